"""Command line: run one task over headerless CSV inputs, write key<TAB>value text.

    python -m kinship top-pages --activity log/ --pages pages.csv --out result/
    spark-submit kinship/cli.py follower-count --lines data/ --out result/

Inputs may be files, folders or patterns (also with braces, data/{a,b}.csv);
several paths are separated by commas. Each task also accepts its letter
(A-H). Output folders are refused if they exist unless ``--mode overwrite`` is
given. Lines come in the order of their keys over the part files (numbers by
value, text by bytes), task B's by visits; --unordered saves that sort. The
rows and bad rows of every typed input are counted by the job itself and
printed; --fail-fast stops at the first bad row.
"""

from __future__ import annotations

import argparse
import os
import sys

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, Observation, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from kinship import sinks  # noqa: E402
from kinship.functions import render_follow_report  # noqa: E402
from kinship.plans import access, followers, hobbies, reciprocity, recency, visits  # noqa: E402
from kinship.session import apply_scale_conf, get_session  # noqa: E402
from kinship.sources import generate, records, text  # noqa: E402

ALIASES = {
    "A": "hobby-frequency",
    "B": "top-pages",
    "C": "hobby-members",
    "D": "follower-count",
    "E": "access",
    "F": "popular-users",
    "G": "outdated-pages",
    "H": "not-followed-back",
}
TASKS = [*ALIASES.values(), "record-types", "generate"]


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="kinship", description=__doc__, formatter_class=argparse.RawTextHelpFormatter)
    p.add_argument("task", help="one of: " + ", ".join(TASKS) + " (or A-H)")
    p.add_argument("--pages", help="page CSV path(s)")
    p.add_argument("--follows", help="follow CSV path(s)")
    p.add_argument("--activity", help="activity CSV path(s)")
    p.add_argument("--lines", help="folder(s) of mixed record lines (tasks D and E, record-types)")
    p.add_argument("--out", required=True, help="output folder")
    p.add_argument("--mode", default="errorifexists", choices=["errorifexists", "overwrite"])
    p.add_argument("--unordered", action="store_true", help="write the lines in any order")
    p.add_argument("--fail-fast", action="store_true", help="fail on the first bad row of a typed input")
    p.add_argument("--hobby", default="Reading", help="task C: the hobby to match")
    p.add_argument("--k", type=int, default=10, help="task B: number of pages")
    p.add_argument("--by", default="page", choices=["page", "person"], help="task E: group by page or by person")
    p.add_argument("--all-owners", action="store_true", help="task F: average over all page owners")
    p.add_argument("--people", action="store_true", help="task H: each person once, not each follow")
    p.add_argument("--time", default="date", choices=["date", "int"], help="task G: time column type")
    p.add_argument("--max-gap", type=int, default=90, help="task G: idle days (or units)")
    p.add_argument("--users", type=int, default=generate.N_USERS, help="generate: pages")
    p.add_argument("--n-follows", type=int, default=generate.N_FOLLOWS, help="generate: follow rows")
    p.add_argument("--n-activity", type=int, default=generate.N_ACTIVITY, help="generate: activity rows")
    p.add_argument("--seed", type=int, default=0, help="generate: seed")
    p.add_argument("--master", default=None, help="Spark master for local runs, e.g. local[*]")
    return p


def _need(args, *names: str) -> None:
    missing = [n for n in names if not getattr(args, n)]
    if missing:
        raise SystemExit(f"task {args.task} needs --{' --'.join(missing)}")


class Scans:
    """The typed inputs of one run, with an observation of each that is read."""

    def __init__(self, spark: SparkSession, args):
        self.spark, self.args = spark, args
        self.counted: dict[str, Observation] = {}

    def _options(self, name: str, trim_numbers: bool) -> dict:
        self.counted[name] = Observation(name)
        return {"counted": self.counted[name], "trim_numbers": trim_numbers, "strict": self.args.fail_fast}

    def pages(self, trim_numbers: bool = False) -> DataFrame:
        return text.read_pages(self.spark, self.args.pages, **self._options("pages", trim_numbers))

    def follows(self, trim_numbers: bool = False) -> DataFrame:
        return text.read_follows(self.spark, self.args.follows, **self._options("follows", trim_numbers))

    def activity(self, integer_time: bool = False, trim_numbers: bool = False) -> DataFrame:
        options = self._options("activity", trim_numbers)
        return text.read_activity(self.spark, self.args.activity, integer_time=integer_time, **options)

    def report(self) -> list[str]:
        """A line for each input, when the job has run."""
        return [f"{name}: {o.get['n_rows']} rows, {o.get['n_bad']} bad" for name, o in self.counted.items()]


def build(spark: SparkSession, args, scans: Scans | None = None) -> DataFrame:
    """The key<TAB>value lines of one task (a lazy DataFrame)."""
    scans = scans or Scans(spark, args)

    def _as_text(df: DataFrame, keys: list[str], values: list[str], by_key: bool = True) -> DataFrame:
        rows = sinks.in_key_order(df, keys) if by_key and not args.unordered else df
        return sinks.key_value_lines(rows, keys, values)

    task = ALIASES.get(args.task.upper(), args.task) if len(args.task) == 1 else args.task
    integer_time = args.time == "int"
    if task == "hobby-frequency":
        _need(args, "pages")
        return _as_text(hobbies.hobby_frequency(scans.pages()), ["hobby"], ["frequency"])
    if task == "top-pages":
        _need(args, "activity", "pages")
        best = visits.top_pages(scans.activity(), scans.pages(), args.k)
        return _as_text(best, ["page_id", "nickname", "job_title"], ["visits"], by_key=False)
    if task == "hobby-members":
        _need(args, "pages")
        return _as_text(hobbies.hobby_members(scans.pages(), args.hobby), ["nickname"], ["job_title"])
    if task == "follower-count":
        if args.lines:
            records_of = records.follower_records(text.read_lines(spark, args.lines))
            result = followers.follower_count_of_records(records_of)
        else:
            _need(args, "pages", "follows")
            result = followers.follower_count(scans.follows(), scans.pages())
        return _as_text(result, ["id", "nickname"], ["n_followers"])
    if task == "access":
        if args.lines:
            _, _, log = records.typed_from_mixed(text.read_lines(spark, args.lines))
        else:
            _need(args, "activity")
            log = scans.activity(integer_time)
        result = access.access_by_page(log) if args.by == "page" else access.access_by_person(log)
        key = "page_id" if args.by == "page" else "by_who"
        return _as_text(result, [key], ["n_total", "n_distinct"])
    if task == "popular-users":
        _need(args, "follows")
        if args.all_owners:
            _need(args, "pages")
            result = followers.popular_users_all_owners(scans.follows(), scans.pages())
        else:
            result = followers.popular_users(scans.follows())
        return _as_text(result, ["id"], ["n_follows"])
    if task == "outdated-pages":
        _need(args, "activity", "pages")
        # The recency and reciprocity tasks accept ids and times padded with spaces.
        log, pages = scans.activity(integer_time, trim_numbers=True), scans.pages(trim_numbers=True)
        plan = recency.outdated_pages_int if integer_time else recency.outdated_pages
        return _as_text(plan(pages, log, args.max_gap), ["id"], ["nickname"])
    if task == "not-followed-back":
        _need(args, "follows", "pages")
        follows, pages = scans.follows(trim_numbers=True), scans.pages(trim_numbers=True)
        if args.people:
            return _as_text(reciprocity.not_followed_back_people(follows, pages), ["id"], ["nickname"])
        rows = reciprocity.not_followed_back(follows, pages)
        report = rows.select("id", render_follow_report(F.col("nickname"), F.col("followed_id")).alias("report"))
        return _as_text(report, ["id"], ["report"])
    if task == "record-types":
        _need(args, "lines")
        return _as_text(records.record_type_counts(text.read_lines(spark, args.lines)), ["kind"], ["n_lines"])
    raise SystemExit(f"unknown task {args.task!r}; expected one of {', '.join(TASKS)}")


def run_generate(spark: SparkSession, args) -> None:
    out = args.out.rstrip("/")
    sinks.write_csv(generate.gen_pages(spark, args.users, args.seed), f"{out}/pages", args.mode)
    sinks.write_csv(generate.gen_follows(spark, args.n_follows, args.users, args.seed), f"{out}/follows", args.mode)
    sinks.write_csv(generate.gen_activity(spark, args.n_activity, args.users, args.seed), f"{out}/activity", args.mode)


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = get_session(args.master)
    try:
        if args.task == "generate":
            run_generate(spark, args)
        else:
            inputs = [p for v in (args.pages, args.follows, args.activity, args.lines) if v for p in text.path_list(v)]
            apply_scale_conf(spark, inputs)
            scans = Scans(spark, args)
            build(spark, args, scans).write.mode(args.mode).text(args.out)
            for line in scans.report():
                print(line, file=sys.stderr)
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
