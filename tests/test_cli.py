"""The command line builds the same answers as the plans."""

from __future__ import annotations

from kinship import cli


def _lines(spark, argv):
    args = cli._parser().parse_args(argv)
    return sorted(r.value for r in cli.build(spark, args).collect())


def test_cli_tasks(spark, micro_paths, tmp_path):
    out = str(tmp_path / "unused")
    p, f, a = micro_paths["pages"], micro_paths["follows"], micro_paths["activity"]
    assert _lines(spark, ["A", "--pages", p, "--out", out]) == ["Baking\t1", "Chess\t2", "Reading\t3"]
    assert _lines(spark, ["top-pages", "--activity", a, "--pages", p, "--k", "2", "--out", out]) == [
        "2,Bob,Analyst\t3",
        "3,Cyd,Engineer\t3",
    ]
    assert _lines(spark, ["C", "--pages", p, "--out", out]) == ["Ann\tEngineer", "Cyd\tEngineer", "Fay\tAnalyst"]
    assert "98,\t1" in _lines(spark, ["D", "--pages", p, "--follows", f, "--out", out])
    assert _lines(spark, ["E", "--activity", a, "--time", "int", "--out", out]) == [
        "1\t1,1",
        "2\t3,2",
        "3\t3,3",
        "77\t1,1",
    ]
    assert _lines(spark, ["F", "--follows", f, "--out", out]) == ["1\t3", "2\t4"]
    assert _lines(spark, ["G", "--activity", a, "--pages", p, "--time", "int", "--out", out]) == [
        "3\tCyd",
        "5\tAnn",
        "6\tFay",
    ]
    assert _lines(spark, ["H", "--follows", f, "--pages", p, "--out", out]) == [
        "3\tCyd follows ID 1 (No follow back)",
        "3\tCyd follows ID 2 (No follow back)",
        "5\tAnn follows ID 1 (No follow back)",
    ]
    assert _lines(spark, ["record-types", "--lines", ",".join(micro_paths.values()), "--out", out]) == [
        "activity\t8",
        "follows\t12",
        "page\t6",
    ]


def test_cli_main_writes_and_refuses_existing(micro_paths, tmp_path):
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {**os.environ, "PYTHONPATH": root, "KINSHIP_DRIVER_MEMORY": "2g"}
    out = str(tmp_path / "b")
    cmd = [
        sys.executable, "-m", "kinship", "B",
        "--activity", micro_paths["activity"], "--pages", micro_paths["pages"],
        "--k", "2", "--out", out, "--master", "local[2]",
    ]
    assert subprocess.run(cmd, env=env, capture_output=True, timeout=600).returncode == 0
    written = sorted(
        line for name in os.listdir(out) if name.startswith("part-") for line in open(os.path.join(out, name))
    )
    assert written == ["2,Bob,Analyst\t3\n", "3,Cyd,Engineer\t3\n"]
    # An existing output folder is refused unless --mode overwrite is given.
    assert subprocess.run(cmd, env=env, capture_output=True, timeout=600).returncode != 0
    assert subprocess.run(cmd + ["--mode", "overwrite"], env=env, capture_output=True, timeout=600).returncode == 0


def test_cli_h_people_and_mixed_lines(spark, micro_paths, tmp_path):
    out = str(tmp_path / "unused")
    p, f = micro_paths["pages"], micro_paths["follows"]
    assert _lines(spark, ["H", "--follows", f, "--pages", p, "--people", "--out", out]) == ["3\tCyd", "5\tAnn"]
    both = _lines(spark, ["D", "--lines", f"{p},{f}", "--out", out])
    assert both == _lines(spark, ["D", "--pages", p, "--follows", f, "--out", out])


def _run(tmp_path, *argv):
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {**os.environ, "PYTHONPATH": root, "KINSHIP_DRIVER_MEMORY": "2g"}
    cmd = [sys.executable, "-m", "kinship", *argv, "--master", "local[2]"]
    return subprocess.run(cmd, env=env, capture_output=True, timeout=600, text=True)


def test_cli_main_braces_order_and_bad_rows(tmp_path):
    """Brace patterns reach the scan whole; part files are in key order; bad rows are printed, or fail the run."""
    (tmp_path / "a.csv").write_text("".join(f"{i},1,{i % 101 - 3},100,x\n" for i in range(400)))
    (tmp_path / "b.csv").write_text("500,2,7,100,x\n501,2\n502,2,nine,100,x\n")
    (tmp_path / "c.csv").write_text("600,2,5000,100,x\n")
    paths = f"{tmp_path}/{{a,b}}.csv"
    (tmp_path / "p.csv").write_text("".join(f"{i},n{i},j,1,h\n" for i in range(120)))
    done = _run(tmp_path, "D", "--follows", paths, "--pages", f"{tmp_path}/p.csv", "--out", f"{tmp_path}/out")
    assert done.returncode == 0, done.stderr[-2000:]
    lines = [line for part in sorted((tmp_path / "out").glob("part-*")) for line in part.read_text().splitlines()]
    assert [int(line.split(",")[0]) for line in lines] == list(range(-3, 120))
    assert "7,n7\t2" in lines and "follows: 403 rows, 2 bad" in done.stderr and "pages: 120 rows, 0 bad" in done.stderr
    strict = _run(tmp_path, "D", "--follows", paths, "--pages", f"{tmp_path}/p.csv", "--out", f"{tmp_path}/no", "--fail-fast")
    assert strict.returncode != 0 and "malformed row" in strict.stderr


def test_cli_main_takes_path_patterns(tmp_path):
    import os
    import subprocess
    import sys

    for i, hobby in enumerate(("Chess", "Chess", "Baking")):
        (tmp_path / f"p{i}.csv").write_text(f"{i},n,j,1,{hobby}\n")
    (tmp_path / "q.csv").write_text("9,n,j,1,Surfing\n")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {**os.environ, "PYTHONPATH": root, "KINSHIP_DRIVER_MEMORY": "2g"}
    out = str(tmp_path / "out")
    cmd = [sys.executable, "-m", "kinship", "A", "--pages", f"{tmp_path}/p*.csv", "--out", out, "--master", "local[2]"]
    assert subprocess.run(cmd, env=env, capture_output=True, timeout=600).returncode == 0
    written = [line for name in os.listdir(out) if name.startswith("part-") for line in open(os.path.join(out, name))]
    assert sorted(written) == ["Baking\t1\n", "Chess\t2\n"]
