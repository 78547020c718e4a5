"""Licence scan by ordered signature rules, in DataFrame functions only.

1. A text becomes its words, lower-case, with single spaces between, before
   and after. Only texts that hold one of the rules' keywords go on; all the
   others are done after a number of substring tests.
2. For each such text the rules whose own keyword it holds are tried; every
   match is an interval of words.
3. Detections inside an earlier-starting or equal interval are suppressed (of
   equal intervals the rule of best priority stays); of two that overlap
   without containment, the one of worse priority goes. A hint ("licensed
   under the X") suppresses only hints, and goes where it touches anything
   else, inside it or not: the licence that it introduces stays.

Base phrases are counted before suppression, at every place, and their labels
always stay.

Defined results: a null text counts as empty; a text without a word has
n_words 0, null first_word and last_word, empty labels and score 0; every row
gives a row, also repeated ones; an empty table gives none; further columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kinship.llm.common import numbered, written
from kinship.llm.license_rules import HINT, Rule, announced, rules

# ASCII characters that are neither digits nor letters of lower-case text.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Two characters that words can't hold, around each match.
OPEN, CLOSE = "\x01", "\x02"

# The same around each announced expression of identifiers.
BEGIN, END = "\x03", "\x04"


def _spaces(text: Column) -> Column:
    return F.char_length(text) - F.char_length(F.replace(text, F.lit(" "), F.lit("")))


def words_of(docs: DataFrame, chosen: tuple[Rule, ...]) -> DataFrame:
    """row, doc_id, n_words, words (null where no rule can match)."""
    # Lower-casing beyond ASCII changes no word's bounds and makes no ASCII letter but k, which no base phrase has.
    body = F.trim(F.regexp_replace(F.lower(F.coalesce("text", F.lit(""))), BETWEEN, " "))
    padded = F.concat(F.lit(" "), F.col("body"), F.lit(" "))
    any_keyword = F.lit(False)
    keywords = {r.keyword for r in chosen}
    # A keyword that holds another one needs no test of its own here.
    for keyword in sorted(k for k in keywords if not any(o in k for o in keywords - {k})):
        any_keyword = any_keyword | F.contains(F.col("words"), F.lit(keyword))
    return (
        docs.select("doc_id", body.alias("body"))
        .withColumn("words", padded)
        .select(
            "doc_id",
            F.when(F.col("body") == "", 0).otherwise(_spaces(F.col("words")) - 1).cast("long").alias("n_words"),
            F.when(any_keyword, F.col("words")).alias("words"),
        )
    )


def pattern(rule: Rule) -> str:
    """The regular expression of a rule between words, with what has to stand before a match."""
    if rule.announced:
        # First in its expression, or joined to what stands before it there.
        return f"(?<={BEGIN}|{BEGIN}[a-z0-9 ]{{1,600}} (?:or|and) ){rule.pattern}(?= )"
    behind = f"(?={rule.pattern} )(?<= {rule.behind})" if rule.behind else ""
    return f"(?<= ){behind}{rule.pattern}(?= )"


def _tried(i: int, rule: Rule) -> str:
    """SQL of a rule's fields and of a text cut before each match: spaces of each
    piece, and those inside the match that begins it."""
    inside = f"substring_index(p, '{CLOSE}', 1)"
    marked = f"regexp_replace({'tagged' if rule.announced else 'words'}, r'{pattern(rule)}', '{OPEN}$0{CLOSE}')"
    spaces, within = (f"char_length({x}) - char_length(replace({x}, ' ', ''))" for x in ("p", inside))
    return f"""named_struct(
        'rule', {i}, 'label', '{rule.label}', 'priority', {rule.priority}, 'score', {rule.score}D, 'base', {str(rule.base).lower()},
        'pieces', transform(split({marked}, '{OPEN}'), p -> named_struct('spaces', {spaces}, 'inside', {within})))"""


def detections(texts: DataFrame, chosen: tuple[Rule, ...]) -> DataFrame:
    """(row, rule, label, priority, score, base, start, stop) of every match; words from 0, stop exclusive."""
    words = F.col("words")
    # Marks change no count of spaces. Texts that announce nothing stay as they are.
    tagged = F.when(F.contains(words, F.lit("identifier")), F.regexp_replace(words, F.lit(announced()), F.lit(f"{BEGIN}$0{END}")))
    # Each rule's expression is a literal, so a task compiles it once; only the places of its matches are kept.
    gates = []
    for keyword in sorted({r.keyword for r in chosen}):
        gated = ", ".join(_tried(i, r) for i, r in enumerate(chosen) if r.keyword == keyword)
        gates.append(f"CASE WHEN contains(words, '{keyword}') THEN array({gated}) END")
    tried = F.flatten(F.filter(F.expr(f"array({', '.join(gates)})"), lambda g: g.isNotNull()))
    matched = F.filter(tried, lambda r: F.size(r["pieces"]) > 1)
    found = texts.where(words.isNotNull()).select("row", "words", tagged.alias("tagged")).select("row", F.explode(matched).alias("r"))
    so_far = Window.partitionBy("row", "rule").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    # Spaces before a match, less the one before the first word.
    start = F.sum("piece.spaces").over(so_far) - 1
    fields = ("rule", "label", "priority", "score", "base")
    return (
        found.select("row", *(f"r.{name}" for name in fields), F.posexplode("r.pieces").alias("place", "piece"))
        .withColumn("start", start)
        .where(F.col("place") > 0)
        .select(
            "row",
            *fields,
            F.col("start").cast("long").alias("start"),
            (F.col("start") + F.col("piece.inside") + 1).cast("long").alias("stop"),
        )
    )


def resolved(found: DataFrame) -> DataFrame:
    """The detections that are left after suppression."""
    hint = F.col("priority") >= HINT
    forth = ("start", F.desc("stop"), "priority", "rule")
    back = (F.desc("start"), "stop", F.desc("priority"), F.desc("rule"))
    before = Window.partitionBy("row").orderBy(*forth).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("row").orderBy(*back).rowsBetween(Window.unboundedPreceding, -1)
    reached = F.when(hint, F.max("stop").over(before)).otherwise(F.max(F.when(~hint, F.col("stop"))).over(before))
    outer = found.withColumn("reached", reached).where(F.col("reached").isNull() | (F.col("reached") < F.col("stop")))
    # Starts and stops of all but the hints both ascend now, so of them only neighbours overlap directly.
    order = Window.partitionBy("row", hint).orderBy(*forth)
    neighbour = ((F.lag("stop").over(order) > F.col("start")) & (F.lag("priority").over(order) < F.col("priority"))) | (
        (F.lead("start").over(order) < F.col("stop")) & (F.lead("priority").over(order) < F.col("priority"))
    )
    touched = (F.max(F.when(~hint, F.col("stop"))).over(before) > F.col("start")) | (
        F.min(F.when(~hint, F.col("start"))).over(after) < F.col("stop")
    )
    beaten = F.coalesce(neighbour, F.lit(False)) | (hint & F.coalesce(touched, F.lit(False)))
    return outer.withColumn("beaten", beaten).where(~F.col("beaten")).drop("reached", "beaten")


def scan(docs: DataFrame, chosen: tuple[Rule, ...] | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, base (struct of the base
    phrases' n, first, last, labels), found (array of the detections left)."""
    chosen = rules() if chosen is None else chosen
    texts = written(numbered(words_of(docs, chosen), "row"), "licence-words")
    found = written(detections(texts, chosen), "licence-matches")
    base = (
        found.where("base")
        .groupBy("row")
        .agg(
            F.struct(
                F.count(F.lit(1)).alias("n"),
                F.min("start").alias("first"),
                F.max("start").alias("last"),
                F.array_sort(F.collect_set("label")).alias("labels"),
            ).alias("base")
        )
    )
    left = (
        resolved(found)
        .groupBy("row")
        .agg(F.array_sort(F.collect_list(F.struct("start", "stop", "label", "priority", "score"))).alias("found"))
    )
    return texts.select("row", "doc_id", "n_words").join(base, "row", "left").join(left, "row", "left").drop("row")


def digest(scanned: DataFrame) -> DataFrame:
    """Columns of the registered query, from what :func:`scan` returns."""
    base_labels = F.coalesce(F.col("base.labels"), F.array().cast("array<string>"))
    labels = F.array_sort(F.array_union(base_labels, F.coalesce("found.label", F.array().cast("array<string>"))))
    return scanned.select(
        "doc_id",
        "n_words",
        F.coalesce("base.n", F.lit(0)).cast("long").alias("n_base"),
        F.col("base.first").alias("first_word"),
        F.col("base.last").alias("last_word"),
        F.array_join(base_labels, ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.greatest(
            F.coalesce(F.array_max("found.score"), F.lit(0.0)), F.when(F.col("base.n") > 0, 0.6).otherwise(0.0)
        ).alias("score"),
    )
