"""Headerless comma-separated text: typed scans, a mixed-record classifier and
a malformed-row policy.

Typed scans use Spark's CSV reader with an explicit schema (never schema
inference), so a comma list inside quotes (``"viewed,like"``) stays one
field, only the referenced columns are parsed, and any number of paths or
folders can be read in one job.

Malformed-row policy (one policy for all inputs): in PERMISSIVE mode a field
that does not parse becomes NULL and the rest of the row is kept; a row
without its key column is dropped by the plans (``kinship.operators.keys``). ``mode="FAILFAST"`` makes a
scan fail on the first bad row instead. A scan can count its rows and its bad
rows for an ``Observation`` while the job that needs them runs.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinship.functions import is_digits, tokens
from kinship.sources import schemas

# The record kinds of a mixed text line.
KIND_PAGE = "page"
KIND_FOLLOWS = "follows"
KIND_ACTIVITY = "activity"
KIND_UNKNOWN = "unknown"
KIND_MALFORMED = "malformed"  # fewer than four non-empty tokens

# Outcomes of a typed parse.
PARSE_OK = "ok"
PARSE_BAD_FIELD = "bad_field"
PARSE_SHORT = "short"

# A quoted CSV segment (a doubled quote inside is part of it).
QUOTED_SEGMENT = '"[^"]*(?:""[^"]*)*"'

CSV_OPTIONS = {
    "header": "false",
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "dateFormat": "yyyy-MM-dd",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def path_list(paths: str | Sequence[str]) -> list[str]:
    """The paths of a comma-separated list; a comma inside braces belongs to
    its pattern, as in ``data/{a,b}.csv``. A brace that is never closed has no
    meaning of its own."""
    if not isinstance(paths, str):
        return list(paths)
    found, start, depth = [], 0, 0
    for i, char in enumerate(paths):
        if char == "{" and "}" in paths[i:]:
            depth += 1
        elif char == "}" and depth:
            depth -= 1
        elif char == "," and not depth:
            found.append(paths[start:i])
            start = i + 1
    return [p for p in (*found, paths[start:]) if p]


# Fixed value: characters stripped from number and date fields when a scan
# trims them, U+0000 through U+0020.
NUMBER_PADDING = "".join(chr(i) for i in range(0x21))


def _trimmed_cast(value: F.Column, data_type: T.DataType) -> F.Column:
    stripped = F.btrim(value, F.lit(NUMBER_PADDING))
    if isinstance(data_type, T.DateType):
        return F.to_date(F.try_to_timestamp(stripped, F.lit(CSV_OPTIONS["dateFormat"])))
    return stripped.try_cast(data_type)


def read_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType,
    mode: str = "PERMISSIVE",
    keep_corrupt: bool = False,
    trim_numbers: bool = False,
    counted: Observation | None = None,
    strict: bool = False,
) -> DataFrame:
    """Typed scan of one or more headerless CSV paths (files or folders;
    a single string may hold several comma-separated paths).

    With ``trim_numbers`` (PERMISSIVE only), number and date fields may be
    padded with spaces or control characters: they are read as text,
    stripped and then cast (a failed cast gives NULL); text fields are kept
    exactly as written.

    ``counted`` gets the metrics ``n_rows``, ``n_bad`` and ``n_gaps`` (rows
    without one of their numbers or dates) of the scan, from the same job that
    reads it. With ``strict`` a bad row fails the job, also
    where fields are trimmed; ``mode="FAILFAST"`` is Spark's own check, for
    scans that trim nothing. A bad row has another number of fields than the
    schema, or a number or date field that is not empty and does not parse;
    to find them every field is parsed, also those that the plan does not need."""
    reader = spark.read.options(**CSV_OPTIONS).option("mode", mode)
    if mode != "PERMISSIVE" and counted is None and not trim_numbers:
        # Any bad field of a row fails the scan, also one that the plan does not need.
        return reader.option("columnPruning", "false").schema(schema).csv(path_list(paths))
    if trim_numbers and mode != "PERMISSIVE":
        raise ValueError(f"trim_numbers reads fields as text first and works in PERMISSIVE mode only, not {mode}")
    read = schema
    if trim_numbers:
        read = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    if (strict or counted is not None) and mode == "PERMISSIVE":
        raw = _judged(reader, path_list(paths), read, schema, counted, strict)
    elif keep_corrupt and mode == "PERMISSIVE":
        reader = reader.option("columnNameOfCorruptRecord", schemas.CORRUPT_COLUMN)
        return reader.schema(schemas.with_corrupt_column(schema)).csv(path_list(paths))
    else:
        raw = reader.schema(read).csv(path_list(paths))
    if not trim_numbers:
        return raw
    return raw.select(
        *[
            (F.col(f.name) if isinstance(f.dataType, T.StringType) else _trimmed_cast(F.col(f.name), f.dataType))
            .alias(f.name)
            for f in schema.fields
        ]
    )


def _judged(
    reader, paths: list[str], read: T.StructType, schema: T.StructType, counted: Observation | None, strict: bool
) -> DataFrame:
    """The scan with its rows and bad rows counted on the way, or failing at a bad one."""
    reader = reader.option("columnNameOfCorruptRecord", schemas.CORRUPT_COLUMN).option("columnPruning", "false")
    raw = reader.schema(schemas.with_corrupt_column(read)).csv(paths)
    bad = F.col(schemas.CORRUPT_COLUMN).isNotNull()
    for text_field, field in zip(read.fields, schema.fields):
        if text_field.dataType != field.dataType:
            value = F.col(field.name)
            bad = bad | (value.isNotNull() & _trimmed_cast(value, field.dataType).isNull())
    if counted is not None:
        # The last count needs all numbers and dates, so the scan parses them all.
        gap = reduce(or_, (F.col(f.name).isNull() for f in schema.fields if not isinstance(f.dataType, T.StringType)))
        counts = {"n_rows": F.count(F.lit(1)), "n_bad": F.count_if(bad), "n_gaps": F.count_if(gap)}
        raw = raw.observe(counted, *(count.alias(name) for name, count in counts.items()))
    if strict:
        shown = F.concat(F.lit("malformed row: "), F.to_json(F.struct(*(f.name for f in read.fields))))
        raw = raw.where(F.when(bad, F.raise_error(shown).cast("boolean")).otherwise(True))
    return raw.drop(schemas.CORRUPT_COLUMN)


def read_pages(
    spark: SparkSession,
    paths,
    mode: str = "PERMISSIVE",
    trim_numbers: bool = False,
    counted: Observation | None = None,
    strict: bool = False,
) -> DataFrame:
    return read_csv(spark, paths, schemas.PAGE, mode, trim_numbers=trim_numbers, counted=counted, strict=strict)


def read_follows(
    spark: SparkSession,
    paths,
    mode: str = "PERMISSIVE",
    integer_time: bool = False,
    trim_numbers: bool = False,
    counted: Observation | None = None,
    strict: bool = False,
) -> DataFrame:
    schema = schemas.FOLLOWS_INT if integer_time else schemas.FOLLOWS
    return read_csv(spark, paths, schema, mode, trim_numbers=trim_numbers, counted=counted, strict=strict)


def read_activity(
    spark: SparkSession,
    paths,
    mode: str = "PERMISSIVE",
    integer_time: bool = False,
    trim_numbers: bool = False,
    counted: Observation | None = None,
    strict: bool = False,
) -> DataFrame:
    schema = schemas.ACTIVITY_INT if integer_time else schemas.ACTIVITY
    return read_csv(spark, paths, schema, mode, trim_numbers=trim_numbers, counted=counted, strict=strict)


def read_key_value(spark: SparkSession, paths, schema: T.StructType | str) -> DataFrame:
    """Typed scan of ``key<TAB>value`` text (the key-value sink's format).
    A key or value made of several comma-joined parts stays one field."""
    return (
        spark.read.options(**{**CSV_OPTIONS, "sep": "\t", "quote": "\u0000"})
        .schema(schema)
        .csv(path_list(paths))
    )


def read_lines(spark: SparkSession, paths) -> DataFrame:
    """Raw lines (column ``value``) of any number of text paths; folders are
    read with all their sub-folders (a mixed folder may hold one sub-folder
    per source)."""
    return spark.read.option("recursiveFileLookup", "true").text(path_list(paths))


def _kind_of_tokens(toks: F.Column) -> F.Column:
    t1, t2, t3 = (F.get(toks, i) for i in (1, 2, 3))
    n1, n2, n3 = is_digits(t1), is_digits(t2), is_digits(t3)
    return (
        F.when(F.size(toks) < 4, F.lit(KIND_MALFORMED))
        .when(n1 & n2 & n3, F.lit(KIND_FOLLOWS))
        .when(n1 & n2 & ~n3, F.lit(KIND_ACTIVITY))
        .when(~n1 & ~n2, F.lit(KIND_PAGE))
        .otherwise(F.lit(KIND_UNKNOWN))
    )


def record_kind(line: F.Column) -> F.Column:
    """Kind of a mixed text line, decided by its 2nd-4th non-empty
    comma-separated tokens: three numbers -> follows; two numbers then text
    -> activity; two texts -> page; anything else -> unknown."""
    return _kind_of_tokens(tokens(line))


def classify(lines: DataFrame, column: str = "value", keep_tokens: bool = False) -> DataFrame:
    """Add ``kind``; with ``keep_tokens`` also the non-empty tokens as
    ``_tokens``. The token array is projected once and then inspected, so
    each line is split a single time."""
    # The tokens come out of a generator (``inline`` of a one-element array).
    # Catalyst pushes a later filter such as ``kind = 'follows'`` through
    # plain projections by copying their expressions into it, which would
    # tokenize (and, for derived lines, render) every line once per
    # reference; a predicate on a generator's output stays above it.
    one = F.array(F.struct(tokens(F.col(column)).alias("_tokens")))
    with_tokens = lines.select("*", F.inline(one))
    kinds = with_tokens.withColumn("kind", _kind_of_tokens(F.col("_tokens")))
    return kinds if keep_tokens else kinds.drop("_tokens")


def field_count(line: F.Column, sep: str = ",") -> F.Column:
    """Number of CSV fields of a line: separators outside quoted segments + 1."""
    # Quoted segments are only collapsed in lines that have a quote at all.
    unquoted = F.when(F.instr(line, '"') > 0, F.regexp_replace(line, QUOTED_SEGMENT, "q")).otherwise(line)
    return F.size(F.split(unquoted, sep, -1))


def parse_lines(lines: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """Parse a text column with a CSV schema (PERMISSIVE), adding ``parse``:
    ``ok``; ``short`` (too few or too many fields); ``bad_field`` (right
    width, but a number or date field is empty or does not parse)."""
    options = {k: v for k, v in CSV_OPTIONS.items() if k != "header"}
    # Parse once into a struct column, then read its fields.
    parsed = lines.select(
        "*",
        F.from_csv(F.col(column), schema.simpleString(), options).alias("_parsed"),
        field_count(F.col(column)).alias("_width"),
    )
    fields = [F.col("_parsed").getField(f.name) for f in schema.fields]
    bad = F.lit(False)
    for value, field in zip(fields, schema.fields):
        if not isinstance(field.dataType, T.StringType):
            bad = bad | value.isNull()
    outcome = (
        F.when(F.col("_width") != len(schema.fields), F.lit(PARSE_SHORT))
        .when(bad, F.lit(PARSE_BAD_FIELD))
        .otherwise(F.lit(PARSE_OK))
    )
    return parsed.select(
        *lines.columns, *[v.alias(f.name) for v, f in zip(fields, schema.fields)], outcome.alias("parse")
    )
