"""Join operators.

Broadcast policy: no join forces a broadcast. Spark's planner broadcasts a
side only when its size estimate (for a top-k, its row limit) is under ``spark.sql.autoBroadcastJoinThreshold`` and which,
under AQE, re-plans with the measured size of finished shuffle stages. Above
the threshold the join is a shuffled sort-merge join, with AQE splitting
skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bounded_lookup(
    bounded: DataFrame,
    key: str,
    table: DataFrame,
    table_key: str,
    columns: Sequence[str],
    default: str | None = None,
) -> DataFrame:
    """Left-join ``bounded`` (a result with a known small row count, such as a
    top-k) to label ``columns`` of a possibly huge ``table``.

    The table meets the bounded keys in a semi-join, which Spark turns into a
    broadcast join where its size check finds the keys small; then the table
    is not shuffled. Of several records of a key the smallest counts (field
    by field, a missing one last). Unmatched keys keep their row, with
    ``default`` in every label column (a matched record's NULL fields stay
    NULL).
    """
    # At most as many keys as bounded rows; repeated keys do not change a semi join.
    keys = bounded.select(F.col(key).alias("_lookup_key"))
    fields = [f for c in columns for f in (F.col(c).isNull().alias(f"no_{c}"), F.col(c))]
    hits = (
        table.join(keys, F.col(table_key) == F.col("_lookup_key"), "left_semi")
        .groupBy(F.col(table_key).alias("_lookup_key"))
        .agg(F.min(F.struct(*fields)).alias("_record"))
        .select("_lookup_key", *(F.col("_record")[c].alias(c) for c in columns))
    )
    joined = bounded.join(hits, F.col(key) == F.col("_lookup_key"), "left")
    # The default marks keys without a record; a record's own empty field stays as it is.
    missing = F.col("_lookup_key").isNull()
    labelled = [
        (F.when(missing, F.lit(default)).otherwise(F.col(c)) if default is not None else F.col(c)).alias(c)
        for c in columns
    ]
    others = [c for c in bounded.columns if c not in columns]
    return joined.select(*[F.col(c) for c in others], *labelled)


def full_outer_with_defaults(
    left: DataFrame,
    left_key: str,
    right: DataFrame,
    right_key: str,
    out_key: str,
    defaults: dict[str, object],
) -> DataFrame:
    """Full outer equi-join; the key is taken from whichever side has it and
    each column in ``defaults`` falls back to its default when missing."""
    joined = left.join(right, left[left_key] == right[right_key], "full_outer")
    cols = [F.coalesce(left[left_key], right[right_key]).alias(out_key)]
    for name, value in defaults.items():
        cols.append(F.coalesce(F.col(name), F.lit(value)).alias(name))
    return joined.select(*cols)
