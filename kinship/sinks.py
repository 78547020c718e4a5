"""Writers for results and generated inputs.

* :func:`write_key_value_text` - one ``key<TAB>value`` line per row (several
  value columns are joined with commas), the classic text output; with
  ``ordered``, in the order of the key over all part files.
* :func:`write_csv` - headerless CSV, quoted where a field holds a comma.

``mode`` is Spark's save mode: ``errorifexists`` (the default: refuse an
existing target), ``overwrite`` (replace it), ``append`` or ``ignore``.
Writes go through Spark's output committer, so a lost executor's partial
files never become visible.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinship.sources.text import CSV_OPTIONS


def key_value_lines(df: DataFrame, key: str | Sequence[str], values: Sequence[str] | None = None) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    values = [c for c in df.columns if c not in keys] if values is None else list(values)

    # A missing field is written as an empty one, so every line has all fields.
    def joined(names: Sequence[str]) -> Column:
        return F.concat_ws(",", *[F.coalesce(F.col(n).cast("string"), F.lit("")) for n in names])

    return df.select(F.concat_ws("\t", joined(keys), joined(values)).alias("value"))


def in_key_order(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows in the order of their key over all partitions: numbers by value,
    text by its bytes, missing keys first.

    The tasks get ranges of the key and sort them, so the part files, read in
    the order of their names, are the sorted result. The other columns break
    ties: rows of one hot key are cut into ranges too.
    """
    keys = [key] if isinstance(key, str) else list(key)
    return df.orderBy(*keys, *(c for c in df.columns if c not in keys))


def write_key_value_text(
    df: DataFrame,
    path: str,
    key: str | Sequence[str],
    values: Sequence[str] | None = None,
    mode: str = "errorifexists",
    ordered: bool = False,
) -> None:
    rows = in_key_order(df, key) if ordered else df
    key_value_lines(rows, key, values).write.mode(mode).text(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    opts = {k: v for k, v in CSV_OPTIONS.items() if k not in ("ignoreLeadingWhiteSpace", "ignoreTrailingWhiteSpace")}
    df.write.mode(mode).options(**opts).csv(path)


def committed(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds a finished Spark write (its ``_SUCCESS``
    marker exists), on whatever file system the path names."""
    jvm = spark.sparkContext._jvm
    marker = jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + "/_SUCCESS")
    fs = marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(marker))
