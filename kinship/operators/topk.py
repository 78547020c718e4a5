"""Top-k.

``orderBy(...).limit(k)`` is planned as ``TakeOrderedAndProject``: every
partition keeps its own k best rows and only those reach a single task, the
same two-phase shape as a per-mapper heap followed by one merging reducer.
The limit is the feature here (a top-k report), not a row cap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top_k(df: DataFrame, by: str, k: int, tie_break: str | None = None) -> DataFrame:
    """The ``k`` rows with the largest ``by``; ties broken by ascending
    ``tie_break`` so the answer is deterministic."""
    order: list[Column] = [F.desc(by)]
    if tie_break:
        order.append(F.asc(tie_break))
    return df.orderBy(*order).limit(k)
