"""Helpers that several test files import. (A conftest is no module to import
from: the folders below have their own, of the same name.)"""

from __future__ import annotations

SF_SMALL = "/root/testdata/sf0.001"


def rows(df) -> list[tuple]:
    return sorted(tuple(r) for r in df.collect())
