from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from kinship.session import get_session  # noqa: E402
from kinship.sources import text  # noqa: E402

# Micro fixture with hand-worked answers (integer time mode). Pages cover a
# repeated nickname, pages nobody follows and a never-active member; follows
# cover a duplicate edge, a self-follow, ids without a page and one-way
# edges; the log covers a quoted action list, an unparsable time, a visited
# page without a record and an actor without a page.
PAGE_LINES = [
    "1,Ann,Engineer,7,Reading",
    "2,Bob,Analyst,7,Chess",
    "3,Cyd,Engineer,7,Reading",
    "4,Dee,Manager,9,Chess",
    "5,Ann,Manager,7,Baking",
    "6,Fay,Analyst,9,Reading",
]
FOLLOW_LINES = [
    "1,1,2,100,a",
    "2,1,2,101,b",
    "3,2,1,102,c",
    "4,3,1,103,d",
    "5,1,4,104,e",
    "6,5,5,105,f",
    "7,4,99,106,g",
    "8,5,1,107,h",
    "9,99,2,108,i",
    "10,2,4,109,j",
    "11,3,2,110,k",
    "12,6,98,111,l",
]
ACTIVITY_LINES = [
    "1,1,2,viewed,1000",
    '2,1,2,"viewed,like",990',
    "3,1,3,viewed,5",
    "4,2,2,viewed,910",
    "5,3,1,viewed,909",
    "6,4,77,viewed,950",
    '7,5,3,"viewed,poked",abc',
    "8,42,3,viewed,995",
]


@pytest.fixture(scope="session")
def spark():
    session = get_session("local[4]", shuffle_partitions=4)
    yield session
    session.stop()


def _write(folder, name: str, lines: list[str]) -> str:
    path = folder / f"{name}.csv"
    path.write_text("\n".join(lines) + "\n")
    return str(path)


@pytest.fixture(scope="session")
def micro_paths(tmp_path_factory):
    folder = tmp_path_factory.mktemp("micro")
    return {
        "pages": _write(folder, "pages", PAGE_LINES),
        "follows": _write(folder, "follows", FOLLOW_LINES),
        "activity": _write(folder, "activity", ACTIVITY_LINES),
    }


class Micro:
    def __init__(self, spark, paths):
        self.pages = text.read_pages(spark, paths["pages"])
        self.follows = text.read_follows(spark, paths["follows"], integer_time=True)
        self.activity = text.read_activity(spark, paths["activity"], integer_time=True)


@pytest.fixture(scope="session")
def micro(spark, micro_paths):
    return Micro(spark, micro_paths)
