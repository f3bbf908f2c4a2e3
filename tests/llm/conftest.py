import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from wakeline.llm.workers import importable  # noqa: E402


@pytest.fixture(scope="session")
def lab(spark):
    return importable(spark)


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"


DOCS = "doc_id long, text string, lang string, source string, n_chars long, note string"
RUN = " ".join(f"w{i}" for i in range(40))
#: Nulls, empty and blank texts, copies, equal rows, a long text, a null id, other alphabets.
ODD = [
    (1, None, None, "a", 0, "x"),
    (2, "", "en", "a", 0, None),
    (3, " \t\n\x0b\x0c\r ", "en", None, 8, "x"),
    (4, "one", "en", "a", 3, "x"),
    (5, f"{RUN}\nsecond line of it\n\nthird line of it", "en", "a", 1, "x"),
    (6, f"{RUN}\nsecond line of it\n\nthird line of it", "en", "a", 1, "x"),
    (7, f"before {RUN} after", "en", "a", 1, "x"),
    (7, f"before {RUN} after", "en", "a", 1, "x"),
    (None, f"nobody {RUN}", "en", "a", 1, "x"),
    (8, "été ça ñandú größe 東京 \U0001f600 é", "fr", "a", 1, "x"),
    (9, "long " * 30_000, "en", "a", 1, "x"),
    (10, "x" * 200_000, "de", "a", 1, "x"),
    (11, "same\nsame\nsame\nsame\nsame", "en", "a", 1, "x"),
    (12, "ABC Def\nghi", "EN", "a", 1, "x"),
]


@pytest.fixture(scope="session")
def odd(lab):
    return lab.createDataFrame(ODD, DOCS).repartition(3)


@pytest.fixture(scope="session")
def none(lab):
    return lab.createDataFrame([], DOCS)
