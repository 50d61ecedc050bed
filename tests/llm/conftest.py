import pytest

LONG = " ".join(f"w{i % 977}x{i * 7 % 1009}" for i in range(6000))
PASSAGE = " ".join(f"p{i}" for i in range(60))
BASE = [f"b{i}" for i in range(80)]

TEXTS = [
    None, "", "   \n\t ", "one", "One ONE one", "a b c", "the same text twice", "the same text twice", LONG, PASSAGE + " tail one", "head two " + PASSAGE, " ".join(BASE), " ".join(BASE[:40] + ["zz"] + BASE[40:]),
    "And " * 200, "é ñ 漢字 🙂 \u00a0x", "Released under the MIT License.", "x\x00y \x0b z", "stupid idiot moron " * 3, " ".join(f"q{i}" for i in range(20)),
]


@pytest.fixture(scope="session")
def docs(spark):
    """Nulls, empty and long texts, ties, repeated rows and ids, and columns whose names clash with the operators' own."""
    rows = [(i, t, "x", "y", 1, 2.0) for i, t in enumerate(TEXTS)]
    rows += [(6, TEXTS[6], "x", "y", 1, 2.0), (None, "no id", None, None, None, None), (None, None, None, None, None, None), (3, "an id again", "x", "y", 1, 2.0)]
    return spark.createDataFrame(rows, "doc_id long, text string, row string, rec string, n_words long, score double")


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)
