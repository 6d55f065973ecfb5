import pytest


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls, empty and long texts, ties, repeated rows, an extra column whose name operators use inside."""
    long = " ".join(f"word{i % 977}x{i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, "   \n\t"), (4, long), (5, "the same text of the same words again and again"), (6, "the same text of the same words again and again"), (6, "the same text of the same words again and again"), (7, "é\x1c漢字 🙂\n\nWORD word"), (None, "a row without id"), (2**53 + 1, "the id of this row is no double"), (2**53 + 3, "neither is the id of this one")]
    return spark.createDataFrame([(i, t, "en", None, len(t or ""), "clash") for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint, rule string")


@pytest.fixture(scope="session")
def empty(awkward):
    return awkward.where("1 = 0")
