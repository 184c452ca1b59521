import pytest

LONG = " ".join(f"word{i % 977} tail{i % 31}," for i in range(9000))
EDGE_TEXTS = [None, "", " \n\t ", "same text here for all of them, long enough to count as a line", "same text here for all of them, long enough to count as a line",
              LONG, LONG, "Ünïcödé 日本語 😀 tëxt\nwith lines\nand more of them 12 34", "x", "\n\n\n", "a" * 3000,
              "mail me at jo.doe@example.org or +1 (523) 555-1055 today", "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows,
    and extra columns whose names operators use themselves."""
    rows = [(i if i % 5 else None if i == 5 else i, t, None if i % 3 else "en", None, len(t or ""), 1, "b", 2, "k", 3, 4) for i, t in enumerate(EDGE_TEXTS)]
    rows += [rows[3], rows[3], rows[1], (None, None, None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, id long, "
                                       "block string, fp long, `key` string, length long, _id long")


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.where("false")
