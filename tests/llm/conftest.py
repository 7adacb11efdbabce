import sys

import pytest

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

#: The columns of documents, and further ones with the names that operators use themselves.
CLASHES = ("score", "kept", "taken", "found", "predicted", "_row", "_doc", "_key", "_base", "_maybe", "_spans", "_drawn", "_lane", "Words", "class_id", "row_key", "epoch")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHES)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, repeated rows, and columns whose names clash with results."""
    long_text = " ".join(f"w{i}" for i in range(30_000))
    rows = [(1, None, None, None), (2, "", "en", "a"), (None, "no id here at all", "en", None), (4, "the same text " * 9, "en", "a"), (4, "the same text " * 9, "en", "a"), (5, "the same text " * 9, "en", "b"), (6, long_text, "de", "b"), (7, "x" * 200_000, "fr", "b"), (8, " \n\t ", "es", "c"), (9, "mail a@b.org, 10.0.0.1 and +1 (555) 555-0100, 4111 1111 1111 1111\nReleased under the MIT License.", "en", "c")]
    return spark.createDataFrame([(i, t, g, s, None if t is None else len(t), *CLASHES) for i, t, g, s in rows], SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
