"""Small tables with everything an operator may meet."""

import os

import pytest

SF_DIR = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the given tables")

#: The documents' columns, and more whose names operators use for their own.
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, row long, keep_id string, digest string, "
    "range int, shard string, slot string, bucket int, score string, lang_pred string, guessed int, kept_row int, gone int, drawn int"
)


def document(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, None if text is None else len(text), 7, "x", "y", 1, "s", "t", 2, "u", "v", 3, 4, 5, 6)


LONG = " ".join(f"word{i}" for i in range(40_000))
EDGES = [
    document(5, "The cat sat on the mat, and the dog looked at it from the door."),
    document(3, "The cat sat on the mat,\tand the dog looked at it from the door. "),
    document(9, "The cat sat on the mat, and the dog looked at it from the door."),
    document(9, "The cat sat on the mat, and the dog looked at it from the door."),
    document(1, None, None, None), document(2, ""), document(4, " \n\t "), document(None, "A text without an id."),
    document(None, None, None, None), document(6, "1234 !!"), document(7, "one", "fr", None), document(8, LONG),
    document(10, LONG.replace("word7 ", "changed ")), document(11, "é ß\U0001F600 end", "de", "b"),
]


@pytest.fixture
def docs(spark):
    def build(rows=EDGES):
        return spark.createDataFrame(rows, SCHEMA)

    return build


@pytest.fixture
def given(spark):
    return lambda name: spark.read.parquet(f"{SF_DIR}/{name}.parquet")


def same_columns(before, after):
    assert after.columns == before.columns
    assert after.dtypes == before.dtypes
