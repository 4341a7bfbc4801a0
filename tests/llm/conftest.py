import pytest
from pyspark.sql import types as T

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Columns of a user that happen to have names which operators also give.
CLASHING = "score double, fp long, base string, part int, ids string, tree string, key string"


@pytest.fixture
def docs(spark):
    """(doc_id, text) pairs as a table of documents with extra columns, over several partitions."""
    def build(pairs, parts=3, langs=None):
        schema = T.StructType([*T._parse_datatype_string(DOCS).fields, *T._parse_datatype_string(CLASHING).fields])
        langs = langs or [None] * len(pairs)
        rows = [(i, t, lang, "s0", None if t is None else len(t), 0.5, 7, "b", 3, "x", None, "k")
                for (i, t), lang in zip(pairs, langs, strict=True)]
        return spark.createDataFrame(rows, schema).repartition(parts)
    return build


@pytest.fixture
def edge_pairs():
    """Nulls, empty and blank texts, repeated rows, ties, one long text and unusual characters."""
    words = ("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda " * 4).strip()
    return [(1, None), (2, ""), (3, " \n\t "), (4, words), (4, words), (5, words), (None, words),
            (None, None), (6, "é中文 😀 \x1c\x85 it's THE end"), (7, "long word " * 9000), (8, "a")]
