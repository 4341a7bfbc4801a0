"""Every operator on nulls, empty and long texts, repeated rows, empty tables and clashing columns."""

import public_tokenizers
import pytest

import corpus_pipeline
from lakeops.llm import (
    byte_bpe, infilling, langid, lexicon_bpe, licenses, merkle, packing, pii, quality_gam, rules, simhash,
    urls, vector_codes)

RANKS, WORDS = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
LABELS = "doc_id long, quality int, toxic int"

PER_DOCUMENT = {
    "pii": pii.personal_data_report,
    "quality": lambda d: quality_gam.classify_quality(
        d, d.sparkSession.createDataFrame([(4, 1, 0), (7, 0, 0), (None, 1, 0), (8, None, 0)], LABELS)),
    "bpe": lambda d: byte_bpe.encode_documents(d, RANKS, public_tokenizers.PATTERN, 2_000, 100),
    "licenses": licenses.scan_licenses,
    "rules": rules.judge,
    "simhash": simhash.near_copies,
    "language": langid.identify_language,
    "merkle_next": lambda d: merkle.compare_with_next(d, 3),
    "merkle": merkle.fingerprint_documents,
    "infilling": infilling.rearrange,
    "lexicon": lambda d: lexicon_bpe.encode_texts(d, BYTES, 5),
}
KEEPING = {
    "quality": lambda d: quality_gam.keep_good(d, d.sparkSession.createDataFrame([], LABELS)),
    "language": langid.keep_identified,
    "near": simhash.keep_one_of_each,
    "pii": pii.sanitise,
}


@pytest.mark.parametrize("name", PER_DOCUMENT)
def test_one_row_per_row(docs, edge_pairs, name):
    got = [tuple(r) for r in PER_DOCUMENT[name](docs(edge_pairs, langs=["en"] * len(edge_pairs))).collect()]
    assert sorted(str(r[0]) for r in got) == sorted(str(i) for i, _ in edge_pairs)
    twins = [r for r in got if r[0] == 4]
    assert len(twins) == 2 and (name == "merkle_next" or twins[0] == twins[1])
    assert PER_DOCUMENT[name](docs([])).count() == 0


@pytest.mark.parametrize("name", KEEPING)
def test_stages_keep_columns(docs, edge_pairs, name):
    df = docs(edge_pairs, langs=["en"] * len(edge_pairs))
    got = KEEPING[name](df)
    assert got.columns == df.columns and got.dtypes == df.dtypes
    assert got.count() <= len(edge_pairs)
    assert KEEPING[name](docs([])).count() == 0


def test_packing_holds_every_id_once(docs, edge_pairs):
    got = packing.pack(docs(edge_pairs), WORDS).collect()
    assert sum(r.length for r in got if r.doc_id == 4) == 2 * (4 * 11 + 1)
    assert [r.doc_tokens for r in got if r.doc_id == 1] == [1]
    assert packing.pack(docs([]), WORDS).count() == 0


def test_urls_of_any_kind(spark):
    pages = spark.createDataFrame(
        [(1, None, 0), (2, "", 1), (None, "http://a.org/", 2), (3, "HTTP://A.ORG/x?y", 3), (3, "HTTP://A.ORG/x?y", 3),
         (4, "no scheme", 4), (5, "://", 5), (6, "x://b.net" + "/p" * 9000, 6)], "page_id long, url string, part int")
    found = urls.rules_of(spark, [("block", "org/")])
    got = sorted((tuple(r) for r in urls.filter_urls(pages, found).collect()), key=repr)
    assert len(got) == 8 and [r[3:] for r in got if r[0] == 3] == [("org/", "block")] * 2
    assert [r[1:] for r in got if r[0] == 1] == [("", "", None, "block")]
    assert [r[3:] for r in got if r[0] == 6] == [(None, "allow")]
    assert urls.filter_urls(pages.limit(0), found).count() == 0


def test_vectors_of_any_kind(spark):
    nan, inf, third = float("nan"), float("inf"), 1 / 3
    rows = [(1, [0.5, -0.5, third], 1, 0), (1, [0.5, -0.5, third], 1, 0), (None, [1.0, 2.0, 3.0], None, 1),
            (2, None, 1, 2), (3, [None, 1.0, 2.0], 1, 3), (4, [nan, 1.0, 2.0], 1, 4), (5, [1.0, -inf, 0.0], 1, 5),
            (6, [], 2, 6), (7, [1e300, -1e300, 0.0, 1.0, -1.0], 2, 7), (8, [-0.0001], None, 8)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, code int")
    got = vector_codes.compress(table, entries=4).collect()
    assert sorted(str(r.vec_id) for r in got) == ["1", "1", "6", "7", "8", "None"]
    by_id = {r.vec_id: r for r in got}
    assert [tuple(r) for r in got].count(tuple(by_id[1])) == 2  # equal rows, equal results
    assert all(len(r.code) == 8 for r in got) and by_id[7].error == 0  # a start entry of its own
    assert by_id[None].label_error == by_id[None].error + by_id[8].error  # null labels together
    assert vector_codes.compress(table.limit(0)).count() == 0
    assert vector_codes.compress(table.filter("vec_id = 4")).count() == 0


def test_pipeline_on_edges(spark, docs, edge_pairs, tmp_path):
    docs(edge_pairs, langs=["en"] * len(edge_pairs)).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(4, 1, 0), (5, 1, 0)], LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in got} <= {i for i, _ in edge_pairs}
    assert sum(r.doc_id in (4, 5) and r.start == 0 for r in got) == 1  # one of three copies stays
