"""Vector codes, fill-in-the-middle and the word lexicon against brute force, libraries and round trips."""

import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakeops.llm import common, infilling, lexicon_bpe, vector_codes
from lakeops.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")


# -- vector codes ---------------------------------------------------------------------------------

def slow_codes(rows, parts=4, entries=256, rounds=4):
    """(codes, error, label_error) by id, and all final entries, in Python integers."""
    def floor(x):
        n, d = float(x).as_integer_ratio()
        return n * 1024 // d

    kept = sorted((i, [floor(x) for x in v], label) for i, v, label in rows)
    size = len(kept[0][1]) // parts
    cut = {i: [v[p * size:(p + 1) * size] for p in range(parts)] for i, v, _ in kept}
    books = [[cut[i][p] for i, *_ in kept[:entries]] for p in range(parts)]

    def near(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        new = []
        for p, book in enumerate(books):
            members = [[] for _ in book]
            for i in cut:
                members[near(cut[i][p], book)[1]].append(cut[i][p])
            new.append([[sum(c) // len(m) for c in zip(*m, strict=True)] if m else e
                        for m, e in zip(members, book, strict=True)])
        books = new
    found = {i: [near(cut[i][p], books[p]) for p in range(parts)] for i in cut}
    error = {i: sum(d for d, _ in f) for i, f in found.items()}
    by_label = {}
    for i, _, label in kept:
        by_label[label] = by_label.get(label, 0) + error[i]
    return {i: ("".join(f"{k:02x}" for _, k in found[i]), error[i], by_label[label]) for i, _, label in kept}, [
        str(c) for book in books for e in book for c in e]


@pytest.mark.parametrize("scale", [0.2, 50.0, 3e5, 1e11])  # 2, 4 and 8 bytes; floats, longs, Python integers
def test_codes_equal_a_count_in_python(spark, scale):
    rng = random.Random(5)
    centres = [[rng.gauss(0, scale) for _ in range(8)] for _ in range(4)]
    rows = [(i, [round(c, 1) if rng.random() < 0.5 else rng.gauss(c, scale / 9) for c in rng.choice(centres)],
             rng.choice([1, 2, None])) for i in range(150)]
    rows += [(1000 + i, rows[7][1], 2) for i in range(60)]  # a hot vector
    rng.shuffle(rows)
    got = vector_codes.compress(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
                                .repartition(5), entries=12).collect()
    want, entries = slow_codes(rows, entries=12)
    long = lambda n: n if n < 1 << 63 else None
    assert {r.vec_id: (r.code, r.error) for r in got} == {i: (c, long(e)) for i, (c, e, _) in want.items()}
    if scale < 1e6:
        assert {r.vec_id: r.label_error for r in got} == {i: long(e) for i, (*_, e) in want.items()}
    assert {r.codebooks_sha256 for r in got} == {hashlib.sha256(",".join(entries).encode()).hexdigest()}


def test_trie_shares_prefixes_and_agrees_with_a_plain_search():
    rng = np.random.default_rng(1)
    for kind, high in ((3, 4), (6, 3), (1, 9)):
        parts = rng.integers(-high, high, (3000, kind))
        parts = np.unique(parts, axis=0)
        book = rng.integers(-high, high, (40, kind))
        far = ((parts[:, None, :] - book[None]) ** 2).sum(axis=2)
        for largest in (high, 1 << 28, 1 << 40):
            codes, errors = vector_codes.assign(parts, book, largest)
            assert codes.tolist() == far.argmin(axis=1).tolist()
            assert list(map(int, errors)) == far.min(axis=1).tolist()


def test_keys_sort_like_parts():
    rng = np.random.default_rng(2)
    for width, top in ((2, 1 << 15), (4, 1 << 31), (8, 1 << 53)):
        parts = rng.integers(-top, top, (200, 3))
        parts[:3] = [[-top, 0, top - 1], [0, 0, 0], [-1, 1, -1]]
        keys = [k.tobytes() for k in vector_codes.to_keys(parts, width)]
        assert vector_codes.from_keys(keys, width).tolist() == parts.tolist()
        assert sorted(range(200), key=keys.__getitem__) == sorted(range(200), key=parts.tolist().__getitem__)


# -- fill-in-the-middle ---------------------------------------------------------------------------

def kinds_of(units):
    return {kind for _, kind, *_ in units.containers}


def test_select_over_every_kind_of_container():
    rng = np.random.default_rng(3)
    w = infilling.WIDTH
    sparse, dense = rng.choice(w, 900, replace=False), w + rng.choice(w, 30_000, replace=False)
    runs = np.concatenate([4 * w + np.arange(100, 60_000), 4 * w + np.arange(60_001, w)])
    offsets = np.sort(np.concatenate([sparse, dense, runs, [7 * w, 9 * w - 1]]))
    units = infilling.BoundarySet(offsets)
    assert kinds_of(units) == {infilling.ARRAY, infilling.BITMAP, infilling.RUNS} and len(units) == len(offsets)
    assert [units.select(k) for k in range(len(units))] == offsets.tolist()
    with pytest.raises(IndexError):
        units.select(len(units))


def slow_infilling(doc_id, text, seed=1):
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in infilling.MARKS) or h[2] % 100 >= 90:
        return len(units), "plain", None, None, text
    if h[3] % 100 < 20:
        return len(units), "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return len(units), "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def test_infilling_equals_a_version_in_python(docs):
    rng = random.Random(4)
    rows = [(i, "".join(rng.choice(["ab", "Z", " ", "<", "<S", "P>", "M", ">", "é", "😀", "\n", "中"])
                        for _ in range(rng.randrange(40)))) for i in range(400)]
    rows += [(1000, None), (1001, "<P>"), (1002, "a" * 200_000), (1003, "a b" * 100_000), (None, "no id here"),
             (1004, "Ab é " * 70_000 + "x" * 70_000)]
    got = infilling.rearrange(docs(rows)).withColumn("back", infilling.restored(F.col("output"), F.col("form")))
    found = {r.doc_id: r for r in got.collect()}
    assert len(found) == len(rows)
    for i, text in rows:
        r = found[i]
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == slow_infilling(i, text or "")
        assert r.back == (text or "")
    assert {r.form for r in found.values()} == {"plain", "psm", "spm"}


def test_marks_that_could_arise_at_a_border_are_refused(docs):
    for marks in (("<P>", "<P>", "<M>"), ("<<P>", "<S>", "<M>"), ("<", "<S>", "<M>"), ("", "a", "b")):
        with pytest.raises(ValueError):
            infilling.rearrange(docs([(1, "x")]), marks=marks)


# -- lexicon --------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_ids_and_texts_equal_the_library(spark, library):
    """Whole texts of the given table, through the registered query."""
    texts = {r.doc_id: r.text or "" for r in common.table(spark, SF, "documents").collect()}
    got = QUERIES["op13_lexicon_bpe"](spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        back = library.decode(ids, skip_special_tokens=False)
        assert r.decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()


PIECES = ["a", "the", " the", "ing", "é", "t'", "'s", "'S", "'ll", " ", "  ", "\n", "\t", "\x1c", "\x85", "12", "½", "中文",
          "՘", "\U00031350", "😀", "<|endoftext|>", "<|endof", "!", "...", "\u3000", "_", "\0", "\u200b", "ſ"]


@pytest.mark.parametrize("words", [0, 40, 5000])
def test_random_texts_whatever_the_lexicon_holds(docs, library, words):
    rng = random.Random(words)
    rows = [(i, "".join(rng.choice(PIECES) for _ in range(rng.randrange(30)))) for i in range(800)]
    rows += [(9000, "a" * 70_000), (9001, "the end of it, " * 30_000), (9002, None), (9003, " \n" * 50_000)]
    coded = lexicon_bpe.encode_texts(docs(rows), PATH, words)
    got = {r.doc_id: r for r in coded.withColumn("back", lexicon_bpe.decoded("ids", PATH)).collect()}
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(got[i].ids, "<u4").tolist() == ids, text[:80]
        assert got[i].back == library.decode(ids, skip_special_tokens=False) == (text or "")


def test_ids_that_are_no_text_decode_like_the_library(spark, library):
    rng = random.Random(6)
    rows = [[rng.randrange(50_257) for _ in range(rng.randrange(9))] for _ in range(300)]
    df = spark.createDataFrame([(k, bytearray(np.array(ids, "<u4").tobytes())) for k, ids in enumerate(rows)],
                               "k int, ids binary")
    got = {r.k: r.back for r in df.withColumn("back", lexicon_bpe.decoded("ids", PATH)).collect()}
    assert got == {k: library.decode(ids, skip_special_tokens=False) for k, ids in enumerate(rows)}


def test_both_ways_to_merge_agree():
    vocabulary, rng = lexicon_bpe.Vocabulary.of(PATH), random.Random(2)
    words = [bytes(rng.choice(b"aaaeeetthing the\xc3\xa9") for _ in range(rng.randrange(0, 60))) for _ in range(3000)]
    got = vocabulary.merge(words)
    assert [np.frombuffer(b, "<u4").tolist() for b in got] == [vocabulary._merge_long(w) for w in words]
    assert vocabulary.merge([]) == [] and vocabulary.merge([b""]) == [b""]


def test_automaton_is_minimal_and_finds_every_word(tmp_path):
    words = sorted({a + b + c for a in (b"", b"re", b"un") for b in (b"do", b"make", b"tie") for c in (b"", b"s", b"ing")})
    (tmp_path / "x").write_bytes(lexicon_bpe.compile_lexicon(words, [np.array([k, k + 1], "<u4").tobytes() for k in range(len(words))]))
    lexicon = lexicon_bpe.Lexicon(str(tmp_path / "x"))
    assert lexicon.places(words).tolist() == list(range(len(words)))
    others = [b"", b"r", b"re", b"redos!", b"doin", b"doings", b"\xff", b"make" * 40]
    assert lexicon.places(others).tolist() == [-1] * len(others)
    assert [np.frombuffer(b, "<u4").tolist() for b in lexicon.ids_at(np.array([5, 0]))] == [[5, 6], [0, 1]]
    # States by right language: as many as the automaton has.
    languages = {tuple(sorted(w[len(p):] for w in words if w.startswith(p)))
                 for w in words for p in (w[:k] for k in range(len(w) + 1))}
    assert len(lexicon.final) == len(languages)
    with pytest.raises(ValueError):
        lexicon_bpe.compile_lexicon([b"b", b"a"], [b"", b""])


def test_frequent_words_fit_the_lexicon(spark):
    rng = random.Random(8)
    counted = spark.createDataFrame([(f"w{k}", rng.randrange(1, 1 << rng.randrange(1, 20))) for k in range(3000)], "word string, n long")
    counts = sorted((r.n for r in counted.collect()), reverse=True)
    for words in (0, 1, 50, 900, 2999, 3000, 9999):
        got = sorted((r.n for r in lexicon_bpe.frequent_words(counted, words).collect()), reverse=True)
        assert got == counts[:len(got)] and len(got) <= words and (len(got) == 3000 or words < 3000)
        assert words < 50 or len(got) > 0.6 * min(words, 3000)


def test_words_are_counted_over_all_texts(docs):
    splitter = lexicon_bpe.Splitter(None, "")
    rows = [(i, "same words in each text " + chr(97 + i) * 60) for i in range(20)] + [(50, None)]
    got = {r.word: r.n for r in lexicon_bpe.count_words(docs(rows), splitter).collect()}
    assert got == dict.fromkeys(["same", " words", " in", " each", " text"], 20)  # no word of 61 bytes
