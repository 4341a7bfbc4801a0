"""Each operator against a brute-force version, a round trip or held-out accuracy."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import regex
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from lakeops.llm import (
    byte_bpe, common, langid, licenses, merkle, packing, pii, quality_gam, rules, simhash, urls)
from lakeops.llm.queries import QUERIES, SQL, URL_RULES

SF = "/root/testdata/sf0.001"
RANKS, WORDS = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in common.table(spark, SF, "documents").select("doc_id", "text").collect()}


def test_registered():
    assert [n.split("_")[0] for n in sorted(QUERIES, key=lambda n: int(n[2:].split("_")[0]))] == [
        f"op{i}" for i in range(1, 14)]
    assert set(SQL) <= set(QUERIES) and len(corpus_pipeline.STAGES) == 5


# -- personal data --------------------------------------------------------------------------------

def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


FORMS = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def base_spans(text):
    out = []
    for i, (kind, form) in enumerate(zip(pii.KINDS, FORMS, strict=True)):
        for m in re.finditer(form, text):
            digits = re.sub("[^0-9]", "", m.group())
            bad = (kind == "ip" and any(int(p) > 255 for p in m.group().split("."))
                   or kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits))
                   or kind == "phone" and not 10 <= len(digits) <= 15)
            if not bad:
                out.append((m.start(), i, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(s for *_, s in sorted(out))


PRIVATE = ("1.2.3.4.5.6.7.8 a@b.c_d@e.f +1 (555) 1234567890 x 4111 1111-1111 1111 1.2.3.999 é😀 a@b.co "
           "00001.2.3.4 @x.y a@b 256.1.1.1 +123 4111111111111112")


def test_base_spans_of_personal_data(spark, docs, texts):
    rows = [*texts.items(), (10**6, PRIVATE), (10**6 + 1, PRIVATE * 300), (10**6 + 2, "9" * 20_000 + "a" * 20_000)]
    want = {i: base_spans(t) for i, t in rows}
    for r in pii.personal_data_report(docs(rows)).collect():
        assert r.base_sha256 == hashlib.sha256(want[r.doc_id].encode()).hexdigest()
        kinds = Counter(s.split(":")[0] for s in want[r.doc_id].split(",") if s)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [kinds[k] for k in pii.KINDS]


def test_telling_terms_are_found_near_their_entity(docs):
    rng = random.Random(3)
    common_words = ["river", "table", "green", "morning", "window", "paper"]
    filler = lambda n: " ".join(rng.choice(common_words) for _ in range(n))
    rows = [(i, f"{filler(20)} zanzibarov {filler(2)} z@x.org {filler(20)}") for i in range(8)]
    rows += [(100 + i, filler(60)) for i in range(60)]
    got = {r.doc_id: r for r in pii.personal_data_report(docs(rows)).collect()}
    for i, text in rows[:8]:
        at = text.index("zanzibarov")
        terms = [s for s in got[i].spans.split(",") if not s.startswith("email")]
        assert terms == [f"removed:{at}:{at + 10}"]
    assert all(got[i].spans == "" for i, _ in rows[8:])
    clean = {r.doc_id: r.text for r in pii.sanitise(docs(rows)).collect()}
    assert "zanzibarov" not in clean[0] and "[EMAIL]" in clean[0] and clean[100] == dict(rows)[100]


def slow_report(rows, reach=48, min_contexts=3, generalise_at=0.7, remove_at=0.95):
    """All spans of each row, by counting in Python."""
    near, counted = [], Counter()
    for i, text in rows:
        counted.update(w.lower() for w in regex.findall(r"\p{L}{3,}", text))
        for rank, (kind, form) in enumerate(zip(pii.KINDS, FORMS, strict=True)):
            found = list(re.finditer(form, text))
            borders = [0, *[m.end() for m in found]]
            for n, m in enumerate(found):
                if f"{kind}:{m.start()}:{m.end()}" not in base_spans(text).split(","):
                    continue
                stop = found[n + 1].start() if n + 1 < len(found) else len(text)
                before, after = text[borders[n]:m.start()][-reach - 1:], text[m.end():stop][:reach + 1]
                value = re.sub("[^0-9]", "", m.group()) if kind in ("card", "phone") else m.group().lower()
                context = (before.lower(), after.lower())
                left = regex.sub(r"^\p{L}+", "", before) if len(before) > reach else before
                right = regex.sub(r"\p{L}+$", "", after) if len(after) > reach else after
                for at, side in ((m.start() - len(left), left), (m.end(), right)):
                    near += [(i, (kind, value), context, w.group().lower(), at + w.start(), at + w.end())
                             for w in regex.finditer(r"\p{L}{3,}", side)]
    both, around = Counter((e, t) for _, e, _, t, *_ in near), Counter(e for _, e, *_ in near)
    contexts = {}
    for _, e, c, t, *_ in near:
        contexts.setdefault((e, t), set()).add(c)
    out = {i: {s: None for s in base_spans(text).split(",") if s} for i, text in rows}
    told = {}
    for i, e, _, t, start, end in near:
        prior = min(0.5, around[e] / counted.total())
        disclosed = np.log2(min(1, both[e, t] / counted[t]) / prior) / -np.log2(prior)
        if len(contexts[e, t]) >= min_contexts and disclosed >= generalise_at:
            told[i, start, end] = max(disclosed, told.get((i, start, end), 0))
    for (i, start, end), disclosed in told.items():
        out[i][f"{'removed' if disclosed >= remove_at else 'term'}:{start}:{end}"] = None
    order = {k: n for n, k in enumerate([*pii.KINDS, "term", "removed"])}
    key = lambda s: (int(s.split(":")[1]), min(order[s.split(":")[0]], 4), int(s.split(":")[2]))
    return {i: ",".join(sorted(spans, key=key)) for i, spans in out.items()}


def test_all_spans_equal_a_count_in_python(docs, texts):
    rng, rows = random.Random(9), list(texts.items())
    holders = [t for _, t in rows if base_spans(t) and len(t) < 3000][:5]
    for n, text in enumerate(holders):
        for k in range(6):
            words = text.split(" ")
            for _ in range(max(2, len(words) // 8)):
                words[rng.randrange(len(words))] = rng.choice(["alpha", "beta", "gammas"])
            rows.append((10_000 + 10 * n + k, " ".join(words)))
    want = slow_report(rows)
    got = {r.doc_id: r.spans for r in pii.personal_data_report(docs(rows)).collect()}
    assert got == want and sum("term:" in s or "removed:" in s for s in want.values()) > 5


def test_copies_are_one_context(docs):
    rows = [(i, "unusualword near z@x.org and more") for i in range(9)] + [(50, "and more and more near")]
    assert all(r.n_terms == 0 for r in pii.personal_data_report(docs(rows)).collect())


def test_contexts_reach_over_other_hits(docs):
    card, text = "4111 1111-1111 1111", "Zebedeus, 12 High St, 10.0.0.1, 4111 1111-1111 1111; 12 5 7 77 to a@b.co, 33 a 4 Yolanda"
    rows = [(1, text), (2, "ab 11; " * 40 + card + "; 22 cd" * 40), (3, card + " x"), (4, "ü" * 80 + " " + card + " é")]
    near = {r.doc_id: b for r in pii.find_entities(docs(rows)).collect() for b in r.base if b.kind == "card"}
    assert set(near) == {1, 2, 3, 4}
    for i, t in rows:
        assert (near[i].before, near[i].after) == (t[:near[i].start][-49:], t[near[i].end:][:49])


def test_terms_anywhere_in_the_documents_of_their_entity(docs):
    rng = random.Random(4)
    words = ["river", "table", "green", "morning", "window", "paper"]
    filler = lambda n: " ".join(rng.choice(words) for _ in range(n))
    rows = [(i, f"Quimby {filler(50)} y@x.org {filler(60)} quimby {i}") for i in range(30)]
    rows += [(40 + i, filler(80)) for i in range(400)]
    got = {r.doc_id: r for r in pii.personal_data_report(docs(rows), scope="document").collect()}
    at = rows[2][1].index("quimby")
    assert got[2].spans.startswith("removed:0:6,email:") and got[2].spans.endswith(f"removed:{at}:{at + 6}")
    assert all(got[40 + i].spans == "" for i in range(400))
    clean = {r.doc_id: r.text for r in pii.sanitise(docs(rows), scope="document").collect()}
    assert "uimby" not in clean[5] and clean[50] == dict(rows)[50]


def test_terms_of_an_entity_in_one_text(docs):
    rng = random.Random(4)
    words = ["river", "table", "green", "morning", "window", "paper"]
    filler = lambda n: " ".join(rng.choice(words) for _ in range(n))
    rows = [(1, f"Zanzibarov {filler(90)} z@x.org {filler(90)}. Zanzibarov {filler(9)}")]
    rows += [(40 + i, filler(80)) for i in range(400)] + [(900 + i, rows[0][1]) for i in range(5)]
    got = {r.doc_id: r for r in pii.personal_data_report(docs(rows), scope="document").collect()}
    at = rows[0][1].rindex("Zanzibarov")
    for i in (1, 900, 904):  # copies are one document
        assert "term:0:10,email:" in got[i].spans and got[i].spans.endswith(f"term:{at}:{at + 10}")
    assert all(got[40 + i].spans == "" for i in range(400))


def natural(n, seed, own=5):
    """Texts of words that all share, and ``own`` words each that occur nowhere else."""
    rng, letters = random.Random(seed), "abcdefghijklmnopqrstuvwxyz"
    shared = ["".join(rng.choice(letters) for _ in range(6)) for _ in range(300)]
    return [[rng.choice(shared) for _ in range(40)] + ["".join(rng.choice(letters) for _ in range(12)) for _ in range(own)]
            for _ in range(n)]


def slow_documents(rows, generalise_at=0.7, remove_at=0.95):
    """Term spans of each row in the scope of documents, counted in Python."""
    texts = dict.fromkeys(t for _, t in rows)
    words = {t: {w.lower() for w in regex.findall(r"\p{L}{3,}", t)} for t in texts}
    entities = {t: set() for t in texts}
    for t in texts:
        for s in filter(None, base_spans(t).split(",")):
            kind, a, b = s.split(":")
            value = t[int(a):int(b)]
            entities[t].add((kind, re.sub("[^0-9]", "", value) if kind in ("card", "phone") else value.lower()))
    n_term = Counter(w for t in texts for w in words[t])
    n_entity = Counter(e for t in texts for e in entities[t])
    n_both = Counter((e, w) for t in texts for e in entities[t] for w in words[t])
    bins = Counter(int(np.floor(np.log2(n) * 4)) for n in n_term.values())
    told = {}
    for (e, w), both in n_both.items():
        n, prior = n_term[w], min(0.5, n_entity[e] / len(texts))
        x = both / n
        spread = 0 if x == 1 else -(x * np.log2(x) + (1 - x) * np.log2(1 - x))
        bits = -both * np.log2(prior) - n * spread - np.log2(bins[int(np.floor(np.log2(n) * 4))])
        share = (both + 0.25 * prior) / (n + 0.25)
        if bits >= 4.4 and share >= generalise_at:
            told[e, w] = share
    out = {}
    for i, t in rows:
        best = {}
        for m in regex.finditer(r"\p{L}{3,}", t):
            shares = [told[e, m.group().lower()] for e in entities[t] if (e, m.group().lower()) in told]
            if shares:
                best[m.start()] = f"{'removed' if max(shares) >= remove_at else 'term'}:{m.start()}:{m.end()}"
        out[i] = sorted(best.values())
    return out


def test_rare_words_stay_and_names_that_return_with_an_entity_go(docs):
    rng, rows = random.Random(6), []
    for i, words in enumerate(natural(600, 1)):
        if i < 200:  # an address of its own
            words.append(f"u{i}@x.org")
        elif i < 203:
            words += ["Petrovna", "p@x.org"]
        elif i < 210:
            words += ["Quimby", "q@x.org"]
        elif i < 214:
            words += ["Everyman", f"e{i}@x.org" if i % 2 else ""]
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
    got = {r.doc_id: [s for s in r.spans.split(",") if s and not s.startswith("email")]
           for r in pii.personal_data_report(docs(rows), scope="document").collect()}
    for i, text in rows:
        name, kind = ("Petrovna", "term") if 200 <= i < 203 else ("Quimby", "removed") if 203 <= i < 210 else (None, None)
        assert got[i] == ([f"{kind}:{text.index(name)}:{text.index(name) + len(name)}"] if name else [])
    assert {i: sorted(s) for i, s in got.items()} == slow_documents(rows)


def test_document_terms_equal_a_count_in_python(docs, texts):
    rows, rng = list(texts.items()), random.Random(2)
    holders = [t for _, t in rows if base_spans(t) and len(t) < 4000][:8]
    for k, text in enumerate(holders):  # the same entities in edited texts
        for n in range(4):
            words = text.split(" ")
            for _ in range(len(words) // 6):
                words[rng.randrange(len(words))] = rng.choice(["alpha", "beta", "gammas"])
            rows.append((10_000 + 10 * k + n, " ".join(words)))
    rows += [(20_000 + i, f"footer mail a@b.org {' '.join(f'name{chr(97 + j)}' for j in range(i % 20))} end") for i in range(60)]
    got = {r.doc_id: sorted(s for s in r.spans.split(",") if s.split(":")[0] in ("term", "removed"))
           for r in pii.personal_data_report(docs(rows), scope="document").collect()}
    want = slow_documents(rows)
    assert got == want
    kinds = Counter(s.split(":")[0] for found in want.values() for s in found)
    assert kinds["term"] and kinds["removed"]


def test_running_starts(spark):
    got = spark.range(1).selectExpr("transform(sequence(1, 1000), x -> cast(x % 7 as int)) AS s").select(
        common.running_starts(F.col("s"), 16).alias("r")).first().r
    assert got == [sum(x % 7 for x in range(1, n)) for n in range(1, 1001)]


# -- quality, language ------------------------------------------------------------------------------

def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in common.table(spark, sf, "labels").collect()}
    got = [r for r in QUERIES["op2_quality"](spark, sf).collect() if r.held_out and r.doc_id in labels]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert np.mean([r.predicted == labels[r.doc_id] for r in got]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.random((3000, 3))
    y = ((x[:, 0] > 0.5) != (x[:, 1] > 0.5)).astype(float)
    model = quality_gam.fit_additive(x, y, n_pairs=1)
    assert model.pairs == [(0, 1)] and np.mean((model.score(x) >= 0.5) == y) > 0.95


def test_language_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    known = {r.doc_id: r.lang for r in common.table(spark, sf, "documents").select("doc_id", "lang").collect()}
    got = [r for r in QUERIES["op9_language"](spark, sf).collect() if r.held_out]
    assert np.mean([r.lang_pred == known[r.doc_id] for r in got]) > 0.97


@pytest.mark.parametrize("parts", [1, 2])
def test_texts_of_no_learned_language_are_dropped(spark, parts):
    own = common.table(spark, "/root/testdata/sf0.01", "documents").select(
        "doc_id", "text", F.concat("lang", (F.col("doc_id") % parts).cast("string")).alias("lang"))
    odd = ["Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw",
           "xqzj vbkp wrtq zzxk plmk qwrt bvcx kjhg fdsa mnbv", "日本語の文章です。東京は大きい町です",
           "Minä olen suomalainen ja asun Helsingissä, missä on kaunis kesä ja pitkä talvi",
           "for (int i = 0; i < n; i++) { sum += a[i] * b[i]; } return sum;"]
    planted = spark.createDataFrame([(10**7 + i, t, None) for i, t in enumerate(odd)], own.schema)
    kept = {r.doc_id for r in langid.keep_identified(own.union(planted)).select("doc_id").collect()}
    assert not {i for i in kept if i >= 10**7}
    assert len(kept) >= 0.98 * own.filter(F.col("text").rlike(r"\p{L}")).count()


def grams_of(text):
    """Hashed n-grams of each order, as sets of Python integers."""
    kept = " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())
    codes, out = [ord(c) for c in (f" {kept} " if kept else "")], []
    for n in langid.ORDERS:
        found = set()
        for i in range(len(codes) - n + 1):
            value = 0
            for c in codes[i:i + n]:
                value = (value * 1_000_003 + c) % 2**64
            found.add((value * 0x9E3779B97F4A7C15 % 2**64 >> 40) % langid.SLOTS)
        out.append(found)
    return out


def kernel(a, b):
    return np.mean([len(x & y) / np.sqrt(len(x) * len(y)) if x and y else 0.0 for x, y in zip(a, b, strict=True)])


def many_languages(n, each, seed=11):
    """(text, language) pairs; every language has its own words over the same letters."""
    rng, letters = random.Random(seed), "abcdefghijklmnopqrstuvwxyzäöüß"
    words = [["".join(rng.choice(letters) for _ in range(rng.randrange(3, 8))) for _ in range(40)] for _ in range(n)]
    return [(" ".join(rng.choice(words[k]) for _ in range(60)), f"l{k:03}") for k in range(n) for _ in range(each)]


def test_fit_and_predictions_equal_a_version_in_python(spark, docs):
    rows = [(i, t, lang) for i, (t, lang) in enumerate(many_languages(3, 16))]
    df = docs([r[:2] for r in rows], langs=[r[2] for r in rows])
    model = langid.learn_languages(df, landmarks=9)
    known = [(grams_of(t), lang) for i, t, lang in rows if zlib.crc32(str(i).encode()) % 4 != 2]
    texts = {np.packbits(langid.present(t)).tobytes(): grams_of(t) for _, t, _ in rows}
    marks = [texts[m.tobytes()] for m in model.marks]
    assert len(marks) == 9 and model.languages == ["l000", "l001", "l002"]
    gram = np.array([[kernel(a, b) for b in marks] for a in marks])
    values, vectors = np.linalg.eigh(gram)
    root = vectors / np.sqrt(values)
    z = np.array([[kernel(a, m) for m in marks] for a, _ in known]) @ root
    goal = np.array([[float(lang == name) for name in model.languages] for _, lang in known])
    w = np.array([1 / (3 * sum(other == lang for _, other in known)) for _, lang in known])[:, None]
    zc, centre = z - (w * z).sum(axis=0), (w * goal).sum(axis=0)
    solved = np.linalg.solve(zc.T @ (w * zc) + 1e-2 / len(known) * np.eye(9), zc.T @ (w * (goal - centre)))
    got = {r.doc_id: r for r in langid.identify_language(df, landmarks=9).collect()}
    for i, t, _ in rows:
        margins = (np.array([kernel(grams_of(t), m) for m in marks]) @ root - (w * z).sum(axis=0)) @ solved + centre
        assert got[i].lang_pred == model.languages[int(margins.argmax())]
        assert abs(got[i].score - 1 / np.exp(8 * (margins - margins.max())).sum()) < 1e-3
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
    for k, name in enumerate(model.languages):  # how usual a text's n-grams are among the others
        own = [g[-1] for g, lang in known if lang == name]
        shares = [np.mean([sum(s in o for o in own[:j] + own[j + 1:]) / (len(own) - 1) for s in g])
                  for j, g in enumerate(own)]
        assert abs(np.quantile(shares, langid.RARE) - model.least[k]) < 1e-4


def test_every_language_is_learned(spark, docs):
    rows = list(enumerate(many_languages(150, 8)))
    rows += [(10_000, ("qqq qqq zzz", "lonely"))]
    df = docs([(i, t) for i, (t, _) in rows], langs=[lang for _, (_, lang) in rows])
    got = {r.doc_id: r for r in langid.identify_language(df).collect()}
    learned = {lang for i, (_, lang) in rows if zlib.crc32(str(i).encode()) % 4 != 2}
    right = [got[i].lang_pred == lang for i, (_, lang) in rows if got[i].held_out and lang in learned]
    assert np.mean(right) > 0.95 and len(right) > 200


def test_partial_sums_do_not_depend_on_the_partitions(spark, docs):
    rows = [(i, t, lang) for i, (t, lang) in enumerate(many_languages(4, 12))]
    models = [langid.learn_languages(docs([r[:2] for r in rows], parts=parts, langs=[r[2] for r in rows]), landmarks=8)
              for parts in (1, 7)]
    assert models[0].marks.tolist() == models[1].marks.tolist()
    assert np.allclose(models[0].weights, models[1].weights, atol=1e-4) and np.allclose(models[0].usual, models[1].usual)


def test_kernel_is_the_mean_of_the_presence_kernels():
    a, b = "the cat sat", "the dog sat down"
    flags = np.stack([langid.present(a), langid.present(b)])
    x = langid.unit_rows(flags)
    want = np.mean([(flags[0, n] & flags[1, n]).sum() / np.sqrt(float(flags[0, n].sum()) * float(flags[1, n].sum()))
                    for n in range(len(langid.ORDERS))])
    assert abs(float(x[0] @ x[1]) - want) < 1e-5


# -- tokens ------------------------------------------------------------------------------------------

@pytest.mark.parametrize("chunk,overlap", [(400, 60), (32_768, 1_024)])
def test_bpe_equals_whole_texts(docs, texts, chunk, overlap):
    rows = [*list(texts.items())[:60], (9001, "a" * 5000), (9002, (" " * 700 + "x") * 4), (9003, "é中😀're" * 400),
            (9004, "12345 " * 300 + "b" * 900 + " end")]
    codec = byte_bpe.Codec.of(RANKS, public_tokenizers.PATTERN)
    got = byte_bpe.encode_documents(docs(rows), RANKS, public_tokenizers.PATTERN, chunk, overlap).collect()
    want = {}
    for i, t in rows:
        ids = codec.tokens.encode_ordinary(t)
        want[i] = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                   hashlib.sha256(t.encode()).hexdigest())
    assert {r.doc_id: tuple(r)[1:] for r in got} == want


def test_bpe_cut_after_whitespace(docs):
    gaps = ["\n\n", "\t\t", "\n\n\n", " \n", "\n ", "\u2003\u2003"]
    rows = [(i, ("lorem ipsum " * 40)[:398 - len(gap)] + "ab" + gap + "Gamma delta\t\tx " * 60)
            for i, gap in enumerate(gaps)]
    assert all(t[:400].endswith(gap) for (_, t), gap in zip(rows, gaps, strict=True))
    rows += [(10 + i, "x" + t) for i, t in rows]  # a cut inside the run
    codec = byte_bpe.Codec.of(RANKS, public_tokenizers.PATTERN)
    got = byte_bpe.encode_documents(docs(rows), RANKS, public_tokenizers.PATTERN, 400, 60).collect()
    want = {i: (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
            for i, t in rows for ids in [codec.tokens.encode_ordinary(t)]}
    assert {r.doc_id: (r.n_tokens, r.ids_sha256) for r in got} == want


def test_packing_is_a_partition_of_all_ids(docs, texts):
    rows = [*list(texts.items())[:80], (9001, "word " * 9000), (9002, "ΣΑΣ. don't it's,.. 3.14%% ﬁ <|endoftext|>"), (9003, "")]
    tokenizer = Tokenizer.from_file(WORDS)
    tokenizer.encode_special_tokens = True
    want = {i: np.array([*tokenizer.encode(t, add_special_tokens=False).ids, packing.END_ID], "<u4") for i, t in rows}
    pieces = packing.pack(docs(rows), WORDS).collect()
    for i, ids in want.items():
        own = sorted((p for p in pieces if p.doc_id == i), key=lambda p: p.start)
        assert [p.start for p in own] == list(np.cumsum([0, *[p.length for p in own]])[:-1])
        assert sum(p.length for p in own) == len(ids) == own[0].doc_tokens
        assert all(p.ids_crc32 == zlib.crc32(ids[p.start:p.start + p.length].tobytes()) for p in own)
    by_sequence = {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == by_sequence.get(p.sequence_id, 0)
        by_sequence[p.sequence_id] = p.offset + p.length
    assert all(size <= 2048 and size & (size - 1) == 0 for size in by_sequence.values())


def test_hilbert_curve_visits_neighbours():
    cells = np.array(np.meshgrid(*[np.arange(8)] * 3, indexing="ij")).reshape(3, -1).T
    keys = packing.hilbert_key(cells, 3)
    assert sorted(keys) == list(range(512))
    assert np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1).max() == 1


# -- licenses, rules ---------------------------------------------------------------------------------

def test_exact_phrases(texts):
    scanner = licenses.Scanner()
    for text in [*texts.values(), "cc by cc-by CC BY! all rights  reserved all rights reserved"]:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text))
        base = sorted((i, label) for phrase, label in licenses.PHRASES for i in range(len(words))
                      if words[i:i + len(phrase.split())] == phrase.split())
        got = licenses.scan(scanner, text)
        assert (got["n_words"], got["n_base"], got["base_labels"]) == (
            len(words), len(base), ",".join(sorted({label for _, label in base})))
        assert (got["first_word"], got["last_word"]) == ((base[0][0], base[-1][0]) if base else (None, None))


def test_many_near_copies_of_a_notice_in_one_text():
    """Work grows with the text: 20,000 near copies, 600,000 characters, in seconds (it took hours)."""
    scanner, start = licenses.Scanner(), time.time()
    got = licenses.scan(scanner, "released under the mit licnse " * 20_000)
    assert len(got["notices"]) == 20_000 and got["labels"] == "mit" and time.time() - start < 60
    assert [(n["start"], n["end"]) for n in got["notices"][:2]] == [(0, 5), (5, 10)]
    few = licenses.scan(scanner, "x " * 300 + "released under the mit licnse released under the mit license " + "y " * 300)
    assert [(n["start"], n["end"], n["score"] == 1) for n in few["notices"]] == [(300, 305, False), (305, 310, True)]


def test_seeds_lose_no_notice_within_the_error_bound():
    scanner, rng = licenses.Scanner(), random.Random(5)
    for notice in scanner.notices:
        for _ in range(30):
            letters = list(notice.text)
            for _ in range(rng.randint(0, notice.errors)):
                at = rng.randrange(1, len(letters) - 1)
                letters[at] = rng.choice(["", "q", letters[at] + "q"])
            line = licenses.read_words("some words " + "".join(letters) + " and more")
            direct = notice.pattern.search(line)
            if direct:
                assert notice.label in {label for *_, label, _ in scanner.find(line)}


def test_fuzzy_notice_reports_its_words():
    got = licenses.scan(licenses.Scanner(), "Foo. Licenced under the Apache Licence, Version 2")
    assert got["labels"] == "apache" and (got["notices"][0]["start"], got["notices"][0]["end"]) == (1, 6)
    assert got["n_base"] == 0 and 0.8 < got["score"] < 1


def test_near_copies_of_a_notice_in_a_row():
    good, bad = "released under the mit license", "released under the mit licnse"
    for parts in ([bad, good], [good, bad], [bad, bad, good, bad], [bad, "x", good]):
        line = f" {' '.join(parts)} "
        found = [line[a:b] for a, b, label, _ in licenses.Scanner().find(line) if label == "mit"]
        assert found == [p for p in parts if p != "x"]


def test_ablation_counts(spark, docs, texts):
    rows = rules.ledger(docs(list(texts.items())))
    bits = [r.failed for r in rows.collect()]
    policy = rules.STRICT
    for r in rules.ablation(rows, (rules.BASE, policy)).collect():
        mask = (rules.BASE if r.policy == "base" else policy).mask()
        bit = 1 << [x.name for x in rules.RULES].index(r.rule)
        assert r.kept == sum(b & mask == 0 for b in bits) and r.failing == sum(b & bit > 0 for b in bits)
        assert r.only_this_rule == sum(b & mask == bit for b in bits)
        assert r.kept_without == sum(b & mask & ~bit == 0 for b in bits)


def test_ablation_of_nothing(docs):
    got = rules.ablation(rules.ledger(docs([])), (rules.BASE,)).collect()
    assert [(r.rule, r.kept, r.failing, r.kept_without) for r in sorted(got)] == [
        ("few_words", 0, 0, 0), ("repeated_words", 0, 0, 0)]


# -- urls --------------------------------------------------------------------------------------------

def verdict(url, given):
    host = path = ""
    if url and "://" in url:
        m = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1])
        host, path = re.sub("[A-Z]", lambda c: c.group().lower(), m[1]), m[2]
    fits = []
    for action, rule in given:
        own, _, rest = rule.partition("/")
        if (host == own or host.endswith("." + own)) and path.startswith("/" + rest):
            fits.append((-len(rule), -len(own), rule, action))
    return (host, path, *(min(fits)[2:] if fits else (None, "allow" if host else "block")))


@pytest.mark.parametrize("ranges", [1, 7, 60])
def test_url_rules(spark, ranges):
    given = [*URL_RULES, ("block", "a.example.com/"), ("allow", "b.a.example.com/x/"), ("block", "net/"),
             ("allow", "example.com/"), ("block", "com/de/x/yyyyyyyyyyyyyyy")]
    rng = random.Random(1)
    hosts = ["", "org", ".org", "org.", "a..org", "EXAMPLE.org", "xexample.org", "a.example.com", "b.a.example.com",
             "c.b.a.example.com", "com", "é.example.net", "a.example.com:80", *["hot.example.net"] * 12]
    paths = ["", "/", "/es/1", "/fr/", "/en/1", "/en/12?x", "#a", "?q=http://a.org/", "/de/x/yyyyyyyyyyyyyyy/1", "/x/y"]
    rows = [(i, rng.choice(["http://", "X://", "://", ""]) + rng.choice(hosts) + rng.choice(paths)) for i in range(800)]
    got = urls.filter_urls(spark.createDataFrame(rows, "page_id long, url string").repartition(4),
                           urls.rules_of(spark, given), ranges).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr((i, *verdict(u, given))) for i, u in rows)


# -- near duplicates ---------------------------------------------------------------------------------

def slow_simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_values(texts):
    for text in [*list(texts.values())[:40], "", "One", "one  TWO", "É\x85x y z"]:
        assert simhash.simhash(text) == slow_simhash(text)


def clusters(points, limit=2):
    root = {p: p for p in points}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    ordered = sorted(points)
    for i, a in enumerate(ordered):
        for b in ordered[i + 1:]:
            if (a ^ b).bit_count() <= limit:
                root[find(b)] = find(a)
    return {p: find(p) for p in points}


@pytest.mark.parametrize("max_bucket", [1, 3, 200])
def test_components_of_near_fingerprints(spark, max_bucket):
    rng = random.Random(2)
    points = set()
    for _ in range(12):
        at = rng.getrandbits(64)
        for _ in range(25):
            points.add(at)
            if rng.random() < 0.8:
                at ^= 1 << rng.randrange(64)
            if rng.random() < 0.8:
                at ^= 1 << rng.randrange(64)
            if rng.random() < 0.2:
                at ^= 7 << rng.randrange(60)
    signed = {simhash._signed(p): p for p in points}
    rows = [(i, s) for i, s in enumerate(sorted(signed))] + [(1000, min(signed)), (None, min(signed))]
    found = spark.createDataFrame(rows, "doc_id long, fp long").repartition(3)
    got = {r.fp: r.component_id for r in simhash.group_members(found, max_bucket=max_bucket).collect()}
    parts = clusters(points)
    ids = dict((s, i) for i, s in rows[:len(signed)])
    first = {}
    for s, p in signed.items():
        first[parts[p]] = min(first.get(parts[p], 10**9), ids[s])
    assert got == {s: first[parts[p]] for s, p in signed.items()}


def test_near_copies_of_documents(docs, texts):
    # Long texts with one word more share most shingles: some of them come within two bits.
    near = {10_000 + i: f"{t} {'extra' if i % 2 else 'more'}" for i, t in texts.items() if len(t) > 1500}
    assert sum(0 < (slow_simhash(t) ^ slow_simhash(texts[i - 10_000])).bit_count() <= 2 for i, t in near.items()) > 5
    texts = texts | near
    rows = list(texts.items())
    parts = clusters({slow_simhash(t) for _, t in rows})
    first = {}
    for i, t in rows:
        root = parts[slow_simhash(t)]
        first[root] = min(first.get(root, 10**9), i)
    for r in simhash.near_copies(docs(rows)).collect():
        assert r.fingerprint == f"{slow_simhash(texts[r.doc_id]):016x}"
        assert r.component_id == first[parts[slow_simhash(texts[r.doc_id])]]
    kept = simhash.keep_one_of_each(docs(rows)).collect()
    assert sorted(r.doc_id for r in kept) == sorted(first.values())


# -- fingerprints ------------------------------------------------------------------------------------

@pytest.mark.parametrize("ranges", [1, 4, 30])
def test_each_document_meets_its_successor(docs, texts, ranges):
    rows = sorted([*texts.items(), (-5, None), (5000, ""), (5001, "x"), (5002, "z" * 1000)])
    want = []
    for k, (i, text) in enumerate(rows):
        text, other = text or "", rows[(k + 1) % len(rows)][1] or ""
        size = len(text) // 4
        edited = text[:len(text) - size] + other[:size]
        trees = [merkle.Tree(t) for t in (text, edited, other)]
        want.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), trees[0].root.hex(), trees[1].root.hex(),
                     merkle.likeness(trees[0], trees[1]), merkle.likeness(trees[0], trees[2])))
    assert sorted(map(tuple, merkle.compare_with_next(docs(rows), ranges).collect())) == want
    long = [w for w in want if w[1] > 400]
    assert np.mean([w[5] for w in long]) > 0.7 and np.mean([w[6] for w in long]) < 0.1


def test_roots_and_edits(docs):
    a = "# T\none two three four five six\nseven eight\n\n# U\nnine ten\n" + "x" * 500
    b = a.replace("ten", "TEN")
    trees = [merkle.Tree(t).nodes() for t in (a, b)]
    assert trees[0].digest != trees[1].digest and merkle.edits(trees[0], trees[0]) == []
    (start, end), = merkle.edits(*trees)
    assert "TEN" in b[start:end] and end - start < 10
    got = merkle.locate_edits(docs([(1, a), (2, a)]), docs([(1, b), (2, a)])).collect()
    assert [(r.doc_id, [(e.start, e.end) for e in r.edits]) for r in got] == [(1, [(start, end)])]


def test_pipeline_equals_its_stages(spark, texts):
    """The packed documents are those that every stage, run by hand, keeps."""
    docs = common.table(spark, SF, "documents")
    labels = common.table(spark, SF, "labels")
    good = {r.doc_id for r in quality_gam.keep_good(docs, labels).select("doc_id").collect()}
    lang = {r.doc_id for r in langid.keep_identified(docs.filter(docs.doc_id.isin(list(good)))).select("doc_id").collect()}
    parts = clusters({slow_simhash(texts[i]) for i in lang})
    first = {}
    for i in sorted(lang):
        first.setdefault(parts[slow_simhash(texts[i])], i)
    assert {r.doc_id for r in corpus_pipeline.run(spark, SF).collect()} == set(first.values())
    bad = {r.doc_id for r in labels.collect() if r.quality == 0}
    assert len(good & bad) <= 0.1 * len(bad) and len(good - bad) >= 0.95 * (len(texts) - len(bad) * 2.5)
