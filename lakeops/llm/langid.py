"""Language identification with a blended-spectrum string kernel.

Two texts are compared by the n-grams (one to three characters) that occur in both: each text is
the 0/1 vector of the hashed n-grams present in it, and the kernel is the product of two such vectors
divided by their lengths, one kernel for each n, averaged. The Nyström method replaces the kernel by
its values against a few landmark texts, on which a ridge regression per language (one against
the rest) is solved. Scoring is two matrix products per batch of documents.

Whether a text is in a learned language at all is decided apart from which one fits best, by how
usual its longest n-grams are there: the mean, over the n-grams in it, of the share of the language's
sample that has them. Texts of the sample are measured against the others, and a text below the
``RARE`` quantile of every language is in none of them. Each quantile depends on one language's
sample only, not on the number of languages.

Learning reads about ``per_language`` texts of each language (a share by id hash, fixed by the language's number
of texts), every labelled language among them. Only the landmarks (``landmarks``, or ``PER_CLASS`` for each
language if that is more) and sums over the sample reach the driver: the normal equations of the regression
and how many texts have each n-gram. Tasks add these up, and solving costs the driver as much as the
landmarks do. Predictions read whole texts of all rows.

Defined results: null texts and texts without a letter are ``und`` with score 0. If nothing can be
learned, every text is ``und``. Repeated rows get equal results; ties go to the
alphabetically first language. A language with a single text in the sample, whose usual n-grams can't be measured
against others, takes the mean threshold of the other languages (0 if there is none).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeops.llm.common import held_out, in_slices
from lakeops.session import settle

ORDERS = (1, 2, 3)
SLOTS = 4096  # hashed n-grams of each order
PER_CLASS = 2  # landmarks of each language at least
BLOCK = 1 << 16  # numbers of a partial sum that travel as one row
RARE = 0.005  # share of a language's own sample that counts as none of the learned languages
LETTER = r"(?s).*\p{L}.*"


def present(text: str) -> np.ndarray:
    """Which hashed n-grams occur: a 0/1 row of ``SLOTS`` entries for each n."""
    out = np.zeros((len(ORDERS), SLOTS), np.uint8)
    kept = " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split()) \
        if not text.isascii() else " ".join(text.lower().translate(_NOT_LETTERS).split())
    if not kept:
        return out
    codes = np.frombuffer(f" {kept} ".encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    value = np.zeros(len(codes), np.uint64)
    for row, n in enumerate(ORDERS):
        value = value[:len(codes) - n + 1] * np.uint64(1_000_003) + codes[n - 1:]
        mixed = (value * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
        out[row, mixed % np.uint64(SLOTS)] = 1
    return out


_NOT_LETTERS = {i: " " for i in range(128) if not chr(i).isalpha()}


def unit_rows(flags: np.ndarray) -> np.ndarray:
    """Texts x (orders * slots), scaled so that a product of two rows is the mean kernel."""
    x = flags.astype(np.float32)
    norm = np.sqrt(x.sum(axis=2, keepdims=True))
    x /= np.where(norm > 0, norm, 1) * np.float32(np.sqrt(len(ORDERS)))
    return x.reshape(len(x), -1)


@dataclass
class KernelModel:
    languages: list[str]
    marks: np.ndarray    # landmarks x bytes: their 0/1 vectors, packed
    weights: np.ndarray  # landmarks x languages
    bias: np.ndarray
    usual: np.ndarray    # languages x slots: share of the sample that has an n-gram of the last order
    least: np.ndarray    # by language: how usual the n-grams of a text must be

    @cached_property
    def landmarks(self) -> np.ndarray:
        return unit_rows(unpack(self.marks))

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "landmarks"}

    def margins(self, x: np.ndarray) -> np.ndarray:
        return (x @ self.landmarks.T) @ self.weights + self.bias

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the best language, and its share after a softmax of the margins."""
        m = self.margins(x)
        best = m.argmax(axis=1)
        e = np.exp(8 * (m - m.max(axis=1, keepdims=True)))
        return best, (e / e.sum(axis=1, keepdims=True))[np.arange(len(m)), best]

    def is_learned(self, x: np.ndarray) -> np.ndarray:
        """Whether each text is usual enough for some language, rather than in none."""
        return (usualness(longest(x), self.usual) >= self.least).any(axis=1)


def unpack(bits: np.ndarray) -> np.ndarray:
    """Texts x orders x slots, 0/1, from packed rows."""
    return np.unpackbits(bits, axis=1).reshape(len(bits), len(ORDERS), SLOTS)


def longest(x: np.ndarray) -> np.ndarray:
    """Which n-grams of the last order occur, from unit rows."""
    return x[:, -SLOTS:] > 0


def usualness(has: np.ndarray, usual: np.ndarray) -> np.ndarray:
    """Mean share of the n-grams of each text, for each language."""
    has = has.astype(np.float32)
    return (has @ usual.T) / np.maximum(has.sum(axis=1, keepdims=True), 1)


def solve_kernel(marks: np.ndarray, grams: np.ndarray, mean: np.ndarray, goals: np.ndarray, rows: int,
                 ridge: float = 1e-2) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias of a ridge regression per language on Nyström features.

    ``grams``, ``mean`` and ``goals`` are sums over the sample of k k', k and k y', where k are a text's kernel values
    against the landmarks and y its language; every language weighs the same, all together 1.
    """
    x = unit_rows(unpack(marks))
    values, vectors = np.linalg.eigh((x @ x.T).astype(np.float64))
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    mean, centre = mean @ root, np.full(goals.shape[1], 1 / goals.shape[1])
    spread = root.T @ grams @ root - np.outer(mean, mean)
    solved = np.linalg.solve(spread + ridge / rows * np.eye(len(spread)),
                             root.T @ goals - np.outer(mean, centre))
    return (root @ solved).astype(np.float32), (centre - mean @ solved).astype(np.float32)


def _packed(batch: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("bits").to_pylist()), np.uint8).reshape(batch.num_rows, -1)


def _in_blocks(whole: np.ndarray) -> pa.RecordBatch:
    parts = [whole[a:a + BLOCK] for a in range(0, len(whole), BLOCK)]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.arange(len(parts), dtype=np.int32)), pa.array([p.tobytes() for p in parts], pa.binary())],
        ["block", "body"])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of the same block added up; a task holds one sum per block."""
    sums: dict[int, np.ndarray] = {}
    for batch in in_slices(batches, 16):
        for block, body in zip(batch.column("block").to_pylist(), batch.column("body").to_pylist(), strict=True):
            part = np.frombuffer(body, np.float64)
            sums[block] = sums[block] + part if block in sums else part
    for block, part in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([part.tobytes()], pa.binary())],
                                         ["block", "body"])


def learn_languages(docs: DataFrame, per_language: int = 800, landmarks: int = 160) -> KernelModel | None:
    """Fit on known languages outside the held-out quarter."""
    known = (docs.select("doc_id", "lang", "text")
             .filter(F.col("lang").isNotNull() & ~held_out(F.col("doc_id"), 4, 2)))
    sizes = known.filter(F.col("text").rlike(r"\p{L}")).groupBy("lang").count()
    # A share of each language by the hash of the id: no group in one task.
    scale = 1 << 30
    shares = sizes.select(F.col("lang").alias("l"), F.least(F.lit(scale), F.ceil(
        F.lit(scale * per_language) / F.col("count"))).alias("share"))
    spot = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(scale))
    # One row a language, which the model holds thousands of numbers for: small enough to broadcast.
    rows = (known.withColumn("spot", spot)
            .join(F.broadcast(shares), (F.col("lang") == F.col("l")) & (F.col("spot") < F.col("share")))
            .filter(F.col("text").rlike(r"\p{L}")).select("lang", "text"))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_slices(batches):
            bits = [np.packbits(present(t)).tobytes() for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("lang"), pa.array(bits, pa.binary())], ["lang", "bits"])

    sample = settle(rows.mapInArrow(vectors, "lang string, bits binary"), "language-sample")
    counts = {r["lang"]: r["count"] for r in sample.groupBy("lang").count().collect()}
    if not counts:
        return None
    languages = sorted(counts)
    turn = Window.partitionBy("lang").orderBy(F.xxhash64("bits"), "bits")
    first = (sample.distinct().withColumn("turn", F.row_number().over(turn))
             .filter(F.col("turn") <= landmarks).orderBy("turn", "lang")
             .limit(max(landmarks, PER_CLASS * len(languages))))
    marks = np.frombuffer(b"".join(r["bits"] for r in first.collect()), np.uint8).reshape(-1, len(ORDERS) * SLOTS // 8)
    m, n_languages, place = len(marks), len(languages), {lang: k for k, lang in enumerate(languages)}
    total = m * m + m + m * n_languages + n_languages * SLOTS

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole, against = np.zeros(total), unit_rows(unpack(marks)).T
        grams, mean, goals, has = np.split(whole, np.cumsum([m * m, m, m * n_languages]))
        grams, goals = grams.reshape(m, m), goals.reshape(m, n_languages)
        has = has.reshape(n_languages, SLOTS)
        for batch in in_slices(batches, 128):
            x = unit_rows(unpack(_packed(batch)))
            names = batch.column("lang").to_pylist()
            y = np.array([place[lang] for lang in names])
            k = (x @ against).astype(np.float64)
            weighted = k / np.array([counts[lang] * n_languages for lang in names])[:, None]
            grams += k.T @ weighted
            mean += weighted.sum(axis=0)
            np.add.at(goals.T, y, weighted)
            np.add.at(has, y, longest(x))
        yield _in_blocks(whole)

    added = (sample.mapInArrow(sums, "block int, body binary").repartition("block")
             .mapInArrow(_added, "block int, body binary").collect())
    whole = np.concatenate([np.frombuffer(r["body"], np.float64) for r in sorted(added, key=lambda r: r["block"])])
    grams, mean, goals, has = np.split(whole, np.cumsum([m * m, m, m * n_languages]))
    weights, bias = solve_kernel(marks, grams.reshape(m, m), mean, goals.reshape(m, n_languages), sum(counts.values()))
    sizes_of = np.array([counts[lang] for lang in languages])
    usual = (has.reshape(n_languages, SLOTS) / sizes_of[:, None]).astype(np.float32)

    def against_others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, 128):
            y = np.array([place[lang] for lang in batch.column("lang").to_pylist()])
            flags = unpack(_packed(batch))[:, -1] > 0
            share, n = usualness(flags, usual)[np.arange(len(y)), y], sizes_of[y]
            share = (n * share - 1) / np.maximum(n - 1, 1)  # a text has all its own n-grams
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(share, pa.float64())], ["lang", "share"])

    low = {r["lang"]: r["low"] for r in sample.mapInArrow(against_others, "lang string, share double")
           .groupBy("lang").agg(F.percentile("share", F.lit(RARE)).alias("low")).collect() if counts[r["lang"]] > 1}
    alone = float(np.mean(list(low.values()))) if low else 0.0
    least = np.array([low.get(lang, alone) for lang in languages], np.float32)
    return KernelModel(languages, marks, weights, bias, usual, least)


def language_of(model: KernelModel | None):
    """A function of a text column that gives (lang, score, learned)."""
    @F.arrow_udf("lang string, score double, learned boolean")
    def predict(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for chunk in texts:
            langs, scores, learned = [], [], []
            for start in range(0, len(chunk), 128):
                part = [t or "" for t in chunk.slice(start, 128).to_pylist()]
                flags = np.stack([present(t) for t in part])
                named = flags.any(axis=(1, 2))
                if model is None:
                    best, score, own = np.zeros(len(part), int), np.zeros(len(part)), np.zeros(len(part), bool)
                else:
                    x = unit_rows(flags)
                    best, score = model.predict(x)
                    own = model.is_learned(x)
                for k, ok in enumerate(named):
                    ok = ok and model is not None
                    langs.append(model.languages[best[k]] if ok else "und")
                    scores.append(float(min(1.0, score[k])) if ok else 0.0)
                    learned.append(bool(ok and own[k]))
            yield pa.StructArray.from_arrays(
                [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(learned, pa.bool_())],
                ["lang", "score", "learned"])
    return predict


def identify_language(docs: DataFrame, **limits: int) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score."""
    predict = language_of(learn_languages(docs, **limits)).asNondeterministic()
    return (docs.select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"),
                        predict("text").alias("_llm_guess"))
            .select("doc_id", "held_out", F.col("_llm_guess.lang").alias("lang_pred"),
                    F.col("_llm_guess.score").alias("score")))


def keep_identified(docs: DataFrame, **limits: int) -> DataFrame:
    """The rows of ``docs`` in one of the learned languages, with all their columns."""
    predict = language_of(learn_languages(docs, **limits))
    return docs.filter(predict("text")["learned"])
