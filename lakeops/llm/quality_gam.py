"""Quality classifier: a generalised additive model with pairwise interactions.

Every feature has a lookup table over its bins, and a few pairs of features have a table over a
coarse grid. The tables are learned by cyclic gradient boosting: feature after feature, a tree of at
most four leaves (for pairs: one cut on each axis) is fitted to the gradients summed per bin, and a
fraction of it is added to the table. Scoring a document is one addition per table, done for a
whole batch at once.

The features see the text alone. Learning takes at most ``max_rows`` labelled rows, the first by a
hash of their id; everything else reads all rows.

Defined results: a null text counts as empty; empty texts are scored like any other. Repeated rows
get equal scores. A document with several labels has the rounded mean of them; null labels are
ignored. With no usable labels the model is constant and scores 0.5.
"""

from __future__ import annotations

import operator
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import hash_sample, held_out, in_slices

FEATURES = ("log_chars", "log_words", "word_length", "upper", "digits", "symbols", "exclamations",
            "bars", "marks", "spaces", "wide", "entropy", "distinct_words", "root_distinct",
            "top_word", "neighbours_equal", "repeated_lines", "words_per_line", "words_per_stop")


def text_features(text: str | None) -> list[float]:
    """One number per name in ``FEATURES``; shares are of characters, words or lines."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    size = max(len(raw), 1)
    count = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words = raw.split()
    n = max(len(words), 1)
    seen = Counter(words)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    share = count[count > 0] / size
    at = {c: int(count[ord(c)]) for c in "!|.?,;:#$%&*<>@=_~^{}[]\\/+ \n\t"}
    return [
        np.log1p(len(raw)), np.log1p(len(words)), sum(map(len, words)) / n,
        count[65:91].sum() / size, count[48:58].sum() / size,
        sum(at[c] for c in "#$%&*<>@=_~^{}[]\\/+") / size, at["!"] / size, at["|"] / size,
        sum(at[c] for c in ".,;:?") / size, (at[" "] + at["\n"] + at["\t"]) / size,
        count[192:].sum() / size, float(-(share * np.log2(share)).sum()),
        len(seen) / n, len(seen) / np.sqrt(n), max(seen.values(), default=0) / n,
        sum(map(operator.eq, words, words[1:])) / n,
        1 - len(set(lines)) / max(len(lines), 1), n / max(len(lines), 1),
        n / (at["."] + at["?"] + at["!"] + 1),
    ]


@dataclass
class AdditiveModel:
    intercept: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    grids: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probabilities for the rows of ``x`` by additions of looked-up bins."""
        total = np.full(len(x), self.intercept)
        for j, table in enumerate(self.tables):
            total += table[np.searchsorted(self.edges[j], x[:, j], side="right")]
        for (j, k), grid in zip(self.pairs, self.grids, strict=True):
            total += grid[np.searchsorted(self.coarse[j], x[:, j], side="right"),
                          np.searchsorted(self.coarse[k], x[:, k], side="right")]
        return _sigmoid(total)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _gain(g: np.ndarray, h: np.ndarray, l2: float) -> np.ndarray:
    return g * g / (h + l2)


def _cut(g: np.ndarray, h: np.ndarray, l2: float) -> int:
    """The best place to cut a run of bins in two; 0 if no cut helps."""
    if len(g) < 2:
        return 0
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gain = (_gain(left_g, left_h, l2) + _gain(g.sum() - left_g, h.sum() - left_h, l2)
            - _gain(g.sum(), h.sum(), l2))
    best = int(gain.argmax())
    return best + 1 if gain[best] > 1e-9 else 0


def _tree(g: np.ndarray, h: np.ndarray, l2: float, depth: int = 2) -> np.ndarray:
    """Leaf values per bin of a greedy tree over one feature."""
    at = _cut(g, h, l2) if depth else 0
    if at == 0:
        return np.full(len(g), g.sum() / (h.sum() + l2))
    return np.concatenate([_tree(g[:at], h[:at], l2, depth - 1), _tree(g[at:], h[at:], l2, depth - 1)])


def _quadrants(g: np.ndarray, h: np.ndarray, l2: float) -> tuple[float, np.ndarray]:
    """Gain and leaf values per cell of the best pair of cuts, one on each axis."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)

    def corners(c: np.ndarray) -> list[np.ndarray]:
        a, top, left, whole = c[:-1, :-1], c[:-1, -1:], c[-1:, :-1], c[-1, -1]
        return [a, top - a, left - a, whole - top - left + a]

    if min(g.shape) < 2:
        return 0.0, np.zeros_like(g)
    gs, hs = corners(cg), corners(ch)
    gain = sum(_gain(a, b, l2) for a, b in zip(gs, hs, strict=True))
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    leaf = [a[i, j] / (b[i, j] + l2) for a, b in zip(gs, hs, strict=True)]
    out = np.empty_like(g)
    out[:i + 1, :j + 1], out[:i + 1, j + 1:] = leaf[0], leaf[1]
    out[i + 1:, :j + 1], out[i + 1:, j + 1:] = leaf[2], leaf[3]
    return float(gain[i, j] - _gain(cg[-1, -1], ch[-1, -1], l2)), out


def _bins(x: np.ndarray, bins: int) -> list[np.ndarray]:
    steps = np.linspace(0, 1, bins + 1)[1:-1]
    return [np.unique(np.quantile(x[:, j], steps)) for j in range(x.shape[1])]


def fit_additive(x: np.ndarray, y: np.ndarray, *, bins: int = 32, rounds: int = 120,
                 rate: float = 0.1, n_pairs: int = 4, pair_bins: int = 8, pair_rounds: int = 40,
                 l2: float = 1.0) -> AdditiveModel:
    """Learn all tables from features ``x`` and 0/1 labels ``y``."""
    if len(y) == 0:
        return AdditiveModel()
    share = (y.sum() + 0.5) / (len(y) + 1)
    model = AdditiveModel(float(np.log(share / (1 - share))), _bins(x, bins))
    if y.min() == y.max():
        return model
    width = x.shape[1]
    codes = [np.searchsorted(model.edges[j], x[:, j], side="right") for j in range(width)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    total = np.full(len(y), model.intercept)
    for _ in range(rounds):
        for j in range(width):
            p = _sigmoid(total)
            size = len(model.tables[j])
            step = rate * _tree(np.bincount(codes[j], y - p, size),
                                np.bincount(codes[j], p * (1 - p), size), l2)
            model.tables[j] += step
            total += step[codes[j]]
    model.coarse = _bins(x, pair_bins)
    cells = [np.searchsorted(model.coarse[j], x[:, j], side="right") for j in range(width)]

    def grid_of(j: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        shape = len(model.coarse[j]) + 1, len(model.coarse[k]) + 1
        p, flat = _sigmoid(total), cells[j] * shape[1] + cells[k]
        return (np.bincount(flat, y - p, shape[0] * shape[1]).reshape(shape),
                np.bincount(flat, p * (1 - p), shape[0] * shape[1]).reshape(shape))

    ranked = sorted(combinations(range(width), 2),
                    key=lambda jk: -_quadrants(*grid_of(*jk), l2)[0])
    model.pairs = ranked[:n_pairs]
    model.grids = [np.zeros((len(model.coarse[j]) + 1, len(model.coarse[k]) + 1))
                   for j, k in model.pairs]
    for _ in range(pair_rounds):
        for at, (j, k) in enumerate(model.pairs):
            step = rate * _quadrants(*grid_of(j, k), l2)[1]
            model.grids[at] += step
            total += step[cells[j], cells[k]]
    return model


def learn_quality(docs: DataFrame, labels: DataFrame, max_rows: int = 12_000) -> AdditiveModel:
    """Fit on the labelled rows outside the held-out third, ``max_rows`` at most (by id hash)."""
    known = (labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
             .filter(~held_out(F.col("doc_id"), 3, 1))
             .groupBy("doc_id").agg(F.round(F.avg("quality")).cast("int").alias("label")))
    chosen = hash_sample(known, max_rows, "doc_id")
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text")

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_slices(batches):
            got = [text_features(t) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("label"), pa.array(got, pa.list_(pa.float64()))], ["doc_id", "label", "x"])

    # One row an id, however often it occurs: at most max_rows reach the driver.
    got = (rows.mapInArrow(featured, f"doc_id {dict(rows.dtypes)['doc_id']}, label int, x array<double>")
           .groupBy("doc_id").agg(F.min(F.struct("label", "x")).alias("r")).select("r.label", "r.x").toPandas())
    if got.empty:
        return AdditiveModel()
    # The same rows in another order would add up to other last digits.
    x = np.array(got["x"].tolist())
    order = np.lexsort((got["label"], *x.T))
    return fit_additive(x[order], got["label"].to_numpy(float)[order])


def quality_score(model: AdditiveModel):
    """A function of a text column that gives the probability of label 1."""
    @F.arrow_udf("double")
    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for chunk in texts:
            out = []
            for start in range(0, len(chunk), 256):
                x = np.array([text_features(t) for t in chunk.slice(start, 256).to_pylist()])
                out.append(model.score(x))
            yield pa.array(np.concatenate(out) if out else np.empty(0), pa.float64())
    return score


def classify_quality(docs: DataFrame, labels: DataFrame, max_rows: int = 12_000) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted."""
    score = quality_score(learn_quality(docs, labels, max_rows))
    return (docs.select("doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"),
                        score("text").alias("score"))
            .withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0)))


def keep_good(docs: DataFrame, labels: DataFrame, max_rows: int = 12_000) -> DataFrame:
    """The rows of ``docs`` that score at least 0.5, with all their columns."""
    score = quality_score(learn_quality(docs, labels, max_rows))
    return docs.filter(score("text") >= 0.5)
