"""Fill-in-the-middle: texts cut in three and put together so that the middle comes last.

A text is a sequence of units: runs of the letters A to Z and a to z, and single other code points. The offsets
at which units begin or end form a ``BoundarySet``: containers of 65,536 offsets each, kept as a sorted
array, a bitmap or runs, whichever is smallest, with the number of members before each container.
The cut after k units is the k-th member: a search among those numbers names the container, a
selection inside it the offset. Only the two cuts leave Python; texts are put together and restored by
Spark's string functions.

The draws h1 to h4 are the first four groups of eight hex digits of the SHA-256 of ``seed:doc_id``. The
prefix ends after the smaller of h1 and h2 modulo n + 1 units, the middle after the larger. Texts stay
plain if they are empty or hold a mark, and where h3 modulo 100 isn't below ``rate``; of the others those with h4
modulo 100 below ``spm_rate`` take the order suffix, prefix, middle.

Defined results: a null text is empty, hence plain with n = 0; a null id draws as the empty word. Repeated
rows get equal results. Texts of any length are cut whole, one at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARKS = ("<P>", "<S>", "<M>")
WIDTH = 1 << 16  # offsets that one container covers
ARRAY, BITMAP, RUNS = "array", "bitmap", "runs"


class BoundarySet:
    """Offsets in ascending order that can be asked for the k-th member."""

    def __init__(self, offsets: np.ndarray):
        """``offsets``: distinct, ascending."""
        self.containers: list[tuple[int, str, np.ndarray, np.ndarray | None]] = []
        sizes, at = [], 0
        while at < len(offsets):
            high = int(offsets[at]) // WIDTH
            end = at + int(np.searchsorted(offsets[at:], (high + 1) * WIDTH))
            self.containers.append((high * WIDTH, *_container((offsets[at:end] - high * WIDTH))))
            sizes.append(end - at)
            at = end
        self.before = np.cumsum([0, *sizes])

    def __len__(self) -> int:
        return int(self.before[-1])

    def select(self, k: int) -> int:
        """The member that has ``k`` members before it."""
        if not 0 <= k < len(self):
            raise IndexError(k)
        at = int(np.searchsorted(self.before, k, side="right")) - 1
        base, kind, body, counts = self.containers[at]
        k -= int(self.before[at])
        if kind == ARRAY:
            return base + int(body[k])
        part = int(np.searchsorted(counts, k, side="right")) - 1
        k -= int(counts[part])
        if kind == RUNS:
            return base + int(body[part, 0]) + k
        bits = np.flatnonzero(np.unpackbits(body[part * 8:part * 8 + 8], bitorder="little"))
        return base + part * 64 + int(bits[k])


def _container(low: np.ndarray) -> tuple[str, np.ndarray, np.ndarray | None]:
    """The smallest form of ascending offsets below ``WIDTH``, and what selection needs beside it:
    members before each run, or before each 64 bits."""
    breaks = np.flatnonzero(np.diff(low) != 1) + 1
    size = {ARRAY: 2 * len(low), BITMAP: WIDTH // 8, RUNS: 4 * (len(breaks) + 1)}
    kind = min(size, key=size.get)
    if kind == ARRAY:
        return kind, low.astype(np.uint16), None
    if kind == RUNS:
        starts = np.concatenate([[0], breaks])
        lengths = np.diff(np.append(starts, len(low)))
        runs = np.stack([low[starts], lengths - 1], axis=1).astype(np.uint16)
        return kind, runs, np.cumsum(lengths) - lengths
    flags = np.zeros(WIDTH, np.uint8)
    flags[low] = 1
    per_word = flags.reshape(-1, 64).sum(axis=1, dtype=np.int64)
    return kind, np.packbits(flags, bitorder="little"), np.cumsum(per_word) - per_word


def boundaries(text: str) -> BoundarySet:
    """Where units of ``text`` begin or end, counted in code points."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    letter = ((codes | 32) - 97 < 26) & (codes < 128)
    border = np.ones(len(codes) + 1, bool)
    border[1:-1] = ~(letter[1:] & letter[:-1])
    return BoundarySet(np.flatnonzero(border))


def _cuts(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """Number of units, and both cuts in code points, from texts and two draws."""
    for texts, one, two in batches:
        rows = []
        for text, a, b in zip(texts, one.to_pylist(), two.to_pylist(), strict=True):
            units = boundaries(text.as_py())
            n = len(units) - 1
            rows.append((n, *(units.select(k) for k in sorted((a % (n + 1), b % (n + 1))))))
        yield pa.StructArray.from_arrays(
            [pa.array(c, pa.int64()) for c in (zip(*rows, strict=True) if rows else ([], [], []))],
            ["n", "first", "second"])


def rearrange(docs: DataFrame, seed: int = 1, rate: int = 90, spm_rate: int = 20,
              marks: tuple[str, str, str] = MARKS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n, form, prefix_chars, middle_chars, output (the text
    rearranged). ``marks`` stand before prefix, suffix and middle."""
    _check_marks(marks)
    text = F.coalesce("text", F.lit(""))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)

    def draw(i: int) -> Column:
        return F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long")

    plain = (F.length("t") == 0) | (draw(2) % 100 >= rate)
    for mark in marks:
        plain = plain | F.col("t").contains(mark)
    form = F.when(plain, "plain").when(draw(3) % 100 < spm_rate, "spm").otherwise("psm")
    # Not deterministic for the planner only, so that it computes the cuts of a row once.
    cut = F.arrow_udf(_cuts, "n long, first long, second long").asNondeterministic()
    rows = (docs.select("doc_id", text.alias("t"))
            .select("doc_id", "t", form.alias("form"), cut("t", draw(0), draw(1)).alias("c"))
            .select("doc_id", "t", "form", "c.n", "c.first", "c.second"))
    prefix = F.substring("t", F.lit(1), F.col("first"))
    middle = F.substring("t", F.col("first") + 1, F.col("second") - F.col("first"))
    suffix = F.substring("t", F.col("second") + 1, F.length("t"))
    p, s, m = map(F.lit, marks)
    chosen = F.col("form") != "plain"
    return rows.select(
        "doc_id", "n", "form", F.when(chosen, F.col("first")).alias("prefix_chars"),
        F.when(chosen, F.col("second") - F.col("first")).alias("middle_chars"),
        F.when(~chosen, F.col("t"))
        .when(F.col("form") == "psm", F.concat(p, prefix, s, suffix, m, middle))
        .otherwise(F.concat(s, suffix, p, prefix, m, middle)).alias("output"))


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text that ``rearrange`` made ``output`` from."""
    _check_marks(marks)
    p, s, m = marks
    size = {mark: len(mark) for mark in marks}

    def between(a: str, b: str) -> Column:
        start = F.instr(output, a) + size[a]
        return F.substring(output, start, F.instr(output, b) - start)

    last = F.substring(output, F.instr(output, m) + size[m], F.length(output))
    return (F.when(form == "plain", output)
            .when(form == "psm", F.concat(between(p, s), last, between(s, m)))
            .otherwise(F.concat(between(p, m), last, between(s, p))))


def _check_marks(marks: tuple[str, str, str]) -> None:
    """A mark that begins with a character found nowhere else in the marks can't arise where a text
    without marks meets one."""
    heads, rest = {m[:1] for m in marks}, {c for m in marks for c in m[1:]}
    if len(set(marks)) < 3 or "" in heads or heads & rest or any(
            a != b and a.startswith(b) for a in marks for b in marks):
        raise ValueError("marks must differ, and begin with a character that occurs nowhere inside them")
