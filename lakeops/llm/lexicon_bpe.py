"""BPE encoding by a lexicon of frequent words, and decoding.

Merges never cross the borders of words (pre-tokens), so a word has the same ids wherever it stands. The words
of all documents are counted; the most frequent ones are compiled, with their ids, into a minimal acyclic
transducer: an automaton in which words share beginnings and endings, and whose edges carry numbers that
add up along a path to the word's place in a table of ids. It is written once to the shared folder,
handed to the executors as a file and mapped into memory there. A task splits its texts into words, runs the
distinct ones of a batch through the automaton side by side, and merges words that it doesn't hold by the
ranks, exactly as the merges were learned: the lowest rank first, the leftmost of equals. The lexicon therefore
decides how fast a word is encoded, never how.

Splitting uses a pattern; texts with characters that the tokenizers library classes differently (its tables
follow another Unicode version) are split by the library. Special tokens standing in a text become their
ids, as in the library. Decoding puts the bytes of the ids together; bytes that aren't UTF-8 are replaced.

Limits: byte-level vocabularies without normalizer, post-processor, dropout or ``ignore_merges``. The lexicon has
at most ``words`` words of at most ``LONGEST`` bytes; both bound what reaches the driver, and all other words
are merged. Words that share a frequency bin with too many others stay out together.

Defined results: a null text is empty and has no ids; no ids decode to the empty text. Repeated rows get equal
results. Long texts are split in runs of words.
"""

from __future__ import annotations

import heapq
import json
import mmap
import re
import uuid
from array import array
from collections import Counter
from collections.abc import Iterator
from functools import cached_property
from itertools import islice, pairwise

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Regex, pre_tokenizers

from lakeops.llm.common import in_slices, letters_of_bytes
from lakeops.session import settle, write_bytes

LONGEST = 48        # bytes of a word of the lexicon
RUN = 1 << 16       # words of a long text that are handled at a time
KEPT = 1 << 18      # distinct words that a counting task holds before it hands them on, and an encoding one keeps
STEPS = 16          # bins of a frequency between one power of two and the next

_SPLIT = regex.compile(public_tokenizers.PATTERN)
# The same pattern where every character is ASCII.
_SPLIT_ASCII = re.compile(r" ?[A-Za-z]+| ?[0-9]+|'s|'t|'re|'ve|'m|'ll|'d| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+", re.A)
# And where every character is in Latin-1, whose letters, numbers and spaces are spelled out.
_L, _N, _S = "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff", "0-9\u00b2\u00b3\u00b9\u00bc-\u00be", "\t-\r \u0085\u00a0"
_SPLIT_LATIN = re.compile(f" ?[{_L}]+| ?[{_N}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
_BEYOND_LATIN = re.compile("[^\x00-\xff]")
_LIBRARY = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)

_opened: dict[str, object] = {}


# -- vocabulary -----------------------------------------------------------------------------------

class Vocabulary:
    """Bytes of the ids, merges and special tokens of a ``tokenizer.json``."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as source:
            whole = json.load(source)
        model, split, added = whole["model"], whole["pre_tokenizer"], whole["added_tokens"]
        if (model["type"] != "BPE" or whole["normalizer"] or whole["post_processor"] or model.get("dropout")
                or model.get("ignore_merges") or split["type"] != "ByteLevel" or split["add_prefix_space"]
                or not split["use_regex"]
                or any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added)):
            raise ValueError("not a plain byte-level BPE tokenizer")
        byte_of = {c: b for b, c in enumerate(letters_of_bytes())}

        def raw(token: str) -> bytes:
            return bytes(byte_of[c] for c in token)

        ids = {raw(token): i for token, i in model["vocab"].items()}
        self.single = np.array([ids[bytes([b])] for b in range(256)])
        spelled = [tuple(map(raw, pair if isinstance(pair, list) else pair.split(" "))) for pair in model["merges"]]
        self.merged = np.array([ids[a + b] for a, b in spelled])  # id of the pair of each rank
        pairs = np.array([ids[a] << 32 | ids[b] for a, b in spelled])
        self.pair_ranks = np.argsort(pairs)
        self.pairs = pairs[self.pair_ranks]
        self.special = {t["content"]: t["id"] for t in added}
        self.bytes_of = {i: token for token, i in ids.items()} | {
            i: token.encode() for token, i in self.special.items()}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.cut = re.compile("|".join(map(re.escape, longest_first))) if longest_first else None

    @classmethod
    def of(cls, path: str) -> Vocabulary:
        if path not in _opened:
            _opened[path] = cls(path)
        return _opened[path]

    def merge(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word: of its adjacent pairs the one of the lowest rank is merged, the leftmost of
        equals, until no pair has a rank. The words take such steps side by side."""
        out = [b""] * len(words)
        short = [k for k, w in enumerate(words) if len(w) <= LONGEST]
        for k, ids in zip(short, self._merge_short([words[k] for k in short]), strict=True):
            out[k] = ids
        for k, word in enumerate(words):
            if len(word) > LONGEST:
                out[k] = np.array(self._merge_long(word), "<u4").tobytes()
        return out

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids, the number of merges for pairs without one."""
        pair = left << 32 | right
        found = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return np.where(self.pairs[found] == pair, self.pair_ranks[found], len(self.merged))

    def _merge_short(self, words: list[bytes]) -> list[bytes]:
        none, size = len(self.merged), np.fromiter(map(len, words), np.int64, len(words))
        ids = self.single[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words)), size)
        rank = np.full(len(ids), none)  # of the pair that begins here, inside a word
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        rank[inside] = self._ranks(ids[inside], ids[inside + 1])
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(ids):
            starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            count = np.diff(np.append(starts, len(ids)))
            lowest = np.repeat(np.minimum.reduceat(rank, starts), count)
            going = lowest < none
            done.append((owner[~going], ids[~going]))
            ids, owner, rank, lowest = ids[going], owner[going], rank[going], lowest[going]
            hits = np.flatnonzero(rank == lowest)
            if not len(hits):
                break
            at = hits[np.concatenate([[True], owner[hits[1:]] != owner[hits[:-1]]])]
            ids[at] = self.merged[rank[at]]
            stays = np.ones(len(ids), bool)
            stays[at + 1] = False
            ids, owner, rank = ids[stays], owner[stays], rank[stays]
            at = at - np.arange(len(at))
            rank[at] = none
            for left in (at, at - 1):  # the new id's pairs with its neighbours
                left = left[(left >= 0) & (left + 1 < len(ids))]
                left = left[owner[left] == owner[left + 1]]
                rank[left] = self._ranks(ids[left], ids[left + 1])
        order = np.argsort(np.concatenate([[], *[o for o, _ in done]]), kind="stable")
        flat = np.concatenate([np.zeros(0, np.int64), *[i for _, i in done]])[order].astype("<u4").tobytes()
        n_ids = np.bincount(np.concatenate([np.zeros(0, np.int64), *[o for o, _ in done]]), minlength=len(words))
        ends = (4 * np.cumsum(n_ids)).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def _merge_long(self, word: bytes) -> list[int]:
        """The ids of one word of any length, with a queue of pairs."""
        ids = array("i", self.single[np.frombuffer(word, np.uint8)].tolist())
        n, ranks = len(ids), self.rank_of
        after, before = array("i", range(1, n + 1)), array("i", range(-1, n - 1))
        queue = [(rank, at) for at, pair in enumerate(pairwise(ids)) if (rank := ranks.get(pair)) is not None]
        heapq.heapify(queue)
        while queue:
            rank, at = heapq.heappop(queue)
            right = after[at]
            if ids[at] < 0 or right >= n or ranks.get((ids[at], ids[right])) != rank:
                continue  # the pair changed since it was queued
            ids[at], ids[right] = int(self.merged[rank]), -1
            after[at] = right = after[right]
            if right < n:
                before[right] = at
            for left, other in ((before[at], at), (at, right)):
                if left >= 0 and other < n and (new := ranks.get((ids[left], ids[other]))) is not None:
                    heapq.heappush(queue, (new, left))
        return [i for i in ids if i >= 0]

    @cached_property
    def rank_of(self) -> dict[tuple[int, int], int]:
        return {(p >> 32, p & 0xFFFFFFFF): r for p, r in zip(self.pairs.tolist(), self.pair_ranks.tolist(), strict=True)}


# -- words ----------------------------------------------------------------------------------------

def differing_characters() -> str:
    """The inside of a character class: all characters that are a letter, number or space for only one of
    the library and the pattern's module; empty if there are none. Planes that hold no characters, or only
    private ones, are left out."""
    every = np.array([c for plane in (0, 1, 2, 3, 14) for c in range(plane << 16, (plane + 1) << 16)
                      if not 0xD800 <= c < 0xE000], np.uint32)
    text = every.astype("<u4").tobytes().decode("utf-32-le")
    differ = np.zeros(len(every) + 1, bool)
    for kind in (r"\p{L}", r"\p{N}", r"\s"):
        other = np.zeros(len(every) + 1, bool)
        for _, (a, b) in pre_tokenizers.Split(Regex(f"{kind}+"), "removed").pre_tokenize_str(text):
            other[a:b] = True
        mine = np.zeros(len(every) + 1, bool)
        for run in regex.finditer(f"{kind}+", text):
            mine[run.start():run.end()] = True
        differ[:-1] |= mine[:-1] == other[:-1]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], differ])))
    return "".join(f"\\U{every[a]:08x}-\\U{every[b - 1]:08x}" for a, b in edges.reshape(-1, 2))


def _by_library(text: str) -> list[str]:
    return [text[a:b] for _, (a, b) in _LIBRARY.pre_tokenize_str(text)]


class Splitter:
    """Texts as runs of words; a special token is a word of its own."""

    def __init__(self, special: re.Pattern | None, differing: str):
        self.special = special
        self.odd = re.compile(f"[{differing}]") if differing else None
        # Most texts have no character as high as the first that differs, which is soon seen.
        self.high = re.compile(f"[{differing[:10]}-\\U0010ffff]") if differing else None

    def runs(self, text: str) -> Iterator[list[str]]:
        at = 0
        for match in self.special.finditer(text) if self.special else ():
            yield from self._plain(text[at:match.start()])
            yield [match.group()]
            at = match.end()
        yield from self._plain(text[at:] if at else text)

    def _plain(self, text: str) -> Iterator[list[str]]:
        if not text:
            return
        pattern = _SPLIT_ASCII if text.isascii() else _SPLIT if _BEYOND_LATIN.search(text) else _SPLIT_LATIN
        if pattern is not _SPLIT_ASCII and self.odd and self.high.search(text) and self.odd.search(text):
            yield _by_library(text)
        elif len(text) <= RUN:
            yield pattern.findall(text)
        else:
            matches = pattern.finditer(text)
            while run := [m.group() for m in islice(matches, RUN)]:
                yield run


def count_words(docs: DataFrame, splitter: Splitter) -> DataFrame:
    """(word, n): how often each word of at most ``LONGEST`` bytes stands in the texts. Tasks count
    before they shuffle, so a word in every text is a few rows."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()

        def rows() -> pa.RecordBatch:
            kept = [(w, n) for w, n in seen.items() if len(w.encode()) <= LONGEST]
            seen.clear()
            words, counts = zip(*kept, strict=True) if kept else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(counts, pa.int64())],
                                              ["word", "n"])

        for part in in_slices(batches):
            for text in part.column("text").to_pylist():
                for run in splitter.runs(text):
                    seen.update(run)
                    if len(seen) > KEPT:
                        yield rows()
        yield rows()

    return (docs.select("text").filter("text IS NOT NULL").mapInArrow(counted, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")))


# -- lexicon --------------------------------------------------------------------------------------

def compile_lexicon(words: list[bytes], ids: list[bytes]) -> bytes:
    """The transducer of ascending distinct ``words``, and their ``ids``, as one file.

    States are made minimal while the words arrive: once a word has left a branch, its states are
    looked up among the finished ones and replaced by an equal one. Then an edge's number is how many words
    end or branch off before it in its state.
    """
    register: dict[tuple, int] = {}
    finished: list[tuple[bool, tuple[tuple[int, int], ...]]] = []
    below: list[int] = []  # words that can be ended from a finished state

    def finish(final: bool, edges: list[tuple[int, int]]) -> int:
        key = (final, tuple(edges))
        if key not in register:
            register[key] = len(finished)
            finished.append(key)
            below.append(final + sum(below[t] for _, t in edges))
        return register[key]

    open_states: list[list] = [[False, []]]  # final, finished edges, along the last word

    def close(depth: int, last: bytes) -> None:
        while len(open_states) > depth + 1:
            state = open_states.pop()
            open_states[-1][1].append((last[len(open_states) - 1], finish(*state)))

    last = b""
    for n, word in enumerate(words):
        if n and word <= last:
            raise ValueError("words must ascend")
        shared = 0
        while shared < min(len(word), len(last)) and word[shared] == last[shared]:
            shared += 1
        close(shared, last)
        open_states.extend([False, []] for _ in range(len(word) - shared))
        open_states[-1][0] = True
        last = word
    close(0, last)
    start = finish(*open_states[0])

    keys, targets, numbers = [], [], []
    for state, (final, edges) in enumerate(finished):
        passed = int(final)
        for byte, target in edges:
            keys.append(state * 256 + byte)
            targets.append(target)
            numbers.append(passed)
            passed += below[target]
    starts = np.cumsum([0, *[len(i) // 4 for i in ids]])
    parts = [np.array(keys, "<u4"), np.array(targets, "<u4"), np.array(numbers, "<u4"),
             np.array([f for f, _ in finished], "u1"), starts.astype("<u4"),
             np.frombuffer(b"".join(ids), "<u4")]
    if len(finished) >= 1 << 24:
        raise ValueError("too many states for keys of 32 bits")
    head = np.array([start, max(map(len, words), default=0), *map(len, parts)], "<u8")
    return head.tobytes() + b"".join(p.tobytes() for p in parts)


class Lexicon:
    """A compiled file, mapped into memory."""

    def __init__(self, path: str):
        with open(path, "rb") as source:
            whole = mmap.mmap(source.fileno(), 0, access=mmap.ACCESS_READ)
        head = np.frombuffer(whole, "<u8", 8)
        self.start, self.longest, at, parts = int(head[0]), int(head[1]), head.nbytes, []
        for size, kind in zip(head[2:], ("<u4", "<u4", "<u4", "u1", "<u4", "<u4"), strict=True):
            parts.append(np.frombuffer(whole, kind, int(size), at))
            at += parts[-1].nbytes
        self.keys, self.targets, self.numbers, self.final, self.starts, _ = parts
        self.ids = memoryview(whole)[at - 4 * int(head[-1]):]

    @classmethod
    def of(cls, name: str) -> Lexicon:
        if name not in _opened:
            _opened[name] = cls(SparkFiles.get(name))
        return _opened[name]

    def places(self, words: list[bytes]) -> np.ndarray:
        """Each word's place in the table of ids, -1 if the automaton doesn't hold it. All words take
        one step at a time together."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        out = np.full(len(words), -1, np.int64)
        if not len(self.keys):
            return out
        blob = np.frombuffer(b"".join(words), np.uint8)
        begin = np.cumsum(size) - size
        running = np.flatnonzero(size <= self.longest)
        state, total = np.full(len(running), self.start, np.uint32), np.zeros(len(running), np.int64)
        for depth in range(self.longest + 1):
            ended = size[running] == depth
            done = ended & (self.final[state] == 1)
            out[running[done]] = total[done]
            running, state, total = running[~ended], state[~ended], total[~ended]
            if not len(running):
                break
            key = state * np.uint32(256) + blob[begin[running] + depth]
            edge = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            there = self.keys[edge] == key
            running, edge = running[there], edge[there]
            state, total = self.targets[edge], total[there] + self.numbers[edge]
        return out

    def ids_at(self, places: np.ndarray) -> list[bytes]:
        """The ids of each place as little-endian numbers of 32 bits."""
        starts, ends = self.starts[places].tolist(), self.starts[places + 1].tolist()
        return [bytes(self.ids[4 * a:4 * b]) for a, b in zip(starts, ends, strict=True)]


def frequent_words(counted: DataFrame, words: int) -> DataFrame:
    """As many of the most frequent words as have room among ``words``: all whose frequency is in a bin above
    some border. Only the sizes of bins reach the driver, so the border costs the same at every size."""
    bin_of = F.floor(F.log2("n") * STEPS)
    bins = counted.groupBy(bin_of.alias("bin")).count().orderBy(F.desc("bin")).collect()
    border, held = float("inf"), 0
    for r in bins:
        held += r["count"]
        if held > words:
            break
        border = r["bin"]
    return counted.filter(bin_of >= F.lit(border))


def build_lexicon(docs: DataFrame, vocabulary: Vocabulary, splitter: Splitter, words: int) -> str:
    """Compile the most frequent words of ``docs``; the name of the file that tasks can open."""
    counted = settle(count_words(docs, splitter), "word-counts")
    rows = frequent_words(counted, words).select("word").collect()
    chosen = sorted(r["word"].encode() for r in rows if r["word"] not in vocabulary.special)
    spark = docs.sparkSession
    name = f"lexicon-{uuid.uuid4().hex}"
    path = write_bytes(spark, name, compile_lexicon(chosen, vocabulary.merge(chosen)))
    spark.sparkContext.addFile(path)
    return path.rsplit("/", 1)[-1]


# -- encoding -------------------------------------------------------------------------------------

def encode_texts(docs: DataFrame, tokenizer: str, words: int = 1 << 17, back: bool = False) -> DataFrame:
    """doc_id and ids (binary: little-endian, 32 bits each) of every row's text; with ``back`` also ``decoded``,
    the text that the ids give, made by the same task."""
    vocabulary = Vocabulary.of(tokenizer)
    differing = differing_characters()
    lexicon = build_lexicon(docs, vocabulary, Splitter(vocabulary.cut, differing), words)

    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        vocab, lex = Vocabulary.of(tokenizer), Lexicon.of(lexicon)
        splitter, known = Splitter(vocab.cut, differing), {}
        for batch in batches:
            out: list[list[bytes]] = [[] for _ in range(len(batch))]
            waiting: list[tuple[int, list[str]]] = []
            size = 0
            for k, text in enumerate(batch):
                for run in splitter.runs(text.as_py() or ""):
                    waiting.append((k, run))
                    size += len(run)
                    if size >= RUN:
                        _encode_runs(waiting, vocab, lex, known, out)
                        size = 0
            _encode_runs(waiting, vocab, lex, known, out)
            for k, parts in enumerate(out):
                out[k] = b"".join(parts)
            ids = pa.array(out, pa.binary())
            texts = pa.array([_decode(b, vocab) for b in out] if back else [None] * len(out), pa.string())
            yield pa.StructArray.from_arrays([ids, texts], ["ids", "decoded"])

    coded = F.arrow_udf(encode, "ids binary, decoded string").asNondeterministic()
    rows = docs.select("doc_id", coded("text").alias("_llm_ids"))
    return rows.select("doc_id", "_llm_ids.ids", *["_llm_ids.decoded"] * back)


def _decode(ids: bytes, vocab: Vocabulary) -> str:
    return b"".join(map(vocab.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


def _encode_runs(waiting: list[tuple[int, list[str]]], vocab: Vocabulary, lex: Lexicon,
                 known: dict[str, bytes], out: list[list[bytes]]) -> None:
    """Add the ids of the waiting (text, words) runs to ``out``, and empty ``waiting``. ``known`` holds ids of
    words met lately, at most ``KEPT`` and those of one run."""
    if len(known) > KEPT:
        known.clear()
    new = list(set().union(*[run for _, run in waiting]).difference(known))
    raw = [w.encode() for w in new]
    places = lex.places(raw)
    held = np.flatnonzero(places >= 0)
    known.update(zip([new[k] for k in held.tolist()], lex.ids_at(places[held]), strict=True))
    unseen = np.flatnonzero(places < 0).tolist()
    known.update(zip([new[k] for k in unseen], vocab.merge([raw[k] for k in unseen]), strict=True))
    known.update((w, i.to_bytes(4, "little")) for w, i in vocab.special.items())
    for k, run in waiting:
        out[k].append(b"".join(map(known.__getitem__, run)))
    waiting.clear()


def decoded(ids: str, tokenizer: str) -> Column:
    """The text of a column of ids as ``encode_texts`` gives them; null for null."""
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        vocab = Vocabulary.of(tokenizer)
        for batch in batches:
            yield pa.array([_decode(b.as_py(), vocab) if b.is_valid else None for b in batch], pa.string())

    return F.arrow_udf(decode, "string").asNondeterministic()(ids)
