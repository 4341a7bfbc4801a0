"""License notices: exact phrases, and short notices with a few wrong letters.

A notice of length n that may have k errors is cut into k + 1 seeds. By the pigeonhole principle any
text within k errors of the notice contains one seed unchanged, so all seeds are looked up in one
pass (Aho-Corasick), and only around the hits the ``regex`` library matches the notice with
bounded errors and gives its span.

Texts are compared as words: A-Z are lower-cased, and every run of other ASCII characters than
letters and digits is one blank. Spans are word positions, ends exclusive.

Defined results: a null or empty text has no words and no labels. Repeated rows get equal
rows. Overlapping finds of one notice count once; finds of different notices all count.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Exact phrases and their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

# Notices that are found with errors too, and their labels.
NOTICES = (
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge", "mit"),
    ("licensed under the apache license", "apache"),
    ("gnu general public license", "gpl"),
    ("general public license version", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("redistribution and use in source and binary forms", "bsd"),
    ("mozilla public license", "mpl"),
    ("licensed under cc by", "cc-by"),
    ("licensed under cc by nc", "cc-by-nc"),
    ("creative commons attribution", "cc-by"),
    ("dedicated to the public domain", "public-domain"),
    ("all rights reserved", "reserved"),
    ("permission to use copy modify and or distribute this software", "isc"),
    ("gnu affero general public license", "agpl"),
    ("apache license version 2 0", "apache"),
    ("licensed under the bsd license", "bsd"),
    ("eclipse public license", "epl"),
    ("common development and distribution license", "cddl"),
    ("european union public licence", "eupl"),
    ("boost software license version", "bsl"),
    ("microsoft public license", "ms-pl"),
    ("python software foundation license", "psf"),
    ("sil open font license", "ofl"),
    ("creative commons zero", "cc0"),
    ("creative commons attribution sharealike", "cc-by-sa"),
    ("creative commons attribution noncommercial", "cc-by-nc"),
    ("spdx license identifier mit", "mit"),
    ("spdx license identifier apache 2 0", "apache"),
    ("spdx license identifier gpl", "gpl"),
    ("spdx license identifier bsd", "bsd"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
)
STRETCH = 4  # lengths of a notice that are searched at a time, besides an overlap
ERRORS_PER_CHARACTERS = 10  # one error is allowed for each so many characters of a notice

_BLANK = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32
               for c in range(256))


@dataclass(frozen=True)
class Notice:
    text: str
    label: str
    errors: int
    seeds: tuple[tuple[int, str], ...]  # where each seed stands in the notice
    pattern: regex.Pattern


def prepare(text: str, label: str) -> Notice:
    errors = len(text) // ERRORS_PER_CHARACTERS
    edges = [len(text) * i // (errors + 1) for i in range(errors + 2)]
    seeds = tuple((a, text[a:b]) for a, b in zip(edges, edges[1:]))
    # Whole words only: a blank stands on either side.
    pattern = regex.compile(f"(?b)(?<= )(?:{regex.escape(text, literal_spaces=True)}){{e<={errors}}}(?= )")
    return Notice(text, label, errors, seeds, pattern)


class Scanner:
    """All notices, and one automaton over their seeds."""

    def __init__(self, notices: tuple[tuple[str, str], ...] = NOTICES):
        self.notices = [prepare(*n) for n in notices]
        owners: dict[str, list[tuple[int, int]]] = {}
        for k, notice in enumerate(self.notices):
            for at, seed in notice.seeds:
                owners.setdefault(seed, []).append((k, at))
        self.seeds = ahocorasick.Automaton()
        for seed, owned in owners.items():
            self.seeds.add_word(seed, (len(seed), owned))
        self.seeds.make_automaton()

    def windows(self, text: str) -> dict[int, list[list[int]]]:
        """For each notice the stretches of ``text`` that can hold it, without overlaps."""
        found: dict[int, list[list[int]]] = {}
        for end, (size, owned) in self.seeds.iter(text):
            for k, at in owned:
                notice = self.notices[k]
                begin = max(0, end + 1 - size - at - notice.errors - 1)
                stop = end + 1 - size - at + len(notice.text) + notice.errors + 1
                spans = found.setdefault(k, [])
                if spans and begin <= spans[-1][1]:
                    spans[-1][0] = min(spans[-1][0], begin)
                    spans[-1][1] = max(spans[-1][1], stop)
                else:
                    spans.append([begin, stop])
        return found

    def find(self, text: str) -> list[tuple[int, int, str, float]]:
        """(start, end, label, score) by character, of all notices."""
        out = []
        for k, spans in self.windows(text).items():
            notice = self.notices[k]
            longest = len(notice.text) + notice.errors + 2  # with the blanks around it
            # A long window is searched in stretches: one match lies in one of them whole, and the work
            # grows with the text.
            step = STRETCH * longest
            found = {m for begin, stop in spans for a in range(begin, max(begin + 1, min(stop, len(text)) - longest), step)
                     for m in self._matches(notice, text, a, min(a + step + longest, stop, len(text)))}
            ends: list[tuple[int, int]] = []  # of the chosen matches, the best first; none overlap
            for errors, start, end in sorted(found):
                at = bisect.bisect_left(ends, (start, end))
                if (at and ends[at - 1][1] > start) or (at < len(ends) and ends[at][0] < end):
                    continue
                ends.insert(at, (start, end))
                out.append((start, end, notice.label, 1 - errors / len(notice.text)))
        return sorted(out)

    @staticmethod
    def _matches(notice: Notice, text: str, begin: int, stop: int) -> Iterator[tuple[int, int, int]]:
        """(errors, start, end): the best match, and those before and after it."""
        left = [(begin, stop)]
        while left:
            first, last = left.pop()
            m = notice.pattern.search(text, first, last, concurrent=False)
            if m:
                yield sum(m.fuzzy_counts), m.start(), m.end()
                left += [(first, m.start()), (m.end(), last)]


def read_words(text: str | None) -> str:
    """The words between single blanks, with a blank before and after."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_BLANK).split()
    return (b" " + b" ".join(words) + b" " if words else b" ").decode("utf-8", "surrogatepass")


def scan(scanner: Scanner, text: str | None) -> dict:
    """Counts, spans and labels of one text."""
    line = read_words(text)
    n_words = line.count(" ") - 1
    blanks: list[int] = []

    def word(at: int) -> int:
        """The number of the word that begins at a character."""
        if not blanks:
            blanks.extend(i for i, c in enumerate(line) if c == " ")
        return bisect.bisect_left(blanks, at)

    base = []
    for phrase, label in PHRASES:
        at = line.find(f" {phrase} ")
        while at >= 0:
            base.append((word(at + 1) - 1, label))
            at = line.find(f" {phrase} ", at + 1)
    spans = [(word(a) - 1, word(b), label, score) for a, b, label, score in scanner.find(line)]
    return {
        "n_words": max(n_words, 0), "n_base": len(base),
        "first_word": min(base)[0] if base else None, "last_word": max(base)[0] if base else None,
        "base_labels": ",".join(sorted({label for _, label in base})),
        "labels": ",".join(sorted({label for _, label in base} | {s[2] for s in spans})),
        "score": max([1.0 if base else 0.0, *(s[3] for s in spans)]),
        "notices": [{"start": a, "end": b, "label": label, "score": score} for a, b, label, score in spans],
    }


SCANNED = pa.struct([
    ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
    ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()),
    ("score", pa.float64()), ("notices", pa.list_(pa.struct([
        ("start", pa.int64()), ("end", pa.int64()), ("label", pa.string()), ("score", pa.float64())])))])


def scan_licenses(docs: DataFrame, notices: tuple[tuple[str, str], ...] = NOTICES) -> DataFrame:
    """One row per row of ``docs``: doc_id, counts, labels, score, and ``notices`` with spans."""
    @F.arrow_udf("n_words long, n_base long, first_word long, last_word long, base_labels string, "
                 "labels string, score double, "
                 "notices array<struct<start:long,end:long,label:string,score:double>>")
    def scanned(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scanner = Scanner(notices)
        for chunk in texts:
            yield pa.array([scan(scanner, t.as_py()) for t in chunk], SCANNED)

    return docs.select("doc_id", scanned.asNondeterministic()("text").alias("s")).select("doc_id", "s.*")
