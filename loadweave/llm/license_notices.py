"""Short licence notices in texts, with a bounded number of edits.

A text becomes its words (digits, letters and all code points above ASCII, A-Z in lower case)
with one space between them. A notice may be found with up to ``k`` edits (inserted, deleted or
replaced characters). Cut into k + 1 pieces, at least one piece of it then stands unchanged in
the text (pigeonhole), so one pass of an automaton over the text finds every place where a piece
stands; each gives a candidate start, and starts that are near each other are one candidate. From
every word boundary near it to every one in reach, the regex library matches the notice with
its bounded errors and gives the number of edits; numbers bear no edit. A notice that differs from another only in a few characters would match in the other's
place: of matches whose spans overlap the one with the fewest edits stays (ties: the
longer one, then by name).

Exact phrases are counted besides: every place where their words stand consecutively.

Rules: a null text has no words; a text without words has no match. Repeated rows are scanned
each on their own, ids play no part. Whole texts are read whatever their length; work and
memory are in proportion to the text and its seed places. An empty table gives no rows.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import ahocorasick
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadweave.llm.common import append_columns, ascii_words, prepare, sealed

#: Exact phrases and their labels.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)
#: Openings and titles of common licences, in normal form, and their labels.
NOTICES = (
    ("released under the mit license", "mit"),
    ("licensed under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit"),
    ("licensed under the apache license version 2 0", "apache-2"),
    ("apache license version 2 0", "apache-2"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under cc by sa 4 0", "cc-by-sa"),
    ("licensed under cc by nd 4 0", "cc-by-nd"),
    ("creative commons attribution noncommercial", "cc-by-nc"),
    ("creative commons attribution sharealike", "cc-by-sa"),
    ("creative commons attribution noderivatives", "cc-by-nd"),
    ("licensed under the gnu general public license version 3", "gpl-3"),
    ("licensed under the gnu general public license version 2", "gpl-2"),
    ("gnu general public license version 3", "gpl-3"),
    ("gnu general public license version 2", "gpl-2"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("mozilla public license version 2 0", "mpl-2"),
    ("eclipse public license version 2 0", "epl-2"),
    ("boost software license version 1 0", "bsl-1"),
    ("redistribution and use in source and binary forms with or without modification", "bsd"),
    ("permission to use copy modify and or distribute this software for any purpose", "isc"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
)
#: One edit is allowed for so many characters of a notice.
CHARS_PER_EDIT = 12
DIGEST = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, "
    "labels string, score double"
)
SPANS = (
    "spans array<struct<label: string, notice: string, first_word: long, n_words: long, "
    "edits: int>>"
)


@dataclass(frozen=True)
class Found:
    start: int
    stop: int
    edits: int
    notice: int


def edits_allowed(notice: str) -> int:
    return max(1, len(notice) // CHARS_PER_EDIT)


def pieces(notice: str, k: int) -> list[tuple[int, str]]:
    """``notice`` in k + 1 pieces of nearly equal length, with their places."""
    cuts = [len(notice) * i // (k + 1) for i in range(k + 2)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:])]


def bounded(notice: str, k: int) -> regex.Pattern:
    """``notice``, whose runs of letters may each have up to ``k`` edits, numbers none (so one
    version is not taken for another)."""
    parts = [p for p in regex.split(r"(\d(?:[\d ]*\d)?)", notice) if p]
    shown = [regex.escape(p, special_only=True) for p in parts]
    body = "".join(e if p[0].isdigit() else f"(?:{e}){{e<={k}}}" for p, e in zip(parts, shown))
    return regex.compile(f"(?b){body}")


def _boundaries(text: str, low: int, high: int) -> Iterator[int]:
    """Places of spaces in ``text`` from ``low`` to ``high``, both included."""
    at = text.find(" ", max(low, 0), high + 1)
    while at >= 0:
        yield at
        at = text.find(" ", at + 1, high + 1)


class Scanner:
    """The automaton of all pieces and one bounded-error pattern per notice."""

    def __init__(self, notices: Sequence[tuple[str, str]], phrases: Sequence[tuple[str, str]]):
        self.notices = list(notices)
        self.phrases = [(f" {phrase} ", label) for phrase, label in phrases]
        self.edits = [edits_allowed(text) for text, _ in notices]
        seeds: dict[str, list[tuple[int, int]]] = {}
        for number, (text, _) in enumerate(notices):
            for at, piece in pieces(text, self.edits[number]):
                seeds.setdefault(piece, []).append((number, at))
        self.automaton = ahocorasick.Automaton()
        for piece, places in seeds.items():
            self.automaton.add_word(piece, (len(piece), places))
        if seeds:
            self.automaton.make_automaton()
        self.patterns = [bounded(text, k) for (text, _), k in zip(notices, self.edits)]

    def candidates(self, text: str) -> dict[int, list[tuple[int, int]]]:
        """Per notice, the ranges of starts that its pieces give, near ones joined."""
        starts: dict[int, set[int]] = {}
        if self.notices:
            for end, (length, places) in self.automaton.iter(text):
                for number, at in places:
                    starts.setdefault(number, set()).add(end + 1 - length - at)
        out = {}
        for number, found in starts.items():
            ranges: list[list[int]] = []
            for s in sorted(found):
                if ranges and s - ranges[-1][1] <= 2 * self.edits[number]:
                    ranges[-1][1] = s
                else:
                    ranges.append([s, s])
            out[number] = [(a, b) for a, b in ranges]
        return out

    def matches(self, text: str) -> Iterator[Found]:
        """Bounded-error matches in ``text`` (words with a space before, between and after)."""
        for number, ranges in self.candidates(text).items():
            notice, k = self.notices[number][0], self.edits[number]
            for first, last in ranges:
                # a start is off by k at most, and a match longer or shorter by k at most
                for start in _boundaries(text, first - k - 1, last + k):
                    a = start + 1
                    for b in _boundaries(text, a + len(notice) - k, a + len(notice) + k):
                        m = self.patterns[number].fullmatch(text, a, b)
                        if m and sum(m.fuzzy_counts) <= k:
                            yield Found(a, b, sum(m.fuzzy_counts), number)

    def best(self, text: str) -> list[Found]:
        """Of overlapping matches the one with the fewest edits (then the longest, then by
        name), in order of place."""
        order = sorted(
            set(self.matches(text)),
            key=lambda f: (f.edits, f.start - f.stop, self.notices[f.notice], f.start),
        )
        starts: list[int] = []
        kept: list[Found] = []
        for f in order:
            at = bisect.bisect_left(starts, f.start)
            clear_left = at == 0 or kept[at - 1].stop <= f.start
            if clear_left and (at == len(kept) or f.stop <= starts[at]):
                starts.insert(at, f.start)
                kept.insert(at, f)
        return kept

    def scan(self, raw: bytes) -> tuple[int, list[tuple[int, str]], list[tuple]]:
        """Words of the text, its exact phrases as (first word, label), and its notices as
        (label, notice, first word, words, edits)."""
        words = ascii_words(raw)
        text = f" {b' '.join(words).decode('utf-8', 'replace')} "
        exact, at_word = [], WordPlaces(text)
        for phrase, label in self.phrases:
            at = text.find(phrase)
            while at >= 0:
                exact.append((at + 1, label))
                at = text.find(phrase, at + 1)
        found = self.best(text)
        spans = [
            (
                self.notices[f.notice][1],
                self.notices[f.notice][0],
                at_word(f.start),
                text.count(" ", f.start, f.stop) + 1,
                f.edits,
            )
            for f in found
        ]
        return len(words), [(at_word(at), label) for at, label in sorted(exact)], spans


class WordPlaces:
    """Word number of a place in a text; places asked in rising order are counted on from
    the one before."""

    def __init__(self, text: str):
        self.text, self.at, self.words = text, 0, -1

    def __call__(self, place: int) -> int:
        if place < self.at:
            self.at, self.words = 0, -1
        self.words += self.text.count(" ", self.at, place)
        self.at = place
        return self.words


def summary(n_words: int, exact: list[tuple[int, str]], spans: list[tuple]) -> tuple:
    """The digest columns: ``score`` is 1 with an exact phrase, else the greatest share of a
    notice's characters that no edit touches, else 0."""
    base = sorted({label for _, label in exact})
    labels = sorted({*base, *(s[0] for s in spans)})
    likeness = [1.0 - s[4] / len(s[1]) for s in spans]
    return (
        n_words,
        len(exact),
        exact[0][0] if exact else None,
        max(at for at, _ in exact) if exact else None,
        ",".join(base),
        ",".join(labels),
        1.0 if exact else max(likeness, default=0.0),
    )


def scan_notices(
    df: DataFrame,
    text_col: str = "text",
    notices: Sequence[tuple[str, str]] = NOTICES,
    phrases: Sequence[tuple[str, str]] = PHRASES,
) -> DataFrame:
    """All columns of ``df`` (under their names, also clashing ones) before the columns of
    ``DIGEST`` and ``spans``: the notices found, with their place and length in words."""
    prepare(df.sparkSession)
    inner, names, _ = sealed(df)
    notices, phrases = tuple(notices), tuple(phrases)
    made = [c.split()[0] for c in DIGEST.split(", ")]
    ready: list[Scanner] = []

    def run(texts: list[bytes]) -> dict[str, object]:
        if not ready:
            ready.append(Scanner(notices, phrases))
        found = [ready[0].scan(t) for t in texts]
        columns = dict(zip(made, zip(*[summary(*f) for f in found])))
        kind = ("label", "notice", "first_word", "n_words", "edits")
        return columns | {"spans": [[dict(zip(kind, s)) for s in spans] for _, _, spans in found]}

    out = append_columns(inner, names[text_col], run, f"{DIGEST}, {SPANS}")
    return out.toDF(*df.columns, *made, "spans")


def notice_digests(docs: DataFrame) -> DataFrame:
    """The scan of every document's whole text: doc_id and the columns of ``DIGEST``."""
    found = scan_notices(docs.select("doc_id", F.col("text").alias("body")), "body")
    return found.drop("body", "spans")
