"""Removal of every byte that a repeated 200-byte string covers, by blockwise suffix sorting.

1. Anchors. Of the 169 places in a window of 200 bytes where 32 bytes can start, the one of
   least hash is the window's anchor: equal windows have the same anchor at the same place.
   Consecutive windows with one anchor make a record; only its hashes are shuffled. Windows
   whose anchor's 32 bytes occur once in all documents are unique and go no further.
2. Records that are equal as a whole are settled by counting. What is left are the ends of
   repeated passages: there the distinct contexts of an anchor are sent, as text, to a block.
3. Blocks are suffix-sorted by a difference cover: the suffixes at positions whose remainder
   lies in the cover are ranked once, then one bucket of the other suffixes (a range of
   leading bytes) is sorted at a time; suffixes that agree in their first ``COVER`` bytes are
   put in order by the ranks a few bytes on, where both lie in the cover. Neighbours that
   agree in 200 bytes are repeated.
4. An anchor with more than ``GROUP`` contexts is dealt to several blocks; the windows of
   these are then also compared between blocks, by the hashes of what each block holds.

Rules: texts are UTF-8 bytes, a null is empty; matches never cross documents; rows that are
equal in id and text are documents of their own, so all of them match; texts under 200 bytes
keep all bytes; an empty table gives no rows. Rows are told apart by id and a hash of the text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadweave.llm.common import arrow_schema, byte_texts, mix, prepare, sealed, stored

LENGTH = 200
GRAM = 32
#: Period of the difference cover and its square root; comparisons by rank start within it.
COVER, STEP = 64, 8
#: Bytes of text hashed at once, sorted at once (whole blocks, so up to GROUP contexts of at most
#: 368 bytes more), suffixes of a bucket, contexts of a block.
PIECE = 1 << 18
BLOCK = 1 << 20
BUCKET = 1 << 16
GROUP = 12_000


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20_007)
    letters = rng.integers(0, 1 << 64, 256, np.uint64)
    odd = np.uint64(0x9E3779B97F4A7C15)
    inverse = np.uint64(pow(int(odd), -1, 1 << 64))
    size = PIECE + 2 * LENGTH + 1
    up = np.concatenate([[np.uint64(1)], np.cumprod(np.full(size, odd, np.uint64))])
    down = np.concatenate([[np.uint64(1)], np.cumprod(np.full(size, inverse, np.uint64))])
    return letters, up, down


_TABLES: list = []


def tables():
    if not _TABLES:
        _TABLES.append(_tables())
    return _TABLES[0]


class Rolling:
    """Hashes of any substrings of a piece of text, from sums of weighted letters."""

    def __init__(self, data: np.ndarray):
        letters, self.up, self.down = tables()
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(letters[data] * self.up[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        body = (self.sums[stop] - self.sums[start]) * self.down[start]
        return mix(body + (stop - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def grams(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return mix((self.sums[size:] - self.sums[:n]) * self.down[:n])


def window_runs(data: np.ndarray, ends: np.ndarray):
    """Runs of windows with one anchor: first window, number, place of the anchor in the
    first, hash of the anchor, hash of all bytes of the run. ``ends``: for each byte, the end
    of its document. Windows start before ``PIECE``."""
    n = len(data)
    if n < LENGTH:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty.view(np.uint64), empty.view(np.uint64)
    rolling = Rolling(data)
    grams = rolling.grams(GRAM)
    bits = np.uint64(20)
    least = (grams >> bits << bits) | np.arange(len(grams), dtype=np.uint64)
    places, have = LENGTH - GRAM + 1, 1
    while 2 * have <= places:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    if have < places:
        rest = places - have
        least = np.minimum(least[:-rest], least[rest:])
    starts = np.arange(n - LENGTH + 1)
    anchor = (least & np.uint64((1 << 20) - 1)).astype(np.int64)
    good = starts + LENGTH <= ends[: len(starts)]
    anchor[~good] = -1
    edge = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
    stop = np.append(edge[1:], len(anchor))
    real = anchor[edge] >= 0
    first, stop = edge[real], stop[real]
    at = anchor[first]
    return first, stop - first, at - first, grams[at], rolling.of(first, stop - 1 + LENGTH)


def pieces(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts joined to pieces of about PIECE bytes: the bytes, and for each byte its
    document, its place there and the end of its document in the piece. A longer text is cut
    so that every window of it lies in exactly one piece."""
    held: list[tuple[int, int, bytes]] = []
    size = 0

    def joined():
        data = np.frombuffer(b"".join(t for *_, t in held), np.uint8)
        n = np.array([len(t) for *_, t in held])
        end = np.cumsum(n)
        place = np.arange(len(data)) - np.repeat(end - n - np.array([s for _, s, _ in held]), n)
        return data, np.repeat([d for d, *_ in held], n), place, np.repeat(end, n)

    for doc, text in enumerate(texts):
        for at in range(0, max(len(text) - LENGTH + 1, 0), PIECE - LENGTH):
            part = text[at : at + PIECE - 1]
            if size + len(part) > PIECE and held:
                yield joined()
                held, size = [], 0
            held.append((doc, at, part))
            size += len(part)
    if held:
        yield joined()


RECORDS = "doc long, at long, shape int, anchor long, body long"


def row_keys(docs: DataFrame, id_col: str, text_col: str):
    whole = dict(docs.dtypes)[id_col] in ("tinyint", "smallint", "int", "bigint")
    own = F.coalesce(F.col(id_col).cast("long"), F.lit(-1)) if whole else F.xxhash64(id_col)
    return own, F.hash(F.col(text_col), F.col(id_col).isNull())


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """_doc and _tag tell the rows apart: the id (its hash, if no integer) and a text hash."""
    own, tag = row_keys(docs, id_col, text_col)
    return docs.select(
        F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), own.alias("_doc"), tag.alias("_tag")
    )


def records(rows: DataFrame) -> DataFrame:
    """(doc, at, shape, anchor, body) of every run of windows with one anchor.

    ``at`` holds the text hash above the first window's place, ``shape`` the number of
    windows and the place of the anchor; ``body`` is the hash of all bytes of the run.
    """
    kinds = arrow_schema(RECORDS)

    def run(batches):
        for batch in batches:
            doc = batch.column(1).to_numpy(zero_copy_only=False)
            tag = batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64) << 32
            for data, owner, place, ends in pieces(byte_texts(batch.column(0))):
                first, n, off, anchor, body = window_runs(data, ends)
                own = owner[first]
                made = (doc[own], tag[own] | place[first], (n << 8 | off).astype(np.int32), anchor.view(np.int64), body.view(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in made], schema=kinds)

    return rows.select("_text", "_doc", "_tag").mapInArrow(run, RECORDS)


def difference_cover() -> np.ndarray:
    """Remainders such that every difference occurs between two of them: 0..STEP-1 and the
    multiples of STEP. (Any d is a multiple of STEP less some s < STEP.)"""
    return np.unique(np.concatenate([np.arange(STEP), np.arange(0, COVER, STEP)]))


def cover_shifts(cover: np.ndarray) -> np.ndarray:
    """[r, s]: how far to go from remainders r and s until both lie in the cover."""
    inside = np.zeros(COVER, bool)
    inside[cover] = True
    shift = np.zeros((COVER, COVER), np.int64)
    for r in range(COVER):
        for s in range(COVER):
            shift[r, s] = next(k for k in range(COVER) if inside[(r + k) % COVER] and inside[(s + k) % COVER])
    return shift


SHIFTS = cover_shifts(difference_cover())


def _renamed(name: np.ndarray, more: np.ndarray) -> np.ndarray:
    """Names in the order of (name, more), the same where both are the same."""
    order = np.lexsort((more, name))
    step = (more[order][1:] != more[order][:-1]) | (name[order][1:] != name[order][:-1])
    out = np.empty_like(name)
    out[order] = np.append(0, np.cumsum(step))[: len(name)]
    return out


class BlockSuffixes:
    """Suffixes of one block of text in order, as far as ``LENGTH`` bytes tell them apart."""

    def __init__(self, data: bytes):
        padded = data + bytes(LENGTH + COVER + 8)
        self.words = np.ndarray(len(padded) - 7, ">u8", padded, strides=(1,)).astype(np.uint64)
        self.n = len(data)
        self.rank = self._cover_ranks()

    def _cover_ranks(self) -> np.ndarray:
        """Rank of every cover position among all of them; positions past the end rank 0.

        The names by COVER bytes are doubled (a cover position plus COVER is one again)
        until all differ, so that comparisons by rank never contradict each other.
        """
        inside = np.zeros(COVER, bool)
        inside[difference_cover()] = True
        at = np.flatnonzero(np.resize(inside, self.n))
        rank = np.zeros(self.n + COVER, np.int64)
        name = np.zeros(len(at), np.int64)
        for k in range(0, COVER, 8):  # by 8 bytes, 16 bytes, ...: each sorts the names so far
            name = _renamed(name, self.words[at + k])
        reach = COVER
        while reach < 2 * self.n and name.max(initial=0) + 1 < len(name):
            rank[at] = name + 1
            beyond = at + reach
            name = _renamed(name, np.where(beyond < self.n, rank[np.minimum(beyond, self.n)], 0))
            reach *= 2
        rank[at] = name + 1
        return rank

    def less(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether suffix i comes before j, for suffixes that agree in COVER bytes."""
        shift = SHIFTS[i % COVER, j % COVER]
        return self.rank[i + shift] < self.rank[j + shift]

    def ordered(self, at: np.ndarray) -> np.ndarray:
        """The suffixes at ``at`` in order, one bucket of leading bytes after another."""
        lead = self.words[at]
        cuts = np.sort(lead)[::BUCKET][1:]
        bucket = np.searchsorted(np.unique(cuts), lead, side="right")
        order = np.argsort(bucket, kind="stable")
        edge = np.append(0, np.cumsum(np.bincount(bucket)))
        return np.concatenate([self._bucket(at[order[a:b]]) for a, b in zip(edge, edge[1:])])

    def _bucket(self, at: np.ndarray) -> np.ndarray:
        tie = np.zeros(len(at), np.int64)
        for k in range(0, COVER, 8):
            word = self.words[at + k]
            order = np.lexsort((word, tie))
            at, tie, word = at[order], tie[order], word[order]
            tie = np.append(0, np.cumsum((tie[1:] != tie[:-1]) | (word[1:] != word[:-1])))
        return self._ties(at, tie) if len(at) else at

    def _ties(self, at: np.ndarray, tie: np.ndarray) -> np.ndarray:
        """Merge sort of all ties at once: in every round each element counts, by bisection,
        how many of the neighbouring run come before it."""
        start = np.flatnonzero(np.append(True, tie[1:] != tie[:-1]))
        size = np.diff(np.append(start, len(tie)))
        run = 1
        while run < size.max():
            wide = np.flatnonzero(np.repeat(size > run, size))
            base, local, n = start[tie[wide]], wide - start[tie[wide]], size[tie[wide]]
            mine = local // run
            other = base + (mine ^ 1) * run
            low = np.zeros(len(wide), np.int64)
            high = np.clip(n - (mine ^ 1) * run, 0, run)
            own, right = at[wide], (mine & 1).astype(bool)
            while (open_ := low < high).any():
                k = np.flatnonzero(open_)
                mid = (low[k] + high[k]) >> 1
                x = at[other[k] + mid]
                # of equals, those of the left run come first
                before = np.where(right[k], ~self.less(own[k], x), self.less(x, own[k]))
                low[k] = np.where(before, mid + 1, low[k])
                high[k] = np.where(before, high[k], mid)
            at = at.copy()
            at[base + (mine & ~1) * run + local % run + low] = own
            run *= 2
        return at

    def same(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether LENGTH bytes at i and j agree."""
        alive = np.arange(len(i))
        for k in range(0, LENGTH, 8):
            alive = alive[self.words[i[alive] + k] == self.words[j[alive] + k]]
        out = np.zeros(len(i), bool)
        out[alive] = True
        return out


def repeated_windows(data: bytes, at: np.ndarray) -> np.ndarray:
    """For each window start in ``at``: whether its 200 bytes start at another one too; and
    for repeated ones, whether it is the first of its kind in suffix order."""
    suffixes = BlockSuffixes(data)
    order = suffixes.ordered(at)
    equal = suffixes.same(order[:-1], order[1:])
    found = np.append(equal, False) | np.append(False, equal)
    first = np.append(True, ~equal)
    flags = np.zeros(len(data) + 1, np.uint8)
    flags[order] = found | first.astype(np.uint8) << 1
    return flags[at]


CONTEXTS = "anchor long, part int, parts int, alone boolean, doc long, at long, n int, bytes binary"
#: A run of repeated windows (last null), or a distinct window of an anchor in many blocks.
FINDINGS = "doc long, at long, n int, anchor long, window long, open boolean"


def contexts(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes of every wanted run of windows, sliced where the document is."""
    listed = wanted.groupBy("doc", F.shiftright("at", 32).cast("int").alias("tag")).agg(
        F.collect_list(F.struct("anchor", "part", "parts", "alone", "at", "n")).alias("_runs")
    )
    joined = rows.join(listed, (rows["_doc"] == listed["doc"]) & (rows["_tag"] == listed["tag"]))
    kinds = arrow_schema(CONTEXTS)

    def run(batches):
        for batch in batches:
            for text, doc, runs in zip(byte_texts(batch.column(0)), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                out = []
                for r in runs:
                    at = r["at"] & 0xFFFFFFFF
                    out.append((r["anchor"], r["part"], r["parts"], r["alone"], doc, r["at"], r["n"], text[at : at + r["n"] - 1 + LENGTH]))
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), kinds.types)], schema=kinds)

    return joined.select("_text", "doc", "_runs").mapInArrow(run, CONTEXTS)


def compare_blocks(blocks: DataFrame, partitions: int) -> DataFrame:
    """Suffix-sort whole blocks, several at a time up to BLOCK bytes of text."""
    kinds = arrow_schema(FINDINGS)

    def compared(rows: list[tuple]):
        data = b"".join(r[7] for r in rows)
        n = np.array([r[6] for r in rows])
        size = np.array([len(r[7]) for r in rows])
        base = np.cumsum(size) - size
        inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        at = np.repeat(base, n) + inner
        flags = repeated_windows(data, at)
        owner = np.repeat(np.arange(len(rows)), n)
        alone = np.array([r[3] for r in rows])
        hit = (flags & 1).astype(bool) & alone[owner]
        # runs of repeated windows within one context
        edge = np.flatnonzero(hit & ~(np.append(False, hit[:-1]) & np.append(False, owner[1:] == owner[:-1])))
        last = np.flatnonzero(hit & ~(np.append(hit[1:], False) & np.append(owner[1:] == owner[:-1], False)))
        doc = np.array([r[4] for r in rows])
        place = np.array([r[5] for r in rows])
        own = owner[edge]
        none = np.zeros(len(edge), np.int64)
        yield doc[own], place[own] + inner[edge], (last - edge + 1).astype(np.int32), none, none, none.astype(bool), True
        split = np.array([r[2] > 1 for r in rows])
        if split.any():
            k = np.flatnonzero(split[owner] & (flags >> 1 & 1).astype(bool))
            own, start = owner[k], at[k]
            window = np.empty(len(k), np.uint64)
            raw = np.frombuffer(data, np.uint8)
            for i in range(0, len(raw), PIECE):
                some = (start >= i) & (start < i + PIECE)
                rolling = Rolling(raw[i : i + PIECE + LENGTH])
                window[some] = rolling.of(start[some] - i, start[some] - i + LENGTH)
            anchor = np.array([r[0] for r in rows])
            # a context known to be repeated as a whole needs no answer
            left = ~(flags[k] & 1).astype(bool) & alone[own]
            yield doc[own], place[own] + inner[k], np.ones(len(k), np.int32), anchor[own], window.view(np.int64), left, False

    def emit(rows):
        for doc, at, n, anchor, window, left, done in compared(rows):
            arrays = [pa.array(doc, pa.int64()), pa.array(at, pa.int64()), pa.array(n, pa.int32()), pa.array(anchor, pa.int64())]
            arrays.append(pa.nulls(len(doc), pa.int64()) if done else pa.array(window, pa.int64()))
            arrays.append(pa.array(left, pa.bool_()))
            yield pa.RecordBatch.from_arrays(arrays, schema=kinds)

    def run(batches):
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if size >= BLOCK and row[:2] != held[-1][:2]:
                    yield from emit(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[7])
        if held:
            yield from emit(held)

    return (
        blocks.repartition(partitions, "anchor", "part")
        .sortWithinPartitions("anchor", "part", "doc", "at")
        .mapInArrow(run, FINDINGS)
    )


def repeated_runs(rows: DataFrame) -> DataFrame:
    """(doc, at, n): runs of n windows, every one of them repeated; each such window is in one."""
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    every = records(rows)
    often = stored(every.groupBy("anchor").agg(F.count("*").alias("_n")).where("_n > 1").select("anchor"), "anchors")
    marked = stored(every.join(often, "anchor"), "anchor-runs")
    n = F.shiftright("shape", 8)
    kinds = stored(
        marked.groupBy("anchor", "body").agg(
            F.count("*").alias("copies"), F.min(F.struct("doc", "at", n.alias("n"))).alias("one")
        ),
        "run-kinds",
    )
    whole = marked.join(kinds.where("copies > 1").select("anchor", "body"), ["anchor", "body"]).select("doc", "at", n.alias("n"))
    mixed = stored(
        kinds.groupBy("anchor").agg(F.count("*").alias("k"), F.min("copies").alias("least")).where("least = 1 and k > 1"),
        "mixed-anchors",
    )
    parts = F.ceil(F.col("k") / GROUP).cast("int")
    wanted = kinds.join(mixed, "anchor").select(
        "anchor",
        F.pmod("body", parts).cast("int").alias("part"),
        parts.alias("parts"),
        (F.col("copies") == 1).alias("alone"),
        "one.doc",
        "one.at",
        "one.n",
    )
    found = stored(compare_blocks(contexts(rows, wanted), partitions), "findings")
    within = found.where("window is null").select("doc", "at", "n")
    windows = found.where("window is not null")
    met = stored(
        windows.groupBy("anchor", "window").agg(F.count("*").alias("_n")).where("_n > 1").select("anchor", "window"),
        "met-windows",
    )
    across = windows.where("open").join(met, ["anchor", "window"]).select("doc", "at", "n")
    return whole.unionByName(within).unionByName(across)


def spans(runs: list) -> list[tuple[int, int]]:
    """Maximal covered byte ranges of runs (first window, number of windows)."""
    out: list[list[int]] = []
    for at, n in sorted(runs):
        stop = at + n - 1 + LENGTH
        if out and at <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([at, stop])
    return [(a, b) for a, b in out]


def runs_of_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc, tag and ``_runs``: the repeated windows of a row as (at, n) structs."""
    runs = repeated_runs(keyed(docs, id_col, text_col))
    return runs.groupBy("doc", F.shiftright("at", 32).cast("int").alias("tag")).agg(
        F.collect_set(F.struct(F.col("at").bitwiseAND(F.lit(0xFFFFFFFF)).alias("at"), "n")).alias("_runs")
    )


def dedup_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes, n_removed, n_spans and the SHA-256 of what is kept, for every row."""
    prepare(docs.sparkSession)
    rows = keyed(docs, id_col, text_col)
    listed = runs_of_rows(docs, id_col, text_col)
    joined = rows.join(listed, (rows["_doc"] == listed["doc"]) & (rows["_tag"] == listed["tag"]), "left")
    schema = f"`{id_col}` {dict(docs.dtypes)[id_col]}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    kinds = arrow_schema(schema)

    def run(batches):
        for batch in batches:
            out = []
            for doc, text, runs in zip(batch.column(0).to_pylist(), byte_texts(batch.column(1)), batch.column(2).to_pylist()):
                cut = spans([(r["at"], r["n"]) for r in runs or ()])
                kept = hashlib.sha256(_kept(text, cut)).hexdigest()
                out.append((doc, len(text), sum(b - a for a, b in cut), len(cut), kept))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), kinds.types)], schema=kinds)

    return joined.select("_id", "_text", "_runs").mapInArrow(run, schema)


def _kept(text: bytes, cut: list[tuple[int, int]]) -> bytes:
    if not cut:
        return text
    edges = [0, *(x for span in cut for x in span), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs``; repeated bytes are gone from the text.

    A cut inside a letter drops the letter's other bytes too, so the text stays valid UTF-8.
    A null text stays null.
    """
    prepare(docs.sparkSession)
    docs, inner, back = sealed(docs)
    id_col, text_col = inner[id_col], inner[text_col]
    listed = runs_of_rows(docs, id_col, text_col)
    own, tag = row_keys(docs, id_col, text_col)
    runs = listed.select(F.col("doc").alias("_rdoc"), F.col("tag").alias("_rtag"), "_runs")
    joined = docs.join(runs, (own == F.col("_rdoc")) & (tag == F.col("_rtag")), "left")
    names, at = list(docs.columns), docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            made = []
            for text, runs in zip(batch.column(at).cast(pa.binary()).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
                if runs:
                    text = _kept(text, spans([(r["at"], r["n"]) for r in runs])).decode(errors="ignore").encode()
                made.append(text)
            columns = list(batch.columns[:-1])
            columns[at] = pa.array(made, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return back(joined.select(*docs.columns, "_runs").mapInArrow(run, docs.schema))

