"""Token ids in directly addressable codes, written in document order and read back.

An id is split into byte chunks, lowest first. Level k holds, for every id that has more
than k chunks, its k-th chunk and one bit that says whether another follows. A directory
of ones before every block of ``BLOCK`` bits turns a position of level k into one of level
k + 1, so any id, or any run of ids, is read without decoding what lies before it.

A file row (segment) holds whole documents up to about ``SEGMENT_IDS`` ids: the document
ids, their lengths and one coded payload. Documents are dealt to ranges of ascending id and
sorted there; the first id of a range follows from the totals of the ranges before it (one
number per range).

Rules: a null or empty text gives just the end id; null document ids come last; rows that
share a document id are all kept, ordered by their ids; an empty table writes no segment.
"""

from __future__ import annotations

import itertools
import json
import os
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadweave.llm.bpe import _byte_letters
from loadweave.llm.common import arrow_schema, bucket_of, prepare, range_cuts, texts
from loadweave.session import scratch_path

BLOCK = 512
MAGIC = b"DAC1"
SEGMENT_IDS = 1 << 19


def pack(ids: np.ndarray) -> bytes:
    """One payload: magic, number of ids and levels, then each level."""
    levels, rest = [], ids.astype(np.uint32)
    while True:
        more = rest > 255
        bits = np.packbits(more, bitorder="little")
        padded = np.pad(more, (0, -len(more) % BLOCK)).reshape(-1, BLOCK)
        ones = padded.sum(1, dtype=np.uint32)
        ranks = np.concatenate([[0], np.cumsum(ones, dtype=np.uint32)]).astype("<u4")
        levels.append((len(rest), rest.astype(np.uint8).tobytes(), bits.tobytes(), ranks.tobytes()))
        if not more.any():
            break
        rest = rest[more] >> np.uint32(8)
    head = MAGIC + struct.pack("<QI", len(ids), len(levels))
    body = [struct.pack("<Q", n) + chunks + bits + ranks for n, chunks, bits, ranks in levels]
    return head + b"".join(body)


class Reader:
    """Random access to one payload."""

    def __init__(self, payload: bytes):
        if payload[:4] != MAGIC:
            raise ValueError("not a payload of directly addressable codes")
        self.n, count = struct.unpack_from("<QI", payload, 4)
        at, self.levels = 16, []
        for _ in range(count):
            (n,) = struct.unpack_from("<Q", payload, at)
            at += 8
            chunks = np.frombuffer(payload, np.uint8, n, at)
            at += n
            bits = np.frombuffer(payload, np.uint8, -(-n // 8), at)
            at += -(-n // 8)
            ranks = np.frombuffer(payload, "<u4", -(-n // BLOCK) + 1, at)
            at += 4 * len(ranks)
            self.levels.append((chunks, bits, ranks))

    def rank(self, level: int, i: int) -> int:
        """Ones among the first i continuation bits of a level."""
        _, bits, ranks = self.levels[level]
        block, inside = divmod(i, BLOCK)
        found = int(ranks[block])
        if inside:
            some = np.unpackbits(bits[block * BLOCK // 8 : i // 8 + 1], bitorder="little")
            found += int(some[:inside].sum())
        return found

    def get(self, i: int) -> int:
        value = 0
        for k, (chunks, bits, _) in enumerate(self.levels):
            value |= int(chunks[i]) << (8 * k)
            if not bits[i >> 3] >> (i & 7) & 1:
                break
            i = self.rank(k, i)
        return value

    def slice(self, start: int, stop: int) -> np.ndarray:
        out = np.zeros(stop - start, np.uint32)
        where = np.arange(stop - start)
        for k, (chunks, bits, _) in enumerate(self.levels):
            if stop <= start:
                break
            out[where] |= chunks[start:stop].astype(np.uint32) << np.uint32(8 * k)
            some = np.unpackbits(bits[start // 8 : -(-stop // 8)], bitorder="little")
            more = some[start % 8 : start % 8 + stop - start].astype(bool)
            where = where[more]
            start = self.rank(k, start)
            stop = start + len(where)
        return out


#: Letters, numbers and spaces of these ranges are the same in every Unicode table at hand.
SETTLED = re.compile("[^\x00-\u024f\u2000-\u206f]")


class ByteBpe:
    """Ids of a byte-level tokenizer file, as the tokenizers library gives them.

    The same merges are made by tiktoken, which is several times faster; a text with letters
    outside the SETTLED ranges goes to the library itself.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letter = {x: b for b, x in enumerate(_byte_letters())}
        vocab = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        # a merge's rank is its place; merged ids rise with it, so ids can serve as ranks
        ranks = {bytes(map(letter.__getitem__, t)): i for t, i in vocab.items() if t not in self.special}
        made = [vocab[a + b] for a, b in spec["model"]["merges"]]
        level = spec["pre_tokenizer"]
        plain = level == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
        self.fast = None
        if plain and spec["normalizer"] is None and made == sorted(made):
            self.fast = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=self.special)

    def encode(self, texts: list[str]) -> list[list[int]]:
        out: list = [None] * len(texts)
        slow = []
        for i, t in enumerate(texts):
            if self.fast is None or SETTLED.search(t):
                slow.append(i)
            elif any(s in t for s in self.special):
                out[i] = self.fast.encode(t, allowed_special="all")
            else:
                out[i] = self.fast.encode_ordinary(t)
        for i, coded in zip(slow, self.library.encode_batch_fast([texts[i] for i in slow], add_special_tokens=False)):
            out[i] = coded.ids
        return out


#: Fixed value: how byte-level tokenizer files part words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_TOKENIZERS: dict[str, ByteBpe] = {}


def byte_tokenizer(name: str) -> ByteBpe:
    """Once per worker, and without threads of the library's own."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    import public_tokenizers

    if name not in _TOKENIZERS:
        _TOKENIZERS[name] = ByteBpe(public_tokenizers.path(name))
    return _TOKENIZERS[name]


def token_rows(docs: DataFrame, name: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """_id and the ids with the end id, as little-endian integers of 2 or 4 bytes."""
    schema = "_id long, _wide boolean, _ids binary"
    kinds = arrow_schema(schema)

    def run(batches):
        model = byte_tokenizer(name)
        for batch in batches:
            own = texts(batch.column(1))
            made = []
            for i in range(0, len(own), 256):
                made += [np.array([*ids, end_id], np.uint32) for ids in model.encode(own[i : i + 256])]
            wide = [bool(x.max() > 0xFFFF) for x in made]
            raw = [x.astype("<u4" if w else "<u2").tobytes() for x, w in zip(made, wide)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(wide), pa.array(raw, kinds.types[2])],
                schema=kinds,
            )

    return docs.select(id_col, text_col).mapInArrow(run, schema)


SEGMENTS = "bucket int, first long, doc_ids array<long>, lengths array<long>, payload binary"


def write_tokens(
    docs: DataFrame,
    path: str,
    name: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Write the segments of ``docs`` in ascending document order below ``path``."""
    spark = prepare(docs.sparkSession)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = range_cuts(docs, id_col, parts)
    kinds = arrow_schema(SEGMENTS)

    def segments(batches):
        """Streams the sorted documents of a range; holds one segment at a time."""
        held: list[np.ndarray] = []
        ids: list = []
        bucket, first, size = None, 0, 0

        def flush():
            rows = [[bucket], [first - size], [ids], [[len(x) for x in held]], [pack(np.concatenate(held))]]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows, kinds.types)], schema=kinds)

        for batch in batches:
            for own, doc, wide, raw in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if held and (own != bucket or size >= SEGMENT_IDS):
                    yield flush()
                    held, ids, size = [], [], 0
                if own != bucket:
                    bucket, first = own, 0
                x = np.frombuffer(raw, "<u4" if wide else "<u2").astype(np.uint32)
                held.append(x)
                ids.append(doc)
                size += len(x)
                first += len(x)
        if held:
            yield flush()

    (
        token_rows(docs, name, end_id, id_col, text_col)
        .withColumn("_bucket", bucket_of("_id", cuts))
        .select("_bucket", "_id", "_wide", "_ids")
        .repartitionById(len(cuts) + 1, "_bucket")
        .sortWithinPartitions("_bucket", F.asc_nulls_last("_id"), "_ids")
        .mapInArrow(segments, SEGMENTS)
        .write.option("compression", "zstd")
        .parquet(path)
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids (little-endian 32-bit) of every document on file."""
    return _read(spark, path, "ids binary", lambda x: x.astype("<u4").tobytes())


def _read(spark: SparkSession, path: str, column: str, digest) -> DataFrame:
    prepare(spark)
    files = spark.read.schema(SEGMENTS).parquet(path)
    totals = {
        r["bucket"]: r["n"]
        for r in files.groupBy("bucket")
        .agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))
        .collect()  # a number for each range
    }
    order = sorted(totals)
    base = dict(zip(order, itertools.accumulate([0, *(totals[b] for b in order)])))
    schema = f"doc_id long, start long, n_tokens long, {column}"
    kinds = arrow_schema(schema)

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                reader, at, found = Reader(row["payload"]), 0, []
                start = base[row["bucket"]] + row["first"]
                for doc, n in zip(row["doc_ids"], row["lengths"]):
                    found.append((doc, start + at, n, digest(reader.slice(at, at + n))))
                    at += n
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*found), kinds.types)], schema=kinds)

    return files.mapInArrow(run, schema)


def token_file_digests(
    docs: DataFrame,
    name: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Write the token file of ``docs`` and digest every document as it is read back."""
    path = scratch_path(docs.sparkSession, "token-file")
    write_tokens(docs, path, name, end_id, id_col, text_col)
    crc = _read(docs.sparkSession, path, "ids_crc32 long", lambda x: zlib.crc32(x.astype("<u4").tobytes()))
    return crc.withColumnRenamed("doc_id", id_col)
