"""BPE encoding and decoding on contiguous arrays of adjacent ranks.

A word is held as part boundaries and the rank of every adjacent pair of parts. The pair
of lowest rank is found by a scan, the boundary between its parts is deleted, and only the
two neighbouring ranks are looked up again. The short words that a batch meets for the
first time lie side by side as rows of one array, so a scan step advances all of them.
Words of more than ``ROW`` bytes are merged alone, those of more than ``SCAN_PARTS`` with the
same merges in a heap, so one very long word does not cost the square of its length.

Rules: a null or empty text has no ids and decodes to the empty text; rows are handled one
by one, so ties, repeated rows and other columns do not matter; texts are never cut. Python
keeps at most ``CACHE`` encoded words per worker.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re

import numpy as np
import pyarrow as pa
import tokenizers
from pyspark.sql import DataFrame

from loadweave.llm.common import arrow_schema, prepare, texts

SCAN_PARTS = 96
CACHE = 500_000
#: Longest word, in bytes, that shares an array with others, and words in one array.
ROW = 32
ROWS_AT_ONCE = 2048
NO_RANK = 1 << 30


def _byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(spare)) for b in range(256)]


#: Letters, numbers and white space below U+0250 once in lower case. All of these are in
#: normal form C already; any other text goes through the library's own tables.
LETTERS = "a-zªµºß-öø-ɏ"
NUMBERS = "0-9²³¹¼½¾"
SPACE = "\\t-\\r \\x85\\xa0"
LATIN_END = "\u0250"


def latin_pattern(pattern: str) -> re.Pattern:
    """The split pattern of the file with its classes spelled out for such texts."""
    plain = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{SPACE}{LETTERS}{NUMBERS}]")
    return re.compile(plain.replace(r"[\p{L}]", f"[{LETTERS}]").replace(r"[\p{N}]", f"[{NUMBERS}]"))


class WordBpe:
    """A tokenizer file with NFC, lower case, a split pattern and a word-end suffix."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end = model.get("end_of_word_suffix") or ""
        #: Key of a pair of ids: its rank; and by rank, the id that the pair becomes.
        self.ranks: dict[int, int] = {}
        self.made: list[int] = []
        for rank, (a, b) in enumerate(model["merges"]):
            self.ranks[self.vocab[a] << 20 | self.vocab[b]] = rank
            self.made.append(self.vocab[a + b])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in self.vocab.items()}
        self.tokens.update({i: t for t, i in self.special.items()})
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.split = latin_pattern(pattern)
        self.cut = re.compile("|".join(f"({re.escape(s)})" for s in self.special))
        letters = _byte_letters()
        self.letter_byte = {x: b for b, x in enumerate(letters)}
        self.inner = [self.vocab[x] for x in letters]
        self.last = [self.vocab[x + self.end] for x in letters]
        self.inner_row = np.array(self.inner, np.int32)
        self.last_row = np.array(self.last, np.int32)
        library = tokenizers.Tokenizer.from_file(path)
        self.normalizer, self.pre_tokenizer = library.normalizer, library.pre_tokenizer
        keys = np.array([a << 16 | b for a, b in self._pairs(model)], np.uint32)
        self.key_order = np.argsort(keys).astype(np.int32)
        self.keys = keys[self.key_order]
        self.made_row = np.array(self.made, np.int32)
        self.token_bytes = {i: t.encode() for i, t in self.tokens.items()}
        self.words: dict[str, tuple[bytes, bytes]] = {}

    def _pairs(self, model: dict):
        return ((self.vocab[a], self.vocab[b]) for a, b in model["merges"])

    def rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids; NO_RANK where there is none or one is missing (< 0)."""
        key = a.astype(np.uint32) << np.uint32(16) | b.astype(np.uint32)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        known = (self.keys[at] == key) & (a >= 0) & (b >= 0)
        return np.where(known, self.key_order[at], NO_RANK)

    def merge_rows(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each short word: every row scans for its lowest rank at the same time."""
        if not words:
            return []
        size = np.array([len(w) for w in words])
        wide = int(size.max())
        letters = np.frombuffer(b"".join(w.ljust(wide, b"\0") for w in words), np.uint8).reshape(len(words), wide)
        parts = self.inner_row[letters]
        rows, cols = np.arange(len(words)), np.arange(wide)
        parts[rows, size - 1] = self.last_row[letters[rows, size - 1]]
        parts[cols >= size[:, None]] = -1
        parts = np.pad(parts, ((0, 0), (0, 1)), constant_values=-1)
        near = self.rank_of(parts[:, :-1], parts[:, 1:])
        done: list[np.ndarray] = [parts[i] for i in range(len(words))]
        left = rows
        while left.size:
            at = near.argmin(1)
            best = near[np.arange(left.size), at]
            live = best < NO_RANK
            if not live.all():
                for i in np.flatnonzero(~live):
                    done[left[i]] = parts[i]
                left, parts, near, at, best = left[live], parts[live], near[live], at[live], best[live]
                if not left.size:
                    break
            own = np.arange(left.size)
            shift = np.minimum(cols + (cols >= at[:, None] + 1), wide)
            new = self.made_row[best]
            parts[:, :-1] = np.take_along_axis(parts, shift, 1)
            parts[own, at] = new
            shift = np.minimum(cols + (cols >= at[:, None]), wide - 1)
            near = np.take_along_axis(near, shift, 1)
            near[own, at] = self.rank_of(new, parts[own, at + 1])
            back = np.flatnonzero(at)
            near[back, at[back] - 1] = self.rank_of(parts[back, at[back] - 1], new[back])
        return [x[x >= 0] for x in done]

    def merge(self, parts: list[int]) -> list[int]:
        if len(parts) > SCAN_PARTS:
            return self._merge_long(parts)
        rank, made = self.ranks.get, self.made
        near = [rank(a << 20 | b, NO_RANK) for a, b in zip(parts, parts[1:])]
        while near:
            best = min(near)
            if best == NO_RANK:
                break
            i = near.index(best)
            new = parts[i] = made[best]
            del parts[i + 1], near[i]
            if i:
                near[i - 1] = rank(parts[i - 1] << 20 | new, NO_RANK)
            if i < len(near):
                near[i] = rank(new << 20 | parts[i + 1], NO_RANK)
        return parts

    def _merge_long(self, parts: list[int]) -> list[int]:
        n, rank = len(parts), self.ranks.get
        right, left = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def offer(x: int, y: int) -> None:
            if x >= 0 and y < n:
                found = rank(parts[x] << 20 | parts[y])
                if found is not None:
                    heapq.heappush(heap, (found, x, parts[x], parts[y]))

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            best, i, a, b = heapq.heappop(heap)
            j = right[i]
            if parts[i] != a or j >= n or parts[j] != b:
                continue
            parts[i], parts[j] = self.made[best], None
            right[i] = right[j]
            if right[i] < n:
                left[right[i]] = i
            offer(left[i], i)
            offer(i, right[i])
        return [p for p in parts if p is not None]

    def words_of(self, text: str) -> list[str | int]:
        """Words in order, and the ids of special tokens written out in the text."""
        found: list[str | int] = []
        for piece in self.cut.split(text) if "<|" in text else (text,):
            if piece in self.special:
                found.append(self.special[piece])
            elif piece and max(piece) < LATIN_END:
                # lower case letter by letter, as the file's normalizer does
                found += self.split.findall(piece.lower())
            elif piece:
                split = self.pre_tokenizer.pre_tokenize_str(self.normalizer.normalize_str(piece))
                found += [bytes(map(self.letter_byte.__getitem__, w)).decode() for w, _ in split]
        return found

    def learn(self, words: set) -> dict[str, tuple[bytes, bytes]]:
        """(ids as little-endian 32-bit integers, decoded bytes) of each new word."""
        short, ids = [], {}
        for w in words:
            raw = w.encode()
            if len(raw) <= ROW:
                short.append((len(raw), w, raw))
            else:
                parts = [self.inner[b] for b in raw]
                parts[-1] = self.last[raw[-1]]
                ids[w] = np.array(self.merge(parts), np.int32)
        short.sort()
        for i in range(0, len(short), ROWS_AT_ONCE):
            some = short[i : i + ROWS_AT_ONCE]
            ids.update(zip([w for _, w, _ in some], self.merge_rows([raw for *_, raw in some])))
        token = self.token_bytes
        return {
            w: (x.astype("<u4").tobytes(), b" ".join([token[i] for i in x.tolist()]))
            for w, x in ids.items()
        }

    def documents(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """Ids and decoded bytes of every text: its tokens with a space between, as the
        file names no decoder."""
        cut = [self.words_of(t) for t in texts]
        known = self.words
        fresh = self.learn({w for ws in cut for w in ws if type(w) is str and w not in known})
        fresh.update({i: (i.to_bytes(4, "little"), self.token_bytes[i]) for i in self.special.values()})
        out = []
        for ws in cut:
            made = [known.get(w) or fresh[w] for w in ws]
            out.append((b"".join([m[0] for m in made]), b" ".join([m[1] for m in made])))
        if len(known) + len(fresh) > CACHE:
            known.clear()
        known.update((w, m) for w, m in fresh.items() if type(w) is str and len(w) <= ROW)
        return out

    def document(self, text: str) -> tuple[bytes, bytes]:
        return self.documents([text])[0]

    def decode(self, ids: list[int]) -> str:
        return " ".join(self.tokens[i] for i in ids)


_LOADED: dict[str, WordBpe] = {}


def tokenizer(name: str) -> WordBpe:
    """Loaded once per Python worker, from the tokenizers installed there."""
    import public_tokenizers

    path = public_tokenizers.path(name)
    if path not in _LOADED:
        _LOADED[path] = WordBpe(path)
    return _LOADED[path]


def encode_documents(
    docs: DataFrame, name: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Every row's id, its token ids (little-endian 32-bit) and its decoded text."""
    prepare(docs.sparkSession)
    kind = dict(docs.dtypes)[id_col]
    schema = f"`{id_col}` {kind}, ids binary, decoded binary"
    kinds = arrow_schema(schema)

    def run(batches):
        import public_tokenizers  # noqa: F401  the file is found where the task runs

        model = tokenizer(name)
        for batch in batches:
            made = model.documents(texts(batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(kinds.types[0]), pa.array([m[0] for m in made], kinds.types[1]), pa.array([m[1] for m in made], kinds.types[2])],
                schema=kinds,
            )

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def token_digests(
    docs: DataFrame, name: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """n_tokens and SHA-256 of the ids and of the decoded text, without carrying either on."""
    prepare(docs.sparkSession)
    kind = dict(docs.dtypes)[id_col]
    schema = f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    kinds = arrow_schema(schema)

    def run(batches):
        model = tokenizer(name)
        for batch in batches:
            made = model.documents(texts(batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(kinds.types[0]),
                    pa.array([len(m[0]) // 4 for m in made], pa.int64()),
                    pa.array([hashlib.sha256(m[0]).hexdigest() for m in made], pa.string()),
                    pa.array([hashlib.sha256(m[1]).hexdigest() for m in made], pa.string()),
                ],
                schema=kinds,
            )

    return docs.select(id_col, text_col).mapInArrow(run, schema)
