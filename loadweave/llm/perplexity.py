"""Quality rules: plain text rules, then bands of held-out n-gram perplexity for each language.

Each language has two modified Kneser-Ney models of ``ORDER`` letters (lower case, digits as
0), one for each half of its texts; a text's hash says which half, so copies share one. Every
text is counted in the model of its half and scored by that of the other: none is scored by
its own counts. Tasks count the n-grams of their batches, Spark adds them up, and lower
orders count in how many ways an n-gram is continued to the left. Probabilities are joins of
these tables. They are kept as sorted arrays of 64-bit hashes with a directory of leading
bits, and broadcast only if they have at most ``BROADCAST_ROWS`` n-grams (counted first); a
larger model stays a table, and the documents' n-grams are joined to it instead.

A text's perplexity is that of its letters and its end. For each language the logarithms of
all texts that pass the base rules are counted in bins of 0.001. With their quartiles Q1 and
Q3 (``QUARTILES``) the band is from Q1 - ``FENCE`` (Q3 - Q1) to Q3 + ``FENCE`` (Q3 - Q1), the
spread counting as ``LEAST`` at least. Texts of another language go while they are few: where
they are some per cent of a language's letters, its models learn them too.

Rules: a null text is empty and fails the base rules; the null language is a language of its
own; a text whose language has no text in the other half has no perplexity and is rejected by
the base rules alone; rows are judged one by one, so repeated rows are judged alike; an empty
table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loadweave.llm.common import arrow_schema, byte_texts, mix, prepare, sealed, shipped, stored, texts

ORDER = 5
PAD, END = 2, 3
BROADCAST_ROWS = 4_000_000
QUARTILES = (0.25, 0.75)
FENCE = 3.0
LEAST = 0.01
BIN = 1000
#: Letters handled at once inside a batch.
LETTERS = 1 << 20
SYMBOLS = b"#*$%&|<>"
#: Odd 64-bit numbers of the hash: multiples of the golden ratio's fraction, mixed.
FACTORS = mix(np.arange(1, ORDER + 4, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def base_rules(raw: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text's bytes."""
    words = raw.split()  # of bytes: parted by the six ASCII white space characters
    chars = b"".join(words)
    inside = len(chars) if chars.isascii() else len(chars.decode(errors="replace"))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines, repeated = set(), 0
    for line in raw.split(b"\n"):
        if line in lines:
            repeated += 1
        elif line.strip():
            lines.add(line)
    n, again = len(words), 0
    if n > 3:
        ids: dict[bytes, int] = {}
        codes = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
        if len(ids) < n:
            windows = (codes[:-2] * len(ids) + codes[1:-1]) * len(ids) + codes[2:] if len(ids) < 1 << 20 else _named(codes)
            _, where, count = np.unique(windows, return_inverse=True, return_counts=True)
            often = count[where] > 1
            if often.any():
                covered = np.zeros(n, bool)
                for k in range(3):
                    covered[k : k + n - 2] |= often
                again = int(covered.sum())
    return n, inside, symbols, repeated, again


def _named(codes: np.ndarray) -> np.ndarray:
    """One number for each window where three codes do not fit one."""
    _, pair = np.unique(codes[:-1] * (codes.max() + 1) + codes[1:], return_inverse=True)
    return pair[:-1] * (codes.max() + 1) + codes[2:]


def base_failed(n: int, repeat: int) -> bool:
    return n < 50 or 100 * repeat > 50 * n


def letters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each behind ORDER - 1 pads and with its end; and how many
    of each text are scored."""
    lead = chr(PAD) * (ORDER - 1)
    joined = "".join([lead + t.lower() + chr(END) for t in texts])
    codes = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)
    digits = (codes >= 48) & (codes <= 57)
    codes = np.where(digits, np.uint32(48), np.maximum(codes, 1))
    size = np.array([len(t.lower()) + 1 for t in texts], np.int64)
    return codes, size


def gram_hashes(codes: np.ndarray, n: int, part: np.ndarray) -> np.ndarray:
    """Hash of the n code points from each place on and of the model (``part``) at the place:
    a sum of products with odd numbers, whose leading bits are the well mixed ones."""
    size = max(len(codes) - n + 1, 0) if n else len(part)
    h = part[:size] * FACTORS[-1]
    h += FACTORS[n]
    wide = codes.astype(np.uint64) if n else codes
    for k in range(n):
        h += wide[k : k + size] * FACTORS[k]
    return h


def scored_places(size: np.ndarray) -> np.ndarray:
    """First place of the n-gram that ends with each scored letter."""
    each = size + ORDER - 1
    start = np.cumsum(each) - each
    return np.arange(size.sum()) + np.repeat(start - (np.cumsum(size) - size), size)


def parts_of(batch: pa.RecordBatch, name: str | None) -> np.ndarray:
    """The model of every row; all share one where there is no such column."""
    if name is None:
        return np.zeros(batch.num_rows, np.uint64)
    return batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def halves(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    """``docs`` with the model that counts each text (_m) and the one that scores it (_o)."""
    half = F.pmod(F.xxhash64(text_col), F.lit(2)).cast("int")
    lang = F.col(lang_col)
    return docs.withColumns({"_m": F.xxhash64(lang, lang.isNull(), half), "_o": F.xxhash64(lang, lang.isNull(), 1 - half)})


def groups_of(texts: list[str]):
    """Slices of texts with about LETTERS letters."""
    at = total = 0
    for i, t in enumerate(texts):
        total += len(t)
        if total >= LETTERS:
            yield at, i + 1
            at, total = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


def counted(docs: DataFrame, text_col: str, part_col: str | None) -> DataFrame:
    """(m, g, c): every n-gram of ORDER letters of a model and how often it occurs."""

    def count(own: list[str]) -> tuple[np.ndarray, np.ndarray]:
        codes, size = letters(own)
        at = scored_places(size)
        seen = np.zeros(0x110000, bool)
        seen[codes] = True
        alphabet = np.flatnonzero(seen)
        if len(alphabet) <= 4096:  # ORDER numbers of 12 bits fit one
            number = np.zeros(0x110000, np.int64)
            number[alphabet] = np.arange(len(alphabet))
            small = number[codes]
            packed = np.zeros(len(codes) - ORDER + 1, np.int64)
            for k in range(ORDER):
                packed = packed << 12 | small[k : k + len(packed)]
            packed = np.sort(packed[at])
            first = np.flatnonzero(np.append(True, packed[1:] != packed[:-1]))
            n = np.diff(np.append(first, len(packed)))
            grams = np.stack([alphabet[packed[first] >> 12 * (ORDER - 1 - k) & 4095] for k in range(ORDER)], 1)
        else:
            own_part = np.zeros(len(codes), np.uint64)
            _, first, n = np.unique(gram_hashes(codes, ORDER, own_part)[at], return_index=True, return_counts=True)
            grams = np.stack([codes[at[first] + k] for k in range(ORDER)], 1)
        return np.ascontiguousarray(grams.astype(np.uint32)), n

    def run(batches):
        for batch in batches:
            own: dict[int, list[str]] = {}
            for t, m in zip(texts(batch.column(0)), parts_of(batch, part_col).view(np.int64).tolist()):
                if t:
                    own.setdefault(m, []).append(t)
            for m, of in own.items():
                for a, b in groups_of(of):
                    grams, n = count(of[a:b])
                    strings = grams.view(f"<U{ORDER}").ravel().tolist()
                    yield pa.RecordBatch.from_pydict({"m": np.full(len(n), m), "g": pa.array(strings, pa.string()), "c": pa.array(n, pa.int64())})

    rows = docs.select(text_col, *[part_col][: part_col is not None])
    return rows.mapInArrow(run, "m long, g string, c long").groupBy("m", "g").agg(F.sum("c").alias("c"))


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """The three discounts of the modified method; 1/2 each where counts are too few."""
    if not (n1 and n2):
        return 0.5, 0.5, 0.5
    y = n1 / (n1 + 2 * n2)
    one = 1 - 2 * y * n2 / n1
    two = 2 - 3 * y * n3 / n2
    three = 3 - 4 * y * n4 / n3 if n3 else two
    return tuple(min(max(d, 0.05), k - 0.05) for d, k in zip((one, two, three), (1, 2, 3)))


def _discounts(counts: DataFrame) -> DataFrame:
    """(m, _1, _2, _3): ``discounts`` of every model, as columns."""
    few = counts.groupBy("m").agg(*[F.count_if(F.col("c") == i).cast("double").alias(f"n{i}") for i in (1, 2, 3, 4)])
    y = "n1 / (n1 + 2 * n2)"
    made = [f"1 - 2 * {y} * n2 / n1", f"2 - 3 * {y} * n3 / n2", f"if(n3 > 0, 3 - 4 * {y} * try_divide(n4, n3), 2 - 3 * {y} * n3 / n2)"]
    return few.select("m", *[F.expr(f"if(n1 > 0 and n2 > 0, least(greatest({d}, 0.05D), {k}D - 0.05D), 0.5D)").alias(f"_{k}") for k, d in enumerate(made, 1)])


def probabilities(docs: DataFrame, text_col: str = "text", part_col: str | None = None) -> list[tuple[DataFrame, DataFrame]]:
    """For every order: (m, g, p) of the n-grams seen and (m, u, gamma) of their contexts.

    The empty context's gamma is what each unseen letter gets.
    """
    counts = {ORDER: stored(counted(docs, text_col, part_col), "ngrams")}
    for k in range(ORDER - 1, 0, -1):
        shorter = F.expr(f"substring(g, 2, {k})").alias("g")
        counts[k] = stored(counts[k + 1].groupBy("m", shorter).agg(F.count("*").alias("c")), "ngrams")
    vocabulary = counts[1].groupBy("m").agg((F.count("*") + 1).alias("letters"))
    out, lower = [], None
    for k in range(1, ORDER + 1):
        cut = F.when(F.col("c") == 1, F.col("_1")).when(F.col("c") == 2, F.col("_2")).otherwise(F.col("_3"))
        rows = counts[k].join(stored(_discounts(counts[k]), "discounts"), "m").select("m", "g", "c", F.expr(f"substring(g, 1, {k - 1})").alias("u"), cut.alias("cut"))
        contexts = rows.groupBy("m", "u").agg(F.sum("c").alias("total"), F.sum("cut").alias("kept"))
        contexts = contexts.select("m", "u", "total", (F.col("kept") / F.col("total")).alias("gamma"))
        if lower is None:
            contexts = contexts.join(vocabulary, "m").select("m", "u", "total", (F.col("gamma") / F.col("letters")).alias("gamma"))
        contexts = stored(contexts, "contexts")
        own = rows.join(contexts, ["m", "u"]).select(
            "m", "g", F.expr("substring(g, 2)").alias("s"), "gamma", (F.greatest(F.col("c") - F.col("cut"), F.lit(0.0)) / F.col("total")).alias("own")
        )
        if lower is None:
            made = own.select("m", "g", (F.col("own") + F.col("gamma")).alias("p"))
        else:
            made = own.join(lower.select("m", F.col("g").alias("s"), F.col("p").alias("q")), ["m", "s"]).select(
                "m", "g", (F.col("own") + F.col("gamma") * F.col("q")).alias("p")
            )
        lower = stored(made, "probabilities")
        out.append((lower, contexts.select("m", "u", "gamma")))
    return out


class SortedHashes:
    """Values under 64-bit hashes: sorted arrays, found from a directory of leading bits."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order].astype(np.float32)
        self.bits = max(1, int(math.log2(len(keys) + 1)) + 1)
        lead = (self.keys >> np.uint64(64 - self.bits)).astype(np.int64)
        self.start = np.searchsorted(lead, np.arange((1 << self.bits) + 1)).astype(np.int32)

    def find(self, h: np.ndarray) -> np.ndarray:
        """The value of each hash; nan where there is none."""
        if not len(self.keys):
            return np.full(len(h), np.nan, np.float32)
        lead = (h >> np.uint64(64 - self.bits)).view(np.int64)
        at = self.start.take(lead)
        out = self.values.take(at, mode="clip")  # most stand at the first place of their bits
        left = np.flatnonzero(self.keys.take(at, mode="clip") != h)
        out[left] = np.nan
        at, stop, h = at[left] + 1, self.start.take(lead[left] + 1), h[left]
        some = at < stop
        left, at, stop, h = left[some], at[some], stop[some], h[some]
        while left.size:
            hit = self.keys[at] == h
            out[left[hit]] = self.values[at[hit]]
            at = at + 1
            more = ~hit & (at < stop)
            left, at, stop, h = left[more], at[more], stop[more], h[more]
        return out


class Model:
    """Logarithms of probabilities and back-off weights, by order."""

    def __init__(self, grams: list[SortedHashes], backs: list[SortedHashes]):
        self.grams, self.backs = grams, backs

    def log_probability(self, codes: np.ndarray, at: np.ndarray, part: np.ndarray) -> np.ndarray:
        """Of the letter that ends the n-gram of ORDER letters at each place."""
        out = self.grams[-1].find(gram_hashes(codes, ORDER, part)[at])
        left = np.flatnonzero(np.isnan(out))
        weight = np.zeros(len(left), np.float32)
        for k in range(ORDER - 1, 0, -1):  # only for n-grams that no counted text has
            if not left.size:
                break
            end = at[left] + ORDER - 1
            back = self.backs[k].find(gram_hashes(codes, k, part)[end - k])
            weight = weight + np.nan_to_num(back, nan=0.0)
            found = self.grams[k - 1].find(gram_hashes(codes, k, part)[end - k + 1])
            hit = ~np.isnan(found)
            out[left[hit]] = found[hit] + weight[hit]
            left, weight = left[~hit], weight[~hit]
        if left.size:  # nan where the model has counted no text
            out[left] = weight + self.backs[0].find(gram_hashes(codes, 0, part[at[left]]))
        return out

    def log_perplexity(self, own: list[str], part: np.ndarray | None = None) -> np.ndarray:
        out = np.full(len(own), np.nan)
        part = np.zeros(len(own), np.uint64) if part is None else part
        for a, b in groups_of(own):
            codes, size = letters(own[a:b])
            each = np.repeat(part[a:b], size + ORDER - 1)
            logs = self.log_probability(codes, scored_places(size), each).astype(np.float64)
            start = np.cumsum(size) - size
            out[a:b] = -np.add.reduceat(logs, start) / size
        return out


def _hashed(rows: DataFrame, n: int, value: str) -> DataFrame:
    """(h, v): the hash of each model's string of n letters and the logarithm of its value."""

    def run(batches):
        for batch in batches:
            codes = np.frombuffer("".join(batch.column(1).to_pylist()).encode("utf-32-le"), np.uint32)
            part = parts_of(batch, "m")
            h = gram_hashes(codes, n, np.repeat(part, n))[::n] if n else gram_hashes(codes, 0, part)
            logs = np.log(np.maximum(batch.column(2).to_numpy(zero_copy_only=False), 1e-30))
            yield pa.RecordBatch.from_pydict({"h": h.view(np.int64), "v": logs.astype(np.float32)})

    return rows.select("m", rows.columns[1], value).mapInArrow(run, "h long, v float")


def _array(rows: DataFrame) -> SortedHashes:
    got = rows.toArrow()
    return SortedHashes(got.column("h").to_numpy().view(np.uint64), got.column("v").to_numpy())


def collected(tables: list[tuple[DataFrame, DataFrame]]) -> Model | None:
    """The models as arrays, if their counted size keeps within BROADCAST_ROWS."""
    if sum(g.count() for g, _ in tables) > BROADCAST_ROWS:
        return None
    grams = [_array(_hashed(g, k, "p")) for k, (g, _) in enumerate(tables, 1)]
    backs = [_array(_hashed(u, k, "gamma")) for k, (_, u) in enumerate(tables)]
    return Model(grams, backs)


RULES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, log_perplexity double"


def measured(docs: DataFrame, tables: list[tuple[DataFrame, DataFrame]], text_col: str, part_col: str | None = None) -> DataFrame:
    """``docs`` with the base rules' figures and the logarithm of the perplexity by the model ``part_col``."""
    model = collected(tables)
    shared = shipped(docs.sparkSession, model) if model else None
    kinds = arrow_schema(RULES)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            raw = byte_texts(batch.column(text_col))
            base = [base_rules(t) for t in raw]
            failed = [base_failed(b[0], b[4]) for b in base]
            logs = np.full(len(raw), np.nan)
            if shared:
                logs = shared().log_perplexity([t.decode() for t in raw], parts_of(batch, part_col))
            made = [*zip(*base), failed, pa.array(logs, from_pandas=True)]
            made = [x if isinstance(x, pa.Array) else pa.array(x, f.type) for x, f in zip(made, kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*batch.schema.names, *kinds.names])

    rows = docs.mapInArrow(run, StructType([*docs.schema.fields, *StructType.fromDDL(RULES).fields]))
    return rows if shared else _measured_by_join(rows, tables, text_col, part_col)


def _measured_by_join(rows: DataFrame, tables: list[tuple[DataFrame, DataFrame]], text_col: str, part_col: str | None) -> DataFrame:
    """For models too large to broadcast: the distinct n-grams of every text are joined to them,
    and to all lower orders, for those that the model has not counted."""
    part = F.lit(0).cast("long") if part_col is None else F.col(part_col)
    hashed, length = F.xxhash64(text_col), F.coalesce(F.length(text_col), F.lit(0)).cast("long")

    def run(batches):
        for batch in batches:
            for a, n, m, text in zip(*(c.to_pylist() for c in batch.columns)):
                codes, size = letters([text or ""])
                grams = np.lib.stride_tricks.sliding_window_view(codes, ORDER)[scored_places(size)]
                strings, count = np.unique(np.ascontiguousarray(grams).view(f"<U{ORDER}").ravel(), return_counts=True)
                yield pa.RecordBatch.from_pydict({"x": np.full(len(strings), a), "y": np.full(len(strings), n), "m": np.full(len(strings), m), "g": pa.array(strings.tolist(), pa.string()), "n": count})

    own = rows.select(hashed.alias("x"), length.alias("y"), part.alias("m"), text_col)
    asked = own.mapInArrow(run, "x long, y long, m long, g string, n long").groupBy("x", "y", "m", "g").agg(F.max("n").alias("n"))
    known = asked.select("m", "g").distinct().withColumn("p", F.lit(None).cast("double"))
    for k, (grams, contexts) in enumerate(tables, 1):
        known = known.withColumns({"s": F.expr(f"substring(g, {ORDER - k + 1}, {k})"), "u": F.expr(f"substring(g, {ORDER - k + 1}, {k - 1})")})
        known = known.join(grams.select("m", F.col("g").alias("s"), F.col("p").alias("q")), ["m", "s"], "left").join(contexts, ["m", "u"], "left")
        back = F.col("gamma") if k == 1 else F.coalesce("gamma", F.lit(1.0)) * F.col("p")
        known = known.select("m", "g", F.coalesce("q", back).alias("p"))
    value = F.log(F.greatest("p", F.lit(1e-30)))
    known = known.where("p is not null").select("m", "g", value.alias("v"))
    logs = asked.join(known, ["m", "g"]).groupBy("x", "y", "m").agg((-F.sum(F.col("n") * F.col("v")) / F.sum("n")).alias("_log"))
    logs = logs.withColumnRenamed("m", "_of")
    columns = [c for c in rows.columns if c != "log_perplexity"]
    same = (hashed == F.col("x")) & (length == F.col("y")) & (part == F.col("_of"))
    return rows.join(logs, same, "left").select(*columns, F.col("_log").alias("log_perplexity"))


def bands(figures: DataFrame, lang_col: str = "lang") -> DataFrame:
    """(_lang, _low, _high): the band of each language, over texts that pass the base rules."""
    kept = figures.where("not base_failed and log_perplexity is not null")
    bins = kept.groupBy(F.col(lang_col).alias("_lang"), F.floor(F.col("log_perplexity") * BIN).alias("_bin")).agg(F.count("*").alias("_n"))
    bins = stored(bins, "perplexity-bins")
    up = Window.partitionBy("_lang").orderBy("_bin")
    summed = bins.withColumns({"_up": F.sum("_n").over(up), "_all": F.sum("_n").over(Window.partitionBy("_lang"))})
    first, third = (F.min(F.when(F.col("_up") >= q * F.col("_all"), F.col("_bin"))) / BIN for q in QUARTILES)
    reach = FENCE * F.greatest(F.col("_q3") - F.col("_q1"), F.lit(LEAST))
    quartiles = summed.groupBy("_lang").agg(first.alias("_q1"), third.alias("_q3"))
    return quartiles.select("_lang", (F.col("_q1") - reach).alias("_low"), (F.col("_q3") + reach).alias("_high"))


def judged(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", id_col: str = "doc_id", keep: bool = False) -> DataFrame:
    """doc_id, lang, the rules' figures, the language's band and ``kept`` of every row.

    With ``keep``: the kept rows themselves, with all their columns.
    """
    prepare(docs.sparkSession)
    if keep:
        docs, names, back = sealed(docs)
        lang_col, text_col = names[lang_col], names[text_col]
    split = halves(docs, lang_col, text_col)
    tables = probabilities(split, text_col, "_m")
    if not keep:
        split = split.select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), "_m", "_o")
        lang_col, text_col = "lang", "text"
    found = measured(split.drop("_m"), tables, text_col, "_o").drop("_o")
    # scored once and read twice, for the bands and for the verdicts
    rows = slim = stored(found if keep else found.drop(text_col), "rules")
    band = stored(bands(slim, lang_col), "bands")
    joined = rows.join(F.broadcast(band) if band.count() <= 1000 else band, F.col(lang_col).eqNullSafe(F.col("_lang")), "left")
    inside = F.coalesce(F.col("log_perplexity").between(F.col("_low"), F.col("_high")), F.lit(True))
    joined = joined.withColumn("kept", ~F.col("base_failed") & inside)
    if keep:
        return back(joined.where("kept"))
    return joined.drop("_lang")
