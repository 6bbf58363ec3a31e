"""Every operator on a small odd table, against plain Python."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from tests.llm import brute

from loadweave.llm import (
    bloom_sketch,
    bpe,
    budget_mix,
    compression_quality,
    dac,
    perplexity,
    simhash_links,
    suffix_dedup,
    token_counts,
)

KEY = lambda r: tuple((x is not None, x) for x in r)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=KEY)


def test_suffix_dedup(table_of, odd_rows):
    want = sorted(brute.repeats(odd_rows), key=KEY)
    assert rows_of(suffix_dedup.dedup_digests(table_of(odd_rows))) == want


def test_suffix_dedup_compares_windows_between_blocks(table_of, odd_rows, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "GROUP", 2)
    monkeypatch.setattr(suffix_dedup, "BLOCK", 500)
    want = sorted(brute.repeats(odd_rows), key=KEY)
    assert rows_of(suffix_dedup.dedup_digests(table_of(odd_rows))) == want


def test_suffix_dedup_of_low_complexity(table_of):
    rows = [(1, "a" * 900), (2, "ab" * 400), (3, "a" * 199), (4, "a" * 200 + "b"), (5, "abc" * 90)]
    assert rows_of(suffix_dedup.dedup_digests(table_of(rows))) == sorted(brute.repeats(rows))


@pytest.mark.parametrize("letters", [1, 2, 26])
def test_block_suffixes_are_in_order(letters):
    rng = np.random.default_rng(letters)
    base = rng.integers(97, 97 + letters, 1500).astype(np.uint8).tobytes()
    data = b"".join(base[i : i + 400] for i in rng.integers(0, 1000, 6))
    at = np.arange(len(data) - 199)
    windows = [data[i : i + 200] for i in suffix_dedup.BlockSuffixes(data).ordered(at)]
    assert windows == sorted(windows) and len(windows) == len(at)
    flags = suffix_dedup.repeated_windows(data, at)
    whole = [data[i : i + 200] for i in at]
    assert [bool(f & 1) for f in flags] == [whole.count(w) > 1 for w in whole]


def test_difference_cover_has_every_difference():
    d = suffix_dedup.difference_cover()
    assert {int((a - b) % suffix_dedup.COVER) for a in d for b in d} == set(range(suffix_dedup.COVER))


def test_remove_repeats_keeps_columns(table_of, odd_rows):
    docs = table_of(odd_rows)
    left = suffix_dedup.remove_repeats(docs)
    assert left.columns == docs.columns
    bare = {(r["doc_id"], r["n_chars"]): r["text"] for r in left.collect()}
    assert len(bare) == len(odd_rows)
    assert bare[1, 0] is None and bare[4, 3] == "one"
    assert bare[40, 19] == ""


def test_simhash_components(table_of, odd_rows):
    want = sorted(brute.components(odd_rows), key=KEY)
    found = simhash_links.near_components(table_of(odd_rows))
    got = found.select("doc_id", simhash_links.hex_fingerprint("_fp"), "component_id")
    assert rows_of(got) == want


def test_simhash_links_of_dense_groups(spark, monkeypatch):
    monkeypatch.setattr(simhash_links, "CHUNK", 40)
    rng = random.Random(1)
    points = set()
    for centre in (rng.getrandbits(64), rng.getrandbits(64)):
        for _ in range(150):
            x = centre
            for b in rng.sample(range(64), rng.randrange(0, 8)):
                x ^= 1 << b
            points.add(x)
    points = sorted(points)
    root = list(range(len(points)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(points):
        for j in range(i):
            if (a ^ points[j]).bit_count() <= 4:
                root[find(i)] = find(j)
    want = {}
    for i, a in enumerate(points):
        want.setdefault(find(i), set()).add(a)
    marked = spark.createDataFrame([(i, simhash_links._long(a)) for i, a in enumerate(points)], "_id long, _fp long")
    got = {}
    for r in simhash_links.component_of(marked).collect():
        got.setdefault(r["_root"], set()).add(r["_fp"] % (1 << 64))
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_allocation_covers_all_pairs():
    """Thresholds sum to BITS - m + 1, so that no pair within BITS is lost."""
    sample = np.random.default_rng(0).integers(0, 1 << 63, 300).astype(np.uint64)
    for m in (2, 3, 4, 5):
        groups = [list(range(k * 64 // m, (k + 1) * 64 // m)) for k in range(m)]
        assert sum(simhash_links.allocate(groups, sample, 10**6)[1]) == simhash_links.BITS - m + 1


def test_probes_are_the_values_near_each_fingerprint(spark):
    points = spark.createDataFrame([(0b1011,), (-1,)], "_fp long")
    got = simhash_links.probes(points, [(0, 0b0011, [0]), (3, 0b1100, [0, 0b0100, 0b1000])])
    want = [(0, 3, 11), (3, 8, 11), (3, 12, 11), (3, 0, 11), (0, 3, -1), (3, 12, -1), (3, 8, -1), (3, 4, -1)]
    assert rows_of(got) == sorted(want)


def test_keep_one_of_each(table_of, odd_rows):
    docs = table_of(odd_rows)
    kept = simhash_links.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    parts = {c for *_, c in brute.components(odd_rows)}
    assert kept.count() == len({(f, c) for _, f, c in brute.components(odd_rows)} & {(f, c) for d, f, c in brute.components(odd_rows) if d == c}) == len(parts)


def test_bpe(table_of, odd_rows):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for d, t in odd_rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want.append((d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert rows_of(bpe.token_digests(table_of(odd_rows), "word_bpe_49k.json")) == sorted(want, key=KEY)


def test_bpe_long_words_equal_short_ones():
    model = bpe.tokenizer("word_bpe_49k.json")
    word = [model.inner[b] for b in b"internationalisation" * 8]
    scan, heap = list(word), list(word)
    saved, bpe.SCAN_PARTS = bpe.SCAN_PARTS, 10_000
    try:
        assert model.merge(scan) == model._merge_long(heap)
    finally:
        bpe.SCAN_PARTS = saved


def test_token_counts(table_of, odd_rows):
    model = token_counts.load("piece_bpe_32k.model")
    want = [(d, len((t or "").encode()), n := len(model.encode(t or "")), n > 50) for d, t in odd_rows]
    got = token_counts.count_tokens(table_of(odd_rows), "piece_bpe_32k.model", limit=50)
    assert rows_of(got) == sorted(want, key=KEY)


def test_token_file(table_of, odd_rows):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = sorted(odd_rows, key=lambda r: (r[0] is None, r[0] or 0))
    coded = [np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4") for _, t in rows]
    got = rows_of(dac.token_file_digests(table_of(odd_rows), "byte_bpe_50k.json", end_id=2).orderBy("start"))
    got.sort(key=lambda r: r[1])
    at = 0
    for (d, start, n, _), (want, _) in zip(got, rows):
        assert d == want and start == at
        at += n
    assert sorted((r[0] is None, r[0], r[3]) for r in got if r[0]) == sorted((False, d, zlib.crc32(x.tobytes())) for (d, _), x in zip(rows, coded) if d)
    assert at == sum(map(len, coded))


def test_directly_addressable_codes():
    ids = np.random.default_rng(5).integers(0, 1 << 20, 3000).astype(np.uint32)
    ids[::7] = 3
    reader = dac.Reader(dac.pack(ids))
    assert [reader.get(i) for i in range(0, 3000, 37)] == ids[::37].tolist()
    for a, b in ((0, 3000), (511, 513), (7, 7), (1234, 2048)):
        assert reader.slice(a, b).tolist() == ids[a:b].tolist()
    assert len(dac.Reader(dac.pack(ids[:0])).slice(0, 0)) == 0


def test_versions(table_of, odd_rows):
    got = bloom_sketch.version_fingerprints(table_of(odd_rows)).collect()
    want = sorted(brute.versions(odd_rows), key=KEY)
    assert sorted((tuple(r)[:3] for r in got), key=KEY) == want
    one = bloom_sketch.version_fingerprints(table_of([(7, "abc")])).collect()
    assert tuple(one[0])[:3] == brute.versions([(7, "abc")])[0]


def test_likeness_is_the_share_of_common_paragraphs(table_of, odd_rows):
    from collections import Counter

    def share(a, b):
        a, b = (Counter(x for p in bloom_sketch.PARAGRAPH.findall(t) if (x := p.strip())) for t in (a, b))
        either = sum((a | b).values())
        return sum((a & b).values()) / either if either else 1.0

    many = "\n\n".join(f"paragraph {k % 700}" for k in range(900))
    rows = [*odd_rows, (80, many), (79, many.replace("paragraph 5", "other 5")), (78, many)]
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] is not None, r[1] or ""))
    want = []
    for i, (d, t) in enumerate(order):
        t, other = t or "", order[(i + 1) % len(order)][1] or ""
        k = len(t) // 3
        want.append((d, share(t, t[: len(t) - k] + other[:k]), share(t, other)))
    got = bloom_sketch.version_fingerprints(table_of(rows)).collect()
    assert sorted(((r["doc_id"], r["near_edited"], r["near_next"]) for r in got), key=KEY) == sorted(want, key=KEY)
    mark = {r["doc_id"]: r["fingerprint"] for r in got}
    assert mark[78] == mark[80] != mark[79]


def test_sketch_recovers_any_difference():
    rng = np.random.default_rng(2)
    for common, a, b in ((0, 0, 0), (50, 1, 0), (10, 40, 90), (0, 3000, 1), (5000, 10, 10)):
        keys = rng.integers(0, 1 << 63, common + a + b).astype(np.uint64)
        mine, other = bloom_sketch.difference(keys[: common + a], np.concatenate([keys[:common], keys[common + a :]]))
        assert sorted(mine) == sorted(keys[common : common + a])
        assert sorted(other) == sorted(keys[common + a :])


def test_mix(table_of, odd_rows):
    rows = [r for r in odd_rows if len(r[1] or "") < 5000] + [(100 + i, "w " * (i % 17 + 1)) for i in range(300)]
    docs = table_of(rows)
    got = budget_mix.mix(docs).collect()
    assert sorted(map(tuple, got), key=KEY) == rows_of(budget_mix.mix(docs))
    by = {}
    for r in got:
        assert r["size"] == 0 == r["taken"] or r["taken"] % r["size"] == 0 and r["taken"] <= 2 * r["size"]
        by.setdefault(r["source"], []).append(r)
    sizes = {s: sum(r["size"] for r in rs) for s, rs in by.items()}
    goal = brute.targets(sizes, [5, 2, 1], 1.5 * sum(sizes.values()))
    for s, rs in by.items():
        assert {r["target"] for r in rs} == {goal[s]} and {r["source_size"] for r in rs} == {sizes[s]}
        assert abs(sum(r["taken"] for r in rs) - goal[s]) <= max(3, 0.02 * goal[s])
    mixed = budget_mix.mixed_rows(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r["taken"] // r["size"] for r in got if r["size"]) + sum(1 for r in mixed.where("length(trim(coalesce(text, ''))) = 0 or text rlike '^[ \\n\\t]*$'").collect())


def test_targets_share_what_full_sources_cannot_take(spark):
    goal = brute.targets({"a": 10, "b": 100, None: 1000}, [5, 2, 1], 1665)
    assert goal["a"] == 20 and goal["b"] == 200 and goal[None] == 1445
    rng = random.Random(8)
    many = {f"{rng.choice(['s', 'é', '日', ''])}{i}": int(rng.paretovariate(0.7)) for i in range(400)}
    for sizes in ({"a": 10, "b": 100, None: 1000}, {**many, None: 7, "": 0, "big": 10**7}, {"a": 0, None: 0}, {None: 5}, {}):
        table = spark.createDataFrame(list(sizes.items()), "_source string, _source_size long").repartition(3)
        for share in (1.5, 2.0, 5.0):
            got = {r["_source"]: r["_target"] for r in budget_mix.targets(table, (5, 2, 1), share).collect()}
            want = brute.targets(sizes, [5, 2, 1], share * sum(sizes.values()))
            assert got.keys() == want.keys() and all(got[s] == pytest.approx(want[s], rel=1e-12) for s in want)


@pytest.mark.parametrize("seed", range(4))
def test_knapsack_is_exact(seed):
    rng = np.random.default_rng(seed)
    lengths = np.unique(rng.integers(1, 60, 8))
    counts = rng.integers(1, 4, len(lengths))
    sums = {0}
    for n, c in zip(lengths.tolist(), counts.tolist()):
        sums = {s + k * n for s in sums for k in range(c + 1)}
    for budget in (0, 1, 37, 100, 10**4):
        took = budget_mix.knapsack(lengths, counts, budget)
        assert (took <= counts).all() and (took * lengths).sum() == max(s for s in sums if s <= budget)
    assert (budget_mix.fit(lengths, counts, 50) <= counts).all()


def test_base_rules_and_bands(table_of, odd_rows):
    docs = table_of(odd_rows)
    got = perplexity.judged(docs).collect()
    want = sorted(((d, *brute.base_rules(t)) for d, t in odd_rows), key=KEY)
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert sorted((tuple(r[n] for n in names) for r in got), key=KEY) == want
    assert not any(r["kept"] for r in got if r["base_failed"])
    kept = perplexity.judged(docs, keep=True)
    assert kept.columns == docs.columns and kept.count() == sum(r["kept"] for r in got)


def kneser_ney(texts):
    """Log perplexities by the definition, with dictionaries."""
    from collections import Counter, defaultdict

    n = perplexity.ORDER
    padded = ["\x02" * (n - 1) + "".join("0" if c in "0123456789" else c for c in t.lower()) + "\x03" for t in texts]
    counts = {n: Counter(p[i : i + n] for p in padded for i in range(len(p) - n + 1))}
    for k in range(n - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    cut = {k: perplexity.discounts(*(sum(c == i for c in counts[k].values()) for i in (1, 2, 3, 4))) for k in counts}
    total, gamma = defaultdict(int), defaultdict(float)
    for k in counts:
        for g, c in counts[k].items():
            total[g[:-1]] += c
            gamma[g[:-1]] += cut[k][min(c, 3) - 1]

    def p(g):
        if not g:
            return 1 / (len(counts[1]) + 1)
        c = counts[len(g)][g]
        own = max(c - cut[len(g)][min(c, 3) - 1], 0) if c else 0
        return (own + gamma[g[:-1]] * p(g[1:])) / total[g[:-1]]

    return [-np.mean([np.log(p(x[i : i + n])) for i in range(len(x) - n + 1)]) for x in padded]


@pytest.mark.parametrize("rows", [10**9, 0], ids=["broadcast", "joined"])
def test_perplexity_by_the_definition(table_of, monkeypatch, rows):
    monkeypatch.setattr(perplexity, "BROADCAST_ROWS", rows)
    texts = ["abc abd abc", "the cat sat on the mat 12", "a", "zzzz zzzz", ""]
    docs = table_of(list(enumerate(texts)))
    tables = perplexity.probabilities(docs)
    got = {r["doc_id"]: r["log_perplexity"] for r in perplexity.measured(docs, tables, "text").collect()}
    want = kneser_ney([t for t in texts if t])
    for i, w in enumerate(want):
        assert got[i] == pytest.approx(w, abs=1e-4)


def test_unseen_text_backs_off(table_of):
    docs = table_of([(1, "abc abd abc"), (2, "xyz")])
    model = perplexity.collected(perplexity.probabilities(docs))
    seen, unseen = model.log_perplexity(["abc abd abc", "qqq 日"])
    assert np.isfinite(unseen) and unseen > seen


def test_compression_classifier(spark, table_of):
    rng = random.Random(4)
    good = ["the quiet river", "a long road", "she said that", "morning light on"]
    bad = ["BUY NOW!!", "$$$ free $$$", "click ### here", "&&& win"]
    rows = [(i, " ".join(rng.choice(good if i % 2 else bad) + f" {rng.randrange(99)}" for _ in range(80))) for i in range(400)]
    docs = table_of([*rows, (900, None), (None, "x"), (901, "")])
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(400)] + [(None, 1, 0), (77, None, 0)], "doc_id long, quality int, toxic int")
    model = compression_quality.fit(docs, labels)
    got = compression_quality.score(docs, model).collect()
    held = [r for r in got if r["held_out"] and r["doc_id"] < 400]
    assert sum(r["predicted"] == r["doc_id"] % 2 for r in held) >= 0.95 * len(held)
    for r in got:
        assert 0 <= r["score"] <= 1 and r["held_out"] == brute.crc_held_out(r["doc_id"])
    flat = compression_quality.fit(docs, labels.where("quality = 1"))
    assert {r["score"] for r in compression_quality.score(docs, flat).collect()} == {1.0}


def test_a_repeated_labelled_id_counts_once(spark, table_of):
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice(["calm", "river", "night"] if i % 2 else ["BUY", "###", "win"]) for _ in range(60))) for i in range(120)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(120)], "doc_id long, quality int")
    plain = compression_quality.fit(table_of(rows), labels)
    hot = compression_quality.fit(table_of(rows + rows[7:9] * 400 + [(7, None)] * 50), labels)
    assert hot.pair == plain.pair
    texts = [t.encode() for _, t in rows] + [b""]
    assert np.array_equal(hot.score(texts), plain.score(texts))
    none = table_of(rows).where("doc_id = 999")
    assert compression_quality.score(none, compression_quality.fit(none, labels)).count() == 0


def test_empty_tables(table_of):
    none = table_of([(1, "x")]).where("doc_id = 2")
    assert suffix_dedup.dedup_digests(none).count() == 0
    assert simhash_links.near_components(none).count() == 0
    assert bpe.token_digests(none, "word_bpe_49k.json").count() == 0
    assert token_counts.count_tokens(none, "piece_bpe_32k.model").count() == 0
    assert dac.token_file_digests(none, "byte_bpe_50k.json", end_id=2).count() == 0
    assert bloom_sketch.version_fingerprints(none).count() == 0
    assert budget_mix.mix(none).count() == 0
    assert perplexity.judged(none).count() == 0


def prose_of(rng, syllables, n):
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4))) for _ in range(n))


@pytest.mark.parametrize("rows", [10**9, 0], ids=["broadcast", "joined"])
def test_bands_reject_other_languages_and_shuffled_letters(spark, monkeypatch, rows):
    monkeypatch.setattr(perplexity, "BROADCAST_ROWS", rows)
    rng = random.Random(5)
    of = {lang: ["".join(rng.choices(letters, k=3)) for _ in range(60)] for lang, letters in (("en", "abcdefghijkl"), ("fr", "efghimnopqrs"), (None, "stuvwxyzaeio"))}
    made = [(lang, prose_of(rng, of[lang], rng.randrange(60, 200))) for lang in of for _ in range(100)]
    wrong = [("en", prose_of(rng, of["fr"], 100)) for _ in range(3)]
    shuffled = [("fr", "".join(rng.sample(t, len(t)))) for t in (prose_of(rng, of["fr"], 100) for _ in range(3))]
    lone = [("xx", prose_of(rng, of["en"], 100))] * 2
    all_rows = [(i, lang, t) for i, (lang, t) in enumerate([*made, *wrong, *shuffled, *lone])]
    docs = spark.createDataFrame(all_rows, "doc_id long, lang string, text string").repartition(3)
    got = {r["doc_id"]: r for r in perplexity.judged(docs).collect()}
    n = len(made)
    assert len(got) == len(all_rows) and not any(got[i]["kept"] for i in range(n, n + 6))
    assert sum(got[i]["kept"] for i in range(n)) >= 0.98 * n
    assert all(got[i]["kept"] and got[i]["log_perplexity"] is None for i in (n + 6, n + 7))
