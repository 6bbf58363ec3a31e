"""Whitening, licence notices and ranked search on odd tables, against plain Python."""

import collections
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadweave.llm import dual_tree, license_notices, whitening
from loadweave.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def key(row):
    return tuple((x is None, x) for x in row)


# --- op11


def vectors(seed=5, n=120, dims=6):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(c) for c in rng.normal(size=dims) * (np.arange(dims) + 1)]) for i in range(n)]
    hot = rows[3][1]
    rows += [(1000 + i, hot) for i in range(300)] + [(7, rows[7][1]), (None, hot), (None, rows[8][1])]
    bad = [None, [], [1.0, None, 0.0, 0.0, 0.0, 0.0], [float("nan")] * dims, [float("inf")] + [0.0] * (dims - 1)]
    return rows + [(2000 + i, v) for i, v in enumerate(bad)], [r for r in rows]


def expected(rows, weights="one", most=4):
    x = np.array([[math.floor(256 * c) for c in v] for _, v in rows])
    fit, counts = np.unique(x, axis=0, return_counts=True)
    w = np.ones(len(fit)) if weights == "one" else counts.astype(float)
    n, s = int(w.sum()), (w[:, None] * fit).sum(axis=0)
    z = fit - s / n
    e, q = np.linalg.eigh((z * w[:, None]).T @ z / n)
    e, q = e[::-1], q[:, ::-1]
    out = (x - s / n) @ q[:, :most] / np.sqrt(e[:most])
    far = [int(sum((n * int(c) - int(t)) ** 2 for c, t in zip(row, s))) for row in x]
    return n, out, far, e[:most] / e.sum()


@pytest.mark.parametrize("weights", ["one", "count"])
def test_whitening(spark, weights):
    rows, good = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("x", F.lit("clash"))
    got = whitening.whiten(df.withColumn("component", F.lit(0)).repartition(5), weights=weights)
    n, want, far, shares = expected(good, weights)
    found = collections.defaultdict(list)
    for r in got.collect():
        assert r["n"] == n and r["identity_error"] < 1e-9
        assert r["explained"] == pytest.approx(shares[r["component"] - 1], rel=1e-9)
        found[r["component"]].append((r["vec_id"], r["deviation"], r["whitened"]))
    assert sorted(found) == [1, 2, 3, 4]
    for c, got_rows in found.items():
        sign = 0
        for (_, _, a), b in zip(sorted(got_rows, key=lambda r: (r[1], r[0] is None)), sorted(zip(far, want[:, c - 1]))):
            sign = sign or math.copysign(1, a * b[1])
        rows_want = sorted(((i, d, round(sign * v, 7) + 0.0) for (i, _), d, v in zip(good, far, want[:, c - 1])), key=key)
        assert sorted(((i, d, round(v, 7) + 0.0) for i, d, v in got_rows), key=key) == rows_want


def test_whitening_of_little_and_large(spark):
    schema = "vec_id long, embedding array<double>"
    none = spark.createDataFrame([], schema)
    assert whitening.whiten(none).count() == 0
    assert whitening.whiten(none).columns == ["vec_id", *[c.split()[0] for c in whitening.MADE.split(", ")]]
    one = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)
    assert whitening.whiten(one).count() == 0
    line = spark.createDataFrame([(1, [1.0, 2.0]), (2, [2.0, 4.0]), (3, [3.0, 6.0])], schema)
    got = whitening.whiten(line).collect()
    assert [r["component"] for r in got] == [1, 1, 1] and got[0]["explained"] == pytest.approx(1)
    huge = spark.createDataFrame([(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 0.0])], schema)
    assert {r["deviation"] for r in whitening.whiten(huge).collect()} >= {None}
    mixed = spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], schema)
    with pytest.raises(Exception, match="different lengths"):
        whitening.whiten(mixed)


def test_deviations_are_exact():
    rng = np.random.default_rng(1)
    for reach in (10, 10**6, 10**9):
        x = rng.integers(-reach, reach, (50, 3))
        sums = [int(v) for v in x.astype(object).sum(axis=0)]
        want = [sum((50 * int(c) - s) ** 2 for c, s in zip(row, sums)) for row in x]
        assert whitening.deviations(x, 50, sums) == [v if v < 2**63 else None for v in want]
        assert whitening.exact_sums(x, np.full(50, 3)) == [3 * s for s in sums]


# --- op12


def phrase_places(text):
    found = words(text)
    out = []
    for phrase, label in license_notices.PHRASES:
        p = phrase.split()
        out += [(i, label) for i in range(len(found)) if found[i : i + len(p)] == p]
    return len(found), sorted(out)


def least_edits(notice, text):
    """Fewest edits of ``notice`` against any part of ``text`` from word to word, numbers
    unchanged, by plain dynamic programming."""
    best = math.inf
    for m in re.finditer(r"(?<= )(?=[^ ])", text):
        row = list(range(len(notice) + 1))
        if any(c.isdigit() for c in notice):
            for i, c in enumerate(notice):
                row[i + 1] = math.inf if c.isdigit() else row[i] + 1
        for at in range(m.start(), min(len(text) - 1, m.start() + 2 * len(notice))):
            new = [row[0] + 1]
            for i, c in enumerate(notice):
                same = row[i] + (0 if c == text[at] else math.inf if c.isdigit() else 1)
                gone = math.inf if c.isdigit() else new[i] + 1
                new.append(min(same, row[i + 1] + 1, gone))
            row = new
            if text[at + 1] == " ":
                best = min(best, row[-1])
    return best


def edited(rng, notice, edits):
    out = list(notice)
    for _ in range(edits):
        at = rng.randrange(len(out))
        if out[at] in " 0123456789":
            continue
        kind = rng.randrange(3)
        if kind == 0:
            out[at] = rng.choice("abcdefgh")
        elif kind == 1:
            out.insert(at, rng.choice("abcdefgh"))
        else:
            del out[at]
    return "".join(out)


def test_notices_are_found_as_by_dynamic_programming():
    rng = random.Random(11)
    notices = [n for n in license_notices.NOTICES if len(n[0]) < 45][:9]
    scanner = license_notices.Scanner(notices, license_notices.PHRASES)
    hits = 0
    for _ in range(60):
        notice = rng.choice(notices)[0]
        text = f" here is some {edited(rng, notice, rng.randrange(7))} and more words "
        found = {f.notice: f.edits for f in scanner.matches(text)}
        for number, (other, _) in enumerate(notices):
            k = license_notices.edits_allowed(other)
            want = least_edits(other, text)
            assert (number in found) == (want <= k), (other, text, found)
            if want <= k:
                hits += 1
                assert found[number] == want
    assert hits > 40


def test_notice_digests(table_of, odd_rows):
    notices = [
        (60, "Released under the MIT License. Also under the mit-license; CC BY-NC 4.0"),
        (61, "This work is licensed under the GNU General Public License, version 3."),
        (62, "it is licenced under the Apache Licence, Version 2.0 " * 3),
        (63, "GNU General Public License version 4"),
        (64, "Realeased under teh MIT Licence"),
        (65, "ÀUNDER the MIT license, apache\x00license\x7fversion 2"),
        (66, "x " * 200000 + "under the mit license " * 500),
    ]
    rows = odd_rows + notices + [notices[0]]
    got = license_notices.notice_digests(table_of(rows)).collect()
    want = collections.Counter()
    for d, t in rows:
        n, places = phrase_places(t)
        base = ",".join(sorted({label for _, label in places}))
        want[d, n, len(places), places[0][0] if places else None, max(places)[0] if places else None, base] += 1
    assert collections.Counter(tuple(r)[:6] for r in got) == want
    labels = {r["doc_id"]: (r["labels"], r["score"]) for r in got}
    assert labels[61] == ("gpl-3", 1.0)
    assert labels[62][0] == "apache-2" and 0.9 < labels[62][1] < 1
    assert labels[63] == ("", 0.0)
    assert labels[60] == ("cc-by-nc,mit", 1.0) and labels[40] == ("", 0.0)


def test_notice_spans_and_columns(spark):
    df = spark.createDataFrame([("a b gnu lesser genral public license c", 1)], "body string, labels long")
    out = license_notices.scan_notices(df, "body")
    assert out.columns[:2] == ["body", "labels"] and out.columns[-1] == "spans"
    spans = out.select("spans").first()[0]
    assert [tuple(s) for s in spans] == [("lgpl", "gnu lesser general public license", 2, 5, 1)]


def test_places_of_words():
    at = license_notices.WordPlaces(" a bc d ")
    assert [at(1), at(3), at(6), at(1)] == [0, 1, 2, 0]


# --- op13


def ranked(docs, items, k=10):
    found = [(d, words(t)) for d, t in docs]
    found = [(d, collections.Counter(ts), len(ts)) for d, ts in found if ts]
    n_docs, length = len(found), sum(n for _, _, n in found)
    df = collections.Counter(t for _, c, _ in found for t in c)
    out = []
    for item, text in items:
        scores = []
        for d, c, n in found:
            m = 100 - 90 + (90 * n * n_docs) // length
            s = sum(
                dual_tree.weight(n_docs, df[t]) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t in set(words(text))
                if t in c
            )
            if s > 0:
                scores.append((-s, d is None, d or 0, d))
        out += [(item, i + 1, d, -s) for i, (s, _, _, d) in enumerate(sorted(scores)[:k])]
    return out


def searched(spark, docs, items, **kw):
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("n", F.lit("clash"))
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("number", F.lit(1))
    got = dual_tree.search_items(frame.repartition(3), asked, **kw)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in got.collect()), key=key)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "straße"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    docs = [(i, text(rng.randrange(1, 60))) for i in range(250)]
    docs += [(1000 + i, docs[5][1]) for i in range(60)] + [(None, docs[9][1]), (3, docs[3][1])]
    docs += [(2000, None), (2001, ""), (2002, " --\n"), (2003, "W1 w1,w1; É " * 3000)]
    items = [(i, text(rng.randrange(1, 12))) for i in range(40)]
    items += [(100, None), (101, "?!"), (102, "unknown words"), (103, "w1 w1 W1"), (103, "w1 w1 W1"), (None, "w2 w3")]
    return docs, items


def test_search(spark, corpus):
    docs, items = corpus
    assert searched(spark, docs, items) == sorted(ranked(docs, items), key=key)


def test_search_in_small_blocks_and_trees(spark, corpus, monkeypatch):
    docs, items = corpus
    monkeypatch.setattr(dual_tree, "TREE", 32)
    monkeypatch.setattr(dual_tree, "LEAF", 4)
    monkeypatch.setattr(dual_tree, "FAN", 2)
    monkeypatch.setattr(dual_tree, "ITEM_LEAF", 3)
    assert searched(spark, docs, items[:20], block_bytes=200) == sorted(ranked(docs, items[:20]), key=key)
    few = searched(spark, docs, items[20:], k=3, block_bytes=12)  # long items are blocks of their own
    assert few == sorted(ranked(docs, items[20:], 3), key=key)


def test_search_prunes_leaves():
    """With kth scores from a part of the documents most leaves are never scored."""
    rng = np.random.default_rng(2)
    starts = np.arange(0, 4097 * 4, 4)
    terms = np.sort(rng.integers(0, 500, (4096, 1)), axis=0) + rng.integers(0, 3, (4096, 4))
    tree = dual_tree.DocumentTree(starts, terms.ravel(), rng.integers(1, 1000, 4096 * 4))
    block = dual_tree.Block([(i, np.array([i, i + 1])) for i in range(0, 500, 25)], 502, np.arange(502))
    best = dual_tree.Best(np.zeros(20, dtype=np.int64), 10)
    scored = dual_tree.search(tree, np.arange(4096), block, best)
    assert 0 < scored < 50


def test_search_of_empty_tables(spark):
    assert searched(spark, [], [(1, "a")]) == [] and searched(spark, [(1, "a")], []) == []


def test_length_terms_beyond_a_long():
    got = dual_tree.length_terms(np.array([10**9]), 10**10, 10**12)
    assert got[0] == 10 + 90 * 10**19 // 10**12


def test_registered():
    assert {"op11_whitened_vectors", "op12_license_notices", "op13_dual_tree_search"} <= set(QUERIES)
