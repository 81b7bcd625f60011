"""Lexical search, license scan and hard negatives against brute force."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from civicloom.llm import hard_negatives, lexical_search, license_scan, queries
from civicloom.llm.license_rules import compiled

CLASHES = ["item_id", "rank", "score", "term", "part", "node", "x", "shard", "block", "words", "n_words", "base", "anchor", "window", "top"]


def brute_ranked(docs, items, top=50):
    """Each item's rows by the formula, over every document."""
    split = lambda text: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    counted = [(doc, Counter(split(text))) for doc, text in docs]
    counted = [(doc, c) for doc, c in counted if c]
    n_docs, n_terms = len(counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    asked = defaultdict(set)
    for item, text in items:
        asked[item] |= set(split(text))
    found = Counter()
    for item, terms in asked.items():
        scored = []
        for doc, c in counted:
            m = 100 - 50 + 50 * c.total() * n_docs // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                for t in terms if c[t]
            )
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        for i, (score, unnamed, doc) in enumerate(sorted(scored)[:top]):
            found[item, i + 1, None if unnamed else doc, -score] += 1
    return found


def texts(seed, count, words=40):
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["ñandú", "Ünder", "A1"]
    share = 1 / np.arange(1, len(vocabulary) + 1)
    return [", ".join(rng.choice(vocabulary, rng.integers(0, words), p=share / share.sum())) for _ in range(count)]


def test_lexical_search(spark):
    docs = [*enumerate(texts(1, 300)), (None, "w1 w2 w3"), (7, "w1 w1"), (7, "w1 w1"), (900, None), (901, ""), (902, " -- "), (903, "w5 " * 20_000)]
    items = [*enumerate(texts(2, 12, 15)), (3, "w9 w40"), (None, "w1 zzz"), (50, None), (51, "..."), (52, "nowhere"), (53, "ñandú W2")]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3).withColumns({c: F.lit("mine") for c in CLASHES})
    asked = spark.createDataFrame(items, "item_id bigint, text string").withColumn("doc_id", F.lit("mine"))
    got = Counter(tuple(r) for r in lexical_search.ranked(frame, asked).collect())
    assert got == brute_ranked(docs, items)
    assert lexical_search.ranked(frame.limit(0), asked).count() == lexical_search.ranked(frame, asked.limit(0)).count() == 0


def test_items_in_rounds_and_an_index_of_all_terms(spark, monkeypatch):
    docs, items = list(enumerate(texts(3, 150))), list(enumerate(texts(4, 9, 12)))
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(2)
    asked = spark.createDataFrame(items, "item_id bigint, text string")
    monkeypatch.setattr(lexical_search, "TERM_BYTES", 1)
    monkeypatch.setattr(lexical_search, "ITEM_BYTES", 500)
    assert Counter(tuple(r) for r in lexical_search.ranked(frame, asked, 5).collect()) == brute_ranked(docs, items, 5)


@pytest.mark.parametrize("top, block, window, shard_docs", [(3, 4, 16, 400), (5, 2, 7, 60), (50, 128, 4096, 400)])
def test_block_max_search_of_shards(monkeypatch, top, block, window, shard_docs):
    """Small blocks and windows, so that lists become non-essential and candidates are rejected unread."""
    for name, value in (("BLOCK", block), ("WINDOW", window), ("SHARD_DOCS", shard_docs)):
        monkeypatch.setattr(lexical_search, name, value)
    docs, items = list(enumerate(texts(5, 400))), list(enumerate(texts(6, 10, 15)))
    own, shards = lexical_search.Gathered(None), []
    for doc, text in docs:
        own.add(doc, text.encode())
        if own.full():
            shards.append(own.shard())
            own.clear()
    if own.ids:
        shards.append(own.shard())
    rows = [dict(zip(lexical_search._NAMES, s)) for s in shards]
    n_docs, n_terms = sum(r["n_docs"] for r in rows), sum(r["n_terms"] for r in rows)
    df = Counter()
    for r in rows:
        df.update(dict(zip(r["terms"], r["found"])))
    opened = [lexical_search.Shard(r, n_docs, n_terms) for r in rows]
    got = Counter()
    for item, text in items:
        terms = [(t, math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))) for t in set(lexical_search.terms_of(text.encode()))]
        ranking = lexical_search.Ranking(top)
        for shard in opened:
            ranking.add(*shard.best(terms, top, ranking.floor()), shard.ids)
        got.update((item, i + 1, int(doc), int(score)) for i, (score, _, doc) in enumerate(ranking.rows))
    assert got == brute_ranked(docs, items, top)
    if top == 3:
        for shard in opened:
            shard.cache.clear()
            shard.decompressed = 0
        terms = [(t, math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))) for t in (b"w0", b"w1", b"w59")]
        opened[0].best(terms, top, 0)
        assert opened[0].decompressed < sum(-(-opened[0].found[opened[0].number[t]] // block) for t, _ in terms)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 1 << 31), st.integers(1, 1 << 20)), min_size=1, max_size=200, unique_by=lambda x: x[0]))
def test_blocks_round_trip(rows):
    places, tf = map(np.array, zip(*sorted(rows)))
    got = lexical_search.unpack(lexical_search.pack(places, tf), len(rows))
    assert got[0].tolist() == places.tolist() and got[1].tolist() == tf.tolist()


@given(st.lists(st.tuples(st.integers(1, 9), st.integers(1, 9)), min_size=1, max_size=60))
def test_impacts_bound_every_pair(rows):
    tf, n = map(np.array, zip(*rows))
    kept = lexical_search.impacts(tf, n)
    for a, b in rows:
        assert ((tf[kept] >= a) & (n[kept] <= b)).any()
    assert len(np.unique(tf[kept])) == len(kept)


def test_rules():
    rules = compiled()
    assert len(rules) > 300 and len({r.pattern.pattern for r in rules}) == len(rules)
    # A gate that the pattern doesn't need would hide matches.
    for r in rules:
        words = set(re.findall(rb"[a-z0-9]+", r.pattern.pattern.replace(b"licen[cs]e", b"license")))
        assert r.words <= words, r.label


@pytest.mark.parametrize("text, labels", [
    ("Licensed under CC BY-NC 4.0.", ["cc-by-nc-4.0"]),
    ("Released under the MIT License.", ["mit"]),
    ("Licensed under the Apache License, Version 2.0.", ["apache-2.0"]),
    ("This work is licensed under the GNU General Public License, version 3.", ["gpl-3.0"]),
    ("SPDX-License-Identifier: LGPL-2.1-or-later", ["lgpl-2.1-or-later"]),
    ("the GNU Lesser General Public Licence, v 3.0 and the ISC license", ["lgpl-3.0", "isc"]),
    ("See https://creativecommons.org/licenses/by-sa/4.0/ for this", ["cc-by-sa-4.0"]),
    ("GPLv2 or later; BSD 3-Clause License", ["gpl-2.0-or-later", "bsd-3-clause"]),
    ("a licence to print money", []),
])
def test_licenses(text, labels):
    assert [d.label for d in license_scan.Scanner()(text.encode())[2]] == labels


@settings(max_examples=300, deadline=None)
@given(st.lists(st.builds(
    lambda start, size, priority, rule: license_scan.Detection("x", rule, start, start + size, priority, 0.5),
    st.integers(0, 12), st.integers(1, 6), st.integers(1, 3), st.integers(0, 99)), max_size=15))
def test_containment(found):
    found = list({d[2:]: d for d in found}.values())
    found = list({d.rule: d for d in found}.values())

    def loses(d, e):
        inside = e.start <= d.start and d.end <= e.end
        same = (e.start, e.end) == (d.start, d.end)
        return inside and (e.priority > d.priority or e.priority == d.priority and (not same or e.rule < d.rule))

    want = [d for d in found if not any(loses(d, e) for e in found if e is not d)]
    assert sorted(license_scan.resolved(found)) == sorted(want)


def test_license_report(spark):
    filler = " ".join(f"Wörd{i}" for i in range(30_000))
    rows = [
        (1, "MIT License\nMIT license; the Apache-License, CC BY CC-BY"), (2, None), (3, ""), (4, "admit license"), (None, "gnu general\tpublic license"),
        (5, f"{filler} GNU General Public License"), (6, "cc by"), (6, "cc by"), (7, "CC BY-SA 4.0"), (8, "mit licensee"),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3).withColumns({c: F.lit("mine") for c in CLASHES})
    got = Counter(tuple(r)[:7] for r in license_scan.report(docs).collect())
    want = Counter()
    for doc, text in rows:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        places = sorted(
            (i, label) for phrase, label in license_scan.BASE.items() for i in range(len(words))
            if words[i : i + len(phrase.split())] == phrase.decode().split()
        )
        labels = {label for _, label in places}
        found = {d.label for d in license_scan.Scanner()((text or "").encode())[2]}
        want[doc, len(words), len(places), places[0][0] if places else None, places[-1][0] if places else None,
             ",".join(sorted(labels)), ",".join(sorted(labels | found))] += 1
    assert got == want
    assert license_scan.report(docs.limit(0)).count() == 0
    scores = {r.doc_id: r.score for r in license_scan.report(docs).collect()}
    assert scores[2] == 0 and 0 < scores[6] <= 1


def test_license_query_base_columns(spark, sf):
    """The query's rows on the smallest table, by the definition."""
    texts_of = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    got = queries.op12_license_scan(spark, sf).collect()
    assert len(got) == len(texts_of) and sum(r.n_base for r in got) > 0
    for r in got:
        line = " ".join(["", *re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), texts_of[r.doc_id] or "")), ""])
        assert r.n_base == sum(len(re.findall(f"(?= {p.decode()} )", line)) for p in license_scan.BASE)
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def brute_negatives(rows, positives=5, negatives=3):
    rows = [
        (v, label, np.floor(256 * np.array(e, dtype=np.float64)).astype(np.int64)) for v, label, e in rows
        if v is not None and label is not None and e is not None and len(e) == 8 and all(x is not None and math.isfinite(x) and abs(x) < 1e5 for x in e)
    ]
    found = Counter()
    for i, (anchor, label, a) in enumerate(rows):
        if anchor % 50:
            continue
        scored = sorted((-int(a @ x), v, own) for j, (v, own, x) in enumerate(rows) if j != i)
        for p, positive, _ in [s for s in scored if s[2] == label][:positives]:
            inside = [(n, v) for n, v, own in scored if own != label and 50 * -p <= 100 * -n <= 95 * -p]
            for rank, (n, v) in enumerate(inside[:negatives]):
                found[anchor, positive, rank + 1, v, -p, -n] += 1
    return found


@pytest.mark.parametrize("shard_rows, block_anchors", [(8192, 1024), (37, 3)])
def test_hard_negatives(spark, monkeypatch, shard_rows, block_anchors):
    monkeypatch.setattr(hard_negatives, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(hard_negatives, "BLOCK_ANCHORS", block_anchors)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(4, 8))
    rows = [(i, int(rng.integers(0, 4) if i % 3 else 0), (centres[rng.integers(0, 4)] + rng.normal(size=8) * 0.5).astype(np.float32).tolist()) for i in range(700)]
    rows += [(50, 1, rows[50][2]), (800, 9, rows[50][2]), (850, None, rows[1][2]), (900, 1, None), (None, 1, rows[2][2]), (950, 1, [1.0, None] + [0.0] * 6)]
    rows += [(1000, 2, [float("nan")] * 8), (1050, 2, [float("inf")] + [0.0] * 7), (1100, 2, [1e6] + [0.0] * 7), (1150, 2, []), (1200, 2, [0.0] * 8), (1250, 2, [1.0] * 3)]
    rows += [(1300 + i, i % 2, [0.5] * 8) for i in range(60)]  # ties
    df = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<float>").repartition(4).withColumns({c: F.lit("mine") for c in CLASHES})
    got = Counter(tuple(r) for r in hard_negatives.hard_negatives(df, F.col("vec_id") % 50 == 0).collect())
    assert got == brute_negatives(rows) and len(got) > 50
    assert hard_negatives.hard_negatives(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert hard_negatives.hard_negatives(df, F.col("vec_id") < 0).count() == 0


@pytest.mark.parametrize("kind", [np.float64, np.int64])
def test_threshold_search(kind):
    rng = np.random.default_rng(8)
    x = rng.integers(-200, 200, (500, 3)).astype(kind)
    lists = hard_negatives.Lists(x, rng.permutation(500))
    for _ in range(40):
        anchor, allowed = rng.integers(-200, 200, 3).astype(kind), rng.random(500) < 0.8
        low, high = sorted(rng.integers(-60_000, 60_000, 2).tolist())
        (places, scores), (few, _) = lists.search(anchor, allowed, np.array([low, -(1 << 62)]), np.array([high, 1 << 62]), 3)
        own = x @ anchor
        inside = [i for i in np.lexsort((lists.ids, -own)) if allowed[i]]
        assert places.tolist() == [i for i in inside if low <= own[i] <= high][:3] and few.tolist() == inside[:3]
        assert scores.tolist() == own[places].tolist()
    lists.accessed = 0
    for _ in range(20):
        lists.search(rng.integers(-200, 200, 3).astype(kind), np.ones(500, dtype=bool), np.array([-(1 << 62)]), np.array([1 << 62]), 3)
    assert lists.accessed < 20 * 250  # stops early
