"""Operators on awkward tables: nulls, empty and long texts, ties, repeated rows, clashing names, empty tables."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from civicloom.llm import (
    embedding_dedup, html_text, language_id, line_dedup, minhash, mixing, packing, quality_model, quality_rules, queries, simhash, tokens,
    toxicity,
)
from civicloom.session import stage_table

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that operators use inside.
CLASHES = ["row", "key", "copy", "n", "words", "fp", "score", "text_key", "h1", "place", "list", "node", "lost", "salt", "TAKEN"]
LINE = "this line is long enough to count"


def rows():
    body = "the cat sat on the mat and looked at the moon while rain fell on the roof of the house by the sea"
    found = [(i, f"{body} {i} " + " ".join(f"w{i}x{j}" for j in range(40)), "en", f"src{i % 4}", 9) for i in range(40)]
    found += [(100 + i, f"{LINE}\nown {i} line that nobody else has got\n  {LINE.upper()} ", "en", "src1", 9) for i in range(5)]
    found += [(200, None, None, None, None), (201, "", "", "", 0), (202, " \n\t", "de", "web", 3)]
    found += [(None, LINE, "en", "src2", 5), (300, LINE, None, "src3", 5), (300, LINE, None, "src3", 5), (300, "other", "en", "src3", 5)]
    found += [(400, "long " * 30_000, "en", "src1", 9), (401, "word" * 20_000, "fr", "src1", 9)]
    return found


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(rows(), DOCS).repartition(3)
    return stage_table(df.withColumns({c: F.lit("mine") for c in CLASHES}), "awkward")


@pytest.fixture(scope="module")
def labels(spark):
    found = [(i, int(i % 5 > 0), int(i % 5 == 0)) for i in range(40)] + [(3, 0, 1), (None, 1, 0), (7, None, None)]
    return spark.createDataFrame(found, "doc_id bigint, quality int, toxic int")


def held_out(doc_id):
    import zlib

    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def counts(df, *columns):
    return Counter(tuple(r[c] for c in columns) for r in df.select(*columns).collect())


def test_line_dedup(docs):
    got = counts(line_dedup.line_report(docs), "doc_id", "n_lines", "n_dropped", "kept_sha256")
    keys, want = defaultdict(set), Counter()

    def key(line):
        return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))

    for doc, text, *_ in rows():
        for line in (text or "").split("\n"):
            if len(key(line)) >= 20 and doc is not None:
                keys[key(line)].add(doc)
    for doc, text, *_ in rows():
        lines = (text or "").split("\n")
        kept = [x for x in lines if doc is None or len(keys[key(x)]) < 3 or max(keys[key(x)]) == doc]
        want[(doc, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest())] += 1
    assert got == want


def test_line_dedup_splits_hot_keys(spark, docs, monkeypatch):
    whole = counts(line_dedup.line_report(docs), "doc_id", "n_dropped", "kept_sha256")
    monkeypatch.setattr(line_dedup, "PIECE_ROWS", 2)
    monkeypatch.setattr(line_dedup, "HOT_BINS", 0)
    assert counts(line_dedup.line_report(docs), "doc_id", "n_dropped", "kept_sha256") == whole


def test_dropped_lines_leave_the_rest_of_the_row(docs):
    got = line_dedup.drop_repeated_lines(docs)
    assert got.columns == docs.columns and got.count() == docs.count()
    first = got.filter("doc_id = 100").first()
    assert first.text == "own 0 line that nobody else has got" and first.n_chars == len(first.text) and first.key == "mine"
    assert got.filter("doc_id = 200 AND text IS NULL").count() == 1


def test_packing(docs):
    found = packing.pack_documents(docs).collect()
    encode = tokens.encoder()
    by_sequence = defaultdict(list)
    for r in found:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for parts in by_sequence.values():
        ends = np.cumsum([0, *[n for _, n in sorted(parts)]])
        assert [a for a, _ in sorted(parts)] == ends[:-1].tolist() and ends[-1] <= 2048
    lengths = Counter()
    for doc, text, *_ in rows():
        lengths[doc] += len(encode(text or "")) + 1
    packed = Counter()
    for r in found:
        packed[r.doc_id] += r.length
    assert packed == lengths


def test_packing_reaches_the_bound(spark):
    """On the given table of sf0.01 the plan needs no sequence more than all ids do."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    packed = stage_table(packing.pack_documents(docs), "packed")
    ids, used = packed.agg(F.sum("length"), F.countDistinct("sequence_id")).first()
    assert used == -(-ids // 2048)


def test_packed_sequences_round_trip(docs):
    pieces = stage_table(tokens.token_pieces(docs.filter("doc_id IN (0, 1, 400)"), 2048, with_ids=True), "ids")
    packed = packing.pack_pieces(pieces)
    whole = {r.sequence_id: r.ids for r in packing.sequences(packed).collect()}
    for doc, text, *_ in rows():
        if doc in (0, 1, 400):
            mine = sorted((r for r in packed.collect() if r.doc_id == doc), key=lambda r: r.piece)
            ids = [i for r in mine for i in whole[r.sequence_id][r.offset : r.offset + r.length]]
            assert ids == [*tokens.encoder()(text).tolist(), 0]


def _components(ids, near):
    root = list(range(len(ids)))
    for i in range(len(ids)):
        for j in range(i):
            if near(i, j) and root[i] != root[j]:
                root = [root[j] if r == root[i] else r for r in root]
    return root


@pytest.mark.parametrize("pairs", [32, 1])
def test_simhash_links(spark, monkeypatch, pairs):
    """Fingerprints one, two and three bits apart, through pairs and through shared neighbours."""
    monkeypatch.setattr(simhash, "CELL_PAIRS", pairs)
    rng = np.random.default_rng(4)
    found = [0, (1 << 64) - 1]
    for base in rng.integers(0, 1 << 63, 30).tolist():
        found += [base, base ^ 1, base ^ 0b110, base ^ (0b111 << 20), base ^ (1 << 63) ^ (1 << 5) ^ (1 << 40)]
    signed = sorted({v - (1 << 64) if v >> 63 else v for v in found})
    edges = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp bigint")).collect()
    pairs_of = {(r.a, r.b) for r in edges}
    distance = lambda a, b: bin((a ^ b) % (1 << 64)).count("1")
    assert all(distance(a, b) <= 2 for a, b in pairs_of)
    want = _components(signed, lambda i, j: distance(signed[i], signed[j]) <= 2)
    at = {v: i for i, v in enumerate(signed)}
    got = _components(signed, lambda i, j: (signed[i], signed[j]) in pairs_of or (signed[j], signed[i]) in pairs_of)
    assert len(at) == len(signed) and [want.index(r) for r in want] == [got.index(r) for r in got]


def test_simhash_rows(docs):
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(rows())
    by_print = defaultdict(set)
    for r in got:
        by_print[r.fingerprint].add(r.component_id)
    assert all(len(c) == 1 for c in by_print.values())
    zero = [r for r in got if r.fingerprint == "0" * 16]
    assert {r.doc_id for r in zero} >= {200, 201, 202} and {r.component_id for r in zero} == {200}


def test_one_row_of_each_group_stays(docs):
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = counts(kept, "doc_id")
    assert ids[(200,)] == 1 and ids[(201,)] == 0 and ids[(None,)] == 0 and sum(ids.values()) == len(simhash_groups(docs))


def simhash_groups(docs):
    return {r.root for r in simhash.grouped(docs).select("root").collect()}


def _shingles(text):
    words = text.encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, min(len(words), 1)))}


@pytest.mark.parametrize("piece", [256, 5])
def test_pipeline_drops_near_copies(spark, sf, monkeypatch, piece):
    """Texts with a few words changed, one large group of them, and texts that share less."""
    monkeypatch.setattr(minhash, "PIECE", piece)
    rng = np.random.default_rng(9)
    texts = []
    for size in (150, 400):
        for copies in (40, *[2] * 60):
            base = [f"w{k}" for k in rng.integers(0, 5000, size)]
            for changed in rng.choice([0, 1, 2, 4, 8, 30], copies):
                words = list(base)
                for k in rng.integers(0, size, changed):
                    words[k] = f"x{rng.integers(0, 10**6)}"
                texts.append(" ".join(words))
    sets = list(map(_shingles, texts))
    near = lambda i, j: 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])
    root = _components(texts, near)
    want = {root.index(r) for r in root}
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    got = {r.doc_id for r in dict(corpus_pipeline.STAGES)[corpus_pipeline.STAGES[2][0]](spark, df, sf).collect()}
    print("kept", len(got), "right", len(want), "of", len(texts))
    assert got == want


def _share(capacity, weights, budget):
    """Water filling by hand."""
    given, open_ = dict.fromkeys(capacity, 0), set(capacity)
    while open_:
        level = (budget - sum(given.values())) / sum(weights[k] for k in open_)
        full = {k for k in open_ if capacity[k] <= level * weights[k]}
        if not full:
            return given | {k: level * weights[k] for k in open_}
        given |= {k: capacity[k] for k in full}
        open_ -= full
    return given


def test_shortages_go_to_siblings_first(spark):
    sizes = [("a", "en", "s1", 100), ("a", "en", "s2", 1000), ("a", "de", "s1", 900), ("b", "en", "s1", 50), ("b", "en", "s2", 60)]
    df = spark.createDataFrame(sizes, "domain string, language string, source string, n_tokens bigint")
    targets = mixing.Targets(50, 2, 7, mixing.numbered_domain, {"a": 1, "b": 1}, {"en": 3, "de": 1}, {"*": 1})
    got = {(r.domain, r.language, r.source): r.budget for r in mixing.leaf_budgets(df, targets).collect()}
    top = _share({"a": 4000, "b": 220}, {"a": 1, "b": 1}, 1055)
    language = _share({"en": 2200, "de": 1800}, {"en": 3, "de": 1}, top["a"])
    source = _share({"s1": 200, "s2": 2000}, {"s1": 1, "s2": 1}, language["en"])
    assert abs(got["a", "en", "s2"] - source["s2"]) <= 3 and got["a", "en", "s1"] == 200
    assert (got["b", "en", "s1"], got["b", "en", "s2"]) == (100, 120) and abs(got["a", "de", "s1"] - language["de"]) <= 3


def test_mixture_takes_prefixes(docs):
    taken = mixing.mixed(docs)
    assert taken.columns == docs.columns
    assert counts(taken, "doc_id") == counts(mixing.mixture(docs), "doc_id")
    again = counts(mixing.mixture(docs.repartition(7)), "doc_id", "epoch")
    assert again == counts(mixing.mixture(docs), "doc_id", "epoch")


def test_quality_rules(docs):
    got = {(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in
           quality_rules.quality_rules(docs).collect()}
    want = set()
    for doc, text, *_ in rows():
        words, lines = re.findall(r"[^\x20\x09-\x0D]+", text or ""), [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
        windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        many = Counter(windows)
        inside = {i + k for i, w in enumerate(windows) if many[w] > 1 for k in range(5)}
        symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
        failed = len(words) < 10 or 100 * len(inside) > 20 * len(words)
        want.add((doc, len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(inside), failed))
    assert got == want


def test_classifiers(docs, labels):
    good, bad = quality_model.quality(docs, labels), toxicity.toxicity(docs, labels)
    for df in (good, bad):
        found = df.collect()
        assert len(found) == len(rows()) and all(0 <= r.score <= 1 for r in found)
        assert all(r.held_out == (r.doc_id is not None and held_out(r.doc_id)) for r in found)
    kept = quality_model.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == good.filter("predicted = 1").count()


def test_held_out_labels_teach_nothing(docs, labels):
    ours = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    flipped = labels.withColumn("quality", F.when(ours, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert (quality_model.train(docs, labels) == quality_model.train(docs, flipped)).all()


def test_languages(docs):
    found = {r.doc_id: r for r in language_id.languages(docs).collect()}
    assert found[5].lang_pred == "en" and found[200].lang_pred == found[202].lang_pred == "und"


def test_languages_in_blocks_of_trees(docs, monkeypatch):
    """One block of trees, and a block for each tree, give the same rows."""
    found = []
    for size in (language_id.BLOCK_BYTES, 1):
        monkeypatch.setattr(language_id, "BLOCK_BYTES", size)
        found.append(Counter((r.doc_id, r.held_out, r.lang_pred, round(r.score, 9)) for r in language_id.languages(docs).collect()))
    assert found[0] == found[1]


def test_language_query_by_brute_force(spark, sf):
    """The query on the smallest table: the sample, the code lengths and the scores worked out without Spark."""
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", F.xxhash64("doc_id").alias("h")).collect()
    texts = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.h, r.doc_id)):
        if r.lang is not None and r.text is not None and not held_out(r.doc_id):
            texts[r.lang].append(r.text.encode())
    assert all(len(t) <= language_id.MAX_ROWS for t in texts.values())
    joined = {k: language_id.joined([language_id.spread(t, language_id.ROW_BYTES) for t in v], language_id.MAX_BYTES) for k, v in texts.items()}
    trees = {k: language_id.fit(t) for k, t in joined.items()}
    got = {r.doc_id: r for r in queries.op7_language_id(spark, sf).collect()}
    assert len(got) == len(rows)
    for r in rows:
        lang, score = language_id.predict(r.text, trees)
        assert (got[r.doc_id].lang_pred, got[r.doc_id].held_out) == (lang, held_out(r.doc_id))
        assert abs(got[r.doc_id].score - score) < 1e-6


def _training(spark, sf, label):
    """All texts by id, and ``(doc_id, text, label)`` of the labelled ones that aren't held out, worked out without Spark."""
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    known = defaultdict(set)
    for r in spark.read.parquet(f"{sf}/labels.parquet").collect():
        if r.doc_id is not None and r[label] is not None and not held_out(r.doc_id):
            known[r.doc_id].add(r[label])
    return texts, sorted((doc, texts[doc], min(v)) for doc, v in known.items() if len(v) == 1 and doc in texts)


def test_quality_query_by_brute_force(spark, sf):
    texts, rows = _training(spark, sf, "quality")
    assert 20 < len(rows) <= quality_model.MAX_TRAINING_ROWS
    weights = quality_model.fit([r[1:] for r in rows])
    got = queries.op10_quality_classifier(spark, sf).collect()
    want = dict(zip(texts, quality_model.scores(list(texts.values()), weights, quality_model.Features())))
    assert len(got) == len(texts)
    for r in got:
        assert abs(r.score - want[r.doc_id]) < 1e-6 and r.held_out == held_out(r.doc_id) and r.predicted == int(r.score >= 0.7)


def test_toxicity_query_by_brute_force(spark, sf):
    import zlib

    texts, rows = _training(spark, sf, "toxic")
    tokens_, corpus = toxicity.Tokens(), np.zeros(1 << toxicity.BITS)
    for text in texts.values():
        np.add.at(corpus, tokens_(text).ravel(), 1)
    sample = sorted(((t, x) for _, t, x in rows), key=lambda row: (zlib.crc32(row[0].encode()), row))
    model = toxicity.fit(sample, corpus)
    model = model._replace(scores=model.scores.astype(np.float32))
    got = queries.op3_toxicity(spark, sf).collect()
    assert len(got) == len(texts) and len(rows) > 20
    for r in got:
        bins = tokens_(texts[r.doc_id])
        found = toxicity.found_passages(bins, model.scores)
        chance = model.log_k + np.log(max(len(bins), 1))
        evidence = sum(e for e in (model.rate * s - chance for s, _, _ in found) if e > -np.log(toxicity.MOST_E))
        want = 1 / (1 + np.exp(-np.clip(model.slope * np.log1p(evidence) + model.base, -40, 40)))
        assert abs(r.score - want) < 1e-6 and r.held_out == held_out(r.doc_id) and r.predicted == int(r.score >= 0.3)


def test_toxic_words_of_few_texts(spark):
    rng = np.random.default_rng(2)
    words = [f"{a}{b}" for a in "bcdfgh" for b in ("ab", "ek", "il", "om", "up")]
    texts = [(i, " ".join(rng.choice(words, 60)) + (" moron scum" if i % 4 == 0 else "")) for i in range(400)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 4 == 0).cast("int").alias("toxic"))
    wrong = toxicity.toxicity(docs, labels).join(labels, "doc_id").filter("held_out AND predicted <> toxic").count()
    assert wrong == 0
    model = toxicity.train(docs, labels)
    spans = {r.doc_id: (r.start, r.end) for r in toxicity.passages(docs, model).collect()}
    assert all(spans[i][1] >= 61 for i in range(0, 400, 4)) and not set(spans) - set(range(0, 400, 4))


def test_html_pages(spark):
    template = "<div><p>Shop opening hours</p><div>nine to five</div></div>"
    pages = [(i, f"http://www.x.org/{i}", f"<body>{template}<div>text of page {i}</div></body>") for i in range(8)]
    pages += [(50, None, None), (51, "nothing", ""), (52, "http://y.org/", f"<body>{template}</body>"), (0, "http://www.x.org/0", pages[0][2])]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string").withColumn("host", F.lit("mine"))
    got = Counter((r.page_id, r.url, r.text, r.n_chars) for r in html_text.extract(df).collect())
    want = Counter((i, u, f"text of page {i}", 14) for i, u, _ in [*pages[:8], pages[-1]])
    want += Counter([(50, None, "", 0), (51, "nothing", "", 0), (52, "http://y.org/", "Shop opening hours\nnine to five", 31)])
    assert got == want


@pytest.mark.parametrize("sections", [1, 4, 12])
def test_templates_alone_decide(spark, sections):
    """No article element, no telling tag or name: menus, sidebars and footers of each section go by their recurrence."""
    pages, want = [], {}
    for i in range(600):
        k = i % sections
        own = [f"Heading {i}", f"This is what page {i} says.", f"And a second paragraph {i * 7}.", "Thanks for reading." if i < 3 else f"Bye {i}"]
        side = "".join(f"<div><span>Link {k}-{j}</span></div>" for j in range(6))
        html = (
            f"<body><div><div>Home</div><div>Shop</div></div><div class=c{k}>{side}</div><div><h1>{own[0]}</h1><p>{own[1]}</p><p>{own[2]}</p>"
            f"<p>{own[3]}</p></div><div><p>Company {k} street</p></div></body>"
        )
        pages.append((i, f"https://big.org/{k}/{i}", html))
        want[i] = "\n".join(own)
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string").repartition(4)
    df = df.withColumns({c: F.lit("mine") for c in ("host", "k1", "k2", "page", "subtree", "templates", "n", "pages", "text")})
    assert {r.page_id: r.text for r in html_text.extract(df).collect()} == want


def test_html_query_by_brute_force(spark, sf):
    """The query on the smallest table: templates counted without Spark."""
    rows = spark.read.parquet(f"{sf}/pages.parquet").collect()
    host = lambda url: re.match(r"(?:\w+://([^/?#:]*))?", url or "")[1] or ""
    counts, sizes = defaultdict(set), defaultdict(set)
    for r in rows:
        page, hashes = html_text.subtrees(r.html or "")
        sizes[host(r.url)].add(page)
        for h in hashes:
            counts[host(r.url), h].add(page)
    many = {k for k, p in counts.items() if len(p) >= max(5, min(0.3 * len(sizes[k[0]]), 2 * len(sizes[k[0]]) ** 0.5))}
    want = {r.page_id: html_text.main_text(r.html or "", frozenset(h for x, h in many if x == host(r.url))) for r in rows}
    assert {r.page_id: r.text for r in queries.op8_html_extraction(spark, sf).collect()} == want


@pytest.mark.parametrize("piece", [2048, 7])
def test_embeddings(spark, monkeypatch, piece):
    monkeypatch.setattr(embedding_dedup, "PIECE", piece)
    monkeypatch.setattr(embedding_dedup, "BLOCK", piece)
    rng = np.random.default_rng(6)
    base = rng.normal(size=(60, 16))
    vectors = np.concatenate([base, base[:20] + rng.normal(size=(20, 16)) * 0.06, base[:1] + rng.normal(size=(30, 16)) * 0.03, base[:4]])
    found = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(vectors)]
    odd = [(900, None), (901, []), (902, [0.0] * 16), (903, [float("nan")] * 16), (904, [None] * 16), (905, [1.0, 2.0]), (None, found[0][1])]
    df = spark.createDataFrame(found + odd, "vec_id bigint, embedding array<float>").withColumn("node", F.lit("mine"))
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_duplicates(df).collect()}
    unit = embedding_dedup.unit(np.array([v for _, v in found]))
    near = unit @ unit.T >= 0.95
    root = _components(found, lambda i, j: near[i, j])
    want = {i: (int(near[i].sum()) - 1, root.index(root[i]), root.index(root[i]) == i) for i in range(len(found))}
    want |= {i: (0, i, True) for i, _ in odd if i is not None} | {None: (0, None, False)}
    right = sum(got[i] == want[i] for i in want)
    assert len(got) == len(want) and right >= 0.97 * len(want)
    assert all(got[i] == want[i] for i, _ in odd)


def test_recall_on_the_given_vectors(spark):
    """Twins at cosines from just below to well above the limit, planted among the given vectors, against all pairs."""
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").filter("embedding IS NOT NULL").select("embedding").collect()
    given_ = np.array([r[0] for r in rows if len(r[0]) == 64 and None not in r[0]], dtype=np.float64)
    rng = np.random.default_rng(12)
    base = embedding_dedup.unit(given_[rng.permutation(len(given_))[:600]])
    aside = rng.normal(size=base.shape)
    aside = embedding_dedup.unit(aside - (aside * base).sum(axis=1, keepdims=True) * base)
    cosine = rng.uniform(0.945, 0.99, (len(base), 1))
    vectors = np.concatenate([given_, cosine * base + np.sqrt(1 - cosine**2) * aside]).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<float>").repartition(4)
    got = {r.vec_id: r.n_links for r in embedding_dedup.near_duplicates(df).collect()}
    unit = embedding_dedup.unit(vectors.astype(np.float64))
    want = (unit @ unit.T >= 0.95).sum(axis=1) - 1
    print("recall", sum(got.values()) / want.sum(), "of", want.sum())
    assert want.sum() > 800 and all(got[i] <= want[i] for i in got) and sum(got.values()) >= 0.98 * want.sum()


@pytest.mark.parametrize("longest, recall", [(10_000, 1.0), (300, 0.97)])
def test_embeddings_of_one_topic(spark, monkeypatch, longest, recall):
    """Many pairs in a hot topic, whose lists are several pieces long and have no big component."""
    monkeypatch.setattr(embedding_dedup, "PIECE", 100)
    monkeypatch.setattr(embedding_dedup, "LONGEST", longest)
    rng = np.random.default_rng(7)
    one = rng.normal(size=32) + rng.normal(size=(600, 32)) * 0.4
    twin = one + rng.normal(size=one.shape) * 0.15
    vectors = np.concatenate([one, twin, rng.normal(size=(200, 32))]).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<float>")
    got = {r.vec_id: r.n_links for r in embedding_dedup.near_duplicates(df).collect()}
    unit = embedding_dedup.unit(vectors.astype(np.float64))
    near = unit @ unit.T >= 0.95
    want = near.sum(axis=1) - 1
    print("recall", sum(got.values()) / want.sum(), want.sum())
    assert want.sum() > 1000 and all(got[i] <= want[i] for i in got)
    assert sum(got.values()) >= recall * want.sum()


def test_empty_tables(spark, docs, labels):
    none, no_labels = docs.limit(0), labels.limit(0)
    made = [
        packing.pack_documents(none), line_dedup.line_report(none), toxicity.toxicity(none, no_labels),
        simhash.near_duplicates(none), quality_rules.quality_rules(none), mixing.mixture(none), language_id.languages(none),
        quality_model.quality(none, no_labels),
        html_text.extract(spark.createDataFrame([], "page_id bigint, url string, html string")),
        embedding_dedup.near_duplicates(spark.createDataFrame([], "vec_id bigint, embedding array<float>")),
    ]
    assert [df.count() for df in made] == [0] * 10
    assert quality_model.quality(docs, no_labels).select("score").distinct().collect() == [(0.5,)]


def test_pipeline_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    sizes = []
    for _, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage_table(stage(spark, docs, sf), "stage")
        sizes.append((before, docs))
    assert len(sizes) == 5 and all(after.columns == before.columns for before, after in sizes[:-1])
    (raw, good), (_, lines), (_, single), (_, mixed), (_, packed) = sizes
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    kept = quality_model.quality(raw, labels).filter("predicted = 1")
    assert counts(good, "doc_id") == counts(kept, "doc_id") and counts(lines, "doc_id") == counts(good, "doc_id")
    found = lines.orderBy("doc_id").select("doc_id", "text").collect()
    sets = [_shingles(r.text or "") for r in found]
    near = lambda i, j: 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])
    groups = {found[r].doc_id for r in _components(found, near)}
    assert groups != {r.component_id for r in simhash.near_duplicates(lines).collect()}
    assert {r.doc_id for r in single.collect()} == groups
    assert {r.doc_id for r in mixed.collect()} <= groups and counts(packed.filter("piece = 0"), "doc_id") == counts(mixed, "doc_id")
