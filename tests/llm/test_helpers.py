"""Brute-force tests of the Python helpers inside tasks."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings, strategies as st

from civicloom.llm import html_text, language_id, packing, quality_model, simhash, tokens, toxicity


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found.encode_special_tokens = True
    return found


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text("abc éß'\n\t 12$<|>\xa0 \x1c\x85", max_size=60)))
def test_ids_are_the_tokenizers(tokenizer, text):
    assert tokens.encoder()(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_special_strings_and_long_words_are_text(tokenizer):
    for text in ("a<|endoftext|>b", "x" * 30_000, " " * 5_000 + "x", "é" * 3000):
        assert tokens.encoder()(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("length", [1, 7, 8, 9, 16, 17])
def test_only_the_first_piece_is_short(length):
    ids = np.arange(length)
    pieces = tokens.cut(ids, 8)
    assert np.concatenate([p for _, p in pieces]).tolist() == ids.tolist()
    assert [a for a, _ in pieces] == np.cumsum([0, *[len(p) for _, p in pieces][:-1]]).tolist()
    assert all(len(p) == 8 for _, p in pieces[1:]) and 0 < len(pieces[0][1]) <= 8


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 60), max_size=40))
def test_a_plan_holds_every_piece(counts):
    runs = packing.plan(counts, 64)
    held = Counter()
    for pattern, many in runs:
        assert sum(length * copies for length, copies in pattern) <= 64
        for length, copies in pattern:
            held[length] += copies * many
    assert held == counts
    least = max(-(-sum(k * v for k, v in counts.items()) // 64), sum(v for k, v in counts.items() if k > 32))
    assert sum(many for _, many in runs) <= 1.7 * least + 1


def test_plans_are_near_the_lower_bound():
    rng = np.random.default_rng(1)
    lengths = np.minimum(rng.lognormal(6.6, 1.1, 40_000).astype(int) + 1, 2048)
    counts = dict(zip(*(a.tolist() for a in np.unique(lengths, return_counts=True))))
    used = sum(many for _, many in packing.plan(counts))
    assert used <= 1.01 * sum(k * v for k, v in counts.items()) / 2048


@settings(max_examples=200, deadline=None)
@given(st.text("aB é\n\tß!", max_size=80))
def test_fingerprint_by_definition(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert simhash.fingerprint(text) % (1 << 64) == want


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(-5, 4), max_size=25))
def test_maximal_segments_by_definition(values):
    """Ruzzo and Tompa's recursion: take the best segment, then the parts left and right of it."""

    def best(low, high):
        found = [(sum(values[a:b]), a - b, a, b) for a in range(low, high) for b in range(a + 1, high + 1)]
        top = max((f for f in found if f[0] > 0), default=None, key=lambda f: (f[0], f[1], -f[2]))
        if top is None:
            return []
        return [*best(low, top[2]), (top[0], top[2], top[3]), *best(top[3], high)]

    assert sum(s for s, _, _ in toxicity.segments(np.array(values, float))) == sum(s for s, _, _ in best(0, len(values)))


def test_passages_are_found_whatever_stands_before():
    """Four strong words, first singly and far apart, then twice in a row, then once more far away."""
    scores = np.full(1 << toxicity.BITS, -0.5)
    tokens = toxicity.Tokens()
    for i, word in enumerate(("morona", "scumbo", "vilest", "idiota")):
        scores[tokens(word)[0]] = 4.0
    singly = [w for word in ("morona", "scumbo", "vilest", "idiota") for w in [word, *["filler"] * 40]]
    passage = ["morona", "scumbo", "vilest", "idiota"] * 2
    text = " ".join([*singly, *passage, *["filler"] * 80, *passage])
    found = toxicity.found_passages(tokens(text), scores)
    assert [(s, b - a) for s, a, b in found if s > 4] == [(16.0, 8), (16.0, 8)]
    assert sum(s == 4 for s, _, _ in found) == 4
    # A word said over and over is one word.
    assert [s for s, _, _ in toxicity.found_passages(tokens("morona filler " * 50), scores)] == [4.0]
    assert toxicity.found_passages(tokens(""), scores) == []


def test_growth_rate_solves_its_equation():
    scores, counts = np.array([2.0, -1.0]), np.array([1.0, 9.0])
    rate = toxicity.growth_rate(scores, counts)
    assert math.isclose(0.1 * math.exp(2 * rate) + 0.9 * math.exp(-rate), 1, rel_tol=1e-6)


def _partial_match(train, text):
    """Code length by the recursive definition."""
    seen, counts = b"   " + train.lower(), {}
    for i in range(3, len(seen)):
        for k in range(4):
            counts.setdefault(seen[i - k : i], Counter())[seen[i]] += 1
    wanted = b"   " + text.lower()

    def bits(k, i):
        if k < 0:
            return 8.0
        found = counts.get(wanted[i - k : i])
        if not found:
            return bits(k - 1, i)
        n, kinds = sum(found.values()), len(found)
        return -math.log2(found[wanted[i]] / (n + kinds)) if wanted[i] in found else bits(k - 1, i) - math.log2(kinds / (n + kinds))

    return sum(bits(3, i) for i in range(3, len(wanted)))


def test_code_lengths_by_definition(monkeypatch):
    rng = random.Random(3)
    texts = {k: "".join(rng.choices(a, k=4000)).encode() for k, a in {"x": "ab c", "y": "cde a", "z": "éß ab"}.items()}
    trees = {k: language_id.unpacked(language_id.packed(language_id.fit(t))[0]) for k, t in texts.items()}
    for chunk in (1 << 20, 4):
        monkeypatch.setattr(language_id, "_CHUNK", chunk)
        for text in ("ab cab", "Cde é~q", "\x00 日本", "ab cab dea é" * 20):
            for k, tree in trees.items():
                assert math.isclose(language_id.code_length(text.encode(), tree), _partial_match(texts[k], text.encode()), rel_tol=1e-5)
    assert language_id.predict("cde cde aed", trees)[0] == "y"
    many = ["ab cab", None, "Cde é~q", "1", "a", "cc" * 90_000, "ab é"]
    monkeypatch.setattr(language_id, "TOGETHER", 30)
    assert [b.language for b in language_id.best_of(many, trees)] == [language_id.predict(t, trees)[0] for t in many]
    halves = language_id.best_of(many, {"z": trees["z"]}, language_id.best_of(many, {k: trees[k] for k in "xy"}))
    for whole, half in zip(language_id.best_of(many, trees), halves):
        assert whole.language == half.language and math.isclose(whole.sum, half.sum, rel_tol=1e-9)
    for empty in (None, "", "123 !?"):
        assert language_id.predict(empty, trees) == ("und", 0.0)
    assert language_id.predict("abc", {}) == ("und", 0.0)


@settings(max_examples=100, deadline=None)
@given(st.sets(st.one_of(st.integers(0, (1 << 32) - 1), st.integers(0, 40), st.just((1 << 32) - 1)), max_size=300))
def test_hash_tables_find_their_keys(keys):
    keys = np.array(sorted(keys), dtype=np.uint32)
    table = language_id.table_of(keys, np.arange(len(keys)).astype(float))
    assert language_id.look_up(table, keys).tolist() == list(range(len(keys)))
    others = np.setdiff1d(np.arange(50, dtype=np.uint32), keys)
    assert np.isnan(language_id.look_up(table, others)).all()


def test_sampled_rows_share_the_bytes_equally():
    rows = [b"a" * 10_000_000, b"b" * 100, b"", b"c" * 5000]
    text = language_id.joined(rows, 9000)
    assert text.count(b"b") == 100 and all(4440 <= text.count(c) <= 4460 for c in (b"a", b"c"))
    assert language_id.spread(bytes(range(200)) * 5, 320)[:64] == bytes(range(64)) and language_id.spread(b"abc", 5) == b"abc"


def test_languages_in_many_scripts():
    """Whatever number of others there are: the same code lengths, and each script's texts found."""
    rng = random.Random(11)
    starts = [0x61, 0x3B1, 0x430, 0x561, 0x5D0, 0x627, 0x905, 0x995, 0xE01, 0x10D0, 0x1200, 0x3041, 0x30A1, 0x4E00, 0xAC00]
    trees, words = {}, {}
    for i in range(24):
        letters = [chr(starts[i % len(starts)] + k) for k in range(24)]
        words[i] = ["".join(rng.choices(letters[: 8 + i % 7], k=rng.randint(2, 6))) for _ in range(80)]
        trees[f"l{i:02}"] = language_id.fit(" ".join(rng.choices(words[i], k=600)).encode())
    for i in range(24):
        text = " ".join(rng.choices(words[i], k=12))
        assert language_id.predict(text, trees)[0] == f"l{i:02}"


def test_classifiers_without_two_classes():
    assert quality_model.scores(["x"], quality_model.fit([]), quality_model.Features()) == [0.5]
    assert quality_model.scores([""], quality_model.fit([("a b", 1)]), quality_model.Features())[0] > 0.99
    model = toxicity.fit([], np.zeros(1 << toxicity.BITS))
    assert toxicity.statistic(toxicity.Tokens()("a b"), model) == 0


def test_ftrl_by_its_definition():
    """Sparse updates against a dense reference, one coordinate at a time."""
    rng = np.random.default_rng(7)
    size, q = 12, quality_model
    model, z, n = q.Ftrl(size), [0.0] * (size + 1), [0.0] * (size + 1)

    def weight(i):
        l1 = 0.0 if i == size else q.L1
        return 0.0 if abs(z[i]) <= l1 else -math.copysign(abs(z[i]) - l1, z[i]) / ((q.BETA + math.sqrt(n[i])) / q.ALPHA + q.L2)

    for _ in range(200):
        index = np.sort(rng.choice(size, 4, replace=False))
        value, label = rng.random(4), int(rng.random() < 0.4)
        x = {**dict(zip(index.tolist(), value.tolist())), size: 1.0}
        p = 1 / (1 + math.exp(-sum(weight(i) * v for i, v in x.items())))
        steps = {}
        for i, v in x.items():
            g = (p - label) * v
            sigma = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / q.ALPHA
            steps[i] = (g - sigma * weight(i), g * g)
        for i, (dz, dn) in steps.items():
            z[i], n[i] = z[i] + dz, n[i] + dn
        model.update(index, value, label)
    assert np.allclose(model.weights(np.arange(size + 1)), [weight(i) for i in range(size + 1)], rtol=1e-9)


def test_quality_separates_shapes():
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdef", k=5)) for _ in range(3000)]
    good = [(" ".join(rng.sample(words, 40)), 1) for _ in range(300)]
    bad = [(" ".join(w + rng.choice(["###", "%%"]) for w in rng.sample(words, 40)), 0) for _ in range(100)]
    model = quality_model.fit([*good[:200], *bad[:70]])
    found = quality_model.scores([t for t, _ in [*good[200:], *bad[70:]]], model, quality_model.Features())
    assert min(found[:100]) >= 0.7 > max(found[100:])


PAGE = (
    '<!DOCTYPE html><head><title>T</title></head><body><nav><a>Menu</a></nav><div class="ad">Buy</div><article><h1>Head '
    "line</h1><p>One &amp; <b>t</b>wo<br>three&nbsp;x<p>Four<script>var t='</p>';</script></article>"
    '<div id="comments"><article>Nasty</article></div><footer>F</footer>'
)


@pytest.mark.parametrize(
    "page, want",
    [
        (PAGE, "Head line\nOne & two three x\nFour"),
        ("", ""), ("plain <3 text <im", "plain <3 text"), ("<p>a<!-- b", "a"), ("<ul><li>a<li>b</ul>", "a\nb"),
        ("<article>a&amp;lt;b</article><p>outside</p>", "a&lt;b"),
        ("<main><aside>x</aside><div>in</div></main><div>out</div>", "in"),
        ("<div>" * 5000 + "deep" + "</div>" * 5000, "deep"),
    ],
)
def test_main_text(page, want):
    assert html_text.main_text(page) == want


def test_recurring_subtrees_go_but_the_article_stays():
    box = "<section><div>Join the club</div></section>"
    page = f"<body>{box}<div>own text</div></body>"
    (known,) = {h for h in html_text.subtrees(f"<body>{box}<div>b</div></body>")[1]} & set(html_text.subtrees(f"<body>{box}<i>c</i></body>")[1]) - set(
        html_text.subtrees("<body><div>Join the club</div></body>")[1]
    )
    assert html_text.main_text(page, frozenset([known])) == "own text"
    article = "<article><p>shared passage</p></article>"
    assert html_text.main_text(article, frozenset(html_text.subtrees(article)[1])) == "shared passage"
