"""DuckDB twins, written from the definitions."""

WHITE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

LINE_DEDUP = f"""
WITH rows AS (
    SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), lines AS (
    SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM rows
), keyed AS (
    SELECT r, doc_id, line, pos, translate(trim(line, {WHITE}), {LOWER}) AS key FROM lines
), common AS (
    SELECT key, max(doc_id) AS keeper FROM keyed
    WHERE length(key) >= 20 AND doc_id IS NOT NULL
    GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), judged AS (
    SELECT r, k.doc_id, line, pos, c.key IS NOT NULL AND k.doc_id IS NOT NULL AND k.doc_id <> c.keeper AS lost
    FROM keyed k LEFT JOIN common c ON k.key = c.key
)
SELECT
    doc_id,
    count(*) AS n_lines,
    count(*) FILTER (lost) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT lost), '')) AS kept_sha256
FROM judged GROUP BY r, doc_id
"""

_CLASSES = ["[a-z]", r"[ \t\n\x0b\f\r]", "[A-Z]", "[0-9]", "[#*$%&|<>]", r"[\x21-\x7e]"]


def _class_sizes() -> str:
    """One row per document and class: code points of the class, less those of classes before it."""
    sizes, seen = [], []
    for i, pattern in enumerate(_CLASSES):
        left = f"regexp_replace(text, '{'|'.join(seen)}', '', 'g')" if seen else "text"
        taken = f"regexp_replace(text, '{'|'.join([*seen, pattern])}', '', 'g')"
        sizes.append(f"SELECT r, {i} AS k, length({left}) - length({taken}) AS n FROM docs")
        seen.append(pattern)
    sizes.append(f"SELECT r, {len(_CLASSES)}, length(regexp_replace(text, '{'|'.join(seen)}', '', 'g')) FROM docs")
    return " UNION ALL ".join(sizes)


def _distance(shares: str, own: str, refs: str) -> str:
    """Jensen-Shannon distance per row of ``own`` (r, k, n) to its reference in ``shares`` (ref, k, q)."""
    return f"""
    SELECT r, CASE WHEN max(total) > 0 THEN sqrt(greatest(sum(
        CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END
    ) / 2, 0)) ELSE 0 END AS far
    FROM (
        SELECT x.r, x.total, s.q, coalesce(o.n, 0) / greatest(x.total, 1)::DOUBLE AS p
        FROM (SELECT r, ref, (SELECT coalesce(sum(n), 0) FROM {own} o WHERE o.r = refs.r) AS total FROM {refs} refs) x
        JOIN {shares} s ON s.ref = x.ref LEFT JOIN {own} o ON o.r = x.r AND o.k = s.k
    ) GROUP BY r"""


QUALITY_RULES = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS text FROM documents
), split AS (
    SELECT r, lang, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM docs
), words AS (
    SELECT r, lang, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM split
), windows AS (
    SELECT r, i, [word, lead(word, 1) OVER w, lead(word, 2) OVER w, lead(word, 3) OVER w, lead(word, 4) OVER w] AS g
    FROM words WINDOW w AS (PARTITION BY r ORDER BY i) QUALIFY lead(word, 4) OVER w IS NOT NULL
), again AS (
    SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, g) > 1
), repeats AS (
    SELECT r, sum(least(5, coalesce(following - i, 5))) AS n
    FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS following FROM again) GROUP BY r
), lines AS (
    SELECT r, count(*) - count(DISTINCT line) AS n
    FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs)
    WHERE trim(line, {WHITE}) <> '' GROUP BY r
), sizes AS ({_class_sizes()}),
totals AS (
    SELECT lang AS ref, count(*) AS total FROM words WHERE lang IS NOT NULL GROUP BY lang
), refs AS (
    SELECT r, ref FROM docs LEFT JOIN totals ON ref = lang
), class_refs AS (
    SELECT r, coalesce(ref, '*all*') AS ref FROM refs
), class_shares AS (
    SELECT ref, k, sum(n) / (sum(sum(n)) OVER (PARTITION BY ref))::DOUBLE AS q FROM sizes JOIN refs USING (r) WHERE ref IS NOT NULL GROUP BY ref, k
    UNION ALL SELECT '*all*', k, sum(n) / (sum(sum(n)) OVER ())::DOUBLE FROM sizes GROUP BY k
), ranked AS (
    SELECT lang AS ref, word, count(*) AS n, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, word) AS k
    FROM words WHERE lang IS NOT NULL GROUP BY lang, word QUALIFY k <= 24
), word_shares AS (
    SELECT ref, k, n / total::DOUBLE AS q FROM ranked JOIN totals USING (ref)
    UNION ALL SELECT ref, 0, (any_value(total) - sum(n)) / any_value(total)::DOUBLE FROM ranked JOIN totals USING (ref) GROUP BY ref
), uses AS (
    SELECT w.r, coalesce(t.k, 0) AS k, count(*) AS n
    FROM words w JOIN refs f ON f.r = w.r LEFT JOIN ranked t ON t.ref = f.ref AND t.word = w.word GROUP BY 1, 2
), class_far AS ({_distance("class_shares", "sizes", "class_refs")}),
word_far AS ({_distance("word_shares", "uses", "refs")}),
counts AS (
    SELECT d.r, d.doc_id, len(s.ws) AS n_words,
        length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
        coalesce(l.n, 0) AS n_dup_lines, CAST(coalesce(p.n, 0) AS BIGINT) AS n_repeat_words
    FROM docs d JOIN split s ON s.r = d.r LEFT JOIN lines l ON l.r = d.r LEFT JOIN repeats p ON p.r = d.r
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
    NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words
        OR (n_words >= 50 AND coalesce(c.far, 0) > 0.35) OR (n_words >= 100 AND coalesce(w.far, 0) > 0.65)) AS kept
FROM counts LEFT JOIN class_far c USING (r) LEFT JOIN word_far w USING (r)
"""


def _filled(nodes: str, parent: str, name: str, weight: str) -> str:
    """Each parent's ``given`` shared among its nodes by weight, none over its ``room``."""
    family = f"PARTITION BY {parent}"
    tightest = f"{family} ORDER BY room::DOUBLE / greatest(weight, 1)::DOUBLE, {name}"
    return f"""
    SELECT * REPLACE (CASE WHEN is_full THEN room WHEN open > 0 THEN ((given - used) * weight) // open ELSE 0 END AS room)
    FROM (
        SELECT *, coalesce(sum(room) FILTER (is_full) OVER ({family}), 0)::HUGEINT AS used,
            coalesce(sum(weight) FILTER (NOT is_full) OVER ({family}), 0)::HUGEINT AS open
        FROM (
            SELECT *, room * sum(weight) OVER ({tightest} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::HUGEINT
                < (given - coalesce(sum(room) OVER ({tightest} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT) * weight AS is_full
            FROM (SELECT *, ({weight})::HUGEINT AS weight FROM {nodes})
        )
    )"""


MIXTURE = rf"""
WITH sized AS (
    SELECT doc_id, coalesce(lang, '') AS language, coalesce(source, '') AS source,
        len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n_tokens,
        md5(concat_ws(chr(31), coalesce(doc_id::VARCHAR, ''), coalesce(lang, ''), coalesce(source, ''), md5(coalesce(text, '')))) AS row_key,
        TRY_CAST(nullif(regexp_extract(coalesce(source, ''), '([0-9]+)$', 1), '') AS BIGINT) % 3 AS number
    FROM documents
), sizes AS (
    SELECT * EXCLUDE number, CASE number WHEN 0 THEN 'web' WHEN 1 THEN 'reference' WHEN 2 THEN 'dialogue' ELSE 'other' END AS domain
    FROM sized
), leaves AS (
    SELECT domain, language, source, sum(n_tokens)::HUGEINT AS tokens, (2 * sum(n_tokens))::HUGEINT AS room FROM sizes GROUP BY ALL
), domains AS ({_filled(
    "(SELECT domain, sum(room)::HUGEINT AS room, (SELECT sum(tokens)::HUGEINT * 90 // 100 FROM leaves) AS given FROM leaves GROUP BY domain)",
    "1", "domain", "CASE domain WHEN 'web' THEN 5 WHEN 'reference' THEN 3 WHEN 'dialogue' THEN 2 ELSE 1 END")}
), languages AS ({_filled(
    "(SELECT l.domain, language, sum(l.room)::HUGEINT AS room, any_value(d.room) AS given FROM leaves l JOIN domains d USING (domain) GROUP BY l.domain, language)",
    "domain", "language", "CASE language WHEN 'en' THEN 5 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 WHEN 'es' THEN 2 ELSE 1 END")}
), budgets AS ({_filled(
    "(SELECT l.*, g.room AS given FROM leaves l JOIN languages g USING (domain, language))", "domain, language", "source", "1")}
), rows AS (
    SELECT s.*, (room // tokens)::INTEGER AS epochs, room % tokens AS cut
    FROM sizes s JOIN budgets USING (domain, language, source) WHERE tokens > 0
), whole AS (
    SELECT *, unnest(range(epochs))::INTEGER AS epoch FROM rows
), prefix AS (
    SELECT *, epochs AS epoch FROM rows QUALIFY coalesce(sum(n_tokens) OVER (
        PARTITION BY domain, language, source ORDER BY md5(concat_ws(':', '7', epochs::VARCHAR, row_key))
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) < cut
)
SELECT doc_id, domain, language, source, n_tokens, epoch FROM whole
UNION ALL SELECT doc_id, domain, language, source, n_tokens, epoch FROM prefix
"""

LEXICAL_SEARCH = rf"""
WITH words AS (
    SELECT r, doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), {LOWER}), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT row_number() OVER () AS r, doc_id, text FROM documents)
), lengths AS (
    SELECT r, doc_id, count(*) AS n FROM words GROUP BY r, doc_id
), sums AS (
    SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM lengths
), asked AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), {LOWER}), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
), postings AS (
    SELECT r, term, count(*) AS tf FROM words SEMI JOIN asked USING (term) GROUP BY r, term
), weights AS (
    SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
    FROM postings, sums GROUP BY term
), parts AS (
    SELECT r, term, (1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // n_terms)) AS part
    FROM postings JOIN lengths USING (r), sums
), scored AS (
    SELECT item_id, r, sum(w * part)::BIGINT AS score FROM asked JOIN weights USING (term) JOIN parts USING (term) GROUP BY item_id, r
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scored JOIN lengths USING (r) WHERE score > 0 QUALIFY rank <= 50
"""

HARD_NEGATIVES = """
WITH rows AS (
    SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x) AND abs(x) <= 262144)) = len(embedding)
), scored AS (
    SELECT a.r AS a, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.x, b.x)::BIGINT AS score
    FROM rows a JOIN rows b ON a.r <> b.r WHERE a.vec_id % 50 = 0
), positives AS (
    SELECT a, anchor_id, vec_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id) AS k
    FROM scored WHERE same QUALIFY k <= 5
)
SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY a, k ORDER BY score DESC, vec_id)::INTEGER AS rank,
    vec_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s USING (a)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score QUALIFY rank <= 3
"""
