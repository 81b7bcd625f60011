"""Quality rules: base counts, then divergence from the language's own habits.

The references are taken from all documents: each language's shares of character classes,
and its commonest words with their shares. A document's own shares are compared with
them by Jensen-Shannon distance (square root, base 2, so 0 to 1). A distance counts only
from a least length on, since short texts diverge by chance. Everything is built-in
functions over the row's own arrays, so no text leaves its row.

Defined results. Null or empty text has no word, so the base rules fail it. A language
that is null or has no word at all has its classes compared with all languages
together, and its words with nothing. Ties among common words go to the smaller word. Repeated rows are
judged each and count each in the references; a null id is an id like others. Extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from civicloom.llm.common import WHITE, text_of
from civicloom.session import stage_table

MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW_WORDS = 10, 20, 5
SYMBOLS = "#*$%&|<>"
#: Character classes in the order they are taken out of the text; what is left is the last class.
CLASSES = ("[a-z]+", r"[ \t\n\x0b\f\r]+", "[A-Z]+", "[0-9]+", "[#*$%&|<>]+", "[\\x21-\\x7e]+")
COMMON_WORDS = 24
#: Distances above these fail a document of at least so many words.
MAX_CLASS_DISTANCE, CLASS_MIN_WORDS = 0.35, 50
MAX_WORD_DISTANCE, WORD_MIN_WORDS = 0.65, 100


def _zero() -> Column:
    return F.lit(0).cast("bigint")


def _with_words(rows: DataFrame) -> DataFrame:
    trimmed = F.btrim("text", F.lit(WHITE))
    split = F.split(trimmed, r"[ \t\n\x0b\f\r]+")
    return rows.withColumn("words", F.when(trimmed == "", F.array().cast("array<string>")).otherwise(split))


def _with_classes(rows: DataFrame) -> DataFrame:
    """Adds ``classes``, code points by class."""
    sizes, left = [], "text"
    for i, pattern in enumerate(CLASSES):
        rows = rows.withColumn(f"left{i}", F.regexp_replace(left, pattern, ""))
        sizes.append(F.length(left) - F.length(f"left{i}"))
        left = f"left{i}"
    sizes.append(F.length(left))
    return rows.withColumn("classes", F.array(*sizes).cast("array<bigint>")).drop(
        *[f"left{i}" for i in range(len(CLASSES))]
    )


def _repeat_words() -> Column:
    """Words inside windows that are found more than once, from the windows' hashes ``windows``."""
    place = F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    placed = F.sort_array(place)
    return F.when(F.size(F.array_distinct("windows")) == F.size("windows"), F.array().cast(PLACES)).otherwise(placed)


PLACES = "array<struct<h:bigint,i:int>>"


def counted(docs: DataFrame) -> DataFrame:
    """``doc_id, lang, word_hashes, classes`` and the base counts of every row."""
    rows = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), text_of().alias("text"))
    rows = _with_classes(_with_words(rows))
    with_word = F.filter(F.split("text", "\n"), lambda line: F.btrim(line, F.lit(WHITE)) != "")
    rows = rows.withColumns(
        {"lines": with_word, "word_hashes": F.transform("words", lambda w: F.xxhash64(w))}
    ).withColumn("n_words", F.size("words"))

    def window(_: Column, i: Column) -> Column:
        return F.xxhash64(F.slice("word_hashes", i + 1, WINDOW_WORDS))

    starts = F.slice("word_hashes", 1, F.greatest(F.col("n_words") - WINDOW_WORDS + 1, F.lit(0)))
    rows = rows.withColumn("windows", F.transform(starts, window)).withColumn("places", _repeat_words())

    def again(x: Column, i: Column) -> Column:
        before, after = F.get("places", i - 1), F.get("places", i + 1)
        return before["h"].eqNullSafe(x["h"]) | after["h"].eqNullSafe(x["h"])

    repeats = F.sort_array(F.transform(F.filter("places", again), lambda x: x["i"]))
    rows = rows.withColumn("repeats", repeats)
    reach = F.transform(
        "repeats", lambda p, k: F.least(F.coalesce(F.get("repeats", k + 1) - p, F.lit(WINDOW_WORDS)), F.lit(WINDOW_WORDS))
    )
    return rows.select(
        "doc_id", "lang", "word_hashes", "classes",
        F.col("n_words").cast("bigint").alias("n_words"),
        (F.length("text") - F.col("classes")[1]).cast("bigint").alias("word_chars"),
        F.col("classes")[4].alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.aggregate(reach, _zero(), lambda total, n: total + n).alias("n_repeat_words"),
    )


def references(docs: DataFrame) -> DataFrame:
    """``lang, common, word_shares`` of every language with a word, stored: the hashes of its commonest words, and the
    shares of those and of all other words."""
    rows = docs.select(F.col("lang").cast("string").alias("lang"), text_of().alias("text")).filter("lang IS NOT NULL")
    counts = _with_words(rows).select("lang", F.explode("words").alias("word")).groupBy("lang", "word").count()
    # Counted once and stored: both the ranks and the totals read it.
    counts = stage_table(counts, "word_counts")
    first = Window.partitionBy("lang").orderBy(F.desc("count"), "word")
    # The rank limit runs before the shuffle, so a language's reducer gets few rows from each task.
    top = counts.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= COMMON_WORDS)
    own = top.groupBy("lang").agg(
        F.sort_array(F.collect_list(F.struct("place", F.xxhash64("word").alias("h"), "count"))).alias("top")
    )
    both = own.join(counts.groupBy("lang").agg(F.sum("count").alias("total")), "lang")
    shares = F.transform("top", lambda w: w["count"] / F.col("total"))
    rest = (F.col("total") - F.aggregate("top", _zero(), lambda a, w: a + w["count"])) / F.col("total")
    return stage_table(both.select("lang", F.col("top.h").alias("common"), F.concat(shares, F.array(rest)).alias("word_shares")), "references")


def _with_distance(rows: DataFrame, name: str, counts: str, shares: str) -> DataFrame:
    """Adds the Jensen-Shannon distance of counts to shares; 0 where there is nothing to count.

    Total and parts are columns of their own, so that they aren't worked out again for each element.
    """

    def term(p: Column, q: Column) -> Column:
        m = (p + q) / 2
        return F.when(p > 0, p * F.log2(p / m)).otherwise(0.0) + F.when(q > 0, q * F.log2(q / m)).otherwise(0.0)

    rows = rows.withColumn("total", F.aggregate(counts, _zero(), lambda a, n: a + n))
    rows = rows.withColumn("parts", F.transform(counts, lambda n: n / F.greatest("total", F.lit(1))))
    both = F.aggregate(F.zip_with("parts", shares, term), F.lit(0.0), lambda a, x: a + x)
    far = F.when(F.col("total") > 0, F.sqrt(F.greatest(both / 2, F.lit(0.0)))).otherwise(0.0)
    return rows.withColumn(name, far).drop("total", "parts")


def _class_shares(sums: list[Column]) -> Column:
    total = sum(sums[1:], sums[0])
    return F.array(*[n / F.greatest(total, F.lit(1)) for n in sums])


def quality_rules(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words``, the base counts, ``base_failed`` and ``kept`` of every row."""
    known = references(docs)
    # As many references as languages: the optimizer broadcasts them or splits a hot language's rows, by their size.
    rows = counted(docs).join(known, "lang", "left")
    at = F.filter(F.transform("word_hashes", lambda h: F.array_position("common", h).cast("int")), lambda k: k > 0)
    rows = rows.withColumn("at", at)
    ranks = F.sequence(F.lit(1), F.size("common"))
    uses = F.transform(ranks, lambda k: (F.size("at") - F.size(F.array_remove("at", k))).cast("bigint"))
    rows = rows.withColumn("uses", F.concat(uses, F.array(F.col("n_words") - F.size("at"))))
    # One pass over the texts gives each row's few numbers; the class references are sums over those.
    rows = stage_table(rows.drop("word_hashes", "common", "at"), "rule_counts")
    sums = [F.col(f"c{i}") for i in range(len(CLASSES) + 1)]
    by_lang = rows.groupBy("lang").agg(*[F.sum(F.col("classes")[i]).alias(f"c{i}") for i in range(len(sums))])
    by_lang = stage_table(by_lang, "class_sums")
    everything = [n or 0 for n in by_lang.agg(*map(F.sum, sums)).first()]
    shares = by_lang.join(known.select("lang"), "lang").select("lang", _class_shares(sums).alias("class_shares"))
    rows = rows.join(shares, "lang", "left")
    every = _class_shares([F.lit(n) for n in everything])
    rows = rows.withColumn("class_shares", F.coalesce("class_shares", every))
    rows = _with_distance(rows, "class_distance", "classes", "class_shares")
    rows = _with_distance(rows, "word_distance", "uses", "word_shares")
    class_far = (F.col("n_words") >= CLASS_MIN_WORDS) & (F.col("class_distance") > MAX_CLASS_DISTANCE)
    word_far = (F.col("n_words") >= WORD_MIN_WORDS) & (F.coalesce("word_distance", F.lit(0.0)) > MAX_WORD_DISTANCE)
    repeats = 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    rows = rows.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | repeats)
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~class_far & ~word_far).alias("kept"),
    )
