"""Line deduplication by range-partitioned hashes.

Each counted line becomes a 128-bit hash with its document and position. The hashes
are range-partitioned and sorted by document (largest first) and position, so one
streaming pass over a partition sees each group's first occurrence and decides every
later one. What comes back is a sparse bitmap per document, not text: 64-line words
in which a set bit is a line to drop; a word that is absent keeps all its lines.

Defined results. Null or empty text is one empty line. A row without ``doc_id`` keeps
all its lines and counts for no key. Rows that repeat a ``doc_id`` are one document
when documents are counted, and each gets its own result. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from civicloom.llm.common import WHITE, ascii_lower, text_of
from civicloom.session import stage_table

MIN_CHARS, MIN_DOCS = 20, 3
WORD_BITS = 64
#: Hash bins that are counted to find hot keys; also the most rows that reach the driver.
BINS = 4096
#: A bin is split into pieces of so many mean bins, and of so many rows at least.
HOT_BINS, PIECE_ROWS = 4, 1000


def _text_key() -> Column:
    """Tells rows that share a document id apart; equal rows get equal bitmaps."""
    return F.xxhash64(text_of())


def counted_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``doc_id, text_key, pos, h1, h2`` of each line whose key is long enough."""
    lines = docs.filter(F.col("doc_id").isNotNull()).select(
        "doc_id",
        _text_key().alias("text_key"),
        F.posexplode(F.split(ascii_lower(text_of()), "\n")).alias("pos", "line"),
    )
    key = F.btrim("line", F.lit(WHITE))
    keyed = lines.select("doc_id", "text_key", "pos", key.alias("key")).filter(F.length("key") >= min_chars)
    return keyed.select(
        "doc_id", "text_key", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2")
    )


def _salted(lines: DataFrame) -> DataFrame:
    """Adds ``pieces`` and ``salt``: keys of a bin with far more rows than the mean are split by document."""
    bin_of = F.pmod("h1", F.lit(BINS)).cast("int")
    counts = {r["bin"]: r["count"] for r in lines.groupBy(bin_of.alias("bin")).count().collect()}
    piece = max(HOT_BINS * sum(counts.values()) / BINS, PIECE_ROWS)
    hot = [(b, int(-(-n // piece))) for b, n in sorted(counts.items()) if n > piece]
    if not hot:
        return lines.withColumns({"pieces": F.lit(1), "salt": F.lit(0)})
    split = lines.sparkSession.createDataFrame(hot, "bin int, pieces int")
    joined = lines.withColumn("bin", bin_of).join(F.broadcast(split), "bin", "left").drop("bin")
    pieces = F.coalesce("pieces", F.lit(1))
    return joined.withColumns(
        {"pieces": pieces, "salt": F.pmod(F.xxhash64("doc_id"), pieces).cast("int")}
    )


def dropped_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``doc_id, text_key, pos`` of the lines to drop."""
    lines = stage_table(counted_lines(docs, min_chars), "lines")
    runs = _salted(lines).repartitionByRange("h1", "h2", "salt")
    group = Window.partitionBy("h1", "h2", "salt")
    stream = group.orderBy(F.desc("doc_id"), "text_key", "pos")
    previous = F.lag("doc_id").over(stream)
    seen = (
        runs.withColumn("new_doc", (previous.isNull() | (previous != F.col("doc_id"))).cast("int"))
        .withColumns({"n_docs": F.sum("new_doc").over(group), "keeper": F.max("doc_id").over(group)})
    )
    later = (F.col("n_docs") >= min_docs) & (F.col("doc_id") != F.col("keeper"))
    seen = stage_table(
        seen.filter((F.col("pieces") > 1) | later).drop("n_docs", "keeper"), "line_runs"
    )
    # The pieces of a split bin are summed per key, and each piece is told the sums.
    split = seen.filter("pieces > 1")
    whole = split.groupBy("h1", "h2", "pieces").agg(F.sum("new_doc").alias("n_docs"), F.max("doc_id").alias("keeper"))
    pieces = F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("salt")
    told = whole.filter(F.col("n_docs") >= min_docs).select("h1", "h2", "keeper", pieces)
    late = split.join(told, ["h1", "h2", "salt"]).filter("doc_id <> keeper")
    columns = ["doc_id", "text_key", "pos"]
    return seen.filter("pieces = 1").select(columns).unionByName(late.select(columns))


def drop_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``doc_id, text_key, n_dropped, words``: one row per document that loses a line.

    ``words`` maps a word number to its 64 bits; bit ``i`` of word ``w`` is line ``64 w + i``.
    """
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("pos") % WORD_BITS).cast("int"))
    words = (
        dropped_lines(docs, min_chars, min_docs)
        .groupBy("doc_id", "text_key", (F.col("pos") / WORD_BITS).cast("int").alias("word"))
        .agg(F.bit_or(bit).alias("bits"))
    )
    return words.groupBy("doc_id", "text_key").agg(
        F.sum(F.bit_count("bits").cast("bigint")).alias("n_dropped"),
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("word", "bits")))).alias("words"),
    )


def _with_bitmaps(docs: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """``row, text, n_dropped, words``; the row is kept whole, so its names cannot clash."""
    rows = docs.select(F.struct("*").alias("row"), "doc_id", _text_key().alias("text_key"))
    joined = rows.join(drop_bitmaps(docs, min_chars, min_docs), ["doc_id", "text_key"], "left")
    return joined.withColumn("text", text_of("row.text"))  # after the join, so a text travels once


def _kept_text() -> Column:
    def stays(_: Column, i: Column) -> Column:
        word = F.try_element_at("words", (i / WORD_BITS).cast("int"))
        return F.getbit(F.coalesce(word, F.lit(0).cast("bigint")), i % WORD_BITS) == 0

    kept = F.array_join(F.filter(F.split("text", "\n"), stays), "\n")
    return F.when(F.col("words").isNull(), F.col("text")).otherwise(kept)


def line_report(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept_sha256`` of every row."""
    narrow = docs.select("doc_id", "text")
    return _with_bitmaps(narrow, min_chars, min_docs).select(
        "doc_id",
        F.size(F.split("text", "\n")).cast("bigint").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0).cast("bigint")).alias("n_dropped"),
        F.sha2(_kept_text().cast("binary"), 256).alias("kept_sha256"),
    )


def drop_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """The rows with the dropped lines taken out of ``text``, other columns as they were.

    ``n_chars``, if there, is counted anew where the text changed. A null text stays null.
    """
    lost = F.col("words").isNotNull()
    text = F.when(lost, _kept_text()).otherwise(F.col("row.text"))
    rows = _with_bitmaps(docs, min_chars, min_docs).select("row", lost.alias("lost"), text.alias("new_text"))
    columns = []
    for name in docs.columns:
        own = F.col("row").getField(name)
        if name == "text":
            own = F.col("new_text")
        elif name == "n_chars":
            own = F.when(F.col("lost"), F.length("new_text").cast(docs.schema[name].dataType)).otherwise(own)
        columns.append(own.alias(name))
    return rows.select(columns)
