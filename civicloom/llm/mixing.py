"""Mixing sources to target weights by hierarchical budgeting.

The tree is domain, language, source; a leaf is one source's documents in one language.
The token budget goes down by weight. A node can't use more than its leaves hold in
``max_epochs`` epochs; what it can't use goes to its siblings by their weights, and to
its parent's siblings only when none of its own can use it, because a parent's share is
limited by what its whole subtree holds. Each leaf then takes whole epochs and the
prefix of one more, each epoch in an order of its own seeded by hash.

A prefix is found without sorting the leaf: tokens are summed per leaf and hash bucket,
buckets before the cut are taken whole, and only the bucket with the cut is ordered.

Defined results. Null text has no tokens; null language or source is a name of its own,
the empty one. A leaf without tokens gives no rows. A document that starts before the
cut is taken whole. Equal rows are interchangeable, and as many are taken as fall before
the cut. Weights are whole numbers; what isn't listed has ``DEFAULT``. Budgets are
rounded down. Extra columns are kept by :func:`mixed` and ignored by :func:`chosen`.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from civicloom.llm.common import text_of
from civicloom.session import stage_table

DEFAULT = "*"
BUCKET_DIGITS = 3  # 4,096 buckets a leaf
LEAF = ["domain", "language", "source"]


def numbered_domain(source: Column) -> Column:
    """Stand-in for a domain column, which the given tables lack: sources are dealt out by their number."""
    number = F.regexp_extract(source, "([0-9]+)$", 1)
    at = F.when(number != "", number.try_cast("bigint") % 3)
    return F.when(at == 0, "web").when(at == 1, "reference").when(at == 2, "dialogue").otherwise("other")


class Targets(NamedTuple):
    budget_percent: int = 90
    max_epochs: int = 2
    seed: int = 7
    domain: Callable[[Column], Column] = numbered_domain
    domains: Mapping[str, int] = {"web": 5, "reference": 3, "dialogue": 2, DEFAULT: 1}
    languages: Mapping[str, int] = {"en": 5, "de": 2, "fr": 2, "es": 2, DEFAULT: 1}
    sources: Mapping[str, int] = {DEFAULT: 1}


def _row_key() -> Column:
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("doc_id", "lang", "source")]
    return F.md5(F.concat_ws("\x1f", *parts, F.md5(text_of())))


def _sized(docs: DataFrame, targets: Targets) -> DataFrame:
    """``row_key, doc_id, domain, language, source, n_tokens`` of every row; tokens are words."""
    named = docs.select(
        "doc_id", _row_key().alias("row_key"),
        F.coalesce(F.col("lang"), F.lit("")).alias("language"), F.coalesce("source", F.lit("")).alias("source"),
        F.regexp_count(text_of(), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint").alias("n_tokens"),
    )
    return named.withColumn("domain", targets.domain(F.col("source")))


def _weight(weights: Mapping[str, int], name: str) -> Column:
    found = F.lit(weights.get(DEFAULT, 0))
    for key, value in weights.items():
        if key != DEFAULT:
            found = F.when(F.col(name) == key, value).otherwise(found)
    return found.cast("decimal(38,0)")


def _filled(nodes: DataFrame, parent: list[str], name: str, weights: Mapping[str, int]) -> DataFrame:
    """Shares each parent's ``given`` among its nodes by weight, none over its ``room``: adds ``budget``."""
    family = Window.partitionBy(*parent)
    nodes = nodes.withColumn("weight", _weight(weights, name)).withColumn(
        "room", F.when(F.col("weight") > 0, F.col("room")).otherwise(0).cast("decimal(38,0)")
    )
    tightest = family.orderBy(F.col("room").cast("double") / F.greatest("weight", F.lit(1)).cast("double"), name)
    before = F.coalesce(F.sum("room").over(tightest.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    behind = F.sum("weight").over(tightest.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    nodes = nodes.withColumns({"before": before.cast("decimal(19,0)"), "behind": behind.cast("decimal(18,0)")})
    small, weight = F.col("room").cast("decimal(19,0)"), F.col("weight").cast("decimal(18,0)")
    full = small * F.col("behind") < (F.col("given").cast("decimal(19,0)") - F.col("before")) * weight
    nodes = nodes.withColumn("full", full)
    used = F.sum(F.when(F.col("full"), small).otherwise(0)).over(family).cast("decimal(19,0)")
    open_weight = F.sum(F.when(F.col("full"), 0).otherwise(weight)).over(family).cast("decimal(18,0)")
    nodes = nodes.withColumns({"used": used, "open": open_weight})
    share = F.expr("CASE WHEN open > 0 THEN ((CAST(given AS decimal(19,0)) - used) * CAST(weight AS decimal(18,0))) DIV open ELSE 0 END")
    return nodes.withColumn("budget", F.when(F.col("full"), small).otherwise(share).cast("bigint")).drop(
        "weight", "before", "behind", "full", "used", "open", "given"
    )


def leaf_budgets(sizes: DataFrame, targets: Targets) -> DataFrame:
    """``domain, language, source, tokens, budget`` of every leaf."""
    leaves = sizes.groupBy(*LEAF).agg(F.sum("n_tokens").alias("tokens"))
    leaves = stage_table(leaves.withColumn("room", F.col("tokens") * targets.max_epochs), "leaves")
    total = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0)).cast("bigint")).first()[0] * targets.budget_percent // 100
    domains = leaves.groupBy("domain").agg(F.sum("room").alias("room")).withColumns(
        {"given": F.lit(total).cast("bigint"), "top": F.lit(0)}
    )
    domains = _filled(domains, ["top"], "domain", targets.domains).selectExpr("domain", "budget AS given")
    languages = leaves.groupBy("domain", "language").agg(F.sum("room").alias("room")).join(domains, "domain")
    languages = _filled(languages, ["domain"], "language", targets.languages)
    languages = languages.selectExpr("domain", "language", "budget AS given")
    under = leaves.join(languages, ["domain", "language"])
    return _filled(under, ["domain", "language"], "source", targets.sources).select(*LEAF, "tokens", "budget")


def chosen(docs: DataFrame, targets: Targets = Targets()) -> DataFrame:
    """``row_key, doc_id, domain, language, source, n_tokens, epoch``: a row for each time a document is taken."""
    sizes = stage_table(_sized(docs, targets), "sizes")
    budgets = leaf_budgets(sizes, targets).filter("tokens > 0").selectExpr(
        *LEAF, "CAST(budget DIV tokens AS int) AS epochs", "budget % tokens AS cut"
    )
    budgets = stage_table(budgets, "budgets")
    rows = sizes.join(budgets, LEAF)
    names = ["row_key", "doc_id", *LEAF, "n_tokens"]
    whole = rows.filter("epochs > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("epochs") - 1)))

    order = F.md5(F.concat_ws(":", F.lit(str(targets.seed)), F.col("epochs").cast("string"), "row_key"))
    part = rows.filter("cut > 0").withColumn("order", order).withColumn("bucket", F.substring("order", 1, BUCKET_DIGITS))
    earlier = Window.partitionBy(*LEAF).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = part.groupBy(*LEAF, "bucket").agg(F.sum("n_tokens").alias("tokens"))
    buckets = stage_table(buckets.withColumn("before", F.coalesce(F.sum("tokens").over(earlier), F.lit(0))), "buckets")
    part = part.join(buckets, [*LEAF, "bucket"]).filter("before < cut")
    inside = part.filter("before + tokens < cut")
    across = part.filter("before + tokens >= cut")
    ahead = Window.partitionBy(*LEAF).orderBy("order").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("before") + F.coalesce(F.sum("n_tokens").over(ahead), F.lit(0))
    across = across.withColumn("start", start).filter("start < cut")
    prefix = inside.select(*names, "epochs").unionByName(across.select(*names, "epochs"))
    return whole.select(*names, "epoch").unionByName(prefix.withColumnRenamed("epochs", "epoch"))


def mixture(docs: DataFrame, targets: Targets = Targets()) -> DataFrame:
    """``doc_id, domain, language, source, n_tokens, epoch`` of what is taken."""
    return chosen(docs, targets).drop("row_key")


def mixed(docs: DataFrame, targets: Targets = Targets()) -> DataFrame:
    """The rows taken, with their own columns; a row taken in several epochs comes as often."""
    taken = chosen(docs, targets).groupBy("row_key", "epoch").agg(F.count(F.lit(1)).alias("n"))
    rows = docs.select(F.struct("*").alias("row"), _row_key().alias("row_key"))
    copy = F.row_number().over(Window.partitionBy("row_key").orderBy("row_key"))
    return rows.withColumn("copy", copy).join(taken, "row_key").filter("copy <= n").select("row.*")
