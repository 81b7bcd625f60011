"""Gold marts over the silver complaints and the staged macro series."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from civicloom import rules
from civicloom.functions.columns import (
    blank_to_null,
    clean_upper,
    count_where,
    full_address,
    neighborhood_quality,
    normalize_address,
    percent_of,
    risk_class,
    risk_tier,
    round_half_away,
    timestamp_literal,
)
from civicloom.functions.windows import global_rank
from civicloom.session import stage_table

# A calendar frame has one narrow row per day. 200,000 days (five centuries) of a few
# doubles is some 15 MB, which any executor can hold.
MAX_BROADCAST_DAYS = 200_000


def _is(name: str, value: str) -> Column:
    return F.col(name) == value


def _not_closed() -> Column:
    return F.col("status") != rules.CLOSED_STATUS


def _settled_days() -> Column:
    return F.when(F.col("resolution_days") >= 0, F.col("resolution_days"))


def with_address(silver: DataFrame) -> DataFrame:
    return silver.filter(F.trim("incident_address") != "")


# --- Complaint marts --------------------------------------------------------


DAILY_MEASURES = ["total_complaints", "closed_complaints", "open_complaints", "avg_resolution_days", "anomaly_count"]


def daily_aggregates() -> list[Column]:
    """The measures of the daily mart; the streaming form uses the same list."""
    return [
        F.count(F.lit(1)).alias("total_complaints"),
        count_where(_is("status", rules.CLOSED_STATUS)).alias("closed_complaints"),
        count_where(F.col("status").isin(rules.OPEN_STATUSES)).alias("open_complaints"),
        round_half_away(F.avg(_settled_days()), 1).alias("avg_resolution_days"),
        count_where(F.col("is_resolution_anomaly")).alias("anomaly_count"),
    ]


def daily_parts() -> list[Column]:
    """The daily measures as sums, which add up over batches of rows."""
    counts = [c for c, name in zip(daily_aggregates(), DAILY_MEASURES) if name != "avg_resolution_days"]
    return [*counts, F.sum(_settled_days()).alias("settled_days"), F.count(_settled_days()).alias("settled_rows")]


def daily_from_parts(parts: DataFrame) -> DataFrame:
    """The daily mart from ``daily_parts`` of any number of batches."""
    average = F.sum("settled_days") / F.nullif(F.sum("settled_rows"), F.lit(0))
    measures = {c: F.sum(c) for c in DAILY_MEASURES} | {"avg_resolution_days": round_half_away(average, 1)}
    return parts.groupBy("complaint_date", "borough").agg(*[measures[c].alias(c) for c in DAILY_MEASURES])


def daily_complaints(silver: DataFrame) -> DataFrame:
    return silver.groupBy("complaint_date", "borough").agg(*daily_aggregates())


def borough_summary(silver: DataFrame) -> DataFrame:
    """Precinct statistics, top complaint type and priority rank.

    One pass over silver makes a cube of (precinct, borough, type) cells; both the
    statistics and the top type are taken from those cells. The top type is per
    precinct, across its boroughs. ``open`` here means any status but CLOSED. Ranking
    sorts the statistics now; the rest is lazy.
    """
    cells = (
        silver.filter(F.col("police_precinct") != rules.UNASSIGNED_PRECINCT)
        .groupBy("police_precinct", "borough", "complaint_type")
        .agg(
            F.count(F.lit(1)).alias("total"),
            count_where(_not_closed()).alias("open"),
            F.sum(_settled_days()).alias("days"),
            F.count(_settled_days()).alias("settled"),
            count_where(F.col("is_resolution_anomaly")).alias("anomalies"),
        )
    )
    by_type = Window.partitionBy("police_precinct", "complaint_type")
    by_size = Window.partitionBy("police_precinct").orderBy(
        F.desc("type_total"), F.col("complaint_type").asc_nulls_last()
    )
    ranked = cells.withColumn("type_total", F.sum("total").over(by_type)).withColumn(
        "top_type", F.first("complaint_type").over(by_size)
    )
    stats = ranked.groupBy("police_precinct", "borough").agg(
        F.sum("total").alias("total_complaints"),
        F.sum("open").alias("open_complaints"),
        percent_of(F.sum("open"), F.sum("total"), 1).alias("open_rate_pct"),
        round_half_away(
            F.sum("days").cast("double") / F.nullif(F.sum("settled"), F.lit(0)), 1
        ).alias("avg_resolution_days"),
        F.sum("anomalies").alias("anomaly_count"),
        percent_of(F.sum("anomalies"), F.sum("total"), 2).alias("anomaly_rate_pct"),
        F.first("top_type").alias("top_complaint_type"),
    )
    return priority_rank(stats)


def priority_rank(stats: DataFrame) -> DataFrame:
    """1 for the precinct with the highest open rate, then the slowest one."""
    order = [
        F.col("open_rate_pct").desc_nulls_last(),
        F.col("avg_resolution_days").desc_nulls_last(),
        F.col("police_precinct").asc_nulls_last(),
        F.col("borough").asc_nulls_last(),
    ]
    return global_rank(stats, order, "priority_rank").select("priority_rank", *stats.columns)


def anomaly_summary(silver: DataFrame) -> DataFrame:
    keys = ["agency", "agency_name", "complaint_type", "borough", "police_precinct"]
    year = F.year("created_date").cast("bigint").alias("complaint_year")
    return (
        silver.filter("is_resolution_anomaly")
        .groupBy(*keys, year)
        .agg(
            F.count(F.lit(1)).alias("anomaly_count"),
            round_half_away(F.avg("resolution_days"), 1).alias("avg_days_early"),
            F.min("resolution_days").alias("worst_case_days"),
            F.countDistinct("complaint_id").alias("unique_complaints"),
        )
    )


def resolution_anomalies(silver: DataFrame) -> DataFrame:
    return silver.filter("is_resolution_anomaly").select(
        "complaint_id", "created_date", "closed_date", "resolution_days", "complaint_type",
        "descriptor", "agency", "agency_name", "borough", "police_precinct",
        "incident_address", "zip_code", "channel_type", "resolution_description",
        F.year("created_date").cast("bigint").alias("complaint_year"),
    )


# --- Macro series -----------------------------------------------------------


def pivot_macro(obs: DataFrame, series: Mapping[str, str] = rules.MACRO_SERIES) -> DataFrame:
    """Long to wide: one row per date, one column per series."""
    return obs.groupBy("observation_date").agg(
        *[
            F.max(F.when(F.col("series_id") == key, F.col("value"))).alias(column)
            for key, column in series.items()
        ]
    )


def macro_calendar(macro: DataFrame, last: date, reference_col: str) -> DataFrame:
    """Every day from the first observation to ``last`` with each series carried forward.

    Each series is filled on its own, since a wide row may hold a value for one
    series and NULL for another. The windows are per series, and a series has at
    most one row per day.
    """
    columns = [c for c in macro.columns if c != "observation_date"]
    dated = macro.withColumn(reference_col, F.datediff("observation_date", F.lit("1970-01-01")).cast("double"))
    points = dated.unpivot(
        "observation_date", [*columns, reference_col], "series", "value"
    ).filter(F.col("value").isNotNull())
    spec = Window.partitionBy("series").orderBy("observation_date")
    until = F.coalesce(F.date_sub(F.lead("observation_date").over(spec), 1), F.lit(last))
    days = points.withColumn("until", until).select(
        "series", "value", F.explode(F.sequence("observation_date", "until")).alias("day")
    )
    wide = days.groupBy("day").agg(
        *[F.max(F.when(F.col("series") == c, F.col("value"))).alias(c) for c in [*columns, reference_col]]
    )
    return wide.withColumn(
        reference_col, F.date_add(F.lit("1970-01-01").cast("date"), F.col(reference_col).cast("int"))
    )


def join_macro(
    df: DataFrame, macro: DataFrame, mode: str = "month", reference_col: str = "macro_reference_date"
) -> DataFrame:
    """Add the macro columns to dated rows.

    ``month`` matches the first day of the complaint's month, so a quarterly series
    is filled only in the first month of its quarter. ``asof`` gives each series its
    latest value on or before the complaint date.

    ``macro`` has one row per date. Its first and last dates bound how many rows
    either form can have, and only a bound that fits is broadcast; a wider one joins
    by shuffle on the date.
    """
    first, last = macro.agg(F.min("observation_date"), F.max("observation_date")).first()
    if mode == "month":
        side = macro.withColumnRenamed("observation_date", reference_col).withColumn(
            "_day", F.col(reference_col)
        )
        day = F.trunc("complaint_date", "MM")
    elif mode == "asof":
        side = macro_calendar(macro, last or date(1970, 1, 1), reference_col).withColumnRenamed("day", "_day")
        day = F.when(
            F.col("complaint_date").isNotNull(), F.least("complaint_date", F.lit(last).cast("date"))
        )
    else:
        raise ValueError(f"mode must be month or asof, not {mode}")
    days = 0 if first is None else (last - first).days + 1
    if days <= MAX_BROADCAST_DAYS:
        side = F.broadcast(side)
    columns = [c for c in side.columns if c != "_day"]
    return df.join(side, day == F.col("_day"), "left").select(
        *[df[c] for c in df.columns], reference_col, *[c for c in columns if c != reference_col]
    )


def property_incidents(
    silver: DataFrame, macro: DataFrame, mode: str = "month", reference_col: str = "macro_reference_date"
) -> DataFrame:
    """Every addressed complaint with its clean address and macro context.

    Silver has one row per complaint, so address cleaning and the macro join are one
    projection and one join on the date: complaints are never shuffled.
    """
    address = [F.col("incident_address"), F.col("city"), F.col("borough"), F.col("zip_code")]
    rows = with_address(silver).select(
        "complaint_id",
        normalize_address(address[0]).alias("incident_address"),
        full_address(*address).alias("full_address"),
        F.col("city").alias("neighborhood"),
        neighborhood_quality(F.col("city"), F.col("borough")).alias("neighborhood_quality_flag"),
        "zip_code", "borough", "latitude", "longitude", "complaint_date", "created_date",
        "closed_date", "complaint_type", "descriptor", "agency", "agency_name", "status",
        "channel_type", "location_type", "police_precinct", "community_board",
        "resolution_days", "resolution_date", "resolution_description", "is_resolution_anomaly",
    )
    return join_macro(rows, macro, mode, reference_col)


# --- Address risk -----------------------------------------------------------

ADDRESS_KEYS = [
    "incident_address", "full_address", "neighborhood", "borough", "zip_code",
    "police_precinct", "community_board",
]

#: The same grain with one short text for both forms of the address.
LINE_KEYS = ["line", *ADDRESS_KEYS[2:]]


# Yes/no facts a complaint contributes to its address, as 1 or NULL columns.
def _risk_flags() -> dict[str, Column]:
    kind = risk_class(F.col("complaint_type"))
    flags = {"open_complaints": _not_closed(), "anomaly_count": F.col("is_resolution_anomaly")}
    flags |= {f"{name.lower()}_risk_complaints": kind == name for name in ("HIGH", "MEDIUM", "LOW")}
    flags |= {f"{name.lower()}_complaints": _is("channel_type", name) for name in ("PHONE", "ONLINE", "MOBILE")}
    return flags


def risk_base(silver: DataFrame) -> DataFrame:
    """The columns the score needs, addresses cleaned and facts turned into flags.

    Stored before it is aggregated, so that silver and its address texts are gone through once. Both forms of
    the address follow from ``line`` and the other keys, so only that is stored and grouped by.
    """
    # Without a borough there is no full address, and lines of one normal form are one address.
    line = F.when(F.col("borough").isNull(), normalize_address(F.col("incident_address")))
    return with_address(silver).select(
        F.coalesce(line, clean_upper(F.col("incident_address"))).alias("line"),
        clean_upper(F.col("city")).alias("neighborhood"),
        clean_upper(F.col("borough")).alias("borough"),
        blank_to_null(F.col("zip_code")).alias("zip_code"),
        "police_precinct", "community_board", "latitude", "longitude", "complaint_type",
        "complaint_date", _settled_days().alias("settled_days"),
        *[F.when(test, 1).alias(name) for name, test in _risk_flags().items()],
    )


def address_types(base: DataFrame) -> DataFrame:
    """Top type and highest risk class per (address, zip), both from one set of counts.

    A NULL zip matches nothing in the later join, so those rows are left out here.
    """
    # Lines are counted as they are, so that only different ones are brought into normal form.
    lines = (
        base.filter(F.col("zip_code").isNotNull())
        .groupBy("line", "zip_code", F.col("borough").isNull().alias("normal"), "complaint_type")
        .agg(F.count(F.lit(1)).alias("cell"))
    )
    address = F.when(F.col("normal"), F.col("line")).otherwise(normalize_address(F.col("line")))
    cells = lines.groupBy(address.alias("incident_address"), "zip_code", "complaint_type").agg(F.sum("cell").alias("cell"))
    kind = risk_class(F.col("complaint_type"))
    grade = F.when(kind == "HIGH", 3).when(kind == "MEDIUM", 2).otherwise(0)
    biggest = F.struct(-F.col("cell"), F.col("complaint_type").isNull(), F.col("complaint_type"))
    best = F.max(grade)
    return cells.groupBy("incident_address", "zip_code").agg(
        F.min_by("complaint_type", biggest).alias("top_complaint_type"),
        F.when(best == 3, "HIGH").when(best == 2, "MEDIUM").otherwise("LOW").alias(
            "highest_complaint_risk_class"
        ),
    )


def risk_score() -> Column:
    weights = rules.SCORE_WEIGHTS
    raw = (
        F.col("total_complaints") * F.lit(weights["total"])
        + F.col("open_complaints") * F.lit(weights["open"])
        + F.coalesce("avg_resolution_days", F.lit(0.0)) * F.lit(weights["days"])
        + F.col("anomaly_count") * F.lit(weights["anomaly"])
        + F.col("high_risk_complaints") * F.lit(weights["high"])
    )
    return round_half_away(F.least(F.lit(rules.SCORE_CAP), raw), 1)


def address_risk_score(silver: DataFrame, scored_at: datetime) -> DataFrame:
    """Complaint profile and risk score per address.

    The grain is the seven ``ADDRESS_KEYS``, not address and zip alone. All
    aggregates are partial first, so a hot address reaches its reducer as a few
    partial rows. Its days and types are held as sets, which the calendar and the list of
    types bound, so no row is expanded for the distinct counts. ``silver`` is read once.
    """
    base = stage_table(risk_base(silver), "risk_base")
    measures = base.groupBy(*LINE_KEYS).agg(
        round_half_away(F.avg("latitude"), 6).alias("latitude"),
        round_half_away(F.avg("longitude"), 6).alias("longitude"),
        F.count(F.lit(1)).alias("total_complaints"),
        F.size(F.collect_set("complaint_date")).cast("bigint").alias("complaint_days"),
        F.size(F.collect_set("complaint_type")).cast("bigint").alias("distinct_complaint_types"),
        round_half_away(F.avg("settled_days"), 1).alias("avg_resolution_days"),
        F.max("settled_days").alias("max_resolution_days"),
        *[F.count(name).alias(name) for name in _risk_flags()],
        F.min("complaint_date").alias("first_complaint_date"),
        F.max("complaint_date").alias("last_complaint_date"),
    )
    total = F.col("total_complaints")
    shares = {"open_rate_pct": ("open_complaints", 1), "anomaly_rate_pct": ("anomaly_count", 2)}
    history = F.datediff("last_complaint_date", "first_complaint_date").cast("bigint")
    measures = measures.select(
        "*",
        F.when(F.col("borough").isNull(), F.col("line")).otherwise(normalize_address(F.col("line"))).alias("incident_address"),
        full_address(F.col("line"), F.col("neighborhood"), F.col("borough"), F.col("zip_code")).alias("full_address"),
        *[
            round_half_away(F.col(part).cast("double") / total * 100, digits).alias(name)
            for name, (part, digits) in shares.items()
        ],
        history.alias("complaint_history_days"),
    )
    scored = measures.withColumn("property_risk_score", risk_score()).join(
        address_types(base), ["incident_address", "zip_code"], "left"
    )
    return scored.select(
        *ADDRESS_KEYS, "latitude", "longitude", "property_risk_score",
        risk_tier(F.col("property_risk_score")).alias("risk_tier"),
        "highest_complaint_risk_class", "total_complaints", "complaint_days",
        "distinct_complaint_types", "top_complaint_type", "open_complaints", "open_rate_pct",
        "avg_resolution_days", "max_resolution_days", "anomaly_count", "anomaly_rate_pct",
        "high_risk_complaints", "medium_risk_complaints", "low_risk_complaints",
        "phone_complaints", "online_complaints", "mobile_complaints",
        "first_complaint_date", "last_complaint_date", "complaint_history_days",
        timestamp_literal(scored_at).alias("scored_at"),
    )
