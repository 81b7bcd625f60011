"""Stand-in inputs: the shapes the operators expect, derived from the given tables.

Every frame reads whole tables; only the needed columns are scanned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# How source codes show up as complaint fields.
PRIORITY_TYPES = {
    "1-URGENT": "Heat/Hot Water",
    "2-HIGH": " Plumbing",
    "3-MEDIUM": "Noise - Residential",
    "4-NOT SPECIFIED": "Illegal Parking",
    "5-LOW": "Street Light",
}
REGION_BOROUGHS = {0: "Bronx", 1: "Brooklyn", 2: "Manhattan", 3: "Queens"}
STREETS = ["main st", "Oak Ave", "Street Rd", "Park Street", "Elm Pl"]
CITIES = [None, "Queens", "Astoria", "Jamaica", "Hoboken", "New York"]
OPEN_BY_FLAG = {"N": "Open", "R": "In Progress", "A": "Unknown"}
CHANNEL_BY_FLAG = {"N": "phone", "R": "online", "A": "mobile"}
PRIORITY_SERIES = {"1-URGENT": "UNRATE", "2-HIGH": "CPIAUCSL", "3-MEDIUM": "FEDFUNDS"}
#: The complaint's key begins with these, and raw complaints are joined by them.
WITHIN = ["l_orderkey"]
TIE_BREAKERS = ["l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _choose(column: Column, values: dict) -> Column:
    (first, label), *rest = values.items()
    chain = F.when(column == first, label)
    for key, value in rest:
        chain = chain.when(column == key, value)
    return chain


def _pick(index: Column, values: list) -> Column:
    return F.get(F.array(*map(F.lit, values)), index.cast("int"))


def raw_complaints(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    # Orders find their place first, so that the many lines are shuffled once, by order.
    placed = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    rows = lines.join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
    supp, part = F.col("l_suppkey"), F.col("l_partkey")
    closed = F.col("l_linestatus") == "F"
    return rows.select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("unique_key"),
        F.col("o_orderdate").alias("created_date"),
        F.when(closed, F.col("l_shipdate")).alias("closed_date"),
        _choose(F.col("o_orderpriority"), PRIORITY_TYPES).alias("complaint_type"),
        F.col("o_orderpriority").alias("descriptor"),
        F.col("c_mktsegment").alias("agency"),
        F.col("c_mktsegment").alias("agency_name"),
        _choose(F.col("n_regionkey"), REGION_BOROUGHS).alias("borough"),
        F.when(part % 50 == 0, None)
        .when(part % 51 == 0, "  ")
        .otherwise(F.concat(supp.cast("string"), F.lit(" "), _pick(supp % 5, STREETS)))
        .alias("incident_address"),
        F.when(supp % 7 != 0, (10000 + supp % 20).cast("string")).alias("incident_zip"),
        _pick(supp % 6, CITIES).alias("city"),
        F.when(closed, "Closed").otherwise(_choose(F.col("l_returnflag"), OPEN_BY_FLAG)).alias("status"),
        F.concat(F.lit("BOARD "), F.col("n_regionkey").cast("string")).alias("community_board"),
        F.when(F.col("n_nationkey") == 0, "Unspecified")
        .when(F.col("n_nationkey") != 1, F.col("n_name"))
        .alias("police_precinct"),
        _choose(F.col("l_returnflag"), CHANNEL_BY_FLAG).alias("open_data_channel_type"),
        F.col("c_mktsegment").alias("location_type"),
        F.col("l_returnflag").alias("resolution_description"),
        F.col("l_shipdate").alias("resolution_action_updated_date"),
        (F.lit(40.5) + supp / 1000.0).alias("latitude"),
        (F.lit(-74.0) + supp / 1000.0).alias("longitude"),
        *TIE_BREAKERS,
        *WITHIN,
    )


def event_complaints(spark: SparkSession, events: DataFrame) -> DataFrame:
    """Events as silver rows: one per event, the event type as borough."""
    settled = F.col("value") < 100
    return events.select(
        F.col("event_id").cast("string").alias("complaint_id"),
        F.col("ts").alias("created_date"),
        F.col("event_type").alias("borough"),
        F.when(settled, "CLOSED").when(F.col("value") < 200, "OPEN").otherwise("UNKNOWN").alias("status"),
        F.when(settled, F.floor("value").cast("bigint") - 5).alias("resolution_days"),
        (settled & (F.floor("value") < 5)).alias("is_resolution_anomaly"),
        F.col("ts").cast("date").alias("complaint_date"),
    )


def macro_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(series_id, load_stamp, observation_date, raw_value): two overlapping snapshots.

    Three monthly series from order values by priority, one quarterly series over all
    orders. The second snapshot revises 1998 onwards. Every thirteenth month has no
    value yet, which the source writes as a dot.
    """
    orders = table(spark, sf_dir, "orders")
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    monthly = (
        orders.select(
            _choose(F.col("o_orderpriority"), PRIORITY_SERIES).alias("series_id"),
            F.trunc("o_orderdate", "MM").alias("observation_date"),
            cents.alias("cents"),
        )
        .filter(F.col("series_id").isNotNull())
        .groupBy("series_id", "observation_date")
        .agg(F.expr("sum(cents) div count(*)").alias("amount"))
    )
    quarterly = (
        orders.groupBy(F.trunc("o_orderdate", "quarter").alias("observation_date"))
        .agg(F.sum(cents).alias("amount"))
        .select(F.lit("GDP").alias("series_id"), "observation_date", "amount")
    )
    month_number = F.year("observation_date") * 12 + F.month("observation_date")
    snapshots = monthly.unionByName(quarterly).withColumn("load_stamp", F.explode(F.array(F.lit(1), F.lit(2))))
    return snapshots.filter("load_stamp = 1 OR observation_date >= DATE'1998-01-01'").select(
        "series_id", "load_stamp", "observation_date",
        F.when(month_number % 13 == 0, ".")
        .otherwise((F.col("amount") + F.col("load_stamp")).cast("string"))
        .alias("raw_value"),
    )


def raw_macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same points as nested documents, one per series and snapshot (a row per month)."""
    element = F.struct(
        F.col("observation_date").cast("string").alias("date"), F.col("raw_value").alias("value")
    )
    return macro_points(spark, sf_dir).groupBy("series_id", "load_stamp").agg(
        F.array_sort(F.collect_list(element)).alias("observations")
    )


def classified_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as records with flags, for the classifier."""
    supp, part = F.col("l_suppkey"), F.col("l_partkey")
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice").alias("record_id"),
        _choose(F.col("l_returnflag"), {"N": "FlightAware", "R": "OpenSky", "A": ""}).alias("source_system"),
        F.when(part % 23 != 0, "valid").alias("validation_status"),
        F.when(supp % 11 != 0, F.concat(F.lit("CS"), supp.cast("string"))).alias("callsign"),
        F.when(part % 17 != 0, F.concat(F.lit("O"), (part % 5).cast("string"))).alias("origin"),
        F.when(part % 19 != 0, F.concat(F.lit("D"), (part % 7).cast("string"))).alias("destination"),
        F.when(F.col("l_linenumber") == 7, None)
        .when(part % 31 == 0, "n/a")
        .otherwise((F.col("l_quantity").cast("bigint") * 30 - 30).cast("string"))
        .alias("duration_minutes"),
        (F.col("l_discount") >= 0.095).alias("duplicate_key"),
        F.when(F.col("l_linestatus") == "F", F.col("l_quantity") > 45).alias("range_violation"),
        (F.col("l_tax") >= 0.075).alias("schema_drift"),
        (part % 97 == 0).alias("security_exposure"),
    )


def coded_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with a list of reason codes each, known and unknown ones."""
    supp, part = F.col("l_suppkey"), F.col("l_partkey")
    codes = F.array(
        F.when(supp % 5 == 0, "missing_optional_field"),
        F.when(F.col("l_linenumber") == 2, "mystery_code"),
        F.when(part % 3 == 0, "duplicate_key"),
        F.when(supp % 4 == 0, "cost_threshold_exceeded"),
        F.when(part % 29 == 0, "security_exposure"),
        F.when(part % 13 == 0, "missing_origin_or_destination"),
    )
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        F.filter(codes, lambda c: c.isNotNull()).alias("codes"),
    )


def routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as flight routes with missing pieces."""
    event = F.col("event_id")
    user = F.col("user_id").cast("string")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_type") == "purchase", "FlightAware ")
        .when(F.col("event_type") == "signup", "OpenSky")
        .when(F.col("event_type") != "view", F.col("event_type"))
        .alias("source_system"),
        F.when(event % 7 == 0, None).when(event % 41 == 0, "").otherwise(F.concat(F.lit("CS"), user)).alias("callsign"),
        F.when(event % 5 != 0, F.concat(F.lit("x"), user)).alias("icao24"),
        F.when(event % 11 != 0, F.concat(F.lit("O"), (event % 9).cast("string"))).alias("origin"),
        F.when(event % 13 != 0, F.concat(F.lit("D"), (event % 8).cast("string"))).alias("destination"),
        F.when(event % 17 == 0, None)
        .when(event % 37 == 0, "n/a")
        .otherwise(F.floor(F.col("value") * 10).cast("string"))
        .alias("duration_minutes"),
        F.when(event % 3 != 0, F.concat(F.lit("h"), user)).alias("payload_hash"),
    )


LOG_GATES = [
    "schema", "data_quality", "validation", "quarantine", "reconciliation", "cost", "security",
    "promotion", "trend_forecast",
]


def gate_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as gate results: a run per day, an asset per event type."""
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("run_"), F.date_format("ts", "yyyyMMdd")).alias("run_id"),
        F.concat(F.lit("gold."), F.col("event_type")).alias("asset_name"),
        _pick(F.col("user_id") % 9, LOG_GATES).alias("gate_name"),
        F.when(F.col("value") < 60, "pass").when(F.col("value") < 120, "warn").otherwise("fail").alias("status"),
        F.concat(F.lit("event "), F.col("event_id").cast("string")).alias("message"),
        F.to_json(F.struct(F.col("event_id").alias("record_count"), F.lit(None).cast("double").alias("threshold_value"),
                           F.col("value").alias("actual_value"), F.col("props").alias("details"))).alias("metrics"),
        F.col("ts").alias("executed_at"),
        F.col("ts").alias("logged_at"),
    )


def validation_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as validation reports."""
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("gold."), F.col("event_type")).alias("asset_name"),
        F.concat(F.lit("ml_"), F.lpad(F.col("event_id").cast("string"), 12, "0")).alias("run_id"),
        _pick(F.col("user_id") % 3, ["APPROVE", "review", "reject"]).alias("recommendation"),
        F.col("props").alias("report"),
        F.col("ts").alias("created_at"),
    )


def region_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per day and region, the shape of the daily mart."""
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .groupBy(F.col("o_orderdate").cast("date").alias("complaint_date"), F.col("r_name").alias("borough"))
        .agg(F.count(F.lit(1)).alias("total_complaints"))
    )
