"""Every registered query: an operator applied to the given tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from civicloom import rules, schemas
from civicloom.functions.columns import (
    full_address,
    neighborhood_quality,
    normalize_address,
    review_bucket,
    round_half_away,
)
from civicloom.functions.windows import keep_latest, top_value
from civicloom.operators import anomaly, classify, forecast, gate_log, gates, marts, silver as silver_layer
from civicloom.operators.gates import GateContext
from civicloom.plans.pipeline import DAILY_CONFIG, Layers, build_gold, run_gates
from civicloom.session import stage_path, stage_table
from civicloom.sources import driver_tables as given
from civicloom.sources.increments import ingest_increment, late_rows
from civicloom.sources.json_arrays import read_json_arrays
from civicloom.sources.readers import (
    malformed_json,
    read_json_bronze,
    read_optional,
    read_tabular,
    with_series_from_filename,
)
from civicloom.sources.sinks import verify_export, write_findings, write_sorted
from civicloom.streaming import streams

SCORED_AT = datetime(2024, 1, 31)
GATES_AT = datetime(2024, 1, 31, 2)
SPLIT_AT = "2024-01-15T12:00:00.000"
JSON_FILE_ROWS = 250_000

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(query: Query) -> Query:
    QUERIES[query.__name__.removeprefix("q_")] = query
    return query


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_layer.stage_complaints(given.raw_complaints(spark, sf_dir), given.TIE_BREAKERS, within=given.WITHIN)


def _stored_silver(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Silver written once, for queries that read it more than once."""
    silver = _silver(spark, sf_dir)
    return stage_table(silver.select(*columns) if columns else silver, "silver")


def _rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: round_half_away(F.col(c), digits) for c in columns})


def _joined(df: DataFrame, *columns: str) -> DataFrame:
    """Lists as comma-separated text."""
    return df.withColumns({c: F.array_join(c, ",") for c in columns})


# --- Silver -----------------------------------------------------------------


@register
def silver_complaints(spark, sf_dir):
    return _silver(spark, sf_dir)


@register
def bronze_json(spark, sf_dir):
    """Silver by way of JSON: everything is text in the files, as the source delivers it."""
    raw, path = given.raw_complaints(spark, sf_dir).drop(*given.WITHIN), stage_path(spark, "json")
    # As plain text the files are ten times the tables; a compressed one is read by one task, so it holds few rows.
    raw.write.option("compression", "gzip").option("maxRecordsPerFile", JSON_FILE_ROWS).json(path)
    typed = [f for f in raw.schema.fields if f.name in given.TIE_BREAKERS]
    schema = T.StructType([*schemas.BRONZE_COMPLAINT.fields, *typed])
    return silver_layer.stage_complaints(read_json_bronze(spark, path, schema, lines=True), given.TIE_BREAKERS)


@register
def q_keep_latest(spark, sf_dir):
    return keep_latest(given.table(spark, sf_dir, "events"), ["user_id"], [F.desc("ts")], [F.desc("event_id")])


@register
def q_ingest_increment(spark, sf_dir):
    """Two pulls: one while the source ends at the split, one after it has grown."""
    events = given.table(spark, sf_dir, "events")
    state, target = stage_path(spark, "mark"), stage_path(spark, "bronze")
    ingest_increment(late_rows(events, "ts", SPLIT_AT), state, "ts", target)
    ingest_increment(events, state, "ts", target)
    return (
        spark.read.parquet(target)
        .groupBy("ingest_mark")
        .agg(
            F.count(F.lit(1)).alias("row_count"), F.countDistinct("event_id").alias("event_count"),
            F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"),
        )
        .drop("ingest_mark")
    )


@register
def q_ingest_late(spark, sf_dir):
    """Two pulls: the second finds rows that are new but before the mark, and they are held, not lost."""
    events = given.table(spark, sf_dir, "events")
    state, target, held = stage_path(spark, "mark"), stage_path(spark, "bronze"), stage_path(spark, "held")
    timed = events.withColumn("ts", F.when(F.col("event_id") % 11 != 0, F.col("ts")))
    first = late_rows(timed, "ts", SPLIT_AT).filter("event_id % 3 <> 0")
    for pull in (first, timed):
        ingest_increment(pull, state, "ts", target, quarantine=held, keys=["event_id"])
    kept = spark.read.parquet(target).select(F.lit("ingested").alias("reason"), "event_id", "ts")
    rows = kept.unionByName(spark.read.parquet(held).select("reason", "event_id", "ts"))
    return rows.groupBy("reason").agg(
        F.count(F.lit(1)).alias("row_count"), F.countDistinct("event_id").alias("event_count"),
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"),
    )


@register
def q_late_rows(spark, sf_dir):
    return late_rows(given.table(spark, sf_dir, "events"), "ts", SPLIT_AT)


# --- Address columns --------------------------------------------------------


@register
def q_normalize_address(spark, sf_dir):
    address = [F.col("incident_address"), F.col("city"), F.col("borough"), F.col("zip_code")]
    return marts.with_address(_silver(spark, sf_dir)).select(
        "complaint_id",
        normalize_address(address[0]).alias("incident_address_clean"),
        full_address(*address).alias("full_address"),
    )


@register
def q_neighborhood_quality(spark, sf_dir):
    flag = neighborhood_quality(F.col("city"), F.col("borough"))
    return (
        _silver(spark, sf_dir)
        .groupBy("borough", "city", flag.alias("neighborhood_quality_flag"))
        .agg(F.count(F.lit(1)).alias("complaints"))
    )


# --- Marts ------------------------------------------------------------------


@register
def daily_complaints(spark, sf_dir):
    return marts.daily_complaints(_silver(spark, sf_dir))


@register
def borough_summary(spark, sf_dir):
    return marts.borough_summary(_silver(spark, sf_dir))


@register
def top_types(spark, sf_dir):
    """Most frequent complaint type per precinct."""
    assigned = _silver(spark, sf_dir).filter(F.col("police_precinct") != rules.UNASSIGNED_PRECINCT)
    return top_value(assigned, ["police_precinct"], "complaint_type")


@register
def anomaly_summary(spark, sf_dir):
    return marts.anomaly_summary(_silver(spark, sf_dir))


@register
def resolution_anomalies(spark, sf_dir):
    return marts.resolution_anomalies(_silver(spark, sf_dir))


def _risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.address_risk_score(_silver(spark, sf_dir), SCORED_AT)


@register
def address_risk_score(spark, sf_dir):
    return _risk(spark, sf_dir)


# --- Macro ------------------------------------------------------------------


def _newest_macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = silver_layer.numeric_observations(given.macro_points(spark, sf_dir))
    return silver_layer.dedupe_observations(points, [F.desc("load_stamp")]).drop("load_stamp")


def _macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide table, written: it is read for its bounds and then for the join."""
    return stage_table(marts.pivot_macro(_newest_macro(spark, sf_dir)), "macro")


@register
def stage_observations(spark, sf_dir):
    return silver_layer.stage_observations(given.raw_macro(spark, sf_dir))


@register
def dedupe_observations(spark, sf_dir):
    return silver_layer.stage_observations(given.raw_macro(spark, sf_dir), [F.desc("load_stamp")])


@register
def explode_props(spark, sf_dir):
    entries = F.from_json("props", "map<string,bigint>")
    return (
        given.table(spark, sf_dir, "events")
        .select("event_type", F.explode(entries).alias("prop", "amount"))
        .groupBy("event_type", "prop")
        .agg(F.count(F.lit(1)).alias("entries"), F.sum("amount").alias("total"), F.max("amount").alias("largest"))
    )


@register
def macro_wide(spark, sf_dir):
    return marts.pivot_macro(_newest_macro(spark, sf_dir))


@register
def macro_recent(spark, sf_dir):
    return anomaly.tail(marts.pivot_macro(_newest_macro(spark, sf_dir)), ["observation_date"], 20)


@register
def property_incidents_month(spark, sf_dir):
    return marts.property_incidents(_silver(spark, sf_dir), _macro(spark, sf_dir), "month")


@register
def property_incidents_asof(spark, sf_dir):
    return marts.property_incidents(_silver(spark, sf_dir), _macro(spark, sf_dir), "asof")


@register
def gold_export(spark, sf_dir):
    """All layers built and exported; the manifest's counts and checksums, held against the files."""
    macro = marts.pivot_macro(_newest_macro(spark, sf_dir))
    ctx = GateContext("gold", "run_check", SCORED_AT)
    manifest = build_gold(
        given.raw_complaints(spark, sf_dir), macro, ctx, stage_path(spark, "lake"), given.TIE_BREAKERS, within=given.WITHIN
    )
    return verify_export(manifest).select("table_name", "row_count", "checksum", "verified")


# --- Gates ------------------------------------------------------------------


def _context(asset: str) -> GateContext:
    return GateContext(asset, "run_check", GATES_AT)


def _gate_rows(*results: DataFrame) -> DataFrame:
    """Several results as one frame, message and details included."""
    rows = reduce(DataFrame.unionByName, results)
    return _rounded(rows, 6, "threshold_value", "actual_value").select(
        "gate_name", "asset_name", "status", "message", "record_count", "threshold_value", "actual_value", "details", "run_id",
        "executed_at",
    )


TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)


@register
def gate_schema_tables(spark, sf_dir):
    """The schema gate on every given table against a contract that lacks its last column, with row counts."""
    found = []
    for name in TABLES:
        df = given.table(spark, sf_dir, name)
        contract = dict(df.dtypes[:-1])
        row = gates.schema_gate(spark, df, _context(name), contract)
        extra = F.from_json("details", "extra_columns array<string>")["extra_columns"]
        count = df.agg(F.count(F.lit(1)).alias("rows")).withColumn("asset_name", F.lit(name))
        found.append(row.select("asset_name", "status", "record_count", F.array_join(extra, ",").alias("extra")).join(count, "asset_name"))
    return reduce(DataFrame.unionByName, found)


@register
def gate_schema(spark, sf_dir):
    lines = given.table(spark, sf_dir, "lineitem")
    contract = {name: kind for name, kind in lines.dtypes}
    changed = {**contract, "l_quantity": "BIGINT"}
    return _gate_rows(
        gates.schema_gate(spark, lines, _context("same"), contract),
        gates.schema_gate(spark, lines, _context("types"), changed),
        gates.schema_gate(spark, lines, _context("missing"), {**contract, "l_comment": "VARCHAR"}),
        gates.schema_gate(spark, lines, _context("extra"), {"l_orderkey": "BIGINT"}),
        gates.schema_gate(spark, None, _context("absent"), contract),
    )


@register
def gate_data_quality(spark, sf_dir):
    silver = _stored_silver(spark, sf_dir, "complaint_id", "police_precinct", "zip_code", "borough", "resolution_days")
    return _gate_rows(
        gates.data_quality_gate(silver, _context("keys"), ["complaint_id", "borough"]),
        gates.data_quality_gate(silver, _context("precinct"), ["complaint_id", "police_precinct"]),
        gates.data_quality_gate(silver, _context("zip"), ["zip_code", "police_precinct"]),
        gates.data_quality_gate(silver, _context("range"), ["complaint_id"], {"resolution_days": (0, 100_000)}),
        gates.data_quality_gate(silver.filter("complaint_id IS NULL"), _context("empty")),
    )


@register
def gate_validation(spark, sf_dir):
    reports = given.validation_reports(spark, sf_dir)
    assets = [f"gold.{kind}" for kind in ("click", "error", "purchase", "signup", "view", "nothing")]
    stale = GateContext("gold.click", "run_check", datetime(2024, 2, 3))
    return _gate_rows(
        *[gates.validation_gate(spark, reports, _context(asset)) for asset in assets],
        gates.validation_gate(spark, reports, stale),
    )


def _layers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(bronze, silver, addressed silver, silver without an address)."""
    bronze = given.table(spark, sf_dir, "lineitem")
    silver = _stored_silver(spark, sf_dir, "complaint_id", "complaint_date", "borough", "incident_address")
    addressed = F.coalesce(F.trim("incident_address") != "", F.lit(False))
    return bronze, silver, silver.filter(addressed), silver.filter(~addressed)


@register
def gate_quarantine(spark, sf_dir):
    _, silver, gold, held = _layers(spark, sf_dir)
    return _gate_rows(
        gates.quarantine_gate(spark, gold, silver, held, _context("default")),
        gates.quarantine_gate(spark, gold, silver, held, _context("strict"), warn=0.01),
        gates.quarantine_gate(spark, gold, silver, None, _context("orphans")),
        gates.quarantine_gate(spark, held, held.filter("complaint_id IS NULL"), held, _context("empty")),
    )


@register
def gate_quarantine_agg(spark, sf_dir):
    _, silver, gold, held = _layers(spark, sf_dir)
    daily = gold.groupBy("complaint_date", "borough").count()
    return _gate_rows(
        gates.quarantine_gate(spark, daily, silver, held, _context("default"), aggregated=True),
        gates.quarantine_gate(spark, daily, silver, held, _context("strict"), warn=0.01, aggregated=True),
    )


@register
def gate_reconciliation(spark, sf_dir):
    bronze, silver, gold, _ = _layers(spark, sf_dir)
    return _gate_rows(
        gates.reconciliation_gate(spark, gold, silver, bronze, _context("attrition")),
        gates.reconciliation_gate(spark, gold, silver, bronze, _context("tolerant"), attrition=0.9),
        gates.reconciliation_gate(spark, bronze, silver, bronze, _context("gold_grew")),
        gates.reconciliation_gate(spark, gold, bronze, silver, _context("silver_grew")),
        gates.reconciliation_gate(spark, gold, None, None, _context("alone")),
    )


@register
def gate_reconciliation_agg(spark, sf_dir):
    bronze, silver, gold, _ = _layers(spark, sf_dir)
    daily = gold.groupBy("complaint_date", "borough").count()
    return _gate_rows(
        gates.reconciliation_gate(spark, daily, silver, bronze, _context("fine"), aggregated=True),
        gates.reconciliation_gate(spark, daily, bronze, silver, _context("silver_grew"), aggregated=True),
    )


@register
def gate_cost(spark, sf_dir):
    lines = given.table(spark, sf_dir, "lineitem")
    return _gate_rows(
        gates.cost_gate(lines, _context("default")),
        gates.cost_gate(lines, _context("soft"), soft_mb=0.5, hard_mb=1e6),
        gates.cost_gate(lines, _context("hard"), soft_mb=0.5, hard_mb=1.0),
    )


@register
def gate_cost_measured(spark, sf_dir):
    path = f"{sf_dir}/lineitem.parquet"
    row = gates.cost_gate(spark.read.parquet(path), _context("stored"), hard_mb=1e9, soft_mb=1e9, path=path)
    return row.select("gate_name", "asset_name", "status", "record_count", (F.col("actual_value") > 0).alias("has_size"))


@register
def gate_security_values(spark, sf_dir):
    scans = [
        gates.scan_sensitive(given.table(spark, sf_dir, name)).select(F.lit(name).alias("table_name"), "*")
        for name in ("documents", "conversations", "pages")
    ]
    return reduce(DataFrame.unionByName, scans)


@register
def gate_security(spark, sf_dir):
    documents = given.table(spark, sf_dir, "documents")
    lines = given.table(spark, sf_dir, "lineitem")
    return _gate_rows(
        gates.security_gate(spark, documents, _context("documents")),
        gates.security_gate(spark, documents, _context("whitelisted"), whitelist=["text"]),
        gates.security_gate(spark, lines, _context("lineitem")),
        gates.security_gate(spark, lines.withColumnRenamed("l_tax", "api_key"), _context("renamed")),
    )


@register
def gate_promotion(spark, sf_dir):
    return _joined(
        gates.promotion_by_run(given.gate_log(spark, sf_dir)), "missing_gates", "failing_gates", "warning_gates"
    )


@register
def q_run_gates(spark, sf_dir):
    """The seven gates and the verdict on the library's own daily mart, under its own configuration."""
    return _gates_on_daily(spark, sf_dir, lambda daily: daily, DAILY_CONFIG)


@register
def q_run_gates_broken(spark, sf_dir):
    """A mart without its borough and with a range on a text column: gates that can't run say ``fail``."""
    config = replace(DAILY_CONFIG, ranges={"complaint_text": (0, 1)})
    return _gates_on_daily(
        spark, sf_dir, lambda daily: daily.withColumn("complaint_text", F.lit("many")).drop("borough"), config
    )


def _gates_on_daily(spark, sf_dir, change, config):
    bronze = given.table(spark, sf_dir, "lineitem")
    silver = _stored_silver(spark, sf_dir)
    held = silver.filter(~F.coalesce(F.trim("incident_address") != "", F.lit(False)))
    gold = stage_table(change(marts.daily_complaints(silver)), "gold")
    layers = Layers(gold, silver, bronze, held, given.validation_reports(spark, sf_dir))
    log = stage_path(spark, "gate_log")
    return run_gates(spark, layers, config, _context("gold.click"), log).select(
        "run_id", "asset_name", "gate_name", "status", "executed_at"
    )


@register
def constraint_checks(spark, sf_dir):
    silver = _stored_silver(spark, sf_dir, "complaint_id", "created_date", "complaint_type", "borough", "status", "zip_code")
    return gates.check_constraints(
        silver,
        unique=["complaint_id", "created_date"],
        not_null=["complaint_id", "created_date", "complaint_type", "status", "zip_code"],
        accepted={"borough": [*rules.BOROUGHS, rules.DEFAULT_BOROUGH], "status": ["CLOSED", "OPEN"]},
    )


# --- Log --------------------------------------------------------------------


@register
def log_latest_summary(spark, sf_dir):
    return gate_log.latest_run_summary(given.gate_log(spark, sf_dir))


@register
def log_verdicts(spark, sf_dir):
    return gate_log.promotion_verdicts(given.gate_log(spark, sf_dir))


@register
def log_grid(spark, sf_dir):
    grid = gate_log.gate_grid(given.gate_log(spark, sf_dir), [*rules.REQUIRED_GATES, rules.PROMOTION_GATE])
    others = F.transform(F.map_entries("other_gates"), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return grid.withColumn("other_gates", F.array_join(others, ","))


@register
def log_timeline(spark, sf_dir):
    return gate_log.run_timeline(given.gate_log(spark, sf_dir))


@register
def log_run_detail(spark, sf_dir):
    return gate_log.run_detail(given.gate_log(spark, sf_dir), "run_20240115").drop("metrics")


# --- Classification ---------------------------------------------------------


@register
def q_defect_rules(spark, sf_dir):
    """The rule table with how often each rule fires. The rules are 13 rows."""
    codes = given.coded_lines(spark, sf_dir).select(F.explode("codes").alias("defect_type"))
    used = codes.groupBy("defect_type").agg(F.count(F.lit(1)).alias("occurrences"))
    table = classify.defect_rules(spark).drop("description")
    return table.join(used, "defect_type", "left").fillna(0, ["occurrences"])


@register
def score_defects(spark, sf_dir):
    scored = classify.score_defects(given.coded_lines(spark, sf_dir), "codes")
    return _joined(scored.drop("codes"), "reason_codes", "unknown_defects")


@register
def recoverability(spark, sf_dir):
    scored = classify.score_recoverability(given.coded_lines(spark, sf_dir), "codes")
    return scored.withColumn("review_bucket", review_bucket(F.col("recoverability_score"))).drop("codes")


@register
def q_classify(spark, sf_dir):
    return classify.classify(given.classified_lines(spark, sf_dir), "aviation").drop("reason_codes")


@register
def classify_control(spark, sf_dir):
    return classify.classify(given.classified_lines(spark, sf_dir), "validation_control").drop("reason_codes")


@register
def quarantine_split(spark, sf_dir):
    records = classify.classify(given.classified_lines(spark, sf_dir), "aviation")
    sides = dict(zip(("gold", "quarantine"), classify.quarantine_split(records)))
    rows = reduce(DataFrame.unionByName, [df.withColumn("side", F.lit(name)) for name, df in sides.items()])
    return rows.groupBy("side", "validation_status", "severity").agg(F.count(F.lit(1)).alias("records"))


@register
def route_confidence(spark, sf_dir):
    return _joined(classify.score_route(given.routes(spark, sf_dir)), "reason_codes")


# --- Anomalies and profiles -------------------------------------------------


@register
def zscore_anomalies(spark, sf_dir):
    found = anomaly.zscore_anomalies(given.table(spark, sf_dir, "events"), "events", ["event_id"])
    return _rounded(found, 6, "mean", "std", "zscore")


@register
def iqr_anomalies(spark, sf_dir):
    found = anomaly.iqr_anomalies(given.table(spark, sf_dir, "events"), "events", ["event_id"])
    return _rounded(found, 6, "lower_bound", "upper_bound")


@register
def anomaly_baseline(spark, sf_dir):
    """Profiles and findings of all six gold tables, and one table that doesn't exist."""
    silver = _stored_silver(spark, sf_dir)
    incidents = marts.property_incidents(silver, _macro(spark, sf_dir), "month")
    gold = {
        "daily_complaints": (marts.daily_complaints(silver), ["complaint_date", "borough"]),
        "borough_summary": (marts.borough_summary(silver), ["police_precinct", "borough"]),
        "anomaly_summary": (marts.anomaly_summary(silver), ["agency", "complaint_type", "borough", "police_precinct", "complaint_year"]),
        "resolution_anomalies": (marts.resolution_anomalies(silver), ["complaint_id"]),
        "property_incidents": (incidents, ["complaint_id"]),
        "address_risk_score": (marts.address_risk_score(silver, SCORED_AT), ["full_address", "police_precinct"]),
    }
    tables = {name: (stage_table(df, name), keys) for name, (df, keys) in gold.items()}
    findings, profiles, absent = anomaly.anomaly_baseline({**tables, "forecasts": (None, [])})
    counts = findings.groupBy("table_name", "column_name").agg(
        *[F.count_if(F.col("anomaly_type") == kind).alias(kind) for kind in ("zscore_outlier", "iqr_outlier")],
        F.count_if(F.col("severity") == "high").alias("high_findings"), F.min("value").alias("smallest"), F.max("value").alias("largest"),
    )
    rows = profiles.join(counts, ["table_name", "column_name"], "left").fillna(0, ["zscore_outlier", "iqr_outlier", "high_findings"])
    return _rounded(rows, 6, "mean", "std", "q1", "q3").withColumn("absent_tables", F.lit(",".join(absent)))


@register
def table_profile(spark, sf_dir):
    return anomaly.profile_table(_silver(spark, sf_dir), "complaints")


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_table(
        _risk(spark, sf_dir).select(
            "full_address", "police_precinct", "community_board", "neighborhood", "zip_code", "borough",
            "property_risk_score", "total_complaints", "incident_address",
        ),
        "scores",
    )


@register
def score_profile(spark, sf_dir):
    scores = _scores(spark, sf_dir)
    found = anomaly.detect_columns(scores)
    profile = anomaly.profile_score(scores, found["score"], found["address"])
    return _rounded(profile, 6, "mean_score", "median_score", "p95_score", "p99_score")


@register
def price_profile(spark, sf_dir):
    """The profile of a continuous column, where nearly every value is distinct."""
    lines = given.table(spark, sf_dir, "lineitem")
    profile = anomaly.profile_score(lines, "l_extendedprice", "l_returnflag")
    return _rounded(profile, 2, "mean_score", "median_score", "p95_score", "p99_score")


@register
def score_by_zip(spark, sf_dir):
    return _rounded(anomaly.score_by(_scores(spark, sf_dir), "zip_code", "property_risk_score"), 6, "mean", "median")


@register
def score_by_borough(spark, sf_dir):
    return _rounded(anomaly.score_by(_scores(spark, sf_dir), "borough", "property_risk_score"), 6, "mean", "median")


_SCORE_TIES = ["full_address", "police_precinct", "community_board", "neighborhood", "incident_address"]


@register
def top_risk(spark, sf_dir):
    ties = [F.col(c).asc_nulls_last() for c in _SCORE_TIES]
    return anomaly.top_share(_scores(spark, sf_dir), "property_risk_score", ties).select(
        "score_rank", "full_address", "police_precinct", "property_risk_score", "total_complaints"
    )


@register
def validation_report(spark, sf_dir):
    records = classify.classify(given.classified_lines(spark, sf_dir), "aviation")
    events = given.table(spark, sf_dir, "events")
    findings = anomaly.union_findings(
        anomaly.zscore_anomalies(events, "events", ["event_id"]),
        anomaly.iqr_anomalies(events, "events", ["event_id"]),
    )
    profile = anomaly.score_warnings(anomaly.profile_score(events, "value", "event_type"))
    report = anomaly.validation_report(spark, records, findings, profile, ["borough_summary"])
    return _joined(report, "blocking_failures", "warnings")


# --- Forecast ---------------------------------------------------------------


def _series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast.monthly_series(given.region_days(spark, sf_dir))


@register
def monthly_series(spark, sf_dir):
    return _series(spark, sf_dir)


@register
def trend_fits(spark, sf_dir):
    fits = forecast.fit_trends(_series(spark, sf_dir))
    names = [f"{m}_{s}" for m in forecast.MODELS for s in ("aic", "sic", "mse", "rmse", "r2_adj")]
    return _rounded(fits, 6, *names).select("borough", "n_obs", "last_month", *names)


@register
def ljung_box_q(spark, sf_dir):
    fits = forecast.with_whiteness(forecast.fit_trends(_series(spark, sf_dir)))
    names = [f"{m}_{s}" for m in forecast.MODELS for s in ("q", "pvalue")]
    return _rounded(fits, 6, *names).select(
        "borough", F.col("lags").cast("bigint").alias("lags"), *names, "linear_white", "quadratic_white"
    )


@register
def trend_selected(spark, sf_dir):
    models = forecast.trend_models(_series(spark, sf_dir))
    return _rounded(models, 6, "sic_delta").select("borough", "n_obs", "selected_model", "sic_delta")


@register
def trend_forecast_points(spark, sf_dir):
    rows = forecast.forecast(forecast.trend_models(_series(spark, sf_dir)))
    return _rounded(rows, 6, "point_forecast", "aic", "sic", "rmse").drop("lower_pi", "upper_pi")


@register
def trend_forecast(spark, sf_dir):
    """Published end to end, read back with its intervals."""
    target, log = stage_path(spark, "forecast"), stage_path(spark, "forecast_log")
    forecast.run_trend_forecast(
        given.region_days(spark, sf_dir), GateContext("gold.trend_forecast", "trend_check", GATES_AT), target, log
    )
    return _rounded(spark.read.parquet(target), 6, "point_forecast", "lower_pi", "upper_pi", "aic", "sic", "rmse")


@register
def forecast_checks(spark, sf_dir):
    models = forecast.trend_models(_series(spark, sf_dir))
    ctx = GateContext("gold.trend_forecast", "trend_check", GATES_AT)
    log = forecast.forecast_log_row(models, ctx, rules.HORIZON_MONTHS, rules.INTERVAL_LEVEL)
    return forecast.forecast_checks(log).select("check_name", "passed", "severity")


# --- Streams ----------------------------------------------------------------


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = given.table(spark, sf_dir, "events").schema
    return streams.stream_bronze(spark, sf_dir, schema, "parquet", pathGlobFilter="events.parquet")


@register
def stream_daily(spark, sf_dir):
    return streams.run_daily(given.event_complaints(spark, _event_stream(spark, sf_dir)))


@register
def stream_daily_split(spark, sf_dir):
    """Four arrivals, a fifth of the rows out of order: the daily mart next to the rows set aside, by day."""
    events, source = given.table(spark, sf_dir, "events"), stage_path(spark, "arrivals")
    target, checkpoint = stage_path(spark, "split"), stage_path(spark, "split-checkpoint")
    quarter = F.floor((F.dayofmonth("ts") - 1) / 8)
    arrival = F.when(F.col("event_id") % 5 == 0, 3 - quarter).otherwise(quarter)
    for part in range(4):
        events.filter(arrival == part).write.mode("append").parquet(source)
        silver = given.event_complaints(spark, streams.stream_bronze(spark, source, events.schema, "parquet"))
        streams.split_daily(silver, target, checkpoint, "2 days").awaitTermination()
    late = streams.late_view(spark, target, silver.schema).groupBy("complaint_date", "borough", "late_reason").agg(
        F.count(F.lit(1)).alias("late_rows")
    )
    days = streams.split_daily_view(spark, target)
    return days.join(late, ["complaint_date", "borough"], "full_outer")


@register
def stream_keep_latest(spark, sf_dir):
    target, checkpoint = stage_path(spark, "latest"), stage_path(spark, "latest-checkpoint")
    keys, order = ["user_id"], [F.desc("ts"), F.desc("event_id")]
    streams.stream_keep_latest(_event_stream(spark, sf_dir), target, checkpoint, keys, order).awaitTermination()
    return streams.latest_view(spark, target, keys, order)


@register
def stream_compacted(spark, sf_dir):
    """Three micro-batches in bad time order, folded into a base after the second; the third comes on top."""
    events, source = given.table(spark, sf_dir, "events"), stage_path(spark, "arrivals")
    target, checkpoint = stage_path(spark, "latest"), stage_path(spark, "latest-checkpoint")
    keys, order = ["user_id"], [F.desc("ts"), F.desc("event_id")]
    for part in (1, 0, 2):
        events.filter(F.col("event_id") % 3 == part).write.mode("append").parquet(source)
        stream = streams.stream_bronze(spark, source, events.schema, "parquet")
        streams.stream_keep_latest(stream, target, checkpoint, keys, order).awaitTermination()
        if part == 0:
            streams.compact(spark, target, keys, order)
            streams.retire(spark, target)
    return streams.latest_view(spark, target, keys, order)


# --- Sources and sinks, read back -------------------------------------------


@register
def bronze_json_arrays(spark, sf_dir):
    """One array of objects per file, files with different columns, one of them not JSON."""
    orders, path = given.table(spark, sf_dir, "orders"), stage_path(spark, "arrays")
    fields = [F.col(c).cast("string").alias(c) for c in ("o_orderkey", "o_orderstatus", "o_orderpriority")]
    rows = orders.select(*fields, F.floor(F.col("o_orderkey") / 2000).alias("block"))  # a file holds at most 2,000
    for part, columns in enumerate((["o_orderkey", "o_orderstatus"], ["o_orderkey", "o_orderpriority"])):
        some = rows.filter((F.col("o_orderkey").cast("bigint") % 2) == part).groupBy("block").agg(
            F.to_json(F.collect_list(F.struct(*columns))).alias("value")
        )
        some.write.mode("append").partitionBy("block").text(path)
    spark.range(1).select(F.lit('[{"o_orderkey": ').alias("value")).write.text(f"{path}/block=-1")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("o_orderkey", "o_orderstatus", "o_orderpriority")])
    read = read_json_bronze(spark, path, schema).agg(
        F.count("o_orderkey").alias("documents"), F.countDistinct("o_orderkey").alias("orders"),
        F.count("o_orderstatus").alias("with_status"), F.count("o_orderpriority").alias("with_priority"),
    )
    bad = malformed_json(spark, path, schema).agg(F.sum("malformed").cast("bigint").alias("malformed"))
    return read.join(bad, F.lit(True))


@register
def bronze_json_splits(spark, sf_dir):
    """Objects one after the other with braces in their texts, in files that are cut anywhere."""
    orders, path = given.table(spark, sf_dir, "orders"), stage_path(spark, "objects")
    note = F.concat(F.lit('"}, {\\'), "o_orderpriority", F.lit('"['))
    nested = F.struct(F.array(F.struct("o_orderstatus")).alias("states"), F.col("o_totalprice"))
    rows = orders.select(F.to_json(F.struct("o_orderkey", note.alias("note"), nested.alias("inner"))).alias("value"))
    rows.write.option("lineSep", ",\n").text(path)
    schema = "o_orderkey bigint, note string, inner struct<states: array<struct<o_orderstatus: string>>, o_totalprice: double>"
    read = read_json_arrays(spark, path, T._parse_datatype_string(schema))
    return read.groupBy(F.col("inner.states")[0]["o_orderstatus"].alias("status"), "note").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("o_orderkey").alias("orders"), F.max("inner.o_totalprice").alias("highest")
    )


@register
def macro_from_files(spark, sf_dir):
    """The series key comes from the name of the file a row is in."""
    path = stage_path(spark, "series")
    orders = given.table(spark, sf_dir, "orders").select("o_orderstatus", "o_totalprice")
    for name, status in (("UNRATE", "O"), ("CPIAUCSL", "F"), ("FEDFUNDS", "P")):
        folder = f"{path}/raw/{name}"
        orders.filter(F.col("o_orderstatus") == status).write.json(folder)
        _rename_parts(spark, folder, f"{path}/{name}")
    rows = with_series_from_filename(spark.read.schema("o_orderstatus string, o_totalprice double").json(f"{path}/*.json"))
    return rows.groupBy("series_id").agg(F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("highest"))


def _rename_parts(spark: SparkSession, folder: str, name: str) -> None:
    """Give the files a writer left in a folder names of their own, by day."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    parts = sorted(str(s.getPath()) for s in files.listStatus(path(folder)) if s.getPath().getName().startswith("part-"))
    for i, part in enumerate(parts):
        files.rename(path(part), path(f"{name}_{20240101 + i}.json"))


@register
def q_read_tabular(spark, sf_dir):
    """The same table as CSV and as Parquet."""
    customers, path = given.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal"), stage_path(spark, "tab")
    customers.write.option("header", True).csv(f"{path}/t.csv")
    customers.write.parquet(f"{path}/t")
    both = [read_tabular(spark, f"{path}/t.csv", customers.schema), read_tabular(spark, f"{path}/t")]
    return reduce(DataFrame.unionByName, [df.select(F.lit(i).alias("form"), "*") for i, df in enumerate(both)])


@register
def q_read_optional(spark, sf_dir):
    """A table that is there, and one that is not."""
    there, absent = (read_optional(spark, f"{sf_dir}/{name}.parquet") for name in ("supplier", "nothing"))
    return there.groupBy("s_nationkey").count().withColumn("other_is_absent", F.lit(absent is None))


@register
def findings_written(spark, sf_dir):
    """Findings written as CSV and JSON, read back and counted."""
    found = anomaly.iqr_anomalies(given.table(spark, sf_dir, "events"), "events", ["event_id"])
    path = stage_path(spark, "findings")
    write_findings(found, path)
    flat = T.StructType([T.StructField(f.name, T.StringType()) for f in found.schema.fields])
    forms = {
        "csv": spark.read.option("header", True).schema(flat).csv(f"{path}/csv"),
        "json": spark.read.schema(found.schema).json(f"{path}/json"),
    }
    rows = [df.select(F.lit(k).alias("form"), "column_name", F.col("value").cast("double").alias("value")) for k, df in forms.items()]
    return reduce(DataFrame.unionByName, rows).groupBy("form", "column_name").agg(
        F.count(F.lit(1)).alias("findings"), F.max("value").alias("largest")
    )


@register
def sorted_files(spark, sf_dir):
    """A table in one total order over its files: neighbours in reading order never go down."""
    path = stage_path(spark, "sorted")
    parts = given.table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    write_sorted(parts, path, [F.asc("p_retailprice"), F.asc("p_partkey")])
    files = spark.read.parquet(path).groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.count(F.lit(1)).alias("n"), F.min("p_retailprice").alias("low"), F.max("p_retailprice").alias("high")
    )
    in_order = F.coalesce(F.col("low") >= F.lag("high").over(Window.orderBy("file")), F.lit(True))
    return files.withColumn("in_order", in_order).agg(
        F.sum("n").alias("row_count"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.bool_and("in_order").alias("in_order"),
    )


@register
def detected_columns(spark, sf_dir):
    """The score column found by its values, as no name says so."""
    lines = given.table(spark, sf_dir, "lineitem").select("l_extendedprice", "l_quantity", "l_tax", "l_returnflag")
    found = anomaly.detect_columns(lines)
    return lines.agg(*[F.lit(found[k]).cast("string").alias(k) for k in ("score", "address", "zip", "borough")], F.count(F.lit(1)).alias("n"))
