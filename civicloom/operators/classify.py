"""Record classification: defects, severity, recoverability, quarantine, routes.

Everything here is column arithmetic on one row: no join, no shuffle, no Python UDF.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from civicloom import rules
from civicloom.functions.columns import round_half_away

def defect_rules(spark: SparkSession) -> DataFrame:
    rows = [(name, *rule) for name, rule in rules.DEFECT_RULES.items()]
    return spark.createDataFrame(
        rows,
        "defect_type string, severity string, quarantine_flag boolean, "
        "recoverability_score double, description string",
    )


def defect_score(codes: Column) -> Column:
    """Struct (severity, quarantine_flag, recoverability_score, reason_codes, unknown_defects).

    The worst severity and the lowest recoverability win; one defect that demands
    quarantine, or one unknown defect, is enough for quarantine.
    """
    codes = F.coalesce(codes, F.array().cast("array<string>"))
    listed = list(rules.DEFECT_RULES)
    known = F.filter(codes, lambda c: c.isin(listed))
    unknown = F.filter(codes, lambda c: ~c.isin(listed))
    none_known = F.size(known) == 0
    of_unknown = rules.UNKNOWN_DEFECT
    clean = F.size(codes) == 0
    severity, quarantine, score = _worst({c: F.array_contains(codes, c) for c in listed})
    return F.struct(
        F.when(clean, "info").when(none_known, of_unknown[0]).otherwise(severity).alias("severity"),
        F.when(clean, False)
        .when(none_known, of_unknown[1])
        .otherwise((F.size(unknown) > 0) | quarantine)
        .alias("quarantine_flag"),
        F.when(clean, 1.0).when(none_known, of_unknown[2]).otherwise(score).alias("recoverability_score"),
        F.concat(known, unknown).alias("reason_codes"),
        unknown.alias("unknown_defects"),
    )


def _worst(present: Mapping[str, Column]) -> tuple[Column, Column, Column]:
    """(worst severity, any quarantine, lowest recoverability) of the defects present.

    Without any defect these are info, false and 1.
    """
    def of(pick: Callable[[tuple], bool]) -> Column:
        tests = [present[c] for c in present if pick(rules.DEFECT_RULES[c])]
        return F.coalesce(reduce(lambda a, b: a | b, tests), F.lit(False)) if tests else F.lit(False)

    severity = F.lit(rules.SEVERITIES[0])
    for name in rules.SEVERITIES[1:]:
        severity = F.when(of(lambda rule, name=name: rule[0] == name), name).otherwise(severity)
    score = F.lit(1.0)
    for value in sorted({rules.DEFECT_RULES[c][2] for c in present}, reverse=True):
        score = F.when(of(lambda rule, value=value: rule[2] == value), value).otherwise(score)
    return severity, of(lambda rule: rule[1]), score


def score_defects(df: DataFrame, codes_col: str) -> DataFrame:
    return df.withColumn("_score", defect_score(F.col(codes_col))).select("*", "_score.*").drop("_score")


def recoverability(codes: Column) -> Column:
    codes = F.coalesce(codes, F.array().cast("array<string>"))
    groups: dict[float, Column] = {}
    for code, value in rules.RECOVERABILITY.items():
        found = F.array_contains(codes, code)
        groups[value] = groups[value] | found if value in groups else found
    other = F.exists(codes, lambda c: ~c.isin(list(rules.RECOVERABILITY)))
    unlisted = rules.UNKNOWN_RECOVERABILITY
    groups[unlisted] = groups[unlisted] | other if unlisted in groups else other
    score = F.lit(1.0)
    for value in sorted(groups, reverse=True):
        score = F.when(groups[value], value).otherwise(score)
    return score


def score_recoverability(df: DataFrame, codes_col: str) -> DataFrame:
    return df.withColumn("recoverability_score", recoverability(F.col(codes_col)))


def _column(df: DataFrame, name: str, kind: str = "string") -> Column:
    """The column, or NULL when the frame has none of that name."""
    return F.col(name).try_cast(kind) if name in df.columns else F.lit(None).cast(kind)


def _flag(df: DataFrame, name: str) -> Column:
    """A flag column; NULL is false."""
    return F.coalesce(_column(df, name, "boolean"), F.lit(False))


def _first_filled(df: DataFrame, names: Sequence[str]) -> Column:
    return F.coalesce(*[F.nullif(_column(df, n), F.lit("")) for n in names])


def defect_tests(df: DataFrame, domain: str) -> list[tuple[Column, str]]:
    """The tests of a domain and the defect each one finds, in order; a defect may have two."""
    tests: list[tuple[Column, str]] = []
    if domain in rules.STATUS_REQUIRED:
        tests.append((_column(df, "validation_status").isNull(), "null_validation_status"))
    for field in rules.REQUIRED_FIELDS.get(domain, []):
        if field in df.columns:
            tests.append((F.col(field).isNull(), "missing_required_field"))
    for flag in ("duplicate_key", "range_violation", "schema_drift", "security_exposure"):
        tests.append((_flag(df, flag), flag))
    if domain == "aviation":
        minutes = _column(df, "duration_minutes", "double")
        outside = (minutes <= 0) | (minutes > rules.MAX_DURATION)
        unreadable = _column(df, "duration_minutes").isNotNull() & minutes.isNull()
        tests += [
            (F.lower(_column(df, "source_system")) == "opensky", "route_ambiguous"),
            (
                _column(df, "origin").isNull() | _column(df, "destination").isNull(),
                "route_ambiguous",
            ),
            (F.coalesce(outside, F.lit(False)) | unreadable, "duration_outlier"),
        ]
    return tests


def derive_defects(df: DataFrame, domain: str) -> Column:
    """The list of a record's defects."""
    return F.array_compact(F.array(*[F.when(test, code) for test, code in defect_tests(df, domain)]))


def classify(df: DataFrame, domain: str = "unknown") -> DataFrame:
    """Nine columns per record: identity, status, defects, severity, quarantine, recoverability.

    A medium defect that does not demand quarantine leaves the record valid.
    """
    tests = defect_tests(df, domain)
    flagged = df.select(
        _first_filled(df, ["record_id", "complaint_id", "route_key", "id", "index"]).alias("record_id"),
        F.coalesce(_first_filled(df, ["source_system", "source"]), F.lit(domain)).alias("source_system"),
        F.lit(domain).alias("domain"),
        *[F.when(test, code).alias(f"_d{i}") for i, (test, code) in enumerate(tests)],
    )
    found = [F.col(f"_d{i}") for i in range(len(tests))]
    present: dict[str, Column] = {}
    for column, (_, code) in zip(found, tests):
        hit = column.isNotNull()
        present[code] = present[code] | hit if code in present else hit
    severity, quarantine, score = _worst(present)
    scored = flagged.select(
        "record_id", "source_system", "domain",
        F.concat_ws(",", *found).alias("defect_type"),
        severity.alias("severity"), quarantine.alias("quarantine_flag"),
        score.alias("recoverability_score"),
        F.array_compact(F.array(*found)).alias("reason_codes"),
    )
    status = (
        F.when(F.col("severity") == "blocking", "invalid")
        .when(F.col("quarantine_flag") & F.col("severity").isin("high", "medium"), "quarantine_candidate")
        .when(F.col("severity") == "low", "pending")
        .otherwise("valid")
    )
    return scored.select(
        "record_id", "source_system", "domain", status.alias("validation_status"), "defect_type",
        "severity", "quarantine_flag", "recoverability_score", "reason_codes",
    )


def quarantine_split(classified: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that may flow to gold, quarantined rows); together they are all rows."""
    held = F.coalesce(F.col("quarantine_flag"), F.lit(False))
    return classified.filter(~held), classified.filter(held)


def score_route(df: DataFrame) -> DataFrame:
    """Confidence in a flight route: points per piece of evidence, codes for what lacks.

    A blank call sign earns its points but shows as UNK in the key. An OpenSky route
    is analytical only, whatever its score.
    """
    source = F.lower(
        F.trim(F.coalesce(_first_filled(df, ["source_system", "source"]), F.lit("")), F.lit(" \t\n\r\f\v"))
    )
    duration = _column(df, "duration_minutes")
    minutes = F.nanvl(_column(df, "duration_minutes", "double"), F.lit(None).cast("double"))
    is_nan = F.coalesce(F.isnan(_column(df, "duration_minutes", "double")), F.lit(False))
    no_duration = duration.isNull() | is_nan
    has_ends = _column(df, "origin").isNotNull() & _column(df, "destination").isNotNull()
    usual, possible = minutes.between(120, 900), (minutes > 0) & (minutes <= rules.MAX_DURATION)

    def present(name: str) -> Column:
        return _column(df, name).isNotNull()

    points = [
        F.when(source == "flightaware", 0.30).when(source == "opensky", 0.10).otherwise(0.05),
        F.when(present("callsign"), 0.15).otherwise(0.0),
        F.when(present("icao24"), 0.10).otherwise(0.0),
        F.when(has_ends, 0.20).otherwise(0.0),
        F.when(usual, 0.15).when(possible, 0.05).otherwise(0.0),
        F.when(present("payload_hash"), 0.10).otherwise(0.0),
    ]
    codes = [
        F.when(source == "flightaware", "premium_source_flightaware")
        .when(source == "opensky", "opensky_analytical_support_only")
        .otherwise("unknown_source"),
        F.when(~present("callsign"), "missing_callsign"),
        F.when(~present("icao24"), "missing_icao24"),
        F.when(~has_ends, "missing_origin_or_destination"),
        F.when(no_duration, "missing_duration")
        .when(minutes.isNull(), "duration_parse_failure")
        .when(usual, None)
        .when(possible, "duration_needs_review")
        .otherwise("duration_outlier"),
        F.when(~present("payload_hash"), "missing_payload_hash"),
    ]
    total = points[0]
    for point in points[1:]:
        total = total + point
    score = round_half_away(F.least(F.greatest(total, F.lit(0.0)), F.lit(1.0)), 4)
    key = [F.coalesce(F.nullif(_column(df, n), F.lit("")), F.lit("UNK")) for n in ("origin", "destination", "callsign")]
    scored = df.select(
        F.concat_ws("_", *key).alias("route_key"),
        F.coalesce(F.nullif(source, F.lit("")), F.lit("unknown")).alias("source_system"),
        *[_column(df, n).alias(n) for n in ("origin", "destination", "callsign", "icao24")],
        duration.alias("duration_minutes"),
        score.alias("route_confidence_score"),
        F.filter(F.array(*codes), lambda c: c.isNotNull()).alias("reason_codes"),
    )
    confidence = F.col("route_confidence_score")
    status = (
        F.when(F.col("source_system") == "opensky", "analytical_only")
        .when(confidence >= 0.80, "certifiable")
        .when(confidence >= 0.50, "needs_review")
        .otherwise("invalid")
    )
    return scored.select(
        "route_key", "source_system", "origin", "destination", "callsign", "icao24",
        "duration_minutes", "route_confidence_score", status.alias("route_validation_status"),
        "reason_codes",
    )
