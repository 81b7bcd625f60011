import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from civicloom import rules
from civicloom.operators import classify


def scored(spark, *lists):
    df = spark.createDataFrame([(i, codes) for i, codes in enumerate(lists)], "i int, codes array<string>")
    return classify.score_defects(df, "codes").orderBy("i").collect()


def test_score_defects_branches(spark):
    rows = scored(
        spark, [], None, ["mystery"], ["missing_optional_field"], ["cost_threshold_exceeded"],
        ["mystery", "missing_optional_field"], ["duplicate_key", "range_violation", "duplicate_key"],
        ["route_ambiguous", "security_exposure"],
    )
    got = [(r.severity, r.quarantine_flag, r.recoverability_score, r.reason_codes) for r in rows]
    assert got == [
        ("info", False, 1.0, []), ("info", False, 1.0, []), ("medium", True, 0.5, ["mystery"]),
        ("low", False, 0.9, ["missing_optional_field"]), ("medium", False, 0.5, ["cost_threshold_exceeded"]),
        ("low", True, 0.9, ["missing_optional_field", "mystery"]),
        ("high", True, 0.4, ["duplicate_key", "range_violation", "duplicate_key"]),
        ("blocking", True, 0.0, ["route_ambiguous", "security_exposure"]),
    ]


codes = st.lists(st.sampled_from([*rules.DEFECT_RULES, "unknown_a", "unknown_b"]), max_size=6)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(codes, min_size=20, max_size=40))
def test_score_defects_against_brute_force(spark, lists):
    for row, wanted in zip(scored(spark, *lists), lists):
        known = [rules.DEFECT_RULES[c] for c in wanted if c in rules.DEFECT_RULES]
        other = [c for c in wanted if c not in rules.DEFECT_RULES]
        if known:
            assert row.severity == max((r[0] for r in known), key=rules.SEVERITIES.index)
            assert row.quarantine_flag == (any(r[1] for r in known) or bool(other))
            assert row.recoverability_score == min(r[2] for r in known)
        assert row.unknown_defects == other
        assert row.reason_codes == [c for c in wanted if c in rules.DEFECT_RULES] + other


def test_recoverability(spark):
    lists = [
        ["missing_optional_field"], ["route_ambiguous"], ["duplicate_key"], ["range_violation"], ["missing_required_field"],
        ["security_exposure"], ["null_validation_status"], [], ["cost_threshold_exceeded"], ["missing_origin_or_destination"],
        ["missing_optional_field", "unknown"],
    ]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(lists)], "i int, codes array<string>")
    got = [r.recoverability_score for r in classify.score_recoverability(df, "codes").orderBy("i").collect()]
    assert got == [0.9, 0.7, 0.6, 0.4, 0.3, 0.0, 0.0, 1.0, 0.5, 0.2, 0.5]


RECORD = (
    "record_id string, source_system string, validation_status string, callsign string, origin string, "
    "destination string, duration_minutes string, duplicate_key boolean, range_violation boolean"
)


def test_classify_aviation(spark):
    rows = [
        ("1", "FlightAware", "valid", "C", "A", "B", "300", None, None),
        ("2", "FlightAware", "valid", "C", "A", "B", "300", True, None),
        ("3", "OpenSky", "valid", "C", None, "B", "850", None, None),
        ("4", "FlightAware", None, "C", "A", "B", "300", None, None),
        ("5", "FlightAware", "valid", "C", "A", "B", "0", None, None),
        ("6", "FlightAware", "valid", "C", "A", "B", "soon", None, None),
        ("7", "FlightAware", "valid", "", "A", "B", None, None, True),
    ]
    got = {r.record_id: r for r in classify.classify(spark.createDataFrame(rows, RECORD), "aviation").collect()}
    assert (got["1"].validation_status, got["1"].defect_type, got["1"].severity) == ("valid", "", "info")
    assert (got["2"].validation_status, got["2"].reason_codes) == ("quarantine_candidate", ["duplicate_key"])
    assert got["3"].defect_type == "missing_required_field,route_ambiguous,route_ambiguous"
    assert (got["4"].validation_status, got["4"].severity, got["4"].recoverability_score) == ("invalid", "blocking", 0.0)
    assert got["5"].reason_codes == ["duration_outlier"] == got["6"].reason_codes
    assert got["7"].reason_codes == ["range_violation"]  # blank is not missing, NULL duration is no outlier


def test_classify_needs_only_columns_that_exist(spark):
    df = spark.createDataFrame([("7", None)], "complaint_id string, zip string")
    row = classify.classify(df, "complaints").first()
    assert (row.record_id, row.source_system, row.validation_status) == ("7", "complaints", "valid")
    assert classify.classify(df.withColumn("complaint_id", F.lit(None).cast("string")), "complaints").first().defect_type == "missing_required_field"
    # an aviation record without route columns has no route
    assert classify.classify(df, "aviation").first().defect_type == "null_validation_status,route_ambiguous"
    assert classify.classify(df, "property_risk").first().validation_status == "valid"


def test_record_id_falls_through_blanks(spark):
    df = spark.createDataFrame([("", None, "k1", "s2")], "record_id string, complaint_id string, route_key string, source string")
    row = classify.classify(df).first()
    assert (row.record_id, row.source_system, row.domain) == ("k1", "s2", "unknown")


def test_split_loses_nothing(spark, sf):
    from civicloom.sources import driver_tables as given_tables

    records = classify.classify(given_tables.classified_lines(spark, sf), "aviation")
    clean, held = classify.quarantine_split(records)
    assert clean.count() + held.count() == records.count()
    assert held.filter("NOT quarantine_flag").count() == clean.filter("quarantine_flag").count() == 0


ROUTE = (
    "source_system string, callsign string, icao24 string, origin string, destination string, "
    "duration_minutes string, payload_hash string"
)


@pytest.mark.parametrize(
    "row, score, status, key, missing",
    [
        (("FlightAware", "UA845", "abc", "KORD", "SBGR", "610", "h"), 1.0, "certifiable", "KORD_SBGR_UA845", []),
        (("OpenSky", "UA845", "abc", "KORD", "SBGR", "610", "h"), 0.8, "analytical_only", "KORD_SBGR_UA845", []),
        (
            ("OpenSky", None, None, "SBGL", None, "9999", None), 0.1, "analytical_only", "SBGL_UNK_UNK",
            ["missing_callsign", "missing_icao24", "missing_origin_or_destination", "duration_outlier", "missing_payload_hash"],
        ),
        ((None, "", "a", "K", "S", "100", "h"), 0.65, "needs_review", "K_S_UNK", ["duration_needs_review"]),
        (("\tflightaware ", "C", None, "K", "S", "x", None), 0.65, "needs_review", "K_S_C",
         ["missing_icao24", "duration_parse_failure", "missing_payload_hash"]),
        (("radar", "C", None, None, None, None, None), 0.2, "invalid", "UNK_UNK_C",
         ["missing_icao24", "missing_origin_or_destination", "missing_duration", "missing_payload_hash"]),
        (("radar", "C", "a", "K", "S", "120", "h"), 0.75, "needs_review", "K_S_C", []),
        (("radar", "C", "a", "K", "S", "900.5", "h"), 0.65, "needs_review", "K_S_C", ["duration_needs_review"]),
        (("radar", "C", "a", "K", "S", "1200", "h"), 0.65, "needs_review", "K_S_C", ["duration_needs_review"]),
        (("radar", "C", "a", "K", "S", "0", "h"), 0.6, "needs_review", "K_S_C", ["duration_outlier"]),
        (("radar", "C", "a", "K", "S", "NaN", "h"), 0.6, "needs_review", "K_S_C", ["missing_duration"]),
    ],
)
def test_route(spark, row, score, status, key, missing):
    got = classify.score_route(spark.createDataFrame([row], ROUTE)).first()
    assert (got.route_confidence_score, got.route_validation_status, got.route_key) == (score, status, key)
    assert got.reason_codes[1:] == missing
