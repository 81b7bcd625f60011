from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from civicloom.operators import marts

SILVER = (
    "complaint_id string, complaint_date date, created_date timestamp_ntz, closed_date timestamp_ntz, borough string, "
    "police_precinct string, complaint_type string, status string, resolution_days bigint, "
    "is_resolution_anomaly boolean, incident_address string, city string, zip_code string, latitude double, "
    "longitude double, channel_type string, community_board string, agency string, agency_name string, "
    "descriptor string, location_type string, resolution_date timestamp_ntz, resolution_description string"
)
NAMES = [part.split()[0] for part in SILVER.split(", ")]


def silver(spark, *rows):
    base = {
        "complaint_date": date(2024, 1, 1), "borough": "QUEENS", "police_precinct": "P1", "complaint_type": "NOISE",
        "status": "CLOSED", "is_resolution_anomaly": False, "incident_address": "1 main st", "zip_code": "10001",
        "community_board": "B1", "channel_type": "PHONE", "city": "ASTORIA", "latitude": 1.0, "longitude": 2.0,
    }
    full = [{**base, "complaint_id": str(i), **row} for i, row in enumerate(rows)]
    full = [{**r, "created_date": datetime.combine(r["complaint_date"], datetime.min.time())} for r in full]
    return spark.createDataFrame([tuple(r.get(n) for n in NAMES) for r in full], SILVER)


def test_daily_open_means_listed_statuses(spark):
    rows = silver(
        spark, {"status": "CLOSED", "resolution_days": 3}, {"status": "OPEN"}, {"status": "UNKNOWN"}, {"status": None},
        {"status": "CLOSED", "resolution_days": -2, "is_resolution_anomaly": True}, {"status": "CLOSED", "resolution_days": 4},
    )
    row = marts.daily_complaints(rows).first()
    assert (row.total_complaints, row.closed_complaints, row.open_complaints) == (6, 3, 1)
    assert (row.avg_resolution_days, row.anomaly_count) == (3.5, 1)


def test_daily_totals_sum_to_silver(spark, sf):
    from civicloom.plans import catalog

    rows = catalog._stored_silver(spark, sf)
    assert marts.daily_complaints(rows).agg(F.sum("total_complaints")).first()[0] == rows.count()


def test_borough_summary(spark):
    rows = silver(
        spark,
        {"complaint_type": "A", "status": "OPEN"}, {"complaint_type": "B", "resolution_days": 1},
        {"complaint_type": "B", "borough": "BRONX", "status": "UNKNOWN"},
        {"police_precinct": "P2", "status": None, "resolution_days": 9},
        {"police_precinct": "Unspecified"}, {"police_precinct": None},
    )
    got = {(r.police_precinct, r.borough): r for r in marts.borough_summary(rows).collect()}
    assert set(got) == {("P1", "QUEENS"), ("P1", "BRONX"), ("P2", "QUEENS")}
    assert got["P1", "BRONX"].open_rate_pct == 100.0 and got["P1", "BRONX"].priority_rank == 1
    assert got["P1", "BRONX"].avg_resolution_days is None
    assert got["P1", "QUEENS"].top_complaint_type == "B"  # over the whole precinct
    assert got["P2", "QUEENS"].open_complaints == 0  # a NULL status is neither open nor closed
    assert got["P2", "QUEENS"].priority_rank == 3


def test_borough_rank_goes_from_rate_to_days_to_name(spark):
    stats = spark.createDataFrame(
        [("a", "x", 50.0, 2.0), ("b", "x", 50.0, None), ("c", "x", 50.0, 9.0), ("d", "x", 75.0, 0.0), ("e", "x", 50.0, 2.0)],
        "police_precinct string, borough string, open_rate_pct double, avg_resolution_days double",
    )
    ranked = marts.priority_rank(stats).orderBy("priority_rank").collect()
    assert [r.police_precinct for r in ranked] == ["d", "c", "a", "e", "b"]


def test_anomaly_marts(spark):
    rows = silver(
        spark, {"is_resolution_anomaly": True, "resolution_days": -4}, {"is_resolution_anomaly": True, "resolution_days": -7},
        {"resolution_days": 3},
    )
    row = marts.anomaly_summary(rows).first()
    assert (row.anomaly_count, row.avg_days_early, row.worst_case_days, row.unique_complaints) == (2, -5.5, -7, 2)
    assert row.complaint_year == 2024
    assert marts.resolution_anomalies(rows).count() == 2


MACRO = "observation_date date, unemployment_rate double, gdp_billions double"


def macro(spark):
    return spark.createDataFrame(
        [(date(2024, 1, 1), 3.7, 100.0), (date(2024, 2, 1), 3.8, None), (date(2024, 4, 1), None, 101.0)], MACRO
    )


@pytest.mark.parametrize(
    "mode, day, want",
    [
        ("month", date(2024, 1, 31), (date(2024, 1, 1), 3.7, 100.0)),
        ("month", date(2024, 2, 9), (date(2024, 2, 1), 3.8, None)),
        ("month", date(2024, 3, 9), (None, None, None)),
        ("asof", date(2023, 12, 31), (None, None, None)),
        ("asof", date(2024, 1, 1), (date(2024, 1, 1), 3.7, 100.0)),
        ("asof", date(2024, 3, 9), (date(2024, 2, 1), 3.8, 100.0)),
        ("asof", date(2024, 4, 1), (date(2024, 4, 1), 3.8, 101.0)),
        ("asof", date(2031, 1, 1), (date(2024, 4, 1), 3.8, 101.0)),
        ("asof", None, (None, None, None)),
    ],
)
def test_macro_join(spark, mode, day, want):
    df = spark.createDataFrame([(day,)], "complaint_date date")
    assert tuple(marts.join_macro(df, macro(spark), mode).first())[1:] == want


def test_macro_join_without_observations(spark):
    df = spark.createDataFrame([(date(2024, 1, 1),)], "complaint_date date")
    for mode in ("month", "asof"):
        assert tuple(marts.join_macro(df, spark.createDataFrame([], MACRO), mode).first())[1:] == (None, None, None)


def test_macro_join_wider_than_the_bound_is_not_broadcast(spark, monkeypatch):
    df = spark.createDataFrame([(date(2024, 3, 9),)], "complaint_date date")
    monkeypatch.setattr(marts, "MAX_BROADCAST_DAYS", 1)
    hinted = marts.join_macro(df, macro(spark), "asof")
    assert "ResolvedHint" not in hinted._jdf.queryExecution().analyzed().toString()
    assert tuple(hinted.first())[1:] == (date(2024, 2, 1), 3.8, 100.0)


def test_incidents_need_an_address(spark):
    rows = silver(spark, {}, {"incident_address": "  "}, {"incident_address": None})
    got = marts.property_incidents(rows, macro(spark)).collect()
    assert [(r.complaint_id, r.incident_address, r.neighborhood_quality_flag) for r in got] == [("0", "1 MAIN STREET", "CLEAN")]


def test_address_risk_score(spark):
    rows = silver(
        spark,
        {"complaint_type": "LEAD", "status": "OPEN"},
        {"complaint_type": "LEAD", "resolution_days": 10, "channel_type": "MOBILE", "complaint_date": date(2024, 1, 11)},
        {"complaint_type": "NOISE", "resolution_days": -1, "is_resolution_anomaly": True},
        {"complaint_type": "X", "incident_address": "1 MAIN STREET", "city": "JAMAICA"},  # another full address
        {"complaint_type": "LEAD", "zip_code": None},
    )
    got = {(r.neighborhood, r.zip_code): r for r in marts.address_risk_score(rows, datetime(2024, 2, 1)).collect()}
    assert len(got) == 3
    main = got["ASTORIA", "10001"]
    # 3*2 + 1*5 + 10*0.5 + 1*10 + 2*3
    assert main.property_risk_score == 32.0 and main.risk_tier == "LOW"
    assert (main.total_complaints, main.complaint_days, main.distinct_complaint_types) == (3, 2, 2)
    assert (main.open_rate_pct, main.anomaly_rate_pct) == (33.3, 33.33)
    assert (main.phone_complaints, main.mobile_complaints, main.complaint_history_days) == (2, 1, 10)
    # top type and class look at the whole address and zip, not at one full address
    assert got["JAMAICA", "10001"].top_complaint_type == "LEAD"
    assert got["JAMAICA", "10001"].highest_complaint_risk_class == "HIGH"
    assert got["JAMAICA", "10001"].low_risk_complaints == 1
    # a NULL zip never matches
    assert got["ASTORIA", None].top_complaint_type is None
    assert got["ASTORIA", None].highest_complaint_risk_class is None


def test_risk_score_is_capped(spark):
    rows = silver(spark, *[{"status": "OPEN"} for _ in range(40)])
    row = marts.address_risk_score(rows, datetime(2024, 2, 1)).first()
    assert row.property_risk_score == 100.0 and row.risk_tier == "HIGH"


def test_risk_base_holds_one_text_of_an_address(spark):
    rows = silver(
        spark,
        {"incident_address": " 1 Main St ", "borough": None}, {"incident_address": "1 MAIN STREET", "borough": None},
        {"incident_address": "1 main st"}, {"incident_address": "1 MAIN STREET"}, {"incident_address": "ST"},
    )
    assert not {"incident_address", "full_address"} & set(marts.risk_base(rows).columns)
    got = marts.address_risk_score(rows, datetime(2024, 2, 1)).collect()
    found = sorted((r.incident_address, r.full_address or "", r.total_complaints) for r in got)
    # Without a borough there is no full address to tell the two forms apart.
    assert [(a, n) for a, _, n in found] == [("1 MAIN STREET", 2), ("1 MAIN STREET", 1), ("1 MAIN STREET", 1), ("ST", 1)]
    assert [f.split(",")[0] for _, f, _ in found] == ["", "1 MAIN ST", "1 MAIN STREET", "ST"]
