"""Explicit schemas; nothing in this package infers one from data."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


_TEXT, _LONG, _DOUBLE = T.StringType(), T.LongType(), T.DoubleType()
_STAMP, _DATE, _BOOL = T.TimestampNTZType(), T.DateType(), T.BooleanType()

# Raw complaints arrive as JSON in which every value is text.
BRONZE_COMPLAINT = _struct(
    unique_key=_TEXT, created_date=_TEXT, closed_date=_TEXT, complaint_type=_TEXT,
    descriptor=_TEXT, agency=_TEXT, agency_name=_TEXT, borough=_TEXT,
    incident_address=_TEXT, incident_zip=_TEXT, city=_TEXT, status=_TEXT,
    community_board=_TEXT, police_precinct=_TEXT, open_data_channel_type=_TEXT,
    location_type=_TEXT, resolution_description=_TEXT,
    resolution_action_updated_date=_TEXT, latitude=_TEXT, longitude=_TEXT,
)

BRONZE_MACRO = _struct(observations=T.ArrayType(_struct(date=_TEXT, value=_TEXT)))

GATE_LOG = _struct(
    run_id=_TEXT, asset_name=_TEXT, gate_name=_TEXT, status=_TEXT, message=_TEXT,
    metrics=_TEXT, executed_at=_STAMP, logged_at=_STAMP,
)

GATE_METRICS = _struct(
    record_count=_LONG, threshold_value=_DOUBLE, actual_value=_DOUBLE, details=_TEXT,
)

VALIDATION_REPORT = _struct(
    asset_name=_TEXT, run_id=_TEXT, recommendation=_TEXT, report=_TEXT, created_at=_STAMP,
)

FORECAST = _struct(
    run_id=_TEXT, borough=_TEXT, forecast_month=_DATE, point_forecast=_DOUBLE,
    lower_pi=_DOUBLE, upper_pi=_DOUBLE, pi_level=_DOUBLE, model_type=_TEXT,
    aic=_DOUBLE, sic=_DOUBLE, rmse=_DOUBLE, generated_at=_STAMP,
)
