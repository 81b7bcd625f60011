"""Silver layer: cleaned complaints, staged macro observations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from civicloom import rules
from civicloom.functions.columns import clean_upper
from civicloom.functions.windows import keep_latest


def clean_complaints(
    raw: DataFrame, keep: Sequence[str] = (), on_bad: str = "raise"
) -> DataFrame:
    """Typed, trimmed complaint rows with their derived fields.

    Rows without a key or creation time are left out. A timestamp or coordinate
    that does not parse stops the job (``on_bad="raise"``) or becomes NULL
    (``"null"``). ``keep`` names extra columns to carry along.
    """

    def typed(name: str, kind: str) -> Column:
        column = F.col(name)
        return column.cast(kind) if on_bad == "raise" else column.try_cast(kind)

    created, closed = typed("created_date", "timestamp_ntz"), typed("closed_date", "timestamp_ntz")
    present = raw.filter(F.col("unique_key").isNotNull() & F.col("created_date").isNotNull())
    return present.select(
        F.col("unique_key").cast("string").alias("complaint_id"),
        created.alias("created_date"),
        closed.alias("closed_date"),
        clean_upper(F.col("complaint_type")).alias("complaint_type"),
        F.trim("descriptor").alias("descriptor"),
        clean_upper(F.col("agency")).alias("agency"),
        F.trim("agency_name").alias("agency_name"),
        clean_upper(F.coalesce("borough", F.lit(rules.DEFAULT_BOROUGH))).alias("borough"),
        F.trim("incident_address").alias("incident_address"),
        F.trim("incident_zip").alias("zip_code"),
        F.trim("city").alias("city"),
        clean_upper(F.col("status")).alias("status"),
        F.trim("community_board").alias("community_board"),
        F.trim("police_precinct").alias("police_precinct"),
        clean_upper(F.col("open_data_channel_type")).alias("channel_type"),
        F.trim("location_type").alias("location_type"),
        F.trim("resolution_description").alias("resolution_description"),
        typed("resolution_action_updated_date", "timestamp_ntz").alias("resolution_date"),
        typed("latitude", "double").alias("latitude"),
        typed("longitude", "double").alias("longitude"),
        F.datediff(closed, created).cast("bigint").alias("resolution_days"),
        F.coalesce(closed < created, F.lit(False)).alias("is_resolution_anomaly"),
        created.cast("date").alias("complaint_date"),
        *keep,
    )


def stage_complaints(
    raw: DataFrame, tie_breakers: Sequence[str] = (), on_bad: str = "raise", within: Sequence[str] = ()
) -> DataFrame:
    """Clean, then keep the newest record of each complaint.

    Records of one complaint created at the same time are told apart by the later
    closing time (NULL last), then by ``tie_breakers``, which are not kept. ``within`` names
    columns that the complaint's key determines. Rows already partitioned by them, as a
    join by shuffle leaves them, are not shuffled again. They are not kept either.
    """
    cleaned = clean_complaints(raw, keep=[*tie_breakers, *within], on_bad=on_bad)
    latest = keep_latest(
        cleaned,
        [*within, "complaint_id"],
        [F.desc("created_date")],
        [F.col("closed_date").desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in tie_breakers]],
    )
    return latest.drop(*tie_breakers, *within)


def explode_observations(raw: DataFrame) -> DataFrame:
    """One row per element of the nested ``observations`` array, values still text."""
    others = [c for c in raw.columns if c != "observations"]
    return raw.select(*others, F.explode("observations").alias("obs")).select(
        *others,
        F.col("obs.date").cast("date").alias("observation_date"),
        F.col("obs.value").alias("raw_value"),
    )


def numeric_observations(obs: DataFrame) -> DataFrame:
    """Observations whose text is a number.

    ``.`` stands for "not published" and is left out. The text "nan" parses as a
    double but is no observation, so it is left out too.
    """
    value = F.col("raw_value").try_cast("double")
    others = [c for c in obs.columns if c != "raw_value"]
    return obs.withColumn("value", value).filter(
        F.col("value").isNotNull() & ~F.isnan("value")
    ).select(*others, "value")


def dedupe_observations(obs: DataFrame, newest_first: Sequence[Column]) -> DataFrame:
    """Overlapping snapshots of one series: one row per series and date."""
    return keep_latest(obs, ["series_id", "observation_date"], newest_first)


def stage_observations(raw: DataFrame, newest_first: Sequence[Column] | None = None) -> DataFrame:
    """Nested snapshots to clean long rows, one per series and date when ordered."""
    rows = numeric_observations(explode_observations(raw))
    return rows if newest_first is None else dedupe_observations(rows, newest_first)
