import math

import pytest
from pyspark.sql import functions as F, types as T

from civicloom.functions import columns as C


def values(spark, schema, rows, column):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(column).collect()]


def test_rounding_keeps_nan(spark):
    (got,) = values(spark, "v double", [(float("nan"),)], C.round_half_away(F.col("v"), 2))
    assert got != got


@pytest.mark.parametrize(
    "value, digits, want",
    [
        (2.25, 1, 2.3), (0.35, 1, 0.4), (-2.25, 1, -2.3), (1.005, 2, 1.0), (0.0, 1, 0.0),
        (None, 1, None), (12.0, 1, 12.0), (-0.04, 1, -0.0),
        (1e15, 6, 1e15), (float("inf"), 2, float("inf")), (float("-inf"), 2, float("-inf")), (-1e300, 1, -1e300),
    ],
)
def test_round_half_away(spark, value, digits, want):
    assert values(spark, "v double", [(value,)], C.round_half_away(F.col("v"), digits)) == [want]


@pytest.mark.parametrize(
    "raw, want",
    [
        (" 12 main st ", "12 MAIN STREET"),
        ("1 Oak Ave", "1 OAK AVENUE"),
        ("1 Big Blvd", "1 BIG BOULEVARD"),
        ("1 x dr", "1 X DRIVE"),
        ("1 x rd", "1 X ROAD"),
        ("1 x pl", "1 X PLACE"),
        ("1 x ct", "1 X COURT"),
        ("1 x ln", "1 X LANE"),
        ("1 x pkwy", "1 X PARKWAY"),
        ("5 Street Rd", "5 ST ROAD"),  # an inner STREET is shortened
        ("9 Park Street", "9 PARK STREET"),  # a final one comes back
        ("1 STREET STREET", "1 ST STREET"),  # only the first is touched
        ("1 STREETER", "1 STREETER"),  # whole words only
        ("1 X_STREET Y", "1 X_STREET Y"),  # an underscore belongs to the word
        ("ST", "ST"),  # an abbreviation needs something before it
        ("1 STREET\nAPT 2 ST", "1 ST\nAPT 2 STREET"),
        ("\t7 a st", "\t7 A STREET"),  # only spaces are trimmed
        ("1 hwy", "1 HWY"),
        ("", ""),
        (None, None),
    ],
)
def test_normalize_address(spark, raw, want):
    assert values(spark, "a string", [(raw,)], C.normalize_address(F.col("a"))) == [want]


@pytest.mark.parametrize(
    "row, want",
    [
        (("1 main st", "Astoria", "Queens", "11101"), "1 MAIN ST, ASTORIA, QUEENS, NY 11101"),
        (("1 main st", None, "Queens", " "), "1 MAIN ST, QUEENS, QUEENS, NY 00000"),
        (("1 main st", "", "Queens", None), "1 MAIN ST, , QUEENS, NY 00000"),
        (("1 main st", "Astoria", None, "11101"), None),
        ((None, "Astoria", "Queens", "11101"), None),
    ],
)
def test_full_address(spark, row, want):
    column = C.full_address(*map(F.col, "acbz"))
    assert values(spark, "a string, c string, b string, z string", [row], column) == [want]


@pytest.mark.parametrize(
    "city, borough, want",
    [
        (None, "QUEENS", "MISSING"), ("  ", "QUEENS", "MISSING"), ("new york", "QUEENS", "GENERIC"),
        (" Astoria", "queens ", "CLEAN"), ("Hoboken", "QUEENS", "CROSS_BOROUGH"),
        ("Hoboken", "BRONX", "CLEAN"), ("Hoboken", None, "CLEAN"), ("NEW HYDE PARK", "QUEENS", "CLEAN"),
    ],
)
def test_neighborhood_quality(spark, city, borough, want):
    column = C.neighborhood_quality(F.col("c"), F.col("b"))
    assert values(spark, "c string, b string", [(city, borough)], column) == [want]


def test_risk_class(spark):
    rows = [("LEAD",), ("NOISE",), ("STREET LIGHT",), (None,)]
    assert values(spark, "t string", rows, C.risk_class(F.col("t"))) == ["HIGH", "MEDIUM", "LOW", "LOW"]


def test_tiers_and_buckets(spark):
    rows = [(39.9,), (40.0,), (69.9,), (70.0,), (100.0,), (None,)]
    assert values(spark, "s double", rows, C.risk_tier(F.col("s"))) == [
        "LOW", "MEDIUM", "MEDIUM", "HIGH", "HIGH", "LOW",
    ]
    rows = [(0.75,), (0.74,), (0.5,), (0.1,), (0.0,)]
    assert values(spark, "s double", rows, C.review_bucket(F.col("s"))) == [
        "highly_recoverable", "review_recommended", "review_recommended", "low_recoverability", "blocked",
    ]


def test_rounding_agrees_with_binary_rounding_everywhere(spark):
    numbers = [(k / 8 + d / 1000,) for k in range(-40, 40) for d in range(0, 125, 7)]
    got = values(spark, "v double", numbers, C.round_half_away(F.col("v"), 1))
    for (v,), r in zip(numbers, got):
        scaled = abs(v) * 10
        assert r == math.copysign(math.floor(scaled + 0.5) / 10, v)


def test_checksum_sees_large_whole_numbers_as_they_are(spark):
    assert values(spark, "v double", [(820494475813.0,)], C._checked_text(F.col("v"), T.DoubleType())) == ["820494475813.000000"]
