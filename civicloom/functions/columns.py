"""Column expressions shared by the marts. All of them run inside codegen."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, functions as F, types as T

from civicloom import rules


#: From here on a double has no fraction.
WHOLE_ABOVE = float(2**52)


def timestamp_literal(value: datetime) -> Column:
    """A zone-free timestamp with exactly these clock fields, whatever the session's zone."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def round_half_away(value: Column, digits: int) -> Column:
    """Binary rounding, halves away from zero.

    Spark's own ``round`` goes through the decimal text of a double and so gives
    1.01 for 1.005; scaling the double itself gives 1.0, which is what a SQL
    engine on binary doubles prints. NaN and infinity stay, and so does a number so large
    that it has no such digits.
    """
    scale = float(10**digits)
    shifted = F.floor(F.abs(value) * scale + 0.5).cast("double") / scale
    # NaN counts as larger than any number, so it is kept too.
    return F.when(F.abs(value) * scale >= WHOLE_ABOVE, value).when(value < 0, -shifted).otherwise(shifted)


def clean_upper(value: Column) -> Column:
    return F.upper(F.trim(value))


def blank_to_null(value: Column) -> Column:
    return F.nullif(F.trim(value), F.lit(""))


def has_text(value: Column) -> Column:
    """True for text that is more than spaces; NULL and blank are not."""
    return F.coalesce(F.trim(value) != "", F.lit(False))


def normalize_address(address: Column) -> Column:
    """Canonical street line.

    The first whole word STREET collapses to ST (only the first one), then a
    trailing abbreviation is spelled out. So a final STREET survives and an inner
    one is shortened. The long forms never end in another abbreviation, so at
    most one suffix rule can apply: that of the last word, looked up in a map.
    """
    line = clean_upper(address)
    first_street = r"(?s)^(.*?)(?<![A-Za-z0-9_])STREET(?![A-Za-z0-9_])"
    line = F.when(
        F.contains(line, F.lit("STREET")), F.regexp_replace(line, first_street, "$1ST")
    ).otherwise(line)
    last = F.substring_index(line, " ", -1)
    long = F.try_element_at(F.create_map(*[F.lit(word) for pair in rules.STREET_SUFFIXES.items() for word in pair]), last)
    head = F.substring(line, F.lit(1), F.length(line) - F.length(last))
    return F.trim(F.coalesce(F.when(F.contains(line, F.lit(" ")), F.concat(head, long)), line))


def full_address(address: Column, city: Column, borough: Column, zip_code: Column) -> Column:
    """One-field match key; NULL when the address or borough is NULL."""
    return F.trim(
        F.concat(
            clean_upper(address),
            F.lit(", "),
            F.coalesce(clean_upper(city), clean_upper(borough)),
            F.lit(", "),
            clean_upper(borough),
            F.lit(", NY "),
            F.coalesce(blank_to_null(zip_code), F.lit(rules.MISSING_ZIP)),
        )
    )


def neighborhood_quality(city: Column, borough: Column) -> Column:
    name, home = clean_upper(city), clean_upper(borough)
    flag = F.when(~has_text(city), "MISSING").when(name.isin(rules.GENERIC_CITIES), "GENERIC")
    for listed_borough, names in rules.NEIGHBORHOODS.items():
        flag = flag.when((home == listed_borough) & ~name.isin(names), "CROSS_BOROUGH")
    return flag.otherwise("CLEAN")


def risk_class(complaint_type: Column) -> Column:
    return (
        F.when(complaint_type.isin(rules.RISK_CLASSES["HIGH"]), "HIGH")
        .when(complaint_type.isin(rules.RISK_CLASSES["MEDIUM"]), "MEDIUM")
        .otherwise("LOW")
    )


def risk_tier(score: Column) -> Column:
    return (
        F.when(score >= rules.TIER_HIGH, "HIGH")
        .when(score >= rules.TIER_MEDIUM, "MEDIUM")
        .otherwise("LOW")
    )


def review_bucket(score: Column) -> Column:
    return (
        F.when(score >= 0.75, "highly_recoverable")
        .when(score >= 0.50, "review_recommended")
        .when(score > 0.0, "low_recoverability")
        .otherwise("blocked")
    )


def count_where(condition: Column) -> Column:
    """Rows for which the condition holds, as BIGINT; NULL does not count."""
    return F.count(F.when(condition, 1))


def percent_of(part: Column, whole: Column, digits: int) -> Column:
    return round_half_away(part.cast("double") * 100.0 / whole, digits)


#: Digits after the point that a checksum sees of a double, and from where on it sees its plain text.
CHECKED_DIGITS, CHECKED_BELOW = 6, 1e15
CHECKSUM_BELOW = 10**18


def _checked_text(column: Column, kind: T.DataType) -> Column:
    """A value as text that other engines write alike; a NULL is a backslash and an N."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        value = column.cast("double")
        # CASE guards the cast, which a NaN or an infinity would fail.
        plain = F.isnan(value) | (F.abs(value) >= CHECKED_BELOW)
        rounded = F.when(~plain, round_half_away(value, CHECKED_DIGITS)).cast(f"decimal(38,{CHECKED_DIGITS})")
        text = F.when(plain, value.cast("string")).otherwise(rounded.cast("string"))
    elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        text = F.to_json(column)
    else:
        text = column.cast("string")
    return F.coalesce(text, F.lit("\\N"))


def rows_checksum(schema: T.StructType) -> Column:
    """An aggregate over rows of that schema that doesn't depend on the order of rows or columns.

    Each row's values, by name of column, give 32 bits of their MD5; these add up below 10^18.
    """
    fields = sorted(schema.fields, key=lambda f: f.name)
    text = F.concat_ws("|", *[_checked_text(F.col(f"`{f.name}`"), f.dataType) for f in fields])
    bits = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("decimal(20,0)")
    return F.pmod(F.coalesce(F.sum(bits), F.lit(0)), F.lit(CHECKSUM_BELOW)).cast("bigint")
