"""Numeric expressions: adaptive rounding, fixed point, integer scaling, hashing of keys to numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_ROUNDING_STEP = 3
_ROUNDING_LEVELS = 9
_TWO_62 = 1 << 62


def round_value(value: Column, places: int = 6) -> Column:
    """Round half-up to `places` decimals, with three more decimals each time the magnitude does not exceed 10^-places.

    Zero, null, NaN and infinities pass unchanged. The first levels are compiled one by one; for smaller magnitudes the number of
    decimals is worked out per row.
    """
    levels = [places + _ROUNDING_STEP * n for n in range(_ROUNDING_LEVELS)]
    chain = F.when(F.isnan(value) | F.abs(value).isin(0.0, float("inf")), value)
    for scale in levels:
        chain = chain.when(F.abs(value) > F.lit(10.0**-scale), F.round(value, scale))
    return chain.otherwise(_round_tiny(value, places))


def _round_tiny(value: Column, places: int) -> Column:
    """The same for any magnitude, through the decimal text of the number, which knows no last level."""
    steps = F.ceil((-F.log10(F.abs(value)) - places) / _ROUNDING_STEP).cast("int")
    guess = F.lit(places) + F.lit(_ROUNDING_STEP) * steps
    # The logarithm may be off at a border; the magnitude must exceed 10^-scale and not 10^-(scale - 3).
    power = [F.concat(F.lit("1e-"), (guess + shift).cast("string")).cast("double") for shift in (0, -_ROUNDING_STEP)]
    scale = F.when(F.abs(value) <= power[0], guess + _ROUNDING_STEP).when(F.abs(value) > power[1], guess - _ROUNDING_STEP).otherwise(guess)
    return F.call_function("format_string", F.concat(F.lit("%."), scale.cast("string"), F.lit("f")), value).cast("double")


def fixed_point_encode(value: Column, places: int = 6) -> Column:
    """A decimal number as a whole number of 10^-places units."""
    return F.round(value * F.lit(float(10**places)), 0).cast("bigint")


def fixed_point_decode(units: Column, places: int = 6) -> Column:
    return F.round(units / F.lit(float(10**places)), places)


def wei_scale(value: Column) -> Column:
    """`value` times 10^18 as DECIMAL(38,0), truncated; exact in the double's binary value.

    The product is split at 2^62 and its upper part at 2^31, so every part is an exact whole number. NaN gives null; a product
    that DECIMAL(38,0) cannot hold, from a magnitude of about 1e20 on, is an error.
    """
    scaled = value * F.lit(1e18)
    low = scaled % F.lit(float(_TWO_62))
    upper = (scaled - low) / F.lit(float(_TWO_62))
    middle = upper % F.lit(float(1 << 31))
    high = (upper - middle) / F.lit(float(1 << 31))
    parts = [F.when(F.abs(value) < F.lit(1e20), part).cast("bigint").cast("decimal(19,0)") for part in (low, middle, high)]
    whole = (
        (parts[2] * F.lit(1 << 31).cast("decimal(10,0)") + parts[1]).cast("decimal(20,0)") * F.lit(_TWO_62).cast("decimal(19,0)") + parts[0]
    ).cast("decimal(38,0)")
    refused = F.raise_error(F.concat(F.lit("too large to scale: "), value.cast("string"))).cast("decimal(38,0)")
    return F.when(value.isNull() | F.isnan(value), F.lit(None).cast("decimal(38,0)")).when(F.abs(value) < F.lit(1e20), whole).otherwise(refused)


def wei_scale_array(values: Column) -> Column:
    return F.transform(values, wei_scale)


def wei_scale_map(values: Column) -> Column:
    return F.transform_values(values, lambda _key, value: wei_scale(value))


def hash32(text: Column) -> Column:
    """First four bytes of the SHA-256 digest as an unsigned number."""
    return F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("bigint")


def stream_id(text: Column) -> Column:
    return F.concat(F.lit("kw"), F.substring(F.sha2(text, 256), 1, 30))


def key_uuid(*keys: Column) -> Column:
    """A UUID-shaped id derived from the keys, so a repeated run writes the same id."""
    digest = F.sha2(F.concat_ws("\x1f", *[F.coalesce(k.cast("string"), F.lit("")) for k in keys]), 256)
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(digest, start, size) for start, size in cuts])


def decimal_comma(text: Column) -> Column:
    return F.replace(text, F.lit(","), F.lit(".")).try_cast("double")


def price_number(text: Column) -> Column:
    """The number a price text starts with once the dollar sign is gone; null when there is none."""
    number = F.regexp_extract(F.replace(text, F.lit("$"), F.lit("")), r"^\s*([-+]?(?:\d+\.?\d*|\.\d+))", 1)
    return number.try_cast("double")


def round_slot(round_id: Column) -> Column:
    """Storage slot of a round: magnitude modulo ten of the whole number the id starts with."""
    digits = F.regexp_extract(round_id.cast("string"), r"^\s*([-+]?\d+)", 1)
    return F.abs(digits.try_cast("bigint")) % F.lit(10)


def exact_sum(value: Column, scale: int) -> Column:
    """Sum independent of row order: doubles with at most `scale` decimals are added as decimals."""
    return F.sum(value.cast(f"decimal(18,{scale})")).cast("double")


def exact_avg(value: Column, scale: int) -> Column:
    return exact_sum(value, scale) / F.count(value)


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)
