"""Row-level expressions. Each returns a Column, so Catalyst sees plain built-in functions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str

# Months of each season.
SEASON_MONTHS = {"Spring": (3, 4, 5), "Summer": (6, 7, 8), "Fall": (9, 10, 11)}
SEASON_OTHERWISE = "Winter"

# Efficiency of each irrigation method; Sprinkler has no single one.
IRRIGATION_EFFICIENCY = {
    "Drip": "High",
    "Flood": "Low",
    "Center Pivot": "Medium",
    "Sub-surface": "High",
    "None": "None",
}

# Plausible pH range of each soil type; other soils fall in SOIL_PH_OTHERWISE.
SOIL_PH_RANGE = {
    "Clay": (5.0, 7.5),
    "Sandy": (5.5, 7.0),
    "Loam": (6.0, 7.0),
    "Silt": (6.0, 7.0),
    "Peaty": (4.0, 6.0),
    "Chalky": (7.0, 8.5),
}
SOIL_PH_OTHERWISE = (5.5, 7.5)

NOISE_MODULUS = 2_147_483_647
NOISE_MULTIPLIER = 48_271
NOISE_INCREMENT = 12_345


def col(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def first_match(rules: Iterable[tuple[Column, Any]], otherwise: Any = None) -> Column:
    """The value of the first rule whose condition holds; a null condition counts as not holding."""
    chain = None
    for condition, value in rules:
        chain = F.when(condition, value) if chain is None else chain.when(condition, value)
    if chain is None:
        return F.lit(otherwise)
    return chain.otherwise(otherwise)


def value_map(value: ColumnLike, mapping: Mapping[Any, Any], otherwise: Any = None) -> Column:
    """Translate listed values; anything else, null included, becomes ``otherwise``."""
    source = col(value)
    return first_match(((source == F.lit(key), mapped) for key, mapped in mapping.items()), otherwise)


def band(
    value: ColumnLike, steps: Sequence[tuple[float, Any]], otherwise: Any, inclusive: bool = False
) -> Column:
    """Band a number by descending thresholds. Null falls to ``otherwise``."""
    source = col(value)
    return first_match(
        ((source >= limit if inclusive else source > limit, label) for limit, label in steps), otherwise
    )


def or_default(value: ColumnLike, default: Any) -> Column:
    return F.coalesce(col(value), F.lit(default))


def non_zero(value: ColumnLike) -> Column:
    return F.nullif(col(value), F.lit(0))


def safe_ratio(numerator: ColumnLike, denominator: ColumnLike) -> Column:
    """Quotient that is null, not an error, for a zero divisor."""
    return col(numerator) / non_zero(denominator)


def percent_of(part: ColumnLike, whole: ColumnLike) -> Column:
    return safe_ratio(part, whole) * 100


def growth_percent(current: ColumnLike, previous: ColumnLike) -> Column:
    return (safe_ratio(current, previous) - 1) * 100


def weighted_sum(terms: Sequence[tuple[Column, float]]) -> Column:
    """Sum of value x weight, added in the given order."""
    total = terms[0][0] * terms[0][1]
    for value, weight in terms[1:]:
        total = total + value * weight
    return total


def per_root(score: ColumnLike, size: ColumnLike) -> Column:
    """Score normalised by the square root of a size; null for a size that has no usable root."""
    root = F.when(col(size) > 0, F.sqrt(col(size)))
    return col(score) / root


def season_of(month: ColumnLike) -> Column:
    source = col(month)
    return first_match(
        ((source.isin(*months), season) for season, months in SEASON_MONTHS.items()), SEASON_OTHERWISE
    )


def month_floor(day: ColumnLike) -> Column:
    return F.trunc(col(day), "month")


def days_between(start: ColumnLike, end: ColumnLike) -> Column:
    """Days from ``start`` to ``end``; negative when ``end`` comes first."""
    return F.datediff(col(end), col(start))


def date_in_year(year: ColumnLike, month_day: tuple[int, int]) -> Column:
    month, day = month_day
    return F.make_date(col(year).cast("int"), F.lit(month), F.lit(day))


def parse_date(text: ColumnLike, pattern: str = "yyyy-MM-dd") -> Column:
    """Date of a text, null when it does not parse (a plain ``to_date`` would fail the job)."""
    return F.to_date(F.try_to_timestamp(col(text), F.lit(pattern)))


def iso_date(text: ColumnLike) -> Column:
    """Day of an ISO-8601 timestamp text; null when it does not parse."""
    return F.to_date(F.try_to_timestamp(col(text)))


def shifted_date_text(day: ColumnLike, days: ColumnLike | int) -> Column:
    offset = F.lit(days) if isinstance(days, int) else col(days)
    return F.date_format(F.date_add(col(day), offset.cast("int")), "yyyy-MM-dd")


def as_id(value: ColumnLike) -> Column:
    """Integer key, null for keys such as ``FARM_12`` that hold none."""
    return col(value).try_cast("bigint")


def profit_margin(revenue: ColumnLike, cost: ColumnLike) -> Column:
    """Margin in percent, two decimals, null without revenue. Rounded as a decimal to keep ties exact."""
    percent = percent_of(col(revenue) - col(cost), revenue)
    return F.round(percent.cast("decimal(28,10)"), 2).cast("double")


def stable_noise(*keys: ColumnLike) -> Column:
    """Pseudo-uniform number in [0, 1) that depends on integer keys only.

    Integer arithmetic on reduced keys: the same on every engine, for any partitioning, with no overflow.
    """
    state = F.lit(NOISE_INCREMENT).cast("bigint")
    for key in keys:
        mixed = state + F.pmod(col(key).cast("bigint"), F.lit(NOISE_MODULUS).cast("bigint"))
        state = F.pmod(
            F.pmod(mixed, F.lit(NOISE_MODULUS).cast("bigint")) * NOISE_MULTIPLIER + NOISE_INCREMENT,
            F.lit(NOISE_MODULUS).cast("bigint"),
        )
    return state / F.lit(float(NOISE_MODULUS))


def content_id(*columns: ColumnLike) -> Column:
    """Id of a record computed from its content, so a replayed record keeps it."""
    return F.sha2(F.to_json(F.struct(*[col(c) for c in columns])), 256)


def lat_lon_text(latitude: ColumnLike, longitude: ColumnLike, decimals: int = 4) -> Column:
    shape = f"%.{decimals}f"
    return F.format_string(f"{shape},{shape}", col(latitude), col(longitude))


def lat_of(location: ColumnLike) -> Column:
    return F.get(F.split(col(location), ","), 0).try_cast("double")


def lon_of(location: ColumnLike) -> Column:
    return F.get(F.split(col(location), ","), 1).try_cast("double")


def table_of_path(path: ColumnLike) -> Column:
    """Table a data file belongs to: the last directory that is neither a partition nor the file itself."""
    folders = F.slice(F.split(col(path), "/"), 1, F.size(F.split(col(path), "/")) - 1)
    plain = F.filter(folders, lambda part: ~part.contains("="))
    return F.element_at(plain, -1)


def irrigation_efficiency(method: ColumnLike) -> Column:
    return value_map(method, IRRIGATION_EFFICIENCY)


def ph_plausible(soil_type: ColumnLike, ph: ColumnLike) -> Column:
    """Whether a pH lies in the range of its soil type."""
    low = value_map(soil_type, {k: v[0] for k, v in SOIL_PH_RANGE.items()}, SOIL_PH_OTHERWISE[0])
    high = value_map(soil_type, {k: v[1] for k, v in SOIL_PH_RANGE.items()}, SOIL_PH_OTHERWISE[1])
    return col(ph).between(low, high)
