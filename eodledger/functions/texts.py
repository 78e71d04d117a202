"""Text predicates and normalisation."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Country spellings and the names they are reported under.
COUNTRY_NAMES = {
    " OWITIWARAYA": "OWITIWARAYA",
    "AU": "AUSTRALIA",
    "DOMINICA": "DOMINICAN REPUBLIC",
    "HONG KONG S.A.R.": "HONG KONG SAR CHINA",
    "HONG KONG SAR CHINA": "HONG KONG SAR CHINA",
    "HONGKONG": "HONG KONG SAR CHINA",
    "HONGKONG SAR CHINA": "HONG KONG SAR CHINA",
    "MYANMAR [BURMA]": "MYANMAR",
    "UK": "UNITED KINGDOM",
    "USA": "UNITED STATES",
    "EN": "UNKNOWN OR INVALID REGION",
    "SEF": "UNKNOWN OR INVALID REGION",
    "TW": "TAIWAN",
    "中國": "CHINA",
    "中国": "CHINA",
}
UNKNOWN_COUNTRY = "UNKNOWN OR INVALID REGION"

# LIKE patterns come from users and may hold a backslash, which Spark would read as
# an escape; this character never occurs in them.
NO_ESCAPE = "\x01"


def none_like(column: Column, patterns: Iterable[str]) -> Column:
    """True when no pattern matches; NULL input gives NULL, so a filter drops it."""
    return reduce(lambda a, b: a & b, [~column.like(p) for p in patterns])


def any_like(column: Column, patterns: Iterable[str]) -> Column:
    return reduce(lambda a, b: a | b, [column.like(p) for p in patterns])


def none_like_or_null(column: Column, patterns: Iterable[str]) -> Column:
    return none_like(column, patterns) | column.isNull()


def like_ignore_case(text: Column, pattern: Column) -> Column:
    return F.like(F.lower(text), F.lower(pattern), F.lit(NO_ESCAPE))


def last_segment(path: Column, separator: str) -> Column:
    return F.split_part(path, F.lit(separator), F.lit(-1))


def segment(text: Column, position: int, separator: str = "-") -> Column:
    return F.split_part(text, F.lit(separator), F.lit(position))


def canonical_name(
    raw: Column, names: Mapping[str, str] = COUNTRY_NAMES, unknown: str = UNKNOWN_COUNTRY
) -> Column:
    """Known spellings through the name table; anything else upper-cased without digits."""
    table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    bare = F.upper(F.regexp_replace(raw, "[0-9]", ""))
    return F.coalesce(
        F.try_element_at(table, F.upper(raw)), F.when(bare == "", unknown).otherwise(bare)
    )


def part_after(text: Column, marker: str) -> Column:
    """Text between the first and second marker; NULL when there is no marker."""
    return F.get(F.split(text, marker), F.lit(1))
