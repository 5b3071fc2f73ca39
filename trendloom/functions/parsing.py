"""Turning raw text into typed values. Nothing here raises under ANSI mode."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from trendloom.schemas import CATEGORY_NAMES

# File-name patterns that carry the two-letter country code.
LOOSE_COUNTRY = r"([A-Z]{2})"
STRICT_COUNTRY = r"([A-Z]{2})videos\.csv"

_NUM = r"(\d+(?:[.,]\d+)?)"
ISO_DURATION = (
    rf"^([+-]?)P(?=.)(?:{_NUM}Y)?(?:{_NUM}M)?(?:{_NUM}W)?(?:{_NUM}D)?"
    rf"(?:T(?:{_NUM}H)?(?:{_NUM}M)?(?:{_NUM}S)?)?$"
)
# group number in ISO_DURATION -> seconds; years and months count as 0
_DURATION_UNITS = {4: 604800, 5: 86400, 6: 3600, 7: 60, 8: 1}


def split_tags(tags: str | Column = "tags") -> Column:
    return F.split(F.col(tags) if isinstance(tags, str) else tags, r"\|")


def country_from_file(variant: str = "default", file: str = "source_file") -> Column:
    """Country code in a file name; '' where the pattern does not match.

    ``loose`` takes the first two capitals anywhere, ``strict`` wants
    ``XXvideos.csv``, ``default`` is strict with 'XX' for an unknown file.
    """
    f = F.col(file)
    if variant == "loose":
        return F.regexp_extract(f, LOOSE_COUNTRY, 1)
    if variant == "strict":
        return F.regexp_extract(f, STRICT_COUNTRY, 1)
    if variant == "default":
        return F.when(f.isNotNull(), F.regexp_extract(f, STRICT_COUNTRY, 1)).otherwise("XX")
    raise ValueError(f"unknown country variant {variant!r}")


def whole_number(value: str | Column, kind: str = "bigint") -> Column:
    """Whole number from text, its fraction dropped; NULL for anything unreadable.

    Read as a whole number first: a double holds only 53 bits. Text without a digit is
    not read as one, which would cost an exception a row.
    """
    c = F.col(value) if isinstance(value, str) else value
    fraction = F.when(F.rlike(c.cast("string"), F.lit("[0-9]")), c).try_cast("double")
    return F.coalesce(c.try_cast(kind), fraction.try_cast(kind))


def coerce_long(value: str | Column) -> Column:
    """As ``whole_number``, but 0 for anything unreadable."""
    return F.coalesce(whole_number(value), F.lit(0))


def coerce_timestamp(value: str | Column, fmt: str | None = None) -> Column:
    """Timestamp from text; NULL for anything unreadable."""
    c = F.col(value) if isinstance(value, str) else value
    return F.try_to_timestamp(c, F.lit(fmt)) if fmt else F.try_to_timestamp(c)


def iso_duration_seconds(value: str | Column) -> Column:
    """ISO 8601 duration text as seconds; 0 when missing or unreadable."""
    c = F.col(value) if isinstance(value, str) else value
    # one match: the sign and the numbers in a row; other text stays in one piece
    marked = "|".join(f"${group}" for group in (1, *_DURATION_UNITS))
    parts = F.split(F.regexp_replace(c, ISO_DURATION, marked), r"\|")

    def seconds(p: Column) -> Column:
        total = F.lit(0.0)
        for i, unit in enumerate(_DURATION_UNITS.values(), 1):
            text = F.get(p, F.lit(i))
            number = F.when(text != "", F.replace(text, F.lit(","), F.lit("."))).try_cast("double")
            total = total + F.coalesce(number, F.lit(0.0)) * unit
        signed = F.when(F.get(p, F.lit(0)) == "-", -total).otherwise(total)
        return F.when(F.size(p) == len(_DURATION_UNITS) + 1, signed).otherwise(0.0)

    # the one-element array binds the parts, so that they are found once per row
    return F.get(F.transform(F.array(parts), seconds), F.lit(0))


def category_name(
    category: str | Column = "category_id",
    unknown: str | None = None,
    names: dict[int, str] | None = None,
) -> Column:
    """Display name of a category id; ``unknown`` replaces ids not listed."""
    c = F.col(category) if isinstance(category, str) else category
    pairs = chain(*(names or CATEGORY_NAMES).items())
    looked_up = F.create_map(*[F.lit(x) for x in pairs])[c.try_cast("int")]
    return looked_up if unknown is None else F.coalesce(looked_up, F.lit(unknown))
