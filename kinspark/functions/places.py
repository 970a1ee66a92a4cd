"""Places and coordinates as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kinspark.functions.identity import strip


def squeezed(c: Column) -> Column:
    """White space of any kind as single blanks, none at the ends."""
    return strip(F.regexp_replace(c, r"[\s\p{Z}]+", " "))


def event_place(c: Column) -> Column:
    """White space collapsed, one blank after each comma; null when empty."""
    return F.nullif(strip(F.regexp_replace(squeezed(c), r"\s*,\s*", ", ")), F.lit(""))


def standard_place(c: Column) -> Column:
    """``struct(id, raw, normalized)``; null for null and blank texts."""
    n = F.nullif(squeezed(c), F.lit(""))
    return F.when(n.isNotNull(), F.struct(F.lower(n).alias("id"), c.alias("raw"), n.alias("normalized")))


def levels(c: Column) -> Column:
    """The non-blank levels between commas, trimmed."""
    return F.filter(F.transform(F.split(c, ","), lambda x: strip(x)), lambda x: x != "")


def place_parts(c: Column, country_last: bool = True) -> Column:
    """``struct(city, county, state, country)``. The country is the last
    level where there are four or more, or always the fourth."""
    x = levels(c)
    country = F.when(F.size(x) >= 4, F.element_at(x, -1)) if country_last else F.try_element_at(x, F.lit(4))
    return F.struct(*[F.try_element_at(x, F.lit(i)).alias(n) for i, n in enumerate(("city", "county", "state"), 1)], country.alias("country"))


def place_block(raw: Column, latitude: Column, longitude: Column) -> Column:
    """``struct(raw, parts, latitude, longitude)`` of an event's place and its
    coordinates as typed."""
    return F.struct(raw.alias("raw"), place_parts(raw, country_last=False).alias("parts"), prefixed_degrees(latitude).alias("latitude"), prefixed_degrees(longitude).alias("longitude"))


def place_text(parts: Column) -> Column:
    """P10: the parts of a place as one text."""
    return F.concat_ws(", ", *[F.nullif(parts[p], F.lit("")) for p in ("city", "county", "state", "country")])


def hemisphere_degrees(c: Column) -> Column:
    """Signed degrees; a leading S or W makes them negative."""
    t = F.upper(F.trim(c))
    value = F.regexp_replace(t, r"[^0-9.\-]", "").try_cast("double")
    return F.when(t.rlike("^[SW]"), -F.abs(value)).otherwise(value)


def prefixed_degrees(c: Column) -> Column:
    """A hemisphere letter and a number, else a plain number."""
    t = F.upper(F.trim(c))
    value = F.regexp_extract(t, r"^[NSEW]\s*([0-9.]+)$", 1).try_cast("double")
    return F.when(t.rlike(r"^[NSEW]\s*[0-9.]+$"), F.when(t.rlike("^[SW]"), -value).otherwise(value)).otherwise(t.try_cast("double"))


def place_tokens(c: Column) -> Column:
    return F.array_distinct(F.transform(levels(c), F.lower))


def places_similar(a: Column, b: Column) -> Column:
    """The two share a level."""
    return F.coalesce(F.arrays_overlap(place_tokens(a), place_tokens(b)), F.lit(False))


def places_conflict(a: Column, b: Column) -> Column:
    """Both have levels and share none."""
    return F.coalesce((F.size(place_tokens(a)) > 0) & (F.size(place_tokens(b)) > 0) & ~F.arrays_overlap(place_tokens(a), place_tokens(b)), F.lit(False))
