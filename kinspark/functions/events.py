"""Event tags, types, roles and scores as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kinspark.functions.dates import lineage_ymd, lookup
from kinspark.functions.places import levels

#: Event tags of individuals and of families.
INDIVIDUAL_TAGS = ("BIRT", "CHR", "CHRA", "BAPM", "BARM", "BASM", "BLES", "ADOP", "CONF", "FCOM", "GRAD", "ORDN", "EMIG", "IMMI", "NATU", "CENS", "PROB", "WILL", "RETI", "DEAT", "BURI", "CREM", "EVEN")
FAMILY_TAGS = ("MARR", "MARB", "MARC", "MARL", "MARS", "ENGA", "ANUL", "DIV", "DIVF")
#: Tags that always name a role, and tags that never do.
ROLE_TAGS = ("HUSB", "WIFE", "CHIL", "ASSO", "ROLE")
NO_ROLE_TAGS = ("DATE", "PLAC", "NOTE", "SOUR", "CONC", "CONT", "MAP", "LATI", "LONG", "OBJE", "TYPE", "CAUS", "QUAY")
#: Names of event types and of roles.
TYPES = {
    "BIRT": "Birth", "CHR": "Christening", "CHRA": "Adult Christening", "BAPM": "Baptism", "BARM": "Bar Mitzvah", "BASM": "Bas Mitzvah",
    "ADOP": "Adoption", "MARR": "Marriage", "DIV": "Divorce", "ENGA": "Engagement", "DEAT": "Death", "BURI": "Burial", "CREM": "Cremation",
    "EMIG": "Emigration", "IMMI": "Immigration", "NATU": "Naturalization", "CENS": "Census", "GRAD": "Graduation", "WILL": "Will",
    "OCCU": "Occupation", "RETI": "Retirement", "EVEN": "Event",
}
ROLES = {"HUSB": "Husband", "WIFE": "Wife", "CHIL": "Child", "ASSO": "Associate", "_WITN": "Witness"}


def is_event(tag: Column) -> Column:
    return F.upper(tag).isin(*INDIVIDUAL_TAGS, *FAMILY_TAGS)


def event_type(tag: Column) -> Column:
    t = F.upper(tag)
    return F.coalesce(lookup(TYPES, t), F.concat(F.lit("CustomEvent("), t, F.lit(")")))


def role_label(tag: Column) -> Column:
    t = F.upper(tag)
    return F.coalesce(lookup(ROLES, t), F.initcap(F.regexp_replace(F.lower(t), "^_+", "")))


def certainty(quay: Column) -> Column:
    n = F.trim(quay).try_cast("int")
    return F.when(n.between(0, 3), n)


def claim_score(date: Column, place: Column, n_sources: Column, n_notes: Column, has_coordinates: Column | None = None, settled: Column | None = None) -> Column:
    """How good a claim of an event is, for choosing between several."""
    has_coordinates = F.lit(False) if has_coordinates is None else has_coordinates
    settled = F.lit(False) if settled is None else settled
    d, up = F.trim(F.coalesce(date, F.lit(""))), F.upper(F.coalesce(date, F.lit("")))
    doubt = F.lit(False)
    for q in ("ABT", "BEF", "AFT", "EST", "CALC"):
        doubt = doubt | F.contains(up, F.lit(q))
    dated = F.when(d != "", 50 - 10 * doubt.cast("int") + 5 * d.rlike("[ /-]").cast("int")).otherwise(0)
    depth = F.coalesce(F.size(levels(place)), F.lit(0))
    placed = F.when(depth > 0, 30 + 5 * (depth >= 2).cast("int") + 5 * has_coordinates.cast("int")).otherwise(0)
    return dated + placed + 5 * (n_sources >= 1).cast("int") + 5 * (n_sources >= 3).cast("int") + 3 * (n_notes >= 1).cast("int") + 2 * settled.cast("int")


def date_points(date: Column) -> Column:
    """X5."""
    p = lineage_ymd(date)["precision"]
    return F.when(F.coalesce(date, F.lit("")) == "", 0).when(p == 3, 25).when(p == 2, 18).when(p == 1, 10).otherwise(5)


def place_points(place: Column) -> Column:
    """X6."""
    n = F.size(levels(place))
    return F.when(F.coalesce(place, F.lit("")) == "", 0).when(n >= 4, 25).when(n == 3, 20).when(n == 2, 15).when(n == 1, 10).otherwise(5)


def field_points(date: Column, place: Column, n_sources: Column, extras: Column | None = None) -> Column:
    """X7."""
    has = lambda c: (F.coalesce(c, F.lit("")) != "").cast("int")
    return F.least(F.lit(25), 8 * has(date) + 8 * has(place) + 5 * (n_sources > 0).cast("int") + F.least(F.lit(0) if extras is None else extras, F.lit(4)))


def lifespan_points(birth_year: Column, death_year: Column) -> Column:
    """X8."""
    known = (F.coalesce(birth_year, F.lit(0)) != 0) & (F.coalesce(death_year, F.lit(0)) != 0)
    return F.when(known & (death_year < birth_year), 10).when(known & (death_year - birth_year > 120), 20).otherwise(25)


def evidence_points(n_sources: Column) -> Column:
    """X11."""
    return F.when(n_sources <= 0, 10).when(n_sources == 1, 40).when(n_sources == 2, 60).otherwise(100)


def hybrid_points(a: Column, c: Column, e: Column) -> Column:
    """Halves are rounded to even."""
    return F.greatest(F.lit(0), F.least(F.lit(100), F.bround(0.40 * a + 0.40 * c + 0.20 * e, 0).cast("int")))


def ranking(hybrid: Column) -> Column:
    """X13."""
    return F.when(hybrid >= 70, "primary").when(hybrid < 40, "low_confidence").otherwise("alternate")


def score_flags(date: Column, place: Column, n_sources: Column, consistency: Column) -> Column:
    """The flags of X5-X8."""
    d, p, depth = F.coalesce(date, F.lit("")), F.coalesce(place, F.lit("")), F.size(levels(place))
    precision = lineage_ymd(date)["precision"]
    return F.array_compact(
        F.array(
            F.when(d == "", "no_date").when(precision.isin(1, 2), "partial_date").when(precision == 0, "unrecognized_date_format"),
            F.when(p == "", "no_place").when(depth == 0, "ambiguous_place"),
            F.when(n_sources <= 0, "no_sources"),
            F.when(consistency == 10, "death_before_birth").when(consistency == 20, "unrealistic_lifespan"),
            F.when(consistency < 25, "conflicts_with_other_events"),
        )
    )
