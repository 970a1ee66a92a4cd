"""Z3: the archive as vertices and edges."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinspark.functions.identity import normalize_pointer
from kinspark.functions.places import standard_place
from kinspark.operators.hierarchy import family_states


def _members(families: DataFrame) -> DataFrame:
    m = family_states(families).filter("not deleted").select("fam", F.explode("members").alias("m"))
    return m.select("fam", F.upper(F.trim("m.role")).alias("role"), normalize_pointer(F.col("m.member")).alias("member")).filter("member is not null").distinct()


def edges(families: DataFrame, events: DataFrame, citations: DataFrame) -> DataFrame:
    """``(src, dst, kind)``: PARENT (child to parent), SPOUSE, EVENT_OF, PLACE_OF, SOURCE_OF."""
    m = _members(families)
    spouses, kids = m.filter("role in ('HUSB', 'WIFE')"), m.filter("role = 'CHIL'")
    e = events.filter("event_id is not null").select(F.concat(F.lit("E"), F.col("event_id").cast("string")).alias("event"), normalize_pointer(F.col("owner_pointer")).alias("owner"), standard_place(F.col("place"))["id"].alias("place")).distinct()
    c = citations.select(normalize_pointer(F.col("source_xref")).alias("src"), normalize_pointer(F.col("owner_pointer")).alias("dst")).distinct()
    h, w = (spouses.filter(F.col("role") == r).select("fam", F.col("member").alias(r)) for r in ("HUSB", "WIFE"))
    parts = [
        (kids.select("fam", F.col("member").alias("src")).join(spouses.select("fam", F.col("member").alias("dst")), "fam").select("src", "dst"), "PARENT"),
        (h.join(w, "fam").select(F.col("HUSB").alias("src"), F.col("WIFE").alias("dst")), "SPOUSE"),
        (e.select(F.col("event").alias("src"), F.col("owner").alias("dst")), "EVENT_OF"),
        (e.select(F.col("place").alias("src"), F.col("event").alias("dst")), "PLACE_OF"),
        (c, "SOURCE_OF"),
    ]
    return reduce(DataFrame.unionByName, [d.filter("src is not null and dst is not null").distinct().withColumn("kind", F.lit(k)) for d, k in parts])


def vertices(individuals: DataFrame, families: DataFrame, events: DataFrame, sources: DataFrame) -> DataFrame:
    """``(id, kind)``."""
    ptr = lambda d, k: d.select(normalize_pointer(F.col("pointer")).alias("id"), F.lit(k).alias("kind"))
    e = events.filter("event_id is not null")
    parts = [
        ptr(individuals, "INDI"), ptr(families, "FAM"), ptr(sources, "SOURCE"),
        e.select(F.concat(F.lit("E"), F.col("event_id").cast("string")).alias("id"), F.lit("EVENT").alias("kind")),
        e.select(standard_place(F.col("place"))["id"].alias("id"), F.lit("PLACE").alias("kind")),
    ]
    return reduce(DataFrame.unionByName, parts).filter("id is not null").distinct()
