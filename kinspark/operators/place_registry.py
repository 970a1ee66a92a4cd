"""Places: registry, hierarchy, versions and their checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kinspark.functions.dates import first_year
from kinspark.functions.identity import place_version_id
from kinspark.functions.places import levels, standard_place

EXAMPLES = 5


def standardize(events: DataFrame, place: str = "place") -> DataFrame:
    """Events with ``place_id`` and ``place_normalized``."""
    s = standard_place(F.col(place))
    return events.withColumns({"place_id": s["id"], "place_normalized": s["normalized"]})


def standardized_counts(events: DataFrame, owner_type: str = "owner_type", owner: str = "owner") -> DataFrame:
    """One row of counts over standardised events: owners of either kind that have
    some, events, and those with a place."""
    who = lambda t: F.count_distinct(F.when(F.col(owner_type) == t, F.col(owner)))
    return events.agg(who("INDI").alias("n_individuals"), who("FAM").alias("n_families"), F.count("*").alias("n_events"), F.count("place_id").alias("n_with_places"))


def place_registry(events: DataFrame, owner_type: str = "owner_type", place: str = "place") -> DataFrame:
    """One row per place with its counts and the least raw writings."""
    e = standardize(events, place).filter("place_id is not null")
    counts = e.groupBy("place_id").agg(
        F.min("place_normalized").alias("normalized"), F.count("*").alias("n_events"),
        F.count_if(F.col(owner_type) == "INDI").alias("n_individual"), F.count_if(F.col(owner_type) == "FAM").alias("n_family"),
    )
    at = F.row_number().over(W.partitionBy("place_id").orderBy("raw"))
    few = e.select("place_id", F.col(place).alias("raw")).distinct().withColumn("at", at).filter(F.col("at") <= EXAMPLES)
    raws = few.groupBy("place_id").agg(F.array_sort(F.collect_list("raw")).alias("raw_examples"))
    return counts.join(raws, "place_id")


def place_hierarchy(places: DataFrame) -> DataFrame:
    """V2: ``(place_id, parent_id, n_levels, generated, n_children)``: every suffix of
    a place's levels is a place too; those not in the registry are generated."""
    x = levels(F.col("place_id"))
    suffix = F.transform(F.sequence(F.lit(1), F.size("x")), lambda i: F.array_join(F.slice(F.col("x"), i, F.size("x")), ", "))
    chains = places.select("place_id", x.alias("x")).filter(F.size("x") > 0).select("place_id", F.posexplode(suffix).alias("at", "id"), F.size("x").alias("n"))
    all_ids = chains.select(F.when(F.col("at") == 0, F.col("place_id")).otherwise(F.col("id")).alias("place_id"), (F.col("n") - F.col("at")).alias("n_levels"), "id")
    known = places.select("place_id", F.lit(True).alias("_k")).distinct()
    rows = all_ids.groupBy("place_id").agg(F.max("n_levels").alias("n_levels"), F.min("id").alias("id"))
    parent = F.when(F.col("n_levels") > 1, F.array_join(F.slice(levels(F.col("id")), F.lit(2), F.col("n_levels")), ", "))
    rows = rows.select("place_id", parent.alias("parent_id"), "n_levels").join(known, "place_id", "left").withColumn("generated", F.col("_k").isNull()).drop("_k")
    kids = rows.filter("parent_id is not null").groupBy(F.col("parent_id").alias("place_id")).agg(F.count("*").alias("n_children"))
    return rows.join(kids, "place_id", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))


def jurisdictions(spark, default: str = "default", enabled: list[str] | None = None) -> DataFrame:
    """V4."""
    ids = list(dict.fromkeys([default, *(enabled or [])]))
    return spark.createDataFrame([(i, i.replace("_", " ").title(), i != default) for i in ids], "id string, name string, inferred boolean")


def place_refs(events: DataFrame, systems: DataFrame, open_ended: bool = True) -> DataFrame:
    """V3, V5: ``(event_id, place_id, js_id, year, confidence, place_version_id)``, one
    per event, place and system; the year comes from the date, else the value."""
    e = standardize(events).filter("place_id is not null")
    year = first_year(F.col("date_text"))
    said = first_year(F.col("value_text"))
    e = e.select("event_id", "place_id", F.coalesce(year, said).alias("year"), F.when(year.isNotNull(), 0.95).otherwise(0.6).alias("confidence"))
    if not open_ended:
        e = e.filter("year is not null")
    ids = [r["id"] for r in systems.select("id").collect()]  # the few systems that are enabled
    refs = e.select("*", F.explode(F.array(*map(F.lit, ids))).alias("js_id"))
    return refs.withColumn("place_version_id", place_version_id(F.col("place_id"), F.col("js_id"), F.col("year")))


def place_versions(refs: DataFrame) -> DataFrame:
    """Versions with the number of references, always computed anew."""
    return refs.groupBy("place_version_id", "place_id", "js_id", "year").agg(F.count("*").alias("n_refs"), F.max("confidence").alias("confidence"))


def merge_report(changes: DataFrame, versions: DataFrame) -> DataFrame:
    """``(change_id, kind, side, place_version_id)`` of the merges and splits
    that name versions which don't exist. ``changes``: ``(change_id, kind, from_ids,
    to_ids)``; a merge has several versions before, a split several after."""
    sides = [changes.select("change_id", "kind", F.lit(side).alias("side"), F.explode(f"{side}_ids").alias("place_version_id")) for side in ("from", "to")]
    return sides[0].unionByName(sides[1]).join(versions.select("place_version_id"), "place_version_id", "left_anti").select("change_id", "kind", "side", "place_version_id")


def integrity(events: DataFrame, places: DataFrame, refs: DataFrame, versions: DataFrame, systems: DataFrame) -> DataFrame:
    """VC2-VC4, J10: ``(check, n_bad)`` for every rule."""
    p, v, s = places.select("place_id"), versions.select("place_version_id"), systems.select(F.col("id").alias("js_id"))
    own = standardize(events).filter("place_id is not null").select("event_id", F.col("place_id").alias("own"))
    checks = {
        "event_place": own.select(F.col("own").alias("place_id")).join(p, "place_id", "left_anti"),
        "version_place": versions.join(p, "place_id", "left_anti"),
        "version_system": versions.join(s, "js_id", "left_anti"),
        "ref_version": refs.join(v, "place_version_id", "left_anti"),
        "ref_system": refs.join(s, "js_id", "left_anti"),
        "ref_same_place": refs.join(own, "event_id").filter("place_id <> own"),
        "ref_year": refs.filter("year is not null and (year < 1 or year > 9999)"),
    }
    out = None
    for name, bad in checks.items():
        row = bad.agg(F.count("*").alias("n_bad")).select(F.lit(name).alias("rule"), "n_bad")
        out = row if out is None else out.unionByName(row)
    return out
