"""Cross-references (J2-J5): links between tables and the index of identifiers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinspark.functions.identity import normalize_pointer, uuid_for_pointer


def resolve_links(owners: DataFrame, field: str, targets: DataFrame) -> DataFrame:
    """``(pointer, at, ref, uuid)``: the references of an array field in order;
    the uuid is null where the target doesn't exist."""
    known = targets.select(normalize_pointer(F.col("pointer")).alias("ref")).filter("ref is not null").distinct().withColumn("uuid", uuid_for_pointer(F.col("ref")))
    refs = owners.select(normalize_pointer(F.col("pointer")).alias("pointer"), F.posexplode(field).alias("at", "raw")).select("pointer", "at", normalize_pointer(F.col("raw")).alias("ref"))
    return refs.filter("ref is not null").distinct().join(known, "ref", "left").select("pointer", "at", "ref", "uuid")


def resolve_members(members: DataFrame, individuals: DataFrame) -> DataFrame:
    """Family members with their uuid, null where they don't exist."""
    known = individuals.select(normalize_pointer(F.col("pointer")).alias("member")).filter("member is not null").distinct().withColumn("uuid", uuid_for_pointer(F.col("member")))
    return members.join(known, "member", "left")


def uuid_index(tables: dict[str, DataFrame], uuid: str = "uuid") -> DataFrame:
    """``(rec_type, pointer, uuid)``: the record's own uuid, else one derived."""
    parts = []
    for name, df in tables.items():
        own = F.col(uuid) if uuid in df.columns else F.lit(None).cast("string")
        p = normalize_pointer(F.col("pointer"))
        rows = df.select(F.lit(name).alias("rec_type"), p.alias("pointer"), F.coalesce(F.nullif(own, F.lit("")), uuid_for_pointer(F.col("pointer"))).alias("uuid"))
        parts.append(rows.filter("pointer is not null").groupBy("rec_type", "pointer").agg(F.min("uuid").alias("uuid")))
    return reduce(DataFrame.unionByName, parts)
