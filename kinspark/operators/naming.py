"""Names of individuals: normalisation and the index of names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinspark.functions.identity import normalize_pointer, uuid_for_name
from kinspark.functions.names import clean, name_block


def normalize_names(records: DataFrame) -> DataFrame:
    """Every name with what its person's best name knows and it lacks, and the
    person's ``normalized_full``. The best is the first with a full name."""
    person = normalize_pointer(F.col("pointer"))
    block = name_block(*[F.col(c) for c in ("full_name", "given", "surname", "prefix", "suffix", "nickname", "name_type")])
    n = records.select("name_id", person.alias("pointer"), "full_name", "given", "surname", "suffix", block.alias("b"))
    rank = F.struct(clean(F.col("full_name")).isNull(), "name_id")
    best = n.groupBy("pointer").agg(F.min_by("b", rank).alias("best"))
    j = n.join(best, "pointer")
    return j.select(
        "name_id", "pointer", clean(F.col("full_name")).alias("full_name"),
        F.coalesce(clean(F.col("given")), F.col("best.parsed.given")).alias("given"),
        F.coalesce(clean(F.col("surname")), F.col("best.parsed.surname")).alias("surname"),
        F.coalesce(clean(F.col("suffix")), F.col("best.parsed.suffix")).alias("suffix"),
        F.col("best.normalized.full").alias("normalized_full"),
    )


def normalized_counts(records: DataFrame) -> DataFrame:
    """One row of counts: people, their names, what normalize_names() fills in, and
    the people that get a normalised name."""
    before = records.select("name_id", *[clean(F.col(c)).alias(c + "_0") for c in ("given", "surname", "suffix")])
    j = normalize_names(records).join(before, "name_id")
    filled = lambda c: F.count_if(F.col(c + "_0").isNull() & F.col(c).isNotNull()).alias(f"n_filled_{c}")
    return j.agg(
        F.count_distinct("pointer").alias("n_people"), F.count("*").alias("n_names"), filled("given"), filled("surname"), filled("suffix"),
        F.count_distinct(F.when(F.col("normalized_full").isNotNull(), F.col("pointer"))).alias("n_normalized"),
    )


def name_identity(records: DataFrame) -> DataFrame:
    """``(pointer, normalized, uuid)`` of each person's best name."""
    best = normalize_names(records).groupBy("pointer").agg(F.min("normalized_full").alias("normalized"))
    return best.filter("normalized is not null").withColumn("uuid", uuid_for_name(F.col("pointer"), F.col("normalized")))


def name_index(identities: DataFrame) -> DataFrame:
    """How many individuals bear each normalised name, and the least of them."""
    return identities.groupBy("normalized").agg(F.count("*").alias("occurrences"), F.min("pointer").alias("first_pointer"))
