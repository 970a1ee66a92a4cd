"""Lineage lines made from the star-schema tables, for queries over text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinspark.session import read_table


def people(spark: SparkSession, d: str) -> DataFrame:
    c, n, r = (read_table(spark, d, t) for t in ("customer", "nation", "region"))
    return c.join(n, c["c_nationkey"] == n["n_nationkey"]).join(r, n["n_regionkey"] == r["r_regionkey"])


def synth_lines(spark: SparkSession, d: str) -> DataFrame:
    """One file per nation, ten lines per customer, a family of three lines on top."""
    p = people(spark, d)
    k = F.col("c_custkey")
    year = (1800 + k % 100).cast("string")
    date = F.when(k % 4 == 0, year).when(k % 4 == 1, F.concat(F.lit("ABT "), year)).when(k % 4 == 2, F.concat(F.lit("MAR "), year)).otherwise(F.concat((1 + k % 28).cast("string"), F.lit(" MAR "), year))
    raws = [
        F.concat(F.lit("0 @I"), k, F.lit("@ INDI")),
        F.concat(F.lit("1 NAME "), "c_mktsegment", F.lit(" /"), "c_name", F.lit("/")),
        F.concat(F.lit("1 SEX "), F.when(k % 2 == 0, "F").otherwise("M")),
        F.lit("1 BIRT"),
        F.concat(F.lit("2 DATE "), date),
        F.concat(F.lit("2 PLAC "), "n_name", F.lit(",  "), "r_name"),
        F.concat(F.lit("1 NOTE entry "), k),
        F.lit("2 CONC  and more"),
        F.lit("2 CONT next line"),
        F.concat(F.lit("1 FAMS @F"), "n_nationkey", F.lit("@")),
    ]
    file = F.concat(F.lit("nation-"), F.col("n_nationkey").cast("string"))
    lines = p.select(file.alias("file"), k.alias("k"), F.posexplode(F.array(*raws)).alias("at", "raw")).select("file", (F.col("k") * 10 + 100 + F.col("at")).alias("lineno"), "raw")
    fam = p.groupBy("n_nationkey").agg(F.min("c_custkey").alias("h"), F.max("c_custkey").alias("w"))
    top = F.array(F.concat(F.lit("0 @F"), "n_nationkey", F.lit("@ FAM")), F.concat(F.lit("1 HUSB @I"), "h", F.lit("@")), F.concat(F.lit("1 WIFE @I"), "w", F.lit("@")))
    head = fam.select(file.alias("file"), F.posexplode(top).alias("at", "raw")).select("file", (F.col("at") + 1).cast("bigint").alias("lineno"), "raw")
    return lines.unionByName(head)
