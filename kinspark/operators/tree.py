"""The tree of a lineage file as an adjacency table.

``nodes(file, lineno, record_lineno, parent_lineno, level, tag, value, pointer)``.
No step gathers a whole file in one task: record boundaries are carried from one
range of lines to the next through a table with one row per range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Lines per range.
RANGE = 1 << 16


def with_records(tokens: DataFrame) -> DataFrame:
    """Each line with the line of its record (the last level 0 up to it)."""
    t = tokens.withColumn("_b", F.floor(F.col("lineno") / RANGE))
    zero = F.when(F.col("level") == 0, F.col("lineno"))
    carry = t.groupBy("file", "_b").agg(F.max(zero).alias("_z"))
    before = W.partitionBy("file").orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    carry = carry.select("file", "_b", F.max("_z").over(before).alias("_c"))
    here = W.partitionBy("file", "_b").orderBy("lineno").rowsBetween(W.unboundedPreceding, 0)
    return t.join(carry, ["file", "_b"]).withColumn("record_lineno", F.coalesce(F.max(zero).over(here), "_c")).drop("_b", "_c")


def build_nodes(tokens: DataFrame) -> DataFrame:
    """Each line hangs on the nearest line before it in its record that is one
    level up. A line meets its candidates in the group of that level."""
    t = with_records(tokens)
    up = F.struct((F.col("level") - 1).alias("k"), F.lit(None).cast("int").alias("candidate"), F.col("lineno").alias("child"))
    own = F.struct(F.col("level").alias("k"), F.col("lineno").cast("int").alias("candidate"), F.lit(None).cast("int").alias("child"))
    pairs = t.select("file", "record_lineno", "lineno", F.explode(F.array(up, own)).alias("p")).select("file", "record_lineno", "lineno", "p.*").filter("k >= 0")
    w = W.partitionBy("file", "record_lineno", "k").orderBy("lineno").rowsBetween(W.unboundedPreceding, -1)
    parents = pairs.withColumn("parent_lineno", F.last("candidate", ignorenulls=True).over(w)).filter("child is not null").select("file", F.col("child").alias("lineno"), "parent_lineno")
    cols = ["file", "lineno", "record_lineno", "parent_lineno", "level", "tag", "value", "pointer"]
    return t.join(parents, ["file", "lineno"], "left").select(*cols)


def level_jumps(tokens: DataFrame) -> DataFrame:
    """Lines more than one level below the line before, and first lines that
    are not of level 0. Within a record each line compares with the one before."""
    t = with_records(tokens)
    w = W.partitionBy("file", "record_lineno").orderBy("lineno")
    before = F.lag("level").over(w)
    return t.withColumn("previous_level", before).filter("level > coalesce(previous_level, -1) + 1").select("file", "lineno", "level", "previous_level")


def find_by_pointer(nodes: DataFrame, pointer: str) -> DataFrame:
    """The last node of the pointer in each file."""
    hit = nodes.filter(F.col("pointer") == pointer)
    return hit.groupBy("file").agg(F.max_by(F.struct(*hit.columns), "lineno").alias("n")).select("n.*")


def find_records(nodes: DataFrame, tag: str) -> DataFrame:
    """Records of a tag in any case."""
    return nodes.filter((F.col("level") == 0) & (F.upper("tag") == tag.upper()))


def all_tags(nodes: DataFrame) -> DataFrame:
    """The tags of records."""
    return nodes.filter("level = 0").select("tag").distinct()


def children(nodes: DataFrame, parents: DataFrame, tag: str | None = None) -> DataFrame:
    """T4: the direct children of some nodes."""
    up = parents.select("file", F.col("lineno").alias("parent_lineno"))
    hit = nodes.filter(F.upper("tag") == tag.upper()) if tag else nodes
    return hit.join(up, ["file", "parent_lineno"], "left_semi")


def fold_text(nodes: DataFrame) -> DataFrame:
    """CONC and CONT pieces joined to the value of their parent; the pieces and
    what hangs on them are gone."""
    piece = F.upper("tag").isin("CONC", "CONT")
    text = F.concat(F.when(F.upper("tag") == "CONT", "\n").otherwise(""), F.coalesce("value", F.lit("")))
    more = (
        nodes.filter(piece)
        .groupBy("file", F.col("parent_lineno").alias("lineno"))
        .agg(F.array_sort(F.collect_list(F.struct("lineno", text.alias("t")))).alias("p"))
        .select("file", "lineno", F.array_join(F.transform("p", lambda x: x["t"]), "").alias("_more"))
    )
    gone = nodes.filter(piece).select("file", F.col("lineno").alias("parent_lineno"))
    kept = nodes.filter(~piece).join(gone, ["file", "parent_lineno"], "left_anti")
    value = F.when(F.col("_more").isNotNull(), F.concat(F.coalesce("value", F.lit("")), "_more")).otherwise(F.col("value"))
    return kept.join(more, ["file", "lineno"], "left").withColumn("value", value).drop("_more").select(*nodes.columns)


def fold_flat(tokens: DataFrame) -> DataFrame:
    """Pieces joined to the last kept line before them, whatever the levels;
    a CONT on an empty text adds no line end."""
    piece = F.upper("tag").isin("CONC", "CONT")
    t = with_records(tokens)
    w = W.partitionBy("file", "record_lineno").orderBy("lineno")
    t = t.withColumn("_g", F.sum((~piece).cast("int")).over(w))
    merged = t.groupBy("file", "record_lineno", "_g").agg(
        F.array_sort(F.collect_list(F.struct("lineno", "level", "tag", "pointer", F.coalesce("value", F.lit("")).alias("value")))).alias("ls")
    )
    text = F.aggregate(
        F.slice("ls", 2, 1 << 30),
        F.element_at("ls", 1)["value"],
        lambda acc, x: F.when((F.upper(x["tag"]) == "CONT") & (acc != ""), F.concat(acc, F.lit("\n"), x["value"])).otherwise(F.concat(acc, x["value"])),
    )
    first = F.element_at("ls", 1)
    return merged.select("file", first["lineno"].alias("lineno"), first["level"].alias("level"), first["tag"].alias("tag"), first["pointer"].alias("pointer"), text.alias("value"))
