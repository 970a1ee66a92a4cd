"""Lineage text: files of level-numbered lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: level, pointer, tag, value of a line; a pointer must be followed by a tag.
LINE = r"(?s)^([0-9]+) +(?:(@[^ ]*) +([^ ]+)|([^ @][^ ]*))(?: (.*))?$"


def resolve_path(spark: SparkSession, path: str | None) -> str | None:
    """The full name of an input file in any file system Spark reads; an error where it
    isn't there or is no file."""
    if path is None:
        return None
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(at):
        raise FileNotFoundError(f"no such input: {path}")
    status = fs.getFileStatus(at)
    if not status.isFile():
        raise ValueError(f"no file: {path}")
    return status.getPath().toString()


def split_rows(text: DataFrame) -> DataFrame:
    """Rows of the text source as ``(file, _block, raw)``: the file and split of each line."""
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"), F.make_valid_utf8("value").alias("raw"))


def number_lines(rows: DataFrame) -> DataFrame:
    """``(file, lineno, raw)`` of split_rows(): non-blank lines, numbered from 1 with
    blank ones counted. A line's number is its place in its split and the lines of the
    splits before, of which a table of one row per split keeps count."""
    rows = rows.withColumn("_id", F.monotonically_increasing_id())
    splits = rows.groupBy("file", "_block").agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
    before = F.sum("_n").over(W.partitionBy("file").orderBy("_block").rowsBetween(W.unboundedPreceding, -1))
    splits = splits.select("file", "_block", "_first", F.coalesce(before, F.lit(0)).alias("_before"))
    return rows.join(splits, ["file", "_block"]).select("file", (F.col("_before") + F.col("_id") - F.col("_first") + 1).alias("lineno"), "raw").filter(F.trim("raw") != "")


def read_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``(file, lineno, raw)`` of text files; a file is read by as many tasks as it has splits."""
    return number_lines(split_rows(spark.read.text(paths)))


def error_code(raw: Column) -> Column:
    """L3: what is wrong with a line, null if nothing is."""
    t = F.trim(raw)
    return (
        F.when(raw.rlike(LINE), F.lit(None).cast("string"))
        .when(t == "", "blank")
        .when(t.rlike("^[0-9]+$"), "level_only")
        .when(~t.rlike("^[0-9]+ "), "bad_level")
        .when(t.rlike(r"^[0-9]+ +@[^ ]*$"), "pointer_without_tag")
        .otherwise("empty_tag")
    )


def _stripped(lines: DataFrame) -> DataFrame:
    bom = F.when(F.col("lineno") == 1, F.regexp_replace("raw", "^﻿", "")).otherwise(F.col("raw"))
    return lines.withColumn("raw", F.regexp_replace(bom, r"[\r\n]+$", ""))


def tokenize(lines: DataFrame, mode: str = "failfast") -> DataFrame:
    """L2: ``(file, lineno, level, pointer, tag, value, raw)``. ``failfast`` fails on
    a bad line, ``permissive`` leaves it out; see line_errors."""
    part = lambda i: F.regexp_extract("raw", LINE, i)
    s = _stripped(lines)
    ok = F.col("raw").rlike(LINE)
    level = part(1).try_cast("int")
    if mode == "failfast":
        level = F.when(ok, level).otherwise(F.raise_error(F.concat(F.lit("bad line "), F.col("lineno"), F.lit(": "), F.col("raw"))).cast("int"))
    else:
        s = s.filter(ok)
    return s.select(
        "file", "lineno", level.alias("level"), F.nullif(part(2), F.lit("")).alias("pointer"),
        F.coalesce(F.nullif(part(3), F.lit("")), part(4)).alias("tag"), part(5).alias("value"), "raw",
    )


def line_errors(lines: DataFrame) -> DataFrame:
    """L3: ``(file, lineno, code, raw)`` of the lines that can't be read."""
    s = _stripped(lines)
    return s.select("file", "lineno", error_code(F.col("raw")).alias("code"), "raw").filter("code is not null")


def to_text(nodes: DataFrame) -> DataFrame:
    """Nodes back to lines; values with line ends become CONT lines."""
    pieces = F.split(F.coalesce("value", F.lit("")), "\n")
    head = F.concat_ws(" ", F.col("level").cast("string"), "pointer", "tag", F.nullif(F.element_at(pieces, 1), F.lit("")))
    more = F.transform(F.slice(pieces, 2, 1 << 20), lambda p: F.concat_ws(" ", (F.col("level") + 1).cast("string"), F.lit("CONT"), F.nullif(p, F.lit(""))))
    out = nodes.select("file", "lineno", F.posexplode(F.concat(F.array(head), more)).alias("at", "raw"))
    return out.select("file", "lineno", "at", "raw")
