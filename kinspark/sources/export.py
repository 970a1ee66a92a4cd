"""SK1-SK5, VC1: exports, their validation, and reading them again.

The document of an export is a folder of JSON lines, one folder per section and one
line per record, so it is written and read in parts and no row holds it as a whole.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Sections of a document, and those every document has.
SECTIONS = ("individuals", "families", "sources", "repositories", "media_objects", "places", "place_versions", "jurisdiction_systems", "uuid_index")
REQUIRED = ("individuals", "families", "sources", "repositories", "media_objects")


def write_tables(tables: dict[str, DataFrame], path: str, mode: str = "overwrite") -> None:
    """One parquet table per entity: the default form of an export."""
    for name, df in tables.items():
        df.write.mode(mode).parquet(f"{path}/{name}")


def json_entries(tables: dict[str, DataFrame], key: str = "pointer") -> DataFrame:
    """``(section, key, entry)``: every record as JSON."""
    rows = [df.select(F.lit(name).alias("section"), F.col(key).cast("string").alias("key"), F.to_json(F.struct(*[c for c in df.columns if c != key])).alias("entry")) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, rows)


def write_json(tables: dict[str, DataFrame], path: str, key: str = "pointer") -> None:
    """JSON lines partitioned by section."""
    json_entries(tables, key).write.mode("overwrite").partitionBy("section").json(path)


def read_json(spark: SparkSession, path: str, section: str, schema: str | StructType) -> DataFrame:
    """A section of a written document: ``key`` and the fields of ``schema``."""
    rows = spark.read.schema("section string, key string, entry string").json(path).filter(F.col("section") == section)
    return rows.select("key", F.from_json("entry", schema).alias("r")).select("key", "r.*")


def validate_export(entries: DataFrame, schemas: dict[str, dict[str, str]]) -> DataFrame:
    """SK5, VC1: ``(section, key, rule, field)`` of everything wrong in ``(section, key,
    entry)``. ``schemas``: section -> field -> ``string``, ``number``, ``array``, ``object`` or
    ``boolean``, with ``!`` after it where the field must be there and ``null`` is no value.
    Rules: ``unknown_section``, ``missing_section``, ``no_key``, ``repeated_key``, ``no_object``,
    ``unknown_field``, ``missing_field``, ``wrong_type``."""
    spark = entries.sparkSession
    rows = entries.select("section", "key", "entry", F.try_parse_json("entry").alias("v"))
    whole = F.col("v").isNotNull() & F.trim("entry").startswith("{")
    found = [
        rows.filter(~F.col("section").isin(*SECTIONS)).select("section", "key", F.lit("unknown_section").alias("rule"), F.lit(None).cast("string").alias("field")),
        rows.filter(F.coalesce(F.trim("key"), F.lit("")) == "").select("section", "key", F.lit("no_key").alias("rule"), F.lit(None).cast("string").alias("field")),
        rows.filter(~whole).select("section", "key", F.lit("no_object").alias("rule"), F.lit(None).cast("string").alias("field")),
        rows.groupBy("section", "key").agg(F.count("*").alias("n")).filter("n > 1 and key is not null").select("section", "key", F.lit("repeated_key").alias("rule"), F.lit(None).cast("string").alias("field")),
        spark.createDataFrame([(s,) for s in REQUIRED], "section string").join(rows.select("section").distinct(), "section", "left_anti").select("section", F.lit(None).cast("string").alias("key"), F.lit("missing_section").alias("rule"), F.lit(None).cast("string").alias("field")),
    ]
    fields = rows.filter(whole).select("section", "key", F.explode(F.from_json("entry", "map<string,string>")).alias("field", "text"))
    kind = (
        F.when(F.col("text").isNull(), "null").when(F.col("text").startswith("["), "array").when(F.col("text").startswith("{"), "object")
        .when(F.col("text").isin("true", "false"), "boolean").when(F.col("text").rlike(r"^-?[0-9]+(\.[0-9]+)?([eE][-+]?[0-9]+)?$"), "number").otherwise("string")
    )
    rules = spark.createDataFrame([(s, f, k.rstrip("!"), k.endswith("!")) for s, fs in schemas.items() for f, k in fs.items()], "section string, field string, wanted string, must boolean")
    typed = fields.select("section", "key", "field", kind.alias("kind")).join(F.broadcast(rules), ["section", "field"], "left")  # rules: one row per field of the schema
    known = typed.filter(F.col("section").isin(*schemas))
    # A text may look like any other value.
    bad = F.col("wanted").isNotNull() & (F.col("kind") != "null") & (F.col("wanted") != "string") & (F.col("kind") != F.col("wanted"))
    found.append(known.filter("wanted is null").select("section", "key", F.lit("unknown_field").alias("rule"), "field"))
    found.append(known.filter(bad).select("section", "key", F.lit("wrong_type").alias("rule"), "field"))
    wanted = rows.filter(whole).select("section", "key", F.from_json("entry", "map<string,string>").alias("m")).join(F.broadcast(rules.filter("must")), "section")
    found.append(wanted.filter("try_element_at(m, field) is null").select("section", "key", F.lit("missing_field").alias("rule"), "field"))
    return reduce(DataFrame.unionByName, found)


def read_document(spark: SparkSession, path: str, section: str, schema: str) -> DataFrame:
    """A section ``{key: record}`` of JSON documents that are one object a file, as other
    programs write them. A document is parsed as a whole, so it must fit into a task
    (2 GB at most); larger archives are read with read_json()."""
    text = spark.read.text(path, wholetext=True)
    doc = text.select(F.from_json("value", f"struct<`{section}`: map<string, {schema}>>").alias("d"))
    return doc.select(F.explode(f"d.`{section}`").alias("key", "r")).select("key", "r.*")


def load_config(path: str) -> dict:
    """A YAML file as options, where the YAML library is there."""
    try:
        import yaml
    except ImportError as e:
        raise RuntimeError("reading YAML needs the yaml library") from e
    with open(path, encoding="utf-8") as f:
        return yaml.safe_load(f) or {}
