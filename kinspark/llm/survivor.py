"""Problem 1: the best representative of each duplicate group.

Each row stands for itself in one ranking per field. A window orders a group's
rows by completeness of the field, then trust where a trust column is named,
then recency, then the least id, and the top row gives the field. As the rank
is limited, Spark keeps only the top rows of a group in each task before the
shuffle, so a group of any size passes through no single task as a whole.

Defined results: rows with a null id or a null group key belong to no group; a
field that no row of the group has gives -1; a null recency comes last; rows
delivered twice tie with themselves and count once; groups of one row are left
out. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kinspark.functions.identity import normalize_pointer, strip

#: Tags whose records name one occurrence per owner.
ONCE = ("BIRT", "CHR", "DEAT", "BURI", "MARR")
_MONTH = r"(?:jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)\.?"
_DAY = r"(?:0?[1-9]|[12][0-9]|3[01])"
_MON = r"(?:0?[1-9]|1[0-2])"
_YEAR = r"[0-9]{3,4}"


def date_completeness(date: Column) -> Column:
    """4 for a full day, 3 a month, 2 a year, 1 a qualified or ranged date, 0 for
    what is absent or can't be read."""
    d = F.regexp_replace(F.lower(strip(date)), r"\s*\((?:julian|gregorian|old style|new style)\)$", "")
    day = rf"^(?:{_DAY} {_MONTH},? {_YEAR}|{_MONTH} {_DAY},? {_YEAR}|{_YEAR}-{_MON}-{_DAY}|{_DAY}[./]{_MON}[./]{_YEAR})$".replace(" ", r"\s+")
    month = rf"^(?:{_MONTH},? {_YEAR}|{_YEAR}-{_MON})$".replace(" ", r"\s+")
    year = rf"^(?:(?:spring|summer|autumn|fall|winter)\s+)?{_YEAR}$"
    qualified = rf"^(?:abt|about|approx|around|circa|ca|c|bef|before|prior|by|aft|after|since|est|estimated|cal|calculated|bet|btw|between|from|to|until)\b.*\b{_YEAR}\b"
    return (
        F.when(d.rlike(day), 4).when(d.rlike(month), 3).when(d.rlike(year), 2).when(d.rlike(qualified), 1).when(d.rlike(rf"^{_YEAR}\s*[-–/]\s*{_YEAR}$"), 1).otherwise(0)
    )


def place_completeness(place: Column) -> Column:
    """The number of non-blank levels between commas."""
    return F.coalesce(F.size(F.filter(F.split(place, ","), lambda x: strip(x) != "")), F.lit(0))


def source_completeness(sources: Column) -> Column:
    """The number of different sources."""
    return F.coalesce(F.size(F.array_distinct(F.array_compact(F.transform(sources, normalize_pointer)))), F.lit(0))


def best_rows(rows: DataFrame, group: str, key: str, fields: dict[str, Column], recency: str, trust: Column | None = None) -> DataFrame:
    """``(group_id, <field>_from ...)`` for every group of two or more keys.

    ``fields`` names the completeness of each field (0: the row hasn't got it)."""
    names = list(fields)
    null_at = F.lit(None).cast(dict(rows.dtypes)[recency])
    trusted = trust.cast("long") if trust is not None else F.lit(0).cast("long")
    own = F.struct(F.lit(0).alias("f"), F.lit(1).cast("long").alias("full"), F.lit(0).cast("long").alias("trust"), null_at.alias("at"))
    ranked = [F.struct(F.lit(i).alias("f"), c.cast("long").alias("full"), trusted.alias("trust"), F.col(recency).alias("at")) for i, c in enumerate(fields.values(), 1)]
    entries = (
        rows.filter(F.col(group).isNotNull() & F.col(key).isNotNull())
        .select(F.col(group).alias("g"), F.col(key).alias("id"), F.explode(F.array(own, *ranked)).alias("e"))
        .select("g", "id", "e.*")
        .filter("full > 0")
    )
    order = W.partitionBy("g", "f").orderBy(F.desc("full"), F.desc("trust"), F.desc_nulls_last("at"), "id")
    top = entries.withColumn("r", F.dense_rank().over(order)).filter("r <= 2")
    first = [F.coalesce(F.min(F.when((F.col("f") == i) & (F.col("r") == 1), F.col("id"))), F.lit(-1).cast("long")).alias(f"{n}_from") for i, n in enumerate(names, 1)]
    return (
        top.groupBy("g")
        .agg(F.min(F.when(F.col("f") == 0, F.col("id"))).alias("group_id"), F.max(F.when(F.col("f") == 0, F.col("r"))).alias("n"), *first)
        .filter("n = 2")
        .drop("n", "g")
    )


def occurrence_key() -> Column:
    """Owner and tag, for CENS also the year; null where rows name no occurrence."""
    tag = F.upper(strip(F.col("tag")))
    year = F.nullif(F.regexp_extract("date_text", rf"(?<![0-9])({_YEAR})(?![0-9])", 1), F.lit(""))
    owner = normalize_pointer(F.col("owner_pointer"))
    return F.when(tag.isin(*ONCE), F.concat_ws("|", tag, owner)).when((tag == "CENS") & year.isNotNull(), F.concat_ws("|", tag, owner, year))


def event_survivors(event_records: DataFrame, trust: Column | None = None) -> DataFrame:
    """``(group_id, date_from, place_from, sources_from)`` per occurrence. With ``trust``
    the more trusted of equally complete rows goes before the later one; a null is the
    least trusted."""
    rows = event_records.filter(normalize_pointer(F.col("owner_pointer")).isNotNull()).select(
        "event_id",
        occurrence_key().alias("g"),
        date_completeness(F.col("date_text")).alias("d"),
        place_completeness(F.col("place")).alias("p"),
        source_completeness(F.col("sources")).alias("s"),
        "updated_at",
        (trust if trust is not None else F.lit(0)).cast("long").alias("t"),
    )
    return best_rows(rows, "g", "event_id", {"date": F.col("d"), "place": F.col("p"), "sources": F.col("s")}, "updated_at", None if trust is None else F.col("t"))


def survivor_records(event_records: DataFrame) -> DataFrame:
    """The surviving record of each occurrence, its fields taken from the rows chosen."""
    picks = event_survivors(event_records)
    vals = event_records.filter("event_id is not null").groupBy("event_id").agg(F.min(F.struct("loaded_at", "owner_pointer", "tag", "date_text", "place", "sources")).alias("v"))

    def of(col: str, field: str) -> DataFrame:
        return vals.select(F.col("event_id").alias(col), F.col(f"v.{field}").alias(field))

    head = vals.select(F.col("event_id").alias("group_id"), normalize_pointer(F.col("v.owner_pointer")).alias("owner_pointer"), F.upper(strip(F.col("v.tag"))).alias("tag"))
    return (
        picks.join(head, "group_id")
        .join(of("date_from", "date_text"), "date_from", "left")
        .join(of("place_from", "place"), "place_from", "left")
        .join(of("sources_from", "sources"), "sources_from", "left")
        .select("group_id", "owner_pointer", "tag", "date_text", "place", F.array_join("sources", " ").alias("sources"))
    )
