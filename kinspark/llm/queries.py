"""Queries of the operators in this subpackage, with SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinspark.llm import canonical, mixing, name_link, spam, survivor, tokenizer
from kinspark.plans.training import pointer_sql
from kinspark.session import read_table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return survivor.event_survivors(read_table(spark, d, "event_records"))


def p1_trusted(spark: SparkSession, d: str) -> DataFrame:
    """As p1_found, but of equally complete rows the one of higher quality."""
    return survivor.event_survivors(read_table(spark, d, "event_records"), F.when(F.col("quality").between(0, 3), F.col("quality")))


def p1_survivors(spark: SparkSession, d: str) -> DataFrame:
    return survivor.survivor_records(read_table(spark, d, "event_records"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return canonical.canonical_values(*(read_table(spark, d, t) for t in ("event_records", "places_ref", "occupations_ref")))


def p4_report(spark: SparkSession, d: str) -> DataFrame:
    return canonical.unmatched_values(p4_found(spark, d))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return name_link.linked_names(read_table(spark, d, "name_records"))


def p5_classes(spark: SparkSession, d: str) -> DataFrame:
    return name_link.name_classes(read_table(spark, d, "name_records"))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokenizer.token_ids(read_table(spark, d, "documents"))


def p8_lengths(spark: SparkSession, d: str) -> DataFrame:
    return tokenizer.count_by_length(read_table(spark, d, "documents"))


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix_plan(read_table(spark, d, "documents"), read_table(spark, d, "mix_targets"))[0]


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix_plan(read_table(spark, d, "documents"), read_table(spark, d, "mix_targets"))[1]


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return spam.spam_pages(read_table(spark, d, "documents"))


def p10_shares(spark: SparkSession, d: str) -> DataFrame:
    """Pages and flagged pages per tenth of stuffed bytes."""
    shares = spam.stuffed_pages(read_table(spark, d, "documents"))
    return shares.groupBy(F.floor(F.col("share") * 10).cast("int").alias("tenth")).agg(F.count("*").alias("n_docs"))


QUERIES = {
    "p1_found": p1_found, "p1_survivors": p1_survivors, "p1_trusted": p1_trusted, "p4_found": p4_found, "p4_report": p4_report, "p5_found": p5_found, "p5_classes": p5_classes,
    "p8_ids": p8_ids, "p8_lengths": p8_lengths, "p9_mix": p9_mix, "p9_shares": p9_shares, "p10_found": p10_found, "p10_shares": p10_shares,
}

_M = survivor._MONTH
_D = r"(0?[1-9]|[12][0-9]|3[01])"
_N = r"(0?[1-9]|1[0-2])"
_Y = r"[0-9]{3,4}"


def _re(pattern: str) -> str:
    return pattern.replace(" ", r"\s+").replace("'", "''")


_EVENTS = f"""norm AS (SELECT DISTINCT event_id, upper(trim(tag)) AS tag, {pointer_sql('owner_pointer')} AS owner, lower(trim(date_text)) AS dt, date_text, place, sources, updated_at FROM event_records),
keyed AS (SELECT *, CASE WHEN tag IN ('BIRT', 'CHR', 'DEAT', 'BURI', 'MARR') THEN tag || '|' || owner
  WHEN tag = 'CENS' AND regexp_matches(date_text, '(^|[^0-9])[0-9]{{3,4}}([^0-9]|$)') THEN tag || '|' || owner || '|' || regexp_extract(date_text, '(^|[^0-9])([0-9]{{3,4}})([^0-9]|$)', 2) END AS g,
  CASE WHEN regexp_full_match(dt, '{_re(f"{_D} {_M},? {_Y}|{_M} {_D},? {_Y}|{_Y}-{_N}-{_D}|{_D}[./]{_N}[./]{_Y}")}') THEN 4
  WHEN regexp_full_match(dt, '{_re(f"{_M},? {_Y}|{_Y}-{_N}")}') THEN 3
  WHEN regexp_full_match(dt, '{_Y}') THEN 2
  WHEN regexp_matches(dt, '^(abt|about|circa|ca|bef|before|aft|after|bet|between|from|to|est|cal)[^a-z].*{_Y}') THEN 1 ELSE 0 END AS sd,
  coalesce(len(list_filter(string_split(place, ','), lambda x: trim(x) <> '')), 0) AS sp,
  coalesce(len(list_distinct(list_filter(list_transform(sources, lambda s: {pointer_sql('s')}), lambda s: s IS NOT NULL))), 0) AS ss
  FROM norm WHERE owner IS NOT NULL),
best AS (SELECT g, min(event_id) AS group_id, count(DISTINCT event_id) AS n,
  coalesce(first(event_id ORDER BY sd DESC, updated_at DESC, event_id) FILTER (WHERE sd > 0), -1) AS date_from,
  coalesce(first(event_id ORDER BY sp DESC, updated_at DESC, event_id) FILTER (WHERE sp > 0), -1) AS place_from,
  coalesce(first(event_id ORDER BY ss DESC, updated_at DESC, event_id) FILTER (WHERE ss > 0), -1) AS sources_from
  FROM keyed WHERE g IS NOT NULL GROUP BY g HAVING count(DISTINCT event_id) > 1)"""

_TRUSTED = _EVENTS.replace("updated_at FROM event_records", "updated_at, CASE WHEN quality BETWEEN 0 AND 3 THEN quality END AS q FROM event_records").replace("DESC, updated_at DESC", "DESC, q DESC, updated_at DESC")

ORACLES = {
    "p1_trusted": f"WITH {_TRUSTED} SELECT group_id, date_from, place_from, sources_from FROM best",
    "p1_found": f"WITH {_EVENTS} SELECT group_id, date_from, place_from, sources_from FROM best",
    "p1_survivors": f"""WITH {_EVENTS}, e AS (SELECT DISTINCT event_id, tag, owner, date_text, place, sources FROM norm)
SELECT b.group_id, h.owner AS owner_pointer, h.tag, a.date_text, p.place, array_to_string(s.sources, ' ') AS sources FROM best b
JOIN e h ON h.event_id = b.group_id LEFT JOIN e a ON a.event_id = b.date_from LEFT JOIN e p ON p.event_id = b.place_from LEFT JOIN e s ON s.event_id = b.sources_from""",
}
