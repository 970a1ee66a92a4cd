"""Queries of the general training-data operators, with SQL for those that SQL
can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinspark.operators import flatten, hierarchy, orphans, packed
from kinspark.session import read_table


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return flatten.record_nodes(read_table(spark, d, "raw_records")).select("record_id", "node_path", "parent_path", "tag")


def p2_tags(spark: SparkSession, d: str) -> DataFrame:
    nodes = flatten.record_nodes(read_table(spark, d, "raw_records"))
    return nodes.groupBy("tag").agg(
        F.count("*").alias("n_nodes"), F.count("value").alias("n_values"), F.max(F.size(F.split("node_path", r"\."))).cast("bigint").alias("deepest")
    )


def _lines(spark: SparkSession, d: str) -> DataFrame:
    return hierarchy.lines_of_descent(read_table(spark, d, "individuals"), read_table(spark, d, "families"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _lines(spark, d)


def p3_descendants(spark: SparkSession, d: str) -> DataFrame:
    """Descendants of every individual that has some, and how far down they go."""
    links = hierarchy.parent_links(read_table(spark, d, "individuals"), read_table(spark, d, "families"))
    below = hierarchy.descendants(hierarchy.resolve_hierarchy(links))
    return below.groupBy(F.col("ancestor").alias("pointer")).agg(F.count("*").alias("n_descendants"), F.max("steps").cast("bigint").alias("deepest"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return packed.packed_places(read_table(spark, d, "event_records"))


def _orphans(spark: SparkSession, d: str) -> DataFrame:
    return orphans.archive_orphans(*(read_table(spark, d, t) for t in ("individuals", "families", "citations", "source_records", "event_records")))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """The direct orphans; they are step 0 of the cascade, which p7_inherited and
    p7_report follow to its end."""
    found = orphans.archive_direct(*(read_table(spark, d, t) for t in ("individuals", "families", "citations", "source_records")))
    return found.select("tbl", "row_key", "field_name", "ref_pointer", "orphan_kind", "loaded_month")


def p7_inherited(spark: SparkSession, d: str) -> DataFrame:
    return _orphans(spark, d).filter("orphan_class = 'inherited'").select("tbl", "row_key", "steps")


def p7_report(spark: SparkSession, d: str) -> DataFrame:
    return orphans.orphans_per_period(_orphans(spark, d))


QUERIES = {
    "p2_found": p2_found, "p2_tags": p2_tags, "p3_found": p3_found, "p3_descendants": p3_descendants,
    "p6_found": p6_found, "p7_found": p7_found, "p7_inherited": p7_inherited, "p7_report": p7_report,
}


def pointer_sql(col: str) -> str:
    """normalize_pointer() in SQL."""
    core = f"regexp_replace(upper({col}), '^[@\\s\\p{{Z}}]+|[@\\s\\p{{Z}}]+$', '', 'g')"
    return f"CASE WHEN {core} <> '' THEN '@' || {core} || '@' END"


_P = pointer_sql("pointer")
_FAMILY_STATE = f"""fam_all AS (SELECT {_P} AS fam, loaded_at, coalesce(deleted, false) AS deleted, members FROM families),
fam AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY fam ORDER BY loaded_at DESC, deleted DESC) AS rn FROM fam_all WHERE fam IS NOT NULL) t WHERE rn = 1)"""

_LINKS = f"""{_FAMILY_STATE},
alive AS (SELECT fam, members FROM fam WHERE NOT deleted),
ind AS (SELECT DISTINCT {_P} AS node FROM individuals WHERE {_P} IS NOT NULL),
m0 AS (SELECT fam, unnest(members) AS m FROM alive),
mem AS (SELECT fam, upper(trim(m.role)) AS role, {pointer_sql('m.member')} AS node, m.ord AS ord FROM m0),
heads AS (SELECT fam, node AS parent FROM (SELECT mem.fam, mem.node, row_number() OVER (PARTITION BY mem.fam ORDER BY mem.role, mem.ord) AS rn
  FROM mem JOIN ind USING (node) WHERE mem.role IN ('HUSB', 'WIFE')) t WHERE rn = 1),
f0 AS (SELECT {_P} AS node, unnest(famc) AS raw, generate_subscripts(famc, 1) AS at FROM individuals),
f1 AS (SELECT f0.node, {pointer_sql('f0.raw')} AS fam, f0.at FROM f0),
named AS (SELECT node, arg_min(f1.fam, f1.at) AS fam FROM f1 JOIN alive ON f1.fam = alive.fam GROUP BY node),
listed AS (SELECT node, min(fam) AS fam FROM mem WHERE role = 'CHIL' AND node IS NOT NULL GROUP BY node),
link AS (SELECT ind.node, heads.parent FROM ind LEFT JOIN named ON named.node = ind.node LEFT JOIN listed ON listed.node = ind.node
  LEFT JOIN heads ON heads.fam = coalesce(named.fam, listed.fam)),
walk AS (SELECT node, node AS root, 0 AS depth, node AS path FROM link WHERE parent IS NULL
  UNION ALL SELECT link.node, walk.root, walk.depth + 1, walk.path || '/' || link.node FROM link JOIN walk ON link.parent = walk.node)"""

_REFS = f"""i0 AS (SELECT {_P} AS row_key, 'famc' AS field_name, unnest(famc) AS raw, loaded_at FROM individuals
  UNION ALL SELECT {_P}, 'fams', unnest(fams), loaded_at FROM individuals),
r0 AS (SELECT 'individuals' AS tbl, row_key, field_name, {pointer_sql('raw')} AS ref_pointer, loaded_at FROM i0
  UNION ALL SELECT 'citations', CAST(citation_id AS VARCHAR), 'source_xref', {pointer_sql('source_xref')}, loaded_at FROM citations),
r AS (SELECT tbl, row_key, field_name, ref_pointer, min(loaded_at) AS row_at FROM r0 WHERE ref_pointer IS NOT NULL AND row_key IS NOT NULL GROUP BY ALL),
t0 AS (SELECT 'individuals' AS tbl, {_P} AS ref_pointer, loaded_at, coalesce(deleted, false) AS deleted FROM families
  UNION ALL SELECT 'citations', {_P}, loaded_at, coalesce(deleted, false) FROM source_records),
t AS (SELECT tbl, ref_pointer, min(loaded_at) AS first_at, arg_max(deleted, loaded_at) AS deleted FROM t0 WHERE ref_pointer IS NOT NULL GROUP BY tbl, ref_pointer),
direct AS (SELECT * FROM (SELECT r.tbl, r.row_key, r.field_name, r.ref_pointer,
  CASE WHEN t.deleted IS NULL THEN 'missing' WHEN t.deleted THEN 'deleted' WHEN t.first_at > r.row_at THEN 'late' END AS orphan_kind,
  strftime(r.row_at, '%Y-%m') AS loaded_month FROM r LEFT JOIN t ON t.tbl = r.tbl AND t.ref_pointer = r.ref_pointer) x WHERE orphan_kind IS NOT NULL)"""

_OWN = pointer_sql("owner_pointer")
_HEIRS = f"""lost AS (SELECT DISTINCT tbl, row_key FROM direct WHERE orphan_kind <> 'late'),
last_fam AS (SELECT {_P} AS k, arg_max(members, loaded_at) AS ms, arg_max(coalesce(deleted, false), loaded_at) AS gone FROM families GROUP BY 1),
ups AS (SELECT DISTINCT 'families' AS tbl, k AS row_key, 'individuals' AS up_tbl, {pointer_sql('m.member')} AS up_key FROM (SELECT k, unnest(ms) AS m FROM last_fam WHERE k IS NOT NULL AND NOT gone)
  UNION SELECT 'individuals', k, 'families', {pointer_sql('ref')} FROM (SELECT {_P} AS k, unnest(list_concat(coalesce(famc, []), coalesce(fams, []))) AS ref FROM individuals) WHERE k IS NOT NULL
  UNION SELECT 'citations', CAST(citation_id AS VARCHAR), t, {_OWN} FROM citations, (VALUES ('individuals'), ('families')) v(t) WHERE citation_id IS NOT NULL
  UNION SELECT 'event_records', CAST(event_id AS VARCHAR), t, {_OWN} FROM event_records, (VALUES ('individuals'), ('families')) v(t) WHERE event_id IS NOT NULL),
fall(tbl, row_key, steps) USING KEY (tbl, row_key) AS (SELECT tbl, row_key, 0 FROM lost
  UNION SELECT u.tbl, u.row_key, f.steps + 1 FROM fall f JOIN ups u ON u.up_tbl = f.tbl AND u.up_key = f.row_key
  WHERE NOT EXISTS (SELECT 1 FROM recurring.fall g WHERE g.tbl = u.tbl AND g.row_key = u.row_key)),
heir AS (SELECT tbl, row_key, CAST(steps AS INTEGER) AS steps FROM fall WHERE steps > 0)"""

# Objects among the children, whatever shape holds them; arrays nest up to four deep here.
_FLAT = "flatten(list_transform({0}, lambda e: CASE json_type(e) WHEN 'ARRAY' THEN json_extract(e, '$[*]') ELSE [e] END))"
_KIDS = "list_filter(" + _FLAT.format(_FLAT.format(_FLAT.format(_FLAT.format("[c]")))) + ", lambda e: json_type(e) = 'OBJECT')"
_TREE = f"""bodies AS (SELECT record_id, CAST(any_value(body) AS JSON) AS v FROM raw_records WHERE record_id IS NOT NULL AND json_valid(body) GROUP BY record_id),
tree(record_id, path, up, v) AS (SELECT record_id, '0', '', v FROM bodies WHERE json_type(v) = 'OBJECT'
  UNION ALL SELECT record_id, path || '.' || (i - 1), path, kids[i] FROM (SELECT record_id, path, kids, unnest(range(1, len(kids) + 1)) AS i FROM (SELECT record_id, path, {_KIDS} AS kids FROM (
    SELECT record_id, path, CASE WHEN json_type(k) = 'VARCHAR' THEN CASE WHEN json_valid(k ->> '$') THEN CAST(k ->> '$' AS JSON) END ELSE k END AS c FROM (SELECT record_id, path, json_extract(v, '$.children') AS k FROM tree)) WHERE c IS NOT NULL))),
nodes AS (SELECT record_id, path AS node_path, up AS parent_path, CASE WHEN json_type(v, '$.tag') = 'VARCHAR' THEN upper(regexp_replace(v ->> '$.tag', '^[\\s\\p{{Z}}]+|[\\s\\p{{Z}}]+$', '', 'g')) END AS tag,
  CASE WHEN json_type(v, '$.value') NOT IN ('NULL', 'OBJECT', 'ARRAY') THEN v ->> '$.value' END AS value FROM tree)"""

ORACLES = {
    "p2_found": f"WITH RECURSIVE {_TREE} SELECT record_id, node_path, parent_path, tag FROM nodes",
    "p2_tags": f"WITH RECURSIVE {_TREE} SELECT tag, count(*) AS n_nodes, count(value) AS n_values, max(len(string_split(node_path, '.'))) AS deepest FROM nodes GROUP BY tag",
    "p3_found": f"""WITH RECURSIVE {_LINKS}
SELECT ind.node AS pointer, coalesce(walk.root, 'cycle') AS root_pointer, CAST(coalesce(walk.depth, -1) AS INTEGER) AS node_depth, coalesce(walk.path, '') AS node_path
FROM ind LEFT JOIN walk ON walk.node = ind.node""",
    "p3_descendants": f"""WITH RECURSIVE {_LINKS},
above AS (SELECT link.node, link.parent AS pointer, 1 AS steps FROM link JOIN walk ON walk.node = link.node WHERE link.parent IS NOT NULL
  UNION ALL SELECT above.node, link.parent, above.steps + 1 FROM above JOIN link ON link.node = above.pointer WHERE link.parent IS NOT NULL)
SELECT pointer, count(*) AS n_descendants, CAST(max(steps) AS BIGINT) AS deepest FROM above GROUP BY pointer""",
    "p7_found": f"WITH {_REFS} SELECT tbl, row_key, field_name, ref_pointer, orphan_kind, loaded_month FROM direct",
    "p7_inherited": f"WITH RECURSIVE {_REFS}, {_HEIRS} SELECT tbl, row_key, steps FROM heir",
    "p7_report": f"""WITH RECURSIVE {_REFS}, {_HEIRS}, both_kinds AS (
  SELECT tbl, field_name, 'direct' AS orphan_class, orphan_kind, loaded_month, row_key FROM direct
  UNION ALL SELECT tbl, NULL, 'inherited', 'inherited', NULL, row_key FROM heir)
SELECT tbl, field_name, orphan_class, orphan_kind, loaded_month, count(*) AS n_refs, count(DISTINCT row_key) AS n_rows FROM both_kinds GROUP BY ALL""",
}
