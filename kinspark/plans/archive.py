"""Queries of the archive's operators, with the SQL that answers them from the
same tables."""

from __future__ import annotations

import difflib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kinspark.functions import dates, events as ev, identity, names, occupations, places
from kinspark.operators import claims, components, graph, naming, place_registry, registry, resolution, tree, xref
from kinspark.plans.synth import people as customers, synth_lines
from kinspark.plans.training import pointer_sql
from kinspark.session import durable, first_delivery, read_table
from kinspark.sources import lineage

B = "bigint"


def _tokens(s: SparkSession, d: str) -> DataFrame:
    return lineage.tokenize(synth_lines(s, d))


def _nodes(s: SparkSession, d: str) -> DataFrame:
    # Written once: every builder reads the nodes several times.
    return durable(tree.fold_text(tree.build_nodes(_tokens(s, d))))


def _events(s: SparkSession, d: str) -> DataFrame:
    return first_delivery(read_table(s, d, "event_records"), "event_id")


def births_by_place_and_year(s, d):
    e = place_registry.standardize(registry.events(_nodes(s, d), coordinates=False, ages=False).filter("tag = 'BIRT'"))
    year = dates.first_year(F.col("date")["date"])
    return e.groupBy("place_id", year.alias("birth_year")).agg(F.count("*").alias("n_births"))


def tokenize_lines(s, d):
    return _tokens(s, d).groupBy(F.col("level").cast(B).alias("level"), "tag").agg(F.count("*").alias("n"), F.count("pointer").alias("n_pointers"), F.sum(F.length("value")).cast(B).alias("n_chars"))


def line_errors(s, d):
    bad = F.array(*map(F.lit, ["X HEAD", "0 ", "0", "0 @I1@", "1 @I2@ ", "0 HEAD"]))
    lines = read_table(s, d, "nation").select(F.col("n_name").alias("file"), F.posexplode(bad).alias("lineno", "raw"))
    return lineage.line_errors(lines.withColumn("lineno", F.col("lineno") + 1)).groupBy("code").agg(F.count("*").alias("n"))


def tree_parents(s, d):
    return tree.build_nodes(_tokens(s, d)).select("file", "lineno", F.col("record_lineno").cast(B).alias("record_lineno"), F.col("parent_lineno").cast(B).alias("parent_lineno"))


def level_jumps(s, d):
    t = _tokens(s, d)
    broken = t.withColumn("level", F.when((F.col("lineno") % 500 == 4), 3).otherwise(F.col("level")))
    return tree.level_jumps(broken).select("file", "lineno")


def record_tags(s, d):
    n = _nodes(s, d)
    return tree.all_tags(n).join(tree.find_records(n, "indi").groupBy("tag").agg(F.count("*").alias("n_indi")), "tag", "left")


def folded_notes(s, d):
    return _nodes(s, d).filter("tag = 'NOTE'").select("file", "lineno", "value")


def lines_round_trip(s, d):
    """Folded nodes written as lines and read again."""
    back = lineage.to_text(_nodes(s, d)).select("file", (F.col("lineno") * 10 + F.col("at")).alias("lineno"), "raw")
    n = tree.fold_text(tree.build_nodes(lineage.tokenize(back)))
    return n.filter("tag = 'NOTE'").select("file", (F.col("lineno") / 10).cast(B).alias("lineno"), "value")


def entity_counts(s, d):
    return registry.entity_counts(_nodes(s, d))


def individuals(s, d):
    i = registry.individuals(_nodes(s, d))
    return i.select("pointer", "uuid", "gender", F.array_join("fams", " ").alias("fams"), F.try_element_at("notes", F.lit(1)).alias("note"))


def person_names(s, d):
    n = registry.names(_nodes(s, d))
    block = names.name_block(*[F.col(c) for c in ("full", "given", "surname", "prefix", "suffix", "nickname", "name_type")])
    return n.select("pointer", "full", block["parsed"]["given"].alias("given"), block["parsed"]["surname"].alias("surname"), block["normalized"]["full"].alias("normalized"))


def family_members(s, d):
    return registry.linked_members(_nodes(s, d)).select("family", "role", "member")


def events_extracted(s, d):
    e = registry.events(_nodes(s, d))
    return e.select("owner", "tag", "type", "place", F.col("date")["normalized"].alias("date"), F.col("date")["kind"].alias("kind"), F.col("date")["precision"].alias("date_precision"))


def event_roles(s, d):
    lines = synth_lines(s, d)
    marr = lines.filter("raw like '0 @F%'").select("file", (F.col("lineno") + 3).alias("lineno"), F.lit("1 MARR").alias("raw"))
    nodes = tree.build_nodes(lineage.tokenize(lines.unionByName(marr)))
    return registry.event_roles(nodes).filter("owner like '@F%'").select("owner", "tag", "value", "label")


def date_parse(s, d):
    p = dates.parse_date(F.col("date_text"))
    return _events(s, d).select("event_id", *[p[c].alias(c) for c in ("kind", "modifier", "date", "precision", "start", "end")])


def date_years(s, d):
    y = dates.lineage_ymd(F.col("date_text"))
    return _events(s, d).select("event_id", y["y"].cast(B).alias("y"), y["m"].cast(B).alias("m"), y["d"].cast(B).alias("d"), y["precision"].cast(B).alias("p"), dates.first_year(F.col("date_text")).cast(B).alias("first_year"))


def ages(s, d):
    o = read_table(s, d, "orders").select("o_orderkey", "o_custkey", F.upper(F.date_format("o_orderdate", "d MMM yyyy")).alias("t"), "o_orderdate")
    first = o.groupBy("o_custkey").agg(F.min_by("t", "o_orderdate").alias("b"))
    a = dates.age_between(dates.parse_date(F.col("b")), dates.parse_date(F.col("t")))
    return o.join(first, "o_custkey").select("o_orderkey", a["years"].cast(B).alias("years"), a["months"].cast(B).alias("months"))


def uuids(s, d):
    c = read_table(s, d, "customer")
    ptr = F.concat(F.lit(" i"), F.col("c_custkey").cast("string"))
    return c.select("c_custkey", identity.uuid_for_pointer(ptr).alias("by_pointer"), identity.uuid_for_name(ptr, F.col("c_name")).alias("by_name"), identity.uuid_for_event(ptr, F.lit("birt"), F.lit(None), F.col("c_mktsegment")).alias("by_event"))


def name_index(s, d):
    r = first_delivery(read_table(s, d, "name_records"), "name_id")
    return naming.name_index(naming.name_identity(r)).drop("first_pointer")


def name_counts(s, d):
    return naming.normalized_counts(first_delivery(read_table(s, d, "name_records"), "name_id"))


def standard_counts(s, d):
    kind = F.when(F.upper(F.trim("tag")) == "MARR", "FAM").otherwise("INDI")
    e = place_registry.standardize(_events(s, d)).withColumns({"owner_type": kind, "owner": identity.normalize_pointer(F.col("owner_pointer"))})
    return place_registry.standardized_counts(e)


def names_by_lists(s, d):
    c = read_table(s, d, "customer")
    v = F.concat(F.when(F.col("c_custkey") % 2 == 0, "Dr. ").otherwise(""), F.lit("Ann Mary /van der "), "c_mktsegment", F.lit("/ Jr."))
    n = names.split_value(v)
    return c.select("c_custkey", *[n[x].alias(x) for x in ("prefix", "given", "middle", "surname_prefix", "surname", "suffix")])


def place_standard(s, d):
    e = _events(s, d)
    return e.select("event_id", places.event_place(F.col("place")).alias("place_text"), places.standard_place(F.col("place"))["id"].alias("place_id"))


def place_parts(s, d):
    p = places.place_parts(F.concat_ws(", ", "c_name", "n_name", F.lit("x"), F.lit(" "), "r_name", F.lit("Earth")))
    return customers(s, d).select("c_custkey", *[p[x].alias(x) for x in ("city", "county", "state", "country")])


def place_counts(s, d):
    kind = F.when(F.upper(F.trim("tag")) == "MARR", "FAM").otherwise("INDI")
    return place_registry.place_registry(_events(s, d).withColumn("owner_type", kind)).select("place_id", "n_events", "n_individual", "n_family")


def place_tree(s, d):
    ids = customers(s, d).select(F.lower(F.concat_ws(", ", "n_name", "r_name", F.lit("earth"))).alias("place_id")).distinct()
    return place_registry.place_hierarchy(ids).select("place_id", "parent_id", F.col("n_levels").cast(B).alias("n_levels"), "generated", "n_children")


def _refs(s, d):
    return place_registry.place_refs(_events(s, d), place_registry.jurisdictions(s))


def place_versions(s, d):
    return place_registry.place_versions(_refs(s, d)).select("place_version_id", "place_id", "js_id", F.col("year").cast(B).alias("year"), "n_refs")


def place_integrity(s, d):
    """Checks of tables into which faults of every kind are put."""
    e, sys = _events(s, d), place_registry.jurisdictions(s)
    refs = _refs(s, d)
    places_ = place_registry.standardize(e).filter("place_id is not null and place_id not like 'm%'").select("place_id").distinct()
    lost = F.when(F.col("place_id").startswith("s"), "lost").otherwise(F.col("js_id"))
    versions = place_registry.place_versions(refs).filter("year is not null").withColumn("js_id", lost)
    bad = refs.withColumns({
        "js_id": F.when(F.col("event_id") % 100 == 0, "other").otherwise(F.col("js_id")), "place_id": F.when(F.col("event_id") % 101 == 0, "nowhere").otherwise(F.col("place_id")),
        "year": F.when(F.col("event_id") % 103 == 0, 10000).otherwise(F.col("year")),
    })
    return place_registry.integrity(e, places_, bad, versions, sys)


def coordinates(s, d):
    a = F.abs(F.floor("s_acctbal")).cast("string")
    side = F.when(F.col("s_suppkey") % 3 == 0, "S").when(F.col("s_suppkey") % 3 == 1, "N").otherwise("")
    t = F.concat(side, a)
    return read_table(s, d, "supplier").select("s_suppkey", places.hemisphere_degrees(t).alias("degrees"), places.prefixed_degrees(t).alias("prefixed"))


def occupations_found(s, d):
    o = read_table(s, d, "occupations_ref")
    dic = o.select(F.explode(F.concat(F.array("label"), F.coalesce("alt_labels", F.array().cast("array<string>")))).alias("variant"), F.col("label").alias("canonical"))
    return occupations.occupations_in(read_table(s, d, "documents").filter("doc_id is not null"), "doc_id", "text", dic)


def xref_links(s, d):
    i, f = read_table(s, d, "individuals"), read_table(s, d, "families")
    both = [xref.resolve_links(i, field, f).select(F.lit(field).alias("field"), "pointer", "ref", "uuid").distinct() for field in ("famc", "fams")]
    return both[0].unionByName(both[1])


def xref_members(s, d):
    m = graph._members(read_table(s, d, "families"))
    return xref.resolve_members(m, read_table(s, d, "individuals")).select("fam", "role", "member", "uuid")


def xref_index(s, d):
    t = {n: read_table(s, d, n) for n in ("individuals", "families", "source_records")}
    return xref.uuid_index(t)


def _claims(s, d):
    e = _events(s, d).filter("owner_pointer is not null")
    return e.select(
        F.concat_ws("|", identity.normalize_pointer(F.col("owner_pointer")), F.upper(F.trim("tag"))).alias("event_key"), F.col("event_id").alias("claim"), "date_text", "place",
        F.coalesce(F.size("sources"), F.lit(0)).alias("n_sources"), F.lit(0).alias("n_notes"),
    )


def event_choice(s, d):
    return claims.choose_claims(_claims(s, d)).select("event_key", "n_claims", F.col("best_score").cast(B).alias("best_score"), "n_best", "ambiguous", "winner")


def _scores(s, d):
    e = _events(s, d).filter("owner_pointer is not null")
    rows = e.select("event_id", identity.normalize_pointer(F.col("owner_pointer")).alias("owner"), F.upper(F.trim("tag")).alias("tag"), "date_text", "place", F.coalesce(F.size("sources"), F.lit(0)).alias("n_sources"), F.col("event_id").alias("ord"))
    return claims.score_events(rows)


def event_points(s, d):
    e = _events(s, d)
    n = F.coalesce(F.size("sources"), F.lit(0))
    cols = {"date_points": ev.date_points(F.col("date_text")), "place_points": ev.place_points(F.col("place")), "field_points": ev.field_points(F.col("date_text"), F.col("place"), n), "evidence": ev.evidence_points(n)}
    return e.select("event_id", *[c.cast(B).alias(k) for k, c in cols.items()])


def event_scores(s, d):
    return _scores(s, d)


def score_summary(s, d):
    return claims.score_summary(_scores(s, d))


def person_scores(s, d):
    return claims.score_summary(_scores(s, d), "owner")


def first_births(s, d):
    e = _events(s, d).select(identity.normalize_pointer(F.col("owner_pointer")).alias("owner"), F.upper(F.trim("tag")).alias("tag"), "event_id", F.col("event_id").alias("ord"))
    return claims.first_birth(e.filter("owner is not null")).select("owner", "tag", "event_id")


GIVEN = ("john", "jon", "johan", "unknown")


def _people(s, d):
    """People with like and unknown names, years and places that are missing, and places
    that were only typed."""
    k = F.col("c_custkey")
    return customers(s, d).select(
        k.alias("person_id"), F.element_at(F.array(*map(F.lit, GIVEN)), (k % 4 + 1).cast("int")).alias("given"), F.lower("c_mktsegment").alias("surname"),
        F.when(k % 17 != 0, (1900 + k % 7).cast("int")).alias("birth_year"), F.when(k % 11 != 0, F.lower("n_name")).alias("place_id"),
        F.when((k % 11 != 0) | (k % 2 == 0), F.col("n_name")).alias("place_raw"), F.when(k % 5 == 0, F.array(F.lit("BIRT"), F.lit("DEAT"))).otherwise(F.array(F.lit("BIRT"))).alias("tags"),
    )


def _family_rows(s, d):
    """The customers of a nation as one family, the first and last as its heads."""
    c, k = read_table(s, d, "customer"), F.col("c_custkey")
    w = W.partitionBy("c_nationkey")
    role = F.when(k == F.min(k).over(w), "HUSB").when(k == F.max(k).over(w), "WIFE").otherwise("CHIL")
    return c.select(F.col("c_nationkey").alias("fam"), role.alias("role"), k.alias("member"))


def er_candidates(s, d):
    return resolution.candidates(_people(s, d)).select("id1", "id2", F.round("score", 6).alias("score"))


def _plan(s, d):
    pairs = resolution.candidates(_people(s, d))
    m = resolution.clusters(pairs)
    return pairs, m, resolution.merge_plan(pairs, m)


def er_clusters(s, d):
    return _plan(s, d)[1]


def er_merge_plan(s, d):
    p = _plan(s, d)[2]
    return p.select("cluster", "n_members", "n_pairs", F.round("min_score", 6).alias("min_score"), F.round("max_score", 6).alias("max_score"), "action")


def er_applied(s, d):
    p = _people(s, d)
    _, m, plan = _plan(s, d)
    return resolution.apply_merges(p, resolution.id_map(p, m, plan)).select("new_id", "n_sources", "first_source", "given", "surname")


def _resolved(s, d):
    names_ = read_table(s, d, "customer").select(F.col("c_custkey").alias("person_id"), F.substring("c_name", 10, 8).alias("name"))
    return resolution.resolve(_people(s, d), _family_rows(s, d), {"names": names_})


def er_summary(s, d):
    return _resolved(s, d)["summary"]


def er_members(s, d):
    return _resolved(s, d)["members"].select("fam", "role", "member")


def er_names(s, d):
    """All names of each person after the merge."""
    return _resolved(s, d)["names"].select("person_id", "name")


def er_blocks(s, d):
    return resolution.block_sizes(_people(s, d)).filter("n > 1").groupBy("n").agg(F.count("*").alias("n_blocks"))


def graph_edges(s, d):
    return graph.edges(*(read_table(s, d, t) for t in ("families", "event_records", "citations"))).select("src", "dst", "kind")


def graph_vertices(s, d):
    return graph.vertices(*(read_table(s, d, t) for t in ("individuals", "families", "event_records", "source_records"))).select("id", "kind")


def kin_components(s, d):
    """Individuals held together by families, and the least of each such group."""
    m = graph._members(read_table(s, d, "families"))
    c = components.connected_components(m.select(F.col("fam").alias("a"), F.col("member").alias("b")))
    return c.groupBy("component").agg(F.count("*").alias("n"))


def media_files(s, d):
    lines = read_table(s, d, "part").select(F.lit("parts").alias("file"), F.col("p_partkey").alias("k"), F.posexplode(F.array(
        F.concat(F.lit("0 @M"), "p_partkey", F.lit("@ OBJE")), F.concat(F.lit("1 FILE scans/"), "p_partkey", F.lit(".JPG")), F.lit("2 FORM jpeg"), F.lit("3 TYPE photo"), F.concat(F.lit("1 TITL "), "p_name"),
    )).alias("at", "raw"))
    nodes = tree.build_nodes(lineage.tokenize(lines.select("file", (F.col("k") * 10 + F.col("at")).alias("lineno"), "raw")))
    return registry.normalize_media(registry.media_files(nodes)).select("pointer", "basename", "extension", "form", "media_type", "title")


QUERIES = {f.__name__: f for f in (
    births_by_place_and_year, tokenize_lines, line_errors, tree_parents, level_jumps, record_tags, folded_notes, lines_round_trip, entity_counts, individuals, person_names,
    family_members, events_extracted, event_roles, date_parse, date_years, ages, uuids, name_index, name_counts, standard_counts, names_by_lists, place_standard, place_parts, place_counts, place_tree,
    place_versions, place_integrity, coordinates, occupations_found, xref_links, xref_members, xref_index, event_choice, event_points, event_scores, score_summary,
    person_scores, first_births, er_candidates, er_clusters, er_merge_plan, er_applied, er_summary, er_members, er_names, er_blocks, graph_edges, graph_vertices, kin_components, media_files,
)}

_C = "(SELECT * FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"
_DATE = "CASE c_custkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'ABT ' WHEN 2 THEN 'MAR ' ELSE (1 + c_custkey % 28) || ' MAR ' END || (1800 + c_custkey % 100)"
_ISO = "CASE c_custkey % 4 WHEN 2 THEN (1800 + c_custkey % 100) || '-03' WHEN 3 THEN (1800 + c_custkey % 100) || '-03-' || lpad(CAST(1 + c_custkey % 28 AS VARCHAR), 2, '0') ELSE CAST(1800 + c_custkey % 100 AS VARCHAR) END"
_FILE = "'nation-' || n_nationkey"
_RAWS = f"""lines AS (SELECT {_FILE} AS file, (c_custkey * 10 + 100) + j AS lineno, CASE WHEN j = 0 THEN 0 WHEN j IN (4, 5, 7, 8) THEN 2 ELSE 1 END AS level,
  ['INDI','NAME','SEX','BIRT','DATE','PLAC','NOTE','CONC','CONT','FAMS'][j + 1] AS tag,
  CASE j WHEN 0 THEN '' WHEN 1 THEN c_mktsegment || ' /' || c_name || '/' WHEN 2 THEN 'M' WHEN 3 THEN '' WHEN 4 THEN {_DATE} WHEN 5 THEN n_name || ',  ' || r_name
    WHEN 6 THEN 'entry ' || c_custkey WHEN 7 THEN ' and more' WHEN 8 THEN 'next line' ELSE '@F' || n_nationkey || '@' END AS value,
  CASE WHEN j = 0 THEN NULL WHEN j IN (4, 5) THEN (c_custkey * 10 + 100) + 3 WHEN j IN (7, 8) THEN (c_custkey * 10 + 100) + 6 ELSE (c_custkey * 10 + 100) END AS parent, (c_custkey * 10 + 100) AS rec, j = 0 AS ptr
  FROM {_C} c, (SELECT unnest(range(10)) AS j) j
 UNION ALL SELECT 'nation-' || n, j + 1, CASE WHEN j = 0 THEN 0 ELSE 1 END, ['FAM','HUSB','WIFE'][j + 1], CASE j WHEN 0 THEN '' WHEN 1 THEN '@I' || h || '@' ELSE '@I' || w || '@' END,
  CASE WHEN j = 0 THEN NULL ELSE 1 END, 1, j = 0 FROM (SELECT c_nationkey AS n, min(c_custkey) AS h, max(c_custkey) AS w FROM customer GROUP BY 1) f, (SELECT unnest(range(3)) AS j) j)"""
_EV = "ev AS (SELECT DISTINCT event_id, owner_pointer, tag, date_text, place, value_text, sources FROM event_records WHERE event_id IS NOT NULL)"
_MON = "(JAN|FEB|MAR|APR|MAY|JUN|JUL|AUG|SEPT?|OCT|NOV|DEC)"
_MNO = "CAST((strpos('JANFEBMARAPRMAYJUNJULAUGSEPOCTNOVDEC', upper({0}[:3])) + 2) / 3 AS INTEGER)"
_SQUEEZE = "trim(regexp_replace({0}, '[\\s\\p{{Z}}]+', ' ', 'g'))"
_SHA = "substr(sha1({0}),1,8) || '-' || substr(sha1({0}),9,4) || '-' || substr(sha1({0}),13,4) || '-' || substr(sha1({0}),17,4) || '-' || substr(sha1({0}),21,12)"
_LEVELS = "list_filter(list_transform(string_split(place, ','), lambda x: trim(x, ' ' || chr(160) || chr(9) || chr(10) || chr(13))), lambda x: x <> '')"
_PID = f"nullif(lower({_SQUEEZE.format('place')}), '')"
_RATIOS = ", ".join(f"({i}, {j}, {0.0 if 'unknown' in (x, y) else difflib.SequenceMatcher(None, x, y).ratio()}::DOUBLE)" for i, x in enumerate(GIVEN) for j, y in enumerate(GIVEN))
_ER = f"""p AS (SELECT c_custkey AS id, c_custkey % 4 AS g, c_custkey % 5 = 0 AS two, c_custkey % 17 <> 0 AS dated,
  CASE WHEN c_custkey % 11 <> 0 THEN lower(n_name) WHEN c_custkey % 2 = 0 THEN regexp_replace(lower(n_name), '[^a-z0-9]+', '', 'g') ELSE 'UNKNOWN' END AS place,
  lower(c_mktsegment) || '|' || CASE WHEN c_custkey % 17 <> 0 THEN CAST(1900 + c_custkey % 7 AS VARCHAR) ELSE 'UNKNOWN' END AS who FROM {_C} c),
r(g1, g2, sim) AS (VALUES {_RATIOS}),
c AS (SELECT a.id AS id1, b.id AS id2, round(0.4::DOUBLE * (0.7::DOUBLE + 0.3::DOUBLE * r.sim) + 0.3::DOUBLE + 0.2::DOUBLE * CASE WHEN a.place = 'UNKNOWN' THEN 0 ELSE 1 END + 0.1::DOUBLE * CASE WHEN a.two = b.two THEN 1 ELSE 0.5::DOUBLE END, 6) AS score
  FROM p a JOIN p b ON a.who = b.who AND a.place = b.place AND a.id < b.id AND a.dated JOIN r ON r.g1 = a.g AND r.g2 = b.g),
cand AS (SELECT * FROM c WHERE score >= 0.75),
both_ways AS (SELECT id1 AS a, id2 AS b FROM cand UNION SELECT id2, id1 FROM cand),
cc(person_id, cluster) USING KEY (person_id) AS (SELECT DISTINCT a, a FROM both_ways
  UNION SELECT e.b, min(cc.cluster) FROM cc JOIN both_ways e ON e.a = cc.person_id JOIN recurring.cc k ON k.person_id = e.b WHERE cc.cluster < k.cluster GROUP BY e.b),
m AS (SELECT person_id, cluster FROM cc),
size AS (SELECT cluster, count(*) AS n_members FROM m GROUP BY 1),
plan AS (SELECT m.cluster, any_value(n_members) AS n_members, count(*) AS n_pairs, CASE WHEN count(*) < any_value(n_members) * (any_value(n_members) - 1) / 2 THEN CAST(0.0 AS DOUBLE) ELSE min(score) END AS min_score, max(score) AS max_score
  FROM cand JOIN m ON m.person_id = cand.id1 JOIN size ON size.cluster = m.cluster GROUP BY m.cluster),
act AS (SELECT *, CASE WHEN min_score >= 0.92 THEN 'auto_merge' WHEN min_score >= 0.8 THEN 'review' ELSE 'no_merge' END AS action FROM plan),
ids AS (SELECT p.id, coalesce(x.cluster, p.id) AS new_id, p.g FROM p LEFT JOIN (SELECT m.* FROM m JOIN act ON act.cluster = m.cluster AND action = 'auto_merge') x ON x.person_id = p.id)"""
_OWN = pointer_sql("owner_pointer")
_NSRC = "coalesce(len(sources), 0)"
_MEM = f"""fam_all AS (SELECT {pointer_sql('pointer')} AS fam, loaded_at, coalesce(deleted, false) AS deleted, members FROM families),
alive AS (SELECT fam, members FROM (SELECT *, row_number() OVER (PARTITION BY fam ORDER BY loaded_at DESC, deleted DESC) AS rn FROM fam_all WHERE fam IS NOT NULL) t WHERE rn = 1 AND NOT deleted),
m0 AS (SELECT fam, unnest(members) AS m FROM alive),
mem AS (SELECT DISTINCT fam, upper(trim(m.role)) AS role, {pointer_sql('m.member')} AS member FROM m0 WHERE {pointer_sql('m.member')} IS NOT NULL)"""
_T = "trim(coalesce(date_text, ''))"
_Y3 = "[0-9]{3,4}"
_ALL = "'JANFEBMARAPRMAYJUNJULAUGSEPOCTNOVDEC'"
_CLEAN = "nullif(trim(regexp_replace({0}, '\\s+', ' ', 'g'), ' '), '')"
_MARKED = r"^(.*?)/([^/]+)/\s*(.*)$"
_GOOD = {
    2: rf"^{_MON}\s+({_Y3})$",
    3: rf"^([0-9]{{1,4}})\s+{_MON}\s+({_Y3})(\s|$)",
}


_PAIRS = """toks AS (SELECT event_id, list_distinct(list_transform(LV, lambda x: lower(x))) AS t FROM ev)""".replace("LV", f"coalesce({_LEVELS}, [])")
_TOL = "'primary' WHEN hybrid < 40 THEN 'low_confidence' ELSE 'alternate'"


def _scores_sql(years: str, points: str) -> str:
    """The scores of events, from the SQL of date_years and event_points."""
    return f"""WITH {_EV}, {_PAIRS}, dy AS ({years}), ep AS ({points}),
e AS (SELECT ev.event_id, {_OWN} AS owner, upper(trim(tag)) AS tag, coalesce(date_text, '') AS dt, coalesce(place, '') AS pl, {_NSRC} AS ns, dy.y, dy.m, dy.p, toks.t FROM ev JOIN dy USING (event_id) JOIN toks USING (event_id) WHERE owner_pointer IS NOT NULL),
prs AS (SELECT a.owner, a.tag, a.dt <> '' OR b.dt <> '' AS dated, a.pl <> '' OR b.pl <> '' AS placed, coalesce(abs(a.y - b.y) = 0 OR (abs(a.y - b.y) = 1 AND a.m IS NOT NULL AND a.m = b.m), false) AS same, coalesce(abs(a.y - b.y) >= 10, false) AS far,
  list_has_any(a.t, b.t) AS near, len(a.t) > 0 AND len(b.t) > 0 AND NOT list_has_any(a.t, b.t) AS apart FROM e a JOIN e b ON a.owner = b.owner AND a.tag = b.tag AND a.event_id < b.event_id),
cx AS (SELECT owner, tag, floor(100 * (0.5::DOUBLE * CASE WHEN count_if(dated) > 0 THEN count_if(dated AND same) / count_if(dated) ELSE 1.0::DOUBLE END + 0.5::DOUBLE * CASE WHEN count_if(placed) > 0 THEN count_if(placed AND near) / count_if(placed) ELSE 1.0::DOUBLE END)) AS agree,
  count_if(dated AND far) + count_if(placed AND apart) AS severe FROM prs GROUP BY owner, tag),
life AS (SELECT owner, arg_max_null(y, event_id) FILTER (tag = 'BIRT' AND dt <> '') AS b, arg_max_null(y, event_id) FILTER (tag = 'DEAT' AND dt <> '') AS d FROM e GROUP BY owner),
z AS (SELECT e.*, CASE WHEN coalesce(b, 0) <> 0 AND coalesce(d, 0) <> 0 AND d < b THEN 10 WHEN coalesce(b, 0) <> 0 AND coalesce(d, 0) <> 0 AND d - b > 120 THEN 20 ELSE 25 END AS life, coalesce(greatest(0, least(100, agree - least(100, 10 * severe))), 100) AS consistency,
  ep.date_points, ep.place_points, ep.field_points, ep.evidence FROM e JOIN ep USING (event_id) LEFT JOIN life USING (owner) LEFT JOIN cx ON cx.owner = e.owner AND cx.tag = e.tag),
h AS (SELECT *, least(100, date_points + place_points + field_points + life) AS completeness FROM z),
k AS (SELECT *, CAST(greatest(0, least(100, round_even(0.4::DOUBLE * completeness + 0.4::DOUBLE * consistency + 0.2::DOUBLE * evidence, 0))) AS INTEGER) AS hybrid FROM h)
SELECT event_id, owner, tag, CAST(completeness AS INTEGER) AS completeness, CAST(consistency AS INTEGER) AS consistency, CAST(evidence AS INTEGER) AS evidence, hybrid, CASE WHEN hybrid >= 70 THEN {_TOL} END AS ranking,
 concat_ws(' ', CASE WHEN dt = '' THEN 'no_date' WHEN p IN (1, 2) THEN 'partial_date' WHEN p = 0 THEN 'unrecognized_date_format' END, CASE WHEN pl = '' THEN 'no_place' WHEN len(t) = 0 THEN 'ambiguous_place' END,
  CASE WHEN ns <= 0 THEN 'no_sources' END, CASE life WHEN 10 THEN 'death_before_birth' WHEN 20 THEN 'unrealistic_lifespan' END, CASE WHEN life < 25 THEN 'conflicts_with_other_events' END) AS flags FROM k"""


def _summary_sql(scores: str, by: str = "") -> str:
    head, tail = (f"{by}, ", f" GROUP BY {by}") if by else ("", "")
    return f"""SELECT {head}count(*) AS n_events, round(avg(hybrid), 6) AS avg_hybrid, min(hybrid) AS min_hybrid, max(hybrid) AS max_hybrid, count_if(hybrid < 40) AS n_low, count_if(contains(flags, 'conflicts')) AS n_conflicts FROM ({scores}) s{tail}"""


def _simple_sql(t: str) -> str:
    u = f"upper({t})"
    return (
        f"CASE WHEN regexp_full_match({t}, '{_Y3}') THEN lpad({t}, 4, '0')"
        f" WHEN regexp_matches({u}, '{_GOOD[2]}') THEN lpad(regexp_extract({u}, '{_GOOD[2]}', 2), 4, '0') || '-' || lpad(CAST({_MNO.format(u)} AS VARCHAR), 2, '0')"
        f" WHEN regexp_matches({u}, '{_GOOD[3]}') THEN lpad(regexp_extract({u}, '{_GOOD[3]}', 3), 4, '0') || '-' || lpad(CAST({_MNO.format(f'regexp_extract({u}, {chr(39)}{_GOOD[3]}{chr(39)}, 2)')} AS VARCHAR), 2, '0') || '-' || lpad(regexp_extract({u}, '{_GOOD[3]}', 1), 2, '0') END"
    )


ORACLES = {
    "births_by_place_and_year": f"SELECT lower(n_name || ', ' || r_name) AS place_id, CAST(1800 + c_custkey % 100 AS INTEGER) AS birth_year, count(*) AS n_births FROM {_C} c GROUP BY 1, 2",
    "tokenize_lines": f"WITH {_RAWS} SELECT CAST(level AS BIGINT) AS level, tag, count(*) AS n, count_if(ptr) AS n_pointers, CAST(sum(length(value)) AS BIGINT) AS n_chars FROM lines GROUP BY 1, 2",
    "line_errors": "SELECT code, count(*) AS n FROM nation, (VALUES ('bad_level'), ('level_only'), ('level_only'), ('pointer_without_tag'), ('pointer_without_tag')) v(code) GROUP BY 1",
    "tree_parents": f"WITH {_RAWS} SELECT file, lineno, rec AS record_lineno, parent AS parent_lineno FROM lines",
    "level_jumps": f"SELECT {_FILE} AS file, (c_custkey * 10 + 100) + 4 AS lineno FROM {_C} c WHERE ((c_custkey * 10 + 100) + 4) % 500 = 4",
    "record_tags": "SELECT 'INDI' AS tag, count(*) AS n_indi FROM customer UNION ALL SELECT 'FAM', NULL",
    "folded_notes": f"SELECT {_FILE} AS file, (c_custkey * 10 + 100) + 6 AS lineno, 'entry ' || c_custkey || ' and more' || chr(10) || 'next line' AS value FROM {_C} c",
    "lines_round_trip": f"SELECT {_FILE} AS file, (c_custkey * 10 + 100) + 6 AS lineno, 'entry ' || c_custkey || ' and more' || chr(10) || 'next line' AS value FROM {_C} c",
    "entity_counts": "SELECT 'individuals' AS entity, count(*) AS n FROM customer UNION ALL SELECT 'families', count(DISTINCT c_nationkey) FROM customer",
    "individuals": f"SELECT '@I' || c_custkey || '@' AS pointer, {_SHA.format(chr(39) + 'PTR|@I' + chr(39) + ' || c_custkey || ' + chr(39) + '@' + chr(39))} AS uuid, CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender, '@F' || c_nationkey || '@' AS fams, 'entry ' || c_custkey || ' and more' || chr(10) || 'next line' AS note FROM customer",
    "person_names": "SELECT '@I' || c_custkey || '@' AS pointer, c_mktsegment || ' /' || c_name || '/' AS \"full\", c_mktsegment AS given, c_name AS surname, lower(regexp_replace(c_mktsegment || ' ' || c_name, '[^0-9A-Za-z .-]', '', 'g')) AS normalized FROM customer",
    "family_members": "SELECT '@F' || c_nationkey || '@' AS family, r AS role, '@I' || CASE WHEN r = 'HUSB' THEN min(c_custkey) ELSE max(c_custkey) END || '@' AS member FROM customer, (VALUES ('HUSB'), ('WIFE')) v(r) GROUP BY c_nationkey, r",
    "events_extracted": f"SELECT '@I' || c_custkey || '@' AS owner, 'BIRT' AS tag, 'Birth' AS type, n_name || ', ' || r_name AS place, {_ISO} AS date, CASE WHEN c_custkey % 4 = 1 THEN 'approximate' ELSE 'exact' END AS kind, CASE c_custkey % 4 WHEN 2 THEN 'month' WHEN 3 THEN 'day' ELSE 'year' END AS date_precision FROM {_C} c",
    "event_roles": "SELECT '@F' || c_nationkey || '@' AS owner, r AS tag, '@I' || CASE WHEN r = 'HUSB' THEN min(c_custkey) ELSE max(c_custkey) END || '@' AS value, CASE WHEN r = 'HUSB' THEN 'Husband' ELSE 'Wife' END AS label FROM customer, (VALUES ('HUSB'), ('WIFE')) v(r) GROUP BY c_nationkey, r",
    "date_parse": rf"""WITH {_EV}, t AS (SELECT event_id, {_T} AS t FROM ev), h AS (SELECT event_id, t, lower(regexp_extract(t, '^(\S+)', 1)) AS head, trim(regexp_extract(t, '^\S+\s*(.*)$', 1)) AS rest FROM t),
q AS (SELECT *, CASE WHEN head IN ('abt', 'abt.', 'circa') THEN 'ABT' WHEN head = 'bef' THEN 'BEF' WHEN head = 'aft' THEN 'AFT' WHEN head = 'bet' THEN 'BET' END AS code FROM h),
b AS (SELECT *, code = 'BET' AND regexp_matches(rest, '(?i)\sand\s') AS is_range, replace(CASE WHEN code IS NULL THEN t ELSE rest END, ',', ' ') AS body FROM q),
s AS (SELECT *, {_simple_sql('body')} AS iso, trim(regexp_extract(rest, '(?i)^(.*?)\sand\s', 1)) AS l, trim(regexp_extract(rest, '(?i)\sand\s(.*)$', 1)) AS r FROM b)
SELECT event_id, CASE WHEN is_range THEN 'range' WHEN code = 'ABT' THEN 'approximate' WHEN code = 'BEF' THEN 'before' WHEN code = 'AFT' THEN 'after' WHEN iso IS NULL THEN 'unknown' ELSE 'exact' END AS kind,
 code AS modifier, CASE WHEN NOT coalesce(is_range, false) THEN iso END AS date, CASE WHEN coalesce(is_range, false) OR iso IS NULL THEN NULL WHEN length(iso) = 4 THEN 'year' WHEN length(iso) = 7 THEN 'month' ELSE 'day' END AS precision,
 CASE WHEN is_range THEN {_simple_sql('l')} END AS start, CASE WHEN is_range THEN {_simple_sql('r')} END AS "end" FROM s""",
    "date_years": rf"""WITH {_EV}, t AS (SELECT event_id, date_text, {_T} AS t FROM ev),
n AS (SELECT *, CASE WHEN regexp_full_match(t, '\d+') THEN 1 WHEN regexp_full_match(t, '\S+\s+\d+') AND strpos({_ALL}, upper(t[:3])) % 3 = 1 THEN 2
  WHEN regexp_full_match(t, '\d+\s+\S+\s+\d+') AND strpos({_ALL}, upper(regexp_extract(t, '\s(\S+)', 1)[:3])) % 3 = 1 THEN 3 ELSE 0 END AS p FROM t)
SELECT event_id, CAST(p AS BIGINT) AS p, CASE WHEN p > 0 THEN CAST(regexp_extract(t, '(\d+)$', 1) AS BIGINT) END AS y,
 CASE p WHEN 2 THEN (strpos({_ALL}, upper(t[:3])) + 2) // 3 WHEN 3 THEN (strpos({_ALL}, upper(regexp_extract(t, '\s(\S+)', 1)[:3])) + 2) // 3 END AS m,
 CASE WHEN p = 3 THEN CAST(regexp_extract(t, '^(\d+)', 1) AS BIGINT) END AS d,
 try_cast(nullif(regexp_extract(date_text, '(^|[^0-9])([0-9]{{4}})([^0-9]|$)', 2), '') AS BIGINT) AS first_year FROM n""",
    "name_index": rf"""WITH c AS (SELECT DISTINCT name_id, {pointer_sql('pointer')} AS pointer, {_CLEAN.format('full_name')} AS f, {_CLEAN.format('given')} AS g, {_CLEAN.format('surname')} AS s, {_CLEAN.format('suffix')} AS x FROM name_records WHERE name_id IS NOT NULL),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY pointer ORDER BY f IS NULL, name_id) AS rn FROM c) t WHERE rn = 1),
m AS (SELECT *, coalesce(f, '') AS base, regexp_matches(coalesce(f, ''), '/[^/]+/') AS marked FROM b),
k AS (SELECT pointer, concat_ws(' ', coalesce(g, CASE WHEN marked THEN regexp_extract(base, '{_MARKED}', 1) ELSE base END), coalesce(s, CASE WHEN marked THEN regexp_extract(base, '{_MARKED}', 2) END), coalesce(x, CASE WHEN marked THEN regexp_extract(base, '{_MARKED}', 3) END)) AS pretty FROM m)
SELECT lower({_CLEAN.format(r"regexp_replace(pretty, '[^0-9A-Za-z\s.''’-]', '', 'g')")}) AS normalized, count(*) AS occurrences FROM k WHERE pointer IS NOT NULL GROUP BY 1 HAVING normalized IS NOT NULL""",
    "standard_counts": f"""WITH {_EV} SELECT count(DISTINCT CASE WHEN upper(trim(tag)) <> 'MARR' THEN {_OWN} END) AS n_individuals, count(DISTINCT CASE WHEN upper(trim(tag)) = 'MARR' THEN {_OWN} END) AS n_families, count(*) AS n_events, count({_PID}) AS n_with_places FROM ev""",
    "name_counts": rf"""WITH c AS (SELECT DISTINCT name_id, {pointer_sql('pointer')} AS pointer, {_CLEAN.format('full_name')} AS f, {_CLEAN.format('given')} AS g, {_CLEAN.format('surname')} AS s, {_CLEAN.format('suffix')} AS x FROM name_records WHERE name_id IS NOT NULL),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY pointer ORDER BY f IS NULL, name_id) AS rn FROM c) t WHERE rn = 1),
m AS (SELECT *, coalesce(f, '') AS base, regexp_matches(coalesce(f, ''), '/[^/]+/') AS marked FROM b),
k AS (SELECT pointer, split_part(coalesce(g, {_CLEAN.format(f"CASE WHEN marked THEN regexp_extract(base, '{_MARKED}', 1) ELSE base END")}), ' ', 1) AS pg, coalesce(s, {_CLEAN.format(f"CASE WHEN marked THEN regexp_extract(base, '{_MARKED}', 2) END")}) AS ps, coalesce(x, {_CLEAN.format(f"CASE WHEN marked THEN regexp_extract(base, '{_MARKED}', 3) END")}) AS px,
  concat_ws(' ', coalesce(g, CASE WHEN marked THEN regexp_extract(base, '{_MARKED}', 1) ELSE base END), coalesce(s, CASE WHEN marked THEN regexp_extract(base, '{_MARKED}', 2) END), coalesce(x, CASE WHEN marked THEN regexp_extract(base, '{_MARKED}', 3) END)) AS pretty FROM m)
SELECT count(DISTINCT c.pointer) AS n_people, count(*) AS n_names, count_if(c.g IS NULL AND pg <> '') AS n_filled_given, count_if(c.s IS NULL AND ps IS NOT NULL) AS n_filled_surname, count_if(c.x IS NULL AND px IS NOT NULL) AS n_filled_suffix,
 count(DISTINCT CASE WHEN {_CLEAN.format(r"regexp_replace(pretty, '[^0-9A-Za-z\s.''’-]', '', 'g')")} IS NOT NULL THEN c.pointer END) AS n_normalized FROM c JOIN k ON k.pointer = c.pointer""",
    "ages": "SELECT o_orderkey, CAST(date_part('year', age(o_orderdate, b)) AS BIGINT) AS years, CAST(date_part('month', age(o_orderdate, b)) AS BIGINT) AS months FROM orders JOIN (SELECT o_custkey, min(o_orderdate) AS b FROM orders GROUP BY 1) f USING (o_custkey)",
    "uuids": f"""SELECT c_custkey, {_SHA.format("'PTR|@I' || c_custkey || '@'")} AS by_pointer, {_SHA.format("'NAME| i' || c_custkey || '|' || c_name")} AS by_name, {_SHA.format("'EVT| i' || c_custkey || '|BIRT||' || c_mktsegment")} AS by_event FROM customer""",
    "names_by_lists": "SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'Dr.' END AS prefix, 'Ann' AS given, 'Mary' AS middle, 'van der' AS surname_prefix, c_mktsegment AS surname, 'Jr.' AS suffix FROM customer",
    "place_standard": f"WITH {_EV} SELECT event_id, nullif(trim(regexp_replace({_SQUEEZE.format('place')}, '\\s*,\\s*', ', ', 'g')), '') AS place_text, {_PID} AS place_id FROM ev",
    "place_parts": f"SELECT c_custkey, c_name AS city, n_name AS county, 'x' AS state, 'Earth' AS country FROM {_C} c",
    "place_counts": f"WITH {_EV} SELECT {_PID} AS place_id, count(*) AS n_events, count_if(upper(trim(tag)) <> 'MARR') AS n_individual, count_if(upper(trim(tag)) = 'MARR') AS n_family FROM ev WHERE {_PID} IS NOT NULL GROUP BY 1",
    "place_tree": f"""WITH c AS (SELECT DISTINCT lower(n_name) AS n, lower(r_name) AS r FROM {_C} c)
SELECT n || ', ' || r || ', earth' AS place_id, r || ', earth' AS parent_id, CAST(3 AS BIGINT) AS n_levels, false AS generated, 0 AS n_children FROM c
UNION ALL SELECT r || ', earth', 'earth', 2, true, count(*) FROM c GROUP BY r UNION ALL SELECT 'earth', NULL, 1, true, count(DISTINCT r) FROM c""",
    "place_versions": f"""WITH {_EV}, y AS (SELECT {_PID} AS place_id, coalesce(try_cast(nullif(regexp_extract(date_text, '(^|[^0-9])([0-9]{{4}})([^0-9]|$)', 2), '') AS BIGINT), try_cast(nullif(regexp_extract(value_text, '(^|[^0-9])([0-9]{{4}})([^0-9]|$)', 2), '') AS BIGINT)) AS year FROM ev WHERE {_PID} IS NOT NULL)
SELECT 'pv_' || substr(sha1(place_id || '|default|' || coalesce(CAST(year AS VARCHAR), '..')), 1, 20) AS place_version_id, place_id, 'default' AS js_id, year, count(*) AS n_refs FROM y GROUP BY place_id, year""",
    "place_integrity": f"""WITH {_EV}, y AS (SELECT event_id, {_PID} AS place_id, coalesce(try_cast(nullif(regexp_extract(date_text, '(^|[^0-9])([0-9]{{4}})([^0-9]|$)', 2), '') AS BIGINT), try_cast(nullif(regexp_extract(value_text, '(^|[^0-9])([0-9]{{4}})([^0-9]|$)', 2), '') AS BIGINT)) AS year FROM ev WHERE {_PID} IS NOT NULL),
v AS (SELECT DISTINCT place_id, year FROM y WHERE year IS NOT NULL)
SELECT 'event_place' AS rule, (SELECT count(*) FROM y WHERE place_id LIKE 'm%') AS n_bad UNION ALL SELECT 'version_place', (SELECT count(*) FROM v WHERE place_id LIKE 'm%')
UNION ALL SELECT 'version_system', (SELECT count(*) FROM v WHERE place_id LIKE 's%') UNION ALL SELECT 'ref_version', (SELECT count(*) FROM y WHERE year IS NULL)
UNION ALL SELECT 'ref_system', (SELECT count(*) FROM y WHERE event_id % 100 = 0) UNION ALL SELECT 'ref_same_place', (SELECT count(*) FROM y WHERE event_id % 101 = 0)
UNION ALL SELECT 'ref_year', (SELECT count(*) FROM y WHERE event_id % 103 = 0 OR year < 1)""",
    "coordinates": "SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN -abs(floor(s_acctbal)) ELSE abs(floor(s_acctbal)) END AS degrees, CASE WHEN s_suppkey % 3 = 0 THEN -abs(floor(s_acctbal)) ELSE abs(floor(s_acctbal)) END AS prefixed FROM supplier",
    "occupations_found": """WITH v AS (SELECT unnest(list_prepend(label, coalesce(alt_labels, []))) AS variant, label AS canonical FROM occupations_ref),
n AS (SELECT trim(regexp_replace(lower(variant), '[^a-z0-9]+', ' ', 'g')) AS variant, canonical FROM v), t AS (SELECT doc_id, ' ' || trim(regexp_replace(lower(coalesce(text, '')), '[^a-z0-9]+', ' ', 'g')) || ' ' AS t FROM documents WHERE doc_id IS NOT NULL)
SELECT DISTINCT doc_id, canonical FROM t JOIN n ON contains(t, ' ' || variant || ' ')""",
    "xref_links": f"""WITH r AS (SELECT 'famc' AS field, {pointer_sql('pointer')} AS pointer, unnest(famc) AS raw FROM individuals UNION ALL SELECT 'fams', {pointer_sql('pointer')}, unnest(fams) FROM individuals),
x AS (SELECT DISTINCT field, pointer, {pointer_sql('raw')} AS ref FROM r WHERE {pointer_sql('raw')} IS NOT NULL),
k AS (SELECT DISTINCT {pointer_sql('pointer')} AS ref FROM families) SELECT x.field, x.pointer, x.ref, CASE WHEN k.ref IS NOT NULL THEN {_SHA.format("'PTR|' || x.ref")} END AS uuid FROM x LEFT JOIN k ON k.ref = x.ref""",
    "xref_members": f"""WITH {_MEM}, k AS (SELECT DISTINCT {pointer_sql('pointer')} AS member FROM individuals)
SELECT fam, role, mem.member, CASE WHEN k.member IS NOT NULL THEN {_SHA.format("'PTR|' || mem.member")} END AS uuid FROM mem LEFT JOIN k ON k.member = mem.member""",
    "xref_index": f"""WITH a AS (SELECT 'individuals' AS rec_type, {pointer_sql('pointer')} AS pointer, uuid FROM individuals UNION ALL SELECT 'families', {pointer_sql('pointer')}, uuid FROM families UNION ALL SELECT 'source_records', {pointer_sql('pointer')}, NULL FROM source_records)
SELECT rec_type, pointer, min(coalesce(nullif(uuid, ''), {_SHA.format("'PTR|' || pointer")})) AS uuid FROM a WHERE pointer IS NOT NULL GROUP BY 1, 2""",
    "event_choice": f"""WITH {_EV}, c AS (SELECT {_OWN} || '|' || upper(trim(tag)) AS event_key, event_id,
 CASE WHEN {_T} <> '' THEN 50 - 10 * CAST(regexp_matches(upper(date_text), 'ABT|BEF|AFT|EST|CALC') AS INTEGER) + 5 * CAST(regexp_matches({_T}, '[ /-]') AS INTEGER) ELSE 0 END
 + CASE WHEN coalesce(len({_LEVELS}), 0) > 0 THEN 30 + 5 * CAST(len({_LEVELS}) >= 2 AS INTEGER) ELSE 0 END + 5 * CAST({_NSRC} >= 1 AS INTEGER) + 5 * CAST({_NSRC} >= 3 AS INTEGER) AS score FROM ev WHERE owner_pointer IS NOT NULL),
b AS (SELECT *, max(score) OVER (PARTITION BY event_key) AS best FROM c)
SELECT event_key, count(*) AS n_claims, CAST(max(best) AS BIGINT) AS best_score, count_if(score = best) AS n_best, count_if(score = best) > 1 AS ambiguous, CASE WHEN count_if(score = best) = 1 THEN min(event_id) FILTER (WHERE score = best) END AS winner FROM b GROUP BY event_key""",
    "event_points": rf"""WITH {_EV} SELECT event_id, CAST(CASE WHEN coalesce(date_text, '') = '' THEN 0 WHEN regexp_full_match(trim(date_text), '\d+') THEN 10
 WHEN regexp_full_match(upper(trim(date_text)), '{_MON[:-1]}|[A-Z]*)\s+\d+') AND strpos('JANFEBMARAPRMAYJUNJULAUGSEPOCTNOVDEC', upper(trim(date_text)[:3])) % 3 = 1 THEN 18
 WHEN regexp_full_match(upper(trim(date_text)), '\d+\s+[A-Z]+\s+\d+') AND strpos('JANFEBMARAPRMAYJUNJULAUGSEPOCTNOVDEC', regexp_extract(upper(date_text), '\d+\s+([A-Z]+)', 1)[:3]) % 3 = 1 THEN 25 ELSE 5 END AS BIGINT) AS date_points,
 CAST(CASE WHEN coalesce(place, '') = '' THEN 0 WHEN len({_LEVELS}) >= 4 THEN 25 WHEN len({_LEVELS}) = 3 THEN 20 WHEN len({_LEVELS}) = 2 THEN 15 WHEN len({_LEVELS}) = 1 THEN 10 ELSE 5 END AS BIGINT) AS place_points,
 CAST(least(25, 8 * CAST(coalesce(date_text, '') <> '' AS INTEGER) + 8 * CAST(coalesce(place, '') <> '' AS INTEGER) + 5 * CAST({_NSRC} > 0 AS INTEGER)) AS BIGINT) AS field_points,
 CAST(CASE WHEN {_NSRC} <= 0 THEN 10 WHEN {_NSRC} = 1 THEN 40 WHEN {_NSRC} = 2 THEN 60 ELSE 100 END AS BIGINT) AS evidence FROM ev""",
    "first_births": f"WITH {_EV}, e AS (SELECT {_OWN} AS owner, upper(trim(tag)) AS tag, event_id FROM ev) SELECT owner, tag, event_id FROM (SELECT *, row_number() OVER (PARTITION BY owner ORDER BY tag <> 'BIRT', event_id) AS rn FROM e WHERE tag IN ('BIRT', 'CHR', 'BAPM') AND owner IS NOT NULL) t WHERE rn = 1",
    "er_candidates": f"WITH RECURSIVE {_ER} SELECT id1, id2, score FROM cand",
    "er_merge_plan": f"WITH RECURSIVE {_ER} SELECT cluster, n_members, n_pairs, min_score, max_score, action FROM act",
    "er_clusters": f"WITH RECURSIVE {_ER} SELECT person_id, cluster FROM m",
    "er_applied": f"WITH RECURSIVE {_ER} SELECT new_id, count(*) AS n_sources, min(ids.id) AS first_source, (['john', 'jon', 'johan', 'unknown'])[arg_min(g, ids.id) + 1] AS given, lower(arg_min(c_mktsegment, ids.id)) AS surname FROM ids JOIN customer ON c_custkey = ids.id GROUP BY new_id",
    "er_summary": f"WITH RECURSIVE {_ER} SELECT (SELECT count(*) FROM ids) AS n_in, (SELECT count(DISTINCT new_id) FROM ids) AS n_out, count(*) AS n_clusters, count_if(action = 'auto_merge') AS n_auto_merge, count_if(action = 'review') AS n_review, count_if(action = 'no_merge') AS n_no_merge FROM act",
    "er_members": f"""WITH RECURSIVE {_ER}, f AS (SELECT c_nationkey AS fam, CASE WHEN c_custkey = min(c_custkey) OVER w THEN 'HUSB' WHEN c_custkey = max(c_custkey) OVER w THEN 'WIFE' ELSE 'CHIL' END AS role, c_custkey AS k FROM customer WINDOW w AS (PARTITION BY c_nationkey))
SELECT DISTINCT fam, role, new_id AS member FROM f JOIN ids ON ids.id = f.k""",
    "er_names": f"WITH RECURSIVE {_ER} SELECT DISTINCT new_id AS person_id, substr(c_name, 10, 8) AS name FROM ids JOIN customer ON c_custkey = ids.id",
    "er_blocks": f"WITH RECURSIVE {_ER} SELECT n, count(*) AS n_blocks FROM (SELECT count(*) AS n FROM p GROUP BY who, place HAVING count(*) > 1) t GROUP BY n",
    "graph_edges": f"""WITH {_MEM}, e AS (SELECT DISTINCT event_id, {_OWN} AS owner, {_PID} AS place FROM event_records WHERE event_id IS NOT NULL),
x AS (SELECT k.member AS src, s.member AS dst, 'PARENT' AS kind FROM mem k JOIN mem s ON s.fam = k.fam AND s.role IN ('HUSB', 'WIFE') WHERE k.role = 'CHIL'
 UNION SELECT h.member, w.member, 'SPOUSE' FROM mem h JOIN mem w ON w.fam = h.fam WHERE h.role = 'HUSB' AND w.role = 'WIFE'
 UNION SELECT 'E' || event_id, owner, 'EVENT_OF' FROM e WHERE owner IS NOT NULL UNION SELECT place, 'E' || event_id, 'PLACE_OF' FROM e WHERE place IS NOT NULL
 UNION SELECT {pointer_sql('source_xref')}, {_OWN}, 'SOURCE_OF' FROM citations WHERE {pointer_sql('source_xref')} IS NOT NULL AND {_OWN} IS NOT NULL)
SELECT src, dst, kind FROM x""",
    "graph_vertices": f"""WITH x AS (SELECT {pointer_sql('pointer')} AS id, 'INDI' AS kind FROM individuals UNION SELECT {pointer_sql('pointer')}, 'FAM' FROM families UNION SELECT {pointer_sql('pointer')}, 'SOURCE' FROM source_records
 UNION SELECT 'E' || event_id, 'EVENT' FROM event_records UNION SELECT {_PID}, 'PLACE' FROM event_records) SELECT id, kind FROM x WHERE id IS NOT NULL""",
    "media_files": "SELECT '@M' || p_partkey || '@' AS pointer, p_partkey || '.JPG' AS basename, 'jpg' AS extension, 'jpeg' AS form, 'photo' AS media_type, p_name AS title FROM part",
}

ORACLES["event_scores"] = _scores_sql(ORACLES["date_years"], ORACLES["event_points"])
ORACLES["score_summary"] = _summary_sql(ORACLES["event_scores"])
ORACLES["person_scores"] = _summary_sql(ORACLES["event_scores"], "owner")
ORACLES["kin_components"] = f"""WITH RECURSIVE {_MEM}, link AS (SELECT fam AS a, member AS b FROM mem WHERE fam <> member UNION SELECT member, fam FROM mem WHERE fam <> member),
cc(node, c) USING KEY (node) AS (SELECT DISTINCT a, a FROM link
  UNION SELECT e.b, min(cc.c) FROM cc JOIN link e ON e.a = cc.node JOIN recurring.cc k ON k.node = e.b WHERE cc.c < k.c GROUP BY e.b)
SELECT c AS component, count(*) AS n FROM cc GROUP BY c"""
