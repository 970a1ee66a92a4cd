"""Queries over records that hold every kind of line, made from the star-schema
tables, with the SQL that answers them from the same tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinspark.functions import identity, names, occupations, places
from kinspark.operators import claims, place_registry, registry, tree
from kinspark.plans.synth import people
from kinspark.session import durable, read_table
from kinspark.sources import export, lineage

B = "bigint"
OCCUPATIONS = [("farmer", "farmer"), ("farm hand", "farmer"), ("baker", "baker"), ("miller", "miller"), ("clerk", "clerk")]


def record_lines(s: SparkSession, d: str) -> DataFrame:
    """32 lines per customer, and per nation a source, a note and a repository."""
    p, k = people(s, d), F.col("c_custkey")
    t = lambda *parts: F.concat(*[F.lit(x) if isinstance(x, str) else x.cast("string") for x in parts])
    born = t("2 DATE 1 JAN ", 1800 + k % 50)
    place = t("2 PLAC ", F.col("n_name"), ", ", F.col("r_name"))
    person = [
        t("0 @I", k, "@ INDI"), t("1 NAME Dr. Ann /van ", F.col("c_mktsegment"), "/ Jr."), t("2 GIVN Ann Mary"), t("2 SURN ", F.col("c_mktsegment")), t("2 NICK Nan"),
        t("1 BIRT"), born, place, t("3 MAP"), t("4 LATI N", k % 90, ".5"), t("4 LONG W", k % 180, ".25"), t("2 SOUR @S", F.col("n_nationkey"), "@"), t("2 NOTE seen"),
        t("2 OBJE"), t("3 FILE pics/", k, ".png"), t("3 TITL cradle"), t("3 _PRIM Y"),
        t("1 DEAT"), t("2 DATE 1 JAN ", 1850 + k % 50 + k % 3), t("2 CAUS fever"), t("2 QUAY ", k % 5),
        t("1 EVEN spoke"), t("2 TYPE Meeting"), t("1 OCCU Farmer"),
        t("1 BIRT"), F.when(k % 2 == 1, "2 DATE ABT 1801").otherwise(born), place,
        t("1 OBJE @M", k, "@"), t("1 OBJE"), t("2 FORM png"), t("1 _MILT yes"),
        t("1 NOTE He worked as a ", F.when(k % 2 == 0, "baker").otherwise("miller"), ". Occupation: clerk"),
    ]
    n, name = F.col("n_nationkey"), F.col("n_name")
    shelf = [
        t("0 @S", n, "@ SOUR"), t("1 TITL ", name), t("1 AUTH ", F.col("r_name")), t("1 PUBL none"), t("1 PUBL ", name, " press"), t("1 REPO @R", n, "@"), t("1 NOTE kept"), t("1 _APID ", n),
        t("0 @N", n, "@ NOTE text ", n), t("1 CONC  more"), t("1 CONT end"), t("1 _COLOR red"), t("0 @R", n, "@ REPO"), t("1 NAME Archive ", n), t("1 ADDR Street ", n), t("1 NOTE see @O", n + 1, "@"),
    ]
    a = p.select(F.lit("people").alias("file"), k.alias("k"), F.posexplode(F.array(*person)).alias("at", "raw")).select("file", (F.col("k") * 100 + F.col("at")).alias("lineno"), "raw")
    nations = p.select("n_nationkey", "n_name", "r_name").distinct()
    b = nations.select(F.lit("shelf").alias("file"), n.alias("k"), F.posexplode(F.array(*shelf)).alias("at", "raw")).select("file", (F.col("k") * 20 + F.col("at") + 1).cast(B).alias("lineno"), "raw")
    return a.unionByName(b)


def _tokens(s, d):
    return lineage.tokenize(record_lines(s, d))


def _nodes(s, d):
    return durable(tree.fold_text(tree.build_nodes(_tokens(s, d))))


def rec_events(s, d):
    e = registry.events(_nodes(s, d))
    return e.select(
        "owner", "lineno", "tag", "subtype", "description", "cause", F.col("certainty").cast(B).alias("certainty"), "latitude", "longitude",
        F.array_join("notes", "|").alias("notes"), F.array_join("sources", "|").alias("sources"), F.col("age")["years"].cast(B).alias("age"),
    )


def rec_sources(s, d):
    x = registry.sources(_nodes(s, d))
    return x.select("pointer", "title", "author", "publication", "repository", F.array_join("notes", "|").alias("notes"))


def rec_notes(s, d):
    return registry.notes(_nodes(s, d)).select("pointer", "text")


def rec_flat_notes(s, d):
    return tree.fold_flat(_tokens(s, d)).filter("tag = 'NOTE' and level = 0").select("pointer", "value")


def rec_repositories(s, d):
    return registry.repositories(_nodes(s, d)).select("pointer", "name", "address")


def rec_attributes(s, d):
    return registry.attributes(_nodes(s, d)).select("entity", "pointer", "tag", "value")


def rec_attachments(s, d):
    return registry.attachments(_nodes(s, d)).select("owner", "lineno", "context", "kind", "target", "path", "form", "title", "is_primary", "media_object_id")


def rec_claims(s, d):
    e = registry.events(_nodes(s, d)).filter("tag = 'BIRT'")
    return registry.event_claims(e).select("owner", "lineno", F.col("claim").cast(B).alias("claim"), "n_claims", "ambiguous")


def rec_names(s, d):
    n = _nodes(s, d)
    under = n.filter("level = 2").groupBy("file", F.col("parent_lineno").alias("lineno")).agg(*[F.max(F.when(F.upper("tag") == t, F.col("value"))).alias(t) for t in ("NPFX", "GIVN", "SPFX", "SURN", "NSFX")])
    x = registry.names(n).join(under, ["file", "lineno"], "left")
    m = names.merge_tags(F.col("full"), *[F.col(t) for t in ("NPFX", "GIVN", "SPFX", "SURN", "NSFX")])
    v = names.match_view(F.col("given"), F.col("surname"), F.col("full"))
    bare = names.match_view(F.lit(None).cast("string"), F.lit(None).cast("string"), F.concat(F.lit("Nil (Ni) /"), "surname", F.lit("/")))
    return x.select("pointer", "nickname", *[m[c].alias(c) for c in ("prefix", "given", "middle", "surname_prefix", "surname", "suffix")], m["full"].alias("full_name"), v["given_norm"].alias("given_norm"), v["surname_norm"].alias("surname_norm"), bare["given_norm"].alias("bare_given"), bare["surname_norm"].alias("bare_surname"))


def rec_births(s, d):
    """The births of one record, found by its pointer."""
    n = _nodes(s, d)
    return tree.children(n, tree.find_by_pointer(n, "@I7@"), "birt").select("file", "lineno", "tag")


def rec_minted(s, d):
    x = registry.minted_xrefs(registry.used_xrefs(_nodes(s, d)), 40)
    return x.select(F.col("ord").cast(B).alias("ord"), "xref")


def rec_occupations(s, d):
    n = _nodes(s, d)
    dic = s.createDataFrame(OCCUPATIONS, "variant string, canonical string")
    own = registry.attributes(n).filter("tag = 'OCCU'").select("pointer", F.col("value").alias("text"))
    notes = registry.individuals(n).select("pointer", F.explode("notes").alias("text"))
    found = occupations.inferred_occupations(own, notes, "pointer", dic)
    said = notes.groupBy("pointer").agg(F.min(F.array_join(occupations.note_terms(F.col("text")), "|")).alias("said"))
    return found.join(said, "pointer").select("pointer", *[F.array_join(c, "|").alias(c) for c in ("explicit", "inferred", "all_found")], "said")


def rec_terms(s, d):
    x = F.concat_ws(", ", F.lit("Zoo Keeper"), "c_mktsegment", F.lit(" farmer"), F.lit(""), F.lit("FARMER"))
    return read_table(s, d, "customer").select("c_custkey", F.array_join(occupations.split_terms(x), "|").alias("terms"))


def rec_uuids(s, d):
    c = read_table(s, d, "customer")
    k, ptr = F.col("c_custkey"), F.concat(F.lit("@I"), "c_custkey", F.lit("@"))
    kids = F.array(F.lit('NAME:"Zoë"'), F.concat(F.lit("SEX:"), "c_mktsegment"))
    return c.select(
        "c_custkey", identity.deterministic_uuid(F.lit("A"), k, F.lit(None)).alias("of_parts"), identity.uuid_for_occupation(ptr, F.col("c_mktsegment")).alias("of_occupation"),
        identity.uuid_for_record(F.lit("INDI"), F.lit(None).cast("string"), ptr, k, kids).alias("of_record"),
    )


def rec_places(s, d):
    k = F.col("c_custkey")
    raw = F.concat_ws(", ", "c_name", "n_name", "r_name", F.when(k % 2 == 0, F.lit("Earth")))
    p = places.place_block(raw, F.concat(F.lit("N"), (k % 90).cast("string"), F.lit(".5")), F.concat((k % 180).cast("string"), F.lit(".25")))
    return people(s, d).select("c_custkey", p["parts"]["country"].alias("country"), p["latitude"].alias("latitude"), p["longitude"].alias("longitude"), places.place_text(p["parts"]).alias("place_text"))


def rec_changes(s, d):
    """Merges and splits of place versions, some of which name versions that don't exist."""
    n = read_table(s, d, "nation")
    v = n.filter("n_nationkey % 5 <> 0").select(F.concat(F.lit("pv_"), "n_nationkey").alias("place_version_id"))
    id_ = lambda e: F.concat(F.lit("pv_"), e.cast("string"))
    k = F.col("n_nationkey")
    changes = n.select(
        k.alias("change_id"), F.when(k % 2 == 0, "merge").otherwise("split").alias("kind"),
        F.when(k % 2 == 0, F.array(id_(k), id_(k + 1))).otherwise(F.array(id_(k))).alias("from_ids"), F.when(k % 2 == 0, F.array(id_(k))).otherwise(F.array(id_(k), id_(k + 1))).alias("to_ids"),
    )
    return place_registry.merge_report(changes, v).select(F.col("change_id").cast(B).alias("change_id"), "kind", "side", "place_version_id")


def rec_settled(s, d):
    """Claims of the births with the winner in the first place."""
    e = registry.event_claims(registry.events(_nodes(s, d)).filter("tag = 'BIRT'"))
    rows = e.select(F.col("owner").alias("event_key"), "claim", F.col("date")["raw"].alias("date_text"), "place", F.size("sources").alias("n_sources"), F.size("notes").alias("n_notes"))
    # Where the number is divisible by 3 the better claim comes last.
    turned = rows.withColumn("claim", F.when(F.regexp_extract("event_key", "([0-9]+)", 1).cast("int") % 3 == 0, 1 - F.col("claim")).otherwise(F.col("claim")))
    return claims.settle(turned).select("event_key", F.col("at").cast(B).alias("at"), F.col("claim").cast(B).alias("claim"), "date_text", F.col("score").cast(B).alias("score"), "ambiguous")


def rec_settled_counts(s, d):
    e = read_table(s, d, "lineitem").filter("l_linenumber <= 3")
    rows = e.select(F.col("l_orderkey").alias("event_key"), F.col("l_linenumber").alias("claim"), F.lit("1 JAN 1900").alias("date_text"), F.lit("A").alias("place"), (F.col("l_partkey") % 4).cast("int").alias("n_sources"), F.lit(0).alias("n_notes"))
    return claims.choice_counts(claims.settle(rows))


def _entries(s, d):
    c, k = people(s, d), F.col("c_custkey")
    entry = (
        F.when(k % 7 == 0, F.lit("{broken")).when(k % 7 == 1, F.to_json(F.struct(k.alias("uuid"), F.col("c_name").alias("name"))))
        .when(k % 7 == 2, F.to_json(F.struct(k.cast("string").alias("uuid"), F.col("c_name").alias("nom")))).otherwise(F.to_json(F.struct(k.cast("string").alias("uuid"), F.array("c_name").alias("events"), F.col("c_name").alias("name"))))
    )
    rows = c.select(F.when(k % 10 == 0, "persons").otherwise("individuals").alias("section"), F.when(k % 9 == 0, F.lit(" ")).otherwise((k - k % 2 * (k % 8 == 1).cast("int")).cast("string")).alias("key"), entry.alias("entry"))
    return rows.unionByName(s.createDataFrame([(x, "1", "{}") for x in ("families", "sources", "repositories")], "section string, key string, entry string"))


def rec_invalid(s, d):
    """What is wrong with a document, by rule and field."""
    schemas = {"individuals": {"uuid": "string!", "name": "string!", "events": "array"}}
    # A number in a text's place can't be told apart by its letters, so the type is asked of the list.
    return export.validate_export(_entries(s, d), schemas).groupBy("section", "rule", "field").agg(F.count("*").alias("n"))


QUERIES = {f.__name__: f for f in (
    rec_events, rec_sources, rec_notes, rec_flat_notes, rec_repositories, rec_attributes, rec_attachments, rec_claims, rec_names, rec_births, rec_minted, rec_occupations,
    rec_terms, rec_uuids, rec_places, rec_changes, rec_settled, rec_settled_counts, rec_invalid,
)}

_C = "(SELECT * FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"
_N = f"(SELECT DISTINCT n_nationkey AS n, n_name, r_name FROM {_C} c)"
_I = "'@I' || c_custkey || '@'"


def sha(x: str) -> str:
    return f"regexp_replace(substr(sha1({x}), 1, 32), '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})$', '\\1-\\2-\\3-\\4-\\5')"


_MEDIA = f"""'IMEDIA|{{"file": "pics/' || c_custkey || '.png", "lineno": ' || (c_custkey * 100 + 13) || ', "owner_pointer": "' || {_I} || '", "owner_uuid": "' || {sha(f"'PTR|' || {_I}")} || '", "title": "cradle"}}'"""

ORACLES = {
    "rec_events": f"""SELECT {_I} AS owner, c_custkey * 100 + 5 AS lineno, 'BIRT' AS tag, NULL AS subtype, NULL AS description, NULL AS cause, CAST(NULL AS BIGINT) AS certainty, c_custkey % 90 + CAST(0.5 AS DOUBLE) AS latitude,
 -(c_custkey % 180 + CAST(0.25 AS DOUBLE)) AS longitude, 'seen' AS notes, '@S' || c_nationkey || '@' AS sources, CAST(NULL AS BIGINT) AS age FROM customer
UNION ALL SELECT {_I}, c_custkey * 100 + 17, 'DEAT', NULL, NULL, 'fever', CASE WHEN c_custkey % 5 < 4 THEN c_custkey % 5 END, NULL, NULL, '', '', 50 + c_custkey % 3 FROM customer
UNION ALL SELECT {_I}, c_custkey * 100 + 21, 'EVEN', 'Meeting', 'spoke', NULL, NULL, NULL, NULL, '', '', NULL FROM customer
UNION ALL SELECT {_I}, c_custkey * 100 + 24, 'BIRT', NULL, NULL, NULL, NULL, NULL, NULL, '', '', NULL FROM customer""",
    "rec_sources": f"SELECT '@S' || n || '@' AS pointer, n_name AS title, r_name AS author, n_name || ' press' AS publication, '@R' || n || '@' AS repository, 'kept' AS notes FROM {_N} x",
    "rec_notes": f"SELECT '@N' || n || '@' AS pointer, 'text ' || n || ' more' || chr(10) || 'end' AS text FROM {_N} x",
    "rec_flat_notes": f"SELECT '@N' || n || '@' AS pointer, 'text ' || n || ' more' || chr(10) || 'end' AS value FROM {_N} x",
    "rec_repositories": f"SELECT '@R' || n || '@' AS pointer, 'Archive ' || n AS name, 'Street ' || n AS address FROM {_N} x",
    "rec_attributes": f"""SELECT 'INDI' AS entity, {_I} AS pointer, t AS tag, v AS value FROM customer, (VALUES ('OCCU', 'Farmer'), ('_MILT', 'yes')) q(t, v)
UNION ALL SELECT 'SOUR', '@S' || n || '@', '_APID', CAST(n AS VARCHAR) FROM {_N} x UNION ALL SELECT 'NOTE', '@N' || n || '@', '_COLOR', 'red' FROM {_N} x""",
    "rec_attachments": f"""SELECT {_I} AS owner, c_custkey * 100 + 13 AS lineno, 'BIRT' AS context, 'inline' AS kind, NULL AS target, 'pics/' || c_custkey || '.png' AS path, NULL AS form, 'cradle' AS title, true AS is_primary, {sha(_MEDIA)} AS media_object_id FROM customer
UNION ALL SELECT {_I}, c_custkey * 100 + 27, 'INDI', 'pointer', '@M' || c_custkey || '@', NULL, NULL, NULL, false, '@M' || c_custkey || '@' FROM customer
UNION ALL SELECT {_I}, c_custkey * 100 + 28, 'INDI', 'inline', NULL, NULL, 'png', NULL, false, NULL FROM customer""",
    "rec_claims": f"SELECT {_I} AS owner, c_custkey * 100 + CASE WHEN i = 0 THEN 5 ELSE 24 END AS lineno, CAST(i AS BIGINT) AS claim, CAST(2 AS BIGINT) AS n_claims, c_custkey % 2 = 1 AS ambiguous FROM customer, (VALUES (0), (1)) v(i)",
    "rec_names": f"""SELECT {_I} AS pointer, 'Nan' AS nickname, 'Dr.' AS prefix, 'Ann' AS given, 'Mary' AS middle, 'van' AS surname_prefix, c_mktsegment AS surname, 'Jr.' AS suffix, 'Dr. Ann Mary van ' || c_mktsegment || ' Jr.' AS full_name,
 'annmary' AS given_norm, regexp_replace(lower(c_mktsegment), '[^a-z0-9]', '', 'g') AS surname_norm, 'nil' AS bare_given, regexp_replace(lower(c_mktsegment), '[^a-z0-9]', '', 'g') AS bare_surname FROM customer""",
    "rec_births": "SELECT 'people' AS file, CAST(700 + j AS BIGINT) AS lineno, 'BIRT' AS tag FROM (VALUES (5), (24)) v(j)",
    "rec_minted": f"""SELECT row_number() OVER (ORDER BY id) AS ord, '@O' || id || '@' AS xref FROM range(1, 200) r(id) WHERE id NOT IN (SELECT n + 1 FROM {_N} x) ORDER BY id LIMIT 40""",
    "rec_occupations": f"""SELECT {_I} AS pointer, 'farmer' AS explicit, o[1] || '|' || o[2] AS inferred, array_to_string(list_sort(list_append(o, 'farmer')), '|') AS all_found, array_to_string(list_sort([w, 'clerk']), '|') AS said
FROM (SELECT c_custkey, list_sort([CASE WHEN c_custkey % 2 = 0 THEN 'baker' ELSE 'miller' END, 'clerk']) AS o, CASE WHEN c_custkey % 2 = 0 THEN 'baker' ELSE 'miller' END AS w FROM customer)""",
    "rec_terms": "SELECT c_custkey, array_to_string(list_sort(['farmer', lower(c_mktsegment), 'zoo keeper']), '|') AS terms FROM customer",
    "rec_uuids": f"""SELECT c_custkey, {sha("'A|' || c_custkey || '|'")} AS of_parts, {sha(f"'OCCU|' || {_I} || '|' || c_mktsegment")} AS of_occupation,
 {sha(f"'REC|{{{chr(34)}children{chr(34)}: [{chr(34)}NAME:' || chr(92) || '{chr(34)}Zo' || chr(92) || 'u00eb' || chr(92) || '{chr(34)}{chr(34)}, {chr(34)}SEX:' || c_mktsegment || '{chr(34)}], {chr(34)}lineno{chr(34)}: ' || c_custkey || ', {chr(34)}pointer{chr(34)}: {chr(34)}' || {_I} || '{chr(34)}, {chr(34)}tag{chr(34)}: {chr(34)}INDI{chr(34)}, {chr(34)}value{chr(34)}: null}}'")} AS of_record FROM customer""",
    "rec_places": f"""SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'Earth' END AS country, c_custkey % 90 + CAST(0.5 AS DOUBLE) AS latitude, c_custkey % 180 + CAST(0.25 AS DOUBLE) AS longitude,
 c_name || ', ' || n_name || ', ' || r_name || CASE WHEN c_custkey % 2 = 0 THEN ', Earth' ELSE '' END AS place_text FROM {_C} c""",
    "rec_changes": """WITH x AS (SELECT CAST(n_nationkey AS BIGINT) AS change_id, CASE WHEN n_nationkey % 2 = 0 THEN 'merge' ELSE 'split' END AS kind FROM nation),
s AS (SELECT *, 'from' AS side, change_id AS v FROM x UNION ALL SELECT *, 'to', change_id FROM x UNION ALL SELECT *, CASE kind WHEN 'merge' THEN 'from' ELSE 'to' END, change_id + 1 FROM x)
SELECT change_id, kind, side, 'pv_' || v AS place_version_id FROM s WHERE v % 5 = 0 OR v NOT IN (SELECT n_nationkey FROM nation)""",
    "rec_settled": f"""WITH c AS (SELECT c_custkey AS k, {_I} AS event_key, i, CASE WHEN c_custkey % 3 = 0 THEN 1 - i ELSE i END AS claim,
  CASE WHEN i = 0 OR c_custkey % 2 = 0 THEN '1 JAN ' || (1800 + c_custkey % 50) ELSE 'ABT 1801' END AS date_text,
  CASE WHEN i = 0 OR c_custkey % 2 = 0 THEN 55 ELSE 45 END + 35 + CASE WHEN i = 0 THEN 5 + 3 ELSE 0 END AS score FROM customer, (VALUES (0), (1)) v(i))
SELECT event_key, row_number() OVER (PARTITION BY event_key ORDER BY i) - 1 AS at, CAST(claim AS BIGINT) AS claim, date_text, CAST(score AS BIGINT) AS score, false AS ambiguous FROM c""",
    "rec_settled_counts": """WITH c AS (SELECT l_orderkey AS k, CASE l_partkey % 4 WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END AS s FROM lineitem WHERE l_linenumber <= 3),
m AS (SELECT *, max(s) OVER (PARTITION BY k) AS b FROM c), g AS (SELECT k, count(*) AS n, count_if(s = b) > 1 AS tie FROM m GROUP BY k)
SELECT count(*) AS n_events, count_if(n > 1) AS n_with_alternates, count_if(n > 1 AND NOT tie) AS n_resolved, count_if(n > 1 AND tie) AS n_ties FROM g""",
    "rec_invalid": """WITH e AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 10 = 0 THEN 'persons' ELSE 'individuals' END AS section, CASE WHEN c_custkey % 9 = 0 THEN ' ' ELSE CAST(CASE WHEN c_custkey % 8 = 1 THEN c_custkey - 1 ELSE c_custkey END AS VARCHAR) END AS key FROM customer),
bad AS (SELECT section, 'unknown_section' AS rule, NULL AS field FROM e WHERE section = 'persons' UNION ALL SELECT section, 'no_key', NULL FROM e WHERE key = ' ' UNION ALL SELECT section, 'no_object', NULL FROM e WHERE k % 7 = 0
 UNION ALL SELECT section, 'repeated_key', NULL FROM (SELECT section, key FROM e GROUP BY 1, 2 HAVING count(*) > 1) UNION ALL SELECT 'media_objects', 'missing_section', NULL
 UNION ALL SELECT section, 'unknown_field', 'nom' FROM e WHERE k % 7 = 2 AND section = 'individuals'
 UNION ALL SELECT DISTINCT section, 'missing_field', 'name' || k FROM e WHERE k % 7 = 2 AND section = 'individuals')
SELECT section, rule, CASE WHEN rule = 'missing_field' THEN 'name' ELSE field END AS field, count(*) AS n FROM bad GROUP BY 1, 2, 3""",
}
