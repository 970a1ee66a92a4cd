"""Records of lineage files as typed tables.

All builders are conditional aggregations over ``nodes``; nothing nests. A
reference is a line's pointer or, as in files, its value in the form ``@…@``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kinspark.functions import events as ev
from kinspark.functions.dates import age_between, parse_date
from kinspark.functions.identity import is_pointer, normalize_pointer, uuid_for_event, uuid_for_inline_media, uuid_for_pointer
from kinspark.functions.places import event_place, hemisphere_degrees

#: Tags of the records that become entities.
ENTITIES = {"INDI": "individuals", "FAM": "families", "SOUR": "sources", "NOTE": "notes", "OBJE": "media_objects", "REPO": "repositories"}

#: Ids per range in which new pointers are counted.
IDS = 1 << 20


def reference() -> Column:
    return F.coalesce(F.col("pointer"), F.when(is_pointer(F.trim("value")), F.trim("value")))


def records(nodes: DataFrame, tag: str) -> DataFrame:
    """The last record of each pointer: ``(file, record_lineno, pointer)``."""
    r = nodes.filter((F.col("level") == 0) & (F.upper("tag") == tag) & F.col("pointer").isNotNull())
    return r.groupBy("file", normalize_pointer(F.col("pointer")).alias("pointer")).agg(F.max("lineno").alias("record_lineno"))


def entity_counts(nodes: DataFrame) -> DataFrame:
    """G1: records per entity type, a pointer counting once."""
    named = nodes.filter(F.col("level") == 0).withColumn("entity", F.coalesce(*[F.when(F.upper("tag") == t, F.lit(e)) for t, e in ENTITIES.items()]))
    return named.filter("entity is not null").groupBy("entity").agg(F.count_distinct("file", "pointer").alias("n"))


def _first_level(nodes: DataFrame, tag: str) -> DataFrame:
    own = records(nodes, tag).select("file", "record_lineno", F.col("pointer").alias("owner"))
    return nodes.filter("level = 1").join(own, ["file", "record_lineno"])


def _sorted(value: Column, when: Column) -> Column:
    return F.transform(F.array_sort(F.collect_list(F.when(when & value.isNotNull(), F.struct("lineno", value.alias("v"))))), lambda x: x["v"])


def individuals(nodes: DataFrame) -> DataFrame:
    """R2: ``(file, pointer, uuid, gender, fams, famc, notes, sources)``."""
    tag, ref, text = F.upper("tag"), normalize_pointer(reference()), F.nullif(F.trim("value"), F.lit(""))
    kids = _first_level(nodes, "INDI").groupBy("file", F.col("owner").alias("pointer")).agg(
        F.min_by(F.when(tag == "SEX", text), F.when(tag == "SEX", F.col("lineno"))).alias("gender"),
        _sorted(ref, tag == "FAMS").alias("fams"), _sorted(ref, tag == "FAMC").alias("famc"),
        _sorted(text, tag == "NOTE").alias("notes"), _sorted(ref, tag == "SOUR").alias("sources"),
    )
    return records(nodes, "INDI").drop("record_lineno").join(kids, ["file", "pointer"], "left").withColumn("uuid", uuid_for_pointer(F.col("pointer")))


def names(nodes: DataFrame) -> DataFrame:
    """R2: one row per NAME: ``(file, pointer, lineno, full, given, surname, prefix, suffix, nickname, name_type)``."""
    top = _first_level(nodes, "INDI").filter(F.upper("tag") == "NAME").select("file", F.col("owner").alias("pointer"), "lineno", F.col("value").alias("full"))
    parts = {"GIVN": "given", "SURN": "surname", "NPFX": "prefix", "NSFX": "suffix", "NICK": "nickname", "TYPE": "name_type"}
    low = nodes.filter("level = 2").groupBy("file", F.col("parent_lineno").alias("lineno")).agg(
        *[F.max_by(F.when(F.upper("tag") == t, F.col("value")), F.when(F.upper("tag") == t, F.col("lineno"))).alias(c) for t, c in parts.items()]
    )
    return top.join(low, ["file", "lineno"], "left").select("file", "pointer", "lineno", "full", *parts.values())


def family_members(nodes: DataFrame) -> DataFrame:
    """``(file, family, role, member, ord)``: the first HUSB and WIFE, every CHIL."""
    rows = _first_level(nodes, "FAM").filter(F.upper("tag").isin("HUSB", "WIFE", "CHIL")).select(
        "file", F.col("owner").alias("family"), F.upper("tag").alias("role"), normalize_pointer(reference()).alias("member"), "lineno"
    ).filter("member is not null")
    ord_ = F.row_number().over(W.partitionBy("file", "family", "role").orderBy("lineno"))
    return rows.withColumn("ord", ord_).filter("role = 'CHIL' or ord = 1").drop("lineno")


def linked_members(nodes: DataFrame) -> DataFrame:
    """Members that exist as individuals; this one table gives both directions."""
    people = records(nodes, "INDI").select("file", F.col("pointer").alias("member"))
    return family_members(nodes).join(people, ["file", "member"])


def sources(nodes: DataFrame) -> DataFrame:
    """``(file, pointer, title, author, publication, repository, notes)``, the last of
    each and all notes; other lines are in attributes()."""
    tag = F.upper("tag")
    last = lambda t, v: F.max_by(F.when(tag == t, v), F.when(tag == t, F.col("lineno")))
    kids = _first_level(nodes, "SOUR").groupBy("file", F.col("owner").alias("pointer")).agg(
        last("TITL", F.col("value")).alias("title"), last("AUTH", F.col("value")).alias("author"),
        last("PUBL", F.col("value")).alias("publication"), last("REPO", reference()).alias("repository"),
        _sorted(F.nullif(F.trim("value"), F.lit("")), tag == "NOTE").alias("notes"),
    )
    return records(nodes, "SOUR").drop("record_lineno").join(kids, ["file", "pointer"], "left")


def notes(nodes: DataFrame) -> DataFrame:
    """``(file, pointer, text)``; give it folded nodes."""
    own = nodes.select("file", F.col("lineno").alias("record_lineno"), F.col("value").alias("text"))
    return records(nodes, "NOTE").join(own, ["file", "record_lineno"]).select("file", "pointer", "text")


def media_files(nodes: DataFrame) -> DataFrame:
    """One row per FILE of a media record; form and type stand under it or beside it."""
    tag = F.upper("tag")
    files = _first_level(nodes, "OBJE").filter(tag == "FILE").select("file", F.col("owner").alias("pointer"), "lineno", "record_lineno", F.col("value").alias("path"))
    under = nodes.filter((F.col("level") == 2) & tag.isin("FORM", "TYPE", "MEDI")).groupBy("file", F.col("parent_lineno").alias("lineno")).agg(
        F.min_by(F.when(tag == "FORM", F.col("value")), F.when(tag == "FORM", F.col("lineno"))).alias("form_under"),
        F.min_by(F.when(tag.isin("TYPE", "MEDI"), F.col("value")), F.when(tag.isin("TYPE", "MEDI"), F.col("lineno"))).alias("type_under"),
    )
    deep = nodes.filter((F.col("level") == 3) & tag.isin("TYPE", "MEDI")).join(
        nodes.filter((F.col("level") == 2) & (tag == "FORM")).select("file", F.col("lineno").alias("parent_lineno"), F.col("parent_lineno").alias("of")), ["file", "parent_lineno"]
    ).groupBy("file", F.col("of").alias("lineno")).agg(F.min_by("value", "lineno").alias("type_deep"))
    beside = nodes.filter("level = 1").groupBy("file", "record_lineno").agg(
        F.min_by(F.when(tag == "FORM", F.col("value")), F.when(tag == "FORM", F.col("lineno"))).alias("form_beside"),
        F.min_by(F.when(tag == "TITL", F.col("value")), F.when(tag == "TITL", F.col("lineno"))).alias("title"),
    )
    return (
        files.join(under, ["file", "lineno"], "left").join(deep, ["file", "lineno"], "left").join(beside, ["file", "record_lineno"], "left")
        .select("file", "pointer", "lineno", "path", F.coalesce("form_under", "form_beside").alias("form"), F.coalesce("type_deep", "type_under").alias("media_type"), "title")
    )


def attachments(nodes: DataFrame) -> DataFrame:
    """Media attached to records at any depth; inline ones with a file
    are promoted to media objects: ``(file, owner, lineno, context, kind, target,
    path, form, title, media_type, is_primary, media_object_id)``; ``context`` is the tag
    under which the attachment stands."""
    own = nodes.filter("level = 0 and pointer is not null").select("file", F.col("lineno").alias("record_lineno"), normalize_pointer(F.col("pointer")).alias("owner"))
    tag = F.upper("tag")
    above = nodes.select("file", F.col("lineno").alias("parent_lineno"), tag.alias("context"))
    rows = nodes.filter((F.col("level") >= 1) & (tag == "OBJE")).join(own, ["file", "record_lineno"]).join(above, ["file", "parent_lineno"])
    first = lambda *t: F.min_by(F.when(tag.isin(*t), F.col("value")), F.when(tag.isin(*t), F.col("lineno")))
    low = nodes.filter("level >= 2").groupBy("file", F.col("parent_lineno").alias("lineno")).agg(
        first("FILE").alias("path"), first("FORM").alias("form"), first("TITL").alias("title"), first("TYPE", "MEDI").alias("media_type"), first("_PRIM").alias("_prim")
    )
    target = normalize_pointer(reference())
    inline = F.when(F.coalesce("path", F.lit("")) != "", uuid_for_inline_media(uuid_for_pointer(F.col("owner")), F.col("owner"), F.col("lineno"), F.col("path"), F.col("title")))
    return rows.join(low, ["file", "lineno"], "left").select(
        "file", "owner", "lineno", "context", F.when(target.isNotNull(), "pointer").otherwise("inline").alias("kind"), target.alias("target"), "path", "form", "title",
        "media_type", F.coalesce(F.upper(F.trim("_prim")) == "Y", F.lit(False)).alias("is_primary"), F.coalesce(target, inline).alias("media_object_id"),
    )


def normalize_media(files: DataFrame) -> DataFrame:
    """V7: the file's name and extension in lower case, the form falling back to the extension."""
    name = F.regexp_extract("path", r"([^/\\]+)$", 1)
    ext = F.lower(F.nullif(F.regexp_extract(name, r"\.([A-Za-z0-9]+)$", 1), F.lit("")))
    return files.withColumns({"basename": name, "extension": ext, "form": F.coalesce(F.lower("form"), ext)})


def used_xrefs(nodes: DataFrame) -> DataFrame:
    """Every pointer that is defined or mentioned."""
    said = nodes.select(F.explode(F.regexp_extract_all("value", F.lit(r"(@[^@\s]+@)"))).alias("xref"))
    return nodes.select(F.col("pointer").alias("xref")).filter("xref is not null").unionByName(said).distinct()


def minted_xrefs(used: DataFrame, n: int) -> DataFrame:
    """``(ord, xref)``: n new pointers ``@O<k>@`` that are not used. An id's place is
    itself less the ids before it that are taken; those are counted by ranges."""
    taken = used.select(F.regexp_extract("xref", "^@O([0-9]+)@$", 1).try_cast("bigint").alias("id")).filter("id is not null").distinct()
    # As many ids as are taken may be unusable, so this range is long enough.
    ids = used.sparkSession.range(1, n + taken.count() + 1).join(taken, "id", "left_anti").withColumn("b", F.floor(F.col("id") / IDS))
    counts = ids.groupBy("b").agg(F.count("*").alias("n"))
    before = W.partitionBy(F.lit(0)).orderBy("b").rowsBetween(W.unboundedPreceding, -1)  # one row per range
    start = counts.select("b", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    at = F.col("start") + F.row_number().over(W.partitionBy("b").orderBy("id"))
    return ids.join(start, "b").withColumn("ord", at).filter(F.col("ord") <= n).select("ord", F.concat(F.lit("@O"), F.col("id").cast("string"), F.lit("@")).alias("xref"))


def attributes(nodes: DataFrame) -> DataFrame:
    """S3: first-level lines of individuals, families, sources, notes and media
    objects that no model covers: ``(file, entity, pointer, lineno, tag, value)``."""
    known = {
        "INDI": ["NAME", "SEX", "FAMS", "FAMC", "NOTE", "SOUR", "OBJE", *ev.INDIVIDUAL_TAGS, *ev.FAMILY_TAGS],
        "FAM": ["HUSB", "WIFE", "CHIL", "NOTE", "SOUR", "OBJE", *ev.INDIVIDUAL_TAGS, *ev.FAMILY_TAGS],
        "SOUR": ["TITL", "AUTH", "PUBL", "REPO", "NOTE"], "NOTE": ["CONC", "CONT"], "OBJE": ["FILE", "FORM", "TITL"],
    }
    own = nodes.filter((F.col("level") == 0) & F.col("pointer").isNotNull()).select("file", F.col("lineno").alias("record_lineno"), F.upper("tag").alias("entity"), normalize_pointer(F.col("pointer")).alias("pointer"))
    rows = nodes.filter("level = 1").drop("pointer").join(own, ["file", "record_lineno"])
    open_ = F.lit(False)
    for entity, tags in known.items():
        open_ = open_ | ((F.col("entity") == entity) & ~F.upper("tag").isin(*tags))
    return rows.filter(open_).select("file", "entity", "pointer", "lineno", F.upper("tag").alias("tag"), "value")


def events(nodes: DataFrame, coordinates: bool = True, ages: bool = True) -> DataFrame:
    """One row per event of an individual or family with its date, place,
    type, cause, certainty, notes and sources, and, where asked for, its coordinates
    and the age at it."""
    tag = F.upper("tag")
    own = nodes.filter((F.col("level") == 0) & tag.isin("INDI", "FAM") & F.col("pointer").isNotNull()).select(
        "file", F.col("lineno").alias("record_lineno"), normalize_pointer(F.col("pointer")).alias("owner"), tag.alias("owner_type")
    )
    rows = nodes.filter((F.col("level") == 1) & ev.is_event(F.col("tag"))).join(own, ["file", "record_lineno"])
    first = lambda t: F.min_by(F.when((tag == t) & (F.trim("value") != ""), F.trim("value")), F.when((tag == t) & (F.trim("value") != ""), F.col("lineno")))
    low = nodes.filter("level = 2").groupBy("file", F.col("parent_lineno").alias("lineno")).agg(
        first("DATE").alias("date_text"), first("PLAC").alias("place_text"), first("TYPE").alias("subtype"), first("CAUS").alias("cause"), first("QUAY").alias("quay"),
        _sorted(F.nullif(F.trim("value"), F.lit("")), tag == "NOTE").alias("notes"), _sorted(reference(), tag == "SOUR").alias("sources"),
    )
    rows = rows.join(low, ["file", "lineno"], "left")
    if coordinates:
        rows = rows.join(_coordinates(nodes), ["file", "lineno"], "left")
    e = rows.select(
        "file", "owner", "owner_type", "lineno", tag.alias("tag"), parse_date(F.col("date_text")).alias("date"), event_place(F.col("place_text")).alias("place"),
        ev.event_type(F.col("tag")).alias("type"), "subtype", F.when(tag == "EVEN", F.nullif(F.trim("value"), F.lit(""))).alias("description"),
        "cause", ev.certainty(F.col("quay")).alias("certainty"), *(["latitude", "longitude"] if coordinates else []), "notes", "sources",
    )
    e = e.withColumn("uuid", uuid_for_event(F.col("owner"), F.col("tag"), F.col("date")["normalized"], F.col("place")))
    if not ages:
        return e
    births = e.filter("tag = 'BIRT' and owner_type = 'INDI'").groupBy("file", "owner").agg(F.min_by("date", "lineno").alias("birth"))
    age = F.when((F.col("owner_type") == "INDI") & (F.col("tag") != "BIRT"), age_between(F.col("birth"), F.col("date")))
    return e.join(births, ["file", "owner"], "left").withColumn("age", age).drop("birth")


def _coordinates(nodes: DataFrame) -> DataFrame:
    """``(file, lineno, latitude, longitude)`` of events; they stand in a MAP of the event
    or of its place."""
    tag = F.upper("tag")
    deep = nodes.filter(tag.isin("LATI", "LONG")).select("file", F.col("parent_lineno").alias("map"), tag.alias("which"), "value", "lineno")
    maps = nodes.filter(tag == "MAP").select("file", F.col("lineno").alias("map"), F.col("parent_lineno").alias("of"))
    ups = nodes.select("file", F.col("lineno").alias("of"), F.when(F.col("level") == 1, F.col("lineno")).otherwise(F.col("parent_lineno")).alias("event_line"))
    return deep.join(maps, ["file", "map"]).join(ups, ["file", "of"]).groupBy("file", F.col("event_line").alias("lineno")).agg(
        F.min_by(F.when(F.col("which") == "LATI", hemisphere_degrees(F.col("value"))), F.when(F.col("which") == "LATI", F.col("lineno"))).alias("latitude"),
        F.min_by(F.when(F.col("which") == "LONG", hemisphere_degrees(F.col("value"))), F.when(F.col("which") == "LONG", F.col("lineno"))).alias("longitude"),
    )


def event_roles(nodes: DataFrame) -> DataFrame:
    """``(file, owner, event_lineno, tag, value, label)``: roles named by the
    record or the event, each once."""
    tag = F.upper("tag")
    ref = reference()
    role = tag.isin(*ev.ROLE_TAGS) | (tag.startswith("_") & ref.isNotNull() & ~tag.isin(*ev.NO_ROLE_TAGS))
    own = nodes.filter((F.col("level") == 0) & tag.isin("INDI", "FAM") & F.col("pointer").isNotNull()).select("file", F.col("lineno").alias("record_lineno"), normalize_pointer(F.col("pointer")).alias("owner"))
    e = nodes.filter((F.col("level") == 1) & ev.is_event(F.col("tag"))).select("file", "record_lineno", F.col("lineno").alias("event_lineno"))
    said = F.coalesce(ref, F.trim("value"))
    above = nodes.filter((F.col("level") == 1) & role).select("file", "record_lineno", F.lit(0).alias("src"), "lineno", tag.alias("tag"), said.alias("value")).join(e, ["file", "record_lineno"])
    below = nodes.filter((F.col("level") == 2) & role).select("file", "record_lineno", F.lit(1).alias("src"), "lineno", tag.alias("tag"), said.alias("value"), F.col("parent_lineno").alias("event_lineno")).join(e, ["file", "record_lineno", "event_lineno"])
    rows = above.unionByName(below).join(own, ["file", "record_lineno"])
    n = F.row_number().over(W.partitionBy("file", "event_lineno", "tag", "value").orderBy("src", "lineno"))
    return rows.withColumn("n", n).filter("n = 1").select("file", "owner", "event_lineno", "tag", "value", ev.role_label(F.col("tag")).alias("label"))


def event_claims(e: DataFrame, owner: str = "owner", tag: str = "tag", order: str = "lineno") -> DataFrame:
    """O3: competing claims of one event: the first is the primary one (claim 0), the
    others its alternates; ``ambiguous`` where any differs in date or place."""
    w = W.partitionBy(owner, tag)
    form = F.struct(F.col("date")["raw"], F.col("place"))
    differ = F.min(form).over(w) != F.max(form).over(w)
    return e.withColumns({"claim": F.row_number().over(w.orderBy(order)) - 1, "n_claims": F.count("*").over(w), "ambiguous": F.coalesce(differ, F.lit(False))})


def repositories(nodes: DataFrame) -> DataFrame:
    """``(file, pointer, name, address)`` of the repositories."""
    tag = F.upper("tag")
    first = lambda t: F.min_by(F.when(tag == t, F.col("value")), F.when(tag == t, F.col("lineno")))
    kids = _first_level(nodes, "REPO").groupBy("file", F.col("owner").alias("pointer")).agg(first("NAME").alias("name"), first("ADDR").alias("address"))
    return records(nodes, "REPO").drop("record_lineno").join(kids, ["file", "pointer"], "left")
