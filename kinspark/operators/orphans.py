"""Problem 7: references to records that do not exist.

A reference is *direct* when its own target is missing, deleted or was loaded
only later. Records that hang on an orphaned record are *inherited* orphans:
they are found by iterating semi-joins down the foreign-key graph until no new
record turns up.

Defined results: null and blank references are none; a reference repeated in a
field counts once, with the first delivery of its row; a target's last row (by
``loaded_at``, a deletion winning a tie) is its state; a null ``loaded_at``
counts as earlier than any other, and a null ``deleted`` as false. Extra
columns are ignored and empty tables give an empty report.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinspark.functions.identity import normalize_pointer
from kinspark.session import durable

LINKS = "tbl string, row_key string, parent_tbl string, parent_key string"


def target_states(df: DataFrame, tbl: str, pointer: str = "pointer") -> DataFrame:
    """``(parent_tbl, ref_pointer, first_at, deleted)``: one row per record."""
    return (
        df.select(
            normalize_pointer(F.col(pointer)).alias("ref_pointer"),
            "loaded_at",
            F.coalesce(F.col("deleted"), F.lit(False)).alias("deleted"),
        )
        .filter(F.col("ref_pointer").isNotNull())
        .groupBy("ref_pointer")
        .agg(F.min("loaded_at").alias("first_at"), F.max(F.struct("loaded_at", "deleted")).alias("_s"))
        .select(F.lit(tbl).alias("parent_tbl"), "ref_pointer", "first_at", F.col("_s.deleted").alias("deleted"))
    )


def references(df: DataFrame, tbl: str, row_key, field: str, parent_tbl: str) -> DataFrame:
    """The distinct references of one field; arrays are unfolded."""
    kind = dict(df.dtypes)[field]
    raw = F.explode(field) if kind.startswith("array") else F.col(field)
    return (
        df.select(row_key.cast("string").alias("row_key"), "loaded_at", raw.alias("_ref"))
        .select(
            F.lit(tbl).alias("tbl"),
            "row_key",
            F.lit(field).alias("field_name"),
            F.lit(parent_tbl).alias("parent_tbl"),
            normalize_pointer(F.col("_ref")).alias("ref_pointer"),
            "loaded_at",
        )
        .filter(F.col("ref_pointer").isNotNull() & F.col("row_key").isNotNull())
        .groupBy("tbl", "row_key", "field_name", "parent_tbl", "ref_pointer")
        .agg(F.min("loaded_at").alias("row_at"))
    )


def direct_orphans(refs: DataFrame, targets: DataFrame) -> DataFrame:
    kind = (
        F.when(F.col("deleted").isNull(), "missing")
        .when(F.col("deleted"), "deleted")
        .when(F.col("row_at").isNotNull() & (F.col("first_at") > F.col("row_at")), "late")
        .when(F.col("row_at").isNull() & F.col("first_at").isNotNull(), "late")
    )
    return (
        refs.join(targets, ["parent_tbl", "ref_pointer"], "left")
        .withColumn("orphan_kind", kind)
        .filter(F.col("orphan_kind").isNotNull())
        .select(
            "tbl", "row_key", "field_name", "parent_tbl", "ref_pointer", "orphan_kind",
            F.date_format("row_at", "yyyy-MM").alias("loaded_month"),
        )
    )


def cascade(direct: DataFrame, links: DataFrame) -> DataFrame:
    """``(tbl, row_key, steps)`` of every orphaned record: 0 steps where its own
    reference is missing or deleted, else the number of links to such a record.

    ``links`` has one row per foreign key (see LINKS). Each round semi-joins the
    links with the records found last; the rounds end when none is new, so there
    is no bound on the depth."""
    lost = direct.filter(F.col("orphan_kind") != "late")
    found = durable(lost.select("tbl", "row_key").distinct().withColumn("steps", F.lit(0)))
    frontier, step = found, 0
    while True:
        step += 1
        parents = frontier.select(F.col("tbl").alias("parent_tbl"), F.col("row_key").alias("parent_key"))
        new = durable(
            links.join(parents, ["parent_tbl", "parent_key"], "left_semi")
            .select("tbl", "row_key")
            .distinct()
            .join(found, ["tbl", "row_key"], "left_anti")
            .withColumn("steps", F.lit(step))
        )
        if new.isEmpty():
            return found
        found, frontier = found.unionByName(new), new
        if step % 10 == 0:
            found = durable(found)


def orphan_report(direct: DataFrame, inherited: DataFrame) -> DataFrame:
    """Direct orphan references and, below them, the records that inherit:
    ``(tbl, row_key, field_name, ref_pointer, orphan_kind, loaded_month,
    orphan_class, steps)``. An inherited row has no field, pointer or month."""
    cols = ["tbl", "row_key", "field_name", "ref_pointer", "orphan_kind", "loaded_month"]
    null = F.lit(None).cast("string")
    return direct.select(*cols, F.lit("direct").alias("orphan_class"), F.lit(0).alias("steps")).unionByName(
        inherited.select(
            "tbl", "row_key", null.alias("field_name"), null.alias("ref_pointer"), F.lit("inherited").alias("orphan_kind"),
            null.alias("loaded_month"), F.lit("inherited").alias("orphan_class"), "steps",
        )
    )


def archive_refs(individuals: DataFrame, citations: DataFrame) -> DataFrame:
    who = normalize_pointer(F.col("pointer"))
    return (
        references(individuals, "individuals", who, "famc", "families")
        .unionByName(references(individuals, "individuals", who, "fams", "families"))
        .unionByName(references(citations, "citations", F.col("citation_id"), "source_xref", "source_records"))
    )


def archive_targets(families: DataFrame, sources: DataFrame) -> DataFrame:
    return target_states(families, "families").unionByName(target_states(sources, "source_records"))


def foreign_keys(df: DataFrame, tbl: str, row_key, ref, parent_tbl: str) -> DataFrame:
    """Links of one foreign key (see LINKS); an array of references is unfolded."""
    return (
        df.select(F.lit(tbl).alias("tbl"), row_key.cast("string").alias("row_key"), F.lit(parent_tbl).alias("parent_tbl"), ref.alias("_ref"))
        .select("tbl", "row_key", "parent_tbl", normalize_pointer(F.col("_ref")).alias("parent_key"))
        .filter("row_key is not null and parent_key is not null")
        .distinct()
    )


def archive_direct(individuals: DataFrame, families: DataFrame, citations: DataFrame, sources: DataFrame) -> DataFrame:
    """The direct orphans of the archive, from which the cascade starts: famc and
    fams of individuals, source_xref of citations."""
    return direct_orphans(archive_refs(individuals, citations), archive_targets(families, sources))


def archive_orphans(individuals: DataFrame, families: DataFrame, citations: DataFrame, sources: DataFrame, events: DataFrame) -> DataFrame:
    """The orphan report of the family archive: its direct orphans, and by the
    cascade all records that inherit: families
    from the members of their last row unless it is deleted, individuals from their
    famc and fams, citations and events from their owner, an individual or a
    family. Only records that exist can inherit."""
    who = normalize_pointer(F.col("pointer"))
    last = families.select(who.alias("pointer"), "loaded_at", F.coalesce("deleted", F.lit(False)).alias("deleted"), "members").filter("pointer is not null")
    last = last.groupBy("pointer").agg(F.max_by("members", F.struct("loaded_at", "deleted")).alias("members"), F.max(F.struct("loaded_at", "deleted")).alias("s")).filter("not s.deleted")
    links = foreign_keys(last, "families", F.col("pointer"), F.explode("members.member"), "individuals")
    for field in ("famc", "fams"):
        links = links.unionByName(foreign_keys(individuals, "individuals", who, F.explode(field), "families"))
    direct = durable(archive_direct(individuals, families, citations, sources))
    found = cascade(direct.filter("tbl = 'individuals'"), durable(links))
    # Citations and events are nobody's parents: they are looked up once, at the end.
    parents = found.select(F.col("row_key").alias("parent_key"), (F.col("steps") + 1).alias("steps"))
    below = []
    for df, tbl, key in ((citations, "citations", "citation_id"), (events, "event_records", "event_id")):
        owners = df.select(F.col(key).cast("string").alias("row_key"), normalize_pointer(F.col("owner_pointer")).alias("parent_key"))
        heirs = owners.filter("row_key is not null").join(parents, "parent_key").groupBy("row_key").agg(F.min("steps").alias("steps"))
        below.append(heirs.select(F.lit(tbl).alias("tbl"), "row_key", "steps"))
    lost = direct.filter("tbl = 'citations' and orphan_kind <> 'late'").select("tbl", "row_key")
    heirs = found.filter("steps > 0").unionByName(below[0].join(lost, ["tbl", "row_key"], "left_anti")).unionByName(below[1])
    return orphan_report(direct, heirs)


def orphans_per_period(report: DataFrame) -> DataFrame:
    """Counts per table, field, kind and month of loading."""
    return report.groupBy("tbl", "field_name", "orphan_class", "orphan_kind", "loaded_month").agg(
        F.count("*").alias("n_refs"), F.countDistinct("row_key").alias("n_rows")
    )
