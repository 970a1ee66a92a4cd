"""Problem 3: parent-child links to full hierarchies of unknown depth.

Splitters are nodes whose key hashes to 0 modulo ``every`` (and every root).
Each node walks to its next splitter; a walk takes over the walk of the node
it stands on, so its length doubles per round. Splitters then form a reduced
graph, ``every`` times smaller, on which the same walk leads to the roots, and
each node's exact path is its splitter's path and its own segment. A walk that
comes back to its own start without a splitter lies on an endless line; that is
found where it happens and passed on to the nodes leading into it.

Defined results: rows with a null node are no nodes; a parent that is null or
itself no node makes a root; of several parents of one node the least counts; a
node that is its own parent, lies on a loop or leads into one has root
``cycle``, depth -1 and an empty path; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinspark.functions.identity import normalize_pointer
from kinspark.session import durable

ACTIVE, DONE, ENDLESS = 0, 1, 2


def _walk(walks: DataFrame, stops: DataFrame, is_stop: Column, max_rounds: int) -> DataFrame:
    """Advance ``(node, cur, seg, status)`` until no walk is active. ``seg`` holds
    the nodes after ``node`` up to and including ``cur``. ``stops``: ``(node)``
    at which walks end besides those for which ``is_stop`` (of node) holds."""
    ends = stops.select("node", F.col("node").alias("cur"), F.array().cast("array<string>").alias("seg"), F.lit(DONE).alias("status"))
    settled = None
    for _ in range(max_rounds):
        # Only walks that moved are written; those that ended before stay where they are.
        walks = durable(walks)
        active, ended = walks.filter(F.col("status") == ACTIVE), walks.filter(F.col("status") != ACTIVE)
        settled = ended if settled is None else settled.unionByName(ended)
        if active.isEmpty():
            return settled
        own = F.when(is_stop, F.array().cast("array<string>")).otherwise(F.col("seg"))
        onward = settled.unionByName(active).select(
            F.col("node").alias("cur"),
            F.when(is_stop, F.col("node")).otherwise(F.col("cur")).alias("cur2"),
            own.alias("seg2"),
            F.when(is_stop, DONE).otherwise(F.col("status")).alias("status2"),
        ).unionByName(ends.select(F.col("node").alias("cur"), F.col("cur").alias("cur2"), F.col("seg").alias("seg2"), F.col("status").alias("status2")))
        seg = F.concat("seg", "seg2")
        walks = (
            active.drop("status")
            .join(onward.hint("merge"), "cur")  # a broadcast would keep the partitions of the union, which double every round
            .select(
                "node",
                F.col("cur2").alias("cur"),
                F.when(F.col("status2") == ENDLESS, F.array().cast("array<string>")).otherwise(seg).alias("seg"),
                F.when(F.col("status2") != ACTIVE, F.col("status2"))
                .when(F.array_contains(seg, F.col("node")), ENDLESS)
                .otherwise(ACTIVE)
                .alias("status"),
            )
        )
    raise RuntimeError(f"walks did not end in {max_rounds} rounds")


def resolve_hierarchy(links: DataFrame, every: int = 4, max_rounds: int = 64) -> DataFrame:
    """``links``: ``(node, parent)``. Returns ``(node, root, depth, path)`` with
    ``path`` the array of nodes from the root to the node."""
    one = links.filter(F.col("node").isNotNull()).groupBy("node").agg(F.min("parent").alias("parent"))
    known = one.select(F.col("node").alias("parent"), F.lit(True).alias("_is"))
    nodes = durable(one.join(known, "parent", "left").select("node", F.when(F.col("_is"), F.col("parent")).alias("parent")))
    roots = nodes.filter(F.col("parent").isNull()).select("node")

    def splits(c: str) -> Column:
        return F.pmod(F.xxhash64(F.col(c)), F.lit(every)) == 0

    start = nodes.filter(F.col("parent").isNotNull()).select(
        "node",
        F.col("parent").alias("cur"),
        F.array("parent").alias("seg"),
        F.when(F.col("parent") == F.col("node"), ENDLESS).when(splits("parent"), DONE).otherwise(ACTIVE).alias("status"),
    )
    walked = _walk(start, roots, splits("node"), max_rounds)
    # The reduced graph: splitters only; they stop at roots, which are not in it.
    reduced = walked.filter(splits("node")).withColumn(
        "status", F.when((F.col("status") == DONE) & (F.col("cur") == F.col("node")), ENDLESS).when(F.col("status") == DONE, ACTIVE).otherwise(F.col("status"))
    )
    solved = _walk(reduced, roots, F.lit(False), max_rounds)
    ends = solved.select(F.col("node").alias("cur"), F.col("cur").alias("root"), F.col("seg").alias("tail"), F.col("status").alias("end")).unionByName(
        roots.select(F.col("node").alias("cur"), F.col("node").alias("root"), F.array().cast("array<string>").alias("tail"), F.lit(DONE).alias("end"))
    )
    rest = walked.filter(~splits("node"))
    lost = rest.filter(F.col("status") == ENDLESS).select("node")
    up = F.concat(F.array("node"), F.col("seg"), F.col("tail"))
    expanded = rest.filter(F.col("status") == DONE).join(ends, "cur").select("node", "root", "end", up.alias("up"))
    own = solved.select("node", F.col("cur").alias("root"), F.col("status").alias("end"), F.concat(F.array("node"), F.col("seg")).alias("up"))
    at_root = roots.select("node", F.col("node").alias("root"), F.lit(DONE).alias("end"), F.array("node").alias("up"))
    none = F.array().cast("array<string>")
    whole = expanded.unionByName(own).unionByName(at_root).unionByName(lost.select("node", F.lit("cycle").alias("root"), F.lit(ENDLESS).alias("end"), none.alias("up")))
    ok = F.col("end") == DONE
    return whole.select(
        "node",
        F.when(ok, F.col("root")).otherwise(F.lit("cycle")).alias("root"),
        F.when(ok, F.size("up") - 1).otherwise(F.lit(-1)).alias("depth"),
        F.when(ok, F.reverse("up")).otherwise(none).alias("path"),
    )


def descendants(resolved: DataFrame) -> DataFrame:
    """``(ancestor, node, steps)``: every node below every ancestor, itself aside."""
    return resolved.filter("depth > 0").select("node", "depth", F.posexplode("path").alias("at", "ancestor")).filter("at < depth").select(
        "ancestor", "node", (F.col("depth") - F.col("at")).alias("steps")
    )


def family_states(families: DataFrame) -> DataFrame:
    """The last row of each family, deletions included: ``(fam, members, deleted)``."""
    return (
        families.select(normalize_pointer(F.col("pointer")).alias("fam"), "loaded_at", F.coalesce("deleted", F.lit(False)).alias("deleted"), "members")
        .filter("fam is not null")
        .groupBy("fam")
        .agg(F.max(F.struct("loaded_at", "deleted", "members")).alias("_r"))
        .select("fam", "_r.deleted", "_r.members")
    )


def parent_links(individuals: DataFrame, families: DataFrame) -> DataFrame:
    """``(node, parent)`` of every individual: its family of origin is the first
    famc entry with a living family, else the (least) family naming it CHIL; its
    parent that family's first HUSB that exists, else its first WIFE likewise."""
    people = individuals.select(normalize_pointer(F.col("pointer")).alias("node"), "famc").filter("node is not null")
    exists = people.select("node").distinct()
    alive = family_states(families).filter(~F.col("deleted"))
    members = alive.select("fam", F.posexplode("members").alias("at", "m")).select(
        "fam",
        F.upper(F.trim("m.role")).alias("role"),
        normalize_pointer(F.col("m.member")).alias("node"),
        F.coalesce("m.ord", "at").alias("ord"),
        "at",
    ).filter("node is not null")
    heads = (
        members.filter("role in ('HUSB', 'WIFE')")
        .join(exists, "node", "left_semi")
        .groupBy("fam")
        .agg(F.min(F.struct(F.col("role"), "ord", "at", "node")).alias("h"))
        .select("fam", F.col("h.node").alias("parent"))
    )
    named = (
        people.select("node", F.posexplode("famc").alias("at", "raw"))
        .select("node", "at", normalize_pointer(F.col("raw")).alias("fam"))
        .filter("fam is not null")
        .join(alive.select("fam"), "fam", "left_semi")
        .groupBy("node")
        .agg(F.min_by("fam", "at").alias("fam"))
    )
    listed = members.filter("role = 'CHIL'").groupBy("node").agg(F.min("fam").alias("fam2"))
    origin = exists.join(named, "node", "left").join(listed, "node", "left").select("node", F.coalesce("fam", "fam2").alias("fam"))
    return origin.join(heads, "fam", "left").select("node", "parent")


def lines_of_descent(individuals: DataFrame, families: DataFrame) -> DataFrame:
    """``(pointer, root_pointer, node_depth, node_path)`` of every individual."""
    return resolve_hierarchy(parent_links(individuals, families)).select(
        F.col("node").alias("pointer"), F.col("root").alias("root_pointer"), F.col("depth").cast("int").alias("node_depth"), F.concat_ws("/", "path").alias("node_path")
    )
