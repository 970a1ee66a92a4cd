"""Duplicate people (K1-K14): blocking, similarity, clusters, merge plan, merges.

``people(person_id, given, surname, birth_year, place_id, place_raw, tags)``;
given and surname as match tokens (``unknown`` where there is none), place_raw the
place as typed, which counts where there is no place_id.
"""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinspark.operators.components import connected_components
from kinspark.session import durable

MIN_SCORE, REVIEW, AUTO = 0.75, 0.80, 0.92


def block_key() -> Column:
    """K1."""
    return F.concat_ws("|", "surname", F.coalesce(F.col("birth_year").cast("string"), F.lit("UNKNOWN")), F.coalesce("place_id", "place_token", F.lit("UNKNOWN")))


def place_token() -> Column:
    """The typed place as a match token, null where nothing is left."""
    return F.nullif(F.regexp_replace(F.lower("place_raw"), "[^a-z0-9]+", ""), F.lit(""))


def block_sizes(people: DataFrame) -> DataFrame:
    """``(block, n)``."""
    return people.withColumn("place_token", place_token()).groupBy(block_key().alias("block")).agg(F.count("*").alias("n"))


def _matching_blocks(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([difflib.SequenceMatcher(None, x, y).ratio() if x and y else 0.0 for x, y in zip(a, b)])


def ratio(a: Column, b: Column) -> Column:
    """K2: the share of matching blocks; equal texts never leave the JVM."""
    blocks = F.pandas_udf(_matching_blocks, "double")
    return F.when((a == b) & (a != ""), F.lit(1.0)).otherwise(blocks(F.coalesce(a, F.lit("")), F.coalesce(b, F.lit(""))))


def birth_similarity(a: Column, b: Column) -> Column:
    """K4."""
    d = F.abs(a - b)
    return F.when(d == 0, 1.0).when(d <= 1, 0.9).when(d <= 3, 0.7).when(d <= 10, 0.4).otherwise(0.0)


def tag_similarity(a: Column, b: Column) -> Column:
    """K6."""
    return F.when((F.size(a) > 0) & (F.size(b) > 0), F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))).otherwise(0.0)


def candidates(people: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """K3, K5, K7, K8: ``(id1, id2, score)``. Blocks without surname or birth year can't
    reach a score of 0.75 and are left out then; no other pair of a block is.

    People of a block that are alike in all that is compared are compared once:
    pairs are those of different forms, and each form with itself."""
    p = people.withColumn("place_token", place_token())
    if min_score > 0.7:
        p = p.filter("surname <> 'unknown' and birth_year is not null")
    p = p.withColumn("block", block_key()).withColumn("tags", F.array_sort("tags"))
    key = ["block", "surname", "given", "birth_year", "place_id", "place_token", "tags"]
    forms = p.groupBy(*key).agg(F.count("*").alias("n"))
    forms = durable(forms.withColumn("form", F.monotonically_increasing_id()))
    right = forms.select("block", *[F.col(c).alias(c + "_b") for c in ("given", "birth_year", "place_id", "place_token", "tags", "form")])
    pairs = forms.join(right, "block").filter("form < form_b or (form = form_b and n > 1)")
    # Within a block the surname, year and place are equal.
    known = (F.col("given") != "unknown") & (F.col("given_b") != "unknown")
    given = F.when(known, ratio(F.col("given"), F.col("given_b"))).otherwise(0.0)
    name = F.when(F.col("surname") == "unknown", 0.0).otherwise(0.7 + 0.3 * given)
    both_ids, typed = F.col("place_id").isNotNull() & F.col("place_id_b").isNotNull(), F.coalesce("place_token", F.lit(""))
    typed_b = F.coalesce("place_token_b", F.lit(""))
    place = F.when(both_ids, 1.0).when((typed == "") & (typed_b == ""), 0.0).otherwise(ratio(typed, typed_b))
    score = 0.40 * name + 0.30 * birth_similarity(F.col("birth_year"), F.col("birth_year_b")) + 0.20 * place + 0.10 * tag_similarity(F.col("tags"), F.col("tags_b"))
    good = durable(pairs.withColumn("score", F.round(score, 9)).filter(F.col("score") >= min_score).select("form", "form_b", "score"))
    same = F.lit(True)
    q = p.select("person_id", *key)
    for c in key:
        same = same & F.col(f"q.{c}").eqNullSafe(F.col(f"f.{c}"))
    of = q.alias("q").join(forms.alias("f"), same).select("person_id", "form")
    a, b = of.select(F.col("person_id").alias("x"), "form"), of.select(F.col("person_id").alias("y"), F.col("form").alias("form_b"))
    out = good.join(a, "form").join(b, "form_b").filter("x <> y and (form <> form_b or x < y)")
    return out.select(F.least("x", "y").alias("id1"), F.greatest("x", "y").alias("id2"), "score")


def clusters(pairs: DataFrame) -> DataFrame:
    """``(person_id, cluster)``, a cluster being named by its least member."""
    c = connected_components(pairs.select(F.col("id1").alias("a"), F.col("id2").alias("b")))
    return c.select(F.col("node").alias("person_id"), F.col("component").alias("cluster"))


def merge_plan(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """Per cluster the least score of all its pairs, a missing pair counting 0:
    ``(cluster, n_members, n_pairs, min_score, max_score, action)``."""
    size = members.groupBy("cluster").agg(F.count("*").alias("n_members"))
    s = pairs.join(members.select(F.col("person_id").alias("id1"), "cluster"), "id1").groupBy("cluster").agg(F.count("*").alias("n_pairs"), F.min("score").alias("lo"), F.max("score").alias("max_score"))
    lo = F.when(F.col("n_pairs") < F.col("n_members") * (F.col("n_members") - 1) / 2, F.lit(0.0)).otherwise(F.col("lo"))
    action = F.when(lo >= AUTO, "auto_merge").when(lo >= REVIEW, "review").otherwise("no_merge")
    return size.join(s, "cluster").select("cluster", "n_members", "n_pairs", lo.alias("min_score"), "max_score", action.alias("action"))


def id_map(people: DataFrame, members: DataFrame, plan: DataFrame) -> DataFrame:
    """``(person_id, new_id)``: members of clusters to merge go to the cluster."""
    merged = members.join(plan.filter("action = 'auto_merge'").select("cluster"), "cluster", "left_semi")
    return people.select("person_id").join(merged, "person_id", "left").select("person_id", F.coalesce("cluster", "person_id").alias("new_id"))


def apply_merges(people: DataFrame, ids: DataFrame) -> DataFrame:
    """One row per new id with its sources and the first values known."""
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col("person_id"))).alias(c)
    return people.join(ids, "person_id").groupBy("new_id").agg(
        F.count("*").alias("n_sources"), F.min("person_id").alias("first_source"), first("given"), first("surname"), first("birth_year"), first("place_id")
    )


def merged_children(children: DataFrame, ids: DataFrame, key: str = "person_id") -> DataFrame:
    """What hangs on people (names, events, families, notes, sources) under the
    new ids: the merged person has all that its members had, each once."""
    m = ids.select(F.col("person_id").alias(key), "new_id")
    return children.join(m, key, "left").withColumn(key, F.coalesce("new_id", key)).drop("new_id").distinct()


def rewrite_members(members: DataFrame, ids: DataFrame, member: str = "member") -> DataFrame:
    """Family members under their new ids, each once."""
    m = ids.select(F.col("person_id").alias(member), "new_id")
    return members.join(m, member, "left").withColumn(member, F.coalesce("new_id", member)).drop("new_id").distinct()


def resolve(people: DataFrame, members: DataFrame, children: dict[str, DataFrame] | None = None, min_score: float = MIN_SCORE) -> dict[str, DataFrame]:
    """The whole way from people to its three outputs: ``candidates``,
    ``summary``, and the registry rewritten (``people``, ``members``, ``id_map`` and
    every table of ``children``)."""
    pairs = durable(candidates(people, min_score))
    groups = clusters(pairs)
    plan = durable(merge_plan(pairs, groups))
    ids = durable(id_map(people, groups, plan))
    out = {"candidates": pairs, "plan": plan, "summary": summary(people, plan, ids), "people": apply_merges(people, ids), "members": rewrite_members(members, ids), "id_map": ids}
    return out | {name: merged_children(df, ids) for name, df in (children or {}).items()}


def summary(people: DataFrame, plan: DataFrame, ids: DataFrame) -> DataFrame:
    """G8."""
    a = plan.agg(F.count("*").alias("n_clusters"), *[F.count_if(F.col("action") == x).alias(f"n_{x}") for x in ("auto_merge", "review", "no_merge")])
    n = ids.agg(F.count("*").alias("n_in"), F.count_distinct("new_id").alias("n_out"))
    # Two results of one row each.
    return n.withColumn("_", F.lit(1)).join(a.withColumn("_", F.lit(1)), "_").drop("_")
