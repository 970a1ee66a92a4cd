"""Competing claims of events: choice and scores.

``claims(event_key, claim, date_text, place, n_sources, n_notes)``: claim 0 is the
primary one, the others its alternates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kinspark.functions import events as ev
from kinspark.functions.dates import lineage_ymd
from kinspark.functions.places import places_conflict, places_similar


def choose_claims(claims: DataFrame) -> DataFrame:
    """Per event its best score, how many claims reach it, and the
    winner where only one does: ``(event_key, n_claims, best_score, n_best,
    ambiguous, winner)``. Partial aggregates, no group is gathered."""
    scored = claims.withColumn("score", ev.claim_score(F.col("date_text"), F.col("place"), F.col("n_sources"), F.col("n_notes")))
    per = scored.groupBy("event_key", "score").agg(F.count("*").alias("n"), F.min("claim").alias("claim"))
    best = per.groupBy("event_key").agg(F.sum("n").alias("n_claims"), F.max(F.struct("score", "n", "claim")).alias("b"))
    return best.select(
        "event_key", "n_claims", F.col("b.score").alias("best_score"), F.col("b.n").alias("n_best"),
        (F.col("b.n") > 1).alias("ambiguous"), F.when(F.col("b.n") == 1, F.col("b.claim")).alias("winner"),
    )


def settle(claims: DataFrame) -> DataFrame:
    """Every claim with its event's choice: the winner takes place 0 and the
    others follow in their order, unless several are best: then all keep their
    places and the event is ambiguous. ``(event_key, at, claim, date_text, place, score,
    ambiguous)``."""
    choice = choose_claims(claims).select("event_key", "winner", "ambiguous")
    score = ev.claim_score(F.col("date_text"), F.col("place"), F.col("n_sources"), F.col("n_notes"))
    rows = claims.withColumn("score", score).join(choice, "event_key")
    first = F.when(F.col("winner").isNotNull() & (F.col("claim") == F.col("winner")), 0).otherwise(1)
    at = F.row_number().over(W.partitionBy("event_key").orderBy(first, "claim")) - 1
    return rows.select("event_key", at.alias("at"), "claim", "date_text", "place", "score", "ambiguous")


def choice_counts(settled: DataFrame) -> DataFrame:
    """``(n_events, n_with_alternates, n_resolved, n_ties)``."""
    per = settled.groupBy("event_key").agg(F.count("*").alias("n"), F.max("ambiguous").alias("tie"))
    many = F.col("n") > 1
    return per.agg(F.count("*").alias("n_events"), F.count_if(many).alias("n_with_alternates"), F.count_if(many & ~F.col("tie")).alias("n_resolved"), F.count_if(many & F.col("tie")).alias("n_ties"))


def cross_evidence(claims: DataFrame) -> DataFrame:
    """Per event the agreement of its claims less their severe conflicts,
    0-100; 100 where there is one claim. Claims alike are counted together, so the
    pairs compared are those of different dates and places."""
    d = lineage_ymd(F.col("date_text"))
    v = claims.select("event_key", F.coalesce("date_text", F.lit("")).alias("date_text"), F.coalesce("place", F.lit("")).alias("place"), d["y"].alias("y"), d["m"].alias("m"))
    forms = v.groupBy("event_key", "date_text", "place", "y", "m").agg(F.count("*").alias("n"))
    forms = forms.withColumn("f", F.struct("date_text", "place"))
    b = forms.select("event_key", *[F.col(c).alias(c + "_b") for c in ("date_text", "place", "y", "m", "n", "f")])
    pairs = forms.join(b, "event_key").filter("f <= f_b")
    many = F.when(F.col("f") == F.col("f_b"), F.col("n") * (F.col("n") - 1) / 2).otherwise(F.col("n") * F.col("n_b"))
    gap = F.abs(F.col("y") - F.col("y_b"))
    dated, placed = (F.col("date_text") != "") | (F.col("date_text_b") != ""), (F.col("place") != "") | (F.col("place_b") != "")
    same_date = F.coalesce((gap == 0) | ((gap == 1) & F.col("m").isNotNull() & (F.col("m") == F.col("m_b"))), F.lit(False))
    far = F.coalesce(gap >= 10, F.lit(False))
    num = lambda c: c.cast("int") * many
    agg = pairs.groupBy("event_key").agg(
        F.sum(num(dated)).alias("dp"), F.sum(num(dated & same_date)).alias("dm"),
        F.sum(num(placed)).alias("pp"), F.sum(num(placed & places_similar(F.col("place"), F.col("place_b")))).alias("pm"),
        F.sum(num(dated & far) + num(placed & places_conflict(F.col("place"), F.col("place_b")))).alias("severe"),
    )
    share = lambda hit, of: F.when(F.col(of) > 0, F.col(hit) / F.col(of)).otherwise(1.0)
    agreement = F.floor(100 * (0.5 * share("dm", "dp") + 0.5 * share("pm", "pp")))
    return agg.select("event_key", F.greatest(F.lit(0), F.least(F.lit(100), agreement - F.least(F.lit(100), 10 * F.col("severe")))).cast("int").alias("cross_evidence"))


def lifespans(events: DataFrame) -> DataFrame:
    """``(owner, birth_year, death_year)`` of the last dated BIRT and DEAT."""
    y = lineage_ymd(F.col("date_text"))["y"]
    dated = F.coalesce("date_text", F.lit("")) != ""

    def last(tag: str):
        on = (F.col("tag") == tag) & dated
        return F.max_by(F.when(on, y), F.when(on, F.col("ord")))

    return events.groupBy("owner").agg(last("BIRT").alias("birth_year"), last("DEAT").alias("death_year"))


def score_events(events: DataFrame) -> DataFrame:
    """X3-X13 for ``events(event_id, owner, tag, date_text, place, n_sources, ord)``."""
    keyed = events.withColumn("event_key", F.concat_ws("|", "owner", "tag"))
    cross = cross_evidence(keyed)
    e = keyed.join(lifespans(events), "owner", "left").join(cross, "event_key", "left")
    life = ev.lifespan_points(F.col("birth_year"), F.col("death_year"))
    a = ev.date_points(F.col("date_text")) + ev.place_points(F.col("place")) + ev.field_points(F.col("date_text"), F.col("place"), F.col("n_sources")) + life
    e = e.withColumns({"completeness": F.least(F.lit(100), a), "consistency": F.coalesce("cross_evidence", F.lit(100)), "evidence": ev.evidence_points(F.col("n_sources"))})
    e = e.withColumn("hybrid", ev.hybrid_points(F.col("completeness"), F.col("consistency"), F.col("evidence")))
    flags = F.array_join(ev.score_flags(F.col("date_text"), F.col("place"), F.col("n_sources"), life), " ")
    return e.select("event_id", "owner", "tag", "completeness", "consistency", "evidence", "hybrid", ev.ranking(F.col("hybrid")).alias("ranking"), flags.alias("flags"))


def score_summary(scores: DataFrame, by: str | None = None) -> DataFrame:
    """G3 per ``by``, G4 over all."""
    aggs = [
        F.count("*").alias("n_events"), F.round(F.avg("hybrid"), 6).alias("avg_hybrid"), F.min("hybrid").alias("min_hybrid"), F.max("hybrid").alias("max_hybrid"),
        F.count_if(F.col("hybrid") < 40).alias("n_low"), F.count_if(F.col("flags").contains("conflicts")).alias("n_conflicts"),
    ]
    return scores.groupBy(by).agg(*aggs) if by else scores.agg(*aggs)


def first_birth(events: DataFrame) -> DataFrame:
    """The first BIRT of each owner, else the first CHR or BAPM."""
    rank = F.struct(F.when(F.col("tag") == "BIRT", 0).otherwise(1), "ord")
    cols = [c for c in events.columns if c != "owner"]
    hit = events.filter(F.col("tag").isin("BIRT", "CHR", "BAPM"))
    return hit.groupBy("owner").agg(F.min_by(F.struct(*cols), rank).alias("e")).select("owner", "e.*")
