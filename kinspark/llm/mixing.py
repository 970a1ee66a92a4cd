"""Problem 9: mixing sources to target weights.

Sizes are tokens of a public tokenizer. Capped water-filling fixes each
source's share: sources that would exceed their allowed repetitions are clamped
there, what they leave goes to the others in proportion to their weights, until
nothing changes. Each document of a source is then taken whole so many times,
and a seeded fraction of them once more, chosen by the hash of the id up to the
hash at which the tokens come nearest to the share.

Defined results: source names are compared trimmed, in lower case and with
blanks as underscores; documents of no target source (null ones too) count for
the size of the mix and are not in it; null and empty texts hold no tokens and
follow their source; targets with a null source, and weights or repetitions that
are null or not positive, take no share. If all sources at their cap are
smaller than the corpus, the mix is as large as they are. With no documents the
mix is empty and the shares are 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kinspark.functions.identity import strip
from kinspark.llm.tokenizer import TOKENIZERS, VOCABULARY, token_counts
from kinspark.session import durable

SEED = 17
#: Hash ranges in which a source's tokens are summed, per round of refinement.
RANGES = 1024


def source_name(c: Column) -> Column:
    return F.regexp_replace(F.lower(strip(c)), r"[\s\p{Z}-]+", "_")


def water_fill(total: float, sources: dict[str, tuple[float, float]]) -> dict[str, float]:
    """Tokens per source. ``sources``: name -> (weight, most tokens it may give)."""
    share = dict.fromkeys(sources, 0.0)
    free = {s for s, (w, most) in sources.items() if w > 0 and most > 0}
    left = total
    while free:
        weight = sum(sources[s][0] for s in free)
        full = {s for s in free if left * sources[s][0] / weight >= sources[s][1]}
        if not full:
            for s in free:
                share[s] = left * sources[s][0] / weight
            return share
        for s in full:
            share[s] = sources[s][1]
        left -= sum(share[s] for s in full)
        free -= full
        if left <= 0:
            return share
    return share


def _draw(c: str, seed: int) -> Column:
    """A hash of the id, even over [0, 2^40)."""
    return F.pmod(F.xxhash64(F.lit(seed), F.col(c)), F.lit(1 << 40))


def _limits(docs: DataFrame, wanted: dict[str, float]) -> dict[str, int]:
    """Per source the hash below which documents hold about the tokens wanted.
    Sums over hash ranges are refined: each round looks into one range."""
    lo, width, before = dict.fromkeys(wanted, 0), 1 << 40, dict.fromkeys(wanted, 0.0)
    spark = docs.sparkSession
    while width > 1 and wanted:
        step = width // RANGES
        at = spark.createDataFrame([(s, lo[s]) for s in wanted], "source string, lo long")
        sums = (
            docs.join(F.broadcast(at), "source")  # one row per target source
            .filter((F.col("h") >= F.col("lo")) & (F.col("h") < F.col("lo") + width))
            .groupBy("source", F.floor((F.col("h") - F.col("lo")) / step).alias("k"))
            .agg(F.sum("n_tokens").alias("n"))
            .collect()  # at most RANGES rows per target source
        )
        by: dict[str, dict[int, int]] = {s: {} for s in wanted}
        for r in sums:
            by[r["source"]][r["k"]] = r["n"]
        for s in wanted:
            k = 0
            while k < RANGES - 1 and before[s] + by[s].get(k, 0) <= wanted[s]:
                before[s] += by[s].get(k, 0)
                k += 1
            lo[s] += k * step
        width = step
    return lo


def mix_plan(documents: DataFrame, targets: DataFrame, seed: int = SEED, folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> tuple[DataFrame, DataFrame]:
    """``mix(doc_id, source, n_tokens, repeats)`` and ``shares`` per source."""
    spark = documents.sparkSession
    goals: dict[str, tuple[float, int]] = {}
    for r in targets.select(source_name(F.col("source")).alias("s"), "weight", "max_repeats").filter("s is not null").collect():  # one row per source
        if (r["weight"] or 0) > 0 and (r["max_repeats"] or 0) > 0:
            goals[r["s"]] = (goals.get(r["s"], (0.0, 0))[0] + float(r["weight"]), max(goals.get(r["s"], (0.0, 0))[1], int(r["max_repeats"])))
    whole = sum(w for w, _ in goals.values()) or 1.0
    # The source travels with the text, so no join brings the counts back to it.
    docs = durable(token_counts(documents.filter("doc_id is not null").withColumn("source", source_name(F.col("source"))), folder, vocabulary, ["source"]))
    have = {r["source"]: int(r["n"] or 0) for r in docs.filter(F.col("source").isin(list(goals) or [""])).groupBy("source").agg(F.sum("n_tokens").alias("n")).collect()}
    total = float(docs.agg(F.sum("n_tokens")).first()[0] or 0)
    share = water_fill(total, {s: (w / whole, float(m * have.get(s, 0))) for s, (w, m) in goals.items()})
    times = {s: (min(int(share[s] // have[s]), goals[s][1]) if have.get(s) else 0) for s in goals}
    rest = {s: share[s] - times[s] * have[s] for s in goals if have.get(s) and times[s] < goals[s][1]}
    rest = {s: t for s, t in rest.items() if t > 0}
    docs = docs.withColumn("h", _draw("doc_id", seed))
    limit = _limits(docs.filter(F.col("source").isin(list(rest) or [""])), rest)
    rows = [(s, goals[s][0] / whole, goals[s][1], times[s], limit.get(s, 0), share[s]) for s in goals]
    plan = spark.createDataFrame(rows, "source string, weight double, max_repeats int, whole int, below long, wanted double")
    mixed = docs.join(F.broadcast(plan), "source").withColumn("repeats", F.col("whole") + (F.col("h") < F.col("below")).cast("int"))  # plan: one row per source
    mix = mixed.filter("repeats > 0").select("doc_id", "source", "n_tokens", "repeats")
    used = mixed.groupBy("source").agg(
        F.sum("n_tokens").alias("available"), F.sum(F.col("n_tokens") * F.col("repeats")).alias("used"), F.max("repeats").alias("most_repeats")
    )
    shares = plan.join(used, "source", "left").select(
        "source",
        F.round("weight", 6).alias("weight"),
        "max_repeats",
        F.coalesce("available", F.lit(0)).alias("available_tokens"),
        F.coalesce("used", F.lit(0)).alias("used_tokens"),
        F.coalesce("most_repeats", F.lit(0)).alias("most_repeats"),
        F.round("wanted", 3).alias("wanted_tokens"),
    )
    all_used = F.sum("used_tokens").over(W.partitionBy(F.lit(0)))  # one row per target source
    shares = shares.withColumn("actual_share", F.round(F.when(all_used > 0, F.col("used_tokens") / all_used).otherwise(0.0), 6))
    return mix, shares
