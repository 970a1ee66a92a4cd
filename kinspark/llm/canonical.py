"""Problem 4: mapping free-entered values to a canonical list.

Values are cut into the parts that could name an entry. Parts and names are
sets of character bigrams per word, so the order of words doesn't matter. The
set-similarity join orders bigrams by rarity over the whole column, joins only
the rare prefixes that any pair at the threshold must share, applies the length
and the positional filter, and verifies the Jaccard similarity exactly. Of the
entries a value's parts come near to, the best supported one is kept: for places
the one whose ancestors the other parts name. A value near to no entry is
reported as ``none``.

Which places hold several values is told by the operator of problem 6 from the
whole column. Pairs at the threshold are checked once more by edits, whatever the
order of their words.

Defined results: null and blank values, and values exactly in the canonical
writing, give no row; places that hold several values give none either; a value
without letters is ``none``; where entries share a name and nothing tells them
apart, the least id counts; rows delivered twice count once; an empty list makes
every value ``none``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinspark.functions.dates import let
from kinspark.functions.identity import filled, strip
from kinspark.llm.name_link import MARKED, PLAIN
from kinspark.operators.packed import counted_texts, packed_of
from kinspark.session import durable

JACCARD = 0.44
#: The part of the letters that may be edited.
EDITS = 0.3
#: Words of 64 bits in a signature.
MASKS = 3
#: Least support of a place, and of an occupation.
PLACE_SUPPORT, WORD_SUPPORT = 0.55, 0.5
#: Words that add detail to a place, and abbreviations in names.
DETAIL = r"\b(?:parish|co|county|prov|province|township|nr|near|prob|probably|poss|of|at|by|in|the)\b"
SHORT = [(r"\bst\b", "saint"), (r"\bmt\b", "mount"), (r"\bpt\b", "port"), (r"\bnr\b", "near")]
ANY_OF_THESE = "|".join([DETAIL, *(a for a, _ in SHORT)])


def plain(c: Column) -> Column:
    """Lower case, without marks; everything but letters and digits is a space."""
    t = F.translate(F.lower(c), MARKED + "'’", PLAIN)  # those without a counterpart are deleted
    return F.trim(F.regexp_replace(t, r"[^\p{L}\p{N}]+", " "))


def spelled(c: Column) -> Column:
    """plain() with the abbreviations of place names written out, without details."""

    def changed(t: Column) -> Column:
        for a, b in SHORT:
            t = F.regexp_replace(t, a, b)
        return F.trim(F.regexp_replace(F.regexp_replace(t, DETAIL, " "), " +", " "))

    return let(plain(c), lambda t: F.when(t.rlike(ANY_OF_THESE), changed(t)).otherwise(t))


def bigrams(c: Column) -> Column:
    """The set of bigrams of the words of a plain() text, each with its two ends."""
    ends = F.concat(F.lit("^"), F.replace(c, F.lit(" "), F.lit("$^")), F.lit("$"))
    # Those across the gap between words are none.
    return F.array_distinct(F.regexp_extract_all(ends, F.lit(r"(?s)(?=((?!\^\$|\$\^)..))"), F.lit(1)))


def bigram_rows(df: DataFrame, key: str) -> DataFrame:
    """``(key, t)``. The set is no column before it is taken apart: Spark would filter
    by it and so make it three times."""
    return df.select(key, F.explode(bigrams(F.col(key))).alias("t"))


def marks(t: Column) -> list[Column]:
    """One of 64 * MASKS bits as words m0, m1, ...; those of a set, or-ed, are a quick
    bound on what two sets can share."""
    bit = F.pmod(F.xxhash64(t), F.lit(64 * MASKS)).cast("int")
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(bit, F.lit(64)))
    return [F.when(F.floor(bit / 64) == i, one).otherwise(F.lit(0).cast("long")).alias(f"m{i}") for i in range(MASKS)]


def df_conf(df: DataFrame, key: str) -> str:
    return df.sparkSession.conf.get(key)


def jaccard(a: Column, b: Column) -> Column:
    both = F.size(F.array_intersect(a, b))
    return both / (F.size(a) + F.size(b) - both)


def similar(parts: DataFrame, names: DataFrame, least: float = JACCARD, also: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """``(part, name, sim)`` for all pairs of a part and a name with a Jaccard
    similarity of ``least`` or more that fulfil ``also``. ``parts``: ``(part)``,
    ``names``: ``(name)``."""
    # A few bytes here make many candidates: keep as many tasks as the session sets.
    p = parts.select("part").repartition(int(df_conf(parts, "spark.sql.shuffle.partitions")), "part").distinct()
    n = durable(names.select("name").distinct())
    # Rare in the list first, then in the column: the shortest postings are joined.
    both = bigram_rows(p, "part").select("t", F.lit(0).alias("in_list")).unionByName(bigram_rows(n, "name").select("t", F.lit(1).alias("in_list")))
    rarity = durable(both.groupBy("t").agg(F.struct(F.sum("in_list").alias("a"), F.count("*").alias("b")).alias("df")).select("t", "df", *marks(F.col("t"))))

    def prefixed(df: DataFrame, key: str) -> DataFrame:
        """One row per token of the prefix, with its position, the set's size and
        its signature."""
        ranked = (
            bigram_rows(df, key)
            .join(rarity, "t")
            .groupBy(key)
            .agg(F.sort_array(F.collect_list(F.struct("df", "t"))).alias("s"), F.count("*").cast("int").alias("size"), *[F.bit_or(f"m{i}").alias(f"m{i}") for i in range(MASKS)])
        )
        keep = F.col("size") - F.ceil(F.lit(least) * F.col("size")).cast("int") + 1
        spare = F.col("size") - sum(F.bit_count(f"m{i}") for i in range(MASKS))
        cols = [key, "size", "spare", *[f"m{i}" for i in range(MASKS)]]
        return ranked.withColumn("spare", spare).select(*cols, F.posexplode(F.slice("s", F.lit(1), keep)).alias("at", "x")).select(*cols, "at", F.col("x.t").alias("t"))

    def need(x: Column, y: Column) -> Column:
        """How many tokens sets of these sizes must share."""
        return F.lit(least / (1 + least)) * (x + y) - 1e-9

    a = prefixed(p, "part")
    b = prefixed(n, "name").select("name", "t", *[F.col(c).alias(c + "_b") for c in ("size", "at", *[f"m{i}" for i in range(MASKS)])])
    # Length filter, and positional filter: two sets that share as many tokens as are
    # needed share one that so many tokens follow in both, itself counted. Each name
    # stands for every size a part may have, so others aren't met at all.
    sizes = F.sequence(F.ceil(F.lit(least) * F.col("size_b") - 1e-9).cast("int"), F.floor(F.col("size_b") / least + 1e-9).cast("int"))
    b = b.select("*", F.explode(F.filter(sizes, lambda x: F.col("size_b") - F.col("at_b") >= need(x, F.col("size_b")))).alias("size"))
    short, long, least_shared = F.least("size", "size_b"), F.greatest("size", "size_b"), need(F.col("size"), F.col("size_b"))
    # Bits in common, and bigrams that share a bit, are all that can be common.
    shared = sum(F.bit_count(F.col(f"m{i}").bitwiseAND(F.col(f"m{i}_b"))) for i in range(MASKS)) + F.col("spare")
    near = (F.col("size") - F.col("at") >= least_shared) & (short >= F.lit(least) * long) & (shared >= least_shared)
    if also:
        near = near & also(F.col("part"), F.col("name"))
    # Written, so that the exact similarity isn't pushed below the join.
    found = durable(a.join(b, ["t", "size"]).filter(near).select("part", "name").distinct())
    sets = found.select("part", "name", bigrams(F.col("part")).alias("g"), bigrams(F.col("name")).alias("g_b"))
    # As in bigram_rows(), a filter would make the sets again.
    return sets.select("part", "name", F.explode(F.filter(F.array(jaccard(F.col("g"), F.col("g_b"))), lambda x: x >= least)).alias("sim"))


def few_edits(a: Column, b: Column) -> Column:
    """Whether edits to at most ``EDITS`` of the letters make one the other, whatever
    the order of their words."""
    in_order = lambda c: F.array_join(F.sort_array(F.split(c, " ")), " ")
    most = F.greatest(F.lit(1), (F.greatest(F.length(a), F.length(b)) * EDITS).cast("int"))
    few = lambda x, y: F.call_function("levenshtein", x, y, most) >= 0  # noqa: E731  # beyond the limit it is -1
    return few(a, b) | ((F.contains(a, F.lit(" ")) | F.contains(b, F.lit(" "))) & few(in_order(a), in_order(b)))


def matched(parts: DataFrame, names: DataFrame) -> DataFrame:
    """``(part, name, sim)``: equal names, and for other parts the near ones that few
    edits tell apart."""
    p = durable(parts.select("part").distinct())
    n = durable(names.select("name").distinct())
    same = p.join(n, p["part"] == n["name"], "left_semi").select("part", F.col("part").alias("name"), F.lit(1.0).alias("sim"))
    rest = p.join(n, p["part"] == n["name"], "left_anti")
    return same.unionByName(similar(rest, n, also=few_edits))


def most_words(names: DataFrame) -> int:
    """Words of the longest name of the list, at least one."""
    return names.agg(F.max(F.size(F.split("name", " "))).alias("n")).first()["n"] or 1


def _windows(words: Column, most: int) -> Column:
    """Runs of one to ``most`` words, as ``(pos, text)``."""

    def runs(w: Column, k: int) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.greatest(F.size(w) - k, F.lit(0))), lambda i: i + k <= F.size(w))
        return F.transform(starts, lambda i: F.struct(i.alias("pos"), F.array_join(F.slice(w, i + 1, F.lit(k)), " ").alias("text")))

    return let(words, lambda w: F.flatten(F.array(*[runs(w, k) for k in range(1, most + 1)])))


def place_entries(places_ref: DataFrame) -> DataFrame:
    """``(name, ref_id, ups, depth)``: every name of an entry with its ancestors."""
    base = places_ref.filter("place_id is not null").groupBy("place_id").agg(F.max(F.struct("parent_id", "place_name", "alt_names")).alias("r")).select("place_id", "r.*")
    up = base.select(F.col("place_id").alias("above"), F.col("parent_id").alias("next"))
    lines = base.select("place_id", "place_name", "alt_names", "parent_id", F.array().cast("array<string>").alias("ups"))
    while True:  # one level a round; a loop ends where it comes back
        lines = durable(lines)
        if lines.filter("parent_id is not null").isEmpty():
            break
        fresh = F.col("above").isNotNull() & (F.col("above") != F.col("place_id")) & ~F.array_contains("ups", F.col("parent_id"))
        lines = lines.join(up, F.col("parent_id") == F.col("above"), "left").select(
            "place_id", "place_name", "alt_names", F.when(fresh, F.col("next")).alias("parent_id"), F.when(fresh, F.concat("ups", F.array("parent_id"))).otherwise(F.col("ups")).alias("ups")
        )
    names = F.concat(F.array("place_name"), F.coalesce("alt_names", F.array().cast("array<string>")))
    return lines.select(F.explode(names).alias("raw"), F.col("place_id").alias("ref_id"), "ups", F.size("ups").alias("depth")).select(spelled(F.col("raw")).alias("name"), "ref_id", "ups", "depth").filter("name <> ''").distinct()


def match_places(values: DataFrame, places_ref: DataFrame) -> DataFrame:
    """``(value, ref_id)`` of every distinct value, ``none`` where no entry is meant."""
    entries = durable(place_entries(places_ref))
    # Written once, so the ids stay what they are; they travel in place of the texts.
    values = durable(values.select("value").distinct().withColumn("id", F.monotonically_increasing_id()))
    cut = F.filter(F.transform(F.split(F.col("value"), r"[,()\[\]?;|\n\t]|\s+in\s+"), spelled), lambda x: x != "")
    levels = values.select("id", "value", cut.alias("levels"))
    # A text without levels is searched for names in its words.
    words = F.filter(F.split(F.translate(F.lower("value"), MARKED, PLAIN), r"[\s\p{Z}]+"), lambda w: w != "")
    parts = F.when(
        (F.size("levels") == 1) & (F.size(words) > 2),
        F.transform(_windows(words, most_words(entries)), lambda w: F.struct(w["pos"].alias("pos"), spelled(w["text"]).alias("text"))),
    ).otherwise(F.transform("levels", lambda x, i: F.struct(i.alias("pos"), x.alias("text"))))
    once = F.array_distinct(F.filter(parts, lambda p: p["text"] != ""))
    parts = durable(levels.select("id", F.explode(once).alias("p")).select("id", "p.pos", F.col("p.text").alias("part")))
    found = matched(parts, entries).join(entries, "name").groupBy("part").agg(
        F.collect_set(F.struct("sim", "ref_id", "ups", "depth", F.size(F.split("name", " ")).alias("words"))).alias("c")
    )
    near_to = parts.join(found, "part").groupBy("id").agg(F.collect_list(F.struct("pos", "c")).alias("ps"))
    scored = near_to.select(
        "id",
        F.flatten(
            F.transform(
                "ps",
                lambda p: F.transform(
                    p["c"],
                    lambda c: let(
                        c["sim"] + 0.1 * (c["words"] - 1) + _context(F.col("ps"), p, c),
                        lambda score: F.struct(F.round(score, 6).alias("r"), c["depth"].alias("depth"), _descending(c["ref_id"]).alias("d"), c["ref_id"].alias("ref_id"), score.alias("score")),
                    ),
                ),
            )
        ).alias("s"),
    )
    best = scored.select("id", F.array_max("s")["ref_id"].alias("ref_id"), F.array_max(F.transform("s", lambda x: x["score"])).alias("score"))
    kept = best.select("id", F.when(F.col("score") >= PLACE_SUPPORT, F.col("ref_id")).alias("ref_id"))
    return values.join(kept, "id", "left").select("value", F.coalesce("ref_id", F.lit("none")).alias("ref_id"))


def _descending(ref: Column) -> Column:
    """A text that sorts the other way round, so that the least id is the maximum."""
    return F.translate(ref, "0123456789", "9876543210")


def _context(ps: Column, p: Column, c: Column) -> Column:
    """What the other parts say: half their similarity where they name an ancestor,
    and a deduction where one surely names a higher place that is none."""

    def per(q: Column) -> Column:
        sure = F.exists(q["c"], lambda d: (d["sim"] > 0.8) & (d["depth"] < c["depth"]))
        said = F.aggregate(
            q["c"],
            F.lit(0.0),
            lambda a, d: F.greatest(a, F.when(F.array_contains(c["ups"], d["ref_id"]), d["sim"]).otherwise(0.0)),
            lambda up: F.when(up > 0, up * 0.5).when(sure, F.lit(-0.5)).otherwise(F.lit(0.0)),
        )
        return F.when(q["pos"] == p["pos"], F.lit(0.0)).otherwise(said)

    return F.aggregate(ps, F.lit(0.0), lambda a, q: a + per(q))


def match_words(values: DataFrame, ref: DataFrame, key: str, label: str, alt: str) -> DataFrame:
    """``(value, ref_id)`` of every distinct value against a flat list: the run of
    words most like an entry, the longer one where equally like."""
    names = F.concat(F.array(label), F.coalesce(alt, F.array().cast("array<string>")))
    entries = durable(ref.filter(f"{key} is not null").select(F.explode(names).alias("raw"), F.col(key).alias("ref_id")).select(plain(F.col("raw")).alias("name"), "ref_id").filter("name <> ''").distinct())
    words = F.filter(F.split(plain(F.col("value")), " "), lambda w: w != "")
    parts = durable(values.select("value", F.explode(_windows(words, most_words(entries))).alias("w")).select("value", F.col("w.text").alias("part")).distinct())
    hits = parts.join(matched(parts, entries), "part").join(entries, "name")
    rank = F.struct((F.col("sim") + 0.1 * F.size(F.split("name", " "))).alias("r"), _descending(F.col("ref_id")).alias("d"))
    best = hits.filter(F.col("sim") >= WORD_SUPPORT).groupBy("value").agg(F.max_by("ref_id", rank).alias("ref_id"))
    return values.select("value").distinct().join(best, "value", "left").select("value", F.coalesce("ref_id", F.lit("none")).alias("ref_id"))


def canonical_values(event_records: DataFrame, places_ref: DataFrame, occupations_ref: DataFrame) -> DataFrame:
    """``(event_id, field_name, ref_id)`` of every freely typed place and occupation."""
    rows = event_records.filter("event_id is not null")
    places = rows.filter(filled(F.col("place"))).select("event_id", "place")
    listed = places_ref.filter("full_name is not null").select(F.col("full_name").alias("text")).distinct()
    typed = counted_texts(places, "place")
    # Which fields hold several values is learned from the whole column (problem 6).
    several = packed_of(typed).filter(F.size("vals") > 1).select("text")
    values = typed.select("text").join(listed, "text", "left_anti").join(several, "text", "left_anti").select(F.col("text").alias("value"))
    of_place = durable(match_places(values, places_ref).withColumnRenamed("value", "place"))
    found = places.join(of_place, "place").select("event_id", F.lit("place").alias("field_name"), "ref_id").distinct()

    is_occu = F.contains(F.upper("tag"), F.lit("OCCU")) & (F.upper(strip(F.col("tag"))) == "OCCU")  # most tags need no regular expression
    occu = durable(rows.filter(is_occu & filled(F.col("value_text"))).select("event_id", F.col("value_text").alias("value")))
    labels = occupations_ref.filter("label is not null").select(F.col("label").alias("value")).distinct()
    words = durable(occu.select("value").distinct().join(labels, "value", "left_anti"))
    of_word = durable(match_words(words, occupations_ref, "occupation_id", "label", "alt_labels"))
    return found.unionByName(occu.join(of_word, "value").select("event_id", F.lit("value_text").alias("field_name"), "ref_id").distinct())


def unmatched_values(found: DataFrame) -> DataFrame:
    """Values mapped and not mapped, per field."""
    return found.groupBy("field_name").agg(F.count("*").alias("n_values"), F.count_if(F.col("ref_id") == "none").alias("n_unmatched"))
