"""Problem 5: variant spellings of names typed by people.

Each name becomes a vector of character n-grams, weighted by their rarity over
the whole table; nicknames count as the given name the table itself shows them
with. A sparse cosine join pairs names of one parish whose birth years, where
known, are at most two apart: only the rare tokens of a vector that could still
reach the threshold are joined, which loses no pair above it. Pairs are then
checked exactly (spellings of one surname; the same given name, or its initial
or abbreviation). Average-linkage clustering groups the individuals: in each
round those that are each other's nearest merge, which gives the same groups as
merging one pair at a time, and no group is ever collected.

Defined results: rows with a null name_id count for nothing; without a pointer
a record stands alone; a null parish or a name without letters is like no
other; a name without a given name or a surname is linked through its pointer
only; a null birth year goes with any. Rows delivered twice count once.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinspark.functions.dates import let
from kinspark.functions.identity import normalize_pointer, strip
from kinspark.session import durable, first_delivery

#: Cosine from which names are a pair, and mean similarity from which groups merge.
COSINE, LINKAGE = 0.42, 0.33
#: Cosine from which the surnames alone are joined.
SURNAME_COSINE = 0.3
YEARS = 2
#: Years of a range by which forms are joined.
SPAN = 5
GIVEN_WEIGHT = 0.6
#: Characters of an n-gram.
GRAM = 2
#: A nickname is learned when it stands so often beside one given name, and mostly there.
NICKNAME_TIMES, NICKNAME_PART = 5, 0.5
#: Titles before and after names.
TITLES = r"(?i)(?<![\p{L}])(?:mrs|miss|mr|ms|dame|sir|rev|dr|capt|col|lieut|sgt|prof|esq|esquire|jr|sr|junior|senior)(?![\p{L}'])\.?,?"
#: Letters with marks and the letters they are written for.
MARKED = "àáâãäåçèéêëìíîïñòóôõöøùúûüýÿ"
PLAIN = "aaaaaaceeeeiiiinoooooouuuuyy"


def _letters(c: Column) -> Column:
    """Lower case without marks, hyphens and points; digits read for letters."""
    return F.regexp_replace(F.translate(F.lower(c), MARKED + "10", PLAIN + "lo"), r"[^a-z ]", "")


def parse_names(df: DataFrame) -> DataFrame:
    """``(name_id, pointer, parish, birth_year, sn, gn, nick)``: surname and given
    name as plain letters, read from the full name, else from the parts."""
    bare = F.regexp_replace(F.regexp_replace(F.coalesce("full_name", F.lit("")), TITLES, " "), r"[\"“”«»(][^\"“”«»()]*[\"“”«»)]", " ")
    full = strip(F.regexp_replace(strip(bare), r"[\s\p{Z}]+", " "))

    def facts(v: Column) -> Column:
        tokens = F.split(v, " ")
        rest = F.slice(tokens, 2, 1 << 20)
        others = F.exists(rest, lambda t: t.rlike(r"\p{Ll}")) | ((F.size(rest) > 0) & F.forall(rest, lambda t: t.rlike(r"^\p{Lu}\.?$")))
        capital = F.element_at(tokens, 1).rlike(r"^[\p{Lu}0-9'’-]{3,}$") & others
        slashed, before = F.regexp_extract(v, r"/([^/]*)/?", 1), F.regexp_extract(v, r"^([^,]*),", 1)
        kind = F.when(slashed != "", "slashed").when(before != "", "comma").when(capital, "capital").when(F.size(tokens) > 1, "last").when(v == "", "parts").otherwise("one")
        return let(F.struct(v.alias("full"), tokens.alias("tokens"), slashed.alias("slashed"), before.alias("before"), kind.alias("kind")), split)

    def split(v: Column) -> Column:
        k, tokens, whole = v["kind"], v["tokens"], v["full"]
        surname = (
            F.when(k == "slashed", v["slashed"]).when(k == "comma", v["before"]).when(k == "capital", F.element_at(tokens, 1)).when(k == "last", F.element_at(tokens, -1))
            .when(k == "parts", F.col("surname")).otherwise(F.coalesce("surname", F.lit("")))
        )
        rest = (
            F.when(k == "slashed", F.regexp_replace(whole, r"/[^/]*/?", " ")).when(k == "comma", F.regexp_replace(whole, r"^[^,]*,", ""))
            .when(k == "capital", F.array_join(F.slice(tokens, 2, 1 << 20), " ")).when(k == "last", F.element_at(tokens, 1)).when(k == "parts", F.col("given")).otherwise(whole)
        )
        given = F.regexp_replace(F.element_at(F.split(strip(_letters(rest)), " +"), 1), "^xp", "chrisp")
        # m and in or rn are read for each other.
        folded = F.regexp_replace(F.regexp_replace(_letters(surname), " ", ""), "in|rn", "m")
        return F.struct(folded.alias("sn"), F.when(given == "jno", "jn").otherwise(given).alias("gn"))

    return df.select(
        "name_id",
        F.coalesce(normalize_pointer(F.col("pointer")), F.concat(F.lit("#"), F.col("name_id").cast("string"))).alias("pointer"),
        "parish",
        "birth_year",
        let(full, facts).alias("n"),
        strip(_letters(F.col("nickname"))).alias("nick"),
    ).select("name_id", "pointer", "parish", "birth_year", "n.sn", "n.gn", "nick")


def learned_nicknames(parsed: DataFrame) -> DataFrame:
    """``(gn, canon)``: nicknames that stand beside one given name in the table."""
    seen = parsed.filter("nick <> '' and length(gn) > 2 and gn <> nick").groupBy("nick", "gn").agg(F.count("*").alias("n"))
    return (
        seen.groupBy("nick")
        .agg(F.max(F.struct("n", "gn")).alias("best"), F.sum("n").alias("all"))
        .filter((F.col("best.n") >= NICKNAME_TIMES) & (F.col("best.n") >= F.lit(NICKNAME_PART) * F.col("all")))
        .select(F.col("nick").alias("gn"), F.col("best.gn").alias("canon"))
    )


def _grams(word: str, mark: str) -> list[str]:
    w = f"^{word}$"
    return sorted({mark + w[i : i + GRAM] for i in range(len(w) - GRAM + 1)})


def tokens(sn: str, gn: str) -> list[tuple[str, float]]:
    """N-grams of the surname, and of the given name at less weight; what may be
    an initial or abbreviation counts by its first letter only."""
    out = [(g, 1.0) for g in _grams(sn, "s")]
    if not gn:
        return out
    out.append(("i" + gn[:1], GIVEN_WEIGHT))
    if len(gn) > 3:
        out += [(g, GIVEN_WEIGHT / 2) for g in _grams(gn, "g")]
    return out


class Weights:
    """Vectors under the document frequencies of tokens; the surname's part and the
    whole are unit vectors each."""

    def __init__(self, df: dict[str, int], n: int):
        self.df, self.n = df, max(n, 1)
        # The rarest token first: this order is the same for all vectors.
        self.place = {t: k for k, t in enumerate(sorted(df, key=lambda t: (df[t], t)))}
        self.vector = lru_cache(maxsize=200_000)(self._vector)

    def __reduce__(self):
        return Weights, (self.df, self.n)

    def _vector(self, sn: str, gn: str) -> tuple[np.ndarray, np.ndarray]:
        """Places of the tokens in ascending order, and their weights."""
        found = sorted((self.place[t], w * math.log(1 + self.n / self.df[t])) for t, w in tokens(sn, gn))
        x = np.array([w for _, w in found])
        return np.array([k for k, _ in found]), x / (math.sqrt(float(x @ x)) or 1.0)

    def prefix(self, sn: str, least: float) -> list[int]:
        """The rarest tokens, until what is left can't reach the threshold alone."""
        at, x = self.vector(sn, "")
        left = 1.0 - np.concatenate(([0.0], np.cumsum(x * x)[:-1]))
        return at[left >= least * least - 1e-9].tolist()

    def cosines(self, a: list[tuple[str, str]], b: list[tuple[str, str]]) -> np.ndarray:
        """The cosine of each pair, all pairs of a batch at once."""
        words = {w: k for k, w in enumerate(dict.fromkeys([*a, *b]))}
        vectors = [self.vector(*w) for w in words]
        width = max((len(at) for at, _ in vectors), default=1)
        at, x = np.full((len(words), width), -1, np.int32), np.zeros((len(words), width))
        for k, (p, v) in enumerate(vectors):
            at[k, : len(p)], x[k, : len(p)] = p, v
        ia, ib = np.array([words[w] for w in a], int), np.array([words[w] for w in b], int)
        out = np.zeros(len(a))
        for i in range(width):  # each token of the one against all tokens of the other
            own = at[ia, i]
            out += x[ia, i] * np.where((at[ib] == own[:, None]) & (own >= 0)[:, None], x[ib], 0.0).sum(1)
        return out


def same_given(a: Column, b: Column) -> Column:
    """Equal, a spelling, an initial or an abbreviation of the other."""

    def short(x: Column, y: Column) -> Column:
        # Every letter of x in order in y, from the same first letter.
        pattern = F.concat(F.lit("^"), F.regexp_replace(x, "(.)", "$1.*"))
        return (F.length(x) < F.length(y)) & (F.length(x) <= 6) & F.regexp_like(y, pattern)

    typo = F.levenshtein(a, b) <= F.when(F.least(F.length(a), F.length(b)) >= 6, 2).when(F.least(F.length(a), F.length(b)) >= 3, 1).otherwise(0)
    return (a == b) | typo | short(a, b) | short(b, a)


def same_surname(a: Column, b: Column) -> Column:
    n = F.greatest(F.length(a), F.length(b))
    return F.levenshtein(a, b) <= F.when(n >= 10, 3).when(n >= 6, 2).otherwise(1)


def spelled_alike(names: DataFrame, weights: Weights, least: float) -> DataFrame:
    """``(parish, sn, sn_b)``, sn <= sn_b: surnames of one parish whose vectors have a
    cosine of ``least`` or more, each with itself too. ``names``: ``(parish, sn)``."""

    def prefixes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(pre=[weights.prefix(s, least) for s in pdf["sn"]])

    post = durable(names.mapInPandas(prefixes, "parish string, sn string, pre array<int>"))
    left = post.select("parish", "sn", "pre", F.explode("pre").alias("t"))
    right = left.select("parish", "t", F.col("sn").alias("sn_b"), F.col("pre").alias("pre_b"))
    # A pair is taken at the first token its prefixes share, so it comes once.
    both = left.join(right.hint("merge"), ["parish", "t"]).filter((F.col("sn") < F.col("sn_b")) & (F.element_at(F.array_intersect("pre", "pre_b"), 1) == F.col("t")))

    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf[weights.cosines([(s, "") for s in pdf["sn"]], [(s, "") for s in pdf["sn_b"]]) >= least]

    pairs = both.select("parish", "sn", "sn_b").mapInPandas(near, "parish string, sn string, sn_b string")
    return pairs.unionByName(names.select("parish", "sn", F.col("sn").alias("sn_b")))


def name_pairs(records: DataFrame, least: float = COSINE, least_surname: float = SURNAME_COSINE) -> DataFrame:
    """``(fa, fb, s)``: pairs of forms that are spellings of one name. A form is
    what records of one parish, year, surname and given name share."""
    forms = durable(
        records.filter("parish is not null and sn <> '' and gn <> ''").select("parish", "birth_year", "sn", "gn").distinct().withColumn(
            "f", F.xxhash64("parish", F.coalesce("birth_year", F.lit(-1)), "sn", "gn")
        )
    )
    words = durable(forms.select("sn", "gn").distinct())

    def all_tokens(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame(Counter(t for s, g in zip(pdf["sn"], pdf["gn"]) for t, _ in tokens(s, g)).items(), columns=["t", "n"])

    counts = words.mapInPandas(all_tokens, "t string, n bigint").groupBy("t").agg(F.sum("n").alias("n"))
    # At most 28 * 28 bigrams of plain letters per kind, and 26 initials.
    weights = Weights({r["t"]: r["n"] for r in counts.collect()}, words.count())

    alike = spelled_alike(forms.select("parish", "sn").distinct(), weights, least_surname)
    alike = alike.filter(same_surname(F.col("sn"), F.col("sn_b")))
    # Either order, so that the earlier year can stand left.
    alike = durable(alike.unionByName(alike.filter("sn <> sn_b").select("parish", F.col("sn_b").alias("sn"), F.col("sn").alias("sn_b"))))
    own = forms.hint("merge")
    left = alike.join(own, ["parish", "sn"]).select("parish", "sn", "sn_b", "birth_year", "gn", "f")
    right = own.select("parish", F.col("sn").alias("sn_b"), F.col("birth_year").alias("birth_year_b"), F.col("gn").alias("gn_b"), F.col("f").alias("f_b"))
    span = lambda y: F.floor(y / SPAN)
    reach = F.when(F.col("birth_year").isNotNull(), F.sequence(span(F.col("birth_year")), span(F.col("birth_year") + YEARS)))
    known = left.filter("birth_year is not null").withColumn("y", F.explode(reach)).join(right.filter("birth_year_b is not null").withColumn("y", span(F.col("birth_year_b"))).hint("merge"), ["parish", "sn_b", "y"])
    known = known.filter((F.col("birth_year_b") - F.col("birth_year")).between(0, YEARS) & ((F.col("birth_year") < F.col("birth_year_b")) | (F.col("f") < F.col("f_b"))))
    unknown = left.filter("birth_year is null").join(right.hint("merge"), ["parish", "sn_b"]).filter("birth_year_b is not null or f < f_b")
    cols = ["f", "f_b", "sn", "gn", "sn_b", "gn_b"]

    def cosines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            s = weights.cosines(list(zip(pdf["sn"], pdf["gn"])), list(zip(pdf["sn_b"], pdf["gn_b"])))
            yield pdf[["f", "f_b", "gn", "gn_b"]].assign(s=s)[s >= least]

    near = known.select(*cols).unionByName(unknown.select(*cols)).mapInPandas(cosines, "f bigint, f_b bigint, gn string, gn_b string, s double")
    pairs = near.filter(same_given(F.col("gn"), F.col("gn_b")))
    same = forms.select(F.col("f").alias("fa"), F.col("f").alias("fb"), F.lit(1.0).alias("s"))
    return pairs.select(F.least("f", "f_b").alias("fa"), F.greatest("f", "f_b").alias("fb"), "s").unionByName(same)


def average_linkage(nodes: DataFrame, links: DataFrame, least: float = LINKAGE) -> DataFrame:
    """``(node, cluster)``. ``nodes``: ``(node, n)`` with sizes; ``links``: ``(a, b,
    w)`` with a < b and the sum of the similarities between their members. Pairs
    without a link are 0 alike. Each round merges all pairs that are each other's
    nearest at a mean similarity of ``least`` or more. At least the pair highest in
    the order of all links merges in every round, so the rounds end by themselves.

    A mean can't exceed the greatest of those it is made of, so a cluster without
    a link of ``least`` never merges, and its links leave the rounds."""
    size = lambda c: nodes.select(F.col("node").alias(c), F.col("n").alias("n" + c))
    edges = links.join(size("a").hint("merge"), "a").join(size("b").hint("merge"), "b").select("a", "b", "na", "nb", "w")
    member = nodes.select("node", F.col("node").alias("cluster"))
    moves: list[DataFrame] = []
    while True:
        edges = durable(edges.withColumn("s", F.col("w") / (F.col("na") * F.col("nb"))))
        # One order over all edges: the nearest of either end is the same edge for both.
        rank = F.struct("s", F.hash("a", "b").alias("h"), "a", "b", "na", "nb")
        near = edges.filter(F.col("s") >= least).select(F.explode(F.array("a", "b")).alias("c"), rank.alias("r")).groupBy("c").agg(F.max("r").alias("r"))
        # Both ends of a pair that merges stand under the same edge.
        pair = near.groupBy("r.a", "r.b", (F.col("r.na") + F.col("r.nb")).alias("m")).agg(F.collect_list(F.struct("c", F.when(F.col("c") == F.col("r.a"), F.col("r.na")).otherwise(F.col("r.nb")).alias("n"))).alias("cs"))
        both = F.size("cs") == 2
        live = durable(pair.select("a", "m", both.alias("both"), F.explode("cs").alias("c")).select(F.col("c.c").alias("c"), F.when(F.col("both"), F.col("a")).otherwise(F.col("c.c")).alias("to"), F.when(F.col("both"), F.col("m")).otherwise(F.col("c.n")).alias("m")))
        if live.isEmpty():
            break
        moves.append(live.filter("c <> to").select(F.col("c").alias("cluster"), "to"))
        for end in ("a", "b"):
            edges = edges.join(live.select(F.col("c").alias(end), F.col("to").alias(end + "2"), F.col("m").alias("m" + end)).hint("merge"), end)
        edges = edges.filter("a2 <> b2")
        turned = F.col("a2") > F.col("b2")
        edges = edges.select(*[F.when(turned, F.col(y)).otherwise(F.col(x)).alias(z) for x, y, z in (("a2", "b2", "a"), ("b2", "a2", "b"), ("ma", "mb", "na"), ("mb", "ma", "nb"))], "w")
        edges = edges.groupBy("a", "b", "na", "nb").agg(F.sum("w").alias("w"))
    for at, into in enumerate(moves, 1):
        member = member.join(into.hint("merge"), "cluster", "left").select("node", F.coalesce("to", "cluster").alias("cluster"))
        if at % 4 == 0:
            member = durable(member)
    return member


def name_clusters(name_records: DataFrame) -> DataFrame:
    """``(name_id, cluster)`` of every name record."""
    cols = ["name_id", "pointer", "full_name", "given", "surname", "nickname", "parish", "birth_year", "loaded_at"]
    parsed = durable(parse_names(first_delivery(name_records.select(*cols), "name_id")))
    canon = learned_nicknames(parsed)
    records = durable(parsed.join(canon, "gn", "left").withColumn("gn", F.coalesce("canon", "gn")).drop("canon", "nick"))
    records = records.withColumn("f", F.xxhash64("parish", F.coalesce("birth_year", F.lit(-1)), "sn", "gn"))
    pairs = durable(name_pairs(records))
    people = records.groupBy(F.col("pointer").alias("node")).agg(F.count("*").alias("n"))
    holds = records.filter("parish is not null and sn <> '' and gn <> ''").groupBy("pointer", "f").agg(F.count("*").alias("k"))
    left, right = (holds.select(F.col("f").alias("f" + x), F.col("pointer").alias("p" + x), F.col("k").alias("k" + x)).hint("merge") for x in "ab")
    links = (
        pairs.join(left, "fa")
        .join(right, "fb")
        .filter("pa <> pb and (fa <> fb or pa < pb)")
        .groupBy(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
        .agg(F.sum(F.col("s") * F.col("ka") * F.col("kb")).alias("w"))
    )
    groups = average_linkage(people, links)
    return records.select("name_id", F.col("pointer").alias("node")).join(groups.hint("merge"), "node").select("name_id", "cluster")


def linked_names(name_records: DataFrame) -> DataFrame:
    """``(name_id_a, name_id_b)``, a < b: every pair of records of one person."""
    c = name_clusters(name_records)
    a, b = c.select(F.col("name_id").alias("name_id_a"), "cluster"), c.select(F.col("name_id").alias("name_id_b"), "cluster")
    return a.join(b.hint("merge"), "cluster").filter("name_id_a < name_id_b").select("name_id_a", "name_id_b")


def name_classes(name_records: DataFrame) -> DataFrame:
    """``(name_id, class_id, n_links)``: the person of every record, named by its
    least name_id, and how many other records the person has."""
    c = durable(name_clusters(name_records))
    sizes = c.groupBy("cluster").agg(F.min("name_id").alias("class_id"), (F.count("*") - 1).alias("n_links"))
    return c.join(sizes.hint("merge"), "cluster").select("name_id", "class_id", "n_links")
