"""Problem 6: several values packed in one field.

A text is cut at every place where a delimiter could stand; spans in quotation
marks are atomic. Over these atoms lies a lattice whose edges are all
runs of atoms. Expectation-maximisation learns from the whole column how often
each value occurs (by its levels between commas) and each kind of delimiter really separates,
until neither changes; Viterbi then takes the most likely way through each lattice. So a name that holds a slash or an ampersand
stays whole because the column knows it, or because the kind of delimiter
hardly ever separates.

Defined results: null and blank texts hold no value; empty values (doubled,
leading or trailing delimiters) are left out and not counted in ``pos``; a
quotation mark that is never closed is plain text; texts with fewer than two
values give no rows. A text longer than any other is treated like any other;
its lattice grows as the square of its delimiters. Should the rates not settle
in ``MAX_ROUNDS``, an error is raised.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinspark.functions.identity import filled, strip
from kinspark.session import durable

#: The expectation ends when no kind's rate and no such part of all counts changes more.
SETTLED = 1e-3
MAX_ROUNDS = 100
#: Texts of a batch of lattices.
BATCH = 5_000
#: How many times oftener a name must stand first than later to be a value of a list.
HEADED = 1.0
#: In what part of its occurrences a name may stand before the same next one in a list.
COMPANY = 0.03
#: Opening quotation mark -> closing one.
QUOTES = {'"': '"', "'": "'", "“": "”", "«": "»", "„": "“", "‘": "’"}
#: Kinds of delimiters, the first that matches counts.
DELIMITERS = [
    ("semicolon", r"\s*;\s*"),
    ("bar", r"\s*\|\s*"),
    ("tab", r" *\t\s*"),
    ("line", r"[ \r]*\n\s*"),
    ("arrow", r"\s*(?:->|=>|→)\s*"),
    ("plus", r"\s+\+\s+"),
    ("slash_apart", r"\s+/\s+"),
    ("slash", r"/"),
    ("ampersand", r"\s+&\s+"),
    ("and", r"\s+and\s+"),
    ("number", r"\s+(?=\(?[0-9]{1,2}\)\s)"),
    ("comma", r"\s*,\s*"),
]
KINDS = [*(k for k, _ in DELIMITERS), "level"]
_KIND = {k: i for i, k in enumerate(KINDS)}
_DELIM = re.compile("|".join(f"(?P<{k}>{p})" for k, p in DELIMITERS), re.I)
_WITHIN = re.compile(r"\s*[/&]\s*|\s+and\s+")
_NUMBER = re.compile(r"\(?([0-9]{1,3})[).]\s*")
_EDGE = " \t\r\n\f\v\u00a0\ufeff\u2007\u202f\u3000"
#: A text without any of these holds one value and needs no lattice.
HINT = r"""[;|\t\n→+/&"“«„‘]|->|=>|(?i:\sand\s)|^\s*'|\s\(?[0-9]{1,2}\)\s"""
_NO_LETTER = re.compile(r"\s+and\s+|[\W_]")
_CHAR_COST = math.log(40.0)


def atoms(text: str, levels: bool = False) -> tuple[list[tuple[int, int]], list[str], list[bool]]:
    """Spans of the atoms, the kind of delimiter after each but the last, and
    whether each is a quoted span. A comma is a delimiter beside quoted spans, and
    with ``levels`` everywhere."""
    spans, kinds, marks = [], [], []
    start, at, end = 0, 0, len(text)
    quoted_before = False
    while True:
        while at < end and at == start and text[at] in _EDGE:
            at += 1
            start = at
        close = QUOTES.get(text[at]) if at < end and at == start else None
        quoted = False
        if close:
            stop = at + 1
            while True:
                stop = text.find(close, stop)
                if stop < 0:
                    break
                if text.startswith(close * 2, stop):
                    stop += 2
                    continue
                rest = text[stop + 1 :].lstrip(_EDGE.replace("\t", "").replace("\n", ""))
                if not rest or _DELIM.match(rest) or _DELIM.match(text, stop + 1):
                    quoted = True
                    break
                stop += 1
            if quoted:
                at = stop + 1
        m = None
        for m in _DELIM.finditer(text, at):
            if m.lastgroup != "comma" or levels or quoted or (m.end() < end and text[m.end()] in QUOTES and quoted_before):
                break
            m = None
        if m is None:
            spans.append((start, end))
            return spans, kinds, [*marks, quoted]
        spans.append((start, m.start()))
        marks.append(quoted)
        beside = quoted or (m.end() < end and text[m.end()] in QUOTES)
        kinds.append("level" if m.lastgroup == "comma" and not beside else m.lastgroup)
        quoted_before = quoted
        start = at = m.end()


def clean(value: str) -> str:
    """Without outer white space, enclosing quotation marks and their doubling."""
    v = value.strip(_EDGE)
    if len(v) >= 2 and v[0] in QUOTES and v[-1] == QUOTES[v[0]]:
        q = v[-1]
        v = v[1:-1].replace(q * 2, q).strip(_EDGE)
    return v


def unnumbered(parts: list[str]) -> list[str]:
    """Without list numbers, where the values that are there count up from 1."""
    found = [(_NUMBER.match(p), p) for p in parts if p]
    if len(found) > 1 and all(m and int(m[1]) == k for k, (m, _) in enumerate(found, 1)):
        return [p[m.end() :] for m, p in found]
    return [p for _, p in found]


def parts(value: str) -> list[str]:
    """What a value is known by: its levels in lower case, the first marked as
    the head; a head that holds a delimiter is also known by its sides. A list
    number is no part of it."""
    v = clean(value)
    m = _NUMBER.match(v)
    levels = [" ".join(x.lower().split()) for x in (v[m.end() :] if m else v).split(",")]
    known = [("h:" if k == 0 else "t:") + x for k, x in enumerate(levels) if x]
    sides = _WITHIN.split(levels[0])
    return known + ["s:" + x for x in sides if x] if len(sides) > 1 else known


def edges(text: str, spans: list[tuple[int, int]], quoted: list[bool]) -> list[tuple[int, int, list[str]]]:
    """``(i, j, parts)`` for every run of atoms i..j-1 that could be one value; a
    quoted span is a value by itself."""
    n, out = len(spans), []
    for i in range(n):
        for j in range(i + 1, n + 1):
            if j - i > 1 and any(quoted[i:j]):
                break
            out.append((i, j, parts(text[spans[i][0] : spans[j - 1][1]])))
    return out


def viterbi(n: int, es) -> list[tuple[int, int]]:
    best, back = [0.0] + [-math.inf] * n, [0] * (n + 1)
    for i, j, w in es:
        if best[i] + w > best[j]:
            best[j], back[j] = best[i] + w, i
    way, j = [], n
    while j:
        way.append((back[j], j))
        j = back[j]
    return way[::-1]


_LATTICE = pa.schema(
    [("id", pa.int64()), ("text", pa.string()), ("n", pa.int64()), ("kinds", pa.list_(pa.int32())), ("starts", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32()))]
    + [("sizes", pa.list_(pa.int32())), ("at", pa.list_(pa.int32())), ("letters", pa.list_(pa.int32())), ("parts", pa.list_(pa.string()))]
)
_DDL = "id bigint, text string, n bigint, kinds array<int>, starts array<int>, ends array<int>, sizes array<int>, at array<int>, letters array<int>, parts array<string>"
_COUNT = pa.schema([("what", pa.string()), ("part", pa.string()), ("c", pa.float64()), ("texts", pa.int64())])
_VALS = pa.schema([("text", pa.string()), ("vals", pa.list_(pa.string()))])


def lattice(text: str, levels: bool) -> tuple[list, ...]:
    """Kinds of the delimiters by number; starts and ends of the edges, how many parts
    each has and which; letters of the distinct parts, and the parts."""
    spans, kinds, quoted = atoms(text, levels)
    own: dict[str, int] = {}
    starts, ends, sizes, at = [], [], [], []
    for i, j, values in edges(text, spans, quoted):
        starts.append(i), ends.append(j), sizes.append(len(values))
        at.extend(own.setdefault(x, len(own)) for x in values)
    return [_KIND[k] for k in kinds], starts, ends, sizes, at, [len(_NO_LETTER.sub("", x[2:])) for x in own], list(own)


def _lattices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a in range(0, batch.num_rows, BATCH):
            ids, texts, n, levels = (c.to_pylist() for c in batch.slice(a, BATCH).columns)
            columns = zip(*(lattice(t, x) for t, x in zip(texts, levels)))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((ids, texts, n, *columns), _LATTICE)], schema=_LATTICE)


def _flat(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, pa.Array]:
    """Offsets and values of a list column; a null is an empty list."""
    c = batch.column(name)
    size = np.nan_to_num(pc.list_value_length(c).to_numpy(zero_copy_only=False).astype(float)).astype(np.int64)
    return np.concatenate((np.zeros(1, np.int64), np.cumsum(size))), pc.list_flatten(c)


class Batch:
    """The lattices of many texts as arrays, with the log weight of every edge: that of
    its parts, of the delimiters kept within, and of the cut after. Known parts have
    their log probability; others share the mass ``new`` by their letters."""

    def __init__(self, batch: pa.RecordBatch, new: float, cut: dict[str, tuple[float, float]]):
        whole = lambda name: (lambda o, v: (o, v.to_numpy(zero_copy_only=False)))(*_flat(batch, name))
        self.rows = batch.num_rows
        self.n = batch.column("n").to_numpy(zero_copy_only=False).astype(float)
        self.koff, self.kinds = whole("kinds")
        self.eoff, self.start = whole("starts")
        self.end = whole("ends")[1]
        sizes, at = whole("sizes")[1], whole("at")
        self.poff, letters = whole("letters")
        self.text = np.repeat(np.arange(self.rows), np.diff(self.eoff))  # of each edge
        self.edge = np.repeat(np.arange(len(sizes)), sizes)  # of each part in an edge
        self.part = at[1] + np.repeat(self.poff[:-1], np.diff(at[0]))
        # The parts come in any order, each with its number in its text.
        off, e = _flat(batch, "e")
        place = np.empty(len(letters), np.int64)
        place[np.repeat(self.poff[:-1], np.diff(off)) + e.field("k").to_numpy(zero_copy_only=False)] = np.arange(len(e))
        self.parts = e.field("part").take(pa.array(place))
        lp = e.field("lp").to_numpy(zero_copy_only=False)[place]
        lp = np.where(np.isnan(lp), new - 2.0 - _CHAR_COST * letters, lp)
        what = pc.utf8_slice_codeunits(self.parts, 0, 1)
        sums = {}
        for kind in "ths":
            own = pc.equal(what, kind).to_numpy(zero_copy_only=False)[self.part]
            sums[kind] = np.bincount(self.edge, lp[self.part] * own, len(sizes)), np.bincount(self.edge, own, len(sizes)) > 0
        heads, sides = sums["h"][0], sums["s"][0]
        # A misspelt name that holds a delimiter is still known by its sides.
        w = sums["t"][0] + np.where(sums["s"][1], np.maximum(heads, sides), heads)
        cuts, keeps = (np.array([cut[k][x] for k in KINDS]) for x in (0, 1))
        kept = np.concatenate((np.zeros(1), np.cumsum(keeps[self.kinds])))
        base = self.koff[self.text]
        w += kept[base + self.end - 1] - kept[base + self.start]
        self.after = np.where(base + self.end - 1 < self.koff[self.text + 1], base + self.end - 1, -1)
        self.w = w + np.where(self.after >= 0, cuts[self.kinds[self.after]], 0.0) if len(self.kinds) else w

    def _sums(self, group: np.ndarray, other: np.ndarray, first: np.ndarray, down: bool) -> np.ndarray:
        """Log sums over all ways from one end to each node, a step of nodes at a time."""
        node = np.repeat(np.arange(self.rows), np.diff(self.koff) + 2)
        self.base = np.concatenate((np.zeros(1, np.int64), np.cumsum(np.diff(self.koff) + 2)))
        out = np.full(len(node), -np.inf)
        out[first] = 0.0
        key = -group if down else group
        order = np.argsort(key, kind="stable")
        for here in np.split(order, np.flatnonzero(np.diff(key[order])) + 1) if len(order) else []:
            t = self.text[here]
            v = out[self.base[t] + other[here]] + self.w[here]
            head = np.concatenate(([0], np.flatnonzero(np.diff(t)) + 1))
            most = np.maximum.reduceat(v, head)
            most = np.where(np.isfinite(most), most, 0.0)
            total = np.add.reduceat(np.exp(v - np.repeat(most, np.diff(np.append(head, len(v))))), head)
            with np.errstate(divide="ignore"):
                out[self.base[t[head]] + group[here[0]]] = most + np.log(total)
        return out

    def posteriors(self) -> np.ndarray:
        """The probability of each edge."""
        base = np.concatenate((np.zeros(1, np.int64), np.cumsum(np.diff(self.koff) + 2)))
        ends = base[1:] - 1
        up = self._sums(self.end, self.start, base[:-1], False)
        down = self._sums(self.start, self.end, ends, True)
        at = base[self.text]
        return np.exp(np.minimum(0.0, up[at + self.start] + self.w + down[at + self.end] - up[ends[self.text]]))


def _expect(new: float, cut):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, BATCH):
                b = Batch(batch.slice(a, BATCH), new, cut)
                p = b.posteriors()
                mass = b.n[b.text] * p
                count = np.bincount(b.part, (mass * (p > 1e-4))[b.edge], len(b.parts))
                got = np.flatnonzero(count > 0)
                names = b.parts.take(pa.array(got)).dictionary_encode()
                which = names.indices.to_numpy(zero_copy_only=False)
                size = len(names.dictionary)
                last = b.after >= 0
                cuts = np.bincount(b.kinds[b.after[last]], mass[last], len(KINDS)) if last.any() else np.zeros(len(KINDS))
                every = np.bincount(b.kinds, np.repeat(b.n, np.diff(b.koff)), len(KINDS))
                columns = (
                    ["v"] * size + ["cut"] * len(KINDS) + ["all"] * len(KINDS), names.dictionary.to_pylist() + KINDS * 2,
                    np.concatenate((np.bincount(which, count[got], size), cuts, every)), np.concatenate((np.bincount(which, count[got] > 0.05, size), np.zeros(2 * len(KINDS)))).astype(np.int64),
                )
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _COUNT)], schema=_COUNT)

    return run


def _decide(new: float, cut):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            b = Batch(batch, new, cut)
            vals, texts = [], batch.column("text").to_pylist()
            es = list(zip(b.start.tolist(), b.end.tolist(), b.w.tolist()))
            for r, (text, levels) in enumerate(zip(texts, batch.column("levels").to_pylist())):
                spans = atoms(text, levels)[0]
                values = unnumbered([text[spans[i][0] : spans[j - 1][1]].strip(_EDGE) for i, j in viterbi(len(spans), es[b.eoff[r] : b.eoff[r + 1]])])
                vals.append([c for v in values if (c := clean(v))])
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array(vals, pa.list_(pa.string()))], schema=_VALS)

    return run


def _plain_parts(c: Column) -> Column:
    """parts() of a text without delimiters, as an array column."""
    level = F.transform(F.split(F.lower(c), ","), lambda x: strip(F.regexp_replace(x, r"[\s\p{Z}]+", " ")))
    marked = F.transform(level, lambda x, k: F.when(x != "", F.concat(F.when(k == 0, F.lit("h:")).otherwise(F.lit("t:")), x)))
    return F.array_compact(marked)


def _listed(distinct: DataFrame, known: DataFrame) -> DataFrame:
    """The texts whose commas may separate values: each of their parts is better
    known as a head, and their first two parts hardly ever meet otherwise (a place
    keeps company with its next level)."""
    level = F.substring("part", 3, 1 << 30).alias("x")
    heads = known.filter("part like 'h:%'").select(level, F.col("c").alias("h"))
    tails = known.filter("part like 't:%'").select(level, F.col("c").alias("t"))
    headed = heads.join(tails, "x", "left").filter(F.col("h") >= HEADED * F.coalesce("t", F.lit(0.0)) + 1).select("x", "h")
    plain = distinct.filter("not hint and size(parts) > 1")
    rows = plain.select("text", F.size("parts").alias("m"), F.explode("parts").alias("part")).select("text", "m", level)
    every = rows.join(headed, "x").groupBy("text", "m").agg(F.count("*").alias("k")).filter("k = m").select("text")
    first = F.substring(F.element_at("parts", 1), 3, 1 << 30)
    pairs = plain.select("text", "n", first.alias("x"), F.element_at("parts", 2).alias("second"))
    met = pairs.groupBy("x", "second").agg(F.sum("n").alias("met")).join(headed, "x").filter(F.col("met") <= 2 + COMPANY * F.col("h"))
    alone = pairs.join(met, ["x", "second"], "left_semi").select("text")
    return durable(plain.join(every, "text", "left_semi").join(alone, "text", "left_semi"))


def _sizes(known: DataFrame) -> tuple[float, int]:
    """The sum of the counts, and how many parts are seen once."""
    size = known.agg(F.sum("c").alias("n"), F.count_if(F.col("c") < 1.5).alias("once")).first()
    return float(size["n"] or 0.0), size["once"]


def _scored(open_texts: DataFrame, known: DataFrame, beside: tuple[float, int], drop: tuple[str, ...] = ()) -> tuple[DataFrame, float]:
    """The lattices with their parts and the log probabilities of those that are known,
    and the log mass of parts never seen (that of the parts seen once). ``beside``:
    the sizes of what is known of parts that no lattice has."""
    size = _sizes(known)
    total, once = size[0] + beside[0] + 1.0, float(size[1] + beside[1]) + 1.0
    lp = F.log("c") - F.lit(math.log(total + once))
    rows = open_texts.select("id", F.posexplode("parts").alias("k", "part"))
    of_text = rows.join(known, "part", "left").groupBy("id").agg(F.collect_list(F.struct("k", "part", lp.alias("lp"))).alias("e"))
    # The text and its parts don't travel twice.
    return open_texts.drop("parts", *drop).join(of_text, "id", "left"), math.log(once) - math.log(total + once)


def _counted(distinct: DataFrame) -> DataFrame:
    parts = distinct.select("n", F.explode("parts").alias("part"))
    return durable(parts.groupBy("part").agg(F.sum("n").cast("double").alias("c")))


def _moved(before: DataFrame, after: DataFrame) -> float:
    """The part of all counts that differs between two rounds."""
    both = before.select("part", (-F.col("c")).alias("d"), F.lit(0.0).alias("c")).unionByName(after.select("part", F.col("c").alias("d"), "c"))
    r = both.groupBy("part").agg(F.abs(F.sum("d")).alias("d"), F.sum("c").alias("c")).agg(F.sum("d").alias("d"), F.sum("c").alias("c")).first()
    return (r["d"] or 0.0) / (r["c"] or 1.0)


def counted_texts(texts: DataFrame, col: str = "text") -> DataFrame:
    """``(text, n, hint, parts, id)`` of every distinct text that isn't blank: the rows
    that have it, whether it could hold a delimiter and, if not, its parts."""
    distinct = texts.filter(filled(F.col(col))).groupBy(F.col(col).alias("text")).agg(F.count("*").alias("n"))
    hint = F.col("text").rlike(HINT)
    distinct = distinct.withColumn("hint", hint).withColumn("parts", F.when(~F.col("hint"), _plain_parts(F.col("text"))))
    # Written once, so the ids stay what they are.
    return durable(distinct.withColumn("id", F.monotonically_increasing_id()))


def packed_texts(texts: DataFrame, col: str = "text") -> DataFrame:
    """``(text, vals)`` of every distinct text that could hold several values;
    ``vals`` has one entry where it turns out to hold one."""
    return packed_of(counted_texts(texts, col))


def packed_of(distinct: DataFrame) -> DataFrame:
    """packed_texts() of what counted_texts() gives."""
    plain = _counted(distinct.filter("not hint"))

    def lattice_of(some: DataFrame, levels: bool) -> DataFrame:
        lattices = some.select("id", "text", "n", F.lit(levels).alias("levels")).mapInArrow(_lattices, _DDL)
        return durable(lattices.withColumn("levels", F.lit(levels)))

    open_texts = lattice_of(distinct.filter("hint"), False)
    known = plain
    cut = {k: (math.log(0.5), math.log(0.5)) for k in KINDS}
    before, beside = None, (0.0, 0)
    for at in range(MAX_ROUNDS):
        scored, new = _scored(open_texts, known, beside, ("text", "levels"))
        seen = scored.mapInArrow(_expect(new, cut), "what string, part string, c double, texts bigint")
        got = durable(seen.groupBy("what", "part").agg(F.sum("c").alias("c"), F.sum("texts").alias("texts")))
        rate = {(r["what"], r["part"]): r["c"] for r in got.filter("what <> 'v'").collect()}  # two rows per kind of delimiter
        last = dict(cut)
        for k in KINDS:
            p = (rate.get(("cut", k), 0.0) + 0.5) / (rate.get(("all", k), 0.0) + 1.0)
            p = min(max(p, 1e-6), 1 - 1e-6)
            cut[k] = (math.log(p), math.log(1 - p))
        values = got.filter("what = 'v'").select("part", "c")
        if at == 0:
            # Now values are known from packed fields too: lists by comma join the lattice.
            listed = _listed(distinct, plain.unionByName(values.filter("c >= 0.5")).groupBy("part").agg(F.sum("c").alias("c")))
            open_texts = open_texts.unionByName(lattice_of(listed, True))
            lost = listed.select((-F.col("n")).alias("n"), F.explode("parts").alias("part")).groupBy("part").agg(F.sum("n").cast("double").alias("c"))
            plain = durable(plain.unionByName(lost).groupBy("part").agg(F.sum("c").alias("c")).filter("c > 0"))
            # Of parts that no lattice has, which stay as they are, only the sizes matter.
            every = _sizes(plain)
            plain = durable(plain.join(open_texts.select(F.explode("parts").alias("part")).distinct(), "part", "left_semi"))
            own = _sizes(plain)
            beside = every[0] - own[0], every[1] - own[1]
        # What a single text alone supports is no evidence for that text.
        known = durable(
            plain.withColumn("texts", F.lit(2))
            .unionByName(got.filter("what = 'v'").select("part", "c", "texts"))
            .groupBy("part")
            .agg(F.sum("c").alias("c"), F.sum("texts").alias("texts"))
            .filter("texts > 1")
            .drop("texts")
        )
        steady = all(abs(math.exp(cut[k][0]) - math.exp(last[k][0])) <= SETTLED for k in KINDS)
        if at > 1 and steady and _moved(before, values) <= SETTLED:
            break
        before = values
    else:
        raise RuntimeError(f"the rates of delimiters did not settle in {MAX_ROUNDS} rounds")
    scored, new = _scored(open_texts, known, beside)
    return durable(scored.mapInArrow(_decide(new, cut), "text string, vals array<string>"))


def packed_places(event_records: DataFrame) -> DataFrame:
    """``(event_id, pos, val)``: every value of each place field that holds two or
    more, repeated deliveries counted once."""
    rows = event_records.filter("event_id is not null and place is not null").select("event_id", "place")
    split = packed_texts(rows, "place").filter(F.size("vals") > 1)
    packed = rows.join(split, F.col("place") == F.col("text")).select("event_id", "vals").distinct()
    return packed.select("event_id", F.posexplode("vals").alias("pos", "val"))
