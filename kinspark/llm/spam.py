"""Problem 10: keyword-stuffed and link-list pages.

Texts are cut into blocks, and each block is compressed. The ratio is held against
the median of blocks of like length and language, over the whole corpus; blocks far
more redundant than those are *extreme*, and where they also have next to no
sentence punctuation they are confirmed as stuffed.

Redundancy within a block doesn't show a list of links that are all different, or
keywords strewn into sentences. What such blocks share with the confirmed ones are
their words. So the words and pairs of words of all blocks are counted, in confirmed
blocks and in the others; those far more frequent in confirmed blocks are *stuffing*,
and a block covered by stuffing is stuffed as well. The counts are taken again from
all blocks now called stuffed. A page is flagged when more than ``SHARE`` of its
bytes lies in stuffed blocks.

All statistics cover all blocks of all texts. Words are counted by a hash of
``HASHES`` values, so what a task keeps and what the driver collects, the stuffing
alone, are bounded whatever the vocabulary of the corpus.

Defined results: null, empty and blank texts are never flagged; a null or odd
language counts as ``und``; where no block is confirmed only the test by redundancy
and punctuation is left, and where nothing is extreme there is no spam.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinspark.functions.identity import strip
from kinspark.session import durable

#: Characters per block.
WIDE = 400
#: Robust standard deviations below the median from which a block is extreme.
EXTREME = -3.5
#: Blocks by which the norm of all languages weighs in the norm of one.
POOLED = 200
#: Sentence ends per word up to which a block has no sentences.
FEW_STOPS = 0.02
#: Values of the hash of words, and how many times (log) more frequent stuffing is in stuffed blocks.
HASHES, ODDS = 1 << 22, 2.5
#: Stuffed blocks in which stuffing occurs at least.
LEAST_BLOCKS = 3
#: The part of a block's words that is stuffing, and the part of a page's bytes that is stuffed.
COVERED, SHARE = 0.33, 0.5
#: Times the words are counted.
ROUNDS = 2
_STOP = re.compile(r"[.!?…](?=[\"'”’)\]]*(?:\s|$))")
_LETTER = np.zeros(256, bool)
_LETTER[[*range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = True


def blocks(text: str, size: int) -> list[str]:
    """Cuts near multiples of ``size``, at a line end or white space if there is one."""
    out, i, n = [], 0, len(text)
    while i < n:
        j = min(n, i + size)
        if j < n:
            k = text.find("\n", max(i + 1, j - size // 5), j + size // 5)
            if k < 0:
                k = text.find(" ", j, j + size // 5)
            if k > 0:
                j = k
        out.append(text[i:j])
        i = j
    return out


def sentence_density(block: str) -> float:
    return len(_STOP.findall(block)) / max(1, len(block.split()))


def _bucket(size: int) -> int:
    return int(math.log2(size) * 2)


@lru_cache(maxsize=1)
def _compressor():
    import zstandard as Z

    p = Z.ZstdCompressionParameters.from_level(6, source_size=4 * WIDE, write_checksum=False, write_content_size=False, write_dict_id=False)
    return Z.ZstdCompressor(compression_params=p)


def ratio(block: bytes) -> float:
    return len(_compressor().compress(block)) / len(block)


def words(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all words of two letters or more: the part each stands in, its hash, and the
    hash of it and the next word of the part (-1 after the last)."""
    data = np.frombuffer(b" ".join(parts) + b" ", np.uint8)
    ends = np.cumsum([len(p) + 1 for p in parts])
    letter = _LETTER[data]
    edge = np.flatnonzero(np.diff(letter.astype(np.int8), prepend=0))
    start, stop = edge[0::2], edge[1::2]
    long = stop - start > 1
    start, stop = start[long], stop[long]
    # The value of a polynomial over the bytes of a word, from sums over all bytes.
    base = np.uint64(0x100000001B3)
    power = np.cumprod(np.full(len(data), base, np.uint64))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power)))
    back = np.cumprod(np.full(len(data), np.uint64(pow(0x100000001B3, -1, 1 << 64)), np.uint64))
    value = (sums[stop] - sums[start]) * back[start]
    part = np.searchsorted(ends, start, "right")
    mix = lambda v: ((v ^ (v >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - 22)).astype(np.int64)
    own, both = mix(value), np.full(len(value), -1, np.int64)
    if len(value):
        both[:-1] = np.where(part[1:] == part[:-1], mix(value[:-1] * base + value[1:]), -1)
    return part, own, both


def covered(n: int, part: np.ndarray, own: np.ndarray, both: np.ndarray, stuffing: np.ndarray) -> np.ndarray:
    """The part of the words of each block that is stuffing, by itself or with a neighbour."""
    if not len(own):
        return np.zeros(n)
    pair = (both >= 0) & stuffing[both]
    hit = stuffing[own] | pair
    hit[1:] |= pair[:-1]
    return np.bincount(part, hit, n) / np.maximum(np.bincount(part, minlength=n), 1)


class Norms:
    """Medians and robust deviations of the ratio per language and length."""

    def __init__(self, rows: dict[tuple[str, int], tuple[float, float, int]]):
        self.rows = rows

    def deviation(self, block: bytes, lang: str) -> float:
        """Robust standard deviations of the block's ratio from its like."""
        mid, dev = self._of(lang, _bucket(len(block)))
        return (ratio(block) - mid) / dev

    def _of(self, lang: str, bucket: int) -> tuple[float, float]:
        mid, dev, _ = self.rows.get(("*", bucket), (0.0, 1.0, 0))
        own = self.rows.get((lang, bucket))
        if own:
            w = own[2] / (own[2] + POOLED)
            mid, dev = w * own[0] + (1 - w) * mid, w * own[1] + (1 - w) * dev
        return mid, dev

    def confirmed(self, block: str, encoded: bytes, lang: str) -> bool:
        return len(encoded) >= 24 and sentence_density(block) < FEW_STOPS and self.deviation(encoded, lang) < EXTREME


_RATIO = pa.schema([("lang", pa.string()), ("bucket", pa.int32()), ("ratio", pa.float64())])
_COUNT = pa.schema([("h", pa.int32()), ("stuffed", pa.int64()), ("other", pa.int64())])
_SHARE = pa.schema([("doc_id", pa.int64()), ("share", pa.float64())])


def _table(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _cut(batches: Iterator[pa.RecordBatch], docs: int = 256):
    """Some documents at a time: ids, and their blocks as document, language, block, bytes."""
    for batch in batches:
        for a in range(0, batch.num_rows, docs):
            ids, langs, texts = (c.to_pylist() for c in batch.slice(a, docs).columns)
            yield ids, [(k, lang, b, b.encode()) for k, (lang, text) in enumerate(zip(langs, texts)) for b in blocks(text, WIDE)]


def _ratios(batches):
    for _, bs in _cut(batches):
        rows = [(lang, _bucket(len(e)), ratio(e)) for _, lang, _, e in bs if len(e) >= 8]
        yield _table(_RATIO, *(zip(*rows) if rows else ([], [], [])))


def _judged(bs, norms: Norms, stuffing: np.ndarray | None):
    """Words of the blocks, and which blocks are stuffed."""
    part, own, both = words([b.lower().encode() for _, _, b, _ in bs])
    named = [norms.confirmed(b, e, lang) for _, lang, b, e in bs] if stuffing is None else None
    return part, own, both, np.array(named, bool) if stuffing is None else covered(len(bs), part, own, both, stuffing) >= COVERED


def _counted(norms: Norms, stuffing: np.ndarray | None):
    """In how many blocks each word and pair occurs, of the stuffed and the others; at -1
    the blocks themselves."""

    def run(batches):
        counts = np.zeros((2, HASHES), np.int32)
        total = np.zeros(2, np.int64)
        for _, bs in _cut(batches):
            part, own, both, stuffed = _judged(bs, norms, stuffing)
            key = np.unique(np.concatenate((part * HASHES + own, (part * HASHES + both)[both >= 0])))
            of, h = key // HASHES, key % HASHES
            for side in (0, 1):
                x, n = np.unique(h[stuffed[of] == (side == 0)], return_counts=True)
                counts[side, x] += n.astype(np.int32)
            total += [stuffed.sum(), (~stuffed).sum()]
        at = np.flatnonzero(counts.any(0))
        for k in range(0, len(at), 100_000):
            x = at[k : k + 100_000]
            yield _table(_COUNT, x, counts[0, x], counts[1, x])
        yield _table(_COUNT, [-1], total[:1], total[1:])

    return run


def _stuffing(docs: DataFrame, norms: Norms, before: np.ndarray | None) -> np.ndarray:
    """The hashes of words and pairs that are stuffing, as one bit each."""
    seen = docs.mapInArrow(_counted(norms, before), "h int, stuffed bigint, other bigint").groupBy("h").agg(F.sum("stuffed").alias("stuffed"), F.sum("other").alias("other"))
    seen = durable(seen)
    total = seen.filter("h = -1").first()
    out = np.zeros(HASHES, bool)
    if total and total["stuffed"]:
        odds = F.log((F.col("stuffed") + 0.05) / (total["stuffed"] + 0.1)) - F.log((F.col("other") + 0.5) / (total["other"] + 1.0))
        rows = seen.filter((F.col("h") >= 0) & (F.col("stuffed") >= LEAST_BLOCKS) & (odds > ODDS)).select("h").collect()  # of at most HASHES values
        out[[r["h"] for r in rows]] = True
    return out


def block_norms(docs: DataFrame) -> Norms:
    """Median and deviation of the ratio per language and length, over all blocks; ``*``
    stands for all languages. The deviation is that of the upper half, on which
    stuffed blocks, however many, have little weight."""
    r = docs.mapInArrow(_ratios, "lang string, bucket int, ratio double")
    stats = (
        r.select(F.explode(F.array("lang", F.lit("*"))).alias("lang"), "bucket", "ratio")
        .groupBy("lang", "bucket")
        .agg(F.percentile_approx("ratio", [0.5, 0.75], 2000).alias("q"), F.count("*").alias("n"))
        .collect()  # language codes of two or three letters times some twenty lengths
    )
    return Norms({(x["lang"], x["bucket"]): (x["q"][0], max(1.4826 * (x["q"][1] - x["q"][0]), 0.02), x["n"]) for x in stats})


def stuffed_pages(documents: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``(doc_id, share)`` of every document with text."""
    lang = F.lower(strip(F.col("lang")))
    docs = documents.filter(F.col("doc_id").isNotNull() & (strip(F.col("text")) != "")).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.when(lang.rlike("^[a-z]{2,3}$"), lang).otherwise("und").alias("lang"), "text"
    )
    norms = block_norms(docs)
    stuffing = None
    for _ in range(rounds):
        stuffing = _stuffing(docs, norms, stuffing)

    def shares(batches):
        for ids, bs in _cut(batches):
            of = np.array([k for k, *_ in bs], int)
            size = np.array([len(e) for *_, e in bs], float)
            *_, stuffed = _judged(bs, norms, stuffing)
            stuffed |= np.array([not s and norms.confirmed(b, e, lang) for s, (_, lang, b, e) in zip(stuffed, bs)], bool)
            yield _table(_SHARE, ids, np.bincount(of, size * stuffed, len(ids)) / np.maximum(np.bincount(of, size, len(ids)), 1))

    return docs.mapInArrow(shares, "doc_id bigint, share double")


def spam_pages(documents: DataFrame) -> DataFrame:
    """``(doc_id)`` of the pages that mainly consist of stuffed blocks."""
    return stuffed_pages(documents).filter(F.col("share") >= SHARE).select("doc_id").distinct()
