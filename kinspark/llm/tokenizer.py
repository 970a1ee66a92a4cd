"""Problem 8: encoding of the whole corpus with a public byte-level BPE.

The pieces of a batch's texts are made unique and sorted into buckets by
length. A bucket is a padded matrix of token ids; in each round every row looks
up the ranks of its new neighbouring pairs in a hash table, merges its leftmost pair
of minimum rank and the other places of that pair, and closes the gaps; rows
without a pair left leave the matrix. A piece of any length goes this way.

Defined results: an empty list for null and for empty texts; strings that look
like special tokens are ordinary text; texts are encoded as a whole, whatever
their length.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"
#: Fixed value: how this vocabulary's training cut texts into pieces.
PIECES = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pieces whose ids a worker remembers between batches.
REMEMBERED = 400_000
_NONE = np.iinfo(np.int64).max


class PairTable:
    """(left id, right id) -> merged id, by open addressing; ids are ranks."""

    def __init__(self, pairs: np.ndarray, merged: np.ndarray):
        bits = max(4, int(np.ceil(np.log2(len(pairs) * 2.5 + 1))))
        self.shift = np.uint64(64 - bits)
        self.mask = (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.vals = np.full(1 << bits, _NONE, np.int64)
        left = np.arange(len(pairs))
        slot = self._slot(pairs)
        while len(left):
            free = self.keys[slot[left]] == -1
            _, first = np.unique(slot[left[free]], return_index=True)
            put = left[free][first]
            self.keys[slot[put]] = pairs[put]
            self.vals[slot[put]] = merged[put]
            left = left[self.keys[slot[left]] != pairs[left]]
            slot[left] = (slot[left] + 1) & self.mask

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def get(self, key: np.ndarray) -> np.ndarray:
        out = np.full(key.shape, _NONE, np.int64)
        flat, res = key.reshape(-1), out.reshape(-1)
        todo = np.flatnonzero(flat >= 0)
        slot = self._slot(flat[todo])
        while len(todo):
            at = self.keys[slot]
            hit = at == flat[todo]
            res[todo[hit]] = self.vals[slot[hit]]
            on = ~hit & (at != -1)
            todo, slot = todo[on], (slot[on] + 1) & self.mask
        return out


class BytePairEncoder:
    def __init__(self, vocabulary: bytes):
        import regex

        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in vocabulary.splitlines() if line.strip())}
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.width = 1 << 20
        found = [
            (ranks[t[:i]] * self.width + ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks
        ]
        self.pairs = PairTable(np.array([p for p, _ in found], np.int64), np.array([r for _, r in found], np.int64))
        # Ids from which a pair of lower rank than their own can arise.
        self.early = np.zeros(max(ranks.values()) + 1, bool)
        for p, r in found:
            for part in divmod(p, self.width):
                self.early[part] |= r < part
        self.pieces = regex.compile(PIECES)
        self.known: dict[str, np.ndarray] = {}

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return self.pairs.get(np.where(right >= 0, left * self.width + right, -1))

    def _matrix(self, rows: np.ndarray) -> list[np.ndarray]:
        """Rows of ids, padded with -1 at the end, to their merged ids."""
        out: list[np.ndarray] = [None] * len(rows)  # type: ignore[list-item]
        who = np.arange(len(rows))
        # The rank of each id's pair with the next one; none at the end.
        rank = np.full(rows.shape, _NONE, np.int64)
        rank[:, :-1] = self._ranks(rows[:, :-1], rows[:, 1:])
        while len(who):
            best = rank.min(1)
            done = best == _NONE
            for k in np.flatnonzero(done):
                r = rows[k]
                out[who[k]] = r[r >= 0].astype(np.int32)
            rows, who, rank, best = rows[~done], who[~done], rank[~done], best[~done]
            if not len(who):
                break
            # The pair of minimum rank, from the left and wherever else it stands: no
            # merge can come between, but after an id in ``early``.
            hit = rank == best[:, None]
            at = np.arange(rows.shape[1])
            hit &= (at == hit.argmax(1)[:, None]) | ~self.early[best][:, None]
            if (hit[:, 1:] & hit[:, :-1]).any():  # of a run such as aaaa every second
                hit &= (at - np.maximum.accumulate(np.where(hit, 0, at + 1), 1)) % 2 == 0
            rows = np.where(hit, best[:, None], rows)
            live = rows >= 0
            live[:, 1:] &= ~hit[:, :-1]
            size = live.sum(1)
            slot = np.arange(size.max()) < size[:, None]
            closed, ranks, new = np.full(slot.shape, -1, np.int64), np.full(slot.shape, _NONE, np.int64), np.zeros(slot.shape, bool)
            closed[slot], ranks[slot], new[slot] = rows[live], rank[live], hit[live]
            new[:, :-1] |= new[:, 1:]
            i, j = np.nonzero(new)
            inside = j + 1 < closed.shape[1]
            ranks[i[~inside], j[~inside]] = _NONE
            i, j = i[inside], j[inside]
            ranks[i, j] = self._ranks(closed[i, j], closed[i, j + 1])
            rows, rank = closed, ranks
        return out

    def _learn(self, pieces: list[str]) -> None:
        raw = [p.encode() for p in pieces]
        size = np.array([len(b) for b in raw])
        bucket = np.where(size <= 16, size, 1 << np.ceil(np.log2(np.maximum(size, 1))).astype(int))
        for width in np.unique(bucket):
            which = np.flatnonzero(bucket == width)
            step = max(1, (1 << 20) // int(width))
            for a in range(0, len(which), step):
                part = which[a : a + step]
                data = np.frombuffer(b"".join(raw[k] for k in part), np.uint8)
                rows = np.full((len(part), int(width)), -1, np.int64)
                rows[np.arange(int(width)) < size[part][:, None]] = self.byte_ids[data]
                for k, ids in zip(part, self._matrix(rows)):
                    self.known[pieces[k]] = ids

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Offsets and ids of all texts."""
        cut = [self.pieces.findall(t) if t else [] for t in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = {p for ps in cut for p in ps if p not in self.known}
        if new:
            self._learn(list(new))
        runs = [[self.known[p] for p in ps] for ps in cut]
        sizes = [sum(map(len, r)) for r in runs]
        flat = [x for r in runs for x in r]
        return np.concatenate(([0], np.cumsum(sizes))).astype(np.int64), (np.concatenate(flat) if flat else np.zeros(0, np.int32))


@lru_cache(maxsize=4)
def encoder(vocabulary: bytes) -> BytePairEncoder:
    return BytePairEncoder(vocabulary)


def _encoded(path: str, lists: bool):
    """Texts, the last column, replaced by their ids or by their number. The vocabulary,
    a file of about a megabyte, is read once and travels with the job."""
    with open(path, "rb") as f:
        vocabulary = f.read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(vocabulary)
        for batch in batches:
            for a in range(0, batch.num_rows, 1024):
                part = batch.slice(a, 1024)
                *kept, texts = part.columns
                offsets, ids = bpe.encode(texts.to_pylist())
                if lists:
                    last: pa.Array = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids, pa.int32()))
                else:
                    last = pa.array(np.diff(offsets))
                yield pa.RecordBatch.from_arrays([*kept, last], names=[*part.schema.names[:-1], "ids" if lists else "n_tokens"])

    return run


def token_ids(documents: DataFrame, folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> DataFrame:
    """``(doc_id, ids)`` of every document."""
    return documents.select("doc_id", "text").mapInArrow(_encoded(os.path.join(folder, vocabulary), True), "doc_id bigint, ids array<int>")


def token_counts(documents: DataFrame, folder: str = TOKENIZERS, vocabulary: str = VOCABULARY, keep: list[str] | None = None) -> DataFrame:
    """``(doc_id, *keep, n_tokens)`` of every document."""
    cols = ["doc_id", *(keep or [])]
    kinds = dict(documents.dtypes)
    ddl = ", ".join(f"{c} {kinds[c]}" for c in cols) + ", n_tokens bigint"
    return documents.select(*cols, "text").mapInArrow(_encoded(os.path.join(folder, vocabulary), False), ddl)


def count_by_length(documents: DataFrame) -> DataFrame:
    """Documents and tokens per power of two of the token count."""
    n = token_counts(documents)
    return n.groupBy(F.when(F.col("n_tokens") > 0, F.floor(F.log2("n_tokens"))).otherwise(F.lit(-1)).cast("int").alias("log2_tokens")).agg(
        F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")
    )
