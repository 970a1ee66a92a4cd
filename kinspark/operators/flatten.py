"""Problem 2: deeply nested records to flat node tables with parent links.

The bodies of an Arrow batch are one byte buffer with list offsets. Structural
characters are found over the whole buffer at once, each opening bracket gets
its container by a search among the brackets one level up, nodes get their
parent through the container, and paths go down level by level with a
vectorised take. No body is walked node by node, and depth is bounded only by
the data.

Defined results: null, blank and malformed bodies, bodies that are no object
and rows with a null key give no rows; a body that names a field twice in one
object, or has anything after its object, is malformed. Children may be an array (nulls and
plain values in it are passed over), one object, null, absent, or a text that
holds any of these as JSON; nested arrays are looked through. A tag that is
absent or no text is null.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinspark.functions.identity import blank_to_null, strip
from kinspark.session import first_delivery

FIELDS = ("tag", "level", "value", "pointer", "lineno")
CHUNK_BYTES = 1 << 21

_OPEN_OBJ, _OPEN_ARR, _COLON, _QUOTE, _COMMA = ord("{"), ord("["), ord(":"), ord('"'), ord(",")


def _quotes(data: np.ndarray) -> np.ndarray:
    """Positions of the quotation marks that no backslash escapes."""
    q = np.flatnonzero(data == _QUOTE)
    bs = np.flatnonzero(data == 92)
    if len(bs) == 0:
        return q
    first = np.concatenate(([True], np.diff(bs) > 1))
    start = bs[first]
    end = bs[np.concatenate((first[1:], [True]))]
    odd_end = end[(end - start) % 2 == 0]
    return q[~np.isin(q - 1, odd_end)]


def _spans_equal(data: np.ndarray, start: np.ndarray, stop: np.ndarray, word: bytes) -> np.ndarray:
    hit = np.flatnonzero(stop - start == len(word))
    out = np.zeros(len(start), bool)
    if len(hit):
        at = start[hit][:, None] + np.arange(len(word))
        out[hit] = (data[at] == np.frombuffer(word, np.uint8)).all(1)
    return out


def _take_text(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> pa.Array:
    """The byte spans as texts, copied out in one gather."""
    size = stop - start
    offsets = np.concatenate(([0], np.cumsum(size))).astype(np.int64)
    at = np.arange(offsets[-1]) + np.repeat(start - offsets[:-1], size)
    return pa.Array.from_buffers(pa.large_utf8(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[at]))])


def _unescape(texts: pa.Array) -> pa.Array:
    """JSON escapes resolved; only texts that have any are touched."""
    has = pc.match_substring(texts, "\\").to_numpy(zero_copy_only=False).astype(bool)
    if not has.any():
        return texts
    at = np.flatnonzero(has)
    plain = [json.loads(f'"{t}"').encode("utf-8", "replace").decode() for t in texts.take(pa.array(at)).to_pylist()]
    return pc.replace_with_mask(texts, pa.array(has), pa.array(plain, pa.large_utf8()))


class _Level:
    """Documents to flatten: bytes, offsets, and what their root nodes hang on.
    A root object has path ``0``, or is a child in a document under a parent."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, rec: np.ndarray, parents: pa.Array | None):
        self.data, self.offsets, self.rec, self.parents = data, offsets, rec, parents


def _flatten(doc: _Level) -> tuple[dict, _Level | None]:
    """The nodes of the documents as columns, and the documents found within texts."""
    data, off = doc.data, doc.offsets
    q = _quotes(data)
    row_q = np.searchsorted(off, q, "right") - 1
    first_q = np.searchsorted(q, off[:-1])
    is_open = (np.arange(len(q)) - first_q[row_q]) % 2 == 0
    q_open, q_close = q[is_open], q[~is_open]
    pos = np.flatnonzero((data == _OPEN_OBJ) | (data == 125) | (data == _OPEN_ARR) | (data == 93) | (data == _COLON) | (data == _COMMA))
    inside = (np.searchsorted(q, pos) - first_q[np.searchsorted(off, pos, "right") - 1]) % 2 == 1
    pos = pos[~inside]
    ch = data[pos]
    opening = (ch == _OPEN_OBJ) | (ch == _OPEN_ARR)
    closing = (ch == 125) | (ch == 93)
    depth_after = np.cumsum(opening.astype(np.int64) - closing)

    o = np.flatnonzero(opening)
    o_pos, o_obj, o_depth = pos[o], ch[o] == _OPEN_OBJ, depth_after[o] - 1
    o_row = np.searchsorted(off, o_pos, "right") - 1
    n = len(o)
    container = np.full(n, -1, np.int64)
    by_depth = np.argsort(o_depth, kind="stable")
    bounds = np.searchsorted(o_depth[by_depth], np.arange((o_depth.max() if n else 0) + 2))
    levels = [by_depth[bounds[d] : bounds[d + 1]] for d in range(len(bounds) - 1)]
    for up, here in zip(levels, levels[1:]):
        container[here] = up[np.searchsorted(o_pos[up], o_pos[here]) - 1]

    # Keys: the text before each colon, the container it stands in, and its value.
    c = np.flatnonzero(ch == _COLON)
    c_pos = pos[c]
    k = np.searchsorted(q_close, c_pos) - 1
    key_start, key_stop = q_open[k] + 1, q_close[k]
    c_depth = depth_after[c] - 1
    c_in = np.full(len(c), -1, np.int64)
    for d, here in enumerate(levels):
        m = np.flatnonzero(c_depth == d)
        c_in[m] = here[np.searchsorted(o_pos[here], c_pos[m]) - 1]
    stop_pos = np.append(pos, len(data))[c + 1]
    v_open = np.searchsorted(o_pos, c_pos, "right")
    opens = np.zeros(len(c), bool)
    inn = v_open < n
    opens[inn] = o_pos[v_open[inn]] == stop_pos[inn]
    vq = np.searchsorted(q_open, c_pos)
    texts = np.zeros(len(c), bool)
    inq = vq < len(q_open)
    texts[inq] = (q_open[vq[inq]] < stop_pos[inq]) & ~opens[inq]

    is_children = _spans_equal(data, key_start, key_stop, b"children")
    child_key = np.zeros(n, bool)
    child_key[v_open[is_children & opens]] = True
    keyed = np.zeros(n, bool)
    keyed[v_open[opens]] = True

    # Level by level: holders (arrays of children) pass their node on.
    node = np.zeros(n, bool)
    owner = np.full(n, -1, np.int64)  # opener of the parent node
    holder = np.zeros(n, bool)
    if levels and len(levels[0]):
        top = levels[0]
        alone = np.bincount(o_row[top], minlength=len(off) - 1)[o_row[top]] == 1
        node[top] = o_obj[top] & alone
        if doc.parents is not None:
            holder[top] = ~o_obj[top]
        for here in levels[1:]:
            up = container[here]
            below_node = node[up] & child_key[here]
            below_holder = holder[up] & ~keyed[here]
            owner[here] = np.where(below_node, up, np.where(below_holder, owner[up], -1))
            live = below_node | below_holder
            node[here] = live & o_obj[here]
            holder[here] = live & ~o_obj[here]

    idx = np.flatnonzero(node)
    m = len(idx)
    slot = np.full(n, -1, np.int64)
    slot[idx] = np.arange(m)
    par = np.where(owner[idx] >= 0, slot[owner[idx]], -1)
    row = o_row[idx]
    # Ordinal among siblings: rank in order of position within one parent, or one document.
    group = np.where(par >= 0, par, m + row)
    order = np.argsort(group, kind="stable")
    g = group[order]
    head = np.concatenate(([0], np.flatnonzero(np.diff(g)) + 1)) if m else np.zeros(0, np.int64)
    ordinal = np.zeros(m, np.int64)
    ordinal[order] = np.arange(m) - np.repeat(head, np.diff(np.append(head, m)))

    depth = np.zeros(m, np.int64)
    by = np.argsort(o_depth[idx], kind="stable")
    for part in np.split(by, np.flatnonzero(np.diff(o_depth[idx][by])) + 1) if m else []:
        depth[part] = np.where(par[part] >= 0, depth[par[part]] + 1, 0)
    rank = np.argsort(depth, kind="stable")
    at_rank = np.empty(m, np.int64)
    at_rank[rank] = np.arange(m)
    text_ord = pc.cast(pa.array(ordinal), pa.large_utf8())
    cuts = np.searchsorted(depth[rank], np.arange((depth.max() if m else 0) + 2))
    paths: list[pa.Array] = []
    ups: list[pa.Array] = []
    for d in range(len(cuts) - 1):
        here = rank[cuts[d] : cuts[d + 1]]
        own = text_ord.take(pa.array(here))
        if d:
            up = paths[-1].take(pa.array(at_rank[par[here]] - cuts[d - 1]))
        elif doc.parents is None:
            ups.append(pa.array([""] * len(here), pa.large_utf8()))
            paths.append(pa.array(["0"] * len(here), pa.large_utf8()))
            continue
        else:
            up = doc.parents.take(pa.array(row[here]))
        ups.append(up)
        paths.append(pc.binary_join_element_wise(up, own, pa.scalar(".", pa.large_utf8())))
    back = pa.array(at_rank)
    empty = pa.array([], pa.large_utf8())
    path = pa.concat_arrays(paths).take(back) if m else empty
    parent = pa.concat_arrays(ups).take(back) if m else empty

    out = {"rec": doc.rec[row], "node_path": path, "parent_path": parent}
    in_node = np.where(c_in >= 0, slot[c_in], -1)
    for field in FIELDS:
        f = np.flatnonzero(_spans_equal(data, key_start, key_stop, field.encode()) & (in_node >= 0) & ~opens)
        at = np.full(m, -1, np.int64)
        at[in_node[f]] = f  # the last of equal keys stays
        have = np.flatnonzero(at >= 0)
        a = at[have]
        quoted = texts[a]
        start = np.where(quoted, q_open[np.minimum(vq[a], max(len(q_open) - 1, 0))] + 1, c_pos[a] + 1)
        stop = np.where(quoted, q_close[np.minimum(vq[a], max(len(q_close) - 1, 0))], stop_pos[a])
        got = _take_text(data, start, stop)
        if quoted.any():
            got = pc.if_else(pa.array(quoted), _unescape(got), pc.utf8_trim_whitespace(got))
        else:
            got = pc.utf8_trim_whitespace(got)
        bare = ~quoted
        null = bare & pc.equal(got, "null").to_numpy(zero_copy_only=False).astype(bool)
        if field == "tag":
            null = bare
        got = pc.if_else(pa.array(null), pa.scalar(None, pa.large_utf8()), got)
        full = np.full(m, -1, np.int64)
        full[have] = np.arange(len(have))
        out[field] = got.take(pa.array(full, mask=full < 0))

    packed = np.flatnonzero(is_children & texts & (in_node >= 0))
    if not len(packed):
        return out, None
    inner = _unescape(_take_text(data, q_open[vq[packed]] + 1, q_close[vq[packed]]))
    good = np.array([_readable(t) for t in inner.to_pylist()], bool)
    packed, inner = packed[good], inner.filter(pa.array(good))
    if not len(packed):
        return out, None
    owner_slot = in_node[packed]
    more = _Level(*_buffers(inner), doc.rec[row[owner_slot]], path.take(pa.array(owner_slot)))
    return out, more


def _readable(text: str) -> bool:
    """Whether a text kept in place of children is JSON."""
    try:
        return isinstance(json.loads(text), (dict, list))
    except ValueError:
        return False


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    texts = texts.cast(pa.large_utf8())
    _, offsets, data = texts.buffers()
    off = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, off - off[0]


def _batches(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, bodies = batch.column(0), batch.column(1)
        if not len(bodies):
            continue
        size = np.cumsum(pc.binary_length(bodies).to_numpy(zero_copy_only=False))
        cuts = np.unique(np.concatenate(([0], np.searchsorted(size, np.arange(CHUNK_BYTES, size[-1], CHUNK_BYTES)), [len(bodies)])))
        for a, b in zip(cuts, cuts[1:]):
            doc: _Level | None = _Level(*_buffers(bodies.slice(a, b - a)), np.arange(a, b), None)
            while doc is not None:
                out, doc = _flatten(doc)
                cols = [keys.take(pa.array(out.pop("rec")))] + [c.cast(pa.string()) for c in out.values()]
                yield pa.RecordBatch.from_arrays(cols, schema=schema)


def flatten_nodes(df: DataFrame, key: str = "record_id", body: str = "body") -> DataFrame:
    """``(key, node_path, parent_path, tag, level, value, pointer, lineno)``: one
    row per node. The root's path is ``0`` with an empty parent path; the n-th
    child of ``p`` is ``p.n``. Tags are trimmed and in upper case; ``level`` and
    ``lineno`` are ints where they can be read as such."""
    kind = dict(df.dtypes)[key]
    rows = df.select(key, body).filter(
        F.col(key).isNotNull() & blank_to_null(F.col(body)).isNotNull() & F.expr(f"try_parse_json(`{body}`)").isNotNull() & F.col(body).rlike(r"(?s)^\s*\{.*\}\s*$")
    )
    schema = pa.schema([(key, {"bigint": pa.int64(), "int": pa.int32()}.get(kind, pa.string()))] + [(c, pa.string()) for c in ("node_path", "parent_path", *FIELDS)])
    ddl = f"`{key}` {kind}, node_path string, parent_path string, " + ", ".join(f"{c} string" for c in FIELDS)
    flat = rows.mapInArrow(lambda it: _batches(it, schema), ddl)
    return flat.select(
        key, "node_path", "parent_path", F.upper(strip(F.col("tag"))).alias("tag"), F.expr("try_cast(trim(level) as int)").alias("level"),
        "value", "pointer", F.expr("try_cast(trim(lineno) as int)").alias("lineno"),
    )


def record_nodes(raw_records: DataFrame) -> DataFrame:
    """The nodes of every record, repeated deliveries counted once."""
    return flatten_nodes(first_delivery(raw_records.select("record_id", "body", "loaded_at"), "record_id"))
