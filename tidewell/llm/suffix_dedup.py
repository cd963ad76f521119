"""Suffix-array deduplication with threshold-bounded interval expansion.

Bytes that lie in a string of at least `length` bytes that also starts in a document with a smaller
doc_id are removed. repeats.py brings together all places that can share such a string: those with
the same anchor gram. There the suffixes at the anchors are put in order, with the common prefix of
neighbours, which is a sparse suffix array; the bytes before them are its Burrows-Wheeler columns.
Breadth first, by one byte a step, every interval of the order is extended backward: o bytes to the
left leave length - gram - o to the right, so an interval splits by its column's byte and by common
prefixes under length - o. Intervals of one suffix are dropped, and the expansion stops at `length`.

Edge cases. Null text is empty. A null doc_id comes after all others. Rows that repeat doc_id and
text get the same result each; other rows with the same doc_id aren't earlier than one another.
doc_id is a whole number, or text that casts to one. Removed bytes may cut a character, so what is
kept is binary. Texts of any length are taken whole. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import repeats

LENGTH, GRAM = 50, 12
U = np.uint64


def expand(kind, h, order, left, right, seg):
    """Bit o of a row: its window that begins o bytes before the anchor also stands earlier."""
    n, reach = len(h), kind.reach
    wide = np.zeros((n, -(-kind.length // 8) * 8), np.uint8)
    wide[:, : kind.length] = np.where(seg[:, reach:] > 0, seg[:, reach:] - 1, 255)  # 255 is in no UTF-8 text
    words = wide.view(">u8").astype(U)
    sorted_at = np.lexsort((*words.T[::-1], h))
    wide, h, order, left, right = wide[sorted_at], h[sorted_at], order[sorted_at], left[sorted_at], right[sorted_at]
    column = seg[sorted_at, :reach][:, ::-1]
    differ = wide[1:] != wide[:-1]
    prefix = np.where(differ.any(1), differ.argmax(1), kind.length)
    prefix[h[1:] != h[:-1]] = -1
    bits, live, cls = np.zeros(n, U), np.arange(n), np.zeros(n, np.int64)
    for o in range(reach + 1):
        if o:
            cls = repeats.refine(cls, column[live, o - 1].astype(np.int64))
        run = np.append(0, np.cumsum(prefix < kind.length - o))
        key = cls * (n + 1) + run[live]
        whole = np.flatnonzero((left[live] >= o) & (right[live] >= kind.length - o))
        hit = live[whole[repeats.later(order[live[whole]], key[whole])]]
        bits[hit] |= U(1) << U(o)
        # an interval whose suffixes share a gram and o bytes before it, but which holds one suffix only, gives nothing more
        group = repeats.refine(cls, np.append(0, np.cumsum(prefix < kind.gram))[live])
        more = np.bincount(group)[group] > 1
        live, cls = live[more], cls[more]
        if not len(live):
            break
    out = np.empty(n, U)
    out[sorted_at] = bits
    return out


def _finish(kind, docs: pa.Table, side: pa.Table) -> pa.Table:
    texts, _, row = repeats._texts(docs)
    n_bytes, spans, kept = [], [], []
    for lo, hi, data, offs, _, _, gone in repeats.covered(kind, texts, side):
        left = data[~gone]
        ends = np.append(0, np.cumsum(~gone))[offs]
        edge = np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))
        inner = offs[1:-1][gone[offs[1:-1] - 1] & gone[np.minimum(offs[1:-1], len(gone) - 1)] & (offs[1:-1] < len(gone)) & (offs[1:-1] > 0)] if len(gone) else offs[:0]
        cuts = np.unique(inner)  # runs that touch across two texts
        begin, end = np.sort(np.append(np.flatnonzero(edge == 1), cuts)), np.sort(np.append(np.flatnonzero(edge == -1), cuts))
        at = np.searchsorted(begin, offs)
        n_bytes.append(np.diff(offs))
        owner = np.repeat(np.arange(hi - lo), np.diff(at))
        pair = pa.StructArray.from_arrays([pa.array(begin - offs[owner]), pa.array(end - offs[owner])], names=["start", "end"])
        spans.append(pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pair))
        kept.append(pa.Array.from_buffers(pa.binary(), hi - lo, [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(left.tobytes())]))
    take = pa.array(row)
    cols = [docs.column("doc_id").combine_chunks(), docs.column("th").combine_chunks(), pa.array(np.concatenate(n_bytes)).take(take), pa.concat_arrays(spans).take(take), pa.concat_arrays(kept).take(take)]
    return pa.Table.from_arrays(cols, names=["doc_id", "th", "n_bytes", "spans", "kept"])


def deduplicate(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, th (hash of the text), n_bytes, spans (removed runs: start, end in bytes), kept (the other bytes)."""
    kind = repeats.Kind(length, gram, False, False, expand)
    return repeats.chain(docs, kind, _finish, "doc_id long, th long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")


def digest(result: DataFrame) -> DataFrame:
    """The contract's columns from deduplicate()'s."""
    removed = F.col("n_bytes") - F.octet_length("kept")
    return result.select("doc_id", "n_bytes", removed.cast("long").alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
