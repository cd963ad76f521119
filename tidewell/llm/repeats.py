"""Finds every place of a table's texts whose next `length` symbols also stand earlier.

Symbols are bytes or words. Of each window of `length` symbols the rightmost smallest gram hash is
the window's anchor, so equal windows have their anchor at the same place. What follows is one
chain of shuffles of compact blocks (one row holds many anchors), without loops or a driver step:

1. documents, dealt into buckets, give each anchor's hash and two hashes of 64 bits of its segment:
   all symbols of the windows that can hold the anchor. Exact copies of an earlier text give none.
2. anchors meet by hash range. One whose segment stands earlier is covered with all its windows;
   those left over in groups with several segments are open if they share a half with another one
   (a window that two anchors share takes in half of the reach on one side, so by 12 bits of these
   halves' hashes none is missed, and a false match only costs work).
3. documents give the open anchors' segments, which meet again by hash range; there a method of the
   caller (suffix order with backward extension, or seed extension) decides window by window.
4. documents take the decisions and are rewritten.

The texts are shuffled once; the exchange is reused by the steps that need them. Ranges, buckets and
tasks are counted from the bytes of the input (and are no fewer than spark.sql.shuffle.partitions
asks for), so that what a Python worker holds at once doesn't grow with it. Copies, however many, leave one representative before any
anchor is made. A passage that very many texts share is covered in step 2 at one row an anchor.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import seqs
from .common import nullable, session, size_of, unused

U = np.uint64
#: A segment's two hashes, in a row's bytes and in memory.
SEGMENT = np.dtype([("s", "<u8"), ("s2", "<u8")])
LAST = (1 << 63) - 1  # the place in the order of a null doc_id
#: Bytes of files a bucket (about three times as much text), and the most tasks of a step.
BUCKET, TASKS = 32 << 20, 20_000
ANCHORS, FULL, OPEN, DECIDED, COPY, MET = range(6)
ROW = "rng int, bucket int, kind int, h binary, s binary, doc binary, idx binary, pos binary, mask binary"
_SCHEMA = pa.schema([(n, pa.int32()) for n in ("rng", "bucket", "kind")] + [(n, pa.binary()) for n in ("h", "s", "doc", "idx", "pos", "mask")])


@dataclass(frozen=True)
class Kind:
    length: int  # of a repeat, in symbols
    gram: int  # of an anchor
    inside: bool  # whether earlier places of the same document count
    words: bool
    decide: Callable  # see step 3

    @property
    def reach(self) -> int:
        return self.length - self.gram


def _rows(rows: list[dict]) -> pa.Table:
    return pa.Table.from_pylist(rows, schema=_SCHEMA)


def _array(table: pa.Table, name: str, kind) -> np.ndarray:
    return np.concatenate([np.frombuffer(x, kind) for x in table.column(name).to_pylist()] or [np.zeros(0, kind)])


def _pack(x: np.ndarray, steps: bool) -> bytes:
    """Numbers, or their steps, by planes of bytes, which the shuffle's compression makes small."""
    x = x.view(f"<u{x.itemsize}")
    return np.ascontiguousarray((np.diff(x, prepend=x.dtype.type(0)) if steps else x).view(np.uint8).reshape(-1, x.itemsize).T).tobytes()


def _unpack(table: pa.Table, name: str, kind, steps: bool) -> np.ndarray:
    """The numbers of all rows."""
    size, whole = np.dtype(kind).itemsize, [np.zeros(0, kind)]
    for b in table.column(name).to_pylist():
        x = np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(size, -1).T).view(f"<u{size}").ravel()
        whole.append((np.cumsum(x, dtype=x.dtype) if steps else x).view(kind))
    return np.concatenate(whole)


def _bucket_docs(table: pa.Table):
    """Rows of a bucket in a fixed order: their places in the table, and the number of each among distinct documents."""
    doc = table.column("doc_id").fill_null(LAST).to_numpy()
    t1, t2 = table.column("th").to_numpy(), table.column("th2").to_numpy()
    order = np.lexsort((t2, t1, doc))
    new = np.ones(len(order), bool)
    new[1:] = (doc[order][1:] != doc[order][:-1]) | (t1[order][1:] != t1[order][:-1]) | (t2[order][1:] != t2[order][:-1])
    return order, np.cumsum(new) - 1, new


def _three(x: np.ndarray) -> np.ndarray:
    """The lowest three bytes of numbers."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :3])


def _whole(x: np.ndarray) -> np.ndarray:
    """The numbers of three bytes each."""
    out = np.zeros((len(x) // 3, 8), np.uint8)
    out[:, :3] = x.reshape(-1, 3)
    return out.view("<u8").ravel()


def _symbols(kind: Kind, data, offs):
    if kind.words:
        w = seqs.Words(data, offs, seqs.PLAIN)
        return w.hash() | U(1), w.offs, w
    return data.astype(U) + U(1), offs, None


def _hashes(sym):
    up, down = seqs.powers(len(sym) + 1)
    total = np.zeros(len(sym) + 1, dtype=U)
    np.cumsum(sym * up[: len(sym)], out=total[1:])
    return total, down


def _anchors(kind: Kind, sym, offs):
    """Places of anchors in a block's symbols, with gram hashes, segment hashes and 12 bits for each half of the reach (0: it isn't there)."""
    n, q = len(sym), kind.gram
    if n < kind.length:
        return np.zeros(0, np.int64), np.zeros(0, U), np.zeros(0, SEGMENT), np.zeros((0, 3), np.uint8)
    total, down = _hashes(sym)
    g = seqs.mix((total[q:] - total[:-q]) * down[: n - q + 1])
    v, p, size, span = g, np.arange(len(g), dtype=np.int32), 1, kind.reach + 1
    while size < span:
        shift = min(size, span - size)
        right = v[shift:] <= v[:-shift]
        p = np.where(right, p[shift:], p[:-shift])
        v = np.minimum(v[shift:], v[:-shift])
        size += shift
    p = p[seqs.room(offs, n)[: len(p)] >= kind.length]
    at = p[np.append(True, p[1:] != p[:-1])].astype(np.int64) if len(p) else p.astype(np.int64)
    row = np.searchsorted(offs, at, "right") - 1
    first, last = np.maximum(offs[row], at - kind.reach), np.minimum(offs[row + 1], at + kind.length)
    place = (at - first).astype(U) * U(0x9E3779B97F4A7C15) + (last - at).astype(U) * U(0xC2B2AE3D27D4EB4F)
    s = np.empty(len(at), SEGMENT)
    s["s"] = seqs.mix((total[last] - total[first]) * down[first] + place)
    # a window of the anchor takes at least half of the reach on one of its sides
    half = -(-kind.reach // 2)
    sides = np.zeros(len(at), U)
    for side, (a, b) in enumerate(((at - half, at + q), (at, at + q + half))):
        there = (a >= offs[row]) & (b <= offs[row + 1])
        a, b = a[there], b[there]
        sides[there] |= (U(1) + seqs.mix((total[b] - total[a]) * down[a]) % U(4095)) << U(12 * side)
    total, down = _hashes(seqs.mix(sym.astype(U) ^ U(0xD6E8FEB86659FD93)))  # other values of the symbols, so another hash
    s["s2"] = seqs.mix((total[last] - total[first]) * down[first] + place)
    return at, g[at], s, _three(sides)


def _cut(kind: Kind, bits: int):
    """Step 1."""

    def run(key, docs, copies):
        bucket = key[0].as_py()
        order, number, new = _bucket_docs(docs)
        doc = docs.column("doc_id").fill_null(LAST).to_numpy()[order]
        copied = set(zip(copies.column("doc_id").fill_null(LAST).to_pylist(), copies.column("th").to_pylist(), copies.column("th2").to_pylist(), strict=True))
        t1, t2 = docs.column("th").to_numpy()[order], docs.column("th2").to_numpy()[order]
        is_copy = np.array([(a, b, c) in copied for a, b, c in zip(doc.tolist(), t1.tolist(), t2.tolist(), strict=True)], bool)
        use = np.flatnonzero(new & ~is_copy)
        texts = docs.column("text").combine_chunks().take(pa.array(order[use]))
        found = []
        for lo, _, data, offs in seqs.blocks(texts):
            sym, offs, _ = _symbols(kind, data, offs)
            at, g, s, sides = _anchors(kind, sym, offs)
            row = np.searchsorted(offs, at, "right") - 1
            found.append((g, s, sides, doc[use][lo + row], number[use][lo + row], at - offs[row]))
        rows = [{"rng": -1 - bucket, "bucket": bucket, "kind": COPY, "idx": number[is_copy].astype("<u4").tobytes()}] if is_copy.any() else []
        if found:
            g, s, sides, d, i, p = (np.concatenate(x) for x in zip(*found, strict=True))
            g = seqs.mix(g + U(0x9E3779B97F4A7C15))  # anchors are smallest hashes, so g itself would crowd the first ranges
            rng = (g >> U(64 - bits)).astype(np.int64)
            o = np.argsort(rng, kind="stable")
            cuts = np.searchsorted(rng[o], np.arange((1 << bits) + 1))
            h = _three(g >> U(40 - bits))[o]
            s, sides, d, i, p = (x[o] for x in (s, sides, d.astype("<i8"), i.astype("<u4"), p.astype("<u4")))
            rows += [{"rng": r, "bucket": bucket, "kind": ANCHORS, "h": h[a:b].tobytes(), "s": s[a:b].tobytes(), "doc": _pack(d[a:b], True), "idx": _pack(i[a:b], True), "pos": _pack(p[a:b], False), "mask": sides[a:b].tobytes()} for r, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)) if b > a]
        return _rows(rows)

    return run


def _gather(table: pa.Table, **kinds):
    """The arrays of all rows of a range, each with its bucket."""
    size = [len(x) // 4 for x in table.column("idx").to_pylist()]
    return [np.repeat(table.column("bucket").to_numpy(), size)] + [_array(table, n, k) for n, k in kinds.items()]


def _deal(kind: int, bucket, **columns) -> list[dict]:
    """One row for each bucket."""
    if not len(bucket):
        return []
    o = np.argsort(bucket, kind="stable")
    own, at = np.unique(bucket[o], return_index=True)
    ends = np.append(at[1:], len(o))
    return [{"rng": -1 - int(b), "bucket": int(b), "kind": kind} | {n: x[o[a:e]].tobytes() for n, x in columns.items()} for b, a, e in zip(own, at, ends, strict=True)]


def _meet(kind: Kind):
    """Step 2."""

    def run(key, table):
        rng = key[0].as_py()
        if rng < 0:
            return table.select(_SCHEMA.names)
        bucket, h, s, sides = _gather(table, h="u1", s=SEGMENT, mask="u1")
        h, sides = _whole(h), _whole(sides)
        doc, idx, pos = _unpack(table, "doc", "<i8", True), _unpack(table, "idx", "<u4", True), _unpack(table, "pos", "<u4", False)
        o = np.argsort(h)
        same = h[o][1:] == h[o][:-1]
        o = o[np.append(same, False) | np.append(False, same)]  # of hashes that come more than once
        if not len(o):
            return _rows([])
        o = o[np.lexsort((pos[o], idx[o], bucket[o], doc[o], s["s2"][o], s["s"][o], h[o]))]
        bucket, h, s, sides, doc, idx, pos = (x[o] for x in (bucket, h, s, sides, doc, idx, pos))
        new = np.append(True, (h[1:] != h[:-1]) | (s["s"][1:] != s["s"][:-1]) | (s["s2"][1:] != s["s2"][:-1]))
        first = np.maximum.accumulate(np.where(new, np.arange(len(o)), 0))
        covered = ~new if kind.inside else doc > doc[first]
        group = np.cumsum(np.append(True, h[1:] != h[:-1])) - 1
        many = np.bincount(group, new) > 1
        at = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
        if not kind.inside:
            many &= np.minimum.reduceat(doc, at) < np.maximum.reduceat(doc, at)
        wait = np.flatnonzero(~covered & many[group])
        # whoever shares neither half with another one of its group shares no window with it
        halves = np.stack([sides[wait] & U(4095), sides[wait] >> U(12)], 1).astype(np.int64)
        near = np.zeros(len(wait), bool)
        for half in halves.T:
            _, inv, count = np.unique(group[wait] << 12 | half, return_inverse=True, return_counts=True)
            near |= (half > 0) & (count[inv] > 1)
        wait = wait[near]
        full = U(rng) << U(32) | h
        pick = lambda m: {"idx": idx[m].astype("<u4"), "pos": pos[m].astype("<u4")}
        # a row for each bucket: covered places in idx and pos, open ones in h, s and mask
        rows = {r["bucket"]: r for r in _deal(MET, bucket[covered], **pick(covered))}
        for r in _deal(MET, bucket[wait], h=full[wait].astype("<u8"), s=idx[wait].astype("<u4"), mask=pos[wait].astype("<u4")):
            rows[r["bucket"]] = {"idx": b"", "pos": b""} | rows.get(r["bucket"], {}) | r
        return _rows([{"h": b"", "s": b"", "mask": b""} | r for r in rows.values()])

    return run


def _texts(docs: pa.Table):
    """Distinct documents of a bucket, by number; and the number of each row."""
    order, number, new = _bucket_docs(docs)
    row = np.empty(len(order), np.int64)
    row[order] = number
    return docs.column("text").combine_chunks().take(pa.array(order[new])), docs.column("doc_id").fill_null(LAST).to_numpy()[order[new]], row


def _show(kind: Kind):
    """Step 3, documents' side: left and right reach and the symbols around each open anchor."""

    def run(key, docs, side):
        bucket = key[0].as_py()
        names = side.column("kind").to_numpy()
        out = [side.filter(pa.array(names != MET)).select(_SCHEMA.names)]
        side = side.filter(pa.array(names == MET))
        if side.num_rows:
            out.append(_rows([{"rng": -1 - bucket, "bucket": bucket, "kind": FULL} | {n: b"".join(side.column(n).to_pylist()) for n in ("idx", "pos")}]))
        h, idx, pos = (_array(side, n, k) for n, k in (("h", "<u8"), ("s", "<u4"), ("mask", "<u4")))
        if len(h):
            o = np.argsort(idx, kind="stable")
            h, idx, pos = h[o], idx[o], pos[o].astype(np.int64)
            texts, doc, _ = _texts(docs)
            parts = []
            for lo, hi, data, offs in seqs.blocks(texts):
                a, b = np.searchsorted(idx, [lo, hi])
                if a == b:
                    continue
                sym, offs, _ = _symbols(kind, data, offs)
                row = idx[a:b] - lo
                at = offs[row] + pos[a:b]
                left, right = np.minimum(at - offs[row], kind.reach), np.minimum(offs[row + 1] - at, kind.length)
                places = at[:, None] + np.arange(-kind.reach, kind.length)
                seg = sym[np.clip(places, 0, len(sym) - 1)]
                seg[(places < (at - left)[:, None]) | (places >= (at + right)[:, None])] = 0
                parts.append((left, right, seg.astype("<u8" if kind.words else "<u1")))
            left, right, seg = (np.concatenate(x) for x in zip(*parts, strict=True))
            rng = (h >> U(32)).astype(np.int64)
            o = np.argsort(rng, kind="stable")
            own, first = np.unique(rng[o], return_index=True)
            for r, a, e in zip(own.tolist(), first, np.append(first[1:], len(o)), strict=True):
                m = o[a:e]
                meta = np.stack([left[m], right[m]], 1).astype("<u2").tobytes()
                out.append(_rows([{"rng": r, "bucket": bucket, "kind": OPEN, "h": h[m].tobytes(), "s": seg[m].tobytes(), "doc": doc[idx[m]].astype("<i8").tobytes(), "idx": idx[m].astype("<u4").tobytes(), "pos": pos[m].astype("<u4").tobytes(), "mask": meta}]))
        return pa.concat_tables(out)

    return run


def _judge(kind: Kind):
    """Step 3, where segments meet: a bit for each window of an open anchor, counted from the anchor to the left."""

    def run(key, table):
        if key[0].as_py() < 0:
            return table.select(_SCHEMA.names)
        bucket, h, doc, idx, pos, meta, seg = _gather(table, h="<u8", doc="<i8", idx="<u4", pos="<u4", mask="<u2", s="<u8" if kind.words else "<u1")
        left, right = meta.reshape(-1, 2).astype(np.int64).T
        order = np.empty(len(h), np.int64)
        order[np.lexsort((pos, idx, bucket, doc))] = np.arange(len(h))
        if not kind.inside:
            order = np.unique(doc, return_inverse=True)[1]
        seg = seg.reshape(len(h), -1)
        # by runs of whole groups, so that memory doesn't follow the range
        o, bits, at = np.argsort(h, kind="stable"), np.zeros(len(h), U), 0
        ends = np.append(np.flatnonzero(h[o][1:] != h[o][:-1]) + 1, len(h))
        while at < len(h):
            end = int(ends[max(np.searchsorted(ends, at + 20_000, "right") - 1, np.searchsorted(ends, at, "right"))])
            own = o[at:end]
            bits[own] = kind.decide(kind, h[own], order[own], left[own], right[own], seg[own])
            at = end
        m = bits != 0
        return _rows(_deal(DECIDED, bucket[m], idx=idx[m].astype("<u4"), pos=pos[m].astype("<u4"), mask=bits[m].astype("<u8")))

    return run


def later(order: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Whether the same key has a smaller order."""
    o = np.lexsort((order, key))
    new = np.append(True, key[o][1:] != key[o][:-1])
    first = order[o][np.maximum.accumulate(np.where(new, np.arange(len(o)), 0))]
    out = np.zeros(len(o), bool)
    out[o] = order[o] > first
    return out


def refine(cls: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """Classes split by a symbol; both are small whole numbers."""
    return np.unique(cls * (int(symbol.max(initial=0)) + 1) + symbol, return_inverse=True)[1]


def covered(kind: Kind, texts: pa.Array, side: pa.Table):
    """Blocks of a bucket's distinct texts, with a mask of the symbols that are covered."""
    names = side.column("kind").to_numpy()
    rows = {k: side.filter(pa.array(names == k)) for k in (FULL, DECIDED, COPY)}
    copy = np.zeros(len(texts) + 1, bool)
    copy[_array(rows[COPY], "idx", "<u4")] = True
    starts, ends = [], []
    fi, fp = _array(rows[FULL], "idx", "<u4").astype(np.int64), _array(rows[FULL], "pos", "<u4").astype(np.int64)
    di, dp, dm = (_array(rows[DECIDED], n, k) for n, k in (("idx", "<u4"), ("pos", "<u4"), ("mask", "<u8")))
    for o in range(kind.reach + 1):
        m = (dm >> U(o)) & U(1) == 1
        starts.append((di[m].astype(np.int64), dp[m].astype(np.int64) - o, dp[m].astype(np.int64) - o + kind.length))
    ends.append((fi, fp - kind.reach, fp + kind.length))
    idx, a, b = (np.concatenate(x) for x in zip(*starts, *ends, strict=True))
    o = np.argsort(idx, kind="stable")
    idx, a, b = idx[o], a[o], b[o]
    for lo, hi, data, offs in seqs.blocks(texts):
        sym_offs, words = offs, None
        if kind.words:
            words = seqs.Words(data, offs, seqs.PLAIN)
            sym_offs = words.offs
        n = int(sym_offs[-1])
        change = np.zeros(n + 1, np.int64)
        x, y = np.searchsorted(idx, [lo, hi])
        row = idx[x:y] - lo
        np.add.at(change, np.maximum(a[x:y] + sym_offs[row], sym_offs[row]), 1)
        np.add.at(change, np.minimum(b[x:y] + sym_offs[row], sym_offs[row + 1]), -1)
        gone = np.cumsum(change[:n]) > 0
        long = np.diff(sym_offs) >= kind.length
        gone |= np.repeat(copy[lo:hi] & long, np.diff(sym_offs))
        yield lo, hi, data, offs, sym_offs, words, gone


def chain(docs: DataFrame, kind: Kind, finish: Callable, schema: str, carry: bool = False) -> DataFrame:
    """docs through all steps; finish(kind, table of a bucket's rows, decisions) gives the result's rows; carry: they get row, the other columns of docs, too."""
    spark = session(docs.sparkSession)
    parts, size = int(spark.conf.get("spark.sql.shuffle.partitions")), size_of(docs)
    buckets, tasks = max(2 * parts, size // BUCKET), min(size // BUCKET, TASKS)
    bits = max(4, (max(parts, size // (2 * BUCKET)) - 1).bit_length())
    text = F.coalesce(F.col("text"), F.lit(""))
    others = [F.struct(F.col("text").isNull().alias(unused(docs, "_null")), *(c for c in docs.columns if c != "text")).alias("row")] if carry else []
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), F.xxhash64(F.lit(7), text).alias("th2"), text.alias("text"), *others)
    bucket = F.pmod(F.xxhash64("doc_id", "th", "th2"), F.lit(buckets)).cast("int").alias("bucket")
    dealt = keyed.select(bucket, "doc_id", "th", "th2", "text", *["row"] * carry)
    # copies of a text with a smaller doc_id
    ids = keyed.select("doc_id", "th", "th2").distinct()
    first = ids.groupBy("th", "th2").agg(F.min(F.coalesce("doc_id", F.lit(LAST))).alias("_first"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    copies = ids.join(first, ["th", "th2"]).where(F.coalesce("doc_id", F.lit(LAST)) > F.col("_first")).select(bucket, *(F.col(c).alias(c) for c in ("doc_id", "th", "th2")))
    by = lambda df, name: (df.repartition(tasks, name) if tasks > parts else df).groupBy(name)
    cut = by(dealt, "bucket").cogroup(by(copies, "bucket")).applyInArrow(_cut(kind, bits), ROW)
    met = by(cut, "rng").applyInArrow(_meet(kind), ROW)
    shown = by(dealt, "bucket").cogroup(by(met, "bucket")).applyInArrow(_show(kind), ROW)
    judged = by(shown, "rng").applyInArrow(_judge(kind), ROW)

    def end(key, docs, side):
        out = finish(kind, docs, side)
        return out.append_column("row", nullable(docs.column("row"))) if carry else out

    return by(dealt, "bucket").cogroup(by(judged, "bucket")).applyInArrow(end, schema + (f", row {dealt.schema['row'].dataType.simpleString()}" if carry else ""))
