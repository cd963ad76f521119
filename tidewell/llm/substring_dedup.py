"""Substring deduplication by seed and extension, in words.

Words in a window of `length` words whose sequence also starts earlier (in a document with a smaller
doc_id, or before in the same document) are removed. Seeds are winnowed word grams, joined by hash
in repeats.py; a seed whose whole surroundings stand earlier is settled there. The others are
extended both ways, a word at a time: rows stay in one class while their words agree, and a seed
that agrees with an earlier one over o words to the left and length - gram - o to the right is a
repeat over the threshold. Overlapping repeats are merged, which leaves maximal ones.

Edge cases. Null text has no words. A null doc_id comes after all others. Rows that repeat doc_id
and text are one document and get the same result each; different texts with one doc_id are
documents of their own, in a fixed order. doc_id is a whole number, or text that casts to one.
Texts of any length are taken whole. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import repeats
from .common import unused

LENGTH, GRAM = 20, 8
U = np.uint64


def extend(kind, h, order, left, right, seg):
    """Bit o of a row: its window that begins o words before the seed also starts earlier."""
    n, reach, q = len(h), kind.reach, kind.gram
    symbol = np.unique(seg, return_inverse=True)[1].reshape(seg.shape)
    cls = np.unique(h, return_inverse=True)[1]
    for j in range(q):
        cls = repeats.refine(cls, symbol[:, reach + j])
    rights = [cls]
    for t in range(1, reach + 1):
        rights.append(repeats.refine(rights[-1], symbol[:, reach + q + t - 1]))
    bits = np.zeros(n, U)
    for o in range(reach + 1):
        if o:
            cls = repeats.refine(cls, symbol[:, reach - o])
        key = cls * (n + 1) + rights[reach - o]
        whole = np.flatnonzero((left >= o) & (right >= kind.length - o))
        bits[whole[repeats.later(order[whole], key[whole])]] |= U(1) << U(o)
    return bits


def _finish(kind, docs: pa.Table, side: pa.Table) -> pa.Table:
    texts, _, row = repeats._texts(docs)
    n_words, n_removed, kept = [], [], []
    for lo, hi, data, offs, words_at, w, gone in repeats.covered(kind, texts, side):
        stay = ~gone
        count = np.append(0, np.cumsum(stay))
        owner = np.repeat(np.arange(hi - lo), np.diff(words_at))
        last = np.zeros(len(stay), bool)  # the last kept word of its text
        k = np.flatnonzero(stay)
        if len(k):
            last[k[np.append(owner[k][1:] != owner[k][:-1], True)]] = True
        change = np.zeros(len(data) + 2, np.int64)
        np.add.at(change, w.starts[stay], 1)
        np.add.at(change, w.ends[stay] + ~last[stay], -1)  # with the white space after it
        mask = np.cumsum(change[: len(data)]) > 0
        out = np.append(0, np.cumsum(mask))[offs]
        kept.append(pa.Array.from_buffers(pa.string(), hi - lo, [None, pa.py_buffer(out.astype(np.int32).tobytes()), pa.py_buffer(w.bytes[mask].tobytes())]))
        n_words.append(np.diff(words_at))
        n_removed.append(np.diff(words_at) - np.diff(count[words_at]))
    take = pa.array(row)
    cols = [docs.column("doc_id").combine_chunks(), docs.column("th").combine_chunks(), pa.array(np.concatenate(n_words)).take(take), pa.array(np.concatenate(n_removed)).take(take), pa.concat_arrays(kept).take(take)]
    return pa.Table.from_arrays(cols, names=["doc_id", "th", "n_words", "n_removed", "kept"])


def deduplicate(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, th (hash of the text), n_words, n_removed, kept (the words left, joined by one blank)."""
    kind = repeats.Kind(length, gram, True, True, extend)
    return repeats.chain(docs, kind, _finish, "doc_id long, th long, n_words long, n_removed long, kept string")


def cleaned(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """docs with what is left of each text; texts that lose nothing keep their white space, and n_chars follows the text."""

    def finish(kind, rows: pa.Table, side: pa.Table) -> pa.Table:
        out = _finish(kind, rows, side)
        text = pc.if_else(pc.greater(out.column("n_removed"), 0), out.column("kept"), rows.column("text").cast(pa.string()))
        return pa.table({"text": text})

    kind = repeats.Kind(length, gram, True, True, extend)
    out = repeats.chain(docs, kind, finish, "text string", carry=True)
    text = F.when(~F.col(f"row.{unused(docs, '_null')}"), F.col("text"))
    cols = [text.alias(c) if c == "text" else F.coalesce(F.length(text), F.col("row.n_chars")).cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(f"row.`{c}`") for c in docs.columns]
    return out.select(*cols)


def digest(result: DataFrame) -> DataFrame:
    """The contract's columns from deduplicate()'s."""
    return result.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))
