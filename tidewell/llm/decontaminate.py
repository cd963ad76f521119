"""Benchmark decontamination by winnowing.

Training texts and benchmark items are cut into word k-grams; of every window of words the
smallest k-gram hash is its fingerprint, so each shared span of a window's length shares a
fingerprint. Training fingerprints pass a bitmap of the benchmark's (sized by it, 8 MB at
most; it only saves work, the join decides), hits are extended to their whole
window, and windows are joined on fingerprint, length and a 128-bit hash of all their words.
Whether that join is broadcast is left to Spark's check of the benchmark side's size.

Edge cases. Null and empty texts have no words: n_words 0, no hits. An item of fewer words than a
window, but not none, is one window of its own length. Rows that repeat doc_id and text count as
one document; rows with the same doc_id (null too) and other texts are documents of their own.
Items that share an item_id count as one item; items without an id can be hit but aren't counted.
Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import seqs
from .common import materialize, session, text_key

GRAM, WINDOW, BITS, MOST = 5, 13, 22, 26
_RAW = "doc_id {id}, th long, n_words long, pos int, len int, fp long, w1 long, w2 long"


def _windows(data, offs, window, gram, short, keep):
    """Of a block: words of each text, and row, start, length, fingerprint and two hashes of each window whose fingerprint keep() accepts."""
    w = seqs.Words(data, offs, seqs.LETTERS)
    a, b = w.hash(0), w.hash(1)
    n, free = len(a), seqs.room(w.offs, len(a))
    row = seqs.spread(np.arange(len(offs) - 1), w.offs)
    out = []
    for size in (window, *short):
        if size == window:
            fp = seqs.sliding_min(seqs.grams(a, gram, 1), window - gram + 1)
        else:
            fp = seqs.grams(a, size, 100 + size)
        at = np.flatnonzero(keep(fp, size) & (free[: len(fp)] >= size)) if len(fp) else np.zeros(0, np.int64)
        out.append((row[at], at - w.offs[row[at]], np.full(len(at), size), fp[at], seqs.grams_at(a, at, size, 2), seqs.grams_at(b, at, size, 3)))
    return np.diff(w.offs), [np.concatenate(x) for x in zip(*out, strict=True)] if n else [np.zeros(0, t) for t in (int, int, int, seqs.U, seqs.U, seqs.U)]


def benchmark_windows(items: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Distinct windows of all items: len, fp, w1, w2, items (array of distinct item_id)."""
    kind = items.schema["item_id"].dataType

    def cut(batches):
        for batch in batches:
            for lo, hi, data, offs in seqs.blocks(batch.column("text")):
                words = seqs.Words(data, offs, seqs.LETTERS)
                n_words = np.diff(words.offs)
                short = sorted({int(x) for x in n_words if 0 < x < window})
                _, (row, pos, size, fp, w1, w2) = _windows(data, offs, window, gram, short, lambda fp, size: np.ones(len(fp), bool))
                good = (size == window) | (size == n_words[row])
                ids = batch.column("item_id").take(pa.array(row[good] + lo))
                yield pa.RecordBatch.from_arrays([ids, pa.array(size[good].astype(np.int32)), *(seqs.long(x[good]) for x in (fp, w1, w2))], names=["item_id", "len", "fp", "w1", "w2"])

    rows = items.select("item_id", "text").mapInArrow(cut, f"item_id {kind.simpleString()}, len int, fp long, w1 long, w2 long")
    return rows.groupBy("len", "fp", "w1", "w2").agg(F.collect_set("item_id").alias("items"))


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, gram: int = GRAM, share: int = 20) -> DataFrame:
    """doc_id, th (key of the text), n_words, spans (array of start, length in words), n_hit, items, contaminated (n_hit > 0 and share * n_hit >= n_words)."""
    spark = session(docs.sparkSession)
    test = benchmark_windows(items, window, gram)
    test = materialize(test, "benchmark_windows")
    # eight bits a window or more, as long as the bitmap stays under 2 ** MOST bits (8 MB)
    bits_of = int(min(MOST, max(BITS, test.count().bit_length() + 3)))
    place = F.shiftrightunsigned("fp", 64 - bits_of)
    parts = test.select(F.shiftright(place, 15).alias("part"), place.bitwiseAND(F.lit(32767)).alias("bit")).groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits")).collect()
    short = sorted(r[0] for r in test.where(F.col("len") < window).select("len").distinct().collect())  # at most window - 1
    bitmap = np.zeros((1 << bits_of) // 8, np.uint8)
    for r in parts:
        bitmap[r["part"] * 4096 : (r["part"] + 1) * 4096] = np.frombuffer(r["bits"], np.uint8)
    shared = spark.sparkContext.broadcast(bitmap.tobytes())

    def scan(batches):
        bits = np.unpackbits(np.frombuffer(shared.value, np.uint8), bitorder="little").view(bool)
        for batch in batches:
            for lo, hi, data, offs in seqs.blocks(batch.column("text")):
                n_words, (row, pos, size, *hashes) = _windows(data, offs, window, gram, short, lambda fp, size: bits[fp >> seqs.U(64 - bits_of)])
                rows = np.arange(hi - lo)
                at = pa.array(np.concatenate([rows, row]) + lo)
                none = pa.nulls(hi - lo, pa.int32())
                # rows that tell of a text, not of a hit, have a length that no window has, and hashes that spread them over tasks
                apart = seqs.mix(batch.column("th").slice(lo, hi - lo).to_numpy().view(seqs.U) + rows.astype(seqs.U))
                keys = [pa.array(np.append(np.zeros(hi - lo, np.int32), size.astype(np.int32))), *(seqs.long(np.append(apart, x)) for x in hashes)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(at), batch.column("th").take(at), pa.array(n_words[np.concatenate([rows, row])].astype(np.int64)), pa.concat_arrays([none, pa.array(pos.astype(np.int32))]), *keys],
                    names=["doc_id", "th", "n_words", "pos", "len", "fp", "w1", "w2"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    hits = docs.select("doc_id", text_key().alias("th"), "text").mapInArrow(scan, _RAW.format(id=kind))
    joined = hits.join(test, ["len", "fp", "w1", "w2"], "left")
    found = F.col("items").isNotNull()
    per_doc = joined.groupBy("doc_id", "th").agg(
        F.max("n_words").alias("n_words"),
        F.sort_array(F.collect_set(F.when(found, F.struct(F.col("pos").alias("start"), F.col("len").alias("length"))))).alias("spans"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
    )
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))

    def step(acc, s):
        end = (s["start"] + s["length"]).cast("long")
        return F.struct((acc["n"] + F.greatest(F.lit(0).cast("long"), end - F.greatest(acc["end"], s["start"].cast("long")))).alias("n"), F.greatest(acc["end"], end).alias("end"))

    per_doc = per_doc.withColumn("n_hit", F.aggregate("spans", zero, step, lambda acc: acc["n"]))
    return per_doc.withColumn("contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words")))


def digest(result: DataFrame) -> DataFrame:
    """The contract's columns from contamination()'s."""
    ids = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return result.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), "contaminated")
