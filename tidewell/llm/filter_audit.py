"""How filters work together: what each of them removes in every order in which they can be applied.

Five conditions mark a document as failing, one bit each:

* A: fewer than 50 words; B: fewer than 65 distinct words in 100; C: more than 5 letters A-Z in 100
  code points; D: any of the marks #$%&*|; E: the same text as a document with a smaller doc_id.

A document is removed by the first filter of an order that it fails, so a table of 32 masks by 120
orders holds every answer. Tasks look their rows up in it, count removals by part, order and step
with one np.bincount a batch, and Spark sums the partial counts.

One scan of the texts gives a row of about 50 bytes a document; nothing else of a text moves. E is
told by SHA-256 of the whole text: the smallest doc_id of each digest comes from a map-side combined
aggregate, and goes back to the documents by digest and salt, so a group of copies that holds a third
of all rows is dealt over SALTS tasks. Tasks keep at most PARTS parts before they hand their counts on.

Edge cases. Null text is empty, null source is the part ''. Texts of any length are counted whole, a
slice at a time. Repeated rows are documents of their own; rows of equal text and equal doc_id fail E
only if a smaller doc_id has the text. A null doc_id is neither smaller nor larger than another one,
and has no label. If a doc_id has several labels, one that is 1 is enough. Other columns are ignored.
An empty table has no parts, hence no rows.
"""

from __future__ import annotations

import hashlib
import re
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, session

FILTERS = "ABCDE"
SALTS, PER_SALT, PARTS, SLICE = 256, 500_000, 2048, 1 << 22
UPPER = bytes(range(65, 91))
_BLANK = re.compile(rb"[\x20\x09-\x0D]")
COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def _words(text: bytes):
    """Lists of words, of a slice of the text each; bytes.split() cuts at exactly the six ASCII blanks."""
    at = 0
    while at < len(text):
        cut = _BLANK.search(text, at + SLICE) if len(text) - at > SLICE else None
        end = cut.start() if cut else len(text)
        yield text[at:end].split()
        at = end


def mask_of(text: bytes, least_words: int = 50, least_distinct: int = 65, most_upper: int = 5, marks: bytes = b"#$%&*|") -> int:
    """Bits 0 to 3 tell which of the conditions A to D the text meets; least_distinct and most_upper are in 100."""
    n, distinct = 0, set()
    for words in _words(text):
        n += len(words)
        distinct.update(words)
    upper = len(text) - len(text.translate(None, UPPER))
    points = len(text) if text.isascii() else int(np.count_nonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80))
    marked = len(text) != len(text.translate(None, marks))
    return (n < least_words) | (100 * len(distinct) < least_distinct * n) << 1 | (100 * upper > most_upper * points) << 2 | marked << 3


def first_failures(filters: str = FILTERS) -> np.ndarray:
    """For each mask and each order of the filters (sorted), the step (from 0) that removes the document, or their number if none does."""
    k = len(filters)
    orders = np.array(list(permutations(range(k))))
    fails = np.arange(1 << k)[:, None, None] >> orders[None] & 1
    return np.where(fails.any(2), fails.argmax(2), k).astype(np.int64)


def facts(docs: DataFrame, **limits) -> DataFrame:
    """part, doc_id, mask of A to D, digest of the text: one row a document."""
    session(docs.sparkSession)

    def measure(batches):
        for batch in batches:
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            masks, digests = [mask_of(t, **limits) for t in texts], [hashlib.sha256(t).digest() for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column("part"), batch.column("doc_id"), pa.array(masks, pa.int32()), pa.array(digests, pa.binary())], names=["part", "doc_id", "mask", "digest"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), "doc_id", "text")
    return rows.mapInArrow(measure, f"part string, doc_id {kind}, mask int, digest binary")


def with_copies(rows: DataFrame) -> DataFrame:
    """The rows with bit 4 of mask set where a smaller doc_id has the same text."""
    salts = max(SALTS, rows.count() // PER_SALT)
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", "part", "mask"), F.lit(salts)).cast("int"))
    # a row for each digest and salt that occur, so that the documents' side needs no more than an equi join
    cells = rows.groupBy("digest", "salt").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    shared = cells.groupBy("digest").agg(F.min("least").alias("least"), F.max("most").alias("most"), F.collect_list("salt").alias("salts")).where("least < most")
    first = shared.select("digest", "least", F.explode("salts").alias("salt"))
    late = F.coalesce(F.col("least") < F.col("doc_id"), F.lit(False))
    return rows.join(first, ["digest", "salt"], "left").select("part", "doc_id", (F.col("mask") + 16 * late.cast("int")).alias("mask"))


def with_labels(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, good, toxic; rows without a doc_id match nothing and are dealt over all tasks."""
    one = lambda name: F.max(F.coalesce(F.col(name) == 1, F.lit(False)))
    told = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(one("quality").alias("good"), one("toxic").alias("toxic")).withColumn("apart", F.lit(0).cast("long"))
    apart = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id()).otherwise(0)
    joined = rows.withColumn("apart", apart).join(told, ["doc_id", "apart"], "left")
    return joined.select("part", "mask", *(F.coalesce(n, F.lit(False)).alias(n) for n in ("good", "toxic")))


def tally(rows: DataFrame, filters: str = FILTERS) -> DataFrame:
    """From part, mask, good, toxic: the counts of every part, order and step."""
    k = len(filters)
    orders = list(permutations(range(k)))
    names = ["".join(filters[i] for i in o) for o in orders]

    def count(batches):
        table, m = first_failures(filters), len(orders)
        at, cell = np.array(orders), np.arange(m) * (k + 1)
        parts, sums, only, failed = {}, None, None, None

        def handed():
            """A row for each part, order and step of what was counted."""
            n = len(parts)
            total, good, toxic = (sums[:n, i].reshape(n, m, k + 1) for i in range(3))
            removed = total[..., :k]
            kept = total.sum(2, keepdims=True) - removed.cumsum(2)
            shapley = np.stack([removed[:, at == f].sum(1) for f in range(k)], 1)
            columns = [kept, removed, failed[:n, at] - removed, only[:n, at], good[..., :k], toxic[..., :k], shapley[:, at]]
            part = pa.array(np.repeat(np.arange(n), m * k), pa.int32())
            order = pa.array(np.tile(np.repeat(np.arange(m), k), n), pa.int32())
            step = pa.array(np.tile(np.arange(1, k + 1), n * m), pa.int32())
            keys = [pa.array(list(parts), pa.string()).take(part), pa.array(names).take(order), step]
            rows = pa.RecordBatch.from_arrays(keys + [pa.array(np.ascontiguousarray(c).ravel()) for c in columns], names=["part", "filter_order", "step", *COUNTS])
            for lo in range(0, rows.num_rows, 60_000):
                yield rows.slice(lo, 60_000)

        for batch in batches:
            if not batch.num_rows:
                continue
            local = batch.column("part").dictionary_encode()
            if parts and len(parts) + len(local.dictionary) > PARTS:
                yield from handed()
                parts, sums = {}, None
            slots = np.array([parts.setdefault(p, len(parts)) for p in local.dictionary.to_pylist()])
            if sums is None or len(parts) > len(sums):
                more = max(64, 2 * len(parts))
                grown = [np.zeros((more, *shape), np.int64) for shape in ((3, m * (k + 1)), (k,), (k,))]
                if sums is not None:
                    for new, old in zip(grown, (sums, only, failed), strict=True):
                        new[: len(old)] = old
                sums, only, failed = grown
            slot, mask = local.indices.to_numpy(), batch.column("mask").to_numpy()
            code = (slot * (m * (k + 1)))[:, None] + cell + table[mask]
            size = len(slots) * m * (k + 1)
            for i, some in enumerate([slice(None), batch.column("good").to_numpy(zero_copy_only=False), batch.column("toxic").to_numpy(zero_copy_only=False)]):
                sums[slots, i] += np.bincount(code[some].ravel(), minlength=size).reshape(len(slots), -1)
            for f in range(k):
                failed[slots, f] += np.bincount(slot[mask >> f & 1 == 1], minlength=len(slots))
                only[slots, f] += np.bincount(slot[mask == 1 << f], minlength=len(slots))
        if parts:
            yield from handed()

    partial = rows.mapInArrow(count, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS))
    return partial.groupBy("part", "filter_order", "step").agg(*(F.sum(c).alias(c) for c in COUNTS))


def audit(docs: DataFrame, labels: DataFrame, **limits) -> DataFrame:
    """One row per part, order of the five filters and step, with what that step removes, keeps and loses."""
    rows = materialize(facts(docs, **limits), "facts")
    return tally(with_labels(with_copies(rows), labels))
