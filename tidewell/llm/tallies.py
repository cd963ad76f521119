"""Sums over documents of something that is told once for each distinct key of the corpus.

Documents are dealt into blocks: a block is a run of documents of one task, of BLOCK characters or
one document. It is one row, with the list of its distinct keys and, for each document, which of
these it holds and how often (a sparse matrix: `held` numbers of keys a document, `at` their places,
`n` how often). Blocks are written once. Only (spot, key) is shuffled to meet what is told of the key,
where a spot is a block and a place in its list; values come back as a few rows a block and task, with
their places and values side by side, and meet the block's matrix, so that no row per document and key
ever exists.

A key that every block holds is dealt over up to 64 salts, one more for each SPREAD blocks.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, session

#: Characters of a block, documents of a block, characters of texts that are cut at a time, blocks a salt, values that a task gathers.
BLOCK, DOCUMENTS, RUN, SPREAD, GATHERED = 1 << 23, 1 << 16, 1 << 19, 4096, 1 << 19
#: Bits of a place in a block (a block closes before it has so many keys), and of a block's number in its task.
PLACE, NUMBER = 28, 14


def planes(numbers, width: int = 4) -> bytes:
    """Unsigned numbers of so many bytes, all lowest bytes first: small numbers compress well."""
    return np.ascontiguousarray(np.asarray(numbers).astype(f"<u{width}").view(np.uint8).reshape(-1, width).T).tobytes()


def of_planes(raw: bytes, width: int = 4) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, -1).T).view(f"<u{width}").ravel().astype(np.int64)


def numbered(items) -> tuple[np.ndarray, list]:
    """The number of each item among the distinct ones, by first appearance."""
    place = defaultdict(count().__next__)
    at = np.fromiter(map(place.__getitem__, items), np.int64, len(items))
    return at, list(place)


class Block:
    """Documents of one block: chunks of their texts are numbered, chunks give keys when the block is closed."""

    def __init__(self):
        self.place, self.ids, self.values, self.held, self.chars = defaultdict(count().__next__), [], [], [], 0

    def numbers(self, chunks: list) -> np.ndarray:
        return np.fromiter(map(self.place.__getitem__, chunks), np.int32, len(chunks))

    def add(self, doc_id: pa.Array, value: tuple, runs: list, chars: int) -> None:
        """One document: its id (an array of one), its own columns and the chunk numbers of its text."""
        self.ids.append(doc_id)
        self.values.append(value)
        tallied = [np.unique(r, return_counts=True) for r in runs]
        if len(tallied) == 1:
            self.held.append(tallied[0])
        else:
            self.held.append(tuple(np.concatenate([t[i] for t in tallied] or [np.zeros(0, np.int64)]) for i in (0, 1)))
        self.chars += chars

    def full(self, chars: int) -> bool:
        return self.chars >= chars or len(self.ids) >= DOCUMENTS

    def closed(self, number: int, names: list[str], spread, kind: pa.DataType) -> pa.RecordBatch:
        """The block as one row. spread(chunks) gives how many keys each chunk has, the keys' numbers and the distinct keys."""
        many, key, keys = spread(list(self.place))
        chunk, often = (np.concatenate([h[i] for h in self.held]).astype(np.int32) for i in (0, 1))
        doc = np.repeat(np.arange(len(self.held), dtype=np.int32), [len(h[0]) for h in self.held])
        length, first = many[chunk], (np.cumsum(many) - many)[chunk]
        # the keys of a document's chunks, one after another
        each = np.arange(length.sum()) + np.repeat(first - (np.cumsum(length) - length), length)
        doc, often, key = np.repeat(doc, length), np.repeat(often, length), key[each]
        del each, chunk, first
        # frequent keys first, for small differences between the places of a document
        rank = np.bincount(key, minlength=len(keys)).argsort(kind="stable")[::-1]
        place = np.empty(len(keys), np.int64)
        place[rank] = np.arange(len(keys))
        code = doc * np.int64(max(1, len(keys))) + place[key]
        del doc, key
        order = code.argsort(kind="stable")
        code, often = code[order], often[order].astype(np.int64)
        del order
        new = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])[: len(code)])
        often, code = (np.add.reduceat(often, new) if len(new) else often), code[new]
        doc, at = np.divmod(code, max(1, len(keys)))
        total = np.bincount(at, often, minlength=len(keys)).astype(np.int64)
        held = np.bincount(doc, minlength=len(self.ids))
        step = np.diff(at, prepend=0)
        starts = (np.cumsum(held) - held)[held > 0]
        step[starts] = at[starts]
        one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
        distinct = pa.array(keys, kind).take(pa.array(rank))
        columns = [pa.array([number], pa.int64()), one(pa.concat_arrays(self.ids)), *(one(pa.array(v)) for v in zip(*self.values, strict=True)), one(distinct), one(pa.array(total)), *(pa.array([planes(x)], pa.binary()) for x in (held, step, often))]
        return pa.RecordBatch.from_arrays(columns, names=["block", "doc_id", *names, "keys", "totals", "held", "at", "n"])


def runs(column, chars: int = RUN):
    """First row and texts of runs of about so many characters; null texts are empty."""
    lo, held, size = 0, [], 0
    for i, x in enumerate(column):
        held.append(x.as_py() or "")
        size += len(held[-1])
        if size > chars:
            yield lo, held
            lo, held, size = i + 1, [], 0
    if held:
        yield lo, held


def blocks(docs: DataFrame, names: dict[str, str], kind: str, maker, chars: int = BLOCK) -> DataFrame:
    """The written blocks of docs, of so many characters. names: the documents' own columns and their Spark types; kind: the Spark type of keys.

    maker() gives, in a task, read(block, texts), which yields the own columns and the chunk numbers
    of each text, and the function spread of `Block.closed`.
    """
    session(docs.sparkSession)
    key = {"string": pa.string(), "bigint": pa.int64()}[kind]

    def make(batches):
        read, spread = maker()
        block, number = Block(), TaskContext.get().partitionId() << NUMBER
        for batch in batches:
            ids = batch.column("doc_id")
            for lo, texts in runs(batch.column("text")):
                for i, (value, chunks) in enumerate(read(block, texts)):
                    block.add(ids.slice(lo + i, 1), value, chunks, len(texts[i]))
                if block.full(chars):
                    yield block.closed(number, list(names), spread, key)
                    block, number = Block(), number + 1
        if block.ids:
            yield block.closed(number, list(names), spread, key)

    own = ", ".join(f"{n} array<{t}>" for n, t in names.items())
    id_kind = docs.schema["doc_id"].dataType.simpleString()
    made = docs.select("doc_id", "text").mapInArrow(make, f"block long, doc_id array<{id_kind}>, {own}, keys array<{kind}>, totals array<long>, held binary, at binary, n binary")
    return materialize(made, "blocks", codec="zstd")


def looked_up(blocks: DataFrame, tell, *values: str, totals: bool = True) -> DataFrame:
    """of (block), places and the values that tell gives for the keys there, packed by `planes`.

    tell gets and gives one row a distinct key: key, salts, with totals also total (how often the corpus holds it), and the values.
    """
    salts = min(64, 1 + blocks.count() // SPREAD)
    rows = blocks.select("block", F.posexplode(F.arrays_zip("keys", "totals")).alias("place", "x"))
    salt = F.pmod(F.xxhash64("block"), F.lit(salts)).cast("int").alias("salt")
    spot = (F.shiftleft("block", PLACE) + F.col("place")).alias("spot")
    distinct = rows.select(F.col("x.keys").alias("key"), F.col("x.totals").alias("total"), salt)
    every = F.bit_or(F.expr("shiftleft(1L, salt)")) if salts > 1 else F.lit(1).cast("long")
    distinct = distinct.groupBy("key").agg(every.alias("salts"), *[F.sum("total").alias("total")][:totals])
    where = F.filter(F.sequence(F.lit(0), F.lit(salts - 1)), lambda s: F.getbit("salts", s) == 1)
    told = tell(distinct).select("key", *values, F.explode(where).alias("salt"))
    by = ["key", "salt"][: 1 + (salts > 1)]
    found = rows.select(F.col("x.keys").alias("key"), *[salt][: salts > 1], spot).join(told, by).select("spot", *values)

    def gather(batches):
        held, n = [], 0

        def packed():
            whole = pa.Table.from_batches(held)
            spots = whole.column("spot").to_numpy()
            order = spots.argsort()
            of, place = spots[order] >> PLACE, spots[order] & (1 << PLACE) - 1
            cuts = np.flatnonzero(np.diff(of, prepend=-1))
            ends = np.append(cuts[1:], len(of))
            runs = list(zip(cuts, ends, strict=True))
            columns = [pa.array([planes(np.diff(place[i:j], prepend=0)) for i, j in runs], pa.binary())]
            for v in values:
                value = whole.column(v).to_numpy()[order]
                columns.append(pa.array([planes(value[i:j], 8) for i, j in runs], pa.binary()))
            return pa.RecordBatch.from_arrays([pa.array(of[cuts]), *columns], names=["of", "place", *values])

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
            if n >= GATHERED:
                yield packed()
                held, n = [], 0
        if held:
            yield packed()

    return found.mapInArrow(gather, "of long, place binary, " + ", ".join(f"{v} binary" for v in values))


def summed(blocks: DataFrame, told: DataFrame, names: dict[str, str], *values: str) -> DataFrame:
    """doc_id, the documents' own columns and, for each value, its sum over the keys of the document, each as often as it stands there."""
    id_kind = blocks.schema["doc_id"].dataType.elementType.simpleString()
    schema = ", ".join([f"doc_id {id_kind}", *(f"{n} {t}" for n, t in names.items()), *(f"{v} long" for v in values)])

    def add(block: pa.Table, told: pa.Table) -> pa.Table:
        out = []
        gathered = lambda name, width: [of_planes(x, width) for x in told.column(name).to_pylist()]
        place = np.concatenate([np.zeros(0, np.int64), *(x.cumsum() for x in gathered("place", 4))])
        for r in range(block.num_rows):
            held, step, often = (of_planes(block.column(c)[r].as_py()) for c in ("held", "at", "n"))
            at = step.cumsum()
            starts = (held.cumsum() - held)[held > 0]
            # places are differences inside a document: what came before it goes
            before = np.repeat(at[starts] - step[starts], held[held > 0])
            at, ends = at - before, held.cumsum()
            sums = []
            for v in values:
                value = np.zeros(int(place.max(initial=-1)) + 1, np.int64)
                value[place] = np.concatenate([np.zeros(0, np.int64), *gathered(v, 8)])
                upto = np.concatenate([[0], (often * value[at]).cumsum()])
                sums.append(upto[ends] - upto[ends - held])
            own = [block.column(n)[r].values for n in ("doc_id", *names)]
            out.append(pa.Table.from_arrays([*own, *map(pa.array, sums)], names=["doc_id", *names, *values]))
        return pa.concat_tables(out)

    left = blocks.select("block", "doc_id", *names, "held", "at", "n")
    return left.groupBy("block").cogroup(told.groupBy("of")).applyInArrow(add, schema)
