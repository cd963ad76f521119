"""Files that are one JSON array each, read by many tasks and written by many.

A file is dealt into byte ranges by Spark's text reader, which cuts at closing braces wherever they
stand. What a brace or comma means depends on whether it stands in a string and how deep, so there
are two passes. The first tells of each range, for each way in which it may begin (outside strings,
inside one, inside one after a backslash), how it ends and by how many brackets the depth changes; a
prefix over a file's ranges, a row each, makes that the true state at every border. The second pass
starts from it: elements that lie in one range come out whole, and the ends and beginnings that
borders cut are put together again, two rows a range. A task holds an Arrow batch and one element.

Text outside an array is skipped (white space, a byte order mark); a file that begins with an object
fails the job. An empty array has no elements. Compressed files are one range each.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewell.session import ship

#: Bytes of text that a task gathers before it hands on rows.
HANDED = 4 << 20
OUTSIDE, INSIDE, ESCAPED = 0, 1, 2


def _scan(text: bytes, state: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Of each byte whether it stands outside strings, the change of depth that it makes, and the state after the last one."""
    shift = int(state == ESCAPED)
    b = np.frombuffer(b"\\" * shift + text, np.uint8)
    if not len(b):
        return np.zeros(0, bool), np.zeros(0, np.int64), state
    at = np.arange(len(b))
    back = b == 92
    other = np.maximum.accumulate(np.where(back, -1, at))  # the last byte that is no backslash
    run = at - other  # backslashes that end here
    escaped = np.concatenate([[False], run[:-1] % 2 == 1])
    quote = (b == 34) & ~escaped
    before = (quote.cumsum() - quote + (state != OUTSIDE)) % 2
    outside = before == 0
    depth = (((b == 91) | (b == 123)) & outside).astype(np.int64) - (((b == 93) | (b == 125)) & outside)
    within = (before[-1] + quote[-1]) % 2
    end = OUTSIDE if not within else ESCAPED if run[-1] % 2 == 1 else INSIDE
    return outside[shift:], depth[shift:], end


def _runs(batch: pa.RecordBatch):
    """file, start and text of each run of rows of one range, with the braces that the reader cut away."""
    file, start, value = (batch.column(c) for c in ("file", "start", "value"))
    key = np.array([f"{f}\0{s}" for f, s in zip(file.to_pylist(), start.to_pylist(), strict=True)])
    cuts = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)]
    for i, j in zip(cuts, cuts[1:], strict=False):
        if j > i:
            yield i, "".join(f"{v}}}" for v in value.slice(i, j - i).to_pylist()).encode()


def _summaries(batches):
    """A row a range: for each state at its start the state at its end and the change of depth."""
    held, ends, depths = None, [0, 1, 2], [0, 0, 0]

    def told():
        return pa.RecordBatch.from_pydict({"file": [held[0]], "start": [held[1]], "ends": [ends], "depths": [depths]}, pa.schema([("file", pa.string()), ("start", pa.int64()), ("ends", pa.list_(pa.int32())), ("depths", pa.list_(pa.int64()))]))

    for batch in batches:
        for i, text in _runs(batch):
            key = batch.column("file")[i].as_py(), batch.column("start")[i].as_py()
            if key != held:
                if held:
                    yield told()
                held, ends, depths = key, [0, 1, 2], [0, 0, 0]
            known = {}
            for s in range(3):
                if ends[s] not in known:
                    _, depth, end = _scan(text, ends[s])
                    known[ends[s]] = end, int(depth.sum())
            depths = [depths[s] + known[ends[s]][1] for s in range(3)]
            ends = [known[e][0] for e in ends]
    if held:
        yield told()


def _states(ranges: pd.DataFrame) -> pd.DataFrame:
    """The true state and depth at the start of each range of a file."""
    state, depth, out = OUTSIDE, 0, []
    for r in ranges.sort_values("start").itertuples():
        out.append((r.file, r.start, state, depth))
        depth += int(r.depths[state])
        state = int(r.ends[state])
    return pd.DataFrame(out, columns=["file", "start", "state", "depth"])


def _elements(batches):
    """Elements and parts of elements of each range: w whole, h the end of one, t the beginning, m a middle."""
    held, state, depth, current, began = None, 0, 0, bytearray(), False
    rows, size = [], 0

    def packed():
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.int64(), pa.string(), pa.string()), strict=True)], names=["file", "start", "part", "value"])

    def put(part):
        nonlocal size
        rows.append((*held, part, current.decode()))
        size += len(current)

    for batch in batches:
        for i, text in _runs(batch):
            key = batch.column("file")[i].as_py(), batch.column("start")[i].as_py()
            if key != held:
                if held and depth > 0:
                    put("t" if began else "m")
                held, state, depth = key, batch.column("state")[i].as_py(), batch.column("depth")[i].as_py()
                current, began = bytearray(), False
            b = np.frombuffer(text, np.uint8)
            outside, change, state = _scan(text, state)
            after = depth + change.cumsum()
            before = after - change
            if (b[(before == 0) & (change > 0)] == 123).any():
                raise ValueError(f"{held[0]} is not an array")
            borders = np.flatnonzero(outside & ((change > 0) & (before == 0) | (change < 0) & (after == 0) | (b == 44) & (before == 1)))
            last, inside = 0, depth > 0
            for at in borders.tolist():
                if inside:
                    current += text[last:at]
                    put("w" if began else "h")
                current, began, inside, last = bytearray(), True, bool(after[at] > 0), at + 1
                if size >= HANDED:
                    yield packed()
                    rows, size = [], 0
            if inside:
                current += text[last:]
            depth = max(0, int(after[-1])) if len(after) else depth
        if rows:
            yield packed()
            rows, size = [], 0
    if held and depth > 0:
        put("t" if began else "m")
    if rows:
        yield packed()


def read(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """raw_json: the text of each element of the arrays at path, in no order."""
    ship(spark)
    pieces = spark.read.option("lineSep", "}").text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")
    ranges = pieces.mapInArrow(_summaries, "file string, start long, ends array<int>, depths array<long>")
    states = ranges.groupBy("file").applyInPandas(_states, "file string, start long, state int, depth long")
    # a row a range, not a row of data; the scan's order within a range is kept by a join that doesn't shuffle it
    known = pieces.join(F.broadcast(states), ["file", "start"])
    parts = known.mapInArrow(_elements, "file string, start long, part string, value string")
    whole = parts.where("part = 'w'").select("value")
    # a beginning owns the parts up to the next beginning of its file; of a range the end comes first
    place = F.when(F.col("part") == "t", 1).otherwise(0)
    owner = F.last(F.when(F.col("part") == "t", F.col("start")), ignorenulls=True).over(Window.partitionBy("file").orderBy("start", place))
    cut = parts.where("part != 'w'").withColumn("owner", owner).groupBy("file", "owner")
    joined = cut.agg(F.array_sort(F.collect_list(F.struct("start", place.alias("place"), "value"))).alias("x")).select(F.array_join(F.transform("x", lambda p: p["value"]), "").alias("value"))
    return whole.unionByName(joined).select(F.trim(F.regexp_replace("value", r"^\s+|\s+$", "")).alias("raw_json")).where("raw_json != ''")


def write(rows: DataFrame, path: str, column: str = "raw_json") -> None:
    """One array a task, of the JSON texts in column; null texts are left out. Tasks without rows write an empty array."""
    ship(rows.sparkSession)

    def lines(batches):
        first = "["
        for batch in batches:
            out = []
            for v in batch.column(0).to_pylist():
                out.append(first + v)
                first = ","
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])
        yield pa.RecordBatch.from_arrays([pa.array(["[]" if first == "[" else "]"], pa.string())], names=["value"])

    rows.where(F.col(column).isNotNull()).select(column).mapInArrow(lines, "value string").write.text(path)
