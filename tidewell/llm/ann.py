"""Approximate nearest neighbours by multiprobe p-stable hashing.

A table's hash of a vector is the cell of `functions` Gaussian projections, shifted and cut at a
width. A query visits its own cell and then neighbouring ones, in the order of the squared distances
to the borders crossed, which is that of estimated success. Candidates of all tables are ranked by
exact distance.

Fit. `sample` vectors (those with the smallest hash of vec_id) are searched exactly, in blocks
against all rows; their true neighbours set the width, and the number of probes is the smallest
that finds the target share of them. Every row is indexed.

Equal vectors are one entry: the k + 1 smallest vec_ids of each are kept, which is all that any
result can hold. Cells with more than `fill` entries are split, and queries visit all their parts.

Edge cases. Vectors that are null, empty, zero, or hold null or non-finite components take no part,
nor do rows without vec_id. Of rows that repeat a vec_id one counts, that
whose vector has the smallest hash. Vectors of different
lengths never meet. Queries whose cells hold fewer than k others are searched exactly, so that k are
returned, or all if there are fewer. Distances that are no finite doubles are infinite. Ties go to the smaller vec_id. Other
columns are ignored.
"""

from __future__ import annotations

import itertools
import warnings

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, session, size_of

K, TABLES, FUNCTIONS, SAMPLE, TARGET, FILL = 10, 8, 6, 64, 0.96, 20_000
#: Rounding of a squared distance from products, as a share of the pair's squared norms; components of pairs ranked exactly at a time; bytes of vectors a group.
SLACK, RERANKED, GROUP = 1e-11, 1 << 22, 8 << 20


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, v (array of double), h1, h2 of the rows that take part."""
    v = F.col("embedding")
    whole = (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.where(F.col("vec_id").isNotNull() & v.isNotNull()).where(whole).select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    return rows.withColumns({"h1": F.xxhash64("v"), "h2": F.xxhash64(F.lit(7), "v")})


def _matrix(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Vectors as one flat array, and their lengths."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64), np.diff(column.offsets.to_numpy())


def _by_length(column):
    """(length, places, matrix) for each length of vectors."""
    flat, size = _matrix(column)
    ends = np.append(0, np.cumsum(size))
    for d in np.unique(size):
        at = np.flatnonzero(size == d)
        yield int(d), at, flat[(ends[at][:, None] + np.arange(d)).ravel()].reshape(len(at), int(d))


def _nearest(q: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int):
    """For each query its k nearest of x: (query, place, exact distance), ties to the smaller id."""
    with np.errstate(over="ignore", invalid="ignore"):
        return _nearest_of(q, x, ids, k)


def _far(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of rows; where squares overflow or vanish, of scaled differences."""
    d = a - b
    far = np.sqrt((d**2).sum(1))
    odd = np.flatnonzero(~np.isfinite(far) | ((far < 1e-150) & (d != 0).any(1)))
    if len(odd):
        most = np.abs(a[odd] / 2 - b[odd] / 2).max(1)
        most = np.where(most > 0, most, 1)
        far[odd] = 2 * most * np.sqrt((((a[odd] / 2 - b[odd] / 2) / most[:, None]) ** 2).sum(1))
    return far


def _nearest_of(q: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int):
    qq, xx = (q * q).sum(1)[:, None], (x * x).sum(1)[None]
    near = qq + xx - 2 * q @ x.T
    slack = SLACK * (qq + xx)  # what rounding can do to this pair
    odd = ~np.isfinite(near)  # of these the exact distance decides
    if x.shape[0] > k:
        edge = np.partition(np.where(odd, np.inf, near + slack), k - 1, axis=1)[:, k - 1 : k]
        row, at = np.nonzero((near - slack <= edge) | odd)
    else:
        row, at = (y.ravel() for y in np.indices(near.shape))
    far, step = np.empty(len(row)), max(1, RERANKED // max(1, x.shape[1]))
    for lo in range(0, len(row), step):
        far[lo : lo + step] = _far(q[row[lo : lo + step]], x[at[lo : lo + step]])
    o = np.lexsort((ids[at], far, row))
    row, at, far = row[o], at[o], far[o]
    rank = np.arange(len(row)) - np.searchsorted(row, row)
    return row[rank < k], at[rank < k], far[rank < k]


class Index:
    """Projections, shifts and cells; the same on every machine."""

    def __init__(self, tables: int, functions: int, seed: int, width: float = 1.0, probes: int = 1):
        self.tables, self.functions, self.seed, self.width, self.probes = tables, functions, seed, width, probes
        self.steps = np.array(list(itertools.product((0, -1, 1), repeat=functions)))

    def cells(self, x: np.ndarray, table: int):
        """Whole and fractional cell coordinates."""
        rng = np.random.default_rng([self.seed, table, x.shape[1]])
        a, b = rng.standard_normal((x.shape[1], self.functions)), rng.uniform(size=self.functions)
        with np.errstate(over="ignore", invalid="ignore"):
            y = np.clip(np.nan_to_num(x @ a / self.width + b), -(2.0**60), 2.0**60)  # far out, vectors share cells
        return np.floor(y).astype(np.int64), y - np.floor(y)

    def name(self, cell: np.ndarray) -> np.ndarray:
        """Cells as numbers; coordinates far out share them, which only adds candidates."""
        out = np.zeros(cell.shape[:-1], np.int64)
        for j in range(self.functions):
            out = out * 1009 + cell[..., j] % 1009
        return out

    def ranks(self, x: np.ndarray, table: int):
        """For every query all cells it can visit, best first."""
        cell, rest = self.cells(x, table)
        border = np.stack([np.zeros_like(rest), (1 - rest) ** 2, rest**2], 2)  # by step: 0, 1, -1
        cost = sum(border[:, j, self.steps[:, j]] for j in range(self.functions))
        order = np.argsort(cost, axis=1, kind="stable")
        return cell[:, None, :] + self.steps[order]

    def probe(self, x: np.ndarray, table: int) -> np.ndarray:
        return self.name(self.ranks(x, table)[:, : self.probes])


def scanned(entries: DataFrame, q: np.ndarray, k: int) -> DataFrame:
    """q (place in q), vec_id, far, v: of each block of rows the k + 1 nearest entries of every vector in q, which are few and of one length."""
    shared = entries.sparkSession.sparkContext.broadcast(q)

    def scan(batches):
        q = shared.value
        for batch in batches:
            ids = batch.column("vec_id").to_numpy()
            for size, at, x in _by_length(batch.column("v")):
                if size == q.shape[1]:
                    row, place, far = _nearest(q, x, ids[at], k + 1)
                    yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(ids[at][place]), pa.array(far), batch.column("v").take(pa.array(at[place]))], names=["q", "vec_id", "far", "v"])

    kind = entries.schema["v"].dataType.simpleString()
    return entries.select("vec_id", "v").mapInArrow(scan, f"q long, vec_id long, far double, v {kind}")


def completed(best: DataFrame, queries: DataFrame, entries: DataFrame, k: int, block: int = 1024) -> DataFrame:
    """best, with an exact search, in blocks of queries against all rows, for those that have fewer entries than there are to find."""
    spark = best.sparkSession
    size = F.size("v").alias("d")
    there = {r.d: r["count"] for r in entries.groupBy(size).count().collect()}  # a row for each length of vectors
    many = F.create_map(*(F.lit(x) for d, n in there.items() for x in (d, min(k + 1, n)))) if there else F.lit(None)
    found = best.groupBy("h1", "h2").agg(F.countDistinct("vec_id").alias("n"))
    lack = queries.join(found, ["h1", "h2"], "left").where(F.coalesce("n", F.lit(0)) < F.element_at(many, F.size("v"))) if there else queries.limit(0)
    lack = materialize(lack.select("h1", "h2", "v"), "unfinished")
    total = lack.count()
    if not total:
        return best
    more, parts = [], -(-total // block)
    for p in range(parts):
        rows = lack.where(F.pmod(F.xxhash64("h1"), F.lit(parts)) == p).collect()
        for d in sorted({len(r.v) for r in rows}):
            own = [r for r in rows if len(r.v) == d]
            got = scanned(entries, np.array([r.v for r in own], float), k)
            names = spark.createDataFrame([(i, r.h1, r.h2) for i, r in enumerate(own)], "q long, h1 long, h2 long")
            got = got.withColumn("n", F.row_number().over(Window.partitionBy("q").orderBy("far", "vec_id"))).where(F.col("n") <= k + 1)
            more.append(materialize(got.join(names, "q").select("h1", "h2", "vec_id", "far"), "exact"))
    out = best.join(lack.select("h1", "h2"), ["h1", "h2"], "left_anti").select("h1", "h2", "vec_id", "far")
    for m in more:
        out = out.union(m)
    return out


def fit(entries: DataFrame, k: int = K, tables: int = TABLES, functions: int = FUNCTIONS, sample: int = SAMPLE, target: float = TARGET, seed: int = 11) -> Index:
    """entries: vec_id, v of distinct vectors."""
    spark = entries.sparkSession
    chosen = entries.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("vec_id", "v").collect()
    index = Index(tables, functions, seed)
    sizes = [len(r.v) for r in chosen]
    if not sizes:
        return index
    d = max(set(sizes), key=sizes.count)
    own = [r.vec_id for r in chosen if len(r.v) == d]
    q = np.array([r.v for r in chosen if len(r.v) == d], float)
    found = scanned(entries, q, k)
    best = found.withColumn("n", F.row_number().over(Window.partitionBy("q").orderBy("far", "vec_id"))).where(F.col("n") <= k + 1).collect()
    best = [r for r in best if r.vec_id != own[r.q]]
    if not best:
        return index
    row, near = np.array([r.q for r in best]), np.array([r.v for r in best], float)
    typical = float(np.median([r.far for r in best])) or 1.0
    for widen in range(12):
        index.width = 1.9 * typical * 1.5**widen
        at = np.full(len(best), len(index.steps))
        for t in range(tables):
            ways = index.ranks(q, t)[row]
            same = (ways == index.cells(near, t)[0][:, None, :]).all(2)
            at = np.minimum(at, np.where(same.any(1), same.argmax(1), len(index.steps)))
        need = int(np.sort(at)[min(len(at) - 1, int(np.ceil(target * len(at))) - 1)])
        if need < len(index.steps):
            index.probes = need + 1
            return index
    warnings.warn(f"{target:.0%} of the sampled neighbours aren't found with any width tried", stacklevel=2)
    index.probes = len(index.steps)
    return index


def search(vectors: DataFrame, is_query: Column, k: int = K, fill: int = FILL, **how) -> DataFrame:
    """query_id, rank, vec_id, score (Euclidean distance) of the k nearest other rows of each row for which is_query holds."""
    spark = session(vectors.sparkSession)
    rows = usable(vectors)
    order = Window.partitionBy("h1", "h2").orderBy("vec_id")
    # of rows that share a vec_id one takes part
    one = rows.groupBy("vec_id").agg(F.min(F.struct("h1", "h2", "v")).alias("x")).select("vec_id", "x.*")
    kept = one.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
    kept = materialize(kept, "vectors")
    entries = kept.where("n = 1").drop("n")
    asking = rows.where(is_query).groupBy("vec_id").agg(F.min(F.struct("h1", "h2")).alias("x")).select("vec_id", "x.*")
    queries = asking.select("h1", "h2").distinct().join(entries, ["h1", "h2"])
    index = fit(entries, k, **how)
    kind = entries.schema["v"].dataType.simpleString()

    def place(probes):
        def run(batches):
            for batch in batches:
                for _, at, x in _by_length(batch.column("v")):
                    take = pa.array(at)
                    for t in range(index.tables):
                        if probes:
                            names = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * index.probes), pa.array(index.probe(x, t).ravel()))
                        else:
                            names = pa.array(index.name(index.cells(x, t)[0]))
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), t, np.int32)), names, *(batch.column(c).take(take) for c in ("vec_id", "h1", "h2", "v"))], names=["t", "cell", "vec_id", "h1", "h2", "v"])

        return run

    fields = f"vec_id long, h1 long, h2 long, v {kind}"
    placed = entries.select("vec_id", "h1", "h2", "v").mapInArrow(place(False), f"t int, cell long, {fields}").withColumn("d", F.size("v"))
    asked = queries.select("vec_id", "h1", "h2", "v").mapInArrow(place(True), f"t int, cell array<long>, {fields}").withColumn("cell", F.explode("cell")).withColumn("d", F.size("v"))
    parts = placed.groupBy("t", "cell", "d").agg(F.ceil(F.count("*") / fill).cast("int").alias("parts"))
    groups = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), index.tables * size_of(kept) // GROUP)
    group = F.pmod(F.xxhash64("t", "cell", "d", "part"), F.lit(groups)).cast("int").alias("g")
    there = placed.join(parts, ["t", "cell", "d"]).withColumn("part", F.pmod(F.xxhash64("h1"), F.col("parts")).cast("int")).select(group, "t", "cell", "d", "part", "vec_id", "v")
    visits = asked.join(parts, ["t", "cell", "d"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(group, "t", "cell", "d", "part", "h1", "h2", F.col("v").alias("q"))

    def rank(key, left, right):
        out = {n: [] for n in ("h1", "h2", "vec_id", "far")}
        if left.num_rows and right.num_rows:
            cell_of = lambda t: np.stack([t.column(c).to_numpy().astype(np.int64) for c in ("t", "cell", "d", "part")], 1)
            _, inv = np.unique(np.concatenate([cell_of(left), cell_of(right)]), axis=0, return_inverse=True)
            a, b = inv[: left.num_rows], inv[left.num_rows :]
            oa, ob = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
            left, right, a, b = left.take(pa.array(oa)).combine_chunks(), right.take(pa.array(ob)).combine_chunks(), a[oa], b[ob]
            ids = left.column("vec_id").to_numpy()
            (fx, sx), (fq, sq) = _matrix(left.column("v")), _matrix(right.column("q"))
            ex, eq = np.append(0, np.cumsum(sx)), np.append(0, np.cumsum(sq))
            h1, h2 = right.column("h1").to_numpy(), right.column("h2").to_numpy()
            for c in np.intersect1d(a, b):
                la, ra = np.searchsorted(a, [c, c + 1])
                lb, rb = np.searchsorted(b, [c, c + 1])
                x = fx[ex[la] : ex[ra]].reshape(ra - la, -1)
                for lo in range(lb, rb, 512):
                    hi = min(lo + 512, rb)
                    row, at, far = _nearest(fq[eq[lo] : eq[hi]].reshape(hi - lo, -1), x, ids[la:ra], k + 1)
                    for n, y in (("h1", h1[lo + row]), ("h2", h2[lo + row]), ("vec_id", ids[la + at]), ("far", far)):
                        out[n].append(y)
        got = {n: np.concatenate(x) if x else np.zeros(0, float if n == "far" else np.int64) for n, x in out.items()}
        o = np.lexsort((got["vec_id"], got["far"], got["h2"], got["h1"]))  # of a query's visits in this group the best
        got = {n: x[o] for n, x in got.items()}
        if len(o):
            same = (got["h1"][1:] == got["h1"][:-1]) & (got["h2"][1:] == got["h2"][:-1])
            fresh = np.append(True, ~(same & (got["vec_id"][1:] == got["vec_id"][:-1])))
            got, same = {n: x[fresh] for n, x in got.items()}, None
            new = np.append(True, (got["h1"][1:] != got["h1"][:-1]) | (got["h2"][1:] != got["h2"][:-1]))
            n = np.arange(len(new)) - np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
            got = {m: x[n <= k] for m, x in got.items()}
        return pa.table({n: pa.array(x) for n, x in got.items()})

    met = there.groupBy("g").cogroup(visits.groupBy("g")).applyInArrow(rank, "h1 long, h2 long, vec_id long, far double")
    per_query = Window.partitionBy("h1", "h2").orderBy("far", "vec_id")
    best = met.distinct().withColumn("n", F.row_number().over(per_query)).where(F.col("n") <= k + 1).drop("n")
    best = completed(materialize(best, "found"), queries, entries, k)
    # vectors back to their rows
    named = entries.select(F.col("vec_id").alias("e"), F.col("h1").alias("e1"), F.col("h2").alias("e2"))
    held = kept.select(F.col("h1").alias("m1"), F.col("h2").alias("m2"), F.col("vec_id").alias("m"))
    full = best.join(named, F.col("vec_id") == F.col("e")).join(held, (F.col("e1") == F.col("m1")) & (F.col("e2") == F.col("m2"))).select("h1", "h2", F.col("m").alias("vec_id"), "far")
    full = full.withColumn("n", F.row_number().over(per_query)).where(F.col("n") <= k + 1).drop("n")
    result = asking.withColumnRenamed("vec_id", "query_id").join(full, ["h1", "h2"]).where("query_id != vec_id")
    final = result.withColumn("rank", F.row_number().over(Window.partitionBy("query_id", "h1", "h2").orderBy("far", "vec_id")).cast("int")).where(F.col("rank") <= k)
    return final.select("query_id", "rank", "vec_id", F.col("far").alias("score"))
