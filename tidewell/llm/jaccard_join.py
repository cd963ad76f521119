"""Near duplicates by a grouped prefix join on word shingles.

A document is the set of its shingles. Two sets with Jaccard similarity of at least `percent` share
one of the first n - ceil(percent n) + 1 shingles in any common order. The order used puts shingles
that look frequent in a count sketch last; the sketch only shapes the order, so its noise costs time
and never a link.

Documents with the same set are one class; classes with the same prefix and size are one group.
Groups meet at their prefix shingles, and pass the size and the position filter. Shingles that few
groups share give all their pairs. At the others each group first meets one of like size, so links
are found at a row a group; the components of those links are then taken out of the question, and
only members of different components, there and inside and between groups, are paired. Parity
bitmaps (a popcount can only fall short of the sets' difference) drop most false pairs, and the rest
are verified on whole sets.

Edge cases. Null, empty and word-less texts have an empty set and are linked with nothing; with
fewer words than a shingle the whole sequence is one shingle. Repeated rows link with each other.
doc_id may be null: such a row gets the smallest non-null id it reaches. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import seqs
from .common import materialize, session, text_key, tidy, unused
from .components import LEAST, SHARE, components, spread_join

SHINGLE, PERCENT, CELLS, FEW, FILTER = 5, 75, 22, 64, 23
U = np.uint64


def _shingles(data, offs, k):
    """Shingle hashes of a block's texts (with repeats) and each text's range of them."""
    w = seqs.Words(data, offs, seqs.LOWER)
    h, n = w.hash(), np.diff(w.offs)
    whole = seqs.grams(h, k, 5)
    keep = seqs.room(w.offs, len(h))[: len(whole)] >= k
    number = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    ends = np.append(0, np.cumsum(number))
    out = np.empty(ends[-1], U)
    short = np.flatnonzero((n > 0) & (n < k))
    is_short = np.zeros(len(out), bool)
    is_short[ends[short]] = True
    out[~is_short] = whole[keep]
    for i in short:
        out[ends[i]] = seqs.grams(h[w.offs[i] : w.offs[i + 1]], int(n[i]), 50 + int(n[i]))[0]
    return out, ends


def sketch(docs: DataFrame, k: int) -> np.ndarray:
    """For each of 2 ** CELLS cells a small number that grows with the frequency of its shingles; 0 for those that don't stand out.

    Tasks count whole texts into cells; blocks of cells are added up, first within salts, so neither
    a task nor the driver gets more than the cells, however much data there is.
    """
    blocks, kind = 64, "block int, n binary"

    def count(batches):
        cells = np.zeros(1 << CELLS, np.int64)
        for batch in batches:
            for _, _, data, offs in seqs.blocks(batch.column("text")):
                out, _ = _shingles(data, offs, k)
                cells += np.bincount((out >> U(64 - CELLS)).astype(np.int64), minlength=1 << CELLS)
        rows = np.minimum(cells, 255).astype(np.uint8).reshape(blocks, -1)  # a task's share; more than that is frequent anyway
        yield pa.RecordBatch.from_arrays([pa.array(range(blocks), pa.int32()), pa.array([x.tobytes() for x in rows], pa.binary())], names=["block", "n"])

    def add(key, table):
        total = np.zeros((1 << CELLS) // blocks, np.int64)
        for x in table.column("n"):
            total += np.frombuffer(x.as_buffer(), np.uint8 if len(x.as_buffer()) == len(total) else "<u4")
        return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([np.minimum(total, (1 << 32) - 1).astype("<u4").tobytes()], pa.binary())], names=["block", "n"])

    part = docs.select("text").mapInArrow(count, kind).withColumn("salt", F.spark_partition_id() % 32)
    rows = part.groupBy("block", "salt").applyInArrow(add, kind).groupBy("block").applyInArrow(add, kind).collect()
    if not rows:
        return np.zeros(1 << CELLS, np.uint8)
    # block by block, so that the driver holds little more than the result
    mean = sum(int(np.frombuffer(r.n, "<u4").sum(dtype=np.int64)) for r in rows) / (1 << CELLS)
    out = []
    for r in sorted(rows):
        over = np.frombuffer(r.n, "<u4") - np.float32(mean + 4 * mean**0.5)
        out.append(np.where(over > 8, np.minimum(31, np.log2(np.maximum(over, 1))), 0).astype(np.uint8))
    return np.concatenate(out)


def _prefix(n, percent):
    return n - -(-n * percent // 100) + 1


def _sets(data, offs, k, rank):
    """(text, sorted distinct shingles, their rank order) of each text of a block that has words."""
    out, ends = _shingles(data, offs, k)
    # rank first, then hash
    key = (out >> U(5)) | (rank[(out >> U(64 - CELLS)).astype(np.int64)].astype(U) << U(59)) if rank is not None else out
    for i, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)):
        if b > a:
            yield i, np.unique(key[a:b])


def _bitmap(s: np.ndarray) -> bytes:
    """Parity of the set's members in each of about len(s) cells, a power of two of at least 64."""
    size = max(64, 1 << (len(s) - 1).bit_length())
    return np.packbits((np.bincount((s & U(size - 1)).astype(np.int64), minlength=size) & 1).astype(np.uint8), bitorder="little").tobytes()


def _far(a: bytes, b: bytes) -> int:
    """A lower bound of the size of the sets' difference."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def _group_id(n: int, prefix: np.ndarray) -> int:
    up, _ = seqs.powers(len(prefix) + 1)
    return int(seqs.grams(np.array([(prefix * up[: len(prefix)]).sum(), n], U), 2, 77).view(np.int64)[0])


def profile(docs: DataFrame, k: int, percent: int, shared) -> DataFrame:
    """doc_id, th, n, s1, s2 (hash of the set), gid (group), bm (parity bitmap) of every document; shared: the broadcast sketch."""

    def run(batches):
        rank = shared.value
        for batch in batches:
            for lo, hi, data, offs in seqs.blocks(batch.column("text")):
                n, s1, s2, gid, bm = [0] * (hi - lo), [0] * (hi - lo), [0] * (hi - lo), [0] * (hi - lo), [b""] * (hi - lo)
                for i, s in _sets(data, offs, k, rank):
                    up, _ = seqs.powers(len(s), 0)
                    up2, _ = seqs.powers(len(s), 1)
                    n[i] = len(s)
                    s1[i], s2[i] = (int(x) for x in np.array([(s * up).sum(), (seqs.mix(s) * up2).sum()], U).view(np.int64))
                    gid[i], bm[i] = _group_id(len(s), s[: _prefix(len(s), percent)]), _bitmap(s)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), batch.column("th").slice(lo, hi - lo), *(pa.array(x, pa.int64()) for x in (n, s1, s2, gid)), pa.array(bm, pa.binary())], names=["doc_id", "th", "n", "s1", "s2", "gid", "bm"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_key().alias("th"), "text").mapInArrow(run, f"doc_id {kind}, th long, n long, s1 long, s2 long, gid long, bm binary")


def _index(docs: DataFrame, k: int, percent: int, shared, bits: int) -> DataFrame:
    """Prefix shingles by hash range: a row holds runs (gid, n, how many) and their shingles with positions. A task tells each group once."""

    def run(batches):
        rank, told = shared.value, set()
        for batch in batches:
            for _, _, data, offs in seqs.blocks(batch.column("text")):
                gids, sizes, parts = [], [], []
                for _, s in _sets(data, offs, k, rank):
                    p = s[: _prefix(len(s), percent)]
                    g = _group_id(len(s), p)
                    if g not in told:
                        if len(told) < 1 << 20:
                            told.add(g)
                        gids.append(g)
                        sizes.append(len(s))
                        parts.append(p)
                if not parts:
                    continue
                token = seqs.mix(np.concatenate(parts))
                count = np.array([len(p) for p in parts])
                run_of = np.repeat(np.arange(len(parts)), count)
                pos = np.arange(len(token)) - np.repeat(np.cumsum(count) - count, count)
                rng = (token >> U(64 - bits)).astype(np.int64)
                o = np.argsort(rng, kind="stable")
                token, run_of, pos, rng = ((token >> U(32 - bits)) & U(0xFFFFFFFF)).astype("<u4")[o], run_of[o], pos[o].astype("<u4"), rng[o]
                gids, sizes = np.array(gids, "<i8"), np.array(sizes, "<u4")
                cuts = np.searchsorted(rng, np.arange((1 << bits) + 1))
                rows = []
                for r, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)):
                    if b > a:
                        at = np.flatnonzero(np.append(True, run_of[a + 1 : b] != run_of[a : b - 1]))
                        own = run_of[a:b][at]
                        rows.append((r, gids[own].tobytes(), sizes[own].tobytes(), np.diff(np.append(at, b - a)).astype("<u4").tobytes(), token[a:b].tobytes(), pos[a:b].tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), [pa.int32()] + [pa.binary()] * 5, strict=True)], names=["rng", "gid", "n", "runs", "token", "pos"])

    return docs.select("text").mapInArrow(run, "rng int, gid binary, n binary, runs binary, token binary, pos binary")


def _meet(percent: int, most: int):
    """Groups that share prefix shingles of a range: pairs (kind 0), and the groups of shingles that many share (kind 1)."""

    def run(key, table):
        get = lambda name, kind: np.concatenate([np.frombuffer(x, kind) for x in table.column(name).to_pylist()])
        runs = get("runs", "<u4").astype(np.int64)
        gid, n, token, pos = np.repeat(get("gid", "<i8"), runs), np.repeat(get("n", "<u4"), runs).astype(np.int64), get("token", "<u4"), get("pos", "<u4").astype(np.int64)
        o = np.argsort(token, kind="stable")
        t = token[o]
        o = o[np.append(t[1:] == t[:-1], False) | np.append(False, t[1:] == t[:-1])] if len(t) else o
        o = o[np.lexsort((gid[o], n[o], token[o]))]
        gid, n, token, pos = gid[o], n[o], token[o], pos[o]
        new = np.ones(len(o), bool)
        new[1:] = (token[1:] != token[:-1]) | (gid[1:] != gid[:-1])
        gid, n, token, pos = gid[new], n[new], token[new], pos[new]
        out_a, out_b, big = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], []
        if len(token):
            start = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
            size = np.diff(np.append(start, len(token)))
            few = np.repeat(size <= most, size)
            g, m, tk, p = gid[few], n[few], token[few], pos[few]
            for d in range(1, most):
                same = np.flatnonzero(tk[d:] == tk[:-d])
                if not len(same):
                    break
                i, j = same, same + d
                need = -(-percent * (m[i] + m[j]) // (100 + percent))
                good = (100 * m[i] >= percent * m[j]) & (np.minimum(m[i] - p[i], m[j] - p[j]) >= need)
                out_a.append(g[i][good])
                out_b.append(g[j][good])
            # of like sizes, all meet the one with the fewest shingles before this one: of a family the least edited
            like = np.floor(np.log(n) / np.log(100 / percent) + 1e-9).astype(np.int64)
            low = seqs.mix(gid.view(U))
            for a, e in zip(start[size > most], (start + size)[size > most], strict=True):
                for band in np.unique(like[a:e]):
                    at = a + np.flatnonzero(like[a:e] == band)
                    lead = at[np.lexsort((low[at], pos[at]))[0]]
                    need = -(-percent * (n[at] + n[lead]) // (100 + percent))
                    at = at[(at != lead) & (np.minimum(n[at] - pos[at], n[lead] - pos[lead]) >= need)]
                    out_a.append(np.full(len(at), gid[lead]))
                    out_b.append(gid[at])
                o = np.argsort(gid[a:e])
                big.append((gid[a:e][o], pos[a:e][o]))
        a, b = np.concatenate(out_a), np.concatenate(out_b)
        a, b = np.minimum(a, b), np.maximum(a, b)
        o = np.lexsort((b, a))
        a, b = a[o], b[o]
        new = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))[: len(a)]
        a, b = a[new], b[new]
        # shingles with the very same groups tell the same; the first place counts
        alike: dict[bytes, np.ndarray] = {}
        for g, p in big:
            alike[g.tobytes()] = np.minimum(p, alike.get(g.tobytes(), p))
        rows = [(0, 0, a[i : i + 4096], b[i : i + 4096]) for i in range(0, len(a), 4096)]
        for raw, p in alike.items():
            g = np.frombuffer(raw, np.int64)
            name = int(seqs.mix(np.array([seqs.mix(g.view(U)).sum(), len(g)], U)).view(np.int64)[0])
            rows += [(1, name, g[i : i + 4096], p[i : i + 4096]) for i in range(0, len(g), 4096)]
        return pa.table([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.list_(pa.int64())), pa.array([r[3] for r in rows], pa.list_(pa.int64()))], names=["kind", "bucket", "a", "b"])

    return run


def _verified(pairs: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose sets are similar."""
    small = classes.select("cid", "n", "bm")
    met = pairs.join(small.toDF("a", "na", "ba").hint("merge"), "a").where("ba is not null").join(small.toDF("b", "nb", "bb").hint("merge"), "b")

    def near(batches):
        for batch in batches:
            far = np.array([_far(x, y) for x, y in zip(batch.column("ba").to_pylist(), batch.column("bb").to_pylist(), strict=True)], np.int64)
            n = batch.column("na").to_numpy() + batch.column("nb").to_numpy()
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(far * (100 + percent) <= (100 - percent) * n))

    left = met.select("a", "b", "na", "nb", "ba", "bb").where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")).mapInArrow(near, "a long, b long")
    both = left.join(sets.toDF("b", "sb").hint("merge"), "b").join(sets.toDF("a", "sa").hint("merge"), "a")
    both = both.select("a", "b", F.size("sa").alias("na"), F.size("sb").alias("nb"), F.size(F.array_intersect("sa", "sb")).alias("i"))
    return both.where(F.col("i") * 100 >= percent * (F.col("na") + F.col("nb") - F.col("i"))).select("a", "b")


def _sets_of(docs: DataFrame, needed: DataFrame, k: int) -> DataFrame:
    """cid, s (sorted shingles) of the classes in needed (cid, _d, _th)."""

    def make(batches):
        for batch in batches:
            ids, lists = [], []
            for lo, _, data, offs in seqs.blocks(batch.column("text")):
                for i, s in _sets(data, offs, k, None):
                    ids.append(batch.column("cid")[lo + i].as_py())
                    lists.append(s.view(np.int64))
            ends = np.append(0, np.cumsum([len(x) for x in lists])).astype(np.int32)
            flat = np.concatenate(lists) if lists else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], names=["cid", "s"])

    own = docs.withColumn("_k", text_key())
    texts = _maybe(own, needed).join(needed.hint("merge"), (own["_k"] == needed["_th"]) & own["doc_id"].eqNullSafe(needed["_d"])).select("cid", "text")
    sets = materialize(texts.mapInArrow(make, "cid long, s array<long>"), "sets")
    return sets.dropDuplicates(["cid"]) if _repeats(own) else sets


def _open_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs of classes of different components in one bucket that pass the size and the position filter.

    rows: bucket, cid, n, label, pos. Only classes in the same or the next band of sizes meet, and of
    a bucket only rows that some other component of these bands faces.
    """
    wide = float(np.log(100 / percent))
    band = F.floor(F.log(F.col("n").cast("double")) / wide + 1e-9).cast("int")
    rows = rows.withColumn("band", band)
    x = rows.toDF("bucket", "a", "na", "la", "pa", "band")
    y = rows.toDF("bucket", "b", "nb", "lb", "pb", "own").withColumn("band", F.explode(F.array(F.col("own") - 1, F.col("own"), F.col("own") + 1)))
    like = 100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")
    need = percent * (F.col("na") + F.col("nb"))
    shared = ((100 + percent) * (F.col("na") - F.col("pa")) >= need) & ((100 + percent) * (F.col("nb") - F.col("pb")) >= need)
    return x.join(y.drop("own").hint("merge"), ["bucket", "band"]).where((F.col("la") < F.col("lb")) & like & shared).select("a", "b")


def near_duplicates(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT, few: int = FEW) -> DataFrame:
    """doc_id, th (key of the text), n_shingles, component_id (smallest doc_id reachable by links, itself included), label (of the component; null for empty sets). Shingles of at most `few` groups give all their pairs at once.

    The driver holds the sketch and plans of single steps only: every step is a written table, joins
    are never broadcast, and what a step used is released before the next.
    """
    spark = session(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    shared = spark.sparkContext.broadcast(sketch(docs, k))
    seen = materialize(profile(docs, k, percent, shared), "profile")
    key = ["n", "s1", "s2"]
    classes = seen.where("n > 0").groupBy(*key).agg(F.min(F.struct("doc_id", "th", "gid", "bm")).alias("x"), F.min("doc_id").alias("least"), F.count("*").alias("rows"))
    classes = materialize(classes.select(F.monotonically_increasing_id().alias("cid"), *key, "least", "rows", F.col("x.doc_id").alias("doc_id"), F.col("x.th").alias("th"), F.col("x.gid").alias("gid"), F.col("x.bm").alias("bm")), "classes")
    bits = max(4, (int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length())
    met = materialize(_index(docs, k, percent, shared, bits).groupBy("rng").applyInArrow(_meet(percent, few), "kind int, bucket long, a array<long>, b array<long>"), "met")
    shared.unpersist()
    tidy(spark)
    groups = materialize(classes.groupBy("gid").agg(F.min("cid").alias("lead"), F.count("*").alias("size")), "groups")
    pairs = met.where("kind = 0").select(F.explode(F.arrays_zip("a", "b")).alias("p")).select("p.a", "p.b").distinct()
    big = met.where("kind = 1").select("bucket", F.explode(F.arrays_zip("a", "b")).alias("p")).groupBy("bucket", F.col("p.a").alias("gid")).agg(F.min("p.b").alias("pos"))
    lead = groups.select("gid", "lead", "size")
    by_group = materialize(pairs.join(lead.toDF("a", "la", "ka").hint("merge"), "a").join(lead.toDF("b", "lb", "kb").hint("merge"), "b"), "pairs")
    members = classes.join(groups.hint("merge"), "gid").select("gid", "cid", "lead", "size", "n")
    inside = members.where("cid != lead").select(F.col("lead").alias("a"), F.col("cid").alias("b"))
    first = by_group.select(F.col("la").alias("a"), F.col("lb").alias("b")).union(inside).distinct()
    # sets of all classes that can be in a pair
    touched = by_group.select(F.col("a").alias("gid")).union(by_group.select("b")).union(groups.where("size > 1").select("gid")).union(big.select("gid")).distinct()
    needed = classes.join(touched.hint("merge"), "gid", "left_semi").select("cid", F.col("doc_id").alias("_d"), F.col("th").alias("_th"))
    sets = _sets_of(docs, materialize(needed, "needed"), k)
    tidy(spark)
    edges = materialize(_verified(first, classes, sets, percent), "links")
    label, hubs = components(edges)
    named = members.join(label.withColumnRenamed("node", "cid").hint("merge"), "cid", "left").select("gid", "cid", "n", "size", F.coalesce("label", "cid").alias("label"))
    named = materialize(named, "named")
    # what the first round left open: buckets, groups and pairs of groups with several components
    rows = big.join(named.hint("merge"), "gid").select("bucket", "cid", "n", "label", "pos").union(named.where("size > 1").select(F.col("gid").alias("bucket"), "cid", "n", "label", F.lit(0).cast("long")))
    rows = materialize(rows, "buckets")
    mixed = rows.groupBy("bucket").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x != y").select("bucket")
    rows = materialize(rows.join(mixed.hint("merge"), "bucket", "left_semi"), "buckets")
    wide = by_group.where("ka > 1 or kb > 1").select("a", "b")
    m = named.select("gid", "cid", "n", "label")
    like = 100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")
    wide = wide.join(m.toDF("a", "ca", "na", "la").hint("merge"), "a").join(m.toDF("b", "cb", "nb", "lb").hint("merge"), "b").where((F.col("la") != F.col("lb")) & like).select(F.col("ca").alias("a"), F.col("cb").alias("b"))
    both = materialize(_open_pairs(rows, percent).union(wide).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")
    tidy(spark)
    more = materialize(_verified(both, classes, sets, percent), "links")
    if more.take(1):
        label, hubs = components(label.where("node != label").toDF("a", "b").union(more))
    # the smallest doc_id of each component
    root = classes.join(label.withColumnRenamed("node", "cid").hint("merge"), "cid", "left").select("cid", *key, "least", F.coalesce("label", "cid").alias("label"))
    root = materialize(root, "roots")
    best = root.groupBy("label").agg(F.min("least").alias("component_id"))
    final = spread_join(root, best, "label", "cid", hubs).select(*key, "component_id", "label")
    hot = [r.s1 for r in classes.where(F.col("rows") > max(LEAST, seen.count() // SHARE)).select("s1").collect()]  # at most SHARE
    out = spread_join(seen.select("doc_id", "th", *key), final, key, "doc_id", hot, "s1", "left")
    return out.select("doc_id", "th", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), "label")


def _maybe(own: DataFrame, needed: DataFrame) -> DataFrame:
    """The rows of own that may be needed, by a bitmap of 2 ** FILTER bits (a megabyte, whatever the data), so that few texts are shuffled."""
    place = lambda d, t: F.pmod(F.xxhash64(d, t), F.lit(1 << FILTER))
    at = place("_d", "_th")
    bits = needed.select(F.shiftright(at, 15).alias("_part"), at.bitwiseAND(F.lit(32767)).alias("_bit")).groupBy("_part").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    row = own.withColumn("_at", place("doc_id", "_k")).withColumn("_part", F.shiftright("_at", 15))
    bit = F.col("_at").bitwiseAND(F.lit(32767))
    byte = F.conv(F.hex(F.substring("_bits", (F.shiftright(bit, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    kept = row.join(F.broadcast(bits), "_part").where((F.floor(byte / F.pow(F.lit(2), bit.bitwiseAND(F.lit(7)))) % 2 == 1))
    return kept.select(*own.columns)


def one_of_each(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of docs that stay: of each component the row with the smallest doc_id (null last) and text key, once; and all rows without words."""
    found = materialize(found.select("doc_id", "th", "label"), "components")
    first = found.where("label is not null").groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "th")).alias("x"))
    stay = first.select(F.col("x.doc_id").alias("_d"), F.col("x.th").alias("_t")).union(found.where("label is null").select("doc_id", "th").distinct())
    at, d, t = (unused(docs, name) for name in ("_at", "_d", "_t"))
    own, stay = docs.withColumn(at, text_key()), stay.toDF(d, t)
    kept = own.join(stay.hint("merge"), (F.col(at) == F.col(t)) & F.col("doc_id").eqNullSafe(F.col(d)), "left_semi")
    if found.where("label is not null").groupBy("doc_id", "th").count().where("count > 1").take(1):
        kept = kept.dropDuplicates(["doc_id", at])
    return kept.drop(at)


def _repeats(own: DataFrame) -> bool:
    """Whether some row repeats another's doc_id and text."""
    return bool(own.groupBy("doc_id", "_k").count().where("count > 1").take(1))
