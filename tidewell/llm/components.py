"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, tidy

#: A node with more than 1 / SHARE of all edges' ends (and more than LEAST) is a hub; there are at most SHARE of them.
SHARE, LEAST, SALTS = 512, 1000, 64


def spread_join(many: DataFrame, one: DataFrame, key: str | list[str], by: str, hubs: list[int], hot: str | None = None, how: str = "inner") -> DataFrame:
    """many joined with one (a row a key); rows whose column `hot` (by default the key) is among hubs are dealt over SALTS tasks by a hash of the column `by` of many."""
    keys = [key] if isinstance(key, str) else key
    if not hubs:
        return many.join(one.hint("merge"), keys, how)
    is_hot = F.coalesce(F.col(hot or keys[0]).isin(hubs), F.lit(False))
    left = many.withColumn("_salt", F.when(is_hot, F.pmod(F.xxhash64(by), F.lit(SALTS))).otherwise(0).cast("int"))
    right = one.withColumn("_salt", F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))))
    return left.join(right.hint("merge"), [*keys, "_salt"], how).drop("_salt")


def _look(e: DataFrame) -> tuple[bool, list[int]]:
    """Whether edges (a over b) lead from every node to the smallest one of its component; and the hubs."""
    ends = e.select(F.col("a").alias("u"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(e.select("b", F.lit(0), F.lit(1)))
    nodes = ends.groupBy("u").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
    most = max(LEAST, 2 * e.count() // SHARE)
    # one row; the list holds at most SHARE nodes, as each of them has more than that share of all ends
    row = nodes.agg(F.count_if((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).alias("open"), F.collect_list(F.when(F.col("up") + F.col("down") > most, F.col("u"))).alias("hubs")).first()
    return row["open"] == 0, sorted(row["hubs"])


def components(edges: DataFrame, most: int = 60) -> tuple[DataFrame, list[int]]:
    """(node, label: the smallest node of each node's component, for nodes of edges (a, b)), and the labels of very large components.

    Each step joins every node's neighbours to the smallest of them. The minimum is a partial
    aggregate, and the neighbours of hubs are dealt over many tasks. Steps are written out, so a lost
    executor costs one step. Null ends and loops are ignored.
    """

    def star(e: DataFrame, large: bool, hubs: list[int]) -> DataFrame:
        """Neighbours of each node that are larger (large-star) or smaller (small-star) meet its smallest one."""
        both = e.union(e.select(F.col("b"), F.col("a"))).toDF("u", "v") if large else e.select(F.greatest("a", "b"), F.least("a", "b")).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        met = spread_join(both, least, "u", "v", hubs)
        out = met.where("v > u").select(F.col("v"), F.col("m")) if large else met.select(F.col("v"), F.col("m")).union(least.select("u", "m"))
        return out.toDF("a", "b").where("a != b")

    e = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(), "edges")
    done, hubs = _look(e)
    for _ in range(most):
        if done:
            return e.select(F.col("a").alias("node"), F.col("b").alias("label")).union(e.select(F.col("b"), F.col("b")).distinct().toDF("node", "label")), hubs
        e = materialize(star(star(e, True, hubs), False, hubs).distinct(), "edges")
        tidy(e.sparkSession)
        done, hubs = _look(e)
    raise RuntimeError("components did not converge")
