"""The corpus pipeline: toxic documents go, one of each group of near duplicates stays, repeated
passages are cut, contaminated documents go, and what is left is packed into sequences.

Each stage takes the documents that its predecessor kept. Null and empty texts pass every stage:
they are clean, linked with nothing, and packed as their end id. Columns of any name pass unchanged. Labels and benchmark items are read
from the folder of the tables.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from tidewell.llm import decontaminate, jaccard_join, packing, substring_dedup, toxicity
from tidewell.llm.common import materialize, text_key, unused


def clean_toxic(spark, docs, sf_dir):
    """Documents that the model, fitted on the labelled ones among them, does not call toxic."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model, carry=True).where("predicted = 0").select("row.*")


def drop_near_duplicates(spark, docs, sf_dir):
    """Of each group of linked documents the one with the smallest doc_id."""
    return jaccard_join.one_of_each(docs, jaccard_join.near_duplicates(docs))


def cut_repeats(spark, docs, sf_dir):
    """Documents without the words of passages that stand earlier."""
    return substring_dedup.cleaned(docs)


def drop_contaminated(spark, docs, sf_dir):
    """Documents of which less than a twentieth is benchmark text."""
    found = decontaminate.contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    at, d, t = (unused(docs, name) for name in ("_at", "_d", "_t"))
    bad = materialize(found.where("contaminated").select(F.col("doc_id").alias(d), F.col("th").alias(t)), "contaminated")
    own = docs.withColumn(at, text_key())
    return own.join(bad, (F.col(at) == F.col(t)) & F.col("doc_id").eqNullSafe(F.col(d)), "left_anti").drop(at)


def pack(spark, docs, sf_dir):
    """The pieces of all documents with their sequences and places there."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("toxicity", clean_toxic), ("near_duplicates", drop_near_duplicates), ("substring_dedup", cut_repeats), ("decontamination", drop_contaminated), ("packing", pack)]
#: The first stage is a trained model, which SQL can't express; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
