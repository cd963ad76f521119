"""The registered queries of the corpus operators, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import oracles
from .common import documents


def op1_best_fit_packing(spark, sf_dir):
    import public_tokenizers

    from .packing import pack

    return pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op2_toxicity(spark, sf_dir):
    from .toxicity import score, train

    docs = documents(spark, sf_dir)
    return score(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op3_benchmark_decontamination(spark, sf_dir):
    from .decontaminate import contamination, digest

    return digest(contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def op4_mixing_lm(spark, sf_dir):
    from .mixing_lm import score, train

    docs = documents(spark, sf_dir)
    return score(docs, *train(docs)).drop("th")


def op5_url_filters(spark, sf_dir):
    from .url_rules import judge

    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op6_license_scan(spark, sf_dir):
    from .license_scan import scan

    return scan(documents(spark, sf_dir))


def op7_multiprobe_neighbours(spark, sf_dir):
    from .ann import search

    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 100 == 0)


def op8_jaccard_join(spark, sf_dir):
    from .jaccard_join import near_duplicates

    return near_duplicates(documents(spark, sf_dir)).drop("th", "label")


def op9_suffix_dedup(spark, sf_dir):
    from .suffix_dedup import deduplicate, digest

    return digest(deduplicate(documents(spark, sf_dir)))


def op10_substring_dedup(spark, sf_dir):
    from .substring_dedup import deduplicate, digest

    return digest(deduplicate(documents(spark, sf_dir)))


def op11_token_counts(spark, sf_dir):
    import public_tokenizers

    from .token_counts import token_counts

    return token_counts(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op12_token_alignment(spark, sf_dir):
    import public_tokenizers

    from .alignment import alignment

    return alignment(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op13_filter_audit(spark, sf_dir):
    from .filter_audit import audit

    return audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_best_fit_packing,
        op2_toxicity,
        op3_benchmark_decontamination,
        op4_mixing_lm,
        op5_url_filters,
        op6_license_scan,
        op7_multiprobe_neighbours,
        op8_jaccard_join,
        op9_suffix_dedup,
        op10_substring_dedup,
        op11_token_counts,
        op12_token_alignment,
        op13_filter_audit,
    )
}
#: The others are trained, mined, approximate or of a free choice of numbers; tests hold them against brute force.
ORACLE_SQL = {
    "op3_benchmark_decontamination": oracles.OP3,
    "op8_jaccard_join": oracles.OP8,
    "op9_suffix_dedup": oracles.OP9,
    "op10_substring_dedup": oracles.OP10,
    "op13_filter_audit": oracles.OP13,
}
