import random

import corpus_pipeline
from tests.llm.fixtures import words
from tests.llm.test_decontaminate import brute as contaminated
from tests.llm.test_jaccard_join import brute as linked
from tests.llm.test_repeats import brute_words


def write(spark, folder):
    rng = random.Random(8)
    passage, item = words(rng, 60, 9999), words(rng, 30, 9999)
    rows = []
    for i in range(120):
        w = words(rng, rng.randrange(10, 90), 9999)
        if i % 9 == 0:
            w[5:5] = passage
        if i % 13 == 0:
            w[2:2] = item[:20]
        if i % 11 == 0:
            w[3:3] = ["vile", "."]
        if i % 10 == 7:
            w = rows[i - 1][1].split()
            w[-1:] = ["edited"]
        rows.append((i, "\n".join([" ".join(w[:8]), " ".join(w[8:])])))
    rows += [(200, None), (201, ""), (202, rows[1][1]), (202, rows[1][1]), (None, rows[2][1]), (None, "a row without id")]
    spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", "7 as _k", "8 as _d", "9 as _t", "10 as _at", "11 as _null").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(d, 1, int("vile" in (t or ""))) for d, t in rows if d is not None and d < 100], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, " ".join(item)), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return rows


def test_each_stage_against_brute_force(spark, tmp_path):
    folder = str(tmp_path)
    rows = write(spark, folder)
    docs, seen = spark.read.parquet(f"{folder}/documents.parquet"), {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        docs.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if name != "packing":
            assert docs.columns == columns
        seen[name] = [(r.doc_id, r.text) for r in docs.collect()] if name != "packing" else docs.collect()
    key = lambda rs: sorted(rs, key=str)
    assert key(seen["toxicity"]) == key([r for r in rows if "vile" not in (r[1] or "")])
    least = {c: (str(d), n) for d, n, c in sorted(linked(seen["toxicity"]), key=lambda x: (x[2] == "None", x[2]))}
    assert len([r for r in seen["near_duplicates"] if r[1]]) == len({c for _, n, c in linked(seen["toxicity"]) if n and c != "None"}) + sum(1 for d, n, c in linked(seen["toxicity"]) if n and c == "None")
    assert least and (202, rows[1][1]) not in seen["near_duplicates"] and (200, None) in seen["near_duplicates"]
    lengths = sorted(len((t or "").split()) for _, t in seen["substring_dedup"])
    assert lengths == sorted(n - m for _, n, m, _ in brute_words(seen["near_duplicates"]))
    same = dict(seen["near_duplicates"])
    assert all(t == same[d] for d, t in seen["substring_dedup"] if d is not None and len((t or "").split()) == len((same[d] or "").split()))
    bad = {d for d, _, _, _, _, c in contaminated(seen["substring_dedup"], [(1, spark.read.parquet(f"{folder}/benchmark.parquet").first().text)] if False else [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]) if c}
    assert bad and key(seen["decontamination"]) == key([r for r in seen["substring_dedup"] if r[0] not in bad])
    assert {r.doc_id for r in seen["packing"]} == {d for d, _ in seen["decontamination"]}
    again = corpus_pipeline.run(spark, folder).collect()
    assert sorted((str(r.doc_id), r.piece, r.ids_crc32) for r in again) == sorted((str(r.doc_id), r.piece, r.ids_crc32) for r in seen["packing"])
