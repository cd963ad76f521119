import pytest
from pyspark.sql import functions as F

from tidewell.plans import registry, ror, runs


def test_run_lifecycle(spark):
    log = runs.status(spark, "r1", "running", "t0", 0, {"pages": 3}).unionByName(runs.status(spark, "r1", "complete", "t2", 2, notes="ok")).unionByName(runs.status(spark, "r2", "running", "t1", 1, {}))
    got = {r.run_id: r for r in runs.current(log).collect()}
    assert (got["r1"].status, got["r1"].parameters_json, got["r1"].notes) == ("complete", '{"pages": 3}', "ok") and got["r2"].status == "running"
    with pytest.raises(ValueError, match="no_such_table"):
        runs.require(spark, ["no_such_table"])


def test_retrievals_and_updates(spark):
    rows = spark.createDataFrame([("r1", "s", "w1", "https://doi.org/10.1/A", "{}"), ("r1", "s", "w2", None, "{}")], "run_id string, source_id string, work_id string, doi string, raw_json string")
    old = spark.createDataFrame([("w1", "old")], "work_id string, title string")
    got = {r.work_id: r for r in runs.retrievals(rows, old).collect()}
    assert got["w1"].already_present and not got["w2"].already_present and got["w1"].doi == "10.1/a" and got["w1"].event_id.startswith("disc_") and len(got["w1"].event_id) == 21
    new = spark.createDataFrame([("w1", "new"), ("w2", "x")], "work_id string, title string")
    assert sorted(map(tuple, runs.apply_works(old, new).collect())) == [("w1", "old"), ("w2", "x")]
    assert sorted(map(tuple, runs.apply_works(old, new, True).collect())) == [("w1", "new"), ("w2", "x")]


def test_enrichment(spark):
    canon = spark.createDataFrame([("CI1", "Ministry of X", "r1"), ("CI2", "Uni", "r2"), ("CI3", "None", None)], "canonical_institution_id string, canonical_name string, canonical_ror string")
    org = spark.createDataFrame([("r1", "M", "active", 1900)], "ror_id string, name string, status string, established int")
    names = spark.createDataFrame([("r1", "M", "en", "label"), ("r1", "Em", "fr", "label")], "ror_id string, name string, lang string, name_types string")
    value = lambda *rows: spark.createDataFrame(list(rows), "ror_id string, value string")
    loc = spark.createDataFrame([("r1", "C", "NZ", 1.0, 2.0)], "ror_id string, city string, country_code string, lat double, lng double")
    rel = spark.createDataFrame([("r1", "r2", "Uni", "Parent"), ("r1", "r9", "Q", "child")], "ror_id string, related_ror_id string, label string, relationship_type string")
    ids = spark.createDataFrame([("r1", "GRID", "g")], "ror_id string, id_type string, id_value string")
    out = {r.canonical_institution_id: r for r in ror.enriched(canon, org, names, value(("r1", "a")), loc, rel, ids, value(("r1", "http://l"))).collect()}
    assert len(out) == 3 and out["CI1"].ror_names == "Em; M" and (out["CI1"].parents, out["CI1"].children, out["CI2"].parents) == (1, 1, 0) and out["CI1"].related_names == "Q [child]; Uni [parent]" and not out["CI3"].has_ror_match
    assert sorted((r.related_ror_id, r.related_institution_id) for r in ror.relationship_edges(canon, rel).collect()) == [("r2", "CI2"), ("r9", None)]
    assert ror.websites(canon, value(("r1", "l1"), ("r1", "l2")), value(("r1", "d1"), ("r1", "d2"))).count() == 4
    assert ror.external_ids(canon, ids).count() == 1 and [r.canonical_institution_id for r in ror.policy_organisations(canon).collect()] == ["CI1"]
    assert out["CI1"].lat == 1.0 and F is not None


@pytest.mark.parametrize("name", ["ledger_identifier_claims", "ledger_work_claims", "ledger_retrievals"])
def test_works_are_not_broadcast(spark, name):
    """Works made of records look small to Spark, which doesn't know how long these are; the driver would have to hold all of them."""
    query = registry.queries()[name](spark, "/root/testdata/sf0.001")
    joins = [x for x in query._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in x]
    met = [x for x in joins if "doi_clean" in x or name == "ledger_retrievals" and "work_id" in x]
    assert met and all("strategy=merge" in x for x in met)
    assert name != "ledger_work_claims" or all("strategy=merge" in x for x in joins if "o_custkey" in x or "source_key" in x)
    assert not any("canonical_source_id" in x or "_range" in x for x in joins)
