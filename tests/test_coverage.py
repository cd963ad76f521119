from tidewell.plans import outputs

REG = "registry_id string, title string, issn_print string, issn_online string, country string, priority_band string, is_active boolean, title_key string"
TAGS = "work_id string, source_name string, publication_year int, is_journal_article_like boolean, issn string, issn_l string"


def journals(spark, rows):
    return spark.createDataFrame([(k, k, p, o, "NZ", "core", True, k) for k, p, o in rows], REG)


def test_journals_by_pairs_of_issns(spark):
    reg = journals(spark, [("both", "1", "2"), ("same", "1", "1"), ("online", None, "2"), ("none", None, None), ("absent", "9", "8"), ("half", "9", "2"), ("turned", "2", "1")])
    tags = spark.createDataFrame([
        ("w1", "A", 2000, True, "1; 2", None), ("w2", "B", None, False, "1", "1"), ("w3", None, 1990, True, "", "2"),
        # a work of two rows, one of them an article
        ("w4", "C", 2010, True, "1", None), ("w4", "D", 2010, False, "2", None), ("w5", "E", 2020, True, "7", None), ("w6", "F", 2021, None, None, None),
    ], TAGS)
    got = {r.registry_id: (r.works, r.journal_articles, r.first_year, r.last_year, r.matched_names) for r in outputs.registry_coverage(reg, tags).collect()}
    assert got == {
        "both": (4, 3, 1990, 2010, "A; B; C; D"), "turned": (4, 3, 1990, 2010, "A; B; C; D"), "same": (3, 2, 2000, 2010, "A; B; C"), "online": (3, 2, 1990, 2010, "A; D"),
        "none": (0, 0, None, None, None), "absent": (0, 0, None, None, None), "half": (3, 2, 1990, 2010, "A; D"),
    }


def test_journals_and_works_of_one_issn_never_meet_as_pairs(spark):
    n = 3000
    reg = journals(spark, [(f"j{i}", "1", "2") for i in range(n)])
    tags = spark.range(n).selectExpr("'w' || id AS work_id", "'N' AS source_name", "2000 AS publication_year", "true AS is_journal_article_like", "'1; 2' AS issn", "'1' AS issn_l")
    out = outputs.registry_coverage(reg, tags)
    assert {(r.works, r.journal_articles) for r in out.collect()} == {(n, n)}
    rows, plans = [], [out._jdf.queryExecution().executedPlan()]
    while plans:  # what each node of the plan that ran gave
        plan = plans.pop()
        if plan.metrics().contains("numOutputRows"):
            rows.append(plan.metrics().apply("numOutputRows").value())
        inner = ["executedPlan"] if plan.nodeName().startswith("AdaptiveSparkPlan") else ["plan"] if plan.nodeName().endswith("QueryStage") else []
        plans += [getattr(plan, i)() for i in inner] or [plan.children().apply(i) for i in range(plan.children().size())]
    assert rows and max(rows) <= 20 * n
