import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidewell.sources import harvest, json_arrays

TEXT = st.text(st.sampled_from(list('ab{}[],:"\\ é\n')), max_size=12)
VALUE = st.recursive(st.one_of(st.none(), st.integers(-5, 5), TEXT), lambda v: st.one_of(st.lists(v, max_size=3), st.dictionaries(TEXT, v, max_size=3)), max_leaves=8)


@pytest.fixture
def small_ranges(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "60")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
    spark.conf.set("spark.sql.files.openCostInBytes", before[1])


def elements(spark, path):
    return sorted(json.dumps(json.loads(r.raw_json), sort_keys=True) for r in harvest.read_json_array(spark, path).collect())


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(VALUE, max_size=12), min_size=1, max_size=2), st.sampled_from([None, 1]))
def test_elements_across_ranges(spark, tmp_path_factory, small_ranges, arrays, indent):
    folder = tmp_path_factory.mktemp("arrays")
    for n, a in enumerate(arrays):
        (folder / f"{n}.json").write_text(("﻿" if n else "") + json.dumps(a, ensure_ascii=False, indent=indent) + "\n" * n, encoding="utf-8")
    assert elements(spark, str(folder)) == sorted(json.dumps(x, sort_keys=True) for a in arrays for x in a)


def test_one_file_by_many_tasks(spark, tmp_path, small_ranges):
    """An element longer than several ranges, and braces, quotes and backslashes in strings."""
    values = [{"n": i, "s": '}{"],[\\' * (i % 5), "deep": [[{"x": "\\"}] * (60 if i == 7 else 1)]} for i in range(40)]
    (tmp_path / "d.json").write_text(json.dumps(values))
    found = harvest.read_json_array(spark, str(tmp_path / "d.json"))
    assert sorted(json.loads(r.raw_json)["n"] for r in found.collect()) == list(range(40))
    assert elements(spark, str(tmp_path / "d.json")) == sorted(json.dumps(v, sort_keys=True) for v in values)
    assert spark.read.option("lineSep", "}").text(str(tmp_path / "d.json")).rdd.getNumPartitions() > 20


def test_written_arrays_are_read_back(spark, tmp_path, small_ranges):
    rows = spark.createDataFrame([(json.dumps({"k": i, "t": "a]}" * (i % 4)}),) for i in range(50)] + [(None,)], "raw_json string").repartition(3)
    json_arrays.write(rows, str(tmp_path / "out"))
    assert sorted(json.loads(r.raw_json)["k"] for r in json_arrays.read(spark, str(tmp_path / "out")).collect()) == list(range(50))
    json_arrays.write(rows.limit(0), str(tmp_path / "none"))
    assert json_arrays.read(spark, str(tmp_path / "none")).count() == 0


def test_a_file_that_is_no_array_is_an_error(spark, tmp_path):
    (tmp_path / "o.json").write_text('{"a": 1}')
    with pytest.raises(Exception, match="not an array"):
        json_arrays.read(spark, str(tmp_path / "o.json")).collect()
