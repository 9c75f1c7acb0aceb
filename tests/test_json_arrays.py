"""Outer-array JSON files cut into elements over many byte ranges."""

import gzip
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from histmart.sources import read_json_array
from histmart.sources.arrays import array_elements, array_pieces, read_large_json_array


@pytest.fixture()
def small_ranges(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


ODD = ['plain', 'a,b', 'a "quoted, b" c', 'back\\slash,', 'ends with \\', '\\",\\"', '[{,]}', '}],[{', '', ',,,', 'é,ü,漢字', 'line\nend,', '\\\\"']


def _elements(n, seed):
    rng = random.Random(seed)
    return [{"k": i, "v": rng.choice(ODD) * rng.randint(1, 3), "nested": [{"w": rng.choice(ODD)}, [rng.choice(ODD), [1, 2]]][: rng.randint(0, 2)],
             rng.choice(ODD) + "x": {"deep": [[], {}]}} for i in range(n)]


@pytest.mark.parametrize("indent,separators", [(None, (",", ":")), (2, None), (None, (" , ", " : "))])
def test_elements_equal_a_plain_parser(spark, small_ranges, tmp_dir, indent, separators):
    want = {}
    for name in ("a", "b"):
        want[name] = _elements(150, name)
        with open(f"{tmp_dir}/{name}.json", "w", encoding="utf-8") as f:
            json.dump(want[name], f, ensure_ascii=False, indent=indent, separators=separators)
    pieces, _ = array_pieces(spark, tmp_dir)
    assert pieces.select("_file", "_block").distinct().count() > 20
    got = array_elements(spark, tmp_dir).select(F.regexp_extract("_file", r"(\w+)\.json$", 1).alias("f"), "_element", "text").collect()
    found = {name: [json.loads(r.text) for r in sorted((r for r in got if r.f == name), key=lambda r: r._element)] for name in want}
    assert found == want


def test_rows_equal_the_whole_file_read(spark, small_ranges, tmp_dir):
    for part in ("x", "y"):
        os.makedirs(f"{tmp_dir}/p={part}")
        with open(f"{tmp_dir}/p={part}/f.json", "w", encoding="utf-8") as f:
            json.dump(_elements(120, part), f)
    schema = "k bigint, v string"
    split = read_large_json_array(spark, tmp_dir, schema)
    whole = read_json_array(spark, tmp_dir, schema)
    assert sorted(split.columns) == sorted(whole.columns)
    key = lambda rows: sorted((r.p, r.k, r.v) for r in rows)
    assert key(split.collect()) == key(whole.collect()) and split.count() == 240


@pytest.mark.parametrize("text,rows", [
    ("[]", []), (" [ ] \n", []), ("", []), ('[{"k": 1}]', [1]), ('﻿[{"k": 1}, {"k": 2}]\n', [1, 2]), ('{"k": 3, "v": "a,b"}', [3]),
    ('[{"k": 1}, "no object", {"k": 2}]', [None, 1, 2]), ('[{"k": 1, "v": "]"}, {"k": 2}', [1, 2])])
def test_defined_cases(spark, tmp_dir, text, rows):
    with open(f"{tmp_dir}/f.json", "w", encoding="utf-8") as f:
        f.write(text)
    got = [r.k for r in read_large_json_array(spark, tmp_dir, "k bigint, v string").collect()]
    assert sorted(got, key=lambda k: (k is not None, k or 0)) == rows


def test_compressed_file(spark, small_ranges, tmp_dir):
    with gzip.open(f"{tmp_dir}/f.json.gz", "wt", encoding="utf-8") as f:
        json.dump(_elements(100, 3), f)
    assert [r.k for r in read_large_json_array(spark, tmp_dir, "k bigint").orderBy("k").collect()] == list(range(100))


def test_no_task_sorts_or_holds_a_range(spark, tmp_dir):
    with open(f"{tmp_dir}/f.json", "w", encoding="utf-8") as f:
        json.dump(_elements(20, 5), f)
    plan = array_elements(spark, tmp_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "MapInArrow" in plan


def test_elements_within_a_range_are_not_shuffled(spark, tmp_dir):
    """Only the parts of a range's first and last element go to the groups; elements that end like the array keep their end."""
    with open(f"{tmp_dir}/f.json", "w", encoding="utf-8") as f:
        f.write("[[0]," + ",".join(f"[{i}, [{i}]]" for i in range(1, 2000)) + "]")
    elements = array_elements(spark, tmp_dir)
    plan = elements._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan.split("Aggregate")[0]
    assert [r.text for r in elements.orderBy("_element").collect()] == ["[0]"] + [f"[{i}, [{i}]]" for i in range(1, 2000)]
