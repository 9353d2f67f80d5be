"""Array files cut into many blocks, against the standard library's parser."""

import gzip
import json
import os
import random
import time

import pytest
from pyspark.sql import functions as F, types as T

import __spark_entry__ as entry
from gridsight.catalog import row_queries
from gridsight.session import short_shuffles
from gridsight.sources import readers

SCHEMA = T.StructType([T.StructField("no", T.LongType()), T.StructField("s", T.StringType()), T.StructField("deep", T.StringType())])


def element(rng, no):
    text = "".join(rng.choice(['"', "\\", "{", "}", "[", "]", ",", "\n", "é", "😀", "a", " "]) for _ in range(rng.randrange(30)))
    deep = rng.choice([None, text, {"x": [{"y": text}, {}]}, [[text], {}], {}])
    return {"no": no, "s": text, "deep": deep}


@pytest.fixture(params=["40", "333", "134217728"])
def block_size(spark, request):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", request.param)
    yield int(request.param)
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_any_cut_gives_the_elements(spark, tmp_path, block_size):
    rng, want = random.Random(block_size), []
    for i, n in enumerate([0, 1, 2, 40]):
        rows = [element(rng, 1000 * i + k) for k in range(n)]
        text = json.dumps(rows, indent=rng.choice([None, 2]), ensure_ascii=rng.random() < 0.5)
        (tmp_path / f"{i}.json").write_text(rng.choice(["", " \n", "﻿"]) + text + rng.choice(["", " \n"]), encoding="utf-8")
        want += rows
    records, skipped = readers.read_records_json(spark, str(tmp_path), SCHEMA)
    assert skipped.count() == 0
    got = {r.no: r for r in records.collect()}
    assert len(got) == len(want) == records.count()
    for w in want:
        r = got[w["no"]]
        assert r.s == w["s"]
        assert (r.deep if w["deep"] is None or isinstance(w["deep"], str) else json.loads(r.deep)) == w["deep"]


def test_a_file_of_many_blocks_is_read_by_many_tasks(spark, tmp_path, block_size):
    if block_size != 333:
        pytest.skip("one size is enough")
    (tmp_path / "a.json").write_text(json.dumps([{"no": i, "s": "x" * 50} for i in range(500)]))
    from gridsight.sources import json_arrays

    assert json_arrays._fragments(spark, str(tmp_path), "*.json").rdd.getNumPartitions() > 50
    assert readers.read_records_json(spark, str(tmp_path), SCHEMA)[0].where("s is not null").distinct().count() == 500


def test_broken_files_give_nothing_and_are_listed(spark, tmp_path, block_size):
    bad = {
        "blank": " \n", "object": '{"no": 1}', "cut": '[{"no": 1}, {"no": 2', "open": '[{"no": 1}', "comma": '[{"no": 1},]', "number": '[1, {"no": 1}]',
        "gap": '[{"no": 1} {"no": 2}]', "text": '[{"s": "a}]', "twice": '[{"no": 1}][{"no": 2}]', "word": '[{"no": x}, {"no": 2}]', "after": '[{"no": 1}] z', "inner": '[{"deep": [1}]',
    }
    for name, text in bad.items():
        (tmp_path / f"{name}.json").write_text(text)
    (tmp_path / "empty.json").write_text("")
    (tmp_path / "good.json").write_text('[{"no": 7, "deep": {"a": {}}}]')
    records, skipped = readers.read_records_json(spark, str(tmp_path), SCHEMA)
    assert [(r.no, r.deep) for r in records.collect()] == [(7, '{"a":{}}')]
    got = {r.file.rsplit("/", 1)[1][:-5]: r.is_array for r in skipped.collect()}
    assert set(got) == set(bad)
    assert not got["blank"] and not got["object"] and not got["cut"] and got["comma"] and got["number"]


def test_texts_stay_in_the_task_that_reads_them(spark, tmp_path):
    """No shuffle of all texts or records, and every element is parsed once for each of the two outputs."""
    (tmp_path / "a.json").write_text(json.dumps([{"no": i, "s": "x" * 50} for i in range(50)]))
    records, _ = readers.read_records_json(spark, str(tmp_path), SCHEMA)
    plan = records._jdf.queryExecution().optimizedPlan().toString()
    assert "Repartition" not in plan and plan.count("ResolvedHint") + plan.count("rightHint=(strategy=broadcast)") >= 3
    assert sum("from_json(" in line for line in plan.splitlines()) == 2
    assert records.count() == 50


def test_compressed_files_are_read_like_others(spark, tmp_path, block_size):
    """A compressed file is one block, beside files that are cut."""
    rng, want = random.Random(block_size), []
    for i in range(4):
        rows = [element(rng, 1000 * i + k) for k in range(40 * i)]
        text = json.dumps(rows, ensure_ascii=False)
        (tmp_path / f"{i}.json").write_text(text) if i % 2 else (tmp_path / f"{i}.json.gz").write_bytes(gzip.compress(text.encode()))
        want += rows
    (tmp_path / "cut.json.gz").write_bytes(gzip.compress(b'[{"no": 1}, {"no": 2'))
    records, skipped = readers.read_records_json(spark, str(tmp_path), SCHEMA, glob="*.json*")
    assert sorted((r.no, r.s) for r in records.collect()) == sorted((w["no"], w["s"]) for w in want)
    assert [r.file.rsplit("/", 1)[1] for r in skipped.collect()] == ["cut.json.gz"]


def test_written_arrays_are_compressed(spark, sf, tmp_path, monkeypatch):
    """The texts of ``src01`` repeat all names; its scratch files stay far below them."""
    monkeypatch.setattr(row_queries, "scratch", lambda spark, name: f"{tmp_path}/{name}")
    assert entry.queries()["src01_json_array_files"](spark, sf).count() == 6000
    files = [p for p in (tmp_path / "arrays").glob("part-*")]
    texts = [gzip.decompress(p.read_bytes()) for p in files]
    assert sum(len(json.loads(t)) for t in texts) == 6000
    assert sum(p.stat().st_size for p in files) < 0.3 * sum(map(len, texts))
    assert "spark.sql.classic.shuffleDependency.fileCleanup.enabled" not in {k for k, v in spark.conf.getAll.items() if v == "true"}


def test_shuffle_files_of_a_write_go_with_it(spark, tmp_path):
    def shuffle_files():
        tops = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirsString()
        return {f for top in tops for _, _, names in os.walk(top) for f in names if f.startswith("shuffle_")}

    df = spark.range(20000).select((F.col("id") % 5000).alias("k")).groupBy("k").count()
    before = shuffle_files()
    with short_shuffles(spark):
        df.write.parquet(str(tmp_path / "short"))
    until = time.time() + 20
    while shuffle_files() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files() - before
    assert spark.read.parquet(str(tmp_path / "short")).count() == df.count() == 5000
