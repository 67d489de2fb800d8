"""JSON arrays cut into records by many tasks, whatever lies at the borders of blocks."""

import json
import os
import random

import pytest

from newsatlas import sources


@pytest.fixture
def small_blocks(spark):
    """Files are divided into blocks of a few dozen bytes."""
    settings = {"spark.sql.files.maxPartitionBytes": "64", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def found(spark, path):
    return sorted(r.record for r in sources.records(sources.pieces(spark, str(path))).collect())


NASTY = ["}", "{", '"', "\\", '\\"', "},{", "[", "a\nb", "é日", "", " } { ", '{"a": 1}', "\\\\}"]


def objects(rng, n):
    out = []
    for i in range(n):
        o = {"n": i, "s": "".join(rng.choice(NASTY) for _ in range(rng.randint(0, 6)))}
        if rng.random() < 0.4:
            o["long"] = {"$numberLong": str(i), "more": {rng.choice(NASTY): []}}
        if rng.random() < 0.1:
            o["s"] += "x" * rng.randint(60, 400)  # longer than some blocks
        out.append(o)
    return out


@pytest.mark.parametrize("indent", [None, 2])
def test_records_equal_the_arrays(spark, tmp_path, small_blocks, indent):
    rng = random.Random(indent or 0)
    expected = []
    for name in range(4):
        data = objects(rng, rng.choice([0, 1, 40, 90]))
        (tmp_path / f"{name}.json").write_text(json.dumps(data, indent=indent, ensure_ascii=bool(name % 2)))
        expected += data
    pieces = sources.pieces(spark, str(tmp_path))
    assert pieces.rdd.getNumPartitions() > 20
    assert pieces.select("file", "block").distinct().count() > 20
    got = [json.loads(r) for r in found(spark, tmp_path)]
    order = lambda o: json.dumps(o, sort_keys=True)
    assert sorted(got, key=order) == sorted(expected, key=order)


def test_odd_files(spark, tmp_path, small_blocks):
    (tmp_path / "one.json").write_text('  {"a": 1}\n')
    (tmp_path / "others.json").write_text('[1, null, {"b": "}"}, "{", [{"c": {}}], {}]')
    (tmp_path / "empty.json").write_text("")
    (tmp_path / "lines.json").write_text('{"d": 1}\n{"d": 2}\n')
    assert found(spark, tmp_path) == ['{"a": 1}', '{"b": "}"}', '{"c": {}}', '{"d": 1}', '{"d": 2}', "{}"]


def test_truncated_files_lose_no_whole_record(spark, tmp_path, small_blocks):
    text = json.dumps([{"GKGRECORDID": f"r{i}", "Themes": "T" * i} for i in range(30)])
    (tmp_path / "cut.json").write_text(text[: len(text) // 2])
    whole = text[: len(text) // 2].count("}")
    rows = sources.read_json(spark, str(tmp_path), "gkg").collect()
    assert [r.GKGRECORDID for r in sorted(rows, key=str)].count(None) == 1 and len(rows) == whole + 1
    assert {r.GKGRECORDID for r in rows} == {f"r{i}" for i in range(whole)} | {None}


def test_one_array_is_read_by_many_tasks(spark, tmp_path, small_blocks):
    rows = [{"GLOBALEVENTID": {"$numberLong": str(i)}, "MentionTimeDate": 20240105120000 + i, "MentionSourceName": "},{" * (i % 9)}
            for i in range(200)]
    os.makedirs(f"{tmp_path}/m")
    with open(f"{tmp_path}/m/all.json", "w") as file:
        json.dump(rows, file)
    read = sources.read_json(spark, f"{tmp_path}/m", "mentions")
    got = sorted((r.GLOBALEVENTID, r.MentionTimeDate, r.MentionSourceName) for r in read.collect())
    assert got == [(i, 20240105120000 + i, "},{" * (i % 9)) for i in range(200)]
    whole = spark.read.schema("GLOBALEVENTID string, MentionTimeDate string, MentionSourceName string").option("multiLine", True)
    assert len(got) == whole.json(f"{tmp_path}/m").count()
