"""Folders with versions: snapshots switch as a whole, writers lose and double nothing."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from sparkrec.sources import sinks, versions

PAIR = "item_id_1 long, item_id_2 long, common_users long, similarity_score double"


def _pairs(spark, lo, hi):
    return spark.createDataFrame([(i, i + 1, 20 + i, i / 100) for i in range(lo, hi)], PAIR)


def _table(spark, path):
    return [tuple(r) for r in sinks.similarity_table(spark, path).orderBy("similarity_id").drop("created_at").collect()]


def test_ids_go_on_and_times_stay(spark, tmp_path):
    path = f"{tmp_path}/t"
    days = [F.lit(f"2024-01-0{k} 00:00:00").cast("timestamp") for k in (1, 2)]
    sinks.append_similarities(spark, _pairs(spark, 5, 8), path, created_at=days[0])
    sinks.append_similarities(spark, _pairs(spark, 0, 8), path, created_at=days[1])
    assert [r[:2] for r in _table(spark, path)] == [(1, 5), (2, 6), (3, 7)] + [(4 + i, i) for i in range(5)]
    by_day = sinks.similarity_table(spark, path).groupBy(F.dayofmonth("created_at").alias("d")).agg(F.max("similarity_id")).collect()
    assert sorted(map(tuple, by_day)) == [(1, 3), (2, 8)]
    number = versions.current(spark, path).number
    assert sinks.append_similarities(spark, _pairs(spark, 0, 8), path).count() == 8
    assert versions.current(spark, path).number == number == 2
    assert sinks.similarity_table(spark, path).columns == ["similarity_id", *PAIR.replace(" long", "").replace(" double", "").split(", "), "created_at"]


def test_a_writer_that_comes_second_counts_the_others_pairs(spark, tmp_path, monkeypatch):
    path, publish = f"{tmp_path}/t", versions.publish

    def late(spark_, folder, version):
        monkeypatch.setattr(versions, "publish", publish)
        sinks.append_similarities(spark, _pairs(spark, 0, 6), path)  # between reading and publishing
        return publish(spark_, folder, version)

    sinks.append_similarities(spark, _pairs(spark, 0, 2), path)
    monkeypatch.setattr(versions, "publish", late)
    sinks.append_similarities(spark, _pairs(spark, 4, 9), path)
    assert [r[:2] for r in _table(spark, path)] == [(i + 1, i) for i in range(9)]
    assert versions.current(spark, path).number == 3


def test_strict_writer_that_comes_second_is_rejected(spark, tmp_path, monkeypatch):
    path, publish = f"{tmp_path}/t", versions.publish

    def late(spark_, folder, version):
        monkeypatch.setattr(versions, "publish", publish)
        sinks.append_similarities(spark, _pairs(spark, 0, 6), path)
        return publish(spark_, folder, version)

    monkeypatch.setattr(versions, "publish", late)
    with pytest.raises(ValueError, match="already"):
        sinks.append_similarities(spark, _pairs(spark, 4, 9), path, strict=True)
    assert [r[1] for r in _table(spark, path)] == list(range(6))


def test_writers_at_once(spark, tmp_path):
    path = f"{tmp_path}/t"
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda lo: sinks.append_similarities(spark, _pairs(spark, lo, lo + 12), path), (0, 6, 12, 18)))
    rows = _table(spark, path)
    assert sorted(r[1] for r in rows) == list(range(30))
    assert [r[0] for r in rows] == list(range(1, 31))


def test_one_number_is_taken_once(spark, tmp_path):
    one = versions.Version(1, {})
    with ThreadPoolExecutor(8) as pool:
        assert sum(pool.map(lambda _: versions.publish(spark, str(tmp_path), one), range(8))) == 1
    assert versions.current(spark, str(tmp_path)) == one
    assert sorted(p.name for p in (tmp_path / versions.MANIFESTS).iterdir()) == ["000000000001.json"]


def test_empty_and_null_batches(spark, tmp_path):
    path = f"{tmp_path}/t"
    assert sinks.append_similarities(spark, _pairs(spark, 0, 0), path).count() == 0
    assert sinks.append_similarities(spark, _pairs(spark, 0, 3), path).count() == 3
    assert sinks.append_similarities(spark, _pairs(spark, 0, 0), path).count() == 3
    with pytest.raises(ValueError, match="null"):
        sinks.append_similarities(spark, spark.createDataFrame([(None, 2, 3, 0.5)], PAIR), path)


def test_snapshots_switch_as_a_whole(spark, tmp_path):
    folder = f"file://{tmp_path}/s"
    old = {n: spark.createDataFrame([(1, f"{n} old")], "id long, v string") for n in ("a", "b")}
    sinks.snapshot_write(old, folder)
    before = versions.current(spark, folder)
    fails = spark.range(1).select("id", F.raise_error(F.lit("lost")).cast("string").alias("v"))
    with pytest.raises(Exception, match="lost"):
        sinks.snapshot_write({"a": spark.createDataFrame([(2, "a new")], "id long, v string"), "b": fails}, folder)
    assert versions.current(spark, folder) == before and versions.read(spark, folder, "a").collect() == [(1, "a old")]
    reader = versions.read(spark, folder, "a")
    sinks.snapshot_write({"a": spark.createDataFrame([(2, "a new"), (3, None)], "id long, v string")}, folder)
    assert sorted(versions.read(spark, folder, "a").collect()) == [(2, "a new"), (3, None)]
    assert versions.read(spark, folder, "b").collect() == [(1, "b old")]
    assert versions.read(spark, folder, "a", 1).collect() == reader.collect() == [(1, "a old")]
    with pytest.raises(KeyError):
        versions.read(spark, folder, "c")


def test_vacuum_leaves_what_is_named_or_young(spark, tmp_path):
    folder = f"{tmp_path}/s"
    for k in range(4):
        sinks.snapshot_write({"a": spark.range(k)}, folder)
    assert versions.vacuum(spark, folder) == []
    assert len(versions.vacuum(spark, folder, keep=2, min_age_s=0)) == 2
    assert versions.read(spark, folder, "a").count() == 3 and versions.read(spark, folder, "a", 3).count() == 2
    assert versions.vacuum(spark, folder, keep=2, min_age_s=0) == []


def test_csv_snapshot_and_foreign_folder(spark, tmp_path):
    sinks.snapshot_write({"a": spark.createDataFrame([(1, 'x, "y"', 0.5)], "id long, v string, r double")}, f"{tmp_path}/c", csv=True)
    assert versions.read(spark, f"{tmp_path}/c", "a").collect() == [(1, 'x, "y"', 0.5)]
    spark.range(3).write.parquet(f"{tmp_path}/plain")
    with pytest.raises(ValueError, match="no versions"):
        sinks.append_similarities(spark, _pairs(spark, 0, 2), f"{tmp_path}/plain")
