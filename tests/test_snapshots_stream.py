"""Snapshot sink/source round trip and the incremental (streaming) silver run."""

import tempfile

import pytest
from pyspark.sql import functions as F

from tidemark.sources.snapshots import export_csv, export_json, published_runs, read_best_gold, read_latest_snapshot, write_snapshot


def test_snapshot_round_trip(spark):
    root = tempfile.mkdtemp(prefix="tm-snap-", dir="/tmp")
    a = spark.createDataFrame([(1, ["x"])], "row_id long, tags array<string>")
    b = spark.createDataFrame([(2, ["y"]), (3, [])], "row_id long, tags array<string>")
    assert write_snapshot(a.limit(0), root, "gold", "20240101_000000") is None
    write_snapshot(a, root, "gold", "20240101_000000")
    write_snapshot(b, root, "gold", "20240102_000000")
    latest = read_latest_snapshot(spark, root, "gold")
    assert sorted(r["row_id"] for r in latest.collect()) == [2, 3]
    assert sorted(r["row_id"] for r in read_best_gold(spark, root).collect()) == [2, 3]
    export_csv(latest, f"{root}/csv")
    export_json(latest, f"{root}/json")
    assert spark.read.option("header", True).csv(f"{root}/csv").count() == 2
    assert spark.read.json(f"{root}/json").count() == 2


def test_unpublished_runs_are_not_read(spark):
    root = tempfile.mkdtemp(prefix="tm-publish-", dir="/tmp")
    a = spark.createDataFrame([(1,)], "row_id long")
    write_snapshot(a, root, "gold", "20240101_000000")
    a.union(a).write.parquet(f"{root}/gold/run_id=20240102_000000")  # its writer was lost before it published
    assert read_latest_snapshot(spark, root, "gold").count() == 1 and read_best_gold(spark, root).count() == 1
    assert [tuple(r) for r in published_runs(spark, root, "gold").collect()] == [(1, "20240101_000000")]
    assert write_snapshot(a.union(a), root, "gold", "20240102_000000") == "20240102_000000"
    assert read_latest_snapshot(spark, root, "gold").count() == 2
    with pytest.raises(ValueError):
        write_snapshot(a, root, "gold", "20240102_000000")
    with pytest.raises(FileNotFoundError):
        read_latest_snapshot(spark, root, "silver")


def test_incremental_silver(spark):
    from tidemark.streaming.snapshots import incremental_silver

    root = tempfile.mkdtemp(prefix="tm-stream-", dir="/tmp")
    rows = [(1, "Markets fall sharply today", "2024-01-01T00:00:00", 10.0),
            (2, "Markets fall sharply today", "2024-01-01T00:00:00", 10.0),
            (3, "", "2024-01-01T00:00:00", 10.0)]
    df = spark.createDataFrame(rows, "row_id long, headline string, timestamp string, price double")
    write_snapshot(df, root, "bronze", "20240101_000000")
    schema = spark.read.parquet(f"{root}/bronze").schema
    q = incremental_silver(spark, f"{root}/bronze", f"{root}/silver", f"{root}/ckpt", schema)
    q.awaitTermination(120)
    out = spark.read.parquet(f"{root}/silver")
    assert out.count() == 1 and out.first()["row_id"] == 1
    assert out.where(F.col("snippet").endswith("[Price: $10.00]")).count() == 1


def test_replayed_batch_and_split_run(spark):
    from tidemark.streaming.snapshots import read_silver, write_batch

    root = tempfile.mkdtemp(prefix="tm-replay-", dir="/tmp") + "/silver"
    schema = "row_id long, headline string, timestamp string, price double, run_id string"
    first = spark.createDataFrame([(1, "Markets fall sharply today", "2024-01-01T00:00:00", 10.0, "r1"), (2, "Other headline", "2024-01-01T00:00:00", 1.0, "r1")], schema)
    second = spark.createDataFrame([(3, "Markets fall sharply today", "2024-01-01T00:00:00", 10.0, "r1"), (4, "Markets fall sharply today", "2024-01-01T00:00:00", 10.0, "r2")], schema)
    for batch, batch_id in ((first, 0), (first, 0), (second, 1), (second, 1)):  # every batch is replayed after its write
        write_batch(batch, batch_id, root)
    assert spark.read.parquet(root).count() == 4
    assert sorted((r.row_id, r.run_id) for r in read_silver(spark, root).collect()) == [(1, "r1"), (2, "r1"), (4, "r2")]
