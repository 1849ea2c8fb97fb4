"""Versions behind a pointer, and distinct sketches."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidegate.errors import ConnectorError
from tidegate.operators import roll_up, sketch_windows, with_estimate
from tidegate.operators.sketches import standard_error
from tidegate.plans import connector
from tidegate.sinks import publish_file, published_versions, read_published, versions


def ids(df):
    return sorted(r.id for r in df.collect())


def failing(spark):
    """A load whose last task fails after others have written."""
    return spark.range(0, 40, 1, 4).select(F.expr("IF(id = 39, raise_error('lost'), id)").cast("long").alias("id"))


def test_a_failed_load_leaves_the_former_version(spark, tmp_path):
    path = str(tmp_path / "set")
    with pytest.raises(ConnectorError, match="No version"):
        read_published(spark, path)
    with pytest.raises(ConnectorError):
        publish_file(failing(spark), path)
    assert published_versions(spark, path).count() == 0
    publish_file(spark.range(5), path)
    before = read_published(spark, path)
    with pytest.raises(ConnectorError):
        publish_file(failing(spark), path)
    assert ids(read_published(spark, path)) == [0, 1, 2, 3, 4]
    publish_file(read_published(spark, path).where("id > 2"), path)  # made of the version it follows
    assert ids(read_published(spark, path)) == [3, 4]
    assert ids(before) == [0, 1, 2, 3, 4]  # a reader keeps the version it began with
    assert sorted(r.number for r in published_versions(spark, path).collect()) == [0, 1]


def test_a_driver_lost_before_the_pointer_publishes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "set")
    publish_file(spark.range(2), path)
    written = []

    def write_and_die(*args):
        versions.read_file(spark, path + "/versions/*")
        written.append(args[1])
        raise KeyboardInterrupt

    monkeypatch.setattr(versions, "write_file", write_and_die)
    with pytest.raises(KeyboardInterrupt):
        publish_file(spark.range(9), path)
    assert written and ids(read_published(spark, path)) == [0, 1]


def test_two_loads_at_a_time_do_not_both_publish(spark, tmp_path, monkeypatch):
    path, real = str(tmp_path / "set"), versions.write_file

    def meanwhile(*args):
        real(*args)
        monkeypatch.setattr(versions, "write_file", real)
        publish_file(spark.range(1), path)

    monkeypatch.setattr(versions, "write_file", meanwhile)
    with pytest.raises(ConnectorError, match="meanwhile"):
        publish_file(spark.range(9), path)
    assert ids(read_published(spark, path)) == [0]


@pytest.mark.parametrize("file_type", ["parquet", "json"])
def test_specs_publish_and_read_what_was_published(spark, tmp_path, file_type):
    place = {"connector_type": "local_file", "file_type": file_type, "file_path": f"{tmp_path}/set"}
    sink = connector("sink", {**place, "write_mode": "publish", "write_props": {}})
    source = connector("source", {**place, "dataset_name": "d", "read_props": {"published": True}})
    for n in (3, 2):
        sink.write(spark.range(n))
        assert ids(source.read(spark)) == list(range(n))


START = dt.datetime(2024, 1, 1)


def test_sketches_of_hours_add_up_to_the_day(spark):
    rows = spark.range(0, 60_000, 1, 6).selectExpr(
        "TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id % 172800) AS t",
        "IF(id % 3 = 0, 'hot', 'cold') AS g", "IF(id % 50 = 1, NULL, id % 9000) AS item",
    )
    days = with_estimate(roll_up(sketch_windows(rows, "t", "g", "item"), "g")).collect()
    exact = rows.groupBy(F.to_date("t").alias("d"), "g").agg(F.count("*").alias("n"), F.count_distinct("item").alias("k"))
    want = {(r.d, r.g): (r.n, r.k) for r in exact.collect()}
    assert {(r.window_start.date(), r.g) for r in days} == want.keys()
    for r in days:
        n, k = want[r.window_start.date(), r.g]
        assert r.rows == n and abs(r.distinct_items - k) <= 4 * standard_error() * k


def test_sketches_of_a_stream_come_out_when_their_window_is_over(spark, tmp_path):
    rows = [(START + dt.timedelta(minutes=m), "g", m % 7) for m in range(0, 130, 5)] + [(None, "g", 1)]
    spark.createDataFrame(rows, "t TIMESTAMP, g STRING, item INT").coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("t TIMESTAMP, g STRING, item INT").parquet(f"{tmp_path}/in")
    sketched = sketch_windows(stream, "t", "g", "item", watermark="1 minute")
    writer = sketched.writeStream.format("parquet").option("path", f"{tmp_path}/out")
    assert writer.option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start().awaitTermination(60)
    out = with_estimate(spark.read.schema(sketched.schema).parquet(f"{tmp_path}/out")).collect()
    assert sorted((r.window_start.hour, r.rows, r.distinct_items) for r in out) == [(0, 12, 7), (1, 12, 7)]
