"""Raw loading, layered writes, export policies, parameters and the shared folder."""

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from refrain.functions.calendar import since
from refrain.session import scratch_path, shared_folder
from refrain.sources import writers
from refrain.sources.tables import bound_query, read_database, read_table, spread


def test_corrupt_lines_are_kept(spark, tmp_path):
    (tmp_path / "part.json").write_text('{"id": 1, "name": "a"}\n{"id": 2, "na\n{"id": "x", "name": "c"}\n')
    loaded = writers.load_raw(spark, str(tmp_path), "id long, name string").cache()
    rows = loaded.select("id", F.col(writers.CORRUPT).isNotNull().alias("bad")).collect()
    assert len(rows) == 3 and sum(r.bad for r in rows) == 2


def test_only_present_partitions_are_replaced(spark):
    target = scratch_path(spark, "layer")
    day = dt.date(2024, 1, 1)
    first = spark.createDataFrame([(day, 1), (day + dt.timedelta(days=1), 2)], "dt date, v long")
    writers.write_layer(first, target, "dt")
    writers.write_layer(spark.createDataFrame([(day, 9)], "dt date, v long"), target, "dt")
    assert sorted(r.v for r in spark.read.parquet(target).collect()) == [2, 9]


def test_layers_are_built_from_the_written_ones(spark):
    from refrain.plans.layers import write_layers
    from refrain.plans.warehouse import Warehouse

    target = scratch_path(spark, "layers")
    w = Warehouse(spark, "/root/testdata/sf0.001")
    names = ["dwd_comment_detail", "dws_song_daily", "ads_song_rank", "ads_user_portrait"]
    stored = write_layers(w, target, names)
    for attribute in ("song_daily", "song_rank", "portrait"):
        fresh, written = getattr(w, attribute), getattr(stored, attribute).select(getattr(w, attribute).columns)
        assert fresh.exceptAll(written).count() == written.exceptAll(fresh).count() == 0
    day = stored.song_daily.filter("dt = DATE'2024-01-05'")
    plan = day._jdf.queryExecution().toString()
    assert "events.parquet" not in plan
    partition = plan[plan.index("PartitionFilters: [") :].splitlines()[0]
    assert "dt" in partition.split("]")[0]


def test_export_policies(spark, tmp_path):
    frame = spark.createDataFrame(
        [(Decimal("1.50"), dt.date(2024, 1, 2), dt.datetime(2024, 1, 2, 3, 4, 5), bytearray(b"ab"), None)],
        "d decimal(5,2), day date, t timestamp_ntz, b binary, n string",
    )
    text = json.loads(writers.to_json_rows(frame.drop("b"), "as_string").first().json)
    assert text == {"d": "1.50", "day": "2024-01-02", "t": "2024-01-02 03:04:05", "n": None}
    number = json.loads(writers.to_json_rows(frame, "as_float").first().json)
    assert number == {"d": 1.5, "day": "2024-01-02", "t": "2024-01-02T03:04:05", "b": "ab", "n": None}
    writers.export_json(frame, str(tmp_path / "out"), "as_float")
    lines = [p.read_text() for p in (tmp_path / "out").glob("part-*")]
    assert json.loads("".join(lines)) == number


def test_undecodable_bytes_are_ignored(spark):
    frame = spark.createDataFrame([(bytearray(b"a\xff\xc3b\xe6\xad\x8c"),)], "b binary")
    assert json.loads(writers.to_json_rows(frame, "as_float").first().json) == {"b": "ab歌"}


def test_parameters_are_bound_not_spliced(spark):
    frame = spark.createDataFrame([(1, "x' OR '1'='1")], "id long, s string")
    rows = bound_query(spark, "SELECT id FROM {t} WHERE s = :s", {"s": "x' OR '1'='1"}, {"t": frame}).collect()
    assert [r.id for r in rows] == [1]


def test_database_reader_needs_bounds(spark):
    with pytest.raises(ValueError):
        read_database(spark, "jdbc:mysql://nowhere/db", "t", split_on="id")


def test_time_filter_reaches_the_files(spark):
    events = read_table(spark, "/root/testdata/sf0.001", "events").filter(
        since(F.col("ts"), F.lit(dt.date(2024, 1, 20)), 3)
    )
    plan = events.select("user_id")._jdf.queryExecution().toString()
    scan = plan[plan.index("PushedFilters") :].splitlines()[0]
    assert "GreaterThanOrEqual(ts" in scan and "props" not in scan


def test_documents_carry_their_length(spark):
    documents = read_table(spark, "/root/testdata/sf0.01", "documents")
    assert documents.filter("n_chars IS DISTINCT FROM char_length(text)").count() == 0


def test_spread_leaves_large_inputs_alone(spark):
    large = spark.range(0, 1 << 30, 1, 2)  # fewer splits than cores, but too much to shuffle
    assert spread(large) is large
    assert spread(spark.range(0, 1000, 1, 1)).rdd.getNumPartitions() > 1


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
