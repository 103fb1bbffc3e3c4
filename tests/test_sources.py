"""File sources and sinks."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from voltaria.schemas import AGENT_METRICS, SESSIONS
from voltaria.sources import metric_log as L
from voltaria.sources import panel as P
from voltaria.sources.dated_log import DatedLog
from voltaria.sources.sessions import read_sessions


def write(path, text):
    path.write_text(text)
    return str(path)


def test_sessions_csv_and_json(spark, tmp_path):
    csv = write(
        tmp_path / "s.csv",
        "connectionTime,disconnectTime,doneChargingTime,kWhDelivered,stationID,siteID\n"
        "2024-01-01 10:00:00,2024-01-01 12:00:00,,3.5,7,1\nbad,2024-01-01 12:00:00,,oops,8,1\n",
    )
    rows = read_sessions(spark, csv, "csv").orderBy("stationID").collect()
    assert rows[0]["kWhDelivered"] == 3.5 and rows[0]["connectionTime"] == dt.datetime(2024, 1, 1, 10)
    assert rows[1]["kWhDelivered"] is None and rows[1]["connectionTime"] is None and rows[1]["stationID"] == "8"
    json = write(tmp_path / "s.json", '{"connectionTime": "2024-01-01T10:00:00", "kWhDelivered": "NaN", "stationID": "1"}\n')
    df = read_sessions(spark, json, "json")
    assert df.schema.fieldNames() == SESSIONS.fieldNames() and df.first()["kWhDelivered"] is None


TIMES = "month,day,year,hour,minute,second\n" + "".join(f"1,1,2024,0,{m},0\n" for m in (0, 5, 10))


def test_wide_series(spark, tmp_path):
    index = P.read_time_index(spark, write(tmp_path / "time.csv", TIMES))
    assert [r["ts"].minute for r in index.orderBy("row").collect()] == [0, 5, 10]
    path = write(tmp_path / "occ.csv", "Unnamed: 0,102,104\n0,1,2\n1,3,x\n2,5,6\n")
    wide = P.read_wide_series(spark, path, index)
    assert wide.columns == ["row", "ts", "102", "104"]
    long = P.to_long(wide)
    assert long.count() == 6
    got = {(r["ts"].minute, r["station_id"]): r["value"] for r in long.collect()}
    assert got[5, "102"] == 3.0 and got[5, "104"] is None and got[10, "104"] == 6.0
    short = write(tmp_path / "short.csv", "102\n1\n")
    assert P.read_wide_series(spark, short, index).first()["ts"] is None
    own = write(tmp_path / "own.csv", "timestamp,102\n2024-01-01 03:00:00,1\n")
    assert P.read_wide_series(spark, own, index).first()["ts"] == dt.datetime(2024, 1, 1, 3)


def test_file_order_survives_splits(spark, tmp_path):
    path = write(tmp_path / "long.csv", "102\n" + "".join(f"{i}\n" for i in range(20000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        wide = P.read_wide_series(spark, path)
        assert spark.read.csv(path).rdd.getNumPartitions() > 1
        assert wide.where(F.col("row") != F.col("`102`").cast("long")).count() == 0
        assert wide.count() == 20000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_edges_and_districts(spark, tmp_path):
    adj = write(tmp_path / "adj.csv", "node_id,102,104,107\n102,0,1,0\n104,1,0,1\n107,0,1,0\n")
    dist = write(tmp_path / "dis.csv", ",102,104,107\n102,0,2.5,0\n104,2.5,0,4\n107,0,4,0\n")
    got = {(r["src"], r["dst"]): r["dist"] for r in P.read_edges(spark, adj, dist).collect()}
    assert got == {("102", "104"): 2.5, ("104", "102"): 2.5, ("104", "107"): 4.0, ("107", "104"): 4.0}
    info = write(tmp_path / "info.csv", "grid,num,count,area\n a ,1,5,2.5\nb,2,x,\n")
    rows = P.read_districts(spark, info).orderBy("num").collect()
    assert (rows[0]["grid"], rows[0]["count"], rows[1]["count"], rows[1]["CBD"]) == ("a", 5, None, None)
    assert P.read_stations(spark, info).columns == ["grid", "num", "count", "area"]


def test_metric_log(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = spark.createDataFrame([("a", "m", 1.0), ("b", "m", 2.0)], "agent_name string, metric_name string, metric_value double")
    L.append_log(rows, path, AGENT_METRICS, dt.datetime(2024, 1, 1))
    L.append_log(rows, path, AGENT_METRICS, dt.datetime(2024, 1, 2))
    newest = L.read_log(spark, path, AGENT_METRICS, {"agent_name": "b"}, 1).collect()
    assert len(newest) == 1 and newest[0]["timestamp"] == dt.datetime(2024, 1, 2) and newest[0]["metadata"] is None
    assert L.read_log(spark, path, AGENT_METRICS, limit=None).count() == 4
    now = L.conform(rows, AGENT_METRICS).first()["timestamp"]
    assert abs((dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) - now).total_seconds()) < 600
    pruned = spark.read.parquet(path).where(F.col("date") == "2024-01-02")
    assert "PartitionFilters: [isnotnull(date" in pruned._jdf.queryExecution().toString()


def test_dated_sink_counts(spark, tmp_path):
    df = spark.range(100).select(F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0,0,0,0,id)").alias("ts"), "id")
    P.write_by_date(df, str(tmp_path / "d"))
    assert spark.read.parquet(str(tmp_path / "d")).groupBy("date").count().count() == 5


def test_grid_size_constants():
    assert (P.EXPECTED_STEPS, P.EXPECTED_DISTRICTS, P.STEP_SECONDS) == (8641, 248, 300)


def test_lines_equal_columns_and_very_wide_files_stay_flat(spark, tmp_path):
    index = P.read_time_index(spark, write(tmp_path / "time.csv", TIMES))
    files = ["Unnamed: 0,102,104\n0,1,2\n1,3,x\n2,5,\n", 'timestamp,"102",104\n2024-01-01 03:00:00,"1",inf\n', "102\n1\n"]
    for i, text in enumerate(files):
        path = write(tmp_path / f"w{i}.csv", text)
        wide = P.read_wide_series(spark, path, index)
        want = sorted(map(str, P.to_long(wide, keys=("row", "ts")).collect()))
        assert sorted(map(str, P.read_long_series(spark, path, index).collect())) == want
    n = 20_000
    rows = [[0] * n for _ in range(3)]
    rows[0][7], rows[1][n - 1], rows[2][0] = 1, 1, 1
    adj = write(tmp_path / "wide.csv", "node_id," + ",".join(f"n{i}" for i in range(n)) + "\n" + "".join(f"n{i}," + ",".join(map(str, r)) + "\n" for i, r in enumerate(rows)))
    edges = P.read_edges(spark, adj, adj)
    assert sorted(tuple(r) for r in edges.collect()) == [("n0", "n7", 1.0), ("n1", f"n{n - 1}", 1.0), ("n2", "n0", 1.0)]
    assert len(edges._jdf.queryExecution().optimizedPlan().toString()) < 20_000


def decisions(spark, *days, source="rule"):
    rows = [(dt.datetime(2024, 3, d, h), f"s{h}", source) for d in days for h in range(4)]
    return spark.createDataFrame(rows, "timestamp timestamp_ntz, station_id string, decision_source string")


def test_dated_log_repeats_and_reads_the_newest_dates_only(spark, tmp_path):
    log = DatedLog(str(tmp_path / "dated"), decisions(spark, 1).schema)
    log.append(decisions(spark, *range(1, 15)), "run-1")
    log.append(decisions(spark, 14, 15, source="other"), "run-2")
    log.append(decisions(spark, 14, 15, source="other"), "run-2")
    assert log.read(spark).count() == 64 and log.read(spark, [dt.date(2024, 3, 14)]).count() == 8
    dates = lambda df: sorted({f.split("date=")[1][:10] for f in df.inputFiles()})
    six = log.newest(spark, limit=6, unique=("station_id", "decision_source"))
    assert dates(six) == ["2024-03-14", "2024-03-15"]
    assert [(r.timestamp.day, r.station_id, r.decision_source) for r in six.collect()] == [(15, f"s{h}", "other") for h in (3, 2, 1, 0)] + [(14, "s3", "rule"), (14, "s3", "other")]
    ruled = log.newest(spark, {"decision_source": "rule"}, 5)
    assert dates(ruled) == ["2024-03-13", "2024-03-14", "2024-03-15"] and [r.timestamp.day for r in ruled.collect()] == [14, 14, 14, 14, 13]
    assert log.newest(spark, {"decision_source": "none"}).count() == 0 and log.newest(spark).count() == 64
    log.append(decisions(spark, 15), "run-2")
    assert log.read(spark).count() == 60 and log.newest(spark, limit=1).first().decision_source == "rule"
    with pytest.raises(ValueError):
        log.append(decisions(spark, 1), "a/b")


def test_dated_log_without_manifest_of_an_append(spark, tmp_path):
    log = DatedLog(str(tmp_path / "half"), decisions(spark, 1).schema)
    log.append(decisions(spark, 1, 2), "a")
    decisions(spark, 9).withColumn("date", F.to_date("timestamp")).write.partitionBy("date").parquet(f"{log.path}/data/batch=b")
    assert log.read(spark).count() == 8 and log.newest(spark, limit=1).first().timestamp.day == 2
