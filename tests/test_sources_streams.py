import json
import threading

import pytest
from pyspark.sql import functions as F

from faultline.operators import windows
from faultline.sources import services, tables
from faultline.streaming import streams


def test_geojson(spark):
    doc = {"features": [{"id": "us1", "properties": {"mag": 4.5, "magType": "mw", "place": "x", "time": 1600000000123, "status": "reviewed"}, "geometry": {"coordinates": [35.0, 38.0, 7.0]}}, {"id": "us2", "properties": {"mag": None}, "geometry": {"coordinates": []}}]}
    rows = services.geojson_events(spark.createDataFrame([(json.dumps(doc),)], "value string"), "usgs").orderBy("event_id").collect()
    assert (rows[0].magnitude, rows[0].longitude, rows[0].depth_km, rows[0].source) == (4.5, 35.0, 7.0, "usgs") and rows[1].latitude is None


def test_service_source(spark):
    def fetch(year, agency):
        if year == 2001:
            raise OSError("down")
        return [(f"{agency}{year}", year)]

    spark.dataSource.register(services.service("quakes", "id string, year int", fetch))
    ask = json.dumps([{"year": y, "agency": "isc"} for y in (2000, 2001, 2002)])
    read = lambda: spark.read.format("quakes").option("requests", ask).option("tries", "1").option("pause", "0")
    assert sorted(r.id for r in read().option("onFailure", "skip").load().collect()) == ["isc2000", "isc2002"]
    with pytest.raises(Exception, match="down"):
        read().load().collect()


def test_inventory(spark):
    landed = spark.createDataFrame([("KO", "A", 38.0, 36.0, 10.0, None, [("HNE", "00"), ("HHZ", "00"), ("HNE", "10")]), ("KO", "B", 38.0, 36.0, 10.0, None, [("XYZ", "00")])], "network string, station string, latitude double, longitude double, elevation double, start_date timestamp, channels array<struct<code:string,location:string>>")
    stations, channels = services.station_tables(landed)
    got = {r.station: (r.channel_codes, r.instrument_types, r.has_strong_motion) for r in stations.collect()}
    assert got == {"A": ("HHZ,HNE", "broadband,strong_motion", True), "B": ("XYZ", "bilinmiyor", False)} and channels.count() == 4
    sites = services.enrich_sites(stations, spark.createDataFrame([("A", 400.0), ("B", -1.0)], "station string, vs30_ms double"))
    assert {r.station: r.nehrp_site_class for r in sites.collect()} == {"A": "C", "B": None}


def test_binary_traces(spark, tmp_path):
    (tmp_path / "good.bin").write_bytes(b"1,2,3")
    (tmp_path / "bad.bin").write_bytes(b"x")
    out = services.binary_traces(spark, str(tmp_path), lambda b: [("HNE", 0, 100, [float(x) for x in b.split(b",")])])
    got = {r.file.rpartition("/")[2]: (r.samples, r.error) for r in out.collect()}
    assert got == {"good.bin": ([1.0, 2.0, 3.0], None), "bad.bin": (None, "ValueError")}


def test_strict_scan_and_log(spark, tmp_path):
    df = spark.createDataFrame([(" a ", "1.5"), ("b", "x"), ("c", "NaN"), ("d", "900")], "k string, v string")
    assert [r.v for r in tables.strict(df, {"k": "string", "v": "double"}, {"v": (0, 100)}).orderBy("k").collect()] == [1.5, None, None, None]
    with pytest.raises(ValueError, match="nope"):
        tables.strict(df, {"nope": "double"})
    path = str(tmp_path / "log")
    tables.append_log(df.limit(2), path)
    tables.append_log(df.limit(1), path)
    assert tables.pending(df, spark.read.parquet(path), ["k"]).count() == 2
    assert {r.event_source for r in tables.migrate_log(df).collect()} == {"usgs"}
    made = []
    for _ in range(2):
        tables.cached(spark, str(tmp_path / "cache"), lambda: made.append(1) or df)
    assert len(made) == 1
    with pytest.raises(FileNotFoundError):
        tables.resolve(data_dir=str(tmp_path), name="missing")


def run(stream, spark, name):
    q = stream.writeStream.format("memory").queryName(name).outputMode("append").trigger(availableNow=True).start()
    guard = threading.Timer(120, q.stop)
    guard.start()
    q.awaitTermination()
    guard.cancel()
    return spark.table(name)


def test_stream_equals_batch(spark, tmp_path):
    times = [0, 100, 250, 1000, 1209, 5000, 90000]
    rows = spark.createDataFrame([(f"e{i}", 1.6e9 + t) for i, t in enumerate(times)], "event_id string, t_sec double").withColumn("time_utc", F.timestamp_micros((F.col("t_sec") * 1e6).cast("long")))
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 10).parquet(str(tmp_path / "in"))
    got = {r.window_group: r.n for r in run(streams.session_groups(stream), spark, "sessions").collect()}
    batch = {r.window_group: r["count"] for r in windows.sessionize(rows, "event_id", "t_sec").groupBy("window_group").count().collect()}
    assert got == {k: v for k, v in batch.items() if k != "e6"}  # the last session waits for the watermark
    twice = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    assert run(streams.first_of_each(twice, ["event_id"]), spark, "firsts").count() == len(times)


def test_peaks_after_pick(spark, tmp_path):
    rows = spark.createDataFrame([("e", "A", s / 10, float((-1) ** s * s)) for s in range(-5, 60)], "event_id string, station string, sec double, amplitude double")
    rows.write.parquet(str(tmp_path / "in"))
    stream = streams.peaks_after_pick(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")))
    q = stream.writeStream.format("memory").queryName("peaks").outputMode("update").trigger(availableNow=True).start()
    q.awaitTermination()
    r = spark.table("peaks").orderBy(F.desc("peak_10s")).first()
    assert (r.peak_1s, r.peak_3s, r.peak_5s, r.peak_10s) == (9.0, 29.0, 49.0, 59.0)
