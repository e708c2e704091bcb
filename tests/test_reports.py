import json
import random
import subprocess
from datetime import UTC, datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

import faultline
from faultline import cli
from faultline.operators import joins, provenance, reports, validation
from faultline.sources import services, tables


def test_matched_picks_by_brute_force(spark):
    rng = random.Random(11)
    keys = [(rng.choice("abc"), rng.choice(["S1", "S2", None])) for _ in range(40)]
    at = lambda: datetime.fromtimestamp(1.7e9 + rng.random() * 9, UTC)
    analyst = [(e, s, rng.choice("PS"), at()) for e, s in keys[:20]]
    automatic = [(e, s, at() if rng.random() < 0.8 else None, rng.random(), rng.choice(["train", "test"])) for e, s in keys[20:]]
    a = spark.createDataFrame(analyst, "event_id string, station string, phase_type string, pick_time timestamp")
    b = spark.createDataFrame(automatic, "event_id string, station string, p_pick_time timestamp, p_pick_confidence double, split string")
    got = sorted((r.event_id, r.station, r.split, round(r.abs_error_sec, 5)) for r in reports.matched_picks(a, b, "P").collect())
    want = [(e, s, split, round(abs((t - u).total_seconds()), 5)) for e, s, phase, u in analyst if phase == "P" for f, z, t, _, split in automatic if (e, s) == (f, z) and s and t]
    assert got == sorted(want) and want
    out = {r.split: r for r in reports.pick_report(reports.matched_picks(a, b, "P")).collect()}
    for split, r in out.items():
        errors = [x[3] for x in want if x[2] == split]
        assert r.n_matched == len(errors) == r.n_high_confidence + r.n_low_confidence and r.p90_abs_error_sec == pytest.approx(np.quantile(errors, 0.9), abs=1e-4)
    with pytest.raises(ValueError, match="phase"):
        reports.matched_picks(a, b, "Q")


def motions(spark, n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        m, h, v = rng.uniform(3, 7), rng.uniform(5, 300), rng.uniform(200, 900)
        rows.append((f"e{i % 9}", f"s{i % 4}", m, h, v, float(10 ** (0.5 * m - 1.5 * np.log10(h) - 0.3 * np.log10(v) + rng.gauss(0, 0.2)))))
    rows += [("x", "s0", 4.0, 9.0, None, 0.1), ("x", "s0", 4.0, 9.0, 300.0, 0.0)]  # neither can be used
    return rows, spark.createDataFrame(rows, "event_id string, station string, magnitude double, hypocentral_distance_km double, vs30_ms double, pga_g double")


def test_score_split_is_least_squares(spark):
    (train, a), (test, b) = motions(spark, 60, 1), motions(spark, 45, 2)
    got = {r.model: r for r in reports.score_split(a, b, reps=50).collect()}
    design = lambda rows: (np.array([[m, np.log10(h), np.log10(v), 1] for _, _, m, h, v, p in rows if v and p > 0]), np.array([np.log10(p) for *_, v, p in rows if v and p > 0]))
    (x, y), (u, w) = design(train), design(test)
    k = np.linalg.lstsq(x, y, rcond=None)[0]
    for model, residual in (("linear_ols", w - u @ k), ("naive_train_mean", w - y.mean())):
        r = got[model]
        assert (r.train_records, r.test_records, r.test_events, r.test_stations) == (60, 45, 9, 4)
        assert r.rmse == pytest.approx(np.sqrt((residual**2).mean())) and r.bias == pytest.approx(residual.mean()) and r.r2 == pytest.approx(1 - (residual**2).sum() / ((w - w.mean()) ** 2).sum())
        assert r.rmse_low <= r.rmse <= r.rmse_high
    assert got["linear_ols"].rmse < got["naive_train_mean"].rmse
    assert {r.rmse_low for r in reports.score_split(a, b.drop("event_id"), reps=5).collect()} == {None}
    with pytest.raises(ValueError, match="vs30_ms"):
        reports.score_split(a, b.drop("vs30_ms"))
    with pytest.raises(ValueError, match="positive target"):
        reports.score_split(a, b.where("false"))
    c = reports.model_comparison(a, b, F.lit(-1.0)).first()
    assert c.linear_rmse == pytest.approx(got["linear_ols"].rmse) and c.model_rmse == pytest.approx(np.sqrt(((w + 1) ** 2).mean())) and c.unbiased_rmse == pytest.approx(w.std())


def test_comparison_skips_no_row_at_distance_zero(spark):
    (_, a), (rows, b) = motions(spark, 60, 1), motions(spark, 45, 2)
    zero = spark.createDataFrame([("z", "s0", 4.0, 0.0, 300.0, 0.1)], b.schema)
    want = [-1.0 - np.log10(p) for *_, v, p in rows if v and p > 0] + [0.0]
    fitted, only_test = (reports.model_comparison(x, b.unionByName(zero), F.lit(-1.0)).first() for x in (a.unionByName(zero), a))
    assert fitted.n == only_test.n == len(want) and fitted.model_rmse == pytest.approx(np.sqrt(np.mean(np.square(want))))
    assert np.isnan(fitted.linear_rmse) and np.isinf(only_test.linear_rmse)


def test_installed_and_targets(spark):
    df = spark.createDataFrame([(1, None), (1, 1), (1, 2)], "t int, start int")
    assert [r[0] for r in df.select(joins.installed(F.col("t"), F.col("start"))).collect()] == [True, True, False]
    log = spark.createDataFrame([("e", "B", "ok"), ("e", "A", "ok"), ("e", "A", "ok"), ("e", "C", "error"), ("f", "A", "no_data"), (None, "A", "ok"), ("unknown", "A", "ok")], "event_id string, station string, status string")
    events = spark.createDataFrame([("e", 2, 5.0), ("e", 1, 4.0), ("f", 1, 3.0)], "event_id string, time_utc int, magnitude double")
    assert [tuple(r) for r in joins.target_events(log, events).collect()] == [("e", ["A", "B"], 1, 4.0)]


def test_statuses_and_revision(spark, tmp_path):
    counts = spark.createDataFrame([("a", "reports", 3), ("b", "reports", 0), ("n", "rows", 2), ("w", "rows", 2), ("w", "waveform_files", 5), ("v", "with_vs30", 0)], "source string, metric string, value long")
    kinds = {"a": "catalog", "b": "catalog", "c": "catalog", "n": "network", "w": "network", "u": "network", "v": "sites"}
    got = {r.source: r.status for r in provenance.source_statuses(counts, kinds, skipped=("b",)).collect()}
    assert got == {
        "a": "catalog_records_observed", "b": "no_catalog_records_observed_picks_skipped", "c": "catalog_source_status_unverified", "n": "stations_observed_no_waveforms",
        "w": "stations_and_waveforms_observed", "u": "koeri_source_status_unverified", "v": "no_vs30_values_observed",
    }
    with pytest.raises(RuntimeError, match="no revision"):
        provenance.revision(tmp_path)
    git = ["git", "-C", str(tmp_path), "-c", "user.name=n", "-c", "user.email=e@example.org"]
    subprocess.run([*git[:3], "init", "-q"], check=True)
    subprocess.run([*git, "commit", "-q", "--allow-empty", "-m", "one"], check=True)
    assert provenance.revision(tmp_path)["dirty"] is False
    (tmp_path / "new").write_text("x")
    assert provenance.revision(tmp_path)["dirty"] is True and len(provenance.revision(tmp_path)["revision"]) == 40
    assert provenance.versions(("pyspark", "no-such-package"))["no-such-package"] == "absent"


QUAKES = """<q:quakeml xmlns:q="http://quakeml.org/xmlns/quakeml/1.2" xmlns="http://quakeml.org/xmlns/bed/1.2"><eventParameters>
<event publicID="one"><preferredOriginID>o2</preferredOriginID>
 <origin publicID="o1"><time><value>2020-01-01T00:00:00Z</value></time><latitude><value>1</value></latitude><longitude><value>2</value></longitude></origin>
 <origin publicID="o2"><time><value>2020-02-03T04:05:06.5Z</value></time><latitude><value>38.5</value></latitude><longitude><value>27.25</value></longitude><depth><value>7000</value></depth></origin>
 <magnitude publicID="m1"><mag><value>4.5</value></mag><type>ML</type></magnitude><magnitude publicID="m2"><mag><value>9</value></mag></magnitude></event>
<event publicID="two"><origin publicID="o3"><time><value>2020-01-01T00:00:00</value></time><latitude><value>1</value></latitude><longitude><value>2</value></longitude></origin></event>
</eventParameters></q:quakeml>"""


def test_event_services(spark, tmp_path):
    assert services.query_url("http://x/query", 1999) == "http://x/query?format=geojson&starttime=1999-01-01&endtime=1999-12-31&minmagnitude=3.0&minlatitude=35.0&maxlatitude=43.0&minlongitude=25.0&maxlongitude=45.5"
    assert len(services.year_requests(["isc", "emsc"], 1990, 1992)) == 6
    at = datetime(2020, 2, 3, 4, 5, 6, 500000, UTC)
    assert services.quakeml_events(QUAKES.encode(), "isc") == [("one", at, 38.5, 27.25, 7.0, 4.5, "ml", "isc")]
    assert services.quakeml_events(b" ", "isc") == []
    fetch = services.agency_events({"isc": "http://x"}, lambda url: QUAKES.encode() if "1990-01-01" in url else b"")
    spark.dataSource.register(services.service("agency_events_test", tables.RAW, fetch))
    rows = spark.read.format("agency_events_test").option("requests", json.dumps(services.year_requests(["isc"], 1990, 1991))).load().collect()
    assert [(r.source_event_id, r.magnitude, r.source) for r in rows] == [("one", 4.5, "isc")]
    asked = []
    get = lambda key: asked.append(key) or b"<r/>"
    assert [services.kept(str(tmp_path / "responses"), "KO/A B", get) for _ in range(2)] == [b"<r/>", b"<r/>"] and asked == ["KO/A B"]
    assert len(list((tmp_path / "responses").iterdir())) == 1


def dataset(spark, good):
    t = datetime(2020, 1, 1)
    events = spark.createDataFrame([("e", 4.0, 39.0, 30.0, t, 5.0, True, 1, "ml", "local_magnitude", 0.1, "usgs" if good else None, 3.98)], "event_id string, magnitude double, latitude double, longitude double, time_utc timestamp, depth_km double, has_waveform boolean, num_waveform_files long, mag_type string, magnitude_scale_group string, magnitude_agreement_std double, reported_by string, mw_estimate double")
    stations = spark.createDataFrame([("s", 39.0, 30.5, 400.0, "C")], "station string, latitude double, longitude double, vs30_ms double, nehrp_site_class string")
    features = spark.createDataFrame([("f", "e", 0.1, 2.0)], "file string, event_id string, pga_g double, pgv_cms double")
    return events, stations, features


def test_validation_and_command_line(spark, tmp_path, capsys):
    events, stations, features = dataset(spark, True)
    names = lambda df: {r.check: r.passed for r in df.collect()}
    got = names(validation.validate(events, stations, features))
    assert [n for n, ok in got.items() if not ok] == ["event_station_not_empty"]
    files = spark.createDataFrame([("f", b"x")], "path string, content binary")
    log = spark.createDataFrame([("ok",), ("error",)], "status string")
    full = names(validation.validate(events, stations, features, files=files, log=log, decode=lambda b: []))
    quick = names(validation.validate(events, stations, features, files=files, log=log, decode=lambda b: [], quick=True))
    assert full.pop("files_readable") is False and full == quick and full["files_match_events"] and full["log_matches_files"]

    facts = spark.createDataFrame([("e", "s", 39.0, 30.0, 39.0, 30.5, 43.2, 43.5)], "event_id string, station string, event_latitude double, event_longitude double, station_latitude double, station_longitude double, epicentral_distance_km double, hypocentral_distance_km double")
    for good in (True, False):
        d = tmp_path / str(good)
        for name, df in zip(("catalog", "stations", "features", "event_station"), (*dataset(spark, good), facts), strict=True):
            df.write.parquet(str(d / name))
        base = str(d / "benchmarks")
        for split, station, when in (("train", "s", "2021-01-01"), ("val", "t", "2021-01-01"), ("test", "u", "2023-01-01")):
            rows = spark.createDataFrame([("e" + split, station, when)], "event_id string, station string, time_utc string")
            rows.write.parquet(tables.benchmark_path("ground_motion", split, None, base))
            rows.write.parquet(tables.benchmark_path("ground_motion", split, "station", base))
            if split != "val":
                rows.write.parquet(tables.benchmark_path("ground_motion", split, "time", base))
        found = validation.load_splits(spark, base)
        assert {n: df.count() for n, df in found.items()} == {"events": 3, "station": 3, "time": 2}
        status = cli.main(["validate", "--data", str(d), "--benchmarks", base, "--report", str(d / "report")], spark)
        report = json.loads((d / "report" / "validation_report.json").read_text())
        assert status == int(not good) and report["failed"] == int(not good) and "train_before_cutoff" in {c["check"] for c in report["checks"]}
    assert cli.main(["validate", "--data", str(tmp_path / "nowhere")], spark) == 1
    assert faultline.load_catalog(spark, data_dir=str(tmp_path / "True")).count() == 1
    capsys.readouterr()


def test_diff_on_command_line(spark, tmp_path, capsys):
    for name, files in (("old", {"a": "1", "b": "1"}), ("new", {"b": "2", "c": "1"})):
        rows = spark.createDataFrame(list(files.items()), "path string, sha256 string")
        counts = spark.createDataFrame([("isc", "reports", len(name))], "source string, metric string, value long")
        (tmp_path / name).write_text(provenance.manifest(rows, counts, {}))
    assert cli.main(["diff", str(tmp_path / "old"), str(tmp_path / "new")], spark) == 0
    got = json.loads(capsys.readouterr().out)
    assert {a["path"]: a["change"] for a in got["artifacts"]} == {"a": "removed", "b": "changed", "c": "added"} and got["lineage"] == []
    (tmp_path / "broken").write_text("{")
    assert cli.main(["diff", str(tmp_path / "old"), str(tmp_path / "broken")], spark) == 1
