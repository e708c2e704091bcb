import numpy as np
import pytest
from pyspark.sql import functions as F

from faultline.functions import gmpe
from faultline.operators import kernels as K
from faultline.operators import waveform as W

def model(m, r, v, metric, style):
    """The published equations in plain numbers: source, path and style on rock, then site amplification."""
    k = gmpe.BY_DISTANCE[metric]
    over = m - gmpe.M_HINGE
    source = over * (gmpe.A2 if over <= 0 else gmpe.A7) + k["a3"] * (8.5 - m) ** 2
    path = (k["a4"] + gmpe.A5 * over) * np.log(np.hypot(r, gmpe.A6))
    rock = np.exp(k["a1"] + source + path + {"n": gmpe.A8, "r": gmpe.A9, "s": 0.0}[style])
    x = min(v, gmpe.V_CON) / gmpe.V_REF
    site = gmpe.B1 * np.log(x)
    if v < gmpe.V_REF:
        site += gmpe.B2 * np.log((rock + gmpe.C * x**gmpe.N) / ((rock + gmpe.C) * x**gmpe.N))
    return rock * np.exp(site)


@pytest.mark.parametrize("metric", ["rhypo", "repi"])
def test_ground_motion_model(spark, metric):
    rng = np.random.default_rng(17)
    rows = [(float(rng.uniform(4, 8)), float(rng.uniform(0, 190)), float(rng.uniform(150, 1300)), "nrs"[i % 3]) for i in range(60)]
    df = spark.createDataFrame(rows, "m double, r double, v double, style string")
    p = gmpe.median_pga(F.col("m"), F.col("r"), F.col("v"), metric, F.col("style") == "n", F.col("style") == "r")
    for row in df.withColumn("p", p).collect():
        assert row.p == pytest.approx(model(row.m, row.r, row.v, metric, row.style), rel=1e-9)


@pytest.mark.parametrize(("period", "damping"), [(0.35, 0.05), (1.3, 0.02), (2.7, 0.1)])
def test_oscillator_under_a_sudden_load(period, damping):
    """A constant acceleration from rest has a closed solution; a ramp is its integral, by linearity."""
    dt, g = 0.0005, 1.7
    t = np.arange(0, 4 * period, dt)
    w = 2 * np.pi / period
    free = w * np.sqrt(1 - damping**2)
    want = -g / w**2 * (1 - np.exp(-damping * w * t) * (np.cos(free * t) + damping * w / free * np.sin(free * t)))
    got = K.oscillator(np.full(len(t), g), dt, period, damping)
    assert np.abs(got - want).max() < 2e-3 * np.abs(want).max()
    ramp = K.oscillator(g * t, dt, period, damping)
    assert np.abs(ramp - np.concatenate([[0], np.cumsum((want[1:] + want[:-1]) / 2) * dt])).max() < 2e-3 * np.abs(ramp).max()


def test_resonance_and_zero():
    t = np.arange(0, 40, 0.001)
    assert K.psa(np.sin(2 * np.pi * t), 0.001, 1.0) == pytest.approx(10, rel=0.01)
    assert K.psa(np.zeros(500), 0.01, 1.0) == 0 and K.psa(np.zeros(0), 0.01, 1.0) == 0


def test_intensity():
    arias, cav, span = K.intensity(np.full(500, 2.0), 0.01)
    assert arias == pytest.approx(np.pi / (2 * 9.81) * 20, rel=1e-4) and cav == pytest.approx(10) and span == pytest.approx(4.5, abs=0.02)
    assert K.intensity(np.zeros(1000), 0.01) == (0.0, 0.0, None)


def test_rotation():
    s = 3 * np.sin(np.linspace(0, 60, 6000))
    a = np.radians(20)
    assert K.rotd50(s * np.cos(a), s * np.sin(a)) == pytest.approx(3 / np.sqrt(2), rel=0.02)
    t = np.linspace(0, 60, 20000)
    assert K.rotd50(2 * np.cos(t), 2 * np.sin(t)) == pytest.approx(2, abs=1e-3)


def test_highpass_removes_drift():
    t = np.arange(0, 200, 0.01)
    burst = np.where((t > 90) & (t < 110), np.sin(4 * np.pi * t), 0)
    assert np.abs(K.highpass(burst + 5 * np.sin(2 * np.pi * 0.005 * t), 100, 0.1)).max() == pytest.approx(1, rel=0.02)


def test_triggers_and_picks():
    x = np.random.default_rng(1).normal(size=6000) * 0.01
    x[3000:3400] += np.sin(np.arange(400) / 3)
    r = K.sta_lta(x, 100, 1000)
    (start, end), *_ = K.triggers(r)
    assert 3000 <= start <= 3050 and end > start and 0 <= K.confidence(r, start, end) <= 1 and K.snr_db(x, start, 100) > 10
    assert K.window_peaks(x, 5950, 100) == {}


TRACES = "file string, channel string, start_ts timestamp, sampling_rate_hz double, samples array<double>"


def traces(spark, *rows):
    return spark.createDataFrame([(f, c, s, 100.0, [float(v) for v in x]) for f, c, s, x in rows], "file string, channel string, s double, sampling_rate_hz double, samples array<double>").select("file", "channel", F.timestamp_micros((F.col("s") * 1e6).cast("long")).alias("start_ts"), "sampling_rate_hz", "samples")


def test_horizontal_peaks(spark):
    df = traces(spark, ("a", "HNE", 0.0, [0, 4, -1, 0]), ("a", "HNN", 0.0, [0, 0, -9, 0]), ("a", "HNZ", 0.0, [0, 2, 0, 0]), ("b", "BHE", 0.0, [1, -3, 2]), ("b", "BHZ", 0.0, [0.5, 0.2, -0.1]))
    got = {r.file: r for r in W.horizontal_peaks(df).collect()}
    a, b = got["a"], got["b"]
    assert (a.channels, a.h1, a.h2, a.v, a.geomean) == ("HNE,HNN", 4, 9, 2, 6) and a.rotd50 <= np.hypot(4, 9)
    assert (b.v, b.h1, b.geomean, b.rotd50) == (0.5, None, None, None)


def test_alignment(spark):
    df = traces(spark, ("a", "HNE", 0.0, range(10)), ("a", "HNN", 0.02, range(100, 110)), ("far", "HNE", 0.0, [1, 2]), ("far", "HNN", 9.0, [1, 2]), ("one", "HNE", 0.0, [1, 2]))
    (r,) = W.aligned_horizontals(df).collect()
    assert r.h1 == [2, 3, 4, 5, 6, 7, 8, 9] and r.h2 == list(range(100, 108)) and r.dt == 0.01


def test_column_forms_equal_kernels(spark):
    x = np.random.default_rng(3).normal(size=(2, 300))
    df = traces(spark, ("a", "HNE", 0.0, x[0]), ("a", "HNN", 0.0, x[1]))
    r = W.aligned_horizontals(df).select(W.rotd50(F.col("h1"), F.col("h2")).alias("r"), W.arias(F.col("h1"), F.col("dt")).alias("a"), W.cav(F.col("h1"), F.col("dt")).alias("c"), W.significant_duration(F.col("h1"), F.col("dt")).alias("d"), W.clipped(F.col("h1")).alias("k")).first()
    assert r.r == pytest.approx(K.rotd50(*x), rel=1e-12) and (r.a, r.c, r.d) == pytest.approx(K.intensity(x[0], 0.01)) and not r.k


def test_features_survive_bad_files(spark):
    df = traces(spark, ("good", "HNE", 0.0, np.sin(np.arange(3000) / 5)), ("good", "HNN", 0.0, np.cos(np.arange(3000) / 5)), ("good", "HNZ", 0.0, np.sin(np.arange(3000) / 9)), ("short", "HNE", 0.0, []))
    got = {r.file: r for r in W.compute_features(df).collect()}
    assert got["good"].pga_rotd50_g > 0 and got["good"].highpass_corner_hz == 0.05 and W.FLAG_COMPONENT in got["short"].qc_flags


def test_filter_in_blocks_equals_the_recurrence():
    x = np.random.default_rng(4).normal(size=333)
    for b, a in K._sections(0.3, 50.0, 4):
        want, y1, y2 = [], 0.0, 0.0
        for i, v in enumerate(x):
            y = b[0] * v + b[1] * (x[i - 1] if i else 0) + b[2] * (x[i - 2] if i > 1 else 0) - a[1] * y1 - a[2] * y2
            want.append(y)
            y1, y2 = y, y1
        assert np.allclose(K._filtered(x, b, a), want, atol=1e-9) and np.allclose(K._filtered(x, b, a, 7), want, atol=1e-9)


def test_pieces_instruments_and_flags(spark):
    t = np.arange(6000) / 100
    x = np.sin(2 * np.pi * 2 * t) * (t > 20) * 3 * np.exp(-(t - 20) / 40) + 1e-3 * np.sin(2 * np.pi * 7 * t)
    rows = []
    for c in ("HNE", "HNN", "HNZ"):
        rows += [("gap", c, 0.0, x[:3000]), ("gap", c, 31.0, x[3100:]), ("whole", c, 0.0, x), ("both", c, 0.0, x)]
    rows += [("both", c, 0.0, 50 * x) for c in ("HHE", "HHN", "HHZ")] + [("flat", c, 0.0, np.clip(x, -1, 1)) for c in ("HNE", "HNN", "HNZ")] + [("few", "HHZ", 0.0, x)]
    df = traces(spark, *rows)
    got = {r.file: r for r in W.compute_features(df).collect()}
    assert got["both"].pga_g == got["whole"].pga_g and got["both"].instrument_type_used == "strong_motion" and got["both"].pga_geomean_g is not None
    assert got["gap"].qc_flags == W.FLAG_GAPS and got["gap"].duration_sec == 60.0 and got["gap"].usable_for_engineering and got["gap"].pga_g == pytest.approx(got["whole"].pga_g, rel=0.02)
    assert W.FLAG_CLIPPING in got["flat"].qc_flags and not got["flat"].usable_for_engineering
    assert got["few"].instrument_type_used == "broadband" and W.FLAG_COMPONENT in got["few"].qc_flags and not got["few"].usable_for_engineering
    assert 300 / (4 * np.pi) <= got["whole"].pgv_cms <= 600 / (4 * np.pi) and got["whole"].p_pick_sec == pytest.approx(20, abs=0.5)
    p = {r.file: r for r in W.p_windows(df, spark.createDataFrame([("both", 20.0), ("few", 55.0), ("whole", None)], "file string, p_pick_sec double")).collect()}
    assert p["both"].channel == "HNZ" and p["both"].pa_3s == pytest.approx(3, rel=0.03) and p["both"].pd_10s > 0 and set(p) == {"both", "few"} and p["few"].pa_10s is None and p["few"].pa_3s is not None


def test_response_is_removed_or_flagged(spark):
    x = np.sin(2 * np.pi * 2 * np.arange(4000) / 100) * np.exp(-np.abs(np.arange(4000) - 2000) / 3000)
    df = traces(spark, *[(f, c, 0.0, 1000 * x) for f in ("known", "unknown") for c in ("HNE", "HNN", "HNZ")])
    told = spark.createDataFrame([("known", c, 1000.0, [[0.0, 0.0]][:0], [[0.0, 0.0]][:0]) for c in ("HNE", "HNN", "HNZ")], "file string, channel string, gain double, poles array<array<double>>, zeros array<array<double>>")
    got = {r.file: r for r in W.compute_features(df, responses=told).collect()}
    assert got["known"].pga_g == pytest.approx(1 / K.G, rel=0.05) and got["known"].usable_for_engineering
    assert got["unknown"].pga_g is None and got["unknown"].qc_flags.startswith(W.FLAG_NO_RESPONSE) and not got["unknown"].usable_for_engineering
