"""Waveform operators over trace tables: higher-order functions where SQL can express them, numpy kernels where not.

Traces: file, channel, start_ts, sampling_rate_hz, samples array<double>.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline.functions.scalar import GRAVITY, highpass_corner, instrument_type, np_round
from faultline.operators import kernels as K


def peak(samples: Column) -> Column:
    return F.array_max(F.transform(samples, lambda x: F.abs(x)))


def clipped(samples: Column) -> Column:
    """Many samples at the peak: more than five and more than 1 % within 0.1 % of it."""
    top = peak(samples)
    near = F.size(F.filter(samples, lambda x: F.abs(x) >= top * 0.999))
    return F.coalesce((F.size(samples) >= 10) & (top > 0) & (near > F.greatest(F.lit(5.0), F.size(samples) * 0.01)), F.lit(False))


def rotd50(h1: Column, h2: Column) -> Column:
    """Median over 180 directions of the largest projection, as a column expression."""
    peaks = F.array_sort(F.transform(F.sequence(F.lit(0), F.lit(179)), lambda d: F.array_max(F.zip_with(h1, h2, lambda a, b: F.abs(a * F.cos(F.radians(d.cast("double"))) + b * F.sin(F.radians(d.cast("double"))))))))
    return (F.element_at(peaks, 90) + F.element_at(peaks, 91)) / 2


def arias(samples: Column, dt: Column) -> Column:
    energy = F.aggregate(samples, F.lit(0.0), lambda t, x: t + x * x)
    return np_round(F.lit(np.pi / (2 * GRAVITY)) * energy * dt, 6)


def cav(samples: Column, dt: Column) -> Column:
    return np_round(F.aggregate(samples, F.lit(0.0), lambda t, x: t + F.abs(x)) * dt, 4)


def significant_duration(samples: Column, dt: Column) -> Column:
    """Time between 5 % and 95 % of the energy: samples whose running energy lies below each share are counted in one fold."""
    total = F.aggregate(samples, F.lit(0.0), lambda t, x: t + x * x)
    zero = F.struct(F.lit(0.0).alias("e"), F.lit(0).alias("lo"), F.lit(0).alias("hi"))

    def step(s: Column, x: Column) -> Column:
        e = s["e"] + x * x
        return F.struct(e.alias("e"), (s["lo"] + (e / total < 0.05).cast("int")).alias("lo"), (s["hi"] + (e / total < 0.95).cast("int")).alias("hi"))

    return F.when(total > 0, np_round(F.aggregate(samples, zero, step, lambda s: s["hi"] - s["lo"]) * dt, 3))


def aligned_horizontals(traces: DataFrame) -> DataFrame:
    """Per file with exactly two horizontal traces of one rate that overlap: channels, both trimmed sample arrays, dt."""
    end = F.col("start_us") + F.rint((F.size("samples") - 1) * 1e6 / F.col("sampling_rate_hz")).cast("long")
    h = traces.where(~F.col("channel").endswith("Z")).withColumn("start_us", F.unix_micros("start_ts")).withColumn("end_us", end)
    two = h.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("channel", "start_us", "end_us", "sampling_rate_hz", "samples"))).alias("t")).where(F.size("t") == 2)
    a, b = F.col("t")[0], F.col("t")[1]
    start, stop, rate = F.greatest(a["start_us"], b["start_us"]), F.least(a["end_us"], b["end_us"]), a["sampling_rate_hz"]
    two = two.where((a["sampling_rate_hz"] == b["sampling_rate_hz"]) & (stop > start))
    place = lambda t: F.rint((start - t["start_us"]) * rate / 1e6).cast("int") + 1
    want = F.rint((stop - start) * rate / 1e6).cast("int") + 1
    n = F.least(want, F.size(a["samples"]) - place(a) + 1, F.size(b["samples"]) - place(b) + 1)
    cut = two.select("file", a["channel"].alias("channel_1"), b["channel"].alias("channel_2"), F.slice(a["samples"], place(a), n).alias("h1"), F.slice(b["samples"], place(b), n).alias("h2"), (F.lit(1.0) / rate).alias("dt"))
    return cut.where(F.size("h1") >= 2)


def horizontal_peaks(traces: DataFrame) -> DataFrame:
    """Per file: channels, h1, h2, geomean (two horizontals), v (exactly one vertical) and rotd50 (if they align)."""
    vertical = F.col("channel").endswith("Z")
    p = traces.withColumn("peak", peak(F.col("samples")))
    g = p.groupBy("file").agg(
        F.count_if(vertical).alias("nv"), F.max(F.when(vertical, F.col("peak"))).alias("v"),
        F.array_sort(F.collect_list(F.when(~vertical, F.struct("channel", "peak")))).alias("h"),
    )
    two = F.size("h") == 2
    out = g.select(
        "file", F.when(two, F.array_join(F.transform("h", lambda x: x["channel"]), ",")).alias("channels"),
        F.when(two, F.get("h", F.lit(0))["peak"]).alias("h1"), F.when(two, F.get("h", F.lit(1))["peak"]).alias("h2"), F.when(F.col("nv") == 1, F.col("v")).alias("v"),
    ).withColumn("geomean", F.sqrt(F.col("h1") * F.col("h2")))
    turned = aligned_horizontals(traces).select("file", rotd50(F.col("h1"), F.col("h2")).alias("rotd50"))
    return out.join(turned, "file", "left")


def gap_stats(traces: DataFrame) -> DataFrame:
    """Per file and channel: pieces, gaps between them, and the seconds missing."""
    end = F.unix_micros("start_ts") / 1e6 + F.size("samples") / F.col("sampling_rate_hz")
    w = Window.partitionBy("file", "channel").orderBy("start_ts")
    gap = F.unix_micros("start_ts") / 1e6 - F.lag("end").over(w)
    rows = traces.withColumn("end", end).withColumn("gap", gap)
    return rows.groupBy("file", "channel").agg(F.count(F.lit(1)).alias("pieces"), F.count_if(F.col("gap") > F.lit(0.5) / F.col("sampling_rate_hz")).alias("gaps"), np_round(F.coalesce(F.sum(F.when(F.col("gap") > F.lit(0.5) / F.col("sampling_rate_hz"), F.col("gap"))), F.lit(0.0)), 6).alias("missing_sec"))


def preferred_instrument(traces: DataFrame) -> DataFrame:
    """Per file the channel group to use: strong motion, then broadband, then the first by name."""
    code = F.substring("channel", 1, 2)
    rank = F.when(F.substring(code, 2, 1) == "N", 0).when(F.substring(code, 2, 1) == "H", 1).otherwise(2)
    return traces.groupBy("file").agg(F.min(F.struct(rank, code.alias("code")))["code"].alias("group"), F.min_by(instrument_type(F.col("channel")), F.struct(rank, "channel")).alias("instrument_type_used"))


#: Values of the flag column, part of the data contract (fixed values).
FLAG_GAPS, FLAG_COMPONENT, FLAG_CLIPPING, FLAG_NO_VERTICAL, FLAG_RATE = "has_gaps", "eksik_bileşen", "clipping_şüphesi", "Z_bileşeni_yok_veya_kısa", "örnekleme_hızı_tutarsız"
FLAG_NO_RESPONSE, FLAG_RESPONSE_FAILED = "tepki_bilgisi_yok", "tepki_çıkarımı_başarısız"
BLOCKERS = (FLAG_CLIPPING, FLAG_COMPONENT, FLAG_NO_RESPONSE, FLAG_RESPONSE_FAILED, FLAG_RATE)


def flags(**conditions: Column) -> Column:
    """Comma-joined names of the conditions that hold, in the order given."""
    return F.array_join(F.filter(F.array(*(F.when(c, F.lit(name)) for name, c in conditions.items())), lambda x: x.isNotNull()), ",")


def usable(flag_list: Column, instrument: Column) -> Column:
    return (instrument == "strong_motion") & ~F.arrays_overlap(F.split(flag_list, ","), F.array(*map(F.lit, BLOCKERS)))


FEATURES = "file string, instrument_type_used string, usable_for_engineering boolean, pga_g double, pgv_cms double, pga_h1_g double, pga_h2_g double, pga_v_g double, pga_geomean_g double, pga_rotd50_g double, " + ", ".join(f"sa_{str(p).replace('.', 'p')}_rotd50_g double" for p in K.PERIODS) + ", arias double, cav double, d5_95 double, dominant_hz double, mean_hz double, p_pick_sec double, p_pick_confidence double, snr_db double, s_pick_sec double, s_pick_confidence double, highpass_corner_hz double, duration_sec double, qc_flags string"


#: Instrument groups in the order of preference, by the channel code's second letter.
GROUPS = {"N": "strong_motion", "H": "broadband"}


def instrument(channels: list[str]) -> list[str]:
    """The channels of the preferred instrument: strong motion, then broadband high rate, then the first by name."""
    for code in ("HN", "HH"):
        own = [c for c in channels if c.startswith(code)]
        if own:
            return own
    return [c for c in channels if c[:2] == channels[0][:2]] if channels else []


def file_features(channels: dict[str, tuple[float, list[tuple[float, np.ndarray]]]], magnitude: float | None, responses: dict[str, tuple] | None = None) -> dict:
    """Measures of one file (channel -> rate, pieces of start and samples); a stage that fails leaves NULLs and a flag.

    Without ``responses`` the samples are acceleration in m/s2; with them they are counts, of which the
    response (poles, zeros, gain of acceleration) is removed, and a channel without one is not measured.
    """
    out: dict = {}
    notes: list[str] = []
    corner = 0.05 if magnitude is None or magnitude != magnitude else 0.03 if magnitude >= 6.5 else 0.05 if magnitude >= 5.5 else 0.1
    out["highpass_corner_hz"] = corner
    names = instrument(sorted(channels))
    out["instrument_type_used"] = (GROUPS.get(names[0][1:2], "other") if names else None)
    raw, gaps = {}, 0
    for c in names:
        x, n = K.merged(channels[c][1], channels[c][0])
        raw[c], gaps = (channels[c][0], x), gaps + n
    flat = [c for c in names if not c.endswith("Z")]
    up = next((c for c in names if c.endswith("Z")), None)
    out["duration_sec"] = round(max((len(x) / r for r, x in raw.values()), default=0.0), 3)
    if gaps:
        notes.append(FLAG_GAPS)
    if len(names) < 3:
        notes.append(FLAG_COMPONENT)
    if any(K.clipped(x) for _, x in raw.values()):
        notes.append(FLAG_CLIPPING)
    if len({r for r, _ in raw.values()}) > 1:
        notes.append(FLAG_RATE)
    ground = raw
    if responses is not None:
        ground = {}
        for c, (r, x) in raw.items():
            if responses.get(c) is None:
                notes += [FLAG_NO_RESPONSE] * (FLAG_NO_RESPONSE not in notes)
                continue
            try:
                ground[c] = r, K.deconvolve(x, r, *responses[c])
            except (ValueError, TypeError, np.linalg.LinAlgError):
                notes += [FLAG_RESPONSE_FAILED] * (FLAG_RESPONSE_FAILED not in notes)
    clean = {c: (r, K.highpass(x, r, corner)) for c, (r, x) in ground.items() if len(x)}
    peaks = {c: float(np.abs(x).max()) / K.G for c, (_, x) in clean.items()}
    if peaks:
        out["pga_g"] = round(max(peaks.values()), 5)
        speed = [np.abs(K.integral(x, 1 / r)).max() for r, x in clean.values()]
        out["pgv_cms"] = round(float(max(speed)) * 100, 4)
    if up in peaks:
        out["pga_v_g"] = round(peaks[up], 5)
    if len(flat) == 2 and all(c in peaks for c in flat):
        (r1, a), (r2, b) = clean[flat[0]], clean[flat[1]]
        out["pga_h1_g"], out["pga_h2_g"] = round(peaks[flat[0]], 5), round(peaks[flat[1]], 5)
        out["pga_geomean_g"] = round(float(np.sqrt(peaks[flat[0]] * peaks[flat[1]])), 5)
        n = min(len(a), len(b))
        if r1 == r2 and n >= 2:
            a, b, dt = a[:n], b[:n], 1 / r1
            out["pga_rotd50_g"] = round(K.rotd50(a, b) / K.G, 5)
            for p in K.PERIODS:
                out[f"sa_{str(p).replace('.', 'p')}_rotd50_g"] = round(K.sa_rotd50(a, b, dt, p) / K.G, 5)
            best = a if np.abs(a).max() >= np.abs(b).max() else b
            out["arias"], out["cav"], out["d5_95"] = K.intensity(best, dt)
            out["dominant_hz"], out["mean_hz"] = K.spectrum(best, dt)
    if up is None or len(raw[up][1]) <= 200:
        notes.append(FLAG_NO_VERTICAL)
    else:
        rate, z = raw[up]
        ratio = K.sta_lta(z, int(K.STA * rate), int(K.LTA * rate))
        hits = K.triggers(ratio)
        if hits:
            pick = hits[0][0]
            out["p_pick_sec"], out["p_pick_confidence"] = pick / rate, K.confidence(ratio, *hits[0])
            out["snr_db"] = K.snr_db(z, pick, rate)
            if len(flat) >= 2:
                n = min(len(raw[flat[0]][1]), len(raw[flat[1]][1]))
                e = np.hypot(raw[flat[0]][1][:n], raw[flat[1]][1][:n])
                second = K.sta_lta(e, int(K.STA * rate), int(K.LTA * rate))
                later = [t for t in K.triggers(second) if t[0] > pick + int(rate)]
                if later:
                    out["s_pick_sec"], out["s_pick_confidence"] = later[0][0] / rate, K.confidence(second, *later[0])
    out["qc_flags"] = ",".join(notes)
    out["usable_for_engineering"] = out["instrument_type_used"] == "strong_motion" and not set(notes) & set(BLOCKERS)
    return out


def _pieces(group: pd.DataFrame) -> dict[str, tuple[float, list[tuple[float, np.ndarray]]]]:
    """A file's traces by channel; pieces of another rate than the channel's first are left to a channel of their own."""
    out: dict[str, tuple[float, list[tuple[float, np.ndarray]]]] = {}
    for c, t, r, x in sorted(zip(group.channel, group.start, group.sampling_rate_hz, group.samples, strict=True), key=lambda v: (v[0], v[1])):
        if x is not None:
            name = c if c not in out or out[c][0] == float(r) else f"{c[:2]}_{float(r):g}{c[2:]}"
            out.setdefault(name, (float(r), []))[1].append((float(t), np.asarray(x, float)))
    return out


def compute_features(traces: DataFrame, magnitudes: DataFrame | None = None, responses: DataFrame | None = None) -> DataFrame:
    """One row of measures a file; a file's traces are one group (one record, bounded by its length).

    ``magnitudes``: file, magnitude. ``responses``: file, channel, gain and arrays of poles and zeros (pairs of
    real and imaginary part), for traces in counts.
    """
    rows = traces.join(magnitudes, "file", "left") if magnitudes is not None else traces.withColumn("magnitude", F.lit(None).cast("double"))
    kind = "struct<gain:double,poles:array<array<double>>,zeros:array<array<double>>>"
    if responses is not None:
        rows = rows.join(responses.select("file", "channel", F.struct("gain", "poles", "zeros").cast(kind).alias("response")), ["file", "channel"], "left")
    else:
        rows = rows.withColumn("response", F.lit(None).cast(kind))
    names = [f.split()[0] for f in FEATURES.split(", ")]
    counts = responses is not None

    def one(group: pd.DataFrame) -> pd.DataFrame:
        m = group.magnitude.iloc[0]
        known = {}
        for c, r in zip(group.channel, group.response, strict=True) if counts else []:
            if r is not None:
                known[c] = [complex(*z) for z in r["poles"]], [complex(*z) for z in r["zeros"]], float(r["gain"])
        found = file_features(_pieces(group), None if pd.isna(m) else float(m), known if counts else None)
        return pd.DataFrame([{n: None for n in names} | {"file": group.file.iloc[0]} | found])[names]

    start = (F.unix_micros("start_ts") / 1e6).alias("start") if "start_ts" in traces.columns else F.lit(0.0).alias("start")
    return rows.select("file", "channel", start, "sampling_rate_hz", "samples", F.col("magnitude").cast("double").alias("magnitude"), "response").groupBy("file").applyInPandas(one, FEATURES)


P_WINDOWS = "file string, channel string, pa_1s double, pa_3s double, pa_5s double, pa_10s double, pd_1s double, pd_3s double, pd_5s double, pd_10s double"


def p_windows(traces: DataFrame, picks: DataFrame) -> DataFrame:
    """Per file of ``picks`` (file, p_pick_sec): peak acceleration and peak displacement 1, 3, 5 and 10 s after the pick.

    They are read from one vertical channel: strong motion, then broadband, then the first by name; windows
    that the record does not cover are NULL, and a file without a vertical channel has no row.
    """
    names = [f.split()[0] for f in P_WINDOWS.split(", ")]

    def one(group: pd.DataFrame) -> pd.DataFrame:
        own = {c: v for c, v in _pieces(group).items() if c.endswith("Z")}
        if not own:
            return pd.DataFrame(columns=names)
        channel = min(own, key=lambda c: (not c.startswith("HN"), not c.startswith("HH"), c))
        rate, (x, _) = own[channel][0], K.merged(own[channel][1], own[channel][0])
        pick = int(round(float(group.p_pick_sec.iloc[0]) * rate))
        a, d = (K.window_peaks(x, pick, rate), K.displacement_peaks(x, pick, rate)) if 0 <= pick < len(x) else ({}, {})
        return pd.DataFrame([{"file": group.file.iloc[0], "channel": channel} | {f"{n}_{w}s": v.get(w) for n, v in (("pa", a), ("pd", d)) for w in (1, 3, 5, 10)}])[names]

    rows = traces.join(picks.where("p_pick_sec is not null").select("file", "p_pick_sec"), "file")
    return rows.select("file", "channel", (F.unix_micros("start_ts") / 1e6).alias("start"), "sampling_rate_hz", "samples", "p_pick_sec").groupBy("file").applyInPandas(one, P_WINDOWS)


def map_arrays(df: DataFrame, schema: str, f) -> DataFrame:
    """``f`` (a row's values as a dict, to a dict) over Arrow batches."""
    names = [x.strip().split()[0] for x in schema.split(",")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([f(r) for r in b.to_dict("records")], columns=names)

    return df.mapInPandas(run, schema)


def corner_for(magnitude: Column) -> Column:
    return highpass_corner(magnitude)
