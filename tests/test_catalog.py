import collections
import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from faultline.functions import scalar as S
from faultline.operators import dedup, joins, review, windows

SCHEMA = "source_event_id string, t_sec double, latitude double, longitude double, magnitude double, source string"


def kilometres(a, b):
    x, y = math.radians(a[0]), math.radians(b[0])
    h = math.sin((y - x) / 2) ** 2 + math.cos(x) * math.cos(y) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 2 * 6371.0 * math.asin(math.sqrt(h))


def random_catalog(seed, n=70):
    """Reports in bursts, with agencies, times, places and magnitudes that are now and then just within or beyond a limit."""
    rng, out, t = random.Random(seed), [], 0.0
    for i in range(n):
        t += rng.choice([0.0, 3.0, 11.0, 29.0, 31.0, 400.0])
        out.append((f"r{i:03d}", t, 37.5 + rng.choice([0, 0.2, 0.45, 1.3]), 30.0 + rng.choice([0, 0.3, 0.9]), rng.choice([3.2, 3.9, 4.7, 5.1]), rng.choice(["usgs", "isc", "emsc"])))
    return out


def limit(magnitude):
    return min(150.0, max(50.0, 50.0 + 10.0 * magnitude))


def links(events):
    """(score, earlier, later) of all pairs of reports of different agencies within the three limits."""
    order = sorted(range(len(events)), key=lambda i: (events[i][1], events[i][5], events[i][0]))
    out = {}
    for n, i in enumerate(order):
        for j in order[n + 1 :]:
            a, b = events[i], events[j]
            dt, km, dm, most = b[1] - a[1], kilometres(a[2:4], b[2:4]), abs(a[4] - b[4]), limit(max(a[4], b[4]))
            if a[5] != b[5] and dt <= 30 and km <= most and dm <= 1.5:
                out[i, j] = 0.4 * (1 - dt / 30) + 0.4 * (1 - km / most) + 0.2 * (1 - dm / 1.5)
    return order, out


def brute_clusters(events):
    """Best links first; a cluster has one report an agency and lasts at most 30 s."""
    order, pairs = links(events)
    place = {i: n for n, i in enumerate(order)}
    groups = {i: {i} for i in range(len(events))}
    for (i, j), _ in sorted(pairs.items(), key=lambda x: (-round(x[1], 9), place[x[0][0]], place[x[0][1]])):
        both = groups[i] | groups[j]
        times = [events[k][1] for k in both]
        if groups[i] is not groups[j] and len({events[k][5] for k in both}) == len(both) and max(times) - min(times) <= 30:
            for k in both:
                groups[k] = both
    return {events[i][0]: frozenset(events[k][0] for k in g) for i, g in groups.items()}


def members(df):
    by = collections.defaultdict(set)
    for r in df.collect():
        by[r.cluster_id].add(r.source_event_id)
    return {k: frozenset(v) for v in by.values() for k in v}


@pytest.mark.parametrize("seed", [1, 2])
def test_clusters_of_random_catalogs(spark, seed):
    events = random_catalog(seed)
    df = spark.createDataFrame(events, SCHEMA)
    order, pairs = links(events)
    got = {(r.source_event_id_a, r.source_event_id_b): r.score for r in dedup.candidate_pairs(df).collect()}
    assert got.keys() == {(events[i][0], events[j][0]) for i, j in pairs}
    assert all(abs(got[events[i][0], events[j][0]] - s) < 1e-6 for (i, j), s in pairs.items())
    if len({round(s, 9) for s in pairs.values()}) < len(pairs):  # tied scores: only what every order of ties keeps
        for cluster in members(dedup.clusters(df)).values():
            inside = [e for e in events if e[0] in cluster]
            assert len({e[5] for e in inside}) == len(inside) and max(e[1] for e in inside) - min(e[1] for e in inside) <= 30
    else:
        assert members(dedup.clusters(df)) == brute_clusters(events)


def test_clusters_without_ties(spark):
    rng = random.Random(9)
    events = [(k, t + rng.random() * 0.01, la + rng.random() * 0.01, lo, m, s) for k, t, la, lo, m, s in random_catalog(3, 90)]
    df = spark.createDataFrame(events, SCHEMA)
    want = brute_clusters(events)
    assert members(dedup.clusters(df)) == want == members(dedup.clusters(df.repartition(5, "magnitude")))
    assert any(len(c) == 3 for c in want.values())


def test_catalog_of_clusters(spark):
    """Quality, composite rows and the id map, against the clusters found."""
    events = [(*e, float(i) if i % 3 else None) for i, e in enumerate(random_catalog(4, 50))]
    df = spark.createDataFrame(events, SCHEMA + ", depth_km double")
    catalog, ids = dedup.deduplicate(df)
    by = {e[0]: e for e in events}
    first = lambda c: min(c, key=lambda k: (("usgs", "isc", "emsc").index(by[k][5]), by[k][1], k))
    clusters = set(members(dedup.clusters(df)).values())
    rows = {r.source_event_id: r for r in catalog.collect()}
    assert rows.keys() == {first(c) for c in clusters}
    for c in clusters:
        r = rows[first(c)]
        km = max((kilometres(by[a][2:4], by[b][2:4]) for a in c for b in c), default=0)
        assert r.cluster_size == len(c) and r.reported_by == ",".join(sorted({by[k][5] for k in c})) and abs(r.cluster_max_distance_km - km) < 0.01
        assert (r.dedup_confidence == 1.0) if len(c) == 1 else 0 <= r.dedup_confidence <= 1
        depths = [by[k][6] for k in sorted(c, key=lambda k: (("usgs", "isc", "emsc").index(by[k][5]), by[k][1], k)) if by[k][6] is not None]
        assert r.depth_km == (depths[0] if depths else None)
    assert {r.source_event_id: r.representative_event_id for r in ids.collect()} == {k: first(c) for c in clusters for k in c}


def brute_copies(classes, pairs):
    """Node by node: equal scores by the places of both, which follow time, agency and id."""
    nodes = sorted((t, s, k, c) for c, (t, s, ids) in enumerate(classes) for k in ids)
    groups = {i: {i} for i in range(len(nodes))}
    for _, i, j in sorted((-x, i, j) for x, a, b in pairs for i, e in enumerate(nodes) if e[3] == a for j, f in enumerate(nodes) if f[3] == b):
        both = groups[i] | groups[j]
        times = [nodes[k][0] for k in both]
        if groups[i] is not groups[j] and len({nodes[k][1] for k in both}) == len(both) and max(times) - min(times) <= 30:
            for k in both:
                groups[k] = both
    return {e[2]: nodes[min(groups[i])][2] for i, e in enumerate(nodes)}


def test_copies_merge_as_if_paired_one_by_one():
    rng = random.Random(12)
    for _ in range(400):
        names, classes = rng.sample(range(100, 999), 40), []
        for _ in range(rng.randrange(2, 9)):
            classes.append((rng.choice([0.0, 12.0, 25.0, 37.0, 50.0]), rng.choice("abcd"), sorted(f"r{names.pop()}" for _ in range(rng.randrange(1, 5)))))
        before = lambda a, b: classes[a][:2] < classes[b][:2] and classes[a][1] != classes[b][1] and classes[b][0] - classes[a][0] <= 30
        pairs = [(rng.choice([0.2, 0.5, 0.7, 1.0]), a, b) for a in range(len(classes)) for b in range(len(classes)) if before(a, b) and rng.random() < 0.8]
        assert dedup.merge_greedily(classes, pairs) == brute_copies(classes, pairs)


def test_copies_of_reports_make_no_pairs(spark, monkeypatch):
    rng = random.Random(10)
    events = [(k, t + rng.random() * 0.01, la + rng.random() * 0.01, lo, m, s) for k, t, la, lo, m, s in random_catalog(11, 25)]
    copies = [(f"{e[0]}-{c}", *e[1:5], agency) for e in events for c, agency in enumerate(rng.choices(("usgs", "isc", "emsc"), k=6))]
    df, linked, made = spark.createDataFrame(copies, SCHEMA), dedup.candidate_pairs, []
    monkeypatch.setattr(dedup, "candidate_pairs", lambda x: made.append(linked(x)) or made[-1])
    assert members(dedup.clusters(df.repartition(3))) == brute_clusters(copies)
    distinct = list({e[1:]: e for e in copies}.values())
    assert made[0].count() == len(links(distinct)[1]) < len(links(copies)[1]) / 3


def test_copies_of_all_agencies_are_settled_before_pairs(spark, monkeypatch):
    """No pairs are made of what is in a whole cluster; an agency's surplus, near copies and incomplete spots still meet."""
    rng = random.Random(13)
    events = [(k, 5000 + t + rng.random() * 0.01, la + rng.random() * 0.01, lo, m) for k, t, la, lo, m, _ in random_catalog(14, 20)]
    agencies = ("usgs", "isc", "emsc")
    copies = [(f"{e[0]}-{c}", *e[1:], agencies[c % 3]) for e in events for c in range(6)]
    surplus = [(f"{e[0]}-{c}", *e[1:], agency) for e in events[::4] for c, agency in (("x", "isc"), ("y", "emsc"), ("z", "isc"))]
    t, la, lo, m = events[1][1:]
    near = [(f"near{c}", t, la, lo, math.nextafter(m, 9), agency) for c, agency in enumerate(agencies)]
    df, store, kept = spark.createDataFrame(copies, SCHEMA), dedup.stored, []
    monkeypatch.setattr(dedup, "stored", lambda x: kept.append(store(x)) or kept[-1])
    assert members(dedup.clusters(df)) == brute_clusters(copies)
    assert [x.count() for x in kept if "score" in x.columns] == [0] and len(links(copies)[1]) > 200
    for more in (copies + surplus, copies + near, [e for e in copies if e[0] != "r003-4"]):
        assert members(dedup.clusters(spark.createDataFrame(more, SCHEMA).repartition(3))) == brute_clusters(more)


def test_sample_of_copies_is_that_of_all_pairs(spark):
    """Copies are counted by class, pairs of one time and agency have the order of their ids, and hashes decide."""
    rng = random.Random(8)
    reports = [(k, t, la, lo, m, s) for k, t, la, lo, m, s in random_catalog(13, 30)]
    reports += [(f"m{k}", t, la, lo, m + 0.5, s) for k, t, la, lo, m, s in reports[:10]]  # the same time and agency
    copies = [(f"{rng.randrange(10**6)}x{e[0]}{c}", *e[1:]) for e in reports for c in range(rng.choice((1, 2, 12)))]
    df = spark.createDataFrame([*copies, ("none", 3.0, None, 30.0, 4.0, "usgs")], SCHEMA)
    strata = collections.defaultdict(list)
    for r in review.review_pairs(df).collect():
        a, b = r.source_event_id_a, r.source_event_id_b
        strata[r.stratum].append((hashlib.md5(f"20261025|{a}|{b}".encode()).hexdigest(), a, b))
    want = {(k, a, b, len(v), min(7, len(v))) for k, v in strata.items() for _, a, b in sorted(v)[:7]}
    got = [tuple(r)[:5] for r in review.sampled_pairs(df, 7).select("stratum", "a", "b", "stratum_population", "stratum_sample_size").collect()]
    assert set(got) == want and len(got) == len(want) and max(map(len, strata.values())) > 300
    classes = review.review_classes(df)
    assert classes.agg(F.sum("n")).first()[0] == sum(map(len, strata.values())) > 5 * classes.count()


def test_sample_of_rows_whose_ids_repeat(spark):
    """All rows of a stratum share a hash that is beyond the share looked at first."""
    high = next(str(i) for i in range(999) if hashlib.md5(f"20261025|{i}".encode()).hexdigest() > "f")
    df = spark.createDataFrame([("one", high)] * 3000 + [("two", str(i)) for i in range(3000)], "k string, id string")
    got = review.stratified_sample(df, "k", ["id"], 5).collect()
    assert sorted((r.k, r.id) for r in got if r.k == "one") == [("one", high)] * 5 and {r.review_weight for r in got} == {600.0}
    assert {r.id for r in got if r.k == "two"} == set(sorted(map(str, range(3000)), key=lambda i: hashlib.md5(f"20261025|{i}".encode()).hexdigest())[:5])


def test_quality_of_large_clusters(spark):
    """Against all pairs; positions on a circle and inside it, missing values, and differences at the middle of two roundings."""
    rng = random.Random(5)
    rows = [("half", "h0", 1704067200.000001, 38.0, 36.0, 4.0), ("half", "h1", 1704067255.075001, 38.0, 36.0, 4.5), ("one", "o", 5.0, 38.0, 36.0, 4.0)]
    for n in range(60):
        a, r = rng.uniform(0, 6.3), rng.choice([0.3, rng.random() * 0.3])
        rows.append(("round", f"r{n}", rng.uniform(0, 99), 38 + r * math.sin(a), 36 + r * math.cos(a), rng.uniform(3, 5)))
        rows.append(("gaps", f"g{n}", 7.0, None if n % 3 else 38.0 + n / 60, 36.0, None if n % 4 else 4.0 + n / 60))
    got = {r.cluster_id: r for r in dedup.quality(spark.createDataFrame(rows, "cluster_id string, source_event_id string, t_sec double, latitude double, longitude double, magnitude double")).collect()}
    assert got["one"][1:] == (1, 0.0, 0.0, 0.0, 1.0) and got["half"].cluster_max_time_diff_sec == 55.08  # 55.075 s
    for c in ("round", "gaps"):
        own = [x for x in rows if x[0] == c]
        spread = lambda i: max(x[i] for x in own if x[i]) - min(x[i] for x in own if x[i])
        km = max(kilometres(x[3:5], y[3:5]) for x in own if x[3] for y in own if y[3])
        conf = 0.4 * max(0, 1 - spread(2) / 30) + 0.4 * max(0, 1 - km / limit(max(x[5] for x in own if x[5]))) + 0.2 * max(0, 1 - spread(5) / 1.5)
        r = got[c]
        assert r.cluster_size == 60 and abs(r.cluster_max_distance_km - km) < 0.006 and abs(r.cluster_max_magnitude_diff - spread(5)) < 0.006
        assert abs(r.cluster_max_time_diff_sec - spread(2)) < 0.006 and abs(r.dedup_confidence - conf) < 0.002


def test_distance(spark):
    rng = random.Random(1)
    places = [(rng.uniform(-90, 90), rng.uniform(-180, 180), rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(50)] + [(0.0, 0.0, 0.0, 180.0), (12.0, 7.0, 12.0, 7.0)]
    df = spark.createDataFrame(places, "a double, b double, c double, d double")
    for r in df.withColumn("km", S.haversine_km(F.col("a"), F.col("b"), F.col("c"), F.col("d"))).collect():
        assert r.km == pytest.approx(kilometres((r.a, r.b), (r.c, r.d)), rel=1e-9, abs=1e-6)


def test_sessions_and_context_of_random_times(spark):
    rng = random.Random(6)
    times = sorted(rng.uniform(0, 40_000) for _ in range(120)) + [50_000.0, 50_210.0, 50_420.5]
    rows = [(f"e{i:03d}", t, round(rng.uniform(3, 7), 2)) for i, t in enumerate(times)]
    df = spark.createDataFrame([*rows, ("none", None, 4.0)], "event_id string, t_sec double, magnitude double")
    want, head, before = {"none": "none"}, None, -1e9
    for k, t, _ in rows:
        head = k if t - before > 210.0 else head
        want[k], before = head, t
    for bucket in (86_400.0, 777.0):
        assert {r.event_id: r.window_group for r in windows.sessionize(df, "event_id", "t_sec", bucket=bucket).collect()} == want
    facts = df.where("t_sec is not null").select("event_id", "magnitude")
    for r in windows.window_context(facts, df.where("t_sec is not null")).collect():
        t = dict((k, x) for k, x, _ in rows)[r.event_id]
        near = [m for k, x, m in rows if k != r.event_id and t - 130.0 <= x <= t + 200.0]
        assert r.window_group == want[r.event_id] and r.window_other_max_magnitude == (max(near) if near else None)
        assert r.label_ambiguous == (bool(near) and max(near) >= r.magnitude)


def test_remapped_ids_collapse(spark):
    rng = random.Random(2)
    ids = [(rng.choice(["usgs", "isc"]), f"x{i}", f"x{i - i % 3}") for i in range(12)]
    facts = [(f"x{rng.randrange(14)}", rng.choice(["P", "Q"]), i) for i in range(30)]
    m = spark.createDataFrame(ids, "source string, source_event_id string, representative_event_id string")
    df = spark.createDataFrame(facts, "event_id string, station string, n long").withColumn("orig", F.col("event_id"))
    to = {k: r for _, k, r in ids}
    want = {}
    for k, station, n in facts:  # a representative's own row first, then the first row
        new = to.get(k, k)
        want[new, station] = min(want.get((new, station), (9, 0)), (k != new, n))
    got = {(r.event_id, r.station): (r.orig != r.event_id, r.n) for r in joins.collapse_duplicates(joins.remap(df, joins.id_lookup(m, F.col("source"))), "orig", "n").collect()}
    assert got == want


def test_nearest_of_random_places(spark):
    rng = random.Random(3)
    events = [(i, rng.uniform(35, 42), rng.uniform(26, 45)) for i in range(30)]
    places = [(f"s{i}", rng.uniform(35, 42), rng.uniform(26, 45), i % 3 == 0) for i in range(40)]
    e = spark.createDataFrame(events, "event_id long, latitude double, longitude double")
    s = spark.createDataFrame(places, "station string, latitude double, longitude double, has_strong_motion boolean")
    flags = {"any": F.lit(True), "sm": F.col("has_strong_motion")}
    for r in joins.nearest(e, s, "station", flags).collect():
        for flag, some in (("any", places), ("sm", [x for x in places if x[3]])):
            near = min(some, key=lambda x: kilometres(events[r.event_id][1:], x[1:3]))
            assert r[flag] == near[0] and r[f"{flag}_distance_km"] == pytest.approx(kilometres(events[r.event_id][1:], near[1:3]), rel=1e-6)
    assert {r.sm for r in joins.nearest(e, s.where("not has_strong_motion"), "station", flags).collect()} == {None}


def test_nearest_of_equal_distances_is_the_first_key(spark):
    """Places as far to the north as to the south, whose terms differ in the last bits."""
    e = spark.range(10).select(F.col("id").alias("event_id"), (38.0 + F.col("id") * 0.1).alias("latitude"), F.lit(36.0).alias("longitude"))
    s = spark.range(80).select(F.format_string("s%02d", (F.col("id") * 37) % 80).alias("station"), (F.lit(37.05) + F.col("id") * 0.1).alias("latitude"), F.lit(36.0).alias("longitude"))
    places = s.collect()
    for r in joins.nearest(e, s, "station", {"any": F.lit(True)}).collect():
        near = min((round(kilometres((r.latitude, r.longitude), x[1:3]), 6), x.station) for x in places)
        assert (r["any"], round(r.any_distance_km, 6)) == (near[1], near[0])


def test_nearest_in_blocks(spark, monkeypatch):
    e = spark.range(20).select(F.col("id").alias("event_id"), (35 + F.col("id") * 0.3).alias("latitude"), (30 + F.col("id") % 7).cast("double").alias("longitude"))
    s = spark.range(50).select(F.col("id").cast("string").alias("station"), (34 + F.col("id") * 0.17).alias("latitude"), (28 + F.col("id") % 11).cast("double").alias("longitude"))
    one = {r.event_id: r.any for r in joins.nearest(e, s, "station", {"any": F.lit(True)}).collect()}
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 7)
    assert one == {r.event_id: r.any for r in joins.nearest(e, s, "station", {"any": F.lit(True)}).collect()}


def test_scalars(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    classes = [one(S.site_class(F.lit(float(v)))) for v in (1, 179, 181, 359, 361, 759, 761, 1499, 1501)]
    assert classes == sorted(classes, reverse=True) and set(classes) == set("ABCDE") and one(S.site_class(F.lit(-3.0))) is None
    corners = [one(S.highpass_corner(F.lit(m))) for m in (3.0, 5.4, 5.6, 6.4, 6.6, 8.0)]
    assert corners == sorted(corners, reverse=True) and len(set(corners)) == 3
    assert one(S.estimate_mw(F.lit("other"), F.lit(4.0))) is None and one(S.estimate_mw(F.lit("moment_magnitude"), F.lit(6.1))) == 6.1
    rng = random.Random(7)
    for _ in range(5):
        text = "".join(rng.choices("abcXYZ019:/=._", k=20))
        back = one(S.desanitize_id(S.sanitize_id(F.lit(text))))
        assert back == text or "_" in text


def test_k_nearest_in_blocks(spark, monkeypatch):
    points = spark.createDataFrame([(str(i), float(i % 7)) for i in range(20)], "event_id string, x double")
    places = spark.createDataFrame([(f"s{i:02d}", float(i % 9)) for i in range(25)], "station string, y double")
    run = lambda: sorted(map(tuple, joins.k_nearest(points, places, "event_id", "station", F.abs(F.col("x") - F.col("y")), 4, 3.0, F.lit(True)).select("event_id", "station", "distance_km", "rank").collect()))
    want = []
    for i in range(20):
        near = sorted((abs(float(i % 7) - float(j % 9)), f"s{j:02d}") for j in range(25))
        want += [(str(i), s, d, n + 1) for n, (d, s) in enumerate(x for x in near if x[0] <= 3.0) if n < 4]
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 6)
    assert run() == sorted(want)


def test_k_nearest_from_the_reference_magnitude(spark):
    import math

    from faultline.plans import bindings
    from faultline.plans.queries import QUERIES

    d = "/root/testdata/sf0.001"
    events = bindings.catalog(spark, d).where("magnitude >= 4.5").collect()
    stations = bindings.stations(spark, d).where("has_strong_motion").collect()
    got = {(r.event_id, r["rank"]): r.distance_km for r in QUERIES["k_nearest_stations_m45"](spark, d).collect()}
    want = {}
    for e in events:
        distances = []
        for s in stations:
            a, b = math.radians(e.latitude), math.radians(s.latitude)
            h = math.sin((b - a) / 2) ** 2 + math.cos(a) * math.cos(b) * math.sin(math.radians(s.longitude - e.longitude) / 2) ** 2
            distances.append(2 * 6371 * math.asin(math.sqrt(h)))
        want |= {(e.event_id, n + 1): x for n, x in enumerate(sorted(x for x in distances if x <= 400)[:12])}
    assert len(events) == 40 and got.keys() == want.keys() and all(abs(got[k] - want[k]) < 0.5 for k in want)


def test_forest_has_the_reference_number_of_trees(spark, monkeypatch):
    from pyspark.ml.regression import RandomForestRegressor

    from faultline.plans.queries import QUERIES

    made = []
    fit = RandomForestRegressor.fit
    monkeypatch.setattr(RandomForestRegressor, "fit", lambda self, *a: made.append(m := fit(self, *a)) or m)
    assert QUERIES["random_forest"](spark, "/root/testdata/sf0.001").count() == 1
    assert [m.getNumTrees for m in made] == [200]
