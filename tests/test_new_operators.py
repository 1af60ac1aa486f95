"""Sketches, dyadic intervals, accent-aware codes and corrupt records."""

import datetime as dt
import random

from pyspark.sql import functions as F

from kestrel.functions.text import fold_accents, name_codes
from kestrel.operators import intervals as iv
from kestrel.operators import matching as mm
from kestrel.operators import sketches as sk
from kestrel.sources import files


def test_merged_sketches_stay_within_their_bound(spark):
    rnd = random.Random(4)
    rows = [(dt.datetime(2024, 1, 1) + dt.timedelta(seconds=rnd.randrange(2 * 86400)), "A",
             rnd.gauss(50, 20), rnd.randrange(3000)) for _ in range(40_000)]
    rows += [(None, "A", 1.0, 1), (dt.datetime(2024, 1, 1), "B", None, None)]
    df = spark.createDataFrame(rows, "t timestamp_ntz, c string, x double, who int")
    minutes = sk.minute_sketches(df, "t", ["c"], ["x"], "who")
    days = sk.merge(sk.merge(minutes, ["c"], ["x"], "who", 3600), ["c"], ["x"], "who", 86400)
    got = {(r.period.day, r.c): r for r in sk.estimates(days, ["c"], ["x"], "who").collect()}
    assert set(got) == {(1, "A"), (2, "A"), (1, "B")}
    for day in (1, 2):
        mine = [r for r in rows if r[1] == "A" and r[0] and r[0].day == day]
        xs, r = sorted(x[2] for x in mine), got[day, "A"]
        assert (r.samples, r.n_x, r.min_x, r.max_x) == (len(mine), len(mine), xs[0], xs[-1])
        assert abs(sum(x <= r.q70_x for x in xs) / len(xs) - 0.7) < 0.01
        assert abs(r.distinct_who / len({x[3] for x in mine}) - 1) < 0.04
    b = got[1, "B"]
    assert (b.samples, b.n_x, b.q70_x, b.avg_x, b.distinct_who) == (1, 0, None, None, 0)


def test_dyadic_cover_is_disjoint_complete_and_short(spark):
    rnd = random.Random(1)
    bounds = [(0, 0), (1, 1), (-1, 0), (-9, -2), (-300, 41), (0, 7), (1, 6), (5, 4), (3, 2**30)]
    bounds += [(a, a + rnd.randrange(400)) for a in (rnd.randrange(5000) for _ in range(200))]
    df = spark.createDataFrame(bounds, "lo long, hi long")
    for r in df.select("lo", "hi", iv.dyadic_cover(F.col("lo"), F.col("hi")).alias("c")).collect():
        width = max(0, r.hi - r.lo + 1)
        assert sum(2 ** x.level for x in r.c) == width and len(r.c) <= 2 * width.bit_length()
        if width < 1000:
            units = [u for x in r.c for u in range(x.block << x.level, (x.block + 1) << x.level)]
            assert sorted(units) == list(range(r.lo, r.hi + 1))


def test_points_in_intervals_equal_brute_force(spark):
    rnd = random.Random(2)
    lo = [(i, rnd.choice("ab"), a, a + rnd.choice([0, 3, 90, 7300])) for i, a in
          enumerate(rnd.randrange(-900, 900) for _ in range(150))] + [(900, None, 0, 5), (901, "a", 9, 3), (902, "a", None, 5)]
    at = [(i, rnd.choice("ab"), rnd.randrange(-1000, 8000)) for i in range(300)] + [(900, "a", None), (901, None, 4)]
    at += at[:20]
    left = spark.createDataFrame(lo, "i long, k string, lo long, hi long")
    right = spark.createDataFrame(at, "j long, pk string, p long")
    out = iv.points_in_intervals(left, right, "k", "pk", F.col("lo"), F.col("hi"), F.col("p"),
                                 F.col("p").between(F.col("lo"), F.col("hi")))
    want = sorted((i, j) for i, k, a, b in lo for j, pk, p in at
                  if k and k == pk and a is not None and p is not None and a <= p <= b)
    assert sorted((r.i, r.j) for r in out.collect()) == want
    assert iv.points_in_intervals(left, right.limit(0), "k", "pk", F.col("lo"), F.col("hi"), F.col("p"),
                                  F.lit(True)).count() == 0


def test_names_with_accents_and_parts(spark):
    rows = [("Éloïse", "Eloise"), ("Jean-Pierre", "Jean  Pierre"), ("Œuvrard", "OEUVRARD"), ("Nguyễn", "Nguyen"),
            ("étoile", "etoile"), ("D'Ångström", "d angstrom")]
    df = spark.createDataFrame([*rows, (None, None), ("日本", "")], "a string, b string")
    got = df.select(fold_accents("a").alias("f"), name_codes("a").alias("x"), name_codes("b").alias("y")).collect()
    assert [g.f for g in got] == ["Eloise", "Jean-Pierre", "OEuvrard", "Nguyen", "etoile", "D'Angstrom", None, "日本"]
    assert all(g.x == g.y and g.x for g in got[:6]) and [(g.x, g.y) for g in got[6:]] == [(None, None)] * 2
    assert got[1].x == "J500 P600"
    out = mm.compound_match(df.select(F.lit(1).alias("k"), "a"), df.select(F.lit(1).alias("k"), "b"), ["k"], "a", "b")
    assert sorted((r.codes, r.n_left, r.n_right) for r in out.collect())[3] == ("J500 P600", 1, 1)
    assert out.count() == 6


def test_lines_that_are_no_record_are_rejected(spark, tmp_path):
    (tmp_path / "2015.json").write_text(
        '{"ORIGIN_COUNTRY_NAME":"A","DEST_COUNTRY_NAME":"B","count":3}\nnot json\n{"count":"x"}\n')
    good = files.read_traffic_json(spark, str(tmp_path), [2015])
    bad = files.read_traffic_json(spark, str(tmp_path), [2015], rejects=True)
    assert [tuple(r) for r in good.collect()] == [("A", "B", 3, 2015)]
    assert sorted((r.corrupt_record, r.reject_reason) for r in bad.collect()) == [
        ("not json", "bad_record"), ('{"count":"x"}', "bad_record")]
    readers = {"drivers": (files.read_drivers, ["id", "name"]), "poi": (files.read_pois, files.POI_COLUMNS),
               "assign": (files.read_assignments, ["driverId", "vehicle"]),
               "maint": (files.read_maintenance, files.MAINTENANCE_COLUMNS),
               "trace": (files.read_traceability, files.TRACEABILITY_COLUMNS),
               "reports": (files.read_reports, files.REPORT_COLUMNS),
               "clients": (files.read_client_register, files.CLIENT_COLUMNS)}
    for name, (reader, cols) in readers.items():
        path = tmp_path / f"{name}.csv"
        whole = ";".join([""] * (len(cols) - 1) + ["1"]) if name == "poi" else ";".join(["x"] + [""] * (len(cols) - 1))
        path.write_text("\n".join([";".join(cols), whole, whole + ";surplus", "short"]) + "\n")
        good, bad = reader(spark, str(path)), reader(spark, str(path), rejects=True)
        assert good.columns == list(cols)
        assert (good.count(), bad.filter("reject_reason = 'bad_record'").count()) == (1, 2), name
    day = tmp_path / "gps" / "2024-01-01"
    day.mkdir(parents=True)
    line = ";".join(str(i) for i in range(len(files.GPS_COLUMNS)))
    (day / "a.csv").write_text("\n".join([";".join(files.GPS_COLUMNS), line, line + ";9"]) + "\n")
    assert files.read_gps_day(spark, str(tmp_path / "gps"), "2024-01-01").count() == 1
    assert files.read_gps_day(spark, str(tmp_path / "gps"), "2024-01-01", rejects=True).count() == 1


def test_join_blocks_are_few_whatever_the_length(spark):
    rnd = random.Random(7)
    bounds = [(0, 0), (-1, 0), (-9, -2), (5, 4), (3, 2**30), (0, 15), (0, 16), (7, 262)]
    bounds += [(a, a + rnd.randrange(4000)) for a in (rnd.randrange(-5000, 5000) for _ in range(200))]
    df = spark.createDataFrame(bounds, "lo long, hi long").withColumn("level", iv.block_level(F.col("lo"), F.col("hi")))
    for r in df.collect():
        if r.lo > r.hi:
            assert r.level is None
        else:
            n = (r.hi >> r.level) - (r.lo >> r.level) + 1
            assert r.level % iv.STEP == 0 and (1 << r.level) <= r.hi - r.lo + 1 and n <= 17
    assert df.select("level").distinct().count() <= 6
