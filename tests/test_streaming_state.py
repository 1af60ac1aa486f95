import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from kestrel.operators import journeys as jn
from kestrel.operators import logs as lg
from kestrel.operators import tracking as tk
from kestrel.sources import derived
from kestrel.sources.tables import Tables
from kestrel.streaming import feed, keyed, windows
from kestrel.streaming import telemetry as st

from conftest import SMOKE
from test_streaming import RAW, _pois, fix


def _rows(spark, paths, name):
    return spark.read.parquet(paths[name]).collect()


def _deliver(spark, batches, each, schema=RAW):
    """``each(stream)`` after every batch is there."""
    src, out = tempfile.mkdtemp(prefix="kestrel-stream-src-"), None
    for rows in batches:
        spark.createDataFrame(rows, schema).write.mode("append").parquet(src)
        out = each(st.read_file_stream(spark, src))
    return out


def _run(spark, batches, **options):
    base = tempfile.mkdtemp(prefix="kestrel-keyed-")
    return _deliver(spark, batches, lambda s: keyed.run(s, _pois(spark), base, **options))


def test_five_micro_batches_equal_the_batch_answer_and_lose_nothing(spark):
    t = Tables(spark, SMOKE)
    pois, base = derived.pois_from_nation(t.nation), tempfile.mkdtemp(prefix="kestrel-keyed-")
    n = t.events.count()
    again = F.col("event_id") % 20 == 0
    for path in feed.deliveries(t.events, "ts", 5, again=again):
        paths = keyed.run(derived.gps_raw(st.read_file_stream(spark, path)), pois, base, horizon_seconds=30 * 86400)
    delivered = spark.read.parquet(path).count()
    assert n < delivered
    counts = {k: len(_rows(spark, paths, k)) for k in keyed.OUTPUTS}
    assert sum(counts.values()) == delivered and counts["late"] == 0 and counts["duplicate"] > 0
    assert spark.read.parquet(paths["enriched"]).select("epoch").distinct().count() >= 5
    cols = list(tk.ENRICHED_COLUMNS)
    got = sorted(tuple(r) for r in spark.read.parquet(paths["enriched"]).select(*cols).collect())
    want = sorted(tuple(r) for r in tk.enrich(derived.gps_raw(t.events), pois).select(*cols).collect())
    assert got == want


def test_a_repeat_two_micro_batches_later_is_a_duplicate_not_late(spark):
    first = fix("V", "10:00:00", "10")
    paths = _run(spark, [[first], [fix("V", "10:00:10", "20")], [first, fix("V", "10:00:05", "1"), fix("V", "10:00:20", "x")],
                         [fix("V", "10:00:20", "40"), fix("V", "10:00:20", "40")]])
    assert [(r.vin, r.speed) for r in _rows(spark, paths, "duplicate") if r.epoch == 2] == [("V", 10)]
    assert [(r.vin, r.speed) for r in _rows(spark, paths, "late")] == [("V", 1)]
    assert len(_rows(spark, paths, "rejects")) == 1 and len(_rows(spark, paths, "duplicate")) == 2
    rows = {r.speed: r for r in _rows(spark, paths, "enriched")}
    assert sorted(rows) == [10, 20, 40]
    assert rows[10].acceleration is None and rows[10].poi == "P"
    assert abs(rows[40].acceleration - 20 * tk.MPH_TO_MS / 10) < 1e-12


def test_beyond_the_horizon_a_repeat_is_late(spark):
    first = fix("V", "10:00:00", "10")
    paths = _run(spark, [[first], [fix("V", "10:10:00", "20")], [first]], horizon_seconds=60)
    assert [r.speed for r in _rows(spark, paths, "late")] == [10] and not _rows(spark, paths, "duplicate")


def test_a_failed_micro_batch_runs_again_with_the_state_before_it(spark):
    base, src = tempfile.mkdtemp(prefix="kestrel-keyed-"), tempfile.mkdtemp(prefix="kestrel-stream-src-")
    fail = {1}

    def after(epoch):
        if epoch in fail:
            fail.discard(epoch)
            raise RuntimeError("lost after the outputs were written")

    def go():
        return keyed.run(st.read_file_stream(spark, src), _pois(spark), base, after_epoch=after)

    spark.createDataFrame([fix("V", "10:00:00", "10")], RAW).write.mode("append").parquet(src)
    go()
    spark.createDataFrame([fix("V", "10:00:10", "20"), fix("V", "10:00:00", "10")], RAW).write.mode("append").parquet(src)
    with pytest.raises(Exception, match="lost after"):
        go()
    spark.createDataFrame([fix("V", "10:00:20", "30")], RAW).write.mode("append").parquet(src)
    paths = go()
    got = sorted((r.speed, r.acceleration) for r in _rows(spark, paths, "enriched") if r.acceleration is not None)
    assert [s for s, _ in got] == [20, 30] and all(abs(a - tk.MPH_TO_MS) < 1e-12 for _, a in got)
    assert len(_rows(spark, paths, "enriched")) == 3 and len(_rows(spark, paths, "duplicate")) == 1


def test_unknown_speeds_and_nothing_to_do(spark):
    paths = _run(spark, [[fix("V", "10:00:00", None)], [fix("V", "10:00:00", "5"), fix("V", "10:00:10", None)],
                         [fix("V", "10:00:20", "7")]])
    rows = _rows(spark, paths, "enriched")
    assert len(rows) == 4 and all(r.acceleration is None for r in rows)


def _windowed(spark, make, closing=True, **options):
    t = Tables(spark, SMOKE)
    base = tempfile.mkdtemp(prefix="kestrel-windows-")
    for path in feed.deliveries(t.events, "ts", 4, closing=derived.heartbeat(t.events) if closing else None, **options):
        out = windows.run(make(st.read_file_stream(spark, path)), base)
    return out


def _sorted(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_closed_windows_equal_the_batch_answer(spark):
    events = Tables(spark, SMOKE).events
    metrics = _windowed(spark, lambda f: windows.component_metrics(derived.component_metrics_input(f)))
    assert _sorted(metrics) == _sorted(lg.component_metrics(derived.component_metrics_input(events)))
    activity = _windowed(spark, lambda f: windows.activity(lg.parse_logs(derived.log_lines(f)), delay="30 days"),
                         again=F.col("event_id") % 7 == 0)
    assert _sorted(activity) == _sorted(lg.activity(lg.parse_logs(derived.log_lines(events))))
    trips = _windowed(spark, lambda f: windows.trips(tk.good_rows(tk.clean(tk.normalize(derived.gps_raw(f))))))
    good = tk.good_rows(tk.clean(tk.normalize(derived.gps_raw(events))))
    assert _sorted(trips) == _sorted(jn.trips(good))


def test_open_windows_wait_and_lost_rows_are_an_error(spark):
    sample = "timestamp timestamp_ntz, component string, requests_count int, ram_usage int, cpu_usage int"
    at = dt.datetime(2024, 1, 1, 10)
    base = tempfile.mkdtemp(prefix="kestrel-windows-")

    def rows(*minutes):
        return [(at + dt.timedelta(minutes=m), "A", 1, 50 + m, 30) for m in minutes]

    def go(stream):
        return windows.run(windows.component_metrics(stream, delay="5 minutes"), base)

    out = _deliver(spark, [rows(0, 0, 3), rows(8)], go, sample)
    assert [(r.datetime_timestamp.minute, r.requests_count) for r in out.collect()] == [(0, 2)]
    with pytest.raises(RuntimeError, match="behind the watermark"):
        _deliver(spark, [rows(0, 30), rows(1)], lambda s: windows.run(
            windows.component_metrics(s, delay="5 minutes"), base + "-late"), sample)


def test_a_vehicles_step_sorts_unknown_values_first_without_pandas_sorting(monkeypatch):
    import numpy as np
    import pandas as pd
    monkeypatch.setattr(pd.DataFrame, "sort_values", lambda *a, **k: pytest.fail("a pandas sort per vehicle"))
    rows = pd.DataFrame({"us": [2_000_000, 1_000_000, 1_000_000], "speed": [20.0, 10.0, None], "lat": [1.0] * 3,
                         "lng": [2.0] * 3, "fix_hash": [3, 2, 1]})
    none = np.zeros(0, np.int64)
    out, last, _, seen = keyed.step(rows, None, none, none, 10**12, True, 1.0)
    assert out["fix_hash"].tolist() == [1, 2, 3] == seen.tolist() and last == (2_000_000, 20.0, 1.0, 2.0)
    assert out["outcome"].tolist() == ["enriched"] * 3 and out["acceleration"].tolist()[2] == 10.0
