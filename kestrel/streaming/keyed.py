"""Streaming enrichment with one state per vehicle in Spark's state store.

``telemetry`` reads and writes the last fixes of all vehicles ever seen in
each micro-batch. Here each vehicle's state stands in the state store (RocksDB
with the session's settings), and a micro-batch touches the vehicles it holds.

State of a vehicle: its last fix, and a hash and time of every fix of the last
``horizon``. A cleaned fix is

* ``duplicate`` if the same fix (all columns) came before, in this or an
  earlier micro-batch, within the horizon of the vehicle's newest fix;
* ``late`` if it lies before the vehicle's last fix of an earlier micro-batch;
* ``enriched`` else, with its acceleration against the fix before it.

Every input row reaches exactly one of ``enriched``, ``duplicate``, ``late``
and ``rejects`` (not decodable or not clean, with the reason), in folders
``epoch=n`` written by overwrite, so a micro-batch that runs again replaces its
own results; the state store goes back to the version of that micro-batch.

A vehicle's rows of one micro-batch meet in one task: memory and time of that
task follow the micro-batch (bounded by the source's ``maxFilesPerTrigger`` or
``maxOffsetsPerTrigger``), not the history. For a feed in which one vehicle
sends most of a large micro-batch use ``telemetry``, whose (vehicle, hour)
buckets spread it.
"""

from __future__ import annotations

import os
import uuid
import warnings
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from kestrel.operators import tracking as tk
from kestrel.session import ensure_checkpoint_dir, materialize, scratch
from kestrel.streaming.telemetry import clean_reports

OUTPUTS = ("enriched", "duplicate", "late", "rejects")
ORDER = ["us", "speed", "lat", "lng"]
HORIZON_SECONDS = 2 * 3600

_TYPES = {"vin": "string", "lat": "double", "lng": "double", "altitude": "int", "speed": "double", "motion": "boolean",
          "power": "double", "distance": "double", "engineHours": "int"}
_STATE = "us long, speed double, lat double, lng double, seen_us binary, seen_hash binary"


def _key(us, speed, lat, lng) -> tuple:
    """Orders fixes; an unknown speed comes before all others."""
    return (us, speed is not None, speed or 0.0, lat, lng)


def _place(us, speed, lat, lng, fix) -> tuple:
    """Place of a fix among a vehicle's rows: by ``ORDER`` and hash, unknown values first."""
    return (us, speed is not None, speed or 0.0, lat == lat, lat if lat == lat else 0.0, lng == lng,
            lng if lng == lng else 0.0, fix)


def _cells(column: pd.Series) -> list:
    return [None if v is None or v != v else v for v in column.tolist()]


def step(rows: pd.DataFrame, last: tuple | None, seen_us: np.ndarray, seen_hash: np.ndarray, horizon_us: int,
         drop_repeats: bool, speed_factor: float) -> tuple[pd.DataFrame, tuple, np.ndarray, np.ndarray]:
    """One vehicle's rows of a micro-batch: the rows with outcome and acceleration, and the state after them."""
    # plain lists and one build at the end: a vehicle has few rows, and each pandas call costs more than they do
    fixes = list(zip(rows["us"].tolist(), _cells(rows["speed"]), rows["lat"].tolist(), rows["lng"].tolist(),
                     rows["fix_hash"].tolist()))
    places = sorted(range(len(fixes)), key=lambda i: _place(*fixes[i]))
    if places != list(range(len(fixes))):
        rows, fixes = rows.take(places), [fixes[i] for i in places]
    before, known = last, set(seen_hash.tolist())
    outcome, acceleration = [], []
    for us, speed, lat, lng, fix in fixes:
        mine, a = _key(us, speed, lat, lng), None
        if drop_repeats and fix in known:
            outcome.append("duplicate")
        elif before is not None and mine < _key(*before):
            outcome.append("late")
        else:
            outcome.append("enriched")
            if last is not None and speed is not None and last[1] is not None:
                seconds = us // 1_000_000 - last[0] // 1_000_000
                a = (speed - last[1]) * speed_factor / float(seconds) if seconds else None
            last = (us, speed, lat, lng)
        known.add(fix)
        acceleration.append(a)
    out = rows.assign(outcome=outcome, acceleration=pd.array(acceleration, "Float64"))
    if drop_repeats:
        new = np.array([o != "duplicate" for o in outcome], bool)
        seen_us = np.concatenate([seen_us, rows["us"].to_numpy(np.int64)[new]])
        seen_hash = np.concatenate([seen_hash, rows["fix_hash"].to_numpy(np.int64)[new]])
        near = seen_us >= seen_us.max(initial=0) - horizon_us
        seen_us, seen_hash = seen_us[near], seen_hash[near]
    return out, last, seen_us, seen_hash


def with_outcome(good: DataFrame, horizon_seconds: int = HORIZON_SECONDS, drop_repeats: bool = True,
                 speed_factor: float = tk.MPH_TO_MS) -> DataFrame:
    """Streaming fixes with ``outcome`` and ``acceleration``, one keyed state per vehicle."""
    us = F.unix_micros(F.col("dt").cast("timestamp"))
    rows = good.select(*[F.col(c).cast(t).alias(c) for c, t in _TYPES.items()], us.alias("us"),
                       F.xxhash64(*tk.GPS_COLUMNS).alias("fix_hash"))
    columns = [f.name for f in rows.schema]
    out_type = ", ".join([*[f"{c} {t}" for c, t in _TYPES.items()], "us long, fix_hash long, outcome string, "
                          "acceleration double"])

    def vehicle(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        warnings.filterwarnings("ignore", category=FutureWarning, module="pyspark")  # of columns without a value
        last, seen = None, (np.zeros(0, np.int64), np.zeros(0, np.int64))
        if state.exists:
            *last, seen_us, seen_hash = state.get
            last = tuple(None if isinstance(v, float) and v != v else v for v in last)
            seen = np.frombuffer(seen_us, np.int64), np.frombuffer(seen_hash, np.int64)
        frames = list(frames)
        out, last, *seen = step(frames[0] if len(frames) == 1 else pd.concat(frames, ignore_index=True), last, *seen, horizon_seconds * 1_000_000,
                                drop_repeats, speed_factor)
        if last is not None:
            state.update((*last, seen[0].tobytes(), seen[1].tobytes()))
        yield out[[*columns, "outcome", "acceleration"]]

    return rows.groupBy("vin").applyInPandasWithState(vehicle, out_type, _STATE, "append", GroupStateTimeout.NoTimeout)


def start(stream: DataFrame, pois: DataFrame, base: str, speed_type: str = "int",
          clean: Callable[[DataFrame], DataFrame] = clean_reports,
          after_epoch: Callable[[int], None] | None = None, **options):
    """Process what the source holds now, from the checkpoint under ``base``; two queries, rejects and fixes."""
    cleaned = clean(stream)

    def keep(batch: DataFrame, epoch: int) -> None:
        tk.rejected_rows(batch, [c for c in ("raw_value",) if c in batch.columns]).write.mode("overwrite").parquet(
            f"{base}/rejects/epoch={epoch}")

    def each(batch: DataFrame, epoch: int) -> None:
        with scratch(batch.sparkSession):
            rows = materialize(batch.withColumns({"dt": F.timestamp_micros("us").cast("timestamp_ntz"),
                                                  "speed": F.col("speed").cast(speed_type)}), "keyed-rows")
            for outcome in ("duplicate", "late"):
                (rows.filter(F.col("outcome") == outcome).select(*tk.GPS_COLUMNS)
                 .write.mode("overwrite").parquet(f"{base}/{outcome}/epoch={epoch}"))
            moving = tk.driving_harshness(rows.filter("outcome = 'enriched'"))
            (tk.resolve_pois(moving, pois).select(*tk.ENRICHED_COLUMNS)
             .write.mode("overwrite").parquet(f"{base}/enriched/epoch={epoch}"))
        if after_epoch:
            after_epoch(epoch)

    fixes = with_outcome(tk.good_rows(cleaned), **options)
    return [df.writeStream.foreachBatch(f).option("checkpointLocation", f"{base}/checkpoint-{name}")
            .trigger(availableNow=True).start()
            for name, df, f in (("rejects", cleaned, keep), ("fixes", fixes, each))]


def run(stream: DataFrame, pois: DataFrame, base: str, **options) -> dict[str, str]:
    """``start`` and wait; paths of the outputs."""
    for query in start(stream, pois, base, **options):
        query.awaitTermination()
    return {k: f"{base}/{k}" for k in OUTPUTS}


def fresh_base(spark: SparkSession, name: str) -> str:
    return os.path.join(ensure_checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")
