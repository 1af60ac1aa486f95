"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each entry reads the driver tables (or frames Spark derives from them) and
runs one operator of the library over the whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.operators import journeys as jn
from kestrel.operators import logs as lg
from kestrel.operators import maintenance as mt
from kestrel.operators import matching as mm
from kestrel.operators import sketches as sk
from kestrel.operators import tracking as tk
from kestrel.operators import traffic as tr
from kestrel.plans import params as P
from kestrel.session import materialize
from kestrel.sources import derived
from kestrel.sources.tables import Tables

Query = Callable[[SparkSession, str], DataFrame]


def _traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return derived.traffic_table(t.lineitem, t.orders, t.customer, t.supplier, t.nation)


def q_traffic_table(spark, sf_dir):
    return _traffic(spark, sf_dir)


def q_traffic_rows_per_year(spark, sf_dir):
    return tr.rows_per_year(_traffic(spark, sf_dir))


def q_domestic_routes(spark, sf_dir):
    return tr.domestic_routes(_traffic(spark, sf_dir), P.HOME)


def q_outwardness(spark, sf_dir):
    return tr.outwardness(_traffic(spark, sf_dir), P.HOME)


def q_outwardness_full(spark, sf_dir):
    return tr.outwardness(_traffic(spark, sf_dir), P.HOME, how="full")


def q_key_zone_pivot(spark, sf_dir):
    return tr.key_zone_pivot(_traffic(spark, sf_dir), P.HOME, P.KEY_ZONES)


def _logs(spark, sf_dir):
    return lg.parse_logs(derived.log_lines(Tables(spark, sf_dir).events))


def q_log_lines(spark, sf_dir):
    return derived.log_lines(Tables(spark, sf_dir).events)


def q_parse_logs(spark, sf_dir):
    return _logs(spark, sf_dir)


def q_activity_30min(spark, sf_dir):
    return lg.activity(_logs(spark, sf_dir), "30 minutes")


def q_activity_hourly(spark, sf_dir):
    return lg.activity(_logs(spark, sf_dir), "1 hour")


def q_inactivity_gaps(spark, sf_dir):
    return lg.inactivity_gaps(_logs(spark, sf_dir), P.SLOT_MINUTES, by=("composante",))


def q_incomplete_requests(spark, sf_dir):
    return lg.incomplete_requests(_logs(spark, sf_dir), P.INCOMPLETE_COMPONENT)


def q_component_metrics(spark, sf_dir):
    return lg.component_metrics(derived.component_metrics_input(Tables(spark, sf_dir).events))


def _gps_cleaned(spark, sf_dir):
    return tk.clean(tk.normalize(derived.gps_raw(Tables(spark, sf_dir).events)))


def _pois(spark, sf_dir):
    return derived.pois_from_nation(Tables(spark, sf_dir).nation)


def q_gps_clean(spark, sf_dir):
    return tk.good_rows(_gps_cleaned(spark, sf_dir))


def q_gps_rejects(spark, sf_dir):
    return tk.rejected_rows(_gps_cleaned(spark, sf_dir))


def q_gps_acceleration(spark, sf_dir):
    good = tk.good_rows(_gps_cleaned(spark, sf_dir))
    return tk.driving_harshness(tk.compute_acceleration(good))


def q_gps_nearest_poi(spark, sf_dir):
    good = tk.good_rows(_gps_cleaned(spark, sf_dir))
    return tk.resolve_pois(good, _pois(spark, sf_dir))


def q_gps_enriched(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return tk.enrich(derived.gps_raw(t.events), _pois(spark, sf_dir))


def q_driver_kpis(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return tk.driver_kpis(q_gps_enriched(spark, sf_dir), derived.drivers_from_customer(t.customer),
                          derived.assignments_from_customer(t.customer))


HISTORY_ORDER = (mt.START, "numero_intervention", mt.DUE, mt.STATE, "trace_id")


def _states(spark, sf_dir, censor_last=False):
    t = Tables(spark, sf_dir)
    return mt.assign_state(derived.interventions(t.orders),
                           derived.traceability(t.lineitem, t.orders), censor_last=censor_last)


def q_assign_state(spark, sf_dir):
    return _states(spark, sf_dir).select(*mt.STATE_COLUMNS)


def q_next_state(spark, sf_dir):
    return mt.next_state(_states(spark, sf_dir), HISTORY_ORDER).select(
        *mt.STATE_COLUMNS, "first_element", "element_trouve", "next_rc")


def q_lifetime(spark, sf_dir):
    return mt.lifetime(_states(spark, sf_dir), HISTORY_ORDER, as_struct=False).select(
        *mt.STATE_COLUMNS, "duree_vie_jour", "duree_vie_km", "type_individu")


def _part_sides(spark, sf_dir, block=P.MATCH_BLOCK):
    part = Tables(spark, sf_dir).part
    block = list(block)

    def side(p):
        return part.select(*block, F.col("p_partkey").alias(f"{p}_partkey"),
                           F.col("p_name").alias(f"{p}_name"))
    return side("a"), side("b"), block


MATCH_COLUMNS = ("a_partkey", "b_partkey", "a_name", "b_name", *P.MATCH_BLOCK, "score")


def _self_pairs():
    return F.col("a_partkey") < F.col("b_partkey")


def q_fuzzy_match(spark, sf_dir):
    a, b, block = _part_sides(spark, sf_dir)
    return mm.fuzzy_match(a, b, block, "a_name", "b_name", P.MATCH_THRESHOLD,
                          pair_filter=_self_pairs(), symmetric=True).select(*MATCH_COLUMNS)


def q_fuzzy_match_brand(spark, sf_dir):
    """Coarser blocking (brand only): larger blocks, same exact candidate scheme."""
    a, b, block = _part_sides(spark, sf_dir, P.MATCH_BLOCK_COARSE)
    return mm.fuzzy_match(a, b, block, "a_name", "b_name", P.MATCH_THRESHOLD,
                          pair_filter=_self_pairs(), symmetric=True).select(
        "a_partkey", "b_partkey", "a_name", "b_name", *block, "score")


def q_fuzzy_name_pairs(spark, sf_dir):
    """The brand-wide match as name pairs with group sizes."""
    a, b, block = _part_sides(spark, sf_dir, P.MATCH_BLOCK_COARSE)
    return mm.name_pair_groups(a, b, block, "a_name", "b_name", P.MATCH_THRESHOLD, symmetric=True)


def q_field_match(spark, sf_dir):
    """Field by field: name and type of parts of one brand and size."""
    part = Tables(spark, sf_dir).part

    def side(p):
        return part.select("p_brand", "p_size", F.col("p_name").alias(f"{p}_name"),
                           F.col("p_type").alias(f"{p}_type"))
    return mm.field_match(side("a"), side("b"), ["p_brand", "p_size"],
                          [("a_name", "b_name"), ("a_type", "b_type")], P.MATCH_THRESHOLD)


def q_phonetic_match(spark, sf_dir):
    return mm.phonetic_columns(q_fuzzy_match(spark, sf_dir), "a_name", "b_name")


def _combined(spark, sf_dir, mode):
    a, b, block = _part_sides(spark, sf_dir)
    return mm.combined_match(a, b, block, "a_name", "b_name", P.MATCH_THRESHOLD, mode=mode,
                             pair_filter=_self_pairs(), symmetric=True).select(
        *MATCH_COLUMNS, "sound_emetteur", "sound_client")


def q_combined_match_and(spark, sf_dir):
    return _combined(spark, sf_dir, "and")


def q_combined_match_or(spark, sf_dir):
    return _combined(spark, sf_dir, "or")


def _stream_run(spark, sf_dir, outputs):
    from kestrel.streaming import telemetry as st
    events = st.read_file_stream(spark, f"{sf_dir.rstrip('/')}/events.parquet")
    return st.run_available_now(spark, derived.gps_raw(events), _pois(spark, sf_dir),
                                outputs=outputs)


def q_stream_enriched(spark, sf_dir):
    paths = _stream_run(spark, sf_dir, ("enriched",))
    return spark.read.parquet(paths["enriched"]).select(*tk.ENRICHED_COLUMNS)


def q_stream_rejects(spark, sf_dir):
    paths = _stream_run(spark, sf_dir, ("rejects",))
    return spark.read.parquet(paths["rejects"]).drop("epoch")


def _fed(spark, events, parts, run, **options):
    """``run(stream, base)`` after each piece of ``events`` in time order; what the last one returned."""
    from kestrel.streaming import feed, keyed
    from kestrel.streaming import telemetry as st
    base, out = keyed.fresh_base(spark, "kestrel-fed"), None
    for path in feed.deliveries(events, "ts", parts, **options):
        out = run(st.read_file_stream(spark, path), base)
    return out


def q_stream_enriched_batches(spark, sf_dir):
    """``events`` fed as several micro-batches: the stored fixes must carry over."""
    from kestrel.streaming import telemetry as st
    paths = _fed(spark, Tables(spark, sf_dir).events, 3, lambda feed, base: st.run_available_now(
        spark, derived.gps_raw(feed), _pois(spark, sf_dir), base=base))
    return spark.read.parquet(paths["enriched"]).select(*tk.ENRICHED_COLUMNS)


def _message_run(spark, sf_dir):
    from kestrel.streaming import telemetry as st
    messages = derived.telemetry_messages(Tables(spark, sf_dir).events)
    return _fed(spark, messages, 2, lambda feed, base: st.run_available_now(
        spark, feed.select("value"), _pois(spark, sf_dir), base=base, clean=st.clean_messages))


def q_stream_messages(spark, sf_dir):
    """JSON messages end to end: decode, clean, accelerate, resolve POIs."""
    return spark.read.parquet(_message_run(spark, sf_dir)["enriched"]).select(
        "vin", "dt", "lat", "lng", "speed", "acceleration", "poi")


def _keyed_run(spark, sf_dir, **options):
    from kestrel.streaming import keyed
    horizon = options.pop("horizon_seconds", keyed.HORIZON_SECONDS)
    return _fed(spark, Tables(spark, sf_dir).events, P.FEED_PIECES, lambda feed, base: keyed.run(
        derived.gps_raw(feed), _pois(spark, sf_dir), base, horizon_seconds=horizon,
        drop_repeats="again" in options), **options)


def q_stream_keyed_enriched(spark, sf_dir):
    """Five micro-batches with one keyed state per vehicle."""
    return spark.read.parquet(_keyed_run(spark, sf_dir)["enriched"]).select(*tk.ENRICHED_COLUMNS)


def q_stream_repeated_fixes(spark, sf_dir):
    """Every twentieth event comes again two micro-batches later: the ``duplicate`` output."""
    paths = _keyed_run(spark, sf_dir, again=F.col("event_id") % P.REPEATED_EVENT == 0,
                       horizon_seconds=P.REPEAT_HORIZON_DAYS * 86400)
    return spark.read.parquet(paths["duplicate"]).select(*tk.GPS_COLUMNS)


def q_stream_component_metrics(spark, sf_dir):
    """Per-minute metrics of a stream: windows close by watermark."""
    from kestrel.streaming import windows
    events = Tables(spark, sf_dir).events
    return _fed(spark, events, P.FEED_PIECES, lambda feed, base: windows.run(
        windows.component_metrics(derived.component_metrics_input(feed)), base),
        closing=derived.heartbeat(events))


def q_stream_activity_30min(spark, sf_dir):
    """Activity of a stream of log lines; repeated lines are counted once."""
    from kestrel.streaming import windows
    events = Tables(spark, sf_dir).events
    return _fed(spark, events, P.FEED_PIECES, lambda feed, base: windows.run(windows.activity(
        lg.parse_logs(derived.log_lines(feed)), delay=f"{P.REPEAT_HORIZON_DAYS} days"), base),
        again=F.col("event_id") % P.REPEATED_EVENT == 0, closing=derived.heartbeat(events))


def q_stream_trips(spark, sf_dir):
    """Trips of a stream: sessions that merge in the state store."""
    from kestrel.streaming import windows
    events = Tables(spark, sf_dir).events
    return _fed(spark, events, P.FEED_PIECES, lambda feed, base: windows.run(windows.trips(
        tk.good_rows(tk.clean(tk.normalize(derived.gps_raw(feed))))), base), closing=derived.heartbeat(events))


def _good(spark, sf_dir):
    return materialize(tk.good_rows(_gps_cleaned(spark, sf_dir)), "good-fixes")


def q_gps_trips(spark, sf_dir):
    return jn.trips(_good(spark, sf_dir))


def q_gps_odometer(spark, sf_dir):
    return jn.odometer(_good(spark, sf_dir)).select("vin", "dt", "speed", "distance", "fix_number", "odometer")


def q_gps_moving_speed(spark, sf_dir):
    return jn.moving_speed(_good(spark, sf_dir), P.FRAME_SECONDS).select(
        "vin", "dt", "speed", "mean_speed", "max_speed", "fixes_in_frame")


def q_driver_at_fix(spark, sf_dir):
    return jn.driver_at_fix(_good(spark, sf_dir), derived.sign_ons(Tables(spark, sf_dir).events)).select(
        "vin", "dt", "speed", "driverId")


def q_speed_rank(spark, sf_dir):
    return jn.speed_rank(_good(spark, sf_dir))


def q_stream_poi_messages(spark, sf_dir):
    """The POI messages the stream wrote, read back."""
    from kestrel.streaming import telemetry as st
    return st.decode_poi_messages(spark.read.parquet(_message_run(spark, sf_dir)["pois"]))


def q_assign_state_dyadic(spark, sf_dir):
    """The same answer as assign_state, windows covered by blocks of doubling size."""
    t = Tables(spark, sf_dir)
    return mt.assign_state(derived.interventions(t.orders), derived.traceability(t.lineitem, t.orders),
                           cover="dyadic").select(*mt.STATE_COLUMNS)


def _sketched_days(spark, sf_dir):
    """Exact columns and sketch estimates per day and component, merged from stored minutes."""
    samples = derived.component_metrics_input(Tables(spark, sf_dir).events)
    keys, metrics = ["component"], ["ram_usage", "cpu_usage"]
    minutes = materialize(sk.minute_sketches(samples, "timestamp", keys, metrics, "ram_usage"), "minute-sketches")
    hours = sk.merge(minutes, keys, metrics, "ram_usage", 3600)
    return sk.estimates(sk.merge(hours, keys, metrics, "ram_usage", 86400), keys, metrics, "ram_usage")


def q_metrics_by_day_sketched(spark, sf_dir):
    """With quantiles and distinct counts, which are estimates."""
    return _sketched_days(spark, sf_dir)


def q_metrics_by_day(spark, sf_dir):
    """The columns that merge exactly."""
    return _sketched_days(spark, sf_dir).drop("q70_ram_usage", "q70_cpu_usage", "distinct_ram_usage")


def q_compound_names(spark, sf_dir):
    """Part names against the same names with accents and hyphens, by the codes of their parts."""
    part = Tables(spark, sf_dir).part
    plain = part.select("p_brand", F.col("p_name").alias("a_name"))
    other = part.select("p_brand", F.replace(F.translate("p_name", "aeiou", "àéîôü"), F.lit(" "), F.lit("-"))
                        .alias("b_name"))
    return mm.compound_match(plain, other, ["p_brand"], "a_name", "b_name")


def q_assign_state_operations(spark, sf_dir):
    """Several operations per intervention number at one start."""
    t = Tables(spark, sf_dir)
    return mt.assign_state(derived.operations(t.lineitem, t.orders),
                           derived.traceability(t.lineitem, t.orders)).select(
        *mt.STATE_COLUMNS, "numero_intervention", "code_operation", mt.DUE)


def q_lifetime_censored(spark, sf_dir):
    return mt.lifetime(_states(spark, sf_dir, censor_last=True), HISTORY_ORDER,
                       as_struct=False).select(*mt.STATE_COLUMNS, "duree_vie_jour",
                                               "duree_vie_km", "type_individu")


def q_driver_kpis_from_files(spark, sf_dir):
    """J10 + J11 as jobs: write the enriched day(s), read them back for KPIs."""
    import uuid

    from kestrel.plans import jobs
    from kestrel.session import ensure_checkpoint_dir
    t = Tables(spark, sf_dir)
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/kestrel-gps-{uuid.uuid4().hex}"
    path = jobs.gps_day(derived.gps_raw(t.events), _pois(spark, sf_dir), "all",
                        f"{base}/enriched", f"{base}/defects")
    return jobs.driver_kpi_report(spark, path, derived.drivers_from_customer(t.customer),
                                  derived.assignments_from_customer(t.customer))


QUERIES: dict[str, Query] = {
    "traffic_table": q_traffic_table,
    "traffic_rows_per_year": q_traffic_rows_per_year,
    "domestic_routes": q_domestic_routes,
    "outwardness": q_outwardness,
    "outwardness_full": q_outwardness_full,
    "key_zone_pivot": q_key_zone_pivot,
    "log_lines": q_log_lines,
    "parse_logs": q_parse_logs,
    "activity_30min": q_activity_30min,
    "activity_hourly": q_activity_hourly,
    "inactivity_gaps": q_inactivity_gaps,
    "incomplete_requests": q_incomplete_requests,
    "component_metrics": q_component_metrics,
    "gps_clean": q_gps_clean,
    "gps_rejects": q_gps_rejects,
    "gps_acceleration": q_gps_acceleration,
    "gps_nearest_poi": q_gps_nearest_poi,
    "gps_enriched": q_gps_enriched,
    "driver_kpis": q_driver_kpis,
    "driver_kpis_from_files": q_driver_kpis_from_files,
    "assign_state": q_assign_state,
    "next_state": q_next_state,
    "lifetime": q_lifetime,
    "lifetime_censored": q_lifetime_censored,
    "fuzzy_match": q_fuzzy_match,
    "fuzzy_match_brand": q_fuzzy_match_brand,
    "fuzzy_name_pairs": q_fuzzy_name_pairs,
    "field_match": q_field_match,
    "phonetic_match": q_phonetic_match,
    "combined_match_and": q_combined_match_and,
    "combined_match_or": q_combined_match_or,
    "stream_enriched": q_stream_enriched,
    "stream_rejects": q_stream_rejects,
    "stream_enriched_batches": q_stream_enriched_batches,
    "stream_messages": q_stream_messages,
    "stream_poi_messages": q_stream_poi_messages,
    "assign_state_operations": q_assign_state_operations,
    "stream_keyed_enriched": q_stream_keyed_enriched,
    "stream_repeated_fixes": q_stream_repeated_fixes,
    "stream_component_metrics": q_stream_component_metrics,
    "stream_activity_30min": q_stream_activity_30min,
    "stream_trips": q_stream_trips,
    "gps_trips": q_gps_trips,
    "gps_odometer": q_gps_odometer,
    "gps_moving_speed": q_gps_moving_speed,
    "driver_at_fix": q_driver_at_fix,
    "speed_rank": q_speed_rank,
    "assign_state_dyadic": q_assign_state_dyadic,
    "metrics_by_day": q_metrics_by_day,
    "metrics_by_day_sketched": q_metrics_by_day_sketched,
    "compound_names": q_compound_names,
}
