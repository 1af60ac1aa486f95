"""Reference inputs derived from the driver tables.

The reference reads files that are not shipped (flight summaries, GPS day
reports, maintenance exports, generated logs). Each function here builds the
same shape of input from the driver's TPC-H-like tables with Spark
expressions only, so every query's work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.operators.joins import broadcast_if_bounded

# TPC-H fixes nation at 25 rows whatever the scale; the bound is checked anyway.
NATION_BOUND = 10_000


# ---------------------------------------------------------------- traffic (A)
def traffic_table(lineitem: DataFrame, orders: DataFrame, customer: DataFrame,
                  supplier: DataFrame, nation: DataFrame) -> DataFrame:
    """Flight-summary shape: one row per (origin, destination, year).

    A line item is a "flight" from its supplier's nation to its customer's
    nation in the year of the order. Names are attached to suppliers and
    customers before the fact joins, so a filter on a country reaches those
    small tables and cuts the facts at their first join; the final aggregate
    has at most 25 x 25 x years groups and is partially aggregated map-side.
    """
    names = broadcast_if_bounded(nation.select("n_nationkey", "n_name"), NATION_BOUND)
    origins = (supplier.select("s_suppkey", "s_nationkey")
               .join(names, F.col("s_nationkey") == F.col("n_nationkey"))
               .select("s_suppkey", F.col("n_name").alias("ORIGIN_COUNTRY_NAME")))
    dests = (customer.select("c_custkey", "c_nationkey")
             .join(names, F.col("c_nationkey") == F.col("n_nationkey"))
             .select("c_custkey", F.col("n_name").alias("DEST_COUNTRY_NAME")))
    origin = (lineitem.select("l_orderkey", "l_suppkey")
              .join(origins, F.col("l_suppkey") == F.col("s_suppkey"))
              .select("l_orderkey", "ORIGIN_COUNTRY_NAME"))
    dest = (orders.select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("YEAR"))
            .join(dests, F.col("o_custkey") == F.col("c_custkey"))
            .select("o_orderkey", "YEAR", "DEST_COUNTRY_NAME"))
    return (origin.join(dest, F.col("l_orderkey") == F.col("o_orderkey"))
            .groupBy("ORIGIN_COUNTRY_NAME", "DEST_COUNTRY_NAME", "YEAR")
            .agg(F.count(F.lit(1)).alias("COUNT"))
            .select("ORIGIN_COUNTRY_NAME", "DEST_COUNTRY_NAME", "COUNT", "YEAR"))


# ------------------------------------------------------------------- logs (E)
# Log levels of the line format. The messages are our own.
LOG_LEVELS = ("DEBUG", "INFO", "WARNING", "ERROR")
LOG_MESSAGES = ("cache warmed", "order accepted: forwarding", "disk-1 failed, retry in 5s - see runbook",
                "batch closed (100%)")
# Our mapping of event types to components, and of JSON ``k`` to duration.
COMPONENT_OF_EVENT = {"click": "A", "view": "B", "purchase": "C", "signup": "D", "error": "E"}
INCOMPLETE_BELOW_K = 10  # k < 10 -> request has no end time


def event_k(props: str = "props"):
    """Integer ``k`` of the ``{"k": n}`` JSON props."""
    return F.regexp_extract(F.col(props), r'"k":\s*(\d+)', 1).cast("int")


def event_component(col: str = "event_type"):
    expr = F.lit(None).cast("string")
    for ev, comp in COMPONENT_OF_EVENT.items():
        expr = F.when(F.col(col) == ev, F.lit(comp)).otherwise(expr)
    return expr


def log_lines(events: DataFrame) -> DataFrame:
    """One log line per event: ``start|end - C LEVEL - uuid - message``.

    start = event time; end = start + k minutes, empty when k < 10;
    component from the event type; level from event_id, message from
    user_id; correlation id = md5 of event_id laid out as a UUID.
    """
    from kestrel.functions.timefn import add_minutes, iso_seconds

    events = events.select("event_id", "user_id", "ts", "event_type", event_k().alias("_k"))
    k = F.col("_k")
    start = iso_seconds(F.col("ts"))
    end = F.when(k < INCOMPLETE_BELOW_K, F.lit("")).otherwise(
        iso_seconds(add_minutes(F.col("ts"), k)))
    levels = F.array(*[F.lit(x) for x in LOG_LEVELS])
    messages = F.array(*[F.lit(x) for x in LOG_MESSAGES])
    level = F.element_at(levels, (F.col("event_id") % len(LOG_LEVELS)).cast("int") + 1)
    message = F.element_at(messages, (F.col("user_id") % len(LOG_MESSAGES)).cast("int") + 1)
    uuid = F.regexp_replace(F.md5(F.col("event_id").cast("string")),
                            r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    line = F.concat(start, F.lit("|"), end, F.lit(" - "), event_component(), F.lit(" "),
                    level, F.lit(" - "), uuid, F.lit(" - "), message)
    return events.select(line.alias("log"))


def component_metrics_input(events: DataFrame) -> DataFrame:
    """Metric samples: (timestamp, component, requests_count=1, ram_usage, cpu_usage).

    ram_usage in 10..89 from the event value, cpu_usage in 20..79 from k.
    """
    return events.select(
        F.col("ts").alias("timestamp"), event_component().alias("component"),
        F.lit(1).alias("requests_count"),
        (F.lit(10) + F.floor("value").cast("int") % 80).alias("ram_usage"),
        (F.lit(20) + event_k() % 60).alias("cpu_usage"))


# --------------------------------------------------------------- tracking (C)
def gps_raw(events: DataFrame) -> DataFrame:
    """Daily-report shape, every column as text with decimal commas.

    vin = user_id, dt = event time; v = round(value * 100):
    lat = 48 + k/100, lng = 2 + v/100000, speed = v, power = v/100,
    distance = (v div 50) + 0.5 metres, altitude = engineHours = k,
    motion = "0" for views else "1" (views with speed > 0 are rejects).
    Deterministic junk: k = 0 has no latitude, k = 1 an unparsable speed.
    The text is built from integers, so any engine parses the same numbers.
    """
    # k and v first, in their own projection: each is used several times
    base = events.select("user_id", "ts", "event_type", event_k().alias("_k"),
                         F.round(F.col("value") * 100.0).cast("long").alias("_v"))
    k, v = F.col("_k"), F.col("_v")
    ks, vs = k.cast("string"), v.cast("string")
    return base.select(
        F.col("user_id").cast("string").alias("vin"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("dt"),
        F.when(k == 0, F.lit("")).otherwise(F.concat(F.lit("48,"), F.lpad(ks, 2, "0"))).alias("lat"),
        F.concat(F.lit("2,"), F.lpad(vs, 5, "0")).alias("lng"),
        ks.alias("altitude"),
        F.when(k == 1, F.lit("n/a")).otherwise(vs).alias("speed"),
        F.when(F.col("event_type") == "view", F.lit("0")).otherwise(F.lit("1")).alias("motion"),
        F.concat((v / 100).cast("long").cast("string"), F.lit(","),
                 F.lpad((v % 100).cast("string"), 2, "0")).alias("power"),
        F.concat((v / 50).cast("long").cast("string"), F.lit(",5")).alias("distance"),
        ks.alias("engineHours"))


def pois_from_nation(nation: DataFrame) -> DataFrame:
    """POIs: one per nation at lat 48 + key * 0.04, lng 2.05, radius 1 + region km."""
    return nation.select(F.col("n_name").alias("name"),
                         (F.lit(48.0) + F.col("n_nationkey").cast("double") * F.lit(0.04)).alias("lat"),
                         F.lit(2.05).alias("lng"), F.lit(None).cast("double").alias("altitude"),
                         (F.lit(1) + F.col("n_regionkey")).cast("double").alias("radius"))


def drivers_from_customer(customer: DataFrame) -> DataFrame:
    return customer.select(F.col("c_custkey").cast("string").alias("id"),
                           F.col("c_name").alias("name"))


def assignments_from_customer(customer: DataFrame) -> DataFrame:
    """Vehicle ``c_custkey`` is driven by customer ``c_custkey`` (vin = user_id)."""
    return customer.select(F.col("c_custkey").cast("string").alias("driverId"),
                           F.col("c_custkey").cast("string").alias("vehicle"))


def sign_ons(events: DataFrame) -> DataFrame:
    """Assignments with a beginning: a sign-up puts driver ``event_id mod 97`` on the user's vehicle."""
    return events.filter(F.col("event_type") == "signup").select(
        F.col("user_id").cast("string").alias("vehicle"),
        (F.col("event_id") % 97).cast("string").alias("driverId"), F.col("ts").alias("valid_from"))


def heartbeat(events: DataFrame, days: int = 90) -> DataFrame:
    """One event of a new user, ``days`` after the last one: it closes the windows of a feed that ends."""
    return events.agg((F.max("ts") + F.expr(f"INTERVAL {days} DAYS")).alias("ts"),
                      (F.max("event_id") + 1).alias("event_id"), (F.max("user_id") + 1).alias("user_id")).select(
        "event_id", "ts", "user_id", F.lit("click").alias("event_type"), F.lit(0.0).alias("value"), F.lit('{"k": 50}').alias("props"))


# ------------------------------------------------------------ maintenance (D)
# Fixed mapping of line-item return flags to organ states.
STATE_OF_RETURNFLAG = {"R": "RC", "N": "NC", "A": "C"}


def interventions(orders: DataFrame) -> DataFrame:
    """One intervention per order; the equipment is the customer.

    end = start + (1 + orderkey mod 3) days; km = 40 per day since
    1992-01-01 + orderkey mod 40 (grows with time, no window needed).
    """
    days = (F.lit(1) + F.col("o_orderkey") % 3).cast("int")
    return orders.select(
        F.col("o_orderkey").cast("string").alias("numero_intervention"),
        F.col("o_orderpriority").alias("code_operation"),
        F.col("o_custkey").cast("string").alias("id_materiel"),
        F.col("o_orderdate").alias("date_debut_intervention"),
        (F.col("o_orderdate") + F.make_dt_interval(days, F.lit(0), F.lit(0), F.lit(0)))
        .alias("date_fin_intervention"),
        (F.datediff(F.col("o_orderdate").cast("date"), F.lit("1992-01-01").cast("date")) * 40
         + (F.col("o_orderkey") % 40).cast("int")).alias("releve_km"))


def operations(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Several operations per intervention number: one per line item, all at the order's date."""
    start = F.col("o_orderdate")
    days = (F.lit(1) + F.col("l_linenumber") % 3).cast("int")
    return (lineitem.select("l_orderkey", "l_linenumber")
            .join(orders.select("o_orderkey", "o_custkey", "o_orderdate"),
                  F.col("l_orderkey") == F.col("o_orderkey"))
            .select(F.col("o_orderkey").cast("string").alias("numero_intervention"),
                    F.concat(F.lit("OP"), F.col("l_linenumber").cast("string")).alias("code_operation"),
                    F.col("o_custkey").cast("string").alias("id_materiel"),
                    start.alias("date_debut_intervention"),
                    (start + F.make_dt_interval(days, F.lit(0), F.lit(0), F.lit(0)))
                    .alias("date_fin_intervention"),
                    (F.col("l_linenumber") * 10).cast("int").alias("releve_km")))


def telemetry_messages(events: DataFrame) -> DataFrame:
    """Topic shape: a JSON ``value`` per event; k = 0 has no latitude, k = 1 is no JSON at all."""
    base = events.select("user_id", "ts", event_k().alias("_k"),
                         F.round(F.col("value") * 100.0).cast("long").alias("_v"))
    k, v = F.col("_k"), F.col("_v")
    message = F.to_json(F.struct(
        F.col("user_id").cast("string").alias("vin"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
        F.when(k > 0, F.concat(F.lit("48."), F.lpad(k.cast("string"), 2, "0")).cast("double"))
        .alias("latitude"),
        F.concat(F.lit("2."), F.lpad(v.cast("string"), 5, "0")).cast("double").alias("longitude"),
        v.cast("double").alias("speed"), (k / F.lit(100.0)).alias("fuel_level")))
    return base.select(F.when(k == 1, F.lit("not json")).otherwise(message).alias("value"), "ts")


def traceability(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """One state per line item, due at its ship date, for the order's customer.

    ``trace_id`` (orderkey * 100 + linenumber) is a tie-breaker for ordering.
    """
    state = F.lit(None).cast("string")
    for flag, st in STATE_OF_RETURNFLAG.items():
        state = F.when(F.col("l_returnflag") == flag, F.lit(st)).otherwise(state)
    return (lineitem.select("l_orderkey", "l_linenumber", "l_returnflag", "l_shipdate")
            .join(orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
            .select(F.col("o_custkey").cast("string").alias("id_materiel"), state.alias("etat_organe"),
                    F.col("l_shipdate").alias("date_echeance"),
                    (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("trace_id")))
