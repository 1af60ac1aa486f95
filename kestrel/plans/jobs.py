"""End-to-end batch jobs: read, run the operators, write the reference's outputs.

Each job writes idempotently (overwrite of its own path / partitions) so a
retry after a failure does not duplicate data, and reads its intermediate
outputs back instead of recomputing their lineage.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.functions.text import full_name
from kestrel.operators import logs as lg
from kestrel.operators import maintenance as mt
from kestrel.operators import matching as mm
from kestrel.operators import tracking as tk
from kestrel.operators import traffic as tr
from kestrel.session import materialize, scratch
from kestrel.sinks import write_csv, write_partitioned_parquet, write_quarantine
from kestrel.sources.files import read_maintenance, read_traceability


def flight_indicators(traffic: DataFrame, home: str, countries: Sequence[str],
                      out_dir: str) -> dict:
    """Country shares (sorted by DEST_FREQUENCY) and the key-zone pivot, as CSV."""
    out = out_dir.rstrip("/")
    return {"frequencies": write_csv(tr.outwardness(traffic, home),
                                     f"{out}/flights_frequencies.csv"),
            "key_zones": write_csv(tr.key_zone_pivot(traffic, home, countries),
                                   f"{out}/key_zones_flights.csv")}


def gps_day(raw: DataFrame, pois: DataFrame, day: str, enriched_path: str,
            quarantine_base: str) -> str:
    """Clean one day of GPS reports, quarantine rejects, write the enriched day.

    The cleaned rows feed two outputs, so they are materialized once; the
    enriched rows land in ``enriched_path/day=...`` (dynamic overwrite).
    """
    with scratch(raw.sparkSession):
        cleaned = materialize(tk.clean(tk.normalize(raw)), "gps-cleaned")
        write_quarantine(tk.rejected_rows(cleaned), quarantine_base, day)
        good = tk.good_rows(cleaned)
        enriched = tk.resolve_pois(tk.driving_harshness(tk.compute_acceleration(good)), pois)
        return write_partitioned_parquet(
            enriched.select(*tk.ENRICHED_COLUMNS).withColumn("day", F.to_date("dt")), enriched_path)


def driver_kpi_report(spark: SparkSession, enriched_path: str, drivers: DataFrame,
                      assignments: DataFrame, days: Sequence[str] | None = None,
                      out_path: str | None = None) -> DataFrame:
    """Hourly driver KPIs from the written enriched days (partition-pruned read)."""
    enriched = spark.read.parquet(enriched_path)
    if days:
        enriched = enriched.filter(F.col("day").isin([F.lit(d).cast("date") for d in days]))
    kpis = tk.driver_kpis(enriched, drivers, assignments)
    if out_path:
        write_csv(kpis.orderBy("hour", "driverName"), out_path)
    return kpis


def log_supervision(lines: DataFrame, out_dir: str) -> dict:
    """Parsed logs materialized once, then activity, gaps and open requests as CSV."""
    out = out_dir.rstrip("/")
    with scratch(lines.sparkSession):
        logs = materialize(lg.parse_logs(lines), "parsed-logs")
        return {
            "activity_30min": write_csv(lg.activity(logs, "30 minutes"), f"{out}/activity_30min"),
            "activity_hourly": write_csv(lg.activity(logs, "1 hour"), f"{out}/activity_hourly"),
            "inactivity": write_csv(lg.inactivity_gaps(logs), f"{out}/inactivity"),
            "incomplete": write_csv(lg.incomplete_requests(logs), f"{out}/incomplete"),
            "rejects": write_csv(logs.filter("reject_reason IS NOT NULL"), f"{out}/rejects"),
        }


def maintenance_history(spark: SparkSession, maintenance_path: str, traceability_path: str,
                        out_dir: str, censor_last: bool = False) -> dict:
    """From the two maintenance exports to state, next state and lifetime, as CSV.

    Rows with values that cannot be parsed go to ``rejects`` with their reason.
    The assigned states feed two outputs, so they are materialized once.
    """
    out = out_dir.rstrip("/")
    paths = {}
    for name, reader, path in (("maintenance", read_maintenance, maintenance_path),
                               ("traceability", read_traceability, traceability_path)):
        paths[f"rejects_{name}"] = write_csv(reader(spark, path, rejects=True),
                                             f"{out}/rejects/{name}", sep=";")
    with scratch(spark):
        states = materialize(mt.assign_state(read_maintenance(spark, maintenance_path),
                                             read_traceability(spark, traceability_path),
                                             censor_last=censor_last), "states")
        paths["next_state"] = write_csv(mt.next_state(states), f"{out}/next_state", sep=";")
        paths["lifetime"] = write_csv(mt.lifetime(states, as_struct=False), f"{out}/lifetime", sep=";")
    return paths


def aml_field_screening(reports: DataFrame, clients: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Reports matched to clients field by field: surname, first names, birth date.

    The birth year is the blocking key; the date itself is a field of the score.
    """
    r = reports.select(F.year("date_naissance_emetteur").alias("_year"), "nom_emetteur",
                       "prenoms_emetteur",
                       F.col("date_naissance_emetteur").cast("string").alias("naissance_emetteur"))
    c = clients.select(F.year("date_naissance").alias("_year"), "nom", "prenoms",
                       F.col("date_naissance").cast("string").alias("naissance_client"))
    return mm.field_match(r, c, ["_year"], [("nom_emetteur", "nom"), ("prenoms_emetteur", "prenoms"),
                                            ("naissance_emetteur", "naissance_client")],
                          threshold).drop("_year")


def aml_screening(reports: DataFrame, clients: DataFrame, threshold: float = 0.7,
                  mode: str | None = None) -> DataFrame:
    """Reports matched to clients born the same day whose full names are close.

    ``mode`` None: Levenshtein score only; "and"/"or": combined with Soundex.
    """
    r = reports.select("*", full_name("prenoms_emetteur", "nom_emetteur")
                       .alias("nom_complet_emetteur"),
                       F.col("date_naissance_emetteur").alias("_dob"))
    c = clients.select("*", full_name("prenoms", "nom").alias("nom_complet_client"),
                       F.col("date_naissance").alias("_dob"))
    args = (r, c, ["_dob"], "nom_complet_emetteur", "nom_complet_client", threshold)
    out = (mm.fuzzy_match(*args) if mode is None
           else mm.combined_match(*args, mode=mode))
    cols = ["nom_complet_emetteur", "nom_complet_client", "date_naissance_emetteur",
            "date_naissance", "score"]
    if mode is not None:
        cols += ["sound_emetteur", "sound_client"]
    return out.select(*cols)
