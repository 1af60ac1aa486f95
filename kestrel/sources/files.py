"""Readers for the reference's own file formats (JSON summaries, `;` CSV, log text).

All schemas are explicit: no inference pass over the data, and typed parsing
is done afterwards with ``try_*`` functions. A row with a value that is there
but cannot be parsed is rejected with a reason (``bad_<column>``): readers
return the good rows, or with ``rejects=True`` the rejected ones as they were
read, with ``reject_reason``. A line that is no record of the schema (no JSON,
CSV fields missing or surplus) is rejected as ``bad_record``, its text in
``corrupt_record``. Good and rejected rows together are the lines of the input;
blank lines are none.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TRAFFIC_JSON_SCHEMA = T.StructType([
    T.StructField("ORIGIN_COUNTRY_NAME", T.StringType()),
    T.StructField("DEST_COUNTRY_NAME", T.StringType()),
    T.StructField("count", T.LongType()),
])

# GPS daily report columns, all read as text; normalisation parses them.
GPS_COLUMNS = ("vin", "dt", "lat", "lng", "altitude", "speed", "motion", "power",
               "distance", "engineHours")
POI_COLUMNS = ("name", "lat", "lng", "altitude", "radius")
MAINTENANCE_COLUMNS = ("numero_intervention", "code_operation", "id_materiel",
                       "date_debut_intervention", "date_fin_intervention", "releve_km")
TRACEABILITY_COLUMNS = ("id_materiel", "etat_organe", "date_echeance")

# Fixed value: timestamp text format of the maintenance exports.
MAINTENANCE_TS_FORMAT = "dd/MM/yyyy HH:mm:ss"


def _string_schema(columns: Iterable[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


#: Column that holds a line which does not fit the schema.
CORRUPT = "corrupt_record"


def read_semicolon_csv(spark: SparkSession, path: str | list[str],
                       columns: Iterable[str]) -> DataFrame:
    """`;`-separated CSV with a header, every column as STRING, and ``corrupt_record``."""
    return (spark.read.options(header=True, sep=";", mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)
            .schema(_string_schema([*columns, CORRUPT])).csv(path))


def _parsed(raw: DataFrame, typed: dict[str, Column], rejects: bool) -> DataFrame:
    """Rows of ``raw`` with ``typed`` columns, split by whether the line and all its values could be parsed."""
    reason = F.lit(None).cast("string")
    for c, expr in reversed(typed.items()):
        present = F.col(c).isNotNull() & (F.trim(c) != "")
        reason = F.when(present & expr.isNull(), F.lit(f"bad_{c}")).otherwise(reason)
    reason = F.when(F.col(CORRUPT).isNotNull(), F.lit("bad_record")).otherwise(reason)
    verdict = F.struct(*[typed.get(c, F.col(c)).alias(c) for c in raw.columns],
                       reason.alias("reject_reason"))
    rows = raw.select(F.struct(*raw.columns).alias("_raw"), F.inline(F.array(verdict)))
    if rejects:
        return rows.filter("reject_reason IS NOT NULL").select("_raw.*", "reject_reason")
    return rows.filter("reject_reason IS NULL").drop("_raw", "reject_reason", CORRUPT)


def _try(c: str, kind: str) -> Column:
    return F.expr(f"try_cast({c} AS {kind})")


def _export_time(c: str) -> Column:
    return F.try_to_timestamp(c, F.lit(MAINTENANCE_TS_FORMAT)).cast("timestamp_ntz")


def read_traffic_json(spark: SparkSession, base: str, years: Iterable[int], rejects: bool = False) -> DataFrame:
    """Yearly flight summaries ``{base}/{year}.json`` as one multi-path scan.

    The year is taken from the file name through ``_metadata.file_path``,
    so the six yearly files are one read (one job, one set of tasks), not
    a union of six scans.
    """
    paths = [f"{base.rstrip('/')}/{y}.json" for y in years]
    df = (spark.read.option("columnNameOfCorruptRecord", CORRUPT)
          .schema(T.StructType([*TRAFFIC_JSON_SCHEMA, T.StructField(CORRUPT, T.StringType())])).json(paths))
    year = F.regexp_extract(F.col("_metadata.file_path"), r"(\d{4})\.json$", 1).cast("int")
    return _parsed(df.select("ORIGIN_COUNTRY_NAME", "DEST_COUNTRY_NAME",
                             F.col("count").cast("long").alias("COUNT"), year.alias("YEAR"), CORRUPT), {}, rejects)


def read_gps_day(spark: SparkSession, base: str, day: str, rejects: bool = False) -> DataFrame:
    """One day folder of GPS reports (``{base}/{day}/``), raw text columns."""
    return _parsed(read_semicolon_csv(spark, f"{base.rstrip('/')}/{day}/", GPS_COLUMNS), {}, rejects)


def read_pois(spark: SparkSession, path: str, rejects: bool = False) -> DataFrame:
    raw = read_semicolon_csv(spark, path, POI_COLUMNS)
    return _parsed(raw, {c: _try(c, "double") for c in POI_COLUMNS[1:]}, rejects)


def read_maintenance(spark: SparkSession, path: str, rejects: bool = False) -> DataFrame:
    raw = read_semicolon_csv(spark, path, MAINTENANCE_COLUMNS)
    return _parsed(raw, {"date_debut_intervention": _export_time("date_debut_intervention"),
                         "date_fin_intervention": _export_time("date_fin_intervention"),
                         "releve_km": _try("releve_km", "int")}, rejects)


def read_traceability(spark: SparkSession, path: str, rejects: bool = False) -> DataFrame:
    raw = read_semicolon_csv(spark, path, TRACEABILITY_COLUMNS)
    return _parsed(raw, {"etat_organe": F.trim("etat_organe"),
                         "date_echeance": _export_time("date_echeance")}, rejects)


def read_log_text(spark: SparkSession, path: str) -> DataFrame:
    """Plain log file(s), one line per row in column ``log``."""
    return spark.read.text(path).withColumnRenamed("value", "log")


REPORT_COLUMNS = ("nom_emetteur", "prenoms_emetteur", "date_naissance_emetteur")
CLIENT_COLUMNS = ("nom", "prenoms", "date_naissance", "numero_telephone")


def read_reports(spark: SparkSession, path: str, rejects: bool = False) -> DataFrame:
    """Suspicious-activity reports: issuer surname, first names, birth date."""
    raw = read_semicolon_csv(spark, path, REPORT_COLUMNS)
    return _parsed(raw, {"date_naissance_emetteur": _try("date_naissance_emetteur", "date")}, rejects)


def read_client_register(spark: SparkSession, path: str, rejects: bool = False) -> DataFrame:
    """Client register; phone numbers rewritten to the +33 form."""
    from kestrel.functions.text import french_phone
    raw = read_semicolon_csv(spark, path, CLIENT_COLUMNS)
    return _parsed(raw, {"date_naissance": _try("date_naissance", "date"),
                         "numero_telephone": french_phone("numero_telephone")}, rejects)


def read_drivers(spark: SparkSession, path: str, rejects: bool = False) -> DataFrame:
    return _parsed(read_semicolon_csv(spark, path, ("id", "name")), {}, rejects)


def read_assignments(spark: SparkSession, path: str, rejects: bool = False) -> DataFrame:
    return _parsed(read_semicolon_csv(spark, path, ("driverId", "vehicle")), {}, rejects)
