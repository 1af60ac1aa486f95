import os
import tempfile

from pyspark.sql import functions as F

from kestrel.operators import maintenance as mt
from kestrel.operators import tracking as tk
from kestrel.plans import jobs
from kestrel.plans import params as P
from kestrel.sinks import write_partitioned_parquet
from kestrel.sources import derived
from kestrel.sources.files import read_client_register, read_reports
from kestrel.sources.tables import Tables

from conftest import SMOKE


def _write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_aml_screening_from_csv(spark, tmp_path):
    reports = _write(tmp_path / "signalisations.csv",
                     "nom_emetteur;prenoms_emetteur;date_naissance_emetteur\n"
                     "Dupont;Jean;1980-01-01\nMartin;Éloïse;1990-05-05\nDupond;Jean;1975-03-03\n")
    clients = _write(tmp_path / "referentiel.csv",
                     "nom;prenoms;date_naissance;numero_telephone\n"
                     "Dupont;J.;1980-01-01;33612345678\nMartin;Eloise;1990-05-05;06 12 34 56 78\n"
                     "Durand;Paul;1980-01-01;0612345678\nDupont;Jean;1975-03-03;+33 6 12 34 56 78\n")
    r, c = read_reports(spark, str(reports)), read_client_register(spark, str(clients))
    phones = {x.numero_telephone for x in c.collect()}
    assert phones == {"+33612345678"}
    got = {(x.nom_complet_emetteur, x.nom_complet_client) for x in
           jobs.aml_screening(r, c).collect()}
    assert got == {("Jean Dupont", "J. Dupont"), ("Éloïse Martin", "Eloise Martin"),
                   ("Jean Dupond", "Jean Dupont")}
    both = {(x.nom_complet_emetteur, x.sound_emetteur, x.sound_client)
            for x in jobs.aml_screening(r, c, mode="and").collect()}
    # "J. Dupont" codes J315, not J531; a non-ASCII initial codes as the name itself
    assert both == {("Jean Dupond", "J531", "J531")}
    either = {(x.nom_complet_emetteur, x.nom_complet_client)
              for x in jobs.aml_screening(r, c, mode="or").collect()}
    assert got <= either


def test_gps_day_job_equals_in_memory_chain(spark):
    t = Tables(spark, SMOKE)
    base = tempfile.mkdtemp(prefix="kestrel-gps-")
    pois = derived.pois_from_nation(t.nation)
    path = jobs.gps_day(derived.gps_raw(t.events), pois, "2024-01", f"{base}/enriched",
                        f"{base}/defects")
    stored = spark.read.parquet(path)
    want = tk.enrich(derived.gps_raw(t.events), pois)
    cols = list(tk.ENRICHED_COLUMNS)
    assert sorted(map(tuple, stored.select(*cols).collect())) == sorted(map(tuple, want.collect()))
    defects = spark.read.option("header", True).option("sep", ";").csv(f"{base}/defects/2024-01")
    assert defects.count() + stored.count() == t.events.count()
    kpis = jobs.driver_kpi_report(spark, path, derived.drivers_from_customer(t.customer),
                                  derived.assignments_from_customer(t.customer),
                                  days=["2024-01-02"])
    assert kpis.filter(F.to_date("hour") != "2024-01-02").count() == 0 and kpis.count() > 0


def test_dynamic_partition_overwrite_keeps_other_days(spark):
    out = tempfile.mkdtemp(prefix="kestrel-parts-")
    schema = "day string, v int"
    write_partitioned_parquet(spark.createDataFrame([("a", 1), ("b", 2)], schema), out)
    write_partitioned_parquet(spark.createDataFrame([("a", 9)], schema), out)
    assert sorted(map(tuple, spark.read.parquet(out).select("day", "v").collect())) == [
        ("a", 9), ("b", 2)]


def test_flight_and_log_outputs(spark):
    t = Tables(spark, SMOKE)
    out = tempfile.mkdtemp(prefix="kestrel-out-")
    traffic = derived.traffic_table(t.lineitem, t.orders, t.customer, t.supplier, t.nation)
    paths = jobs.flight_indicators(traffic, P.HOME, P.KEY_ZONES, out)
    freq = spark.read.option("header", True).csv(paths["frequencies"])
    assert freq.columns == ["COUNTRY_NAME", "DEST_FREQUENCY", "ORIGIN_FREQUENCY", "OUTWARDNESS"]
    assert freq.count() > 0
    logs = jobs.log_supervision(derived.log_lines(t.events), os.path.join(out, "logs"))
    assert spark.read.option("header", True).csv(logs["inactivity"]).count() > 0


def test_censor_last_makes_rule_3_reachable(spark):
    iv = spark.createDataFrame(
        [(str(i), "op", "X", d, d, 10 * i) for i, d in enumerate(
            ["2020-01-01", "2020-02-01", "2020-03-01"], 1)],
        "numero_intervention string, code_operation string, id_materiel string, "
        "date_debut_intervention string, date_fin_intervention string, releve_km int") \
        .withColumn("date_debut_intervention", F.col("date_debut_intervention").cast("timestamp_ntz")) \
        .withColumn("date_fin_intervention", F.col("date_fin_intervention").cast("timestamp_ntz"))
    tr = spark.createDataFrame([("X", "RC", "2020-01-10"), ("X", "C", "2020-02-10")],
                               "id_materiel string, etat_organe string, date_echeance string") \
        .withColumn("date_echeance", F.col("date_echeance").cast("timestamp_ntz"))
    order = ("date_debut_intervention", "numero_intervention", "date_echeance", "etat_organe")
    kept = mt.lifetime(mt.assign_state(iv, tr), order).filter("type_individu IS NOT NULL").count()
    cut = mt.lifetime(mt.assign_state(iv, tr, censor_last=True), order) \
        .filter("type_individu IS NOT NULL").collect()
    assert kept == 0
    assert [(r.type_individu, tuple(r.duree_de_vie)) for r in cut] == [("censure_droite", (31, 10))]
