import datetime as dt
import random

from kestrel.operators import maintenance as mt
from kestrel.session import materialize

IV = ("numero_intervention string, code_operation string, id_materiel string, "
      "date_debut_intervention timestamp_ntz, date_fin_intervention timestamp_ntz, releve_km int")
TR = "id_materiel string, etat_organe string, date_echeance timestamp_ntz"


def D(day, month=1, year=2020):
    return dt.datetime(year, month, day)


def _iv(spark, starts):
    return spark.createDataFrame([(str(i), "op", "X", s, s + dt.timedelta(days=1), 100 * i)
                                  for i, s in enumerate(starts, 1)], IV)


def test_overlapping_windows(spark):
    iv = _iv(spark, [D(1), D(11), D(31)])
    tr = spark.createDataFrame([("X", "NC", D(8)), ("X", "RC", D(10))], TR)
    got = sorted((r.numero_intervention, r.etat_organe, r.date_echeance)
                 for r in mt.assign_state(iv, tr).collect())
    assert got == [("1", "NC", D(8)), ("2", "NC", D(8)), ("2", "RC", D(10)), ("3", "TM", None)]


def test_hole_between_windows(spark):
    iv = _iv(spark, [D(1), D(21), D(31)])
    tr = spark.createDataFrame([("X", "NC", D(18))], TR)
    got = sorted((r.numero_intervention, r.etat_organe) for r in mt.assign_state(iv, tr).collect())
    assert got == [("1", "TM"), ("2", "TM"), ("3", "TM")]


def test_long_window_spans_many_buckets(spark):
    iv = _iv(spark, [D(1, 1, 2019), D(1, 1, 2021)])
    tr = spark.createDataFrame([("X", "C", D(3, 6, 2019)), ("X", "RC", D(1, 3, 2020))], TR)
    got = sorted((r.numero_intervention, r.etat_organe) for r in mt.assign_state(iv, tr).collect())
    assert got == [("1", "C"), ("1", "RC"), ("2", "TM")]


def _history(spark, states):
    rows = [("X", st, D(1 + 3 * i), D(2 + 3 * i), 1000 * i, str(i)) for i, st in enumerate(states)]
    return spark.createDataFrame(rows, "id_materiel string, etat_organe string, "
                                 "date_debut_intervention timestamp_ntz, "
                                 "date_fin_intervention timestamp_ntz, releve_km int, "
                                 "numero_intervention string")


ORDER = ("date_debut_intervention", "numero_intervention")


def _life(spark, states):
    out = mt.lifetime(_history(spark, states), ORDER).orderBy("date_debut_intervention").collect()
    marked = [(i, r.type_individu, tuple(r.duree_de_vie)) for i, r in enumerate(out)
              if r.type_individu]
    return marked


def test_lifetime_rules(spark):
    # row i starts on day 1+3i and ends on day 2+3i, km = 1000 i
    assert _life(spark, ["RC", "C", "RC"]) == [(0, "defaillant", (5, 2000))]
    assert _life(spark, ["RC", "C", "C"]) == [(0, "censure_droite", (5, 2000))]
    assert _life(spark, ["RC", "TM", "RC"]) == []
    assert _life(spark, ["NC", "C", "RC"]) == [(0, "censure_gauche", (2, 1000))]
    assert _life(spark, ["NC", "RC"]) == []
    assert _life(spark, ["NC", "C", "TM"]) == [(0, "censure_droite", (2, 1000))]
    assert _life(spark, ["TM", "C", "TM"]) == [(1, "censure", (2, 1000))]
    assert _life(spark, ["NC", "C", "NC"]) == [(1, "censure_gauche", (2, 1000))]
    # C after N does not count (negative durations are impossible)
    assert _life(spark, ["NC", "RC", "C"]) == []


def test_next_state(spark):
    out = mt.next_state(_history(spark, ["C", "C", "NC", "RC"]), ORDER).collect()
    assert {(r.first_element, r.element_trouve, r.next_rc) for r in out} == {("C", "NC", 1)}
    out = mt.next_state(_history(spark, ["RC", "C"]), ORDER).collect()
    assert {(r.first_element, r.element_trouve, r.next_rc) for r in out} == {("RC", None, 0)}


def test_identical_twin_counts_as_a_later_row(spark):
    # The first row appears twice (same date, intervention, everything). As in
    # a row-by-row window, the twin is the next NC, so the C that follows it
    # does not come before the next state and no rule applies.
    rows = [("X", st, D(d), D(d + 1), km, no)
            for st, d, km, no in [("NC", 1, 0, "1"), ("NC", 1, 0, "1"), ("C", 4, 1000, "2"),
                                  ("NC", 7, 2000, "3")]]
    hist = spark.createDataFrame(rows, "id_materiel string, etat_organe string, "
                                 "date_debut_intervention timestamp_ntz, "
                                 "date_fin_intervention timestamp_ntz, releve_km int, "
                                 "numero_intervention string")
    assert mt.lifetime(hist, ORDER).filter("type_individu IS NOT NULL").count() == 0
    out = mt.next_state(hist, ORDER).collect()
    assert {(r.first_element, r.element_trouve, r.next_rc) for r in out} == {("NC", "NC", 0)}


def test_two_operations_under_one_number(spark):
    rows = [("1", "opA", "X", D(1), D(2), 0), ("1", "opB", "X", D(1), D(3), 0), ("2", "op", "X", D(11), D(12), 5)]
    iv = spark.createDataFrame(rows, IV)
    tr = spark.createDataFrame([("X", "RC", D(5))], TR)
    got = sorted((r.numero_intervention, r.code_operation, r.etat_organe) for r in mt.assign_state(iv, tr).collect())
    assert got == [("1", "opA", "TM"), ("1", "opB", "RC"), ("2", "op", "TM")]


def test_null_number_is_matched_once(spark):
    rows = [(None, "op", "X", D(1), D(2), 0), ("2", "op", "X", D(11), D(12), 5)]
    tr = spark.createDataFrame([("X", "RC", D(5))], TR)
    got = sorted((str(r.numero_intervention), r.etat_organe)
                 for r in mt.assign_state(spark.createDataFrame(rows, IV), tr).collect())
    assert got == [("2", "TM"), ("None", "RC")]


def test_history_job_from_files(spark, tmp_path):
    from kestrel.plans import jobs
    (tmp_path / "m.csv").write_text(
        "numero_intervention;code_operation;id_materiel;date_debut_intervention;date_fin_intervention;releve_km\n"
        "1;A;X;01/01/2020 00:00:00;02/01/2020 00:00:00;100\n2;A;X;11/01/2020 00:00:00;12/01/2020 00:00:00;200\n"
        "3;A;X;21/01/2020 00:00:00;22/01/2020 00:00:00;300\n4;A;X;2020-02-01;;400\n")
    (tmp_path / "t.csv").write_text(
        "id_materiel;etat_organe;date_echeance\nX; RC ;05/01/2020 00:00:00\nX;NC;15/01/2020 00:00:00\nX;C;soon\n")
    out = jobs.maintenance_history(spark, str(tmp_path / "m.csv"), str(tmp_path / "t.csv"), str(tmp_path / "out"))

    def rows(name):
        return spark.read.options(header=True, sep=";").csv(out[name]).collect()

    assert [(r.numero_intervention, r.reject_reason) for r in rows("rejects_maintenance")] == [
        ("4", "bad_date_debut_intervention")]
    assert [(r.date_echeance, r.reject_reason) for r in rows("rejects_traceability")] == [("soon", "bad_date_echeance")]
    marked = [(r.numero_intervention, r.type_individu, r.duree_vie_jour, r.duree_vie_km)
              for r in rows("lifetime") if r.type_individu]
    assert marked == [("1", "defaillant", "9", "100")]
    assert {(r.first_element, r.element_trouve) for r in rows("next_state")} == {("RC", "NC")}


def test_sparse_and_dense_ids_give_the_same_rows(spark):
    rnd = random.Random(12)
    # id A is dense above three rows, B is not; several operations at one start, NULL ids, dates and numbers, twins
    rows = [(str(i // 2) if i % 7 else None, f"op{i % 2}", "A", D(1) + dt.timedelta(days=40 * (i // 2)),
             D(2) + dt.timedelta(days=40 * (i // 2)), i) for i in range(16)]
    rows += [("90", "op", "B", D(1), D(2), 1), ("91", "op", "B", D(1, 6), D(2, 6), 2), ("92", "op", "C", D(1), D(2), 3)]
    rows += [("93", "op", None, D(1), D(2), 4), ("94", "op", None, D(9), D(9), 5), ("95", "op", "B", None, D(2), 6)]
    rows += [rows[3], rows[16]]
    states = [("A", rnd.choice(["RC", "NC", "C", None]), D(1) + dt.timedelta(days=rnd.randint(-30, 400)))
              for _ in range(40)]
    states += [("B", "C", D(3, 3)), ("B", "C", D(3, 3)), ("B", "RC", None), (None, "RC", D(5)), ("C", "NC", D(5)),
               ("D", "NC", D(5))]
    iv, tr = spark.createDataFrame(rows, IV), spark.createDataFrame(states, TR)

    def key(r):
        return tuple((x is not None, str(x)) for x in r)

    for censor_last in (False, True):
        want = []
        for ident in ("A", "B", "C", None):
            # NULLs come first in the order
            mine = sorted((r for r in rows if r[2] == ident), key=lambda r: key((r[3], r[0], r[1])) + (r[4], r[5]))
            for a, b in zip(mine, mine[1:] + [None]):
                nxt = b and b[3]
                # a row without a date is in no bucket and has no neighbour
                known = a[3] is not None and nxt is not None
                delta = (nxt - a[3]) * 0.2 if known else None
                hits = [s for s in states if known and ident is not None and s[0] == ident and s[2] is not None
                        and a[3] - delta < s[2] <= nxt - delta]
                if hits or nxt is not None and a[3] is not None or not censor_last:
                    want += [(*a, s[1] or "TM", s[2]) for s in hits] or [(*a, "TM", None)]
        for options in ({}, {"dense_rows": 3}, {"dense_rows": 0}, {"cover": "dyadic"}):
            got = [(r.numero_intervention, r.code_operation, r.id_materiel, r.date_debut_intervention,
                    r.date_fin_intervention, r.releve_km, r.etat_organe, r.date_echeance)
                   for r in mt.assign_state(iv, tr, censor_last=censor_last, **options).collect()]
            assert sorted(got, key=key) == sorted(want, key=key), (censor_last, options)


def test_long_windows_of_a_sparse_id_are_shuffled_once(spark, monkeypatch):
    plans = []

    def noted(df, *args, **kwargs):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return materialize(df, *args, **kwargs)

    monkeypatch.setattr(mt, "materialize", noted)
    iv = _iv(spark, [D(1, 1, 1950), D(1, 1, 2021), D(1, 1, 2021)])
    tr = spark.createDataFrame([("X", "C", D(3, 6, 1990))], TR)
    out = mt.assign_state(iv, tr)
    plans.append(out._jdf.queryExecution().optimizedPlan().toString())
    assert not [p for p in plans if "explode" in p]
    assert sorted((r.numero_intervention, r.etat_organe) for r in out.collect()) == [("1", "C"), ("2", "TM"), ("3", "TM")]
