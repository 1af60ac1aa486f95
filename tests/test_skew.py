"""Hot keys: results stay exact when one key holds most rows."""

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from kestrel.operators import maintenance as mt
from kestrel.operators import matching as mm
from kestrel.operators.sequence import with_neighbours


def test_hot_key_neighbours_equal_plain_window(spark):
    rnd = random.Random(11)
    t0 = dt.datetime(2024, 1, 1)
    rows = [("HOT", t0 + dt.timedelta(seconds=rnd.randint(0, 30 * 86400)), float(i)) for i in range(3000)]
    rows += [(f"K{i % 7}", t0 + dt.timedelta(seconds=rnd.randint(0, 30 * 86400)), float(i))
             for i in range(300)]
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz, v double")
    b = F.floor(F.unix_timestamp("t") / 3600)
    ours = with_neighbours(df, ["k"], ["t", "v"], b, prev=["v"], next=["v"])
    plan = ours._jdf.queryExecution().executedPlan().toString()
    assert "_bk" in plan  # windows are partitioned by (key, bucket), not by key alone
    w = Window.partitionBy("k").orderBy("t", "v")
    plain = df.select("k", "t", "v", F.lag("v").over(w).alias("p"), F.lead("v").over(w).alias("n"))
    got = sorted((r.k, r.t, r.v, r.prev_v, r.next_v) for r in ours.collect())
    want = sorted((r.k, r.t, r.v, r.p, r.n) for r in plain.collect())
    assert got == want


def test_hot_equipment_interval_join_matches_brute_force(spark):
    rnd = random.Random(5)
    d0 = dt.datetime(2020, 1, 1)
    starts = sorted({d0 + dt.timedelta(days=rnd.randint(0, 900)) for _ in range(120)})
    iv_rows = [(str(i), "op", "HOT", s, s + dt.timedelta(days=1), i) for i, s in enumerate(starts)]
    iv_rows += [("c1", "op", "COLD", d0, d0, 0), ("c2", "op", "COLD", d0 + dt.timedelta(days=50),
                                                   d0 + dt.timedelta(days=51), 1)]
    tr_rows = [("HOT", rnd.choice(["RC", "NC", "C"]), d0 + dt.timedelta(days=rnd.randint(0, 950)))
               for _ in range(600)] + [("COLD", "C", d0 + dt.timedelta(days=20))]
    iv = spark.createDataFrame(iv_rows, "numero_intervention string, code_operation string, "
                               "id_materiel string, date_debut_intervention timestamp_ntz, "
                               "date_fin_intervention timestamp_ntz, releve_km int")
    tr = spark.createDataFrame(tr_rows, "id_materiel string, etat_organe string, "
                               "date_echeance timestamp_ntz")
    got = sorted((r.numero_intervention, r.etat_organe, r.date_echeance)
                 for r in mt.assign_state(iv, tr, bucket_days=7).collect())
    want = []
    for ident in ("HOT", "COLD"):
        mine = sorted((r for r in iv_rows if r[2] == ident), key=lambda r: (r[3], r[0]))
        for a, b in zip(mine, mine[1:] + [None]):
            hits = []
            if b is not None:
                delta = (b[3] - a[3]) * 0.2
                hits = [(a[0], st, due) for who, st, due in tr_rows
                        if who == ident and a[3] - delta < due <= b[3] - delta]
            want += hits or [(a[0], "TM", None)]
    assert got == sorted(want, key=lambda x: (x[0], x[1], x[2] or d0))


def test_hot_copy_group_gives_every_pair(spark):
    n = 60
    rows = [("B", i, "same name") for i in range(n)] + [("B", 100 + i, "other thing") for i in range(5)]
    a = spark.createDataFrame(rows, "blk string, a_key int, a_name string")
    b = spark.createDataFrame(rows, "blk string, b_key int, b_name string")
    out = mm.fuzzy_match(a, b, ["blk"], "a_name", "b_name", 0.7,
                         pair_filter=F.col("a_key") < F.col("b_key"), symmetric=True)
    assert out.count() == n * (n - 1) // 2 + 5 * 4 // 2


def test_hot_id_history_salted_join_equals_broadcast(spark, monkeypatch):
    # One equipment holds most rows, with many same-day ties. Forcing the
    # salted join (bound 0) must give exactly the broadcast join's answer.
    rnd = random.Random(5)
    states = ["RC", "NC", "C", "TM"]
    rows = []
    for k in range(1500):
        eq = "HOT" if k < 1200 else f"E{k % 40}"
        day = dt.datetime(2020, 1, 1) + dt.timedelta(days=rnd.randint(0, 60))
        rows.append((eq, rnd.choice(states), day, day + dt.timedelta(days=1),
                     rnd.randint(0, 9000), str(rnd.randint(1, 5))))
    hist = spark.createDataFrame(rows, "id_materiel string, etat_organe string, "
                                 "date_debut_intervention timestamp_ntz, "
                                 "date_fin_intervention timestamp_ntz, releve_km int, "
                                 "numero_intervention string")
    order = ("date_debut_intervention", "numero_intervention", "etat_organe", "releve_km")

    def answers():
        life = sorted(map(tuple, mt.lifetime(hist, order, as_struct=False).collect()), key=repr)
        nxt = sorted(map(tuple, mt.next_state(hist, order).collect()), key=repr)
        return life, nxt

    broadcast = answers()
    monkeypatch.setattr(mt, "HISTORY_BROADCAST_ROWS", 0)
    salted = answers()
    assert salted == broadcast
    assert any(r[-1] is not None for r in broadcast[0])  # some rule fired


def test_pairs_of_a_hot_name_are_dealt_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(mm, "LIST_ROWS", 8)
    monkeypatch.setattr(mm, "PAIRS_PER_TASK", 500)
    rows = [("B", i, "same name") for i in range(100)] + [("B", None, "same nome"), (None, 1, "same name"), ("B", 2, None)]
    a = spark.createDataFrame(rows, "blk string, a_key int, a_name string")
    b = spark.createDataFrame(rows, "blk string, b_key int, b_name string")
    out = mm.fuzzy_match(a, b, ["blk"], "a_name", "b_name", 0.7, symmetric=True)
    tasks = [r.n for r in out.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(tasks) == 101 * 101 and len(tasks) > 3
    assert max(tasks) < 101 * 101 // 2


def test_fields_that_both_match_give_a_pair_once(spark):
    left = spark.createDataFrame([("b", "same name", "kind"), ("b", "same name", "kind"), ("b", "other", "kind")],
                                 "k string, a string, at string")
    right = spark.createDataFrame([("b", "same nome", "kind"), ("b", "other", None)], "k string, b string, bt string")
    out = mm.field_match(left, right, ["k"], [("a", "b"), ("at", "bt")])
    assert sorted((r.a, r.b, r.n_left) for r in out.collect()) == [("same name", "same nome", 2)]
    # no row of a pair is kept to compare it with the others
    assert "deduplicate" not in out._jdf.queryExecution().optimizedPlan().toString().lower()


def test_facts_of_a_history_do_not_repeat_its_rows(spark, monkeypatch):
    monkeypatch.setattr(mt, "HISTORY_BROADCAST_ROWS", 0)
    d = dt.datetime(2020, 1, 1)
    hist = spark.createDataFrame(
        [("E", s, d + dt.timedelta(days=i), d + dt.timedelta(days=i + 1), i, str(i)) for i, s in
         enumerate(["RC", "C", "RC"])] + [(None, "RC", d, d, 0, "9")],
        "id_materiel string, etat_organe string, date_debut_intervention timestamp_ntz, "
        "date_fin_intervention timestamp_ntz, releve_km int, numero_intervention string")
    order = ("date_debut_intervention", "numero_intervention", "etat_organe", "releve_km")
    stored = []
    real = mt.materialize
    monkeypatch.setattr(mt, "materialize", lambda df, label="stage", **k: stored.append((label, df.columns)) or real(df, label, **k))
    out = mt.lifetime(hist, order, as_struct=False)
    assert sorted((r.id_materiel, r.releve_km, r.duree_vie_jour, r.type_individu) for r in out.collect()) == [
        ("E", 0, 1, "defaillant"), ("E", 1, None, None), ("E", 2, None, None)]
    # a row is stored once, and the result is found by its number, without the 16 salts of an id
    assert dict(stored)["history"] == [*hist.columns, "_seq"]
    assert "_salt" not in out._jdf.queryExecution().optimizedPlan().toString()


def _one_hot_history(spark):
    """1200 rows of one id, ten of each of 30 others, two of none."""
    rnd = random.Random(8)
    ids = ["HOT"] * 1200 + [f"E{i % 30}" for i in range(300)] + [None] * 2
    days = [dt.datetime(2020, 1, 1) + dt.timedelta(days=rnd.randint(0, 60)) for _ in ids]
    return spark.createDataFrame(
        [(i, rnd.choice(["RC", "NC", "C", "TM", None]), d, d + dt.timedelta(days=1), rnd.randint(0, 9000), str(rnd.randint(1, 5)))
         for i, d in zip(ids, days)],
        "id_materiel string, etat_organe string, date_debut_intervention timestamp_ntz, "
        "date_fin_intervention timestamp_ntz, releve_km int, numero_intervention string")


def test_facts_of_many_ids_are_neither_broadcast_nor_repeated(spark, monkeypatch):
    # their files are small, so the planner alone would broadcast them, 16 rows per id before
    hist = _one_hot_history(spark)
    order = ("date_debut_intervention", "numero_intervention", "etat_organe", "releve_km")
    want = sorted(map(tuple, mt.next_state(hist, order).collect()), key=repr)
    monkeypatch.setattr(mt, "HISTORY_BROADCAST_ROWS", 20)
    plans = []
    real = mt.materialize

    def noted(df, label="stage", **k):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, label, **k)

    monkeypatch.setattr(mt, "materialize", noted)
    out = mt.next_state(hist, order)
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    assert sorted(map(tuple, out.collect()), key=repr) == want
    assert len(want) == 1500
    assert not any("_salt" in p for p in plans)
    # of the two joins with one row per id neither is a broadcast; the others read both sides' aggregates
    assert "SortMergeJoin" in plans[-1] and "Broadcast" not in plans[-1]
    assert any("LeftAnti" in p and "BroadcastHashJoin [_seq" not in p for p in plans)


def test_only_a_hot_id_is_salted(spark, monkeypatch):
    hist = _one_hot_history(spark)
    order = ("date_debut_intervention", "numero_intervention", "etat_organe", "releve_km")
    want = sorted(map(tuple, mt.next_state(hist, order).collect()), key=repr)
    monkeypatch.setattr(mt, "HISTORY_BROADCAST_ROWS", 20)
    monkeypatch.setattr(mt, "HISTORY_HOT_ROWS", 100)
    spread = []
    real = mt._join_per_id

    def noted(r, per_id):
        out = real(r, per_id)
        spread.append(out)
        return out

    monkeypatch.setattr(mt, "_join_per_id", noted)
    assert sorted(map(tuple, mt.next_state(hist, order).collect()), key=repr) == want
    plan = spread[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan and "explode" in plan
    # twelve salts of the hot id fall on several of the eight tasks
    monkeypatch.setattr(mt, "_join_per_id", real)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        tasks = [r.n for r in spread[0].filter("id_materiel = 'HOT'").groupBy(F.spark_partition_id()).agg(
            F.count("*").alias("n")).collect()]
    finally:
        spark.conf.set(key, before)
    assert sum(tasks) == 1200 and len(tasks) > 3 and max(tasks) < 600


def test_lists_meet_by_blocks(spark, monkeypatch):
    # all that one row gives is kept until it is complete: it must be two blocks, not two lists
    monkeypatch.setattr(mm, "LIST_ROWS", 16)
    monkeypatch.setattr(mm, "BLOCK_ROWS", 4)
    lrows = [("B", "same name", i if i % 5 else None) for i in range(37)] + [("B", "other", 1), (None, "same name", 2)]
    rrows = [("B", "same nome", i if i % 7 else None, f"x{i}") for i in range(21)] + [("B", None, 1, "y")]
    left = spark.createDataFrame(lrows, "blk string, a_name string, a_key int")
    right = spark.createDataFrame(rrows, "blk string, b_name string, b_key int, b_text string")
    out = mm.fuzzy_match(left, right, ["blk"], "a_name", "b_name", 0.7)
    got = sorted(((r.a_name, r.a_key, r.b_name, r.b_key, r.b_text) for r in out.collect()), key=repr)
    assert got == sorted(((a[1], a[2], *b[1:]) for a in lrows for b in rrows
                          if a[0] == b[0] and a[1] == "same name" and b[1] is not None), key=repr)
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    cuts = [line for line in plan.splitlines() if "Generate explode(transform(sequence(" in line]
    assert len(cuts) == 2 and not any("*(" in line for line in cuts)  # outside the compiled loops
    # rows without other columns
    alone = mm.fuzzy_match(left.drop("a_key"), right.select("blk", "b_name"), ["blk"], "a_name", "b_name", 0.7)
    assert alone.columns == ["blk", "b_name", "a_name", "score"] and alone.count() == 37 * 21
