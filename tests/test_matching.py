import random

import duckdb
from pyspark.sql import functions as F

from kestrel.functions.text import full_name
from kestrel.operators import matching as mm
from kestrel.plans.oracles import soundex_sql

REPORTS = "nom_emetteur string, prenoms_emetteur string, date_naissance_emetteur string"
CLIENTS = "nom string, prenoms string, date_naissance string"


def _match(spark, reports, clients, threshold=0.7):
    r = spark.createDataFrame(reports, REPORTS).select(
        "*", full_name("prenoms_emetteur", "nom_emetteur").alias("nom_complet_emetteur"),
        F.col("date_naissance_emetteur").alias("dob"))
    c = spark.createDataFrame(clients, CLIENTS).select(
        "*", full_name("prenoms", "nom").alias("nom_complet_client"),
        F.col("date_naissance").alias("dob"))
    return mm.fuzzy_match(r, c, ["dob"], "nom_complet_emetteur", "nom_complet_client", threshold)


def test_abbreviated_first_name_is_kept(spark):
    out = _match(spark, [("Dupont", "Jean", "1980-01-01")], [("Dupont", "J.", "1980-01-01"),
                                                             ("Dupont", "J.", "1980-01-02")]).collect()
    assert len(out) == 1
    assert abs(out[0].score - 8 / 11) < 1e-12 and out[0].date_naissance == "1980-01-01"


def test_empty_names_never_match(spark):
    out = _match(spark, [("", "", "1980-01-01"), (None, None, "1980-01-01")],
                 [("", "", "1980-01-01"), (None, None, "1980-01-01")])
    assert out.count() == 0


def test_soundex_non_ascii_initial(spark):
    r = spark.sql("SELECT soundex('Éloïse') AS a, soundex('Eloise') AS b").first()
    assert (r.a, r.b) == ("Éloïse", "E420")


def test_soundex_sql_equals_spark(spark):
    words = ["Jean Dupont", "Hello", "Ashcraft", "Tymczak", "Pfister", "Honeyman", "Éloïse",
             "Eloise", "", "1abc", "a", "Lloyd-Wright", "O'Hara", "big widget", "Robert", "Rupert",
             "Gutierrez", "Jackson", "wh", "Aaaa", "bcdfg hjk"]
    got = {r.w: r.s for r in spark.createDataFrame([(w,) for w in words], "w string")
           .select("w", F.soundex("w").alias("s")).collect()}
    con = duckdb.connect()
    for w in words:
        sql = soundex_sql("x")
        assert con.execute(f"SELECT {sql} FROM (SELECT ? AS x)", [w]).fetchone()[0] == got[w], w


def _lev(a, b):
    prev = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        cur = [i]
        for j, cb in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
        prev = cur
    return prev[-1]


def test_signature_candidates_are_exact(spark):
    rnd = random.Random(3)
    alphabet = "abcde"
    base = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 14))) for _ in range(60)]
    names = base + ["".join(c if rnd.random() > 0.25 else rnd.choice(alphabet) for c in w)
                    for w in base] + [w[: max(1, len(w) - 2)] for w in base[:20]]
    rows = [(rnd.randint(0, 2), w) for w in names]
    left = spark.createDataFrame(rows, "blk int, a string")
    right = spark.createDataFrame([(b, w + rnd.choice(["", "x"])) for b, w in rows], "blk int, b string")
    lrows, rrows = set(rows), {(r.blk, r.b) for r in right.collect()}
    for t in (0.5, 0.7, 0.85):
        got = {(r.blk, r.a, r.b) for r in
               mm.similar_name_pairs(left, right, ["blk"], "a", "b", t).collect()}
        want = {(bl, a, b) for bl, a in lrows for bl2, b in rrows
                if bl == bl2 and 1 - _lev(a, b) / max(len(a), len(b)) >= t}
        assert got == want, t
    # self match: one orientation + mirror gives the same pairs
    same = spark.createDataFrame(rows, "blk int, b string")
    for t in (0.6, 0.8):
        sym = {(r.blk, r.a, r.b) for r in
               mm.similar_name_pairs(left, same, ["blk"], "a", "b", t, symmetric=True).collect()}
        want = {(bl, a, b) for bl, a in lrows for bl2, b in lrows
                if bl == bl2 and 1 - _lev(a, b) / max(len(a), len(b)) >= t}
        assert sym == want, t


def test_fields_match_in_any_order_of_names(spark):
    from kestrel.operators import matching as mm
    left = spark.createDataFrame([("1980", "Dupont", "Jean"), ("1980", "Dupont", "Jean"), ("1980", "Martin", "Zoe")],
                                 "y string, nom_e string, prenom_e string")
    right = spark.createDataFrame([("1980", "Dupond", "Jean"), ("1980", "Jean", "Dupont"), ("1980", "Marten", "Zoé")],
                                  "y string, nom string, prenom string")
    got = {(r.nom_e, r.prenom_e, r.nom, r.prenom): r for r in mm.field_match(
        left, right, ["y"], [("nom_e", "nom"), ("prenom_e", "prenom")]).collect()}
    assert set(got) == {("Dupont", "Jean", "Dupond", "Jean"), ("Martin", "Zoe", "Marten", "Zoé")}
    r = got["Dupont", "Jean", "Dupond", "Jean"]
    assert r.n_left == 2 and r.n_right == 1 and abs(r.score - (5 / 6 + 1) / 2) < 1e-12


def test_name_pair_groups_do_not_expand_copies(spark):
    from kestrel.operators import matching as mm
    rows = [("B", "same name")] * 50 + [("B", "same nome")] * 30
    a, b = (spark.createDataFrame(rows, f"blk string, {c} string") for c in ("a_name", "b_name"))
    got = {(r.a_name, r.b_name): (r.n_left, r.n_right) for r in mm.name_pair_groups(
        a, b, ["blk"], "a_name", "b_name", symmetric=True).collect()}
    assert len(got) == 4 and got["same name", "same nome"] == (50, 30)
