"""Domain D: equipment maintenance history and lifetime classes.

interventions: id_materiel, numero_intervention, code_operation,
               date_debut_intervention, date_fin_intervention, releve_km
traceability : id_materiel, etat_organe (RC / NC / C), date_echeance [, tie-breakers]
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.operators.intervals import points_in_intervals
from kestrel.operators.joins import has_at_most
from kestrel.operators.sequence import with_next
from kestrel.session import materialize

ID = "id_materiel"
START, END, KM = "date_debut_intervention", "date_fin_intervention", "releve_km"
STATE, DUE = "etat_organe", "date_echeance"
STATE_COLUMNS = (ID, STATE, START, END, KM)
# Organ states and the "no match" fill.
RC, NC, C, TM = "RC", "NC", "C", "TM"

# Lifetime rules as data: (rule, first state F, next state N, class,
# duration from, duration to, row carrying the result). "first" = the
# first row of the history, "next" = first RC/NC/TM after it, "first_c" /
# "last_c" = first / last C after the first row. Rules 4-9 need a C before
# N; rule 3 (no N) needs any C.
LIFETIME_RULES = (
    (1, RC, RC, "defaillant", "first", "next", "first"),
    (2, RC, NC, "defaillant", "first", "next", "first"),
    (3, RC, None, "censure_droite", "first", "last_c", "first"),
    (4, NC, RC, "censure_gauche", "first_c", "next", "first"),
    (5, NC, NC, "censure_gauche", "first_c", "next", "first_c"),
    (6, NC, TM, "censure_droite", "first_c", "next", "first"),
    (7, TM, RC, "censure_gauche", "first_c", "next", "first_c"),
    (8, TM, NC, "censure_gauche", "first_c", "next", "first_c"),
    (9, TM, TM, "censure", "first_c", "next", "first_c"),
)


def _bucket(ts: Column | str, width_s: int) -> Column:
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.floor(F.unix_timestamp(ts) / width_s)


# Windows and states of one id are compared in one task up to this many rows of either; an id with
# more of them goes by time buckets.
DENSE_ROWS = 1000


def _dense_ids(interventions: DataFrame, states: DataFrame, most: int) -> DataFrame | None:
    """Ids with more than ``most`` rows on either side, None if there are none."""
    counts = [df.filter(F.col(c).isNotNull()).groupBy(F.col(c).alias(ID)).count().filter(F.col("count") > most)
              for df, c in ((interventions, ID), (states, "_tid"))]
    dense = materialize(counts[0].unionByName(counts[1]).select(ID).distinct(), "dense-ids")
    return None if has_at_most(dense, 0) else dense


def assign_state(interventions: DataFrame, traceability: DataFrame, tolerance: float = 0.2,
                 fill: str = TM, bucket_days: int = 30,
                 order: Sequence[str] = (START, "numero_intervention"),
                 censor_last: bool = False, cover: str = "buckets",
                 dense_rows: int = DENSE_ROWS) -> DataFrame:
    """Attach each traceability row to the interventions whose tolerance window holds it.

    window of an intervention = (start - d, next_start - d], d = tolerance x
    (next_start - start); the last intervention of an id has no window.
    Interventions with no match get one row with state ``fill`` -- except,
    with ``censor_last``, an id's last intervention, whose synthetic fill
    would otherwise end every history (and hide "no state follows" cases). Windows
    may overlap or leave holes (each uses its own d), so a row can match
    two interventions or none.

    Range join without a per-id nested loop over a busy id. An id with at most
    ``dense_rows`` interventions and as many states is left-joined on the id
    alone, with the range as a residual: each of its windows is shuffled once,
    however long it is. The windows of a dense id (found by counting) are
    exploded over the ``bucket_days`` time buckets they cover and
    inner-joined to the traceability rows on (id, bucket), so
    it is spread over its buckets and AQE may split a hot (id, bucket)
    on either side; so many rows make short windows, that cover few buckets.
    A window that ends where it begins (several operations
    at one start) holds nothing and is not joined at all.
    With ``cover="dyadic"`` every window is covered by blocks of
    days sized by its length (``intervals.points_in_intervals``): rows per window
    are bounded, and a dense month is no bucket, for
    one look-up of each traceability row per block size. Every intervention row gets an id of its own, stored with
    its neighbour: it ends the order (several operations may share a number
    and a start, and numbers may be NULL) and tells which rows had a match.
    The matches of buckets and blocks are materialized once, because rows with
    no match come from a left-anti join against them.
    """
    width = bucket_days * 86400
    rest = [c for c in interventions.columns if c != ID and c not in order]
    iv = with_next(interventions.withColumn("_rid", F.monotonically_increasing_id()), [ID],
                   [*order, *rest, "_rid"], [START], _bucket(START, width), prefix="next_")
    nxt = F.col("next_" + START)
    delta = (nxt - F.col(START)) * F.lit(tolerance)
    bounds = iv.withColumns({"_lo": F.col(START) - delta, "_hi": nxt - delta})
    # NULL bounds count as no window; one condition, so that both sides of the split read the same exchange
    holds = F.coalesce(F.col(ID).isNotNull() & (F.col("_lo") < F.col("_hi")), F.lit(False))
    win = bounds.filter(holds)
    tr = traceability.withColumnRenamed(ID, "_tid")
    trace_cols = [c for c in traceability.columns if c != ID]
    inside = (F.col(DUE) > F.col("_lo")) & (F.col(DUE) <= F.col("_hi"))

    def unmatched(rows):
        rows = rows.filter(nxt.isNotNull()) if censor_last else rows
        return rows.select(*interventions.columns, *[F.lit(None).cast(traceability.schema[c].dataType).alias(c)
                                                     for c in trace_cols])

    def matched_or_not(pairs, rows):
        matched = materialize(pairs.select("_rid", *interventions.columns, *trace_cols), "interval-matches")
        without = rows.join(matched.select("_rid").distinct(), "_rid", "left_anti")
        return matched.drop("_rid").unionByName(unmatched(without))

    if cover == "dyadic":
        pairs = points_in_intervals(win, tr, ID, "_tid", _bucket("_lo", 86400), _bucket("_hi", 86400),
                                    _bucket(DUE, 86400), inside)
        out = matched_or_not(pairs, iv)
    elif cover == "buckets":
        tr = materialize(tr.filter(F.col("_tid").isNotNull() & F.col(DUE).isNotNull()), "states")
        dense = _dense_ids(iv, tr, dense_rows)
        out = unmatched(bounds.filter(~holds))
        sparse, sparse_tr = win, tr
        if dense is not None:
            dense_tr = dense.withColumnRenamed(ID, "_tid")
            sparse, sparse_tr = win.join(dense, ID, "left_anti"), tr.join(dense_tr, "_tid", "left_anti")
            win, tr = win.join(dense, ID, "left_semi"), tr.join(dense_tr, "_tid", "left_semi")
            pieces = win.withColumn("_b", F.explode(F.sequence(_bucket("_lo", width), _bucket("_hi", width))))
            pairs = pieces.join(tr.withColumn("_tb", _bucket(DUE, width)),
                                (F.col(ID) == F.col("_tid")) & (F.col("_b") == F.col("_tb")) & inside)
            out = out.unionByName(matched_or_not(pairs, win))
        out = out.unionByName(sparse.join(sparse_tr, (F.col(ID) == F.col("_tid")) & inside, "left")
                              .select(*interventions.columns, *trace_cols))
    else:
        raise ValueError("cover must be 'buckets' or 'dyadic'")
    return out.fillna({STATE: fill})


# Joining history rows to one-row-per-id facts: broadcast the facts up to this
# many ids; above it the join shuffles, and an id with more than
# HISTORY_HOT_ROWS rows is spread over tasks of so many.
HISTORY_BROADCAST_ROWS = 200_000
HISTORY_HOT_ROWS = 1_000_000


def _small_or_merged(df: DataFrame) -> DataFrame:
    """A stored side of a join: broadcast up to ``HISTORY_BROADCAST_ROWS`` rows, above it never.

    Unhinted, the planner goes by the size of the files, and a few megabytes of
    well packed rows are hundreds in the driver.
    """
    return F.broadcast(df) if has_at_most(df, HISTORY_BROADCAST_ROWS) else df.hint("merge")


def _join_per_id(r: DataFrame, per_id: DataFrame) -> DataFrame:
    """``r`` (many rows per id, with ``_seq``) joined to the stored ``per_id`` (one row per id, ``_rows`` of it in ``r``).

    A plain shuffle join would put all rows of a hot id in one task, and AQE
    does not split it when an aggregate by id follows. Few facts are broadcast,
    with no shuffle of ``r``. Otherwise the rows of a hot id get a salt from
    their fixed sequence id and its facts are repeated once per salt; the other
    ids have one row of facts each. At most ``HISTORY_BROADCAST_ROWS`` ids can have more
    than that part of all rows, so the list of the hot ones can be broadcast.
    """
    if has_at_most(per_id, HISTORY_BROADCAST_ROWS):
        return r.join(F.broadcast(per_id.drop("_rows")), ID)
    hot_rows = max(HISTORY_HOT_ROWS, r.count() // max(HISTORY_BROADCAST_ROWS, 1))
    salts = F.ceil(F.col("_rows") / hot_rows).cast("int")
    hot = per_id.filter(F.col("_rows") > hot_rows).select(ID, salts.alias("_salts"))
    if has_at_most(hot, 0):
        return r.join(per_id.drop("_rows").hint("merge"), ID)
    salt = F.pmod(F.xxhash64("_seq"), F.coalesce("_salts", F.lit(1))).cast("int")
    spread = per_id.withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_rows")
    return (r.join(F.broadcast(hot), ID, "left").withColumn("_salt", salt).drop("_salts")
            .join(spread.hint("merge"), [ID, "_salt"]).drop("_salt"))


def _history_facts(rows: DataFrame, order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Per-id facts about an ordered state history, skew-safe.

    Two partially-aggregated passes instead of a window over the whole id:
    (1) the first row in a total order, (2) among rows after it: first RC/NC/TM (``next``),
    first and last C, any RC. Returns (facts per id, with its number of ``_rows``, and the stored rows).
    """
    # The last field breaks exact ties: an identical twin of the first row
    # still counts as a later row, as in a row-by-row window. The ids are
    # fixed by the write, so recomputing a consumer never changes them.
    r = materialize(rows.withColumn("_seq", F.monotonically_increasing_id()), "history")
    o = F.struct(*order, "_seq")
    row = F.struct(o.alias("o"), *[c for c in (STATE, START, END, KM) if c not in order])
    known = r.filter(F.col(ID).isNotNull())
    first = materialize(known.groupBy(ID).agg(F.min(row).alias("f"), F.count(F.lit(1)).alias("_rows")), "history-first")
    # the first row is left out by its number: no id is hot there, and nothing is repeated
    after = (known.join(_small_or_merged(first.select(F.col("f.o._seq").alias("_first"))),
                        F.col("_seq") == F.col("_first"), "left_anti")
             .groupBy(ID).agg(
                 F.min(F.when(F.col(STATE).isin(RC, NC, TM), row)).alias("n"),
                 F.min(F.when(F.col(STATE) == C, row)).alias("c1"),
                 F.max(F.when(F.col(STATE) == C, row)).alias("cl"),
                 F.max(F.when(F.col(STATE) == RC, 1).otherwise(0)).alias("next_rc")))
    # a struct of each row: its order, and the columns that are not part of it
    facts = first.join(after, ID, "left").withColumn("next_rc", F.coalesce("next_rc", F.lit(0)))
    for which in ("f", "n", "c1", "cl"):
        facts = facts.withColumn(which, F.when(F.col(which).isNotNull(), F.struct(
            F.col(f"{which}.o").alias("o"), *[F.col(f"{which}.o.{c}" if c in order else f"{which}.{c}").alias(c)
                                              for c in (STATE, START, END, KM)])))
    return facts, r


def next_state(rows: DataFrame, order: Sequence[str] = (START, "numero_intervention", DUE,
                                                          STATE)) -> DataFrame:
    """Per row: first_element (first state of the id's history), element_trouve
    (first RC/NC/TM after it, NULL if none) and next_rc (1 if an RC follows)."""
    facts, r = _history_facts(rows, order)
    facts = materialize(facts.select(ID, F.col(f"f.{STATE}").alias("first_element"),
                                     F.col(f"n.{STATE}").alias("element_trouve"),
                                     F.col("next_rc").cast("int").alias("next_rc"), "_rows"), "history-facts")
    return _join_per_id(r, facts).select(*rows.columns, "first_element", "element_trouve", "next_rc")


def lifetime(rows: DataFrame, order: Sequence[str] = (START, "numero_intervention", DUE, STATE),
             as_struct: bool = True) -> DataFrame:
    """Lifetime class and duration (days, km) of each id, on the row the rule names.

    duration = (start of the "to" row) - (end of the "from" row) in calendar
    days, and the difference of their km readings; other rows get NULLs.
    """
    facts, r = _history_facts(rows, order)
    f, n = F.col(f"f.{STATE}"), F.col(f"n.{STATE}")
    c_before_n = F.col("c1").isNotNull() & (F.col("c1.o") < F.col("n.o"))
    rule = F.lit(None).cast("int")
    for no, fs, ns, *_ in reversed(LIFETIME_RULES):
        cond = (f == fs) & (n == ns if ns else F.col("n").isNull())
        if no == 3:
            cond = cond & F.col("c1").isNotNull()
        elif no > 3:
            cond = cond & c_before_n
        rule = F.when(cond, F.lit(no)).otherwise(rule)

    def pick(which_of):  # CASE rule -> struct column named by the rule table
        expr = F.lit(None)
        for no, *_, frm, to, row in LIFETIME_RULES:
            name = {"from": frm, "to": to, "row": row}[which_of]
            src = {"first": "f", "next": "n", "first_c": "c1", "last_c": "cl"}[name]
            expr = F.when(F.col("_rule") == no, F.col(src)).otherwise(expr)
        return expr

    classes = F.lit(None).cast("string")
    for no, _, _, cls, *_ in LIFETIME_RULES:
        classes = F.when(F.col("_rule") == no, F.lit(cls)).otherwise(classes)
    days = F.datediff(F.col(f"_to.{START}").cast("date"), F.col(f"_from.{END}").cast("date"))
    km = F.col(f"_to.{KM}") - F.col(f"_from.{KM}")
    # one row per id takes the result, found by its number: no id is hot there
    found = materialize(facts.withColumn("_rule", rule).filter(F.col("_rule").isNotNull())
                        .select(pick("row")["o"]["_seq"].alias("_at"), pick("from").alias("_from"),
                                pick("to").alias("_to"), classes.alias("type_individu"))
                        .select("_at", days.alias("duree_vie_jour"), km.alias("duree_vie_km"), "type_individu"),
                        "history-facts")
    out = r.filter(F.col(ID).isNotNull()).join(_small_or_merged(found), F.col("_seq") == F.col("_at"), "left")
    if as_struct:
        dur = F.when(F.col("_at").isNotNull(), F.struct("duree_vie_jour", "duree_vie_km"))
        return out.select(*rows.columns, dur.alias("duree_de_vie"), "type_individu")
    return out.select(*rows.columns, "duree_vie_jour", "duree_vie_km", "type_individu")
