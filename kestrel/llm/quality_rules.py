"""Quality by weak supervision: rules vote or abstain, EM weighs them, a posterior decides.

Every rule looks at one measure of a document and votes clean (1), bad (-1) or
abstains (0). Vote patterns are counted over all documents (there are at most
``3 ** rules`` of them, whatever the corpus), and expectation-maximisation on
the counts estimates for both classes how often each rule votes which way. A
document is kept when its posterior probability of being clean reaches the
threshold -- one doubtful rule no longer rejects it, as all-must-pass would.
Measures, votes, EM sums and posteriors are DataFrame expressions throughout.

Defined results: NULL and empty texts have no words, so every rule but the
length rule abstains and the base check fails; repeated rows are scored
alike; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import SPACE_CLASS
from kestrel.session import materialize

KEEP_AT = 0.5
MIN_WORDS = 50
#: Rules vote clean/bad; a vote must be at least this many times likelier in the class it names.
LEAST_RATIO = 2.0


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id and the counts the rules look at."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    base = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("t"))
    words = F.array_remove(F.split("t", SPACE_CLASS + "+"), "")
    lines = F.filter(F.split("t", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    base = base.withColumns({"w": words, "lines": lines})
    # one (hash, place) per 3-word window, in hash order: equal windows are neighbours
    heads = F.slice("w", F.lit(1), F.greatest(F.size("w") - 2, F.lit(0)))
    windows = F.transform(heads, lambda x, i: F.struct(
        F.xxhash64(x, F.get("w", i + 1), F.get("w", i + 2)).alias("h"), i.alias("p")))
    base = base.withColumn("s", F.sort_array(windows))

    def found_again(x: Column, j: Column) -> Column:
        h = x["h"]
        return (F.coalesce(F.get("s", j - 1)["h"] == h, F.lit(False))
                | F.coalesce(F.get("s", j + 1)["h"] == h, F.lit(False)))

    covered = F.flatten(F.transform(F.filter("s", found_again),
                                    lambda x: F.array(x["p"], x["p"] + 1, x["p"] + 2)))
    return base.select(
        "doc_id",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.array_distinct(covered)).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        F.size(F.array_distinct("w")).cast("long").alias("n_distinct"),
        F.regexp_count("t", F.lit(r"\p{Lu}{2,}")).cast("long").alias("n_shouted"),
        F.regexp_count("t", F.lit(r"[.!?][\x20\x09-\x0D]|[.!?]$")).cast("long").alias("n_sentences"))


def base_failed() -> Column:
    """The plain check: too short, or more than half of the words in repeated windows."""
    return ((F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def _vote(bad: Column, clean: Column) -> Column:
    return F.when(bad, F.lit(-1)).when(clean, F.lit(1)).otherwise(F.lit(0)).cast("int")


def votes() -> dict[str, Column]:
    """Rule name -> vote over the columns of ``measures``."""
    n, some = F.col("n_words"), F.col("n_words") > 0
    long_enough = n >= MIN_WORDS
    per_word = lambda c: F.col(c) / F.greatest(n, F.lit(1))
    no = F.lit(False)
    return {
        "length": _vote(n < 8, no),
        "symbols": _vote(some & (per_word("n_symbols") > 0.1), no),
        "shouting": _vote(some & (per_word("n_shouted") > 0.3), no),
        "repeats": _vote(some & (per_word("n_repeat_words") > 0.3), no),
        "dup_lines": _vote((F.col("n_lines") >= 3) & (F.col("n_dup_lines") > 0.3 * F.col("n_lines")), no),
        "word_length": _vote(some & ~per_word("word_chars").between(2.5, 14.0), no),
        "variety": _vote(long_enough & (per_word("n_distinct") < 0.08), no),
        "sentences": _vote(long_enough & (F.col("n_sentences") * 150 < n),
                           long_enough & per_word("n_sentences").between(0.02, 0.3)
                           & (per_word("n_symbols") < 0.02) & (per_word("n_shouted") < 0.02)),
    }


@dataclass
class LabelModel:
    """P(vote | class) for each rule, and the prior of the clean class."""

    rules: list[str]
    prior: float = 0.8
    #: class (0 bad, 1 clean) -> rule -> vote -> probability
    p: list[dict[str, dict[int, float]]] = field(default_factory=list)

    def __post_init__(self) -> None:
        if not self.p:  # where EM starts: votes are mostly right, most rules abstain mostly
            self.p = [{r: {-1: .3, 0: .6, 1: .1} for r in self.rules},
                      {r: {-1: .01, 0: .59, 1: .4} for r in self.rules}]

    def log_ratios(self) -> Column:
        """log P(vote | clean) / P(vote | bad) at place ``3 * rule + vote + 1``.

        One array literal: its values are data to the generated code, so the
        rounds of ``fit`` share one compiled plan.
        """
        return F.lit([math.log(self.p[1][r][v] / self.p[0][r][v])
                      for r in self.rules for v in (-1, 0, 1)])

    def posterior(self) -> Column:
        """Probability of the clean class from the column ``codes`` (see ``vote_codes``)."""
        ratios = self.log_ratios()
        prior = F.lit([math.log(self.prior / (1 - self.prior))])
        odds = F.aggregate("codes", F.get(prior, F.lit(0)), lambda acc, c: acc + F.get(ratios, c))
        return 1 / (1 + F.exp(-odds))

    def accuracy(self, rule: str) -> float:
        """Estimated share of right votes among the rule's votes."""
        right = self.prior * self.p[1][rule][1] + (1 - self.prior) * self.p[0][rule][-1]
        wrong = self.prior * self.p[1][rule][-1] + (1 - self.prior) * self.p[0][rule][1]
        return right / (right + wrong)


def vote_codes(rules: list[str]) -> Column:
    """The votes ``v_<rule>`` as one array of ``3 * rule + vote + 1``."""
    return F.array(*[F.lit(3 * i + 1) + F.col(f"v_{r}") for i, r in enumerate(rules)])


def fit(patterns: DataFrame, rules: list[str], rounds: int = 30) -> LabelModel:
    """EM over the counted vote patterns (columns ``codes`` and ``n``).

    Each round is one aggregate of the pattern table to the expected counts of
    every (rule, vote). A vote stays ``LEAST_RATIO`` times likelier under the
    class it names, so the classes cannot swap or drift to some other split.
    """
    model = LabelModel(rules)
    total = patterns.agg(F.sum("n")).first()[0]
    if not total:
        return model
    for _ in range(rounds):
        weighted = patterns.select("n", (model.posterior() * F.col("n")).alias("c"),
                                   F.explode("codes").alias("code"))
        got = {r["code"]: (r["n"] - r["c"], r["c"]) for r in weighted.groupBy("code").agg(
            F.sum("n").alias("n"), F.sum("c").alias("c")).collect()}  # 3 rows per rule at most
        clean = sum(got.get(v, (0, 0))[1] for v in (0, 1, 2))
        size = (total - clean, clean)
        p: list[dict[str, dict[int, float]]] = [{}, {}]
        for i, r in enumerate(rules):
            for y in (0, 1):
                p[y][r] = {v: (got.get(3 * i + v + 1, (0, 0))[y] + 0.01) / (size[y] + 0.03)
                           for v in (-1, 0, 1)}
            for v, own in ((-1, 0), (1, 1)):
                p[1 - own][r][v] = min(p[1 - own][r][v], p[own][r][v] / LEAST_RATIO)
            for y in (0, 1):
                p[y][r][0] = max(1e-9, 1 - p[y][r][-1] - p[y][r][1])
        prior = min(0.99, max(0.5, clean / total))
        moved = abs(prior - model.prior) + sum(abs(p[y][r][v] - model.p[y][r][v])
                                               for y in (0, 1) for r in rules for v in (-1, 0, 1))
        model = LabelModel(rules, prior, p)
        if moved < 1e-5:
            break
    return model


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            keep_at: float = KEEP_AT) -> DataFrame:
    """doc_id, the measures, ``v_<rule>`` votes, quality_prob, base_failed and kept."""
    rules = votes()
    scored = materialize(measures(docs, id_col, text_col)
                         .withColumns({f"v_{r}": v for r, v in rules.items()}), "quality-measures")
    scored = scored.withColumn("codes", vote_codes(list(rules)))
    counted = materialize(scored.groupBy("codes").agg(F.count("*").alias("n")), "quality-counts")
    # at most 3 ** rules rows, put into one file after they were counted: every EM step reads them
    patterns = materialize(counted.coalesce(1), "quality-patterns")
    model = fit(patterns, list(rules))
    out = scored.withColumns({"quality_prob": model.posterior(), "base_failed": base_failed()})
    return (out.withColumn("kept", ~F.col("base_failed") & (F.col("quality_prob") >= keep_at))
            .drop("codes"))
