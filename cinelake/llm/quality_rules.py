"""Quality rules with risk-controlled thresholds.

Each rule compares a rate of a text with a cutoff. One of them is a word
score: the summed weights of a sparse linear model of words, fitted to at most
``FIT_DOCS`` labelled documents of the design half (least hash of the id), which
brings in the unwanted words of any language. The cutoffs come from all
labelled documents, stratum by stratum (language):

1. Design half: on a fixed grid, a rule takes the cutoff that rejects most bad
   documents less ``GOOD_COST`` times the good ones; rules that gain nothing are
   off. The rules then form a sequence by gain, so that prefixes of it are
   nested rule sets.
2. Holdout half: the rule sets are tested in that fixed order. The number of good
   holdout documents a set rejects gives, by the exact binomial tail, the
   p-value of "it rejects more than ``risk`` of the good documents". A set is
   adopted while its p-value is at most ``delta`` / number of strata; the
   sequence ends at its first failure. A fixed sequence needs no correction
   within a stratum, and Bonferroni's covers the strata: with probability 1 -
   ``delta`` no stratum loses more than ``risk`` of its good documents.

A stratum with too few labels adopts nothing, so its documents are kept. Good
means quality 1 and not toxic, bad means quality 0 or toxic; a document whose
labels repeat is bad if one says so, null labels say nothing.

All documents and labels count, and every labelled language is a stratum, as are
the documents without one. Histograms, rule sequences and binomial tails have a
row a stratum, made where it lies; adopted rules are joined back by stratum, so
nothing that grows with the strata comes to the driver.

Defined results: null and wordless texts have no words and fail the base
rules; repeated rows each give a row; without labels all rules are off; an
empty table gives no rows; further columns are kept whatever their names are.
"""

from __future__ import annotations

import math
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinelake.llm import textstats
from cinelake.llm.quality_classifier import SparseScorer, first_ids, id_and_text, sample, truth_of
from cinelake.llm.tables import bucket, free_name, map_batches, prepare, staged

RISK, DELTA, GOOD_COST = 0.02, 0.05, 20
#: Name of the documents without a language in ``cutoffs``.
OTHER = "(other)"

#: Rule: numerator, denominator and grid of cutoffs; a text is rejected from the cutoff on.
_RATES = (0.02, 0.05, 0.08, 0.12, 0.16, 0.2, 0.3, 0.4, 0.5, 0.6, 0.8)
RULES: dict[str, tuple[str, str, tuple[float, ...]]] = {
    "symbols": ("n_symbols", "n_words", _RATES),
    "dup_lines": ("n_dup_lines", "n_lines", _RATES),
    "repeats": ("n_repeat_words", "n_words", _RATES[:6]),
    "upper": ("n_upper", "n_words", _RATES),
    "echoes": ("n_echo", "n_words", _RATES[3:]),
    "marks": ("n_marks", "n_words", _RATES),
    "noisy": ("n_noisy", "n_words", _RATES),
    "insults": ("n_insults", "one", (1, 2, 3, 5)),
    "words": ("word_score", "one", (2, 3, 4, 6)),
    "word_length": ("word_chars", "n_words", (9, 10, 12, 15, 20, 30, 50)),
}

STATS_SCHEMA = "doc_id long, stratum string, " + ", ".join(f"{c} long" for c in textstats.COUNTS) \
    + ", word_score double"


# -- exact binomial tail --------------------------------------------------------

def _fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny, c, d = 1e-300, 1.0, 1 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > tiny else tiny)
    value = d
    for m in range(1, 100_000):
        for step in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                     -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d, c = 1 + step * d, 1 + step / c
            d, c = 1 / (d if abs(d) > tiny else tiny), c if abs(c) > tiny else tiny
            value *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return value


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X binomial (n, p), by the incomplete beta function."""
    if k >= n:
        return 1.0
    a, b, x = n - k, k + 1, 1 - p
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log(p))
    if x < (a + 1) / (a + b + 2):
        return min(1.0, front * _fraction(a, b, x) / a)
    return max(0.0, 1 - front * _fraction(b, a, p) / b)


# -- counts -----------------------------------------------------------------------

def word_model(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id",
               insults: tuple[str, ...] = textstats.INSULTS) -> SparseScorer:
    """Weights of words that mark bad documents, from the design half only."""
    prepare(docs.sparkSession)
    truth = truth_of(labels).where(bucket("doc_id", 2) != 1)
    rows = sample(id_and_text(docs, text, key), first_ids(truth.select("doc_id")), truth, insults)
    return SparseScorer().fit([s for _, s, _ in rows], np.array([bad for _, _, bad in rows]))


def stats(docs: DataFrame, text: str = "text", key: str = "doc_id", stratum: str = "lang",
          insults: tuple[str, ...] = textstats.INSULTS, words: SparseScorer | None = None) -> DataFrame:
    """doc_id, stratum, the counts and the word score of every whole text."""
    prepare(docs.sparkSession)
    model = words or SparseScorer()
    rows = docs.select(docs[key].cast("long").alias("doc_id"), docs[stratum].cast("string").alias("stratum"),
                       docs[text].cast("string").alias("text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = textstats.Texts(batch.column(2).to_pylist(), insults)
        found = textstats.counts(texts)
        return pa.RecordBatch.from_arrays(
            [*batch.columns[:2], *(pa.array(c) for c in found.T.copy()), pa.array(model.words(texts))],
            ["doc_id", "stratum", *textstats.COUNTS, "word_score"])

    return map_batches(rows, run, STATS_SCHEMA)


def rate(rule: str) -> Column:
    top, bottom, _ = RULES[rule]
    return F.col(top) / (F.lit(1) if bottom == "one" else F.greatest(F.col(bottom), F.lit(1)))


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def labelled(counted: DataFrame, labels: DataFrame) -> DataFrame:
    """The counts of labelled documents with ``good``."""
    return counted.join(truth_of(labels).select("doc_id", (F.col("bad") == 0).alias("good")), "doc_id")


# -- cutoffs ----------------------------------------------------------------------

Cutoffs = dict[str, list[tuple[str, float]]]


#: Of a stratum, by place in RULES: cutoff (infinite: off) and place in its sequence.
_SEQUENCES = "stratum string, cuts array<double>, places array<int>"


def _sequence(cells: list[dict]) -> tuple[list[float], list[int]]:
    """Cutoffs and places in the rule sequence, best first, from a stratum's design histogram."""
    tables = {rule: [[0, 0] for _ in range(len(grid) + 1)] for rule, (_, _, grid) in RULES.items()}
    for cell in cells:
        tables[cell["rule"]][cell["level"]][cell["good"]] += cell["n"]
    gains = []
    for rule, (_, _, grid) in RULES.items():
        best = max((sum(c[0] - GOOD_COST * c[1] for c in tables[rule][k + 1:]), k) for k in range(len(grid)))
        if best[0] > 0:
            gains.append((-best[0], rule, float(grid[best[1]])))
    cuts, places = [math.inf] * len(RULES), [len(RULES)] * len(RULES)
    for place, (_, rule, cut) in enumerate(sorted(gains)):
        at = list(RULES).index(rule)
        cuts[at], places[at] = cut, place
    return cuts, places


def _sequences(names: list, found: list[tuple[list[float], list[int]]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(names, pa.string()), pa.array([c for c, _ in found], pa.list_(pa.float64())),
         pa.array([p for _, p in found], pa.list_(pa.int32()))], ["stratum", "cuts", "places"])


def _design(rows: DataFrame) -> DataFrame:
    """Rule sequences of the strata from the design half."""
    steps = []
    for rule, (_, _, grid) in RULES.items():
        level = sum(((rate(rule) >= cut).cast("int") for cut in grid), F.lit(0))
        steps.append(F.struct(F.lit(rule).alias("rule"), level.alias("level")))
    counted = rows.select("stratum", F.col("good").cast("int").alias("good"), F.explode(F.array(*steps)).alias("s")).groupBy(
        "stratum", "good", "s.rule", "s.level").agg(F.count(F.lit(1)).alias("n"))
    cells = counted.groupBy("stratum").agg(F.collect_list(F.struct("rule", "level", "good", "n")).alias("cells"))  # rules x grid

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return _sequences(batch.column(0).to_pylist(), [_sequence(c) for c in batch.column(1).to_pylist()])

    return map_batches(cells, run, _SEQUENCES)


def _with_rules(rows: DataFrame, sequences: DataFrame, stratum: str = "stratum", how: str = "left") -> DataFrame:
    """``rows`` with the cutoffs and places of their stratum (null is one); a row each stratum, broadcast if small."""
    key, cuts, places = (free_name(rows, c) for c in ("_key", "cuts", "places"))
    table = sequences.select(F.col("stratum").alias(key), F.col("cuts").alias(cuts), F.col("places").alias(places))
    return rows.join(table, F.col(f"`{stratum}`").eqNullSafe(F.col(key)), how).drop(key)


def _place() -> Column:
    """Place in its stratum's sequence of the first rule that rejects the row; null if none does."""
    return F.least(*[F.when(rate(rule) >= F.get("cuts", F.lit(k)), F.get("places", F.lit(k))) for k, rule in enumerate(RULES)])


def learned(counted: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """The adopted rules of each stratum that has some."""
    known = staged(labelled(counted, labels), "labelled-counts")
    strata = known.agg(F.count_distinct("stratum")).first()[0] + 1
    held_out = bucket("doc_id", 2) == 1
    good = _with_rules(known.where(held_out & F.col("good")), staged(_design(known.where(~held_out)), "rule-sequences"),
                       how="inner").withColumn("place", _place())
    hits = good.groupBy("stratum").agg(
        F.first("cuts"), F.first("places"), F.count(F.lit(1)),
        F.array(*[F.sum((F.coalesce("place", F.lit(-1)) == k).cast("long")) for k in range(len(RULES))]))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        names, found = [], []
        for name, cuts, places, total, rejected in zip(*(c.to_pylist() for c in batch.columns)):
            keep, sum_ = 0, 0
            for place in range(sum(p < len(RULES) for p in places)):
                sum_ += rejected[place]
                if binomial_tail(sum_, total, risk) > delta / strata:
                    break
                keep = place + 1
            if keep:
                names.append(name)
                found.append(([c if p < keep else math.inf for c, p in zip(cuts, places)], places))
        return _sequences(names, found)

    return staged(map_batches(hits, run, _SEQUENCES), "adopted-rules")


Cutoffs = dict[str, list[tuple[str, float]]]


def cutoffs(counted: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> Cutoffs:
    """The adopted rules in order, to look at: of each stratum, [] if it has none."""
    out: Cutoffs = {OTHER: []}
    for r in learned(counted, labels, risk, delta).collect():
        rules = sorted((p, rule, c) for rule, c, p in zip(RULES, r["cuts"], r["places"]) if c < math.inf)
        out[OTHER if r["stratum"] is None else r["stratum"]] = [(rule, c) for _, rule, c in rules]
    return out


def _first_rule(cutoffs: Cutoffs) -> Column:
    """As ``_place``, by few cutoffs at hand."""
    cases = F.lit(None).cast("int")
    for stratum, sequence in cutoffs.items():
        for place, (rule, cut) in reversed(list(enumerate(sequence))):
            cases = F.when((F.col("stratum") == stratum) & (rate(rule) >= cut), place).otherwise(cases)
    return cases


def stratum_of(strata: list[str]) -> Column:
    """The row's name among few strata at hand: null has one, a language without one has none."""
    named = F.col("stratum").isin([s for s in strata if s != OTHER])
    return F.when(F.col("stratum").isNull(), F.lit(OTHER)).when(named, F.col("stratum"))


def kept(adopted: Cutoffs) -> Column:
    return ~base_failed() & _first_rule(adopted).isNull()


def judge(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Counts, base verdict and verdict of every document."""
    counted = staged(stats(docs, text, key, words=word_model(docs, labels, text, key)), "text-counts")
    rows = _with_rules(counted, learned(counted, labels))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       base_failed().alias("base_failed"), (~base_failed() & _place().isNull()).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", stratum: str = "lang",
              insults: tuple[str, ...] = textstats.INSULTS) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all columns. The counts are
    made twice, for the cutoffs and for the verdict, rather than moving texts; only
    adopted rules beyond Spark's broadcast limit have the texts sorted by stratum."""
    model = word_model(docs, labels, text, key, insults)
    adopted = learned(staged(stats(docs, text, key, stratum, insults, model), "text-counts"), labels)
    names, own = docs.columns, free_name(docs, "_s")
    rows = _with_rules(docs.select(*[docs[f"`{c}`"] for c in names], docs[f"`{stratum}`"].cast("string").alias(own),
                                   docs[f"`{text}`"].cast("string").alias(free_name(docs, "_t"))), adopted, own)
    off = [math.inf] * len(RULES)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = textstats.Texts(batch.column(len(names) + 1).to_pylist(), insults)
        found = textstats.counts(texts)
        c = dict(zip(textstats.COUNTS, found.T), one=np.ones(len(found)), word_score=model.words(texts))
        stays = (c["n_words"] >= 10) & (100 * c["n_repeat_words"] <= 20 * c["n_words"])
        cuts = np.array([c or off for c in batch.column(len(names) + 2).to_pylist()])
        for k, (top, bottom, _) in enumerate(RULES.values()):
            stays &= c[top] / np.maximum(c[bottom], 1) < cuts[:, k]
        return pa.RecordBatch.from_arrays([x.filter(pa.array(stays)) for x in batch.columns[:len(names)]], names)

    return map_batches(rows, run, docs.schema)
