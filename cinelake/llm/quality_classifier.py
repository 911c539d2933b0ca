"""Quality classifier from weak labels.

Overlapping heuristic labellers vote on each text. Most are rules on its
counts; two are a sparse linear model of words, fitted to labelled documents,
at two strengths, which brings in the unwanted words of any language.
Expectation-maximisation over the counts of vote patterns of all documents
estimates how often each labeller fires on good and on bad documents, and the share of
bad ones; documents of ``labels`` have known classes and hold them. The
posterior labels then train a linear scorer on hashed words and votes, which
scores every document.

Both fits use bounded samples: the ``FIT_DOCS`` labelled documents, and the
``FIT_DOCS`` documents, with the least hash of their id. Only the samples'
hashed words and the vote patterns (at most 2 to the number of labellers,
times 3) come to the driver. The penalty on weights leaves most at zero, and
hashes have 32 bits, so a word that the sample lacks weighs nothing.

Defined results: a null text is empty, has no votes and is judged by the
bias alone; without labels the priors separate the classes; repeated rows
each give a row; an empty table gives no rows; further columns are kept
whatever their names are.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.llm import textstats
from cinelake.llm.tables import free_name, map_batches, prepare, staged

#: Documents in each sample; rejection from this probability of being bad.
FIT_DOCS, THRESHOLD = 10_000, 0.5

#: Logits at which the two word labellers fire.
WORD_LEVELS = (1.0, 3.0)

#: Labellers: each says "bad" of texts by their counts ``c``, or nothing.
LABELLERS: dict[str, Callable[[dict[str, np.ndarray]], np.ndarray]] = {
    "symbols": lambda c: c["n_symbols"] > 0.25 * c["n_words"],
    "noisy_words": lambda c: c["n_noisy"] > 0.2 * c["n_words"],
    "upper": lambda c: c["n_upper"] > 0.3 * c["n_words"],
    "marks": lambda c: c["n_marks"] > 0.3 * c["n_words"],
    "echoes": lambda c: c["n_echo"] > 0.15 * c["n_words"],
    "few_kinds": lambda c: (c["n_distinct"] < 0.15 * c["n_words"]) & (c["n_words"] >= 30),
    "repeats": lambda c: c["n_repeat_words"] > 0.5 * c["n_words"],
    "no_short_words": lambda c: (c["n_short"] < 0.05 * c["n_words"]) & (c["n_words"] >= 10),
    "insults": lambda c: c["n_insults"] >= 1,
    "more_insults": lambda c: c["n_insults"] >= 2,
}


def votes(counts: np.ndarray) -> np.ndarray:
    """The labellers' votes on rows of counts, as bits."""
    named = dict(zip(textstats.COUNTS, counts.T))
    return sum((fires(named).astype(np.int64) << k for k, fires in enumerate(LABELLERS.values())),
               np.zeros(len(counts), np.int64))


COUNT_LABELLERS = len(LABELLERS)
ALL_LABELLERS = (*LABELLERS, *(f"words_{level:g}" for level in WORD_LEVELS))


# -- label model --------------------------------------------------------------------

class LabelModel:
    """Two classes, labellers independent given the class. The priors say that
    a labeller seldom fires on good documents, and that most documents are good."""

    def __init__(self, labellers: int, rounds: int = 50):
        self.rounds = rounds
        self.fires = np.array([np.full(labellers, 0.01), np.full(labellers, 0.3)])
        self.bad = 0.2

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Probability of being bad of rows of votes."""
        logs = np.stack([patterns @ np.log(p) + (1 - patterns) @ np.log1p(-p) for p in self.fires])
        logs += np.log([[1 - self.bad], [self.bad]])
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -60, 60)))

    def fit(self, patterns: np.ndarray, counts: np.ndarray, known: np.ndarray) -> LabelModel:
        """known: 0 good, 1 bad, -1 unknown; counts: documents of a row."""
        total = counts.sum()
        for _ in range(self.rounds if total else 0):
            bad = np.where(known < 0, self.posterior(patterns), known)
            for c, share in enumerate((1 - bad, bad)):
                weight = counts * share
                hit, prior = (0.01, 1.0) if c == 0 else (0.3, 1.0)
                self.fires[c] = np.clip((weight @ patterns + hit * prior) / (weight.sum() + prior), 1e-6, 1 - 1e-6)
            self.bad = float(np.clip((counts @ bad + 2) / (total + 10), 1e-3, 1 - 1e-3))
        return self


def _bits(patterns: np.ndarray) -> np.ndarray:
    return (patterns[:, None] >> np.arange(len(ALL_LABELLERS)) & 1).astype(float)


# -- hashed linear scorer ------------------------------------------------------------

VOTE_SLOTS = [zlib.crc32(f"vote {name}".encode()) for name in ALL_LABELLERS]


class SparseScorer:
    """Logistic regression on present slots, fitted by follow-the-regularised-
    leader steps with an absolute penalty: a slot whose summed error stays
    under the penalty keeps the weight zero."""

    def __init__(self, weights: dict[int, float] | None = None, bias: float = 0.0):
        self.weights, self.bias = weights or {}, bias

    def fit(self, rows: list[np.ndarray], targets: np.ndarray, epochs: int = 4, rate: float = 0.5,
            penalty: float = 2.0) -> SparseScorer:
        """rows: distinct slots of a document; targets: probability of being bad.
        The order is fixed by a seed. Slots stay at 32 bits, as this runs in the driver."""
        if not rows:
            return self
        slots = np.unique(np.concatenate([*rows, np.zeros(1, np.uint32)]))
        places = [np.searchsorted(slots, r).astype(np.int32) for r in rows]
        pull, size, draw = np.zeros(len(slots)), np.zeros(len(slots)), np.random.default_rng(7)
        share = float(np.clip(np.mean(targets), 0.01, 0.99))
        bias, steps = float(np.log(share / (1 - share))), 1.0
        weight = lambda z, n: np.where(np.abs(z) > penalty, (np.sign(z) * penalty - z) * rate / (1 + np.sqrt(n)), 0.0)
        for _ in range(epochs):
            for i in draw.permutation(len(rows)):
                at = places[i]
                z, n = pull[at], size[at]
                w = weight(z, n)
                error = 1 / (1 + np.exp(-np.clip(bias + w.sum(), -60, 60))) - targets[i]
                square = error * error
                pull[at] = z + error - (np.sqrt(n + square) - np.sqrt(n)) / rate * w
                size[at] = n + square
                steps += square
                bias -= 0.3 * error / np.sqrt(steps)
        final = weight(pull, size)
        self.weights = {int(slots[k]): float(final[k]) for k in np.flatnonzero(final)}
        self.bias = bias
        return self

    def words(self, texts: textstats.Texts) -> np.ndarray:
        """Summed weights of each text's distinct words (of words alike but for case and marks, one counts)."""
        known = np.array(sorted(self.weights), np.int64)
        if not len(known) or not len(texts.words):
            return np.zeros(len(texts.texts))
        at = np.minimum(np.searchsorted(known, texts.slots), len(known) - 1)
        weights = np.array([self.weights[s] for s in known.tolist()])
        found = np.where(known[at] == texts.slots, weights[at], 0.0)[texts.places]
        hits = np.flatnonzero(found)
        total, taken = np.zeros(len(texts.texts)), set()
        for owner, place, value in zip(texts.owner[hits].tolist(), texts.slots[texts.places[hits]].tolist(),
                                       found[hits].tolist()):
            if (owner, place) not in taken:
                taken.add((owner, place))
                total[owner] += value
        return total

    def probabilities(self, texts: textstats.Texts, patterns: np.ndarray) -> np.ndarray:
        """Probability of being bad of texts with these votes."""
        logits = self.bias + self.words(texts)
        for k, s in enumerate(VOTE_SLOTS):
            logits += self.weights.get(s, 0.0) * (patterns >> k & 1)
        return 1 / (1 + np.exp(-np.clip(logits, -60, 60)))


def _word_votes(values: np.ndarray) -> np.ndarray:
    return sum(((values >= level).astype(np.int64) << (COUNT_LABELLERS + k) for k, level in enumerate(WORD_LEVELS)),
               np.zeros(len(values), np.int64))


def _with_votes(slots: np.ndarray, pattern: int) -> np.ndarray:
    """A document's slots of words and votes."""
    return np.append(slots, np.array([s for k, s in enumerate(VOTE_SLOTS) if pattern >> k & 1], np.uint32))


class Classifier:
    """Word labellers, label model and scorer; what a task needs to judge texts."""

    def __init__(self, word_model: SparseScorer, labels: LabelModel, scorer: SparseScorer, insults: tuple[str, ...]):
        self.word_model, self.labels, self.scorer, self.insults = word_model, labels, scorer, insults

    def votes(self, texts: textstats.Texts) -> np.ndarray:
        return votes(textstats.counts(texts)) | _word_votes(self.word_model.words(texts))

    def judge(self, batch: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Votes and the scorer's probabilities of being bad."""
        texts = textstats.Texts(batch, self.insults)
        patterns = self.votes(texts)
        return patterns, self.scorer.probabilities(texts, patterns)


# -- over tables ------------------------------------------------------------------------

def truth_of(labels: DataFrame) -> DataFrame:
    """(doc_id, bad) of labelled documents; bad (1) if any of their labels says so."""
    return labels.where("doc_id is not null and (quality is not null or toxic is not null)").groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.greatest(1 - F.coalesce(F.min("quality"), F.lit(1)), F.coalesce(F.max("toxic"), F.lit(0))).alias("bad"))


def id_and_text(docs: DataFrame, text: str, key: str) -> DataFrame:
    return docs.select(docs[f"`{key}`"].cast("long").alias("doc_id"), docs[f"`{text}`"].cast("string").alias("text"))


def first_ids(ids: DataFrame) -> DataFrame:
    """The FIT_DOCS ids (column doc_id) with the least hash."""
    return ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_DOCS)


def sample(source: DataFrame, ids: DataFrame, truth: DataFrame,
           insults: tuple[str, ...]) -> list[tuple[int, np.ndarray, float]]:
    """(count votes, word slots, bad or -1) of the (doc_id, text) rows with
    the given ids; these are a few times FIT_DOCS at most, hence the broadcast.
    The slots are views of one Arrow table, so the driver holds them once."""
    picked = source.join(F.broadcast(ids), "doc_id", "left_semi")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = textstats.Texts(batch.column(1).to_pylist(), insults)
        found = votes(textstats.counts(texts))
        own = texts.slots[texts.places].astype(np.uint32)
        slots = [np.unique(own[a:b]) for a, b in zip(texts.firsts.tolist(), texts.firsts[1:].tolist())]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int32()),
                                           pa.array([s.tobytes() for s in slots], pa.binary())],
                                          ["doc_id", "votes", "slots"])

    rows = map_batches(picked, run, "doc_id long, votes int, slots binary").groupBy("doc_id").agg(
        F.min(F.struct("votes", "slots")).alias("s")).select("doc_id", "s.*").join(truth, "doc_id", "left")  # one row an id
    taken = rows.toArrow()
    order = np.argsort(taken.column("doc_id").to_numpy(), kind="stable")
    found, slots, bad = (taken.column(c) for c in ("votes", "slots", "bad"))
    found, bad = found.to_pylist(), bad.to_pylist()
    slots = [np.frombuffer(s.as_buffer(), np.uint32) for s in slots]
    return [(found[k], slots[k], -1.0 if bad[k] is None else float(bad[k])) for k in order]


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id",
        insults: tuple[str, ...] = textstats.INSULTS) -> Classifier:
    """Word labellers and scorer on the samples, label model over all documents."""
    prepare(docs.sparkSession)
    source, truth = id_and_text(docs, text, key), staged(truth_of(labels), "truth")
    every = source.where("doc_id is not null").select("doc_id")
    drawn = sample(source, first_ids(truth.select("doc_id")).unionByName(first_ids(every)).distinct(), truth, insults)
    fitted = SparseScorer().fit([_with_votes(s, v) for v, s, bad in drawn if bad >= 0],
                                np.array([bad for _, _, bad in drawn if bad >= 0]))
    vote_slots = set(VOTE_SLOTS)
    words = SparseScorer({s: w for s, w in fitted.weights.items() if s not in vote_slots})
    model = Classifier(words, LabelModel(len(ALL_LABELLERS)), SparseScorer(), insults)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = model.votes(textstats.Texts(batch.column(1).to_pylist(), insults))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int32())], ["doc_id", "votes"])

    patterns = staged(map_batches(source, run, "doc_id long, votes int"), "votes") \
        .join(truth, "doc_id", "left").groupBy("votes", "bad").count().collect()  # bounded by the patterns
    model.labels.fit(_bits(np.array([r["votes"] for r in patterns], np.int64)),
                     np.array([r["count"] for r in patterns], float),
                     np.array([-1 if r["bad"] is None else r["bad"] for r in patterns], float))
    values = np.array([sum(words.weights.get(int(x), 0.0) for x in s) for _, s, _ in drawn])
    full = (np.array([v for v, _, _ in drawn], np.int64) | _word_votes(values)).tolist()
    weak = model.labels.posterior(_bits(np.array(full, np.int64)))
    model.scorer.fit([_with_votes(s, v) for v, (_, s, _) in zip(full, drawn)], weak)
    return model


def classify(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id",
             insults: tuple[str, ...] = textstats.INSULTS) -> DataFrame:
    """(doc_id, weak_score, score, kept) of every document; scores are probabilities of being bad."""
    model = fit(docs, labels, text, key, insults)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        patterns, score = model.judge(batch.column(1).to_pylist())
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(model.labels.posterior(_bits(patterns))), pa.array(score),
             pa.array(score < THRESHOLD)], ["doc_id", "weak_score", "score", "kept"])

    return map_batches(id_and_text(docs, text, key), run, "doc_id long, weak_score double, score double, kept boolean")


def keep_good(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id",
              insults: tuple[str, ...] = textstats.INSULTS) -> DataFrame:
    """The rows of ``docs`` that the scorer keeps, with all columns."""
    model, names = fit(docs, labels, text, key, insults), docs.columns
    rows = docs.select(*[docs[f"`{c}`"] for c in names], docs[f"`{text}`"].cast("string").alias(free_name(docs, "_t")))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        mask = pa.array(model.judge(batch.column(len(names)).to_pylist())[1] < THRESHOLD)
        return pa.RecordBatch.from_arrays([c.filter(mask) for c in batch.columns[:-1]], names)

    return map_batches(rows, run, docs.schema)
