"""Language identification by a bidirectional gated recurrent network over bytes.

A text's bytes are cut into windows of ``STEPS``; two gated recurrent layers
read each window forwards and backwards, and every position gets
probabilities of the languages from both states. A text's probabilities are
the mean over all its positions. The network is trained in numpy by
backpropagation through time on ``FIT_DOCS`` documents of each language (those
with the least hash of the id), with one segment of ``SEGMENT`` characters each.

Language, source and doc_id are no inputs of a prediction. Defined results:
``und`` with score 0 for null texts, texts without a letter, and if there is
nothing to learn from; null languages are not learned from; repeated rows each
give a row; an empty table gives none. Only the named columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cinelake.llm.tables import bucket, crc_bucket, map_batches, prepare

FIT_DOCS, SEGMENT, STEPS, HIDDEN, BLOCK = 200, 400, 64, 8, 4096
FOLDS, UNKNOWN = 5, "und"

_LETTER = regex.compile(r"\p{L}")


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """Logistic function in place, by the hyperbolic tangent."""
    x *= 0.5
    np.tanh(x, out=x)
    x += 1
    x *= 0.5
    return x


class Network:
    """Two gated layers (0 forwards, 1 backwards) and a softmax at each position.

    w: byte -> update, reset and candidate inputs; u: state -> the same; out:
    both states -> languages.
    """

    def __init__(self, languages: list[str], hidden: int = HIDDEN, seed: int = 1):
        draw = np.random.default_rng(seed)
        self.languages, self.hidden = languages, hidden
        normal = lambda *shape: draw.normal(0, 0.2, shape).astype(np.float32)
        self.params = {"w0": normal(256, 3 * hidden), "w1": normal(256, 3 * hidden), "u0": normal(hidden, 3 * hidden),
                       "u1": normal(hidden, 3 * hidden), "out": normal(2 * hidden, len(languages)),
                       "bias": np.zeros(len(languages), np.float32)}

    # -- one layer ------------------------------------------------------------

    def _run(self, data: np.ndarray, side: int, keep: bool = False):
        """States [time, window, hidden] of one layer over bytes [time, window]."""
        h, w, u = self.hidden, self.params[f"w{side}"], self.params[f"u{side}"]
        steps, n = data.shape
        states, state, trace = np.empty((steps, n, h), np.float32), np.zeros((n, h), np.float32), []
        gated = np.empty((n, 3 * h), np.float32)
        for t in range(steps) if side == 0 else range(steps - 1, -1, -1):
            inputs = w[data[t]]
            np.matmul(state, u, out=gated)
            gates = inputs[:, :2 * h]
            gates += gated[:, :2 * h]
            _sigmoid(gates)
            update, reset = gates[:, :h], gates[:, h:]
            candidate = gated[:, 2 * h:] * reset
            candidate += inputs[:, 2 * h:]
            np.tanh(candidate, out=candidate)
            if keep:
                trace.append((t, state, update, reset, candidate, gated[:, 2 * h:].copy()))
            new = states[t]
            np.subtract(state, candidate, out=new)
            new *= update
            new += candidate
            state = new
        return states, trace

    def positions(self, data: np.ndarray) -> np.ndarray:
        """Language probabilities [time, window, language] of every byte."""
        logits = self._run(data, 0)[0] @ self.params["out"][:self.hidden]
        logits += self._run(data, 1)[0] @ self.params["out"][self.hidden:]
        logits += self.params["bias"]
        logits -= logits.max(-1, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(-1, keepdims=True)
        return logits

    # -- training -----------------------------------------------------------------

    def _gradients(self, data: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Backpropagation through time; every position of a window has its label."""
        h, p = self.hidden, self.params
        steps, n = data.shape
        runs = [self._run(data, side, keep=True) for side in (0, 1)]
        both = np.concatenate([r[0] for r in runs], axis=2)
        logits = both @ p["out"] + p["bias"]
        logits -= logits.max(-1, keepdims=True)
        error = np.exp(logits)
        error /= error.sum(-1, keepdims=True)
        error[:, np.arange(n), labels] -= 1
        error /= steps * n
        grads = {"out": both.reshape(-1, 2 * h).T @ error.reshape(-1, error.shape[2]), "bias": error.sum((0, 1))}
        back = error @ p["out"].T
        for side, (_, trace) in enumerate(runs):
            own, u = back[:, :, side * h:(side + 1) * h], p[f"u{side}"]
            d_inputs, d_u, later = np.zeros((steps, n, 3 * h), np.float32), np.zeros_like(u), np.zeros((n, h), np.float32)
            for t, before, update, reset, candidate, gated in reversed(trace):
                d = own[t] + later
                d_candidate = d * (1 - update) * (1 - candidate ** 2)
                d_update = d * (before - candidate) * update * (1 - update)
                d_reset = d_candidate * gated * reset * (1 - reset)
                d_inputs[t] = np.concatenate([d_update, d_reset, d_candidate], axis=1)
                d_gated = np.concatenate([d_update, d_reset, d_candidate * reset], axis=1)
                d_u += before.T @ d_gated
                later = d * update + d_gated @ u.T
            d_w = np.zeros_like(p[f"w{side}"])
            flat, bytes_ = d_inputs.reshape(-1, 3 * h), data.reshape(-1)
            for k in range(3 * h):
                d_w[:, k] = np.bincount(bytes_, flat[:, k], 256)
            grads[f"w{side}"], grads[f"u{side}"] = d_w, d_u
        return grads

    def fit(self, windows: np.ndarray, labels: np.ndarray, rounds: int = 250, size: int = 192,
            rate: float = 0.02, seed: int = 2) -> Network:
        """Adam steps on windows [window, time], languages drawn alike."""
        draw = np.random.default_rng(seed)
        by_label = [np.flatnonzero(labels == k) for k in range(len(self.languages))]
        first = {k: np.zeros_like(v) for k, v in self.params.items()}
        second = {k: np.zeros_like(v) for k, v in self.params.items()}
        for step in range(1, rounds + 1):
            picked = np.concatenate([draw.choice(rows, max(1, size // len(by_label))) for rows in by_label])
            for k, g in self._gradients(windows[picked].T, labels[picked]).items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.01 * (g * g - second[k])
                pace = rate * min(1, 2 * (rounds - step + 1) / rounds)
                self.params[k] -= (pace * (first[k] / (1 - 0.9 ** step)) / (
                    np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
        return self

    # -- prediction ------------------------------------------------------------------

    def pooled(self, texts: list[bytes]) -> np.ndarray:
        """Mean language probabilities of each non-empty text's bytes."""
        pieces = [(len(t) + STEPS - 1) // STEPS for t in texts]
        owner = np.repeat(np.arange(len(texts)), pieces)
        sizes = np.full(len(owner), STEPS)
        last = np.cumsum(pieces) - 1
        sizes[last] = [len(t) - (p - 1) * STEPS for t, p in zip(texts, pieces)]
        padded = np.frombuffer(b"".join(t + bytes(-len(t) % STEPS) for t in texts), np.uint8).reshape(-1, STEPS)
        sums = np.zeros((len(texts), len(self.languages)))
        for k in range(0, len(padded), BLOCK):
            block = np.ascontiguousarray(padded[k:k + BLOCK].T)
            found = self.positions(block)
            found *= (np.arange(STEPS)[:, None] < sizes[None, k:k + BLOCK])[:, :, None]
            np.add.at(sums, owner[k:k + BLOCK], found.sum(0))
        return sums / np.array([len(t) for t in texts])[:, None]


def windows_of(segments: list[tuple[str, str]], languages: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Full windows of labelled segments (a short one is repeated to fill a window)."""
    rows, labels = [], []
    for text, lang in segments:
        data = text.encode()
        if not data:
            continue
        data = data * (STEPS // len(data) + 1) if len(data) < STEPS else data
        for k in range(0, len(data) - STEPS + 1, STEPS):
            rows.append(np.frombuffer(data[k:k + STEPS], np.uint8))
            labels.append(languages.index(lang))
    return np.array(rows, np.uint8).reshape(-1, STEPS), np.array(labels, np.int64)


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> Network | None:
    """The network trained on a bounded sample of the training documents; None without any."""
    prepare(docs.sparkSession)
    own = docs.select(docs[key].alias("doc_id"), docs[text].cast("string").alias("text"), docs[lang].cast("string").alias("lang"))
    usable = own.where((bucket("doc_id", FOLDS) != 0) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    begin = F.pmod(F.xxhash64("doc_id"), F.greatest(F.length("text") - SEGMENT, F.lit(1)).cast("long")) + 1
    rows = usable.select("lang", F.xxhash64("doc_id", F.lit("order")).alias("place"),
                         F.col("text").substr(begin.cast("int"), F.lit(SEGMENT)).alias("segment"))
    order = Window.partitionBy("lang").orderBy("place", "segment")
    picked = rows.withColumn("n", F.row_number().over(order)).where(F.col("n") <= FIT_DOCS).collect()  # FIT_DOCS a language
    sample = sorted((r["lang"], r["place"], r["segment"]) for r in picked)
    languages = sorted({s[0] for s in sample})
    if not languages:
        return None
    return Network(languages).fit(*windows_of([(t, lang) for lang, _, t in sample], languages))


PREDICTED = "doc_id long, held_out boolean, lang_pred string, score double"


def predict(docs: DataFrame, network: Network | None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every whole text."""
    prepare(docs.sparkSession)
    rows = docs.select(docs[key].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t or "" for t in batch.column(1).to_pylist()]
        known = [k for k, t in enumerate(texts) if network is not None and _LETTER.search(t)]
        langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if known:
            pooled = network.pooled([texts[k].encode() for k in known])
            for k, best, top in zip(known, pooled.argmax(1), pooled.max(1)):
                langs[k], scores[k] = network.languages[best], float(min(top, 1.0))
        ids = batch.column(0).to_pylist()
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([crc_bucket(i, FOLDS) == 0 for i in ids], pa.bool_()),
             pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
            ["doc_id", "held_out", "lang_pred", "score"])

    return map_batches(rows, run, PREDICTED)


def identify(docs: DataFrame) -> DataFrame:
    """Train on the training documents, predict all."""
    return predict(docs, fit(docs))
