"""Language-model scores: a log-bilinear model of token classes.

Tokens are lower-cased words and one end a document. The base model is the
smoothed unigram over all training tokens. The neural model predicts the class of
a token (each of the most frequent tokens, and one for all others) from the classes of the two before it: a context vector, the sum of a
matrix for each position times the vector of its class, is multiplied with every
class's vector; a class's bias is added. Within the class of all others tokens
keep their unigram shares, so log-probabilities are normalised over all tokens.

It is trained in numpy with noise-contrastive estimation (noise: class
frequencies) on the counts of class triples over all training documents:
shards of equal token counts (``SHARDS``, or more of at most ``SHARD_TOKENS``) are
trained by a task each, and their parameters are averaged (``FAN_IN`` at once) after each of ``ROUNDS``
rounds. The rounds together visit every training token once, small shards
more often. Classes grow as the square root of the counted
vocabulary, from ``CLASSES`` on, without a bound. Scores use the exact softmax:
normalisers of contexts come from batched matrix products, once a worker for
those of the ``MOST_CLASSES`` first classes and the class of all others, whose
tables take 67 MB; other contexts are normalised when a batch has them.

Counts cover all training documents. The ``HEAD`` most frequent tokens travel
to the tasks, the only thing sent there whole; counts of the others are joined by word.

Defined results: a null text is empty (the end token alone); with nothing to
learn from every token is unknown; repeated rows each give a row; an empty
table gives none. Only the named columns are read.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.llm.pretokens import white_words
from cinelake.llm.tables import bucket, map_batches, prepare, staged, texts, worker_cache

CLASSES, MOST_CLASSES, HEAD, SIZE = 255, 700, 1 << 17, 16
SHARDS, ROUNDS, STEPS, SAMPLES, NOISE = 12, 3, 20, 4096, 16
#: Scores that are normalised at once.
SCORES = 4096 * (MOST_CLASSES + 1)
#: Classes whose noise is taken in expectation, and those drawn a step for the others.
FIXED, DRAWN = 64, 48
#: Tokens that a shard holds at most, by which count a triple is dealt out to all shards, shards that are averaged at once.
SHARD_TOKENS, HEAVY, FAN_IN = 1 << 21, 64, 64
FOLDS, HELD_OUT = 5, 1

#: The end of a document as a token; no word has white space.
END = "\n"


class Tokens:
    """The tokens of a batch: distinct ones, places of all, and each text's first (and the end)."""

    def __init__(self, batch: list[str]):
        words, places, firsts = white_words(batch, lower=True)
        n = len(firsts) - 1
        self.words = [*words, END]
        self.firsts = firsts + np.arange(n + 1)
        self.places = np.insert(places, firsts[1:], len(words))


# -- the model ------------------------------------------------------------------------

class LogBilinear:
    """vectors, matrices of the two positions, output vectors and biases of the classes."""

    def __init__(self, shares: np.ndarray, size: int = SIZE, seed: int = 1):
        draw = np.random.default_rng(seed)
        n = len(shares)
        self.noise = shares / shares.sum()
        table = lambda *shape: draw.normal(0, 0.1, shape).astype(np.float32)
        self.params = {"r": table(n, size), "c1": table(size, size), "c2": table(size, size), "q": table(n, size),
                       "b": np.log(self.noise).astype(np.float32)}

    def context(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Context vectors; two: the class just before, one: the class before that."""
        p = self.params
        return (p["r"] @ p["c1"])[one] + (p["r"] @ p["c2"])[two]

    def train(self, triples: np.ndarray, counts: np.ndarray, seed: int, steps: int | None = None, samples: int = SAMPLES,
              noise: int = NOISE, rate: float = 0.1, turn: int = 0, turns: int = 1) -> LogBilinear:
        """Noise-contrastive steps (AdaGrad) on the tokens of one turn; the normaliser is
        taken as 1; later turns go in smaller steps. Every example has ``noise`` false tokens on average, shared by the step so that scores and
        gradients are matrix products: the ``FIXED`` most frequent classes count by their expected number,
        of the others ``DRAWN`` are drawn, each for an equal part of the rest."""
        draw, n, p = np.random.default_rng([seed, turn]), len(self.noise), self.params
        columns = np.ascontiguousarray(triples.T)
        sums = {k: np.full_like(v, 1e-8) for k, v in p.items()}
        order = np.argsort(-self.noise, kind="stable")
        fixed, rest = order[:FIXED], order[FIXED:]
        heap = np.cumsum(self.noise[rest])
        expected = (noise * self.noise[fixed] / samples).astype(np.float32)
        if len(rest):
            part = noise * heap[-1] / DRAWN / samples
            expected = np.append(expected, np.full(DRAWN, part, np.float32))
        offset = np.log(noise * self.noise).astype(np.float32)
        error = np.empty((samples, len(expected)), np.float32)  # one buffer for all steps
        for drawn in visits(counts, seed, turn, turns, steps, samples):
            one, two, word = (column[drawn] for column in columns)
            false = fixed
            if len(rest):
                places = np.searchsorted(heap, heap[-1] * (np.arange(DRAWN) + draw.random(DRAWN)) / DRAWN)
                false = np.append(fixed, rest[np.minimum(places, len(rest) - 1)])
            h, q, own, bias = self.context(one, two), p["q"][false], p["q"][word], p["b"] - offset
            np.matmul(h, q.T, out=error)
            error += bias[false]
            _sigmoid(error)
            error *= expected
            true = (_sigmoid((h * own).sum(axis=1) + bias[word]) - 1) / samples
            d_h = error @ q + true[:, None] * own
            d_q, d_b = _by_class(word, true[:, None] * h, n), np.bincount(word, true, n)
            np.add.at(d_q, false, error.T @ h)
            np.add.at(d_b, false, error.sum(axis=0))
            by_one, by_two = _by_class(one, d_h, n), _by_class(two, d_h, n)
            grads = {"q": d_q, "b": d_b, "c1": p["r"].T @ by_one, "c2": p["r"].T @ by_two,
                     "r": by_one @ p["c1"].T + by_two @ p["c2"].T}
            for k, g in grads.items():
                sums[k] += g * g
                p[k] -= rate / (1 + turn) * g / np.sqrt(sums[k])
        return self

    def normalisers(self, block: int = 4096, side: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Vectors of all contexts of the first ``side`` classes (one * side + two; all
        classes if not given) and the logs of their softmax sums, block by block."""
        n = side or len(self.noise)
        return self.normalised(np.arange(n * n), n, block)

    def normalised(self, codes: np.ndarray, width: int, block: int = 4096) -> tuple[np.ndarray, np.ndarray]:
        """Vectors and logs of the softmax sums of contexts, as one * width + two."""
        block = max(1, min(block, SCORES // len(self.noise)))
        vectors, logs = np.empty((len(codes), self.params["q"].shape[1]), np.float32), np.empty(len(codes))
        for k in range(0, len(codes), block):
            at, own = slice(k, k + block), codes[k:k + block]
            vectors[at] = self.context(own // width, own % width)
            scores = vectors[at] @ self.params["q"].T + self.params["b"]
            top = scores.max(1)
            logs[at] = top + np.log(np.exp(scores - top[:, None]).sum(1))
        return vectors, logs

    def looked_up(self, tables: tuple[np.ndarray, np.ndarray], one: np.ndarray,
                  two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Vectors and logs of contexts, from the tables of the first classes or made here, each context once."""
        vectors, logs = tables
        side, width = math.isqrt(len(logs)), len(self.noise)
        far = np.flatnonzero((one >= side) | (two >= side))
        if not len(far):
            return vectors[one * side + two], logs[one * side + two]
        at = one * side + two
        at[far] = 0
        vectors, logs = vectors[at], logs[at]
        codes, places = np.unique(one[far] * width + two[far], return_inverse=True)
        own_vectors, own_logs = self.normalised(codes, width)
        vectors[far], logs[far] = own_vectors[places], own_logs[places]
        return vectors, logs

    def packed(self) -> bytes:
        return np.concatenate([v.ravel() for v in self.params.values()]).astype(np.float32).tobytes()

    def unpack(self, data: np.ndarray) -> LogBilinear:
        at = 0
        for k, v in self.params.items():
            self.params[k] = data[at:at + v.size].reshape(v.shape).astype(np.float32)
            at += v.size
        return self


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place."""
    np.negative(x, out=x)
    with np.errstate(over="ignore"):
        np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def visits(counts: np.ndarray, seed: int, turn: int = 0, turns: int = 1, steps: int | None = None,
           samples: int = SAMPLES) -> Iterator[np.ndarray]:
    """Places of the triples of each step. The turns deal out all tokens in one
    random order; a turn takes steps for all of its own, STEPS at least."""
    order = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
    np.random.default_rng(seed).shuffle(order)
    own = order[turn::turns] if len(order) > turn else order
    for step in range(steps or max(STEPS, -(-len(own) // samples))):
        yield own[np.arange(step * samples, (step + 1) * samples) % len(own)]


def _by_class(classes: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sums of rows by class."""
    return np.stack([np.bincount(classes, rows[:, k], n) for k in range(rows.shape[1])], axis=1)


# -- counts -------------------------------------------------------------------------------

def _two(docs: DataFrame, text: str, key: str) -> DataFrame:
    prepare(docs.sparkSession)
    return docs.select(docs[key].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"))


def token_counts(rows: DataFrame) -> DataFrame:
    """(word, n) over (doc_id, text) rows."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        tokens = Tokens(texts(batch.column(1)))
        n = np.bincount(tokens.places, minlength=len(tokens.words))
        return pa.RecordBatch.from_arrays([pa.array(tokens.words, pa.string()), pa.array(n, pa.int64())], ["word", "n"])

    return map_batches(rows, run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Unigram:
    """Counts of the most frequent tokens and the base model's sizes. Classes in
    order: the first tokens by frequency (MOST_CLASSES at most), all others
    (``other``), the further tokens with a class of their own."""

    def __init__(self, head: list[tuple[str, int]], total: int, kinds: int):
        self.place = {w: k for k, (w, _) in enumerate(head)}
        self.counts = np.array([n for _, n in head] + [0], np.float64)  # last: not in the head
        self.total, self.kinds = total, kinds
        self.whole = total + 0.5 * (kinds + 1)
        self.logs = np.log10((self.counts + 0.5) / self.whole)
        self.own = min(max(CLASSES, math.isqrt(kinds) // 3), len(head))  # tokens with a class of their own
        self.other = min(MOST_CLASSES, self.own)  # the class of all other tokens
        self.width = self.own + 1
        shares = (self.counts[:self.own] + 0.5) / self.whole
        rest = 1 - shares.sum()
        self.shares = np.insert(shares, self.other, rest if rest > 1e-12 else 1e-12)
        self.end = min(self.place.get(END, self.other), self.other)

    def classify(self, tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
        """Head place (or len(head)) of distinct tokens, and classes of all."""
        head = np.fromiter((self.place.get(w, len(self.place)) for w in tokens.words), np.int64, len(tokens.words))
        classes = np.where(head < self.other, head, np.where(head < self.own, head + 1, self.other))
        return head, classes[tokens.places]

    def contexts(self, tokens: Tokens, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Classes two and one places before each token; before a text, its end."""
        one, two = np.full_like(classes, self.end), np.full_like(classes, self.end)
        two[1:], one[2:] = classes[:-1], classes[:-2]
        first = tokens.firsts[:-1]
        two[first], one[first] = self.end, self.end
        second = first[np.diff(tokens.firsts) > 1] + 1
        one[second] = self.end
        return one, two


def unigram(counts: DataFrame) -> Unigram:
    """From staged counts; the head is HEAD rows, or a row for each class where these are more."""
    sums = counts.agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds")).first()
    head = counts.orderBy(F.desc("n"), "word").limit(max(HEAD, math.isqrt(sums["kinds"]) // 3)).toArrow()
    return Unigram(list(zip(head.column("word").to_pylist(), head.column("n").to_pylist())), sums["total"] or 0, sums["kinds"])


def triples(rows: DataFrame, base: Unigram) -> DataFrame:
    """(triple, n): counts of three classes in a row, packed in one number."""
    width = base.width
    shared = rows.sparkSession.sparkContext.broadcast(base)  # HEAD tokens

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = shared.value
        tokens = Tokens(texts(batch.column(1)))
        _, classes = own.classify(tokens)
        one, two = own.contexts(tokens, classes)
        kinds, n = np.unique((one * width + two) * width + classes, return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(kinds, pa.int64()), pa.array(n, pa.int64())], ["triple", "n"])

    return map_batches(rows, run, "triple long, n long").groupBy("triple").agg(F.sum("n").alias("n"))


def dealt(counted: DataFrame, shards: int) -> DataFrame:
    """(triple, n, shard): a triple lies in one shard, a heavy one in all, so none holds many more tokens."""
    heavy = F.col("n") >= HEAVY * shards
    own = F.array(F.pmod(F.xxhash64("triple"), F.lit(shards)).cast("int"))
    at = F.when(heavy, F.sequence(F.lit(0), F.lit(shards - 1))).otherwise(own)
    part = F.expr(f"n div {shards} + if(shard < n % {shards}, 1, 0)")
    return counted.select("triple", "n", F.explode(at).alias("shard")).select(
        "triple", F.when(heavy, part).otherwise(F.col("n")).alias("n"), "shard")


_TRAINED = "shard int, n long, params binary"


def _trained(shard: int, params: bytes, n: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([n], pa.int64()), pa.array([params], pa.binary())],
                                      ["shard", "n", "params"])


def _average(parts: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, int]:
    """Parameters averaged by tokens, and the tokens."""
    total, whole = sum(n for _, n, _ in parts), 0.0
    for _, n, params in parts:
        whole = whole + np.frombuffer(params, np.float32) * (n / total)
    return whole, total


def _averaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A model for each run of equal shard numbers, one batch in memory at a time."""
    shard, n, whole = None, 0, 0.0
    for batch in batches:
        for own, more, params in zip(*(c.to_pylist() for c in batch.columns)):
            if shard is not None and own != shard:
                yield _trained(shard, (whole / n).astype(np.float32).tobytes(), n)
                n, whole = 0, 0.0
            shard, n, whole = own, n + more, whole + np.frombuffer(params, np.float32) * float(more)
    if shard is not None:
        yield _trained(shard, (whole / n).astype(np.float32).tobytes(), n)


def fit(counted: DataFrame, base: Unigram) -> LogBilinear:
    """Rounds of training, a task each shard of the staged triples, parameters averaged by tokens."""
    model, width = LogBilinear(base.shares), base.width
    number = max(SHARDS, -(-base.total // SHARD_TOKENS))
    shards = staged(dealt(counted, number), "triples").repartitionById(number, F.col("shard")).sortWithinPartitions("triple")
    for turn in range(ROUNDS):
        now, shares = model.packed(), base.shares

        def run(batches, turn=turn, now=now):
            parts = [[c.to_numpy() for c in b.columns] for b in batches if b.num_rows]
            if parts:
                code, n, shard = (np.concatenate(c) for c in zip(*parts))
                rows = np.stack([code // (width * width), code // width % width, code % width], axis=1).astype(np.int32)
                own = LogBilinear(shares).unpack(np.frombuffer(now, np.float32)).train(rows, n, int(shard[0]), turn=turn, turns=ROUNDS)
                yield _trained(int(shard[0]), own.packed(), int(n.sum()))

        made, left = shards.mapInArrow(run, _TRAINED), number
        while left > FAN_IN:
            left = -(-left // FAN_IN)
            made = made.withColumn("shard", F.expr(f"shard div {FAN_IN}").cast("int")).repartition(left, "shard") \
                .sortWithinPartitions("shard", "n", "params").mapInArrow(_averaged, _TRAINED)
        parts = [(r["shard"], r["n"], bytes(r["params"])) for r in made.collect()]  # FAN_IN models at most
        if parts:
            model.unpack(_average(sorted(parts))[0])
    return model


# -- scores -----------------------------------------------------------------------------------

def _tables(shared) -> tuple:
    """Context vectors and normalisers of the first classes, once a worker and model."""
    base, model, name = shared.value
    return worker_cache(name, lambda: model.normalisers(side=base.other + 1))


_PARTS = ("row long, doc_id long, n_tokens long, n_known long, base double, model double, word string, times int")


def _partial(rows: DataFrame, shared) -> DataFrame:
    """Of each text a row of sums over head tokens, and a row for each distinct
    other token. ``model`` lacks the base logs of tokens that are not in the head."""
    def run(batches):
        number = TaskContext.get().partitionId() << 33
        base, model, _ = shared.value
        tables = _tables(shared)
        out, bias = model.params["q"], model.params["b"]
        rest = np.log10(base.shares[base.other])
        for batch in batches:
            tokens = Tokens(texts(batch.column(1)))
            n = batch.num_rows
            head, classes = base.classify(tokens)
            one, two = base.contexts(tokens, classes)
            vectors, logs = model.looked_up(tables, one, two)
            found = np.einsum("td,td->t", vectors, out[classes]) + bias[classes] - logs
            place = head[tokens.places]
            inside = place < len(base.place)
            own = np.where(inside, base.logs[place], 0.0)
            found = found / np.log(10) + np.where(classes == base.other, own - rest, 0.0)
            text = np.repeat(np.arange(n), np.diff(tokens.firsts))
            add = lambda values: np.bincount(text, values, n)
            ids = batch.column(0).to_pylist()
            tail, times = np.unique(text[~inside] * len(tokens.words) + tokens.places[~inside], return_counts=True)
            whose, which = tail // len(tokens.words), tail % len(tokens.words)
            rows_of = [*range(number, number + n), *(number + whose).tolist()]
            pad = [None] * len(tail)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows_of, pa.int64()), pa.array(ids + pad, pa.int64()),
                 pa.array(np.diff(tokens.firsts).tolist() + pad, pa.int64()),
                 pa.array(add(inside.astype(float)).astype(np.int64).tolist() + pad, pa.int64()),
                 pa.array(add(own).tolist() + pad, pa.float64()), pa.array(add(found).tolist() + pad, pa.float64()),
                 pa.array([None] * n + [tokens.words[k] for k in which], pa.string()),
                 pa.array([None] * n + times.tolist(), pa.int32())],
                ["row", "doc_id", "n_tokens", "n_known", "base", "model", "word", "times"])
            number += n

    return rows.mapInArrow(run, _PARTS)


def score(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every text."""
    rows = _two(docs, text, key)
    learned = rows.where(bucket("doc_id", FOLDS) != HELD_OUT)
    counts = staged(token_counts(learned), "token-counts")
    base = unigram(counts)
    model = fit(triples(learned, base), base)
    shared = docs.sparkSession.sparkContext.broadcast((base, model, uuid.uuid4().hex))
    parts = staged(_partial(rows, shared), "score-parts")
    tail = parts.where("word is not null").select("row", "word", "times").join(counts, "word", "left")
    known = F.coalesce("n", F.lit(0))
    logs = F.log10((known + 0.5) / F.lit(base.whole)) if base.whole else F.lit(0.0)
    sums = tail.groupBy("row").agg(F.sum(F.when(known > 0, F.col("times")).otherwise(0)).alias("tail_known"),
                                   F.sum(F.col("times") * logs).alias("tail_base"),
                                   F.sum("times").alias("tail_times"))
    whole = parts.where("word is null").drop("word", "times").join(sums, "row", "left")
    more = lambda name: F.coalesce(F.col(name), F.lit(0))
    return whole.select("doc_id", (bucket("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "n_tokens",
                        (F.col("n_known") + more("tail_known")).cast("long").alias("n_known"),
                        F.lit(base.total).cast("long").alias("train_tokens"),
                        (F.col("base") + more("tail_base")).alias("base_score"),
                        (F.col("model") + more("tail_base")).alias("score"))
