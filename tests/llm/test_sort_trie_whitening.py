"""Operators 11, 12 and 13 against brute force in plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from cinelake.llm import content_sort, prefix_trie, whitening
from cinelake.llm.registry import QUERIES
from cinelake.llm.tables import fresh_path

from cases import SF001

# -- content sort ------------------------------------------------------------------------


def groups_of(rows):
    """(doc_id, keep_id, size, kept, sha) of (doc_id, text) rows, sorted."""
    groups = defaultdict(list)
    for key, text in rows:
        groups[re.sub("[\x20\x09-\x0d]+", " ", text or "")].append(key)
    out = []
    for text, keys in groups.items():
        keys.sort(key=lambda k: (k is None, k))
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(k, keys[0], len(keys), at == 0, sha) for at, k in enumerate(keys)]
    return sorted(out, key=repr)


def as_rows(frame):
    return sorted((tuple(r) for r in frame.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=repr)


def test_content_sort_on_defined_cases(spark, odd, none):
    clashing = odd
    for name in ("hash", "head", "slice", "bytes", "place", "keep_id", "n", "crowded", "slices"):
        clashing = clashing.withColumn(name, odd["fp"])
    want = groups_of([(r["doc_id"], r["text"]) for r in odd.collect()])
    assert as_rows(content_sort.exact_duplicates(clashing)) == want
    assert content_sort.exact_duplicates(none).count() == 0


def test_content_sort_whole_table(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    want = groups_of([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert as_rows(QUERIES["op11_content_sort"](spark, SF001)) == want


def test_texts_with_very_many_copies_are_sliced(spark):
    """A third of all rows is one text; ids lie in no order, white space differs."""
    draw = random.Random(5)
    rows = [(draw.randrange(10_000), "one  passage" + "\t" * draw.randint(1, 3)) for _ in range(1500)]
    rows += [(draw.randrange(10_000), draw.choice("abcdefgh") * 40) for _ in range(1500)]
    rows += [(draw.randrange(10_000), f"x{k}") for k in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    counted = docs.select(content_sort.normalised("text").alias("bytes")).selectExpr("xxhash64(bytes) as hash")
    slices = [r["slices"] for r in content_sort._crowded(counted, len(rows)).collect()]
    assert len(slices) == 1 + 8 or max(slices) > 3  # the passage, whatever the letters' counts are
    assert as_rows(content_sort.exact_duplicates(docs)) == groups_of(rows)


def test_equal_beginnings_and_hashes_do_not_make_texts_equal(spark):
    rows = [(k, "the same beginning of all of these texts " + str(k % 5)) for k in range(400)]
    assert as_rows(content_sort.exact_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))) == groups_of(rows)


def test_content_sort_shuffles_texts_once(spark):
    """The runs' window takes the range partitioning as it is."""
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    plan = content_sort._runs(docs, "text", "doc_id")._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r" Exchange (\w+)", plan)) == 1 and "Exchange rangepartitioning" in plan
    assert len(re.findall(r"- (?:\*\(\d+\) )?Sort ", plan)) == 1


# -- prefix trie ------------------------------------------------------------------------------

def brute_trie(rows, block=None, heads=None):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((-math.inf if turn is None else turn, role or "", text or ""))
    own = {c: [(r, t) for _, r, t in sorted(found)] for c, found in turns.items()}
    paths = {}
    for c, found in own.items():
        h = zlib.crc32(str(c).encode()) % heads if block else 0
        base = c - int(math.fmod(c, block)) if block else c
        paths[c] = tuple([*own.get(base, [])[:h], *found[h:]])
    members = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    out = []
    for node, convs in members.items():
        under = [n for n in members if n[:len(node)] == node]
        ends = ",".join(map(str, sorted(c for c in convs if len(paths[c]) == len(node))))
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children[node]),
                    sum(not children[n] for n in under),
                    sum((len(members[n]) - 1) * len(n[-1][1]) for n in under if n), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def trie_rows(frame):
    return sorted((tuple(r) for r in frame.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()),
        key=repr)


CONVERSATION = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("members", [prefix_trie.MEMBERS, 2, 1000])
def test_trie_of_random_conversations(spark, monkeypatch, members):
    """Few distinct turns, so prefixes are shared; shards of every size."""
    monkeypatch.setattr(prefix_trie, "MEMBERS", members)
    monkeypatch.setattr(prefix_trie, "BLOCK", 3)
    draw = random.Random(members)
    rows = [(c, t, draw.choice(["user", "assistant"]), draw.choice(["", "a", "bb", "ccc"]))
            for c in draw.sample(range(600), 150) for t in range(draw.choice([1, 2, 3, 5, 9]))]
    rows += [(c, t, "user", "hot") for c in range(1000, 1100) for t in range(3)]
    rows += [(77_777, t, "user", "long") for t in range(300)]
    given = spark.createDataFrame(rows, CONVERSATION).repartition(5)
    assert trie_rows(prefix_trie.trie(given)) == brute_trie(rows)
    assert trie_rows(prefix_trie.trie(given, 100, 6)) == brute_trie(rows, 100, 6)


def test_trie_of_defined_cases(spark):
    rows = [(1, 2, "user", "b"), (1, None, "user", "first"), (1, 2, "user", "a"), (1, 2, None, None), (1, 2, "user", "b"),
            (2, 0, "user", "z" * 100_000), (3, 0, None, ""), (None, 0, "user", "x"), (-105, 0, "user", "n"), (-7, 1, "a", "中文"),
            (5, None, None, None), (5, 0, "user", "</turn>")]
    for name in ("key", "parent", "base"):
        assert name not in CONVERSATION
    given = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], CONVERSATION + ", key long, parent long, base long")
    assert trie_rows(prefix_trie.trie(given, 100, 6)) == brute_trie(rows, 100, 6)
    assert prefix_trie.trie(given.where("false"), 100, 6).count() == 0


def test_trie_whole_table(spark):
    table = spark.read.parquet(f"{SF001}/conversations.parquet")
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in table.collect()]
    assert trie_rows(QUERIES["op12_prefix_trie"](spark, SF001)) == brute_trie(rows, 100, 6)


def test_a_spilled_queue_gives_messages_in_order(spark):
    draw, queue = random.Random(1), prefix_trie.SpillingQueue(fresh_path(spark, "queue"), limit=5)
    sent = [(draw.randrange(4), draw.randrange(3), draw.randrange(100)) for _ in range(200)]
    for message in sent:
        queue.push(message)
    assert queue.spilled > 10
    got = [m for least in sorted({m[:2] for m in sent}) for m in queue.pop(least)]
    assert got == sorted(sent)


def test_time_forward_with_a_queue_that_spills(spark):
    draw = random.Random(2)
    parent = [None] + [draw.randrange(k) for k in range(1, 300)]
    depth = [0] * 300
    for k in range(1, 300):
        depth[k] = depth[parent[k]] + 1
    gain = [draw.randrange(10) for _ in parent]
    name = lambda k: None if k is None else k.to_bytes(2, "big")
    nodes = sorted(((name(k), name(parent[k]), depth[k], k, 1, k == 0, gain[k], 0, 0) for k in range(300)),
                   key=lambda n: (-n[2], n[0]))
    queue = prefix_trie.SpillingQueue(fresh_path(spark, "queue"), limit=4)
    got = {row[3]: row[5:] for row in prefix_trie.time_forward(iter(nodes), queue)}
    assert queue.spilled and len(got) == 300
    for k in reversed(range(300)):
        below = [c for c in range(300) if parent[c] == k]
        assert got[k] == (len(below), sum(got[c][1] for c in below) or 1, gain[k] + sum(got[c][2] for c in below))


# -- whitening ------------------------------------------------------------------------------------

def test_polynomial_of_matrices_known(spark):
    draw = np.random.default_rng(3)
    for size in (1, 2, 3, 7):
        m = draw.integers(-50, 50, (size, size)).astype(object)
        m = m + m.T
        residues = {p: whitening.polynomial_modulo(m, p).tolist() for p in whitening.primes(whitening.coefficient_bits(m))}
        found = whitening.remaindered(residues)
        want = np.poly(m.astype(float))[::-1]
        assert found[-1] == 1 and np.allclose(np.array(found, float), want, rtol=1e-6, atol=1e-3 * np.abs(want).max())
    block = np.zeros((4, 4), object)  # Hessenberg form needs swaps, and has zeros beneath the diagonal
    block[0, 3] = block[3, 0] = 5
    found = whitening.remaindered({p: whitening.polynomial_modulo(block, p).tolist() for p in whitening.primes(60)})
    assert found == [0, 0, -25, 0, 1]


def test_primes_are_the_largest():
    got = whitening.primes(60, below=1000)
    assert got == [p for p in range(999, 2, -1) if all(p % q for q in range(2, p))][:len(got)]
    assert math.prod(got).bit_length() > 60


def test_roots_with_multiplicity():
    poly = [1]
    for root in (0, 0, 3, 3, 3, 7, 10, 10):  # (t - root) each
        poly = [(-root * a) + b for a, b in zip([*poly, 0], [0, *poly])]
    one = 1 << whitening.BITS
    assert whitening.Roots(poly).largest(8) == [r * one for r in (10, 10, 7, 3, 3, 3)]
    assert whitening.Roots([-2, 0, 1]).largest(8) == [math.isqrt(2 << (2 * whitening.BITS)) + 1]  # the root of 2


def white(frame):
    return frame.orderBy("vec_id", "component").collect()


def check_whitening(spark, rows, got, least=1):
    """Against numpy: rows are (id, vector) that shall remain."""
    x = np.floor(np.array([v for _, v in rows], float) * 1024) + 100_000
    n, size = x.shape
    centred = x - x.mean(axis=0)
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:8]
    number = int((values[order] > values.max() * 1e-9).sum())
    assert len(got) == n * number and number >= least
    assert [r["component"] for r in got[:number]] == list(range(1, number + 1))
    sums = [int(s) for s in x.astype(np.int64).astype(object).sum(axis=0)]
    for k, (key, _) in enumerate(rows):
        own = got[k * number:(k + 1) * number]
        deviation = sum((n * int(v) - s) ** 2 for v, s in zip(x[k], sums))
        assert all(r["vec_id"] == key and r["n"] == n and r["deviation"] == deviation for r in own)
    w = np.array([r["whitened"] for r in got]).reshape(n, number)
    assert np.abs(w.T @ w / n - np.eye(number)).max() < 1e-9 and got[0]["identity_error"] < 1e-9
    assert np.allclose([r["explained"] for r in got[:number]], values[order][:number] / values.sum(), rtol=1e-9)
    return w, centred @ vectors[:, order[:number]] / np.sqrt(values[order][:number])


def test_whitening_against_numpy(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in
            spark.read.parquet(f"{SF001}/embeddings.parquet").orderBy("vec_id").collect()]
    w, want = check_whitening(spark, rows, white(QUERIES["op13_whitening"](spark, SF001)), 8)
    assert np.allclose(w * np.sign((w * want).sum(axis=0)), want, atol=1e-6)


def test_whitening_of_defined_cases(spark):
    draw = random.Random(4)
    good = [(k, [draw.gauss(0, 1), draw.gauss(0, 3), draw.gauss(0, 1), 0.25]) for k in range(40)]
    good += [(100, [1.0, 2.0, 3.0, 4.0]), (101, [1.0, 2.0, 3.0, 4.0])]
    bad = [(200, None), (201, []), (202, [1.0, None, 2.0, 3.0]), (203, [float("nan")] * 4), (204, [math.inf, 0.0, 0.0, 0.0]),
           (205, [1.0, 2.0]), (206, [1e30, 0.0, 0.0, 0.0])]
    given = spark.createDataFrame([(*r, 1, 2) for r in good + bad],
                                  "vec_id long, embedding array<double>, white int, vector int").repartition(3)
    check_whitening(spark, good, white(whitening.whiten(given)), 4)
    assert whitening.whiten(given.where("false")).count() == 0
    assert whitening.whiten(given.where("vec_id in (100, 101)")).count() == 0  # no variance
    twice = whitening.whiten(given.where("vec_id < 200").unionByName(given.where("vec_id = 7")))
    assert twice.where("vec_id = 7").count() == 8
    only = spark.createDataFrame([(None, [1.0]), (None, [2.0])], "vec_id long, embedding array<float>")
    assert sorted(r["whitened"] for r in whitening.whiten(only).collect()) == [-1.0, 1.0]


def test_equal_and_nearly_equal_roots_give_orthogonal_components(spark):
    rows = [(k, [float(k == j) - float(k - 4 == j) for j in range(4)]) for k in range(8)]  # all directions alike
    check_whitening(spark, rows, white(whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))), 4)
    near = [(k, [v * (1 + 2.0 ** -10 * (j == 0)) for j, v in enumerate(r)]) for k, r in rows]
    check_whitening(spark, near, white(whitening.whiten(spark.createDataFrame(near, "vec_id long, embedding array<double>"))), 4)


def test_values_beyond_doubles_stay_exact(spark):
    draw = random.Random(6)
    rows = [(k, [draw.gauss(0, 1) * 1e9, draw.gauss(0, 1)]) for k in range(12)]
    got = white(whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")))
    x = [[math.floor(1024 * c) + 100_000 for c in v] for _, v in rows]
    sums = [sum(c) for c in zip(*x)]
    want = [sum((12 * a - s) ** 2 for a, s in zip(v, sums)) for v in x]
    assert [r["deviation"] for r in got[::2]] == [w if w < 1 << 63 else None for w in want]
    assert got[0]["identity_error"] < 1e-9
