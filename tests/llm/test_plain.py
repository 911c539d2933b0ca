"""Fitted models applied text by text in plain Python: operators 2, 7, 8 and 10, and the pipeline's rows."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cinelake.llm import decontaminate, langid, lm, quality_classifier, quality_rules, simhash, textstats
from cinelake.llm.registry import QUERIES
from cinelake.llm.tables import bucket, read, staged

from cases import SF001, SF01

SF1 = "/root/testdata/sf0.1"
WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def bare(word):
    return word.strip(".,;:!?\"'()[]#*$%&|<>").lower()


def counts_of(text):
    """The counts that rules and labellers use, by their names."""
    words = WORD.findall(text)
    lines = [row for row in text.split("\n") if WORD.search(row)] if words else []
    windows = [tuple(words[k:k + 5]) for k in range(len(words) - 4)]
    seen = Counter(windows)
    covered = {p for k, w in enumerate(windows) if seen[w] > 1 for p in range(k, k + 5)}
    rude = [bare(w) for w in words if bare(w) in textstats.INSULTS]
    return {"n_words": len(words), "word_chars": sum(map(len, words)),
            "n_symbols": sum(c in "#*$%&|<>" for c in text) if words else 0, "n_lines": len(lines),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
            "n_upper": sum(w.isupper() and len(w) > 3 for w in words), "n_echo": sum(a == b for a, b in zip(words, words[1:])),
            "n_distinct": len(set(words)), "n_noisy": sum(w[-1] in "#*$%&|<>" for w in words),
            "n_short": sum(len(w) < 4 for w in words), "n_marks": sum(c in "!?" for c in text) if words else 0,
            "n_insults": len(rude), "n_insult_kinds": len(set(rude))}


def summed(model, text):
    """Weights of a text's distinct hashed words."""
    return sum(model.weights.get(s, 0.0) for s in {zlib.crc32(bare(w).encode()) for w in WORD.findall(text)})


def plain_score(model, text):
    """The scorer's probability that a text is bad."""
    counts = counts_of(text)
    fired = [bool(rule(counts)) for rule in quality_classifier.LABELLERS.values()]
    fired += [summed(model.word_model, text) >= level for level in quality_classifier.WORD_LEVELS]
    logit = model.scorer.bias + summed(model.scorer, text)
    logit += sum(model.scorer.weights.get(s, 0.0) for s, f in zip(quality_classifier.VOTE_SLOTS, fired) if f)
    return 1 / (1 + math.exp(-max(-60, min(60, logit))))


def plain_verdict(adopted, words, text, lang):
    """Whether base rules and learned rules keep a text."""
    counts = counts_of(text) | {"one": 1}
    counts["word_score"] = summed(words, text)
    if counts["n_words"] < 10 or 100 * counts["n_repeat_words"] > 20 * counts["n_words"]:
        return False
    for rule, cut in adopted.get(quality_rules.OTHER if lang is None else lang, []):
        top, bottom, _ = quality_rules.RULES[rule]
        if counts[top] / max(counts[bottom], 1) >= cut:
            return False
    return True


def rules_of(docs, labels):
    words = quality_rules.word_model(docs, labels)
    return quality_rules.cutoffs(staged(quality_rules.stats(docs, words=words), "test-counts"), labels), words


def rows_of(docs):
    return {r["doc_id"]: (r["text"] or "", r["lang"]) for r in docs.collect()}


def test_op2_verdicts(spark):
    """On a table large enough for rules to be adopted."""
    docs, labels = read(spark, SF1, "documents"), read(spark, SF1, "labels")
    adopted, words = rules_of(docs, labels)
    assert any(adopted.values())
    want = {i: plain_verdict(adopted, words, text, lang) for i, (text, lang) in rows_of(docs).items()}
    assert {r["doc_id"]: r["kept"] for r in QUERIES["op2_quality_rules"](spark, SF1).collect()} == want
    kept = quality_rules.keep_good(docs, labels).collect()
    assert {r["doc_id"] for r in kept} == {i for i, stays in want.items() if stays}


def test_op7_scores_and_verdicts(spark):
    docs, labels = read(spark, SF01, "documents"), read(spark, SF01, "labels")
    model = quality_classifier.fit(docs, labels)
    want = {i: plain_score(model, text) for i, (text, _) in rows_of(docs).items()}
    got = {r["doc_id"]: (r["score"], r["kept"]) for r in QUERIES["op7_quality_classifier"](spark, SF01).collect()}
    assert got.keys() == want.keys() and 0 < sum(not k for _, k in got.values()) < len(got)
    for i, score in want.items():
        assert got[i][0] == pytest.approx(score, abs=1e-9) and got[i][1] == (score < quality_classifier.THRESHOLD)


def test_op8_scores(spark):
    """Every token's class by the whole softmax, one context at a time."""
    docs = read(spark, SF001, "documents")
    rows = lm._two(docs, "text", "doc_id")
    learned = rows.where(bucket("doc_id", 5) != 1)
    base = lm.unigram(staged(lm.token_counts(learned), "test-token-counts"))
    model = lm.fit(lm.triples(learned, base), base)
    p = {k: v.astype(float) for k, v in model.params.items()}
    counts = Counter(w for i, (text, _) in rows_of(docs).items() if zlib.crc32(str(i).encode()) % 5 != 1
                     for w in [*WORD.findall(text.translate(LOWER)), lm.END])
    total, kinds = sum(counts.values()), len(counts)
    frequent = sorted(counts, key=lambda w: (-counts[w], w))[:base.other]
    cls = {w: k for k, w in enumerate(frequent)}
    rest = sum(counts[w] + 0.5 for w in counts.keys() - cls.keys()) + 0.5  # and the unknown
    share = 1 - sum((counts[w] + 0.5) / (total + 0.5 * (kinds + 1)) for w in frequent)
    assert share * (total + 0.5 * (kinds + 1)) == pytest.approx(rest)
    softmax: dict[tuple[int, int], np.ndarray] = {}

    def log_classes(one, two):
        if (one, two) not in softmax:
            scores = p["q"] @ (p["r"][one] @ p["c1"] + p["r"][two] @ p["c2"]) + p["b"]
            softmax[one, two] = scores - scores.max() - np.log(np.exp(scores - scores.max()).sum())
        return softmax[one, two]

    def plain(text):
        one = two = cls.get(lm.END, base.other)
        out = 0.0
        for w in [*WORD.findall(text.translate(LOWER)), lm.END]:
            k = cls.get(w, base.other)
            out += log_classes(one, two)[k] / math.log(10)
            if k == base.other:
                out += math.log10((counts[w] + 0.5) / rest)
            one, two = two, k
        return out

    got = {r["doc_id"]: r["score"] for r in QUERIES["op8_lm"](spark, SF001).collect()}
    for i, (text, _) in rows_of(docs).items():
        assert got[i] == pytest.approx(plain(text), rel=1e-4)


def plain_probabilities(network, data):
    """Mean language probabilities of a text's bytes, a state at a time."""
    p, h = {k: v.astype(float) for k, v in network.params.items()}, network.hidden
    logistic = lambda x: 1 / (1 + np.exp(-x))
    whole = np.zeros(len(network.languages))
    for k in range(0, len(data), langid.STEPS):
        window = data[k:k + langid.STEPS]
        padded = window + bytes(langid.STEPS - len(window))
        states = []
        for side, order in enumerate((range(langid.STEPS), range(langid.STEPS - 1, -1, -1))):
            state, made = np.zeros(h), {}
            for t in order:
                inputs, own = p[f"w{side}"][padded[t]], state @ p[f"u{side}"]
                update, reset = logistic(inputs[:h] + own[:h]), logistic(inputs[h:2 * h] + own[h:2 * h])
                candidate = np.tanh(inputs[2 * h:] + reset * own[2 * h:])
                state = made[t] = update * state + (1 - update) * candidate
            states.append(made)
        for t in range(len(window)):
            scores = np.exp(np.concatenate([states[0][t], states[1][t]]) @ p["out"] + p["bias"])
            whole += scores / scores.sum()
    return whole / len(data)


def test_op10_languages_and_scores(spark):
    docs = read(spark, SF001, "documents")
    network = langid.fit(docs)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in QUERIES["op10_langid"](spark, SF001).collect()}
    for i, (text, _) in rows_of(docs).items():
        if not any(c.isalpha() for c in text):
            assert got[i] == ("und", 0.0)
            continue
        want = plain_probabilities(network, text.encode())
        assert got[i][1] == pytest.approx(want.max(), abs=1e-3)
        assert want[network.languages.index(got[i][0])] == pytest.approx(want.max(), abs=1e-3)


def test_pipeline_rows(spark):
    """Verdict after verdict by the plain forms; token digests by the tokenizers library."""
    import corpus_pipeline
    labels, docs = read(spark, SF001, "labels"), read(spark, SF001, "documents")
    only = lambda ids: docs.where(docs.doc_id.isin(sorted(ids)))
    model = quality_classifier.fit(docs, labels)
    left = {i for i, (text, _) in rows_of(docs).items() if plain_score(model, text) < quality_classifier.THRESHOLD}
    adopted, words = rules_of(only(left), labels)
    left = {i for i, (text, lang) in rows_of(only(left)).items() if plain_verdict(adopted, words, text, lang)}
    prints = sorted((i, simhash.fingerprint(text)) for i, (text, _) in rows_of(only(left)).items())
    first = {i: i for i, _ in prints}
    for _ in prints:  # the smallest id passes on along links until nothing changes
        before = dict(first)
        for i, a in prints:
            first[i] = min(first[j] for j, b in prints if (a ^ b).bit_count() <= 2)
        if first == before:
            break
    left = {i for i in left if first[i] == i}
    leaks = {r["doc_id"] for r in decontaminate.matches(only(left), read(spark, SF001, "benchmark")).collect()}
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = set()
    for i, (text, _) in rows_of(only(left - leaks)).items():
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        want.add((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()))
    rows = corpus_pipeline.run(spark, SF001).select("doc_id", "n_tokens", "ids_sha256").collect()
    assert want and len(rows) == len(want) and {tuple(r) for r in rows} == want
