"""Operators 2 and 7: counts against brute force, guarantees, held-out accuracy."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from cinelake.llm import quality_classifier, quality_rules, textstats
from cinelake.llm.registry import QUERIES

from cases import SF001, SF01

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[k:k + 5]) for k in range(len(words) - 4)]
    seen, covered, lines, dups = Counter(windows), set(), set(), 0
    for k, w in enumerate(windows):
        if seen[w] > 1:
            covered.update(range(k, k + 5))
    for line in text.split("\n"):
        if WORD.search(line):
            dups += line in lines
            lines.add(line)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text) if words else 0, dups, len(covered))


def base_failed(counts):
    return counts[0] < 10 or 100 * counts[4] > 20 * counts[0]


def test_op2_counts_and_base_verdict(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    got = {r["doc_id"]: r for r in QUERIES["op2_quality_rules"](spark, SF01).collect()}
    assert got.keys() == docs.keys()
    for i, text in docs.items():
        want = brute(text)
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == base_failed(want) and not (r["base_failed"] and r["kept"])


@pytest.mark.parametrize("k,n,p", [(0, 10, 0.1), (3, 50, 0.05), (9, 10, 0.5), (40, 4000, 0.02), (0, 1, 0.3)])
def test_binomial_tail_is_exact(k, n, p):
    want = sum(math.comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(k + 1))
    assert quality_rules.binomial_tail(k, n, p) == pytest.approx(want, rel=1e-9)
    assert quality_rules.binomial_tail(n, n, p) == 1


def labelled_texts(spark, good, bad, loose):
    """good plain texts, bad ones full of symbols, and ``loose`` good ones full of them too."""
    plain, noisy = ("every morning the old baker walked along quiet streets to his shop {} {} {}",
                    "### $$ %% ## ** && || << >> ++ -- {} {} {}")
    rows = [(i, (plain if i < good else noisy).format(i, i + 1, i + 2), "en" if i % 2 else "fr") for i in range(good + bad + loose)]
    labels = [(i, int(i < good or i >= good + bad), 0) for i in range(good + bad + loose)]
    return (spark.createDataFrame(rows, "doc_id long, text string, lang string"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_cutoffs_are_adopted_only_when_the_holdout_allows(spark):
    docs, labels = labelled_texts(spark, 2400, 300, 0)
    adopted = quality_rules.cutoffs(quality_rules.stats(docs), labels)
    assert any(rule == "symbols" for rule, _ in adopted["en"]) and adopted["fr"] and not adopted["(other)"]
    kept = quality_rules.judge(docs, labels).where("kept")
    assert kept.count() == 2400 == kept.where("doc_id < 2400").count()
    few, own = labelled_texts(spark, 60, 20, 0)
    assert not any(quality_rules.cutoffs(quality_rules.stats(few), own).values())


def test_a_rule_that_rejects_too_many_good_documents_is_not_adopted(spark):
    docs, labels = labelled_texts(spark, 2000, 4000, 150)  # 7 % of the good ones look bad
    adopted = quality_rules.cutoffs(quality_rules.stats(docs), labels)
    counted = quality_rules.labelled(quality_rules.stats(docs), labels).where("good")
    lost = counted.where(~quality_rules.kept(adopted) & ~quality_rules.base_failed()).count()
    assert lost <= 0.02 * counted.count()


def test_rules_on_odd_texts(spark, odd, none):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, None), (None, 1, 1), (4, None, None)], "doc_id long, quality int, toxic int")
    rows = quality_rules.judge(odd, labels).collect()
    want = Counter((r["doc_id"], *brute(r["text"])) for r in odd.collect())
    assert Counter(tuple(r)[:6] for r in rows) == want
    assert all(r["base_failed"] == base_failed(tuple(r)[1:6]) for r in rows)
    assert quality_rules.judge(none, labels.where("false")).count() == 0
    assert quality_rules.keep_good(none, labels.where("false")).count() == 0
    kept = quality_rules.keep_good(odd, labels)
    assert kept.columns == odd.columns
    judged = [r["doc_id"] for r in rows if r["kept"]]
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(judged)


def test_text_counts_of_long_and_plain_texts():
    found = textstats.counts(textstats.Texts([None, "Idiot! you idiot, CLOWN## ab ab"]))
    named = dict(zip(textstats.COUNTS, found[1].tolist()))
    assert not found[0].any()
    assert (named["n_insults"], named["n_insult_kinds"], named["n_echo"], named["n_noisy"]) == (3, 2, 1, 1)
    assert (named["n_upper"], named["n_distinct"], named["n_marks"]) == (1, 5, 1)


def test_label_model_finds_the_accuracies():
    draw = np.random.default_rng(3)
    bad = draw.random(20_000) < 0.3
    rates = np.array([[0.02, 0.05, 0.01], [0.7, 0.6, 0.4]])
    votes = (draw.random((20_000, 3)) < rates[bad.astype(int)]).astype(float)
    kinds, counts = np.unique(votes, axis=0, return_counts=True)
    model = quality_classifier.LabelModel(3, 200).fit(kinds, counts.astype(float), np.full(len(kinds), -1.0))
    assert np.abs(model.fires - rates).max() < 0.06 and abs(model.bad - 0.3) < 0.05


def test_op7_rejects_bad_documents_that_were_not_labelled(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    labels = spark.read.parquet(f"{SF01}/labels.parquet").toPandas()
    bad = dict(zip(labels.doc_id, (labels.quality == 0) | (labels.toxic == 1)))
    half = spark.createDataFrame(labels[labels.doc_id % 2 == 0])
    got = {r["doc_id"]: r["kept"] for r in quality_classifier.classify(docs, half).collect()}
    assert len(got) == docs.count()
    held = [(bad[i], got[i]) for i in bad if i % 2]
    lost = sum(not b and not k for b, k in held)
    caught = sum(b and not k for b, k in held) / sum(b for b, _ in held)
    assert lost <= 0.02 * len(held) and caught > 0.75


def test_classifier_on_odd_texts(spark, odd, none):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = quality_classifier.classify(odd, labels).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(r["doc_id"] for r in odd.collect())
    assert all(0 <= r["score"] <= 1 and r["kept"] == (r["score"] < quality_classifier.THRESHOLD) for r in rows)
    assert quality_classifier.classify(none, labels).count() == 0
    assert quality_classifier.keep_good(none, labels).count() == 0
    kept = quality_classifier.keep_good(odd, labels)
    assert kept.columns == odd.columns and kept.count() == sum(r["kept"] for r in rows)


def test_op7_gives_every_document_a_verdict(spark):
    rows = QUERIES["op7_quality_classifier"](spark, SF001)
    assert rows.count() == spark.read.parquet(f"{SF001}/documents.parquet").count()


def test_languages_without_a_stratum_meet_no_learned_rule(spark):
    """70 languages: those beyond the strata keep all that passes the base rules."""
    from cinelake.llm import quality_rules as rules
    from pyspark.sql import functions as F
    named = [f"l{k}" for k in range(64)]
    rows = spark.createDataFrame([(f"l{k}",) for k in range(70)] + [(None,)], "stratum string")
    got = {r[0]: r[1] for r in rows.select("stratum", rules.stratum_of([*named, rules.OTHER]).alias("s")).collect()}
    assert all(got[f"l{k}"] == f"l{k}" for k in range(64)) and all(got[f"l{k}"] is None for k in range(64, 70)) and got[None] == rules.OTHER
    first = rules._first_rule({"l1": [("upper", 0.0)] if "upper" in rules.RULES else [(next(iter(rules.RULES)), 0.0)]})
    counts = {name: F.lit(1.0) for name in [*textstats.COUNTS, "word_score", "one"]}
    assert rows.withColumns(counts).where(F.col("stratum") == "l66").withColumn(
        "stratum", rules.stratum_of(named)).select(first.alias("f")).first()["f"] is None


def test_repeated_ids_give_the_same_model_twice(spark):
    from cinelake.llm import quality_classifier as qc
    rows = [(k % 40, f"words of text {k} " * (1 + k % 7)) for k in range(400)]
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(40)], "doc_id long, quality int, toxic int")
    taken = []
    for n in (2, 5):
        docs = qc.id_and_text(spark.createDataFrame(rows, "doc_id long, text string").repartition(n), "text", "doc_id")
        truth = qc.truth_of(labels)
        taken.append(qc.sample(docs, qc.first_ids(truth.select("doc_id")), truth, textstats.INSULTS))
    assert len(taken[0]) == 40  # one row an id, the same one however the rows lie
    assert all(a[0] == b[0] and (a[1] == b[1]).all() and a[2] == b[2] for a, b in zip(*taken))


def test_the_scorer_is_fitted_in_little_memory(spark):
    """The fit runs in the driver: a few times the sample's 32-bit slots, and the sample itself once."""
    import tracemalloc
    draw = np.random.default_rng(2)
    rows = [np.unique(draw.integers(0, 50_000, 10_000, dtype=np.uint32)) for _ in range(200)]
    tracemalloc.start()
    try:
        quality_classifier.SparseScorer().fit(rows, np.arange(200) % 2, epochs=1)
        assert tracemalloc.get_traced_memory()[1] < 20 * sum(map(len, rows))
    finally:
        tracemalloc.stop()
    docs = spark.createDataFrame([(k, f"words of text {k}") for k in range(9)], "doc_id long, text string")
    truth = quality_classifier.truth_of(spark.createDataFrame([(k, 1, 0) for k in range(5)], "doc_id long, quality int, toxic int"))
    taken = quality_classifier.sample(docs, docs.select("doc_id"), truth, textstats.INSULTS)
    assert [bad for _, _, bad in taken] == [0.0] * 5 + [-1.0] * 4
    assert all(s.dtype == np.uint32 and len(s) == 4 and s.base is not None for _, s, _ in taken)


def test_every_labelled_language_is_a_stratum(spark):
    """70 languages and null: those with fewest labels have learned rules too."""
    from pyspark.sql import functions as F
    names = [f"l{k}" for k in range(70)] + [None]
    counts = {c: F.lit(0).cast("long") for c in textstats.COUNTS} | {"n_words": F.lit(100).cast("long"), "word_score": F.lit(0.0)}
    rows = spark.createDataFrame([(k, n) for k, n in enumerate(names)], "k int, stratum string").join(
        spark.range(1600).withColumnRenamed("id", "i")).where("i < 1500 or k < 64").withColumn(
        "doc_id", F.col("k") * 1600 + F.col("i")).withColumns(counts).withColumn(
        "n_symbols", F.when(F.col("i") < 100, 90).otherwise(0).cast("long"))
    labels = rows.select("doc_id", (F.col("i") >= 100).cast("int").alias("quality"), F.lit(0).alias("toxic"))
    adopted = quality_rules.cutoffs(rows, labels)
    assert adopted.keys() == {n or "(other)" for n in names}
    assert all([rule for rule, _ in sequence] == ["symbols"] for sequence in adopted.values())
    mixed = spark.createDataFrame([(n, 90) for n in names] + [(n, 0) for n in names] + [("unseen", 90)],
                                  "stratum string, n_symbols long")
    told = quality_rules._with_rules(mixed.withColumns({c: v for c, v in counts.items() if c != "n_symbols"}),
                                     quality_rules.learned(rows, labels))
    left = told.where(quality_rules._place().isNull()).select("stratum", "n_symbols").collect()
    assert Counter(map(tuple, left)) == Counter([(n, 0) for n in names] + [("unseen", 90)])
