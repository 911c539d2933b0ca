"""Operators 3, 5, 6, 8, 9 and 10: against brute force, round trips, held-out accuracy."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from cinelake.llm import chat, components, decontaminate, langid, lm, simhash, warc
from cinelake.llm.registry import QUERIES
from cinelake.llm.tables import SharedFiles, fresh_path

from cases import SF001, SF01

# -- chat ------------------------------------------------------------------------------


def test_random_turns_survive_the_round_trip():
    draw = random.Random(3)
    pieces = ["\\", "<", "</turn>", "turn>", "/", "a", "\n", "### ", ":", "</turn", ">", "\\\\<"]
    for _ in range(20_000):
        turns = [(draw.choice(["user", "a:b", "x\\", "\n", ""]),
                  "".join(draw.choice(pieces) for _ in range(draw.randint(0, 8)))) for _ in range(3)]
        made = [chat.render(*t) for t in turns]
        assert chat.parse("".join(m[0] for m in made)) == turns


def test_only_conflicting_content_is_escaped():
    assert chat.render("user", "a \\n < b ###")[0] == "### user:\na \\n < b ###</turn>\n"
    assert chat.render("user", chat.PROBE)[0] == "### user:\n\\### Assistant: \\</turn> ok</turn>\n"
    assert chat.parse("### user:\nno end") is None and chat.parse("user") is None


def test_read_back_gives_the_probe_and_odd_turns(spark):
    rows = [(1, 2, "assistant", "b"), (1, 1, "user", "a"), (1, 2, "assistant", "b"), (2, None, None, None),
            (2, 0, "assistant", "</turn>\\"), (None, 0, "user", ""), (3, 0, "assistant", "z" * 100_000)]
    given = spark.createDataFrame([(*r, 9) for r in rows], "conv_id long, turn long, role string, text string, formatted int")
    got = {r["conv_id"]: r for r in chat.round_trip(chat.with_probe(given)).collect()}
    groups = defaultdict(list)
    for conv, turn, role, text in [*rows, (-7, 0, "user", chat.PROBE), (-7, 1, "assistant", chat.PROBE)]:
        groups[conv].append((-1 if turn is None else turn, role or "", text or ""))
    assert got.keys() == groups.keys()
    for conv, turns in groups.items():
        turns.sort()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        want = hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest()
        r = got[conv]
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"]) == (len(turns), want, len(loss))
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert r["formatted_chars"] == sum(len(chat.render(role, text)[0]) for _, role, text in turns)
    assert chat.round_trip(given.where("false")).count() == 0


def test_equal_turns_follow_in_order_of_their_source_texts(spark):
    texts = ["</turn>", "<a", "a", "a\t", "a</turn>", "a ", "\\<", "\\"]
    given = spark.createDataFrame([(1, 5, "user", t) for t in texts] + [(1, None, "user", "z")], "conv_id long, turn long, role string, text string")
    got = chat.round_trip(given).collect()[0]
    turns = ["z", *sorted(texts)]
    assert got["turns_sha256"] == hashlib.sha256("".join(f"user\n{t}\n" for t in turns).encode()).hexdigest()


def test_operators_do_not_mind_names_that_they_use_themselves(spark):
    rows = [(k, f"some words of document {k} that nobody else has written so far " * (k + 1), "en", 1, 2, 3, 4, 5) for k in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, _t int, _s int, _text_ int, _simhash_row int, _digest int")
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(6)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, "nothing of the kind is in any of the documents above or below it")], "item_id long, text string")
    from cinelake.llm import quality_classifier, quality_rules
    for kept in (quality_rules.keep_good(docs, labels), quality_classifier.keep_good(docs, labels), simhash.keep_one(docs),
                 decontaminate.keep_clean(docs, bench)):
        assert kept.columns == docs.columns and kept.count() <= 6
    odd_key = docs.select(docs["doc_id"].cast("double").alias("doc_id"), "text")
    item = spark.createDataFrame([(1, rows[2][1])], "item_id long, text string")
    assert {r["doc_id"] for r in decontaminate.matches(odd_key, item).collect()} >= {2.0}


# -- near-duplicates ------------------------------------------------------------------------


def brute_print(text):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[k:k + 3]) for k in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(prints, bits=2):
    """Smallest place reachable over links of ``bits`` or fewer bits."""
    values, root = np.array(prints, np.uint64), list(range(len(prints)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for k in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values[k + 1:] ^ values[k]) <= bits):
            a, b = find(k), find(k + 1 + int(j))
            root[max(a, b)] = min(a, b)
    return [find(k) for k in range(len(prints))]


def test_op5_on_documents(spark):
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF01}/documents.parquet").collect())
    prints = [brute_print(t) for _, t in docs]
    want = {docs[k][0]: (f"{prints[k]:016x}", docs[c][0]) for k, c in enumerate(brute_classes(prints))}
    assert {r[0]: (r[1], r[2]) for r in QUERIES["op5_simhash"](spark, SF01).collect()} == want


@pytest.mark.parametrize("bits, block, refs", [(2, 256, 16), (2, 2, 16), (3, 8, 16), (1, 4, 1), (0, 256, 16)])
def test_links_are_all_that_brute_force_finds(spark, bits, block, refs):
    """Dense groups, long chains, all values of nine bits; small blocks pass every level."""
    draw = random.Random(block)
    prints = {draw.getrandbits(64) for _ in range(60)} | {0, *range(1 << 40, 1 << 49, 1 << 40)}
    for start in list(prints)[:12]:
        value = start
        for _ in range(25):
            value ^= 1 << draw.randrange(64)
            if draw.random() < 0.7:
                value ^= 1 << draw.randrange(64)
            prints.add(value)
    values = np.array(sorted(prints), np.uint64)
    want = {tuple(sorted((simhash._signed(int(values[k])), simhash._signed(int(v))))) for k in range(len(values))
            for v in values[k + 1:][np.bitwise_count(values[k + 1:] ^ values[k]) <= bits]}
    rows = spark.createDataFrame([(simhash._signed(int(p)),) for p in values], "fp long")
    got = [tuple(r) for r in simhash.links(rows, bits, simhash.pivots(refs), block).collect()]
    assert len(got) == len(set(got)) and set(got) == want and bool(want) == (bits > 0)


def test_pivots_discard_no_link_and_most_other_pairs(spark):
    draw = random.Random(3)
    base = draw.getrandbits(32)
    prints = [simhash._signed(base << 32 | draw.getrandbits(32)) for _ in range(200)]
    table = simhash.pivot_table(spark.createDataFrame([(p,) for p in set(prints)], "fp long"), simhash.pivots())
    pairs = simhash.candidates(table).distinct().collect()
    assert len(pairs) == len(set(prints)) * (len(set(prints)) - 1) // 2  # one block, the first 32 bits
    assert all(r["gap"] <= 2 for r in pairs if ((r["fp"] ^ r["other"]) & (1 << 64) - 1).bit_count() <= 2)
    assert sum(r["gap"] > 2 for r in pairs) > 0.9 * len(pairs)


def test_max_bits_widens_the_groups(spark):
    texts = [" ".join(f"w{k}" for k in range(n, n + 400)) for n in range(0, 40, 2)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for bits in (1, 3):
        got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(rows, max_bits=bits).collect()}
        assert got == dict(enumerate(brute_classes([brute_print(t) for t in texts], bits)))
    with pytest.raises(ValueError):
        simhash.near_duplicates(rows, max_bits=4)


def test_components_of_long_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(200)] + [(5000, 5000), (None, 3)]
    rows = spark.createDataFrame([(b, a) if b is not None and a is not None and (a + b) % 3 else (a, b) for a, b in edges], "a long, b long")
    got = {r["node"]: r["root"] for r in components.components(rows, "a", "b").collect()}
    assert got == {**{i: 0 for i in range(301)}, **{1000 + i: 1000 for i in range(200)}}
    assert components.components(rows.where("false"), "a", "b").count() == 0


def test_near_duplicates_of_odd_texts(spark, odd, none):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    prints = [brute_print(t) for _, t in rows]
    least = defaultdict(list)
    classes = brute_classes(prints)
    for (i, _), c in zip(rows, classes):
        least[c] += [i] if i is not None else []
    want = Counter((i, f"{p:016x}", min(least[c], default=None)) for (i, _), p, c in zip(rows, prints, classes))
    assert Counter(tuple(r) for r in simhash.near_duplicates(odd).collect()) == want
    assert simhash.near_duplicates(none).count() == 0
    assert simhash.keep_one(none).count() == 0
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()) == sorted(
        (not least[c], min(least[c], default=0)) for c in set(classes))


# -- WARC ----------------------------------------------------------------------------------------


def brute_pages(pages):
    first, out = {}, []
    for page_id, _, html in pages:
        if page_id is not None:
            first[html or ""] = min(first.get(html or "", page_id), page_id)
    for page_id, _, html in pages:
        data, least = (html or "").encode(), first.get(html or "")
        again = least is not None and page_id != least
        out.append((page_id, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                    "revisit" if again else "response", least if again else None))
    return Counter(out)


def test_archives_of_odd_pages(spark):
    pages = [(5, "http://a/\u00e9 b\r\nX: y", "<p>one</p>"), (3, None, "<p>one</p>"), (9, "http://c", "<p>one</p>"), (4, "u", None),
             (6, "", ""), (None, "http://n", "<p>one</p>"), (None, "http://n", "alone"), (3, None, "<p>one</p>"),
             (7, "http://l", "\u4e2d" * 400_000), (8, "http://r", "\r\n\r\nWARC/1.1\r\n\r\n")]
    given = spark.createDataFrame([(*p, 1) for p in pages], "page_id long, url string, html string, digest int")
    assert Counter(tuple(r) for r in warc.round_trip(given).collect()) == brute_pages(pages)
    assert warc.round_trip(given.where("false")).count() == 0


def test_no_two_records_share_an_id(spark):
    rows = [(1, "a"), (1, "a"), (1, "b"), (2, "a"), (2, "a"), (3, "c"), (4, "c"), (4, "c"), (None, "d"), (None, "d"), (None, "c")]
    given = spark.createDataFrame([(i, f"http://x/{i}", t) for i, t in rows], "page_id long, url string, html string")
    for least in (0, 10):
        folder = fresh_path(spark, "warc-ids")
        heads = []
        for name in warc.write(given.repartition(3), folder, least):
            with SharedFiles(folder).read(name) as file:
                heads += [warc._fields(r.partition(b"\r\n\r\n")[0]) for r in warc.records(file)]
        ids = [h["WARC-Record-ID"] for h in heads]
        assert len(ids) == len(rows) == len(set(ids))
        named = {h["WARC-Record-ID"]: h for h in heads}
        links = [(h, named[h["WARC-Refers-To"]]) for h in heads if "WARC-Refers-To" in h]
        assert len(links) == (3 if least == 0 else 0)  # of page 3; that of page 1 stands twice
        assert all(r["WARC-Type"] == "response" and r["Page-ID"] == "3" for _, r in links)
        assert all(h["WARC-Payload-Digest"] == r["WARC-Payload-Digest"] for h, r in links)


def test_an_archive_is_a_dictionary_and_frames_that_read_alone(spark):
    zstandard = pytest.importorskip("zstandard")
    folder = fresh_path(spark, "archive")
    writer = warc.Writer(SharedFiles(folder).write("a"))
    records = [warc.record(i, f"http://x/{i}", f"<html><body>page {i} of many alike</body></html>".encode() * 40, None)
               for i in range(2000)]
    for data in records:
        writer.add(data)
    writer.close()
    with SharedFiles(folder).read("a") as file:
        assert list(warc.records(file)) == records
        file.seek(0)
        data = file.read()
    size = int.from_bytes(data[4:8], "little")
    assert data[:4] == (0x184D2A5D).to_bytes(4, "little")
    words = zstandard.ZstdCompressionDict(data[8:8 + size])
    assert zstandard.ZstdDecompressor(dict_data=words).decompressobj().decompress(data[8 + size:]) == records[0]
    assert len(data) < sum(len(zstandard.ZstdCompressor().compress(r)) for r in records)
    with pytest.raises(ValueError):
        warc.read_record(records[0].replace(b"page 0", b"page X"))


# -- language model -----------------------------------------------------------------------------------


def test_op8_counts_and_base_scores(spark):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    got = {r["doc_id"]: r for r in QUERIES["op8_lm"](spark, SF01).collect()}
    tokens = lambda t: re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]+", lambda m: m[0].lower(), t)) + ["\n"]
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in docs}
    n = Counter(w for i, t in docs.items() if not held[i] for w in tokens(t))
    total = sum(n.values())
    gain = 0.0
    assert got.keys() == docs.keys()
    for i, text in docs.items():
        words, r = tokens(text), got[i]
        base = sum(math.log10((n[w] + 0.5) / (total + 0.5 * (len(n) + 1))) for w in words)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (
            held[i], len(words), sum(n[w] > 0 for w in words), total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        gain += (r["score"] - base) * held[i]
    assert gain > 0  # the model knows more of held-out texts than word frequencies do


def test_model_is_normalised_and_learns_what_follows_what():
    draw, width = np.random.default_rng(0), 4
    chain = [0, 1]
    for _ in range(5000):
        chain.append((chain[-1] + 1) % width if draw.random() < 0.9 else int(draw.integers(width)))
    chain = np.array(chain)
    rows, n = np.unique(np.stack([chain[:-2], chain[1:-1], chain[2:]], axis=1), axis=0, return_counts=True)
    model = lm.LogBilinear(np.bincount(chain, minlength=width) / len(chain)).train(rows, n, 1, steps=400, samples=512)
    vectors, logs = model.normalisers(5)
    found = np.exp(vectors @ model.params["q"].T + model.params["b"] - logs[:, None])
    assert np.allclose(found.sum(1), 1)
    after = found.reshape(width, width, width).mean(0)
    assert all(after[k].argmax() == (k + 1) % width and after[k].max() > 0.6 for k in range(width))


def test_what_the_model_learns_grows_with_the_input(spark):
    counts = np.array([500_000, 1, 1, 300_000, 7])
    seen = [np.concatenate(list(lm.visits(counts, 3, turn, 3))) for turn in range(3)]
    assert sum(map(len, seen)) < counts.sum() + 3 * lm.SAMPLES
    assert (np.bincount(np.concatenate(seen), minlength=5) >= counts).all()  # every token, rare triples too
    classes = [lm.Unigram([(f"w{k}", 9) for k in range(2000)], 18_000 + kinds, kinds).other for kinds in (10**4, 10**6, 10**9)]
    assert classes == [lm.CLASSES, 333, lm.MOST_CLASSES]
    rows = [(0, 1_000_003)] + [(k, 1 + k % 9) for k in range(1, 3000)]
    parts = lm.dealt(spark.createDataFrame(rows, "triple long, n long"), 12).collect()
    shards, again = Counter(), Counter()
    for r in parts:
        shards[r["shard"]] += r["n"]
        again[r["triple"]] += r["n"]
    assert again == dict(rows) and len(shards) == 12 and max(shards.values()) < 1.05 * min(shards.values())


def test_classes_beyond_the_tables_are_as_exact(spark, monkeypatch):
    """More tokens than the context tables have classes for: the same probabilities as by whole tables."""
    head = [(f"w{k}", 1000 - k) for k in range(900)]
    base = lm.Unigram(head, sum(n for _, n in head) + 10**7, 10**7)
    assert base.other == lm.MOST_CLASSES and base.width == 901 and base.shares.sum() == pytest.approx(1)
    tokens = lm.Tokens([" ".join(f"w{k}" for k in range(0, 1000, 7)), "w899 w0 w899 w700 w5"])
    place, classes = base.classify(tokens)
    named = dict(zip(tokens.words, place))
    assert all(named[f"w{k}"] == min(k, 900) for k in range(0, 1000, 7))
    assert classes[-6:].tolist() == [900, 0, 900, 701, 5, base.other]  # the end is not in this head
    assert base.shares[900] == pytest.approx((101 + 0.5) / base.whole)
    model = lm.LogBilinear(base.shares)
    one, two = base.contexts(tokens, classes)
    vectors, logs = model.looked_up(model.normalisers(side=base.other + 1), one, two)
    assert ((one > base.other) | (two > base.other)).any()
    scores = model.context(one, two) @ model.params["q"].T + model.params["b"]
    assert np.allclose(vectors, model.context(one, two), atol=1e-6) and np.allclose(logs, np.log(np.exp(scores).sum(1)), atol=1e-5)
    rows = [(i, f"the cat {i % 9} sat on mat {i % 5} and {'then slept' if i % 2 else 'ran off'}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(lm, "MOST_CLASSES", 5)
    got = lm.score(docs).collect()
    assert len(got) == 60 and all(r["score"] > r["base_score"] for r in got if r["held_out"])


def test_scores_of_odd_texts(spark, odd, none):
    rows = lm.score(odd).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(r["doc_id"] for r in odd.collect())
    assert all(math.isfinite(r["score"]) and math.isfinite(r["base_score"]) and r["n_tokens"] >= 1 for r in rows)
    assert lm.score(none).count() == 0
    alone = lm.score(odd.where("doc_id = 1")).collect()  # one document, learned from or not
    assert len(alone) == 1 and math.isfinite(alone[0]["score"])


# -- decontamination --------------------------------------------------------------------------------------


def test_op9_equals_a_search_for_thirteen_words_in_a_row(spark):
    norm = lambda t: re.findall(r"\w+", (t or "").lower())
    grams = defaultdict(set)
    for r in spark.read.parquet(f"{SF01}/benchmark.parquet").collect():
        words = norm(r["text"])
        for k in range(len(words) - 12):
            grams[tuple(words[k:k + 13])].add(r["item_id"])
    want = set()
    for r in spark.read.parquet(f"{SF01}/documents.parquet").collect():
        words = norm(r["text"])
        for k in range(len(words) - 12):
            want |= {(r["doc_id"], i) for i in grams.get(tuple(words[k:k + 13]), ())}
    got = {(r["doc_id"], r["item_id"]) for r in QUERIES["op9_decontaminate"](spark, SF01).collect()}
    assert want and want <= got and len(got - want) <= 0.02 * len(got)


ITEM = ("At noon a train leaves from Paris with 120 people who each carry 5 kg of bread and meets Anna "
        "who walked 120 meters to see it go by while 5 dogs ran along")


def swap(text, **words):
    return re.sub(r"\w+", lambda m: words.get(m[0], m[0]), text)


def test_changed_numbers_names_and_units_are_found(spark):
    docs = {1: ITEM, 2: "Before. " + swap(ITEM, **{"120": "77", "5": "9"}) + " After it.", 3: swap(ITEM, Paris="Berlin", Anna="Otto"),
            4: swap(ITEM, kg="lbs", meters="feet"), 5: ITEM.upper(), 6: re.sub(" ", "### ", ITEM),
            7: ITEM.replace("120", "77", 1), 8: "a train of other words that have little to do with any of it at all, 5 times 120",
            9: " ".join(ITEM.split()[:9]), 10: None, 11: ""}
    rows = spark.createDataFrame([(i, t, "x") for i, t in docs.items()] + [(1, ITEM, "x"), (None, ITEM, "x")],
                                 "doc_id long, text string, item_id string")
    items = spark.createDataFrame([(1, ITEM, 0), (2, "why is the sky blue", 0), (3, "two words", 0), (4, None, 0), (1, ITEM, 0)],
                                  "item_id long, text string, doc_id int")
    got = Counter((r["doc_id"], r["item_id"]) for r in decontaminate.matches(rows, items).collect())
    found = {i for i, _ in got}
    assert {1, 2, 3, 4, 5, 6, None} <= found and not found & {8, 9, 10, 11}
    assert got[1, 1] == 4  # two equal documents, two equal items
    kept = decontaminate.keep_clean(rows, items)
    assert kept.columns == rows.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(set(docs) - found)
    assert decontaminate.matches(rows.where("false"), items).count() == 0
    assert decontaminate.matches(rows, items.where("false")).count() == 0
    assert decontaminate.keep_clean(rows.where("false"), items).count() == 0


@pytest.mark.parametrize("item, changed", [
    ("Wie viele Kilometer fährt ein Auto in drei Stunden wenn es für hundert Meter immer genau vier Sekunden braucht",
     dict(Kilometer="Meilen", drei="sieben", hundert="fünfzig", vier="zwei")),
    ("Combien de litres faut-il pour remplir en trois heures une piscine dont chaque mètre demande deux jours de travail",
     dict(trois="douze", deux="cinq", heures="semaines")),
    ("Cuántos kilómetros recorre en dos horas un tren que pasa por cada pueblo de la costa cinco minutos antes",
     dict(dos="ocho", cinco="veinte", horas="días"))], ids=["de", "fr", "es"])
def test_changed_values_are_found_in_other_languages(spark, item, changed):
    docs = [(1, f"Vorab. {swap(item, **changed)} Fin."), (2, swap(item, **{w: "xyz" for w in item.split()[4::3]}))]
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    asked = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert changed.keys() <= set(item.split())
    assert [(r["doc_id"], r["item_id"]) for r in decontaminate.matches(rows, asked).collect()] == [(1, 1)]


def test_units_in_singular_and_plural():
    for word in "day days inch inches stunde stunden jahre jahren meilen mois jours años lbs kms".split():
        assert decontaminate.is_unit(word)
    for word in ["", "s", "es", "en", "yearn", "grade", "an", "mes", "seconded", "this"]:
        assert not decontaminate.is_unit(word)


def test_short_items_are_compared_whole(spark):
    items = spark.createDataFrame([(2, "why is the sky blue")], "item_id long, text string")
    rows = spark.createDataFrame([(1, "tell me why is the sky blue today"), (2, "why is the sea blue")], "doc_id long, text string")
    assert [(r["doc_id"], r["covered"]) for r in decontaminate.matches(rows, items).collect()] == [(1, 5)]


def test_items_below_five_words_are_found_as_whole_lines(spark):
    items = spark.createDataFrame([(1, "What is two plus"), (2, "Hello"), (3, "?!"), (4, "Hello")], "item_id long, text string")
    docs = [(1, "first\nwhat is  two plus?\nlast"), (2, "what is two plus three"), (3, "HELLO!"), (4, "hello there"),
            (5, "x\nhello\nhello"), (6, None), (7, ""), (1, "- hello -")]
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    got = Counter(tuple(r) for r in decontaminate.matches(rows, items).collect())
    assert got == Counter([(1, 1, 4, 4), *((d, i, 1, 1) for d in (3, 5, 1) for i in (2, 4))])
    assert sorted(r["doc_id"] for r in decontaminate.keep_clean(rows, items).collect()) == [2, 4, 6, 7]


@pytest.mark.parametrize("count", [5, 8, 9, 12, 13])
def test_items_of_any_length_are_found(spark, count):
    item = " ".join(f"word{chr(97 + k)}x" for k in range(count))
    long = "filler text " * 30_000
    docs = [(1, f"so {item} then"), (2, " ".join(item.split()[:-1])), (3, long + item + " " + long), (4, long)]
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    asked = spark.createDataFrame([(1, item), (2, ITEM)], "item_id long, text string")
    assert sorted(tuple(r) for r in decontaminate.matches(rows, asked).collect()) == [(1, 1, count, count), (3, 1, count, count)]


def test_a_phrase_that_is_no_leak_is_not_joined(spark, monkeypatch):
    """300 items and 300 documents share twelve words; only one document holds an item."""
    phrase = "all of the answers to these questions must be written in ink"
    items = [(k, f"item{k} is opened by its own words and says {phrase} before it ends with q{k}x z{k}y") for k in range(300)]
    docs = [(k, f"page {chr(97 + k % 26)}{k}g says so: {phrase}, and goes on with p{k}h") for k in range(300)] + [(999, items[7][1])]
    staged, sizes = decontaminate.staged, {}

    def counted(df, name):
        sizes[name] = (out := staged(df, name)).count()
        return out

    monkeypatch.setattr(decontaminate, "staged", counted)
    got = decontaminate.matches(spark.createDataFrame(docs, "doc_id long, text string"),
                                spark.createDataFrame(items, "item_id long, text string")).collect()
    assert (999, 7) in {(r["doc_id"], r["item_id"]) for r in got} and {r["doc_id"] for r in got} == {999}
    assert sizes["document-windows"] < 50  # those of document 999


def test_reaching_windows_by_brute_force():
    draw = random.Random(5)
    for _ in range(200):
        span = draw.randrange(13, 40)
        starts = sorted(draw.sample(range(120), draw.randrange(1, 14)))
        text = np.array([s // 60 for s in starts])
        want = []
        for k, s in enumerate(starts):
            near = [[t for j, t in enumerate(starts) if text[j] == text[k] and p <= t < p + span]
                    for i, p in enumerate(starts) if text[i] == text[k] and p <= s < p + span]
            want.append(any(len({w for t in met for w in range(t, t + 8)}) >= 13 for met in near))
        assert decontaminate._reaching(np.array(starts), text, span).tolist() == want


def test_copies_made_of_numbers_and_units_are_found(spark):
    items = {1: "Convert 5 km 300 meters to feet and 7 miles to km", 2: "What is 12 times 7 ?", 3: "3 5 8 13 21 34 55 89",
             4: "Add 5 kg 7 kg 9 lbs 11 lbs 13 oz 15 oz 17 grams 19 grams"}
    docs = {k: f"See here. {t} That was it." for k, t in items.items()}
    docs |= {5: "What is 13 times 7 ?", 6: "3 5 8 13 21 34 55 90", 7: "Add 5 kg 7 kg 9 lbs 12 lbs and 13 oz 15 oz 17 grams"}
    rows = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    asked = spark.createDataFrame(list(items.items()), "item_id long, text string")
    got = Counter((r["doc_id"], r["item_id"], r["covered"]) for r in decontaminate.matches(rows, asked).collect())
    assert got == {(1, 1, 12): 1, (2, 2, 5): 1, (3, 3, 8): 1, (4, 4, 17): 1}


def test_slots_must_agree_within_an_alignment():
    kinds = np.array([0, 1, 0, 1], np.int8)
    item, same, other = (np.array(v, np.uint64) for v in ([9, 5, 9, 5], [9, 7, 9, 7], [9, 7, 9, 8]))
    assert decontaminate.consistent([(10, 0, same, item, kinds)]) == {0, 1, 2, 3}
    assert decontaminate.consistent([(10, 0, other, item, kinds)]) == set()


def test_windows_far_apart_in_a_document_make_no_leak(spark):
    words = ITEM.split()
    one, two, fill = " ".join(words[:9]), " ".join(words[14:23]), " and so on" * 40
    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    rows = spark.createDataFrame([(1, one + fill + " " + two), (2, one + " quite soon " + two), (3, one + fill + " " + ITEM)],
                                 "doc_id long, text string")
    assert sorted(r["doc_id"] for r in decontaminate.matches(rows, items).collect()) == [2, 3]
    kinds, item = np.array([0, 1], np.int8), np.array([9, 5], np.uint64)
    seven, eight = np.array([9, 7], np.uint64), np.array([9, 8], np.uint64)
    met = [(10, 0, seven, item, kinds), (13, 2, seven, item, kinds), (17, 4, eight, item, kinds)]
    assert decontaminate.consistent(met, 9) == {0, 1, 2, 3}  # slots over alignments together


# -- languages -------------------------------------------------------------------------------------------


def test_gradients_are_those_of_the_loss():
    draw = np.random.default_rng(5)
    net = langid.Network(["a", "b", "c"], hidden=4)
    net.params = {k: v.astype(np.float64) for k, v in net.params.items()}
    data, labels = draw.integers(0, 256, (6, 7)).astype(np.uint8), draw.integers(0, 3, 7)
    loss = lambda: -np.log(net.positions(data)[:, np.arange(7), labels]).mean()
    for name, grad in net._gradients(data, labels).items():
        at = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        old, step = net.params[name][at], 1e-2
        net.params[name][at] = old + step
        up = loss()
        net.params[name][at] = old - step
        down = loss()
        net.params[name][at] = old
        assert grad[at] == pytest.approx((up - down) / (2 * step), rel=2e-2)


def test_op10_held_out_accuracy_and_unknown(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    rows = QUERIES["op10_langid"](spark, SF01).collect()
    assert {r["doc_id"] for r in rows} == docs.keys() and len(rows) == len(docs)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    held = [r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in rows if r["held_out"]]
    assert sum(held) >= 0.95 * len(held)


def test_languages_of_odd_texts(spark, odd, none):
    rows = langid.identify(odd).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(r["doc_id"] for r in odd.collect())
    by_id = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert {by_id[k]["lang_pred"] for k in (0, 1, 2, 7)} == {"und"} and all(0 <= r["score"] <= 1 for r in rows)
    assert by_id[3]["lang_pred"] == "en"  # the only language there is
    assert langid.identify(none).count() == 0
    assert {r["lang_pred"] for r in langid.identify(odd.where("lang is null")).collect()} == {"und"}


def test_pooling_counts_every_byte_once():
    net = langid.Network(["a", "b"])
    text = bytes(range(97, 123)) * 9
    whole = [text[k:k + langid.STEPS] for k in range(0, len(text), langid.STEPS)]
    want = np.concatenate([net.positions(np.frombuffer(w + bytes(langid.STEPS - len(w)), np.uint8)[:, None])[:len(w), 0]
                           for w in whole]).mean(0)
    assert np.allclose(net.pooled([b"x", text])[1], want, atol=1e-5)


# -- SQL and the pipeline ----------------------------------------------------------------------------------


@pytest.mark.parametrize("name", ["op3_chat", "op6_warc"])
def test_queries_equal_their_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    from cinelake.llm.registry import SQL
    con = duckdb.connect()
    for table in ("conversations", "pages"):
        con.execute(f"create view {table} as select * from '{SF001}/{table}.parquet'")
    rows = QUERIES[name](spark, SF001)
    want = con.execute(f"select {', '.join(rows.columns)} from ({SQL[name]})").fetchall()
    assert Counter(map(tuple, rows.collect())) == Counter(want)


def test_pipeline_stages_act_on_what_is_left(spark):
    import corpus_pipeline
    from cinelake.llm.tables import read, staged
    docs = read(spark, SF01, "documents")
    columns, sizes = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"] for r in docs.collect()}
        docs = staged(stage(spark, docs, SF01), f"test-{name}")
        assert docs.columns == columns and {r["doc_id"] for r in docs.collect()} <= before
        sizes.append(docs.count())
    assert all(a > b for a, b in zip(sizes, sizes[1:]))
    prints = [brute_print(r["text"]) for r in docs.collect()]
    assert len(set(brute_classes(prints))) == len(prints)
    assert decontaminate.matches(docs, spark.read.parquet(f"{SF01}/benchmark.parquet")).count() == 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF01)
    assert {r["doc_id"] for r in last.collect()} == {r["doc_id"] for r in docs.collect()}


def test_pipeline_runs_as_a_query(spark):
    import corpus_pipeline
    assert corpus_pipeline.run(spark, SF001).count() > 0


def test_models_are_averaged_in_a_tree(spark, monkeypatch):
    """Averages of averages weigh every shard by its tokens, whatever the fan-in."""
    draw = np.random.default_rng(5)
    parts = [(k, int(draw.integers(1, 100)), draw.normal(0, 1, 7).astype(np.float32).tobytes()) for k in range(70)]
    whole, n = lm._average(parts)
    rows = spark.createDataFrame([(s // 9, n, p) for s, n, p in parts], lm._TRAINED).repartition(3, "shard").sortWithinPartitions("shard")
    made = [(r["shard"], r["n"], bytes(r["params"])) for r in rows.mapInArrow(lm._averaged, lm._TRAINED).collect()]
    again, m = lm._average(made)
    assert len(made) == 8 and m == n and np.allclose(again, whole, atol=1e-5)
    rows = [(k, 5) for k in range(500)]
    counted = spark.createDataFrame(rows, "triple long, n long")
    base = lm.Unigram([(f"w{k}", 9) for k in range(7)], 2500, 7)
    wide = lm.fit(counted, base)
    monkeypatch.setattr(lm, "FAN_IN", 4)
    deep = lm.fit(counted, base)
    assert all(np.allclose(wide.params[k], deep.params[k], atol=1e-4) for k in wide.params)
