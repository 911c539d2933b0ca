"""Benchmark decontamination by template canonicalisation.

Words lose the marks at their ends and their case. Numbers, units (both by shape and in
words of English, German, French and Spanish) and names
(capitalised words within a sentence) become typed placeholders, their values
are kept as slots. Windows of ``WINDOW`` canonical words are joined by hash with those
of the benchmark items, which finds questions whose numbers, names or units were
changed; a second key keeps names as words, which finds changes of case. Both ask
for ``LITERALS`` words that are no placeholders, since "<number> <unit> <number>"
stands in any table. A third key keeps all values, for windows that hold a number
or a unit, and asks for none: verbatim copies meet whatever they consist of.

For each document and item, windows are taken together if they lie in one alignment, or
in several whose places in the document lie within the item's length (words were
put in or left out). Their slots must be consistent: one value of the item stands for one value in the document, and the other
way round. Windows that contradict the majority are dropped. A document holds
an item if the remaining windows of one such place cover at least ``COVER`` of the item's words
and as many of the document's. Items of fewer words are compared whole, by one window of their length;
below ``LEAST`` words, where any text would hold them, with whole lines and whole texts.

A window that occurs in no item is dropped before the shuffle by a bit map of
fixed size (8 MB): it lets some others pass, which the join drops, and loses
none. It is the only thing broadcast. Of the others, those go on that together with the windows
around them, up to the longest item's length, cover ``COVER`` words of the document: a
phrase that many items and many documents share, but which is no leak, is never joined. Windows
that many documents share are a skewed join key whose rows Spark splits, since the join needs no order.

Defined results: null texts have no words; items without words are in no document;
repeated rows and items each give their rows; empty tables give none; further
columns are kept whatever their names are.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from itertools import groupby

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from cinelake.llm.pretokens import WordTable, white_words
from cinelake.llm.tables import BITS, bit_map, free_name, prepare, staged, texts, without, worker_cache

WINDOW, COVER, LEAST, LITERALS = 8, 13, 5, 4
WORDS_KEPT = 400_000

#: Number words of four languages. Words that are articles or other common words too are left out.
NUMBER_WORDS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve twenty thirty forty fifty hundred thousand "
    "million billion dozen "
    "null zwei drei vier fünf sechs sieben acht neun zehn elf zwölf zwanzig dreißig vierzig fünfzig hundert tausend "
    "millionen milliarde milliarden dutzend "
    "zéro deux trois quatre cinq sept huit neuf dix onze douze vingt trente quarante cinquante mille milliard douzaine "
    "cero dos tres cuatro cinco seis siete ocho nueve diez doce veinte treinta cuarenta cincuenta cien ciento mil "
    "millón millones docena".split())

#: Units of four languages, without the plurals that ``is_unit`` knows by rule.
UNITS = frozenset(
    "mm cm km kg mg lb oz ml kb mb gb hz khz mhz kw kwh mph kmh meter metre kilometer kilometre centimeter mile inch "
    "foot feet yard gram kilogram pound ounce liter litre gallon second minute hour day week month year dollar euro "
    "cent percent degree watt volt "
    "zentimeter gramm kilogramm pfund sekunde stunde tag tage woche monat monate jahr jahre grad prozent meile "
    "mètre kilomètre centimètre gramme kilogramme livre seconde heure jour semaine mois année degré "
    "metro kilómetro centímetro gramo kilogramo litro segundo minuto hora día semana año grado milla".split())


def is_unit(word: str) -> bool:
    """A listed unit, or its plural in -s, -es or, after an e, -n."""
    return word in UNITS or word[-1:] == "s" and (word[:-1] in UNITS or word[-2:] == "es" and word[:-2] in UNITS) \
        or word[-2:] == "en" and word[:-1] in UNITS


_NUMBER = regex.compile(r"[+-]?\d[\d.,:/]*")
_GLUED = regex.compile(r"([+-]?\d[\d.,]*)(\p{L}+)")
_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~«»“”„’‘…–—¿¡"

# Low bits of an entry: kind (0 word, 1 number, 2 unit), capitalised, ends a sentence.
_KIND, _CAPITAL, _ENDS, _FLAGS = 3, 4, 8, 15
_TYPES = np.array([0, *(xxhash.xxh64_intdigest(f"<{k}>") for k in ("number", "unit", "name"))], np.uint64)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_WHOLE = np.uint64(0x5851F42D4C957F2D)  # tells windows of items that are compared whole
_WORD = regex.compile(r"[^\x20\x09-\x0D]+")


def _entries(word: str) -> list[int]:
    """A word's entries: hash of its value with flags in the low bits; none for bare marks."""
    bare = word.strip(_MARKS)
    if not bare:
        return []
    flags = (_CAPITAL if bare[0].isupper() else 0) | (_ENDS if word[-1] in ".!?:;" else 0)
    value = bare.lower()
    glued = _GLUED.fullmatch(value)
    if glued and is_unit(glued[2]):
        return [_entry(glued[1], 1), _entry(glued[2], 2 | flags & _ENDS)]
    kind = 1 if _NUMBER.fullmatch(value) or value in NUMBER_WORDS else 2 if is_unit(value) else 0
    return [_entry(value, kind | flags)]


def _entry(value: str, flags: int) -> int:
    return xxhash.xxh64_intdigest(value) & ~_FLAGS | flags


def _table() -> WordTable:
    return worker_cache("entries", lambda: WordTable(WORDS_KEPT, np.uint64))


class Windows:
    """Canonical words of a batch of texts and their window keys."""

    def __init__(self, batch: list[str]):
        words, places, firsts = white_words(batch)
        table = _table()
        fresh = table.missing(words)
        made = [_entries(w) for w in fresh]
        table.add(fresh, [e for m in made for e in m], [len(m) for m in made])
        entries, ends = table.gather(words, places)
        self.firsts = ends[firsts]  # first entry of each text and the end
        self.values = entries & ~np.uint64(_FLAGS)
        flags = entries.astype(np.int64) & _FLAGS
        opens = np.ones(len(entries), bool)
        opens[1:] = flags[:-1] & _ENDS > 0
        opens[self.firsts[:-1][self.firsts[:-1] < len(entries)]] = True
        plain = flags & _KIND
        self.kinds = np.where((plain == 0) & (flags & _CAPITAL > 0) & ~opens, 3, plain).astype(np.int8)
        self.plain = plain.astype(np.int8)

    def keys(self, size: int = WINDOW) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each key (names as words, names as placeholders, all as words): first entry of the window, key, kinds."""
        n = len(self.values) - size + 1
        out = []
        if n <= 0:
            return out
        at = np.arange(n)
        text = np.searchsorted(self.firsts, at, side="right") - 1
        whole = at + size <= self.firsts[text + 1]
        views = ((self.plain, None), (self.kinds, self.kinds == 3), (np.zeros_like(self.plain), self.plain > 0))
        for number, (kinds, changed) in enumerate(views, 1):
            codes = np.where(kinds > 0, _TYPES[kinds], self.values)
            key = np.full(n, number, np.uint64)
            for k in range(size):
                key = key * _FACTOR + codes[k:k + n]
            key ^= key >> np.uint64(31)
            sums = np.concatenate([[0], np.cumsum(kinds == 0)])
            good = whole & (sums[size:] - sums[:-size] >= min(LITERALS, size - 1))
            if changed is not None:  # the first key has windows that are the same by this one
                sums = np.concatenate([[0], np.cumsum(changed)])
                good &= sums[size:] > sums[:-size]
            first = np.flatnonzero(good)
            out.append((first, key[first], kinds))
        return out


_WINDOWS = "row long, place int, words int, size int, key long, vals binary, kinds binary"


def _reaching(starts: np.ndarray, text: np.ndarray, span: int) -> np.ndarray:
    """Which windows (sorted distinct starts) lie among windows that start within
    ``span`` words of each other and cover ``COVER`` words."""
    place = starts + text * (span + WINDOW)  # texts far apart
    covered = np.cumsum(np.minimum(np.diff(place, prepend=place[0]), WINDOW))
    end = np.searchsorted(place, place + span)  # the first start beyond
    good = WINDOW + covered[end - 1] - covered >= COVER
    marks = np.zeros(len(place) + 1, np.int64)
    np.add.at(marks, np.flatnonzero(good), 1)
    np.add.at(marks, end[good], -1)
    return np.cumsum(marks[:-1]) > 0


def _windows(rows: DataFrame, id_kind: str, modes: list[tuple[int, bool]], bits: bytes | None,
             span: int = 0) -> DataFrame:
    """Windows of (id, text) rows, by modes (size, whole items); with ``bits``, those that
    may be in the benchmark, and for items that are not compared whole may cover enough of it."""
    schema = f"id {id_kind}, {_WINDOWS}"

    def run(batches):
        number = TaskContext.get().partitionId() << 33
        bit_map = None if bits is None else np.frombuffer(bits, np.uint8)
        for batch in batches:
            found = Windows(texts(batch.column(1)))
            counts = np.diff(found.firsts)
            text_of = lambda first: np.searchsorted(found.firsts, first, side="right") - 1
            columns: list[list] = [[] for _ in range(8)]
            for size, whole in modes:
                met = []
                for first, key, kinds in found.keys(size):
                    key = key ^ _WHOLE if whole else key
                    if bit_map is None:  # the benchmark's own
                        ok = counts[text_of(first)] == size if whole else counts[text_of(first)] >= COVER
                    else:
                        bit = (key % np.uint64(BITS)).astype(np.int64)
                        ok = bit_map[bit >> 3] >> (bit & 7).astype(np.uint8) & 1 > 0
                    met.append((first[ok], key[ok], kinds))
                if bit_map is not None and not whole and any(len(first) for first, _, _ in met):
                    starts = np.unique(np.concatenate([first for first, _, _ in met]))
                    starts = starts[_reaching(starts, text_of(starts), span)]
                    oks = [np.isin(first, starts) for first, _, _ in met]
                    met = [(first[ok], key[ok], kinds) for ok, (first, key, kinds) in zip(oks, met)]
                for first, key, kinds in met:
                    text = text_of(first)
                    at = first[:, None] + np.arange(size)
                    columns[0] += text.tolist()
                    columns[1] += (number + text).tolist()
                    columns[2] += (first - found.firsts[text]).tolist()
                    columns[3] += counts[text].tolist()
                    columns[4] += [size] * len(first)
                    columns[5] += key.astype(np.int64).tolist()
                    columns[6] += [v.tobytes() for v in found.values[at]]
                    columns[7] += [k.tobytes() for k in kinds[at]]
            number += batch.num_rows
            if columns[0]:
                kinds_of = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(columns[0], pa.int64())),
                     *(pa.array(c, k) for c, k in zip(columns[1:], kinds_of))],
                    ["id", "row", "place", "words", "size", "key", "vals", "kinds"])

    return rows.mapInArrow(run, schema)


def short_key(text: str) -> bytes | None:
    """The words of a text with 1 to ``LEAST`` - 1 of them, else none."""
    found: list[int] = []
    for word in _WORD.finditer(text):
        found += [e & ~_FLAGS for e in _entries(word[0])]
        if len(found) >= LEAST:
            return None
    return np.array(found, np.uint64).tobytes() if found else None


def _short(rows: DataFrame, id_kind: str, lines: bool) -> DataFrame:
    """(id, vals) of short texts among (id, text) rows; with ``lines``, of the
    distinct short lines too."""
    def run(batches):
        for batch in batches:
            out = []
            for k, text in enumerate(texts(batch.column(1))):
                parts = {*text.split("\n"), text} if lines else {text}
                out += [(k, v) for v in {short_key(p) for p in parts} - {None}]
            if out:
                vals = [v for _, v in out]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array([k for k, _ in out], pa.int64())),
                     pa.array(vals, pa.binary())], ["id", "vals"])

    return rows.mapInArrow(run, f"id {id_kind}, vals binary")


def consistent(rows: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]], words: int = 0) -> set[int]:
    """Most item words covered at one place of the document by windows (place in document,
    place in item, values there, values here, kinds) whose slots agree: those
    of one alignment, or of all whose places lie within ``words`` of each other. Where fewer
    words of the document cover them, those."""
    by_shift = defaultdict(list)
    for row in rows:
        by_shift[row[0] - row[1]].append(row)
    found = [_agreeing(met) for met in by_shift.values()]
    if len(by_shift) > 1:
        rows, end = sorted(rows, key=lambda r: r[:2]), 0
        for k, row in enumerate(rows):
            upto = end
            while upto < len(rows) and rows[upto][0] < row[0] + words:
                upto += 1
            if upto > end:  # else part of the span before
                found.append(_agreeing(rows[k:upto]))
                end = upto
    return max(found, key=len, default=set())


def _agreeing(met: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]) -> set[int]:
    """Item words covered by the windows that do not contradict the majority's slots,
    or the document's words that do so, if they are fewer."""
    covered: set[int] = set()
    covering: set[int] = set()
    there, back = defaultdict(Counter), defaultdict(Counter)
    slots = []
    for place, _, doc, item, kinds in met:
        own = {(int(kinds[k]), int(item[k]), int(doc[k]), place + k) for k in np.flatnonzero(kinds)}
        slots.append(own)
    for kind, item, doc, _ in set().union(*slots):
        there[kind, item][doc] += 1
        back[kind, doc][item] += 1
    best = {k: max(c.items(), key=lambda x: (x[1], x[0]))[0] for k, c in there.items()}
    rest = {k: max(c.items(), key=lambda x: (x[1], x[0]))[0] for k, c in back.items()}
    for (place, at, _, item, _), own in zip(met, slots):
        if all(best[kind, a] == b and rest[kind, b] == a for kind, a, b, _ in own):
            covered.update(range(at, at + len(item)))
            covering.update(range(place, place + len(item)))
    return min(covered, covering, key=len)


def matches(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id",
            item_text: str = "text", item_key: str = "item_id") -> DataFrame:
    """(key, item_id, covered, item_words) of documents that hold an item."""
    prepare(docs.sparkSession)
    items = benchmark.select(benchmark[item_key].cast("long").alias("id"), benchmark[item_text].cast("string").alias("text"))
    own = staged(_windows(items, "long", [*((n, True) for n in range(LEAST, COVER)), (WINDOW, False)], None),
                 "benchmark-windows")
    kinds_of = own.groupBy("size", (F.col("words") < COVER).alias("whole")).agg(F.max("words").alias("most")).collect()
    used = [(r["size"], r["whole"]) for r in kinds_of]  # at most nine
    span = max((r["most"] for r in kinds_of), default=0)
    id_kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(docs[f"`{key}`"].alias("id"), docs[f"`{text}`"].cast("string").alias("text"))
    found = staged(_windows(rows, id_kind, used, bit_map(own, F.col("key")), span), "document-windows")
    its = own.select(F.col("id").alias("item_id"), F.col("row").alias("item_row"), F.col("place").alias("at"),
                     F.col("words").alias("item_words"), "size", "key", F.col("vals").alias("item_vals"),
                     F.col("kinds").alias("item_kinds"))
    met = found.drop("words").join(its, ["key", "size"]).where(F.col("kinds") == F.col("item_kinds"))
    met = met.select("row", "item_row", "id", "item_id", "item_words", "place", "at", "vals", "item_vals", "kinds")
    groups = met.repartition("row", "item_row").sortWithinPartitions("row", "item_row")

    def run(batches):
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        out = []
        for _, group in groupby(rows, key=lambda r: r[:2]):
            group = list(group)
            doc, item, words = group[0][2:5]
            covered = consistent([(r[5], r[6], np.frombuffer(r[7], np.uint64), np.frombuffer(r[8], np.uint64),
                                   np.frombuffer(r[9], np.int8)) for r in group], words)
            if len(covered) >= min(COVER, words):
                out.append((doc, item, len(covered), words))
        if out:
            kinds = (kind, pa.int64(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                             [name, "item_id", "covered", "item_words"])

    kind, name = to_arrow_type(docs.schema[key].dataType), key
    held = groups.mapInArrow(run, f"`{key}` {id_kind}, item_id long, covered int, item_words int")
    few = staged(_short(items, "long", False), "benchmark-short").withColumnRenamed("id", "item_id")
    if few.isEmpty():  # no line can equal one
        return held
    words = (F.length("vals") / 8).cast("int")
    return held.unionByName(_short(rows, id_kind, True).join(few, "vals").select(
        F.col("id").alias(key), "item_id", words.alias("covered"), words.alias("item_words")))


def keep_clean(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with all columns. Whether
    a text holds one depends on the text alone, so its digest decides."""
    digest = free_name(docs, "_digest")
    rows = docs.withColumn(digest, F.sha2(F.coalesce(docs[f"`{text}`"].cast("string"), F.lit("")), 256))
    held = staged(matches(rows, benchmark, text, digest).select(digest).distinct(), "contaminated")
    return without(rows, held, digest).select(*[F.col(f"`{c}`") for c in docs.columns])
