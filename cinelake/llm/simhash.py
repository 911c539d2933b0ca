"""SimHash near-duplicates over pivot distance tables.

Fingerprints of w-word shingles link at ``max_bits`` or fewer differing bits.
The pivot table holds, for a distinct fingerprint, its Hamming distances to
many reference fingerprints (the pivots). Candidates share ``j`` of
``max_bits + j`` bands of bits, as two within ``max_bits`` must. No link moves a
coordinate by more than ``max_bits``, so pairs whose maximum coordinate
difference is larger are discarded, and the survivors are verified by their own distance.

Blocks (fingerprints with the same bands) are counted first, by partial
aggregates. Those of more than ``BLOCK`` fingerprints form no pairs: their
fingerprints go to the next level, with more and narrower bands, so that more bits are shared.
A linked pair shares a block at every level; it is found at the first one at which a
shared block is small. On the last level a block cannot hold more
fingerprints than the bits outside its bands allow (256 for 2 bits, 4096 for 3, the most), so nothing is capped.

Exact copies are one fingerprint before the table, and the links between fingerprints
are contracted by ``components``.

Defined results: null and wordless texts have fingerprint zero and link like
others; a null doc_id is a row like others, and a component whose doc_ids are
all null has component_id null; repeated rows each give a row; an empty table
gives none. Further columns are kept (``keep_one``) whatever their names are.
"""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.llm.components import components
from cinelake.llm.tables import free_name, prepare, staged, texts, without

MAX_BITS, MOST_BITS, PIVOTS = 2, 3, 16
#: Fingerprints of a block that are paired, and the shared bands of each level.
BLOCK, LEVELS = 256, (2, 4, 8, 16)
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_CHUNK = 1 << 16


def pivots(count: int = PIVOTS, seed: int = 42) -> list[int]:
    """Reference fingerprints: XXH64 of their numbers, as signed longs."""
    return [_signed(xxhash.xxh64_intdigest(f"pivot {i}".encode(), seed)) for i in range(count)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprint(text: str, words_a_shingle: int = 3) -> int:
    """SimHash of a text as a signed 64-bit integer."""
    words = text.encode().translate(_LOWER).split()  # bytes split at the six ASCII white spaces
    if not words:
        return 0
    joined, width = b" ".join(words), min(words_a_shingle, len(words))
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[:len(words) - width]]
    digest, set_bits = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for k in range(0, len(starts), _CHUNK):
        hashes = np.array([digest(joined[a:b - 1], 42) for a, b in zip(
            starts[k:k + _CHUNK], ends[k + width - 1:k + width - 1 + _CHUNK])], np.dtype("<u8"))
        set_bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, np.int64)
    bits = np.packbits(2 * set_bits > len(starts), bitorder="little")
    return int(bits.view(np.dtype("<i8"))[0])


def fingerprints(docs: DataFrame, text: str, columns: list[str], row: str, out: str,
                 words_a_shingle: int = 3) -> DataFrame:
    """``columns`` of ``docs``, a row number unique in the result, and the fingerprint."""
    prepare(docs.sparkSession)
    rows = docs.select(*[docs[f"`{c}`"] for c in columns], docs[f"`{text}`"].cast("string").alias(free_name(docs, "_text_")))
    schema = docs.select(*[docs[f"`{c}`"] for c in columns]).schema.add(row, "long").add(out, "long")

    def run(batches):
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            found = [fingerprint(t, words_a_shingle) for t in texts(batch.column(len(columns)))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(range(number, number + len(found)), pa.int64()),
                 pa.array(found, pa.int64())], [*columns, row, out])
            number += len(found)

    return rows.mapInArrow(run, schema)


def masks(max_bits: int, shared: int) -> list[int]:
    """Every choice of ``shared`` of ``max_bits + shared`` bands, as a mask of its bits."""
    count = max_bits + shared
    if not 0 <= max_bits <= MOST_BITS:
        raise ValueError(f"max_bits must lie between 0 and {MOST_BITS}")
    ends = [64 * k // count for k in range(count + 1)]
    bands = [(1 << b) - (1 << a) for a, b in zip(ends, ends[1:])]
    return [_signed(sum(chosen)) for chosen in combinations(bands, shared)]


def pivot_table(prints: DataFrame, refs: list[int]) -> DataFrame:
    """(fp, distances): the Hamming distances of each fingerprint to the pivots."""
    return prints.select("fp", F.array(*[F.bit_count(F.col("fp").bitwiseXOR(F.lit(r).cast("long"))).cast("byte")
                                         for r in refs]).alias("distances"))


def candidates(table: DataFrame, max_bits: int = MAX_BITS, pivot_count: int = PIVOTS,
               block: int = BLOCK, levels: tuple[int, ...] = LEVELS) -> DataFrame:
    """(fp, other, gap): pairs of the pivot table that share a small block, fp < other,
    and their maximum coordinate difference. A pair may stand in several blocks."""
    found = None
    for shared in levels:
        keyed = table.select("fp", "distances", F.posexplode(F.array(
            *[F.col("fp").bitwiseAND(F.lit(m).cast("long")) for m in masks(max_bits, shared)])).alias("part", "bands"))
        sizes = keyed.groupBy("part", "bands").agg(F.count(F.lit(1)).alias("n"))
        sizes = staged(sizes.where("n > 1"), "pivot-blocks")
        last = shared == levels[-1]
        few = sizes if last else sizes.where(F.col("n") <= block)
        met = staged(keyed.join(few.drop("n"), ["part", "bands"]), "pivot-rows")
        other = met.select("part", "bands", F.col("fp").alias("other"), F.col("distances").alias("others"))
        gap = F.array_max(F.array(*[F.abs(F.col("distances")[i] - F.col("others")[i]) for i in range(pivot_count)]))
        pairs = met.join(other, ["part", "bands"]).where("fp < other").select("fp", "other", gap.alias("gap"))
        found = pairs if found is None else found.unionByName(pairs)
        many = sizes.where(F.col("n") > block).drop("n")
        if last or many.isEmpty():
            return found
        table = staged(keyed.join(many, ["part", "bands"]).select("fp", "distances").distinct(), "pivot-dense")
    return found


def links(prints: DataFrame, max_bits: int = MAX_BITS, refs: list[int] | None = None,
          block: int = BLOCK) -> DataFrame:
    """(fp, other): all pairs of the fingerprints (column ``fp``, distinct)
    that differ in ``max_bits`` or fewer bits, fp < other."""
    refs = pivots() if refs is None else refs
    pairs = candidates(staged(pivot_table(prints, refs), "pivot-table"), max_bits, len(refs), block)
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= max_bits
    return pairs.where(F.col("gap") <= max_bits).where(near).select("fp", "other").distinct()


def _classes(rows: DataFrame, key: str, row: str, fp: str, max_bits: int) -> DataFrame:
    """(fp, component_id, kept): of every distinct fingerprint, its component's
    smallest doc_id and the row number of its first document."""
    known = F.col(key).isNull().alias("late")
    own = staged(rows.groupBy(F.col(fp).alias("fp")).agg(
        F.min(F.struct(known, F.col(key).alias("id"), F.col(row).alias("row"))).alias("first")), "fingerprints")
    roots = staged(components(links(own.select("fp"), max_bits), "fp", "other"), "roots")
    linked = own.join(roots, own["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    firsts = linked.groupBy("root").agg(F.min("first").alias("least"))
    return linked.join(firsts, "root").select("fp", F.col("least.id").alias("component_id"),
                                              F.col("least.row").alias("kept"))


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", words_a_shingle: int = 3,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row."""
    source = docs.select(docs[key].cast("long").alias("doc_id"), docs[text].alias("text"))
    rows = staged(fingerprints(source, "text", ["doc_id"], "row", "fp", words_a_shingle), "simhash")
    classes = _classes(rows, "doc_id", "row", "fp", max_bits)
    return rows.join(classes, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, text: str = "text", key: str = "doc_id", words_a_shingle: int = 3,
             max_bits: int = MAX_BITS) -> DataFrame:
    """The columns of ``docs``; of each component the row with the smallest doc_id (of equal ones, one)."""
    row, fp = free_name(docs, "_simhash_row"), free_name(docs, "_simhash_fp")
    rows = staged(fingerprints(docs, text, docs.columns, row, fp, words_a_shingle), "simhash-rows")
    light = rows.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(row).alias("row"), F.col(fp).alias("print"))
    classes = _classes(light, "id", "row", "print", max_bits)
    dropped = light.join(classes, light["print"] == classes["fp"]).where("row <> kept").select(F.col("row").alias(row))
    return without(rows, staged(dropped, "near-copies"), row).select(*[F.col(f"`{c}`") for c in docs.columns])
