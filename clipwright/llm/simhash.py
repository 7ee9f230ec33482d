"""Near duplicates by 64-bit SimHash fingerprints, with pivot distance tables.

A fingerprint bit is the majority of that bit over the XXH64 of a text's word shingles.  Fingerprints that differ in at
most ``radius`` bits are linked, and linked documents form components.

Every distinct fingerprint gets a table row: its Hamming distances to ``PIVOTS`` reference fingerprints, precomputed.
By the triangle inequality two fingerprints differ in at least as many bits as any coordinate of their rows does, so a
pair whose largest coordinate difference exceeds the radius is discarded; survivors are verified.  Distances to
references cluster around 32, so they can rule pairs out but offer no key to bring pairs together.  The pairs looked
at are therefore those that agree on whole blocks of bits: with radius 4 and 4 + s blocks, at least s blocks agree.
s grows with the number of distinct fingerprints; the links found are the same for every s.

Copies share a fingerprint and cost nothing.  A large group of near copies never becomes all its pairs: every bucket
first links its members to its smallest one, components of these links are formed, and only members outside a bucket's
most common component are compared with the rest of the bucket.

Defined results: a null or empty text, or one of white space, has fingerprint zero and is linked like any other; fewer
words than a shingle make one shingle; repeated rows give a row each; a null id is never the smallest (a component of
null ids only has a null id); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipwright.llm.common import whole_text, written
from clipwright.llm.graphs import components

#: Reference fingerprints; eight distances fit one long of the table.
PIVOTS = 16
SEED = 42
#: Shingles whose bits are counted at once.
STEP = 1 << 15


def fingerprint(text: bytes, width: int) -> int:
    """Unsigned fingerprint of a UTF-8 text over shingles of ``width`` words."""
    import xxhash

    words = text.lower().split()     # on bytes both touch ASCII only
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    size = min(width, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
    begins, ends = starts[: len(words) - size + 1].tolist(), (starts + lengths)[size - 1:].tolist()
    counts = np.zeros(64, np.int64)
    for at in range(0, len(begins), STEP):
        part = [digest(joined[b:e], SEED) for b, e in zip(begins[at: at + STEP], ends[at: at + STEP])]
        bits = np.unpackbits(np.array(part, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(0, dtype=np.int64)
    over = np.packbits(2 * counts > len(begins))
    return int.from_bytes(over.tobytes(), "big")


def _fingerprints(width: int):
    def run(batches):
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            found = np.array([fingerprint(t, width) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found)], names=["id", "fp"])

    return run


def fingerprints(docs: DataFrame, width: int = 4, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, fp) of every document, fp as a signed long."""
    rows = docs.select(F.col(id_column).alias("id"), whole_text(text_column).alias("text"))
    return rows.mapInArrow(_fingerprints(width), f"id {rows.schema['id'].dataType.simpleString()}, fp long")


def differing(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def pivot_rows(fps: DataFrame) -> DataFrame:
    """``fps`` with the distances to the references, one byte each, in ``d0``, ``d1``, ..."""
    tables = {}
    for at in range(0, PIVOTS, 8):
        packed = F.lit(0).cast("long")
        for j in range(8):
            distance = F.bit_count(F.col("fp").bitwiseXOR(F.xxhash64(F.lit(at + j)))).cast("long")
            packed = packed.bitwiseOR(F.shiftleft(distance, 8 * j))
        tables[f"d{at // 8}"] = packed
    return fps.withColumns(tables)


def pivots_allow(left: str, right: str, radius: int) -> Column:
    """Whether no coordinate of two table rows differs by more than the radius."""
    allowed = F.lit(True)
    for table in range(PIVOTS // 8):
        a, b = F.col(f"{left}.d{table}"), F.col(f"{right}.d{table}")
        for j in range(8):
            byte = lambda x: F.shiftrightunsigned(x, 8 * j).bitwiseAND(255)  # noqa: B023, E731
            allowed = allowed & (F.abs(byte(a) - byte(b)) <= radius)
    return allowed


def block_keys(radius: int, n: int) -> list[Column]:
    """Keys of a fingerprint; two within the radius share one.  Longer keys for more fingerprints."""
    for same in range(1, 5):
        blocks = radius + same
        edges = [64 * i // blocks for i in range(blocks + 1)]
        if same == 4 or (1 << (64 // blocks * same)) >= n:
            break
    keys = []
    for number, chosen in enumerate(combinations(range(blocks), same)):
        bits = sum(((1 << edges[i + 1]) - (1 << edges[i])) for i in chosen)
        signed = bits - (1 << 64) if bits >= 1 << 63 else bits
        keys.append(F.struct(F.lit(number).alias("number"), F.col("fp").bitwiseAND(F.lit(signed).cast("long")).alias("bits")))
    return keys


def link(fps: DataFrame, radius: int = 4) -> DataFrame:
    """(fp, component) of the distinct fingerprints that have a link; the component is one of its fingerprints."""
    fps = pivot_rows(fps)
    keyed = fps.withColumn("key", F.explode(F.array(*block_keys(radius, fps.count()))))
    buckets = keyed.groupBy("key").agg(F.min("fp").alias("centre"), F.count("*").alias("members")).filter("members > 1")
    crowded = written(keyed.join(buckets, "key").drop("members"), "simhash-buckets")

    # every bucket as a star around its smallest member
    stars = crowded.filter((F.col("fp") != F.col("centre")) & (differing("fp", "centre") <= radius))
    first = components(stars.select(F.col("fp").alias("a"), F.col("centre").alias("b")))
    named = crowded.drop("centre").join(first, F.col("fp") == F.col("node"), "left").drop("node")
    named = written(named.withColumn("component", F.coalesce("component", "fp")), "simhash-members")

    # what the stars left apart: members outside the bucket's main component against the whole bucket
    counted = named.groupBy("key", "component").agg(F.count("*").alias("n"))
    main = counted.groupBy("key").agg(F.max_by("component", F.struct("n", "component")).alias("main"),
                                      F.count("*").alias("parts")).filter("parts > 1")
    others = named.join(main, "key").filter(F.col("component") != F.col("main"))
    meets = others.alias("l").join(
        named.alias("r"),
        (F.col("l.key") == F.col("r.key")) & (F.col("l.component") != F.col("r.component"))
        & pivots_allow("l", "r", radius) & (differing("l.fp", "r.fp") <= radius))
    bridges = meets.select(F.greatest("l.component", "r.component").alias("a"), F.least("l.component", "r.component").alias("b"))
    second = components(bridges).withColumnsRenamed({"node": "of", "component": "joined"})

    members = named.select("fp", "component").distinct()
    return members.join(second, F.col("component") == F.col("of"), "left").select(
        "fp", F.coalesce("joined", "component").alias("component"))


def near_duplicates(docs: DataFrame, width: int = 4, radius: int = 4, id_column: str = "doc_id",
                    text_column: str = "text") -> DataFrame:
    """(id, fp, component_id) of every document; component_id is the smallest id that links reach, its own included."""
    marked = written(fingerprints(docs, width, id_column, text_column), "simhash")
    distinct = written(marked.groupBy("fp").agg(F.min("id").alias("least")), "simhash-distinct")
    linked = link(distinct.select("fp"), radius)
    grouped = distinct.join(linked, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    grouped = written(grouped, "simhash-components")
    named = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    names = written(grouped.join(named, "component").select("fp", "component_id"), "simhash-names")
    return marked.join(names, "fp").select(F.col("id").alias(id_column), "fp", "component_id")


def as_hex(fp: str = "fp") -> Column:
    return F.lpad(F.lower(F.hex(F.col(fp))), 16, "0")
