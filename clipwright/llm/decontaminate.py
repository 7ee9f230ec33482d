"""Benchmark decontamination by greedy string tiling.

Texts and test items are sequences of words (A-Z in lower case, ASCII signs ignored), known by 64-bit fingerprints.
Karp-Rabin fingerprints of ``match`` consecutive words are the seeds: a document and an item that share none have no
tile.  For every pair that shares seeds, the longest match of words that no tile holds yet becomes a tile, again and
again, until no match of ``match`` words is left; ties go to the earlier place in the document, then in the item.  As
tiles may come in any order, a passage whose parts were rearranged is covered like a straight copy.  A pair is reported
if its tiles cover at least ``coverage`` of the item's words.

The test items are a stated set held against all documents: they are cut into blocks of at most ``block_words`` words,
and each block's seeds are broadcast (16 bytes a word) for one pass over the documents.  No document is shuffled, a
document is tiled where it is read, and only pairs that share a seed are looked at.

Defined results: null or empty texts and items, and items of fewer than ``match`` words, are in no pair; repeated
documents and items, and null ids, give a pair each; an empty table on either side gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipwright.llm.common import WordHasher, mixed, runs, text_slices, whole_text

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.ones(256, bool)
_WORD[:128] = [chr(i).isalnum() for i in range(128)]
#: Base of the rolling fingerprint over word fingerprints.
ROLL = np.uint64(0xA24BAED4963EE407)


def word_hashes(data: np.ndarray, offsets: np.ndarray, hasher: WordHasher) -> tuple[np.ndarray, np.ndarray]:
    """(word fingerprints, words before each text) of a block of texts."""
    data = _LOWER[data]
    starts, ends, firsts = runs(_WORD[data], offsets)
    return hasher(data, starts, ends), firsts


def seeds(words: np.ndarray, width: int) -> np.ndarray:
    """Fingerprint of every run of ``width`` words."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    rolled = np.zeros(n, np.uint64)
    for k in range(width):
        rolled = rolled * ROLL + words[k: k + n]
    return mixed(rolled)


def tiles(text: np.ndarray, item: np.ndarray, at: np.ndarray, on: np.ndarray, width: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (place in text, place in item, length), given the pairs of places where a seed of both begins."""
    order = np.lexsort((at, at - on))
    at, on = at[order], on[order]
    diagonal = at - on
    # seeds that follow each other on a diagonal are one maximal match
    cut = np.flatnonzero(np.concatenate([[True], (diagonal[1:] != diagonal[:-1]) | (at[1:] != at[:-1] + 1), [True]]))
    heap = [(-(int(e - b) + width - 1), int(at[b]), int(on[b])) for b, e in zip(cut[:-1], cut[1:])]
    heapq.heapify(heap)
    used_text, used_item, out = np.zeros(len(text), bool), np.zeros(len(item), bool), []
    while heap:
        length, i, j = heapq.heappop(heap)
        length = -length
        free = ~(used_text[i: i + length] | used_item[j: j + length])
        if free.all():
            used_text[i: i + length] = used_item[j: j + length] = True
            out.append((i, j, length))
            continue
        # what earlier tiles left of this match
        edge = np.flatnonzero(np.diff(np.concatenate([[False], free, [False]]).astype(np.int8)))
        for b, e in zip(edge[::2].tolist(), edge[1::2].tolist()):
            if e - b >= width:
                heapq.heappush(heap, (-(e - b), i + b, j + b))
    return out


class Block:
    """The words and the seeds of some test items, ready for lookups."""

    def __init__(self, items: list[tuple[object, np.ndarray]], width: int):
        self.ids, self.words, self.width = [i for i, _ in items], [w for _, w in items], width
        keys = [seeds(w, width) for w in self.words]
        owner = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
        place = np.concatenate([np.arange(len(k)) for k in keys]) if keys else np.zeros(0, np.int64)
        key = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        order = np.argsort(key, kind="stable")
        self.key, self.owner, self.place = key[order], owner[order], place[order]
        # most words of a document are ruled out by one bit of a table that fits a processor's cache
        self.mask = np.zeros(1 << 20, bool)
        self.mask[(self.key >> np.uint64(44)).astype(np.int64)] = True

    def pairs(self, words: np.ndarray, firsts: np.ndarray):
        """(text, item, tiles) of every pair that shares a seed."""
        rolled = seeds(words, self.width)
        hit = np.flatnonzero(self.mask[(rolled >> np.uint64(44)).astype(np.int64)])
        low = np.searchsorted(self.key, rolled[hit], "left")
        high = np.searchsorted(self.key, rolled[hit], "right")
        hit, low, high = (x[high > low] for x in (hit, low, high))
        text = np.searchsorted(firsts, hit, "right") - 1
        inside = hit + self.width <= firsts[text + 1]          # a seed does not run into the next text
        hit, low, high, text = (x[inside] for x in (hit, low, high, text))
        bounds = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1], [True]])) if len(text) else np.zeros(1, np.int64)
        for b, e in zip(bounds[:-1], bounds[1:]):
            doc, n = int(text[b]), high[b:e] - low[b:e]
            index = np.repeat(low[b:e] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            at, item, on = np.repeat(hit[b:e], n) - firsts[doc], self.owner[index], self.place[index]
            own = words[firsts[doc]: firsts[doc + 1]]
            for number in np.unique(item):
                mine = item == number
                yield doc, int(number), tiles(own, self.words[number], at[mine], on[mine], self.width)


def _item_blocks(benchmark: DataFrame, id_column: str, text_column: str, width: int, block_words: int):
    """Items as word fingerprints, in blocks of at most ``block_words`` words (or one longer item)."""
    def run(batches):
        hasher = WordHasher()
        for batch in batches:
            for at, to, data, offsets in text_slices(batch.column("text")):
                words, firsts = word_hashes(data, offsets, hasher)
                packed = [words[a:b].tobytes() for a, b in zip(firsts[:-1], firsts[1:])]
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(at, to - at), pa.array(packed, pa.binary())],
                                                 names=["id", "words"])

    rows = benchmark.select(F.col(id_column).alias("id"), whole_text(text_column).alias("text"))
    rows = rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, words binary")
    rows = rows.filter(F.octet_length("words") >= 8 * width).orderBy("id", "words")
    block, size = [], 0
    for row in rows.toLocalIterator():
        words = np.frombuffer(row["words"], np.uint64)
        if block and size + len(words) > block_words:
            yield block
            block, size = [], 0
        block.append((row["id"], words))
        size += len(words)
    if block:
        yield block


def contaminated(docs: DataFrame, benchmark: DataFrame, match: int = 5, coverage: float = 0.5, block_words: int = 2_000_000,
                 id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id",
                 item_text_column: str = "text") -> DataFrame:
    """(id, item id, coverage, n_tiles, n_words, longest, first_word) of documents that hold a test item.

    ``n_words`` are the item's covered words, ``first_word`` is where the first tile stands in the document.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_column).alias("id"), whole_text(text_column).alias("text"))
    item_type = benchmark.schema[item_column].dataType.simpleString()
    schema = (f"`{id_column}` {rows.schema['id'].dataType.simpleString()}, `{item_column}` {item_type}, coverage double, "
              "n_tiles int, n_words int, longest int, first_word int")
    result = None

    def searcher(shared):
        def run(batches):
            hasher = WordHasher()
            for batch in batches:
                found = []
                for at, _, data, offsets in text_slices(batch.column("text")):
                    words, firsts = word_hashes(data, offsets, hasher)
                    for doc, number, own in shared.value.pairs(words, firsts):
                        covered = sum(length for _, _, length in own)
                        share = covered / len(shared.value.words[number])
                        if share >= coverage:
                            found.append((at + doc, shared.value.ids[number], share, len(own), covered,
                                          max(x[2] for x in own), min(x[0] for x in own)))
                if found:
                    places, ids, *numbers = zip(*found)
                    ints = [pa.array(x, pa.int32()) for x in numbers[1:]]
                    yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(places)), pa.array(ids),
                                                      pa.array(numbers[0]), *ints],
                                                     names=[id_column, item_column, "coverage", "n_tiles", "n_words",
                                                            "longest", "first_word"])

        return run

    for items in _item_blocks(benchmark, item_column, item_text_column, match, block_words):
        shared = spark.sparkContext.broadcast(Block(items, match))
        part = rows.mapInArrow(searcher(shared), schema)
        result = part if result is None else result.unionByName(part)
    return spark.createDataFrame([], schema) if result is None else result


def without_contaminated(docs: DataFrame, benchmark: DataFrame, match: int = 5, coverage: float = 0.5,
                         block_words: int = 2_000_000, text_column: str = "text", item_column: str = "item_id",
                         item_text_column: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text no test item's tiles cover enough of."""
    schema, at = docs.schema, docs.columns.index(text_column)

    def keeper(shared):
        def run(batches):
            hasher = WordHasher()
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                texts = batch.column(at)
                for begin, _, data, offsets in text_slices(texts):
                    words, firsts = word_hashes(data, offsets, hasher)
                    for doc, number, own in shared.value.pairs(words, firsts):
                        covered = sum(length for _, _, length in own)
                        keep[begin + doc] &= covered / len(shared.value.words[number]) < coverage
                yield batch.filter(pa.array(keep))

        return run

    for items in _item_blocks(benchmark, item_column, item_text_column, match, block_words):
        docs = docs.mapInArrow(keeper(docs.sparkSession.sparkContext.broadcast(Block(items, match))), schema)
    return docs
