"""Runs of periodic words in texts, by internal pattern matching.

A run is a stretch of words with smallest period q, at least ``LEAST`` words and three periods long, that no neighbouring
word extends.  Texts are looked at in chunks; within one, suffixes are sorted by prefix doubling, refining only those that
are still tied, and a wavelet tree over the suffix array answers in which positions suffixes of a range stand.

Patterns are one, two or three neighbouring dyadic blocks.  A pattern of B words at position i asks for its next
occurrence after i, a range successor: the smallest position above i in the pattern's range of the suffix array.  If it
stands at most B words on, the two overlap or touch, so the text between has that distance as its smallest period: the
step of the progression in which the pattern's occurrences stand.  Which blocks suffice: a run of period q holds every
pattern of B words that starts on a multiple of S inside it, with its next occurrence, if it has S + B + q - 1 words.
Then B >= q makes the distance the smallest period.  8-word blocks do for q <= 8 (runs have 24 words), three 4-word
blocks for 9 <= q <= 12, and two or three blocks of b = 8, 16, ... words for q up to 2b and from 2b up to 3b, as runs have
3q words.  Every distance is extended both ways to its maximal run, so runs found several times are one.

Documents are one row each and never meet; a map without a shuffle.  What a task holds grows with one chunk, or with one
text where that is longer.

Defined results: a null or empty text, or one of white space, has no words and no runs; equal rows give equal results, a
row each; a null id repeats no words; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipwright.llm.common import whole_text

#: Words a run has at least; a run has three periods at least.
LEAST = 24
#: Words of the texts that are sorted together; a longer text is a chunk of its own.
CHUNK_WORDS = 1 << 16

SCHEMA = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def suffix_ranks(codes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of the suffixes that share their first ``LEAST`` // 3 words with another one, and LCPs of neighbours.

    ``codes`` are words as numbers, different in different texts; ``ends`` the end of each position's text.  Suffixes are
    ordered by doubling, where only suffixes that are still tied are looked at.  What is apart after eight words has no
    repeated pattern and is left out.
    """
    n, shortest = len(codes), LEAST // 3
    order = np.argsort(codes, kind="stable")
    head = np.flatnonzero(np.r_[True, np.diff(codes[order]) != 0])
    rank = np.empty(n + 1, np.int64)                # place of the first suffix of the class
    rank[order] = np.repeat(head, np.diff(np.r_[head, n]))
    rank[n] = -1
    size = np.diff(np.r_[head, n])
    tied = order[np.repeat(size > 1, size)]         # in class order
    depth, kept, ranks = 1, None, [rank.astype(np.int32)]
    while len(tied):
        following = tied + depth
        second = np.where(following < ends[tied], rank[np.minimum(following, n)], -1)
        first = rank[tied]
        by = np.lexsort((second, first))
        tied, first, second = tied[by], first[by], second[by]
        new = np.r_[True, (np.diff(first) != 0) | (np.diff(second) != 0)]
        starts = np.flatnonzero(new)
        # the class keeps its first place, its parts follow one another
        base = np.flatnonzero(np.r_[True, np.diff(first) != 0])
        within = np.arange(len(tied)) - np.repeat(base, np.diff(np.r_[base, len(tied)]))
        size = np.diff(np.r_[starts, len(tied)])
        rank[tied] = np.repeat(first[starts] + within[starts], size)
        depth *= 2
        ranks.append(rank.astype(np.int32))
        if depth == shortest:
            kept = tied[np.repeat(size > 1, size)]
        tied = tied[np.repeat(size > 1, size)]
    if kept is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    array = kept[np.argsort(rank[kept], kind="stable")]
    # common prefixes of neighbours from the classes at every depth, largest step first
    a, b = array[:-1].copy(), array[1:].copy()
    lcp = np.zeros(max(len(array) - 1, 0), np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        step = 1 << level
        fits = (a + step <= ends[array[:-1]]) & (b + step <= ends[array[1:]])
        same = fits & (ranks[level][np.minimum(a, n)] == ranks[level][np.minimum(b, n)])
        lcp += same * step
        a, b = a + same * step, b + same * step
    return array, lcp


class WaveletTree:
    """Range successors in a sequence of numbers, for many queries at once.

    Level by level the numbers are divided by their next bit, highest first; ``zeros`` counts the zero bits before each
    place.
    """

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(values.max(initial=0)).bit_length())
        self.zeros = []
        for bit in range(self.bits - 1, -1, -1):
            ones = (values >> bit) & 1
            self.zeros.append(np.r_[0, np.cumsum(1 - ones)])
            values = np.r_[values[ones == 0], values[ones == 1]]

    def below(self, low: np.ndarray, high: np.ndarray, value: np.ndarray) -> np.ndarray:
        """How many numbers of places low to high are smaller than ``value``."""
        count = np.zeros(len(low), np.int64)
        for level, zeros in enumerate(self.zeros):
            a, b = zeros[low], zeros[high]
            one = (value >> (self.bits - 1 - level)) & 1 == 1
            count += np.where(one, b - a, 0)
            low, high = np.where(one, zeros[-1] + low - a, a), np.where(one, zeros[-1] + high - b, b)
        return count

    def smallest(self, low: np.ndarray, high: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The number at ``place``, from 0, of the sorted numbers of places low to high."""
        value = np.zeros(len(low), np.int64)
        for zeros in self.zeros:
            a, b = zeros[low], zeros[high]
            one = place >= b - a
            value = 2 * value + one
            place = np.where(one, place - (b - a), place)
            low, high = np.where(one, zeros[-1] + low - a, a), np.where(one, zeros[-1] + high - b, b)
        return value

    def successor(self, low: np.ndarray, high: np.ndarray, value: np.ndarray) -> np.ndarray:
        """The smallest number above ``value`` among places low to high, -1 if there is none."""
        before = self.below(low, high, value + 1)
        found = before < high - low
        out = np.full(len(low), -1, np.int64)
        out[found] = self.smallest(low[found], high[found], before[found])
        return out


def patterns(longest: int) -> Iterator[tuple[int, int]]:
    """(step, words): patterns of that many words on every multiple of the step, as far as any recurs."""
    yield LEAST // 3, LEAST // 3
    yield 4, 12
    block = 8
    while 2 * block <= longest:
        yield block, 2 * block
        yield block, 3 * block
        block *= 2


def candidates(codes: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, distance) of patterns whose next occurrence overlaps or touches them."""
    array, lcp = suffix_ranks(codes, ends)
    if not len(array):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    tree, places = WaveletTree(array), np.arange(len(array))
    where, distances = [], []
    for step, words in patterns(int(lcp.max(initial=0))):
        # suffixes that share the pattern are neighbours; ranges of one are patterns that do not recur
        apart = np.r_[0, np.flatnonzero(lcp < words) + 1, len(array)]
        size = np.diff(apart)
        low = np.repeat(apart[:-1], size)
        asked = (np.repeat(size, size) > 1) & ((array - begins[array]) % step == 0) & (array + words <= ends[array])
        asked = places[asked]
        low, high = low[asked], low[asked] + np.repeat(size, size)[asked]
        following = tree.successor(low, high, array[asked])
        distance = following - array[asked]
        near = (following >= 0) & (distance <= words)
        where.append(array[asked][near])
        distances.append(distance[near])
    return np.concatenate(where), np.concatenate(distances)


def stretch(same: np.ndarray, at: int, by: int, limit: int) -> int:
    """How many steps from ``at`` in direction ``by`` words stay equal, looked at in doubling portions."""
    codes, distance = same
    length, portion = 0, 32
    while length < limit:
        portion = min(portion, limit - length)
        if by > 0:
            a, b = at + length, at + length + portion
            differ = codes[a:b] != codes[a + distance: b + distance]
        else:
            a, b = at - length - portion, at - length
            differ = (codes[a:b] != codes[a + distance: b + distance])[::-1]
        if differ.any():
            return length + int(differ.argmax())
        length, portion = length + portion, 2 * portion
    return length


def runs_of(codes: np.ndarray, found: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(start, length, period) of one text's runs by start, then period, from its candidates."""
    out, until = set(), {}
    for at, period in sorted(found):
        if at < until.get(period, 0):               # inside the last stretch of this period
            continue
        start = at - stretch((codes, period), at, -1, at)
        end = at + stretch((codes, period), at, 1, len(codes) - period - at) + period
        until[period] = end - period
        if end - start >= max(LEAST, 3 * period):
            out.add((start, end - start, period))
    return sorted(out, key=lambda r: (r[0], r[2]))


def find_runs(texts: list[list]) -> list[list[tuple[int, int, int]]]:
    """Runs of each list of words; words are compared as they are."""
    out, at = [], 0
    while at < len(texts):
        to, words = at, 0
        while to < len(texts) and (to == at or words + len(texts[to]) <= CHUNK_WORDS):
            words += len(texts[to])
            to += 1
        known: dict = {}
        number = known.setdefault
        own = [np.array([number(w, len(known)) for w in t], np.int64) for t in texts[at:to]]
        sizes = np.array([len(t) for t in own])
        bounds = np.r_[0, np.cumsum(sizes)]
        text_of = np.repeat(np.arange(len(own)), sizes)
        codes = np.concatenate(own) + text_of * len(known)
        positions, distances = candidates(codes, bounds[:-1][text_of], bounds[1:][text_of])
        held: list[list] = [[] for _ in own]
        for text, position, distance in zip(text_of[positions].tolist(), (positions - bounds[:-1][text_of[positions]]).tolist(),
                                            distances.tolist()):
            held[text].append((position, distance))
        out += [runs_of(c, h) if h else [] for c, h in zip(own, held)]
        at = to
    return out


def collapsed(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words without those that a run holds after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


def repeated_words(words: list, number: int | None) -> list:
    """The words, where ``number`` = crc32 of the id is a multiple of ten with a part written over by its first words."""
    if number is None or number % 10 or not words:
        return words
    n, g = len(words), number // 10
    at = g % n
    period = 1 + (n - at) // (3 + g % 8)
    repeats = -(-(n - at) // period)
    return words[:at] + (words[at: at + period] * repeats)[: n - at]


def _run(plant: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.split() for t in batch.column("text").cast(pa.binary()).to_pylist()]     # ASCII white space
            if plant:
                numbers = [None if i is None else zlib.crc32(i.encode()) for i in batch.column("said").to_pylist()]
                texts = [repeated_words(t, i) for t, i in zip(texts, numbers)]
            runs = find_runs(texts)
            kinds = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
            listed = [[dict(zip(("start", "length", "period"), r)) for r in own] for own in runs]
            left = [b" ".join(collapsed(t, own)) for t, own in zip(texts, runs)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(map(len, texts), pa.int64()), pa.array(listed, kinds), pa.array(left, pa.binary()).cast(pa.string())],
                names=["id", "n_words", "runs", "collapsed"])

    return run


def periodic_runs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", plant: bool = False) -> DataFrame:
    """(id, n_words, runs, collapsed) of every document: its runs, and its text with one period left of each.

    ``plant`` first writes periodic words into the texts whose id's crc32 is a multiple of ten, so that tables without
    runs have some.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.col(id_column).cast("string").alias("said"), whole_text(text_column).alias("text"))
    schema = f"id {rows.schema['id'].dataType.simpleString()}, {SCHEMA}"
    return rows.mapInArrow(_run(plant), schema).withColumnRenamed("id", id_column)
