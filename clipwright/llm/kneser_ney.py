"""Language-model scores: an interpolated modified Kneser-Ney bigram model.

Tokens are lower-cased (A-Z) words between white space and one end token per text, known by 64-bit hashes.  Spark
counts them in three steps:

1. words: partial counts per task, summed by word;
2. bigrams: tasks send their distinct bigrams with counts, packed by shard.  A shard is a range of first words; a word
   that holds over a thousandth of all tokens has its bigrams dealt by both words, so no word fills a shard.  A shard
   merges what it gets, writes its sorted hash array, and passes on what the bigrams say of their words;
3. words again: counts, continuation counts and context totals of each word, written as sorted hash arrays.

The arrays lie in the shared folder, a file per shard, written under a temporary name and renamed, so a repeated task
only repeats them.  Workers map them into memory and look up sorted, distinct keys, a block of texts at a time.  Where
the shared folder is not a mounted file system, a worker copies a file beside itself before mapping it.

With counts n of bigrams (u, w) and discounts D from the counts of counts:
P(w|u) = (n - D(n) + (D1 N1(u) + D2 N2(u) + D3 N3(u)) P(w)) / n(u), and P(w) the same over distinct predecessors,
with 1 / (V + 1) below it, so that unseen words share one place.  Discounts are held within 0.1 and their count, as
small or repetitive tables give counts of counts that leave nothing for unseen bigrams.

Defined results: a null or empty text is its end token alone; repeated rows count and are scored as often as they
stand; null ids are scored (and trained on, as crc32 of the empty text decides); without training texts every
probability is 1; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipwright.llm.common import WordHasher, mixed, runs, text_slices, whole_text, written
from clipwright.session import scratch_path

END, START = np.uint64(0x5BD1E995A5A5F00D), np.uint64(0x1F83D9AB5BE0CD19)
#: Tokens of the corpus for each bigram shard, and words for each word shard.
SHARD_TOKENS, SHARD_WORDS = 2_000_000, 500_000
#: Pairs a task gathers before it makes them distinct, and half the words.
GATHER = 1_500_000
#: Shards sent on in one batch.
SENT = 8
LEAST_DISCOUNT = 0.1
WORD_FIELDS = ["word", "count", "continuation", "total", "n1", "n2", "n3"]

_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def tokens(data: np.ndarray, offsets: np.ndarray, hasher: WordHasher):
    """(tokens, the token before each, text of each, tokens before each text) of a block of texts."""
    data = _LOWER[data]
    starts, ends, firsts = runs(~_SPACE[data], offsets)
    docs = len(offsets) - 1
    of = np.repeat(np.arange(docs), np.diff(firsts))
    found = np.empty(len(starts) + docs, np.uint64)
    found[np.arange(len(starts)) + of] = hasher(data, starts, ends)
    begins = firsts + np.arange(docs + 1)
    found[begins[1:] - 1] = END
    before = np.empty_like(found)
    before[1:] = found[:-1]
    before[begins[:-1]] = START
    return found, before, np.repeat(np.arange(docs), np.diff(begins)), begins


def pair_key(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mixed(first * np.uint64(0xD6E8FEB86659FD93) + second)


def summed(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, one place of each in ``keys``, and their counts."""
    order = np.argsort(keys)
    ordered = keys[order]
    at = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(keys) else np.zeros(0, np.int64)
    if counts is None:
        totals = np.diff(np.append(at, len(keys)))
    else:
        totals = np.add.reduceat(counts[order], at) if len(keys) else np.zeros(0, np.int64)
    return ordered[at], order[at], totals


def drained(arrays: list[np.ndarray]) -> np.ndarray:
    """The arrays as one; the list is left empty, so that both are not held longer than needed."""
    joined = np.concatenate(arrays)
    arrays.clear()
    return joined


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    return ((hashes >> np.uint64(40)) * np.uint64(shards) >> np.uint64(24)).astype(np.int32)


def bigram_shard(first: np.ndarray, keys: np.ndarray, heavy: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each bigram: by its first word, by its key if that word is one of the (sorted) heavy ones."""
    if len(heavy):
        at = np.minimum(np.searchsorted(heavy, first), len(heavy) - 1)
        first = np.where(heavy[at] == first, keys, first)
    return shard_of(first, shards)


# ---------------------------------------------------------------- files

def _local(uri: str) -> str | None:
    if uri.startswith("file:"):
        return "/" + uri[5:].lstrip("/")
    return uri if "://" not in uri else None


def put(folder: str, name: str, arrays: list[np.ndarray]) -> None:
    """The arrays one after the other as a file, complete or not there at all."""
    local = _local(folder)
    if local:
        os.makedirs(local, exist_ok=True)
        path = f"{local}/{name}"
        with open(f"{path}.{uuid.uuid4().hex}", "wb") as file:
            for array in arrays:
                file.write(np.ascontiguousarray(array).data)
        os.replace(file.name, path)
        return
    from pyarrow import fs

    system, base = fs.FileSystem.from_uri(folder)
    system.create_dir(base, recursive=True)
    temporary = f"{base}/{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(temporary) as file:
        for array in arrays:
            file.write(np.ascontiguousarray(array).tobytes())
    system.move(temporary, f"{base}/{name}")


def mapped(folder: str, name: str) -> np.ndarray:
    """A file's bytes, mapped into memory."""
    local = _local(folder)
    if not local:
        import tempfile

        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(folder)
        with system.open_input_stream(f"{base}/{name}") as source, tempfile.NamedTemporaryFile() as copy:
            while block := source.read(1 << 24):
                copy.write(block)
            copy.flush()
            return np.memmap(copy.name, np.uint8, "r")
    return np.memmap(f"{local}/{name}", np.uint8, "r")


def _empty_shards(spark, folder: str, kind: str, shards: int) -> None:
    """A file for every shard, so that one into which nothing falls differs from one that cannot be seen."""
    def run(batches):
        for batch in batches:
            for shard in batch.column("id").to_pylist():
                put(folder, f"{kind}-{shard:07d}", [np.zeros(1, np.int64)])
            yield batch

    spark.range(shards).mapInArrow(run, "id long").write.format("noop").mode("overwrite").save()


# ---------------------------------------------------------------- counting

def _count_words(batches):
    hasher, words, counts = WordHasher(), [], []
    for batch in batches:
        for _, _, data, offsets in text_slices(batch.column("text")):
            key, _, n = summed(tokens(data, offsets, hasher)[0])
            words.append(key)
            counts.append(n)
            if sum(map(len, words)) > GATHER // 2:
                key, _, n = summed(drained(words), drained(counts))
                words, counts = [key], [n]
                if len(key) > GATHER // 4:
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n)], names=["word", "n"])
                    words, counts = [], []
    if words:
        key, _, n = summed(drained(words), drained(counts))
        for at in range(0, len(key), 1 << 18):
            yield pa.RecordBatch.from_arrays([pa.array(key[at: at + (1 << 18)].view(np.int64)), pa.array(n[at: at + (1 << 18)])],
                                             names=["word", "n"])


def _packed(first, second, heavy, shards):
    """Batches with a row for each shard: first words once each with how many bigrams follow, second words, counts.

    A task's memory is largest here, so arrays are let go as soon as they are used.
    """
    keys, at, counts = summed(pair_key(first, second))
    first, second = first[at], second[at]
    shard = bigram_shard(first, keys, heavy, shards)
    del keys, at
    order = np.lexsort((first, shard))
    first, second, counts, shard = first[order], second[order], counts[order], shard[order]
    del order
    edges = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1], [True]]))
    for some in range(0, len(edges) - 1, SENT):
        rows = {name: [] for name in ("shard", "first", "runs", "second", "n")}
        bounds = edges[some: some + SENT + 1]
        for begin, end in zip(bounds[:-1], bounds[1:]):
            own = first[begin:end]
            starts = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            n = counts[begin:end]
            rows["shard"].append(int(shard[begin]))
            rows["first"].append(own[starts].tobytes())
            rows["runs"].append(np.diff(np.append(starts, len(own))).astype(np.uint32).tobytes())
            rows["second"].append(second[begin:end].tobytes())
            rows["n"].append(n.astype(np.uint8 if n.max() < 256 else np.int64).tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows["shard"], pa.int32()), *(pa.array(rows[x], pa.binary()) for x in list(rows)[1:])], names=list(rows))


def _count_bigrams(heavy: np.ndarray, shards: int):
    def run(batches):
        hasher, first, second, size = WordHasher(), [], [], 0
        for batch in batches:
            for _, _, data, offsets in text_slices(batch.column("text")):
                word, before, _, _ = tokens(data, offsets, hasher)
                first.append(before)
                second.append(word)
                size += len(word)
                del word, before
                if size > GATHER:
                    yield from _packed(drained(first), drained(second), heavy, shards)
                    size = 0
        if size:
            yield from _packed(drained(first), drained(second), heavy, shards)

    return run


def _unpacked(rows: pd.DataFrame):
    first, second, counts = [], [], []
    for row in rows.itertuples():
        words = np.frombuffer(row.second, np.uint64)
        n = np.frombuffer(row.n, np.uint8 if len(row.n) == len(words) else np.int64)
        first.append(np.repeat(np.frombuffer(row.first, np.uint64), np.frombuffer(row.runs, np.uint32)))
        second.append(words)
        counts.append(n.astype(np.int64))
    return drained(first), drained(second), drained(counts)


def _merge_bigrams(folder: str):
    """Writes a shard's sorted hash array; returns what its bigrams say of their words, and counts of counts."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        first, second, n = _unpacked(rows)
        keys, at, n = summed(pair_key(first, second), n)
        first, second = first[at], second[at]
        put(folder, f"bigrams-{int(rows['shard'].iloc[0]):07d}", [np.array([len(keys)]), keys, n.astype(np.uint16 if n.max() < 1 << 16 else np.int64)])
        del keys, at
        order = np.argsort(first)
        first, own_n = first[order], n[order]
        at = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]]))
        u, (total, *stats) = first[at], [np.add.reduceat(x, at, dtype=np.int64) for x in (own_n, own_n == 1, own_n == 2, own_n > 2)]
        del first, own_n, order
        w, _, continuation = summed(second)
        zero = lambda k: np.zeros(k, np.int64)
        own = pd.DataFrame({"word": u.view(np.int64), "continuation": zero(len(u)), "total": total,
                            "n1": stats[0], "n2": stats[1], "n3": stats[2]})
        other = pd.DataFrame({"word": w.view(np.int64), "continuation": continuation, "total": zero(len(w)),
                              "n1": zero(len(w)), "n2": zero(len(w)), "n3": zero(len(w))})
        # counts of counts travel under a name of their own: four rows whose field ``total`` is the number
        tally = pd.DataFrame({"word": np.arange(4), "continuation": zero(4) - 1, "total": [int((n == k).sum()) for k in (1, 2, 3, 4)],
                              "n1": zero(4), "n2": zero(4), "n3": zero(4)})
        return pd.concat([own, other, tally], ignore_index=True)

    return run


def _write_words(folder: str):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        shard = int(rows["shard"].iloc[0])
        hashes = rows["word"].to_numpy(np.int64).view(np.uint64)
        order = np.argsort(hashes)
        put(folder, f"words-{shard:07d}", [np.array([len(order)]), hashes[order],
                                             *(rows[c].to_numpy(np.int64)[order] for c in WORD_FIELDS[1:])])
        return pd.DataFrame({"shard": [shard]})

    return run


def discounts(counts: list[int]) -> np.ndarray:
    """D(0), D(1), D(2), D(3 and more) from the numbers of types seen once, twice, three and four times."""
    n1, n2, n3, n4 = (float(max(c, 0)) for c in counts)
    y = n1 / (n1 + 2 * n2) if n1 + 2 * n2 else 0.5
    raw = [1 - 2 * y * n2 / n1 if n1 else y, 2 - 3 * y * n3 / n2 if n2 else y, 3 - 4 * y * n4 / n3 if n3 else y]
    return np.array([0.0, *(min(max(d, LEAST_DISCOUNT), k) for k, d in zip((1, 2, 3), raw))])


@dataclass
class Model:
    """Where the arrays lie, and the few numbers that hold for all of them."""

    folder: str
    bigram_shards: int
    word_shards: int
    n_tokens: int
    n_words: int
    heavy: np.ndarray
    bigram_discounts: np.ndarray
    word_discounts: np.ndarray
    continuations: int = 0
    word_types: list[int] = field(default_factory=lambda: [0, 0, 0])


def fit(docs: DataFrame, text_column: str = "text") -> Model:
    """Count the model over every row of ``docs`` and write its arrays to the shared folder."""
    spark = docs.sparkSession
    texts = docs.select(whole_text(text_column).alias("text"))
    folder = scratch_path(spark, "bigram-model")
    words = written(texts.mapInArrow(_count_words, "word long, n long").groupBy("word").agg(F.sum("n").alias("count")), "words")
    n_tokens, n_words = (x or 0 for x in words.agg(F.sum("count"), F.count("*")).first())
    shards, word_shards = max(1, -(-n_tokens // SHARD_TOKENS)), max(1, -(-(n_words + 1) // SHARD_WORDS))
    # at most a thousand words hold a thousandth of all tokens each; the start is before every text
    frequent = words.filter(F.col("count") * 1000 > n_tokens).toPandas()["word"].to_numpy(np.int64).view(np.uint64)
    heavy = np.sort(np.append(frequent, START).astype(np.uint64))

    _empty_shards(spark, folder, "bigrams", shards)
    _empty_shards(spark, folder, "words", word_shards)
    packed = texts.mapInArrow(_count_bigrams(heavy, shards), "shard int, first binary, runs binary, second binary, n binary")
    # an explicit number of partitions: a task merges one shard or two, not what is small when compressed
    partial = packed.repartition(shards, "shard").groupBy("shard").applyInPandas(
        _merge_bigrams(folder), "word long, continuation long, total long, n1 long, n2 long, n3 long")
    partial = written(partial, "bigram-words")
    tally = {r["word"]: r["n"] for r in partial.filter("continuation < 0").groupBy("word").agg(F.sum("total").alias("n")).collect()}
    told = partial.filter("continuation >= 0").withColumn("count", F.lit(0).cast("long"))
    counted = words.select("word", "count", *[F.lit(0).cast("long").alias(c) for c in WORD_FIELDS[2:]])
    merged = told.select(*WORD_FIELDS).union(counted.select(*WORD_FIELDS)).groupBy("word").agg(
        *[F.sum(c).alias(c) for c in WORD_FIELDS[1:]])
    merged = written(merged, "word-table")
    shard = F.shiftright(F.shiftrightunsigned("word", 40) * word_shards, 24).cast("int").alias("shard")
    merged.select(shard, *WORD_FIELDS).repartition(word_shards, "shard").groupBy("shard").applyInPandas(
        _write_words(folder), "shard int").write.format("noop").mode("overwrite").save()

    types = merged.select(F.sum("continuation"), *[F.count_if(F.col("continuation") == k) for k in (1, 2, 3, 4)],
                          F.count_if(F.col("continuation") > 2)).first()
    return Model(folder, shards, word_shards, n_tokens, n_words, heavy, discounts([tally.get(k, 0) for k in range(4)]),
                 discounts(list(types[1:5])), types[0] or 0, [types[1], types[2], types[5]])


# ---------------------------------------------------------------- scoring

class Lookup:
    """A worker's view of the arrays; files are mapped when first asked for."""

    def __init__(self, model: Model):
        self.model, self.files = model, {}

    def _file(self, kind: str, shard: int, width: int):
        if (kind, shard) not in self.files:
            raw = mapped(self.model.folder, f"{kind}-{shard:07d}")
            n = int(raw[:8].view(np.int64)[0])
            columns, rest = [raw[8: 8 + 8 * n].view(np.uint64)], raw[8 + 8 * n:]
            size = len(rest) // (n * (width - 1)) if n else 8       # counts take two bytes where they fit
            columns += [rest[size * n * i: size * n * (i + 1)].view(f"{'u' if size < 8 else 'i'}{size}") for i in range(width - 1)]
            self.files[kind, shard] = columns
        return self.files[kind, shard]

    def find(self, kind: str, keys: np.ndarray, shards: np.ndarray, width: int) -> np.ndarray:
        """The fields of sorted distinct keys, zero where a key is not there: fields x keys."""
        out = np.zeros((width - 1, len(keys)), np.int64)
        order = np.argsort(shards, kind="stable")
        bounds = np.searchsorted(shards[order], np.arange(shards.max(initial=-1) + 2))
        for shard in np.flatnonzero(np.diff(bounds)):
            own = order[bounds[shard]: bounds[shard + 1]]
            columns = self._file(kind, int(shard), width)
            if not len(columns[0]):
                continue
            at = np.minimum(np.searchsorted(columns[0], keys[own]), len(columns[0]) - 1)
            hit = columns[0][at] == keys[own]
            for i in range(width - 1):
                out[i, own[hit]] = columns[i + 1][at[hit]]
        return out


def score_block(lookup: Lookup, data: np.ndarray, offsets: np.ndarray, hasher: WordHasher):
    """(tokens, known tokens, log10 base, log10 model) of each text of a block."""
    m, docs = lookup.model, len(offsets) - 1
    word, before, of, begins = tokens(data, offsets, hasher)
    kinds, places = np.unique(np.concatenate([word, before]), return_inverse=True)
    w, u = places[: len(word)], places[len(word):]
    count, continuation, total, n1, n2, n3 = lookup.find("words", kinds, shard_of(kinds, m.word_shards), len(WORD_FIELDS))

    d = m.word_discounts
    share = (d[1:] * m.word_types).sum()
    lower = np.maximum(continuation - d[np.minimum(continuation, 3)], 0) + share / (m.n_words + 1)
    lower = lower / m.continuations if m.continuations else np.full(len(kinds), 1 / (m.n_words + 1))

    keys, of_key = np.unique(pair_key(before, word), return_inverse=True)
    one = np.zeros(len(keys), np.int64)
    one[of_key] = np.arange(len(word))
    n = lookup.find("bigrams", keys, bigram_shard(before[one], keys, m.heavy, m.bigram_shards), 2)[0][of_key]
    d = m.bigram_discounts
    left = d[1] * n1 + d[2] * n2 + d[3] * n3
    seen = total[u] > 0
    high = (np.maximum(n - d[np.minimum(n, 3)], 0) + left[u] * lower[w]) / np.where(seen, total[u], 1)
    model = np.log10(np.where(seen, high, lower[w]))
    base = np.log10((count[w] + 0.5) / (m.n_tokens + 0.5 * (m.n_words + 1)))
    add = lambda x: np.bincount(of, x, docs)
    return np.diff(begins), add(count[w] > 0).astype(np.int64), add(base), add(model)


def score(docs: DataFrame, model: Model, keep: list[str], text_column: str = "text") -> DataFrame:
    """Columns ``keep`` of every document and n_tokens, n_known, train_tokens, base_score, score, perplexity."""
    rows = docs.select(*keep, whole_text(text_column).alias("_whole"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    shared = docs.sparkSession.sparkContext.broadcast(model)     # a folder's name and at most a thousand words

    def run(batches):
        lookup, hasher = Lookup(shared.value), WordHasher()
        for batch in batches:
            found = [score_block(lookup, data, offsets, hasher)
                     for _, _, data, offsets in text_slices(batch.column(batch.num_columns - 1))]
            if not found:
                continue
            n, known, base, own = (np.concatenate(x) for x in zip(*found))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(n.astype(np.int64)), pa.array(known),
                 pa.array(np.full(len(n), shared.value.n_tokens)), pa.array(base), pa.array(own), pa.array(10 ** (-own / n))],
                names=[*batch.schema.names[:-1], "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"])

    return rows.mapInArrow(run, f"{kept}, n_tokens long, n_known long, train_tokens long, base_score double, score double, "
                                "perplexity double")
