"""Best-fit packing of tokenized documents into sequences of bounded length, by hierarchical residual packing.

Documents become token ids with an end id each; only a document longer than a sequence is cut.  Pieces are dealt evenly
into groups of about ``GROUP``, so every group holds the same mix of lengths.  A group packs its pieces by decreasing
size, each into the fullest sequence that still holds it, and emits the sequences that are done.

After a best-fit run no two sequences of a group can be joined, so at most one is half empty.  Groups therefore meet in
a tree: ``FAN`` groups hand their half-empty sequences on as items, beside those with the most room, and best fit runs
again over these.  A half-empty sequence from each group is all that can move, so ``FAN`` hosts a group and level are
all that can be needed: what a task of the tree reads is bounded whatever the input, and nothing is left out that
another round could place.  A moved sequence is one row (sequence, host, offset); pieces are joined to these rows once.

Defined results: a null or empty text is its end id alone; repeated rows and null ids are documents of their own, and
no two of them share a piece row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipwright.llm.common import DOTTED, MARKS, PLAIN, byte_characters, whole_text, written

#: Tokens a sequence holds, and the id that ends every document.
CAPACITY, END = 4096, 1
#: Pieces packed by one task at a time, and groups that meet in one task of the tree.
GROUP, FAN = 8192, 16
#: Words in one generation of those whose ids a Python worker keeps; it holds the current one and the one before.
KEPT_WORDS = 5 << 17
#: Texts tokenized together.
BATCH = 256

PIECES = "piece int, start long, length long, ids_crc32 long"


def _bytes(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Generation(dict):
    """Ids by word; a word that is not there is asked of ``learn``."""

    def __init__(self, learn):
        super().__init__()
        self.learn = learn

    def __missing__(self, word: bytes) -> bytes:
        ids = self[word] = self.learn(word)
        return ids


class WordIds:
    """Token ids of texts, from the ids of their words.

    For a lower-casing tokenizer whose pieces never span white space: a text's ids are those of its words one after
    the other, so the library sees every distinct word once as long as the worker keeps it.
    """

    def __init__(self, content: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(content)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t["content"] for t in json.loads(content)["added_tokens"]]
        self.model, self.characters = self.tokenizer.model, byte_characters()
        self.kept, self.older = Generation(self.learn), {}

    def _letters(self, word: bytes) -> bytes | None:
        """Ids of letters: normalisation only lowers them, and they are one piece for the model.  None for other words."""
        low, text = word.lower(), None
        if not low.isalpha():                                       # not ASCII letters alone
            text = low.decode()
            if not text.isalpha() or max(text) >= PLAIN or DOTTED in text:
                return None
        known = self.kept.get(low) or self.older.get(low)
        if known is None:
            shown = text.lower().translate(self.characters) if text else low.decode()
            known = self.kept[low] = _bytes([t.id for t in self.model.tokenize(shown)])
        return known

    def _any(self, word: bytes) -> bytes:
        """Ids of any word, by the tokenizer's parts one after the other; a whole call costs twice as much."""
        text, parts = word.decode(), self.tokenizer
        if any(mark in text for mark in self.special):
            ids = parts.encode(text, add_special_tokens=False).ids
        else:
            pieces = parts.pre_tokenizer.pre_tokenize_str(parts.normalizer.normalize_str(text))
            ids = [t.id for piece, _ in pieces for t in self.model.tokenize(piece)]
        return _bytes(ids)

    def learn(self, word: bytes) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            stem = word.rstrip(MARKS.encode())
            ids = self._letters(stem) if stem else None
            if ids is None:
                ids = self._any(word)
            elif len(stem) < len(word):     # marks after letters are a piece of their own
                ids += self.kept[word[len(stem):]]
        return ids

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian 32-bit ids of each text.  ASCII white space alone divides words here."""
        found = [b"".join(map(self.kept.__getitem__, text.split())) for text in texts]
        if len(self.kept) > KEPT_WORDS:
            self.older, self.kept = self.kept, Generation(self.learn)
        return found


_encoders: dict[str, WordIds] = {}


def _cut(content, capacity: int, end: int, with_ids: bool):
    """Pieces of every document; ``key`` is unique among all pieces."""
    closing = _bytes([end])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text = content.value
        if text not in _encoders:
            _encoders.clear()
            _encoders[text] = WordIds(text)
        encode, made = _encoders[text], TaskContext.get().partitionId() << 36
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                rows, columns = [], ([], [], [], [], [])
                for row, ids in enumerate(encode(part.column("text").cast(pa.binary()).to_pylist())):
                    ids += closing
                    for number, start in enumerate(range(0, len(ids), 4 * capacity)):
                        own = ids[start: start + 4 * capacity]
                        rows.append(row)
                        for column, value in zip(columns, (number, start // 4, len(own) // 4, zlib.crc32(own), own)):
                            column.append(value)
                kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                arrays = [pa.array(c, k) for c, k in zip(columns, kinds)][: 5 if with_ids else 4]
                keys = pa.array(np.arange(made, made + len(rows)))
                made += len(rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(pa.array(rows, pa.int64())), *arrays, keys],
                    names=["id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids, "key"])

    return run


def pieces_of(docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, end: int = END, id_column: str = "doc_id",
              text_column: str = "text", with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids], key): the written pieces of all documents.

    The tokenizer must end its pieces at white space, as word-based ones do.
    """
    with open(tokenizer_file, encoding="utf-8") as file:
        content = docs.sparkSession.sparkContext.broadcast(file.read())     # one vocabulary file
    rows = docs.select(F.col(id_column).alias("id"), whole_text(text_column).alias("text"))
    schema = f"id {rows.schema['id'].dataType.simpleString()}, {PIECES}, {'ids binary, ' * with_ids}key long"
    return written(rows.mapInArrow(_cut(content, capacity, end, with_ids), schema), "pack-pieces")


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset) of every item and the fill of every bin: decreasing sizes, each into the fullest bin with room."""
    places, offsets, fills = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64), []
    with_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0                                       # bit r is set where some bin has room r
    for item in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[item])
        enough = rooms >> size
        if enough:
            room = size + (enough & -enough).bit_length() - 1
            held = with_room[room]
            at = held.pop()
            if not held:
                rooms ^= 1 << room
        else:
            at, room = len(fills), capacity
            fills.append(0)
        places[item], offsets[item] = at, fills[at]
        fills[at] += size
        room -= size
        if room:
            with_room[room].append(at)
            rooms |= 1 << room
    return places, offsets, np.array(fills, np.int64)


def handed_on(fills: np.ndarray, capacity: int, hosts: int) -> np.ndarray:
    """Which bins the next level needs: half-empty ones, and as many hosts with the most room as it can use."""
    chosen = 2 * fills <= capacity
    order = np.argsort(fills, kind="stable")
    chosen[order[: hosts + int(chosen.sum())]] = True
    return chosen & (fills < capacity)


def _pack_group(capacity: int, hosts: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("key", ignore_index=True)
        places, offsets, fills = best_fit(rows["length"].to_numpy(), capacity)
        on = handed_on(fills, capacity, hosts)
        return rows.assign(bin=(rows["group"].to_numpy(np.int64) << 32) + places, offset=offsets,
                           fill=fills[places], on=on[places] & (offsets == 0)).drop(columns="key")

    return run


def _merge_group(capacity: int, hosts: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("bin", ignore_index=True)
        places, offsets, fills = best_fit(rows["fill"].to_numpy(), capacity)
        first = np.zeros(len(fills), np.int64)
        first[places[offsets == 0]] = rows["bin"].to_numpy()[offsets == 0]
        on = handed_on(fills, capacity, hosts)
        return pd.DataFrame({"group": rows["group"], "bin": rows["bin"], "into": first[places], "shift": offsets,
                             "fill": fills[places], "on": on[places] & (offsets == 0)})

    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (length, key and any other columns) with ``sequence_id`` and ``offset`` instead of ``key``."""
    groups = max(1, -(-pieces.count() // GROUP))
    levels, width = 0, groups
    while width > 1:
        levels, width = levels + 1, -(-width // FAN)
    hosts = FAN * levels

    dealt = pieces.withColumn("group", F.pmod(F.xxhash64("key"), F.lit(groups)))
    kept = [f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema if f.name != "key"]
    local = written(dealt.groupBy("group").applyInPandas(
        _pack_group(capacity, hosts), f"{', '.join(kept)}, group long, bin long, offset long, fill long, on boolean"), "pack-local")

    open_, moved = local.filter("on").select("group", "bin", "fill"), None
    for _ in range(levels):
        met = written(open_.withColumn("group", F.floor(F.col("group") / FAN)).groupBy("group").applyInPandas(
            _merge_group(capacity, hosts), "group long, bin long, into long, shift long, fill long, on boolean"), "pack-level")
        open_ = met.filter("on").select("group", "bin", "fill")
        moves = met.filter("into <> bin").select("bin", "into", "shift")
        if moved is not None:       # a host that moves takes along what was put into it
            after = moves.select(F.col("bin").alias("into"), F.col("into").alias("later"), F.col("shift").alias("more"))
            moved = moved.join(after, "into", "left").select(
                "bin", F.coalesce("later", "into").alias("into"), (F.col("shift") + F.coalesce("more", F.lit(0))).alias("shift"))
            moves = moved.unionByName(moves)
        moved = written(moves, "pack-moves")
    if moved is None:
        return local.withColumnRenamed("bin", "sequence_id").drop("group", "fill", "on")
    return local.join(moved, "bin", "left").withColumns({
        "sequence_id": F.coalesce("into", "bin"), "offset": F.col("offset") + F.coalesce("shift", F.lit(0)),
    }).drop("group", "bin", "fill", "on", "into", "shift")


def pack_documents(docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, end: int = END, id_column: str = "doc_id",
                   text_column: str = "text", with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids], sequence_id, offset) of every piece of every document."""
    pieces = pieces_of(docs, tokenizer_file, capacity, end, id_column, text_column, with_ids)
    return pack(pieces, capacity).withColumnRenamed("id", id_column)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the packed sequences as little-endian 32-bit ids, from pieces packed ``with_ids``."""
    held = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("held"))
    joined = F.aggregate("held", F.lit(b""), lambda ids, piece: F.concat(ids, piece["ids"]))
    return held.select("sequence_id", joined.alias("ids"))
