"""Token counts through a digest cache.

A text is known by the SHA-256 of its normalised content and a tokenizer by the digest of its file, settings
and library version.  Digests are joined to the stored counts; of the digests without one, one text each is
encoded, and the new counts are appended to the cache.  Every document then takes its count from the cache.

A byte-level tokenizer takes a text in parts that end before a single blank or beside a single line end, so a task
encodes each distinct word once and adds up; texts with other white space at such borders are encoded whole.

Normalisation must not change a count, so it only makes a null text the empty one.  Texts travel through one
shuffle, keyed by digest and document, so a text that a third of all rows share is spread like any other.

Defined results: a null or empty text has 0 bytes and 0 tokens; repeated rows and null ids give a row each;
an empty table gives an empty result; other columns of the input are ignored and may have any name.
"""

from __future__ import annotations

import hashlib
import json
import os
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipwright.llm.common import MARKS, PLAIN, byte_characters, exists, whole_text

CACHE_SCHEMA = "digest binary, n_tokens long, tokenizer string, batch string"
#: Whole texts encoded by one call of the library, and texts taken up together.
BATCH, READ = 32, 256

#: Words whose counts a task keeps; beyond it starts anew.
KEPT_WORDS = 1 << 20


def tokenizer_version(content: str) -> str:
    """Digest of a tokenizer: its file, the library that reads it, and the settings used here."""
    import tokenizers

    said = f"{tokenizers.__version__}\0add_special_tokens=False\0{content}"
    return hashlib.sha256(said.encode()).hexdigest()


def divides(content: str) -> bool:
    """Whether a tokenizer takes a text in parts that end before a blank and what follows it.

    That is how the byte-level pattern matches, if nothing is changed before it and no added token looks further.
    """
    said = json.loads(content)
    first, added = said.get("pre_tokenizer") or {}, said.get("added_tokens") or []
    return (said.get("normalizer") is None and said["model"].get("type") == "BPE" and first.get("type") == "ByteLevel"
            and first.get("use_regex", True) and not first["add_prefix_space"]
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["content"].split() != [t["content"]] for t in added))


class Whole(Exception):
    """A text is to be counted as a whole."""


class Counts(dict):
    """Tokens by word, the word led by ``lead``; a word that is not there is asked of ``learn``."""

    def __init__(self, learn, lead: str):
        super().__init__()
        self.learn, self.lead = learn, lead

    def __missing__(self, word: str) -> int:
        count = self[word] = self.learn(word, self.lead)
        return count


class Counter:
    """Token counts of texts; the library sees a distinct word once where a text divides at single blanks and line ends."""

    def __init__(self, content: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(content)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model, self.characters, self.divides = self.tokenizer.model, byte_characters(), divides(content)
        self.special = [t["content"] for t in json.loads(content).get("added_tokens") or []]
        self.forget()

    def forget(self) -> None:
        self.bare, self.led = Counts(self.learn, ""), Counts(self.learn, " ")

    def _encoded(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False))

    def learn(self, word: str, lead: str) -> int:
        if not word or word != word.strip():        # more white space at the border: its parts are found in the whole text
            raise Whole
        stem = word.rstrip(MARKS)
        # letters are one part with the blank before them, marks after them another
        if not stem.isalpha() or max(stem) >= PLAIN or any(mark in word for mark in self.special):
            return self._encoded(lead + word)
        if len(stem) < len(word):
            return (self.led if lead else self.bare)[stem] + self.bare[word[len(stem):]]
        return len(self.model.tokenize((lead + word).translate(self.characters)))

    def _divided(self, text: str) -> int:
        count = -1                                  # a line end between lines is a token
        for line in text.split("\n"):
            words = line.split(" ")
            count += 1 + self.bare[words[0]] + sum(map(self.led.__getitem__, words[1:]))
        return count

    def __call__(self, texts: list[str]) -> list[int]:
        counts, whole = [0] * len(texts), []
        for i, text in enumerate(texts):
            try:
                if not self.divides:
                    raise Whole
                counts[i] = self._divided(text) if text else 0
            except Whole:
                whole.append(i)
        for at in range(0, len(whole), BATCH):
            own = whole[at: at + BATCH]
            found = self.tokenizer.encode_batch_fast([texts[i] for i in own], add_special_tokens=False)
            for i, tokens in zip(own, found):
                counts[i] = len(tokens)
        if len(self.bare) + len(self.led) > KEPT_WORDS:
            self.forget()
        return counts


def _encode(content):
    def run(batches):
        count = Counter(content.value)
        for batch in batches:
            counts = []
            for at in range(0, batch.num_rows, READ):
                counts += count(batch.column("text").slice(at, READ).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(counts, pa.int64())],
                                             names=["digest", "n_tokens"])

    return run


def _stored(spark, cache: str, version: str) -> DataFrame:
    """One row per digest that the cache holds for this tokenizer."""
    if exists(spark, cache):
        rows = spark.read.schema(CACHE_SCHEMA).parquet(cache).filter(F.col("tokenizer") == version)
    else:
        rows = spark.createDataFrame([], CACHE_SCHEMA)
    # two writers may have stored the same digest
    return rows.groupBy("tokenizer", "digest").agg(F.max("n_tokens").alias("n_tokens")).drop("tokenizer")


def count_tokens(docs: DataFrame, tokenizer_file: str, cache: str, id_column: str = "doc_id",
                 text_column: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens) of every document.

    ``cache`` is a folder that executors and driver share; it may be absent, and is shared by all tokenizers.
    Counts are those of ``tokenizers`` without special tokens added and with its default treatment of special
    strings inside texts.
    """
    spark = docs.sparkSession
    with open(tokenizer_file, encoding="utf-8") as file:
        content = file.read()
    version = tokenizer_version(content)
    shared = spark.sparkContext.broadcast(content)   # one vocabulary file

    text = whole_text(text_column)
    keyed = docs.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("key"), text.alias("text"),
                        F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"))
    # one document for each digest that has no count; keyed by both, copies of a text are spread over the tasks
    distinct = keyed.groupBy("digest").agg(F.min("key").alias("key"))
    misses = distinct.join(_stored(spark, cache, version).select("digest"), "digest", "left_anti")
    chosen = keyed.dropDuplicates(["digest", "key"]).join(misses, ["digest", "key"]).select("digest", "text")
    fresh = chosen.mapInArrow(_encode(shared), "digest binary, n_tokens long")
    fresh.write.parquet(f"{cache.rstrip('/')}/tokenizer={version}/batch={uuid.uuid4().hex}")

    sizes = docs.select(F.col(id_column).alias(id_column), F.octet_length(text).cast("long").alias("n_bytes"),
                        F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"))
    return sizes.join(_stored(spark, cache, version), "digest").select(id_column, "n_bytes", "n_tokens")
