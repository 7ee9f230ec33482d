"""License scan: named phrases, and an exact set-similarity join of text blocks with license templates.

Blocks are the lines of a text, as sets of words.  A block matches a template if it holds at least ``containment`` of
the template's words.  The words of the templates are counted over all blocks and ordered from rare to frequent; a
block is read as its template words in that order.  With o the words a match needs, only the first |T| - o + 1 words of
a template and the first |B| - o + 1 of a block are joined (prefix filter); a block with fewer than o template words is
left out (length filter); and what can still follow the shared word on both sides must complete o (positional filter).
Survivors are verified by intersection, so every match is found and none is invented.

Only DataFrame functions are used.  The number of templates and phrases is set by the caller; nothing else is bounded.

Defined results: a null or empty text has no words, places or labels and score 0; repeated rows and null ids give a
row each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipwright.llm.common import lower_ascii, row_key, whole_text

#: What is between words, after A-Z became lower case.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def template_words(text: str) -> set[str]:
    return {w for w in re.split(BETWEEN, text.lower()) if w}


def _spaces(text: Column) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))).cast("long")


def phrase_places(docs: DataFrame, phrases: Sequence[tuple[str, str]]) -> DataFrame:
    """Adds n_words, n_base, first_word, last_word and base (sorted distinct labels) from the column ``low``.

    The text becomes its words behind one blank each.  A place is the blank in front of a phrase; words before it are
    blanks before it.  Overlapping places all count, as the phrase itself is only looked ahead at.
    """
    line = F.concat(F.lit(" "), F.trim(F.regexp_replace("low", BETWEEN, " ")), F.lit(" "))
    docs = docs.withColumn("line", F.when(F.trim("low") == "", F.lit("  ")).otherwise(line))
    docs = docs.withColumn("n_words", F.when(F.trim("line") == "", F.lit(0).cast("long")).otherwise(_spaces(F.col("line")) - 1))
    counts, firsts, lasts, labels = [], [], [], []
    for phrase, label in phrases:
        present = F.contains("line", F.lit(f" {phrase} "))
        marked = F.regexp_replace("line", f" (?={re.escape(phrase)} )", "\x01")
        places = (F.length("line") - F.length(F.replace(marked, F.lit("\x01"), F.lit("")))).cast("long")
        before_first = _spaces(F.substring_index(marked, "\x01", 1))
        behind_last = F.substring_index(marked, "\x01", -1)
        zero = F.lit(None).cast("long")
        counts.append(F.when(present, places).otherwise(F.lit(0).cast("long")))
        firsts.append(F.when(present, before_first).otherwise(zero))
        # the line ends with a blank, so the words from the last place on are the blanks behind it
        lasts.append(F.when(present, F.col("n_words") - _spaces(behind_last)).otherwise(zero))
        labels.append(F.when(present, F.lit(label)))
    least = F.least(*firsts) if len(firsts) > 1 else firsts[0]
    most = F.greatest(*lasts) if len(lasts) > 1 else lasts[0]
    return docs.withColumns({
        "n_base": sum(counts[1:], counts[0]), "first_word": least, "last_word": most,
        "base": F.array_sort(F.array_distinct(F.array_compact(F.array(*labels)))),
    }).drop("line")


def _blocks(docs: DataFrame, words: Sequence[str]) -> DataFrame:
    """(key, block): per line, which of ``words`` it holds, as their sorted places in the list from 1."""
    known = F.array(*map(F.lit, words))
    here = F.transform(F.array_intersect(F.split("one", BETWEEN), known), lambda w: F.array_position(known, w).cast("int"))
    return docs.select("key", F.explode(F.split("low", "\n")).alias("one")).select("key", F.array_sort(here).alias("block"))


def template_matches(docs: DataFrame, templates: Sequence[tuple[str, str]], containment: float) -> DataFrame:
    """(key, label, share) of the best block of each document for each template it matches."""
    spark = docs.sparkSession
    sets = [(label, template_words(text)) for label, text in templates]
    vocabulary = sorted(set().union(*(words for _, words in sets)))
    counts = _blocks(docs, vocabulary).select(F.explode("block").alias("at")).groupBy("at").count()
    frequency = {row["at"]: row["count"] for row in counts.collect()}      # one number per word of the templates
    order = sorted(vocabulary, key=lambda w: (frequency.get(vocabulary.index(w) + 1, 0), w))

    prefixes = []
    for number, (label, words) in enumerate(sets):
        ranks = sorted(order.index(w) + 1 for w in words)
        needed = max(1, math.ceil(containment * len(ranks) - 1e-9))
        prefixes += [(rank, number, label, j, ranks, needed) for j, rank in enumerate(ranks[: len(ranks) - needed + 1])]
    prefixes = spark.createDataFrame(prefixes, "rank int, template int, label string, j int, ranks array<int>, needed int")

    least = min(max(1, math.ceil(containment * len(words) - 1e-9)) for _, words in sets)
    blocks = _blocks(docs, order).filter(F.size("block") >= least)
    # a block needs at least `least` words for any template, so its own prefix is that much shorter
    shared = blocks.select("key", "block", F.posexplode(F.slice("block", F.lit(1), F.size("block") - least + 1)).alias("i", "rank"))
    size, length = F.size("block"), F.size("ranks")
    found = shared.join(prefixes, "rank").filter(
        (size >= F.col("needed"))
        & (F.least(size - F.col("i"), length - F.col("j")) >= F.col("needed"))
        & (F.col("i") <= size - F.col("needed")))
    overlap = F.size(F.array_intersect("block", "ranks"))
    return found.withColumn("overlap", overlap).filter("overlap >= needed").groupBy("key", "label").agg(
        F.max(F.col("overlap") / length).alias("share"))


def scan_licenses(docs: DataFrame, phrases: Sequence[tuple[str, str]], templates: Sequence[tuple[str, str]],
                  containment: float = 0.9, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every document.

    ``score`` is 1 where a phrase stands and the best template containment elsewhere, 0 without a match.
    """
    text = whole_text(text_column)
    docs = docs.select(F.col(id_column).alias("_id"), lower_ascii(text).alias("low")).withColumn("key", row_key("_id", "low"))
    matches = template_matches(docs, templates, containment).groupBy("key").agg(
        F.array_sort(F.collect_set("label")).alias("more"), F.max("share").alias("share"))
    base = phrase_places(docs, phrases).select(
        "_id", "key", "n_words", "n_base", "first_word", "last_word", "base").alias("b")
    joined = base.join(matches.alias("m"), F.col("b.key").eqNullSafe(F.col("m.key")), "left")
    none = F.array().cast("array<string>")
    labels = F.array_sort(F.array_union("base", F.coalesce("more", none)))
    return joined.select(
        F.col("_id").alias(id_column), "n_words", "n_base", "first_word", "last_word",
        F.array_join("base", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"))
