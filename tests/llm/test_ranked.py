"""Ranked search against scores of all pairs."""

import collections
import math
import re

import numpy as np
import pytest

from clipwright.llm import ranked
from clipwright.llm.ranked import rank_documents


def terms_of(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def brute(docs, items, k=10):
    held = [(i, terms_of(t)) for i, t in docs]
    held = [(i, t) for i, t in held if t]
    total, number = sum(len(t) for _, t in held), len(held)
    df = collections.Counter(term for _, t in held for term in set(t))
    weight = {t: math.floor(1000 * math.log((2 * number + 2) / (2 * n + 1))) for t, n in df.items()}
    out = []
    for item_id, text in dict.fromkeys(items):
        asked, scored = collections.Counter(terms_of(text)), []
        for doc_id, own in held:
            tf, m = collections.Counter(own), 25 + 75 * len(own) * number // total
            score = sum(n * weight[t] * (10**9 * tf[t] // (1000 * tf[t] + 8 * m)) for t, n in asked.items() if t in tf)
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        out += [(item_id, rank, None if none else doc, -s) for rank, (s, none, doc) in enumerate(sorted(scored)[:k], 1)]
    return out


def frames(spark, docs, items):
    return (spark.createDataFrame([(i, t, 1, "x", 0.5) for i, t in docs], "doc_id long, text string, item_id int, terms string, length double"),
            spark.createDataFrame([(i, t, 2) for i, t in items], "item_id long, text string, doc_id int"))


def same(found, expected):
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted((tuple(r) for r in found.collect()), key=key) == sorted(expected, key=key)


@pytest.mark.parametrize("bucket,block", [(4096, 1 << 18), (16, 60)])
def test_ranks_are_those_of_all_pairs(spark, monkeypatch, bucket, block):
    monkeypatch.setattr(ranked, "BUCKET", bucket)
    monkeypatch.setattr(ranked, "BLOCK_TERMS", block)
    random = np.random.default_rng(4)
    words = [f"w{i}" for i in range(200)] + ["É", "ñu", "Foo", "x1"]
    odds = 1 / np.arange(1, len(words) + 1)
    odds /= odds.sum()

    def text(n):
        return " ,.".join(random.choice(words, n, p=odds))

    docs = [(i, text(random.integers(1, 80))) for i in range(400)]
    items = [(i, text(random.integers(1, 30))) for i in range(25)]
    docs += [(1000 + i, docs[0][1]) for i in range(30)]                       # copies: equal scores
    docs += [(i, items[i][1]) for i in range(5)] + [docs[3], docs[3], (None, items[7][1]), (None, None), (9, ""), (10, "!?"), (11, "É")]
    docs.append((12, text(20_000)))
    items += [items[0], (0, "w1 w2 w2 unseen"), (None, "FOO foo w3"), (50, None), (51, "..."), (52, "unseen")]
    same(rank_documents(*frames(spark, docs, items)), brute(docs, items))


def test_ranks_of_awkward_and_no_rows(spark, awkward):
    items = [(1, "quick brown fox word"), (2, "Ünïcode é"), (3, "endoftext")]
    bench = frames(spark, [], items)[1]
    same(rank_documents(awkward, bench), brute([(r.doc_id, r.text) for r in awkward.collect()], items))
    assert rank_documents(awkward.limit(0), bench).count() == 0
    assert rank_documents(awkward, bench.limit(0)).count() == 0
    assert rank_documents(awkward.filter("doc_id in (3, 4)"), bench).count() == 0


def test_documents_against_benchmark(spark, documents, sf_dir):
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    some = [(r.item_id, r.text) for r in items.collect()][:10]
    found = rank_documents(documents, items.limit(10)).collect()
    assert sorted(map(tuple, found)) == sorted(brute([(r.doc_id, r.text) for r in documents.collect()], some))
