"""Periodic runs against all periods of all stretches."""

import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from clipwright.llm import catalogue, periods


def brute_runs(words):
    codes = {}
    t = np.array([codes.setdefault(w, len(codes)) for w in words])
    n, out = len(t), set()
    for q in range(1, n // 3 + 1):
        same = np.r_[False, t[:-q] == t[q:], False]
        edges = np.flatnonzero(same[1:] != same[:-1])
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if b - a + q >= max(24, 3 * q):
                out.add((a, b - a + q, q))
    # a stretch counts by its smallest period alone
    smallest = {(s, n, q) for s, n, q in out if not any((t[s:s + n - p] == t[s + p:s + n]).all() for p in range(1, q))}
    return sorted(smallest, key=lambda r: (r[0], r[2]))


def awkward_words(kind, random):
    if kind == "binary":
        return random.integers(0, 2, 400).tolist()
    if kind == "unary":
        return [1] * int(random.integers(20, 200))
    if kind == "fibonacci":
        a, b = "a", "ab"
        while len(b) < 600:
            a, b = b, b + a
        return list(b)
    if kind == "nested":
        inner = random.integers(0, 9, random.integers(1, 5)).tolist() * int(random.integers(6, 12)) + [99]
        return (inner * 4 + random.integers(0, 50, 30).tolist()) * 3
    out = random.integers(0, 1000, random.integers(0, 60)).tolist()
    for _ in range(4):                 # stretches of every period, exactly long enough or one word short
        q = int(random.integers(1, 70))
        length = max(24, 3 * q) + int(random.integers(-1, 4))
        base = random.integers(0, 3 if q < 4 else 1000, q).tolist()
        out += (base * (length // q + 1))[:length] + random.integers(1000, 2000, random.integers(0, 20)).tolist()
    return out


@pytest.mark.parametrize("kind", ["binary", "unary", "fibonacci", "nested", "planted"])
def test_runs_are_all_runs(kind, monkeypatch):
    random = np.random.default_rng(len(kind))
    texts = [awkward_words(kind, random) for _ in range(120 if kind == "planted" else 25)]
    expected = [brute_runs(t) for t in texts]
    assert periods.find_runs(texts) == expected
    monkeypatch.setattr(periods, "CHUNK_WORDS", 100)
    assert periods.find_runs([[], *texts, []]) == [[], *expected, []]
    assert kind == "binary" or any(expected)


def test_every_period_at_every_alignment():
    texts = []
    for q in [*range(1, 40), 47, 48, 49, 63, 64, 65, 96, 97, 127, 128, 129]:
        for shift in (0, 1, 2, 3, 5, 7, 8, 11, 13, 16, 31):
            length = max(24, 3 * q)
            texts.append([-1 - i for i in range(shift)] + (list(range(q)) * (length // q + 1))[:length] + [-100])
    assert [len(r) for r in periods.find_runs(texts)] == [1] * len(texts)


def test_range_successors():
    random = np.random.default_rng(1)
    values = random.permutation(500)[:300]
    tree = periods.WaveletTree(values)
    low = random.integers(0, 300, 400)
    high = np.minimum(low + random.integers(0, 60, 400), 300)
    asked = random.integers(-1, 520, 400).clip(0)
    found = tree.successor(low, high, np.minimum(asked, values.max()))
    for a, b, v, f in zip(low, high, asked, found):
        assert f == min((x for x in values[a:b] if x > v), default=-1)


def brute_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1, len(words)
    if h % 10 == 0 and n:
        a, p = h // 10 % n, 1 + (n - h // 10 % n) // (3 + h // 10 % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in dropped)))


def test_query_on_documents_and_awkward_rows(spark, awkward, documents, tmp_path):
    more = [(50, "a b " * 40), (51, "x\x85y\xa0z " * 9), (52, " ".join("abcdefgh" * 3)), (53, " ".join("abcdefgh" * 3)[:-1])]
    docs = awkward.filter("length(text) < 50000 or text is null").unionByName(
        spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True)
    docs = docs.unionByName(documents.filter("length(text) < 4000"), allowMissingColumns=True)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    key = lambda r: tuple((x is None, x or 0) if not isinstance(x, str) else (False, x) for x in r)
    found = [tuple(r) for r in catalogue.QUERIES["op13_periodic_runs"](spark, str(tmp_path)).collect()]
    expected = [brute_row(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert sorted(found, key=key) == sorted(expected, key=key)
    assert sum(r[1] > 0 for r in found) > 10


def test_runs_of_very_long_and_no_texts(spark, awkward):
    found = {r.doc_id: r for r in periods.periodic_runs(awkward).collect()}
    assert [tuple(r) for r in found[6].runs] == [(0, 30_000, 1)] and found[6].collapsed == "word"
    assert found[4].n_words == 0 and found[4].runs == [] and found[4].collapsed == ""
    assert periods.periodic_runs(awkward.limit(0)).count() == 0
