"""Search, URLs and the pipeline against plain Python."""

import math
import re
import zlib

import numpy as np
import pandas as pd
import pytest

import corpus_pipeline
from clipwright.llm.catalogue import URL_RULES
from clipwright.llm.packing import best_fit, pack, pack_documents, pieces_of, sequences
from clipwright.llm.topk import top_k
from clipwright.llm.urls import judge_urls
from pyspark.sql import functions as F


def brute_top(rows, is_query, k=5):
    vectors = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
               if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q in vectors:
        if is_query(i):
            scored = sorted(((-sum(a * b for a, b in zip(q, v)), j) for j, v in vectors if j != i and len(v) == len(q)))
            out += [(i, rank, j, -s) for rank, (s, j) in enumerate(scored[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("case", ["plain", "ties", "skewed", "few"])
def test_top_k(spark, monkeypatch, case):
    from clipwright.llm import topk

    monkeypatch.setattr(topk, "ROW_BLOCK", 100)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 7)
    random = np.random.default_rng(5)
    n = 3 if case == "few" else 400
    matrix = random.standard_normal((n, 8))
    if case == "ties":
        matrix[: n // 2] = matrix[0]
        matrix = np.round(matrix * 2) / 256
    if case == "skewed":
        matrix = np.sign(matrix) * np.exp(4 * matrix)
    rows = [(i, m.tolist()) for i, m in enumerate(matrix)]
    rows += [(1001, None), (1002, [None] * 8), (1003, [math.nan] * 8), (1004, [math.inf] * 8), (None, matrix[0].tolist()),
             (1010, []), (1020, [1.0, 2.0]), (1030, [3.0, 4.0])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, score int, id string")
    found = top_k(df, F.col("vec_id") % 10 == 0)
    assert sorted(tuple(r) for r in found.collect()) == brute_top(rows, lambda i: i % 10 == 0)


def test_top_k_of_nothing(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert top_k(empty, F.col("vec_id") % 10 == 0).count() == 0


@pytest.mark.parametrize("case", ["all zero", "zero blocks among negative scores"])
def test_top_k_of_blocks_without_postings(spark, monkeypatch, case):
    from clipwright.llm import topk

    monkeypatch.setattr(topk, "ROW_BLOCK", 4)
    rows = [(i, [0.001, 0.0, 0.003]) for i in range(60)]
    if case != "all zero":
        rows[::10] = [(i, [1.0 if i % 20 else -1.0, 0.0, 0.5]) for i in range(0, 60, 10)]
    found = top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 10 == 0)
    assert sorted(tuple(r) for r in found.collect()) == brute_top(rows, lambda i: i % 10 == 0)


@pytest.mark.parametrize("entries", [1, 2000, 1 << 21])
def test_top_k_deals_queries_to_cells_without_the_driver(spark, monkeypatch, entries):
    from clipwright.llm import topk

    monkeypatch.setattr(topk, "ROW_BLOCK", 50)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 5)
    monkeypatch.setattr(topk, "CELL_ENTRIES", entries, raising=False)
    random = np.random.default_rng(6)
    rows = [(i, m.tolist()) for i, m in enumerate(random.standard_normal((300, 8)))]
    rows += [(i, [float(i), 1.0]) for i in range(400, 430)] + rows[:20]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = top_k(df, F.col("vec_id") % 10 == 0)
    # a query's copies for the index blocks were broadcast: their product went through the driver
    assert "Broadcast" not in found._jdf.queryExecution().toString()
    once = {(i, tuple(v)) for i, v in rows if i % 10 == 0}
    expected = []
    for i, q in sorted(once):
        own = [(-sum(math.floor(256 * a) * math.floor(256 * b) for a, b in zip(q, v)), j) for j, v in rows if j != i and len(v) == len(q)]
        expected += [(i, rank, j, -s) for rank, (s, j) in enumerate(sorted(own)[:5], 1)]
    assert sorted(tuple(r) for r in found.collect()) == expected


def test_search_block_keeps_members_when_scores_need_rounding():
    from clipwright.llm import topk

    random = np.random.default_rng(7)
    for scale in (1.0, 1e4, 1e8):                   # single precision holds neither the larger scores nor their ties
        matrix = np.floor(random.standard_normal((600, 6)) * scale).astype(np.int64)
        matrix[300:400] = matrix[:100]
        ids = random.permutation(600)
        frame = pd.DataFrame({"width": 6, "block": np.arange(600) // 200, "id": ids, "vector": list(matrix)})
        best = topk.Best(40, 5)
        for _, own in frame.groupby("block"):
            r = next(topk.build_index(own)).iloc[0]
            topk.search_block(topk.IndexBlock(6, r.ids, r.vectors, r.order_, r.cuts, r.left), ids[:40], matrix[:40], best)
        got = sorted(zip(ids[best.query].tolist(), (-best.score).tolist(), best.id.tolist()))
        expected = []
        for i in range(40):
            scored = sorted((-int(s), int(j)) for s, j in zip(matrix @ matrix[i], ids) if j != ids[i])
            expected += [(int(ids[i]), s, j) for s, j in scored[:5]]
        assert got == sorted(expected)


def brute_rule(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(len(h + p), h + p, v) for v, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    _, name, verdict = max(fits, default=(0, None, None))
    return host, path, name, verdict


def test_urls(spark):
    urls = ["http://A.Example.NET/en/x?q=/de/", "ftp://example.com/de", "http://example.com/de/", "x://net/", "x://net", None, "",
            "no scheme", "a://b://c.org/fr/1", "http://www.org/fr/", "http://wwworg/fr/", "https://x.net?/", "http://x.net#/", "http:///",
            "http://ÄB.net/\n/x", "http://a.com/" + "y" * 100_000, "x://net/", "http://good.example.com/en/"]
    pages = spark.createDataFrame([(i if i else None, u, "<p>", "x") for i, u in enumerate(urls)], "page_id long, url string, html string, host string")
    found = judge_urls(pages, URL_RULES).collect()
    got = sorted((str(r.page_id), r.host, r.path, r.rule) for r in found)
    assert got == sorted((str(i if i else None), *brute_rule(u)[:3]) for i, u in enumerate(urls))
    assert all(r.verdict == brute_rule(urls[r.page_id or 0])[3] for r in found if r.rule)
    assert all(r.verdict in ("allow", "block") for r in found)
    assert judge_urls(pages.limit(0), URL_RULES).count() == 0
    assert {r.verdict for r in judge_urls(pages.filter("url is null or url = ''"), URL_RULES).collect()} == {"allow"}


def test_trees_learn_what_blocked_urls_look_like(spark):
    rules = [("block", "bad.com", "/"), ("allow", "good.com", "/")]
    rows = [(f"http://s{i}.bad.com/{i * 7919}/{i * 104729}?a={i}&b=1",) for i in range(200)]
    rows += [(f"http://s.good.com/page{'x' * (i % 5)}",) for i in range(200)]
    rows += [(f"http://t{i}.other.org/{i * 7919}/{i * 104729}?a={i}&b=1",) for i in range(20)] + [("http://s.other.org/pagexx",)] * 20
    pages = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "page_id long, url string")
    found = {r.page_id: r for r in judge_urls(pages, rules).collect()}
    right = sum(found[i].verdict == ("block" if i < 420 else "allow") for i in range(400, 440))
    assert right >= 36 and all(found[i].rule is None for i in range(400, 440))


# ------------------------------------------------------------------ pipeline

def test_stages_on_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_duplicates", "decontamination", "personal_data", "segmentation"]
    samples = corpus_pipeline.run(spark, sf_dir)
    kept = {r.doc_id for r in samples.select("doc_id").distinct().collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    texts = {}
    for r in docs.orderBy("doc_id").collect():
        texts.setdefault(r.text, []).append(r.doc_id)
    assert all(len(kept & set(ids)) <= 1 for ids in texts.values())          # copies: one stays at most
    junk = [i for i in kept if labels.get(i) == 0]
    assert len(junk) <= 0.1 * sum(q == 0 for q in labels.values())
    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert not any(item in text for text, ids in texts.items() for item in items if kept & set(ids))
    assert len(kept) > 0.6 * docs.count()


def test_stages_on_awkward_rows(spark, awkward, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([(1, 1, 0), (9, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, "quick brown fox jumps over the lazy")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    for docs in (awkward, awkward.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            before = docs.count()
            docs = stage(spark, docs, folder)
            assert docs.columns == awkward.columns and docs.count() <= before
            if name == "near_duplicates" and before:
                # one of the two equal rows, one of the three empty texts and null
                assert docs.filter("doc_id = 1").count() == 1
                assert docs.filter("text is null or trim(text) = ''").count() <= 1
            if name == "decontamination":
                assert docs.filter("doc_id = 1").count() == 0
        assert stage is not corpus_pipeline.segmentation
        assert corpus_pipeline.segmentation(spark, docs, folder).select("doc_id").count() >= docs.count()


# ------------------------------------------------------------------ packing

def test_best_fit_takes_the_fullest_bin_with_room():
    random = np.random.default_rng(2)
    for _ in range(20):
        sizes = random.integers(1, 101, random.integers(1, 200))
        bins, expected = [], 0
        for size in sorted(sizes.tolist(), reverse=True):
            fitting = [i for i, fill in enumerate(bins) if fill + size <= 100]
            if fitting:
                bins[max(fitting, key=lambda i: bins[i])] += size
            else:
                bins.append(size)
        places, offsets, fills = best_fit(sizes, 100)
        assert sorted(fills.tolist()) == sorted(bins)
        for b in range(len(fills)):
            own = sorted(zip(offsets[places == b].tolist(), sizes[places == b].tolist()))
            assert [o for o, _ in own] == [sum(s for _, s in own[:i]) for i in range(len(own))]


def checked_sequences(rows, capacity):
    """Offsets are gapless from 0 in every sequence; returns the fills."""
    held = {}
    for r in rows:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in held.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:i]) for i in range(len(own))]
        assert sum(n for _, n in own) <= capacity
    return [sum(n for _, n in own) for own in held.values()]


@pytest.mark.parametrize("lengths", ["mixed", "large", "tiny", "one"])
def test_packing_in_many_groups_and_levels(spark, monkeypatch, lengths):
    from clipwright.llm import packing

    monkeypatch.setattr(packing, "GROUP", 100)
    monkeypatch.setattr(packing, "FAN", 3)
    random = np.random.default_rng(8)
    draw = {"mixed": lambda: int(random.integers(1, 101)), "large": lambda: int(random.integers(40, 75)),
            "tiny": lambda: int(random.integers(1, 4)), "one": lambda: 60}[lengths]
    rows = [(None if i % 3 else i, draw(), i) for i in range(1000)]
    pieces = spark.createDataFrame(rows, "id long, length long, key long")
    found = pack(pieces, 100).collect()
    assert sorted(r.length for r in found) == sorted(n for _, n, _ in rows)
    fills = checked_sequences(found, 100)
    total, large = sum(fills), sum(n > 50 for _, n, _ in rows)
    assert len(fills) <= 1.08 * max(-(-total // 100), large)
    assert sum(2 * f <= 100 for f in fills) <= 1


def test_packed_documents_are_the_library_s_ids(spark, awkward, documents):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    more = ["Kelvin \u212a \u0130stanbul e\u0301a A\u030angstr\u00f6m", "a\x1cb c\x85d\xa0e\u2028f\u200bg", "it's we'll CAN'T x.", "a\x0bb\x0cc",
            "<|startoftext|> in a<|endoftext|>word <|ENDOFTEXT|>", "!!! ... ?. a! 3. 12,5 \u4e2d\u6587\u3002", "\u0301 \u0301a"]
    extra = spark.createDataFrame([(100 + i, t) for i, t in enumerate(more)], "doc_id long, text string")
    docs = awkward.unionByName(extra, allowMissingColumns=True).unionByName(documents, allowMissingColumns=True)
    whole = [(r.doc_id, library.encode(r.text or "", add_special_tokens=False).ids + [1]) for r in docs.collect()]
    found = pack_documents(docs, path, with_ids=True).collect()
    expected = [(i, at // 4096, at, ids[at: at + 4096]) for i, ids in whole for at in range(0, len(ids), 4096)]
    got = [(r.doc_id, r.piece, r.start, np.frombuffer(r.ids, "<u4").tolist()) for r in found]
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(got, key=key) == sorted(expected, key=key)
    assert all(r.length == len(r.ids) // 4 and r.ids_crc32 == zlib.crc32(r.ids) for r in found)
    fills = checked_sequences(found, 4096)
    assert len(fills) <= 1 + -(-sum(fills) // 4096) * 1.01
    laid = sequences(pack_documents(docs, path, with_ids=True)).collect()
    assert sorted(len(r.ids) // 4 for r in laid) == sorted(fills)
    assert pack_documents(docs.limit(0), path).count() == 0


def test_a_worker_that_forgets_words_gives_the_same_ids(monkeypatch):
    import public_tokenizers
    from clipwright.llm import packing

    content = open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read()
    texts = [b"one two", b"two three, four", "five \u00e9t\u00e9 one".encode(), b""]
    expected = packing.WordIds(content)(texts)
    monkeypatch.setattr(packing, "KEPT_WORDS", 2)
    small = packing.WordIds(content)
    assert [small([t])[0] for t in texts] == expected == small(texts)


def test_latin_words_and_marks_skip_the_tokenizer_s_parts(monkeypatch):
    import public_tokenizers
    from clipwright.llm import packing
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    letters = [c for c in map(chr, range(0x180)) if c.isalpha()]
    words = [*letters, *(f"a{c}b" for c in letters), *(f"{c}{c}###" for c in letters), "Été.,&&&", "Straße", "x<|", "ab-_", "A_b"]
    marks = ["!", "###", ".,&&&", "-_", "<|"]
    encode = packing.WordIds(open(path, encoding="utf-8").read())
    got = encode([w.encode() for w in [*words, *marks]])
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [library.encode(w, add_special_tokens=False).ids for w in [*words, *marks]]
    apart = "' '| \u0301 \u0301< 1 1! \u00b2 \u00b2."        # a kept word that is no letters says nothing of the longer one
    assert np.frombuffer(encode([apart.encode()])[0], "<u4").tolist() == library.encode(apart, add_special_tokens=False).ids
    asked, ask = [], encode._any
    monkeypatch.setattr(encode, "_any", lambda word: asked.append(word) or ask(word))
    encode([f"q{w}".encode() for w in words])
    # the dotted I becomes two characters, a mark may stand between letters
    assert {w.decode() for w in asked} == {"qİ", "qaİb", "qİİ###", "qA_b"}
