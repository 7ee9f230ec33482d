"""Operators on texts against plain Python."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash

from clipwright.llm import kneser_ney, segment, simhash
from clipwright.llm.catalogue import LICENSE_PHRASES, LICENSE_TEMPLATES, QUERIES
from clipwright.llm.decontaminate import contaminated, without_contaminated
from clipwright.llm.licenses import scan_licenses, template_words
from clipwright.llm.pii import digests, find_personal_data, redact
from clipwright.llm.quality import fit_voter, score_documents
from clipwright.llm.token_counts import count_tokens
from clipwright.session import scratch_path


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def rows(df):
    return [tuple(r) for r in df.collect()]


# ------------------------------------------------------------------ token counts

def test_token_counts_are_the_library_s_and_cached(spark, awkward):
    from tokenizers import Tokenizer

    path, cache = public_tokenizers.path("byte_bpe_50k.json"), scratch_path(spark, "cache")
    library = Tokenizer.from_file(path)
    expected = sorted((r.doc_id or -1, len((r.text or "").encode()), len(library.encode(r.text or "", add_special_tokens=False)))
                      for r in awkward.collect())
    found = count_tokens(awkward, path, cache)
    assert sorted((r[0] or -1, *r[1:]) for r in rows(found)) == expected
    before = spark.read.parquet(cache).count()
    assert before == awkward.select("text").na.fill("").distinct().count()
    again = count_tokens(awkward.union(awkward), path, cache)
    assert sorted((r[0] or -1, *r[1:]) for r in rows(again)) == sorted(expected * 2)
    assert spark.read.parquet(cache).count() == before
    assert count_tokens(awkward.limit(0), path, scratch_path(spark, "cache")).count() == 0


def test_a_task_encodes_a_word_once(monkeypatch):
    from clipwright.llm import token_counts
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    texts = ["it's we'll CAN'T x.", "a b\nc d", "\u00c9t\u00e9 Stra\u00dfe###", "a<|endoftext|> b <|endoftext|>", "x1 ,. 1! '|", "", "A_b A_b"]
    apart = [" a", "a  b", "a \n b", "a\n\nb", "a ", "\na", "a\n", "a \u3000b", "a\tb \tc", "a \x1c b", "\u00a0 a"]
    with open(path, encoding="utf-8") as file:
        count = token_counts.Counter(file.read())
    for _ in range(2):
        assert count(texts + apart) == [len(library.encode(t, add_special_tokens=False)) for t in texts + apart]
    asked, learn = [], count.learn
    monkeypatch.setattr(count.bare, "learn", lambda word, lead: asked.append(word) or learn(word, lead))
    monkeypatch.setattr(count.led, "learn", lambda word, lead: asked.append(word) or learn(word, lead))
    count(texts * 3)
    assert not asked
    count(["a new new, word", "a word, new"])
    assert sorted(asked) == [",", "new", "new,", "word", "word,"]
    monkeypatch.setattr(token_counts, "KEPT_WORDS", 2)
    assert [count([t])[0] for t in texts] == count(texts)


# ------------------------------------------------------------------ simhash

def brute_fingerprint(text, width=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    shingles = [" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, ids, radius=4):
    parent = {f: f for f in fps}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    distinct = sorted(set(fps))
    for i, a in enumerate(distinct):
        for b in distinct[i + 1:]:
            if (a ^ b).bit_count() <= radius:
                parent[find(a)] = find(b)
    least = {}
    for f, i in zip(fps, ids):
        if i is not None:
            least[find(f)] = min(i, least.get(find(f), i))
    return [least.get(find(f)) for f in fps]


def test_fingerprints_and_components_of_documents(documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    found = rows(simhash.near_duplicates(documents).select("doc_id", simhash.as_hex(), "component_id"))
    assert len(found) == len(texts)
    small = [r for r in found if len(texts[r[0]]) < 3000]
    assert all(int(r[1], 16) == brute_fingerprint(texts[r[0]]) for r in small)
    assert [r[2] for r in found] == brute_components([int(r[1], 16) for r in found], [r[0] for r in found])


@pytest.mark.parametrize("n", [1500, 9000])
def test_links_of_dense_groups_and_chains(spark, n):
    random = np.random.default_rng(n)
    centre = int(random.integers(1 << 62))
    fps = {centre}
    for _ in range(n // 3):                       # one dense group
        fps.add(centre ^ sum(1 << int(b) for b in random.choice(64, random.integers(1, 4), replace=False)))
    chain = int(random.integers(1 << 62))
    for step in range(14):                        # a chain whose ends are far apart
        chain ^= 0b1111 << (4 * step)
        fps.add(chain)
    fps |= {int(x) for x in random.integers(0, 1 << 62, n)}
    fps = sorted(f - (1 << 64) if f >= 1 << 63 else f for f in fps)
    found = dict(rows(simhash.link(spark.createDataFrame([(f,) for f in fps], "fp long"))))
    unsigned = [f & (1 << 64) - 1 for f in fps]
    if n < 2000:
        expected = brute_components(unsigned, fps)
    else:
        values, parent = np.array(unsigned, np.uint64), list(range(len(fps)))

        def find(a):
            while parent[a] != a:
                parent[a] = parent[parent[a]]
                a = parent[a]
            return a

        for i in range(len(values)):
            for j in np.flatnonzero(np.bitwise_count(values[i + 1:] ^ values[i]) <= 4):
                parent[find(i)] = find(i + 1 + int(j))
        expected = [find(i) for i in range(len(fps))]
    groups, own = collections.defaultdict(set), collections.defaultdict(set)
    for f, e in zip(fps, expected):
        groups[e].add(f)
        own[found.get(f, f)].add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, own.values()))


def test_simhash_of_awkward_rows(spark, awkward):
    found = rows(simhash.near_duplicates(awkward).orderBy("doc_id"))
    assert len(found) == awkward.count()
    by_id = {r[0]: r for r in found if r[0] is not None}
    assert by_id[2][1] == by_id[3][1] == by_id[4][1] == 0 and by_id[4][2] == 2
    assert simhash.near_duplicates(awkward.limit(0)).count() == 0


# ------------------------------------------------------------------ licenses

def brute_licenses(text, containment=0.9):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    places, base, method, share = [], set(), set(), 0.0
    for phrase, label in LICENSE_PHRASES:
        p = phrase.split()
        own = [i for i in range(len(words)) if words[i:i + len(p)] == p]
        places += own
        base |= {label} if own else set()
    for line in lower(text).split("\n"):
        block = set(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", line))
        for label, template in LICENSE_TEMPLATES:
            t = template_words(template)
            if len(block & t) >= math.ceil(containment * len(t) - 1e-9):
                method.add(label)
                share = max(share, len(block & t) / len(t))
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | method)), 1.0 if places else share)


def test_licenses(spark, awkward, documents):
    texts = ["cc by nc cc-by-nc CC BY NC", "Under the MIT license under the mit license", "This work is licensed under the "
             "GNU General Public License version 3", "a licensed work: this is under version 3, GNU general public", "cc by", "\x01 a\x01b",
             "Licensed under CC BY-SA 4.0 by X\nApache License, Version 2.0"]
    made = spark.createDataFrame(list(enumerate(texts, 100)), "doc_id long, text string")
    for docs in (made, awkward, documents):
        expected = sorted(((r.doc_id, *brute_licenses(r.text)) for r in docs.collect()), key=str)
        assert sorted(rows(scan_licenses(docs, LICENSE_PHRASES, LICENSE_TEMPLATES)), key=str) == expected
    assert scan_licenses(awkward.limit(0), LICENSE_PHRASES, LICENSE_TEMPLATES).count() == 0


# ------------------------------------------------------------------ personal data

PATTERNS = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
            ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def brute_base(text):
    found = []
    for order, (kind, pattern) in enumerate(PATTERNS):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
            luhn = sum(v - 9 if v > 9 else v for v in doubled) % 10 == 0
            if {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else 0,
                    "card": 14 <= len(digits) <= 19 and luhn, "phone": 10 <= len(digits) <= 15}[kind]:
                found.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(x[2] for x in sorted(found))


def test_base_spans(spark, awkward, documents):
    texts = ["a@b.co_x@d.ef", "1.2.3.4.5.6.7.8", "256.1.1.1 0001.2.3.255", "+1 (017) 555-7713 é +12 (", "4111 1111 1111 1111",
             "x@y z@", "😀 a.b@c.d 😀 +1234567890-", "1-2-3-4-5-6-7-8-9-0-1-2-3-4 ", "1" * 50_000, "a@b" + ".b" * 20_000,
             "+1" + " " * 3000, "ip 10.0.0.1@x.y"]
    made = spark.createDataFrame(list(enumerate(texts, 100)), "doc_id long, text string")
    for docs in (made, awkward, documents):
        expected = sorted((str(r.doc_id), hashlib.sha256(brute_base(r.text).encode()).hexdigest()) for r in docs.collect())
        assert sorted((str(r.doc_id), r.base_sha256) for r in digests(find_personal_data(docs)).collect()) == expected
    assert find_personal_data(awkward.limit(0)).count() == 0


def test_patterns_learned_from_seeds_find_what_has_no_pattern(spark):
    texts = [f"please call the office desk at +1555123{i:04d} today" for i in range(40)]
    texts += ["please call the office desk at X-55-A today", "see room 101 now", "office desk at noon"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spans = {r.doc_id: r.spans for r in digests(find_personal_data(docs)).collect()}
    start = texts[40].index("X-55-A")
    assert spans[40] == f"id:{start}:{start + 6}" and spans[41] == spans[42] == ""
    assert all(spans[i].startswith("phone:") and "id" not in spans[i] for i in range(40))
    clean = {r.doc_id: r.text for r in redact(docs).collect()}
    assert clean[40] == "please call the office desk at [id] today" and clean[0].split()[6] == "[phone]"


def test_redaction_keeps_rows_and_columns(awkward):
    clean = redact(awkward)
    assert clean.columns == awkward.columns and clean.count() == awkward.count()
    assert [r.text for r in clean.collect() if r.text and "[" in r.text] == ["mail [email] or [phone]"]


# ------------------------------------------------------------------ quality

def test_quality_separates_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    found = {r.doc_id: r for r in QUERIES["op2_quality"](spark, folder).collect()}
    labels = [r for r in spark.read.parquet(f"{folder}/labels.parquet").collect() if found[r.doc_id].held_out]
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 for i, r in found.items())
    right = sum(found[r.doc_id].predicted == r.quality for r in labels)
    assert len(labels) > 50 and right / len(labels) > 0.95


def test_quality_votes_are_exact(spark, documents, sf_dir):
    voter = fit_voter(documents, spark.read.parquet(f"{sf_dir}/labels.parquet"), sample_rows=40, rank=8, neighbours=5)
    from clipwright.llm.quality import term_counts

    texts = [r.text.encode() for r in documents.limit(20).collect()]
    data = np.frombuffer(b"".join(texts), np.uint8)
    counts = term_counts(data, np.concatenate([[0], np.cumsum([len(t) for t in texts])]))
    latent = voter.latent(counts).astype(float)
    for vector, score in zip(latent, voter.score(counts)):
        cosines = voter.vectors.astype(float) @ vector
        near = np.argsort(-cosines)[:5]
        weight = np.clip(cosines[near], 0, 1) ** 8
        assert score == pytest.approx((weight * voter.labels[near]).sum() / weight.sum(), abs=1e-4)


def test_quality_of_awkward_rows(spark, awkward):
    labels = spark.createDataFrame([(1, 1, None), (6, 0, 1), (None, 1, 1), (7, None, 0), (6, 0, 0)], "doc_id long, quality int, toxic int")
    voter = fit_voter(awkward, labels)
    assert score_documents(awkward, voter, "own").count() == awkward.count()
    nothing = fit_voter(awkward.limit(0), labels.limit(0))
    assert {r.own for r in score_documents(awkward, nothing, "own").collect()} == {0.5}
    assert score_documents(awkward.limit(0), voter, "own").count() == 0


# ------------------------------------------------------------------ decontamination

def brute_tiles(x, y, k):
    used_x, used_y, total = [0] * len(x), [0] * len(y), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(x)):
            for j in range(len(y)):
                n = 0
                while i + n < len(x) and j + n < len(y) and x[i + n] == y[j + n] and not used_x[i + n] and not used_y[j + n]:
                    n += 1
                best = max(best, (n, -i, -j))
        n, i, j = best[0], -best[1], -best[2]
        if n < k:
            return total
        total += n
        used_x[i:i + n] = used_y[j:j + n] = [1] * n


def test_tiles_match_the_plain_algorithm(spark):
    random = np.random.default_rng(3)
    items = [(j, " ".join(random.choice(list("abc"), 20))) for j in range(6)] + [(90, "a b"), (91, None), (92, ""), (None, "a a a a a a")]
    docs = [(i, " ".join(random.choice(list("abc"), 40))) for i in range(25)] + [(90, None), (91, ""), (None, "b " * 50), (92, "a " * 300)]
    docs_df = spark.createDataFrame(docs, "doc_id long, text string")
    items_df = spark.createDataFrame(items, "item_id long, text string")
    for block in (2_000_000, 30):
        found = {(r.doc_id, r.item_id): r.n_words for r in contaminated(docs_df, items_df, match=4, coverage=0.0, block_words=block).collect()}
        expected = {(i, j): n for i, d in docs for j, t in items if (n := brute_tiles((d or "").split(), (t or "").split(), 4))}
        assert found == expected


def test_reordered_passages_are_caught_and_rows_kept(spark, awkward):
    item = " ".join(f"w{i}" for i in range(30))
    words = item.split()
    moved = " ".join(words[20:] + ["x"] + words[:10] + ["y"] + words[10:20])
    docs = spark.createDataFrame([(1, f"start {moved} end"), (2, " ".join(words[:12])), (3, None)], "doc_id long, text string")
    items = spark.createDataFrame([(7, item)], "item_id long, text string")
    assert [(r.doc_id, r.item_id, r.coverage, r.n_tiles) for r in contaminated(docs, items).collect()] == [(1, 7, 1.0, 3)]
    assert sorted(r.doc_id for r in without_contaminated(docs, items).collect()) == [2, 3]
    assert without_contaminated(awkward, items).count() == awkward.count()
    assert contaminated(docs, items.limit(0)).count() == contaminated(docs.limit(0), items).count() == 0
    assert without_contaminated(docs, items.limit(0)).count() == 3


# ------------------------------------------------------------------ segmentation

@pytest.fixture(scope="module")
def vocabulary():
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        return segment.Vocabulary(file.read(), 1.0)


def all_segmentations(text, vocabulary):
    pieces = {vocabulary.pieces[i]: (int(i), w) for i, w in zip(vocabulary.ids, vocabulary.weights)}
    marked = "▁" + text.replace(" ", "▁")

    def rest(i):
        if i == len(marked):
            return [((), 0.0)]
        out = []
        for j in range(i + 1, min(len(marked), i + vocabulary.longest) + 1):
            if marked[i:j] in pieces:
                number, weight = pieces[marked[i:j]]
                out += [((number, *r), weight + w) for r, w in rest(j)]
        if marked[i] not in pieces:
            raw = marked[i].encode()
            out += [((*(vocabulary.bytes[b] for b in raw), *r), len(raw) * vocabulary.byte_weight + w) for r, w in rest(i + 1)]
        return out

    found = rest(0)
    total = np.logaddexp.reduce([w for _, w in found])
    return {ids: w - total for ids, w in found}


@pytest.mark.parametrize("text", ["the cat", "é\nab", "aa"])
def test_samples_follow_the_lattice_s_distribution(text, vocabulary):
    reference, n, k = all_segmentations(text, vocabulary), 3000, 2
    first, second, weight = collections.Counter(), collections.Counter(), collections.Counter()
    for paths in segment.segment_block([text] * n, list(range(n)), k, 5, segment.Units(vocabulary)):
        ids = [tuple(p[0].tolist()) for p in paths]
        assert len(set(ids)) == len(ids) == min(k, len(reference))
        assert all(abs(p[1] - reference[i]) < 1e-9 for p, i in zip(paths, ids)) and paths[0][2] >= paths[-1][2]
        first[ids[0]] += 1 / n
        second[ids[-1]] += 1 / n
        for p, i in zip(paths, ids):
            weight[i] += 1 / p[3] / n
    p = {ids: math.exp(w) for ids, w in reference.items()}
    for ids in sorted(p, key=p.get)[-3:]:
        assert first[ids] == pytest.approx(p[ids], abs=0.04)
        expected = sum(p[o] * p[ids] / (1 - p[o]) for o in p if o != ids)
        assert second[ids] == pytest.approx(expected, abs=0.04)
        if p[ids] > 0.05:
            assert weight[ids] == pytest.approx(1, abs=0.15)


def test_samples_decode_to_their_text(spark, awkward, documents):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    for docs in (awkward, documents):
        samples = segment.encode_samples(docs, path, k=2)
        decoded = segment.decode_samples(samples, path).collect()
        expected = collections.Counter((r.doc_id, r.text or "") for r in docs.collect())
        assert collections.Counter((r.doc_id, r.text) for r in decoded if r["sample"] == 1) == expected
        for r in decoded[:40]:
            assert library.decode(np.frombuffer(r.pieces, np.int32).tolist()) == r.text
    empty = [r for r in segment.encode_samples(awkward, path).collect() if r.n_pieces == 0]
    assert len(empty) == 3 and all(r.inclusion == 1.0 and r["sample"] == 1 for r in empty)
    assert segment.encode_samples(awkward.limit(0), path).count() == 0


def test_paths_of_a_block_are_drawn_together(vocabulary, monkeypatch):
    draws, draw = [], segment._draw
    monkeypatch.setattr(segment, "_draw", lambda *a: draws.append(len(a[1])) or draw(*a))
    texts = ["the cat sat", "", "one two three four", "a", "\u00e9t\u00e9 \u4e2d", "the cat sat"]
    kept = segment.Units(vocabulary)
    together = [[(p[0].tolist(), *p[1:]) for p in paths] for paths in segment.segment_block(texts, list(range(6)), 3, 5, kept)]
    assert len(draws) == 3                                       # one for each path, whatever the number of texts
    alone = [[(p[0].tolist(), *p[1:]) for p in next(segment.segment_block([t], [i], 3, 5, kept))] for i, t in enumerate(texts)]
    assert together == alone and together[0] != together[5]
    for text, paths in zip(texts, together):
        reference = all_segmentations(text, vocabulary) if text else {(): 0.0}
        assert len({tuple(p[0]) for p in paths}) == min(3, len(reference))
        assert all(p[1] == pytest.approx(reference[tuple(p[0])], abs=1e-9) for p in paths)
        assert [p[2] for p in paths] == sorted((p[2] for p in paths), reverse=True)


# ------------------------------------------------------------------ language model

def brute_model(training):
    c = collections.Counter(w for x in training for w in x)
    b = collections.Counter((u, w) for x in training for u, w in zip(["start", *x], x))
    total, kinds, cont = collections.Counter(), collections.defaultdict(lambda: [0] * 4), collections.Counter()
    for (u, w), n in b.items():
        total[u] += n
        kinds[u][min(n, 3)] += 1
        cont[w] += 1
    coc, coc1 = collections.Counter(b.values()), collections.Counter(cont.values())
    d, e = kneser_ney.discounts([coc[k] for k in (1, 2, 3, 4)]), kneser_ney.discounts([coc1[k] for k in (1, 2, 3, 4)])
    spare = e[1] * coc1[1] + e[2] * coc1[2] + e[3] * sum(n for k, n in coc1.items() if k > 2)

    def lower_order(w):
        return (max(cont[w] - e[min(cont[w], 3)], 0) + spare / (len(c) + 1)) / len(b)

    def probability(u, w):
        if not total[u]:
            return lower_order(w)
        n = b[u, w]
        return (max(n - d[min(n, 3)], 0) + sum(d[k] * kinds[u][k] for k in (1, 2, 3)) * lower_order(w)) / total[u]

    return c, probability


def model_tokens(text):
    return [*re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower()), None]


@pytest.mark.parametrize("shards", [(4_000_000, 1_000_000), (20_000, 3_000)])
def test_language_model(spark, documents, monkeypatch, shards):
    monkeypatch.setattr(kneser_ney, "SHARD_TOKENS", shards[0])
    monkeypatch.setattr(kneser_ney, "SHARD_WORDS", shards[1])
    monkeypatch.setattr(kneser_ney, "GATHER", 10 * shards[1])
    docs = [(r.doc_id, r.text) for r in documents.collect()]
    training = [model_tokens(t) for i, t in docs if zlib.crc32(str(i).encode()) % 5 != 1]
    c, probability = brute_model(training)
    n, v = sum(c.values()), len(c)
    assert sum(probability(b"the", w) for w in c) + probability(b"the", "unseen") == pytest.approx(1)
    found = {r.doc_id: r for r in QUERIES["op10_kneser_ney"](spark, "/root/testdata/sf0.001").collect()}
    for i, text in docs:
        x, r = model_tokens(text), found[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(x), sum(c[w] > 0 for w in x), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in x))
        assert r.score == pytest.approx(sum(math.log10(probability(u, w)) for u, w in zip(["start", *x], x)))


def test_language_model_of_awkward_rows(spark, awkward):
    model = kneser_ney.fit(awkward)
    found = kneser_ney.score(awkward, model, ["doc_id"]).collect()
    assert len(found) == awkward.count() and all(r.score <= 0 and math.isfinite(r.score) for r in found)
    empty = kneser_ney.fit(awkward.limit(0))
    assert {(r.score, r.base_score, r.n_known) for r in kneser_ney.score(awkward, empty, ["doc_id"]).collect()} == {(0.0, 0.0, 0)}
    assert kneser_ney.score(awkward.limit(0), model, ["doc_id"]).count() == 0


def test_counting_holds_little_more_than_what_it_gathers(monkeypatch):
    import tracemalloc

    import pyarrow as pa

    monkeypatch.setattr(kneser_ney, "GATHER", 500_000)
    random = np.random.default_rng(4)
    texts = [" ".join(map(str, random.integers(0, 1000, 20_000))) for _ in range(60)]
    batches = [pa.RecordBatch.from_arrays([pa.array([t])], names=["text"]) for t in texts]
    count = kneser_ney._count_bigrams(np.array([kneser_ney.START]), 50)
    list(count(batches[:1]))
    tracemalloc.start()
    pairs = 0
    for batch in count(batches):
        assert batch.num_rows <= 8
        pairs += sum(np.frombuffer(n, np.uint8 if len(n) * 8 == len(w) else np.int64).sum()
                     for n, w in zip(batch.column("n").to_pylist(), batch.column("second").to_pylist()))
        del batch
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert pairs == 60 * 20_001
    assert peak < 80 * 500_000          # a gathered pair takes 16 bytes
