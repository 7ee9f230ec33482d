"""The bootstrap of personal data beside plain Python, and what its evidence finds and leaves alone."""

import collections
import random

import pytest

from clipwright.llm.pii import digests, find_personal_data


def phone(i):
    return f"+1 202 555 {i:04d}"


def method_values(spark, texts, **settings):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = find_personal_data(docs, **settings).collect()
    return {s["m"] for r in found for s in r.spans if s["kind"] == "id"}


def plain(occurrences, rounds=3, support=5, confidence=0.8, limit=0.5):
    """Values reported for (value, seed, patterns) occurrences."""
    contexts = {(v, p) for v, _, p in occurrences}
    edges = {(pattern, v) for v, p in contexts for pattern in p}
    score = {v: 0.0 for _, v in edges} | {v: 1.0 for v, seed, p in occurrences if seed and p}
    for number in range(rounds):
        known = {p for p, v in edges if score[v] >= confidence}
        own = collections.defaultdict(list)
        for v, p in contexts:
            if p:
                own[v].append(not any(q in known for q in p))
        doubt = {v: sum(d) / len(d) for v, d in own.items()}
        pro, contra, sure = collections.Counter(), collections.Counter(), collections.Counter()
        for p, v in edges:
            pro[p] += score[v]
            contra[p] += (1 - score[v]) * doubt[v]
            sure[p] += score[v] >= confidence
        mean = {p: pro[p] / (pro[p] + contra[p]) for p in pro if pro[p] + contra[p] > 0}
        trusted = {p for p in mean if sure[p] >= support and mean[p] >= confidence}
        if number < rounds - 1:
            for v in list(score):
                if doubt[v] <= limit:
                    score[v] = max([score[v]] + [mean[p] for p in trusted if (p, v) in edges])
    return {v for v, seed, p in occurrences if not seed and set(p) & trusted and not (score[v] < 1 and doubt[v] > limit)}


def test_unseen_identifiers_may_be_a_large_share(spark):
    texts = [f"please call me at {phone(i)} before noon" for i in range(30)]
    texts += [f"please call me at x{i}-77 before noon" for i in range(10)]
    assert method_values(spark, texts) == {f"x{i}-77" for i in range(10)}


def test_signs_without_digits_and_second_round(spark):
    texts = [f"write to me under {phone(i)} thanks" for i in range(20)]
    # learned in the first round, these handles bring a second context to trust in the next one
    texts += [f"write to me under @{c}name thanks" for c in "abcdefgh"] + [f"known online as @{c}name everywhere" for c in "abcdefgh"]
    texts += ["known online as @newcomer everywhere"]
    found = method_values(spark, texts)
    assert {f"@{c}name" for c in "abcdefgh"} <= found and "@newcomer" in found


def test_numbers_that_stand_everywhere_are_left_alone(spark):
    texts = [f"call me at {phone(i)} now" for i in range(20)] + ["call me at 7 now"]
    texts += [f"part {chr(97 + i)} 7 of {chr(97 + i)}" for i in range(20)]
    assert "7" not in method_values(spark, texts)
    # contexts in which plain numbers are the rule are not trusted
    mixed = [f"it costs about {phone(i)} each" for i in range(6)]
    mixed += [f"it costs about {n} each" for n in range(100, 140)] + [f"page{w} {n} of{w} volume" for n in range(100, 140) for w in "uvwxyz"]
    assert method_values(spark, mixed) == set()


def test_context_words_are_whole(spark):
    """Words far longer than the window looked at first make the same patterns as everywhere else."""
    long = "x" * 1500
    texts = [f"{long} account {phone(i)} {long} end" for i in range(10)] + [f"{'y' * i}z {long} account q9-{i} {long} end" for i in range(4)]
    assert method_values(spark, texts) == {f"q9-{i}" for i in range(4)}
    # the words before differ only beyond the window
    apart = [f"{'a' + long} account {phone(i)} r{chr(97 + i)}" for i in range(10)] + [f"{'b' + long} account q9-{i} s{chr(97 + i)}" for i in range(4)]
    assert method_values(spark, apart) == set()


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_scores_equal_plain_python(spark, seed):
    draw = random.Random(seed)
    words, values = ["at", "on", "call", "see", "room", "from"], [f"v{i}" for i in range(25)]
    texts, occurrences = [], set()
    for i in range(220):
        before, behind = [draw.choice(words) for _ in range(2)], draw.choice(words[:3])
        known = draw.random() < (0.8 if before[1] in ("call", "at") else 0.1)
        value = phone(draw.randrange(40)) if known else draw.choice(values)
        texts.append(" ".join([*before, value, behind]))
        occurrences.add((value, known, (f"b {before[0]} {before[1]}", f"a {before[1]} _ {behind}")))
    for confidence, support in ((0.8, 5), (0.6, 2)):
        mine = method_values(spark, texts, confidence=confidence, support=support)
        assert mine == plain(occurrences, support=support, confidence=confidence)


def test_nothing_to_learn_from(spark):
    assert method_values(spark, ["", None, "a1 b2 c3", "@x _y #z"]) == set()
    docs = spark.createDataFrame([(1, None), (1, None), (None, "call 5")], "doc_id long, text string")
    assert digests(find_personal_data(docs)).count() == 3
