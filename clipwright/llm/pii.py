"""Personal data: four base kinds by pattern, and bootstrapped contextual extraction for what has no pattern.

Base kinds are found leftmost and non-overlapping, each on its own.  A text is split by the kind's expression; lengths
of what lies between and of the matches give positions in code points.

The bootstrap looks at *instances*: base entities (the seeds) and every other token that holds a digit or one of the signs
``@ _ #``.  The whole words around an occurrence, however long, make its lexical patterns: the two words before it, and the
word before with the word behind.  Patterns and distinct instances form a graph, scored in rounds:

- A pattern is *known* if a sure instance stands in it.  An instance's *doubt* is the share of its different contexts with no
  known pattern: a number that stands everywhere is no identifier, one that stands only where identifiers do may be.
- A pattern scores for / (for + against): the scores of its instances, and what is missing to a score of 1 times the doubt.
  An instance nothing is known about speaks neither way.  Patterns with enough sure instances and score are trusted.
- An instance scores the best of its trusted patterns; seeds score 1 throughout.

A token that stands in a trusted pattern of the last round, and is not doubtful itself, is reported as kind ``id``.  Copies count
once, since edges join distinct values.

Only DataFrame functions are used.

Defined results: a null or empty text has no spans; repeated rows and null ids give a row each; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipwright.llm.common import fresh, row_key, whole_text, written

# Possessive and anchored forms of the kinds' expressions: they match the same places without rescanning long runs.
LOCAL, DOMAIN = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
KINDS = [
    ("email", rf"(?:\G|(?<!{LOCAL})){LOCAL}++@{DOMAIN}++(?:\.{DOMAIN}++)++"),
    ("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"),
    ("card", r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]
#: Cheap necessary conditions, so that most texts skip the expression.
HINTS = {"email": "@", "phone": "+"}
#: A token with a digit or sign of an identifier; kind of the spans that the bootstrap adds.
SIGNS = "0-9@_#"
TOKEN, METHOD_KIND = rf"(?<!\S)[^\s{SIGNS}]*+[{SIGNS}]\S*+", "id"
#: Characters in which context words are looked for first; where whole words reach beyond, all of the text is taken.
NEAR = 200
EDGES = r"^[\"'(\[{<=:;,]+|[\"')\]}>,;:.!?]+$"


def occurrences(text: Column, expression: str) -> Column:
    """array<struct<s, e, m>>: start, end and text of every match, from 0, in code points."""
    matches = F.regexp_extract_all(text, F.lit(expression), F.lit(0))
    zipped = F.arrays_zip(F.split(text, expression, -1).alias("p"), matches.alias("m"))
    empty = F.array().cast("array<struct<s:int,e:int,m:string>>")
    start = lambda a, z: a["at"] + F.length(z["p"])
    step = lambda a, z: F.when(z["m"].isNull(), a).otherwise(F.struct(
        (start(a, z) + F.length(z["m"])).alias("at"),
        F.array_append(a["found"], F.struct(start(a, z).alias("s"), (start(a, z) + F.length(z["m"])).alias("e"),
                                            z["m"].alias("m"))).alias("found")))
    return F.aggregate(zipped, F.struct(F.lit(0).alias("at"), empty.alias("found")), step, lambda a: a["found"])


def _luhn(digits: Column) -> Column:
    """Whether the digits pass the Luhn check, from the last one leftward."""
    def value(c: Column, i: Column) -> Column:
        digit = c.cast("int")
        twice = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        return F.when(i % 2 == 1, twice).otherwise(digit)

    total = F.aggregate(F.transform(F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""), value), F.lit(0), lambda a, x: a + x)
    return total % 10 == 0


def _sound(kind: str, found: Column) -> Column:
    text = found["m"]
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        small = lambda part: F.regexp_replace(part, "^0+(?=[0-9])", "").rlike(r"^(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$")
        return F.forall(F.split(text, r"\."), small)
    digits = F.regexp_replace(text, "[^0-9]", "")
    if kind == "card":
        return F.length(digits).between(14, 19) & F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(False)
    return F.length(digits).between(10, 15)


def base_spans(text: Column) -> Column:
    """array<struct<s, o, e, kind, m>> of the four kinds, by start and then kind."""
    none = F.array().cast("array<struct<s:int,o:int,e:int,kind:string,m:string>>")
    digits = text.rlike("[0-9]")
    parts = []
    for order, (kind, expression) in enumerate(KINDS):
        found = F.filter(occurrences(text, expression), lambda x: _sound(kind, x))  # noqa: B023
        spans = F.transform(found, lambda x: F.struct(  # noqa: B023
            x["s"].alias("s"), F.lit(order).alias("o"), x["e"].alias("e"), F.lit(kind).alias("kind"), x["m"].alias("m")))  # noqa: B023
        likely = text.contains(HINTS[kind]) if kind in HINTS else digits
        parts.append(F.when(likely, spans).otherwise(none))
    return F.array_sort(F.concat(*parts))


def spelled(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")


def _words(near: str, whole: str, more: str, enough: int) -> Column:
    """Lower-case words of the near text, or of the whole one where more text follows and too few words are surely whole."""
    parts = lambda text: F.filter(F.split(F.lower(F.expr(text)), r"\s+"), lambda w: w != "")
    return F.when(F.expr(more) & (F.size(parts(near)) < enough), parts(whole)).otherwise(parts(near))


def _candidates(marked: DataFrame) -> DataFrame:
    """(key, s, e, value, seed, patterns) of base entities and of other tokens that may identify someone."""
    none = F.array().cast("array<struct<s:int,e:int,m:string>>")
    tokens = F.when(F.col("text").rlike(f"[{SIGNS}]"), occurrences(F.col("text"), TOKEN)).otherwise(none)
    # a token that touches a base span is part of it
    free = F.filter(tokens, lambda t: ~F.exists("base", lambda b: (b["s"] < t["e"]) & (t["s"] < b["e"])))
    both = F.concat(F.transform("base", lambda b: F.struct(b["s"], b["e"], b["m"], F.lit(True).alias("seed"))),
                    F.transform(free, lambda t: F.struct(t["s"], t["e"], t["m"], F.lit(False).alias("seed"))))
    rows = marked.select("key", "text", F.explode(both).alias("x")).select(
        "key", F.col("x.s").alias("s"), F.col("x.e").alias("e"), F.col("x.m").alias("m"), F.col("x.seed").alias("seed"),
        _words(f"substring(text, greatest(x.s - {NEAR}, 0) + 1, least(x.s, {NEAR}))", "substring(text, 1, x.s)",
               f"x.s > {NEAR}", 3).alias("before"),
        _words(f"substring(text, x.e + 1, {NEAR})", "substring(text, x.e + 1, length(text))",
               f"length(text) > x.e + {NEAR}", 2).alias("behind"))
    # quotes and brackets around a token belong to its context, not to it
    lead = F.length(F.regexp_extract("m", r"^[\"'(\[{<=:;,]*", 0))
    rows = rows.withColumn("cut", F.when(F.col("seed"), F.col("m")).otherwise(F.regexp_replace("m", EDGES, "")))
    rows = rows.withColumn("s", F.when(F.col("seed"), F.col("s")).otherwise(F.col("s") + lead))
    rows = rows.withColumn("e", F.col("s") + F.length("cut")).filter(F.col("cut").rlike(f"[{SIGNS}]"))
    before = F.col("before")
    rows = rows.withColumns({"l1": F.get(before, F.size(before) - 1), "l2": F.get(before, F.size(before) - 2),
                             "r1": F.get("behind", F.lit(0))})
    patterns = F.array(F.concat(F.lit("b "), "l2", F.lit(" "), "l1"), F.concat(F.lit("a "), "l1", F.lit(" _ "), "r1"))
    return rows.select("key", "s", "e", F.col("cut").alias("value"), "seed", F.array_compact(patterns).alias("patterns"))


def _doubts(contexts: DataFrame, edges: DataFrame, scores: DataFrame, confidence: float) -> DataFrame:
    """(value, doubt): the share of a value's contexts in which no pattern has a sure instance."""
    sure = scores.filter(F.col("score") >= confidence).select("value")
    known = edges.join(sure, "value", "left_semi").select("pattern").distinct().withColumn("known", F.lit(1))
    opened = contexts.select("value", "patterns", F.explode("patterns").alias("pattern")).join(known, "pattern", "left")
    supported = opened.groupBy("value", "patterns").agg(F.max("known").alias("known"))
    return supported.groupBy("value").agg((1.0 - F.count("known") / F.count("*")).alias("doubt"))


def trusted_patterns(candidates: DataFrame, rounds: int, support: int, confidence: float, doubt: float) -> tuple[DataFrame, DataFrame]:
    """(pattern) of the last round's trusted ones, with ``support`` sure instances and a score of ``confidence`` or more,
    and (value) of the instances with more than ``doubt``."""
    if rounds < 1:
        raise ValueError("at least one round")
    contexts = written(candidates.groupBy("patterns", "value").agg(F.max("seed").alias("seed")), "pii-contexts")
    edges = written(contexts.select(F.explode("patterns").alias("pattern"), "value", "seed").groupBy(
        "pattern", "value").agg(F.max("seed").alias("seed")), "pii-edges")
    scores = written(edges.groupBy("value").agg(F.max(F.col("seed").cast("double")).alias("score")), "pii-scores")
    for number in range(rounds):
        scored = written(scores.join(_doubts(contexts, edges, scores, confidence), "value"), "pii-doubts")
        rated = edges.join(scored, "value").groupBy("pattern").agg(
            F.sum("score").alias("pro"), F.sum((1.0 - F.col("score")) * F.col("doubt")).alias("contra"),
            F.sum((F.col("score") >= confidence).cast("long")).alias("known"))
        mean = F.try_divide(F.col("pro"), F.col("pro") + F.col("contra"))
        rated = written(rated.withColumn("mean", mean).filter((F.col("known") >= support) & (F.col("mean") >= confidence)), "pii-patterns")
        if number < rounds - 1:
            reached = edges.join(rated, "pattern").groupBy("value").agg(F.max("mean").alias("reached"))
            scores = written(scored.join(reached, "value", "left").select("value", F.when(
                F.col("doubt") <= doubt, F.greatest("score", "reached")).otherwise(F.col("score")).alias("score")), "pii-scores")
    return rated.select("pattern"), scored.filter((F.col("score") < 1) & (F.col("doubt") > doubt)).select("value")


def find_personal_data(docs: DataFrame, rounds: int = 3, support: int = 5, confidence: float = 0.8, doubt: float = 0.5,
                       id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, key, base, spans) of every document; both arrays hold structs (s, o, e, kind, m) by start, then kind."""
    docs = docs.select(F.col(id_column).alias("_id"), whole_text(text_column).alias("text"))
    marked = docs.withColumns({"key": row_key("_id", "text"), "base": base_spans(F.col("text"))})
    # most texts hold no such sign; they need not be looked at again
    candidates = written(_candidates(marked.filter(F.col("text").rlike(f"[{SIGNS}]"))), "pii-candidates")
    patterns, doubtful = trusted_patterns(candidates, rounds, support, confidence, doubt)
    unseen = candidates.filter("not seed").select("key", "s", "e", "value", F.explode("patterns").alias("pattern"))
    found = unseen.join(patterns, "pattern").join(doubtful, "value", "left_anti").select("key", "s", "e", "value").distinct().groupBy("key").agg(
        F.collect_list(F.struct("s", F.lit(len(KINDS)).alias("o"), "e", F.lit(METHOD_KIND).alias("kind"),
                                F.col("value").alias("m"))).alias("more"))
    marked = marked.select("_id", F.col("key").alias("k"), "base")
    joined = marked.join(found, F.col("k").eqNullSafe(F.col("key")), "left").drop("key")
    spans = F.when(F.col("more").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "more")))
    return joined.select(F.col("_id").alias(id_column), F.col("k").alias("key"), "base", spans.alias("spans"))


def digests(found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Counts per base kind, the digest of the base spans, and all spans as text."""
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(id_column, *[count(kind) for kind, _ in KINDS],
                        F.sha2(spelled(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                        spelled(F.col("spans")).alias("spans"))


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; spans that overlap the one before add nothing."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
    piece = lambda a, x: F.substring(text, a["at"] + 1, x["s"] - a["at"])
    step = lambda a, x: F.when(x["s"] < a["at"], F.struct(F.greatest(a["at"], x["e"]).alias("at"), a["parts"].alias("parts"))).otherwise(
        F.struct(x["e"].alias("at"), F.array_append(a["parts"], F.concat(piece(a, x), F.lit("["), x["kind"], F.lit("]"))).alias("parts")))
    rest = lambda a: F.concat(F.array_join(a["parts"], ""), F.substring(text, a["at"] + 1, F.length(text)))
    return F.aggregate(spans, start, step, rest)


def redact(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **settings) -> DataFrame:
    """The documents, all columns, with personal data replaced by its kind; a null text stays null."""
    key, spans = fresh("pii_key", docs), fresh("pii_spans", docs)
    found = find_personal_data(docs, id_column=id_column, text_column=text_column, **settings)
    found = found.filter(F.size("spans") > 0).select(F.col("key").alias(key), F.col("spans").alias(spans)).distinct()
    joined = docs.join(found, row_key(id_column, text_column).eqNullSafe(F.col(key)), "left")
    return joined.withColumn(text_column, F.when(F.col(spans).isNull(), F.col(text_column)).otherwise(
        redacted(F.col(text_column), F.col(spans)))).select(*docs.columns)
