"""Queries that apply the operators to whole tables, and the SQL that checks them where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipwright.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if check:
            CHECKS[name] = check
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: Tokens a training context holds.
CONTEXT_TOKENS = 512


@query("op1_token_counts")
def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document.  ``spark.llm.token.cache`` names a cache that outlives the query; unset, it is new."""
    import public_tokenizers

    from clipwright.llm.token_counts import count_tokens

    cache = spark.conf.get("spark.llm.token.cache", None) or scratch_path(spark, "token-cache")
    counts = count_tokens(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), cache)
    return counts.withColumn("over_limit", F.col("n_tokens") > CONTEXT_TOKENS)


@query("op7_topk", """
    WITH e AS (
      SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings
      WHERE vec_id IS NOT NULL),
    v AS (
      SELECT vec_id, i, floor(256 * x)::BIGINT AS x FROM e
      WHERE vec_id NOT IN (SELECT vec_id FROM e WHERE x IS NULL OR NOT isfinite(x))),
    s AS (
      SELECT q.vec_id AS query_id, c.vec_id, sum(q.x * c.x)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND q.i = c.i GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
""")
def op7_topk(spark: SparkSession, folder: str) -> DataFrame:
    from clipwright.llm.topk import top_k

    return top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"),
             ("allow", "org", "/fr/")]


@query("op8_url_filter")
def op8_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    from clipwright.llm.urls import judge_urls

    return judge_urls(table(spark, folder, "pages"), URL_RULES)


@query("op4_simhash")
def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    from clipwright.llm.simhash import as_hex, near_duplicates

    found = near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", as_hex().alias("fingerprint"), "component_id")


# fixed values: phrases and labels of the scan's base
LICENSE_PHRASES = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]
#: Short notices by which works state their license.
LICENSE_TEMPLATES = [
    ("mit", "Released under the MIT License."),
    ("apache-2", "Licensed under the Apache License, Version 2.0."),
    ("bsd-3", "Use of this source code is governed by a BSD 3-clause license."),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3."),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
]
LICENSE_CONTAINMENT = 0.9


def _license_check() -> str:
    from clipwright.llm.licenses import template_words

    def quoted(words) -> str:
        return "[" + ", ".join(f"'{w}'" for w in words) + "]"

    places = " UNION ALL ".join(
        f"SELECT doc_id, '{label}' AS label, i - 1 AS place FROM words, unnest(range(1, len(w) + 1)) AS r(i) "
        f"WHERE w[i:i + {len(phrase.split()) - 1}] = {quoted(phrase.split())}" for phrase, label in LICENSE_PHRASES)
    templates = ", ".join(f"('{label}', {quoted(sorted(template_words(text)))})" for label, text in LICENSE_TEMPLATES)
    return rf"""
    WITH low AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
                 FROM documents),
    words AS (SELECT doc_id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM low),
    places AS ({places}),
    base AS (SELECT doc_id, count(*) AS n, min(place) AS f, max(place) AS l, list(DISTINCT label) AS labels FROM places GROUP BY doc_id),
    templates(label, t) AS (VALUES {templates}),
    blocks AS (SELECT doc_id, list_distinct(regexp_extract_all(line, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS b
               FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM low)),
    method AS (SELECT doc_id, list(DISTINCT label) AS labels, max(len(list_intersect(b, t)) / len(t)) AS share
               FROM blocks, templates WHERE len(list_intersect(b, t)) >= ceil({LICENSE_CONTAINMENT} * len(t) - 1e-9) GROUP BY doc_id)
    SELECT w.doc_id, len(w.w)::BIGINT AS n_words, coalesce(base.n, 0)::BIGINT AS n_base, base.f::BIGINT AS first_word,
           base.l::BIGINT AS last_word, coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
           coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(method.labels, [])))), ','), '') AS labels,
           CASE WHEN base.n > 0 THEN 1.0 ELSE coalesce(method.share, 0.0) END::DOUBLE AS score
    FROM words w LEFT JOIN base USING (doc_id) LEFT JOIN method USING (doc_id)
    """


@query("op5_licenses", _license_check())
def op5_licenses(spark: SparkSession, folder: str) -> DataFrame:
    from clipwright.llm.licenses import scan_licenses

    return scan_licenses(table(spark, folder, "documents"), LICENSE_PHRASES, LICENSE_TEMPLATES, LICENSE_CONTAINMENT)


@query("op6_pii")
def op6_pii(spark: SparkSession, folder: str) -> DataFrame:
    from clipwright.llm.pii import digests, find_personal_data

    return digests(find_personal_data(table(spark, folder, "documents")))


#: Documents scoring at least this are kept.
QUALITY_THRESHOLD = 0.3


@query("op2_quality")
def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    from clipwright.llm.common import held_out
    from clipwright.llm.quality import fit_voter, score_documents

    docs = table(spark, folder, "documents")
    voter = fit_voter(docs, table(spark, folder, "labels"))
    scored = score_documents(docs, voter, keep=["doc_id"])
    return scored.select("doc_id", held_out("doc_id", 0).alias("held_out"), "score",
                         (F.col("score") >= QUALITY_THRESHOLD).cast("int").alias("predicted"))


@query("op10_kneser_ney")
def op10_kneser_ney(spark: SparkSession, folder: str) -> DataFrame:
    from clipwright.llm.common import held_out
    from clipwright.llm.kneser_ney import fit, score

    docs = table(spark, folder, "documents")
    model = fit(docs.filter(~held_out("doc_id", 1)))
    return score(docs, model, ["doc_id"]).select(
        "doc_id", held_out("doc_id", 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")


@query("op3_decontamination")
def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    from clipwright.llm.decontaminate import contaminated

    return contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op9_segmentation")
def op9_segmentation(spark: SparkSession, folder: str) -> DataFrame:
    """Two sampled segmentations of every document; the pieces are given by their digest."""
    import public_tokenizers

    from clipwright.llm.segment import encode_samples

    samples = encode_samples(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return samples.withColumn("pieces_sha256", F.sha2("pieces", 256)).drop("pieces")


@query("op12_best_fit_packing")
def op12_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    from clipwright.llm.packing import pack_documents

    return pack_documents(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op13_periodic_runs")
def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of every document, with periodic words written into a tenth of them; texts are given by their digest."""
    from clipwright.llm.periods import periodic_runs

    found = periodic_runs(table(spark, folder, "documents"), plant=True)
    # greatest length / period, the first of equal ones; runs come by start, then period
    best = F.aggregate("runs", F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"), lambda best, run: F.when(
        best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run).otherwise(best))
    listed = F.transform("runs", lambda r: F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))))
    found = found.withColumn("best", best)
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(listed, lambda line: F.concat(line, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


@query("op11_ranked_search", r"""
    WITH low AS (
      SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
    size AS (SELECT count(*) AS n, sum(len(t))::BIGINT AS l FROM low WHERE len(t) > 0),
    tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM low) GROUP BY r, term),
    weight AS (SELECT term, floor(1000 * ln((2 * max(n) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, size GROUP BY term),
    items AS (
      SELECT row_number() OVER () AS i, item_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM (SELECT DISTINCT item_id, text FROM benchmark)),
    asked AS (SELECT i, term, count(*) AS times FROM (SELECT i, unnest(t) AS term FROM items) GROUP BY i, term),
    m AS (SELECT r, 100 - 75 + ((75 * len(t)::BIGINT * n) // l) AS m FROM low, size WHERE len(t) > 0),
    score AS (
      SELECT i, r, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
      FROM asked JOIN weight USING (term) JOIN tf USING (term) JOIN m USING (r) GROUP BY i, r),
    best AS (
      SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank
      FROM score JOIN items USING (i) JOIN low USING (r) WHERE score > 0)
    SELECT item_id, rank, doc_id, score FROM best WHERE rank <= 10
""")
def op11_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    from clipwright.llm.ranked import rank_documents

    return rank_documents(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
