"""URL filter: block and allow rules first, boosted trees on lexical features for what no rule decides.

Everything here is DataFrame work and MLlib's boosting; no Python runs in a task.  URLs that a rule decides are the
labelled ones.  Suffix statistics (the share of blocked URLs per last host label and per last two) are counted over
all of them; the trees are fitted on at most ``train_rows`` of them, those with the smallest hash of the URL, and
judge every URL without a rule.

Defined results: a null URL or one without ``://`` has an empty host and path and is judged like any other text; of
rules of equal length the first of the list wins; repeated rows and null ids give a row each; without a single
labelled URL everything undecided is allowed; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipwright.llm.common import lower_ascii, written

#: (verdict, host, path); a rule's name is host and path joined.
Rule = tuple[str, str, str]
FEATURES = ["length", "host_length", "labels", "depth", "digits", "hyphens", "entropy", "parameters", "fragment",
            "secure", "suffix_rate", "suffix_log_count", "domain_rate"]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path of a URL; both empty for null or without ``://``."""
    known = F.coalesce(url.contains("://"), F.lit(False))
    rest = F.when(known, F.expr("substring(_u, locate('://', _u) + 3)")).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return lower_ascii(host), path


def rule_of(rules: Sequence[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, null if none does."""
    name = verdict = None
    for kind, rule_host, rule_path in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        text, said = F.lit(rule_host + rule_path), F.lit(kind)
        name = F.when(fits, text) if name is None else name.when(fits, text)
        verdict = F.when(fits, said) if verdict is None else verdict.when(fits, said)
    if name is None:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    return name, verdict


def _occurrences(text: Column, what: str) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(what), F.lit("")))).cast("double")


def _lexical(df: DataFrame) -> DataFrame:
    url, host, path = F.col("_u"), F.col("host"), F.col("path")
    size = F.greatest(F.length(url), F.lit(1)).cast("double")
    digits = F.length(F.regexp_replace(url, "[^0-9]", "")).cast("double")
    share = lambda c: (F.length(url) - F.length(F.replace(url, c, F.lit("")))) / size
    entropy = F.aggregate(F.array_distinct(F.split(url, "")), F.lit(0.0),
                          lambda a, c: a - F.when((c != "") & (share(c) > 0), share(c) * F.log2(share(c))).otherwise(0.0))
    return df.withColumns({
        "length": F.length(url).cast("double"), "host_length": F.length(host).cast("double"),
        "labels": _occurrences(host, ".") + 1, "depth": _occurrences(path, "/"), "digits": digits / size,
        "hyphens": _occurrences(host, "-"), "entropy": entropy,
        "parameters": _occurrences(url, "&") + F.contains(url, F.lit("?")).cast("double"),
        "fragment": F.contains(url, F.lit("#")).cast("double"), "secure": F.startswith(url, F.lit("https:")).cast("double"),
        "suffix": F.substring_index(host, ".", -1), "domain": F.substring_index(host, ".", -2),
    })


def _with_rates(df: DataFrame, labelled: DataFrame) -> DataFrame:
    """Smoothed share of blocked URLs of the host's last label and last two labels."""
    blocked = F.sum("label")
    for key in ("suffix", "domain"):
        counts = labelled.groupBy(key).agg(((blocked + 1) / (F.count("*") + 2)).alias(f"{key}_rate"),
                                           F.log1p(F.count("*")).alias(f"{key}_log_count"))
        df = df.join(counts, key, "left").fillna({f"{key}_rate": 0.5, f"{key}_log_count": 0.0})
    return df


def judge_urls(pages: DataFrame, rules: Sequence[Rule], train_rows: int = 20_000, trees: int = 10, depth: int = 4,
               id_column: str = "page_id", url_column: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict, score) of every page; score is the trees' probability of ``block``."""
    urls = pages.select(F.col(id_column).alias("_id"), F.coalesce(F.col(url_column).cast("string"), F.lit("")).alias("_u"))
    host, path = host_and_path(F.col("_u"))
    urls = urls.withColumns({"host": host, "path": path})
    name, verdict = rule_of(rules, F.col("host"), F.col("path"))
    urls = written(_lexical(urls.withColumns({"rule": name, "said": verdict})), "urls")

    label = (F.col("said") == "block").cast("double")
    labelled = urls.filter(F.col("said").isNotNull()).withColumn("label", label)
    # only the trees' training rows are bounded: a shuffle-free top list by a hash of the URL
    sample = labelled.orderBy(F.xxhash64("_u"), "_u").limit(train_rows)
    sample = written(_with_rates(sample, labelled), "url-sample")
    result = _with_rates(urls, labelled)
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    if sample.isEmpty():
        score = result.withColumn("score", F.lit(0.0))
    else:
        model = GBTClassifier(maxIter=trees, maxDepth=depth, seed=7, stepSize=0.3).fit(
            assembler.transform(sample).select("features", "label"))
        score = model.transform(assembler.transform(result))
        score = score.withColumn("score", F.get(vector_to_array("probability"), F.lit(1)))
    method = F.when(F.col("score") > 0.5, "block").otherwise("allow")
    return score.select(F.col("_id").alias(id_column), "host", "path", "rule",
                        F.coalesce("said", method).alias("verdict"), "score")

