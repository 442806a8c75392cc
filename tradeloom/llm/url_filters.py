"""Allow or block URLs: rules first, boosted trees on lexical features for the rest.

URLs that a rule decides are the labelled ones.  Gradient-boosted trees learn
from them what length, depth, digits, entropy, parameters and host suffix say,
and judge the URLs no rule fits.  Only DataFrame functions and Spark's own tree
learner are used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.plans.staging import stage

#: Rules as (verdict, host and path).
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
# Labelled URLs the trees are grown on: those with the smallest hash.
TRAIN_ROWS = 20_000
TREES = 20
DEPTH = 4
# Weight of the overall rate in the block rate of a host suffix.
SMOOTHING = 20.0
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
FEATURES = (
    "n_url", "n_host", "n_path", "depth", "labels", "digits", "host_digits", "hyphens", "entropy", "parameters", "fragment", "suffix_rate", "suffix_share",
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    text = F.coalesce(url.cast("string"), F.lit(""))
    return F.translate(F.regexp_extract(text, _PARTS, 1), _UPPER, _LOWER), F.regexp_extract(text, _PARTS, 2)


def matched_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """The longest rule whose host is the URL's or a parent of it and whose path begins the URL's; null if none."""
    found = []
    for _, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        name, slash, rest = rule.partition("/")
        here = (host == name) | host.endswith(f".{name}")
        found.append(F.when(here & path.startswith(slash + rest), F.lit(rule)))
    return F.coalesce(*found, F.lit(None).cast("string"))


def _count(text: Column, what: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(what), F.lit("")))


def _entropy(text: Column) -> Column:
    """Bits per character."""
    n = F.length(text).cast("double")
    shares = F.transform(
        F.array_distinct(F.split(text, "")),
        lambda c: (n - F.length(F.replace(text, c, F.lit(""))).cast("double")) / n,
    )
    return F.when(n > 0, F.aggregate(shares, F.lit(0.0), lambda a, p: a - F.when(p > 0, p * F.log2(p)).otherwise(F.lit(0.0)))).otherwise(F.lit(0.0))


def lexical(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """``(page_id, url, host, path, rule, label, suffix)`` and the features of the URL alone."""
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("rule", matched_rule(F.col("host"), F.col("path"), rules))
    blocked = [rule for verdict, rule in rules if verdict == "block"]
    url, query = F.col("url"), F.substring_index(F.substring_index(F.col("url"), "#", 1), "?", -1)
    n = F.greatest(F.length(url), F.lit(1))
    features = {
        "label": F.when(F.col("rule").isNotNull(), F.col("rule").isin(blocked).cast("double")),
        "suffix": F.substring_index("host", ".", -1),
        "n_url": F.length(url),
        "n_host": F.length("host"),
        "n_path": F.length("path"),
        "depth": _count(F.col("path"), "/"),
        "labels": _count(F.col("host"), "."),
        "digits": F.regexp_count(url, F.lit("[0-9]")) / n,
        "host_digits": F.regexp_count("host", F.lit("[0-9]")),
        "hyphens": _count(url, "-"),
        "entropy": _entropy(url),
        "parameters": F.when(url.contains("?"), _count(query, "&") + 1).otherwise(F.lit(0)),
        "fragment": url.contains("#"),
    }
    numeric = {k: (v if k in ("label", "suffix") else v.cast("double")) for k, v in features.items()}
    return rows.withColumns(numeric)


def _with_suffix_rates(rows: DataFrame, rates: DataFrame, overall: float) -> DataFrame:
    joined = rows.join(rates, "suffix", "left")
    seen = F.coalesce(F.col("_seen"), F.lit(0.0))
    rate = (F.coalesce(F.col("_blocked"), F.lit(0.0)) + F.lit(SMOOTHING * overall)) / (seen + F.lit(SMOOTHING))
    return joined.withColumn("suffix_rate", rate).withColumn("suffix_share", F.log1p(seen)).drop("_seen", "_blocked")


def judged(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """``(page_id, host, path, rule, verdict, block_score)``: one row per row of ``pages``.

    A null URL or one without ``://`` has empty host and path, so no rule, and
    is judged on its features as any other.  Where the rules label no URL, or
    all alike, the method gives that label (``allow`` if there is none).
    """
    rows = stage(lexical(pages, rules), "urls")
    labelled = rows.where(F.col("label").isNotNull())
    totals = labelled.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("label"), F.lit(0.0)).alias("blocked")).first()
    columns = ["page_id", "host", "path", "rule"]
    said = F.when(F.col("label") == 1.0, F.lit("block")).when(F.col("label") == 0.0, F.lit("allow"))
    if totals.blocked in (0.0, float(totals.n)):
        score = 1.0 if totals.n and totals.blocked else 0.0
        return rows.select(*columns, F.coalesce(said, F.lit("block" if score else "allow")).alias("verdict"), F.lit(score).alias("block_score"))

    rates = labelled.groupBy("suffix").agg(F.count(F.lit(1)).cast("double").alias("_seen"), F.sum("label").alias("_blocked"))
    full = _with_suffix_rates(rows, rates, totals.blocked / totals.n).drop("suffix")
    assembled = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(full)
    chosen = assembled.where(F.col("label").isNotNull()).select("features", "label", F.xxhash64("url").alias("draw"))
    training = stage(chosen.orderBy("draw").limit(TRAIN_ROWS).select("features", "label"), "labelled-urls")
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, seed=7, maxBins=64).fit(training)
    scored = model.transform(assembled).withColumn("block_score", vector_to_array("probability")[1])
    own = F.when(F.col("block_score") > 0.5, F.lit("block")).otherwise(F.lit("allow"))
    return scored.select(*columns, F.coalesce(said, own).alias("verdict"), "block_score")
