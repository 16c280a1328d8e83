"""URL filter: host rules first, gradient-boosted trees on lexical features for the rest.

Everything runs in the JVM: features are SQL expressions, the trees are trained
and applied by Spark's own library.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import col, fresh, with_columns


class Rule(NamedTuple):
    """`verdict` for a host with its subdomains and paths that start with `path`."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return f"{self.host}{self.path}"


# Fixed values of the contract.
RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)

#: Labelled URLs that training reads at most.
TRAIN_ROWS = 20_000
#: A suffix or first path segment counts as much as this many rows of the mean.
PRIOR_ROWS = 20.0

NUMERIC = [
    "url_length", "host_length", "path_length", "depth", "host_labels", "digit_ratio", "host_digit_ratio",
    "host_hyphens", "entropy", "host_entropy", "n_params", "query_length", "has_fragment", "is_https",
    "suffix_rate", "segment_rate",
]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first "://" up to "/", "?", "#" or the end, A-Z lower-cased; "" without "://" or for NULL."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to "?", "#" or the end."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    return F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def _fits(rule: Rule, host: Column, path: Column) -> Column:
    return ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)


def rule_for(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """(rule, verdict) of the longest rule that fits, longest host and path together; NULL if none does.

    The rule list is a setting, checked one after the other in generated code.
    """
    ordered = sorted(rules, key=lambda r: (-len(r.name), r.name))
    out = None
    for r in ordered:
        hit = F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict"))
        out = F.when(_fits(r, host, path), hit) if out is None else out.when(_fits(r, host, path), hit)
    if out is None:
        return F.lit(None).cast("struct<rule:string,verdict:string>")
    return out


def _entropy(text: Column) -> Column:
    """Shannon entropy of the characters, in bits."""
    n = F.length(text).cast("double")

    def part(c: Column) -> Column:
        p = (n - F.length(F.replace(text, c, F.lit("")))) / n
        return -p * F.log2(p)

    each = F.transform(F.array_distinct(F.filter(F.split(text, ""), lambda c: c != "")), part)
    return F.coalesce(F.aggregate(each, F.lit(0.0), lambda a, x: a + x), F.lit(0.0))


def _ratio(text: Column, pattern: str) -> Column:
    n = F.length(text)
    return F.when(n > 0, (n - F.length(F.regexp_replace(text, pattern, ""))) / n).otherwise(F.lit(0.0))


def features(urls: DataFrame, url: str) -> DataFrame:
    """Add `host`, `path`, `suffix`, `segment` and the numeric features but the two rates.

    The suffix is the last two labels of the host, the segment the first part
    of the path. A NULL or empty URL has empty parts and zero features.
    """
    u = F.coalesce(col(url), F.lit(""))
    host, path = host_of(col(url)), path_of(col(url))
    query = F.regexp_extract(u, r"^[^?#]*\?([^#]*)", 1)
    df = with_columns(urls, {"host": host, "path": path})
    h, p = F.col("host"), F.col("path")
    return with_columns(
        df,
        {
            "suffix": F.regexp_extract(h, r"[^.]*(\.[^.]*)?$", 0),
            "segment": F.regexp_extract(p, r"^/([^/]*)/", 1),
            "url_length": F.length(u).cast("double"),
            "host_length": F.length(h).cast("double"),
            "path_length": F.length(p).cast("double"),
            "depth": (F.length(p) - F.length(F.replace(p, F.lit("/"), F.lit("")))).cast("double"),
            "host_labels": F.size(F.split(h, r"\.")).cast("double"),
            "digit_ratio": _ratio(u, "[0-9]").cast("double"),
            "host_digit_ratio": _ratio(h, "[0-9]").cast("double"),
            "host_hyphens": (F.length(h) - F.length(F.replace(h, F.lit("-"), F.lit("")))).cast("double"),
            "entropy": _entropy(u),
            "host_entropy": _entropy(h),
            "n_params": F.when(query == "", F.lit(0.0)).otherwise(F.size(F.split(query, "&")).cast("double")),
            "query_length": F.length(query).cast("double"),
            "has_fragment": F.contains(u, F.lit("#")).cast("double"),
            "is_https": u.startswith("https://").cast("double"),
        },
    )


class UrlModel(NamedTuple):
    """Trees with the rates of suffixes and segments that training saw; None where one verdict only was labelled."""

    trees: GBTClassificationModel | None
    suffix_rates: dict[str, float]
    segment_rates: dict[str, float]
    prior: float


def _rate(value: Column, rates: dict[str, float], prior: float) -> Column:
    """A lookup in at most `TRAIN_ROWS` rates, as a literal map."""
    if not rates:
        return F.lit(prior)
    table = F.create_map(*(F.lit(x) for item in sorted(rates.items()) for x in item))
    return F.coalesce(F.element_at(table, value), F.lit(prior))


def _assembled(df: DataFrame, model: UrlModel, vector: str) -> DataFrame:
    df = with_columns(
        df,
        {
            "suffix_rate": _rate(F.col("suffix"), model.suffix_rates, model.prior),
            "segment_rate": _rate(F.col("segment"), model.segment_rates, model.prior),
        },
    )
    return VectorAssembler(inputCols=NUMERIC, outputCol=vector).transform(df)


def train(labelled: DataFrame, url: str = "url", label: str = "label", rows: int = TRAIN_ROWS, iterations: int = 20, depth: int = 4) -> UrlModel:
    """Fit on at most `rows` distinct labelled URLs (label 1: block), those with the least hash.

    Rows with a NULL URL or label don't count. Suffix and segment rates are
    block shares shrunk to the mean; both tables are bounded by the sample.
    """
    known = labelled.select(col(url).alias("url"), col(label).cast("double").alias("label")).dropna()
    sample = known.distinct().orderBy(F.xxhash64("url"), "url", "label").limit(rows)
    sample = features(sample, "url").cache()
    n, mean = sample.agg(F.count("label"), F.avg("label")).first()
    if not n or mean in (0.0, 1.0):
        sample.unpersist()
        return UrlModel(None, {}, {}, float(mean or 0.0))

    def rates(by: str) -> dict[str, float]:
        shrunk = (F.sum("label") + PRIOR_ROWS * mean) / (F.count("label") + PRIOR_ROWS)
        return {r[0]: r[1] for r in sample.groupBy(by).agg(shrunk).collect()}

    model = UrlModel(None, rates("suffix"), rates("segment"), float(mean))
    ready = _assembled(sample, model, "__features")
    trees = GBTClassifier(featuresCol="__features", labelCol="label", maxIter=iterations, maxDepth=depth, seed=7, cacheNodeIds=False)
    fitted = trees.fit(ready)
    sample.unpersist()
    return model._replace(trees=fitted)


def filter_urls(pages: DataFrame, model: UrlModel, rules: Sequence[Rule] = RULES, url: str = "url") -> DataFrame:
    """Add `host`, `path`, `rule`, `verdict` and `block_score`; no shuffle, no row dropped.

    The longest fitting rule decides, else the trees: block at a score of 0.5
    or more. A NULL or empty URL, or one without "://", has empty parts and is
    judged by the trees like any other. `block_score` is the model's and is
    NULL where one verdict only was labelled; the verdict is then that one.
    Input columns named like new ones are replaced.
    """
    base = [c for c in pages.columns if c.lower() not in {"host", "path", "rule", "verdict", "block_score"}]
    payload, address = fresh(pages.select(*map(col, base)), "__row", "__url")
    packed = pages.select(F.struct(*map(col, base)).alias(payload), col(url).alias(address))
    df = features(packed, address)
    if model.trees is None:
        score, fallback = F.lit(None).cast("double"), F.lit("block" if model.prior >= 0.5 else "allow")
    else:
        from pyspark.ml.functions import vector_to_array

        df = model.trees.setPredictionCol("__prediction").setProbabilityCol("__probability").setRawPredictionCol("__raw").transform(_assembled(df, model, "__features"))
        score = vector_to_array(F.col("__probability"))[1]
        fallback = F.when(score >= 0.5, F.lit("block")).otherwise(F.lit("allow"))
    hit = rule_for(F.col("host"), F.col("path"), rules)
    return df.select(
        *(F.col(payload)[c].alias(c) for c in base),
        "host",
        "path",
        hit["rule"].alias("rule"),
        F.coalesce(hit["verdict"], fallback).alias("verdict"),
        score.alias("block_score"),
    )
