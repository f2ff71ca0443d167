"""URL filters: rules by host and path, and boosted trees where no rule fits.

A rule fits its host and all subdomains if the path starts with the rule's; the longest one wins.
Its verdicts are also the labels of a classifier over lexical features of the URL: length, depth,
digits, entropy, parameters, and how often URLs of the same suffix are blocked. Spark's
gradient-boosted trees learn from at most ``SAMPLE`` labelled URLs, those with the least hash; suffix
statistics cover all of them. All of it is DataFrame functions and Spark ML.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerline.llm.common import lower_ascii
from layerline.operators.scale import materialize

SAMPLE = 20_000
#: Suffix rates are shrunk by so many URLs of the overall rate.
SHRINK = 10.0


@dataclass(frozen=True)
class UrlRule:
    verdict: str  # allow or block
    target: str  # host, then path from its slash

    @property
    def host(self) -> str:
        return self.target.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.target.partition("/")[2]


#: Fixed values.
RULES = (
    UrlRule("allow", "org/"),
    UrlRule("block", "example.org/es/"),
    UrlRule("block", "example.org/en/1"),
    UrlRule("allow", "com/fr/"),
    UrlRule("block", "com/de/"),
)

AFTER_SCHEME = "(?s)^.*?://([^/?#]*)([^?#]*)"
FEATURES = (
    "f_length", "f_host_length", "f_host_labels", "f_depth", "f_path_length", "f_digits",
    "f_entropy", "f_parameters", "f_hyphens", "f_suffix_rate", "f_suffix_count",
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case (A to Z) and path; both empty without ``://`` or url."""
    body = F.coalesce(url, F.lit(""))
    return lower_ascii(F.regexp_extract(body, AFTER_SCHEME, 1)), F.regexp_extract(body, AFTER_SCHEME, 2)


def matching_rule(host: Column, path: Column, rules: tuple[UrlRule, ...]) -> tuple[Column, Column]:
    """Target and verdict of the longest rule that fits, else null."""
    target = verdict = F.when(F.lit(False), F.lit(""))
    for rule in sorted(rules, key=lambda r: -len(r.target)):
        fits = (host == rule.host) | F.endswith(host, F.lit("." + rule.host))
        fits &= F.startswith(path, F.lit(rule.path))
        target = target.when(fits, F.lit(rule.target))
        verdict = verdict.when(fits, F.lit(rule.verdict))
    return target, verdict


def _count(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def entropy(text: Column) -> Column:
    """Bits a character of the text's own character distribution."""
    size = F.length(text).cast("double")
    share = lambda c: (F.length(text) - F.length(F.replace(text, c, F.lit("")))) / size
    bits = F.aggregate(
        F.array_distinct(F.filter(F.split(text, ""), lambda c: c != "")),
        F.lit(0.0),
        lambda total, c: total - share(c) * F.log2(share(c)),
    )
    return F.when(F.length(text) > 0, bits).otherwise(0.0)


def _lexical(rows: DataFrame) -> DataFrame:
    url, host, path = F.col("_url"), F.col("host"), F.col("path")
    query = F.regexp_extract("_url", "(?s)\\?([^#]*)", 1)
    return rows.withColumns(
        {
            "f_length": F.length(url).cast("double"),
            "f_host_length": F.length(host).cast("double"),
            "f_host_labels": _count(host, ".").cast("double"),
            "f_depth": _count(path, "/").cast("double"),
            "f_path_length": F.length(path).cast("double"),
            "f_digits": F.when(F.length(url) > 0, _count(url, "0123456789") / F.length(url)).otherwise(0.0),
            "f_entropy": entropy(url),
            "f_parameters": F.when(query != "", _count(query, "&") + 1).otherwise(0).cast("double"),
            "f_hyphens": _count(url, "-_").cast("double"),
            "_suffix": F.substring_index("host", ".", -1),
        }
    )


def judge(
    pages: DataFrame,
    rules: tuple[UrlRule, ...] = RULES,
    *,
    key: str = "page_id",
    url: str = "url",
    sample: int = SAMPLE,
) -> DataFrame:
    """key, host, path, rule, verdict (allow or block), block_score of each row.

    ``block_score`` is what the classifier gives (0 to 1). A null or empty url has an empty host and path
    and is judged by the classifier like any other. Where the rules label no URL, or all alike, there
    is nothing to learn: the verdict is that label, or allow without any. Null keys and equal rows
    stay; other columns are ignored.
    """
    body = F.coalesce(F.col(url), F.lit(""))
    host, path = host_and_path(F.col(url))
    rows = pages.select(F.col(key).alias("_id"), body.alias("_url"), host.alias("host"), path.alias("path"))
    target, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    rows = _lexical(rows.withColumns({"rule": target, "_known": verdict}))
    blocked = (F.col("_known") == "block").cast("double")
    labelled = rows.where(F.col("_known").isNotNull()).withColumn("_label", blocked)
    by_suffix = materialize(
        labelled.groupBy("_suffix").agg(F.count(F.lit(1)).alias("_n"), F.sum("_label").alias("_blocked")), "url-suffixes"
    )
    total = by_suffix.agg(F.sum("_n").alias("n"), F.sum("_blocked").alias("blocked")).first()
    n, bad = int(total["n"] or 0), int(total["blocked"] or 0)
    if bad in (0, n):
        score = F.lit(1.0 if n and bad else 0.0)
        judged = rows.withColumn("block_score", score)
    else:
        overall = bad / n

        def with_suffix(frame: DataFrame) -> DataFrame:
            seen = F.coalesce("_n", F.lit(0))
            rate = (F.coalesce("_blocked", F.lit(0.0)) + SHRINK * overall) / (seen + SHRINK)
            return frame.join(by_suffix, "_suffix", "left").withColumns(
                {"f_suffix_rate": rate, "f_suffix_count": F.log1p(seen)}
            )

        gather = VectorAssembler(inputCols=list(FEATURES), outputCol="_features")
        chosen = labelled.orderBy(F.xxhash64("_url"), "_url").limit(sample)
        trees = GBTClassifier(
            featuresCol="_features", labelCol="_label",
            maxDepth=3, stepSize=0.3, seed=7, checkpointInterval=-1,
        )
        # The sample is written, so that the trees' many passes read it and not the pages.
        model = trees.fit(gather.transform(with_suffix(materialize(chosen, "url-sample").coalesce(1))))
        judged = model.transform(gather.transform(with_suffix(rows)))
        judged = judged.withColumn("block_score", vector_to_array("probability")[1])
    learnt = F.when(F.col("block_score") >= 0.5, F.lit("block")).otherwise(F.lit("allow"))
    return judged.select(
        F.col("_id").alias(key), "host", "path", "rule",
        F.coalesce("_known", learnt).alias("verdict"), "block_score",
    )
