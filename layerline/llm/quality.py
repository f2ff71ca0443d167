"""Quality rules: counts of each text, and a verdict on whole hosts.

Each document is counted in its own row. Documents that break the base rule are counted by host;
a host's failure rate is shrunk towards the corpus with a beta prior whose two parameters are fitted
to all hosts (method of moments), so a few bad documents do not condemn a small host. Documents of a
host whose shrunk rate is above ``most_failing`` go with it. All of it is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerline.llm.common import SPACE
from layerline.operators.scale import fits_broadcast, materialize

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\x0b\x0c\r"
LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20
MOST_FAILING = 0.5
WINDOW = 5
#: The prior weighs as much as so many documents, at least and at most.
PRIOR_RANGE = (2.0, 1e6)

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _window_hash(hashes: str, at: Column) -> Column:
    return F.xxhash64(*[F.col(hashes)[at + i] for i in range(WINDOW)])


def text_counts(rows: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """The five counts of each text, besides the columns of ``keep``.

    Repeated words: windows are compared by hash first; equal windows have equal hashes, so a text
    whose hashes all differ has no repeat. Only for the others are the windows sorted as strings.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    hashed = (
        rows.select(*keep, body.alias("_body"))
        .withColumn("_words", F.filter(F.split("_body", SPACE), lambda w: w != ""))
        .withColumn(
            "_lines",
            F.filter(F.split("_body", "\n"), lambda line: F.translate(line, BLANKS, "") != ""),
        )
        .withColumn("_n", F.size("_words"))
        .withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
        .withColumn("_starts", F.when(F.col("_n") >= WINDOW, F.sequence(F.lit(0), F.col("_n") - WINDOW)))
        .withColumn("_windows", F.transform("_starts", lambda i: _window_hash("_hashes", i)))
    )
    repeats = F.size("_windows") > F.size(F.array_distinct("_windows"))
    ordered = hashed.withColumn(
        "_sorted",
        F.when(
            repeats,
            F.sort_array(
                F.transform(
                    "_starts",
                    lambda i: F.struct(
                        F.concat_ws(" ", F.slice("_words", i + 1, WINDOW)).alias("w"), i.alias("i")
                    ),
                )
            ),
        ),
    )

    def shared(pair: Column, k: Column) -> Column:
        # get() gives null outside the array, where there is no neighbour
        before = F.when(k > 0, F.get(F.col("_sorted"), k - 1)["w"] == pair["w"])
        after = F.get(F.col("_sorted"), k + 1)["w"] == pair["w"]
        return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

    places = F.sort_array(F.transform(F.filter("_sorted", shared), lambda pair: pair["i"]))
    covered = F.aggregate(
        places,
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("total")),
        lambda seen, at: F.struct(
            at.alias("last"), (seen["total"] + F.least(F.lit(WINDOW), at - seen["last"])).alias("total")
        ),
    )["total"]
    return ordered.select(
        *keep,
        F.col("_n").cast("long").alias("n_words"),
        F.length(F.regexp_replace("_body", SPACE, "")).cast("long").alias("word_chars"),
        (F.length("_body") - F.length(F.translate("_body", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def base_rule() -> Column:
    """Too few words, or too many in repeated windows."""
    return (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    )


def host_verdicts(rows: DataFrame, host: str, failed: str, most_failing: float = MOST_FAILING) -> DataFrame:
    """host, documents, failures, shrunk_rate, rejected; null hosts are not judged."""
    hosts = rows.where(F.col(host).isNotNull()).groupBy(host).agg(
        F.count(F.lit(1)).alias("documents"), F.sum(F.col(failed).cast("long")).alias("failures")
    )
    n, bad = F.col("documents"), F.col("failures")
    sums = hosts.agg(
        F.count(F.lit(1)).alias("hosts"),
        F.sum(n).alias("n"),
        F.sum(bad).alias("bad"),
        F.sum(n.cast("double") * n).alias("squares"),
        F.sum(bad.cast("double") * bad / n).alias("spread"),
    ).first()
    mean, weight = 0.5, PRIOR_RANGE[0]
    if sums["n"]:
        mean = sums["bad"] / sums["n"]
        within = mean * (1 - mean)
        between = sums["spread"] - sums["n"] * mean * mean - (sums["hosts"] - 1) * within
        scale = sums["n"] - sums["squares"] / sums["n"]
        variance = between / scale if scale > 0 else 0.0
        weight = within / variance - 1 if variance > 0 else PRIOR_RANGE[1]
        weight = min(max(weight, PRIOR_RANGE[0]), PRIOR_RANGE[1])
    rate = (bad + F.lit(mean * weight)) / (n + F.lit(weight))
    return hosts.withColumn("shrunk_rate", rate).withColumn("rejected", F.col("shrunk_rate") > most_failing)


def judge(
    documents: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    host: str = "source",
    most_failing: float = MOST_FAILING,
) -> DataFrame:
    """key, the five counts, base_failed, kept, host and text_hash of each row.

    A null or empty text has no words and fails the base rule. A null host is not judged; its
    documents stand for themselves. Null keys and equal rows stay, one result each; an empty
    table gives no rows. Other columns are ignored. ``text_hash`` (xxhash64) tells
    rows of one key apart.
    """
    rows = documents.select(
        F.col(key).alias("_key"),
        F.col(host).alias("_host"),
        F.xxhash64(text).alias("_text_hash"),
        F.col(text).alias("_text"),
    )
    counted = text_counts(rows, "_text", ["_key", "_host", "_text_hash"])
    counted = materialize(counted.withColumn("base_failed", base_rule()), "quality-counts")
    # Only the condemned hosts are joined, by broadcast if measured small; else Spark's skew join
    # splits a hot host.
    condemned = (
        host_verdicts(counted, "_host", "base_failed", most_failing)
        .where("rejected")
        .select(F.col("_host"), F.lit(True).alias("_rejected"))
    )
    condemned = F.broadcast(condemned) if fits_broadcast(condemned) else condemned
    return counted.join(condemned, "_host", "left").select(
        F.col("_key").alias(key),
        *COUNTS,
        "base_failed",
        (~F.col("base_failed") & F.col("_rejected").isNull()).alias("kept"),
        F.col("_host").alias(host),
        F.col("_text_hash").alias("text_hash"),
    )
