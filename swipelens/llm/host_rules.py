"""Quality rules per document and per host, in DataFrame functions only.

A document fails by its own text (``base_failed``). Hosts then answer for their documents:
failures are counted per host, each host's failure rate is shrunk towards the rate of all
hosts by a beta prior whose strength is estimated from the spread between hosts, and a host
whose shrunken rate is above ``max_rate`` takes all its documents with it.

Edge cases: a null or blank text has no words, so it fails; a document without a host is
judged by its own text only; repeated rows are judged one by one; an empty table gives an
empty result. Further columns pass through. Input columns named like a result column are
replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swipelens.llm.common import GAP_CHARS, free_names, whole, words
from swipelens.session import materialize
from swipelens.sizing import broadcast_if_small

MIN_WORDS = 50
#: Percent of the words that may lie in repeated three-word windows.
MAX_REPEAT_PERCENT = 50
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 3

METRICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _by_hash(hashes: Column) -> Column:
    """Window hashes with their positions, equal hashes side by side."""
    return F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))


def document_metrics(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the five metrics and ``base_failed``. No shuffle: each row is judged alone.

    Windows are compared by a 64-bit hash. Texts in which no hash repeats skip the sort.
    """
    kept = [c for c in df.columns if c not in (*METRICS, "base_failed")]
    body = whole(text)
    lines = F.filter(F.split(body, "\n"), lambda line: F.btrim(line, F.lit(GAP_CHARS)) != "")
    # Packed, so that no column of the input meets a name in here.
    doc = "_doc"
    step = df.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias(doc),
        words(text).alias("_words"),
        lines.alias("_lines"),
        (F.length(body) - F.length(F.regexp_replace(body, SYMBOLS, ""))).cast("long").alias("n_symbols"),
    )
    w = F.col("_words")
    window_hashes = F.when(
        F.size(w) >= WINDOW,
        F.transform(
            F.sequence(F.lit(0), F.size(w) - WINDOW), lambda i: F.xxhash64(*[w[i + k] for k in range(WINDOW)])
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    step = step.select(
        doc, "n_symbols",
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        window_hashes.alias("_hashes"),
    )
    step = step.withColumn(
        "_sorted",
        F.when(F.size(F.array_distinct("_hashes")) < F.size("_hashes"), _by_hash(F.col("_hashes"))),
    )
    near = F.col("_sorted")
    twice = F.filter(
        near,
        lambda x, i: x["h"].eqNullSafe(F.get(near, i - 1)["h"]) | x["h"].eqNullSafe(F.get(near, i + 1)["h"]),
    )
    step = step.withColumn("_starts", F.sort_array(F.transform(twice, lambda x: x["i"])))
    # A window covers three words, less those that the window before it has covered.
    covered = F.aggregate(
        "_starts",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last")),
        lambda acc, p: F.struct((acc["n"] + F.least(F.lit(WINDOW), p - acc["last"])).alias("n"), p.alias("last")),
        lambda acc: acc["n"],
    )
    step = step.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long")))
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    return step.select(f"{doc}.*", *METRICS, failed.alias("base_failed"))


@dataclass(frozen=True)
class BetaPrior:
    """Failure rate of all hosts, and how many documents' worth of weight it has."""

    rate: float
    strength: float

    @classmethod
    def fit(cls, hosts: DataFrame) -> "BetaPrior":
        """Moments over hosts (columns ``n``, ``failed``). One row reaches the driver.

        The variance between hosts is what is left of the spread of the rates after the
        variance expected from counting. Without any, all hosts share one rate.
        """
        n, x = F.col("n").cast("double"), F.col("failed").cast("double")
        row = hosts.agg(
            F.count(F.lit(1)).alias("k"), F.sum(n).alias("n"), F.sum(x).alias("x"),
            F.sum(n * n).alias("nn"), F.sum(x * x / n).alias("xx"),
        ).first()
        if not row["k"]:
            return cls(0.0, 1.0)
        total, rate = row["n"], row["x"] / row["n"]
        binomial = rate * (1 - rate)
        spread = row["xx"] - total * rate * rate
        room = total - row["nn"] / total
        between = (spread - binomial * (row["k"] - 1)) / room if room > 0 else 0.0
        if between <= 0 or binomial <= 0:
            return cls(rate, total)
        return cls(rate, min(total, max(1.0, binomial / between - 1)))


def host_verdicts(metrics: DataFrame, host: str, max_rate: float) -> DataFrame:
    """One row per host: counts, shrunken failure rate, and whether the host is rejected."""
    hosts = metrics.where(F.col(host).isNotNull()).groupBy(F.col(host).alias("_host")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("base_failed").cast("long")).alias("failed")
    )
    hosts = materialize(hosts)
    prior = BetaPrior.fit(hosts)
    rate = (F.col("failed") + prior.rate * prior.strength) / (F.col("n") + F.lit(prior.strength))
    return hosts.withColumns({"host_rate": rate, "host_rejected": rate > max_rate})


def quality_rules(
    df: DataFrame, text: str = "text", host: str = "source", max_rate: float = 0.5, keep_text: bool = True
) -> DataFrame:
    """Metrics, ``base_failed``, ``host_rate`` and ``kept`` for every row.

    The measured rows are written once to the shared folder, without the text unless
    ``keep_text``: the texts are read and split once, and the join with the hosts moves
    what is asked for only. The host counts are summed on the map side. The verdicts are
    broadcast only below a counted bound; beyond it both sides are shuffled and Spark
    splits a host that holds much of the table.
    """
    measured = document_metrics(df, text).drop("host_rate", "kept")
    if not keep_text:
        measured = measured.drop(text)
    measured = materialize(measured)
    key, rejected = free_names(measured, "host", "host_rejected")
    verdicts = broadcast_if_small(
        host_verdicts(measured, host, max_rate).select(F.col("_host").alias(key), "host_rate", F.col("host_rejected").alias(rejected))
    )
    judged = measured.join(verdicts, measured[host] == verdicts[key], "left")
    kept = ~F.col("base_failed") & ~F.coalesce(rejected, F.lit(False))
    return judged.withColumn("kept", kept).drop(key, rejected)
