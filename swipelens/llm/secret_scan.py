"""Secrets in whole texts, found with a trigram inverted index. DataFrame functions only.

From each rule's expression a Boolean trigram query is derived (``trigrams``). The index holds
postings (trigram, text) for the trigrams that some query asks for; texts are named by their
64-bit hash, so equal texts have one entry, and a chance collision could only add a candidate.
Clauses intersect postings by the bits of their trigrams that a text has; every candidate is
then verified with the expression. A rule without mandatory trigrams scans all texts.

Spans are in code points, end exclusive, leftmost and non-overlapping per kind: what lies
between matches and the matches themselves follow each other, so their lengths give positions.

Edge cases: a null text is the empty text and has no spans. Repeated rows give repeated
results. An empty table gives an empty result. Further columns pass through; input columns
named like a result column are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swipelens.llm.common import free_names, whole
from swipelens.llm.trigrams import ANY, trigram_query
from swipelens.session import materialize
from swipelens.sizing import broadcast_if_small


@dataclass(frozen=True)
class Rule:
    """``least`` is the length that ``group`` of a match must have for the match to count."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# Kinds, patterns and least lengths that the results are defined by.
BASE_RULES = (
    Rule(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2, least=8,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=16),
    Rule("hex", r"[0-9a-f]{32,}", least=32),
)

# Published formats of widespread credentials.
FORMAT_RULES = (
    Rule("github", r"gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULES = BASE_RULES + FORMAT_RULES
MASK = "[SECRET]"

_KEY = "_text_key"
RESULTS = ["n_assign", "n_access", "n_hex", "base_sha256", "spans"]


def _clauses(rules: tuple[Rule, ...]) -> list[tuple[int, int, str, int, int]]:
    """(rule bit, clause, trigram, bit of the trigram in the clause, bits of the clause)."""
    rows, number = [], 0
    for at, rule in enumerate(rules):
        query = trigram_query(rule.pattern)
        for clause in sorted(map(sorted, query if query != ANY else [])):
            if len(clause) > 62:
                clause = clause[:62]
            rows += [(1 << at, number, t, 1 << i, (1 << len(clause)) - 1) for i, t in enumerate(clause)]
            number += 1
    return rows


def full_scans(rules: tuple[Rule, ...]) -> int:
    """Bits of the rules that no trigram can narrow down."""
    return sum(1 << i for i, rule in enumerate(rules) if trigram_query(rule.pattern) == ANY)


def postings(df: DataFrame, rules: tuple[Rule, ...], text: str = "text") -> DataFrame:
    """The inverted index: columns ``trigram`` and the text's key, for the trigrams asked for."""
    asked = sorted({row[2] for row in _clauses(rules)})
    lowered = df.select(F.xxhash64(whole(text)).alias(_KEY), F.lower(whole(text)).alias("_low"))
    found = F.array_compact(F.array(*[F.when(F.contains("_low", F.lit(t)), F.lit(t)) for t in asked]))
    return lowered.select(_KEY, F.explode(found).alias("trigram"))


def candidates(index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Per text with any candidate: ``_rules``, the bits of the rules that may match.

    The clauses are as many as the rules spell out, so they are broadcast. Bits are combined
    on the map side: a common trigram, or a text with many copies, costs one row per task.
    """
    spark = index.sparkSession
    asked = spark.createDataFrame(_clauses(rules), "rule BIGINT, clause INT, trigram STRING, bit BIGINT, mask BIGINT")
    return (
        index.join(F.broadcast(asked), "trigram")
        .groupBy(_KEY, "rule", "clause", "mask").agg(F.bit_or("bit").alias("bits"))
        .where("bits = mask")
        .groupBy(_KEY).agg(F.bit_or("rule").alias("_rules"))
    )


def _spans(text: Column, rule: Rule, order: int) -> Column:
    """Array of (start, order, end, kind) of the matches of one rule."""
    pattern = F.lit(rule.pattern)
    between = F.transform(F.split(text, rule.pattern), F.length)
    lengths = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.length)
    sizes = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.length) if rule.group else lengths
    # Both arrays run along the text; the last gap follows the last match.
    steps = F.zip_with(between, lengths, lambda gap, hit: F.struct(gap.alias("gap"), hit.alias("hit")))
    placed = F.aggregate(
        steps,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out")),
        lambda acc, s: F.struct(
            (acc["at"] + s["gap"] + F.coalesce(s["hit"], F.lit(0))).alias("at"),
            F.when(s["hit"].isNull(), acc["out"]).otherwise(
                F.array_append(
                    acc["out"],
                    F.struct(
                        (acc["at"] + s["gap"]).alias("start"), (acc["at"] + s["gap"] + s["hit"]).alias("end")
                    ),
                )
            ).alias("out"),
        ),
        lambda acc: acc["out"],
    )
    valid = F.filter(
        F.arrays_zip(placed.alias("span"), sizes.alias("size")), lambda x: x["size"] >= rule.least
    )
    return F.transform(
        valid,
        lambda x: F.struct(
            x["span"]["start"].alias("start"), F.lit(order).alias("order"), x["span"]["end"].alias("end"),
            F.lit(rule.kind).alias("kind"),
        ),
    )


def _listed(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def scan(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Add ``found``: the spans of all rules, by start and then in the order of the rules.

    The texts are read twice, for the index and to verify, and never shuffled while the
    candidates are below a counted bound; beyond it texts and candidates are joined by key.
    """
    empty = F.array().cast("array<struct<start:int,order:int,end:int,kind:string>>")
    key, named = free_names(df, _KEY, "_rules")
    chosen = broadcast_if_small(materialize(candidates(postings(df, rules, text), rules).toDF(key, named)))
    always = full_scans(rules)
    keyed = df.drop("found").withColumn(key, F.xxhash64(whole(text))).join(chosen, key, "left")
    mask = F.coalesce(named, F.lit(0).cast("bigint")).bitwiseOR(F.lit(always))
    body = whole(text)
    spans = [
        F.when(
            (mask.bitwiseAND(F.lit(1 << i)) != 0) & body.rlike(rule.pattern), _spans(body, rule, i)
        ).otherwise(empty)
        for i, rule in enumerate(rules)
    ]
    return keyed.withColumn("found", F.array_sort(F.concat(*spans))).drop(key, named)


def report(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, the digest of the base spans and the list of all spans."""
    kept = [c for c in found.columns if c not in RESULTS]
    base = F.filter("found", lambda s: s["order"] < len(BASE_RULES))

    def count(order: int) -> Column:
        return F.size(F.filter("found", lambda s: s["order"] == order)).cast("long")

    counts = [count(i).alias(f"n_{rule.kind}") for i, rule in enumerate(BASE_RULES)]
    return found.select(
        *kept, *counts, F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("found")).alias("spans")
    )


def redact(found: DataFrame, text: str = "text", mask: str = MASK) -> DataFrame:
    """Replace every span by ``mask``; spans that overlap are replaced as one.

    A text without spans is left as it is, null included.
    """
    merged = F.aggregate(
        "found",
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.when(s["end"] <= acc["at"], acc).otherwise(
            F.struct(
                s["end"].alias("at"),
                F.when(
                    s["start"] < acc["at"], acc["out"]
                ).otherwise(
                    F.concat(
                        acc["out"], F.substring(F.col(text), acc["at"] + 1, s["start"] - acc["at"]), F.lit(mask)
                    )
                ).alias("out"),
            )
        ),
    )
    (step,) = free_names(found, "merged")
    clean = F.concat(
        F.col(f"{step}.out"), F.substring(F.col(text), F.col(f"{step}.at") + 1, F.length(F.col(text)))
    )
    return found.withColumn(step, F.when(F.size("found") > 0, merged)).withColumn(
        text, F.when(F.col(step).isNull(), F.col(text)).otherwise(clean)
    ).drop("found", step)
