"""Mix sources to target weights. DataFrame functions only.

Sources share ``share`` times all words by weight; a target stops at ``most`` times its
source's words and the excess is shared again by weight among the rest. All rows are sorted
once by (source, hash key) with a range partitioning, so one source may hold most of the
table. Prefix sums over that order give each row's place within its source; each source is
passed as often as its budget allows in full, and cut at the exact word in the last pass.

A row then needs only its key and its source's cut to know how much of it is taken, so texts
are neither sorted nor shuffled. Keys depend on seed and id alone: a rerun takes the same.

Edge cases: a null source is a source of its own, last in order. A null or blank text has
size 0 and is never taken. Repeated rows and null ids are rows of their own, told apart by a
row number that is written with them. An empty table gives an empty result. Further columns
pass through; input columns named like a result column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swipelens.llm.common import free_names, words
from swipelens.operators.ordering import running_totals, with_position
from swipelens.session import materialize
from swipelens.sizing import broadcast_if_small

WEIGHTS = (5, 2, 1)
SHARE = (3, 2)
MOST = 2
SEED = 42

RESULTS = ["size", "source_size", "target", "taken"]
_KEY, _ROW = "_mix_key", "_mix_row"


def hash_key(id_col: str, seed: int) -> Column:
    """Sixty hash bits of seed and id, as a long; the same in every engine that has MD5."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(named), 1, 15), 16, 10).cast("bigint")


def targets(
    sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: tuple[int, int] = SHARE, most: int = MOST
) -> DataFrame:
    """Add ``weight`` and ``target`` to a table of (source, source_size), one row per source.

    A source reaches its cap if the sources with a smaller ratio of cap to weight, it among
    them, at their caps, and the others at its ratio, do not need more than there is. The
    sums are exact; one row reaches the driver.
    """
    big = "decimal(38,0)"
    ranked = with_position(sources, F.col("source").isNull(), F.col("source"), name="_rank")
    cap = F.lit(most) * F.col("source_size")
    ranked = ranked.withColumn(
        "weight", F.get(F.array(*[F.lit(w) for w in weights]), (F.col("_rank") % len(weights)).cast("int"))
    ).withColumns({"_cap": cap, "_ratio": cap.cast("double") / F.col("weight")})
    summed = running_totals(ranked, ["_ratio", "_rank"], {"_caps": "_cap", "_weights": "weight"})
    whole = sources.agg(F.sum("source_size")).first()[0] or 0
    all_weights = ranked.agg(F.sum("weight")).first()[0] or 0
    wanted = F.lit(whole * share[0]).cast(big)
    need = share[1] * (
        F.col("_caps").cast(big) * F.col("weight") + F.col("_cap").cast(big) * (F.lit(all_weights) - F.col("_weights"))
    )
    summed = materialize(summed.withColumn("_full", need <= wanted * F.col("weight")))
    full = summed.where("_full").agg(F.sum("_cap"), F.sum("weight")).first()
    left = whole * share[0] - share[1] * (full[0] or 0)
    over = share[1] * (all_weights - (full[1] or 0))
    level = (F.lit(left).cast(big) * F.col("weight")).cast("double") / F.lit(float(over or 1))
    target = F.when(F.col("_full"), F.col("_cap").cast("double")).otherwise(level)
    return summed.select("source", "source_size", "weight", target.alias("target"))


def mix(
    df: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", seed: int = SEED,
    weights: tuple[int, ...] = WEIGHTS, share: tuple[int, int] = SHARE, most: int = MOST, keep_text: bool = False,
) -> DataFrame:
    """Add ``size``, ``source_size``, ``target`` and ``taken`` (words, repeats counted).

    The rows are written once with size, key and row number, without the text unless
    ``keep_text``. Only (source, key, row number, size) is sorted.
    """
    dropped = {*RESULTS, *(() if keep_text else (text,))}
    # Packed, so that no column of the input meets a name in here.
    sized = materialize(df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns if c not in dropped]).alias("_doc"),
        F.col(f"`{source}`").alias("_from"), F.size(words(text)).cast("bigint").alias("size"),
        hash_key(id_col, seed).alias(_KEY), F.monotonically_increasing_id().alias(_ROW),
    ))
    per_source = materialize(
        sized.groupBy(F.col("_from").alias("source")).agg(F.sum("size").alias("source_size"))
    )
    aimed = materialize(targets(per_source, weights, share, most))
    # Words of all sources that come earlier in the order of the sort.
    starts = running_totals(aimed, [F.col("source").isNull(), F.col("source")], {"_end": "source_size"})
    budget = F.floor("target").cast("bigint")
    whole_passes = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    plan = materialize(
        starts.withColumn("_passes", whole_passes.cast("bigint")).select(
            F.col("source").alias("_source"), "source_size", "target", "_passes",
            (F.col("_end") - F.col("source_size")).alias("_start"),
            (budget - F.col("_passes") * F.col("source_size")).alias("_rest"),
        )
    )
    narrow = sized.where("size > 0").select(F.col("_from").alias("_s"), _KEY, _ROW, "size")
    summed = running_totals(narrow, [F.col("_s").isNull(), "_s", _KEY, _ROW], {"_through": "size"})
    here = F.col("_s").eqNullSafe(F.col("_source"))
    before = F.col("_through") - F.col("size") - F.col("_start")
    # The last row that the unfinished pass reaches, and how many of its words.
    cuts = (
        summed.join(broadcast_if_small(plan), here)
        .withColumn("_before", before).where("_before < _rest")
        .groupBy("_source").agg(
            F.max(F.struct(_KEY, _ROW, F.least(F.col("size"), F.col("_rest") - F.col("_before")).alias("words"))).alias("_cut")
        )
    )
    decided = broadcast_if_small(
        materialize(plan.join(cuts.withColumnRenamed("_source", "_cut_source"), F.col("_source").eqNullSafe(F.col("_cut_source")), "left").drop("_cut_source"))
    )
    place, cut = F.struct(_KEY, _ROW), F.struct(F.col(f"_cut.{_KEY}"), F.col(f"_cut.{_ROW}"))
    last_pass = (
        F.when(F.col("_cut").isNull() | (place > cut), F.lit(0).cast("bigint"))
        .when(place < cut, F.col("size")).otherwise(F.col("_cut.words"))
    )
    return (
        sized.join(decided, F.col("_from").eqNullSafe(F.col("_source")))
        .withColumn("taken", F.col("_passes") * F.col("size") + F.when(F.col("size") > 0, last_pass).otherwise(0))
        .select("_doc.*", *RESULTS)
    )


def expand(mixed: DataFrame) -> DataFrame:
    """One row per pass that takes a document.

    Documents come whole: the one in which a budget ends is taken once more or not, whichever is
    nearer to the budget.
    """
    (step,) = free_names(mixed, "pass")
    passes = F.floor((2 * F.col("taken") + F.col("size")) / (2 * F.col("size")))
    return (
        mixed.where("taken > 0").withColumn(step, passes).where(F.col(step) > 0)
        .withColumn(step, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(step)))).drop(step)
    )
