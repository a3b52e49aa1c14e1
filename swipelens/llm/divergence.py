"""Source divergence audit over run-length columns.

Per language the terms in at least ``min_docs`` documents are kept. A group is one source of a
language; its share of a term is p = 1 + floor(SCALE (count + 2) / (N + 2 V)), for N occurrences
of the V kept terms in it, and two shares p, q differ by f = floor((p - q)^2 / (p + q)). The
audit sums f over all kept terms for every two sources of a language, and lists for each group
the terms that it has more of than its language.

Kept terms are sorted by their counts in all sources, those of small sources first, so equal
counts stand together. The sorted vocabulary is cut into blocks, and in a block every group's
column of counts is a list of runs. For two groups the run boundaries are intersected and f is
taken once per piece and multiplied by its length, so a pair costs its runs, not its terms.

Tasks count the terms of their documents in tables of bounded size, so a common term or a large
source crosses the network once per task. A block holds ``BLOCK_TERMS`` terms, and pairs of
sources are compared in tiles of ``TILE`` by ``TILE``: a task holds two tiles of one block.
The result has one row for every two sources of a language; no pairs of documents or terms are
ever made.

Arithmetic is exact in 64 bits while N + 2 V is below 9e15.

Edge cases: null text, language and source are the empty string. A group without kept terms has
count 0 for all of them. A language without kept terms has divergence 0 for all pairs. Texts
are read whole, repeated rows are documents of their own, ties are ordered by the item's UTF-8
bytes, an empty table gives an empty result, and other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from swipelens.llm.common import ship, whole
from swipelens.session import materialize
from swipelens.sizing import broadcast_if_small

MIN_DOCS = 10
TOP = 10
SCALE = 10 ** 9
#: Terms of a block, and sources per tile.
BLOCK_TERMS = 1 << 14
TILE = 32
#: Terms that a task counts before it hands them on.
COUNTED = 300_000

#: Bytes of a text as the bytes of its terms, in lower case, and blanks between them: terms are
#: letters A to Z and everything above 127.
TERM_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256)
)

_COUNTS = "lang STRING, source STRING, term STRING, n BIGINT, docs BIGINT"
_RUNS = "lang STRING, block BIGINT, idx INT, starts ARRAY<INT>, counts ARRAY<BIGINT>, length INT"
_SUMS = "lang STRING, a INT, b INT, value BIGINT"


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of every term per language and source."""
    groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    held = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in groups.items():
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * len(n), pa.string()), pa.array([source] * len(n), pa.string()),
                pa.array(list(n), pa.binary()).view(pa.string()), pa.array(list(n.values()), pa.int64()),
                pa.array([docs[t] for t in n], pa.int64()),
            ], ["lang", "source", "term", "n", "docs"])
        groups.clear()

    for batch in batches:
        langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
        for lang, source, text in zip(langs, sources, batch.column("text")):
            n, docs = groups.setdefault((lang, source), (Counter(), Counter()))
            terms = text.as_buffer().to_pybytes().translate(TERM_BYTES).split()
            held -= len(n)
            n.update(terms)
            docs.update(set(terms))
            held += len(n)
            if held > COUNTED:
                yield from flush()
                held = 0
    yield from flush()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) over all documents; columns lang, source and text are given."""
    ship(docs.sparkSession)
    bare = docs.select("lang", "source", F.col("text").cast("binary").alias("text"))
    return bare.mapInArrow(_count, _COUNTS).groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs")
    )


def share(count: np.ndarray, total: int) -> np.ndarray:
    """1 + floor(SCALE * count / total) for count <= total, digit group by digit group."""
    share, rest = np.zeros_like(count), count
    for _ in range(3):
        rest = rest * 1000
        share = share * 1000 + rest // total
        rest = rest % total
    return 1 + share


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def runs_of(column: np.ndarray) -> np.ndarray:
    """Where the runs of equal values begin."""
    return np.flatnonzero(np.concatenate([[True], column[1:] != column[:-1]]))


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The run-length columns of all groups of a language, block by block of sorted terms."""
    partition, made = TaskContext.get().partitionId(), 0
    lang, groups, cells = None, 0, []

    def close() -> pa.RecordBatch:
        nonlocal made
        length, rows = len(cells), []
        # The block by columns: where each group has counts, and which.
        place = np.repeat(np.arange(length), [len(c) for c in cells])
        idx = np.array([i for c in cells for i, _ in c], np.int64)
        n = np.array([v for c in cells for _, v in c], np.int64)
        order = np.argsort(idx, kind="stable")
        place, n = place[order], n[order]
        ends = np.searchsorted(idx[order], np.arange(groups + 1))
        for i in range(groups):
            column = np.zeros(length, np.int64)
            column[place[ends[i]:ends[i + 1]]] = n[ends[i]:ends[i + 1]]
            starts = runs_of(column)
            rows.append((lang, (partition << 32) + made, i, starts.tolist(), column[starts].tolist(), length))
        made += 1
        cells.clear()
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.int32()]
        return pa.RecordBatch.from_arrays(
            [pa.array(list(v), k) for v, k in zip(zip(*rows), kinds)],
            ["lang", "block", "idx", "starts", "counts", "length"],
        )

    for batch in batches:
        for row_lang, row_groups, counts in zip(*[batch.column(c).to_pylist() for c in ("lang", "groups", "counts")]):
            if cells and (row_lang != lang or len(cells) >= BLOCK_TERMS):
                yield close()
            lang, groups = row_lang, row_groups
            cells.append([(c["idx"], c["n"]) for c in counts])
    if cells:
        yield close()


def run_columns(kept: DataFrame) -> DataFrame:
    """(lang, block, idx, starts, counts, length) from (lang, term, groups, counts per source)."""
    ship(kept.sparkSession)
    ordered = kept.orderBy("lang", "counts", "term").select("lang", "groups", "counts")
    return ordered.mapInArrow(_encode, _RUNS)


def _compare(rows: pd.DataFrame) -> pd.DataFrame:
    """Sums of f over one block for all pairs of two tiles of sources."""
    first, second = rows["first"].iat[0], rows["second"].iat[0]
    columns = {}
    for idx, starts, counts, total in zip(rows["idx"], rows["starts"], rows["counts"], rows["total"]):
        columns[idx] = (np.asarray(starts, np.int64), share(np.asarray(counts, np.int64) + 2, int(total)))
    length, lang = int(rows["length"].iat[0]), rows["lang"].iat[0]
    left = sorted(i for i in columns if i // TILE == first)
    right = sorted(i for i in columns if i // TILE == second)
    found = []
    for a in left:
        starts_a, p = columns[a]
        for b in right:
            if a >= b:
                continue
            starts_b, q = columns[b]
            bounds = np.union1d(starts_a, starts_b)
            sizes = np.diff(bounds, append=length)
            f = distance(
                p[np.searchsorted(starts_a, bounds, "right") - 1], q[np.searchsorted(starts_b, bounds, "right") - 1]
            )
            found.append((lang, a, b, int((f * sizes).sum())))
    return pd.DataFrame(found, columns=["lang", "a", "b", "value"])


def pair_sums(columns: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, a, b, value) for every two sources a < b of a language with kept terms."""
    tile = F.floor(F.col("idx") / TILE).cast("int")
    tiles = F.floor((F.col("groups") - 1) / TILE).cast("int")
    totals = broadcast_if_small(groups.select("lang", "idx", "total", "groups"))
    dealt = (
        columns.join(totals, ["lang", "idx"])
        .withColumn("_tile", tile).withColumn("_other", F.explode(F.sequence(F.lit(0), tiles)))
        .withColumns({"first": F.least("_tile", "_other"), "second": F.greatest("_tile", "_other")})
        .drop("_tile", "_other", "groups")
    )
    return (
        dealt.groupBy("lang", "block", "first", "second").applyInPandas(_compare, _SUMS)
        .groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    )


def _exact_share(count: str, total: str) -> str:
    return f"1 + (CAST({count} + 2 AS DECIMAL(20,0)) * {SCALE}) div CAST({total} AS DECIMAL(20,0))"


def excess_terms(kept: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    """(lang, idx, item, value, rank): the terms that a group has most in excess of its language."""
    totals = broadcast_if_small(groups.select("lang", "idx", "total", "lang_total"))
    shares = (
        kept.select("lang", "term", F.col("n").alias("all_n"), F.explode("counts").alias("_c"))
        .select("lang", "term", "all_n", "_c.idx", "_c.n").join(totals, ["lang", "idx"])
        .withColumns({"p": F.expr(_exact_share("n", "total")), "q": F.expr(_exact_share("all_n", "lang_total"))})
        .where("p > q")
        .select("lang", "idx", F.col("term").alias("item"), F.expr("(p - q) * (p - q) div (p + q)").alias("value"))
    )
    along = Window.partitionBy("lang", "idx").orderBy(F.desc("value"), "item")
    return shares.withColumn("rank", F.row_number().over(along)).where(F.col("rank") <= top)


def audit(
    df: DataFrame, lang: str = "lang", source: str = "source", text: str = "text",
    min_docs: int = MIN_DOCS, top: int = TOP,
) -> DataFrame:
    """(lang, source, part, item, value, rank): parts ``pair`` and ``term``, see above."""
    docs = df.select(whole(lang).alias("lang"), whole(source).alias("source"), whole(text).alias("text"))
    # Small sources first: their columns change least often, and the sort keeps them together.
    within = Window.partitionBy("lang").orderBy("docs", "source")
    names = materialize(
        docs.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("docs"))
        .withColumn("idx", F.row_number().over(within) - 1)
        .withColumn("groups", F.count(F.lit(1)).over(Window.partitionBy("lang")).cast("int"))
        .drop("docs")
    )
    counted = term_counts(docs).join(broadcast_if_small(names), ["lang", "source"])
    kept = materialize(
        counted.groupBy("lang", "term").agg(
            F.sum("docs").alias("docs"), F.sum("n").alias("n"), F.first("groups").alias("groups"),
            F.sort_array(F.collect_list(F.struct("idx", "n"))).alias("counts"),
        ).where(F.col("docs") >= min_docs).drop("docs")
    )
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("n").alias("lang_n"))
    own = (
        kept.select("lang", F.explode("counts").alias("_c"))
        .groupBy("lang", F.col("_c.idx").alias("idx")).agg(F.sum("_c.n").alias("n"))
    )
    zero = F.lit(0).cast("bigint")
    groups = materialize(
        names.join(langs, "lang", "left").join(own, ["lang", "idx"], "left").select(
            "lang", "source", "idx", "groups", F.coalesce("terms", zero).alias("terms"),
            (F.coalesce("n", zero) + 2 * F.coalesce("terms", zero)).alias("total"),
            (F.coalesce("lang_n", zero) + 2 * F.coalesce("terms", zero)).alias("lang_total"),
        )
    )
    sums = materialize(pair_sums(run_columns(kept), groups))
    mirrored = sums.unionByName(sums.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    bare = groups.where("terms = 0").select("lang", "idx")
    nothing = bare.select("lang", F.col("idx").alias("a")).join(
        bare.select("lang", F.col("idx").alias("b")), "lang"
    ).where("a <> b").withColumn("value", zero)
    label = groups.select("lang", F.col("idx").alias("b"), F.col("source").alias("item"))
    label = broadcast_if_small(label)
    ranked = Window.partitionBy("lang", "a").orderBy(F.desc("value"), "item")
    pairs = (
        mirrored.unionByName(nothing).join(label, ["lang", "b"])
        .select("lang", F.col("a").alias("idx"), F.lit("pair").alias("part"), "item", "value", F.row_number().over(ranked).alias("rank"))
    )
    terms = excess_terms(kept, groups, top).withColumn("part", F.lit("term"))
    source_of = broadcast_if_small(groups.select("lang", "idx", "source"))
    return pairs.unionByName(terms).join(source_of, ["lang", "idx"]).select(
        "lang", "source", "part", "item", "value", "rank"
    )
