"""Shards by k-d tree: split at weighted medians along the widest metadata dimension.

Rows are points in the metadata dimensions, each scaled to [0, 1]; text dimensions are the ranks
of their distinct values. A node that holds k leaves is split along its widest dimension into
nodes of k // 2 and k - k // 2 leaves, where the bytes of its rows divide in that proportion,
until every node is one leaf: a shard. All nodes of a level are split at once. A histogram of
bytes per node finds the bin with the median, and only the rows of that bin are sorted, by value,
hash of the id and row number, so a value that holds most of a node is split like any other. The
cut goes to the nearer side of a row, so each split is off by at most half a row.

The law is ``bytes``: shards are near equal in bytes. Equal texts are rows like all others.

Rows are written once with a row number. The tree is grown on narrow rows (number, bytes,
coordinates); then each row finds its leaf by descending the cuts, one broadcast lookup of one
row per node and level, and the texts cross the network once, to the pieces of their shard. A
piece holds about ``PIECE_BYTES``, whatever the size of a shard, and its first slot is known from
the counts of the pieces before it. Each shard is a folder of Parquet files.

Edge cases: a null text has size 1 and stays null. A null coordinate, or one that is not finite,
lies at the low end. Null ids and repeated rows are told apart by their row number. With fewer
rows than shards some shards are empty. An empty table gives an empty result. Further columns
pass through; input columns named like a result column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from swipelens.operators.ordering import running_totals, with_position
from swipelens.session import materialize, new_path
from swipelens.sizing import broadcast_if_small

N_SHARDS = 16
DIMENSIONS = ("lang", "source", "n_chars")
LAW = "bytes"
#: Histogram bins per node, and bytes of a shard that are sorted and written together.
BINS = 1 << 12
PIECE_BYTES = 32 << 20
SEED = 42
#: Texts lie on disk twice, as staged rows and in the shards, so they are packed well.
CODEC = "zstd"
RESULTS = ["size", "shard", "slot"]


def _coordinates(df: DataFrame, dims: list[str]) -> tuple[DataFrame, list[Column]]:
    """The table with the ranks of its text dimensions joined, and a column in [0, 1] per dimension."""
    texts = [d for d in dims if isinstance(df.schema[d].dataType, T.StringType)]
    if texts:
        cells = F.array(*[F.struct(F.lit(d).alias("dim"), F.col(d).alias("value")) for d in texts])
        distinct = df.select(F.explode(cells).alias("_c")).select("_c.*").where("value is not null").distinct()
        # One numbering for all of them: only differences count.
        ranks = materialize(with_position(distinct, "dim", "value", name="rank"))
    raw = []
    for dim in dims:
        if dim in texts:
            lookup = ranks.where(F.col("dim") == dim).select(F.col("value").alias(f"{dim}_value"), F.col("rank").alias(f"{dim}_rank"))
            df = df.join(broadcast_if_small(lookup), df[dim] == F.col(f"{dim}_value"), "left").drop(f"{dim}_value")
            raw.append(F.col(f"{dim}_rank").cast("double"))
        else:
            value = F.col(dim).cast("double")
            finite = value.isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf"))
            raw.append(F.when(finite, value))
    ends = df.agg(*[F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")).alias(f"d{i}") for i, c in enumerate(raw)]).first()
    scaled = []
    for i, column in enumerate(raw):
        low, high = ends[f"d{i}"]
        if low is None or high == low:
            scaled.append(F.lit(0.0))
        else:
            # Halves, since the difference of two finite numbers need not be finite.
            part = (column / 2 - F.lit(low / 2)) / F.lit(high / 2 - low / 2)
            scaled.append(F.coalesce(part, F.lit(0.0)))
    return df, scaled


def _bin(value: Column) -> Column:
    """Bin of a value between the node's ends; one bin if they meet."""
    width = F.col("hi") - F.col("lo")
    return F.when(width > 0, F.least(F.floor((value - F.col("lo")) / width * BINS), F.lit(BINS - 1))).otherwise(0).cast("int")


def _value() -> Column:
    return F.get(F.col("at"), F.col("dim"))


def _left(key: Column, row: Column, tie: Column) -> Column:
    """Whether a row goes to the first child: by bin, and in the bin of the median by order."""
    place = F.struct(key.alias("x"), tie.alias("tie"), row.alias("row"))
    here = _bin(key)
    return (here < F.col("pivot")) | ((here == F.col("pivot")) & F.coalesce(place <= F.col("cut"), F.lit(False)))


def _table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Rows about the open nodes as a broadcast side: fewer than there are shards."""
    return F.broadcast(spark.createDataFrame(rows, schema))


def cuts_of(rows: DataFrame, n_dims: int) -> DataFrame:
    """(low, leaves, dim, lo, hi, pivot, cut) of every node with more than one leaf; one row each.

    The driver holds one short row per node, so fewer than ``n_shards``.
    """
    spark, open_rows = rows.sparkSession, rows.where("leaves > 1")
    ends = [f(F.col("at")[i]).alias(f"{n}{i}") for i in range(n_dims) for n, f in (("lo", F.min), ("hi", F.max))]
    nodes = []
    for r in open_rows.groupBy("low", "leaves").agg(F.sum("size").alias("total"), *ends).collect():
        dim = max(range(n_dims), key=lambda i: (r[f"hi{i}"] - r[f"lo{i}"], -i))
        # Twice the bytes that the first child should get, for half rows.
        want = 2 * r["total"] * (r["leaves"] // 2) // r["leaves"]
        nodes.append((r["low"], r["leaves"], dim, r[f"lo{dim}"], r[f"hi{dim}"], want))
    known = "low INT, leaves INT, dim INT, lo DOUBLE, hi DOUBLE, want BIGINT"
    held = open_rows.join(_table(spark, nodes, known).drop("leaves"), "low")
    histogram = held.groupBy("low", "want", _bin(_value()).alias("bin")).agg(F.sum("size").alias("n"))
    along = Window.partitionBy("low").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    pivots = (
        histogram.withColumn("before", F.coalesce(F.sum("n").over(along), F.lit(0).cast("bigint")))
        .where(2 * F.col("before") <= F.col("want"))
        .groupBy("low").agg(F.max(F.struct("bin", "before")).alias("p")).select("low", "p.bin", "p.before").collect()
    )
    pivot_of = {r["low"]: (r["bin"], r["before"]) for r in pivots}
    nodes = [(*n, *pivot_of[n[0]]) for n in nodes]
    known += ", pivot INT, before BIGINT"
    inside = (
        open_rows.join(_table(spark, nodes, known).drop("leaves"), "low").withColumn("x", _value())
        .where(_bin(F.col("x")) == F.col("pivot")).select("low", "x", "tie", "row", "size")
    )
    summed = running_totals(inside, ["low", "x", "tie", "row"], {"through": "size"})
    # The sums run over all nodes: take off what the nodes before have in their pivot bins.
    starts = {r["low"]: r["start"] for r in summed.groupBy("low").agg(F.min(F.col("through") - F.col("size")).alias("start")).collect()}
    marks = [(n[0], n[5] - 2 * (n[7] - starts[n[0]])) for n in nodes]
    # The middle of the row, doubled, lies in the first part.
    first = (
        summed.join(_table(spark, marks, "low INT, room BIGINT"), "low")
        .where(2 * F.col("through") - F.col("size") <= F.col("room"))
        .groupBy("low").agg(F.max(F.struct("x", "tie", "row")).alias("cut")).collect()
    )
    cut_of = {r["low"]: tuple(r["cut"]) for r in first}
    cuts = [(*n[:5], n[6], cut_of.get(n[0])) for n in nodes]
    return _table(spark, cuts, "low INT, leaves INT, dim INT, lo DOUBLE, hi DOUBLE, pivot INT, cut STRUCT<x: DOUBLE, tie: BIGINT, row: BIGINT>")


def descend(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """Move every row of (row, tie, at, low, leaves) to its child; rows in a leaf stay."""
    held = rows.join(cuts, ["low", "leaves"], "left")
    left = _left(_value(), F.col("row"), F.col("tie"))
    side = F.when(F.col("dim").isNull(), 0).when(left, 1).otherwise(2)
    half = F.floor(F.col("leaves") / 2).cast("int")
    own = [c for c in rows.columns if c not in ("low", "leaves")]
    return held.select(*own, "low", "leaves", side.alias("side")).select(
        *own, F.when(F.col("side") == 2, F.col("low") + half).otherwise(F.col("low")).alias("low"),
        F.when(F.col("side") == 0, F.col("leaves")).when(F.col("side") == 1, half).otherwise(F.col("leaves") - half).alias("leaves"),
    )


def _grow(df: DataFrame, dims: tuple[str, ...], id_col: str, text: str, n_shards: int | None, target_bytes: int | None):
    """Stage the rows and grow the tree. Returns the staged points and all levels of cuts."""
    kept = [c for c in df.columns if c.lower() not in RESULTS]
    packed = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("doc"),
        (F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)).cast("bigint") + 1).alias("size"),
        F.xxhash64(F.lit(SEED), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))).alias("tie"),
        F.monotonically_increasing_id().alias("row"),
        *[F.col(f"`{d}`").alias(f"m{i}") for i, d in enumerate(dims)],
    )
    path = new_path(df.sparkSession)
    packed.write.option("compression", CODEC).parquet(path)
    staged = df.sparkSession.read.schema(packed.schema).parquet(path)
    total = staged.agg(F.sum("size")).first()[0] or 0
    if n_shards is None:
        if not target_bytes:
            raise ValueError("name n_shards or target_bytes")
        n_shards = max(1, -(-total // target_bytes))
    ranked, scaled = _coordinates(staged, [f"m{i}" for i in range(len(dims))])
    points = ranked.select(
        "doc", "size", "tie", "row", F.array(*scaled).alias("at"), F.lit(0).alias("low"), F.lit(int(n_shards)).alias("leaves")
    )
    rows, levels = materialize(points.drop("doc")), []
    for _ in range(max(0, int(n_shards) - 1).bit_length()):
        levels.append(cuts_of(rows, len(dims)))
        rows = materialize(descend(rows, levels[-1]))
    return points, rows, levels, kept, int(n_shards), total


def write_shards(
    df: DataFrame, folder: str, n_shards: int | None = N_SHARDS, target_bytes: int | None = None,
    dims: tuple[str, ...] = DIMENSIONS, id_col: str = "doc_id", text: str = "text", piece_bytes: int = PIECE_BYTES,
) -> DataFrame:
    """Write the rows to ``folder/shard=K`` and return what is read back, with ``shard`` and ``slot``.

    The number of leaves is ``n_shards``, or what it takes for leaves of ``target_bytes``.
    """
    points, rows, levels, kept, n_shards, total = _grow(df, dims, id_col, text, n_shards, target_bytes)
    # Rows of a shard fall to its pieces by hash, an even power of two of them.
    bits = max(0, -(-total // max(1, n_shards * piece_bytes)) - 1).bit_length()
    spread = F.xxhash64("tie", "row")
    piece = F.shiftrightunsigned(spread, 64 - bits) if bits else F.lit(0).cast("bigint")
    before = Window.partitionBy("shard").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    first_slots = materialize(
        rows.select(F.col("low").alias("shard"), piece.alias("piece")).groupBy("shard", "piece").agg(F.count(F.lit(1)).alias("n"))
        .withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0).cast("bigint"))).drop("n")
    )
    routed = points
    for cuts in levels:
        routed = descend(routed, cuts)
    routed = routed.select("doc", "tie", "row", "size", F.col("low").alias("shard"), piece.alias("piece"))
    inside = Window.partitionBy("shard", "piece").orderBy("tie", "row")
    placed = routed.withColumn("at", F.row_number().over(inside) - 1).join(broadcast_if_small(first_slots), ["shard", "piece"])
    out = placed.select(
        *[F.col(f"doc.`{c}`") for c in kept], "size", (F.col("first") + F.col("at")).alias("slot"), "shard"
    )
    out.write.option("compression", CODEC).partitionBy("shard").parquet(folder)
    return read_shards(df.sparkSession, folder, out.schema)


def read_shards(spark, folder: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(folder)


def shard_report(df: DataFrame, n_shards: int = N_SHARDS, id_col: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Write shards to a new shared folder and describe every row as read back from them."""
    rows = write_shards(df, new_path(df.sparkSession), n_shards, id_col=id_col, text=text, **options)
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    return rows.select(
        id_col, (F.octet_length(body) + 1).cast("bigint").alias("size"), F.crc32(body).alias("text_crc32"),
        F.lit(LAW).alias("law"), F.col("shard").cast("int").alias("shard"), F.col("slot").cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
