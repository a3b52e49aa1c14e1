"""SimHash near-duplicates: fingerprints, bit-sliced comparison, connected groups.

Two fingerprints link when at most ``radius`` of their 64 bits differ. If the bits are cut
into ``radius + extra`` bands, a linked pair agrees on at least ``extra`` of them, so every
choice of ``extra`` bands is one table whose buckets hold rows that agree on those bands.
``extra`` grows with the counted number of fingerprints, so that buckets stay small; every
value gives the same links. A bucket above ``block_rows`` is cut into blocks, and each pair of
blocks is compared by itself: no task holds more than two blocks, and nothing is left out.

Inside a block the fingerprints lie as 64 vertical bit planes, 64 rows to a machine word. The
distances of one query to 64 rows are counted at once by carry-save adders over planes. After
every eight planes, words whose 64 rows all exceed the radius are abandoned. A block gives a
spanning forest of its links, never the pairs.

Edge cases: a null text, or one without words, has fingerprint zero and is linked like any
other. Equal texts have equal fingerprints and are compared once. Rows with a null id belong
to their group, whose id is the smallest one that is not null. An empty table gives an empty
result. Further columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swipelens.llm.common import ship
from swipelens.session import materialize
from swipelens.sizing import broadcast_if_small

BITS = 64
SEED = 42
SHINGLE = 4
RADIUS = 4
#: Rows per block of a bucket; a task compares two blocks at a time.
BLOCK_ROWS = 2048
#: Mean rows per bucket above which one more band is asked to agree.
BUCKET_ROWS = 64
#: Cells (query, word of 64 rows) that are compared together.
CELLS = 1 << 15
ROW_ID = "_row"

_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_hashes(text: bytes, size: int) -> np.ndarray:
    """XXH64 of every word shingle of a UTF-8 text; a shorter text is one shingle."""
    parts = text.lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    joined = b" ".join(parts)
    if len(parts) <= size:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    ends = np.cumsum([len(p) + 1 for p in parts])
    starts = [0, *ends[:-size].tolist()]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in zip(starts, (ends[size - 1:] - 1).tolist())], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """A bit is 1 if it is set in over half of the hashes. Returned as a signed long."""
    if not len(hashes):
        return 0
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        piece = hashes[at:at + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(piece, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def with_fingerprint(df: DataFrame, text: str = "text", shingle: int = SHINGLE, name: str = "_fp") -> DataFrame:
    """Add the 64-bit fingerprint as a signed long. ASCII letters are lower-cased."""
    ship(df.sparkSession)

    @F.pandas_udf("bigint")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(shingle_hashes(t, shingle)) for t in texts], dtype="int64")

    # Bytes need no decoding and keep what is not valid text.
    return df.withColumn(name, of(F.coalesce(F.col(text), F.lit("")).cast("binary")))


# --- comparison of blocks ---------------------------------------------------------------


def bit_planes(rows: np.ndarray) -> np.ndarray:
    """(64, words): plane p of word w has bit p of rows 64 w to 64 w + 63."""
    bits = np.unpackbits(rows.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    lanes = bits.reshape(-1, 64, BITS).transpose(2, 0, 1)
    return np.ascontiguousarray(np.packbits(lanes, axis=2, bitorder="little")).view("<u8")[..., 0]


def _add(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Carry-save: three bits of equal weight become a sum and a carry."""
    half = a ^ b
    return half ^ c, (a & b) | (half & c)


def near_lanes(
    planes: np.ndarray, queries: np.ndarray, cell_query: np.ndarray, cell_word: np.ndarray,
    valid: np.ndarray, radius: int,
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For cells (query, word): the cells with rows within ``radius``, and their lane masks.

    ``valid`` masks the lanes of a word that hold rows. Distances are counted in ``levels``
    vertical bits and one sticky overflow bit per lane.
    """
    levels = max(1, int(radius).bit_length())
    for at in range(0, len(cell_query), CELLS):
        q, w = cell_query[at:at + CELLS], cell_word[at:at + CELLS]
        own = queries[q]
        count = [np.zeros(len(q), np.uint64) for _ in range(levels)]
        over = ~valid[w]
        for first in range(0, BITS, 8):
            differ = [
                planes[p, w] ^ (np.uint64(0) - ((own >> np.uint64(p)) & np.uint64(1)))
                for p in range(first, first + 8)
            ]
            s1, c1 = _add(*differ[0:3])
            s2, c2 = _add(*differ[3:6])
            s3, c3 = _add(s1, s2, differ[6])
            ones, c4 = s3 ^ differ[7], s3 & differ[7]
            t1, f1 = _add(c1, c2, c3)
            twos, f2 = t1 ^ c4, t1 & c4
            fours, eights = f1 ^ f2, f1 & f2
            for start, bits in enumerate((ones, twos, fours, eights)):
                carry = bits
                for level in range(start, levels):
                    count[level], carry = count[level] ^ carry, count[level] & carry
                over |= carry
            exceeds, equal = over, np.full(len(q), _ALL)
            for level in range(levels - 1, -1, -1):
                if radius >> level & 1:
                    equal = equal & count[level]
                else:
                    exceeds = exceeds | (equal & count[level])
                    equal = equal & ~count[level]
            alive = np.flatnonzero(exceeds != _ALL)
            if len(alive) < len(q):
                q, w, own, over = q[alive], w[alive], own[alive], over[alive]
                count = [c[alive] for c in count]
                exceeds = exceeds[alive]
            if not len(q):
                break
        if len(q):
            yield np.stack([q, w]), ~exceeds


def forest(n: int, links: Iterator[np.ndarray]) -> np.ndarray:
    """Smallest index reachable from each of ``n`` nodes over batches of (2, m) links."""
    label = np.arange(n)
    for pair in links:
        a, b = pair
        while len(a):
            la, lb = label[a], label[b]
            apart = la != lb
            if not apart.any():
                break
            a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
            low = np.minimum(la, lb)
            np.minimum.at(label, np.maximum(la, lb), low)
            while True:
                jumped = label[label]
                if (jumped == label).all():
                    break
                label = jumped
    return label


def unit_links(units: list[tuple[np.ndarray, np.ndarray]], radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Spanning links of many units at once.

    A unit is (fingerprints, side): with two sides only pairs across them are compared, as
    each side is compared with itself elsewhere.
    """
    rows, queries, word_of_unit, cell_q, cell_w, node_of_lane, node_of_query = [], [], 0, [], [], [], []
    nodes = 0
    for prints, side in units:
        crossed = bool(side.any()) and not bool(side.all())
        against = np.flatnonzero(side == 0) if crossed else np.arange(len(prints))
        asking = np.flatnonzero(side == 1) if crossed else np.arange(len(prints))
        words = -(-len(against) // 64)
        padded = np.zeros(words * 64, np.uint64)
        padded[:len(against)] = prints[against]
        lanes = np.full(words * 64, -1)
        lanes[:len(against)] = nodes + against
        first = sum(map(len, queries))
        if crossed:
            q, w = np.repeat(np.arange(len(asking)), words), np.tile(np.arange(words), len(asking))
        else:
            # Each pair once: a query is compared with its own word and those after it.
            counts = words - np.arange(len(asking)) // 64
            q = np.repeat(np.arange(len(asking)), counts)
            w = np.concatenate([np.arange(words - c, words) for c in counts]) if len(counts) else q
        cell_q.append(q + first)
        cell_w.append(w + word_of_unit)
        rows.append(padded)
        queries.append(prints[asking])
        node_of_lane.append(lanes)
        node_of_query.append(nodes + asking)
        word_of_unit += words
        nodes += len(prints)
    lanes, askers = np.concatenate(node_of_lane), np.concatenate(node_of_query)
    planes = bit_planes(np.concatenate(rows))
    held = np.packbits(lanes.reshape(-1, 64) >= 0, axis=1, bitorder="little")
    valid = np.ascontiguousarray(held).view("<u8")[:, 0]

    def pairs() -> Iterator[np.ndarray]:
        asked = np.concatenate(queries)
        for cells, near in near_lanes(planes, asked, np.concatenate(cell_q), np.concatenate(cell_w), valid, radius):
            hit = np.flatnonzero(near)
            for at in range(0, len(hit), 4096):
                some = hit[at:at + 4096]
                bits = np.unpackbits(near[some].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                cell, lane = np.nonzero(bits)
                yield np.stack([askers[cells[0, some[cell]]], lanes[cells[1, some[cell]] * 64 + lane]])

    label = forest(nodes, pairs())
    prints = np.concatenate([p for p, _ in units])
    moved = np.flatnonzero(label != np.arange(nodes))
    return prints[moved], prints[label[moved]]


def _unit_ends(keys: np.ndarray) -> np.ndarray:
    return np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1


def _compare(radius: int):
    """mapInPandas over rows sorted by unit: spanning links of each unit."""
    names = ["_table", "_key", "_i", "_j"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_keys = np.empty((0, 4), np.int64)
        open_rows, open_side = np.empty(0, np.uint64), np.empty(0, np.int64)

        def flush(keys: np.ndarray, rows: np.ndarray, side: np.ndarray) -> pd.DataFrame:
            cuts = [0, *_unit_ends(keys).tolist(), len(keys)]
            waiting, cells, found = [], 0, []
            for a, b in zip(cuts, cuts[1:]):
                if b - a > 1:
                    waiting.append((rows[a:b], side[a:b]))
                    cells += (b - a) * (1 + (b - a) // 64)
                if cells >= CELLS:
                    found.append(unit_links(waiting, radius))
                    waiting, cells = [], 0
            if waiting:
                found.append(unit_links(waiting, radius))
            a, b = (np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, np.uint64),) * 2
            return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

        for batch in batches:
            keys = np.concatenate([open_keys, batch[names].to_numpy(np.int64)])
            rows = np.concatenate([open_rows, batch["_fp"].to_numpy(np.int64).view(np.uint64)])
            side = np.concatenate([open_side, batch["_side"].to_numpy(np.int64)])
            ends = _unit_ends(keys) if len(keys) else []
            whole = int(ends[-1]) if len(ends) else 0
            if whole:
                yield flush(keys[:whole], rows[:whole], side[:whole])
            # The last unit may go on in the next batch; it has at most two blocks.
            open_keys, open_rows, open_side = keys[whole:], rows[whole:], side[whole:]
        if len(open_keys):
            yield flush(open_keys, open_rows, open_side)

    return run


def band_tables(radius: int, extra: int) -> list[int]:
    """Masks of the bits on which the rows of a bucket agree, one per table."""
    bands = radius + extra
    edges = [BITS * i // bands for i in range(bands + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(masks, extra)]


def bands_needed(rows: int, radius: int, bucket_rows: int = BUCKET_ROWS) -> int:
    """Smallest ``extra`` whose buckets hold ``bucket_rows`` on average, if rows spread evenly."""
    extra = 1
    while extra < 4 and rows >> (BITS * extra // (radius + extra)) > bucket_rows:
        extra += 1
    return extra


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def links(prints: DataFrame, radius: int, rows: int, block_rows: int = BLOCK_ROWS, extra: int | None = None) -> DataFrame:
    """Spanning links (a, b) among distinct fingerprints ``_fp``."""
    ship(prints.sparkSession)
    masks = band_tables(radius, extra or bands_needed(rows, radius))
    bucketed = prints.select(
        "_fp",
        F.posexplode(F.array(*[F.col("_fp").bitwiseAND(F.lit(_signed(m))) for m in masks])).alias("_table", "_key"),
    )
    sizes = bucketed.groupBy("_table", "_key").agg(F.count(F.lit(1)).alias("_n"))
    large = sizes.where(F.col("_n") > block_rows).withColumn("_blocks", F.ceil(F.col("_n") / block_rows))
    placed = bucketed.join(large, ["_table", "_key"], "left").withColumn("_blocks", F.coalesce("_blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("_fp"), F.col("_blocks"))
    placed = placed.withColumn("_own", own).withColumn(
        "_other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_blocks") - 1))
    )
    units = placed.select(
        "_table", "_key", F.least("_own", "_other").alias("_i"), F.greatest("_own", "_other").alias("_j"),
        (F.col("_own") > F.col("_other")).cast("int").alias("_side"), "_fp",
    )
    unit = ["_table", "_key", "_i", "_j"]
    return (
        units.repartition(*unit).sortWithinPartitions(*unit)
        .mapInPandas(_compare(radius), "a BIGINT, b BIGINT").distinct()
    )


# --- groups -----------------------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """Smallest node of its component for every node with a link: columns ``node``, ``root``.

    Alternating stars: every node points its larger neighbours, then its smaller ones, to
    the smallest it knows. Edges never multiply, and a round is written to the shared folder.
    The driver sees two sums per round. It ends when a round changes nothing.
    """
    pairs = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    state = None
    while True:
        seen = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == state or not seen[0]:
            return pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = tuple(seen)
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("_m")).select("a", F.least("a", "_m").alias("_m"))
        large = both.join(low, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("_m").alias("b"))
        large = large.where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("_m"))
        small = large.join(low, "a").select(
            F.when(F.col("b") == F.col("_m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("_m").alias("b")
        )
        pairs = materialize(small.where("a <> b").distinct())


def group_ids(
    prints: DataFrame, id_col: str, radius: int = RADIUS, block_rows: int = BLOCK_ROWS, extra: int | None = None
) -> DataFrame:
    """One row per distinct fingerprint ``_fp``: ``component_id``, the smallest reachable id."""
    distinct = materialize(prints.groupBy("_fp").agg(F.min(id_col).alias("_low")))
    found = links(distinct.select("_fp"), radius, distinct.count(), block_rows, extra)
    roots = materialize(components(found))
    rooted = distinct.join(roots, distinct["_fp"] == roots["node"], "left").select(
        "_fp", "_low", F.coalesce("root", "_fp").alias("_root")
    )
    lowest = rooted.groupBy("_root").agg(F.min("_low").alias("component_id"))
    return rooted.join(lowest, "_root").select("_fp", "component_id")


def near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS,
    block_rows: int = BLOCK_ROWS, extra: int | None = None, keep_text: bool = False,
) -> DataFrame:
    """Add ``fingerprint`` (16 hex digits), ``component_id`` and the row number ``_row``.

    The fingerprinted rows are written once, without the text unless ``keep_text``. Row
    numbers come with that table and so stay the same however often it is read.
    """
    base = df.drop("fingerprint", "component_id", "_fp", ROW_ID)
    printed = with_fingerprint(base, text, shingle).withColumn(ROW_ID, F.monotonically_increasing_id())
    printed = materialize(printed if keep_text else printed.drop(text))
    groups = group_ids(printed.select("_fp", id_col), id_col, radius, block_rows, extra)
    return (
        printed.join(groups, "_fp")
        .withColumn("fingerprint", F.lower(F.lpad(F.hex("_fp"), 16, "0")))
        .drop("_fp")
    )


def _first_rows(marked: DataFrame, id_col: str) -> DataFrame:
    """Row number of the smallest id of each group, reduced on the map side."""
    first = marked.groupBy("component_id").agg(
        F.min(F.struct(F.col(id_col).isNull(), F.col(id_col), F.col(ROW_ID).alias("row"))).alias("_first")
    )
    return first.select(F.col("_first.row").alias(ROW_ID))


def keep_one(marked: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The row with the smallest id of each group; of rows that share it, the first."""
    return marked.join(_first_rows(marked, id_col), ROW_ID, "left_semi").drop(ROW_ID)


def deduplicate(
    df: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS
) -> DataFrame:
    """``keep_one`` of the near-duplicates, with the columns of ``df``; texts move once at most.

    Groups and their first rows are found on ids and fingerprints alone.
    """
    base = df.drop("_fp", ROW_ID)
    printed = with_fingerprint(base, text, shingle).withColumn(ROW_ID, F.monotonically_increasing_id())
    printed = materialize(printed)
    narrow = printed.select(id_col, "_fp", ROW_ID)
    marked = narrow.join(group_ids(narrow.select("_fp", id_col), id_col, radius), "_fp")
    chosen = materialize(_first_rows(marked, id_col))
    # Below a counted bound the texts stay where they are.
    return printed.join(broadcast_if_small(chosen), ROW_ID, "left_semi").select(*base.columns)
