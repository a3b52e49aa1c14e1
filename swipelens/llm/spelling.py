"""Spelling variants: words at one edit from each other, found by pivotal grams.

All bigrams are ranked by how many words hold them. A word's prefix is its three rarest bigrams,
with every other occurrence of a bigram as rare as the third. Its pivots are two bigrams of the
prefix that share no character, chosen for the smallest sum of frequencies by dynamic programming.
One edit spoils at most one of two disjoint bigrams. So if two words are at one edit, a pivot of
the one whose prefix ends at the rarer bigram stands in the other word too, and there in the
prefix, at the same place or shifted by one.

The pivots are indexed. On that side of a surviving pivot where the edit is not, both words agree
from their start or to their end; that piece, pivot included, is the position limit, and with the
word length it is the join key. Prefixes of all words are looked up under it, and what meets is
verified by edit distance. No pair is lost: the keys follow from the edit alone.

A word's form is its near word with the most occurrences, if it has ``ratio`` times as many; the
root is reached by doubling the links, whose counts grow by ``ratio`` at each step.

Tasks count the words of their documents in tables of bounded size, so a common word crosses the
network once per task. The bigram table has at most one row per two letters of the alphabet of 90.

Edge cases: a null text has no words. Null ids take part as the empty text in the hash. Repeated
rows count each time. Ties in a form go to the smallest word. An empty table gives an empty
result, and other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swipelens.llm.common import ship, whole
from swipelens.session import materialize
from swipelens.sizing import broadcast_if_small

GRAM = 2
EDITS = 1
#: Bigrams of the prefix, and pivots: what the number of edits asks for.
PREFIX = GRAM * EDITS + 1
PIVOTS = EDITS + 1
MIN_LENGTH = 6
MIN_COUNT = 5
RATIO = 5
#: A run loses a character when this divides its hash.
THIN = 199
#: Words that a task counts before it hands them on.
COUNTED = 300_000

#: Letters are A to Z and U+00C0 to U+00FF. In Latin-1 those are single bytes; in UTF-8 the
#: latter are the byte C3 and one more.
LATIN_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))
UTF8_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))
_PLAIN = bytes(range(128)) + bytes(range(0x80, 0xC0)) + b"\xc3"


def runs(text: bytes) -> list[bytes]:
    """The runs of letters of a UTF-8 text, A to Z in lower case, as UTF-8."""
    if not text.isascii() and text.translate(None, _PLAIN):
        # Other leading bytes: go by characters, with a blank for those outside Latin-1.
        latin = text.decode("utf-8", "replace").encode("latin-1", "replace").translate(LATIN_BYTES)
        return [w if w.isascii() else w.decode("latin-1").encode() for w in latin.split()]
    return text.translate(UTF8_BYTES).split()


def without(run: bytes, hashed: int) -> bytes:
    """The run without its character at ``hashed`` modulo its length."""
    letters = run.decode()
    at = hashed % len(letters)
    return (letters[:at] + letters[at + 1:]).encode()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n) with the thinned runs put under what is left of them."""
    table: Counter = Counter()

    def flush() -> pa.RecordBatch:
        found = [(w, n) for w, n in table.items() if len(w) >= MIN_LENGTH]
        table.clear()
        return pa.RecordBatch.from_arrays([
            pa.array([w for w, _ in found], pa.binary()).view(pa.string()), pa.array([n for _, n in found], pa.int64()),
        ], ["word", "n"])

    for batch in batches:
        for name, text in zip(batch.column("id").to_pylist(), batch.column("text")):
            own = Counter(runs(text.as_buffer().to_pybytes()))
            if not own:
                continue
            begin = zlib.crc32(f"{name}:".encode())
            hashes = np.fromiter(map(zlib.crc32, own, repeat(begin)), np.int64, len(own))
            thin = np.flatnonzero(hashes % THIN == 0)
            if len(thin):
                names = list(own)
                moved = [(names[i], own.pop(names[i]), int(hashes[i])) for i in thin.tolist()]
                for run, n, hashed in moved:
                    own[without(run, hashed)] += n
            table.update(own)
            if len(table) > COUNTED:
                yield flush()
    yield flush()


def word_counts(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): words of at least MIN_LENGTH characters with MIN_COUNT occurrences."""
    ship(df.sparkSession)
    bare = df.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), whole(text).cast("binary").alias("text")
    )
    return (
        bare.mapInArrow(_count, "word STRING, n BIGINT").where(F.length("word") >= MIN_LENGTH)
        .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)
    )


def bigram_frequencies(words: DataFrame) -> dict[str, int]:
    """In how many places of the words each bigram stands. At most 90 squared of them."""
    places = F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substring(F.col("word"), i, F.lit(GRAM)))
    rows = words.select(F.explode(places).alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("n")).collect()
    return {r["gram"]: r["n"] for r in rows}


def disjoint(places: list[int], costs: list[int], wanted: int = PIVOTS) -> list[int]:
    """Places, ascending, of ``wanted`` grams that do not overlap, with the smallest sum of costs.

    ``best[i]`` is the cheapest choice among the first i grams; one more gram is added per round.
    """
    best: list[tuple[int, list[int]] | None] = [(0, [])] * (len(places) + 1)
    for _ in range(wanted):
        longer: list[tuple[int, list[int]] | None] = [None]
        free = 0
        for i, place in enumerate(places):
            while free < i and places[free] + GRAM <= place:
                free += 1
            # The first ``free`` grams end before this one begins.
            before = best[free]
            taken = before and (before[0] + costs[i], [*before[1], place])
            skipped = longer[-1]
            longer.append(min((c for c in (skipped, taken) if c), default=None))
        best = longer
    return best[-1][1]


def signature(word: str, rank: dict[str, int], frequency: dict[str, int]) -> tuple[int, list[int], list[int]]:
    """Rank of the prefix's last gram, the places of the prefix, and those of the pivots."""
    grams = [word[i:i + GRAM] for i in range(len(word) - GRAM + 1)]
    ranks = [rank[g] for g in grams]
    last = sorted(ranks)[PREFIX - 1]
    prefix = [i for i, r in enumerate(ranks) if r <= last]
    return last, prefix, disjoint(prefix, [frequency[grams[i]] for i in prefix])


def _key(side: str, length: int, piece: str) -> int:
    return xxhash.xxh3_64_intdigest(f"{side}{length}:{piece}".encode()) - (1 << 63)


def index_keys(word: str, pivots: list[int]) -> list[int]:
    """Where a word is indexed: the piece up to each pivot, and the piece from it on."""
    found = []
    for i in pivots:
        found += [_key("<", len(word), word[:i + GRAM]), _key(">", len(word), word[i:])]
    return found


def probe_keys(word: str, prefix: list[int]) -> list[int]:
    """Where the words at one edit are looked up: by the agreeing piece and their length.

    The other side must be able to hold the edit: nothing can be replaced or left out where no
    character is.
    """
    found, length = [], len(word)
    for i in prefix:
        for side, piece, rest in (("<", word[:i + GRAM], length - i - GRAM), (">", word[i:], i)):
            found += [_key(side, length + more, piece) for more in ((1, 0, -1) if rest else (1,))]
    return found


def _keyed(frequency: dict[str, int], probing: bool):
    rank = {g: r for r, g in enumerate(sorted(frequency, key=lambda g: (frequency[g], g)))}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, counts = batch.column("word").to_pylist(), batch.column("n").to_pylist()
            keys, rows, lasts = [], [], []
            for row, word in enumerate(words):
                last, prefix, pivots = signature(word, rank, frequency)
                found = set(probe_keys(word, prefix) if probing else index_keys(word, pivots))
                keys += found
                rows += [row] * len(found)
                lasts += [last] * len(found)
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([
                pa.array(keys, pa.int64()), pa.array(words, pa.string()).take(at),
                pa.array(counts, pa.int64()).take(at), pa.array(lasts, pa.int32()),
            ], ["key", "word", "n", "last"])

    return run


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, n_a, b, n_b): all pairs a < b of (word, n) at exactly one edit, once each."""
    ship(words.sparkSession)
    frequency = bigram_frequencies(words)
    schema = "key BIGINT, word STRING, n BIGINT, last INT"
    index = words.mapInArrow(_keyed(frequency, False), schema).toDF("key", "p", "n_p", "last_p")
    probe = words.mapInArrow(_keyed(frequency, True), schema).toDF("key", "q", "n_q", "last_q")
    # Spark sizes both sides as the words, of which they have many rows each: neither is broadcast.
    met = index.hint("merge").join(probe, "key").where(
        (F.col("last_q") >= F.col("last_p")) & (F.col("p") != F.col("q")) & (F.levenshtein("p", "q", EDITS) == EDITS)
    )
    first = F.col("p") < F.col("q")
    return met.select(
        F.least("p", "q").alias("a"), F.when(first, F.col("n_p")).otherwise(F.col("n_q")).alias("n_a"),
        F.greatest("p", "q").alias("b"), F.when(first, F.col("n_q")).otherwise(F.col("n_p")).alias("n_b"),
    ).distinct()


def roots(links: DataFrame) -> DataFrame:
    """(word, root) from (word, form): links are doubled until none leads further.

    Chains are as long as a count can be multiplied, so there are few rounds.
    """
    reached = materialize(links.select("word", F.col("form").alias("root")))
    while True:
        ahead = broadcast_if_small(reached.select(F.col("word").alias("_w"), F.col("root").alias("_r")))
        step = materialize(reached.join(ahead, reached["root"] == ahead["_w"], "left").drop("_w"))
        if not step.where("_r is not null").limit(1).count():
            return reached
        reached = step.select("word", F.coalesce("_r", "root").alias("root"))


def variants(df: DataFrame, id_col: str = "doc_id", text: str = "text", ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for all words."""
    words = materialize(word_counts(df, id_col, text))
    pairs = near_pairs(words)
    sides = F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("near_n")),
    )
    best = F.min(F.struct((-F.col("near_n")).alias("minus_n"), "near"))
    near = (
        pairs.select(F.explode(sides).alias("_s")).select("_s.*")
        .groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    )
    joined = words.join(near.hint("merge"), "word", "left")
    wins = -F.col("best.minus_n") >= ratio * F.col("n")
    judged = materialize(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(wins, F.col("best.near")).alias("form"), F.when(wins, -F.col("best.minus_n")).alias("form_n"),
    ))
    ends = broadcast_if_small(roots(judged.where("form is not null")))
    return judged.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
