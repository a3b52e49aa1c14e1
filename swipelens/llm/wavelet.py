"""Token ids in files: one wavelet matrix per shard, with rank and select.

A shard holds the ids of consecutive documents. Level by level, from the highest bit of the
ids, the file has one bit per token and then the tokens in order of that bit. ``rank`` over
these planes leads from a position to its place on the next level and ``select`` leads back,
so one file answers what token stands where, how often a token occurs in a range, and where.
Per 512 bits the file keeps the number of ones before them; planes are packed with zstandard.

Documents are range partitioned and sorted by id. Tasks cut their documents into shards of
about ``SHARD_TOKENS`` and write each as one file; no shard, and so no task, holds more than
that and one document. A document's start is its place in its partition, plus the totals of
the earlier partitions: one number per partition passes through the driver.

Edge cases: a null text is the empty text, which has the end id only. Null ids come last.
Rows with one id are ordered by a hash of their text. An empty table gives no file and an empty result.
Columns other than id and text are not stored.
"""

from __future__ import annotations

import gc
import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from swipelens.llm import files
from swipelens.llm.bpe import LATIN_END, NOT_SPACE, STEP, Codec, Remembered, in_symbols, read_spec
from swipelens.llm.common import ship, whole
from swipelens.session import materialize, new_path

SHARD_TOKENS = 1 << 21
BLOCK = 512
#: Bytes that a task remembers of runs between white space, and per generation of words.
RUN_BYTES, WORD_BYTES = 64 << 20, 32 << 20
#: Bytes of text that are encoded together.
TEXT_BYTES = 32 << 20
#: A letter and a mark that is a word of its own behind it.
MARKED = r"([a-z])([.,;:!?)])"
#: Positions that are looked up together.
LOOKUP = 1 << 16
MAGIC = b"SWLWM001"
_HEAD = struct.Struct("<8sIQQIB")

MANIFEST = "partition INT, shard INT, name STRING, n_docs BIGINT, n_tokens BIGINT"
ROWS = "doc_id BIGINT, start BIGINT, n_tokens BIGINT, ids_crc32 BIGINT"


@dataclass
class Plane:
    """One level: its bits in 64-bit words, and how many are zero."""

    words: np.ndarray
    blocks: np.ndarray
    zeros: int

    @classmethod
    def of(cls, bits: np.ndarray) -> "Plane":
        padded = np.zeros(-(-len(bits) // BLOCK) * BLOCK // 8, np.uint8)
        packed = np.packbits(bits, bitorder="little")
        padded[:len(packed)] = packed
        words = padded.view("<u8")
        ones = np.bitwise_count(words).reshape(-1, BLOCK // 64).sum(axis=1, dtype=np.int64)
        return cls(words, np.concatenate([[0], np.cumsum(ones)]).astype("<u4"), int(len(bits) - bits.sum()))

    def __post_init__(self):
        # Ones before each word; the file has them per block only.
        inside = np.bitwise_count(self.words).astype(np.int64).reshape(-1, BLOCK // 64)
        before = np.cumsum(inside, axis=1) - inside + self.blocks[:-1, None].astype(np.int64)
        self.before = np.append(before.ravel(), int(self.blocks[-1]))

    def bit(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each position; the end of the plane is a position too."""
        word = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        inside = np.bitwise_count(self.words[np.minimum(word, len(self.words) - 1)] & low)
        return self.before[word] + np.where(word < len(self.words), inside, 0)

    def select(self, one: bool, k: np.ndarray) -> np.ndarray:
        """Position of the k-th one, or zero, counted from 0."""
        before = self.before if one else np.arange(len(self.before)) * 64 - self.before
        word = np.searchsorted(before, k, side="right") - 1
        bits = np.unpackbits(self.words[word].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        if not one:
            bits = 1 - bits
        seen = np.cumsum(bits, axis=1)
        return word * 64 + np.argmax(seen > (k - before[word])[:, None], axis=1)


class WaveletMatrix:
    """Ids of one shard and where its documents begin."""

    def __init__(self, n: int, planes: list[Plane], docs: np.ndarray, has_id: np.ndarray, starts: np.ndarray,
                 partition: int = 0, base: int = 0):
        self.n, self.planes, self.docs, self.has_id, self.starts = n, planes, docs, has_id, starts
        self.partition, self.base = partition, base

    @classmethod
    def build(cls, ids: np.ndarray, docs: list[int | None], starts: list[int], partition: int = 0, base: int = 0):
        """``starts``: where each document begins, and the number of ids at the end."""
        planes, order = [], ids
        for level in range(max(1, int(ids.max(initial=0)).bit_length()) - 1, -1, -1):
            bits = (order >> ids.dtype.type(level)) & ids.dtype.type(1) != 0
            planes.append(Plane.of(bits))
            # By positions: a mask of random bits costs four times as much.
            order = np.concatenate([order.take(np.flatnonzero(~bits)), order.take(np.flatnonzero(bits))])
        has_id = np.array([d is not None for d in docs], bool)
        return cls(len(ids), planes, np.array([d or 0 for d in docs], "<i8"), has_id, np.array(starts, "<u8"), partition, base)

    def access(self, at: np.ndarray) -> np.ndarray:
        """The ids at the given positions."""
        at, ids = at.astype(np.int64), np.zeros(len(at), np.uint32)
        for plane in self.planes:
            bit, ones = plane.bit(at), plane.rank(at)
            ids = (ids << np.uint32(1)) | bit.astype(np.uint32)
            at = np.where(bit != 0, plane.zeros + ones, at - ones)
        return ids

    def slice(self, low: int, high: int) -> Iterator[np.ndarray]:
        for at in range(low, high, LOOKUP):
            yield self.access(np.arange(at, min(high, at + LOOKUP)))

    def decode(self) -> np.ndarray:
        """All ids in order, from the last level up: each bit sends its half back to its places."""
        ids = np.zeros(self.n, np.uint16 if len(self.planes) <= 16 else np.uint32)
        for shift, plane in enumerate(reversed(self.planes)):
            bits = np.unpackbits(plane.words.view(np.uint8), count=self.n, bitorder="little").view(bool)
            above = np.empty_like(ids)
            above[np.flatnonzero(~bits)] = ids[:plane.zeros]
            above[np.flatnonzero(bits)] = ids[plane.zeros:] | ids.dtype.type(1 << shift)
            ids = above
        return ids

    def _range(self, token: int, low: int, high: int) -> tuple[int, int]:
        """Where the token's occurrences between two positions lie below the last level."""
        if token >> len(self.planes):
            return 0, 0
        ends = np.array([low, high])
        for shift, plane in zip(range(len(self.planes) - 1, -1, -1), self.planes):
            ones = plane.rank(ends)
            ends = plane.zeros + ones if token >> shift & 1 else ends - ones
        return int(ends[0]), int(ends[1])

    def count(self, token: int, low: int = 0, high: int | None = None) -> int:
        a, b = self._range(token, low, self.n if high is None else high)
        return b - a

    def locate(self, token: int, low: int = 0, high: int | None = None) -> np.ndarray:
        """Positions of the token between two positions, ascending."""
        a, b = self._range(token, low, self.n if high is None else high)
        at = np.arange(a, b)
        for shift, plane in enumerate(reversed(self.planes)):
            one = bool(token >> shift & 1)
            at = plane.select(one, at - plane.zeros if one else at) if len(at) else at
        return at

    def to_bytes(self) -> bytes:
        pack = zstandard.ZstdCompressor(level=1).compress
        out = [_HEAD.pack(MAGIC, self.partition, self.base, self.n, len(self.docs), len(self.planes))]
        sections = [self.docs, self.has_id, self.starts]
        for plane in self.planes:
            sections += [np.array([plane.zeros], "<u8"), plane.words, plane.blocks]
        for section in sections:
            data = pack(section.tobytes())
            out += [struct.pack("<I", len(data)), data]
        return b"".join(out)

    @classmethod
    def from_bytes(cls, data: bytes) -> "WaveletMatrix":
        magic, partition, base, n, _, levels = _HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a token shard")
        unpack, at = zstandard.ZstdDecompressor().decompress, _HEAD.size

        def section(kind: str) -> np.ndarray:
            nonlocal at
            (size,) = struct.unpack_from("<I", data, at)
            at += 4 + size
            return np.frombuffer(unpack(data[at - size:at]), kind)

        docs, has_id, starts = section("<i8"), section("?"), section("<u8")
        planes = []
        for _ in range(levels):
            zeros = int(section("<u8")[0])
            planes.append(Plane(section("<u8"), section("<u4"), zeros))
        return cls(n, planes, docs, has_id, starts, partition, base)


class Runs:
    """Ids of runs of text, many looked up together; what was seen lately is remembered.

    The remembered runs are Arrow columns that stand before those looked up: one dictionary
    encoding tells what is known, what is new and what repeats, so each new run is computed once
    and the others never become Python objects. Beyond ``limit`` bytes only the runs looked up
    last are kept; very long ones are not kept at all.
    """

    def __init__(self, compute, kind: str, limit: int):
        self.compute, self.kind, self.limit = compute, np.dtype(kind), limit
        self.known, self.ids = pa.array([], pa.string()), self._lists([])

    def _lists(self, found: list[bytes]) -> pa.ListArray:
        ends = np.cumsum([0, *map(len, found)]) // self.kind.itemsize
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(found), self.kind)))

    def held(self) -> int:
        return self.known.nbytes + self.ids.nbytes

    def find(self, runs: pa.StringArray) -> pa.ListArray:
        """The ids of each run."""
        n = len(self.known)
        coded = pa.concat_arrays([self.known, runs]).dictionary_encode()
        self.known, at = coded.dictionary, coded.indices[n:]
        new = self.known[n:]
        self.ids = pa.concat_arrays([self.ids, self._lists(list(map(self.compute, new.to_numpy(zero_copy_only=False))))])
        found = self.ids.take(at)
        short = pc.less_equal(pc.binary_length(new), STEP).to_numpy(zero_copy_only=False)
        if self.held() > self.limit or not short.all():
            kept = np.unique(at.to_numpy()) if self.held() > self.limit else np.arange(len(self.known))
            kept = pa.array(kept[np.append(np.ones(n, bool), short)[kept]])
            self.known, self.ids = self.known.take(kept), self.ids.take(kept)
        return found


class LibraryIds:
    """Ids of whole texts by the tokenizers library, with the end id behind each.

    Words are remembered, and so are runs of them without white space between: most runs are
    one word. Texts of Latin letters are lower-cased, split and looked up together.
    """

    def __init__(self, spec: str, end_id: int):
        self.codec = Codec(spec)
        self.kind = "<u2" if len(self.codec.tokens) <= 1 << 16 and end_id < 1 << 16 else "<u4"
        self.end, self.end_id = np.array([end_id], self.kind).tobytes(), end_id
        model, code = self.codec.library.model.tokenize, np.dtype(self.kind).char

        def of(word: str) -> bytes:
            return array(code, [t.id for t in model(word)]).tobytes()

        split = self.codec.latin.findall if self.codec.latin else None

        def run(text: str) -> bytes:
            # Letters only are one word.
            return of(in_symbols(text)) if text.isalpha() else b"".join(map(latin.__getitem__, split(text)))

        latin = Remembered(lambda word: of(in_symbols(word)), WORD_BYTES)
        self.bytes_of = {True: Remembered(run, WORD_BYTES), False: Remembered(of, WORD_BYTES)}
        self.runs = Runs(run, self.kind, RUN_BYTES)
        # What the short cut leaves to the library, spells an added token out, or is lower-cased to several characters.
        left = "".join(rf"\x{{{c:x}}}" for c in range(LATIN_END) if chr(c) in NOT_SPACE or len(chr(c).lower()) > 1)
        spelled = (re.sub(r"([!-/:-@[-`{-~])", r"\\\1", content) for content in self.codec.added)
        self.alone = "|".join([rf"[{left}\x{{{LATIN_END:x}}}-\x{{10ffff}}]", *spelled])

    def __call__(self, text: str) -> np.ndarray:
        parts = []
        for piece in self.codec.pieces(text, runs=True):
            if isinstance(piece, int):
                parts.append(np.array([piece], self.kind).tobytes())
            else:
                parts.append(b"".join(map(self.bytes_of[piece[0]].__getitem__, piece[1])))
        parts.append(self.end)
        return np.frombuffer(b"".join(parts), self.kind)

    def together(self, texts: pa.StringArray) -> Iterator[np.ndarray]:
        """The ids of each text."""
        if self.codec.latin is None:
            yield from map(self, texts.to_pylist())
            return
        alone = pc.match_substring_regex(texts, self.alone)
        lower = pc.utf8_lower(texts.filter(pc.invert(alone)))
        # No word goes on from a letter to a mark, so that words come apart from the marks behind them.
        runs = pc.utf8_split_whitespace(pc.replace_substring_regex(lower, MARKED, r"\1 \2"))
        found = self.runs.find(runs.values)
        ends = found.offsets.to_numpy()[runs.offsets.to_numpy()[1:]]
        ids, ends = np.insert(found.values.to_numpy(), ends, self.end_id), ends + np.arange(1, len(ends) + 1)
        odd, at, done = iter(texts.filter(alone).to_pylist()), iter(ends.tolist()), 0
        for by_itself in alone.to_pylist():
            if by_itself:
                yield self(next(odd))
            else:
                begin, done = done, next(at)
                yield ids[begin:done]

    def of_texts(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text; up to ``TEXT_BYTES`` of text are taken together, longer texts by themselves."""
        ends, first = np.cumsum(pc.binary_length(texts).to_numpy(), dtype=np.int64), 0
        while first < len(texts):
            before = int(ends[first - 1]) if first else 0
            stop = int(np.searchsorted(ends, before + TEXT_BYTES, side="right"))
            if stop == first:
                stop += 1
                yield self(texts[first].as_py())
            else:
                yield from self.together(texts.slice(first, stop - first).cast(pa.string()))
            first = stop


_encoders: dict[tuple[int, int], LibraryIds] = {}


def _writer(folder: str, spec, end_id: int, shard_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        named = (hash(spec.value), end_id)
        if named not in _encoders:
            _encoders[named] = LibraryIds(spec.value, end_id)
        encode, partition = _encoders[named], TaskContext.get().partitionId()
        # The tables of words are large and hold no cycles: looking for some costs a tenth of the time.
        gc.disable()
        ids, docs, starts, base, shard = [], [], [0], 0, 0

        def close() -> pa.RecordBatch:
            nonlocal ids, docs, starts, base, shard
            name = f"part-{partition:06d}-{shard:06d}.wm"
            matrix = WaveletMatrix.build(np.concatenate(ids), docs, starts, partition, base)
            files.put(folder, name, matrix.to_bytes())
            row = pa.RecordBatch.from_arrays(
                [pa.array([partition], pa.int32()), pa.array([shard], pa.int32()), pa.array([name]), pa.array([len(docs)]), pa.array([starts[-1]])],
                ["partition", "shard", "name", "n_docs", "n_tokens"],
            )
            ids, docs, base, shard = [], [], base + starts[-1], shard + 1
            starts = [0]
            return row

        for batch in batches:
            doc_ids, no_ids, texts = batch.columns
            for doc, null, found in zip(doc_ids.to_pylist(), no_ids.to_pylist(), encode.of_texts(texts)):
                ids.append(found)
                docs.append(None if null else doc)
                starts.append(starts[-1] + len(found))
                if starts[-1] >= shard_tokens:
                    yield close()
        if docs:
            yield close()
        gc.enable()

    return run


def write(
    df: DataFrame, folder: str, path: str, id_col: str = "doc_id", text: str = "text", end_id: int = 2,
    shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """Encode, append ``end_id`` to each document and write the shards. Returns the manifest.

    Texts cross the network once, to be in order.
    """
    ship(df.sparkSession)
    spec = df.sparkSession.sparkContext.broadcast(read_spec(path))
    rows = df.select(
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(0)).alias("doc_id"),
        F.col(id_col).isNull().alias("no_id"), whole(text).alias("text"),
    )
    # One order for both, so that it holds across partitions; a text itself is no fit bound.
    order = ["no_id", "doc_id", F.xxhash64("text")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return materialize(ordered.mapInArrow(_writer(folder, spec, end_id, shard_tokens), MANIFEST))


def shards(spark: SparkSession, folder: str) -> DataFrame:
    """The files of a folder, one row each. A file is no larger than a shard."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*.wm").load(folder)


def read_documents(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """Per document, from the files alone: its start among all ids, their number and CRC-32."""
    ship(spark)
    totals = manifest.groupBy("partition").agg(F.sum("n_tokens").alias("n")).orderBy("partition").collect()
    if not totals:
        return spark.createDataFrame([], ROWS)
    offsets, at = {}, 0
    for row in totals:
        offsets[row["partition"]] = at
        at += row["n"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for data in batch["content"]:
                matrix = WaveletMatrix.from_bytes(data)
                ids = matrix.decode().astype("<u4", copy=False)
                begin = matrix.starts.astype(np.int64)
                docs = pd.array(matrix.docs, "Int64")
                docs[~matrix.has_id] = pd.NA
                yield pd.DataFrame({
                    "doc_id": docs,
                    "start": begin[:-1] + matrix.base + offsets[matrix.partition],
                    "n_tokens": np.diff(begin),
                    "ids_crc32": [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(begin, begin[1:])],
                })

    return shards(spark, folder).select("content").mapInPandas(run, ROWS)


def token_counts(spark: SparkSession, folder: str, token: int) -> DataFrame:
    """How often and where a token occurs in each shard, without decoding the shard."""
    ship(spark)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, data in zip(batch["path"], batch["content"]):
                matrix = WaveletMatrix.from_bytes(data)
                yield pd.DataFrame({"path": [name], "n": [matrix.count(token)], "positions": [matrix.locate(token).tolist()]})

    return shards(spark, folder).select("path", "content").mapInPandas(run, "path STRING, n BIGINT, positions ARRAY<BIGINT>")


def shard_report(df: DataFrame, path: str, shard_tokens: int = SHARD_TOKENS, **names: str) -> DataFrame:
    """Write the shards to a new shared folder and read every document back."""
    folder = new_path(df.sparkSession)
    manifest = write(df, folder, path, shard_tokens=shard_tokens, **names)
    return read_documents(df.sparkSession, folder, manifest)
