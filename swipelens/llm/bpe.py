"""Byte-pair encoding as a streaming transducer, and decoding as a state machine.

A token at the end of what has been read may still change with what follows; one that ends
``lookahead`` symbols earlier cannot. The lookahead is computed from the merge list: a merge
whose right part ends at some place can be undone only by an earlier merge that takes a token
off the right end of that part, and that merge in turn only by a still earlier one on its own
right. Ranks fall along such a chain, so its longest total length is found in rank order.

Every word runs through the transducer: tokens are emitted once they are stable or the word
ends, and the buffer keeps the rest, so memory does not grow with the length of a word or text.
At a word's end the transducer is where it began, so what it emits for a word can be remembered:
tasks do so in tables of bounded bytes. Ids are decoded one by one by the state machine.

The tokenizer file names the normalizer, the splitting pattern and the merges. For words of
Latin letters the common normalizer and pattern are applied here; every other word, and every
other tokenizer, goes through the library's own normalizer and splitter.

Edge cases: a null text is the empty text, which has no tokens. Repeated rows give repeated
results. An empty table gives an empty result. Further columns pass through; input columns
named like a result column are replaced.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import re
import sys
import unicodedata
from array import array
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from swipelens.llm.common import free_names, ship, whole

#: Bytes per generation that a task remembers of words' ids, and of words' digests' parts.
REMEMBERED_BYTES = 24 << 20
SUMMARY_BYTES = 64 << 20
#: Token ids per batch that a task hands on.
BATCH_IDS = 1 << 20
#: Symbols read at once from a long word, and characters from a long text.
STEP = 512
CHUNK = 1 << 16
RESULTS = ["n_tokens", "ids_sha256", "decoded_sha256"]

#: The normalizer and pattern that the short cut for Latin words stands for.
KNOWN_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
KNOWN_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: One past the last character of the short cut, and white space below it.
LATIN_END = 0x180
LATIN_SPACE = "\t\n\x0b\x0c\r \x85\xa0"
#: Controls that Python takes for white space and the library does not.
NOT_SPACE = "\x1c\x1d\x1e\x1f"


def byte_symbols() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


UTF8 = codecs.getincrementaldecoder("utf-8")
SYMBOL_OF_BYTE = byte_symbols()
BYTE_OF_SYMBOL = {s: b for b, s in SYMBOL_OF_BYTE.items()}


def in_symbols(word: str) -> str:
    """The word's bytes in the symbols of byte-level vocabularies."""
    if word.isascii() and word.isprintable():
        return word
    return "".join([SYMBOL_OF_BYTE[b] for b in word.encode()])


class MergeList:
    """Ranked merges over token ids, with the lookahead that makes tokens stable."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str = ""):
        self.vocab, self.suffix = vocab, suffix
        self.ranks: dict[tuple[int, int], int] = {}
        self.made: dict[tuple[int, int], int] = {}
        born = {vocab[a + b]: rank for rank, (a, b) in enumerate(merges)}
        for rank, (a, b) in enumerate(merges):
            pair = (vocab[a], vocab[b])
            if max(born.get(pair[0], -1), born.get(pair[1], -1)) >= rank or born[vocab[a + b]] != rank:
                raise ValueError("a merge uses a token that only a later merge makes, or makes one twice")
            self.ranks[pair], self.made[pair] = rank, vocab[a + b]
        self.by_rank, self.none = list(self.made.values()), len(merges)
        self.lookahead, self.longest = self._lookahead(born)
        self.window = self.lookahead + self.longest + STEP

    def _lookahead(self, born: dict[int, int]) -> tuple[int, int]:
        parts = {self.made[p]: p for p in self.ranks}
        length: dict[int, int] = {}
        for pair, rank in sorted(self.ranks.items(), key=lambda x: x[1]):
            length[self.made[pair]] = length.get(pair[0], 1) + length.get(pair[1], 1)
        # Per left token: ranks of the merges that take it, and the longest reach up to each.
        taken: dict[int, tuple[list[int], list[int]]] = {}

        def reach(token: int, bound: float) -> int:
            """Symbols right of ``token`` that can keep it from being there at rank ``bound``."""
            most = 0
            while True:
                if token in taken:
                    ranks, best = taken[token]
                    at = bisect_left(ranks, bound)
                    if at:
                        most = max(most, best[at - 1])
                if token not in parts:
                    return most
                bound, token = born[token], parts[token][1]

        for pair, rank in sorted(self.ranks.items(), key=lambda x: x[1]):
            need = length.get(pair[1], 1) + reach(pair[1], rank)
            ranks, best = taken.setdefault(pair[0], ([], []))
            ranks.append(rank)
            best.append(max(need, best[-1]) if best else need)
        tokens = set(self.vocab.values())
        return max((reach(t, float("inf")) for t in tokens), default=0), max(length.values(), default=1)

    def merge(self, ids: list[int]) -> list[int]:
        """Apply the merges by rank, leftmost first."""
        if len(ids) > 64:
            return self._merge_long(ids)
        rank_of, made, none = self.ranks.get, self.by_rank, self.none
        ids = list(ids)
        ranks = [rank_of(p, none) for p in zip(ids, ids[1:])]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            i = ranks.index(best)
            new = made[best]
            ids[i:i + 2] = (new,)
            del ranks[i]
            if i:
                ranks[i - 1] = rank_of((ids[i - 1], new), none)
            if i < len(ranks):
                ranks[i] = rank_of((new, ids[i + 1]), none)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap over a linked list, for long inputs."""
        ids, right = list(ids), list(range(1, len(ids) + 1))
        left, end = list(range(-1, len(ids) - 1)), len(ids)
        heap = [(self.ranks[p], i, p) for i, p in enumerate(zip(ids, ids[1:])) if p in self.ranks]
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = right[i]
            if ids[i] != pair[0] or j >= end or ids[j] != pair[1]:
                continue
            ids[i], ids[j], right[i] = self.made[pair], -1, right[j]
            if right[j] < end:
                left[right[j]] = i
            for a, b in ((left[i], i), (i, right[i])):
                if a >= 0 and b < end and (ids[a], ids[b]) in self.ranks:
                    heapq.heappush(heap, (self.ranks[ids[a], ids[b]], a, (ids[a], ids[b])))
        return [t for t in ids if t >= 0]

    def stream(self, symbols: Iterable[str], lengths: dict[int, int]) -> Iterator[int]:
        """Ids of one word whose symbols arrive one by one; holds ``window`` symbols at most."""
        buffer: list[int] = []
        last = None
        for symbol in symbols:
            if last is not None and last in self.vocab:
                buffer.append(self.vocab[last])
            last = symbol
            if len(buffer) >= self.window:
                stable = len(buffer) - self.lookahead
                done = 0
                for token in self.merge(buffer):
                    if done + lengths[token] > stable:
                        break
                    done += lengths[token]
                    yield token
                buffer = buffer[done:]
        if last is not None and last + self.suffix in self.vocab:
            buffer.append(self.vocab[last + self.suffix])
        yield from self.merge(buffer)


class Remembered(dict):
    """Results of the keys seen lately: those of this generation and of the one before.

    A generation ends when its entries take ``limit`` bytes. Those of very long keys are not kept.
    """

    def __init__(self, compute, limit: int):
        super().__init__()
        self.compute, self.limit, self.before, self.held = compute, limit, {}, 0

    def __missing__(self, key):
        if len(key) > STEP:
            return self.compute(key)
        if self.held >= self.limit:
            self.before, self.held = dict(self), 0
            self.clear()
        value = self.before.get(key)
        if value is None:
            value = self.compute(key)
        self[key] = value
        # Two words for the slot of the table, which is at least a third empty, and its hash.
        self.held += sys.getsizeof(key) + sys.getsizeof(value) + 48
        if isinstance(value, tuple):
            self.held += sum(map(sys.getsizeof, value))
        return value

    def forget(self) -> None:
        self.clear()
        self.before, self.held = {}, 0


class IncrementalDecoder:
    """Text of ids that arrive one by one.

    ``joined`` is the text of a tokenizer file without a decoder: the tokens with a space
    between them. Otherwise the tokens' bytes are turned into text as soon as a character is
    complete: the state is the bytes of an unfinished one, and whether a word has ended.
    """

    def __init__(self, tokens: list[str], suffix: str, special: frozenset[int], joined: bool):
        self.tokens, self.suffix, self.special, self.joined = tokens, suffix, special, joined
        self.started = False
        self.utf8 = UTF8("replace")

    def feed(self, token_id: int) -> str:
        token = self.tokens[token_id]
        if self.joined:
            piece = " " + token if self.started else token
            self.started = True
            return piece
        if token_id in self.special:
            return self.utf8.decode(b"", True) + token
        ends = bool(self.suffix) and token.endswith(self.suffix)
        body = token[:-len(self.suffix)] if ends else token
        raw = bytes(BYTE_OF_SYMBOL[c] for c in body if c in BYTE_OF_SYMBOL)
        return self.utf8.decode(raw + (b" " if ends else b""))

    def finish(self) -> str:
        return self.utf8.decode(b"", True)


class Codec:
    """One tokenizer file, ready to encode and decode texts."""

    _open: dict[str, "Codec"] = {}

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        data = json.loads(spec)
        model = data["model"]
        if model["type"] != "BPE" or model.get("dropout") or model.get("byte_fallback") or model.get("unk_token"):
            raise ValueError("only plain BPE tokenizer files are supported")
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.merges = MergeList(model["vocab"], merges, self.suffix)
        self.library = Tokenizer.from_str(spec)
        added = {t["content"]: t["id"] for t in data.get("added_tokens", [])}
        self.special = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True)))) if added else None
        self.added = added
        names = {i: t for t, i in (model["vocab"] | added).items()}
        self.tokens = [names.get(i, "") for i in range(max(names) + 1)]
        self.joined = data.get("decoder") is None
        self.lengths = {i: max(1, len(t.removesuffix(self.suffix))) for i, t in enumerate(self.tokens)}
        self.latin = self._latin_pattern() if self._is_known(data) else None
        self.special_ids = frozenset(added.values())
        self.odd = re.compile(f"[^\x00-{chr(LATIN_END - 1)}]")
        # By spelling: of Latin words as they stand in the text, of others in the model's symbols.
        self.ids_of = {
            True: Remembered(self.latin_ids, REMEMBERED_BYTES), False: Remembered(self.symbol_ids, REMEMBERED_BYTES),
        }
        self.summary_of = {
            True: Remembered(lambda w: self.summarize(self.latin_ids(w)), SUMMARY_BYTES),
            False: Remembered(lambda w: self.summarize(self.symbol_ids(w)), SUMMARY_BYTES),
        }

    @classmethod
    def of(cls, spec: str) -> "Codec":
        """The codec of a file, kept by the worker from one batch to the next."""
        name = hashlib.md5(spec.encode()).hexdigest()
        if name not in cls._open:
            cls._open[name] = cls(spec)
        return cls._open[name]

    def forget(self) -> None:
        """Give up what is remembered, and memory of batches that are gone."""
        for remembered in (*self.ids_of.values(), *self.summary_of.values()):
            remembered.forget()
        pa.default_memory_pool().release_unused()

    @staticmethod
    def _is_known(data: dict) -> bool:
        normal = [n["type"] for n in (data.get("normalizer") or {}).get("normalizers", [])]
        splits = (data.get("pre_tokenizer") or {}).get("pretokenizers", [])
        return (
            normal == KNOWN_NORMALIZERS and len(splits) == 2
            and splits[0].get("pattern") == {"Regex": KNOWN_PATTERN} and splits[0].get("invert") is True
            and splits[0].get("behavior") == "Removed"
            and splits[1]["type"] == "ByteLevel" and not splits[1]["add_prefix_space"] and not splits[1]["use_regex"]
        )

    @staticmethod
    def _latin_pattern() -> re.Pattern:
        """The known pattern for characters below LATIN_END, with its classes spelled out."""
        def of(kind: str) -> str:
            return "".join(rf"\u{c:04x}" for c in range(LATIN_END) if unicodedata.category(chr(c))[0] == kind)

        letters, digits, space = of("L"), of("N"), "".join(rf"\u{ord(c):04x}" for c in LATIN_SPACE)
        return re.compile(
            KNOWN_PATTERN.replace(r"[^\s\p{L}\p{N}]", f"[^{space}{letters}{digits}]")
            .replace(r"[\p{L}]", f"[{letters}]").replace(r"[\p{N}]", f"[{digits}]")
        )

    def symbol_ids(self, word: str) -> array:
        """Ids of one word of the model, spelled in its symbols: the transducer from word to word."""
        return array("i", self.merges.stream(word, self.lengths))

    def latin_ids(self, word: str) -> array:
        return self.symbol_ids(in_symbols(word))

    def is_latin(self, text: str) -> bool:
        """Whether the short cut holds for a text; the cheap tests settle it for most."""
        if self.latin is None or any(c in text for c in NOT_SPACE):
            return False
        if text.isascii():
            return True
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return not self.odd.search(text)
        return True

    def pieces(self, text: str, runs: bool = False) -> Iterator[int | tuple[bool, list[str]]]:
        """Ids of added tokens that the text spells out, and between them lists of words.

        Whether the words are Latin ones as they stand comes with each list. Long texts are
        cut at white space, where no word goes on. With ``runs`` Latin text comes as lower-case
        runs between white space, which ``latin`` splits into words.
        """
        at = 0
        spelled = any(content in text for content in self.added)
        for hit in [*(self.special.finditer(text) if spelled else ()), None]:
            end = hit.start() if hit else len(text)
            while at < end:
                stop = min(end, at + CHUNK)
                if self.latin is None:
                    stop = end
                # Where the library sees white space, no word goes on.
                while stop < end and (not text[stop].isspace() or text[stop] in NOT_SPACE):
                    stop += 1
                chunk, at = text[at:stop], stop
                if self.is_latin(chunk):
                    yield True, chunk.lower().split() if runs else self.latin.findall(chunk.lower())
                else:
                    normal = self.library.normalizer.normalize_str(chunk) if self.library.normalizer else chunk
                    yield False, [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)]
            if hit:
                yield self.added[hit[0]]
                at = hit.end()

    def encode(self, text: str) -> array:
        found = array("i")
        for piece in self.pieces(text):
            if isinstance(piece, int):
                found.append(piece)
            else:
                for ids in map(self.ids_of[piece[0]].__getitem__, piece[1]):
                    found.extend(ids)
        return found

    def decoder(self) -> IncrementalDecoder:
        return IncrementalDecoder(self.tokens, self.suffix, self.special_ids, self.joined)

    def decode(self, ids: Iterable[int]) -> Iterator[str]:
        machine = self.decoder()
        yield from map(machine.feed, ids)
        yield machine.finish()

    def text_of(self, ids: Iterable[int]) -> str:
        return "".join(self.decode(ids))

    def digest_of(self, ids: Iterable[int]) -> str:
        """SHA-256 of the decoded text, taken in as the decoder gives it out."""
        digest, pieces = hashlib.sha256(), []
        for piece in self.decode(ids):
            pieces.append(piece)
            if len(pieces) >= CHUNK:
                digest.update("".join(pieces).encode())
                pieces.clear()
        digest.update("".join(pieces).encode())
        return digest.hexdigest()

    def summarize(self, ids: array) -> tuple[int, bytes, bytes]:
        """Number of ids, the ids as decimals, and their text."""
        return len(ids), " ".join(map(str, ids)).encode(), self.text_of(ids).encode()

    def digests(self, text: str) -> tuple[int, str, str]:
        """Number of ids, SHA-256 of the ids as decimals, SHA-256 of the decoded text.

        Without a decoder the decoded text of two words is that of each with a space between,
        so the digests are fed piece by piece.
        """
        if not self.joined:
            ids = self.encode(text)
            listed = " ".join(map(str, ids)).encode()
            return len(ids), hashlib.sha256(listed).hexdigest(), self.digest_of(ids)
        total, listed, decoded, between = 0, hashlib.sha256(), hashlib.sha256(), b""
        for piece in self.pieces(text):
            if isinstance(piece, int):
                found = [self.summarize(array("i", [piece]))]
            else:
                found = map(self.summary_of[piece[0]].__getitem__, piece[1])
            # A word without any token that the vocabulary knows leaves no trace.
            found = [f for f in found if f[0]]
            if found:
                counts, ids, texts = zip(*found)
                total += sum(counts)
                listed.update(between + b" ".join(ids))
                decoded.update(between + b" ".join(texts))
                between = b" "
        return total, listed.hexdigest(), decoded.hexdigest()


def read_spec(path: str) -> str:
    """The tokenizer file, read on the driver; a vocabulary has a few megabytes."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def encode(df: DataFrame, path: str, text: str = "text", name: str = "ids") -> DataFrame:
    """Add the token ids of every text as an array."""
    ship(df.sparkSession)
    spec = df.sparkSession.sparkContext.broadcast(read_spec(path))

    @F.pandas_udf("array<int>")
    def of(texts: pd.Series) -> pd.Series:
        codec = Codec.of(spec.value)
        return pd.Series([np.frombuffer(codec.encode(t), np.int32) for t in texts], dtype=object)

    return df.withColumn(name, of(whole(text)))


def decode(df: DataFrame, path: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """Add the text of every array of ids; null ids give the empty text."""
    ship(df.sparkSession)
    spec = df.sparkSession.sparkContext.broadcast(read_spec(path))

    @F.pandas_udf("string")
    def of(lists: pd.Series) -> pd.Series:
        codec = Codec.of(spec.value)
        return pd.Series(["" if x is None else codec.text_of(x) for x in lists], dtype=object)

    return df.withColumn(name, of(F.col(ids)))


def transcode(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Replace the text by ``n_tokens``, its ``ids``, and the SHA-256 of what they decode to.

    One pass, no shuffle. Ids leave a task in batches of about ``BATCH_IDS``, the decoded text
    not at all.
    """
    ship(df.sparkSession)
    spec = df.sparkSession.sparkContext.broadcast(read_spec(path))
    made = T.StructType.fromDDL("n_tokens BIGINT, ids ARRAY<INT>, decoded_sha256 STRING").fields
    replaced = {text.lower(), *(f.name.lower() for f in made)}
    kept = [c for c in df.columns if c.lower() not in replaced]
    body = free_names(df, "body")[0]
    schema = T.StructType([*[df.schema[c] for c in kept], *made])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(spec.value)

        def record(rows: pa.RecordBatch, found: list[array], digests: list[str]) -> pa.RecordBatch:
            ends = np.cumsum([0, *map(len, found)])
            ids = np.frombuffer(b"".join(map(memoryview, found)), np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids))
            columns = [rows.column(i) for i in range(len(kept))]
            return pa.RecordBatch.from_arrays(
                [*columns, pa.array(np.diff(ends), pa.int64()), lists, pa.array(digests, pa.string())],
                [*kept, *[f.name for f in made]],
            )

        for batch in batches:
            texts, first, found, digests, held = batch.column(len(kept)), 0, [], [], 0
            for at in range(batch.num_rows):
                found.append(codec.encode(texts[at].as_py()))
                digests.append(codec.digest_of(found[-1]))
                held += len(found[-1])
                if held >= BATCH_IDS:
                    yield record(batch.slice(first, len(found)), found, digests)
                    first, found, digests, held = at + 1, [], [], 0
            if found:
                yield record(batch.slice(first), found, digests)
        # Workers stay while other stages run, which need the memory.
        codec.forget()

    return df.select(*[F.col(f"`{c}`") for c in kept], whole(text).alias(body)).mapInArrow(run, schema)


def digests(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Add ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``. One pass, no shuffle."""
    ship(df.sparkSession)
    spec = df.sparkSession.sparkContext.broadcast(read_spec(path))

    @F.pandas_udf("n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    def of(texts: pd.Series) -> pd.DataFrame:
        codec = Codec.of(spec.value)
        return pd.DataFrame(list(map(codec.digests, texts)), columns=RESULTS)

    kept = [c for c in df.columns if c not in RESULTS]
    (found,) = free_names(df, "found")
    return df.select(*kept, of(whole(text)).alias(found)).select(*kept, *[f"{found}.{c}" for c in RESULTS])
