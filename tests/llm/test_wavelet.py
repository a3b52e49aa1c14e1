import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from tokenizers import Tokenizer

from swipelens.llm import wavelet
from swipelens.llm.bpe import CHUNK, LATIN_END, STEP, read_spec
from swipelens.session import new_path

PATH = public_tokenizers.path("word_bpe_49k.json")


def brute(rows):
    library = Tokenizer.from_file(PATH)
    out, at = [], 0
    def place(row):
        by_text = int(np.uint64(xxhash.xxh64_intdigest(row[1] or "", 42)).view(np.int64))
        return row[0] is None, row[0] or 0, by_text

    for doc, text in sorted(rows, key=place):
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((doc, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def listed(found):
    return sorted((tuple(r) for r in found.collect()), key=lambda r: r[1])


@pytest.mark.parametrize("shard_tokens", [50, wavelet.SHARD_TOKENS])
def test_documents_come_back(spark, documents, shard_tokens):
    want = brute([(r["doc_id"], r["text"]) for r in documents.collect()])
    found = wavelet.shard_report(documents.repartition(7), PATH, shard_tokens)
    assert found.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert listed(found) == want


def test_odd_rows(spark):
    rows = [(5, None), (None, "b a"), (None, None), (3, ""), (3, "x"), (3, "x"), (-1, "日本 <|endoftext|>"), (9, "w " * 50_000)]
    frame = spark.createDataFrame([(d, t, "z") for d, t in rows], "doc_id BIGINT, text STRING, n_tokens STRING")
    assert listed(wavelet.shard_report(frame, PATH, 4)) == brute(rows)
    assert wavelet.shard_report(frame.limit(0), PATH).count() == 0


@pytest.mark.parametrize("n,top", [(1, 1), (7, 2), (511, 5), (512, 70_000), (5000, 49_408), (3000, 1)])
def test_matrix(n, top):
    draw = np.random.default_rng(n)
    ids = draw.integers(0, top, n).astype("<u4")
    matrix = wavelet.WaveletMatrix.build(ids, [4, None], [0, n // 2, n], 3, 17)
    back = wavelet.WaveletMatrix.from_bytes(matrix.to_bytes())
    assert (back.n, back.partition, back.base, back.has_id.tolist()) == (n, 3, 17, [True, False])
    assert (np.concatenate(list(back.slice(0, n))) == ids).all() and (back.decode() == ids).all()
    at = draw.integers(0, n, 50)
    assert (back.access(at) == ids[at]).all()
    for token in {int(ids[0]), int(ids[-1]), 0, top - 1, top + 5, 1 << 20}:
        low, high = sorted(draw.integers(0, n + 1, 2).tolist())
        assert back.count(token) == (ids == token).sum()
        assert back.count(token, low, high) == (ids[low:high] == token).sum()
        assert back.locate(token, low, high).tolist() == [i for i in range(low, high) if ids[i] == token]


def test_select_inverts_rank():
    bits = np.random.default_rng(1).random(3000) < 0.3
    plane = wavelet.Plane.of(bits)
    assert plane.select(True, np.arange(bits.sum())).tolist() == np.flatnonzero(bits).tolist()
    assert plane.select(False, np.arange((~bits).sum())).tolist() == np.flatnonzero(~bits).tolist()
    assert plane.rank(np.arange(3001)).tolist() == [0, *np.cumsum(bits).tolist()]


def test_lookup_across_shards(spark, documents):
    folder = new_path(spark)
    manifest = wavelet.write(documents, folder, PATH, shard_tokens=5000)
    found = wavelet.token_counts(spark, folder, 2).collect()
    # Every document ends in the end id, and the word pieces never have that id here.
    assert len(found) == manifest.count() > 1
    assert sum(r["n"] for r in found) >= documents.count()
    assert all(len(r["positions"]) == r["n"] for r in found)


@pytest.fixture(scope="module")
def encoder():
    return wavelet.LibraryIds(read_spec(PATH), 2)


def odd_texts():
    texts = [f"{a}{chr(c)}{b}{chr(c)} {chr(c)}" for c in [*range(LATIN_END + 40), 0x2028, 0x3000, 0x65E5] for a, b in (("it", "s"), ("X.", " 'S!"))]
    texts += ["", " ", "Plain words, and (plain) words.", "a.,b c.. d!' e?'s f:'ll", "it's,we've.I'm;", "A<|endoftext|>b", "a<|endoftext|", "1.5,2;x3.", "É.È,é!"]
    return texts + ["ha" * 3000 + ". " + "é" * 2000 + ",", "w, " * CHUNK + "\x1c!!! b", "x" * CHUNK + "y" * 9 + "."]


@pytest.mark.parametrize("text_bytes", [1, 700, wavelet.TEXT_BYTES])
@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_texts_together_equal_the_library(encoder, monkeypatch, text_bytes, kind):
    monkeypatch.setattr(wavelet, "TEXT_BYTES", text_bytes)
    library, texts = Tokenizer.from_file(PATH), odd_texts()
    found = list(encoder.of_texts(pa.array(["cut off", *texts], kind).slice(1)))
    assert len(found) == len(texts)
    for text, ids in zip(texts, found):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids + [2], repr(text[:50])
    assert list(encoder.of_texts(pa.array([], kind))) == []
    assert [len(ids) for ids in encoder.of_texts(pa.array(["\u65e5", "\x1c"], kind))] == [2, 2]


def test_other_tokenizers_take_texts_one_by_one(encoder, monkeypatch):
    texts = odd_texts()
    want = [ids.tolist() for ids in encoder.of_texts(pa.array(texts))]
    monkeypatch.setattr(encoder.codec, "latin", None)
    assert [ids.tolist() for ids in encoder.of_texts(pa.array(texts))] == want


def test_each_run_is_computed_once(encoder):
    computed = []
    runs = wavelet.Runs(lambda run: computed.append(run) or run.encode("utf-16-le"), "<u2", 1 << 20)
    for words in (["a", "bc", "a", ""], ["bc", "d", "d", "a"], []):
        assert runs.find(pa.array(words, pa.string())).to_pylist() == [list(map(ord, w)) for w in words]
    assert computed == ["a", "bc", "", "d"]
    # A word and the marks behind it are runs of their own: no word is computed again for a mark.
    table = wavelet.LibraryIds(read_spec(PATH), 2)
    list(table.of_texts(pa.array(["Word word, word. word; (word!", "word?"])))
    assert table.runs.known.to_pylist() == ["word", ",", ".", ";", "(word", "!", "?"]


def test_runs_are_bounded_by_bytes():
    runs = wavelet.Runs(lambda run: run.encode("utf-16-le"), "<u2", 10_000)
    for i in range(300):
        words = [f"word {i + j}" for j in range(30)] + ["x" * (STEP + 1 + i), "y" * STEP]
        assert runs.find(pa.array(words)).to_pylist() == [list(map(ord, w)) for w in words]
        assert runs.held() < 12_000 and len(runs.known) == len(runs.ids)
        assert max(map(len, runs.known.to_pylist())) == STEP and set(words[:30]) <= set(runs.known.to_pylist())
