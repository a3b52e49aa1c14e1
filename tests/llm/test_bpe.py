import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from swipelens.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id BIGINT, text STRING, n_tokens STRING, ids STRING"
ODD = [
    "", " \n\t", "a<|endoftext|>b <|startoftext|><|endoftext|>", "İstanbul ΑΣ ΣΑΣ ß ẞ Å é café", "日本語 テスト。a　b",
    "x\x1cy \x1d z", "it's I'LL we've '''s", "á̧ ́", "123 4½ ²³ ٣ Ⅷ", "\x00\x01\x7f\x80\x85\xa0\xad", "😀👍🏽 emoji‍",
    "a" * 5000, "ha" * 3000, "é" * 2000, "of the " * 30_000, "ƏƐƜ Ÿ ŉ",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec.of(bpe.read_spec(PATH))


def digests(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    listed, text = " ".join(map(str, ids)), library.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()


def mixture(draw):
    parts = ["a", "th", "in", "<|endoftext|>", " ", "\n", "é", "ß", "1", "'s", "!!", "́", "日", "\x85", "\x1f", "İ", "Σ", "😀"]
    return "".join(draw.choice([*parts, chr(draw.randrange(0x2C00))]) for _ in range(draw.randrange(1, 14)))


def test_odd_texts_equal_the_library(codec, library):
    draw = random.Random(3)
    for text in [*ODD, *(mixture(draw) for _ in range(1500))]:
        assert list(codec.encode(text)) == library.encode(text, add_special_tokens=False).ids, repr(text)
        assert codec.digests(text) == digests(library, text), repr(text)


@pytest.mark.parametrize("space", ["\x1c", "\x1d", "\x1e", "\x1f", " ", "\x85", "\xa0", "\u2028", "\u3000", "\u180e", "\u200b"])
def test_long_texts_are_cut_where_the_library_parts_words(codec, library, space):
    for tail in ("a!" + space + "!!! b", "a" + space + "bc " + space + "!" + space, "'" + space + "s it's" + space * 3):
        for short in (0, 1, 2):
            text = "a " * (bpe.CHUNK // 2 - short) + tail
            assert list(codec.encode(text)) == library.encode(text, add_special_tokens=False).ids
            assert codec.digests(text) == digests(library, text)


def test_tables_are_bounded_by_bytes():
    table = bpe.Remembered(lambda key: (len(key), key.encode()), 10_000)
    for i in range(2_000):
        assert table[f"word {i}"] == (len(f"word {i}"), f"word {i}".encode())
        assert table.held < 11_000 and len(table) + len(table.before) < 200


def test_transcode_equals_the_library(spark, library, monkeypatch):
    texts = [*ODD, None, "long " * 3000]
    rows = [(i, t, "en", "x", "y") for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING, ids STRING, body STRING").repartition(2)
    found = bpe.transcode(frame, PATH)
    assert found.columns == ["doc_id", "lang", "body", "n_tokens", "ids", "decoded_sha256"]
    for r in found.collect():
        want = library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        assert r["ids"] == want and r["n_tokens"] == len(want) and r["body"] == "y"
        assert r["decoded_sha256"] == digests(library, texts[r["doc_id"]])[2]
    assert bpe.transcode(frame.limit(0), PATH).count() == 0


def test_query_equals_the_library(spark, library):
    frame = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = bpe.digests(frame, PATH).collect()
    assert len(rows) == frame.count()
    for r in rows:
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == digests(library, r["text"])


def test_nulls_clashes_and_empty_tables(spark, library):
    frame = spark.createDataFrame([(1, None, "x", "y"), (1, None, "x", "y"), (None, "A b", "x", "y")], SCHEMA)
    rows = bpe.digests(frame, PATH).collect()
    assert sorted(r["n_tokens"] for r in rows) == [0, 0, 2] and rows[0]["ids"] == "y"
    assert rows[0]["ids_sha256"] == hashlib.sha256(b"").hexdigest()
    assert bpe.digests(spark.createDataFrame([], SCHEMA), PATH).count() == 0
    back = bpe.decode(bpe.encode(frame, PATH), PATH).collect()
    assert sorted(r["decoded"] for r in back) == ["", "", "a</w> b</w>"]


def test_streaming_in_the_smallest_window_changes_nothing(codec):
    draw, merges = random.Random(5), codec.merges
    words = ["".join(draw.choices([*"abcdefghijklmnopqrstuvwxyz", "th", "ing", "tion", "aa"], k=draw.randrange(1, 500))) for _ in range(400)]
    wide = bpe.MergeList.__new__(bpe.MergeList)
    wide.__dict__.update(merges.__dict__, window=1 << 40)
    tight = bpe.MergeList.__new__(bpe.MergeList)
    tight.__dict__.update(merges.__dict__, window=merges.lookahead + merges.longest + 1)
    for word in words:
        assert list(tight.stream(word, codec.lengths)) == list(wide.stream(word, codec.lengths))


@pytest.mark.parametrize("seed", range(40))
def test_lookahead_of_random_merge_lists(seed):
    # Every extension of a prefix must leave the tokens alone that end a lookahead before its end.
    draw = random.Random(seed)
    vocab, merges = {c: i for i, c in enumerate("abc")}, []
    while len(merges) < 14:
        a, b = draw.choice(list(vocab)), draw.choice(list(vocab))
        if a + b not in vocab and len(a + b) < 7:
            merges.append((a, b))
            vocab[a + b] = len(vocab)
    found = bpe.MergeList(vocab, merges)
    names = {i: t for t, i in vocab.items()}
    for _ in range(200):
        word = draw.choices("abc", k=40)
        full = found.merge([vocab[c] for c in word])
        ends, at = set(), 0
        for t in full:
            at += len(names[t])
            ends.add((at, t))
        for cut in range(found.lookahead + 1, 40):
            at = 0
            for t in found.merge([vocab[c] for c in word[:cut]]):
                at += len(names[t])
                if at <= cut - found.lookahead:
                    assert (at, t) in ends


def test_merge_of_long_inputs_equals_short_ones(codec):
    draw, merges = random.Random(9), codec.merges
    for _ in range(200):
        ids = [codec.merges.vocab[c] for c in draw.choices("abehinorst", k=60)]
        assert merges.merge(ids) == merges._merge_long(ids)


def test_decoding_byte_by_byte():
    symbols = bpe.SYMBOL_OF_BYTE
    tokens = [symbols[b] for b in range(256)] + ["a</w>", "<|end|>"]
    text = "é日😀 x"
    machine = bpe.IncrementalDecoder(tokens, "</w>", frozenset([257]), joined=False)
    pieces = [machine.feed(b) for b in text.encode()]
    assert "".join(pieces) == text and pieces[0] == "" and pieces[1] == "é"
    # A character that stays unfinished is replaced.
    assert machine.feed(0xE6) == "" and machine.feed(257) == "�<|end|>" and machine.feed(256) == "a "


def test_merge_lists_that_use_later_tokens_are_refused():
    with pytest.raises(ValueError):
        bpe.MergeList({"a": 0, "b": 1, "ab": 2, "abb": 3}, [("ab", "b"), ("a", "b")])


def test_what_is_forgotten_is_found_again(codec):
    text = "Plain words and \u4e2d\u6587 and plain words"
    ids, digests = list(codec.encode(text)), codec.digests(text)
    assert any(codec.ids_of.values()) and any(codec.summary_of.values())
    codec.forget()
    for remembered in (*codec.ids_of.values(), *codec.summary_of.values()):
        assert not remembered and not remembered.before and not remembered.held
    assert list(codec.encode(text)) == ids and codec.digests(text) == digests
