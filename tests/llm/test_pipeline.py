import hashlib
import re
from collections import defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as P
from tests.llm.test_host_rules import brute as metrics
from tests.llm.test_mixing import brute_targets, n_words
from tests.llm.test_secret_scan import redacted
from tests.llm.test_simhash import brute_groups, brute_print

SF = "/root/testdata/sf0.001"


def stage(name):
    return dict(P.STAGES)[name]


def test_stages_in_order():
    assert [n for n, _ in P.STAGES] == ["quality rules", "simhash near-dedup", "secret scans", "mixing sources", "bpe encoding"]


@pytest.fixture(scope="module")
def rows(spark):
    return [r.asDict() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


def clean(rows):
    """Documents that pass by their own text; no host of this table is bad."""
    found = []
    for r in rows:
        n, _, _, _, repeated = metrics(r["text"])
        if n >= 50 and 100 * repeated <= 50 * n:
            found.append(r)
    return found


def test_run_equals_brute_force(spark, rows):
    docs = clean(rows)
    assert 0 < len(docs) < len(rows)
    groups = brute_groups([r["doc_id"] for r in docs], [brute_print(r["text"]) for r in docs], 4)
    docs = [dict(r, text=redacted(r["text"])) for r, g in zip(docs, groups) if r["doc_id"] == g]
    sizes = defaultdict(int)
    for r in docs:
        sizes[r["source"]] += n_words(r["text"])
    targets = brute_targets(sizes)
    found = P.run(spark, SF).collect()
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    by_id, source_words = defaultdict(list), defaultdict(int)
    for r in found:
        by_id[r["doc_id"]].append(r["ids"])
    for r in docs:
        whole = library.encode(r["text"], add_special_tokens=False).ids
        copies = by_id.pop(r["doc_id"], [])
        assert len(copies) <= 2
        for ids in copies:
            assert ids == whole
            source_words[r["source"]] += n_words(r["text"])
    assert not by_id
    longest = max(n_words(r["text"]) for r in docs)
    for source, target in targets.items():
        # The document in which the budget ends is taken once more or not.
        assert abs(source_words[source] - target) <= longest / 2 + 1


def test_stages_keep_the_columns_and_handle_odd_rows(spark):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [
        (1, good, "en", "a", len(good)), (1, good, "en", "a", len(good)), (None, good + " x", None, None, None),
        (3, None, "en", "a", 0), (4, "", "en", "a", 0), (5, good.replace("w5", "password=abcdefgh1"), "en", "b", 9),
        (6, " ".join(f"z{i}" for i in range(40_000)), "en", "b", 9),
    ]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT")
    for _, function in P.STAGES[:-1]:
        docs = function(spark, docs, SF)
        assert docs.columns == P.COLUMNS
        left = docs.collect()
        assert left and all(not re.search("password=", r["text"] or "") or function is not P.secrets for r in left)
    assert {r["doc_id"] for r in P.encode(spark, docs, SF).collect()} <= {1, None, 5, 6}


def test_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, function in P.STAGES:
        docs = function(spark, docs, SF)
        assert docs.count() == 0


def test_last_stage_decodes_its_ids(spark):
    texts = ["plain words go here", "naïve façade, 北京 &  two  spaces\n\ttabs", "", None]
    rows = [(i, t, "en", "a", 0) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT")
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    found = {r["doc_id"]: r for r in P.encode(spark, docs, SF).collect()}
    assert len(found) == len(texts)
    for i, text in enumerate(texts):
        want = library.decode(library.encode(text or "", add_special_tokens=False).ids, skip_special_tokens=False)
        assert found[i]["decoded_sha256"] == hashlib.sha256(want.encode()).hexdigest()
