import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from swipelens.llm import divergence

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING"


def brute(rows, min_docs, top=10):
    """Shares of all groups and terms, term by term, from (text, lang, source)."""
    rows = [(t or "", lang or "", s or "") for t, lang, s in rows]
    found = []
    for lang in {r[1] for r in rows}:
        docs, groups = Counter(), defaultdict(Counter)
        for text, own, source in rows:
            if own == lang:
                low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
                terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
                docs.update(set(terms))
                groups[source].update(terms)
        kept = [t for t, n in docs.items() if n >= min_docs]

        def shares(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10 ** 9 * (counts[t] + 2) // (total + 2 * len(kept)) for t in kept}

        def f(p, q):
            return (p - q) ** 2 // (p + q)

        share_of = {s: shares(c) for s, c in groups.items()}
        whole = shares(sum(groups.values(), Counter()))
        for source, own in share_of.items():
            pairs = [(-sum(f(own[t], q[t]) for t in kept), s) for s, q in share_of.items() if s != source]
            terms = [(-f(own[t], whole[t]), t) for t in kept if groups[source][t] and own[t] > whole[t]]
            for part, listed in (("pair", sorted(pairs, key=lambda x: (x[0], x[1].encode()))),
                                 ("term", sorted(terms, key=lambda x: (x[0], x[1].encode()))[:top])):
                found += [(lang, source, part, item, -v, i) for i, (v, item) in enumerate(listed, 1)]
    return sorted(found)


def audit(df, **options):
    return sorted(tuple(r) for r in divergence.audit(df, **options).collect())


def test_documents_equal_brute_force(spark, documents):
    rows = [(r["text"], r["lang"], r["source"]) for r in documents.collect()]
    assert audit(documents) == brute(rows, 10)


@pytest.mark.parametrize("block,tile", [(1, 1), (3, 2), (1 << 14, 32)])
def test_blocks_and_tiles_change_nothing(spark, block, tile, monkeypatch):
    texts = ["b a a Ünï 字x", "a b c d", "A-B_c", "d d d e", None, "", "... 12", "a\x00b", "c" * 70_000]
    rows = [(t, lang, s) for i, t in enumerate(texts) for lang in ("en", None, "") for s in ("s1", None, f"t{i % 3}")]
    monkeypatch.setattr(divergence, "BLOCK_TERMS", block)
    monkeypatch.setattr(divergence, "TILE", tile)
    df = spark.createDataFrame([(None, *r) for r in rows], SCHEMA).repartition(3)
    # Workers import the module anew, so small sizes go in with the functions.
    monkeypatch.setattr(divergence, "_encode", _with(divergence._encode, block, tile))
    monkeypatch.setattr(divergence, "_compare", _with(divergence._compare, block, tile))
    assert audit(df, min_docs=2) == brute(rows, 2)


def _with(function, block, tile):
    def run(argument):
        divergence.BLOCK_TERMS, divergence.TILE = block, tile
        return function(argument)

    return run


def test_a_language_without_terms_has_no_divergence(spark):
    df = spark.createDataFrame([(1, "a", "xx", "p"), (2, "b", "xx", "q"), (3, None, "xx", None)], SCHEMA)
    assert audit(df) == sorted(
        ("xx", a, "pair", b, 0, i) for a in ("", "p", "q") for i, b in enumerate(sorted({"", "p", "q"} - {a}), 1)
    )


def test_empty_and_clashing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert audit(empty) == []
    rows = [("a b", "en", "s"), ("a", "en", "t")] * 6
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], SCHEMA)
    named = ["idx", "term", "n", "docs", "groups", "counts", "total", "block", "item", "value", "rank", "part"]
    more = df.withColumns({n: F.lit("x") for n in named})
    assert audit(more) == audit(df) == brute(rows, 10)


def test_shares_are_exact():
    import numpy as np

    for count, total in [(2, 2), (1, 3), (10 ** 15 - 1, 10 ** 15), (123456789, 987654321987654)]:
        assert divergence.share(np.array([count]), total)[0] == 1 + 10 ** 9 * count // total
