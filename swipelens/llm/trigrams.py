"""Trigrams that a text must contain for a regular expression to match it.

A query is a set of clauses, each a set of lower-case trigrams: the text must hold every
trigram of at least one clause. The query with the empty clause holds for every text. The
condition is necessary, never sufficient, so candidates are verified with the expression.
"""

from __future__ import annotations

from itertools import product
from re import _constants as op  # the parser of the standard library, on the driver only
from re import _parser

Query = frozenset[frozenset[str]]

ANY: Query = frozenset([frozenset()])
#: Beyond so many strings or clauses a part of the expression is replaced by "any text".
MOST = 64


def _absorb(clauses) -> Query:
    """Drop every clause that another one implies; too many become "any text"."""
    kept = [c for c in clauses if not any(other < c for other in clauses)]
    return frozenset(kept) if len(kept) <= MOST else ANY


def both(a: Query, b: Query) -> Query:
    return _absorb({x | y for x, y in product(a, b)})


def either(a: Query, b: Query) -> Query:
    return _absorb(a | b)


def of_strings(strings: set[str]) -> Query:
    """The text holds one of the strings."""
    return _absorb({frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings})


def _walk(items) -> tuple[set[str] | None, Query]:
    """The exact strings that a sequence can match, if few, and its query otherwise."""
    query, runs, exact = ANY, {""}, True
    for kind, value in items:
        strings, inner = _one(kind, value)
        if strings is not None and len(runs) * len(strings) <= MOST:
            runs = {a + b for a, b in product(runs, strings)}
            continue
        query = both(query, of_strings(runs))
        exact, runs = False, {""}
        if strings is not None:
            runs = strings
        else:
            query = both(query, inner)
    if exact:
        return runs, ANY
    return None, both(query, of_strings(runs))


def _one(kind, value) -> tuple[set[str] | None, Query]:
    if kind is op.LITERAL:
        return {chr(value).lower()}, ANY
    if kind is op.IN:
        chars = {chr(v).lower() for k, v in value if k is op.LITERAL}
        small = all(k is op.LITERAL for k, _ in value) and len(chars) <= 8
        return (chars if small else None), ANY
    if kind is op.SUBPATTERN:
        return _walk(value[3])
    if kind is op.BRANCH:
        exact, query = set(), frozenset()
        for strings, inner in map(_walk, value[1]):
            exact = None if exact is None or strings is None else exact | strings
            query = either(query, of_strings(strings) if strings is not None else inner)
        if exact is not None and len(exact) <= MOST:
            return exact, ANY
        return None, query
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT):
        low, high, items = value
        strings, inner = _walk(items)
        if strings is not None and (low, high) == (0, 1):
            return strings | {""}, ANY
        if low == 0:
            return None, ANY
        if strings is None:
            return None, inner
        if low == high and len(strings) == 1:
            return {s * low for s in strings}, ANY
        return None, of_strings({s * min(low, MOST) for s in strings} if len(strings) == 1 else strings)
    if kind is op.AT or kind in (op.ASSERT, op.ASSERT_NOT):
        return {""}, ANY
    return None, ANY


def trigram_query(pattern: str) -> Query:
    """Necessary trigrams of a pattern, in lower case, whether or not it minds the case."""
    strings, query = _walk(_parser.parse(pattern))
    return of_strings(strings) if strings is not None else query
