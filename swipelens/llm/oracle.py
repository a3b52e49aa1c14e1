"""SQL twins of the named queries that SQL can express, for DuckDB."""

from __future__ import annotations

from swipelens.llm import divergence, host_rules, mixing
from swipelens.llm.secret_scan import BASE_RULES, RULES, Rule
from swipelens.llm.warc import REVISIT_BYTES

#: White space and symbols as in the operators, in the notation of the SQL engine.
_GAP = r"[\x20\x09-\x0D]+"
_GAP_CHARS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _words(text: str) -> str:
    return f"list_filter(string_split_regex(coalesce({text}, ''), '{_GAP}'), lambda x: x <> '')"


def document_metrics(source: str) -> str:
    """CTE list: ``measured`` holds the metrics of every row of ``source`` (unique doc_id)."""
    return f"""
split_docs AS (
    SELECT *, {_words('text')} AS w,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: trim(l, {_GAP_CHARS}) <> '') AS l
    FROM {source}
),
positions AS (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM split_docs),
windows AS (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n FROM positions
),
repeats AS (
    SELECT doc_id, count(DISTINCT j) AS n_repeat_words
    FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM windows WHERE n > 1) GROUP BY doc_id
),
metrics AS (
    SELECT d.* EXCLUDE (w, l), CAST(len(w) AS BIGINT) AS n_words,
           CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
           CAST(len(regexp_extract_all(coalesce(text, ''), '{host_rules.SYMBOLS}')) AS BIGINT) AS n_symbols,
           CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
           CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
    FROM split_docs d LEFT JOIN repeats USING (doc_id)
),
measured AS (
    SELECT *, n_words < {host_rules.MIN_WORDS}
              OR 100 * n_repeat_words > {host_rules.MAX_REPEAT_PERCENT} * n_words AS base_failed
    FROM metrics
),
hosts AS (
    SELECT source, count(*) AS n, sum(base_failed::INT) AS x FROM measured WHERE source IS NOT NULL GROUP BY source
),
moments AS (
    SELECT count(*) AS k, sum(n)::DOUBLE AS t, sum(x) / sum(n) AS r, sum(n::DOUBLE * n) AS nn,
           sum(x::DOUBLE * x / n) AS xx FROM hosts
),
prior AS (
    SELECT r, CASE WHEN between_hosts <= 0 OR r * (1 - r) <= 0 THEN t
                   ELSE least(t, greatest(1.0, r * (1 - r) / between_hosts - 1)) END AS strength
    FROM (SELECT *, CASE WHEN t - nn / t > 0 THEN (xx - t * r * r - r * (1 - r) * (k - 1)) / (t - nn / t)
                         ELSE 0 END AS between_hosts FROM moments)
),
judged AS (
    SELECT m.*, NOT base_failed AND NOT coalesce((h.x + p.r * p.strength) / (h.n + p.strength) > 0.5, false) AS kept
    FROM measured m LEFT JOIN hosts h ON m.source = h.source LEFT JOIN prior p ON true
)"""


def _spans_of(order: int, rule: Rule) -> str:
    pattern = "'" + rule.pattern.replace("'", "''") + "'"
    return f"""
    SELECT doc_id, {order} AS k, '{rule.kind}' AS kind, s, s + length(hits[i]) AS e
    FROM (SELECT *, list_sum(list_transform(gaps[1:i], lambda x: length(x)))
                    + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS s
          FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i
                FROM (SELECT doc_id, regexp_extract_all(t, {pattern}) AS hits,
                             regexp_extract_all(t, {pattern}, {rule.group}) AS sized,
                             string_split_regex(t, {pattern}) AS gaps
                      FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents))))
    WHERE length(sized[i]) >= {rule.least}"""


def secret_spans() -> str:
    """Spans of every rule by splitting at the matches (unique doc_id)."""
    listed = "string_agg(kind || ':' || s::BIGINT || ':' || e::BIGINT, ',' ORDER BY s, k)"
    counts = ", ".join(f"count(*) FILTER (k = {i}) AS n_{r.kind}" for i, r in enumerate(BASE_RULES))
    return f"""
WITH spans AS ({" UNION ALL ".join(_spans_of(i, r) for i, r in enumerate(RULES))}),
lists AS (
    SELECT doc_id, {counts}, {listed} FILTER (k < {len(BASE_RULES)}) AS base, {listed} AS spans
    FROM spans GROUP BY doc_id
)
SELECT d.doc_id, {", ".join(f"coalesce(n_{r.kind}, 0)::BIGINT AS n_{r.kind}" for r in BASE_RULES)},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN lists USING (doc_id)"""


def mixture() -> str:
    """Targets by caps in order of their ratio, then the cut along the hash keys (unique doc_id)."""
    weights = ", ".join(map(str, mixing.WEIGHTS))
    up, down = mixing.SHARE
    return f"""
WITH d AS (
    SELECT doc_id, source, CAST(len({_words('text')}) AS BIGINT) AS size,
           CAST('0x' || substr(md5('{mixing.SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 15) AS BIGINT) AS k
    FROM documents
),
s AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS n,
           [{weights}][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)}] AS w
    FROM d GROUP BY source
),
a AS (
    SELECT *, sum(n) OVER () AS all_n, sum(w) OVER () AS all_w,
           sum({mixing.MOST} * n) OVER o AS caps, sum(w) OVER o AS ws
    FROM s WINDOW o AS (ORDER BY {mixing.MOST} * n / w::DOUBLE)
),
f AS (SELECT *, {down} * (caps * w + {mixing.MOST} * n * (all_w - ws)) <= {up} * all_n * w AS is_full FROM a),
t AS (
    SELECT source, n, CASE WHEN is_full THEN CAST({mixing.MOST} * n AS DOUBLE) ELSE
        CAST(({up} * all_n - {down} * coalesce(sum({mixing.MOST} * n) FILTER (is_full) OVER (), 0)) * w AS DOUBLE)
        / CAST({down} * (all_w - coalesce(sum(w) FILTER (is_full) OVER (), 0)) AS DOUBLE) END AS target
    FROM f
),
p AS (
    SELECT doc_id, size, n AS source_size, target,
           CASE WHEN n > 0 THEN CAST(floor(target) AS BIGINT) // n ELSE 0 END AS passes,
           CAST(floor(target) AS BIGINT) AS budget,
           sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id ROWS UNBOUNDED PRECEDING) - size AS before
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       CAST(passes * size + greatest(0, least(size, budget - passes * source_size - before)) AS BIGINT) AS taken
FROM p"""


def source_divergence() -> str:
    """Every group's share of every kept term, and sums over all of them (unique doc_id)."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    share = f"1 + (CAST({{}} AS HUGEINT) + 2) * {divergence.SCALE} // ({{}} + 2 * v)"
    f = "(p - q) * (p - q) // (p + q)"
    ranked = "row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)"
    return f"""
WITH d AS (
    SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           translate(coalesce(text, ''), '{upper}', '{upper.lower()}') AS t FROM documents
),
tokens AS (
    SELECT doc_id, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
),
kept AS (SELECT lang, term FROM tokens GROUP BY ALL HAVING count(DISTINCT doc_id) >= {divergence.MIN_DOCS}),
counts AS (SELECT lang, source, term, count(*) AS c FROM tokens JOIN kept USING (lang, term) GROUP BY ALL),
vocabulary AS (SELECT lang, count(*) AS v FROM kept GROUP BY ALL),
cells AS (
    SELECT lang, source, term, coalesce(c, 0) AS c, v, CAST(sum(coalesce(c, 0)) OVER (PARTITION BY lang, source) AS HUGEINT) AS n
    FROM (SELECT DISTINCT lang, source FROM d) JOIN kept USING (lang) JOIN vocabulary USING (lang)
    LEFT JOIN counts USING (lang, source, term)
),
shares AS (SELECT *, {share.format('c', 'n')} AS p FROM cells),
whole AS (
    SELECT lang, term, {share.format('sum(c)', 'CAST(any_value(all_n) AS HUGEINT)')} AS q
    FROM (SELECT *, sum(c) OVER (PARTITION BY lang) AS all_n FROM cells) GROUP BY lang, term, v
),
sums AS (
    SELECT lang, source, item, sum({f}) AS value
    FROM shares JOIN (SELECT lang, term, source AS item, p AS q FROM shares) o USING (lang, term)
    WHERE source <> item GROUP BY ALL
),
pairs AS (
    SELECT a.lang, a.source, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
    FROM (SELECT DISTINCT lang, source FROM d) a JOIN (SELECT DISTINCT lang, source FROM d) b
      ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
),
terms AS (
    SELECT lang, source, term AS item, CAST({f} AS BIGINT) AS value
    FROM shares JOIN whole USING (lang, term) WHERE c > 0 AND p > q
)
SELECT lang, source, 'pair' AS part, item, value, CAST({ranked} AS INT) AS rank FROM pairs
UNION ALL
SELECT lang, source, 'term', item, value, CAST({ranked} AS INT) FROM terms QUALIFY {ranked} <= {divergence.TOP}"""


ORACLE: dict[str, str] = {
    "op5_host_quality": f"""
WITH {document_metrics('documents')}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM judged""",
    "op6_secret_scan": secret_spans(),
    "op8_warc": f"""
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= {REVISIT_BYTES} AND page_id < first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= {REVISIT_BYTES} AND page_id < first THEN first END AS refers_to
FROM (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS n, sha1(coalesce(html, '')) AS digest,
             max(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages)""",
    "op9_mixing": mixture(),
    "op11_divergence": source_divergence(),
}
