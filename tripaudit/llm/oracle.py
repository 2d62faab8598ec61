"""DuckDB statements for the queries that SQL can express."""

from __future__ import annotations

from tripaudit.llm import centroids, filter_audit, host_rules, license_scan

_WORDS = "list_filter(string_split_regex({text}, '{gap}'), lambda x: x <> '')"


def _template_rows() -> str:
    rows = []
    both = [(t, label, "true") for t, label in license_scan.PHRASES] + [(t, label, "false") for t, label in license_scan.SENTENCES]
    for number, (text, label, base) in enumerate(both):
        words = text.split()
        rows += [f"({number}, '{label}', {base}, {len(words) - 1}, {i}, '{words[i]} {words[i + 1]}')" for i in range(len(words) - 1)]
    return ", ".join(rows)


def host_rules_sql() -> str:
    words = _WORDS.format(text="coalesce(text, '')", gap="[\\x09-\\x0D\\x20]+")
    return f"""
WITH w AS (
  SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t, {words} AS ws FROM documents
), win AS (
  SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)
), dup AS (SELECT doc_id, g FROM win GROUP BY ALL HAVING count(*) > 1
), rep AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM win JOIN dup USING (doc_id, g)) GROUP BY doc_id
), lines AS (
  SELECT doc_id, count(*) - count(DISTINCT l) AS n
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM w) WHERE trim(l, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) <> ''
  GROUP BY doc_id
), counted AS (
  SELECT doc_id, host, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^{host_rules.SYMBOLS}]+', '', 'g'))::BIGINT AS n_symbols,
    coalesce(lines.n, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
    len(string_split(t, chr(10))) AS n_lines
  FROM w LEFT JOIN rep USING (doc_id) LEFT JOIN lines USING (doc_id)
), judged AS (
  SELECT *, n_words < {host_rules.MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    n_symbols * 10 > n_words OR n_dup_lines * 10 > n_lines * 3 OR word_chars < 2 * n_words OR word_chars > 15 * n_words AS mild
  FROM counted
), hosts AS (
  SELECT host, count(*) AS n, sum((base_failed OR mild)::INT) AS f FROM judged GROUP BY host
), sums AS (SELECT sum(n) AS n, sum(f) AS f, count(*) AS k, sum(f * f / n) AS ff, sum(f) / sum(n) AS m FROM hosts
), spread AS (SELECT m, (ff - f * m - m * (1 - m) * (k - 1)) / n AS b FROM sums
), prior AS (
  SELECT m, CASE WHEN b > 0 AND m > 0 AND m < 1 THEN least(1e6, greatest(1.0, m * (1 - m) / b - 1)) ELSE 1e6 END AS s FROM spread
), rates AS (SELECT host, (f + m * s) / (n + s) AS rate FROM hosts, prior
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND rate < {host_rules.BLOCKED} AND (rate < {host_rules.WATCHED} OR NOT mild) AS kept
FROM judged JOIN rates USING (host)
"""


def license_scan_sql() -> str:
    words = _WORDS.format(text=f"translate(coalesce(text, ''), '{license_scan.UPPER}', '{license_scan.UPPER.lower()}')", gap=license_scan.WORD_GAP)
    return f"""
WITH tpl(t, label, base, pairs, pos, gram) AS (VALUES {_template_rows()}
), w AS (SELECT doc_id, {words} AS ws FROM documents
), votes AS (
  SELECT doc_id, t, label, base, pairs, pos, i - 1 - pos AS diagonal
  FROM (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] AS gram FROM (SELECT doc_id, ws, unnest(range(1, len(ws))) AS i FROM w))
  JOIN tpl USING (gram)
), diagonals AS (
  SELECT doc_id, t, label, base, pairs, diagonal, list(DISTINCT pos) AS hits FROM votes GROUP BY ALL
), gaps AS (
  SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY doc_id, t ORDER BY diagonal) > {license_scan.MERGE} THEN 1 ELSE 0 END AS gap
  FROM diagonals
), numbered AS (SELECT *, sum(gap) OVER (PARTITION BY doc_id, t ORDER BY diagonal) AS span FROM gaps
), spans AS (
  SELECT doc_id, t, label, base, pairs, span, len(list_distinct(flatten(list(hits)))) / pairs AS share,
    count(*) FILTER (len(hits) = pairs) AS places, min(diagonal) FILTER (len(hits) = pairs) AS a, max(diagonal) FILTER (len(hits) = pairs) AS z
  FROM numbered GROUP BY doc_id, t, label, base, pairs, span
), found AS (
  SELECT doc_id, sum(places) FILTER (base) AS n_base, min(a) FILTER (base) AS a, max(z) FILTER (base) AS z,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base AND places > 0) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER ((base AND places > 0) OR (NOT base AND share >= {license_scan.COVERAGE})) AS labels,
    max(share) AS score
  FROM spans GROUP BY doc_id
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, a::BIGINT AS first_word, z::BIGINT AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
FROM w LEFT JOIN found USING (doc_id)
"""


JACCARD_JOIN_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x09-\\x0D\\x20]+'), lambda x: x <> '') AS raw FROM documents
), lowered AS (
  SELECT doc_id, list_transform(raw, lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS ws FROM w
), s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(ws) < 5 THEN array_to_string(ws, ' ') ELSE array_to_string(ws[i:i + 4], ' ') END AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM lowered WHERE len(ws) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), met AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS m FROM s x JOIN s y USING (g) WHERE x.doc_id < y.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM met JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * m >= 75 * (x.n + y.n - m)
), either AS (SELECT a, b FROM links UNION SELECT b, a FROM links
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM reach r JOIN either e ON r.b = e.a
)
SELECT documents.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id
FROM documents LEFT JOIN n USING (doc_id)
JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) c USING (doc_id)
"""


def filter_audit_sql() -> str:
    words = _WORDS.format(text="coalesce(text, '')", gap="[\\x09-\\x0D\\x20]+")
    letters = ", ".join(f"('{letter}', {1 << i})" for i, letter in enumerate(filter_audit.FILTERS))
    size = len(filter_audit.FILTERS)
    names = [f"f{i}" for i in range(size)]
    pairs = [f"{a}.l <> {b}.l" for i, a in enumerate(names) for b in names[i + 1 :]]
    steps = " UNION ALL ".join(
        f"SELECT {' || '.join(f'{n}.l' for n in names)} AS filter_order, {i + 1} AS step, {names[i]}.l AS l, {names[i]}.bit AS bit, "
        f"{' + '.join(['0', *(f'{n}.bit' for n in names[:i])])} AS before FROM {', '.join(f'f {n}' for n in names)} WHERE {' AND '.join(pairs)}"
        for i in range(size)
    )
    return f"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, {words} AS ws FROM documents
), least AS (SELECT t, min(doc_id) AS first FROM d GROUP BY t
), flags AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
), masked AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    (len(ws) < {filter_audit.MIN_WORDS})::INT + 2 * (100 * len(list_distinct(ws)) < 65 * len(ws))::INT
    + 4 * (100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 5 * length(t))::INT
    + 8 * regexp_matches(t, '[{filter_audit.SYMBOLS}]')::INT + 16 * coalesce(doc_id > first, false)::INT AS mask
  FROM d JOIN least USING (t) LEFT JOIN flags USING (doc_id)
), c AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM masked GROUP BY part, mask
), f(l, bit) AS (VALUES {letters}
), steps AS ({steps}
), rows AS (
  SELECT part, filter_order, step, l, coalesce(sum(n) FILTER (mask & before = 0 AND mask & bit = 0), 0) AS kept,
    coalesce(sum(n) FILTER (mask & before = 0 AND mask & bit > 0), 0) AS removed,
    coalesce(sum(n) FILTER (mask & before > 0 AND mask & bit > 0), 0) AS redundant,
    coalesce(sum(n) FILTER (mask = bit), 0) AS unique_fails,
    coalesce(sum(good) FILTER (mask & before = 0 AND mask & bit > 0), 0) AS good_lost,
    coalesce(sum(toxic) FILTER (mask & before = 0 AND mask & bit > 0), 0) AS toxic_lost
  FROM c, steps GROUP BY part, filter_order, step, l
)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
  unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  (sum(removed) OVER (PARTITION BY part, l))::BIGINT AS shapley
FROM rows
"""


def centroids_sql() -> str:
    size = centroids.DIMENSIONS
    fine = "list_filter(embedding, lambda v: v IS NOT NULL AND isfinite(v))"
    parts = [f"""
WITH v AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda v: floor({centroids.SCALE} * v::DOUBLE)::BIGINT) AS x
  FROM embeddings WHERE len(embedding) = {size} AND len({fine}) = {size}
), e AS MATERIALIZED (SELECT vec_id, unnest(range({size})) AS j, unnest(x) AS x FROM v
), seeds AS (SELECT x, row_number() OVER (ORDER BY sha256('{centroids.SEED}' || vec_id), vec_id) - 1 AS k FROM v
), c0 AS MATERIALIZED (SELECT k, unnest(range({size})) AS j, unnest(x) AS c FROM seeds WHERE k < {centroids.CLUSTERS}"""]
    for r in range(centroids.ROUNDS + 1):
        parts.append(f"""
), a{r} AS MATERIALIZED (
  SELECT vec_id, k, d FROM (SELECT vec_id, k, sum((x - c) * (x - c)) AS d FROM e JOIN c{r} USING (j) GROUP BY vec_id, k)
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, k) = 1""")
        if r < centroids.ROUNDS:
            parts.append(f"""
), s{r} AS (SELECT k, j, sum(x) AS s, count(*) AS n FROM a{r} JOIN e USING (vec_id) GROUP BY k, j
), c{r + 1} AS MATERIALIZED (
  SELECT k, j, CASE WHEN n IS NULL THEN c ELSE ((s - ((s % n) + n) % n) // n)::BIGINT END AS c FROM c{r} LEFT JOIN s{r} USING (k, j)""")
    last = centroids.ROUNDS
    parts.append(f"""
), digests AS (SELECT k, sha256(string_agg(c::VARCHAR, ',' ORDER BY j)) AS digest FROM c{last} GROUP BY k)
SELECT vec_id, k::INT AS cluster, d::BIGINT AS distance, (sum(d) OVER (PARTITION BY k))::BIGINT AS cluster_inertia,
  (sum(d) OVER ())::BIGINT AS inertia, digest AS centroid_sha256
FROM a{last} JOIN digests USING (k)
""")
    return "".join(parts)


ORACLE_SQL = {
    "op7_host_rules": host_rules_sql(),
    "op9_jaccard_join": JACCARD_JOIN_SQL,
    "op10_license_scan": license_scan_sql(),
    "op11_filter_audit": filter_audit_sql(),
    "op13_centroids": centroids_sql(),
}
