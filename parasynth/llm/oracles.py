"""SQL counterparts (DuckDB) of the queries of this package."""

from __future__ import annotations

from . import quality_rules as q


def _beyond(value: str, cutoffs: list[float]) -> str:
    return " + ".join(f"({value} > {c!r}::DOUBLE)::INT" for c in cutoffs)


def quality_rules() -> str:
    """Windows and lines by unnesting, thresholds from the binomial distribution by lgamma."""
    values = {
        "symbols_per_word": "n_symbols / greatest(n_words, 1)::DOUBLE",
        "dup_line_share": "n_dup_lines / greatest(n_lines, 1)::DOUBLE",
        "repeat_word_share": "n_repeat_words / greatest(n_words, 1)::DOUBLE",
        "word_length": "word_chars / greatest(n_words, 1)::DOUBLE",
        "short_words": "greatest(n_words, 1) / greatest(word_chars, 1)::DOUBLE",
    }
    beyond = ", ".join(_beyond(v, q.LADDERS[r]) for r, v in values.items())
    p = q.MAX_FALSE_REJECTION
    return rf"""
    WITH d AS (
      SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS t,
             regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
             list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
      FROM documents),
    win AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM d)),
    rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1),
    cov AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM rep, (SELECT unnest(range(0, 3)) AS k) GROUP BY doc_id),
    m AS (
      SELECT d.doc_id, stratum, len(ws) AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
             length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
             len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words, len(ls) AS n_lines
      FROM d LEFT JOIN cov ON d.doc_id = cov.doc_id),
    r AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, {q.LEVELS + 1} - greatest({beyond}) AS lvl FROM m),
    held AS (SELECT stratum, lvl FROM r WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)),
    s AS (SELECT stratum, count(*) AS n, (SELECT count(DISTINCT stratum) FROM held) AS n_strata FROM held GROUP BY stratum),
    k AS (SELECT stratum, n, n_strata, t, (SELECT count(*) FROM held h WHERE h.stratum = s.stratum AND h.lvl <= t) AS k FROM s, (SELECT unnest(range(1, {q.LEVELS + 1})) AS t)),
    tail AS (
      SELECT stratum, t, n_strata, CASE WHEN k >= n * {p} THEN 1.0 ELSE (
        SELECT sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({p}) + (n - i) * ln(1 - {p}))) FROM (SELECT unnest(range(0, k + 1)) AS i)) END AS p
      FROM k),
    best AS (SELECT stratum, coalesce(min(CASE WHEN p > {q.ERROR} / n_strata THEN t END) - 1, {q.LEVELS}) AS level FROM tail GROUP BY stratum)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND lvl > coalesce(level, 0) AS kept
    FROM r LEFT JOIN best ON r.stratum = best.stratum"""


def line_templates(min_docs: int, depth: int, similarity: float, long: int, long_docs: int) -> str:
    """Lines unnested, templates as strings, votes per place of a leaf."""
    leaf = " || ' ' || ".join(["len(toks)", *[f"toks[{i + 1}]" for i in range(depth)]])
    return rf"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
    x AS (SELECT doc_id, t, unnest(range(0, len(ls))) AS n, unnest(ls) AS line FROM d),
    y AS (SELECT doc_id, t, n, list_transform(list_filter(regexp_split_to_array(line, '[ \t\x0B\f\r]+'), lambda w: w <> ''),
                 lambda w: CASE WHEN regexp_matches(w, '[0-9]') THEN '<*>' ELSE w END) AS toks FROM x),
    z AS (SELECT *, array_to_string(toks, ' ') AS f FROM y WHERE len(toks) > 0),
    rf AS (SELECT f, arg_min(t, doc_id) AS ft FROM z GROUP BY f HAVING count(DISTINCT t) >= CASE WHEN max(len(toks)) >= {long} THEN {long_docs} ELSE {min_docs} END),
    v AS (SELECT *, {leaf} AS leaf, toks[{depth + 1}:] AS p FROM z WHERE len(toks) > {depth}),
    w AS (SELECT * FROM v WHERE leaf IN (SELECT leaf FROM v GROUP BY leaf HAVING count(*) >= {min_docs} AND count(DISTINCT f) > 1)),
    u AS (SELECT doc_id, n, leaf, unnest(range(0, len(p))) AS pos, unnest(p) AS w FROM w),
    votes AS (SELECT leaf, pos, w, count(*) AS c FROM u GROUP BY ALL),
    fixed AS (SELECT leaf, pos, arg_max(w, c) AS w FROM votes GROUP BY leaf, pos HAVING 2 * max(c) > sum(c)),
    held AS (SELECT doc_id, n, count(*) AS c FROM u JOIN fixed USING (leaf, pos, w) GROUP BY doc_id, n),
    g AS (SELECT w.* FROM w JOIN held USING (doc_id, n) WHERE c >= {similarity} * len(p)),
    rg AS (SELECT leaf, arg_min(t, doc_id) AS ft FROM g GROUP BY leaf HAVING count(DISTINCT t) >= {min_docs}),
    m AS (SELECT doc_id, n FROM z JOIN rf USING (f) WHERE t <> ft UNION SELECT doc_id, n FROM g JOIN rg USING (leaf) WHERE t <> ft),
    drops AS (SELECT doc_id, list(n) AS ns FROM m GROUP BY doc_id)
    SELECT d.doc_id, len(ls) AS n_lines, coalesce(len(ns), 0) AS n_dropped,
           array_to_string(list_filter(ls, lambda l, i: ns IS NULL OR NOT list_contains(ns, i - 1)), chr(10)) AS text
    FROM d LEFT JOIN drops USING (doc_id)"""


def licenses(templates: list[tuple[str, str]], least: float) -> str:
    """Units unnested and joined with the templates."""
    values = ", ".join(f"({i}, '{name}', '{wording.replace(chr(39), chr(39) * 2)}')" for i, (name, wording) in enumerate(templates))
    words = r"list_filter(string_split(lower(regexp_replace({}, '[^A-Za-z0-9]+', ' ', 'g')), ' '), lambda w: w <> '')"
    grams = "list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]))"
    return rf"""
    WITH t AS (SELECT name, {grams} AS b FROM (SELECT name, {words.format('wording')} AS ws FROM (VALUES {values}) v(i, name, wording))),
    u AS (
      SELECT doc_id, unnest(list_distinct(string_split(t, chr(10)) || regexp_split_to_array(t, '\n[ \t]*\n') || [t])) AS unit
      FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)),
    a AS (SELECT doc_id, {grams} AS a FROM (SELECT doc_id, {words.format('unit')} AS ws FROM u) WHERE len(ws) > 1),
    m AS (
      SELECT doc_id, max({{'d': dice, 'n': name}}) AS top FROM (
        SELECT doc_id, a, name, 2 * len(list_intersect(a, b)) / (len(a) + len(b)) AS dice FROM a, t)
      WHERE dice >= {least} GROUP BY doc_id, a),
    g AS (SELECT doc_id, max(top) AS best, list_sort(list(DISTINCT top.n)) AS names, count(*) AS n FROM m GROUP BY doc_id)
    SELECT d.doc_id, best.n AS license, round(best.d, 6) AS dice, coalesce(array_to_string(names, ','), '') AS licenses, coalesce(n, 0) AS n_units
    FROM documents d LEFT JOIN g USING (doc_id)"""


def warc() -> str:
    """Digests as base32 of the hexadecimal SHA-1, five bits at a time."""
    return """
    WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
    d AS (SELECT page_id, strlen(h) AS payload_bytes, sha1(h) AS s FROM p),
    b AS (SELECT *, array_to_string(list_transform(range(0, 32), lambda i:
              substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(s, (5 * (i // 4) + 1)::INT, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31) + 1)::INT, 1)), '') AS payload_digest
          FROM d),
    k AS (SELECT s, max(page_id) AS keeper FROM d GROUP BY s)
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN keeper IS NULL OR page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN keeper IS NULL OR page_id = keeper THEN NULL ELSE keeper END AS refers_to
    FROM b JOIN k USING (s)"""
