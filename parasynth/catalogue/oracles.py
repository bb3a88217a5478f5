"""SQL counterparts of the queries, for an independent engine (DuckDB).

Written against the tables, not against the operators: ranks are plain window
ranks, distances are plain joins, regular expressions run once per pattern.
Only the random number formula is the same on purpose.
"""

import numpy as np

from .. import fixed_values as fv
from ..functions import rng
from ..functions.numeric import TAIL_DENOMINATOR, TAIL_NUMERATOR

ORACLES: dict[str, str] = {}


def _poly(coefficients, x):
    out = f"{coefficients[0]!r}::DOUBLE"
    for c in coefficients[1:]:
        out = f"({out} * {x} + ({c!r})::DOUBLE)"
    return out


def cdf(x: str) -> str:
    """Normal distribution function of a column."""
    a = f"abs({x})"
    tail = f"(exp(-({a} * {a}) / 2::DOUBLE) * {_poly(TAIL_NUMERATOR, a)} / {_poly(TAIL_DENOMINATOR, a)})"
    return f"(CASE WHEN {x} > 0 THEN 1::DOUBLE - {tail} ELSE {tail} END)"


def uniforms(source: str, row: str, streams: dict[str, tuple], prefix: str = "u") -> str:
    """CTEs ending in ``<prefix>_out`` with one uniform column per stream."""
    words = {}
    for name, k in streams.items():
        words[f"{name}_a"], words[f"{name}_b"] = (k[0], k[1]), (k[2], k[3])
    m = rng.MASK
    mult = lambda c: f"(xor({c}, {c} >> 16) * {rng.MULTIPLIER}) & {m}"
    steps = [
        lambda c, k: f"xor({row} & {m}, {k[0]})",
        lambda c, k: mult(c), lambda c, k: mult(c),
        lambda c, k: f"xor(xor({c}, {c} >> 16), ((({row} >> 32) & {m}) * {rng.HIGH_WORD} + {k[1]}) & {m})",
        lambda c, k: mult(c), lambda c, k: mult(c), lambda c, k: f"xor({c}, {c} >> 16)",
    ]
    ctes, last = [], source
    for i, step in enumerate(steps):
        columns = ", ".join(f"{step(c, k)} AS {c}" for c, k in words.items())
        rest = f"* EXCLUDE ({', '.join(words)})" if i else "*"
        ctes.append(f"{prefix}_{i} AS (SELECT {rest}, {columns} FROM {last})")
        last = f"{prefix}_{i}"
    final = ", ".join(f"(({n}_a * 1048576 + ({n}_b >> 12))::DOUBLE + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS {n}" for n in streams)
    ctes.append(f"{prefix}_out AS (SELECT * EXCLUDE ({', '.join(words)}), {final} FROM {last})")
    return ",\n".join(ctes)


def normal(u: str, v: str, cosine: bool) -> str:
    return f"sqrt(-2::DOUBLE * ln({u})) * {'cos' if cosine else 'sin'}(2::DOUBLE * pi() * {v})"


# --- profiling -------------------------------------------------------------------------


def _stats(table, columns, by=None):
    key = f"CAST({by} AS VARCHAR) AS source_id, " if by else ""
    group = f" GROUP BY {by}" if by else ""
    return " UNION ALL ".join(
        f"SELECT {key}'{c}' AS name, avg({c}) AS mean, stddev_samp({c}) AS std FROM {table}{group}" for c in columns
    )


ORACLES["profile_continuous"] = f"""
SELECT name, 'normal' AS distribution, round(mean, 4) AS mean, round(std, 4) AS std,
       round(mean - 3 * std, 4) AS min, round(mean + 3 * std, 4) AS max
FROM ({_stats("lineitem", ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])})"""

ORACLES["profile_categorical"] = """
WITH long AS (SELECT 'o_orderstatus' AS name, o_orderstatus AS label FROM orders
              UNION ALL SELECT 'o_orderpriority', o_orderpriority FROM orders),
c AS (SELECT name, label, count(*) AS n FROM long GROUP BY ALL)
SELECT name, row_number() OVER (PARTITION BY name ORDER BY label) - 1 AS code, label,
       round(n / sum(n) OVER (PARTITION BY name), 6) AS prob FROM c"""

SHARES = """
base AS (SELECT CAST({key} AS VARCHAR) AS source_id, l_quantity AS q, l_extendedprice AS e, l_linestatus AS s, l_returnflag AS f FROM lineitem),
cat AS (SELECT source_id, 'l_linestatus' AS v, s AS label, count(*) AS n FROM base GROUP BY ALL
        UNION ALL SELECT source_id, 'l_returnflag', f, count(*) FROM base GROUP BY ALL),
sh AS (SELECT source_id, v, label, n / sum(n) OVER (PARTITION BY source_id, v) AS p,
       row_number() OVER (PARTITION BY source_id, v ORDER BY label) - 1 AS code,
       count(*) OVER (PARTITION BY source_id, v) AS k FROM cat),
coded AS (SELECT b.*, a.code AS sc, c.code AS fc FROM base b
          JOIN sh a ON a.source_id = b.source_id AND a.v = 'l_linestatus' AND a.label = b.s
          JOIN sh c ON c.source_id = b.source_id AND c.v = 'l_returnflag' AND c.label = b.f),
cor AS (SELECT source_id, corr(q, fc) AS r0, corr(e, fc) AS r1, corr(sc, fc) AS r2, corr(q, e) AS r3 FROM coded GROUP BY 1),
pairs AS (SELECT source_id, 0 AS pos, 'l_quantity' AS a, 'l_returnflag' AS b, r0 AS r FROM cor
    UNION ALL SELECT source_id, 1, 'l_extendedprice', 'l_returnflag', r1 FROM cor
    UNION ALL SELECT source_id, 2, 'l_linestatus', 'l_returnflag', r2 FROM cor
    UNION ALL SELECT source_id, 3, 'l_quantity', 'l_extendedprice', r3 FROM cor)"""
WHOLE = SHARES.format(key="'table'")
BY_SUPPLIER = SHARES.format(key="l_suppkey")

ORACLES["profile_correlation"] = f"""
WITH {WHOLE}
SELECT a || '__' || b AS key, round(r, 6) AS correlation, CASE WHEN r >= 0 THEN 'positive' ELSE 'negative' END AS direction FROM pairs"""

ORACLES["profile_by_source"] = f"""
SELECT source_id, name, round(mean, 4) AS mean, round(std, 4) AS std FROM ({_stats("lineitem", ["l_quantity", "l_extendedprice"], "l_suppkey")})"""

ORACLES["describe_table"] = " UNION ALL ".join(
    f"SELECT '{c}' AS name, count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, "
    f"round(min({c}), 4) AS min, round(max({c}), 4) AS max FROM lineitem"
    for c in ("l_quantity", "l_extendedprice", "l_discount")
)

TEXT = """
phr AS (SELECT source_id, v, code, k, printf('''%s'' with probability %.4f', label, p) AS ph FROM sh),
lst AS (SELECT source_id, v, CASE WHEN any_value(k) = 2 THEN string_agg(ph, ' and ' ORDER BY code)
        ELSE string_agg(ph, ', ' ORDER BY code) FILTER (code < k - 1) || ', and ' || max(ph) FILTER (code = k - 1) END AS listed
        FROM phr GROUP BY 1, 2),
st AS (SELECT source_id, avg(q) AS mq, stddev_samp(q) AS sq, avg(e) AS me, stddev_samp(e) AS se FROM base GROUP BY 1),
lines AS (SELECT source_id, 0 AS o, printf('The variable l_quantity has mean %.4f and std %.4f.', mq, sq) AS line FROM st
    UNION ALL SELECT source_id, 1, printf('The variable l_extendedprice has mean %.4f and std %.4f.', me, se) FROM st
    UNION ALL SELECT source_id, CASE v WHEN 'l_linestatus' THEN 2 ELSE 3 END,
              'The categorical variable ' || v || ' takes value ' || listed || '.' FROM lst
    UNION ALL SELECT source_id, 4 + pos, printf('The correlation between %s and %s is %.4f.', a, b, r) FROM pairs),
texts AS (SELECT source_id, string_agg(line, chr(10) ORDER BY o) AS text FROM lines GROUP BY 1)"""

ORACLES["source_text"] = f"WITH {BY_SUPPLIER}, {TEXT} SELECT source_id, text FROM texts"

# --- extraction --------------------------------------------------------------------------

PART_TEXT = """
texts AS (SELECT CAST(p_partkey AS VARCHAR) AS source_id,
  'For ' || p_name || ' the mean is ' || printf('%.2f', p_retailprice) || ' and the standard deviation of ' || p_size || 'e-1 was found.' || chr(10)
  || 'Here SD = ' || p_size || '.5, average: -' || p_partkey || '.' || chr(10)
  || 'The correlation between size and price is 0.' || (p_partkey % 90 + 10) || ' while corr(price, size) = -.' || (p_partkey % 9 + 1) || ' elsewhere.' AS text FROM part)"""

_q = lambda s: s.replace("'", "''")


def mean_std_ctes() -> str:
    both = []
    for turn, (pattern, m, s) in enumerate(((fv.MEAN_THEN_STD, 1, 2), (fv.STD_THEN_MEAN, 2, 1))):
        take = lambda g: f"unnest(regexp_extract_all(text, '{_q(pattern)}', {g}, 'i'))"
        count = f"unnest(range(len(regexp_extract_all(text, '{_q(pattern)}', 0, 'i'))))"
        both.append(f"SELECT source_id, {turn} AS turn, {count} AS pos, CAST({take(m)} AS DOUBLE) AS mean, CAST({take(s)} AS DOUBLE) AS std FROM texts")
    return f"""
found AS ({" UNION ALL ".join(both)}),
firsts AS (SELECT source_id, mean, std, min(turn * 1000000 + pos) AS o FROM found GROUP BY 1, 2, 3),
numbered AS (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY o) AS i FROM firsts)"""


ORACLES["extract_mean_std"] = f"""
WITH {PART_TEXT}, {mean_std_ctes()}
SELECT source_id, 'var_' || i AS name, round(mean, 4) AS mean, round(std, 4) AS std,
       round(mean - 3 * std, 4) AS min, round(mean + 3 * std, 4) AS max FROM numbered"""

RUNS = f"""
runs AS (SELECT source_id, unnest(regexp_extract_all(text, '{_q(r"categorical\s+variable\s+(\w+)\s+takes\s+value\s+((?:'[^']+'\s+with\s+probability\s+" + fv.PROBABILITY + fv.CATEGORY_JOINER + ")+)")}', 1, 'i')) AS name,
    unnest(regexp_extract_all(text, '{_q(r"categorical\s+variable\s+(\w+)\s+takes\s+value\s+((?:'[^']+'\s+with\s+probability\s+" + fv.PROBABILITY + fv.CATEGORY_JOINER + ")+)")}', 2, 'i')) AS blob FROM texts),
labels AS (SELECT source_id, name, unnest(range(len(regexp_extract_all(blob, '{_q(fv.CATEGORY_PAIR)}', 0, 'i')))) AS code,
    unnest(regexp_extract_all(blob, '{_q(fv.CATEGORY_PAIR)}', 1, 'i')) AS label,
    CAST(unnest(regexp_extract_all(blob, '{_q(fv.CATEGORY_PAIR)}', 2, 'i')) AS DOUBLE) AS p FROM runs)"""

ORACLES["extract_categorical"] = f"""
WITH {BY_SUPPLIER}, {TEXT}, {RUNS}
SELECT source_id, name, code, label, round(p / sum(p) OVER (PARTITION BY source_id, name), 6) AS prob FROM labels
QUALIFY count(*) OVER (PARTITION BY source_id, name) >= 2"""


def _pairs_of(pattern, turn):
    take = lambda g: f"unnest(regexp_extract_all(text, '{_q(pattern)}', {g}, 'i'))"
    return f"SELECT source_id, {turn} AS turn, {take(1)} AS a, {take(2)} AS b, CAST({take(3)} AS DOUBLE) AS r FROM texts"


ORACLES["extract_correlation"] = f"""
WITH {PART_TEXT}, c AS ({_pairs_of(fv.CORRELATION_NAMED, 0)} UNION ALL {_pairs_of(fv.CORRELATION_CALL, 1)})
SELECT source_id, a || '__' || b AS key, r AS correlation, CASE WHEN r >= 0 THEN 'positive' ELSE 'negative' END AS direction FROM c"""

ORACLES["extract_roundtrip"] = f"""
WITH {WHOLE}, {TEXT}, {mean_std_ctes()}, {RUNS}
SELECT i - 1 AS var_pos, 'var_' || i AS name, 'normal' AS distribution, round(mean, 3) AS mean, round(std, 3) AS std FROM numbered
UNION ALL SELECT CASE name WHEN 'l_linestatus' THEN 2 ELSE 3 END, name, 'categorical', 0::DOUBLE, 1::DOUBLE FROM (SELECT DISTINCT name FROM labels)"""

ORACLES["parse_parameters_json"] = """
WITH good AS (SELECT * FROM part WHERE p_partkey % 7 <> 0 AND p_partkey % 11 <> 0)
SELECT CAST(p_partkey AS VARCHAR) AS source_id, 'price' AS name, 'normal' AS distribution, round(p_retailprice, 4) AS mean,
       p_size::DOUBLE AS std, round(p_retailprice - 3 * p_size, 4) AS min, round(p_retailprice + 3 * p_size, 4) AS max,
       CAST(NULL AS VARCHAR) AS label, CAST(NULL AS DOUBLE) AS prob FROM good
UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'kind', 'categorical', 0, 1, -3, 3, 'small', round(p_size / (p_size + 10.0::DOUBLE), 4) FROM good"""

ORACLES["parse_correlations_json"] = """
SELECT CAST(p_partkey AS VARCHAR) AS source_id, 'k' AS key, 'price' AS var1, 'kind' AS var2,
       round(greatest(-1::DOUBLE, least(1::DOUBLE, p_size / 20.0::DOUBLE - 1)), 4) AS correlation, 'positive' AS direction
FROM part WHERE p_partkey % 7 <> 0 AND p_partkey % 11 <> 0"""

ORACLES["extract_with_fallback"] = f"""
WITH {PART_TEXT}, {mean_std_ctes()}, n AS (SELECT source_id, count(*) AS n FROM numbered GROUP BY 1)
SELECT CAST(p_partkey AS VARCHAR) AS source_id,
  CASE WHEN p_partkey % 7 <> 0 AND p_partkey % 11 <> 0 THEN 'llm' ELSE 'regex_fallback' END AS extraction_method,
  CASE WHEN p_partkey % 7 <> 0 AND p_partkey % 11 <> 0 THEN 2 ELSE n END AS n_variables,
  CASE WHEN p_partkey % 7 <> 0 AND p_partkey % 11 <> 0 THEN 1 ELSE 2 END AS n_correlations
FROM part LEFT JOIN n ON n.source_id = CAST(p_partkey AS VARCHAR)"""

ORACLES["normalize_parameters"] = """
SELECT c_custkey, CASE c_custkey % 5 WHEN 1 THEN 'uniform' WHEN 2 THEN 'gamma'
         WHEN 3 THEN CASE WHEN c_acctbal > 0 THEN 'categorical' ELSE 'normal' END ELSE 'normal' END AS distribution,
  round(c_acctbal - 3 * c_nationkey, 4) AS min, round(c_acctbal + 3 * c_nationkey, 4) AS max,
  round(greatest(-1::DOUBLE, least(1::DOUBLE, c_acctbal / 1000)), 4) AS correlation,
  CASE WHEN c_acctbal > 0 THEN 0.75::DOUBLE END AS prob FROM customer"""

ORACLES["parameters_from_truth"] = """
SELECT CAST(s_suppkey AS VARCHAR) AS source_id, 'balance' AS name, round(s_acctbal - 6, 4) AS min, round(s_acctbal + 6, 4) AS max,
  'balance__nation' AS key, round(greatest(-1::DOUBLE, least(1::DOUBLE, s_nationkey / 12.0::DOUBLE - 1)), 4) AS correlation,
  CASE WHEN s_nationkey >= 12 THEN 'positive' ELSE 'negative' END AS direction FROM supplier"""

MEMBERS = """
mem AS (SELECT CAST(s_nationkey AS VARCHAR) AS g, CAST(s_suppkey AS VARCHAR) AS source_id,
        count(*) OVER (PARTITION BY s_nationkey) AS size FROM supplier)"""

ORACLES["merge_parameters"] = f"""
WITH {BY_SUPPLIER}, {MEMBERS}, st AS ({_stats("lineitem", ["l_quantity", "l_extendedprice"], "l_suppkey")}),
m AS (SELECT g AS source_id, name, 'normal' AS distribution, avg(mean) AS mean, avg(std) AS std FROM st JOIN mem USING (source_id) GROUP BY 1, 2),
k AS (SELECT DISTINCT g AS source_id, v AS name, size FROM sh JOIN mem USING (source_id))
SELECT source_id, name, distribution, round(mean, 3) AS mean, round(std, 3) AS std, round(mean - 3 * std, 3) AS min, round(mean + 3 * std, 3) AS max FROM m
UNION ALL SELECT source_id, name, CASE WHEN size = 1 THEN 'categorical' ELSE 'normal' END, 0, 1,
  CASE WHEN size = 1 THEN NULL ELSE -3 END, CASE WHEN size = 1 THEN NULL ELSE 3 END FROM k"""

ORACLES["merge_categories"] = f"""
WITH {BY_SUPPLIER}, {MEMBERS},
n AS (SELECT g, v, count(DISTINCT source_id) AS n FROM sh JOIN mem USING (source_id) GROUP BY 1, 2)
SELECT g AS source_id, v AS name, label, round(sum(p) / any_value(n), 5) AS prob
FROM sh JOIN mem USING (source_id) JOIN n USING (g, v) GROUP BY 1, 2, 3"""

ORACLES["merge_correlations"] = f"""
WITH {BY_SUPPLIER}, {MEMBERS}
SELECT g AS source_id, a || '__' || b AS key, round(avg(r), 5) AS correlation FROM pairs JOIN mem USING (source_id) WHERE r IS NOT NULL GROUP BY 1, 2"""

ORACLES["merge_sources"] = """
SELECT CAST(s_nationkey AS VARCHAR) AS source_id,
  CASE WHEN count(*) = 1 THEN min(s_name) ELSE 'merged(' || string_agg(s_name, ', ' ORDER BY s_suppkey) || ')' END AS source,
  'regex_fallback' AS extraction_method FROM supplier GROUP BY s_nationkey"""

ORACLES["merge_lineage"] = """
SELECT CAST(s_nationkey AS VARCHAR) AS source_id, CAST(s_suppkey AS VARCHAR) AS member, s_name AS source FROM supplier"""

ORACLES["score_extraction"] = f"""
WITH st AS ({_stats("lineitem", ["l_quantity", "l_extendedprice"], "l_suppkey")})
SELECT source_id, 1::DOUBLE AS success_rate, round(avg(abs(round(mean, 4) - mean) / abs(mean)), 4) AS mean_rel_err,
       round(avg(abs(round(std, 4) - std) / abs(std)), 4) AS std_rel_err FROM st GROUP BY 1"""

ORACLES["method_list"] = """
SELECT p_partkey % 20 AS group_id, string_agg(DISTINCT CASE WHEN p_partkey % 7 <> 0 AND p_partkey % 11 <> 0 THEN 'llm' ELSE 'regex_fallback' END, ', '
  ORDER BY CASE WHEN p_partkey % 7 <> 0 AND p_partkey % 11 <> 0 THEN 'llm' ELSE 'regex_fallback' END) AS methods FROM part GROUP BY 1"""

ORACLES["rejected_sources"] = """
SELECT CAST(p_partkey AS VARCHAR) AS source_id, 'no variables' AS reason FROM part WHERE p_partkey % 7 = 0 OR p_partkey % 11 = 0"""

# --- cleaning and discovery ------------------------------------------------------------------


def _visible(column):
    text = f"regexp_replace({column}, '<!--.*?-->', ' ', 'gs')"
    for name in ("script", "style", "noscript", "nav", "header", "footer", "head"):
        text = f"regexp_replace({text}, '<{name}(?:[ \\t\\n\\f\\r][^>]*)?>.*?</{name}[ \\t\\n\\f\\r]*>', ' ', 'gsi')"
    text = f"regexp_replace({text}, '<[^>]+>', ' ', 'g')"
    for entity, character in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
        text = f"replace({text}, '{entity}', '{character}')"
    return f"trim(regexp_replace({text}, '[ \\t\\n\\f\\r]+', ' ', 'g'))"


ORACLES["html_to_text"] = f"SELECT page_id, {_visible('html')} AS text FROM pages"
ORACLES["assemble_pages"] = "SELECT conv_id AS doc_id, string_agg(text, chr(10) || chr(10) ORDER BY turn) AS text FROM conversations GROUP BY 1"
ORACLES["statistical_density"] = r"""
SELECT doc_id, round(coalesce(len(regexp_extract_all(text, '[0-9]+(?:\.[0-9]+)?')) / nullif(len(regexp_extract_all(text, '[A-Za-z0-9_]+')), 0)::DOUBLE, 0), 6) AS density FROM documents"""

EXPAND = """
l AS (SELECT conv_id, turn - 1 AS turn, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x, ' ' || chr(9) || chr(13) || chr(12) || chr(11))), lambda x: x <> '')[1:4] AS extra
      FROM conversations WHERE role <> 'user'),
qs AS (SELECT conv_id || '-' || turn AS query_id, list_concat([text], coalesce(extra, [])) AS qs FROM (SELECT * FROM conversations WHERE role = 'user') LEFT JOIN l USING (conv_id, turn)),
ex AS (SELECT query_id, unnest(range(len(qs))) AS query_pos, unnest(qs) AS query FROM qs)"""
ORACLES["expand_queries"] = f"WITH {EXPAND} SELECT * FROM ex"
ORACLES["run_discovery"] = f"""
WITH {EXPAND},
q AS (SELECT query_id, query_pos, unnest(list_distinct(regexp_extract_all(lower(query), '[a-z0-9]+'))) AS term FROM ex),
d AS (SELECT doc_id, unnest(list_distinct(regexp_extract_all(lower(text), '[a-z0-9]+'))) AS term FROM documents),
h AS (SELECT query_id, query_pos, doc_id, CASE WHEN doc_id % 4 = 0 THEN 'pdf' ELSE 'html' END AS source_type, count(*) AS hits FROM q JOIN d USING (term) GROUP BY ALL),
top AS (SELECT *, row_number() OVER (PARTITION BY query_id, query_pos, source_type ORDER BY hits DESC, doc_id) - 1 AS result_pos FROM h QUALIFY result_pos < 5)
SELECT query_id, query_pos, result_pos, doc_id, hits, source_type FROM top
QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY query_id, query_pos, source_type, result_pos) = 1"""

SEARCH = """
q AS (SELECT item_id AS query_id, unnest(list_distinct(regexp_extract_all(lower(text), '[a-z0-9]+'))) AS term FROM benchmark),
d AS (SELECT doc_id, unnest(list_distinct(regexp_extract_all(lower(text), '[a-z0-9]+'))) AS term FROM documents),
h AS (SELECT query_id, doc_id, CASE WHEN doc_id % 4 = 0 THEN 'pdf' ELSE 'html' END AS source_type, count(*) AS hits FROM q JOIN d USING (term) GROUP BY ALL),
top AS (SELECT *, row_number() OVER (PARTITION BY query_id, source_type ORDER BY hits DESC, doc_id) - 1 AS result_pos FROM h QUALIFY result_pos < 5)"""

ORACLES["search_corpus"] = f"""
WITH {SEARCH}
SELECT query_id, source_type, result_pos, doc_id, hits, CASE source_type WHEN 'pdf' THEN 1.0::DOUBLE ELSE 0.8::DOUBLE END AS relevance_score FROM top"""

PAGE_SOURCES = r"""
src AS (SELECT page_id % 3 AS query_pos, page_id AS result_pos, page_id,
  regexp_replace(regexp_replace(url, '[?#].*$', ''), '^https?://[^.]+\.', '') || CASE WHEN page_id % 3 = 0 THEN '.pdf' ELSE '' END AS url FROM pages)"""
ORACLES["dedup_sources"] = f"""
WITH {PAGE_SOURCES} SELECT * FROM src QUALIFY row_number() OVER (PARTITION BY url ORDER BY query_pos, result_pos) = 1"""
ORACLES["classify_sources"] = f"""
WITH {PAGE_SOURCES} SELECT page_id, CASE WHEN url LIKE '%.pdf' THEN 'pdf' ELSE 'html' END AS source_type,
  CASE WHEN url LIKE '%.pdf' THEN 1.0::DOUBLE ELSE 0.8::DOUBLE END AS relevance_score FROM src"""

SUGGEST = f"""
{SEARCH}, res AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY source_type, result_pos) - 1 AS result_pos, doc_id FROM top),
marked AS (SELECT *, query_id % 5 <> 0 AND (result_pos = query_id % 4 OR result_pos = 2 OR result_pos = 17) AS suggested FROM res)"""
ORACLES["suggest_sources"] = f"WITH {SUGGEST} SELECT query_id, result_pos, doc_id, suggested FROM marked"
ORACLES["select_sources"] = f"WITH {SUGGEST} SELECT query_id, result_pos, doc_id FROM marked WHERE suggested"

ORACLES["recode_clean"] = """
SELECT o_orderkey, o_orderstatus AS status, CASE o_orderpriority WHEN '1-URGENT' THEN 'high' WHEN '2-HIGH' THEN 'high' WHEN '5-LOW' THEN 'low' END AS level
FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '5-LOW')"""
ORACLES["latest_runs"] = """
SELECT 'run_' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS run_id, event_type FROM events ORDER BY run_id DESC LIMIT 3"""
ORACLES["preview"] = "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10"

# --- synthesis ----------------------------------------------------------------------------------

ROWS = "rws AS (SELECT unnest(range((SELECT count(*) FROM lineitem))) AS row_id)"
LISTS = """
pe AS (SELECT avg(l_extendedprice) AS m, stddev_samp(l_extendedprice) AS s FROM lineitem),
cl AS (SELECT 's' AS v, l_linestatus AS label, count(*) AS n FROM lineitem GROUP BY ALL UNION ALL SELECT 'f', l_returnflag, count(*) FROM lineitem GROUP BY ALL),
cc AS (SELECT v, label, sum(n) OVER (PARTITION BY v ORDER BY label) / sum(n) OVER (PARTITION BY v) AS c FROM cl),
ls AS (SELECT list(label ORDER BY label) FILTER (v = 's') AS sl, list(c ORDER BY label) FILTER (v = 's') AS sc,
              list(label ORDER BY label) FILTER (v = 'f') AS fl, list(c ORDER BY label) FILTER (v = 'f') AS fc FROM cc)"""


def pick(labels, cuts, p):
    return f"{labels}[1 + least(len(list_filter({cuts}, lambda c: c <= {p})), len({labels}) - 1)]"


_K = [rng.keys(fv.DEFAULT_SEED, 0, i) for i in range(4)]
_SPARE = tuple(k ^ 0x5BD1E995 for k in _K[3])
_L = np.linalg.cholesky(np.array([[1, .6, 0, 0], [.6, 1, 0, -.3], [0, 0, 1, 0], [0, -.3, 0, 1.0]]))

ORACLES["synth_copula"] = f"""
WITH {ROWS}, {LISTS}, {uniforms("rws", "row_id", {"u0": _K[0], "u1": _K[1], "u3": _K[3], "u4": _SPARE, "p2": _K[2]})},
g AS (SELECT row_id, p2, {normal("u0", "u1", True)} AS g0, {normal("u0", "u1", False)} AS g1, {normal("u3", "u4", True)} AS g3 FROM u_out),
z AS (SELECT row_id, p2, g0 AS z0, {float(_L[1, 0])!r}::DOUBLE * g0 + {float(_L[1, 1])!r}::DOUBLE * g1 AS z1,
      ({float(_L[3, 0])!r})::DOUBLE * g0 + ({float(_L[3, 1])!r})::DOUBLE * g1 + {float(_L[3, 3])!r}::DOUBLE * g3 AS z3 FROM g),
p AS (SELECT *, {cdf("z0")} AS p0, {cdf("z3")} AS p3 FROM z)
SELECT row_id, round(p0 * 53.9::DOUBLE - 1.45::DOUBLE, 3) AS l_quantity, round(m + s * 1.1::DOUBLE * z1, 3) AS l_extendedprice,
  {pick("sl", "sc", "p2")} AS l_linestatus, {pick("fl", "fc", "p3")} AS l_returnflag FROM p, pe, ls"""

_SPARE1 = tuple(k ^ 0x5BD1E995 for k in _K[1])
ORACLES["synth_independent"] = f"""
WITH {ROWS}, {LISTS}, {uniforms("rws", "row_id", {"p0": _K[0], "u1": _K[1], "u5": _SPARE1, "p2": _K[2], "p3": _K[3]})},
z AS (SELECT *, {normal("u1", "u5", True)} AS z1 FROM u_out)
SELECT row_id, round(p0 * 53.9::DOUBLE - 1.45::DOUBLE, 3) AS l_quantity, round(m + s * 1.1::DOUBLE * z1, 3) AS l_extendedprice,
  {pick("sl", "sc", "p2")} AS l_linestatus, {pick("fl", "fc", "p3")} AS l_returnflag FROM z, pe, ls"""

ORACLES["synth_categorical"] = f"""
WITH {ROWS}, {LISTS}, {uniforms("rws", "row_id", {"p0": rng.keys(7, 0, 0), "p1": rng.keys(7, 0, 1)})}
SELECT {pick("sl", "sc", "p0")} AS l_linestatus, {pick("fl", "fc", "p1")} AS l_returnflag, count(*) AS n FROM u_out, ls GROUP BY ALL"""

ORACLES["rank_match"] = """
WITH a AS (SELECT o_orderkey, row_number() OVER (ORDER BY date_trunc('month', o_orderdate), o_orderkey) AS rank FROM orders),
b AS (SELECT o_totalprice, row_number() OVER (ORDER BY o_totalprice) AS rank FROM orders)
SELECT o_orderkey, rank, o_totalprice FROM a JOIN b USING (rank)"""

# --- validation ------------------------------------------------------------------------------------


def _distance(position, source):
    return f"""
u AS (SELECT {position} AS u FROM {source}),
r AS (SELECT u, row_number() OVER (ORDER BY u) AS i, count(*) OVER () AS n FROM u)
SELECT max(n) AS n, round(max(greatest(i / n - u, u - (i - 1) / n)), 8) AS d FROM r"""


ORACLES["ks_statistic_normal"] = f"""
WITH x AS (SELECT (l_extendedprice - (SELECT avg(l_extendedprice) FROM lineitem)) / (SELECT stddev_samp(l_extendedprice) FROM lineitem) AS x FROM lineitem),
{_distance(cdf("x"), "x")}"""
ORACLES["ks_statistic_uniform"] = f"WITH {_distance('greatest(0::DOUBLE, least(1::DOUBLE, (l_quantity - 1) / 49::DOUBLE))', 'lineitem')}"

ORACLES["chi_square_fit"] = """
WITH c AS (SELECT o_orderstatus, count(*) AS o FROM orders GROUP BY 1), t AS (SELECT sum(o) AS n FROM c),
s AS (SELECT any_value(n) AS n, sum((o - n / 3.0::DOUBLE) ** 2 / (n / 3.0::DOUBLE)) AS x FROM c, t)
SELECT 'o_orderstatus' AS name, CAST(n AS BIGINT) AS n, round(x, 5) AS statistic, round(exp(-x / 2), 5) AS pvalue FROM s"""

ORACLES["distribution_fit"] = f"""
WITH m AS (SELECT avg(l_quantity) AS mq, stddev_samp(l_quantity) AS sq, avg(l_extendedprice) AS me, stddev_samp(l_extendedprice) AS se FROM lineitem),
x AS (SELECT 'l_quantity' AS name, (l_quantity - mq) / sq AS x FROM lineitem, m UNION ALL SELECT 'l_extendedprice', (l_extendedprice - me) / se FROM lineitem, m),
u AS (SELECT name, {cdf("x")} AS u FROM x),
r AS (SELECT name, u, row_number() OVER (PARTITION BY name ORDER BY u) AS i, count(*) OVER (PARTITION BY name) AS n FROM u)
SELECT name, 'ks' AS test, max(n) AS n, round(max(greatest(i / n - u, u - (i - 1) / n)), 6) AS statistic FROM r GROUP BY 1
UNION ALL SELECT unnest(['l_linestatus', 'l_returnflag']), 'chi2', (SELECT count(*) FROM lineitem), 0::DOUBLE"""

ORACLES["correlation_similarity"] = """
WITH c AS (SELECT l_quantity AS q, l_extendedprice AS e, CASE l_returnflag WHEN 'R' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS f FROM lineitem),
d AS (SELECT abs(corr(q, e) - 0.4::DOUBLE) + abs(corr(q, f) + 0.2::DOUBLE) + abs(corr(e, f)) AS t FROM c)
SELECT round(1 - t / 3 / 2, 6) AS corr_similarity FROM d"""

BIAS = """
b AS (SELECT 'l_quantity' AS name, abs(avg(l_quantity) - 30) / 30 > 0.2 AS biased FROM lineitem
  UNION ALL SELECT 'l_extendedprice', abs(avg(l_extendedprice) - 40000) / 40000 > 0.2 FROM lineitem
  UNION ALL SELECT 'l_returnflag', abs(avg((l_returnflag = 'R')::INT) - 0.2) > 0.1 OR abs(avg((l_returnflag = 'N')::INT) - 0.5) > 0.1
     OR abs(avg((l_returnflag = 'A')::INT) - 0.3) > 0.1 FROM lineitem)"""
ORACLES["bias_variables"] = f"WITH {BIAS} SELECT name, biased FROM b"
ORACLES["bias_score"] = f"WITH {BIAS} SELECT round(1 - sum(biased::INT) / 3.0::DOUBLE, 6) AS bias FROM b"

ORACLES["privacy_score"] = f"""
WITH m AS (SELECT avg(c_acctbal) AS ma, stddev_samp(c_acctbal) AS sa, avg(c_nationkey) AS mn, stddev_samp(c_nationkey) AS sn FROM customer),
z AS (SELECT c_custkey, (c_acctbal - ma) / sa AS a, (c_nationkey - mn) / sn AS b FROM customer, m),
{uniforms("z", "c_custkey", {"h": rng.keys(0, "privacy")})},
s AS (SELECT * FROM u_out ORDER BY h, c_custkey LIMIT 500),
d AS (SELECT x.c_custkey, min(sqrt((x.a - y.a) ** 2 + (x.b - y.b) ** 2)) AS d FROM s x JOIN s y ON x.c_custkey <> y.c_custkey GROUP BY 1)
SELECT round(avg(d), 4) AS avg_min_dist, round(least(avg(d) / sqrt(2), 1), 4) AS privacy_score FROM d"""

# --- loop -------------------------------------------------------------------------------------------

ORACLES["noise_schedule"] = """
WITH RECURSIVE log AS (SELECT user_id AS run_id, event_id AS position, value AS score,
    row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS iteration FROM events),
walk AS (
  SELECT run_id, position, iteration, 0.1::DOUBLE AS noise, score > -1 AS improved, CASE WHEN score > -1 THEN 0 ELSE 1 END AS streak,
         greatest(score, -1) AS best_score FROM log WHERE iteration = 0
  UNION ALL
  SELECT l.run_id, l.position, l.iteration,
    CASE WHEN w.improved THEN w.noise WHEN w.streak % 4 = 0 THEN 0.1::DOUBLE WHEN w.streak % 2 = 0 THEN greatest(w.noise * 0.5::DOUBLE, 0.01::DOUBLE)
         ELSE least(w.noise * 1.1::DOUBLE, 2.0::DOUBLE) END,
    l.score > w.best_score, CASE WHEN l.score > w.best_score THEN 0 ELSE w.streak + 1 END, greatest(w.best_score, l.score)
  FROM walk w JOIN log l ON l.run_id = w.run_id AND l.iteration = w.iteration + 1)
SELECT run_id, position, iteration, round(noise, 8) AS noise, improved, streak, best_score FROM walk"""

ORACLES["ratchet_best"] = """
SELECT user_id AS run_id, max(value) AS best_score, arg_min(event_id, (-value, event_id)) AS best_position FROM events GROUP BY 1"""

# --- evaluation -----------------------------------------------------------------------------------------

ORACLES["stratified_split"] = f"""
WITH c AS (SELECT o_orderstatus, count(*) AS size FROM orders GROUP BY 1),
t AS (SELECT sum(size) AS total, sum(size) - ceil(0.2::DOUBLE * sum(size)) AS n_train FROM c),
s AS (SELECT o_orderstatus, size, floor(size * (n_train / total)) AS fl, size * (n_train / total) - floor(size * (n_train / total)) AS rest, n_train FROM c, t),
w AS (SELECT o_orderstatus, size - fl - CASE WHEN row_number() OVER (ORDER BY rest DESC, o_orderstatus) <= n_train - sum(fl) OVER () THEN 1 ELSE 0 END AS want FROM s),
o AS (SELECT o_orderstatus, o_orderkey FROM orders), {uniforms("o", "o_orderkey", {"h": rng.keys(3, "split")})}
SELECT o_orderstatus, o_orderkey, row_number() OVER (PARTITION BY o_orderstatus ORDER BY h, o_orderkey) <= want AS is_test FROM u_out JOIN w USING (o_orderstatus)"""

ORACLES["label_encode"] = "SELECT c_custkey, dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS code FROM customer"
ORACLES["unseen_labels"] = """
SELECT DISTINCT p_name FROM part WHERE p_size > 20 AND p_name NOT IN (SELECT p_name FROM part WHERE p_size <= 20)"""
ORACLES["positive_label"] = "SELECT coalesce(min(o_orderpriority) FILTER (trim(o_orderpriority) LIKE '>%'), max(o_orderpriority)) AS positive FROM orders"

GUESS = """
g AS (SELECT l_returnflag AS label, CASE WHEN l_discount < 0.03::DOUBLE THEN 'A' WHEN l_quantity > 30 THEN 'N' ELSE 'R' END AS prediction FROM lineitem)"""
ORACLES["confusion_matrix"] = f"""
WITH {GUESS}, k AS (SELECT label AS l FROM g UNION SELECT prediction FROM g),
c AS (SELECT label, prediction, count(*) AS n FROM g GROUP BY ALL)
SELECT a.l AS true_label, b.l AS pred_label, coalesce(n, 0) AS n FROM k a CROSS JOIN k b LEFT JOIN c ON label = a.l AND prediction = b.l"""
ORACLES["class_report"] = f"""
WITH {GUESS}, k AS (SELECT label AS l FROM g UNION SELECT prediction FROM g),
r AS (SELECT l AS label, (SELECT count(*) FROM g WHERE g.label = l AND prediction = l) AS ok, (SELECT count(*) FROM g WHERE g.label = l) AS support,
      (SELECT count(*) FROM g WHERE prediction = l) AS predicted FROM k)
SELECT label, round(coalesce(ok / nullif(predicted, 0), 0), 6) AS precision, round(coalesce(ok / nullif(support, 0), 0), 6) AS recall,
       round(coalesce(2 * ok / nullif(predicted + support, 0), 0), 6) AS f1, support FROM r"""
ORACLES["classifier_metrics"] = """
WITH q AS (SELECT lang, quality AS y, (n_chars > 1000)::INT AS p FROM documents JOIN labels USING (doc_id))
SELECT lang, round(avg((y = p)::INT), 6) AS accuracy, round(coalesce(2 * sum((y = 1 AND p = 1)::INT) / nullif(sum(y) + sum(p), 0), 0), 6) AS f1 FROM q GROUP BY 1"""
ORACLES["roc_auc"] = """
WITH r AS (SELECT (l_returnflag = 'R') AS y, rank() OVER (ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_extendedprice) - 1) / 2.0::DOUBLE AS k FROM lineitem),
s AS (SELECT sum(k) FILTER (y) AS w, count(*) FILTER (y) AS p, count(*) FILTER (NOT y) AS n FROM r)
SELECT round((w - p::DOUBLE * (p + 1) / 2) / (p::DOUBLE * n), 8) AS roc_auc FROM s"""
ORACLES["positive_rates"] = f"""
WITH {GUESS} SELECT round(avg((prediction = 'R')::INT), 6) AS pred_pos_rate, round(avg((label = 'R')::INT), 6) AS true_pos_rate FROM g"""
ORACLES["target_correlation"] = " UNION ALL ".join(
    f"SELECT l_linestatus, '{c}' AS feature, round(corr({c}, (l_returnflag = 'R')::INT), 6) AS corr FROM lineitem GROUP BY 1"
    for c in ("l_quantity", "l_extendedprice", "l_discount")
)
ORACLES["seed_summary"] = """
WITH s AS (SELECT event_type, event_id % 5 AS seed, avg(value) AS score FROM events GROUP BY 1, 2)
SELECT event_type, count(*) AS n_seeds, round(avg(score), 6) AS score_mean,
       round(CASE WHEN count(*) >= 2 THEN stddev_samp(score) ELSE 0 END, 6) AS score_std FROM s GROUP BY 1"""

PAIRS = """
p AS (SELECT user_id, avg(value) FILTER (event_type = 'click') AS a, avg(value) FILTER (event_type = 'view') AS b FROM events GROUP BY 1),
d AS (SELECT a - b AS d FROM p WHERE a IS NOT NULL AND b IS NOT NULL)"""
ORACLES["paired_ttest"] = f"WITH {PAIRS} SELECT count(*) AS n, round(avg(d), 6) AS mean_diff, round(avg(d) / (stddev_samp(d) / sqrt(count(*))), 6) AS t FROM d"
ORACLES["wilcoxon"] = f"""
WITH {PAIRS}, r AS (SELECT d, rank() OVER (ORDER BY abs(d)) + (count(*) OVER (PARTITION BY abs(d)) - 1) / 2.0::DOUBLE AS k FROM d WHERE d <> 0),
s AS (SELECT count(*) AS n, coalesce(sum(k) FILTER (d > 0), 0) AS wp, coalesce(sum(k) FILTER (d < 0), 0) AS wm FROM r)
SELECT n, round(wp, 3) AS w_plus, round(wm, 3) AS w_minus, round(least(wp, wm), 3) AS statistic FROM s"""
ORACLES["ablation_summary"] = """
SELECT event_type AS method, count(value) AS n, round(avg(value), 6) AS mean_latency_s, round(avg((value > 5)::INT), 6) AS mean_success_rate,
       round(avg(value / 100), 6) AS mean_rel_err, round(avg(value / 200), 6) AS std_rel_err FROM events GROUP BY 1"""
ORACLES["cost_latency_summary"] = """
SELECT event_type AS provider, 'm' || (user_id % 3) AS model, count(*) AS n, round(avg(value / 10), 6) AS mean_latency_s,
  round(stddev_samp(value / 10), 6) AS std_latency_s, round(avg(value / 1000), 6) AS mean_cost_usd,
  round(avg(length(props)), 6) AS mean_prompt_tokens, round(avg(event_id % 50), 6) AS mean_completion_tokens FROM events GROUP BY 1, 2"""
ORACLES["token_savings"] = """
WITH s AS (SELECT role, CAST(sum(length(text)) AS BIGINT) AS v, CAST(sum(len(regexp_split_to_array(trim(text, ' '), '[ ]+'))) AS BIGINT) AS k FROM conversations GROUP BY 1)
SELECT role, v AS verbose_tokens, k AS short_tokens, round((v - k) / v * 100, 6) AS reduction_pct FROM s"""

# The same texts in markup give the same parameters.
ORACLES["process_pages"] = ORACLES["extract_with_fallback"]


ORACLES["correlation_retention"] = """
WITH t AS (SELECT CASE WHEN l_linestatus = 'F' THEN 'real' ELSE 'later' END AS source, (l_discount::DOUBLE > 0.05)::INT::DOUBLE AS y,
                  l_quantity::DOUBLE AS l_quantity, l_extendedprice::DOUBLE AS l_extendedprice, l_discount::DOUBLE AS l_discount FROM lineitem),
c AS (UNPIVOT (SELECT source, corr(l_quantity, y) AS l_quantity, corr(l_extendedprice, y) AS l_extendedprice, corr(l_discount, y) AS l_discount FROM t GROUP BY source)
      ON l_quantity, l_extendedprice, l_discount INTO NAME feature VALUE corr)
SELECT c.source, c.feature, round(c.corr, 6) AS corr, round(r.corr, 6) AS real_corr
FROM c JOIN c r ON c.feature = r.feature AND r.source = 'real' WHERE c.source <> 'real'"""

_GAP_METRICS = {
    "true_pos_rate": "s.tp", "pred_pos_rate": "s.pp", "train_pos_prev": "s.prev",
    "f1_gap": "r.f1 - s.f1", "pred_rate_gap": "s.pp - r.pp", "prevalence_gap": "s.prev - r.prev",
}
ORACLES["score_gaps"] = f"""
WITH e AS (SELECT (user_id % 20)::INT AS seed, CASE WHEN event_type = 'click' THEN 'real' ELSE event_type END AS source,
                  avg(value) AS f1, avg((value > 50)::INT::DOUBLE) AS pp, avg((value > 20)::INT::DOUBLE) AS tp, avg((value > 80)::INT::DOUBLE) AS prev
           FROM events GROUP BY ALL)
SELECT 'events' AS dataset, s.source, count(*) AS n_seeds,
       {', '.join(f"round(avg({x}), 6) AS {m}_mean, round(CASE WHEN count(*) >= 2 THEN stddev_samp({x}) ELSE 0 END, 6) AS {m}_std" for m, x in _GAP_METRICS.items())}
FROM e s JOIN e r ON s.seed = r.seed AND r.source = 'real' WHERE s.source <> 'real' GROUP BY s.source"""
