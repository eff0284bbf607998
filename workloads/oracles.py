"""SQL that computes what each query must return, from the same tables."""

from __future__ import annotations

from workloads.fixtures import WIKI_RECORD
from workloads.queries import DIGITS, ITERATIONS, PREVIEW_PAGES, TIE_DIGITS

RECORDS = f"""
w AS (SELECT p_partkey, {WIKI_RECORD} AS rec FROM part),
fields AS (
  SELECT p_partkey, rec,
         NOT contains(rec, '<ns>')
           OR trim(regexp_extract(rec, '(?s)<ns>(.*?)</ns>', 1), ' ' || chr(9) || chr(10) || chr(13)) = '0' AS is_article,
         regexp_matches(rec, '(?s)<title>.*?</title>') AS has_title,
         regexp_extract(rec, '(?s)<title>(.*?)</title>', 1) AS raw_title,
         regexp_matches(rec, '(?s)<text[^>]*>.*?</text>') AS has_body,
         regexp_extract(rec, '(?s)<text[^>]*>(.*?)</text>', 1) AS body
  FROM w),
marks AS (
  SELECT *,
         regexp_matches(body, '(?i)#REDIRECT\\s*\\[\\[(.*?)\\]\\]') AS is_redirect,
         regexp_matches(body, '(?i)\\{{\\{{disambig\\w*\\}}\\}}') AS is_disambiguation,
         contains(rec, 'Wikipedia:Stub') OR contains(body, '-stub}}}}') AS is_stub
  FROM fields),
classified AS (
  SELECT *, CASE WHEN NOT is_article THEN 'NOT_ARTICLE'
                 WHEN NOT has_title THEN 'NO_TITLE'
                 WHEN raw_title = '' THEN 'EMPTY_TITLE'
                 WHEN NOT has_body THEN 'NO_TEXT'
                 WHEN body = '' THEN 'EMPTY_TEXT'
                 WHEN is_redirect THEN 'REDIRECT'
                 WHEN is_disambiguation THEN 'DISAMBIGUATION'
                 WHEN is_stub THEN 'STUB'
                 ELSE 'ARTICLE' END AS outcome
  FROM marks)"""


def _plain(text: str) -> str:
    """Entities that occur in the tables; the ampersand comes last, so each decodes once."""
    for entity, character in (("&quot;", "'\"'"), ("&copy;", "chr(169)"), ("&middot;", "chr(183)"),
                              ("&#233;", "chr(233)"), ("&amp;", "'&'")):
        text = f"replace({text}, '{entity}', {character})"
    return text


def _normal(text: str) -> str:
    return f"replace({_plain(text)}, ' ', '_')"


SPANS = RECORDS + """,
spans AS (
  SELECT p_partkey, raw_title, unnest(regexp_extract_all(body, '(?s)\\[\\[(.*?)\\]\\]', 1)) AS link
  FROM classified WHERE outcome = 'ARTICLE')"""

WIKI_RAW = SPANS + f""",
raw AS (
  SELECT {_normal("raw_title")} AS src, {_normal("target")} AS dst, p_partkey
  FROM (SELECT *, split_part(split_part(link, '|', 1), '#', 1) AS target
        FROM spans WHERE NOT contains(link, ':'))
  WHERE target <> '')"""

PARSE_COUNTERS = f"""WITH {WIKI_RAW}
SELECT 'TOTAL_PAGES' AS metric, CAST(count(*) AS BIGINT) AS value FROM classified
UNION ALL SELECT 'NO_LINKS', CAST(count(*) AS BIGINT) FROM classified
  WHERE outcome = 'ARTICLE' AND p_partkey NOT IN (SELECT p_partkey FROM raw)
""" + "\n".join(
    f"UNION ALL SELECT '{name}', CAST(count(*) AS BIGINT) FROM classified WHERE outcome = '{name}'"
    for name in ("NOT_ARTICLE", "NO_TITLE", "EMPTY_TITLE", "NO_TEXT", "EMPTY_TEXT", "REDIRECT",
                 "DISAMBIGUATION", "STUB")
)

DUMP_COUNTERS = f"""{PARSE_COUNTERS}
UNION ALL SELECT 'VERTICES', CAST(count(DISTINCT src) AS BIGINT) FROM raw
UNION ALL SELECT 'EDGES', CAST(count(*) AS BIGINT) FROM raw"""


def _succession(closed: bool = False) -> str:
    condition = "" if closed else "WHERE a.l_returnflag = 'R'"
    return f"""
raw AS (
  SELECT CAST(a.l_partkey AS VARCHAR) AS src, CAST(b.l_partkey AS VARCHAR) AS dst
  FROM lineitem a JOIN lineitem b
    ON a.l_orderkey = b.l_orderkey AND b.l_linenumber = a.l_linenumber + 1
  {condition})"""


GRAPH = """,
edges AS MATERIALIZED (SELECT DISTINCT src, dst FROM raw),
nodes AS MATERIALIZED (SELECT src AS title, CAST(count(*) AS BIGINT) AS out_degree FROM edges GROUP BY src),
n AS MATERIALIZED (SELECT count(*) AS n FROM nodes)"""

PARTS = _succession() + GRAPH
CLOSED_PARTS = _succession(closed=True) + GRAPH
WIKI = WIKI_RAW + GRAPH


def _mass(i: int, before: str) -> str:
    return f"""
m{i} AS MATERIALIZED (
  SELECT k.title, coalesce(s.mass, 0) AS mass
  FROM nodes k LEFT JOIN (
    SELECT e.dst, sum(r.rank / d.out_degree) AS mass
    FROM edges e JOIN {before} r ON r.title = e.src JOIN nodes d ON d.title = e.src
    GROUP BY e.dst) s ON s.dst = k.title)"""


def _log_iterations(last: int = ITERATIONS, n: str = "(SELECT n FROM n)") -> str:
    parts = [f"\nr0 AS MATERIALIZED (SELECT title, CAST(1 AS DOUBLE) / {n} AS rank FROM nodes)"]
    for i in range(1, last + 1):
        parts.append(_mass(i, f"r{i - 1}"))
        parts.append(f"\nx{i} AS MATERIALIZED (SELECT greatest(0, 1 - sum(mass)) AS missing FROM m{i})")
        parts.append(
            f"\nr{i} AS MATERIALIZED (SELECT title, 0.15 / {n} + 0.85 * (mass + (SELECT missing FROM x{i}) / {n}) AS rank FROM m{i})"
        )
    return "," + ",".join(parts)


def _basic_iterations(last: int = ITERATIONS) -> str:
    parts = ["\nr0 AS MATERIALIZED (SELECT title, CAST(1 AS DOUBLE) AS rank FROM nodes)"]
    for i in range(1, last + 1):
        parts.append(_mass(i, f"r{i - 1}"))
        parts.append(f"\nr{i} AS MATERIALIZED (SELECT title, 0.85 + 0.15 * mass AS rank FROM m{i})")
    return "," + ",".join(parts)


def _log_ranks(graph: str, n: str = "(SELECT n FROM n)") -> str:
    return f"""WITH {graph}{_log_iterations(n=n)}
SELECT title, round(ln(rank), {DIGITS}) AS log_rank FROM r{ITERATIONS}"""


BASIC_RANKS = f"""WITH {PARTS}{_basic_iterations()}
SELECT title, round(rank, {DIGITS}) AS rank FROM r{ITERATIONS}"""


def _top(graph: str) -> str:
    return f"""WITH {graph}{_log_iterations()}
SELECT title, round(log_rank, {DIGITS}) AS log_rank
FROM (SELECT title, ln(rank) AS log_rank FROM r{ITERATIONS})
ORDER BY round(log_rank, {TIE_DIGITS}) DESC, title LIMIT 10"""


def _missing_masses(graph: str, name: str) -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{name}' AS graph, {i} AS iteration, round(missing, {DIGITS}) AS missing_mass FROM x{i}"
        for i in range(1, ITERATIONS + 1)
    )
    return f"WITH {graph}{_log_iterations()} {rows}"


def _adjacency(graph: str) -> str:
    return f"""WITH {graph}
SELECT src AS title, 'INITIALIZED' AS type, CAST('-Infinity' AS DOUBLE) AS rank,
       array_to_string(list_sort(list(dst)), chr(9)) AS links
FROM edges GROUP BY src"""


def _preview(ranks: str, rank: str, limit: str) -> str:
    return f"""WITH {PARTS}{ranks}
SELECT title, {rank} AS rank,
       '<' || array_to_string(list_slice(links, 1, 5), chr(9)) || CASE WHEN len(links) > 5 THEN ' ...' ELSE '' END || '>' AS preview
FROM (SELECT src AS title, list_sort(list(dst)) AS links FROM edges GROUP BY src) {limit}"""


EDGES_WITH_DEGREE = f"""WITH {PARTS}
SELECT src, dst, out_degree FROM edges JOIN nodes ON title = src"""

HTML_TITLES = f"""
h AS (SELECT page_id, {_normal("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)")} AS title FROM pages)"""

_GRAPHS = (("wiki", WIKI), ("parts", PARTS))

SCAN = f"WITH {RECORDS} SELECT rec FROM w"

ORACLES: dict[str, str] = {
    "scan_xml_records": SCAN,
    "scan_xml_bz2": SCAN,
    "scan_custom_tags": f"""WITH {RECORDS}
SELECT regexp_extract(rec, '(?s)<revision>.*</revision>') AS rec FROM w""",
    "filter_namespace": f"WITH {RECORDS} SELECT p_partkey FROM classified WHERE is_article",
    "extract_title": f"WITH {RECORDS} SELECT p_partkey, has_title, raw_title FROM classified",
    "extract_body": f"WITH {RECORDS} SELECT p_partkey, has_body, body FROM classified",
    "filter_redirect": f"WITH {RECORDS} SELECT p_partkey FROM classified WHERE is_redirect",
    "filter_disambiguation": f"WITH {RECORDS} SELECT p_partkey FROM classified WHERE is_disambiguation",
    "filter_stub": f"WITH {RECORDS} SELECT p_partkey FROM classified WHERE is_stub",
    "classify_pages": f"WITH {RECORDS} SELECT raw_title, body, outcome FROM classified",
    "parse_counters": PARSE_COUNTERS,
    "counters_roundtrip": PARSE_COUNTERS,
    "dump_counters": DUMP_COUNTERS,
    "extract_links_raw": f"WITH {SPANS} SELECT raw_title, link FROM spans",
    "extract_links": f"WITH {WIKI_RAW} SELECT src, dst FROM raw",
    "normalize_titles": f"WITH {RECORDS} SELECT raw_title, {_normal('raw_title')} AS title FROM classified",
    "unescape_entities": f"""SELECT 'page' AS kind, page_id AS id, {_plain("html")} AS text FROM pages
UNION ALL SELECT 'document', doc_id, {_plain("text")} FROM documents""",
    "html_link_graph": f"""SELECT DISTINCT src, {_normal("link")} AS dst FROM (
  SELECT {_normal("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)")} AS src,
         unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS link
  FROM pages) WHERE src <> '' AND link <> ''""",
    "build_adjacency": _adjacency(WIKI),
    "graph_counters": "\nUNION ALL\n".join(
        f"""SELECT * FROM (WITH {graph} SELECT CAST(count(DISTINCT src) AS BIGINT) AS vertices,
  CAST(count(*) AS BIGINT) AS edges_raw, '{name}' AS graph FROM raw)"""
        for name, graph in _GRAPHS
    ),
    "out_degree": "\nUNION ALL\n".join(
        f"SELECT * FROM (WITH {graph} SELECT title, out_degree, '{name}' AS graph FROM nodes)"
        for name, graph in _GRAPHS
    ),
    "graph_summary": f"""WITH {PARTS} SELECT (SELECT n FROM n) AS nodes, CAST(count(*) AS BIGINT) AS edges FROM edges""",
    "preview_graph": _preview("", "CAST('-Infinity' AS DOUBLE)", f"ORDER BY title LIMIT {PREVIEW_PAGES}"),
    "preview_graph_all": _preview(
        _basic_iterations(1), f"round((SELECT rank FROM r1 WHERE r1.title = src), {DIGITS})", ""
    ).replace("SELECT src AS title, list_sort", "SELECT src, src AS title, list_sort"),
    "type_histogram": f"""WITH {PARTS}
SELECT 'INITIALIZED' AS type, n AS pages FROM n UNION ALL SELECT 'COMPLETED', n FROM n""",
    "missing_structure": f"""WITH {PARTS}
SELECT DISTINCT dst AS title FROM edges WHERE NOT EXISTS (SELECT 1 FROM nodes WHERE title = dst)""",
    "duplicate_titles": f"""WITH {HTML_TITLES}
SELECT title, CAST(count(*) AS BIGINT) AS pages FROM h GROUP BY title HAVING count(*) > 1""",
    "snapshot_roundtrip": EDGES_WITH_DEGREE,
    "graph_overwrites_itself": EDGES_WITH_DEGREE,
    "adjacency_text_roundtrip": _adjacency(PARTS),
    "adjacency_text_long_pages": EDGES_WITH_DEGREE,
    "pagerank_contributions": f"""WITH {PARTS}
SELECT dst, round(sum(CAST(1 AS DOUBLE) / out_degree), {DIGITS}) AS mass
FROM edges JOIN nodes ON title = src GROUP BY dst""",
    "log_add": f"""WITH {PARTS}
SELECT title, round(CASE WHEN a + b = 0 THEN CAST('-Infinity' AS DOUBLE) ELSE ln(a + b) END, {DIGITS}) AS log_sum
FROM (SELECT title, CASE WHEN out_degree % 5 = 0 THEN 0 ELSE CAST(1 AS DOUBLE) / out_degree END AS a,
             CASE WHEN out_degree % 3 = 0 THEN 0 ELSE CAST(1 AS DOUBLE) / (out_degree + 1) END AS b
      FROM nodes)""",
    "log_mass_sum": f"""WITH {PARTS}
SELECT dst, round(ln(sum(exp(-ln(out_degree)))), {DIGITS}) AS log_mass
FROM edges JOIN nodes ON title = src GROUP BY dst""",
    "pagerank_phase1": f"""WITH {PARTS}{_log_iterations(1)}
SELECT title, round(mass, {DIGITS}) AS mass,
       CASE WHEN mass = 0 THEN CAST('-Infinity' AS DOUBLE) ELSE round(ln(mass), {DIGITS}) END AS log_mass
FROM m1""",
    "pagerank_phase2": f"""WITH {PARTS}{_log_iterations(1)}
SELECT title, round(ln(rank), {DIGITS}) AS log_rank FROM r1""",
    "missing_mass": f"""SELECT * FROM ({_missing_masses(PARTS, "open")})
UNION ALL SELECT * FROM ({_missing_masses(CLOSED_PARTS, "closed")})""",
    "pagerank_basic": BASIC_RANKS,
    "pagerank_basic_text": f"""WITH {PARTS}{_basic_iterations()}
SELECT r.title, 'COMPLETED' AS type, round(any_value(rank), {DIGITS}) AS rank,
       array_to_string(list_sort(list(dst)), chr(9)) AS links
FROM r{ITERATIONS} r JOIN edges ON src = r.title GROUP BY r.title""",
    "pagerank_basic_text_resume": BASIC_RANKS,
    "pagerank_basic_resume": BASIC_RANKS,
    "pagerank_log": _log_ranks(PARTS),
    "pagerank_log_closed": _log_ranks(CLOSED_PARTS),
    "pagerank_resume": _log_ranks(PARTS),
    "pagerank_resume_layout": _log_ranks(PARTS),
    "pagerank_after_interruption": _log_ranks(PARTS),
    "pagerank_from_log_ranks": _log_ranks(PARTS),
    "pagerank_nodes_override": _log_ranks(PARTS, "(SELECT 2 * n FROM n)"),
    "iteration_counters": f"""WITH {PARTS}
SELECT 'NODES' AS metric, CAST(n AS BIGINT) AS value FROM n
UNION ALL SELECT 'EDGES', CAST(sum(out_degree) AS BIGINT) FROM nodes
UNION ALL SELECT 'MASS_MESSAGES_SENT', CAST(count(*) AS BIGINT) FROM edges
UNION ALL SELECT 'MASS_MESSAGES_RCVD', CAST(count(*) AS BIGINT) FROM edges
UNION ALL SELECT 'MISSING_STRUCTURE', CAST(count(DISTINCT dst) AS BIGINT) FROM edges
  WHERE dst NOT IN (SELECT title FROM nodes)""",
    "rank_mass_total": f"""WITH {PARTS}{_log_iterations()}
SELECT round(sum(rank), 9) AS total FROM r{ITERATIONS}""",
    "topk_pages": _top(PARTS),
    "topk_text_roundtrip": _top(PARTS),
    "topk_repeated_titles": f"""WITH {HTML_TITLES}
SELECT title, CAST(max(page_id) AS DOUBLE) AS rank FROM h GROUP BY title ORDER BY rank DESC, title LIMIT 20""",
    "topk_duplicates_report": f"""WITH {HTML_TITLES}, pages_of AS (SELECT title, max(page_id) AS best, count(*) AS n FROM h GROUP BY title)
SELECT title, CAST(best AS DOUBLE) AS rank, (SELECT count(*) FROM pages_of WHERE n > 1) AS repeated_titles,
  (SELECT CAST(sum(n - 1) AS BIGINT) FROM pages_of) AS repeated_rows FROM pages_of ORDER BY rank DESC, title LIMIT 20""",
    "dump_to_topk": _top(WIKI),
}
