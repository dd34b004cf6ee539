"""Oracle SQL per registered query (DuckDB, driver tables as views)."""

from __future__ import annotations

from oracle.sql import (TS, catalog_cte, extension, identifier, inventory_cte, landing_ctes,
                        pairs_cte, parse_stem_cols, semantic_ctes, stem, with_landing)


def missing_titles() -> str:
    return with_landing(pairs_cte()) + """
SELECT idx, scope, module, title,
       row_number() OVER (PARTITION BY module ORDER BY idx) AS seq,
       printf('%02d. %s', row_number() OVER (PARTITION BY module ORDER BY idx), title) AS label
FROM catalog WHERE idx NOT IN (SELECT idx FROM pairs)"""


def extra_files() -> str:
    return with_landing(pairs_cte()) + """
SELECT file_id, dir, name FROM landing WHERE file_id NOT IN (SELECT file_id FROM pairs)"""


def matched_files() -> str:
    return with_landing(pairs_cte()) + """
SELECT file_id, dir, name FROM landing WHERE file_id IN (SELECT file_id FROM pairs)"""


def title_matches() -> str:
    return with_landing(pairs_cte()) + "SELECT DISTINCT file_id, idx FROM pairs"


def missing_by_module() -> str:
    return with_landing(pairs_cte()) + """
SELECT scope, module, count(*) AS n_expected,
       CAST(sum(CASE WHEN idx NOT IN (SELECT idx FROM pairs) THEN 1 ELSE 0 END) AS BIGINT) AS n_missing
FROM catalog GROUP BY GROUPING SETS ((scope, module), ())"""


def _status(scope: str | None) -> str:
    head = "WITH " + ",\n".join([catalog_cte(scope), landing_ctes().strip(), pairs_cte()]) + "\n"
    return head + """
SELECT nm AS n_missing, ne AS n_extras, CASE WHEN nm = 0 AND ne = 0 THEN 0 ELSE 2 END AS status FROM (
  SELECT (SELECT count(*) FROM catalog WHERE idx NOT IN (SELECT idx FROM pairs)) AS nm,
         (SELECT count(*) FROM landing WHERE file_id NOT IN (SELECT file_id FROM pairs)) AS ne)"""


def reconcile_status() -> str:
    return _status(None)


def reconcile_scope_air() -> str:
    return _status("aire")


def count_by_extension() -> str:
    return with_landing(inventory_cte()) + f"""
SELECT {extension('name')} AS ext, count(*) AS n_files FROM inventory GROUP BY 1"""


def count_report() -> str:
    return with_landing(inventory_cte(), pairs_cte("inventory")) + f"""
SELECT count(*) AS n_files,
       count(*) FILTER (WHERE {extension('name')} = '.csv') AS n_csv,
       CAST(71 AS BIGINT) AS n_expected_aire, CAST(16 AS BIGINT) AS n_expected_agua,
       CAST(87 AS BIGINT) AS n_expected,
       count(*) FILTER (WHERE ends_with(name, '.csv') AND file_id NOT IN (SELECT file_id FROM pairs)) AS n_extra_csv
FROM inventory"""


def sql_identifiers() -> str:
    return with_landing() + f"SELECT file_id, name, {identifier(stem('name'))} AS ident FROM landing"


def parsed_stems() -> str:
    return with_landing() + f"""
SELECT file_id, base, ts, ver, ts_int FROM (
  SELECT file_id, {parse_stem_cols('st')} FROM (SELECT file_id, {stem('name')} AS st FROM landing))"""


def landing_names() -> str:
    return with_landing() + """
SELECT file_id, translate(title, ' (),', '_') || '_' || strftime(mtime, '%Y%m%d_%H%M%S') || '.csv' AS landing_name
FROM landing JOIN catalog ON file_id % 87 = idx"""


def semantic_names() -> str:
    src = f"sb AS (SELECT file_id, base FROM (SELECT file_id, {parse_stem_cols(stem('name'))} FROM landing))"
    ctes = [src] + semantic_ctes("sb", "base", "sm")
    return with_landing(*ctes) + "SELECT file_id, base, sem FROM sm"


def _plan(drop: bool, files: str = "landing", extra: tuple[str, ...] = ()) -> str:
    gkey = "base_sql" if drop else "CASE WHEN ts IS NULL THEN base_sql ELSE base_sql || '_' || ts END"
    stem_final = "CASE WHEN rk = 1 THEN gkey ELSE gkey || '_v' || CAST(rk AS VARCHAR) END"
    if drop:
        stem_final = f"regexp_replace({stem_final}, '{TS}', '')"
    ctes = list(extra) + [
        f"pst AS (SELECT file_id, dir, name, mtime, {parse_stem_cols(stem('name'))} FROM {files})",
        *semantic_ctes("pst", "base", "psm"),
        f"pid AS (SELECT *, {identifier('sem')} AS base_sql FROM psm)",
        f"pg AS (SELECT *, {gkey} AS gkey, lower(name) AS lname FROM pid)",
        "pr AS (SELECT *, row_number() OVER (PARTITION BY dir, gkey ORDER BY ts_int DESC, "
        "mtime DESC NULLS FIRST, lname, name) AS rk, min(lname) OVER (PARTITION BY dir, gkey) AS fl, "
        "arg_min(name, (lname, name)) OVER (PARTITION BY dir, gkey) AS fn FROM pg)",
        f"plan AS (SELECT file_id, dir, name AS src, {stem_final} AS dst_stem, fl, fn, rk FROM pr)",
    ]
    return with_landing(*ctes)


def rename_plan_keep_ts() -> str:
    # No two files of one folder share a destination in this fixture, so no
    # collision step is needed here (it is exercised by rename_collisions).
    return _plan(False) + "SELECT file_id, dir, src, dst_stem || '.csv' AS dst FROM plan"


def rename_plan_drop_ts() -> str:
    return _plan(True) + "SELECT file_id, dir, src, dst_stem || '.csv' AS dst FROM plan"


def rename_changes() -> str:
    return _plan(True) + "SELECT file_id, dir, src, dst_stem || '.csv' AS dst FROM plan WHERE src <> dst_stem || '.csv'"


def rename_collisions() -> str:
    copies = ("landing2 AS (SELECT * FROM landing UNION ALL SELECT file_id + 1000000000000, dir, "
              f"{stem('name')} || ' v2.csv', mtime, length FROM landing WHERE file_id % 11 = 0)")
    body = """,
fam AS (SELECT *, regexp_replace(dst_stem, '(?i)_v\\d+$', '') AS family FROM plan),
dupf AS (SELECT DISTINCT dir, regexp_replace(dst_stem, '(?i)_v\\d+$', '') AS family
         FROM plan GROUP BY dir, dst_stem HAVING count(*) > 1),
items AS (SELECT f.*, row_number() OVER (PARTITION BY f.dir, f.family ORDER BY fl, fn, rk) AS seq
          FROM fam f JOIN dupf USING (dir, family)),
rec AS (
  SELECT dir, family, CAST(0 AS BIGINT) AS seq, CAST([] AS VARCHAR[]) AS used,
         CAST(NULL AS BIGINT) AS file_id, CAST(NULL AS VARCHAR) AS pick
  FROM dupf
  UNION ALL
  SELECT r.dir, r.family, i.seq,
         list_append(r.used, p.pick), i.file_id, p.pick
  FROM rec r JOIN items i ON i.dir = r.dir AND i.family = r.family AND i.seq = r.seq + 1,
  LATERAL (SELECT CASE WHEN NOT list_contains(r.used, i.dst_stem) THEN i.dst_stem
                       ELSE i.family || '_v' || CAST(list_min(list_filter(range(2, len(r.used) + 3),
                            lambda n: NOT list_contains(r.used, i.family || '_v' || CAST(n AS VARCHAR)))) AS VARCHAR)
                  END AS pick) p
)
SELECT f.file_id, f.dir, f.src, coalesce(r.pick, f.dst_stem) || '.csv' AS dst
FROM fam f LEFT JOIN (SELECT file_id, pick FROM rec WHERE file_id IS NOT NULL) r USING (file_id)"""
    sql = _plan(True, "landing2", (copies,))
    # _plan ends its WITH list; append the fold CTEs to it.
    return "WITH RECURSIVE " + sql[len("WITH "):].rstrip("\n") + body


HEADERS_CTE = """headers AS (SELECT 't' || CAST(p_size AS VARCHAR) AS table_id,
       row_number() OVER (PARTITION BY p_size ORDER BY p_partkey) AS ordinal,
       CASE WHEN p_partkey % 2 = 0 THEN p_name ELSE p_type END AS raw_name FROM part)"""

CELLS_CTE = """ev AS (SELECT 'events_' || strftime(ts, '%Y%m%d') AS table_id, event_id AS row, * EXCLUDE (event_id) FROM events),
cells AS (
  SELECT table_id, 'event_id' AS col, row, CAST(row AS VARCHAR) AS value FROM ev UNION ALL
  SELECT table_id, 'user_id', row, CAST(user_id AS VARCHAR) FROM ev UNION ALL
  SELECT table_id, 'event_type', row, event_type FROM ev UNION ALL
  SELECT table_id, 'value', row, CASE WHEN row % 10 = 0 THEN 'n/a' ELSE CAST(value AS VARCHAR) END FROM ev UNION ALL
  SELECT table_id, 'fecha', row, CAST(ts AS VARCHAR) FROM ev UNION ALL
  SELECT table_id, 'props', row, props FROM ev)"""


def normalized_columns() -> str:
    return f"""WITH {HEADERS_CTE},
rn AS (SELECT *, CASE WHEN raw_name IS NULL OR raw_name = '' THEN 'Unnamed: ' || CAST(ordinal - 1 AS VARCHAR)
                      ELSE raw_name END AS h FROM headers),
rk AS (SELECT *, row_number() OVER (PARTITION BY table_id, h ORDER BY ordinal) AS k FROM rn),
rd AS (SELECT *, CASE WHEN k = 1 THEN h ELSE h || '.' || CAST(k - 1 AS VARCHAR) END AS read_name FROM rk),
bs AS (SELECT *, {identifier('read_name')} AS base FROM rd),
nn AS (SELECT *, row_number() OVER (PARTITION BY table_id, base ORDER BY ordinal) AS n FROM bs)
SELECT table_id, ordinal, raw_name,
       CASE WHEN n = 1 THEN base ELSE base || '_' || CAST(n AS VARCHAR) END AS column_name FROM nn"""


def date_like_columns() -> str:
    return f"""WITH {CELLS_CTE},
cols AS (SELECT DISTINCT table_id, col FROM cells),
named AS (SELECT table_id, col, {identifier('col')} AS column_name FROM cols)
SELECT table_id, col, column_name,
       regexp_matches(column_name, '(fecha|date|time|datetime|anio|ano|year|mes|month)') AS is_date_like FROM named"""


NULLS = ("'', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', "
         "'1.#QNAN', '<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null'")
INT_RE = "^\\s*[+-]?[0-9]+\\s*$"
FLOAT_RE = "^\\s*[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?\\s*$|^\\s*[+-]?(?i:inf|infinity)\\s*$"
DATE_RE = "^\\d{4}-\\d{2}-\\d{2}([ T]\\d{2}:\\d{2}(:\\d{2}(\\.\\d{1,9})?)?)?$"


def _typed(v: str) -> dict[str, str]:
    return {
        "long": f"CASE WHEN regexp_matches({v}, '{INT_RE}') THEN TRY_CAST(trim({v}) AS BIGINT) END",
        "double": f"CASE WHEN regexp_matches({v}, '{FLOAT_RE}') THEN TRY_CAST(trim({v}) AS DOUBLE) END",
        "bool": f"CASE WHEN {v} IN ('True', 'TRUE', 'true') THEN true WHEN {v} IN ('False', 'FALSE', 'false') THEN false END",
        "ts": f"CASE WHEN regexp_matches({v}, '{DATE_RE}') THEN TRY_CAST({v} AS TIMESTAMP) END",
    }


def _profile_ctes() -> str:
    t = _typed("v")
    return f"""{CELLS_CTE},
cv AS (SELECT table_id, col, row, value, CASE WHEN value IN ({NULLS}) THEN NULL ELSE value END AS v FROM cells),
pg AS (SELECT table_id, col, count(*) AS n_values, count(*) FILTER (WHERE v IS NULL) AS n_null,
              count({t['long']}) AS n_int, count({t['double']}) AS n_float,
              count({t['bool']}) AS n_bool, count({t['ts']}) AS n_date
       FROM cv GROUP BY table_id, col),
pi AS (SELECT *, CASE WHEN n_values - n_null = 0 THEN 'LONG' WHEN n_int = n_values - n_null THEN 'LONG'
                      WHEN n_float = n_values - n_null THEN 'DOUBLE' WHEN n_bool = n_values - n_null THEN 'BOOLEAN'
                      ELSE 'STRING' END AS inferred_type FROM pg),
profile AS (SELECT *, CASE WHEN inferred_type <> 'STRING' THEN inferred_type
                WHEN regexp_matches({identifier('col')}, '(fecha|date|time|datetime|anio|ano|year|mes|month)')
                     AND n_date > 0 THEN 'TIMESTAMP'
                WHEN n_float > 0 AND n_int = n_float THEN 'LONG'
                WHEN n_float > 0 THEN 'DOUBLE' ELSE 'STRING' END AS lenient_type FROM pi)"""


def column_type_profile() -> str:
    return "WITH " + _profile_ctes() + """
SELECT table_id, col, n_values, n_null, n_int, n_float, n_bool, n_date, inferred_type, lenient_type FROM profile"""


def lenient_values() -> str:
    t = _typed("cv.v")
    return "WITH " + _profile_ctes() + f"""
SELECT cv.table_id, cv.col, cv.row, p.lenient_type AS type,
       CASE WHEN p.lenient_type = 'LONG' THEN {t['long']} END AS long_value,
       CASE WHEN p.lenient_type = 'DOUBLE' THEN {t['double']} END AS double_value,
       CASE WHEN p.lenient_type = 'BOOLEAN' THEN {t['bool']} END AS bool_value,
       CASE WHEN p.lenient_type = 'TIMESTAMP' THEN {t['ts']} END AS ts_value,
       CASE WHEN p.lenient_type = 'STRING' THEN cv.v END AS string_value
FROM cv JOIN profile p USING (table_id, col)"""


def _decode(x: str) -> str:
    t = f"regexp_replace({x}, '<[^>]*>', '', 'g')"
    for ent, ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "),
                    ("&amp;", "&")):
        t = f"replace({t}, '{ent}', '{ch}')"
    return t


def _trim_ws(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def discovered_links() -> str:
    link = "(?s)<a\\b[^>]*>(.*?)</a>"
    return f"""WITH c AS (SELECT page_id, regexp_extract(html, '(?s)<nav\\b[^>]*>(.*?)</nav>', 1) AS cont FROM pages),
l AS (SELECT page_id, regexp_extract_all(cont, '{link}', 1) AS links FROM c),
u AS (SELECT page_id, UNNEST(links) AS raw, UNNEST(range(1, len(links) + 1)) AS pos FROM l),
t AS (SELECT page_id, pos, {_trim_ws(_decode('raw'))} AS text FROM u),
f AS (SELECT page_id, text, min(pos) AS first_pos FROM t WHERE text <> '' GROUP BY page_id, text)
SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY first_pos) AS ordinal, text FROM f"""


def element_survey() -> str:
    cols = ", ".join(f"CAST(len(regexp_extract_all(html, '(?i)<{t}\\b')) AS BIGINT) AS n_{t}"
                     for t in ("span", "input", "button", "a", "li", "ul", "nav"))
    return f"SELECT page_id, {cols} FROM pages"


def _elements(tag: str) -> str:
    return (f"list_transform(regexp_extract_all(html, '(?si)<{tag}\\b[^>]*>(.*?)</{tag}>', 1), "
            f"lambda x: {_decode('x')})")


def keyword_survey() -> str:
    hit = " OR ".join(f"contains(x, '{w}')" for w in ("VBA", "Módulo", "Estado"))
    return f"""WITH e AS (SELECT page_id, {_elements('a')} AS el FROM pages)
SELECT page_id, CAST(len(el) AS BIGINT) AS n_elements,
       CAST(len(list_filter(list_slice(el, 1, 20), lambda x: {hit})) AS BIGINT) AS n_keyword_hits,
       CAST(len(list_filter(list_slice(el, 1, 20), lambda x: {_trim_ws('x')} <> '')) AS BIGINT) AS n_nonblank_head,
       CAST(len(list_filter(el, lambda x: contains(x, 'Estadísticas de Medio Ambiente'))) AS BIGINT) AS n_section
FROM e"""


def module_element() -> str:
    mods = "('Módulo VBA- Estado - Aire'), ('Módulo VBA- Estado- Agua')"
    return f"""WITH e AS (SELECT page_id, {_elements('a')} AS el FROM pages),
u AS (SELECT page_id, UNNEST(el) AS t, UNNEST(range(1, len(el) + 1)) AS pos FROM e),
m AS (SELECT * FROM (VALUES {mods}) v(module)),
pm AS (SELECT page_id, module FROM pages, m),
ex AS (SELECT u.page_id, m.module, min(pos) AS pos FROM u JOIN m ON contains(lower(u.t), lower(m.module))
       GROUP BY u.page_id, m.module),
fa AS (SELECT u.page_id, m.module, min(pos) AS pos FROM u JOIN m
         ON contains(m.module, 'Aire') AND contains(lower(u.t), 'aire') GROUP BY u.page_id, m.module),
fw AS (SELECT u.page_id, m.module, min(pos) AS pos FROM u JOIN m
         ON contains(m.module, 'Agua') AND contains(lower(u.t), 'agua') GROUP BY u.page_id, m.module),
pick AS (SELECT pm.page_id, pm.module, ex.pos AS xp, coalesce(fa.pos, fw.pos) AS fp
         FROM pm LEFT JOIN ex USING (page_id, module) LEFT JOIN fa USING (page_id, module)
         LEFT JOIN fw USING (page_id, module))
SELECT pick.page_id, pick.module, CAST(coalesce(xp, fp) AS BIGINT) AS ordinal, u.t AS text,
       CASE WHEN xp IS NOT NULL THEN 'exact' WHEN fp IS NOT NULL THEN 'fallback' ELSE 'none' END AS how
FROM pick LEFT JOIN u ON u.page_id = pick.page_id AND u.pos = coalesce(xp, fp)"""


STAMP = "2025-09-14 13:29:07"
RDIR = "data/downloads"


def missing_report_lines() -> str:
    r72, d72 = "=" * 72, "-" * 72
    return with_landing(pairs_cte()) + f"""
, miss AS (SELECT * FROM catalog WHERE idx NOT IN (SELECT idx FROM pairs)),
ext AS (SELECT * FROM landing WHERE file_id NOT IN (SELECT file_id FROM pairs)),
pm AS (SELECT scope, module, CAST(sum(CASE WHEN idx IN (SELECT idx FROM miss) THEN 1 ELSE 0 END) AS BIGINT) AS n
       FROM catalog GROUP BY scope, module),
sec AS (SELECT * FROM (VALUES ('aire', 1), ('agua', 2)) v(scope, s)),
tot AS (SELECT (SELECT count(*) FROM miss) AS nm, (SELECT count(*) FROM ext) AS ne),
lines(section, seq, ord, key, line) AS (
  SELECT 0, 0, 0, '', 'REPORTE DE ARCHIVOS FALTANTES - generado {STAMP}' UNION ALL
  SELECT 0, 1, 0, '', 'Carpeta analizada: {RDIR}' UNION ALL
  SELECT 0, 2, 0, '', '{r72}' UNION ALL
  SELECT s, 0, 0, '', '[' || module || ']  Faltantes: ' || CAST(n AS VARCHAR) FROM pm JOIN sec USING (scope) UNION ALL
  SELECT s, 1, 0, '', ' - (sin faltantes)' FROM pm JOIN sec USING (scope) WHERE n = 0 UNION ALL
  SELECT s, 1, idx, '', ' - ' || title FROM miss JOIN sec USING (scope) UNION ALL
  SELECT s, 2, 0, '', '' FROM pm JOIN sec USING (scope) UNION ALL
  SELECT 3, 0, 0, '', '{d72}' UNION ALL
  SELECT 3, 1, 0, '', 'TOTAL FALTANTES: ' || CAST(nm AS VARCHAR) FROM tot UNION ALL
  SELECT 3, 2, 0, '', '{r72}' UNION ALL
  SELECT 3, 3, 0, '', '' UNION ALL
  SELECT 3, 4, 0, '', 'ARCHIVOS CSV EXTRA (no esperados)' UNION ALL
  SELECT 3, 5, 0, '', 'Total extras: ' || CAST(ne AS VARCHAR) FROM tot UNION ALL
  SELECT 3, 6, 0, '', ' - (sin extras)' FROM tot WHERE ne = 0 UNION ALL
  SELECT 4, 0, 0, name, ' - ' || name FROM ext UNION ALL
  SELECT 5, 0, 0, '', '{r72}')
SELECT CAST(section AS INTEGER) AS section, CAST(seq AS INTEGER) AS seq, CAST(ord AS BIGINT) AS ord,
       key, line FROM lines"""


DOWNLOADS_CTE = """dl AS (SELECT c.scope AS module, l.dir || '/' || l.name AS path, l.file_id
       FROM landing l JOIN catalog c ON c.idx = l.file_id % 90 WHERE (l.file_id % 90) % 10 <> 3),
mods AS (SELECT * FROM (VALUES ('aire', 'Módulo VBA- Estado - Aire', 1), ('agua', 'Módulo VBA- Estado- Agua', 2))
         v(module, name, s)),
per AS (SELECT m.module, m.name, 'AUTO-DESCUBRIMIENTO' AS mode, m.s,
               CAST((SELECT count(*) FROM dl WHERE dl.module = m.module) AS BIGINT) AS n_files FROM mods m)"""


def downloads_by_module() -> str:
    return with_landing(DOWNLOADS_CTE) + """
SELECT module, name, mode, n_files FROM per UNION ALL
SELECT NULL, NULL, NULL, CAST(sum(n_files) AS BIGINT) FROM per"""


def preset_summary_lines() -> str:
    return run_summary_lines("CASE WHEN module = 'agua' THEN 'CONFIGURACIÓN PREDEFINIDA' ELSE mode END")


def run_summary_lines(mode: str = "mode") -> str:
    r60 = "=" * 60
    return with_landing(DOWNLOADS_CTE) + f"""
, lines(section, seq, ord, key, line) AS (
  SELECT 0, 0, 0, '', '{r60}' UNION ALL
  SELECT 0, 1, 0, '', 'REPORTE DE DESCARGAS - {STAMP}' UNION ALL
  SELECT 0, 2, 0, '', '{r60}' UNION ALL
  SELECT 0, 3, 0, '', 'Directorio de descargas: {RDIR}' UNION ALL
  SELECT 0, 4, 0, '', '' UNION ALL
  SELECT s, 0, 0, '', 'Módulo: ' || name FROM per UNION ALL
  SELECT s, 1, 0, '', 'Modo: ' || {mode} FROM per UNION ALL
  SELECT s, 2, 0, '', 'Archivos descargados: ' || CAST(n_files AS VARCHAR) FROM per UNION ALL
  SELECT s, 3, 0, '', '' FROM per UNION ALL
  SELECT m.s, 4, dl.file_id, '', '  - ' || regexp_extract(dl.path, '[^/]*$') FROM dl JOIN mods m USING (module) UNION ALL
  SELECT s, 5, 0, '', '' FROM per UNION ALL
  SELECT 3, 0, 0, '', 'TOTAL DE ARCHIVOS DESCARGADOS: ' || CAST((SELECT sum(n_files) FROM per) AS VARCHAR) UNION ALL
  SELECT 3, 1, 0, '', '{r60}')
SELECT CAST(section AS INTEGER) AS section, CAST(seq AS INTEGER) AS seq, CAST(ord AS BIGINT) AS ord,
       key, line FROM lines"""


def load_manifest() -> str:
    return """SELECT 'event_type_' || event_type AS "table", CAST(count(*) AS BIGINT) AS n_rows
FROM events GROUP BY event_type"""


def loaded_column_types() -> str:
    return """WITH t AS (SELECT 'event_type_' || event_type AS tbl, count(*) AS n, count(event_id) AS ne,
                  count(user_id) AS nu, count(value) AS nv FROM events GROUP BY event_type)
SELECT tbl AS "table", CAST(1 AS BIGINT) AS ordinal, 'event_id' AS column_name, 'LONG' AS type FROM t UNION ALL
SELECT tbl, 2, 'ts', 'STRING' FROM t UNION ALL
SELECT tbl, 3, 'user_id', 'LONG' FROM t UNION ALL
SELECT tbl, 4, 'value', CASE WHEN nv = 0 THEN 'LONG' ELSE 'DOUBLE' END FROM t UNION ALL
SELECT tbl, 5, 'props', 'STRING' FROM t"""


def load_totals() -> str:
    return "SELECT count(DISTINCT strftime(o_orderdate, '%Y%m')) AS n_tables, count(*) AS n_rows FROM orders"


def month_tables() -> str:
    return """
SELECT 'mes_' || strftime(o_orderdate, '%Y%m') AS "table", count(*) AS n_rows, CAST(sum(o_orderkey) AS BIGINT) AS numbers,
       strftime(min(o_orderdate), '%Y-%m-%d') AS first_day, strftime(max(o_orderdate), '%Y-%m-%d') AS last_day,
       CASE WHEN any_value(month(o_orderdate)) % 2 = 0 THEN CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) END AS cents,
       CASE WHEN any_value(month(o_orderdate)) % 2 = 1 THEN count(o_orderstatus) ELSE 0 END AS n_estado
FROM orders GROUP BY strftime(o_orderdate, '%Y%m')"""


def ranged_load() -> str:
    return quoted_load()


def expected_by_scope() -> str:
    return with_landing(pairs_cte(), "held AS (SELECT DISTINCT idx FROM pairs)") + (
        "SELECT c.scope, count(*) AS n_expected, count(h.idx) AS n_held "
        "FROM catalog c LEFT JOIN held h USING (idx) GROUP BY c.scope UNION ALL "
        "SELECT 'total', (SELECT count(*) FROM catalog), (SELECT count(*) FROM held)")


# Pages of the portal's shape: what they hold follows from page_id and url alone.
_AIR = ("CASE WHEN page_id % 2 = 0 THEN 'Módulo VBA- Estado - Aire' WHEN page_id % 3 = 0 THEN 'Calidad del Aire' ELSE 'Otros' END")
_WATER = ("CASE WHEN page_id % 4 = 0 THEN 'Módulo VBA- Estado- Agua' WHEN page_id % 3 = 0 THEN 'Agua dulce' ELSE '' END")


def module_datasets() -> str:
    url = _trim_ws(_decode("url"))
    return f"""SELECT page_id, CAST(1 AS BIGINT) AS ordinal, 'serie ' || CAST(page_id AS VARCHAR) AS text FROM pages WHERE page_id % 2 = 0
UNION ALL SELECT page_id, 2, {url} FROM pages WHERE page_id % 2 = 0
UNION ALL SELECT page_id, 3, 'final ' || CAST(page_id AS VARCHAR) FROM pages WHERE page_id % 2 = 0"""


def tree_survey() -> str:
    return f"""SELECT page_id, CAST(3 + page_id % 20 AS BIGINT) AS n_tree_items,
       CAST(2 + CASE WHEN {_WATER} <> '' THEN 1 ELSE 0 END + least(12, page_id % 20) AS BIGINT) AS n_nonblank_head FROM pages"""


def portal_keyword_survey() -> str:
    return f"""SELECT page_id, CAST(4 + 2 * (page_id % 20) AS BIGINT) AS n_elements,
       CAST(1 + CASE WHEN page_id % 2 = 0 THEN 1 ELSE 0 END + CASE WHEN page_id % 4 = 0 THEN 1 ELSE 0 END AS BIGINT) AS n_keyword_hits,
       CAST(3 + CASE WHEN {_WATER} <> '' THEN 1 ELSE 0 END + least(16, 2 * (page_id % 20)) AS BIGINT) AS n_nonblank_head,
       CAST(1 AS BIGINT) AS n_section FROM pages"""


def portal_module_element() -> str:
    return f"""WITH p AS (SELECT page_id, {_AIR} AS air, {_WATER} AS water FROM pages)
SELECT page_id, 'Módulo VBA- Estado - Aire' AS module,
       CASE WHEN air <> 'Otros' THEN CAST(2 AS BIGINT) END AS ordinal, CASE WHEN air <> 'Otros' THEN air END AS text,
       CASE WHEN page_id % 2 = 0 THEN 'exact' WHEN page_id % 3 = 0 THEN 'fallback' ELSE 'none' END AS how FROM p
UNION ALL
SELECT page_id, 'Módulo VBA- Estado- Agua', CASE WHEN water <> '' THEN CAST(4 AS BIGINT) END, CASE WHEN water <> '' THEN ' ' || water END,
       CASE WHEN page_id % 4 = 0 THEN 'exact' WHEN page_id % 3 = 0 THEN 'fallback' ELSE 'none' END FROM p"""


def quoted_load() -> str:
    return """SELECT event_id, 'say "' || event_type || '",' || chr(10) || 'then ' || chr(92) AS note,
       CASE WHEN event_id % 3 <> 0 THEN CAST(user_id AS BIGINT) END AS half,
       event_id % 2 = 0 AS flag, CAST(NULL AS BIGINT) AS "none",
       strftime(ts, '%Y-%m-%d') || ' 00:00:00' AS fecha, value FROM events"""


def folder_listing() -> str:
    return """
WITH f AS (SELECT o_custkey AS k, CAST(count(*) % 5 AS BIGINT) AS length FROM orders GROUP BY 1),
n AS (SELECT *, CASE k % 7 WHEN 0 THEN '.hidden_' || k || '.csv' WHEN 1 THEN '_under ' || k || '.csv'
                           WHEN 2 THEN '[br]ack{et}* ' || k || '.csv' WHEN 3 THEN 'Ñandú_' || k || '.csv'
                           WHEN 4 THEN 'PLAIN_' || k || '.CSV' WHEN 5 THEN 'note ' || k || '.txt'
                           ELSE 'plain%20' || k || '.csv' END AS name,
             'a' || k % 5 || CASE WHEN k % 3 = 0 THEN '' ELSE '/[b]' || k % 4 END
                  || CASE WHEN k % 3 = 2 THEN '/c d' || k % 11 ELSE '' END AS folder FROM f)
SELECT folder || '/' || name AS rel, name, length,
       CAST(row_number() OVER (ORDER BY lower(name), name, folder || '/' || name) AS INT) AS place
FROM n WHERE ends_with(name, '.csv')"""


# Pages in wild markup: what a browser shows of them, from page_id and url alone.
def wild_links() -> str:
    return f"""SELECT page_id, CAST(1 AS BIGINT) AS ordinal, 'enlace' || chr(160) || CAST(page_id AS VARCHAR) AS text FROM pages
UNION ALL SELECT page_id, 2, 'Módulo área <' || CAST(page_id AS VARCHAR) || '>' FROM pages
UNION ALL SELECT page_id, 3, 'dos partes juntas' FROM pages
UNION ALL SELECT page_id, 4, {_trim_ws('url')} FROM pages"""


def wild_module_datasets() -> str:
    return """SELECT page_id, CAST(1 AS BIGINT) AS ordinal, 'serie ' || CAST(page_id AS VARCHAR) AS text FROM pages
UNION ALL SELECT page_id, 2, 'literal &amp;' FROM pages
UNION ALL SELECT page_id, 3, 'igual' FROM pages WHERE page_id % 5 > 0"""


def wild_element_survey() -> str:
    return """SELECT page_id, CAST(3 AS BIGINT) AS n_span, CAST(0 AS BIGINT) AS n_input, CAST(0 AS BIGINT) AS n_button,
       CAST(9 + page_id % 5 AS BIGINT) AS n_a, CAST(6 + page_id % 5 AS BIGINT) AS n_li, CAST(2 AS BIGINT) AS n_ul, CAST(1 AS BIGINT) AS n_nav FROM pages"""


def wild_module_element() -> str:
    return """SELECT page_id, 'Módulo VBA- Estado - Aire' AS module, CAST(1 AS BIGINT) AS ordinal, 'Módulo VBA- Estado - Aire' AS text, 'exact' AS how FROM pages
UNION ALL SELECT page_id, 'Módulo VBA- Estado- Agua', NULL, NULL, 'none' FROM pages"""
