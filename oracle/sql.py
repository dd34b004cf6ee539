"""Building blocks of the oracle SQL (DuckDB dialect)."""

from __future__ import annotations

from oracle.values import (MP25_DOT_PATTERN, MP25_DOT_REPLACEMENT, POLLUTANT_TOKENS, RESERVED_WORDS,
                           SCOPE_SUFFIXES, SEMANTIC_RULES, catalog_rows)


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def catalog_cte(scope: str | None = None) -> str:
    rows = ", ".join(f"({i}, {q(sc)}, {q(m)}, {q(t)})" for i, sc, m, t in catalog_rows(scope))
    return f"catalog(idx, scope, module, title) AS (SELECT * FROM (VALUES {rows}))"


LANDING_CTES = """
lb AS (SELECT o_orderkey k, o_orderkey % 90 i, (o_orderkey // 90) % 5 v,
              'run_' || CAST(o_orderkey // 450 AS VARCHAR) dir,
              strftime(o_orderdate, '%Y%m%d') || '_' || lpad(CAST(o_custkey % 24 AS VARCHAR), 2, '0') || '0000' ts,
              o_orderdate + to_seconds(o_custkey % 86400) mtime,
              CAST(floor(o_totalprice) AS BIGINT) length
       FROM orders),
lt AS (SELECT lb.*, CASE WHEN i % 10 = 3 OR i >= 87 THEN 'Desconocido ' || CAST(i AS VARCHAR) ELSE c0.title END title
       FROM lb LEFT JOIN (SELECT * FROM (VALUES {cat_rows})) c0(idx, title) ON c0.idx = lb.i),
ls AS (SELECT *, translate(title, ' (),', '_') safe FROM lt),
landing AS (SELECT k file_id, dir,
                   CASE v WHEN 0 THEN title || '.csv' WHEN 1 THEN safe || '.csv'
                          WHEN 2 THEN safe || '_' || ts || '.csv' WHEN 3 THEN safe || '_' || ts || '_v2.csv'
                          ELSE upper(safe) || '_' || ts || '.csv' END AS name,
                   mtime, length
            FROM ls)"""


def landing_ctes() -> str:
    rows = ", ".join(f"({i}, {q(t)})" for i, _, _, t in catalog_rows())
    return LANDING_CTES.replace("{cat_rows}", rows)


def inventory_cte() -> str:
    return """inventory AS (
  SELECT file_id, dir || '/' || nm AS path, dir, nm AS name, mtime, length FROM (
    SELECT file_id, dir, mtime, length,
           regexp_replace(name, '^(.+)\\.[^.]+$', '\\1') ||
           CASE WHEN file_id % 7 <= 3 THEN '.csv' WHEN file_id % 7 = 4 THEN '.PNG'
                WHEN file_id % 7 = 5 THEN '.txt' ELSE '' END AS nm
    FROM landing))"""


def with_landing(*extra: str, scope: str | None = None) -> str:
    parts = [catalog_cte(scope), landing_ctes().strip()] + list(extra)
    return "WITH " + ",\n".join(parts) + "\n"


def pairs_cte(files: str = "landing", name: str = "name") -> str:
    """(file_id, idx) of every matching pair, as a direct theta join."""
    return f"""fk AS (SELECT file_id, lower(nfc_normalize({name})) n FROM {files}),
ck AS (SELECT idx, lower(nfc_normalize(title)) r, lower(nfc_normalize(translate(title, ' (),', '_'))) s FROM catalog),
pairs AS (SELECT fk.file_id, ck.idx FROM fk JOIN ck
          ON fk.n = ck.r || '.csv' OR fk.n = ck.s || '.csv'
          OR starts_with(fk.n, ck.r || '_') OR starts_with(fk.n, ck.s || '_'))"""


# ---- names -----------------------------------------------------------------

def snake(x: str) -> str:
    return (f"trim(regexp_replace(lower(strip_accents(coalesce({x}, ''))), '[^a-z0-9]+', '_', 'g'), '_')")


def identifier(x: str) -> str:
    reserved = ", ".join(q(w) for w in RESERVED_WORDS)
    s = f"(CASE WHEN {snake(x)} = '' THEN 't' ELSE {snake(x)} END)"
    return (f"substr(CASE WHEN regexp_matches({s}, '^[0-9]') OR {s} IN ({reserved}) "
            f"THEN 't_' || {s} ELSE {s} END, 1, 63)")


def stem(x: str) -> str:
    return f"regexp_replace({x}, '^(.+)\\.[^.]+$', '\\1')"


def extension(x: str) -> str:
    e = f"lower(regexp_extract({x}, '^.+(\\.[^.]+)$', 1))"
    return f"(CASE WHEN {e} = '' THEN '(sin extensión)' ELSE {e} END)"


VER = "(?i)_v(\\d+)$"
TS = "[\\-_](\\d{8})[\\-_](\\d{6})\\s*$"


def parse_stem_cols(x: str) -> str:
    """Select-list fragment: base, ts, ver, ts_int of stem expression x."""
    rest = f"regexp_replace({x}, '{VER}', '')"
    ver = f"regexp_extract({x}, '{VER}', 1)"
    ts = (f"CASE WHEN regexp_matches({rest}, '{TS}') THEN regexp_extract({rest}, '{TS}', 1) || '_' || "
          f"regexp_extract({rest}, '{TS}', 2) END")
    base = f"regexp_replace({rest}, '{TS}', '')"
    return (f"{base} AS base, {ts} AS ts, TRY_CAST(NULLIF({ver}, '') AS BIGINT) AS ver, "
            f"COALESCE(TRY_CAST(replace({ts}, '_', '') AS BIGINT), 0) AS ts_int")


def semantic_ctes(src: str, col: str, out: str) -> list[str]:
    """CTE chain computing ``sem`` for column ``col`` of relation ``src``;
    the last CTE is named ``out`` and keeps all source columns."""
    s0 = f"trim(regexp_replace(lower(strip_accents({col})), '[_\\s]+', ' ', 'g'))"
    flags = []
    for i, (pats, _tok) in enumerate(SCOPE_SUFFIXES):
        cond = " AND ".join(f"regexp_matches(s, '{p}')" for p in pats)
        flags.append(f"({cond}) AS f{i}")
    s = f"regexp_replace(s, '{MP25_DOT_PATTERN}', '{MP25_DOT_REPLACEMENT}', 'g')"
    for pat, rep in SEMANTIC_RULES:
        rep_d = rep.replace("$1", "\\1")
        s = f"regexp_replace({s}, {q(pat)}, {q(rep_d)}, 'g')"
    s = f"trim(regexp_replace({s}, '\\s+', ' ', 'g'))"
    ctes = [
        f"{out}_a AS (SELECT *, {s0} AS s FROM {src})",
        f"{out}_b AS (SELECT *, {', '.join(flags)}, {s} AS r FROM {out}_a)",
    ]
    r = "r"
    for i, (_p, tok) in enumerate(SCOPE_SUFFIXES):
        r = f"(CASE WHEN f{i} AND NOT contains({r}, '{tok}') THEN {r} || ' {tok}' ELSE {r} END)"
    ctes.append(f"{out}_c AS (SELECT *, {snake(r)} AS o FROM {out}_b)")
    o = f"(CASE WHEN o = '' THEN {snake(col)} ELSE o END)"
    ctes.append(f"{out}_d AS (SELECT *, {o} AS o2 FROM {out}_c)")
    case = " ".join(
        f"WHEN regexp_matches(o2, '^(?i){t}(?:_?{t})+') THEN regexp_replace(o2, '^(?i){t}(?:_?{t})+_?', '{t}_')"
        for t in POLLUTANT_TOKENS)
    ctes.append(
        f"{out} AS (SELECT * EXCLUDE (s, r, o, o2, {', '.join(f'f{i}' for i in range(len(SCOPE_SUFFIXES)))}), "
        f"CASE WHEN {col} IS NULL OR {col} = '' THEN '' ELSE (CASE {case} ELSE o2 END) END AS sem FROM {out}_d)")
    return ctes
