"""SQL twins of the queries, for an independent engine (DuckDB)."""

from __future__ import annotations

from kindred.config import MatchConfig
from kindred.functions.text import COUNTRY_ALIASES, LEGAL_FORMS

from . import fixtures as fx

ALPHABET = " abcdefghijklmnopqrstuvwxyz0123456789"


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# ------------------------------------------------------------------------ normalisation


def fold(x: str) -> str:
    return rf"regexp_replace(strip_accents({x}), '[^\x00-\x7F]', '', 'g')"


def words(x: str) -> str:
    return f"trim(regexp_replace({x}, '[^a-z0-9]+', ' ', 'g'))"


def name_key(x: str) -> str:
    x = f"coalesce(cast({x} as varchar), '')"
    x = rf"regexp_replace({x}, '\s*\([A-Z]{{1,6}}:[A-Z0-9.]+\)', '', 'g')"
    x = f"translate({x}, '«»„\"‘’“”', '')"
    for _ in range(2):  # no look-around here: a second pass catches overlapping hyphens
        x = rf"regexp_replace({x}, '([\p{{L}}\p{{N}}_])-([\p{{L}}\p{{N}}_])', '\1 \2', 'g')"
    x = f"lower({fold(x)})"
    for phrase, short in LEGAL_FORMS:
        x = rf"regexp_replace({x}, '\b{phrase}\b', '{short}', 'g')"
    return words(x)


def country_key(x: str) -> str:
    x = f"lower({fold(f'coalesce(cast({x} as varchar), {lit(str())})')})"
    x = words(f"replace({x}, '&', ' and ')")
    cases = " ".join(f"when {lit(k)} then {lit(v)}" for k, v in COUNTRY_ALIASES.items())
    return f"(case {x} {cases} else {x} end)"


def lei_set(x: str) -> str:
    return (
        f"list_distinct(list_filter(list_transform(string_split(coalesce({x}, ''), '|'), "
        "lambda v: trim(v)), lambda v: v <> ''))"
    )


# ------------------------------------------------------------------------------ fixtures


def _choose(values: list[str], number: str) -> str:
    texts = "[" + ", ".join(map(lit, values)) + "]"
    return f"{texts}[cast({number} % {len(values)} as int) + 1]"


ORG_LEFT = f"""select s_suppkey as branch_id,
    p_name || ' ' || {_choose(fx.LEFT_FORMS, 's_suppkey')} as institution_name,
    {_choose(fx.LEFT_COUNTRIES, 's_nationkey')} as country_name,
    'L' || s_suppkey || ' | ' || p_brand as lei, s_acctbal as balance
  from supplier join part on p_partkey = s_suppkey"""
ORG_RIGHT = f"""select c_custkey as entity_id,
    p_name || ' ' || c_mktsegment || ' ' || {_choose(fx.RIGHT_FORMS, 'c_custkey')} as SP_ENTITY_NAME,
    {_choose(fx.RIGHT_COUNTRIES, 'c_nationkey')} as SP_COUNTRY_NAME,
    'L' || c_custkey as SP_LEI, c_mktsegment as industry
  from customer join part on p_partkey = c_custkey"""
PAGES = """select page_id, url, regexp_extract(html, '<title>(.*?)</title>', 1) as title,
    regexp_extract(html, 'lang="(.*?)"', 1) as area,
    concat_ws(' | ', regexp_extract(url, '/([0-9]+)', 1), regexp_extract(url, '://([^/]*)/', 1)) as codes
  from pages"""
DOMAIN = "regexp_extract(url, '^http://[^/]*[.]([a-z]+)/', 1)"
PAGES_MOVED = f"select * replace (case when {DOMAIN} <> '' then {DOMAIN} else area end as area) from ({PAGES})"
PAGES_BLANK = f"""select * replace (case when page_id % 7 = 0 then null else title end as title,
    case when page_id % 5 = 0 then null else area end as area) from ({PAGES})"""

SIDES = {
    "org": (ORG_LEFT, ORG_RIGHT),
    "part": ("select * from part", "select * from part"),
    "page": (PAGES, PAGES),
    "moved": (PAGES_MOVED, PAGES),
    "blank": (PAGES_BLANK, PAGES_BLANK),
}


def keyed(fixture: str, cfg: MatchConfig, right_where: str = "true") -> str:
    """CTEs l and r: the rows of both sides with their keys."""
    left, right = SIDES[fixture]
    right = f"select * from ({right}) where {right_where}"

    def side(sql, name, country, lei, row, extras):
        extra = "".join(f", {c} as x_{c}" for c in extras)
        return (
            f"select {name} as name, {country} as country, {lei} as lei, {row} as pos{extra}, "
            f"{name_key(name)} as nk, {country_key(country)} as ck from ({sql})"
        )

    l = side(left, cfg.left_name_col, cfg.left_country_col, cfg.left_lei_col, cfg.left_id_col, cfg.left_extra_cols)
    r = side(
        right, cfg.right_name_col, cfg.right_country_col, cfg.right_lei_col, cfg.right_id_col, cfg.right_extra_cols
    )
    return f"l as materialized ({l}), r as materialized ({r})"


# ------------------------------------------------------------------------------- scorers


def _codes(s: str) -> str:
    return (
        f"(case when {s} = '' then []::integer[] else "
        f"list_transform(string_split({s}, ''), lambda ch: instr({lit(ALPHABET)}, ch)::integer) end)"
    )


def _masks(codes: str) -> str:
    return (
        f"list_transform(range(1, {len(ALPHABET) + 1}), lambda k: "
        f"coalesce(list_sum(list_transform({codes}, lambda cd, i: "
        "case when cd = k then 1::bigint << (i - 1)::integer else 0::bigint end)), 0)::bigint)"
    )


def _lcs(masks: str, size: str, codes: str) -> str:
    full = f"((1::bigint << ({size})::integer) - 1)"
    return (
        f"({size} - bit_count(list_reduce({codes}, lambda st, k: "
        f"((st + (st & {masks}[k])) | (st - (st & {masks}[k]))) & {full}, {full})))"
    )


def _ratio(a: str, b: str) -> str:
    """Ratio of two prepared names (columns x_m, x_n, x_c: masks, size, codes)."""
    return (
        f"(case when {a}_n = 0 or {b}_n = 0 then 0::double else "
        f"200::double * {_lcs(f'{a}_m', f'{a}_n', f'{b}_c')} / ({a}_n + {b}_n) end)"
    )


def _partial_one(a: str, b: str) -> str:
    low, high = f"greatest(1, e - {a}_n + 1)", f"least(e, {b}_n)"
    part = f"{b}_c[{low}:{high}]"
    return (
        f"list_max(list_transform(range(1, {a}_n + {b}_n), lambda e: "
        f"200::double * {_lcs(f'{a}_m', f'{a}_n', part)} / ({a}_n + {high} - {low} + 1)))"
    )


def _partial(a: str, b: str) -> str:
    return (
        f"(case when {a}_n = 0 or {b}_n = 0 then 0::double "
        f"when {a}_n < {b}_n then {_partial_one(a, b)} "
        f"when {a}_n > {b}_n then {_partial_one(b, a)} "
        f"else greatest({_partial_one(a, b)}, {_partial_one(b, a)}) end)"
    )


def scores(pairs: str, scorers) -> str:
    """CTEs ending in ``scored(a, b, <scorer>...)`` for distinct name pairs (a, b)."""
    need = set(scorers)
    tokens = need & {"token_sort_ratio", "token_set_ratio", "WRatio", "ensemble"}
    prepared = lambda s, t: f"{t} as {s}_t, length({t}) as {s}_n, {_codes(t)} as {s}_c"
    sql = f"""
    dp as materialized (select distinct a, b from ({pairs})),
    nm0 as (select a as n from dp union select b from dp),
    nm1 as (select n, {prepared('p', 'n')},
        array_to_string(list_sort(string_split(n, ' ')), ' ') as st,
        case when n = '' then []::varchar[] else list_sort(list_distinct(string_split(n, ' '))) end as tk
      from nm0),
    nm as materialized (select *, {_masks('p_c')} as p_m, s_m_codes as s_c, {_masks('s_m_codes')} as s_m,
        length(st) as s_n from (select *, {_codes('st')} as s_m_codes from nm1)),
    j0 as (select dp.a, dp.b,
        x.p_n as a_n, x.p_c as a_c, x.p_m as a_m, y.p_n as b_n, y.p_c as b_c, y.p_m as b_m,
        x.s_n as sa_n, x.s_c as sa_c, x.s_m as sa_m, y.s_n as sb_n, y.s_c as sb_c, y.s_m as sb_m,
        list_sort(list_filter(x.tk, lambda w: list_contains(y.tk, w))) as both_t,
        array_to_string(list_filter(x.tk, lambda w: not list_contains(y.tk, w)), ' ') as da,
        array_to_string(list_filter(y.tk, lambda w: not list_contains(x.tk, w)), ' ') as db,
        len(x.tk) as na, len(y.tk) as nb
      from dp join nm x on x.n = dp.a join nm y on y.n = dp.b),
    j1 as (select *, length(array_to_string(both_t, ' ')) as s, {_codes('da')} as da_c, {_codes('db')} as db_c,
        length(da) as da_n, length(db) as db_n,
        case when len(both_t) > 0 then 1 else 0 end as g from j0),
    j2 as materialized (select *, {_masks('da_c')} as da_m, {_masks('db_c')} as db_m from j1),"""
    parts = ["a", "b"]
    if need & {"WRatio", "ensemble", "ratio"}:
        parts.append(f"{_ratio('a', 'b')} as base")
    if need & {"WRatio", "ensemble", "partial_ratio"}:
        parts.append(f"{_partial('a', 'b')} as part")
    if tokens:
        parts.append(f"{_ratio('sa', 'sb')} as tsort")
        set_score = (
            "(case when na = 0 or nb = 0 then 0::double "
            "when s > 0 and (da_n = 0 or db_n = 0) then 100::double "
            f"else greatest(100::double * (2 * (s + g) + da_n + db_n - (da_n + db_n - 2 * "
            f"(case when da_n = 0 or db_n = 0 then 0 else {_lcs('da_m', 'da_n', 'db_c')} end)))"
            " / (2 * (s + g) + da_n + db_n), "
            "case when s > 0 then 200::double * s / (2 * s + g + da_n) else 0 end, "
            "case when s > 0 then 200::double * s / (2 * s + g + db_n) else 0 end) end)"
        )
        parts.append(f"{set_score} as tset")
        if need & {"WRatio", "ensemble"}:
            token = (
                f"(case when greatest(a_n, b_n) * 2 < least(a_n, b_n) * 3 then 0 when s > 0 then 100::double "
                f"else greatest({_partial('sa', 'sb')}, {_partial('da', 'db')}) end)"
            )
            parts.append(f"{token} as ptok")
            parts.append("least(a_n, b_n) as short, greatest(a_n, b_n) as long")
    sql += f"\n    j3 as materialized (select {', '.join(parts)} from j2),\n"
    weighted = (
        "(case when short = 0 then 0::double when 2 * long < 3 * short "
        "then greatest(base, 0.95::double * greatest(tsort, tset)) "
        "else greatest(base, part * k, ptok * 0.95::double * k) end)"
    )
    k = "case when long <= 8 * short then 0.9::double else 0.6::double end"
    columns = {
        "ratio": "base", "partial_ratio": "part", "token_sort_ratio": "tsort", "token_set_ratio": "tset",
        "WRatio": weighted, "ensemble": f"greatest({weighted}, part)",
    }
    source = f"(select *, {k} as k from j3)" if need & {"WRatio", "ensemble"} else "j3"
    chosen = ", ".join(f"{columns[x]} as {x}" for x in scorers)
    return sql + f"    scored as materialized (select a, b, {chosen} from {source})"


# ---------------------------------------------------------------------------- the pipeline

STRICT_PAIRS = "select l.nk as a, r.nk as b from l join r on l.ck = r.ck where l.nk <> ''"


def match_rows(fixture: str, cfg: MatchConfig, right_where: str = "true") -> str:
    """CTEs ending in ``ranked``: one row per kept pair with rank and flags."""
    pairs = STRICT_PAIRS
    if cfg.relax_country:
        pairs += " union all select l.nk, r.nk from l cross join r where l.nk <> '' and l.ck <> r.ck"
    t, n = f"{cfg.score_threshold}::double", cfg.top_n
    x_l = "".join(f", l.x_{c} as left_{c}" for c in cfg.left_extra_cols)
    x_r = "".join(f", r.x_{c} as right_{c}" for c in cfg.right_extra_cols)
    row = (
        "l.name as l_name, l.country as l_country, l.lei as l_lei, l.pos as l_pos, r.name as r_name, "
        f"r.country as r_country, r.lei as r_lei, r.pos as r_pos, {cfg.scorer} as raw{x_l}{x_r}"
    )
    kept = "qualify row_number() over (partition by l.pos order by raw desc, r.pos) <= " + str(n)
    sql = f"""{keyed(fixture, cfg, right_where)}, {scores(pairs, [cfg.scorer])},
    strict as materialized (select {row}, true as country_match from l join r on l.ck = r.ck
      join scored on scored.a = l.nk and scored.b = r.nk where l.nk <> '' and {cfg.scorer} >= {t} {kept})"""
    union = "select * from strict"
    if cfg.relax_country:
        sql += f""",
    relaxed as (select {row}, false as country_match
      from (select * from l where pos not in (select l_pos from strict)) l
      join scored on scored.a = l.nk join r on scored.b = r.nk
      where l.nk <> '' and l.ck <> r.ck and {cfg.scorer} >= {t} {kept})"""
        union += " union all select * from relaxed"
    return sql + f""",
    ranked as (select *, round_even(raw, 2) as fuzzy_score,
        len(list_intersect({lei_set('l_lei')}, {lei_set('r_lei')})) > 0 as lei_match,
        row_number() over (partition by l_name, l_country
          order by round_even(raw, 2) desc, l_pos, raw desc, r_pos) as match_rank
      from ({union}))"""


def result_columns(cfg: MatchConfig) -> str:
    extras = "".join(f", left_{c}" for c in cfg.left_extra_cols)
    extras += "".join(f", right_{c}" for c in cfg.right_extra_cols)
    return (
        f"l_name as left_{cfg.left_name_col}, l_country as left_{cfg.left_country_col}, "
        f"l_lei as left_{cfg.left_lei_col}, r_name as right_{cfg.right_name_col}, "
        f"r_country as right_{cfg.right_country_col}, r_lei as right_{cfg.right_lei_col}, "
        f"fuzzy_score, lei_match, country_match, match_rank{extras}"
    )


def match_sql(fixture: str, cfg: MatchConfig, right_where: str = "true") -> str:
    return f"with {match_rows(fixture, cfg, right_where)} select {result_columns(cfg)} from ranked"


def truth(fixture_cfg: MatchConfig) -> str:
    """CTE truth over l and r: pairs of rows sharing an identifier."""
    return f"""ll as (select distinct pos, nk, ck, unnest({lei_set('lei')}) as v from l),
    rr as (select distinct pos, nk, ck, unnest({lei_set('lei')}) as v from r),
    truth as materialized (select distinct ll.pos as left_id, rr.pos as right_id, ll.nk as left_key,
      rr.nk as right_key, ll.ck as left_country_key, rr.ck as right_country_key
      from ll join rr on ll.v = rr.v)"""
