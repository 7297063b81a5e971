"""The same results as plain SQL over the given tables, by other means: ranks and
``IGNORE NULLS`` windows over whole series, self joins, sorted quantiles."""

from __future__ import annotations


Y = "muc_thuong_luu"

EVENTS = """
panel as (
  select event_type as site_id, date_trunc('hour', ts) as "timestamp",
         avg(value) as muc_thuong_luu, max(length(event_type))::double as muc_dang_binh_thuong,
         sum(value) as luu_luong_den, max(value) as tong_luong_xa,
         avg(case when value > 60 then value end) as xa_tran, count(*)::double as so_cua_xa_mat
  from events group by all)"""
USERS = """
panel as (
  select user_id::varchar as site_id, date_trunc('hour', ts) as "timestamp",
         avg(value) as muc_thuong_luu, avg(case when event_type = 'view' then value end) as luu_luong_den
  from events group by all)"""
ORDERS = """
panel as (
  select o_orderpriority as site_id, o_orderdate as "timestamp", avg(o_totalprice) as muc_thuong_luu
  from orders group by all)"""
EVENT_COLS = ["muc_thuong_luu", "muc_dang_binh_thuong", "luu_luong_den", "tong_luong_xa", "xa_tran", "so_cua_xa_mat"]
USER_COLS = ["muc_thuong_luu", "luu_luong_den"]


def r(expr: str, name: str | None = None) -> str:
    return f"{rnd(expr)} as {name or expr}"


def rnd(expr: str) -> str:
    """Six decimals, moved off rounding edges as in ``inputs.comparable``."""
    return f"(round(({expr})::double + 3.3e-8, 6) + 0.0)"


def regular(cols: list[str], hours: int = 1, limit: int = 48, fill: bool = True, source: str = "panel") -> str:
    """CTEs up to ``regular``: grid, neighbours, interpolation."""
    up = 'over (partition by site_id order by "timestamp" rows between unbounded preceding and current row)'
    down = 'over (partition by site_id order by "timestamp" rows between current row and unbounded following)'
    near, out = [], []
    for c in cols:
        at = f'case when {c} is not null then "timestamp" end'
        near += [
            f"last_value({at} ignore nulls) {up} as pt_{c}", f"last_value({c} ignore nulls) {up} as py_{c}",
            f"first_value({at} ignore nulls) {down} as nt_{c}", f"first_value({c} ignore nulls) {down} as ny_{c}",
        ]
        k = f"(date_diff('hour', pt_{c}, \"timestamp\") / {hours}.0)"
        m = f"(date_diff('hour', \"timestamp\", nt_{c}) / {hours}.0)"
        gap = f"(date_diff('hour', pt_{c}, nt_{c}) / {hours}.0)"
        out.append(
            f"""case when {c} is not null then {c} when pt_{c} is null then ny_{c}
                when nt_{c} is null then py_{c}
                else py_{c} + (ny_{c} - py_{c})
                     * (case when {k} <= {limit} or {m} <= {limit} then {k} else {limit} end) / {gap}
                end as {c}"""
            if fill else c
        )
    some = " or ".join(f"p.{c} is null" for c in cols)
    return f"""
ends as (select site_id, min("timestamp") as lo, max("timestamp") as hi from {source} group by 1),
grid as (select site_id, unnest(generate_series(lo, hi, interval {hours} hour)) as "timestamp" from ends),
cells as (
  select g.site_id, g."timestamp", {', '.join('p.' + c for c in cols)},
         ({some})::int as was_imputed
  from grid g left join {source} p on p.site_id = g.site_id and p."timestamp" = g."timestamp"),
near as (select *, {', '.join(near)} from cells),
regular as (
  select site_id, "timestamp", {', '.join(out)}, was_imputed,
         row_number() over (partition by site_id order by "timestamp") - 1 as time_idx,
         count(*) over (partition by site_id) as series_len
  from near)"""


SPLIT = """
parts as (
  select *, case when time_idx < floor(series_len * 0.7::double) then 'train'
                 when time_idx < floor(series_len * (0.7::double + 0.15::double)) then 'val'
                 else 'test' end as split
  from regular)"""


def calendar(ts: str = '"timestamp"', hours: int = 7) -> dict[str, str]:
    wall = f"({ts} + interval {hours} hour)"
    raw = {"hour": f"hour({wall})", "dow": f"(isodow({wall}) - 1)", "doy": f"dayofyear({wall})"}
    out = dict(raw)
    for name, p in (("hour", 24), ("dow", 7), ("doy", 366)):
        out[f"{name}_sin"] = f"sin(2 * pi() * {raw[name]} / {p}.0)"
        out[f"{name}_cos"] = f"cos(2 * pi() * {raw[name]} / {p}.0)"
    out["is_weekend"] = f"({raw['dow']} >= 5)::int"
    return out


def calendar_select(names: list[str] | None = None, ts: str = '"timestamp"') -> str:
    cal = calendar(ts)
    names = names or list(cal)
    return ", ".join(r(cal[n], n) if n.endswith(("_sin", "_cos")) else f"{cal[n]} as {n}" for n in names)


def rounded(cols: list[str]) -> str:
    return ", ".join(r(c) for c in cols)


def features(lags: list[int], windows: list[int], y: str = Y, rnd: bool = True, source: str = "regular") -> str:
    wrap = r if rnd else (lambda e, n: f"{e} as {n}")
    w = 'partition by site_id order by "timestamp"'
    cols = [wrap(f"lag({y}, {n}) over ({w})", f"{y}_lag_{n}") for n in lags]
    for n in windows:
        frame = f"over ({w} rows between {n} preceding and 1 preceding)"
        for s, f in (("mean", "avg"), ("std", "stddev_samp")):
            expr = f"(case when count({y}) {frame} >= {max(1, n // 3)} then {f}({y}) {frame} end)"
            cols.append(wrap(expr, f"{y}_rolling_{s}_{n}"))
    return ", ".join(cols)


def quantiles(source: str, keys: str, value: str) -> str:
    """Observed quantiles at rank ceil(q n) per group, as lo, mid, hi."""
    pick = lambda q, n: f"max(case when rk = greatest(1, ceil({q}::double * n)) then v end) as {n}"
    return f"""(
  select {keys}, {pick(0.1, 'lo')}, {pick(0.5, 'mid')}, {pick(0.9, 'hi')} from (
    select {keys}, {value} as v, row_number() over (partition by {keys} order by {value}) as rk,
           count(*) over (partition by {keys}) as n
    from {source} where {value} is not null)
  group by {keys})"""


def with_(*ctes: str, body: str) -> str:
    return "with " + ",".join(ctes) + body


H = 24
EV = (EVENTS, regular(EVENT_COLS))
EVS = (*EV, SPLIT)

# Persistence from every validation origin: self joins of whole series.
def step_changes(horizon: int) -> str:
    return f"""
changes as (
  select a.site_id, b.time_idx - a.time_idx as step, b.{Y} - a.{Y} as d
  from parts a join parts b on a.site_id = b.site_id and b.time_idx between a.time_idx + 1 and a.time_idx + {horizon}
  where a.split = 'train' and b.split = 'train'),
spread as {quantiles('changes', 'site_id, step', 'd')}"""


def long_persistence(horizon: int) -> str:
    return f"""
  select o.site_id, o.time_idx as origin_idx, a.step::int as step, o."timestamp" + to_hours(a.step::int) as "timestamp",
    {rounded(["q10", "q50", "q90"])}
  from (select *, {Y} as v from parts where time_idx = series_len - 1) o
  cross join (select unnest(generate_series(1, {horizon})) as step) a
  left join (select * from spread) s on s.site_id = o.site_id and s.step = a.step
  cross join lateral (select o.v + s.lo as q10, o.v + s.mid as q50, o.v + s.hi as q90)"""


CHANGES = step_changes(H)
BACKTEST = f"""
{CHANGES.strip()},
backtest as (
  select a.site_id, a.time_idx as origin_idx, (b.time_idx - a.time_idx)::int as step, b."timestamp",
         a.{Y} + s.lo as q10, a.{Y} + s.mid as q50, a.{Y} + s.hi as q90, b.{Y} as y
  from parts a
  join parts b on a.site_id = b.site_id and b.time_idx between a.time_idx + 1 and a.time_idx + {H}
  left join spread s on s.site_id = a.site_id and s.step = b.time_idx - a.time_idx
  where a.split = 'val' and a.time_idx + {H} < a.series_len)"""
BT = (*EVS, BACKTEST)


def seasonal_changes(season: int, seasons: int) -> str:
    lags = " union all ".join(
        f"""select site_id, {k} as k, {Y} - lag({Y}, {k * season}) over w as d, split, lag(split, {k * season}) over w as before,
               time_idx, series_len from parts window w as (partition by site_id order by time_idx)"""
        for k in range(1, seasons + 1)
    )
    return f"""
season_changes as (
  select site_id, k, d from ({lags})
  where split = 'train' and before = 'train' and time_idx <= series_len - 1 - :holdout),
season_spread as {quantiles('season_changes', 'site_id, k', 'd')}"""


def seasonal(season: int, horizon: int, holdout: int) -> str:
    seasons = -(-horizon // season)
    return seasonal_changes(season, seasons).replace(":holdout", str(holdout)) + f""",
recent as materialized (
  select site_id, series_len - 1 - {holdout} as origin_idx, time_idx - (series_len - 1 - {holdout}) as back, "timestamp" as t, {Y} as v
  from parts where time_idx <= series_len - 1 - {holdout} and time_idx > series_len - 1 - {holdout} - {season}),
seasonal as (
  select site_id, origin_idx, (back + k * {season})::int as step, t + to_hours((k * {season})::int) as "timestamp",
         v + lo as q10, v + mid as q50, v + hi as q90
  from (select r.*, ks.k, s.lo, s.mid, s.hi from recent r cross join (select unnest(generate_series(1, {seasons})) as k) ks
        left join season_spread s on s.site_id = r.site_id and s.k = ks.k)
  where back + k * {season} <= {horizon})"""


def seasonal_backtest(season: int, horizon: int, split: str = "val") -> str:
    seasons = -(-horizon // season)
    return seasonal_changes(season, seasons).replace(":holdout", "0") + f""",
seasonal_backtest as (
  select o.site_id, o.time_idx as origin_idx, (a.time_idx - o.time_idx)::int as step, a."timestamp",
         b.{Y} + s.lo as q10, b.{Y} + s.mid as q50, b.{Y} + s.hi as q90, a.{Y} as y
  from parts o
  join parts a on a.site_id = o.site_id and a.time_idx between o.time_idx + 1 and o.time_idx + {horizon}
  left join parts b on b.site_id = o.site_id
       and b.time_idx = a.time_idx - {season} * ((a.time_idx - o.time_idx + {season - 1}) // {season})
  left join season_spread s on s.site_id = o.site_id
       and s.k = (a.time_idx - o.time_idx + {season - 1}) // {season}
  where o.split = '{split}' and o.time_idx + {horizon} < o.series_len and o.time_idx >= {season - 1})"""


def irls(iterations: int) -> str:
    """Coefficients of y = b0 + b1 * y_origin + b2 * inflow by reweighted normal equations, per
    quantile; Cramer's rule over the sums of three inputs."""
    def det(m: list[list[str]]) -> str:
        (a, b, c), (d, e, f), (g, h, i) = m
        return f"({a} * ({e} * {i} - {f} * {h}) - {b} * ({d} * {i} - {f} * {g}) + {c} * ({d} * {h} - {e} * {g}))"

    x = ["1.0::double", "x1", "x2"]
    gram = [[f"g{min(i, j)}{max(i, j)}" for j in range(3)] for i in range(3)]
    sums = ", ".join([f"sum(w * {x[i]} * {x[j]}) as g{i}{j}" for i in range(3) for j in range(i, 3)] + [f"sum(w * {x[i]} * y) as r{i}" for i in range(3)])
    column = lambda k: [[f"r{i}" if j == k else gram[i][j] for j in range(3)] for i in range(3)]
    coefficients = ", ".join(f"{det(column(k))} / {det(gram)} as b{k}" for k in range(3))
    residual = "(y - (b0 + b1 * x1 + b2 * x2))"
    steps = [f"""
pairs as materialized (
  select a.{Y} as x1, b.luu_luong_den as x2, b.{Y} as y
  from parts a join parts b on a.site_id = b.site_id and b.time_idx between a.time_idx + 1 and a.time_idx + {H}
  where a.split = 'train' and b.split = 'train' and a.{Y} is not null and b.{Y} is not null and b.luu_luong_den is not null),
c0 as materialized (select q, {coefficients} from (select {sums} from (select *, 1.0::double as w from pairs))
                    cross join (select unnest([0.1, 0.5, 0.9]) as q)),
least as materialized (select 0.05 * avg(abs({residual})) as floor from pairs cross join (select * from c0 where q = 0.5))"""]
    for k in range(1, iterations + 1):
        weight = f"(case when {residual} < 0 then 1.0 - q else q end)::double / greatest(abs({residual}), floor)"
        steps.append(f"""
c{k} as materialized (select q, {coefficients} from (
  select q, {sums} from (select *, {weight} as w from pairs cross join c{k - 1} cross join least) group by q))""")
    return ",".join(steps)


BANDS = rounded(["q10", "q50", "q90"])
FORECAST = f'site_id, origin_idx, step, "timestamp", {BANDS}'

SCALED_GROUPS = {
    "obs": ["muc_thuong_luu", "luu_luong_den", "tong_luong_xa", "xa_tran", "so_cua_xa_mat", "was_imputed"],
    "static": ["muc_dang_binh_thuong"],
    "known": ["hour_sin", "hour_cos", "dow_sin", "dow_cos", "doy_sin", "doy_cos", "is_weekend"],
}
CAL_PARTS = "\ncal as (select parts.*, " + ", ".join(f"{v} as {k}" for k, v in calendar().items()) + " from parts)"


CALENDAR_KNOWN = SCALED_GROUPS["known"]
ROLE_FEATURES = [f"{Y}_lag_1", f"{Y}_lag_24", f"{Y}_rolling_mean_24", f"{Y}_rolling_std_24"]


def profiled(groups: dict[str, list[str]], source: str, more: str = "") -> str:
    """Counts and moments of each column by split; names that are not numbers have counts only."""
    def one(role: str, c: str) -> str:
        x = "null::double" if c == "site_id" else f"{c}::double"
        return f"""
  select split, '{role}' as "role", '{c}' as "column", count({c}) as n_known, count(*) - count({c}) as n_missing,
         {r(f'avg({x})', 'mean')}, {r(f'min({x})', 'lowest')}, {r(f'max({x})', 'highest')}{more} from {source} group by split"""

    return " union all ".join(one(role, c) for role, names in groups.items() for c in names)


def scaled(columns: list[str]) -> str:
    parts = []
    for c in columns:
        parts.append(f"(select avg({c}) from cal where split = 'train') as m_{c}")
        parts.append(
            f"(select case when stddev_pop({c}) = 0 then 1 else stddev_pop({c}) end from cal where split = 'train') as s_{c}"
        )
    return "\nst as (select " + ", ".join(parts) + ")"


def z(c: str) -> str:
    return f"(({c} - m_{c}) / s_{c})"


def window_sql(condition: str, source: str = "regular") -> str:
    return f"""
  select o.site_id, o.time_idx as origin_idx, (w.time_idx - o.time_idx)::int as step, w."timestamp",
         {r('w.' + Y, Y)}, {r('(w.time_idx - o.time_idx - 1) / 24.0', 'relative_idx')}
  from {source} o join {source} w on o.site_id = w.site_id
       and w.time_idx between o.time_idx - 23 and o.time_idx + 12
  where o.time_idx >= 23 and o.time_idx + 12 < o.series_len and {condition}"""


CUT = "(select max(time_idx) - 12 from regular)"


RAW4 = ["muc_thuong_luu", "luu_luong_den", "tong_luong_xa", "xa_tran"]
RAW_A = f"""
raw as (
  select site_id, "timestamp", {', '.join(f'round({c}, 4) as {c}' for c in RAW4)},
         muc_dang_binh_thuong, so_cua_xa_mat::bigint as gates
  from panel)"""
PANEL_OUT = """
  select "timestamp", site_id, {level} as muc_thuong_luu, {normal} as muc_dang_binh_thuong,
         {dead} as muc_chet, {inflow} as luu_luong_den, {total} as tong_luong_xa, {spill} as xa_tran,
         {plant} as xa_nha_may, {deep} as so_cua_xa_sau, {surface} as so_cua_xa_mat
  from raw"""
AS_GIVEN = dict(
    level="muc_thuong_luu", normal="muc_dang_binh_thuong", dead="1.5::double", inflow="luu_luong_den",
    total="tong_luong_xa", spill="xa_tran", plant="0.25::double", deep="0::bigint", surface="gates",
)


def layered(short_lines: bool) -> dict[str, str]:
    """The winning layout per row: short lines over revised rows over the first ones."""
    zero = {"normal": "0.0", "dead": "0.0", "inflow": "0.0", "spill": "0.0", "plant": "0.0",
            "deep": "0", "surface": "0"}
    revised = {
        "level": "case when tong_luong_xa > 200 then null else muc_thuong_luu + 1 end",
        "total": "tong_luong_xa + 1", **zero,
    }
    out = {}
    for k, first in AS_GIVEN.items():
        short = "7.5" if k == "level" else "null"
        top = f"when luu_luong_den > 500 then {short}" if short_lines else ""
        out[k] = f"case {top} when muc_thuong_luu > 50 then {revised[k]} else {first} end"
    return {k: rnd(v) for k, v in out.items()}


ROUNDED_GIVEN = {k: rnd(v) for k, v in AS_GIVEN.items()}

METRICS = f"""
  {r('avg(abs(y - q50))', 'mae')}, {r('sqrt(avg((y - q50) * (y - q50)))', 'rmse')},
  {r('avg(abs((y - q50) / (y + 1e-8))) * 100', 'mape')},
  {r('avg((y >= q10 and y <= q90)::int) * 100', 'coverage')},
  {r('avg(q90 - q10)', 'interval_width')}, {r('stddev_pop(q90 - q10)', 'sharpness')}"""


def pinball(band: str, q: float) -> str:
    return f"avg(greatest({q}::double * (y - {band}), ({q}::double - 1) * (y - {band})))"


AVG_PINBALL = f"(({pinball('q10', 0.1)} + {pinball('q50', 0.5)} + {pinball('q90', 0.9)}) / 3)"


def horizon(h: int, name: str) -> str:
    e = f"(case when step <= {h} then y - q50 end)"
    return f"{r(f'avg(abs({e}))', f'mae_{name}')}, {r(f'sqrt(avg({e} * {e}))', f'rmse_{name}')}"


def report() -> str:
    """Report lines with four decimals."""
    groups = {
        "Overall Performance": {
            "MAE": "avg(abs(y - q50))", "RMSE": "sqrt(avg((y - q50) * (y - q50)))",
            "MAPE": "avg(abs((y - q50) / (y + 1e-8))) * 100",
            "Coverage_80%": "avg((y >= q10 and y <= q90)::int) * 100",
            "Interval_Width": "avg(q90 - q10)", "Sharpness": "stddev_pop(q90 - q10)",
        },
        "Horizon-wise Performance": {
            f"{m}_{n}": f"{f}(avg({g}(case when step <= {h} then y - q50 end{p})))".replace("id(", "(")
            for n, h in (("24h", 24), ("7d", 168), ("14d", 336))
            for m, f, g, p in (("MAE", "", "abs", ""), ("RMSE", "sqrt", "pow", ", 2"))
        },
        "Quantile Loss": {
            "Pinball_Q10": pinball("q10", 0.1), "Pinball_Q50": pinball("q50", 0.5),
            "Pinball_Q90": pinball("q90", 0.9), "Avg_Pinball": AVG_PINBALL,
        },
    }
    lines = []
    for title, fields in groups.items():
        lines.append(f"'{title}:'")
        lines += [f"'  {n}: ' || printf('%.4f', {e})" for n, e in fields.items()]
    return f"select unnest([{', '.join(lines)}]) as value from backtest"


S, T = "site_id", '"timestamp"'

ORACLE: dict[str, str] = {
    # sources
    "crawl_ingest": with_(EVENTS, RAW_A, body=PANEL_OUT.format(**layered(True))),
    "crawl_rejects": with_(EVENTS, body="""
  select * from (
    select 'too many fields' as reject_reason, count(*) as n from panel where so_cua_xa_mat > 2
    union all select 'failure row', count(*) from panel where so_cua_xa_mat = 2
    union all select 'bad timestamp', count(*) from panel where so_cua_xa_mat = 1) where n > 0"""),
    "upload_batch": with_(EVENTS, RAW_A, body=PANEL_OUT.format(**layered(False))),
    "panel_csv_roundtrip": with_(EVENTS, body=f"""
  select {S}, {T}, {rounded(EVENT_COLS[:-1])}, so_cua_xa_mat::bigint as so_cua_xa_mat from panel"""),
    "page_records": with_(EVENTS, RAW_A, body=PANEL_OUT.format(**ROUNDED_GIVEN)),
    "month_append": with_(EVENTS, RAW_A, body=PANEL_OUT.format(**ROUNDED_GIVEN)),
    "poll_batches": with_(EVENTS, body="""
  select 'records' as kind, count(*) as n from panel union all select 'failures', count(*) from pages"""),
    "poll_failures": """
  select strftime(polled, '%Y-%m-%d %H:%M') as "timestamp", 200 as status_code,
         '{''td'': ''' || page_id || '''}' as params, strftime(polled, '%Y-%m') as month,
         md5(case when length(html) > 5000 then substring(html, 1, 5000) || '…'
                  else regexp_replace(replace(html, chr(10), ' '), '^\\s+|\\s+$', '', 'g') end) as content
  from (select *, timestamp '2024-01-01' + to_hours((page_id * 2)::int) as polled from pages)""",
    # text and numbers
    "normalized_text": """
  select doc_id, md5(regexp_replace(regexp_replace(lower(strip_accents(text)), '[^\\p{L}\\p{N}\\s]', '', 'g'),
                     '^\\s+|\\s+$', '', 'g')) as plain_md5 from documents""",
    "header_fields": """
  select case
      when w like '%ten%' then 'ten_ho'
      when w like '%thoi%' or w like '%ngay%' or w like '%gio%' or w like '%timestamp%' then 'timestamp'
      when w like '%thuong%' and w like '%nuoc%' then 'muc_nuoc_thuong_luu'
      when (w like '%dang%' or w like '%binh%') and w like '%nuoc%' then 'muc_nuoc_dang_binh_thuong'
      when w like '%chet%' and w like '%nuoc%' then 'muc_nuoc_chet'
      when w like '%luu%' and w like '%den%' then 'luu_luong_den_ho'
      when w like '%tong%' and w like '%dap%' then 'tong_luong_xa_qua_dap_tran'
      when w like '%tong%' and w like '%nha%' then 'tong_luong_xa_qua_nha_may'
      when w like '%tong%' and w like '%xa%' then 'tong_luong_xa'
      when w like '%so%' and w like '%sau%' then 'so_cua_xa_sau'
      when w like '%so%' and w like '%mat%' then 'so_cua_xa_mat' end as field, count(*) as n
  from (select regexp_replace(lower(strip_accents(unnest(string_split(text, ' ')))), '[^\\p{L}\\p{N}\\s]', '', 'g') as w
        from documents) group by 1""",
    "expanded_headers": """
  select o_orderkey, array_to_string(list_concat(
      list_transform(generate_series(1, length(o_orderpriority) % 3 + 1), lambda x: o_orderstatus),
      list_transform(generate_series(1, day(o_orderdate) % 4 + 1), lambda x: o_orderpriority)), '|') as header
  from orders""",
    "data_rows": """
  select o_orderkey, o_orderstatus = 'F' or n >= 2 as is_data, o_orderstatus = 'F' or n >= 14 as is_data_wide
  from (select *, 2 + (try_cast(o_orderpriority as double) is not null)::int as n from orders)""",
    "tolerant_numbers": f"""
  select l_orderkey, l_linenumber, {rnd('v')} as as_float, {rnd('trunc(v)')} as as_int
  from (select *, case when l_returnflag in ('R', 'A') then round(l_extendedprice, 2) end as v from lineitem)""",
    # dedup, union, head and tail
    "keep_last_rows": f"""
  select {S}, {T}, {r('value')}, 1 as version, event_id from (
    select event_type as {S}, date_trunc('hour', ts) as {T}, value + 1 as value, -event_id as event_id,
           row_number() over (partition by event_type, date_trunc('hour', ts) order by event_id) as rk
    from events) where rk = 1""",
    "union_frames": """
  with p as (select event_type, date_trunc('hour', ts) as t from events group by all),
  q as (select user_id, date_trunc('hour', ts) as t, avg(case when event_type = 'view' then value end) as v
        from events group by all),
  u as (select t, 1 as target, null::double as v from p union all select t, null, v from q)
  select t as "timestamp", count(*) as n, count(target) as n_target, round(sum(v) + 3.3e-8, 6) + 0.0 as inflow from u group by 1""",
    "series_tail": with_(*EV, body=f"""
  select {S}, {T}, {r(Y)} from regular where time_idx >= series_len - 168"""),
    "series_tail_irregular": with_(USERS, body=f"""
  select {S}, {T}, {r(Y)} from panel
  qualify row_number() over (partition by {S} order by {T} desc) <= 24"""),
    "forecast_head": with_(*EVS, seasonal(24, 48, 48), body=f" select {FORECAST} from seasonal where step <= 12"),
    # regular grid
    "regular_panel_events": with_(*EV, body=f"""
  select {S}, {T}, {rounded(EVENT_COLS)}, was_imputed, time_idx, series_len from regular"""),
    "regular_panel_users": with_(USERS, regular(USER_COLS), body=f"""
  select {S}, {T}, {rounded(USER_COLS)}, was_imputed, time_idx, series_len from regular"""),
    "regular_panel_two_hourly": with_(USERS, regular(USER_COLS, hours=2), body=f"""
  select {S}, {T}, {rounded(USER_COLS)}, was_imputed, time_idx, series_len from regular"""),
    "regular_panel_orders_daily": with_(ORDERS, regular([Y], hours=24, limit=1), body=f"""
  select {S}, {T}, {r(Y)}, was_imputed, time_idx, series_len from regular"""),
    "grid_without_fill": with_(EVENTS, regular(EVENT_COLS, fill=False), body=f"""
  select {S}, {T}, {rounded(EVENT_COLS)}, was_imputed, time_idx, series_len from regular"""),
    # features
    "calendar_features": f"""
  select o_orderkey, o_orderdate as {T}, {calendar_select(ts='o_orderdate')} from orders""",
    "lag_rolling_events": with_(*EV, body=f"""
  select {S}, {T}, {r(Y)}, {features([1, 3, 6, 24, 48, 168], [3, 12, 24, 168])} from regular"""),
    "lag_rolling_users": with_(USERS, regular(USER_COLS), body=f"""
  select {S}, {T}, {Y}_lag_24, {Y}_rolling_mean_24, {Y}_rolling_std_24, {Y}_rolling_mean_168, {Y}_rolling_std_168
  from (select {S}, {T}, {features([24], [24, 168])} from regular)"""),
    "lag_rolling_irregular": with_(USERS, body=f"""
  select {S}, {T}, {r('luu_luong_den')}, {features([1, 3], [3, 12], 'luu_luong_den')} from panel"""),
    "filled_features": with_(*EV, "\nfeat as (select site_id, \"timestamp\", time_idx, "
                             f"{Y}, {features([1, 3, 6, 24, 48, 168], [3, 12, 24, 168], rnd=False)} from regular)", body=f"""
  select {S}, {T}, time_idx, {r(Y)}, """ + ", ".join(
        r(f"coalesce(last_value({c} ignore nulls) over (partition by site_id order by time_idx), "
          f"first_value({c} ignore nulls) over (partition by site_id order by time_idx rows between current row and unbounded following))", c)
        for c in [*[f"{Y}_lag_{n}" for n in (1, 3, 6, 24, 48, 168)],
                  *[f"{Y}_rolling_{s}_{n}" for n in (3, 12, 24, 168) for s in ("mean", "std")]]
    ) + " from feat"),
    "filled_forward": with_(USERS, body=f"""
  select {S}, {T}, {r(Y)},
    {r('last_value(luu_luong_den ignore nulls) over (partition by site_id order by "timestamp")', 'luu_luong_den')}
  from panel"""),
    "series_position": f"""
  select user_id as {S}, ts as {T}, event_id, row_number() over (partition by user_id order by ts) - 1 as time_idx,
         count(*) over (partition by user_id) as series_len from events""",
    "series_position_segments": f"""
  select {S}, {T}, series_len, min(i) as first_idx, max(i) as last_idx
  from (select event_type as {S}, ts as {T}, row_number() over (partition by event_type order by ts) - 1 as i,
               count(*) over (partition by event_type) as series_len from events) group by 1, 2, 3""",
    # splits and scaling
    "ratio_split": with_(*EVS, body=f" select {S}, {T}, split from parts"),
    "ratio_split_irregular": with_(USERS, """
regular as (
  select *, row_number() over (partition by site_id order by "timestamp") - 1 as time_idx,
         count(*) over (partition by site_id) as series_len from panel)""", SPLIT,
                                   body=f" select {S}, {T}, split from parts"),
    "date_split": with_(EVENTS, body=f"""
  select {S}, {T}, case when {T} <= timestamp '2024-01-15 12:00:00' then 'train'
                        when {T} <= timestamp '2024-01-22' then 'val' else 'test' end as split from panel"""),
    "scaler_statistics": with_(*EVS, CAL_PARTS, body=" " + " union all ".join(
        f"""select '{g}' as "group", '{c}' as "column", {r(f'avg({c})', 'mean')},
            {r(f'case when stddev_pop({c}) = 0 then 1 else stddev_pop({c}) end', 'scale')} from cal where split = 'train'"""
        for g, cols in SCALED_GROUPS.items() for c in cols)),
    "scaler_moments": with_(*EVS, CAL_PARTS, body=" " + " union all ".join(
        f"""select '{g}' as "group", '{c}' as "column", {r(f'avg({c})', 'mean')},
            {r(f'case when stddev_pop({c}) = 0 then 1 else stddev_pop({c}) end', 'scale')} from cal where split = 'train'"""
        for g, cols in SCALED_GROUPS.items() for c in cols)),
    "scaled_panel": with_(*EVS, CAL_PARTS, scaled(
        [Y, "luu_luong_den", "xa_tran", "so_cua_xa_mat", "was_imputed", "muc_dang_binh_thuong", "hour_sin", "doy_cos", "is_weekend"]),
        body=f" select {S}, {T}, split, " + ", ".join(
            r(z(c), c) for c in [Y, "luu_luong_den", "xa_tran", "so_cua_xa_mat", "was_imputed", "muc_dang_binh_thuong",
                                 "hour_sin", "doy_cos", "is_weekend"]) + " from cal, st"),
    "split_sink": with_(*EVS, CAL_PARTS, scaled([Y, "hour_sin"]), body=f"""
  select 'raw' as "copy", split, count(*) as n, {r(f'avg({Y})', 'mean_target')}, {r('avg(hour_sin)', 'mean_hour_sin')}
  from cal group by 2 union all
  select 'scaled', split, count(*), {r(f'avg({z(Y)})', 'mean_target')}, {r(f"avg({z('hour_sin')})", 'mean_hour_sin')}
  from cal, st group by 2"""),
    "column_roles": with_(*EVS, CAL_PARTS, f"\nfeat as (select *, {features([1, 24], [24], rnd=False, source='cal')} from cal)", body=profiled({
        "static_categoricals": ["site_id"], "static_reals": ["muc_dang_binh_thuong"], "known": CALENDAR_KNOWN,
        "unknown": [*SCALED_GROUPS["obs"], *ROLE_FEATURES], "derived": ROLE_FEATURES,
    }, "feat")),
    "manifest_profile": with_(*EVS, CAL_PARTS, body=profiled(
        {"continuous_obs": SCALED_GROUPS["obs"], "known_future": CALENDAR_KNOWN, "static_real": ["muc_dang_binh_thuong"]}, "cal",
        """, 168::int as enc_len, 336::int as dec_len, '1H' as frequency, 'Asia/Bangkok' as timezone""")),
    # windows
    "cutoff": with_(*EV, body=" select max(time_idx) - 12 as cutoff from regular"),
    "windows_train": with_(*EV, body=window_sql(f"o.time_idx + 12 <= {CUT}")),
    "windows_validation": with_(*EV, body=window_sql(f"o.time_idx >= {CUT}")),
    "windows_last": with_(*EV, body=window_sql("o.time_idx = o.series_len - 13")),
    "windows_strided": with_(*EV, body=f"select {S}, origin_idx, step, {T}, {Y} from (" + window_sql("(o.time_idx - 23) % 12 = 0") + ")"),
    "windows_per_site_cutoff": with_(USERS, regular(USER_COLS), body=f"""
  select {S}, origin_idx, count(*) as n, {r(f'sum({Y})', 'total')} from (
    select o.site_id, o.time_idx as origin_idx, w.{Y}
    from regular o join regular w on o.site_id = w.site_id and w.time_idx between o.time_idx - 23 and o.time_idx + 12
    where o.time_idx >= 23 and o.time_idx = o.series_len - 13) group by 1, 2"""),
    "window_array_form": with_(*EV, body=f"""
  select {S}, origin_idx,
    md5(string_agg(case when step <= 0 then floor((v + 3.3e-8) * 1e6)::bigint::varchar end, '|' order by step)) as encoder,
    md5(string_agg(case when step > 0 then floor((v + 3.3e-8) * 1e6)::bigint::varchar end, '|' order by step)) as decoder
  from (select o.site_id, o.time_idx as origin_idx, w.time_idx - o.time_idx as step, w.{Y} as v
        from regular o join regular w on o.site_id = w.site_id and w.time_idx between o.time_idx - 23 and o.time_idx + 12
        where o.time_idx >= 23 and o.time_idx + 12 < o.series_len) group by 1, 2"""),
    "window_arrays_two_weeks": with_(USERS, regular(USER_COLS), body=f"""
  select site_id, origin_idx, {', '.join(
      f"""{r(f"max(case when step = {a} then v end)", f"{n}_first")}, {r(f"max(case when step = {b} then v end)", f"{n}_last")},
      {r(f"sum(case when step between {a} and {b} then coalesce(v, 0) * step else 0 end)", f"{n}_total")},
      count(case when step between {a} and {b} then 1 end)::int as {n}_size"""
      for n, a, b in (("encoder", -167, 0), ("decoder", 1, 336)))}
  from (select o.site_id, o.time_idx as origin_idx, w.time_idx - o.time_idx as step, w.{Y} as v
        from regular o join regular w on o.site_id = w.site_id and w.time_idx between o.time_idx - 167 and o.time_idx + 336
        where o.time_idx >= 167 and o.time_idx + 336 < o.series_len and (o.time_idx - 167) % 24 = 0) group by 1, 2"""),
    "cutoff_users": with_(USERS, body=f"""
  select max(n) - 12 as cutoff from (select date_diff('hour', min({T}), max({T})) as n from panel group by site_id)"""),
    "normalized_target": with_(*EV, body=f"""
  select {S}, {T}, {r(f'({Y} - avg({Y}) over (partition by site_id)) / stddev_samp({Y}) over (partition by site_id)', Y + '_norm')}
  from regular"""),
    "position_gaps": with_(USERS, body=f"""
  select * from (select {S}, {T},
    date_diff('hour', lag({T}) over (partition by site_id order by {T}), {T}) - 1 as gap_before from panel)
  where gap_before > 0"""),
    "inference_rows": with_(EVENTS, f"""
mixed as (
  select {S}, {T}, case when {T} < timestamp '2024-01-29' then {Y} end as {Y}, {T} >= timestamp '2024-01-29' as fut from panel)""",
        regular([Y], source="mixed"), f"""
marked as (select *, {T} > (select max({T}) from mixed m where not fut and m.site_id = regular.site_id) as is_future from regular),
st as (select avg({Y}) as m, stddev_pop({Y}) as s from marked where not is_future)""",
        body=f" select {S}, {T}, is_future, {r(f'({Y} - m) / s', Y)} from marked, st"),
    # forecasts
    "persistence": with_(*EVS, CHANGES, body=f"""
  select o.site_id, o.time_idx as origin_idx, a.step::int as step, o.{T} + to_hours(a.step::int) as {T},
    {r(f'o.{Y} + s.lo', 'q10')}, {r(f'o.{Y} + s.mid', 'q50')}, {r(f'o.{Y} + s.hi', 'q90')}, {r(f'f.{Y}', 'y')}
  from parts o cross join (select unnest(generate_series(1, {H})) as step) a
  left join spread s on s.site_id = o.site_id and s.step = a.step
  left join parts f on f.site_id = o.site_id and f.time_idx = o.time_idx + a.step
  where o.time_idx = o.series_len - 1 - {H}"""),
    "persistence_two_weeks": with_(*EVS, step_changes(336), body=long_persistence(336)),
    "persistence_users": with_(USERS, regular(USER_COLS), SPLIT, step_changes(336), body=long_persistence(336)),
    "seasonal": with_(*EVS, seasonal(24, 48, 48), body=f"""
  select {', '.join('f.' + c for c in ('site_id', 'origin_idx', 'step'))}, f.{T}, {BANDS}, {r(f'p.{Y}', 'y')}
  from seasonal f left join parts p on p.site_id = f.site_id and p.{T} = f.{T}"""),
    "seasonal_users": with_(USERS, regular(USER_COLS), SPLIT, seasonal(168, 336, 0), body=f" select {FORECAST} from seasonal"),
    "climatology": with_(*EVS, f"""
recent as (
  select site_id, hour({T} + interval 7 hour) as h, {Y} as v from parts
  where time_idx <= series_len - 1 - {H} and time_idx > series_len - 1 - {H} - 14 * 24),
byhour as {quantiles('recent', 'site_id, h', 'v')}""", body=f"""
  select o.site_id, o.time_idx as origin_idx, a.step::int as step, o.{T} + to_hours(a.step::int) as {T},
    {r('c.lo', 'q10')}, {r('c.mid', 'q50')}, {r('c.hi', 'q90')}, {r(f'f.{Y}', 'y')}
  from parts o cross join (select unnest(generate_series(1, {H})) as step) a
  left join byhour c on c.site_id = o.site_id and c.h = hour(o.{T} + to_hours(a.step::int) + interval 7 hour)
  left join parts f on f.site_id = o.site_id and f.time_idx = o.time_idx + a.step
  where o.time_idx = o.series_len - 1 - {H}"""),
    "persistence_backtest": with_(*BT, body=f" select {FORECAST}, {r('y')} from backtest"),
    "seasonal_backtest": with_(*EVS, seasonal_backtest(12, 24), body=f" select {FORECAST}, {r('y')} from seasonal_backtest"),
    "quantile_forecast": with_(*EVS, irls(4), body=f"""
  select o.site_id, o.time_idx as origin_idx, (f.time_idx - o.time_idx)::int as step, f.{T},
    {', '.join(f"{rnd(f'max(b0 + b1 * o.{Y} + b2 * f.luu_luong_den) filter (q = {q})')} as {n}" for q, n in ((0.1, 'q10'), (0.5, 'q50'), (0.9, 'q90')))}
  from parts o join parts f on f.site_id = o.site_id and f.time_idx > o.time_idx cross join c4
  where o.time_idx = o.series_len - 1 - {H} group by all"""),
    "covariates_as_issued": with_(*EV, f"""
i as (select site_id, {T} as t, {T} - to_hours(lead) as issued, luu_luong_den + lead as v
      from panel cross join (select unnest([6, 30, 54]) as lead)),
want as (
  select a.site_id, a.{T} as origin_ts, (b.time_idx - a.time_idx)::int as step, b.{T} as t, 'training' as part
  from regular a join regular b on a.site_id = b.site_id and b.time_idx between a.time_idx + 1 and a.time_idx + 48
  where a.time_idx % 24 = 0
  union all
  select site_id, max({T}) - to_hours(48), s::int, max({T}) - to_hours(48) + to_hours(s::int), 'inference'
  from regular cross join (select unnest(generate_series(1, 48)) as s) group by site_id, s)""", body=f"""
  select w.site_id, w.origin_ts, w.step, max(i.issued) as issued_at, {r('arg_max(i.v, i.issued)', 'rain_forecast_mm')}, w.part
  from want w left join i on i.site_id = w.site_id and i.t = w.t and i.issued <= w.origin_ts group by all"""),
    "as_of_rows": with_(EVENTS, f"""
hours as (select site_id, {T} + interval 1 hour as known, {Y} from panel where {Y} > 50)""", body=f"""
  select e.event_id, e.event_type as site_id, e.ts as {T}, {r(f'h.{Y}', Y)}
  from events e asof left join hours h on e.event_type = h.site_id and e.ts >= h.known"""),
    "request_forecast": with_(EVENTS.replace("from events", "from events where ts < timestamp '2024-01-29'"), regular([Y]), SPLIT,
                              seasonal(24, 48, 0), body=f" select site_id, step, {T}, {BANDS} from seasonal"),
    "selected_model": with_(
        *EVS, BACKTEST.replace("where a.split = 'val'", "where a.split = 'val' and b.split = 'val'"),
        seasonal_backtest(24, 24).replace("where o.split = 'val'", "where o.split = 'val' and a.split = 'val'"), f"""
losses as (
  select 'persistence' as model, {AVG_PINBALL} as loss from backtest
  union all select 'seasonal', {AVG_PINBALL} from seasonal_backtest)""", body=f"""
  select model, {r('loss')} from losses order by loss limit 1"""),
    "candidate_losses": with_(
        *EVS, irls(4), BACKTEST.replace("where a.split = 'val'", "where a.split = 'val' and b.split = 'val'"),
        seasonal_backtest(24, 24).replace("where o.split = 'val'", "where o.split = 'val' and a.split = 'val'"), f"""
linear as (
  select b.{Y} as y, max(b0 + b1 * a.{Y} + b2 * b.luu_luong_den) filter (q = 0.1) as q10,
         max(b0 + b1 * a.{Y} + b2 * b.luu_luong_den) filter (q = 0.5) as q50, max(b0 + b1 * a.{Y} + b2 * b.luu_luong_den) filter (q = 0.9) as q90
  from parts a join parts b on a.site_id = b.site_id and b.time_idx between a.time_idx + 1 and a.time_idx + {H} cross join c4
  where a.split = 'val' and b.split = 'val' and a.time_idx + {H} < a.series_len group by a.site_id, a.time_idx, b.time_idx, b.{Y}),
losses as (
  select 'linear' as model, {AVG_PINBALL} as loss from linear union all
  select 'persistence' as model, {AVG_PINBALL} as loss from backtest
  union all select 'seasonal', {AVG_PINBALL} from seasonal_backtest)""", body=f"""
  select model, {r('loss')} from losses"""),
    "future_steps": with_(USERS, body=f"""
  select {S}, step::int as step, hi + to_hours(step::int) as {T}
  from (select {S}, max({T}) as hi from panel group by 1) cross join (select unnest(generate_series(1, 48)) as step)"""),
    "forecast_envelope": with_(*BT, body=f"""
  select {S}, origin_idx, step, {r('least(q10, q50, q90)', 'lower')}, {r('q90', 'median')},
    {r('greatest(q10, q50, q90)', 'upper')}, {r('q50', 'sorted_median')} from backtest"""),
    "unscaled_forecast": with_(*EVS, seasonal(24, 24, 24), body=f" select {FORECAST} from seasonal"),
    "known_future_rows": with_(EVENTS, f"""
ahead as (
  select {S}, step::int as step, hi + to_hours(step::int) as t
  from (select {S}, max({T}) as hi from panel group by 1) cross join (select unnest(generate_series(1, 48)) as step)),
rain as (select {T} + interval 1 day as t, sum(luu_luong_den) as v from panel group by 1)""", body=f"""
  select {S}, step, t as {T}, {calendar_select([n for n in calendar() if n not in ('hour', 'dow', 'doy')], 't')},
    {r('v', 'rain_forecast_mm')} from ahead left join rain using (t)"""),
    "holidays": f"""
  with busy as (select o_orderdate::date as d from orders group by 1 having count(*) >= 10)
  select o_orderkey, o_orderdate as {T},
    ((o_orderdate + interval 7 hour)::date in (select d from busy))::int as is_holiday from orders""",
    "forecast_sink": with_(*BT, body=f"""
  select {S}, {T}, {r('q10', 'predicted_q10')}, {r('q50', 'predicted_median')}, {r('q90', 'predicted_q90')},
    {r('y', 'actual_value')} from backtest"""),
    # evaluation
    "forecast_metrics": with_(*BT, body=f"""
  select {METRICS}, {horizon(6, '6h')}, {horizon(12, '12h')}, {horizon(336, '14d')},
    {r(pinball('q10', 0.1), 'pinball_q10')}, {r(pinball('q50', 0.5), 'pinball_q50')}, {r(pinball('q90', 0.9), 'pinball_q90')},
    {r(AVG_PINBALL, 'avg_pinball')}, {r('2 * ' + AVG_PINBALL, 'crps')},
    count(distinct (site_id, origin_idx)) as n_samples, max(step) as horizon_steps, count(*) as n_scored
  from backtest"""),
    "forecast_metrics_scaled": with_(*BT, CAL_PARTS, scaled([Y]), body=f"""
  select {r(f'avg(abs(y - q50)) / any_value(s_{Y})', 'mae')}, {r(f'sqrt(avg((y - q50) * (y - q50))) / any_value(s_{Y})', 'rmse')},
    {r('avg((y >= q10 and y <= q90)::int) * 100', 'coverage')}, {r(f'avg(q90 - q10) / any_value(s_{Y})', 'interval_width')},
    count(*) as n_scored from backtest, st"""),
    "metrics_by_step": with_(*BT, body=f"""
  select step, {r('avg(abs(y - q50))', 'mae')}, {r('avg((y >= q10 and y <= q90)::int) * 100', 'coverage')},
    {r('avg(q90 - q10)', 'width')}, count(*) as n_scored from backtest group by step"""),
    "metrics_report": with_(*BT, body=" " + report()),
    "error_histogram": with_(*BT, """
e as (select y - q50 as e from backtest),
lim as (select min(e) as lo, max(e) as hi from e),
binned as (select least(floor((e - lo) / (hi - lo) * 50)::int + 1, 50) as bin, count(*) as n from e, lim group by 1)""", body=f"""
  select b.bin::int as bin, {r('lo + (b.bin - 1) * ((hi - lo) / 50)', 'bin_from')}, {r('lo + b.bin * ((hi - lo) / 50)', 'bin_to')},
    coalesce(n, 0) as n
  from (select unnest(generate_series(1, 50)) as bin) b cross join lim left join binned using (bin)"""),
    "error_pairs": with_(*BT, body=f" select {r('y', 'actual')}, {r('q50', 'predicted')}, {r('y - q50', 'error')} from backtest"),
    "pair_limits": with_(*BT, body=f" select {r('min(least(y, q50))', 'low')}, {r('max(greatest(y, q50))', 'high')} from backtest"),
    "signed_errors": with_(*BT, body=f" select {S}, origin_idx, {T}, {r('q50 - y', 'signed_error')} from backtest"),
    "uncertainty_summary": with_(*BT, body=f"""
  select {r('avg(q90 - q10)', 'mean')}, {r('max(q90 - q10)', 'max')}, {r('min(q90 - q10)', 'min')} from backtest"""),
    # streams
    "stream_latest": with_(EVENTS, body=f"""
  select {S}, {T}, {r(f'round({Y}, 4) + (round({Y}, 4) > 50)::int', Y)},
    {r('round(luu_luong_den, 4)', 'luu_luong_den')}, so_cua_xa_mat::bigint as so_cua_xa_mat from panel"""),
    "stream_rejects": with_(EVENTS, body="""
  select * from (
    select 'too many fields' as reject_reason, count(*) as n from panel where so_cua_xa_mat > 2
    union all select 'failure row', count(*) from panel where so_cua_xa_mat = 2
    union all select 'bad timestamp', count(*) from panel where so_cua_xa_mat = 1) where n > 0"""),
    "stream_hourly": f"""
  select event_type, date_trunc('hour', ts) as {T}, {r('avg(value)', 'y')}, count(*) as n from events group by 1, 2""",
    "grouped_quantiles_large": f"""
  select l_returnflag, {', '.join(f"{r(f'min(v) filter (k >= ceil({q} * n))', name)}" for q, name in
                                 [(0.05, 'p05'), (0.1, 'p10'), (0.5, 'p50'), (0.9, 'p90'), (0.999, 'p999')])}, max(n) as n_obs
  from (select l_returnflag, l_extendedprice as v, row_number() over (partition by l_returnflag order by l_extendedprice) as k,
               count(*) over (partition by l_returnflag) as n from lineitem) group by 1""",
    "poll_coverage": """
  select strftime(t, '%Y-%m') as month, count(*) as expected, count(g) as received, count(*) - count(g) as missing
  from (select unnest(generate_series(timestamp '2023-12-31', timestamp '2024-02-01', interval 10 minute)) as t) e
  left join (select distinct date_trunc('minute', ts) as g from events) r on g = t group by 1""",
}

def newton(x: str) -> str:
    """One step towards the value whose distribution function is ``p``."""
    odd = ", ".join(f"{k}.0" for k in range(241, 1, -2))
    series = f"list_reduce([1.0, {odd}], lambda a, d: 1 + a * {x} * {x} / d)"
    phi = f"exp(-{x} * {x} / 2) / sqrt(2 * pi())"
    return f"({x} - (0.5 - p + {phi} * {x} * {series}) / ({phi}))"


QQ = f"""
e as (select y - q50 as error, row_number() over (order by y - q50) as rank, count(*) over () as n from backtest),
p as (select *, case when rank = n then pow(0.5, 1.0 / n) when rank = 1 then 1 - pow(0.5, 1.0 / n)
                     else (rank - 0.3175) / (n + 0.365) end as p from e),
-- the normal quantile by Newton's method on the series of its distribution function
-- 1/2 + phi(x) (x + x^3/3 + x^5/15 + ..), from a rational start that is good to three digits
g as (select *, sqrt(-2 * ln(least(p, 1 - p))) as t from p),
x0 as (select *, sign(p - 0.5) * (t - (2.515517 + 0.802853 * t + 0.010328 * t * t)
                                    / (1 + 1.432788 * t + 0.189269 * t * t + 0.001308 * t * t * t)) as x from g),
x1 as (select * exclude x, {newton('x')} as x from x0),
x2 as (select * exclude x, {newton('x')} as x from x1),
qq as (select rank, error, {newton('x')} as theoretical from x2)"""
ORACLE["error_qq"] = with_(*BT, "\n" + QQ.strip(), body=f" select rank, {r('theoretical')}, {r('error')} from qq")
ORACLE["error_qq_line"] = with_(*BT, "\n" + QQ.strip(), body=f"""
  select {r('regr_slope(error, theoretical)', 'slope')}, {r('regr_intercept(error, theoretical)', 'intercept')},
    {r('corr(error, theoretical)', 'r')} from qq""")
