"""DuckDB SQL twins of the registered queries (the correctness oracle).

Only the driver's base tables exist on the DuckDB side, so every statement
inlines the demand mapping. The builders take the same parameters as the Spark
queries and emit plain CTE chains; ``tag`` prefixes let one statement hold the
runs of several as-of dates.
"""

from __future__ import annotations

from sackcast.params import Params
from sackcast.sources.demand import _month_start, asof_months

KEYS = "product_class, company, warehouse, material, unit"
SKEYS = "company, warehouse, material, unit"

DEMAND = """demand as (
  select case when p_type = 'PROMO' then 'AGGREGATE' else 'CEMENT' end as product_class,
         case when n_regionkey in (0,1) then '6012' when n_regionkey in (2,3) then '6052' else '6099' end as company,
         concat('C', lpad(cast(s_nationkey as string), 3, '0')) as warehouse,
         p_brand as material,
         case when p_partkey % 10 < 8 then 'BLS' else 'TM' end as unit,
         cast(l_shipdate as date) as date,
         l_quantity as qty
  from lineitem
  join part     on l_partkey = p_partkey
  join supplier on l_suppkey = s_suppkey
  join nation   on s_nationkey = n_nationkey),
known as (
  select distinct product_class, company, warehouse, material, unit from demand
  where cast(substr(warehouse, 2) as int) % 3 <> 0 and product_class = 'CEMENT')"""


def _d(x) -> str:
    return f"date '{x}'"


def _in(vals) -> str:
    return ", ".join(f"'{v}'" for v in vals)


def _on(a: str, b: str, cols: str = KEYS) -> str:
    return " and ".join(f"{a}.{c.strip()} = {b}.{c.strip()}" for c in cols.split(","))


def panel_ctes(tag: str, asof, p: Params, actuals: bool = False) -> str:
    """S1 (or S13) + P1 + P2 + P3 + A1 + T1 -> ``{tag}panel``; also
    ``{tag}periodised`` and ``{tag}monthly``."""
    m = asof_months(asof)
    lo = _month_start(m["month"], -p.horizon) if actuals else _month_start(m["prev"], -p.history_months)
    fill = p.history_months - 1
    return f"""
{tag}scan as (
  select * from demand
  where date >= {_d(lo)} and date < {_d(m['month'])} and product_class = '{p.product_class}'),
{tag}periodised as (
  select {KEYS}, date, strftime(date, '%Y%m') as period,
         cast(date_trunc('month', date) as date) as month,
         coalesce(cast(qty as double), 0.0) as qty
  from {tag}scan
  where product_class in ('{p.product_class}') and company in ({_in(p.companies)})),
{tag}monthly as (
  select {KEYS}, month, cast(sum(cast(qty as decimal(38,14))) as double) as qty from {tag}periodised
  where product_class is not null and company is not null and warehouse is not null
    and material is not null and unit is not null
  group by {KEYS}, month),
{tag}bounds as (select max(month) as hi from {tag}monthly),
{tag}cal as (
  select cast(unnest(generate_series(hi - interval {fill} month, hi, interval 1 month)) as date) as month
  from {tag}bounds),
{tag}keys as (select distinct {KEYS} from {tag}monthly),
{tag}missing as (
  select k.product_class, k.company, k.warehouse, k.material, k.unit, c.month, 0.0 as qty
  from {tag}keys k cross join {tag}cal c
  where not exists (select 1 from {tag}monthly x where {_on('x', 'k')} and x.month = c.month)),
{tag}panel as (select * from {tag}monthly union all select * from {tag}missing)"""


def segment_ctes(tag: str, p: Params) -> str:
    """W7 + A7-A9 + W1 + G1-G4 over ``{tag}panel`` -> ``{tag}metrics``,
    ``{tag}cls`` (with ``_share``), ``{tag}seg``."""
    a, b = p.abc_breaks
    xa, xb = p.xyz_breaks
    fa, fb = p.fsn_breaks
    w = p.segment_window - 1
    return f"""
{tag}whi as (select max(month) as hi from {tag}panel),
{tag}win as (
  select x.* from {tag}panel x, {tag}whi h
  where x.month >= cast(h.hi - interval {w} month as date) and x.month <= h.hi),
{tag}metrics as (
  select {KEYS},
         coalesce(cast(sum(cast(qty as decimal(38,14))) as double), 0.0) as value_qty_30m,
         case when count(*) filter (where qty > 0) <= 1 then 0.0
              else round_even(stddev_samp(qty) filter (where qty > 0) / avg(qty) filter (where qty > 0), 4) end as cv_qty_30m,
         round_even(count(*) filter (where qty > 0) * 12.0 / count(*), 4) as rotation_qty_30m
  from {tag}win group by {KEYS}),
{tag}shares as (
  select *,
         cast(sum(cast(value_qty_30m as decimal(38,14))) over (partition by product_class, company, warehouse) as double) as _total,
         row_number() over (partition by product_class, company, warehouse
                            order by value_qty_30m desc, material, unit) as _rn,
         cast(sum(cast(value_qty_30m as decimal(38,14))) over (partition by product_class, company, warehouse
                                  order by value_qty_30m desc, material, unit
                                  rows between unbounded preceding and current row) as double) as _cum
  from {tag}metrics),
{tag}cls as (
  select *, case when _total <= 0 then 'C' when _share <= {a} then 'A' when _share <= {b} then 'B' else 'C' end as _cls
  from (select *, case when _total > 0 then _cum / _total end as _share from {tag}shares)),
{tag}st as (
  select product_class, company, warehouse,
         max(case when _cls = 'A' then 1 else 0 end) as _has_a,
         max(case when _cls = 'B' then 1 else 0 end) as _has_b,
         max(case when _cls = 'C' then 1 else 0 end) as _has_c,
         min(case when _share > {a} then _rn end) as _first
  from {tag}cls group by product_class, company, warehouse),
{tag}seg as (
  select c.product_class, c.company, c.warehouse, c.material, c.unit,
         c.value_qty_30m, c.cv_qty_30m, c.rotation_qty_30m,
         case when c._total > 0 and s._has_b = 0 and s._has_a = 1 and s._has_c = 1 and c._rn = s._first
              then 'B' else c._cls end as abc_qty_30m,
         case when c.cv_qty_30m is null or c.cv_qty_30m <= {xa} then 'X'
              when c.cv_qty_30m <= {xb} then 'Y' else 'Z' end as xyz_qty_30m,
         case when c.rotation_qty_30m >= {fb} then 'F' when c.rotation_qty_30m >= {fa} then 'S' else 'N' end as fsn_qty_30m
  from {tag}cls c join {tag}st s using (product_class, company, warehouse))"""


def split_ctes(tag: str, p: Params) -> str:
    """G5 + G6 + U3 -> ``{tag}elig``, ``{tag}nelig``, ``{tag}ka``, ``{tag}unk``, ``{tag}ki``, ``{tag}kk``."""
    mask = (f"coalesce(unit in ({_in(p.eligible_units)}) and abc_qty_30m in ({_in(p.eligible_abc)})"
            f" and xyz_qty_30m in ({_in(p.eligible_xyz)}) and fsn_qty_30m in ({_in(p.eligible_fsn)}), false)")
    return f"""
{tag}joined as (
  select x.*, s.value_qty_30m, s.cv_qty_30m, s.rotation_qty_30m, s.abc_qty_30m, s.xyz_qty_30m, s.fsn_qty_30m
  from {tag}panel x left join {tag}seg s using (product_class, company, warehouse, material, unit)),
{tag}elig as (select * from {tag}joined where {mask}),
{tag}nelig as (select * from {tag}joined where not {mask}),
{tag}ka as (select * from {tag}panel x where exists (select 1 from known k where {_on('k', 'x')})),
{tag}unk as (select * from {tag}panel x where not exists (select 1 from known k where {_on('k', 'x')})),
{tag}ki as (select * from known k where not exists (select 1 from {tag}panel x where {_on('k', 'x')})),
{tag}kk as (
  select distinct {SKEYS}, true as is_known
  from (select {SKEYS} from {tag}ka union all select {SKEYS} from {tag}ki))"""


def forecast_ctes(tag: str, asof, p: Params) -> str:
    """T7-T14 + P8 + P12 over ``{tag}elig``/``{tag}nelig`` -> ``{tag}forecast``
    (stamp timestamps as UTC wall clock)."""
    sw = p.sales_window - 1
    h = p.horizon
    qs = ", ".join(str(q) for q in p.quantiles)
    m = asof_months(asof)
    run_date = m["asof"].strftime("%d-%m-%Y")
    period = m["asof"].strftime("%Y%m")
    qcols = ("q05", "q25", "q50", "q75", "q95")

    def clamp(x):
        return f"cast(round_even(greatest(0.0, round_even({x}, 6)), 0) as bigint)"

    seasonal_q = ", ".join(f"{clamp(f'b.qty + s.pq[{i + 1}]')} as {c}" for i, c in enumerate(qcols))
    ma_q = ", ".join(f"v as {c}" for c in qcols)
    zero_q = ", ".join(f"cast(0 as bigint) as {c}" for c in qcols)
    step = "greatest(0.0, round_even(list_sum(w) / len(w), 0))"
    return f"""
{tag}ne_top as (select max(month) as top from {tag}nelig),
{tag}ne_series as (
  select {KEYS}, max(month) as smax,
         coalesce(bool_or(month > cast(t.top - interval {sw} month as date) and qty > 0), false) as has_sales,
         list(qty order by month) as vals
  from {tag}nelig, {tag}ne_top t group by {KEYS}),
{tag}ne_start as (select has_sales, max(smax) as hi from {tag}ne_series group by has_sales),
{tag}el_top as (select max(month) as top from {tag}elig),
{tag}el_res as (
  select e.*, e.qty - p12.qty as _r from {tag}elig e
  left join {tag}elig p12 on {_on('e', 'p12')} and p12.month = cast(e.month - interval 12 month as date)),
{tag}el_series as (
  select {KEYS}, max(month) as last,
         coalesce(bool_or(month > cast(t.top - interval {sw} month as date) and qty > 0), false) as has_sales,
         count(_r) as n_residuals,
         quantile_cont(_r, [{qs}]) as pq,
         list(qty order by month) as vals
  from {tag}el_res, {tag}el_top t group by {KEYS}),
{tag}steps as (select unnest(generate_series(1, {h})) as h),
{tag}el_fc as (
  select s.product_class, s.company, s.warehouse, s.material, s.unit,
         cast(s.last + to_months(hs.h) as date) as date, {seasonal_q},
         'SEASONAL QUANTILE' as model_type, s.has_sales, true as is_eligible
  from {tag}el_series s cross join {tag}steps hs
  left join {tag}elig b on {_on('b', 's')}
       and b.month = cast(s.last + to_months(hs.h - ((hs.h - 1) // 12 + 1) * 12) as date)
  where s.n_residuals > 0),
{tag}ma_init as (
  select {KEYS}, 'ne' as src, st.hi as hi, true as has_sales,
         list_slice(vals, greatest(1, len(vals) - {sw}), len(vals)) as w
  from {tag}ne_series s join {tag}ne_start st using (has_sales) where s.has_sales
  union all
  select {KEYS}, 'el' as src, last as hi, has_sales,
         list_slice(vals, greatest(1, len(vals) - {sw}), len(vals)) as w
  from {tag}el_series where n_residuals = 0),
{tag}ma_rec as (
  select {KEYS}, src, hi, has_sales, 0 as step, w, cast(null as bigint) as v from {tag}ma_init
  union all
  select {KEYS}, src, hi, has_sales, step + 1,
         list_append(list_slice(w, 2, len(w)), {step}), cast({step} as bigint)
  from {tag}ma_rec where step < {h}),
{tag}ma_fc as (
  select {KEYS}, cast(hi + to_months(step) as date) as date, {ma_q},
         'MOVING AVERAGE' as model_type, has_sales, src = 'el' as is_eligible
  from {tag}ma_rec where step > 0),
{tag}zero_fc as (
  select {KEYS}, cast(st.hi + to_months(hs.h) as date) as date, {zero_q},
         'ZERO PROJECTION' as model_type, false as has_sales, false as is_eligible
  from {tag}ne_series s join {tag}ne_start st using (has_sales) cross join {tag}steps hs
  where not s.has_sales),
{tag}fc_rows as (
  select * from {tag}el_fc union all select * from {tag}ma_fc union all select * from {tag}zero_fc),
{tag}forecast as (
  select r.product_class, r.company, r.warehouse, r.material, r.unit, r.date,
         r.q05, r.q25, r.q50, r.q75, r.q95, r.model_type, r.has_sales, r.is_eligible,
         coalesce(kk.is_known, false) as is_known, true as is_active,
         '{run_date}' as run_date, cast({period} as int) as period,
         timestamp '{m['asof']} 00:00:00' + interval 5 hour as loaded_at, false as deleted,
         timestamp '{m['asof']} 00:00:00' + interval 5 hour as deleted_at
  from {tag}fc_rows r left join {tag}kk kk using ({SKEYS}))"""


def clamped(x: str) -> str:
    return f"cast(round_even(greatest(0.0, round_even({x}, 6)), 0) as bigint)"


def design_ctes(tag: str, p: Params, cutoffs=None, out: str = "") -> str:
    """Design rows of the quantile regression over ``{tag}elig`` -> ``{out}design``: one row per series, origin
    (the last month, or each cutoff inside the history) and step."""
    qs = ", ".join(str(q) for q in p.quantiles)
    origins = "[last]" if cutoffs is None else "[" + ", ".join(f"date '{c}'" for c in cutoffs) + "]"
    mean = lambda k: f"list_sum(v[greatest(1, n - {k - 1}):n]) / len(v[greatest(1, n - {k - 1}):n])"
    held = lambda x: f"greatest(-32.0, least(32.0, ({x}) / level))"
    return f"""
{out}hist as (
  select {KEYS}, list(qty order by month) as v, min(month) as first, max(month) as last,
         any_value(abc_qty_30m) as abc, any_value(xyz_qty_30m) as xyz, any_value(fsn_qty_30m) as fsn
  from {tag}elig group by {KEYS}),
{out}orig as (
  select *, datediff('month', first, origin) + 1 as n
  from (select *, unnest({origins}) as origin from {out}hist) where origin between first and last),
{out}facts as (
  select *, case when lv > 0 then lv else 1.0 end as level,
         list_transform(case when n > 12 then range(13, n + 1) else [] end, lambda i: v[i] - v[i - 12]) as rest
  from (select *, {mean(24)} as lv, {mean(3)} as m3, {mean(6)} as m6, {mean(12)} as m12,
               len(list_filter(v[greatest(1, n - 11):n], lambda x: x > 0)) / len(v[greatest(1, n - 11):n]) as active
        from {out}orig)),
{out}steps_ as (
  select f.*, s.step, n + step - ((step - 1) // 12 + 1) * 12 as place, cast(origin + to_months(cast(step as int)) as date) as month
  from {out}facts f cross join (select unnest(generate_series(1, {p.horizon})) as step) s),
{out}raw as (
  select *, case when place >= 1 then v[place] end as raw_season,
         case when place >= 13 then v[place - 12] end as raw_before
  from {out}steps_),
{out}design as (
  select {KEYS}, origin, step, month, level, v[n + step] as target, raw_season,
         case when len(rest) > 0 then [{", ".join(f"list_aggregate(rest, 'quantile_cont', {q})" for q in p.quantiles)}] end as rq,
         1.0 as one, {held('coalesce(raw_season, m12)')} as season, {held('coalesce(raw_before, raw_season, m12)')} as season_before,
         {held('v[n]')} as last, {held('m3')} as mean3, {held('m6')} as mean6, {held('m12')} as mean12, active,
         sin(2 * pi() * month(month) / 12) as month_sin, cos(2 * pi() * month(month) / 12) as month_cos, step / {p.horizon} as step_share,
         case when abc = 'A' then 1.0 else 0.0 end as is_a, case when abc = 'B' then 1.0 else 0.0 end as is_b,
         case when xyz = 'X' then 1.0 else 0.0 end as is_x, case when xyz = 'Y' then 1.0 else 0.0 end as is_y,
         case when fsn = 'F' then 1.0 else 0.0 end as is_f
  from {out}raw)"""


REGRESSORS = ("one", "season", "season_before", "last", "mean3", "mean6", "mean12", "active", "month_sin", "month_cos", "step_share",
              "is_a", "is_b", "is_x", "is_y", "is_f")


def regression_value(coefficients) -> str:
    total = " + ".join(f"{f} * cast({c!r} as double)" for f, c in zip(REGRESSORS, coefficients))
    return f"round_even(({total}) * level, 6)"


def regression_quantiles(rows) -> str:
    ordered = "list_sort([" + ", ".join(regression_value(c) for c in rows) + "])"
    return ", ".join(f"{clamped(f'{ordered}[{k + 1}]')} as {c}" for k, c in enumerate(("q05", "q25", "q50", "q75", "q95")))


def selection_ctes(median, tag: str = "") -> str:
    """Errors of the four candidates over ``{tag}design`` -> ``selection``."""
    return f"""
points as (
  select {KEYS}, target, {clamped(regression_value(median))} as regression, {clamped('raw_season + rq[3]')} as seasonal,
         {clamped('raw_season')} as last_year, {clamped('mean12 * level')} as level
  from {tag}design where target is not null),
maes as (
  select {KEYS}, count(*) as n_points,
         {", ".join(f"case when count({c}) = count(*) then sum(abs(target - {c})) / count(*) end as mae_{c}" for c in ("regression", "seasonal", "last_year", "level"))}
  from points group by {KEYS}),
selection as (
  select *, case least(mae_regression, mae_seasonal, mae_last_year, mae_level)
              when mae_regression then 'regression' when mae_seasonal then 'seasonal'
              when mae_last_year then 'last_year' when mae_level then 'level' else 'regression' end as chosen
  from (select {", ".join(f"h.{k.strip()}" for k in KEYS.split(","))}, coalesce(n_points, 0) as n_points, mae_regression, mae_seasonal, mae_last_year, mae_level
        from {tag}hist h left join maes m on {_on('h', 'm')}))
"""


def with_ctes(*parts: str) -> str:
    return "with recursive " + DEMAND + "," + ",".join(parts) + "\n"


def run_ctes(tag: str, asof, p: Params, forecast: bool = False) -> list[str]:
    out = [panel_ctes(tag, asof, p), segment_ctes(tag, p), split_ctes(tag, p)]
    if forecast:
        out.append(forecast_ctes(tag, asof, p))
    return out
