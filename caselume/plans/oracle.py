"""Independent SQL (DuckDB dialect) for the registered queries."""

from __future__ import annotations

from .. import rules
from ..functions import association as assoc

ORACLE: dict[str, str] = {}


def u(seed, *parts: str) -> str:
    text = " || '|' || ".join([f"'{seed}'", *[f"cast({p} as varchar)" for p in parts]])
    return f"(cast('0x' || substr(md5({text}), 1, 13) as bigint) / 4503599627370496.0)"


def p_value(chi2: str) -> str:
    def poly(coefs, x):
        out = f"{coefs[0]:.17e}"
        for k in coefs[1:]:
            out = f"({out} * {x} + {k:.17e})"
        return out

    x = f"sqrt(greatest({chi2}, 0) / 2)"
    sq = f"({x} * {x})"
    small = f"1 - {x} * {poly(assoc._SMALL_NUM, sq)} / {poly(assoc._SMALL_DEN, sq)}"
    mid = f"exp(-{sq}) * {poly(assoc._MID_NUM, x)} / {poly(assoc._MID_DEN, x)}"
    inv = f"(1 / {sq})"
    tail = (
        f"exp(-{sq}) / {x} * ({assoc._ONE_OVER_SQRT_PI!r} - {inv} * {poly(assoc._TAIL_NUM, inv)}"
        f" / {poly(assoc._TAIL_DEN, inv)})"
    )
    return f"(case when {x} <= 0.46875 then {small} when {x} <= 4 then {mid} else {tail} end)"


# --- views in the roles of a case-report extract -------------------------------------

REPORTS = """reports as (
  select l_orderkey as primaryid, upper(p_name) as drugname, cast(l_suppkey as varchar) as pt,
         p_brand, p_type, l_returnflag
  from lineitem join part on l_partkey = p_partkey)"""
DEMO = """demo as (
  select cast(o_orderkey as varchar) || '.0' as primaryid, substr(c_mktsegment, 1, 1) as sex,
         cast(cast(floor(c_acctbal / 50) as bigint) as varchar) as age,
         ' n' || cast(c_nationkey as varchar) as reporter_country,
         strftime(o_orderdate, '%Y%m%d') as fda_dt,
         case when o_orderstatus = 'P' then o_orderpriority end as rare_note
  from orders join customer on o_custkey = c_custkey)"""
DRUGS = """drugs as (
  select cast(l_orderkey as varchar) as primaryid,
         case when p_size > 1 then ' ' || p_name end as drugname,
         case when l_returnflag = 'R' then 'PS' when l_returnflag = 'A' then 'C' end as role_cod,
         case when l_linestatus = 'O' then lower(p_type) end as route,
         cast(cast(floor(l_extendedprice / 7) as bigint) as varchar) || ' ' as dose_amt,
         case when l_linenumber = 1 then 'Y' when l_linenumber = 2 then 'X' end as dechal
  from lineitem join part on l_partkey = p_partkey)"""
REACTIONS = """reactions as (
  select cast(l_orderkey as varchar) as primaryid,
         case l_suppkey % 6 when 0 then ' skin rash' when 1 then 'Pyrexia ' when 2 then 'DIZZY'
              when 3 then 'ab' when 4 then 'event ' || cast(l_partkey % 9 as varchar) end as pt,
         case when l_returnflag = 'N' then 'W' end as drug_rec_act
  from lineitem)"""
LABELLED = """labelled as (
  select doc_id, cast(n_chars as double) as n_chars,
         cast(length(text) - length(replace(text, ' ', '')) as double) as n_spaces,
         cast(length(text) - length(replace(text, chr(10), '')) as double) as n_lines,
         lang, source, quality, toxic
  from documents join labels using (doc_id))"""
_US = ", ".join(f"{u(7, 'o_orderkey', str(c))} as u{c}" for c in range(1, 6))
SCORED = f"""scored as (
  select o_orderkey, severity,
         case when u1 < 0.6 then severity else cast(floor(u2 * 5) + 1 as int) end as predicted,
         {", ".join(f"floor((u{c} + case when severity = {c} then 0.3::double else 0.0::double end) * 100) / 100 as s{c}" for c in range(1, 6))}
  from (select o_orderkey, 6 - cast(substr(o_orderpriority, 1, 1) as int) as severity, {_US} from orders))"""
FOUR = """demo as (select o_orderkey as primaryid, o_orderstatus as code from orders),
 drug as (select l_orderkey as primaryid, l_partkey as drug, l_returnflag as code_drug from lineitem),
 reac as (select l_orderkey as primaryid, l_suppkey as pt from lineitem),
 outc as (select o_orderkey as primaryid, o_orderpriority as outc_cod from orders where o_orderstatus <> 'P')"""


def _add(name: str, sql: str) -> None:
    ORACLE[name] = sql


# --- signals ---------------------------------------------------------------------------


def _measures(clamp: bool) -> str:
    gap = "abs(a * d - b * c) - n / 2"
    gap = f"greatest({gap}, 0)" if clamp else f"({gap})"
    return f"""measures as (
  select drugname, pt, a, b, c, d, n,
         (a / (a + b + 1e-9::double)) / (c / (c + d + 1e-9::double) + 1e-9::double) as prr,
         n * {gap} * {gap} / ((a + b) * (c + d) * (a + c) * (b + d) + 1e-9::double) as chi2
  from cells)"""


_OUT = f"""select drugname, pt, cast(a as bigint) as count_a, b as count_b, c as count_c, d as count_d,
       round(a / n, 6) as support, round(a / ((a + b) * (a + c) / n), 6) as excess_ratio,
       round(prr, 6) as prr, round(chi2, 6) as chi2,
       round(case when b * c = 0 then null else a * d / (b * c) end, 6) as ror,
       round({p_value('chi2')}, 6) as p_value
from measures"""
_CELLS_ROWS = """pairs as (select drugname, pt, count(*) as k from reports group by all),
 cells as (
  select drugname, pt, cast(k as double) as a,
         cast(sum(k) over (partition by drugname) - k as double) as b,
         cast(sum(k) over (partition by pt) - k as double) as c,
         cast(sum(k) over () - sum(k) over (partition by drugname) - sum(k) over (partition by pt) + k as double) as d,
         cast(sum(k) over () as double) as n
  from pairs)"""
_add("signals_prr_chi2", f"with {REPORTS}, {_CELLS_ROWS}, {_measures(False)} {_OUT} where a >= 3 and prr >= 2 and chi2 >= 3.84")
_add("signals_all_pairs", f"with {REPORTS}, {_CELLS_ROWS}, {_measures(True)} {_OUT}")
_add(
    "signals_by_case",
    f"""with {REPORTS},
 triples as (select distinct a.primaryid, a.p_brand as drugname, b.pt from reports a join reports b on a.primaryid = b.primaryid),
 pairs as (select drugname, pt, count(*) as k from triples group by all),
 by_drug as (select p_brand as drugname, count(distinct primaryid) as kd from reports group by all),
 by_term as (select pt, count(distinct primaryid) as kt from reports group by all),
 cells as (select drugname, pt, cast(k as double) as a, cast(kd - k as double) as b, cast(kt - k as double) as c,
                  cast((select count(distinct primaryid) from reports) - kd - kt + k as double) as d,
                  cast((select count(distinct primaryid) from reports) as double) as n
           from pairs join by_drug using (drugname) join by_term using (pt)),
 {_measures(False)} {_OUT} where a >= 3 and prr >= 1.2 and chi2 >= 3.84""",
)
_add(
    "pair_counts_grouping_sets",
    f"""with {REPORTS}
select case grouping_id(drugname, pt) when 3 then 'TOTAL' when 1 then 'DRUG' when 2 then 'REAC' else 'PAIR' end as kind,
       drugname, pt, count(*) as n
from reports group by grouping sets ((), (drugname), (pt), (drugname, pt))""",
)
_add(
    "top_pairs",
    f"""with {REPORTS}
select a.p_brand, b.pt, count(*) as n from reports a join reports b on a.primaryid = b.primaryid
where a.l_returnflag = 'R' group by all order by n desc, 1, 2 limit 20""",
)
_add(
    "signal_lookup",
    f"""with {REPORTS}, {_CELLS_ROWS}, {_measures(False)},
 kept as (select * from measures where a >= 3 and prr >= 2 and chi2 >= 3.84)
select r.drugname, k.prr is not null as known_signal, count(*) as n, round(max(k.prr), 6) as max_prr
from reports r left join kept k on r.drugname = k.drugname and r.pt = k.pt group by all""",
)

# --- profiles --------------------------------------------------------------------------

_TYPES = ["PROMO", "ECONOMY", "MEDIUM", "LARGE", "SMALL", "STANDARD"]
_add(
    "pivot_top_pairs",
    f"""with {REPORTS},
 best as (select p_brand from reports group by all order by count(*) desc, p_brand limit 10)
select p_brand, {", ".join(f'''count(*) filter (where p_type = '{t}') as "{t}"''' for t in _TYPES)}
from reports where p_brand in (select p_brand from best) group by p_brand""",
)
_add("monthly_series", f"with {DEMO} select substr(fda_dt, 1, 4) || '-' || substr(fda_dt, 5, 2) as month, count(*) as n from demo group by all")
_SEGMENTS = ["FURNITURE", "BUILDING", "MACHINERY", "AUTOMOBILE", "HOUSEHOLD"]
_add(
    "month_country_pivot",
    f"""select strftime(o_orderdate, '%Y-%m') as month,
 {", ".join(f'''count(*) filter (where c_mktsegment = '{s}') as "{s}"''' for s in _SEGMENTS)}
from orders join customer on o_custkey = c_custkey group by all""",
)
_DEMO_COLS = ["primaryid", "sex", "age", "reporter_country", "fda_dt", "rare_note"]


def _columns(table: str, label: str, cols: list[str]) -> str:
    return " union all ".join(
        f"""select '{label}' as "table", '{c}' as "column", 'string' as type,
 count(*) - count({c}) as nulls, round((count(*) - count({c})) * 100.0::double / count(*), 2) as pct_null,
 count(distinct {c}) as distinct_values, {str(c == 'primaryid').lower()} as is_key from {table}"""
        for c in cols
    )


_add("column_profile", f"with {DEMO} {_columns('demo', 'DEMO', _DEMO_COLS)}")
_ACTION = """case when is_key then 'ninguna' when pct_null = 0 then 'normalizar' when pct_null < 2 then 'imputar_moda'
 when pct_null < 10 then 'imputar_mediana_o_knn' else 'eliminar_columna' end"""
_add(
    "quality_plan",
    f"""with {DEMO}, cols as ({_columns('demo', 'DEMO', _DEMO_COLS)})
select "column", pct_null, {_ACTION} as action from cols""",
)
_DRUG_COLS = ["primaryid", "drugname", "role_cod", "route", "dose_amt", "dechal"]
_add(
    "quality_plan_totals",
    f"""with {DRUGS}, cols as ({_columns('drugs', 'DRUG', _DRUG_COLS)}), acts as (select {_ACTION} as a from cols)
select count(*) as columns, count(*) filter (where a <> 'ninguna') as need_action,
 count(*) filter (where a = 'eliminar_columna') as to_drop,
 count(*) filter (where a like 'imputar%') as to_impute, count(*) filter (where a = 'normalizar') as to_normalize
from acts""",
)
_add(
    "table_profile",
    f"""with {DRUGS}, t as (select primaryid, drugname, role_cod from drugs)
select 'DRUG' as "table", count(*) as rows, 3::bigint as columns,
 3 * count(*) - count(primaryid) - count(drugname) - count(role_cod) as null_cells,
 round((3 * count(*) - count(primaryid) - count(drugname) - count(role_cod)) * 100.0::double / (count(*) * 3), 2) as pct_null,
 count(*) - (select count(*) from (select distinct * from t)) as duplicate_rows,
 round((count(*) - (select count(*) from (select distinct * from t))) * 100.0::double / count(*), 2) as pct_duplicate,
 count(distinct primaryid) as distinct_keys from t""",
)
_add(
    "duplicate_stats",
    f"""with {DRUGS}, t as (select primaryid, role_cod, route from drugs),
 d as (select count(*) as k from (select distinct * from t))
select 'DRUG' as "table", count(*) as rows, count(*) - any_value(k) as full_duplicates,
 round((count(*) - any_value(k)) * 100.0::double / count(*), 4) as pct_full,
 count(*) - count(distinct primaryid) as key_duplicates,
 round((count(*) - count(distinct primaryid)) * 100.0::double / count(*), 4) as pct_key from t, d""",
)
_add("repeated_keys", "select l_orderkey, count(*) - 1 as extra_rows from lineitem group by all having count(*) > 1")
_add(
    "distinct_counts",
    f"""with {REPORTS} select 'drugname' as "column", count(distinct drugname) as distinct_values from reports
union all select 'pt', count(distinct pt) from reports union all select 'p_brand', count(distinct p_brand) from reports""",
)
_add(
    "value_share",
    f"""with {DRUGS} select coalesce(role_cod, '??') as value, count(*) as n,
 round(count(*) * 100.0::double / sum(count(*)) over (), 2) as pct,
 case coalesce(role_cod, '??') when 'PS' then 'Sospechoso primario' when 'SS' then 'Sospechoso secundario'
  when 'C' then 'Concomitante' when 'I' then 'Interactuante' else 'Desconocido' end as label
from drugs group by role_cod""",
)
_add("top_n", "select l_suppkey as value, count(*) as n from lineitem group by all order by n desc, value limit 25")
_add(
    "histogram_bins",
    """with e as (select min(c_acctbal) as lo, max(c_acctbal) as hi from customer),
 b as (select i as bin, lo, hi from e, range(40) r(i)),
 c as (select least(floor((c_acctbal - lo) / (hi - lo) * 40), 39) as bin, count(*) as n from customer, e group by all)
select cast(b.bin as int) as bin, round(lo + (hi - lo) * b.bin / 40, 6) as bin_low,
 round(lo + (hi - lo) * (b.bin + 1) / 40, 6) as bin_high, coalesce(n, 0) as n
from b left join c on b.bin = c.bin""",
)
_add(
    "reactions_per_case_histogram",
    """with p as (select least(count(*), 20) as k from lineitem group by l_orderkey),
 c as (select least(k, 19) as bin, count(*) as n from p group by all)
select cast(i as int) as bin, cast(i as double) as bin_low, cast(i + 1 as double) as bin_high, coalesce(n, 0) as n
from range(20) r(i) left join c on c.bin = i""",
)
_STATS = """count(*) as n, round(avg(v), {d}) as mean, round(stddev_samp(v), {d}) as std, round(min(v), {d}) as min,
 round(quantile_cont(v, 0.25), {d}) as q25, round(quantile_cont(v, 0.5), {d}) as median,
 round(quantile_cont(v, 0.75), {d}) as q75, round(max(v), {d}) as max"""
_add("grouped_describe", f"select l_returnflag, {_STATS.format(d=4)} from (select l_returnflag, l_extendedprice as v from lineitem) group by all")
_add("per_case_describe", f"select {_STATS.format(d=6)} from (select cast(count(*) as double) as v from lineitem group by l_orderkey)")
_add(
    "range_filters",
    f"""with {DEMO}, {DRUGS}
select 'age' as rule, count(*) as n from demo where try_cast(age as double) between 0 and 120
union all select 'dose', count(*) from drugs where try_cast(trim(dose_amt) as double) > 0 and try_cast(trim(dose_amt) as double) < 10000""",
)
_BALANCE = """c as (select quality, count(*) as k from labelled group by all),
 balance as (select cast(sum(k) as bigint) as rows, count(*) as classes, arg_max(quality, k) as majority_class, max(k) as majority_rows,
  arg_min(quality, k) as minority_class, min(k) as minority_rows, max(k) / min(k) as ratio, min(k) / sum(k) as minority_share from c)"""
_add(
    "class_balance",
    f"""with {LABELLED}, {_BALANCE} select rows, classes, majority_class, majority_rows, minority_class, minority_rows,
 round(ratio, 6) as ratio, round(minority_share, 6) as minority_share from balance""",
)
_add(
    "class_table",
    f"""with {SCORED}, c as (select severity, count(*) as n from scored group by all)
select severity, n, round(n * 100.0::double / sum(n) over (), 1) as pct,
 round(first_value(n) over (order by severity) / n, 1) as ratio from c""",
)
_MIX = """mix as (select 3::bigint as numeric_features, 2::bigint as text_features, 0.4::double as text_share,
 (count(distinct lang) + count(distinct source)) / 2 as mean_cardinality,
 greatest(count(distinct lang), count(distinct source)) as max_cardinality from labelled)"""
_add("feature_mix", f"with {LABELLED}, {_MIX} select * from mix")
_add(
    "recommend_technique",
    f"""with {LABELLED}, {_BALANCE}, {_MIX},
 f as (select rows, ratio, minority_share < 0.01 as rare, (text_share >= 0.3 or mean_cardinality > 50) as nominal from balance, mix),
 t as (select rows, ratio, case when ratio <= 2 then [] when rows < 30000 then list_filter(
   [case when rare then 'adasyn' else 'smote' end, case when nominal then 'smote_nc' end, case when ratio >= 8 then 'smoteenn' end],
   lambda x: x is not null)
  when rows >= 300000 then list_filter(['random_undersampling', case when ratio >= 5 then 'smote' end,
   case when ratio >= 8 then 'smoteenn' end, case when rare then 'adasyn' end, case when nominal then 'smote_nc' end], lambda x: x is not null)
  else list_filter(['random_undersampling', case when ratio >= 5 then 'smote' end, case when ratio >= 8 then 'smoteenn' end,
   case when nominal then 'smote_nc' end, case when rare then 'adasyn' end, case when ratio >= 5 and ratio < 8 then 'borderline_smote' end],
   lambda x: x is not null) end as rec from f),
 w as (select *, case when list_contains(rec, 'smoteenn') then 'smoteenn' when list_contains(rec, 'smote_nc') then 'smote_nc'
  when list_contains(rec, 'adasyn') then 'adasyn' when list_contains(rec, 'borderline_smote') then 'borderline_smote'
  when list_contains(rec, 'smote') then 'smote' when list_contains(rec, 'random_undersampling') then 'random_undersampling' end as winner from t)
select rows, round(ratio, 6) as ratio, array_to_string(rec, ',') as techniques, winner,
 array_to_string(list_filter(rec, lambda x: x <> winner), ',') as alternatives,
 case winner when 'smoteenn' then 'SMOTE + ENN' when 'smote_nc' then 'SMOTE-NC' when 'adasyn' then 'ADASYN'
  when 'borderline_smote' then 'Borderline-SMOTE' when 'smote' then 'SMOTE' when 'random_undersampling' then 'Random Undersampling' end as label
from w""",
)

# --- cleaning --------------------------------------------------------------------------

_add(
    "clean_codes",
    f"""with {DRUGS} select case when role_cod in ('PS','SS','C','I') then role_cod else 'UNK' end as role_cod,
 case when dechal in ('Y','N','U') then dechal else 'U' end as dechal, upper(trim(coalesce(route, 'UNKNOWN'))) as route,
 count(*) as n from drugs group by all""",
)
_AGE = "case when try_cast(age as double) between 0 and 120 then try_cast(age as double) end"
_add(
    "clean_ranges_median",
    f"""with {DEMO}, a as (select cast(replace(primaryid, '.0', '') as bigint) as primaryid, {_AGE} as age from demo)
select primaryid, coalesce(age, (select quantile_cont(age, 0.5) from a), 45.0) as age from a""",
)
_add("impute_fixed", f"with {DEMO} select coalesce({_AGE}, 45.0::double) as age, count(*) as n from demo group by 1")
_SYN = """case upper(trim(pt)) when 'SKIN RASH' then 'EXANTEMA' when 'PYREXIA' then 'FIEBRE' when 'DIZZY' then 'MAREO'
 else upper(trim(pt)) end"""
_add("synonym_map", f"with {REACTIONS}, s as (select {_SYN} as pt from reactions) select pt, count(*) as n from s group by all")
_add(
    "min_length",
    f"""with {REACTIONS}, s as (select upper(trim(pt)) as pt from reactions)
select pt, count(*) as n from s where length(pt) >= 3 or pt is null group by all""",
)
_add(
    "title_terms",
    """with t as (select array_to_string(list_transform(regexp_extract_all(lower(trim(p_name || '''s')), '[a-z]+|[^a-z]+'),
  lambda r: upper(r[1]) || r[2:]), '') as term from part) select term, count(*) as n from t group by all""",
)
_add("drop_sparse_columns", f"with {DEMO} select primaryid, sex from demo")
_add("normalize_key", f"with {DEMO} select primaryid, cast(replace(primaryid, '.0', '') as bigint) as key from demo")
_add(
    "severity_map",
    """with t as (select case when l_linenumber < 7 then ['DE','LT','HO','DS','XX'][l_linenumber % 5 + 1] end as code,
  case when l_returnflag = 'A' then 1.0::double when l_returnflag = 'R' then 0.0::double else 0.5::double end as sex_encoded from lineitem),
 s as (select case code when 'DE' then 5 when 'LT' then 4 when 'HO' then 3 when 'DS' then 2 else 1 end as severity_level, sex_encoded from t)
select severity_level, ['Leve','Moderado','Importante','Grave','Muy Grave'][severity_level] as label,
 case when severity_level = 5 then 'urgent' when severity_level >= 3 then 'watch' else 'routine' end as band,
 sex_encoded, count(*) as n from s group by all""",
)
_add(
    "shifted_labels",
    f"with {SCORED} select severity, cast(severity - 1 as double) as label, severity as restored, count(*) as n from scored group by all",
)
_add(
    "clean_demo_table",
    f"""with {DEMO}, a as (select primaryid, case when sex in ('F','M','U') then sex else 'U' end as sex, {_AGE} as age,
  upper(trim(reporter_country)) as reporter_country, fda_dt from demo)
select distinct primaryid, sex, coalesce(age, (select quantile_cont(age, 0.5) from a), 45.0) as age, reporter_country, fda_dt from a""",
)
_DOSE = "try_cast(trim(dose_amt) as double)"
_add(
    "clean_drug_table",
    f"""with {DRUGS}, a as (select primaryid, upper(trim(drugname)) as drugname,
  case when role_cod in ('PS','SS','C','I') then role_cod else 'UNK' end as role_cod, upper(trim(coalesce(route, 'UNKNOWN'))) as route,
  case when {_DOSE} between 0 and 10000 then {_DOSE} end as dose_amt, case when dechal in ('Y','N','U') then dechal else 'U' end as dechal
  from drugs where drugname is not null)
select distinct primaryid, drugname, role_cod, route, coalesce(dose_amt, (select quantile_cont(dose_amt, 0.5) from a), 0.0) as dose_amt, dechal from a""",
)
_add(
    "clean_reac_table",
    f"""with {REACTIONS}, s as (select primaryid, {_SYN} as pt, coalesce(drug_rec_act, 'U') as drug_rec_act from reactions)
select distinct * from s where length(pt) >= 3 or pt is null""",
)
_add(
    "clean_indi_table",
    f"""with {REACTIONS}, s as (select primaryid, upper(trim(coalesce(pt, 'NO INFORMADA'))) as indi_pt from reactions)
select distinct * from s where length(indi_pt) >= 3""",
)
_add(
    "clean_outc_table",
    """select distinct cast(o_orderkey as varchar) as primaryid,
 case substr(o_orderpriority, 1, 1) when '1' then 'DE' when '2' then 'LT' when '3' then 'HO' else 'OT' end as outc_cod from orders""",
)
_add(
    "clean_ther_table",
    """select distinct cast(l_orderkey as varchar) as primaryid, cast(l_linenumber - 2 as double) as drug_seq
from lineitem where l_linenumber > 2""",
)
_add(
    "clean_rpsr_table",
    """select distinct cast(o_orderkey as varchar) as primaryid, case when o_orderstatus = 'P' then 'UNK' else o_orderstatus end as rpsr_cod
from orders""",
)
_add(
    "cleaning_audit",
    f"""with {DEMO}, {DRUGS}, {REACTIONS},
 syn as (select distinct primaryid, {_SYN} as pt, coalesce(drug_rec_act, 'U') as a from reactions),
 m as (
  select 'demo' as "table", 'rows_in' as measure, count(*) as value from demo
  union all select 'demo', 'blank_key', 0
  union all select 'demo', 'sex_defaulted', count(*) from demo where sex not in ('F','M')
  union all select 'demo', 'age_imputed', count(*) from demo where ({_AGE}) is null
  union all select 'demo', 'country_not_two_letters', count(*) from demo where length(trim(reporter_country)) <> 2
  union all select 'demo', 'rows_out', count(*) from (select distinct * exclude (rare_note) from demo)
  union all select 'drug', 'rows_in', count(*) from drugs
  union all select 'drug', 'blank_key', 0
  union all select 'drug', 'blank_drug', count(*) from drugs where drugname is null
  union all select 'drug', 'role_defaulted', count(*) from drugs where role_cod is null
  union all select 'drug', 'route_unknown', count(*) from drugs where route is null
  union all select 'drug', 'dose_out_of_range', count(*) from drugs where {_DOSE} > 10000 or {_DOSE} < 0
  union all select 'drug', 'dechal_defaulted', count(*) from drugs where dechal is null or dechal <> 'Y'
  union all select 'drug', 'rows_out', count(*) from (select distinct primaryid, drugname, coalesce(role_cod, 'UNK'), coalesce(route, 'unknown'),
    case when {_DOSE} between 0 and 10000 then {_DOSE} else
     (select quantile_cont({_DOSE}, 0.5) from drugs where drugname is not null and {_DOSE} between 0 and 10000) end, dechal = 'Y' and dechal is not null
    from drugs where drugname is not null)
  union all select 'reac', 'rows_in', count(*) from reactions
  union all select 'reac', 'blank_key', 0
  union all select 'reac', 'short_term', count(*) from reactions where length(trim(pt)) < 3
  union all select 'reac', 'action_defaulted', count(*) from reactions where drug_rec_act is null
  union all select 'reac', 'rows_out', count(*) from syn where length(pt) >= 3 or pt is null)
select * from m""",
)

# --- joins -----------------------------------------------------------------------------

_add(
    "join_multiway_inner",
    f"""with {FOUR} select pt, code, code_drug, outc_cod, count(*) as n, cast(sum(drug) as bigint) as drug_sum
from demo join drug using (primaryid) join reac using (primaryid) join outc using (primaryid) group by all""",
)
_add(
    "joined_pair_counts",
    f"""with {FOUR} select code_drug as code, pt, count(*) as count_a
from demo join drug using (primaryid) join reac using (primaryid) join outc using (primaryid) group by all""",
)
_add(
    "explosion_size",
    f"""with {FOUR}, k as (select primaryid, count(*) as n
  from demo join drug using (primaryid) join reac using (primaryid) join outc using (primaryid) group by all)
select cast(sum(n) as double) as joined_rows, cast(max(n) as double) as largest_key_rows, count(*) as joined_keys from k""",
)
_KEYS = """keys as (select primaryid from demo intersect select primaryid from drug intersect
 select primaryid from reac intersect select primaryid from outc)"""
_add("common_keys", f"with {FOUR}, {_KEYS} select primaryid from keys")
_add(
    "coherent_sample",
    f"""with {FOUR}, {_KEYS}, s as (select primaryid from keys order by {u(42, 'primaryid')}, primaryid limit 500)
select primaryid, count(*) as n, cast(sum(drug) as bigint) as drug_sum from drug where primaryid in (select primaryid from s) group by all""",
)
_add(
    "limited_join",
    f"""with {FOUR}, f as (select primaryid from demo order by primaryid limit 100)
select count(*) as joined_rows from f join drug using (primaryid)""",
)
_add(
    "case_assembly",
    """with d as (select l_orderkey as k, string_agg(cast(l_partkey as varchar), ',' order by l_linenumber, cast(l_partkey as varchar)) as drugs
  from lineitem where l_returnflag = 'R' group by all),
 r as (select l_orderkey as k, string_agg(cast(l_suppkey as varchar), ',' order by cast(l_suppkey as varchar)) as reactions from lineitem group by all)
select o_orderkey as primaryid, o_orderstatus as sex, drugs, reactions,
 case when o_orderstatus = 'F' then o_orderpriority else '' end as outcomes
from orders join d on d.k = o_orderkey join r on r.k = o_orderkey""",
)

# --- balancing -------------------------------------------------------------------------

_add(
    "undersample",
    f"""with {SCORED}, c as (select severity, count(*) as n from scored group by all),
 least as (select severity as s, n from c order by n, severity limit 1),
 pool as (select o_orderkey, severity, row_number() over (order by {u(42, 'o_orderkey')}, o_orderkey) as r from scored where severity <> (select s from least))
select o_orderkey, severity from scored where severity = (select s from least)
union all select o_orderkey, severity from pool where r <= (select n from least)""",
)
_add(
    "undersample_per_class",
    f"""with c as (select min(n) as n from (select count(*) as n from labels group by quality)),
 r as (select doc_id, quality, row_number() over (partition by quality order by {u(42, 'doc_id')}, doc_id) as r,
  count(*) over (partition by quality) as m from labels)
select doc_id, quality from r where r <= (select n from c)""",
)
_add(
    "knn_exact",
    """with d as (select a.vec_id, b.vec_id as nn_id,
  list_sum(list_transform(list_zip(a.embedding::double[], b.embedding::double[]), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) as d2
  from embeddings a join embeddings b on a.vec_id <> b.vec_id)
select vec_id, cast(row_number() over (partition by vec_id order by d2, nn_id) as int) as rank, nn_id, round(sqrt(d2), 5) as distance
from d qualify rank <= 5""",
)
_D2 = "pow(a.n_chars - b.n_chars, 2) + pow(a.n_spaces - b.n_spaces, 2) + pow(a.n_lines - b.n_lines, 2)"


def _near(name: str, base: str, k: int, same: bool, d2: str = _D2, extra: str = "") -> str:
    cond = "and a.quality = b.quality" if same else ""
    return f"""{name} as (select a.doc_id, a.quality, b.doc_id as nn_id, b.quality as nn_quality, {d2} as d2,
  b.n_chars as x1, b.n_spaces as x2, b.n_lines as x3, {extra}
  row_number() over (partition by a.doc_id order by {d2}, b.doc_id) as r
  from {base} a join {base} b on a.doc_id <> b.doc_id {cond} qualify r <= {k})"""


_add(
    "knn_same_class",
    f"""with {LABELLED}, {_near('nn', 'labelled', 5, True)}
select doc_id, cast(r as int) as rank, nn_id, round(sqrt(d2), 6) as distance from nn""",
)
_add(
    "knn_numeric",
    f"""with {LABELLED}, {_near('nn', 'labelled', 5, False)}
select doc_id, cast(r as int) as rank, nn_id, round(sqrt(d2), 6) as distance from nn""",
)
_TOMEK = f"""{_near('nn', 'labelled', 1, False)},
 links as (select p.doc_id as a, p.nn_id as b, p.quality as label_a, p.nn_quality as label_b
  from nn p join nn q on p.nn_id = q.doc_id and q.nn_id = p.doc_id where p.doc_id < p.nn_id and p.quality <> p.nn_quality)"""
_add("tomek_links", f"with {LABELLED}, {_TOMEK} select * from links")
_LEAST = "least as (select quality as s, count(*) as n from labelled group by all order by n, s limit 1)"
_add(
    "remove_tomek",
    f"""with {LABELLED}, {_TOMEK}, {_LEAST},
 gone as (select a as id from links where label_a <> (select s from least) union select b from links where label_b <> (select s from least))
select doc_id, quality from labelled where doc_id not in (select id from gone)""",
)


def _votes(near: str) -> str:
    return f"""votes as (select doc_id, nn_quality as vote, count(*) as n,
  row_number() over (partition by doc_id order by count(*) desc, nn_quality) as p from {near} group by doc_id, nn_quality)"""


_add(
    "enn",
    f"""with {LABELLED}, {_near('nn', 'labelled', 3, False)}, {_votes('nn')}
select doc_id, quality from labelled join votes using (doc_id) where p = 1 and vote = quality""",
)
_NEED = """sizes as (select quality, count(*) as n from labelled group by all),
 need as (select quality, n, (select max(n) from sizes) - n as k from sizes),
 starts as (select quality, n, k, cast(sum(k) over (order by quality) - k as bigint) as first from need),
 wanted as (select quality, n, first + unnest(range(k)) as j from starts)"""
_RANKED = f"""ranked as (select *, row_number() over (partition by quality order by {u(42, 'doc_id')}, doc_id) as rk,
  count(*) over (partition by quality) as bases from {{base}})"""


def _made(near: str, extra: str = "") -> str:
    gap = u(42, "'gap'", "j")
    return f"""picked as (select w.j, w.quality, p.doc_id, p.n_chars as f1, p.n_spaces as f2, p.n_lines as f3,
   (select count(*) from {near} q where q.doc_id = p.doc_id) as m
  from wanted w join ranked p on p.quality = w.quality and p.rk = floor({u(42, "'base'", 'w.j')} * p.bases) + 1),
 made as (select -j - 1 as doc_id, f1 + {gap} * (x1 - f1) as n_chars, f2 + {gap} * (x2 - f2) as n_spaces,
   f3 + {gap} * (x3 - f3) as n_lines, {extra} p.quality, true as is_synthetic
  from picked p join {near} q on q.doc_id = p.doc_id and q.r = floor({u(42, "'near'", 'j')} * m) + 1)"""


_ROUND = "round(n_chars, 4) as n_chars, round(n_spaces, 4) as n_spaces, round(n_lines, 4) as n_lines"
_ALL = f"""select doc_id, {_ROUND}, quality, is_synthetic from
 (select doc_id, n_chars, n_spaces, n_lines, quality, false as is_synthetic from labelled union all select * from made)"""
_SMOTE = f"{LABELLED}, {_NEED}, {_near('near', 'labelled', 5, True)}, {_RANKED.format(base='labelled')}, {_made('near')}"
_add("smote", f"with {_SMOTE} {_ALL}")
_add(
    "borderline_smote",
    f"""with {LABELLED}, {_NEED}, {_near('ctx', 'labelled', 7, False)},
 danger as (select doc_id, quality from ctx where quality in (select quality from need where k > 0) group by all
  having count(*) filter (where nn_quality <> quality) * 2 >= count(*) and count(*) filter (where nn_quality <> quality) < count(*)),
 dangerous as (select l.* from labelled l join danger using (doc_id)),
 {_near('near', 'labelled', 5, True)}, {_RANKED.format(base='dangerous')}, {_made('near')} {_ALL}""",
)
_GAP = u(42, "'gap'", "j")
_add(
    "adasyn",
    f"""with {LABELLED}, {_NEED}, {_near('ctx', 'labelled', 5, False)},
 hard as (select doc_id, quality, count(*) filter (where nn_quality <> quality) as others from ctx
  where quality in (select quality from need where k > 0) group by all),
 quota as (select doc_id, h.quality, cast(round_even(others * cast(k as double) / sum(others) over (partition by h.quality), 0) as bigint) as q
  from hard h join need n on n.quality = h.quality),
 numbered as (select *, cast(sum(q) over (order by quality, doc_id) - q as bigint) as first from quota where q > 0),
 many as (select doc_id, quality, first + unnest(range(q)) as j from numbered),
 {_near('near', 'labelled', 5, True)},
 made as (select -j - 1 as doc_id, l.n_chars + {_GAP} * (x1 - l.n_chars) as n_chars, l.n_spaces + {_GAP} * (x2 - l.n_spaces) as n_spaces,
   l.n_lines + {_GAP} * (x3 - l.n_lines) as n_lines, m.quality, true as is_synthetic
  from many m join labelled l using (doc_id)
  join near q on q.doc_id = m.doc_id and q.r = floor({u(42, "'near'", 'j')} * (select count(*) from near z where z.doc_id = m.doc_id)) + 1)
 {_ALL}""",
)
_NC = f"({_D2} + (case when a.lang <> b.lang then 1 else 0 end) * (select w from weight) + (case when a.source <> b.source then 1 else 0 end) * (select w from weight))"
_add(
    "smote_nc",
    f"""with {LABELLED}, {_NEED}, {_LEAST},
 weight as (select pow(quantile_cont(s, 0.5), 2) as w from (select unnest([stddev_pop(n_chars), stddev_pop(n_spaces), stddev_pop(n_lines)]) as s
  from labelled where quality = (select s from least))),
 small as (select * from labelled where quality in (select quality from need where k > 0)),
 {_near('near', 'small', 5, True, _NC, 'b.lang as nlang, b.source as nsource,')},
 modes as (select doc_id, arg_min(nlang, struct_pack(c := -lc, v := nlang)) as mlang, arg_min(nsource, struct_pack(c := -sc, v := nsource)) as msource
  from (select doc_id, nlang, nsource, count(*) over (partition by doc_id, nlang) as lc, count(*) over (partition by doc_id, nsource) as sc from near) group by doc_id),
 {_RANKED.format(base='small')}, {_made('near', "(select mlang from modes z where z.doc_id = p.doc_id) as lang, (select msource from modes z where z.doc_id = p.doc_id) as source,")}
select doc_id, {_ROUND}, lang, source, quality, is_synthetic from
 (select doc_id, n_chars, n_spaces, n_lines, lang, source, quality, false as is_synthetic from labelled union all select * from made)""",
)
_add(
    "smote_enn",
    f"""with {_SMOTE},
 grown as (select doc_id, n_chars, n_spaces, n_lines, quality, false as is_synthetic from labelled union all select * from made),
 {_near('nn', 'grown', 3, False)}, {_votes('nn')}
select doc_id, {_ROUND}, quality, is_synthetic from grown join votes using (doc_id) where p = 1 and vote = quality""",
)
_UNDER = f"""pool as (select doc_id, quality, row_number() over (order by {u(42, 'doc_id')}, doc_id) as r from labelled where quality <> (select s from least)),
 under as (select doc_id, quality from labelled where quality = (select s from least) union all select doc_id, quality from pool where r <= (select n from least))"""
_TOMEK_KEPT = """gone as (select a as id from links where label_a <> (select s from least) union select b from links where label_b <> (select s from least)),
 tk as (select doc_id, quality from labelled where doc_id not in (select id from gone))"""
_THREE = f"""{_SMOTE}, {_LEAST}, {_UNDER}, {_TOMEK}, {_TOMEK_KEPT},
 sm as (select quality from labelled union all select quality from made),
 counts as (select 'before' as t, quality, count(*) as n from labelled group by all
  union all select 'random_undersampling', quality, count(*) from under group by all
  union all select 'tomek', quality, count(*) from tk group by all union all select 'smote', quality, count(*) from sm group by all)"""
_add(
    "compare_techniques",
    f"""with {_THREE}, s as (select t, cast(sum(n) as bigint) as rows, max(n) / min(n) as ratio from counts group by t),
 b as (select rows, ratio from s where t = 'before')
select case s.t when 'smote' then 'SMOTE' when 'tomek' then 'Tomek Links' else 'Random Undersampling' end as technique,
 b.rows as rows_before, s.rows as rows_after, round(b.ratio, 2) as ratio_before, round(s.ratio, 2) as ratio_after,
 round((b.ratio - s.ratio) / b.ratio * 100, 1) as gain_pct, s.ratio <= 2 as balanced from s, b where s.t <> 'before'""",
)
_add(
    "class_distribution",
    f"""with {_THREE} select quality, {", ".join(f'''cast(coalesce(sum(n) filter (where t = '{t}'), 0) as bigint) as "{t}"''' for t in ("before", "random_undersampling", "tomek", "smote"))}
from counts group by quality""",
)

# --- leakage, splits, encoders, metrics -------------------------------------------------

_ENTROPY = """tl as (select source, quality, count(*) as n, sum(count(*)) over (partition by source) as rows from labelled group by source, quality),
 entropy as (select source, -sum(n / rows * log2(n / rows + 1e-10::double)) as h, cast(max(rows) as bigint) as rows from tl where rows >= 3 group by source)"""
_add("term_entropy", f"with {LABELLED}, {_ENTROPY} select source, round(h, 6) as entropy, rows from entropy")
_add(
    "dominant_label",
    f"""with {LABELLED}, {_ENTROPY} select source, arg_min(quality, struct_pack(c := -n, v := quality)) as dominant,
 round(max(n) / max(rows), 6) as share, cast(max(rows) as bigint) as rows from tl group by source""",
)
_MASKED = "masked as (select case when source in (select source from entropy where h < 0.6) then 'OUTCOME_PROXY' else source end as masked, source, quality from labelled)"
_add("mask_proxy_terms", f"with {LABELLED}, {_ENTROPY}, {_MASKED} select masked, quality, count(*) as n from masked group by all")
_add("safe_terms", f"with {LABELLED}, {_ENTROPY} select source from entropy where h >= 0.6")


def _mi(rows: str) -> str:
    return f"""joint as (select feature, value, quality, count(*) as n from {rows} group by all),
 marg as (select *, sum(n) over (partition by feature, value) as nx, sum(n) over (partition by feature, quality) as ny,
  sum(n) over (partition by feature) as t from joint),
 mi as (select feature, sum(n / t * ln(n * t / (nx * cast(ny as double)))) as m from marg group by feature)"""


def _bin(col: str) -> str:
    return f"cast(floor((rank() over (order by {col}) - 1) * 8 / count(*) over ()) as varchar)"


_add(
    "mutual_information",
    f"""with {LABELLED}, cells as (select 'source' as feature, source as value, quality from labelled
  union all select 'lang', lang, quality from labelled union all select 'n_chars', {_bin('n_chars')}, quality from labelled
  union all select 'n_spaces', {_bin('n_spaces')}, quality from labelled), {_mi('cells')}
select feature, round(m, 6) as mutual_info, m > 0.7 as leaking from mi""",
)


def _digamma(x: str) -> str:
    """Recurrence up to six, then the asymptotic series."""
    y = f"({x} + 6)"
    series = " + ".join(f"({c}) / pow({y}, {p})" for c, p in ((-1 / 12, 2), (1 / 120, 4), (-1 / 252, 6), (1 / 240, 8), (-1 / 132, 10), (691 / 32760, 12), (-1 / 12, 14)))
    return f"(ln({y}) - 0.5 / {y} + {series} - ({' + '.join(f'1.0::double / ({x} + {i})' for i in range(6))}))"


_add(
    "neighbor_information",
    f"""with {LABELLED}, cells as (select 'n_chars' as feature, doc_id, quality, n_chars as v from labelled
  union all select 'n_spaces', doc_id, quality, n_spaces from labelled union all select 'n_lines', doc_id, quality, n_lines from labelled),
 sized as (select *, count(*) over (partition by feature, quality) as rows from cells qualify rows > 1),
 d as (select a.feature, a.doc_id, abs(a.v - b.v) as d, row_number() over (partition by a.feature, a.doc_id order by abs(a.v - b.v)) as place,
  least(3, a.rows - 1) as k, a.rows from sized a join sized b on a.feature = b.feature and a.quality = b.quality and a.doc_id <> b.doc_id),
 r as (select feature, doc_id, k, rows, d as r from d where place = k),
 m as (select a.feature, a.doc_id, r.k, r.rows, cast(count(*) as double) as m from sized a join r using (feature, doc_id)
  join sized b on b.feature = a.feature and (abs(a.v - b.v) < r.r or a.v = b.v) group by all)
select feature as "column", round(greatest(0.0::double, max({_digamma('cast(n as double)')}) + avg({_digamma('cast(k as double)')} - {_digamma('cast(rows as double)')} - {_digamma('m')})), 6) as mutual_info
from (select *, count(*) over (partition by feature) as n from m) group by feature""",
)
_add(
    "leakage_report",
    f"""with {LABELLED}, {_ENTROPY}, {_MASKED},
 cells as (select 'before' as feature, source as value, quality from masked union all select 'after', masked, quality from masked), {_mi('cells')},
 w as (select max(m) filter (where feature = 'before') as b, max(m) filter (where feature = 'after') as a from mi)
select 'term' as feature, round(b, 6) as before, round(a, 6) as after, round((b - a) / (b + 1e-10::double) * 100, 6) as reduction_pct, a > 0.7 as leaking from w""",
)
_RANK_Y = f"""ry as (select o_orderkey, severity, row_number() over (partition by severity order by {u(42, 'o_orderkey')}, o_orderkey) as r,
 count(*) over (partition by severity) as n from scored)"""
_add("stratified_split", f"with {SCORED}, {_RANK_Y} select o_orderkey, severity, r <= round(n * 0.2::double) as is_test from ry")
_add("kfold", f"with {SCORED}, {_RANK_Y} select o_orderkey, severity, cast((r - 1) % 5 as int) as fold from ry")
_add(
    "ordinal_encode",
    f"""with {REPORTS}, book as (select drugname as v, cast(row_number() over (order by drugname) - 1 as double) as code
  from (select distinct drugname from reports where p_type <> 'SMALL'))
select drugname, coalesce(code, -1.0) as code, count(*) as n from reports left join book on v = drugname group by all""",
)
_CELL = """cm as (select a as actual, p as predicted, (select count(*) from scored s where s.severity = a and s.predicted = p) as n
 from range(1, 6) x(a), range(1, 6) y(p))"""
_add("confusion_matrix", f"with {SCORED}, {_CELL} select cast(actual as int) as actual, cast(predicted as int) as predicted, n from cm")
_add(
    "class_report",
    f"""with {SCORED}, c as (select k as cls, (select count(*) from scored where severity = k and predicted = k) as tp,
  (select count(*) from scored where predicted = k) as pr, (select count(*) from scored where severity = k) as su from range(1, 6) t(k)),
 f as (select cls, coalesce(tp / nullif(pr, 0), 0) as p, coalesce(tp / nullif(su, 0), 0) as r, coalesce(2 * tp / nullif(pr + su, 0), 0) as f, su, tp from c),
 o as (select cast(cls as varchar) as class, p, r, f, su from f union all select 'macro', avg(p), avg(r), avg(f), sum(su) from f
  union all select 'weighted', sum(p * su) / sum(su), sum(r * su) / sum(su), sum(f * su) / sum(su), sum(su) from f
  union all select 'accuracy', sum(tp) / sum(su), sum(tp) / sum(su), sum(tp) / sum(su), sum(su) from f)
select class, round(p, 6) as precision, round(r, 6) as recall, round(f, 6) as f1, cast(su as bigint) as support from o""",
)
_LONG = "long as (" + " union all ".join(f"select {c} as class, s{c} as score, severity = {c} as pos from scored" for c in range(1, 6)) + ")"
_add(
    "roc_auc",
    f"""with {SCORED}, {_LONG}, rk as (select class, pos, rank() over (partition by class order by score) as lo,
  count(*) over (partition by class, score) as ties from long)
select cast(class as int) as class, round((sum(lo + (ties - 1) / 2) filter (where pos) - count(*) filter (where pos) * (count(*) filter (where pos) + 1) / 2)
  / (count(*) filter (where pos) * count(*) filter (where not pos)), 6) as auc,
 count(*) filter (where pos) as positives, count(*) filter (where not pos) as negatives from rk group by class""",
)
_add(
    "mean_roc_curve",
    f"""with {SCORED}, {_LONG}, st as (select class, score, count(*) filter (where pos) as p, count(*) filter (where not pos) as q from long group by all),
 cu as (select class, sum(p) over w / sum(p) over (partition by class) as y, sum(q) over w / sum(q) over (partition by class) as x
  from st window w as (partition by class order by score desc)),
 pts as (select class, x, y from cu union all select distinct class, 0, 0 from cu),
 top as (select class, x, max(y) as yhi, min(y) as ylo from pts group by all),
 g as (select i / 499 as fpr, class from range(500) t(i), (select distinct class from cu)),
 lo as (select g.fpr, g.class, max(t.x) as x0 from g join top t on t.class = g.class and t.x <= g.fpr group by all),
 hi as (select g.fpr, g.class, min(t.x) as x1 from g join top t on t.class = g.class and t.x > g.fpr group by all),
 v as (select lo.fpr, lo.class, case when x1 is null then a.yhi else a.yhi + (b.ylo - a.yhi) / (x1 - x0) * (lo.fpr - x0) end as tpr
  from lo left join hi on hi.fpr = lo.fpr and hi.class = lo.class join top a on a.class = lo.class and a.x = x0
  left join top b on b.class = lo.class and b.x = x1)
select round(fpr, 6) as fpr, round(avg(tpr), 6) as tpr from v group by fpr""",
)

# --- streams ---------------------------------------------------------------------------

_EVENTS = """ev as (select event_id, ts, value, upper(event_type) as drugname,
  'K' || cast(cast(json_extract_string(props, '$.k') as int) % 20 as varchar) as pt from events)"""
_EVENT_CELLS = _CELLS_ROWS.replace("from reports", "from ev")
_STRONG = f"strong as (select drugname, pt, prr, {p_value('chi2')} as p_value from measures where prr > 1.05)"
_add(
    "stream_batch_alerts",
    f"""with {_EVENTS}, {_EVENT_CELLS}, {_measures(False)}, {_STRONG}
select s.drugname, s.pt, round(prr, 6) as prr, round(p_value, 6) as p_value, count(distinct event_id) as n_cases_in_batch
from strong s join ev on ev.drugname = s.drugname and ev.pt = s.pt where p_value < 0.5
group by s.drugname, s.pt, prr, p_value having count(distinct event_id) >= 3""",
)
_add(
    "stream_window_alerts",
    f"""with {_EVENTS}, {_EVENT_CELLS}, {_measures(False)}, {_STRONG},
 days as (select date_trunc('day', ts) as window_start, drugname, pt, count(distinct event_id) as n from ev group by all)
select window_start, s.drugname, s.pt, round(prr, 6) as prr, round(p_value, 6) as p_value, n as n_cases_in_batch
from days d join strong s on d.drugname = s.drugname and d.pt = s.pt
where p_value < 0.5 and n >= 3 and window_start + interval 1 day <= (select max(ts) from ev) - interval 10 minute""",
)
_add(
    "stream_alert_counts",
    f"with {_EVENTS} select drugname as level, count(*) as consumed, count(*) filter (where value >= 10) as alerts from ev group by all",
)

# --- streams, sources and codes ----------------------------------------------------------


def _case(column: str, values: dict, other) -> str:
    """The SQL of a lookup in one of the fixed tables."""
    cells = " ".join(f"when {k!r} then {v!r}" for k, v in values.items())
    return f"case {column} {cells} else {other!r} end"


_add(
    "stream_level_totals",
    """select upper(event_type) as level, count(*) as alerts from events where value >= 10 group by all""",
)
_add(
    "delimited_roundtrip",
    """select cast(c_custkey as varchar) as primaryid, c_mktsegment as sex, cast(c_nationkey as varchar) as age,
 case when c_custkey % 2 <> 0 then c_name end as c_name from customer""",
)
_add(
    "tolerant_read",
    """select c_mktsegment as sex, count(*) as n from customer where c_custkey % 10 <> 3 group by all
 union all select 'bad lines', count(*) from customer where c_custkey % 10 = 3""",
)
_add(
    "json_lines_roundtrip",
    """select cast(c_custkey as varchar) as primaryid, c_mktsegment as sex from customer where c_custkey % 10 <> 3""",
)
_add(
    "csv_signal_lookup",
    f"""with {REPORTS},
 rows_ as (select p_brand as drugname, pt from reports),
 pairs as (select drugname, pt, count(*) as k from rows_ group by all),
 d as (select drugname, count(*) as kd from rows_ group by all), t as (select pt, count(*) as kt from rows_ group by all),
 cells as (select drugname, pt, cast(k as double) as a, cast(kd - k as double) as b, cast(kt - k as double) as c,
                  cast((select count(*) from rows_) - kd - kt + k as double) as d, cast((select count(*) from rows_) as double) as n
           from pairs join d using (drugname) join t using (pt)),
 {_measures(False)} , known as ({_OUT} where a >= 3 and prr >= 1.2 and chi2 >= 3.84)
 select known.count_a is not null as known_signal, count(*) as n, sum(coalesce(cast(known.count_a as double), 0.0)) as counts
 from rows_ left join known on rows_.drugname = known.drugname and rows_.pt = known.pt group by all""",
)
_add(
    "code_labels",
    f"""with rows_ as (select o_custkey as k, ['DE','LT','HO','DS','CA','RI','OT','ZZ'][o_orderkey % 8 + 1] as outc, ['PS','SS','C','I','??'][o_orderkey % 5 + 1] as role from orders),
 rated as (select k, max({_case("outc", rules.SEVERITY_OF_OUTCOME, rules.SEVERITY_DEFAULT)}) as worst from rows_ group by k)
 select {_case("role", rules.ROLE_LABELS, rules.UNKNOWN_LABEL)} as role, {_case("outc", rules.OUTCOME_LABELS, rules.UNKNOWN_LABEL)} as outcome, worst, count(*) as n
 from rows_ join rated using (k) group by all""",
)
_add(
    "case_items",
    f"""with {REPORTS} select primaryid, row_number() over (partition by primaryid order by p_brand, drugname) as position, drugname as item from reports""",
)


def _boost(source: str, ident: str, label: str, features: list[str], classes: list[int], bins: int, depth: int) -> str:
    """Common tables of one round of boosted trees: splits ``b0`` .. , rows in their leaves ``l<depth>``, ``leaves``."""
    p = 1 / len(classes)
    long = " union all ".join(f"select {ident} as id, {label} as y, {i} as fi, cast({f} as double) as x from {source}" for i, f in enumerate(features))
    parts = [
        f"fx as ({long})",
        "pv as (select fi, x, count(*) as m from fx group by all)",
        "cv as (select fi, x, m, sum(m) over (partition by fi order by x) as cum, sum(m) over (partition by fi) as n from pv)",
        f"ed as (select fi, (cum - m) * {bins} // n as s, max(x) as edge from cv group by all)",
        "ee as (select fi, list_sort(list(edge)) as es from ed group by fi)",
        "bn as (select id, fi, es, len(list_filter(es, lambda t: t < x)) as bin from fx join ee using (fi))",
        f"l0 as (select {ident} as id, k, 1 as node, {p!r}::double - case when {label} = k then 1 else 0 end as g, {2 * p * (1 - p)!r}::double as h from {source}, (select unnest({classes}) as k))",
    ]
    for d in range(depth):
        parts += [
            f"h{d} as (select k, node, fi, bin, es, sum(g) as g, sum(h) as h from l{d} join bn using (id) where node >= {1 << d} group by all)",
            f"""c{d} as (select *, sum(g) over u as gl, sum(h) over u as hl, sum(g) over w as gt, sum(h) over w as ht from h{d}
  window u as (partition by k, node, fi order by bin), w as (partition by k, node, fi))""",
            f"""b{d} as (select k, node, fi, bin, es[bin + 1] as edge from (select *, gl * gl / (hl + 1) + (gt - gl) * (gt - gl) / (ht - hl + 1) - gt * gt / (ht + 1) as gain from c{d})
  where hl >= 1 and ht - hl >= 1 and gain > 1e-6 qualify row_number() over (partition by k, node order by round(gain, 9) desc, fi, bin) = 1)""",
            f"""l{d + 1} as (select l.id, l.k, case when b.node is null then l.node when n.bin <= b.bin then 2 * l.node else 2 * l.node + 1 end as node, l.g, l.h
  from l{d} l left join b{d} b on b.k = l.k and b.node = l.node left join bn n on n.id = l.id and n.fi = b.fi)""",
        ]
    parts.append(f"leaves as (select k, node, -0.3::double * sum(g) / (sum(h) + 1) as value from l{depth} group by all)")
    return ",\n ".join(parts)


_add(
    "boosted_nodes",
    f"""with {LABELLED}, {_boost('labelled', 'doc_id', 'quality', ['n_chars', 'n_spaces', 'n_lines'], [0, 1], 16, 2)}
select k as class_no, node, fi as feature, edge as threshold, null as value from b0 union all select k, node, fi, edge, null from b1
union all select k, node, null, null, round(value, 6) from leaves""",
)
_add(
    "boosted_alerts",
    f"""with src as (select o_orderkey, o_totalprice, c_acctbal, 6 - cast(substr(o_orderpriority, 1, 1) as int) as severity from orders join customer on o_custkey = c_custkey),
 {_boost('src', 'o_orderkey', 'severity', ['o_totalprice', 'c_acctbal'], [1, 2, 3, 4, 5], 16, 2)},
 scored as (select id, k, exp(value) as e, sum(exp(value)) over (partition by id) as z from l2 join leaves using (k, node)),
 best as (select id, k, e / z as confidence from scored qualify row_number() over (partition by id order by e / z desc, k) = 1)
select o_orderkey, severity, cast(k as integer) as prediction, round(confidence, 6) as confidence from best join src on id = o_orderkey where k >= 4""",
)
_add(
    "stream_severity_alerts",
    f"""with src as (select event_id, value, cast(props ->> '$.k' as double) as number,
  list_position(['click', 'error', 'purchase', 'signup', 'view'], event_type) as severity from events),
 {_boost('src', 'event_id', 'severity', ['value', 'number'], [1, 2, 3, 4, 5], 16, 2)},
 scored as (select id, k, exp(value) as e, sum(exp(value)) over (partition by id) as z from l2 join leaves using (k, node)),
 best as (select id, k, e / z as confidence from scored qualify row_number() over (partition by id order by e / z desc, k) = 1)
select id as primaryid, cast(k as integer) as predicted_severity, ['Leve','Moderado','Importante','Grave','Muy Grave'][k] as severity_label,
 round(confidence, 6) as confidence_score from best where k >= 4""",
)
