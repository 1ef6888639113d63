"""The same results in plain SQL, written apart from the operators."""

from __future__ import annotations

import json
import re

from bindings.views import CATEGORIES, CODE_PREFIXES, CODES, EXPERIMENT, GRID, MANY_GRID, ORDER_TEMPORAL
from riskrank.operators.modeling import expand_grid
from riskrank.operators.splits import temporal_splits
from riskrank.presets import FEATURE_NAMES

ORACLE: dict[str, str] = {}

# model ids of the baseline experiment, by ranked column
MODEL_IDS = {m.kwargs["column"]: m.model_id for m in expand_grid(EXPERIMENT["model_config"])}

# ---------------------------------------------------------------- shared views

PARTS: dict[str, str] = {}

PARTS["versions"] = """
select o_custkey as entity_key, cast(o_orderdate as date) as received, o_orderkey as seq,
       o_orderstatus as status, o_orderpriority as priority from orders"""

PARTS["evaluations"] = """
select o_custkey as handler, cast(l_shipdate as date) as started, cast(o_orderdate as date) as determined,
       case when l_returnflag = 'R' then 'Y' else 'N' end as found,
       case when l_linestatus = 'F' then 'Y' else 'N' end as complaint,
       case when l_returnflag = 'R' then l_extendedprice end as amount,
       l_orderkey as line_order, l_partkey as line_part, l_suppkey as line_supplier,
       l_linenumber as line_no, l_quantity as line_quantity
from lineitem join orders on l_orderkey = o_orderkey"""

_LINE_ORDER = ("line_order, line_part, line_supplier, line_no, line_quantity, amount nulls last, "
               "found, complaint")


def _matched(versions: str, columns: str) -> str:
    return f"""
select {columns} from (
  select e.*, v.*, row_number() over (partition by e.handler, e.started
         order by {_LINE_ORDER}, received desc, seq desc) as rn
  from evaluations e join {versions} v on e.handler = v.entity_key and e.started >= v.received)
where rn = 1"""


_EVAL_COLUMNS = ("started, determined, found, complaint, amount, line_order, line_part, line_supplier, "
                 "line_no, line_quantity")
PARTS["matched"] = _matched("versions", f"entity_key, received, seq, status, priority, {_EVAL_COLUMNS}")
PARTS["versions_f"] = "select entity_key, received, seq, priority as land_type from versions where status = 'F'"
PARTS["matched_f"] = _matched("versions_f", f"entity_key, received, seq, land_type, {_EVAL_COLUMNS}")

for _suffix in ("", "_f"):
    PARTS[f"entity_ids{_suffix}"] = f"""
select entity_key as id_number, row_number() over (order by entity_key) as id
from (select distinct entity_key from versions{_suffix})"""
    PARTS[f"event_ids{_suffix}"] = f"""
select entity_key, received, row_number() over (order by entity_key, received) as id
from (select distinct entity_key, received from matched{_suffix})"""
    PARTS[f"rolled{_suffix}"] = f"""
select entity_key, received, max(started) as event_date,
       max(greatest(started, determined)) as knowledge_date,
       cast(max(case when found = 'Y' then 1 else 0 end) as integer) as found_violation,
       cast(max(case when complaint = 'Y' then 1 else 0 end) as integer) as citizen_complaint,
       coalesce(max(amount), 0) as penalty_amount,
       cast(case when max(amount) > 0 then 1 else 0 end as integer) as label
from matched{_suffix} group by entity_key, received"""


def _rollup(suffix: str, measures: str) -> str:
    return f"""
select t.id as entity_id, w.id as event_id, event_date, knowledge_date, {measures}
from rolled{suffix} r join entity_ids{suffix} t on t.id_number = r.entity_key
join event_ids{suffix} w on w.entity_key = r.entity_key and w.received = r.received"""


_CATEGORY = "case " + " ".join(
    [f"when p_brand = '{c}' then '{n}'" for c, n in CODES.items()]
    + [f"when starts_with(p_brand, '{c}') then '{n}'" for c, n in CODE_PREFIXES.items()]
) + " else 'others' end"

PARTS["customer_year_flags"] = """
select o_custkey, cast(year(l_shipdate) as integer) as cycle, l_returnflag, sum(l_quantity) as tons
from lineitem join orders on l_orderkey = o_orderkey group by all"""


def _panel(reports: str, ids: str) -> str:
    cells = ", ".join(
        f"case when sum(case when category = '{c}' then tons end) > 0 "
        f"then sum(case when category = '{c}' then tons end) else 0.0 end as {c}" for c in CATEGORIES)
    return f"""
select t.id as entity_id, make_date(cycle, 12, 31) as event_date, {cells}
from (select * from (select distinct reporter from ({reports})), (select distinct cycle from ({reports}))) g
left join ({reports}) r using (reporter, cycle) join {ids} t on t.id_number = reporter
group by t.id, cycle"""


_SUPPLIER_REPORTS = f"""select l_suppkey as reporter, cast(year(l_shipdate) as integer) as cycle,
  {_CATEGORY} as category, l_quantity as tons from lineitem join part on l_partkey = p_partkey"""
_CUSTOMER_REPORTS = f"""select o_custkey as reporter, cast(year(l_shipdate) as integer) as cycle,
  {_CATEGORY} as category, l_quantity as tons from lineitem join orders on l_orderkey = o_orderkey
  join part on l_partkey = p_partkey
  where o_custkey in (select o_custkey from orders where o_orderstatus = 'F')"""

# three repeats of two training as-of dates and one test period, written out
PARTS["splits"] = """
select * from (values
  (0, 0, 'train', date '2024-01-01', date '2024-01-06', date '2024-01-06', date '2024-01-11', date '2024-01-21'),
  (1, 0, 'train', date '2024-01-01', date '2024-01-11', date '2024-01-11', date '2024-01-16', date '2024-01-21'),
  (2, 0, 'test',  date '2024-01-06', date '2024-01-16', date '2024-01-16', date '2024-01-21', date '2024-01-21'),
  (3, 1, 'train', date '2024-01-01', date '2024-01-11', date '2024-01-11', date '2024-01-16', date '2024-01-26'),
  (4, 1, 'train', date '2024-01-01', date '2024-01-16', date '2024-01-16', date '2024-01-21', date '2024-01-26'),
  (5, 1, 'test',  date '2024-01-11', date '2024-01-21', date '2024-01-21', date '2024-01-26', date '2024-01-26'),
  (6, 2, 'train', date '2024-01-01', date '2024-01-16', date '2024-01-16', date '2024-01-21', date '2024-01-31'),
  (7, 2, 'train', date '2024-01-01', date '2024-01-21', date '2024-01-21', date '2024-01-26', date '2024-01-31'),
  (8, 2, 'test',  date '2024-01-16', date '2024-01-26', date '2024-01-26', date '2024-01-31', date '2024-01-31')
) as s(split_id, repeat, role, feature_start, feature_end, label_start, label_end, as_of)"""

PARTS["order_splits"] = "select * from (values " + ", ".join(
    f"({s.split_id}, date '{s.feature_end}', date '{s.as_of}')" for s in temporal_splits(ORDER_TEMPORAL)
) + ") as s(split_id, feature_end, as_of)"
PARTS["order_events"] = """
select o_custkey as entity_id, cast(o_orderdate as date) as event_date, o_orderstatus = 'F' as found from orders"""

PARTS["entity_events"] = """
select user_id as entity_id, event_id, cast(ts as date) as event_date,
       cast(ts as date) + case event_type when 'signup' then 0 when 'view' then 1 when 'click' then 2
                               when 'purchase' then 3 else 4 end as knowledge_date,
       case when event_type = 'error' then 1 else 0 end as found_violation,
       case when event_type = 'signup' then 1 else 0 end as citizen_complaint,
       cast(case when event_type = 'purchase' then value else 0 end as decimal(12, 2)) as penalty_amount
from events"""
PARTS["entity_labels"] = """
select entity_id, event_date, knowledge_date, case when penalty_amount > 50 then 1 else 0 end as label
from entity_events"""
PARTS["visible"] = """
select s.split_id, s.feature_end, e.* from entity_events e join splits s
on e.event_date between s.feature_start and s.feature_end and e.knowledge_date <= s.feature_end"""
PARTS["cohort"] = """
select distinct split_id, entity_id from entity_events join splits on event_date <= as_of"""
PARTS["label_rows"] = """
select split_id, entity_id, cast(max(label) as integer) as label from entity_labels join splits
on event_date between label_start and label_end and knowledge_date <= label_end group by all"""
PARTS["daily_panel"] = """
select user_id as entity_id, cast(ts as date) as event_date, count(*) as day_events,
       round(sum(value), 2) as day_value
from events group by all"""
PARTS["latest"] = """
select split_id, entity_id, event_date, day_events, day_value from (
  select s.split_id, p.*, row_number() over (partition by split_id, entity_id order by event_date desc) as rn
  from daily_panel p join splits s on event_date between feature_start and feature_end)
where rn = 1"""


def _within(days: int, column: str) -> str:
    return f"case when event_date > feature_end - {days} then {column} end"


PARTS["event_features"] = f"""
select split_id, entity_id,
  cast(sum(found_violation) as bigint) as events_sum_found_violation,
  cast(sum({_within(7, 'found_violation')}) as bigint) as events_sum_found_violation_7_days,
  cast(sum({_within(14, 'found_violation')}) as bigint) as events_sum_found_violation_14_days,
  avg(found_violation) as events_avg_found_violation,
  avg({_within(7, 'found_violation')}) as events_avg_found_violation_7_days,
  avg({_within(14, 'found_violation')}) as events_avg_found_violation_14_days,
  cast(sum(citizen_complaint) as bigint) as events_sum_citizen_complaint,
  cast(sum({_within(7, 'citizen_complaint')}) as bigint) as events_sum_citizen_complaint_7_days,
  cast(sum(penalty_amount) as double) as events_sum_penalty_amount,
  cast(sum({_within(7, 'penalty_amount')}) as double) as events_sum_penalty_amount_7_days,
  cast(min(feature_end - event_date) as integer) as events_days_since_event_date
from visible group by split_id, entity_id"""

_SUMS = [f"events_sum_{c}{w}" for c, ws in
         (("found_violation", ("", "_7_days", "_14_days")), ("citizen_complaint", ("", "_7_days")),
          ("penalty_amount", ("", "_7_days"))) for w in ws]
_AVGS = [f"events_avg_found_violation{w}" for w in ("", "_7_days", "_14_days")]


def _flagged(name: str, value: str, expr: str | None = None) -> str:
    return (f"{expr or f'coalesce({name}, {value})'} as {name}, "
            f"cast(case when {name} is null then 1 else 0 end as integer) as {name}_impute_flag")


def _filled(name: str) -> str:
    if "penalty" in name:
        return _flagged(name, "0", f"round(coalesce({name}, 0), 6)")
    return _flagged(name, "0")


PARTS["matrix"] = f"""
select split_id, entity_id,
  round(coalesce(c_acctbal, avg(c_acctbal) over (partition by split_id)), 6) as c_acctbal,
  round(coalesce(c_nationkey, avg(c_nationkey) over (partition by split_id)), 6) as c_nationkey,
  {_flagged('day_events', '0')},
  {_flagged('day_value', '0', 'round(coalesce(day_value, 0), 6)')},
  {', '.join(_filled(n) for n in _SUMS)},
  {', '.join(f'round(coalesce({n}, 0), 6) as {n}' for n in _AVGS)},
  {_flagged('events_days_since_event_date', '100000000')}
from cohort
left join (select c_custkey as entity_id, c_acctbal, c_nationkey from customer) using (entity_id)
left join (select split_id, entity_id, day_events, day_value from latest) using (split_id, entity_id)
left join event_features using (split_id, entity_id)"""

_RANKED_COLUMNS = list(MODEL_IDS)
PARTS["baseline_long"] = " union all ".join(
    f"select repeat, role, split_id, entity_id, '{i}' as model_id, cast({c} as double) as value from matrix "
    f"join splits using (split_id)" for c, i in MODEL_IDS.items())
PARTS["baseline_ranked"] = """
select *, row_number() over (partition by repeat, role, model_id order by value desc, entity_id, split_id) as rank,
       count(*) over (partition by repeat, role, model_id) as group_rows from baseline_long"""
_AT = [("50", "50"), ("0.1", "floor(group_rows * 0.1::double)"), ("1.0", "group_rows")]
PARTS["baseline_predictions"] = f"""
select repeat, split_id, entity_id, model_id, rank, group_rows,
  round(case when group_rows = 1 then 0.0 else (group_rows - rank)::double / (group_rows - 1) end, 9) as probability,
  {', '.join(f'cast(rank <= {n} as integer) as "prediction_at_{k}"' for k, n in _AT)}
from baseline_ranked where role = 'test'"""


def _metric_columns(at: list[tuple[str, str]]) -> list[tuple[str, str]]:
    out = []
    hit = "coalesce(sum(case when rank <= {n} and label = 1 then 1 else 0 end), 0)::double"
    flagged = "sum(case when rank <= {n} then 1 else 0 end)"
    for k, n in at:
        out.append((f"precision_score_at_{k}", f"coalesce({hit.format(n=n)} / nullif({flagged.format(n=n)}, 0), 0)"))
    for k, n in at:
        out.append((f"recall_score_at_{k}", f"coalesce({hit.format(n=n)} / nullif(sum(label), 0), 0)"))
    for k, n in at:
        out.append((f"num_labeled_samples_at_{k}", f"{flagged.format(n=n)}::double"))
    return out


_EXP_METRICS = _metric_columns(_AT)
PARTS["experiment_metrics"] = f"""
select repeat, role, model_id, cast(count(*) as bigint) as num_labeled_rows,
  {', '.join(f'round_even({e}, 4) as "{n}"' for n, e in _EXP_METRICS)}
from baseline_ranked join label_rows using (split_id, entity_id) group by repeat, role, model_id"""
_KWARGS = "case model_id " + " ".join(
    f"""when '{i}' then '{{"column": "{c}"}}'""" for c, i in MODEL_IDS.items()) + " end"
PARTS["experiment_results"] = f"""
select model_id, 'RankBaseline' as model_class, {_KWARGS} as model_kwargs, m.repeat, m.role,
       label_start as split_date, num_labeled_rows, {', '.join(f'"{n}"' for n, _ in _EXP_METRICS)}
from experiment_metrics m join splits s on s.repeat = m.repeat and s.role = 'test'"""
PARTS["test_results"] = "select * from experiment_results where role = 'test'"

# documents
PARTS["docs"] = """
select 0 as split_id, doc_id as entity_id, n_chars, cast(len(string_split(text, ' ')) as integer) as n_words,
       cast(length(text) - length(replace(text, chr(10), '')) + 1 as integer) as n_lines from documents"""
PARTS["doc_labels"] = "select 0 as split_id, doc_id as entity_id, quality as label from labels"
PARTS["doc_ranked"] = """
select split_id, entity_id, model_id, probability,
       row_number() over (partition by model_id order by probability desc, entity_id) as rank,
       count(*) over (partition by model_id) as group_rows
from (select split_id, entity_id, 'by_n_chars' as model_id, n_chars::double as probability from docs union all
      select split_id, entity_id, 'by_n_words', n_words::double from docs)"""
_DOC_AT = [("50", "50"), ("0.01", "floor(group_rows * 0.01::double)"),
           ("0.1", "floor(group_rows * 0.1::double)"), ("1.0", "group_rows")]
_DOC_METRICS = _metric_columns(_DOC_AT)
PARTS["doc_flags"] = f"""
select split_id, entity_id, model_id, probability, rank, group_rows,
  {', '.join(f'cast(rank <= {n} as integer) as "prediction_at_{k}"' for k, n in _DOC_AT)} from doc_ranked"""
PARTS["doc_metrics"] = f"""
select split_id, model_id, cast(count(*) as bigint) as num_labeled_rows,
  {', '.join(f'{e} as "{n}"' for n, e in _DOC_METRICS)}
from doc_ranked join doc_labels using (split_id, entity_id) group by split_id, model_id"""

PARTS["blocks"] = """
select n_regionkey as state, c_mktsegment as county, c_custkey as tract, cast(floor(c_acctbal) as bigint) as population,
       c_nationkey as zip from customer join nation on c_nationkey = n_nationkey"""

_NEEDS = {name: [p for p in PARTS if p != name and re.search(rf"\b{p}\b", text)]
          for name, text in PARTS.items()}


def _sql(text: str) -> str:
    """Put the views a statement mentions in front of it, in order of need."""
    wanted: list[str] = []

    def need(name: str) -> None:
        for inner in _NEEDS[name]:
            if inner not in wanted:
                need(inner)
        if name not in wanted:
            wanted.append(name)

    for name in PARTS:
        if re.search(rf"\b{name}\b", text):
            need(name)
    views = ",\n".join(f"{n} as ({PARTS[n]})" for n in wanted)
    return f"with {views}\n{text}" if wanted else text


def check(name: str, text: str) -> None:
    ORACLE[name] = _sql(text)


# ---------------------------------------------------------------- ingest and clean

_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
check("load_demographics", f"""
select c_nationkey as county, c_custkey as block_group, c_acctbal as total_pop, mean_county_income
from customer left join (
  select c_nationkey, round(avg(total), 4) as mean_county_income from (
    select c_nationkey, c_mktsegment, sum(c_acctbal) as total from customer
    where c_mktsegment in ({', '.join(f"'{s}'" for s in _SEGMENTS)}) group by all)
  group by c_nationkey) using (c_nationkey)""")
check("load_zip_density", """
select case when length(c_custkey::varchar) < 5 then lpad(c_custkey::varchar, 5, '0') else c_custkey::varchar end as zip,
  c_nationkey as population, c_acctbal as zip_area_sq_miles,
  round(c_acctbal / (c_nationkey + 1), 6) as zip_density_sq_miles from customer""")
check("link_geography", """
select c_custkey as tract, c_nationkey as county, c_acctbal, n_name as zip
from customer join nation on c_nationkey = n_nationkey""")
check("clean_entities", "select entity_key, received, seq, priority as land_type from versions where status = 'F'")
check("asof_latest_version", "select * from matched")
check("asof_timestamps", """
select viewer, seen_at, view_id, user_id, ts, event_id, event_type from (
  select a.user_id, a.ts, a.event_id, a.event_type, b.user_id as viewer, b.ts as seen_at, b.event_id as view_id,
    row_number() over (partition by a.user_id, a.ts order by a.event_id, b.ts desc, b.event_id desc) as rn
  from events a join events b on a.user_id = b.user_id and b.ts <= a.ts
  where a.event_type <> 'view' and b.event_type = 'view')
where rn = 1""")
check("clean_reports", """
select l_orderkey, l_linenumber, l_quantity, lower(l_returnflag) as l_returnflag from lineitem
where l_orderkey in (select o_orderkey from orders where o_orderstatus = 'F')""")
check("clean_reports_fan_out", """
select c_custkey, lower(c_mktsegment) as c_mktsegment from customer join orders on c_custkey = o_custkey""")
check("entity_ids", "select * from entity_ids")
check("event_ids", """
select entity_key, received, row_number() over (order by entity_key, received) as id
from (select distinct entity_key, received from versions)""")

# ---------------------------------------------------------------- semantic layer

check("rollup_events", _rollup("", "found_violation, citizen_complaint, penalty_amount"))
check("rollup_labels", _rollup("", "label"))
check("categorize_codes", f"select p_partkey, p_brand, {_CATEGORY} as category from part")
check("densify", """
select o_custkey, cycle, l_returnflag, case when tons > 0 then tons else 0.0 end as tons
from (select * from (select distinct o_custkey from customer_year_flags),
       (select distinct cycle from customer_year_flags), (select unnest(['A', 'N', 'R']) as l_returnflag))
left join customer_year_flags using (o_custkey, cycle, l_returnflag)""")
check("densify_many_values", """
select s.o_orderstatus, o.o_orderkey,
       case when s.o_orderstatus = o.o_orderstatus and o_totalprice > 0 then o_totalprice::double else 0.0::double end as price
from orders o, (select distinct o_orderstatus from orders) s""")
check("pivot_wide", """
select o_custkey, cycle, sum(tons) filter (l_returnflag = 'A') as A, sum(tons) filter (l_returnflag = 'N') as N,
       sum(tons) filter (l_returnflag = 'R') as R from customer_year_flags group by all""")
check("reporting_panel", _panel(
    _SUPPLIER_REPORTS,
    "(select s_suppkey as id_number, row_number() over (order by s_suppkey) as id from supplier)"))
def _geography(ids: str) -> str:
    """Measures of the nation and segment of customers with an id."""
    return f"""
select id as entity_id, z.zip, zip_population, county, county_population, zip_area_sq_miles, zip_density_sq_miles,
       mean_county_income
from ({ids}) f
left join (
  select zip, cast(sum(population) as bigint) as zip_population, min(mean_county_income) as mean_county_income
  from blocks left join (
    select state, county, round(avg(o_totalprice), 2) as mean_county_income
    from blocks join orders on tract = o_custkey group by all) using (state, county)
  group by zip) z on z.zip = c_nationkey
left join (select s_nationkey, count(*)::double as zip_area_sq_miles, max(s_acctbal) as zip_density_sq_miles
           from supplier group by s_nationkey) d on s_nationkey = c_nationkey
left join (select distinct zip as county_zip, county from blocks) on county_zip = c_nationkey
left join (select county, cast(sum(population) as bigint) as county_population from blocks group by county)
  using (county)"""


check("geo_demographics", _geography("select c_custkey, c_nationkey, row_number() over (order by c_custkey) as id from customer"))
check("run_preprocessing_acs", _geography("""
select c_custkey, c_nationkey, row_number() over (order by c_custkey) as id
from customer where c_custkey in (select o_custkey from orders where o_orderstatus = 'F')"""))

# ---------------------------------------------------------------- splits, cohorts, features, labels

check("temporal_splits", """
select s.split_id, repeat, role, cast(case when role = 'test' then 0 else (split_id % 3) end as integer) as split,
  feature_start, feature_end, label_start, label_end, as_of,
  (select count(*) from entity_events where event_date between feature_start and feature_end
     and knowledge_date <= feature_end) as feature_events,
  (select count(*) from entity_events where event_date between label_start and label_end
     and knowledge_date <= label_end) as label_events
from splits s""")
check("fan_out", "select split_id, entity_id, event_id, event_date from visible")
check("build_cohort", "select distinct split_id, entity_id from order_events join order_splits on event_date <= as_of")
check("cohort_at_feature_end", """
select distinct split_id, entity_id from order_events join order_splits on event_date <= feature_end""")
check("cohort_user_query", """
select distinct split_id, entity_id from order_events join order_splits on event_date <= as_of where found""")
check("select_labels", "select * from label_rows")
check("select_labels_half_open", """
select split_id, entity_id, cast(max(label) as integer) as label from entity_labels join splits
on event_date > label_start and event_date <= label_end and knowledge_date <= label_end group by all""")
check("latest_record_asof", "select * from latest")
check("static_features", "select c_custkey as entity_id, c_acctbal, c_nationkey from customer")
check("window_features", f"""
select split_id, entity_id,
  cast(sum(found_violation) as bigint) as ev_sum_found_violation,
  cast(sum({_within(7, 'found_violation')}) as bigint) as ev_sum_found_violation_7_days,
  cast(sum({_within(14, 'found_violation')}) as bigint) as ev_sum_found_violation_14_days,
  round(avg(found_violation), 6) as ev_avg_found_violation,
  round(avg({_within(7, 'found_violation')}), 6) as ev_avg_found_violation_7_days,
  round(avg({_within(14, 'found_violation')}), 6) as ev_avg_found_violation_14_days,
  count(found_violation) as ev_count_found_violation,
  count({_within(7, 'found_violation')}) as ev_count_found_violation_7_days,
  count({_within(14, 'found_violation')}) as ev_count_found_violation_14_days,
  {', '.join(f"cast({how}({_within(7, 'penalty_amount') if w else 'penalty_amount'}) as double) "
             f"as ev_{how}_penalty_amount{w}" for how in ('sum', 'min', 'max') for w in ('', '_1_week'))},
  round(stddev_samp(penalty_amount::double), 6) as ev_stddev_penalty_amount,
  cast(min(feature_end - event_date) as integer) as ev_days_since_event_date
from visible group by split_id, entity_id""")
PARTS["value_counts"] = f"""
select split_id, entity_id, penalty_amount::double as v, count(*) as n, count({_within(7, '1')}) as near
from visible where penalty_amount is not null group by split_id, entity_id, penalty_amount"""
PARTS["value_modes"] = """
select split_id, entity_id, first(v order by n desc, v) as of_all,
       first(v order by near desc, v) filter (near > 0) as of_week
from value_counts group by split_id, entity_id"""
_NEEDS |= {"value_counts": ["visible"], "value_modes": ["value_counts"]}
_QUANTILES = ", ".join(f"round(quantile_cont({x}, {q}), 6) as ev_{name}_penalty_amount{w}"
                       for name, q in (("median", 0.5), ("percentile_90", 0.9))
                       for w, x in (("", "penalty_amount::double"), ("_1_week", _within(7, "penalty_amount::double"))))
check("window_features_median", f"""
select split_id, entity_id, {_QUANTILES},
  round(any_value(of_all), 6) as ev_mode_penalty_amount, round(any_value(of_week), 6) as ev_mode_penalty_amount_1_week,
  count(distinct penalty_amount) as ev_count_distinct_penalty_amount,
  count(distinct {_within(7, 'penalty_amount')}) as ev_count_distinct_penalty_amount_1_week,
  round(quantile_cont(found_violation::double, 0.5), 6) as ev_median_found_violation,
  cast(sum(found_violation) as bigint) as ev_sum_found_violation
from visible left join value_modes using (split_id, entity_id) group by split_id, entity_id""")
check("days_since_features", """
select split_id, entity_id, cast(min(feature_end - event_date) as integer) as ev_days_since_event_date,
  cast(min(feature_end - knowledge_date) as integer) as ev_days_since_knowledge_date
from visible group by split_id, entity_id""")


def _over(how: str, column: str) -> str:
    return f"{how}({column}) over (partition by split_id)"


check("impute", f"""
select split_id, entity_id,
  round(coalesce(day_value, 0), 6) as as_zero,
  cast(case when day_value is null then 1 else 0 end as integer) as as_zero_impute_flag,
  round(coalesce(day_value, {_over('avg', 'day_value')}), 6) as as_mean,
  cast(case when day_value is null then 1 else 0 end as integer) as as_mean_impute_flag,
  round(coalesce(day_value, {_over('min', 'day_value')}), 6) as as_min,
  cast(coalesce(day_events, 100000000) as bigint) as as_inf,
  cast(case when day_events is null then 1 else 0 end as integer) as as_inf_impute_flag,
  cast(coalesce(day_events, {_over('max', 'day_events')}) as bigint) as as_max,
  cast(case when day_events is null then 1 else 0 end as integer) as as_max_impute_flag,
  round(coalesce(day_events, {_over('avg', 'day_events')}), 6) as as_avg
from cohort left join latest using (split_id, entity_id)""")
check("assemble_features", "select * from matrix")
check("union_splits", """
select case o_orderstatus when 'F' then 0 when 'O' then 1 else 2 end as split, o_orderkey, o_totalprice from orders
where o_orderstatus in ('F', 'O', 'P')""")
check("training_matrix", """
select split_id, entity_id, c_acctbal, day_value, events_sum_penalty_amount, events_days_since_event_date, label
from matrix join label_rows using (split_id, entity_id)""")

# ---------------------------------------------------------------- ranking and metrics

check("rank_baseline", """
select entity_id, n_chars, rank, round((n - rank)::double / (n - 1), 9) as probability,
       (n - rank)::double / (n - 1) > 0.5 as prediction
from (select *, row_number() over (order by n_chars desc, entity_id) as rank, count(*) over () as n from docs)""")
check("rank_baseline_asc", """
select entity_id, n_words, rank, round((n - rank)::double / (n - 1), 9) as probability,
       (n - rank)::double / (n - 1) > 0.5 as prediction
from (select *, row_number() over (order by n_words, entity_id) as rank, count(*) over () as n from docs)""")
check("top_k_flags", "select * from doc_flags")

_GRID = expand_grid(GRID)
_BUILDABLE = [m for m in _GRID if m.kind != "Classifier"]
check("fit_grid", " union all ".join(
    f"select '{m.model_id}' as model_id, '{m.model_class}' as model_class, "
    f"'{json.dumps(m.kwargs, sort_keys=True)}' as model_kwargs, {str(m in _BUILDABLE).lower()} as fitted "
    f"from documents having count(*) > 0" for m in _GRID))
check("score_models", " union all ".join(
    f"select '{m.model_id}' as model_id, count(*) as scored, count(distinct doc_id) as entities, "
    f"0::bigint as invalid from documents" for m in _BUILDABLE if not m.is_baseline))

check("fit_grid_many", " union all ".join(
    f"select '{m.model_id}' as model_id, count(*) as scored, 0::bigint as invalid from documents"
    for m in expand_grid(MANY_GRID)))

PARTS["long_rates"] = """
select is_long, avg(quality)::double as rate, count(*) as n
from (select doc_id, (n_chars >= 1500)::integer::double as is_long from documents) join labels using (doc_id) group by is_long"""
_NEEDS["long_rates"] = []
_LONG = "(select doc_id as entity_id, (n_chars >= 1500)::integer::double as is_long from documents) join long_rates using (is_long)"
check("logistic_model", f"select entity_id, 'LogisticRegression' as model, round(rate, 4) as probability from {_LONG}")
check("tree_model", f"""
select entity_id, 'DecisionTreeClassifier' as model, round(rate, 6) as probability from {_LONG} union all
select entity_id, 'GradientBoostingClassifier',
       round(1 / (1 + exp(-(ln(p / (1 - p)) + (rate - p) / (p * (1 - p))))), 6)
from {_LONG}, (select sum(rate * n) / sum(n) as p from long_rates)""")
def _boosted(score: str) -> str:
    """The score after a Newton step of rate 0.5 in the row's group."""
    return f"({score} + 0.5 * (rate - 1 / (1 + exp(-{score}))) * (1 + exp(-{score})) * (1 + exp({score})))"


check("boosting_rounds", f"""
select entity_id, n_estimators::bigint as n_estimators,
       round(1 / (1 + exp(-case when n_estimators = 2 then two else {_boosted("two")} end)), 6) as probability
from (select *, {_boosted("one")} as two from (select *, {_boosted("start")} as one from (
        select entity_id, rate, (select ln(sum(rate * n) / sum(n - rate * n)) from long_rates) as start from {_LONG}))),
     (select unnest([2, 3]) as n_estimators)""")
check("deep_tree_chain", """
with c as (select c_custkey, c_custkey % 2 as label, row_number() over (order by c_custkey) as place from customer)
select c_custkey as entity_id, c_custkey::double as x, max_depth::bigint as max_depth,
       round(case when place <= max_depth then label
                  else avg(label) over (partition by max_depth, place <= max_depth) end::double, 6) as probability
from c, (select unnest([3, 35, 50, 100]) as max_depth)""")
check("tree_best_threshold", """
with o as (
  select o_orderkey, o_totalprice::double as x, (o_orderpriority < '3')::integer as label from orders
), g as (
  select x, count(*) as n, sum(label) as p from o group by x
), sides as (
  select x, lead(x) over w as next, sum(n) over w as n, sum(p)::double over w as p, (select count(*) from o) as total,
         (select sum(label)::double from o) as positive from g window w as (order by x)
), best as (
  select x as highest, p / n as lower, (positive - p) / (total - n) as upper from sides where next is not null
  order by p * p / n + (positive - p) * (positive - p) / (total - n) desc, x limit 1
)
select o_orderkey as entity_id, x, 1::bigint as max_depth, round(case when x <= highest then lower else upper end, 6)
       as probability from o, best""".replace("sum(p)::double over w", "(sum(p) over w)::double"))
check("tree_full_depth", """
select l_quantity::double as x, 1::bigint as scores, round(avg((l_returnflag = 'R')::integer), 6) as probability
from lineitem group by l_quantity""")
check("tree_min_samples_split", """
with s as (select s_suppkey, (s_suppkey = 1)::integer::double as x, (s_suppkey % 3 = 1)::integer as label from supplier)
select s_suppkey as entity_id, x, null::bigint as max_depth, least_rows::bigint as min_samples_split,
       round(case when least_rows < 1000 then avg(label) over (partition by least_rows, x)
                  else avg(label) over (partition by least_rows) end, 6) as probability
from s, (select unnest([2, 10, 1000000000]) as least_rows)""")
check("forest_order", """
select is_long, 1::bigint as scores, rate = max(rate) over () as higher from long_rates""")
check("feature_importance", """
select 'LogisticRegression' as model, 'is_long' as feature, round(abs(sum(case is_long when 1 then 1 else -1 end
  * ln(rate / (1 - rate)))) * sqrt(product(n) / (sum(n) * (sum(n) - 1))), 3) as importance from long_rates union all
select unnest(['DecisionTreeClassifier', 'RandomForestClassifier', 'GradientBoostingClassifier']), 'is_long', 1.0::double
from documents having count(*) > 0""")


def _unpivot(names: list[str], source: str, ids: str) -> str:
    return " union all ".join(
        f"select {ids}, '{n.split('_at_')[0]}' as metric, '{n.split('_at_')[1]}' as k, "
        f"'{'float' if '.' in n else 'int'}' as k_type, round(\"{n}\", 6) as value from {source}" for n in names)


check("metrics_at_k", _unpivot([n for n, _ in _DOC_METRICS], "doc_metrics", "split_id, model_id, num_labeled_rows"))
check("results_table", f"""
select model_id, 'RankBaseline' as model_class,
  case model_id when 'by_n_chars' then '{{"column": "n_chars"}}' else '{{"column": "n_words"}}' end as model_kwargs,
  split_id, num_labeled_rows, {', '.join(f'round_even("{n}", 4) as "{n}"' for n, _ in _DOC_METRICS)}
from doc_metrics""")

# ---------------------------------------------------------------- analysis

check("results_over_time", " union all ".join(
    f"select model_id, model_class, split_date, '{m}' as metric, {m} as value from test_results"
    for m in ("precision_score_at_50", "num_labeled_samples_at_50")))


def _best(metric: str, criterion: str, n: int, least: int) -> str:
    def reduce(c: str) -> str:
        return {"min": f'min("{c}")', "average": f'avg("{c}")', "last": f'max_by("{c}", split_date)'}[criterion]

    support = f"num_labeled_samples_at_{metric.rsplit('_', 1)[-1]}"
    return f"""
select '{metric}' as metric, '{criterion}' as criterion, cast(position as integer) as position, model_id,
       round(value, 6) as value
from (select *, row_number() over (order by value desc, model_id) as position from (
  select model_id, case when {reduce(support)} < {least} then -1.0 else {reduce(metric)} end as value
  from test_results group by model_id))
where position <= {n}"""


check("select_best_models", _best("precision_score_at_50", "average", 2, 20))
check("select_best_models_multi", " union all ".join(
    _best(m, c, 2, 14) for m in ("precision_score_at_50", "recall_score_at_0.1")
    for c in ("min", "average", "last")))
check("baseline_models", "select distinct model_id from experiment_results where model_class = 'RankBaseline'")


def _crosstab(feature: str, source: str, flag: str, where: str = "true") -> str:
    c = f'"{feature}"'
    spread = f"(stddev_samp({c}) + 1e-12)"
    pos, neg = f'avg({c}) filter ("{flag}" = 1)', f'avg({c}) filter ("{flag}" = 0)'
    return f"""
select split_id, model_id, '{feature}' as feature, round({pos}, 6) as positive_mean, round({neg}, 6) as negative_mean,
  round(abs(({pos} - avg({c})) / {spread} - ({neg} - avg({c})) / {spread}), 6) as normalized_difference
from {source} where {where} group by split_id, model_id"""


check("crosstab", " union all ".join(
    _crosstab(f, "doc_flags join docs using (split_id, entity_id)", "prediction_at_0.1")
    for f in ("n_chars", "n_words", "n_lines")))


def _rate(metric: str, group: int, flag: str) -> str:
    mine = f"member = {group}"
    hits = f'sum(case when {mine} and "{flag}" = 1 and label = 1 then 1 else 0 end)::double'
    if metric == "tpr":
        return f"{hits} / nullif(sum(case when {mine} then label else 0 end), 0)"
    return f'1.0 - {hits} / nullif(sum(case when {mine} and "{flag}" = 1 then 1 else 0 end), 0)'


for _m in ("fdr", "tpr"):
    check("fairness_disparity" if _m == "fdr" else "fairness_disparity_tpr", f"""
select split_id, model_id, round(r1, 6) as {_m}_group1, round(r0, 6) as {_m}_group0, round(r1 / nullif(r0, 0), 6) as {_m}
from (select split_id, model_id, {_rate(_m, 1, 'prediction_at_0.1')} as r1, {_rate(_m, 0, 'prediction_at_0.1')} as r0
  from (select *, case when n_lines >= 20 then 1 else 0 end as member
        from doc_flags join docs using (split_id, entity_id) join doc_labels using (split_id, entity_id))
  group by split_id, model_id)""")

check("pr_curve", " union all ".join(
    f"select split_id, model_id, {k}::double as k, round(\"precision_score_at_{k}\", 6) as precision, "
    f"round(\"recall_score_at_{k}\", 6) as recall from doc_metrics" for k in ("0.01", "0.1", "1.0")))
check("pr_curve_int", """
select split_id, model_id, 50.0::double as k, round("precision_score_at_50", 6) as precision,
       round("recall_score_at_50", 6) as recall from doc_metrics""")
_FIRST = min(MODEL_IDS.values())
check("base_rate_series", f"""
select split_date, round("precision_score_at_1.0", 6) as base_rate,
       round(50.0::double / num_labeled_rows * "precision_score_at_1.0", 6) as scaled_rate
from test_results where model_id = '{_FIRST}'""")

_ALL_FEATURES = [c for n in ("day_events", "day_value") for c in (n, f"{n}_impute_flag")]
_ALL_FEATURES = (["c_acctbal", "c_nationkey", *_ALL_FEATURES] + [c for n in _SUMS for c in (n, f"{n}_impute_flag")]
                 + _AVGS + ["events_days_since_event_date", "events_days_since_event_date_impute_flag"])
_DISPLAY = {f: FEATURE_NAMES[f] for f in _ALL_FEATURES if f in FEATURE_NAMES}
_COLUMNS_SQL = "(select unnest([" + ", ".join(f"'{f}'" for f in _ALL_FEATURES) + "]) as feature)"
_TOP = f"""
select model_id, cast(position as integer) as position, feature,
  case feature {' '.join(f"when '{f}' then '{d}'" for f, d in _DISPLAY.items())} else feature end as display_name,
  importance
from (select *, row_number() over (partition by model_id order by importance desc, feature) as position from (
  select model_id, feature, case when feature = ranked then 1.0::double else 0.0::double end as importance
  from {_COLUMNS_SQL}, (select distinct model_id, json_extract_string(model_kwargs, '$.column') as ranked
                        from experiment_results)))
where position <= """
check("top_features", _TOP + "2")
check("importance_matrix", f"""
select feature, {', '.join(f"case when feature = '{c}' then 1.0::double else 0.0::double end as {c}" for c in MODEL_IDS)}
from {_COLUMNS_SQL} where exists (select 1 from experiment_results)""")

# ---------------------------------------------------------------- pipelines

check("run_preprocessing", _rollup("_f", "found_violation, citizen_complaint, penalty_amount"))
check("run_preprocessing_labels", _rollup("_f", "label"))
check("run_preprocessing_persisted", _rollup("_f", "label"))
check("run_preprocessing_reporting", _panel(_CUSTOMER_REPORTS, "entity_ids_f"))
check("run_steps_user_sql", """
select o_custkey, round(sum(o_totalprice), 2) as total from orders where o_orderstatus = 'O'
group by o_custkey having sum(o_totalprice) > 100000""")
check("write_read_table", """
select o_orderkey, case when o_orderstatus = 'F' then -o_totalprice else o_totalprice end as o_totalprice, o_orderstatus
from orders""")
check("run_experiment", "select * from experiment_results")
check("run_experiment_predictions", "select * from baseline_predictions")
_LAST = "split_id = 8"
check("run_analysis", " union all ".join([
    *[_crosstab(f, "baseline_predictions join matrix using (split_id, entity_id)", "prediction_at_50", _LAST)
      for f in ("events_sum_penalty_amount", "c_acctbal")],
    f"""select split_id, model_id, 'tpr' as feature, round(r1, 6), round(r0, 6), round(r1 / nullif(r0, 0), 6)
from (select split_id, model_id, {_rate('tpr', 1, 'prediction_at_50')} as r1, {_rate('tpr', 0, 'prediction_at_50')} as r0
  from (select *, case when c_acctbal >= 5000 then 1 else 0 end as member from baseline_predictions
        join matrix using (split_id, entity_id) join label_rows using (split_id, entity_id) where {_LAST})
  group by split_id, model_id)"""]))

# every table of the analysis
_OVER_TIME = " union all ".join(
    f"select model_id, model_class, split_date, '{m}' as metric, round({m}, 6) as value from test_results"
    for m in ("precision_score_at_50", "num_labeled_samples_at_50"))
check("run_analysis_results_over_time", _OVER_TIME)
check("run_analysis_best_models", _best("precision_score_at_50", "min", 2, 20))
check("run_analysis_best_results_over_time", f"""
select * from ({_OVER_TIME}) where model_id in (
  select model_id from ({_best("precision_score_at_50", "min", 2, 20)}))""")
check("run_analysis_base_rate", f"""
select split_date, round("precision_score_at_1.0", 6) as base_rate from test_results where model_id = '{_FIRST}'""")
check("run_analysis_pr_curve", " union all ".join(f"""
select 8 as split_id, model_id, {k}::double as k, round("precision_score_at_{k}", 6) as precision,
       round("recall_score_at_{k}", 6) as recall from test_results where repeat = 2""" for k in ("0.1", "1.0")))
check("run_analysis_top_features", _TOP + "12")
check("run_analysis_crosstab", """
select split_id, model_id, feature, round(positive_mean, 4) as positive_mean, round(negative_mean, 4) as negative_mean,
       round(normalized_difference, 4) as normalized_difference from (""" + " union all ".join(
    _crosstab(f, "baseline_predictions join matrix using (split_id, entity_id)", "prediction_at_50", _LAST)
    for f in _ALL_FEATURES) + ")")
for _m in ("fdr", "tpr"):
    check(f"run_analysis_disparity_{_m}", f"""
select d.*, model_class, round("precision_score_at_50", 6) as precision_score_at_50 from (
  select split_id, model_id, round(r1, 6) as {_m}_group1, round(r0, 6) as {_m}_group0, round(r1 / nullif(r0, 0), 6) as {_m}
  from (select split_id, model_id, {_rate(_m, 1, 'prediction_at_50')} as r1, {_rate(_m, 0, 'prediction_at_50')} as r0
    from (select *, case when c_acctbal >= 5000 then 1 else 0 end as member from baseline_predictions
          join matrix using (split_id, entity_id) join label_rows using (split_id, entity_id) where {_LAST})
    group by split_id, model_id)) d
join test_results using (model_id) where repeat = 2""")
