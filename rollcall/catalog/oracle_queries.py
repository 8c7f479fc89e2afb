"""SQL counterpart of every catalog query that SQL can express."""

from __future__ import annotations

import re

from rollcall.catalog import stated
from rollcall.catalog.oracle import metric_sql, metric_statement, statement, two_day_anchors
from rollcall.plans.metrics import METRICS

_PLACE = "city country region timezone has_missing_timezone:b"
_DESKS = "delivered_workstations:i allocated_workstations:i free_sharing_workstations:i"
_SITE_TAIL = (
    "net_workstation_area_sqm:f cost_per_workstation_month:f lease_expiry_date:d is_space_audited:b"
)
_DEPTS = "dept_l1 dept_l2 dept_l3 dept_l4"
_TAP = "emp_id workplace_code tower floor:i direction device_id tap_ts_utc:t"
_RESULT = "name category status value:f threshold:f"
_COUNTS = (
    "employee_days:i headcount_incumbent:i scheduled_office_days:i attendance_daily:i "
    "scheduled_attendance:i attendance_expected_days:i attendance_expected_met:i no_show_days:i "
    "leave_days:i travel_days:i assignment_days:i non_office_days:i post_exit_days:i "
    "pre_hire_days:i late_reported_tap_days:i"
)

# Models of the estate under the names the SQL relations have.
_RELATION_OF = {
    "hr_employee_snapshot": "raw_hr",
    "badge_taps": "raw_taps",
    "leave_requests": "raw_leave",
    "travel_bookings": "raw_travel",
    "workplace_dim": "raw_space",
    "dept_schedule": "raw_schedule",
    "stg_hr_employee_snapshot": "hr",
    "stg_badge_taps": "tap",
    "stg_leave_requests": "leave_",
    "stg_travel_bookings": "travel_",
    "stg_workplace_space": "space",
    "stg_workplace": "site",
    "stg_dept_schedule": "raw_schedule",
    "stg_city_primary_workplace": "main_site",
    "int_employee_scd2": "history",
    "int_leave_days": "leave_day",
    "int_travel_days": "travel_day",
    "int_tap_day": "tap_day",
    "int_employee_day": "emp_day",
    "dim_date": "calendar",
    "dim_employee": "dim_emp",
    "dim_workplace": "dim_site",
    "fct_attendance_daily": "attendance",
    "fct_workplace_capacity_daily": "capacity",
    "fct_floor_presence_hourly": "floor_hour",
}
_LAYER_OF = {"stg": "staging", "int": "intermediate", "dim": "marts", "fct": "marts"}


def _layer_counts() -> str:
    parts = [
        f"select '{_LAYER_OF.get(n.split('_')[0], 'raw')}' as layer, '{n}' as \"table\", "
        f'count(*) as "rows" from {r}'
        for n, r in _RELATION_OF.items()
    ]
    return " union all ".join(parts)


def _value(text: str) -> str:
    return text if text.lstrip("-").isdigit() else f"'{text}'"


def _tests(stated: str, relation_of) -> str:
    """One count for each stated test of a table."""
    parts = []
    for table, column, test, *rest in map(str.split, stated.strip().splitlines()):
        rel = relation_of(table)
        if test == "not_null":
            count = f"select count(*) from {rel} where {column} is null"
        elif test == "accepted_values":
            allowed = ", ".join(map(_value, rest[0].split(",")))
            count = f"select count(*) from {rel} where {column} not in ({allowed})"
        elif test == "unique":
            count = f"select count(*) from (select count(*) as n from {rel} where {column} is not null group by {column}) where n > 1"
        else:
            other, key = rest
            count = f"select count({column}) from {rel} anti join {relation_of(other)} o on o.{key} = {rel}.{column}"
        parts.append(f"select '{table}' as \"table\", '{column}' as \"column\", '{test}' as test, ({count}) as violations")
    return " union all ".join(parts)


def _contract_rows() -> str:
    """Counts of each stated contract rule over the derived feeds (types are declared, so uncast)."""
    parts = []

    def row(feed: str, column: str, rule: str, count: str) -> None:
        parts.append(f"select '{feed}' as feed, '{column}' as \"column\", '{rule}' as rule, ({count}) as violations")

    for feed, column, kind, null, domain, limits in map(str.split, stated.CONTRACT_COLUMNS.strip().splitlines()):
        held = f"select count(*) from {_RELATION_OF[feed]} where"
        kind = {"timestamp_ntz": "timestamp", "string": "varchar"}.get(kind, kind)
        row(feed, column, "type", f"{held} {column} is not null and try_cast({column} as {kind}) is null")
        if null == "-":
            row(feed, column, "not_null", f"{held} {column} is null")
        if domain != "-":
            row(feed, column, "domain", f"{held} {column} not in ({', '.join(map(_value, domain.split(',')))})")
        if limits != "-":
            row(feed, column, "range", f"{held} " + " or ".join(f"{column} {x}" for x in limits.split("|")))
    for feed, *keys in map(str.split, stated.GRAINS.strip().splitlines()):
        of = ", ".join(keys)
        count = f"select count(*) from (select {of} from {_RELATION_OF[feed]} group by {of} having count(*) > 1)"
        row(feed, "+".join(keys), "unique", count)
    return " union all ".join(parts)


def _audit() -> str:
    """Profile of the numeric columns of the two facts, next to literal claims and waivers."""
    claimed = [(c, m) for c, *of in map(str.split, stated.CLAIMS.strip().splitlines()) for m in of]
    waived = stated.WAIVED.split()
    claims = ", ".join(f"('{c}', '{m}')" for c, m in claimed)
    waivers = ", ".join(f"('{c}')" for c in waived)
    columns = {
        "fct_attendance_daily": [
            c.split(":")[0]
            for c in f"{_COUNTS} avg_span_minutes:f required_days_per_week:i".split()
        ],
        "fct_workplace_capacity_daily": (
            "delivered_workstations allocated_workstations free_sharing_workstations "
            "unallocated_workstations available_workstations cost_per_workstation_month "
            "net_workstation_area_sqm headcount_incumbent attendance_actual departments_present "
            "workstation_waste floating_headcount"
        ).split(),
    }
    stats = " union all ".join(
        f"select '{model}' as model, '{c}' as col, count(*) as n, count({c}) as filled, "
        f"min({c})::double as lowest, max({c})::double as highest from {_RELATION_OF[model]}"
        for model, names in columns.items()
        for c in names
        if c not in stated.KEYS.split()
    )
    return (
        f'select p.model, p.col as "column", n as "rows", filled as non_null, lowest, highest, '
        f"count(k.m) as claims, case when count(k.m) > 0 then 'claimed' when count(w.c) > 0 "
        f"then 'waived' else 'unclaimed' end as cover from ({stats}) p "
        f"left join (values {claims}) as k(c, m) on k.c = p.model || '.' || p.col "
        f"left join (values {waivers}) as w(c) on w.c = p.model || '.' || p.col group by all"
    )


def _headlines() -> str:
    return " union all ".join(
        f"select '{m.name}' as metric, '{m.headline_grain}' as grain, "
        f"(select round(avg({m.name}), 4) from ({metric_sql(m.name, (), m.headline_grain)})) as value"
        for m in METRICS.values()
    )


_ORDERS_CONTRACT = """
select 'orders' as feed, * from (values
  ('o_orderkey', 'type', 0::bigint),
  ('o_orderkey', 'not_null', (select count(*) from orders where o_orderkey is null)),
  ('o_orderkey', 'range', (select count(*) from orders where o_orderkey <= 99)),
  ('o_custkey', 'type', 0),
  ('o_custkey', 'not_null', (select count(*) from orders where o_custkey is null)),
  ('o_custkey', 'range', (select count(*) from orders where o_custkey not between 10 and 100)),
  ('o_orderstatus', 'type', 0),
  ('o_orderstatus', 'not_null', (select count(*) from orders where o_orderstatus is null)),
  ('o_orderstatus', 'domain', (select count(*) from orders where o_orderstatus = 'P')),
  ('o_totalprice', 'type', 0),
  ('o_totalprice', 'not_null', (select count(*) from orders where o_totalprice is null)),
  ('o_totalprice', 'range', (select count(*) from orders where o_totalprice <= 1000)),
  ('o_orderpriority', 'type', (select count(o_orderpriority) from orders)),
  ('o_orderpriority', 'not_null', (select count(*) from orders where o_orderpriority is null)),
  ('o_clerk', 'missing', 1),
  ('o_orderdate', 'unexpected', 1),
  ('o_custkey+o_orderstatus', 'unique', (select count(*) from (
     select 1 from orders group by o_custkey, o_orderstatus having count(*) > 1)))
) as v("column", rule, violations)
"""

_RULES = """
select 'attendance_within_population' as rule, (select count(*) from attendance
    where attendance_daily > employee_days or scheduled_attendance > scheduled_office_days
       or headcount_incumbent > employee_days or scheduled_attendance > attendance_daily)
    as violations
union all select 'employee_day_state_is_consistent', (select count(*) from emp_day
    where state_rule_id is null or employee_day_state is null
       or (state_rule_id = 3 and not is_on_leave) or (state_rule_id = 5 and not is_on_assignment)
       or (state_rule_id = 4 and not is_on_travel) or (state_rule_id = 7 and not attended_flag)
       or (state_rule_id = 8 and (attended_flag or not is_scheduled_office_day))
       or (state_rule_id = 1 and employment_status_effective <> 'terminated'))
union all select 'supply_identity_holds', (select count(*) from capacity
    where delivered_workstations - allocated_workstations <> unallocated_workstations
       or available_workstations - attendance_actual <> workstation_waste
       or available_workstations - allocated_workstations
          <> case region when 'CN' then 0 else free_sharing_workstations end
       or allocated_workstations > delivered_workstations)
union all select 'workplace_attributes_agree', (select count(*) from (
    select workplace_code from space group by workplace_code
    having count(distinct city) > 1 or count(distinct region) > 1
        or count(distinct timezone) > 1 or count(distinct cost_per_workstation_month) > 1))
union all select 'fact_grain_is_unique', (select count(*) from repeats_ where n > 0)
"""

_GATES = """
select 'employee_day_grain' as gate, (select n from repeats_ where model = 'int_employee_day')
    as violations
union all select 'attendance_within_population', (select count(*) from attendance
    where attendance_expected_met > attendance_expected_days or attendance_daily > employee_days)
union all select 'supply_identity', (select count(*) from capacity
    where workstation_waste + attendance_actual <> available_workstations
       or allocated_workstations + unallocated_workstations <> delivered_workstations)
"""



def _planted(sql: str) -> str:
    """The same statement over the tables with planted faults."""
    return re.sub(r"\b(from) (attendance|emp_day|capacity|space|repeats_)\b", _bad_name, sql)


def _bad_name(found: re.Match) -> str:
    return f"{found[1]} {found[2].rstrip('_')}_bad"


_FRESHNESS_PLANTED = """
select 'freshness_' || feed as name, 'freshness' as category,
       case when late is null or late >= sla then 'fail' when 4 * late >= 3 * sla then 'warn' else 'pass' end as status,
       late as value, if(late is null, null, sla) as threshold
from (
    select 'hr_employee_snapshot' as feed, 26 as sla, 0 as late
    union all select 'badge_taps', 50, (select 24 * min(l.d - ingested_date) filter (l.d - ingested_date >= 2)
        from raw_taps, (select max(snapshot_date) as d from raw_hr) l)
    union all select 'leave_requests', 26, (select 24 * min(l.d - applied_ts::date) filter (l.d - applied_ts::date >= 5)
        from raw_leave, (select max(snapshot_date) as d from raw_hr) l)
    union all select 'travel_bookings', 26, (select 24 * min(l.d - depart_date) filter (l.d - depart_date >= 1)
        from raw_travel, (select max(snapshot_date) as d from raw_hr) l)
    union all select 'workplace_dim', 168, null
)
"""
# Every site of a fact is known (q_dq_integrity), so the rows of the planted days are the orphans.
_INTEGRITY_PLANTED = """
select 'integrity_' || what as name, 'referential_integrity' as category,
       if(n = 0, 'pass', 'fail') as status, n as value, 0 as threshold
from (
    select 'fct_attendance_daily_workplace_code' as what,
           count(*) filter (day(local_date) in (2, 10)) as n from attendance
    union all select 'fct_attendance_daily_local_date', count(*) filter (day(local_date) = 14) from attendance
    union all select 'fct_workplace_capacity_daily_workplace_code',
           count(*) filter (day(local_date) in (3, 11)) from capacity
    union all select 'fct_floor_presence_hourly_workplace_code',
           count(*) filter (day(local_date) in (4, 12)) from floor_hour
)
"""
_CONTRACT_LANDED = """
select * from (
    select 'leave_requests' as feed, c as "column", r as rule, (select coalesce(sum(w) filter (case r
             when 'not_null' then c = 'emp_id' and k % 89 = 3
             when 'domain' then c = 'leave_type' and k % 41 = 1
             when 'type' then c = 'start_date' and k % 97 = 5 end), 0)
        from (select cast(substr(leave_id, 2) as bigint) as k,
                     case when k % 106 = 2 then 3 when k % 53 = 2 then 2 else 1 end as w
              from raw_leave)) as violations
    from (values ('leave_id', 'type'), ('leave_id', 'not_null'), ('emp_id', 'type'),
          ('emp_id', 'not_null'), ('leave_type', 'type'), ('leave_type', 'not_null'),
          ('leave_type', 'domain'), ('start_date', 'type'), ('start_date', 'not_null'),
          ('end_date', 'type'), ('end_date', 'not_null'), ('applied_ts', 'type'),
          ('applied_ts', 'not_null')) as v(c, r)
    union all select 'leave_requests', 'status', 'missing', 1
    union all select 'leave_requests', 'note', 'unexpected', 1
    union all select 'leave_requests', 'leave_id', 'unique',
        (select count(*) from raw_leave where cast(substr(leave_id, 2) as bigint) % 53 = 2)
    union all select 'workplace_dim', 'timezone', 'missing', 1
    union all select 'workplace_dim', 'floor', 'range',
        (select count(*) from raw_space where floor = 1)
    union all select 'workplace_dim', c, r, 0
    from (values ('workplace_code'), ('name'), ('city'), ('country'), ('region'), ('tower'), ('floor'),
          ('delivered_workstations'), ('allocated_workstations'), ('free_sharing_workstations'),
          ('net_workstation_area_sqm'), ('cost_per_workstation_month'), ('lease_expiry_date'),
          ('is_space_audited')) as v(c), (values ('type'), ('not_null')) as w(r)
    union all select 'workplace_dim', c, r, 0
    from (values ('region', 'domain'), ('delivered_workstations', 'range'),
          ('allocated_workstations', 'range'), ('free_sharing_workstations', 'range'),
          ('net_workstation_area_sqm', 'range'), ('cost_per_workstation_month', 'range'),
          ('workplace_code+tower+floor', 'unique')) as v(c, r)
)
"""

_RECALL = """
select defect, injected, detected_by, detected, detected > 0 as caught,
       detected = injected as exact
from (
    select 'leavers still reported active' as defect, 'active_after_termination' as detected_by,
           (select count(distinct c_custkey) from staff_day
            where snapshot_date > term_date and c_custkey % 4 = 1) as injected,
           (select count(distinct emp_id) from hr where is_post_exit
            and employment_status_reported = 'active') as detected
    union all
    select 'snapshot rows before the hire date', 'snapshot_before_hire_date',
           (select count(*) from staff_day where snapshot_date < hire_date
            and if(snapshot_date > term_date, c_custkey % 4 = 1, c_custkey % 5 = 2)),
           (select count(*) from hr where is_pre_hire and employment_status_reported = 'active')
    union all
    select 'sites without a time zone', 'missing_workplace_timezone',
           (select count(*) from supplier where s_suppkey % 17 = 3),
           (select count(*) from site where has_missing_timezone)
    union all
    select 'people badging after termination', 'tap_after_termination',
           (select count(distinct user_id) from events join staff_ on c_custkey = user_id
            where event_id % 101 <> 7 and ts::date > term_date),
           (select count(distinct emp_id) from late_badges)
)
"""

_SAMPLES = """
select * from (
    select 'active_after_termination' as "check", emp_id, count(*) as "rows" from hr
    where is_post_exit and employment_status_reported = 'active'
    group by emp_id order by 3 desc, 2 limit 10)
union all
select * from (
    select 'tap_after_termination', emp_id, count(*) from late_badges
    where business_date > term_date + 7 group by emp_id order by 3 desc, 2 limit 10)
"""

_LADDER = """
select region, sum(delivered) as delivered, sum(allocated) as allocated,
       sum(available) as available, sum(peak) as peak_attendance, sum(typical) as mean_attendance
from (
    select region, workplace_code, max(delivered_workstations) as delivered,
           max(allocated_workstations) as allocated, max(available_workstations) as available,
           max(if(is_weekend, null, attendance_actual)) as peak,
           avg(if(is_weekend, null, attendance_actual)) as typical
    from capacity group by all
) group by region
"""

_COMPOSITION = """
select local_date, sum((state_rule_id = 7)::int) as attended,
       sum((state_rule_id = 8)::int) as no_show, sum((state_rule_id = 6)::int) as not_scheduled,
       sum((state_rule_id in (3, 4, 5))::int) as excused,
       sum((state_rule_id <= 2)::int) as not_employed
from emp_day group by local_date
"""

_RECOVERY = (
    "select m.region, realised_rate as planted, attendance_rate as recovered, "
    "abs(attendance_rate - realised_rate) as abs_error "
    f"from ({metric_sql('attendance_rate', ('region',), None)}) m "
    "left join realised r on r.region = m.region"
)

_ROUNDTRIP = """
select 'hr_employee_snapshot' as feed, count(*) as "rows", count(distinct snapshot_date) as days
from raw_hr
union all select 'badge_taps', count(*), count(distinct tap_ts_utc::date) from raw_taps
union all select 'leave_requests', count(*), 0 from raw_leave
union all select 'travel_bookings', count(*), 0 from raw_travel
union all select 'workplace_dim', count(*), 0 from raw_space
union all select 'dept_schedule', count(*), 0 from raw_schedule
"""

_LANDED = """
select 'hr_employee_snapshot' as feed, count(*) as "rows",
       count(distinct snapshot_date) as partitions, partitions as partitions_validated from raw_hr
union all select 'badge_taps', count(*), count(distinct tap_ts_utc::date) as p, p from raw_taps
union all select 'leave_requests', count(*), 1, 1 from raw_leave
union all select 'travel_bookings', count(*), 1, 1 from raw_travel
union all select 'workplace_dim', count(*), 1, 1 from raw_space
union all select 'dept_schedule', count(*), 1, 1 from raw_schedule
"""

# Days with a null, a value outside its domain, or each row twice; a day of taps; a column lost and one added.
_LANDED_PLANTED = """
select 'hr_employee_snapshot' as feed, count(*) + count(*) filter (snapshot_date = s + 7) as "rows",
       count(distinct snapshot_date) as partitions,
       count(distinct snapshot_date) filter (snapshot_date not in (s + 3, s + 5, s + 7)) as partitions_validated,
       count(*) filter (snapshot_date in (s + 3, s + 5, s + 7)) as violations
from raw_hr, (select min(snapshot_date) as s from raw_hr) group by all
union all
select 'badge_taps', count(*), count(distinct tap_ts_utc::date),
       count(distinct tap_ts_utc::date) filter (tap_ts_utc::date <> s + 9), count(*) filter (tap_ts_utc::date = s + 9)
from raw_taps, (select min(snapshot_date) as s from raw_hr)
union all select 'travel_bookings', count(*), 1, 1, 0 from raw_travel
union all select 'workplace_dim', count(*), 1, 0, 2 from raw_space
"""

# Facts with a day of repeats, a day of unknown sites, one of none, and (attendance) a day a century late.
_SAMPLES_PLANTED = """
with a as (
    select if(day(local_date) = 14, local_date + 36525, local_date) as local_date, dept_l2,
           case when day(local_date) = 2 then 'NOWHERE' when day(local_date) <> 10 then workplace_code end as site
    from (select * from attendance union all select * from attendance where day(local_date) = 9)
),
c as (
    select local_date, case when day(local_date) = 3 then 'NOWHERE' when day(local_date) <> 11 then workplace_code end as site
    from (select * from capacity union all select * from capacity where day(local_date) = 9)
),
f as (
    select local_date, tower, floor, local_hour,
           case when day(local_date) = 4 then 'NOWHERE' when day(local_date) <> 12 then workplace_code end as site
    from (select * from floor_hour union all select * from floor_hour where day(local_date) = 9)
),
d as (select * from emp_day union all select * from emp_day where day(local_date) = 11),
bad as (
    select 'integrity_fct_attendance_daily_workplace_code' as what, coalesce(site, '') as key, count(*) as n
    from a where site is null or site = 'NOWHERE' group by all
    union all select 'integrity_fct_attendance_daily_local_date', local_date::varchar, count(*) from a
    where local_date >= date '2100-01-01' group by all
    union all select 'integrity_fct_workplace_capacity_daily_workplace_code', coalesce(site, ''), count(*)
    from c where site is null or site = 'NOWHERE' group by all
    union all select 'integrity_fct_floor_presence_hourly_workplace_code', coalesce(site, ''), count(*)
    from f where site is null or site = 'NOWHERE' group by all
    union all select 'grain_int_employee_day', emp_id || '|' || local_date, count(*) from d group by all having count(*) > 1
    union all select 'grain_fct_attendance_daily', local_date || '|' || coalesce(site, '') || '|' || dept_l2, count(*)
    from a group by all having count(*) > 1
    union all select 'grain_fct_workplace_capacity_daily', local_date || '|' || coalesce(site, ''), count(*)
    from c group by all having count(*) > 1
    union all select 'grain_fct_floor_presence_hourly',
        local_date || '|' || coalesce(site, '') || '|' || tower || '|' || floor || '|' || local_hour, count(*)
    from f group by all having count(*) > 1
    union all select 'active_after_termination', emp_id || '|' || term_date, count(*) from hr
    where is_post_exit and employment_status_reported = 'active' group by all
    union all select 'snapshot_before_hire_date', emp_id || '|' || hire_date || '|' || snapshot_date, 1 from hr
    where is_pre_hire and employment_status_reported = 'active'
    union all select 'tap_after_termination', emp_id || '|' || term_date, count(*) from late_badges
    where business_date > term_date + 7 group by all
    union all select 'missing_workplace_timezone', workplace_code, delivered_workstations from dim_site
    where has_missing_timezone
)
select what as "check", position, key, n as "rows"
from (select *, row_number() over (partition by what order by n desc, key) as position from bad) where position <= 10
"""

# With one rate before the latest days there are no edges to compare between.
_DRIFT_PLANTED = """
select 'attendance_rate_drift' as name, 'distribution_drift' as category, 'warn' as status, null as value,
       null as threshold, (select count(*) from (
           select 1 from attendance where city is not null group by local_date, city
           having sum(attendance_expected_days) between 1 and 19)) as left_out
"""

_DETAILS = """
select 'active_after_termination' as name, m as measure, n as amount
from (select count(distinct (emp_id, term_date)) as people, count(*) as n_rows from hr
      where is_post_exit and employment_status_reported = 'active'),
     lateral (values ('employees', people), ('rows', n_rows)) as v(m, n)
union all
select 'tap_after_termination', m, n
from (select count(*) as taps, count(distinct emp_id) as people from late_badges),
     lateral (values ('taps_after_termination_any', taps), ('employees_after_termination_any', people),
                     ('grace_days', 7)) as v(m, n)
union all
select 'missing_workplace_timezone', 'desks', coalesce(sum(delivered_workstations), 0) from dim_site where has_missing_timezone
union all
select 'attendance_rate_drift', m, n
from (select (select count(distinct local_date) from rates) as days, coalesce(len(base), 0) as earlier, coalesce(len(late), 0) as latest from split_),
     lateral (values ('days_available', days), ('recent_days', least(28, days // 2)), ('baseline_observations', earlier),
         ('buckets', least(10, greatest(least(earlier, latest) // 8, 2))), ('city_days_left_out', (select count(*) from (
             select 1 from attendance where city is not null group by local_date, city
             having sum(attendance_expected_days) between 1 and 19)))) as v(m, n)
union all
select 'reconcile_' || w, m, n
from (values ('attendance_count', (select count(*) from (select distinct emp_id, business_date from tap)),
              (select sum(attendance_daily) from attendance)),
             ('headcount_days', (select count(*) from hr where not (is_post_exit or is_pre_hire)),
              (select sum(headcount_incumbent) from attendance)),
             ('delivered_workstations', (select sum(delivered_workstations) from space),
              (select sum(delivered_workstations) from dim_site))) as p(w, a, b),
     lateral (values ('staging', a), ('marts', b)) as v(m, n)
union all
select 'volume_' || feed, 'peers', count(*) filter (d < last and isodow(d) = isodow(last))
from (select *, max(d) over (partition by feed) as last from daily_volume) group by feed
"""

_FINDINGS = """
select 'malformed_claim' as finding, 'fct_attendance_daily' as model, '' as "column", null as "rows", null as non_null
union all select 'unknown_model', 'fct_badges', 'taps', null, null
union all select 'missing_column', 'fct_attendance_daily', 'overtime_days', null, null
union all select 'waiver_without_owner', 'fct_attendance_daily', 'leave_days', count(*), count(leave_days) from attendance
union all select 'waiver_without_reason', 'fct_attendance_daily', 'travel_days', count(*), count(travel_days) from attendance
union all select 'stale_waiver', 'fct_workplace_capacity_daily', 'seats', null, null
union all select 'unclaimed_measure', 'fct_workplace_capacity_daily', 'floating_headcount', count(*),
    count(floating_headcount) from capacity
"""

_TESTS_PLANTED = """
select 'orders' as "table", c as "column", t as test, n as violations
from (select count(*) filter (o_orderkey % 11 = 4) as keys, count(*) filter (o_orderkey % 7 = 3) as owners from orders),
     lateral (values ('o_orderkey', 'not_null', keys), ('o_custkey', 'not_null', owners),
                     ('o_orderkey', 'unique', 0), ('o_custkey', 'relationships', 0)) as v(c, t, n)
"""

_DATES = """
select date_day, year(date_day) as year, month(date_day) as month, day(date_day) as day_of_month,
       dayofweek(date_day) as day_of_week_sun0, weekday_mon0,
       weekofyear(date_day) as iso_week, iso_year_week, is_weekend, dayname(date_day) as day_name
from calendar
"""

# Days that late taps of two days and leave from the second of them bear on: four back to three ahead, or a leave's own.
_AFFECTED = """
select distinct d as day from (
    select unnest(generate_series(u - 3, u + 4, interval 1 day))::date as d
    from (select distinct tap_ts_utc::date as u from raw_taps where ingested_date > tap_ts_utc::date),
         (select min(snapshot_date) as s from raw_hr)
    where u between s + 13 and s + 14
    union all
    select unnest(generate_series(start_date, least(end_date, hi + 1), interval 1 day))::date
    from raw_leave, (select min(snapshot_date) as s,
        greatest(max(snapshot_date), (select max(tap_ts_utc)::date from raw_taps)) as hi from raw_hr)
    where start_date = s + 14 and start_date <= end_date
)
"""
_FIRST = "(select min(snapshot_date) from raw_hr)"
_WEEK = f"local_date between {_FIRST} + 9 and {_FIRST} + 15"

ORACLES: dict[str, str] = {
    "q_workplace_space": statement(
        f"workplace_code workplace_name {_PLACE} tower floor:i {_DESKS} {_SITE_TAIL}", "space"
    ),
    "q_workplace_rollup": statement(
        f"workplace_code workplace_name {_PLACE} floor_count:i tower_count:i {_DESKS} {_SITE_TAIL}",
        "site",
    ),
    "q_city_primary": statement("city region primary_workplace_code", "main_site"),
    "q_dim_workplace": statement(
        f"workplace_code workplace_name {_PLACE} is_china_region:b tower_count:i floor_count:i "
        f"{_DESKS} unallocated_workstations:i available_workstations:i sqm_per_workstation:f "
        f"{_SITE_TAIL}",
        "dim_site",
    ),
    "q_taps_localised": statement(
        "emp_id workplace_code direction device_id tap_ts_utc:t timezone tap_ts_local:t",
        "tap_local",
    ),
    "q_taps_deduped": statement(f"{_TAP} ingested_date:d", "tap_kept"),
    "q_taps_business_day": statement(
        f"{_TAP} tap_ts_local:t local_date:d business_date:d local_hour:i ingested_date:d timezone "
        "city region has_missing_timezone:b is_overnight_tap:b is_late_reported:b",
        "tap",
    ),
    "q_unknown_site_taps": statement(
        "workplace_code taps:i",
        "select workplace_code, count(*) as taps from raw_taps where workplace_code not in "
        "(select workplace_code from site) group by all",
    ),
    "q_tap_day": statement(
        "emp_id local_date:d first_tap_ts:t last_tap_ts:t first_tap_ts_utc:t last_tap_ts_utc:t "
        "tap_count:i workplace_count:i tap_workplace tap_city tap_region tower_first tower_last "
        "floor_first:i floor_last:i span_minutes:i has_late_reported_tap:b has_missing_timezone:b "
        "has_overnight_tap:b",
        "tap_day",
    ),
    "q_floor_hourly": statement(
        "local_date:d workplace_code tower floor:i local_hour:i tap_events:i employees_seen:i "
        "tap_ins:i tap_outs:i",
        "floor_hour",
    ),
    "q_hr_typed": statement(
        "snapshot_date:d emp_id employment_status_reported hire_date:d term_date:d badge_type "
        f"employee_type {_DEPTS} base_city theory_workplace manager_id assignment_city "
        "employment_status_derived is_post_exit:b is_pre_hire:b",
        "hr",
    ),
    "q_scd2": statement(
        "emp_id version_number:i valid_from:d valid_to:d snapshot_days:i is_current:b "
        "employment_status_reported hire_date:d term_date:d badge_type employee_type "
        f"{_DEPTS} base_city theory_workplace manager_id assignment_city",
        "history",
    ),
    "q_dim_employee": statement(
        "emp_id version_number:i valid_from:d valid_to:d employment_status_reported hire_date:d "
        f"term_date:d badge_type employee_type {_DEPTS} base_city theory_workplace manager_id "
        "assignment_city theory_city theory_region theory_country has_missing_base_city:b",
        "dim_emp",
    ),
    "q_leave_staged": statement(
        "leave_id emp_id leave_type start_date:d end_date:d status applied_ts:t is_effective:b "
        "is_retro_applied:b duration_days:i",
        "leave_",
    ),
    "q_leave_days": statement(
        "emp_id leave_date:d leave_type leave_id is_retro_applied:b", "leave_day"
    ),
    "q_travel_staged": statement(
        "booking_id emp_id origin_city destination_city depart_date:d return_date:d "
        "booking_status hotel_flag:b flight_flag:b is_effective:b trip_days:i",
        "travel_",
    ),
    "q_travel_days": statement(
        "emp_id travel_date:d destination_city origin_city booking_id destination_workplace_code",
        "travel_day",
    ),
    "q_schedule": statement(
        "dept_l2 dept_l1 weekday:i is_scheduled_office_day:b required_days_per_week:i "
        "policy_version",
        "raw_schedule",
    ),
    "q_population_spine": statement(
        "c_custkey:i visible_days:i first_day:d last_day:d",
        "select c_custkey, count(*) as visible_days, min(snapshot_date) as first_day, "
        "max(snapshot_date) as last_day from staff_day group by all",
    ),
    "q_employee_day": statement(
        f"emp_id local_date:d {_DEPTS} employee_type badge_type manager_id base_city hire_date:d "
        "term_date:d employment_status_reported employment_status_effective assignment_city "
        "expected_workplace theory_workplace is_scheduled_office_day:b is_attendance_expected:b "
        "required_days_per_week:i is_on_leave:b leave_type is_on_travel:b destination_city "
        "is_on_assignment:b attended_flag:b first_tap_ts:t last_tap_ts:t tap_workplace tap_city "
        "tap_region tower_first tower_last floor_first:i floor_last:i tap_count:i "
        "workplace_count:i span_minutes:i has_late_reported_tap:b state_rule_id:i "
        "employee_day_state is_incumbent:b",
        "emp_day",
    ),
    "q_state_counts": statement(
        "local_date:d employee_day_state employee_days:i",
        "select local_date, employee_day_state, count(*) as employee_days from emp_day group by all",
    ),
    "q_state_composition": statement(
        "local_date:d attended:i no_show:i not_scheduled:i excused:i not_employed:i", _COMPOSITION
    ),
    "q_dim_date": statement(
        "date_day:d year:i month:i day_of_month:i day_of_week_sun0:i weekday_mon0:i iso_week:i "
        "iso_year_week is_weekend:b day_name",
        _DATES,
    ),
    "q_attendance_daily_fact": statement(
        f"local_date:d iso_year_week workplace_code city region dept_l1 dept_l2 {_COUNTS} "
        "avg_span_minutes:f required_days_per_week:i",
        "attendance",
    ),
    "q_capacity_daily_fact": statement(
        "local_date:d workplace_code city region is_china_region:b is_weekend:b iso_year_week "
        f"{_DESKS} unallocated_workstations:i available_workstations:i "
        "cost_per_workstation_month:f net_workstation_area_sqm:f headcount_incumbent:i "
        "attendance_actual:i departments_present:i workstation_waste:i floating_headcount:i",
        "capacity",
    ),
    **{
        f"q_metric_{m.name}": metric_statement(m.name, ("region",), m.headline_grain)
        for m in METRICS.values()
    },
    "q_metric_day_grain": metric_statement("workstation_waste", ("city", "local_date"), "day"),
    "q_metric_no_dims": metric_statement("attendance_rate", (), "month"),
    "q_metric_by_site": metric_statement(
        "waste_ratio", ("workplace_code", "iso_year_week"), "week"
    ),
    "q_metric_by_department": metric_statement("attendance_rate", ("dept_l1", "dept_l2"), None),
    "q_metric_all_week_filter_off": metric_statement(
        "attendance_daily", ("region", "is_weekend"), "week", weekdays=False
    ),
    "q_metric_caller_filter": metric_statement(
        "headcount_incumbent", ("city",), "month", where="region in ('CN', 'AMER')"
    ),
    "q_metric_composite_no_keys": metric_statement("seat_demand_rate", (), None),
    "q_metric_composite_own_filter": metric_statement(
        "seat_demand_absolute", ("city",), "month", weekdays=True
    ),
    "q_metric_headlines": statement("metric grain value:f", _headlines()),
    "q_rule_violations": statement("rule violations:i", _RULES),
    "q_gates": statement("gate violations:i", _GATES),
    "q_rules_planted": statement("rule violations:i", _planted(_RULES)),
    "q_gates_planted": statement("gate violations:i", _planted(_GATES)),
    "q_dq_grain_planted": statement(
        _RESULT,
        "select 'grain_' || model as name, 'grain_uniqueness' as category, "
        "if(n = 0, 'pass', 'fail') as status, n as value, 0 as threshold from repeats_bad",
    ),
    "q_dq_freshness_planted": statement(_RESULT, _FRESHNESS_PLANTED),
    "q_dq_integrity_planted": statement(_RESULT, _INTEGRITY_PLANTED),
    "q_contract_landed": statement('feed "column" rule violations:i', _CONTRACT_LANDED),
    "q_contract_violations": statement('feed "column" rule violations:i', _contract_rows()),
    "q_contract_orders": statement('feed "column" rule violations:i', _ORDERS_CONTRACT),
    "q_generic_tests": statement(
        '"table" "column" test violations:i', _tests(stated.TESTS, _RELATION_OF.__getitem__)
    ),
    "q_generic_tests_retail": statement(
        '"table" "column" test violations:i', _tests(stated.RETAIL_TESTS, str)
    ),
    "q_dq_freshness": statement(_RESULT, "checks_freshness"),
    "q_dq_integrity": statement(_RESULT, "checks_integrity"),
    "q_dq_grain": statement(_RESULT, "checks_grain"),
    "q_dq_legality": statement(_RESULT, "checks_legality"),
    "q_dq_psi": statement(_RESULT, "checks_psi"),
    "q_dq_reconcile": statement(_RESULT, "checks_reconcile"),
    "q_dq_volume": statement(_RESULT, "checks_volume"),
    "q_dq_samples": statement('"check" emp_id "rows":i', _SAMPLES),
    "q_dq_samples_planted": statement('"check" position:i key "rows":i', _SAMPLES_PLANTED),
    "q_dq_drift_planted": statement(f"{_RESULT} left_out:f", _DRIFT_PLANTED),
    "q_dq_details": statement("name measure amount:f", _DETAILS),
    "q_audit_findings": statement('finding model "column" "rows":i non_null:i', _FINDINGS),
    "q_metric_ordered": statement(
        "period:d city region attendance_daily:f position:i",
        "select *, row_number() over (order by period, city, region) as position from "
        f"({metric_sql('attendance_daily', ('city', 'region'), 'day')})",
    ),
    "q_table_tests_planted": statement('"table" "column" test violations:i', _TESTS_PLANTED),
    "q_scorecard": statement(
        f"{_RESULT} verdict owner review_by:d is_overdue:b",
        "select *, review_by < date '2025-09-01' as is_overdue from card",
    ),
    "q_scorecard_summary": statement(
        "n_pass:i n_warn:i n_fail:i unexpected:i expected:i stale:i worst passed:b",
        "select count_if(status = 'pass') as n_pass, count_if(status = 'warn') as n_warn, "
        "count_if(status = 'fail') as n_fail, count_if(verdict = 'unexpected') as unexpected, "
        "count_if(verdict = 'expected') as expected, count_if(verdict = 'stale') as stale, "
        "case when count_if(status = 'fail') > 0 then 'fail' when count_if(status = 'warn') > 0 "
        "then 'warn' else 'pass' end as worst, "
        "count_if(verdict in ('unexpected', 'stale')) = 0 as passed from card",
    ),
    "q_scorecard_by_category": statement(
        "category checks:i n_pass:i n_warn:i n_fail:i",
        "select category, count(*) as checks, count_if(status = 'pass') as n_pass, "
        "count_if(status = 'warn') as n_warn, count_if(status = 'fail') as n_fail "
        "from checks group by all",
    ),
    "q_recall": statement("defect injected:i detected_by detected:i caught:b exact:b", _RECALL),
    "q_supply_ladder": statement(
        "region delivered:i allocated:i available:i peak_attendance:i mean_attendance:f", _LADDER
    ),
    "q_realised_rates": statement("region owed_days:i met_days:i realised_rate:f", "realised"),
    "q_recovery": statement("region planted:f recovered:f abs_error:f", _RECOVERY),
    "q_layer_counts": statement('layer "table" "rows":i', _layer_counts()),
    "q_measure_audit": statement(
        'model "column" "rows":i non_null:i lowest:f highest:f claims:i cover', _audit()
    ),
    "q_partitioned_roundtrip": statement('feed "rows":i days:i', _ROUNDTRIP),
    "q_landed_days": statement(
        'feed "rows":i partitions:i partitions_validated:i', _LANDED
    ),
    "q_landed_days_planted": statement(
        'feed "rows":i partitions:i partitions_validated:i violations:i', _LANDED_PLANTED
    ),
    "q_day_range_rate": two_day_anchors(
        metric_statement("attendance_rate", ("region",), "week", where=_WEEK)
    ),
    "q_day_range_waste": two_day_anchors(
        metric_statement("waste_ratio", ("city",), "week", where=_WEEK)
    ),
    "q_affected_days": statement("day:d", _AFFECTED),
}
# A refresh must give what a build of everything gives.
for _name, _whole in (
    ("q_day_refresh", "q_attendance_daily_fact"),
    ("q_day_refresh_capacity", "q_capacity_daily_fact"),
    ("q_day_refresh_floors", "q_floor_hourly"),
):
    ORACLES[_name] = two_day_anchors(ORACLES[_whole])
