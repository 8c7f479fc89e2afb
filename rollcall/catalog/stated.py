"""What the SQL side expects of feeds and tables, written out by itself rather than taken from the plans."""

from __future__ import annotations

# Feed, column, type, "null" where allowed, closed domain, and the condition that breaks its range.
CONTRACT_COLUMNS = """
hr_employee_snapshot snapshot_date date - - -
hr_employee_snapshot emp_id string - - -
hr_employee_snapshot employment_status string - active,onboarding,resigned,terminated,on_assignment,pre_assignment -
hr_employee_snapshot hire_date date - - -
hr_employee_snapshot term_date date null - -
hr_employee_snapshot badge_type string - - -
hr_employee_snapshot employee_type string - FTE,intern,contractor,BPO -
hr_employee_snapshot dept_l1 string - - -
hr_employee_snapshot dept_l2 string - - -
hr_employee_snapshot dept_l3 string - - -
hr_employee_snapshot dept_l4 string - - -
hr_employee_snapshot base_city string null - -
hr_employee_snapshot theory_workplace string - - -
hr_employee_snapshot manager_id string null - -
hr_employee_snapshot assignment_city string null - -
badge_taps emp_id string - - -
badge_taps workplace_code string - - -
badge_taps tower string - - -
badge_taps floor int - - <=0
badge_taps tap_ts_utc timestamp_ntz - - -
badge_taps direction string - in,out -
badge_taps device_id string - - -
badge_taps ingested_date date - - -
leave_requests leave_id string - - -
leave_requests emp_id string - - -
leave_requests leave_type string - annual,sick,parental,unpaid,comp -
leave_requests start_date date - - -
leave_requests end_date date - - -
leave_requests status string - approved,pending,cancelled -
leave_requests applied_ts timestamp_ntz - - -
travel_bookings booking_id string - - -
travel_bookings emp_id string - - -
travel_bookings origin_city string - - -
travel_bookings destination_city string - - -
travel_bookings depart_date date - - -
travel_bookings return_date date - - -
travel_bookings booking_status string - confirmed,cancelled -
travel_bookings hotel_flag boolean - - -
travel_bookings flight_flag boolean - - -
workplace_dim workplace_code string - - -
workplace_dim name string - - -
workplace_dim city string - - -
workplace_dim country string - - -
workplace_dim region string - AMER,EMEA,APAC,CN -
workplace_dim timezone string null - -
workplace_dim tower string - - -
workplace_dim floor int - - <=0
workplace_dim delivered_workstations int - - <0
workplace_dim allocated_workstations int - - <0
workplace_dim free_sharing_workstations int - - <0
workplace_dim net_workstation_area_sqm double - - <0
workplace_dim cost_per_workstation_month double - - <=0
workplace_dim lease_expiry_date date - - -
workplace_dim is_space_audited boolean - - -
dept_schedule dept_l2 string - - -
dept_schedule dept_l1 string - - -
dept_schedule weekday int - - <0|>6
dept_schedule is_scheduled_office_day boolean - - -
dept_schedule required_days_per_week int - - <0|>7
dept_schedule policy_version string - - -
"""

# Feeds and the columns of which no two rows may agree.
GRAINS = """
hr_employee_snapshot snapshot_date emp_id
leave_requests leave_id
travel_bookings booking_id
workplace_dim workplace_code tower floor
dept_schedule dept_l2 weekday
"""

# Table, column, test, and what it allows or refers to.
TESTS = """
hr_employee_snapshot emp_id not_null
hr_employee_snapshot snapshot_date not_null
hr_employee_snapshot employment_status not_null
hr_employee_snapshot employment_status accepted_values active,onboarding,resigned,terminated,on_assignment,pre_assignment
badge_taps emp_id not_null
badge_taps tap_ts_utc not_null
badge_taps direction accepted_values in,out
leave_requests leave_id not_null
leave_requests status accepted_values approved,pending,cancelled
leave_requests leave_id unique
travel_bookings booking_id not_null
travel_bookings booking_id unique
workplace_dim workplace_code not_null
workplace_dim region accepted_values AMER,EMEA,APAC,CN
dept_schedule dept_l2 not_null
int_employee_scd2 emp_id not_null
int_employee_scd2 valid_from not_null
int_employee_scd2 employment_status_reported accepted_values active,onboarding,resigned,terminated,on_assignment,pre_assignment
int_leave_days emp_id not_null
int_leave_days leave_date not_null
int_leave_days leave_type accepted_values annual,sick,parental,unpaid,comp
int_travel_days emp_id not_null
int_travel_days travel_date not_null
int_tap_day emp_id not_null
int_tap_day tap_workplace not_null
int_tap_day tap_workplace relationships stg_workplace workplace_code
int_employee_day emp_id not_null
int_employee_day local_date not_null
int_employee_day expected_workplace not_null
int_employee_day employee_day_state not_null
int_employee_day state_rule_id not_null
int_employee_day employee_day_state accepted_values post_exit,pre_hire,on_leave,on_travel,on_assignment,non_office_day,attended,no_show
int_employee_day state_rule_id accepted_values 1,2,3,4,5,6,7,8
int_employee_day employment_status_effective accepted_values active,onboarding,terminated,on_assignment,pre_assignment
int_employee_day expected_workplace relationships stg_workplace workplace_code
dim_date date_day not_null
dim_date weekday_mon0 accepted_values 0,1,2,3,4,5,6
dim_date date_day unique
dim_employee emp_id not_null
dim_employee theory_workplace not_null
dim_employee employee_type accepted_values FTE,intern,contractor,BPO
dim_employee emp_id unique
dim_employee theory_workplace relationships dim_workplace workplace_code
dim_workplace workplace_code not_null
dim_workplace region not_null
dim_workplace delivered_workstations not_null
dim_workplace timezone not_null
dim_workplace region accepted_values AMER,EMEA,APAC,CN
dim_workplace workplace_code unique
fct_attendance_daily local_date not_null
fct_attendance_daily workplace_code not_null
fct_attendance_daily dept_l2 not_null
fct_attendance_daily headcount_incumbent not_null
fct_attendance_daily local_date relationships dim_date date_day
fct_attendance_daily workplace_code relationships dim_workplace workplace_code
fct_workplace_capacity_daily local_date not_null
fct_workplace_capacity_daily workplace_code not_null
fct_workplace_capacity_daily available_workstations not_null
fct_workplace_capacity_daily local_date relationships dim_date date_day
fct_workplace_capacity_daily workplace_code relationships dim_workplace workplace_code
fct_floor_presence_hourly workplace_code not_null
fct_floor_presence_hourly local_hour not_null
fct_floor_presence_hourly workplace_code relationships dim_workplace workplace_code
"""

RETAIL_TESTS = """
orders o_orderkey not_null
orders o_custkey not_null
orders o_orderstatus accepted_values F,O
orders o_orderkey unique
orders o_custkey unique
orders o_custkey relationships customer c_custkey
customer c_mktsegment accepted_values BUILDING,MACHINERY
customer c_custkey relationships events user_id
customer c_nationkey relationships nation n_nationkey
"""

# Measures and the metrics that claim them.
CLAIMS = """
fct_workplace_capacity_daily.attendance_actual attendance_daily peak_day_attendance waste_ratio workstation_vacancy_rate workstation_waste
fct_attendance_daily.attendance_daily attendance_daily
fct_attendance_daily.attendance_expected_met attendance_rate
fct_attendance_daily.attendance_expected_days attendance_rate
fct_workplace_capacity_daily.cost_per_workstation_month average_unit_workstation_cost
fct_workplace_capacity_daily.delivered_workstations average_unit_workstation_cost unallocated_workstation_rate workstation_vacancy_rate
fct_workplace_capacity_daily.floating_headcount floating_headcount
fct_workplace_capacity_daily.headcount_incumbent headcount_incumbent incumbent_vacancy_rate
fct_attendance_daily.headcount_incumbent headcount_incumbent
fct_workplace_capacity_daily.allocated_workstations incumbent_vacancy_rate waste_ratio workstation_waste
fct_attendance_daily.scheduled_attendance scheduled_office_day_compliance_rate
fct_attendance_daily.scheduled_office_days scheduled_office_day_compliance_rate
fct_workplace_capacity_daily.unallocated_workstations unallocated_workstation_rate
fct_workplace_capacity_daily.free_sharing_workstations waste_ratio workstation_waste
fct_workplace_capacity_daily.workstation_waste workstation_waste
fct_workplace_capacity_daily.available_workstations workstation_waste
"""

# Measures that no metric has to claim.
WAIVED = """
fct_attendance_daily.leave_days
fct_attendance_daily.travel_days
fct_attendance_daily.assignment_days
fct_attendance_daily.non_office_days
fct_attendance_daily.post_exit_days
fct_attendance_daily.pre_hire_days
fct_attendance_daily.no_show_days
fct_attendance_daily.employee_days
fct_attendance_daily.avg_span_minutes
fct_attendance_daily.late_reported_tap_days
fct_workplace_capacity_daily.departments_present
fct_workplace_capacity_daily.net_workstation_area_sqm
"""

# Number columns of the two facts that are no measures.
KEYS = """
local_date
iso_year_week
workplace_code
city
region
country
dept_l1
dept_l2
dept_l3
dept_l4
tower
floor
local_hour
is_weekend
is_china_region
required_days_per_week
"""
