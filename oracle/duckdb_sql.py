"""DuckDB SQL that gives the expected rows of each registered query."""

from __future__ import annotations

import re

RAW_EMPLOYEE = """
SELECT
  CASE c_custkey % 3 WHEN 0 THEN '"' || CAST(c_custkey AS STRING) || '"'
                     WHEN 1 THEN '  ' || CAST(c_custkey AS STRING) || ' '
                     ELSE CAST(c_custkey AS STRING) END            AS client_employee_id,
  CASE c_custkey % 11 WHEN 0 THEN 'N/A' WHEN 1 THEN '-' ELSE c_name END AS first_name,
  CASE c_custkey % 13 WHEN 0 THEN '' ELSE 'Nurse' END              AS last_name,
  CASE c_custkey % 7  WHEN 0 THEN '[NULL]' WHEN 1 THEN 'Null' ELSE c_mktsegment END AS job_title,
  CAST(c_nationkey AS STRING)                                      AS department_id,
  CAST(c_nationkey AS STRING) || '-' || n_name                     AS department_name,
  CASE WHEN c_custkey % 29 = 0 THEN 'not-a-date'
       WHEN c_custkey % 4 = 0 THEN '"' || CAST(CAST(DATE '2019-01-01' + INTERVAL '1' DAY * (c_custkey * 17 % 1860) AS DATE) AS STRING) || '"'
       ELSE CAST(CAST(DATE '2019-01-01' + INTERVAL '1' DAY * (c_custkey * 17 % 1860) AS DATE) AS STRING) END AS hire_date,
  CASE WHEN c_custkey % 4 = 1
       THEN CAST(CAST(DATE '2019-01-01' + INTERVAL '1' DAY * (c_custkey * 17 % 1860 + c_custkey * 37 % 1500) AS DATE) AS STRING)
       WHEN c_custkey % 4 = 2 THEN '[NULL]' WHEN c_custkey % 4 = 3 THEN ' ' END AS term_date,
  'employee_' || CAST(c_custkey % 3 AS STRING) || '.csv'           AS source_file,
  TIMESTAMP '2025-01-01 00:00:00' + INTERVAL '1' DAY * (c_custkey % 3) AS loaded_at
FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE c_custkey % 7 <> 3
"""

RAW_TIMESHEET = """
SELECT
  CASE WHEN event_id % 101 = 0 THEN '[NULL]' ELSE CAST(user_id AS STRING) END AS client_employee_id,
  CAST(CAST(ts AS DATE) AS STRING)                                 AS punch_apply_date,
  CASE WHEN event_id % 31 = 0 THEN '' ELSE CAST(ts AS STRING) END  AS punch_in_datetime,
  CASE WHEN event_id % 37 = 0 THEN '[NULL]'
       ELSE '"' || CAST(ts + INTERVAL '1' MINUTE * (event_id * 61 % 720) AS STRING) || '"' END AS punch_out_datetime,
  CASE WHEN event_id % 41 = 0 THEN 'abc' WHEN event_id % 43 = 0 THEN '--'
       WHEN event_id % 47 = 0 THEN '-1.5' ELSE CAST(event_id * 7 % 26 AS STRING) || '.' || CAST(event_id * 3 % 4 * 25 AS STRING) END AS hours_worked,
  CASE WHEN event_id % 53 = 0 THEN 'undefined' ELSE event_type END AS pay_code,
  CASE event_id % 16 WHEN 0 THEN 'EARLY_OUT' WHEN 1 THEN 'late in' WHEN 2 THEN 'VERY_LATE_IN'
       WHEN 3 THEN '"FORGOT PUNCH"' WHEN 4 THEN 'Employee Missed In Punch' WHEN 5 THEN 'MEAL_NOT_TAKEN'
       WHEN 6 THEN 'meal skipped' WHEN 7 THEN 'LATE_IN|MISSED_PUNCH' WHEN 8 THEN 'MISSED|FOO'
       WHEN 9 THEN 'MEAL|X' WHEN 10 THEN 'hello' WHEN 11 THEN '[null]' WHEN 12 THEN 'undefined'
       WHEN 13 THEN 'SHORT_SHIFT' WHEN 14 THEN 'Cancelled Deduction' END AS punch_in_comment,
  CASE event_id % 5 WHEN 0 THEN 'VACATION' WHEN 1 THEN 'LEFT EARLY' WHEN 2 THEN 'stayed longer'
       WHEN 3 THEN 'EXTRA_SHIFT' END                               AS punch_out_comment,
  'timesheet_' || CAST(event_id % 4 AS STRING) || '.csv'           AS source_file,
  TIMESTAMP '2025-01-01 00:00:00.500' + INTERVAL '1' HOUR * (event_id % 4) AS loaded_at
FROM events
"""

# dcln(c) and cln(c) stand for text macros, expanded by _expand.
PRELUDE = r"""
cat_rules(ord, cat, rx) AS (VALUES
  (1,'EARLY OUT','EARLY'),
  (2,'LATE OUT','LATE_OUT|LATE OUT|LATEOUT|VERY_LATE|VERY LATE OUT'),
  (3,'LATE IN','LATE'),
  (4,'MISSED PUNCH','MISSED_PUNCH|MISSED PUNCH|MISSEDPUNCH|MISSING_PUNCH|FORGOT_PUNCH|FORGOT PUNCH|NO_PUNCH|NO PUNCH|IN_CHAIN|IN CHAIN'),
  (5,'PTO','PTO|PAID_TIME_OFF|PAID TIME OFF|VACATION|PERSONAL_DAY|PERSONAL DAY|SICK|HOLIDAY|LEAVE|TIME_OFF|TIME OFF'),
  (6,'UNSCHEDULED','UNSCHEDULED|UN_SCHEDULED|NOT_SCHEDULED|NOT SCHEDULED|EXTRA_SHIFT|EXTRA SHIFT|OVERTIME|OT'),
  (7,'MEAL ISSUE','MEAL_NOT_TAKEN|MEAL NOT TAKEN|MEAL_ISSUE|MEAL ISSUE|NO_MEAL|NO MEAL|MISSED_MEAL|MISSED MEAL'),
  (8,'SHORT SHIFT','SHORT_SHIFT|SHORT SHIFT|SHORTSHIFT|PARTIAL_SHIFT|PARTIAL SHIFT'),
  (9,'CANCELLED DEDUCTION','CANCELLED_DEDUCTION|CANCELLED DEDUCTION|CANCELED_DEDUCT|CANCELED DEDUCTION|DEDUCTION_CANCELLED|DEDUCTION CANCELLED')),
vocab AS (SELECT DISTINCT x AS raw FROM (SELECT punch_in_comment AS x FROM raw_timesheet UNION SELECT punch_out_comment FROM raw_timesheet
          UNION SELECT cat FROM cat_rules UNION SELECT unnest(['OTHER','NA']))),
vocab_u AS (SELECT raw, upper(trim(trim(regexp_replace(raw,'^\s+|\s+$','','g'),'"'),'''')) AS u FROM vocab),
comment_map AS (
  SELECT raw, CASE
    WHEN raw IS NULL OR u IN ('[NULL]','NULL','NONE','N/A','NA','NAN','',' ','-','--','.') THEN 'NA'
    WHEN (SELECT min(ord) FROM cat_rules r WHERE regexp_matches(u, r.rx)) IS NOT NULL
      THEN (SELECT arg_min(cat, ord) FROM cat_rules r WHERE regexp_matches(u, r.rx))
    WHEN u LIKE '%MISSED%' AND regexp_matches(u,'PUNCH|IN|OUT') THEN 'MISSED PUNCH'
    WHEN u LIKE '%MEAL%' AND regexp_matches(u,'NOT|TAKEN|SKIP|MISSED') THEN 'MEAL ISSUE'
    WHEN u LIKE '%|%' AND u LIKE '%MISSED%' THEN 'MISSED PUNCH'
    WHEN u LIKE '%|%' AND u LIKE '%MEAL%' THEN 'MEAL ISSUE'
    ELSE 'OTHER' END AS cat
  FROM vocab_u),
stg_employee AS (
  SELECT coalesce(cln(client_employee_id),'UNKNOWN') AS employee_id, coalesce(cln(first_name),'') AS first_name,
         coalesce(cln(last_name),'') AS last_name, coalesce(cln(job_title),'Unknown') AS job_title,
         cln(department_id) AS department_id, coalesce(cln(department_name),'Unknown') AS department_name,
         try_cast(dcln(hire_date) AS DATE) AS hire_date,
         coalesce(try_cast(dcln(term_date) AS DATE), DATE '2222-12-31') AS termination_date,
         CASE WHEN coalesce(try_cast(dcln(term_date) AS DATE), DATE '2222-12-31') = DATE '2222-12-31' THEN 1 ELSE 0 END AS is_active,
         source_file, loaded_at AS bronze_loaded_at
  FROM raw_employee),
cln_timesheet AS (
  SELECT coalesce(cln(client_employee_id),'UNKNOWN') AS employee_id,
         try_cast(dcln(punch_apply_date) AS DATE) AS work_date,
         try_cast(dcln(punch_in_datetime) AS TIMESTAMP) AS punch_in, try_cast(dcln(punch_out_datetime) AS TIMESTAMP) AS punch_out,
         coalesce(try_cast(cln(hours_worked) AS DOUBLE), 0.0) AS hours_worked, coalesce(cln(pay_code),'') AS pay_code,
         i.cat AS punch_in_comment, o.cat AS punch_out_comment, source_file, loaded_at AS bronze_loaded_at
  FROM raw_timesheet t JOIN comment_map i ON t.punch_in_comment IS NOT DISTINCT FROM i.raw
                       JOIN comment_map o ON t.punch_out_comment IS NOT DISTINCT FROM o.raw),
stg_timesheet AS (SELECT * FROM cln_timesheet WHERE employee_id IN (SELECT employee_id FROM stg_employee)),
dim_department AS (
  SELECT row_number() OVER (ORDER BY department_id, department_name) AS department_key, department_id, department_name,
         1 AS is_active, DATE '2025-01-01' AS start_date, DATE '2222-12-01' AS end_date
  FROM (SELECT DISTINCT department_id, department_name FROM stg_employee)),
dim_employee AS (
  SELECT row_number() OVER (ORDER BY e.employee_id) AS employee_key, e.employee_id, first_name, last_name, job_title,
         d.department_key, hire_date, termination_date, e.is_active, DATE '2025-01-01' AS start_date, DATE '2222-12-01' AS end_date
  FROM stg_employee e LEFT JOIN dim_department d ON e.department_id IS NOT DISTINCT FROM d.department_id),
dim_date AS (
  SELECT row_number() OVER (ORDER BY work_date) AS date_id, work_date, CAST(year(work_date) AS INTEGER) AS year, CAST(month(work_date) AS INTEGER) AS month,
         CAST(day(work_date) AS INTEGER) AS day, CAST(week(work_date) AS INTEGER) AS week, CAST(quarter(work_date) AS INTEGER) AS quarter
  FROM (SELECT DISTINCT work_date FROM stg_timesheet WHERE work_date IS NOT NULL)),
fact_timesheet AS (
  SELECT e.employee_key, e.department_key, t.work_date, t.punch_in, t.punch_out, '09:00:00' AS scheduled_start,
         '17:00:00' AS scheduled_end, t.hours_worked, t.pay_code, i.cat AS punch_in_comment, o.cat AS punch_out_comment
  FROM stg_timesheet t JOIN dim_employee e USING (employee_id)
  JOIN comment_map i ON t.punch_in_comment = i.raw JOIN comment_map o ON t.punch_out_comment = o.raw)
"""

BODIES = {
    "bronze_lineage": """
SELECT source_file, loaded_at, count(*) AS n FROM raw_timesheet GROUP BY ALL
""",
    "bronze_load_employee": """
SELECT * REPLACE (nullif(last_name, '') AS last_name) FROM raw_employee
""",
    "bronze_load_timesheet": """
SELECT * REPLACE (nullif(punch_in_datetime, '') AS punch_in_datetime) FROM raw_timesheet
""",
    "bronze_new_files": """
SELECT source_file, count(*) AS n FROM raw_timesheet WHERE source_file NOT IN ('timesheet_0.csv','timesheet_1.csv') GROUP BY 1
""",
    "bronze_rejects": """
SELECT CAST(9 AS INTEGER) AS n_fields, true AS rejected, count(*) AS n FROM raw_timesheet WHERE hours_worked = 'abc'
UNION ALL SELECT 5, false, count(*) FROM raw_timesheet WHERE hours_worked = '--'
UNION ALL SELECT 8, false, count(*) FROM raw_timesheet WHERE hours_worked NOT IN ('abc', '--')
""",
    "watermark_state": """
SELECT 'raw_employee' AS table_name, max(loaded_at) AS last_processed_at FROM raw_employee UNION ALL SELECT 'raw_timesheet', max(loaded_at) FROM raw_timesheet
""",
    "incremental_employees": """
SELECT employee_id, bronze_loaded_at FROM stg_employee WHERE bronze_loaded_at > TIMESTAMP '2025-01-01 00:00:00'
""",
    "incremental_timesheets": """
SELECT employee_id, work_date, punch_in, bronze_loaded_at FROM cln_timesheet WHERE bronze_loaded_at > TIMESTAMP '2025-01-01 01:00:00.5'
""",
    "clean_string": """
SELECT employee_id, first_name, last_name, job_title FROM stg_employee
""",
    "clean_numeric": """
SELECT employee_id, work_date, hours_worked FROM cln_timesheet
""",
    "clean_date": """
SELECT employee_id, hire_date FROM stg_employee
""",
    "clean_date_formats": """
SELECT employee_id, hire_date, termination_date, is_active, source_file FROM stg_employee
""",
    "date_format_votes": """
SELECT source_file, 'hire_date' AS column, CASE source_file WHEN 'employee_0.csv' THEN 'MM/dd/yyyy[ HH:mm[:ss]]' WHEN 'employee_1.csv' THEN 'yyyyMMdd[ HH:mm[:ss]]' ELSE 'ISO' END AS format,
       count(*) AS n_texts, count(*) FILTER (hire_date <> 'not-a-date') AS n_parsed FROM raw_employee GROUP BY ALL
UNION ALL
SELECT source_file, 'term_date', CASE source_file WHEN 'employee_0.csv' THEN 'MM/dd/yyyy[ HH:mm[:ss]]' WHEN 'employee_1.csv' THEN 'yyyyMMdd[ HH:mm[:ss]]' ELSE 'ISO' END,
       count(*) FILTER (term_date LIKE '2%'), count(*) FILTER (term_date LIKE '2%') FROM raw_employee GROUP BY ALL
""",
    "clean_date_sentinel": """
SELECT employee_id, termination_date FROM stg_employee
""",
    "is_active_flag": """
SELECT is_active, count(*) AS n FROM stg_employee GROUP BY 1
""",
    "categorize_comment": """
SELECT punch_in_comment, punch_out_comment, count(*) AS n FROM cln_timesheet GROUP BY 1, 2
""",
    "categorize_comment_pipe": """
SELECT t.punch_in_comment AS raw, m.cat AS category, count(*) AS n FROM raw_timesheet t JOIN comment_map m ON t.punch_in_comment = m.raw WHERE t.punch_in_comment LIKE '%|%' GROUP BY 1, 2
""",
    "recategorize_comment": """
SELECT punch_in_comment, punch_out_comment, count(*) AS n FROM fact_timesheet GROUP BY 1, 2
""",
    "clean_employee": """
SELECT * FROM stg_employee
""",
    "clean_timesheet": """
SELECT * FROM cln_timesheet
""",
    "clean_missing_columns": """
SELECT employee_id, CAST(NULL AS DATE) AS hire_date, DATE '2222-12-31' AS termination_date, 1 AS is_active FROM stg_employee
""",
    "silver_employee": """
SELECT * FROM stg_employee
""",
    "silver_timesheet": """
SELECT * FROM stg_timesheet
""",
    "orphan_filter": """
SELECT employee_id, work_date, hours_worked FROM stg_timesheet
""",
    "orphan_rejects": """
SELECT employee_id, count(*) AS n FROM cln_timesheet WHERE employee_id NOT IN (SELECT employee_id FROM stg_employee) GROUP BY 1
""",
    "date_parts": """
SELECT work_date, year, month, day, week, quarter FROM dim_date
""",
    "dim_department": """
SELECT * FROM dim_department
""",
    "dim_employee": """
SELECT * FROM dim_employee
""",
    "dim_date": """
SELECT * FROM dim_date
""",
    "fact_timesheet": """
SELECT * FROM fact_timesheet
""",
    "surrogate_keys": """
SELECT employee_id, employee_key FROM dim_employee
""",
    "upsert_by_key": """
SELECT work_date, CASE WHEN day >= 10 THEN quarter ELSE 0 END AS quarter FROM dim_date
""",
    "insert_if_absent": """
SELECT work_date, CASE WHEN day <= 20 THEN 0 ELSE quarter END AS quarter FROM dim_date
""",
    "refresh_fact": """
SELECT count(*) AS records FROM fact_timesheet
""",
    "gold_counts": """
SELECT (SELECT count(*) FROM dim_department) AS dim_department, (SELECT count(*) FROM dim_employee) AS dim_employee, (SELECT count(*) FROM dim_date) AS dim_date, (SELECT count(*) FROM fact_timesheet) AS fact_timesheet
""",
    "post_load_counts": """
SELECT 'dim_department' AS table_name, count(*) AS db_row_count, count(*) > 0 AS passed FROM dim_department UNION ALL SELECT 'dim_employee', count(*), count(*) > 0 FROM dim_employee UNION ALL SELECT 'dim_date', count(*), count(*) > 0 FROM dim_date UNION ALL SELECT 'fact_timesheet', count(*), count(*) > 0 FROM fact_timesheet
""",
    "kpi_active_headcount": """
SELECT d.work_date, count(DISTINCT e.employee_id) AS active_headcount FROM dim_employee e JOIN dim_date d ON d.work_date >= e.hire_date AND (e.termination_date = DATE '2222-12-31' OR d.work_date <= e.termination_date) WHERE e.is_active = 1 GROUP BY 1
""",
    "kpi_turnover_trend": """
SELECT CAST(year(termination_date) AS INTEGER) AS termination_year, count(*) AS total_terminated FROM dim_employee WHERE termination_date <> DATE '2222-12-31' GROUP BY 1
""",
    "kpi_avg_tenure": """
SELECT d.department_name, d.department_id, round(avg(date_diff('day', e.hire_date, e.termination_date) // 365), 0) AS avg_tenure_years FROM dim_employee e JOIN dim_department d USING (department_key) WHERE e.termination_date <> DATE '2222-12-31' GROUP BY 1, 2
""",
    "kpi_avg_hours": """
SELECT e.employee_id, e.first_name, e.last_name, rounded(sum(numeric(coalesce(f.hours_worked, 0))), count(*)) AS avg_daily_hours FROM fact_timesheet f JOIN dim_employee e USING (employee_key) GROUP BY 1, 2, 3
""",
    "kpi_avg_hours_exact": """
, odd AS (
  SELECT employee_key, CASE WHEN employee_key % 97 = 0 AND pay_code = 'purchase' THEN 1e30 WHEN day(work_date) % 5 = 0 THEN 0.49999999999
    WHEN day(work_date) % 5 = 1 THEN -0.25 WHEN day(work_date) % 5 = 2 THEN 0.7 WHEN day(work_date) % 5 = 3 THEN 0.3 ELSE hours_worked END AS hours
  FROM fact_timesheet),
added AS (
  SELECT employee_id, first_name, last_name, count(*) AS n, count(*) FILTER (hours = 1e30) AS wild,
    sum(CASE WHEN hours = 1e30 THEN 0 ELSE numeric(hours) END) AS s
  FROM odd JOIN dim_employee USING (employee_key) GROUP BY 1, 2, 3)
SELECT employee_id, first_name, last_name,
  printf('%.9e', CASE WHEN wild > 0 THEN (wild * 1e30 + CAST(s AS DOUBLE)) / n ELSE rounded(s, n) END) AS avg_daily_hours
FROM added
""",
    "kpi_late_arrivals": """
SELECT e.employee_id, e.first_name, e.last_name, count(*) AS late_days FROM fact_timesheet f JOIN dim_employee e USING (employee_key) WHERE f.punch_in::TIME > (f.scheduled_start::TIME + INTERVAL '5 minutes') GROUP BY 1, 2, 3
""",
    "kpi_early_departures": """
SELECT e.employee_id, e.first_name, e.last_name, count(*) AS early_departure_days FROM fact_timesheet f JOIN dim_employee e USING (employee_key) WHERE f.punch_out::TIME < (f.scheduled_end::TIME - INTERVAL '5 minutes') GROUP BY 1, 2, 3
""",
    "kpi_overtime": """
SELECT employee_key, count(*) AS overtime_count FROM fact_timesheet WHERE punch_in IS NOT NULL AND punch_out IS NOT NULL AND scheduled_start IS NOT NULL AND scheduled_end IS NOT NULL AND ((work_date + punch_out::TIME) - (work_date + punch_in::TIME)) > ((work_date + scheduled_end::TIME) - (work_date + scheduled_start::TIME) + INTERVAL '5 minutes') GROUP BY 1
""",
    "kpi_rolling_avg_hours": """
SELECT f.employee_key, e.first_name, e.last_name, f.work_date, f.punch_in, rounded(sum(numeric(f.hours_worked)) OVER w, count(f.hours_worked) OVER w) AS rolling_avg_7days FROM fact_timesheet f JOIN dim_employee e USING (employee_key) WINDOW w AS (PARTITION BY f.employee_key ORDER BY f.work_date, f.punch_in NULLS FIRST, f.punch_out NULLS FIRST, f.hours_worked ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
""",
    "kpi_early_attrition": """
SELECT round(count(*) FILTER (WHERE date_diff('day', hire_date, termination_date) <= 90)::DECIMAL / count(*) * 100, 2) AS early_attrition_rate_percentage FROM dim_employee WHERE termination_date <> DATE '2222-12-31'
""",
    "list_employees": """
SELECT * FROM dim_employee WHERE is_active = 1 AND department_key = 3 ORDER BY employee_key LIMIT 20 OFFSET 0
""",
    "list_employees_total": """
SELECT count(*) AS total FROM dim_employee WHERE is_active = 1 AND department_key = 3
""",
    "search_employees": """
SELECT employee_key, employee_id, first_name FROM dim_employee WHERE first_name ILIKE '%MER#00000001%' OR last_name ILIKE '%MER#00000001%' OR employee_id ILIKE '%MER#00000001%'
""",
    "get_employee": """
SELECT * FROM dim_employee WHERE employee_key = 5
""",
    "list_timesheets_deep": """
SELECT employee_key, work_date, punch_in, hours_worked, pay_code FROM fact_timesheet ORDER BY work_date DESC, employee_key, punch_in NULLS FIRST, punch_out NULLS FIRST, hours_worked LIMIT 20 OFFSET 2580
""",
    "list_timesheets_stored": """
SELECT employee_key, work_date, punch_in, hours_worked, pay_code FROM fact_timesheet WHERE work_date >= DATE '2024-01-10' AND work_date <= DATE '2024-02-09' ORDER BY work_date DESC, employee_key, punch_in NULLS FIRST, punch_out NULLS FIRST, hours_worked LIMIT 20 OFFSET 40
""",
    "get_timesheet": """
SELECT f.employee_key, f.work_date, f.punch_in, f.hours_worked, f.pay_code, e.employee_id, e.first_name FROM (SELECT * FROM fact_timesheet WHERE pay_code = 'click' ORDER BY work_date DESC, employee_key, punch_in NULLS FIRST, punch_out NULLS FIRST, hours_worked LIMIT 1) f LEFT JOIN dim_employee e USING (employee_key)
""",
    "list_timesheets": """
SELECT employee_key, work_date, punch_in, hours_worked, pay_code FROM fact_timesheet WHERE work_date >= DATE '2024-01-05' AND work_date <= DATE '2024-01-20' AND pay_code = 'click' ORDER BY work_date DESC, employee_key, punch_in NULLS FIRST, punch_out NULLS FIRST, hours_worked LIMIT 20 OFFSET 20
""",
    "list_timesheets_total": """
SELECT count(*) AS total FROM fact_timesheet WHERE work_date >= DATE '2024-01-05' AND work_date <= DATE '2024-01-20' AND pay_code = 'click'
""",
    "employee_timesheets": """
SELECT f.employee_key, f.work_date, f.punch_in, f.hours_worked FROM fact_timesheet f JOIN dim_employee e USING (employee_key) WHERE e.employee_id = '5' ORDER BY work_date DESC, f.employee_key, punch_in NULLS FIRST, punch_out NULLS FIRST, hours_worked LIMIT 20
""",
    "employee_timesheets_by_key": """
SELECT employee_key, work_date, punch_in, hours_worked FROM fact_timesheet WHERE employee_key = (SELECT min(employee_key) FROM dim_employee WHERE employee_id = '5') ORDER BY work_date DESC, punch_in NULLS FIRST, punch_out NULLS FIRST, hours_worked LIMIT 20
""",
    "timesheet_with_employee": """
SELECT f.employee_key, f.work_date, f.punch_in, f.punch_out, f.hours_worked, e.employee_id, e.first_name, e.job_title FROM fact_timesheet f LEFT JOIN dim_employee e USING (employee_key)
""",
    "insert_employees": """
SELECT employee_key, employee_id FROM dim_employee UNION ALL SELECT (SELECT max(employee_key) FROM dim_employee) + i, 'new' || i FROM range(1, 3) t(i)
""",
    "update_employees": """
SELECT employee_key, CASE WHEN employee_key <= 10 THEN 'Lead' ELSE job_title END AS job_title, CASE WHEN employee_key BETWEEN 11 AND 20 THEN NULL ELSE termination_date END AS termination_date FROM dim_employee
""",
    "delete_employees": """
SELECT employee_key, employee_id FROM dim_employee WHERE employee_key > 10
""",
    "qc_row_count": """
SELECT 'dim_employee' AS table_name, count(*) AS row_count, count(*) >= 1 AS passed FROM dim_employee
""",
    "qc_nulls": """
SELECT count(*) FILTER (WHERE punch_in IS NULL) AS punch_in, count(*) FILTER (WHERE punch_out IS NULL) AS punch_out FROM stg_timesheet
""",
    "qc_duplicates": """
SELECT CAST(coalesce(sum(c), 0) AS BIGINT) AS duplicate_count FROM (SELECT count(*) AS c FROM stg_timesheet GROUP BY employee_id, work_date HAVING count(*) > 1)
""",
    "qc_numeric_range": """
SELECT count(*) FILTER (WHERE hours_worked < 0) AS below_min, count(*) FILTER (WHERE hours_worked > 24) AS above_max, min(hours_worked) AS min_val, max(hours_worked) AS max_val FROM stg_timesheet
""",
    "qc_ref_integrity": """
SELECT count(DISTINCT employee_id) AS orphan_count FROM cln_timesheet WHERE employee_id IS NOT NULL AND employee_id NOT IN (SELECT employee_id FROM stg_employee)
""",
    "qc_date_range": """
SELECT count(*) FILTER (WHERE hire_date < DATE '2020-01-01') AS before_min, count(*) FILTER (WHERE hire_date > DATE '2023-12-31') AS after_max, min(hire_date) AS min_date, max(hire_date) AS max_date FROM stg_employee
""",
    "validate_employee": """
SELECT count(*) AS row_count, count(*) FILTER (WHERE employee_id IS NULL) AS null_ids, count(*) FILTER (WHERE is_active NOT IN (0, 1)) AS invalid_active, count(*) - count(DISTINCT employee_id) AS duplicate_ids FROM stg_employee
""",
    "validate_timesheet": """
SELECT count(*) AS row_count, count(*) FILTER (WHERE employee_id IS NULL) AS null_ids, count(*) FILTER (WHERE work_date IS NULL) AS null_dates, count(*) FILTER (WHERE hours_worked < 0 OR hours_worked > 24) AS out_of_range FROM stg_timesheet
""",
    "validate_integrity": """
SELECT (SELECT count(DISTINCT employee_id) FROM cln_timesheet WHERE employee_id NOT IN (SELECT employee_id FROM stg_employee)) AS orphan_ids, (SELECT count(*) FROM cln_timesheet WHERE employee_id NOT IN (SELECT employee_id FROM stg_employee)) AS orphan_records, (SELECT count(DISTINCT employee_id) FROM stg_employee WHERE employee_id NOT IN (SELECT employee_id FROM cln_timesheet)) AS employees_without_timesheets
""",
    "qc_gold_suite": """
SELECT 'dim_department' AS table_name, 'row_count' AS check_name, CAST((SELECT CASE WHEN count(*) >= 1 THEN 0 ELSE 1 END FROM dim_department) AS BIGINT) AS failing, ((SELECT CASE WHEN count(*) >= 1 THEN 0 ELSE 1 END FROM dim_department)) = 0 AS passed
UNION ALL SELECT 'dim_department' AS table_name, 'null_check' AS check_name, CAST(((SELECT count(*) FROM dim_department WHERE department_id IS NULL) + (SELECT count(*) FROM dim_department WHERE department_name IS NULL)) AS BIGINT) AS failing, (((SELECT count(*) FROM dim_department WHERE department_id IS NULL) + (SELECT count(*) FROM dim_department WHERE department_name IS NULL))) = 0 AS passed
UNION ALL SELECT 'dim_department' AS table_name, 'duplicate_check' AS check_name, CAST((SELECT coalesce(sum(c), 0) FROM (SELECT count(*) AS c FROM dim_department GROUP BY department_key HAVING count(*) > 1)) AS BIGINT) AS failing, ((SELECT coalesce(sum(c), 0) FROM (SELECT count(*) AS c FROM dim_department GROUP BY department_key HAVING count(*) > 1))) = 0 AS passed
UNION ALL SELECT 'dim_employee' AS table_name, 'row_count' AS check_name, CAST((SELECT CASE WHEN count(*) >= 1 THEN 0 ELSE 1 END FROM dim_employee) AS BIGINT) AS failing, ((SELECT CASE WHEN count(*) >= 1 THEN 0 ELSE 1 END FROM dim_employee)) = 0 AS passed
UNION ALL SELECT 'dim_employee' AS table_name, 'null_check' AS check_name, CAST(((SELECT count(*) FROM dim_employee WHERE employee_id IS NULL) + (SELECT count(*) FROM dim_employee WHERE employee_key IS NULL)) AS BIGINT) AS failing, (((SELECT count(*) FROM dim_employee WHERE employee_id IS NULL) + (SELECT count(*) FROM dim_employee WHERE employee_key IS NULL))) = 0 AS passed
UNION ALL SELECT 'dim_employee' AS table_name, 'duplicate_check' AS check_name, CAST((SELECT coalesce(sum(c), 0) FROM (SELECT count(*) AS c FROM dim_employee GROUP BY employee_key HAVING count(*) > 1)) AS BIGINT) AS failing, ((SELECT coalesce(sum(c), 0) FROM (SELECT count(*) AS c FROM dim_employee GROUP BY employee_key HAVING count(*) > 1))) = 0 AS passed
UNION ALL SELECT 'dim_employee' AS table_name, 'ref_integrity_department_key' AS check_name, CAST((SELECT count(DISTINCT department_key) FROM dim_employee WHERE department_key NOT IN (SELECT department_key FROM dim_department)) AS BIGINT) AS failing, ((SELECT count(DISTINCT department_key) FROM dim_employee WHERE department_key NOT IN (SELECT department_key FROM dim_department))) = 0 AS passed
UNION ALL SELECT 'dim_date' AS table_name, 'row_count' AS check_name, CAST((SELECT CASE WHEN count(*) >= 1 THEN 0 ELSE 1 END FROM dim_date) AS BIGINT) AS failing, ((SELECT CASE WHEN count(*) >= 1 THEN 0 ELSE 1 END FROM dim_date)) = 0 AS passed
UNION ALL SELECT 'dim_date' AS table_name, 'null_check' AS check_name, CAST(((SELECT count(*) FROM dim_date WHERE work_date IS NULL) + (SELECT count(*) FROM dim_date WHERE date_id IS NULL)) AS BIGINT) AS failing, (((SELECT count(*) FROM dim_date WHERE work_date IS NULL) + (SELECT count(*) FROM dim_date WHERE date_id IS NULL))) = 0 AS passed
UNION ALL SELECT 'dim_date' AS table_name, 'duplicate_check' AS check_name, CAST((SELECT coalesce(sum(c), 0) FROM (SELECT count(*) AS c FROM dim_date GROUP BY date_id, work_date HAVING count(*) > 1)) AS BIGINT) AS failing, ((SELECT coalesce(sum(c), 0) FROM (SELECT count(*) AS c FROM dim_date GROUP BY date_id, work_date HAVING count(*) > 1))) = 0 AS passed
UNION ALL SELECT 'fact_timesheet' AS table_name, 'row_count' AS check_name, CAST((SELECT CASE WHEN count(*) >= 1 THEN 0 ELSE 1 END FROM fact_timesheet) AS BIGINT) AS failing, ((SELECT CASE WHEN count(*) >= 1 THEN 0 ELSE 1 END FROM fact_timesheet)) = 0 AS passed
UNION ALL SELECT 'fact_timesheet' AS table_name, 'null_check' AS check_name, CAST(((SELECT count(*) FROM fact_timesheet WHERE employee_key IS NULL) + (SELECT count(*) FROM fact_timesheet WHERE work_date IS NULL)) AS BIGINT) AS failing, (((SELECT count(*) FROM fact_timesheet WHERE employee_key IS NULL) + (SELECT count(*) FROM fact_timesheet WHERE work_date IS NULL))) = 0 AS passed
UNION ALL SELECT 'fact_timesheet' AS table_name, 'range_check_hours_worked' AS check_name, CAST((SELECT count(*) FROM fact_timesheet WHERE hours_worked < 0 OR hours_worked > 24) AS BIGINT) AS failing, ((SELECT count(*) FROM fact_timesheet WHERE hours_worked < 0 OR hours_worked > 24)) = 0 AS passed
UNION ALL SELECT 'fact_timesheet' AS table_name, 'ref_integrity_employee_key' AS check_name, CAST((SELECT count(DISTINCT employee_key) FROM fact_timesheet WHERE employee_key NOT IN (SELECT employee_key FROM dim_employee)) AS BIGINT) AS failing, ((SELECT count(DISTINCT employee_key) FROM fact_timesheet WHERE employee_key NOT IN (SELECT employee_key FROM dim_employee))) = 0 AS passed
UNION ALL SELECT 'fact_timesheet' AS table_name, 'ref_integrity_department_key' AS check_name, CAST((SELECT count(DISTINCT department_key) FROM fact_timesheet WHERE department_key NOT IN (SELECT department_key FROM dim_department)) AS BIGINT) AS failing, ((SELECT count(DISTINCT department_key) FROM fact_timesheet WHERE department_key NOT IN (SELECT department_key FROM dim_department))) = 0 AS passed
UNION ALL SELECT 'fact_timesheet' AS table_name, 'date_range_work_date' AS check_name, CAST((SELECT count(*) FROM fact_timesheet WHERE work_date < DATE '2000-01-01') AS BIGINT) AS failing, ((SELECT count(*) FROM fact_timesheet WHERE work_date < DATE '2000-01-01')) = 0 AS passed
""",
    "qc_report_summary": """
SELECT bool_and(passed) AS passed, count(*) FILTER (WHERE passed) AS passed_count, count(*) FILTER (WHERE NOT passed) AS failed_count FROM ({qc_gold_suite})
""",
    "bronze_scan_csv": """
SELECT client_employee_id, punch_apply_date, nullif(punch_in_datetime, '') AS punch_in_datetime, punch_out_datetime, hours_worked,
       pay_code, punch_in_comment, punch_out_comment, TIMESTAMP '2025-01-01 00:00:00' AS loaded_at
FROM raw_timesheet
""",
    "stream_incremental_silver": """
SELECT * FROM stg_timesheet
""",
    "stream_incremental_employee": """
SELECT e.*, coalesce(t.n_timesheets, 0) AS n_timesheets FROM stg_employee e LEFT JOIN (SELECT employee_id, count(*) AS n_timesheets FROM stg_timesheet GROUP BY 1) t USING (employee_id)
""",
    "gate_stops": """
SELECT 'Silver - Timesheet' AS layer, 'Null Work Date' AS check_name, count(*) || ' null values found' AS message, true AS stopped, CAST(0 AS BIGINT) AS fact_rows
FROM raw_timesheet WHERE hours_worked = 'abc' AND client_employee_id IN (SELECT employee_id FROM stg_employee)
""",
    "post_load_unreadable": """
SELECT 'dim_department' AS table_name, CAST(-1 AS BIGINT) AS db_row_count, false AS passed UNION ALL SELECT 'dim_employee', count(*), count(*) > 0 FROM dim_employee UNION ALL SELECT 'dim_date', count(*), count(*) > 0 FROM dim_date UNION ALL SELECT 'fact_timesheet', count(*), count(*) > 0 FROM fact_timesheet
""",
    "medallion_run": """
SELECT 'dim_department' AS table_name, count(*) AS db_row_count, count(*) > 0 AS passed FROM dim_department UNION ALL SELECT 'dim_employee', count(*), count(*) > 0 FROM dim_employee UNION ALL SELECT 'dim_date', count(*), count(*) > 0 FROM dim_date UNION ALL SELECT 'fact_timesheet', count(*), count(*) > 0 FROM fact_timesheet
""",
    "star_incremental": """
SELECT t.employee_id, strftime(t.work_date, '%Y-%m') AS month, count(*) AS n, sum(t.hours_worked) AS hours
FROM stg_timesheet t JOIN stg_employee e USING (employee_id)
WHERE day(e.bronze_loaded_at) - 1 <= least(hour(t.bronze_loaded_at), 2) GROUP BY ALL
""",
    "kpi_active_headcount_all": """
SELECT d.work_date, count(DISTINCT e.employee_id) AS active_headcount FROM dim_employee e JOIN dim_date d ON d.work_date >= e.hire_date AND (e.termination_date = DATE '2222-12-31' OR d.work_date <= e.termination_date) GROUP BY 1
""",
    "kpi_active_headcount_2262": """
SELECT d.work_date, count(DISTINCT e.employee_id) AS active_headcount FROM dim_employee e JOIN dim_date d ON d.work_date >= e.hire_date AND (e.termination_date = DATE '2262-01-01' OR d.work_date <= e.termination_date) WHERE e.is_active = 1 GROUP BY 1
""",
    "kpi_turnover_trend_2262": """
SELECT CAST(year(termination_date) AS INTEGER) AS termination_year, count(*) AS total_terminated FROM dim_employee WHERE termination_date <> DATE '2262-01-01' GROUP BY 1
""",
    "kpi_avg_tenure_2262": """
SELECT d.department_name, d.department_id, round(avg(date_diff('day', e.hire_date, e.termination_date) // 365), 0) AS avg_tenure_years FROM dim_employee e JOIN dim_department d USING (department_key) WHERE e.termination_date <> DATE '2262-01-01' GROUP BY 1, 2
""",
    "kpi_early_attrition_2262": """
SELECT round(count(*) FILTER (WHERE date_diff('day', hire_date, termination_date) <= 90)::DECIMAL / count(*) * 100, 2) AS early_attrition_rate_percentage FROM dim_employee WHERE termination_date <> DATE '2262-01-01'
""",
    "silver_report": """
SELECT layer, check_name, failing = 0 AS passed, message, severity FROM {silver_checks}
""",
    "silver_report_summary": """
SELECT layer, count(*) FILTER (WHERE failing > 0 AND severity = 'ERROR') = 0 AS passed, count(*) FILTER (WHERE failing > 0 AND severity = 'ERROR') AS error_count, count(*) FILTER (WHERE failing > 0 AND severity = 'WARNING') AS warning_count FROM {silver_checks} GROUP BY 1
""",
}

# One row per staging check, on timesheets before the orphan filter.
SILVER_CHECKS = """(
SELECT 'Silver - Employee' AS layer, 'Row Count' AS check_name, CASE WHEN count(*) > 0 THEN 0 ELSE 1 END AS failing, count(*) || ' records' AS message, 'ERROR' AS severity FROM stg_employee
UNION ALL SELECT 'Silver - Employee', 'Null Employee ID', count(*), count(*) || ' null values found', 'ERROR' FROM stg_employee WHERE employee_id IS NULL
UNION ALL SELECT 'Silver - Employee', 'Valid is_active', count(*), count(*) || ' invalid values (expected 0 or 1)', 'WARNING' FROM stg_employee WHERE is_active NOT IN (0, 1)
UNION ALL SELECT 'Silver - Employee', 'Duplicate Employee ID', count(*) - count(DISTINCT employee_id), (count(*) - count(DISTINCT employee_id)) || ' duplicates found', 'WARNING' FROM stg_employee
UNION ALL SELECT 'Silver - Timesheet', 'Row Count', CASE WHEN count(*) > 0 THEN 0 ELSE 1 END, count(*) || ' records', 'ERROR' FROM cln_timesheet
UNION ALL SELECT 'Silver - Timesheet', 'Null Employee ID', count(*), count(*) || ' null values found', 'ERROR' FROM cln_timesheet WHERE employee_id IS NULL
UNION ALL SELECT 'Silver - Timesheet', 'Null Work Date', count(*), count(*) || ' null values found', 'ERROR' FROM cln_timesheet WHERE work_date IS NULL
UNION ALL SELECT 'Silver - Timesheet', 'Hours Worked Range (0-24)', count(*), count(*) || ' records out of range', 'WARNING' FROM cln_timesheet WHERE hours_worked < 0 OR hours_worked > 24
UNION ALL SELECT 'Silver - Referential Integrity', 'Orphan Timesheet Records', count(DISTINCT employee_id), count(DISTINCT employee_id) || ' employee IDs (' || count(*) || ' records) not found in employee table', 'WARNING' FROM cln_timesheet WHERE employee_id NOT IN (SELECT employee_id FROM stg_employee)
UNION ALL SELECT 'Silver - Referential Integrity', 'Employees Without Timesheets', 0, count(DISTINCT employee_id) || ' employees have no timesheet records', 'INFO' FROM stg_employee WHERE employee_id NOT IN (SELECT employee_id FROM cln_timesheet)
)"""

_PLACEHOLDERS = ", ".join(f"'{p}'" for p in (
    "[NULL]", "[null]", "NULL", "null", "None", "none", "N/A", "n/a", "NA", "na",
    "NaN", "nan", "", " ", "  ", "-", "--", ".", "undefined",
))


def _expand(text: str) -> str:
    """Write the text macros out."""
    bare = """trim(trim(regexp_replace({c},'^\\s+|\\s+$','','g'),'"'),'''')"""
    text = re.sub(r"\bcln\((\w+)\)", lambda m: f"CASE WHEN dcln({m[1]}) NOT IN ({_PLACEHOLDERS}) THEN dcln({m[1]}) END", text)
    return re.sub(r"\bdcln\((\w+)\)", lambda m: bare.replace("{c}", m[1]), text)


_NUMERIC = "CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18))"
# Half away from zero in whole numbers: the digits of the sum without their point, against those of the count.
_ROUNDED = """CAST(sign({s}) * ((2 * CAST(replace(CAST(abs({s}) AS VARCHAR), '.', '') AS HUGEINT) + CAST({n} AS HUGEINT) * 1000000000000000000)
  // nullif(2 * CAST({n} AS HUGEINT) * 1000000000000000000, 0)) AS DOUBLE)"""


def _call(text: str, name: str, *names: str, body: str) -> str:
    """Write out calls of a macro whose arguments may hold brackets themselves."""
    while (start := text.find(f"{name}(")) >= 0:
        at, depth, given = start + len(name) + 1, 1, [""]
        while depth:
            depth += {"(": 1, ")": -1}.get(text[at], 0)
            if text[at] == "," and depth == 1:
                given.append("")
            elif depth:
                given[-1] += text[at]
            at += 1
        out = body
        for key, value in zip(names, given, strict=True):
            out = out.replace(f"{{{key}}}", value.strip())
        text = text[:start] + out + text[at:]
    return text


def statements() -> dict[str, str]:
    prelude = f"WITH raw_employee AS ({RAW_EMPLOYEE}), raw_timesheet AS ({RAW_TIMESHEET}), {_expand(PRELUDE)}"
    parts = {"{qc_gold_suite}": BODIES["qc_gold_suite"], "{silver_checks}": SILVER_CHECKS}
    out = {}
    for name, body in BODIES.items():
        for marker, text in parts.items():
            body = body.replace(marker, text)
        body = _call(_call(body, "rounded", "s", "n", body=_ROUNDED), "numeric", "x", body=_NUMERIC)
        out[name] = prelude + body
    return out
