"""The same answers as plain SQL over the driver's tables.

``VIEWS`` are named sub-queries; :func:`oracle` puts the ones a statement
needs in front of it.
"""

from __future__ import annotations

import re

from wardflow.plans import fixtures
from wardflow.schemas import SCHEMA_NAMES, TABLES
from wardflow.plans.queries import AS_OF, BEGUN, CRON_LINES, DATASET, HALF_WAY, LAST_ALERT, MART_COLUMNS, MOVED_AT, RETAINED_AT, SINCE

DAY = AS_OF[:10]
RAW_JSON = "concat('{', concat_ws(',', " + ", ".join(
    f"'\"{c}\":\"' || {c} || '\"'"
    for c in ["facility_id", "work_date", "role_code", "staff_count", "patient_census", "hours_worked",
              "hours_worked_overtime", "shift_type"]
) + "), '}')"


def ts(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S.%f')"


def txt(expr: str) -> str:
    return f"cast({expr} as varchar)"


def ints(expr: str) -> str:
    return f"cast({expr} as bigint)"


def rules(*pairs: tuple[str, str]) -> str:
    cells = ", ".join(f"case when {test} then '{name}' end" for test, name in pairs)
    return f"concat_ws(',', {cells})"


WORK_DATE = "coalesce(" + ", ".join(
    f"try_strptime(work_date, '{f}')"
    for f in ["%m/%d/%Y", "%Y-%m-%d", "%d/%m/%Y", "%Y%m%d", "%m-%d-%Y", "%Y-%m-%d %H:%M:%S"]
) + ")::date"
EVENT_TS = "coalesce(" + ", ".join(
    f"try_strptime(event_timestamp, '{f}')"
    for f in ["%Y-%m-%dT%H:%M:%SZ", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%d %H:%M:%S", "%Y-%m-%d %H:%M:%S.%f",
              "%m/%d/%Y %H:%M:%S"]
) + ")"

REASONS = rules(
    ("coalesce(facility_id,'')=''", "NULL_FACILITY_ID"),
    ("try_cast(patient_census as double)<0 or try_cast(patient_census as double)>1500", "CENSUS_OUT_OF_RANGE"),
    ("try_cast(hours_worked_overtime as double)>24", "OT_HOURS_EXCEED_MAX"),
    ("try_cast(staff_count as double)<0", "NEGATIVE_STAFF_COUNT"),
    ("try_cast(staff_count as int) is null", "STAFF_COUNT_NOT_NUMERIC"),
)
FLAGS = rules(
    ("coalesce(facility_id,'')=''", "NULL_FACILITY_ID"),
    ("work_date is null", "NULL_WORK_DATE"),
    ("coalesce(role_code,'')=''", "NULL_ROLE_CODE"),
    ("patient_census>1500", "CENSUS_OUT_OF_RANGE"),
    ("patient_census<0", "NEGATIVE_CENSUS"),
    ("hours_overtime>24", "OT_HOURS_EXCEED_MAX"),
    ("staff_count<0", "NEGATIVE_STAFF_COUNT"),
)
RULE_NAMES = ["CENSUS_OUT_OF_RANGE", "NEGATIVE_STAFF_COUNT", "NULL_FACILITY_ID", "OT_HOURS_EXCEED_MAX",
              "STAFF_COUNT_NOT_NUMERIC"]
RULE_COUNTS = ", ".join(f"count(*) filter (contains(reasons,'{r}')) n_{r}" for r in RULE_NAMES)
RULE_TEXT = "concat_ws(',', " + ", ".join(f"case when n_{r}>0 then '{r}=' || n_{r} end" for r in RULE_NAMES) + ")"
STATUS = ("case when quarantined=0 then 'PASS' when valid_records*100.0/total_records>=90 then 'WARN'"
          " else 'FAIL' end")
TOTALS = ("count(*) total_records, count(*) filter (reasons='') valid_records,"
          " count(*) filter (reasons<>'') quarantined")
SILVER_ID = "sha256(concat_ws('|', coalesce(facility_id,''), coalesce(cast(work_date as varchar),''), coalesce(role_code,'')))"
SHIFT_ID = ("sha256(concat_ws('|', coalesce(facility_id,''), coalesce(cast(work_date as varchar),''),"
            " coalesce(role_code,''), coalesce(shift_type,'')))")
TYPE_STD = ("case when upper(trim(event_type)) in ('A','ADMIT','ADMISSION') then 'ADMIT'"
            " when upper(trim(event_type)) in ('D','DISCHARGE','DISCH') then 'DISCHARGE'"
            " when upper(trim(event_type)) in ('T','TRANSFER','TRANS') then 'TRANSFER' else 'UNKNOWN' end")

VIEWS: dict[str, str] = {name: fixtures.duck_text(name) for name in fixtures.ALL}
VIEWS |= {
    "judged": f"select *, {REASONS} reasons from staffing_raw",
    "shifts_judged": f"select *, {WORK_DATE} as day, upper(trim(shift_type)) as shift from judged",
    "typed0": f"""select facility_id, {WORK_DATE} work_date, role_code, try_cast(staff_count as int) staff_count,
 try_cast(patient_census as int) patient_census, try_cast(hours_worked as double) hours_worked,
 try_cast(hours_worked_overtime as double) hours_overtime, upper(trim(shift_type)) shift_type,
 _source_file, _ingested_at, _record_index from staffing_raw""",
    "typed": f"""select *, {SILVER_ID} staffing_id, {SHIFT_ID} shift_id, {FLAGS} _dq_flags,
 round(staff_count::double/nullif(patient_census,0),3) nurse_patient_ratio,
 round(hours_overtime/nullif(hours_worked,0),3) overtime_pct from typed0""",
    "silver": """select * from typed qualify row_number() over
 (partition by staffing_id order by _ingested_at desc, _record_index desc)=1""",
    "shifts": """select * from typed qualify row_number() over
 (partition by shift_id order by _ingested_at desc, _record_index desc)=1""",
    "fact": """select cast(strftime(work_date,'%Y%m%d') as int) date_key, facility_id, role_code, work_date, staff_count,
 patient_census, hours_worked, hours_overtime, nurse_patient_ratio, overtime_pct,
 nurse_patient_ratio<0.25 is_understaffed,
 case when _dq_flags='' then 0 else len(string_split(_dq_flags,',')) end dq_flag_count
 from silver where work_date is not null""",
    "overtime": """select cast(strftime(work_date,'%Y%m%d') as int) date_key, facility_id, role_code, shift_type,
 work_date, hours_worked, hours_overtime, overtime_pct, hours_overtime*65.0 overtime_cost_est
 from shifts where work_date is not null and hours_overtime>0""",
    "features": f"""select f.*, cast(is_understaffed as int) understaffed_flag,
 avg(patient_census) over w avg_census_7d, avg(staff_count) over w avg_staff_7d,
 {ints('sum(cast(round(overtime_pct*1000) as bigint)) over w')}/(nullif(count(overtime_pct) over w,0)*1000.0) avg_ot_pct_7d,
 sum(hours_overtime) over w total_ot_hours_7d,
 lag(overtime_pct) over o overtime_pct_lag1, lead(overtime_pct) over o next_pct, lead(work_date) over o next_date
 from fact f
 window o as (partition by facility_id, role_code order by work_date),
 w as (partition by facility_id, role_code order by work_date range between interval 6 days preceding and current row)""",
    "bronze_events": "select * replace (sha256(patient_id) as patient_id) from adt_raw",
    "events_ts": f"select *, {EVENT_TS} event_ts, {TYPE_STD} event_type_std from bronze_events",
    "events_silver": """select *, cast(event_ts as date) event_date, cast(hour(event_ts) as int) event_hour,
 sha256(concat_ws('|', facility_id, patient_id, event_timestamp, event_type)) event_id,
 case event_type_std when 'ADMIT' then 1 when 'DISCHARGE' then -1 else 0 end census_delta from events_ts""",
    "unique_events": "select * from events_silver qualify row_number() over (partition by event_id order by unit_id, event_type)=1",
    "event_sums": """select *, sum(census_delta) over (partition by facility_id, unit_id order by event_ts, event_id
 rows unbounded preceding) running from unique_events where event_ts is not null""",
    "census": f"""select facility_id, unit_id, event_date, event_hour,
 {ints('last(running order by event_ts, event_id)')} census,
 count(*) filter (event_type_std='ADMIT') admits, count(*) filter (event_type_std='DISCHARGE') discharges,
 count(*) filter (event_type_std='TRANSFER') transfers from event_sums group by all""",
    "sent": "select * from adt_raw where seq%50<>0 and seq%51<>0 and seq%53<>0",
    "sent_unique": """select u.* from events_silver u where seq%50<>0 and seq%51<>0 and seq%53<>0
 qualify row_number() over (partition by event_id order by arrived_at, seq)=1""",
    "sent_sums": """select *, sum(census_delta) over (partition by facility_id, unit_id order by event_ts, event_id
 rows unbounded preceding) running from sent_unique where event_ts is not null""",
    "all_index": f"""select _source_file source_file, _ingested_at ingestion_timestamp, reasons quarantine_reason, facility_id,
 {RAW_JSON} raw_record, sha256({RAW_JSON}) record_hash from judged where reasons<>''""",
    "bad_index": "select *, substr(record_hash,1,1) in ('0','1','2','3') resolved from all_index",
    "dq_results": f"""select *, valid_records*100.0/total_records pass_rate, {STATUS} quality_status, {RULE_TEXT} error_summary
 from (select '{DATASET}' dataset_name, _source_file source_file, _ingested_at run_timestamp, {TOTALS}, {RULE_COUNTS}
 from judged group by _source_file, _ingested_at)""",
    "manifest": """select _source_file path, md5(concat(substr(min(_source_file),1,18), strftime(min(_ingested_at),'%Y%m'))) file_checksum,
 count(*) record_count, max(_ingested_at) received_at from staffing_raw group by 1""",
    "ledger": f"select * from manifest where received_at<=timestamp '{HALF_WAY}'",
    "registry": """select md5(_source_file) file_checksum, md5('file|' || md5(_source_file)) file_id, _source_file source_path,
 'bronze/stg_staffing' bronze_path, string_split(_source_file,'/')[-2] hospital_id, count(*) record_count,
 count(*) filter (reasons<>'') quarantine_count, 'run-1' bronze_run_id, 'INGESTED' bronze_status, 'PENDING' silver_status,
 'PENDING' gold_status, max(_ingested_at) bronze_at, cast(null as timestamp) silver_at, cast(null as timestamp) gold_at,
 'run-1' run_id, max(_ingested_at) recorded_at, cast(max(_ingested_at) as date) file_date from judged group by _source_file""",
    "headers": """select dataset_name, list_sort(columns) columns, seen_at,
 'v_' || substr(md5(array_to_string(list_sort(columns),',')),1,8) schema_version from file_headers""",
    "versions": """select dataset_name, schema_version, min(seen_at) registered_at, min(columns) columns
 from headers group by 1,2""",
    "drift": """select dataset_name, (select count(*) from versions v where v.dataset_name=d.dataset_name) versions,
 coalesce((select string_agg(c, ',' order by c) from (select c from (select unnest(columns) c from versions v
 where v.dataset_name=d.dataset_name) group by c having count(*)<(select count(*) from versions v where v.dataset_name=d.dataset_name))),'') drifted_columns
 from (select dataset_name from versions group by 1 having count(*)>1) d""",
    "before": """select v.dataset_name, v.schema_version, list(distinct c) held from versions v, (select dataset_name, registered_at, schema_version, unnest(columns) c from versions) b
 where b.dataset_name=v.dataset_name and (b.registered_at, b.schema_version) < (v.registered_at, v.schema_version) group by all""",
    "changes": """select v.dataset_name, v.schema_version, registered_at,
 case when held is null then '' else array_to_string(list_sort(list_filter(columns, lambda c: not list_contains(held, c))), ',') end added,
 coalesce(array_to_string(list_sort(list_filter(held, lambda c: not list_contains(columns, c))), ','), '') missing
 from versions v left join before using (dataset_name, schema_version)""",
    "dim1": """select facility_id, bed_capacity, staffing_benchmark, true is_current, date '2024-01-01' effective_from,
 cast(null as date) effective_to from attributes_1""",
    "pairs": """select coalesce(a.facility_id,b.facility_id) facility_id, a.bed_capacity old_bed_capacity,
 a.staffing_benchmark old_staffing_benchmark, b.bed_capacity new_bed_capacity, b.staffing_benchmark new_staffing_benchmark,
 a.facility_id is null is_new,
 a.facility_id is not null and b.facility_id is not null and (a.bed_capacity is distinct from b.bed_capacity
  or a.staffing_benchmark is distinct from b.staffing_benchmark) is_changed
 from attributes_1 a full join attributes_2 b on a.facility_id=b.facility_id""",
    "dim2": """select facility_id, old_bed_capacity bed_capacity, old_staffing_benchmark staffing_benchmark, not is_changed is_current,
 date '2024-01-01' effective_from, case when is_changed then date '2024-02-01' end effective_to from pairs where not is_new
 union all
 select facility_id, new_bed_capacity, new_staffing_benchmark, true, date '2024-02-01', null from pairs where is_new or is_changed""",
    "runs": """select * from run_events qualify row_number() over (partition by run_id order by
 case when status='RUNNING' then 0 else 1 end desc, recorded_at desc)=1""",
    "bookmarks": """select * from job_bookmarks qualify row_number() over
 (partition by job_name, source_name order by updated_at desc, batch_id desc)=1""",
    "schedule": """select hospital_id facility_id, 'STAFFING' file_type,
 concat('0 ', expected_by_hour, ' * * ', case expected_day when 'SUNDAY' then '0' when 'MONDAY' then '1' when 'TUESDAY' then '2'
 when 'WEDNESDAY' then '3' when 'THURSDAY' then '4' when 'FRIDAY' then '5' when 'SATURDAY' then '6' else '*' end) schedule_cron,
 grace_period_hrs*60 grace_period_minutes, 'WARN' alert_severity, is_active, last_received_at, consecutive_misses,
 expected_day, expected_by_hour from old_schedule""",
    "last_seen": f"""select s.*, (select max(received_at) from arrivals a where a.facility_id=s.facility_id and a.file_type=s.file_type) arrived
 from schedule s where is_active""",
    "walked": f"""select kind, slot from (select unnest(generate_series(timestamp '{SINCE}', timestamp '{AS_OF}', interval 5 minute)) slot) g,
 (values ('SCHEDULE_DELTA'), ('CALLOUT'), ('ROSTER')) c(kind) where case kind
 when 'SCHEDULE_DELTA' then minute(slot) in (0, 30) and hour(slot) >= 5 and dayofweek(slot) between 1 and 5
 when 'CALLOUT' then minute(slot) = 0 and hour(slot) = 6 and day(slot) = 1 and month(slot) in (1, 4, 7, 10)
 else minute(slot) in (10, 35) and hour(slot) = 8 and month(slot) <= 6 and (day(slot) = 13 or day(slot) >= 29 or dayofweek(slot) = 5) end""",
    "slots": f"""select facility_id, count(*) misses from
 (select l.*, greatest(coalesce(last_received_at, arrived), coalesce(arrived, last_received_at)) seen from last_seen l) x,
 (select cast(unnest(generate_series(timestamp '1994-12-25', timestamp '2001-08-07', interval 1 day)) as timestamp) day0) g
 where (expected_day='DAILY' or upper(dayname(day0))=expected_day)
 and day0 + to_hours(expected_by_hour) > coalesce(seen, timestamp '{SINCE}')
 and day0 + to_hours(expected_by_hour) + to_minutes(grace_period_minutes) < timestamp '{AS_OF}' group by 1""",
}

SILVER_COLUMNS = f"""facility_id, {txt('work_date')} work_date, role_code, staff_count, patient_census, hours_worked,
 hours_overtime, shift_type, {ts('_ingested_at')} _ingested_at, _record_index, staffing_id, nurse_patient_ratio,
 overtime_pct, _dq_flags"""
FACT_COLUMNS = f"""date_key, facility_id, role_code, {txt('work_date')} work_date, staff_count, patient_census, hours_worked,
 hours_overtime, nurse_patient_ratio, overtime_pct, {txt('is_understaffed')} is_understaffed, dq_flag_count"""
OT_COLUMNS = f"""date_key, facility_id, role_code, shift_type, {txt('work_date')} work_date, hours_worked, hours_overtime,
 overtime_pct, overtime_cost_est"""
CENSUS_COLUMNS = f"facility_id, unit_id, {txt('event_date')} event_date, event_hour, census, admits, discharges, transfers"
DIM_COLUMNS = f"""facility_id, bed_capacity, staffing_benchmark, {txt('is_current')} is_current,
 {txt('effective_from')} effective_from, {txt('effective_to')} effective_to"""
SENT_ROW = """_record_index sent_id, facility_id, work_date, role_code, staff_count, patient_census, hours_worked,
 hours_worked_overtime, shift_type"""
SENDER = "case when cast(right(_record_index,1) as int)%2=0 then 'FAC_A' else 'FAC_B' end"
PART = "(length(_record_index)+cast(right(_record_index,1) as int))%4"
STAMPED = """select * replace (timestamp '1997-06-01'+to_days(cast(day(_ingested_at)%3 as int)) as _ingested_at) from typed"""
FEATURE_COLUMNS = f"""date_key, facility_id, role_code, staff_count, patient_census, hours_overtime, nurse_patient_ratio,
 overtime_pct, understaffed_flag is_understaffed, avg_census_7d, avg_staff_7d, avg_ot_pct_7d, total_ot_hours_7d,
 patient_census-avg_census_7d census_vs_avg, {txt('dayofweek(work_date) in (0,6)')} is_weekend, overtime_pct_lag1,
 {txt('next_pct>0')} will_overtime_next_day,
 {txt("case when next_date=work_date+interval 1 day then next_pct>0 end")} will_overtime_next_calendar_day"""
STANDARD = f"""event_id, {ts('event_ts')} event_ts, {txt('event_date')} event_date, event_hour, event_type_std, census_delta"""
SUMMARY = f"""total_records, valid_records, quarantined, pass_rate, quality_status, error_summary"""

STATEMENTS: dict[str, str] = {
    "landing_scan": f"select {SENT_ROW} from staffing_raw",
    "header_evolution": """select role_code, count(*) records, count(facility_id) with_facility,
 cast(sum(length(shift_type)) as bigint) shift_chars, 'true' any_agency_hours, 'false' all_agency_hours from staffing_raw group by 1""",
    "ingest_bronze": f"select {SENT_ROW} from judged where reasons=''",
    "ingest_control_rows": f"""select {SENDER} sender, {TOTALS}, """ + ", ".join(
        f"count(*) filter (contains(reasons,'{r}')) {r.lower()}" for r in RULE_NAMES) + " from judged group by 1",
    "audit_records": f"""select {SENDER} sender, count(*) records, count(*) filter (reasons<>'') quarantined,
 cast(0 as bigint) other_path, cast(0 as bigint) other_status from judged group by 1""",
    "lineage_columns": f"""select {SENDER} sender, count(*) records, count(*) indexes, count(*) timed, cast(1 as bigint) times
 from judged where reasons='' group by 1""",
    "odd_headers": f"""select 'BRONZE' outcome, count(*) records, count(facility_id) with_facility, count(distinct _record_index) sent_ids
 from judged where {PART}<2 and reasons=''
 union all select string_split(reasons,',')[1], count(*), count(facility_id), 0 from judged where {PART}<2 and reasons<>'' group by 1
 union all select 'SURPLUS_CELLS', count(*), count(facility_id), 0 from judged where {PART}=2
 union all select 'HEADER_NOT_READABLE', 2*count(distinct right(_record_index,1)), 0, 0 from judged where {PART}=3""",
    "resent_files": f"""select role_code, {ints('sum(3)')} files, {ints('sum(case when n>1 then 2 else 1 end)')} contents
 from (select role_code, facility_id, count(*) n from staffing_raw group by 1,2) group by 1""",
    "late_batch_silver": f"""select {SILVER_COLUMNS} from (select * from ({STAMPED}) qualify row_number() over
 (partition by staffing_id order by _ingested_at desc, _record_index desc)=1)""",
    "late_batch_gold": f"""select {OT_COLUMNS} from (select *, cast(strftime(work_date,'%Y%m%d') as int) date_key, hours_overtime*65.0 overtime_cost_est
 from (select * from ({STAMPED}) qualify row_number() over (partition by shift_id order by _ingested_at desc, _record_index desc)=1)
 where work_date is not null and hours_overtime>0)""",
    "schema_hints": " union all ".join(
        f"select '{c}' column_name, count({c}) filled from staffing_raw"
        for c in ["facility_id", "work_date", "role_code", "staff_count", "patient_census", "hours_worked",
                  "hours_worked_overtime", "shift_type"]),
    "registered_table": "select role_code, count(*) records from staffing_raw group by 1",
    "partitioned_create": f"select {SILVER_COLUMNS} from silver",
    "feature_snapshot": f"select {FEATURE_COLUMNS} from features",
    "refreshed_features": f"select {FEATURE_COLUMNS} from features",
    "source_guard": """select 'staffing' source, case when exists(from staffing_raw) then 'ROWS' else 'NO_NEW_RECORDS' end outcome
 union all select 'events after 2100', case when exists(from adt_raw where arrived_at>timestamp '2100-01-01') then 'ROWS' else 'NO_BRONZE_DATA' end
 union all select 'facts', case when exists(from fact) then 'ROWS' else 'NO_GOLD_DATA' end""",
    "event_bronze_stream": f"""select event_type, facility_id, unit_id, sha256(patient_id) patient_id, event_timestamp, bed_id, attending_role,
 concat('shard-', seq%4) _kinesis_partition, lpad(cast(seq as varchar),12,'0') _kinesis_sequence,
 {ts("date_trunc('milliseconds', arrived_at)")} _kinesis_timestamp from sent""",
    "event_silver_stream": f"""select lpad(cast(seq as varchar),12,'0') _kinesis_sequence, {STANDARD} from events_silver
 where seq%50<>0 and seq%51<>0 and seq%53<>0
 union all select lpad(cast(seq as varchar),12,'0') _kinesis_sequence, {STANDARD} from events_silver
 where seq%50<>0 and seq%51<>0 and seq%53<>0 and seq%3=0 and seq%10=0""",
    "replay_safe_stream": f"""select event_id, facility_id, unit_id, {ts('event_ts')} event_ts, event_type_std from sent_unique""",
    "census_stream": f"""select facility_id, unit_id, {txt('event_date')} event_date, event_hour,
 {ints('last(running order by event_ts, event_id)')} census, count(*) filter (event_type_std='ADMIT') admits,
 count(*) filter (event_type_std='DISCHARGE') discharges, count(*) filter (event_type_std='TRANSFER') transfers
 from sent_sums group by all""",
    "realtime_json": f"select {txt('cast(arrived_at as date)')} date, facility_id, count(*) events from sent group by all",
    "realtime_quarantine": "select 'EVENT_NOT_READABLE' as rule, count(*) records from adt_raw where seq%50=0 or seq%51=0 or seq%53=0",
    "payload_decode": f"""select lpad(cast(seq as varchar),12,'0') "sequenceNumber", {txt('seq%50<>0')} is_base64,
 case when seq%50<>0 and seq%51<>0 and seq%53<>0 then event_type end event_type,
 case when seq%50<>0 and seq%51<>0 then bed_id end bed_id from adt_raw""",
    "duplicate_files": """select path, file_checksum, record_count from manifest where file_checksum not in (select file_checksum from ledger)
 qualify row_number() over (partition by file_checksum order by path)=1""",
    "validation_reasons": "select _record_index, reasons from judged",
    "split_valid": "select facility_id, case when reasons='' then 'valid' else 'bad' end side, count(*) records from judged group by 1,2",
    "quarantine_index": f"""select source_file, {ts('ingestion_timestamp')} ingestion_timestamp, quarantine_reason, facility_id,
 raw_record, 'false' resolved, record_hash from all_index""",
    "quarantine_queue": f"""select source_file, {ts('min(ingestion_timestamp)')} ingestion_timestamp, quarantine_reason, record_hash
 from all_index group by source_file, quarantine_reason, record_hash""",
    "dq_summary": f"select dataset_name, source_file, {ts('run_timestamp')} run_timestamp, {SUMMARY} from dq_results",
    "dq_summary_by_facility": f"""select facility_id, total_records, valid_records, quarantined, valid_records*100.0/total_records pass_rate,
 {STATUS} quality_status, {RULE_TEXT} error_summary from (select facility_id, {TOTALS}, {RULE_COUNTS} from judged group by 1)""",
    "schema_registry": f"""select dataset_name, schema_version, array_to_string(columns,',') columns, {ts('registered_at')} registered_at
 from versions""",
    "schema_registry_insert": f"""select distinct dataset_name, schema_version from headers h where seen_at>timestamp '{BEGUN}'
 and not exists (select 1 from headers k where k.seen_at<=timestamp '{BEGUN}' and k.dataset_name=h.dataset_name
 and k.schema_version=h.schema_version)""",
    "dq_flags": "select _record_index, _dq_flags from typed",
    "remediation": f"""select facility_id, rule, {txt('resolved')} resolved, count(*) records from (
 select facility_id, string_split(reasons, ',')[1] as rule, facility_id is not null and day is not null and (facility_id, day, role_code, shift) in (
   select (facility_id, day, role_code, shift) from shifts_judged where reasons<>'' and facility_id is not null and day is not null
   and substr(sha256({RAW_JSON}),1,1) in ('0','1','2','3')) resolved
 from shifts_judged where reasons<>'') group by all""",
    "schema_drift": "select * from drift",
    "schema_changes": f"select dataset_name, schema_version as version, added, missing, {ts('registered_at')} seen_at from changes",
    "parsed_events": """select event_type, facility_id, unit_id, sha256(patient_id) patient_id, event_timestamp, bed_id, attending_role,
 concat('shard-', seq%4) _kinesis_partition, lpad(cast(seq as varchar),12,'0') _kinesis_sequence from sent""",
    "incremental_filter": f"""select _record_index, {ts('_ingested_at')} _ingested_at from staffing_raw
 where _ingested_at>(select max(_ingested_at) from staffing_raw where _ingested_at<=timestamp '{HALF_WAY}')""",
    "duplicate_keys": "select staffing_id, count(*) copies from typed group by 1 having count(*)>1",
    "work_dates": f"select _record_index, work_date, {txt(WORK_DATE)} parsed_date from staffing_raw",
    "silver_casts": """select _record_index, staffing_id, staff_count, patient_census, hours_worked, hours_overtime, shift_type,
 nurse_patient_ratio, overtime_pct from typed""",
    "deidentified_patients": "select seq, patient_id from bronze_events",
    "standard_events": f"select seq, {STANDARD} from events_silver",
    "weekend_flags": f"""select distinct {txt('work_date')} work_date, cast(strftime(work_date,'%Y%m%d') as int) date_key,
 {txt('dayofweek(work_date) in (0,6)')} is_weekend from silver where work_date is not null""",
    "error_messages": "select pipeline_id, status, substr(error_text,1,500) error_message from pipeline_log",
    "silver_watermark": f"""select {ts('max(_ingested_at)')} watermark, 'full' load from silver
 union all select '1970-01-01 00:00:00.000000', 'none'""",
    "run_row_counts": """select count(*) records_read, count(*) filter (reasons='') records_written,
 count(*) filter (reasons<>'') records_failed from judged""",
    "silver_staffing": f"select {SILVER_COLUMNS} from silver",
    "silver_shifts": f"select shift_id, {SILVER_COLUMNS} from shifts",
    "fact_staffing": f"select {FACT_COLUMNS} from fact",
    "fact_overtime": f"select {OT_COLUMNS} from overtime",
    "hourly_census": f"select {CENSUS_COLUMNS} from census",
    "replay_census": f"select {CENSUS_COLUMNS} from census",
    "running_census": f"select event_id, facility_id, unit_id, {ints('running')} census from event_sums",
    "hourly_last_census": f"select facility_id, unit_id, {txt('event_date')} event_date, event_hour, census from census",
    "overtime_features": f"select {FEATURE_COLUMNS} from features",
    "known_facilities": """select facility_id from silver where facility_id is not null union
 select facility_id from events_silver where facility_id is not null""",
    "gold_check": "select count(*) records, min(date_key) first_day, max(date_key) last_day from fact",
    "control_counts": """select 'file_registry' as name, count(*) records from registry
 union all select 'pipeline_runs', count(*) from run_events
 union all select 'file_schedule', count(*) from schedule
 union all select 'quarantine_index', count(*) from bad_index
 union all select unnest([%s]), 0""" % ", ".join(f"'{n}'" for n, t in TABLES.items() if t.schema_name == "batch_control" and n not in ("file_registry", "pipeline_runs", "file_schedule", "quarantine_index")),
    "upsert_silver": f"select {SILVER_COLUMNS} from silver",
    "merge_fact_staffing": f"select {FACT_COLUMNS} from fact",
    "upsert_fact_staffing": f"select {FACT_COLUMNS} from fact",
    "upsert_fact_overtime": f"select {OT_COLUMNS} from overtime",
    "upsert_census": f"select {CENSUS_COLUMNS} from census",
    "unseen_facilities": "select facility_id from attributes_2 where facility_id not in (select facility_id from attributes_1)",
    "changed_facilities": """select facility_id, old_bed_capacity, old_staffing_benchmark, new_bed_capacity, new_staffing_benchmark
 from pairs where is_changed""",
    "seed_schedule": """select facility_id, file_type, schedule_cron, grace_period_minutes, alert_severity, 'true' is_active,
 cast(null as varchar) last_received_at, 0 consecutive_misses
 from (select distinct facility_id from silver where facility_id is not null),
 (values ('STAFFING','0 8 * * *',60,'CRITICAL'),('SCHEDULE_DELTA','0 12 * * *',120,'WARN'),('CALLOUT','0 6 * * *',30,'INFO'))
 k(file_type, schedule_cron, grace_period_minutes, alert_severity)""",
    "latest_fact_rows": f"""select facility_id, role_code, {txt('work_date')} work_date, nurse_patient_ratio, overtime_pct
 from fact order by date_key desc, facility_id nulls first, role_code limit 20""",
    "ordered_schedule": """select row_number() over (order by facility_id, file_type)-1 place, facility_id, file_type, schedule_cron
 from schedule""",
    "facility_source": """select facility_id, bed_capacity, staffing_benchmark from
 (select facility_id from silver where facility_id is not null union select facility_id from events_silver)
 full join attributes_1 using (facility_id)""",
    "dim_first_load": f"select {DIM_COLUMNS} from dim1",
    "dim_after_changes": f"select {DIM_COLUMNS} from dim2",
    "dim_same_day": f"""select {DIM_COLUMNS} from (select facility_id, bed_capacity, staffing_benchmark, false is_current,
 date '2024-01-01' effective_from, date '2024-02-01' effective_to from attributes_1
 union all select facility_id, bed_capacity+1, staffing_benchmark, true, date '2024-02-01', null from attributes_2)""",
    "facility_keys": """select (select count(*) from attributes_1)+(select count(*) from attributes_2) versions,
 (select count(*) from attributes_1)+(select count(*) from attributes_2) distinct_keys, cast(0 as bigint) empty_ranges""",
    "tracked_run": f"""select 'Validation' pipeline_name, 'BRONZE' layer, 'MANUAL' triggered_by, 'SUCCESS' status, n records_read, n records_written,
 cast(0 as bigint) records_failed, '{AS_OF}.000000' watermark_to, 'true' timed, 'SUCCESS' logged_status, n records_processed,
 cast(0 as bigint) records_quarantined from (select count(*) n from judged where reasons='')""",
    "created_tables": " union all ".join(
        f"""select '{name}' schema_name, cast({sum(t.schema_name == name for t in TABLES.values())} as bigint) tables,
 {"(select count(*) from silver)" if name == 'silver' else 'cast(0 as bigint)'} as rows"""
        for name in SCHEMA_NAMES),
    "realtime_runs": """select pipeline_name, layer, status, n records_read, cast(1 as bigint) logged, marked, failed from (
 select 'ADT_Bronze_Streaming' pipeline_name, 'BRONZE' layer, 'SUCCESS' status, count(*) n, count(*) marked, 'false' failed from adt_raw
 union all select 'ADT_Bronze_Streaming', 'BRONZE', 'FAILED', 0, count(*), 'true' from adt_raw
 union all select 'ADT_Silver_Streaming', 'SILVER', 'SUCCESS', count(*), count(*), 'false' from sent
 union all select 'ADT_Census_Streaming', 'GOLD', 'SUCCESS', count(*), count(*), 'false' from sent)""",
    "stream_metadata": f"""select concat('shard-', seq%4) _kinesis_partition, lpad(cast(seq as varchar),12,'0') _kinesis_sequence,
 {ts('arrived_at')} _kinesis_timestamp, 'true' processed from sent""",
    "scd2_audit": """select facility_id, '2024-02-01' changed_on,
 concat('bed_capacity=', old_bed_capacity, ',staffing_benchmark=', old_staffing_benchmark) old_values,
 concat('bed_capacity=', new_bed_capacity, ',staffing_benchmark=', new_staffing_benchmark) new_values from pairs where is_changed""",
    "current_runs": f"""select run_id, pipeline_name, layer, triggered_by, status, {ts('started_at')} started_at,
 {ts('recorded_at')} recorded_at, records_read from runs""",
    "file_registry": f"""select file_checksum, file_id, source_path, bronze_path, hospital_id, record_count, quarantine_count, bronze_run_id,
 bronze_status, silver_status, gold_status, {ts('bronze_at')} bronze_at, {ts('silver_at')} silver_at, {ts('gold_at')} gold_at,
 run_id, {ts('recorded_at')} recorded_at, {txt('file_date')} file_date from registry""",
    "file_layer_status": f"""select source_path, 'INGESTED' bronze_status,
 case when hit then 'TRANSFORMED' else 'PENDING' end silver_status, 'PENDING' gold_status,
 case when hit then '{MOVED_AT}.000000' end silver_at, case when hit then 'run-2' else 'run-1' end run_id
 from (select source_path, source_path in (select _source_file from silver) hit from registry)""",
    "job_bookmarks": f"select job_name, source_name, record_count, batch_id, run_status, {ts('updated_at')} updated_at from bookmarks",
    "migrate_file_schedule": f"""select facility_id, file_type, schedule_cron, grace_period_minutes, alert_severity, {txt('is_active')} is_active,
 {ts('last_received_at')} last_received_at, consecutive_misses from schedule""",
    "missed_files": f"""select facility_id, file_type, schedule_cron,
 {ts('greatest(coalesce(last_received_at, arrived), coalesce(arrived, last_received_at))')} last_received_at,
 cast(coalesce(misses,0) as int) consecutive_misses, case when misses>0 then alert_severity end severity
 from last_seen left join slots using (facility_id)
 union all select facility_id, k, line, {ts('last_received_at')}, case when k<>'BROKEN' then cast((select count(*) from walked w where w.kind=k
  and w.slot > coalesce(last_received_at, timestamp '{SINCE}') and w.slot < timestamp '{AS_OF}' - to_minutes(grace_period_minutes)) as int) end misses,
  case when k='BROKEN' then 'UNREADABLE' when (select max(slot) from walked w where w.kind=k and w.slot < timestamp '{AS_OF}' - to_minutes(grace_period_minutes))
  > coalesce(last_received_at, timestamp '{SINCE}') then alert_severity end
 from last_seen, (values {", ".join(str(line) for line in CRON_LINES)}) c(k, line)""",
    "quarantine_unresolved": "select source_file, record_hash from bad_index where not resolved",
    "quarantine_by_rule": """select rule, count(*) records from (select unnest(string_split(quarantine_reason,',')) as rule from bad_index)
 group by 1""",
    "quarantine_by_file": """select source_file, quarantine_reason, record_hash from bad_index where source_file=
 (select source_file from bad_index group by 1 order by count(*) desc, source_file limit 1)""",
    "files_with_quarantine": "select source_file, count(*) records, count(*) filter (not resolved) unresolved from bad_index group by 1",
    "dq_trend": f"""select {txt('run_date')} run_date, total_records, valid_records, quarantined, valid_records*100.0/total_records pass_rate
 from (select cast(run_timestamp as date) run_date, {ints('sum(total_records)')} total_records,
 {ints('sum(valid_records)')} valid_records, {ints('sum(quarantined)')} quarantined from dq_results
 where cast(run_timestamp as date)>date '{DAY}'-365 and cast(run_timestamp as date)<=date '{DAY}' group by 1)""",
    "job_status": f"""select pipeline_id, pipeline_name, {ts('event_timestamp')} event_timestamp, status, records_processed from pipeline_log
 where cast(event_timestamp as date)=date '1997-01-15'
 qualify row_number() over (partition by pipeline_name order by event_timestamp desc, pipeline_id desc)=1""",
    "pipeline_failures": f"""select pipeline_id, pipeline_name, {ts('event_timestamp')} event_timestamp from pipeline_log
 where status='FAILED' and event_timestamp>timestamp '{AS_OF}'-interval 365 day and event_timestamp<=timestamp '{AS_OF}'""",
    "pipeline_runs": f"""select run_id, pipeline_name, layer, triggered_by, status, {ts('started_at')} started_at,
 {ts('recorded_at')} recorded_at, records_read from runs
 where started_at>timestamp '{AS_OF}'-interval 365 day and started_at<=timestamp '{AS_OF}'""",
    "duplicate_check": """select file_checksum, path, record_count from ledger where file_checksum=(select min(file_checksum) from ledger)""",
    "health_check": f"""select 'files_ingested' check_name, count(*) as value from ledger
 union all select 'quarantine_records', count(*) from bad_index
 union all select 'quarantine_unresolved', count(*) filter (not resolved) from bad_index
 union all select 'dq_fail_runs', count(*) filter (quality_status='FAIL') from dq_results
 union all select 'dq_runs', count(*) from dq_results
 union all select 'datasets_with_drift', count(*) from drift
 union all select 'bookmarks', count(*) from bookmarks
 union all select 'runs_failed_today', count(*) filter (status='FAILED' and cast(event_timestamp as date)=date '{DAY}') from pipeline_log""",
    "alerts": f"""select 'DQ_PASS_RATE' alert, source_file subject, 'FAIL' severity from dq_results where pass_rate<90
 union all select 'BOOKMARK_STALE', concat(job_name,'/',source_name), 'WARN' from bookmarks where updated_at<timestamp '{DAY}'
 union all select 'QUARANTINE_AGE', source_file, 'WARN' from bad_index where not resolved group by source_file
 having min(ingestion_timestamp)<timestamp '{AS_OF}'-interval 30 minute
 union all select 'SCHEMA_DRIFT', concat(dataset_name, '/', schema_version), 'WARN' from changes
 where (added<>'' or missing<>'') and registered_at > timestamp '{LAST_ALERT}'""",
    "retention_job": " union all ".join(
        f"select '{layer}' layer, count(*) records, {txt(f'cast(min({day}) as date)')} oldest from {table} where {kept}"
        for layer, table, day, kept in [
            ("landing", "staffing_raw", "null", "true"),
            ("bronze", "staffing_raw", "_ingested_at", f"cast(_ingested_at as date) >= date '{RETAINED_AT}' - 365"),
            ("silver", "silver", "silver.work_date", f"silver.work_date is null or silver.work_date >= date '{RETAINED_AT}' - 1095"),
            ("gold", "overtime", "overtime.work_date", f"overtime.work_date >= date '{RETAINED_AT}' - 2555"),
            ("audit", "staffing_raw", "_ingested_at", f"day(_ingested_at) = 1 and cast(_ingested_at as date) >= date '{RETAINED_AT}' - 2555"),
            ("quarantine", "all_index", "ingestion_timestamp", f"date_trunc('quarter', ingestion_timestamp) in (select date_trunc('quarter', ingestion_timestamp) from all_index where ingestion_timestamp >= date '{RETAINED_AT}' - 180)"),
            ("pipeline_log", "pipeline_log", "event_timestamp", f"event_timestamp >= date '{RETAINED_AT}' - 90"),
        ]),
    "stored_missed_files": f"""select facility_id, file_type, schedule_cron,
 {ts('greatest(coalesce(last_received_at, arrived), coalesce(arrived, last_received_at))')} last_received_at,
 cast(coalesce(misses,0) as int) consecutive_misses from last_seen left join slots using (facility_id)""",
    "quarantine_of_facility": f"""select source_file, {ts('ingestion_timestamp')} ingestion_timestamp, record_hash from bad_index
 where facility_id='FAC_1' and cast(ingestion_timestamp as date)>date '1998-03-24' and cast(ingestion_timestamp as date)<=date '1998-03-31'""",
    "retention": " union all ".join(
        f"""select '{layer}' layer, count(*) records, {txt('cast(min(_ingested_at) as date)')} oldest from staffing_raw
 where cast(_ingested_at as date)>=date '{DAY}'-{days}"""
        for layer, days in [("landing", 90), ("bronze", 365), ("silver", 1095), ("gold", 2555), ("audit", 2555), ("quarantine", 180),
                            ("pipeline_log", 90)]),
    "facility_daily_summary": f"""select facility_id, {txt('work_date')} work_date, {ints('sum(staff_count)')} staff_total,
 {ints('sum(patient_census)')} census_total, sum(hours_overtime) overtime_hours,
 {ints('sum(cast(round(nurse_patient_ratio*1000) as bigint))')}/(nullif(count(nurse_patient_ratio),0)*1000.0) avg_nurse_patient_ratio,
 count(*) filter (is_understaffed) understaffed_roles from fact group by facility_id, fact.work_date""",
    "np_ratio_realtime": f"""select facility_id, census_now, {txt('as_of_date')} as_of_date, staff_now, {txt('staff_date')} staff_date,
 round(staff_now::double/nullif(census_now,0),3) np_ratio from (
 select c.facility_id, census_now, as_of_date, staff staff_now, work_date staff_date from
 (select facility_id, {ints('sum(census)')} census_now, max(event_date) as_of_date from
   (select * from census qualify row_number() over (partition by facility_id, unit_id order by event_date desc, event_hour desc)=1)
  group by 1) c left join
 (select facility_id, work_date, {ints('sum(staff_count)')} staff from fact group by 1,2) s
 on s.facility_id=c.facility_id and s.work_date<=c.as_of_date
 qualify row_number() over (partition by c.facility_id order by work_date desc)=1)""",
    "ot_summary_monthly": f"""select facility_id, role_code, {txt("cast(date_trunc('month',work_date) as date)")} as month,
 sum(hours_overtime) overtime_hours, sum(overtime_cost_est) overtime_cost, count(*) overtime_rows
 from overtime group by facility_id, role_code, date_trunc('month',work_date)""",
    "scorecard_quarterly": f"""select s.facility_id, {txt('s.q')} as quarter, avg_nurse_patient_ratio, understaffed_share, overtime_pct,
 coalesce(overtime_cost,0.0) overtime_cost from
 (select facility_id, cast(date_trunc('quarter',work_date) as date) q,
  {ints('sum(cast(round(nurse_patient_ratio*1000) as bigint))')}/(nullif(count(nurse_patient_ratio),0)*1000.0) avg_nurse_patient_ratio,
  count(*) filter (is_understaffed)/nullif(count(is_understaffed),0) understaffed_share from fact group by 1,2) s left join
 (select facility_id, cast(date_trunc('quarter',work_date) as date) q, round(sum(hours_overtime)/nullif(sum(hours_worked),0),3) overtime_pct,
  sum(overtime_cost_est) overtime_cost from overtime group by 1,2) o
 on s.facility_id is not distinct from o.facility_id and s.q=o.q""",
    "dq_dashboard": f"""select '{DATASET}' dataset_name, {txt('run_date')} run_date, total_records, valid_records,
 n_NULL_FACILITY_ID null_facility_id, n_CENSUS_OUT_OF_RANGE census_out_of_range, n_OT_HOURS_EXCEED_MAX ot_hours_exceed_max,
 n_NEGATIVE_STAFF_COUNT negative_staff_count, n_STAFF_COUNT_NOT_NUMERIC staff_count_not_numeric,
 valid_records*100.0/total_records pass_rate from (select cast(_ingested_at as date) run_date, {TOTALS}, {RULE_COUNTS} from judged group by 1)""",
    "dim_facility_current": f"""select facility_id, bed_capacity, staffing_benchmark, 'true' is_current, {txt('effective_from')} effective_from
 from dim2 where is_current""",
}


MART_TYPES = ["varchar", "varchar", "varchar", "double", "double", "double", "double"]
STATEMENTS["stored_marts"] = " union all ".join(
    f"select '{mart}' mart, "
    + ", ".join(f"cast({c or 'null'} as {t}) as {n}" for c, t, n in zip(columns, MART_TYPES, ["facility_id", "part", "day", "v1", "v2", "v3", "v4"]))
    + f" from ({STATEMENTS[mart]})"
    for mart, columns in MART_COLUMNS.items()
)


def oracle(statement: str) -> str:
    """A statement with the sub-queries it needs, in order of definition."""
    needed: set[str] = set()
    pending = [statement]
    while pending:
        words = set(re.findall(r"[A-Za-z_][A-Za-z_0-9]*", pending.pop()))
        for name in words & VIEWS.keys() - needed:
            needed.add(name)
            pending.append(VIEWS[name])
    views = ",\n".join(f"{name} as ({body})" for name, body in VIEWS.items() if name in needed)
    return f"with {views}\n{statement}" if views else statement
