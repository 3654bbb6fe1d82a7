"""Staffing, event and control inputs derived from the driver's tables.

Each input is one SELECT that reads the same in Spark and in the oracle's
dialect; only date formatting and a few function names differ. ``{table}``
marks a base table. The hint on the staffing join states what its size would
choose on large tables; small test files hold one row group each, and the
shuffle is also what spreads their rows over the cores.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

# Date patterns in both notations.
PATTERNS = {
    "MM/dd/yyyy": "%m/%d/%Y",
    "yyyy-MM-dd": "%Y-%m-%d",
    "dd/MM/yyyy": "%d/%m/%Y",
    "yyyyMMdd": "%Y%m%d",
    "yyyyMM": "%Y%m",
    "MM-dd-yyyy": "%m-%d-%Y",
    "yyyy-MM-dd HH:mm:ss": "%Y-%m-%d %H:%M:%S",
    "yyyy-MM-dd HH:mm:ss.SSSSSS": "%Y-%m-%d %H:%M:%S.%f",
    "MM/dd/yyyy HH:mm:ss": "%m/%d/%Y %H:%M:%S",
    "yyyy-MM-dd'T'HH:mm:ss": "%Y-%m-%dT%H:%M:%S",
    "yyyy-MM-dd'T'HH:mm:ss'Z'": "%Y-%m-%dT%H:%M:%SZ",
}


class Spark:
    @staticmethod
    def fmt(x: str, pattern: str) -> str:
        return f'date_format({x}, "{pattern}")'

    @staticmethod
    def plus_seconds(ts: str, n: str) -> str:
        return f"cast({ts} as timestamp) + make_dt_interval(0, 0, 0, {n})"

    @staticmethod
    def sha256(x: str) -> str:
        return f"sha2({x}, 256)"

    @staticmethod
    def words(x: str) -> str:
        return f"split({x}, ',')"


class Duck:
    @staticmethod
    def fmt(x: str, pattern: str) -> str:
        return f"strftime({x}, '{PATTERNS[pattern]}')"

    @staticmethod
    def plus_seconds(ts: str, n: str) -> str:
        return f"{ts} + to_seconds({n})"

    @staticmethod
    def sha256(x: str) -> str:
        return f"sha256({x})"

    @staticmethod
    def words(x: str) -> str:
        return f"string_split({x}, ',')"


def staffing_raw(d) -> str:
    return f"""
select /*+ SHUFFLE_MERGE(o) */
 case when l_partkey%97=0 then null else concat('FAC_',cast(l_suppkey%5 as string)) end facility_id,
 case when l_partkey%101=0 then 'not-a-date' else case l_orderkey%6
   when 0 then {d.fmt('l_shipdate', 'MM/dd/yyyy')} when 1 then {d.fmt('l_shipdate', 'yyyy-MM-dd')}
   when 2 then {d.fmt('l_shipdate', 'dd/MM/yyyy')} when 3 then {d.fmt('l_shipdate', 'yyyyMMdd')}
   when 4 then {d.fmt('l_shipdate', 'MM-dd-yyyy')} else {d.fmt('l_shipdate', 'yyyy-MM-dd HH:mm:ss')} end end work_date,
 case l_returnflag when 'R' then 'RN' when 'A' then 'LPN' else 'CNA' end role_code,
 case when l_partkey%83=0 then 'abc' when l_partkey%89=0 then '-3'
      else cast(cast(l_quantity as int) as string) end staff_count,
 case when l_partkey%79=0 then '0' when l_partkey%73=0 then '-5' when l_partkey%67=0 then '1600'
      else cast(cast(floor(l_extendedprice/500) as int) as string) end patient_census,
 case when l_partkey%71=0 then '0' else cast(cast(l_quantity*8 as int) as string) end hours_worked,
 cast(cast(floor(l_quantity*l_discount*6) as int) as string) hours_worked_overtime,
 case when l_linestatus='F' then ' day ' else 'Night' end shift_type,
 concat('landing/sftp/FAC_',cast(l_suppkey%5 as string),'/staff_',{d.fmt('o_orderdate', 'yyyyMMdd')},'.csv') _source_file,
 cast(o_orderdate as timestamp) _ingested_at,
 concat_ws('-',cast(l_orderkey as string),cast(l_linenumber as string),cast(l_partkey as string),
           cast(l_suppkey as string),cast(cast(round(l_extendedprice*100) as bigint) as string)) _record_index
from {{lineitem}} l join {{orders}} o on l_orderkey=o_orderkey"""


def adt_raw(d) -> str:
    return f"""
select event_id seq,
 case event_type
  when 'signup' then case event_id%3 when 0 then 'A' when 1 then 'ADMIT' else 'admission' end
  when 'view' then case event_id%3 when 0 then 'D' when 1 then 'DISCHARGE' else ' Disch ' end
  when 'click' then case event_id%3 when 0 then 'T' when 1 then 'TRANSFER' else 'Trans' end
  when 'purchase' then 'ADMIT' else 'X' end event_type,
 concat('FAC_',cast(user_id%5 as string)) facility_id,
 concat('U',cast(cast(floor(user_id/5) as int)%4 as string)) unit_id,
 concat('PT',cast(user_id as string)) patient_id,
 case when event_id%97=0 then 'bad-time' else case event_id%5
  when 0 then {d.fmt('ts', "yyyy-MM-dd'T'HH:mm:ss'Z'")} when 1 then {d.fmt('ts', 'yyyy-MM-dd HH:mm:ss')}
  when 2 then {d.fmt('ts', 'yyyy-MM-dd HH:mm:ss.SSSSSS')} when 3 then {d.fmt('ts', 'MM/dd/yyyy HH:mm:ss')}
  else {d.fmt('ts', "yyyy-MM-dd'T'HH:mm:ss")} end end event_timestamp,
 concat('B',cast(event_id%40 as string)) bed_id,
 concat('ROLE_',cast(event_id%3 as string)) attending_role,
 cast(ts as timestamp) arrived_at
from {{events}}"""


def file_headers(d) -> str:
    base = "facility_id,work_date,role_code,staff_count,patient_census,hours_worked,hours_worked_overtime,shift_type"
    turned = ",".join(reversed(base.split(",")))
    return f"""
select concat('sftp_',cast(o_custkey%25 as string)) dataset_name,
 {d.words(f"concat(case when o_orderkey%2=0 then '{base}' else '{turned}' end, "
          "case when o_orderpriority like '1%' and o_custkey%25<12 then ',agency_hours' "
          "when o_orderpriority like '2%' and o_custkey%25<5 then ',agency_hours,float_pool' else '' end)")} columns,
 cast(o_orderdate as timestamp) seen_at
from {{orders}}"""


def facility_attributes(d, snapshot: int) -> str:
    if snapshot == 1:
        return """
select concat('FAC_',cast(c_custkey as string)) facility_id,
 cast(50 + (c_custkey%8)*25 as int) bed_capacity,
 cast(20 + (c_custkey%4)*5 as double)/100 staffing_benchmark
from {customer} where c_custkey%10<>0"""
    return """
select concat('FAC_',cast(c_custkey as string)) facility_id,
 cast(50 + (c_custkey%8)*25 + case when c_nationkey%5=0 then 25 else 0 end as int) bed_capacity,
 cast(20 + (c_custkey%4)*5 + case when c_mktsegment='BUILDING' then 5 else 0 end as double)/100 staffing_benchmark
from {customer}"""


def run_events(d) -> str:
    common = """cast(o_orderkey as string) run_id, concat('job_',cast(o_custkey%7 as string)) pipeline_name,
 case o_orderkey%4 when 0 then 'BRONZE' when 1 then 'SILVER' when 2 then 'GOLD' else 'ML' end layer,
 case o_orderkey%3 when 0 then 'SCHEDULE' when 1 then 'SNS' else 'MANUAL' end triggered_by"""
    return f"""
select {common}, 'RUNNING' status, cast(o_orderdate as timestamp) started_at, cast(o_orderdate as timestamp) recorded_at,
 cast(null as bigint) records_read from {{orders}}
union all
select {common}, case when o_orderkey%5=0 then 'FAILED' else 'SUCCESS' end status,
 cast(o_orderdate as timestamp) started_at, {d.plus_seconds('o_orderdate', 'o_orderkey%3600')} recorded_at,
 o_custkey*10 records_read from {{orders}} where o_orderkey%11<>0"""


def pipeline_log(d) -> str:
    return f"""
select cast(o_orderkey as string) pipeline_id, concat('job_',cast(o_custkey%7 as string)) pipeline_name,
 {d.plus_seconds('o_orderdate', '(o_orderkey%1440)*60')} event_timestamp,
 case when o_orderkey%5=0 then 'FAILED' else 'SUCCESS' end status, o_custkey*10 records_processed,
 case when o_orderkey%5=0 then repeat(concat('stage ',cast(o_orderkey as string),' lost; '), cast(o_orderkey%60 as int)) end error_text
from {{orders}}"""


def job_bookmarks(d) -> str:
    return f"""
select concat('job_',cast(o_custkey%7 as string)) job_name, concat('src_',cast(o_custkey%3 as string)) source_name,
 o_custkey*10 record_count, cast(o_orderkey as string) batch_id, 'SUCCESS' run_status,
 {d.plus_seconds('o_orderdate', '(o_orderkey%1440)*60')} updated_at
from {{orders}} where o_orderstatus<>'P'"""


def old_schedule(d) -> str:
    return """
select concat('FAC_',cast(c_custkey as string)) hospital_id,
 case c_nationkey%8 when 0 then 'MONDAY' when 1 then 'TUESDAY' when 2 then 'WEDNESDAY' when 3 then 'THURSDAY'
  when 4 then 'FRIDAY' when 5 then 'SATURDAY' when 6 then 'SUNDAY' else 'DAILY' end expected_day,
 cast(c_custkey%24 as int) expected_by_hour, cast(c_custkey%5 as int) grace_period_hrs,
 c_custkey%13<>0 is_active,
 case when c_custkey%17=0 then null else cast('2001-01-01 00:00:00' as timestamp) end last_received_at,
 cast(0 as int) consecutive_misses
from {customer}"""


def arrivals(d) -> str:
    return f"""
select concat('FAC_',cast(o_custkey as string)) facility_id, 'STAFFING' file_type,
 {d.plus_seconds('o_orderdate', '(o_orderkey%1440)*60')} received_at
from {{orders}} where o_orderkey%3=0"""


ALL = {
    "staffing_raw": staffing_raw,
    "adt_raw": adt_raw,
    "file_headers": file_headers,
    "attributes_1": lambda d: facility_attributes(d, 1),
    "attributes_2": lambda d: facility_attributes(d, 2),
    "run_events": run_events,
    "pipeline_log": pipeline_log,
    "job_bookmarks": job_bookmarks,
    "old_schedule": old_schedule,
    "arrivals": arrivals,
}


def duck_text(name: str) -> str:
    """The input as a query over the oracle's own table names."""
    return re.sub(r"\{(\w+)\}", r"\1", ALL[name](Duck))


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The input as a Spark frame over the Parquet tables of ``sf_dir``."""
    text = ALL[name](Spark)
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in set(re.findall(r"\{(\w+)\}", text))}
    return spark.sql(text, **tables)
