"""DuckDB SQL that computes each registered query independently of Spark.

``LEAD_VIEW`` defines ``L``, the cleaned lead view (one row per order),
written straight from the driver tables over the raw order join.
"""

from __future__ import annotations

ORDER_JOIN = """
  orders join customer on o_custkey = c_custkey
  join nation on c_nationkey = n_nationkey
  join region on n_regionkey = r_regionkey"""

LEAD_VIEW = f"""L as (
 select cast(o_orderdate as date) as day,
  cast(o_orderkey as varchar) as leadId,
  case when o_orderkey % 17 <> 0 then strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') end as createTime,
  cast(c_custkey as varchar) as dealerId, c_name as dealerName,
  cast(null as varchar) as countyCode, cast(null as varchar) as countyName,
  cast(n_nationkey as varchar) as cityCode, n_name as cityName,
  cast(n_nationkey as varchar) as provinceCode, n_name as provinceName,
  case when o_orderkey % 11 <> 0 then cast(r_regionkey as varchar) end as regionCode,
  r_name as regionName, c_mktsegment as seriesCode, cast(null as varchar) as seriesName,
  case when o_orderstatus = 'F' then 'OFF' else 'ON' end as vfrom1,
  case when o_orderkey % 13 <> 0 then o_orderpriority end as vfrom2,
  o_orderstatus as vfrom3, c_mktsegment as vfrom4,
  case o_orderkey % 5 when 0 then true when 1 then false when 2 then false end as newLeadHQ,
  case o_orderkey % 3 when 0 then true when 1 then false end as newLeadDealer
 from {ORDER_JOIN})"""

FIELDS = ("leadId, createTime, dealerId, dealerName, countyCode, countyName, cityCode, "
           "cityName, provinceCode, provinceName, regionCode, regionName, seriesCode, "
           "seriesName, vfrom1, vfrom2, vfrom3, vfrom4, newLeadHQ, newLeadDealer")

COMPLETE = ("newLeadDealer and vfrom1 is not null and vfrom2 is not null and vfrom3 is not null"
             " and vfrom4 is not null and regionCode is not null and provinceCode is not null")

_DD = f"""DD as (
 select day as lz_date, vfrom1, vfrom2, vfrom3, vfrom4,
  regionCode as region_code, provinceCode as province_code, count(*) as lead_cnt
 from L where {COMPLETE}
 group by all)"""

DIM_COLS = "vfrom1, vfrom2, vfrom3, vfrom4, region_code, province_code"

_LINE = ("concat_ws(';', " + ", ".join(
    f"coalesce(cast({f.strip()} as varchar), '\\N')" for f in FIELDS.split(",")) + ", 'lead_center')")

PAYLOAD = ("'{\"createTime\":' || epoch_ms(cast(cast(substr(createTime, 1, 10) as date) as timestamp))"
            " || '}'")

# The ``dirty`` fixture: its good leads, and the messages set aside.
_FORM = "cast(leadId as bigint) % 23"
_DIRTY_FIELDS = (FIELDS
    .replace("createTime", f"case {_FORM} when 7 then '2019-1-5 10:00:00' when 8 then 'soon'"
                           " else createTime end as createTime")
    .replace("dealerName", f"case {_FORM} when 6 then 'a;b' else dealerName end as dealerName")
    .replace("vfrom2", f"case {_FORM} when 9 then chr(8232) when 10 then null"
                       " else vfrom2 end as vfrom2")
    .replace("newLeadDealer", f"case when {_FORM} in (1, 2, 3) then true when {_FORM} = 4 then false"
                              " else newLeadDealer end as newLeadDealer"))
_DIRTY_LEADS = f"select {_DIRTY_FIELDS} from L where {_FORM} not in (0, 5, 11, 12)"
_DIRTY_BAD = ("select case when o_orderkey % 23 = 0 then '' else cast(o_orderkey as varchar) end as leadid,"
              " case o_orderkey % 23 when 0 then 'empty' when 5 then 'bad_flag' when 11 then 'no_time'"
              f" else 'malformed' end as reason from {ORDER_JOIN} where o_orderkey % 23 in (0, 5, 11, 12)")

# The archive's lines under their day.
LINES_SQL = f"select strftime(day, '%Y-%m-%d') as dt, {_LINE} as line from L"

_MISSING = "'" + ";".join(["\\N"] * 20) + "'"


def with_ctes(*ctes: str) -> str:
    return "with " + ",\n".join(ctes) + "\n"


ORACLE_SQL = {
    "parse_leads": with_ctes(LEAD_VIEW) + f"select {FIELDS} from L",
    "lead_lines": with_ctes(LEAD_VIEW) + f"select {_LINE} as line from L",
    "line_fields": with_ctes(LEAD_VIEW) + (
        "select leadId as leadid, regionCode as regioncode, vfrom2,"
        " cast(newLeadDealer as varchar) as newleaddealer from L"),
    "parse_dirty": with_ctes(LEAD_VIEW) + _DIRTY_LEADS,
    "quarantine_dirty": _DIRTY_BAD,
    "oneid_dirty": with_ctes(LEAD_VIEW, f"D as ({_DIRTY_LEADS})") + (
        "select leadId as leadid, '{\"createTime\":' || epoch_ms(cast(case when createTime like '2019-1-5%'"
        " then date '2019-01-05' else cast(substr(createTime, 1, 10) as date) end as timestamp)) || '}'"
        " as payload from D where createTime <> 'soon'"),
    "missing_line": (f"select cast(o_orderkey as varchar) as leadid, {_MISSING} as line"
                     f" from {ORDER_JOIN} where o_orderkey % 19 = 0"),
    "lead_total_daily": with_ctes(LEAD_VIEW) + "select day as clue_dt, count(*) as clue_amounts from L group by day",
    "lead_hq_daily": with_ctes(LEAD_VIEW) + (
        "select day as clue_hq_dt, count(*) as clue_hq_amounts from L where newLeadHQ group by day"),
    "lead_dealer_daily": with_ctes(LEAD_VIEW) + (
        "select day as clue_new_dt, count(*) as clue_new_amounts from L where newLeadDealer group by day"),
    "lead_counters_daily": with_ctes(LEAD_VIEW) + (
        "select day, count(*) as total, count(*) filter (where newLeadHQ) as hq,"
        " count(*) filter (where newLeadDealer) as dealer from L group by day"),
    "complete_leads": with_ctes(LEAD_VIEW) + f"select leadId as leadid from L where {COMPLETE}",
    "lead_dim_daily": with_ctes(LEAD_VIEW, _DD) + "select * from DD",
    "lead_dim_latest": with_ctes(LEAD_VIEW, _DD) + (
        f"select {DIM_COLS}, min(lz_date) as lz_date, arg_max(lead_cnt, lz_date) as lead_cnt"
        f" from DD group by all"),
    "oneid_outbox": with_ctes(LEAD_VIEW) + (
        f"select leadId as leadid, {PAYLOAD} as payload from L where createTime is not null"),
    "oneid_reply": with_ctes(LEAD_VIEW) + (
        f"select 200 as code, 'success' as status, leadId as msg, {PAYLOAD} as data from L"),
    "csv_unquote": with_ctes(LEAD_VIEW) + "select leadId as leadid from L",
    "quarantine": (f"select cast(o_orderkey as varchar) as leadid, 'malformed' as reason"
                   f" from {ORDER_JOIN} where o_orderkey % 19 = 0"),
    "upsert_totals": with_ctes(
        LEAD_VIEW,
        "old as (select day as clue_dt, count(*) as clue_amounts from L"
        " where vfrom1 = 'OFF' group by day)",
        "new as (select day as clue_dt, count(*) as clue_amounts from L"
        " where day >= date '1998-01-01' group by day)") + (
        "select coalesce(n.clue_dt, o.clue_dt) as clue_dt,"
        " case when n.clue_dt is not null then n.clue_amounts else o.clue_amounts end"
        " as clue_amounts from old o full join new n on o.clue_dt = n.clue_dt"),
    "expire_counters": with_ctes(
        LEAD_VIEW, _DD,
        f"latest as (select {DIM_COLS}, max(lz_date) as last_day,"
        f" arg_max(lead_cnt, lz_date) as lead_cnt from DD group by all)") + (
        f"select {DIM_COLS}, lead_cnt from latest"
        " where last_day > (select max(lz_date) from DD) - interval 365 days"),
    "ms_to_midnight": ("select event_id, epoch_us(date_trunc('day', ts) + interval 1 day) // 1000"
                       " - epoch_us(ts) // 1000 as ms from events"),
    "oneid_lenient": with_ctes(LEAD_VIEW, "R as (select leadId, case cast(leadId as bigint) % 7"
                               " when 0 then date '2020-01-05' when 1 then date '2019-03-02'"
                               " when 2 then date '2018-12-10' when 3 then date '2019-02-28'"
                               " when 4 then date '2021-03-02' when 5 then null"
                               " else cast(substr(createTime, 1, 10) as date) end as d"
                               " from L where createTime is not null)") + (
        "select leadId as leadid, '{\"createTime\":' || epoch_ms(cast(d as timestamp)) || '}' as payload"
        " from R where d is not null"),
    "reply_variant": with_ctes(LEAD_VIEW) + (
        "select leadId as leadid, case when cast(leadId as bigint) % 6 <> 5 then 200 end as code,"
        " case cast(leadId as bigint) % 6 when 0 then 'OBJECT<createTime: BIGINT>' when 1 then 'STRING'"
        " when 2 then 'ARRAY<BIGINT>' when 3 then 'VOID' when 4 then 'BOOLEAN' end as data_type,"
        " case when cast(leadId as bigint) % 6 = 0 then cast(leadId as bigint) end as create_time from L"),
    "unknown_fields": (
        f"select 'pkId' as field, count(*) as messages, 'BIGINT' as kind from {ORDER_JOIN} union all"
        f" select 'id', count(*) filter (where o_orderkey % 5 <> 0), 'STRING' from {ORDER_JOIN} union all"
        f" select 'updateTime', count(*), 'VARIANT' from {ORDER_JOIN}"),
    "line_repair": with_ctes(LEAD_VIEW, f"D as ({_DIRTY_LEADS})") + (
        "select leadId as leadid, case when cast(leadId as bigint) % 29 = 0 then 'ambiguous'"
        f" when {_FORM} = 6 then 'repaired' else 'whole' end as status,"
        " case when cast(leadId as bigint) % 29 <> 0 then dealerName end as dealername,"
        " case when cast(leadId as bigint) % 29 <> 0 then regionCode end as regioncode,"
        " case when cast(leadId as bigint) % 29 <> 0 then cast(newLeadDealer as varchar) end as newleaddealer"
        " from D"),
}
