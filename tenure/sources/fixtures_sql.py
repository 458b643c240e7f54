"""DuckDB SQL for the fixtures in ``fixtures.py`` (used by the oracle queries).

Each entry is the body of a CTE over the driver's pre-registered views.
``with_fixtures(sql, *names)`` prefixes a query with the CTEs it needs.
"""

from __future__ import annotations

_HOURS = "cast(case {k} % 3 when 0 then 40 when 1 then 24 else 12 end as decimal(6,2))"

FIXTURE_SQL = {
    "job": """
select lpad(cast(o_custkey as varchar), 6, '0') emplid,
       cast(o_orderkey % 2 as integer) empl_rcd,
       cast(o_orderdate as date) effdt,
       cast(row_number() over (partition by o_custkey, o_orderkey % 2, cast(o_orderdate as date) order by o_orderkey) - 1 as integer) effseq,
       case when o_orderstatus = 'F' then 'I' else 'A' end hr_status,
       case when o_orderkey % 9 = 0 then 'POI' else 'EMP' end per_org,
       lpad(cast(o_orderkey % 200 as varchar), 8, '0') position_nbr,
       case when o_orderkey % 6 = 0 then 'Y' else 'N' end position_override,
       'BU' || cast(o_orderkey % 2 as varchar) business_unit,
       lpad(cast(o_orderkey % 4 as varchar), 4, '0') deptid,
       lpad(cast(o_orderkey % 3 as varchar), 4, '0') location,
       lpad(cast(o_orderkey % 5 as varchar), 4, '0') jobcode,
       case when o_orderkey % 4 = 0 then '101' else '001' end company,
       """ + _HOURS.format(k="o_orderkey") + """ std_hours,
       lpad(cast(o_orderkey % 10 as varchar), 8, '0') reports_to,
       case when o_orderkey % 6 = 0 then '73' else 'NON' end union_cd,
       case when o_orderkey % 13 = 0 then null else substring(o_orderpriority, 1, 1) end shift,
       case when o_orderkey % 7 = 0 then 'T' else 'R' end reg_temp,
       case o_orderkey % 3 when 0 then 'F' when 1 then 'P' else 'C' end full_part_time,
       case when o_orderkey % 2 = 0 then 'N' else 'E' end flsa_status,
       case when o_orderkey % 2 = 0 then 'P' else 'S' end job_indicator,
       case when o_orderkey % 19 = 0 then 'L' when o_orderkey % 23 = 0 then 'P' else 'A' end empl_status,
       substring('1236ABC79D', cast(o_orderkey % 10 as integer) + 1, 1) officer_cd,
       case when o_orderkey % 17 = 0 then 'N' else 'Y' end elig_rehire,
       case when o_orderstatus = 'F' then cast(o_orderdate as date) end termination_dt,
       cast(o_orderdate as date) - cast(o_orderkey % 400 as integer) hire_dt,
       cast(o_totalprice as decimal(12,2)) hourly_rt
from orders""",
    "position_data": """
select lpad(cast(p_partkey as varchar), 8, '0') position_nbr,
       v.effdt,
       case when p_partkey % 11 = 0 and v.k = 1 then 'I' else 'A' end eff_status,
       'BU' || cast(p_partkey % 2 as varchar) business_unit,
       lpad(cast(case when v.k = 0 then p_partkey % 4 else (p_partkey + 4) % 8 end as varchar), 4, '0') deptid,
       lpad(cast(p_partkey % 3 as varchar), 4, '0') location,
       lpad(cast(p_partkey % 5 as varchar), 4, '0') jobcode,
       case when p_partkey % 4 = 0 then '101' else '001' end company,
       """ + _HOURS.format(k="p_partkey") + """ std_hours,
       lpad(cast(p_partkey % 10 as varchar), 8, '0') reports_to,
       case when p_partkey % 6 = 0 then '73' else 'NON' end union_cd,
       cast(p_partkey % 2 + 1 as varchar) shift,
       case when p_partkey % 7 = 0 then 'T' else 'R' end reg_temp,
       case p_partkey % 3 when 0 then 'F' when 1 then 'P' else 'C' end full_part_time,
       case when p_partkey % 2 = 0 then 'N' else 'E' end flsa_status,
       case when p_partkey % 3 = 0 then 'N' else 'Y' end include_title,
       cast(case when p_size % 5 = 0 then 1 else 99 end as integer) max_head_count,
       case when p_partkey % 4 = 1 then 'N' else 'Y' end update_incumbents,
       case when p_partkey % 5 = 0 then 'Y' else 'N' end avail_telework_pos,
       case when p_partkey % 21 <> 0 then substring('1236ABC79D', cast(p_partkey % 10 as integer) + 1, 1) end manager_level
from part,
     (select 0 k, date '1994-01-01' effdt union all select 1 k, date '1998-01-01' effdt) v""",
    "hires": """
select cast(c_custkey as varchar) req_num,
       case when c_custkey % 8 = 0 then ' ' else lpad(cast(c_custkey as varchar), 6, '0') end emplid,
       c_name name,
       case c_custkey % 4 when 0 then 'Transfer' when 1 then 'FTE/Shift Changes' when 2 then 'Dual Employment' else ' ' end hire_comments,
       lpad(cast((c_custkey + 1) % 150 as varchar), 6, '0') mgr_id,
       lpad(cast(c_custkey % 4 as varchar), 4, '0') deptid,
       lpad(cast(c_custkey % 5 as varchar), 4, '0') jobcode,
       """ + _HOURS.format(k="c_custkey") + """ std_hours,
       cast(c_nationkey % 2 + 1 as varchar) shift,
       case when c_custkey % 7 = 0 then 'T' else 'R' end reg_temp,
       cast(c_acctbal as decimal(12,2)) hourly_rt,
       date '1999-01-01' start_date,
       'Manager ' || cast((c_custkey + 1) % 150 as varchar) mgr_name,
       case when c_custkey % 9 = 0 then null when c_custkey % 2 = 0 then 'N' else 'E' end flsa_status,
       case when c_custkey % 6 <> 0 then date '1985-01-01' + cast(c_custkey % 900 as integer) end prof_experience_dt
from customer""",
    "person_assignment": """
select lpad(cast(c_custkey as varchar), 6, '0') emplid, r.empl_rcd, 'EMP' per_org, r.empl_rcd org_instance_ern,
       cast(c_custkey % 3 as integer) benefit_rcd_nbr,
       case when c_custkey % 4 <> 0 then date '1985-01-01' + cast(c_custkey % 900 as integer) end prof_experience_dt,
       date '1986-01-01' + cast(c_custkey % 700 as integer) cmpny_seniority_dt,
       date '1987-01-01' + cast(c_custkey % 500 as integer) service_dt,
       case when c_custkey % 5 <> 0 then date '1988-01-01' + cast(c_custkey % 300 as integer) end seniority_pay_dt
from customer, (select cast(0 as integer) empl_rcd union all select 1) r
where c_custkey % 14 <> 0 or r.empl_rcd = 0""",
    "employees": """
select lpad(cast(c_custkey as varchar), 6, '0') emplid,
       r.empl_rcd,
       case when c_nationkey % 2 = 0 then '001' else '101' end company,
       'PG' || cast(c_nationkey % 3 as varchar) paygroup,
       case when c_custkey % 5 <> 0 and r.empl_rcd = 0 then 'P' else 'S' end job_indicator,
       case when (c_custkey + r.empl_rcd) % 4 = 0 then 'T' else 'R' end reg_temp,
       cast(12 * (1 + (c_custkey + r.empl_rcd) % 3) as decimal(6,2)) std_hours
from customer, (select 0 empl_rcd union all select 1) r
where c_acctbal >= 0""",
    "refund_pastes": """
select c_custkey paste_id,
       case when c_custkey % 5 = 0
            then row1 || ',,' || lpad(cast(c_custkey + 1 as varchar), 6, '0') || '|101|PARK|B|REF|5.25'
            else row1 end text
from (select c_custkey,
             '''' || lpad(cast(c_custkey as varchar), 6, '0') || '|001|' ||
             case when c_custkey % 19 = 0 then '' else 'PARK;' end ||
             '|"A"|REF|' || cast(cast(c_acctbal as decimal(12,2)) as varchar) row1
      from customer)""",
    "candidates": """
select case when o_orderkey % 3 = 0 then 'R' || cast(o_orderkey as varchar) else cast(o_orderkey as varchar) end req_num,
       case when o_orderkey % 25 = 0 then 'Y' else 'N' end load_status,
       cast(o_orderdate as date) hire_dt,
       lpad(cast(o_custkey as varchar), 6, '0') manager_id,
       lpad(cast(o_orderkey % 4 as varchar), 4, '0') deptid,
       lpad(cast(o_orderkey % 5 as varchar), 4, '0') jobcode,
       """ + _HOURS.format(k="o_orderkey") + """ std_hours,
       case when o_orderkey % 16 = 3 then lpad(cast(o_custkey + 900000000 as varchar), 9, '0')
            else lpad(cast(o_custkey * 7 as varchar), 9, '0') end national_id,
       case when o_orderkey % 11 <> 0 then cast(o_orderkey % 3 + 1 as varchar) end shift,
       case when o_orderkey % 7 = 0 then 'T' when o_orderkey % 7 <> 1 then 'R' end reg_temp,
       case when o_orderkey % 5 = 0 then 'RMOTE' else lpad(cast(o_orderkey % 3 as varchar), 4, '0') end location,
       '(' || lpad(cast(o_custkey % 1000 as varchar), 3, '0') || ') 555-' || lpad(cast(o_orderkey % 10000 as varchar), 4, '0') home_phone,
       case when o_orderkey % 4 = 0 then 'Message: matches ' || lpad(cast(o_custkey as varchar), 6, '0') else 'Message: none' end message_descr,
       cast(o_totalprice as decimal(12,2)) hourly_rt,
       'Last' || (o_custkey % 90) last_name, 'First' || (o_orderkey % 70) first_name, case when o_orderkey % 3 = 0 then 'M' end middle_name,
       case when o_orderkey % 15 <> 0 then date '1960-01-01' + cast(o_orderkey % 9000 as integer) end birthdate,
       (o_orderkey % 99) || ' Elm St' address1, case when o_orderkey % 4 = 0 then 'Apt 2' end address2, 'City' || (o_orderkey % 25) city,
       'S' || (o_orderkey % 50) state_number, lpad(cast(o_orderkey % 1000 as varchar), 5, '0') postal,
       '555-' || lpad(cast(o_orderkey % 7919 as varchar), 4, '0') || ' x' work_phone,
       case when o_orderkey % 6 <> 0 then '+1 ' || lpad(cast(o_orderkey % 6007 as varchar), 7, '0') end mobile_phone,
       'c' || o_orderkey || '@example.net' email_addr, 'Role ' || (o_orderkey % 12) descr100,
       case when o_orderkey % 2 = 0 then 'N' else 'E' end flsa_status, case when o_orderkey % 5 = 1 then 'Days' else 'Nights' end scheduled,
       case o_orderkey % 3 when 0 then 'F' when 1 then 'P' else 'C' end full_part_time,
       case when o_orderkey % 10 = 0 then lpad(cast(o_orderkey as varchar), 10, '0') end alter_emplid,
       case when o_orderkey % 4 = 0 then 'New Hire' else 'Rehire' end hire_comments,
       case when o_orderkey % 9 <> 0 then strftime(cast(o_orderdate as date), '%Y-%m-%d') end datein_prefix
from orders""",
    "names_hist": """
select lpad(cast(p_partkey // 2 as varchar), 6, '0') emplid,
       case when p_partkey % 2 = 0 then 'PRI' else 'LEG' end name_type,
       cast(case when p_partkey % 2 = 0 then 1 else 2 end as integer) order_by_seq,
       p_name || ' ' || lower(p_type) name
from part""",
    "names_searched": """
select distinct replace(p_name || ' ' || p_type, 'e', 'i') name_searched
from part""",
    "jobcode_tbl": """
select case when s_suppkey % 7 = 6 then 'OTHER' else 'SHARE' end setid,
       lpad(cast(s_suppkey % 5 as varchar), 4, '0') jobcode,
       cast(date '1990-01-01' + cast(floor(s_suppkey / 5) * 30 as integer) as date) effdt,
       substring('1236ABC79D', cast(s_suppkey % 10 as integer) + 1, 1) manager_level,
       'P' || cast(s_suppkey % 2 as varchar) sal_admin_plan,
       lpad(cast(s_suppkey % 9 as varchar), 3, '0') grade,
       case s_suppkey % 3 when 0 then '73' when 1 then '399' else 'NON' end union_cd,
       'B' || cast(s_suppkey % 8 as varchar) job_family, 'Job ' || s_suppkey descr, 'Job number ' || s_suppkey descr50
from supplier""",
    "dept_tbl": """
select case when s_suppkey % 7 = 6 then 'OTHER' else 'SHARE' end setid,
       lpad(cast(s_suppkey % 4 as varchar), 4, '0') deptid,
       cast(date '1990-01-01' + cast(floor(s_suppkey / 4) * 45 as integer) as date) effdt,
       'BU' || cast(cast(floor(s_suppkey / 4) as bigint) % 2 as varchar) business_unit, 'Department ' || s_suppkey descr
from supplier""",
    "pers_nid": """
select lpad(cast(c_custkey as varchar), 6, '0') emplid, 'USA' country, 'PR' national_id_type,
       lpad(cast(c_custkey * 7 + case when c_custkey % 10 = 9 then 1 else 0 end as varchar), 9, '0') national_id
from customer
union all
select lpad(cast(c_custkey as varchar), 6, '0'), 'USA', 'PR', lpad(cast(c_custkey + 900000000 as varchar), 9, '0')
from customer where c_custkey % 12 = 0""",
    "person_data": """
select lpad(cast(c_custkey as varchar), 6, '0') emplid,
       case when c_custkey % 17 <> 0 then date '1950-01-01' + cast(c_custkey % 9000 as integer) end birthdate
from customer""",
    "phones": """
select lpad(cast(c_custkey as varchar), 6, '0') emplid, t.phone_type, '555' || lpad(cast(c_custkey as varchar), 7, '0') || t.mark phone
from customer, (values ('HOME', 'H'), ('CELL', 'C'), ('CELL', 'C2')) t(phone_type, mark)
where (t.mark = 'H' and c_custkey % 3 <> 0) or (t.mark = 'C' and c_custkey % 2 = 0) or (t.mark = 'C2' and c_custkey % 20 = 0)""",
    "addresses": """
select lpad(cast(c_custkey as varchar), 6, '0') emplid, 'HOME' address_type, (c_custkey % 99) || ' Main St' address1,
       'City' || c_nationkey city, lpad(cast(c_custkey % 1000 as varchar), 5, '0') postal,
       case when c_custkey % 8 = 1 then 'Unit 7' end address2, 'County' || (c_custkey % 30) county, 'S' || (c_custkey % 50) state
from customer where c_custkey % 4 <> 0""",
    "user_ids": """
select lpad(cast(c_custkey as varchar), 6, '0') emplid, 'U' || c_custkey oprid from customer where c_custkey % 5 <> 0""",
    "emails": """
select lpad(cast(c_custkey as varchar), 6, '0') emplid, case when c_custkey % 5 = 0 then 'HOME' else 'BUSN' end e_addr_type,
       case when c_custkey % 23 = 0 then 'not-an-email' else lower(replace(c_name, '#', '.')) || '@example.org' end email_addr
from customer""",
    "location_tbl": """
select case when s_suppkey % 7 = 6 then 'OTHER' else 'SHARE' end setid, lpad(cast(s_suppkey % 3 as varchar), 4, '0') location,
       cast(date '1990-01-01' + cast(floor(s_suppkey / 3) * 20 as integer) as date) effdt, s_name descr, 'B' || (s_suppkey % 11) building,
       'AC' || (s_suppkey % 13) descr_ac, 'G' || (s_suppkey % 17) geo_code
from supplier""",
    "names": """
select lpad(cast(c_custkey + r.next as varchar), 6, '0') emplid, 'PRI' name_type, case when r.next = 0 then date '1990-01-01' else date '1996-01-01' end effdt,
       c_name name_display, string_split(c_name, '#')[-1] last_name, string_split(c_name, '#')[1] first_name,
       case when c_nationkey % 3 = 0 then 'Q' end middle_name,
       (['hot', 'old', 'blue', 'large', 'cold', 'small'])[c_custkey % 6 + 1] || ' ' ||
       (['ring large', 'bolt economy', 'ring small', 'plate standard', 'plate economy'])[(c_custkey // 3) % 5 + 1] name_psformat
from customer, (values (0), (1)) r(next) where r.next = 0 or c_custkey % 10 = 3""",
}


def with_fixtures(sql: str, *names: str, extra: str = "") -> str:
    """``with <fixture CTEs>[, <extra CTEs>] <sql>``."""
    ctes = [f"{n} as ({FIXTURE_SQL[n]}\n)" for n in names]
    if extra.strip():
        ctes.append(extra.strip().rstrip(","))
    return "with " + ",\n".join(ctes) + "\n" + sql
