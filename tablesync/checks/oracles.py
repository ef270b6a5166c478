"""The same results in SQL, for the check against DuckDB."""

from __future__ import annotations

from tablesync.config import TENANT_INITIALS

INITIALS = ", ".join(f"'{letter}'" for letter in TENANT_INITIALS)

VIEWS = {
    "src_catalog": """
select concat('app', cast(o_custkey % 50 as string)) as table_schema,
       concat('tbl_', cast(o_orderkey as string)) as table_name,
       case when o_orderstatus = 'P' then 'VIEW' else 'BASE TABLE' end as table_type
from orders
""",
    "wh_tables": """
select upper(concat('app', cast(o_custkey % 50 as string))) as table_schema,
       upper(concat('tbl_', cast(o_orderkey as string))) as table_name
from orders where o_orderkey % 10 <> 0
""",
    "wh_columns": """
select table_schema, table_name, c.column_name, c.data_type
from wh_tables cross join (
  select 'ID' as column_name, 'NUMBER' as data_type union all
  select 'NAME', 'TEXT' union all select 'UPDATED_AT', 'TIMESTAMP_NTZ') c
""",
    "landing": """
select event_id, concat('events/', upper(event_type), '/u', cast(user_id as string), '/',
       cast(event_id as string), '.parquet') as path
from events
""",
    "control": """
select distinct event_type as app_id, event_type in ('click', 'view', 'error') as flag
from events where event_type <> 'signup'
""",
    "run_log": """
select event_type as app_id, concat('u', cast(user_id as string)) as table_name,
       case when event_type <> 'view' and value > 255 then 'failed' else 'ok' end as status,
       case when event_type <> 'view' and value > 300 then 'String is too long and would be truncated'
            when event_type <> 'view' and value > 255 then 'connection reset' end as message
from events where event_type in ('click', 'view', 'error')
""",
    "target_snapshot": """
select c_custkey as id, c_acctbal as amount, cast(null as string) as last_type
from customer where c_custkey % 3 <> 0
""",
    "changes": """
select user_id as id, value as amount, event_type as last_type, ts, event_id as seq,
       case when event_type = 'error' then 'D' when event_type = 'signup' then 'I' else 'U' end as op
from events
""",
    "src_rows": """
select o_orderkey as id, o_totalprice as amount from orders where o_orderkey % 7 <> 0
""",
    "tgt_rows": """
select o_orderkey as id, case when o_orderkey % 11 = 0 then o_totalprice + 1 else o_totalprice end as amount
from orders where o_orderkey % 13 <> 0
""",
}

STATEMENTS = {
    "catalog_snapshot": """
select table_schema as src_schema, table_name as src_table, '' as tgt_schema, '' as tgt_table
from src_catalog
where table_schema <> 'app7' and table_type <> 'VIEW'
  and table_name in ('tbl_1', 'tbl_2', 'tbl_3', 'tbl_4', 'tbl_5', 'tbl_6', 'tbl_7', 'tbl_8', 'tbl_9')
""",
    "missing_tables": """
select schema_name, table_name
from (select distinct table_schema as schema_name, table_name from src_catalog) wanted
where not exists (
  select 1 from (select distinct upper(table_schema) as s, upper(table_name) as n from wh_tables) present
  where present.s = upper(wanted.schema_name) and present.n = upper(wanted.table_name))
""",
    "column_catalog": """
select distinct lower(c.table_schema) as table_schema, lower(c.table_name) as table_name,
       lower(c.column_name) as column_name, lower(c.data_type) as data_type
from wh_columns c
where upper(c.table_schema) in (select distinct upper(table_schema) from src_catalog where table_type <> 'VIEW')
  and c.table_name <> 'TBL_1'
""",
    "available_tables": """
select distinct concat_ws('.', lower(table_schema), lower(table_name)) as formatted_name from wh_columns
""",
    "group_tables": """
select upper(table_schema) as schema_name, count(*) as n_tables,
       min(concat(table_schema, '.', table_name)) as first_table
from src_catalog group by upper(table_schema)
""",
    "landing_index": """
select lower(split_part(path, '/', 2)) as schema_name, lower(split_part(path, '/', 3)) as table_name,
       count(*) as n_files, min(path) as first_path
from landing group by 1, 2
""",
    "initial_filter": f"""
select schema_name, count(*) as n_files
from (select split_part(path, '/', 2) as schema_name from landing) t
where upper(substr(schema_name, 1, 1)) in ({INITIALS})
group by schema_name
""",
    "batch_assign": """
select schema_name, cast(floor((dense_rank() over (order by schema_name) - 1) / 2.0) as int) as batch_id
from (select distinct split_part(path, '/', 2) as schema_name from landing) t
""",
    "batch_members": """
select l.event_id, l.path from landing l
where split_part(l.path, '/', 2) in (select upper(app_id) from control where flag = true)
""",
    "latest_change": """
select id, amount, last_type, op from (
  select *, row_number() over (partition by id order by ts desc, seq desc) as rn from changes) t
where rn = 1
""",
    "apply_changes": """
with l as (select * from (
  select *, row_number() over (partition by id order by ts desc, seq desc) as rn from changes) t where rn = 1)
select coalesce(s.id, l.id) as id,
       case when l.id is not null then l.amount else s.amount end as amount,
       case when l.id is not null then l.last_type else s.last_type end as last_type
from target_snapshot s full join l on s.id = l.id
where l.op is null or l.op <> 'D'
""",
    "insert_if_absent": """
select app_id, flag from control
union all
select t.app_id, cast(null as boolean) as flag
from (select distinct event_type as app_id from events) t
where not exists (select 1 from control c where c.app_id = t.app_id)
""",
    "fullload_plan": """
select c.app_id, t.table_name
from (select distinct lower(app_id) as app_id from control where flag = true) c
cross join (select distinct lower(table_name) as table_name from src_catalog
            where table_name in ('tbl_1', 'tbl_2', 'tbl_3', 'tbl_4', 'tbl_5')) t
""",
    "clear_flags": """
select c.app_id, case when c.flag and coalesce(r.n_failed, 0) = 0 then false else c.flag end as flag
from control c left join (
  select app_id, count(*) as n_failed from run_log where status = 'failed' group by app_id) r
on c.app_id = r.app_id
""",
    "run_summary": """
select app_id, count(*) as n_runs, count(case when status = 'failed' then 1 end) as n_failed,
       count(case when message like '%too long and would be truncated%' then 1 end) as n_too_long
from run_log group by app_id
""",
    "union_catalogs": """
select table_schema, table_name from wh_tables
union all
select table_schema, table_name from src_catalog
""",
    "reconcile_counts": """
select upper(a.table_schema) as schema_name, count(*) as n_source, count(b.table_name) as n_target
from src_catalog a left join wh_tables b
  on upper(a.table_schema) = b.table_schema and upper(a.table_name) = b.table_name
group by upper(a.table_schema)
""",
    "reconcile_rows": """
select coalesce(a.id, b.id) as id,
       case when b.id is null then 'missing' when a.id is null then 'extra' else 'changed' end as diff
from src_rows a full join tgt_rows b on a.id = b.id
where a.id is null or b.id is null or a.amount is distinct from b.amount
""",
    "overlength": """
select lang, count(*) as n_over, cast(max(length(text)) as bigint) as max_len
from documents where length(text) > 2000 group by lang
""",
    "catalog_by_sql": """
select table_schema as src_schema, table_name as src_table, table_type
from src_catalog where table_schema <> 'app7' and table_type <> 'VIEW'
""",
    "split_available": """
select a.table_schema, a.table_name, a.table_type,
       case when exists (
         select 1 from wh_tables b
         where b.table_schema = upper(a.table_schema) and b.table_name = upper(a.table_name))
       then 'target' else 'quarantine' end as place
from src_catalog a
""",
    "identifiers": """
select concat(table_schema, '.', table_name) as full_name,
       concat('"', upper(table_schema), '"."', upper(table_name), '"') as quoted_name,
       table_schema as schema_name, table_name
from src_catalog
""",
    "stamped_orders": """
select o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as order_time,
       '2024-01-31 12:30:00' as run_ts
from orders
""",
    "landing_files": """
select distinct concat('schema_name=app', cast(id % 5 as varchar)) as schema_name,
       'table_name=changes' as table_name
from changes
""",
    "align_changes": """
select cast(id as int) as id, amount, cast(seq as varchar) as seq, cast(null as varchar) as note
from changes
""",
    "reconcile_schema": """
with s as (
  select lower(table_schema) as table_schema, lower(table_name) as table_name,
         lower(column_name) as column_name, lower(data_type) as source_type
  from wh_columns where not (table_name like '%7' and column_name = 'NAME')),
t as (
  select lower(table_schema) as table_schema, lower(table_name) as table_name,
         lower(column_name) as column_name,
         case when table_name like '%5' and column_name = 'NAME' then 'variant'
              else lower(data_type) end as target_type
  from wh_columns where not (table_name like '%3' and column_name = 'ID'))
select table_schema, table_name, column_name, source_type, target_type,
       case when target_type is null then 'missing' when source_type is null then 'extra'
            else 'type' end as diff
from s full join t using (table_schema, table_name, column_name)
where source_type is distinct from target_type
""",
    "missing_load": """
select concat('app', cast(o_custkey % 50 as varchar)) as schema_name,
       concat('orders_', lower(o_orderstatus)) as table_name,
       o_orderkey as id, o_totalprice as amount
from orders where o_custkey % 50 >= 40
""",
    "full_load_log": """
with flagged as (
  select distinct concat('app', cast(o_custkey % 50 as varchar)) as app_id from orders
  where o_custkey % 50 % 3 = 0)
select app_id, table_name, 'ok' as status from flagged
cross join (select 'orders_f' as table_name union all select 'orders_o' union all select 'orders_p') n
union all
select distinct concat('app', cast(o_custkey % 50 as varchar)), 'control', 'false' from orders
""",
}

STATEMENTS["landing_changes"] = """
select concat('schema_name=app', cast(id % 5 as varchar)) as schema_name,
       'table_name=changes' as table_name, id, seq, op
from changes
"""
STATEMENTS["control_rewrite"] = """
select t.app_id,
       case when c.flag and coalesce(r.n_failed, 0) = 0 then false else c.flag end as flag
from (select distinct event_type as app_id from events) t
left join control c on c.app_id = t.app_id
left join (
  select app_id, count(*) as n_failed from run_log where status = 'failed' group by app_id) r
on r.app_id = t.app_id
"""

STATEMENTS["partial_changes"] = """
with l as (select * from (
  select *, row_number() over (partition by id order by ts desc, seq desc) as rn from changes) t where rn = 1)
select concat('app', cast(coalesce(s.id, l.id) % 5 as varchar)) as schema_name, coalesce(s.id, l.id) as id,
       case when l.id is not null then l.amount else s.amount end as amount,
       case when s.id is not null then 'loaded' end as last_type
from target_snapshot s full join l on s.id = l.id
where l.op is null or l.op <> 'D'
"""
STATEMENTS["tied_changes"] = """
with l as (select * from (
  select *, row_number() over (partition by id order by amount desc, op = 'D' desc, last_type desc) as rn
  from changes) t where rn = 1)
select way, id, amount, last_type
from l cross join (select 'memory' as way union all select 'whole' union all select 'split') w
where op <> 'D'
"""
STATEMENTS["quarantine_rows"] = """
select concat('schema_name=app', cast(id % 5 as varchar)) as schema_name, table_name, id, seq
from changes cross join (select 'table_name=one' as table_name union all select 'table_name=two') t
where id % 5 not in (0, 1)
"""

STATEMENTS["routed_changes"] = """
with named as (
  select *, case when last_type = 'click' then 'table_name=clicks' else 'table_name=others' end as table_name from changes),
l as (select * from (
  select *, row_number() over (partition by table_name, id order by ts desc, seq desc) as rn from named) t where rn = 1)
select table_name, concat('schema_name=app', cast(id % 5 as varchar)) as schema_name, id, last_type, seq
from l where op <> 'D'
union all
select 'table_name=all_data', concat('schema_name=app', cast(id % 5 as varchar)), id, last_type, seq from changes
"""

STATEMENTS["reconcile_checksums"] = """
with keyed as (select o_orderkey as id, concat('app', cast(o_custkey % 50 as varchar)) as schema_name from orders)
select schema_name, id, 'missing' as diff from keyed where id % 997 = 0
union all
select schema_name, id, 'changed' from keyed where id % 991 = 0 and id % 997 <> 0
union all
select schema_name, -id, 'extra' from keyed where id % 983 = 0 and id > 0
"""

STATEMENTS["staged_publish"] = """
with held as (
  select concat('app', cast(o_custkey % 50 as varchar)) as app_id, o_totalprice as amount,
         o_custkey % 50 = 5 or (o_custkey % 50 = 3 and count(case when o_orderkey % 7 = 0 then 1 end)
           over (partition by o_custkey % 50) > 0) as kept
  from orders)
select app_id, count(*) as n_rows, max(case when kept then 0.0 else amount end) as most,
       case when kept then 'old' else 'new' end as note, case when kept then 'failed' else 'ok' end as status, kept as flag
from held group by app_id, kept
"""

STATEMENTS["bookmark_reads"] = """
select concat('app', cast(user_id % 5 as varchar)) as schema_name, event_id as id, value as amount from events
"""

STATEMENTS["weighted_batches"] = """
with w as (
  select concat('app', cast(o_custkey % 50 as varchar)) as schema_name,
         sum(case when o_custkey % 50 = 7 then 40 else 1 end) as weight from orders group by 1),
t as (select sum(weight) as total, greatest(1, ceil(sum(weight) / 48.0)) as most from w),
p as (select schema_name, weight, cast(greatest(ceil(weight / most), 1) as bigint) as n_pieces, total from w cross join t),
c as (select schema_name, n_pieces, total, piece, cast(weight * (piece + 1) // n_pieces - weight * piece // n_pieces as bigint) as weight
      from (select *, unnest(range(0, n_pieces)) as piece from p)),
b as (select *, coalesce(sum(weight) over (order by weight desc, schema_name, piece
        rows between unbounded preceding and 1 preceding), 0) as before from c)
select schema_name, piece, n_pieces, weight, cast(least(before * 6 // total, 5) as int) as batch_id from b
"""
STATEMENTS["run_history"] = """
with logs as (
  select event_type as app_id, concat('u', cast(user_id as varchar)) as table_name, event_id % 3 as n,
         case when max(value) > 255 then 'failed' else 'ok' end as status
  from events group by 1, 2, 3)
select app_id, table_name, status, concat('run', cast(9 - n as varchar)) as run, status = 'failed' as again
from (select *, row_number() over (partition by app_id, table_name order by n desc) as rn from logs) r where rn = 1
"""

STATEMENTS["declared_types"] = """
select concat('schema_name=app', cast(id % 3 as varchar)) as schema_name, id,
       cast(cast(case when id % 3 = 1 then cast(amount as decimal(12,3)) else trunc(amount) end as decimal(22,3)) as varchar) as total
from (select *, row_number() over (partition by id order by seq desc) as rn from changes) c where rn = 1
"""

# Other ways to the result of a statement above.
STATEMENTS["ledger_changes"] = STATEMENTS["routed_changes"]
STATEMENTS["late_changes"] = STATEMENTS["apply_changes"]
STATEMENTS["reconcile_hashed"] = STATEMENTS["reconcile_rows"]
STATEMENTS["merge_table"] = f"""
select concat('app', cast(id % 5 as varchar)) as schema_name, id, amount, last_type
from ({STATEMENTS["apply_changes"]}) r
"""
STATEMENTS["split_buckets"] = STATEMENTS["merge_table"]
STATEMENTS["stream_changes"] = f"""
select concat('schema_name=app', cast(id % 5 as varchar)) as schema_name, id, amount, last_type
from ({STATEMENTS["apply_changes"]}) r
"""

_WITH = ", ".join(f"{name} as ({text})" for name, text in VIEWS.items())

ORACLES = {
    name: f"with {_WITH} select * from ({statement}) q" for name, statement in STATEMENTS.items()
}
