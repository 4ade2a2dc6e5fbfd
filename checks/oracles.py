"""The SQL that must give the rows of each query, for an independent engine on the same tables."""

from __future__ import annotations

VIEWS = {
    "tgt_single": """
        select o_orderkey as id, o_custkey as cust_id, o_totalprice as amount,
               o_orderdate as last_modified,
               case when o_orderkey % 11 = 0 then '1' when o_orderkey % 97 = 1 then null else '0' end
                 as is_deleted,
               o_orderstatus as partition_key, '20240101000000' as _hoodie_commit_time,
               cast(o_orderkey as varchar(20)) as _hoodie_record_key
        from orders""",
    "src_single": """
        select o_orderkey as id from orders where o_orderkey % 13 <> 5
        union all select o_orderkey + 1000000 as id from orders where o_orderkey % 5 = 0""",
    "pair_latest": """
        select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate, l_returnflag
        from (select *, row_number() over (partition by l_orderkey, l_linenumber
                order by l_shipdate desc, l_partkey desc, l_suppkey desc) as rn from lineitem) t
        where rn = 1""",
    "tgt_pair": """
        select l_orderkey as transaction_id, l_linenumber as transaction_line_id, l_partkey, l_suppkey,
               l_quantity, l_shipdate as date_last_modified_gmt,
               case when l_orderkey % 11 = 0 then '1' else '0' end as is_deleted,
               l_returnflag as partition_key
        from pair_latest""",
    "src_pair": """
        select distinct l_orderkey as transaction_id, l_linenumber as transaction_line_id
        from lineitem where (l_orderkey * 7 + l_linenumber) % 13 <> 5""",
    "src_text": """
        select case when o_orderkey % 2 = 0 then 'it''s' when o_orderkey % 53 = 0 then null
                    else o_orderpriority || (o_orderkey % 7) end as code,
               o_orderkey / 4.0 as line, cast(o_orderdate as date) as day
        from orders""",
    "src_pair_short": "select * from src_pair where transaction_id % 11 <> 0",
    "tgt_five": """
        select l_orderkey as k1, l_linenumber as k2, l_partkey as k3, nullif(l_suppkey % 10, 0) as k4,
               l_returnflag as k5, l_shipdate as date_last_modified, '0' as is_deleted,
               l_linestatus as partition_key
        from lineitem""",
    "src_five": "select k1, k2, k3, k4, k5 from tgt_five where k1 % 17 <> 3",
    "ev_base": """
        select event_id, ts, user_id, event_type, 'base' as origin
        from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn
              from events where event_id % 2 = 0) t where rn = 1""",
    "ev_upd": """
        select event_id, ts, user_id, event_type, 'update' as origin
        from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn
              from events where event_id % 2 = 1 or event_id % 3 = 0) t where rn = 1""",
    "old_columns": """
        select concat('order_', l_orderkey) as table_name, concat('line_', l_linenumber) as column_name,
               l_returnflag as type_name from pair_latest""",
    "new_columns": """
        select concat('order_', l_orderkey) as table_name,
               concat('line_', l_linenumber, case when l_quantity < 5 then '_x' else '' end)
                 as column_name,
               case when l_quantity > 40 then 'string' else l_returnflag end as type_name
        from pair_latest where not (l_quantity between 10 and 12)""",
    "compared": """
        select coalesce(o.table_name, n.table_name) as table_name,
               coalesce(o.column_name, n.column_name) as column_name,
               o.type_name as expected, n.type_name as got
        from old_columns o full join new_columns n
          on o.table_name = n.table_name and o.column_name = n.column_name""",
}

_EQUAL = {
    "single": "s.id = t.id",
    "pair": "s.transaction_id = t.transaction_id and s.transaction_line_id = t.transaction_line_id",
    "five": " and ".join(f"s.k{i} = t.k{i}" for i in range(1, 6)),
}
_SAME_FIVE = " and ".join(f"s.k{i} is not distinct from t.k{i}" for i in range(1, 6))
_BARE = "id, cust_id, amount, last_modified, is_deleted, partition_key"


def _with(query: str) -> str:
    views = ", ".join(f"{name} as ({body})" for name, body in VIEWS.items())
    return f"with {views} {query}"


def _gone(name: str, source: str | None = None, equal: str | None = None) -> str:
    """The condition that row ``t`` of a target is active and its key is not in the source."""
    return (
        f"t.is_deleted <> '1' and not exists "
        f"(select 1 from {source or 'src_' + name} s where {equal or _EQUAL[name]})"
    )


def _missing(name: str, columns: str = "*", equal: str | None = None) -> str:
    return (
        f"select {columns} replace ('1' as is_deleted) from tgt_{name} t where {_gone(name, equal=equal)}"
    )


def _gate(name: str, source: str) -> str:
    return f"""
        select d as count_diff, d > 0 as gate_open, case when d > 0 then u else 0 end as update_rows
        from (select (select count(*) from {source})
                   - (select count(*) from tgt_{name} where is_deleted <> '1') as d,
                     (select count(*) from tgt_{name} t where {_gone(name, source)}) as u)"""


def _counts(name: str) -> str:
    return f"""
        (select count(*) from src_{name}) as source_count,
        (select count(*) from tgt_{name} where is_deleted <> '1') as target_count"""


def _summary(name: str) -> str:
    return f"""
        select '{name}' as table_name, {_counts(name)},
               (select count(*) from tgt_{name} t where {_gone(name)}) as missing_count"""


_SPREAD = "(abs(transaction_id % 10) + abs(transaction_line_id % 10)) % 10"
_META = "exclude (_hoodie_commit_time, _hoodie_record_key)"
_PER_PARTITION = "select partition_key, count(*) as n from tgt_single group by partition_key"

ORACLES: dict[str, str] = {
    name: _with(query)
    for name, query in {
        "project_source_keys": "select id from src_single",
        "source_key_parts": f"""
            select cast({_SPREAD} as integer) as part, count(*) as n from src_pair group by 1""",
        "source_key_bounds": """
            select min(transaction_id) as lo, max(transaction_id) as hi, count(*) as n from src_pair""",
        "source_key_quantiles": """
            select tile as part, count(*) as n
            from (select ntile(10) over (order by transaction_id, transaction_line_id) as tile from src_pair)
            group by tile""",
        "source_text_quantiles": """
            select case when code is null then 0 else tile end as part, count(*) as n
            from (select code, ntile(10) over (partition by code is null order by code, line, day) as tile from src_text)
            group by 1""",
        "csv_snapshot_scan": "select conv_id, turn, role, text from conversations",
        "csv_snapshot_split": "select conv_id, turn, role, text from conversations",
        "target_active_scan": "select * from tgt_single where is_deleted <> '1'",
        "table_config": """
            , entries as (
              select concat('order_', o_orderkey) as table_name, o_orderstatus as integration,
                     concat(' o', o_custkey, ',,', o_orderpriority, ' , ') as names from orders
              union all
              select concat('customer_', o_orderkey), null,
                     case when o_orderstatus = 'F' then concat('c', o_custkey) else '' end from orders),
            lists as (
              select table_name, integration, list_filter(list_transform(string_split(names, ','),
                     lambda x: trim(x)), lambda x: x <> '') as keys from entries)
            select table_name, integration, cast(unnest(range(len(keys))) as integer) as key_pos,
                   unnest(keys) as key_name from lists""",
        "flag_three_valued": """
            select is_deleted, count(*) as n from tgt_single where is_deleted <> '1' group by is_deleted""",
        "derived_names": """
            select c_name as table_name, concat(lower(c_mktsegment), '_', c_name) as target_name,
                   concat('env', c_nationkey, '_replica') as database_name,
                   concat('s3://warehouse-env', c_nationkey, '/', lower(c_mktsegment), '/', c_name, '/')
                     as path
            from customer""",
        "drop_meta_columns": f"select {_BARE} from tgt_single",
        "stringify_columns": """
            select cast(id as varchar) as id, cast(cast(amount as decimal(18,2)) as varchar) as amount,
                   cast(last_modified as varchar) as last_modified, is_deleted from tgt_single""",
        "null_fill_missing": """
            select id, cust_id, is_deleted from tgt_single
            union all select id, null, null from src_single""",
        "left_join_flagged": """
            select t.id, t.is_deleted,
                   case when s.id is null then '1' else t.is_deleted end as is_deleted_new
            from tgt_single t left join src_single s on s.id = t.id where t.is_deleted <> '1'""",
        "missing_in_source_single": _missing("single", f"* {_META}"),
        "missing_in_source_bitmap": f"select distinct id from tgt_single t where {_gone('single')}",
        "missing_in_source_pair": _missing("pair"),
        "missing_in_source_pair_wide": _missing("pair"),
        "missing_in_source_pair_by_key": _missing("pair"),
        "missing_in_source_five": _missing("five"),
        "missing_in_source_five_wide": _missing("five"),
        "missing_in_source_five_by_key": _missing("five"),
        "missing_in_source_five_nullsafe": _missing("five", equal=_SAME_FIVE),
        "missing_in_source_five_nullsafe_by_key": _missing("five", equal=_SAME_FIVE),
        "run_counts": f"""
            select source_count, target_count, source_count - target_count as count_diff
            from (select {_counts("single")})""",
        "gate_open": _gate("single", "src_single"),
        "gate_closed": _gate("pair", "src_pair_short"),
        "column_diff": """
            select table_name, case when got is null then 'missing' else 'extra' end as kind, column_name
            from compared where (got is null or expected is null) and table_name in (
              select table_name from compared group by table_name having count(expected) <> count(got))""",
        "schema_diff": """
            select table_name,
                   case when got is null then concat('missing column ', column_name)
                        when expected is null then concat('extra column ', column_name)
                        else concat(column_name, ' type mismatch (expected ', expected, ', got ', got, ')')
                   end as mismatch
            from compared where expected is distinct from got""",
        "latest_wins_pair": "select * from pair_latest",
        "upsert_events": """
            select event_id, ts, user_id, event_type, origin from (
              select *, row_number() over (partition by user_id order by ts desc, origin desc) as rn
              from (select * from ev_base union all select * from ev_upd)) where rn = 1""",
        "upsert_keeps_partition": f"""
            select id, case when {_gone("single")} then '1' else is_deleted end as is_deleted,
                   partition_key from tgt_single t""",
        "upsert_soft_delete": f"""
            select id, cust_id, amount, last_modified,
                   case when {_gone("single")} then '1' else is_deleted end as is_deleted, partition_key
            from tgt_single t""",
        "upsert_switched": f"""
            select id, cust_id, amount, last_modified,
                   case when {_gone("single")} then '1' else is_deleted end as is_deleted, partition_key
            from tgt_single t""",
        "upsert_by_index": f"""
            select id, cust_id, amount, last_modified,
                   case when {_gone("single")} then '1' else is_deleted end as is_deleted, partition_key
            from tgt_single t""",
        "partitioned_publish": _PER_PARTITION,
        "catalog_publish": _PER_PARTITION,
        "audit_record": f"""
            select 'single2024-01-31 06:30:00' as soft_delete_key, 'single' as source_table_name,
                   'single' as target_table_name, source_count as source_table_count,
                   target_count as target_table_count, source_count - target_count as record_count_diff,
                   'Completed' as status, '2024-01-31 06:30:00' as last_run_ts, 'run-1' as job_run_id
            from (select {_counts("single")})""",
        "soft_delete_end_to_end": f"""
            select transaction_id, transaction_line_id,
                   case when {_gone("pair")} then '1' else is_deleted end as is_deleted, partition_key
            from tgt_pair t""",
        "reconcile_by_digests": f"""
            select transaction_id, transaction_line_id,
                   case when {_gone("pair")} then '1' else is_deleted end as is_deleted, partition_key
            from tgt_pair t""",
        "reconcile_evolved_files": f"""
            select id, case when id % 2 = 1 then amount end as amount,
                   case when {_gone("single")} then '1' else is_deleted end as is_deleted, partition_key
            from tgt_single t""",
        "widened_files_scan": """
            select o_orderkey as id, o_custkey as cust_id, o_orderstatus as partition_key,
                   'decimal(20,0)/decimal(18,4)/string' as kinds from orders""",
        "reconcile_all_audited": " union all ".join(
            f"""select '{name}' as source_table_name, source_count as source_table_count,
                   target_count as target_table_count, source_count - target_count as record_count_diff,
                   'Completed' as status from (select {_counts(name)})"""
            for name in ("single", "pair", "five")
        ),
        "reconcile_all_configured": " union all ".join(map(_summary, ("single", "pair", "five"))),
    }.items()
}
