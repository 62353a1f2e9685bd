"""The same queries as ANSI SQL over the driver's tables."""

from __future__ import annotations

from collections.abc import Sequence

from tidemark.plans.queries import (
    AGES,
    AUDITED_STATUSES,
    EVENTS_FROM,
    EVENTS_UNTIL,
    FIRST_LOAD,
    KEPT_SINCE,
    OLDEST_AUDITED,
    REGISTRY_ROOT,
    SECOND_LOAD,
    SILVER_UNTIL,
    WATERMARK,
    WINDOW_END,
)


def ts(value: str) -> str:
    return f"timestamp '{value}'"


def hashed(columns: Sequence[str]) -> str:
    parts = [
        rf"coalesce(replace(replace(cast({c} as varchar), '\', '\\'), '|', '\|'), '\N')" for c in columns
    ]
    return f"md5(concat_ws('|', {', '.join(parts)}))"


def numbered(columns: Sequence[str], last: str = "0") -> str:
    """Surrogate keys: row numbers by hash bucket, after the last key given out before."""
    order = ", ".join(columns)
    return f"row_number() over (order by substr({hashed(columns)}, 1, 4), {order}) + {last}"


USERS_FROM = """
    select c_custkey as id, c_name as name, cast(c_custkey % 120 as integer) as age, c_mktsegment as address,
           timestamp '1995-01-01 00:00:00' + to_hours(c_custkey) as created_at, cast(null as timestamp) as updated_at
    from customer
"""
UPDATED_FROM = """
    select c_custkey as id, c_name as name, cast(c_custkey % 120 as integer) as age, 'COLLECTIONS' as address,
           timestamp '1995-01-01 00:00:00' + to_hours(c_custkey) as created_at,
           timestamp '1995-01-01 00:00:00' + to_hours(c_custkey) + interval 30 day as updated_at
    from customer where c_acctbal < 0
"""
BASE = f"""
    src_users as ({USERS_FROM}),
    src_users_in_credit as ({USERS_FROM} where c_acctbal >= 0),
    src_users_updated as ({UPDATED_FROM}),
    src_users_last as (select * from src_users_in_credit union all select * from src_users_updated),
    src_orders as (
        select o_orderkey as id, o_custkey as id_user, cast(floor(o_totalprice) as bigint) as spent,
               case o_orderstatus when 'O' then 'processing' when 'F' then 'shipped' else 'pending' end as status,
               o_orderdate as created_at,
               case when o_orderstatus = 'F' then o_orderdate + interval 7 day end as updated_at
        from orders
    ),
    src_first_seen as (
        select id, id_user, spent, 'processing' as status, created_at, cast(null as timestamp) as updated_at
        from src_orders
    ),
    src_updated as (select * from src_orders where status = 'shipped'),
    src_as_of as (
        select id, id_user, spent,
               case when updated_at > {ts(WATERMARK)} then 'processing' else status end as status,
               created_at,
               case when updated_at <= {ts(WATERMARK)} then updated_at end as updated_at
        from src_orders where created_at <= {ts(WATERMARK)}
    )
"""

ORDER_COLUMNS = ("id", "id_user", "spent", "status", "created_at", "updated_at")
ORDER_TEXT = (
    "id, id_user, spent, status, cast(created_at as varchar) as created_at, cast(updated_at as varchar) as updated_at"
)


def tags(entity: str) -> str:
    return f"'1_0' as schema_version, '{entity}' as schema_name"


def schema_url(entity: str) -> str:
    return f"'{REGISTRY_ROOT}/schemas/{entity}/1_0.json' as schema_url"


def sales(orders: str, users: str = "src_users") -> str:
    return f"""
        select o.id as order_id, o.id_user as order_id_user, o.spent as order_spent, o.status as order_status,
               o.created_at as order_created_at, o.updated_at as order_updated_at,
               u.id as user_id, u.name as user_name, u.age as user_age, u.address as user_address,
               u.created_at as user_created_at, u.updated_at as user_updated_at
        from {orders} o left join {users} u on o.id_user = u.id
    """


def query(body: str, *ctes: str) -> str:
    return f"with {', '.join((BASE, *ctes))} {body}"


def newer(watermark: str) -> str:
    return f"(created_at > {watermark} or updated_at > {watermark})"


EVENT_HASH = hashed(["user_id", "event_type", "props"])

DIM_USERS = f"""
    users_v1 as (
        select {numbered(["id"])} as sk, id, name, cast(age as bigint) as age, address, created_at,
               {ts(FIRST_LOAD)} as valid_from, true as is_effective
        from src_users
    ),
    users_v2 as (
        select {numbered(["id"], "(select count(*) from src_users)")} as sk, id, name, cast(age as bigint) as age,
               address, created_at, {ts(SECOND_LOAD)} as valid_from, true as is_effective
        from src_users_updated
    ),
    dim_users as (
        select * replace (id not in (select id from users_v2) as is_effective) from users_v1
        union all select * from users_v2
    )
"""
STATUS_V1 = f"""
    status_v1 as (
        select {numbered(["id"])} as sk, id, status, {ts(FIRST_LOAD)} as valid_from, true as is_effective
        from src_first_seen
    )
"""
DIM_STATUS = f"""
    {STATUS_V1},
    status_v2 as (
        select {numbered(["id"], "(select count(*) from src_first_seen)")} as sk, id, status,
               {ts(SECOND_LOAD)} as valid_from, true as is_effective
        from src_updated
    ),
    dim_status as (
        select * replace (id not in (select id from status_v2) as is_effective) from status_v1
        union all select * from status_v2
    )
"""

# The two runs of the end-to-end loads: what each run extracts, behind the watermark of the one before.
RUNS = f"""
    run_1 as (select * from src_as_of),
    mark as (select greatest(max(created_at), max(updated_at)) as w from run_1),
    run_2 as (select o.* from src_orders o, mark where o.created_at > w or o.updated_at > w),
    user_mark as (select max(created_at) as w from src_users),
    users_run_2 as (select u.* from src_users_last u, user_mark where u.created_at > w or u.updated_at > w)
"""
FACT_BY = ["id", "id_user", "created_at", "spent"]

SALES_TEXT = f"""
    order_id, order_id_user, order_spent, order_status, user_id, user_name, cast(user_age as bigint) as user_age,
    user_address, cast(order_created_at as varchar) as order_created_at,
    cast(order_updated_at as varchar) as order_updated_at, cast(user_created_at as varchar) as user_created_at,
    cast(user_updated_at as varchar) as user_updated_at, {tags("sales")}
"""

STATUS_LIST = ", ".join(f"'{s}'" for s in AUDITED_STATUSES)


def failures(rules: Sequence[tuple[int, str, str]]) -> str:
    """Failed rules, numbered; a rule is (id, table, failing rows as an aggregate)."""
    counts = " union all ".join(
        f"select cast({rule} as bigint) as id_dim_tests, cast({amount} as bigint) as amount_records_failing from {table}"
        for rule, table, amount in rules
    )
    return f"""
        failed as (
            select row_number() over (order by id_dim_tests) as id, id_dim_tests, amount_records_failing,
                   {ts(SECOND_LOAD)} as "timestamp"
            from ({counts}) where amount_records_failing > 0
        )
    """


def rules(users: str, orders: str, age: str, name: str, spent: str, status: str) -> list[tuple[int, str, str]]:
    return [
        (1, users, "case when count(*) = 0 then 1 else 0 end"),
        (2, users, f"count(*) filter (where {age} < 0 or {age} > 100)"),
        (3, users, f"count(*) filter (where {name} is null or {name} = '')"),
        (4, orders, f"count(*) filter (where {spent} is null or {spent} <= 0)"),
        (5, orders, f"count(*) filter (where {status} not in ({STATUS_LIST}))"),
    ]


def audited(users: str, orders: str, wanted: Sequence[int]) -> str:
    """Failing rows of some rules of the star model, with the texts of the catalogue."""
    return " union all ".join(
        f"select cast({rule} as bigint) as id_dim_tests, cast({amount} as bigint) as amount_records_failing, "
        f"'{RULE_TEXTS[rule].format(users='users_extract_cast', orders='orders_extract_cast')}' as description, "
        f"'{'users' if table == users else 'orders'}_extract_cast' as table_name from {table}"
        for rule, table, amount in rules(users, orders, "age", "name", "spent", "status")
        if rule in wanted
    )


# The texts of the rules.
RULE_TEXTS = {
    1: "check {users} table is not empty",
    2: "check {users} age is between 0 and 100",
    3: "check {users} name is not empty",
    4: "check {orders} spent is not null or negative",
    5: "check {orders} status is valid",
}
STAR_FAILURES = failures(rules("src_users", "src_orders", "age", "name", "spent", "status"))
SALES_FAILURES = failures(rules("sales", "sales", "user_age", "user_name", "order_spent", "order_status"))

NEW_ORDERS = f"""
    kept as (select * from src_orders where created_at >= {ts(KEPT_SINCE)}),
    pairs as (
        select o.id as old_id, n.id as new_id, coalesce(o.id, n.id) as id
        from src_as_of o full outer join kept n on o.id = n.id
        where o.id is null or n.id is null or o.id_user is distinct from n.id_user or o.spent is distinct from n.spent
           or o.status is distinct from n.status or o.created_at is distinct from n.created_at
           or o.updated_at is distinct from n.updated_at
    )
"""

# State after the change feeds: the orders known at first, the new ones, and the changed ones.
CDC_STATUS = f"""
    cdc_v1 as (
        select {numbered(["order_id"])} as id, order_id, status, {ts(FIRST_LOAD)} as valid_from, true as is_effective
        from (select id as order_id, status from src_as_of)
    ),
    fed as (
        select n.id as order_id, n.id_user, n.status, n.created_at as ordered_at, o.id is not null as is_update
        from src_orders n left join src_as_of o on o.id = n.id
        where o.id is null or o.status <> n.status or o.updated_at is distinct from n.updated_at
    ),
    cdc_v2 as (
        select {numbered(["order_id"], "(select count(*) from cdc_v1)")} as id, order_id, status,
               {ts(SECOND_LOAD)} as valid_from, true as is_effective
        from fed
    ),
    cdc_status as (
        select * replace (order_id not in (select order_id from cdc_v2) as is_effective) from cdc_v1
        union all select * from cdc_v2
    )
"""
CDC_USER = f"""
    cdc_user_v1 as (
        select {numbered(["user_id"])} as id, user_id, address, age, name, registered_at,
               {ts(FIRST_LOAD)} as valid_from, true as is_effective
        from (select id as user_id, address, cast(age as bigint) as age, name, created_at as registered_at from src_users)
    ),
    cdc_user_v2 as (
        select {numbered(["user_id"], "(select count(*) from src_users)")} as id, user_id, address, age, name,
               registered_at, {ts(SECOND_LOAD)} as valid_from, true as is_effective
        from (
            select id as user_id, address, cast(age as bigint) as age, name, created_at as registered_at
            from src_users_updated
        )
    ),
    cdc_user as (
        select * replace (user_id not in (select user_id from cdc_user_v2) as is_effective) from cdc_user_v1
        union all select * from cdc_user_v2
    )
"""
ENTERED = "fed where status = 'processing' and not is_update"


def cdc_facts(orders: str, status: str, user: str, last: str = "0") -> str:
    return f"""
        select {numbered(["o.order_id"], last)} as id, o.order_id, s.id as orderstatus_id, u.id as orderuser_id,
               o.ordered_at
        from ({orders}) o
        left join {status} s on s.order_id = o.order_id and s.is_effective
        left join {user} u on u.user_id = o.id_user and u.is_effective
    """


CDC_FACTS = query(
    f"""
    {cdc_facts("select id as order_id, id_user, created_at as ordered_at from src_as_of where status = 'processing'", "cdc_v1", "cdc_user_v1")}
    union all
    {cdc_facts(f"select * from {ENTERED}", "cdc_status", "cdc_user", "(select count(*) from src_as_of where status = 'processing')")}
    """,
    CDC_STATUS,
    CDC_USER,
)

LOGGED = " union all ".join(
    f"select {n} as batch, id_dim_tests, amount_records_failing, {ts(at)} as loaded_at, description, table_name from ({counted})"
    for n, (at, counted) in enumerate(
        (at, counted)
        for at, users, orders in ((FIRST_LOAD, "src_users", "run_1"), (SECOND_LOAD, "users_run_2", "run_2"))
        for counted in (audited(users, orders, (1, 2, 3)), audited(users, orders, (4, 5)))
    )
)


ORACLES: dict[str, str] = {
    "incremental_extract": query(f"select * from src_orders where {newer(ts(WATERMARK))}"),
    "obt_extract": query(sales(f"(select * from src_orders where {newer(ts(WATERMARK))})")),
    "watermark_floor": query(
        """
        select 'users' as entity, coalesce(greatest(max(created_at), max(updated_at)), timestamp '1000-04-13 00:00:00') as watermark
        from src_users_last
        union all
        select 'orders', coalesce(greatest(max(created_at), max(updated_at)), timestamp '1000-04-13 00:00:00') from src_orders
        union all
        select 'sales', coalesce(greatest(max(created_at), max(updated_at)), timestamp '1000-04-13 00:00:00')
        from src_orders, (select greatest(max(created_at), max(updated_at)) as w from src_orders) m
        where created_at > w or updated_at > w
        """
    ),
    "watermark_window": query(
        f"""
        select count(*) filter (where created_at > w and created_at <= {ts(WINDOW_END)}) as closed_right,
               count(*) filter (where created_at >= w and created_at < {ts(WINDOW_END)}) as closed_left
        from src_orders, (
            select coalesce(max(created_at), timestamp '1900-01-01 00:00:00') as w
            from src_orders where created_at <= {ts(SILVER_UNTIL)}
        ) silver
        """
    ),
    "landing_scan": query(
        f"""
        select id, name, cast(age as bigint) as age, address, cast(created_at as varchar) as created_at,
               cast(updated_at as varchar) as updated_at, {tags("users")}
        from src_users
        """
    ),
    "staged_file": query("select id, name, created_at from src_users"),
    "tag_schema": query(f"select *, {tags('orders')}, {schema_url('orders')} from src_orders"),
    "timestamps_as_text": query(f"select {ORDER_TEXT} from src_orders"),
    "row_hash": query(f"select id, {hashed(ORDER_COLUMNS)} as md5 from src_orders"),
    "bronze_lineage": f"""
        select o_orderkey as id, o_custkey as id_user, 'orders.parquet' as file,
               row_number() over (order by o_orderkey) as metadata_row_number, {ts(FIRST_LOAD)} as created_at
        from orders
    """,
    "extract_cast": query(f"select {ORDER_TEXT}, {tags('orders')}, {schema_url('orders')} from src_orders"),
    "extract_fixed": query(
        """
        select id as user_id, address, cast(age as bigint) as age, name, created_at as registered_at, updated_at
        from src_users_last
        """
    ),
    "extract_props": """
        select event_id, cast(json_extract_string(props, '$.k') as bigint) as k,
               json_extract_string(props, '$.unknown') as unknown
        from events
    """,
    "bronze_ingest": query(f"select {ORDER_TEXT}, {tags('orders')} from src_orders"),
    "delta_batches": query(
        """
        select status, count(*) as "rows", cast(sum(spent) as bigint) as spent
        from (select * from src_first_seen union all select * from src_updated) group by status
        """
    ),
    "independent_readers": query(
        """
        select consumer, status, count(*) as "rows", cast(sum(spent) as bigint) as spent
        from (
            select 'status' as consumer, * from delivered union all select 'fact' as consumer, * from delivered
        ) group by consumer, status
        """,
        "delivered as (select * from src_first_seen union all select * from src_updated)",
    ),
    "dedup_md5": f"""
        select * exclude (n) from (
            select *, row_number() over (partition by md5 order by ts, event_id) as n
            from (select *, {EVENT_HASH} as md5 from events)
        ) where n = 1
    """,
    "dedup_window": f"""
        select event_id, user_id, event_type as status, ts as ordered_at,
               cast(json_extract_string(props, '$.k') as bigint) as k, md5
        from (
            select *, row_number() over (partition by md5 order by ts, event_id) as n
            from (select *, {EVENT_HASH} as md5 from events)
            where ts >= {ts(EVENTS_FROM)} and ts < {ts(EVENTS_UNTIL)}
        ) where n = 1
    """,
    "contract_violations": query(
        """
        select field, breaches from (
            select unnest(['user_id', 'user_name', 'user_age', 'user_address', 'user_created_at']) as field, breaches
            from (select count(*) as breaches from src_orders where id_user not in (select id from src_users_in_credit))
        ) where breaches > 0
        """
    ),
    "json_contract": query(
        """
        select record_set, id, breaches = '' as valid,
               case when breaches = '' then 'Given JSON data is Valid' else 'Given JSON data is InValid' end as message,
               breaches
        from (
            select 'users' as record_set, id,
                   case when age < 1 then 'age: below 1' when age > 110 then 'age: above 110' else '' end as breaches
            from src_users
            union all
            select 'orders', id, case when spent < 1 then 'spent: below 1' else '' end from src_orders
            union all
            select 'props', event_id,
                   case when k is null then 'k: missing' when k < 1 then 'k: below 1' when k > 90 then 'k: above 90' else '' end
            from (select event_id, cast(json_extract_string(props, '$.k') as double) as k from events)
        )
        """
    ),
    "pk_duplicates": query(
        """
        select id, count(*) as copies
        from (select id from src_first_seen union all select id from src_updated)
        group by id having count(*) > 1
        """
    ),
    "fk_orphans": query(
        """
        select id, id_user from src_orders o
        where id_user is not null and not exists (select 1 from src_users_in_credit u where u.id = o.id_user)
        """
    ),
    "surrogate_keys": query(f"select {numbered(['id'], '1000')} as sk, id, status from src_orders"),
    "scd1_upsert": query(
        """
        select * from src_first_seen f where not exists (select 1 from src_updated u where u.id = f.id)
        union all select * from src_updated
        """
    ),
    "silver_upsert": query(
        """
        select id as order_id, id_user, spent, status, created_at as ordered_at, updated_at
        from (
            select * from src_first_seen f where not exists (select 1 from src_updated u where u.id = f.id)
            union all select * from src_updated
        )
        """
    ),
    "scd2_close": query(
        "select * replace (id not in (select id from src_updated) as is_effective) from status_v1", STATUS_V1
    ),
    "scd2_dim_users": query("select * from dim_users", DIM_USERS),
    "scd2_dim_status": query("select * from dim_status", DIM_STATUS),
    "scd2_only_changed": query(
        f"""
        select * replace (id not in (select id from changed) as is_effective) from status_v1
        union all
        select {numbered(["id"], "(select count(*) from status_v1)")} as sk, id, status,
               {ts(SECOND_LOAD)} as valid_from, true as is_effective
        from changed
        """,
        STATUS_V1,
        "changed as (select id, status from src_orders where status <> 'processing')",
    ),
    "scd2_valid_to": query(
        "select *, lead(valid_from) over (partition by id order by valid_from, sk) as valid_to from dim_status",
        DIM_STATUS,
    ),
    "fact_orders": query(
        f"""
        select {numbered(["o." + c for c in FACT_BY])} as sk, o.id, o.created_at, o.spent,
               u.sk as id_dim_user, s.sk as id_dim_status
        from src_orders o
        left join dim_users u on u.id = o.id_user and u.is_effective
        left join dim_status s on s.id = o.id and s.is_effective
        where o.updated_at is null
        """,
        DIM_USERS,
        DIM_STATUS,
    ),
    "fact_orders_fanout": query(
        f"""
        select {numbered([*["o." + c for c in FACT_BY], "u.sk", "s.sk"])} as sk, o.id, o.created_at, o.spent,
               u.sk as id_dim_user, s.sk as id_dim_status
        from src_first_seen o
        left join dim_users u on u.id = o.id_user
        left join dim_status s on s.id = o.id
        where o.updated_at is null
        """,
        DIM_USERS,
        DIM_STATUS,
    ),
    "obt_first_run": query(
        f"""
        select *, {ts(FIRST_LOAD)} as valid_from, false as is_effective from sales
        union all
        select *, {ts(FIRST_LOAD)} as valid_from, true as is_effective from sales
        """,
        f"sales as ({sales('src_first_seen')})",
    ),
    "obt_second_run": query(
        f"""
        select *, {ts(FIRST_LOAD)} as valid_from, false as is_effective from sales
        union all
        select *, {ts(FIRST_LOAD)} as valid_from, order_id not in (select id from src_updated) as is_effective from sales
        union all
        select *, {ts(SECOND_LOAD)} as valid_from, true as is_effective from updated
        """,
        f"sales as ({sales('src_first_seen')})",
        f"updated as ({sales('src_updated')})",
    ),
    "kimball_load": query(
        f"""
        select {numbered(["o." + c for c in FACT_BY])} as sk, o.id, o.created_at, o.spent,
               u.sk as id_dim_user, s.sk as id_dim_status
        from run_1 o left join u1 u on u.id = o.id_user left join s1 s on s.id = o.id
        where o.updated_at is null
        union all
        select {numbered(["o." + c for c in FACT_BY], "(select count(*) from run_1 where updated_at is null)")} as sk,
               o.id, o.created_at, o.spent, coalesce(v.sk, u.sk) as id_dim_user, s.sk as id_dim_status
        from run_2 o left join u1 u on u.id = o.id_user left join u2 v on v.id = o.id_user left join s2 s on s.id = o.id
        where o.updated_at is null
        """,
        RUNS,
        f"u1 as (select {numbered(['id'])} as sk, id from src_users)",
        f"u2 as (select {numbered(['id'], '(select count(*) from src_users)')} as sk, id from users_run_2)",
        f"s1 as (select {numbered(['id'])} as sk, id from run_1)",
        f"s2 as (select {numbered(['id'], '(select count(*) from run_1)')} as sk, id from run_2)",
    ),
    "obt_load": query(
        f"""
        select {SALES_TEXT}, {ts(FIRST_LOAD)} as valid_from, order_id not in (select id from run_2) as is_effective
        from ({sales("run_1")})
        union all
        select {SALES_TEXT}, {ts(SECOND_LOAD)} as valid_from, true as is_effective from ({sales("run_2")})
        """,
        RUNS,
    ),
    "dq_failures": query("select * from failed", STAR_FAILURES),
    "dq_gate": query("select count(*) = 0 as passed, count(*) as failed_rules from failed", STAR_FAILURES),
    "dq_sales": query(
        "select * from failed", f"sales as ({sales('src_orders', 'src_users_in_credit')})", SALES_FAILURES
    ),
    "change_feed": query(
        """
        select o.*, 'DELETE' as action, p.new_id is not null as is_update
        from pairs p join src_as_of o on o.id = p.old_id
        union all
        select n.*, 'INSERT' as action, p.old_id is not null as is_update
        from pairs p join kept n on n.id = p.new_id
        """,
        NEW_ORDERS,
    ),
    "cdc_scd2": query("select * from cdc_status", CDC_STATUS),
    "cdc_dim_user": query("select * from cdc_user", CDC_USER),
    **dict.fromkeys(("cdc_fact", "cdc_load", "cdc_catch_up"), CDC_FACTS),
    "cdc_silver_window": query(
        f"""
        select o.id as order_id, o.id_user, o.spent, o.status, o.created_at as ordered_at, o.updated_at,
               case when r.id is null then {ts(FIRST_LOAD)} else {ts(SECOND_LOAD)} end as copied_at,
               case when r.id is null then {ts(FIRST_LOAD)} else {ts(SECOND_LOAD)} end as dbt_at
        from src_orders o left join run_2 r on r.id = o.id
        """,
        RUNS,
    ),
    "landing_retry": query(
        """
        select id as user_id, address, cast(age as bigint) as age, name, created_at as registered_at, updated_at
        from src_users
        """
    ),
    "repeated_load": query(
        f"""
        select {numbered(["o." + c for c in FACT_BY])} as sk, o.id, o.created_at, o.spent, u.sk as id_dim_user, s.sk as id_dim_status
        from (select * replace (created_at + interval 500 millisecond as created_at) from src_orders) o
        left join u1 u on u.id = o.id_user left join s1 s on s.id = o.id
        where o.updated_at is null
        """,
        f"u1 as (select {numbered(['id'])} as sk, id from src_users)",
        f"s1 as (select {numbered(['id'])} as sk, id from src_orders)",
    ),
    "rejected_load": query(
        f"""
        select {numbered(["o." + c for c in FACT_BY])} as sk, o.id, o.created_at, o.spent,
               coalesce(u.sk, v.sk) as id_dim_user, s.sk as id_dim_status
        from src_orders o left join u1 u on u.id = o.id_user left join u2 v on v.id = o.id_user left join s1 s on s.id = o.id
        where o.updated_at is null
        """,
        f"u1 as (select {numbered(['id'])} as sk, id from src_users_in_credit)",
        f"u2 as (select {numbered(['id'], '(select count(*) from src_users_in_credit)')} as sk, id from src_users_updated)",
        f"s1 as (select {numbered(['id'])} as sk, id from src_orders)",
    ),
    "landing_crash": query(
        f"""
        select {numbered(["o." + c for c in FACT_BY])} as sk, o.id, o.created_at, o.spent, u.sk as id_dim_user, s.sk as id_dim_status
        from known_1 o left join u1 u on u.id = o.id_user left join s1 s on s.id = o.id
        where o.updated_at is null
        union all
        select {numbered(["o." + c for c in FACT_BY], "(select count(*) from known_1 where updated_at is null)")} as sk,
               o.id, o.created_at, o.spent, u.sk as id_dim_user, s.sk as id_dim_status
        from known_2 o left join u1 u on u.id = o.id_user left join s2 s on s.id = o.id
        where o.updated_at is null
        """,
        f"known_1 as (select * from src_as_of where id_user % {AGES} <= {OLDEST_AUDITED})",
        "known_mark as (select greatest(max(created_at), max(updated_at)) as w from known_1)",
        f"""
        known_2 as (
            select o.* from src_orders o, known_mark
            where (o.created_at > w or o.updated_at > w) and id_user % {AGES} <= {OLDEST_AUDITED}
        )
        """,
        f"u1 as (select {numbered(['id'])} as sk, id from src_users where age <= {OLDEST_AUDITED})",
        f"s1 as (select {numbered(['id'])} as sk, id from known_1)",
        f"s2 as (select {numbered(['id'], '(select count(*) from known_1)')} as sk, id from known_2)",
    ),
    "schema_versions": query(
        """
        select id, name, cast(age as bigint) as age, address, cast(null as varchar) as segment,
               cast(created_at as varchar) as created_at, cast(updated_at as varchar) as updated_at,
               '1_0' as schema_version, 'users' as schema_name
        from src_users_in_credit
        union all
        select id, name, cast(age as bigint), null, address, cast(created_at as varchar), cast(updated_at as varchar), '2_0', 'users'
        from src_users_updated
        """
    ),
    "dq_failure_log": query(
        f"""
        select row_number() over (order by batch, id_dim_tests) as id, id_dim_tests, amount_records_failing,
               loaded_at as "timestamp", description, table_name
        from ({LOGGED}) where amount_records_failing > 0
        """,
        RUNS,
    ),
}
ORACLES["late_rows"] = ORACLES["landing_scan"]
