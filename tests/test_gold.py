"""Merges, slowly changing dimensions, facts, the wide table, the audit and change feeds on small rows."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from seed import LATER, PLACED, RUN_1, RUN_2, RUN_3, orders, rows, users
from tidemark.operators import audit, changes, merge, star, wide
from tidemark.operators.scd import DIM_STATUS, DIM_USERS, apply_scd2, with_valid_to
from tidemark.plans.cdc import orders_to_silver
from tidemark.sources.incremental import joined_rows


def statuses(spark, *pairs):
    return spark.createDataFrame([(i, s) for i, s in pairs], "id bigint, status string")


def effective(df, key="id"):
    return {r[key]: r for r in df.where("is_effective").collect()}


def load(spark, *batches, **options):
    table = DIM_STATUS.empty(spark)
    for batch, as_of in zip(batches, (RUN_1, RUN_2, RUN_3)):
        next_key = table.count() + 1
        table = apply_scd2(table, batch, DIM_STATUS, as_of, first_key=next_key, **options)
    return table


# Merges


def test_close_only(spark):
    table = load(spark, statuses(spark, (1, "a"), (2, "a")))
    closed = merge.close_versions(table, statuses(spark, (2, "b"), (2, "c"), (3, "a")), "id")
    assert closed.count() == 2 and set(effective(closed)) == {1}
    again = merge.close_versions(closed, statuses(spark, (2, "b")), "id", unique=True)
    assert rows(again) == rows(closed)


def test_upsert(spark):
    after = merge.upsert(statuses(spark, (1, "a"), (2, "a")), statuses(spark, (2, "b"), (3, "c")), "id")
    assert rows(after) == [(1, "a"), (2, "b"), (3, "c")]
    assert rows(merge.upsert(after, statuses(spark), "id")) == rows(after)


def test_close_or_insert(spark):
    table = load(spark, statuses(spark, (1, "a")))
    new = statuses(spark, (1, "b"), (2, "b")).select(
        F.lit(9).cast("bigint").alias("sk"), "id", "status", F.lit(RUN_2).cast("timestamp_ntz").alias("valid_from"), F.lit(True).alias("is_effective")
    )
    after = merge.close_or_insert(table, new, "id")
    assert {(r.id, r.status, r.is_effective) for r in after.collect()} == {(1, "a", False), (2, "b", True)}


# Dimensions


def test_first_load_and_redelivery(spark):
    once = apply_scd2(DIM_USERS.empty(spark), users(spark), DIM_USERS, RUN_1)
    assert once.columns == DIM_USERS.schema.names and set(effective(once)) == {1, 2, 3}
    twice = apply_scd2(once, users(spark), DIM_USERS, RUN_2, first_key=4)
    assert twice.count() == 6 and set(effective(twice)) == {1, 2, 3}
    assert sorted(r.sk for r in twice.collect()) == [1, 2, 3, 4, 5, 6]
    same = apply_scd2(once, users(spark), DIM_USERS, RUN_2, first_key=4, only_changed=True)
    assert rows(same) == rows(once)


def test_only_changed_opens_versions_for_changed_and_new_rows(spark):
    after = load(
        spark, statuses(spark, (1, "a"), (2, "a")), statuses(spark, (1, "a"), (2, "b"), (3, "c")), only_changed=True
    )
    assert after.count() == 4
    assert {k: r.status for k, r in effective(after).items()} == {1: "a", 2: "b", 3: "c"}


def test_two_states_of_one_key_in_a_batch(spark):
    batch = orders(spark, [(1, 1, 5, "processing", PLACED, None), (1, 1, 5, "shipped", PLACED, LATER)])
    after = load(spark, batch)
    assert [(r.status, r.is_effective) for r in after.collect()] == [("shipped", True)]
    as_written = load(spark, batch, latest_only=False)
    assert rows(as_written.select("status", "is_effective")) == [("processing", True), ("shipped", True)]


def test_empty_batch_changes_nothing(spark):
    table = load(spark, statuses(spark, (1, "a")))
    assert rows(apply_scd2(table, statuses(spark), DIM_STATUS, RUN_2, first_key=2)) == rows(table)


def test_null_attribute_fails_the_load(spark):
    with pytest.raises(Exception, match="dim_status.status"):
        load(spark, statuses(spark, (1, None))).collect()


def test_valid_to(spark):
    table = load(spark, statuses(spark, (1, "a")), statuses(spark, (1, "b")), statuses(spark, (1, "c")))
    spans = {r.status: (str(r.valid_from), str(r.valid_to)) for r in with_valid_to(table).collect()}
    assert spans == {"a": (RUN_1, RUN_2), "b": (RUN_2, RUN_3), "c": (RUN_3, "None")}


batches = st.lists(st.dictionaries(st.integers(1, 6), st.sampled_from("abc"), max_size=6), min_size=1, max_size=3)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(batches=batches)
def test_one_effective_version_per_key_and_dense_keys(spark, batches):
    table = load(spark, *[statuses(spark, *b.items()) for b in batches]).collect()
    state = {}
    for b in batches:
        state |= b
    assert {r.id: r.status for r in table if r.is_effective} == state
    assert len([r for r in table if r.is_effective]) == len(state)
    assert sorted(r.sk for r in table) == list(range(1, sum(map(len, batches)) + 1))


# Facts


def test_facts_of_two_runs(spark):
    dims = []
    for dim, batch in ((DIM_USERS, users(spark)), (DIM_STATUS, orders(spark))):
        first = apply_scd2(dim.empty(spark), batch, dim, RUN_1)
        dims.append((first, apply_scd2(first, batch, dim, RUN_2, first_key=4)))
    (users_1, users_2), (status_1, status_2) = dims
    first = star.fact_orders(orders(spark), users_1, status_1)
    assert [r.sk for r in first.orderBy("sk").collect()] == [1, 2, 3]
    assert first.columns == ["sk", "id", "created_at", "spent", "id_dim_user", "id_dim_status"]
    second = star.fact_orders(orders(spark), users_2, status_2, first_key=4)
    assert second.count() == 3 and {r.sk for r in second.collect()} == {4, 5, 6}
    newest = {r.sk for r in users_2.where("is_effective").collect()}
    assert {r.id_dim_user for r in second.collect()} <= newest
    fanout = star.fact_orders(orders(spark), users_2, status_2, effective=False, first_key=4)
    assert fanout.count() == 12 and sorted(r.sk for r in fanout.collect()) == list(range(4, 16))


def test_updated_orders_make_no_fact_and_a_missing_user_fails(spark):
    dim_users = apply_scd2(DIM_USERS.empty(spark), users(spark), DIM_USERS, RUN_1)
    batch = orders(spark, [(1, 1, 5, "shipped", PLACED, LATER), (2, 9, 5, "processing", PLACED, None)])
    dim_status = apply_scd2(DIM_STATUS.empty(spark), batch, DIM_STATUS, RUN_1)
    assert star.fact_orders(batch.where("id = 1"), dim_users, dim_status).count() == 0
    with pytest.raises(Exception, match="fact_orders.id_dim_user"):
        star.fact_orders(batch, dim_users, dim_status).collect()


def test_wide_table(spark):
    sales = joined_rows(orders(spark), users(spark))
    first = wide.load_wide(None, sales, RUN_1)
    assert first.count() == 3 and first.where("is_effective").count() == 3
    second = wide.load_wide(first, sales, RUN_2)
    assert second.count() == 6 and second.where("is_effective").count() == 3
    written_1 = wide.load_wide(None, sales, RUN_1, as_written=True)
    assert written_1.count() == 6 and written_1.where("is_effective").count() == 3
    written_2 = wide.load_wide(written_1, sales, RUN_2, as_written=True)
    assert written_2.count() == 9 and written_2.where("is_effective").count() == 3


# Audit


def failing(tables, statuses=("processing",)):
    found = audit.run_audit(tables, audit.star_rules(statuses), RUN_1).collect()
    return {r.id_dim_tests: r.amount_records_failing for r in found}


def test_rules_at_their_bounds(spark):
    ages = users(spark, [(i, n, a, "x", PLACED, None) for i, (n, a) in enumerate(
        [("a", -1), ("a", 0), ("a", 100), ("a", 101), ("a", None), (None, 5), ("", 5), (" ", 5)]
    )])
    spent = orders(spark, [(i, 1, s, t, PLACED, None) for i, (s, t) in enumerate(
        [(0, "processing"), (-1, "processing"), (None, "processing"), (1, "lost"), (1, None), (1, "processing")]
    )])
    tables = {"users_extract_cast": ages, "orders_extract_cast": spent}
    assert failing(tables) == {2: 2, 3: 2, 4: 3, 5: 1}
    assert failing({"users_extract_cast": users(spark), "orders_extract_cast": orders(spark)}) == {}
    assert failing({"users_extract_cast": users(spark).limit(0)}) == {1: 1}


def test_gate(spark):
    bad = {"users_extract_cast": users(spark).limit(0)}
    failures = audit.run_audit(bad, audit.star_rules(["processing"]), RUN_1)
    assert failures.columns == ["id", "id_dim_tests", "amount_records_failing", "timestamp"]
    assert tuple(audit.gate(failures).first()) == (False, 1)
    with pytest.raises(audit.AuditFailed, match="rule 1: 1 rows"):
        audit.require_passed(failures)
    good = audit.run_audit({"users_extract_cast": users(spark)}, audit.star_rules(["processing"]), RUN_1)
    assert tuple(audit.gate(good).first()) == (True, 0)
    audit.require_passed(good)


def test_rule_text_is_quoted(spark):
    odd = ["it's", "back\\slash"]
    batch = orders(spark, [(1, 1, 1, odd[0], PLACED, None), (2, 1, 1, odd[1], PLACED, None)])
    assert failing({"orders_extract_cast": batch}, odd) == {}
    assert audit.rule_table(spark, audit.wide_rules(odd)).count() == 5


# Change feeds

states = st.dictionaries(st.integers(1, 5), st.one_of(st.none(), st.sampled_from("ab")), max_size=5)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(old=states, new=states)
def test_feed_turns_the_old_state_into_the_new(spark, old, new):
    before, after = statuses(spark, *old.items()), statuses(spark, *new.items())
    feed = changes.change_feed(before, after, "id").collect()
    state = set(old.items())
    state -= {(r.id, r.status) for r in feed if r.action == "DELETE"}
    state |= {(r.id, r.status) for r in feed if r.action == "INSERT"}
    assert state == set(new.items())
    changed = {k for k in old.keys() & new.keys() if old[k] != new[k]}
    assert {r.id for r in feed if r.is_update} == changed
    assert len(feed) == 2 * len(changed) + len(old.keys() ^ new.keys())


def silver(spark, *triples):
    return orders_to_silver(orders(spark, [(i, 1, 5, s, PLACED, u) for i, s, u in triples]))


def test_feed_driven_dimension(spark):
    dim = changes.DIM_ORDERSTATUS
    none = silver(spark)
    first = silver(spark, (1, "processing", None), (2, "processing", None))
    second = silver(spark, (1, "shipped", LATER), (3, "processing", None))
    table = changes.apply_feed_scd2(dim.empty(spark), changes.change_feed(none, first, "order_id"), dim, RUN_1)
    feed = changes.change_feed(first, second, "order_id")
    for as_written in (False, True):
        after = changes.apply_feed_scd2(table, feed, dim, RUN_2, first_key=3, as_written=as_written)
        assert {k: r.status for k, r in effective(after, "order_id").items()} == {1: "shipped", 2: "processing", 3: "processing"}
        assert sorted(r.id for r in after.collect()) == [1, 2, 3, 4]
    # A removed key that comes back: the written merge only closes it.
    back = changes.change_feed(second, second.unionByName(silver(spark, (2, "pending", None))), "order_id")
    kept = changes.apply_feed_scd2(after, back, dim, RUN_3, first_key=5)
    assert effective(kept, "order_id")[2].status == "pending"
    lost = changes.apply_feed_scd2(after, back, dim, RUN_3, first_key=5, as_written=True)
    assert 2 not in effective(lost, "order_id")


def test_fact_from_feed_takes_entering_orders_only(spark):
    dim = changes.DIM_ORDERSTATUS
    first = silver(spark, (1, "processing", None), (2, "pending", None))
    feed = changes.change_feed(silver(spark), first, "order_id")
    status = changes.apply_feed_scd2(dim.empty(spark), feed, dim, RUN_1)
    people = users(spark).selectExpr("cast(id as bigint) user_id", "address", "cast(age as bigint) age", "name", "created_at registered_at")
    user_feed = changes.change_feed(people.limit(0), people, "user_id")
    user = changes.apply_feed_scd2(changes.DIM_USER.empty(spark), user_feed, changes.DIM_USER, RUN_1)
    facts = changes.fact_from_feed(feed, status, user).collect()
    assert [(r.id, r.order_id) for r in facts] == [(1, 1)] and facts[0].orderuser_id is not None
    update = changes.change_feed(first, silver(spark, (1, "processing", LATER), (2, "pending", None)), "order_id")
    assert changes.fact_from_feed(update, status, user).count() == 0
    assert changes.fact_from_feed(feed, status, user, effective=False).count() == 1


def test_silver_upsert_takes_the_newest_of_a_batch(spark):
    first = changes.upsert_silver(None, silver(spark, (1, "a", None), (1, "b", LATER)), "order_id", "updated_at")
    assert [(r.order_id, r.status) for r in first.collect()] == [(1, "b")]
    after = changes.upsert_silver(first, silver(spark, (1, "c", LATER), (2, "d", None)), "order_id", "updated_at")
    assert rows(after.select("order_id", "status")) == [(1, "c"), (2, "d")]
