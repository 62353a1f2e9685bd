"""Change feed between two states of a table, and the gold tables it drives."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.clock import ntz
from tidemark.operators.contracts import require_not_null
from tidemark.operators.dedup import newest_per_key
from tidemark.operators.keys import with_surrogate_keys
from tidemark.operators.merge import close_versions, unmatched, upsert
from tidemark.operators.scd import Dimension
from tidemark.operators.star import star_join

INSERT, DELETE = "INSERT", "DELETE"

DIM_USER = Dimension(
    "dim_user",
    (("user_id", "bigint"), ("address", "string"), ("age", "bigint"), ("name", "string"), ("registered_at", "timestamp_ntz")),
    key="user_id",
    surrogate="id",
    required=("user_id",),
)
DIM_ORDERSTATUS = Dimension("dim_orderstatus", (("order_id", "bigint"), ("status", "string")), key="order_id", surrogate="id")


def change_feed(old: DataFrame, new: DataFrame, key: str, ignore: Sequence[str] = ()) -> DataFrame:
    """Rows that turn the old state into the new one, with ``action`` and ``is_update``.

    An insert is one INSERT row and a removal one DELETE row; an update is a DELETE row with the old
    image and an INSERT row with the new image, both marked as update. One join on the plain key,
    which is unique. A row that differs in
    ``ignore`` columns alone has not changed.
    """
    columns = new.columns
    before = old.select(F.col(key).alias("_old_key"), F.struct(*columns).alias("_before"))
    after = new.select(F.col(key).alias("_new_key"), F.struct(*columns).alias("_after"))
    pairs = before.join(after, F.col("_old_key") == F.col("_new_key"), "full_outer")
    compared = [c for c in columns if c not in ignore]
    present = [F.col(side).isNotNull() for side in ("_before", "_after")]
    same = reduce(lambda a, b: a & b, [F.col(f"_before.{c}").eqNullSafe(F.col(f"_after.{c}")) for c in compared])
    changed = pairs.where((present[0] != present[1]) | ~same)
    update = F.col("_before").isNotNull() & F.col("_after").isNotNull()
    images = F.array(
        F.struct(F.lit(DELETE).alias("action"), F.col("_before").alias("image")),
        F.struct(F.lit(INSERT).alias("action"), F.col("_after").alias("image")),
    )
    return (
        changed.select(update.alias("is_update"), F.inline(images))
        .where("image is not null")
        .select("image.*", "action", "is_update")
    )


def feed_parts(
    table: DataFrame,
    feed: DataFrame,
    dim: Dimension,
    as_of: datetime | str,
    first_key: int = 1,
    as_written: bool = False,
    effective_slice: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """The stored versions, those of inserted images closed, and a new version of every inserted image.

    The merge and the insert of update images see the same feed and give one result. ``as_written``
    keeps a detail of the first design: a key that was removed and comes back is closed, but gets no
    new version. It has to know every key the dimension ever held, so it takes the whole dimension;
    by default the effective slice is enough.
    """
    inserts = feed.where(F.col("action") == INSERT).select(*dim.attributes, "is_update")
    opened = inserts
    if as_written:
        opened = unmatched(inserts.where("not is_update"), table, dim.key).unionByName(inserts.where("is_update"))
    required = dim.required if dim.required is not None else [c for c, _ in dim.columns]
    values = {c: F.col(c).cast(t) for c, t in dim.columns}
    typed = opened.select(*[(require_not_null(v, f"{dim.name}.{c}") if c in required else v).alias(c) for c, v in values.items()])
    new = with_surrogate_keys(typed, by=[dim.key], first=first_key, name=dim.surrogate).withColumns(
        {"valid_from": ntz(as_of), "is_effective": F.lit(True)}
    )
    return close_versions(table, inserts, dim.key, unique=effective_slice), new


def feeds_parts(
    table: DataFrame, feeds: DataFrame, dim: Dimension, first_key: int = 1, number: str = "_feed", at: str = "_at"
) -> tuple[DataFrame, DataFrame]:
    """``feed_parts`` of several feeds at once, on the effective slice: each row names its feed and that feed's time.

    Every inserted image opens a version, valid from its feed's time and with the key it would have got if the feeds had
    come one by one. Of the versions of a key the last one is effective.
    """
    inserts = feeds.where(F.col("action") == INSERT).select(*dim.attributes, number, at)
    required = dim.required if dim.required is not None else [c for c, _ in dim.columns]
    values = {c: F.col(c).cast(t) for c, t in dim.columns}
    typed = inserts.select(
        *[(require_not_null(v, f"{dim.name}.{c}") if c in required else v).alias(c) for c, v in values.items()], number, at
    )
    keyed = with_surrogate_keys(typed, by=[dim.key], first=first_key, name=dim.surrogate, after=number)
    last = F.row_number().over(Window.partitionBy(dim.key).orderBy(F.desc(number))) == 1
    new = keyed.withColumns({"valid_from": F.col(at), "is_effective": last}).drop(number, at)
    return close_versions(table, inserts, dim.key, unique=True), new


def effective_at(versions: DataFrame, at: datetime | str, key: str, surrogate: str) -> DataFrame:
    """The versions that were effective at a time, each key's newest one until then."""
    following = Window.partitionBy(key).orderBy("valid_from", surrogate)
    known = versions.where(F.col("valid_from") <= ntz(at)).withColumn("_later", F.lead(surrogate).over(following))
    return known.where("_later is null").drop("_later").withColumn("is_effective", F.lit(True))


def apply_feed_scd2(table: DataFrame, feed: DataFrame, dim: Dimension, as_of: datetime | str, **options) -> DataFrame:
    """A dimension after one feed; options as in ``feed_parts``."""
    closed, new = feed_parts(table, feed, dim, as_of, **options)
    return closed.unionByName(new)


def fact_from_feed(
    feed: DataFrame,
    dim_orderstatus: DataFrame,
    dim_user: DataFrame,
    effective: bool = True,
    first_key: int = 1,
) -> DataFrame:
    """Orders that enter as 'processing', with the keys of their status and user versions."""
    entering = entering_orders(feed).select("order_id", "id_user", "ordered_at")
    if effective:
        entering = with_surrogate_keys(entering, by=["order_id"], first=first_key, name="id")
    return entered_facts(entering, dim_orderstatus, dim_user, effective, first_key)


def entering_orders(feed: DataFrame) -> DataFrame:
    return feed.where((F.col("status") == "processing") & (F.col("action") == INSERT) & ~F.col("is_update"))


def entered_facts(
    entering: DataFrame,
    dim_orderstatus: DataFrame,
    dim_user: DataFrame,
    effective: bool = True,
    first_key: int = 1,
    counted: bool = False,
) -> DataFrame:
    """Facts of entering orders: numbered ones if ``effective``, else numbered after their versions fanned them out.

    A missing version fails the job; with ``counted`` its key stays NULL, for the write to count.
    """
    facts = star_join(
        entering, dim_user, dim_orderstatus, ("id_user", "user_id"), ("order_id", "order_id"), "id", effective
    )
    if not effective:
        facts = with_surrogate_keys(facts, by=["order_id", "_user_sk", "_status_sk"], first=first_key, name="id")
    columns = {"id": "id", "order_id": "order_id", "_status_sk": "orderstatus_id", "_user_sk": "orderuser_id", "ordered_at": "ordered_at"}
    late = ("_status_sk", "_user_sk") if counted else ()
    checked = {c: F.col(c) if c in late else require_not_null(F.col(c), f"fact_orders.{name}") for c, name in columns.items()}
    return facts.select(*[value.alias(columns[c]) for c, value in checked.items()])


def upsert_silver(table: DataFrame | None, batch: DataFrame, key: str, *times: str) -> DataFrame:
    """Silver state after one batch: the newest delivered row of each key replaces the stored one."""
    newest = newest_per_key(batch, key, *times)
    return newest if table is None else upsert(table, newest, key)
