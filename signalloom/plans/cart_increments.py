"""The cart signal kept up to date from new events alone.

The state of a cart is a sum of parts: earliest and latest times, flags, amounts and counts of some of its events can
be added to those of others in any order. So each increment turns its events into one part per cart and merges it into
what is kept. Kept are two tables: the carts active within the horizon, a snapshot that is written anew with each
increment, and the dormant ones, written once when they leave it, by hash of their id. Events of a dormant cart bring
it back: its stored state is looked up in the buckets of the carts that have returned, and nowhere else.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalloom.functions.clock import AsOf, days, instant_like
from signalloom.model import CartPolicy, EventNames, OrderStates
from signalloom.operators.carts import abandoned_carts, daily_cart_activity
from signalloom.operators.staging import broadcast_if_small, staged, staged_with_size, staging_area
from signalloom.plans.cart_recovery import horizon_days, signal_of
from signalloom.sinks.tables import key_bucket, table_exists

MEASURES = ("last_activity_at", "has_add", "has_checkout_complete", "added_value", "removed_value", "n_adds", "n_removes")
_SUMS = ("added_value", "removed_value", "n_adds", "n_removes")
BUCKET = "cart_bucket_no"


def cart_parts(events: DataFrame, names: EventNames = EventNames()) -> DataFrame:
    """One row per cart: ``known`` (when its customer was first named, and who) and the measures of these events."""
    per_customer = daily_cart_activity(events, F.lit(None).cast("date"), names).drop("day")
    known = F.when(F.col("customer_id").isNotNull(), F.struct(F.col("first_seen_at").alias("at"), "customer_id"))
    return _summed(per_customer.withColumn("known", known))


def _summed(parts: DataFrame) -> DataFrame:
    return parts.groupBy("cart_id").agg(
        F.min("known").alias("known"), *[(F.sum if c in _SUMS else F.max)(c).alias(c) for c in MEASURES]
    )


@dataclass(frozen=True)
class CartStore:
    """Where the increments of one signal are kept. Increments are numbered from 0 without gaps."""

    root: str
    n_buckets: int = 64

    def _path(self, name: str, number: int) -> str:
        return f"{self.root}/{name}/increment={number}"

    def _read(self, spark: SparkSession, name: str, number: int) -> DataFrame | None:
        path = self._path(name, number)
        return spark.read.parquet(path) if table_exists(spark, path) else None

    def _returned(self, spark: SparkSession, ids: DataFrame, before: int) -> DataFrame:
        """The stored states of carts in ``ids`` that had left before increment ``before``: of each the one stored last."""
        kept = self._read(spark, "active", before - 1).schema
        schema = T.StructType([*kept.fields, T.StructField("increment", T.IntegerType()), T.StructField(BUCKET, T.IntegerType())])
        wanted, size = staged_with_size(ids.select("cart_id", key_bucket(["cart_id"], self.n_buckets).alias("_b")), "returned")
        met = [r["_b"] for r in wanted.select("_b").distinct().collect()]
        stored = spark.read.schema(schema).parquet(f"{self.root}/dormant").where(F.col(BUCKET).isin(met) & (F.col("increment") < before))
        found = stored.join(broadcast_if_small(wanted.select(F.col("cart_id").alias("_id")), size), F.col("cart_id") == F.col("_id"), "left_semi")
        state = F.struct("known", *MEASURES)
        last = found.groupBy("cart_id").agg(F.max_by(state, "increment").alias("s"))
        return last.select("cart_id", "s.*")

    def advance(
        self,
        spark: SparkSession,
        number: int,
        events: DataFrame,
        as_of: AsOf = None,
        *,
        policy: CartPolicy = CartPolicy(),
        names: EventNames = EventNames(),
    ) -> None:
        """Merge ``events``, those that no earlier increment has had, into the state as of ``as_of``.

        Events later than ``as_of`` wait for a later increment. Increment n is made from n - 1 into folders of its own,
        so one that died or is run again gives the same state, as long as it gets the same events and time.
        """
        if number and not table_exists(spark, self._path("active", number - 1)):
            raise ValueError(f"increment {number - 1} of {self.root} is missing")
        now = instant_like(events, "event_timestamp", as_of)
        waiting = self._read(spark, "waiting", number - 1) if number else None
        arrived = events if waiting is None else events.unionByName(waiting, allowMissingColumns=True)
        columns = ["cart_id", "customer_id", "event_type", "event_timestamp", "price_at_event", "quantity"]
        relevant = arrived.select(*columns).where(F.col("event_type").isin(*names.cart))
        with staging_area(spark, "cart-increment"):
            relevant.where(F.col("event_timestamp") > now).write.mode("overwrite").parquet(self._path("waiting", number))
            parts = staged(cart_parts(relevant.where(F.col("event_timestamp") <= now), names), "parts")
            if number:
                active = self._read(spark, "active", number - 1)
                known = active.select(F.col("cart_id").alias("_id"))
                new = parts.join(known, F.col("cart_id").eqNullSafe(F.col("_id")), "left_anti")
                parts = parts.unionByName(active).unionByName(self._returned(spark, new.where("cart_id IS NOT NULL"), number))
            state = staged(_summed(parts), "state")
            recent = F.col("last_activity_at") > now - days(horizon_days(policy))
            # Rows without a cart are one cart to the signal; it never leaves, as ids are needed to find it again.
            stays = recent | F.col("cart_id").isNull()
            gone = state.where(~stays).withColumn(BUCKET, key_bucket(["cart_id"], self.n_buckets))
            folder = self._path("dormant", number)
            gone.hint("rebalance", F.col(BUCKET)).sortWithinPartitions(BUCKET, "cart_id").write.mode("overwrite").partitionBy(BUCKET).parquet(folder)
            # Last of all: an increment is there once its active carts are.
            state.where(stays).write.mode("overwrite").parquet(self._path("active", number))

    def carts(self, spark: SparkSession, number: int) -> DataFrame:
        """The state of every cart active within the horizon, in the columns of ``cart_state``."""
        state = spark.read.parquet(self._path("active", number))
        return state.select("cart_id", F.col("known.customer_id").alias("customer_id"), *MEASURES)

    def signal(
        self,
        spark: SparkSession,
        number: int,
        orders: DataFrame,
        as_of: AsOf = None,
        *,
        policy: CartPolicy = CartPolicy(),
        states: OrderStates = OrderStates(),
        percentile_method: str = "approx",
    ) -> DataFrame:
        """``cart_recovery_signal`` from the state of increment ``number``; ``as_of`` is that of the increment."""
        carts = self.carts(spark, number)
        now = instant_like(carts, "last_activity_at", as_of)
        return signal_of(carts, orders, now, policy, states, percentile_method)
