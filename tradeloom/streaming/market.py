"""Market streams: an endless feed of orders and reviews, and the wide order fact filled as both come in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tradeloom.operators.generate import Feed
from tradeloom.operators.joins import customers, numbered_pool, order_facts
from tradeloom.plans.ordered import top_per_group
from tradeloom.plans.snapshots import SnapshotTable
from tradeloom.plans.staging import stage
from tradeloom.streaming.jobs import held, start

# ---------------------------------------------------------------- feed

FEED_ORDERS = "order_id bigint, user_id bigint, good_id bigint, order_ts timestamp_ntz, price double"
FEED_REVIEWS = "review_id bigint, order_id bigint, user_id bigint, good_id bigint, rating bigint, review_ts timestamp_ntz"
FEED_RUNS = "batch bigint, ticks bigint, said bigint, kept bigint, skipped bigint"
BUCKETS = 16


class EndlessFeed:
    """The order and review feed as a stream of ticks: three orders and two reviews each, one second apart.

    A row is a function of its number, so a batch that is run again, or the
    whole feed started anew, gives the same rows.  Reviews are inserted if
    their user has not reviewed the good yet; ``runs`` says per batch how many
    were kept and skipped, worked out from the stored reviews, so a crash
    between two commits loses no count.  Orders only ever come new and are
    appended, a folder for each batch.
    """

    def __init__(self, spark: SparkSession, path: str, seed: int = 81):
        bucket = F.pmod(F.xxhash64("user_id", "good_id"), F.lit(BUCKETS))
        self.spark, self.path, self.seed = spark, path.rstrip("/"), seed
        self.reviews = SnapshotTable(spark, f"{path}/reviews", FEED_REVIEWS, ["user_id", "good_id"], bucket)
        self.runs = SnapshotTable(spark, f"{path}/runs", FEED_RUNS, ["batch"], F.floor(F.col("batch") / 10_000))

    def orders(self) -> DataFrame:
        return self.spark.read.schema(FEED_ORDERS + ", batch bigint").parquet(f"{self.path}/orders").drop("batch")

    def run(
        self, users: DataFrame, goods: DataFrame, checkpoint: str, start_at: str, ticks: int = 1000, until: int | None = None,
        every: str | None = None,
    ) -> StreamingQuery:
        """Take ``ticks`` more ticks a batch; without ``every`` one batch, then stop.  Ticks from ``until`` on are left out.

        Customers and goods are those of the start: they are numbered and
        stored once, and all batches draw from them.
        """

        def pool(rows: DataFrame, member: str) -> tuple[DataFrame, object]:
            numbered = stage(numbered_pool(rows, member)[0], f"pool-{member}")
            return numbered, F.lit(numbered.count())

        feed = Feed(pool(customers(users), "user_id"), pool(goods, "good_id"), start_at, self.seed)
        source = self.spark.readStream.format("rate-micro-batch").option("rowsPerBatch", ticks)
        seconds = source.option("numPartitions", self.spark.sparkContext.defaultParallelism).load()
        own = seconds.select(F.col("value").alias("tick"))
        if until is not None:
            own = own.where(F.col("tick") < until)

        def each(batch: DataFrame, batch_id: int) -> None:
            feed.orders(batch).write.mode("overwrite").parquet(f"{self.path}/orders/batch={batch_id}")
            said = feed.reviews(batch)
            self.reviews.insert_new(said, ["review_id"], batch_id)
            ends = batch.agg(F.min("tick").alias("a"), F.max("tick").alias("b"), F.count(F.lit(1)).alias("n")).first()
            if not ends["n"]:
                return
            kept = self.reviews.read().where(F.col("review_id").between(2 * ends["a"] + 1, 2 * ends["b"] + 2)).count()
            row = (batch_id, ends["n"], 2 * ends["n"], kept, 2 * ends["n"] - kept)
            self.runs.upsert(self.spark.createDataFrame([row], FEED_RUNS), batch_id)

        return start(own, held(each), checkpoint, "append", every)


# ---------------------------------------------------------------- wide fact

ORDER_ID = "decimal(38,0)"
NOBODY = -1
FACTS = (
    "order_id {id}, user_id bigint, merchant_id bigint, good_id bigint, category_id bigint, category_name string, merchant_name string,"
    " good_name string, rating bigint, has_review int, order_date date, order_timestamp timestamp_ntz"
)
RATINGS = "user_id bigint, good_id bigint, rating bigint, review_ts timestamp_ntz"


class OrderFacts:
    """``joins.order_facts`` filled from two streams.

    Orders meet reviews in a stream-stream left outer join: a review within
    ``within`` of its order comes out with it, and an order without one comes
    out when the watermark has passed.  What such a join cannot give is done
    by key, in the same batch:

    * An order that came out without a review is looked up among the stored
      ratings: the user may have reviewed the good on an earlier order.
    * A review is given to the stored facts of its user and good that have none
      yet.  Facts are searched by four columns, and only the parts that hold a
      hit (a month each, or another ``period``) are rewritten.
    * An order ``grace`` or more behind the newest one seen in earlier
      batches may be dropped by the join as too late, so it is also written
      directly; writing a fact twice changes nothing.

    So the table equals ``order_facts`` of all input as far as the watermark
    has closed the orders, however late rows come, and whole at the end of a
    stream whose last rows move the watermark on (``closing_rows``).  A user
    reviews a good once; of more reviews the last batch's counts.
    """

    def __init__(self, spark: SparkSession, path: str, order_id: str = ORDER_ID, period: str = "yyyy-MM"):
        self.spark, self.id, self.period = spark, order_id, period
        by_order, by_review = (F.date_format(c, period) for c in ("order_date", "review_ts"))
        self.facts = SnapshotTable(spark, f"{path}/facts", FACTS.format(id=order_id), ["order_id"], by_order)
        self.ratings = SnapshotTable(spark, f"{path}/ratings", RATINGS, ["user_id", "good_id"], by_review)
        self.marks = SnapshotTable(spark, f"{path}/marks", "name string, newest timestamp_ntz", ["name"], F.lit("all"))

    def fill(
        self, orders: DataFrame, reviews: DataFrame, users: DataFrame, goods: DataFrame, categories: DataFrame, checkpoint: str,
        within: str = "30 days", grace: str = "1 day", every: str | None = None,
    ) -> StreamingQuery:
        """Start filling.  Streams of ``id, user_id, good_id, order_ts`` and ``user_id, good_id, rating, review_ts``."""
        ordered = orders.select(F.col("id").cast(self.id).alias("id"), "user_id", "good_id", F.col("order_ts").cast("timestamp"))
        said = reviews.select("user_id", "good_id", F.col("rating").cast("bigint"), F.col("review_ts").cast("timestamp"))
        right = said.withWatermark("review_ts", grace).select(
            F.col("user_id").alias("_user"), F.col("good_id").alias("_good"), "rating", "review_ts"
        )
        near = (
            (F.col("user_id") == F.col("_user")) & (F.col("good_id") == F.col("_good"))
            & (F.col("review_ts") >= F.col("order_ts")) & (F.col("review_ts") <= F.col("order_ts") + F.expr(f"INTERVAL {within}"))
        )
        closed = ordered.withWatermark("order_ts", grace).join(right, near, "left_outer").drop("_user", "_good")
        rows = (
            closed.withColumn("kind", F.lit("closed"))
            .unionByName(ordered.withColumn("kind", F.lit("order")), allowMissingColumns=True)
            .unionByName(said.withColumn("kind", F.lit("review")), allowMissingColumns=True)
        )

        def each(batch: DataFrame, batch_id: int) -> None:
            self._take(batch.where(~F.col("user_id").eqNullSafe(NOBODY)), batch_id, users, goods, categories, grace)

        return start(rows, held(each), checkpoint, "append", every)

    def _take(self, batch: DataFrame, batch_id: int, users: DataFrame, goods: DataFrame, categories: DataFrame, grace: str) -> None:
        ntz = [F.col(c).cast("timestamp_ntz").alias(c) for c in ("order_ts", "review_ts")]
        rows = batch.select("kind", "id", "user_id", "good_id", "rating", *ntz)
        pair = ["user_id", "good_id"]
        fresh = top_per_group(rows.where("kind = 'review'").select(*pair, "rating", "review_ts"), pair, ["review_ts", "rating"], 1)
        fresh = stage(fresh, "fresh-ratings")
        # A batch of the watermark alone brings no review.
        reviewed = not fresh.isEmpty()
        if reviewed:
            self.ratings.upsert(fresh, batch_id)

        newest = self.marks.read().agg(F.max("newest").cast("string").alias("t")).first()["t"]
        late = F.lit(False) if newest is None else F.col("order_ts") <= F.lit(newest).cast("timestamp_ntz") - F.expr(f"INTERVAL {grace}")
        came = rows.where((F.col("kind") == "closed") | ((F.col("kind") == "order") & F.coalesce(late, F.lit(True))))
        # A row that the join gave a review wins over the same order taken directly.
        came = stage(top_per_group(came, ["id"], [F.col("review_ts").isNull(), "kind"], 1), "came")
        rated = came.where("review_ts IS NOT NULL").select(*pair, "rating")
        # Stored ratings are few next to orders: folded whole, they need no look at the orders' pairs first.
        known = rated.unionByName(self.ratings.read().select(*pair, "rating")).groupBy(*pair).agg(F.max("rating").alias("rating"))
        new = order_facts(came.select("id", *pair, "order_ts"), users, goods, categories, known)

        changed = new.select(*self.facts.read([]).columns)
        if reviewed:
            changed = changed.unionByName(self._found(fresh).join(came.select(F.col("id").alias("order_id")), "order_id", "left_anti"))
        self.facts.upsert(stage(changed, "changed-facts"), batch_id)

        top = rows.where("kind = 'order'").agg(F.max("order_ts").cast("string").alias("t")).first()["t"]
        if top is not None and (newest is None or top > newest):
            mark = self.spark.range(1).select(F.lit("orders").alias("name"), F.lit(top).cast("timestamp_ntz").alias("newest"))
            self.marks.upsert(mark, batch_id)

    def _found(self, fresh: DataFrame) -> DataFrame:
        """Stored facts without a review whose user and good are in ``fresh``, with that rating."""
        pair = ["user_id", "good_id"]
        hit = self.facts.parts_of(self.facts.read().where("has_review = 0").join(fresh, pair, "left_semi"))
        given = fresh.select(*pair, F.coalesce("rating", F.lit(0)).alias("_rating"))
        found = self.facts.read(hit).where("has_review = 0").join(given, pair)
        found = found.withColumns({"rating": F.col("_rating"), "has_review": F.lit(1)})
        return found.select(*self.facts.read([]).columns)


def closing_rows(spark: SparkSession, at: str) -> tuple[DataFrame, DataFrame]:
    """One order and one review of nobody (user -1) at a time behind all others: they move the watermark on and are not kept."""
    when = F.lit(at).cast("timestamp_ntz")
    nobody = [F.lit(NOBODY).cast("bigint").alias(c) for c in ("user_id", "good_id")]
    one = spark.range(1)
    order = one.select(F.lit(NOBODY).cast("bigint").alias("id"), *nobody, when.alias("order_ts"))
    return order, one.select(*nobody, F.lit(None).cast("bigint").alias("rating"), when.alias("review_ts"))
