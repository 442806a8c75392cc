"""Results that are kept and changed by batches instead of computed anew.

Each class holds keyed tables and takes numbered batches.  A batch with a
number seen before changes nothing.  Where a batch touches several tables, all
changes are worked out from the old state and stored before the first commit,
and the table that later batches start from is committed last: after a crash
in between, the same batch under the same number completes the rest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradeloom.plans.ordered import row_index
from tradeloom.plans.snapshots import SnapshotTable
from tradeloom.plans.staging import stage

# 2^14 registers: a standard error of 0.8 %.
SKETCH_BITS = 14
BUCKETS = 16


class VisitorSketches:
    """Distinct users per event type over any days, from one sketch per day and type.

    A sketch has a bounded size whatever the number of events, and merging is a
    union: the same event in two batches counts once.  Events without a user
    are not counted; events without a time have a day of their own, null, that
    no range contains.
    """

    def __init__(self, spark: SparkSession, path: str):
        month = F.date_format("day", "yyyy-MM")
        self.table = SnapshotTable(spark, path, "day date, event_type string, users binary", ["day", "event_type"], month)

    def add(self, events: DataFrame, batch_id: int) -> bool:
        """``events`` has ``ts``, ``event_type`` and ``user_id``; only the months of the batch are rewritten."""
        days = events.groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.hll_sketch_agg("user_id", SKETCH_BITS).alias("users"))

        def merge(old: DataFrame, new: DataFrame) -> DataFrame:
            return old.unionByName(new).groupBy("day", "event_type").agg(F.hll_union_agg("users").alias("users"))

        return self.table.commit(stage(days, "day-sketches"), merge, batch_id)

    def between(self, first: str, last: str) -> DataFrame:
        """``(event_type, users)`` of the days from ``first`` to ``last``, both included; other months are not read."""
        months = [
            r["m"]
            for r in self.table.spark.range(1)
            .select(F.explode(F.expr(f"sequence(trunc(DATE'{first}', 'MM'), trunc(DATE'{last}', 'MM'), interval 1 month)")).alias("d"))
            .select(F.date_format("d", "yyyy-MM").alias("m"))
            .collect()
        ]
        days = self.table.read(months).where(F.col("day").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
        return days.groupBy("event_type").agg(F.hll_sketch_estimate(F.hll_union_agg("users")).alias("users"))


class Leaderboard:
    """Members by score, highest first, ties by member: a rank reads one band of scores.

    Three tables: the score of each member (hash buckets of the member), the
    board (members by band of their score) and the number of members in each
    band.  A batch of score changes moves its members out of their old band and
    into the new one; other bands are not rewritten.

    ``band`` is a number that never falls as the column ``score`` rises; choose
    it so that there are at most a few thousand bands.
    """

    def __init__(self, spark: SparkSession, path: str, band: Column, member: str = "bigint", score: str = "bigint"):
        self.band = band
        rows = f"member {member}, score {score}"
        bucket = F.pmod(F.xxhash64("member"), F.lit(BUCKETS))
        self.scores = SnapshotTable(spark, f"{path}/scores", rows, ["member"], bucket)
        self.board = SnapshotTable(spark, f"{path}/board", f"{rows}, n bigint", ["member", "score"], band)
        self.counts = SnapshotTable(spark, f"{path}/bands", "band bigint, n bigint", ["band"], F.lit("all"))
        self.type = score

    def add(self, changes: DataFrame, batch_id: int) -> bool:
        """Add signed scores ``(member, score)``; null members are left out, null scores are 0."""
        if batch_id <= self.scores.last_batch():
            return False
        folded = changes.where("member IS NOT NULL").groupBy("member").agg(F.coalesce(F.sum("score"), F.lit(0)).cast(self.type).alias("change"))
        folded = stage(folded, "score-changes")
        before = self.scores.read(self.scores.parts_of(folded))
        after = F.coalesce(F.col("score"), F.lit(0)).cast(self.type) + F.col("change")
        joined = folded.join(before, "member", "left").select("member", "score", after.cast(self.type).alias("after"))
        moves = stage(joined, "score-moves")
        out = moves.where("score IS NOT NULL").select("member", "score", F.lit(-1).cast("bigint").alias("n"))
        into = moves.select("member", F.col("after").alias("score"), F.lit(1).cast("bigint").alias("n"))
        signed = out.unionByName(into)
        counted = stage(signed.groupBy(self.band.cast("bigint").alias("band")).agg(F.sum("n").alias("n")), "band-moves")
        self.board.move(signed, "n", batch_id)
        self.counts.add(counted, ["n"], batch_id)
        return self.scores.upsert(moves.select("member", F.col("after").alias("score")), batch_id)

    def _placed(self, rows: DataFrame) -> DataFrame:
        # One row per band is ordered here, never members.
        above = W.partitionBy(F.lit(0)).orderBy(F.desc("band")).rowsBetween(W.unboundedPreceding, -1)
        ahead = self.counts.read().select(F.col("band").alias("_band"), F.coalesce(F.sum("n").over(above), F.lit(0)).alias("_ahead"))
        banded = rows.drop("n").withColumn("_band", self.band.cast("bigint"))
        inside = row_index(banded, ["_band"], [F.desc("score"), F.col("member")], number="_inside")
        return inside.join(ahead, "_band").select("member", "score", (F.col("_ahead") + F.col("_inside")).alias("position"))

    def positions(self) -> DataFrame:
        """``(member, score, position)`` of all members, band by band."""
        return self._placed(self.board.read())

    def positions_of(self, members: DataFrame) -> DataFrame:
        """Positions of the given members; reads their buckets, their bands and the counts of bands."""
        asked = members.select("member").distinct()
        own = stage(self.scores.read(self.scores.parts_of(asked)).join(asked, "member", "left_semi"), "asked-scores")
        return self._placed(self.board.read(self.board.parts_of(own))).join(own.select("member"), "member", "left_semi")

    def between(self, low: int, high: int) -> DataFrame:
        """Members with a score from ``low`` to ``high``, both included, with their positions."""
        ends = self.board.spark.createDataFrame([(low,), (high,)], "score bigint").select(F.col("score").cast(self.type).alias("score"))
        first, last = [r["b"] for r in ends.select(self.band.cast("bigint").alias("b"), "score").orderBy("score").collect()]
        bands = self.counts.read().where(F.col("band").between(first, last)).select(F.col("band").cast("string").alias("p"))
        rows = self.board.read([r["p"] for r in bands.collect()])
        return self._placed(rows).where(F.col("score").between(low, high))


class OrphanWatch:
    """Children whose parent does not exist, kept while children and parents come and go.

    With a batch, the list of lost children changes by

    * the batch's own children whose parent does not exist after it,
    * the older children of parents that the batch took away, and
    * less the lost children of parents that it brought.

    Children and lost ones lie in hash buckets of the foreign key, so only the
    buckets of parents that came or went are read, and only buckets whose lists
    change are rewritten.  A parent that stays is never joined with its
    children.  Changes are signed: +1 for a row that comes, -1 for one that
    goes; a parent exists while its sum is above 0.  Children without a key
    have no parent to miss and are left out.
    """

    def __init__(self, spark: SparkSession, path: str, key: str = "bigint", child: str = "bigint", buckets: int = BUCKETS):
        by_key = F.pmod(F.xxhash64("key"), F.lit(buckets))
        rows = f"child {child}, key {key}, n bigint"
        self.parents = SnapshotTable(spark, f"{path}/parents", f"key {key}, n bigint", ["key"], by_key)
        self.children = SnapshotTable(spark, f"{path}/children", rows, ["child", "key"], by_key)
        self.lost = SnapshotTable(spark, f"{path}/lost", rows, ["child", "key"], by_key)

    def apply(self, parents: DataFrame, children: DataFrame, batch_id: int) -> bool:
        """One batch of signed ``(key, n)`` and ``(child, key, n)``."""
        if batch_id <= self.children.last_batch():
            return False
        new_parents = stage(parents.where("key IS NOT NULL").groupBy("key").agg(F.sum("n").alias("n")), "parent-changes")
        new_children = stage(
            children.where("key IS NOT NULL").groupBy("child", "key").agg(F.sum("n").alias("n")).where("n <> 0"), "child-changes"
        )
        # After a crash behind the commit of parents, their table holds this batch already.
        done = self.parents.last_batch() >= batch_id
        if not done:
            here = self.parents.read(self.parents.parts_of(new_parents)).withColumnRenamed("n", "was")
            sums = new_parents.join(here, "key", "left").withColumn("was", F.coalesce("was", F.lit(0)))
            flips = stage(
                sums.select("key", (F.col("was") > 0).alias("was"), (F.col("was") + F.col("n") > 0).alias("now")).where("was <> now"), "flips"
            )
            went, came = flips.where("was").select("key"), flips.where("now").select("key")
            # Parents as they are after the batch, in the buckets of the batch's children.
            alive = self.parents.read(self.parents.parts_of(new_children)).unionByName(new_parents)
            alive = alive.groupBy("key").agg(F.sum("n").alias("n")).where("n > 0").select("key")
            own = new_children.join(alive, "key", "left_anti").select("child", "key", "n")
            left = self.children.read(self.children.parts_of(went)).join(went, "key", "left_semi")
            found = self.lost.read(self.lost.parts_of(came)).join(came, "key", "left_semi")
            change = own.unionByName(left.select("child", "key", "n")).unionByName(found.select("child", "key", (-F.col("n")).alias("n")))
            self.lost.move(stage(change, "lost-changes"), "n", batch_id)
            self.parents.move(new_parents, "n", batch_id)
        return self.children.move(new_children, "n", batch_id)

    def orphans(self) -> DataFrame:
        """``(child, key)`` of the children that have no parent now."""
        return self.lost.read().where("n > 0").select("child", "key")
