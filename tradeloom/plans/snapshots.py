"""Keyed tables on plain Parquet: partitions replaced in versions.

Parquet has no MERGE.  A table here is a folder of partition versions and one
small file per batch saying which version of each partition is current::

    <path>/data/<version>/part=<p>/...
    <path>/log/<number>.json      batch id and {partition: version}, complete

A commit writes new versions of the partitions it touches and then the log file
with the next number.  Readers of the old versions are not disturbed, a crash
before the log file leaves no trace, and a batch committed once is skipped when
replayed.  Of two writers that start from the same state one gets the number;
the other fails and may try again.  Log files and versions that only older
states need are deleted along the way.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.plans.ordered import top_per_group
from tradeloom.plans.sizing import MIB, source_bytes
from tradeloom.plans.staging import delete_folder, list_names, read_text, stage, write_text

# What one writer should take at most, what is not worth another writer, and how many may run at most.
FILE_ROWS = 2_000_000
FILE_BYTES = 128 * MIB
SMALL_ROWS = 100_000
MAX_WRITERS = 10_000
# States that stay readable behind the current one.
KEEP = 10


class ConcurrentCommit(RuntimeError):
    """Another writer committed first."""


class SnapshotTable:
    """``schema`` is the DDL of the rows; ``part`` derives the partition label.

    Choose ``part`` so that a commit touches few partitions (a month, a hash
    bucket of the key) and their number stays in the thousands: the log of
    current versions is the only thing read by the driver.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: list[str], part: Column):
        self.spark, self.path, self.schema, self.keys = spark, path.rstrip("/"), schema, keys
        self.part = F.coalesce(part.cast("string"), F.lit("none"))

    def _latest(self) -> tuple[int, int, dict[str, str]]:
        """Number of the last commit and its batch (-1: none), and the current
        version of each partition."""
        names = list_names(self.spark, f"{self.path}/log")
        if not names:
            return -1, -1, {}
        state = json.loads(read_text(self.spark, f"{self.path}/log/{names[-1]}"))
        return int(names[-1].split(".")[0]), state["batch"], state["versions"]

    def last_batch(self) -> int:
        return self._latest()[1]

    def read(self, parts: list[str] | None = None) -> DataFrame:
        """Current rows; with ``parts`` only of these partitions, and no other file is opened."""
        versions = self._latest()[2]
        if parts is not None:
            versions = {p: versions[p] for p in parts if p in versions}
        return self._read(versions)

    def parts_of(self, rows: DataFrame) -> list[str]:
        """Labels of the partitions that ``rows`` belong to: at most as many as the log names."""
        return [r["part"] for r in rows.select(self.part.alias("part")).distinct().collect()]

    def _read(self, versions: dict[str, str]) -> DataFrame:
        if not versions:
            return self.spark.createDataFrame([], self.schema)
        # Few versions, each pruned to the partitions it is current for.
        by_version: dict[str, list[str]] = {}
        for p, v in versions.items():
            by_version.setdefault(v, []).append(p)
        schema = f"{self.schema}, part string"
        pieces = [
            self.spark.read.schema(schema).parquet(f"{self.path}/data/{v}").where(F.col("part").isin(ps))
            for v, ps in by_version.items()
        ]
        return reduce(DataFrame.unionByName, pieces).drop("part")

    def _writers(self, sizes: dict[str, int], touched: dict[str, str], old: DataFrame) -> tuple[Column, int]:
        """The writer of a row, and how many there are.

        Every core gets its share.  A partition larger than a share is dealt by
        key over writers of its own, as many as its rows ask for; the others go
        whole to one of the rest.
        """
        stored = {r["part"]: r["count"] for r in old.groupBy(self.part.alias("part")).count().collect()} if touched else {}
        rows = {p: n + stored.get(p, 0) for p, n in sizes.items()}
        total, cores = sum(rows.values()), self.spark.sparkContext.defaultParallelism
        most = FILE_ROWS
        if stored:
            most = min(most, max(1, FILE_BYTES * sum(stored.values()) // max(1, source_bytes(old))))
        share = max(min(most, max(SMALL_ROWS, total // (2 * cores))), 2 * total // MAX_WRITERS, 1)
        first, own = 0, []
        for p in sorted(p for p in rows if rows[p] > share):
            n = -(-rows[p] // share)
            own += [F.lit(p), F.struct(F.lit(first).alias("first"), F.lit(n).alias("n"))]
            first += n
        rest = -(-sum(n for n in rows.values() if n <= share) // share)
        among = F.lit(first) + F.pmod(F.xxhash64("part"), F.lit(max(1, rest)))
        if own:
            mine = F.create_map(*own)[F.col("part")]
            among = F.coalesce(mine["first"] + F.pmod(F.xxhash64(*self.keys), mine["n"]), among)
        return among.cast("int"), first + max(1, rest)

    def commit(self, batch: DataFrame, combine: Callable[[DataFrame, DataFrame], DataFrame], batch_id: int) -> bool:
        """Combine the touched partitions with ``batch``; False if seen before."""
        number, last, current = self._latest()
        if batch_id <= last:
            return False
        labelled = batch.withColumn("part", self.part)
        sizes = {r["part"]: r["count"] for r in labelled.groupBy("part").count().collect()}
        touched = {p: current[p] for p in sizes if p in current}
        if sizes:
            version = f"{batch_id:012d}-{uuid.uuid4().hex[:8]}"
            old = self._read(touched)
            merged = combine(old, batch.select(*old.columns))
            out = merged.withColumn("part", self.part)
            writer, writers = self._writers(sizes, touched, old)
            dealt = out.withColumn("_writer", writer).repartitionById(writers, F.col("_writer")).drop("_writer")
            dealt.write.partitionBy("part").parquet(f"{self.path}/data/{version}")
            current = {**current, **dict.fromkeys(sizes, version)}
        state = json.dumps({"batch": batch_id, "versions": current})
        if not write_text(self.spark, f"{self.path}/log/{number + 1:020d}.json", state):
            raise ConcurrentCommit(f"{self.path}: commit {number + 1} was made by another writer")
        if number % KEEP == 0:
            self.prune()
        return True

    def prune(self, keep: int = KEEP) -> int:
        """Delete all but the last ``keep`` log files, and versions none of them refers to.

        Only versions older than the oldest kept state go, so what another
        writer has begun is left alone; returns the number of folders deleted.
        """
        names = list_names(self.spark, f"{self.path}/log")
        kept = [json.loads(read_text(self.spark, f"{self.path}/log/{n}")) for n in names[-keep:]]
        if not kept:
            return 0
        live = {v for state in kept for v in state["versions"].values()}
        oldest = min(state["batch"] for state in kept)
        dead = [v for v in list_names(self.spark, f"{self.path}/data") if v not in live and int(v.split("-")[0]) < oldest]
        for version in dead:
            delete_folder(self.spark, f"{self.path}/data/{version}")
        for name in names[:-keep]:
            delete_folder(self.spark, f"{self.path}/log/{name}")
        return len(dead)

    def upsert(self, batch: DataFrame, batch_id: int) -> bool:
        """Replace rows by key."""
        return self.commit(batch, lambda old, new: old.join(new, self.keys, "left_anti").unionByName(new), batch_id)

    def insert_new(self, batch: DataFrame, order: list[str], batch_id: int) -> tuple[int, int] | None:
        """Add the rows whose key is not taken, of equal new keys the first by ``order``; None if seen before.

        Returns how many rows were added and how many skipped.  A key with a
        null in it conflicts with nothing, as under a unique constraint.  Only
        the rows of the touched partitions are looked at, so ``part`` must be
        derived from the key.
        """
        batch = stage(batch, "offered")
        keyed = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in self.keys])
        added: list[DataFrame] = []

        def combine(old: DataFrame, new: DataFrame) -> DataFrame:
            first = top_per_group(new.where(keyed), self.keys, order, 1).join(old, self.keys, "left_anti")
            added.append(stage(first.select(*old.columns).unionByName(new.where(~keyed)), "added"))
            return old.unionByName(added[0])

        if not self.commit(batch, combine, batch_id):
            return None
        taken = added[0].count() if added else 0
        return taken, batch.count() - taken

    def add(self, batch: DataFrame, counters: list[str], batch_id: int) -> bool:
        """Add counters by key."""

        def combine(old: DataFrame, new: DataFrame) -> DataFrame:
            summed = old.unionByName(new).groupBy(*self.keys).agg(*[F.sum(c).alias(c) for c in counters])
            return summed.select(*old.columns)

        return self.commit(batch, combine, batch_id)

    def move(self, batch: DataFrame, count: str, batch_id: int) -> bool:
        """Add a signed ``count`` by key and drop the keys at zero."""

        def combine(old: DataFrame, new: DataFrame) -> DataFrame:
            summed = old.unionByName(new).groupBy(*self.keys).agg(F.sum(count).alias(count))
            return summed.where(F.col(count) != 0).select(*old.columns)

        return self.commit(batch, combine, batch_id)
