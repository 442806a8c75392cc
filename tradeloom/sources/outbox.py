"""The outbox table as a stream source: its offset is the last id handed out."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

SCHEMA = "id bigint, event_type string, entity_id string, payload string, created_at timestamp_ntz"
# Ids that one task reads.
TASK_IDS = 1_000_000


@dataclass
class IdRange(InputPartition):
    """Ids above ``after`` up to ``upto``."""

    after: int
    upto: int


class OutboxReader(DataSourceStreamReader):
    """Batches of new ids, cut into ranges; a range reads the row groups that hold its ids and no others.

    Offsets are kept in the query's checkpoint: a stopped query goes on behind
    the last batch it planned, and a batch that was planned but not finished is
    read again with the same ids.
    """

    def __init__(self, schema, options: dict[str, str]):
        self.schema = schema
        self.path = options["path"]
        self.start = int(options.get("startingId", "0"))
        self.step = int(options.get("taskIds", str(TASK_IDS)))

    def _table(self) -> ds.Dataset:
        return ds.dataset(self.path.removeprefix("file:"), format="parquet")

    def initialOffset(self) -> dict:
        return {"id": self.start}

    def latestOffset(self) -> dict:
        """Largest id, from the files' footers; only files without statistics are read."""
        top = self.start
        for file in self._table().get_fragments():
            meta = file.metadata
            at = meta.schema.names.index("id")
            for g in range(meta.num_row_groups):
                told = meta.row_group(g).column(at).statistics
                if told is not None and told.has_min_max:
                    top = max(top, told.max)
                elif meta.row_group(g).num_rows:
                    top = max(top, pc.max(file.to_table(columns=["id"]).column("id")).as_py() or top)
        return {"id": top}

    def partitions(self, start: dict, end: dict) -> list[IdRange]:
        return [IdRange(a, min(a + self.step, end["id"])) for a in range(start["id"], end["id"], self.step)]

    def read(self, partition: IdRange) -> Iterator[pa.RecordBatch]:
        own = (ds.field("id") > partition.after) & (ds.field("id") <= partition.upto)
        names = [f.name for f in self.schema.fields]
        for batch in self._table().to_batches(columns=names, filter=own):
            if batch.num_rows:
                at = batch.schema.get_field_index("created_at")
                columns = list(batch.columns)
                if at >= 0:
                    columns[at] = columns[at].cast(pa.timestamp("us"))
                yield pa.RecordBatch.from_arrays(columns, names=names)


class OutboxSource(DataSource):
    """``spark.readStream.format("outbox").option("path", folder)``: rows of an append-only Parquet outbox by rising id.

    Options: ``startingId`` (hand out ids above it), ``taskIds`` (ids a task
    reads).  Ids must rise with the order of writing, as a serial key's do; the
    folder must be visible to driver and executors under the same path.
    """

    @classmethod
    def name(cls) -> str:
        return "outbox"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> OutboxReader:
        return OutboxReader(schema, self.options)


def read_outbox_stream(spark: SparkSession, path: str, starting_id: int = 0, task_ids: int = TASK_IDS):
    """A stream of the outbox rows above ``starting_id``."""
    spark.dataSource.register(OutboxSource)
    options = {"path": path, "startingId": str(starting_id), "taskIds": str(task_ids)}
    return spark.readStream.format("outbox").options(**options).load()
