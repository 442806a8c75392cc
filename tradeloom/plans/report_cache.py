"""Stored reports: kept while their inputs are unchanged and they are young."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tradeloom.plans.staging import list_names, read_text, write_text


class ReportCache:
    """One folder of stored results, each tagged with its input versions."""

    def __init__(self, spark: SparkSession, path: str, max_age_s: float = 300.0):
        self.spark, self.path, self.max_age_s = spark, path.rstrip("/"), max_age_s

    def get(
        self, name: str, inputs: dict[str, str], now: float, compute: Callable[[], DataFrame]
    ) -> tuple[DataFrame, str]:
        """The report and where it came from: 'cache' or 'fresh'.

        A changed input version or an age of ``max_age_s`` makes it compute
        again; dropping a cached report is giving its input a new version.
        """
        tag = json.dumps([name, sorted(inputs.items())])
        key = hashlib.sha256(tag.encode()).hexdigest()
        for entry in reversed([n for n in list_names(self.spark, f"{self.path}/log") if n.startswith(key)]):
            known = json.loads(read_text(self.spark, f"{self.path}/log/{entry}"))
            if now - self.max_age_s < known["made_at"] <= now:
                return self.spark.read.parquet(known["folder"]), "cache"
        folder = f"{self.path}/{uuid.uuid4().hex}"
        compute().write.parquet(folder)
        name = f"{key}-{round(now * 1000):020d}-{uuid.uuid4().hex[:8]}.json"
        write_text(self.spark, f"{self.path}/log/{name}", json.dumps({"folder": folder, "made_at": now}))
        return self.spark.read.parquet(folder), "fresh"
