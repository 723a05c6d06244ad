"""An index table that grows by batches, kept as few sorted runs.

Batch n is a run of level 0. Two neighbouring runs of one level become one of the next, so n
batches leave at most 1 + log2(n) runs and every row is rewritten log2(n) times at most. A file
for each batch says which runs are current; a batch whose file is there was taken in before
and changes nothing when it comes again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metalake.operators import tables
from metalake.plans import files


class Levels:
    def __init__(self, spark: SparkSession, root: str, key: list[str], partitions: int = 8):
        self.spark, self.root, self.key, self.partitions = spark, root.rstrip("/"), key, partitions

    def _last(self) -> dict:
        # the last file alone is read: names sort by batch
        names = sorted(f for f in files.listed(self.spark, f"{self.root}/_runs") if f.endswith(".json"))
        return files.records(self.spark, names[-1])[0] if names else {"batch": -1, "runs": []}

    def runs(self) -> list[dict]:
        """The current runs, oldest first: level, first and last batch, path."""
        return self._last()["runs"]

    def _run(self, rows: DataFrame, level: int, first: int, last: int) -> dict:
        path = f"{self.root}/level={level}/{first}-{last}-{uuid.uuid4().hex}"
        tables.clustered(rows, self.key, self.partitions).write.parquet(path)
        return {"level": level, "first": first, "last": last, "path": path}

    def add(self, rows: DataFrame, batch: int) -> bool:
        """Takes a batch in; False if it was there. Of rows with one key the batch has one."""
        known = self._last()
        if batch <= known["batch"]:
            return False
        runs = [*known["runs"], self._run(rows, 0, batch, batch)]
        while len(runs) > 1 and runs[-1]["level"] == runs[-2]["level"]:
            old, new = (self.spark.read.parquet(r["path"]) for r in runs[-2:])
            merged = new.unionByName(old.join(new.select(*self.key), self.key, "left_anti"), allowMissingColumns=True)
            runs[-2:] = [self._run(merged, runs[-1]["level"] + 1, runs[-2]["first"], runs[-1]["last"])]
        try:
            files.create(self.spark, f"{self.root}/_runs/{batch:020d}.json", {"batch": batch, "runs": runs})
        except FileExistsError:
            return False
        return True

    def read(self) -> DataFrame | None:
        """For each key the row of the latest batch; None before the first batch."""
        found = None
        for place, r in enumerate(self.runs()):
            rows = self.spark.read.parquet(r["path"]).withColumn("__run", F.lit(place))
            found = rows if found is None else found.unionByName(rows, allowMissingColumns=True)
        if found is None:
            return None
        rest = [c for c in found.columns if c not in [*self.key, "__run"]]
        last = found.groupBy(*self.key).agg(F.max_by(F.struct(F.lit(0).alias("__none"), *rest), "__run").alias("__v"))
        return last.select(*self.key, *[F.col("__v")[c].alias(c) for c in rest])

    def vacuum(self) -> int:
        """Deletes runs that were merged; returns how many. No batch may be under way."""
        live, gone = {r["path"].rpartition("/")[2] for r in self.runs()}, 0
        for level in files.listed(self.spark, self.root):
            for run in files.listed(self.spark, level) if "level=" in level else []:
                if run.rpartition("/")[2] not in live:
                    gone += files.delete(self.spark, run)
        return gone
