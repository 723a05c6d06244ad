"""Index tables at rest: files of disjoint id ranges, listed by a manifest for each commit.

A table is a set of Parquet files, sorted by key, whose id ranges don't overlap; ids carry a
Bloom filter in each file. A manifest lists the files with their least and largest id and their
rows. A run finds the ranges that its rows fall into, rewrites those files alone and commits a
manifest with the new ones in their place. One commit, a file created under the next number,
names the manifests and additions logs of all tables of a run. A run that fails before that
leaves tables and log as they were, and of two writers of one number one gets
:class:`CommitConflict`.

Manifests, ids' bounds and commits are about files, not rows: the driver reads those.
"""

from __future__ import annotations

import bisect
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from metalake import schemas
from metalake.functions import scalars as S
from metalake.operators import search, tables
from metalake.plans import files
from metalake.plans.lineage import written


class CommitConflict(RuntimeError):
    """Another run committed in between; nothing of this one is visible."""


@dataclass(frozen=True)
class Part:
    """A file of a table: its path, least and largest id, and rows."""

    path: str
    low: str
    high: str
    rows: int


def named(path: str) -> str:
    """The same path however a file system spells its start (file:/x, file:///x)."""
    scheme, colon, rest = path.partition(":")
    return f"{scheme}:/{rest.lstrip('/')}" if colon and not rest.startswith("//") or rest.startswith("///") else path


class Store:
    def __init__(self, spark: SparkSession, root: str, tools: DataFrame, rows_per_file: int = 1_000_000):
        self.spark, self.root, self.tools, self.rows_per_file = spark, root.rstrip("/"), tools, rows_per_file

    # -- commits ------------------------------------------------------------------------------

    def commits(self) -> list[dict]:
        """Every commit, oldest first: number, and for each table its manifest, log and rows added."""
        return sorted(files.records(self.spark, f"{self.root}/_commits"), key=lambda c: c["number"])

    def _commit(self, number: int, told: dict[str, dict]) -> None:
        try:
            files.create(self.spark, f"{self.root}/_commits/{number:020d}.json", {"number": number, "tables": told})
        except FileExistsError as error:
            raise CommitConflict(f"commit {number} is there already") from error

    def version(self, name: str) -> int:
        """Number of the table's last commit, 0 before the first."""
        return max((c["number"] for c in self.commits() if name in c["tables"]), default=0)

    def parts(self, name: str, commits: list[dict] | None = None) -> list[Part]:
        """The current files of a table, by id."""
        with_it = [c for c in (self.commits() if commits is None else commits) if name in c["tables"]]
        if not with_it:
            return []
        rows = self.spark.read.schema(schemas.MANIFEST).parquet(with_it[-1]["tables"][name]["manifest"]).collect()
        return sorted((Part(r["path"], r["low"], r["high"], r["rows"]) for r in rows), key=lambda p: p.low)

    # -- reads --------------------------------------------------------------------------------

    def read(self, name: str, parts: list[Part]) -> DataFrame:
        schema = schemas.TABLES[name]
        return self.spark.read.schema(schema).parquet(*[p.path for p in parts]) if parts else self.spark.createDataFrame([], schema)

    def table(self, name: str) -> DataFrame:
        """The current rows of an index table."""
        return self.read(name, self.parts(name))

    def between(self, name: str, low: str | None = None, high: str | None = None) -> DataFrame:
        """Rows of low <= id < high, from the files that may hold them."""
        parts = [p for p in self.parts(name) if (low is None or p.high >= low) and (high is None or p.low < high)]
        rows = self.read(name, parts)
        rows = rows if low is None else rows.where(F.col("id") >= low)
        return rows if high is None else rows.where(F.col("id") < high)

    def page(self, name: str, page_token: str = "", limit: int = 100, **filters) -> tuple[DataFrame, str | None]:
        """One page of rows by id after ``page_token``, and the next page's token. Files are opened
        in order, at first as many as hold the page and then twice as many each time, so a page
        whose filters keep most rows opens the same number of files however large the table is."""
        parts = [p for p in self.parts(name) if p.high > page_token]
        rows, held = 0, 1
        while held < len(parts) and (rows := rows + parts[held - 1].rows) <= limit:
            held += 1
        got: list = []
        opened = 0
        while opened < len(parts) and len(got) <= limit:
            block = search.by_producer(self.read(name, parts[opened : opened + held]), **filters)
            got += block.where(F.col("id") > page_token).orderBy("id").limit(limit + 1 - len(got)).collect()
            opened, held = opened + held, held * 2
        page = self.spark.createDataFrame(got[:limit], schemas.TABLES[name])
        return page, got[limit - 1]["id"] if len(got) > limit else None

    def having(self, name: str, ids: DataFrame, most: int = 200_000) -> DataFrame:
        """Rows of the table with one of ``ids`` (id), from the files whose range an id falls into. Up
        to ``most`` different ids are broadcast, so the table's rows stay where they are; of more, a
        join on the id, for which Spark may sketch the ids, deals both sides."""
        wanted, parts = written(ids.select("id").where("id is not null").distinct(), "wanted"), self.parts(name)
        if not parts:
            return self.read(name, [])
        touched = ranges(wanted, [p.low for p in parts]).groupBy("range").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("low"), F.max("id").alias("high")).collect()
        met = [parts[r["range"]] for r in touched if parts[r["range"]].high >= r["low"] and parts[r["range"]].low <= r["high"]]
        few = sum(r["n"] for r in touched) <= most
        return self.read(name, met).join(F.broadcast(wanted) if few else wanted, "id", "left_semi")

    def missing(self, name: str, rows: DataFrame) -> DataFrame:
        """Rows whose key the table doesn't hold; only the table's matching rows are joined with them."""
        key = schemas.KEYS[name]
        return tables.missing(rows, self.having(name, rows).select(*key).distinct(), key)

    def changes(self) -> DataFrame:
        """The additions log: every added row of every commit with its whole tool, metadata as it came."""
        paths = [t["changes"] for c in self.commits() for t in c["tables"].values() if t.get("changes")]
        read = self.spark.read.schema(schemas.CHANGES)
        return read.parquet(*paths) if paths else self.spark.createDataFrame([], schemas.CHANGES)

    # -- writes -------------------------------------------------------------------------------

    def add(self, found: dict[str, DataFrame]) -> DataFrame:
        """Upserts rows into their tables and commits all of them; returns the run's summary.

        Two rows of one batch with the same key raise :class:`metalake.operators.tables.DuplicateId`,
        a null id ValueError, and nothing is committed. NULs leave the metadata; search tokens are
        stored with the row. Counts are observed while the rows are staged.
        """
        commits, told, counts = self.commits(), {}, []
        number = commits[-1]["number"] + 1 if commits else 1
        for name, rows in found.items():
            staged, n, nulls = self._staged(name, rows)
            if nulls:
                raise ValueError(f"{nulls} rows of {name} have no id")
            fresh = tables.checked(staged, schemas.KEYS[name])
            told[name] = {"manifest": self._merged(name, fresh, n, self.parts(name, commits)), "changes": self._logged(name, fresh), "added": n}
            counts.append((name, n, "eventful" if n else "uneventful", None))
        if told:
            self._commit(number, told)
        return self.spark.createDataFrame(counts, schemas.SUMMARY)

    def _staged(self, name: str, rows: DataFrame) -> tuple[DataFrame, int, int]:
        """The batch as a written table, so that its job runs once; its rows and null ids."""
        fields = [x.strip().split(" ", 1) for x in schemas.TABLES[name].split(", ")]
        have = set(rows.columns)
        shaped = rows.select(*[(F.col(c) if c in have else F.lit(None)).cast(kind).alias(c) for c, kind in fields])
        seen, path = Observation(), f"{self.root}/{name}/staged-{uuid.uuid4().hex}"
        shaped.observe(seen, F.count(F.lit(1)).alias("n"), F.count_if(F.col("id").isNull()).alias("nulls")).write.parquet(path)
        return self.spark.read.schema(schemas.TABLES[name]).parquet(path), seen.get["n"], seen.get["nulls"]

    def _logged(self, name: str, fresh: DataFrame) -> str:
        path = f"{self.root}/_changes/{uuid.uuid4().hex}"
        tables.additions_log(fresh.drop("tokens"), self.tools, name).write.parquet(path)
        return path

    def _merged(self, name: str, fresh: DataFrame, n: int, parts: list[Part]) -> str:
        """Path of the manifest in which the files that the fresh rows fall into are replaced."""
        key, keep = schemas.KEYS[name], name == "content_license"
        stored = tables.sanitised(fresh) if "metadata" in fresh.columns else fresh
        if "tokens" in fresh.columns:
            stored = stored.withColumn("tokens", S.json_tokens(F.col("metadata")))
        lows = [p.low for p in parts]
        touched = sorted(r[0] for r in ranges(fresh.select("id"), lows).select("range").distinct().collect())
        old = [parts[i] for i in touched if parts]
        merged = tables.upsert(self.read(name, old), stored, key, keep_existing=keep) if old else stored.dropDuplicates(key)
        kept = [p for i, p in enumerate(parts) if i not in set(touched)]
        return self._manifest(name, kept + self._written(name, merged, lows, n + sum(p.rows for p in old)))

    def _written(self, name: str, rows: DataFrame, lows: list[str], n: int, whole: bool = False) -> list[Part]:
        """New files of about ``rows_per_file`` rows, half as many more at most, none of which spans
        two old ranges; with ``whole`` one file for each range."""
        if not n:
            return []
        key, path = schemas.KEYS[name], f"{self.root}/{name}/{uuid.uuid4().hex}"
        rows = ranges(rows, lows)
        rows = rows.repartitionByRange(len(lows), "range") if whole else rows.repartitionByRange(max(1, round(n / self.rows_per_file)), "range", "id")
        dealt = rows.sortWithinPartitions("range", *key)
        writer = dealt.write.partitionBy("range").option("parquet.bloom.filter.enabled#id", "true")
        writer.option("parquet.bloom.filter.expected.ndv#id", str(min(n, self.rows_per_file))).parquet(path)
        bounds = self.spark.read.parquet(path).groupBy(F.input_file_name().alias("path")).agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count(F.lit(1)).alias("rows"))
        return [Part(r["path"], r["low"], r["high"], r["rows"]) for r in bounds.collect()]

    def _manifest(self, name: str, parts: list[Part]) -> str:
        path = f"{self.root}/{name}/manifest-{uuid.uuid4().hex}"
        rows = self.spark.createDataFrame([(p.path, p.low, p.high, p.rows) for p in parts], schemas.MANIFEST)
        rows.coalesce(1).write.parquet(path)
        return path

    def compact(self, name: str) -> int:
        """Rewrites runs of neighbouring files that together fit in one; returns how many files went."""
        parts = self.parts(name)
        runs, run = [], []
        for p in [*parts, None]:
            if p is None or run and sum(x.rows for x in run) + p.rows > self.rows_per_file:
                runs += [run] if len(run) > 1 else []
                run = []
            run = run + [p] if p else run
        if not runs:
            return 0
        small = [p for r in runs for p in r]
        lows = [r[0].low for r in runs]
        new = self._written(name, self.read(name, small), lows, sum(p.rows for p in small), whole=True)
        gone = {p.path for p in small}
        self._commit(self.commits()[-1]["number"] + 1, {name: {"manifest": self._manifest(name, [p for p in parts if p.path not in gone] + new), "added": 0}})
        return len(small) - len(new)

    def vacuum(self, keep: int = 2) -> int:
        """Deletes files that none of a table's last ``keep`` commits lists, among them what failed
        runs left; returns how many. No other run may be under way. Logs stay."""
        commits, deleted = self.commits(), 0
        for name in {n for c in commits for n in c["tables"]}:
            last = [c for c in commits if name in c["tables"]][-keep:]
            live = {named(c["tables"][name]["manifest"]) for c in last} | {named(p.path) for c in last for p in self.parts(name, [c])}
            for folder in files.listed(self.spark, f"{self.root}/{name}"):
                if named(folder) in live:
                    continue
                inside = files.below(self.spark, folder)
                for f in inside:
                    if named(f) not in live:
                        deleted += files.delete(self.spark, f) and f.endswith(".parquet")
                if not any(named(f) in live for f in inside):
                    files.delete(self.spark, folder)
        return deleted

    def run(self, job: Callable[[], dict[str, DataFrame]]) -> DataFrame:
        """:meth:`add` of what ``job`` finds; a job that fails gives one row with status failed
        and its error, and changes neither table nor log."""
        try:
            return self.add(job())
        except Exception as error:  # noqa: BLE001 - any failure of a user's job is reported, not raised
            return self.spark.createDataFrame([(None, 0, "failed", f"{type(error).__name__}: {error}"[:1000])], schemas.SUMMARY)


def ranges(rows: DataFrame, lows: list[str]) -> DataFrame:
    """``rows`` with ``range``: the last of the sorted ``lows`` that isn't above the id, or 0. Ids
    compare as UTF-8 bytes, as in Spark's order."""
    if len(lows) < 2:
        return rows.withColumn("range", F.lit(0))
    bounds = [low.encode() for low in lows]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = [max(bisect.bisect_right(bounds, i.as_py().encode()) - 1, 0) for i in b["id"]]
            yield pa.record_batch([*b.columns, pa.array(np.array(at, "int32"))], [*b.schema.names, "range"])

    return rows.mapInArrow(run, f"{schema}, range int")
