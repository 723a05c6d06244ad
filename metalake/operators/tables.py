"""Keyed index tables: register tools, upsert, find what is missing, look up, log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metalake.functions.scalars import canonical_json, without_nul


class DuplicateId(ValueError):
    """Two rows of one batch share a logical key."""


def duplicate_keys(rows: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows ``n``."""
    return rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def checked(rows: DataFrame, key: list[str]) -> DataFrame:
    """``rows``, or :class:`DuplicateId` when two share a key."""
    if bad := duplicate_keys(rows, key).take(1):
        raise DuplicateId(f"key {bad[0].asDict()}")
    return rows


def matches(left: DataFrame, right: DataFrame, key: list[str]) -> Column:
    on = F.lit(True)
    for k in key:
        on = on & left[k].eqNullSafe(right[k])
    return on


def upsert(table: DataFrame, rows: DataFrame, key: list[str], keep_existing: bool = False) -> DataFrame:
    """The table's next version: new rows replace old ones with their key. With
    ``keep_existing`` old rows win instead (license rows: a conflict changes nothing).

    Two new rows with one key raise :class:`DuplicateId`, or, with ``keep_existing``, count
    once. Write the result to a new location: a plan must not overwrite what it reads.
    """
    rows = rows.select(*table.columns).dropDuplicates(key) if keep_existing else checked(rows.select(*table.columns), key)
    if keep_existing:
        return table.unionByName(rows.join(table.select(*key), key, "left_anti").select(*table.columns))
    return rows.unionByName(table.join(rows.select(*key), key, "left_anti").select(*table.columns))


def clustered(rows: DataFrame, key: list[str], partitions: int) -> DataFrame:
    """Rows in key ranges, sorted within each: files whose key bounds let lookups skip them."""
    return rows.repartitionByRange(partitions, *key).sortWithinPartitions(*key)


def ranges(rows: DataFrame, per_range: int, least: int = 16) -> int:
    """How many key ranges ``rows`` are written in, so that what a task sorts doesn't grow with the table."""
    return max(least, -(-rows.count() // per_range))


def missing(wanted: DataFrame, table: DataFrame, key: list[str]) -> DataFrame:
    """Rows of ``wanted`` whose key the table doesn't hold."""
    return wanted.join(table.select(*key), key, "left_anti")


def attach_tool(rows: DataFrame, tools: DataFrame) -> DataFrame:
    """Nested ``tool`` (id, name, version, configuration) instead of ``tool_id``."""
    tool = F.struct(
        F.col("tool_id").alias("id"), F.col("tool_name").alias("name"),
        F.col("tool_version").alias("version"), F.col("tool_configuration").alias("configuration"),
    )
    named = tools.withColumnRenamed("id", "tool_id")
    return rows.join(named, "tool_id").withColumn("tool", tool).drop("tool_id", "tool_name", "tool_version", "tool_configuration")


def get(ids: DataFrame, table: DataFrame, tools: DataFrame, key: str = "id") -> DataFrame:
    """All rows of the wanted ids, with their tool; unknown ids give no rows."""
    return attach_tool(table.join(ids.select(key).distinct(), key, "left_semi"), tools)


def normal_tools(tools: DataFrame) -> DataFrame:
    """Distinct (name, version, configuration) with configurations in canonical form."""
    return tools.select("tool_name", "tool_version", canonical_json(F.col("tool_configuration")).alias("tool_configuration")).distinct()


NATURAL = ["tool_name", "tool_version", "tool_configuration"]


def register_tools(known: DataFrame, tools: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(all tools, ids of the given ones). Known tools keep their ids; new ones are numbered
    after the largest id, in the order of their natural key. There are few tools, so one
    partition may number them."""
    wanted = normal_tools(tools)
    fresh = wanted.join(known, NATURAL, "left_anti")
    last = known.agg(F.coalesce(F.max("id"), F.lit(0)).alias("last"))
    order = Window.orderBy(*NATURAL)
    numbered = fresh.withColumn("at", F.row_number().over(order)).crossJoin(last).select((F.col("last") + F.col("at")).cast("long").alias("id"), *NATURAL)
    everything = known.select("id", *NATURAL).unionByName(numbered)
    return everything, everything.join(wanted, NATURAL, "left_semi")


def find_tool(tools: DataFrame, name: str, version: str, configuration: str) -> DataFrame:
    """At most one row: the tool with this natural key."""
    same = F.col("tool_configuration") == canonical_json(F.lit(configuration))
    return tools.where((F.col("tool_name") == name) & (F.col("tool_version") == version) & same)


def sanitised(rows: DataFrame, column: str = "metadata") -> DataFrame:
    return rows.withColumn(column, without_nul(F.col(column)))


def additions_log(rows: DataFrame, tools: DataFrame, object_type: str) -> DataFrame:
    """What an add emits: the row as JSON with its whole tool and no tool id."""
    whole = attach_tool(rows, tools)
    tool = F.struct(F.col("tool.name").alias("name"), F.col("tool.version").alias("version"), F.col("tool.configuration").alias("configuration"))
    fields = [F.col(c) for c in whole.columns if c != "tool"]
    return whole.select(F.lit(object_type).alias("object_type"), F.to_json(F.struct(*fields, tool.alias("tool"))).alias("message"))


def run_summary(added: DataFrame, group: str) -> DataFrame:
    """Per table: rows added, and whether the run was eventful."""
    counts = added.groupBy(group).agg(F.sum("n").alias("added"))
    return counts.withColumn("status", F.when(F.col("added") > 0, "eventful").otherwise("uneventful"))


def operation_counts(log: DataFrame) -> DataFrame:
    """Operations by object type and operation."""
    return log.groupBy("object_type", "operation").agg(F.sum("n").alias("n"))


def first_wins(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The row of smallest ``order`` for every key."""
    best = rows.groupBy(key).agg(F.min_by(F.struct(*rows.columns), order).alias("row"))
    return best.select("row.*")


def last_wins(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The row of largest ``order`` for every key."""
    best = rows.groupBy(key).agg(F.max_by(F.struct(*rows.columns), order).alias("row"))
    return best.select("row.*")
