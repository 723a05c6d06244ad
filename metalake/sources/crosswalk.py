"""Vocabulary sources: the crosswalk table of ecosystems and the terms of a JSON-LD context."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Properties that the crosswalk's users must not map.
BLACKLIST = ["softwareRequirements", "softwareSuggestions", "creator"]


def crosswalk(spark: SparkSession, path: str, ecosystems: list[str], property_column: str = "Property") -> DataFrame:
    """(ecosystem, key, term) of a wide CSV file. A cell may hold several keys, split at commas
    and slashes; blank and blacklisted properties go; the last row of a key wins."""
    wide = spark.read.csv(path, header=True, multiLine=True, escape='"').withColumn("__line", F.monotonically_increasing_id())
    term = F.trim(property_column)
    long = wide.where(F.coalesce(term, F.lit("")) != "").where(~term.isin(BLACKLIST)).select(
        term.alias("term"), "__line", F.explode(F.array(*[F.struct(F.lit(e).alias("ecosystem"), F.col(f"`{e}`").alias("cell")) for e in ecosystems])).alias("x")
    )
    keys = long.select("term", "__line", "x.ecosystem", F.explode(F.split("x.cell", r"\s*[,/]\s*")).alias("key")).where("trim(key) <> ''")
    return keys.groupBy("ecosystem", F.trim("key").alias("key")).agg(F.max_by("term", "__line").alias("term"))


def context_terms(spark: SparkSession, path: str) -> DataFrame:
    """(term, iri, coerce): coerce is @id, a type, @list or null; prefixes are resolved."""
    text = spark.read.text(path, wholetext=True).select(F.parse_json("value").alias("v"))
    entries = text.select(F.explode(F.expr("variant_get(v, '$[\"@context\"]', 'map<string, variant>')")).alias("term", "x"))
    plain = entries.where("schema_of_variant(x) = 'STRING' and not startswith(term, '@')").select(F.col("term").alias("prefix"), F.expr("variant_get(x, '$', 'string')").alias("base"))
    at = lambda key: F.expr(f"try_variant_get(x, '$[\"{key}\"]', 'string')")
    terms = entries.where("schema_of_variant(x) like 'OBJECT%'").select("term", at("@id").alias("id"), F.coalesce(at("@type"), at("@container")).alias("coerce"))
    named = terms.withColumn("prefix", F.substring_index("id", ":", 1)).join(F.broadcast(plain), "prefix", "left")
    iri = F.when(F.col("base").isNotNull(), F.concat("base", F.regexp_replace("id", "^[^:]*:", ""))).otherwise(F.col("id"))
    return named.select("term", iri.alias("iri"), "coerce")
