"""Input tables of the engine, derived from a star schema, an event log and document tables.

Identifiers are hex strings of SHA-1 where the archive has binary ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def blobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sha1, data): the text of every document; equal texts are one blob."""
    data = F.col("text").cast("binary")
    return read(spark, sf_dir, "documents").where("text is not null").select(F.sha1(data).alias("sha1"), data.alias("data")).dropDuplicates(["sha1"])


def origin_url(user: str = "user_id"):
    return F.concat(F.lit("https://host"), (F.col(user) % 7).cast("string"), F.lit(".example.org/u/"), F.col(user).cast("string"))


def origins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select(origin_url().alias("url")).distinct()


def visit_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(origin, visit, date, type, status, snapshot): one per event."""
    kind = F.element_at(F.array(F.lit("git"), F.lit("ftp"), F.lit("pypi")), (F.col("user_id") % 3 + 1).cast("int"))
    status = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "view", "partial").otherwise("full")
    return read(spark, sf_dir, "events").select(
        origin_url().alias("origin"), F.col("event_id").alias("visit"), F.col("ts").alias("date"), kind.alias("type"),
        status.alias("status"), F.col("event_id").alias("snapshot"),
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line per (order, line number): the one of smallest part."""
    return read(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("part"))


NAMES = ["HEAD", "master", "refs/heads/dev", "pkg-1.2.tar.gz", "pkg-1.3.tar.gz", "pkg-1.3-rc1.tar.gz", "pkg_0.9+fix.zip"]


def pick(values: list[str], at):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (at + 1).cast("int"))


def branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(snapshot, name, target_type, target): an order is a snapshot, its lines are branches; and
    every tenth customer's snapshot is a chain of up to 29 aliases from HEAD to a revision."""
    at = F.col("part") % 6
    alias = pick(NAMES, F.col("l_linenumber") % 7)
    short = lines(spark, sf_dir).select(
        F.col("l_orderkey").alias("snapshot"), pick(NAMES, F.col("l_linenumber") - 1).alias("name"),
        F.when(at <= 1, "alias").when(at <= 3, "revision").when(at == 4, "release").when(F.col("part") % 12 == 5, "directory").alias("target_type"),
        F.when(at <= 1, alias).when((at <= 4) | (F.col("part") % 12 == 5), F.col("part").cast("string")).alias("target"),
    )
    length = (F.col("c_custkey") % 30).cast("int")
    hops = read(spark, sf_dir, "customer").where("c_custkey % 10 = 9").select("c_custkey", length.alias("length"), F.explode(F.sequence(F.lit(0), length)).alias("hop"))
    name = lambda hop: F.concat(F.lit("hop"), hop.cast("string"))
    inner = F.col("hop") < F.col("length")
    long = hops.select(
        (-F.col("c_custkey")).alias("snapshot"), F.when(F.col("hop") == 0, "HEAD").otherwise(name(F.col("hop"))).alias("name"),
        F.when(inner, "alias").otherwise("revision").alias("target_type"), F.when(inner, name(F.col("hop") + 1)).otherwise(F.col("c_custkey").cast("string")).alias("target"),
    )
    return short.unionByName(long)


def revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, directory)."""
    return read(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("id"), (F.col("p_partkey") * 3).alias("directory"))


def releases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, target_type, target): every other release targets a directory."""
    return read(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("id"),
        F.when(F.col("p_partkey") % 4 == 0, "directory").otherwise("revision").alias("target_type"),
        (F.col("p_partkey") * 3 + 1).alias("target"),
    )


FILES = ["package.json", "pom.xml", "README.md", "x.gemspec", "PKG-INFO", "CITATION.cff", "CodeMeta.json", "src", "composer.json", "a.nuspec"]


def dir_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(dir_id, pos, name, type, target): an order is a directory, its lines are entries; the
    entry ``src`` is a directory, the one of the part's number."""
    name = pick(FILES, F.col("part") % 10)
    return lines(spark, sf_dir).select(
        F.col("l_orderkey").alias("dir_id"), F.col("l_linenumber").alias("pos"), name.alias("name"),
        F.when(name == "src", "dir").otherwise("file").alias("type"), F.col("part").alias("target"),
    )


def part_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sha1_git, sha1, data): the bytes of the file that a part stands for, by its name in
    ``FILES``. Every twentieth file of a kind is broken; sha1_git is the part's number."""
    name, brand, key = F.col("p_name"), F.col("p_brand"), F.col("p_partkey").cast("string")
    bodies = [
        F.concat(F.lit('{"name":"old","keywords":["'), brand, F.lit('"],"license":"MIT","name":"'), name, F.lit('"}')),
        F.concat(F.lit("<project><name>"), name, F.lit("</name><description>"), brand, F.lit("</description></project>")),
        F.lit("read me"),
        F.concat(F.lit('Gem::Specification.new do |s|\n  s.name = "'), name, F.lit('"\n  s.authors = ["'), brand, F.lit('"]\nend\n')),
        F.concat(F.lit("Name: "), name, F.lit("\nSummary: "), brand, F.lit("\n\n")),
        F.concat(F.lit("title: "), name, F.lit("\nabstract: '"), brand, F.lit("'\n")),
        F.concat(F.lit('{"@context":["http://purl.org/codemeta/2.0","https://schema.org/"],"@type":"SoftwareSourceCode","@id":"https://id.org/'), key, F.lit('","name":"'), name, F.lit('"}')),
        F.lit("a directory"),
        F.concat(F.lit('{"name":"'), name, F.lit('","license":"GPL-3.0"}')),
        F.concat(F.lit("<package><metadata><id>"), name, F.lit("</id></metadata></package>")),
    ]
    whole = F.element_at(F.array(*bodies), (F.col("p_partkey") % 10 + 1).cast("int"))
    data = F.when((F.col("p_partkey") / 10).cast("long") % 20 == 3, F.concat(F.lit("{<"), key)).otherwise(F.concat(whole, F.lit("")))
    rows = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("sha1_git"), data.cast("binary").alias("data"))
    return rows.withColumn("sha1", F.sha1(F.concat(F.col("sha1_git").cast("string").cast("binary"), F.lit("/").cast("binary"), "data")))


def contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sha1_git, sha1) of known contents: every eleventh is unknown."""
    return part_files(spark, sf_dir).where("sha1_git % 11 <> 0").select("sha1_git", "sha1")


def part_blobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return part_files(spark, sf_dir).select("sha1", "data")


def known_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, metadata) of contents that were translated before: every seventh."""
    body = F.concat(F.lit('{"@context":"https://doi.org/10.5063/schema/codemeta-2.0","type":"SoftwareSourceCode","name":"known '), F.col("sha1_git").cast("string"), F.lit('"}'))
    return part_files(spark, sf_dir).where("sha1_git % 7 = 0").select(F.col("sha1").alias("id"), body.alias("metadata"))
