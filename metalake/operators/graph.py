"""From origins to root directories: visits, heads, aliases, directories, metadata files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metalake.functions.scalars import version_key
from metalake.plans.lineage import written


def full_visit_origins(statuses: DataFrame, origins: DataFrame) -> DataFrame:
    """Distinct urls: origins with a full visit, and new origins."""
    full = statuses.where("status = 'full'").select(F.col("origin").alias("url"))
    return full.unionByName(origins.select("url")).distinct()


def latest_full_visits(statuses: DataFrame) -> DataFrame:
    """(origin, visit, type, snapshot): the last full visit with a snapshot, by date and visit."""
    good = statuses.where("status = 'full' and snapshot is not null")
    last = good.groupBy("origin").agg(F.max_by(F.struct("visit", "type", "snapshot"), F.struct("date", "visit")).alias("v"))
    return last.select("origin", "v.*")


def resolve_aliases(branches: DataFrame, names: list[str]) -> DataFrame:
    """(snapshot, name, target_type, target) of the named branches that reach a revision or a
    release through aliases of their snapshot, however many. Dangling branches, other targets
    and cycles give no row.

    Aliases jump over each other: every round doubles the length of the chains they stand for,
    so as many rounds as the largest number of aliases in a snapshot has binary digits reach
    every end. Each round is one join of the aliases alone, whose result is written.
    """
    aliases = written(branches.where("target_type = 'alias'").select("snapshot", "name", "target"), "aliases")
    longest = aliases.groupBy("snapshot").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    for _ in range(longest.bit_length()):
        further = aliases.select("snapshot", F.col("name").alias("target"), F.col("target").alias("next"))
        jumped = aliases.join(further, ["snapshot", "target"], "left")
        aliases = written(jumped.select("snapshot", "name", F.coalesce("next", "target").alias("target")), "aliases")
    ends = branches.where(F.col("target_type").isin("revision", "release"))
    direct = ends.where(F.col("name").isin(names)).select("snapshot", "name", "target_type", "target")
    last = ends.select("snapshot", F.col("name").alias("end"), "target_type", "target")
    through = aliases.where(F.col("name").isin(names)).select("snapshot", "name", F.col("target").alias("end")).join(last, ["snapshot", "end"])
    return direct.unionByName(through.drop("end"))


def generic_heads(branches: DataFrame) -> DataFrame:
    """(snapshot, target_type, target): HEAD, or master where HEAD leads nowhere."""
    found = resolve_aliases(branches, ["HEAD", "master"])
    return found.groupBy("snapshot").agg(F.min_by(F.struct("target_type", "target"), "name").alias("h")).select("snapshot", "h.*")


def archive_heads(branches: DataFrame) -> DataFrame:
    """(snapshot, name, target_type, target): the branch with the highest version in its name
    (ties by name); rows without a revision or release target take no part."""
    files = branches.where(F.col("target_type").isin("revision", "release"))
    best = files.groupBy("snapshot").agg(F.max_by(F.struct("name", "target_type", "target"), F.struct(version_key(F.col("name")), F.col("name"))).alias("b"))
    return best.select("snapshot", "b.*")


def origin_heads(visits: DataFrame, branches: DataFrame) -> DataFrame:
    """(origin, snapshot, target_type, target), by the visit's type."""
    generic = visits.where("type <> 'ftp'").join(generic_heads(branches), "snapshot")
    archive = visits.where("type = 'ftp'").join(archive_heads(branches), "snapshot")
    columns = ["origin", "snapshot", "target_type", "target"]
    return generic.select(*columns).unionByName(archive.select(*columns))


def head_directories(heads: DataFrame, revisions: DataFrame, releases: DataFrame) -> DataFrame:
    """(origin, directory): a revision's directory, or a release's target if it is one."""
    by_revision = heads.where("target_type = 'revision'").join(revisions.select(F.col("id").alias("target"), "directory"), "target")
    to_directory = releases.where("target_type = 'directory'").select(F.col("id").alias("target"), F.col("target").alias("directory"))
    by_release = heads.where("target_type = 'release'").join(to_directory, "target")
    return by_revision.select("origin", "directory").unionByName(by_release.select("origin", "directory"))


def root_entries(entries: DataFrame, most: int = 100) -> DataFrame:
    """The first ``most`` entries of each directory, with ``truncated``. Positions count from
    1, so the cap is a filter that reaches the scan; the flag is one aggregate per directory."""
    sizes = entries.groupBy("dir_id").agg((F.max("pos") > most).alias("truncated"))
    return entries.where(F.col("pos") <= most).join(sizes, "dir_id")


def descend_single(entries: DataFrame, source: DataFrame | None = None) -> DataFrame:
    """Entries of each directory; where its only entry is a directory, that one's entries (one
    level down) under the original dir_id. They come from ``source``, by default ``entries``."""
    one = entries.groupBy("dir_id").agg(F.count(F.lit(1)).alias("n"), F.any_value(F.struct("type", "target")).alias("only")).where("n = 1 and only.type = 'dir'")
    inner = one.select(F.col("dir_id").alias("outer_id"), F.col("only.target").alias("dir_id"))
    below = inner.join(entries if source is None else source, "dir_id").drop("dir_id").withColumnRenamed("outer_id", "dir_id")
    return entries.join(one.select("dir_id"), "dir_id", "left_anti").unionByName(below.select(*entries.columns))


#: Fixed values: (mapping, rule, value) of intrinsic metadata files; ``exact`` ignores case,
#: ``pattern`` is a regular expression at the start of the name.
FILE_RULES: list[tuple[str, str, str]] = [
    ("cff", "exact", "citation.cff"),
    ("codemeta", "exact", "codemeta.json"),
    ("composer", "exact", "composer.json"),
    ("gemspec", "pattern", r"^.*\.gemspec"),
    ("maven", "exact", "pom.xml"),
    ("npm", "exact", "package.json"),
    ("nuget", "pattern", r"^.*\.nuspec"),
    ("pkg-info", "exact", "pkg-info"),
    ("pubspec", "exact", "pubspec.yaml"),
]


def file_mappings(rules: list[tuple[str, str, str]] = FILE_RULES):
    """Array column: the mappings whose rule a ``name`` meets."""
    name = F.col("name")
    hit = [F.when(F.lower(name) == value if kind == "exact" else name.rlike(value), mapping) for mapping, kind, value in rules]
    return F.array_compact(F.array(*hit))


def searched(entries: DataFrame, rules: list[tuple[str, str, str]], most: int = 100) -> DataFrame:
    """(dir_id, truncated, inner, hits), a row for each directory, in one aggregate. hits: (mapping,
    target) of its first file of each mapping among its first ``most`` entries; inner: the
    directory that is its only entry, or null."""
    name, looked = F.col("name"), (F.col("type") == "file") & (F.col("pos") <= most)
    meets: dict[str, Column] = {}
    for mapping, kind, value in rules:
        hit = F.lower(name) == value if kind == "exact" else name.rlike(value)
        meets[mapping] = meets[mapping] | hit if mapping in meets else hit
    firsts = [F.min_by("target", F.when(looked & hit, F.col("pos"))).alias(f"hit_{k}") for k, hit in enumerate(meets.values())]
    only = F.max(F.when(F.col("type") == "dir", F.col("target"))).alias("only")
    told = entries.groupBy("dir_id").agg((F.max("pos") > most).alias("truncated"), F.count(F.lit(1)).alias("n"), only, *firsts)
    hits = [F.when(F.col(f"hit_{k}").isNotNull(), F.struct(F.lit(m).alias("mapping"), F.col(f"hit_{k}").alias("target"))) for k, m in enumerate(meets)]
    return told.select("dir_id", "truncated", F.when(F.col("n") == 1, F.col("only")).alias("inner"), F.array_compact(F.array(*hits)).alias("hits"))


def detect_files(entries: DataFrame, rules: list[tuple[str, str, str]] = FILE_RULES) -> DataFrame:
    """(dir_id, mapping, target): for each mapping, the first matching file of a directory."""
    hits = entries.where("type = 'file'").select("dir_id", "pos", "target", F.explode(file_mappings(rules)).alias("mapping"))
    return hits.groupBy("dir_id", "mapping").agg(F.min_by("target", "pos").alias("target"))


def entry_contents(detected: DataFrame, contents: DataFrame) -> DataFrame:
    """Detected files whose content is known, with its sha1 (contents: sha1_git, sha1)."""
    return detected.join(contents.select(F.col("sha1_git").alias("target"), "sha1"), "target")


def split_known(detected: DataFrame, translated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(files whose content some tool has translated before, files to translate)."""
    known = translated.select(F.col("id").alias("sha1")).distinct()
    return detected.join(known, "sha1", "left_semi"), detected.join(known, "sha1", "left_anti")
