"""Archive graph: visits, heads, directories, detected files, roll-ups."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from metalake.functions import scalars as S
from metalake.operators import graph, props
from metalake.plans import pipelines
from metalake.plans.lineage import work_dir
from metalake.plans.store import Store
from metalake.sources import bridge
from metalake.sources.bridge import read

from .register import Register

query = Register()

SQL_VISITS = """visits as (select 'https://host' || (user_id % 7) || '.example.org/u/' || user_id as origin, event_id as visit, ts as date, ['git','ftp','pypi'][(user_id % 3 + 1)::int] as type,
    case event_type when 'error' then 'failed' when 'view' then 'partial' else 'full' end as status, event_id as snapshot from events)"""
SQL_LINES = "lines as (select l_orderkey, l_linenumber, min(l_partkey) as part from lineitem group by all)"
NAMES = "['HEAD','master','refs/heads/dev','pkg-1.2.tar.gz','pkg-1.3.tar.gz','pkg-1.3-rc1.tar.gz','pkg_0.9+fix.zip']"
SQL_BRANCHES = f"""{SQL_LINES}, branches as (select l_orderkey as snapshot, {NAMES}[l_linenumber] as name,
    case when part % 6 <= 1 then 'alias' when part % 6 <= 3 then 'revision' when part % 6 = 4 then 'release' when part % 12 = 5 then 'directory' end as target_type,
    case when part % 6 <= 1 then {NAMES}[(l_linenumber % 7) + 1] when part % 6 <= 4 or part % 12 = 5 then part::varchar end as target from lines
    union all select -c_custkey, case hop when 0 then 'HEAD' else 'hop' || hop end, case when hop < c_custkey % 30 then 'alias' else 'revision' end,
      case when hop < c_custkey % 30 then 'hop' || (hop + 1) else c_custkey::varchar end from customer cross join range(30) h(hop) where c_custkey % 10 = 9 and hop <= c_custkey % 30)"""
FILES = "['package.json','pom.xml','README.md','x.gemspec','PKG-INFO','CITATION.cff','CodeMeta.json','src','composer.json','a.nuspec']"
SQL_ENTRIES = f"""{SQL_LINES}, entries as (select l_orderkey as dir_id, l_linenumber as pos, {FILES}[(part % 10 + 1)::int] as name,
    case when part % 10 = 7 then 'dir' else 'file' end as type, part as target from lines)"""
SQL_LAST = f"""{SQL_VISITS}, last as (select origin, arg_max(visit, (date, visit)) as visit, arg_max(type, (date, visit)) as type, arg_max(snapshot, (date, visit)) as snapshot
    from visits where status = 'full' group by 1)"""
SQL_RESOLVED = f"""{SQL_BRANCHES}, walk as (select snapshot, name as start, target_type, target, [name] as seen from branches where name in ('HEAD', 'master')
      union all select w.snapshot, w.start, b.target_type, b.target, list_append(w.seen, b.name) from walk w join branches b on b.snapshot = w.snapshot and b.name = w.target where w.target_type = 'alias' and not list_contains(w.seen, w.target)),
    resolved as (select * from walk where target_type in ('revision', 'release')),
    generic as (select snapshot, arg_min(target_type, start) as target_type, arg_min(target, start) as target from resolved group by 1)"""
#: Rank of the archive names that have a version, lowest first.
RANKED = "list_position(['pkg_0.9+fix.zip','pkg-1.2.tar.gz','pkg-1.3-rc1.tar.gz','pkg-1.3.tar.gz'], name)"
SQL_ARCHIVE = f"""archive as (select snapshot, arg_max(name, ({{rank}}, name)) as name, arg_max(target_type, ({{rank}}, name)) as target_type, arg_max(target, ({{rank}}, name)) as target
    from branches where target_type in ('revision', 'release') group by 1)""".format(rank=f"coalesce({RANKED}, 0)")
SQL_HEADS = f"""{SQL_LAST}, {SQL_RESOLVED}, {SQL_ARCHIVE}, heads as (select origin, snapshot, g.target_type, g.target from last join generic g using (snapshot) where type <> 'ftp'
    union all select origin, snapshot, a.target_type, a.target from last join archive a using (snapshot) where type = 'ftp')"""
SQL_DIRS = f"""{SQL_HEADS}, head_dirs as (select origin, p_partkey * 3 as directory from heads join part on p_partkey::varchar = target where target_type = 'revision'
    union all select origin, p_partkey * 3 + 1 from heads join part on p_partkey::varchar = target where target_type = 'release' and p_partkey % 4 = 0)"""
SQL_INNER = """single as (select dir_id, any_value(type) as type, any_value(target) as target from entries group by 1 having count(*) = 1),
    deep as (select e.* from entries e where not exists (select 1 from single s where s.dir_id = e.dir_id and s.type = 'dir')
      union all select s.dir_id, e.pos, e.name, e.type, e.target from single s join entries e on e.dir_id = s.target where s.type = 'dir')"""
MAPPING = """case when lower(name) = 'citation.cff' then 'cff' when lower(name) = 'codemeta.json' then 'codemeta' when lower(name) = 'composer.json' then 'composer'
    when name like '%.gemspec%' then 'gemspec' when lower(name) = 'pom.xml' then 'maven' when lower(name) = 'package.json' then 'npm' when name like '%.nuspec%' then 'nuget'
    when lower(name) = 'pkg-info' then 'pkg-info' end"""
SQL_DETECTED = f"""{SQL_INNER}, detected as (select dir_id, mapping, arg_min(target, pos) as target from (select *, {MAPPING} as mapping from deep where type = 'file') where mapping is not null group by all)"""


def inputs(spark, sf_dir):
    return {f.__name__: f(spark, sf_dir) for f in (bridge.origins, bridge.visit_statuses, bridge.branches, bridge.revisions, bridge.releases, bridge.dir_entries)}


@query(f"with {SQL_VISITS} select origin as url from visits where status = 'full' union select origin from visits where visit % 50 = 0")
def full_visit_origins(spark, sf_dir):
    new = bridge.visit_statuses(spark, sf_dir).where("visit % 50 = 0").select(F.col("origin").alias("url"))
    return graph.full_visit_origins(bridge.visit_statuses(spark, sf_dir), new)


@query(f"with {SQL_LAST} select * from last")
def latest_full_visits(spark, sf_dir):
    return graph.latest_full_visits(bridge.visit_statuses(spark, sf_dir))


@query(f"with recursive {SQL_RESOLVED} select snapshot, start as name, target_type, target from resolved")
def resolve_aliases(spark, sf_dir):
    return graph.resolve_aliases(bridge.branches(spark, sf_dir), ["HEAD", "master"])


@query(f"with recursive {SQL_RESOLVED} select * from generic")
def generic_heads(spark, sf_dir):
    return graph.generic_heads(bridge.branches(spark, sf_dir))


@query(f"with {SQL_BRANCHES}, {SQL_ARCHIVE} select * from archive")
def archive_heads(spark, sf_dir):
    return graph.archive_heads(bridge.branches(spark, sf_dir))


@query(r"""with n as (select o_orderkey, case when o_orderkey % 7 = 0 then 'lib-20240101123456' || (o_custkey % 9) || '.tar.gz'
      else 'lib-' || (o_orderkey % 9) || '.' || (o_custkey % 9) || ['', '-rc1', '+fix'][o_orderkey % 3 + 1] || '.tar.gz' end as name, o_custkey from orders)
    select o_orderkey, name, true as matched, case when o_orderkey % 7 = 0 then ['20240101123456' || (o_custkey % 9), '0'] else [(o_orderkey % 9)::varchar, (o_custkey % 9)::varchar, ['0', '-1', '1'][o_orderkey % 3 + 1]] end as numbers,
      case when o_orderkey % 7 = 0 then '' else ['', 'rc1', 'fix'][o_orderkey % 3 + 1] end as suffix from n""")
def version_keys(spark, sf_dir):
    minor = (F.col("o_custkey") % 9).cast("string")
    short = F.concat(F.lit("lib-"), (F.col("o_orderkey") % 9).cast("string"), F.lit("."), minor, bridge.pick(["", "-rc1", "+fix"], F.col("o_orderkey") % 3), F.lit(".tar.gz"))
    name = F.when(F.col("o_orderkey") % 7 == 0, F.concat(F.lit("lib-20240101123456"), minor, F.lit(".tar.gz"))).otherwise(short)
    keys = read(spark, sf_dir, "orders").select("o_orderkey", name.alias("name"), S.version_key(name).alias("k")).select("o_orderkey", "name", "k.*")
    return keys.withColumn("numbers", F.transform("numbers", lambda x: x.cast("string")))


@query(f"with recursive {SQL_HEADS} select * from heads")
def origin_heads(spark, sf_dir):
    return graph.origin_heads(graph.latest_full_visits(bridge.visit_statuses(spark, sf_dir)), bridge.branches(spark, sf_dir))


@query(f"with recursive {SQL_DIRS} select * from head_dirs")
def head_directories(spark, sf_dir):
    i = inputs(spark, sf_dir)
    heads = graph.origin_heads(graph.latest_full_visits(i["visit_statuses"]), i["branches"])
    return graph.head_directories(heads, i["revisions"], i["releases"])


@query(f"with {SQL_ENTRIES} select *, max(pos) over (partition by dir_id) > 4 as truncated from entries qualify pos <= 4")
def root_entries(spark, sf_dir):
    return graph.root_entries(bridge.dir_entries(spark, sf_dir), 4)


@query(f"with {SQL_ENTRIES}, {SQL_INNER} select * from deep")
def descend_single(spark, sf_dir):
    return graph.descend_single(bridge.dir_entries(spark, sf_dir))


@query(f"with {SQL_ENTRIES}, {SQL_DETECTED} select * from detected")
def detect_files(spark, sf_dir):
    return graph.detect_files(graph.descend_single(bridge.dir_entries(spark, sf_dir)))


@query(f"with {SQL_ENTRIES}, {SQL_DETECTED} select dir_id, mapping, target, sha1('f' || target) as sha1 from detected join part on p_partkey = target where p_partkey % 3 <> 0")
def entry_contents(spark, sf_dir):
    known = read(spark, sf_dir, "part").where("p_partkey % 3 <> 0").select(F.col("p_partkey").alias("sha1_git"), F.sha1(F.concat(F.lit("f"), F.col("p_partkey").cast("string")).cast("binary")).alias("sha1"))
    return graph.entry_contents(graph.detect_files(graph.descend_single(bridge.dir_entries(spark, sf_dir))), known)


@query(f"with {SQL_ENTRIES}, {SQL_DETECTED} select mapping, target % 4 = 0 as reused, count(*) as n from detected group by all")
def reuse_contents(spark, sf_dir):
    found = graph.detect_files(graph.descend_single(bridge.dir_entries(spark, sf_dir))).withColumn("sha1", F.col("target"))
    known, rest = graph.split_known(found, read(spark, sf_dir, "part").where("p_partkey % 4 = 0").select(F.col("p_partkey").alias("id")))
    both = known.withColumn("reused", F.lit(True)).unionByName(rest.withColumn("reused", F.lit(False)))
    return both.groupBy("mapping", "reused").agg(F.count(F.lit(1)).alias("n"))


#: What the file of a part says; the file's kind is part % 10, and every twentieth is broken.
SQL_FILES = """said as (select p_partkey as part, p_partkey % 7 = 0 as known, (p_partkey // 10) % 20 = 3 and p_partkey % 7 <> 0 as broken, p_partkey % 10 as kind, p_brand as brand,
      case when p_partkey % 7 = 0 then 'known ' || p_partkey else p_name end as name from part where p_partkey % 11 <> 0)"""
SQL_ROLLED = f"""{SQL_DETECTED}, {SQL_FILES}, met as (select dir_id, mapping, s.* from detected join said s on s.part = target),
    rolled as (select dir_id, list_sort(list_distinct(list(mapping))) as mappings, count(*) filter (not broken or kind = 4) as n,
      list(distinct name order by name) filter (not broken) as names,
      list(distinct brand order by brand) filter (not broken and not known and kind in (1, 4, 5)) as told, any_value(brand) filter (not broken and not known and kind = 3) as author,
      any_value(brand) filter (not broken and not known and kind = 0) as keyword, any_value('https://id.org/' || part) filter (not broken and not known and kind = 6) as id,
      list(distinct case kind when 0 then 'MIT' else 'GPL-3.0' end) filter (not broken and not known and kind in (0, 8)) as licenses from met group by 1)"""
ITEMS = """case when len({0}) = 1 then '"{1}' || {0}[1] || '"' else '["{1}' || array_to_string(list_sort({0}), '","{1}') || '"]' end"""
DOC = f"""case when coalesce(n, 0) = 0 then '{{"@context":"https://doi.org/10.5063/schema/codemeta-2.0"}}' else '{{"@context":"https://doi.org/10.5063/schema/codemeta-2.0","type":"SoftwareSourceCode"' ||
    array_to_string(list_transform(list_filter([
      '"author":[{{"name":"' || author || '","type":"Person"}}]', '"description":' || {ITEMS.format('told', '')}, '"id":"' || id || '"', '"keywords":"' || keyword || '"',
      '"license":' || {ITEMS.format('licenses', 'https://spdx.org/licenses/')}, '"name":' || {ITEMS.format('names', '')}], lambda x: x is not null), lambda x: ',' || x), '') || '}}' end"""


def files_of(spark, sf_dir) -> dict:
    return {
        "dir_entries": bridge.dir_entries(spark, sf_dir), "contents": bridge.contents(spark, sf_dir),
        "blobs": bridge.part_blobs(spark, sf_dir), "known": bridge.known_metadata(spark, sf_dir),
    }


@query(f"""with {SQL_ENTRIES}, {SQL_ROLLED} select e.dir_id as id, {DOC} as metadata, coalesce(mappings, []) as mappings, false as truncated
    from (select distinct dir_id from entries) e left join rolled using (dir_id)""")
def directory_metadata(spark, sf_dir):
    """Every directory, from its files' bytes to its merged document."""
    wanted = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("dir_id")).distinct()
    return pipelines.directory_metadata(wanted, **files_of(spark, sf_dir)).directories


@query(f"""with recursive {SQL_DIRS}, {SQL_ENTRIES.replace(SQL_LINES + ', ', '')}, {SQL_ROLLED}
    select origin as id, {DOC} as metadata, dir_id as from_directory, mappings from rolled join head_dirs on directory = dir_id where n > 0""")
def origin_intrinsic_metadata(spark, sf_dir):
    """Every origin, from its visits to the merged document of its head's files."""
    i = inputs(spark, sf_dir)
    return pipelines.origin_intrinsic_metadata(**i, **{k: v for k, v in files_of(spark, sf_dir).items() if k != "dir_entries"}).origins


@query(f"""with recursive {SQL_DIRS}, {SQL_ENTRIES.replace(SQL_LINES + ', ', '')}, {SQL_ROLLED},
    found as (select origin, {DOC} as metadata, dir_id::varchar as dir_id, mappings from rolled join head_dirs on directory = dir_id where n > 0)
    select 'origin_intrinsic' as name, origin as id, metadata, mappings, 2 as tool_id from found union all
    select distinct 'directory_metadata', dir_id, metadata, mappings, 1 from found""")
def stored_origin_metadata(spark, sf_dir):
    """The flagship job twice into the index tables, read back: the second run replaces every row."""
    i = inputs(spark, sf_dir)
    found = pipelines.origin_intrinsic_metadata(**i, **{k: v for k, v in files_of(spark, sf_dir).items() if k != "dir_entries"})
    tools = spark.createDataFrame([(1, "translator", "1", "{}"), (2, "roll-up", "1", "{}")], "id long, tool_name string, tool_version string, tool_configuration string")
    store = Store(spark, f"{work_dir(spark)}/store-{uuid.uuid4().hex}", tools, 2000)
    rows = {"directory_metadata": found.directories.withColumn("tool_id", F.lit(1)), "origin_intrinsic": found.origins.withColumn("tool_id", F.lit(2))}
    for _ in range(2):
        store.add(rows)
    told = [store.table(name).select(F.lit(name).alias("name"), "id", "metadata", "mappings", "tool_id") for name in rows]
    return told[0].unionByName(told[1])


@query("""with g as (select l_orderkey, l_linenumber, l_partkey, 'https://x/' || l_suppkey as url, l_suppkey, p_brand from lineitem join part on p_partkey = l_partkey),
    i as (select l_orderkey, arg_min(url, (l_linenumber, l_partkey, l_suppkey)) as id, list_sort(list_distinct(list(url))) as urls, list_sort(list_distinct(list(p_brand))) as brands from g group by 1)
    select l_orderkey::varchar as doc_id, id, list_filter(urls, lambda u: u <> id) as same_as, brands from i""")
def merge_documents(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").join(read(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    doc = F.concat_ws("/", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    rank = F.struct("l_linenumber", "l_partkey", "l_suppkey")
    values = F.array(F.struct(F.lit("id").alias("prop"), F.lit("uri").alias("kind"), F.concat(F.lit("https://x/"), F.col("l_suppkey").cast("string")).alias("value")),
                     F.struct(F.lit("brand").alias("prop"), F.lit("literal").alias("kind"), F.col("p_brand").alias("value")))
    table = rows.select(doc.alias("doc_id"), F.explode(values).alias("v")).select("doc_id", "v.prop", "v.kind", F.lit(0).alias("pos"), "v.value")
    groups = rows.select(F.col("l_orderkey").cast("string").alias("group"), rank.alias("rank"), doc.alias("doc_id")).distinct()
    merged = props.merge(table, groups)
    pick = lambda p: F.array_sort(F.collect_set(F.when(F.col("prop") == p, F.col("value"))))
    return merged.groupBy("doc_id").agg(F.max(F.when(F.col("prop") == "id", F.col("value"))).alias("id"), pick("sameAs").alias("same_as"), pick("brand").alias("brands"))


QUERIES, ORACLES = query.queries, query.oracles
