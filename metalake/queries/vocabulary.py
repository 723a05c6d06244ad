"""Vocabulary sources and the registry's extension points, over files made from the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from metalake.plans.lineage import work_dir
from metalake.registry import REGISTRY, Mapping, Registry, ruled
from metalake.sources import crosswalk
from metalake.sources.bridge import read

from .formats import npm_files, told
from .register import Register

query = Register()


@query("""with w as (select p_partkey, case when p_partkey % 7 = 0 then '' when p_partkey % 11 = 0 then 'creator' else 'term' || p_size end as term,
      ['k' || (p_partkey % 50), 'x' || p_size] as alpha, case when p_partkey % 3 = 0 then []::varchar[] else [p_brand, lower(p_type)] end as beta from part),
    k as (select p_partkey, term, 'Alpha' as ecosystem, unnest(alpha) as key from w union all select p_partkey, term, 'Beta', unnest(beta) from w)
    select ecosystem, key, arg_max(term, p_partkey) as term from k where term not in ('', 'creator') group by all""")
def crosswalk_terms(spark, sf_dir):
    """A wide CSV file with a row for each part: blank and unwanted properties, cells of several keys."""
    path, key = f"{work_dir(spark)}/crosswalk-{uuid.uuid4().hex}", F.col("p_partkey")
    term = F.when(key % 7 == 0, "").when(key % 11 == 0, "creator").otherwise(F.concat(F.lit("term"), F.col("p_size").cast("string")))
    alpha = F.concat(F.lit("k"), (key % 50).cast("string"), F.lit(" / x"), F.col("p_size").cast("string"))
    beta = F.when(key % 3 != 0, F.concat("p_brand", F.lit(", "), F.lower("p_type")))
    wide = read(spark, sf_dir, "part").select("p_partkey", term.alias("Property"), alpha.alias("Alpha"), beta.alias("Beta"))
    wide.coalesce(1).sortWithinPartitions("p_partkey").drop("p_partkey").write.option("header", True).csv(path)
    return crosswalk.crosswalk(spark, path, ["Alpha", "Beta"])


@query("""select n_name as term, case when n_nationkey % 4 = 0 then 'https://plain.org/' || n_nationkey else 'https://' || lower(replace(r_name, ' ', '-')) || '.org/' || n_nationkey end as iri,
    ['@id', null, 'schema:Date', '@list'][n_nationkey % 4 + 1] as coerce from nation join region on n_regionkey = r_regionkey""")
def vocabulary_terms(spark, sf_dir):
    """A JSON-LD context with a prefix for each region and a term for each nation."""
    path = f"{work_dir(spark)}/context-{uuid.uuid4().hex}"
    regions = read(spark, sf_dir, "region").select("r_regionkey", F.replace("r_name", F.lit(" "), F.lit("-")).alias("prefix"))
    prefixes = regions.select(F.concat(F.lit('"'), "prefix", F.lit('":"https://'), F.lower("prefix"), F.lit('.org/"')).alias("entry"))
    key = F.col("n_nationkey").cast("string")
    iri = F.when(F.col("n_nationkey") % 4 == 0, F.concat(F.lit("https://plain.org/"), key)).otherwise(F.concat("prefix", F.lit(":"), key))
    more = F.element_at(F.array(F.lit(',"@type":"@id"'), F.lit(""), F.lit(',"@type":"schema:Date"'), F.lit(',"@container":"@list"')), (F.col("n_nationkey") % 4 + 1).cast("int"))
    nations = read(spark, sf_dir, "nation").join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
    terms = nations.select(F.concat(F.lit('"'), "n_name", F.lit('":{"@id":"'), iri, F.lit('"'), more, F.lit("}")).alias("entry"))
    whole = prefixes.unionByName(terms).groupBy().agg(F.concat(F.lit('{"@context":{'), F.array_join(F.array_sort(F.collect_list("entry")), ","), F.lit("}}")).alias("value"))
    whole.coalesce(1).write.text(path)
    return crosswalk.context_terms(spark, path)


@query("""select p_partkey::varchar as doc_id, x.prop, x.kind, x.value from (select p_partkey, unnest([{'prop': 'type', 'kind': 'type', 'value': 'SoftwareSourceCode'}, {'prop': 'name', 'kind': 'literal', 'value': upper(p_name)},
      {'prop': 'url', 'kind': 'uri', 'value': 'https://h.org/' || p_partkey}, {'prop': 'keywords', 'kind': 'literal', 'value': p_brand}, {'prop': 'keywords', 'kind': 'literal', 'value': p_type}]) as x from part where p_partkey % 50 <> 7)""")
def custom_mapping(spark, sf_dir):
    """A user's mapping by rules and a hook takes the place of the built-in one of its name."""
    rules = spark.createDataFrame([("name", "name", "literal"), ("homepage", "url", "uri"), ("keywords", "keywords", "literal")], "key string, term string, kind string")
    mine = Registry(builtin=dict(REGISTRY.builtin))
    own = ruled("npm", rules, ("exact", "package.json"), hooks={"name": lambda x: F.array(F.upper(F.try_variant_get(x, "$", "string")))})
    mine.add_mapping(Mapping("npm", own.translate, own.rule, terms=own.terms))
    return told(mine.mappings()["npm"].translate(npm_files(spark, sf_dir)))


QUERIES, ORACLES = query.queries, query.oracles
