"""The registered queries of the training-data operators, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import ann, byte_bpe, exact_dedup, filter_audit, jaccard_join, language_id, lattice, licences, packing, quality, span_dedup, vector_codes, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(table(spark, sf_dir, "documents"))


def op2_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 20 == 0)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), byte_bpe.multi_path())


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), packing.tokenizer_path(), 1024, 2)


def op7_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.license_scan(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents")).select("doc_id", "score", "keep")


def op9_span_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_dedup.span_dedup(table(spark, sf_dir, "documents"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


def op11_lattice_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_vectors(table(spark, sf_dir, "embeddings"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_jaccard_join, op2_ann, op3_exact_dedup, op4_language_id, op5_byte_bpe, op6_packing, op7_licences, op8_quality, op9_span_dedup, op10_warc, op11_lattice_dedup, op12_vector_codes, op13_filter_audit)
}

ORACLES: dict[str, str] = {
    "op3_exact_dedup": """
        select doc_id, first_value(doc_id) over w as keep_id,
               count(*) over (partition by coalesce(text, '')) as group_size,
               row_number() over w = 1 as kept, sha256(coalesce(text, '')) as text_sha256
        from documents
        window w as (partition by coalesce(text, '') order by doc_id desc nulls last)
    """,
    "op11_lattice_dedup": """
        with recursive
             v as (select vec_id, embedding::double[] as x from embeddings),
             u as (select * from v where x is not null and len([c for c in x if c is null or not isfinite(c)]) = 0 and len([c for c in x if c <> 0]) > 0),
             e as (select a.vec_id as a, b.vec_id as b from u a join u b on a.vec_id <> b.vec_id and len(a.x) = len(b.x) and list_cosine_similarity(a.x, b.x) >= 0.95),
             r as (select vec_id as a, vec_id as b from v union select r.a, e.b from r join e on e.a = r.b),
             c as (select a as vec_id, min(b) as component_id from r group by a),
             n as (select a as vec_id, count(*) as n_links from e group by a)
        select vec_id, coalesce(n_links, 0)::bigint as n_links, component_id, vec_id = component_id as kept
        from c left join n using (vec_id)
    """,
    "op12_vector_codes": """
        with kept as (
                 select vec_id, label, [floor(256 * c::double)::bigint for c in embedding] as q from embeddings
                 where embedding is not null and len([c for c in embedding if c is null or not isfinite(c)]) = 0),
             p as (
                 select vec_id, label, pos, q[pos * 4 + 1] as x1, q[pos * 4 + 2] as x2, q[pos * 4 + 3] as x3, q[pos * 4 + 4] as x4
                 from kept, (select unnest(range(16)) as pos)),
             seeds as (select vec_id, row_number() over (order by vec_id) - 1 as idx from kept qualify idx < 64),
             b0 as (select pos, idx, x1, x2, x3, x4 from p join seeds using (vec_id)),
    """ + "".join(f"""
             d{r} as (
                 select p.vec_id, p.label, p.pos, p.x1, p.x2, p.x3, p.x4, b.idx,
                        (p.x1 - b.x1) ** 2 + (p.x2 - b.x2) ** 2 + (p.x3 - b.x3) ** 2 + (p.x4 - b.x4) ** 2 as far
                 from p join b{r} b using (pos)),
             a{r} as (select * from d{r} qualify row_number() over (partition by vec_id, pos order by far, idx) = 1),
             b{r + 1} as (
                 select b.pos, b.idx, coalesce(m.m1, b.x1) as x1, coalesce(m.m2, b.x2) as x2, coalesce(m.m3, b.x3) as x3, coalesce(m.m4, b.x4) as x4
                 from b{r} b left join (
                     select pos, idx, floor(sum(x1) / count(*))::bigint as m1, floor(sum(x2) / count(*))::bigint as m2,
                            floor(sum(x3) / count(*))::bigint as m3, floor(sum(x4) / count(*))::bigint as m4
                     from a{r} group by pos, idx) m using (pos, idx)),""" for r in range(2)) + """
             d2 as (
                 select p.vec_id, p.label, p.pos, b.idx,
                        (p.x1 - b.x1) ** 2 + (p.x2 - b.x2) ** 2 + (p.x3 - b.x3) ** 2 + (p.x4 - b.x4) ** 2 as far
                 from p join b2 b using (pos)),
             a2 as (select * from d2 qualify row_number() over (partition by vec_id, pos order by far, idx) = 1),
             coded as (
                 select vec_id, label, string_agg(printf('%02x', idx), '' order by pos) as code, sum(far)::bigint as error
                 from a2 group by vec_id, label),
             told as (select sha256(string_agg(concat_ws(',', x1, x2, x3, x4), ',' order by pos, idx)) as codebooks_sha256 from b2)
        select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, codebooks_sha256
        from coded, told
    """,
    "op13_filter_audit": """
        with recursive
             t as (select doc_id, coalesce(text, '') as text, coalesce(lang, '') as part from documents),
             w as (select *, [w for w in string_split_regex(text, '[\\x20\\x09-\\x0D]+') if w <> ''] as words from t),
             l as (select doc_id, coalesce(bool_or(quality = 1), false) as good, coalesce(bool_or(toxic = 1), false) as toxic from labels group by doc_id),
             f as (
                 select part, coalesce(good, false) as good, coalesce(toxic, false) as toxic,
                        {'A': len(words) < 100, 'B': 100 * len(list_distinct(words)) < 80 * len(words),
                         'C': 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text), 'D': regexp_matches(text, '[#$%&*|]'),
                         'E': coalesce(doc_id > min(doc_id) over (partition by text), false)} as fails
                 from w left join l using (doc_id)),
             m as (
                 select part, good, toxic, concat(case when fails.A then 'A' else '' end, case when fails.B then 'B' else '' end, case when fails.C then 'C' else '' end,
                        case when fails.D then 'D' else '' end, case when fails.E then 'E' else '' end) as failed
                 from f),
             g as (select part, failed, count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic from m group by all),
             o(filter_order) as (
                 select '' union all
                 select filter_order || c from o, (select unnest(['A', 'B', 'C', 'D', 'E']) as c) where not contains(filter_order, c)),
             s as (select filter_order, step::int as step, filter_order[step] as letter from o, (select unnest(range(1, 6)) as step) where length(filter_order) = 5),
             r as (
                 select g.*, o.filter_order, coalesce(list_min([instr(o.filter_order, c) for c in string_split(failed, '') if c <> '']), 99) as gone
                 from g, o where length(o.filter_order) = 5),
             x as (
                 select part, filter_order, step, any_value(letter) as letter, sum(case when gone > step then n else 0 end)::bigint as kept,
                        sum(case when gone = step then n else 0 end)::bigint as removed,
                        sum(case when contains(failed, letter) and gone < step then n else 0 end)::bigint as redundant,
                        sum(case when failed = letter then n else 0 end)::bigint as unique_fails,
                        sum(case when gone = step then good else 0 end)::bigint as good_lost, sum(case when gone = step then toxic else 0 end)::bigint as toxic_lost
                 from r join s using (filter_order) group by part, filter_order, step)
        select * exclude (letter), (sum(removed) over (partition by part, letter))::bigint as shapley from x
    """,
    "op10_warc": """
        with p as (select page_id, coalesce(html, '') as html, strlen(coalesce(html, '')) as n from pages),
             g as (select *, max(page_id) over (partition by html) as top from p)
        select page_id, n as payload_bytes, sha1(html) as payload_digest,
               case when n >= 1000 and page_id <> top then 'revisit' else 'response' end as record_type,
               case when n >= 1000 and page_id <> top then top end as refers_to
        from g
    """,
}
