"""The pipeline: columns, each stage on odd rows, and the whole of it against plain versions."""

import itertools
import math
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
from pyspark.sql import functions as F
from test_jaccard import brute
from test_operators import brute_runs
from test_quality import plain_scores

import corpus_pipeline
from metalake.llm import packing


def test_stages(spark, small, odd, empty):
    docs = small
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns, name
        assert out.count() <= docs.count()
        docs = out
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, "")
    assert packed.select("doc_id").distinct().count() == docs.count()
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, "").count() == 0, name
        assert stage(spark, odd, "").count() >= 1, name


def plainly(docs):
    """{doc_id: text} that is left to pack, stage after stage, without the library's operators."""
    scores = plain_scores(docs)
    close = sorted((abs(x - 0.5), i) for i, x in scores.items())[0]
    assert close[0] > 5e-4, close  # else rounding could decide
    good = {r.doc_id: r.text for r in docs if scores.get(r.doc_id, 0) >= 0.5}
    last = {}
    for i in sorted(good):
        last[good[i]] = i
    one = [SimpleNamespace(doc_id=i, text=good[i]) for i in sorted(last.values())]
    leaders = {i for i, first, _ in brute(one) if i == first}
    return len(good), len(one), {i: text for i, text, _ in brute_runs([(r.doc_id, r.text) for r in one if r.doc_id in leaders])}


def test_the_whole_pipeline_equals_plain_versions(spark, tmp_path):
    """The given documents, with exact copies, near copies and passages put in."""
    from tokenizers import Tokenizer

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lead = " ".join(f"Here stands planted sentence number {k} of the shared passage." for k in ("one", "two", "three", "four"))
    clean = docs.where("doc_id % 40 = 7 and n_chars > 400")
    copies = clean.withColumn("doc_id", F.col("doc_id") + 100_000)
    near = clean.withColumn("doc_id", F.col("doc_id") + 200_000).withColumn("text", F.concat("text", F.lit(" one more")))
    shared = clean.withColumn("doc_id", F.col("doc_id") + 300_000).withColumn("text", F.concat(F.array_join(F.reverse(F.split("text", " ")), " "), F.lit(". " + lead + " The end.")))
    docs.unionByName(copies).unionByName(near).unionByName(shared).write.parquet(f"{tmp_path}/documents.parquet")
    rows = spark.read.parquet(f"{tmp_path}/documents.parquet").select("doc_id", "text").collect()
    n_good, n_distinct, left = plainly(rows)
    assert n_good < len(rows) and n_distinct < n_good and len(left) < n_distinct and sum(lead in t for t in left.values()) == 1
    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    tokenizer.encode_special_tokens = True
    want = Counter()
    for i, text in left.items():
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        for k, (start, length) in enumerate(packing.cut(len(ids), 1024)):
            want[i, k, start, length, zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes())] += 1
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for pieces in sequences.values():
        ends = [0, *itertools.accumulate(n for _, n in sorted(pieces))]
        assert [o for o, _ in sorted(pieces)] == ends[:-1] and ends[-1] <= 1024
    assert len(sequences) <= 1.02 * math.ceil(sum(r.length for r in got) / 1024) + 2
