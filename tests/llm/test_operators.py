"""The other training-data operators against brute force, exact round trips and held-out rows."""

import base64
import gzip
import hashlib
import itertools
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import public_tokenizers
from pyspark.sql import functions as F

from metalake.llm import ann, byte_bpe, exact_dedup, language_id, licences, packing, quality, sentences, span_dedup, warc


def by_id(df, key="doc_id"):
    out = defaultdict(list)
    for r in df.collect():
        out[r[key]].append(r)
    return out


def test_exact_dedup(small, odd, empty):
    for df in (small, odd, empty):
        rows = df.collect()
        groups = defaultdict(list)
        for r in rows:
            groups[r.text or ""].append(r.doc_id)
        got = exact_dedup.exact_dedup(df).collect()
        assert len(got) == len(rows)
        assert Counter((r.doc_id, r.text_sha256) for r in got) == Counter((r.doc_id, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in rows)
        assert sum(r.kept for r in got) == len(groups)
        by_sha = {hashlib.sha256(t.encode()).hexdigest(): (max((i for i in ids if i is not None), default=None), len(ids)) for t, ids in groups.items()}
        assert all((r.keep_id, r.group_size) == by_sha[r.text_sha256] and (not r.kept or r.doc_id == r.keep_id) for r in got)
        kept = exact_dedup.drop_exact_copies(df)
        assert kept.columns == df.columns and kept.count() == len(groups)


def test_merge_of_pairs_is_the_library_s():
    import tiktoken

    ranks = byte_bpe.load_ranks(byte_bpe.multi_path())
    theirs = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    words, pieces = byte_bpe.codec(byte_bpe.multi_path())
    rng = random.Random(3)
    alphabet = "abeinrst ehu'1.\n\t éñß中\U0001f600"
    for _ in range(800):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))
        ids = byte_bpe.encode_text(text, words)
        assert ids == ",".join(map(str, theirs.encode_ordinary(text)))
        assert byte_bpe.decode_text(ids, pieces).decode() == text
    long = "supercalifragilistic" * 500
    assert byte_bpe.encode_text(long, words) == ",".join(map(str, theirs.encode_ordinary(long)))


def test_byte_bpe_query(small, odd, empty):
    for df in (small, odd, empty):
        texts = sorted(((r.doc_id, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in df.collect()), key=str)
        got = byte_bpe.round_trip(df, byte_bpe.multi_path()).collect()
        assert sorted(((r.doc_id, r.decoded_sha256) for r in got), key=str) == texts
    ids = byte_bpe.encode(odd, byte_bpe.multi_path())
    back = byte_bpe.decode(ids, byte_bpe.multi_path()).collect()
    assert Counter(bytes(r.data) for r in back) == Counter((r.text or "").encode() for r in odd.collect())


def test_packing(small, odd, empty):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    tokenizer.encode_special_tokens = True
    for df in (small, odd, empty):
        rows = df.collect()
        ids = [[*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 2] for r in rows]
        got = packing.pack(df, packing.tokenizer_path(), 1024, 2).collect()
        want = Counter()
        for r, x in zip(rows, ids):
            for k, (start, length) in enumerate(packing.cut(len(x), 1024)):
                want[r.doc_id, k, start, length, zlib.crc32(np.array(x[start : start + length], "<u4").tobytes())] += 1
        assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
        sequences = defaultdict(list)
        for r in got:
            sequences[r.sequence_id].append((r.offset, r.length))
        for pieces in sequences.values():
            ends = [0, *itertools.accumulate(n for _, n in sorted(pieces))]
            assert [o for o, _ in sorted(pieces)] == ends[:-1] and ends[-1] <= 1024
        assert len(sequences) <= 1.02 * math.ceil(sum(map(len, ids)) / 1024) + 2


@pytest.mark.parametrize("seed", range(20))
def test_packing_plan_places_everything(seed):
    rng = random.Random(seed)
    counts = Counter(rng.choices(range(1, [1025, 400, 600][seed % 3]), k=rng.randint(1, 2000)))
    plan = packing.plan(dict(counts), 1024)
    placed = Counter()
    for n, holds in plan:
        assert n > 0 and sum(a * b for a, b in holds.items()) <= 1024
        assert sum(b for a, b in holds.items() if 3 * a > 1024) <= 2
        for a, b in holds.items():
            placed[a] += n * b
    assert placed == counts


def test_licences(spark, odd, empty):
    texts = ["Licensed under the MIT License.", "under the Apache\nLicense, Version 2.0. mit LICENSE", "GNU General Public License, version 3", "general public licensed", "", None, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {k: v[0] for k, v in by_id(licences.license_scan(df)).items()}
    for i, t in enumerate(texts):
        words = licences.words_of(t or "")
        starts = [(k, label) for phrase, label in licences.BASE for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.encode().split()]
        r = got[i]
        assert (r.n_words, r.n_base, r.base_labels) == (len(words), len(starts), ",".join(sorted({x for _, x in starts})))
        assert (r.first_word, r.last_word) == ((min(starts)[0], max(starts)[0]) if starts else (None, None))
        assert 0 <= r.score <= 1 and set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""}
    assert got[6].labels == "mit" and got[1].labels == "apache,mit"
    assert licences.license_scan(odd).count() == odd.count() and licences.license_scan(empty).count() == 0


def test_licence_labels_match_a_scan_of_every_window(spark):
    """The rare-word lookup finds what a comparison of every notice at every place finds."""
    rng = random.Random(8)
    notices = [(label, key.split(), notice.split()) for label, key, notice in licences.TEMPLATES]
    texts = []
    for k in range(150):
        words = [rng.choice(["the", "of", "a", "software", "license", "terms", f"own{rng.randint(0, 99)}"]) for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            notice = list(rng.choice(notices)[2])
            if rng.random() < 0.3:
                notice[rng.randrange(len(notice))] = "changed"
            at = rng.randint(0, len(words))
            words[at:at] = notice
        texts.append((k, " ".join(words)))
    got = {r.doc_id: r for r in licences.license_scan(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    exact = rows = 0
    for k, text in texts:
        words, full, close = text.split(), set(), set()
        for label, key, notice in notices:
            for s in range(-2, len(words)):
                window = words[max(0, s - 2) : max(0, s + len(notice) + 2)]
                if not any(window[i : i + len(key)] == key for i in range(len(window))):
                    continue
                hits = sum(any(0 <= s + q + d < len(words) and words[s + q + d] == w for d in (-1, 0, 1)) for q, w in enumerate(notice))
                if words[max(s, 0) : max(s, 0) + len(notice)] == notice:
                    full.add(label)
                if hits >= 0.6 * len(notice):
                    close.add(label)
        told = set(filter(None, got[k].labels.split(",")))
        base = set(filter(None, got[k].base_labels.split(",")))
        assert full <= told <= close | base, (text, full, told, close)
        rows, exact = rows + 1, exact + (told == close | base)
    assert exact >= 0.9 * rows


def test_language_id(spark, odd, empty):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language_id.identify(df).join(df.select("doc_id", "lang"), "doc_id").collect()
    test = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert sum(r.lang == r.lang_pred for r in test) >= 0.98 * len(test)
    assert all(0 <= r.score <= 1 for r in got)
    told = language_id.identify(odd).collect()
    assert len(told) == odd.count()
    assert {r.lang_pred for r in told if r.doc_id in (1, 2, 7)} == {"und"}
    assert language_id.identify(empty).count() == 0
    letterless = spark.createDataFrame([(k, t, "en", "x", 1) for k, t in enumerate(["\u00bd", "\u00b2 \u00b3", "\u2163", "7_7", "\u4e2d", "a1"])], "doc_id long, text string, lang string, lang_pred string, score int")
    told = {r.doc_id: r.lang_pred for r in language_id.identify(letterless.unionByName(letterless.withColumn("doc_id", F.col("doc_id") + 100))).collect()}
    assert [told[k] == "und" for k in range(6)] == [True, True, True, True, False, False]


def test_kernel_matches_its_definition():
    rng = random.Random(2)
    texts = ["the cat sat", "le chat", "die katze saß", "\u4e2d\u6587 TEXT \U0001f600", "", "a", " ".join(f"w{rng.getrandbits(60)}" for _ in range(3000))]
    sets = []
    for t in texts:
        data = t.lower().encode()
        sets.append({data[i : i + n] for n in (1, 2, 3, 4) for i in range(len(data) - n + 1)})
    kernel = language_id.Kernel([language_id.grams(t) for t in texts[:4]])
    got = kernel.values(texts)
    for i, j in itertools.product(range(len(texts)), range(4)):
        want = len(sets[i] & sets[j]) / math.sqrt(max(1, len(sets[i])) * len(sets[j]))
        assert abs(got[i, j] - want) < 1e-6


def test_quality(spark, odd, empty):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = quality.classify(df).join(labels, "doc_id").collect()
    good, bad = [r for r in got if r.quality == 1], [r for r in got if r.quality == 0]
    assert sum(r.keep for r in good) >= 0.98 * len(good)
    assert sum(not r.keep for r in bad) >= 0.9 * len(bad)
    told = quality.classify(odd).collect()
    assert len(told) == odd.count() and all(r.score == 0 for r in told if not (r.text or "").strip())
    assert quality.classify(empty).count() == 0


def test_em_finds_accuracies():
    rng = np.random.default_rng(5)
    patterns = rng.choice([-1, 0, 1], (4000, len(quality.LABELLERS)), p=[0.02, 0.3, 0.68])
    patterns[:, quality.DETECTORS] = np.where(rng.random((4000, len(quality.DETECTORS))) < 0.002, -1, 0)
    patterns[:400, quality.DETECTORS[0]] = -1
    p = quality.posterior(patterns, *quality.em(patterns, np.ones(4000)))
    assert p[:400].max() < 0.5 and (p[400:] > 0.5).mean() > 0.95


def sentences_plainly(text):
    """Pieces of a text, read character by character: sentences up to their stops or line ends,
    clauses of those over 32 words."""
    short = {"Mr", "Dr", "e.g", "z.B"}
    pieces, piece, k = [], "", 0
    while k < len(text):
        piece += text[k]
        c, k = text[k], k + 1
        if c in ".!?\u0964":
            while k < len(text) and text[k] in ".!?\u0964":
                piece, k = piece + text[k], k + 1
            while k < len(text) and text[k] in "\"')]":
                piece, k = piece + text[k], k + 1
            last = piece.split()[-1].lstrip("(\"'") if piece.split() else ""
            spared = c == "." and last.endswith(".") and (last[:-1] in short or (len(last) == 2 and last[0].isupper()) or (last[:-1].isdigit() and len(last) <= 3))
            at = k
            while at < len(text) and text[at].isspace():
                at += 1
            if at > k and (not spared or "\n" in text[k:at]):
                pieces, piece, k = [*pieces, piece + text[k:at]], "", at
        elif c == "\u3002" or c == "\n":
            while k < len(text) and text[k].isspace():
                piece, k = piece + text[k], k + 1
            pieces, piece = [*pieces, piece], ""
    out = []
    for s in [*pieces, piece]:
        dense = any("\u4e00" <= x <= "\u9fff" for x in s)
        if (sum("\u4e00" <= x <= "\u9fff" for x in s) if dense else len(s.split())) <= 32:
            out.append(s)
            continue
        part = ""
        for k, c in enumerate(s):
            part += c
            mark = s[k - 1] in ",;" and c == " " or c == "\uff0c"
            if mark and k + 1 < len(s):
                out, part = [*out, part], ""
        out.append(part)
    return [s for s in out if s]


def brute_runs(rows, least=3):
    """(doc_id, text, removed) by looking at every run of sentences: a run of at least ``least``
    goes where the same words stood in an earlier document or place."""
    seen, out, done = {}, [], {}
    key = lambda r: (r[0] is not None, xxh64(r[1] or "") >> 2 if r[0] is None else r[0])
    for doc, text in sorted(rows, key=key):
        if (doc, text) in done:
            out.append((doc, *done[doc, text]))
            continue
        pieces = sentences_plainly(text or "")
        said = [tuple(p.lower()) if any("\u4e00" <= x <= "\u9fff" for x in p) else tuple(p.lower().split()) for p in pieces]
        full = [k for k, x in enumerate(said) if x]
        drop, held = set(), set()
        for x in range(len(full)):
            for y in range(x + least - 1, len(full)):
                run = tuple(said[k] for k in full[x : y + 1])
                if run in seen or run in held:
                    drop.update(range(full[x], full[y] + 1))
                held.add(run)
        seen.update(dict.fromkeys(held))
        done[doc, text] = None if text is None else "".join(p for k, p in enumerate(pieces) if k not in drop), len(drop)
        out.append((doc, *done[doc, text]))
    return sorted(out, key=str)


def xxh64(text):
    """Spark's xxhash64 of a text, unsigned."""
    import xxhash

    return xxhash.xxh64_intdigest(text.encode(), seed=42)


def cleaned(df):
    return sorted(((r.doc_id, r.text, r.n_removed) for r in span_dedup.span_dedup(df).collect()), key=str)


def test_span_dedup_removes_every_repeated_run(spark, odd, empty):
    rng = random.Random(4)
    said = lambda n, tag: " ".join([f"{tag}{rng.random()}"] + [f"word{rng.choice(['', ',', ' e.g. a', ';'])}" for _ in range(n - 1)]) + rng.choice([".", "!", '."', "?\n", ".\n\n"])
    rows = []
    for lengths in ((35, 20), (20, 20, 6, 6), (3, 3, 3, 40, 2, 2), (8, 8), (31, 1), (5, 4, 3, 2, 1), (7, 7, 7), (16,), (90, 3), (1, 1, 1)):
        passage = " ".join(said(n, "p") for n in lengths)
        for _ in range(3):
            rows.append((len(rows), " ".join([said(rng.randint(1, 12), "own") for _ in range(2)] + [passage] + [said(9, "own"), said(25, "own")])))
    pool = [said(rng.randint(1, 50), "pool") for _ in range(12)]
    for _ in range(60):
        rows.append((len(rows), " ".join(rng.choice(pool) for _ in range(rng.randint(1, 14)))))
    han = "".join(chr(0x4E00 + k * 37 % 3000) + ("\u3002" if k % 14 == 13 else "\uff0c" if k % 9 == 5 and k > 80 else "") for k in range(170))
    rows += [(len(rows) + k, chr(0x5000 + k) * 3 + "\u3002" + han) for k in range(3)]
    rows += [(None, rows[0][1] + " Tail one."), (None, rows[0][1] + " Tail two."), (None, None), rows[3], (500, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got, want = cleaned(df), brute_runs(rows)
    assert got == want
    told = {d: n for d, _, n in want}
    assert told[4] >= 4 and told[19] >= 3 and told[28] >= 3  # four sentences; three of seven words; three of one word
    short = odd.where("length(text) < 1000 or text is null")
    assert cleaned(short) == brute_runs([(r.doc_id, r.text) for r in short.collect()])
    clash = odd.withColumn("n_removed", F.lit("x"))
    assert span_dedup.span_dedup(clash).columns == [c for c in clash.columns if c != "n_removed"] + ["n_removed"]
    assert span_dedup.span_dedup(odd).count() == odd.count() and span_dedup.span_dedup(empty).count() == 0


def test_span_dedup_joins_many_places_too(spark, monkeypatch):
    same = " ".join(f"This is short repeated sentence number {k}." for k in ("one", "two", "three"))
    rows = [(i, f"Own {i} x. {same} Own {i} y.") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = cleaned(df)
    monkeypatch.setattr(span_dedup, "MOST_SENT", 0)
    assert cleaned(df) == want and sum(n for _, _, n in want) == 29 * 3


@pytest.mark.parametrize(
    "text, pieces",
    [
        ("", [""]),
        ("We met in New York and later saw Paris with Anna.", ["We met in New York and later saw Paris with Anna."]),
        ("Der Hund und die Katze sahen Frau Meier im Garten. Dann kam z.B. Dr. Alt am 3. Mai.", ["Der Hund und die Katze sahen Frau Meier im Garten. ", "Dann kam z.B. Dr. Alt am 3. Mai."]),
        ('He said "no." She left! J. R. Smith stayed... Then? ', ['He said "no." ', "She left! ", "J. R. Smith stayed... ", "Then? "]),
        ("Title\n\nA line\nanother one", ["Title\n\n", "A line\n", "another one"]),
        ("\u4f60\u597d\u3002\u518d\u89c1\uff01\u300d\u597d", ["\u4f60\u597d\u3002", "\u518d\u89c1\uff01\u300d", "\u597d"]),
        ("\u0915 \u0916\u0964 \u0917\u0964", ["\u0915 \u0916\u0964 ", "\u0917\u0964"]),
        ("a b, " * 9 + "c. D", ["a b, " * 9 + "c. ", "D"]),
        ("a b c d, " * 9 + "e.", ["a b c d, "] * 9 + ["e."]),
        ("word " * 50, ["word " * 50]),
    ],
)
def test_sentences(text, pieces):
    at = sentences.starts(text)
    assert [text[a:b] for a, b in zip(at, at[1:])] == pieces and at[0] == 0 and at[-1] == len(text)


def test_warc(spark):
    html = [(1, "u", "a" * 1000), (2, "u é", "a" * 1000), (3, None, "a" * 1000), (4, "u", "short"), (5, "u", "short"), (6, "u", None), (None, "u", "a" * 1000), (7, "u", "é" * 600), (3, None, "a" * 1000)]
    df = spark.createDataFrame(html, "page_id long, url string, html string")
    got = sorted((tuple(r) for r in warc.archive_round_trip(df).collect()), key=str)
    want = []
    for i, _, text in html:
        data = (text or "").encode()
        revisit = text == "a" * 1000 and i != 3
        want.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", 3 if revisit else None))
    assert got == sorted(want, key=str)
    assert warc.archive_round_trip(df.limit(0)).count() == 0
    big = spark.createDataFrame([(1, "u", "b" * 9_000_000, "z"), (2, "u", "b" * 9_000_000, None)], "page_id long, url string, html string, record_type string")
    back = warc.archive_round_trip(big)
    assert sorted((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in back.collect()) == [(1, 9_000_000, "revisit", 2), (2, 9_000_000, "response", None)]
    assert warc.wrong_revisits(back).count() == 0
    wrong = spark.createDataFrame([(1, 5, "aa", "revisit", 2), (2, 5, "bb", "response", None)], back.schema)
    assert warc.wrong_revisits(wrong).count() == 1


def test_records_are_found_by_the_sidecar(spark, tmp_path):
    df = spark.createDataFrame([(i, "u", f"{i}-" + "c" * 3000 * (i % 4)) for i in range(300)], "page_id long, url string, html string").repartition(3)
    streams = warc.write_streams(warc.record_types(df), f"file://{tmp_path}/streams")
    archives = warc.normalise(streams, f"file://{tmp_path}/warc")
    index = warc.read_index(archives).collect()
    assert len({r.path for r in index}) == streams.count() and sum(r.n_records for r in archives.collect()) == len(index) == 300
    for path in {r.path for r in index}:
        mine = sorted((r.offset, r.length, r.record_id) for r in index if r.path == path)
        data = open(path.removeprefix("file://"), "rb").read()
        assert sum(length for _, length, _ in mine) == len(data)
        for offset, length, record_id in mine:
            assert warc.urn(warc.parse_record(gzip.decompress(data[offset : offset + length]))[0]) == record_id
    short = archives.withColumn("n_records", F.col("n_records") + 1)
    with pytest.raises(Exception, match="lists"):
        warc.read_index(short).collect()


def test_gzip_normaliser_reads_streams_of_any_shape():
    import gzip
    import io

    records = [warc.record(k, "u", b"x" * (k * 70_000), hashlib.sha1(b"x" * (k * 70_000)).hexdigest(), "response", None) for k in range(4)]
    whole = gzip.compress(b"".join(records))
    members = b"".join(map(gzip.compress, records))
    for data in (whole, members):
        got = [d for _, d in warc.split_records(warc.inflate(io.BytesIO(data), 4096))]
        assert got == records
    with pytest.raises((ValueError, RuntimeError, StopIteration)):
        list(warc.split_records(iter([records[1][:40]])))


def test_nearest_neighbours(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 16)) * rng.uniform(0.5, 2, (3000, 1))
    x[50:90] = x[50]
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    rows += [(3000, None), (3001, [0.0] * 16), (3002, [float("nan")] + [1.0] * 15), (3003, [None] + [1.0] * 15), (None, [1.0] * 16), (3004, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = by_id(ann.nearest(df, lambda c: c % 20 == 0), "query_id")
    scores, hits = x @ x.T, 0
    np.fill_diagonal(scores, -np.inf)
    assert set(got) == set(range(0, 3000, 20))
    for q, found in got.items():
        found = sorted(found, key=lambda r: r["rank"])
        assert [r["rank"] for r in found] == list(range(1, 21))
        assert [(-r.score, r.vec_id) for r in found] == sorted((-r.score, r.vec_id) for r in found)
        assert all(abs(r.score - scores[q, r.vec_id]) < 1e-9 for r in found)
        hits += len({r.vec_id for r in found} & set(np.lexsort((np.arange(3000), -np.round(scores[q], 10)))[:20].tolist()))
    assert hits >= 0.9 * 20 * len(got)
    assert ann.nearest(df.limit(0), lambda c: c >= 0).count() == 0
    clash = df.where("vec_id < 100").withColumn("rank", F.lit("x")).withColumn("score", F.lit(1)).withColumn("list", F.lit(None))
    twice = by_id(ann.nearest(clash.unionByName(clash), lambda c: c % 20 == 0), "query_id")
    assert {q: len(v) for q, v in twice.items()} == {0: 20, 20: 20, 40: 20, 60: 20, 80: 20} and all(len({r.vec_id for r in v}) == 20 for v in twice.values())
    few = ann.nearest(df.where("vec_id < 7"), lambda c: c % 2 == 0)
    assert Counter(r.query_id for r in few.collect()) == {0: 6, 2: 6, 4: 6, 6: 6}
    assert ann.nearest(df.where("vec_id = 3000"), lambda c: c >= 0).count() == 0


@pytest.mark.parametrize("noise", [0.0, 0.3])
def test_nearest_neighbours_of_repeated_ids(spark, noise):
    rng = np.random.default_rng(2)
    x = np.repeat(rng.normal(size=(300, 8)), 25, axis=0)
    x += noise * rng.normal(size=x.shape)
    ids = np.repeat(np.arange(300), 25)
    df = spark.createDataFrame([(int(i), [float(v) for v in r]) for i, r in zip(ids, x)], "vec_id long, embedding array<double>")
    got = by_id(ann.nearest(df, lambda c: c % 20 == 0, list_size=40), "query_id")
    best = (x @ x.T).reshape(300, 25, 300, 25).max(axis=(1, 3))
    np.fill_diagonal(best, -np.inf)
    hits = 0
    for q in range(0, 300, 20):
        assert sorted(r["rank"] for r in got[q]) == list(range(1, 21)) and len({r.vec_id for r in got[q]}) == 20
        assert all(r.score <= best[q, r.vec_id] + 1e-9 for r in got[q])
        hits += sum(abs(r.score - best[q, r.vec_id]) < 1e-9 for r in got[q] if r.vec_id in np.argsort(-best[q])[:20])
    assert hits >= 0.9 * 20 * 15


CLASHES = "length int, n_tokens string, labels int, score string, keep string, lang_pred int, record_type string, sequence_id string"


def test_columns_named_like_the_results(spark):
    """Further columns that bear a result's or a work column's name change nothing."""
    rows = [(k, f"Licensed under the MIT license, text {k}.", "en", *[None] * 8) for k in range(8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, " + CLASHES)
    plain = df.select("doc_id", "text", "lang")
    jobs = {
        "op4": language_id.identify,
        "op5": lambda d: byte_bpe.round_trip(d, byte_bpe.multi_path()),
        "op6": lambda d: packing.pack(d, packing.tokenizer_path(), 1024, 2).drop("sequence_id", "offset"),
        "op7": licences.license_scan,
        "op8": lambda d: quality.classify(d).select("doc_id", "score", "keep"),
    }
    for name, job in jobs.items():
        assert Counter(map(tuple, job(df).collect())) == Counter(map(tuple, job(plain).collect())), name


def test_language_model_does_not_depend_on_row_order(spark, small):
    """Ids that repeat with other texts and languages, and null texts with a language."""
    again = small.limit(60).withColumn("text", F.concat(F.lit("zzz "), F.col("text"))).withColumn("lang", F.lit("xx"))
    twice = small.limit(30).withColumn("lang", F.lit("aa"))
    nulls = small.limit(20).withColumn("text", F.lit(None).cast("string")).withColumn("lang", F.lit("null-texts"))
    rows = small.unionByName(again).unionByName(twice).unionByName(nulls)
    models = [language_id.fit(rows.repartition(n, "n_chars")) for n in (1, 7)]
    assert models[0].languages == models[1].languages and "null-texts" not in models[0].languages
    assert np.array_equal(models[0].weights, models[1].weights)


def test_byte_bpe_of_a_whole_table_is_the_library_s(spark):
    import tiktoken

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    theirs = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.load_ranks(byte_bpe.multi_path()), special_tokens={})
    got = {r.doc_id: r for r in byte_bpe.round_trip(docs, byte_bpe.multi_path()).collect()}
    rows = docs.collect()
    assert len(got) == len(rows)
    for r in rows:
        ids = theirs.encode_ordinary(r.text or "")
        g = got[r.doc_id]
        assert (g.n_tokens, g.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert g.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
