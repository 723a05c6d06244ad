"""License scan with a positional rare-token index.

The index holds, for every notice, the positions of its words of highest IDF; document
frequencies come from all documents. A file's own indexed words are looked up rarest first,
a few at a time: an occurrence at place p of the file and at place q of a notice puts the
notice's start at p - q, and starts on which enough different words agree are aligned word by
word. A match counts only if the notice's mandatory key phrase stands in the aligned window.
The lookup ends when all of a file's indexed words have been seen, so several notices in one
file, or one inside another, are all found.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

#: The phrases of the base scan and their labels.
BASE: list[tuple[str, str]] = [
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
]
#: Fixed values: (label, mandatory key phrase, notice) of common license notices and texts,
#: lower-case words without punctuation.
TEMPLATES: list[tuple[str, str, str]] = [
    ("mit", "mit license", "licensed under the mit license"),
    ("mit", "mit license", "released under the mit license"),
    ("mit", "mit license", "released under the terms of the mit license"),
    ("mit", "mit license", "this project is licensed under the mit license see the license file for details"),
    ("mit", "permission is hereby granted", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so"),
    ("mit", "permission is hereby granted", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("apache", "apache license", "licensed under the apache license version 2 0"),
    ("apache", "apache license", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("apache", "limitations under the license", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license"),
    ("gpl", "general public license", "licensed under the gnu general public license version 3"),
    ("gpl", "general public license", "licensed under the gnu general public license version 2"),
    ("gpl", "general public license", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("gpl", "general public license", "you should have received a copy of the gnu general public license along with this program if not see"),
    ("gpl", "general public license", "redistribute it and or modify it under the terms of the gnu general public license"),
    ("gpl", "freedom to share and change it", "the licenses for most software are designed to take away your freedom to share and change it by contrast the gnu general public license is intended to guarantee your freedom to share and change free software"),
    ("lgpl", "lesser general public license", "under the terms of the gnu lesser general public license"),
    ("lgpl", "lesser general public license", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version"),
    ("agpl", "affero general public license", "under the terms of the gnu affero general public license"),
    ("agpl", "affero general public license", "licensed under the gnu affero general public license version 3"),
    ("bsd", "redistribution and use", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", "redistributions of source code", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"),
    ("bsd", "neither the name", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd", "bsd license", "licensed under the bsd license"),
    ("isc", "permission to use copy modify", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("zlib", "altered source versions", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("boost", "boost software license", "distributed under the boost software license version 1 0"),
    ("unlicense", "unencumbered software", "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software"),
    ("cc0", "cc0 1 0", "released under cc0 1 0 universal public domain dedication"),
    ("cc-by", "creative commons attribution", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by", "cc by 4 0", "licensed under cc by 4 0"),
    ("cc-by-nc", "cc by nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "attribution noncommercial", "licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-nd", "cc by nd", "licensed under cc by nd 4 0"),
    ("cc-by-sa", "cc by sa", "licensed under cc by sa 4 0"),
    ("cc-by-sa", "attribution sharealike", "licensed under a creative commons attribution sharealike 4 0 international license"),
    ("mpl", "mozilla public license", "subject to the terms of the mozilla public license v 2 0"),
    ("mpl", "mozilla public license", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("epl", "eclipse public license", "this program and the accompanying materials are made available under the terms of the eclipse public license v 2 0"),
    ("eupl", "european union public licence", "licensed under the eupl version 1 2 european union public licence"),
    ("artistic", "artistic license", "distributed under the terms of the artistic license 2 0"),
    ("sspl", "server side public license", "under the terms of the server side public license version 1"),
    ("proprietary", "all rights reserved", "all rights reserved do not distribute"),
    ("proprietary", "confidential", "this document is confidential and proprietary and may not be copied or distributed without written permission"),
]
#: Bytes of words stay (A-Z in lower case); every other byte becomes a space.
WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(WORDS).split()


def spaced(text: str) -> list[bytes]:
    return text.encode().split()


def document_frequencies(df: DataFrame, vocabulary: set[bytes]) -> tuple[int, dict[bytes, int]]:
    """Documents, and those with each word of ``vocabulary``; the tasks send sums only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = Counter(), 0
        for b in batches:
            n += b.num_rows
            for text in b[0]:
                seen.update(vocabulary.intersection(words_of(text.as_py())))
        rows = [("", n), *((w.decode(), c) for w, c in seen.items())]
        yield pa.record_batch([pa.array([w for w, _ in rows]), pa.array([c for _, c in rows], pa.int64())], ["word", "n"])

    sums = df.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    found = {r["word"].encode(): r["n"] for r in sums}
    return found.pop(b"", 0), found


class Index:
    """Postings of each notice's ``per_template`` words of highest IDF, looked up
    ``at_once`` of a file's rarest words at a time."""

    def __init__(self, n_docs: int, frequencies: dict[bytes, int], per_template: int, at_once: int, templates: list[tuple[str, str, str]]):
        self.at_once = at_once
        self.templates = [(label, spaced(key), spaced(notice)) for label, key, notice in templates]
        self.idf = {w: math.log((1 + n_docs) / (1 + frequencies.get(w, 0))) for _, _, notice in self.templates for w in notice}
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        self.needed: list[int] = []
        for t, (_, _, notice) in enumerate(self.templates):
            rare = self.rarest(set(notice))[:per_template]
            self.needed.append(max(1, (len(rare) + 1) // 2))
            for q, word in enumerate(notice):
                if word in rare:
                    self.postings[word].append((t, q))
        self.postings = dict(self.postings)
        self.ends: dict[bytes, list[tuple[list[bytes], str]]] = defaultdict(list)
        for phrase, label in BASE:
            self.ends[spaced(phrase)[-1]].append((spaced(phrase), label))
        self.watched = set(self.postings) | set(self.ends)

    def rarest(self, words: set[bytes]) -> list[bytes]:
        return sorted(words, key=lambda w: (-self.idf[w], w))

    def aligned(self, words: list[bytes], t: int, start: int) -> float:
        """Share of notice t's words that stand in place from ``start`` on, give or take one
        word; 0 where its key phrase is missing."""
        _, key, notice = self.templates[t]
        window = words[max(0, start - 2) : max(0, start + len(notice) + 2)]
        if not any(window[i : i + len(key)] == key for i in range(len(window) - len(key) + 1)):
            return 0.0
        return sum(any(0 <= start + q + d < len(words) and words[start + q + d] == w for d in (0, -1, 1)) for q, w in enumerate(notice)) / len(notice)

    def matches(self, words: list[bytes], places: dict[bytes, list[int]], least: float = 0.6) -> list[tuple[int, int, float]]:
        """(notice, start, share) of every notice found; ``places``: the indexed words' places."""
        votes: dict[tuple[int, int], set[bytes]] = defaultdict(set)
        out, tried = [], set()
        order = self.rarest(set(places))
        for at in range(0, len(order), self.at_once):
            touched = set()
            for word in order[at : at + self.at_once]:
                for p in places[word]:
                    for t, q in self.postings[word]:
                        votes[t, p - q].add(word)
                        touched.add((t, p - q))
            for t, start in sorted(touched | {(t, s + d) for t, s in touched for d in (-1, 1)} & votes.keys()):
                near = set().union(*(votes.get((t, start + d), ()) for d in (-1, 0, 1)))
                if len(near) < self.needed[t] or (t, start) in tried:
                    continue
                tried.add((t, start))
                if (share := self.aligned(words, t, start)) >= least:
                    out.append((t, start, share))
        return out

    def scan(self, text: str) -> tuple[int, int, int | None, int | None, str, str, float]:
        words = words_of(text)
        base, found, places = [], set(), defaultdict(list)
        for p in [i for i, w in enumerate(words) if w in self.watched]:
            for phrase, label in self.ends.get(words[p], ()):
                start = p - len(phrase) + 1
                if start >= 0 and words[start : p + 1] == phrase:
                    base.append(start)
                    found.add(label)
            if words[p] in self.postings:
                places[words[p]].append(p)
        labels, score = set(found), 0.5 if base else 0.0
        for t, _, share in self.matches(words, places):
            labels.add(self.templates[t][0])
            score = max(score, share)
        return len(words), len(base), min(base, default=None), max(base, default=None), ",".join(sorted(found)), ",".join(sorted(labels)), score


def license_scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", per_template: int = 4, at_once: int = 8, templates: list[tuple[str, str, str]] = TEMPLATES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row.

    Words are runs of digits, a-z (after lower-casing A-Z) and characters beyond ASCII. n_base
    counts all places where a base phrase's words stand consecutively; first_word and
    last_word are their smallest and largest start (null without any). labels adds the
    labels of matched templates; score is the best share of a matched template's words, at
    least 0.5 with a base place, else 0. Null text counts as empty; ids may be null or
    repeated; an empty table gives no rows; further columns are not read.
    """
    texts = df.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    index = Index(*document_frequencies(texts.select("text"), {w for _, _, notice in templates for w in spaced(notice)}), per_template, at_once, templates)
    shared = df.sparkSession.sparkContext.broadcast(index)
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64())
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [shared.value.scan(text.as_py()) for text in b[1]]
            columns = zip(*rows) if rows else [()] * len(kinds)
            yield pa.record_batch([b[0], *(pa.array(list(c), k) for c, k in zip(columns, kinds))], names)

    return texts.mapInArrow(run, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")
