"""Licenses that a text names: SPDX tags with whole expressions, and phrases of notices and texts.

All phrases are found in one pass over the normalised words, by an automaton that each task
builds once; the rest is native. Words are lower-case runs of letters, digits and ``.+-``,
without full stops at their ends, with one space between and around them.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values: (name, phrase) of licenses whose names follow no rule.
SINGLE = [
    ("MIT", " mit license"), ("MIT", " permission is hereby granted free of charge"), ("MIT-0", " mit no attribution"), ("Apache-2.0", " apache license version 2.0"), ("Apache-1.1", " apache software license version 1.1"),
    ("BSD", " redistribution and use in source and binary forms"), ("BSD-3-Clause", " neither the name of"), ("BSD-4-Clause", " all advertising materials mentioning features or use of this software"), ("BSD-2-Clause", " bsd 2-clause"), ("BSD-3-Clause", " bsd 3-clause"), ("BSD-4-Clause", " bsd 4-clause"),
    ("0BSD", " zero-clause bsd"), ("0BSD", " bsd zero clause license"), ("ISC", " isc license "), ("ISC", " permission to use copy modify and or distribute this software for any purpose with or without fee"), ("Unlicense", " free and unencumbered software released into the public domain"),
    ("WTFPL", " do what the fuck you want to public license"), ("Zlib", " zlib license "), ("Zlib", " this software is provided as-is without any express or implied warranty in no event will the authors be held liable"), ("BSL-1.0", " boost software license version 1.0"),
    ("CC-BY-NC-4.0", " cc by-nc 4.0"), ("CC0-1.0", " cc0 1.0 universal"), ("CC0-1.0", " creative commons zero"), ("PDDL-1.0", " public domain dedication and license"), ("ODbL-1.0", " open database license"), ("ODC-By-1.0", " open data commons attribution license"),
    ("Ruby", " ruby is copyrighted free software"), ("Python-2.0", " python software foundation license version 2"), ("PHP-3.01", " php license version 3.01"), ("PostgreSQL", " postgresql license"), ("OpenSSL", " openssl license"), ("curl", " curl license"), ("NCSA", " university of illinois ncsa open source license"),
    ("Vim", " vim license"), ("X11", " x11 license"), ("Beerware", " the beer-ware license"), ("JSON", " the software shall be used for good not evil"), ("MS-PL", " microsoft public license"), ("MS-RL", " microsoft reciprocal license"), ("Sleepycat", " sleepycat license"), ("UPL-1.0", " universal permissive license"),
    ("SSPL-1.0", " server side public license"), ("BUSL-1.1", " business source license 1.1"), ("Elastic-2.0", " elastic license 2.0"), ("QPL-1.0", " the q public license"), ("IPL-1.0", " ibm public license version 1.0"), ("CPL-1.0", " common public license version 1.0"), ("W3C", " w3c software notice and license"),
    ("ECL-2.0", " educational community license version 2.0"), ("OFL-1.1", " sil open font license version 1.1"), ("HPND", " historical permission notice and disclaimer"), ("ICU", " icu license"), ("libpng", " libpng license"), ("FTL", " the freetype project license"), ("IJG", " independent jpeg group s software"),
    ("AFL-2.1", " academic free license version 2.1"), ("AFL-3.0", " academic free license version 3.0"), ("OSL-2.1", " open software license version 2.1"), ("OSL-3.0", " open software license version 3.0"), ("RPL-1.5", " reciprocal public license 1.5"), ("CECILL-B", " cecill-b"), ("CECILL-C", " cecill-c"),
    ("BlueOak-1.0.0", " blue oak model license"), ("MulanPSL-2.0", " mulan permissive software license version 2"), ("SISSL", " sun industry standards source license"), ("NPL-1.1", " netscape public license version 1.1"), ("ZPL-2.1", " zope public license zpl version 2.1"), ("Watcom-1.0", " sybase open watcom public license version 1.0"),
]
#: Families whose versions stand in the name and after the phrase.
FAMILIES = [
    ("GPL", "gnu general public license", ["1.0", "2.0", "3.0"]), ("LGPL", "gnu lesser general public license", ["2.1", "3.0"]), ("LGPL", "gnu library general public license", ["2.0"]), ("AGPL", "gnu affero general public license", ["1.0", "3.0"]),
    ("GFDL", "gnu free documentation license", ["1.1", "1.2", "1.3"]), ("MPL", "mozilla public license", ["1.0", "1.1", "2.0"]), ("EPL", "eclipse public license", ["1.0", "2.0"]), ("CDDL", "common development and distribution license", ["1.0", "1.1"]),
    ("EUPL", "european union public licence", ["1.0", "1.1", "1.2"]), ("Artistic", "the artistic license", ["1.0", "2.0"]), ("LPPL", "latex project public license", ["1.0", "1.1", "1.2", "1.3c"]), ("CECILL", "cecill free software license agreement", ["1.0", "1.1", "2.0", "2.1"]),
]
#: The parts of the commons licenses' names, in words and in short.
COMMONS = [("BY", "attribution"), ("BY-SA", "attribution-sharealike"), ("BY-NC", "attribution-noncommercial"), ("BY-ND", "attribution-noderivatives"), ("BY-NC-SA", "attribution-noncommercial-sharealike"), ("BY-NC-ND", "attribution-noncommercial-noderivatives")]
COMMONS_VERSIONS = ["1.0", "2.0", "2.5", "3.0", "4.0"]


def phrases() -> list[tuple[str, str]]:
    """(name, phrase) of all licenses; a phrase begins, and where a longer version could follow ends, with a space."""
    out = list(SINGLE)
    for name, words, versions in FAMILIES:
        for v in versions:
            shown = [v, v.removesuffix(".0")] if v.endswith(".0") else [v]
            out += [(f"{name}-{v}", f" {words} {how}{s} ") for s in shown for how in ("version ", "v", "")]
    for short, words in COMMONS:
        for v in COMMONS_VERSIONS:
            out += [(f"CC-{short}-{v}", f" creative commons {words} {v} "), (f"CC-{short}-{v}", f" cc {short.lower()} {v} "), (f"CC-{short}-{v}", f" cc-{short.lower()}-{v} ")]
    return sorted(set(out))


PHRASES = phrases()
ID = r"[A-Za-z0-9][A-Za-z0-9.+:-]*"
TAG = r"SPDX-License-Identifier:[ \t]*([^\r\n]*)"
#: The longest start of a line that reads as an expression; brackets group, so they don't change which names occur.
EXPRESSION = rf"^([( ]*{ID}(?: +WITH +{ID})?[ )]*(?:(?:AND|OR) *[( ]*{ID}(?: +WITH +{ID})?[ )]*)*)"
OPERAND = rf"{ID}(?: +WITH +{ID})?"


def words(text: Column) -> Column:
    plain = F.regexp_replace(F.lower(text), "[^a-z0-9.+-]+", " ")
    return F.regexp_replace(F.concat(F.lit(" "), plain, F.lit(" ")), "[.]+ ", " ")


def expression_names(expression: Column) -> Column:
    """Names in an SPDX expression (AND, OR, WITH, brackets), in order; what follows its end is left out."""
    start = F.regexp_extract(expression, EXPRESSION, 1)
    return F.filter(F.regexp_extract_all(start, F.lit(f"({OPERAND})"), 1), lambda n: ~n.isin("AND", "OR", "WITH"))


def tagged(text: Column) -> Column:
    return F.flatten(F.transform(F.regexp_extract_all(text, F.lit(TAG), 1), expression_names))


def named(rows: DataFrame, id_col: str) -> DataFrame:
    """(id, names) of rows (id, words, tags): the phrases' names and the tags', each once."""
    kind = rows.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        held: dict[str, set[str]] = {}
        for name, phrase in PHRASES:
            held.setdefault(phrase, set()).add(name)
        for phrase, names in held.items():
            automaton.add_word(phrase, sorted(names))
        automaton.make_automaton()
        for b in batches:
            out = []
            for text, tags in zip(b[1].to_pylist(), b[2].to_pylist()):
                names = set(tags or ())
                for _, found in automaton.iter(text or ""):
                    names.update(found)
                out.append(sorted(names))
            yield pa.record_batch([b[0], pa.array(out, pa.list_(pa.string()))], [id_col, "names"])

    return rows.mapInArrow(run, f"`{id_col}` {kind}, names array<string>")


def licenses(blobs: DataFrame, id_col: str = "id") -> DataFrame:
    """One row (id, license) per license that the text of ``data`` names, by SPDX tag or by phrase;
    bytes that are no UTF-8 name none."""
    text = F.try_validate_utf8(F.col("data").cast("string"))
    found = named(blobs.select(id_col, words(text).alias("words"), tagged(text).alias("tags")), id_col)
    return found.select(id_col, F.explode("names").alias("license"))
