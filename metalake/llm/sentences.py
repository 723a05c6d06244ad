"""Sentences of a text, as places where they start.

A sentence ends after its full stop (of any script, with what closes a quotation) or at a line
end. A full stop after an abbreviation, an initial or a numbered heading's short number isn't
one. A sentence of more than ``CUT_OVER`` words is cut at its clause marks (commas, semicolons,
colons, dashes): people quote and paste clauses whole, and such a cut depends on the sentence
alone. A sentence without clause marks stays whole, however long.
"""

from __future__ import annotations

import re

STOPS = ".!?।॥۔؟…።။។"
CLOSERS = "\"')\\]»”’"
#: Full stops of scripts that need no white space after them, and what closes their quotations.
WIDE, WIDE_CLOSERS = "。！？｡", "」』”）"
END = re.compile(rf"[{STOPS}]+[{CLOSERS}]*\s+|[{WIDE}]+[{WIDE_CLOSERS}]*\s*|\s*\n\s*")
#: Abbreviations that are followed by a full stop inside a sentence.
ABBREVIATIONS = ["Mr", "Mrs", "Ms", "Dr", "Prof", "St", "Sr", "Jr", "vs", "cf", "e.g", "i.e", "approx", "Fig", "Vol", "pp", "bzw", "ca", "z.B", "z. B", "d.h", "d. h", "u.a", "Nr", "Abs", "Hr", "Mme", "p. ex", "Sra", "Inc", "Ltd", "Corp"]
NO_END = re.compile(r"(?:^|[\s(\"'\u00ab\u201c])(?:" + "|".join(re.escape(a) for a in ABBREVIATIONS) + r"|[A-Z\u00c0-\u00de]|\d{1,2})\.\s+$")
CLAUSE = re.compile(r"[,;:،؛]\s+|[、，；：]\s*|\s[–—-]\s+")
#: Characters of scripts that write no spaces between words: each counts as a word.
UNSPACED = r"\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff"
HAS_UNSPACED = re.compile(f"[{UNSPACED}]")
WORD = re.compile(rf"[{UNSPACED}]|[^\s{UNSPACED}]+")
CUT_OVER = 32


def words(piece: str, dense: bool | None = None) -> list[str]:
    """Words of a piece; dense: whether it may hold scripts without spaces, if known."""
    if dense is None:
        dense = HAS_UNSPACED.search(piece) is not None
    return WORD.findall(piece) if dense else piece.split()


def starts(text: str, dense: bool | None = None) -> list[int]:
    """Start of each sentence, or clause of an overlong one, and the text's length."""
    if dense is None:
        dense = HAS_UNSPACED.search(text) is not None
    out = [0]

    def until(end: int) -> None:
        a = out[-1]
        if end - a > (CUT_OVER if dense else 2 * CUT_OVER) and len(words(text[a:end], dense)) > CUT_OVER:
            out.extend(m.end() for m in CLAUSE.finditer(text, a, end) if m.end() < end)
        out.append(end)

    for m in END.finditer(text):
        end = m.end()
        if end == len(text):
            break
        if text[m.start()] == "." and "\n" not in m.group() and NO_END.search(text, max(m.start() - 12, 0), end):
            continue
        if end > out[-1]:
            until(end)
    if len(text) > out[-1] or len(out) == 1:
        until(len(text))
    return out
