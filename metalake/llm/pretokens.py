"""Splitting text into pre-tokens by the pattern of the public rank files."""

from __future__ import annotations

import re

import public_tokenizers
import regex

_FULL = regex.compile(public_tokenizers.PATTERN)
#: Texts of these characters alone (Latin letters, ASCII, common punctuation) have the same
#: matches under the narrower pattern below, which the standard library runs much faster.
_LETTER = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_NUMBER = "0-9²³¹¼-¾"
_PLAIN = re.compile("[\\t\\n\\r -~¡-ɏ‐-‧‰-⁞]*")
_FAST = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^\\t\\n\\r {_LETTER}{_NUMBER}]+"
    "|[\\t\\n\\r ]+(?![^\\t\\n\\r ])|[\\t\\n\\r ]+"
)


def split(text: str) -> list[str]:
    """The consecutive matches of the pattern; joined they give ``text`` back."""
    return _FAST.findall(text) if _PLAIN.fullmatch(text) else _FULL.findall(text)
