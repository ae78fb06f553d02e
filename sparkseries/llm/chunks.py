"""Texts cut where a tokenizer's own splitting pattern always cuts, so that repeated parts are encoded once per task."""

from __future__ import annotations

import re

#: A space before white space or the end: only there may a split at a space change the pieces.
LOOSE_SPACE = re.compile(r" (?:\s|\Z)")
BETWEEN = re.compile(r"(?<=\S)(?= \S)")


def chunks(text: str) -> list[str]:
    """The text in parts: each starts at a space that stands between two characters that are not white space.

    The pattern of the byte-level tokenizers never matches across such a place and looks no further ahead than one
    character, so the tokens of the parts, one after the other, are the tokens of the text.
    """
    if not text:
        return []
    if LOOSE_SPACE.search(text):
        return BETWEEN.split(text)
    first, *rest = text.split(" ")
    return [first, *[" " + part for part in rest]] if first else [" " + part for part in rest]
