"""Cutting a text into pieces that byte-level BPE encodes independently."""

from __future__ import annotations

import re

#: Two white-space characters side by side, or one at the end: only there does
#: the pre-tokenising pattern look beyond a single space or line end.
_ODD = re.compile(r"\s\s|\s\Z")
#: ASCII white space beside space and line end, and pairs of these two: quicker to look for.
_OTHER = "\t\x0b\x0c\r\x1c\x1d\x1e\x1f"
_PAIRS = ("  ", "\n\n", " \n", "\n ")


def cut(text: str) -> tuple[str, list[str]] | None:
    """``(head, rest)``: ``head`` is the piece before the first space or line end;
    a piece of ``rest`` that starts with a line end stands for itself, any other
    for itself after one space. None for a text with odd white space, which must be
    taken whole.

    A match of the pattern has a space only as its first character (white-space
    runs aside), and a single line end between other characters is a match of its
    own, so in all other texts every cut lies between two matches and no match
    looks across it.
    """
    if text.isascii() and not any(c in text for c in _OTHER):
        if any(pair in text for pair in _PAIRS) or text[-1:] in (" ", "\n"):
            return None
    elif _ODD.search(text):
        return None
    head, *rest = text.replace("\n", " \n").split(" ")
    return head, rest
