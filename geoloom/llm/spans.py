"""Spans in texts: (kind, start, end) in code points, end exclusive."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

Span = tuple[str, int, int]


def joined(spans: Iterable[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def digest(spans: Iterable[Span]) -> str:
    return hashlib.sha256(joined(spans).encode()).hexdigest()


def overlaps(a: int, b: int, taken: list[Span]) -> bool:
    return any(x < b and a < y for _, x, y in taken)


def redacted(text: str, spans: Iterable[Span], names: dict[str, str]) -> str:
    """The text with every span replaced by its kind's name; overlapping spans by the first one's."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], names[kind]]
        at = max(at, b)
    return "".join(out) + text[at:]
