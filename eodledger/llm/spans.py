"""Spans in texts as the operators report them: (kind, start, end), code points, end exclusive."""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterable

Span = tuple[str, int, int]


def written(spans: Iterable[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def digest(spans: Iterable[Span]) -> str:
    return hashlib.sha256(written(spans).encode()).hexdigest()


class Taken:
    """Places that are taken, as sorted places apart from each other; each question is one search."""

    def __init__(self, places: Iterable[tuple[int, int]] = ()):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for start, end in sorted(places):
            if self.ends and start < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def apart(self, start: int, end: int) -> bool:
        """Whether the place overlaps none of them."""
        i = bisect_left(self.starts, end)
        return i == 0 or self.ends[i - 1] <= start

    def within(self, start: int, end: int) -> list[tuple[int, int]]:
        """Those that overlap the place."""
        span = slice(bisect_right(self.ends, start), bisect_left(self.starts, end))
        return list(zip(self.starts[span], self.ends[span]))

    def add(self, start: int, end: int) -> None:
        """Take a place that is apart from the others."""
        i = bisect_left(self.starts, start)
        self.starts.insert(i, start)
        self.ends.insert(i, end)


def replaced(text: str, spans: Iterable[Span], mark) -> str:
    """The text with each span replaced by ``mark(kind)``; overlapping spans are replaced as one."""
    out, at, last = [], 0, None
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if last is not None and start < last:
            last = max(last, end)
            at = last
            continue
        out += [text[at:start], mark(kind)]
        at = last = end
    return "".join([*out, text[at:]])
