"""Secrets in texts: fixed formats, and random strings that a tokenizer finds hard to write."""

from __future__ import annotations

import base64
import re
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType

from eodledger.llm.common import fresh, per_text
from eodledger.llm.spans import Span, Taken, digest, replaced, written

KINDS = ("assign", "access", "hex", "random")

# Fixed formats.
ASSIGN = re.compile(
    r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_LEAST = 8
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")

#: A run that may hold random strings, and its parts between signs.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
PART = re.compile(r"[A-Za-z0-9]+")
#: Characters of the shortest random string, and of the windows slid over longer parts by steps of ``STEP``.
SHORTEST, STEP = 16, 4
#: Characters a token of the tiktoken vocabulary, below which a candidate counts as random.
CHARS_PER_TOKEN = 2.0
#: Hexadecimal digits of the digests in use: MD5, SHA-1, SHA-224, SHA-256, SHA-384, SHA-512.
DIGESTS = (32, 40, 56, 64, 96, 128)
DIGEST = re.compile("|".join(f"(?:[0-9a-f]{{{n}}}|[0-9A-F]{{{n}}})" for n in DIGESTS))
UUID = re.compile(r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
WORD = re.compile(r"[A-Z]?[a-z]{2,}|[A-Z]{3,}")
#: Characters a token from which a part is a name, whatever its letters; a word is one from the other bound.
NAME_RATIO = 3.0


@lru_cache(maxsize=2)
def ranks(path: str, pattern: str):
    """The tiktoken encoding of a file of ranks."""
    import tiktoken

    with open(path, "rb") as file:
        found = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("scan", pat_str=pattern, mergeable_ranks=found, special_tokens={})


def base_spans(text: str) -> list[Span]:
    """The fixed formats, leftmost and non-overlapping within a kind."""
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    return found + [("hex", m.start(), m.end()) for m in HEX.finditer(text)]


def left_over(start: int, end: int, taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """What sorted spans leave of a place."""
    out = []
    for s, e in taken:
        if s < end and e > start:
            out.append((start, s))
            start = max(start, e)
    return [(a, b) for a, b in [*out, (start, end)] if a < b]


def named(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """Digests in usual lengths and UUIDs within a run: long strings that are no secrets."""
    out = [m.span() for m in UUID.finditer(text, start, end)]
    return sorted(out + [m.span() for m in PART.finditer(text, start, end) if DIGEST.fullmatch(m[0])])


def stretches(text: str, start: int, end: int, ratio, least: float) -> list[tuple[int, int]]:
    """Random strings of a run: what lies between its names, and windows of long parts that are no random string as a whole."""
    out, open_parts = [], []

    def close() -> None:
        """Parts that follow each other are one string if it is random and one of them is no number."""
        if open_parts:
            a, b = open_parts[0][0], open_parts[-1][1]
            if b - a >= SHORTEST and any(e - s >= 6 and r < least and not text[s:e].isdigit() for s, e, r in open_parts) and ratio(text[a:b]) < least:
                out.append((a, b))
            else:
                out.extend((s, e) for s, e, r in open_parts if e - s >= SHORTEST and r < least and not text[s:e].isdigit())
        open_parts.clear()

    for m in PART.finditer(text, start, end):
        beside = text[max(0, m.start() - 1) : m.start()] + text[m.end() : m.end() + 1]
        if m[0].isalpha() and not beside.isascii() and any(c.isalpha() and not c.isascii() for c in beside):
            close()  # a piece of a word with letters that the alphabet lacks
            continue
        r = ratio(m[0])
        if r >= NAME_RATIO or r >= least and (WORD.fullmatch(m[0]) or len(m[0]) >= SHORTEST):
            close()
            last = m.end() - SHORTEST
            for at in [*range(m.start(), last, STEP), last] if last > m.start() else []:
                if ratio(text[at : at + SHORTEST]) < least and not text[at : at + SHORTEST].isdigit():
                    if out and at <= out[-1][1]:
                        out[-1] = (out[-1][0], at + SHORTEST)
                    else:
                        out.append((at, at + SHORTEST))
        else:
            open_parts.append((*m.span(), r))
    close()
    return out


def random_spans(text: str, encoding, least: float, taken: list[Span]) -> list[Span]:
    """Strings with few characters a token that overlap no other span."""
    ratio = lambda s: len(s) / len(encoding.encode_ordinary(s))
    base = Taken((s, e) for _, s, e in taken)
    out: list[Span] = []
    for m in CANDIDATE.finditer(text):
        for a, b in left_over(*m.span(), sorted(base.within(*m.span()) + named(text, *m.span()))):
            if b - a >= SHORTEST:
                out += [("random", *x) for x in stretches(text, a, b, ratio, least)]
    return out


def ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def find(text: str, encoding, least: float = CHARS_PER_TOKEN) -> tuple[list[Span], list[Span]]:
    """Base spans and all spans of a whole text."""
    base = base_spans(text)
    return ordered(base), ordered(base + random_spans(text, encoding, least, base))


def scan(
    df: DataFrame,
    path: str,
    pattern: str,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    least: float = CHARS_PER_TOKEN,
) -> DataFrame:
    """The kept columns, counts by kind, the digest of the base spans, and all spans.

    ``path`` is a tiktoken file of ranks, ``pattern`` its splitting pattern. A null text counts as
    empty; a text without spans has zero counts, the digest of nothing and empty ``spans``. One
    row for each row of ``df``; repeated rows repeat; other columns are not read.
    """
    names = {f"n_{k}": LongType() for k in KINDS}
    fields = names | {"base_sha256": StringType(), "spans": StringType()}

    def work():
        encoding = ranks(path, pattern)

        def run(texts: list) -> dict:
            out: dict = {k: [] for k in fields}
            for t in texts:
                base, spans = find(t or "", encoding, least)
                for k in KINDS:
                    out[f"n_{k}"].append(sum(s[0] == k for s in spans))
                out["base_sha256"].append(digest(base))
                out["spans"].append(written(spans))
            return out

        return run

    return per_text(df, text, keep, fields, work)


def redact(df: DataFrame, path: str, pattern: str, text: str = "text", length: str | None = None, least: float = CHARS_PER_TOKEN) -> DataFrame:
    """``df`` with each secret in its text replaced by ``[SECRET]``, and no other change.

    A null text stays null. ``length``, if given, is a column that is set to the number of
    characters of a changed text. Every row stays; the columns are those of ``df``.
    """
    from pyspark.sql import functions as F

    clean, changed = fresh(df, "__clean"), fresh(df, "__changed")

    def work():
        encoding = ranks(path, pattern)

        def run(texts: list) -> dict:
            new = [None if t is None else replaced(t, find(t, encoding, least)[1], lambda _: "[SECRET]") for t in texts]
            return {clean: new, changed: [int(a != b) for a, b in zip(texts, new)]}

        return run

    found = per_text(df, text, tuple(df.columns), {clean: StringType(), changed: LongType()}, work)

    def column(name: str):
        if name == text:
            return F.col(clean).alias(name)
        if name == length:
            kind = df.schema[name].dataType
            return F.when(F.col(changed) == 1, F.length(clean).cast(kind)).otherwise(F.col(name)).alias(name)
        return F.col(name)

    return found.select(*[column(c) for c in df.columns])
