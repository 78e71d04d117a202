"""BPE encoding by forced boundaries, and decoding.

A pair of symbols that stands side by side in no token of the vocabulary can never be merged over,
because every merge makes a token. Such a pair is therefore a certain cut: what lies on either side
is encoded on its own, and the ids are concatenated. Words, too, are cuts. Fragments repeat far more
often than words, and words than texts, so both are looked up before anything is merged.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType

from eodledger.llm.common import per_text

#: Words and fragments that a Python worker remembers, each (words twice).
REMEMBERED = 150_000


class Vocabulary:
    """A vocabulary file of the tokenizers library: BPE over bytes with an end-of-word suffix."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        self.ids: dict[str, int] = model["vocab"]
        #: The id of a merged pair, and the pair's rank, by the ids of the two.
        self.made = {self.ids[a] << 16 | self.ids[b]: self.ids[a + b] for a, b in model["merges"]}
        self.ranks = {pair: rank for rank, pair in enumerate(self.made)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in (self.ids | self.special).items()}
        self.beside = {pair for token in self.ids for pair in self._pairs(token)}

    def _pairs(self, token: str):
        symbols = self.symbols(token.removesuffix(self.end), token.endswith(self.end) and token != self.end)
        return zip(symbols, symbols[1:])

    def symbols(self, word: str, ends: bool = True) -> list[int]:
        """The id of each character; the last has the suffix."""
        ids = self.ids
        if ends and word:
            return [*[ids[c] for c in word[:-1]], ids[word[-1] + self.end]]
        return [ids[c] for c in word]

    def fragments(self, symbols: list[int]) -> list[list[int]]:
        """The symbols between certain cuts."""
        beside = self.beside
        cuts = [i for i, pair in enumerate(zip(symbols, symbols[1:]), 1) if pair not in beside]
        if not cuts:
            return [symbols]
        return [symbols[a:b] for a, b in zip([0, *cuts], [*cuts, len(symbols)])]

    def merge(self, symbols: list[int]) -> list[int]:
        """Merge the pair of lowest rank, the leftmost first, until no pair has a rank."""
        if len(symbols) > 48:
            return self._merge_long(symbols)
        get, made, none = self.ranks.get, self.made, sys.maxsize
        part = list(symbols)
        found = [get(a << 16 | b, none) for a, b in zip(part, part[1:])]
        while found and (best := min(found)) != none:
            i = found.index(best)
            part[i : i + 2] = [made[part[i] << 16 | part[i + 1]]]
            del found[i]
            if i < len(found):
                found[i] = get(part[i] << 16 | part[i + 1], none)
            if i:
                found[i - 1] = get(part[i - 1] << 16 | part[i], none)
        return part

    def _merge_long(self, symbols: list[int]) -> list[int]:
        """The same in n log n steps: a heap of pairs over a linked list."""
        ranks, made, part = self.ranks, self.made, list(symbols)
        after, before = list(range(1, len(part) + 1)), list(range(-1, len(part) - 1))
        heap: list[tuple[int, int, int]] = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j < len(part) and (rank := ranks.get(pair := part[i] << 16 | part[j])) is not None:
                heapq.heappush(heap, (rank, i, pair))

        for i in range(len(part) - 1):
            offer(i, i + 1)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i]
            if part[i] < 0 or j >= len(part) or part[i] << 16 | part[j] != pair:
                continue
            part[i], part[j] = made[pair], -1
            after[i] = after[j]
            if after[i] < len(part):
                before[after[i]] = i
            offer(before[i], i)
            offer(i, after[i])
        return [p for p in part if p >= 0]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _byte_characters() -> list[str]:
    """The character that stands for each byte: itself if it is printable, else one from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


BYTES = _byte_characters()


def _class(kind: str) -> str:
    return "".join(chr(c) for c in range(128, 0x180) if unicodedata.category(chr(c))[0] == kind)


#: Characters whose case, kind and normal form all Unicode versions agree on, in either case: up to U+017F, and punctuation.
PLAIN = re.compile("[\x00-\u017f\u2010-\u2027\u2030-\u205e]*")
_L, _N = "A-Za-z" + _class("L"), "0-9" + _class("N")
_SPACE = "\t-\r \x85\xa0"
#: Contractions, runs of letters, single digits, runs of anything else but white space.
WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^{_SPACE}{_L}{_N}]+")


class Encoder:
    """Whole texts to ids and back, with the words and fragments seen so far remembered."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        self.path, self.v, self.remembered = path, vocabulary(path), remembered
        self.fragment: dict[tuple, list[int]] = {}
        self.special = {token: (str(i), token, i.to_bytes(2, "big")) for token, i in self.v.special.items()}
        self.word, self.older = dict(self.special), {}
        self.library = None
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(self.v.special, key=len, reverse=True))) + ")").split

    def words(self, text: str) -> list[str]:
        """The words of a text; a special token in it is a word of its own."""
        if "<|" in text and len(parts := self.split(text)) > 1:
            return [w for k, part in enumerate(parts) for w in ([part] if k % 2 else self._words(part))]
        return self._words(text)

    def _words(self, text: str) -> list[str]:
        if PLAIN.fullmatch(text):
            return WORDS.findall(text.lower())
        if self.library is None:  # the library's own character tables, for the rest of Unicode
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path)
        normal = self.library.normalizer.normalize_str(text)
        kinds = self.library.pre_tokenizer.pre_tokenize_str(normal)
        return [_Mapped(w) for w, _ in kinds]

    def ids_of(self, word: str) -> list[int]:
        """The ids of one word, which is not a special token."""
        if isinstance(word, _Mapped) or word.isascii() and word.isprintable():
            mapped = str(word)
        else:
            mapped = "".join([BYTES[b] for b in word.encode()])
        out: list[int] = []
        for symbols in self.v.fragments(self.v.symbols(mapped)):
            key = tuple(symbols)
            if (found := self.fragment.get(key)) is None:
                if len(self.fragment) >= self.remembered:
                    self.fragment.clear()
                found = self.v.merge(symbols)
                if len(key) < 100:
                    self.fragment[key] = found
            out += found
        return out

    def _encode(self, word: str) -> tuple[str, str, bytes]:
        """The ids of a word and its tokens, joined by spaces; the ids as two bytes each, high byte first."""
        out = self.ids_of(word)
        return " ".join(map(str, out)), self.decode(out), b"".join([i.to_bytes(2, "big") for i in out])

    def look_up(self, words: list[str]) -> list[tuple[str, str, bytes]]:
        if len(self.word) > REMEMBERED:  # words not seen since the last time are forgotten
            self.word, self.older = dict(self.special), self.word
        known = self.word
        found = [known.get(w) for w in words]
        if None in found:
            for i, entry in enumerate(found):
                if entry is None and (entry := known.get(w := words[i])) is None:
                    entry = self.older.get(w) or self._encode(w)
                    if len(w) < 100:
                        known[w] = entry
                found[i] = entry
        return found

    def encode(self, text: str | None) -> list[int]:
        """The ids of a text."""
        return [int(i) for ids, _, _ in self.look_up(self.words(text or "")) for i in ids.split()]

    def decode(self, ids: list[int]) -> str:
        """The tokens of the ids, joined by spaces: this vocabulary has no other decoder."""
        return " ".join([self.v.tokens[i] for i in ids])


@lru_cache(maxsize=2)
def encoder_of(path: str) -> Encoder:
    """One for each Python worker, which Spark uses for many tasks."""
    return Encoder(path)


class _Mapped(str):
    """A word whose bytes are already written as characters; differs from the same plain word."""

    __slots__ = ()

    def __hash__(self) -> int:
        return hash(("mapped", str(self)))

    def __eq__(self, other: object) -> bool:
        return isinstance(other, _Mapped) and str.__eq__(self, other)


def _digests(path: str, with_ids: bool = False):
    def work():
        encoder = encoder_of(path)

        def run(texts: list) -> dict:
            out: dict = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": [], "ids": []}
            for text in texts:
                found = encoder.look_up(encoder.words(text or ""))
                ids, decoded = map(" ".join, list(zip(*found))[:2]) if found else ("", "")
                if with_ids:
                    out["ids"].append(ids)
                out["n_tokens"].append(ids.count(" ") + 1 if found else 0)
                out["ids_sha256"].append(hashlib.sha256(ids.encode()).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(decoded.encode()).hexdigest())
            return out

        return run

    return work


def encode(df: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns and ``ids``, the ids of the whole text joined by one space.

    A null text counts as empty; an empty text has no ids.
    """

    def work():
        encoder = encoder_of(path)
        return lambda texts: {"ids": [" ".join([f[0] for f in encoder.look_up(encoder.words(t or ""))]) for t in texts]}

    return per_text(df, text, keep, {"ids": StringType()}, work)


def decode(df: DataFrame, path: str, ids: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns and ``decoded``, the text of the ids. Null or empty ids give an empty text."""

    def work():
        encoder = encoder_of(path)
        return lambda rows: {"decoded": [encoder.decode([int(i) for i in (r or "").split()]) for r in rows]}

    return per_text(df, ids, keep, {"decoded": StringType()}, work)


def digests(df: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), with_ids: bool = False) -> DataFrame:
    """The kept columns, ``n_tokens``, and the SHA-256 of the ids and of the text decoded from them.

    ``with_ids`` adds ``ids``, as ``encode`` returns them. Ids are joined by one space, in decimals. Null counts as empty. One row for each row of ``df``;
    repeated rows repeat, an empty table gives none, other columns are not read.
    """
    fields = {"n_tokens": LongType(), "ids_sha256": StringType(), "decoded_sha256": StringType()}
    if with_ids:
        fields["ids"] = StringType()
    return per_text(df, text, keep, fields, _digests(path, with_ids))
