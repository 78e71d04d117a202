"""Personal data in texts: fixed formats, and candidates that boosted trees select."""

from __future__ import annotations

import random
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType

from eodledger.llm.boosting import Boosted, sigmoid, temperature
from eodledger.llm.common import per_text
from eodledger.llm.spans import Span, Taken, digest, written

KINDS = ("email", "ip", "card", "phone", "other")

# Fixed formats. A number begins where its digits do, which spares trying the rest of a long run.
EMAIL_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")

#: Candidates: anything with a sign for "at", runs of digits with separators, account-like codes.
CANDIDATES = (
    re.compile(r"[A-Za-z0-9._%+-]{1,64}\x20?(?:@|\(at\)|\[at\]|\x20at\x20)\x20?[A-Za-z0-9-]{1,63}(?:(?:\.|\x20dot\x20|\(dot\)|\[dot\])[A-Za-z0-9-]{1,63}){1,4}"),
    re.compile(r"(?<![A-Za-z0-9])[+(]{0,2}[0-9](?:[\x20().:/_-]{0,2}[0-9]){5,22}(?![A-Za-z0-9])"),
    re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
)
CUES = re.compile(r"(?i)(?:phone|tel|fax|mobile|call|e-?mail|contact|card|visa|iban|account|ssn|social|passport|address|\bip\b)")
#: Forms that are made up for the fit because no fixed format knows them, and a word that may stand before them.
FORMS = {"iban": "IBAN ", "ssn": "SSN ", "national": "call ", "mail": "contact "}
#: Country and digits after the check digits of some account codes; fixed values.
IBAN_LENGTHS = (("DE", 18), ("AT", 16), ("NL", 14), ("FR", 23), ("ES", 20), ("GB", 18), ("CH", 17), ("IT", 23))
#: Characters before and after a candidate that count as its context.
AROUND = 24
#: Characters of the longest texts that the selector is fitted on.
LONGEST = 20_000


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d)
        if i % 2:
            n = n * 2 - 9 * (n > 4)
        total += n
    return total % 10 == 0


def _emails(text: str) -> list[Span]:
    """Leftmost matches: each begins at the first character of the run before its sign, or behind the last match."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and EMAIL_LOCAL.fullmatch(text, start - 1, start):
            start -= 1
        if start < at and (m := EMAIL.match(text, start)):
            out.append(("email", m.start(), m.end()))
            done = m.end()
        else:
            done = at
        at = text.find("@", max(at + 1, done))
    return out


def base_spans(text: str) -> list[Span]:
    """The fixed formats, by kind, leftmost and non-overlapping within a kind."""
    out = _emails(text)
    if not DIGIT.search(text):
        return out
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = re.sub("[^0-9]", "", m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(DIGIT.findall(m[0])) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


def candidates(text: str) -> list[tuple[int, int]]:
    """Overlapping places that may be personal data."""
    if not DIGIT.search(text) and "@" not in text and "at" not in text:
        return []
    return sorted({(m.start(), m.end()) for p in CANDIDATES for m in p.finditer(text)})


def features(text: str, start: int, end: int) -> list[float]:
    """Format of a candidate, and what stands around it."""
    s, before, after = text[start:end], text[max(0, start - AROUND) : start], text[end : end + AROUND]
    digits = "".join(DIGIT.findall(s))
    groups = re.findall("[0-9]+", s)
    seps = re.findall("[^0-9A-Za-z]", s)
    return [
        len(s),
        len(digits),
        len(groups),
        max(map(len, groups), default=0),
        min(map(len, groups), default=0),
        len(groups[0]) if groups else 0,
        len(groups[-1]) if groups else 0,
        len(re.findall("[A-Za-z]", s)),
        s.count("."),
        s.count("-"),
        s.count(" "),
        s.count("(") + s.count(")"),
        s.count("/") + s.count(":"),
        s.startswith("+"),
        s.startswith("0"),
        "@" in s or "at" in s,
        bool(re.search(r"(\.|dot.?)[A-Za-z]{2,6}$", s)),
        len(set(seps)),
        bool(groups) and all(len(g) <= 3 and int(g) <= 255 for g in groups),
        bool(digits) and luhn(digits),
        bool(re.match("(19|20)[0-9]{2}", digits)),
        len(set(digits)),
        "(at)" in s or "[at]" in s,
        "dot" in s,
        s[-2:].islower(),
        len(re.findall("[._%+-]|[0-9]", s.partition(" ")[0])),
        bool(re.match("[A-Z]{2}[0-9]{2}", s)) and mod97(re.sub("[^0-9A-Z]", "", s)) == 1,
        bool(CUES.search(before)),
        len(DIGIT.findall(before)),
        len(DIGIT.findall(after)),
        before[-1:] in ('"', "'", "=", "_", "#", "$"),
        before[-1:].isspace() or not before,
        after[:1].isspace() or after[:1] in (".", ",", ";") or not after,
    ]


def altered(s: str, kind: str, rng: random.Random) -> str:
    """The same datum in a format that the fixed patterns do not know."""
    if kind == "email":
        name, _, host = s.partition("@")
        return f"{name}{rng.choice((' at ', ' (at) ', '[at]'))}{host}".replace(" (at) ", "(at)")
    if kind == "phone":
        return s.lstrip("+").replace(" ", rng.choice((" ", "-", ".")))
    if kind == "card":
        return rng.choice((".", "/", "-", " ")).join(re.findall("[0-9]{1,4}", re.sub("[^0-9]", "", s)))
    return s


def personal(kind: str, words: list[str], rng: random.Random) -> str:
    """A made-up datum of a form that the fixed patterns do not know; names come from the text's words."""
    n = rng.randrange
    if kind == "iban":
        country, account = rng.choice(IBAN_LENGTHS)
        body = "".join(rng.choice("0123456789") for _ in range(account))
        if rng.random() < 0.3:
            body = "".join(rng.choice("ABCDEFGHKLMNPRSTUVWX") for _ in range(4)) + body[4:]
        whole = f"{country}{98 - mod97(f'{country}00{body}'):02}{body}"
        return " ".join(re.findall(".{1,4}", whole)) if rng.random() < 0.5 else whole
    if kind == "ssn":
        return f"{rng.choice((n(1, 666), n(667, 900))):03}-{n(1, 100):02}-{n(1, 10000):04}"
    if kind == "national":
        area, office, line = n(200, 1000), n(200, 1000), n(10000)
        return rng.choice((f"({area}) {office}-{line:04}", f"{area}-{office}-{line:04}", f"{area}.{office}.{line:04}", f"0{n(20, 1000)} {n(10**6, 10**8)}"))
    name = rng.choice(("{0}.{1}", "{0}{2}", "{0}_{1}", "{0}-{1}", "{0}")).format(rng.choice(words), rng.choice(words), n(10, 2000))
    sign, dot = rng.choice(((" (at) ", "."), ("(at)", "."), ("[at]", "."), (" [at] ", " dot "), (" at ", " dot "), ("(at)", "(dot)"), (" at ", ".")))
    return f"{name}{sign}{rng.choice(words)}{dot}{rng.choice(('com', 'org', 'net', 'de', 'io', 'edu'))}"


def mod97(code: str) -> int:
    """An account code's remainder: its first four characters behind the others, letters as 10 to 35."""
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97


def plain(words: list[str], rng: random.Random) -> str:
    """What looks alike and identifies nobody: dates, times, amounts, versions, ranges, codes, prose with "at"."""
    n = rng.randrange
    long = str(n(10**12, 10**19))
    if luhn(long):  # one more in the last digit, and the check digit is wrong
        long = f"{long[:-1]}{(int(long[-1]) + 1) % 10}"
    return rng.choice(
        (
            long,
            " ".join(re.findall(".{1,4}", long)),
            f"{n(1900, 2031)}-{n(1, 13):02}-{n(1, 29):02}",
            f"{n(1900, 2031)}-{n(1, 13):02}-{n(1, 29):02} {n(24):02}:{n(60):02}:{n(60):02}",
            f"{n(1, 29):02}.{n(1, 13):02}.{n(1900, 2031)}",
            f"{n(1, 13)}/{n(1, 29)}/{n(1900, 2031)} {n(24):02}:{n(60):02}",
            f"{n(1900, 2031)}-{n(1900, 2031)}",
            f"{n(1, 100)}.{n(1000):03}.{n(1000):03}",
            f"{n(1, 30)}.{n(30)}.{n(1000)}-{n(1000)}",
            f"{n(10**6, 10**9)}",
            f"{n(10**9, 10**13)}",
            f"{n(100)}.{n(10**6, 10**8)}",
            f"{n(1, 1000)} {n(1000):03} {n(1000):03}",
            f"{n(10, 100)}/{n(1000, 10000)}/{n(100)}",
            "".join(rng.choice("ABCDEFGHJKMNPQRSTUVWXYZ") for _ in range(2)) + f"{n(10**9, 10**14)}",
            f"{rng.choice(words)} at {rng.choice(words)}.{rng.choice(words).capitalize()}",
            f"{rng.choice(words)} at {rng.choice(words)}.{rng.choice(words)}",
        )
    )


def training_rows(texts: list[str], most: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of candidates, from some texts and from what is put into them.

    Personal are candidates that a fixed format covers, the same datum written in another way in its
    place, and made-up data of every form in ``FORMS`` put between words. Not personal are made-up
    look-alikes put into the same places. Any other candidate of a text is unlabelled, since it may
    be what the fixed formats miss, and is no example of either kind.
    """
    rng, x, y = random.Random(seed), [], []

    def put(text: str, start: int, end: int, cue: str, new: str, label: int) -> None:
        """Examples from the text around a place, after the new datum has taken it."""
        before, after = text[max(0, start - 99) : start] + cue, text[end : end + 99]
        whole, at = before + new + after, len(before)
        for a, b in candidates(whole):
            if min(b, at + len(new)) - max(a, at) >= 0.7 * max(b - a, len(new) if label else 1):
                x.append(features(whole, a, b))
                y.append(label)

    for text in texts:
        if len(x) >= most:
            break
        base = base_spans(text)
        for start, end in candidates(text):
            hit = max((min(end, e) - max(start, s) for _, s, e in base), default=0)
            if hit * 10 >= (end - start) * 7:
                x.append(features(text, start, end))
                y.append(1)
        words = [w.lower() for w in re.findall("[A-Za-z]{2,12}", text[:4000])] or ["name", "host"]
        for kind, start, end in base:
            put(text, start, end, rng.choice(("", "", "tel ", "mail ", "card ")), altered(text[start:end], kind, rng), 1)
            put(text, start, end, "", plain(words, rng), 0)
        gaps = [m.end() for m in re.finditer(" ", text)] or [len(text)]
        for form in FORMS:
            at = rng.choice(gaps)
            put(text, at, at, rng.choice(("", FORMS[form])), f"{personal(form, words, rng)} ", 1)
            at = rng.choice(gaps)
            put(text, at, at, "", f"{plain(words, rng)} ", 0)
            put(text, at, at, "", f"{plain(words, rng)} ", 0)
    return np.array(x, float).reshape(len(x), len(x[0]) if x else 0), np.array(y, float)


@dataclass
class Selector:
    """Boosted trees with a temperature, and the probability from which a candidate is redacted."""

    trees: Boosted | None
    heat: float = 1.0
    threshold: float = 1.0

    def probability(self, rows: list[list[float]]) -> np.ndarray:
        if self.trees is None or not rows:
            return np.zeros(len(rows))
        return sigmoid(self.trees.margin(np.array(rows, float)) / self.heat)


def fit(texts: list[str], most: int, precision: float = 0.98, seed: int = 7) -> Selector:
    """Trees from three quarters of the rows; temperature and threshold from the rest.

    The threshold is the lowest, 0.5 at least, from which the wanted share of selected rows is
    personal. With too few rows of either kind nothing is selected.
    """
    x, y = training_rows(texts, most, seed)
    if min(y.sum(), (1 - y).sum()) < 8:
        return Selector(None)
    held = np.random.default_rng(seed).random(len(y)) < 0.25
    trees = Boosted().fit(x[~held], y[~held])
    margin = trees.margin(x[held])
    heat = temperature(margin, y[held])
    p, t = sigmoid(margin / heat), y[held]
    fine = [c for c in np.linspace(0.5, 0.99, 50) if (p >= c).any() and t[p >= c].mean() >= precision]
    return Selector(trees, heat, fine[0] if fine else 0.995)


def find(text: str, selector: Selector) -> tuple[list[Span], list[Span]]:
    """Base spans and all spans of a whole text, by kind and start."""
    base = base_spans(text)
    base.sort(key=lambda s: (KINDS.index(s[0]), s[1]))
    taken, added = Taken((s, e) for _, s, e in base), Taken()
    places = [(a, b) for a, b in candidates(text) if taken.apart(a, b)]
    chances = selector.probability([features(text, a, b) for a, b in places])
    extra: list[Span] = []
    for p, (a, b) in sorted(zip(chances.tolist(), places), key=lambda c: (-c[0], c[1])):
        if p >= selector.threshold and added.apart(a, b):
            added.add(a, b)
            extra.append(("other", a, b))
    return base, base + sorted(extra, key=lambda s: s[1])


def sample_texts(df: DataFrame, key: str, text: str, most: int, longest: int = LONGEST) -> list[str]:
    """The ``most`` texts with a digit or an at sign whose rows have the smallest hashes; equal rows count once.

    Texts of more than ``longest`` characters are left out, so that what is sent to the driver is bounded.

    Only hashes below a bound are ordered. The bound follows from the number of different rows and
    lets about twice as many through as are wanted, so that what tasks hand on does not grow with
    their number.
    """
    rows = df.select(F.xxhash64(key, text).alias("h"), F.col(text).alias("t")).filter(
        F.col("t").rlike("[0-9@]") & (F.length("t") <= longest)
    )
    there = rows.agg(F.approx_count_distinct("h")).first()[0]
    share = min(1.0, 2 * most / max(there, 1))
    bound = min((1 << 63) - 1, int(share * (1 << 64)) - (1 << 63))
    chosen = rows.filter(F.col("h") <= F.lit(bound)).groupBy("h").agg(F.min("t").alias("t"))
    return [r["t"] for r in chosen.orderBy("h").limit(most).collect()]


def scan(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    sample: int = 2000,
    most: int = 20_000,
    precision: float = 0.98,
    longest: int = LONGEST,
) -> DataFrame:
    """The key, counts of the base kinds, the digest of the base spans, and all spans.

    The selector is fitted on the candidates of at most ``sample`` texts (of up to ``longest``
    characters) and ``most`` rows; every whole text is then searched. A null text counts as empty;
    a text without spans has zero counts, the digest of nothing and empty ``spans``. One row for
    each row of ``df``; repeated rows repeat; with an empty table nothing is fitted and no row
    returned; other columns are not read.
    """
    selector = fit(sample_texts(df, key, text, sample, longest), most, precision)
    counts = {f"n_{k}": LongType() for k in KINDS}
    fields = counts | {"base_sha256": StringType(), "spans": StringType()}

    def work():
        def run(texts: list) -> dict:
            out: dict = {k: [] for k in fields}
            for t in texts:
                base, spans = find(t or "", selector)
                for k in KINDS:
                    out[f"n_{k}"].append(sum(s[0] == k for s in spans))
                out["base_sha256"].append(digest(base))
                out["spans"].append(written(spans))
            return out

        return run

    return per_text(df, text, (key,), fields, work)
