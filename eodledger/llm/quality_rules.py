"""Weak supervision of text quality: rules vote or abstain, and expectation maximisation weighs them.

Everything is a DataFrame expression. The texts are read once: each row keeps its counts and votes,
which are written to the shared folder. Votes form patterns, at most three to the power of the
number of rules, so expectation maximisation runs over counted patterns in one expression of one
row, whatever the number of documents; the posterior of a pattern goes back to its rows by a join.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eodledger.llm.common import BLANKS, fresh, identity, let
from eodledger.session import stored

SPLIT = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
#: Length of the windows whose repetition counts.
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30

#: First shares: of good documents; of those that a rule calls bad, among good and among bad ones; and
#: of those that it calls good. What a rule finds wrong weighs more than what it does not find.
FIRST_GOOD = 0.8
FIRST_BAD_VOTES, FIRST_GOOD_VOTES = (0.03, 0.3), (0.9, 0.7)
#: Least weights of a vote: a rule is never taken to mean the opposite of what it says.
LEAST_BAD, LEAST_GOOD = 0.4, 0.0
#: Pseudo-documents behind the first shares, and the range of fitted ones.
PRIOR, LOW, HIGH = 10.0, 0.001, 0.999
ROUNDS = 40


@dataclass(frozen=True)
class Rule:
    """Votes bad or good where the condition holds, and abstains elsewhere; bad comes first."""

    name: str
    bad: str
    good: str


#: Thresholds of the rules, over the counts of ``measured``. Whole-number tests on both sides.
RULES = (
    Rule("symbols", "10 * n_symbols > n_words", "50 * n_symbols <= n_words"),
    Rule("marks", "5 * n_marks > n_words", "50 * n_marks <= n_words"),
    Rule("signs", "6 * n_signs > word_chars", "20 * n_signs <= word_chars"),
    Rule("lines", "10 * n_dup_lines > 3 * n_lines", "n_lines >= 4 and n_dup_lines = 0"),
    Rule("repeats", "100 * n_repeat_words > 30 * n_words", "n_words >= 40 and 100 * n_repeat_words <= 2 * n_words"),
    Rule("length of words", "word_chars < 2 * n_words or word_chars > 12 * n_words", "word_chars >= 3 * n_words and word_chars <= 9 * n_words"),
    Rule("capitals", "3 * n_upper > word_chars", "8 * n_upper <= word_chars"),
    Rule("shouting", "10 * n_shouts > n_words", "50 * n_shouts <= n_words"),
    Rule("sentences", "n_words >= 60 and 60 * n_ends < n_words", "2 * n_ends <= n_words and 40 * n_ends >= n_words"),
    Rule("variety", "n_words >= 40 and n_words <= 2000 and 5 * n_distinct < n_words", "n_words <= 2000 and 3 * n_distinct >= n_words"),
)


def _repeat_words(words: Column, size: Column) -> Column:
    """Words covered by windows that occur twice or more, from the words and their number.

    Windows are told apart by their 64-bit hash. A text whose windows all differ, the usual case,
    ends there; else the hashes are sorted with their places, and the covered stretches summed.
    """
    hashes = F.transform(F.sequence(F.lit(1), size - WINDOW + 1), lambda i: F.xxhash64(F.slice(words, i, F.lit(WINDOW))))

    def places(h: Column) -> Column:
        order = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return let(
            order,
            lambda s: F.sort_array(
                F.transform(
                    F.filter(
                        F.sequence(F.lit(0), F.size(s) - 1),
                        lambda j: let(
                            F.get(s, j)["h"],
                            lambda x: F.coalesce(x == F.get(s, j - 1)["h"], F.lit(False))
                            | F.coalesce(x == F.get(s, j + 1)["h"], F.lit(False)),
                        ),
                    ),
                    lambda j: F.get(s, j)["i"],
                )
            ),
        )

    def covered(p: Column) -> Column:
        return F.aggregate(
            F.sequence(F.lit(0), F.size(p) - 1),
            F.lit(0),
            lambda total, j: total + F.least(F.lit(WINDOW), F.coalesce(F.get(p, j + 1) - F.get(p, j), F.lit(WINDOW))),
        )

    return F.when(size < WINDOW, 0).otherwise(
        let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(let(places(h), covered)))
    )


def measured(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with the struct column ``name`` of the counts that the rules look at."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    without = lambda pattern: F.length(F.regexp_replace(t, pattern, "")).cast("long")
    trimmed = F.btrim(t, F.lit(BLANKS))

    def of(words: Column) -> Column:
        return let(
            F.filter(F.split(t, "\n"), lambda line: line.rlike(WORD)),
            lambda lines: F.struct(
                F.size(words).cast("long").alias("n_words"),
                without(SPLIT).alias("word_chars"),
                without(r"[^#*$%&|<>]+").alias("n_symbols"),
                (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
                _repeat_words(words, F.size(words)).cast("long").alias("n_repeat_words"),
                F.size(lines).cast("long").alias("n_lines"),
                without("[^A-Z]+").alias("n_upper"),
                F.regexp_count(t, F.lit(r"!!(?![^\x20\x09-\x0D])")).cast("long").alias("n_shouts"),
                F.regexp_count(t, F.lit(r"[.!?:。](?![^\x20\x09-\x0D])")).cast("long").alias("n_ends"),
                F.regexp_count(t, F.lit(r"[#*$%&|<>!]+")).cast("long").alias("n_marks"),
                without(r"[\p{L}\p{N}\x20\x09-\x0D]+").alias("n_signs"),
                F.size(F.array_distinct(words)).cast("long").alias("n_distinct"),
            ),
        )

    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPLIT))
    return df.withColumn(name, let(words, of))


def base_failed(c: str = "m") -> Column:
    return F.expr(f"{c}.n_words < {LEAST_WORDS} or 100 * {c}.n_repeat_words > {MOST_REPEATED} * {c}.n_words")


def votes(c: str) -> Column:
    """The votes of the rules in their order, a letter each: b, g, or - for abstaining."""
    fields = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_shouts", "n_ends", "n_marks", "n_signs", "n_distinct")

    def over(condition: str) -> Column:
        return F.expr(reduce(lambda s, f: s.replace(f" {f} ", f" {c}.{f} "), fields, f" {condition} "))

    return F.concat(*[F.when(over(r.bad), "b").when(over(r.good), "g").otherwise("-") for r in RULES])


def posteriors(rows: DataFrame, pattern: str) -> DataFrame:
    """``pattern`` and ``p_good`` for each pattern of votes in ``rows``.

    Each rule calls a share of the good documents bad and another of the bad ones, and the same for
    good; the share of right votes is its accuracy, and the ratios weigh its votes. Abstaining
    tells nothing. The shares and that of good documents are fitted by expectation maximisation
    over the counted patterns, from the same start at every size.
    """
    k = len(RULES)
    counts = rows.groupBy(pattern).agg(F.count("*").cast("double").alias("n"))
    vote = lambda p, j: F.substring(p, j, 1)
    one = counts.agg(
        F.sort_array(
            F.collect_list(
                F.struct(
                    F.col(pattern).alias("p"),
                    "n",
                    F.array(*[F.when(vote(F.col(pattern), j + 1) == "g", 1).when(vote(F.col(pattern), j + 1) == "b", -1).otherwise(0) for j in range(k)]).alias("v"),
                )
            )
        ).alias("seen")
    )
    rules = F.sequence(F.lit(0), F.lit(k - 1))

    def good(model: Column, v: Column) -> Column:
        """Posterior of a vector of votes: log odds, summed."""
        ratio = lambda up, down, j: F.log(F.get(model[up], j) / F.get(model[down], j))
        odds = F.aggregate(
            rules,
            F.log(model["good"] / (1 - model["good"])),
            lambda s, j: s
            + F.when(F.get(v, j) > 0, F.greatest(F.lit(LEAST_GOOD), ratio("gg", "bg", j)))
            .when(F.get(v, j) < 0, -F.greatest(F.lit(LEAST_BAD), ratio("bb", "gb", j)))
            .otherwise(F.lit(0.0)),
        )
        return 1 / (1 + F.exp(-odds))

    def within(share: Column) -> Column:
        return F.least(F.lit(HIGH), F.greatest(F.lit(LOW), share))

    def step(seen: Column, model: Column) -> Column:
        weighed = F.transform(
            seen,
            lambda r: let(
                good(model, r["v"]), lambda w: F.struct(r["v"].alias("v"), (r["n"] * w).alias("g"), (r["n"] * (1 - w)).alias("b"))
            ),
        )
        total = lambda rows, of: F.aggregate(rows, F.lit(0.0), lambda s, r: s + r[of])

        def shares(rows: Column, of: str, sign: int, first: float) -> Column:
            """For each rule the share of the good (g) or bad (b) documents that it gives such a vote."""
            return let(
                total(rows, of),
                lambda n: F.transform(
                    rules,
                    lambda j: within(
                        (F.aggregate(rows, F.lit(PRIOR * first), lambda s, r: s + F.when(F.get(r["v"], j) == sign, r[of]).otherwise(F.lit(0.0)))) / (n + PRIOR)
                    ),
                ),
            )

        return let(
            weighed,
            lambda rows: F.struct(
                within((total(rows, "g") + PRIOR * FIRST_GOOD) / (total(rows, "g") + total(rows, "b") + PRIOR)).alias("good"),
                shares(rows, "g", -1, FIRST_BAD_VOTES[0]).alias("gb"),
                shares(rows, "b", -1, FIRST_BAD_VOTES[1]).alias("bb"),
                shares(rows, "g", 1, FIRST_GOOD_VOTES[0]).alias("gg"),
                shares(rows, "b", 1, FIRST_GOOD_VOTES[1]).alias("bg"),
            ),
        )

    same = lambda x: F.array(*[F.lit(x)] * k)
    first = F.struct(
        F.lit(FIRST_GOOD).alias("good"),
        same(FIRST_BAD_VOTES[0]).alias("gb"),
        same(FIRST_BAD_VOTES[1]).alias("bb"),
        same(FIRST_GOOD_VOTES[0]).alias("gg"),
        same(FIRST_GOOD_VOTES[1]).alias("bg"),
    )
    fitted = one.withColumn("model", F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), first, lambda model, _: step(F.col("seen"), model)))
    return fitted.select(
        F.explode(F.transform("seen", lambda r: F.struct(r["p"].alias(pattern), good(F.col("model"), r["v"]).alias("p_good")))).alias("r")
    ).select("r.*")


def _judged(df: DataFrame, m: str, pattern: str, chance: str) -> DataFrame:
    """The stored rows with counts, votes and the posterior."""
    rows = stored(df.withColumn(pattern, votes(m)), "votes")
    found = posteriors(rows, pattern).withColumnRenamed("p_good", chance)
    # At most 3 ** len(RULES) patterns, so the broadcast has a bound of its own.
    return rows.join(F.broadcast(found), pattern)


def judge(df: DataFrame, key: str = "doc_id", text: str = "text", least: float = 0.5) -> DataFrame:
    """``doc_id``, the counts, ``base_failed``, ``votes`` and ``kept`` for every row.

    ``kept`` is false where the base rules fail, else whether the posterior chance of good quality
    is at least ``least``. A null text has no words and fails. Repeated rows repeat and count as
    often as they occur; an empty table gives no rows; other columns are not read.
    """
    source = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    rows = _judged(measured(source, "text", "m").drop("text"), "m", "votes", "p_good")
    return rows.select(
        F.col("key").alias(key),
        *[F.col(f"m.{c}") for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        base_failed("m").alias("base_failed"),
        (~base_failed("m") & (F.col("p_good") >= least)).alias("kept"),
        "votes",
    )


def keep_good(df: DataFrame, text: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of ``df`` that ``judge`` keeps, with the columns of ``df``.

    The verdict depends on the text alone. Counts are written once to the shared folder, without the
    texts; the texts that stay are then found by their hashes. A null text has no words and goes;
    repeated rows stay or go together; an empty table gives no rows.
    """
    a, b = identity(F.col("text"))
    texts = df.select(F.col(text).alias("text"))
    rows = _judged(measured(texts, "text", "m").select(a.alias("a"), b.alias("b"), "m"), "m", "votes", "p_good")
    # Stored, so that the join below can split the rows of a text that a third of them repeat.
    good = stored(rows.filter(~base_failed("m") & (F.col("p_good") >= least)).select("a", "b").distinct(), "good")
    a, b = fresh(df, "__a"), fresh(df, "__b")
    named = df.withColumns(dict(zip((a, b), identity(F.col(text)))))
    return named.join(good.withColumnsRenamed({"a": a, "b": b}), [a, b], "left_semi").select(*df.columns)
