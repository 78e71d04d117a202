"""Joins with particular matching rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eodledger.functions.texts import like_ignore_case

GRAM = 3
#: Days that a bin of a validity join holds.
BIN_DAYS = 8
#: Rows that a pivot makes at most from one row of pieces.
PIECE_ROWS = 1 << 17


def cast_key_join(
    left: DataFrame, right: DataFrame, pairs: Mapping[str, str], how: str = "left"
) -> DataFrame:
    """Equi join comparing both sides as text, for ids stored as number here, string there."""
    on = [left[a].cast("string") == right[b].cast("string") for a, b in pairs.items()]
    return left.join(right, on, how)


def not_in(
    probe: DataFrame,
    probe_key: Column,
    listed: DataFrame,
    listed_key: Column,
) -> DataFrame:
    """SQL ``NOT IN (subquery)`` with its NULL rules, without broadcasting the list.

    A NULL in the list empties the result, and a NULL probe is dropped unless the list
    is empty. Both facts are scalars; the rest is an equi anti join that can be shuffled
    at any size.
    """
    values = listed.select(listed_key.alias("__listed"))
    counted = values.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("__listed").isNull()).alias("n_null")
    )
    is_empty = counted.select(F.col("n") == 0).scalar()
    keyed = probe.withColumn("__probe", probe_key)
    allowed = keyed.where(F.col("__probe").isNotNull() | is_empty)
    allowed = allowed.where(counted.select(F.col("n_null") == 0).scalar())
    return allowed.join(
        values, F.col("__probe") == F.col("__listed"), "left_anti"
    ).drop("__probe")


def first_or_either(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Full outer join of two frames that are unique on ``key``, with one key column."""
    other = right.withColumnRenamed(key, "__other")
    joined = left.join(other, left[key] == F.col("__other"), "full")
    keep = [c for c in joined.columns if c not in (key, "__other")]
    return joined.select(F.coalesce(key, "__other").alias(key), *keep)


def residual_or_join(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, residual: Column
) -> DataFrame:
    """Left join on one equal key plus a looser condition tested per matched pair."""
    return left.join(right, (F.col(left_key) == F.col(right_key)) & residual, "left")


def validity_join(
    facts: DataFrame,
    periods: DataFrame,
    key: str,
    day: str,
    period_key: str,
    first: str,
    last: str,
    how: str = "inner",
    width: int = BIN_DAYS,
) -> DataFrame:
    """Equal key and day within [first, last], both ends included.

    Days are put into bins of ``width`` days and a period into every bin it touches, between the first
    and the last day of any fact. The join is on key and bin, so the facts of few keys, or of one key
    with many rows, are spread over as many tasks as there are bins; the ends are tested on the pairs
    that meet. Periods without an end, or that end before they start, match nothing.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"validity_join cannot preserve the periods: {how}")
    of = lambda column: F.expr(f"unix_date(to_date(`{column}`)) div {width}")
    ends = facts.agg(F.min(of(day)).alias("low"), F.max(of(day)).alias("high"))
    low, high = ends.select("low").scalar(), ends.select("high").scalar()
    from_, to = F.greatest(of(first), low), F.least(of(last), high)
    bins = F.when(from_ <= to, F.sequence(from_, to))
    binned = periods.withColumn("__period_bin", F.explode(bins))
    dealt = facts.withColumn("__bin", of(day))
    on = (
        (dealt[key] == binned[period_key])
        & (dealt["__bin"] == binned["__period_bin"])
        & (dealt[day] >= binned[first])
        & (dealt[day] <= binned[last])
    )
    return dealt.join(binned, on, how).drop("__bin", "__period_bin")


def semi_on(df: DataFrame, listed: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows whose key tuple is listed; the list never multiplies rows."""
    return df.join(listed.select(*names).distinct(), list(names), "left_semi")


def _pieces(text: Column, n: int) -> Column:
    """All n-character pieces of a text, as tokens, in one pass over it."""
    cut = F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1))
    return F.transform(cut, lambda piece: F.concat(F.lit("g:"), piece))


def _text_tokens(text: Column) -> Column:
    """All tokens of a text: its pieces of up to GRAM characters and its length tests."""
    size = F.length(text)
    at_least = F.transform(F.sequence(F.lit(0), size), lambda n: F.concat(F.lit(">="), n.cast("string")))
    exactly = F.array(F.concat(F.lit("=="), size.cast("string")))
    pieces = [_pieces(text, n) for n in range(1, GRAM + 1)]
    return F.array_distinct(F.concat(*pieces, at_least, exactly))


def _pattern_tokens(pattern: Column) -> Column:
    """Tokens that every text matching the pattern must hold.

    Pieces of its literal runs, as long as possible; a pattern of wildcards only is
    known by the text length it asks for.
    """
    runs = F.filter(F.split(pattern, "[%_]"), lambda run: run != "")
    long_pieces = F.flatten(F.transform(runs, lambda run: _pieces(run, GRAM)))
    short_runs = F.transform(runs, lambda run: F.concat(F.lit("g:"), run))
    least = F.length(F.regexp_replace(pattern, "%", "")).cast("string")
    test = F.when(F.contains(pattern, F.lit("%")), ">=").otherwise("==")
    return (
        F.when(F.size(long_pieces) > 0, F.array_distinct(long_pieces))
        .when(F.size(runs) > 0, F.array_distinct(short_runs))
        .otherwise(F.array(F.concat(test, least)))
    )


def _template_matches(df: DataFrame, text: str, patterns: DataFrame, pattern: str) -> DataFrame:
    """The (text, pattern) matches of the distinct texts, through an equi join on a shared token.

    A pattern is looked up by the one of its tokens that the fewest patterns share, so
    that patterns with a common beginning do not all meet the same texts. Tokens travel
    with a hash of their text instead of the text; every candidate is tested on the text
    itself, so texts with equal hashes only cost a test.
    """
    known = df.select(F.col(text).alias("__text")).where(F.col("__text").isNotNull()).distinct()
    known = known.withColumn("__id", F.xxhash64("__text"))
    tokens = known.select("__id", F.explode(_text_tokens(F.lower("__text"))).alias("__token"))
    offered = (
        patterns.select(F.col(pattern).alias("__pattern"))
        .distinct()
        .withColumn("__token", F.explode(_pattern_tokens(F.lower("__pattern"))))
    )
    shared = offered.groupBy("__token").agg(F.count(F.lit(1)).alias("__sharers"))
    wanted = (
        offered.join(shared, "__token")
        .groupBy("__pattern")
        .agg(F.min_by("__token", F.struct("__sharers", "__token")).alias("__token"))
    )
    candidates = tokens.join(wanted, "__token").select("__id", "__pattern").distinct()
    return (
        known.join(candidates, "__id")
        .where(like_ignore_case(F.col("__text"), F.col("__pattern")))
        .select("__text", "__pattern")
    )


def like_template_join(df: DataFrame, text: str, templates: DataFrame, pattern: str) -> DataFrame:
    """Left join where the right side holds LIKE patterns, ignoring case.

    A text that matches several templates yields one row for each. Each distinct text is
    matched once, by the same plan for any number of templates, and the matches are
    joined back by equality.
    """
    matches = _template_matches(df, text, templates, pattern).join(
        templates, F.col("__pattern") == F.col(pattern), "inner"
    )
    return df.join(matches, F.col(text) == F.col("__text"), "left").drop("__text", "__pattern")


def _cut(values: Column, most: int) -> Column:
    """Pieces of up to ``most`` values of a list, NULL if it is empty."""
    starts = F.sequence(F.lit(0), F.size(values) - 1, F.lit(most))
    return F.when(F.size(values) > 0, F.transform(starts, lambda at: F.slice(values, at + 1, most)))


def rate_pivot(
    df: DataFrame,
    id_column: str,
    group_column: str,
    value: str,
    groups: Mapping[str, object],
    unique: bool = False,
    piece_rows: int = PIECE_ROWS,
) -> DataFrame:
    """One column per group, for the ids that have the first group, in one exchange by id.

    Repeated (id, group) pairs multiply, as if each group were joined to the first: the values of
    each group are collected for an id and their product is laid out. A null id has the first group
    only. With ``unique`` pairs a conditional aggregate is enough.

    The lists are cut first, so that the values of one piece of each multiply to ``piece_rows`` rows
    at most, and these sets of pieces are dealt over all tasks: generated code holds all rows that
    come from one row, so lists that were laid out whole would fill the memory with an id's product.
    A task that is run again must cut the same pieces, so the lists are sorted.
    """
    (base_name, base_code), *others = groups.items()
    wanted = df.where(F.col(group_column).isin(*groups.values()))
    if unique:
        picked = [F.max(F.when(F.col(group_column) == code, F.col(value))).alias(n) for n, code in groups.items()]
        has_base = F.bool_or(F.col(group_column) == base_code).alias("__has_base")
        return wanted.groupBy(id_column).agg(*picked, has_base).where("__has_base").drop("__has_base")
    # In a struct, so that null values are collected too.
    held = F.struct(F.col(value).alias("value"))
    lists = [F.collect_list(F.when(F.col(group_column) == code, held)).alias(n) for n, code in groups.items()]
    rows = wanted.groupBy(id_column).agg(*lists)
    rows = rows.select(id_column, *[F.sort_array(F.col(n)["value"]).alias(n) for n in groups])
    most = max(1, int(piece_rows ** (1 / len(groups))))
    rows = rows.withColumn(base_name, F.explode(_cut(F.col(base_name), most)))
    for name, _ in others:
        joined = F.when(F.col(id_column).isNotNull(), _cut(F.col(name), most))
        rows = rows.withColumn(name, F.explode_outer(joined))
    rows = rows.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    for name in groups:
        rows = rows.withColumn(name, F.explode_outer(name))
    return rows
