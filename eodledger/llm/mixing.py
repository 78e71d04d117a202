"""Mixing sources to target weights by Pfair scheduling.

Each source's documents are dealt into blocks. With weight w (a whole number) of a period W, the
sum of all weights, block k of a source is released at slot floor(k * W / w) and due by slot
ceil((k + 1) * W / w). Each slot goes to the released block that is due first. On one sequence of
slots this meets every deadline, so after any number of slots each source has had its share to
within less than one block. The schedule repeats after W slots, so it is worked out for one period, and
there only for the blocks of sources with weights of their own; everything else is arithmetic on
ranks, of a source among the sources and of a document within its source.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eodledger.llm.common import fresh, let
from eodledger.llm.merkle import numbered

#: Documents of one source that follow each other.
BLOCK = 16
#: Largest sum of the weights that are named. The number of sources without a name is free.
MOST_NAMED = 4096
#: Hexadecimal digits of the key's MD5 that deal the documents of a source to separately ranked parts.
DIGITS = 3
#: Rows of a given order, as a power of two, that are ranked apart from those before them.
BITS = 8


def weight(source: Column, weights: Mapping[str, int], default: int) -> Column:
    """The whole-number weight of a source, which is at least one; null is a source like any other."""
    if min(default, *weights.values(), 1) < 1:
        raise ValueError("weights must be at least 1")
    if sum(weights.values()) > MOST_NAMED:
        raise ValueError(f"named weights must not sum to more than {MOST_NAMED}")
    out = F.lit(default)
    for name, w in weights.items():
        out = F.when(source.eqNullSafe(F.lit(name)), F.lit(w)).otherwise(out)
    return out.cast("long")


def _div(a: Column, b: Column) -> Column:
    """Whole-number division, which is exact for numbers of any length of a long."""
    return F.call_function("div", a, b)


def _up(a: Column, b: Column) -> Column:
    """Whole-number division of a number not below zero, rounded up."""
    return _div(a + b - 1, b)


def schedule(totals: DataFrame, block: int = BLOCK, pooled: int = 1) -> DataFrame:
    """A row for each source of ``totals (source, w, total)`` with its places in a period.

    ``plan`` has the slots of the source's ``w`` blocks of a period of ``period`` slots, by earliest
    deadline first; ties go to the source that sorts first, null before all. ``end`` is the first
    slot that some source cannot fill.

    Sources of weight ``pooled`` may be of any number: their k-th blocks are all released and due
    together, so they take turns in their order and one count says how far they are. Only the blocks
    of the other sources are simulated, one step each, in one row whose size follows from the weights
    that the caller names. Between two such blocks the pool has every slot; when that ends follows
    from arithmetic. The slots that the others leave are the pool's, by rank. Sources are ranked by
    ranges of their order and stay rows of a table.
    """
    order = F.struct(F.col("source").isNotNull(), "source")
    ranked = numbered(totals.select(F.lit(0).alias("all"), order.alias("by"), "source", "w", "total"), "all", ["by"], "g")
    own = F.col("w") != pooled
    one = ranked.groupBy("all").agg(
        F.sort_array(F.collect_list(F.when(own, F.struct("g", "w")))).alias("apart"),
        F.sum("w").alias("period"),
        F.count(F.when(~own, True)).alias("pool"),
        F.coalesce(F.sum(F.when(own, F.col("w"))), F.lit(0)).alias("named"),
    )
    W, m, S, d = F.col("period"), F.col("pool"), F.col("named"), F.lit(pooled).cast("long")
    turn = F.greatest(m, F.lit(1))

    def blocked(state: Column) -> Column:
        """The first slot at which the pool, if it runs from now on, has no released block."""
        k = _up(state["p"], turn)
        at = state["t"] + k * m - state["p"]
        return F.when(m == 0, state["t"]).otherwise(at + m * F.greatest(F.lit(0), _div((at + 1) * d - k * W + S - 1, S)))

    def waiting(state: Column, stop: Column) -> Column:
        """For every source its next block: due, place in the order, release and first slot that the pool leaves to it."""

        def entry(x: Column, i: Column) -> Column:
            n = F.get(state["done"], i)
            release, due = _div(n * W, x["w"]), _up((n + 1) * W, x["w"])
            k = _div((due - 1) * d, W)
            lost = k * m + F.when(_up((k + 1) * W, d) == due, x["g"] - i).otherwise(0)
            at = F.greatest(release, F.least(state["t"] + F.greatest(F.lit(0), lost - state["p"]), stop))
            return F.struct(due.alias("due"), i.alias("i"), release.alias("release"), at.alias("at"))

        return F.transform("apart", entry)

    def step(state: Column, _: Column) -> Column:
        def picked(found: Column) -> Column:
            slot = F.array_min(F.transform(found, lambda b: b["at"]))
            return let(slot, lambda t: F.struct(t.alias("slot"), F.array_min(F.filter(found, lambda b: b["release"] <= t))["i"].alias("i")))

        return let(
            let(let(blocked(state), lambda stop: waiting(state, stop)), picked),
            lambda c: F.struct(
                F.transform(state["done"], lambda n, i: n + F.when(i == c["i"], 1).otherwise(0)).alias("done"),
                (c["slot"] + 1).alias("t"),
                (state["p"] + c["slot"] - state["t"]).alias("p"),
                F.concat(state["out"], F.array(c)).alias("out"),
            ),
        )

    zero = F.lit(0).cast("long")
    first = F.struct(
        F.transform("apart", lambda _: zero).alias("done"),
        zero.alias("t"),
        zero.alias("p"),
        F.array().cast("array<struct<slot:bigint,i:int>>").alias("out"),
    )
    ran = F.aggregate(F.array_repeat(zero, S.cast("int")), first, step)["out"]
    # Bounded by the named weights, whatever the number of sources.
    one = one.withColumn("out", ran).select(
        "all", "period", "pool", "out", F.transform("apart", lambda x: x["g"]).alias("gs"), F.transform("out", lambda o, i: o["slot"] - i).alias("left")
    )
    before = F.size(F.filter("gs", lambda g: g < F.col("g")))
    turns = F.transform(F.sequence(zero, d - 1), lambda k: k * m + F.col("g") - before)
    plan = F.when(
        own, let(before, lambda i: F.transform(F.filter("out", lambda o: o["i"] == i), lambda o: o["slot"]))
    ).otherwise(F.transform(turns, lambda j: j + F.size(F.filter("left", lambda x: x <= j))))
    made = ranked.join(F.broadcast(one), "all").select("all", "source", "w", plan.alias("plan"), "period", "total")
    full = _div(F.col("total"), F.lit(block))
    ends = made.groupBy("all").agg(F.min(_div(full, F.col("w")) * W + F.get("plan", (full % F.col("w")).cast("int"))).alias("end"))
    return made.join(F.broadcast(ends), "all").select("source", "w", "plan", "period", "end")


def positions(
    df: DataFrame,
    weights: Mapping[str, int],
    default: int = 1,
    key: str = "doc_id",
    source: str = "source",
    block: int = BLOCK,
    order: str | None = None,
) -> DataFrame:
    """``df`` with a struct column ``__mix``, the last, (``slot``, ``position``, ``in_mix``) for every row.

    Documents of a source are in the order of the MD5 of their key or, if given, of the column ``order``
    of whole numbers, which differ and have few gaps, as ``numbered_rows`` makes. ``slot`` counts blocks and
    ``position`` documents of an endless schedule; where a source has run out its places stay
    empty, so positions have gaps but no source moves. ``in_mix`` is true before the first slot
    that a source has to leave empty: up to there the mix has its target weights to within less
    than one block of each source. Later rows are the rest, in the same order. No row is dropped.

    A null source is a source of the default weight; a null key counts as the empty text. Rows with
    equal keys get neighbouring ranks, in no fixed order. An empty table gives no rows.

    Ranks come from two levels, parts of a source by the first digits of the MD5 (or all but the last
    bits of ``order``) and rows within a part, so the documents of a frequent source are spread over
    thousands of groups.
    """
    name = lambda c: F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit(""))
    digest = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")))
    names = ("__md5", "__src", "__part", "__mix", "__offset", "__plan", "__in_part", "__rank", "__block", "__slot")
    md5, src, part, mix, offset, plan, in_part, ranked, block_, slot = (fresh(df, c) for c in names)
    by, dealt = (digest, F.substring(digest, 1, DIGITS)) if order is None else (F.col(order), F.shiftright(F.col(order), BITS))
    rows = df.withColumns({md5: by, src: name(F.col(source)), part: dealt})
    sizes = (
        df.select(F.col(source).cast("string").alias("source"), dealt.alias("part"))
        .groupBy("source", "part")
        .agg(F.count("*").alias("n"))
    )
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("source", F.col("part").alias(part), F.coalesce(F.sum("n").over(before), F.lit(0)).alias(offset))
    totals = sizes.groupBy("source").agg(F.sum("n").alias("total"))
    made = schedule(totals.withColumn("w", weight(F.col("source"), weights, default)), block, default)
    made = made.select(name(F.col("source")).alias(src), F.struct("w", "plan", "period", "end").alias(plan))
    # The plan joins the counts of parts first, so rows meet both where the ranking has dealt them.
    offsets = starts.select(name(F.col("source")).alias(src), part, offset).join(made, src)
    rank = F.row_number().over(Window.partitionBy(src, part).orderBy(md5))
    places = (
        rows.withColumn(in_part, rank)
        .join(offsets, [src, part])
        .withColumn(ranked, F.expr(f"{offset} + {in_part} - 1"))
        .withColumn(block_, F.expr(f"{ranked} div {block}"))
        .withColumn(slot, F.expr(f"({block_} div {plan}.w) * {plan}.period + get({plan}.plan, cast({block_} % {plan}.w as int))"))
    )
    place = F.struct(
        F.col(slot).alias("slot"),
        F.expr(f"{slot} * {block} + {ranked} % {block}").alias("position"),
        (F.col(slot) < F.col(plan)["end"]).alias("in_mix"),
    )
    return places.withColumn(mix, place).select(*df.columns, mix)


def mixed(df: DataFrame, weights: Mapping[str, int], default: int = 1, key: str = "doc_id", source: str = "source", block: int = BLOCK) -> DataFrame:
    """The rows of ``df`` in the order of their positions, with the columns of ``df``.

    The order is that of the files and rows written from the frame, where ``arrived`` finds it again.
    Repeated rows repeat; an empty table gives no rows; other columns, whatever their names, stay as
    they are.
    """
    found = positions(df, weights, default, key, source, block)
    return found.orderBy(F.col(found.columns[-1])["position"]).select(*df.columns)


def arrived(df: DataFrame, name: str) -> DataFrame:
    """``df`` with the struct column ``name``, which sorts its rows in the order in which they come: ``run``, then ``at``.

    Spark numbers the files that it writes in the order of the frame's rows. A scan takes them by
    length instead, and may cut them; so rows of files go by the file's number and name and by where
    the cut starts. Rows of no file go by their task. ``at`` counts the rows of a task. All this holds
    for one run of the query: store the rows before they are used more than once.
    """
    at, file = F.monotonically_increasing_id(), F.input_file_name()
    number = F.coalesce(F.regexp_extract(file, r"part-(\d+)[^/]*$", 1).try_cast("long"), F.lit(-1))
    task = F.shiftright(at, 33).alias("task")
    come = lambda *parts: F.struct(F.struct(*parts, task).alias("run"), at.alias("at"))
    try:
        return df.withColumn(name, come(number.alias("number"), file.alias("file"), F.input_file_block_start().alias("start")))
    except AnalysisException as error:
        if error.getCondition() != "MULTI_SOURCES_UNSUPPORTED_FOR_EXPRESSION":
            raise
        return df.withColumn(name, come())  # joined rows are not those of one file


def numbered_rows(df: DataFrame, order: str, name: str) -> DataFrame:
    """``df``, stored rows with a column ``order`` of ``arrived``, with ``name`` in its place, the number from 0 of each row in that order.

    The table of runs has a row for each task or cut of a file, so it is summed up and broadcast.
    """
    run, shift, n, first = (fresh(df, c) for c in ("__run", "__shift", "__n", "__first"))
    runs = df.groupBy(F.col(order)["run"].alias(run)).agg(F.count("*").alias(n), F.min(F.col(order)["at"]).alias(first))
    before = Window.partitionBy(F.lit(0)).orderBy(run).rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select(run, (F.coalesce(F.sum(n).over(before), F.lit(0)) - F.col(first)).alias(shift))
    found = df.withColumn(run, F.col(order)["run"]).join(F.broadcast(starts), run)
    return found.withColumn(name, F.col(order)["at"] + F.col(shift)).drop(order, run, shift)
