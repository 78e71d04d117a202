"""A Merkle manifest of a dataset, with the proof of every row by pointer jumping.

Each row is a leaf. The leaves of a group, in the order of their keys, are hashed in runs of eight,
the hashes again in runs of eight, until one is left, the group's subroot; the subroots, in the order
of their groups, likewise give the root. Every node starts with a pointer to the node above and one
segment, its siblings. A self-join then replaces each pointer by that of the node it points to and
appends that node's segments, so distances double, and after a number of rounds that grows with the
logarithm of the height every node holds its siblings up to the root.

A run is one row with its children. Leaves jump as runs, so an eighth of the rows moves, and a leaf's
own siblings are added at the end.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eodledger.session import stored

#: Consecutive nodes that are hashed together.
ARITY = 8
#: The number of the tree over the subroots; groups count from 0.
TOP = -1
#: Ancestors of up to this many bytes are sent to every task instead of moving the nodes below them.
BROADCAST_BYTES = 8 << 20
#: Bytes of one segment: seven digests and what holds them.
SEGMENT_BYTES = 320

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*parts: Column) -> Column:
    """Lowercase hexadecimal SHA-256 of the parts, one after the other."""
    return F.sha2(F.concat(*[p.cast("string") for p in parts]).cast("binary"), 256)


def field(value: Column) -> Column:
    """A value as a leaf holds it: byte count, colon and text, or a dash for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: Sequence[Column]) -> Column:
    return digest(*[field(v) for v in values])


def ascii_lower(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def joined(digests: Column) -> Column:
    """Binary digests of an array as one text."""
    return F.array_join(F.transform(digests, lambda d: F.lower(F.hex(d))), "")


def siblings(kids: Column, j: Column) -> Column:
    """The digests of an array to the left and to the right of place ``j``."""
    others = F.greatest(F.size(kids) - j - 1, F.lit(0))
    return F.struct(F.slice(kids, F.lit(1), j).alias("left"), F.slice(kids, j + 2, others).alias("right"))


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf's digest and its path lead to."""
    return F.aggregate(path, start, lambda h, step: F.sha2(F.concat(joined(step["left"]), h, joined(step["right"])).cast("binary"), 256))


def proof_digest(path: Column) -> Column:
    """The digest of all siblings of a path, step by step, left to right."""
    each = F.transform(path, lambda step: F.concat(joined(step["left"]), joined(step["right"])))
    return F.sha2(F.array_join(each, "").cast("binary"), 256)


def numbered(df: DataFrame, group: str, order: Sequence[str], name: str, facts: DataFrame | None = None) -> DataFrame:
    """``df`` with ``name``, the place from 0 of each row in its ``group`` (not null), and the group's ``facts``.

    Rows are dealt by ranges of the order, in which the group comes first, so a group of any size is
    spread over tasks, and stored. A row's place is its place in its range plus the rows of its group
    in earlier ranges, of which there is one count for each group and range. ``order`` must tell rows
    apart.
    """
    dealt = df.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    rows = stored(dealt.withColumn("__at", F.monotonically_increasing_id()), "ordered").withColumn("__range", F.shiftright("__at", 33))
    sizes = rows.groupBy(group, "__range").agg(F.count("*").alias("__n"), F.min("__at").alias("__first"))
    before = Window.partitionBy(group).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(group, "__range", (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")).alias("__shift"))
    if facts is not None:
        starts = starts.join(facts, group)
    return rows.join(starts, [group, "__range"]).withColumn(name, F.col("__at") + F.col("__shift")).drop("__range", "__at", "__shift")


def _runs(nodes: DataFrame, level: int, *kept: str) -> DataFrame:
    """The runs of ``nodes (tree, n, idx, h)``, each with the hash of its children; ``n`` counts a tree's nodes on a level."""
    kids = F.sort_array(F.collect_list(F.struct("idx", "h", *kept)))
    runs = nodes.groupBy("tree", "n", F.expr(f"idx div {ARITY}").alias("up")).agg(kids.alias("kids"))
    return stored(
        runs.select(
            "tree",
            F.ceil(F.col("n") / ARITY).alias("n"),
            F.lit(level).alias("level"),
            F.col("up").alias("idx"),
            "kids",
            F.unhex(F.sha2(joined(F.transform("kids", lambda k: k["h"])).cast("binary"), 256)).alias("h"),
        ),
        f"level{level}",
    )


def _levels(first: DataFrame, most: int) -> list[DataFrame]:
    """``first`` and the runs above it, up to one node a tree; ``most`` nodes of a tree are in ``first``."""
    out = [first]
    while most > 1:
        out.append(_runs(out[-1].filter("n > 1"), len(out) + 1))
        most = -(-most // ARITY)
    return out


def _edges(runs: DataFrame) -> DataFrame:
    """For each child of ``runs`` a pointer to the node above it and one segment, its siblings."""
    digests = F.transform("kids", lambda k: k["h"])
    return runs.select("tree", "level", F.col("idx").alias("up_idx"), digests.alias("hs"), F.posexplode("kids").alias("j", "kid")).select(
        "tree",
        (F.col("level") - 1).alias("level"),
        F.col("kid.idx").alias("idx"),
        F.struct("tree", "level", F.col("up_idx").alias("idx")).alias("up"),
        F.array(siblings(F.col("hs"), F.col("j"))).alias("segs"),
        F.lit(None).cast("binary").alias("subroot"),
    )


def _jumped(paths: DataFrame, span: int) -> DataFrame:
    """Every pointer, which spans ``span`` nodes or ends at a root, replaced by that of the node it points to.

    The nodes pointed to are few where many rows point to one of them: their number falls with the
    span by powers of the arity. Below a bound on their bytes they go to every task; beyond it at
    most ``ARITY ** span`` rows share one, and both sides move.
    """
    above = paths.filter((F.col("tree") == TOP) | (F.col("level") > span)).select(
        F.struct("tree", "level", "idx").alias("up"), F.struct("up", "segs", "subroot").alias("next")
    )
    if above.count() * span * SEGMENT_BYTES <= BROADCAST_BYTES:
        above = F.broadcast(above)
    nxt, segs = F.col("next"), F.col("segs")
    moved = paths.filter("up is not null").join(above, "up", "left").select(
        "tree",
        "level",
        "idx",
        nxt["up"].alias("up"),
        F.when(nxt.isNull(), segs).otherwise(F.concat(segs, nxt["segs"])).alias("segs"),
        F.coalesce("subroot", nxt["subroot"]).alias("subroot"),
    )
    return stored(paths.filter("up is null").unionByName(moved), "paths")


def proofs(
    df: DataFrame, fields: Sequence[str], group: str = "lang", key: str = "doc_id", keep: Mapping[str, Column] | None = None
) -> DataFrame:
    """``key, leaf, subroot, root, path`` for every row of ``df``, and ``keep``, named expressions over it.

    ``leaf`` is the digest of the ``fields``; groups ascend bytewise, null first; leaves by key, null
    first, then by digest. ``path`` has a step for each run on the way to the root, first to last:
    the digests of the run's others to the left and to the right, as binaries. Rows that are equal in
    all fields are leaves beside each other; each is returned. A null is a field like any other. An
    empty table gives no rows; other columns are not read. Kept values must have an order.

    Texts are hashed where they lie, in one pass; from then on only keys, kept values and digests move.
    """
    keep = dict(keep or {})
    rows = stored(
        df.select(
            F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("group"),
            F.col(key).alias("key"),
            F.unhex(leaf([F.col(f) for f in fields])).alias("h"),
            F.struct(*[e.alias(n) for n, e in keep.items()], F.lit(0).alias("__")).alias("kept"),
            F.monotonically_increasing_id().alias("tie"),
        ),
        "leaves",
    )
    groups = rows.groupBy("group").agg(F.count("*").alias("n")).withColumn("all", F.lit(0))
    trees = stored(numbered(groups, "all", ["group"], "tree").select("group", "tree", "n"), "trees")
    size = trees.agg(F.coalesce(F.max("n"), F.lit(0)).alias("most"), F.count("*").alias("groups")).first()
    leaves = stored(numbered(rows, "group", ["key", "h", "tie"], "idx", trees), "placed")
    lone = leaves.filter("n = 1").select(
        "tree", F.lit(0).alias("level"), F.col("idx"), F.array(F.struct("idx", "h", "key", "kept")).alias("kids"), "h"
    )
    levels = _levels(_runs(leaves.filter("n > 1"), 1, "key", "kept"), -(-size["most"] // ARITY))
    node = ("tree", "level", "idx", "h")
    subroots = reduce(DataFrame.unionByName, [m.filter("n = 1").select(*node) for m in levels], lone.select(*node))
    top = []
    if size["groups"] > 1:
        nodes = subroots.select(F.lit(TOP).cast("long").alias("tree"), F.lit(size["groups"]).alias("n"), F.col("tree").alias("idx"), "h")
        top = _levels(_runs(nodes, 1), -(-size["groups"] // ARITY))
    last = (top[-1] if top else subroots).select(F.lower(F.hex("h"))).first()
    root = F.lit(last[0] if last else None).cast("string")
    # A subroot is tied to its leaf of the tree above without a segment.
    tied = subroots.select(
        "tree",
        "level",
        "idx",
        F.struct(F.lit(TOP).cast("long").alias("tree"), F.lit(0).alias("level"), F.col("tree").alias("idx")).alias("up"),
        F.array().cast("array<struct<left:array<binary>,right:array<binary>>>").alias("segs"),
        F.col("h").alias("subroot"),
    )
    paths = stored(reduce(DataFrame.unionByName, [_edges(m) for m in [*levels[1:], *top]], tied), "paths")
    span, height = 1, len(levels) + len(top)
    while span < height:
        paths, span = _jumped(paths, span), 2 * span
    runs = levels[0].select("tree", "level", "idx", "kids").unionByName(lone.drop("h"))
    kid, hs = F.col("kid"), F.transform("kids", lambda k: k["h"])
    found = runs.join(paths.drop("up"), ["tree", "level", "idx"]).select(
        "level", "segs", "subroot", hs.alias("hs"), F.posexplode("kids").alias("j", "kid")
    )
    own = F.array(siblings(F.col("hs"), F.col("j")))
    return found.select(
        kid["key"].alias(key),
        F.lower(F.hex(kid["h"])).alias("leaf"),
        F.lower(F.hex("subroot")).alias("subroot"),
        root.alias("root"),
        F.when(F.col("level") == 0, F.col("segs")).otherwise(F.concat(own, "segs")).alias("path"),
        *[kid["kept"][n].alias(n) for n in keep],
    )


def tampering(key: str, text: str) -> tuple[Column, Column]:
    """Whether the CRC-32 of the decimal key can be divided by three, and the text that such a row then has."""
    hit = F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 0, F.lit(False))
    return hit, F.when(hit, ascii_lower(F.col(text))).otherwise(F.col(text))


def verified(df: DataFrame, fields: Sequence[str], group: str = "lang", key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, leaf, subroot, root, proof_sha256, folded_root, verified`` for every row of ``df``.

    The manifest is made of ``df`` as it is. Then rows with a key by ``tampering`` get a changed text,
    and every row's leaf, made anew, is folded with its path: ``verified`` says whether that is the
    root. A text that the change leaves as it was still verifies. A null key is never tampered with.
    """
    hit, changed = tampering(key, text)
    again = F.when(hit, F.unhex(leaf([changed if f == text else F.col(f) for f in fields])))
    found = proofs(df, fields, group, key, {"__again": again})
    folded = fold(F.coalesce(F.lower(F.hex("__again")), F.col("leaf")), F.col("path"))
    return found.select(key, "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), folded.alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root")
    )
