"""Merkle manifest of a dataset: leaves, source trees, root, proofs and their verification.

Every node of a tree carries the interval ``[lo, hi)`` of leaf ranks that it covers.
Ranks come from a range sort and counts per written partition, so a large source is
spread over many tasks. Nodes are bucketed by level: BAND levels of a tree lie in
blocks of ``ARITY ** BAND`` neighbouring nodes, whatever the size of the source. Going
up, a block yields the node above it. Going down, a block is attached to the ancestor
whose interval contains its own, and the siblings of a node on each level are the
difference of its parent's interval and its own.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedmill.session import drop_staged, stage

ARITY = 3
BAND = 6
_ROW_BITS = 33  # of monotonically_increasing_id, below the partition
STEPS = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts, one after the other."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """``-`` for null, else byte count, colon and value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digests(docs: DataFrame) -> DataFrame:
    """source, doc_id, leaf and the leaf after tampering (null where nothing is tampered with)."""
    head = [field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")]
    text = F.col("text").cast("string")
    hit = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    changed = hit & F.contains(text, F.lit("\n"))
    return docs.select(
        F.col("source").cast("string").alias("source"), F.col("doc_id").cast("long").alias("doc_id"),
        digest(*head, field(text)).alias("digest"),
        F.when(changed, digest(*head, field(F.replace(text, F.lit("\n"), F.lit(""))))).alias("tampered"),
    )


def ranked(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``lo`` (rank within ``group`` by ``order``, from 0), ``hi`` and the group's ``total``.

    Rows are sorted by ranges of group and order; only one count per partition and
    group is summed up, so neither a task nor the driver holds a whole group.
    """
    in_order = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    placed = stage(in_order.withColumn("_row", F.monotonically_increasing_id()), "ranks")
    part = F.shiftright("_row", _ROW_BITS)
    runs = placed.groupBy(part.alias("_part"), F.col(group).alias("_group")).agg(
        F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_held")
    )
    same = Window.partitionBy("_group")
    before = same.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        "_part", "_group", (F.coalesce(F.sum("_held").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_held").over(same).alias("total"),
    )
    lo = F.col("_row") + F.col("_shift")
    joined = placed.join(runs, (part == F.col("_part")) & F.col(group).eqNullSafe(F.col("_group")))
    out = stage(joined.select(*rows.columns, lo.alias("lo"), (lo + 1).alias("hi"), "total"), "ranked")
    drop_staged(placed)
    return out


def _parents(digests: Column) -> Column:
    """Digests of the runs of ARITY neighbours."""
    last = F.floor((F.size(digests) - 1) / ARITY).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.sha2(F.array_join(F.slice(digests, i * ARITY + 1, ARITY), ""), 256))


def _levels_above(total: Column) -> Column:
    """Levels of a block above its nodes, if its level has ``total`` nodes in all."""
    return reduce(lambda out, k: F.when(total <= ARITY ** k, k).otherwise(out), range(BAND - 1, -1, -1), F.lit(BAND))


def blocks(nodes: DataFrame, group: str, width: int) -> DataFrame:
    """Neighbouring nodes of ``width`` leaves each, gathered into blocks, with the digests of the levels above."""
    others = [c for c in nodes.columns if c not in (group, "total")]
    size = width * ARITY ** BAND
    out = nodes.groupBy(group, F.floor(F.col("lo") / size).alias("bucket")).agg(
        F.array_sort(F.collect_list(F.struct("lo", *[c for c in others if c != "lo"]))).alias("nodes"),
        F.max("total").alias("total"),
    )
    out = out.withColumn("levels", _levels_above(F.col("total"))).withColumn("d0", F.col("nodes.digest"))
    for k in range(1, BAND + 1):
        out = out.withColumn(f"d{k}", F.when(F.col("levels") >= k, _parents(F.col(f"d{k - 1}"))))
    return out


def above(block: DataFrame, group: str) -> DataFrame:
    """The node above every block: it covers the block's whole interval."""
    top = F.coalesce(*[F.col(f"d{k}") for k in range(BAND, -1, -1)])
    return block.select(
        group, F.array_min("nodes.lo").alias("lo"), F.array_max("nodes.hi").alias("hi"), top[0].alias("digest"),
        F.ceil(F.col("total") / ARITY ** BAND).alias("total"),
    )


def grow(leaves: DataFrame, group: str, most: int) -> tuple[list[DataFrame], DataFrame]:
    """(blocks of every band from the leaves up, the root of every group); ``most`` leaves in a group."""
    bands, nodes, width = [], leaves, 1
    while True:
        bands.append(stage(blocks(nodes, group, width), "merkle-blocks"))
        nodes = above(bands[-1], group)
        width *= ARITY ** BAND
        if width >= most:
            return bands, nodes.select(group, "digest")


def _siblings(band: DataFrame) -> Column:
    """Steps from the node at ``pos`` to the top of its block: digests left and right of it on each level."""
    steps = []
    for k in range(BAND):
        own = F.floor(F.col("pos") / ARITY ** k).cast("int")
        level, inside = F.col(f"d{k}"), own % ARITY
        # the parent covers the nodes from own - inside on; what it covers besides own are the siblings
        steps.append(F.struct(
            F.array_join(F.slice(level, own - inside + 1, inside), "").alias("left"),
            F.array_join(F.slice(level, own + 2, ARITY - 1 - inside), "").alias("right"),
        ))
    return F.slice(F.array(*steps), F.lit(1), F.col("levels"))


def descend(bands: list[DataFrame], group: str, roots: DataFrame) -> DataFrame:
    """Leaves with ``path``, their steps to the top, and the other columns of ``roots`` (group, path, ...)."""
    facts = [c for c in roots.columns if c not in (group, "path")]
    ancestors = roots.select(F.col(group).alias("_group"), F.lit(0).alias("_lo"), F.lit(None).cast("long").alias("_hi"),
                             F.col("path").alias("_path"), *facts)
    for k, band in reversed(list(enumerate(bands))):
        size = ARITY ** (BAND * (k + 1))
        first, last = F.array_min("nodes.lo"), F.array_max("nodes.hi")
        inside = (
            F.col(group).eqNullSafe(F.col("_group")) & (F.col("bucket") == F.floor(F.col("_lo") / size))
            & (F.col("_lo") <= first) & (F.col("_hi").isNull() | (F.col("_hi") >= last))
        )
        attached = band.join(ancestors, inside).select("*", F.posexplode("nodes").alias("pos", "node"))
        steps = F.concat(_siblings(band), F.col("_path")).cast(STEPS)
        if k == 0:
            return attached.select(group, "node.*", steps.alias("path"), *facts)
        ancestors = attached.select(F.col(group).alias("_group"), F.col("node.lo").alias("_lo"), F.col("node.hi").alias("_hi"),
                                    steps.alias("_path"), *facts)
    raise AssertionError


def fold(leaf: Column, path: Column) -> Column:
    """Root recomputed from a leaf and its steps."""
    return F.aggregate(path, leaf, lambda below, step: digest(step["left"], below, step["right"]))


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every document.

    Leaves of a source ascend by doc_id (null first), then by leaf digest; repeated rows
    are leaves each. A null source is a source, before all others. A source of one
    document has its leaf as subroot, a dataset of one source its subroot as root, and
    a leaf without siblings the proof of nothing. Null columns are hashed as ``-``; a
    row without an id is not tampered with. An empty table gives no rows. Other columns
    take no part. The tables of a tree stay in the shared folder until the session
    ends, as the result reads them; only the unsorted leaves go.
    """
    staged = stage(leaf_digests(docs).withColumn("row", F.monotonically_increasing_id()), "leaves")
    leaves = ranked(staged, "source", ["doc_id", "digest", "row"])
    most = leaves.agg(F.coalesce(F.max("total"), F.lit(0))).first()[0]
    bands, subroots = grow(leaves.drop("row"), "source", most)
    tops = ranked(subroots.withColumn("tree", F.lit(0)), "tree", ["source"])
    upper, root = grow(tops, "tree", tops.count())
    roots = root.select("tree", F.array().cast(STEPS).alias("path"), F.col("digest").alias("root"))
    sources = descend(upper, "tree", roots).select("source", "path", F.col("digest").alias("subroot"), "root")
    out = descend(bands, "source", stage(sources, "source-paths"))
    drop_staged(staged, leaves, tops)
    siblings = F.array_join(F.transform("path", lambda step: F.concat(step["left"], step["right"])), "")
    folded = out.select(
        "doc_id", F.col("digest").alias("leaf"), "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"),
        fold(F.coalesce("tampered", "digest"), F.col("path")).alias("folded_root"),
    )
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))
