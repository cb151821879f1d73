"""Merkle manifest of a dataset: few levels stored, the levels between them computed again where a proof needs them.

Every row is a leaf. Leaves of one group, in order, form a tree: runs of ``FAN_OUT`` consecutive nodes become one node,
level by level, until one is left, the group's subroot. The subroots, ordered by group, form a tree of the same kind,
whose top is the root. Only every ``stride``-th level is written down (a *stratum*). The nodes between two strata belong
to aligned subtrees of ``FAN_OUT ** stride`` nodes of the lower one, so that whoever holds those few nodes can compute
them again. Proofs are made from the top down: the proof of a stored node is what lies beside its path within its own
subtree, found by folding that subtree anew, followed by the proof of the stored node above. No task ever holds more
than one subtree and one path, whatever the size of a group.

All of it is DataFrame expressions; written tables in the shared folder cut the lineage between strata.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapwise.llm.jobs import written

FAN_OUT = 3
#: Levels from one stored level to the next; a subtree has FAN_OUT to that power of stored nodes (81).
STRIDE = 4

_ROW_BITS = 33  # of monotonically_increasing_id: the row within its partition


def field(value: Column) -> Column:
    """One value in a form that no other list of values can have: ``-`` for null, else its length in bytes, ``:``, itself."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*values: Column) -> Column:
    """Digest of a row: lowercase hex sha256 over its fields."""
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def node(*children: Column) -> Column:
    """Digest of a run of digests, taken as hex text."""
    return F.sha2(F.concat(*children), 256)


def fold(digest: Column, proof: Column) -> Column:
    """The root that a leaf leads to by its proof (array of struct<left, right>, from the leaf upwards)."""
    return F.aggregate(proof, digest, lambda above, step: node(step["left"], above, step["right"]))


def siblings(proof: Column) -> Column:
    """All digests of a proof as one text: level by level, from left to right."""
    return F.array_join(F.transform(proof, lambda step: F.concat(step["left"], step["right"])), "")


@dataclass(frozen=True)
class Manifest:
    """``strata``: stored nodes (grp, idx, digest, nodes) of the groups' trees from the leaves up, ``top`` those of the
    tree over subroots, whose only ``grp`` is empty. ``nodes`` is how many nodes a group has on that level. The lowest
    stratum also has the columns kept with the leaves; the lowest of ``top`` has ``member``, the group it stands for."""

    strata: tuple[DataFrame, ...]
    top: tuple[DataFrame, ...]
    stride: int

    @property
    def subroots(self) -> DataFrame:
        """(grp, digest) of every group."""
        return self.top[0].select(F.expr("if(member = '', NULL, substring(member, 2))").alias("grp"), "digest")

    @property
    def root(self) -> DataFrame:
        """One row (digest), or none where there are no leaves."""
        return self.top[-1].select("digest")


def manifest(rows: DataFrame, group: str, order: str, digest: str, keep: tuple[str, ...] = (), stride: int = STRIDE) -> Manifest:
    """The stored levels over ``rows``, one leaf each with its ``digest`` (see ``leaf``).

    Groups may be null (a group of its own, the first) and so may ``order`` (such rows come first). Rows that tie on
    ``order`` stand by digest; rows alike in that too are leaves of their own, and it does not matter which comes
    first. An empty table has no root. ``keep`` names further columns to hand on; any others are ignored.
    """
    key = F.coalesce(F.concat(F.lit("="), F.col(group)), F.lit(""))  # orders as the group does, null first
    leaves = rows.select(
        key.alias("grp"), F.col(order).alias("place"), F.col(digest).alias("digest"), F.struct(*[F.col(c) for c in (order, group, *keep)]).alias("kept")
    )
    strata = _strata(_numbered(leaves, ["place"]), stride)
    subroots = strata[-1].select(F.lit("").alias("grp"), F.col("grp").alias("member"), "digest")
    return Manifest(strata, _strata(_numbered(subroots, ["member"]), stride), stride)


def proofs(made: Manifest) -> DataFrame:
    """Every leaf with its group's subroot, the root and its proof: order and group column, kept columns, ``digest``,
    ``subroot``, ``root``, ``proof`` (array of struct<left, right>, texts of the siblings before and after the path)."""
    # A group's subroot is a leaf of the top tree: its proof there goes on from the subroot.
    above = _with_proofs(made.top, made.stride, None).select(F.col("member").alias("grp"), F.col("digest").alias("subroot"), "root", "proof")
    found = _with_proofs(made.strata, made.stride, written(above, "merkle-top"))
    return found.select("kept.*", "digest", "subroot", "root", "proof")


def _numbered(leaves: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``idx``, from 0 within each ``grp``, and ``nodes``, the size of the group; written.

    A sorted table in range partitions numbers its rows by their partition and place in it, less what other groups
    hold. No task sees more than its range of a group. ``_row`` only keeps many equal rows from being one range.
    """
    leaves = written(leaves.withColumn("_row", F.monotonically_increasing_id()), "merkle-leaves")
    keys = [F.col(c).asc_nulls_first() for c in ("grp", *order, "digest", "_row")]
    placed = leaves.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_row").withColumn("_at", F.monotonically_increasing_id())
    placed = written(placed.withColumn("_part", F.call_function("shiftright", F.col("_at"), F.lit(_ROW_BITS))), "merkle-sorted")
    # One row per group and partition: as many as there are partitions and groups together.
    parts = placed.groupBy("grp", "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    whole = Window.partitionBy("grp")
    before = F.sum("_rows").over(whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("grp", "_part", (F.col("_first") - F.coalesce(before, F.lit(0))).alias("_less"), F.sum("_rows").over(whole).alias("nodes"))
    numbered = placed.join(parts, ["grp", "_part"]).withColumn("idx", F.col("_at") - F.col("_less"))
    return written(numbered.drop("_at", "_part", "_less", "place"), "merkle-level")


def _strata(lowest: DataFrame, stride: int) -> tuple[DataFrame, ...]:
    """The stored levels above ``lowest`` (grp, idx, digest, nodes), up to one node per group."""
    strata = [lowest]
    while not strata[-1].where("nodes > 1").isEmpty():
        strata.append(written(_fold_subtrees(strata[-1], stride), f"merkle-level-{len(strata)}"))
    return tuple(strata)


def _subtrees(stratum: DataFrame, stride: int, *more: str) -> DataFrame:
    """The nodes of each aligned subtree in one row: grp, at (its index on the next stratum), nodes, members."""
    at = F.floor(F.col("idx") / F.lit(FAN_OUT**stride)).cast("long").alias("at")
    gathered = F.array_sort(F.collect_list(F.struct("idx", "digest", *more))).alias("members")
    return stratum.groupBy("grp", at, "nodes").agg(gathered)


def _span(k: Column) -> Column:
    """Leaves under a node ``k`` levels up."""
    return F.pow(F.lit(FAN_OUT), k).cast("long")


def _next_level(digests: Column) -> Column:
    runs = F.sequence(F.lit(0), F.floor((F.size(digests) - 1) / FAN_OUT).cast("int"))
    return F.transform(runs, lambda run: F.sha2(F.array_join(F.slice(digests, run * FAN_OUT + 1, FAN_OUT), ""), 256))


def _with_levels(subtrees: DataFrame, stride: int) -> DataFrame:
    """Adds ``levels``: the digests on each level of the subtree, ``stride + 1`` arrays of them from below.

    A group's tree ends where one node is left in all of the group; from there levels repeat it.
    """

    def grow(levels: Column, k: Column) -> Column:
        last = F.element_at(levels, -1)
        return F.concat(levels, F.array(F.when(F.col("nodes") > _span(k), _next_level(last)).otherwise(last)))

    lowest = F.array(F.col("members.digest"))
    return subtrees.withColumn("levels", F.aggregate(F.sequence(F.lit(0), F.lit(stride - 1)), lowest, grow))


def _fold_subtrees(stratum: DataFrame, stride: int) -> DataFrame:
    folded = _with_levels(_subtrees(stratum.select("grp", "idx", "digest", "nodes"), stride), stride)
    nodes = F.ceil(F.col("nodes") / FAN_OUT**stride).cast("long").alias("nodes")
    return folded.select("grp", F.col("at").alias("idx"), F.element_at("levels", -1)[0].alias("digest"), nodes)


def _steps(place: Column, stride: int) -> Column:
    """What lies beside the path of the ``place``-th node of a subtree, per level up to the subtree's top."""

    def step(k: Column) -> Column:
        level, own = F.get("levels", k), F.floor(place / _span(k)).cast("int")
        first = own - F.pmod(own, F.lit(FAN_OUT))
        left = F.array_join(F.slice(level, first + 1, own - first), "")
        right = F.array_join(F.slice(level, own + 2, F.lit(FAN_OUT - 1) - (own - first)), "")
        return F.struct(left.alias("left"), right.alias("right"))

    levels = F.filter(F.sequence(F.lit(0), F.lit(stride - 1)), lambda k: F.col("nodes") > _span(k))
    return F.transform(levels, step)


def _with_proofs(strata: tuple[DataFrame, ...], stride: int, above: DataFrame | None) -> DataFrame:
    """The lowest stratum with ``subroot``, ``root`` and ``proof``; ``above`` has these for each grp's own top, or is None
    for a tree whose top is the root."""
    top = strata[-1].select("grp", "idx", "digest")
    if above is None:
        none = F.array().cast("array<struct<left:string,right:string>>")
        known = top.select("grp", "idx", F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"), none.alias("proof"))
    else:
        known = top.join(above, "grp").select("grp", "idx", "subroot", "root", "proof")
    if len(strata) == 1:
        return strata[0].join(known, ["grp", "idx"])
    for number in range(len(strata) - 2, -1, -1):
        lower = strata[number]
        kept = [c for c in lower.columns if c not in ("grp", "idx", "digest", "nodes")]
        subtrees = _with_levels(_subtrees(lower, stride, *kept), stride)
        joined = subtrees.join(known.withColumnRenamed("idx", "at"), ["grp", "at"])
        each = joined.select("*", F.posexplode("members").alias("_place", "_member")).select(
            "grp", F.col("_member.idx").alias("idx"), F.col("_member.digest").alias("digest"), *[F.col(f"_member.{c}").alias(c) for c in kept],
            "subroot", "root", F.concat(_steps(F.col("_place"), stride), F.col("proof")).alias("proof"),
        )
        if number:
            known = written(each.select("grp", "idx", "subroot", "root", "proof"), f"merkle-proofs-{number}")
    return each
