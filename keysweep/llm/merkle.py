"""Merkle manifest of a dataset: a digest tree for each group of rows, one over the groups, and a proof for every row.

A leaf is the digest of a row's fields. The leaves of a group are ranked; while several nodes are left, every ``RUN`` consecutive
ones become the digest of their digests. The tops of the groups, in the order of the groups, give the root in the same way.

Ranks come from one range partitioning, so that a group may fill any number of tasks. The digits of the rank to the base ``RUN``
are columns, and are grouped away one after the other: each time, the children become an array of structs inside of their parent.
This stops at blocks of ``RUN ** DIGITS`` nodes. The blocks are the nodes of a next round, until each group is one block. On the
way back, a block's row meets what is above it by grouping the two; a transform gives every child its siblings, and an
explode makes rows of the children. No join takes part in that, and no row holds more than one block.

Cases: a NULL field is written as ``-``, an empty one as ``0:``, so the two differ; texts of any length are only hashed; a NULL group
is a group of its own, before all others; NULL identifiers come first in their group; rows of one identifier are ordered by their
digests, and repeated rows are leaves of their own; a group of one leaf has it as its top; an empty table has no rows and no root.
Columns that are neither a field nor in ``carry`` are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keysweep.functions.columns import column
from keysweep.llm.ranks import placed, with_ranks
from keysweep.llm.staging import Stage

RUN = 16
BITS = 4
# Digits that are grouped away within a block of at most RUN ** DIGITS nodes.
DIGITS = 2
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# Bytes of a row group of nested rows, which is what a reader holds of them at once.
ROW_GROUP = 16 << 20

PATH = "array<struct<before:string,after:string>>"


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def leaf(fields: Sequence[Column]) -> Column:
    """Digest of the fields, each with its length in bytes in front, so that no two rows read alike."""

    def written(field: Column) -> Column:
        text = field.cast("string")
        return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))

    return digest(F.concat(*map(written, fields)))


def levels(total: Column) -> Column:
    """How often nodes are grouped until one of ``total`` is left."""
    return sum((F.when(total > RUN**k, 1).otherwise(0) for k in range(15)), F.lit(0))


def ranked(stage: Stage, nodes: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``nodes`` with their rank from 0 in their ``grp``, by ``order``, and the levels above them."""
    rows = with_ranks(placed(stage, nodes, ["grp", *order], name), "grp")
    return rows.select("grp", "rank", levels(F.col("total")).alias("left"), "hash", "item")


def blocks_of(nodes: DataFrame) -> DataFrame:
    """The blocks of ``nodes``: their digit columns are grouped away from the last one on, and children nest in their parents."""
    digits = [f"digit{k}" for k in range(DIGITS)]
    rows = nodes.select(
        "grp",
        F.shiftright("rank", BITS * DIGITS).alias("block"),
        *[F.shiftright("rank", BITS * k).bitwiseAND(RUN - 1).cast("int").alias(d) for k, d in enumerate(digits)],
        "left",
        "hash",
        "item",
    ).repartition("grp", "block")
    for k, digit in enumerate(digits):
        nested = F.sort_array(F.collect_list(F.struct(F.col(digit).alias("digit"), "hash", "item")))
        rows = rows.groupBy("grp", "block", *digits[k + 1 :]).agg(F.first("left").alias("left"), nested.alias("item"))
        own = digest(F.array_join(F.col("item.hash"), ""))
        # A group that has come down to one node is not grouped any more.
        rows = rows.withColumn("hash", F.when(F.col("left") > k, own).otherwise(F.get("item", F.lit(0))["hash"]))
    return rows


def up(stage: Stage, nodes: DataFrame, name: str) -> list[DataFrame]:
    """Rounds of blocks; those of a round that is not their group's last are the nodes of the next one."""
    rounds = []
    while True:
        blocks = stage.small_groups(blocks_of(nodes), f"{name}-{len(rounds)}", ROW_GROUP)
        rounds.append(blocks)
        more = blocks.filter(F.col("left") > DIGITS)
        if more.isEmpty():
            return rounds
        nodes = more.select("grp", F.col("block").alias("rank"), (F.col("left") - DIGITS).alias("left"), "hash", F.lit(0).alias("item"))


def tops(rounds: Sequence[DataFrame]) -> DataFrame:
    """The last node of every group, and the round it comes from."""
    found = None
    for k, blocks in enumerate(rounds):
        last = blocks.filter(F.col("left") <= DIGITS).select("grp", "block", "hash", F.lit(k).alias("round"))
        found = last if found is None else found.unionByName(last)
    return found


def children(blocks: DataFrame) -> DataFrame:
    """The nodes of ``blocks``, with their siblings, level by level, put in front of the path."""
    rows = blocks.select("grp", "block", "left", "item", "root", "top", "path")
    for k in reversed(range(DIGITS)):

        def with_siblings(child: Column, i: Column) -> Column:
            hashes = F.col("item.hash")
            before, after = F.slice(hashes, 1, i), F.slice(hashes, i + 2, RUN)
            return F.struct(
                child["digit"].alias("digit"),
                child["item"].alias("below"),
                child["hash"].alias("hash"),
                F.struct(F.array_join(before, "").alias("before"), F.array_join(after, "").alias("after")).alias("siblings"),
            )

        rows = rows.select("grp", "block", "left", "root", "top", "path", F.inline(F.transform("item", with_siblings)))
        rows = rows.select(
            "grp",
            (F.shiftleft("block", BITS) + F.col("digit")).alias("block"),
            "left",
            F.col("below").alias("item"),
            "hash",
            "root",
            "top",
            F.when(F.col("left") > k, F.concat(F.array("siblings"), "path")).otherwise(F.col("path")).alias("path"),
        )
    return rows


def down(rounds: Sequence[DataFrame], above: DataFrame) -> DataFrame:
    """The nodes of the first round with their paths; ``above`` has root, top and path of the last block of every group."""
    found = None
    for k in reversed(range(len(rounds))):
        known = above.filter(F.col("round") == k).select("grp", "block", "root", "top", "path")
        if found is not None:
            known = known.unionByName(found.select("grp", "block", "root", "top", "path"))
        both = rounds[k].select("grp", "block", "left", "item").unionByName(known, allowMissingColumns=True)
        met = both.groupBy("grp", "block").agg(*[F.first(c, True).alias(c) for c in ("left", "item", "root", "top", "path")])
        found = children(met)
    return found


def merkle_manifest(
    docs: DataFrame,
    fields: Sequence[str] = FIELDS,
    id_col: str = "doc_id",
    group_col: str = "source",
    carry: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Per row of ``docs``: doc_id, leaf, subroot, root, path, and the columns of ``carry``.

    ``path`` is an array from the leaf's level to the root's of the digests before and after the node in its run, joined.
    """
    carry = dict(carry or {})
    stage = Stage(docs.sparkSession, "merkle")
    item = F.struct(column(id_col).alias("id"), *[c.alias(n) for n, c in carry.items()])
    rows = docs.select(column(group_col).alias("grp"), leaf([column(f) for f in fields]).alias("hash"), item.alias("item"))
    leaves = stage(rows.withColumn("id", F.col("item.id")), "leaves")
    rounds = up(stage, ranked(stage, leaves, ["id", "hash"], "leaves"), "blocks")
    # The tops of the groups are the leaves of one more tree.
    inner = tops(rounds)
    inner = inner.select(F.lit(0).alias("grp"), F.col("grp").alias("own"), "hash", F.struct("grp", "block", "hash", "round").alias("item"))
    outer = up(stage, ranked(stage, inner, ["own"], "groups"), "groups")
    none = F.array().cast(PATH)
    start = tops(outer).select("grp", "block", "round", F.col("hash").alias("root"), F.col("hash").alias("top"), none.alias("path"))
    above = down(outer, start).select("item.grp", "item.block", "item.round", "root", F.col("item.hash").alias("top"), "path")
    found = down(rounds, stage(above, "above"))
    return found.select(
        F.col("item.id").alias("doc_id"),
        F.col("hash").alias("leaf"),
        F.col("top").alias("subroot"),
        "root",
        "path",
        *[F.col("item")[n].alias(n) for n in carry],
    )


def folded(own: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    return F.aggregate(path, own, lambda h, level: digest(F.concat(level["before"], h, level["after"])))


def tampered(text: Column) -> Column:
    """The text with A-Z in lower case."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def merkle_digest(docs: DataFrame) -> DataFrame:
    """The manifest of ``docs`` with a checksum of each path, and the root that each leaf gives after a fifth of them was
    tampered with: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified. NULL identifiers are not tampered with."""
    chosen = F.crc32(column("doc_id").cast("string")) % 5 == 0
    changed = leaf([tampered(column(f)) if f == "text" else column(f) for f in FIELDS])
    found = merkle_manifest(docs, carry={"changed": F.when(chosen, changed)})
    siblings = F.transform("path", lambda level: F.concat(level["before"], level["after"]))
    found = found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        digest(F.array_join(siblings, "")).alias("proof_sha256"),
        folded(F.coalesce("changed", "leaf"), F.col("path")).alias("folded_root"),
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
