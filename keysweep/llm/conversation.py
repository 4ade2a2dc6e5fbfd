"""Conversation structure repair: the cheapest edits that give a conversation the shape of turns, the least of them by their audit.

The rows of a conversation are taken by turn, NULL first; rows of one turn by role, text and a digest of both, as far as their first
``KEY_CHARS`` characters tell them apart. The first fault of each row counts: blank (white space only), duplicate (role and
text of an earlier row), truncated (no ``.``, ``!`` or ``?`` at the end). Edits are Keep, Rerole to user or assistant, Delete, which is
required for blank and duplicate rows, and Insert of an empty user or assistant row. The audit is their initials in order. After them,
the initials of the roles are ``(s?(ua)+)?``. Of the cheapest audits the least one in ASCII is chosen.

Method. Nodes are a number of rows taken and what was written so far: nothing, a system row, ends in user, ends in assistant.
A dynamic program from the end gives every node its cost. Arcs on which the cost goes down by that of the edit are optimal.
Nodes are ranked by the first letter on their optimal arcs, then by 2, 4, 8 letters: the rank over twice as many is that of the pair of
the node's rank and the rank of the node that its pointer leads to, and pointers are doubled with it. No two arcs of a node have
one letter, so each rank has one pointer, and the doubled pointers give the least path.

Rows are ranked within their conversation by ranges, and cut into blocks of ``BLOCK``, so that a conversation may have any number
of rows. Longer conversations have their blocks joined by min-plus matrices: costs from state to state are combined over the blocks
behind, which gives each block the costs at its end; then the states that its least paths lead to are combined over
the blocks before, which gives the state it begins with. Both are scans in trees of ``BLOCK`` branches. Only the checksum of a repaired
conversation, which no one can compute in parts, streams its rows through one task, with no more than a batch in memory.

Cases: a NULL role or text counts as one space; a NULL conversation is one conversation; roles other than system, user and assistant
count by their first letter, and those that begin otherwise, or are empty, are legal nowhere; texts of any length are read
row by row; repeated rows are duplicates; an empty table gives an empty result; other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keysweep.functions.columns import column
from keysweep.llm.ranks import placed, with_ranks
from keysweep.llm.shipping import ship
from keysweep.llm.staging import Stage, same

BLOCK_BITS = 10
BLOCK = 1 << BLOCK_BITS
# Characters of roles and texts by which rows of one turn are ordered, before a digest.
KEY_CHARS = 100
# Blocks times letters that are worked on at a time.
PIECE = 1 << 19

# White space, ends of sentences, and the costs of edits.
SPACE = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")
REROLE = 3
DELETE = 4
INSERT = 3
TRUNCATED = 3

# States: nothing written, a system row, ends in user, ends in assistant.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
INITIALS = ("s", "u", "a")
NAMES = {USER: "user", ASSISTANT: "assistant"}
FAULTS = ("blank", "duplicate", "truncated")
# State after a row of each initial is kept, by state; -1 where it is not legal. The last initial stands for all others.
KEPT = np.array([[SYSTEM, USER, -1, -1], [-1, USER, -1, -1], [-1, -1, ASSISTANT, -1], [-1, USER, -1, -1]])
# State after the user or assistant row that is legal.
WRITTEN = np.array([USER, USER, ASSISTANT, USER])
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
LETTERS = "DIKR"
FAR = 1 << 50
# Costs and inserted rows at the end of a conversation.
FINAL = (0, 2 * INSERT, INSERT, 0)
LAST_INSERTS = (0, 2, 1, 0)


def unpacked(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Initials, rows that must go, and what rows cost if they stay."""
    fault = codes >> 2
    return codes & 3, (fault == 1) | (fault == 2), np.where(fault == 3, TRUNCATED, 0)


def padded(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(x) for x in lists], np.int64)
    out = np.zeros((len(lists), int(sizes.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = np.concatenate([np.array(x, np.int64) for x in lists]) if len(lists) else []
    return out, sizes


def costs(codes: np.ndarray, sizes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Cost from every node (block, rows taken, state) on, where ``ends`` has those at the end of each block."""
    initial, forced, extra = unpacked(codes)
    blocks, longest = codes.shape
    out = np.empty((blocks, longest + 1, 4), np.int64)
    out[:, longest] = ends
    each = np.arange(blocks)
    for i in reversed(range(longest)):
        after = out[:, i + 1]
        row = after + DELETE
        for q in range(4):
            to = KEPT[q][initial[:, i]]
            keep = np.where(to >= 0, after[each, to], FAR) + extra[:, i]
            rerole = after[:, WRITTEN[q]] + REROLE + extra[:, i]
            row[:, q] = np.where(forced[:, i], row[:, q], np.minimum(row[:, q], np.minimum(keep, rerole)))
        at = row.copy()
        at[:, USER] = np.minimum(row[:, USER], row[:, ASSISTANT] + INSERT)
        at[:, ASSISTANT] = np.minimum(row[:, ASSISTANT], row[:, USER] + INSERT)
        at[:, NOTHING] = np.minimum(row[:, NOTHING], at[:, USER] + INSERT)
        at[:, SYSTEM] = np.minimum(row[:, SYSTEM], at[:, USER] + INSERT)
        out[:, i] = np.where((i < sizes)[:, None], at, after)
    return out


def least_arcs(codes: np.ndarray, sizes: np.ndarray, cost: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of every node, the first letter on its optimal arcs (from 1 on, 0 at the end of its block) and the node it leads to."""
    initial, forced, extra = unpacked(codes)
    blocks, longest = codes.shape
    node = np.arange(cost.size).reshape(cost.shape)
    letter, pointer = np.zeros(cost.shape, np.int64), node.copy()
    here, after = cost[:, :longest], cost[:, 1:]
    open_ = np.arange(longest) < sizes[:, None]
    for q in range(4):
        kept = KEPT[q][initial]
        free = open_ & ~forced
        keep = np.where(kept >= 0, np.take_along_axis(after, np.maximum(kept, 0)[:, :, None], 2)[:, :, 0], FAR) + extra
        arcs = (
            (open_ & (after[:, :, q] + DELETE == here[:, :, q]), node[:, 1:, q]),
            (open_ & (here[:, :, WRITTEN[q]] + INSERT == here[:, :, q]), node[:, :longest, WRITTEN[q]]),
            (free & (keep == here[:, :, q]), node[:, 1:, 0] + np.maximum(kept, 0)),
            (free & (after[:, :, WRITTEN[q]] + REROLE + extra == here[:, :, q]), node[:, 1:, WRITTEN[q]]),
        )
        for k, (optimal, to) in reversed(list(enumerate(arcs))):
            letter[:, :longest, q] = np.where(optimal, k + 1, letter[:, :longest, q])
            pointer[:, :longest, q] = np.where(optimal, to, pointer[:, :longest, q])
    return letter.ravel(), pointer.ravel()


def doubled(letter: np.ndarray, pointer: np.ndarray, longest: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Ranks of the nodes by their least audits of ``longest`` letters or more, and pointers over 1, 2, 4 .. letters."""
    rank, pointers, length = letter, [pointer], 1
    while length < longest:
        pair = rank * (int(rank.max(initial=0)) + 1) + rank[pointers[-1]]
        rank = np.unique(pair, return_inverse=True)[1]
        pointers.append(pointers[-1][pointers[-1]])
        length *= 2
    return rank, pointers


def walked(starts: np.ndarray, pointers: list[np.ndarray]) -> np.ndarray:
    """The nodes on the way from each start, by the longest pointers first."""
    path = starts[:, None]
    for pointer in reversed(pointers[:-1]):
        path = np.stack([path, pointer[path]], axis=2).reshape(len(starts), -1)
    return path


def by_size(lists: list[list[int]], width: int) -> Iterator[np.ndarray]:
    """Indices of lists in groups of similar length, whose padded form is bounded."""
    order = np.argsort([len(x) for x in lists], kind="stable")[::-1]
    at = 0
    while at < len(order):
        take = max(1, PIECE // (width * (len(lists[order[at]]) + 1)))
        yield order[at : at + take]
        at += take


def matrices(lists: list[list[int]]) -> np.ndarray:
    """Costs of every block from state to state."""
    out = np.empty((len(lists), 4, 4), np.int64)
    for some in by_size(lists, 4):
        codes, sizes = padded([lists[i] for i in some])
        for q in range(4):
            ends = np.full(4, FAR)
            ends[q] = 0
            out[some, :, q] = costs(codes, sizes, np.broadcast_to(ends, (len(some), 4)))[:, 0]
    return np.minimum(out, FAR)


def paths(lists: list[list[int]], ends: np.ndarray, starts: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Of each block: costs by state, the state that each state's least path leads to, and the audit from ``starts`` on if given."""
    cost, to, audits = np.empty((len(lists), 4), np.int64), np.empty((len(lists), 4), np.int64), [""] * len(lists)
    table = np.frombuffer(b"\0" + LETTERS.encode(), np.uint8)
    for some in by_size(lists, 12):
        codes, sizes = padded([lists[i] for i in some])
        every = costs(codes, sizes, ends[some])
        letter, pointer = least_arcs(codes, sizes, every)
        _, pointers = doubled(letter, pointer, 3 * codes.shape[1] + 1)
        first = np.arange(len(some)) * (codes.shape[1] + 1) * 4
        cost[some] = every[:, 0]
        to[some] = pointers[-1][first[:, None] + np.arange(4)] % 4
        if starts is not None:
            letters = table[letter[walked(first + starts[some], pointers)]]
            for i, row in zip(some.tolist(), letters):
                audits[i] = row[row > 0].tobytes().decode()
    return cost, to, audits


def product(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return np.minimum((left[:, :, None] + right[None, :, :]).min(axis=1), FAR)


def mapped(df: DataFrame, schema: T.StructType | str, func) -> DataFrame:
    """``func`` on the columns of each batch, as lists by name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield func(batch)

    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def int_lists(values: np.ndarray) -> pa.Array:
    return pa.array(values.reshape(len(values), -1).tolist(), pa.list_(pa.int64()))


def scan(stage: Stage, nodes: DataFrame, backward: bool, depth: int = 0) -> DataFrame:
    """For each node (conv, block, matrix) the product of the matrices before it, or behind it."""
    groups = nodes.groupBy("conv", F.shiftright("block", BLOCK_BITS).alias("group")).agg(
        F.sort_array(F.collect_list(F.struct("block", "matrix"))).alias("nodes")
    )
    groups = stage(groups, f"scan-{depth}-{backward}")
    conv = groups.schema["conv"]
    unit = np.where(np.eye(4, dtype=bool), 0, FAR)

    def total(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for nodes in batch.column("nodes").to_pylist():
            whole = unit
            for node in nodes:
                whole = product(whole, np.array(node["matrix"]).reshape(4, 4))
            out.append(whole)
        return pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("group"), int_lists(np.array(out))], ["conv", "block", "matrix"])

    if groups.filter(F.col("group") > 0).isEmpty():
        met = groups.withColumn("outer", F.lit(None).cast("array<long>"))
    else:
        whole = T.StructType([conv, T.StructField("block", T.LongType()), T.StructField("matrix", T.ArrayType(T.LongType()))])
        outer = scan(stage, stage(mapped(groups, whole, total), f"whole-{depth}-{backward}"), backward, depth + 1)
        outer = outer.select(F.col("conv").alias("outer_conv"), F.col("block").alias("outer_group"), F.col("product").alias("outer"))
        met = groups.join(outer, same(F.col("conv"), F.col("outer_conv")) & (F.col("group") == F.col("outer_group")), "left")

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows, blocks, out = [], [], []
        for i, (nodes, start) in enumerate(zip(batch.column("nodes").to_pylist(), batch.column("outer").to_pylist())):
            whole = unit if start is None else np.array(start).reshape(4, 4)
            for node in reversed(nodes) if backward else nodes:
                rows.append(i)
                blocks.append(node["block"])
                out.append(whole)
                own = np.array(node["matrix"]).reshape(4, 4)
                whole = product(own, whole) if backward else product(whole, own)
        return pa.RecordBatch.from_arrays(
            [batch.column("conv").take(pa.array(rows)), pa.array(blocks, pa.int64()), int_lists(np.array(out))], ["conv", "block", "product"]
        )

    found = T.StructType([conv, T.StructField("block", T.LongType()), T.StructField("product", T.ArrayType(T.LongType()))])
    return stage(mapped(met.select("conv", "nodes", "outer"), found, each), f"scanned-{depth}-{backward}")


def taken(stage: Stage, rows: DataFrame) -> DataFrame:
    """Rows with a place: conv, turn, role, text, and their first fault but duplicates."""
    text = F.rtrim(F.col("text"), F.lit(SPACE))
    short = [F.substring(c, 1, KEY_CHARS).alias(f"order_{c}") for c in ("role", "text")]
    rows = rows.select(
        "*",
        *short,
        F.xxhash64("role", "text").alias("order_digest"),
        # Tells repeated rows apart, so that they can be dealt to several tasks.
        F.monotonically_increasing_id().alias("order_row"),
        F.when(text == "", 1).when(~F.substring(text, -1, 1).isin(*ENDS), 3).otherwise(0).alias("fault"),
    )
    order = ["conv", "turn", "order_role", "order_text", "order_digest", "order_row"]
    return placed(stage, rows, order, "rows").drop(*order[2:])


def coded(stage: Stage, rows: DataFrame) -> DataFrame:
    """Rows without their texts: conv, turn, place, rank, total, fault and initial."""
    initial = F.substring("role", 1, 1)
    own = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    number = F.coalesce(*[F.when(initial == c, k) for k, c in enumerate(INITIALS)], F.lit(len(INITIALS)))
    slim = rows.select("conv", "turn", "place", "fault", number.alias("initial"), F.when(F.col("fault") != 1, own).alias("key"))
    ranks = stage(with_ranks(slim, "conv"), "ranks")
    first = ranks.filter(F.col("key").isNotNull()).groupBy("conv", "key").agg(F.min("rank").alias("first"), F.count("*").alias("rows"))
    first = first.filter("rows > 1").select(F.col("conv").alias("first_conv"), F.col("key").alias("first_key"), "first")
    met = ranks.join(first, same(F.col("conv"), F.col("first_conv")) & (F.col("key") == F.col("first_key")), "left")
    fault = F.when(F.col("rank") > F.col("first"), 2).otherwise(F.col("fault"))
    return stage(met.select("conv", "turn", "place", "rank", "total", fault.alias("fault"), "initial"), "coded")


def blocks_of(coded: DataFrame) -> DataFrame:
    """Blocks of codes, each with the initial of the row before it, the place of its first row, and whether it is the last."""
    block = F.shiftright("rank", BLOCK_BITS)
    code = (F.col("initial") + 4 * F.col("fault")).cast("long")
    row = F.struct(block.alias("block"), F.struct("rank", code.alias("code")).alias("row"), F.lit(None).cast("int").alias("lead"))
    lead = F.struct((block + 1).alias("block"), F.lit(None).cast("struct<rank:bigint,code:bigint>").alias("row"), F.col("initial").alias("lead"))
    crosses = ((F.col("rank") + 1) % BLOCK == 0) & (F.col("rank") + 1 < F.col("total"))
    dealt = coded.select("conv", "place", "total", F.inline(F.when(crosses, F.array(row, lead)).otherwise(F.array(row))))
    own = F.transform(F.sort_array(F.collect_list("row")), lambda r: r["code"])
    return dealt.groupBy("conv", "block").agg(
        own.alias("codes"),
        F.max("lead").alias("lead"),
        F.min(F.when(F.col("row").isNotNull(), F.col("place"))).alias("place"),
        F.max("total").alias("total"),
    )


def edits(stage: Stage, coded: DataFrame) -> DataFrame:
    """Per block: conv, block, place, start (the state it begins with), audit, illegal, and in the first one the cost."""
    blocks = stage(blocks_of(coded), "blocks")
    conv = blocks.schema["conv"]
    many = blocks.filter(F.col("total") > BLOCK)
    later = None if many.isEmpty() else between_blocks(stage, many, conv)
    if later is None:
        met = blocks.withColumn("ends", F.lit(None).cast("array<long>")).withColumn("start", F.lit(None).cast("long"))
    else:
        on = same(F.col("conv"), F.col("later_conv")) & (F.col("block") == F.col("later_block"))
        met = blocks.join(later, on, "left").drop("later_conv", "later_block")
    met = met.withColumn("last", F.shiftleft(F.col("block") + 1, BLOCK_BITS) >= F.col("total"))
    legal = {(INITIALS.index(a), INITIALS.index(b)) for a, b in LEGAL}

    def find(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = batch.column("codes").to_pylist()
        ends = np.array([x or FINAL for x in batch.column("ends").to_pylist()], np.int64)
        starts = np.array([x or NOTHING for x in batch.column("start").to_pylist()], np.int64)
        cost, to, audits = paths(lists, ends, starts)
        illegal = []
        for i, (codes, lead, last) in enumerate(zip(lists, batch.column("lead").to_pylist(), batch.column("last").to_pylist())):
            initials = ([] if lead is None else [lead]) + [c & 3 for c in codes]
            illegal.append(sum(pair not in legal for pair in zip(initials, initials[1:])))
            if last:
                audits[i] += "I" * LAST_INSERTS[to[i, starts[i]]]
        first = [cost[i, NOTHING] if b == 0 else None for i, b in enumerate(batch.column("block").to_pylist())]
        return pa.RecordBatch.from_arrays(
            [batch.column("conv"), batch.column("block"), batch.column("place"), pa.array(starts), pa.array(audits, pa.string()), pa.array(illegal, pa.int64()), pa.array(first, pa.int64())],
            ["conv", "block", "place", "start", "audit", "illegal", "cost"],
        )

    names = [("block", T.LongType()), ("place", T.LongType()), ("start", T.LongType()), ("audit", T.StringType()), ("illegal", T.LongType()), ("cost", T.LongType())]
    out = T.StructType([conv, *[T.StructField(n, t) for n, t in names]])
    return stage(mapped(met.select("conv", "block", "codes", "lead", "place", "ends", "start", "last"), out, find), "edits")


def between_blocks(stage: Stage, many: DataFrame, conv: T.StructField) -> DataFrame:
    """For the blocks of long conversations: the costs at their ends, and the states that they begin with."""

    def summed(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = matrices(batch.column("codes").to_pylist())
        return pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("block"), int_lists(out)], ["conv", "block", "matrix"])

    node = T.StructType([conv, T.StructField("block", T.LongType()), T.StructField("matrix", T.ArrayType(T.LongType()))])
    behind = scan(stage, stage(mapped(many.select("conv", "block", "codes"), node, summed), "matrices"), True)
    # The costs at a block's end are those of the blocks behind it, with the end of the conversation.
    rows = [F.slice("product", 4 * p + 1, 4) for p in range(4)]
    final = F.array(*[F.lit(x).cast("long") for x in FINAL])
    ends = F.array(*[F.array_min(F.zip_with(r, final, lambda a, b: a + b)) for r in rows])
    behind = behind.select(F.col("conv").alias("later_conv"), F.col("block").alias("later_block"), ends.alias("ends"))
    on = same(F.col("conv"), F.col("later_conv")) & (F.col("block") == F.col("later_block"))
    known = stage(many.join(behind, on).select("conv", "block", "codes", "ends"), "ends")

    def led(batch: pa.RecordBatch) -> pa.RecordBatch:
        _, to, _ = paths(batch.column("codes").to_pylist(), np.array(batch.column("ends").to_pylist(), np.int64), None)
        out = np.where(np.arange(4) == to[:, :, None], 0, FAR)
        return pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("block"), int_lists(out)], ["conv", "block", "matrix"])

    before = scan(stage, stage(mapped(known, node, led), "led"), False)
    start = (F.array_position(F.slice("product", 4 * NOTHING + 1, 4), F.lit(0).cast("long")) - 1).alias("start")
    before = before.select(F.col("conv").alias("later_conv"), F.col("block").alias("later_block"), start)
    on = same(F.col("conv"), F.col("later_conv")) & (F.col("block") == F.col("later_block"))
    found = known.drop("codes").join(before, on)
    return stage(found.select("later_conv", "later_block", "ends", "start"), "later")


def repaired_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv, first, role, text) of repaired rows, from rows of a block's edits, each before the rows it edits. Blocks come by place.

    A row without role and text stands for a conversation or block that has been begun."""
    state, letters, at = NOTHING, "", 0
    conv, rest = None, 0

    def inserted():
        nonlocal state, at
        while at < len(letters) and letters[at] == "I":
            at += 1
            state = int(WRITTEN[state])
            yield (conv, NAMES[state], "")

    for batch in batches:
        columns = (batch.column(n).to_pylist() for n in ("conv", "audit", "start", "role", "text"))
        for conv_now, audit, start, role, text in zip(*columns):
            if audit is not None:
                yield from inserted()
                conv, letters, at, state = conv_now, audit, 0, start
                yield (conv, None, None)
                continue
            yield from inserted()
            edit, at = letters[at], at + 1
            if edit == "K":
                state = int(KEPT[state][INITIALS.index(role[0])])
                yield (conv, role, text)
            elif edit == "R":
                state = int(WRITTEN[state])
                yield (conv, NAMES[state], text)
    yield from inserted()


def together(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """Rows and the edits of their blocks, by conversation and place, the edits first."""
    both = rows.select("conv", "place", "role", "text").unionByName(edits.select("conv", "place", "start", "audit"), allowMissingColumns=True)
    both = both.withColumn("order", F.col("audit").isNull())
    return both.repartition("conv").sortWithinPartitions("conv", "place", "order")


def checksums(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """conv and the SHA-256 of the repaired ``role:text``, joined by line ends. The hash is fed row by row."""
    both = together(rows, edits)
    kind = both.schema["conv"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types: list[pa.DataType] = []

        def seen() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                types.append(batch.schema.field("conv").type)
                yield batch
                del types[:-1]

        def done(found):
            return pa.RecordBatch.from_arrays([pa.array([c for c, _ in found], types[-1]), pa.array([h for _, h in found])], ["conv", "repaired_sha256"])

        now, hashed, out, lines = object(), None, [], 0
        for conv, role, text in repaired_rows(seen()):
            if hashed is None or conv != now:
                if hashed is not None:
                    out.append((now, hashed.hexdigest()))
                now, hashed, lines = conv, hashlib.sha256(), 0
            if role is not None:
                hashed.update(f"{chr(10) if lines else ''}{role}:{text}".encode())
                lines += 1
            if len(out) >= 10_000:
                yield done(out)
                out = []
        if hashed is not None:
            yield done([*out, (now, hashed.hexdigest())])

    ship(rows.sparkSession)
    return both.select("conv", "start", "audit", "role", "text").mapInArrow(
        run, T.StructType([kind, T.StructField("repaired_sha256", T.StringType())])
    )


def repaired_turns(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """The repaired conversations: conv, block and number, which order the rows, role and text. Blocks are written by different tasks."""
    first = edits.select("conv", "block", "place", "start", "audit")
    ranks = with_ranks(rows.select("conv", "place", "role", "text"), "conv")
    both = ranks.select("conv", F.shiftright("rank", BLOCK_BITS).alias("block"), "place", "role", "text").unionByName(first, allowMissingColumns=True)
    both = both.withColumn("order", F.col("audit").isNull()).repartition("conv", "block").sortWithinPartitions("conv", "block", "place", "order")
    kind = both.schema["conv"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types: list[pa.DataType] = []
        blocks: list[int] = []

        def seen() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                types.append(batch.schema.field("conv").type)
                blocks.extend(b for b, a in zip(batch.column("block").to_pylist(), batch.column("audit").to_pylist()) if a is not None)
                yield batch

        def done(found):
            columns = list(zip(*found))
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], types[-1]), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.string()), pa.array(columns[4], pa.string())],
                ["conv", "block", "number", "role", "text"],
            )

        out, size, begun, number = [], 0, 0, 0
        for conv, role, text in repaired_rows(seen()):
            if role is None:
                begun, number = begun + 1, 0
                continue
            out.append((conv, blocks[begun - 1], number, role, text))
            number, size = number + 1, size + len(text)
            if len(out) >= 10_000 or size > 1 << 20:
                yield done(out)
                out, size = [], 0
        if out:
            yield done(out)

    ship(rows.sparkSession)
    names = [("block", T.LongType()), ("number", T.LongType()), ("role", T.StringType()), ("text", T.StringType())]
    return both.select("conv", "block", "start", "audit", "role", "text").mapInArrow(run, T.StructType([kind, *[T.StructField(n, t) for n, t in names]]))


def prepared(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """conv, turn, role and text, where NULL roles and texts are one space."""
    blank = lambda c: F.coalesce(column(c).cast("string"), F.lit(" "))
    return turns.select(
        column(conv_col).alias("conv"), column(turn_col).cast("long").alias("turn"), blank(role_col).alias("role"), blank(text_col).alias("text")
    )


def repair(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows with a place, the edits of their blocks, and a report per conversation: conv, gaps, blank, duplicate, truncated, illegal,
    cost, audit. ``repaired_turns`` and ``checksums`` take the first two."""
    stage = Stage(turns.sparkSession, "conversations")
    rows = taken(stage, prepared(turns, conv_col, turn_col, role_col, text_col))
    codes = coded(stage, rows)
    found = edits(stage, codes)
    faults = [F.sum((F.col("fault") == k + 1).cast("long")).alias(n) for k, n in enumerate(FAULTS)]
    by_turn = codes.groupBy("conv", "turn").agg(*faults)
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps")
    counts = by_turn.groupBy("conv").agg(gaps, *[F.sum(n).alias(n) for n in FAULTS])
    audit = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "audit"))), lambda b: b["audit"]), "")
    edited = found.groupBy("conv").agg(F.sum("illegal").alias("illegal"), F.max("cost").alias("cost"), audit.alias("audit"))
    edited = edited.withColumnRenamed("conv", "edited_conv")
    report = counts.join(edited, same(F.col("conv"), F.col("edited_conv"))).drop("edited_conv")
    return rows, found, report


def damaged(turns: DataFrame) -> DataFrame:
    """Rows of conversations, damaged by a checksum of conversation and turn: some are dropped, emptied, robbed of the ends of their
    sentences, repeated, or given to the user. NULL counts as one space."""
    rows = prepared(turns, "conv_id", "turn", "role", "text")
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = rows.withColumn("kind", F.crc32(F.concat(blank("conv"), F.lit(":"), blank("turn"))) % 20).filter("kind != 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", "".join(ENDS), "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1)))
    return rows.select(F.col("conv").alias("conv_id"), "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def repair_digest(turns: DataFrame) -> DataFrame:
    """The report of damaged conversations with a checksum of their repaired rows, for every conversation before the damage."""
    rows, found, report = repair(damaged(turns))
    sums = checksums(rows, found).withColumnRenamed("conv", "sum_conv")
    report = report.join(sums, same(F.col("conv"), F.col("sum_conv")))
    every = turns.select(column("conv_id").alias("conv_id")).distinct()
    met = every.join(report, same(F.col("conv_id"), F.col("conv")), "left")
    zero = [F.coalesce(n, F.lit(0).cast("long")).alias(n) for n in ("gaps", *FAULTS, "illegal", "cost")]
    empty = hashlib.sha256(b"").hexdigest()
    return met.select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"))
