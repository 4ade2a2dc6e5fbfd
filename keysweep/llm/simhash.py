"""SimHash near-dedup: fingerprints of texts, links between those that differ in a few bits, and their components.

Fingerprint: words are runs of characters other than ASCII white space, A-Z in lower case; shingles are ``shingle``
consecutive words joined by one space (all words if there are fewer). A bit is 1 if it is set in the XXH64 (seed 42) of
more than half of the shingles, repeats included. A text without words has the fingerprint zero, and is linked like any other.

Links, by the generalised pigeonhole principle: the 64 bits are dealt to parts, correlated bits together, and each part
gets a threshold of its own, -1 for a part that is not used. If the thresholds add up to ``max_bits`` - parts + 1, two
fingerprints within ``max_bits`` are within the threshold in some part. The number of parts and the thresholds are those
of the least estimated cost, found by dynamic programming. Bit frequencies and correlations are measured on all
distinct fingerprints. Each fingerprint is then listed under its value in each part, probed with all values within
the part's threshold, and every candidate is verified on all 64 bits. Any choice gives the same links.

Copies collapse to one fingerprint before anything is joined. The links are those between different fingerprints.

Cases: NULL text counts as empty; rows that repeat an identifier are separate members of their component; a NULL identifier
never names a component unless all its members have none; an empty table gives an empty result; other columns are not
read by ``simhash_components`` and kept by ``simhash_dedup``, whatever their names. Memory is bounded by the longest text.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keysweep.functions.columns import column
from keysweep.llm.components import components
from keysweep.llm.shipping import ship
from keysweep.llm.staging import Stage, columns_of, free_name
from keysweep.llm.text import batch_of, map_pieces, signed

BITS = 64
SHINGLE = 3
MAX_BITS = 3
# Fixed value: seed of XXH64.
SEED = 42
# A candidate is joined, verified and written; it counts as so many probes.
CANDIDATE_COST = 16
MOST_PARTS = 8


def bits_of(fingerprints: np.ndarray) -> np.ndarray:
    """One row of 64 zeros and ones for each unsigned fingerprint, lowest bit first."""
    return np.unpackbits(np.ascontiguousarray(fingerprints).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def fingerprint(text: bytes, shingle: int) -> int:
    words = text.lower().split()
    if not words:
        return 0
    size = min(shingle, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-1]])[: len(words) - size + 1].tolist()
    stops = (ends - 1)[size - 1 :].tolist()
    digest, counts = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for at in range(0, len(starts), 1 << 16):
        part = zip(starts[at : at + (1 << 16)], stops[at : at + (1 << 16)])
        counts += bits_of(np.array([digest(joined[a:b], SEED) for a, b in part], np.uint64)).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(starts), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """(id, fp) of rows of (id, text)."""

    def find(piece: pa.RecordBatch) -> pa.RecordBatch:
        texts = piece.column("text").cast(pa.binary()).to_pylist()
        return batch_of(id=piece.column("id"), fp=signed(np.array([fingerprint(t or b"", shingle) for t in texts], np.uint64)))

    return map_pieces(docs, ["id", "text"], find, "id long, fp long")


def bit_statistics(distinct: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and how often each two bits are both set. The result has a fixed size."""

    def count(batches):
        total, both = 0, np.zeros((BITS, BITS))
        for batch in batches:
            bits = bits_of(batch.column("fp").to_numpy(zero_copy_only=False)).astype(np.float32)
            total, both = total + len(bits), both + bits.T @ bits
        yield batch_of(pos=np.arange(BITS * BITS + 1, dtype=np.int32), n=np.append(both.ravel(), total).astype(np.int64))

    ship(distinct.sparkSession)
    sums = distinct.select("fp").mapInArrow(count, "pos int, n long").groupBy("pos").agg(F.sum("n").alias("n")).collect()
    found = np.zeros(BITS * BITS + 1)
    for row in sums:
        found[row.pos] = row.n
    return int(found[-1]), found[:-1].reshape(BITS, BITS)


@dataclass(frozen=True)
class Part:
    bits: tuple[int, ...]
    threshold: int

    @property
    def mask(self) -> int:
        return sum(1 << b for b in self.bits)

    @property
    def flips(self) -> list[int]:
        """What to change in a value to reach all values within the threshold."""
        return [sum(1 << b for b in chosen) for d in range(self.threshold + 1) for chosen in combinations(self.bits, d)]


def grouped(correlation: np.ndarray, parts: int) -> list[tuple[int, ...]]:
    """Bits dealt to parts of equal size, each grown by the bit most correlated with it so far."""
    left, out = set(range(len(correlation))), []
    for i in range(parts):
        size = len(left) // (parts - i)
        order = sorted(left)
        own = [max(order, key=lambda b: (correlation[b, order].sum(), -b))]
        left.remove(own[0])
        while len(own) < size:
            best = max(sorted(left), key=lambda b: (correlation[b, own].sum(), -b))
            own.append(best)
            left.remove(best)
        out.append(tuple(sorted(own)))
    return out


def differing(chance: Sequence[float], most: int) -> list[float]:
    """Chance that at most 0, 1, .. ``most`` bits differ, if bit i does so with ``chance[i]``, each by itself."""
    exact = np.zeros(most + 1)
    exact[0] = 1
    for p in chance:
        exact = exact * (1 - p) + np.append(0, exact[:-1]) * p
    return np.cumsum(exact).tolist()


def allocate(groups: Sequence[tuple[int, ...]], chance: np.ndarray, total: int, max_bits: int) -> tuple[float, list[Part]]:
    """Thresholds of the least cost that add up to max_bits - parts + 1, and that cost."""
    pairs = total * (total - 1) / 2
    budget = max_bits - len(groups) + 1
    best: dict[int, tuple[float, list[Part]]] = {0: (0.0, [])}
    for group in groups:
        within = differing(chance[list(group)], max_bits)
        following: dict[int, tuple[float, list[Part]]] = {}
        for spent, (cost, chosen) in best.items():
            for t in range(-1, min(max_bits, len(group)) + 1):
                own = 0.0
                if t >= 0:
                    probes = total * (1 + sum(comb(len(group), d) for d in range(t + 1)))
                    own = probes + CANDIDATE_COST * pairs * within[t]
                known = following.get(spent + t)
                if known is None or cost + own < known[0]:
                    following[spent + t] = (cost + own, [*chosen, Part(group, t)])
        best = following
    cost, chosen = best[budget]
    return cost, [p for p in chosen if p.threshold >= 0]


def plan_parts(total: int, both: np.ndarray, max_bits: int) -> list[Part]:
    """The parts of the least estimated cost for ``total`` fingerprints whose bits are set together ``both`` times."""
    share = np.diag(both) / max(total, 1)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12))
    correlation = np.abs(both / max(total, 1) - np.outer(share, share)) / np.outer(spread, spread)
    np.fill_diagonal(correlation, 0)
    chance = 2 * share * (1 - share)
    most = max(1, min(MOST_PARTS, max_bits + 1))
    return min((allocate(grouped(correlation, m), chance, total, max_bits) for m in range(1, most + 1)), key=lambda x: x[0])[1]


def links(distinct: DataFrame, parts: Sequence[Part], max_bits: int) -> DataFrame:
    """(a, b) of different fingerprints within ``max_bits``, once or more often."""
    as_long = lambda x: F.lit(x - (1 << BITS) if x >> (BITS - 1) else x).cast("bigint")
    fp = F.col("fp")
    listed = F.array(*[F.struct(F.lit(i).alias("part"), fp.bitwiseAND(as_long(p.mask)).alias("value")) for i, p in enumerate(parts)])
    known = distinct.select(fp.alias("b"), F.explode(listed).alias("k")).select("b", "k.part", "k.value")
    flips = F.array(*[F.struct(F.lit(i).alias("part"), as_long(f).alias("flip")) for i, p in enumerate(parts) for f in p.flips])
    masks = F.array(*[as_long(p.mask) for p in parts])
    probes = distinct.select(fp.alias("a"), F.explode(flips).alias("k")).select(
        "a", "k.part", F.col("a").bitwiseAND(F.element_at(masks, F.col("k.part") + 1)).bitwiseXOR(F.col("k.flip")).alias("value")
    )
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    return (
        probes.alias("p")
        .join(known.alias("q").hint("merge"), (F.col("p.part") == F.col("q.part")) & (F.col("p.value") == F.col("q.value")) & (F.col("a") < F.col("b")) & close)
        .select("a", "b")
    )


def simhash_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """Per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id (least identifier reachable), root.

    ``root`` is a fingerprint that tells components apart, also those whose members have no identifier.
    """
    if shingle < 1 or not 0 <= max_bits < BITS:
        raise ValueError("shingle must be positive and max_bits between 0 and 63")
    stage = Stage(docs.sparkSession, "simhash")
    marked = stage(fingerprints(docs.select(column(id_col).cast("bigint").alias("id"), column(text_col).alias("text")), shingle), "fingerprints")
    distinct = stage(marked.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
    total, both = bit_statistics(distinct)
    roots = components(links(distinct, plan_parts(total, both, max_bits), max_bits), stage)
    rooted = distinct.join(roots.hint("merge"), distinct["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    rooted = stage(rooted, "rooted")
    named = stage(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "named")
    label = stage(rooted.select("fp", "root").join(named.hint("merge"), "root"), "labels")
    return marked.join(label.hint("merge"), "fp").select(
        F.col("id").alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
        "root",
    )


def simhash_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """The rows of ``docs`` with the least identifier of each component, one of each; columns stay as they are."""
    stage = Stage(docs.sparkSession, "simhash-dedup")
    found = stage(simhash_components(docs, id_col, text_col, shingle, max_bits), "components")
    # Identifiers of one row each are decided by themselves; what goes is less than what stays, and often few.
    ids = found.groupBy("doc_id").agg(F.count("*").alias("rows"), F.max("component_id").alias("component_id"))
    alone = (F.col("rows") == 1) & F.col("doc_id").isNotNull()
    special = stage(ids.filter(~alone).select(F.col("doc_id").alias("own_id")), "special")
    own, mark = free_name(docs, "own_id"), free_name(docs, "own_fp")
    gone = stage(ids.filter(~alone | (F.col("doc_id") != F.col("component_id"))).select(F.col("doc_id").alias(own)), "gone")
    plain = docs.join(gone, docs[id_col].cast("bigint").eqNullSafe(gone[own]), "left_anti")
    if special.isEmpty():
        return plain
    # One identifier may stand for several rows and texts; of a component only the least fingerprint stays then.
    kept = found.join(special, found["doc_id"].eqNullSafe(special["own_id"]), "left_semi")
    kept = kept.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("doc_id", "root").agg(F.min("fingerprint").alias(mark))
    several = stage(kept.select(F.col("doc_id").alias(own), mark), "several")
    return plain.unionByName(first_copies(docs, several, id_col, text_col, shingle, own, mark))


def first_copies(docs: DataFrame, several: DataFrame, id_col: str, text_col: str, shingle: int, own: str, mark: str) -> DataFrame:
    """One row of each of ``several``, identifiers that stand for more than one row, by the fingerprint of its text."""
    rows = docs.join(several.select(own).distinct(), docs[id_col].cast("bigint").eqNullSafe(F.col(own)), "left_semi")
    whole = free_name(docs, "own_row")
    rows = rows.select(*columns_of(docs), F.struct(*columns_of(docs)).alias(whole))
    texts = rows.select(column(id_col).cast("bigint").alias("id"), column(text_col).alias("text")).distinct()

    def find(piece: pa.RecordBatch) -> pa.RecordBatch:
        raw = piece.column("text").cast(pa.binary()).to_pylist()
        return batch_of(id=piece.column("id"), text=piece.column("text"), fp=signed(np.array([fingerprint(t or b"", shingle) for t in raw], np.uint64)))

    marked = map_pieces(texts, ["id", "text"], find, "id long, text string, fp long").select(
        F.col("id").alias(own), F.col("text").alias("t"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias(mark)
    )
    chosen = marked.join(several.select(own, mark), marked[own].eqNullSafe(several[own]) & (marked[mark] == several[mark]), "left_semi")
    chosen = chosen.groupBy(own, mark).agg(F.min("t").alias("t"))
    met = rows.join(chosen, rows[id_col].cast("bigint").eqNullSafe(chosen[own]) & rows[text_col].eqNullSafe(chosen["t"]))
    digest = F.to_json(F.col(whole))
    return met.groupBy(own, mark).agg(F.min_by(F.col(whole), digest).alias(whole)).select(f"{whole}.*")
