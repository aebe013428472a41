"""Near-duplicate documents by SimHash fingerprints and the generalised pigeonhole principle.

A fingerprint has 64 bits; two of them are linked if they differ in at most ``distance`` bits.
The bits are grouped into partitions, correlated ones together, and each partition gets a
threshold, so that the thresholds plus one add up to distance + 1: a linked pair is then within
the threshold of at least one partition. Several numbers of partitions are laid out; for each,
dynamic programming chooses the thresholds that cost least, from the number of equal pairs in a
partition, counted over all fingerprints, and its growth with the threshold, from the bits'
frequencies. A threshold of -1 leaves a partition out; a higher one is probed by flipping bits.

Equal fingerprints are one row from the start. A bucket (partition, value) is searched by one
task in blocks: a bucket with more rows than ``block`` is cut, and every two of its blocks are a
group of their own. A group yields a spanning forest of its links, not the links themselves, so
a dense group of n near copies gives n - 1 rows. Components are then contracted by large-star and
small-star steps on tables in the shared folder.

Defined results for odd input: a null or empty text has no words and fingerprint zero, which is
linked like any other; a null doc_id keeps its row and is never the smallest id unless its
component has no other; repeated rows keep their rows; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrid.llm.common import partitions, without
from tallygrid.staging import Staging

BITS = 64
DISTANCE = 4
SHINGLE = 4
SEED = 42
SLICE = 1 << 15
BLOCK = 2048
LAYOUTS = (3, 4, 5)
ROW_COST, PAIR_COST = 4e-6, 4e-9  # seconds for a probed row and for a compared pair


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Majority of the bits of the hashes of all shingles."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    n = max(1, len(words) - shingle + 1)
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    stops = ends[min(shingle, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    votes = np.zeros(BITS, np.int64)
    for at in range(0, n, SLICE):
        part = [digest(joined[a:b], SEED) for a, b in zip(starts[at : at + SLICE], stops[at : at + SLICE])]
        hashes = np.array(part, dtype=">u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array(
                [fingerprint(t.as_py()) for t in batch.column(1)], dtype=np.uint64
            ).view(np.int64)
            yield pa.record_batch([batch.column(0), pa.array(values)], names=["doc_id", "fp"])

    return docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string")).mapInArrow(
        run, "doc_id long, fp long"
    )


# --- layout of the bits


def bit_sums(prints: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and how often each two bits are both set, over all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS, BITS))
        rows = 0
        for batch in batches:
            values = batch.column(0).to_numpy().astype(">i8").view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(values, axis=1).astype(np.float32)
            total += bits.T @ bits
            rows += len(bits)
        cells = np.append(total.ravel(), rows)
        yield pa.record_batch([np.arange(len(cells)), cells], names=["cell", "n"])

    cells = prints.mapInArrow(run, "cell long, n double").groupBy("cell").agg(F.sum("n").alias("n"))
    found = np.zeros(BITS * BITS + 1)
    for cell, n in cells.collect():  # 4097 numbers, whatever the input
        found[cell] = n
    return int(found[-1]), found[:-1].reshape(BITS, BITS)


def grouped_bits(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Bits dealt into partitions of about equal width, correlated ones together."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    related = np.abs(both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread)
    left, groups = list(range(BITS)), []
    for i in range(parts):
        width = BITS // parts + (i < BITS % parts)
        rest = np.ix_(left, left)
        group = [left[int(np.argmax(related[rest].sum(1)))]]
        left.remove(group[0])
        while len(group) < width:
            best = left[int(np.argmax(related[np.ix_(left, group)].sum(1)))]
            group.append(best)
            left.remove(best)
        groups.append(sorted(group))
    return groups


def growth(p: np.ndarray, bits: list[int], most: int) -> np.ndarray:
    """Pairs within 0, 1, ... ``most`` differing bits of a partition, as a multiple of equal pairs."""
    odds = np.zeros(most + 1)
    odds[0] = 1.0
    for j in bits:
        differ = 2 * p[j] * (1 - p[j])
        odds[1:] += odds[:-1].copy() * (differ / max(1 - differ, 1e-12))
    return np.cumsum(odds)


def allocate(costs: np.ndarray, total: int) -> list[int]:
    """Thresholds, -1 and up, one per row of ``costs`` (cost of thresholds 0, 1, ...), that cost
    least while the thresholds plus one add up to ``total``."""
    parts = len(costs)
    best = np.full((parts + 1, total + 1), np.inf)
    choice = np.zeros((parts + 1, total + 1), int)
    best[0, 0] = 0.0
    for i in range(parts):
        for have in range(total + 1):
            for use in range(total - have + 1):
                cost = best[i, have] + (costs[i, use - 1] if use else 0.0)
                if cost < best[i + 1, have + use]:
                    best[i + 1, have + use], choice[i + 1, have + use] = cost, use
    have, out = total, []
    for i in range(parts, 0, -1):
        out.append(int(choice[i, have]) - 1)
        have -= choice[i, have]
    return out[::-1]


@dataclass(frozen=True)
class Layout:
    bits: tuple[tuple[int, ...], ...]
    thresholds: tuple[int, ...]


def _masks(bits) -> np.int64:
    return np.array([sum(1 << (BITS - 1 - b) for b in bits)], np.uint64).view(np.int64)[0]


def plan_layout(
    prints: DataFrame, distance: int = DISTANCE, layouts: tuple[int, ...] = LAYOUTS
) -> Layout:
    """The cheapest partitions and thresholds, from statistics of all fingerprints."""
    n, both = bit_sums(prints)
    p = np.diag(both) / max(n, 1)
    options = {m: grouped_bits(n, both, m) for m in layouts}
    parts = [(m, i, int(_masks(g))) for m, groups in options.items() for i, g in enumerate(groups)]
    keys = F.array(
        *[
            F.struct(F.lit(k).alias("option"), F.col("fp").bitwiseAND(F.lit(mask)).alias("value"))
            for k, (_, _, mask) in enumerate(parts)
        ]
    )
    equal = (
        prints.select(F.inline(keys))
        .groupBy("option", "value")
        .count()
        .groupBy("option")
        .agg(F.sum(F.col("count").cast("double") * F.col("count")).alias("pairs"))
        .collect()
    )
    pairs = {r["option"]: r["pairs"] for r in equal}
    best: tuple[float, Layout] | None = None
    for m, groups in options.items():
        costs = np.zeros((m, distance + 1))
        for k, (own, i, _) in enumerate(parts):
            if own == m:
                grown = growth(p, groups[i], distance) * pairs.get(k, 0.0)
                balls = np.cumsum([comb(len(groups[i]), t) for t in range(distance + 1)])
                costs[i] = grown * PAIR_COST + max(n, 1) * balls * ROW_COST
        chosen = allocate(costs, distance + 1)
        cost = sum(costs[i, t] for i, t in enumerate(chosen) if t >= 0)
        if best is None or cost < best[0]:
            best = cost, Layout(tuple(map(tuple, groups)), tuple(chosen))
    return best[1]


# --- candidates and links


def probes(prints: DataFrame, layout: Layout) -> DataFrame:
    """part, value, fp, own: own rows of every partition, and those with flipped bits."""
    rows = []
    for i, (bits, threshold) in enumerate(zip(layout.bits, layout.thresholds, strict=True)):
        value = F.col("fp").bitwiseAND(F.lit(int(_masks(bits))))
        for flips in range(threshold + 1):
            for chosen in combinations(bits, flips):
                rows.append(
                    F.struct(
                        F.lit(i).alias("part"),
                        value.bitwiseXOR(F.lit(int(_masks(chosen)))).alias("value"),
                        F.lit(flips == 0).alias("own"),
                    )
                )
    return prints.select("fp", F.inline(F.array(*rows)))


def _forest(values: np.ndarray, own: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """(member, smallest of its tree) for all that are linked, breadth first."""
    values = values.view(np.uint64)
    n = len(values)
    if n <= 256:
        near = np.bitwise_count(values[:, None] ^ values) <= distance
        if np.count_nonzero(near) == n:
            return []
    out, todo = [], np.ones(n, bool)
    for first in range(n):
        if not todo[first]:
            continue
        todo[first] = False
        queue, at = [first], 0
        while at < len(queue):
            u = queue[at]
            at += 1
            near = todo & (np.bitwise_count(values ^ values[u]) <= distance)
            if not own[u]:
                near &= own
            found = np.flatnonzero(near)
            todo[found] = False
            queue.extend(found.tolist())
        if len(queue) > 1:
            tree = np.unique(values[queue].view(np.int64))
            out.extend((int(v), int(tree[0])) for v in tree[1:])
    return out


def links(prints: DataFrame, layout: Layout, staging: Staging, distance: int, block: int) -> DataFrame:
    """u > v of spanning forests over all fingerprints that are linked."""
    probed = probes(prints, layout)
    large = staging.write(
        "large_buckets",
        probed.groupBy("part", "value")
        .count()
        .where(F.col("count") > block)
        .select("part", "value", F.ceil(F.col("count") * 2 / F.lit(block)).cast("int").alias("blocks")),
    )
    blocks = F.coalesce("blocks", F.lit(1))
    mine = F.pmod(F.xxhash64("fp"), blocks).cast("int")
    pairs = F.when(
        blocks > 1,
        F.transform(
            F.filter(F.sequence(F.lit(0), blocks - 1), lambda j: j != F.col("_mine")),
            lambda j: F.struct(
                F.least(j, F.col("_mine")).alias("i"), F.greatest(j, F.col("_mine")).alias("j")
            ),
        ),
    ).otherwise(F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j"))))
    dealt = (
        probed.join(large, ["part", "value"], "left")
        .withColumn("_mine", mine)
        .select("part", "value", "fp", "own", F.inline(pairs))
    )
    keys = ["part", "value", "i", "j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        out: list[tuple[int, int]] = []
        for batch in batches:
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(6)]
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols, strict=True)]
            if not len(cols[0]):
                continue
            change = np.zeros(len(cols[0]), bool)
            for c in cols[:4]:
                change[1:] |= c[1:] != c[:-1]
            cuts = [0, *np.flatnonzero(change).tolist()]
            for a, b in zip(cuts, cuts[1:]):
                if b - a > 1:
                    out.extend(_forest(cols[4][a:b], cols[5][a:b], distance))
            held = [c[cuts[-1] :] for c in cols]
            if len(out) > 10_000:
                yield pa.RecordBatch.from_pylist([{"u": u, "v": v} for u, v in out], schema=EDGES)
                out = []
        if held is not None and len(held[0]) > 1:
            out.extend(_forest(held[4], held[5], distance))
        if out:
            yield pa.RecordBatch.from_pylist([{"u": u, "v": v} for u, v in out], schema=EDGES)

    ordered = dealt.select(*keys, "fp", "own").repartition(*keys).sortWithinPartitions(*keys)
    return ordered.mapInArrow(run, "u long, v long").distinct()


EDGES = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def components(edges: DataFrame, staging: Staging) -> DataFrame:
    """node and root (smallest node) of every node with an edge u > v, but the roots themselves."""

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("u"), F.bit_xor(F.xxhash64("u", "v"))).first())

    edges = staging.write("edges", edges)
    before = state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.where(F.col("v") > F.col("u"))
            .join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        large = staging.write("large_star", large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .where(F.col("v") != F.col("m"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.withColumnRenamed("m", "v"))
            .distinct()
        )
        edges = staging.write("small_star", small)
        after = state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def near_duplicates(
    docs: DataFrame, staging: Staging, distance: int = DISTANCE, block: int = BLOCK
) -> DataFrame:
    """doc_id, fp and component_id, the smallest doc_id that links lead to, for every row."""
    prints = staging.write("fingerprints", fingerprints(docs))
    classes = staging.write("classes", prints.groupBy("fp").agg(F.min("doc_id").alias("smallest")))
    found = classes.select("fp")
    layout = plan_layout(found, distance)
    roots = components(links(found, layout, staging, distance, block), staging)
    # The roots are members as well.
    roots = roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
    # A component may hold a third of all rows: it is split by fingerprint on the way back as well.
    split = F.pmod(F.xxhash64("node"), F.lit(partitions(docs.sparkSession))).cast("int").alias("split")
    linked = staging.write(
        "linked", roots.join(classes, F.col("fp") == F.col("node")).select("node", "root", "smallest", split)
    )
    parts = linked.groupBy("root", "split").agg(F.min("smallest").alias("smallest"))
    smallest = parts.groupBy("root").agg(
        F.min("smallest").alias("component_id"), F.collect_set("split").alias("splits")
    ).select("root", "component_id", F.explode("splits").alias("split"))
    ids = linked.join(smallest, ["root", "split"]).select("node", "component_id")
    named = classes.join(ids, F.col("fp") == F.col("node"), "left").select(
        "fp", F.when(F.col("node").isNull(), F.col("smallest")).otherwise(F.col("component_id")).alias("component_id")
    )
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def simhash_table(docs: DataFrame, staging: Staging) -> DataFrame:
    """doc_id, the fingerprint in hexadecimal digits, component_id."""
    return near_duplicates(docs, staging).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def deduplicated(docs: DataFrame, staging: Staging) -> DataFrame:
    """One document of every component: the one whose id names it."""
    stays = F.max(F.col("doc_id").eqNullSafe(F.col("component_id")))
    rows = near_duplicates(docs, staging).groupBy("doc_id").agg(stays.alias("stays"))
    gone = staging.write("copies", rows.where(~F.col("stays")).select("doc_id"))
    return without(docs, [docs["doc_id"].cast("long")], gone)
