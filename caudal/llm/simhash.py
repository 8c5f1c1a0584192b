"""SimHash near-dedup with a Gray-order hierarchical index.

A fingerprint bit is 1 if it is set in over half of the hashes of a text's word shingles. Fingerprints that differ in at most
`radius` bits are links; documents that links connect are one group.

The index, over distinct fingerprints:

1. Upper nodes are masked bit patterns that fingerprints share. With exact masks (segments minus radius of the segments kept),
   any two fingerprints within the radius share at least one node. Sampled masks, for wide fingerprints and large radii, find
   a pair with a probability that masks and mask_bits set (recall()).
2. Nodes with over `node_rows` fingerprints are split: the bits still free are cut into radius + 1 segments, of which one must
   agree, and a node with no more free bits than the radius is a group as it is. With sampled masks such a node is cut into
   parts by id, and each pair of parts is a block of its own: no pair is lost, and the work grows with the square of the node.
3. Inside a node fingerprints stand in the order of their Gray rank, so that neighbours share most bits. Runs of 64 are
   leaves with a pattern of common bits. Whole pairs of leaves are pruned if the differences accumulated in their common bits
   exceed the radius, and are skipped if they are one component already.
4. A node gives at most one edge for each fingerprint, to the first of its local component. Edges of all nodes are joined to
   components in rounds.

So copies, near copies and hot patterns never become all pairs, and no group is held whole in a task beyond node_rows.

drop_near_duplicates takes the index as a search for candidates and keeps those whose shingle sets have the wanted Jaccard
similarity, exactly (by 64-bit hashes of the shingles). Texts with equal sets are one beforehand. A first look, under few masks,
verifies the nearest and the first neighbour of each fingerprint, which joins most of a large group. The second look gives every
pair within the radius that shares a node and is not in one group yet: once, from the first mask the two share. Pairs that cannot
be similar enough are left out where they are found: by the sizes of their sets, and by odd sketches. An odd sketch is a string of
bits of which every shingle turns one over, so two sketches never differ in more bits than the sets in shingles: what it rules out
is surely under the similarity. It tells best up to some 500 shingles. What it leaves within the radius is verified, so many
long texts of one template still cost the square of their number.

Defined results: NULL and empty texts, and texts without words, have fingerprint zero and link like any other. Fewer words
than a shingle has are one shingle. Rows with a NULL doc_id have a fingerprint and no component, and are not removed. Rows
with equal doc_id count as one document in components; one of them stays, the first by text. Other columns, whatever their names,
pass through.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caudal.llm.common import mapped, stored
from caudal.llm.components import connected_components

SEED = 42
LEAF = 64
SMALL_NODE = 32
FIRST_LOOK = 32
SKETCH = 4  # 64-bit words of an odd sketch
SKETCHED = [f"s{i}" for i in range(SKETCH)]


@dataclass(frozen=True)
class Index:
    """words: 64-bit words of a fingerprint; segments (exact masks) or masks and mask_bits (sampled masks)."""

    radius: int = 2
    words: int = 1
    segments: int | None = 4
    masks: int = 64
    mask_bits: int = 18
    node_rows: int = 20_000
    seed: int = 11

    def upper_masks(self) -> list[tuple[int, ...]]:
        bits = 64 * self.words
        if self.segments:
            cut = [sum(1 << b for b in range(bits) if b * self.segments // bits == s) for s in range(self.segments)]
            return [_as_words(sum(kept), self.words) for kept in combinations(cut, self.segments - self.radius)]
        draw = np.random.Generator(np.random.PCG64(self.seed))
        return [_as_words(sum(1 << int(b) for b in draw.choice(bits, self.mask_bits, replace=False)), self.words) for _ in range(self.masks)]


def similar(similarity: float = 0.8, words: int = 2, masks: int = 112, mask_bits: int = 14, spread: float = 4.0) -> Index:
    """An index for texts whose shingle sets are so similar (Jaccard): the distance expected there, and `spread` standard deviations."""
    bits, angle = 64 * words, math.acos(2 * similarity / (1 + similarity)) / math.pi
    return Index(math.ceil(bits * angle + spread * math.sqrt(bits * angle * (1 - angle))), words, None, masks, mask_bits)


def recall(index: Index, similarity: float) -> float:
    """Share of pairs of a similarity that are within the radius and meet in a node, for sampled masks: the mean over distances."""
    bits, differ = 64 * index.words, math.acos(min(1.0, 2 * similarity / (1 + similarity))) / math.pi
    missed = lambda d: (1 - math.comb(bits - d, index.mask_bits) / math.comb(bits, index.mask_bits)) ** index.masks
    return sum(math.comb(bits, d) * differ**d * (1 - differ) ** (bits - d) * (1 - missed(d)) for d in range(index.radius + 1))


def _as_words(mask: int, words: int) -> tuple[int, ...]:
    parts = [mask >> (64 * w) & (2**64 - 1) for w in range(words)]
    return tuple(p - 2**64 if p >= 2**63 else p for p in parts)


def shingle_hashes(text: str | None, shingle: int) -> np.ndarray:
    """A hash of each word shingle, in order."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not tokens:
        return np.zeros(0, dtype=np.uint64)
    ends = np.cumsum([len(t) + 1 for t in tokens])
    plain, n = b" ".join(tokens), max(1, len(tokens) - shingle + 1)
    starts, stops = [0, *ends[: n - 1].tolist()], [*(ends[shingle - 1 : shingle - 1 + n] - 1).tolist()] or [len(plain)]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(plain[a:b], SEED) for a, b in zip(starts, stops)), dtype=np.uint64, count=n)


def text_fingerprint(text: str | None, shingle: int = 3, words: int = 1) -> list[int]:
    """The fingerprint's words, as unsigned numbers."""
    return _print(shingle_hashes(text, shingle), words)


def _print(hashes: np.ndarray, words: int) -> list[int]:
    n = len(hashes)
    counts = np.zeros(64 * words, dtype=np.int64)
    for s in range(0, n, 65536):
        part = hashes[s : s + 65536]
        wide = np.stack([part if w == 0 else _mixed(part, w) for w in range(words)], axis=1)
        counts += np.unpackbits(wide.astype("<u8").view(np.uint8).reshape(len(part), 8 * words), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(counts * 2 > n, bitorder="little").view("<u8").tolist()


def _mixed(h: np.ndarray, w: int) -> np.ndarray:
    """Further hashes from a hash."""
    x = h + np.uint64(w * 0x9E3779B97F4A7C15 % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprints(docs: DataFrame, shingle: int = 3, words: int = 1, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, w0, w1, ... (bigint): a row for each row of docs."""

    def work(batches) -> Iterator[dict]:
        for batch in batches:
            texts = batch.column(1)
            found = np.array([text_fingerprint(t.as_py(), shingle, words) for t in texts], dtype=np.uint64).reshape(-1, words).view(np.int64)
            yield {"doc_id": batch.column(0), **{f"w{i}": found[:, i] for i in range(words)}}

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return mapped(rows, work, "doc_id bigint, " + ", ".join(f"w{i} bigint" for i in range(words)))


def gray_rank(word: Column) -> Column:
    """Place of a pattern in the Gray-code order, as a number that sorts so."""
    rank = word
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, shift))
    return rank.bitwiseXOR(F.lit(-(2**63)))


def _at_node(names: list[str]) -> Column:
    return F.xxhash64("mask", *[F.col(n).bitwiseAND(F.col("masks")[i]) for i, n in enumerate(names)])


def links(prints: DataFrame, index: Index) -> DataFrame:
    """Edges a, b that connect what lies within the radius. prints: id, w0, ...; distinct fingerprints."""
    names = [f"w{i}" for i in range(index.words)]
    masks = dict(enumerate(index.upper_masks()))
    literal = lambda ids: F.array(*[F.struct(F.lit(i).alias("mask"), F.array(*[F.lit(w).cast("bigint") for w in masks[i]]).alias("masks")) for i in ids])
    rows = prints.select("id", *names, F.inline(literal(masks)))
    edges = []
    while True:
        placed = rows.withColumn("node", _at_node(names))
        hot = stored(placed.groupBy("mask", "node").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > index.node_rows).select("mask", "node", F.col("n").alias("node_n")), "large-nodes")
        here = sorted(r.mask for r in hot.select("mask").distinct().collect())  # masks are few, whatever the data
        if not here:
            edges.append(_resolved(placed, names, index))
            break
        edges.append(_resolved(placed.join(hot, ["mask", "node"], "left_anti"), names, index))
        large, rows = placed.join(hot, ["mask", "node"]), None
        if not index.segments:
            edges.append(_resolved(_blocks(large, index), names, index))
            break
        for i in here:
            mine = large.filter(F.col("mask") == i)
            free = [b for b in range(64 * index.words) if not (masks[i][b // 64] >> (b % 64)) & 1]
            if len(free) <= index.radius:
                edges.append(mine.groupBy("node").agg(F.min("id").alias("b")).join(mine, "node").select(F.col("id").alias("a"), "b"))
                continue
            kept = sum((w & (2**64 - 1)) << (64 * k) for k, w in enumerate(masks[i]))
            cuts = [[b for k, b in enumerate(free) if k * (index.radius + 1) // len(free) == s] for s in range(index.radius + 1)]
            children = []
            for cut in cuts:
                child = kept | sum(1 << b for b in cut)
                masks[len(masks)] = _as_words(child, index.words)
                children.append(len(masks) - 1)
            split = mine.select("id", *names, F.inline(literal(children)))
            rows = split if rows is None else rows.unionAll(split)
        if rows is None:
            break
        rows = stored(rows, "split-nodes")
    out = edges[0]
    for more in edges[1:]:
        out = out.unionAll(more)
    return out.filter("a <> b").distinct()


def _parts(index: Index) -> Column:
    return F.ceil(F.col("node_n") / max(1, index.node_rows // 2))


def _paired(large: DataFrame, index: Index) -> DataFrame:
    """Rows of large nodes, once for each pair of parts (low, high) that theirs is in. side tells the two apart, and is 0 in the pair of a part with itself."""
    mine = large.withColumn("part", F.pmod(F.xxhash64("id"), _parts(index)))
    both = mine.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), _parts(index) - 1)))
    side = F.when(F.col("part") == F.col("other"), 0).when(F.col("part") < F.col("other"), 1).otherwise(2)
    return both.withColumns({"low": F.least("part", "other"), "high": F.greatest("part", "other"), "side": side}).drop("part", "other", "node_n")


def _blocks(large: DataFrame, index: Index) -> DataFrame:
    return _paired(large, index).withColumn("node", F.xxhash64("node", "low", "high")).drop("low", "high")


def _resolved(placed: DataFrame, names: list[str], index: Index) -> DataFrame:
    """Edges inside nodes. A task reads its nodes one after another, in Gray order."""
    radius = index.radius

    def work(batches) -> Iterator[dict]:
        for node, ids, *prints in _whole_nodes(batches):
            yield _edges(node, ids, np.stack(prints, axis=1).view(np.uint64), radius)

    rows = placed.select("node", "id", *names).repartition("node").sortWithinPartitions("node", *[gray_rank(F.col(n)) for n in names])
    return mapped(rows, work, "a bigint, b bigint")


def _whole_nodes(batches) -> Iterator[list[np.ndarray]]:
    """The batches' columns, the first of which is the node, cut so that no node is in two."""
    carry = None
    for batch in batches:
        cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(batch.num_columns)]
        if carry is not None:
            cols = [np.concatenate(x) for x in zip(carry, cols)]
        cut = np.flatnonzero(cols[0] != cols[0][-1]) if len(cols[0]) else []
        cut = cut[-1] + 1 if len(cut) else 0
        carry = [c[cut:] for c in cols]
        if cut:
            yield [c[:cut] for c in cols]
    if carry is not None and len(carry[0]):
        yield carry


def _edges(node: np.ndarray, ids: np.ndarray, prints: np.ndarray, radius: int) -> dict:
    labels = local_components(node, prints, radius)
    linked = np.flatnonzero(labels != np.arange(len(labels)))
    return {"a": ids[linked], "b": ids[labels[linked]]}


def local_components(node: np.ndarray, prints: np.ndarray, radius: int) -> np.ndarray:
    """For each row the first row of its component; rows of a node are neighbours, in Gray order."""
    n = len(node)
    labels = np.arange(n)
    starts = np.flatnonzero(np.concatenate(([True], node[1:] != node[:-1])))
    sizes = np.diff(np.concatenate((starts, [n])))
    large = sizes > SMALL_NODE
    left = np.repeat(np.where(large, 0, sizes), sizes) - (np.arange(n) - np.repeat(starts, sizes))  # rows from here to the node's end
    found = []
    for lag in range(1, SMALL_NODE):
        rows = np.flatnonzero(left > lag)
        if not len(rows):
            break
        near = rows[np.bitwise_count(prints[rows] ^ prints[rows + lag]).sum(axis=1) <= radius]
        found.append((near, near + lag))
    if found:
        a, b = (np.concatenate(x) for x in zip(*found))
        while len(a):
            low = np.minimum(labels[a], labels[b])
            before = labels.copy()
            np.minimum.at(labels, labels[a], low)
            np.minimum.at(labels, labels[b], low)
            np.minimum.at(labels, a, low)
            np.minimum.at(labels, b, low)
            labels = labels[labels]
            if np.array_equal(before, labels):
                break
    for s, size in zip(starts[large], sizes[large]):
        labels[s : s + size] = s + _large_node(prints[s : s + size], radius)
    return labels


def _large_node(prints: np.ndarray, radius: int) -> np.ndarray:
    """Components of one node, by leaves of neighbours in Gray order."""
    n = len(prints)
    starts = np.arange(0, n, LEAF)
    both, any_ = np.bitwise_and.reduceat(prints, starts), np.bitwise_or.reduceat(prints, starts)
    common = ~(both ^ any_)
    labels = np.arange(n)
    for leaf, s in enumerate(starts):
        e = min(n, s + LEAF)
        if np.bitwise_count(~common[leaf]).sum() <= radius:  # all within the radius of each other
            _merge(labels, labels[s:e], np.full(e - s, labels[s]))
        apart = np.bitwise_count((both[leaf] ^ both[leaf:]) & common[leaf] & common[leaf:]).sum(axis=1)
        low, high = np.minimum.reduceat(labels, starts[leaf:]), np.maximum.reduceat(labels, starts[leaf:])
        one = (low == high) & (low == low[0]) & (low[0] == high[0])
        for other in np.flatnonzero((apart <= radius) & ~one):
            t = starts[leaf + other]
            f = min(n, t + LEAF)
            x, y = np.nonzero(np.bitwise_count(prints[s:e, None] ^ prints[None, t:f]).sum(axis=2) <= radius)
            _merge(labels, labels[s + x], labels[t + y])
    return labels


def _merge(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give the components of each a and its b one label, the smallest, in place."""
    pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = up
        return x

    for x, y in pairs[pairs[:, 0] != pairs[:, 1]].tolist():
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    if parent:
        table = np.arange(len(labels))
        for x in list(parent):
            table[x] = root(x)
        labels[:] = table[labels]


def groups(prints: DataFrame, index: Index) -> DataFrame:
    """component_id (smallest doc_id of the group) of each distinct fingerprint: w0, ..., first_doc, component_id.

    prints: doc_id, w0, ...; read more than once, so a stored table.
    """
    names = [f"w{i}" for i in range(index.words)]
    distinct = stored(prints.filter("doc_id is not null").groupBy(*names).agg(F.min("doc_id").alias("first_doc")), "distinct-prints")
    edges = links(distinct.select(F.col("first_doc").alias("id"), *names), index)
    # a doc_id that has several fingerprints is one document
    several = prints.filter("doc_id is not null").select("doc_id", *names).distinct().join(distinct, names).filter("doc_id <> first_doc")
    twice = prints.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("doc_id")
    edges = edges.unionAll(several.join(twice, "doc_id", "left_semi").select(F.col("doc_id").alias("a"), F.col("first_doc").alias("b")))
    found = connected_components(edges)
    return distinct.join(found.withColumnRenamed("node", "first_doc"), "first_doc", "left").withColumn("component_id", F.coalesce("component", "first_doc")).drop("component")


def near_duplicate_groups(docs: DataFrame, index: Index = Index(), shingle: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, w0, ..., component_id: a row for each row of docs."""
    prints = stored(fingerprints(docs, shingle, index.words, doc_id, text), "fingerprints")
    names = [f"w{i}" for i in range(index.words)]
    component = groups(prints, index).select(*names, "component_id")
    known = prints.join(component, names, "left")
    return known.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id")))


def odd_sketch(distinct: np.ndarray) -> list[int]:
    """Bits that are 1 where an odd number of the hashes falls."""
    return np.packbits(np.bincount((distinct >> np.uint64(56)).astype(np.int64), minlength=64 * SKETCH) & 1, bitorder="little").view("<u8").tolist()


def shingle_sets(docs: DataFrame, shingle: int, words: int, doc_id: str, text: str) -> DataFrame:
    """doc_id, w0, ..., n (distinct shingles), k0, k1 (hash of the set of shingles), s0, ... (its odd sketch): a row for each row of docs."""
    names = [*[f"w{i}" for i in range(words)], "n", "k0", "k1", *SKETCHED]

    def work(batches) -> Iterator[dict]:
        for batch in batches:
            found = []
            for t in batch.column(1):
                hashes = shingle_hashes(t.as_py(), shingle)
                distinct = np.unique(hashes)
                key = xxhash.xxh3_128_intdigest(distinct.tobytes())
                found.append([*_print(hashes, words), len(distinct), key >> 64, key & (2**64 - 1), *odd_sketch(distinct)])
            table = np.array(found, dtype=np.uint64).reshape(-1, len(names)).view(np.int64)
            yield {"doc_id": batch.column(0), **{c: table[:, i] for i, c in enumerate(names)}}

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return mapped(rows, work, ", ".join(f"{c} bigint" for c in ["doc_id", *names]))


def _under(sets: DataFrame, masks: int) -> DataFrame:
    """Each row once for each mask, in many tasks also where few files hold the table."""
    tasks = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return sets.repartition(tasks, "id").select("*", F.explode(F.sequence(F.lit(0), F.lit(masks - 1))).alias("mask"))


def _node_of(names: list[str], masks: list[tuple[int, ...]]) -> Column:
    """The node of a row under its mask. It follows from the other columns, so a shuffle need not carry it."""
    mine = F.get(F.array(*[F.array(*[F.lit(w).cast("bigint") for w in m]) for m in masks]), F.col("mask"))
    return F.xxhash64("mask", *[F.col(n).bitwiseAND(F.get(mine, F.lit(i))) for i, n in enumerate(names)])


def _large_nodes(sets: DataFrame, index: Index, names: list[str], masks: list[tuple[int, ...]]) -> DataFrame | None:
    """mask, node, node_n of the nodes with over node_rows rows. Rows are first counted by buckets of nodes, some 16 for each node_rows
    of all rows, which tasks sum up before the shuffle; nodes are then counted in the buckets with over node_rows rows."""
    buckets = 1 << max(10, math.ceil(math.log2(max(1, sets.count() * len(masks) * 16 // index.node_rows))))
    placed = _under(sets.select("id", *names), len(masks)).select("mask", _node_of(names, masks).alias("node")).withColumn("bucket", F.pmod("node", F.lit(buckets)))
    full = stored(placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > index.node_rows).select("bucket"), "large-buckets")
    if full.isEmpty():
        return None
    large = placed.join(full, "bucket", "left_semi").groupBy("mask", "node").agg(F.count(F.lit(1)).alias("node_n")).filter(F.col("node_n") > index.node_rows)
    large = stored(large, "large-nodes")
    return None if large.isEmpty() else large


def _in_nodes(rows: DataFrame, names: list[str], masks: list[tuple[int, ...]], carried: list[str]) -> DataFrame:
    """node and the carried columns, by whole nodes, each in Gray order. rows: mask, names, the carried ones, and the parts low and high of a large node."""
    node = F.xxhash64(_node_of(names, masks), "low", "high")
    sent = rows.select("mask", "low", "high", *[c for c in carried if c != "mask"], *names).repartition(node)
    return sent.select(node.alias("node"), *carried, *names).sortWithinPartitions("node", *[gray_rank(F.col(w)) for w in names])


def _neighbours(sets: DataFrame, index: Index, similarity: float) -> DataFrame:
    """The first look: a, b with the nearest neighbour of each id, and the first by id, under FIRST_LOOK masks. sets: id, w0, ..., n."""
    names, radius, masks = [f"w{i}" for i in range(index.words)], index.radius, index.upper_masks()[:FIRST_LOOK]

    def work(batches) -> Iterator[dict]:
        for node, ids, n, *words in _whole_nodes(batches):
            prints = np.stack(words, axis=1).view(np.uint64)
            starts, _, left = _node_places(node)
            head = np.repeat(starts, np.diff(np.concatenate((starts, [len(node)]))))
            far = np.flatnonzero(np.arange(len(node)) - head >= SMALL_NODE)
            pairs = [(head[far], far)] + [(rows, rows + lag) for lag in range(1, SMALL_NODE) if len(rows := np.flatnonzero(left > lag))]
            a, b = (np.concatenate(x) for x in zip(*pairs))
            apart = np.bitwise_count(prints[a] ^ prints[b]).sum(axis=1)
            fit = np.flatnonzero((apart <= radius) & (ids[a] != ids[b]) & _sizes_fit(n[a], n[b], similarity))
            a, b, apart = np.concatenate((a[fit], b[fit])), np.concatenate((b[fit], a[fit])), np.concatenate((apart[fit], apart[fit])).astype(np.int64)
            for kind, by in ((0, apart), (1, np.zeros_like(apart))):
                order = np.lexsort((ids[b], by, ids[a]))
                order = order[np.flatnonzero(np.concatenate(([True], ids[a[order[1:]]] != ids[a[order[:-1]]])))] if len(order) else order
                yield {"kind": np.full(len(order), kind, dtype=np.int32), "a": ids[a[order]], "apart": by[order], "b": ids[b[order]]}

    rows, large, zero = _under(sets.select("id", "n", *names), len(masks)), _large_nodes(sets, index, names, masks), F.lit(0).cast("bigint")
    if large is not None:  # the first look may read a node in parts
        rows = rows.withColumn("node", _node_of(names, masks)).join(large, ["mask", "node"], "left")
        rows = rows.withColumn("low", F.coalesce(F.pmod(F.xxhash64("id"), _parts(index)), zero)).drop("node", "node_n")
    else:
        rows = rows.withColumn("low", zero)
    rows = _in_nodes(rows.withColumn("high", zero), names, masks, ["id", "n"])
    best = mapped(rows, work, "kind int, a bigint, apart bigint, b bigint").groupBy("kind", "a").agg(F.min(F.struct("apart", "b")).alias("best"))
    return best.select(F.greatest("a", "best.b").alias("a"), F.least("a", "best.b").alias("b")).distinct()


def _candidates(sets: DataFrame, index: Index, similarity: float) -> DataFrame:
    """The second look: all a, b within the radius that share a node, are in no group together and may be similar. sets: id, w0, ..., n, s0, ..., component."""
    names, radius, masks = [f"w{i}" for i in range(index.words)], index.radius, index.upper_masks()
    patterns = np.array(masks, dtype=np.int64).view(np.uint64)

    def work(batches) -> Iterator[dict]:
        for node, mask, ids, n, component, side, *words in _whole_nodes(batches):
            sketch = np.stack(words[:SKETCH], axis=1).view(np.uint64)
            prints = np.stack(words[SKETCH:], axis=1).view(np.uint64)
            for a, b in _pairs(node, prints, component, radius):
                fit = (component[a] != component[b]) & ((side[a] == 0) | (side[a] != side[b])) & _sizes_fit(n[a], n[b], similarity)
                a, b = a[fit], b[fit]
                fit = may_be_similar(sketch[a], sketch[b], n[a], n[b], similarity)
                a, b = a[fit], b[fit]
                differ, new = prints[a] ^ prints[b], np.ones(len(a), dtype=bool)
                for k in range(int(mask[a].max()) if len(a) else 0):
                    new &= (mask[a] <= k) | ((differ & patterns[k]) != 0).any(axis=1)
                a, b = ids[a[new]], ids[b[new]]
                yield {"a": np.maximum(a, b), "b": np.minimum(a, b)}

    carried = ["mask", "id", "n", "component", "side", *SKETCHED]
    columns = ["mask", "low", "high", *carried[1:], *names]
    placed, large, zero = _under(sets, len(masks)), _large_nodes(sets, index, names, masks), F.lit(0).cast("bigint")
    rows = placed.withColumns({"low": zero, "high": zero, "side": F.lit(0)})
    if large is not None:
        by_node = placed.withColumn("node", _node_of(names, masks))
        rows = rows.withColumn("node", _node_of(names, masks)).join(large, ["mask", "node"], "left_anti").select(*columns)
        rows = rows.unionAll(_paired(by_node.join(large, ["mask", "node"]), index).select(*columns))
    return mapped(_in_nodes(rows, names, masks, carried), work, "a bigint, b bigint").distinct()


def may_be_similar(x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray, similarity: float) -> np.ndarray:
    """Whether odd sketches x, y of sets of n and m leave the Jaccard similarity possible: sets that have it differ in few enough elements."""
    return np.bitwise_count(x ^ y).sum(axis=1) <= (n + m) * (1 - similarity) / (1 + similarity) + 1e-9


def _sizes_fit(n: np.ndarray, m: np.ndarray, similarity: float) -> np.ndarray:
    return np.minimum(n, m) >= similarity * np.maximum(n, m) - 1e-9


def _node_places(node: np.ndarray) -> tuple[np.ndarray, ...]:
    """Where nodes start, their sizes, and for each row the rows from there to its node's end."""
    starts = np.flatnonzero(np.concatenate(([True], node[1:] != node[:-1])))
    sizes = np.diff(np.concatenate((starts, [len(node)])))
    return starts, sizes, np.repeat(sizes, sizes) - (np.arange(len(node)) - np.repeat(starts, sizes))


def _pairs(node: np.ndarray, prints: np.ndarray, component: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows of a node within the radius, apart from some of one component; nodes' rows are in Gray order."""
    starts, sizes, left = _node_places(node)
    left = np.where(np.repeat(sizes > SMALL_NODE, sizes), 0, left)
    found = []
    for lag in range(1, SMALL_NODE):
        rows = np.flatnonzero(left > lag)
        if not len(rows):
            break
        near = rows[np.bitwise_count(prints[rows] ^ prints[rows + lag]).sum(axis=1) <= radius]
        found.append((near, near + lag))
    if found:
        yield tuple(np.concatenate(x) for x in zip(*found))
    for first, size in zip(starts[sizes > SMALL_NODE], sizes[sizes > SMALL_NODE]):
        mine, group, leaves = prints[first : first + size], component[first : first + size], np.arange(0, size, LEAF)
        both, any_ = np.bitwise_and.reduceat(mine, leaves), np.bitwise_or.reduceat(mine, leaves)
        common, low, high = ~(both ^ any_), np.minimum.reduceat(group, leaves), np.maximum.reduceat(group, leaves)
        for leaf, s in enumerate(leaves):
            apart = np.bitwise_count((both[leaf] ^ both[leaf:]) & common[leaf] & common[leaf:]).sum(axis=1)
            one = (low[leaf:] == high[leaf:]) & (low[leaf:] == low[leaf]) & (low[leaf] == high[leaf])
            here = []
            for other in np.flatnonzero((apart <= radius) & ~one):
                t = leaves[leaf + other]
                x, y = np.nonzero(np.bitwise_count(mine[s : s + LEAF, None] ^ mine[None, t : t + LEAF]).sum(axis=2) <= radius)
                keep = slice(None) if other else x < y
                here.append((first + s + x[keep], first + t + y[keep]))
            if here:
                yield tuple(np.concatenate(x) for x in zip(*here))


def alike(docs: DataFrame, pairs: DataFrame, shingle: int, similarity: float, doc_id: str, text: str) -> DataFrame:
    """Those of the pairs a, b of documents whose shingle sets have the Jaccard similarity, by a join of the sets of the documents in pairs."""

    def work(batches) -> Iterator[dict]:
        for batch in batches:
            sets = [np.unique(shingle_hashes(t.as_py(), shingle)).view(np.int64) for t in batch.column(1)]
            yield {"id": batch.column(0), "key": [xxhash.xxh3_64_intdigest(s.tobytes()) >> 1 for s in sets], "hashes": sets}

    pairs = stored(pairs, "candidates")
    ids = pairs.select(F.col("a").alias("id")).unionAll(pairs.select("b")).distinct()
    rows = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.col(text).alias("text")).join(ids, "id", "left_semi")
    sets = stored(mapped(rows, work, "id bigint, key bigint, hashes array<bigint>").dropDuplicates(["id", "key"]).drop("key"), "shingle-sets")
    of = lambda side: sets.select(F.col("id").alias(side), F.col("hashes").alias(f"of_{side}"))
    joined = pairs.join(of("a"), "a").join(of("b"), "b")
    both = joined.select("a", "b", F.size(F.array_intersect("of_a", "of_b")).alias("both"), (F.size("of_a") + F.size("of_b")).alias("sizes"))
    return both.filter(F.col("both") * (1 + similarity) >= F.col("sizes") * similarity - 1e-9).select("a", "b").distinct()


def drop_near_duplicates(docs: DataFrame, index: Index | None = None, shingle: int = 5, doc_id: str = "doc_id", text: str = "text", similarity: float = 0.8) -> DataFrame:
    """The rows of docs whose document is the first of its group, by doc_id; columns as they are. Links are similar pairs that the index finds."""
    index = index or similar(similarity)
    names = [f"w{i}" for i in range(index.words)]
    prints = stored(shingle_sets(docs, shingle, index.words, doc_id, text), "fingerprints")
    known = prints.filter("doc_id is not null")
    sets = stored(known.groupBy("k0", "k1", "n", *names, *SKETCHED).agg(F.min("doc_id").alias("id")), "distinct-sets")
    twice = known.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").select("doc_id")
    twice = stored(twice, "repeated-ids")
    # a doc_id that has several sets is one document
    several = known.join(twice, "doc_id", "left_semi").select("doc_id", "k0", "k1").distinct().join(sets.select("k0", "k1", "id"), ["k0", "k1"])
    one = several.filter("doc_id <> id").select(F.col("doc_id").alias("a"), F.col("id").alias("b"))
    edges = stored(alike(docs, _neighbours(sets, index, similarity), shingle, similarity, doc_id, text).unionAll(one), "first-links")
    of = lambda edges: sets.join(connected_components(edges).withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    more = alike(docs, _candidates(stored(of(edges), "first-groups"), index, similarity), shingle, similarity, doc_id, text)
    first = of(edges.unionAll(more)).select(F.col("component").alias("first")).distinct()
    # rows without an id stay as they are and meet no join; the other names stay inside
    keyed = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    kept = keyed.filter("id is not null").join(first, F.col("id") == F.col("first"), "left_semi")
    if not twice.isEmpty():
        again = twice.withColumnRenamed("doc_id", "again")
        repeated = kept.join(again, F.col("id") == F.col("again"), "left_semi").groupBy("id").agg(F.min_by("row", F.struct(F.col("row").getField(text))).alias("row"))
        kept = kept.join(again, F.col("id") == F.col("again"), "left_anti").unionAll(repeated)
    whole = keyed.filter("id is null").unionAll(kept)
    return whole.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
