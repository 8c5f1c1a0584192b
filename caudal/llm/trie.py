"""Prefix trie of conversations by blocks of turns.

A node is a distinct sequence of first turns (role, text); the root is the empty one. A node is named by its depth and by the
smallest id of the conversations that begin with it.

1. Order. Turns are numbered within their conversation, however long it is.
2. Blocks. `BLOCK` turns are one block with one digest. A block's place is the digest of all blocks before it: the exclusive-or of
   hashes of each block with its number (128 bits), so that a running total over blocks gives it.
3. Groups. Blocks with the same number and the same place are the ways in which conversations go on from there. Where all of them
   are the same block, its turns are nodes as they stand, with one conversation to show for all.
4. Refinement. Only where blocks at one place differ are their turns looked at, and grouped by the digest up to each turn.
5. Subtrees. A conversation names a chain of nodes, down to its end; chains hang on nodes of chains with smaller ids. Sums over
   subtrees first go up from chain to chain, twice as far in each round, and then along the chains.

Defined results: rows with a NULL conversation belong to none and are left out. Turns come in order of their number, NULL first;
turns of the same number in order of role, of the text's first 32 code points, and of the digest of role and whole text. A NULL
role or text is the empty one. Repeated rows are a turn each. Texts are read whole. An empty table has no nodes, also no root.
Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caudal.llm.common import SPACES, mapped, stored
from caudal.llm.running import running

BLOCK = 8
#: Copies of one row that a row is opened to at once, and ids that are packed in one text.
TOGETHER = 65_536
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


class Trie(NamedTuple):
    """nodes: conv, depth, d1, d2 (digest), parent, n_convs, n_children, n_leaves, saved_words. ends: conv and its last node's depth, d1, d2."""

    nodes: DataFrame
    ends: DataFrame


def words_of(text: Column) -> Column:
    return F.size(F.array_remove(F.split(text, SPACES), "")).cast("bigint")


def ordered_turns(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv, pos (from 1), digest (of role and text), words: the turns of each conversation in order."""
    said = F.coalesce(F.col(text), F.lit(""))
    who = F.coalesce(F.col(role), F.lit(""))
    rows = conversations.filter(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("bigint").alias("conv"), F.col(turn).cast("bigint").alias("turn"), who.alias("role"), F.substring(said, 1, 32).alias("head"),
        F.unhex(F.md5(F.concat(F.octet_length(who).cast("string"), F.lit(":"), who, said))).alias("digest"), words_of(said).alias("words"),
    )
    same = rows.groupBy("conv", "turn", "role", "head", "digest").agg(F.first("words").alias("words"), F.count(F.lit(1)).alias("n"))
    numbered = running(same, "conv", ["turn", "role", "head", "digest"], sums=["n"], name="numbered-turns")
    some = F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / TOGETHER)))
    runs = numbered.select("conv", "digest", "words", "n", (F.col("n_upto") - F.col("n") + 1).alias("first"), some.alias("run"))
    low, high = F.col("first") + F.col("run") * TOGETHER, F.least(F.col("first") + (F.col("run") + 1) * TOGETHER, F.col("first") + F.col("n")) - 1
    return runs.select("conv", F.explode(F.sequence(low, high)).alias("pos"), "digest", "words")


def _hash(seed: int, number: Column, digests: Column) -> Column:
    return F.xxhash64(F.lit(seed), number, digests)


def _blocks(turns: DataFrame, block: int) -> DataFrame:
    """conv, k (number), digests, words, x1, x2 (hash), p1, p2 (digest of all before), q1, q2 (with this one)."""
    cut = turns.groupBy("conv", F.floor((F.col("pos") - 1) / block).alias("k")).agg(F.sort_array(F.collect_list(F.struct("pos", "digest", "words"))).alias("t"))
    hashed = cut.select("conv", "k", F.col("t.digest").alias("digests"), F.col("t.words").alias("words"), *[_hash(i, F.col("k"), F.col("t.digest")).alias(f"x{i}") for i in (1, 2)])
    placed = running(hashed, "conv", ["k"], xors=["x1", "x2"], name="blocks")
    before = [F.col(f"x{i}_upto").bitwiseXOR(F.col(f"x{i}")).alias(f"p{i}") for i in (1, 2)]
    return placed.select("conv", "k", "digests", "words", *before, F.col("x1_upto").alias("q1"), F.col("x2_upto").alias("q2"))


def _nodes(blocks: DataFrame, convs: DataFrame, block: int) -> DataFrame:
    """conv, depth, d1, d2, n_convs, value, u1, u2 (digest of the parent), inner (whether the parent has the same conv)."""
    place = ["k", "p1", "p2"]
    ways = blocks.groupBy(*place).agg(F.count(F.lit(1)).alias("n"), F.min("conv").alias("least"), *[f(q).alias(f"{f.__name__}_{q}") for f in (F.min, F.max) for q in ("q1", "q2")])
    one = (F.col("min_q1") == F.col("max_q1")) & (F.col("min_q2") == F.col("max_q2"))
    joined = blocks.join(ways.select(*place, "n", "least", one.alias("one")), place).filter(~F.col("one") | (F.col("conv") == F.col("least")))

    def upto(i: int, j: Column) -> Column:
        return F.when(j > 0, F.col(f"p{i}").bitwiseXOR(_hash(i, F.col("k"), F.slice("digests", 1, j)))).otherwise(F.col(f"p{i}"))

    each = F.transform(F.sequence(F.lit(1), F.size("digests")), lambda j: F.struct(
        (F.col("k") * block + j).alias("depth"), upto(1, j).alias("d1"), upto(2, j).alias("d2"), upto(1, j - 1).alias("u1"), upto(2, j - 1).alias("u2"),
        F.get("words", j - 1).alias("words"), (j > 1).alias("inner")))
    opened = joined.select("conv", "n", "one", F.inline(each))
    key = ["depth", "d1", "d2", "u1", "u2", "words"]
    plain = opened.filter("one").select(*key, F.col("n").alias("n_convs"), "conv", "inner")
    refined = opened.filter("not one").groupBy(*key).agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv").alias("conv")).withColumn("inner", F.lit(False))
    none, zero = F.lit(None).cast("bigint"), F.lit(0).cast("bigint")
    root = convs.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv").alias("conv")).filter("n_convs > 0").select(
        zero.alias("depth"), zero.alias("d1"), zero.alias("d2"), none.alias("u1"), none.alias("u2"), zero.alias("words"), "n_convs", "conv", F.lit(False).alias("inner"))
    value = ((F.col("n_convs") - 1) * F.col("words")).alias("value")
    return plain.unionByName(refined).unionByName(root).select("conv", "depth", "d1", "d2", "n_convs", value, "u1", "u2", "inner")


def _linked(nodes: DataFrame) -> DataFrame:
    """nodes with parent, the parent's conv."""
    names = nodes.select((F.col("depth") + 1).alias("depth"), F.col("d1").alias("u1"), F.col("d2").alias("u2"), F.col("conv").alias("parent"))
    outer = nodes.filter("not inner").join(names, ["depth", "u1", "u2"], "left")
    return nodes.filter("inner").withColumn("parent", F.col("conv")).unionByName(outer).drop("u1", "u2", "inner")


def _chains(nodes: DataFrame) -> DataFrame:
    """conv, last (depth), up (the conv whose chain it hangs on), at (the depth there), words, leaves (of the chain alone)."""
    hangs = F.when(F.col("parent") != F.col("conv"), F.col("parent"))
    chains = stored(
        nodes.groupBy("conv").agg(F.min("depth").alias("first"), F.max("depth").alias("last"), F.max(hangs).alias("up"), F.sum("value").alias("words"))
        .select("conv", "last", "up", F.when(F.col("up").isNotNull(), F.col("first") - 1).alias("at"), "words"), "chains")
    below = chains.filter("up is not null").select(F.col("up").alias("conv"), F.col("at").alias("last"), F.lit(0).cast("bigint").alias("leaves")).distinct()
    return chains.join(below, ["conv", "last"], "left").withColumn("leaves", F.coalesce("leaves", F.lit(1).cast("bigint")))


def _summed(chains: DataFrame) -> DataFrame:
    """chains with the words and leaves of all that hang on them, directly or not. Each round reaches twice as far up."""
    now = stored(chains.withColumn("above", F.col("up")), "chain-sums")
    while not now.filter("above is not null").isEmpty():
        add = now.filter("above is not null").groupBy(F.col("above").alias("conv")).agg(F.sum("words").alias("more"), F.sum("leaves").alias("more_leaves"))
        higher = now.select(F.col("conv").alias("above"), F.col("above").alias("higher"))
        joined = now.join(add, "conv", "left").join(higher, "above", "left")
        words, leaves = F.col("words") + F.coalesce("more", F.lit(0)), F.col("leaves") + F.coalesce("more_leaves", F.lit(0))
        now = stored(joined.select("conv", "last", "up", "at", words.alias("words"), leaves.alias("leaves"), F.col("higher").alias("above")), "chain-sums")
    return now


def build(turns: DataFrame, convs: DataFrame, block: int = BLOCK) -> Trie:
    """turns: conv, pos (1, 2, … without gaps), digest, words. convs: conv, once each, also those without turns."""
    convs = convs.select(F.col("conv").cast("bigint").alias("conv"))
    blocks = stored(_blocks(turns, block), "placed-blocks")
    nodes = stored(_linked(stored(_nodes(blocks, convs, block), "nodes")), "linked-nodes")
    chains = _summed(_chains(nodes))
    zero = F.lit(0).cast("bigint")
    hung = chains.filter("up is not null").select(F.col("up").alias("conv"), F.col("at").alias("depth"), "words", "leaves", F.lit(1).cast("bigint").alias("n"), zero.alias("end"))
    ending = chains.select("conv", F.col("last").alias("depth"), zero.alias("words"), zero.alias("leaves"), zero.alias("n"), F.lit(1).cast("bigint").alias("end"))
    here = hung.unionByName(ending).groupBy("conv", "depth").agg(*[F.sum(c).alias(c) for c in ("words", "leaves", "n", "end")])
    filled = nodes.join(here, ["conv", "depth"], "left").fillna(0, ["words", "leaves", "n", "end"])
    own = filled.select(
        "conv", "depth", "d1", "d2", "parent", "n_convs", (F.col("n") + 1 - F.col("end")).alias("n_children"),
        (F.col("value") + F.col("words")).alias("saved"), (F.col("leaves") + F.when((F.col("end") == 1) & (F.col("n") == 0), 1).otherwise(0)).alias("leaf"),
    )
    summed = running(own, "conv", [F.col("depth").desc()], sums=["saved", "leaf"], name="subtrees")
    last = blocks.groupBy("conv").agg(F.max(F.struct("k", F.size("digests").alias("size"), "q1", "q2")).alias("b"))
    at = [F.coalesce(c, F.lit(0)).cast("bigint").alias(n) for n, c in (("depth", F.col("b.k") * block + F.col("b.size")), ("d1", F.col("b.q1")), ("d2", F.col("b.q2")))]
    ends = convs.join(last, "conv", "left").select("conv", *at)
    return Trie(summed.select("conv", "depth", "d1", "d2", "parent", "n_convs", "n_children", F.col("leaf_upto").alias("n_leaves"), F.col("saved_upto").alias("saved_words")), ends)


def end_digests(ends: DataFrame) -> DataFrame:
    """depth, d1, d2, ends_sha256: of the ids that end in a node, ascending and joined by commas. Ids are packed into texts where
    they lie; a node's texts then pass one task in order, of which only the hash's state is held."""
    node = ("depth", "d1", "d2")

    def packed(batches):
        for batch in batches:
            keys, convs = list(zip(*(batch.column(i).to_pylist() for i in range(3)))), batch.column(3).to_pylist()
            cuts = [i for i in range(len(keys)) if i == 0 or keys[i] != keys[i - 1] or i % TOGETHER == 0] + [len(keys)]
            spans = list(zip(cuts, cuts[1:]))
            first = [keys[i] for i, _ in spans]
            yield {n: [k[j] for k in first] for j, n in enumerate(node)} | {"first": [convs[i] for i, _ in spans], "ids": [",".join(map(str, convs[i:j])) for i, j in spans]}

    def hashed(batches):
        key, state = None, hashlib.sha256()
        for batch in batches:
            done = []
            for *k, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 4))):
                if k != key:
                    if key is not None:
                        done.append((*key, state.hexdigest()))
                    key, state = k, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield {n: pa.array([d[j] for d in done], type=pa.string() if j == 3 else pa.int64()) for j, n in enumerate((*node, "ends_sha256"))}
        if key is not None:
            yield {n: [v] for n, v in zip((*node, "ends_sha256"), (*key, state.hexdigest()))}

    dealt = ends.select(*node, "conv").repartitionByRange(*node, "conv").sortWithinPartitions(*node, "conv")
    texts = mapped(dealt, packed, "depth bigint, d1 bigint, d2 bigint, first bigint, ids string")
    return mapped(texts.repartition(*node).sortWithinPartitions(*node, "first"), hashed, "depth bigint, d1 bigint, d2 bigint, ends_sha256 string")
