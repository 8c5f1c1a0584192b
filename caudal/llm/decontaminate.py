"""Benchmark decontamination: fingerprinted windows of the size of benchmark items, found by blocks of bits, verified exactly.

Words are runs of letters, marks and digits, lower-cased. Shingles are five words; fewer words are one shingle. All of it is
built-in functions.

1. Windows. A window has as many shingles as an item (fewer at the text's end) and begins with a shingle of an item of that
   size. A window is fingerprinted only if enough of its shingles are in the benchmark at all: the weighted similarity of a
   window with c such shingles cannot exceed c / (its size + the item's size - c). This loses nothing. Nor does the rule on
   beginnings: moving a window on past a shingle that no item has never makes it less similar.
2. Fingerprints. The window's SimHash: each of 64 bits as in the majority of its shingles' hashes.
3. Search. The 64 bits are cut into 8 blocks. Fingerprints within a radius of r differ in at most r // 8 bits in some block,
   so each item is listed under every value within r // 8 bits of each of its blocks, and a window looks up its own 8 values
   (and its size). The index holds whatever lies within the radius, and each hit's distance is checked. The radius
   is the distance expected at the wanted similarity and `spread` standard deviations more.
4. Verification. Weighted shingle similarity: sum of the smaller counts over sum of the larger counts, at least `similarity`.
   Equal windows are verified once, however many documents have them.

Defined results: NULL and empty texts match nothing, as do items without words. Repeated items and documents are compared
alike, and a match is given once for each doc_id and item_id; NULL ids are ids like others. Texts are read whole.
"""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caudal.llm.common import let, stored

NOT_WORD = r"[^\p{L}\p{M}\p{N}]+"
BLOCKS, BLOCK_BITS = 8, 8


def radius_for(similarity: float, spread: float = 4.0) -> int:
    angle = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return min(64, math.ceil(64 * angle + spread * math.sqrt(64 * angle * (1 - angle))))


def shingle_hashes(text: Column, size: int = 5) -> Column:
    """The text's shingles in order, as hashes; NULL and wordless texts have none."""
    words = F.array_remove(F.split(F.lower(text), NOT_WORD), "")

    def of(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(w) - size, F.lit(0)))
        return F.when(F.size(w) > 0, F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(size)])))

    return let(words, of)


def simhash(hashes: Column) -> Column:
    """64 bits, each set if it is set in over half of the hashes."""
    bit = lambda b: F.aggregate(hashes, F.lit(0), lambda n, h: n + F.getbit(h, b).cast("int"))
    return F.aggregate(
        F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("bigint"),
        lambda acc, b: F.when(bit(b) * 2 > F.size(hashes), acc.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), b))).otherwise(acc),
    )


def _block(fingerprint: Column, block: int) -> Column:
    return F.shiftrightunsigned(fingerprint, block * BLOCK_BITS).bitwiseAND(F.lit(2**BLOCK_BITS - 1).cast("bigint"))


def _flips(block: Column):
    return lambda flipped: block.bitwiseXOR(flipped)


def item_index(items: DataFrame, radius: int) -> DataFrame:
    """items: item, size, print. Gives a row for each block and each value near the item's."""
    near = [sum(1 << b for b in flipped) for n in range(radius // BLOCKS + 1) for flipped in combinations(range(BLOCK_BITS), n)]
    values = [F.transform(F.lit(near).cast("array<bigint>"), _flips(_block(F.col("print"), k))) for k in range(BLOCKS)]
    keys = F.array(*[F.struct(F.lit(k).alias("block"), v.alias("values")) for k, v in enumerate(values)])
    return items.select("item", "size", F.col("print").alias("item_print"), F.inline(keys)).select("item", "size", "item_print", "block", F.explode("values").alias("value"))


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, shingle: int = 5, spread: float = 4.0,
                 doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_id, item_id, similarity (of the best window), first_word, n_words: one row for each document and item that match."""
    matches = _matches(docs, benchmark, similarity, shingle, spread, doc_id, text, item_id, item_text)
    best = F.max(F.struct(F.col("similarity"), (-F.col("pos")).alias("back"), F.col("length"))).alias("best")
    return matches.groupBy(F.col("doc").alias("doc_id"), F.col("id.item_id").alias("item_id")).agg(best).select(
        "doc_id", "item_id", F.col("best.similarity").alias("similarity"), (-F.col("best.back")).alias("first_word"), (F.col("best.length") + shingle - 1).alias("n_words")
    )


def _kind(text: Column) -> Column:
    return F.xxhash64(text)


#: Bits of the bitmap that sorts out texts before their shuffle: 16 MB go to every task at most.
BITMAP_BITS = 2**27


def _maybe_wanted(texts: DataFrame, wanted: DataFrame, most_bits: int = BITMAP_BITS) -> DataFrame:
    """The texts whose hash may be among those of `wanted`: all that are, and with up to most_bits / 64 hashes 1.6 % of the others.

    A bitmap in blocks of 4 KB marks the hashes' last bits. It is at most most_bits large, so every task can have it; more hashes let more texts pass.
    """
    kinds = wanted.select("kind").distinct()
    bits = min(most_bits, max(2**15, 1 << (64 * kinds.count()).bit_length()))
    place = F.col("kind").bitwiseAND(F.lit(bits - 1).cast("bigint")) + 1  # positions count from 1
    blocks = kinds.groupBy(F.bitmap_bucket_number(place).alias("block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bitmap"))
    at = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring("bitmap", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    marked = F.getbit(byte, (at % 8).cast("int")) == 1
    found = texts.withColumn("block", F.bitmap_bucket_number(place)).join(F.broadcast(blocks), "block")
    return found.filter(marked).drop("block", "bitmap")


def _matches(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, shingle: int = 5, spread: float = 4.0,
             doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc, kind (hash of the text), pos, length, similarity, id (of the item): a row for each window and item that match."""
    radius = radius_for(similarity, spread)
    items = (
        benchmark.select(F.col(item_id).alias("item_id"), shingle_hashes(F.col(item_text), shingle).alias("hashes")).filter("hashes is not null")
        .groupBy("hashes").agg(F.collect_set(F.struct("item_id")).alias("ids"))  # equal items are one
        .select(F.xxhash64("hashes").alias("item"), "ids", "hashes", F.size("hashes").alias("size"), simhash(F.col("hashes")).alias("print"))
    )
    items = stored(items, "items")
    parts = items.select("item", "size", F.explode("hashes").alias("h"))
    sizes = stored(parts.groupBy("h").agg(F.collect_set("size").alias("sizes")), "item-shingles")

    key = [F.col(doc_id).alias("doc"), _kind(F.col(text)).alias("kind")]
    texts = docs.select(*key, shingle_hashes(F.col(text), shingle).alias("hashes"))
    exploded = texts.select("doc", "kind", F.size("hashes").alias("n"), F.posexplode("hashes").alias("pos", "h"))
    hits = stored(exploded.join(sizes, "h").select("doc", "kind", "n", "pos", "sizes"), "hits").distinct()

    # how many hits each possible window holds: the running count at its last shingle less the one before its first
    by_doc = Window.partitionBy("doc", "kind").orderBy("pos")
    ranked = hits.withColumn("rank", F.row_number().over(by_doc))
    no_window = F.lit(None).cast("struct<n:int,pos:int,size:int,rank:int>")
    last = (F.least(F.col("pos") + F.col("size"), F.col("n")) - 1).alias("pos")
    begins = ranked.select("doc", "kind", "n", "pos", "rank", F.explode("sizes").alias("size"))
    marks = ranked.select("doc", "kind", "pos", F.lit(1).alias("hit"), no_window.alias("w")).unionAll(begins.select("doc", "kind", last, F.lit(0), F.struct("n", "pos", "size", "rank")))
    counted = marks.withColumn("upto", F.sum("hit").over(by_doc)).filter("w is not null").select("doc", "kind", "w.*", (F.col("upto") - F.col("w.rank") + 1).alias("c"))
    length = F.least(F.col("size"), F.col("n") - F.col("pos"))
    likely = counted.withColumn("length", length).filter(F.col("c") * (1 + similarity) + 1e-9 >= similarity * (F.col("length") + F.col("size")))
    wanted = likely.groupBy("doc", "kind").agg(F.collect_set(F.struct("pos", "length", "size")).alias("windows"))
    wanted = stored(wanted, "windows")

    few = _maybe_wanted(docs.select(*key, F.col(text).alias("text")), wanted).withColumn("doc_key", F.coalesce(F.col("doc").cast("string"), F.lit("-")))
    joined = few.join(wanted.withColumn("doc_key", F.coalesce(F.col("doc").cast("string"), F.lit("-"))).drop("doc"), ["doc_key", "kind"])
    opened = joined.select("doc", "kind", "windows", shingle_hashes(F.col("text"), shingle).alias("all")).select("doc", "kind", "all", F.inline("windows"))
    cut = opened.select("doc", "kind", "pos", "length", "size", F.slice("all", F.col("pos") + 1, F.col("length")).alias("hashes")).distinct()
    cut = stored(cut.withColumn("content", F.xxhash64("hashes", "size")), "window-shingles")

    contents = cut.groupBy("content", "size").agg(F.first("hashes").alias("hashes"))
    contents = stored(contents.select("content", "size", "hashes", simhash(F.col("hashes")).alias("print")), "window-prints")
    looked_up = contents.select("content", "size", "print", F.posexplode(F.array(*[_block(F.col("print"), k) for k in range(BLOCKS)])).alias("block", "value"))
    near = F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= radius
    found = looked_up.join(item_index(items, radius), ["size", "block", "value"]).filter(near).select("content", "item").distinct()

    mine = contents.select("content", F.size("hashes").alias("length"), F.explode("hashes").alias("h")).groupBy("content", "length", "h").agg(F.count(F.lit(1)).alias("n"))
    theirs = parts.groupBy("item", "size", "h").agg(F.count(F.lit(1)).alias("m"))
    shared = found.join(mine, "content").join(theirs, ["item", "h"]).groupBy("content", "item", "length", "size").agg(F.sum(F.least("n", "m")).alias("both"))
    alike = shared.withColumn("similarity", F.col("both") / (F.col("length") + F.col("size") - F.col("both"))).filter(F.col("similarity") >= similarity)
    return cut.select("doc", "kind", "pos", "length", "content").join(alike.select("content", "item", "similarity"), "content").join(items.select("item", F.explode("ids").alias("id")), "item")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """docs without the rows whose text matches an item; columns and rows as they are. Other texts of the same doc_id, or of a NULL one, stay."""
    found = _matches(docs, benchmark, doc_id=doc_id, text=text, **options).select(F.col("doc").alias("__id"), F.col("kind").alias("__kind")).distinct()
    same = F.col(doc_id).eqNullSafe(F.col("__id")) & _kind(F.col(text)).eqNullSafe(F.col("__kind"))
    return docs.join(found, same, "left_anti")
