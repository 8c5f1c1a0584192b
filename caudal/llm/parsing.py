"""Document fingerprints by locally consistent parsing.

A text is a sequence of names, at first one for each code point. A level of the hierarchy names phrases of the level below:

1. Runs of an equal name become one name.
2. Deterministic coin tossing: each name is labelled by the lowest bit in which it differs from the name before it, and that
   bit's value; labels are labelled again in the same way until at most six are left. Neighbours keep unequal labels.
3. A phrase begins where the label is lower than both neighbours'. The phrase's name is a hash of the names in it.

Where phrases begin depends on a few names to the left and one to the right, so equal substrings get the same phrases inside,
wherever they stand; only those at their ends may differ. Levels go on until one name is left, the root.

The fingerprint is a sketch of the set of all phrase names from the third level of names (phrases of phrases, some eight
characters) up to the root: of each of 64 classes of names the smallest, 32 bits each, as hexadecimal digits. Two fingerprints'
likeness is the share of classes that agree among those that either has: an estimate of the sets' Jaccard similarity.

Defined results: NULL is the empty text, which has no phrases: its fingerprint is all f, like 1 to itself and 0 to others. Texts too
short for the third level have the root alone. Documents stand in the order of doc_id, then text, a NULL doc_id first; the
document after the last is the first, and a single document is its own next. Repeated rows are documents of their own. Rows
are streamed, so neither long texts' neighbours nor equal doc_ids are held together. Other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caudal.llm.asof import slot
from caudal.llm.common import chunks, mapped

CLASSES = 64
FIRST_LEVEL = 2
EMPTY = np.uint32(0xFFFFFFFF)
PIECE = 400_000
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@functools.cache
def _code_names() -> np.ndarray:
    return _mix(np.arange(1, 0x110001, dtype=np.uint64) * _STEP)


@functools.cache
def _places() -> np.ndarray:
    """Odd factors for the places in a phrase."""
    return _mix(np.arange(1, 4097, dtype=np.uint64)) | np.uint64(1)


@functools.cache
def _lowest_bit() -> np.ndarray:
    return np.array([(x & -x).bit_length() - 1 if x else 0 for x in range(256)], dtype=np.uint8)


def _labels(names: np.ndarray, first: np.ndarray) -> np.ndarray:
    """At most six labels; neighbours with unequal names get unequal ones, apart from a text's first few."""
    differ = names.copy()
    differ[1:] ^= np.where(first[1:], np.uint64(0), names[:-1])
    bit = np.bitwise_count((differ & -differ) - np.uint64(1)).astype(np.uint8)
    labels = (bit % 64 * 2 + ((names >> (bit % 64).astype(np.uint64)) & np.uint64(1)).astype(np.uint8)).astype(np.uint8)
    for _ in range(3):
        differ = labels.copy()
        differ[1:] ^= np.where(first[1:], np.uint8(0), labels[:-1])
        bit = _lowest_bit()[differ]
        labels = bit * 2 + ((labels >> bit) & 1)
    return labels


def _level_up(names: np.ndarray, owner: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names and owners of the next level, and where its phrases begin in this one."""
    change = np.empty(len(names), dtype=bool)
    change[0] = True
    first = np.empty(len(names), dtype=bool)
    first[0] = True
    np.not_equal(owner[1:], owner[:-1], out=first[1:])
    np.not_equal(names[1:], names[:-1], out=change[1:])
    change |= first
    runs = np.flatnonzero(change)
    if len(runs) < len(names):
        length = np.diff(np.append(runs, len(names))).astype(np.uint64)
        names, owner, first = names[runs], owner[runs], first[runs]
        long = length > 1
        names = names.copy()
        names[long] = _mix(names[long] + length[long] * _STEP)
    labels = _labels(names, first)
    begin = first.copy()
    begin[1:-1] |= (labels[1:-1] < labels[:-2]) & (labels[1:-1] < labels[2:]) & ~first[2:]
    starts = np.flatnonzero(begin)
    size = np.diff(np.append(starts, len(names)))
    place = np.arange(len(names)) - np.repeat(starts, size)
    total = np.add.reduceat(names * _places()[place % 4096], starts)
    return _mix(total + size.astype(np.uint64) * _STEP + np.uint64(level)), owner[starts], runs[starts]


def levels(texts: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """level, names, owners, begin (code point in its text), root (bool) of every level of every text."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    if not len(codes):
        return
    names, owner = _code_names()[codes], np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    offset = np.cumsum(sizes) - sizes
    begin = np.arange(len(codes)) - np.repeat(offset, sizes)
    level = 0
    while len(names):
        count = np.bincount(owner, minlength=len(texts))
        root = count[owner] == 1
        yield level, names, owner, begin, root
        go = ~root
        names, owner, begin = names[go], owner[go], begin[go]
        level += 1
        if len(names):
            names, owner, starts = _level_up(names, owner, level)
            begin = begin[starts]


def sketches(texts: list[str]) -> np.ndarray:
    """A row of CLASSES 32-bit numbers for each text."""
    out = np.full((len(texts), CLASSES), EMPTY, dtype=np.uint32)
    for start, end in chunks(texts, PIECE):
        flat = np.full((end - start) * CLASSES, EMPTY, dtype=np.uint32)
        for level, names, owner, _, root in levels(texts[start:end]):
            if level < FIRST_LEVEL:
                names, owner = names[root], owner[root]
            cell = owner.astype(np.int64) * CLASSES + (names >> np.uint64(58)).astype(np.int64)
            np.minimum.at(flat, cell, np.minimum((names >> np.uint64(20)).astype(np.uint32), EMPTY - np.uint32(1)))
        out[start:end] = flat.reshape(-1, CLASSES)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    either = ((a != EMPTY) | (b != EMPTY)).sum(axis=1)
    same = ((a == b) & (a != EMPTY)).sum(axis=1)
    return np.where(either > 0, same / np.maximum(either, 1), 1.0)


def as_text(sketch: np.ndarray) -> list[str]:
    return [row.tobytes().hex() for row in sketch.astype(">u4")]


def phrases(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, level, begin, length (code points), name: every phrase of every text."""

    def work(batches) -> Iterator[dict]:
        for batch in batches:
            ids, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
            for start, end in chunks(texts, PIECE):
                size = np.array([len(t) for t in texts[start:end]], dtype=np.int64)
                for level, names, owner, begin, _ in levels(texts[start:end]):
                    last = np.append(owner[1:] != owner[:-1], True)
                    length = np.where(last, size[owner], np.append(begin[1:], 0)) - begin
                    yield {"doc_id": ids.take(owner.astype(np.int64) + start), "level": np.full(len(names), level), "begin": begin, "length": length, "name": names.view(np.int64)}

    return mapped(docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")), work, "doc_id bigint, level int, begin bigint, length bigint, name bigint")


def _in_order(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """part, look, doc_id, text: rows in order within a part, and after a part's rows (look = 0) the one that follows (look = 1)."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(doc_id).cast("bigint"), F.lit(-(2**63))).alias("id"), F.col(text).alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [k / parts for k in range(1, parts)] or [0.5]
    low, cuts = rows.agg(F.min("id"), F.percentile_approx("id", shares, max(10_000, 20 * parts))).first()
    if low is None:
        return rows.select(F.lit(0).alias("part"), F.lit(0).alias("look"), "id", "text")
    bounds = sorted({low, *cuts})
    part = slot(F.col("id"), bounds) - 1
    first = F.get(F.lit(bounds).cast("array<bigint>"), F.col("part")) == F.col("id")
    before = F.when(F.col("part") > 0, F.col("part") - 1).otherwise(len(bounds) - 1)
    own = F.struct(F.col("part").alias("part"), F.lit(0).alias("look"))
    places = F.when(first, F.array(own, F.struct(before.alias("part"), F.lit(1).alias("look")))).otherwise(F.array(own))
    dealt = rows.withColumn("part", part).select("id", "text", places.alias("places")).select(F.inline("places"), "id", "text")
    return dealt.repartitionById(len(bounds), F.col("part")).sortWithinPartitions("part", "look", "id", "text")


def edited_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """For each document: its fingerprint, that of its text with the last quarter replaced by the next document's beginning, and
    the likeness to the edited and to the next text: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next."""

    def work(batches) -> Iterator[dict]:
        ids, looks, texts, prints = [], [], [], np.zeros((0, CLASSES), dtype=np.uint32)
        for batch in batches:
            new = [t or "" for t in batch.column(3).to_pylist()]
            for start, end in chunks(new, 10 * PIECE):
                ids += batch.column(2).slice(start, end - start).to_pylist()
                looks += batch.column(1).slice(start, end - start).to_pylist()
                texts += new[start:end]
                prints = np.concatenate((prints, sketches(new[start:end])))
                own = [i for i in range(len(ids) - 1) if looks[i] == 0]
                edited = []
                for i in own:
                    n = len(texts[i])
                    edited.append(texts[i][: n - n // 4] + texts[i + 1][: n // 4])
                changed = sketches(edited)
                if own:
                    mine, following = prints[own], prints[np.array(own) + 1]
                    yield {
                        "doc_id": [ids[i] if ids[i] != -(2**63) else None for i in own],
                        "n_chars": [len(texts[i]) for i in own],
                        "edited_sha256": [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited],
                        "fingerprint": as_text(mine), "edited_fingerprint": as_text(changed),
                        "near_edited": likeness(mine, changed), "near_next": likeness(mine, following),
                    }
                ids, looks, texts, prints = ids[-1:], looks[-1:], texts[-1:], prints[-1:]

    schema = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return mapped(_in_order(docs, doc_id, text), work, schema)
