"""Language ID with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A letter trigram is the product (binding) of its letters' vectors, the first
rotated twice and the second once (permutation), and a text is the sum (bundle) of its trigrams. A language's prototype is the
bundle of its training texts, and a text is given the language whose prototype has the highest cosine.

Text is lower-cased; every run of other characters than letters counts as one blank, so word starts and ends are part of the
trigrams. Sums are of whole numbers, so results do not depend on the order of rows.

Defined results: a text that is NULL, empty or without letters is `und` with score 0; so is every text if nothing could be
learned (no training rows, or only NULL languages). Equal cosines give the smaller language name. Repeated rows are judged
alike and count each in training. Texts of any length are read whole, in pieces. A letter never seen in training has a
vector like any other. Other columns of the input are not read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caudal.llm.common import PIECE, chunks, mapped

UNDETERMINED = "und"


@dataclass(frozen=True)
class Space:
    """dims: length of the vectors; seed: of the letters' random vectors."""

    dims: int = 1024
    seed: int = 7


@dataclass(frozen=True)
class Profiles:
    space: Space
    langs: tuple[str, ...]
    vectors: np.ndarray  # a row of length one per language


@functools.cache
def _is_letter() -> np.ndarray:
    table = np.zeros(0x110000, dtype=bool)
    table[:0x32400] = [chr(c).isalpha() for c in range(0x32400)]
    return table


@functools.lru_cache(maxsize=20_000)
def _letter_vector(space: Space, code: int) -> np.ndarray:
    bits = np.random.Generator(np.random.PCG64([space.seed, code])).integers(0, 2, space.dims, dtype=np.int8)
    return bits * 2 - 1


def _trigram_vectors(space: Space, letters: np.ndarray, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """a, b, c: positions in letters of each trigram's letters."""
    base = np.stack([_letter_vector(space, int(x)) for x in letters])
    return (np.roll(base, 2, axis=1)[a] * np.roll(base, 1, axis=1)[b] * base[c]).astype(np.float32)


def _bundle_piece(space: Space, codes: np.ndarray, owner: np.ndarray, owners: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the trigram vectors around every letter, and the number of letters, for each owner."""
    codes = np.where(_is_letter()[codes], codes, 0)
    middle = np.flatnonzero(codes)
    if not len(middle):
        return np.zeros((owners, space.dims)), np.zeros(owners, dtype=np.int64)
    around = np.concatenate(([0], codes, [0])).astype(np.int64)
    whose = np.concatenate(([-1], owner, [-1]))
    left = np.where(whose[middle] == owner[middle], around[middle], 0)
    right = np.where(whose[middle + 2] == owner[middle], around[middle + 2], 0)
    present = np.zeros(0x110000, dtype=np.int32)
    present[codes] = 1
    present[0] = 1
    letters = np.flatnonzero(present)
    present[letters] = np.arange(len(letters))
    n = len(letters)
    key = (present[left].astype(np.int64) * n + present[codes[middle]]) * n + present[right]
    if n <= 160:
        seen = np.zeros(n**3, dtype=np.int32)
        seen[key] = 1
        kinds = np.flatnonzero(seen)
        seen[kinds] = np.arange(len(kinds))
        kind = seen[key]
    else:
        kinds, kind = np.unique(key, return_inverse=True)
    whose = owner[middle].astype(np.int64)
    sums = np.zeros((owners, space.dims))
    for s in range(0, len(kinds), 8192):  # bounded, however many letters there are
        some = kinds[s : s + 8192]
        mine = slice(None) if len(kinds) <= 8192 else (kind >= s) & (kind < s + 8192)
        counts = np.bincount(whose[mine] * len(some) + kind[mine] - s, minlength=owners * len(some)).reshape(owners, len(some))
        sums += counts.astype(np.float32) @ _trigram_vectors(space, letters, some // (n * n), some // n % n, some % n)
    return sums, np.bincount(whose, minlength=owners)


def bundles(space: Space, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Vector and number of letters of each text."""
    sums, letters = np.zeros((len(texts), space.dims)), np.zeros(len(texts), dtype=np.int64)
    for start, end in chunks(texts):
        lowered = [t.lower() for t in texts[start:end]]
        codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int32)
        owner = np.repeat(np.arange(start, end, dtype=np.int32), [len(t) for t in lowered])
        for s in range(0, max(1, len(codes)), PIECE * 4):  # a very long text; the letters at a cut are read with their neighbours
            lo, hi = max(0, s - 1), min(len(codes), s + PIECE * 4 + 1)
            part, count = _bundle_piece(space, codes[lo:hi], owner[lo:hi] - start, end - start)
            for at, extra in ((lo, lo < s), (hi - 1, hi > s + PIECE * 4)):
                if extra:  # read only as a neighbour
                    back, one = _bundle_one(space, codes, owner, at, lo, hi, start, end - start)
                    part, count = part - back, count - one
            sums[start:end] += part
            letters[start:end] += count
    return sums, letters


def _bundle_one(space, codes, owner, at, lo, hi, start, owners):
    """What the letter at a cut added to a piece in which it stands at the edge."""
    part, count = np.zeros((owners, space.dims)), np.zeros(owners, dtype=np.int64)
    if _is_letter()[codes[at]]:
        near = [codes[i] if lo <= i < hi and owner[i] == owner[at] and _is_letter()[codes[i]] else 0 for i in (at - 1, at, at + 1)]
        kinds = np.array(near)
        letters, place = np.unique(kinds, return_inverse=True)
        part[owner[at] - start] = _trigram_vectors(space, letters, place[:1], place[1:2], place[2:])[0]
        count[owner[at] - start] = 1
    return part, count


def learn(docs: DataFrame, space: Space = Space(), text: str = "text", lang: str = "lang") -> Profiles:
    """Prototypes of the languages in docs. To the driver come dims numbers for each language, which Spark has summed."""

    def work(batches) -> Iterator[dict]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            names = batch.column(1).to_pylist()
            texts = batch.column(0).to_pylist()
            for start, end in chunks(texts):
                kinds = sorted(set(names[start:end]))
                by = {k: [t for t, n in zip(texts[start:end], names[start:end]) if n == k] for k in kinds}
                # one text of each language: its texts with a mark between them that is no letter
                vectors, _ = bundles(space, ["\n".join(by[k]) for k in kinds])
                for k, v in zip(kinds, vectors):
                    sums[k] = sums.get(k, 0) + v
        for k, v in sums.items():
            yield {"lang": [k] * space.dims, "dim": np.arange(space.dims), "n": np.rint(v).astype(np.int64)}

    rows = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).filter("text is not null and lang is not null")
    found = mapped(rows, work, "lang string, dim int, n bigint").groupBy("lang", "dim").agg(F.sum("n").alias("n")).toPandas()
    if not len(found):
        return Profiles(space, (), np.zeros((0, space.dims)))
    table = found.pivot(index="lang", columns="dim", values="n").sort_index()
    vectors = table.to_numpy(dtype=np.float64)
    size = np.linalg.norm(vectors, axis=1)
    keep = size > 0
    return Profiles(space, tuple(table.index[keep]), vectors[keep] / size[keep, None])


def predict(docs: DataFrame, profiles: Profiles, id_cols: list[str | Column], text: str = "text", keep_text: bool = False) -> DataFrame:
    """id_cols (and the text) with lang_pred and score (cosine, negative ones as 0), one row for each row of docs."""
    ids = docs.select(*id_cols, F.col(text).alias(text if keep_text else "__text"))
    kept = ids.columns if keep_text else ids.columns[:-1]
    at = len(ids.columns) - 1

    def work(batches) -> Iterator[dict]:
        for batch in batches:
            texts = [t or "" for t in batch.column(at).to_pylist()]
            for start, end in chunks(texts):
                vectors, letters = bundles(profiles.space, texts[start:end])
                size = np.linalg.norm(vectors, axis=1)
                known = (letters > 0) & (size > 0) & (len(profiles.langs) > 0)
                if profiles.langs:
                    cosines = vectors @ profiles.vectors.T / np.where(size > 0, size, 1)[:, None]
                    best = np.round(cosines, 12).argmax(axis=1)
                    score = np.clip(cosines[np.arange(len(best)), best], 0, 1)
                else:
                    best, score = np.zeros(end - start, dtype=int), np.zeros(end - start)
                part = batch.slice(start, end - start)
                out = {name: part.column(i) for i, name in enumerate(kept)}
                out["lang_pred"] = [profiles.langs[b] if k else UNDETERMINED for b, k in zip(best, known)]
                out["score"] = np.where(known, score, 0.0)
                yield out

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ids.schema.fields[: len(kept)])
    return mapped(ids, work, f"{schema}, lang_pred string, score double")


def fold(doc_id: str, parts: int) -> Column:
    """crc32 of the id as text, modulo parts; a NULL id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % parts


def accepted(lang_pred: Column, score: Column, langs: list[str] | None, at_least: float) -> Column:
    """The stage's rule: a language was found, it is a wanted one, and the likeness is high enough."""
    rule = (lang_pred != UNDETERMINED) & (score >= at_least)
    return rule if langs is None else rule & lang_pred.isin(langs)

