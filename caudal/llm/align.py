"""Alignment of two tokenizers' tokens on the same text.

A is a byte-level BPE (tokenizers), B a piece model with byte fallback (sentencepiece). Both encode a space and the text; B adds
that space itself. Strings of special tokens are ordinary text.

1. Coarse cuts. Both give their tokens' character spans: A its offsets, B those of its proto (this sentencepiece refuses the
   immutable proto; its `offset_mapping` has the same spans). Where a span ends on a character's end, that is the token's end.
2. Refinement. A's tokens that share a multibyte character, and B's byte-fallback tokens, whose spans are empty, are cut by the
   lengths of their decoded bytes, from the last coarse cut on.
3. Groups. Bytes at which a token of A and one of B both end cut the tokens into groups. The two tokens that end there are linked.
4. Counts. Links are counted by pair of ids over the whole corpus, and each pair is compared with the best of its B id.

Both tokenizers cut at a single space between two other characters, whatever is around it, and after a letter before some marks.
So texts are cut there first, and each distinct stretch of a chunk of documents is encoded once, many of them as one text. Chunks are neighbouring documents of about `chunk` code points (a longer
text is alone). A chunk's distinct pairs, not its documents' links, are joined with the corpus counts and come back to the chunk.

Defined results: a NULL or empty text has no tokens, nor has one whose tokens' bytes differ from space and text (such as one with
U+2581, which B writes for a space): all numbers are 0 and groups is ''. NULL and repeated doc_ids are ids like others, repeated
rows are rows each and count each. Texts are read whole. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import functools
import gc
import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, count
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caudal.llm.common import chunks, mapped, stored

BYTE_BPE, PIECE_BPE = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
CHUNK = 4_000_000
#: A worker remembers so many stretches from one chunk to the next, and encodes so many as one text.
REMEMBERED, TOGETHER = 500_000, 256
CUT = re.compile(r"(?<=\S) (?=\S)")


@dataclass(frozen=True)
class Vocabularies:
    """The contents of both files. The driver reads them; tasks get them with their code."""

    byte_bpe: str
    piece_bpe: bytes

    @classmethod
    def read(cls, byte_bpe: str = BYTE_BPE, piece_bpe: str = PIECE_BPE) -> Vocabularies:
        with open(byte_bpe, encoding="utf-8") as a, open(piece_bpe, "rb") as b:
            return cls(a.read(), b.read())


def byte_of_letter() -> dict[str, int]:
    """The letters in which a byte-level vocabulary writes bytes: printable ones as they are, the others from U+0100 on, in order."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Aligned(NamedTuple):
    """Of stretches: numbers of tokens and links, all links in a row as pairs a * n_b + b, and groups as text. No links: other bytes."""

    n_a: np.ndarray
    n_b: np.ndarray
    sizes: np.ndarray
    links: np.ndarray
    groups: list[str]


class Encoders:
    """Both tokenizers, as a task uses them."""

    def __init__(self, files: Vocabularies):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has the cores
        self.byte_bpe = Tokenizer.from_str(files.byte_bpe)
        self.byte_bpe.encode_special_tokens = True
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=files.piece_bpe)
        letters = byte_of_letter()
        vocabulary = json.loads(files.byte_bpe)["model"]["vocab"]
        self.a_bytes = {i: bytes(map(letters.__getitem__, t)) for t, i in vocabulary.items() if all(c in letters for c in t)}
        name = self.pieces.id_to_piece
        self.n_b = self.pieces.get_piece_size()
        self.b_bytes = [bytes([int(name(i)[3:5], 16)]) if self.pieces.is_byte(i) else name(i).replace("▁", " ").encode() for i in range(self.n_b)]
        self.names = [str(i) for i in range(max(max(self.a_bytes) + 1, self.n_b))]

    def aligned(self, stretches: list[str]) -> Iterator[Aligned]:
        """The stretches in their order. Those between two other characters are encoded many at a time, others alone."""
        alone = [i for i, s in enumerate(stretches) if s != s.strip()]
        begin = 0
        for end in [*alone, len(stretches)]:
            for i in range(begin, end, TOGETHER):
                yield from self._together(stretches[i : min(i + TOGETHER, end)])
            yield from self._together(stretches[end : end + 1])
            begin = end + 1

    def _together(self, stretches: list[str]) -> Iterator[Aligned]:
        """Stretches as one text with a space before each. Where bytes differ, halves are encoded apart, down to the stretch to blame."""
        if not stretches:
            return
        text = " " + " ".join(stretches)
        data = text.encode("utf-8", "surrogatepass")
        x = self.byte_bpe.encode(text, add_special_tokens=False)
        y = self.pieces.encode([text[1:]], return_type="offset_mapping", num_threads=1)[0]
        x_ids, y_ids = x.ids, y["ids"]
        spelled_a, spelled_b = [*map(self.a_bytes.__getitem__, x_ids)], [*map(self.b_bytes.__getitem__, y_ids)]
        if b"".join(spelled_a) != data or b"".join(spelled_b) != data:
            if len(stretches) == 1:
                nothing = np.zeros(1, dtype=np.int64)
                yield Aligned(nothing, nothing, nothing, nothing[:0], [""])
            else:
                half = len(stretches) // 2
                yield from self._together(stretches[:half])
                yield from self._together(stretches[half:])
            return
        at = np.append(np.flatnonzero(np.frombuffer(data, dtype=np.uint8) & 0xC0 != 0x80), len(data))
        begins, ends = _columns(x.offsets)
        a_ends = _refined(at[ends], np.append(begins[1:] >= ends[:-1], True), spelled_a)
        begins, ends = _columns(y["offsets"])
        b_ends = _refined(at[ends + 1], ends > begins, spelled_b)
        cuts, a_at, b_at = np.intersect1d(a_ends, b_ends, assume_unique=True, return_indices=True)
        stretch_ends = np.cumsum([1 + (len(s) if s.isascii() else len(s.encode("utf-8", "surrogatepass"))) for s in stretches])
        upto = np.searchsorted(cuts, stretch_ends) + 1
        links = np.array(x_ids)[a_at] * self.n_b + np.array(y_ids)[b_at]
        a, b = [*map(self.names.__getitem__, x_ids)], [*map(self.names.__getitem__, y_ids)]
        groups, p, q = [], 0, 0
        for i, j in zip((a_at + 1).tolist(), (b_at + 1).tolist()):
            groups.append(f"{a[p]}|{b[q]}" if i - p == j - q == 1 else f"{','.join(a[p:i])}|{','.join(b[q:j])}")
            p, q = i, j
        bounds = [0, *upto.tolist()]
        spelled = [";".join(groups[i:j]) for i, j in zip(bounds, bounds[1:])]
        yield Aligned(np.diff(a_at[upto - 1] + 1, prepend=0), np.diff(b_at[upto - 1] + 1, prepend=0), np.diff(upto, prepend=0), links, spelled)

    def marks(self) -> dict[str, tuple[int, int]]:
        """Marks at which both cut after a letter, whatever follows: A's pattern does, and no piece of B has a letter before one."""
        own = {v: i for i, v in self.a_bytes.items()}
        names = [self.pieces.id_to_piece(i) for i in range(self.n_b)]
        free = [m for m in ",.;:!?" if not any(re.search(rf"[^\W\d_]{re.escape(m)}", n) for n in names)]
        return {m: (own[m.encode()], self.pieces.piece_to_id(m)) for m in free if m in names}


def _columns(spans: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    flat = np.fromiter(chain.from_iterable(spans), dtype=np.int64, count=2 * len(spans))
    return flat[::2], flat[1::2]


def _refined(ends: np.ndarray, known: np.ndarray, spelled: list[bytes]) -> np.ndarray:
    """The ends that are known, and between them those of the decoded bytes."""
    if known.all():
        return ends
    length = np.cumsum(np.fromiter(map(len, spelled), dtype=np.int64, count=len(spelled)))
    last = np.maximum.accumulate(np.where(known, np.arange(len(ends)), -1))
    return length + np.where(last < 0, 0, ends[last] - length[last])


def _ranges(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """begin, begin + 1, … of each range, one range after the other."""
    return np.repeat(begins - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


class _Known:
    """Stretches in the form that documents add up, remembered from one task of a worker to the next until they are too many."""

    def __init__(self, files: Vocabularies):
        self.encoders = Encoders(files)
        self.marks = {m: (f";{a}|{b}", a * self.encoders.n_b + b) for m, (a, b) in self.encoders.marks().items()}
        self._forget()

    def _forget(self) -> None:
        self.places: dict[str, int] = {}
        self.groups: list[str] = []
        self.n_a, self.n_b, self.sizes, self.begins, self.links = (array("q") for _ in range(5))

    def _add(self, stretches: list[str]) -> None:
        for x in self.encoders.aligned(stretches):
            self.begins.frombytes((len(self.links) + np.cumsum(x.sizes) - x.sizes).tobytes())
            for own, values in ((self.n_a, x.n_a), (self.n_b, x.n_b), (self.sizes, x.sizes), (self.links, x.links)):
                own.frombytes(values.astype(np.int64).tobytes())
            self.groups += x.groups
        self.places.update(zip(stretches, range(len(self.places), len(self.groups))))

    def of(self, stretches: list[str]) -> Aligned:
        marks, places = self.marks, self.places
        if len(places) > REMEMBERED:
            self._forget()
            places = self.places
        added = [s[-1] if s[-1] in marks and s[-2:-1].isalpha() else "" for s in stretches]
        bare = [s[:-1] if m else s for s, m in zip(stretches, added)]
        gc.disable()  # millions of spans and texts, none in a cycle
        self._add([s for s in dict.fromkeys(bare) if s not in places])
        gc.enable()
        at = np.fromiter(map(places.__getitem__, bare), dtype=np.int64, count=len(bare))
        n_a, n_b, sizes, begins = (np.frombuffer(c, dtype=np.int64)[at] if len(at) else at for c in (self.n_a, self.n_b, self.sizes, self.begins))
        links = np.frombuffer(self.links, dtype=np.int64)[_ranges(begins, sizes)] if len(self.links) else at[:0]
        marked = np.flatnonzero((np.fromiter(map(len, added), dtype=np.int64, count=len(added)) > 0) & (sizes > 0))
        links = np.insert(links, np.cumsum(sizes)[marked], [marks[added[i]][1] for i in marked])
        for numbers in (n_a, n_b, sizes):
            numbers[marked] += 1
        groups = [*map(self.groups.__getitem__, at.tolist())]
        for i in marked.tolist():
            groups[i] += marks[added[i]][0]
        return Aligned(n_a, n_b, sizes, links, groups)


@functools.lru_cache(maxsize=1)
def _known(files: Vocabularies) -> _Known:
    return _Known(files)


CHUNKS = "chunk bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, used array<int>, pairs array<bigint>, freq array<bigint>, links array<int>, sizes array<int>"


def _chunked(docs: DataFrame, files: Vocabularies, doc_id: str, text: str, as_digest: bool, chunk: int) -> DataFrame:
    """A row for each document (`used`: its stretches' places in the chunk), and one for each chunk: its distinct pairs, their
    numbers of links, and its stretches' links (places in pairs) one after the other."""
    pack = (lambda parts: hashlib.sha256(";".join(parts).encode()).hexdigest()) if as_digest else ";".join

    def one(known: _Known, number: int, ids: pa.Array, texts: list[str | None]) -> Iterator[dict]:
        cut = [CUT.split(t) if t else [] for t in texts]
        words = [*chain.from_iterable(cut)]
        places = dict(zip(dict.fromkeys(words), count()))
        used = np.fromiter(map(places.__getitem__, words), dtype=np.int32, count=len(words))
        ends = np.cumsum([*map(len, cut)])
        begins = np.concatenate(([0], ends[:-1]))
        found = known.of(list(places))
        whole = found.sizes > 0

        def per_text(values: np.ndarray) -> np.ndarray:
            upto = np.concatenate(([0], np.cumsum(values[used])))
            return upto[ends] - upto[begins]

        spelled = (per_text(~whole) == 0) & (ends > begins)
        n_a, n_b, n_links = (np.where(spelled, per_text(v), 0) for v in found[:3])
        times = np.bincount(used[np.repeat(spelled, ends - begins)], minlength=len(places))
        pairs, links = np.unique(found.links, return_inverse=True)
        freq = np.bincount(links, weights=np.repeat(times, found.sizes), minlength=len(pairs)).astype(np.int64)
        spell = found.groups.__getitem__
        used = [used[i:j] if ok else used[:0] for i, j, ok in zip(begins, ends, spelled)]
        groups = [pack(map(spell, u.tolist())) if len(u) else "" for u in used]
        n, empty = len(texts), [None] * len(texts)
        yield {"chunk": [number] * n, "doc_id": ids, "n_a": n_a, "n_b": n_b, "n_groups": n_links, "n_links": n_links, "groups": groups, "used": used,
               "pairs": empty, "freq": empty, "links": empty, "sizes": empty}
        nothing = {k: [None] for k in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "used")}
        yield {"chunk": [number], **nothing, "pairs": [pairs], "freq": [freq], "links": [links.astype(np.int32)], "sizes": [found.sizes.astype(np.int32)]}

    def work(batches) -> Iterator[dict]:
        known, number = _known(files), TaskContext.get().partitionId() << 32
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for start, end in chunks([t or "" for t in texts], chunk):
                yield from one(known, number, batch.column(0).slice(start, end - start), texts[start:end])
                number += 1

    return mapped(docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")), work, CHUNKS)


def pair_counts(chunked: DataFrame, n_b: int) -> DataFrame:
    """pair, n (links in the corpus), best (whether no pair with its B id has more)."""
    summed = chunked.filter("pairs is not null").select(F.inline(F.arrays_zip(F.col("pairs").alias("pair"), F.col("freq").alias("n")))).groupBy("pair").agg(F.sum("n").alias("n"))
    counted = stored(summed.withColumn("b", F.col("pair") % n_b), "pair-counts")
    return counted.join(counted.groupBy("b").agg(F.max("n").alias("most")), "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


ALIGNED = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups string"


def _with_counts(rows: pa.Table, counts: pa.Table) -> pa.Table:
    """A chunk's documents with the sums over their links."""
    docs = rows.filter(pa.compute.is_valid(rows["used"]))
    own = rows.filter(pa.compute.is_valid(rows["pairs"])).slice(0, 1)
    links, sizes = (own[c].combine_chunks().flatten().to_numpy() for c in ("links", "sizes"))
    place = counts["place"].to_numpy()
    used = docs["used"].combine_chunks()
    ends = np.cumsum(pa.compute.list_value_length(used).to_numpy(zero_copy_only=False))
    used = used.flatten().to_numpy()

    def summed(column: str) -> np.ndarray:
        value = np.zeros(len(place), dtype=np.int64)
        value[place] = counts[column].to_numpy()
        to = np.concatenate(([0], np.cumsum(value[links])))
        upto = np.cumsum(sizes)
        of_stretch = to[upto] - to[upto - sizes]
        total = np.concatenate(([0], np.cumsum(of_stretch[used])))
        return total[ends] - total[np.concatenate(([0], ends[:-1]))]

    columns = {"n_best": summed("best"), "count_sum": summed("n")}
    return pa.table({c: columns.get(c, docs[c] if c in docs.column_names else None) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")})


def align(docs: DataFrame, files: Vocabularies | None = None, doc_id: str = "doc_id", text: str = "text", as_digest: bool = False, chunk: int = CHUNK) -> DataFrame:
    """A row for each document: doc_id, n_a, n_b (tokens), n_groups, n_links, n_best (links whose pair is its B id's most frequent,
    ties included), count_sum (links' corpus-wide counts added up) and groups (`a1,a2|b1;a3|b2,b3`, or that text's SHA-256)."""
    import sentencepiece

    files = files or Vocabularies.read()
    n_b = sentencepiece.SentencePieceProcessor(model_proto=files.piece_bpe).get_piece_size()
    chunked = stored(_chunked(docs, files, doc_id, text, as_digest, chunk), "aligned")
    counts = pair_counts(chunked, n_b)
    places = chunked.filter("pairs is not null").select("chunk", F.posexplode("pairs").alias("place", "pair"))
    looked_up = places.join(counts, "pair").select(F.col("chunk").alias("of"), "place", "n", F.col("best").cast("bigint").alias("best"))
    wanted = chunked.select("chunk", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "used", "pairs", "links", "sizes")
    return wanted.groupBy("chunk").cogroup(looked_up.groupBy("of")).applyInArrow(_with_counts, ALIGNED)
