"""Language-model scores by a subword lattice.

The pieces of an existing vocabulary and an end symbol are one unigram distribution. A text's probability is the sum over all
ways to cut its words into pieces, by a forward recursion in log space; words are cut apart from each other, each with the
mark of a word's beginning. Characters that are no piece are spelled with the vocabulary's byte pieces. A word that training
has seen c times has one more arc, from its beginning to its end. With N tokens and T kinds of them in training, such an arc
weighs c / (N + T), and the cuts into pieces weigh T / (N + T) in all (Witten and Bell's estimate for what is new). So the
probabilities of all sequences of words sum to at most one.

The vocabulary is fixed. Its scores give the pieces' first weights: probabilities where they are logarithms, else one over the
rank. Expected counts of the pieces over all distinct training words (forward and backward; each kind once, as pieces spell
what is new) then give the weights of the next round, with the first weights as pseudo-counts.

Everything a text needs is in the table of distinct words, which Spark counts: occurrences in training and log probability.
The `frequent` words most used (a bound, not a cut-off) go to every task; the rest of a text's words is joined to the table.

Defined results: NULL is the empty text, of which only the end is scored. Without training texts weights are the vocabulary's
and all counts are 0. A NULL doc_id is the id ''. Repeated rows are scored each, and count each in training. Words of any
length are taken whole. Other columns are not read.
"""

from __future__ import annotations

import functools
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caudal.llm.common import mapped, stored

MARK = "▁"
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
LONG_WORD = 200
FLUSH_WORDS = 300_000


@dataclass(frozen=True)
class Settings:
    """vocabulary: a SentencePiece model file, read by the driver. pseudo: sum of the pseudo-counts."""

    vocabulary: str = VOCABULARY
    rounds: int = 2
    pseudo: float = 1000.0
    frequent: int = 65_536


@dataclass(frozen=True, eq=False)
class Pieces:
    """Text pieces with their log probabilities (natural), then those of the 256 bytes, then that of the end."""

    texts: tuple[str, ...]
    logp: np.ndarray

    @property
    def end(self) -> float:
        return float(self.logp[-1])


def load_pieces(settings: Settings) -> Pieces:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=settings.vocabulary)
    ids = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    plain = [i for i in ids if not model.is_byte(i)]
    scores = np.array([model.get_score(i) for i in plain])
    ranks = np.all(scores == np.rint(scores)) and scores.min() < -100
    weights = 1 / (2 - scores) if ranks else np.exp(scores - scores.max())
    weights = np.concatenate((weights, np.full(257, weights.min())))
    return Pieces(tuple(model.id_to_piece(i) for i in plain), np.log(weights / weights.sum()))


class Lattice:
    """All cuts of words into pieces."""

    def __init__(self, pieces: Pieces):
        import ahocorasick

        self.logp, self.n = pieces.logp, len(pieces.texts)
        self.automaton = ahocorasick.Automaton()
        for i, t in enumerate(pieces.texts):
            self.automaton.add_word(t, i << 16 | len(t))
        self.automaton.make_automaton()
        self.single = np.zeros(0x110000, dtype=bool)
        self.single[[ord(t) for t in pieces.texts if len(t) == 1] + [ord("\n")]] = True
        self.other: dict[str, int] = {}  # characters that are no piece get numbers beyond the end's

    def arcs(self, words: list[str]) -> tuple[np.ndarray, ...]:
        """start, end (places in the joined words), piece and log probability of each arc, ascending by end; the words' places; each arc's word."""
        joined = "\n".join(MARK + w for w in words) + "\n"
        found = np.fromiter(chain.from_iterable(self.automaton.iter(joined)), dtype=np.int64).reshape(-1, 2)
        end, piece, size = found[:, 0] + 1, found[:, 1] >> 16, found[:, 1] & 0xFFFF
        at = np.flatnonzero(~self.single[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)])
        if len(at):
            for i in at.tolist():
                self.other.setdefault(joined[i], len(self.other))
            kind = np.array([self.n + 257 + self.other[joined[i]] for i in at], dtype=np.int64)
            end, piece, size = np.concatenate((end, at + 1)), np.concatenate((piece, kind)), np.concatenate((size, np.ones_like(at)))
            order = np.argsort(end, kind="stable")
            end, piece, size = end[order], piece[order], size[order]
        spelled = np.array([sum(self.logp[self.n + b] for b in c.encode("utf-8", "surrogatepass")) for c in self.other])
        lengths = np.array([len(w) + 2 for w in words], dtype=np.int64)
        starts = np.cumsum(lengths) - lengths
        word = np.repeat(np.arange(len(words)), lengths)[end - 1]
        return end - size, end, piece, np.concatenate((self.logp, spelled))[piece], starts, word

    def forward(self, words: list[str]) -> np.ndarray:
        start, end, _, lp, first, word = self.arcs(words)
        alpha = _forward(start, end, lp, first, word, words)
        return alpha[first + np.array([len(w) + 1 for w in words])]

    def expected(self, words: list[str], times: np.ndarray, into: np.ndarray) -> None:
        """Add the expected counts of pieces and bytes."""
        start, end, piece, lp, first, word = self.arcs(words)
        last = first + np.array([len(w) + 1 for w in words])
        alpha = _forward(start, end, lp, first, word, words)
        # the backward recursion is the forward one on mirrored places
        total = int(last[-1]) + 1
        order = np.argsort(total - start, kind="stable")
        mirrored = _forward((total - end)[order], (total - start)[order], lp[order], (total - last)[::-1].copy(), len(words) - 1 - word[order], words[::-1])
        beta = mirrored[total - np.arange(total + 1)]
        share = np.exp(alpha[start] + lp + beta[end] - alpha[last][word]) * times[word]
        counts = np.bincount(piece, weights=share, minlength=self.n + 257 + len(self.other))
        into[: self.n] += counts[: self.n]
        for c, k in self.other.items():
            for b in c.encode("utf-8", "surrogatepass"):
                into[self.n + b] += counts[self.n + 257 + k]


def _forward(start: np.ndarray, end: np.ndarray, lp: np.ndarray, first: np.ndarray, word: np.ndarray, words: list[str]) -> np.ndarray:
    """Log probability of reaching each place from its word's first. Arcs ascend by end. Words advance side by side."""
    alpha = np.full(int(first[-1]) + len(words[-1]) + 3, -np.inf)
    alpha[first] = 0.0
    depth = end - first[word]
    order = np.argsort(depth.astype(np.uint16) if len(depth) and depth.max() < 65536 else depth, kind="stable")
    start, end, lp, depth = start[order], end[order], lp[order], depth[order]
    cuts = np.searchsorted(depth, np.arange(1, depth[-1] + 2)) if len(depth) else np.zeros(1, dtype=np.int64)
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if a == b:
            continue
        to, value = end[a:b], alpha[start[a:b]] + lp[a:b]
        new = np.flatnonzero(np.concatenate(([True], to[1:] != to[:-1])))
        top = np.maximum.reduceat(value, new)
        size = np.diff(np.append(new, b - a))
        safe = np.where(np.isfinite(top), top, 0.0)
        alpha[to[new]] = safe + np.log(np.add.reduceat(np.exp(value - np.repeat(safe, size)), new))
    return alpha


@functools.lru_cache(maxsize=2)
def _lattice_of(key: str, shared) -> Lattice:
    return Lattice(shared.value)


def _groups(words: list[str]) -> Iterator[list[int]]:
    """Words that are worked on together: of like length, and not too many characters."""
    order = sorted(range(len(words)), key=lambda i: len(words[i]))
    at = 0
    while at < len(order):
        size, stop = 0, at
        while stop < len(order) and stop - at < 20_000 and (size == 0 or size + len(words[order[stop]]) < 300_000):
            size += len(words[order[stop]])
            stop += 1
        yield order[at:stop]
        at = stop


def tokens(text: str | None) -> list[str]:
    return [w.decode("utf-8", "surrogatepass") for w in (text or "").encode("utf-8", "surrogatepass").lower().split()]


def count_words(docs: DataFrame) -> DataFrame:
    """docs: training boolean, text. Gives word, n (occurrences in training) of every word, and of '' (in no text) the texts."""

    def work(batches) -> Iterator[dict]:
        counts: Counter = Counter()
        texts = 0
        for batch in batches:
            for training, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = (text.as_py() or "").encode("utf-8", "surrogatepass").lower().split()
                if training:
                    counts.update(found)
                    texts += 1
                else:
                    for w in set(found):
                        counts[w] += 0
                if len(counts) > FLUSH_WORDS:
                    yield {"word": [w.decode("utf-8", "surrogatepass") for w in counts], "n": list(counts.values())}
                    counts = Counter()
        yield {"word": [*(w.decode("utf-8", "surrogatepass") for w in counts), ""], "n": [*counts.values(), texts]}

    return mapped(docs, work, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def fit(words: DataFrame, settings: Settings) -> Pieces:
    """words: word, n (stored). To the driver come as many numbers as there are pieces, each round."""
    pieces = load_pieces(settings)
    prior = np.exp(pieces.logp)
    spark = words.sparkSession
    ends = words.filter("word = ''").agg(F.sum("n")).first()[0] or 0
    if not ends:
        return pieces
    for k in range(settings.rounds):
        shared = spark.sparkContext.broadcast(pieces)

        def work(batches, shared=shared, key=f"fit-{k}-{id(pieces)}") -> Iterator[dict]:
            lattice, into = _lattice_of(key, shared), np.zeros(len(shared.value.logp))
            for batch in batches:
                names = batch.column(0).to_pylist()
                for group in _groups(names):
                    lattice.expected([names[i] for i in group], np.ones(len(group)), into)
            some = np.flatnonzero(into)
            yield {"piece": some, "micros": np.rint(into[some] * 1e6).astype(np.int64)}

        found = mapped(words.filter("word <> '' and n > 0"), work, "piece int, micros bigint").groupBy("piece").agg(F.sum("micros").alias("n")).toPandas()
        counts = settings.pseudo * prior
        counts[found.piece.to_numpy(dtype=np.int64)] += found.n.to_numpy(dtype=float) / 1e6
        counts[-1] += 1
        pieces = Pieces(pieces.texts, np.log(counts / counts.sum()))
    return pieces


def joined_logp(n, spelled, total: int, kinds: int):
    """Natural log probability of a token seen n times whose pieces have the log probability `spelled`."""
    kinds = max(kinds, 1)
    return np.logaddexp(np.log(np.maximum(n, 1e-300)), math.log(kinds) + spelled) - math.log(total + kinds)


def word_scores(words: DataFrame, pieces: Pieces, total: int, kinds: int) -> DataFrame:
    """word, n, logp (base 10) of every word."""
    shared = words.sparkSession.sparkContext.broadcast(pieces)

    def work(batches) -> Iterator[dict]:
        lattice = _lattice_of(f"score-{id(shared)}", shared)
        for batch in batches:
            names = batch.column(0).to_pylist()
            logp = np.zeros(len(names))
            for group in _groups(names):
                logp[group] = lattice.forward([names[i] for i in group])
            logp = joined_logp(batch.column(1).to_numpy(), logp, total, kinds) / math.log(10)
            yield {"word": batch.column(0), "n": batch.column(1), "logp": logp}

    return mapped(words.filter("word <> ''"), work, "word string, n bigint, logp double")


def score(docs: DataFrame, held_out, settings: Settings = Settings(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, a row for each row of docs.

    held_out: Column of the rows not to learn from. base_score: a word unigram's with half a count for each word."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), held_out.alias("held_out"), F.col(text).alias("text"))
    words = stored(count_words(rows.select(~F.col("held_out"), "text")), "words")
    total, kinds, ends = words.agg(F.sum("n"), F.count_if(F.col("n") > 0), F.sum(F.when(F.col("word") == "", F.col("n")))).first()
    total, ends = total or 0, ends or 0
    below = math.log10(total + 0.5 * (kinds + 1))
    pieces = fit(words, settings)
    table = stored(word_scores(words, pieces, total, kinds), "word-scores")
    top = table.orderBy(F.desc("n"), "word").limit(settings.frequent).toArrow().to_pydict()
    frequent = docs.sparkSession.sparkContext.broadcast({w.encode("utf-8", "surrogatepass"): (n, p) for w, n, p in zip(top["word"], top["n"], top["logp"])})
    end_base, end_logp = math.log10(ends + 0.5) - below, float(joined_logp(ends, pieces.end, total, kinds)) / math.log(10)

    def work(batches) -> Iterator[dict]:
        known_words, key = frequent.value, TaskContext.get().partitionId() << 40
        for batch in batches:
            columns: dict[str, list] = {k: [] for k in ("row", "n_tokens", "n_known", "base", "logp", "words", "times")}
            for t in batch.column(2):
                found = Counter((t.as_py() or "").encode("utf-8", "surrogatepass").lower().split())
                rest, known, base, logp = [], int(ends > 0), end_base, end_logp
                for w, times in found.items():
                    if hit := known_words.get(w):
                        n, p = hit
                        known += times * (n > 0)
                        base += times * (math.log10(n + 0.5) - below)
                        logp += times * p
                    else:
                        rest.append(w)
                for k, v in zip(columns, (key, found.total() + 1, known, base, logp, [w.decode("utf-8", "surrogatepass") for w in rest], [found[w] for w in rest])):
                    columns[k].append(v)
                key += 1
            yield {"doc_id": batch.column(0), "held_out": batch.column(1), **columns}

    kind = docs.schema[doc_id].dataType.simpleString()
    parts = stored(mapped(rows, work, f"doc_id {kind}, held_out boolean, row bigint, n_tokens bigint, n_known bigint, base double, logp double, words array<string>, times array<bigint>"), "scored-parts")
    rest = parts.select("row", F.inline(F.arrays_zip(F.col("words").alias("word"), F.col("times").alias("times")))).join(table, "word")
    rest = rest.groupBy("row").agg(
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("known_more"),
        F.sum(F.col("times") * (F.log10(F.col("n") + 0.5) - below)).alias("base_more"),
        F.sum(F.col("times") * F.col("logp")).alias("logp_more"),
    )
    return parts.drop("words", "times").join(rest, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("known_more", F.lit(0))).alias("n_known"), F.lit(total).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("base_more", F.lit(0.0))).alias("base_score"), (F.col("logp") + F.coalesce("logp_more", F.lit(0.0))).alias("score"),
    )
