"""Language ID by held-out accuracy and exact vectors, lattice scores against all cuts."""

import math
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from caudal.llm import langid, lattice, queries
from tests.llm.conftest import documents

SF = "/root/testdata/sf0.01"


def test_bundle_is_the_sum_of_bound_trigrams():
    space = langid.Space(64, 3)
    v = lambda c: langid._letter_vector(space, ord(c) if c else 0).astype(int)
    text = "Ab1é"
    want = np.zeros(64, dtype=int)
    for a, b, c in (("", "a", "b"), ("a", "b", ""), ("", "é", "")):
        want += np.roll(v(a), 2) * np.roll(v(b), 1) * v(c)
    sums, letters = langid.bundles(space, ["", text, "12"])
    assert sums[1].tolist() == want.tolist() and letters.tolist() == [0, 3, 0] and not sums[[0, 2]].any()


def test_pieces_of_a_long_text_add_up(monkeypatch):
    rng = random.Random(1)
    text = "".join(rng.choice("abc dé\n") for _ in range(5000))
    whole, n = langid.bundles(langid.Space(), [text, "x" + text])
    monkeypatch.setattr(langid, "PIECE", 111)
    parts, m = langid.bundles(langid.Space(), [text, "x" + text])
    assert np.array_equal(whole, parts) and np.array_equal(n, m)


def test_held_out_accuracy(spark):
    got = queries.op10_language(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == 1000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    held_out = [r for r in got if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held_out) > 0.95 * len(held_out)


def test_odd_texts_and_odd_training(spark):
    docs = documents(spark, [(1, "the the", "en", "s"), (2, "der die", "de", "s"), (3, None, "fr", "s"), (4, "le", None, "s"), (5, "42 !", "xx", "s"), (None, "", "en", "s"), (2, "der die", "de", "s")])
    docs = docs.withColumn("lang_pred", F.lit("clash"))
    got = langid.predict(docs, langid.learn(docs), ["doc_id"]).collect()
    assert sorted((r.doc_id or 0, r.lang_pred) for r in got) == [(0, "und"), (1, "en"), (2, "de"), (2, "de"), (3, "und"), (4, "de" if [r.lang_pred for r in got if r.doc_id == 4] == ["de"] else "en"), (5, "und")]
    nothing = langid.predict(docs, langid.learn(docs.limit(0)), ["doc_id"]).collect()
    assert {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)}
    assert langid.predict(docs.limit(0), langid.learn(docs), ["doc_id"]).count() == 0


PIECES = lattice.Pieces(("▁", "a", "b", "ab", "▁a", "ba", "aba", "▁ab"), np.log(np.array([0.1, 0.1, 0.05, 0.1, 0.15, 0.05, 0.05, 0.1] + [0.3 / 257] * 257)))


def cuts(word):
    """All ways to cut a word, with the probability of each."""
    def rest(i):
        if i == len(word):
            return [([], 1.0)]
        out = []
        for j in range(i + 1, len(word) + 1):
            if word[i:j] in PIECES.texts:
                k = PIECES.texts.index(word[i:j])
                out += [([k, *r], p * math.exp(PIECES.logp[k])) for r, p in rest(j)]
        if word[i] not in PIECES.texts:
            out += [([8 + b for b in word[i].encode()] + r, p * math.exp(sum(PIECES.logp[8 + b] for b in word[i].encode()))) for r, p in rest(i + 1)]
        return out
    return rest(0)


def test_forward_and_expected_counts_over_all_cuts():
    words = ["ab", "a", "abab", "babaab", "é", "aéb漢", "a" * 12]
    model = lattice.Lattice(PIECES)
    assert np.allclose(model.forward(words), [math.log(sum(p for _, p in cuts("▁" + w))) for w in words])
    into, want = np.zeros(265), np.zeros(265)
    model.expected(words, np.arange(1.0, 8.0), into)
    for k, w in enumerate(words):
        every = cuts("▁" + w)
        total = sum(p for _, p in every)
        for pieces, p in every:
            for x in pieces:
                want[x] += (k + 1) * p / total
    assert np.allclose(into, want)


def test_very_long_words_do_not_underflow():
    assert np.isfinite(lattice.Lattice(PIECES).forward(["ab" * 5000, "漢" * 3000])).all()


def test_scores_against_counts(spark):
    rows = [(i, t) for i, t in enumerate(["The cat sat", "the dog sat on the cat", "a bird flew", None, "", "the the the", "zebra quux the", "one two three four", "the\x0bcat é"] * 3)] + [(None, "the")]
    docs = documents(spark, rows).withColumn("score", F.lit("clash"))
    out = {f: lattice.score(docs, langid.fold("doc_id", 5) == 1, lattice.Settings(frequent=f)).collect() for f in (1, 1000)}
    assert sorted(map(repr, ((r.doc_id, r.n_tokens, r.n_known, round(r.score, 9)) for r in out[1]))) == sorted(map(repr, ((r.doc_id, r.n_tokens, r.n_known, round(r.score, 9)) for r in out[1000])))
    held = lambda d: zlib.crc32(b"" if d is None else str(d).encode()) % 5 == 1
    words = lambda t: [*((t or "").encode().lower().split()), None]
    counts = {}
    for d, t in rows:
        if not held(d):
            for w in words(t):
                counts[w] = counts.get(w, 0) + 1
    total, kinds = sum(counts.values()), len(counts)
    base = lambda t: sum(math.log10((counts.get(w, 0) + 0.5) / (total + 0.5 * (kinds + 1))) for w in words(t))
    want = sorted(repr((d, held(d), len(words(t)), sum(counts.get(w, 0) > 0 for w in words(t)), total, round(base(t), 8))) for d, t in rows)
    assert sorted(repr((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 8))) for r in out[1000]) == want
    assert all(r.score < 0 for r in out[1000])
    untrained = lattice.score(docs, F.lit(True)).collect()
    assert {r.train_tokens for r in untrained} == {0} and {r.n_known for r in untrained} == {0} and all(np.isfinite(r.score) for r in untrained)
    assert lattice.score(docs.limit(0), F.lit(False)).count() == 0


def test_new_words_share_what_is_left():
    """Seen words' arcs and the share of new words add up to one."""
    seen = np.array([5, 3, 2])
    known = np.exp(lattice.joined_logp(seen, np.array([-1e9] * 3), 10, 3)).sum()
    new = np.exp(lattice.joined_logp(np.array([0]), np.array([0.0]), 10, 3))[0]
    assert math.isclose(known + new, 1.0)
