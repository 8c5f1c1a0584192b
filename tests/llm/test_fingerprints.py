"""Parsing fingerprints and SimHash groups against brute force."""

import hashlib
import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from caudal.llm import parsing, simhash
from tests.llm.conftest import documents


def text_of(rng, n, alphabet="abcdefgh "):
    return "".join(rng.choice(alphabet) for _ in range(n))


def test_equal_substrings_share_interior_phrases():
    rng = random.Random(1)
    text = text_of(rng, 3000)

    def names(t):
        return {(level, int(n)) for level, names, *_ in parsing.levels([t]) for n in names if level >= 2}

    inner, other = names(text[500:2500]), names("zz" * 9 + text[500:2500] + "qq")
    assert len(inner & other) > 0.9 * len(inner)
    assert len(inner & names(text_of(rng, 2000))) < 0.1 * len(inner)


def test_sketches_do_not_depend_on_the_batch():
    rng = random.Random(2)
    texts = [text_of(rng, n) for n in (0, 1, 2, 3, 10, 500, 5000)] + ["a" * 1000, "é漢" * 50]
    alone = np.concatenate([parsing.sketches([t]) for t in texts])
    assert (parsing.sketches(texts) == alone).all()
    assert (parsing.sketches(texts[::-1])[::-1] == alone).all()
    assert parsing.likeness(alone[:1], alone[:1]) == 1 and parsing.likeness(alone[:1], alone[1:2]) == 0


def test_phrases_cover_the_text_at_every_level(spark):
    docs = documents(spark, [(1, "the cat sat on the mat and the dog sat too"), (2, None), (3, "aaaa")])
    rows = parsing.phrases(docs).collect()
    for doc, n in ((1, 42), (3, 4)):
        level = max(r.level for r in rows if r.doc_id == doc)
        assert [(r.begin, r.length) for r in rows if r.doc_id == doc and r.level == level] == [(0, n)]
        for k in range(level + 1):
            spans = sorted((r.begin, r.length) for r in rows if r.doc_id == doc and r.level == k)
            assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:])) and sum(n for _, n in spans) == n
    assert not [r for r in rows if r.doc_id == 2]


def brute_edited(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    out = []
    for i, (doc, text) in enumerate(rows):
        text, following = text or "", rows[(i + 1) % len(rows)][1] or ""
        n = len(text)
        edited = text[: n - n // 4] + following[: n // 4]
        a, b, c = parsing.sketches([text, edited, following])
        out.append((doc, n, hashlib.sha256(edited.encode()).hexdigest(), parsing.as_text(a[None])[0], float(parsing.likeness(a[None], b[None])[0]), float(parsing.likeness(a[None], c[None])[0])))
    return sorted(out, key=repr)


def test_edited_fingerprints(spark):
    rng = random.Random(3)
    rows = [(i * 7 % 101, text_of(rng, rng.choice([0, 1, 3, 50, 4000]))) for i in range(101)]
    rows += [(None, "no id"), (500, None), (501, "twice"), (501, "twice"), (501, "also")]
    for some in (rows, rows[:1], rows[:2]):
        got = parsing.edited_fingerprints(documents(spark, some).withColumn("fingerprint", F.lit("clash")))
        found = sorted([(r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.near_edited, r.near_next) for r in got.collect()], key=repr)
        assert found == brute_edited(some)
    assert parsing.edited_fingerprints(documents(spark, rows).limit(0)).count() == 0


def brute_print(text, shingle=3):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, radius):
    parent = {i: i for i in range(len(prints))}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(prints))]


def test_print_of_text():
    for t in (None, "", " \n", "a", "A b", "a b c d e", "X\x0by\tÉ z  q " * 30):
        assert simhash.text_fingerprint(t) == [brute_print(t)]


def test_local_components_in_small_and_large_nodes():
    rng = np.random.default_rng(1)
    for _ in range(12):
        prints = rng.integers(0, 2**63, (5, 1)).astype(np.uint64)[rng.integers(0, 5, 400)]
        for _ in range(3):
            some = rng.random(400) < 0.5
            prints[some] ^= np.uint64(1) << rng.integers(0, 64, (some.sum(), 1)).astype(np.uint64)
        node = np.sort(rng.integers(0, int(rng.integers(1, 60)), 400))
        got = simhash.local_components(node, prints, 2)
        for k in np.unique(node):
            at = np.flatnonzero(node == k)
            assert [int(at[x]) for x in brute_components([int(p) for p in prints[at, 0]], 2)] == got[at].tolist()


def test_groups_with_hot_nodes_and_odd_rows(spark):
    rng = random.Random(4)
    base = text_of(rng, 1500, "abcd    ")
    rows = []
    for i in range(60):
        words = base.split()
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = rng.choice("xyz")
        rows.append((i, " ".join(words)))
    rows += [(200 + i, text_of(rng, 300)) for i in range(8)] + [(300, ""), (301, None), (302, " "), (303, "one"), (None, "one"), (304, base), (304, base)]
    docs = documents(spark, rows).withColumn("w0", F.lit("clash"))
    prints = [brute_print(t) for _, t in rows]
    known = [(d, p) for (d, _), p in zip(rows, prints) if d is not None]
    roots = brute_components([p for _, p in known], 2)
    lowest = {}
    for (d, _), r in zip(known, roots):
        lowest[r] = min(d, lowest.get(r, d))
    want = sorted((d, lowest[r]) for (d, _), r in zip(known, roots))
    for index in (simhash.Index(), simhash.Index(segments=3, node_rows=25)):
        got = simhash.near_duplicate_groups(docs, index).collect()
        assert sorted((r.doc_id, r.component_id) for r in got if r.doc_id is not None) == want
        assert [r.component_id for r in got if r.doc_id is None] == [None]
        assert sorted(r.w0 % 2**64 for r in got) == sorted(prints)
    assert simhash.near_duplicate_groups(docs.limit(0)).count() == 0


def test_copies_go_and_clean_documents_stay(spark):
    rng = random.Random(5)
    words = lambda n: [text_of(rng, 6, "abcdefghijklmnop") for _ in range(n)]
    rows = []
    for i in range(25):
        own = words(300)
        rows.append((10 * i, " ".join(own)))
        rows.append((10 * i + 1, " ".join(own)))
        own[rng.randrange(300)] = "changed"
        own[rng.randrange(300)] = "again"
        rows.append((10 * i + 2, " ".join(own)))
    docs = documents(spark, [*rows, (None, "x"), (None, "x"), (7, ""), (8, None)]).withColumn("component_id", F.lit("kept"))
    for index in (None, simhash.Index(24, 2, None, 64, 18, node_rows=20)):
        kept = simhash.drop_near_duplicates(docs, index)
        assert kept.columns == docs.columns
        ids = sorted((r.doc_id for r in kept.collect()), key=repr)
        assert ids == sorted([10 * i for i in range(25)] + [None, None, 7], key=repr)
    assert simhash.recall(simhash.similar(0.8), 0.8) > 0.95


def brute_kept(rows, shingle=5, similarity=0.8):
    """The first document of each group that exact Jaccard similarities link."""
    def shingles(text):
        w = text.split()
        return {tuple(w[i : i + shingle]) for i in range(max(1, len(w) - shingle + 1))}

    sets, parent = [shingles(t) for _, t in rows], list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [rows[i][0] for i in range(len(rows)) if root(i) == i]


def changed(rng, words, share):
    """The words with one changed run, so long that about `share` of them are no longer those of the original."""
    n = max(1, round(len(words) * share))
    at = rng.randrange(len(words) - n)
    return [*words[:at], *(text_of(rng, 6, "ABCDEFGHIJ") for _ in range(n)), *words[at + n :]]


def test_only_pairs_of_the_similarity_are_copies(spark):
    rng = random.Random(6)
    rows = []
    for i in range(200):
        own = [text_of(rng, 6, "abcdefghijklmnop") for _ in range(150)]
        rows += [(2 * i, " ".join(own)), (2 * i + 1, " ".join(changed(rng, own, 0.02 + 0.23 * i / 200)).lower())]  # similarity 0.92 to 0.55
    want = brute_kept(rows)
    kept = sorted(r.doc_id for r in simhash.drop_near_duplicates(documents(spark, rows)).collect())
    assert 250 < len(want) < 350 and set(want) <= set(kept)  # no clean document goes


def test_recall_counts_the_radius_and_the_masks_together(spark):
    index = simhash.similar(0.8)
    masks = np.array(index.upper_masks(), dtype=np.int64).view(np.uint64)
    rng = np.random.default_rng(7)
    for similarity in (0.8, 0.85):
        angle = np.arccos(2 * similarity / (1 + similarity)) / np.pi
        differ = np.packbits(rng.random((4000, 128)) < angle, axis=1).view(np.uint64)
        near = np.bitwise_count(differ).sum(axis=1) <= index.radius
        found = near & (((differ[:, None] & masks[None]) == 0).all(axis=2)).any(axis=1)
        assert abs(found.mean() - simhash.recall(index, similarity)) < 0.01
    assert simhash.recall(index, 0.8) > 0.99
    rng = random.Random(8)
    rows = []
    for i in range(150):
        own = [text_of(rng, 6, "abcdefghijklmnop") for _ in range(150)]
        rows += [(2 * i, " ".join(own)), (2 * i + 1, " ".join(changed(rng, own, 0.08)))]  # similarity 0.80 to 0.82
    want = brute_kept(rows)
    kept = {r.doc_id for r in simhash.drop_near_duplicates(documents(spark, rows)).collect()}
    assert len(want) == 150 and set(want) <= kept and len(kept) <= 153


def test_large_nodes_lose_no_link(spark):
    rng = random.Random(9)
    base = [text_of(rng, 6, "abcdefghijklmnop") for _ in range(200)]
    rows = [(i, " ".join(changed(rng, base, rng.choice([0.05, 0.1, 0.15, 0.3])))) for i in range(150)]
    docs = documents(spark, rows)
    for index in (simhash.Index(20, 2, None, 32, 12), simhash.Index(36, 2, None, 192, 16)):
        small = simhash.Index(index.radius, 2, None, index.masks, index.mask_bits, node_rows=20)
        of = lambda x: sorted((r.doc_id, r.component_id) for r in simhash.near_duplicate_groups(docs, x, 5).collect())
        assert of(small) == of(index)
    kept = lambda x: sorted(r.doc_id for r in simhash.drop_near_duplicates(docs, x).collect())
    assert kept(small) == kept(index) == brute_kept(rows)


def test_odd_sketches_rule_out_only_what_is_under_the_similarity():
    rng = np.random.default_rng(11)
    ruled_out = 0
    for _ in range(2000):
        n, share = int(rng.integers(1, 400)), rng.random()
        common, own = rng.integers(0, 2**64, (2, n), dtype=np.uint64)
        x, y = np.unique(common), np.unique(np.where(rng.random(n) < 0.4 * share, own, common))
        both = len(np.intersect1d(x, y))
        similar = both >= 0.8 * (len(x) + len(y) - both)
        sketches = [np.array([simhash.odd_sketch(z)], dtype=np.uint64) for z in (x, y)]
        may = simhash.may_be_similar(*sketches, np.array([len(x)]), np.array([len(y)]), 0.8)[0]
        assert may or not similar
        ruled_out += not may and not similar
    assert ruled_out > 500
    none = np.array([simhash.odd_sketch(np.zeros(0, dtype=np.uint64))], dtype=np.uint64)
    assert simhash.may_be_similar(none, none, np.array([0]), np.array([0]), 0.8).all()


def test_many_rows_without_an_id_and_names_of_the_inside(spark):
    rows = [(None, "same words here") for _ in range(40)] + [(1, "b c d e f g"), (1, None), (1, "a"), (2, "other words")]
    docs = documents(spark, rows).withColumns({"id": F.lit("x"), "row": F.lit("y"), "first": F.lit(1), "again": F.lit(2), "__id": F.lit(3)})
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    got = kept.collect()
    assert sorted(map(repr, ((r.doc_id, r.text) for r in got))) == sorted(map(repr, [(None, "same words here")] * 40 + [(1, None), (2, "other words")]))
    assert {(r["id"], r["row"], r["first"], r["again"], r["__id"]) for r in got} == {("x", "y", 1, 2, 3)}
