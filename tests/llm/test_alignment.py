"""Alignment of two tokenizers against whole texts encoded at once and cut by bytes alone."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from caudal.llm import align, queries
from tests.llm.conftest import documents

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def plain():
    """text -> (a, b, groups) by whole texts and decoded bytes; None if they don't spell it."""
    a = Tokenizer.from_file(align.BYTE_BPE)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=align.PIECE_BPE)
    letters = align.byte_of_letter()

    def ends(parts):
        at, out = 0, []
        for p in parts:
            at += len(p)
            out.append(at)
        return out

    def of(text):
        if not text:
            return None
        data = b" " + text.encode()
        x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        xs = [bytes(letters[c] for c in a.id_to_token(i)) for i in x]
        ys = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in y]
        if b"".join(xs) != data or b"".join(ys) != data:
            return None
        xe, ye = ends(xs), ends(ys)
        where, groups, i, j = dict(zip(ye, range(1, len(ye) + 1))), [], 0, 0
        for k, cut in enumerate(xe, 1):
            if cut in where:
                groups.append((x[i:k], y[j : where[cut]]))
                i, j = k, where[cut]
        return x, y, groups

    return of


def expected(plain, rows):
    parsed = [(doc, plain(text)) for doc, text in rows]
    counts = Counter((g[0][-1], g[1][-1]) for _, p in parsed if p for g in p[2])
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    for doc, p in parsed:
        if p is None:
            yield (doc, 0, 0, 0, 0, 0, 0, "")
            continue
        pairs = [(g[0][-1], g[1][-1]) for g in p[2]]
        groups = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in p[2])
        yield (doc, len(p[0]), len(p[1]), len(pairs), len(pairs), sum(counts[x] == most[x[1]] for x in pairs), sum(counts[x] for x in pairs), groups)


def rows_of(df):
    return sorted(((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups) for r in df.collect()), key=repr)


def test_odd_texts(spark, plain):
    rng = random.Random(1)
    alphabet = list("ab e  \n\t.,'s12€漢𓀀é▁ \x1c\r") + ["<0x0A>", "<|endoftext|>", "<s>", "</s>", " don't", "👩‍👩‍👧", "‍", "é"]
    texts = [None, "", " ", "  ", "a", "\n", "a  b", " a", "a ", "𓀀𓀀", "漢字 漢字", "a▁b", "<|endoftext|> <s>", "\x00", "é ẞ", "x" * 5000, "word " * 3000]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60))) for _ in range(400)]
    rows = [(i if i % 7 else None, t) for i, t in enumerate(texts)] + [(5, "a  b"), (5, "a  b"), (6, "again")]
    docs = documents(spark, rows).withColumns({"chunk": F.lit(1), "pairs": F.lit("x"), "used": F.lit(2)})
    got = align.align(docs.repartition(3), chunk=200)
    assert rows_of(got) == sorted(expected(plain, rows), key=repr)
    assert sum(r[1] > 0 for r in expected(plain, rows)) > 150  # the others hold U+2581


def test_hot_text_in_many_chunks(spark, plain):
    rows = [(i, "the same passage, over and over" if i % 3 else f"text number {i} of its own") for i in range(300)]
    assert rows_of(align.align(documents(spark, rows).repartition(8), chunk=100)) == sorted(expected(plain, rows), key=repr)


def test_empty_table(spark):
    assert align.align(documents(spark, [])).collect() == []


def test_whole_table(spark, plain):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    digest = lambda g: hashlib.sha256(g.encode()).hexdigest() if g else ""
    want = sorted(((*x[:7], digest(x[7])) for x in expected(plain, rows)), key=repr)
    got = queries.op13_token_alignment(spark, SF)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want


def test_tokens_that_share_a_character():
    found = next(align.Encoders(align.Vocabularies.read()).aligned(["a𓀀é"]))
    assert found.sizes.tolist() == found.n_a.tolist() == found.n_b.tolist() == [6]
    assert [len(g.split("|")[0].split(",")) for g in found.groups[0].split(";")] == [1, 1, 1, 1, 1, 1]


def test_stretches_encoded_together_are_those_encoded_alone():
    encoders = align.Encoders(align.Vocabularies.read())
    stretches = ["a", "don't", "é漢", " b", "c\n", "x▁y", "Zug,", "12", "👩‍👩‍👧", "\x1c", "end"]
    together, alone = (
        [(a, b, n, g) for x in found for a, b, n, g in zip(x.n_a.tolist(), x.n_b.tolist(), x.sizes.tolist(), x.groups)]
        for found in (encoders.aligned(stretches), (x for s in stretches for x in encoders.aligned([s])))
    )
    assert together == alone and [n for _, _, n, _ in alone].count(0) == 1
