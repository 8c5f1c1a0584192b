"""Patterns against plain regular expressions, the field against all tag sequences, and both on whole tables."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from caudal.llm import pii, queries
from tests.llm.conftest import documents

SF = "/root/testdata/sf0.01"
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        total += int(d) if i % 2 == 0 else sum(map(int, str(2 * int(d))))
    return total % 10 == 0


def plain_spans(text):
    out = []
    for rank, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub(r"[^0-9]", "", m[0])
            good = {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")), "card": lambda: 14 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 10 <= len(digits) <= 15}[kind]
            if good():
                out.append((m.start(), rank, m.end()))
    return sorted(out)


@pytest.fixture(scope="module")
def field(spark):
    return pii.train(pii.labelled_texts(spark))


def test_patterns_are_the_plain_ones():
    rng = random.Random(1)
    for alphabet in ("a1@.-_ %+é", "0123456789.- +()", "12.@", "45 -", "a@b.c d"):
        for _ in range(3000):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40)))
            assert pii.base_spans(text) == plain_spans(text), text
    for text in ("+1 (017) 555-7713", "4111 1111-1111 1111", "a@b.co_x@d.ef", "1.2.3.4.5.6.7.8", "x" * 50_000 + "@", "9" * 50_000, "1." * 20_000, "+1" * 20_000):
        assert pii.base_spans(text) == plain_spans(text) if len(text) < 100 else pii.base_spans(text) is not None


def test_viterbi_and_sums_are_those_of_all_tag_sequences():
    rng = np.random.default_rng(2)
    begins = np.array([0, 3, 3, 4, 8])
    scores, moves = rng.normal(size=(8, 9)), pii._allowed() + rng.normal(size=(10, 9))
    tags = pii.viterbi(scores, begins, moves)
    marginal, moved, total = pii._expected(scores, begins, moves)
    logs, seen, expected = 0.0, np.zeros((8, 9)), np.zeros((10, 9))
    for a, b in zip(begins[:-1], begins[1:]):
        if a == b:
            continue
        ways = list(itertools.product(range(9), repeat=b - a))
        value = np.array([sum(scores[a + i, t] for i, t in enumerate(w)) + moves[9, w[0]] + sum(moves[x, y] for x, y in zip(w, w[1:])) for w in ways])
        assert tuple(tags[a:b]) == ways[int(value.argmax())]
        z = np.log(np.exp(value).sum())
        logs += z
        for w, p in zip(ways, np.exp(value - z)):
            if p > 1e-12:
                expected[9, w[0]] += p
                for i, t in enumerate(w):
                    seen[a + i, t] += p
                for x, y in zip(w, w[1:]):
                    expected[x, y] += p
    assert np.allclose(total, logs) and np.allclose(marginal, seen, atol=1e-6) and np.allclose(moved, expected, atol=1e-6)


def test_batches_do_not_matter(field):
    texts = [pii.parse_marked(line)[0] for line in pii.LABELLED.strip().splitlines()] + ["", "no anchor here", "1 " * 3000]
    alone = [next(pii.proposed([t], field)) for t in texts]
    assert list(pii.proposed(texts, field)) == alone


def test_field_learns_the_table_and_finds_what_patterns_would(field):
    lines = [pii.parse_marked(line) for line in pii.LABELLED.strip().splitlines()]
    right = sum(found == spans for (_, spans), found in zip(lines, pii.proposed([t for t, _ in lines], field)))
    assert right >= 0.95 * len(lines)


def test_field_alone_on_documents(spark, field):
    """Held out: the patterns' spans in documents that training never sees."""
    texts = [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("text").collect()]
    base = [set(pii.base_spans(t)) for t in texts]
    found = [set(p) for p in pii.proposed(texts, field)]
    assert sum(map(len, base)) > 500 and sum(len(a & b) for a, b in zip(base, found)) >= 0.75 * sum(map(len, base))


def test_added_spans(field):
    texts = {
        "und +1 (826) 555-4081 190.137.223.204 du": ["+1 (826) 555-4081"], "both {7536784127813050 4845168114407329} stay": ["7536784127813050", "4845168114407329"],
        "write to jane.roe (at) web.example.org today": ["jane.roe (at) web.example.org"], "call (243) 555-0199 now": ["(243) 555-0199"],
        "in 2019 there were 3 of 12, that is 25 percent": [], "a@b.example.org": [], "": [],
    }
    for text, want in texts.items():
        base = pii.base_spans(text)
        added = pii.added_spans(text, base, next(pii.proposed([text], field)))
        assert [text[a:b] for a, _, b in added] == want, text
        assert all(not (a < y and x < b) for a, _, b in added for x, _, y in base)


def test_query_on_a_whole_table(spark):
    got = queries.op11_personal_data(spark, SF)
    assert got.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"]
    rows = {r.doc_id: r for r in got.collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(docs)
    for r in docs:
        spans = plain_spans(r.text or "")
        told = [f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in spans]
        mine = rows[r.doc_id]
        assert mine.base_sha256 == hashlib.sha256(",".join(told).encode()).hexdigest()
        assert [mine.n_email, mine.n_ip, mine.n_card, mine.n_phone] == [sum(k == i for _, k, _ in spans) for i in range(4)]
        every = mine.spans.split(",") if mine.spans else []
        assert set(told) <= set(every) and len(every) == len(told) + mine.n_added
        assert [(int(x.split(":")[1]), pii.KINDS.index(x.split(":")[0])) for x in every] == sorted((int(x.split(":")[1]), pii.KINDS.index(x.split(":")[0])) for x in every)


def test_odd_rows(spark, field):
    long = "word " * 200_000 + "a@b.example.org"
    rows = [(None, "x 1.2.3.4"), (1, None), (2, ""), (3, "é𓀀 a@b.co"), (3, "é𓀀 a@b.co"), (4, long), (5, "\x00 +1 (243) 555-5526\n4111 1111 1111 1111")]
    docs = documents(spark, rows).withColumns({"base": F.lit(1), "added": F.lit("x"), "start": F.lit(2)})
    got = pii.find(docs, field, keep_text=True).collect()
    told = sorted(((r.doc_id, r.text, [(s.start, s.kind, s.end) for s in r.base]) for r in got), key=repr)
    want = [(d, t, [(a, pii.KINDS[k], b) for a, k, b in plain_spans(t or "")]) for d, t in rows]
    assert told == sorted(want, key=repr)
    assert pii.find(documents(spark, []), field).collect() == []


def test_labelled_table_is_bounded(spark):
    with pytest.raises(ValueError):
        pii.train(pii.labelled_texts(spark), max_labelled=3)
    nothing = pii.train(pii.labelled_texts(spark).limit(0))
    assert next(pii.proposed(["call +1 (243) 555-5526"], nothing)) == []
