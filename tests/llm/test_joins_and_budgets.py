"""Mixing, quotation links and revisits against brute force."""

import collections
import hashlib
import random

from pyspark.sql import functions as F

from caudal.llm import asof, mixing, queries, quotes, revisits
from caudal.llm.mixing import Level
from caudal.llm.sql import SQL
from tests.llm.conftest import documents
from workload.check import compare_tables, oracle_connection

SF = "/root/testdata/sf0.001"


def share(children, budget):
    """children: name -> (weight, capacity). Rounds of sharing among those that are not full."""
    given, open_ = {}, {k: v for k, v in children.items() if v[0] > 0}
    while True:
        left = budget - sum(given.values())
        weights = sum(w for w, _ in open_.values())
        full = {k: c for k, (w, c) in open_.items() if c * weights <= left * w}
        if not full:
            break
        given |= full
        open_ = {k: v for k, v in open_.items() if k not in full}
    left, weights = budget - sum(given.values()), sum(w for w, _ in open_.values())
    return {**{k: 0 for k in children}, **given, **{k: left * w // weights for k, (w, _) in open_.items()}}


def brute_mix(rows, weights, budget, epochs, seed):
    """rows: (doc_id, words, domain, lang, source). Copies of each row."""
    def allocate(prefix, budget, depth, out):
        if depth == 3:
            out[prefix] = budget
            return
        kinds = sorted({r[2 + depth] for r in rows if r[2 : 2 + depth] == prefix})
        caps = {k: (weights[depth].get(k, 1), epochs * sum(r[1] for r in rows if r[2 : 3 + depth] == (*prefix, k))) for k in kinds}
        for k, b in share(caps, budget).items():
            allocate((*prefix, k), b, depth + 1, out)

    leaves = {}
    allocate((), min(budget, epochs * sum(r[1] for r in rows)), 0, leaves)
    copies = []
    for r in rows:
        leaf = [x for x in rows if x[2:] == r[2:]]
        total = sum(x[1] for x in leaf)
        whole, rest = divmod(leaves[r[2:]], total) if total else (0, 0)
        place = lambda x: hashlib.md5(f"{seed}:{whole}:{'' if x[0] is None else x[0]}".encode()).hexdigest()  # noqa: E731, B023
        upto = sum(x[1] for x in leaf if place(x) <= place(r))
        copies.append(whole + (rest > 0 and upto <= rest))
    return copies


def test_shares_and_prefixes(spark):
    rng = random.Random(1)
    rows = []
    for i in range(300):
        source = "hot" if i % 3 == 0 else rng.choice(["s1", "s2", "s3", "none"])
        n = 0 if source == "none" else rng.choice([0, 1, 5, 40])
        rows.append((i, n, "web" if source == "hot" else rng.choice(["web", "books"]), rng.choice(["en", "de", ""]), source))
    rows += [(None, 3, "web", "en", "s1"), (7, 2, "web", "en", "s1"), (7, 2, "web", "en", "s1")]
    frame = spark.createDataFrame([(d, " ".join(["w"] * n) or None, dom, lang or None, s, n) for d, n, dom, lang, s in rows], "doc_id bigint, text string, domain string, lang string, source string, tokens int")
    weights = ({"web": 3, "books": 1}, {"en": 2, "de": 0}, {"s2": 5})
    levels = [Level("domain", F.col("domain"), weights[0]), Level("lang", F.col("lang"), weights[1]), Level("source", F.col("source"), weights[2])]
    for budget in (0, 100, 2500, 10**7):
        got = mixing.mix(frame, levels, budget, max_epochs=2, seed=5)
        want = brute_mix(rows, weights, budget, 2, 5)
        found = collections.Counter((r.doc_id, r.tokens, r.domain, r.lang or "", r.source, r.copies) for r in got.collect())
        assert found == collections.Counter((*r, c) for r, c in zip(rows, want) if c)
        assert got.columns == ["doc_id", "text", "domain", "lang", "source", "tokens", "copies"]
        assert sum(key[1] * key[-1] * n for key, n in found.items()) <= budget
    assert mixing.mix(frame.limit(0), levels).count() == 0


def brute_links(messages):
    """messages: (conv, turn, text). Parent of each, by comparing passages as texts."""
    plain = lambda t: " ".join(t.lower().split())

    def passages(text):
        out = []
        lines = []
        for line in text.split("\n"):
            body, level = line, 0
            while body.lstrip(" \t").startswith(">"):
                body, level = body.lstrip(" \t")[1:], level + 1
            lines.append((level, body[1:] if level and body.startswith(" ") else body))
        for k, (level, line) in enumerate(lines):
            if k + 1 < len(lines) and lines[k + 1][0] > level and line.startswith("On ") and line.endswith(" wrote:"):
                continue
            if out and out[-1][0] == level:
                out[-1][1].append(line)
            else:
                out.append((level, [line]))
        return out

    wrote = []
    for conv, turn, text in messages:
        for level, lines in passages(text or ""):
            if level == 0:
                for piece in {plain("\n".join(lines)), *(plain(x) for x in lines)} - {""}:
                    wrote.append((conv, piece, turn))
    parents = {}
    for conv, turn, text in messages:
        found = []
        for level, lines in passages(text or ""):
            turns = [t for c, piece, t in wrote if level and c == conv and piece == plain("\n".join(lines)) and t < turn]
            asked = {plain(x) for x in lines} - {""}
            if level and asked and not turns:  # trimmed: all lines by one message
                mine = collections.defaultdict(set)
                for c, piece, t in wrote:
                    if c == conv and t < turn:
                        mine[t].add(piece)
                turns = [t for t, pieces in mine.items() if asked <= pieces]
            if turns:
                found.append((level, -max(turns)))
        parents[conv, turn] = -min(found)[1] if found else None
    return parents


def test_quotes_find_their_messages(spark):
    said = [
        (1, 0, "First thought.\nSecond  line."), (1, 1, "On turn 0, user wrote:\n> first thought.\n> Second line.\n\nI agree."),
        (1, 2, "> second line.\nOnly that one"), (1, 3, "On turn 1, b wrote:\n> On turn 0, a wrote:\n>> First thought.\n>> Second line.\n> I agree.\n\nMe too"),
        (1, 4, ">>> nobody wrote this\nNothing linked"), (1, 5, "Nothing linked"), (1, 6, "> Nothing linked\n"), (2, 0, "> I agree."), (2, 1, None), (2, 2, ""), (2, 3, ">"),
        (5, 0, "one\ntwo\nthree\nfour\nfive"), (5, 1, "two\nthree"), (5, 2, "three\nother"), (5, 3, "> two\n> three\n> four\nTrimmed"), (5, 4, "> three\n> two\nTurned"),
        (5, 5, "> two\n> nobody's\nNot all"), (5, 6, "On " + "a long day " * 40 + "she wrote:\n> five\n> one\nFar apart"), (5, 7, "> two\n> five\n> other\nOf no one message"),
        (3, 0, "same"), (3, 1, "same"), (3, 2, "> same\nlater"), (3, 3, " > later\nOn a walk she wrote:\nthe end"),
    ]
    rows = [(c, t, "user", x) for c, t, x in said] + [(1, 2, "user", said[2][2]), (None, 1, "user", "> same"), (4, None, "user", "> same")]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("hash", F.lit("clash")).withColumn("origin", F.lit(1))
    got = quotes.link_quotes(frame).collect()
    assert len(got) == len(said) + 2
    want = brute_links(said)
    assert [want[5, t] for t in range(3, 8)] == [0, 1, None, 0, None]
    own = {}
    for r in got:
        if r.conv_id is None or r.turn is None:
            assert r.parent_turn is None and r.own_text == ""
            continue
        assert r.parent_turn == want[r.conv_id, r.turn], r
        own[r.conv_id, r.turn] = r.own_text
        root, depth = r.turn, 0
        while want[r.conv_id, root] is not None:
            root, depth = want[r.conv_id, root], depth + 1
        assert (r.root_turn, r.depth) == (root, depth)
    assert own[1, 1] == "I agree." and own[1, 3] == "Me too" and own[1, 0] == said[0][2] and own[2, 1] is None and own[2, 3] == "" and own[3, 3].endswith("wrote:\nthe end")
    assert quotes.link_quotes(frame.limit(0)).count() == 0


def test_derived_replies_answer_the_turn_before(spark):
    larger = "/root/testdata/sf0.01"
    plain = lambda t: " ".join(t.lower().split())
    turns = spark.read.parquet(f"{larger}/conversations.parquet").collect()
    got = {(r.conv_id, r.turn): r for r in queries.op4_quotation_links(spark, larger).collect()}
    texts = {(r.conv_id, r.turn): r.text for r in turns}
    assert len(got) == len(texts)
    n_trimmed = 0
    for (conv, turn), r in got.items():
        assert r.own_text == texts[conv, turn].strip("\n")
        before = {t: x for (c, t), x in texts.items() if c == conv and t < turn}
        quoted = before.get(turn - 1)
        if quoted is None:
            assert r.parent_turn is None
            continue
        lines = quoted.split("\n")
        if (conv + turn) % 4 == 1 and len(lines) >= 3:
            n_trimmed += 1
            lines = lines[1:-1]
        whole = [t for t, x in before.items() if plain("\n".join(lines)) in {plain(x), *map(plain, x.split("\n"))}]
        parts = [t for t, x in before.items() if {plain(y) for y in lines} - {""} <= set(map(plain, x.split("\n")))]
        assert r.parent_turn == max(whole or parts, default=None), (conv, turn)
    assert n_trimmed > 20


def test_latest_before_with_a_hot_key(spark):
    rng = random.Random(2)
    key = lambda: "hot" if rng.random() < 0.5 else rng.choice(["a", "b", None])
    rows = [(key(), rng.choice([None, *range(60)]), i) for i in range(300)]
    events = [(key(), rng.choice([None, *range(60)]), i) for i in range(300)]
    left = spark.createDataFrame(rows, "k string, at bigint, id bigint")
    right = spark.createDataFrame(events, "k string, at bigint, id bigint").select("k", "at", F.struct("id").alias("event"))
    got = {r.id: r.event and r.event.id for r in asof.latest_before(left, right, ["k"], "at", "event").collect()}
    for k, at, i in rows:
        before = [(a, e) for x, a, e in events if k is not None and at is not None and x == k and a is not None and a < at]
        assert got[i] == (max(before)[1] if before else None)
    assert len(got) == 300
    assert asof.latest_before(left, right.limit(0), ["k"], "at", "event").where("event is not null").count() == 0


def test_canonical_urls(spark):
    pairs = {
        "HTTP://WWW.Example.com:80/a/?b=2&a=1&utm_source=x#top": "example.com/a?a=1&b=2", "https://example.com/a?a=1&b=2": "example.com/a?a=1&b=2",
        "example.com": "example.com", "https://example.com/": "example.com", "https://example.com:8080/A": "example.com:8080/A", "": "", "https://x.org?utm_medium=1": "x.org",
    }
    frame = spark.createDataFrame([(u,) for u in pairs], "u string")
    assert [r[1] for r in frame.select("u", revisits.canonical(F.col("u"))).collect()] == list(pairs.values())


def test_revisits(spark):
    full = {"ETag": '"1"', "Last-Modified": "mon", "Content-Length": "9", "X-Own": "kept", "Cache-Control": "old"}
    records = [
        (1, "http://a.org/", 10, "response", full), (2, "http://a.org", 20, "response", {**full, "ETag": '"2"'}), (3, "https://www.a.org/#x", 30, "revisit", {"etag": 'W/"2"', "Content-Length": "0", "Cache-Control": "new"}),
        (4, "http://a.org", 15, "revisit", {"ETAG": '"1"'}), (5, "http://a.org", 25, "revisit", {"ETag": '"1"'}), (6, "http://a.org", 10, "revisit", {"ETag": '"1"'}), (7, "http://a.org", 40, "revisit", {"Last-Modified": "mon"}),
        (8, "http://a.org", 40, "revisit", {"Date": "d"}), (9, "http://a.org", 40, "revisit", None), (10, None, 40, "revisit", {"ETag": '"1"'}), (11, "http://a.org", None, "revisit", {"ETag": '"1"'}),
        (12, "http://b.org", 5, "response", None), (13, "http://b.org", 6, "revisit", {"ETag": '"1"'}), (14, "http://a.org", 20, "response", {**full, "ETag": '"3"', "etag": '"2"'}), (3, "https://www.a.org/#x", 30, "revisit", {"etag": '"2"'}),
    ]
    frame = spark.createDataFrame(records, "record_id bigint, url string, time bigint, kind string, headers map<string,string>").withColumn("response", F.lit("clash"))
    got = revisits.resolve_revisits(frame).collect()
    by = {r.record_id: r for r in got}
    assert len(got) == 11
    assert {k: (r.outcome, r.response_id) for k, r in by.items()} == {
        3: ("resolved", 14), 4: ("resolved", 1), 5: ("mismatch", None), 6: ("missing", None), 7: ("resolved", 14), 8: ("no_validator", None), 9: ("no_validator", None),
        10: ("missing", None), 11: ("missing", None), 13: ("no_validator", None),
    }
    merged = next(r.headers for r in got if r.record_id == 3 and "new" in r.headers.values())
    assert merged == {"etag": 'W/"2"', "last-modified": "mon", "content-length": "9", "x-own": "kept", "cache-control": "new"}
    assert revisits.resolve_revisits(frame.limit(0)).count() == 0


def test_queries_agree_with_their_sql(spark):
    for d in (SF, "/root/testdata/sf0.01"):
        con = oracle_connection(d)
        for name, sql in SQL.items():
            assert compare_tables(queries.QUERIES[name](spark, d).toArrow(), con.execute(sql).to_arrow_table()) == [], (d, name)


def test_duplicates_of_a_document_are_rows(spark):
    docs = documents(spark, [(1, "a b c"), (1, "a b c"), (2, None)])
    got = mixing.mix(docs, [Level("source", F.col("source"))], budget=6, max_epochs=1)
    assert [(r.doc_id, r.tokens, r.copies) for r in got.collect()] == [(1, 3, 1), (1, 3, 1), (2, 0, 1)] or got.count() == 3
