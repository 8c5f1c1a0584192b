"""The prefix trie against sequences held in a dictionary."""

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from caudal.llm import queries, trie
from caudal.llm.running import running

SCHEMA = "conv_id bigint, turn int, role string, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def ordered(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            convs[conv].append(((turn is not None, turn or 0, role.encode(), text[:32].encode(), digest), (role, text)))
    return {c: [t for _, t in sorted(v)] for c, v in convs.items()}


def brute(rows):
    own = ordered(rows)
    made = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        made[c] = tuple(own.get(c - int(math.fmod(c, 20)), [])[:h] + turns[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
        ends[turns].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    total = {}
    for node in sorted(members, key=len, reverse=True):
        saved = (len(members[node]) - 1) * len(WORD.findall(node[-1][1])) if node else 0
        below = [total[x] for x in children[node]]
        total[node] = (sum(x for x, _ in below) or 1, saved + sum(y for _, y in below))
    out = []
    for node, convs in members.items():
        digest = hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest()
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children[node]), total[node][0], total[node][1], digest))
    return sorted(out, key=repr)


def found(spark, rows, tmp_path, parts=5):
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({"pos": F.lit("x"), "conv": F.lit(1), "digest": F.lit(None).cast("int")})
    frame.repartition(parts).write.parquet(f"{tmp_path}/conversations.parquet")
    df = queries.op12_prefix_trie(spark, str(tmp_path))
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_given_tables(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted((tuple(r) for r in queries.op12_prefix_trie(spark, "/root/testdata/sf0.01").collect()), key=repr) == brute(rows)


def test_shared_beginnings_ties_and_nulls(spark, tmp_path):
    rng = random.Random(4)
    rows = []
    for c in range(90):
        for t in range(rng.choice([1, 2, 3, 7, 8, 9, 17, 30])):
            rows.append((c, t, rng.choice(["user", None]) if t % 5 == 4 else "user", f"turn {t}" if rng.random() < 0.9 else rng.choice([None, "", "other words here"])))
    rows += [(None, 1, "user", "nobody's"), (-3, None, "a", "first"), (-3, 0, "b", "x" * 40 + "1"), (-3, 0, "b", "x" * 40 + "2"), (500, 1, "u", "same"), (500, 1, "u", "same"), (500, None, None, None)]
    rows += [(1000, 0, "user", "long text " * 20_000), (1001, 0, "user", "long text " * 20_000), (7001, 3, "user", "alone")]
    assert found(spark, rows, tmp_path) == brute(rows)


def test_one_conversation_holds_most_turns_and_chains_hang_deep(spark, tmp_path):
    rows = [(20_000, t, "user", f"turn {t % 7}") for t in range(4000)] + [(40_000, 0, "user", "again")] * 1500
    rows += [(c, t, "u", "go on" if t < c - 60_000 else f"end {c}") for c in range(60_000, 60_060) for t in range(c - 59_999)]
    rows += [(80_000 + c, 0, "u", "the same") for c in range(700)]
    assert found(spark, rows, tmp_path, 9) == brute(rows)


def test_empty_table(spark, tmp_path):
    assert found(spark, [], tmp_path) == [] == found(spark, [(None, 0, "u", "t")], tmp_path / "null")


def test_other_blocks_give_the_same_nodes(spark):
    rng = random.Random(6)
    rows = [(c, t, "u", str(t if t < 5 else rng.randrange(2))) for c in range(40) for t in range(12)]
    turns = trie.ordered_turns(spark.createDataFrame(rows, SCHEMA))
    names = ["conv", "depth", "parent", "n_convs", "n_children", "n_leaves", "saved_words"]
    got = [sorted(map(tuple, trie.build(turns, turns.select("conv").distinct(), b).nodes.select(names).collect()), key=repr) for b in (1, 3, 8, 50)]
    assert got[0] == got[1] == got[2] == got[3] and len(got[0]) > 40


@pytest.mark.parametrize("partitions", ["1", "16"])
def test_running_sums_over_tasks(spark, partitions):
    rng = random.Random(7)
    rows = [(rng.choice([1, 1, 1, 2, 3, 50 + i]), i, rng.randrange(100), rng.getrandbits(63)) for i in range(3000)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = running(spark.createDataFrame(rows, "k bigint, i bigint, v bigint, x bigint"), "k", ["i"], ["v"], ["x"]).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    v, x = defaultdict(int), defaultdict(int)
    want = {}
    for k, i, a, b in rows:
        v[k] += a
        x[k] ^= b
        want[i] = (v[k], x[k])
    assert {r.i: (r.v_upto, r.x_upto) for r in got} == want
