"""Line dedup, decontamination and the URL filter against brute force."""

import collections
import hashlib
import random
from urllib.parse import urlsplit

import regex
from pyspark.sql import functions as F

from caudal.llm import decontaminate, linedup, queries, urlfilter
from tests.llm.conftest import documents

SF = "/root/testdata/sf0.001"


def test_every_repeated_run_goes_and_nothing_else(spark):
    rng = random.Random(1)
    vocabulary = ["alpha beta", "gamma", "delta epsilon zeta eta theta iota kappa lambda mu", "nu xi", "", "  ", "omicron pi rho sigma tau upsilon phi chi psi omega"]
    rows = []
    for i in range(60):
        own = [f"line {i} {k} with words that stand in no other document at all" for k in range(6)]
        shared = [rng.choice(vocabulary) for _ in range(4)]
        rows.append((i, "\n".join([*own[:3], *shared, *own[3:]])))
    rows += [(60, rows[3][1]), (61, None), (62, ""), (None, "a b c d e f g h"), (63, "A  b c d e f g h"), (63, "other"), (64, "x\n" * 30), (3, rows[3][1])]
    docs = documents(spark, rows).withColumn("pos", F.lit(1)).withColumn("h", F.lit(2))
    got = linedup.drop_repeated_lines(docs)
    found = got.collect()
    assert len(found) == len(rows) and got.columns == [*docs.columns, "n_lines", "removed_lines"]
    seen = {}
    long_gone = set()
    for doc, text in sorted({(d if d is not None else -1, t) for d, t in rows if t is not None}):
        for p, line in enumerate(text.split("\n")):
            k = b" ".join(line.encode().lower().split())
            if len(k.split()) >= linedup.RUN_WORDS and k in seen:
                long_gone.add((doc, text, p))
            seen.setdefault(k, (doc, p))
    texts = {(d if d is not None else -1, len(t.split("\n")), t.split("\n")[0]): t for d, t in rows if t is not None}
    removed = {}
    for r in found:
        if r.n_lines is not None:
            doc = r.doc_id if r.doc_id is not None else -1
            removed.setdefault(doc, []).append(tuple(r.removed_lines))
            for text in [t for (d, n, _), t in texts.items() if d == doc and n == r.n_lines]:
                if r.text == "\n".join(x for p, x in enumerate(text.split("\n")) if p not in r.removed_lines):
                    break
            else:
                raise AssertionError(r)
    for doc, _, p in long_gone:
        assert any(p in lines for lines in removed[doc]), (doc, p)
    for i in range(60):  # a document's own lines stay
        assert all(set(lines) <= {3, 4, 5, 6} for lines in removed[i])
    assert removed[60] == [tuple(p for p, x in enumerate(rows[3][1].split("\n")) if x.strip())] and removed[62] == [()]
    assert linedup.drop_repeated_lines(docs.limit(0)).count() == 0


def test_runs_of_short_lines(spark):
    run = ["one two", "three", "four five six", "seven", "eight nine ten"]
    rows = [(1, "\n".join(["start of one", *run, "end of one"])), (2, "\n".join(["beginning two", "", *run[:3], "", *run[3:], "the end"])), (3, "one two\nseven\nthree"), (4, "\n".join(run[:2]))]
    got = {r.doc_id: r.removed_lines for r in linedup.drop_repeated_lines(documents(spark, rows)).collect()}
    assert got == {1: [], 2: [2, 3, 4, 6, 7], 3: [], 4: []}


def removed_by_definition(rows, least=8):
    """For each document the lines of runs that stand earlier: all runs, of whatever length, by all earlier ones."""
    docs = []
    for doc, text in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5(r[1].encode()).digest())):
        docs.append((doc, text, [(p, tuple(x.lower().split())) for p, x in enumerate(text.split("\n")) if x.split()]))
    out, seen = {}, set()
    for doc, text, lines in docs:
        gone, fresh = set(), []
        for i in range(len(lines)):
            for j in range(i + 1, len(lines) + 1):
                run = tuple(x for _, x in lines[i:j])
                if sum(map(len, run)) >= least:
                    if run in seen:
                        gone.update(p for p, _ in lines[i:j])
                    fresh.append(run)
                    seen.add(run)  # later starts of this document find it, too
        out[doc, text] = sorted(gone)
    return out


def test_runs_are_those_of_the_definition(spark):
    rng = random.Random(8)
    vocabulary = ["a b", "c", "d e f", "g h i j k l m n", "o p q r s t u v w x", "", "y", "see also"]
    rows = [(1, "p q r\nsee also\ns t u"), (2, "one two three\nsee also\nseven eight nine"), (3, "one two three\nsee also\nseven eight nine")]
    rows += [(4, "w w w w w w w w\ny"), (5, "w w w w w w w w\nx"), (6, "w w w w w w w w\nx"), (7, "x\n" * 12), (None, "c\na b\n" * 6)]
    rows += [(10 + i, "\n".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 14)))) for i in range(60)]
    docs = documents(spark, rows).withColumns({n: F.lit("x") for n in ("row", "doc", "kind", "gone", "lines", "h", "__doc", "__lines")})
    got = {(r.doc_id, r.removed_lines and tuple(r.removed_lines) or ()): r for r in linedup.drop_repeated_lines(docs).collect()}
    want = removed_by_definition(rows)
    assert set(got) == {(doc, tuple(lines)) for (doc, _), lines in want.items()}
    assert want[3, rows[2][1]] == [0, 1, 2] and want[6, rows[5][1]] == [0, 1] and want[5, rows[4][1]] == [0]
    assert all(r["row"] == r["doc"] == r["gone"] == r["lines"] == "x" for r in got.values())


def words(text):
    return regex.findall(r"[\p{L}\p{M}\p{N}]+", (text or "").lower())


def shingles(text):
    w = words(text)
    return [tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))] if w else []


def brute_matches(docs, items, similarity=0.8):
    found = {}
    for item, item_text in items:
        want = collections.Counter(shingles(item_text))
        size = sum(want.values())
        for doc, text in docs if size else []:
            every = shingles(text)
            for p in range(len(every)):
                if every[p] not in want:
                    continue
                window = collections.Counter(every[p : p + size])
                both = sum((window & want).values())
                alike = both / (sum(window.values()) + size - both)
                if alike >= similarity:
                    found[doc, item] = max(alike, found.get((doc, item), 0))
    return found


def test_matches_are_those_of_all_windows(spark):
    rng = random.Random(2)
    text = lambda n: " ".join(rng.choice(["ab", "cd", "ef", "gh"]) + str(rng.randrange(40)) for _ in range(n))
    items = [(i, text(rng.choice([3, 8, 30, 60, 90]))) for i in range(25)] + [(90, None), (91, "..."), (None, text(40))]
    items += [(92, items[2][1])]
    docs = [(i, text(150)) for i in range(40)]
    for i, (item, t) in enumerate(items):
        if t:
            w = t.split()
            docs.append((100 + i, f"{text(20)} {t.upper()}! {text(30)}"))
            w[len(w) // 2] = "changed"
            docs.append((200 + i, f"{text(10)} {' '.join(w)}, {text(10)}"))
            docs.append((300 + i, " ".join(t.split()[1:-1])))
            docs.append((400 + i, " ".join(w[: len(w) // 2])))
    docs += [(500, None), (501, ""), (502, "?"), (503, items[3][1]), (503, items[3][1]), (504, f"{items[3][1]} {text(2000)} {items[3][1]} {items[4][1]}")]
    frame = documents(spark, docs).withColumn("hashes", F.lit("clash")).withColumn("size", F.lit(1))
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = decontaminate.contaminated(frame, bench).collect()
    want = brute_matches(docs, items)
    assert {(r.doc_id, r.item_id): round(r.similarity, 9) for r in got} == {k: round(v, 9) for k, v in want.items()}
    assert len(got) == len(want) > 40
    kept = decontaminate.drop_contaminated(frame, bench)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, _ in docs if d not in {k for k, _ in want})


def test_empty_tables_and_null_ids(spark):
    docs = documents(spark, [(None, "one two three four five six seven"), (1, "clean text of its own that has no match")])
    bench = spark.createDataFrame([(7, "One two three four five six, seven.")], "item_id bigint, text string")
    assert [(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench).collect()] == [(None, 7)]
    assert [r.doc_id for r in decontaminate.drop_contaminated(docs, bench).collect()] == [1]
    assert decontaminate.contaminated(docs.limit(0), bench).count() == 0
    assert decontaminate.drop_contaminated(docs, bench.limit(0)).count() == 2


def test_only_the_texts_that_match_go(spark):
    leak, clean = "one two three four five six seven", "clean text of its own that has no match"
    rows = [(None, leak), (None, clean), (None, None), (1, leak), (1, clean), (1, leak), (2, clean)]
    bench = spark.createDataFrame([(7, leak)], "item_id bigint, text string")
    kept = decontaminate.drop_contaminated(documents(spark, rows), bench).collect()
    assert sorted([(r.doc_id, r.text) for r in kept], key=repr) == sorted([r for r in rows if r[1] != leak], key=repr)


def test_index_lists_all_prints_within_the_radius(spark):
    rng = random.Random(3)
    radius = decontaminate.radius_for(0.8)
    prints = [rng.getrandbits(64) for _ in range(20)]
    asked = []
    for i, p in enumerate(prints):
        for bits in (0, 3, radius - 1, radius):
            for b in rng.sample(range(64), bits):
                p ^= 1 << b
            asked.append((i, p if p < 2**63 else p - 2**64))
            p = prints[i]
    items = spark.createDataFrame([(i, 5, p if p < 2**63 else p - 2**64) for i, p in enumerate(prints)], "item bigint, size int, print bigint")
    rows = spark.createDataFrame(asked, "item bigint, q bigint")
    keys = rows.select("item", "q", F.posexplode(F.array(*[decontaminate._block(F.col("q"), k) for k in range(8)])).alias("block", "value"))
    assert keys.join(decontaminate.item_index(items, radius), ["item", "block", "value"]).select("item", "q").distinct().count() == rows.distinct().count()


def test_simhash_is_the_majority(spark):
    rng = random.Random(4)
    rows = [([rng.getrandbits(63) - 2**62 for _ in range(n)],) for n in (1, 2, 5, 40)]
    got = [r[0] % 2**64 for r in spark.createDataFrame(rows, "h array<bigint>").select(decontaminate.simhash(F.col("h"))).collect()]
    assert got == [sum(1 << b for b in range(64) if 2 * sum((x >> b) & 1 for x in h) > len(h)) for (h,) in rows]


def test_url_parts_and_rules(spark):
    urls = ["https://A.Example.NET/en/1?x#y", "http://example.net", "http://example.net/en", "ftp://x.org/fr/a?b/", "no scheme", None, "", "a://b://c/d", "http://Ünï.COM/de/", "http://example.com/de/7#z", "https://notexample.com/de/1", "http://?q", "//x.net/"]
    pages = spark.createDataFrame(list(enumerate(urls)) + [(None, urls[0])], "page_id bigint, url string").withColumn("host", F.lit("clash"))
    model = urlfilter.train(urlfilter.labelled_urls(spark))
    got = urlfilter.judge(pages, queries.RULES, model).collect()
    assert len(got) == len(urls) + 1
    for r in got:
        url = urls[r.page_id or 0] or ""
        rest = url.split("://", 1)[1] if "://" in url else ""
        host = regex.match(r"[^/?#]*", rest).group().translate({c: c + 32 for c in range(65, 91)})
        path = regex.match(r"[^/?#]*([^?#]*)", rest).group(1)
        fits = [x for x in queries.RULES if (host == x.host or host.endswith("." + x.host)) and path.startswith(x.path)]
        best = max(fits, key=lambda x: len(x.host + x.path), default=None)
        assert (r.host, r.path, r.rule) == (host, path, best and best.host + best.path)
        assert r.verdict == best.verdict if best else r.verdict in ("allow", "block")
    assert urlfilter.judge(pages.limit(0), queries.RULES, model).count() == 0
    assert {r.rule for r in urlfilter.judge(pages, [], model).collect()} == {None}


def test_url_model_tells_unseen_hosts_apart(spark):
    urls = ["https://m.casino-games.org/en/3", "http://cheap-pills-shop.com/", "http://spam-farm7.com/en/1", "https://bets-free.org/x", "https://forest.org/en/3", "http://city-library.com/de/5", "https://m.village.com/es/9", "https://blog.rivers.org/fr/2"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    got = urlfilter.judge(pages, [], urlfilter.train(urlfilter.labelled_urls(spark))).orderBy("page_id").collect()
    assert [r.verdict for r in got] == ["block"] * 4 + ["allow"] * 4
    assert urlsplit(urls[0]).hostname == got[0].host


def test_queries_on_small_tables(spark):
    pages = queries.op7_url_filter(spark, SF).collect()
    assert len(pages) == 50 and {r.verdict for r in pages} <= {"allow", "block"}


def test_bitmap_loses_no_wanted_text(spark):
    rng = random.Random(3)
    wanted = [rng.getrandbits(64) - 2**63 for _ in range(3000)] + [-1, 0, 2**63 - 1, -(2**63)]
    others = [rng.getrandbits(64) - 2**63 for _ in range(20_000)]
    texts = spark.createDataFrame([(k,) for k in wanted + others] + [(None,)], "kind bigint")
    asked = spark.createDataFrame([(k,) for k in wanted + wanted], "kind bigint")
    for bits, most in ((2**27, 3004 + 800), (2**15, 3004 + 2500)):
        found = [r.kind for r in decontaminate._maybe_wanted(texts, asked, bits).collect()]
        assert set(wanted) <= set(found) and len(found) <= most
    assert decontaminate._maybe_wanted(texts, asked.limit(0)).collect() == []
