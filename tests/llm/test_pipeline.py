"""Each stage of the pipeline, on what the one before it kept, against brute force; and the registration."""

import pyarrow as pa
import pytest

import __spark_entry__
import corpus_pipeline as pipeline
from caudal.llm import mixing, sql
from tests.llm.conftest import documents
from tests.llm.test_text_filters import brute_matches
from workload.check import compare_tables, oracle_connection

SF = "/root/testdata/sf0.001"
COLUMNS = list(pipeline.COLUMNS)


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows that go in, and then those after each stage."""
    base = tmp_path_factory.mktemp("stages")
    out = [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, stage in pipeline.STAGES:
        stage(spark, out[-1], SF).write.parquet(f"{base}/{name}")
        out.append(spark.read.parquet(f"{base}/{name}"))
    return out


def test_stages_keep_the_columns_of_documents(stages):
    assert [name for name, _ in pipeline.STAGES] == ["language", "lines", "copies", "benchmark", "mixture"]
    assert all(df.columns == COLUMNS for df in stages[:-1]) and stages[-1].columns == [*COLUMNS, "tokens", "copies"]


def test_language_rejects_only_what_has_no_language(stages):
    before, after = (sorted(map(tuple, df.collect())) for df in stages[:2])
    gone = set(before) - set(after)
    assert all(not any(c.isalpha() for c in r[1] or "") or len(r[1]) < 200 for r in gone) and len(gone) < 0.02 * len(before)
    assert set(after) <= set(before)


def test_short_texts_with_letters_stay(spark):
    short = ["A.", "Onhaha sh.", "A.\nAll rights reserved.", "Lllldoado.", "Avec."]
    base = spark.read.parquet(f"{SF}/documents.parquet").select(*COLUMNS)
    docs = base.unionByName(documents(spark, [(10**6 + i, t) for i, t in enumerate([*short, "42 + 43", "", "Þð Ж ქ漢 " * 100])]))
    kept = {r.doc_id for r in pipeline.language(spark, docs, SF).filter(f"doc_id >= {10**6}").collect()}
    assert kept == {10**6 + i for i in range(len(short))}


def test_lines_are_those_of_the_sql(stages):
    con = oracle_connection(SF)
    con.register("kept", stages[1].toArrow())
    con.execute("CREATE OR REPLACE VIEW documents AS SELECT * FROM kept")
    want = {r[0]: r[1] for r in con.execute(f"SELECT doc_id, text FROM ({sql.line_dedup()}) WHERE removed_lines = '' OR trim(text, chr(10) || ' ' || chr(9)) <> ''").fetchall()}
    got = stages[2].collect()
    assert {r.doc_id: r.text for r in got} == want
    assert all(r.n_chars == len(r.text) for r in got if r.text)


def test_one_document_of_each_group_stays(stages):
    def shingles(text):
        w = (text or "").encode().lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    alike = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    before = [(r.doc_id, shingles(r.text)) for r in stages[2].orderBy("doc_id").collect()]
    kept = {r.doc_id for r in stages[3].collect()}
    for i, (doc, s) in enumerate(before):
        near = max((alike(s, t) for _, t in before[:i]), default=0)
        if near < 0.6:  # a clean document
            assert doc in kept
        if near > 0.95:
            assert doc not in kept


def test_benchmark_passages_go(spark, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    docs = [(r.doc_id, r.text) for r in stages[3].collect()]
    leaks = {doc for doc, _ in brute_matches(docs, items)}
    assert {r.doc_id for r in stages[4].collect()} == {d for d, _ in docs} - leaks and leaks


def test_mixture_is_that_of_the_sql(stages):
    con = oracle_connection(SF)
    con.register("kept", stages[4].toArrow())
    con.execute("CREATE OR REPLACE VIEW documents AS SELECT * FROM kept")
    got = stages[5].select("doc_id", "lang", "source", "tokens", "copies").toArrow()
    assert compare_tables(got, con.execute(sql.mixture()).to_arrow_table()) == [] and isinstance(got, pa.Table)


def test_odd_documents_go_through_all_stages(spark):
    rows = [(1, None), (2, ""), (3, "word"), (None, "the and of to in a house by the sea with nine words more"), (None, None), (3, "word"), (4, "x" * 200_000), (5, "42 43\n44")]
    docs = documents(spark, rows)
    for some in (docs, docs.limit(0)):
        for _, stage in pipeline.STAGES:
            some = stage(spark, some, SF)
        assert some.columns[-1] == "copies" and some.count() <= len(rows)


def test_run_is_the_stages(spark, stages):
    assert sorted(map(str, pipeline.run(spark, SF).collect())) == sorted(map(str, stages[-1].collect()))
    assert pipeline.ORACLE_SQL is None and mixing.SLICE_DIGITS == 3


def test_all_queries_are_registered():
    names = __spark_entry__.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13 and "pipeline" in names
    assert set(__spark_entry__.oracle_sql()) <= set(names)
