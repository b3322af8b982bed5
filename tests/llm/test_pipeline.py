"""The registered queries against DuckDB, and the pipeline's stages."""

import duckdb
import pytest

import corpus_pipeline
from checks.compare import TABLES, normal
from pagelens.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    df = QUERIES[name](spark, FOLDER)
    expected = con.execute(ORACLES[name])
    columns = [c[0] for c in expected.description]
    assert normal(df.collect(), df.columns) == normal(expected.fetchall(), columns)


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE TABLE documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, FOLDER).cache()
        assert docs.columns == before.columns and docs.count() <= before.count()
        if name == "language":
            assert docs.count() == before.filter(r"text rlike '\\p{L}'").count()
        if name == "near_copies":
            con.register("kept", before.toPandas())
            sql = ORACLES["op2_ngram_jaccard_join"].replace("FROM documents)", "FROM kept)")
            assert {r.doc_id for r in docs.collect()} == {r[0] for r in con.execute(f"SELECT doc_id FROM ({sql}) WHERE doc_id = component_id").fetchall()}
        if name == "passages":
            con.register("left_over", before.toPandas())
            sql = ORACLES["op10_passage_dedup"].replace("FROM documents)", "FROM left_over)").replace("FROM d LEFT", "FROM d LEFT")
            expected = {r[0]: r[1] for r in con.execute(f"SELECT doc_id, text FROM ({sql}) WHERE trim(text) <> ''").fetchall()}
            assert {r.doc_id: r.text for r in docs.collect()} == expected
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
    assert {r.doc_id for r in pieces} == {r.doc_id for r in docs.collect()}


def test_stages_odd_rows(spark):
    """NULLs, repeated rows, equal ids with other texts, empty tables: no row is multiplied or lost."""
    a, b = " ".join(f"word{c}" for c in "abcdefghijklmnop"), " ".join(f"term{c}" for c in "abcdefghijklmnop")
    rows = [(1, a, "en", "s", 1), (1, a, "en", "s", 1), (1, b, None, None, None), (2, a + " end", "en", "s", 1), (3, None, "en", "s", 1),
            (4, "", None, "s", 1), (None, "no id for these words here", None, "s", None), (5, "12 34", "en", "s", 1), (6, "unlike every other text there is", "de", "t", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER).cache()
        assert docs.columns == corpus_pipeline.COLUMNS
        found[name] = sorted(((r.doc_id, r.text) for r in docs.collect()), key=str)
    whole = {None: "no id for these words here", 6: "unlike every other text there is"}
    assert found["language"] == sorted([(1, a), (1, a), (1, b), (2, a + " end"), *whole.items()], key=str)
    assert found["near_copies"] == found["passages"] == sorted([(1, a), (1, b), *whole.items()], key=str)
    assert {r.doc_id: r.lang for r in docs.collect()}[6] == "de" and all(r.lang for r in docs.collect())
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
    assert sorted(str(r.doc_id) for r in pieces if r.start == 0) == ["1", "1", "6", "None"]
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), FOLDER).count() == 0


def test_near_copies_with_equal_ids(spark):
    """One row of each group stays, also where rows share an id or have none."""
    words = [f"word{i}" for i in range(60)]
    a, b, c = (" ".join(f"{p}{w}" for w in words) for p in "abc")
    rows = [(1, a), (2, b), (2, a + " end"), (None, c), (None, c + " end"), (None, c + " other"), (None, a + " tail"), (None, None), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    found = [(r.doc_id, r.text) for r in corpus_pipeline.join_near_copies(spark, docs, FOLDER).collect()]
    assert len(found) == 4 and {(1, a), (2, b), (None, None)} <= set(found)
    assert [t[:len(c)] for i, t in found if i is None and t] == [c]  # Any one of the three.


def test_few_repeated_ids_move_no_texts(spark, capsys):
    """Texts are shuffled to meet the sets, but not a second time to meet the ids of several rows when these are few."""
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(30)), "en", "s", 1) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "20k")
    try:
        kept = corpus_pipeline.join_near_copies(spark, docs, FOLDER)
        kept.explain()
        assert kept.count() == 3000
    finally:
        spark.conf.set(name, before)
    semi = [line for line in capsys.readouterr().out.splitlines() if "LeftSemi" in line]
    assert semi and all("BroadcastHashJoin" in line for line in semi)
