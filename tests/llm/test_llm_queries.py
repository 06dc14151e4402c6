"""Every query over the smallest tables: against its SQL, or against what its operator's tests hold for all rows."""

import functools

import duckdb
import pytest

import corpus_pipeline
import __spark_entry__ as entry
from tableload.llm.exact import exact_duplicates
from tableload.llm.jaccard import near_duplicates
from tableload.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "pages", "benchmark", "labels", "conversations")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


def rows(frame):
    columns = sorted(frame.columns)
    frame = frame[columns].astype(object).where(frame[columns].notna(), None)
    return sorted(map(str, frame.itertuples(index=False, name=None)))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, duck, name):
    assert rows(QUERIES[name](spark, SF).toPandas()) == rows(duck.sql(ORACLE[name]).df())


def test_one_query_per_operator_and_the_pipeline():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(entry.queries())


def test_queries_give_one_row_per_document(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet").count()
    for name in ("op12_personal_data", "op1_sentencepiece", "op5_language_id", "op9_toxicity", "op10_token_counts"):
        assert QUERIES[name](spark, SF).count() == documents


NAMES = [name for name, _ in corpus_pipeline.STAGES]


@pytest.fixture(scope="module")
def after(spark):
    """What a stage returns for what its predecessors kept, made once, when a test first asks for it."""

    @functools.cache
    def run(number):
        if number < 0:
            return spark.read.parquet(f"{SF}/documents.parquet")
        name, stage = corpus_pipeline.STAGES[number]
        return corpus_pipeline.stored(stage(spark, run(number - 1), SF), name)

    return run


@pytest.mark.parametrize("number", range(len(NAMES) - 1), ids=NAMES[:-1])
def test_stage_of_the_pipeline(after, number):
    before, kept = after(number - 1), after(number)
    assert kept.columns == before.columns
    assert kept.join(before, before.columns, "left_anti").count() == 0 and 0 < kept.count() <= before.count()
    if NAMES[number] == "exact_dedup":
        assert exact_duplicates(kept).filter("group_size > 1").isEmpty()
    if NAMES[number] == "near_dedup":
        assert near_duplicates(kept).filter("component_id <> doc_id").isEmpty()


def test_packing_of_the_pipeline(spark, after):
    kept, packed = after(len(NAMES) - 2), after(len(NAMES) - 1).toPandas()
    assert set(packed.doc_id) == {r.doc_id for r in kept.select("doc_id").collect()}
    columns = ["doc_id", "start", "length", "ids_crc32"]
    assert rows(corpus_pipeline.run(spark, SF).toPandas()[columns]) == rows(packed[columns])


def test_pipeline_of_odd_rows(spark, tmp_path):
    """Null texts and ids, repeated rows and clashing columns: clean documents stay, one of each group."""
    good = {i: " ".join(f"word{i}x{j}" for j in range(60)) + "." for i in range(40)}
    data = [(i, t, "en", "s0", len(t), "a", "b", 1) for i, t in good.items()]
    data += [data[0], (None, good[1], "en", "s0", 1, None, None, None), (None, good[39] + " more", None, None, None, None, None, None)]
    data += [(100, None, "en", "s0", None, None, None, None), (101, "", None, None, None, None, None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string, component_id string, row long"
    folder = str(tmp_path / "odd")
    spark.createDataFrame(data, schema).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    packed = corpus_pipeline.run(spark, folder).toPandas()
    assert sorted(packed.doc_id.dropna()) == list(range(40)) and packed.doc_id.isna().sum() == 0


def test_pipeline_of_no_rows(spark, tmp_path):
    folder = str(tmp_path / "none")
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0
