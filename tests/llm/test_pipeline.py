"""The pipeline against a plain version of its stages, and the registered queries."""

from collections import Counter

import corpus_pipeline
import pytest
from compare import connect, difference, spark_rows, sql_rows
from helpers import ODD, documents, read
from test_decontamination import brute_force
from test_near_copies import plain_representatives
from test_sharding_and_mixing import check_shards, targets, words

import __spark_entry__
from tidemark.llm import quality
from tidemark.llm import queries as registered

SF = "/root/testdata/sf0.001"


def test_stages(spark, monkeypatch):
    import duckdb

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    table = {r.doc_id: r for r in docs.collect()}
    model = quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    good = [i for i, r in table.items() if model.score(quality.features(r.text)[None])[0] >= quality.CUT]
    ids = sorted(good)
    alone = plain_representatives([(i, table[i].text) for i in ids])
    items = duckdb.connect().sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    clean = [i for i in alone if not brute_force(table[i].text, items)[4]]
    steps = {"quality": ids, "near_duplicates": alone, "decontamination": clean}
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, SF)
        assert docs.columns == columns
        rows = docs.collect()
        assert sorted(r.doc_id for r in rows) == steps[name], name
        assert all(r == table[r.doc_id] for r in rows)
        docs = spark.createDataFrame(rows, docs.schema)
    mixed = corpus_pipeline.mix_sources(spark, docs, SF)
    rows = mixed.collect()
    assert mixed.columns == columns and all(r == table[r.doc_id] for r in rows)
    sizes, drawn = Counter(), Counter()
    for i in clean:
        sizes[table[i].source] += words(table[i].text)
    for r in rows:
        drawn[r.source] += words(r.text)
    longest = Counter()
    for i in clean:
        longest[table[i].source] = max(longest[table[i].source], words(table[i].text))
    for s, want in targets(sizes, (5, 2, 1), 3.0).items():
        assert abs(drawn[s] - want) <= longest[s] / 2 + 1
    assert max(Counter(r.doc_id for r in rows).values()) <= 3
    mixed = spark.createDataFrame(rows, mixed.schema)
    check_shards(corpus_pipeline.assign_shards(spark, mixed, SF).collect(), [(r.doc_id, r.text) for r in rows])
    check_shards(corpus_pipeline.run(spark, SF).collect(), [(r.doc_id, r.text) for r in rows])


def test_odd_rows_pass_all_stages(spark):
    docs = documents(spark, ODD, clashing=True)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF)
        assert after.columns == docs.columns
        docs = spark.createDataFrame(after.collect(), docs.schema)
    corpus_pipeline.assign_shards(spark, docs, SF).collect()
    none = documents(spark, [])
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SF).collect() == []


def test_all_queries_are_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names and set(registered.QUERIES) <= set(names)
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13
    assert set(__spark_entry__.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", sorted(registered.ORACLE_SQL))
def test_query_and_its_sql(spark, name):
    result = spark_rows(registered.QUERIES[name](spark, SF))
    assert difference(result, sql_rows(connect(SF), registered.ORACLE_SQL[name])) is None


def test_labels_cover_some_documents():
    assert 0 < len(read("labels")) < len(read("documents"))
