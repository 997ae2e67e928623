"""The registered queries: against DuckDB where there is SQL, and the pipeline stage by stage."""

import os
import re

import duckdb
import pytest
import public_tokenizers
from test_simhash import groups
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from govlake.llm import quality, registry, simhash

SF = "/root/testdata/sf0.001"
TABLES = "documents pages benchmark labels conversations embeddings".split()


@pytest.fixture(scope="module")
def con():
    made = duckdb.connect()
    for t in TABLES:
        made.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return made


def test_entry_has_one_query_for_each_operator():
    names = contract.queries()
    assert set(registry.QUERIES) <= set(names) and "pipeline" in names
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13
    assert set(registry.ORACLE) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_matches_duckdb(spark, con, name):
    df, rel = registry.QUERIES[name](spark, SF), con.sql(registry.ORACLE[name])
    assert sorted(df.columns) == sorted(rel.columns)
    columns = sorted(df.columns)
    want = con.sql(f"SELECT {', '.join(columns)} FROM ({registry.ORACLE[name]})").fetchall()
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in df.select(*columns).collect())


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE) - {"pipeline"}))
def test_one_row_per_document_at_least(spark, con, name):
    got = registry.QUERIES[name](spark, SF)
    ids = {r.doc_id for r in got.select("doc_id").collect()}
    every = {r[0] for r in con.sql("SELECT doc_id FROM documents").fetchall()}
    assert ids <= every if name == "op4_decontamination" else ids == every


def written(spark, tmp_path, df, name):
    df.write.parquet(str(tmp_path / name))
    return spark.read.parquet(str(tmp_path / name))


def words_of(text):
    return re.findall(r"\w+", text.lower())


def test_pipeline_stage_by_stage(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    (_, judged), (_, deduplicated), (_, decontaminated), (_, packed) = corpus_pipeline.STAGES
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good = {r.doc_id for r in quality.predictions(docs, labels).where("predicted = 1").collect()}
    first = written(spark, tmp_path, judged(spark, docs, SF), "1")
    assert first.columns == docs.columns and {r.doc_id for r in first.collect()} == good

    rows = sorted((r.doc_id, r.text) for r in first.collect())
    prints = [simhash.fingerprint_of(t) for _, t in rows]
    group = groups(prints, lambda a, b: (a ^ b).bit_count() <= 4)
    least = {}
    for (d, _), g in zip(rows, group, strict=True):
        least[g] = min(d, least.get(g, d))
    second = written(spark, tmp_path, deduplicated(spark, first, SF), "2")
    assert second.columns == docs.columns
    assert sorted(r.doc_id for r in second.collect()) == sorted(least.values())

    items = [words_of(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    third = written(spark, tmp_path, decontaminated(spark, second, SF), "3")
    kept = {r.doc_id for r in third.collect()}
    for r in second.collect():
        padded = f" {' '.join(words_of(r.text))} "
        assert (r.doc_id not in kept) == any(f" {' '.join(i)} " in padded for i in items)

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    sizes = {r.doc_id: len(library.encode(r.text, add_special_tokens=False).ids) + 1 for r in third.collect()}
    found = {}
    for r in packed(spark, third, SF).collect():
        assert r.doc_tokens == sizes[r.doc_id]
        found[r.doc_id] = found.get(r.doc_id, 0) + r.length
    assert found == sizes
    assert sum(r.length for r in corpus_pipeline.run(spark, SF).collect()) == sum(sizes.values())


def test_pipeline_keeps_extra_columns_and_odd_rows(spark, docs_of, prose):
    docs = docs_of([*enumerate(prose), (None, None), (None, "no id")], extra=True)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SF)
        assert kept.columns == docs.columns
        assert stage(spark, docs.limit(0), SF).collect() == []
        docs = kept
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() >= docs.count() > 0


def test_no_table_is_opened_outside_spark():
    """Inputs can be where only Spark reads: no operator opens files of the tables itself."""
    folder = os.path.dirname(registry.__file__)
    for name in os.listdir(folder):
        if name.endswith(".py"):
            text = open(os.path.join(folder, name)).read()
            assert not re.search(r"pq\.read|read_parquet|open\(|localCheckpoint|\.rdd\b|crossJoin", text), name
