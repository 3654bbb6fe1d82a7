"""The registered queries and the pipeline on the smallest tables."""

import pytest

from __spark_entry__ import oracle_sql, queries
from check import connect, difference
import corpus_pipeline
from wardflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_all_are_registered():
    assert QUERIES.keys() | {"pipeline"} <= queries().keys()
    assert [int(name[2:].split("_")[0]) for name in QUERIES] == list(range(1, 14))
    assert {n for n in oracle_sql() if n in QUERIES} == {"op9_decontamination", "op11_phrase_collocations", "op13_conversation_repair"}


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, name):
    assert difference(spark, connect(SF), SF, name) is None


def test_stages_equal_the_operators(spark):
    """Each stage's rows follow from its operator's verdicts on its own input."""
    from wardflow.llm import decontaminate, langid, neardup, substring
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF).cache()
        assert out.columns == columns
        seen[name] = (docs, out)
        docs = out
    before, after = seen["language_id"]
    accepted = langid.identify(before, langid.train(before, F.lit(True))).where("not rejected")
    assert ids(after) == ids(accepted) and len(ids(after)) > 0.95 * before.count()
    before, after = seen["near_dedup"]
    assert ids(after) == ids(neardup.link(spark, before).where("kept"))
    before, after = seen["substring_dedup"]
    assert {(r.doc_id, r.text) for r in after.collect()} == {(r.doc_id, r.text) for r in substring.remove_repeats(spark, before).collect()}
    before, after = seen["decontamination"]
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert ids(after) == ids(decontaminate.judge(before, benchmark).where("not contaminated"))
    packed = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in packed.collect()} == set(ids(after))


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_odd_rows_pass_every_stage(spark, clashing_docs, no_docs, tmp_path):
    for docs in (clashing_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
            if name != "best_fit_packing":
                docs.write.parquet(path := str(tmp_path / f"{name}-{docs.sparkSession.catalog.currentDatabase()}-{id(docs)}"))
                docs = spark.read.parquet(path)
        docs.count()
