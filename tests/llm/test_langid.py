from pyspark.sql import functions as F

from tests.llm.conftest import prose
from wardflow.llm import langid

LATIN, RHEIN = "the of ing and re er on st th an", "der ung sch ei ch lich und en keit pf"


def corpus(spark):
    rows = [(i, prose(i, 80, LATIN if i % 2 else RHEIN), "en" if i % 2 else "de") for i in range(200)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_held_out_accuracy(spark):
    docs = corpus(spark)
    contents = langid.train(docs, F.col("doc_id") < 100)
    got = langid.identify(docs, contents).join(docs, "doc_id").where("doc_id >= 100").collect()
    assert sum(r.lang_pred == r.lang for r in got) >= 99 and all(0 <= r.score <= 1 for r in got)


def test_mixed_text_is_rejected_and_clean_text_kept(spark):
    contents = langid.train(corpus(spark), F.lit(True))
    mixed = " ".join(w for i in range(60) for w in (prose(i, 1, LATIN), prose(i, 1, RHEIN)))
    docs = spark.createDataFrame([(1, mixed), (2, prose(900, 50, LATIN)), (3, "12 34"), (4, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in langid.identify(docs, contents, margin=0.1).collect()}
    assert got[1].rejected and not got[2].rejected and got[3].lang_pred == got[4].lang_pred == "und"
    assert [r.doc_id for r in langid.keep_identified(docs, contents, margin=0.1).collect()] == [2]


def test_odd_rows(spark, clashing_docs, no_docs):
    contents = langid.train(clashing_docs, F.lit(True))
    assert sorted(contents) == ["de", "en", "fr"]
    got = langid.identify(clashing_docs, contents)
    assert got.count() == clashing_docs.count()
    assert {r.doc_id for r in got.where("lang_pred = 'und'").collect()} == {1, 2, 3, 10}
    assert langid.keep_identified(clashing_docs, contents).columns == clashing_docs.columns
    none = langid.train(no_docs, F.lit(True))
    assert none == {} and {r.lang_pred for r in langid.identify(clashing_docs, none).collect()} == {"und"}
    assert langid.identify(no_docs, contents).count() == 0
    assert {r.lang_pred for r in langid.identify(clashing_docs, {"en": contents["en"]}).collect()} == {"en", "und"}
