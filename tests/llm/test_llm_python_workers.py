"""Steps of the pipeline whose tasks must not need two Python workers at a time."""

from test_plans import plan_text

import corpus_pipeline
from panelspark.llm.ngram_join import _among


def test_wanted_texts_are_picked_without_python(spark):
    docs = spark.createDataFrame([(i, str(i)) for i in [-5, *range(200), None, 7]], "id long, body string")
    wanted = spark.createDataFrame([(-5,), (7,), (64,), (9999,)], "id long")
    found = _among(docs, wanted)
    assert "Python" not in plan_text(found)
    assert sorted((r.id, r.body) for r in found.collect()) == [(-5, "-5"), (7, "7"), (7, "7"), (64, "64")]


def test_ids_are_decoded_in_a_step_of_its_own(spark):
    docs = spark.createDataFrame([(1, "en", "a", "some text"), (2, None, None, None)],
                                 "doc_id long, lang string, source string, text string")
    found = corpus_pipeline.bpe_stage(spark, docs, "")
    assert plan_text(found).count("MapInArrow") == 1
    assert [r.round_trip for r in found.orderBy("doc_id").collect()] == [True, True]
