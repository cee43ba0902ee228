"""Texts in a script that no learned language writes have score 0; mixed ones the learned part's share."""

from pyspark.sql import functions as F

import corpus_pipeline
from distillery.llm.language_id import identify, train


def test_unknown_scripts_are_not_labelled_with_certainty(spark):
    learn = [(i, "the of and that with this from have", "en") for i in range(30)]
    learn += [(100 + i, "der die und das mit dieser von haben", "de") for i in range(30)]
    schema = "doc_id long, text string, lang string"
    model = train(spark.createDataFrame(learn, schema), F.lit(True))
    rows = [(1, "αυτό είναι ένα ελληνικό κείμενο", None), (2, "ภาษาไทย", None), (3, "the and with", None),
            (4, "thatthat κείμενοκ", None), (5, "that κείμενο κείμενο", None)]
    got = {r.doc_id: r for r in identify(spark.createDataFrame(rows, schema), model, keep=["doc_id"]).collect()}
    assert got[1].score == got[2].score == 0.0 and got[1].spans == got[2].spans == []
    assert (got[3].lang_pred, got[3].score) == ("en", 1.0)
    assert (got[4].lang_pred, got[4].score) == ("en", 0.5) and got[5].score == 4 / 18
    kept = corpus_pipeline.language_stage(spark, spark.createDataFrame(learn + rows, schema), "")
    assert {r.doc_id for r in kept.filter("doc_id < 10 and lang is null").collect()} == {3, 4}
