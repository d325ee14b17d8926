from pyspark.sql import functions as F

from tillwright.llm import langid
from tillwright.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    found = QUERIES["op7_language"](spark, SF)
    labels = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    right = found.filter("held_out").join(labels, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.97
    assert found.count() == labels.count()
    assert found.filter("score < 0 or score > 1").isEmpty()


def test_learns_from_the_rest_only(odd):
    learned = langid.learn(odd)
    held = {r.doc_id for r in odd.filter(langid.held_out(F.col("doc_id"))).collect()}
    assert None in held
    for r in odd.filter("lang is not null and text <> ''").collect():
        if r.doc_id in held:
            assert langid.folded(r.text).encode() not in learned.get(r.lang, b"")


def test_odd_rows(spark, odd, nothing):
    dictionaries = {"en": b"the cat and the dog sat on the mat", "fr": "le chat et le chien sont là".encode()}
    found = {r.doc_id: r for r in langid.identify(odd, dictionaries, ["doc_id", "text"]).collect()}
    assert {k for k, r in found.items() if r.lang_pred == "und"} == {2, 3, 4, 5}
    assert all(found[k].score == 0 for k in (2, 3, 4, 5))
    assert found[1].lang_pred == "en" and found[None].lang_pred == "fr"
    assert langid.identify(nothing, dictionaries, ["doc_id", "text"]).count() == 0
    assert langid.learn(nothing) == {}
    assert {r.lang_pred for r in langid.identify(odd, {}, ["text"]).collect()} == {"und"}


def test_ties_and_narrow_margins(spark):
    same = {"b": b"x y z", "a": b"x y z"}
    docs = spark.createDataFrame([(1, "some words here")], "doc_id long, text string")
    found = langid.identify(docs, same, ["doc_id", "text"])
    assert found.first().lang_pred == "a" and found.first().score == 0
    assert langid.accepted(found).count() == 0


def test_names_that_are_taken(odd):
    dictionaries = {"en": b"the cat and the dog sat on the mat", "fr": "le chat et le chien sont là".encode()}
    found = langid.identify(odd, dictionaries, odd.columns)
    assert found.columns == [*odd.columns, "lang_pred_", "score_"]
    kept = langid.accepted(found).collect()
    assert {r.lang_pred_ for r in kept} == {"en", "fr"} and {r.lang_pred for r in kept} <= {"x", "y", None}
