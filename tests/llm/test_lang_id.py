import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from orderlens.llm import lang_id as li
from orderlens.llm import queries


def test_held_out_accuracy(spark):
    """Learn from three quarters of the labelled documents, predict the rest."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = queries.op1_language_id(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out)
    test = [r for r in out if r.held_out and r.lang is not None]
    assert len(test) > 200 and sum(r.lang == r.lang_pred for r in test) >= 0.97 * len(test)
    assert all(0 <= r.score <= 1 for r in out)
    sure = [r for r in test if not r.rejected]
    assert sum(r.lang == r.lang_pred for r in sure) >= 0.98 * len(sure)


@pytest.fixture(scope="module")
def model(frame):
    rows = [(i, "the quick brown fox jumps over the lazy dog near the river and the old mill", "en") for i in range(5)]
    rows += [(i, "der schnelle braune Fuchs springt über den faulen Hund am Fluss bei der alten Mühle", "de") for i in range(5, 9)]
    rows += [(9, "no label", None), (10, None, "fr"), (None, "the brown mill", "en")]
    return li.learn(frame(rows, "doc_id long, text string, lang string"))


def test_dictionaries(model):
    assert list(model.dictionaries) == ["en", "de"]


def test_edge_cases(frame, model):
    rows = [
        (1, None), (2, ""), (3, "123 !? ½"), (4, "THE OLD MILL, NEAR THE RIVER!!"), (5, "über den faulen Hund springt der Fuchs"), (6, "qz"),
        (7, "the lazy dog " * 100_000), (None, "the old mill near the river and the dog"),
    ]
    got = {r.doc_id: r for r in li.identify(frame(rows, "doc_id long, text string"), model).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and all(got[i].score == 0 and got[i].rejected for i in (1, 2, 3))
    assert got[4].lang_pred == got[7].lang_pred == got[None].lang_pred == "en" and got[5].lang_pred == "de"
    assert got[6].rejected and got[6].lang_pred == "en" and got[6].score <= 0.6


def test_no_labels_clashes_and_empty_table(spark, frame, model):
    none = li.learn(frame([(1, "text", None)], "doc_id long, text string, lang string"))
    df = frame([(1, "some text", "mine", 3.0)], "doc_id long, text string, lang_pred string, extra double")
    assert li.identify(df, none).first().lang_pred == "und"
    out = li.identify(df, model)
    assert out.columns.count("lang_pred") == 1 and out.first().extra == 3.0
    assert li.identify(spark.createDataFrame([], "doc_id long, text string"), model).collect() == []
    one = li.Classifier({"en": b"some text of one language"})
    assert li.identify(df, one).first().score == 1.0


def test_more_languages_than_full_dictionaries(frame, monkeypatch):
    def text(lang, i):
        words = [hashlib.md5(f"{lang} {k}".encode()).hexdigest()[:9].translate(str.maketrans("0123456789", "ghijklmnop")) for k in range(5)]
        return " ".join(words[(i + k) % 5] for k in range(6))

    rows = [(lang * 10 + i, text(lang, i) if i else "12 345", f"l{lang:03}") for lang in range(230) for i in range(4)]
    df = frame(rows, "doc_id long, text string, lang string")
    every = li.learn(df)
    assert len(every.dictionaries) == 230
    monkeypatch.setattr(li, "TOTAL_BYTES", 230 * 40)
    less = li.learn(df)
    assert less.dictionaries == {lang: content[:40] for lang, content in every.dictionaries.items()}
    got = {r.doc_id: r.lang_pred for r in li.identify(df.filter("doc_id % 10 = 1 AND doc_id % 70 = 1"), every).collect()}
    assert len(got) > 30 and all(lang == f"l{i // 10:03}" for i, lang in got.items())


def test_learning_ignores_order(spark, frame):
    rows = [(i, f"text number {i} of a language with words", "en" if i % 3 else "xx") for i in range(1500)]
    a = li.learn(frame(rows, "doc_id long, text string, lang string", 2))
    b = li.learn(frame(rows[::-1], "doc_id long, text string, lang string", 5))
    assert a.dictionaries == b.dictionaries
    held = spark.createDataFrame([(i,) for i in range(50)] + [(None,)], "id long").select("id", li.held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (r.id is not None and zlib.crc32(str(r.id).encode()) % 4 == 2) for r in held)
