from datetime import datetime

from qanat.operators import orphans as O


def test_kinds(spark):
    t = lambda n: datetime(2024, 1, n)
    docs = spark.createDataFrame([("d1", "D2 ", ("success",), t(1)), ("d2", "nope", ("deleted",), t(1)), ("d3", " ", (None,), t(1)), ("d4", None, None, t(1))], "id string, superseded_by string, metadata struct<status: string>, created_at timestamp")
    arts = spark.createDataFrame([("a1", "d1", t(5)), ("a1", "d1", t(5)), ("a2", "d2", t(1)), ("a3", "gone", t(1))], "id string, document_id string, created_at timestamp")
    asked = spark.createDataFrame([("q1", ["A1", " a1", "a2", None, "", "zz"], t(3)), ("q1", ["A1", " a1", "a2", None, "", "zz"], t(3)), ("q2", ["a1", "a3"], t(6)), ("q3", None, t(1)), ("q4", [], t(1))], "id string, expected_citations array<string>, created_at timestamp")
    got = O.corpus_orphans(docs, arts, asked)
    assert {tuple(r)[:4] for r in got.collect()} == {
        ("law_documents", "d1", "d2", "deleted"), ("law_documents", "d2", "nope", "missing"),
        ("eval_questions", "q1", "a1", "late"), ("eval_questions", "q1", "a2", "deleted"), ("eval_questions", "q1", "zz", "missing"),
    }
    assert got.count() == 5
    assert {(r["record_table"], str(r["period"]), r["orphan_kind"]): r["orphans"] for r in O.orphan_report(got).collect()}[("eval_questions", "2024-01-01", "late")] == 1


def test_hot_key_is_sliced(spark, monkeypatch):
    monkeypatch.setattr(O, "REFERENCES_PER_SLICE", 50)
    parents = spark.createDataFrame([("p", False, 10.0)], "key string, deleted boolean, made double")
    refs = spark.createDataFrame([(str(i), "p", 5.0) for i in range(400)] + [("x", "q", None)], "record_id string, ref_key string, at double")
    got = O.orphan_references(refs, parents)
    assert got.where("orphan_kind = 'late'").count() == 400
    assert [r["record_id"] for r in got.where("orphan_kind = 'missing'").collect()] == ["x"]


def test_empty(spark):
    parents = spark.createDataFrame([], "key string, deleted boolean, made double")
    refs = spark.createDataFrame([("r", "k", None)], "record_id string, ref_key string, at double")
    assert [tuple(r) for r in O.orphan_references(refs, parents).collect()] == [("r", "k", "missing")]
    assert O.orphan_references(refs.limit(0), parents).count() == 0
