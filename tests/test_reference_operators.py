import json

import pytest
from pyspark.sql import functions as F

from qanat.functions.vector import cosine_distance, stub_embedding
from qanat.operators import corpus, embedding, evaluation, ingest, retrieval, sinks, versions
from qanat.operators.tenancy import TenantContext
from qanat.sources import files
from qanat.streaming.changes import stream_notices

TENANT = "0a1b2c3d-0000-1111-2222-333344445555"


def test_fusion_keeps_the_best_chunk_of_each_article(spark):
    dense = spark.createDataFrame([("c1", "A", 0.0), ("c2", "A", 1.0), ("c3", "B", 0.25)], "id string, article_id string, distance double")
    sparse = spark.createDataFrame([("c3", "B", 0.05), ("c4", "C", 0.08)], "id string, article_id string, sparse_score double")
    fused = retrieval.fuse(dense, sparse)
    assert {r["id"]: r["score"] for r in fused.collect()} == {"c1": 1.0, "c2": 0.5, "c3": 0.85, "c4": 0.08}
    best = retrieval.best_per_group(fused, "article_id", F.desc("score"), F.col("id")).orderBy(F.desc("score")).limit(2).collect()
    assert [(r["article_id"], r["id"]) for r in best] == [("A", "c1"), ("B", "c3")]


def test_batch_search_is_the_single_one(spark):
    rows = [(f"c{i}", f"a{i % 7}", [float((i * 7 + j * 3) % 11) - 5 for j in range(4)]) for i in range(60)] + [("z", "a", [0.0] * 4), ("n", "a", None)]
    chunks = spark.createDataFrame(rows, "id string, article_id string, embedding_ar array<float>")
    asked = spark.createDataFrame([(f"q{i}", rows[i][2]) for i in (3, 8)], "query_id string, vector array<float>")
    got = retrieval.dense_pools(chunks, asked, 6).collect()
    for i in (3, 8):
        single = retrieval.dense_pool(chunks, rows[i][2], 6).collect()
        assert {(r["id"], r["distance"]) for r in got if r["query_id"] == f"q{i}"} == {(r["id"], r["distance"]) for r in single}


def test_vectors(spark):
    row = spark.range(1).select(cosine_distance(F.array(F.lit(1.0), F.lit(0.0)), F.array(F.lit(0.0), F.lit(2.0))).alias("d"), cosine_distance(F.array(F.lit(0.0)), F.array(F.lit(1.0))).alias("n"), F.size(stub_embedding(F.lit(3), 5)).alias("k")).first()
    assert (row["d"], row["n"], row["k"]) == (1.0, None, 5)


def diff(spark, old, new):
    docs = spark.createDataFrame([("d1", "s", "2024-01-01"), ("d2", "s", "2024-01-02")], "id string, source_id string, c string").withColumn("created_at", F.to_timestamp("c"))
    rows = [(f"{d}{i}", d, n, i, t, "") for d, own in (("d1", old), ("d2", new)) for i, (n, t) in enumerate(own)]
    arts = spark.createDataFrame(rows, "id string, document_id string, article_number string, ordering int, text_ar string, text_en string")
    return {(r["article_number"], r["change"]) for r in versions.article_diff(arts, docs).collect()}


@pytest.mark.parametrize(
    "old, new, wanted",
    [
        ([("1", "a")], [("1", "a"), ("2", "b")], {("2", "added")}),
        ([("1", "a"), ("2", "b")], [("1", "a")], {("2", "removed")}),
        ([("1", "old")], [("1", "new")], {("1", "updated")}),
        ([("1", "a")], [("1", "a")], set()),
        ([], [("1", "a")], {("1", "added")}),
        ([("1", "")], [("1", "a")], {("1", "added")}),
        ([(None, "a")], [(None, "b")], {(None, "updated")}),
    ],
)
def test_article_diff(spark, old, new, wanted):
    assert diff(spark, old, new) == wanted


@pytest.mark.parametrize("expected, got, wanted", [([], ["a"], (0, None, None)), (["a", "a", "b"], ["a", "c", "d"], (1, 0.5, 1 / 3)), (["a"], [], (0, 0.0, 0.0)), (["a"], ["a"], (1, 1.0, 1.0))])
def test_scores(spark, expected, got, wanted):
    q = spark.createDataFrame([("q", "d", expected)], "question_id string, domain string, expected array<string>")
    r = spark.createDataFrame([("q", got)], "question_id string, articles array<string>")
    row = evaluation.question_scores(q, r).first()
    assert (row["hits"], row["recall"], row["precision"]) == wanted


def test_tenancy(spark, tmp_path):
    rows = spark.createDataFrame([(TENANT, 1), (TENANT.replace("0a", "ff"), 2)], "tenant_id string, n int")
    assert [r["n"] for r in TenantContext(TENANT).rows(rows).collect()] == [1]
    assert TenantContext(None).rows(rows).count() == 0
    with pytest.raises(ValueError):
        TenantContext("x' OR 1")
    with pytest.raises(PermissionError):
        TenantContext(TENANT).append(rows, str(tmp_path / "t"))


def test_upsert(spark):
    columns = "id string, slug string, code string, type string, issuer string, jurisdiction string, language_primary string, created_at string, updated_at string"
    held = spark.createDataFrame([("1", "a", "A", "t", "i", "SA", "ar", "c", "u")], columns)
    new = spark.createDataFrame([("9", "a", "B", "x", "j", "XX", "en", "d", "v"), ("2", "b", "B", "t", "i", "SA", "ar", "c", "u")], columns)
    assert sorted(tuple(r) for r in corpus.upsert_sources(held, new).collect()) == [("1", "a", "B", "x", "j", "SA", "ar", "c", "v"), ("2", "b", "B", "t", "i", "SA", "ar", "c", "u")]


def test_ingest_from_files(spark, tmp_path):
    first = "المادة الأولى: " + " ".join(["كلمة"] * 15)
    texts = [first, "المادة الثانية: وفقا للمادة الأولى من هذا " + "نص " * 10, "نص " * 704]
    (tmp_path / "out").mkdir()
    (tmp_path / "out/test_source.json").write_text(json.dumps([{"article_number": i + 1, "language": "ar", "text": t} for i, t in enumerate(texts)], ensure_ascii=False))
    (tmp_path / "out/bad.json").write_text("{}")
    (tmp_path / "out/web.json").write_text(json.dumps([{"article_number": "1", "text": "Government Website Registered - Privacy Policy"}]))
    (tmp_path / "out/none.json").write_text("[]")
    (tmp_path / "manifest.json").write_text(json.dumps({"sources": [{"name": "test_source", "status": "success", "article_count": 3}]}))
    assert files.read_manifest(spark, str(tmp_path / "manifest.json"), "TEST_SOURCE").count() == 1
    assert files.read_manifest(spark, str(tmp_path / "manifest.json"), "other").count() == 0
    known = spark.createDataFrame([], "source_name string, version_order int, content_hash string")
    read = files.read_article_files(spark, str(tmp_path / "out"))
    tables = ingest.ingest(read, known)
    run = ingest.write_run(tables, str(tmp_path / "lake"))
    got = {t: ingest.committed(spark, str(tmp_path / "lake"), t) for t in ("documents", "articles", "chunks", "edges", "rejected")}
    assert run and got["documents"].count() == 1 and got["articles"].count() == 3
    assert sorted(r["token_count"] for r in got["chunks"].collect())[-2:] == [242, 512] and got["chunks"].count() == 4
    assert got["edges"].count() == 1
    assert {tuple(r) for r in got["rejected"].collect()} == {("bad", "invalid json"), ("web", "website content"), ("none", "no articles")}
    again = ingest.ingest(read, got["documents"].select("source_name", "version_order", "content_hash"))
    assert again["documents"].count() == 0


def test_page_lines(spark):
    items = spark.createDataFrame([(1, 1, "a", 700.2, False), (1, 2, "b", 699.0, False), (1, 3, "c", 680.0, True), (1, 4, "d", 680.0, False)], "page int, item_no int, str string, y double, has_eol boolean")
    assert [r["text"] for r in files.page_lines(items).orderBy("line").collect()] == ["ab", "c", "d"]


def test_stream_equals_batch(spark, tmp_path):
    docs = spark.createDataFrame([("d1", "s1"), ("d2", "s2")], "id string, source_id string")
    interests = spark.createDataFrame([("t1", "s1"), ("t2", "s1")], "tenant_id string, source_id string")
    spark.createDataFrame([("d1", "1", "added"), ("d2", "1", "added")], "document_id string, article_number string, change string").write.parquet(str(tmp_path / "in"))
    stream_notices(spark, str(tmp_path / "in"), docs, interests, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).drop("batch")
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, [("d1", "s1", "t1"), ("d1", "s1", "t2"), ("d2", "s2", None)]))


def test_source_metadata(spark):
    rows = spark.createDataFrame([("labor",), ("new_one",)], "n string").select(files.source_metadata(F.col("n")).alias("m")).select("m.*").collect()
    assert [tuple(r)[:3] for r in rows] == [("labor", "LABOR_LAW", "statute"), ("new_one", "NEW_ONE", "regulation")]


def test_embedding_in_batches_with_retries(spark):
    calls = []

    def provider(texts):
        calls.append(len(texts))
        if len(calls) == 1:
            raise embedding.Throttled
        return embedding.hashed_provider(4)(texts)

    assert len(embedding.call(provider, ["a", "b"], wait_s=0)) == 2 and calls == [2, 2]
    with pytest.raises(embedding.Throttled):
        embedding.call(lambda t: (_ for _ in ()).throw(embedding.Throttled), ["a"], retries=1, wait_s=0)
    rows = spark.createDataFrame([(str(i), "same" if i % 2 else f"t{i}") for i in range(200)] + [("n", None), ("e", "")], "id string, text string")
    got = {r["id"]: r["vector"] for r in embedding.embedded(rows, embedding.hashed_provider(4)).collect()}
    assert len(got) == 202 and got["1"] == got["3"] != got["2"] and got["n"] is None and got["e"] is None


def test_sinks(spark, tmp_path):
    held = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    new = spark.createDataFrame([("a", 9)], "k string, v int")
    assert sorted(r["v"] for r in sinks.replaced(held, new, "k").collect()) == [2, 3, 9]
    assert sorted(r["v"] for r in sinks.without_keys(held, new, "k").collect()) == [2, 3]
    events = spark.createDataFrame([("r", 1, "running"), ("r", 2, "success")], "k string, at int, status string")
    assert [r["status"] for r in sinks.latest_events(events, "k", "at").collect()] == ["success"]
    sinks.write_json(held, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 3
    assert sinks.cloned(held.where("k = 'a'"), "k", 2).count() == 2
    assert spark.range(1).select(files.parse_vector(F.lit("[1,2.5]")).alias("v")).first()["v"] == [1.0, 2.5]
    (tmp_path / "x.pdf").write_bytes(b"%PDF")
    assert files.read_binary(spark, str(tmp_path)).count() == 1


def test_half_heights_round_up(spark):
    items = spark.createDataFrame([(1, 1, "a", 2.5, False), (1, 2, "b", 0.5, False), (1, 3, "c", 5.5, False)], "page int, item_no int, str string, y double, has_eol boolean")
    assert [r["text"] for r in files.page_lines(items).orderBy("line").collect()] == ["ab", "c"]


def test_appends_and_guards(spark, tmp_path):
    rows = spark.createDataFrame([("v1", "tax", "q", None)], "version string, domain string, question_ar string, expected_citations array<string>")
    sinks.append_rows(rows, "eval_questions", str(tmp_path))
    held = spark.read.parquet(f"{tmp_path}/eval_questions")
    row = held.first()
    assert row["expected_citations"] == [] and row["question_en"] is None and len(row["id"]) == 36
    assert sinks.unseeded(rows, held).count() == 0
    one = sinks.get_or_create(spark, f"{tmp_path}/tenants", "dev")
    assert one == sinks.get_or_create(spark, f"{tmp_path}/tenants", "dev") and spark.read.parquet(f"{tmp_path}/tenants").count() == 1
    assert sinks.throughput(10, 2.0) == 5.0 and sinks.throughput(1, 0.0) == 0.0


def test_cascade_keeps_what_is_not_below(spark):
    make = lambda rows, schema: spark.createDataFrame(rows, schema)
    kept = corpus.cascade(make([("s", "load_1"), ("t", "x"), ("u", None)], "id string, slug string"), make([("d", "s"), ("e", "t")], "id string, source_id string"), make([("a", "d"), ("b", "e"), ("c", None)], "id string, document_id string"), make([("k", "a"), ("l", "b"), ("m", None)], "id string, article_id string"), "load_")
    assert {n: sorted(r["id"] for r in rows.collect()) for n, rows in kept.items()} == {"sources": ["t", "u"], "law_documents": ["e"], "articles": ["b", "c"], "article_chunks": ["l", "m"]}


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from qanat.session import shared_dir

    empty = SimpleNamespace(isEmpty=lambda: True)
    context = SimpleNamespace(master="spark://host", getConf=lambda: {}, _jsc=SimpleNamespace(sc=lambda: SimpleNamespace(getCheckpointDir=lambda: empty)))
    with pytest.raises(ValueError):
        shared_dir(SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda *_: None)))
