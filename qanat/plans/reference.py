"""Queries of the engine's own operators over the whole tables, each with the SQL it is held against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from qanat.functions import text as T
from qanat.functions.vector import stub_embedding, usable
from qanat.operators import corpus as C
from qanat.operators import evaluation as E
from qanat.operators import retrieval as R
from qanat.operators import sinks as S
from qanat.operators import tenancy as N
from qanat.operators import versions as V
from qanat.sources.files import held_versions as held
from qanat.sources.tables import table

TERMS = ["سجل", "المجلس"]
CONTENT = ("articles", "law_documents")


def _tables(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [table(spark, sf_dir, n) for n in names]


def _chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.current_chunks(*_tables(spark, sf_dir, "article_chunks", "articles", "law_documents"))


def _vector(spark: SparkSession, sf_dir: str) -> list[float]:
    """The asked vector: that of the chunk with the smallest id that has one."""
    row = table(spark, sf_dir, "article_chunks").where(usable(F.col("embedding_ar"))).agg(F.min_by("embedding_ar", "id").alias("v")).first()
    return list(row["v"] or ()) if row else []


def _current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.current_articles(*_tables(spark, sf_dir, *CONTENT))


def dense_search(spark, d):
    return R.dense_pool(table(spark, d, "article_chunks"), _vector(spark, d), R.TOP, _current(spark, d))


def sparse_search(spark, d):
    return R.sparse_pool(table(spark, d, "article_chunks"), R.term_hits(table(spark, d, "articles"), TERMS), current=_current(spark, d))


def fused_pools(spark, d):
    chunks, current = table(spark, d, "article_chunks"), _current(spark, d)
    return R.fuse(R.dense_pool(chunks, _vector(spark, d), current=current), R.sparse_pool(chunks, R.term_hits(table(spark, d, "articles"), TERMS), current=current))


def hybrid_search(spark, d):
    return R.hybrid_search(table(spark, d, "article_chunks"), _current(spark, d), R.term_hits(table(spark, d, "articles"), TERMS), _vector(spark, d))


def decorated_search(spark, d):
    """The hybrid search's results as a reader sees them."""
    shown = R.decorated(hybrid_search(spark, d), table(spark, d, "article_chunks"), _current(spark, d), table(spark, d, "sources"))
    return shown.select("id", "article_number", "source_code", F.md5("chunk_text").alias("text_md5"), "score")


def audited_search(spark, d):
    """The audit row that the hybrid search leaves behind."""
    row = R.search_audit(hybrid_search(spark, d), "00000000-0000-0000-0000-000000000001", " ".join(TERMS), "stored vectors and terms", 5)
    return row.select("tenant_id", "query_hash", "response_hash", F.array_join("retrieved_chunk_ids", ",").alias("ids"), "latency_ms")


def response_hashes(spark, d):
    return N.hashed_responses(table(spark, d, "query_audit_log"))


def dense_search_batch(spark, d):
    chunks = table(spark, d, "article_chunks")
    asked = chunks.where("conv(substr(md5(id), 1, 4), 16, 10) % 50 = 0").select(F.col("id").alias("query_id"), F.col("embedding_ar").alias("vector"))
    return R.dense_pools(chunks, asked, R.TOP).select("query_id", "id", "distance")


def best_chunk_per_article(spark, d):
    return R.best_per_group(table(spark, d, "article_chunks").select("article_id", "id", "token_count"), "article_id", F.desc("token_count"), F.col("id"))


def four_way_join(spark, d):
    rows = _chunks(spark, d).join(table(spark, d, "sources").select(F.col("id").alias("source_id"), F.col("code").alias("source_code")), "source_id")
    return rows.groupBy("source_code").agg(F.count("*").alias("chunks"), F.countDistinct("article_id").alias("articles"))


def chunk_articles(spark, d):
    return C.chunk_articles(table(spark, d, "articles")).select("article_id", "chunk_index", "token_count", F.md5("chunk_text").alias("text_md5"), F.md5("chunk_text_normalized").alias("normalized_md5"))


def chunk_statistics(spark, d):
    return C.chunk_articles(table(spark, d, "articles")).groupBy("chunk_index").agg(F.count("*").alias("chunks"), F.sum("token_count").alias("tokens"))


def normalized_texts(spark, d):
    own = T.normalize_arabic(F.col("text_ar"))
    rows = table(spark, d, "articles").where("text_ar != ''").select(F.col("id").alias("article_id"), F.md5(own).alias("normalized_md5"), (own != F.coalesce("text_ar_normalized", F.lit(""))).alias("stale"))
    return rows.groupBy("article_id").agg(F.min(F.struct("normalized_md5", "stale")).alias("n")).select("article_id", "n.*")


def extract_citations(spark, d):
    """Citations of the texts with their headings' colons taken away, so that every heading cites."""
    rows = table(spark, d, "articles").withColumn("text_ar", F.regexp_replace("text_ar", "[:：]", " "))
    return C.article_citations(rows).select("article_id", "cited_number", "matched_text")


def citation_edges(spark, d):
    """Edges of derived texts: each article cites the one whose number is its own place modulo ten, behind a no-break space."""
    names = F.array(*map(F.lit, list(T.ORDINAL_UNITS)[2:]))
    cite = F.concat(F.lit("وفقا للمادة\u00a0"), F.element_at(names, F.col("ordering") % 9 + 1), F.lit(" من النظام"))
    rows = table(spark, d, "articles").select("id", "document_id", F.regexp_replace("article_number", "^(ar|en)_", "").alias("article_number"), "ordering", cite.alias("text_ar"))
    return C.citation_edges(rows.distinct())


def unchanged_documents(spark, d):
    return V.unchanged_documents(table(spark, d, "law_documents"))


def version_chain(spark, d):
    return V.version_chain(table(spark, d, "law_documents"))


def latest_documents(spark, d):
    return V.latest_documents(table(spark, d, "law_documents"))


def article_diff(spark, d):
    return V.article_diff(*_tables(spark, d, *CONTENT))


def diff_summary(spark, d):
    summary = V.diff_summary(article_diff(spark, d))
    return summary.select("document_id", *(F.array_join(c, ",").alias(c) for c in ("added", "updated", "removed")), *(F.size(c).alias(f"n_{c}") for c in ("added", "updated", "removed")))


def watch_fanout(spark, d):
    log, chunks, articles, documents = _tables(spark, d, "query_audit_log", "article_chunks", "articles", "law_documents")
    return N.watch_fanout(V.article_diff(articles, documents), documents, N.tenant_sources(log, chunks, articles, documents))


def tenant_usage(spark, d):
    return N.tenant_usage(table(spark, d, "query_audit_log"))


def tenant_rows(spark, d):
    """The busiest part of the log for the first tenant by name, through its context."""
    first = table(spark, d, "tenants").agg(F.min_by("id", F.struct("name", "id")).alias("id")).first()["id"]
    return N.TenantContext(first).rows(table(spark, d, "query_audit_log")).select("id", "query_hash").distinct()


def audit_hashes(spark, d):
    return N.audit_projection(table(spark, d, "query_audit_log"))


def _scores(spark, d):
    """Questions against what the log retrieved last for the same text."""
    questions, log, chunks = _tables(spark, d, "eval_questions", "query_audit_log", "article_chunks")
    asked = questions.dropDuplicates(["id"]).select(F.col("id").alias("question_id"), "domain", F.col("expected_citations").alias("expected"), F.coalesce(F.when(F.col("question_ar") != "", F.col("question_ar")), F.col("question_en")).alias("text"))
    last = log.where("query_text IS NOT NULL").groupBy("query_text").agg(F.max_by("retrieved_chunk_ids", F.struct("created_at", "id")).alias("ids"))
    shown = last.select("query_text", F.posexplode("ids").alias("at", "id")).join(chunks.select("id", "article_id"), "id").groupBy("query_text").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "article_id"))), lambda s: s["article_id"]).alias("articles"))
    return E.question_scores(asked.select("question_id", "domain", "expected"), asked.join(shown, F.col("text") == F.col("query_text")).select("question_id", "articles"))


def eval_question_scores(spark, d):
    return _scores(spark, d).select("question_id", "domain", "hits", F.round("recall", 6).alias("recall"), F.round("precision", 6).alias("precision"))


def eval_by_domain(spark, d):
    return E.by_domain(_scores(spark, d))


def eval_overall(spark, d):
    return E.overall(_scores(spark, d))


def seed_questions(spark, d):
    return C.seed_questions(*_tables(spark, d, "articles", "law_documents", "eval_questions"))


def stale_citations(spark, d):
    return C.stale_citations(*_tables(spark, d, "eval_questions", "articles", "law_documents"))


def fresh_questions(spark, d):
    return S.fresh_questions(*_tables(spark, d, "eval_questions", "articles", "law_documents")).select("id", "domain")


def replaced_articles(spark, d):
    """Articles of the newest versions delivered again with an upper-case number, in place of the held ones."""
    articles = table(spark, d, "articles").dropDuplicates(["id"]).select("id", "document_id", "article_number")
    newest = V.latest_documents(table(spark, d, "law_documents")).select("document_id")
    new = articles.join(newest, "document_id").select("id", "document_id", F.upper("article_number").alias("article_number"))
    return S.replaced(articles, new, "document_id")


def latest_queries(spark, d):
    """The newest log entry of each tenant."""
    log = table(spark, d, "query_audit_log").where("tenant_id IS NOT NULL").select("tenant_id", "id", "query_hash", F.struct("created_at", "id").alias("at"))
    return S.latest_events(log, "tenant_id", "at").select("tenant_id", "id", "query_hash")


def cloned_sources(spark, d):
    return S.cloned(table(spark, d, "sources").select("slug", "type"), "slug", 3)


def uncited_articles(spark, d):
    articles, questions = _tables(spark, d, "articles", "eval_questions")
    cited = questions.select(F.explode("expected_citations").alias("id")).distinct()
    return articles.select("id", "document_id").distinct().join(cited, "id", "left_anti").groupBy("document_id").agg(F.count("*").alias("uncited"))


def validate_documents(spark, d):
    return C.validate_documents(table(spark, d, "articles"))


def corpus_health(spark, d):
    return C.corpus_health(*_tables(spark, d, "sources", "law_documents", "articles"))


def unpaired_numbers(spark, d):
    return C.unpaired_numbers(table(spark, d, "articles"))


def cascade_counts(spark, d):
    return C.cascade_counts(*_tables(spark, d, "sources", "law_documents", "articles", "article_chunks"), "wage_")


def source_upsert(spark, d):
    held = table(spark, d, "sources")
    new = held.where("slug LIKE '%code%'").select(F.lit("x").alias("id"), "slug", F.upper(F.concat("code", F.lit("_new"))).alias("code"), F.lit("statute").alias("type"), "issuer", F.lit("XX").alias("jurisdiction"), F.lit("unknown").alias("language_primary"), "created_at", F.lit("2026-01-01").cast("timestamp").alias("updated_at"))
    more = new.limit(0).unionByName(new).unionByName(held.agg(F.lit("y").alias("id"), F.lit("new_slug").alias("slug"), F.lit("NEW_SLUG").alias("code"), F.lit("regulation").alias("type"), F.lit("Unknown").alias("issuer"), F.lit("SA").alias("jurisdiction"), F.lit("unknown").alias("language_primary"), F.min("created_at").alias("created_at"), F.max("updated_at").alias("updated_at")))
    return C.upsert_sources(held, more)


def corpus_counts(spark, d):
    out = None
    for name in ("sources", "law_documents", "articles", "article_chunks"):
        one = table(spark, d, name).agg(F.lit(name).alias("table_name"), F.count("*").cast("int").alias("n"))
        out = one if out is None else out.unionByName(one)
    return out


def articles_per_document(spark, d):
    return table(spark, d, "articles").select("id", "document_id").distinct().groupBy("document_id").agg(F.count("*").alias("n"))


def expected_articles(spark, d):
    """The advisory count of each version against what was delivered, with running totals by source."""
    documents, articles = _tables(spark, d, "law_documents", "articles")
    n = articles.select("id", "document_id").distinct().groupBy("document_id").agg(F.count("*").alias("delivered"))
    rows = documents.select(F.col("id").alias("document_id"), "source_id", "created_at", F.col("metadata.article_count").alias("stated")).join(n, "document_id", "left")
    order = Window.partitionBy("source_id").orderBy("created_at", "document_id").rowsBetween(Window.unboundedPreceding, 0)
    return rows.select("document_id", "stated", F.coalesce("delivered", F.lit(0)).alias("delivered"), F.sum(F.coalesce("delivered", F.lit(0))).over(order).alias("running"))


def content_types(spark, d):
    url = F.coalesce("source_url", F.lit("unknown"))
    return table(spark, d, "law_documents").groupBy(T.content_type(url).alias("content_type")).agg(F.count("*").alias("n"))


def version_pairs(spark, d):
    """The ar_n and en_n rows of every number n that a document has."""
    rows = table(spark, d, "articles").where("article_number LIKE 'ar_%' OR article_number LIKE 'en_%'").select("id", "document_id", "article_number").distinct()
    numbered = rows.withColumn("n", F.substring("article_number", 4, 1 << 20))
    a, b = (numbered.where(F.col("article_number") == F.concat(F.lit(p), "n")).select("document_id", "n", F.col("id").alias(f"{p}id")) for p in ("ar_", "en_"))
    return a.join(b, ["document_id", "n"]).withColumnRenamed("n", "number")


def source_lookup(spark, d):
    return table(spark, d, "sources").where("slug LIKE 'wage%' AND code != 'WAGE_RULES_2'").select("id", "slug", "code").orderBy("code")


def json_first(spark, d):
    log = table(spark, d, "eval_questions").dropDuplicates(["id"])
    return log.select("id", F.get("expected_citations", F.lit(0)).alias("first_citation"), F.size(F.coalesce("expected_citations", F.array().cast("array<string>"))).alias("n"))


def event_properties(spark, d):
    events = table(spark, d, "events").select("event_type", F.from_json("props", "struct<k: int>").alias("p"))
    return events.groupBy("event_type").agg(F.count("p.k").alias("n"), F.sum(F.col("p.k").cast("long")).alias("total"))


def split_articles(spark, d):
    rows = table(spark, d, "articles").where("text_ar != ''")
    pieces = rows.select("id", F.posexplode(T.split_articles(F.col("text_ar"))).alias("at", "piece")).select("id", "at", F.col("piece.number").alias("number"), F.md5("piece.body").alias("body_md5"))
    return pieces.distinct()


def corruption_scan(spark, d):
    """The damage of damaged texts: every "ية " is drawn out, every " من" runs into a Latin letter, and a bell stands behind each full stop."""
    damaged = F.col("text_ar")
    for a, b in (("ية ", "يةةةة "), (" من", " xمن"), (".", ".\x07")):
        damaged = F.replace(damaged, F.lit(a), F.lit(b))
    seen = table(spark, d, "articles").select("id", damaged.alias("t")).select("id", T.corruption(F.col("t")).alias("c"), F.size(T.snippets(F.col("t"), T.REPEATED)).alias("samples")).select("id", "c.*", "samples")
    return seen.where("repeated_letters + glued_latin + controls > 0").distinct()


def term_frequencies(spark, d):
    """In how many articles each term of the text index occurs."""
    rows = table(spark, d, "articles").dropDuplicates(["id"]).select(F.explode(T.search_terms(F.col("text_ar_normalized"))).alias("term"))
    return rows.groupBy("term").agg(F.count("*").alias("articles"))


def script_routing(spark, d):
    rows = table(spark, d, "documents").select(T.is_arabic(F.col("text"), F.col("lang")).alias("arabic"), "lang")
    return rows.groupBy("lang", "arabic").agg(F.count("*").alias("n"))


def stub_embeddings(spark, d):
    rows = table(spark, d, "articles").select("id", "ordering").distinct()
    total = F.aggregate(stub_embedding(F.col("ordering")), F.lit(0.0), lambda s, x: s + x)
    return rows.select("ordering").distinct().select("ordering", F.round(total, 6).alias("total")).join(rows, "ordering").select("id", "total")


def fuzzy_parts(spark, d):
    return C.fuzzy_lookup(table(spark, d, "part").select("p_partkey", "p_name"), "p_name", "small ring")


def failing_questions(spark, d):
    return _scores(spark, d).where("recall = 0").select("question_id", "domain")


def spread_articles(spark, d):
    rows = table(spark, d, "articles").select("id", "document_id", "ordering").distinct()
    return C.spread_sample(rows, "document_id", ["ordering", "id"], 3).select("document_id", "id")


def leading_articles(spark, d):
    return C.leading_articles(*_tables(spark, d, *CONTENT), 3).select("source_id", "id")


def first_picks(spark, d):
    rows = table(spark, d, "articles").select("id", "document_id", "ordering").distinct()
    return C.first_picks(rows, "document_id", ["ordering", "id"], 3).select("document_id", "id")


def first_with_content(spark, d):
    return C.first_with_content(table(spark, d, "articles")).select("document_id", "article_id", F.md5("question").alias("question_md5"))


def questions_by_version(spark, d):
    return table(spark, d, "eval_questions").where("version = 'v1'").select("id", "domain").distinct().orderBy("domain", "id")


def unseeded_questions(spark, d):
    """Questions whose version and domain the first version's do not have."""
    rows = table(spark, d, "eval_questions").select("id", "version", "domain").distinct()
    return S.unseeded(rows, rows.where("version = 'v1'").select(F.lit("v2").alias("version"), "domain"))


def cascade_kept(spark, d):
    """What stays of each table when the sources of a prefix are removed."""
    kept = C.cascade(*_tables(spark, d, "sources", "law_documents", "articles", "article_chunks"), "wage_")
    parts = [rows.select(F.lit(name).alias("table_name"), "id") for name, rows in kept.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3]).distinct()


def held_versions(spark, d):
    """Every version's file against all versions of its source."""
    documents = table(spark, d, "law_documents").select(F.col("source_id").alias("source_name"), F.col("id").alias("document_id"), "version", "source_hash")
    files = documents.select("source_name", F.col("source_hash").alias("content_hash")).where("content_hash IS NOT NULL").distinct()
    return held(files, documents).where("same").groupBy("document_id").agg(F.count("*").alias("files"))


def first_of_versions(spark, d):
    """All versions of each source, oldest first, with the first article of each and whether nothing supersedes it."""
    articles, documents = _tables(spark, d, "articles", "law_documents")
    first = articles.where("document_id IS NOT NULL").groupBy("document_id").agg(F.min_by("id", F.struct("ordering", "id")).alias("first_article_id"))
    chain = V.version_chain(documents).select("document_id", "source_id", "version_order")
    flags = documents.select(F.col("id").alias("document_id"), F.col("superseded_by").isNull().alias("is_latest"))
    return chain.join(flags, "document_id").join(first, "document_id", "left")


def new_questions(spark, d):
    """Questions as the append-only table takes them: missing arrays are empty."""
    rows = table(spark, d, "eval_questions").drop("id", "created_at").distinct()
    return S.new_rows(rows, "eval_questions").groupBy("domain").agg(F.countDistinct("id").alias("n"), F.sum(F.size("expected_citations")).alias("citations"))


def manifest_times(spark, d):
    """The day each version was fetched, from ISO text."""
    return table(spark, d, "law_documents").where("metadata.fetched_at IS NOT NULL").select("id", F.to_date(T.iso_time(F.col("metadata.fetched_at"))).alias("fetched_on"))


_NAMES = (
    "dense_search sparse_search fused_pools hybrid_search dense_search_batch best_chunk_per_article four_way_join chunk_articles chunk_statistics normalized_texts extract_citations citation_edges unchanged_documents"
    " version_chain latest_documents article_diff diff_summary watch_fanout tenant_usage tenant_rows audit_hashes eval_question_scores eval_by_domain eval_overall seed_questions stale_citations uncited_articles"
    " validate_documents corpus_health unpaired_numbers cascade_counts source_upsert corpus_counts articles_per_document expected_articles content_types version_pairs source_lookup json_first event_properties"
    " split_articles corruption_scan term_frequencies script_routing stub_embeddings fuzzy_parts failing_questions spread_articles fresh_questions replaced_articles latest_queries cloned_sources"
    " decorated_search audited_search response_hashes leading_articles first_picks first_with_content questions_by_version unseeded_questions cascade_kept held_versions first_of_versions new_questions manifest_times"
).split()
QUERIES = {name: globals()[name] for name in _NAMES}

# ------------------------------------------------------------------------------------------------------------------------------------ SQL

_WS = "[\\t\\n\\x0B\\f\\r \\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}\\x{FEFF}]"
_A = "a AS (SELECT DISTINCT ON (id) * FROM articles)"
_ok = lambda v: f"{v} IS NOT NULL AND list_max(list_transform({v}, lambda x: abs(x))) > 0"
_dist = lambda v, q: f"round(1 - list_cosine_similarity(CAST({v} AS DOUBLE[]), CAST({q} AS DOUBLE[])), 6) + 0"
_squeeze = lambda c: f"regexp_replace(regexp_replace({c}, '{_WS}+', ' ', 'g'), '^ +| +$', '', 'g')"
_norm = lambda c: _squeeze(f"translate(regexp_replace(coalesce({c}, ''), '[\\x{{64B}}-\\x{{65F}}\\x{{670}}]', '', 'g'), '{T.FOLDED}', '{T.FOLDED_TO}')")
_words = lambda c: f"list_filter(regexp_split_to_array(coalesce({c}, ''), '{_WS}+'), lambda x: x <> '')"
_TEXT = "coalesce(nullif(text_ar, ''), text_en)"

_CURRENT = f"""{_A}, c AS (SELECT k.id, k.article_id, k.embedding_ar, a.document_id, l.source_id FROM article_chunks k JOIN a ON a.id = k.article_id JOIN law_documents l ON l.id = a.document_id WHERE l.superseded_by IS NULL),
q AS (SELECT arg_min(embedding_ar, id) AS v FROM article_chunks WHERE {_ok('embedding_ar')})"""
_DENSE = f"SELECT c.id, c.article_id, {_dist('c.embedding_ar', 'q.v')} AS distance FROM c, q WHERE {_ok('c.embedding_ar')} ORDER BY distance, c.id"
_tf = lambda t: f"len(list_filter(w, lambda x: x = '{t}'))"
_SPARSE = f"""SELECT c.id, c.article_id, s.sparse_score FROM c JOIN (
  SELECT id, round(0.1 * ({' + '.join(f'{_tf(t)} / ({_tf(t)} + 1)' for t in TERMS)}) / {len(TERMS)}, 6) AS sparse_score
  FROM (SELECT id, regexp_extract_all(lower({_norm('text_ar')}), '[\\p{{L}}\\p{{N}}]+') AS w FROM a) WHERE {' AND '.join(f"list_contains(w, '{t}')" for t in TERMS)}
) s ON s.id = c.article_id ORDER BY s.sparse_score DESC, c.id LIMIT {R.POOL}"""
_FUSED = f"""WITH {_CURRENT}, dp AS ({_DENSE} LIMIT {R.POOL}), sp AS ({_SPARSE}),
f AS (SELECT coalesce(dp.id, sp.id) AS id, coalesce(dp.article_id, sp.article_id) AS article_id, round(coalesce(1 / (1 + distance), 0) + coalesce(sparse_score, 0), 6) AS score FROM dp FULL OUTER JOIN sp ON dp.id = sp.id)"""
_CHUNKED = f"""WITH {_A}, w AS (SELECT id, {_TEXT} AS t, {_words(_TEXT)} AS w FROM a),
n AS (SELECT *, len(w) AS n, CASE WHEN len(w) = 0 THEN 0 WHEN len(w) <= 512 THEN 1 ELSE ceil((len(w) - 50) / 462) END AS m FROM w),
x AS (SELECT id AS article_id, i + 1 AS chunk_index, w[CAST(i * 462 + 1 AS BIGINT):CAST(i * 462 + 512 AS BIGINT)] AS part, coalesce(regexp_matches(t, '[\\x{{600}}-\\x{{6FF}}]'), false) AS arabic FROM n, unnest(range(0, CAST(m AS BIGINT))) AS u(i)),
k AS (SELECT article_id, CAST(chunk_index AS INTEGER) AS chunk_index, CAST(len(part) AS INTEGER) AS token_count, array_to_string(part, ' ') AS chunk_text, arabic FROM x)"""
# Fixed values of the SQL, written out on their own so that a wrong one in the functions shows.
_UNITS = {"الأولى": 1, "الاولى": 1, "الحادية": 1, "الثانية": 2, "الثالثة": 3, "الرابعة": 4, "الخامسة": 5, "السادسة": 6, "السابعة": 7, "الثامنة": 8, "التاسعة": 9, "العاشرة": 10}
_TENS = {"العشرون": 20, "الثلاثون": 30, "الأربعون": 40, "الخمسون": 50, "الستون": 60, "السبعون": 70, "الثمانون": 80, "التسعون": 90}
_HUNDREDS = {"المائة": 100, "المائتين": 200}
_case = lambda c, table: f"CASE {c} " + " ".join(f"WHEN '{w}' THEN {n}" for w, n in table.items()) + " ELSE 0 END"
_RX = f"(?:ال|لل)ماد[ةه]{_WS}+({'|'.join(_UNITS)})(?:{_WS}+(عشرة))?(?:{_WS}+و({'|'.join(_TENS)}))?(?:{_WS}+بعد{_WS}+({'|'.join(_HUNDREDS)}))?({_WS}{{0,2}}[:：])?"
_grp = lambda i: f"regexp_extract(m, '{_RX}', {i})"
_CITES = f"""m AS (SELECT id, document_id, unnest(regexp_extract_all(text_ar, '{_RX}')) AS m FROM a),
cites AS (SELECT id AS article_id, document_id, m AS matched_text, CAST({_case(_grp(1), _UNITS)} + CASE WHEN {_grp(2)} <> '' AND {_grp(3)} = '' THEN 10 ELSE 0 END + {_case(_grp(3), _TENS)} + {_case(_grp(4), _HUNDREDS)} AS INTEGER) AS cited_number
  FROM m WHERE NOT regexp_matches(m, '[:：]$'))"""
_CHAIN = "ch AS (SELECT id AS document_id, source_id, row_number() OVER w AS version_order, lead(id) OVER w AS successor FROM law_documents WINDOW w AS (PARTITION BY source_id ORDER BY created_at, id))"
_DIFF = f"""WITH {_CHAIN}, st AS (SELECT document_id, article_number, arg_max(coalesce({_TEXT}, ''), (ordering, id)) AS t FROM articles GROUP BY 1, 2),
nw AS (SELECT st.*, 1 AS h FROM st JOIN ch USING (document_id) WHERE version_order > 1), od AS (SELECT ch.successor AS document_id, article_number, t, 1 AS h FROM st JOIN ch USING (document_id) WHERE successor IS NOT NULL),
df AS (SELECT coalesce(nw.document_id, od.document_id) AS document_id, coalesce(nw.article_number, od.article_number) AS article_number,
  CASE WHEN nw.h IS NULL THEN 'removed' WHEN od.h IS NULL OR od.t = '' THEN 'added' WHEN nw.t <> od.t THEN 'updated' END AS change
  FROM nw FULL OUTER JOIN od ON nw.document_id = od.document_id AND nw.article_number IS NOT DISTINCT FROM od.article_number),
d AS (SELECT * FROM df WHERE change IS NOT NULL)"""
_list = lambda k: f"coalesce(list_sort(list(coalesce(article_number, '')) FILTER (change = '{k}')), [])"
_SCORES = f"""WITH q AS (SELECT DISTINCT ON (id) id, domain, expected_citations, coalesce(nullif(question_ar, ''), question_en) AS t FROM eval_questions),
l AS (SELECT query_text, arg_max(coalesce(retrieved_chunk_ids, []), (created_at, id)) AS ids FROM query_audit_log WHERE query_text IS NOT NULL GROUP BY 1),
r AS (SELECT query_text, list(article_id) AS got FROM (SELECT query_text, unnest(ids) AS id FROM l) x JOIN article_chunks k USING (id) GROUP BY 1),
s AS (SELECT q.id AS question_id, domain, list_distinct(list_filter(coalesce(expected_citations, []), lambda x: x IS NOT NULL)) AS e, coalesce(got, []) AS g FROM q LEFT JOIN r ON q.t = r.query_text),
sc AS (SELECT question_id, domain, len(list_intersect(e, g)) AS hits, CASE WHEN len(e) > 0 THEN len(list_intersect(e, g)) / len(e) END AS recall, CASE WHEN len(e) > 0 THEN CASE WHEN len(g) > 0 THEN len(list_intersect(e, g)) / len(g) ELSE 0 END END AS precision FROM s)"""
_LATEST = "lt AS (SELECT source_id, arg_max(id, (created_at, id)) AS document_id FROM law_documents GROUP BY 1)"
_CITED = "cited AS (SELECT DISTINCT unnest(expected_citations) AS id FROM eval_questions)"
_spread = lambda rows, group, order: f"""p AS (SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY {order}) - 1 AS pos, count(*) OVER (PARTITION BY {group}) AS n FROM {rows}),
sp AS (SELECT *, greatest(1, n // 4) AS step FROM p), picked AS (SELECT * FROM sp WHERE pos IN (least(step, n - 1), least(2 * step, n - 1), least(3 * step, n - 1)))"""  # noqa: E731

_HEADER = f"الماد[ةه]{_WS}*\\({_WS}*(\\d+){_WS}*\\)"
_RUNS = "|".join(f"\\x{{{c:X}}}{{3,}}" for c in range(0x600, 0x700))
_LOG = "g AS (SELECT DISTINCT ON (id) * FROM query_audit_log)"

ORACLES = {
    "dense_search": f"WITH {_CURRENT} {_DENSE} LIMIT {R.TOP}",
    "sparse_search": f"WITH {_CURRENT} {_SPARSE}",
    "fused_pools": f"{_FUSED} SELECT * FROM f",
    "hybrid_search": f"{_FUSED}, b AS (SELECT *, row_number() OVER (PARTITION BY article_id ORDER BY score DESC, id) AS n FROM f) SELECT id, article_id, score FROM b WHERE n = 1 ORDER BY score DESC, id LIMIT {R.TOP}",
    "dense_search_batch": f"""WITH u AS (SELECT id, embedding_ar AS v FROM article_chunks WHERE {_ok('embedding_ar')}), q AS (SELECT id AS query_id, v AS qv FROM u WHERE CAST('0x' || substr(md5(id), 1, 4) AS INTEGER) % 50 = 0),
x AS (SELECT query_id, id, {_dist('v', 'qv')} AS distance FROM q, u) SELECT query_id, id, distance FROM x QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY distance, id) <= {R.TOP}""",
    "best_chunk_per_article": "SELECT article_id, id, token_count FROM article_chunks QUALIFY row_number() OVER (PARTITION BY article_id ORDER BY token_count DESC NULLS LAST, id) = 1",
    "four_way_join": f"WITH {_CURRENT} SELECT s.code AS source_code, count(*) AS chunks, count(DISTINCT article_id) AS articles FROM c JOIN sources s ON s.id = c.source_id GROUP BY 1",
    "chunk_articles": f"{_CHUNKED} SELECT article_id, chunk_index, token_count, md5(chunk_text) AS text_md5, md5(CASE WHEN arabic THEN {_norm('chunk_text')} ELSE chunk_text END) AS normalized_md5 FROM k",
    "chunk_statistics": f"{_CHUNKED} SELECT chunk_index, count(*) AS chunks, CAST(sum(token_count) AS BIGINT) AS tokens FROM k GROUP BY 1",
    "normalized_texts": f"WITH {_A} SELECT id AS article_id, md5({_norm('text_ar')}) AS normalized_md5, {_norm('text_ar')} <> coalesce(text_ar_normalized, '') AS stale FROM a WHERE text_ar <> ''",
    "extract_citations": f"WITH a AS (SELECT DISTINCT ON (id) id, document_id, regexp_replace(text_ar, '[:：]', ' ', 'g') AS text_ar FROM articles), {_CITES} SELECT article_id, cited_number, matched_text FROM cites",
    "citation_edges": f"WITH a AS (SELECT DISTINCT ON (id) id, document_id, ordering, regexp_replace(article_number, '^(ar|en)_', '') AS article_number, 'وفقا للمادة' || chr(160) || ['الحادية', 'الثانية', 'الثالثة', 'الرابعة', 'الخامسة', 'السادسة', 'السابعة', 'الثامنة', 'التاسعة', 'العاشرة'][ordering % 9 + 1] || ' من النظام' AS text_ar FROM articles), {_CITES}, t AS (SELECT document_id, article_number, arg_min(id, (ordering, id)) AS to_article_id FROM a WHERE article_number IS NOT NULL GROUP BY 1, 2) SELECT article_id AS from_article_id, to_article_id, matched_text FROM cites JOIN t ON t.document_id = cites.document_id AND t.article_number = CAST(cited_number AS VARCHAR) WHERE article_id <> to_article_id",
    "unchanged_documents": "SELECT document_id, first_document_id FROM (SELECT id AS document_id, first(id) OVER (PARTITION BY source_id, source_hash ORDER BY created_at, id) AS first_document_id FROM law_documents WHERE source_hash IS NOT NULL) WHERE document_id <> first_document_id",
    "version_chain": f"WITH {_CHAIN} SELECT document_id, source_id, CAST(version_order AS INTEGER) AS version_order, 'v' || (version_order + 1) AS next_version, successor FROM ch",
    "latest_documents": "SELECT source_id, arg_max(id, (created_at, id)) AS document_id, arg_max(version, (created_at, id)) AS version FROM law_documents GROUP BY 1",
    "article_diff": f"{_DIFF} SELECT * FROM d",
    "diff_summary": f"{_DIFF}, z AS (SELECT document_id, {_list('added')} AS a, {_list('updated')} AS u, {_list('removed')} AS r FROM d GROUP BY 1) SELECT document_id, array_to_string(a, ',') AS added, array_to_string(u, ',') AS updated, array_to_string(r, ',') AS removed, CAST(len(a) AS INTEGER) AS n_added, CAST(len(u) AS INTEGER) AS n_updated, CAST(len(r) AS INTEGER) AS n_removed FROM z",
    "watch_fanout": f"{_DIFF}, {_A}, i AS (SELECT DISTINCT tenant_id, source_id FROM (SELECT tenant_id, unnest(retrieved_chunk_ids) AS id FROM query_audit_log WHERE tenant_id IS NOT NULL) x JOIN article_chunks k USING (id) JOIN a ON a.id = k.article_id JOIN law_documents l ON l.id = a.document_id), e AS (SELECT DISTINCT document_id FROM d) SELECT e.document_id, l.source_id, i.tenant_id FROM e JOIN law_documents l ON l.id = e.document_id LEFT JOIN i ON i.source_id = l.source_id",
    "tenant_usage": f"WITH {_LOG} SELECT tenant_id, count(*) AS queries, count(DISTINCT user_id) AS users, count(DISTINCT query_hash) AS texts, round(avg(latency_ms), 4) AS mean_latency FROM g GROUP BY 1",
    "tenant_rows": "SELECT DISTINCT id, query_hash FROM query_audit_log WHERE tenant_id = (SELECT arg_min(id, (name, id)) FROM tenants)",
    "audit_hashes": f"WITH {_LOG} SELECT id, tenant_id, sha256(query_text) AS computed_hash, coalesce(sha256(query_text) = query_hash, false) AS matches FROM g",
    "eval_question_scores": f"{_SCORES} SELECT question_id, domain, CAST(hits AS INTEGER) AS hits, round(recall, 6) AS recall, round(precision, 6) AS precision FROM sc",
    "eval_by_domain": f"{_SCORES} SELECT domain, count(*) AS total, count(*) FILTER (recall IS NULL) AS skipped, round(avg(recall), 6) AS recall, round(avg(precision), 6) AS precision FROM sc GROUP BY 1",
    "eval_overall": f"{_SCORES} SELECT count(recall) AS scored, count(*) FILTER (recall IS NULL) AS skipped, round(avg(recall), 6) AS citation_recall, round(avg(precision), 6) AS citation_precision, round((avg(recall) + avg(precision)) / 2, 6) AS overall_score FROM sc",
    "seed_questions": f"WITH {_A}, {_LATEST}, {_CITED}, able AS (SELECT a.id AS article_id, lt.source_id, ordering, {_words("trim(substr(text_ar, instr(text_ar, ':') + 1))")} AS w FROM a JOIN lt ON lt.document_id = a.document_id WHERE instr(text_ar, ':') > 0 AND a.id NOT IN (SELECT id FROM cited WHERE id IS NOT NULL)), ok AS (SELECT * FROM able WHERE len(w) >= 15), {_spread('ok', 'source_id', 'ordering, article_id')} SELECT source_id, article_id, array_to_string(w[1:15], ' ') AS question FROM picked",
    "stale_citations": f"WITH {_A}, {_LATEST}, e AS (SELECT DISTINCT id AS question_id, unnest(expected_citations) AS citation FROM eval_questions) SELECT question_id, citation, CASE WHEN a.document_id IS NULL THEN 'does not exist' WHEN lt.document_id IS NOT NULL THEN 'latest' ELSE 'older version' END AS state FROM e LEFT JOIN a ON a.id = citation LEFT JOIN lt ON lt.document_id = a.document_id WHERE citation IS NOT NULL",
    "uncited_articles": f"WITH {_A}, {_CITED} SELECT document_id, count(*) AS uncited FROM a WHERE id NOT IN (SELECT id FROM cited WHERE id IS NOT NULL) GROUP BY 1",
    "validate_documents": f"WITH f AS (SELECT document_id, arg_min(coalesce({_TEXT}, ''), (ordering, id)) AS t FROM articles WHERE document_id IS NOT NULL GROUP BY 1) SELECT document_id, CASE WHEN coalesce(t, '') = '' THEN 'no text' WHEN {' OR '.join(f"contains(lower(t), '{p}')" for p in T.WEB_PHRASES)} THEN 'website content' ELSE 'ok' END AS reason FROM f",
    "corpus_health": f"WITH {_A}, cur AS (SELECT source_id, min(id) AS document_id FROM law_documents WHERE superseded_by IS NULL GROUP BY 1), fl AS (SELECT document_id, count(*) AS total, count(*) FILTER (trim(coalesce(text_ar, '')) = '' AND length(coalesce(text_en, '')) > 50) AS bad FROM a GROUP BY 1) SELECT code, CASE WHEN cur.document_id IS NULL THEN 'no document' WHEN total IS NULL THEN 'no articles' WHEN bad > 0 THEN 'empty arabic' ELSE 'ok' END AS status, coalesce(bad, 0) AS bad, coalesce(total, 0) AS total FROM sources s LEFT JOIN cur ON cur.source_id = s.id LEFT JOIN fl ON fl.document_id = cur.document_id",
    "unpaired_numbers": "WITH n AS (SELECT DISTINCT document_id, article_number[1:2] AS l, article_number[4:] AS number FROM articles WHERE regexp_matches(article_number, '^(ar|en)_')), b AS (SELECT document_id FROM n GROUP BY 1 HAVING count(DISTINCT l) = 2) SELECT document_id, number, CASE WHEN bool_or(l = 'ar') THEN 'en' ELSE 'ar' END AS missing FROM n WHERE document_id IN (SELECT document_id FROM b) GROUP BY 1, 2 HAVING count(*) = 1",
    "cascade_counts": f"WITH {_A}, g AS (SELECT id FROM sources WHERE starts_with(slug, 'wage_')), d AS (SELECT id, source_id IN (SELECT id FROM g) AS x FROM law_documents), r AS (SELECT a.id, coalesce(d.x, false) AS x FROM a LEFT JOIN d ON d.id = a.document_id), k AS (SELECT coalesce(r.x, false) AS x FROM article_chunks c LEFT JOIN r ON r.id = c.article_id), t AS (SELECT 'sources' AS table_name, starts_with(slug, 'wage_') AS x FROM sources UNION ALL SELECT 'law_documents', x FROM d UNION ALL SELECT 'articles', x FROM r UNION ALL SELECT 'article_chunks', x FROM k) SELECT table_name, count(*) FILTER (x) AS doomed, count(*) FILTER (NOT coalesce(x, false)) AS kept FROM t GROUP BY 1",
    "source_upsert": "SELECT id, slug, CASE WHEN slug LIKE '%code%' THEN upper(code || '_new') ELSE code END AS code, CASE WHEN slug LIKE '%code%' THEN 'statute' ELSE type END AS type, issuer, jurisdiction, CASE WHEN slug LIKE '%code%' THEN coalesce(language_primary, 'unknown') ELSE language_primary END AS language_primary, created_at, CASE WHEN slug LIKE '%code%' THEN TIMESTAMPTZ '2026-01-01 00:00:00+00' ELSE updated_at END AS updated_at FROM sources UNION ALL SELECT 'y', 'new_slug', 'NEW_SLUG', 'regulation', 'Unknown', 'SA', 'unknown', min(created_at), max(updated_at) FROM sources",
    "corpus_counts": " UNION ALL ".join(f"SELECT '{t}' AS table_name, CAST(count(*) AS INTEGER) AS n FROM {t}" for t in ("sources", "law_documents", "articles", "article_chunks")),
    "articles_per_document": f"WITH {_A} SELECT document_id, count(*) AS n FROM a GROUP BY 1",
    "expected_articles": f"WITH {_A}, n AS (SELECT document_id, count(*) AS delivered FROM a GROUP BY 1) SELECT l.id AS document_id, metadata.article_count AS stated, coalesce(delivered, 0) AS delivered, CAST(sum(coalesce(delivered, 0)) OVER (PARTITION BY source_id ORDER BY created_at, l.id) AS BIGINT) AS running FROM law_documents l LEFT JOIN n ON n.document_id = l.id",
    "content_types": "SELECT CASE WHEN coalesce(source_url, 'unknown') LIKE '%.pdf' THEN 'application/pdf' ELSE 'text/html' END AS content_type, count(*) AS n FROM law_documents GROUP BY 1",
    "version_pairs": "WITH r AS (SELECT DISTINCT id, document_id, article_number, article_number[4:] AS n FROM articles) SELECT a.document_id, a.n AS number, a.id AS ar_id, b.id AS en_id FROM r a JOIN r b ON a.document_id = b.document_id AND a.article_number = 'ar_' || a.n AND b.article_number = 'en_' || a.n",
    "source_lookup": "SELECT id, slug, code FROM sources WHERE slug LIKE 'wage%' AND code != 'WAGE_RULES_2' ORDER BY code",
    "json_first": "SELECT DISTINCT ON (id) id, expected_citations[1] AS first_citation, CAST(len(coalesce(expected_citations, [])) AS INTEGER) AS n FROM eval_questions",
    "event_properties": "SELECT event_type, count(CAST(json_extract_string(props, '$.k') AS INTEGER)) AS n, CAST(sum(CAST(json_extract_string(props, '$.k') AS INTEGER)) AS BIGINT) AS total FROM events GROUP BY 1",
    "term_frequencies": f"WITH {_A} SELECT term, count(*) AS articles FROM (SELECT unnest(list_distinct(regexp_extract_all(lower(coalesce(text_ar_normalized, '')), '[\\p{{L}}\\p{{N}}]+'))) AS term FROM a) GROUP BY 1",
    "script_routing": "SELECT lang, coalesce(regexp_matches(text, '[\\x{600}-\\x{6FF}]'), false) OR coalesce(lang = 'ar', false) AS arabic, count(*) AS n FROM documents GROUP BY 1, 2",
    "stub_embeddings": "SELECT id, round(list_sum(list_transform(range(0, 1024), lambda j: sin(ordering * 97 + j) * 0.01)), 6) AS total FROM (SELECT DISTINCT id, ordering FROM articles)",
    "fuzzy_parts": "WITH g AS (SELECT p_partkey, p_name, list_distinct(list_transform(range(1, length('  ' || p_name || ' ') - 1), lambda i: substr('  ' || lower(p_name) || ' ', i, 3))) AS t, list_distinct(list_transform(range(1, 12), lambda i: substr('  small ring ', i, 3))) AS q FROM part) SELECT p_partkey, p_name, round(len(list_intersect(t, q)) / len(list_distinct(list_concat(t, q))), 6) AS similarity FROM g WHERE round(len(list_intersect(t, q)) / len(list_distinct(list_concat(t, q))), 6) >= 0.3",
    "fresh_questions": f"WITH {_A}, {_LATEST}, old AS (SELECT id FROM a WHERE document_id NOT IN (SELECT document_id FROM lt)), q AS (SELECT DISTINCT ON (id) * FROM eval_questions) SELECT id, domain FROM q WHERE expected_citations[1] IS NULL OR expected_citations[1] NOT IN (SELECT id FROM old)",
    "replaced_articles": f"WITH {_A}, {_LATEST} SELECT id, document_id, CASE WHEN document_id IN (SELECT document_id FROM lt) THEN upper(article_number) ELSE article_number END AS article_number FROM a",
    "latest_queries": "SELECT tenant_id, arg_max(id, (created_at, id)) AS id, arg_max(query_hash, (created_at, id)) AS query_hash FROM query_audit_log WHERE tenant_id IS NOT NULL GROUP BY 1",
    "cloned_sources": "SELECT 'clone_' || i || '_' || slug AS slug, type FROM sources, range(0, 3) AS r(i)",
    "failing_questions": f"{_SCORES} SELECT question_id, domain FROM sc WHERE recall = 0",
    "spread_articles": f"WITH r AS (SELECT DISTINCT id, document_id, ordering FROM articles), {_spread('r', 'document_id', 'ordering, id')} SELECT document_id, id FROM picked",
    "decorated_search": f"{_FUSED}, b AS (SELECT *, row_number() OVER (PARTITION BY article_id ORDER BY score DESC, id) AS n FROM f), z AS (SELECT id, article_id, score FROM b WHERE n = 1 ORDER BY score DESC, id LIMIT {R.TOP}) SELECT z.id, a.article_number, s.code AS source_code, md5(k.chunk_text) AS text_md5, z.score FROM z JOIN article_chunks k ON k.id = z.id JOIN a ON a.id = z.article_id JOIN law_documents l ON l.id = a.document_id JOIN sources s ON s.id = l.source_id",
    "audited_search": f"{_FUSED}, b AS (SELECT *, row_number() OVER (PARTITION BY article_id ORDER BY score DESC, id) AS n FROM f), z AS (SELECT id, score FROM b WHERE n = 1 ORDER BY score DESC, id LIMIT {R.TOP}), g AS (SELECT list(id ORDER BY score DESC, id) AS ids FROM z) SELECT '00000000-0000-0000-0000-000000000001' AS tenant_id, sha256('{' '.join(TERMS)}') AS query_hash, sha256(CAST(to_json(ids) AS VARCHAR)) AS response_hash, array_to_string(ids, ',') AS ids, 5 AS latency_ms FROM g",
    "response_hashes": f"WITH {_LOG} SELECT id, sha256(CAST(to_json(coalesce(retrieved_chunk_ids, [])) AS VARCHAR)) AS response_hash FROM g",
    "leading_articles": "WITH r AS (SELECT DISTINCT a.id, l.source_id, a.ordering FROM articles a JOIN law_documents l ON l.id = a.document_id WHERE superseded_by IS NULL) SELECT source_id, id FROM r QUALIFY row_number() OVER (PARTITION BY source_id ORDER BY ordering, id) <= 3",
    "first_picks": "WITH r AS (SELECT DISTINCT id, document_id, ordering FROM articles), p AS (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY ordering, id) - 1 AS pos, count(*) OVER (PARTITION BY document_id) AS n FROM r) SELECT document_id, id FROM p WHERE pos IN (0, greatest(1, n // least(3, n)), 2 * greatest(1, n // least(3, n)))",
    "first_with_content": f"WITH w AS (SELECT id, document_id, ordering, length(text_ar) AS size, array_to_string({_words('text_ar')}[1:15], ' ') AS q FROM articles WHERE document_id IS NOT NULL) SELECT document_id, arg_min(id, (ordering, id)) AS article_id, md5(arg_min(q, (ordering, id))) AS question_md5 FROM w WHERE size >= 20 AND length(q) > 20 GROUP BY 1",
    "questions_by_version": "SELECT DISTINCT id, domain FROM eval_questions WHERE version = 'v1'",
    "unseeded_questions": "SELECT DISTINCT id, version, domain FROM eval_questions q WHERE NOT EXISTS (SELECT 1 FROM eval_questions h WHERE h.version = 'v1' AND q.version = 'v2' AND q.domain = h.domain)",
    "cascade_kept": "WITH g AS (SELECT id FROM sources WHERE starts_with(slug, 'wage_')), d AS (SELECT id FROM law_documents WHERE source_id IN (SELECT id FROM g)), r AS (SELECT id FROM articles WHERE document_id IN (SELECT id FROM d)) SELECT DISTINCT * FROM (SELECT 'sources' AS table_name, id FROM sources WHERE id NOT IN (SELECT id FROM g) UNION ALL SELECT 'law_documents', id FROM law_documents WHERE id NOT IN (SELECT id FROM d) UNION ALL SELECT 'articles', id FROM articles WHERE id NOT IN (SELECT id FROM r) UNION ALL SELECT 'article_chunks', id FROM article_chunks WHERE article_id IS NULL OR article_id NOT IN (SELECT id FROM r))",
    "held_versions": "WITH f AS (SELECT DISTINCT source_id, source_hash FROM law_documents WHERE source_hash IS NOT NULL) SELECT l.id AS document_id, count(*) AS files FROM law_documents l JOIN f ON f.source_id = l.source_id AND f.source_hash = l.source_hash GROUP BY 1",
    "first_of_versions": f"WITH {_CHAIN}, f AS (SELECT document_id, arg_min(id, (ordering, id)) AS first_article_id FROM articles WHERE document_id IS NOT NULL GROUP BY 1) SELECT ch.document_id, ch.source_id, CAST(version_order AS INTEGER) AS version_order, l.superseded_by IS NULL AS is_latest, first_article_id FROM ch JOIN law_documents l ON l.id = ch.document_id LEFT JOIN f ON f.document_id = ch.document_id",
    "new_questions": "WITH q AS (SELECT DISTINCT version, domain, question_ar, question_en, coalesce(expected_citations, []) AS e, coalesce(accepted_answer_ranges, []), attorney_rubric, graded_by FROM eval_questions) SELECT domain, count(DISTINCT struct_pack(a := version, b := question_ar, c := question_en)) AS n, CAST(sum(len(e)) AS BIGINT) AS citations FROM q GROUP BY 1",
    "manifest_times": "SELECT id, CAST(CAST(metadata.fetched_at AS TIMESTAMPTZ) AS DATE) AS fetched_on FROM law_documents WHERE metadata.fetched_at IS NOT NULL",
    "split_articles": f"WITH {_A}, p AS (SELECT id, regexp_matches(text_ar, '{_HEADER}') AS h, text_ar, string_split(regexp_replace(text_ar, '({_HEADER})', chr(1) || '\\1', 'g'), chr(1)) AS p FROM a WHERE text_ar <> ''), n AS (SELECT id, CASE WHEN h THEN list_filter(list_transform(p, lambda x: struct_pack(number := coalesce(TRY_CAST(regexp_extract(x, '^{_HEADER}', 1) AS INTEGER), 0), body := {_squeeze('x')})), lambda s: s.number > 0 OR s.body <> '') ELSE [struct_pack(number := 1, body := {_squeeze('text_ar')})] END AS l FROM p) SELECT id, CAST(i - 1 AS INTEGER) AS at, l[i].number AS number, md5(l[i].body) AS body_md5 FROM n, unnest(range(1, len(l) + 1)) AS u(i)",
    "corruption_scan": f"WITH {_A}, t AS (SELECT id, replace(replace(replace(text_ar, 'ية ', 'يةةةة '), ' من', ' xمن'), '.', '.' || chr(7)) AS t FROM a), c AS (SELECT id, len(regexp_extract_all(t, '{_RUNS}')) AS repeated_letters, len(list_filter({_words('t')}, lambda w: regexp_matches(w, '^[A-Za-z]+[\\x{{600}}-\\x{{6FF}}]|[\\x{{600}}-\\x{{6FF}}][A-Za-z]+($|[\\x{{600}}-\\x{{6FF}}])'))) AS glued_latin, len(regexp_extract_all(t, '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\x7F]')) AS controls, least(5, len(regexp_extract_all(t, '(?s).{{0,15}}({_RUNS}).{{0,15}}'))) AS samples FROM t) SELECT id, CAST(repeated_letters AS INTEGER) AS repeated_letters, CAST(glued_latin AS INTEGER) AS glued_latin, CAST(controls AS INTEGER) AS controls, CAST(samples AS INTEGER) AS samples FROM c WHERE repeated_letters + glued_latin + controls > 0",
}
