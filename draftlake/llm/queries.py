"""The numbered queries: given tables mapped to the operators' records, and results mapped back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from draftlake.llm import (block_names, byte_index, decontaminate, hard_negatives, html_runs, longest_previous, packing, pairwise_quality,
                           periodic_runs, pseudo_likelihood, sentence_spans, token_files, weighted_minhash)

QUERIES, ORACLES = {}, {}
FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def query(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return wrap


def transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as transcripts: doc_id is the contest, text the transcript."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").alias("contest_id"),
                                                                    F.col("text").alias("transcript"))


def tokenizer_file() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def items_digest() -> F.Column:
    """Lowercase hex SHA-256 of the sorted item ids, comma-joined."""
    return F.sha2(F.array_join(F.array_sort("items"), ","), 256)


@query("op1_html_runs")
def op1(spark, d):
    return html_runs.extract_main_text(spark.read.parquet(f"{d}/pages.parquet"))


@query("op2_token_files")
def op2(spark, d):
    path = token_files.write_token_files(transcripts(spark, d), tokenizer_file(), end_id=2)
    return token_files.read_token_files(spark, path).withColumnRenamed("contest_id", "doc_id")


@query("op3_benchmark_hits", f"""
WITH d AS (SELECT doc_id, regexp_extract_all({FOLDED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (SELECT item_id::VARCHAR AS item_id, regexp_extract_all({FOLDED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
g AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, w[i:i + least(len(w), 10) - 1] AS gram
      FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
x AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d),
p AS (SELECT x.doc_id, x.i, s.n, x.w[x.i:x.i + s.n - 1] AS gram FROM x, (SELECT DISTINCT n FROM g) s WHERE x.i + s.n - 1 <= len(x.w)),
h AS (SELECT p.doc_id, p.i, p.n, g.item_id FROM p JOIN g USING (n, gram)),
k AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
      FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(k.n_hit, 0)::BIGINT AS n_hit, coalesce(t.n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(t.ids, '')) AS items_sha256, coalesce(k.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN k USING (doc_id) LEFT JOIN t USING (doc_id)""")
def op3(spark, d):
    items = spark.read.parquet(f"{d}/benchmark.parquet").select(F.col("item_id").alias("ability_key"), F.col("text").alias("description"))
    hits = decontaminate.benchmark_hits(transcripts(spark, d), items)
    return hits.select(F.col("contest_id").alias("doc_id"), "n_words", decontaminate.hit_words().alias("n_hit"),
                       F.size("items").cast("long").alias("n_items"), items_digest().alias("items_sha256"),
                       (F.size("spans") > 0).alias("contaminated"))


@query("op4_pseudo_likelihood")
def op4(spark, d):
    return pseudo_likelihood.pseudo_likelihood(transcripts(spark, d)).withColumnRenamed("contest_id", "doc_id")


@query("op5_pack")
def op5(spark, d):
    return packing.pack_transcripts(transcripts(spark, d), tokenizer_file(), end_id=0).withColumnRenamed("contest_id", "doc_id")


@query("op6_longest_previous")
def op6(spark, d):
    return longest_previous.remove_copies(transcripts(spark, d)).drop("kept").withColumnRenamed("contest_id", "doc_id")


def held_out(doc_id: str = "doc_id") -> F.Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1


def quality_labels(spark, d) -> DataFrame:
    labels = spark.read.parquet(f"{d}/labels.parquet").where(~held_out())
    return labels.select(F.col("doc_id").alias("contest_id"), F.col("quality").alias("usable"))


@query("op7_pairwise_quality")
def op7(spark, d):
    t = transcripts(spark, d)
    scored = pairwise_quality.score_quality(t, pairwise_quality.fit_quality(t, quality_labels(spark, d)))
    return scored.select(F.col("contest_id").alias("doc_id"), held_out("contest_id").alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op8_sentence_spans")
def op8(spark, d):
    return sentence_spans.remove_repeats(transcripts(spark, d)).drop("kept").withColumnRenamed("contest_id", "doc_id")


@query("op9_weighted_minhash")
def op9(spark, d):
    rows = weighted_minhash.near_copies(transcripts(spark, d)).drop("row_key")
    return rows.withColumnRenamed("contest_id", "doc_id")


@query("op10_block_names", f"""
WITH d AS (SELECT doc_id, {FOLDED} AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256 FROM d""")
def op10(spark, d):
    return block_names.exact_copies(transcripts(spark, d)).drop("row_key").withColumnRenamed("contest_id", "doc_id")


@query("op11_byte_index")
def op11(spark, d):
    return byte_index.near_copies(transcripts(spark, d)).withColumnRenamed("contest_id", "doc_id")


def planted_period() -> F.Column:
    """The transcript, for a tenth of the contests with a word of it repeated in cycles from place a on, as the contract says."""
    h = F.crc32(F.col("contest_id").cast("string").cast("binary"))
    words = F.filter(F.split("transcript", "[ \\t-\\r]+"), lambda w: w != "")
    n, g = F.greatest(F.size(words), F.lit(1)), F.floor(h / 10)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    cycle = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    return F.when((h % 10 == 0) & (F.size(words) > 0), F.array_join(F.concat(F.slice(words, F.lit(1), a), F.slice(cycle, F.lit(1), n - a)), " ")).otherwise(F.col("transcript"))


@query("op12_periodic_runs")
def op12(spark, d):
    found = periodic_runs.periodic_runs(transcripts(spark, d).withColumn("transcript", planted_period()))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    best = periodic_runs.longest_run()
    return found.select(
        F.col("contest_id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"),
        best["period"].alias("period"), F.floor(1000 * best["length"] / best["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


@query("op13_hard_negatives", """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
           FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, list_inner_product(a.x, b.x)::BIGINT AS s
      FROM v a, v b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT a, b, s FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY s DESC, b) <= 5)
SELECT p.a AS anchor_id, p.b AS positive_id, (row_number() OVER w)::INTEGER AS rank, s.b AS negative_id, p.s AS positive_score, s.s AS negative_score
FROM p JOIN s ON s.a = p.a AND NOT s.same AND 30 * p.s <= 100 * s.s AND 100 * s.s <= 90 * p.s
WINDOW w AS (PARTITION BY p.a, p.b ORDER BY s.s DESC, s.b) QUALIFY row_number() OVER w <= 10""")
def op13(spark, d):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = spark.read.parquet(f"{d}/embeddings.parquet").select(
        F.col("vec_id").alias("candidate_id"), F.col("embedding").alias("features"), label.alias("label"), (F.col("vec_id") % 100 == 0).alias("is_anchor"))
    return hard_negatives.mine_hard_negatives(vectors)


def all_queries() -> dict:
    """The numbered queries, and the pipeline as one query."""
    import corpus_pipeline
    return {**QUERIES, "pipeline": corpus_pipeline.run}


def all_oracles() -> dict:
    import corpus_pipeline
    return {**ORACLES, **({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})}
