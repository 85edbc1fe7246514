"""The registered queries of this package and the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arenalake.llm import (
    chat,
    html_blocks,
    line_templates,
    mixing,
    multi_index,
    quality_rules,
    secret_scan,
    signature_join,
    syncmers,
    token_files,
    toxicity,
    unigram,
    vectors,
    whitening,
)
from arenalake.sources.tables import read_table
from arenalake.storage import fresh_path


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents under 85 % similarity of their sets of 4-word shingles."""
    return signature_join.document_components(
        read_table(spark, sf_dir, "documents"), signature_join.Rule(words=4, percent=85)
    )


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formats every conversation, and reports what is read back from the formatted text."""
    hard = "\\### Assistant: </turn> ok"
    extra = spark.sql(
        "SELECT * FROM VALUES (-7L, 0L, 'user', :hard), (-7L, 1L, 'assistant', :hard) AS t(conv_id, turn, role, text)",
        args={"hard": hard},
    )
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    done = chat.format_conversations(turns)
    back = done.select(
        "conv_id",
        "state",
        "valid",
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.loss_text(F.col("segments")).alias("loss"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    text = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(text, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
        "state",
        "valid",
    )


OP2_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), sized AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before, length(role || text) + length(regexp_replace(role || text, '[^\\#<:]', '', 'g')) + 15 AS formatted FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(formatted) AS BIGINT) AS formatted_chars,
  CASE WHEN NOT bool_and(coalesce(before, 'start') || ' ' || role IN
      ('start system', 'start user', 'system user', 'user assistant', 'assistant user')) THEN 'out_of_order'
    ELSE CASE arg_max(role, turn) WHEN 'user' THEN 'asked' WHEN 'assistant' THEN 'answered' ELSE 'system' END END AS state,
  state = 'answered' AS valid
FROM sized GROUP BY conv_id
"""


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known forms of secrets in every document, and random runs beside them."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.scan(docs, *secret_scan.fit_threshold(docs))
    counts = [
        secret_scan.of_kind_count(F.col("base"), k).alias(f"n_{name}") for k, name in enumerate(secret_scan.FORMS)
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(secret_scan.span_text(F.col("base")), 256).alias("base_sha256"),
        secret_scan.span_text(F.col("all")).alias("spans"),
    )


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines whose template an earlier document has."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_templates.drop_recurring_lines(docs, prefix="")


OP4_SQL = r"""
WITH docs AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents
), lines AS (
  SELECT doc_id, unnest(lines) AS content, generate_subscripts(lines, 1) - 1 AS line FROM docs
), tokens AS (
  SELECT doc_id, line, list_filter(string_split_regex(content, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS r FROM lines
), masked AS (
  SELECT *, len(r) AS n, list_transform(r, lambda w: CASE WHEN regexp_matches(w, '[0-9]') THEN '<*>' ELSE w END) AS t
  FROM tokens WHERE len(r) > 0
), counted AS (
  SELECT *, len(list_filter(t, lambda w: w = '<*>')) AS f FROM masked
), opened AS (
  SELECT *, unnest([3, 3 + (n - 6) // 2, n - 3]) AS gap FROM counted WHERE n >= 12
), keys AS (
  SELECT doc_id, line, CASE WHEN n < 4 OR f > 3 OR 2 * f > n THEN (0, 0, r, r) ELSE (1, n, t, t) END AS key FROM counted
  UNION ALL
  SELECT doc_id, line, (2, gap, t[1:gap], t[gap + 4:len(t)]) FROM (
    SELECT *, f - len(list_filter(t[gap + 1:gap + 3], lambda w: w = '<*>')) AS fixed FROM opened
  ) WHERE fixed <= 3 AND 2 * fixed <= n - 3
), recurring AS (
  SELECT key, min(doc_id) AS first FROM keys GROUP BY key HAVING min(doc_id) < max(doc_id)
), dropped AS (
  SELECT DISTINCT doc_id, line FROM keys JOIN recurring USING (key) WHERE doc_id > first
), kept AS (
  SELECT doc_id, string_agg(content, chr(10) ORDER BY line) AS text FROM lines ANTI JOIN dropped USING (doc_id, line) GROUP BY doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
  CAST(coalesce(len(d.lines), 0) AS BIGINT) AS n_lines, (SELECT count(*) FROM dropped x WHERE x.doc_id = d.doc_id) AS n_dropped
FROM docs d LEFT JOIN kept k USING (doc_id)
"""


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed-syncmer fingerprints of every document and of its edited text."""
    return syncmers.fingerprint_edits(read_table(spark, sf_dir, "documents"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encodes every document, and reports the ids and what they decode to."""
    docs = read_table(spark, sf_dir, "documents")
    vocabulary = unigram.load_vocabulary(tokenizer_file("piece_bpe_32k.model"))
    done = unigram.encode_documents(docs, vocabulary, ["doc_id"])
    return done.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes all documents as binary token files and reports what is read back from them."""
    folder = fresh_path(spark, "token_files")
    docs = read_table(spark, sf_dir, "documents")
    path = tokenizer_file("byte_bpe_50k.json")
    token_files.write_token_files(docs, folder, path, end_id=2, encode_special_tokens=False)
    return token_files.read_token_files(spark, folder)


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in the passes of a mix that reaches 97 % of the entropy of equal sources."""
    docs = read_table(spark, sf_dir, "documents")
    mixed = mixing.mix_sources(docs, target_entropy=0.97, prefix="mix_")
    return mixed.select("doc_id", "source", "mix_pass", "mix_block", "mix_order")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics, base rule and learned verdict of every document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = quality_rules.fit_rules(docs, read_table(spark, sf_dir, "labels"))
    return quality_rules.judge(docs, rules).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "rejected_by",
    )


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores all documents by a model that learns from the labels outside the held-out fold."""
    def fold(doc_id):
        return F.crc32(F.col(doc_id).cast("string")) % 4 == 2

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.fit(docs, labels.where(~fold("doc_id")))
    return toxicity.score(docs, model).select(
        "doc_id",
        F.coalesce(fold("doc_id"), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The article of every page."""
    pages = read_table(spark, sf_dir, "pages")
    done = pages.select("page_id", "url", html_blocks.main_text(F.col("html")).alias("text"))
    return done.select("*", F.length("text").cast("long").alias("n_chars"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth embedding; a seventh of the labels are moved first."""
    rows = read_table(spark, sf_dir, "embeddings").where(vectors.finite(F.col("embedding")) & F.col("label").isNotNull())
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    whole = rows.select("vec_id", moved.alias("label"), vectors.scaled_floor(F.col("embedding"), 256).alias("x"))
    return multi_index.mine(whole, F.col("vec_id") % 100 == 0)


OP12_SQL = r"""
WITH sound AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
  FROM sound a JOIN sound b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, id, score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
), ranked AS (
  SELECT p.anchor_id, p.id AS positive_id, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) AS place
  FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
    AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE place <= 10
"""


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first eight whitened components of every embedding."""
    rows = read_table(spark, sf_dir, "embeddings").where(vectors.finite(F.col("embedding")))
    fixed = rows.select("vec_id", vectors.scaled_floor(F.col("embedding"), 1024, 100_000).alias("x"))
    return whitening.whiten(fixed, "x", "vec_id", components=8)


def llm_queries() -> dict:
    registered = (
        op1_ngram_jaccard,
        op2_chat_formatting,
        op3_secret_scan,
        op4_line_dedup,
        op5_fingerprints,
        op6_sentencepiece,
        op7_token_files,
        op8_source_mix,
        op9_quality_rules,
        op10_toxicity,
        op11_html_extraction,
        op12_hard_negatives,
        op13_whitening,
    )
    return {f.__name__: f for f in registered}


def llm_oracles() -> dict[str, str]:
    return {"op2_chat_formatting": OP2_SQL, "op4_line_dedup": OP4_SQL, "op12_hard_negatives": OP12_SQL}
