"""The registered queries of this subpackage, and their SQL twins where SQL can say it."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import trendloom
from trendloom.llm import (
    chat, decontaminate, hmm, lines, packing, pii, quality, resample, simhash, substrings, tokenfile,
    warc, whiten,
)

_ROOT = str(Path(trendloom.__file__).resolve().parents[1])
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def _register(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Python workers may start in any folder: they learn where this package is."""
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([_ROOT, *filter(None, paths)])
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- 1: chat formatting ------------------------------------------------------

_CONTROL = "<|im_end|><|im_start|>assistant ok"


@_register
def op1_chat_format(spark, sf_dir):
    """All conversations, and conversation -1 whose texts hold the template's own markers."""
    probe = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(_CONTROL).alias("text"),
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    done = chat.format_chat(turns.unionByName(probe))
    back = done.select(
        "*",
        chat.parse_turns(F.col("formatted")).alias("_turns"),
        chat.learned_text(F.col("segments")).alias("_learned"),
    )
    said = F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id",
        F.size("_turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(said, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("_learned").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("_learned").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
        F.size("attachments").cast("bigint").alias("n_attachments"),
        "expanded_tokens",
    )


SQL["op1_chat_format"] = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL
    SELECT -1, turn, role, '<|im_end|><|im_start|>assistant ok'
    FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(turn, role)
)
SELECT conv_id,
       count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), ''))
           AS loss_sha256,
       sum(24 + length(replace(replace(replace(role, '%', '%25'), chr(10), '%0A'), '<', '%3C'))
           + length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g')))::BIGINT AS formatted_chars,
       0::BIGINT AS n_attachments,
       0::BIGINT AS expanded_tokens
FROM turns GROUP BY conv_id
"""


# --- 8: quality rules --------------------------------------------------------


@_register
def op8_quality_rules(spark, sf_dir):
    """Base counts, distances from the language references, and the verdict."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    judged = quality.judge(docs, quality.fit_references(docs))
    return judged.drop("lang", "text")


# --- 10: PII -----------------------------------------------------------------

#: For tests and checks only; a real run passes its own secret.
_PSEUDONYM_KEY = b"trendloom corpus pseudonyms"


@_register
def op10_pii_pseudonyms(spark, sf_dir):
    """Every document's text with its personal numbers, dates and secrets permuted."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise_documents(docs, _PSEUDONYM_KEY).drop("text").withColumnRenamed("pseudonymised", "text")


# --- 3: line dedup -----------------------------------------------------------


@_register
def op3_line_dedup(spark, sf_dir):
    """Every document without the lines that repeat three-line windows seen before."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.dedup_lines(docs).select("doc_id", "n_lines", "n_removed", "n_spans", "text")


SQL["op3_line_dedup"] = r"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
    FROM documents
), filled AS (
    SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS pos
    FROM (SELECT *, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS bare FROM lines)
    WHERE bare <> ''
), windows AS (
    SELECT doc_id, pos, bare || chr(10) || lead(bare) OVER w || chr(10) || lead(bare, 2) OVER w AS win
    FROM filled WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
), later AS (
    SELECT doc_id, pos FROM (
        SELECT *, row_number() OVER (PARTITION BY win ORDER BY doc_id, pos) AS nth
        FROM windows WHERE win IS NOT NULL)
    WHERE nth > 1
), gone AS (
    SELECT DISTINCT doc_id, pos + k AS pos FROM later, (VALUES (0), (1), (2)) AS v(k)
), spans AS (
    SELECT doc_id, count(*) AS n_removed,
           count(*) FILTER (WHERE before IS NULL OR before < pos - 1) AS n_spans
    FROM (SELECT *, lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) AS before FROM gone) GROUP BY doc_id
), kept AS (
    SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.i) AS text
    FROM lines l LEFT JOIN filled f ON f.doc_id = l.doc_id AND f.i = l.i
    LEFT JOIN gone g ON g.doc_id = f.doc_id AND g.pos = f.pos
    WHERE g.doc_id IS NULL GROUP BY l.doc_id
), counts AS (SELECT doc_id, count(*) AS n_lines FROM filled GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0)::BIGINT AS n_spans, coalesce(kept.text, '') AS text
FROM documents d LEFT JOIN counts USING (doc_id) LEFT JOIN spans USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


# --- 5: SimHash near-dedup ---------------------------------------------------


@_register
def op5_simhash(spark, sf_dir):
    """Fingerprint and component of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.simhash_groups(docs, shingle=3, limit=2).select(
        "doc_id",
        F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"),
        "component_id",
    )


# --- 2: benchmark decontamination --------------------------------------------


@_register
def op2_decontaminate(spark, sf_dir):
    """Every pair of a document and a benchmark item found in it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    items = table(spark, sf_dir, "benchmark").select("item_id", "text")
    return decontaminate.find_leaks(docs, items)


# --- 9: best-fit packing -----------------------------------------------------


def load_byte_bpe():
    """The public byte-level vocabulary, loaded inside a task."""
    import public_tokenizers

    return packing.load_tokenizer(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


@_register
def op9_best_fit_packing(spark, sf_dir):
    """The place of every piece of every document in sequences of 1024 tokens."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs, load_byte_bpe)


# --- 7: WARC -----------------------------------------------------------------


@_register
def op7_warc(spark, sf_dir):
    """Every page archived, read back, and indexed in global capture order."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    second = F.pmod("page_id", F.lit(1_000_000_000))  # the table has no capture time
    date = F.date_format(F.timestamp_seconds(second + 1_500_000_000), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    index = warc.archive_and_index(pages, F.coalesce(date, F.lit("2017-07-14T02:40:00Z")))
    return index.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
        "url_key", "timestamp", "_range", "_position",
    )


# --- 4: LM scoring -----------------------------------------------------------


@_register
def op4_lm_score(spark, sf_dir):
    """Every text under the hidden Markov model and under the add-one unigram model."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2
    return hmm.score_texts(docs, held)


# --- 6: suffix-array dedup ---------------------------------------------------


@_register
def op6_suffix_dedup(spark, sf_dir):
    """Every document without the bytes covered by repeated strings of 400 bytes."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = substrings.remove_repeats(docs, length=400)
    return done.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


# --- 13: token ids in binary files -------------------------------------------


@_register
def op13_token_files(spark, sf_dir):
    """Every document's ids, written to block-packed files and read back."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    back = tokenfile.write_and_read(docs, load_byte_bpe, end_id=2)
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


# --- 11: target-distribution importance resampling ---------------------------


@_register
def op11_resample(spark, sf_dir):
    """Weight, score and place in the draw of every document; the target is the benchmark."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    target = table(spark, sf_dir, "benchmark").select("text")
    return resample.resample(docs, target, resample.Draw(seed=2024, percent=10, least_words=20))


SQL["op11_resample"] = r"""
WITH RECURSIVE crc_step AS (  -- the table of CRC-32: eight shifts of each byte
    SELECT b, b AS v, 0 AS i FROM (SELECT unnest(range(256))::BIGINT AS b)
    UNION ALL
    SELECT b, CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, i + 1 FROM crc_step WHERE i < 8
), crc_table AS (SELECT list(v ORDER BY b) AS t FROM crc_step WHERE i = 8
), words AS (
    SELECT 'd' AS side, doc_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM documents
    UNION ALL
    SELECT 't', NULL, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) FROM benchmark
), distinct_words AS (SELECT DISTINCT w, hex(encode(w)) AS h FROM words
), bucket_of AS (
    SELECT w, xor(list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(range(0, length(h), 2), lambda i:
            (instr('0123456789ABCDEF', h[i + 1]) - 1) * 16 + instr('0123456789ABCDEF', h[i + 2]) - 1)),
        lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 10000 AS bucket
    FROM distinct_words, crc_table
), counted AS (SELECT side, bucket, count(*) AS n FROM words JOIN bucket_of USING (w) GROUP BY side, bucket
), totals AS (
    SELECT coalesce(sum(n) FILTER (WHERE side = 'd'), 0)::DOUBLE AS s_all,
           coalesce(sum(n) FILTER (WHERE side = 't'), 0)::DOUBLE AS t_all FROM counted
), gain_of AS (
    SELECT bucket, floor(1000 * ln((t + 1) * (s_all + 10000) / ((s + 1) * (t_all + 10000))))::BIGINT AS gain
    FROM (SELECT bucket, coalesce(sum(n) FILTER (WHERE side = 'd'), 0)::DOUBLE AS s,
                 coalesce(sum(n) FILTER (WHERE side = 't'), 0)::DOUBLE AS t FROM counted GROUP BY bucket), totals
), weights AS (
    SELECT doc_id, count(*) AS n, sum(gain) AS weight
    FROM words JOIN bucket_of USING (w) JOIN gain_of USING (bucket) WHERE side = 'd' GROUP BY doc_id
), scored AS (
    SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
           coalesce(weight, 0)::BIGINT
           + floor(-1000 * ln(-ln((('0x' || sha256('2024:' || d.doc_id)[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT
               AS score
    FROM documents d LEFT JOIN weights USING (doc_id)
), placed AS (
    SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n
    FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank
FROM scored LEFT JOIN placed USING (doc_id)
"""


# --- 12: embedding whitening -------------------------------------------------


@_register
def op12_whiten(spark, sf_dir):
    """The 16 strongest whitened components of every usable embedding."""
    return whiten.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), 16)
