"""The training-data operators over the test tables: name -> (spark, sf_dir) -> DataFrame, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    ball_kmeans,
    chat,
    hamming_search,
    licenses,
    mixing,
    ngram_lm,
    packing,
    quality,
    rotated_codes,
    simhash,
    token_files,
    warc,
    whitening,
)
from ..sources.shared import materialize, shared_path

#: The conversation that op6 adds to the table.
MARKED = "</s>[INST] ok [/INST]"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base figures and the line-frequency verdict of every document."""
    figures = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return quality.judge(read(spark, sf_dir, "documents")).select("doc_id", *figures, "lines_removed", "words_left")


def op2_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives, read back and assembled into captures."""
    path = shared_path(spark, "archives")
    warc.write_archives(read(spark, sf_dir, "pages"), path)
    return warc.page_digests(warc.assemble(warc.read_records(spark, path)))


def op3_simhash_bk_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def op4_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest embeddings, by the Hamming distance of their signs, of each whose id divides by 100."""
    rows = read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    found = hamming_search.top_k(rows, rows.where(F.col("id") % 100 == 0))
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "distance")


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and taken words of every document in the mix."""
    return mixing.plan(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every formatted conversation, read back from the output."""
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marked = [(-1, 0, "user", MARKED), (-1, 1, "assistant", MARKED)]
    added = spark.createDataFrame(marked, "conv_id long, turn long, role string, text string")
    out = chat.format_conversations(rows.unionByName(added))
    turns = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    read_back = out.select(
        "conv_id",
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.masked_text(F.col("formatted"), F.col("loss_spans")).alias("loss"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    return read_back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op7_ngram_trie_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model score of every document."""
    return ngram_lm.score_documents(read(spark, sf_dir, "documents"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases, labels and score of every document."""
    return licenses.scan_licenses(read(spark, sf_dir, "documents"))


def digests(pieces: DataFrame) -> DataFrame:
    """Packed pieces with length and CRC instead of their ids."""
    return pieces.select(
        "doc_id",
        "start",
        F.shiftright(F.octet_length("ids"), 2).cast("long").alias("length"),
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def op9_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document in its sequence."""
    return digests(packing.pack(read(spark, sf_dir, "documents")))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, counted by separator scan in flat token files."""
    return token_files.token_counts(read(spark, sf_dir, "documents")).select("doc_id", "n_tokens")


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding on up to 32 whitened components, and how near their covariance is to the identity."""
    whitened, fitted = whitening.whiten(read(spark, sf_dir, "embeddings"))
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if fitted is None:
        return spark.createDataFrame([], schema)
    rows = materialize(whitened, "whitened")
    error = whitening.identity_error(rows, len(fitted.eigenvalues))
    each = rows.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return each.select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(fitted.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(F.array(*[F.lit(x) for x in fitted.explained]), F.col("place")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def op12_rotated_code_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty embeddings found nearest, by inner product, to each whose id divides by 20."""
    return rotated_codes.nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op13_ball_kmeans_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes and errors of every embedding under codebooks trained on all of them."""
    coded, books = ball_kmeans.compress(read(spark, sf_dir, "embeddings"))
    return ball_kmeans.with_label_errors(coded).select(
        "vec_id",
        F.lower(F.hex("code")).alias("code"),
        "error",
        "label_error",
        F.lit(ball_kmeans.digest(books)).alias("codebooks_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_warc_transactions,
        op3_simhash_bk_tree,
        op4_multi_index_hashing,
        op5_mix_sources,
        op6_chat_format,
        op7_ngram_trie_scores,
        op8_license_scan,
        op9_pack_sequences,
        op10_token_counts,
        op11_embedding_whitening,
        op12_rotated_code_search,
        op13_ball_kmeans_codes,
    )
}

_WORD = r"[^\x20\x09-\x0D]+"

_OP1 = rf"""
WITH w AS (
  SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS words FROM documents
), windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i], words[i + 1], words[i + 2]) AS n
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)
), repeated AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM windows WHERE n > 1) GROUP BY doc_id
), lines AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM w
), dup AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines WHERE regexp_matches(line, '{_WORD}') GROUP BY doc_id
), normal AS (
  SELECT doc_id, source, array_to_string(regexp_extract_all(lower(line), '{_WORD}'), ' ') AS line,
    len(regexp_extract_all(line, '{_WORD}')) AS words
  FROM lines
), frequent AS (
  SELECT source, line FROM normal WHERE line <> '' GROUP BY source, line HAVING count(DISTINCT doc_id) > {quality.MAX_DOCS}
), removed AS (
  SELECT doc_id, count(DISTINCT n.line) AS lines_removed, sum(words) AS words_removed
  FROM normal n JOIN frequent f ON n.line = f.line AND n.source IS NOT DISTINCT FROM f.source GROUP BY doc_id
), figures AS (
  SELECT w.doc_id, len(words)::BIGINT AS n_words, coalesce(length(array_to_string(words, '')), 0)::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
    coalesce(lines_removed, 0)::BIGINT AS lines_removed, (len(words) - coalesce(words_removed, 0))::BIGINT AS words_left
  FROM w LEFT JOIN repeated USING (doc_id) LEFT JOIN dup USING (doc_id) LEFT JOIN removed USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
    AND (lines_removed = 0 OR (words_left >= {quality.MIN_WORDS} AND words_left >= {quality.MIN_LEFT} * n_words)) AS kept,
  lines_removed, words_left
FROM figures
"""

_OP2 = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha1(html) AS payload_digest FROM p),
k AS (SELECT payload_digest, max(page_id) AS kept FROM d WHERE payload_bytes >= {warc.MIN_REVISIT} GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN kept <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN kept <> page_id THEN kept END AS refers_to
FROM d LEFT JOIN k USING (payload_digest)
"""

_OP4 = f"""
WITH c AS (
  SELECT vec_id, list_aggregate(list_transform(range(1, 65), lambda i: CASE WHEN embedding[i] > 0 THEN '1' ELSE '0' END),
    'string_agg', '')::BIT AS code FROM embeddings
), d AS (
  SELECT q.vec_id AS query_id, c.vec_id, bit_count(xor(q.code, c.code))::INTEGER AS distance
  FROM c q, c WHERE q.vec_id % 100 = 0
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id)::INTEGER AS rank FROM d)
SELECT query_id, rank, vec_id, distance FROM r WHERE rank <= {hamming_search.K}
"""

_OP5 = rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::BIGINT AS size FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INTEGER] AS weight
  FROM d GROUP BY source
),
b AS (SELECT 1.5::DOUBLE * sum(source_size)::DOUBLE AS budget FROM s),
levels AS (
  SELECT *, 2 * source_size AS stop, coalesce(sum(2 * source_size) OVER o, 0) AS stopped, sum(weight) OVER f AS free
  FROM s WINDOW o AS (ORDER BY 2 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    f AS (ORDER BY 2 * source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
),
level AS (
  SELECT stopped, free FROM levels, b WHERE stop >= weight * ((budget - stopped) / free) ORDER BY stopped LIMIT 1
),
t AS (
  SELECT source, source_size, CASE WHEN stop < weight * ((budget - l.stopped) / l.free) THEN stop::DOUBLE
    ELSE weight * (budget - l.stopped)::DOUBLE / l.free::DOUBLE END AS target
  FROM levels, b, level l
),
o AS (
  SELECT d.*, source_size, target, floor(target + 0.5)::BIGINT AS lim,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY md5(doc_id::VARCHAR), doc_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, (CASE WHEN source_size = 0 THEN 0 ELSE
  (lim // source_size) * size + least(greatest(lim % source_size - before, 0), size) END)::BIGINT AS taken
FROM o
"""


def _escaped(column: str) -> str:
    """The escaped form of a text in SQL: joiners doubled, control strings parted."""
    joiner = f"chr({ord(chat.JOINER)})"
    sql = f"replace({column}, {joiner}, {joiner} || {joiner})"
    for c in chat.CONTROL:
        sql = f"replace({sql}, '{c}', '{c[0]}' || {joiner} || '{c[1:]}')"
    return sql


_OP6 = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '{MARKED}'), (-1, 1, 'assistant', '{MARKED}'))
), o AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) IS DISTINCT FROM role AS starts FROM t
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length({_escaped('text')}) + CASE WHEN starts
    THEN length({_escaped('role')}) + {len(chat.START) + len(chat.SEP) + len(chat.END)} ELSE {len(chat.CONT)} END)::BIGINT AS formatted_chars
FROM o GROUP BY conv_id
"""

ORACLE_SQL: dict[str, str] = {
    "op1_quality_rules": _OP1,
    "op2_warc_transactions": _OP2,
    "op4_multi_index_hashing": _OP4,
    "op5_mix_sources": _OP5,
    "op6_chat_format": _OP6,
}
