"""Registered queries of this subpackage: each runs its operator over a whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm import align, bpe, forest, html, katz, language, lattice, lines, lz, minhash, phrases, planes
from tidemark.llm.packing import cut_documents, pack
from tidemark.llm.tokens import encode_documents, vocabulary_encoder
from tidemark.session import delete_at_exit, scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
PATTERN = public_tokenizers.PATTERN
#: Bytes of remembered words for queries whose workers have little else to hold.
ROOMY = 128 << 20


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode_documents(table(spark, sf_dir, "documents"), VOCABULARY, PATTERN, end=2, added=True)
    pieces = cut_documents(encoded, 1024).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return pack(pieces, 1024)


@query
def op3_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = bpe.encode_and_decode(table(spark, sf_dir, "documents"), RANKS, PATTERN, size=ROOMY)
    return both.select(
        "doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op6_bit_plane_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "planes")
    planes.write_texts(table(spark, sf_dir, "documents"), path, lambda: vocabulary_encoder(VOCABULARY, PATTERN, added=True, size=ROOMY), end=0)
    delete_at_exit(spark, path)
    return planes.read_files(spark, path, (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


@query
def op4_lz_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    compared = lz.compare_with_edits(table(spark, sf_dir, "documents"))
    return compared.withColumn("edited", F.sha2("edited", 256)).withColumnRenamed("edited", "edited_sha256")


@query
def op8_lattice_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_duplicates(table(spark, sf_dir, "embeddings"), 0.93)


@query
def op9_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def remainder() -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % 5


@query
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(remainder() == 0, F.lit(False))
    return language.predict(docs, language.learn(docs.where(~held_out)), "doc_id", held_out.alias("held_out"))


@query
def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=2, percent=80)


@query
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.remove_repeated_lines(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed", "text")


@query
def op2_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(remainder() == 1, F.lit(False))
    return katz.score(table(spark, sf_dir, "documents").withColumn("held_out", held_out))


@query
def op11_isolation_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return forest.judge(docs, forest.learn(docs, table(spark, sf_dir, "labels")), "doc_id")


@query
def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.alignment_summary(table(spark, sf_dir, "documents"), VOCABULARY, PATTERN, PIECES)


@query
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"), top=2000)


SQL["op13_collocations"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
split AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
sizes AS (SELECT lang, sum(len(w))::BIGINT AS n FROM split GROUP BY lang),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM split WHERE len(w) > 0),
grams AS (
  SELECT lang, k AS size, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM places, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE i + k - 1 <= len(w)),
f AS (SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 30),
cand AS (SELECT lang, size, phrase, string_split(phrase, ' ') AS w, f AS a FROM f WHERE size >= 2),
cuts AS (
  SELECT c.lang, c.phrase, c.a, k, l.f AS l, r.f AS r, ((2000000::HUGEINT * c.a) // (l.f + r.f))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, size)) AS k FROM cand) c
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:k], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[k + 1:], ' ')),
worst AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT lang, array_to_string(w[p:p + short - 1], ' ') AS phrase, max(a) AS holder
  FROM (SELECT *, unnest(range(1, size - short + 2)) AS p FROM (SELECT *, unnest(range(2, size)) AS short FROM cand))
  GROUP BY ALL),
free AS (
  SELECT s.* FROM worst s LEFT JOIN inside i USING (lang, phrase) WHERE i.holder IS NULL OR 100::HUGEINT * i.holder < 80::HUGEINT * s.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::BIGINT AS rank, phrase, a, l, r, n, score
FROM free JOIN sizes USING (lang) QUALIFY rank <= 2000
"""
