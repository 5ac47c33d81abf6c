"""Corpus preparation: ``run`` applies ``STAGES`` to ``documents``.

1. ``language_id``: documents whose language is none of those learned from the labels go, as do
   those without a letter.
2. ``line_dedup``: lines that repeat an earlier line, exactly or within one edit, go; so do documents
   that lose lines and have only blank ones left.
3. ``near_dedup``: of documents with at least 80 percent of their five-word shingles in common, one stays.
4. ``packing``: the texts left, as token ids, fill sequences of 1024; the result is one row per piece.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.language import keep_known_languages
from tidemark.llm.lines import without_repeated_lines
from tidemark.llm.minhash import keep_one_of_each
from tidemark.llm.packing import cut_documents, pack
from tidemark.llm.tokens import ROWS, encode_documents
from tidemark.session import arrow_batches, delete_at_exit, shared_folder

CAPACITY, END = 1024, 2
#: Bytes of remembered words: workers of this stage stand beside idle ones of the stages before.
REMEMBERED = 12 << 20


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_known_languages(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_repeated_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one_of_each(docs, words=5, percent=80)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length``, ``ids``, ``ids_crc32``, ``sequence_id``, ``offset``."""
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    encoded = encode_documents(docs, vocabulary, public_tokenizers.PATTERN, end=END, added=True, size=REMEMBERED)
    with arrow_batches(spark, ROWS):  # pack computes the ids before it returns
        return pack(cut_documents(encoded, CAPACITY).withColumn("ids_crc32", F.crc32("ids")), CAPACITY)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("packing", packing),
]
#: Neither a fitted classifier nor token ids can be expressed in SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage reads what the one before has written as Parquet to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = os.path.join(shared_folder(spark), "tidemark-pipeline", uuid.uuid4().hex)
    delete_at_exit(spark, folder)
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
