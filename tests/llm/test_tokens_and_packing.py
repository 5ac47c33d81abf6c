from __future__ import annotations

import bisect
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tidemark.llm import bpe, memory, planes, queries
from tidemark.llm.packing import cut_documents, group_lengths, make_plan, optimise, pack
from tidemark.llm.tokens import Memory, encode_documents, vocabulary_encoder

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
ODD = [
    None, "", " ", "  a  b\n\n c", "\n x", "it's  we'll's 12½ ²x <|endoftext|>   y　z", " \x1c\x1d a", "a.\n's b", "a.\n\n\nb c",
    "don't, 'tis' x'' 's", "a\n. b", "é'\n'll", "ж你好 мир", "x" * 3000, "ab " * 2000, "###*** %%%", "a  ", "word.\nNext\nline",
]


def ids_of(text: str | None) -> list[int]:
    tokenizer = Tokenizer.from_file(VOCABULARY)
    tokenizer.encode_special_tokens = True
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def rank_ids(text: str | None) -> list[int]:
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={}).encode_ordinary(text or "")


def packed(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()


def documents(spark, texts):
    # the extra columns have names that the operators use themselves
    return spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(texts)], "doc_id long, text string, length int, ids string")


def test_ids_are_those_of_the_tokenizers_library(spark):
    rows = encode_documents(documents(spark, ODD), VOCABULARY, PATTERN, end=2).collect()
    assert {r.doc_id: r.ids for r in rows} == {i: packed([*ids_of(t), 2]) for i, t in enumerate(ODD)}


def test_queries_give_added_tokens_their_ids(spark, tmp_path):
    library = Tokenizer.from_file(VOCABULARY)
    texts = [*ODD, "a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>\n y", "<|endoftext|", "ab<|endoftext|>  <|endoftext|>c" * 300]
    want = {i: library.encode(t or "", add_special_tokens=False).ids for i, t in enumerate(texts)}
    assert want[len(ODD)] == [64, 220, 50256, 275]
    rows = encode_documents(documents(spark, texts), VOCABULARY, PATTERN, end=2, added=True).collect()
    assert {r.doc_id: r.ids for r in rows} == {i: packed([*ids, 2]) for i, ids in want.items()}

    spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    pieces = queries.op1_best_fit_packing(spark, str(tmp_path)).collect()
    cuts = {i: [0, *range(n % 1024 or 1024, n + 1, 1024)] for i, ids in want.items() for n in [len(ids) + 1]}
    assert {(r.doc_id, r.start): (r.length, r.ids_crc32) for r in pieces} == {
        (i, a): (b - a, zlib.crc32(packed([*want[i], 2][a:b]))) for i, at in cuts.items() for a, b in zip(at, at[1:])
    }
    files = queries.op6_bit_plane_files(spark, str(tmp_path)).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_crc32) for r in files} == {i: (len(ids) + 1, zlib.crc32(packed([*ids, 0]))) for i, ids in want.items()}
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    packing = corpus_pipeline.packing(spark, docs, str(tmp_path)).collect()
    assert {(r.doc_id, r.start): r.ids_crc32 for r in packing} == {(r.doc_id, r.start): r.ids_crc32 for r in pieces}


def test_memory_is_bounded_and_forgetting_changes_nothing():
    whole, small = vocabulary_encoder(VOCABULARY, PATTERN), None
    small = Memory(whole.encode_match, PATTERN, limit=5)
    text = " ".join(f"w{i}, word{i}\nnext" for i in range(50))
    assert small.encode(text) == whole.encode(text) == packed(ids_of(text))
    assert len(small) <= 5 + 2 and len(small.kept) <= 5


def test_bpe_is_that_of_tiktoken_and_decodes(spark):
    rows = bpe.encode_and_decode(documents(spark, ODD), RANKS, PATTERN).collect()
    assert len(rows) == len(ODD)
    for r in rows:
        assert r.ids == packed(rank_ids(ODD[r.doc_id]))
        assert r.decoded == (ODD[r.doc_id] or "").encode()
    apart = bpe.decode(bpe.encode(documents(spark, ODD), RANKS, PATTERN), RANKS)
    assert sorted(apart.collect()) == sorted(rows)


def test_merger_on_random_bytes():
    ranks = bpe.read_ranks(RANKS)
    merger = bpe.Merger(ranks)
    core = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})._core_bpe
    draw = random.Random(1)
    for n in range(1, 400):
        piece = draw.randbytes(n % 40 + 1) if n % 2 else bytes(draw.choices(b"aehnt", k=n % 60 + 1))
        assert merger.ids(piece) == core.encode_single_piece(piece)
    assert b"".join(map({v: k for k, v in ranks.items()}.get, merger.ids(b"ab" * 20_000))) == b"ab" * 20_000


def test_short_pieces_need_no_tree(monkeypatch):
    merger = bpe.Merger(bpe.read_ranks(RANKS))
    draw = random.Random(2)
    pieces = [bytes(draw.choices(b"aehnt \xc3\xa4", k=n % bpe.SHORT + 1)) for n in range(300)]
    by_tree = [merger.many([merger.single[b] for b in p]) for p in pieces]
    monkeypatch.setattr(bpe.Merger, "many", None)
    assert [merger.few(p) for p in pieces] == by_tree
    assert merger.ids(b"qxqxqzzq" * 6) and merger.ids(b"") == []


def test_queries_say_how_much_workers_remember():
    small, large = (vocabulary_encoder(VOCABULARY, PATTERN, size=size) for size in (1 << 14, 8 << 20))
    text = " ".join(f"word{i} number{i}" for _ in range(3) for i in range(2_000))
    assert small.encode(text) == large.encode(text)
    assert len(small) < 100 < len(large) and small.held < 2 * small.size


@pytest.mark.parametrize("bits", [False, True])
def test_plane_file_round_trip(bits):
    ids = np.random.default_rng(0).integers(0, 2**32, 5000).astype("<u4")
    file = planes.PlaneFile(planes.build_file(ids, [3, None, 5], [4000, 0, 1000], block=777, bits=bits))
    assert file.keys == [3, None, 5] and file.starts.tolist() == [0, 4000, 4000]
    for start, n in ((0, 5000), (100, 3000), (777, 777), (4999, 1), (10, 0)):
        assert (file.read(start, n) == ids[start:start + n]).all()
    with pytest.raises(ValueError):
        planes.PlaneFile(b"something else, of 28 bytes or more")


def test_files_hold_documents_in_order(spark, tmp_path):
    docs = documents(spark, [*ODD, *ODD]).union(spark.createDataFrame([(None, "no id", 1, "x"), (3, ODD[3], 1, "x")], "doc_id long, text string, length int, ids string"))
    path = str(tmp_path / "files")
    planes.write_texts(docs.repartition(5), path, lambda: vocabulary_encoder(VOCABULARY, PATTERN), end=0)
    rows = planes.read_files(spark, path).collect()
    texts = {i: t for i, t in enumerate([*ODD, *ODD])} | {None: "no id"}
    assert Counter(r.doc_id for r in rows) == Counter([None, 3, *range(2 * len(ODD))])
    at = 0
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == at and r.ids == packed([*ids_of(texts[r.doc_id]), 0])
        at += len(r.ids) // 4
    keys = [r.doc_id for r in sorted(rows, key=lambda r: r.start)]
    assert keys == [None, *sorted(k for k in keys if k is not None)]
    derived = planes.read_files(spark, path, F.crc32("ids").alias("crc")).collect()
    assert Counter((r.start, r.crc) for r in derived) == Counter((r.start, zlib.crc32(r.ids)) for r in rows)


def test_small_files_and_empty_tables(spark, tmp_path):
    encoded = encode_documents(documents(spark, ODD).coalesce(1), VOCABULARY, PATTERN, end=0)
    planes.write_files(encoded, str(tmp_path / "a"), block=16, file_ids=50)
    assert spark.read.parquet(str(tmp_path / "a")).count() > 3
    assert {r.doc_id: r.ids for r in planes.read_files(spark, str(tmp_path / "a")).collect()} == {r.doc_id: r.ids for r in encoded.collect()}
    planes.write_files(encoded.limit(0), str(tmp_path / "b"))
    assert planes.read_files(spark, str(tmp_path / "b")).collect() == []


def check_packing(rows, capacity, lengths):
    assert Counter(r.length for r in rows) == Counter(lengths)
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    assert set(by) == set(range(len(by)))
    return len(by)


@pytest.mark.parametrize("seed", range(4))
def test_packing_is_as_good_as_best_fit(spark, seed):
    draw = random.Random(seed)
    lengths = [draw.choice([draw.randint(1, 100), draw.randint(1, 20), 100, 51, 34]) for _ in range(1500)]
    pieces = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "doc_id long, length long")
    used = check_packing(pack(pieces, 100).collect(), 100, lengths)
    gaps: list[int] = []  # best fit, longest first, one piece at a time
    for n in sorted(lengths, reverse=True):
        at = bisect.bisect_left(gaps, n)
        gap = gaps.pop(at) if at < len(gaps) else 100
        bisect.insort(gaps, gap - n)
    least = max(-(-sum(lengths) // 100), sum(n > 50 for n in lengths))
    assert least <= used <= len(gaps) + 1


def test_packing_ties_repeats_and_empty(spark):
    rows = [(1, 60), (1, 60), (None, 40), (None, 40), (2, 100), (3, 1)]
    pieces = spark.createDataFrame(rows, "doc_id long, length long")
    assert check_packing(pack(pieces, 100).collect(), 100, [n for _, n in rows]) == 4
    assert pack(pieces.limit(0), 100).collect() == []
    with pytest.raises(ValueError):
        pack(spark.createDataFrame([(1, 101)], "doc_id long, length long"), 100)


def test_hot_length_is_ranked_in_blocks(spark, monkeypatch):
    monkeypatch.setattr("tidemark.llm.packing.BLOCK", 10)
    pieces = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit(50).cast("long").alias("length"))
    assert check_packing(pack(pieces, 100).collect(), 100, [50] * 1000) == 500


def test_plan_parts():
    assert group_lengths({10: 5, 9: 5, 8: 10, 1: 99}, 2, 2) == [[10, 9], [8]]
    patterns = optimise([50, 30, 20], [10, 10, 10], 100)
    assert sum(times for _, times in patterns) <= 10
    rows, total = make_plan({60: 3, 40: 3, 5: 4}, 100, 20)
    assert total == 4 and sum(high - low for _, low, high, *_ in rows) == 10


def test_cut_gives_the_first_piece_the_remainder(spark):
    encoded = spark.createDataFrame([(1, bytearray(4 * 25)), (2, bytearray(4 * 10)), (3, bytearray(0)), (4, bytearray(4 * 20))], "doc_id long, ids binary")
    found = {(r.doc_id, r.piece): (r.start, r.length, len(r.ids)) for r in cut_documents(encoded, 10).collect()}
    assert found == {(1, 0): (0, 5, 20), (1, 1): (5, 10, 40), (1, 2): (15, 10, 40), (2, 0): (0, 10, 40), (4, 0): (0, 10, 40), (4, 1): (10, 10, 40)}


def test_plan_needs_no_python_workers(spark):
    pieces = spark.createDataFrame([(1, 60), (2, 40), (3, 7)], "doc_id long, length long")
    plan = pack(pieces, 100)._jdf.queryExecution().executedPlan().toString()
    assert "LocalTableScan" in plan and "ExistingRDD" not in plan


def test_memory_of_matches_follows_the_size():
    small, usual = (vocabulary_encoder(VOCABULARY, PATTERN, size=size) for size in (12 << 20, 40 << 20))
    assert small.kept.size == 6 << 20 and usual.kept.size == 20 << 20


def test_what_building_took_is_given_back(monkeypatch):
    done = []
    monkeypatch.setattr(memory, "_only", {"before": 1})
    monkeypatch.setattr(memory, "give_back", lambda: done.append("back"))
    for _ in range(2):
        assert memory.only("now", lambda: done.append("built") or 2) == 2
    assert done == ["back", "built", "back"] and memory._only == {"now": 2}


def test_packing_stage_sends_small_batches(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(corpus_pipeline, "pack", lambda pieces, capacity: seen.append(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) or pieces)
    corpus_pipeline.packing(spark, documents(spark, ["a b"]), "")
    assert seen == ["500"]


def test_texts_encoded_together_have_the_ids_of_the_library():
    texts = [
        None, "", "one", " ", "a  b \n c", " a", "a ", "x<|endoftext|>y z", "it's a 12ab'll \x00é　ß ok", "a\tb c\nd.e\n€f,", "nine, nine\nnine nine,",
        *(f"w{i} wörd{i % 7}, word{'s' * (i % 5)}... (x{i})\nnext 'tis" for i in range(300)),
    ]
    library = Tokenizer.from_file(VOCABULARY)
    expected = [np.array([*library.encode(t or "", add_special_tokens=False).ids, 7], "<u4").tobytes() for t in texts]
    calls = []
    made = vocabulary_encoder(VOCABULARY, PATTERN, added=True, size=1 << 16)
    many = made.memory.encode_many
    made.memory.encode_many = lambda matches: calls.append(len(matches)) or many(matches)
    tail = (7).to_bytes(4, "little")
    for _ in range(3):  # unknown, met and remembered
        assert made.encode_all(texts, tail).to_pylist() == expected
    assert len(calls) == 3 and calls[0] > calls[2]
    assert [x for t in texts for x in made.encode_all([t], tail).to_pylist()] == expected
    assert made.encode_all([], tail).to_pylist() == []
