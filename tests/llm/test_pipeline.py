"""The pipeline against plain Python, and its place in the entry module."""

from __future__ import annotations

import random
from collections import defaultdict

import corpus_pipeline
from tests.llm.test_duplicates import lines_by_hand, roots, shingle_set
from tests.llm.test_tokens_and_packing import ids_of, packed


def corpus():
    draw = random.Random(8)
    words = {"en": "the of and that house cat with into which when".split(), "de": "der und nicht haus katze mit welche wenn auch ein".split()}

    def line(lang):
        return " ".join(draw.choices(words[lang], k=draw.randint(6, 14))) + draw.choice(".!?") + str(draw.randint(0, 999))

    rows = []
    for i in range(60):
        lang = draw.choice(["en", "de"])
        rows.append([i, "\n".join(line(lang) for _ in range(draw.randint(1, 5))), lang, "s", 0])
    for i in range(60, 90):  # copies, copies with a changed line, copies with every line changed a little
        text, lang = draw.choice(rows[:60])[1:3]
        kind = i % 3
        if kind == 1:
            text = "\n".join([*text.split("\n"), line(lang)])
        elif kind == 2:
            text = "\n".join(x + " xy zz" for x in text.split("\n"))
        rows.append([i, text, lang, "s", 0])
    rows += [[90, None, "en", "s", None], [91, "", None, "s", 0], [92, "12345 --- 67890", "en", "s", 15], [93, "the house and the cat " * 900, None, "s", 1], [94, "und", None, None, 3]]
    long = draw.choices(words["en"], k=80)
    rows += [[95, " ".join(long), "en", "s", 0], [96, " ".join([*long[:-1], "altogether", "different"]), "en", "s", 0]]
    return [tuple(r) for r in rows]


def test_pipeline_equals_plain_python(spark, tmp_path):
    rows = corpus()
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    texts = {i: t for i, t, *_ in rows if t and any(c.isalpha() for c in t)}
    cleaned = lines_by_hand(sorted(texts.items()))
    texts = {i: t for i, (t, removed) in cleaned.items() if removed <= t.count("\n") or t}
    sets = {i: shingle_set(t, 5) for i, t in texts.items()}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = roots(list(texts), links)
    texts = {i: t for i, t in texts.items() if want[i] == i}
    assert len(texts) < 90 and links

    pieces, places = defaultdict(list), defaultdict(list)
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        pieces[r.doc_id].append((r.start, r.ids))
        places[r.sequence_id].append((r.offset, r.length))
    assert {i: b"".join(ids for _, ids in sorted(p)) for i, p in pieces.items()} == {i: packed([*ids_of(t), 2]) for i, t in texts.items()}
    for place in places.values():
        at = 0
        for offset, length in sorted(place):
            assert offset == at
            at += length
        assert at <= corpus_pipeline.CAPACITY


def test_copies_with_blank_and_short_lines_go(spark, tmp_path):
    texts = ["the house and the cat in the garden\n\nthat cat with the big house", "which house into that cat\nRead more\nwhen the cat was in", "  \n\t"]
    rows = [(3 * copy + i, t, "en", "s", len(t)) for copy in range(4) for i, t in enumerate(texts)]
    rows.append((50, texts[0] + "\n\t\n \n\r\n" + texts[1], "en", "s", 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    left = corpus_pipeline.line_dedup(spark, docs, "").collect()
    # documents that never had any visible text lose no line here
    assert sorted((r.doc_id, r.text, r.n_chars) for r in left if r.text.strip()) == [(i, t, len(t)) for i, t in enumerate(texts[:2])]
    assert {r.doc_id for r in left if not r.text.strip()} == {2, 5, 8, 11}
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == {0, 1}


def test_stages_keep_the_columns(spark):
    docs = spark.createDataFrame(corpus()[:20], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, "").columns == docs.columns
        assert stage(spark, docs.limit(0), "").count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), "").count() == 0


def test_entry_module_has_all_queries():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
