"""Term counts made inside a document's row, blocks of documents scored at once, and the plan they leave."""

import random
import re

import numpy as np

from shelfcast.llm import lexical


def test_words_of_bytes_equal_the_pattern():
    marks, draw = lexical.byte_map(), random.Random(2)
    signs = "aZ09/:@[`{\x7f\x80\xa0 é\x85 \n\t\x0b\x00_İſK"
    for _ in range(500):
        text = "".join(draw.choice(signs) for _ in range(draw.randint(0, 30)))
        want = re.findall(lexical.TERM, text.translate(str.maketrans(lexical.UPPER, lexical.LOWER)))
        for size in (1, 7, 1 << 22):
            assert [w.decode() for part in lexical.words_of(text.encode(), marks, size) for w in part] == want


def test_blocks_find_what_single_documents_do():
    rng = np.random.default_rng(4)
    for documents in (1, 5, 40, 300):
        held = rng.random((6, documents)) < rng.random((6, 1))
        term, at = np.nonzero(held)
        impacts = rng.integers(1, 4, len(term))
        index = lexical.ShardIndex(term, at, impacts, documents)
        repeats = rng.integers(1, 3, 6)
        total = np.zeros(documents, dtype=np.int64)
        np.add.at(total, at, repeats[term] * impacts)
        want = sorted(((d, int(s)) for d, s in enumerate(total) if s), key=lambda r: (-r[1], r[0]))[:7]
        for leaf in (1, 4, 64, 512):
            assert index.search(np.arange(6), repeats, 7, leaf) == want


def test_postings_are_not_shuffled_by_document_and_term(spark, capsys):
    """The one wide exchange moves whole documents, so the disk it takes is a fraction of the texts."""
    docs = spark.createDataFrame([(i, "red green blue " * 3 + str(i)) for i in range(50)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "red green"), (2, "blue 7")], "item_id long, text string")
    best = lexical.rank(docs, items, k=3)
    best.explain()
    plan = capsys.readouterr().out
    assert "Generate explode" not in plan and "SortMergeJoin" not in plan
    assert [(r.item_id, r.rank, r.doc_id) for r in best.where("item_id = 2").orderBy("rank").collect()][0] == (2, 1, 7)


def test_repeats_of_a_document_and_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK_TERMS", 2)
    docs = spark.createDataFrame([(1, "red")] * 5 + [(None, "red"), (2, "red blue"), (3, None)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "Red"), (2, "blue!"), (3, "red blue"), (None, "BLUE")], "item_id long, text string")
    got = [(r.item_id, r["rank"], r.doc_id) for r in lexical.rank(docs, items, k=6).collect()]
    assert sorted(r[1:] for r in got if r[0] == 1) == [(1, 1), (2, 1), (3, 1), (4, 1), (5, 1), (6, None)]
    assert [r for r in got if r[0] == 2] == [(2, 1, 2)] and [r for r in got if r[0] is None] == [(None, 1, 2)]
    assert len([r for r in got if r[0] == 3]) == 6
