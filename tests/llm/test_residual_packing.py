"""Best-fit packing with merges of underfull bins: whole results, ids by the library, few sequences."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import Row
from tokenizers import Tokenizer

from rosterlens.llm import residual_packing as R
from rosterlens.llm.packing import vocabulary_path
from rosterlens.llm.store import table
from rosterlens.llm.wordpieces import word_encoder


def _check(rows, texts, window):
    """Every id of every text lies in exactly one piece, and sequences are gapless."""
    library = Tokenizer.from_file(vocabulary_path("word_bpe_49k.json"))
    ids = {d: np.asarray([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for d, t in texts.items()}
    of, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        of[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
    for doc, mine in of.items():
        mine.sort(key=lambda r: r.piece)
        assert [r.piece for r in mine] == list(range(len(mine)))
        assert [r.start for r in mine] == [window * i for i in range(len(mine))]
        assert all(r.length == window for r in mine[:-1]) and sum(r.length for r in mine) == len(ids[doc])
    for inside in sequences.values():
        at = 0
        for r in sorted(inside, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
    assert set(of) == set(texts)
    return len(sequences), sum(map(len, ids.values()))


def test_all_documents_in_few_sequences(spark, data):
    docs = table(spark, data, "documents")
    rows = R.op12_residual(spark, data).collect()
    used, tokens = _check(rows, {r.doc_id: r.text for r in docs.collect()}, R.WINDOW)
    assert used <= -(-tokens // R.WINDOW) + 2


def test_levels_of_the_tree_give_about_as_few_as_one_task(spark, data):
    docs = table(spark, data, "documents").select("doc_id", "text").repartition(37)
    rows = R.pack(docs, window=256, fan=3).collect()
    used, tokens = _check(rows, {r.doc_id: r.text for r in docs.collect()}, 256)
    assert used <= 1.03 * tokens / 256 + 2


def test_runs_and_a_bound_on_what_is_passed_up_keep_all_pieces(spark, data):
    docs = table(spark, data, "documents").select("doc_id", "text").repartition(6)
    rows = R.pack(docs, window=512, fan=2, run=7, carried=3).collect()
    _check(rows, {r.doc_id: r.text for r in docs.collect()}, 512)


def test_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", "b"), (3, "word " * 3000, "c"), (4, "漢字" * 900, "d"), (5, "\x00 <|endoftext|> Σας", "e")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, bin string").withColumnRenamed("bin", "fill")
    used, _ = _check(R.pack(docs, window=1024).collect(), {d: t for d, t, _ in rows}, 1024)
    assert used >= 3
    twice = R.pack(docs.unionByName(docs), window=1024).groupBy("doc_id", "piece").count().collect()
    assert {r["count"] for r in twice} == {2}
    none = spark.createDataFrame([(None, "x y"), (None, None)], "doc_id long, text string")
    assert sorted((r.doc_id, r.length) for r in R.pack(none).collect()) == [(None, 1), (None, 3)]
    assert R.pack(docs.limit(0)).collect() == []


def test_best_fit_against_brute_force():
    r = random.Random(4)
    for _ in range(60):
        window = r.choice([8, 50, 300])
        sizes = np.asarray([r.randint(1, window) for _ in range(r.randint(0, 80))], np.int64)
        bins, offsets, fills = R.best_fit(sizes, window)
        level: list[int] = []
        for at in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
            fit = [b for b in range(len(level)) if level[b] + sizes[at] <= window]
            best = max((level[b] for b in fit), default=0)
            if not fit:
                level.append(0)
            assert offsets[at] == best
            level[bins[at]] += sizes[at]
        assert level == fills.tolist()


@pytest.mark.parametrize("alphabet", ["abcXYZ012.,!-#<|>' \t\n\x0b\x0c\x1c\x1f\x85\xa0stmdrevl", "abcÉé'İßñſªº²¼ŉǅ×÷\xad\xa0Жжй", "aAé'Σσς́̇漢한가1٢.,🙂‍ 　​﻿\x00"])
def test_ids_are_those_of_the_library(alphabet):
    path = vocabulary_path("word_bpe_49k.json")
    library, encode, r = Tokenizer.from_file(path), word_encoder(path), random.Random(2)
    pool = [*alphabet, "<|endoftext|>", "'ll", "''s", "don't"]
    texts = ["".join(r.choice(pool) for _ in range(r.randint(0, 16))) for _ in range(20000)]
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert encode(text) == np.asarray(want.ids, "<u4").tobytes(), text
    long = " ".join(texts[:200])
    assert word_encoder.__wrapped__(path, 64)(long) == np.asarray(library.encode(long, add_special_tokens=False).ids, "<u4").tobytes()
