"""The stages against their operators' brute-force facts, on the smallest table."""

import re
from collections import Counter

import corpus_pipeline
from rosterlens.llm import packing, toxic_crf
from rosterlens.llm.store import materialise, table


def test_stages(spark, data):
    docs = table(spark, data, "documents")
    columns = docs.columns
    clean = materialise(corpus_pipeline.toxicity(spark, docs, data))
    model = toxic_crf.fit(docs, table(spark, data, "labels"))
    bad = {r.doc_id for r in toxic_crf.score(docs, model).filter("score >= 0.5").collect()}
    assert clean.columns == columns and {r.doc_id for r in clean.collect()} == {r.doc_id for r in docs.collect()} - bad

    from tests.llm.test_dedup_and_vectors import near_brute

    once = materialise(corpus_pipeline.minhash(spark, clean, data))
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert once.columns == columns and Counter(r.doc_id for r in once.collect()) == Counter(set(near_brute(texts).values()))

    red = materialise(corpus_pipeline.pii(spark, once, data))
    assert red.columns == columns and red.count() == once.count()
    for r in red.collect():
        assert r.n_chars == len(r.text) and not re.search(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r.text)

    packed = corpus_pipeline.pack(spark, red, data).collect()
    encode = packing.encoder(packing.vocabulary_path())
    assert sum(r.length for r in packed) == sum(len(encode(r.text)) // 4 + 1 for r in red.collect())
    assert corpus_pipeline.ORACLE_SQL is None and [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "minhash", "pii", "packing"]


def test_null_ids_stay(spark, data):
    rows = spark.createDataFrame([(None, "a b c", "en", "s", 5), (None, "d e f", "en", "s", 5), (None, "d e f", "en", "s", 5), (3, None, "en", "s", 0), (3, None, "en", "s", 0)], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted((r.doc_id or 0, r.text or "") for r in corpus_pipeline.minhash(spark, rows, data).collect())
    assert got == [(0, "a b c"), (0, "d e f"), (3, "")]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, score double, id long"


def test_unrelated_texts_of_one_id_stay(spark, data):
    a, b = (" ".join(f"{c}{i}" for i in range(40)) for c in "ab")
    rows = spark.createDataFrame([(1, b, 0), (5, a, 0), (5, b, 0), (None, a, 0), (0, "x y", 0), (None, "x y", 0), (None, None, 0), (None, "", 0)], "doc_id long, text string, kept int")
    got = Counter((r.doc_id, r.text) for r in corpus_pipeline.minhash(spark, rows, data).collect())
    assert got == Counter([(1, b), (5, a), (0, "x y"), (None, None), (None, "")])


def test_stages_on_odd_rows(spark, data):
    """Nulls, empty and long texts, repeats, clashing extra columns, and no rows at all."""
    long = " ".join(f"w{i}" for i in range(60_000)) + " mail me@example.org"
    rows = [(1, None, None, None, None, True, 0.5, 9), (2, "", "en", "s", 0, None, None, None), (3, long, "en", "s", len(long), True, 0.1, 1), (4, "call +1 (321) 555-7788", "en", "s", 22, True, 0.1, 1), (4, "call +1 (321) 555-7788", "en", "s", 22, True, 0.1, 1), (None, "!!!", None, None, 3, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = corpus_pipeline.toxicity(spark, docs, data)
    assert kept.columns == docs.columns and Counter(r.doc_id for r in kept.collect()) == Counter(r[0] for r in rows)
    red = {r.doc_id: r for r in corpus_pipeline.pii(spark, docs, data).collect()}
    assert red[1].text is None and red[2].text == "" and red[3].text.endswith(" mail <EMAIL>") and red[4].text == "call <PHONE>" and red[None].kept is None
    packed = corpus_pipeline.pack(spark, docs, data).collect()
    assert sum(r.doc_id == 1 for r in packed) == 1 and sum(r.doc_id == 4 for r in packed) >= 2 and sum(r.length for r in packed if r.doc_id == 3) > 60_000
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), data).count() == 0


def test_extra_columns_of_private_looking_names_keep_their_values(spark, data):
    a, b = (" ".join(f"{c}{i}" for i in range(40)) for c in "ab")
    rows = spark.createDataFrame([(1, a, 7, "x", True), (2, a, 8, "y", False), (3, b, 9, "z", None)], "doc_id long, text string, __id int, __key string, __none boolean")
    got = sorted(tuple(r) for r in corpus_pipeline.minhash(spark, rows, data).collect())
    assert got == [(1, a, 7, "x", True), (3, b, 9, "z", None)]
