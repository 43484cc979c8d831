"""Near duplicates, vector links and nearest neighbours, against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from rosterlens.llm import additive_quant, dart_minhash as dm, ego_join
from rosterlens.llm.arrowtext import Words, slices
from rosterlens.llm.components import components

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def shingles(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def classes(ids, linked):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def near_brute(texts):
    sets, holders = {i: shingles(t) for i, t in texts.items()}, {}
    for i, s in sets.items():
        for g in s:
            holders.setdefault(g, []).append(i)
    pairs = {(a, b) for own in holders.values() for k, b in enumerate(own) for a in own[:k]}
    return classes(texts, [(a, b) for a, b in pairs if sum((sets[a] & sets[b]).values()) >= 0.8 * sum((sets[a] | sets[b]).values())])


def test_components(spark):
    r = random.Random(3)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(60)]
    got = {x.id: x.component for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = classes({v for e in edges for v in e}, edges)
    assert got == {i: c for i, c in want.items() if any(i in e and e[0] != e[1] for e in edges)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_darts_estimate_weighted_similarity():
    r = random.Random(4)
    base = [f"w{r.randrange(60)}" for _ in range(400)]
    other = [w if r.random() > 0.03 else "zz" for w in base]
    texts = [" ".join(base), " ".join(other), "one two", ""]
    (_, _, data, off), *_ = slices(pa.array(texts))
    doc, key = dm.cells(Words(data, off))
    sig = dm.signatures(doc, key, 4)
    a, b = shingles(texts[0]), shingles(texts[1])
    true = sum((a & b).values()) / sum((a | b).values())
    assert abs((sig[0] == sig[1]).mean() - true) < 0.12
    assert (sig[2] != sig[0]).all() and (sig[3] == np.uint64(0xFFFFFFFFFFFFFFFF)).all()


def test_near_duplicates_of_the_table(spark, data):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    rows = dm.op4_minhash(spark, data).collect()
    assert {r.doc_id: r.class_id for r in rows} == near_brute(texts)
    assert {r.doc_id for r in rows if r.kept} == set(near_brute(texts).values())


def test_near_duplicate_edges_of_the_contract(spark):
    r = random.Random(6)
    long = [f"t{r.randrange(10**6)}" for _ in range(120)]
    texts = [(1, " ".join(long)), (2, " ".join(long).upper()), (3, " ".join(long[:118] + ["x", "y"])), (4, None), (5, ""), (6, "a b"), (7, "A, b!"), (None, "a b"), (1, " ".join(long)), (8, "!!!"), (9, " ".join(long * 300))]
    df = spark.createDataFrame([(i, t, 0) for i, t in texts], "doc_id long, text string, class_id int")
    rows = dm.near_duplicates(df).collect()
    assert len(rows) == len(texts)
    got = {x.doc_id: x.class_id for x in rows}
    assert got[1] == got[2] == got[3] == 1 and got[4] == 4 and got[5] == 5 and got[8] == 8 and got[9] == 9
    null = next(x for x in rows if x.doc_id is None)
    assert got[6] == got[7] == null.class_id == 6 and not null.kept
    assert dm.near_duplicates(df.limit(0)).count() == 0


def test_rows_of_one_id_are_documents_of_their_own(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    rows = [(1, b), (5, a), (5, b), (None, a + " x"), (None, "p q"), (None, "p q r"), (7, "p q r")]
    got = {(x.doc_id, x.text_key): (x.class_id, x.kept) for x in dm.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    key = {t: k for t, k in spark.createDataFrame(rows, "doc_id long, text string").selectExpr("text", "xxhash64(text)").collect()}
    assert got == {(1, key[b]): (1, True), (5, key[a]): (5, True), (5, key[b]): (1, False), (None, key[a + " x"]): (5, False), (None, key["p q"]): (None, True), (None, key["p q r"]): (7, False), (7, key["p q r"]): (7, True)}


def test_large_star_is_cut_into_blocks(spark, monkeypatch):
    """A chain of texts, each similar to the next only, split over several blocks, is one class."""
    r = random.Random(7)
    words = [f"c{r.randrange(10**6)}" for _ in range(300)]
    texts = []
    for _ in range(40):
        words = words[:]
        at = r.randrange(280)
        words[at : at + 6] = [f"c{r.randrange(10**6)}" for _ in range(6)]
        texts.append(" ".join(words))
    monkeypatch.setattr(dm, "BLOCK", 8)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {x.doc_id: x.class_id for x in dm.near_duplicates(df).collect()} == near_brute(dict(enumerate(texts)))


def test_links_of_a_star_against_brute_force(spark):
    """Centre, settled and loose members in several blocks: the forest has the classes of all pairs."""
    r = random.Random(11)
    families = []
    for _ in range(5):
        base = [f"w{r.randrange(10**6)}" for _ in range(80)]
        families += [base] + [[w if r.random() > p else "q" for w in base] for p in (0.01, 0.02, 0.04, 0.04, 0.08) for _ in range(4)]
    texts = [" ".join(f) for f in families]
    (_, _, data, off), *_ = slices(pa.array(texts))
    doc, key = dm.cells(Words(data, off))
    sig = (dm.mix(dm.signatures(doc, key, len(texts))) & np.uint64(255)).astype(np.uint8)
    rows = [(i, bytearray(sig[i].tobytes()), bytearray(np.sort(key[doc == i]).tobytes())) for i in range(len(texts))]
    sets = spark.createDataFrame(rows, "id long, signature binary, regions binary")
    star = spark.createDataFrame([(0, i) for i in range(1, len(texts))], "a long, b long")
    found = [(x.a, x.b) for x in dm.links(sets, star, 0.8, block=7).collect()]
    own = [shingles(t) for t in texts]
    linked = [(a, b) for b in range(len(texts)) for a in range(b) if sum((own[a] & own[b]).values()) >= 0.8 * sum((own[a] | own[b]).values())]
    assert set(found) <= {(min(e), max(e)) for e in linked} | {(max(e), min(e)) for e in linked} and classes(range(len(texts)), found) == classes(range(len(texts)), linked)
    assert len(set(classes(range(len(texts)), linked).values())) > 6


def vectors(seed=1, n=700, dims=16):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(60, dims))
    x = centres[r.integers(60, size=n)] + r.normal(size=(n, dims)) * r.choice([0.02, 0.12, 0.25], size=(n, 1))
    x[50] = x[51] = x[52]
    rows = [(i, [float(v) for v in np.float32(x[i])], int(i % 3)) for i in range(n)]
    rows += [(n, None, 0), (n + 1, [], 0), (n + 2, [0.0] * dims, 0), (n + 3, [1.0, None] + [1.0] * (dims - 2), 0), (n + 4, [float("nan")] * dims, 0), (n + 5, [float("inf")] * dims, 0), (n + 6, rows[0][1], None), (n + 7, rows[0][1][:4], 0), (n + 8, [2 * v for v in rows[3][1]], rows[3][2])]
    return rows


def usable(v):
    return bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)


def test_vector_links(spark):
    rows = vectors()
    df = spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, embedding array<double>, label int, n_links int")
    ok = [(i, np.array(v), y) for i, v, y in rows if usable(v) and y is not None]
    links = [(a, b) for k, (b, w, z) in enumerate(ok) for a, v, y in ok[:k] if y == z and len(v) == len(w) and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= 0.93]
    n = Counter(i for e in links for i in e)
    want = classes([i for i, _, _ in rows], links)
    got = {r.vec_id: r for r in ego_join.similar(df, block=64).collect()}
    assert len(links) > 500
    for i, _, _ in rows:
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (n[i], want[i], want[i] == i)
    assert ego_join.similar(df.limit(0)).count() == 0


def test_links_of_extreme_vectors_and_labels(spark):
    rows = [(1, [1e-200, 2e-200], "a"), (2, [1e-200, 2.0000001e-200], "a"), (3, [1e200, 2e200], "a"), (4, [5e-324, 1e-323], "b"), (5, [1.0, 2.0], "b"), (6, [1.0, 2.0], "a.5"), (7, [float(i % 7 + 1) for i in range(5000)], "a"), (8, [float(i % 7 + 1) * 2 for i in range(5000)], "a")]
    got = {r.vec_id: (r.n_links, r.component_id) for r in ego_join.similar(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")).collect()}
    assert got == {1: (2, 1), 2: (2, 1), 3: (2, 1), 4: (1, 4), 5: (1, 4), 6: (0, 6), 7: (1, 7), 8: (1, 7)}


def test_nearest_neighbours(spark, data):
    rows = vectors(2, 1200)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {}
    for r in sorted(additive_quant.nearest(df, block=256, query_block=16, shortlist=64).collect(), key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    ok = {i: np.array(v) for i, v, _ in rows if usable(v) and len(v) == 16}
    hit = 0
    queries = [i for i in ok if i % 20 == 0]
    assert set(got) == set(queries)
    for q in queries:
        want = sorted(((-float(ok[q] @ v), i) for i, v in ok.items() if i != q))[:20]
        assert [k for k, _, _ in got[q]] == list(range(1, 21)) and all(abs(s - ok[q] @ ok[i]) < 1e-9 for _, i, s in got[q])
        hit += len({i for _, i in want} & {i for _, i, _ in got[q]})
    assert hit >= 0.97 * 20 * len(queries)
    few = additive_quant.nearest(df.filter("vec_id < 5")).collect()
    assert sorted(r.vec_id for r in few) == [1, 2, 3, 4]
    assert additive_quant.nearest(df.limit(0)).count() == 0


def test_nearest_of_other_lengths_repeats_and_clashing_columns(spark):
    rows = [(i, [float(i), 1.0], 0.5) for i in range(1, 41)] + [(i, [float(i), 1.0, 2.0], 0.5) for i in range(100, 109)] + [(20, [5.0, 5.0], 0.5), (20, [5.0, 5.0, 5.0], 0.5), (200, [3.0], 0.5)]
    got = {}
    for r in additive_quant.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>, score double"), k=3).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    twenty = min(np.array(v).tobytes() for i, v, _ in rows if i == 20 and len(v) == 2)
    q = np.frombuffer(twenty)
    want = sorted((-float(q @ np.array(v)), i) for i, v, _ in rows if i < 41 and i != 20 and len(v) == 2)[:3]
    assert sorted(got[20]) == [(k + 1, i, -s) for k, (s, i) in enumerate(want)]
    assert sorted(got[100]) == [(1, 108, 10805.0), (2, 107, 10705.0), (3, 106, 10605.0)] and 200 not in got
    assert {i for x in got[40] for i in x[1:2]} == {39, 38, 37}


def test_recall_of_the_table(spark, data):
    rows = spark.read.parquet(f"{data}/embeddings.parquet").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    got = {}
    for r in additive_quant.op5_additive(spark, data).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hit = n = 0
    for q in ids[ids % 20 == 0]:
        s = x @ x[ids == q][0]
        own = [i for i in ids[np.lexsort((ids, -s))] if i != q][:20]
        hit, n = hit + len(got[q] & set(own)), n + 20
    assert hit >= 0.9 * n


def test_recall_beside_vectors_of_any_magnitude(spark):
    """A few huge and tiny vectors bear on nobody else's codes; scores stay those of the original vectors."""
    rng = np.random.default_rng(11)
    x = rng.normal(size=(3000, 16))
    x[7] *= 1e200
    x[8] *= 1e-200
    x[40] *= 1e-200
    x[60] *= 1e160
    x[9] = np.where(np.arange(16) % 2, 1e308, -1e308)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in additive_quant.nearest(df, block=512).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    hit = 0
    with np.errstate(over="ignore", invalid="ignore"):
        for q, found in got.items():
            assert len(found) == 20 and not any(np.isnan(s) for _, _, s in found)
            exact = x @ (x[q] / 2.0**540 if q == 60 else x[q])
            want = [i for i in np.lexsort((np.arange(3000), -exact)) if i != q][:20]
            hit += len(set(want) & {i for _, i, _ in found})
            if q not in (40, 60):
                assert all(np.isclose(s, x[q] @ x[i], rtol=1e-9, atol=1e-300) for _, i, s in found if i not in (7, 9))
    assert hit >= 0.95 * 20 * len(got)
