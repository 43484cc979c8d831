"""Near-duplicate texts by weighted MinHash with darts.

A text is a multiset of five-word shingles (of its one shorter run of words, if it has
fewer than five). The c-th occurrence of a shingle is the region [c-1, c) of its weight
axis. Every region is hit by a Poisson stream of darts with hashed arrival ranks and
hashed coordinates 0..k-1, the same in every text; a coordinate keeps its earliest dart.
Two texts agree on a coordinate with probability sum(min)/sum(max) of their weights.
Ranks are looked at only up to a bound that gives k(ln k + 3) darts a text, whatever its
length; the few texts with a coordinate still empty look twice as far again.

Bands of ``rows`` coordinates are buckets. Equal word sequences are one node, so a
bucket holds different texts only. The smallest node of a bucket is its centre; the union
of the buckets with one centre is a star, and every pair of texts that share a bucket
share a star. A star is cut into blocks, each with the centre, and a block is compared
whole inside a task. Texts that a block links to the centre, over others or directly, are
settled; only the rest is compared with the other blocks, again in blocks of both. So a
group of any size whose texts resemble its centre costs its size, not its square. Pairs of
different classes whose signatures leave room for the wanted similarity are settled by
exact weighted Jaccard similarity over 64-bit keys of all shingles, likeliest first, and a
group sends its links as a forest. With 42 bands of 6, a pair at similarity 0.8 shares no
bucket with probability 3e-6, and the signature test (4.5 standard deviations) errs about
as rarely.

A document is a row with its doc_id and text: rows of one doc_id with different texts are
different documents. Null and empty texts have no shingles and are alone in their class.
Null doc_ids stay null and come after all others, so a class has a null class_id only if
none of its rows has an id. Rows that repeat both doc_id and text are one document: all of
them are kept or none. Other columns, whatever their names, are not read. An empty table
gives no rows. A very long text is cut nowhere; ties of doc_id within a class are settled
by the hash of the text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrowtext import U64, Words, mix, slices
from .components import components
from .store import discard, materialise, table

SHINGLE = 5
ROWS, BANDS = 6, 42
SIMILARITY = 0.8
BLOCK = 256  # texts of a star


def cells(w: Words, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(text, key) of every unit region: keys depend on the shingle and on which occurrence it is."""
    at, gram = w.grams(k)
    doc = np.repeat(np.arange(len(w.first) - 1), np.diff(w.first))[at] if len(at) else np.zeros(0, np.int64)
    size = np.diff(w.first)
    short = np.flatnonzero((size > 0) & (size < k))
    if len(short):
        doc = np.concatenate([doc, short])
        gram = np.concatenate([gram, w.content()[0][short]])
    order = np.lexsort((gram, doc))
    doc, gram = doc[order], gram[order]
    if len(doc):
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (gram[1:] != gram[:-1])
        nth = np.arange(len(doc)) - np.maximum.accumulate(np.where(new, np.arange(len(doc)), 0))
        gram = mix(gram + nth.astype(U64) * U64(0x9E3779B97F4A7C15))
    return doc, gram


def signatures(doc: np.ndarray, key: np.ndarray, n: int, k: int = ROWS * BANDS) -> np.ndarray:
    """(n, k) earliest dart of every coordinate, rank in the high bits; all ones for texts without regions."""
    none = U64(0xFFFFFFFFFFFFFFFF)
    out = np.full(n * k, none)
    size = np.bincount(doc, minlength=n)
    bound = np.zeros(n)
    bound[size > 0] = k * (np.log(k) + 3) / size[size > 0]
    todo = np.ones(n, bool)
    while True:
        use = todo[doc]
        d, x = doc[use], key[use]
        rank = np.zeros(len(d))
        turn = 0
        while len(d):
            turn += 1
            x = mix(x + U64(0xA0761D6478BD642F))
            rank = rank - np.log(((x >> U64(11)).astype(np.float64) + 1) * 2.0**-53)
            hit = rank < bound[d]
            d, x, rank = d[hit], x[hit], rank[hit]
            where = mix(x ^ U64(0xE7037ED1A0B428DB))
            # ranks as float bits keep their order; the low bits tell darts of like rank apart
            value = (rank.view(U64) & ~U64(0xFFFFFF)) | (where >> U64(40))
            np.minimum.at(out, d * k + (where % U64(k)).astype(np.int64), value)
        empty = (out.reshape(n, k) == none).any(axis=1) & (size > 0) & todo
        if not empty.any():
            return out.reshape(n, k)
        todo = empty
        bound[empty] *= 2


_SIG = "doc_id long, text_key long, t1 long, t2 long, bands array<long>"


def signed(docs: DataFrame, rows: int = ROWS, bands: int = BANDS) -> DataFrame:
    """Content hashes and band hashes of each row of ``docs(doc_id, text_key, text)``; no bands without words."""
    k = rows * bands

    def run(batches):
        for batch in batches:
            for i, j, data, off in slices(batch.column(2)):
                n = j - i
                w = Words(data, off)
                doc, key = cells(w)
                sig = signatures(doc, key, n, k)
                band = np.arange(bands, dtype=U64)[None, :] + U64(1)
                h = np.zeros((n, bands), U64)
                for r in range(rows):
                    h = mix(h + sig[:, r::rows][:, :bands] + band)
                some = np.bincount(doc, minlength=n) > 0
                ends = pa.array(np.concatenate(([0], np.cumsum(some * bands))).astype(np.int32))
                t1, t2 = (pa.array(c.view(np.int64)) for c in w.content())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, n), batch.column(1).slice(i, n), t1, t2, pa.ListArray.from_arrays(ends, pa.array(h[some].ravel().view(np.int64)))], names=["doc_id", "text_key", "t1", "t2", "bands"])

    return docs.mapInArrow(run, _SIG)


def _sets(docs: DataFrame, nodes: DataFrame, k: int) -> DataFrame:
    """(id, signature, regions): one byte of each coordinate, and sorted 64-bit region keys, of ``nodes(id, none, own, text_key)``."""

    def run(batches):
        for batch in batches:
            for i, j, data, off in slices(batch.column(1)):
                n = j - i
                doc, key = cells(Words(data, off))
                sig = (mix(signatures(doc, key, n, k)) & U64(0xFF)).astype(np.uint8)
                key = key[np.lexsort((key, doc))]
                cut = np.searchsorted(doc, np.arange(n + 1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, n), pa.array([row.tobytes() for row in sig], pa.binary()), pa.array([key[a:b].tobytes() for a, b in zip(cut, cut[1:])], pa.binary())],
                    names=["id", "signature", "regions"],
                )

    by = ["none", "own", "text_key"]
    # no size bound is known for nodes: the join is a merge at every size; repeated rows meet in it
    found = docs.selectExpr("doc_id is null none", "coalesce(doc_id, 0) own", "text_key", "text").join(nodes.hint("merge"), by).dropDuplicates(by)
    return found.select("id", "text").mapInArrow(run, "id long, signature binary, regions binary")


def jaccard(x: np.ndarray, y: np.ndarray) -> float:
    """Similarity of two sorted arrays of distinct region keys."""
    both = np.concatenate([x, y])
    both.sort(kind="stable")
    same = int((both[1:] == both[:-1]).sum())
    return same / (len(both) - same) if len(both) else 0.0


def forest(ids: np.ndarray, sig: np.ndarray, sets: list[np.ndarray], similarity: float, root: np.ndarray | None = None, asked: np.ndarray | None = None, deviations: float = 4.5) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Links that join the classes of some texts, each pair of different classes that may be similar being settled exactly; and each text's class.

    Every round takes, for each text, the likeliest unsettled partner of another class.
    ``root``: classes known beforehand; ``asked``: a symmetric mask of the pairs to settle.
    """
    n, k = sig.shape
    least = similarity - deviations * (similarity * (1 - similarity) / k) ** 0.5
    size = np.array([len(s) for s in sets], float)
    near = np.zeros((n, n), np.float32)
    for i in range(n):
        share = (sig[i + 1 :] == sig[i]).mean(axis=1)
        share[np.minimum(size[i + 1 :], size[i]) < similarity * np.maximum(size[i + 1 :], size[i])] = 0
        near[i, i + 1 :] = share
    near = np.maximum(near, near.T)
    near[near < least + (1 - least) / 256] = 0
    if asked is not None:
        near[~asked] = 0
    root, out = np.arange(n) if root is None else root.copy(), []
    while True:
        near[root[:, None] == root[None, :]] = 0
        best = near.argmax(axis=1) if n else np.zeros(0, np.int64)
        some = np.flatnonzero(near[np.arange(n), best] > 0)
        if not len(some):
            return out, root
        for i in some:
            j = best[i]
            if root[i] == root[j] or not near[i, j]:
                continue
            near[i, j] = near[j, i] = 0
            if jaccard(sets[i], sets[j]) >= similarity:
                out.append((int(ids[i]), int(ids[j])))
                root[root == max(root[i], root[j])] = min(root[i], root[j])


def _group(group: pa.Table) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], list]:
    """ids in order, signatures, regions and marks of a group's texts; a text that lies in it twice counts once, its marks joined."""
    at: dict[int, int] = {}
    marks: dict[int, set] = {}
    for i, (x, mark) in enumerate(zip(group.column("id").to_pylist(), group.column("mark").to_pylist(), strict=True)):
        at.setdefault(x, i)
        marks.setdefault(x, set()).add(mark)
    ids = sorted(at)
    take = pa.array([at[x] for x in ids])
    sig, regions = (group.column(c).take(take).to_pylist() for c in ("signature", "regions"))
    return np.asarray(ids), np.frombuffer(b"".join(sig), np.uint8).reshape(len(ids), -1), [np.frombuffer(r, U64) for r in regions], [marks[x] for x in ids]


_LINK = "a long, x long, y long, own int"


def _table(a: int, rows: list[tuple]) -> pa.Table:
    x, y, own = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.table({"a": pa.array([a] * len(rows), pa.int64()), "x": pa.array(x, pa.int64()), "y": pa.array(y, pa.int64()), "own": pa.array(own, pa.int32())})


def links(sets: DataFrame, pairs: DataFrame, similarity: float, block: int = BLOCK) -> DataFrame:
    """(a, b): a forest of the similar texts within every star of ``pairs(a, b)``; a is the centre."""
    sizes = materialise(pairs.groupBy("a").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks")))
    members = materialise(pairs.join(sizes, "a").select("a", F.col("b").alias("id"), "blocks", F.expr("cast(pmod(xxhash64(b), blocks) as int) own")))
    centres = sizes.select("a", F.col("a").alias("id"), "blocks", F.explode(F.expr("sequence(0, blocks - 1)")).alias("own"))

    def with_centre(group: pa.Table) -> pa.Table:
        ids, sig, regions, _ = _group(group)
        centre, own = group.column("a")[0].as_py(), group.column("own")[0].as_py()
        edges, root = forest(ids, sig, regions, similarity)
        rows = [(x, y, own) for x, y in edges]
        if group.column("blocks")[0].as_py() > 1:
            settled = root == root[np.searchsorted(ids, centre)]
            rows += [(int(x), None, own) for x in ids[~settled]]
        return _table(centre, rows)

    first = members.unionByName(centres).withColumn("mark", F.lit(0)).join(sets, "id")
    near = materialise(first.groupBy("a", "own").applyInArrow(with_centre, _LINK))
    loose = near.filter("y is null").select("a", F.col("x").alias("id"), "own")
    loose_sizes = materialise(loose.groupBy("a").agg(F.ceil(F.count("*") / block).cast("int").alias("parts")))
    settled = members.join(loose.select("a", "id"), ["a", "id"], "left_anti").withColumn("mark", F.lit(0)).unionByName(members.join(loose.select("a", "id"), ["a", "id"], "left_semi").withColumn("mark", F.lit(1)))
    others = settled.join(loose_sizes, "a").select("a", "id", "own", "mark", F.explode(F.expr("sequence(0, parts - 1)")).alias("part"))
    asked = loose.select("a", "id").join(loose_sizes, "a").join(sizes, "a").select(
        "a", "id", F.explode(F.expr("sequence(0, blocks - 1)")).alias("own"), F.lit(2).alias("mark"), F.expr("cast(pmod(xxhash64(id, 1), parts) as int) part"),
    )

    def with_loose(group: pa.Table) -> pa.Table:
        ids, sig, regions, marks = _group(group)
        mine = np.array([2 in m for m in marks])
        other = np.array([0 in m or 1 in m for m in marks])
        root = np.arange(len(ids))
        done = np.array([0 in m for m in marks])
        if done.any():
            root[done] = root[done].min()  # all linked to the centre
        both = mine[:, None] & other[None, :]
        edges, _ = forest(ids, sig, regions, similarity, root, both | both.T)
        return _table(group.column("a")[0].as_py(), [(x, y, 0) for x, y in edges])

    second = others.unionByName(asked).join(sets, "id")
    far = materialise(second.groupBy("a", "own", "part").applyInArrow(with_loose, _LINK))
    return near.filter("y is not null").select("x", "y").unionByName(far.select("x", "y")).toDF("a", "b")


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, rows: int = ROWS, bands: int = BANDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_key (hash of the text), text_id (smallest id with the same words), class_id (smallest id of its class), kept (the class's first document)."""
    given = docs.selectExpr("cast(doc_id as long) doc_id", "xxhash64(cast(text as string)) text_key", "cast(text as string) text")
    signs = materialise(signed(given, rows, bands))
    texts = materialise(
        signs.filter(F.size("bands") > 0).groupBy("t1", "t2")
        .agg(F.min(F.expr("struct(doc_id is null as none, doc_id, text_key)")).alias("lead"), F.first("bands").alias("bands"))
        .withColumn("id", F.monotonically_increasing_id())
    )
    members = texts.select("id", F.explode("bands").alias("h"))
    shared = materialise(members.groupBy("h").agg(F.min("id").alias("a"), F.count("*").alias("n")).filter("n > 1").select("h", "a"))
    stars = materialise(members.join(shared, "h").filter("id <> a").select("a", F.col("id").alias("b")).distinct())
    nodes = stars.select(F.explode(F.array("a", "b")).alias("id")).distinct().join(texts.selectExpr("id", "lead.none", "coalesce(lead.doc_id, 0) own", "lead.text_key"), "id")
    sets = materialise(_sets(given, nodes, rows * bands))
    found = links(sets, stars, similarity, BLOCK)
    classes = materialise(components(found).join(texts.select("id", "lead"), "id"))
    heads = classes.groupBy("component").agg(F.min("lead").alias("head"))
    named = materialise(
        texts.select("t1", "t2", "id", "lead").join(classes.join(heads, "component").select("id", "head"), "id", "left")
        .select("t1", "t2", F.col("lead.doc_id").alias("text_id"), F.coalesce("head", "lead").alias("head"))
    )
    discard(shared, sets)
    out = signs.select("doc_id", "text_key", "t1", "t2").join(named, ["t1", "t2"], "left")
    return out.select(
        "doc_id",
        "text_key",
        F.when(F.col("head").isNull(), F.col("doc_id")).otherwise(F.col("text_id")).alias("text_id"),
        F.when(F.col("head").isNull(), F.col("doc_id")).otherwise(F.col("head.doc_id")).alias("class_id"),
        F.expr("head is null or (doc_id <=> head.doc_id and text_key = head.text_key)").alias("kept"),
    )


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "kept")
