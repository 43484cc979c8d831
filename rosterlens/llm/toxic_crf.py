"""Toxicity by a linear-chain conditional random field over words.

A word's tag is toxic or not. Labels exist for documents only, so the training tags come
from them: in labelled-toxic texts, the words whose form or beginning occurs in toxic
training texts and (nearly) nowhere else are tagged toxic (a likelihood-ratio test whose
bar rises from 9 to 15 with the number of toxic texts), every other word is not. The
field has features of the word (form, beginnings), each a weight of its own, and
transition weights between neighbours' tags; it is trained on every text of the sample,
and features that no training text holds have weight 0. Forward-backward gives the
marginals. A document's score is a logistic function, fitted on the training texts, of the
logarithm of 1 + the expected number of toxic words among those likelier toxic than not;
these words are the offending spans.

Forward-backward runs on ratios: one step maps alpha1/alpha0 by a 2x2 matrix, chunks of
words multiply their matrices, chunk ends are joined text by text, and the chunks are
then filled in independently, all texts of a slice at once.

Null and empty texts have no words: their score is that of an expected count of 0. Without
labelled texts of both classes every score is the share of toxic among the labelled
(0 if none is labelled). Labels other than 0 and 1 and labels of unknown texts are
ignored; repeated labels of a text count once, as toxic if any is. Repeated rows get a
score each, rows of one doc_id with different texts each that of its text. Other columns,
whatever their names, are not read; an empty table gives no rows. Texts of any length are
scored whole, in memory proportional to the longest; ties in the order of the sample are
settled by doc_id, then by the hash of the text.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrowtext import U64, Words, mix, slices
from .store import table

CHUNK = 32
SCHEMA = "doc_id long, score double, spans array<struct<start:int,end:int,p:double>>"


@dataclass
class Model:
    prior: float = 0.0
    fitted: bool = False
    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, U64))  # features, sorted
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0, np.float32))
    bias: float = 0.0  # log odds of a tagged word, kept: what a word without known features starts from
    steps: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))  # log weight of tag i then j
    scale: tuple[float, float] = (0.0, 0.0)


def features(w: Words, at: np.ndarray) -> np.ndarray:
    """Hashes of the form and of the beginnings of 4, 5 and 6 bytes of the words ``at``, a row each."""
    out, lo, hi = [w.hash[at]], w.start[at], w.end[at]
    for i, n in enumerate((4, 5, 6)):
        out.append(mix(w.part(lo, np.minimum(lo + n, hi)) + U64(101 + i)))
    return np.stack(out)


def _emissions(model: Model, w: Words) -> np.ndarray:
    """exp(score of toxic against not) of each word."""
    _, first, own = np.unique(w.hash, return_index=True, return_inverse=True)
    e = np.full(len(first), model.bias)
    if len(model.keys):
        for h in features(w, first):
            near = np.minimum(np.searchsorted(model.keys, h), len(model.keys) - 1)
            e += np.where(model.keys[near] == h, model.weights[near], 0)
    return np.exp(np.clip(e, -30, 30))[own]


def marginals(x: np.ndarray, first: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(toxic) of each word, and the expected share of each transition as (words, 4) rows summed to (4,).

    x: exp(score of toxic against not) of each word; first: word offsets of the texts.
    """
    n = len(x)
    if n == 0:
        return np.zeros(0), np.zeros(4)
    t = np.exp(steps)
    size = np.diff(first)
    chunks = -(-size // CHUNK)
    head = np.concatenate(([0], np.cumsum(chunks)))  # chunk offsets of the texts
    total = int(head[-1])
    at = np.arange(n) - np.repeat(first[:-1], size)
    row = np.repeat(head[:-1], size) + at // CHUNK
    col = at % CHUNK
    grid = np.full((CHUNK, total), np.nan)
    grid[col, row] = x
    real = ~np.isnan(grid)
    grid[~real] = 1.0
    # products of the chunks' matrices, as maps of (a0, a1)
    m = np.zeros((total, 2, 2))
    m[:, 0, 0] = m[:, 1, 1] = 1
    for k in range(CHUNK):
        new = m @ t
        new[:, :, 1] *= grid[k][:, None]
        new /= new.max(axis=(1, 2), keepdims=True)
        m = np.where(real[k][:, None, None], new, m)
    # ratios at the chunks' ends, text by text
    lead, tail = np.ones(total), np.ones(total)
    order = np.argsort(-chunks, kind="stable")
    live = chunks[order]
    r = np.full(len(order), np.nan)
    b = np.ones(len(order))
    for k in range(int(live[0]) if len(live) else 0):
        some = order[: int(np.searchsorted(-live, -k, "left"))]
        c = head[some] + k
        lead[c] = r[some] if k else np.nan
        a = m[c]
        given = np.where(np.isnan(r[some]), 1.0, r[some])
        r[some] = (a[:, 0, 1] + given * a[:, 1, 1]) / (a[:, 0, 0] + given * a[:, 1, 0])
        c = head[some + 1] - 1 - k
        tail[c] = b[some]
        a = m[c]
        b[some] = (a[:, 1, 0] + a[:, 1, 1] * b[some]) / (a[:, 0, 0] + a[:, 0, 1] * b[some])
    # inside the chunks; a text starts from both tags alike
    lead = np.where(np.isnan(lead), 1.0, lead)
    fore, back = np.empty_like(grid), np.empty_like(grid)
    r = lead
    for k in range(CHUNK):
        new = grid[k] * (t[0, 1] + r * t[1, 1]) / (t[0, 0] + r * t[1, 0])
        r = fore[k] = np.where(real[k], new, r)
    b = tail
    for k in range(CHUNK - 1, -1, -1):
        back[k] = b
        y = grid[k] * b
        b = np.where(real[k], (t[1, 0] + t[1, 1] * y) / (t[0, 0] + t[0, 1] * y), b)
    f, g = fore[col, row], back[col, row]
    p = f * g / (1 + f * g)
    prev = np.empty(n)
    prev[1:] = f[:-1]
    prev[first[:-1][size > 0]] = 1.0
    y = x * g
    parts = np.stack([np.full(n, t[0, 0]), t[0, 1] * y, prev * t[1, 0], prev * t[1, 1] * y])
    return p, (parts / parts.sum(axis=0)).sum(axis=1)


def _marked(h: np.ndarray, doc: np.ndarray, toxic: np.ndarray, bar: float) -> np.ndarray:
    """Words whose feature (form or beginning) marks toxic texts, by document labels."""
    share = toxic.mean()
    seen, at = np.unique(h, return_inverse=True)
    pair = np.unique(at.astype(np.int64) * len(toxic) + doc)
    which, text = pair // len(toxic), pair % len(toxic)
    bad = np.bincount(which, toxic[text], len(seen))
    good = np.bincount(which, minlength=len(seen)) - bad
    gain = bad * -np.log(share) + np.where(good > 0, good * np.log(np.maximum(good, 1) / (bad + good) / (1 - share)), 0)
    return ((gain > bar) & (good <= 0.02 * bad))[at]


def fit_texts(texts: list[str], toxic: list[int], rounds: int = 12, bar: float = 9.0, part: int = 250_000) -> Model:
    """Fit on the driver from a bounded sample; forward-backward takes texts of about ``part`` words at a time."""
    y = np.asarray(toxic, float)
    if not len(y) or y.min() == y.max():
        return Model(prior=float(y.mean()) if len(y) else 0.0)
    forms, marks, words, sizes = [], [], [], []
    for _, _, data, off in slices(pa.array(texts, pa.large_string())):
        w = Words(data, off)
        form, first, own = np.unique(w.hash, return_index=True, return_inverse=True)
        forms.append(form)
        marks.append(features(w, first))
        words.append(own)
        sizes.append(np.diff(w.first))
    size = np.concatenate(sizes)
    start, doc = np.concatenate(([0], np.cumsum(size))), np.repeat(np.arange(len(y)), size)
    known, first = np.unique(np.concatenate(forms), return_index=True)
    word = np.concatenate([np.searchsorted(known, f)[o] for f, o in zip(forms, words, strict=True)]).astype(np.int32)
    marks = np.concatenate(marks, axis=1)[:, first]  # features of every different word
    keys = np.unique(marks)
    slots = np.searchsorted(keys, marks)
    tag = np.zeros(len(doc), bool)
    for i in range(len(marks)):
        tag |= _marked(marks[i][word], doc, y, bar + 6 * min(1.0, y.sum() / 500))
    z = (tag & y[doc].astype(bool)).astype(float)
    model = Model(float(y.mean()), True, keys, np.zeros(len(keys), np.float32), float(np.log((z.sum() + 1) / (len(z) + 2))))
    before = np.zeros(len(z), int)
    before[1:] = z[:-1]
    before[start[:-1][size > 0]] = -1
    truth = np.array([[((before == i) & (z == j)).sum() for j in (0, 1)] for i in (0, 1)], float)
    cuts = np.unique(np.append(np.searchsorted(start, np.arange(0, len(z), part)), len(y)))
    total, step_sum = np.full(len(keys), 0.1), np.full((2, 2), 1.0)

    def tags(x: np.ndarray):
        """Marginals of all words, and expected transitions."""
        p, steps = np.empty(len(word)), np.zeros(4)
        for a, b in zip(cuts, cuts[1:]):
            some = slice(start[a], start[b])
            p[some], s = marginals(x[word[some]], start[a : b + 1] - start[a], model.steps)
            steps += s
        return p, steps

    def weight() -> np.ndarray:
        return np.exp(np.clip(model.weights[slots].sum(axis=0) + model.bias, -30, 30))

    for _ in range(rounds if len(word) else 0):
        p, steps = tags(weight())
        err = np.bincount(word, p - z, len(known))
        g = np.bincount(slots.ravel(), np.tile(err, len(slots)), len(keys)) + 0.5 * model.weights
        total += g * g
        model.weights = (model.weights - 1.0 * g / np.sqrt(total)).astype(np.float32)
        d = steps.reshape(2, 2) - truth
        step_sum += d * d
        model.steps = model.steps - 0.2 * d / np.sqrt(step_sum)
    c = np.log1p(_count(tags(weight())[0], doc, len(y)))
    a, b = -1.0, 1.0
    for _ in range(60):  # Newton steps of the logistic curve, lightly held back
        q = 1 / (1 + np.exp(-(a + b * c)))
        v = q * (1 - q) + 1e-9
        g = np.array([(q - y).sum() + 1e-2 * a, ((q - y) * c).sum() + 1e-2 * b])
        h = np.array([[v.sum() + 1e-2, (v * c).sum()], [(v * c).sum(), (v * c * c).sum() + 1e-2]])
        step = np.linalg.solve(h, g)
        a, b = a - np.clip(step[0], -1, 1), b - np.clip(step[1], -1, 1)
    model.scale = (float(a), float(b))
    return model


def _count(p: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Expected number of toxic words among those likelier toxic than not."""
    return np.bincount(doc, np.where(p >= 0.5, p, 0.0), n)


def fit(docs: DataFrame, labels: DataFrame, most_docs: int = 4000, most_bytes: int = 8 << 20) -> Model:
    """Fit on a bounded sample: of the labelled texts that aren't held out the first ``most_docs`` by a hash of doc_id, each whole; one that would bring the sample over ``most_bytes`` is passed over."""
    known = (
        labels.selectExpr("cast(doc_id as long) doc_id", "cast(toxic as int) toxic")
        .filter("toxic in (0, 1) and doc_id is not null and crc32(cast(doc_id as string)) % 5 <> 0")
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    texts = docs.selectExpr("cast(doc_id as long) doc_id", "coalesce(cast(text as string), '') text").withColumn("key", F.xxhash64("text"))
    order = ("place", "doc_id", "key")
    first = texts.select("doc_id", "key", F.octet_length("text").alias("size")).join(known, "doc_id").withColumn("place", F.xxhash64("doc_id")).orderBy(*order).limit(most_docs).collect()
    picked, left = {}, most_bytes
    for r in sorted(first, key=lambda r: tuple(r[c] for c in order)):
        if r["size"] <= left and (r["doc_id"], r["key"]) not in picked:
            picked[r["doc_id"], r["key"]] = r["toxic"]
            left -= r["size"]
    if not picked:
        return Model()
    own = docs.sparkSession.createDataFrame([(*k, t) for k, t in picked.items()], "doc_id long, key long, toxic int")
    rows = texts.join(F.broadcast(own), ["doc_id", "key"]).select("doc_id", "key", "toxic", "text").toPandas().drop_duplicates(["doc_id", "key"]).sort_values(["doc_id", "key"])
    return fit_texts(rows["text"].tolist(), rows["toxic"].tolist())


def _scored(m: Model, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, Words | None, np.ndarray]:
    """Score of each text; its words, and their marginals."""
    n = len(off) - 1
    if not m.fitted:
        return np.full(n, m.prior), None, np.zeros(0)
    w = Words(data, off)
    p, _ = marginals(_emissions(m, w), w.first, m.steps)
    return 1 / (1 + np.exp(-(m.scale[0] + m.scale[1] * np.log1p(_count(p, w.doc(), n))))), w, p


def score(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """doc_id, score, and the offending spans (code points) of each row of ``docs(doc_id, text)``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        kinds = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())])
        for batch in batches:
            for i, j, data, off in slices(batch.column(1)):
                n = j - i
                values, w, p = _scored(m, data, off)
                at = np.flatnonzero(p >= threshold)
                doc = np.zeros(0, np.int64)
                lo = hi = doc
                if len(at):
                    doc = w.doc()[at]
                    points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
                    base = points[off[doc]]
                    lo, hi = points[w.start[at]] - base, points[w.end[at]] - base
                spans = pa.StructArray.from_arrays([pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32)), pa.array(p[at])], fields=list(kinds))
                ends = pa.array(np.searchsorted(doc, np.arange(n + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, n), pa.array(values), pa.ListArray.from_arrays(ends, spans)], names=["doc_id", "score", "spans"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(run, SCHEMA)


def keep_clean(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """Rows of ``docs`` whose score is below ``threshold``, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches):
        m = shared.value
        for batch in batches:
            for i, j, data, off in slices(batch.column(at).cast(pa.string())):
                keep = _scored(m, data, off)[0] < threshold
                yield batch.slice(i, j - i).filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select(
        "doc_id",
        F.coalesce(F.expr("crc32(cast(doc_id as string)) % 5 = 0"), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
