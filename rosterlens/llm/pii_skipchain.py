"""Personal data by a skip-chain conditional random field.

Nodes are the base matches (email, ip, card, phone patterns) and other number runs and
address-like words of a text; labels are the kinds and 'none'. Distant nodes that repeat
each other (same key) or look alike (same last digits, same local part) share potentials
along skip edges, a star for each key, so that edges grow with nodes: the key's hub is a
variable of its own, which has the label of the key's base matches where it has some, and is
unknown where it has none. Neighbouring nodes share potentials along chain edges.

The weights (one per label, one for skip and one for chain agreement) are trained by
pseudo-likelihood, each node given its neighbours. Base matches are labelled with their
kind, other nodes 'none', except those that repeat a base match: what they are no text
tells, so they take no part. The likelihood is a sum over configurations (label, labels
among skip neighbours, left and right neighbour), of which there are at most 5760, counted
over the whole corpus by Spark; the driver climbs from those counts. Decoding passes messages
along chain edges and between nodes and hubs until they settle; base matches are clamped. A
node becomes a span when one label has a belief above one half: so a number written once in
full and later without its prefix is found in all places, and what speaks for a bare number
in one place counts in the others.

Work and memory per text are proportional to its nodes. Null and empty texts have no
spans; a belief of exactly one half makes none. Repeated rows get a row each; a null doc_id
stays null. ``candidates`` reads no
other columns, whatever their names; ``redact`` passes them by. An empty table gives no
rows. Of base matches that overlap all stay spans; redaction takes the first of them.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrowtext import buffers
from .store import materialise, table

KINDS = ("email", "ip", "card", "phone")
LABELS = (*KINDS, "none")

# The base patterns' parts. The guards before a match only skip starts that
# cannot match, so that long runs take linear time.
_LOCAL = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-".decode())
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_RUN = re.compile(r"\(?[0-9](?:[ ().-]{0,2}[0-9])+")
_AT = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?: ?\[at\] ?| at |\(at\))[A-Za-z0-9-]++(?:(?: ?\[dot\] ?| dot |\.)[A-Za-z0-9-]++)+")
_DIGITS = re.compile(r"[^0-9]+")


def _luhn(digits: str) -> bool:
    d = [int(c) for c in reversed(digits)]
    return (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, kind number, end) of the base matches, in order of start, then kind."""
    out = []
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            out.append((start, 0, m.end()))
            end = m.end()
            at = text.find("@", end)
        else:
            end = max(end, at + 1) if start < at else end
            at = text.find("@", at + 1)
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        d = _DIGITS.sub("", m.group())
        if 14 <= len(d) <= 19 and _luhn(d):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_DIGITS.sub("", m.group())) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def _key(value: str) -> str:
    """What repeats of an entity share: the last ten digits, or the lower-case local part of an address."""
    for mark in ("@", "[at]", "(at)", " at "):
        if mark in value:
            return value.split(mark)[0].strip().lower()
    return _DIGITS.sub("", value)[-10:]


def nodes(text: str) -> list[tuple[int, int, int, str]]:
    """(start, end, base kind or 4, key) of a text's nodes in order of start."""
    base = base_spans(text)
    out = [(s, e, k, _key(text[s:e])) for s, k, e in base]
    lows = [s for s, _, _ in base]
    reach = np.maximum.accumulate([e for _, _, e in base]).tolist() if base else []

    def free(s: int, e: int) -> bool:
        i = bisect_left(lows, e)
        return i == 0 or reach[i - 1] <= s

    taken = 0
    others = [m.span() for m in _RUN.finditer(text)]
    if " at " in text or "at]" in text or "at)" in text:
        others += [m.span() for m in _AT.finditer(text)]
    for s, e in sorted(others):
        value = text[s:e]
        if s >= taken and free(s, e) and ("at" in value or len(_DIGITS.sub("", value)) >= 7):
            out.append((s, e, 4, _key(value)))
            taken = e
    return sorted(out)


@dataclass
class Field:
    """Log weights of agreement along skip and chain edges, and of each of LABELS."""

    skip: float
    chain: float
    labels: tuple[float, ...] | None = None

    def own(self) -> np.ndarray:
        """Log potentials over LABELS of a node that isn't a base match; without trained ones, two neighbours of one label alone stay below one half."""
        if self.labels is not None:
            return np.asarray(self.labels)
        return np.log([1.0] * len(KINDS) + [max(1.0, np.exp(2 * self.chain) - 2)])


def link(found: list[tuple]) -> tuple[np.ndarray, list[list[int]]]:
    """Skip edges: for every node that isn't a base match, the kinds of base matches of its key; and the nodes of each key that several have and no base match (keys of under five characters don't count)."""
    of_key: dict[str, list[int]] = {}
    for i, (_, _, _, key) in enumerate(found):
        if len(key) >= 5:
            of_key.setdefault(key, []).append(i)
    out, hubs = np.zeros((len(found), len(KINDS))), []
    for own in of_key.values():
        kinds = {found[i][2] for i in own} - {len(KINDS)}
        others = [i for i in own if found[i][2] == len(KINDS)]
        if kinds:
            out[np.ix_(others, sorted(kinds))] = 1
        elif len(others) > 1:
            hubs.append(others)
    return out, hubs


EDGE = len(LABELS)  # beyond the first or last node
_MASKS = 1 << len(LABELS)


def configurations(found: list[tuple]) -> list[int]:
    """Of each labelled node its label, labels among its labelled skip neighbours, and left and right neighbour, as one number."""
    of_key: dict[str, np.ndarray] = {}
    for _, _, kind, key in found:
        if len(key) >= 5:
            of_key.setdefault(key, np.zeros(len(LABELS), int))[kind] += 1
    sides, out = [EDGE, *(f[2] for f in found), EDGE], []
    for i, (_, _, kind, key) in enumerate(found):
        alike = of_key.get(key)
        based = alike is not None and alike[: len(KINDS)].any()
        if kind == len(KINDS) and based:
            continue
        mask = 0
        if alike is not None:
            near = alike - (np.arange(len(LABELS)) == kind) > 0
            near[len(KINDS)] &= not based  # beside a base match those have no label
            mask = int(near @ (1 << np.arange(len(LABELS))))
        out.append(kind + len(LABELS) * (mask + _MASKS * (sides[i] + 6 * sides[i + 2])))
    return out


def climb(counts: dict[int, float], ridge: float = 0.1, rounds: int = 60) -> Field:
    """Weights of the largest pseudo-likelihood of counted configurations, by Newton steps."""
    code = np.array(sorted(counts), np.int64)
    weight = np.array([counts[c] for c in code], float)
    label, rest = code % len(LABELS), code // len(LABELS)
    skip, left, right = rest % _MASKS, rest // _MASKS % 6, rest // (6 * _MASKS)
    n, names = len(code), np.arange(len(LABELS))
    x = np.zeros((n, len(LABELS), len(LABELS) + 2))  # of every label that a node could have
    x[:, names, names] = 1
    x[:, :, -2] = skip[:, None] >> names & 1
    x[:, :, -1] = (left[:, None] == names).astype(int) + (right[:, None] == names)
    truth = x[np.arange(n), label]
    w = np.zeros(x.shape[2])
    for _ in range(rounds):
        e = x @ w
        p = np.exp(e - e.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        mean = (p[:, :, None] * x).sum(axis=1)
        slope = (weight[:, None] * (truth - mean)).sum(axis=0) - ridge * w
        bend = np.einsum("n,nl,nli,nlj->ij", weight, p, x, x) - np.einsum("n,ni,nj->ij", weight, mean, mean) + ridge * np.eye(len(w))
        w = w + np.clip(np.linalg.solve(bend, slope), -1, 1)
    return Field(float(w[-2]), float(w[-1]), tuple(float(b - w[len(KINDS)]) for b in w[: len(LABELS)]))


def fit(found: DataFrame, prior: float = 3.0) -> Field:
    """Weights trained on the configurations of all nodes of ``candidates``; at most 5760 counts reach the driver.

    ``prior``: agreements along skip edges taken as seen beforehand for each kind and each
    pair of like neighbours, and 'none' nodes between two neighbours of that kind: so few
    that any corpus with repeats outweighs them, and enough that one without still has links
    that count whatever stands around them.
    """
    rows = found.select(F.explode("configs").alias("config")).groupBy("config").count().collect()
    counts = {r["config"]: float(r["count"]) for r in rows}
    for k in range(len(KINDS)):
        agree = [(k, 1 << k, side) for side in (EDGE, len(KINDS), *range(len(KINDS)))]
        for label, skip, side in [*agree, (len(KINDS), 0, k)]:
            config = label + len(LABELS) * (skip + _MASKS * (side + 6 * side))
            counts[config] = counts.get(config, 0.0) + prior
    return climb(counts)


def beliefs(found: list[tuple], field: Field, rounds: int = 200, settled: float = 1e-6) -> np.ndarray:
    """Label marginals of a text's nodes by message passing until no message moves; base nodes are clamped."""
    n, labels = len(found), len(LABELS)
    known, hubs = link(found)
    own = np.zeros((n + len(hubs), labels))  # hubs stand behind the nodes
    own[:n] = field.own()
    own[:n, : len(KINDS)] += field.skip * known
    kind = np.asarray([f[2] for f in found])
    sure = np.flatnonzero(kind < len(KINDS))
    own[sure] = -20.0
    own[sure, kind[sure]] = 0.0
    ends = [np.arange(n - 1), *(np.asarray(h) for h in hubs)]
    starts = [np.arange(1, n), *(np.full(len(h), n + i) for i, h in enumerate(hubs))]
    src, dst = np.concatenate([*starts, *ends]), np.concatenate([*ends, *starts])
    m = len(src) // 2
    gain = np.expm1(np.where((src >= n) | (dst >= n), field.skip, field.chain))[:, None]  # agreement weighs exp(weight), the rest 1
    back = np.concatenate([np.arange(m, 2 * m), np.arange(m)])
    message = np.zeros((2 * m, labels))
    total = own
    for _ in range(rounds if m else 0):
        out = total[src] - message[back]
        p = np.exp(out - out.max(axis=1, keepdims=True))
        new = np.log(p.sum(axis=1, keepdims=True) + p * gain)
        new -= new.max(axis=1, keepdims=True)
        moved = np.abs(new - message).max()
        message = 0.5 * message + 0.5 * new
        total = own.copy()
        for c in range(labels):
            total[:, c] += np.bincount(dst, message[:, c], len(own))
        if moved < settled:
            break
    p = np.exp(total - total.max(axis=1, keepdims=True))
    return (p / p.sum(axis=1, keepdims=True))[:n]


def tagged(found: list[tuple], field: Field) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all spans: base nodes and those whose best label has a belief above one half."""
    spans = [(s, k, e) for s, e, k, _ in found if k < len(KINDS)]
    if len(spans) < len(found) and spans:
        p = beliefs(found, field)
        best = p.argmax(axis=1)
        spans += [(f[0], int(c), f[1]) for f, c, row in zip(found, best, p, strict=True) if f[2] == len(KINDS) and c < len(KINDS) and row[c] > 0.5]
    return sorted(spans)


_NODE = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.int32()), ("key", pa.string())])
_FOUND = "doc_id long, nodes array<struct<start:int,end:int,kind:int,key:string>>, configs array<int>"


def _small(batches, rows: int = 256):
    """Batches of at most ``rows`` rows, so that what is held beside the texts stays small."""
    for batch in batches:
        for a in range(0, len(batch), rows):
            yield batch.slice(a, rows)


def _worth(column: pa.Array) -> np.ndarray:
    """Rows with a digit, an @ or a bracket: the others have no nodes."""
    data, off = buffers(column)
    marks = np.zeros(256, bool)
    marks[[*range(48, 58), 64, 91, 40]] = True
    c = np.concatenate(([0], np.cumsum(marks[data[off[0] : off[-1]]]))) if len(off) > 1 else np.zeros(1, int)
    return c[off[1:] - off[0]] > c[off[:-1] - off[0]]


def candidates(docs: DataFrame) -> DataFrame:
    """Nodes of each text of ``docs(doc_id, text)``, and the configurations of the labelled ones."""

    def run(batches):
        for batch in _small(batches):
            rows, configs = [], []
            for hit, text in zip(_worth(batch.column(1)), batch.column(1), strict=True):
                found = nodes(text.as_py() or "") if hit or " at " in (text.as_py() or "") else []
                rows.append([dict(zip(("start", "end", "kind", "key"), f, strict=True)) for f in found])
                configs.append(configurations(found) if found else [])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(_NODE)), pa.array(configs, pa.list_(pa.int32()))], names=["doc_id", "nodes", "configs"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(run, _FOUND)


_SPANS = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def decode(found: DataFrame, field: Field) -> DataFrame:
    """Counts and digest of base spans, and all spans, of each row of ``candidates``."""

    def text_of(spans) -> str:
        return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)

    def run(batches):
        for batch in batches:
            out = []
            for doc, rows in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                f = [(r["start"], r["end"], r["kind"], r["key"]) for r in rows or ()]
                base = sorted((s, k, e) for s, e, k, _ in f if k < 4)
                out.append((doc, *(sum(k == i for _, k, _ in base) for i in range(4)), hashlib.sha256(text_of(base).encode()).hexdigest(), text_of(tagged(f, field))))
            columns = list(zip(*out, strict=True)) if out else [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if i > 4 else pa.int64()) for i, c in enumerate(columns)], names=[c.split()[0] for c in _SPANS.split(", ")])

    return found.select("doc_id", "nodes").mapInArrow(run, _SPANS)


def redact(docs: DataFrame, field: Field) -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets; overlapping spans count as the first; n_chars follows the text."""
    text_at = docs.columns.index("text")
    count_at = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def run(batches):
        for batch in _small(batches):
            column = batch.column(text_at)
            new = column.to_pylist()
            for i, hit in enumerate(_worth(column)):
                if new[i] and (hit or " at " in new[i]):
                    text, out, end = new[i], [], 0
                    for s, k, e in tagged(nodes(text), field):
                        if s >= end:
                            out += [text[end:s], f"<{KINDS[k].upper()}>"]
                        end = max(end, e)
                    new[i] = "".join([*out, text[end:]]) if end else text
            columns = list(batch.columns)
            columns[text_at] = pa.array(new, batch.schema.field(text_at).type)
            if count_at is not None:
                columns[count_at] = pa.array([None if t is None else len(t) for t in new]).cast(batch.schema.field(count_at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = materialise(candidates(table(spark, sf_dir, "documents")))
    return decode(found, fit(found))
