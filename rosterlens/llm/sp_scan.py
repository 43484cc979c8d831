"""SentencePiece encoding and decoding by a max-plus parallel scan.

The best segmentation of a text into pieces of a given vocabulary is a max-plus product.
A text becomes symbols: a space is the mark U+2581, one mark is put in front, and a mark
that stands in the text itself is spelled in byte pieces, so decoding gives back every
text. The vocabulary is a merge list, whose piece scores are ranks and no probabilities;
the weight of a piece here is the logarithm of a Zipf probability of its rank, and of a
byte piece a weight below all of them, so bytes are used only for what no piece spells.
The ids are those that a unigram model with these weights gives, not those of the merges.

Weights are whole numbers (millionths of a bit, about), so sums don't depend on their
order, and a small fixed number for each place and length within a word decides between
ways of equal weight. So the ids of a text don't depend on ``chunk``.

Texts of more than ``chunk`` symbols are cut. What a cut can leave behind is the number of
symbols by which a piece reaches over it, a state of at most 15. A chunk's transfer matrix
holds the best weight from every entry state to every exit state; matrices are combined by
an associative max-plus product in a doubling scan, which gives the states at
every cut; then every chunk is traced back on its own between its two states. No piece
holds a mark after another symbol, so at the start of a word the state is 0 and a chunk
with such a place has a matrix of rank one: an entry vector plus an exit vector.

Words are segmented by dynamic programming, all new words of a slice of texts at once, and
frequent words come from a bounded cache.

Decoding reads the ids alone. The query decodes every chunk; the chunks of a document are
decoded in order as one stream, and the length and hash of what comes out stand beside
those of the source text, which Spark computes from the table.

Null texts count as empty; an empty text has no pieces. Texts of any length are encoded
whole, chunk by chunk. Repeated rows get rows each. Other columns, whatever their names, are not read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrowtext import U64, mix
from .store import materialise, table

MARK = "▁"
ALIEN = "\udfff"  # a mark of the text itself; no valid text holds this code
CHUNK = 32768
NEVER = -1e18
UNIT = float(1 << 32)  # of a weight of 1
_PLACES = 4096  # places of a word after which the small numbers repeat
_BASE = U64(0x9E3779B97F4A7C15 | 1)


def vocabulary_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def symbols(text: str) -> str:
    """The symbols of a text, one code point each."""
    return MARK + text.replace(MARK, ALIEN).replace(" ", MARK) if text else ""


_WORDS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


class Vocabulary:
    """Pieces with weights, byte pieces, and a hash table of pieces for arrays of symbols."""

    def __init__(self, path: str, cached_words: int = 300_000):
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = [m.id_to_piece(i) for i in range(m.get_piece_size())]
        self.byte = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if m.is_byte(i)}
        self.byte_of = {i: b for b, i in self.byte.items()}
        usual = [i for i in range(len(self.pieces)) if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i) or m.is_unused(i))]
        self.longest = max(len(self.pieces[i]) for i in usual)
        rank = {i: r for r, i in enumerate(sorted(usual, key=lambda i: (-m.get_score(i), i)))}
        self.weight = {self.pieces[i]: -float(np.log(rank[i] + 10.0)) - np.log(np.log(len(usual))) for i in usual}
        self.id = {self.pieces[i]: i for i in usual}
        self.byte_weight = min(self.weight.values()) - 4.0
        if any(MARK in p.lstrip(MARK) for p in self.weight):
            raise ValueError("a piece holds a mark after another symbol")
        self.text = [p.replace(MARK, " ") for p in self.pieces]
        self._is_byte = np.zeros(len(self.pieces), bool)
        self._is_byte[list(self.byte_of)] = True
        self._tables, left = [], {int(self.hash(np.array([ord(c) for c in p], U64))): i for p, i in self.id.items()}
        for shift in (44, 26, 9, 0):  # each table takes what collided in the one before
            keys, owners, rest = np.zeros(1 << 20, U64), np.full(1 << 20, -1, np.int32), {}
            for h, i in left.items():
                s = (h >> shift) & 0xFFFFF
                if owners[s] < 0:
                    keys[s], owners[s] = h, i
                else:
                    rest[h] = i
            self._tables.append((U64(shift), keys, owners))
            left = rest
            if not left:
                break
        if left:
            raise ValueError("pieces collide in every table")
        whole = lambda x: round(x * (1 << 20)) * UNIT / (1 << 20)
        self._weights = np.full(len(self.pieces) + 1, NEVER)
        for p, i in self.id.items():
            self._weights[i] = whole(self.weight[p])
        self._small = (mix(np.arange(_PLACES * 32, dtype=U64) + U64(1)) >> U64(52)).astype(float).reshape(_PLACES, 32)
        codes = np.arange(0x110000)
        self._single = whole(self.byte_weight) * (1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000)).astype(float)
        self._single_id = np.full(0x110000, -1, np.int32)
        for p, i in self.id.items():
            if len(p) == 1:
                self._single[ord(p)], self._single_id[ord(p)] = whole(self.weight[p]), i
        self.cache: dict[str, tuple[float, bytes]] = {}
        self._most = cached_words

    @staticmethod
    def hash(codes: np.ndarray) -> U64:
        h = U64(0)
        with np.errstate(over="ignore"):
            for c in codes:
                h = h * _BASE + (c + U64(1))
            return mix(np.array([h + U64(len(codes))], U64))[0]

    def find(self, h: np.ndarray) -> np.ndarray:
        """Piece of each hash, -1 for none."""
        out = None
        for shift, keys, owners in self._tables:
            s = ((h >> shift) & U64(0xFFFFF)).astype(np.int64)
            got = np.where(keys[s] == h, owners[s], -1)
            out = got if out is None else np.maximum(out, got)
        return out

    def spell(self, symbol: str) -> list[int]:
        if symbol in self.id:
            return [self.id[symbol]]
        return [self.byte[b] for b in (MARK if symbol == ALIEN else symbol).encode()]

    def _advance(self, words: list[str], limits: list[int] | None, leads: list[int] | None = None):
        """Best weights, last pieces' lengths and ids at every place of every word; all words advance together, a symbol at a time. ``leads``: symbols of each word before what is given of it."""
        n = len(words)
        size = np.fromiter(map(len, words), np.int64, n)
        limit = size if limits is None else np.array(limits, np.int64)
        order = np.argsort(-size, kind="stable")
        start = np.concatenate(([0], np.cumsum(size[order])))[:-1]
        codes = np.frombuffer("".join([words[i] for i in order]).encode("utf-32-le", "surrogatepass"), np.uint32)
        node = start + np.arange(n)
        score = np.full(int(size.sum()) + n, NEVER)
        score[node] = 0.0
        last, piece_at = np.zeros(len(score), np.int32), np.full(len(score), -1, np.int32)
        lengths, bounds = size[order], limit[order]
        lead = np.zeros(n, np.int64) if leads is None else np.array(leads, np.int64)[order] % _PLACES
        single, single_id = self._single[codes], self._single_id[codes]
        codes = codes.astype(U64) + U64(1)
        before: list[np.ndarray] = []  # hashes of the last 1, 2, ... symbols up to the place before
        for p in range(1, (int(lengths[0]) if n else 0) + 1):
            live = int(np.searchsorted(-lengths, -p, "right"))
            at, here = start[:live] + p - 1, node[:live] + p
            code = codes[at]
            rolled = [code] + [h[:live] * _BASE + code for h in before[: self.longest - 1]]
            best = score[here - 1] + single[at] + self._small[(lead[:live] + p - 1) % _PLACES, 1]
            own, size_ = single_id[at], np.ones(live, np.int32)
            best[p - 1 >= bounds[:live]] = NEVER
            for k in range(2, min(p, self.longest) + 1):
                piece = self.find(mix(rolled[k - 1] + U64(k)))
                hit = np.flatnonzero((piece >= 0) & (p - k < bounds[:live]))
                if len(hit):
                    v = score[here[hit] - k] + self._weights[piece[hit]] + self._small[(lead[hit] + p - k) % _PLACES, k]
                    hit, v = hit[v >= best[hit]], v[v >= best[hit]]
                    best[hit], own[hit], size_[hit] = v, piece[hit], k
            score[here], last[here], piece_at[here] = best, size_, own
            before = rolled
        return order, node, lengths, score, last, piece_at

    def best(self, words: list[str], limits: list[int] | None = None, leads: list[int] | None = None) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """For each word: best weight of reaching every place of it, and the length of the last piece there.

        ``limits``: places before which a piece must start. ``leads``: as in ``_advance``.
        """
        order, node, lengths, score, last, _ = self._advance(words, limits, leads)
        back = np.empty(len(words), np.int64)
        back[order] = np.arange(len(words))
        cut = [(int(node[b]), int(node[b] + lengths[b] + 1)) for b in back]
        return [score[a:b] for a, b in cut], [last[a:b] for a, b in cut]

    def trace(self, word: str, last: np.ndarray, place: int) -> list[int]:
        """Ids of the best way to ``place``."""
        out: list[list[int]] = []
        while place > 0:
            k = int(last[place])
            piece = word[place - k : place]
            out.append(self.spell(piece) if k == 1 else [self.id[piece]])
            place -= k
        return [i for ids in reversed(out) for i in ids]

    def words(self, text_symbols: str) -> list[str]:
        return _WORDS.findall(text_symbols)

    def learn(self, words) -> None:
        """Segment the words that aren't cached, all at once."""
        new = list({w for w in words if w not in self.cache})
        if len(self.cache) + len(new) > self._most:
            self.cache.clear()
            new = list(set(words))
        for a in range(0, len(new), 20_000):
            part = new[a : a + 20_000]
            order, node, lengths, score, last, piece_at = self._advance(part, None)
            at, open_, steps = node + lengths, np.arange(len(part)), []
            while len(open_):  # one piece back in every word that isn't at its start
                steps.append((open_, piece_at[at[open_]]))
                at[open_] -= last[at[open_]]
                open_ = open_[at[open_] > node[open_]]
            who, ids = (np.concatenate(c) for c in zip(*reversed(steps), strict=True))
            by = np.argsort(who, kind="stable")
            who, ids = who[by], ids[by]
            ends = np.searchsorted(who, np.arange(len(part) + 1)).tolist()
            spelled = set(who[ids < 0].tolist())
            raw = ids.astype("<u4").tobytes()
            totals = score[node + lengths].tolist()
            for i, w in enumerate(order.tolist()):
                if i in spelled:
                    x = np.asarray(self.trace(part[w], last[node[i] : node[i] + lengths[i] + 1], int(lengths[i])), "<u4").tobytes()
                else:
                    x = raw[4 * ends[i] : 4 * ends[i + 1]]
                self.cache[part[w]] = (totals[i], x)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts, as little-endian unsigned 32-bit numbers."""
        cut = [self.words(symbols(t)) for t in texts]
        self.learn([w for c in cut for w in c])
        return [b"".join([self.cache[w][1] for w in c]) for c in cut]

    def decode(self, ids: list[int] | np.ndarray, first: bool = True) -> str:
        """The text of ids; ``first``: they begin a text, so the mark put in front goes."""
        ids = np.asarray(ids, np.int64)
        if self._is_byte[ids].any():
            out = b"".join(bytes([self.byte_of[i]]) if i in self.byte_of else self.text[i].encode() for i in ids.tolist()).decode()
        else:
            out = "".join(map(self.text.__getitem__, ids.tolist()))
        return out[1:] if first else out


# --- chunks -------------------------------------------------------------------------


@dataclass
class Cut:
    """A chunk's symbols as (rest of a word, whole words, begun word with the symbols that follow the cut)."""

    rest: str
    whole: list[str]
    begun: str
    inside: int  # symbols of ``begun`` that lie in the chunk
    split: bool  # whether a word starts inside
    lead: int  # symbols of the first word that lie before the chunk


def cut_chunk(own: str, ahead: str, lead: int) -> Cut:
    """``lead``: how many symbols of the word of the chunk's first symbol lie before the chunk. ``ahead``: the symbols after the cut that a piece could reach."""
    opens = lead == 0
    words = _WORDS.findall(own)
    tail = _WORDS.findall(words[-1] + ahead)[0] if ahead else words[-1]  # up to the end of the word
    if not opens and own[0] != MARK and len(words) == 1:
        return Cut("", [], tail, len(own), False, lead)
    rest = "" if opens else words.pop(0)
    if not words:
        return Cut("", [], tail, len(own), False, lead)
    last = words.pop()
    return Cut(rest, words, tail, len(last), True, lead)


def transfers(v: Vocabulary, cuts: list[Cut]) -> list[np.ndarray]:
    """For each chunk the best weight from every entry state to every exit state."""
    n = v.longest
    v.learn([w for c in cuts for w in c.whole])
    ask: list[tuple[str, int, int]] = []  # words, the places before which their pieces start, leads
    for c in cuts:
        ask += [(c.rest[s:], len(c.rest) - s, c.lead + s) for s in range(min(n, len(c.rest)))]
        ask += [(c.begun, c.inside, 0)] if c.split else [(c.begun[s:], c.inside - s, c.lead + s) for s in range(min(n, c.inside))]
    scores = iter(v.best(*([a[i] for a in ask] for i in range(3)))[0])
    out = []
    for c in cuts:
        m = np.full((n, n), NEVER)
        if c.split:
            entry = np.full(n, NEVER)
            for s in range(min(n, len(c.rest))):
                entry[s] = next(scores)[-1]
            if len(c.rest) < n:
                entry[len(c.rest)] = 0.0
            exits = next(scores)[c.inside : c.inside + n]
            m[:, : len(exits)] = np.maximum(entry[:, None] + sum(v.cache[w][0] for w in c.whole) + exits[None, :], NEVER)
        else:
            for s in range(min(n, c.inside)):
                x = next(scores)[c.inside - s : c.inside - s + n]
                m[s, : len(x)] = x
            for s in range(c.inside, n):  # a piece over the whole chunk
                m[s, s - c.inside] = 0.0
        out.append(_level(m))
    return out


def _level(m: np.ndarray) -> np.ndarray:
    """Matrices whose largest entry is 0: only differences count, and so they stay small."""
    return np.maximum(m - m.max(axis=(-2, -1), keepdims=True), NEVER)


def transfer(v: Vocabulary, c: Cut) -> np.ndarray:
    return transfers(v, [c])[0]


def compose(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product, over leading axes alike."""
    return np.maximum((a[..., :, :, None] + b[..., None, :, :]).max(axis=-2), NEVER)


def scan(matrices: np.ndarray) -> np.ndarray:
    """Products of all prefixes, by doubling."""
    out, step = matrices.copy(), 1
    while step < len(out):
        out[step:] = _level(compose(out[:-step], out[step:]))
        step *= 2
    return out


def states(matrices: np.ndarray) -> list[tuple[int, int]]:
    """Entry and exit state of every chunk on the best way from state 0 to state 0."""
    reach = scan(matrices)[:, 0, :]
    at, out = 0, []
    for i in range(len(matrices) - 1, -1, -1):
        before = reach[i - 1] if i else np.where(np.arange(matrices.shape[1]) == 0, 0.0, NEVER)
        start = int(np.argmax(before + matrices[i][:, at]))
        out.append((start, at))
        at = start
    return out[::-1]


def traces(v: Vocabulary, cuts: list[Cut], ways: list[tuple[int, int]]) -> list[bytes]:
    """For each chunk the ids of the pieces that start in it, between its entry and exit state."""
    v.learn([w for c in cuts for w in c.whole])
    ask: list[tuple[str, int, int, int]] = []  # word, place before which its pieces start, lead, place to reach
    for c, (entry, exit_) in zip(cuts, ways, strict=True):
        if not c.split:
            ask += [(c.begun[entry:], c.inside - entry, c.lead + entry, c.inside - entry + exit_)] if entry < c.inside else []
        else:
            rest = c.rest[entry:]
            ask += [(rest, len(rest), c.lead + entry, len(rest))] if rest else []
            ask.append((c.begun, c.inside, 0, c.inside + exit_))
    _, lasts = v.best(*([a[i] for a in ask] for i in range(3)))
    parts = iter([np.asarray(v.trace(a[0], last, a[3]), "<u4").tobytes() for a, last in zip(ask, lasts, strict=True)])
    out = []
    for c, (entry, _) in zip(cuts, ways, strict=True):
        if not c.split:
            out.append(next(parts) if entry < c.inside else b"")
        else:
            first = next(parts) if entry < len(c.rest) else b""
            out.append(b"".join([first, *(v.cache[w][1] for w in c.whole), next(parts)]))
    return out


def trace_chunk(v: Vocabulary, c: Cut, entry: int, exit_: int) -> bytes:
    return traces(v, [c], [(entry, exit_)])[0]


@lru_cache(maxsize=2)
def vocabulary(path: str | None) -> Vocabulary:
    """A worker's vocabulary; tasks of one worker share it."""
    return Vocabulary(path or vocabulary_path())


_SOURCE = "text_chars long, text_sha256 string"
_CHUNK = f"doc_id long, text_key long, chunk int, lead long, own string, ahead string, {_SOURCE}"
_IDS = f"doc_id long, chunk int, n_symbols long, ids array<int>, text_key long, {_SOURCE}"


_DIGEST = f"doc_id long, chunk int, n_symbols long, n_ids long, ids_crc32 long, decoded_symbols long, text_key long, {_SOURCE}, decoded_chars long, decoded_sha256 string, ids array<int>"


def _names(schema: str) -> list[str]:
    return [f.split()[0] for f in schema.split(", ")]


def _digest(v: Vocabulary, batch: pa.RecordBatch) -> pa.RecordBatch:
    """``_DIGEST`` of some rows of ``_IDS``."""
    crc, back, n, chars, sha = [], [], [], [], []
    for chunk, ids in zip(batch.column(1).to_pylist(), batch.column(3), strict=True):
        x = np.asarray(ids.values)
        crc.append(zlib.crc32(x.astype("<u4").tobytes()))
        text = v.decode(x, chunk == 0)
        back.append(len(text) + (chunk == 0 and len(x) > 0))
        n.append(len(x))
        chars.append(len(text))
        sha.append(hashlib.sha256(text.encode()).hexdigest())
    columns = [*batch.columns[:3], *(pa.array(c, pa.int64()) for c in (n, crc, back)), *batch.columns[4:], pa.array(chars, pa.int64()), pa.array(sha, pa.string()), batch.column(3)]
    return pa.RecordBatch.from_arrays(columns, names=_names(_DIGEST))


def _mask(text: str) -> str:
    """Symbols as a string that Arrow can hold: the mark of the text itself becomes U+10FFFF, doubled with what is U+10FFFE or U+10FFFF already."""
    return text.replace("\U0010fffe", "\U0010fffe\U0010fffe").replace("\U0010ffff", "\U0010fffe\U0010fffd").replace(ALIEN, "\U0010ffff")


def _unmask(text: str) -> str:
    if "\U0010ffff" not in text and "\U0010fffe" not in text:
        return text
    text = text.replace("\U0010ffff", ALIEN)
    return re.sub("\U0010fffe(.)", lambda m: "\U0010ffff" if m[1] == "\U0010fffd" else m[1], text, flags=re.S)


def _source() -> list:
    return [F.length("text").cast("long").alias("text_chars"), F.sha2("text", 256).alias("text_sha256")]


def leads(s: str, chunk: int) -> list[int]:
    """For every chunk of ``s`` the symbols of its first symbol's word that lie before it; looks a chunk back at most."""
    out, begin = [], 0
    for a in range(0, len(s), chunk):
        if a:
            before = s[a - chunk : a]
            if s[a] == MARK and before[-1] != MARK:
                begin = a
            else:
                head = before if s[a] == MARK else before[: before.rfind(MARK) + 1]
                head = head.rstrip(MARK)
                if head:
                    begin = a - chunk + len(head)
        out.append(a - begin)
    return out


def chunks(docs: DataFrame, chunk: int = CHUNK, longest: int = 16) -> DataFrame:
    """Chunks of the texts of more than ``chunk`` symbols."""

    def run(batches):
        for batch in batches:
            rows = []
            for doc, key, text, size, sha in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                s = symbols(text)
                for i, (a, lead) in enumerate(zip(range(0, len(s), chunk), leads(s, chunk))):
                    rows.append((doc, key, i, lead, _mask(s[a : a + chunk]), _mask(s[a + chunk : a + chunk + longest]), size, sha))
                    if len(rows) == 256:
                        yield out(rows)
                        rows = []
            if rows:
                yield out(rows)

    def out(rows):
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=[f.split()[0] for f in _CHUNK.split(", ")])

    return docs.filter(F.length("text") >= chunk).select("doc_id", F.xxhash64("doc_id", "text").alias("text_key"), "text", *_source()).mapInArrow(run, _CHUNK)


def _encode_short(docs: DataFrame, chunk: int, path: str | None, digested: bool) -> DataFrame:
    def run(batches):
        v = vocabulary(path)
        for batch in batches:
            for a in range(0, len(batch), 256):
                part = [t or "" for t in batch.column(1).slice(a, 256).to_pylist()]
                ids = v.encode(part)
                values = pa.array(np.frombuffer(b"".join(ids), "<u4").astype(np.int32))
                ends = pa.array(np.concatenate(([0], np.cumsum([len(b) // 4 for b in ids]))).astype(np.int32))
                out = pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, len(part)), pa.array([0] * len(part), pa.int32()), pa.array([len(t) + 1 if t else 0 for t in part], pa.int64()), pa.ListArray.from_arrays(ends, values), pa.nulls(len(part), pa.int64()), *(batch.column(i).slice(a, len(part)) for i in (2, 3))],
                    names=_names(_IDS),
                )
                yield _digest(v, out) if digested else out

    return docs.filter(F.length("text") < chunk).select("doc_id", "text", *_source()).mapInArrow(run, _DIGEST if digested else _IDS)


def encode(docs: DataFrame, chunk: int = CHUNK, path: str | None = None) -> DataFrame:
    """Ids of each row of ``docs(doc_id, text)``, one row per chunk: doc_id, chunk, n_symbols, ids (the pieces that start in it), text_key (of texts that are cut), and length and hash of the document's source text."""
    short, long = _encoded(docs, chunk, path)
    return short.unionByName(long)


def _encoded(docs: DataFrame, chunk: int, path: str | None, digested: bool = False) -> tuple[DataFrame, DataFrame]:
    """``encode`` of the texts that are one chunk, and of those that are cut; ``digested`` in the same pass, so that a task has one vocabulary."""
    given = docs.selectExpr("cast(doc_id as long) doc_id", "coalesce(cast(text as string), '') text")
    parts = materialise(chunks(given, chunk))

    def matrices(batches):
        v = vocabulary(path)
        for batch in batches:
            for a in range(0, len(batch), 32):
                part = batch.slice(a, 32)
                cuts = [cut_chunk(_unmask(own), _unmask(ahead), lead) for lead, own, ahead in zip(*(part.column(i).to_pylist() for i in (2, 3, 4)), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([m.tobytes() for m in transfers(v, cuts)], pa.binary())], names=["text_key", "chunk", "matrix"])

    def join(pdf):
        pdf = pdf.sort_values("chunk")
        stack = np.stack([np.frombuffer(b) for b in pdf["matrix"]])
        n = int(stack.shape[1] ** 0.5)
        found = states(stack.reshape(-1, n, n))
        return pdf[["text_key", "chunk"]].assign(entry=[a for a, _ in found], exit=[b for _, b in found])

    def trace(batches):
        v = vocabulary(path)
        for batch in batches:
            for start in range(0, len(batch), 32):
                part = batch.slice(start, 32)
                docs_, numbers, lead, own, ahead, a, b = (c.to_pylist() for c in part.columns[:7])
                own = [_unmask(o) for o in own]
                cuts = [cut_chunk(o, _unmask(x), y) for o, x, y in zip(own, ahead, lead, strict=True)]
                ids = [np.frombuffer(x, "<u4").astype(np.int32) for x in traces(v, cuts, list(zip(a, b, strict=True)))]
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int32())]
                out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip((docs_, numbers, [len(o) for o in own], ids), kinds, strict=True)] + part.columns[7:], names=_names(_IDS))
                yield _digest(v, out) if digested else out

    one = parts.dropDuplicates(["text_key", "chunk"]).select("text_key", "chunk", "lead", "own", "ahead")
    cuts = one.mapInArrow(matrices, "text_key long, chunk int, matrix binary").groupBy("text_key").applyInPandas(join, "text_key long, chunk int, entry int, exit int")
    long = parts.join(materialise(cuts), ["text_key", "chunk"]).select("doc_id", "chunk", "lead", "own", "ahead", "entry", "exit", "text_key", "text_chars", "text_sha256")
    return _encode_short(given, chunk, path, digested), long.mapInArrow(trace, _DIGEST if digested else _IDS)


def digest(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """Per chunk: symbols, number of ids, the ids' CRC, the symbols, length and hash of the text that decoding the ids gives back; length and hash of the document's source text, and the ids."""

    def run(batches):
        v = vocabulary(path)
        for batch in batches:
            for a in range(0, len(batch), 256):
                yield _digest(v, batch.slice(a, 256))

    return encoded.mapInArrow(run, _DIGEST)


def decoded_whole(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(text_key, decoded_chars, decoded_sha256) of every cut text: its chunks are decoded in order, one held at a time."""

    def run(batches):
        v = vocabulary(path)
        key, chars, sha = None, 0, None
        for batch in batches:
            keys, sizes, shas = [], [], []
            for k, chunk, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                if k != key:
                    if key is not None:
                        keys, sizes, shas = [*keys, key], [*sizes, chars], [*shas, sha.hexdigest()]
                    key, chars, sha = k, 0, hashlib.sha256()
                text = v.decode(np.asarray(ids.values), chunk == 0)
                chars += len(text)
                sha.update(text.encode())
            yield out(keys, sizes, shas)
        if key is not None:
            yield out([key], [chars], [sha.hexdigest()])

    def out(keys, sizes, shas):
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(sizes, pa.int64()), pa.array(shas, pa.string())], names=["text_key", "decoded_chars", "decoded_sha256"])

    one = encoded.select("text_key", "chunk", "ids").dropDuplicates(["text_key", "chunk"])
    return one.repartition("text_key").sortWithinPartitions("text_key", "chunk").mapInArrow(run, "text_key long, decoded_chars long, decoded_sha256 string")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, chunk, text) of ``encode``'s rows; a document's text is that of its chunks in order."""

    def run(batches):
        v = vocabulary(path)
        for batch in batches:
            texts = [v.decode(ids, chunk == 0) for chunk, ids in zip(batch.column(1).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["doc_id", "chunk", "text"])

    return encoded.mapInArrow(run, "doc_id long, chunk int, text string")


def encoded_and_decoded(docs: DataFrame, chunk: int = CHUNK, path: str | None = None) -> DataFrame:
    """``digest`` of each chunk of ``docs``; length and hash of the decoded text are the document's, as those of the source text are."""
    short, long = _encoded(docs, chunk, path, True)
    long = materialise(long)
    whole = long.drop("decoded_chars", "decoded_sha256").join(decoded_whole(long, path), "text_key", "left")
    return short.unionByName(whole).drop("text_key")


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded_and_decoded(table(spark, sf_dir, "documents"))
