"""Licence scan, personal data, toxicity and their text helpers, against brute force."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from rosterlens.llm import license_diag, pii_skipchain as pii, toxic_crf
from rosterlens.llm.arrowtext import Words, slices

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, lang string, spans string"


def docs(spark, *texts):
    return spark.createDataFrame([(i, t, "en", "clash") for i, t in enumerate(texts)], DOCS)


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


def test_words_are_those_of_the_pattern():
    r = random.Random(1)
    texts = ["".join(r.choice("aB9 é-漢\n.[`{~\x00") for _ in range(r.randint(0, 30))) for _ in range(300)] + [None]
    for i, j, data, off in slices(pa.array(texts), 200):
        w = Words(data, off)
        for d, t in enumerate(texts[i:j]):
            own = slice(w.first[d], w.first[d + 1])
            got = [bytes(data[a:b]).decode().translate({c: c + 32 for c in range(65, 91)}) for a, b in zip(w.start[own], w.end[own])]
            assert got == WORD.findall(lower(t or ""))
        again = Words(*next(iter(slices(pa.array(texts[i:j]))))[2:])
        assert (again.hash == w.hash).all() and (again.content()[0] == w.content()[0]).all()


def license_brute(text):
    words, at = WORD.findall(lower(text or "")), []
    labels = set()
    for phrase, label in license_diag.PHRASES.items():
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i : i + len(p)] == p:
                at.append(i)
                labels.add(label)
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def test_license_scan(spark):
    notice = license_diag.TEMPLATES[3][1]
    texts = [None, "", "The MIT License, and the MIT-License.", "x " * 3000 + "Apache license", "GNU General  Public\nLicense mit license", "text before " + notice + " after", notice.replace("use this", "ever use this"), "no such thing", "Licensed under CC BY-NC 4.0.", "The MIT License, and the MIT-License."]
    rows = {r.doc_id: r for r in license_diag.license_scan(docs(spark, *texts)).collect()}
    for i, t in enumerate(texts):
        r = rows[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == license_brute(t)
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1
    assert rows[5].labels == "apache" and rows[6].labels == "apache" and rows[8].labels == "cc-by-nc" and rows[7].labels == "" and rows[7].score == 0
    assert license_diag.license_scan(docs(spark, "x").limit(0)).count() == 0


def test_license_chain_against_brute_force():
    """The longest chain is as long as that of the plain quadratic recurrence, and ascends in both."""
    r = random.Random(4)
    for _ in range(500):
        hits = list({(r.randrange(12), r.randrange(12)) for _ in range(r.randrange(15))})
        got, best = license_diag.chain(hits), {}
        for p, t in sorted(hits):
            best[p, t] = 1 + max((n for (q, u), n in best.items() if q < p and u < t), default=0)
        assert len(got) == max(best.values(), default=0) and set(got) <= set(hits)
        assert all(a[0] < b[0] and a[1] < b[1] for a, b in zip(got, got[1:]))


def test_license_words_in_another_order_are_no_span(spark):
    """Blocks of a notice in another order, joined by a wide slack, meet its grams but aren't the notice; with words put in or left out it is."""
    words = license_diag.TEMPLATES[0][1].split()
    blocks = [" ".join(words[i : i + 12]) for i in range(0, len(words), 12)]
    some = " ".join(w + (" surely" if i % 20 == 10 else "") for i, w in enumerate(words) if i != 31)
    scanned = license_diag.scan(docs(spark, " ".join(blocks), " ".join(blocks[::-1]), some, "a b " + " ".join(blocks) + " c"))
    found = {r.row: (r.first, r.last, r.coverage) for r in license_diag.spans(scanned, slack=40).filter("template = 0").collect()}
    rows = {r.doc_id: r.row for r in scanned.collect()}
    n = len(WORD.findall(lower(" ".join(blocks))))
    assert found[rows[0]] == (0, n - 1, 1.0) and found[rows[3]] == (2, n + 1, 1.0)
    assert rows[1] not in found and 0.75 <= found[rows[2]][2] < 1


def test_license_query_against_brute_force(spark, data):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    rows = license_diag.op10_license(spark, data).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == license_brute(texts[r.doc_id])


def pii_brute(t):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m.group())
        if 14 <= len(d) <= 19 and sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return sorted(out)


PARTS = ["a", "b", "@", "@", ".", ".", "-", "1", "2", "34", "255", "256", "+", " ", "(", ")", "4337166598464399", "+1 (988) 555-2485", "x.y", "é", "@c.d"]


def test_pii_base_spans_fuzzed():
    r = random.Random(5)
    for _ in range(8000):
        t = "".join(r.choice(PARTS) for _ in range(r.randint(0, 14)))
        assert pii.base_spans(t) == pii_brute(t)


def spans_text(spans):
    return ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in spans)


def test_pii_query_against_brute_force(spark, data):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    rows = pii.op7_pii(spark, data).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = pii_brute(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for _, k, _ in base) for i in range(4)]
        assert r.base_sha256 == hashlib.sha256(spans_text(base).encode()).hexdigest()
        assert set(filter(None, spans_text(base).split(","))) <= set(filter(None, r.spans.split(",")))


def test_pii_repeats_share_a_label(spark):
    """A number written in full and repeated without its prefix is found twice; elsewhere such a number isn't."""
    full = [f"call +1 (988) 555-{i:04d} or mail a{i}@b.example now and +1 (988) 555-{i:04d} again" for i in range(40)]
    d = docs(spark, *full, "call +1 (321) 555-7788 today, later (321) 555-7788 works", "only (321) 555-7788 here", None, "", "+1 (321) 555-7788")
    field = pii.fit(pii.candidates(d))
    rows = {r.doc_id: r for r in pii.decode(pii.candidates(d), field).collect()}
    assert rows[40].n_phone == 1 and rows[40].spans.count("phone:") == 2
    assert rows[41].spans == "" and rows[42].spans == "" and rows[43].n_email == 0
    red = {r.doc_id: r for r in pii.redact(d, field).collect()}
    assert red[40].text == "call <PHONE> today, later <PHONE> works" and red[42].text is None and red[44].text == "<PHONE>" and red[44].lang == "en"


@pytest.mark.parametrize("skip", [np.log(50), 6.0])
@pytest.mark.parametrize("chain", [-1.0, 0.0, 1.0])
def test_pii_links_outweigh_neighbours(skip, chain):
    """Every bare repeat is found whatever stands around it; a bare number without a full one isn't, also between two full ones."""
    field = pii.Field(skip=skip, chain=chain)
    full, bare, alone = "+1 (321) 555-7788", "(321) 555-7788", "(444) 555-6666"
    for n in (1, 2, 3, 10, 100):
        for between in (" or ", f" or {alone} or ", f" or {alone} or 222 333 4444 or ", " or +1 (999) 555-0000 or ", " or a@b.example or "):
            for text in (between.join([full] + [bare] * n + [""]), between.join(["", *[bare] * n, full])):
                for i in range(text.count(alone)):  # another number in each place
                    text = text.replace(alone, f"(444) 55{i // 10000 + 6}-{i:04d}", 1)
                spans = [(text[a:b], k) for a, k, b in pii.tagged(pii.nodes(text), field)]
                assert spans.count((bare, 3)) == n and not any(value.startswith("(444)") for value, _ in spans)
                assert chain > 0 or "222 333 4444" not in {value for value, _ in spans}  # in many places beside full ones it may be
    assert len(pii.tagged(pii.nodes(f"+1 (999) 555-0000, {alone}, +1 (999) 555-0001"), field)) == 2


def test_pii_repeats_in_a_corpus_of_bare_numbers(spark):
    """Thousands of bare numbers without a full one don't hide the repeats of those that have one."""
    alone = [f"first ({200 + i % 700}) 555-{i:04d} then ({200 + i % 700}) 444-{i:04d}, mail a{i}@b.example" for i in range(3000)]
    repeated = {n: "+1 (321) 555-7788" + " again (321) 555-7788" * n for n in (1, 2, 3, 10)}
    d = docs(spark, *alone, *repeated.values())
    found = pii.candidates(d)
    rows = {r.doc_id: r for r in pii.decode(found, pii.fit(found)).collect()}
    assert [rows[3000 + i].spans.count("phone:") for i in range(4)] == [n + 1 for n in repeated]
    assert not any("phone:" in rows[i].spans for i in range(3000))


def test_pii_weights_climb_to_the_best_pseudo_likelihood():
    r = np.random.default_rng(2)
    counts = {int(k + 5 * (m + 32 * (a + 6 * b))): float(r.integers(1, 50)) for k in range(5) for m in (0, 1, 4, 9, 16, 25) for a in (0, 3, 5) for b in (1, 4, 5)}

    def loss(w):
        total = 0.05 * sum(x * x for x in w)
        for c, n in counts.items():
            k, rest = c % 5, c // 5
            m, a, b = rest % 32, rest // 32 % 6, rest // 192
            e = [w[y] + (w[5] if m >> y & 1 else 0) + w[6] * ((a == y) + (b == y)) for y in range(5)]
            total -= n * (e[k] - np.log(np.exp(e).sum()))
        return total

    f = pii.climb(counts)
    shift = np.mean(f.labels)
    best = np.array([x - shift for x in f.labels] + [f.skip, f.chain])  # the ridge centres the labels
    for _ in range(200):
        assert loss(best) <= loss(best + r.normal(size=7) * 0.05) + 1e-6


def test_pii_alike_numbers_share_what_speaks_for_them():
    """A bare number beside full ones in several places, none of them its own: alone it stays, its places together make it a span."""
    field = pii.Field(skip=4.0, chain=1.2, labels=(0.0, 0.0, 0.0, 0.0, 2.2))
    near = "+1 (999) 555-0000 or (444) 555-6666 or +1 (999) 555-0001 or 10.0.0.1. "
    for n in (1, 3, 8):
        spans = pii.tagged(pii.nodes(near * n), field)
        assert sum(k == 3 for _, k, _ in spans) == (2 if n == 1 else 3 * n)
    three = "(444) 555-6666 and then (444) 555-6666 and (444) 555-6666"
    assert pii.tagged(pii.nodes(three), field) == []  # nothing speaks for it
    field = pii.Field(skip=4.0, chain=1.2, labels=(0.0,) * 5)
    p = pii.beliefs(pii.nodes(three + " near +1 (999) 555-0001"), field)
    alone = pii.beliefs(pii.nodes("(444) 555-6666 and then (444) 555-6667 and (444) 555-6668 near +1 (999) 555-0001"), field)
    assert p[0, 3] > 1.5 * alone[0, 3]  # evidence at the last place reaches the first


def test_pii_beliefs_against_enumeration():
    """Where hubs close no loop, messages give the exact marginals of nodes and hubs together."""
    import itertools

    field, r = pii.Field(skip=0.9, chain=-0.7, labels=(0.3, 0.0, -0.2, 0.5, 1.0)), random.Random(4)
    for _ in range(12):
        found = sorted((i * 9, i * 9 + 5, r.choice([4, 4, 4, 3]), r.choice(["11111", "22222", f"9999{i}"])) for i in range(4))
        known, hubs = pii.link(found)
        edges = [(i, i + 1, field.chain) for i in range(3)] + [(i, 4 + h, field.skip) for h, own in enumerate(hubs) for i in own]
        if len(edges) > 3 + len(hubs):
            edges = edges[3:]  # the chain and a hub close a loop
            continue
        want = np.zeros((4, 5))
        for y in itertools.product(range(5), repeat=4 + len(hubs)):
            if any(f[2] < 4 and y[i] != f[2] for i, f in enumerate(found)):
                continue
            e = sum(field.labels[y[i]] + field.skip * (y[i] < 4 and known[i][y[i]]) for i, f in enumerate(found) if f[2] == 4)
            e += sum(w * (y[a] == y[b]) for a, b, w in edges)
            for i in range(4):
                want[i, y[i]] += np.exp(e)
        assert np.allclose(pii.beliefs(found, field), want / want.sum(axis=1, keepdims=True), atol=1e-6)


def test_pii_skip_weight_comes_from_repeats():
    """Of every label's repeats, also those of bare numbers: more where they agree."""

    def config(label, mask, count):
        return {label + 5 * (mask + 32 * (5 + 6 * 5)): count}

    plain = config(3, 0, 50.0) | config(4, 0, 50.0)
    for label in (3, 4):
        agree = plain | config(label, 1 << label, 50.0)
        mixed = agree | config(7 - label, 1 << label, 30.0)
        against = plain | config(7 - label, 1 << label, 50.0)
        assert pii.climb(agree).skip > pii.climb(mixed).skip > 0 > pii.climb(against).skip
    found = pii.nodes("(321) 555-7788 or (321) 555-7788 or +1 (999) 555-0000 or (999) 555-0000 or +1 (999) 555-0000")
    assert sorted(c // 5 % 32 for c in pii.configurations(found)) == [8, 8, 16, 16]  # the bare repeat of a full number has no label


def test_pii_odd_rows(spark):
    long = "x" * 5000
    d = spark.createDataFrame([(None, "+1 (321) 555-7788 and (321) 555-7788", 1), (2, f"{long} at {long} dot org, {'y' * 90}@{'z' * 90}.example", 2), (3, None, 3)], "doc_id long, text string, nodes int")
    found = pii.candidates(d)
    rows = {r.doc_id: r for r in pii.decode(found, pii.fit(found)).collect()}
    assert rows[None].spans.count("phone:") == 2 and rows[2].n_email == 1 and rows[3].spans == ""
    assert (0, 10008, 4) in [n[:3] for n in pii.nodes(f"{long} at {long} dot org")] or pii.nodes(f"{long} at {long} dot org")[0][1] == 10_012
    assert pii.decode(found.limit(0), pii.fit(found.limit(0))).count() == 0 and pii.redact(d, pii.fit(found)).columns == d.columns


def test_pii_long_runs_stay_linear():
    for t in ("a at " * 30_000, "1" * 100_000, "a" * 100_000, "@" * 50_000, "a@" * 50_000, "1." * 50_000, "+1" * 50_000):
        pii.nodes(t)


def test_marginals_against_enumeration():
    r = np.random.default_rng(0)
    first = np.array([0, 3, 3, 40, 110])
    x, steps = np.exp(r.normal(size=110)), r.normal(size=(2, 2))
    p, moves = toxic_crf.marginals(x, first, steps)
    t, want, total = np.exp(steps), np.zeros(110), np.zeros(4)
    for a, b in zip(first, first[1:]):
        fore, v = [], np.ones(2)
        for i in range(a, b):
            v = (v @ t) * np.array([1, x[i]])
            fore.append(v)
        v = np.ones(2)
        for i in range(b - 1, a - 1, -1):
            m = fore[i - a] * v
            want[i] = m[1] / m.sum()
            prev = fore[i - a - 1] if i > a else np.ones(2)
            e = prev[:, None] * t * (np.array([1, x[i]]) * v)[None, :]
            total += (e / e.sum()).ravel()
            v = t @ (np.array([1, x[i]]) * v)
    assert np.allclose(p, want) and np.allclose(moves, total)


def _labelled(n, seed):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    texts, y = [], []
    for i in range(n):
        t = [r.choice(words) for _ in range(r.randint(20, 80))]
        bad = i % 5 == 0
        for _ in range(3 if bad else 0):
            t.insert(r.randrange(len(t)), r.choice(["gruk", "gruken", "blarg"]))
        texts.append(" ".join(t))
        y.append(int(bad))
    return texts, y


def test_toxicity_on_held_out_texts(spark):
    texts, y = _labelled(600, 1)
    model = toxic_crf.fit_texts(texts, y)
    new, want = _labelled(200, 2)
    rows = {r.doc_id: r for r in toxic_crf.score(docs(spark, *new, None, ""), model).collect()}
    assert [int(rows[i].score >= 0.5) for i in range(200)] == want
    assert rows[200].score < 0.5 and rows[201].score < 0.5
    assert {new[0][s.start : s.end] for s in rows[0].spans} <= {"gruk", "gruken", "blarg"} and rows[0].spans
    kept = {r.doc_id for r in toxic_crf.keep_clean(docs(spark, *new, None), model).collect()}
    assert kept == {i for i in range(200) if not want[i]} | {200}


@pytest.mark.parametrize("labels", [[], [(0, 1, 1)], [(0, 1, 0), (None, 1, 1), (1, 1, 7)]])
def test_toxicity_without_both_classes(spark, labels):
    d = docs(spark, "a b", None, "")
    model = toxic_crf.fit(d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert {r.score for r in toxic_crf.score(d, model).collect()} <= {0.0, 1.0}


def test_toxicity_query_on_held_out_rows(spark):
    """The registered query: all rows scored, held-out ones named by the rule and called right."""
    import zlib

    base = "/root/testdata/sf0.01"
    rows = toxic_crf.op6_toxicity(spark, base).collect()
    label = {r.doc_id: r.toxic for r in spark.read.parquet(f"{base}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{base}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [(r.predicted, label[r.doc_id]) for r in rows if r.held_out and label.get(r.doc_id) is not None]
    assert sum(a == b for a, b in held) >= 0.95 * len(held) > 50


def test_toxicity_sample(spark):
    """Labels of unknown texts and texts over the bound don't shrink the sample; repeats count once; long texts are scored whole."""
    texts = [("you vile skunkface " if i % 2 else "a calm day ") + f"w{i} and so on" for i in range(400)]
    rows = [(i, t, "clash") for i, t in enumerate(texts)] + [(1, texts[1], "clash"), (500, "x " * 200_000, "clash"), (501, "calm " * 100_000 + "skunkface skunkface skunkface", "clash")]
    d = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)] + [(i, 1) for i in range(10_000, 30_000)] + [(500, 0)], "doc_id long, toxic int")
    model = toxic_crf.fit(d, labels, most_docs=300, most_bytes=100_000)
    got = {r.doc_id: r.score for r in toxic_crf.score(d, model).collect()}
    assert all((got[i] >= 0.5) == (i % 2 == 1) for i in range(400)) and got[500] < 0.5 <= got[501]
    assert toxic_crf.score(d.limit(0), model).count() == 0 and toxic_crf.keep_clean(d.limit(0), model).count() == 0
    assert not toxic_crf.fit(d.limit(0), labels).fitted and not toxic_crf.fit(d, labels.limit(0)).fitted
