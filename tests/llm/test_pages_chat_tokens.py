"""Pages, conversations, piece encoding and packing, against brute force and round trips."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from rosterlens.llm import chat_template as chat, html_suffix as pages, packing, sp_scan


def test_main_text_of_marked_pages():
    page = (
        '<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body><header><h1>Site</h1></header>'
        '<nav><ul><li><a href="/x">menu</a></ul></nav><div class="ad">Buy</div><article><h1>Title</h1><p><b>One &amp; two&nbsp;&#8212; three<br>four<p>Five\n  six'
        '<aside>side</aside><form>f<input type=text></form><div class="comments"><p>reader</p><div>x</div></div><p>Seven</article><footer>&copy;</footer></body></html>'
    )
    assert [t for r, t in pages.blocks(page) if r == pages.ARTICLE] == ["Title", "One & two — three four", "Five six", "Seven"]
    named = '<article><div class="article-header"><h2>T</h2></div><div class="header">h</div><ol class="commentlist"><li>c</ol><p class="address">stays</p><div id="ad-slot-3">ad</div><p>x</p></article>'
    assert [t for r, t in pages.blocks(named) if r == pages.ARTICLE] == ["T", "stays", "x"]
    assert pages.blocks("a < b <b>c</b>") == [(pages.PLAIN, "a < b c")]
    assert pages.blocks("<p>a<!-- x") == [(pages.PLAIN, "a")] and pages.blocks("<script>x") == []


BODY = "The story itself runs on for quite a few words, and then for some more."


@pytest.mark.parametrize(
    "page",
    [
        f"<main><p>{BODY}</p><div class='comments'><article>reader</article></div></main>",
        f"<main><p>{BODY}</p><article class='comment'>reader</article></main>",
        f"<div><p>{BODY}</p></div><section class='related'><article>card</article></section>",
        f"<script>var x = '<article>';</script><p>{BODY}</p>",
        f"<!-- <article> --><p>{BODY}</p>",
        f"<!-- <article> --><nav>menu</nav><main><p>{BODY}</p></main>",
        f"<div class='content has-sidebar'><article>{BODY}</article></div>",
        f"<article class='post with-comments no-sidebar'>{BODY}</article><footer>c</footer>",
        f"<div class='widget'><div><article>{BODY}</article></div></div>",
        f"<div class='widget'><article>{BODY}</article></div><footer>by us</footer>",
        f"<div id='search'><main>{BODY}</main></div><div class='copyright'>by us</div>",
        f"<article></article><p>{BODY}</p>",
        f"<article><p>{BODY}</p><div class='share-buttons'>s</div></article><div class='site-footer'>f</div><section class='post-comments'><article>{BODY} {BODY}</article></section>",
    ],
)
def test_pages_keep_their_text(spark, page):
    rows = pages.main_text(spark.createDataFrame([(1, "http://h.x/1", page)], "page_id long, url string, html string")).collect()
    assert [(r.text, r.n_chars) for r in rows] == [(BODY, len(BODY))]


def test_text_around_a_teaser_stays():
    found = pages.blocks(f"<main><p>{BODY}</p><article>card</article></main>")
    assert found == [(pages.PLAIN, BODY), (pages.ARTICLE, "card")]
    assert pages.blocks(f"<div><p>{BODY}</p></div><article>card</article>") == [(pages.PLAIN, BODY), (pages.ARTICLE, "card")]


def test_host_repeats_decide_unmarked_blocks(spark):
    menu, foot = "Welcome to our great site about many interesting things", "Contact us by mail or phone at any time"
    rows = [(i, f"http://h.x/{i}", f"<body><div>{menu}</div><p>Unique {i} " + " ".join(f"w{i}x{j}" for j in range(30)) + f"</p><p>{foot}</p>", 1) for i in range(5)]
    rows += [(7, None, None, 1), (8, "http://h.x/a", f"<main>{menu}</main>", 1), (9, "http://other/", f"<p>{foot}</p>", 1), (9, "http://other/", f"<p>{foot}</p>", 1)]
    got = pages.main_text(spark.createDataFrame(rows, "page_id long, url string, html string, text int")).collect()
    assert len(got) == len(rows)
    text = {r.page_id: r.text for r in got}
    assert all(text[i].startswith(f"Unique {i} ") and foot not in text[i] for i in range(5))
    assert text[7] == "" and text[8] == menu and text[9] == foot and all(r.n_chars == len(r.text) for r in got)
    assert pages.main_text(spark.createDataFrame(rows, "page_id long, url string, html string, text int").limit(0)).count() == 0


@pytest.mark.parametrize("batch", ["10000", "3"])
def test_suffix_array_against_brute_force(spark, batch):
    """Longest repeats of at least 3 (up to 6) tokens on 2 or 3 distinct pages of a host, for any cut of a shard into batches."""
    r = random.Random(5)
    texts = []
    for page in range(40):
        t = [r.randrange(1, 5) for _ in range(r.randrange(0, 30))]
        texts.append((page % 3, page, t))
    texts += [(0, 100 + i, [9, 9, 9, 9, 8, 8, 8]) for i in range(3)] + [(1, 200, [7] * 40)]
    streams = spark.createDataFrame([(h, c, bytearray(np.array(t, np.uint32).tobytes())) for h, c, t in texts], "host long, content long, tokens binary")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        for least in (2, 3):
            got = {}
            for row in pages.suffix_array(streams, 3, 6, least).collect():
                key = np.frombuffer(row.key, ">u4")
                got[int(key[1]), tuple(int(x) for x in key[2:] if x)] = row.length
            held = {}
            for h, c, t in texts:
                for i in range(len(t)):
                    for n in range(3, min(6, len(t) - i) + 1):
                        held.setdefault((h, tuple(t[i : i + n])), set()).add(c)
            want = {}
            for h, c, t in texts:
                for i in range(len(t) - 2):
                    best = max((n for n in range(3, min(6, len(t) - i) + 1) if len(held[h, tuple(t[i : i + n])]) >= least), default=0)
                    if best:
                        want[h, tuple(t[i : i + 6])] = best
            assert got == want and len(want) > 100
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_names_and_elements_that_look_like_others():
    def kept(page):
        return [t for r, t in pages.blocks(page) if r != pages.CHROME]

    assert pages.blocks(f"<article-card>x</article-card><main>{BODY}</main>") == [(pages.PLAIN, "x"), (pages.ARTICLE, BODY)]
    assert kept(f"<article><section class='commentary'>a</section><p class='navy'>b</p><div class='legal'>c</div><p>{BODY}</p></article>") == ["a", "b", "c", BODY]
    assert kept(f"<article>{BODY}<p>x <math><mi>y</mi></math> <label>l</label> <object>o</object><canvas>z</canvas></p></article>") == [BODY, "x y l oz"]
    assert kept(f"<article>{BODY}<form><label>name</label></form><div class='comments'>c</div><div class='advert'>d</div></article>") == [BODY]
    assert kept(f"<div class='legal'>c</div><article>{BODY}</article>") == [BODY]


@pytest.mark.parametrize("words", [1, 24, 25, 26, 60])
def test_text_outside_an_article_is_judged_by_repeats_whatever_its_size(spark, words):
    """Unique text stays beside an article of 25 words, however long it is; what three pages of the host share goes."""
    rows = []
    for i in range(4):
        own, shared = " ".join(f"o{i}x{j}" for j in range(words)), " ".join(f"menu{j}" for j in range(12))
        rows.append((i, f"http://h.x/{i}", f"<main><h1>Title {i}</h1><div>{shared}</div><div>{own}</div><article>{' '.join(f'a{i}y{j}' for j in range(25))}</article></main>"))
    for r in pages.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect():
        i = r.page_id
        assert r.text.split("\n\n") == [f"Title {i}", " ".join(f"o{i}x{j}" for j in range(words)), " ".join(f"a{i}y{j}" for j in range(25))]


def test_weak_names_inside_articles_are_judged_and_others_go(spark):
    legal, passage = "All rights in this text lie with whoever wrote it first", "A quoted passage that three articles of one host share word by word"
    rows = [
        (i, f"http://h.x/{i}", f"<article><p>{passage}</p><div class='notice'>n {i}</div><div class='alert'>a {i}</div><ul class='replies'><li>r {i}</ul><div class='responses'>s {i}</div><section class='discussion'>d {i}</section>"
         f"<p class='legal'>{legal}<p>body {i}</p><div class='legal'>own {i}<div>deep {i}</div></div><div class='search'><p>{legal}</p></div><p>end {i}</p></article>")
        for i in range(3)
    ]
    got = {r.page_id: r.text.split("\n\n") for r in pages.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: [passage, f"body {i}", f"own {i}", f"deep {i}", f"end {i}"] for i in range(3)}


def test_a_bound_on_compared_tokens_changes_no_cover(spark):
    r = random.Random(3)
    runs = [" ".join(f"s{k}w{j}" for j in range(r.randint(3, 40))) for k in range(12)]
    rows = [(i, f"http://h.x/{i}", "".join(f"<p>{r.choice(runs)} {'u%dx%d ' % (i, k) * r.randint(0, 3)}{r.choice(runs)}</p>" for k in range(6))) for i in range(30)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    texts = [sorted(tuple(x) for x in pages.main_text(df, depth=depth).collect()) for depth in (6, 8, 64)]
    assert texts[0] == texts[1] == texts[2] and any(t[3] for t in texts[0]) and sum(t[3] for t in texts[0]) < sum(len(h) for _, _, h in rows)


def test_very_long_pages(spark):
    """A page of 100,000 unmarked words and copies of a passage on three pages of its host."""
    passage = " ".join(f"p{i}" for i in range(50))
    rows = [(i, f"http://h.x/{i}", f"<div>{passage}</div><p>" + " ".join(f"u{i}x{j}" for j in range(100_000 if i == 0 else 20)) + "</p>") for i in range(3)]
    got = {r.page_id: r.text for r in pages.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert len(got[0].split()) == 100_000 and all("p1 " not in t for t in got.values())


def test_pages_table(spark, data):
    import html as entities
    import re

    given = {r.page_id: r.html for r in spark.read.parquet(f"{data}/pages.parquet").collect()}
    for r in pages.op1_html(spark, data).collect():
        inner = given[r.page_id].split("<article>", 1)[1].split("</article>", 1)[0]
        parts = [" ".join(entities.unescape(re.sub("<[^>]+>", "", x.replace("<br>", " "))).split()) for x in re.split("</?p>|</?h1>", inner)]
        assert r.text == "\n\n".join(x for x in parts if x) and r.n_chars == len(r.text)


def test_escapes_are_reversible():
    into, out = chat.escaper()
    r = random.Random(2)
    for _ in range(20_000):
        t = "".join(r.choice(["<", "s>", "/s>", "\\", "[", "INST]", "/INST]", "</s>", "[INST]", " ", "GEN]", "a"]) for _ in range(r.randint(0, 12)))
        assert out(into(t)) == t and not any(c in into(t) for c in chat.CONTROLS)


def test_template_language():
    c = chat.Compiled("{% set x = 'a' + 'b' %}{{ x }}:{% for m in messages %}{% if loop.first %}^{% elif m.role == 'user' and not false %}u{% else %}{{ m.role | upper }}{% endif %}{% if 1 == 2 %}never{% endif %}{% generation %}{{ m.text | trim }}{% endgeneration %};{% endfor %}{# note #}end")
    got = c.render([{"role": "user", "text": " q "}, {"role": "user", "text": "r"}, {"role": "bot", "text": None}])
    assert "".join(t for t, _ in got) == "ab:^q;ur;BOT;end" and "".join(t for t, m in got if m) == "qr"
    assert chat.fold(chat.parse("a{{ 'b' }}{% if true %}c{% endif %}"), str) == (chat.Text("abc"),)
    for bad in ("{% for x in y %}{% endfor %}", "{% import os %}", "{{ a() }}", "{{ x | evil }}", "{% if a %}", "{{ __import__('os') }}{% for m in messages %}{% endfor %}"):
        with pytest.raises(chat.TemplateError):
            chat.Compiled(bad)
    empty = chat.Compiled("{% for m in messages %}{{ m.__class__ }}{% endfor %}")
    assert "".join(t for t, _ in empty.render([{"text": "x"}])) == ""


def digest(turns):
    loss = "".join(t for r, t in turns if r == "assistant")
    return len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def test_conversations(spark, data):
    want = {}
    for r in sorted(spark.read.parquet(f"{data}/conversations.parquet").collect(), key=lambda r: (r.conv_id, r.turn)):
        want.setdefault(r.conv_id, []).append((r.role or "", r.text or ""))
    want[-1] = [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]
    got = {r.conv_id: r for r in chat.op2_chat(spark, data).collect()}
    assert set(got) == set(want)
    for c, turns in want.items():
        assert (got[c].n_turns, got[c].turns_sha256, got[c].loss_chars, got[c].loss_sha256) == digest(turns)


def test_odd_conversations(spark):
    rows = [(1, 2, "assistant", None, 0), (1, 1, None, "<s>", 0), (None, None, "user", "x", 0), (2, 1, "a [/INST] b", "[INST] é\\", 0), (2, 1, "a [/INST] b", "[INST] é\\", 0), (3, 1, "assistant", "y" * 300_000, 0)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, n_turns int")
    got = {r.conv_id: r for r in chat.digests(df).collect()}
    for c, turns in {1: [("", "<s>"), ("assistant", "")], None: [("user", "x")], 2: [("a [/INST] b", "[INST] é\\")] * 2, 3: [("assistant", "y" * 300_000)]}.items():
        assert (got[c].n_turns, got[c].turns_sha256, got[c].loss_chars, got[c].loss_sha256) == digest(turns)
    spans = {(r.conv_id, r.turn_index): [r.text[s.start : s.end] for s in r.loss] for r in chat.formatted(df).collect()}
    assert spans[3, 0] == ["y" * 300_000] and spans[1, 0] == []
    assert chat.digests(df.limit(0)).count() == 0


def test_head_and_tail_of_a_template(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (2, 0, "assistant", "b"), (None, 0, "user", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    source = "<head>" + chat.TEMPLATE + "<tail>"
    want = {c: "".join(p for p, _ in chat.Compiled(source).render([{"role": r, "text": t} for i, _, r, t in rows if i == c])) for c in (1, 2, None)}
    got = {}
    for r in sorted(chat.formatted(df, source).collect(), key=lambda r: r.turn_index):
        got[r.conv_id] = got.get(r.conv_id, "") + r.text
        assert [r.text[s.start : s.end] for s in r.loss] == {(1, 1): ["a"], (2, 0): ["b"]}.get((r.conv_id, r.turn_index), [])
    assert got == want and all(t.startswith("<head>") and t.endswith("<tail>") for t in got.values())
    assert {r.conv_id: r.formatted_chars for r in chat.digests(df, source).collect()} == {c: len(t) for c, t in want.items()}


@pytest.fixture(scope="module")
def vocabulary():
    return sp_scan.Vocabulary(sp_scan.vocabulary_path())


def test_chunks_join_to_the_best_way(vocabulary):
    v, r = vocabulary, random.Random(3)

    def weight(ids):
        return sum(v.byte_weight if i in v.byte_of else v.weight[v.pieces[i]] for i in ids)

    for _ in range(120):
        t = "".join(r.choice(["the ", "  ", " ", "thing", "ation", "é", "漢字", "▁", "a\n", "internationalization", "\U0010fffe", "\U0010ffff", "\U0010fffd"]) for _ in range(r.randint(1, 30)))
        s, c = sp_scan.symbols(t), r.choice([1, 2, 5, 7, 16, 40])
        assert sp_scan._unmask(sp_scan._mask(s)) == s
        parts = [sp_scan.cut_chunk(s[a : a + c], s[a + c : a + c + 16], lead) for a, lead in zip(range(0, len(s), c), sp_scan.leads(s, c))]
        ways = sp_scan.states(np.stack([sp_scan.transfer(v, p) for p in parts]))
        ids = np.frombuffer(b"".join(sp_scan.trace_chunk(v, p, a, b) for p, (a, b) in zip(parts, ways)), "<u4").tolist()
        whole = np.frombuffer(v.encode([t])[0], "<u4").tolist()
        assert ids == whole and abs(weight(ids) - weight(whole)) < 1e-6 and v.decode(ids) == t == v.decode(whole)


def test_ids_at_equal_weight_do_not_depend_on_the_cut(vocabulary):
    v, r = vocabulary, random.Random(12)
    for _ in range(150):
        t = "".join(r.choice(["a", "aa", "ab", "ba", "ana", "  ", " "]) for _ in range(r.randint(5, 60)))
        s, whole = sp_scan.symbols(t), v.encode([t])[0]
        for c in (1, 3, 8, 25):
            starts = [m.start() for m in sp_scan._WORDS.finditer(s)]
            assert sp_scan.leads(s, c) == [a - max(x for x in starts if x <= a) for a in range(0, len(s), c)]
            parts = [sp_scan.cut_chunk(s[a : a + c], s[a + c : a + c + 16], lead) for a, lead in zip(range(0, len(s), c), sp_scan.leads(s, c))]
            ways = sp_scan.states(np.stack(sp_scan.transfers(v, parts)))
            assert b"".join(sp_scan.traces(v, parts, ways)) == whole


def test_ids_are_those_of_a_unigram_model(vocabulary, data):
    """The public library, given the same weights as a unigram model's scores, finds ways of the same weight, and nearly always the same one."""
    import struct

    import pyarrow.parquet as pq
    import sentencepiece

    def number(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    m = sentencepiece.SentencePieceProcessor(model_file=sp_scan.vocabulary_path())
    model = b""
    for i, piece in enumerate(vocabulary.pieces):  # field 1: a piece is 1 its text, 2 its score, 3 its type
        kind = 2 if m.is_unknown(i) else 3 if m.is_control(i) else 6 if m.is_byte(i) else 5 if m.is_unused(i) else 1
        text = piece.encode()
        body = b"\x0a" + number(len(text)) + text + b"\x15" + struct.pack("<f", vocabulary.weight.get(piece, 0.0)) + b"\x18" + bytes([kind])
        model += b"\x0a" + number(len(body)) + body
    trainer = b"\x18\x01" + b"\x98\x02\x01"  # a unigram model with bytes for what no piece spells
    normalizer = b"\x0a\x08identity" + b"\x18\x01" + b"\x20\x00"  # a mark in front, all spaces kept
    model += b"\x12" + number(len(trainer)) + trainer + b"\x1a" + number(len(normalizer)) + normalizer
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    letters = set("".join(p for p in vocabulary.weight if len(p) == 1)) | {" "}
    same = n = 0
    for t in pq.read_table(f"{data}/documents.parquet")["text"].to_pylist():
        t = "".join(c for c in (t or "")[:3000] if c in letters and c != sp_scan.MARK)
        if not t:
            continue
        theirs, mine = library.encode(t), np.frombuffer(vocabulary.encode([t])[0], "<u4").tolist()
        weight = [sum(vocabulary.weight[vocabulary.pieces[i]] for i in ids) for ids in (theirs, mine)]
        assert abs(weight[0] - weight[1]) < 1e-3 * (1 + len(mine) / 100), (t, theirs, mine)
        same, n = same + (theirs == mine), n + 1
    assert n > 50 and same >= 0.9 * n


def test_pieces_round_trip(spark):
    texts = [None, "", " ", "a", "▁ x  y ", "wörd " * 9000, "z" * 40_000, "\U0010ffff 漢字 \U0001f600 " * 3000, "a"]
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, chunk int")
    encoded = sp_scan.encode(df, chunk=4096)
    got = {}
    for r in sorted(sp_scan.decode(encoded).collect(), key=lambda r: (r.doc_id, r.chunk)):
        got[r.doc_id] = got.get(r.doc_id, "") + r.text
    assert got == {i: t or "" for i, t in enumerate(texts)}
    rows = sp_scan.digest(encoded).collect()
    assert sum(r.n_symbols for r in rows) == sum(r.decoded_symbols for r in rows) == sum(len(t) + 1 for t in texts if t)


def test_decoded_texts_stand_beside_their_sources(spark):
    texts = [None, "", " ", "a", "▁ x  y ", "wörd " * 3000, "z" * 9_000, "\U0010ffff 漢字 \U0001f600 " * 1500, "wörd " * 3000]
    rows = [(None if i == 7 else i % 8, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame([*rows, rows[5], rows[5]], "doc_id long, text string")
    got = sp_scan.encoded_and_decoded(df, chunk=4096).collect()
    assert {(r.doc_id, r.text_chars, r.text_sha256) for r in got} == {(i, len(t or ""), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows}
    assert all((r.decoded_chars, r.decoded_sha256) == (r.text_chars, r.text_sha256) for r in got)
    assert len([r for r in got if r.doc_id == 5]) == 12 and len({r.chunk for r in got if r.doc_id is None}) > 1


def test_decoding_is_seen_in_the_query(spark, data):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    for r in sp_scan.op8_sentencepiece(spark, data).collect():
        t = texts[r.doc_id]
        assert r.decoded_chars == r.text_chars == len(t) and r.decoded_sha256 == r.text_sha256 == hashlib.sha256(t.encode()).hexdigest()
        assert len(r.ids) == r.n_ids and zlib.crc32(np.asarray(r.ids, "<u4").tobytes()) == r.ids_crc32


def test_word_by_word_ids_are_the_vocabularys():
    from tokenizers import Tokenizer

    path = packing.vocabulary_path()
    whole, mine, r = Tokenizer.from_file(path), packing.encoder(path, 50), random.Random(8)
    for _ in range(1500):
        t = "".join(r.choice(["a", "the", " ", " ", "  ", "\n", "don't", "é", "漢", "12", "!?", "<|endoftext|>", "\t", " ", "longerword"]) for _ in range(r.randint(0, 15)))
        assert np.frombuffer(mine(t), "<u4").tolist() == whole.encode(t, add_special_tokens=False).ids, t


def test_level_choice_minimises_the_sum_of_squares():
    r, bins = random.Random(9), packing.SumOfSquares(32)
    for _ in range(600):
        size = r.randint(1, 31)
        n, sums = bins.counts.copy(), {}
        for h in range(32 - size + 1):
            if h == 0 or n[h]:
                m = n.copy()
                m[h] -= h > 0
                m[h + size] += h + size < 32
                sums[h] = int((m * m).sum())
        assert sums[bins.level_for(size)] == min(sums.values())
        bins.place(size, (0, 0, b"\0\0\0\0" * size, size))


def test_packing_table(spark, data):
    from tokenizers import Tokenizer

    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    ids = {i: np.asarray([*Tokenizer.from_file(packing.vocabulary_path()).encode(t, add_special_tokens=False).ids, 0], "<u4") for i, t in texts.items()}
    docs, windows = {}, {}
    for r in packing.op9_packing(spark, data).collect():
        assert r.doc_tokens == len(ids[r.doc_id]) and r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
        docs.setdefault(r.doc_id, []).append((r.start, r.length))
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(docs) == set(texts)
    for parts, total in [(p, len(ids[i])) for i, p in docs.items()] + [(w, None) for w in windows.values()]:
        end = 0
        for start, n in sorted(parts):
            assert start == end
            end += n
        assert end == total if total is not None else end <= 1024 and end & (end - 1) == 0


def test_packing_odd_rows(spark):
    df = spark.createDataFrame([(1, None, 5), (1, None, 5), (None, "", 5), (2, "word " * 5000, 5)], "doc_id long, text string, start int")
    rows = packing.pack(df, window=64).collect()
    assert sorted((r.doc_id or -1, r.doc_tokens) for r in rows if r.doc_id != 2) == [(-1, 1), (1, 1), (1, 1)]
    assert packing.pack(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        packing.pack(df, window=100)
