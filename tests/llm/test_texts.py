"""Pieces, personal data, fingerprints, pages, and the pipeline."""

import hashlib
import os
import random
import re
import sys

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from llm_samples import BENCH, LABELS, varied_texts
from wardlake.llm import fingerprint, html, pieces, pii

needs_model = pytest.mark.skipif(not os.path.exists(pieces.MODEL), reason="no vocabulary file")
TRICKY = [" two  spaces ", "mark ▁ in text", "\n\t\r\n", "naïve 你好 😀 \x00", "   ", "a" * 300, "word▁ ▁word"]


@needs_model
def test_pieces_without_dropout_are_those_of_the_model():
    from sentencepiece import SentencePieceProcessor

    model, vocabulary = SentencePieceProcessor(model_file=pieces.MODEL), pieces.load()
    encoder = pieces.Encoder(vocabulary, rate=0)
    for text in [t for t in varied_texts() if t] + TRICKY:
        ids = encoder.encode(text, 0)
        assert pieces.decode(ids, vocabulary) == text
        if pieces.MARK not in text:
            assert ids.tolist() == model.encode(text)


@needs_model
def test_dropout_varies_and_decodes(make_docs):
    vocabulary = pieces.load()
    text = "the quick brown foxes were jumping over several interesting documents about language models"
    cuts = set()
    for seed in range(6):
        ids = pieces.Encoder(vocabulary, seed=seed, rate=0.3).encode(text, 0)
        assert pieces.decode(ids, vocabulary) == text
        assert pieces.Encoder(vocabulary, seed=seed, rate=0.3).encode(text, 0).tolist() == ids.tolist()
        cuts.add(tuple(ids.tolist()))
    assert len(cuts) == 6
    longest = pieces.Encoder(vocabulary, rate=1.0).encode(text, 0)
    assert len(longest) == len(text) + 1
    texts = varied_texts() + TRICKY
    rows = pieces.encode(make_docs(texts, extra=True), ["doc_id"]).collect()
    assert len(rows) == len(texts) and all(r.lossless for r in rows)
    for r in rows:
        assert r.n_pieces == len(r.pieces) and pieces.decode(np.array(r.pieces), vocabulary) == (texts[r.doc_id] or "")
    assert pieces.encode(make_docs([]), ["doc_id"]).count() == 0


@needs_model
@pytest.mark.parametrize("rate", [0, 0.1, 0.5, 1.0])
def test_units_merged_together_are_those_merged_alone(monkeypatch, rate):
    monkeypatch.setattr(pieces, "_ROWS", 500)
    vocabulary = pieces.load()
    encoder = pieces.Encoder(vocabulary, rate=rate)
    texts = [t for t in varied_texts() if t][:60] + TRICKY + ["the quick brown foxes were jumping over interesting documents", "ab" * 32 + " " + "cd" * 33, "\u2581 \u2581x ÿ\U0001F600 "]
    streams = [i % 3 for i in range(len(texts))]
    for text, stream, got in zip(texts, streams, encoder.encode_all(texts, streams), strict=True):
        skip = pieces.keyed_skip(pieces.SEED, stream, rate, vocabulary)
        assert got.tolist() == [i for unit in pieces._UNIT.findall(" " + text) for i in pieces.encode_unit(unit, vocabulary, skip)]


PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def plain_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")),
                    "card": 16 <= len(digits) <= 19 and plain_luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]
            if good:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


PRIVATE = [
    "mail a.b+c@x-y.example.com, not a@b", "a@b-c.d%e@f.g and x@y.z@q.r", "é你 1.2.3.4 and 1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.255 9.99999999999999999999.1.1",
    "card 4111 1111 1111 1111, 4111-1111-1111-1112, 4111111111111111 12; 4111111111111111", "+1 (507) 555-7343 +12 +1234567 call +49-30-1234567. +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6",
    "8" * 3000, "a" * 5000 + "@" + "b" * 50, "." * 200 + "1.2.3.4", "IBAN DE89370400440532013000 and GB82WEST12345698765432, DE89370400440532013001", "ssn 123-45-6789", "123-45-6789",
    " ".join(f"{i}.{i}.1.2" for i in range(300)), "😀 x@y.zz 😀 x@y.zz"]


def test_personal_data(make_docs):
    texts = PRIVATE + [None, ""]
    rows = {r.doc_id: r for r in pii.report(make_docs(texts, extra=True)).collect()}
    for i, text in enumerate(texts):
        want = plain_spans(text or "")
        assert [s for s in rows[i].spans.split(",") if s and s.split(":")[0] in PLAIN] == want
        assert rows[i].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert (rows[i].n_email, rows[i].n_ip, rows[i].n_card, rows[i].n_phone) == tuple(sum(w.startswith(k) for w in want) for k in PLAIN)
    assert rows[8].spans.count("iban:") == 2 and "iban:5:27" in rows[8].spans
    assert "national_id" in rows[9].spans and "national_id" not in rows[10].spans
    assert rows[3].scores.split(",")[0] == "1.00"
    assert pii.report(make_docs([])).count() == 0


#: Text, whether its number is a national id, score of its first span or None.
NEAR_WORDS = [
    ("significant 123-45-6789", False, None), ("SSN 123-45-6789", True, "0.90"), ("ssn" + "." * 37 + "123-45-6789", True, "0.90"),
    ("ssn" + "." * 38 + "123-45-6789", False, None), ("xssn" + "." * 36 + "123-45-6789", False, None), ("123-45-6789 (SSN)", True, "0.90"),
    ("123-45-6789" + "." * 13 + "ssn", False, None), ("123-45-6789" + "." * 12 + "ssn", True, "0.90"), ("123-45-6789.........nifty", False, None),
    ("ssn 000-45-6789", False, None), ("ssn 666-45-6789", False, None), ("ssn 912-45-6789", False, None), ("ssn 123-00-6789", False, None),
    ("ssn 123-45-0000", False, None), ("ssn 123-45-67890", False, None), ("ssn A123-45-6789", False, None), ("nif123-45-6789", False, None),
    ("hotel +49 30 1234567", False, "0.70"), ("tel+49 30 1234567", False, "0.90"), ("Tel: +49 30 1234567", False, "0.90"),
    ("+49 30 1234567 mobile", False, "0.90"), ("telephone +49 30 1234567", False, "0.90"), ("shipping 1.2.3.4", False, "0.60"),
    ("\u4f60ssn\u4f60 123-45-6789", True, "0.90"), ("discard 4111111111111111", False, "0.80"), ("4111111111111111 Visa", False, "1.00")]


def test_words_near_a_span_count_whole(make_docs):
    rows = {r.doc_id: r for r in pii.report(make_docs([t for t, _, _ in NEAR_WORDS])).collect()}
    for i, (text, national, score) in enumerate(NEAR_WORDS):
        assert ("national_id" in rows[i].spans) == national, text
        assert (rows[i].scores.split(",")[0] or None) == score, text


def test_personal_data_equals_sql(make_docs):
    texts = [t for t, _, _ in NEAR_WORDS] + [t for t in PRIVATE if len(t) < 1000] + [None, ""]
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string())}))
    want = con.execute(pii.SQL)
    names = [d[0] for d in want.description]
    got = pii.report(make_docs(texts)).select(names).collect()
    assert sorted(map(tuple, got)) == sorted(want.fetchall())


def test_fingerprints_of_rows(make_docs):
    texts = varied_texts()
    rows = {r.doc_id: r for r in fingerprint.run_rows(make_docs(texts, extra=True)).collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        own, other = text or "", texts[i - 1 if i else len(texts) - 1] or ""
        changed = fingerprint.edited(own, other)
        mine, edit, follow = fingerprint.fingerprints([own, changed, other])
        r = rows[i]
        assert (r.n_chars, r.edited_sha256) == (len(own), hashlib.sha256(changed.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (fingerprint.shown(mine), fingerprint.shown(edit))
        assert (r.near_edited, r.near_next) == (fingerprint.likeness(mine, edit), fingerprint.likeness(mine, follow))


def test_fingerprints_of_few_rows(make_docs):
    assert fingerprint.run_rows(make_docs([])).count() == 0
    one = fingerprint.run_rows(make_docs(["abcdef"])).first()
    assert one.edited_sha256 == hashlib.sha256(b"abcabc").hexdigest() and one.near_next == 1.0
    rows = fingerprint.run_rows(make_docs(["aaaa", "bbbb", "bbbb"], [None, 4, 4])).collect()
    assert sorted((str(r.doc_id), r.near_next) for r in rows) == [("4", 0.0), ("4", 1.0), ("None", 0.0)]


def test_equal_substrings_share_phrases():
    inner = " ".join(varied_texts()[-1].split()[:400])
    a, b = fingerprint.fingerprints(["prefix of one " + inner, "z" + inner + " end"])
    assert fingerprint.likeness(a, b) > 0.7
    assert fingerprint.likeness(a, fingerprint.fingerprints([" ".join(varied_texts(9)[-1].split()[:400])])[0]) < 0.5


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a="</p><p>no";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/a">Menu</a></li></ul></nav><div class="cookie-notice">We use cookies</div>
<aside>Side {n}</aside><article class="post"><header><h1>Title {n} &amp; more</h1></header><p>First   <b>bold</b>
paragraph {n}.<br>next<p>Second &lt;{n}&gt; &#233;<p>Read our terms of service</p><form><input>Form</form><div class="ad">Buy {n}</div>
<ul><li>one {n}<li>two</ul></article><section id="comments"><article class="comment">Nice {n}</article></section>
<!-- gone <p>x</p> --><footer>&copy; foot {n}</footer></body></html>"""


def test_pages(spark):
    rows = [(i, "http://a.example/x", PAGE.format(n=i)) for i in range(40)] + [(100, None, None), (101, "http://b.example/", ""), (102, "http://c.example", "plain <b>text"),
            (103, "http://d.example/", "<main><p>in main</p></main><p>outside"), (104, "http://a.example/copy", PAGE.format(n=7)), (104, "http://a.example/copy", PAGE.format(n=7))]
    pages = spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, text string")
    got = html.main_texts(pages).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r for r in got}
    for i in range(40):
        assert by[i].text == f"Title {i} & more\nFirst bold paragraph {i}. next\nSecond <{i}> é\none {i}"
        assert by[i].n_chars == len(by[i].text)
    assert by[104].text == by[7].text
    assert [by[i].text for i in (100, 101, 102, 103)] == ["", "", "plain text", "in main"]
    alone = html.extract([PAGE.format(n=1)])[0]
    assert "Read our terms of service" in alone
    assert html.main_texts(pages.limit(0)).count() == 0


def test_copies_of_a_page_are_not_template():
    assert html.extract([PAGE.format(n=3)] * 30)[5] == html.extract([PAGE.format(n=3)])[0]


LONG = "<html><body><div id=top>Site</div><article><h1>{h}</h1>{p}</article></body></html>"


def long_page(name, n, changed=-1):
    return LONG.format(h=f"Title {name}", p="".join(f"<p>{name} says {i} things{' new' if i == changed else ''}</p>" for i in range(n)))


def test_near_copies_of_a_page_are_not_template():
    pages = [long_page("base", 40)] + [long_page("base", 40, i) for i in range(8)] + [long_page("base", 40)]
    pages += [long_page(f"other{i}", 3) for i in range(12)]
    for order in (1, -1):
        got = html.extract(pages[::order])[::order]
        assert got == [html.extract([p])[0] for p in pages]
        assert all(t.count("\n") == 40 for t in got[:10])


def test_every_page_of_a_host_has_a_template(spark):
    pages = [(i, "http://a.example/", LONG.format(h=f"Title {i}", p=f"<p>text {i}<p>more {i}<p>Read our terms")) for i in range(2 * html.CHUNK + 3)]
    pages[0] = (0, "http://a.example/", "")
    pages[html.CHUNK] = (html.CHUNK, "http://a.example/", "<div class=gallery><span>x</span></div>")
    got = {r.page_id: r.text for r in html.main_texts(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    odd = {0: "", html.CHUNK: "x"}
    assert got == {i: odd.get(i, f"Title {i}\ntext {i}\nmore {i}") for i, _, _ in pages}


def test_names_do_not_hide_the_page():
    article = "<article><header class='entry-header'><h1>Head</h1></header><p>Text of it</article>"
    side = "<div class='sidebar'><p>Aside</div><div id=comments><article>Short</article></div>"
    for name in ("content-sidebar-wrap", "layout no-sidebar", "side", "search-page"):
        assert html.extract([f"<body><div class='{name}'>{article}{side}</div></body>"]) == ["Head\nText of it"]
        assert html.extract([f"<body><div class='{name}'><main><p>Text of it</main>{side}</div></body>"])[0] != ""
    got = html.extract([f"<body><p>x</p><div class='content-sidebar-wrap'><p>Long text of the page</p>{side.split('<div id')[0]}</div></body>"])
    assert got == ["x\nLong text of the page"]
    assert html.extract(["<body><p>Long text of the page</p><div class='page-sidebar'>Aside</div></body>"]) == ["Long text of the page"]


def test_tree_matching_is_maximal():
    a, b = html.parse("<div><p>1<ul><li>x</ul><p>2</div>"), html.parse("<div><ul><li>x</ul><p>2<h2>3</h2></div>")
    pairs = [(x.tag, y.tag) for x, y in html.align(a, b)]
    assert sorted(pairs) == sorted([("html", "html"), ("div", "div"), ("ul", "ul"), ("li", "li"), ("p", "p")])


@needs_model
def _most(x, y):
    """Simple tree matching as it is defined, by recursion."""
    if (x.tag, x.name) != (y.tag, y.name):
        return 0
    rows = [[0] * (len(y.blocks) + 1)]
    for p in x.blocks:
        row = [0]
        for j, q in enumerate(y.blocks):
            row.append(max(rows[-1][j + 1], row[j], rows[-1][j] + _most(p, q)))
        rows.append(row)
    return 1 + rows[-1][-1]


def _tree(rng, depth):
    kids = "".join(_tree(rng, depth - 1) for _ in range(rng.randrange(5))) if depth else "x"
    tag = rng.choice(["div", "section", "div class=a"])
    return f"<{tag}>{kids}</{tag.split()[0]}>"


@pytest.mark.parametrize("cells", [1, 6, 1 << 21])
def test_alignment_matches_as_many_nodes_as_the_definition(monkeypatch, cells):
    monkeypatch.setattr(html, "CELLS", cells)
    rng = random.Random(5)
    for _ in range(150):
        a, b = html.parse(_tree(rng, 4)), html.parse(_tree(rng, 4))
        pairs = html.align(a, b)
        assert len(pairs) == _most(a, b)
        met = {id(x): id(y) for x, y in pairs}
        assert len(met) == len(set(met.values())) == len(pairs)
        for x, y in pairs:
            assert (x.tag, x.name) == (y.tag, y.name)
            below = {id(k) for k in y.blocks}
            places = [[id(k) for k in y.blocks].index(met[id(k)]) for k in x.blocks if id(k) in met]
            assert all(met[id(k)] in below for k in x.blocks if id(k) in met) and places == sorted(places)


def test_deep_wide_and_long_pages():
    deep = html.extract(["<div>" * 3000 + "".join(f"<p>text {i} {k}" for k in range(3)) for i in range(8)])
    assert deep == ["\n".join(f"text {i} {k}" for k in range(3)) for i in range(8)]
    held = html.extract(["".join(f"<div>w{k} " for k in range(2000)) + f"<p>end {i}" for i in range(7)])
    assert held[3] == "\n".join([f"w{k}" for k in range(2000)] + ["end 3"])
    assert html.extract(["<div>a" * 2000])[0] == "\n".join(["a"] * 2000)
    wide = ["<div id=top>Site</div>" + "".join(f"<p>{'<b>x</b>' * (k % 3)} {i} {k}</p><ul><li>{k} {i}</li></ul>" for k in range(1500 + i)) for i in range(8)]
    got = html.extract(wide)
    assert all(g.startswith(f"{i} 0\n0 {i}\n") and g.count("\n") == 2 * (1500 + i) - 1 for i, g in enumerate(got))


def test_pipeline(spark, make_docs, tables):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
    import corpus_pipeline

    texts = varied_texts()
    phrase = " ".join(texts[30].split()[:14])
    folder = tables(documents=make_docs(texts), labels=spark.createDataFrame([(i, 1, 0) for i in range(40)], LABELS),
                    benchmark=spark.createDataFrame([("i", phrase)], BENCH))
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, folder).collect()}
    assert 30 not in out and 0 in out
    assert all(r.lossless for r in out.values())
    assert 4 <= len(corpus_pipeline.STAGES) <= 5 and len(out) < len(texts) - 10
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), folder).columns == docs.columns
