"""Language filters, pieces, licenses, pages: against references, and odd rows."""

import html
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import html_text, langid, licenses
from tessera.llm import sentencepiece as sp
from tests.llm.conftest import SF_SMALL, SF_TINY, odd_documents


# -- language filters ----------------------------------------------------------------------

def test_languages_of_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == 1000 and any(r.held_out for r in got)
    right = [r.lang == r.lang_pred for r in got if r.held_out]
    assert sum(right) >= 0.99 * len(right)
    assert all(0 <= r.score <= 1 for r in got)


def test_languages_of_odd_rows(spark, docs):
    odd = odd_documents(spark, ["12 34 !!", "x"])
    got = {r.doc_id: r for r in langid.predict(odd, langid.train(docs)).collect()}
    for d in (1, 2, 3, 10, 100):
        assert (got[d].lang_pred, got[d].score) == ("und", 0.0)
    assert got[4].lang_pred == "en" and got[101].lang_pred in ("de", "en", "es", "fr")
    none = langid.identify(odd.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in none} == {"und"} and len(none) == odd.count()
    assert langid.identify(odd.limit(0)).count() == 0


def test_bit_slices_answer_all_languages_at_once():
    rng = np.random.default_rng(1)
    sets = [rng.integers(0, 2**63, 3000).astype(np.uint64) for _ in range(70)]
    f = langid.Filters([f"l{i}" for i in range(70)], sets)
    assert f.table.shape[1] == 2
    for i, s in enumerate(sets):
        bit = (f.masks(s)[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)
        assert bit.all()                                        # no false negative
    other = rng.integers(0, 2**63, 20_000).astype(np.uint64)
    seen = ((f.masks(other)[:, 0] >> np.uint64(5)) & np.uint64(1)).mean()
    assert abs(seen - f.false[5]) < 0.01


def test_grams_by_hand():
    def by_hand(t):
        s = " " + re.sub(r"[\W\d_]+", " ", (t or "").lower()).strip() + " "
        return max(0, len(s) - 3) if s.strip() else 0
    texts = ["The cat", "", "  x", None, "été 12 ab", "Straße--und so", "a" * 50]
    g, owner, letters = langid.grams(texts)
    assert np.bincount(owner, minlength=len(texts)).tolist() == [by_hand(t) for t in texts]
    assert letters.tolist() == [sum(c.isalpha() for c in t or "") for t in texts]


# -- pieces --------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def encoder():
    return sp.Encoder(sp.Vocabulary.load(sp.MODEL))


def test_segmentation_is_the_librarys_unigram(encoder):
    pb = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    import sentencepiece
    m = pb.ModelProto()
    with open(sp.MODEL, "rb") as f:
        m.ParseFromString(f.read())
    m.trainer_spec.model_type = 1                               # unigram over the same pieces
    lib = sentencepiece.SentencePieceProcessor(model_proto=m.SerializeToString())
    words = ("the of internationalisation vieux über straße función token naïve café of the and "
             "reproducibility zwölf Donaudampfschiff").split()
    ids, at = encoder.encode(words)
    # the library's n-best search; its plain encode takes a short cut at some words
    best = [lib.nbest_encode(w, nbest_size=2)[0] for w in words]
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == best


def test_best_segmentation_by_brute_force(encoder):
    v = encoder.vocabulary
    index = {p: i for i, p in enumerate(v.pieces) if v.normal[i]}

    def best(word):
        if not word:
            return 0.0
        return max((v.scores[index[word[:k]]] + best(word[k:]) for k in range(1, len(word) + 1)
                    if word[:k] in index), default=-1e18)

    for w in ("▁then", "▁retier", "abcd", "▁é"):
        got = sum(v.scores[i] for i in encoder.segment(w.encode()))
        assert got == best(w.encode())


def test_block_and_single_segmentation_agree(encoder):
    rng = np.random.default_rng(3)
    letters = np.array(list("aeionrtsth▁éß漢😀<0x"))
    words = ["".join(rng.choice(letters, rng.integers(1, 25))) for _ in range(500)]
    raw = [w.encode() for w in words]
    for got, w in zip(encoder._segment_block(raw), raw):
        assert got.tolist() == encoder.segment(w)


def test_round_trip_and_odd_rows(spark, docs):
    odd = odd_documents(spark, ["▁", "a▁b ▁▁c", "日本😀x\n\n y\t\r\n", "x" * 5000, "<0x41> <s>", "  "])
    for table in (docs, odd):
        got = sp.encode(table).collect()
        assert len(got) == table.count() and all(r.exact for r in got)
        assert all(r.n_tokens == len(r.ids) for r in got)
    assert [r.n_tokens for r in got if r.doc_id in (1, 2)] == [0, 0]
    assert sp.encode(odd.limit(0)).count() == 0


def test_full_chunk_cache_changes_no_ids(encoder, monkeypatch):
    texts = ["one two", "a▁b", "three four ▁", "▁▁ five", "six"]
    want = [encoder.encode([t])[0].tolist() for t in texts]
    monkeypatch.setattr(sp, "MAX_CHUNKS", 1)
    decode = sp.decoder(encoder.vocabulary)
    for _ in range(2):
        for t, ids in zip(texts, want):
            assert encoder.encode([t])[0].tolist() == ids and decode(ids) == t


# -- licenses ------------------------------------------------------------------------------

def test_license_lines_of_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = {r.doc_id: r.license for r in licenses.scan(licenses.document_paths(docs)).collect()}
    names = {"MIT License": "MIT", "Apache License": "Apache-2.0", "GNU General": "GPL-3.0",
             "CC BY-NC": "CC-BY-NC-4.0"}
    for r in docs.collect():
        own = {n for k, n in names.items() if k in r.text}
        assert got[r.doc_id] in own if own else got[r.doc_id] is None


def test_nearest_directory_wins(spark):
    files = spark.createDataFrame([
        (1, "a/LICENSE", "Released under the MIT License."), (2, "a/b/c/x.py", "code"),
        (3, "a/b/COPYING", "This work is licensed under the GNU General Public License, version 3."),
        (4, "a/y", None), (5, "z/y", "hello"), (6, None, None), (8, "ab/q", ""),
        (7, "a/b/q", "# Licensed under the Apache License, Version 2.0. See more of it."),
        (9, "a/b/q", "# Licensed under the Apache License, Version 2.0. See more of it."),
        (10, "a/c/notes", "Released under the MIT License. " + "Long text of something else. " * 50),
        (11, "a/c/other", "nothing here about any of this")], "doc_id long, path string, text string")
    files = files.selectExpr("*", "'x' AS license", "1 AS dir", "2 AS score")
    got = {r.doc_id: (r.license, r.found) for r in licenses.scan(files).collect()}
    assert got == {1: ("MIT", "file"), 2: ("GPL-3.0", "inherited"), 3: ("GPL-3.0", "file"),
                   4: ("MIT", "inherited"), 5: (None, None), 6: (None, None), 8: (None, None),
                   7: ("Apache-2.0", "header"), 9: ("Apache-2.0", "header"),
                   10: ("MIT", "header"), 11: ("MIT", "inherited")}
    assert licenses.scan(files.limit(0)).count() == 0


GPL_2 = """{0}This program is free software; you can redistribute it and/or modify
{0}it under the terms of the GNU General Public License as published by
{0}the Free Software Foundation; either version 2 of the License, or
{0}(at your option) any later version.
{0}
{0}This program is distributed in the hope that it will be useful,
{0}but WITHOUT ANY WARRANTY; without even the implied warranty of
{0}MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."""


def wrapped(parts, mark=""):
    return "\n".join(mark + line.strip() for part in parts
                     for line in [*re.findall(r".{1,65}(?:\s|$)", part), ""])


def test_standard_headers_tags_and_files(spark):
    mit = "MIT License\n\nCopyright (c) 2020 A B\n\n" + wrapped((*licenses._MIT, licenses._MIT_WARRANTY))
    code = "\n\nint main(void) { return 0; }\n" * 40
    apache = wrapped(licenses._APACHE, "# ")
    three, lesser = GPL_2.replace("version 2", "version 3"), GPL_2.replace(
        "GNU General", "GNU Lesser General").replace("version 2", "version 2.1")
    cases = [("SPDX-License-Identifier: Apache-2.0", "Apache-2.0"),
             ("// SPDX-License-Identifier: MIT", "MIT"),
             ("# SPDX-License-Identifier: GPL-3.0-or-later", "GPL-3.0"),
             ("/* SPDX-License-Identifier: GPL-2.0-only */", "GPL-2.0"),
             ("This file is MIT licensed.", "MIT"), (GPL_2.format(" * "), "GPL-2.0"),
             (GPL_2.format("# "), "GPL-2.0"), (three.format(""), "GPL-3.0"),
             (lesser.format("// "), "LGPL-2.1"), (apache, "Apache-2.0"), ("/*\n" + mit + "*/", "MIT"),
             ("Licensed under the Foo License.", None),
             ("All rights reserved. No license is granted.", None),
             ("He copied the license of a driver, with permission of the court.", None)]
    rows = [(i, f"r{i}/a.c", text + code) for i, (text, _) in enumerate(cases)]
    rows += [(100, "lib/LICENSE", mit), (101, "lib/x/y.c", code),
             (102, "lib/z.c", GPL_2.format("-- ") + code), (103, "own/text.md", mit),
             (104, "own/deep/er/a", None), (105, "long/a", code * 500 + apache)]
    files = spark.createDataFrame(rows, "doc_id long, path string, text string")
    got = {r.doc_id: (r.license, r.found) for r in licenses.scan(files).collect()}
    assert {i: got[i][0] for i in range(len(cases))} == {i: c[1] for i, c in enumerate(cases)}
    assert got[100] == ("MIT", "file") and got[101] == ("MIT", "inherited")
    assert got[102] == ("GPL-2.0", "header") and got[103] == ("MIT", "file")
    assert got[104] == ("MIT", "inherited") and got[105] == ("Apache-2.0", "header")


def test_licenses_of_odd_rows(spark):
    odd = odd_documents(spark, ["This file is MIT licensed."])
    got = {repr(r.doc_id): r.license for r in licenses.scan(licenses.document_paths(odd)).collect()}
    assert got["100"] == "MIT" and set(got.values()) == {None, "MIT"}


def test_cosine_by_hand(spark):
    rows, idf, rare = licenses.template_weights()
    line = "Licensed under the Apache License, Version 2.1"
    x = {}
    for t in re.findall("[a-z0-9]+", line.lower()):
        x[t] = x.get(t, 0) + idf.get(t, rare)
    norm = sum(v * v for v in x.values()) ** 0.5
    dots = {}
    for i, name, t, w in rows:
        dots[(i, name)] = dots.get((i, name), 0) + w * x.get(t, 0)
    (_, name), dot = max(dots.items(), key=lambda kv: kv[1])
    got = licenses.best_template(spark, spark.createDataFrame([(1, line)], "k int, part string"),
                                 ["k"]).collect()
    assert [(r.license, r.score) for r in got] == [(name, round(dot / norm, 6))]


# -- pages ---------------------------------------------------------------------------------

def test_article_of_every_page(spark):
    pages = spark.read.parquet(f"{SF_TINY}/pages.parquet")
    got = {r.page_id: r for r in html_text.extract(pages).collect()}
    assert len(got) == pages.count()
    for r in pages.collect():
        article = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        blocks = re.split(r"</?(?:p|h1)>", article.replace("<br>", " "))
        lines = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in blocks]
        assert got[r.page_id].text == "\n".join(x for x in lines if x)
        assert got[r.page_id].n_chars == len(got[r.page_id].text)


MARKUP = """<html><body class="has-sidebar"><header><h1>Site</h1></header><ul class="menu"><li>a<li>b
</ul><main><div class="cookie-notice">Accept</div><h2>Title &amp; x</h2><p>One <b>two</b>
 three<p>Four &lt;five&gt;<br>six<ul><li>i1<li>i2</ul><div><p>deep</p> tail</div><aside>side</aside>
<section id="comments"><p>nice</p></section></main><script>var x="</p>"; if(a<b){}</script>
<a title="a > b">link</a><footer>f</footer>"""


def test_markup_by_hand():
    assert html_text.main_text(MARKUP) == (
        "Title & x\nOne two three\nFour <five> six\ni1\ni2\ndeep\ntail")
    assert html_text.main_text(None) == html_text.main_text("") == html_text.main_text("<p>") == ""
    assert html_text.main_text("plain & text < 3") == "plain & text < 3"
    assert html_text.main_text("<div>" * 5000 + "x") == "x"
    assert html_text.main_text("<!-- open <p>x") == ""
    assert html_text.main_text('<a title="1 > 0">in</a> out') == "in out"


def test_quoted_tag_ends_are_no_tag_ends():
    inner = "<p>hidden</p>" * 200
    for q in "\"'":
        assert html_text.main_text(f"<article><div data-x={q}{inner}{q} id=a>seen</div></article>") == "seen"
    assert html_text.main_text("<div data-x = '" + "->" * 50_000 + "'>seen</div>") == "seen"
    assert html_text.main_text('<a href=/x?a="1>in</a> out') == "in out"
    assert html_text.main_text("<a b=>in</a> <i title='it>out</i>") == "in out"
    assert html_text.main_text("one <b c" + "='\"" * 20_000) == "one"


def test_recurring_subtrees_go(spark):
    def page(i):
        return (f"<body><div class=top><span>Welcome to our site</span></div><article><h1>T{i}</h1>"
                f"<p>Text number {i} of this site.</p><p>Same closing words.</p>"
                "<div class=box>Read our other stories</div></article></body>")
    rows = [(i, f"http://h.org/{i}", page(i)) for i in range(12)]
    rows += [(20, "http://other.org/1", page(20)), (21, None, None), (22, "http://h.org/x", ""),
             (None, "http://h.org/0", page(0))]
    # no article: what recurs is template wherever it stands
    rows += [(30 + i, f"http://plain.org/{i}", f"<div>Menu of all</div><div>Story {i} is long enough"
              f" to be the text of its page</div>") for i in range(6)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr(
        "*", "1 AS host", "2 AS page", "3 AS subtree", "4 AS HTML")
    got = {r.page_id: r.text for r in html_text.extract(table).collect()}
    assert got[3] == "T3\nText number 3 of this site.\nSame closing words."
    assert got[20].endswith("Read our other stories")            # once on its host
    assert got[21] == got[22] == "" and got[None] == got[0]
    assert got[33] == "Story 3 is long enough to be the text of its page"
    assert html_text.extract(table.limit(0)).count() == 0


def test_article_text_is_not_lost_to_names():
    """Classes and ids that hold a telling word and name something else, and forms around all."""
    kept = ("<article><h2 id=related-work>Related work</h2><p class=notice>Take notice.</p>"
            "<section id=social-policy><p>Social policy.</p></section><div class='share-price'>"
            "Price of a share</div><p class=share-price>10.5</p><ul class=menu-of-the-day><li>Soup</ul>"
            "</article>")
    lines = "Related work\nTake notice.\nSocial policy.\nPrice of a share\n10.5\nSoup"
    assert html_text.main_text(kept) == lines
    assert html_text.main_text(f"<form id=aspnetForm><nav>Home</nav><main>{kept}</main></form>") == lines
    assert html_text.main_text(f"<div class=page-with-sidebar>{kept}</div>") == lines
    long = "Plain text of a page without any article. " * 5
    assert html_text.main_text(f"<form><p>{long}</p></form><form><p>Search</p></form>") == long.strip()
    assert html_text.main_text(f"<div class=has-sidebar><p>{long}</p></div>") == long.strip()
    for box in ("<div class=related-posts>x</div>", "<div class='share buttons'>x</div>",
                "<section id=comments><p>x</p></section>", "<div class=cookie_notice>x</div>",
                "<form><p>x</p></form>", "<aside>x</aside>", "<div class='a ad-slot'>x</div>",
                "<nav>x</nav>", "<div role=search>x</div>", "<div hidden>x</div>"):
        assert html_text.main_text(f"<article><p>{long}</p>{box}</article>") == long.strip(), box
    assert html_text.main_text("<nav>" + "<a>menu</a> " * 99 + "</nav><p>short</p>") == "short"


def brute_force(rows, min_pages=html_text.MIN_PAGES):
    """The subtree counts again, with dictionaries, and texts by deleting from the tree."""
    seen = {}
    for _, url, page in rows:
        root = html_text.parse(page or "")
        html_text.digest(root)
        host = re.match(r"\w+://([^/]*)", url or "")
        for x in html_text.removable(root):
            seen.setdefault((host and host[1].lower(), x.digest), set()).add(page)
    out = {}
    for i, url, page in rows:
        root = html_text.parse(page or "")
        html_text.digest(root)
        host = re.match(r"\w+://([^/]*)", url or "")
        gone = {id(x) for x in html_text.removable(root)
                if len(seen[host and host[1].lower(), x.digest]) >= min_pages}

        def text(node, top):
            if isinstance(node, str):
                return " ".join(node.split()).join(["\1" if node[:1].isspace() else "",
                                                    "\1" if node[-1:].isspace() else ""])
            if node.tag == "br":
                return "\1"
            if node.drop or id(node) in gone or node.tag == "header" and top is root:
                return ""
            inner = "".join(text(k, top) for k in node.kids)
            return inner if node.tag in html_text.INLINE else f"\n{inner}\n"

        blocks = "".join(text(r, r) for r in html_text._roots(root)).replace("\1", " ").split("\n")
        out[i] = "\n".join(" ".join(b.split()) for b in blocks if b.strip())
    return out


def test_templates_without_telling_names_go_by_their_hashes(spark):
    """Sites whose menus and boxes are plain divs: only counting subtrees tells them."""
    rows = []
    for site in range(3):
        for i in range(9):
            menu = "".join(f"<div>Section {site}.{k}</div>" for k in range(4))
            box = f"<div><div>Read on at site {site}</div><b>every day</b></div>"
            rare = "<div>Only on four pages</div>" if i < 4 else ""
            story = f"<div>Story {site}-{i} tells what happened, and says it at length.</div>"
            article = f"<article><div>{story}{box}{rare}<p>The end.</p></div></article>"
            body = f"<div>{menu}</div>" + (article if site else f"<div>{story}{rare}</div>{box}")
            rows.append((100 * site + i, f"http://s{site}.example/{i}", f"<body>{body}<div>(c) {site}</div>"))
    rows += [(900, None, rows[0][2]), (901, "http://s1.example/again", rows[9][2]), (902, "x", None)]
    got = {r.page_id: r.text for r in html_text.extract(
        spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == brute_force(rows)
    story = "Story 1-7 tells what happened, and says it at length."
    assert got[107] == f"{story}\nThe end."
    assert html_text.main_text(rows[16][2]) == f"{story}\nRead on at site 1\nevery day\nThe end."
    assert got[102] == got[102].replace("Read on", "") and "Only on four pages" in got[102]
    assert "Section 0.1" in got[900] and "Section" not in got[3]      # another host: once


def test_pages_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_TINY}/pages.parquet").select(
        "page_id", "url", "html").collect()]
    long = "<body><article>" + "".join(f"<p>Paragraph {i} &amp; more</p>" for i in range(30_000))
    rows.append((-1, "http://long.example/", long))
    got = {r.page_id: r.text for r in html_text.extract(
        spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == brute_force(rows)
    assert got[-1].count("\n") == 29_999 and got[-1].endswith("Paragraph 29999 & more")


def test_templates_of_sections_go(spark):
    """Ten sections of twelve pages on one host: none has a fifth of the host's pages."""
    rows = []
    for s in range(10):
        for i in range(12):
            story = f"Story {i} of section {s} is long enough to be the text of its page"
            box = f"<div class=box{s}>Best of section {s}</div>"
            rows.append((100 * s + i, f"http://big.org/{s}/{i}",
                         f"<body><article><p>{story}</p>{box}</article></body>"))
            rows.append((5000 + 100 * s + i, f"http://plain.org/{s}/{i}",
                         f"<body>{box}<div><p>{story}</p><p>Closing words of {s}</p></div></body>"))
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    for r in html_text.extract(table).collect():
        s, i = r.page_id % 5000 // 100, r.page_id % 100
        assert r.text == f"Story {i} of section {s} is long enough to be the text of its page"
