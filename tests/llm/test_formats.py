"""HTML extraction, WARC, URL filters, license scans, SentencePiece and media columns against brute force or round trips."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict
from datetime import datetime, timedelta

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from pulseframe.llm import gif, html, licenses, pieces, queries, urls, warc

PIECES = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [None, "", " \n\t", "Some Text", "Some Text", "ÀÉ é 日本語 😀", "a\x00b", "x " * 40_000, "12 ... 34", "▁ sign", "".join(map(chr, range(32, 500)))]


@pytest.fixture(scope="session")
def odd(spark):
    names = "doc_id long, text string, ids string, score string, media string, n_words string, got string"
    return spark.createDataFrame([(None if k == 3 else k, t, *"abcde") for k, t in enumerate(TEXTS)], names)


def page(host, k, article):
    nav = "".join(f'<li><a href="/{x}">{x}</a></li>' for x in ("home", "news", f"n{k}"))
    return f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body class="has-sidebar">
<header><h2>{host} site</h2></header><nav><ul>{nav}</ul></nav><!-- c --><div class="ad">buy {k}</div><div id="cookie-notice">We use cookies</div>
<article><h1>Title {k} &amp; more</h1><p><b>First   words
of {k}.<br><p>Caf&eacute; &lt;b&gt; {article}</p><div class="share-links">Share</div><ul><li>one {k}<li>two {k}</ul><p>Read our terms</p><section class="comments"><p>I liked it</p></section><aside>aside</aside><form><p>name</p></form></article>
<div class="sidebar"><p>more</p></div><footer>&copy; {host}</footer>"""


def test_html(spark):
    rows = [(k, f"https://{h}/x/{k}", page(h, k, f"Body of {k} goes on for quite a few words, so that it is most of what the page has."), "t", "h") for k, h in enumerate(["a.example"] * 8 + ["b.example"] * 2)]
    rows += [(20, None, page("c", 1, "z"), "t", "h"), (21, "https://a.example/e", None, "t", "h"), (22, "https://a.example/e", "", "t", "h"), (None, "nonsense", "plain &amp; simple <unclosed", "t", "h")]
    rows += [(30 + k, f"https://same.example/{k}", f"<article><p>The same copy</p></article><i>{k}</i>", "t", "h") for k in range(6)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, texts string, host_of string")
    got = {r.page_id: r for r in html.extract(pages).collect()}
    assert len(got) == len(rows)
    tail = "Body of {k} goes on for quite a few words, so that it is most of what the page has."
    for k in range(10):
        lines = [f"Title {k} & more", f"First words of {k}.", "Café <b> " + tail.format(k=k), f"one {k}", f"two {k}", "Read our terms"]
        assert got[k].text.split("\n") == lines
        assert got[k].n_chars == len(got[k].text) and got[k].host_of == "h"
    assert got[21].text == got[22].text == "" and got[None].text == "plain & simple"
    assert all(got[30 + k].text == "The same copy" for k in range(6))
    assert html.extract(pages.limit(0)).count() == 0


@pytest.mark.parametrize("element", ["article", "main"])
def test_html_keeps_what_each_article_has(spark, element):
    """Headings and lines that all articles of a host share, whatever the number of its pages; also where a form is around the page."""
    rng = random.Random(3)
    rows, expected = [], {}
    for host, n, wrap in (("small", 3, ""), ("large", 12, ""), ("net", 1, "form"), ("asp", 9, "form")):
        for k in range(n):
            words = lambda m: " ".join(f"w{rng.randrange(900)}" for _ in range(m))
            lines = [f"Dish {words(2)}", words(40), "Ingredients", "1 pinch of salt", words(3), "Method", words(60), "Serves 4"]
            a, b, c, d, e, f, g, s = lines
            body = f"<{element}><h1>{a}</h1><p>{b}</p><h2>{c}</h2><ul><li>{d}<li>{e}</ul><h2>{f}</h2><p>{g}</p><p>{s}</p><form><p>your name</p></form></{element}>"
            page_ = f"<nav><a href='/'>Home</a></nav>{body}<footer>of {host}</footer>"
            rows.append((len(rows), f"https://{host}.example/{k}", f"<html><body>{f'<form id=aspnetForm>{page_}</form>' if wrap else page_}</body></html>"))
            expected[len(rows) - 1] = "\n".join(lines)
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in html.extract(pages).collect()} == expected


def test_html_template_decides(spark):
    """Menus, adverts and footers without a telling element or class: only the template says what they are."""
    rng = random.Random(8)
    rows, expected = [], {}
    for k in range(12):
        texts = [" ".join(f"w{rng.randrange(900)}" for _ in range(50)) + "." for _ in range(rng.randrange(1, 5))]
        links = "".join(f"<p><a href='/{x}'>topic {rng.randrange(10**6)}</a></p>" for x in range(4))
        body = f"<div><p>Home</p><p>News</p><p>About us</p></div><div><h2>Head {k}</h2>{''.join(f'<p>{t}</p>' for t in texts)}<p>Tell your friends</p></div><div>{links}</div><div><p>All of it is ours</p></div>"
        rows.append((k, f"https://plain.example/{k}", f"<html><body>{body}</body></html>"))
        expected[k] = "\n".join([f"Head {k}", *texts])
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in html.extract(pages).collect()} == expected
    assert all("Home" in html.main_text(h, html.Template()) for _, _, h in rows)


def test_html_templates_too_many_to_broadcast(spark, sf_dir, monkeypatch):
    """The same texts where templates are joined: hosts with a large part of the pages, small ones, and pages without a host."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    pages = pages.unionByName(pages.limit(9).withColumns({"url": F.lit(None).cast("string"), "page_id": F.col("page_id") + 10_000}))
    usual = sorted((r.page_id, r.text) for r in html.extract(pages).collect())
    monkeypatch.setattr(html, "MOST_BROADCAST", 0)
    monkeypatch.setattr(html, "MOST_HOT", 8)
    assert sorted((r.page_id, r.text) for r in html.extract(pages).collect()) == usual


def test_html_articles_of_links_stay(spark):
    """Where most words of an article are in links, it is no list of links; a menu of links beside it is."""
    rows = []
    for k in range(9):
        links = " ".join(f"<a href='/{x}'>linked words of {k} and {x}</a> a {x}" for x in range(12))
        rows.append((k, f"https://links.example/{k}", f"<body><ul><li><a>topic {k}</a></li><li><a>other {k}</a></li></ul><div class=x><h2>Head {k}</h2><p>{links}</p></div><div class=y><p><a>next {k + 1}</a></p></div></body>"))
    for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect():
        assert r.text.startswith(f"Head {r.page_id}\nlinked words of {r.page_id} and 0 a 0") and "topic" not in r.text and "next" not in r.text


def test_html_copies_stay(spark):
    """Copies of an article on one host, with menus and adverts of their own, are no template, whether all pages are copies or some."""
    text = "".join(f"<p>Paragraph {j} of the piece that was sent to all.</p>" for j in range(6))
    rows = []
    for host, n in (("all.example", 8), ("some.example", 16)):
        for k in range(n):
            own = text if host == "all.example" or k % 2 else "".join(f"<p>Own {j} of {k} with more.</p>" for j in range(5))
            rows.append((len(rows), f"https://{host}/{k}", f"<body><nav><a>m{k}</a></nav><div class='ad'>buy {k}</div><article><h1>T</h1>{own}</article><footer>f{k}</footer></body>", own))
    got = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string, own string")).collect()
    for r in got:
        assert [x for x in r.text.split("\n") if x != "T"] == re.findall("<p>(.*?)</p>", r.own)


@pytest.mark.parametrize(
    "page, text",
    [
        ("<article><p>a</p><svg/><p>b</p></article>", "a\nb"),
        ("<article><p>a</p><iframe src=x /><p>b</p></article>", "a\nb"),
        ("<article><p>a</p><iframe><p>b</p></article>", "a\nb"),
        ("<article><p>a</p><object><p>b</p></article>", "a\nb"),
        ("<article>a <math>x<mi>y</mi></math> <noscript>c</noscript></article>", "a xy c"),
        ("<article><div class='warning'>Mind the gap</div><div class='form-of-government'>a</div><div class='share-links'>b</div></article>", "Mind the gap\na"),
        ("<article><div class='entry-header'>by me<h1>T</h1></div><p>a</p></article>", "T\na"),
        ("<div class='post-header'>by me<h1>T</h1></div><p>a</p><div class='site-header'><h2>b</h2></div>", "T\na"),
        ("<article><p>a<script>x</p></script>b<style>p{}</style></p><section id=comments>c</section></article>", "ab"),
        ("1 < 2 &amp; 3 <b>x</b> <unfinished", "1 < 2 & 3 x"),
        ('<p title="5" tall">a</p><p title=">">b</p><p title="never>c</p>', "a\nb\nc"),
        ("a</>b</ >c<!-- d --><!doctype e>", "abc"),
        ("<ul><li>a<li>b<ul><li>c</ul></ul><dl><dt>d<dd>e</dl><table><tr><td>f<td>g<tr><td>h</table>", "a\nb\nc\nd\ne\nf\ng\nh"),
        ("<div>" * 100_000 + "a" + "</div>" * 100_000 + "b", "a\nb"),
        ('<a "' * 50_000 + ">a", "a"),
        ('<a x="' * 50_001 + ">a", "a"),
        ("<p>" * 50_000 + "</x>" * 50_000 + "a", "a"),
        ("x " * 500_000 + "<" * 50_000, "x " * 500_000 + "<" * 50_000),
    ],
)
def test_html_elements(page, text):
    assert html.main_text(page, html.Template()) == text


def test_html_of_the_tables(spark, sf_dir):
    """The generated pages' articles hold plain paragraphs only, so a regular expression finds the same."""
    from html import unescape

    for r in queries.html_extraction(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "html"), "page_id").collect():
        article = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        blocks = [" ".join(unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?p>|</?h1>", article)]
        assert r.text == "\n".join(x for x in blocks if x)


def test_occurrence_vectors(spark):
    """Texts with the vector of the page's frame are template; those that come and go are not."""
    rows = [(f"https://h.example/{k}", f"<body><div><p>always</p><h2>head {k}</h2><section><p>text {k} is longer than the others</p>{'<p>often</p>' if k % 3 else ''}</section></div></body>") for k in range(9)]
    (found,) = html.templates(spark.createDataFrame(rows, "url string, html string")).collect()
    role = 0
    for name in ("body", "div", "p"):
        role = html._digest(f"{role}/{name}")
    always = html._digest(f"{role}\0always")
    assert always in found.texts and found.n == 9 and len(set(found.classes)) == 1
    template = html._template(found.asDict())
    for k, (_, h) in enumerate(rows):
        assert html.main_text(h, template) == "\n".join([f"head {k}", f"text {k} is longer than the others"] + ["often"] * (k % 3 > 0))


def test_warc(spark, sf_dir):
    long, other = "<p>" + "x" * 200, "<p>" + "ÿ" * 80
    rows = [(5, "http://A.example:80/p?q=1#f", long), (2, "http://b.example/", long), (9, "https://a.example/z", long), (3, None, "short"), (4, "http://b.example/", "short"), (7, "x y\tz\nq", other), (7, "x y\tz\nq", other), (8, "http://c.example", None), (None, "http://d.example/", long), (2**60 + 1, "http://b.example/", other)]
    pages = spark.createDataFrame([(*r, "k") for r in rows], "page_id long, url string, html string, key string")
    for table in (pages, spark.read.parquet(f"{sf_dir}/pages.parquet")):
        first, expected = {}, []
        own = [(r.page_id, (r.html or "").encode()) for r in table.collect()]
        for i, raw in own:
            if len(raw) >= 100 and i is not None:
                first[raw] = min(i, first.get(raw, i))
        for i, raw in own:
            revisit = len(raw) >= 100 and first.get(raw, i) != i
            expected.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response", first[raw] if revisit else None))
        for options in ({}, {"roll": 600, "block": 2}):
            assert sorted(map(str, map(tuple, warc.round_trip(table, **options).collect()))) == sorted(map(str, expected))
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_warc_lookup(spark):
    pages = spark.createDataFrame([(k, f"http://h{k % 7}.example/{k % 3}", f"page {k}" * 30) for k in range(200)], "page_id long, url string, html string")
    folder, shards = warc.archive(pages, block=4, roll=5_000)
    keys = spark.createDataFrame([(warc.capture_key(f"http://h{k % 7}.example/{k % 3}", k),) for k in range(0, 200, 9)] + [("zzz",), ("",)], "key string")
    got = warc.read_records(warc.lookup(keys, shards, folder), folder, with_payload=True).collect()
    assert {(r.page_id, bytes(r.payload).decode()) for r in got} == {(k, f"page {k}" * 30) for k in range(0, 200, 9)} and len(got) == 23
    assert warc.url_key("https://User@WWW.Example.com:8080/a b?q#f") == "com,example,www:8080)/a%20b?q"


def test_url_filter(spark):
    rng = random.Random(2)
    day = datetime(2024, 1, 1)
    hosts = ["a.x.example", "b.x.example", "x.example", "y.example", "example"]
    case = lambda h: h if rng.random() < 0.7 else h.title()
    entries = [(rng.choice("pq"), case(rng.choice(hosts)), rng.choice(["add", "remove"]), day + timedelta(days=rng.randrange(90))) for _ in range(60)]
    odd = [(None, "x.example", "add", day), ("p", None, "add", day), ("p", "x.example", None, day), ("p", "x.example", "add", None), ("p", "X.example", "toggle", day)]
    captures = [(k, f"https://u@{rng.choice(hosts).upper()}:9/x{k}", day + timedelta(hours=rng.randrange(24 * 120))) for k in range(1500)]
    captures += [(1500, None, day), (1501, "not a url", day), (1502, "http://x.example/", None), (1503, "http://" + "a." * 2_000 + "example/" + "x" * 99_000, day), (None, "http://x.example/", day), (5, *captures[5][1:])]
    got = urls.filter_captures(spark.createDataFrame(captures, "capture_id long, url string, fetched timestamp"), spark.createDataFrame(entries + odd, "list_name string, pattern string, action string, effective timestamp")).collect()
    changes = defaultdict(dict)
    for name, pattern, action, at in entries:
        own = changes[name, pattern.lower()]
        own[at] = max(action, own.get(at, ""))
    expected = []
    for i, url, at in captures:
        m = re.match(r"https?://(?:[^/?#@]*@)?([^/?#:]*)", url or "")
        host, hits = m[1].lower() if m else "", []
        for (name, pattern), dated in changes.items():
            before = [d for d in dated if at and d <= at]
            if before and dated[max(before)] == "add" and (host == pattern or host.endswith("." + pattern)):
                # since is the start of the running interval, that is the latest addition
                hits.append((name, max(before)))
        expected.append((i, host, at, len(hits), ",".join(sorted({h[0] for h in hits})), max((h[1] for h in hits), default=None), bool(hits)))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))


def test_url_filter_ignores_the_case_of_patterns(spark):
    """A pattern added in capitals and removed in small letters is one pattern."""
    day = datetime(2024, 1, 1)
    entries = spark.createDataFrame([("p", "X.example", "add", day), ("p", "x.example", "remove", day + timedelta(days=5))], "list_name string, pattern string, action string, effective timestamp")
    captures = spark.createDataFrame([(k, "http://a.x.example/", day + timedelta(days=k)) for k in (1, 9)], "capture_id long, url string, fetched timestamp")
    assert {r.capture_id: r.blocked for r in urls.filter_captures(captures, entries).collect()} == {1: True, 9: False}


def test_url_filter_of_no_rows(spark):
    none = spark.createDataFrame([], "list_name string, pattern string, action string, effective timestamp")
    captures = spark.createDataFrame([(1, "http://a.example/", datetime(2024, 1, 1))], "capture_id long, url string, fetched timestamp")
    assert [r.blocked for r in urls.filter_captures(captures, none).collect()] == [False]
    assert urls.filter_captures(captures.limit(0), none).count() == 0


def test_html_of_two_layouts(spark):
    """Two layouts, and two languages of one layout, on half of a host's pages each: the blocks of each go, what four articles quote stays."""
    rng = random.Random(4)
    own = lambda k: [" ".join(f"w{rng.randrange(900)}" for _ in range(60)) + f" {k}." for _ in range(3)]
    blocks = lambda x: [f"{x} notice number {j} of the house." for j in range(3)]
    rows, expected = [], {}
    for host in ("layouts.example", "languages.example", "quotes.example"):
        for k in range(20):
            texts = own(k)
            half = "left" if k % 2 else "right"
            inner = "".join(f"<p>{t}</p>" for t in [*texts, *blocks(half)])
            if host == "layouts.example":
                html_ = f'<body><div class="{half}"><article>{inner}</article></div></body>'
            elif host == "languages.example":
                html_ = f"<body><nav><a>{half} home</a></nav><article>{inner}</article></body>"
            else:
                texts = texts + [f"Quoted line {j}." for j in range(3) if k < 4]
                html_ = "<body><article>" + "".join(f"<p>{t}</p>" for t in texts) + "</article></body>"
            rows.append((len(rows), f"https://{host}/{k}", html_))
            expected[rows[-1][0]] = "\n".join(texts)
    got = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in got} == expected


def test_license_scan(spark, odd):
    texts = ["Released under the MIT License. mit-license; MIT license mit license", "GNU Lesser General Public License, version 2.1", "Apache License, Version 2.0", "submit license", "SPDX-License-Identifier: BSD-3-Clause", "general public general public license éMIT license"]
    docs = odd.select("doc_id", "text").unionByName(spark.createDataFrame([(100 + k, t) for k, t in enumerate(texts)], "doc_id long, text string"))
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    got = licenses.license_scan(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        words = word.findall((r.text or "").translate(lower))
        places = [(k, label) for phrase, label in licenses.BASE.items() for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.decode().split()]
        base = sorted({x for _, x in places})
        assert (r.n_words, r.n_base, r.base_labels) == (len(words), len(places), ",".join(base))
        assert (r.first_word, r.last_word) == (min((k for k, _ in places), default=None), max((k for k, _ in places), default=None))
        assert set(base) <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1
    labels = {r.doc_id: r.labels for r in got}
    assert labels[101] == "gpl,lgpl-2.1" and labels[102] == "apache,apache-2.0" and labels[103] == "" and labels[104] == "bsd-3-clause"


def test_contained_detections_go():
    line = licenses.normalised("licensed under the GNU Affero General Public License version 3")
    found = licenses.detections(line.split(), line)
    assert [(r.label, r.priority) for _, _, r in found] == [("agpl-3.0", 3)]
    assert sum(map(len, licenses.RULES.values())) > 300


def slow_labels(text):
    """Every rule tried on every text, and each pair of detections compared."""
    line = licenses.normalised(text)
    rules = {id(r): r for own in licenses.RULES.values() for r in own}.values()
    found = [(m.start(), m.end(), r) for r in rules for m in r.pattern.finditer(line)]
    within = lambda x, y: y[0] <= x[0] and x[1] <= y[1] and (y[1] - y[0], y[2].priority, -y[2].order) > (x[1] - x[0], x[2].priority, -x[2].order)
    left, kept = sorted((x for x in found if not any(within(x, y) for y in found)), key=lambda x: (-x[2].priority, x[0] - x[1], x[0])), []
    for x in left:
        if all(x[1] <= y[0] or y[1] <= x[0] for y in kept):
            kept.append(x)
    return sorted((a, b, r.label) for a, b, r in kept)


def test_licenses_against_all_rules():
    rng = random.Random(6)
    rules = list({id(r): r for own in licenses.RULES.values() for r in own}.values())
    phrases = [x for r in rules for x in itertools.islice(strings(re._parser.parse(r.pattern.pattern.decode())), 3)] + ["license", "the", "version 2", "2 0", "public", "gnu", "under the"]
    for _ in range(60):
        picked = [rng.choice(phrases).split() for _ in range(rng.randrange(1, 9))]
        words = [w for p in picked for w in (p[: rng.randrange(1, len(p) + 1)] if rng.random() < 0.4 else p)]
        text = " ".join(words)
        line = licenses.normalised(text)
        assert [(a, b, r.label) for a, b, r in licenses.detections(line.split(), line)] == slow_labels(text), text


@pytest.mark.parametrize(
    "text, labels",
    [
        ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in", "mit"),
        ("Copyright (c) 2001 X. All rights reserved. Redistribution and use in source and binary forms, with or without modification, are permitted provided", "bsd"),
        ("All rights reserved.", "proprietary"),
        ("This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License", "gpl,gpl-2.0"),
        ("Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.", "apache,apache-2.0"),
        ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above", "isc"),
        ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "mpl-2.0"),
        ("The Software shall be used for Good, not Evil.", "json"),
    ],
)
def test_license_notices(text, labels):
    assert licenses.scanned(text)[5] == labels


def test_places_of_base_phrases_in_a_long_text():
    text = "x mit license " * 100_000
    assert licenses.scanned(text)[:4] == (300_000, 100_000, 1, 299_998)


def strings(parsed):
    """What a pattern matches, the last part varying first; a repeat is taken up to twice more than it must."""
    parts = []
    for op, arg in parsed:
        kind = str(op)
        if kind == "LITERAL":
            parts.append([chr(arg)])
        elif kind == "IN":
            parts.append([chr(a) if str(o) == "LITERAL" else "7" for o, a in arg if str(o) in ("LITERAL", "CATEGORY")])
        elif kind == "NOT_LITERAL":
            parts.append(["x"])
        elif kind == "BRANCH":
            parts.append([x for b in arg[1] for x in strings(b)])
        elif kind == "SUBPATTERN":
            parts.append(list(strings(arg[3])))
        elif kind in ("MAX_REPEAT", "MIN_REPEAT"):
            parts.append(["".join(x) for n in range(arg[0], min(arg[1], arg[0] + 2) + 1) for x in itertools.product(list(strings(arg[2])), repeat=n)])
        else:
            assert kind == "ASSERT", kind
    return map("".join, itertools.product(*parts))


def test_all_that_a_license_rule_matches_passes_the_gate():
    for rule in {id(r): r for own in licenses.RULES.values() for r in own}.values():
        tried = 0
        for text in itertools.islice(strings(re._parser.parse(rule.pattern.pattern.decode())), 400):
            line = f" {text} ".encode()
            assert rule.pattern.search(line), (rule.label, text)
            assert any(a == 1 and b == len(line) - 1 for a, b, _ in licenses.detections(line.split(), line)), (rule.label, text)
            tried += 1
        assert tried


@pytest.mark.parametrize(
    "text, labels",
    [
        ("Expat License", "mit"),
        ("FreeBSD license", "bsd-2-clause"),
        ("PSF license", "psf-2.0"),
        ("BigScience open rail license", "openrail"),
        ("Creative Commons Attribution Share Alike", "cc-by-sa"),
        ("Creative Commons Attribution No Derivatives", "cc-by-nd"),
        ("Creative Commons Attribution-Non-Commercial", "cc-by-nc"),
        ("Creative Commons Attribution-Non-Commercial-Share-Alike", "cc-by-nc-sa"),
        ("Creative Commons Attribution-Non-Commercial-No-Derivs", "cc-by-nc-nd"),
        ("Mozilla Public License", "mpl"),
        ("Mozilla Public License, version 2.0", "mpl-2.0"),
        ("https://www.mozilla.org/MPL/1.1", "mpl-1.1"),
        ("https://www.mozilla.org/en-US/MPL/", "mpl"),
        ("MPL 2.0", "mpl-2.0"),
    ],
)
def test_names_without_the_short_keyword(text, labels):
    assert licenses.scanned(text)[5] == labels


def slow_segment(model, word):
    known = {p: (s, i) for p, (n, s, i) in ((k, model.automaton.get(k)) for k in model.automaton.keys())}
    best = [(0.0, [])] + [None] * len(word)
    for end in range(1, len(word) + 1):
        for start in range(max(0, end - 48), end):
            if word[start:end] in known:
                score, i = known[word[start:end]]
            elif end - start == 1:
                score, i = model.unknown_score, None
            else:
                continue
            total = best[start][0] + score
            if best[end] is None or total > best[end][0]:
                best[end] = total, best[start][1] + ([i] if i is not None else [model.byte_ids[b] for b in word[start:end].encode()])
    return best[-1][1]


def test_pieces_against_all_segmentations():
    model = pieces.model(PIECES)
    for word in ("▁internationalisation", "▁日本語x", "▁▁▁", "▁the", "aaaaaaaaaaaaaaaa", "▁naïve😀"):
        assert model.segment(word) == slow_segment(model, word)


def test_pieces_against_the_library():
    """With its kind set to unigram, the library searches for the same best sum of scores."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as proto

    m = proto.ModelProto()
    m.ParseFromString(open(PIECES, "rb").read())
    m.trainer_spec.model_type = 1
    library = sentencepiece.SentencePieceProcessor(model_proto=m.SerializeToString())
    model = pieces.model(PIECES)
    for text in ("Hello world, this is a segmentation of words.", "Der schnelle braune Fuchs", "queeaux éien pour"):
        (ids,) = model.encode([text])
        theirs = library.encode(text)
        assert model.score(ids) == sum(library.get_score(i) for i in theirs) and library.decode(ids.tolist()) == text == model.decode(ids)


def test_encode_decode(spark, odd):
    got = pieces.encode_decode(odd, PIECES).collect()
    assert len(got) == len(TEXTS) and all(r.round_trip and r.got == "e" for r in got)
    assert all(r.n_ids == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<i4").tobytes()) for r in got)
    back = pieces.encode_decode(odd, PIECES).select("text", pieces.decoded(F.col("ids"), PIECES).alias("back")).collect()
    assert all(r.back == (r.text or "").replace("▁", " ") for r in back)
    assert pieces.encode_decode(odd.limit(0), PIECES).count() == 0


def test_lzw():
    rng = random.Random(4)
    for n in (0, 1, 2, 700, 9_000, 40_000):
        for size in (2, 4, 8):
            for kinds in (1, 1 << size):
                data = bytes(rng.choices(range(kinds), k=n))
                assert gif.lzw_decode(gif.lzw_encode(data, size), size) == data


def test_lzw_known_stream():
    """A stream from the format's public description: a picture of 10 x 10 with four colours."""
    data = bytes.fromhex("8C2D99872A1CDC33A0027 5EC95FAA8DE608C0491 4C01".replace(" ", ""))
    rows = ["1111122222"] * 3 + ["1110000222"] * 2 + ["2220000111"] * 2 + ["2222211111"] * 3
    assert gif.lzw_decode(data, 2) == bytes(int(c) for r in rows for c in r)


def test_composition():
    """A transparent frame over part of the canvas, then disposal to the background and to what was before."""
    palette = bytes((0, 0, 0, 255, 0, 0, 0, 255, 0, 0, 0, 255))

    def frame(disposal, samples, box, transparent=None):
        flags = disposal << 2 | (transparent is not None)
        x, y, w, h = box
        return bytes((0x21, 0xF9, 4, flags, 7, 0, transparent or 0, 0, 0x2C, x, 0, y, 0, w, 0, h, 0, 0, 2)) + gif._blocks(gif.lzw_encode(bytes(samples), 2))

    data = b"GIF89a" + bytes((2, 0, 2, 0, 0xF1, 0, 0)) + palette + frame(1, [1, 1, 1, 1], (0, 0, 2, 2)) + frame(3, [2, 3], (0, 0, 2, 1), 3) + frame(2, [3], (1, 1, 1, 1)) + frame(0, [2], (0, 0, 1, 1)) + b";"
    shown = [["".join("k" if not p.any() else "rgb"[int(p.argmax())] for p in row) for row in f.rgb] for f in gif.read_gif(data)]
    assert shown == [["rr", "rr"], ["gr", "rr"], ["rr", "rb"], ["gr", "rk"]]
    assert [f.at for f in gif.read_gif(data)] == [0, 7, 14, 21]


def slow_bins(payload, shift, mask, step):
    out = [0] * 8
    for b in payload:
        out[step * (b >> shift & mask) // 32] += 1
    return out


def test_media_columns(spark, odd):
    more = [(200, "ab" * 40_000), (201, "".join(map(chr, range(1, 500))) * 60), (202, "same line\n" * 9_000)]
    docs = odd.unionByName(spark.createDataFrame([(i, t, *"abcde") for i, t in more], odd.schema))
    media = gif.media_columns(docs)
    used = set()
    for r in media.collect():
        raw = (r.text or "").encode()
        payload = raw + b"\xff" * (-len(raw) % 576 if raw else 576)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
        assert r.media_bytes == len(r.media) and r.media_sha256 == hashlib.sha256(r.media).hexdigest() and r.got == "e"
        parts = [payload[a : a + 576 * 16] for a in range(0, len(payload), 576 * 16)]
        bins = [[slow_bins(p, 5, 7, 36), slow_bins(p, 2, 7, 36), slow_bins(p, 0, 3, 85)] for p in parts]
        assert [(f.at_ms, f.delay_ms, [f.red, f.green, f.blue]) for f in r.frames] == [(40 * k, 40, b) for k, b in enumerate(bins)]
        total = [[sum(x) for x in zip(*(b[c] for b in bins))] for c in range(3)]
        assert r.feature == f"frames={len(parts)};centiseconds={4 * len(parts)};" + ";".join(f"{n}={','.join(map(str, x))}" for n, x in zip(("red", "green", "blue"), total))
        used |= set(re.findall(rb"\x21\xf9\x04(.)\x04\x00", bytes(r.media), re.S))
    assert {4, 5, 12, 13} >= {x[0] for x in used} >= {4, 5, 13}  # kept and put back, with and without transparency
    frames = gif.frames(media.select("doc_id", "media").unionByName(spark.createDataFrame([(77, None), (78, bytearray(b"no"))], "doc_id long, media binary"))).collect()
    assert {r.doc_id for r in frames if r.frame is None} == {77, 78}
    assert sum(sum(r.red) for r in frames if r.doc_id == 7) >= 80_000 and [r.at_ms for r in frames if r.doc_id == 7] == sorted(40 * r.frame for r in frames if r.doc_id == 7)
    assert gif.media_columns(odd.limit(0)).count() == 0
