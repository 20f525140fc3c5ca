"""Licenses, benchmark passages, urls and pages against plain Python."""

import hashlib
import html as entities
import json
import random
import re
import re._constants as sre
import re._parser as sre_parser

import pytest

from ledgerlake.llm import html as pages
from ledgerlake.llm import licenses, urls
from ledgerlake.llm.common import with_rid
from ledgerlake.llm.decontam import contamination, drop_contaminated, proximity_matches
from ledgerlake.llm.queries import URL_RULES
from ledgerlake.llm.urls import Rule, build, judge, judge_by_join, match
from tests.llm.helpers import documents, got, prose, texts, words

LICENSED = [
    (1, "This work is licensed under the GNU General Public License, version 3."), (2, "Licensed under CC BY-NC 4.0. All rights reserved."),
    (3, "Released under the MIT License. MIT license text: Permission is hereby granted, free of charge, to any person obtaining a copy"),
    (4, "all RIGHTS, reserved; All rights reserved"), (5, "SPDX-License-Identifier: Apache-2.0"), (6, None), (7, ""), (8, "mit und cc"),
    (9, "Accord cc\nby accident, general public license"), (10, "x " * 3000 + "Licensed under the Apache License, Version 2.0."), (11, "ÉCC by cc-by"),
    (12, "GNU Lesser General Public License v2.1"), (None, "Copyright (c) 2024"), (13, "licensed under a commercial license or Creative Commons Attribution 4.0 International"),
]


def license_row(text):
    w = words(text)
    line = " " + " ".join(w) + " "
    base, found = [], []
    for label, phrase in licenses.BASE.items():
        p = phrase.split()
        base += [(k, label) for k in range(len(w) - len(p) + 1) if w[k:k + len(p)] == p]
    for r in licenses.RULES:
        if all(f" {k}" in line for k in r.keywords):
            for m in re.finditer(f"(?<= )(?:{r.regex})(?= )", line):
                a = line[:m.start()].count(" ") - 1
                found.append((a, a + m.group().count(" ") + 1, r.priority, r.label))
    kept = [x for x in found if not any(y[0] <= x[0] and y[1] >= x[1] and (
        y[2] > x[2] or y[2] == x[2] and (y[1] - y[0] > x[1] - x[0] or y[1] - y[0] == x[1] - x[0] and y[3] < x[3])) for y in found)]
    own = sorted({label for _, label in base})
    best = max([x[2] for x in kept] + [1000] * bool(base), default=0)
    return (len(w), len(base), min((k for k, _ in base), default=None), max((k for k, _ in base), default=None), ",".join(own),
            ",".join(sorted(set(own) | {x[3] for x in kept})), min(1.0, best / 100))


@pytest.mark.parametrize("rows", [LICENSED, texts(), []])
def test_license_scan(spark, rows):
    out = licenses.scan(documents(spark, rows, extra=True))
    assert got(out, "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score") == sorted(
        ((i, *license_row(t)) for i, t in rows), key=repr)


def test_license_labels_and_rules(spark):
    labels = {r.doc_id: r.labels for r in licenses.scan(documents(spark, LICENSED)).collect()}
    assert labels[1] == "gpl,gpl-3.0" and labels[2] == "cc-by,cc-by-nc-4.0,reserved" and labels[3] == "mit" and labels[5] == "apache-2.0"
    assert labels[8] == "" and labels[12] == "gpl,lgpl-2.1"
    assert len(licenses.RULES) >= 300
    gated = [r for r in licenses.RULES if not any(k.startswith(g.split()[0]) or g.startswith(k) for k in r.keywords for g in licenses.GATE)
             and "cc by" not in r.keywords]
    assert gated == []


def benchmark(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string").selectExpr("*", "'clash' as item", "1 as phrase")


def contaminated_row(text, items):
    w, hit, ids = words(text), set(), set()
    for i, t in items:
        v = words(t)
        n = min(10, len(v))
        for k in range(len(v) - n + 1) if v else ():
            for s in range(len(w) - n + 1):
                if w[s:s + n] == v[k:k + n]:
                    hit |= set(range(s, s + n))
                    ids |= {str(i)} - {"None"}
    return len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)


def test_contamination(spark):
    docs = texts()
    a, b = docs[0][1].split(), docs[4][1].split()
    items = [(1, " ".join(a[10:40])), (2, " ".join(a[35:45]).upper()), (10, "one TWO"), (3, None), (4, ""), (5, "... !"), (6, "nowhere to be found in any text at all, or so"),
             (1, " ".join(b[:12])), (None, " ".join(b[20:31])), (7, "one"), (8, "x x x x x x x x x x x"), (9, prose(77, 40))]
    out = contamination(documents(spark, docs, extra=True), benchmark(spark, items))
    assert got(out, "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == sorted(
        ((i, *contaminated_row(t, items)) for i, t in docs), key=repr)
    kept = drop_contaminated(documents(spark, docs, extra=True), benchmark(spark, items))
    assert kept.count() == sum(not contaminated_row(t, items)[-1] for _, t in docs)
    assert contamination(documents(spark, []), benchmark(spark, items)).count() == 0
    assert contamination(documents(spark, docs), benchmark(spark, [])).where("n_hit > 0 or contaminated").count() == 0


def test_proximity(spark):
    docs = with_rid(documents(spark, [(1, "b x a y"), (2, "a x x x x b"), (3, "a b a"), (4, None)], parts=1))
    asked = spark.createDataFrame([(7, ["a", "b", "a"])], "query long, terms array<string>")
    out = proximity_matches(docs, asked, 3).join(docs, docs.columns[-1])
    assert got(out, "doc_id", "query", "start") == [(1, 7, 0), (3, 7, 0), (3, 7, 1)]


URLS = ["http://www.example.com/en/1", "https://a.www.example.com/en/", "http://example.com/en/x?y#z", "http://sub.example.com/fr/", "http://x.com", "http://x.com/",
        "http://x.com?/en/", "HTTP://EXAMPLE.COM/en/", "http://net/es/", "http://a.net/es/1", "http://a.net/esx", "http://a.net/fr/#f", "http://a.net/de/", "notaurl", "", None,
        "http://com.evil/", "http://xcom/", "x://é.com/en//", "http://example.com/en", "http://a.com:80/", "ftp://b.org/a/b?c://d.com/"]


def url_row(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fit = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fit, key=lambda r: (r.host.count("."), len(r.path)), default=None)
    return host, path, best and best.text, best.verdict if best else "allow"


def test_urls_by_trie_and_by_join(spark):
    df = spark.createDataFrame(list(enumerate(URLS)) + [(0, URLS[0]), (None, URLS[8])], "page_id long, url string").selectExpr("*", "'clash' as host", "'clash' as rule")
    want = sorted(((i, *url_row(u)) for i, u in [*enumerate(URLS), (0, URLS[0]), (None, URLS[8])]), key=repr)
    assert got(judge(df, URL_RULES), "page_id", "host", "path", "rule", "verdict") == want
    table = spark.createDataFrame(URL_RULES, "verdict string, host string, path string")
    assert got(judge_by_join(df, table), "page_id", "host", "path", "rule", "verdict") == want
    assert judge(df.limit(0), URL_RULES).count() == 0
    trie = build([Rule("block", "a.b", "/x"), Rule("allow", "a.b", "/x/y/z"), Rule("allow", "b", "/")])
    assert match(trie, "c.a.b", "/xx").verdict == "block" and match(trie, "a.b", "/x/y/zz").path == "/x/y/z"
    assert match(trie, "a.b", "/q").host == "b" and match(trie, "b.a", "/x") is None


def page(n, body, tail="</body></html>"):
    return f"""<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var a="</p><p>no";</script></head><body><header><h2>Site</h2></header>
<nav><ul><li><a href="/">Home</a></li><li><a href=/b>B {n}</a></ul></nav><!-- ad <p>no</p> --><div class="ad-box wide">Buy {n}</div><div id=cookie-notice>We use</div>
<article><h1>Title {n}</h1>{body}<div class="share">Share</div><section class="comments"><p>nice {n}</p></section></article>
<aside>Side {n}</aside><form><p>Mail</p><input></form><footer>&copy; {n}</footer>{tail}"""


def test_pages_are_their_articles(spark):
    bodies = ["<p><b>One &amp; two<br><p>Three&nbsp; \n four &lt;x&gt;", "<p>A<p>B<ul><li>c<li>d</ul><table><tr><td>1<td>2</table>", "<div><p>only</p></div>", "", "<p>a&am</p>"]
    wants = ["One & two\nThree four <x>", "A\nB\nc\nd\n1\n2", "only", "", "a&am"]
    rows = [(k, f"http://h{k % 2}.com/{k}", page(k, b, "" if k == 2 else "</body></html>")) for k, b in enumerate(bodies)]
    rows += [(90, "http://h0.com/x", None), (91, None, ""), (92, "http://lone.org/", "<p>x<p>y"), (93, "bad", "just text &eacute;"), (0, rows[0][1], rows[0][2])]
    want = [(k, f"Title {k}" + "\n" * bool(w) + w) for k, w in enumerate(wants)] + [(90, ""), (91, ""), (92, "x\ny"), (93, "just text é"), (0, "Title 0\n" + wants[0])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'clash' as text", "'clash' as wrapper", "1 as pages").repartition(3)
    out = pages.extract(df)
    assert got(out, "page_id", "text") == sorted(want, key=repr)
    assert all(r.n_chars == len(r.text) for r in out.collect())
    assert pages.extract(df.limit(0)).count() == 0


def test_wrapper_is_a_union_free_expression():
    a, b = (pages._items(pages.parse(x)) for x in ("<body><p>one</p><i>same</i></body>", "<body><p>x</p><p>y</p><hr><i>same</i></body>"))
    both = pages.align(a, b)
    assert re.sub(r'"\w+"', '"same"', pages.expression(both)) == '<body>(<p>#</p>)+(<hr></hr>)?<i>"same"</i></body>'
    assert pages.from_text(pages.to_text(both)) == both
    assert pages.Wrapper(both, 3).constants() == {("body", "i")}


def test_very_long_pages_and_urls(spark):
    many = [f"line {k} of the story" for k in range(30_000)]
    html = "<body><nav><a>x</a></nav>" + "".join(f"<p>{t}</p>" if k % 3 else f"<div><i>{t}</i></div>" for k, t in enumerate(many)) + "</body>"
    rows = [(1, "http://a.com/1", html), (2, "http://a.com/2", html.replace("story", "tale"))]
    assert got(pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string")), "page_id", "text") == [
        (1, "\n".join(many)), (2, "\n".join(many).replace("story", "tale"))]
    path = "/en/" + "a/" * 100_000
    df = spark.createDataFrame([(1, f"HTTP://www.Example.com{path}?q"), (2, f"x://{'b.' * 50_000}net/fr/")], "page_id long, url string")
    assert [(r.rule, r.verdict, len(r.host), len(r.path)) for r in judge(df, URL_RULES).orderBy("page_id").collect()] == [
        url_row(f"HTTP://www.Example.com{path}?q")[2:] + (15, len(path)), url_row(f"x://{'b.' * 50_000}net/fr/")[2:] + (100_003, 4)]


def test_deep_and_broken_pages():
    deep = "<div>" * 5000 + "x" + "</div>" * 10
    assert shown([deep]) == ["x"]
    # what a text lies in counts at any depth
    far = "<div>" * 3000
    assert shown([f"{far}<nav><ul><li><b>menu</b></ul></nav><p>text {k}</p><div class=sidebar><p>side</p></div>" for k in range(3)]) == [f"text {k}" for k in range(3)]
    for odd in ("<", "<p", "<p a='x", "</", "<!--", "<script>", "&#x;", "a<b>c</d>", "<p <p>x"):
        shown([odd])
    assert entities.unescape("&eacute;") == "é"


def shown(htmls):
    """Main texts of one host's pages."""
    wrapper = pages._items(pages.parse(htmls[0]))
    for other in htmls[1:]:
        wrapper = pages.align(wrapper, pages._items(pages.parse(other)))
    wrapper = pages.Wrapper(pages.from_text(pages.to_text(wrapper)), len(htmls))
    return [pages.main_text(h, wrapper) for h in htmls]


def test_other_pages_tell_the_hosts_texts_from_the_article(spark):
    body = "<body><div class=x1><p>Quality since 1904</p></div><div class=y1><p>{}</p></div><div class=z1><p>All we do</p></div></body>"
    told = [f"story {k} of a day in town" for k in range(4)]
    rows = [(k, f"http://a.com/{k}", body.format(t)) for k, t in enumerate(told)] + [(9, "http://lone.com/", body.format(told[0]))]
    # copies of one page: nothing differs, so all of it is the page's
    rows += [(20 + k, f"http://same.com/{k}", body.format(told[0])) for k in range(4)]
    whole = f"Quality since 1904\n{told[0]}\nAll we do"
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = sorted([*enumerate(told), (9, whole), *((20 + k, whole) for k in range(4))], key=repr)
    assert got(pages.extract(df.repartition(1)), "page_id", "text") == want
    assert got(pages.extract(df.repartition(5)), "page_id", "text") == want


def brute_constants(htmls):
    """Paths whose texts are one and the same on all of some pages without repeated elements."""
    def texts(element, path):
        for c in element.children:
            yield from [(path, c)] if isinstance(c, str) else texts(c, (*path, c.key))

    each = [dict(texts(pages.parse(h), ())) for h in htmls]
    return {p for p in each[0] if all(e.get(p) == each[0][p] for e in each)}


def test_wrappers_equal_brute_force_alignment(spark, monkeypatch):
    monkeypatch.setattr(pages, "FAN", 3)
    rng = random.Random(8)
    tags = [f"div.b{k}" for k in range(7)]
    rows, want = [], {}
    for host in range(6):
        fixed = {t: f"fixed {t}" for t in rng.sample(tags, 3)}
        htmls = []
        for k in range(rng.randrange(2, 14)):
            parts = [(t, fixed.get(t, f"text {rng.randrange(3)}")) for t in tags if t in fixed or rng.random() < 0.8]
            own = f"<div class=own{chr(97 + k)}>mine</div>"
            htmls.append("<body>" + "".join(f"<div class={t[4:]}>{x}</div>" for t, x in parts) + own + "</body>")
        want[f"h{host}"] = brute_constants(htmls)
        rows += [(f"h{host}", h) for h in htmls]
    df = spark.createDataFrame(rows, "host string, html string")
    out = pages.wrappers(df.repartition(4)).collect()
    assert {r.host: pages.Wrapper(pages.from_text(r.wrapper), r.pages).constants() for r in out} == want
    assert sorted(out) == sorted(pages.wrappers(df.repartition(1)).collect())
    # parts that one page only has don't add up
    assert max(r.wrapper.count(".own") for r in out) == 0


def test_two_templates_of_a_host_keep_their_texts(spark):
    mixed = [f"<body><nav>menu</nav><article><p>long {k}</p></article><p>teaser {k}</p></body>" if k % 2 else
             f"<body><nav>menu</nav><div><p>plain {k}</p></div></body>" for k in range(6)]
    want = [f"long {k}" if k % 2 else f"plain {k}" for k in range(6)]
    assert shown(mixed) == want
    rows = [(k, None if k < 4 else "odd", h) for k, h in enumerate(mixed)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    assert got(pages.extract(df), "page_id", "text") == list(enumerate(want))


@pytest.mark.parametrize("page,want", [
    ("<body class='has-sidebar'><p>{}</p><div class=sidebar>x</div></body>", "{}"),
    ("<html class='hidden'><body class='widget'><p>{}</p></body></html>", "{}"),
    ("<div class='overflow-hidden'><p>{}</p></div><p>more</p>", "{}\nmore"),
    ("<article class='post category-legal comments-open'><p>{}</p></article><p>after</p>", "{}"),
    ("<div class=widget><article class=legal><p>{}</p><p class=share>s</p></article></div><p>after</p>", "{}"),
    ("<div class=modal><p>{}</p></div><p>after</p>", "{}\nafter"),
    ("<main><p>{}</p><div class='comments'><p>" + "c " * 400 + "</p></div></main>", "{}"),
    ("<div id=discussion><p>{}</p></div>", "{}"),
    ("<p>{}</p><div class=sidebar><article>card</article></div><div class='site-header'>h</div><div class=ad-box>a</div>", "{}")])
def test_class_words_do_not_empty_a_page(page, want):
    body = "the text of a page that is long enough " * 3
    assert shown([page.format(body)]) == [want.format(body.strip())]
    assert shown([page.format(f"{k} {body}") for k in range(4)])[3].startswith("3 the text")


@pytest.mark.parametrize("middle", [
    "<svg class='i' width=\"1\"/>", "<math/>", "<object data='a' />", "<iframe src='http://a/b/'/>", "<noscript>", "<object data=x>", "<svg>", "<template>",
    "<svg/><svg>" * 50, "<svg><path d='M0'/></svg>", "<script src='a'/>x</script>", "<iframe src=http://a/>x</iframe>"])
def test_skipped_elements_end(middle):
    assert shown([f"<body><p>one</p>{middle}<p>two</p><p>three</p></body>"]) == ["one\ntwo\nthree"]


@pytest.mark.parametrize("raw", ["script", "style", "title", "textarea", "xmp", "iframe"])
def test_raw_text_without_an_end_goes_on(raw):
    assert shown([f"<body><p>one</p><{raw}><p>two</p></body>"]) == ["one"]


def a_match(regex, rng):
    """Some text that the regular expression matches."""
    def one(parts):
        out = ""
        for kind, value in parts:
            if kind is sre.LITERAL:
                out += chr(value)
            elif kind is sre.ANY:
                out += "x"
            elif kind is sre.IN:
                low = [v if k is sre.LITERAL else v[0] for k, v in value]
                out += chr(rng.choice(low))
            elif kind is sre.BRANCH:
                out += one(rng.choice(value[1]))
            elif kind is sre.SUBPATTERN:
                out += one(value[-1])
            else:
                low, high, inner = value
                out += "".join(one(inner) for _ in range(rng.randint(low, min(high, low + 1))))
        return out

    return one(sre_parser.parse(regex))


def test_license_keywords_are_in_every_match():
    rng = random.Random(3)
    for rule in licenses.RULES:
        for _ in range(40):
            text = a_match(rule.regex, rng)
            assert re.fullmatch(rule.regex, text)
            assert all(f" {k}" in f" {text}" for k in rule.keywords), (rule, text)
            assert any(g.split()[0] in text for g in licenses.GATE) or "cc by" in text, (rule, text)


def test_license_scan_finds_what_ungated_rules_find(spark, monkeypatch):
    rng = random.Random(5)
    said = ["FreeBSD License", "0BSD License.", "the Unlicense", "open rail license", "CC0 1.0 Universal", "licensed for noncommercial use",
            "Redistribution and use in source and binary forms, with or without modification, are permitted", "you can redistribute it and/or modify it under "
            "the terms of the GNU General Public License", "Neither the name of X may be used to endorse or promote products",
            "All advertising materials mentioning features or use of this software"]
    rows = list(enumerate(said + [f"so {a_match(r.regex, rng)}, it says" for r in licenses.RULES]))
    out = licenses.scan(documents(spark, rows))
    monkeypatch.setattr(licenses, "RULES", [r._replace(keywords=()) for r in licenses.RULES])
    want = sorted(((i, *license_row(t)) for i, t in rows), key=repr)
    assert all(w[6] for w in want)
    assert got(out, "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score") == want


def test_of_equal_url_rules_the_later_holds_at_every_size(spark, monkeypatch):
    rules = [Rule("block", "a.org", "/x"), Rule("allow", "a.org", "/x"), Rule("allow", "b.org", "/"), Rule("block", "b.org", "/")]
    df = spark.createDataFrame([(1, "http://a.org/x"), (2, "http://b.org/x"), (3, "http://c.org/")], "page_id long, url string")
    want = [(1, "allow"), (2, "block"), (3, "allow")]
    assert got(judge(df, rules), "page_id", "verdict") == want
    monkeypatch.setattr(urls, "MAX_TRIE_BYTES", 0)
    assert got(judge(df, rules), "page_id", "verdict") == want
