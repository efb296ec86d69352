"""Collocations, main texts of pages and periodic runs against plain versions."""

import hashlib
import html
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest


from clearspark.llm import collocations, main_text, markup, periodic_runs
from clearspark.llm.queries import QUERIES
from clearspark.llm.suffix_runs import runs
from tests.llm.cases import empty_table, odd_rows, odd_table, prose

FOLDER = "/root/testdata/sf0.001"


def plain_runs(s, least):
    found, n = {}, len(s)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            a = i
            while i + q < n and s[i] == s[i + q]:
                i += 1
            if i + q - a >= max(2 * q, least) and i > a:
                found.setdefault((a, i + q - a), q)
            i += i == a
    return sorted(((a, length, q) for (a, length), q in found.items()), key=lambda r: (r[0], r[2]))


def test_suffix_trees_find_all_runs():
    rng = random.Random(1)
    for _ in range(1500):
        n, k = rng.randint(0, 40), rng.randint(1, 4)
        s = [rng.randint(1, k) for _ in range(n)]
        if n > 4 and rng.random() < 0.3:
            a = rng.randrange(n)
            p = rng.randint(1, max(1, (n - a) // 2))
            s = [s[i] if i < a else s[a + (i - a) % p] for i in range(n)]
        assert runs(s) == plain_runs(s, 2)
    assert runs([1] * 50_000, 12) == [(0, 50_000, 1)]


def plain_collapsed(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    found = plain_runs(words, 12)
    dropped = {i for a, n, q in found for i in range(a + q, a + n)}
    return found, b" ".join(w for i, w in enumerate(words) if i not in dropped).decode()


def test_runs_and_collapsed_texts(spark):
    rng = random.Random(3)
    texts = [r[1] for r in odd_rows() if not r[1] or len(r[1]) < 9000]
    for i in range(300):
        w = prose(i, rng.randint(1, 60), rng.choice([2, 5, 400])).split()
        at = rng.randrange(len(w))
        texts.append((rng.choice([" ", "\t\n", "  "])).join(w[:at] + w[at : at + rng.randint(1, 9)] * rng.randint(1, 9) + w[at:]))
    texts += ["a b " * 3000, "x " * 12, "x " * 11, "\x85 " * 14, "é " * 20 + "É " * 20]
    rows = [(i, t, "s", "c", 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows + rows[:3], "doc_id long, text string, runs string, Collapsed string, _text long")
    found = periodic_runs.find(docs, keep=["doc_id", "runs", "Collapsed", "_text"]).collect()
    assert len(found) == len(rows) + 3
    for r in found:
        expected, plain = plain_collapsed(texts[r.doc_id])
        assert [tuple(x) for x in r.runs_] == expected and r.collapsed_ == plain and (r.runs, r.Collapsed, r._text) == ("s", "c", 1)
    assert periodic_runs.find(empty_table(spark), ["doc_id"]).count() == 0


def test_query_of_runs_matches_a_plain_version(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    found = {r.doc_id: r for r in QUERIES["op13_periodic_runs"](spark, FOLDER).collect()}
    assert len(found) == docs.count()
    altered = 0
    for key, text in docs.collect():
        words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
        n, h = len(words), zlib.crc32(str(key).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            altered += 1
        elif n > 3000:
            continue  # the plain version is quadratic; test_runs_and_collapsed_texts has long ones
        if n > 3000:
            continue
        expected, plain = plain_collapsed(b" ".join(words).decode())
        r = found[key]
        assert r.n_runs == len(expected) and r.collapsed_sha256 == hashlib.sha256(plain.encode()).hexdigest()
        assert r.runs_sha256 == hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in expected).encode()).hexdigest()
        best = min(expected, key=lambda x: (-x[1], x[0], x[2]), default=None)
        assert (r.start, r.length, r.period) == (best or (None,) * 3)
        assert r.exponent_milli == (1000 * best[1] // best[2] if best else None)
    assert altered > 5


def plain_collocations(rows, threshold, most, inside=50):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            w = [x for x in re.split(r"[\x20\x09]+", piece) if x]
            totals[lang] += len(w)
            for size in (1, 2, 3):
                counts[lang].update(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
    out = []
    for lang, own in counts.items():
        longer = Counter()
        for g, a in own.items():
            if len(g) == 3 and a >= threshold:
                for part in (g[:2], g[1:]):
                    longer[part] = max(longer[part], a)
        listed = []
        for g, a in own.items():
            if len(g) > 1 and a >= threshold and not (g in longer and 100 * longer[g] >= inside * a):
                score, _, left, right = min((1000000 * a * a // (own[g[:k]] * own[g[k:]]), k, own[g[:k]], own[g[k:]]) for k in range(1, len(g)))
                listed.append((-score, -a, " ".join(g).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(listed)[:most], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def test_collocations_match_a_plain_count(spark):
    docs = odd_table(spark)
    more = [(i, " ".join(prose(i % 7, 30).split() + ["New  York\tcity"]) + "; the end! A.B:c,d", [None, "und", "en", "de", "es"][i % 5]) for i in range(60)]
    docs = docs.unionByName(spark.createDataFrame(more, "doc_id long, text string, lang string"), allowMissingColumns=True)
    rows = [(r.text, r.lang) for r in docs.select("text", "lang").collect()]
    for threshold, most in ((10, 2000), (3, 20)):
        found = collocations.collocations(docs, threshold=threshold, most=most).collect()
        assert sorted(tuple(r) for r in found) == plain_collocations(rows, threshold, most)
    assert collocations.collocations(empty_table(spark)).count() == 0
    assert collocations.collocations(docs.filter("text is null or trim(text) = ''")).count() == 0


def test_summaries_lose_nothing_at_the_threshold():
    rng = np.random.default_rng(2)
    keys = [rng.zipf(1.2, 4000).astype(np.uint32) % 5000 for _ in range(40)]
    parts = [np.unique(k, return_counts=True) for k in keys]
    truth = Counter(np.concatenate(keys).tolist())
    mass, threshold = sum(truth.values()), 200
    capacity = mass // threshold + 1
    keys, counts, off = *parts[0], 0
    for k, n in parts[1:]:
        keys, counts, less = collocations.merged([keys, k], [counts, n], capacity)
        off += less
        assert len(keys) <= capacity
    assert 0 < off < threshold and {k for k, n in truth.items() if n >= threshold} <= set(keys.tolist())
    assert all(0 <= truth[k] - n <= off for k, n in zip(keys.tolist(), counts.tolist(), strict=True))


def test_a_narrow_filter_only_costs_work(spark, monkeypatch):
    docs = spark.createDataFrame([(i, prose(i % 9, 200, 60), "en") for i in range(40)], "doc_id long, text string, lang string")
    expected = sorted(tuple(r) for r in collocations.collocations(docs).collect())
    monkeypatch.setattr(collocations, "MOST_BITS", 8)
    monkeypatch.setattr(collocations, "MASS", 1 << 10)
    monkeypatch.setattr(collocations, "CAPACITY", 1)
    assert sorted(tuple(r) for r in collocations.collocations(docs).collect()) == expected


def test_main_text_of_the_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    found = {r.page_id: r for r in QUERIES["op12_main_text"](spark, "/root/testdata/sf0.01").collect()}
    assert len(found) == pages.count()
    for page in pages.collect():
        article = re.search("<article>(.*?)</article>", page.html, re.S)[1].replace("<br>", " ")
        parts = [" ".join(html.unescape(re.sub("</?b>", "", x)).split()) for x in re.split("</?(?:p|h1)>", article)]
        expected = "\n\n".join(x for x in parts if x)
        assert found[page.page_id].text == expected and found[page.page_id].n_chars == len(expected)


A, B, C = prose(1, 40), prose(2, 50), prose(3, 30)
MENU = "".join(f"<li><a href='/{i}'>Topic {i} here</a></li>" for i in range(12))
ARTICLE = f"<h1>The  title &amp; more</h1><p>{A}<p>{B}<b>bold</b> &eacute;nd<br>new line</p><blockquote>{C}</blockquote>"
PLAIN = f"The title & more\n\n{A}\n\n{B}bold énd new line\n\n{C}"
AROUND = {
    "nothing": "{}",
    "divisions": "<html><head><title>T</title><style>p > a {{}}</style></head><body><div id=top><ul class='nav-menu'>" + MENU + "</ul></div><div class=story>{}</div><div class='site-footer'><p>Copyright 2020 all rights reserved by us</p></div></body></html>",
    "unclosed": "<body><nav><ul>" + MENU + "<article>{}</article><footer>&copy; us and them",
    "upper case": "<BODY><NAV>" + MENU + "</NAV><MAIN>{}</MAIN><ASIDE><P>Read also these five other stories of ours</ASIDE></BODY>",
    "scripts": "<script>if (a < b) document.write('<p>no no no no no no</p>')</script><noscript><p>enable scripts</p></noscript><!-- <p>no</p> --><article>{}</article><script>track('</p>')",
    "notices": "<div role=alert>We use cookies, do you accept all of them?</div><div class='cookie-consent'><p>We use cookies to be of service to you</p></div><article>{}</article>",
    "comments": "<main><article>{}</article><section id='comments'><h2>Comments</h2><article class='comment'><p>" + prose(9, 60) + "</p></article></section></main>",
    "form round all": "<form id='aspnetForm'><div class=menu><ul>" + MENU + "</ul></div><main>{}</main></form>",
    "form": "<article>{}</article><form><label>Name</label><input name=a value='>'><button>Send it now</button><textarea>Your <p> text</textarea></form>",
    "odd quotes": "<body class='a><b'><div title='x > y' class=lead>{}</div><a href=\"unclosed>",
}


@pytest.mark.parametrize("name", sorted(AROUND))
def test_main_text_among_other_things(name):
    page = AROUND[name].format(ARTICLE)
    assert main_text.main_text(page, main_text.Model()) == PLAIN, name


def test_adverts_inside_the_article_are_left_out():
    inside = ARTICLE.replace("<blockquote>", "<div class='ad'>Buy now!</div><aside>Related</aside><figure><script>x</script></figure><blockquote>")
    assert main_text.main_text(f"<body><nav>{MENU}</nav><article>{inside}</article></body>", main_text.Model()) == PLAIN


def test_pages_of_any_kind(spark):
    odd = [None, "", " \n ", "plain text", "<p>", "<", "<a", "</", "<p>a<!--", "<script>", "&amp;&#65;&bogus;&am", "<p hidden>x</p>", "<nav>only a menu</nav>", "<!DOCTYPE html>", "a b"]
    odd += ["<div>" * 3000 + "deep", "<p>word " * 20000, "<p a='" * 300, "<b" * 3000]
    rows = [(i, t, "u", "x", 1) for i, t in enumerate(odd)]
    pages = spark.createDataFrame(rows + rows[3:5], "page_id long, html string, url string, Text string, _html long")
    model = main_text.fit(pages)
    found = main_text.extract(pages, model, keep=["page_id", "url", "Text", "_html"]).collect()
    assert len(found) == len(rows) + 2
    text = {r.page_id: r.text_ for r in found}
    expected = {0: "", 1: "", 2: "", 3: "plain text", 4: "", 8: "a", 9: "", 10: "&A&bogus;&am", 11: "x", 12: "only a menu", 14: "a b"}
    assert {k: text[k] for k in expected} == expected and text[15] == "deep" and text[16].count("word") == 20000
    assert all(r.n_chars == len(r.text_) and r.Text == "x" for r in found)
    none = main_text.fit(pages.limit(0))
    assert none.cost == 2.0 and main_text.extract(pages.limit(0), none, ["page_id"]).count() == 0


def test_weights_come_from_labelled_pages(spark):
    pages = [(i, f"<body><div>{prose(i, 25)}</div><article><td>{prose(i + 99, 40)}</td></article><div>{prose(i + 7, 25)}</div>") for i in range(40)]
    model = main_text.fit(spark.createDataFrame(pages, "page_id long, html string"))
    assert model.word("td||") > 0.9 > 0.2 > model.word("div||")
    bare = f"<body><div>{A}</div><section><td>{B}</td></section><div>{C}</div>"
    assert main_text.main_text(bare, model) == B and main_text.main_text(bare, main_text.Model()) != B


def test_pieces_name_what_they_stand_in():
    row = markup.pieces("<p>a<a href=x>b</a><nav>c</nav></p><article>d</article>")
    assert [(p.text, p.name, p.link, p.shut, p.marked) for p in row if p.text is not None] == [
        ("a", "p", False, False, False), ("b", "p", True, False, False), ("c", "nav", False, True, False), ("d", "article", False, False, True),
    ]
