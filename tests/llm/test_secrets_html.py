"""Secret scan and HTML extraction."""

import hashlib
import random
import re

import pytest

from sentimart.llm import html_extract as H
from sentimart.llm import queries
from sentimart.llm import secret_scan as S

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, spans string"


def slow_base(text):
    """The base spans, straight from the contract."""
    text, out = text or "", []
    key = "(?:" + "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in k)
                           for k in ("password", "passwd", "secret", "token", "api_?key")) + ")"
    for kind, pattern, least in (("assign", key + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6), ("access", "(AKIA[A-Z0-9]+)", 20),
                                 ("hex", "([0-9a-f]+)", 24)):
        out += [(m.start(), ("assign", "access", "hex").index(kind), f"{kind}:{m.start()}:{m.end()}")
                for m in re.finditer(pattern, text) if len(m[1]) >= least]
    return [x[2] for x in sorted(out)]


TEXTS = [
    None, "", "password=abc", 'PassWD : "abcdef', "token=token: abcdef", "api_key=x apikey='y12345' API_KEY=  zzzzzz", "é\U0001f600 secret=a.b-c_d",
    "ſecret=abcdefg toKen=abcdefg", "AKIA" + "A" * 15, "AKIA" + "A" * 16, "xAKIAAKIA" + "B9" * 10 + "c", "a" * 23, "b" * 24, "0" * 30 + "G" + "f" * 24,
    "token = \"" + "0123456789abcdef" * 3 + '"', "secret\t=abcdefg", "password==abcdefg password:=abcdefg",
]


def test_base_spans(spark):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(None, TEXTS[14], "x"), (3, TEXTS[3], "x")]
    rows += [(r.doc_id + 1000, r.text, "x") for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = S.secrets(spark.createDataFrame(rows, DOCS)).collect()
    text = {r[0]: r[1] for r in rows}
    assert len(got) == len(rows)
    for r in got:
        want = slow_base(text[r.doc_id])
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(x.startswith(k + ":") for x in want) for k in S.KINDS]
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [x for x in r.spans.split(",") if x and not x.startswith("grammar")] == want


def test_grammars_add_credentials_and_spare_text(spark):
    rng = random.Random(5)
    value = lambda chars, n: "".join(rng.choice(chars) for _ in range(n))
    syllables = ["ther", "in", "on", "ed", "an", "tion", "re", "st", "ou", "ble"]
    words = lambda n: " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 6))) for _ in range(n))
    up, hexa = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "0123456789abcdef"
    rows = [(i, f"{words(60)} password={value(hexa, 18)} {words(9)} AKIA{value(up, 16)} x", "") for i in range(150)]
    rows += [(1000 + i, f"{words(40)} pw {value(hexa, 18)} {words(5)}", "") for i in range(40)]
    rows += [(2000 + i, f"{words(40)} card 4{value('0123456789', 15)} at {value('0123456789', 12)} mail{i}.example.com {words(30).upper()}", "") for i in range(60)]
    got = {r.doc_id: r for r in S.secrets(spark.createDataFrame(rows, DOCS)).collect()}
    for i, text, _ in rows[150:]:
        want = [f"grammar:{m.start()}:{m.end()}" for m in re.finditer(r"(?<=pw )\S+", text)]
        assert [x for x in got[i].spans.split(",") if x] == want
    assert all(got[i].n_grammar == 0 and got[i].n_assign == got[i].n_access == 1 for i in range(150))


def test_many_bare_credentials(spark):
    """A third of the rows hold distinct credentials that no base pattern labels."""
    rng = random.Random(8)
    value = lambda chars, n: "".join(rng.choice(chars) for _ in range(n))
    syllables = ["ther", "in", "on", "ed", "an", "tion", "re", "st", "ou", "ble"]
    words = lambda n: " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 6))) for _ in range(n))
    hexa = "0123456789abcdef"
    rows = [(i, f"{words(30)} token={value(hexa, 20)} {words(20)}", "") for i in range(400)]
    rows += [(1000 + i, f"{words(20)} {value(hexa, 20)} {value(hexa, 20)} {value(hexa, 20)} {words(20)}", "") for i in range(800)]
    rows += [(2000 + i, words(50), "") for i in range(1200)]
    rows += rows[400:500]  # copies show nothing new
    got = S.secrets(spark.createDataFrame(rows, DOCS)).collect()
    bare = sum(r.n_grammar for r in got if 1000 <= r.doc_id < 2000)
    print(f"bare credentials found {bare} of {3 * 900}, spans in ordinary rows {sum(r.n_grammar for r in got if r.doc_id >= 2000)}")
    assert bare >= 0.98 * 3 * 900
    assert all(r.n_grammar == 0 for r in got if r.doc_id >= 2000 or r.doc_id < 1000)


def test_pieces_beside_base_spans():
    """What is left of a run beside base spans is a candidate; what lies in one is none."""
    rng = random.Random(3)
    for _ in range(300):
        text = "".join(rng.choice(["password=", "AKIA" + "B" * 16, "f" * 24, "/", "xY7", "longerword", " ", "= ", "token:abcdef"]) for _ in range(rng.randint(1, 25)))
        spans = S.base_spans(text)
        inside = {i for a, _, b in spans for i in range(a, b)}
        want, at = [], None
        for i in range(len(text) + 1):  # maximal stretches of credential characters outside the spans, within runs of LEAST_RUN
            ok = i < len(text) and i not in inside and re.match(S.SHORT.pattern, text[i])
            if ok and at is None:
                at = i
            elif not ok and at is not None:
                want.append((at, i))
                at = None
        assert S.free_runs(text, spans) == [(a, b) for a, b in want if b - a >= S.LEAST_RUN]
    key = "wJalrXUtnFEMIK7MDENGbPxRfiCYEXAMPLEKEYab"
    assert S.free_runs("AKIA" + "Z9" * 8 + "/" + key, [(0, 1, 20)]) == [(20, 21 + len(key))]


def test_long_text_in_linear_time():
    import time
    took = []
    for n in (4_000, 16_000):
        text = "password=abcdef1 someLongerRunOfText " * n
        t = time.process_time()
        assert len(S.free_runs(text, S.base_spans(text))) == n
        took.append(time.process_time() - t)
    assert took[1] < 8 * took[0] + 0.2


def test_automaton_generalises():
    rng = random.Random(6)
    a = S.Automaton(["AB" + "".join(rng.choice("01") for _ in range(rng.randint(4, 9))) for _ in range(200)])
    assert len(a.kept) <= 6
    assert a.score("AB0101011101") > a.score("BA01010111") and a.score("AB010101") > a.score("AB0101xx")


@pytest.mark.parametrize("n", [0, 1])
def test_no_credentials(spark, n):
    got = S.secrets(spark.createDataFrame([(1, "plain words only", "x")] * n, DOCS)).collect()
    assert [(r.spans, r.n_grammar) for r in got] == [("", 0)] * n


def test_tree_learns_its_table():
    rows = H.labelled()
    assert all(H.keeps(H.default_tree(), x) == bool(y) for x, y in rows)


def test_held_out_layouts():
    """Each layout is judged by a tree trained on the others' blocks."""
    hits = total = 0
    for i in range(len(H.LAYOUTS)):
        rest = [r for j, layout in enumerate(H.LAYOUTS) if j != i for r in zip(
            H.features(H.blocks("".join(m.replace("%", "w " * n) for m, n, _ in layout))), [y for _, _, y in layout], strict=True)]
        tree = H.train(rest)
        found = H.blocks("".join(m.replace("%", "w " * n) for m, n, _ in H.LAYOUTS[i]))
        hits += sum(H.keeps(tree, x) == bool(y) for x, (_, _, y) in zip(H.features(found), H.LAYOUTS[i], strict=True))
        total += len(found)
    assert hits / total > 0.9


PARA = "Fish &amp; chips&nbsp;cost 3 &lt; 4, x&#233; <b>bo</b>ld\n  text that runs on for a while so that it reads as prose."
PLAIN = "Fish & chips cost 3 < 4, xé bold text that runs on for a while so that it reads as prose."
PAGES = [
    (None, ""), ("", ""), ("  \n ", ""), ("<html><body></body></html>", ""),
    (f"<head><title>T</title><style>p>a{{}}</style></head><nav><a href='a>b'>Home</a></nav><article><h1>Head line here</h1><p>{PARA}</p></article><footer>foot {PARA}</footer>",
     f"Head line here {PLAIN}"),
    (f"<ARTICLE><P>{PARA}<P>{PARA}<script>if (a<b) '</p>'</script><!-- <p>no</p> --></ARTICLE><div class=\"comments\"><article><p>{PARA}</p></article></div>", f"{PLAIN} {PLAIN}"),
    (f"<nav><ul><li>open<article><p>{PARA}</p></article>", PLAIN),
    (f"<div id='cookie-notice'>{PARA}</div><main><header><h1>Title of it</h1></header><p>{PARA}</p><form>{PARA}<input></form></main><aside>{PARA}</aside>", f"Title of it {PLAIN}"),
    (f"<article><p>{PARA}</p><p>cut off here &am", f"{PLAIN} cut off here &am"), (f"<article><p>{PARA}</p><p cla", PLAIN),
    (f"<article><p>{PARA}</p><script>var x = 1; <p>no", PLAIN), (f"<article><p>a < b and c<d</p><p>{PARA}</p></article>", None),
    (f"<article>one<br>two <table><tr><td>three</td><td>four five</td></tr></table><p>{PARA}</p></article>", f"one two three four five {PLAIN}"),
    ("<article>" + f"<p>{PARA}</p>" * 2000 + "</article>", " ".join([PLAIN] * 2000)),
]


def test_pages(spark):
    rows = [(i, "u", h, "clash") for i, (h, _) in enumerate(PAGES)] + [(None, None, PAGES[4][0], "clash"), (4, "u", PAGES[4][0], "clash")]
    got = H.extracted(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    want = {i: t for i, (_, t) in enumerate(PAGES)} | {None: PAGES[4][1]}
    assert len(got) == len(rows)
    for r in got:
        assert want[r.page_id] in (None, r.text) and r.n_chars == len(r.text)


@pytest.mark.parametrize("tag", ["noscript", "button", "select", "object", "svg", "iframe", "template"])
def test_unclosed_elements(tag):
    article = f"<article><p>{PARA}</p></article>"
    assert H.main_text(f"<body><div><{tag}>no <b>text</b><p>here</div>{article}") == PLAIN
    assert H.main_text(f"<ul><li><{tag}>no text</li></ul>{article}") == PLAIN
    assert H.main_text(f"<div><{tag}><div>no</div> text <style>a </div> b</style></{tag}></div>{article}") == PLAIN
    assert H.main_text(f"<head><title>T</title><{tag}>no<body>{article}") == PLAIN
    assert H.main_text(f"<article><p>{PARA}</p><section><{tag}>no</section><p>{PARA}</p></article>") == f"{PLAIN} {PLAIN}"


def test_head_left_open():
    article = f"<article><p>{PARA}</p></article>"
    for head in ("<head><title>T a <b </title><meta charset=utf-8>", "<head><base href=x><script>'<body>'</script><style>p</style>", "<head>", "<HEAD><link rel=x></HEAD>"):
        for body in ("<body>", ""):
            assert H.main_text(f"<html>{head}{body}{article}") == PLAIN
    for tag in ("script", "style", "textarea", "title"):
        assert H.main_text(f"<head>{article}<{tag}>no {article}") == PLAIN
    assert H.main_text(f"<svg><title>no<title>no</svg>{article}") == PLAIN


def test_registered_pages(spark):
    import html

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    for r in queries.op10_html_extraction(spark, SMALL).collect():
        inside = re.search(r"<article>(.*?)(?:</article>|\Z)", pages[r.page_id], re.S)[1]
        assert r.text == " ".join(html.unescape(re.sub(r"<[^>]*(?:>|\Z)", " ", inside)).split())


@pytest.mark.parametrize("opening", [
    "<div id=page class='hfeed has-sidebar'><article>", "<article class='post-1 comments-open'>", "<main class=search-enabled>",
    "<div class='entry-content ad-supported'>", "<div id='page' class='site no-banner'><div class='content-area'>", "<section class='menu-item-has-children'>",
    "<body class='home share-count sidebar-none'><article role=main id=login-required>"])
def test_everyday_markup_keeps_its_article(opening):
    page = f"<nav><a>Home</a> <a>News</a></nav>{opening}<p>{PARA}</p><p>He said no.</p><p>{PARA}</p>"
    assert H.main_text(page) == f"{PLAIN} He said no. {PLAIN}"


@pytest.mark.parametrize("name", ["sidebar", "cookie-notice", "site-footer", "ad", "comments", "primary-menu", "related-posts", "newsletter", "top_banner"])
def test_furniture_by_its_whole_name(name):
    for attribute in (f"class='{name}'", f"id={name}", f'class="x {name.upper()} y"'):
        assert H.main_text(f"<div {attribute}><p>{PARA}</p></div><article><p>{PARA}</p></article>") == PLAIN


LONG = "A paragraph that runs on for long enough to be told from the links around it, as the paragraphs of an article do, with some words to spare at its end."
MENU = "<div><a>Home</a></div><div><a>All news</a></div><div><a>Contact us here</a></div>"
DIVS = [  # pages without a word of markup that helps
    (f"{MENU}<div>{LONG}</div><div>He said no.</div><div>{LONG}</div>{MENU}", f"{LONG} He said no. {LONG}"),
    (f"{MENU}<div>A heading of the article</div><div>{LONG}</div>{MENU}<div>Copyright of the site</div>{MENU}", f"A heading of the article {LONG}"),
    (f"{MENU}<div>{LONG}</div><div><a>A linked paragraph between two others that are not linked</a></div><div>{LONG}</div>{MENU}",
     f"{LONG} A linked paragraph between two others that are not linked {LONG}"),
    (f"<div>{LONG}</div>" + "<div><a>One more linked headline of the many that follow each other here</a></div>" * 5 + "<div>Read these</div>" + MENU, LONG),
    (f"{MENU}<div>{LONG}</div><div>No.</div><div>Why not?</div><div>He said no.</div><div>{LONG}</div>{MENU}", f"{LONG} No. Why not? He said no. {LONG}"),
    (f"{MENU}<div>{LONG}</div><div>{LONG}</div><div>The end.</div>", f"{LONG} {LONG} The end."),
]


@pytest.mark.parametrize("page, text", DIVS)
def test_neighbours_decide_where_markup_does_not(page, text):
    assert H.main_text(page) == text


def _nodes(tree):
    return [tree, *_nodes(tree.low), *_nodes(tree.high)] if isinstance(tree, H.Node) else []


@pytest.mark.parametrize("feature", ["words_before", "link_density_before", "words_after", "link_density_after"])
def test_each_neighbour_feature_counts(feature):
    """It occurs in the tree, and a tree without it misjudges labelled blocks."""
    at = H.FEATURES.index(feature)
    assert any(n.feature == at for n in _nodes(H.default_tree()))
    blank = lambda x: (*x[:at], 0, *x[at + 1:])
    rows = H.labelled()
    without = H.train([(blank(x), y) for x, y in rows])
    assert sum(H.keeps(without, blank(x)) != bool(y) for x, y in rows) > 0


def test_deep_pages_in_linear_time():
    import time
    took = []
    for n in (20_000, 80_000):
        t = time.process_time()
        assert H.main_text("<div>" * n + "</section>" * n + f"<article><p>{PARA}</p></article>" + "</div>" * n) == PLAIN
        took.append(time.process_time() - t)
    assert took[1] < 12 * took[0] + 0.5


def test_empty_pages(spark):
    assert H.extracted(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
