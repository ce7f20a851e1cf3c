import math
import re

import pytest
from pyspark.sql import functions as F

from ascenta.llm import html, quality, urls

PAGE = """<html><head><title>T</title><style>p{x}</style><script>var t="</p><p>no</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav><div class="cookie-notice">We use cookies.</div>
<main><article><h2>A &amp; B</h2><p>First   paragraph,
over lines.</p><aside>See also</aside><div class="ad">Buy</div><p>Second &eacute;t&eacute;<br>line <b>bold</b>.</p><ul><li>one<li>two</ul>
<section id="comments"><p>Reader says hello.</p></section></article></main><form><p>Sign up</p></form><footer>&copy; x</footer></body></html>"""


def test_article():
    assert html.extract_text(PAGE) == "A & B\n\nFirst paragraph, over lines.\n\nSecond été line bold.\n\none\n\ntwo"


def test_density_without_marks():
    links = "".join(f"<li><a href='/{i}'>link {i}</a></li>" for i in range(20))
    body = "".join(f"<p>This paragraph number {i} is long enough to be prose and says so at length.</p>" for i in range(5))
    page = f"<body><div><ul>{links}</ul></div><div><div>{body}</div></div></body>"
    assert html.extract_text(page) == "\n\n".join(f"This paragraph number {i} is long enough to be prose and says so at length." for i in range(5))


@pytest.mark.parametrize("text", [None, "", "<", "<a href=\"x", "<!--", "</", "<p", "<script>", "<div>" * 3000, "<a href=\"" * 3000, "&#0;&#xFFFFFFFF;&bogus;", "<p hidden>x", "<br/>" * 50])
def test_broken_pages(text):
    assert isinstance(html.extract_text(text), str)


def test_plain_text_and_entities():
    assert html.extract_text("just &lt;text&gt;") == "just <text>"
    assert html.extract_text("<p>a<p>b") == "a\n\nb"


def test_pages(spark):
    df = spark.createDataFrame([(1, "u", PAGE, "clash"), (None, None, None, None), (1, "u", PAGE, "clash")], "page_id long, url string, html string, text string")
    found = html.extract_pages(df).collect()
    assert [(r.n_chars, r.page_id) for r in found].count((len(html.extract_text(PAGE)), 1)) == 2
    assert [(r.text, r.n_chars) for r in found if r.page_id is None] == [("", 0)]
    assert html.extract_pages(df.limit(0)).count() == 0


SIDE = "<div class='sidebar'><h3>More</h3><ul>" + "".join(f"<li><a href='/{i}'>Some link text number {i}</a></li>" for i in range(9)) + "</ul></div>"
REMARKS = "<section id='comments'><h2>Comments</h2>" + "".join(f"<article class='comment'><p>Reader {i} says at some length that this is quite right.</p></article>" for i in range(9)) + "</section>"
FRONT = "<header class='site-header'><h1>Site name</h1></header><div class='cookie-notice'><p>We use cookies. Accept them all, please.</p></div>"
ARTICLE = "<h1>A headline</h1><p>The first paragraph, which is of some length, as they are.</p><p>No.</p><p>A third one that says a little more than the second did before it.</p>"
ARTICLE_TEXT = "A headline\n\nThe first paragraph, which is of some length, as they are.\n\nNo.\n\nA third one that says a little more than the second did before it."


@pytest.mark.parametrize("page", [
    f"<div class='content with-sidebar'>{ARTICLE}</div>",
    f"<div class='post no-ads'>{ARTICLE}</div>",
    f"<div class='share-of-market'>{ARTICLE}</div>",
    f"<body class='has-sidebar'><form action='/'>{FRONT}<div>{ARTICLE}</div>{SIDE}</form></body>",
    f"{FRONT}<article><header>{ARTICLE[:19]}</header>{ARTICLE[19:]}</article>{REMARKS}",
    f"{FRONT}{SIDE}<div id='main-content'>{ARTICLE}{REMARKS}</div><div class='ad-slot'>Buy it.</div>",
    f"{FRONT}<div class='row'><div class='col'><section>{ARTICLE[:19]}</section><section>{ARTICLE[19:]}</section></div><div class='col'>{SIDE.replace('sidebar', 'x')}</div></div>",
    f"<div>{ARTICLE}</div><form class='signup-form'><p>Sign up for our letters.</p><input name='a'></form><footer><p>All of it is ours.</p></footer>",
    f"<main>{ARTICLE}</main><p hidden>Not seen.</p><div style='display: none'>Nor this.</div><a href='x",
])
def test_pages_without_an_article_element(page):
    assert html.extract_text(page) == ARTICLE_TEXT


def test_cut_off_tags():
    assert html.extract_text('<p>hello there <a href="x') == "hello there" == html.extract_text("<p>hello there <a")
    assert html.extract_text("<div class='comments'><p>only words</p></div>") == "only words"


COMMON = dict.fromkeys("the of and he she win free track cheap spa rm win cow web".split(), 0.002)


def test_segments():
    model = urls.train_url_model(COMMON)
    assert urls.segment("casinowin", model) == ["casino", "win"] and urls.segment("thefreelibrary", model) == ["the", "free", "library"]
    assert urls.segment("tiontion", model) == ["tiontion"] and urls.segment("", model) == [] and urls.segment("heads", model) == ["heads"]
    blocked = ["casino-win", "freebets", "cheap-pills", "adstrack", "spam-farm", "blog.adult-x"]
    assert all(urls.block_score(f"{h}.example.com", "/en/1", model) > 0 for h in blocked)
    assert all(urls.block_score(f"{h}.example.com", "/en/1", model) <= 0 for h in ("ththre", "winston", "sportsnews", "sexeducation", "heads", "free-track", ""))


def test_scores_are_naive_bayes():
    """The log odds against the textbook product of smoothed word rates."""
    block, allow = ["spam", "bets", "bets"], ["news", "post", "spam", "blog", "wiki"]
    model = urls.train_url_model(COMMON, block, allow, ["www"], smoothing=0.5, block_share=0.2)
    words = set(block) | set(allow)
    size = 5

    def rate(word, own):
        return (own.count(word) * size / len(own) + 0.5) / (size + 0.5 * len(words))

    for host, path in (("spam.bets", "/news"), ("www.wiki.zzz", "/post/9"), ("", "")):
        want = math.log(0.2 / 0.8)
        for w in re.findall("[a-z]+", f"{host} {path}"):
            if w in words:
                want += math.log(rate(w, block) / rate(w, allow))
        assert urls.block_score(host, path, model) == pytest.approx(want)


def test_shares_of_all_words(spark):
    rows = [("http://Spam.ham.com/a/bb", "<p class='zz'>Bb cc<b>cc</b></p>"), (None, None), ("bb", "")]
    df = spark.createDataFrame(rows, "url string, html string")
    words = ["http", "spam", "ham", "com", "bb", "bb", "cc", "cc", "bb"]
    assert urls.unigram_shares(df) == {w: words.count(w) / len(words) for w in words}
    assert urls.unigram_shares(df, least=0.3) == {"bb": 3 / 9} and urls.unigram_shares(df.limit(0)) == {}


def test_rules(spark):
    rules = {"block": ["net/", "example.com/de/"], "allow": ["example.net/en/", "org/fr/"]}
    cases = {
        "https://a.example.net/en/1?x#y": ("a.example.net", "/en/1", "example.net/en/", "allow"),
        "https://A.EXAMPLE.net/EN/": ("a.example.net", "/EN/", "net/", "block"),
        "http://casinowin.org/fr/2": ("casinowin.org", "/fr/2", "org/fr/", "allow"),
        "http://casinowin.org/en/2": ("casinowin.org", "/en/2", None, "block"),
        "http://notexample.com/de/": ("notexample.com", "/de/", None, "allow"),
        "http://b.net": ("b.net", "", None, "allow"),
        "http://b.net?q=/": ("b.net", "", None, "allow"),
        "nothing": ("", "", None, "allow"),
        "a://b://c/d": ("b:", "//c/d", None, "allow"),
        "": ("", "", None, "allow"),
    }
    df = spark.createDataFrame([(k, u, "x") for k, u in enumerate([*cases, None])], "page_id long, url string, host string")
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.filter_urls(df, rules).collect()}
    assert found == dict(enumerate([*cases.values(), ("", "", None, "allow")]))
    assert urls.filter_urls(df.limit(0), rules).count() == 0


def test_quality_learns(spark, edge, empty):
    good = [f"The {a} of the {b} was seen near the {c}, and it was good." for a in ("bird", "fox", "cat", "dog") for b in ("hill", "town", "road", "lake") for c in ("mill", "barn", "sea", "wood")]
    bad = [f"{a}*** {b}### {c}$$$ {b}%%%" for a in ("bird", "fox", "cat", "dog") for b in ("hill", "town", "road", "lake") for c in ("mill", "barn", "sea", "wood")]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(good + bad)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 64), 0) for i in range(128)] + [(5, 1, 0), (None, 1, 0), (6, None, 0)], "doc_id long, quality int, toxic int")
    weights = quality.train_quality(docs, labels)
    found = quality.score_quality(docs, weights).collect()
    assert all(r.predicted == int(r.doc_id < 64) for r in found if r.held_out) and any(r.held_out for r in found)
    assert weights == quality.train_quality(docs.repartition(5), labels)
    scores = quality.score_quality(edge, weights)
    assert scores.count() == edge.count() and scores.where("score IS NULL OR score < 0 OR score > 1").count() == 0
    assert quality.score_quality(empty, weights).count() == 0
    nothing = quality.train_quality(empty, labels.limit(0))
    assert {r.score for r in quality.score_quality(docs.limit(3), nothing).collect()} == {0.5}


def test_scores_against_plain_loops(spark):
    """Training and scores against follow-the-regularised-leader over dictionaries, with hashes made word by word."""
    import random
    import zlib

    import xxhash

    r = random.Random(8)
    settings = quality.Settings(bits=10, epochs=2, train_rows=40)
    texts = [" ".join(r.choice(["Oak", "elm", "ash!", "12", "#x", "fir"]) for _ in range(r.randint(0, 9))) for _ in range(90)]
    labels = [r.randint(0, 1) for _ in texts]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    marked = spark.createDataFrame(list(enumerate(labels)), "doc_id long, quality int")
    mask = (1 << 64) - 1

    def mix(x):
        x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & mask
        x = (x ^ (x >> 27)) * 0x94D049BB133111EB & mask
        return x ^ (x >> 31)

    def features(text):
        words = text.split()
        shape = lambda w: re.sub("[0-9]+", "0", re.sub("[a-z]+", "a", re.sub("[A-Z]+", "A", w)))
        a = [xxhash.xxh3_64_intdigest(w.lower().encode()) for w in words]
        b = [xxhash.xxh3_64_intdigest(shape(w).encode(), 1) for w in words]
        pairs = lambda v: [(x * 0x9E3779B97F4A7C15 + y) & mask for x, y in zip(v, v[1:], strict=False)]
        out = {}
        for view, values in enumerate((a, b, pairs(a), pairs(b), [int(x == y) for x, y in zip(a, a[1:], strict=False)]), 1):
            for v in values:
                slot = mix((v + view) & mask) >> (64 - settings.bits)
                out[slot] = out.get(slot, 0.0) + settings.scale / len(values)
        return out | {"bias": 1.0}

    keys = {x.doc_id: x.k for x in docs.select("doc_id", F.xxhash64("doc_id").alias("k")).collect()}
    chosen = sorted((keys[i], i) for i in range(len(texts)) if zlib.crc32(str(i).encode()) % 5)[:40]
    z, n = {}, {}

    def weight(k):
        if abs(z.get(k, 0.0)) <= settings.l1:
            return 0.0
        sign = 1 if z[k] > 0 else -1
        return -(z[k] - sign * settings.l1) / ((settings.beta + n[k] ** 0.5) / settings.alpha + settings.l2)

    logistic = lambda x: 1 / (1 + math.exp(-x))
    order = sorted((k, labels[i], i) for k, i in chosen)
    for _ in range(settings.epochs):
        for _, label, i in order:
            x = features(texts[i])
            w = {k: weight(k) for k in x}
            p = logistic(sum(w[k] * x[k] for k in x))
            for k, v in x.items():
                g = (p - label) * v
                z[k] = z.get(k, 0.0) + g - ((n.get(k, 0.0) + g * g) ** 0.5 - n.get(k, 0.0) ** 0.5) / settings.alpha * w[k]
                n[k] = n.get(k, 0.0) + g * g
    want = {i: logistic(sum(weight(k) * v for k, v in features(t).items())) for i, t in enumerate(texts)}
    found = quality.score_quality(docs, quality.train_quality(docs, marked, settings), settings).collect()
    assert all(x.score == pytest.approx(want[x.doc_id], abs=1e-5) for x in found) and max(want.values()) - min(want.values()) > 0.2


def test_held_out_is_crc32(spark):
    import zlib

    df = spark.range(200).withColumnRenamed("id", "doc_id").withColumn("h", quality.held_out())
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in df.collect())
    assert df.select(F.lit(None).cast("long").alias("doc_id")).select(quality.held_out().alias("h")).first().h is False
