"""Personal data, main text, toxicity and quality: brute force, round trips, held-out accuracy."""

import random
import re

import pytest

from roundbook.llm import html_text, pii, quality, toxicity

BASE = ("email", "ip", "card", "phone")


def slow_spans(t):
    t, out = t or "", []
    out += [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if max(map(int, m[0].split("."))) <= 255]
    for kind, pattern in (("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(pattern, t):
            d = [int(c) for c in m[0] if c in "0123456789"]
            luhn = sum(sum(divmod(x * (1 + i % 2), 10)) for i, x in enumerate(reversed(d))) % 10 == 0
            if (14 <= len(d) <= 19 and luhn) if kind == "card" else 10 <= len(d) <= 15:
                out.append((kind, *m.span()))
    return sorted(out, key=lambda s: (s[1], BASE.index(s[0])))


def test_base_spans_equal_the_patterns():
    rng = random.Random(2)
    for _ in range(30_000):
        t = "".join(rng.choice("0123456789..@+- a()b-é") for _ in range(rng.randint(0, 45)))
        assert [s for s in pii.find(t) if s[0] in BASE] == slow_spans(t), t


@pytest.mark.parametrize(
    "text, kind, part",
    [
        ("see https://ex.org/a?b=1, ok", "url", "https://ex.org/a?b=1"),
        ('token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"', "secret", "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"),
        ("IBAN: DE89 3704 0044 0532 0130 00.", "account", "DE89 3704 0044 0532 0130 00"),
        ("Account no. 12-345-678!", "account", "12-345-678"),
    ],
)
def test_added_spans(text, kind, part):
    assert [(k, text[a:b]) for k, a, b in pii.find(text) if k not in BASE] == [(kind, part)]


def test_redaction_keeps_rows_and_other_columns(spark):
    rows = [(1, "mail a.b@c.de now", "spans"), (1, "mail a.b@c.de now", "spans"), (None, None, "x"), (2, "", "y"), (3, "clean", "z"), (4, "1.2.3.4 " * 3000, "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    done = pii.redact(docs)
    assert done.columns == docs.columns
    got = sorted(done.collect(), key=str)
    want = [(1, "mail [EMAIL] now", "spans")] * 2 + [(None, None, "x"), (2, "", "y"), (3, "clean", "z"), (4, "[IP] " * 3000, "w")]
    assert [tuple(r) for r in got] == sorted(want, key=lambda r: str(docs.sparkSession and _row(r)))
    assert pii.report(docs.limit(0)).count() == 0
    assert sorted(len(r["spans"]) for r in pii.report(docs).collect()) == [0, 0, 0, 1, 1, 3000]


def _row(values):
    from pyspark.sql import Row

    return Row(doc_id=values[0], text=values[1], spans=values[2])


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><h2>Site</h2></header><nav><ul><li><a href="/a">Menu one</a></li></ul></nav><!-- ad --><div class="ad">Buy this now and save a lot of money today</div>
%s<h1>Head &amp; title</h1><p><b>First   line.<br><p>Second&nbsp;line &lt;x&gt;</p><form><p>Your mail</p><input></form>
<aside>Other stories that you may like very much indeed</aside><p>Third.</p><div class="comments"><p>A reader says a lot of things here.</p></div>%s
<footer>&copy; site &middot; all rights</footer></body></html>"""
TEXT = "Head & title\n\nFirst line.\n\nSecond line <x>\n\nThird."


def test_main_text_of_pages():
    assert html_text.extract(PAGE % ("<article>", "</article>")) == TEXT
    assert html_text.extract(PAGE % ("<main>", "</main>")) == TEXT
    long = "word " * 40
    plain = f"<body><div class='menu'><p>{long}</p></div><div><p>{long}</p><p>Short.</p><p>{long}</p></div><div class='cookie-notice'>{long}</div></body>"
    assert html_text.extract(plain) == "\n\n".join([long.strip(), "Short.", long.strip()])


LONG = ("Many words stand in this paragraph. " * 6).strip()


def test_an_article_that_is_only_a_teaser_does_not_limit_the_page():
    body = f"<div id='story'><p>{LONG}</p><p>Short.</p><p>{LONG}</p></div>"
    for teaser in ("<article><h3>Other story</h3><p>Ten more.</p></article>", "<article><p>Other story</p></article>" * 3):
        for page in (body + teaser, teaser + body):
            assert html_text.extract(f"<html><body>{page}</body></html>") == "\n\n".join([LONG, "Short.", LONG])


def test_thresholds_decide_on_marked_pages():
    article = f"<article><h1>Head</h1><p>{LONG}</p></article>"
    card = "<article><p>Other story</p></article>"
    assert html_text.extract(f"<body>{card}{article}{card}<div><p>By the way</p></div></body>") == f"Head\n\n{LONG}"
    assert html_text.extract("<body><article><p>Tiny.</p></article><footer>All rights are reserved by us</footer></body>") == "Tiny."


@pytest.mark.parametrize("names", ["content has-sidebar", "page-with-menu", "no-sidebar", "menu", "sidebar widget"])
@pytest.mark.parametrize("tag", ["article", "div"])
def test_wrappers_of_the_main_text_are_kept(names, tag):
    page = f"<body><div class='menu'>Home</div><div class='{names}'><{tag}><p>{LONG}</p><p>{LONG}</p></{tag}></div><div class='ad'>Buy now</div></body>"
    assert html_text.extract(page) == f"{LONG}\n\n{LONG}"


def test_whole_names_are_dropped():
    for names in ("ad", "ad-banner", "cookie-notice", "site-header", "comment-list", "nav_menu x", "x main-menu", "search-form"):
        assert html_text.extract(f"<body><div class='{names}'>{LONG}</div><div><p>{LONG} {LONG} End.</p></div></body>") == f"{LONG} {LONG} End.", names
    comments = f"<div class='comments'><article>{LONG}</article><article>{LONG}</article></div>"
    assert html_text.extract(f"<body><main><p>{LONG}</p>{comments}</main></body>") == LONG


def test_captions_are_kept():
    page = f"<article><p>{LONG}</p><figure><img src='a'><figcaption>A bridge.</figcaption></figure><p><label>Note</label> well.</p></article>"
    assert html_text.extract(page) == f"{LONG}\n\nA bridge.\n\nNote well."


def test_short_blocks_between_kept_blocks_are_kept():
    for short in ("<p>Short.</p>", "<div>Short.</div>"):
        page = f"<body><div><p>{LONG}</p><div class='ad'>Buy</div>{short}<aside>More</aside><p>{LONG}</p></div><aside>x</aside><p>Imprint</p></body>"
        assert html_text.extract(page) == f"{LONG}\n\nShort.\n\n{LONG}"


@pytest.mark.parametrize("page", [None, "", "   ", "<p", "<script>x", "<nav>a</nav>", "<!-- x", "<article></article>"])
def test_pages_without_text(page):
    assert html_text.extract(page) == ""


def test_main_text_keeps_rows(spark):
    rows = [(1, PAGE % ("<article>", "</article>"), "t"), (1, None, "t"), (None, "just text &amp; more", "t"), (2, "<article><p>" + "long " * 50_000 + "</article>", "t")]
    pages = spark.createDataFrame(rows, "page_id long, html string, text string")
    got = html_text.main_text(pages)
    assert got.columns == [*pages.columns, "_text"]
    assert sorted(len(r["_text"]) for r in got.collect()) == sorted([len(TEXT), 0, len("just text & more"), 5 * 50_000 - 1])
    assert html_text.main_text(pages.limit(0)).count() == 0


def corpus(spark, n=1500):
    rng = random.Random(9)
    words = ["".join(rng.choice(["ba", "no", "ti", "ra", "el", "os"]) for _ in range(rng.randint(1, 4))) for _ in range(300)]
    bad = ["zukvex", "zukvexa", "grolmit"]
    rows, labels = [], []
    for i in range(n):
        toxic, good = rng.random() < 0.3, rng.random() < 0.7
        text = [rng.choice(words) for _ in range(rng.randint(20, 80))]
        if toxic:
            for _ in range(4):
                text.insert(rng.randint(0, len(text)), rng.choice(bad))
        rows.append((i, " ".join(text) + "." if good else "!! ".join(t.upper() for t in text), "score"))
        labels.append((i, int(good), int(toxic)))
    rows += [(None, None, "s"), (n, "", "s"), (n + 1, " 12 ... ", "s"), (0, rows[0][1], "s"), (n + 2, "ba " * 30_000, "s")]
    labels += [(None, 1, 1), (3, None, None), (n, 7, 9)]
    return spark.createDataFrame(rows, "doc_id long, text string, clash string").repartition(3), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def accuracy(spark, scored, labels, label, of, rest, column):
    own = scored.filter(toxicity.held_out(scored["doc_id"], of, rest)).join(labels.filter(f"{label} in (0, 1)"), "doc_id").select(label, column).collect()
    assert len(own) > 200
    return sum(r[0] == r[1] for r in own) / len(own)


def test_toxicity(spark):
    docs, labels = corpus(spark)
    scored = toxicity.score(docs, labels).cache()
    assert scored.count() == docs.count() and scored.filter("_score is null or _score < 0 or _score > 1").count() == 0
    assert accuracy(spark, scored, labels, "toxic", 4, 2, "_toxic") > 0.97
    empty = {r["_score"] for r in scored.filter("trim(coalesce(text, '')) = '' or text = ' 12 ... '").collect()}
    assert len(empty) == 1


def test_toxicity_counts_all_labelled_rows(spark):
    docs, labels = corpus(spark, 400)
    learned = []
    for most in (40, 1_000_000):
        folder, _ = toxicity.fit(docs.select("doc_id", "text"), labels, most)
        learned.append({tuple(r) for r in spark.read.parquet(folder).select("order", "key").collect()})
    assert learned[0] == learned[1] and len(learned[0]) > 500


def test_shared_counts_grow_past_the_alphabet(spark):
    letters = "abcdefgh"
    texts = [(x + y + "zukve", -1) for x in letters for y in letters]
    counts = toxicity.gram_counts(spark.createDataFrame(texts, "text string, cls int"))
    assert counts.filter("kind = -1 and gram like '%zuk'").count() == 64


def test_a_repeated_word_counts_as_often_as_it_stands():
    ratios = toxicity.Ratios.__new__(toxicity.Ratios)
    plain = [a + b + c for a in "bcdfg" for b in "aeiou" for c in "klmnp"] * 8
    ratios.update({"zukvex": 8.0} | dict.fromkeys(plain, -0.5))
    once, often = ratios.features([" ".join([*plain, *["zukvex"] * n]) for n in (1, 300)])
    assert once[0] == pytest.approx((8 - 0.5 * 1000) / 1001) and often[0] == pytest.approx((300 * 8 - 0.5 * 1000) / 1300)
    assert once[1:].tolist() == often[1:].tolist()


def test_toxicity_without_labels_or_documents(spark):
    docs, labels = corpus(spark, 30)
    assert toxicity.score(docs, labels.limit(0)).filter("_score is null").count() == 0
    assert toxicity.score(docs.limit(0), labels).count() == 0


def test_quality(spark):
    docs, labels = corpus(spark)
    scored = quality.score(docs, labels).cache()
    assert scored.count() == docs.count() and scored.filter("_score is null or _score < 0 or _score > 1").count() == 0
    assert accuracy(spark, scored, labels, "quality", 5, 0, "_good") > 0.97


def test_quality_without_labels_or_documents(spark):
    docs, labels = corpus(spark, 30)
    assert {r["_score"] for r in quality.score(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.score(docs.limit(0), labels).count() == 0
