"""Line blocks decide: surge and dive on pages of every kind."""

import random
import time

import pytest

from roundbook.llm import html_text

LONG = "This is a paragraph of the article with enough words in it to be well over the threshold of eighty-six code points."
P = f"<p>{LONG}</p>"


@pytest.mark.parametrize("line", ["<div><a href='/x'>Link no {}</a></div>", "<div>Line no {}</div>", "<li><a href=/x>Link {}</a></li>"])
def test_runs_of_short_lines_fall_out_whatever_their_names(line):
    run = "".join(line.format(i) for i in range(20))
    assert html_text.extract(f"<html><body>{run}{P * 3}{run}</body></html>") == "\n\n".join([LONG] * 3)
    assert html_text.extract(f"<html><body>{run}{P}</body></html>").endswith(LONG)
    assert html_text.extract(f"<html><body>{run}{P}</body></html>").count("no") <= 1


def test_links_at_the_ends_of_what_stays_fall_out():
    link = "<div><a href='/x'>Home</a> </div>"
    assert html_text.extract(f"<body>{link}{link}{P}{P}{link}</body>") == f"{LONG}\n\n{LONG}"
    assert html_text.extract(f"<body>{link}<h2>Head</h2>{P}<div><a href='/y'>a link between</a></div>{P}</body>") == f"Head\n\n{LONG}\n\na link between\n\n{LONG}"


def test_quotes_in_a_tag_open_a_value_only_after_an_equals_sign():
    page = "<article><p title=it's>" + LONG + "</p><p>" + LONG + "</p><p>It's " + LONG + "</p></article>"
    assert html_text.extract(page) == f"{LONG}\n\n{LONG}\n\nIt's {LONG}"
    assert html_text.extract(f"<article><p \">{LONG}</p><p x=' > ' y = \" > \">{LONG}</p></article>") == f"{LONG}\n\n{LONG}"
    assert html_text.extract(f"<article>{P}<p x=\"open") == LONG


def test_a_longer_article_in_a_related_part_goes():
    related = f"<div class='related'><article><p>{LONG} {LONG} other</p></article></div>"
    for page in (f"<body>{related}<article>{P}</article></body>", f"<body><article>{P}</article>{related}</body>"):
        assert html_text.extract(page) == LONG
    # the only article, though, is the main text, whatever the name around it
    assert html_text.extract(f"<body><div class='related'><article>{P}</article></div><p>x</p></body>") == LONG


def test_very_long_pages_take_time_in_proportion():
    def seconds(n):
        start = time.perf_counter()
        html_text.extract("<div>" * n + "</span>" * n + "<nav></nav><section><p>x</p></section>" * (n // 4))
        return time.perf_counter() - start

    seconds(500)
    assert seconds(32_000) < 25 * max(seconds(4_000), 0.01)


def slow(lines):
    """The rule, line by line: (length, whether a link) of each line of one container."""
    size = [0 if link else n for n, link in lines]
    windows = [range(i, i + 3) for i in range(len(size) - 2)] or [range(len(size))]
    sums = [sum(size[k] for k in w) for w in windows]
    surge = max(1, min(86, max(sums)))
    kept = [all(s >= surge for w, s in zip(windows, sums) if i in w) for i in range(len(size))]
    kept = kept if any(kept) else [any(s >= surge for w, s in zip(windows, sums) if i in w) for i in range(len(size))]
    runs, i = [], 0
    while i < len(size):
        j = i
        while j < len(size) and kept[j]:
            j += 1
        if j > i:
            run = list(range(i, j))
            while run and size[run[0]] == 0:
                run.pop(0)
            while run and size[run[-1]] == 0:
                run.pop()
            runs += run
        i = j + 1
    return list(range(runs[0], runs[-1] + 1)) if runs else []


@pytest.mark.parametrize("seed", range(60))
def test_equals_the_slow_rule(seed):
    rng = random.Random(seed)
    lines = [(rng.choice([5, 9, 20, 30, 60, 100, 200]), rng.random() < 0.3) for _ in range(rng.randint(1, 14))]
    texts = [f"{i:02d}" + "x" * (n - 2) for i, (n, _) in enumerate(lines)]
    page = "".join(f"<p><a href='/'>{t}</a></p>" if link else f"<p>{t}</p>" for t, (_, link) in zip(texts, lines))
    want = [texts[i] for i in slow(lines)]
    assert html_text.extract(f"<html><body>{page}</body></html>") == "\n\n".join(want)
    # an article that is marked keeps all its lines, whatever stands around it
    if any(not link for _, link in lines):
        assert html_text.extract(f"<html><body><p>y</p><article>{page}</article></body></html>") == "\n\n".join(texts)
