"""The line-block distribution: brute force, pages without article, names that only look like boilerplate."""

import re
import time

import duckdb

from lodestone.llm import html_text

SF = "/root/testdata/sf0.01"


def brute(page, window=3, least=80, rise=0.15):
    """Surge and dive points by plain loops, on a page whose lines all stand under one element."""
    lines = html_text.lines_of(page)
    weigh = lambda x: x[1] * ((2 if x[2] else 0.25) if any(y[1] and y[2] for y in lines) else 1)
    sums = [sum(weigh(x) for x in lines[k : k + window]) for k in range(len(lines))]
    bound = min(least, rise * max(sums))
    kept, k = [], 0
    while k < len(sums):
        if not sums[k]:
            k += 1
            continue
        dive = next((j for j in range(k, len(sums)) if not sums[j]), len(sums))
        if max(sums[k:dive]) >= bound:  # a surge
            kept += [x[0] for x in lines[k:dive] if weigh(x)]
        k = dive
    return "\n\n".join(kept)


def pages():
    return [h for (h,) in duckdb.sql(f"select html from '{SF}/pages.parquet' order by page_id").fetchall()]


def test_equals_brute_force():
    for page in pages():
        assert html_text.main_text(page) == brute(page)


def test_pages_without_article_come_out_the_same():
    same = 0
    for page in (all_ := pages()):
        bare = re.sub(r"(</?)article", r"\1div", page)
        same += html_text.main_text(bare) == html_text.main_text(page)
    assert same >= 0.98 * len(all_)


def test_the_window_decides():
    text = "<p>" + "word " * 60 + "</p>"
    junk = "<p>Log in</p>"
    link = '<p><a href="/x">Read this other story about things</a></p>'
    page = f"<body><div>{junk}</div><div>{link * 4}{text}{link}{text}{link * 4}</div><div>{junk}</div></body>"
    want = ["word " * 59 + "word", "Read this other story about things", "word " * 59 + "word"]
    assert html_text.main_text(page).split("\n\n") == want  # links around go, one between stays
    assert html_text.main_text(page, window=1).split("\n\n") == want[::2]  # a window of one line parts at each link
    assert len(html_text.main_text(page, window=7).split("\n\n")) > 3


def test_equal_peaks():
    text = "<p>" + "word " * 40 + "</p>"
    parted = f'<body><div>{text}<div class="ad">x</div>{text}</div></body>'
    assert html_text.main_text(parted).count("word") == 80


def test_names():
    body = "<p>" + "word " * 40 + "</p>"
    keep = ('<section id="related-work">', '<section class="legal-basis">', '<div id="search-results">', '<p class="lead">', '<div class="header-image">', '<section aria-label="Related work">', '<p class="notice-period">')
    drop = ('<p class="advert">', '<li class="ad-slot-1">', '<h2 class="related-posts">', '<div id="comments">', '<td class="sponsored">', '<section class="share-bar">', '<div role="navigation">', '<dd class="cookie-notice">', '<section aria-label="Related articles">')
    for tag in keep + drop:
        name = re.match("<([a-z0-9]+)", tag)[1]
        for end in (f"</{name}>", ""):
            if not end and name not in ("p", "li", "dd", "td"):
                continue
            for holder in ("article", "div"):
                opens, closes = {"li": ("<ul>", "</ul>"), "td": ("<table><tr>", "</tr></table>"), "dd": ("<dl>", "</dl>")}.get(name, ("", ""))
                got = html_text.main_text(f"<body><{holder}>{body}{opens}{tag}Some text {end}{closes}{body}</{holder}></body>")
                assert ("Some text" in got) == (tag in keep), (tag, end, holder)
                assert got.count("word") == 80
    many = "<article>" + '<p class="ad">no</p><p>yes</p>' * 20000 + "</article>"
    assert html_text.main_text(many).count("yes") == 20000 and "no" not in html_text.main_text(many)


def test_deep_pages_take_linear_time():
    start = time.perf_counter()
    assert html_text.main_text("<div>" * 40_000 + "<p>" + "word " * 50) == " ".join(["word"] * 50)
    many = html_text.main_text("".join("<div><p>" + "word " * 20 for _ in range(20_000)))
    assert many.count("\n\n") == 19_999
    assert time.perf_counter() - start < 20


def test_an_article_is_never_empty():
    text = " ".join(["The law says so."] * 20)
    for name in ("legal", "header", "comments"):
        assert html_text.main_text(f'<nav>Menu</nav><main><div class="{name}"><p>{text}</p></div></main><footer>x</footer>') == text
    assert html_text.main_text('<body><nav>Menu</nav><div class="ad">Buy this now</div></body>') == ""


def test_comments_under_a_plain_name():
    text = " ".join(["The article says so."] * 20)
    said = " ".join(["I like it."] * 30)
    after = f'<h3>{{}}</h3><div class="reader"><p>{said}</p></div>'
    for heading in ("Comments", "3 comments", "Comments (12)", "Leave a reply", "Reader comments:"):
        assert html_text.main_text(f"<article><p>{text}</p>{after.format(heading)}</article><p>foot</p>") == text
        assert html_text.main_text(f"<div><p>{text}</p></div>{after.format(heading)}") == text
    kept = html_text.main_text(f"<article><p>{text}</p>{after.format('Comments on the law')}</article>")
    assert kept.endswith(said)


def test_holders():
    h = html_text.Holders()
    a = h.add(0)
    b = h.add(a)
    h.shut(b)
    c = h.add(a)
    h.shut(c)
    h.shut(a)
    d = h.add(0)
    assert h.common([b, c]) == a and h.common([b, d]) == 0 and h.common([c]) == c and h.common([]) == 0
    assert h.holds(a, c) and not h.holds(b, c) and not h.holds(a, d) and h.holds(d, h.add(d))
