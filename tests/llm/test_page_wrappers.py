"""Forms around the text, names of parts of a page, and pages that are dear to parse."""
import random
import time

import pytest

from barlake.llm import pages

WORDS = "".join(f"<p>Paragraph {i} has a good number of words in a row.</p>" for i in range(4))
TEXT = "\n".join(f"Paragraph {i} has a good number of words in a row." for i in range(4))


@pytest.mark.parametrize("tag", ["article", "main"])
def test_a_form_around_an_article_is_a_wrapper(tag):
    inner = f"<{tag}>{WORDS}<form><label>Your name</label><p>Write to us</p></form></{tag}>"
    for page in (f"<body><form id=aspnetForm>{inner}</form></body>",
                 f"<body><form id=aspnetForm><form><p>Sign in</p></form><div>{inner}</div></form></body>",
                 f"<body><form><p>Search</p></form><form><nav>a b</nav>{inner}<p>Below</p></form></body>"):
        assert pages.main_text(page) == TEXT


def test_a_form_around_most_of_the_text_is_a_wrapper():
    assert pages.main_text(f"<body><form>{WORDS}</form></body>") == TEXT
    assert pages.main_text(f"<body><form><div>{WORDS}</div><nav>a b c</nav></form><p>x</p></body>") == TEXT
    assert "name" not in pages.main_text(f"<body>{WORDS}<form><p>Your name</p><p>Your address</p></form></body>")
    assert pages.main_text(f"<body><aside><form><article>{WORDS}</article></form></aside></body>") == ""


@pytest.mark.parametrize("name", ["class='post category-social tag-search'", "id='ad-hoc-networks'", "class='notice-board'",
                                  "class='share-price'", "id=search-results", "class='menu-of-the-week'"])
def test_names_that_are_about_something_else_hide_nothing(name):
    assert pages.main_text(f"<body><div {name}>{WORDS}</div></body>") == TEXT


@pytest.mark.parametrize("name", ["ad", "ads", "ad-slot", "ad-300x250", "google-ad", "advertisement-x", "cookie-banner",
                                  "site-footer", "main-nav", "left-sidebar", "sidebar-foo", "widget_text", "post-comments",
                                  "newsletter-signup", "top_menu", "breadcrumbs", "social-links", "related-posts"])
def test_names_of_parts_hide(name):
    assert not pages._aside("layout") and pages._aside(name)
    assert pages.main_text(f"<body><article>{WORDS}<div class='x {name}'><p>Buy now</p></div></article></body>") == TEXT


def test_markup_that_the_page_ends_in_is_dropped():
    for end in ("<a href=\"htt", "<p class='x", "</p", "<!doctype", "<?php", "<![if x", "<![what[ x", "<!-- x", "<div a"):
        assert pages.main_text(f"<body><article>{WORDS}{end}") == TEXT
    assert pages.main_text(f"<body><![what[ x]><article>{WORDS}</article>") == TEXT


@pytest.mark.parametrize("page", [
    "<a x=\"" * 40_000, "<p a='b" * 40_000, "</p " * 60_000, "<!x " * 60_000, "<?x " * 60_000, "<div>" * 40_000 + "</b></i></x>" * 40_000,
    "<div>" * 40_000 + "</section>" * 40_000, "<form>" * 30_000 + "<article>" * 30_000, "<p>" * 100_000, "<!-- x" * 50_000])
def test_long_odd_pages_are_linear(page):
    at = time.process_time()
    pages.main_text(page)
    assert time.process_time() - at < 6


def plain(html_lines):
    """Density path for a page of (region, text, tags) lines, straight from the definition."""
    from math import exp, sqrt
    ratio = [len(t) / max(1, k) for _, t, k in html_lines]
    smooth = [0.0] * len(ratio)
    for i, (r, _, _) in enumerate(html_lines):
        same = [j for j, x in enumerate(html_lines) if x[0] == r]
        at = same.index(i)
        w = [(exp(-(k - at) ** 2 / 2), ratio[j]) for k, j in enumerate(same) if abs(k - at) <= 3]
        smooth[i] = sum(a * b for a, b in w) / sum(a for a, _ in w)
    mean = sum(smooth) / len(smooth)
    spread = sqrt(sum((x - mean) ** 2 for x in smooth) / len(smooth))
    peak = {r: max(smooth[i] for i, x in enumerate(html_lines) if x[0] == r) for r, _, _ in html_lines}
    least = min(spread, max(peak.values()) / 2)
    return "\n".join(t for r, t, _ in html_lines if peak[r] >= least)


def test_density_decides_without_an_article():
    rng = random.Random(5)
    dropped = 0
    for _ in range(200):
        lines, html = [], ""
        for r in range(rng.randint(1, 6)):
            html += "<div>"
            for k in range(rng.randint(1, 6)):
                links = rng.choice((0, 0, 0, 8))
                text = " ".join(rng.choice(("a", "word", "longer", "words")) for _ in range(rng.randint(1, 30)))
                html += f"<p>{''.join('<a>.</a>' for _ in range(links))}{text}</p>"
                # the tags met while the line is open; the end tag of the paragraph and of the section before it count
                lines.append((r, "." * links + text, 2 * links + (3 if r and not k else 2)))
            html += "</div>"
        parser = pages.Lines(html)
        parser.feed(html)
        parser.close()
        parser.end_line()
        got = [(t, tags) for t, tags, *_ in parser.resolved()]
        assert [t for t, _ in got] == [t for _, t, _ in lines]
        lines = [(r, t, tags) for (r, t, _), (_, tags) in zip(lines, got)]
        want = plain(lines)
        assert pages.main_text(html) == want
        dropped += want.count("\n") + 1 < len(lines)
    assert dropped > 10
