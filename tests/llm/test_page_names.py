"""Names of elements around an article."""
import pytest

from barlake.llm import pages

ARTICLE = "<article><h1>A heading</h1><p>The first words of a text.</p><p>And the last of them.</p></article>"
TEXT = "A heading\nThe first words of a text.\nAnd the last of them."


@pytest.mark.parametrize("around", [
    "class='layout has-sidebar'", "class='page with-sidebar'", "class='elementor-widget elementor-widget-theme-post'",
    "class='site no-sidebar'", "id=search", "class='related'", "class='post-share social'", "role=search", "id=notice"])
@pytest.mark.parametrize("tag", ["article", "main"])
def test_an_article_inside_a_named_element_stays(around, tag):
    inner = ARTICLE.replace("article>", tag + ">")
    for page in (f"<body><div {around}>{inner}</div><p>Imprint and other words</p></body>",
                 f"<body><div {around}><div><p>x</p>{inner}</div></div></body>"):
        assert pages.main_text(page) == TEXT


@pytest.mark.parametrize("around", ["class='layout has-sidebar'", "class='elementor-widget-container'"])
def test_modifiers_hide_no_text_without_an_article(around):
    body = "".join(f"<p>Paragraph {i} has a good number of words in a row.</p>" for i in range(4))
    assert pages.main_text(f"<body><div {around}>{body}</div></body>").count("\n") == 3


def test_tags_attributes_and_comments_still_hide():
    for page in (f"<body><aside>{ARTICLE}</aside></body>", f"<body><div hidden class=widget>{ARTICLE}</div></body>",
                 f"<body><footer><div class=widget>{ARTICLE}</div></footer></body>"):
        assert pages.main_text(page) == ""
    comments = "<section class='comments'><article><p>I disagree with it all.</p></article></section>"
    marked = "<div id='comments'><article class='comment byuser'><p>Nor do I agree.</p></article></div>"
    for page in (ARTICLE.replace("</article>", comments + "</article>"), ARTICLE + marked,
                 f"<main>{ARTICLE}{marked}</main>", ARTICLE.replace("</article>", "<div class=widget><p>w w</p></div></article>")):
        assert pages.main_text(f"<body><div class=widget>{page}</div></body>") == TEXT
