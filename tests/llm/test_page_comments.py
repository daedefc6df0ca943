"""Comments end where the parser says, and only there does a page."""
import pytest

from barlake.llm import pages
from tests.llm.test_page_names import ARTICLE, TEXT


@pytest.mark.parametrize("before", [
    "<p title='a <!-- b'>x</p>", "<title>How <!-- begins a comment</title>", "<textarea><!-- a note</textarea>",
    "<TITLE>a <!-- b</TITLE>", "<style><!-- p{margin:0}</style>", "<script><!-- var a=1;</script>", "<!-- a --!>",
    "<!-->", "<!--->", "<!-- a -- b -->", "<!--[if !IE]><!-->"])
def test_text_after_what_only_looks_open_stays(before):
    assert pages.main_text(f"<body>{before}<div>{ARTICLE}</div></body>") == TEXT


def test_an_open_comment_runs_to_the_end():
    for tail in ("<!-- open <p>more</p>", "<!-- open <script>x</script> <p>more</p>", "<!--", "<!-- <!-- a -- ><!-- b"):
        assert pages.main_text(f"<body>{ARTICLE}{tail}") == TEXT
    assert pages.main_text("<!-- <article><p>a</p></article>") == ""
    assert pages.main_text(f"<body>{ARTICLE}<script><!-- x <p>more</p>") == TEXT
