"""Main text of web pages by text-to-tag ratio.

The standard library's streaming parser turns a page into lines: a block tag ends a line, inline tags do not, ``br``
is a blank. A line has its text, the number of tags met while it was open, and its region - the innermost of
``article``, ``main`` or another sectioning element around it. The text-to-tag ratio of the lines is smoothed with a
Gaussian in page order within each region, and the regions are clustered by their highest smoothed ratio: a region
whose peak is at least the threshold (the standard deviation of all smoothed ratios, at most half of the best peak;
one character per tag within an ``article`` or ``main``) is content, and every line of it is kept, short ones too. Lines inside scripts, styles, forms, navigation, headers
outside an article, footers, asides, and elements whose class, id or role names an advert, notice, menu, sidebar or
comment section are no candidates and have ratio 0; with an ``article`` or ``main`` on the page only lines inside one
are candidates. Names that say what an element has or lacks (``has-sidebar``) do not count, and an ``article`` or ``main``
inside a named element is not hidden by that name, unless it is a comment or inside another ``article``. A name counts when all
its words do or say only where a thing is (``site-footer``; not ``notice-board`` or ``tag-search``). A form that wraps an
``article``, a ``main`` or, on a page without them, more than half of the text is no form to fill in and hides nothing.

Character references are decoded, white space in a line becomes one blank, lines are joined by a line feed. Unclosed
and stray tags are tolerated; a tag that the page ends in is dropped, as browsers do. Work is linear in the page. A null or
empty page gives the empty text."""
from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIGMA = 1.0

_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt "
                    "ruby s samp small span strike strong sub sup time tt u var wbr".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_HIDDEN = frozenset("head title script style noscript template nav footer aside button select textarea iframe "
                    "object svg dialog menu canvas audio video".split())
_REGION = frozenset("article main section div body td".split())
# words that name what is not the text; these hide by any name that starts with them
_SIDE = re.compile(r"ads?|advert.*|sponsor.*|promo.*|banner|cookies?|consent|notices?|popup|modal|overlay|sidebar|comments?|"
                   r"disqus|replies|navigation|nav|navbar|menu|breadcrumbs?|share|sharing|social|related|recommended|"
                   r"newsletter|subscribe|signup|login|footer|masthead|contentinfo|complementary|search")
_LEADING = re.compile(r"widget|sidebar|advert.*|sponsor.*|breadcrumbs?|navbar|disqus")
# words that say where or how large a thing is and leave its meaning alone
_NEUTRAL = frozenset("""accept area article articles bar big block body bottom box button buttons card col column container
    content cookie desktop entry first fixed form frame global google group head header holder icon icons info inner item
    items large last law left link links list local main media message mini mobile module new outer page panel placeholder
    post posts primary reader region right row second secondary section site slot small space sticky stories text tile top
    unit upper lower user web wide wrap wrapper zone""".split())
_COMMENT_END = re.compile(r"--(?:\s*|!)>")
_PLAIN = ("title", "textarea")  # text up to their end tag, no markup inside
_MODIFIER = re.compile(r"(?:has|have|with|without|no)[-_]")
_COMMENT = re.compile(r"comments?|repl(?:y|ies)|disqus")
# A block that begins closes an open paragraph; these close their unclosed likes as well.
_PARAGRAPH = frozenset({"p"})
_CLOSES = {"li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"},
           "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}}


def _aside(name: str) -> bool:
    """Whether a name says that an element is not the text: it starts with a leading word, or all its words are side
    words and neutral ones (``site-footer``, ``ad-300x250``; not ``notice-board``, ``tag-search``, ``ad-hoc``)."""
    words = [w for w in re.split("[^a-z]+", name) if w]
    if not words or _LEADING.fullmatch(words[0]):
        return bool(words)
    side = [bool(_SIDE.fullmatch(w)) for w in words]
    return any(side) and all(x or len(w) == 1 or w in _NEUTRAL for w, x in zip(words, side, strict=True))


class Lines(HTMLParser):
    """Lines of a page as (text, tags, region, hidden, inside an article or main)."""

    def __init__(self, page: str = ""):
        super().__init__(convert_charrefs=True)
        low = page.lower()
        self.last_end = {tag: low.rfind("</" + tag) for tag in _PLAIN}  # of a page that is fed whole
        self.ended = False
        self.lines: list[tuple[str, int, int, bool, bool, int]] = []  # as above, and the form
        # tag, hidden by a tag or attribute, hidden by a name, region, in article or main, in article, form
        self.open: list[tuple[str, bool, bool, int, bool, bool, int]] = []
        self.depth: Counter[str] = Counter()  # open elements by tag
        self.forms = [(0, True)]  # form around a form, whether it is a wrapper; the first is the page
        self.parts: list[str] = []
        self.tags = self.regions = 0

    def state(self) -> tuple[bool, bool, int, bool, bool, int]:
        return self.open[-1][1:] if self.open else (False, False, 0, False, False, 0)

    def resolved(self) -> list[tuple[str, int, int, bool, bool]]:
        """Lines with those of forms hidden, but for forms that wrap the text: an article, a main or, where no article
        or main shows, more than half of all text that nothing else hides."""
        def lines():
            shown = []
            for parent, wrapper in self.forms:
                shown.append(wrapper and (not shown or shown[parent]))
            return [(t, tags, region, hidden or not shown[form], article)
                    for t, tags, region, hidden, article, form in self.lines]
        out = lines()
        if len(self.forms) > 1 and not any(a and not h for _, _, _, h, a in out):
            size = [0] * len(self.forms)
            for text, _, _, hidden, _, form in self.lines:
                size[form] += 0 if hidden else len(text)
            for k in range(len(size) - 1, 0, -1):
                size[self.forms[k][0]] += size[k]
            self.forms = [(parent, wrapper or 2 * n > size[0]) for (parent, wrapper), n in zip(self.forms, size, strict=True)]
            out = lines()
        return out

    def end_line(self):
        text = " ".join("".join(self.parts).split())
        if text:
            hidden, named, region, article, _, form = self.state()
            self.lines.append((text, self.tags, region, hidden or named, article, form))
        self.parts, self.tags = [], 0

    def close(self):
        self.ended = True
        super().close()

    def parse_comment(self, i, report=1):
        """End of the comment at ``i``; one that is still open when the page ends runs to the end."""
        end = _COMMENT_END.search(self.rawdata, i + 2)
        return end.end() if end else len(self.rawdata) if self.ended else -1

    def rest(self, end: int) -> int:
        """``end``, or the end of the page for markup that the page ends in: nothing of it is text or read again."""
        return len(self.rawdata) if end < 0 and self.ended else end

    def parse_starttag(self, i):
        end = super().parse_starttag(i)
        tag = self.lasttag
        if end > 0 and not self.cdata_elem and self.rawdata[end - 2] != "/" and end <= self.last_end.get(tag, -1):
            self.set_cdata_mode(tag)
        return self.rest(end)

    def parse_endtag(self, i):
        return self.rest(super().parse_endtag(i))

    def parse_pi(self, i):
        return self.rest(super().parse_pi(i))

    def parse_html_declaration(self, i):
        try:
            return self.rest(super().parse_html_declaration(i))
        except AssertionError:  # a marked section of no known kind is a comment up to the next bracket
            end = self.rawdata.find(">", i)
            return self.rest(end + 1 if end >= 0 else -1)

    def push(self, *element):
        self.open.append(element)
        self.depth[element[0]] += 1

    def pop(self) -> str:
        tag = self.open.pop()[0]
        self.depth[tag] -= 1
        return tag

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.parts.append(" ")
        if tag not in _INLINE:
            self.end_line()
            while self.open and self.open[-1][0] in _CLOSES.get(tag, _PARAGRAPH):
                self.pop()
        self.tags += 1
        if tag in _VOID:
            return
        names = [] if tag in _INLINE else [n for k, v in attrs if v and k in ("class", "id", "role")
                                           for n in v.lower().split() if not _MODIFIER.match(n)]
        hidden, named, region, article, inner, form = self.state()
        if tag in ("article", "main"):
            named = named and (inner or any(map(_COMMENT.search, names)))
        elif tag not in ("html", "body"):
            named = named or any(map(_aside, names))
        article, inner = article or tag in ("article", "main"), inner or tag == "article"
        hidden = (hidden or tag in _HIDDEN or tag == "header" and not article
                  or any(k == "hidden" or k == "aria-hidden" and v == "true" for k, v in attrs))
        if tag in _REGION:
            self.regions += 1
            region = self.regions
        if tag == "form":
            self.forms.append((form, False))
            form = len(self.forms) - 1
        elif tag in ("article", "main") and not (hidden or named):
            at = form
            while not self.forms[at][1]:
                self.forms[at] = (self.forms[at][0], True)
                at = self.forms[at][0]
        if tag not in _INLINE:
            self.push(tag, hidden, named, region, article, inner, form)

    def handle_startendtag(self, tag, attrs):
        if tag not in _INLINE:
            self.end_line()
        if tag == "br":
            self.parts.append(" ")
        self.tags += 1

    def handle_endtag(self, tag):
        self.tags += 1
        if tag in _INLINE or tag in _VOID:
            return
        self.end_line()
        if self.depth[tag]:
            while self.pop() != tag:
                pass

    def handle_data(self, data):
        self.parts.append(data)


def smoothed(values: list[float], sigma: float = SIGMA) -> list[float]:
    """Gaussian mean over neighbours within three sigma."""
    reach = math.ceil(3 * sigma)
    weight = [math.exp(-(k / sigma) ** 2 / 2) for k in range(reach + 1)]
    out = []
    for i in range(len(values)):
        lo, hi = max(0, i - reach), min(len(values), i + reach + 1)
        out.append(sum(values[j] * weight[abs(i - j)] for j in range(lo, hi))
                   / sum(weight[abs(i - j)] for j in range(lo, hi)))
    return out


def main_text(html: str, sigma: float = SIGMA) -> str:
    parser = Lines(html)
    parser.feed(html)
    parser.close()
    parser.end_line()
    found = parser.resolved()
    only = any(a and not h for _, _, _, h, a in found)
    lines = [(t, 0.0 if h or only and not a else len(t) / max(1, tags), r) for t, tags, r, h, a in found]
    by_region: dict[int, list[int]] = {}
    for i, (_, ratio, region) in enumerate(lines):
        if ratio:
            by_region.setdefault(region, []).append(i)
    if not by_region:
        return ""
    ratios = [0.0] * len(lines)
    for at in by_region.values():
        for i, v in zip(at, smoothed([lines[i][1] for i in at], sigma), strict=True):
            ratios[i] = v
    mean = sum(ratios) / len(ratios)
    spread = math.sqrt(sum((r - mean) ** 2 for r in ratios) / len(ratios))
    peaks = {region: max(ratios[i] for i in at) for region, at in by_region.items()}
    # inside an article the threshold only drops regions that hold next to no text
    threshold = 1.0 if only else min(spread, max(peaks.values()) / 2)
    chosen = {region for region, peak in peaks.items() if peak >= min(threshold, max(peaks.values()))}
    return "\n".join(t for t, ratio, region in lines if ratio and region in chosen)


def _extract(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for pages in batches:
        yield pa.array([main_text(p) if p else "" for p in pages.to_pylist()], pa.string())


def extract(df: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """``df`` with the main text of its page."""
    return df.withColumn(out, F.arrow_udf(_extract, "string")(F.col(html)))
