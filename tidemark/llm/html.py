"""Main text of web pages by text-to-tag ratios.

The standard library's parser streams its events into lines: one line for each block
element, with the visible characters outside links and the tags seen in it. The ratio of both is
smoothed over neighbouring lines with a Gaussian, and a threshold at a share of the deviation
splits the lines into content and the rest. The regions (the article, or else containers) with a
content line are selected, and each of their lines gets its own verdict: content lines stay, as do
lines between them that have text of their own and the headings above them; what lies before the
first and behind the last, and lines of links below the threshold, go. An article that the page marks
as such begins and ends with its mark. Elements that by name, role or class are no article text (menus,
headers, adverts, comments, forms made of inputs ...) have ratio 0 and are never part of a region.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Element names of the HTML standard by their part on a page.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th "
    "thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
OUTSIDE = frozenset(
    "head title script style noscript template nav header footer aside menu dialog button select textarea "
    "iframe object embed applet canvas svg math audio video map datalist".split())
#: Elements that hold inputs, and the inputs.
FORMS = frozenset("form fieldset".split())
INPUTS = frozenset("input select textarea button".split())
LABELS = INPUTS | {"label", "option", "legend"}
#: Characters of text outside labels that a form needs for each of its inputs to be part of a page's text.
FORM_TEXT = 100
REGIONS = frozenset("article main".split())
CONTAINERS = frozenset("body section div td".split())
#: Roles and words in classes and ids of parts that are no article text.
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search status toolbar".split())
HINTS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion promoted cookie cookies consent gdpr "
    "notice notices alert popup modal overlay nav navbar navigation menu breadcrumb breadcrumbs sidebar aside widget header masthead "
    "footer subscribe subscription newsletter signup login share sharing social comment comments reply replies respond discussion "
    "disqus related recommended recommendations pagination pager skip".split())
#: Words that may stand beside one of ``HINTS`` in a name without changing what it names.
PLAIN = frozenset(
    "area bar block body bottom box button buttons class col column container content count feed fixed form group head holder icon icons id "
    "inline inner item items js label left line link links list main media menu message mobile module more outer page panel post posts "
    "primary right row secondary section sec site slot small social sticky stories tab text thread title tool tools top unit wrap wrapper".split())
#: The words of these don't count: generated ids of headings name their subject.
TEXT = frozenset("h1 h2 h3 h4 h5 h6 hgroup p".split())
HEADINGS = TEXT - {"p"}
#: Share of the highest level around that a line of links alone must reach.
LINKED = 0.75
WORDS = re.compile(r"[a-z]+")
SPLIT = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")


@dataclass
class Form:
    """An open or closed form: its inputs, and the text in it that is no input's."""

    inputs: int = 0
    chars: int = 0

    def outside(self) -> bool:
        return self.chars < FORM_TEXT * max(1, self.inputs)


@dataclass
class Line:
    left_out: bool
    region: int
    forms: tuple[Form, ...] = ()
    heading: bool = False
    tags: int = 0
    linked: int = 0  # characters in links
    text: list[str] = field(default_factory=list)

    @property
    def outside(self) -> bool:
        return self.left_out or any(form.outside() for form in self.forms)


def names_outside(value: str) -> bool:
    """Whether a class or id holds a name made of a word of ``HINTS`` and words that say nothing."""
    for name in value.split():
        words = WORDS.findall(SPLIT.sub(" ", name).lower())
        if not HINTS.isdisjoint(words) and all(w in HINTS or w in PLAIN for w in words):
            return True
    return False


def is_outside(tag: str, attributes: list[tuple[str, str | None]], nested: bool) -> bool:
    """``nested``: inside an article, where a further article may be a comment."""
    if tag in OUTSIDE:
        return True
    if tag in REGIONS and not nested or tag in ("body", "html"):
        return False
    for name, value in attributes:
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "style" and value and "display:none" in value.replace(" ", "").lower():
            return True
        if name == "role" and (value or "").lower() in ROLES:
            return True
        if name in ("class", "id") and value and tag not in TEXT and names_outside(value):
            return True
    return False


class LineReader(HTMLParser):
    """Turns parser events into lines."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        #: open elements: name, outside, number of the region
        self.stack: list[tuple[str, bool, int]] = [("", False, 0)]
        #: of each open element, whether it is left out; of headers, whether their attributes say so
        self.hinted: list[bool] = [False]
        self.regions = 0
        self.articles: set[int] = set()
        self.links = 0  # open ones
        self.forms: list[tuple[int, Form]] = []  # open ones, with the number of elements around them
        self.fresh()

    def fresh(self) -> None:
        name, outside, region = self.stack[-1]
        self.lines.append(Line(outside, region, tuple(form for _, form in self.forms), name in HEADINGS))

    def own_header(self) -> bool:
        """In a header of the outermost article or main that is in nothing else outside."""
        names = [name for name, *_ in self.stack]
        first = next((i for i, name in enumerate(names) if name in REGIONS), len(names))
        header = next((i for i in range(first, len(names)) if names[i] == "header"), len(names))
        if header == len(names) or self.stack[header - 1][1] or self.hinted[header]:
            return False
        return not any(self.hinted[header + 1:len(names)])

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in INPUTS and ("type", "hidden") not in attrs:
            for _, form in self.forms:
                form.inputs += 1
        if tag in VOID:
            if tag in BLOCKS:
                self.fresh()
            elif tag in ("br", "wbr"):
                self.lines[-1].text.append(" " if tag == "br" else "")
            self.lines[-1].tags += 1
            return
        if tag in BLOCKS and self.stack[-1][0] == "p":  # a block ends an open paragraph
            self.stack.pop()
        _, outside, region = self.stack[-1]
        inside_region = any(name in REGIONS for name, *_ in self.stack)
        if tag in REGIONS and not inside_region or tag == "body":  # begins anew, whatever was left open before
            outside = False
        if (tag in REGIONS or tag in CONTAINERS) and not inside_region:
            self.regions += 1
            region = self.regions
            if tag in REGIONS:
                self.articles.add(region)
        begins = is_outside(tag, attrs, inside_region)
        if tag in HEADINGS and self.own_header():  # the headline, whatever else the header holds
            outside = False
        self.hinted[len(self.stack):] = [is_outside("div", attrs, inside_region) if tag == "header" else begins]
        if tag in FORMS:
            self.forms.append((len(self.stack), Form()))
        self.links += tag == "a"
        self.stack.append((tag, outside or begins, region))
        if tag in BLOCKS or begins:
            self.fresh()
        self.lines[-1].tags += 1

    def handle_endtag(self, tag: str) -> None:
        self.lines[-1].tags += 1
        for at in range(len(self.stack) - 1, 0, -1):
            if self.stack[at][0] == tag:
                changed = any(name in BLOCKS or out != self.stack[at - 1][1] for name, out, _ in self.stack[at:])
                del self.stack[at:]
                self.links = sum(name == "a" for name, *_ in self.stack)
                while self.forms and self.forms[-1][0] >= at:
                    self.forms.pop()
                if changed:
                    self.fresh()
                return
            if self.stack[at][0] in REGIONS and tag not in ("body", "html", *REGIONS):
                return  # an end without a start inside the article doesn't close it
        if tag in BLOCKS:
            self.fresh()

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_data(self, data: str) -> None:
        line = self.lines[-1]
        line.text.append(data)
        if self.links or self.forms:
            chars = len("".join(data.split()))
            line.linked += chars if self.links else 0
            if not line.left_out and not any(name in LABELS for name, *_ in self.stack):
                for _, form in self.forms:
                    form.chars += chars


def smoothed(ratios: np.ndarray, sigma: float) -> np.ndarray:
    reach = max(1, int(3 * sigma))
    kernel = np.exp(-np.arange(-reach, reach + 1) ** 2 / (2 * sigma**2))
    return np.convolve(ratios, kernel / kernel.sum(), "same") if len(ratios) > 2 * reach else np.convolve(ratios, kernel / kernel.sum())[reach:reach + len(ratios)]


def main_text(html: str | None, sigma: float = 1.0, share: float = 1.0) -> str:
    """The content blocks of a page in page order, one to a line; '' if there are none."""
    if not html:
        return ""
    reader = LineReader()
    reader.feed(html)
    reader.close()
    lines = [(line, text) for line in reader.lines if (text := " ".join("".join(line.text).split()))]
    if not lines:
        return ""
    outside = np.array([line.outside for line, _ in lines])
    own = np.array([len("".join(text.split())) - line.linked for line, text in lines])  # characters outside links
    ratios = np.array([0.0 if out else chars / max(1, line.tags) for (line, _), chars, out in zip(lines, own, outside)])
    region = np.array([line.region for line, _ in lines])
    marked = np.isin(region, list(reader.articles))
    if (ratios * marked).any():  # a page that marks its article has no other content
        ratios = ratios * marked
    if not ratios.any():
        return ""
    level = smoothed(ratios, sigma)
    content = (level >= min(share * level.std(), level[ratios > 0].max())) & ~outside
    # a line of links owes its level to its neighbours: it must come close to theirs, as between two paragraphs
    padded = np.pad(level, 2)
    around = np.max([padded[k:k + len(level)] for k in range(5)], axis=0)
    content &= (own > 0) | (level >= LINKED * around)
    kept = np.zeros(len(lines), bool)
    for number in np.unique(region[content & (ratios > 0)]).tolist():
        here = np.flatnonzero((region == number) & ~outside)
        if number in reader.articles:
            kept[here] = content[here] | (own[here] > 0)
            continue
        firm = here[content[here] & (own[here] > 0)]
        between = here[(here >= firm[0]) & (here <= firm[-1])]
        kept[between] = content[between] | (own[between] > 0)
        for at in here[here < firm[0]][::-1]:  # headings right above
            if not lines[at][0].heading:
                break
            kept[at] = True
    return "\n".join(text for (_, text), keep in zip(lines, kept) if keep)


def extract(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url"), column: str = "html", sigma: float = 1.0, share: float = 1.0) -> DataFrame:
    """``keep`` columns and ``text`` of every row, from the whole of ``column``.

    NULL and empty pages, and pages without content, give ''. Rows are independent: repeated pages
    give repeated rows.
    """
    source = pages.select(*keep, column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = pa.array([main_text(h, sigma, share) for h in batch.column(column).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), text], [*keep, "text"])

    kinds = dict(source.dtypes)
    return source.mapInArrow(run, ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "text string"]))
