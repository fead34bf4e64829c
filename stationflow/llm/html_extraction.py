"""Main text of web pages: a tree-structured graphical model over the DOM.

Block elements and the runs of text in them are the nodes of a tree. Each has a label, content or
not; its own features give it a potential and each parent-child edge another. Messages up and down
the tree give every node's marginal, and the runs that are likelier content than not are the text.
Both kinds of potentials are learned from labelled pages."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape
from math import exp, log, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from stationflow.llm.common import in_small_batches, wider

#: Elements that break the text into blocks; all others are inline.
BLOCKS = frozenset(
    "html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre table thead tbody tfoot tr "
    "td th caption figure figcaption header footer nav aside form fieldset legend label button select option address "
    "details summary hr noscript svg dialog center xmp".split()
)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Elements whose content is no text of the page.
HIDDEN = frozenset("script style title textarea template iframe noframes noembed".split())
#: What an opening element closes, if it is open inside the nearest scope.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("html body main article section div ul ol dl table td th blockquote aside nav header footer form".split())

TOKEN = re.compile(r"[a-z]+")


_TAG = re.compile(r"</?([a-zA-Z][^ \t\n\f\r/>]*)")
_ATTRIBUTE = re.compile(
    r"""[ \t\n\f\r/]*([^ \t\n\f\r/>][^ \t\n\f\r/>=]*)"""
    r"""(?:[ \t\n\f\r]*=[ \t\n\f\r]*(?:"([^"]*)(?:"|\Z)|'([^']*)(?:'|\Z)|([^ \t\n\f\r>"'][^ \t\n\f\r>]*)?))?"""
)
_GAP = re.compile(r"[ \t\n\f\r/]*")
_AT_ONCE, _COMMENT_END = re.compile(r"-?>"), re.compile(r"--!?>")
#: Elements whose content is no markup, and what matters in it.
_RAW = {name: re.compile(rf"</{name}(?=[ \t\n\f\r/>])", re.I) for name in ("style", "title", "textarea", "iframe", "noframes", "noembed", "xmp")}
_RAW["script"] = re.compile(r"<!(?=--)|-->|</?script(?=[ \t\n\f\r/>])", re.I)


def raw_end(html: str, name: str, at: int) -> int:
    """Where the end tag of a raw element stands, or the page's end. Only in a script that opens a
    comment and then another script does the next end tag belong to the inner one."""
    comment = inner = False
    for mark in _RAW[name].finditer(html, at):
        found = mark.group().lower()
        if found == "<!":
            comment = True
        elif found == "-->":
            comment = inner = False
        elif found == "<script":
            inner = comment
        elif inner:
            inner = False
        else:
            return mark.start()
    return len(html)


class PageTree:
    """The nodes of one page in page order, parents first: ``parent``, ``features``, ``runs`` (text,
    or None for an element) and ``marks`` (the value of data-main, for labelled pages)."""

    def __init__(self, html: str):
        self.parent, self.features, self.runs, self.marks = [-1], [("tag=root",)], [None], [None]
        self.open, self.tags = [0], ["root"]
        # Where each tag, and any scope, is open: found without a walk through a deep page.
        self.places: dict[str, list[int]] = defaultdict(list)
        self.scopes: list[int] = []
        self.hidden, self.linked = "", 0
        self.text, self.link_chars = [], 0
        self.read(html)
        self.flush()

    def read(self, html: str) -> None:
        """Tell text from markup as browsers do. A comment or tag that the page's end cuts off is
        dropped, if it stands in ordinary content: in a script, style, title, textarea or quoted
        attribute nothing opens a comment or tag."""
        at, end = 0, len(html)
        while at < end:
            start = html.find("<", at)
            start = end if start < 0 else start
            if start > at:
                self.handle_data(unescape(html[at:start]))
            at, kind = start, html[start + 1 : start + 2]
            tag = _TAG.match(html, at)
            if tag:
                at = self.read_tag(html, tag)
            elif html.startswith("<!--", at):
                close = _AT_ONCE.match(html, at + 4) or _COMMENT_END.search(html, at + 4)
                at = close.end() if close else end
            elif kind and kind in "/!?":
                at = html.find(">", at) + 1 or end
            elif at < end:
                self.handle_data("<")
                at += 1

    def read_tag(self, html: str, tag: re.Match) -> int:
        """Handle one tag and return where what follows it starts."""
        name, at, attrs = tag.group(1).lower(), tag.end(), []
        while found := _ATTRIBUTE.match(html, at):
            value = next((v for v in found.groups()[1:] if v is not None), None)
            attrs.append((found.group(1).lower(), value and unescape(value)))
            at = found.end()
        gap = _GAP.match(html, at)
        at = gap.end()
        if at == len(html):
            return at
        if html[tag.start() + 1] == "/":
            self.handle_endtag(name)
        elif gap.group().endswith("/") and self.places["svg"]:
            self.handle_startendtag(name, attrs)
        else:
            shown = not self.hidden
            self.handle_starttag(name, attrs)
            if name in _RAW:
                end = raw_end(html, name, at + 1)
                if name == "xmp" and shown:
                    self.handle_data(html[at + 1 : end])
                return end
        return at + 1

    def flush(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            shown, parent = len(text), self.tags[-1]
            links = min(1.0, self.link_chars / shown)
            features = [f"run in={parent}", f"size={min(7, shown.bit_length() // 2 * 2 if shown > 3 else 1)}"]
            features.append("links=" + ("none" if not links else "some" if links < 0.5 else "most"))
            features.append("ends=" + ("stop" if text[-1] in ".!?…:;\"'”»" else "open"))
            features.append("signs" if "©" in text else "plain")
            self.add(self.open[-1], tuple(features), text, None)
        self.text, self.link_chars = [], 0

    def add(self, parent: int, features: tuple, text: str | None, mark: str | None) -> int:
        self.parent.append(parent)
        self.features.append(features)
        self.runs.append(text)
        self.marks.append(mark)
        return len(self.parent) - 1

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if self.hidden:
            return
        if tag in HIDDEN:
            self.hidden = tag
            return
        if tag == "br":
            self.text.append(" ")
        elif tag == "a":
            self.linked += 1
        if tag not in BLOCKS:
            return
        self.flush()
        if tag in ("html", "body") and self.places[tag]:
            return
        if self.places["p"]:
            self.shut({"p"})
        if tag in CLOSES:
            self.shut(CLOSES[tag])
        if tag in VOID:
            return
        given = dict(attrs)
        names = set(TOKEN.findall(f"{given.get('class') or ''} {given.get('id') or ''} {given.get('role') or ''}".lower()))
        features = (f"tag={tag}", f"under={self.tags[-1]}", *sorted(f"name={n}" for n in names))
        self.open.append(self.add(self.open[-1], features, None, given.get("data-main")))
        self.places[tag].append(len(self.tags))
        if tag in SCOPES:
            self.scopes.append(len(self.tags))
        self.tags.append(tag)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        """A slash closes an element only within svg; elsewhere browsers ignore it."""
        self.handle_starttag(tag, attrs)
        if tag in BLOCKS and tag not in VOID:
            self.handle_endtag(tag)
        elif tag == "a":
            self.linked -= 1
        elif tag in HIDDEN:
            self.hidden = ""

    def shut(self, tags: set) -> None:
        """Close the innermost open one of ``tags`` that no other scope hides."""
        at = max((self.places[t][-1] for t in tags if self.places[t]), default=0)
        if at and at >= (self.scopes[-1] if self.scopes else 0):
            self.close(at)

    def close(self, at: int) -> None:
        """Close all that is open from a place on."""
        self.flush()
        for tag in self.tags[at:]:
            self.places[tag].pop()
        while self.scopes and self.scopes[-1] >= at:
            self.scopes.pop()
        del self.open[at:], self.tags[at:]

    def handle_endtag(self, tag: str) -> None:
        if self.hidden:
            self.hidden = "" if tag == self.hidden else self.hidden
        elif tag == "a":
            self.linked = max(0, self.linked - 1)
        elif tag in BLOCKS and self.places[tag]:
            self.close(self.places[tag][-1])
            self.linked = 0

    def handle_data(self, data: str) -> None:
        if not self.hidden:
            self.text.append(data)
            if self.linked:
                self.link_chars += len(" ".join(data.split()))


@dataclass(frozen=True)
class TreeModel:
    """``weights``: each feature's log odds of content; ``edges[kind][parent][child]``: log potentials
    of an edge to an element (kind 0) or a run (kind 1)."""

    weights: dict[str, float]
    bias: float
    edges: tuple

    def marginals(self, parent: list[int], features: list[tuple], runs: list) -> list[float]:
        """Chance of content of every node: sum-product, first from the leaves to the root, then back.
        Messages are log odds, as there are two labels."""
        n, weights = len(parent), self.weights
        own = [self.bias + sum(weights.get(f, 0.0) for f in node) for node in features]
        up = [0.0] * n  # what a node tells its parent
        for i in range(n - 1, 0, -1):
            (a, b), (c, d) = self.edges[runs[i] is not None]
            x = own[i]  # with all messages of its children, as they come later in the page
            up[i] = _add(c, d + x) - _add(a, b + x)
            own[parent[i]] += up[i]
        for i in range(1, n):
            (a, b), (c, d) = self.edges[runs[i] is not None]
            x = own[parent[i]] - up[i]  # all that the parent knows from elsewhere
            own[i] += _add(b, d + x) - _add(a, c + x)
        return [1 / (1 + exp(-max(-500.0, min(500.0, x)))) for x in own]


def _add(x: float, y: float) -> float:
    """log(exp x + exp y)"""
    return x + log1p(exp(y - x)) if x > y else y + log1p(exp(x - y))


def fit(labelled: list[str], rounds: int = 1000, rate: float = 0.5, shrink: float = 1e-5) -> TreeModel:
    """From pages whose elements carry data-main="1" or "0" (inherited by what is inside)."""
    seen: Counter[str] = Counter()
    nodes: list[tuple] = []
    labels: list[int] = []
    pairs = np.ones((2, 2, 2))
    for html in labelled:
        page = PageTree(html)
        given = [0] * len(page.parent)
        for i in range(1, len(given)):
            given[i] = int(page.marks[i]) if page.marks[i] is not None else given[page.parent[i]]
            nodes.append(page.features[i])
            labels.append(given[i])
            seen.update(page.features[i])
            pairs[int(page.runs[i] is not None), given[page.parent[i]], given[i]] += 1
    names = {f: k for k, f in enumerate(sorted(f for f, c in seen.items() if c > 2))}
    of = [[names[f] for f in node if f in names] for node in nodes]
    column, row = np.array([k for x in of for k in x]), np.repeat(np.arange(len(of)), [len(x) for x in of])
    truth, weights, bias, scale = np.array(labels, float), np.zeros(len(names)), 0.0, np.full(len(names), 1e-8)
    for _ in range(rounds):
        error = 1 / (1 + np.exp(-(np.bincount(row, weights[column], minlength=len(of)) + bias))) - truth
        slope = np.bincount(column, error[row], minlength=len(names)) / len(of) + shrink * weights
        scale += slope * slope
        weights -= rate * slope / np.sqrt(scale)
        bias -= rate * float(error.mean())
    # The classifier's odds hold the base rate, which the edges hold as well.
    share = truth.mean()
    edges = np.log(pairs / pairs.sum(axis=2, keepdims=True))
    return TreeModel({f: float(weights[k]) for f, k in names.items()}, bias - log(share / (1 - share)), tuple(tuple(tuple(map(float, x)) for x in kind) for kind in edges))


def labelled_pages(count: int = 1200, seed: int = 13) -> list[str]:
    """Labelled pages made by a rule: layouts, names and amounts of content and of what surrounds it
    are drawn at random, the words are made up. Every kind of surrounding that the extraction is
    to leave out occurs under its usual elements and names."""
    rng = random.Random(seed)
    syllables = "an be ca do el fi go hu in ka le mo nu or pe ri so ta ur ve".split()
    word = lambda: "".join(rng.choices(syllables, k=rng.randint(1, 4)))
    phrase = lambda a, b: " ".join(word() for _ in range(rng.randint(a, b)))
    sentence = lambda: phrase(4, 18).capitalize() + rng.choice("...?!")
    prose = lambda a, b: " ".join(sentence() for _ in range(rng.randint(a, b)))
    link = lambda: f'<a href="/{word()}">{phrase(1, 3)}</a>'
    links = lambda a, b: "<ul>" + "".join(f"<li>{link()}</li>" for _ in range(rng.randint(a, b))) + "</ul>"

    def box(tag: str, names: str, inside: str, main: int) -> str:
        name = rng.choice(names.split())
        named = rng.choice([f' class="{name}"', f' id="{name}"', f' class="{name} {word()}"']) if name != "-" else ""
        return f'<{tag}{named} data-main="{main}">{inside}</{tag}>'

    def surroundings() -> list[str]:
        div = lambda names, inside: box(rng.choice(["div", "div", "section"]), names, inside, 0)
        comment = lambda: f'<div class="{rng.choice(["comment", "comment-body", "reply"])}"><p>{prose(1, 3)}</p></div>'
        paragraph = lambda a, b: f"<p>{prose(a, b)}</p>"
        return [
            box("nav", "- menu nav navigation", links(3, 9), 0),
            div("menu nav navbar navigation breadcrumb breadcrumbs", links(3, 9)),
            box("header", "- header masthead site-header", rng.choice([f"<h1>{phrase(1, 3)}</h1>", f"<p>{phrase(2, 6)}</p>"]) + links(2, 5), 0),
            div("header top-bar masthead banner", f"<p>{phrase(2, 6)}</p>"),
            box("footer", "- footer site-footer", rng.choice([f"&copy; {phrase(2, 4)} &middot; {prose(1, 2)}", f"<p>&copy; {phrase(2, 5)}</p>", prose(1, 2) + links(2, 4)]), 0),
            div("footer copyright legal colophon", rng.choice([prose(1, 2), f"<p>&copy; {phrase(2, 6)}</p>"])),
            box("aside", "- sidebar related aside widget", rng.choice([links(3, 6), paragraph(1, 3), f"<h3>{phrase(1, 3)}</h3>" + links(2, 5)]), 0),
            div("sidebar side widget related recommended", rng.choice([links(3, 6), paragraph(1, 3)])),
            div("ad ads advert advertisement sponsored promo", rng.choice([prose(1, 2), paragraph(1, 2), link()])),
            div("cookie cookie-notice notice consent gdpr alert popup modal", rng.choice([prose(1, 2), paragraph(1, 2) + f"<button>{phrase(1, 2)}</button>"])),
            div("newsletter subscribe signup login search", f"<form><label>{phrase(1, 3)}</label><input><button>{phrase(1, 2)}</button></form>"),
            box("form", "- search login contact subscribe", f"<p>{prose(1, 1)}</p><label>{phrase(1, 3)}</label><select><option>{word()}</option><option>{word()}</option></select><button>{word()}</button>", 0),
            box(rng.choice(["section", "div"]), "comments comment-list responses discussion disqus", f"<h2>{phrase(1, 3)}</h2>" + "".join(comment() for _ in range(rng.randint(1, 5))), 0),
            div("share social social-share tags meta pagination pager author-box", rng.choice([links(2, 5), f"<p>{phrase(1, 5)}</p>"])),
            box(rng.choice(["noscript", "dialog"]), "- notice", paragraph(1, 1), 0),
        ]

    def part() -> str:
        kind = rng.random()
        if kind < 0.6:
            return f"<p>{rng.choice(['', '<b>'])}{prose(1, 6)}" + rng.choice(["</p>", "</p>", "<br>"])
        if kind < 0.7:
            return f"<{(h := rng.choice(['h2', 'h3']))}>{phrase(2, 7)}</{h}>"
        if kind < 0.78:
            return "<ul>" + "".join(f"<li>{prose(1, 2)}</li>" for _ in range(rng.randint(2, 5))) + "</ul>"
        if kind < 0.84:
            return f"<blockquote><p>{prose(1, 3)}</p></blockquote>"
        if kind < 0.9:
            return f"<p>{prose(1, 2)} {link()} {prose(1, 2)}</p>"
        if kind < 0.94:
            return f"<p>{phrase(1, 3)}</p>"
        if kind < 0.97:
            return f"<pre>{phrase(3, 20)}</pre><table><tr><td>{phrase(1, 3)}</td><td>{phrase(1, 3)}</td></tr></table>"
        return f"<figure><figcaption>{sentence()}</figcaption></figure><div>{prose(1, 3)}</div>"

    pages = []
    for _ in range(count):
        parts = [f"<h1>{phrase(2, 9)}{rng.choice(['', '.'])}</h1>"] * (rng.random() < 0.9) + [part() for _ in range(rng.randint(1, 14))]
        if rng.random() < 0.6:
            parts.insert(rng.randint(0, len(parts)), rng.choice(surroundings()))
        inside = "".join(parts)
        main = rng.choice(
            [
                lambda: box("article", "- post entry story", inside, 1),
                lambda: box("article", "- post entry story", inside, 1),
                lambda: box("main", "- content main", inside, 1),
                lambda: box("div", "content article main-content post post-body entry-content story article-body text", inside, 1),
                lambda: box("section", "content article post story", inside, 1),
                lambda: '<main data-main="0">' + box("article", "- post", inside, 1) + "</main>",
                lambda: '<div class="wrapper" data-main="0">' + box("div", "content article entry-content post", inside, 1) + "</div>",
                lambda: f'<div data-main="1">{inside}</div>',
            ]
        )()
        around = surroundings()
        before, after = rng.sample(around, rng.randint(0, 4)), rng.sample(around, rng.randint(0, 5))
        body = "".join(before) + main + "".join(after)
        if rng.random() < 0.3:
            body = f'<div class="{rng.choice(["page", "container", "wrapper", "site"])}">{body}</div>'
        pages.append(f"<html><head><title>{phrase(2, 6)}</title></head><body>{body}</body></html>")
    return pages


def main_text(html: str, model: TreeModel) -> str:
    """The runs that are likelier content than not, in page order, joined by an empty line."""
    page = PageTree(html)
    chances = model.marginals(page.parent, page.features, page.runs)
    return "\n\n".join(text for text, chance in zip(page.runs, chances) if text and chance >= 0.5)


def extract(pages: DataFrame, html: str, model: TreeModel, out: str = "text") -> DataFrame:
    """Add ``out``, the main text of the whole html, and ``n_chars``, its code points. A null html is
    empty; a page without content has an empty text. One narrow pass; other columns stay, but for
    those of the same names, which are replaced. Broken markup is read as browsers do: open
    elements are closed where they must be, an unfinished tag or comment at the end is dropped, the
    fallback of an iframe is no text. Work is linear in a page's length, however deep it is nested. A
    chance of exactly a half counts as content. An empty table gives no rows; repeated rows are
    rows of their own."""
    rows = pages.select(*[c for c in pages.columns if c not in (out, "n_chars")])
    place, names = rows.columns.index(html), [*rows.columns, out, "n_chars"]
    shared = pages.sparkSession.sparkContext.broadcast(model)  # some hundred numbers

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            texts = [main_text(x.as_py() or "", known) for x in batch.column(place)]
            arrays = [*batch.columns, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return in_small_batches(rows).mapInArrow(extracted, wider(rows.schema, **{out: "string", "n_chars": "long"}))
