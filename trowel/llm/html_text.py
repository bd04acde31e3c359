"""Main text of web pages: flat text blocks, judged by a small decision tree."""

from __future__ import annotations

import functools
import html
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trowel.llm.common import read
from trowel.llm.labelled_blocks import PAGES

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"                                             # comments
    r"|<(?P<end>/?)(?P<tag>[A-Za-z][A-Za-z0-9:-]*+)(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^'\">])*+)(?:>|\Z)"
    r"|<(?P<end2>/?)(?P<tag2>[A-Za-z][A-Za-z0-9:-]*+)(?P<rest2>[^>]*+)(?:>|\Z)"  # an open quote
    r"|<[!?][^>]*+(?:>|\Z)", re.S)
# One attribute at a time, so that nothing inside a value counts as a name.
_NAMED = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)(?:\"|\Z)|'([^']*)(?:'|\Z)|([^\s\"'>]+)))?")
_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*([a-z-]+)", re.I)
# Elements by what they do to the text around them.
_RAW = {"script", "style", "noscript", "template", "title", "textarea", "iframe", "svg", "head",
        "object", "select", "audio", "video", "canvas", "math"}
# Without an end tag these go on to the end of the page, as in a browser; the others of _RAW end with
# the element around them or at the start of one of _BLOCK.
_TO_THE_END = {"script", "style", "title", "textarea", "iframe"}
_BLOCK = {"article", "main", "section", "nav", "aside", "header", "footer", "div", "p", "h1", "h2", "h3", "h4",
          "h5", "h6", "ul", "ol", "dl", "table", "blockquote", "pre", "figure", "form", "body"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source",
         "track", "wbr"}
_INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn",
           "em", "font", "i", "img", "ins", "kbd", "mark", "q", "s", "samp", "small", "span",
           "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
_APART = {"nav", "footer", "aside", "menu", "dialog", "button", "fieldset", "label", "legend"}
# A form around one of these is the page's own wrapper, as some servers write it.
_STRUCTURE = {"article", "main", "h1", "nav", "header", "footer", "aside"}
# Words in names of elements beside the text.
_HINT = re.compile(
    r"ads?|adslots?|adbox|adunit|adsense|adsby\w+|advert\w*|banner|promo\w*|sponsor\w*|comments?|replies|respond|disqus|"
    r"sidebar|widget|menu|nav|navbar|navigation|breadcrumbs?|footer|masthead|topbar|toolbar|"
    r"cookies?|consent|gdpr|notice|alert|popup|modal|overlay|newsletter|subscribe|signup|login|"
    r"share|sharing|social|related|recommended|pagination|pager|search|skip|complementary|"
    r"contentinfo|header")
# Words that may stand beside those in a name without saying what it is about.
_NEUTRAL = set(
    "site page main top bottom left right upper lower center inner outer first last primary secondary global "
    "box bar block section list links link item items wrapper wrap container content contents body area panel "
    "group row col column region zone slot unit text title heading label button buttons btn icons icon bars form input "
    "field media tools this us js css mobile desktop small large big full wide sticky fixed float toggle count meta "
    "author avatar thread nested reply google layout module component widget cell bg posts articles stories reading "
    "more action actions card cards grid holder policy message tag display".split())
_OF_TEXT = {"post", "entry", "article", "story"}  # their headers are the text's own
# Names that say what an element has or lacks, not what it is.
_STATE = re.compile(r"(?:has|no|not|with|without|show|hide)[-_].*|.*[-_](?:open|closed|enabled|disabled|off|on)", re.I)
# Elements that hold one of several items; what counts is where their list stands.
_ITEM = {"p", "li", "ul", "ol", "dl", "dt", "dd", "h1", "h2", "h3", "h4", "h5", "h6", "option", "tr", "td", "th", "table",
         "tbody", "thead", "blockquote", "pre"}
_WRAPPED = 2 / 3  # a form with so much of the page's words is around the page, too
_TEXT_WORDS = 10  # outside articles a block of so many words, not beside the text, counts as text

FEATURES = ("words", "link_density", "words_before", "links_before", "words_after", "links_after",
            "in_article", "apart", "hinted", "heading", "elsewhere", "in_prose")


def hides(rest: str) -> bool:
    """Whether an element with these attributes is hidden: by the attribute ``hidden``, or by a style
    whose last display is none. Classes, links, titles and other values do not hide; text that is
    hidden until found is text of the page."""
    seen: set[str] = set()
    for m in _NAMED.finditer(rest):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name in seen:
            continue  # the first of a name counts
        seen.add(name)
        if name == "hidden" and value.strip().lower() != "until-found":
            return True
        if name == "style" and (shown := _DISPLAY.findall(value)) and shown[-1].lower() == "none":
            return True
    return False


def after(page: str, tag: str, at: int) -> int | None:
    """Where the next end tag ``tag`` ends."""
    end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
    return end.end() if end else None


def own_ends(page: str) -> dict[int, int]:
    """For the elements of _RAW that nest and have an end tag of their own: where it ends, by the
    end of the start tag."""
    out: dict[int, int] = {}
    began: dict[str, list[int]] = {tag: [] for tag in _RAW - _TO_THE_END - {"head"}}
    at = 0
    while m := _TOKEN.search(page, at):
        at = m.end()
        tag = (m["tag"] or m["tag2"] or "").lower()
        if m["end"] or m["end2"]:
            if began.get(tag):
                out[began[tag].pop()] = at
        elif (m["rest"] or m["rest2"] or "").endswith("/"):
            continue
        elif tag in _TO_THE_END:
            at = after(page, tag, at) or len(page)
        elif tag in began:
            began[tag].append(at)
    return out


@functools.cache
def _told(name: str, inside: bool) -> str | None:
    """What one name says of its element: ``hint`` if all its words, but neutral ones, are of
    something beside the text; ``state`` if it says that such a thing is there or not."""
    words = re.split(r"[-_\s]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", name).lower().strip("-_"))
    words = [w for w in words if not w.isdigit()]
    hints = [w for w in words if _HINT.fullmatch(w)]
    if "header" in hints and (inside or _OF_TEXT & set(words)):
        hints = [w for w in hints if w != "header"]
    if not hints:
        return None
    if _STATE.fullmatch(name):
        return "state"
    return "hint" if all(w in hints or w in _NEUTRAL for w in words) else None


def named(rest: str, heading: bool) -> list[str]:
    """The names of an element: classes, id, role and label. The id of a heading is a mark for
    links to it, made of its words, and says nothing."""
    out = []
    for m in _NAMED.finditer(rest):
        value = m[2] or m[3] or m[4] or ""
        match m[1].lower():
            case "class" | "role":
                out += value.split()
            case "id" if not heading:
                out.append(value.strip())
            case "aria-label":
                out.append(value.strip())
    return out


class Block:
    __slots__ = ("text", "words", "density", "in_article", "apart", "hinted", "heading", "place")


def blocks(page: str | None) -> list[Block]:
    """The text blocks of a page in order; never fails on broken markup.

    Elements left open end with the element around them or the page, and those without text of
    their own (an svg, a select) also where the next block starts; comments, scripts, styles,
    the head and hidden elements give no text. Character references are decoded, white space
    becomes one space, and blocks without text are left out. ``hinted`` is the share of the page's
    words outside the innermost element whose names hint at something beside the text, so a wrapper
    around the whole page counts as none; it is 1 if that element comes after text, as comments do. A
    form is such an element, too; it may be a wrapper if it holds parts of the page's structure or
    most of the words. ``place`` tells blocks of one containing element from others.
    """
    page = page or ""
    out: list[Block] = []
    stack: list[tuple[str, list[str], int]] = []  # open elements, what they do, their number
    count: dict[str, int] = {}  # open elements by name
    parts: list[str] = []
    linked = 0
    depth = {"a": 0, "article": 0, "apart": 0, "heading": 0, "hidden": 0}
    words = 0  # in the blocks so far
    # for each hinted element and form: the words before it, up to its end, if it follows text, and if
    # its share of the page tells a wrapper
    hints: list[list[int]] = []
    within: list[int] = []  # the open ones
    forms: list[int] = []  # open forms without an element of _STRUCTURE so far
    hinted = opened = 0  # open elements that are hinted by name; all elements so far
    texts = 0  # blocks of text so far
    articles: list[int] = []  # those before each open article
    ending: dict[int, int] | None = None
    left_open = 0  # open elements of _RAW

    def effects(tag: str, rest: str) -> list[str]:
        inside = depth["article"] > 0
        out = []
        if tag == "a":
            out.append("a")
        if tag in ("article", "main"):
            out.append("article")
        if tag in _APART or tag == "header" and not inside:
            out.append("apart")
        if tag == "form":
            out.append("form")
        elif rest and tag not in ("body", "html"):
            told = {_told(name, inside) for name in named(rest, bool(re.fullmatch("h[1-6]", tag)))}
            out += ["hint"] if "hint" in told else ["state"] if "state" in told else []
        if re.fullmatch("h[1-6]", tag):
            out.append("heading")
        if rest and hides(rest):
            out.append("hidden")
        return out

    def enter(tag: str, does: list[str]) -> None:
        nonlocal hinted, opened
        if tag in _STRUCTURE:
            for form in forms:
                hints[form][3] = True
            forms.clear()
        for e in does:
            if e in ("hint", "state", "form"):
                within.append(len(hints))
                before = articles[-1] if articles else 0
                hints.append([words, words, e != "state" and texts > before, e != "form"])
                if e == "form":
                    forms.append(within[-1])
                hinted += e == "hint"
            else:
                depth[e] += 1
        if "article" in does:
            articles.append(texts)
        opened += 1
        stack.append((tag, does, opened))
        count[tag] = count.get(tag, 0) + 1

    def leave() -> str:
        nonlocal left_open, hinted
        tag, does, _ = stack.pop()
        count[tag] -= 1
        left_open -= tag in _RAW
        for e in does:
            if e in ("hint", "state", "form"):
                ended = within.pop()
                hints[ended][1] = words
                hinted -= e == "hint"
                if forms and forms[-1] == ended:
                    forms.pop()
            else:
                depth[e] -= 1
        if "article" in does:
            articles.pop()
        return tag

    def flush() -> None:
        nonlocal parts, linked, words, texts
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            block = Block()
            block.text, block.words = text, text.count(" ") + 1
            block.density = min(1.0, linked / block.words)
            block.in_article = depth["article"] > 0
            block.apart, block.hinted = depth["apart"] > 0, within[-1] if within else None
            block.heading = depth["heading"] > 0
            block.place = next((n for tag, _, n in reversed(stack) if tag not in _ITEM and tag not in _INLINE), 0)
            out.append(block)
            words += block.words
            if not (block.apart or block.heading or hinted or block.density > 0.5) and (
                    block.in_article or block.words >= _TEXT_WORDS):
                texts += 1
        parts, linked = [], 0

    def said(text: str) -> None:
        nonlocal linked
        if text and not depth["hidden"]:
            parts.append(text)
            if depth["a"]:
                linked += len(text.split())

    at, head_ends = 0, True
    while m := _TOKEN.search(page, at):
        said(page[at:m.start()])
        at = m.end()
        tag = (m["tag"] or m["tag2"] or "").lower()
        if not tag:
            continue
        rest = m["rest"] or m["rest2"] or ""
        closing = bool(m["end"] or m["end2"])
        if tag not in _INLINE:
            flush()
        if closing:
            if count.get(tag):
                while leave() != tag:
                    pass
            continue
        if tag in _VOID or rest.endswith("/"):
            continue
        if tag == "head":
            if head_ends:
                at, head_ends = after(page, tag, at) or at, after(page, tag, at) is not None
            continue
        if tag in _TO_THE_END:
            at = after(page, tag, at) or len(page)
            continue
        if tag in _RAW:
            ending = own_ends(page) if ending is None else ending
            if at in ending:
                at = ending[at]
            else:
                enter(tag, ["hidden"])
                left_open += 1
            continue
        while left_open and tag in _BLOCK:
            leave()
        if tag in ("p", "li", "option", "dt", "dd", "tr", "td", "th") and stack and stack[-1][0] == tag:
            leave()
        enter(tag, effects(tag, rest))
    said(page[at:])
    flush()
    while stack:
        leave()
    for block in out:
        start, end, follows, shared = (0, words, False, True) if block.hinted is None else hints[block.hinted]
        block.hinted = 1.0 if follows or not shared and end - start < _WRAPPED * words else 1 - (end - start) / words
    return out


def _in_prose(found: list[Block]) -> np.ndarray:
    """Whether the nearest blocks before and after a block that are no links are running text in
    the element that holds it: a list of links in the middle of a text."""
    text = [b.density <= 0.5 and b.words >= _TEXT_WORDS and not b.apart and b.hinted < 0.5 for b in found]
    before: list[int | None] = []
    for side in (range(len(found)), reversed(range(len(found)))):
        last, out = None, [None] * len(found)
        for i in side:
            out[i] = last
            if found[i].density <= 0.5 and not found[i].heading:
                last = found[i].place if text[i] else None
        before.append(out)
    return np.array([a is not None and a == c == b.place for a, c, b in zip(*before, found)], dtype=float)


def features(found: list[Block]) -> np.ndarray:
    """A row for each block: its own figures and those of its neighbours, whether the page has an
    article that the block is not in, and whether text of the same element is around it."""
    has_article = any(b.in_article for b in found)
    out = np.zeros((len(found), len(FEATURES)))
    around = _in_prose(found)
    for i, b in enumerate(found):
        out[i, 0:2] = b.words, b.density
        if i:
            out[i, 2:4] = found[i - 1].words, found[i - 1].density
        if i + 1 < len(found):
            out[i, 4:6] = found[i + 1].words, found[i + 1].density
        out[i, 6:] = b.in_article, b.apart, b.hinted, b.heading, has_article and not b.in_article, around[i]
    return out


def labelled_table() -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the blocks of the labelled pages."""
    rows, labels = [], []
    for page in PAGES:
        found = blocks("".join(piece for _, piece in page))
        expected = [label for label, piece in page for _ in blocks(piece)]
        if len(found) != len(expected):
            raise ValueError("a labelled piece gives other blocks alone than in its page")
        rows.append(features(found))
        labels += expected
    return np.concatenate(rows), np.array(labels)


def grow_tree(x: np.ndarray, y: np.ndarray, depth: int = 8, least: int = 1):
    """A decision tree by Gini impurity: (feature, threshold, at most, above) or a share."""
    share = float(y.mean())
    if depth == 0 or share in (0.0, 1.0) or len(y) < 2 * least:
        return share
    best = None
    for f in range(x.shape[1]):
        order = np.argsort(x[:, f], kind="stable")
        v, ones = x[order, f], np.cumsum(y[order])
        n = np.arange(1, len(y))
        left, right = ones[:-1] / n, (ones[-1] - ones[:-1]) / (len(y) - n)
        gini = n * left * (1 - left) + (len(y) - n) * right * (1 - right)
        gini[(v[1:] == v[:-1]) | (n < least) | (len(y) - n < least)] = np.inf
        k = int(np.argmin(gini))
        if np.isfinite(gini[k]) and (best is None or gini[k] < best[0] - 1e-12):
            best = gini[k], f, (v[k] + v[k + 1]) / 2
    if best is None or best[0] >= len(y) * share * (1 - share) - 1e-12:
        return share
    _, f, t = best
    low = x[:, f] <= t
    return f, t, grow_tree(x[low], y[low], depth - 1, least), grow_tree(x[~low], y[~low], depth - 1, least)


def judge(tree, x: np.ndarray) -> np.ndarray:
    """The share of main text at each row's leaf."""
    if not isinstance(tree, tuple):
        return np.full(len(x), tree)
    f, t, low, high = tree
    below = x[:, f] <= t
    out = np.empty(len(x))
    out[below], out[~below] = judge(low, x[below]), judge(high, x[~below])
    return out


@functools.cache
def block_tree():
    return grow_tree(*labelled_table())


def main_text(page: str | None) -> str:
    """The main text of one page, blocks joined by a line break; empty if it has none."""
    found = blocks(page)
    if not found:
        return ""
    keep = judge(block_tree(), features(found)) >= 0.5
    return "\n".join(b.text for b, k in zip(found, keep) if k)


@F.pandas_udf(T.StringType())
def _main_text(pages: pd.Series) -> pd.Series:
    return pd.Series([main_text(p) for p in pages], dtype=object)


def extract_text(pages: DataFrame, html_col: str = "html", to_col: str = "text") -> DataFrame:
    """The pages with their main text in ``to_col``, in one scan without a shuffle; the tree is
    grown from the labelled table in each worker, the same everywhere.

    Defined cases: null and empty pages, and pages without main text, give the empty text;
    other columns pass through, one named ``to_col`` is replaced; rows may repeat; an empty
    table gives an empty one; a page is held whole in one task.
    """
    return pages.withColumn(to_col, _main_text(F.col(html_col)))


def op5_html_extraction(spark, folder: str) -> DataFrame:
    found = extract_text(read(spark, folder, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))
