"""Main text of HTML pages by the line-block distribution.

Markup is stripped to lines, one per block. A line's length is the length of its text; text of menus, headers, footers,
sidebars, notices, adverts, forms, hidden parts and reader comments goes with its markup and leaves lines of length 0,
one for each of its pieces, as do lines that are mostly links outside an article. Lengths are summed over windows of ``WINDOW`` lines. A surge
point is where the sum leaves 0, a dive point where it is back at 0; the text between them is one stretch. The stretches
whose peak sum comes near the page's highest one are kept. In an article or main element (a *frame*) lines weigh
``FRAME_WEIGHT`` times their length; a stretch ends at the frame's borders, and the stretches of a frame are judged as
one, by the highest peak among them, so that an article is whole or out.

Results in edge cases: a null, empty or textless page gives an empty text; broken or cut-off markup ends at the end of
the page; an element to leave out that is never closed ends with the element around it or where an article starts, and where
HTML lets its end tag be omitted (``<p>``, ``<li>`` and the like), with the next one of its kind; a page of any length is read whole;
an empty table gives an empty table; the added column replaces one of the same name.
"""

from __future__ import annotations

import html
import re
from collections import Counter

from pyspark.sql import DataFrame

from .arrow import with_mapped

WINDOW = 3
# A stretch is kept when its peak is at least this share of the page's highest.
PEAK_SHARE = 0.25
FRAME_WEIGHT = 4
LINK_SHARE = 0.5

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?>(?:\"[^\"]*\"|'[^']*'|[^\"'>])*))(?:>|\Z)"
    r"|<(?P<close2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")

# HTML element names by role.
_RAW = {"script", "style", "title", "textarea", "xmp", "noembed", "noframes"}
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark nobr q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr img label".split()
)
_LEFT_OUT = set(
    "nav footer aside form button select menu dialog iframe object noscript template svg math canvas audio video head "
    "map datalist applet".split()
)
_LEFT_OUT_ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar".split())
_WHOLE = {"html", "body", "main"}
# Class and id names of these say what they are about, not what they are.
_OWN_NAMES = {"article", "h1", "h2", "h3", "h4", "h5", "h6"}

# Elements whose end tag can be omitted, with the start tags that end them, and the elements inside that
# keep a start tag from doing so.
_ENDS_P = set(
    "address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search section summary table ul".split()
)
_ROW_GROUPS = {"tbody", "thead", "tfoot"}
_ENDED_BY = {
    "p": _ENDS_P, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th", "tr"} | _ROW_GROUPS,
    "th": {"td", "th", "tr"} | _ROW_GROUPS, "tr": {"tr"} | _ROW_GROUPS, "option": {"option", "optgroup"},
} | dict.fromkeys(_ROW_GROUPS, _ROW_GROUPS)
_NO_BARRIER = {"address", "div", "p"}

# Parts of class and id names that mark what is not the article; parts that may stand beside them;
# and those with which a header is the article's own. A name with any other part, as "has-sidebar", "related-work" or
# "category-social-media", marks nothing.
_NOT_ARTICLE = re.compile(
    r"ads?|adv|adverts?|advertisements?|advertising|sponsor(?:ed|s)?|promos?|promotions?|banners?|nav|navbar|navigation|"
    r"menus?|breadcrumbs?|masthead|header|footer|sidebars?|aside|widgets?|cookies?|consent|gdpr|notices?|alerts?|popups?|"
    r"modals?|overlays?|comments?|commentlist|disqus|replies|respond|share|sharing|social|related|recommended|"
    r"recommendations|newsletter|subscribe|signup|login|search|pager|pagination|copyright|toolbar|paywall"
)
_BESIDE = re.compile(
    r"\d+|area|articles?|bars?|block|body|bottom|box|btns?|buttons?|col|column|container|content|desktop|entry|fixed|form|global|"
    r"google|group|holder|icons?|inline|inner|item|items|js|left|links?|list|lower|main|mobile|module|outer|page|panel|"
    r"post|posts|primary|region|right|row|secondary|section|site|slot|stories|story|sticky|sub|text|the|title|top|"
    r"unit|upper|user|wrap|wrapper|wp|zone"
)
_ARTICLE_NAME = re.compile(r"article|content|post|entry|story")


def _left_out(name: str, rest: str, in_article: bool) -> bool:
    if name in _LEFT_OUT:
        return True
    if name == "header" and not in_article:
        return True
    if name in _WHOLE or name in _VOID or not rest.strip():
        return False
    for match in _ATTRIBUTE.finditer(rest):
        key, value = match[1].lower(), (match[2] or "").strip("\"'").lower()
        if key == "hidden" or (key == "aria-hidden" and value == "true"):
            return True
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
        if key == "role" and value in _LEFT_OUT_ROLES:
            return True
        if key in ("class", "id") and name not in _OWN_NAMES:
            for word in value.split():
                parts = [part for part in re.split(r"[-_:]+|(?<=[a-z])(?=\d)", word) if part]
                marks = {part for part in parts if _NOT_ARTICLE.fullmatch(part)}
                if marks == {"header"} and any(_ARTICLE_NAME.fullmatch(part) for part in parts):
                    continue
                if marks and all(part in marks or _BESIDE.fullmatch(part) for part in parts):
                    return True
    return False


class _LeftOut:
    """The element that is being left out, and the elements that are open inside it."""

    def __init__(self, name: str):
        self.name = name
        self.inner: list[str] = []
        self.counts: Counter[str] = Counter()
        self.barriers = 0

    def _count(self, name: str, by: int) -> None:
        self.counts[name] += by
        self.barriers += by * (name not in _INLINE and name not in _NO_BARRIER)

    def ends_at(self, name: str) -> bool:
        """If the start tag of ``name`` ends the element."""
        table = self.name in ("td", "th", "tr") or self.name in _ROW_GROUPS
        return name in _ENDED_BY.get(self.name, ()) and not (self.counts["table"] if table else self.barriers)

    def start(self, name: str) -> None:
        self.inner.append(name)
        self._count(name, 1)

    def end(self, name: str, around: Counter[str]) -> tuple[bool, bool]:
        """Takes an end tag: if the element ends there, and if the tag is an outer element's."""
        if self.counts[name]:
            while True:
                last = self.inner.pop()
                self._count(last, -1)
                if last == name:
                    return False, False
        if name == self.name:
            return True, False
        outer = name not in _INLINE and name not in _ENDED_BY and around[name] > 0
        outer |= self.name in ("td", "th", "tr") and (name == "tr" or name in _ROW_GROUPS) and not self.counts["table"]
        return outer, outer


def _close_of(name: str, page: str, start: int) -> int:
    """Where a raw text element's end tag begins; the end of the page if there is none."""
    found = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(page, start)
    return found.start() if found else len(page)


def lines_of(page: str) -> list[tuple[str, int, int]]:
    """The page's lines: text (empty where it was left out), characters of it inside links, and the number of the
    outermost article or main element that they are in (0 for none).
    """
    lines: list[tuple[str, int, int]] = []
    parts: list[str] = []
    linked = links = articles = frames = 0
    skipped: _LeftOut | None = None
    around: Counter[str] = Counter()  # elements that are open outside of it
    at = 0

    def end_line() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            lines.append((text, linked, frames if articles else 0))
        parts.clear()
        linked = 0

    while at < len(page):
        tag = _MARKUP.search(page, at)
        stop = tag.start() if tag else len(page)
        if stop > at and skipped:
            if not page[at:stop].isspace():
                lines.append(("", 0, frames if articles else 0))
        elif stop > at:
            text = html.unescape(page[at:stop])
            parts.append(text)
            if links:
                linked += len(text)
        if not tag:
            break
        at = tag.end()
        name = (tag["name"] or tag["name2"] or "").lower()
        if not name:
            continue
        closing, rest = bool(tag["close"] or tag["close2"]), tag["rest"] or tag["rest2"] or ""
        if not closing and name in _RAW:
            at = _close_of(name, page, at)
            continue
        open_ended = name not in _VOID and not rest.rstrip().endswith("/")
        if skipped:
            if closing:
                done, again = skipped.end(name, around)
            else:
                framed = name in ("article", "main") and name != skipped.name and not _left_out(name, rest, False)
                done = again = framed or skipped.ends_at(name)
                if not done and open_ended:
                    skipped.start(name)
            if done:
                skipped = None
            if not again:
                continue
        if not closing and name not in _VOID and _left_out(name, rest, articles > 0):
            if open_ended:
                if name not in _INLINE:
                    end_line()
                skipped = _LeftOut(name)
            continue
        if closing:
            around[name] -= around[name] > 0
        elif open_ended:
            around[name] += 1
        if name == "a":
            links = 0 if closing else 1
        if name not in _INLINE:
            end_line()
        if name in ("article", "main"):
            frames += not closing and not articles
            articles = max(0, articles - 1) if closing else articles + 1
    end_line()
    return lines


def main_text(page: str | None) -> str:
    """The article of one page."""
    lines = lines_of(page or "")
    lengths = [
        len(text) * (FRAME_WEIGHT if frame else 1) if frame or linked <= LINK_SHARE * len(text) else 0
        for text, linked, frame in lines
    ]
    stretches: list[tuple[int, int, list[str]]] = []
    peaks: dict[int, int] = {}
    peak, kept, window, begin = 0, [], 0, 0
    for at, length in enumerate(lengths):
        frame = lines[at][2]
        border = at > 0 and frame != lines[at - 1][2]
        if border:
            window, begin = 0, at
        window += length - (lengths[at - WINDOW] if at - WINDOW >= begin else 0)
        if kept and (border or window == 0):  # dive
            stretches.append((lines[at - 1][2], peak, kept))
            peak, kept = 0, []
        if length:  # surge, or further on in the stretch
            kept.append(lines[at][0])
        peak = max(peak, window)
        peaks[frame] = max(peaks.get(frame, 0), window)
    if kept:
        stretches.append((lines[-1][2], peak, kept))
    enough = PEAK_SHARE * max(peaks.values(), default=0)
    chosen = [part for frame, peak, part in stretches if (peaks[frame] if frame else peak) >= enough]
    return " ".join(text for part in chosen for text in part)


def extract(pages: DataFrame, page: str = "html", text: str = "text") -> DataFrame:
    """Add the column ``text`` with the main text of ``page``."""
    return with_mapped(pages, page, text, "string", lambda: main_text)
