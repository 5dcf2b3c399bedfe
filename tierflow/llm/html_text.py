"""Main text of web pages by two-pass block rules.

The page is cut into blocks at block-level tags. Pass one drops blocks by where
they stand (menus, forms, adverts, comments and the like) and by link density,
and keeps long enough ones with many stop words of four languages. Blocks that
are too short, or have too few stop words to tell (tables, code, other
languages), stay open; pass two gives them the label of the nearest decided
neighbour. Where pass one keeps no block, it keeps the open ones that are long
enough and have few links.

Where a page names its article (``article``, ``main``), the place says more than
the words: only blocks inside count, and an open block there stays unless it
stands between two dropped ones. Kept blocks are joined in page order by one
line feed.

A name in a class, id or role is a mark only as a whole (``sidebar``,
``cookie-notice`` and ``post-comments``, not ``has-sidebar`` or
``content-sidebar-wrap``). Marks never drop ``main`` or what contains it, and
forms no ``article`` or ``main`` in them. An ``article`` with more text than all
that is otherwise left (inside such elements, or on the page if nothing is) is
not dropped by any mark or form on or around it; nor is a form that has more.

Cases: NULL and empty pages have an empty text; unclosed tags, comments and
scripts end where the page ends or their parent closes; character references
are decoded once; repeated rows give equal results; very long pages are read
whole, broken ones too in time that grows with their length; columns other than the page and those asked for are not read; an empty
table gives an empty result.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rules of the first pass.
SHORT = 70
LONG = 200
STOP_WORDS_ENOUGH = 0.25
LINKS_TOO_DENSE = 0.5
LINKS_MANY = 0.2

# The most frequent function words of four languages.
STOP_WORDS = frozenset(
    """the of and to in a is that for it was on with as be by at this are from or an not have which but were has had their they you he she we his her its
    der die das und in zu den ist von mit für auf im sich nicht ein eine dem des als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem über
    le la les de des et en un une du est que pour dans au par sur qui ne pas il se ce plus avec son sa ses ou mais sont cette aux été leur
    el la los las de y en un una que es por con del al se no lo para su como más pero sus le ha o este sí porque esta entre cuando muy sin sobre""".split()
)
# HTML elements that break a block, that are never article text, and that hold raw text.
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary table tbody td tfoot th thead tr ul".split())
DROPPED = frozenset("nav footer aside form fieldset select button dialog menu noscript template iframe object svg math canvas audio video map head datalist label".split())
RAW = frozenset("script style textarea title xmp noframes noembed".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
MAIN = frozenset(("article", "main"))
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
# Words in class names, ids and roles that mark what is not the article.
MARKS = frozenset(
    """ad ads adv advert adverts advertisement advertising adbox adsense sponsor sponsored sponsors promo promotion promoted banner nav navbar navigation menu breadcrumb breadcrumbs
    sidebar sidebars aside footer masthead cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup share sharing social
    related recommended recommendations teaser teasers comment comments commentlist respond reply replies disqus login search searchbox widget widgets toolbar pagination pager
    skip complementary contentinfo hidden outbrain taboola""".split()
)
# Words before a mark that say whose it is, and words after it that say what kind of box.
WHOSE = frozenset("site page post article main entry primary secondary global".split())
BOXES = frozenset(
    """area areas articles bar bars block blocks box boxes btn button buttons container containers form group header heading icons inner item items link links list lists media
    outer panel posts row section sections slot slots stories text this title unit units wrap wrapper zone""".split()
)

_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/><]*)")
_STOP = re.compile("[>\"']")
_NAMED = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+")
_WORD = re.compile(r"[^\W\d_]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
# Why an element drops what it contains; all but the first give way to the page's article.
_BY_ELEMENT, _BY_MARK, _BY_FORM, _BY_HIDING = 1, 2, 4, 8


def _is_mark(name: str) -> bool:
    """Whether a name is a mark as a whole: whose, a mark, then marks and kinds of boxes."""
    parts = [x for x in _SPLIT.split(_CAMEL.sub(" ", name).lower()) if x and not x.isdigit()]
    first = next((i for i, x in enumerate(parts) if x not in WHOSE), len(parts))
    return first < len(parts) and parts[first] in MARKS and all(x in MARKS or x in BOXES for x in parts[first + 1 :])


def _marked(attributes: str) -> int:
    """Whether an element's names or roles say that it is not the article, or that it is not shown."""
    why = 0
    for name, a, b, c in _NAMED.findall(attributes):
        value = a or b or c
        name = name.lower()
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            why |= _BY_HIDING
        elif name == "style":
            if "display:none" in value.replace(" ", "").lower():
                why |= _BY_HIDING
        elif name != "aria-hidden" and any(map(_is_mark, value.split())):
            why |= _BY_MARK
    return why


class _Places:
    """The block elements of a page, parents before children, and the text that stands in them."""

    def __init__(self) -> None:
        self.parent, self.names, self.why, self.main = [-1], [""], [0], [False]
        self.text: list[tuple[int, int]] = []  # place of a block, characters outside links

    def add(self, parent: int, name: str, why: int) -> int:
        self.parent.append(parent)
        self.names.append(name)
        self.why.append(why)
        self.main.append(self.main[parent] or name in MAIN)
        return len(self.names) - 1

    def dropped(self, kinds: int = 15) -> list[bool]:
        out = [False] * len(self.names)
        for i in range(1, len(out)):
            out[i] = out[self.parent[i]] or bool(self.why[i] & kinds)
        return out

    def clear(self, place: int, kinds: int) -> None:
        """Take reasons from a place and from all that contain it."""
        while place > 0:
            self.why[place] &= ~kinds
            place = self.parent[place]

    def own_text(self) -> list[int]:
        """For each place its text that nothing inside it drops."""
        sums = [0] * len(self.names)
        for at, size in self.text:
            sums[at] += size
        for i in range(len(sums) - 1, 0, -1):
            if not self.why[i]:
                sums[self.parent[i]] += sums[i]
        return sums

    def settle(self) -> None:
        """Keep marks and forms from dropping the page's article."""
        size = len(self.names)
        if not any(why & ~_BY_ELEMENT for why in self.why):
            return
        gone = self.dropped(_BY_ELEMENT)
        holds = [0] * size  # reasons that what a place is or contains rules out
        for i in range(size - 1, 0, -1):
            if self.names[i] in MAIN and not gone[i]:
                holds[i] |= _BY_FORM | (_BY_MARK if self.names[i] == "main" else 0)
            self.why[i] &= ~holds[i]
            holds[self.parent[i]] |= holds[i]
        while True:  # the text left more than doubles each time, so the turns are few
            out = self.dropped()
            inside = sum(n for at, n in self.text if not out[at] and self.main[at])
            left = inside or sum(n for at, n in self.text if not out[at])
            other = self.dropped(_BY_ELEMENT | _BY_MARK | _BY_HIDING)
            sums = self.own_text()
            best = max((i for i in range(size) if out[i] and not gone[i] and (self.names[i] in MAIN or (self.why[i] & _BY_FORM and not other[i] and (self.main[i] or not inside)))), key=lambda i: (sums[i], -i), default=0)
            if not best or sums[best] <= left:
                return
            self.clear(best, ~_BY_ELEMENT if self.names[best] in MAIN else _BY_FORM)


class Tags:
    """The tags and comments of a page, one after the other, in time that grows with the page alone.

    A tag ends at the first ``>`` outside quotes. Where that is depends only on
    the first ``>`` or quote after its name, so the answer is kept for each of
    these; a page of tags that never end is not searched again for every one.
    """

    def __init__(self, page: str):
        self.page, self.last = page, page.rfind(">")
        self.ends: dict[int, int] = {}
        self.free, self.stop = 0, -1  # from the one to the other nothing ends or is quoted

    def _stop(self, at: int) -> int:
        """The first ``>`` or quote from ``at`` on; the page's length if there is none."""
        found = _STOP.search(self.page, at)
        return found.start() if found else len(self.page)

    def end(self, at: int) -> int:
        """The place after the ``>`` that ends a tag whose attributes begin at ``at``; -1 if none does."""
        page, way, found = self.page, [], -1
        if not self.free <= at <= self.stop:
            self.free, self.stop = at, self._stop(at)
        place = self.stop
        while place < len(page):
            if place in self.ends:
                found = self.ends[place]
                break
            way.append(place)
            if page[place] == ">":
                found = place + 1
                break
            close = page.find(page[place], place + 1)
            if close < 0:
                break
            place = self._stop(close + 1)
        for place in way:
            self.ends[place] = found
        return found

    def following(self, at: int) -> tuple[int, int, str, str, str] | None:
        """(start, end, "/" or "", name, attributes) of the next tag or comment; comments have no name."""
        page = self.page
        start = page.find("<", at)
        while start >= 0:
            if page.startswith("<!--", start):
                end = page.find("-->", start + 4)
                return start, end + 3 if end >= 0 else len(page), "", "", ""
            if start > self.last:
                return None if page.find("<!--", start) < 0 else self.following(page.find("<!--", start))
            name = _NAME.match(page, start)
            if name is not None:
                end = self.end(name.end())
                if end >= 0:
                    return start, end, name[1], name[2].lower(), page[name.end() : end - 1]
            if page[start + 1 : start + 2] in ("!", "?", "/"):
                return start, page.find(">", start + 2) + 1, "", "", ""
            start = page.find("<", start + 1)
        return None


def blocks(page: str) -> list[tuple[str, int, bool, bool, bool]]:
    """Blocks as (text, characters inside links, outside the article by place, inside a main element, heading)."""
    found_blocks: list[tuple[str, int, int, bool]] = []
    places = _Places()
    stack: list[tuple[str, int, bool]] = []  # element, its place, breaks a block
    pieces: list[str] = []
    linked = at = breaks = 0
    in_link = False

    def close_block() -> None:
        nonlocal linked, breaks
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                links, place = min(linked, len(text)), stack[-1][1] if stack else 0
                found_blocks.append((text, links, place, bool(stack) and stack[-1][0] in HEADINGS))
                places.text.append((place, len(text) - links))
            pieces.clear()
        linked = breaks = 0

    def take(text: str) -> None:
        nonlocal linked, breaks
        if "&" in text:
            text = html.unescape(text)
        pieces.append(text)
        if in_link:
            linked += len(" ".join(text.split()))
        if breaks and text.strip():
            breaks = 0

    size, tags = len(page), Tags(page)
    opened: dict[str, int] = {}  # elements on the stack by name

    def pop(n: int) -> None:
        for element, _, _ in stack[n:]:
            opened[element] -= 1
        del stack[n:]

    def push(name: str, place: int, breaks_block: bool) -> None:
        opened[name] = opened.get(name, 0) + 1
        stack.append((name, place, breaks_block))

    while at < size:
        found = tags.following(at)
        if found is None:
            rest = page[at:]
            # a tag that the page's end cuts off is no text
            cut = re.search(r"<(?:[a-zA-Z/!?][^<]*)?\Z", rest)
            take(rest[: cut.start()] if cut else rest)
            break
        start, end, slash, name, attributes = found
        if start > at:
            take(page[at:start])
        at = end
        if not name:
            continue
        if slash:  # an end tag
            if name == "a":
                in_link = False
            open_at = next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name) if opened.get(name) else None
            if name in BLOCK or name in DROPPED or (open_at is not None and stack[open_at][2]):
                close_block()
            if open_at is not None:
                in_link = in_link and stack[open_at][0] not in BLOCK
                pop(open_at)
            continue
        if name in RAW:
            shut = re.compile(rf"</{name}\b", re.I).search(page, at)
            after = page.find(">", shut.end()) if shut else -1
            at = after + 1 if after >= 0 else size
            pieces.append(" ")
            continue
        if name == "br":
            pieces.append(" ")
            breaks += 1
            if breaks > 1:
                close_block()
        elif name == "a":
            in_link = True
        why = _marked(attributes) if attributes else 0
        if name in BLOCK or name in DROPPED or why:
            close_block()
            if name in VOID:
                continue
            if (name == "p" or name in HEADINGS) and stack and stack[-1][0] == "p":
                pop(len(stack) - 1)
            elif name == "li" and stack and stack[-1][0] == "li":
                pop(len(stack) - 1)
            above = stack[-1][1] if stack else 0
            if name in ("main", "body", "html"):
                why = 0
            if name == "form":
                why |= _BY_FORM
            elif name in DROPPED or (name == "header" and not places.main[above]):
                why |= _BY_ELEMENT
            push(name, places.add(above, name, why), True)
        elif opened.get(name):
            push(name, stack[-1][1], False)  # so that its end tag closes this one
    close_block()
    places.settle()
    out = places.dropped()
    return [(text, links, out[place], places.main[place], heading) for text, links, place, heading in found_blocks]


def main_text(page: str | None) -> str:
    """The article of one page."""
    found = blocks(page or "")
    inside = any(main and not out for _, _, out, main, _ in found)
    labels: list[bool | None] = []
    for text, linked, out, main, _ in found:
        density = linked / len(text)
        if out or (inside and not main):
            labels.append(False)
        elif density > LINKS_TOO_DENSE:
            labels.append(False)
        elif len(text) < SHORT:
            labels.append(False if density > LINKS_MANY and not inside else None)
        else:
            words = _WORD.findall(text.lower())
            stop = sum(w in STOP_WORDS for w in words) / max(1, len(words))
            if stop >= STOP_WORDS_ENOUGH and (density <= LINKS_MANY or len(text) > LONG):
                labels.append(True)
            else:
                labels.append(None)
    if not inside and not any(labels):
        # tables, code or another language: stop words say nothing about this page
        labels = [True if x is None and len(text) >= SHORT and linked <= LINKS_MANY * len(text) else x for x, (text, linked, *_) in zip(labels, found, strict=True)]
    decided = [i for i, x in enumerate(labels) if x is not None and not found[i][2] and (found[i][3] or not inside)]
    kept = []
    place = 0
    for i, label in enumerate(labels):
        while place < len(decided) and decided[place] < i:
            place += 1
        if label is None:
            before = decided[place - 1] if place else None
            after = decided[place] if place < len(decided) else None
            if inside:
                # an open block of the article goes only between two link lists
                label = not (before is not None and after is not None and not labels[before] and not labels[after]) or not any(labels[j] for j in decided)
            elif before is None or after is None:
                near = before if after is None else after
                label = bool(near is not None and labels[near])
            elif labels[before] == labels[after]:
                label = bool(labels[before])
            elif found[i][4] or i - before > after - i:
                label = bool(labels[after])  # a heading goes with what follows
            else:
                label = i - before < after - i and bool(labels[before])
        if label:
            kept.append(found[i][0])
    return "\n".join(kept)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(p) for p in batch.column(batch.num_columns - 1).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=[*batch.schema.names[:-1], "text", "n_chars"])


def extract(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The ``keep`` columns with ``text`` and its number of code points ``n_chars``; a scan without a shuffle."""
    rows = pages.select(*keep, F.col(html_col).alias("__page"))
    schema = pages.select(*keep).schema.add("text", "string").add("n_chars", "long")
    return rows.mapInArrow(_extract, schema)
