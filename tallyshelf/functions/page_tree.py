"""Products of one HTML page, read in a single pass.

A helper for the page jobs. Every open element gathers what it holds: visible
text, up to two product ids, cells, and links that still look for a container.
When it closes, it is judged from that alone and handed to the element around
it. Text is dropped as soon as no element further out can need it, so a page of
thousands of links takes time in proportion to its length.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from html.parser import HTMLParser

# Fixed values.
VOID_TAGS = {"br", "img", "input", "meta", "link", "hr", "source", "wbr"}
HIDDEN_TAGS = {"script", "style", "svg", "noscript"}
PRODUCT_ID = re.compile(r"/productdetail/(A\d+)", re.I)
BAHT_PRICE = re.compile(r"฿\s*([\d,]+(?:\.\d{1,2})?)")
CARD_TEXT = range(20, 1001)


@dataclass
class _Link:
    product: str
    href: str
    label: str
    text: str = ""


@dataclass
class _Open:
    tag: str
    order: int
    link: _Link | None = None
    words: list[str] = field(default_factory=list)
    length: int = -1  # of the words joined by spaces
    ids: set[str] = field(default_factory=set)
    href: str = ""  # of the first product link inside
    cells: list[str] = field(default_factory=list)
    waiting: list[_Link] = field(default_factory=list)

    @property
    def crowded(self) -> bool:
        """Two ids: neither a row nor a card, and nothing around it is."""
        return len(self.ids) > 1

    def hold(self, words: list[str], length: int) -> None:
        if length >= 0 and not self.crowded:
            # An empty list takes the other over, so words of nested elements are not copied once per level.
            if self.words:
                self.words.extend(words)
            else:
                self.words = words
            self.length += length + 1


def prices(text: str) -> list[float | None]:
    """Baht prices in a text; None where the digits are only commas."""
    return [float(d) if (d := p.replace(",", "")) else None for p in BAHT_PRICE.findall(text)]


class PageProducts(HTMLParser):
    """``rows`` and ``cards``: (id, name, price, href, text) in page order; ``counts``: why others are none."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.counts: Counter = Counter()
        self._rows: list[tuple[int, tuple]] = []
        self._cards: dict[int, tuple] = {}
        self._links: list[_Link] = []
        self._seen = 0
        self._stack = [_Open("#page", 0)]
        self._hidden = 0
        self._open_tags: Counter = Counter()
        self.feed(html)
        self.close()
        while self._stack:
            self._leave()
        self.counts["card_links"] = len(self._links)
        self.counts["card_no_valid_container"] = len(self._links) - len(self._cards) - self.counts["card_no_name"]
        self.rows = [item for _, item in sorted(self._rows, key=lambda r: r[0])]
        self.cards = [self._cards[id(link)] for link in self._links if id(link) in self._cards]

    def handle_starttag(self, tag, attrs):
        self._seen += 1
        element = _Open(tag, self._seen)
        if tag == "a":
            values = {k: v or "" for k, v in attrs}
            found = PRODUCT_ID.search(values.get("href", ""))
            if found:
                label = values.get("aria-label") or values.get("title") or ""
                element.link = _Link(found.group(1).upper(), values["href"], label)
                element.ids, element.href, element.waiting = {element.link.product}, values["href"], [element.link]
                self._links.append(element.link)
        self._stack.append(element)
        self._open_tags[tag] += 1
        if tag in VOID_TAGS:
            self._leave()
        elif tag in HIDDEN_TAGS:
            self._hidden += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS:
            self._leave()

    def handle_endtag(self, tag):
        if self._open_tags[tag]:
            while self._leave() != tag:
                pass

    def handle_data(self, data):
        words = data.split()
        if words:
            self._stack[-1].hold(words, len(" ".join(words)))

    def _leave(self) -> str:
        element = self._stack.pop()
        self._open_tags[element.tag] -= 1
        hidden = element.tag in HIDDEN_TAGS
        if hidden:
            self._hidden -= 1
            element.words, element.length = [], -1
        around = self._stack[-1] if self._stack else None
        needed = element.link or element.tag in ("td", "th") or (
            len(element.ids) == 1 and (element.tag == "tr" or element.waiting and element.length < CARD_TEXT.stop)
        )
        text = " ".join(element.words) if needed else ""
        if element.link:
            element.link.text = text
        if element.tag == "tr":
            self._judge_row(element, text)
        if element.waiting:
            self._judge_cards(element, text)
        if around:
            if element.tag in ("td", "th") and text:
                around.cells.append(text)
            around.href = around.href or element.href
            around.ids |= set(sorted(element.ids)[:2])
            around.waiting += element.waiting
            around.hold(element.words, element.length)
            if around.crowded:
                # No container further out fits any link in here.
                around.words, around.waiting = [], []
        return element.tag

    def _judge_row(self, row: _Open, text: str) -> None:
        self.counts["table_rows"] += 1
        amounts = prices(text) if len(row.ids) == 1 else []
        if len(row.ids) != 1:
            self.counts["table_no_single_id"] += 1
        elif len(amounts) != 1:
            self.counts["table_price_not_single"] += 1
        elif len(row.cells) < 2:
            self.counts["table_insufficient_cells"] += 1
        elif not amounts[0]:
            self.counts["table_invalid_name_or_price"] += 1
        else:
            self._rows.append((row.order, (min(row.ids), row.cells[0], amounts[0], row.href, text)))

    def _judge_cards(self, box: _Open, text: str) -> None:
        """A fitting element takes the links waiting inside; one that is too long ends their wait, as those around are longer."""
        amounts = prices(text) if len(text) in CARD_TEXT else []
        if len(amounts) == 1 and amounts[0]:
            for link in box.waiting:
                name = " ".join((link.label or link.text).split())
                if name:
                    self._cards[id(link)] = (link.product, name, amounts[0], link.href, text)
                else:
                    self.counts["card_no_name"] += 1
            box.waiting = []
        elif box.length >= CARD_TEXT.stop and not self._hidden:
            box.waiting = []


def page_products(html: str) -> tuple[str, dict[str, int], list[tuple]]:
    """(mode, counters, products): the table's products or, if it has none, those of cards; the first of each id and price."""
    page = PageProducts(html)
    mode, found = ("table", page.rows) if page.rows else ("structured_card", page.cards)
    first: dict[tuple, tuple] = {}
    for item in found:
        first.setdefault((item[0], item[2]), item)
    counts = {k: n for k, n in page.counts.items() if not page.rows or not k.startswith("card_")}
    return mode, {**counts, "found": len(found)}, list(first.values())
