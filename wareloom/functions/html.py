"""Reading a few fields out of captured HTML.

The only part of the engine that runs Python per row: HTML as found on the
web cannot be read with built-in expressions. Spark hands over Arrow batches
of the one column needed and gets back the extracted fields.

A rule is a list of choices ``(selector, nth)`` or ``(selector, nth, "squash")``;
the first choice with an nth match gives the value. Selectors know tags,
classes, ``[attribute=value]``, descendants and direct children (``>``).
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter, defaultdict
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, functions as F

from wareloom.schemas import NOT_AVAILABLE, PARSE_ERROR

# --- Fixed values: the markup the rules look for. --------------------------
LISTING_ITEM = "div.product-small.box"
ITEM_LINK = ("a.woocommerce-LoopProduct-link", "p.name.product-title > a", "a")
NEXT_LINK = "a.next.page-numbers"
PRODUCT_RULES = {
    "title": [("h1.product_title.entry-title", 0)],
    "price": [
        ("span.woocommerce-Price-amount.amount bdi", 1),
        ("span.woocommerce-Price-amount.amount bdi", 0),
        ("p.price span.woocommerce-Price-amount.amount", 0, "squash"),
    ],
    "tag": [("span.tagged_as a[rel=tag]", 0)],
    "sku": [("span.sku", 0)],
}
# HTML elements that never have content.
VOID_TAGS = frozenset("area base br col embed hr img input link meta source track wbr".split())
# Elements that end where one of these begins beside them, and those that their end tag may be left out in.
IMPLIED_ENDS = {
    "p": frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                   "header hr main menu nav ol p pre section table ul".split()),
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
    "option": frozenset(["option", "optgroup"]), "tr": frozenset(["tr", "tbody", "tfoot"]),
    "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]), "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
}
# An open element is not ended from inside one of these.
SCOPES = {
    "p": frozenset(["button", "td", "th", "caption", "object"]), "li": frozenset(["ul", "ol", "menu"]),
    "dt": frozenset(["dl"]), "dd": frozenset(["dl"]), "option": frozenset(["select", "datalist"]),
    "tr": frozenset(["table"]), "td": frozenset(["table"]), "th": frozenset(["table"]),
}
# ---------------------------------------------------------------------------


class _Element:
    __slots__ = ("tag", "attrs", "classes", "parent", "text_from", "text_to", "last")

    def __init__(self, tag, attrs, parent, text_from):
        self.tag, self.attrs, self.parent, self.text_from = tag, attrs, parent, text_from
        self.classes = frozenset(attrs.get("class", "").split())
        self.text_to = self.last = None


class Outline(HTMLParser):
    """Elements of one page in document order; a subtree is a slice of them."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.elements, self.texts, self.open = [], [], []
        self.open_tags = Counter()
        self.by_tag = defaultdict(list)
        self.feed(html)
        self.close()
        while self.open:
            self._end_innermost()

    def _end_implied(self, tag):
        """End the elements whose end tag may be left out before ``tag``."""
        for name, followers in IMPLIED_ENDS.items():
            if tag in followers and self.open_tags[name]:
                scope = SCOPES[name]
                for at in reversed(self.open):
                    above = self.elements[at].tag
                    if above == name:
                        while self._end_innermost() != name:
                            pass
                        break
                    if above in scope:
                        break

    def handle_starttag(self, tag, attrs):
        self._end_implied(tag)
        parent = self.open[-1] if self.open else None
        named = {name: value or "" for name, value in attrs}
        self.elements.append(_Element(tag, named, parent, len(self.texts)))
        self.open.append(len(self.elements) - 1)
        self.by_tag[tag].append(len(self.elements) - 1)
        self.open_tags[tag] += 1
        if tag in VOID_TAGS:
            self._end_innermost()

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if self.open_tags[tag]:
            while self._end_innermost() != tag:
                pass

    def handle_data(self, data):
        self.texts.append(data)

    def _end_innermost(self):
        element = self.elements[self.open.pop()]
        element.text_to, element.last = len(self.texts), len(self.elements)
        self.open_tags[element.tag] -= 1
        return element.tag

    def text(self, at: int) -> str:
        element = self.elements[at]
        return "".join(self.texts[element.text_from:element.text_to])

    def select(self, selector: list, within: int | None = None):
        """Positions matching ``selector``, in document order, inside ``within``."""
        first = 0 if within is None else within
        last = len(self.elements) if within is None else self.elements[within].last
        tag = selector[-1][1]
        candidates = range(first, last)
        if tag:
            positions = self.by_tag.get(tag, [])
            candidates = positions[bisect_left(positions, first):bisect_left(positions, last)]
        return (at for at in candidates if self._matches(at, selector, len(selector) - 1, first))

    def _matches(self, at: int, steps: list, n: int, first: int) -> bool:
        direct, tag, classes, attrs = steps[n]
        element = self.elements[at]
        if tag and element.tag != tag or not classes <= element.classes:
            return False
        if any(element.attrs.get(name) != value for name, value in attrs):
            return False
        if n == 0:
            return True
        above = element.parent
        while above is not None and above >= first:
            if self._matches(above, steps, n - 1, first):
                return True
            if direct:
                return False
            above = self.elements[above].parent
        return False


def compile_selector(selector: str) -> list:
    """Steps ``(must be a direct child, tag, classes, attributes)``."""
    steps, direct = [], False
    for part in selector.replace(">", " > ").split():
        if part == ">":
            direct = True
            continue
        attrs = tuple(re.findall(r"\[([\w-]+)=['\"]?([^'\"\]]*)['\"]?\]", part))
        names = re.sub(r"\[[^\]]*\]", "", part).split(".")
        steps.append((direct, names[0].lower(), frozenset(names[1:]), attrs))
        direct = False
    return steps


def _compile_rules(rules):
    return {
        name: [(compile_selector(choice[0]), choice[1], "squash" in choice[2:]) for choice in choices]
        for name, choices in rules.items()
    }


def _first_value(page: Outline, choices) -> str:
    for selector, nth, squash in choices:
        for found, at in enumerate(page.select(selector)):
            if found == nth:
                text = page.text(at)
                return " ".join(text.split()) if squash else text.strip()
    return NOT_AVAILABLE


def _href(page: Outline, choices, within=None):
    """href of the first element found by the first choice that finds any."""
    for selector in choices:
        at = next(page.select(selector, within), None)
        if at is not None:
            return page.elements[at].attrs.get("href")
    return None


def read_page(html: str, rules: dict, item, item_link, next_link) -> tuple[list[str], str | None, dict]:
    """Links of the listing items in order, link to the next page, and the fields.

    A page that cannot be parsed has no links, and marked fields.
    """
    try:
        page = Outline(html)
        hrefs = [_href(page, item_link, at) for at in page.select(item)]
        return ([href for href in hrefs if href is not None], _href(page, next_link),
                {name: _first_value(page, choices) for name, choices in rules.items()})
    except Exception:
        return [], None, dict.fromkeys(rules, PARSE_ERROR)


def extract_page(html: Column, rules: dict = PRODUCT_RULES, item: str = LISTING_ITEM, item_link=ITEM_LINK,
                 next_link: str = NEXT_LINK) -> Column:
    """Struct of ``links`` and ``next_link`` as they stand in the page, and ``fields`` with one string per rule."""
    compiled = _compile_rules(rules)
    selectors = compile_selector(item), [compile_selector(s) for s in item_link], [compile_selector(next_link)]
    kinds = [pa.list_(pa.string()), pa.string(), pa.struct([(name, pa.string()) for name in compiled])]
    fields = ", ".join(f"{name}: string" for name in compiled)

    @F.arrow_udf(f"struct<links: array<string>, next_link: string, fields: struct<{fields}>>")
    def read(pages: pa.Array) -> pa.Array:
        rows = [read_page(page.as_py(), compiled, *selectors) for page in pages]
        columns = zip(*rows) if rows else [[]] * len(kinds)
        return pa.StructArray.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["links", "next_link", "fields"])

    # A filter on a field must not make the page be parsed once more below it.
    return read.asNondeterministic()(html)
