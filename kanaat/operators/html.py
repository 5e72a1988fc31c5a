"""A small reader for fetched pages: elements, attributes and text, selected by short CSS selectors.

Closing tags close the nearest open element of that name; elements never closed end with the page.
Scripts, styles and comments hold no text. One compiled pattern finds the tags, which is what makes
whole pages cheap to read inside a task."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
TAG = re.compile(
    r"<!--.*?(?:-->|$)|<(script|style|template)\b[^>]*>.*?(?:</\1\s*>|$)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
STEP = re.compile(r"([a-zA-Z][\w-]*)?((?:\.[\w-]+|\[[^\]]*\])*)$")
CONDITION = re.compile(r"\.([\w-]+)|\[([\w-]+)(?:([*^$]?=)[\"']?([^\"'\]]*)[\"']?)?\]")


class Element:
    __slots__ = ("name", "attributes", "parent", "first_piece", "last_piece", "order", "after")

    def __init__(self, name, attributes, parent, first_piece, order):
        self.name, self.parent, self.first_piece, self.order = name, parent, first_piece, order
        self.attributes, self.last_piece = attributes, None
        self.after = order + 1  # the element and what it holds are elements[order:after]

    def get(self, name: str) -> str | None:
        if isinstance(self.attributes, str):
            self.attributes = {
                m[1].lower(): unescape(next((g for g in m.groups()[1:] if g is not None), ""))
                for m in ATTRIBUTE.finditer(self.attributes)
            }
        return self.attributes.get(name)


class Page:
    def __init__(self, html: str):
        self.elements: list[Element] = []
        self.pieces: list[str] = []
        parent, end = None, 0
        for tag in TAG.finditer(html or ""):
            if tag.start() > end:
                self.pieces.append(html[end : tag.start()])
            end = tag.end()
            name = (tag[3] or "").lower()
            if not name:
                continue
            if tag[2]:
                parent = self._close(parent, name)
                continue
            element = Element(name, tag[4], parent, len(self.pieces), len(self.elements))
            self.elements.append(element)
            if name in VOID or tag[4].endswith("/"):
                element.last_piece = len(self.pieces)
            else:
                parent = element
        if html and end < len(html):
            self.pieces.append(html[end:])
        for element in self.elements:
            if element.last_piece is None:
                element.last_piece, element.after = len(self.pieces), len(self.elements)

    def _close(self, parent, name):
        target = parent
        while target is not None and target.name != name:
            target = target.parent
        if target is None:
            return parent
        while parent is not target.parent:
            parent.last_piece, parent.after = len(self.pieces), len(self.elements)
            parent = parent.parent
        return parent

    def text(self, element: Element) -> str:
        return unescape("".join(self.pieces[element.first_piece : element.last_piece])).strip()

    def select(self, selector: str, within: Element | None = None) -> list[Element]:
        """Elements matching a selector of names, .class, [attr], [attr=v], [attr*=v], [attr^=v], [attr$=v],
        with blanks for descendants, in page order."""
        return list(self.matches(selector, within))

    def matches(self, selector: str, within: Element | None = None) -> Iterator[Element]:
        """The same one by one. What an element holds follows it in page order, so only that is looked at."""
        steps = [_step(part) for part in selector.split()]
        held = self.elements if within is None else self.elements[within.order : within.after]
        return (e for e in held if _matches(e, steps[-1]) and _led_by(e, steps[:-1]))


def _step(part: str):
    name, conditions = STEP.match(part).groups()
    return (name.lower() if name else None), [m.groups() for m in CONDITION.finditer(conditions or "")]


def _matches(element: Element, step) -> bool:
    name, conditions = step
    if name and element.name != name:
        return False
    for cls, attribute, operation, value in conditions:
        given = element.get("class" if cls else attribute)
        if given is None:
            return False
        if cls:
            if cls not in given.split():
                return False
        elif operation == "=" and given != value:
            return False
        elif operation == "*=" and value not in given:
            return False
        elif operation == "^=" and not given.startswith(value):
            return False
        elif operation == "$=" and not given.endswith(value):
            return False
    return True


def _led_by(element: Element, steps) -> bool:
    above = element.parent
    for step in reversed(steps):
        while above is not None and not _matches(above, step):
            above = above.parent
        if above is None:
            return False
        above = above.parent
    return True

