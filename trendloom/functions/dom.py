"""A small tag tree for one page, built with the standard library parser."""

from __future__ import annotations

from html.parser import HTMLParser

VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT_TAGS = frozenset(("script", "style", "template", "!comment"))


class Element:
    __slots__ = ("name", "attrs", "parent", "children")

    def __init__(self, name: str, attrs: dict[str, str], parent: "Element | None"):
        self.name, self.attrs, self.parent = name, attrs, parent
        self.children: list[Element | str] = []

    def descendants(self):
        pending = list(reversed(self.children))
        while pending:
            node = pending.pop()
            yield node
            if isinstance(node, Element):
                pending.extend(reversed(node.children))

    def first(self, name: str | None) -> "Element | None":
        """First element below this one with the tag name."""
        return next((n for n in self.descendants() if isinstance(n, Element) and n.name == name), None)

    def enclosing(self, name: str) -> "Element | None":
        node = self.parent
        while node is not None and node.name != name:
            node = node.parent
        return node

    def text(self) -> str:
        """Text parts, each stripped, joined without a separator; script and style text left out."""
        parts: list[str] = []
        pending = list(reversed(self.children))
        while pending:
            node = pending.pop()
            if isinstance(node, str):
                parts.append(node.strip())
            elif node.name not in SILENT_TAGS:
                pending.extend(reversed(node.children))
        return "".join(parts)

    def has_class(self, wanted: str | None) -> bool:
        if wanted is None:
            return True
        value = self.attrs.get("class")
        return value is not None and (wanted in value.split() or wanted == value)


class _TreeBuilder(HTMLParser):
    """Keeps unclosed elements open until an outer end tag; ignores stray end tags."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Element("", {}, None)
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        values: dict[str, str] = {}
        for key, value in attrs:
            values[key] = value or ""
        element = Element(tag, values, self.open[-1])
        self.open[-1].children.append(element)
        if tag not in VOID_TAGS:
            self.open.append(element)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS:
            self.open.pop()

    def handle_endtag(self, tag):
        for depth in range(len(self.open) - 1, 0, -1):
            if self.open[depth].name == tag:
                del self.open[depth:]
                return

    def handle_comment(self, data):
        # Keeps the text before and after the comment apart.
        self.open[-1].children.append(Element("!comment", {}, self.open[-1]))

    def handle_data(self, data):
        # One run of text can arrive in pieces; they form one text node.
        children = self.open[-1].children
        if children and isinstance(children[-1], str):
            children[-1] += data
        else:
            children.append(data)


def parse_page(html: str) -> Element:
    builder = _TreeBuilder()
    builder.feed(html)
    builder.close()
    return builder.root
