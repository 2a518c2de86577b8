"""Selectors over HTML pages: XPath and CSS, read into the same tree of steps.

A page is a list of nodes in document order, each of which knows where its descendants end, so an
axis is a walk over that list and nothing recurses with a page's depth. A selector is compiled once
(``compiled``); what cannot be read raises ``SelectorError`` there, before any page is looked at.

Unclosed elements end with their parent; no element is added to a page.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from html.parser import HTMLParser
from typing import NamedTuple

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
SPACE = " \t\r\n\f"


class SelectorError(ValueError):
    """The selector cannot be read."""


class Node:
    """An element, or with an empty tag a text (``data``) or the page itself."""

    __slots__ = ("at", "attrs", "data", "end", "page", "parent", "places", "tag")

    def __init__(self, page: list[Node], tag: str, attrs: dict[str, str], parent: Node | None, data: str | None = None) -> None:
        self.page, self.tag, self.attrs, self.parent, self.data = page, tag, attrs, parent, data
        self.at = len(page)
        self.end = self.at + 1
        self.places: tuple[int, int, int, int] | None = None
        page.append(self)

    def text(self) -> str:
        return "".join(n.data for n in self.page[self.at : self.end] if n.data is not None)

    def within(self) -> list[Node]:
        return self.page[self.at + 1 : self.end]

    def children(self) -> Iterator[Node]:
        at = self.at + 1
        while at < self.end:
            yield self.page[at]
            at = self.page[at].end

    def after(self) -> Iterator[Node]:
        """Following siblings, nearest first."""
        at, end = self.end, self.parent.end if self.parent else self.end
        while at < end:
            yield self.page[at]
            at = self.page[at].end

    def before(self) -> list[Node]:
        """Preceding siblings, nearest first."""
        found = []
        for n in self.parent.children() if self.parent else ():
            if n is self:
                break
            found.append(n)
        return found[::-1]

    def place(self) -> tuple[int, int, int, int]:
        """Places from 1 among the sibling elements: of all and of those of its tag, from the front and from the back; found for all siblings at once."""
        if self.places is None:
            elements = [n for n in self.parent.children() if n.tag] if self.parent else [self]
            of_tag = Counter(n.tag for n in elements)
            seen: Counter = Counter()
            for i, n in enumerate(elements):
                seen[n.tag] += 1
                n.places = (i + 1, seen[n.tag], len(elements) - i, of_tag[n.tag] - seen[n.tag] + 1)
        return self.places

    def above(self) -> Iterator[Node]:
        node = self.parent
        while node is not None:
            yield node
            node = node.parent


class Attribute(NamedTuple):
    at: int
    value: str
    parent: Node

    def text(self) -> str:
        return self.value


class Tree(HTMLParser):
    """The nodes of a page; ``root`` is the page itself."""

    def __init__(self, html: str) -> None:
        super().__init__()
        self.page: list[Node] = []
        self.root = self.open = Node(self.page, "", {}, None)
        self.waiting: dict[str, int] = {}  # open elements by tag, so that a stray end tag costs nothing
        self.feed(html)
        self.close()
        while self.open is not None:
            self._ended()

    def _ended(self) -> None:
        self.open.end = len(self.page)
        self.waiting[self.open.tag] = self.waiting.get(self.open.tag, 1) - 1
        self.open = self.open.parent

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        node = Node(self.page, tag, {k: v or "" for k, v in attrs}, self.open)
        if tag not in VOID:
            self.open, self.waiting[tag] = node, self.waiting.get(tag, 0) + 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        Node(self.page, tag, {k: v or "" for k, v in attrs}, self.open)

    def handle_endtag(self, tag: str) -> None:
        if self.waiting.get(tag, 0) > 0:
            while self.open.tag != tag:
                self._ended()
            self._ended()

    def handle_data(self, data: str) -> None:
        Node(self.page, "", {}, self.open, data)


Item = Node | Attribute
#: What an expression gives: nodes, a text, a number or a truth value.
Value = list[Item] | str | float | bool
Expression = Callable[[Item, int, int], Value]


class Step(NamedTuple):
    axis: str
    test: Callable[[Item], bool]
    tests: tuple[tuple[Expression, bool], ...] = ()  # with whether the position matters


def is_element(n: Item) -> bool:
    return isinstance(n, Node) and bool(n.tag)


def is_text(n: Item) -> bool:
    return isinstance(n, Node) and n.data is not None


AXES: dict[str, Callable[[Node], Iterable[Item]]] = {
    "self": lambda n: (n,),
    "child": Node.children,
    "descendant": Node.within,
    "descendant-or-self": lambda n: n.page[n.at : n.end],
    "parent": lambda n: () if n.parent is None else (n.parent,),
    "ancestor": Node.above,
    "ancestor-or-self": lambda n: (n, *n.above()),
    "following-sibling": Node.after,
    "preceding-sibling": Node.before,
    "following": lambda n: n.page[n.end :],
    "next": lambda n: next(((s,) for s in n.after() if s.tag), ()),
}


def walked(start: list[Item], steps: Iterable[Step]) -> list[Item]:
    """The nodes that the steps lead to, each once, in document order."""
    now = start
    for axis, test, tests in steps:
        found: dict[tuple[int, str], Item] = {}
        reached, whole = 0, axis.startswith("descendant") and not any(positional for _, positional in tests)
        for base in now:
            if whole and isinstance(base, Node):
                if base.end <= reached:
                    continue  # its descendants have been walked over with those of a node around it
                reached = base.end
            if isinstance(base, Attribute):
                here = [base] if axis == "self" else [base.parent] if axis == "parent" else []
            elif axis.startswith("@"):
                names = base.attrs if axis == "@*" else (axis[1:],)
                here = [Attribute(base.at, base.attrs[a], base) for a in names if a in base.attrs]
            else:
                here = [n for n in AXES[axis](base) if test(n)]
            for condition, _ in tests:
                kept = []
                for i, n in enumerate(here, 1):
                    value = condition(n, i, len(here))
                    if value == i if isinstance(value, float) else truth(value):
                        kept.append(n)
                here = kept
            for n in here:
                found[n.at, n.value if isinstance(n, Attribute) else ""] = n
        now = [found[k] for k in sorted(found)] if len(now) > 1 or axis.startswith(("ancestor", "preceding")) else list(found.values())
    return now


def truth(value: Value) -> bool:
    return bool(value) if not isinstance(value, float) else value != 0 and value == value


def text_of(value: Value) -> str:
    """XPath's text of a value: of nodes that of the first."""
    if isinstance(value, list):
        return value[0].text() if value else ""
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, float):
        return str(int(value)) if value.is_integer() else str(value)
    return value


def number_of(value: Value) -> float:
    if isinstance(value, (bool, float)):
        return float(value)
    try:
        return float(text_of(value).strip(SPACE))
    except ValueError:
        return float("nan")


def compared(op: str, a: Value, b: Value) -> bool:
    """XPath's comparison: with nodes, true if it is for any of them."""
    if isinstance(a, list):
        return any(compared(op, n.text(), b) for n in a)
    if isinstance(b, list):
        return any(compared(op, a, n.text()) for n in b)
    if op in ("=", "!="):
        same = truth(a) == truth(b) if bool in (type(a), type(b)) else number_of(a) == number_of(b) if float in (type(a), type(b)) else a == b
        return same == (op == "=")
    x, y = number_of(a), number_of(b)
    return {"<": x < y, "<=": x <= y, ">": x > y, ">=": x >= y}[op]


FUNCTIONS: dict[str, Callable[..., Value]] = {
    "contains": lambda a, b: text_of(b) in text_of(a),
    "starts-with": lambda a, b: text_of(a).startswith(text_of(b)),
    "not": lambda a: not truth(a),
    "boolean": truth,
    "number": number_of,
    "string": text_of,
    "count": lambda a: float(len(a)),
    "concat": lambda *a: "".join(map(text_of, a)),
    "normalize-space": lambda a: " ".join(re.split(f"[{SPACE}]+", text_of(a).strip(SPACE))),
    "string-length": lambda a: float(len(text_of(a))),
    "substring-before": lambda a, b: text_of(a).partition(text_of(b))[0] if text_of(b) in text_of(a) else "",
    "substring-after": lambda a, b: text_of(a).partition(text_of(b))[2],
    "translate": lambda a, b, c: text_of(a).translate({ord(x): text_of(c)[i : i + 1] or None for i, x in reversed(list(enumerate(text_of(b))))}),
    "true": lambda: True,
    "false": lambda: False,
}
#: Functions that look at the node at hand if they are given nothing.
OF_CONTEXT = frozenset({"string", "number", "normalize-space", "string-length"})


class Reader:
    """A selector's tokens, read from left to right."""

    def __init__(self, text: str, tokens: str) -> None:
        self.source, self.tokens, at = text, [], 0
        pattern = re.compile(tokens)
        while at < len(text):
            m = pattern.match(text, at)
            if not m or m.end() == at:
                raise SelectorError(f"unreadable at {text[at:at + 20]!r} in {text!r}")
            if m.group().strip(SPACE) or m.lastgroup == "gap":
                self.tokens.append((m.lastgroup, m.group()))
            at = m.end()
        self.at = 0

    def peek(self, ahead: int = 0) -> tuple[str | None, str]:
        return self.tokens[self.at + ahead] if self.at + ahead < len(self.tokens) else (None, "")

    def take(self, *wanted: str) -> str | None:
        """The next token if it is one of these (any, if none is named)."""
        if self.at < len(self.tokens) and (not wanted or self.peek()[1] in wanted):
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def need(self, wanted: str) -> None:
        if self.take(wanted) is None:
            raise SelectorError(f"{wanted!r} expected before {self.peek()[1]!r} in {self.source!r}")


class XPath(Reader):
    """Unions, all location steps but namespaces, predicates, comparisons, and/or, and the functions above."""

    def __init__(self, text: str) -> None:
        super().__init__(text, r"(?P<text>'[^']*'|\"[^\"]*\")|(?P<number>\d+(?:\.\d+)?|\.\d+)|(?P<name>[A-Za-z_][\w-]*(?:\.[\w-]+)*)|(?P<sign>::|//|\.\.|!=|<=|>=|[/.@*|=<>()\[\],+-])|(?P<blank>\s+)")
        self.positional = False

    def whole(self) -> Expression:
        found = self.either()
        if self.at < len(self.tokens):
            raise SelectorError(f"{self.peek()[1]!r} not expected in {self.source!r}")
        return found

    def either(self) -> Expression:
        out = self.both()
        while self.take("or"):
            out = lambda n, i, k, a=out, b=self.both(): truth(a(n, i, k)) or truth(b(n, i, k))
        return out

    def both(self) -> Expression:
        out = self.comparison()
        while self.take("and"):
            out = lambda n, i, k, a=out, b=self.comparison(): truth(a(n, i, k)) and truth(b(n, i, k))
        return out

    def comparison(self) -> Expression:
        out = self.sum()
        while op := self.take("=", "!=", "<", "<=", ">", ">="):
            out = lambda n, i, k, a=out, b=self.sum(), op=op: compared(op, a(n, i, k), b(n, i, k))
        return out

    def sum(self) -> Expression:
        out = self.union()
        while op := self.take("+", "-"):
            sign = 1 if op == "+" else -1
            out = lambda n, i, k, a=out, b=self.union(), s=sign: number_of(a(n, i, k)) + s * number_of(b(n, i, k))
        return out

    def union(self) -> Expression:
        parts = [self.primary()]
        while self.take("|"):
            parts.append(self.primary())
        if len(parts) == 1:
            return parts[0]

        def all_of(n: Item, i: int, k: int) -> Value:
            found = [p(n, i, k) for p in parts]
            if not all(isinstance(f, list) for f in found):
                raise SelectorError(f"only nodes can be united: {self.source!r}")
            every = {(x.at, x.value if isinstance(x, Attribute) else ""): x for f in found for x in f}
            return [every[key] for key in sorted(every)]

        return all_of

    def primary(self) -> Expression:
        kind, token = self.peek()
        if kind == "text":
            self.take()
            return lambda n, i, k, v=token[1:-1]: v
        if kind == "number":
            self.take()
            self.positional = True
            return lambda n, i, k, v=float(token): v
        if token == "-":
            self.take()
            inner = self.primary()
            return lambda n, i, k: -number_of(inner(n, i, k))
        if token == "(":
            self.take()
            inner = self.either()
            self.need(")")
            return self.followed(inner)
        if kind == "name" and self.peek(1)[1] == "(" and token not in ("text", "node", "comment"):
            return self.call()
        return self.path()

    def call(self) -> Expression:
        name = self.take()
        self.need("(")
        given = []
        while not self.take(")"):
            if given:
                self.need(",")
            given.append(self.either())
        if name in ("position", "last"):
            self.positional = True
            return (lambda n, i, k: float(i)) if name == "position" else (lambda n, i, k: float(k))
        if name not in FUNCTIONS:
            raise SelectorError(f"function {name!r} is not known in {self.source!r}")
        f = FUNCTIONS[name]
        if not given and name in OF_CONTEXT:
            return lambda n, i, k: f([n])
        if name not in ("concat",) and len(given) != f.__code__.co_argcount:
            raise SelectorError(f"{name} takes {f.__code__.co_argcount} arguments in {self.source!r}")
        return lambda n, i, k: f(*[g(n, i, k) for g in given])

    def predicates(self) -> tuple[tuple[Expression, bool], ...]:
        out = []
        while self.take("["):
            before, self.positional = self.positional, False
            condition = self.either()
            self.need("]")
            out.append((condition, self.positional))
            self.positional = before
        return tuple(out)

    def followed(self, inner: Expression) -> Expression:
        """An expression in brackets, its predicates and the path after it."""
        tests, steps = self.predicates(), []
        while sign := self.take("/", "//"):
            steps += self.steps_after(sign)
        if not tests and not steps:
            return inner

        def of(n: Item, i: int, k: int) -> Value:
            found = inner(n, i, k)
            for condition, _ in tests:
                size = len(found)
                found = [x for j, x in enumerate(found, 1) if (value == j if isinstance(value := condition(x, j, size), float) else truth(value))]
            return walked(found, steps)

        return of

    def path(self) -> Expression:
        sign = self.take("/", "//")
        absolute, steps = sign is not None, []
        if sign == "//" or sign is None or self.peek()[1] not in ("", "|", ")", "]", ","):
            steps += self.steps_after(sign or "/")
        while sign := self.take("/", "//"):
            steps += self.steps_after(sign)
        steps = tuple(steps)
        if absolute:
            return lambda n, i, k: walked([(n.parent if isinstance(n, Attribute) else n).page[0]], steps)
        return lambda n, i, k: walked([n], steps)

    def steps_after(self, sign: str) -> list[Step]:
        step = self.step()
        if sign == "/":
            return [step]
        if step.axis == "child" and not any(positional for _, positional in step.tests):
            return [step._replace(axis="descendant")]
        return [Step("descendant-or-self", lambda n: True), step]

    def step(self) -> Step:
        if self.take("."):
            return Step("self", lambda n: True, self.predicates())
        if self.take(".."):
            return Step("parent", lambda n: True, self.predicates())
        axis = "child"
        if self.take("@"):
            axis = "attribute"
        elif self.peek(1)[1] == "::":
            axis = self.take()
            self.take("::")
            if axis not in AXES and axis != "attribute" or axis == "next":
                raise SelectorError(f"axis {axis!r} is not known in {self.source!r}")
        kind, token = self.peek()
        if token != "*" and kind != "name":
            raise SelectorError(f"a step expected before {token!r} in {self.source!r}")
        self.take()
        if axis == "attribute":
            return Step(f"@{token if token == '*' else token.lower()}", lambda n: True, self.predicates())
        if token in ("text", "node", "comment") and self.take("("):
            self.need(")")
            test = {"text": is_text, "node": lambda n: True, "comment": lambda n: False}[token]
        elif token == "*":
            test = is_element
        else:
            test = lambda n, t=token.lower(): n.tag == t
        return Step(axis, test, self.predicates())


def _formula(text: str) -> tuple[int, int]:
    """a and b of CSS's an+b."""
    text = {"odd": "2n+1", "even": "2n"}.get(text.strip().lower(), re.sub(r"\s", "", text.lower()))
    if m := re.fullmatch(r"([+-]?\d*)n([+-]\d+)?", text):
        return int(m[1] + "1") if m[1] in ("", "+", "-") else int(m[1]), int(m[2] or 0)
    if re.fullmatch(r"[+-]?\d+", text):
        return 0, int(text)
    raise SelectorError(f"{text!r} is no place among siblings")


def _place(of_type: bool, last: bool, a: int, b: int) -> Callable[[Node], bool]:
    def test(n: Node) -> bool:
        at = n.place()[of_type + 2 * last]
        return at == b if a == 0 else (at - b) % a == 0 and (at - b) // a >= 0

    return test


class Css(Reader):
    """Groups, the four combinators (one may come first), compounds of tag, class, id, attribute and the usual pseudo-classes, ``::text`` and ``::attr(name)``."""

    NAME = r"-?(?:[\w-]|[^\x00-\x7f]|\\.)+"

    def __init__(self, text: str) -> None:
        value = r"\"[^\"]*\"|'[^']*'|[^\]\s\"']+"
        super().__init__(text.strip(), rf"(?P<attr>\[\s*{self.NAME}\s*(?:[*^$~|]?=\s*(?:{value})\s*)?\])|(?P<element>::(?:text\b|attr\(\s*{self.NAME}\s*\)))|(?P<pseudo>:(?!:)[\w-]+(?:\((?:\"[^\"]*\"|'[^']*'|[^()\"']|\([^()]*\))*\))?)|(?P<hash>#{self.NAME})|(?P<dot>\.{self.NAME})|(?P<tag>\*|{self.NAME})|(?P<self>\.(?![\w-]))|(?P<gap>\s*[,>+~]\s*|\s+)")

    def whole(self) -> Expression:
        groups, ends = [], False
        while not ends:
            groups.append(self.group())
            ends = self.peek()[0] is None
            if not ends and self.take().strip(SPACE) != ",":
                raise SelectorError(f"a comma expected in {self.source!r}")

        def of(n: Item, i: int, k: int) -> Value:
            every = {(x.at, x.value if isinstance(x, Attribute) else ""): x for g in groups for x in walked([n], g)}
            return [every[key] for key in sorted(every)]

        return of

    def group(self) -> tuple[Step, ...]:
        steps, axis = [], "descendant"
        if self.peek()[0] == "gap" and self.peek()[1].strip(SPACE) in (">", "+", "~"):
            axis = self.combinator()
        while True:
            kind, token = self.peek()
            if kind == "self" and not steps:
                self.take()
                steps.append(Step("self", lambda n: True))
            elif kind != "element":
                steps.append(Step(axis, self.compound()))
            elif not steps:
                steps.append(Step("descendant-or-self", is_element))
            if self.peek()[0] == "element":
                token = self.take()
                steps.append(Step("child", is_text) if token == "::text" else Step("@" + token[7:-1].strip().lower(), lambda n: True))
                return tuple(steps)
            kind, token = self.peek()
            if kind is None or token.strip(SPACE) == ",":
                return tuple(steps)
            axis = self.combinator()

    def combinator(self) -> str:
        kind, token = self.peek()
        if kind != "gap" or token.strip(SPACE) == ",":
            raise SelectorError(f"{token!r} not expected in {self.source!r}")
        self.take()
        return {"": "descendant", ">": "child", "+": "next", "~": "following-sibling"}[token.strip(SPACE)]

    def compound(self) -> Callable[[Item], bool]:
        tests: list[Callable[[Node], bool]] = []
        while self.peek()[0] in ("tag", "hash", "dot", "attr", "pseudo") and not (tests and self.peek()[0] == "tag"):
            kind, token = self.peek()
            self.take()
            if kind == "tag":
                tests.append((lambda n: True) if token == "*" else lambda n, t=token.lower(): n.tag == t)
            elif kind == "hash":
                tests.append(lambda n, v=_plain(token[1:]): n.attrs.get("id") == v)
            elif kind == "dot":
                tests.append(lambda n, v=_plain(token[1:]): v in n.attrs.get("class", "").split())
            elif kind == "attr":
                tests.append(self.attribute(token[1:-1].strip()))
            else:
                tests.append(self.pseudo(token[1:]))
        if not tests:
            raise SelectorError(f"an element expected before {self.peek()[1]!r} in {self.source!r}")
        return lambda n: is_element(n) and all(t(n) for t in tests)

    def attribute(self, inside: str) -> Callable[[Node], bool]:
        name, op, value = re.fullmatch(r"(?s)([^=*^$~|\s]+)\s*(?:([*^$~|]?=)\s*(.*))?", inside).groups()
        name = name.lower()
        if not op:
            return lambda n: name in n.attrs
        value = value[1:-1] if value[:1] in "'\"" else value
        match = {
            "=": lambda v: v == value, "*=": lambda v: value != "" and value in v, "^=": lambda v: value != "" and v.startswith(value), "$=": lambda v: value != "" and v.endswith(value),
            "~=": lambda v: value in v.split(), "|=": lambda v: v == value or v.startswith(f"{value}-"),
        }[op]
        return lambda n: name in n.attrs and match(n.attrs[name])

    def pseudo(self, token: str) -> Callable[[Node], bool]:
        name, _, inside = token.partition("(")
        name, inside = name.lower(), inside[:-1]
        if m := re.fullmatch(r"nth-(last-)?(child|of-type)", name):
            return _place(m[2] == "of-type", bool(m[1]), *_formula(inside))
        if m := re.fullmatch(r"(first|last|only)-(child|of-type)", name):
            ends = [_place(m[2] == "of-type", last, 0, 1) for last in (False, True) if m[1] == "only" or (m[1] == "last") == last]
            return lambda n: all(e(n) for e in ends)
        if name in ("not", "is", "where"):
            inner = Css(inside)
            options = [inner.compound()]
            while inner.peek()[1].strip(SPACE) == ",":
                inner.take()
                options.append(inner.compound())
            if inner.peek()[0] is not None:
                raise SelectorError(f"only compounds can stand in {name}(): {self.source!r}")
            return (lambda n: not any(o(n) for o in options)) if name == "not" else lambda n: any(o(n) for o in options)
        if name in ("contains", "-soup-contains"):
            return lambda n, v=inside.strip().strip("'\""): v in n.text()
        if name == "has":
            inner = Css(inside).whole()
            return lambda n: bool(inner(n, 1, 1))
        if name == "empty":
            return lambda n: not any(c.tag or c.data for c in n.children())
        if name == "root":
            return lambda n: n.parent is not None and n.parent.parent is None
        raise SelectorError(f"pseudo-class {name!r} is not known in {self.source!r}")


def _plain(name: str) -> str:
    return re.sub(r"\\(.)", r"\1", name)


def is_xpath(selector: str) -> bool:
    """True for paths (from / or ./ or in brackets) and calls; else CSS is meant."""
    return bool(re.match(r"\s*(?:/|\.{1,2}/|\(|[a-z-]+\()", selector))


@lru_cache(4096)
def compiled(selector: str, method: str | None = None) -> Expression:
    """The selector as a function of a node; ``method`` is css, xpath or, if not stated, what it looks like."""
    if not selector.strip():
        raise SelectorError("the selector is empty")
    if method is None:
        method = "xpath" if is_xpath(selector) else "css"
    return (XPath if method == "xpath" else Css)(selector).whole()


def select(node: Node, selector: str, method: str | None = None) -> list[Item]:
    """The nodes or attributes that a selector names, in document order."""
    found = compiled(selector, method)(node, 1, 1)
    if not isinstance(found, list):
        raise SelectorError(f"{selector!r} gives no nodes")
    return found


def values(node: Node, selector: str, attribute: str | None = None, method: str | None = None) -> list[str]:
    """The stripped texts that a selector gives: of elements the text or the ``attribute`` named, of texts, attributes and calls their own."""
    found = compiled(selector, method)(node, 1, 1)
    if not isinstance(found, list):
        return [text_of(found).strip()]
    out = []
    for n in found:
        if attribute not in (None, "", "text") and is_element(n):
            if attribute in n.attrs:
                out.append(n.attrs[attribute])
        else:
            out.append(n.text().strip())
    return out
