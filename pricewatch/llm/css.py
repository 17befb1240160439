"""The part of CSS that decides whether text is seen: ``display`` and
``visibility`` through a small cascade.

Known are type, class, id and attribute selectors, descendant and child
combinators, selector lists, media and supports blocks, specificity, source
order and ``!important``. A rule with a selector that isn't known here (states
such as ``:hover``, siblings, pseudo-elements) is left out, so what it would
hide stays. Media blocks hold for a screen of ``SCREEN`` pixels; a condition
that isn't about media type or width doesn't hold.

Selectors are matched from the left while the tree is walked down: a node takes
from its parent the places in selectors that wait for a descendant or a child,
so a node costs its own matches and what waits, however deep it is.
"""

from __future__ import annotations

import re
from typing import NamedTuple

SCREEN = 1280               # pixels wide
EM = 16                     # pixels
# What ``display`` and ``visibility`` can be; others are no declarations.
DISPLAY = frozenset("none block inline inline-block flex inline-flex grid inline-grid table inline-table table-row "
                    "table-cell table-caption table-column table-column-group table-row-group table-header-group "
                    "table-footer-group list-item contents flow-root run-in ruby initial inherit unset revert".split())
VISIBILITY = frozenset("visible hidden collapse initial inherit unset revert".split())

_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
_PART = re.compile(r"""\s*([>+~])\s*|(\s+)|([a-zA-Z][\w-]*|\*)|\#([\w-]+)|\.([\w-]+)
                       |\[\s*([\w-]+)\s*(?:([~|^$*]?=)\s*(?:"([^"]*)"|'([^']*)'|([\w-]+))\s*)?\]""", re.X)
_DECLARATION = re.compile(r"\s*(display|visibility)\s*:\s*([\w-]+)\s*(!\s*important)?\s*", re.I)
_WIDTH = re.compile(r"\(\s*(min|max)-(?:device-)?width\s*:\s*([\d.]+)(px|em|rem)\s*\)", re.I)


class Compound(NamedTuple):
    tag: str
    ids: frozenset
    classes: frozenset
    attrs: tuple

    def fits(self, tag: str, attrs: dict, classes: frozenset) -> bool:
        return ((not self.tag or self.tag == tag) and self.classes <= classes
                and (not self.ids or self.ids == {attrs.get("id")})
                and all(_has(attrs, *a) for a in self.attrs))


def _has(attrs: dict, name: str, how: str, value: str) -> bool:
    own = attrs.get(name)
    if own is None or not how:
        return own is not None
    if how == "=":
        return own == value
    if not value:
        return False
    return {"~=": value in own.split(), "|=": own == value or own.startswith(value + "-"), "^=": own.startswith(value),
            "$=": own.endswith(value), "*=": value in own}[how]


class Rule(NamedTuple):
    compounds: list[Compound]
    child: list[bool]           # whether a compound is a child of the one before, else any descendant
    specificity: tuple[int, int, int]
    order: int
    found: list[tuple[str, str, bool]]


def selector(text: str) -> tuple[list[Compound], list[bool], tuple[int, int, int]] | None:
    """Compounds, their combinators and the specificity; None if not known."""
    compounds, child, at = [], [False], 0
    now = ["", set(), set(), []]
    some = False
    text = text.strip()
    weight = [0, 0, 0]
    while at < len(text):
        m = _PART.match(text, at)
        if not m or m[1] in ("+", "~"):
            return None
        at = m.end()
        if m[1] or m[2]:
            if not some:
                return None
            compounds.append(Compound(now[0], frozenset(now[1]), frozenset(now[2]), tuple(now[3])))
            child.append(m[1] == ">")
            now, some = ["", set(), set(), []], False
            continue
        if m[3]:
            if some:
                return None
            if m[3] != "*":
                now[0] = m[3].lower()
                weight[2] += 1
        elif m[4]:
            now[1].add(m[4])
            weight[0] += 1
        elif m[5]:
            now[2].add(m[5])
            weight[1] += 1
        else:
            now[3].append((m[6].lower(), m[7] or "", next((g for g in m.groups()[7:] if g is not None), "")))
            weight[1] += 1
        some = True
    if not some:
        return None
    compounds.append(Compound(now[0], frozenset(now[1]), frozenset(now[2]), tuple(now[3])))
    return compounds, child, tuple(weight)


def declarations(text: str) -> list[tuple[str, str, bool]]:
    """(property, value, important) of what is known, in order."""
    out = []
    for part in text.split(";"):
        m = _DECLARATION.fullmatch(part)
        if m and m[2].lower() in (DISPLAY if m[1].lower() == "display" else VISIBILITY):
            out.append((m[1].lower(), m[2].lower(), bool(m[3])))
    return out


def media_holds(query: str) -> bool:
    """Whether a media query list holds for the screen."""
    return any(_holds(q.strip().lower()) for q in query.split(","))


def _holds(query: str) -> bool:
    turned = query.startswith("not ")
    words = [w.strip() for w in re.split(r"\band\b", query[4:] if turned else query.removeprefix("only "))]
    good = True
    for w in words:
        m = _WIDTH.fullmatch(w)
        if m:
            size = float(m[2]) * (1 if m[3].lower() == "px" else EM)
            good &= SCREEN >= size if m[1].lower() == "min" else SCREEN <= size
        else:
            good &= w in ("", "all", "screen")
    return good != turned


def rules(sheets: list[str]) -> list[Rule]:
    """The rules of the sheets that hold, in source order."""
    out: list[Rule] = []
    for sheet in sheets:
        text = _COMMENT.sub(" ", sheet)
        at, skip = 0, []            # of each open block: whether its rules are left out
        while at < len(text):
            stop = re.compile(r"[{};]").search(text, at)
            if not stop:
                break
            head, at = text[at:stop.start()].strip(), stop.end()
            if stop[0] == ";":
                continue
            if stop[0] == "}":
                if skip:
                    skip.pop()
                continue
            if head.startswith("@"):
                name, _, rest = head[1:].partition(" ")
                name = name.split("(")[0].lower()
                if name == "media":
                    skip.append(not media_holds(rest))
                else:
                    skip.append(name not in ("supports", "layer", "container"))
                continue
            end = text.find("}", at)
            body, at = (text[at:], len(text)) if end < 0 else (text[at:end], end + 1)
            found = [] if any(skip) else declarations(body)
            if found:
                for one in head.split(","):
                    known = selector(one)
                    if known:
                        out.append(Rule(*known, len(out), found))
    return out


class Styles:
    """The cascade of a page. ``of`` gives a node's own display and visibility
    and what its children take."""

    def __init__(self, sheets: list[str]):
        self.rules = rules(sheets)
        self.by: dict[tuple[str, str], list[int]] = {}      # rules by what their first compound asks for
        for i, r in enumerate(self.rules):
            c = r.compounds[0]
            key = ("id", min(c.ids)) if c.ids else ("class", min(c.classes)) if c.classes else ("tag", c.tag)
            self.by.setdefault(key, []).append(i)

    def begin(self) -> tuple[frozenset, frozenset]:
        return frozenset(), frozenset()

    def of(self, tag: str, attrs: dict, above: tuple[frozenset, frozenset]):
        below, child = above
        best: dict[str, tuple] = {}
        if "hidden" in attrs and attrs["hidden"].lower() != "until-found" or tag == "dialog" and "open" not in attrs:
            best["display"] = ((False, False, (-1,), -1), "none")

        def put(prop, value, rank):
            if prop not in best or best[prop][0] <= rank:
                best[prop] = (rank, value)

        if self.rules:
            classes = frozenset(attrs.get("class", "").split())
            keys = [("tag", ""), ("tag", tag), *(("class", c) for c in classes)]
            if "id" in attrs:
                keys.append(("id", attrs["id"]))
            waiting = {(i, 0) for k in keys for i in self.by.get(k, ())} | below | child
            more, next_child = set(), set()
            for i, j in waiting:
                rule = self.rules[i]
                if not rule.compounds[j].fits(tag, attrs, classes):
                    continue
                if j + 1 < len(rule.compounds):
                    (next_child if rule.child[j + 1] else more).add((i, j + 1))
                else:
                    for n, (prop, value, important) in enumerate(rule.found):
                        put(prop, value, (important, False, rule.specificity, (rule.order, n)))
            below, child = below | more if more - below else below, frozenset(next_child)
        for n, (prop, value, important) in enumerate(declarations(attrs["style"])) if attrs.get("style") else ():
            put(prop, value, (important, True, (), (0, n)))
        return {k: v for k, (_, v) in best.items()}, (below, child)
