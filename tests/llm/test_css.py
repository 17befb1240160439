"""Visible text under style rules: golden pages, and random trees against a
plain slow cascade."""

import random

import pytest

pytest.importorskip("pricewatch.llm")

from pricewatch.llm import css  # noqa: E402
from pricewatch.llm.html_text import page_text  # noqa: E402


@pytest.mark.parametrize("sheet,body,want", [
    ("@media print{.x{display:none}}", "<p class=x>a", "a"),
    ("@media screen{.x{display:none}}", "<p class=x>a", ""),
    ("@media (max-width: 600px){.x{display:none}} @media (min-width: 600px){.y{display:none}}",
     "<p class=x>a<p class=y>b", "a"),
    ("@media not print{.x{display:none}}", "<p class=x>a", ""),
    ("@media print{@media screen{.x{display:none}}} .y{display:none}", "<p class=x>a<p class=y>b", "a"),
    (".x{display:none}", "<p class=x style='display:block'>a", "a"),
    (".x{display:none!important}", "<p class=x style='display:block'>a", ""),
    (".x{display:none}.x{display:block}", "<p class=x>a", "a"),
    (".x{display:block}.x{display:none}", "<p class=x>a", ""),
    ("#i{display:block}.x{display:none}p{display:none}", "<p class=x id=i>a", "a"),
    (".a .b{display:none}", "<div class=a><i><p class=b>x</i></div><p class=b>y", "y"),
    (".a > .b{display:none}", "<div class=a><p class=b>x</p><div><p class=b>y</div></div>", "y"),
    (".x:hover{display:none} .x + .y{display:none} .x::before{display:none}", "<p class=x>a<p class=y>b", "a\n\nb"),
    (".x{display:nonsense;visibility:hidden}", "<p class=x>a<b style='visibility:visible'>c</b>", "c"),
    ("[hidden]{display:block}", "<p hidden>a", "a"),
    ("", "<p hidden>a<p>b", "b"),
    ("p[lang|=en]{display:none} [data-x$='ed']{display:none}", "<p lang=en-GB>a<p data-x=hidden>b<p data-x=red>c", "b"),
    ("/* .x{display:none} */ .y{display:none", "<p class=x>a<p class=y>b", "a"),
    ("@font-face{x:y} @import 'z'; .x,.y{display:none}", "<p class=x>a<p class=y>b<p>c", "c"),
])
def test_pages(sheet, body, want):
    assert page_text(f"<style>{sheet}</style>{body}") == want


def slow(tree, rules, above=(), seen=True):
    """Words that are seen, each node's style found by trying every rule on
    every chain of its ancestors."""
    tag, attrs, children, word = tree
    chain = (*above, tree)

    def fits(node, compound):
        return compound.fits(node[0], node[1], frozenset(node[1].get("class", "").split()))

    def matches(i, j, rule):
        if not fits(chain[i], rule.compounds[j]):
            return False
        if j == 0:
            return True
        return any(matches(k, j - 1, rule) for k in ([i - 1] if rule.child[j] else range(i)) if k >= 0)
    style = {}
    for rule in sorted(rules, key=lambda r: (r.specificity, r.order)):
        if matches(len(chain) - 1, len(rule.compounds) - 1, rule):
            for prop, value, _ in rule.found:
                style[prop] = value
    if style.get("display") == "none":
        return []
    seen = {"hidden": False, "visible": True}.get(style.get("visibility"), seen)
    return ([word] if seen else []) + [w for c in children for w in slow(c, rules, chain, seen)]


def test_random_trees():
    rng = random.Random(11)

    def grow(depth, words):
        word = f"w{len(words)}"
        words.append(word)
        return (rng.choice(["div", "section"]), {"class": " ".join(rng.sample("abcd", rng.randint(0, 2)))},
                [grow(depth - 1, words) for _ in range(rng.randint(0, 3))] if depth else [], word)

    def text(t):
        return f"<{t[0]} class='{t[1]['class']}'>{t[3]} {''.join(map(text, t[2]))}</{t[0]}>"

    for _ in range(120):
        tree = grow(4, [])
        sheet = " ".join(
            rng.choice(["", "div", "section"]) + rng.choice([".a", ".b", ".c", ".d"]) + "".join(
                rng.choice([" ", " > "]) + rng.choice([".a", ".b", "div", "section.c"])
                for _ in range(rng.randint(0, 2)))
            + "{" + rng.choice(["display:none", "display:block", "visibility:hidden", "visibility:visible"]) + "}"
            for _ in range(rng.randint(1, 8)))
        assert page_text(f"<style>{sheet}</style>{text(tree)}").split() == slow(tree, css.rules([sheet])), sheet


def test_deep_and_many():
    page = "<style>.a .b{display:none} .a .a .c{display:none}</style>" + "<div class=a>" * 20_000 + "<p class=b>x<p>y"
    assert page_text(page) == "y"
