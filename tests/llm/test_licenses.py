"""License scans: markup, odd rows, and a brute-force matcher."""

import random

import pytest

pytest.importorskip("pricewatch.llm")

from pricewatch.llm import licenses as li  # noqa: E402
from pricewatch.llm.ship import ship  # noqa: E402


def spans(tree, words, i):
    """Ends of the wording from word ``i`` on, by plain recursion."""
    if not tree:
        return {i}
    x, rest = tree[0], tree[1:]
    if isinstance(x, str):
        return spans(rest, words, i + 1) if i < len(words) and words[i] == x else set()
    if isinstance(x, tuple):
        return set().union(*[spans(rest, words, i + n) for n in range(x[0], x[1] + 1) if i + n <= len(words)])
    return spans(rest, words, i) | set().union(*[spans(rest, words, j) for j in spans(x, words, i)])


def test_automata_match_brute_force(spark):
    ship(spark)
    templates = [li.Template("a", "x y [x [y] {v 0..2}] z"), li.Template("b", "y {v 1..2} x [z]"),
                 li.Template("c", "x [[y] z] [x] y"), li.Template("d", "z z", True), li.Template("e", "y [] {w 0..0} z")]
    rng = random.Random(5)
    texts = [" ".join(rng.choices("xyzw", k=rng.randint(0, 14))) for _ in range(600)]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in li.scan(d, templates).collect():
        words = li.plain_words(r.text)
        want = {t.label for t in templates
                if any(spans(li.parse(t.wording), words, i) for i in range(len(words)))}
        assert {p.label for p in r._license.places} == want
        assert [p.start for p in r._license.places if p.base] == [
            i for i in range(len(words) - 1) if words[i:i + 2] == ["z", "z"]]
        for p in r._license.places:
            tree = li.parse(next(t.wording for t in templates if t.label == p.label))
            assert p.end in spans(tree, words, p.start)


def test_licenses_in_texts(spark):
    ship(spark)
    full = {t.label: t.wording for t in li.TEMPLATES}
    mit = full["mit"].replace("{work 1..12}", "this software and associated documentation files")
    rows = [(1, "Released UNDER the MIT License. Under the mit license!"), (2, None), (3, ""), (4, " . "),
            (5, mit.replace("[", "").replace("]", "")), (6, mit.replace("fully", "x").replace("sublicense", "lend")),
            (7, "Licensed under CC BY-NC 4.0"), (7, "Licensed under CC BY-NC 4.0"),
            (8, "word " * 50_000 + "GNU General Public License, version 3"), (None, "cc by nc")]
    d = spark.createDataFrame([(*r, "mine") for r in rows], "doc_id long, text string, _license string")
    out = li.scan(d)
    assert out.columns == ["doc_id", "text", "_license", "_license_"]
    got = {}
    for r in out.collect():
        got.setdefault(r.doc_id, []).append(r._license_)
    assert [(p.label, p.start, p.end, p.base) for p in got[1][0].places] == [("mit", 1, 5, True), ("mit", 5, 9, True)]
    assert all(got[i][0].n_words == 0 and not got[i][0].places and got[i][0].score == 0 for i in (2, 3, 4))
    assert [p.label for p in got[5][0].places] == ["mit"] and got[5][0].score > 0.9 and not got[6][0].places
    assert len(got[7]) == 2 and [p.label for p in got[7][0].places] == ["cc-by-nc", "cc-by-nc-4.0"]
    assert [(p.label, p.start) for p in got[8][0].places] == [("gpl-3.0", 50_000)]
    assert [p.label for p in got[None][0].places] == ["cc-by-nc"]
    assert li.scan(d.where("doc_id = 99")).count() == 0 and li.scan(d, []).count() == len(rows)


@pytest.mark.parametrize("bad", ["[a", "a]", "a {b}", "[a] b", "{v 1..2} a", "a { b"])
def test_bad_markup(bad):
    with pytest.raises(ValueError):
        li.Automata([li.Template("x", bad)])
