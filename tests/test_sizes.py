"""Steps whose rows, shuffles or time must not grow faster than the input; each case failed, or took hours, before its step was mended."""

from __future__ import annotations

import random
import re
import time
from difflib import SequenceMatcher
from types import SimpleNamespace

import pytest

from pagewright import registry
from pagewright.functions import match
from pagewright.functions import text as T
from pagewright.operators import align, folds, layout
from pagewright.sources import derived as D


def shuffles(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


@pytest.mark.parametrize("name", ["row_texts"])
def test_lines_and_orders_are_dealt_once(spark, small, name):
    assert shuffles(registry.QUERIES[name](spark, small)) <= 2


@pytest.mark.parametrize("name", ["gap_segments", "grid_expand"])
def test_partitions_grow_with_the_files(spark, small, monkeypatch, name):
    pieces = []
    for piece in (1 << 14, 1 << 10):
        monkeypatch.setattr(D, "PIECE", piece)
        plan = registry.QUERIES[name](spark, small)._jdf.queryExecution().executedPlan().toString()
        pieces.append(int(re.search(r", (\d+)\), REPARTITION_BY_NUM", plan)[1]))
    assert pieces[1] > 8 * pieces[0] // 2


def test_a_page_of_two_branches_is_met_whole(spark, small):
    """With partitions that may be joined at run time, a page's regions were met without its lines: no text was filled up from them."""
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        got = registry.QUERIES["digital_anchoring"](spark, small).where("filled").count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got > 0


def test_matching_blocks_are_difflibs(monkeypatch):
    rng = random.Random(1)
    for wide in (match.WIDE, 0):
        monkeypatch.setattr(match, "WIDE", wide)
        for _ in range(300):
            letters = rng.choice(["ab", "abcdefghijkl가é😀"])
            a, b = ("".join(rng.choice(letters) for _ in range(rng.randint(0, 50))) for _ in range(2))
            b = rng.choice([b, a[::-1], a[20:] + b[:9] + a[:20]])
            want = [tuple(x) for x in SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks()]
            said = sum(x[2] for x in want)
            assert match.matching_blocks(a, b) == want
            assert [match.matched_from(a, b, n) for n in (said, said + 1)] == [said, 0] and match.reaches(a, b, said) and not match.reaches(a, b, said + 1)


def test_a_long_line_is_aligned_in_seconds():
    """The matcher looked at every pair of equal letters: a line of 60,000 against its reverse took minutes."""
    rng = random.Random(2)
    text = "".join(rng.choice("etaoinshr") for _ in range(60_000))
    rows = [SimpleNamespace(kind="region", pos=1, id="r", key=text, paragraph=False), SimpleNamespace(kind="node", pos=1, id="", key=text[::-1], paragraph=True)]
    began = time.process_time()
    assert align.follow(rows) == [(1, None, "no_region_text_match")]
    assert time.process_time() - began < 10


def test_a_garbled_node_goes_to_the_likest_region():
    """Regions that a node's text is not held by count only where they can be chosen; the choice is that of all scores."""
    keys = ["abcdefghij" * 5 + "x", "qwertyuiop" * 5, "abcdefghij" * 5]
    rows = [SimpleNamespace(kind="region", pos=k, id=f"r{k}", key=x, paragraph=False) for k, x in enumerate(keys)]
    nodes = [SimpleNamespace(kind="node", pos=k, id="", key=x, paragraph=False) for k, x in enumerate(["qwertyuiop" * 5, "abcdefghij" * 5, "abcdefghij" * 4 + "abcdefghiZ", "zzzz" * 9])]
    assert [x[1] for x in align.follow(rows + nodes)] == ["r1", "r2", "r2", None]


def test_page_texts_are_not_paired_with_lines(spark, small):
    """Each region's lines met each node's text of the page, and each node each page of the document."""
    for name in ("structure_corroboration", "page_repartition"):
        plan = registry.QUERIES[name](spark, small)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Join") <= (1 if name == "structure_corroboration" else 0), name


def test_a_page_that_holds_a_node_is_not_matched_against_others(monkeypatch):
    rows = [SimpleNamespace(rank=0, pos=k, key=x, declared=None) for k, x in ((1, "abcdef"), (2, "xabcdey"), (3, "qqqq"))]
    node = lambda pos, key: SimpleNamespace(rank=1, pos=pos, key=key, declared=9)
    assert align.best_pages([*rows, node(5, "abcdez"), node(6, ""), node(7, "abcdefqqqqqqq")]) == [(5, 1), (6, 3), (7, 2)]
    monkeypatch.setattr(align.T, "ratio_from", None)
    assert align.best_pages([*rows, node(5, "abcde")]) == [(5, 2)]


def test_plain_drops_all_but_digits_letters_and_hangul(spark):
    texts = ["".join(map(chr, (*range(0x0, 0x3000), 0xABFF, 0xAC00, 0xD7A3, 0xD7A4, 0xFFFD, 0x1F600, 0x10FFFF))), None]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(T.plain("t")).collect()]
    assert got == [re.sub("[^0-9a-zA-Z가-힣]", "", t or "").lower() for t in texts]


def test_words_of_a_page_are_dealt_once(spark, small):
    """Three folds, each dealt and sorted for itself, were joined."""
    plan = registry.QUERIES["row_cluster"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert shuffles(registry.QUERIES["row_cluster"](spark, small)) == 1 and "Join" not in plan


def test_rows_by_first_of_any_order():
    rng = random.Random(3)
    lines = [SimpleNamespace(i=k, y0=(y := rng.randint(0, 200)), y1=y + rng.randint(1, 40)) for k in range(120)]
    fits = lambda r, h: (min(r.y1, h.y1) - max(r.y0, h.y0)) / max(1, min(r.y1 - r.y0, h.y1 - h.y0)) >= 0.5
    for given in (lines, sorted(lines, key=lambda r: r.y0)):
        heads, want = [], []
        for r in given:
            k = next((k for k, h in enumerate(heads) if fits(r, h)), len(heads))
            heads += [r] * (k == len(heads))
            want.append((r.i, k))
        assert folds.rows_by_first(given) == want


def test_repeats_meet_a_page_text_once(spark):
    """The page's text was normalised for every line of it."""
    lines = spark.createDataFrame([(1, k, t) for k, t in enumerate(["Eight chars", "eight  CHARS", "short", "short", "twice, twice", "twice, twice"])] + [(2, 1, "x" * 9), (2, 2, "x" * 9)], "k int, pos int, text string")
    parser = spark.createDataFrame([(1, "eightchars short TWICE,twice twice,twice")], "k int, text string")
    got = layout.drop_adjacent_repeats(lines, parser, ("k",))
    assert sorted(map(tuple, got.collect())) == [(1, 0), (1, 2), (1, 3), (1, 4), (1, 5), (2, 1), (2, 2)]


def test_styles_are_counted_in_one_pass(spark, small):
    """A join for each of size, colour and font."""
    assert "Join" not in registry.QUERIES["line_styles"](spark, small)._jdf.queryExecution().executedPlan().toString()


def test_regions_do_not_meet_all_others_as_rows(spark, small):
    plan = registry.QUERIES["source_replacement"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in plan.split("\n") if "Join" in x and "Contains(" in x]
