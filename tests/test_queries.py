"""Every query against the second engine, or at least run; the entry point; independence of input order."""

from __future__ import annotations

import re
from difflib import SequenceMatcher

import pytest
from oracle import engine, same_rows
from pyspark.sql import functions as F

from pagewright import registry
from pagewright.operators import assign
from pagewright.sources import derived as D


@pytest.fixture(scope="module")
def con(small):
    return engine(small)


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_matches_sql(spark, small, con, name):
    same_rows(registry.QUERIES[name](spark, small), con, registry.ORACLE_SQL[name])


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE_SQL)))
def test_query_runs(spark, small, name):
    assert registry.QUERIES[name](spark, small).count() > 0


def test_entry(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.columns == ["doc_id", "page_no", "i", "region_id", "overlap"] and df.count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_assignment_is_independent_of_input_order(spark, small):
    lines = D.lines(spark, small).where("doc_id < 20")
    one = {tuple(r) for r in assign.with_owner(lines, D.regions(lines)).select("doc_id", "page_no", "i", "region_id").collect()}
    mixed = lines.orderBy(F.rand(1)).repartition(7)
    assert {tuple(r) for r in assign.with_owner(mixed, D.regions(mixed)).select("doc_id", "page_no", "i", "region_id").collect()} == one


def test_lines_are_owned_exactly_once(spark, small):
    lines = D.lines(spark, small)
    owned = assign.with_owner(lines, D.regions(lines))
    assert owned.count() == lines.count() == owned.select("doc_id", "page_no", "i").distinct().count()


def test_page_joins_are_hash_or_sort_joins_not_nested_loops(spark, small):
    lines = D.lines(spark, small)
    plan = assign.with_owner(lines, D.regions(lines))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_every_word_is_in_a_row(spark, small):
    words = D.lines(spark, small).select(F.explode(F.split("text", " ")))
    found = registry.QUERIES["row_cluster"](spark, small)
    assert found.count() == words.count() == found.select("doc_id", "page_no", "i").distinct().count()


def test_every_line_is_placed_on_a_page(spark, small):
    lines = D.lines(spark, small)
    found = registry.QUERIES["page_repartition"](spark, small)
    assert found.select("doc_id", "pos").exceptAll(lines.select("doc_id", "i")).count() == 0 and found.count() == lines.count()


def test_supplements_see_whole_tables(spark, tmp_path):
    spark.createDataFrame([(1, "a" * 60 + "b" * 240)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = registry.QUERIES["visual_supplements"](spark, str(tmp_path)).collect()
    assert [(r["block_id"], r["action"]) for r in got] == [("v0", "duplicate_dropped")]


def test_source_replacement_against_difflib(spark, small):
    """What the query says of each region, from its regions, lines and owners alone, scored by difflib."""
    plain = lambda t: re.sub("[^0-9a-zA-Z가-힣]", "", t or "").lower()
    lines = D.lines(spark, small)
    regions = D.regions(lines)
    evidence, texts = {}, {}
    for r in sorted(assign.with_owner(lines, regions).where("region_id is not null and i % 8 <> 6").collect(), key=lambda r: r["i"]):
        evidence.setdefault((r["doc_id"], r["page_no"], r["region_id"]), {}).setdefault(plain(r["text"]), r["text"].strip(" "))
    for r in regions.collect():
        said = r["content"].replace(" ", "  ") if r["seq"] % 3 == 0 else r["content"][:25] if r["seq"] % 5 == 0 else r["content"]
        texts[r["doc_id"], r["page_no"], r["region_id"]] = (said, "document_processor" if r["seq"] % 2 == 0 else "block_content")
    want = {}
    for k, (said, source) in texts.items():
        if k not in evidence:
            want[k] = (None, said, source)
            continue
        told = "\n".join(evidence[k].values())
        a, b = plain(told), plain(said)
        score = 0.0 if not a or not b else 1.0 if a in b or b in a else SequenceMatcher(None, a, b, autojunk=False).ratio()
        agrees = score >= 0.8 and min(len(a), len(b)) / max(1, len(a), len(b)) >= 0.7
        foreign = any(o[:2] == k[:2] and o != k and len(plain(t)) >= 6 and plain(t) in a and plain(t) not in b for o, (t, _) in texts.items())
        differs = a != b or (source == "block_content" and " ".join(said.split()) != " ".join(told.split()))
        takes = agrees and not foreign and differs
        want[k] = ("agrees" if agrees else "partial", told if takes else said, "hwp_structure" if takes else source)
    got = {tuple(r[:3]): tuple(r[3:]) for r in registry.QUERIES["source_replacement"](spark, small).collect()}
    assert got == want and {v[0] for v in got.values()} == {None, "agrees", "partial"}
