"""Rules with Hangul and odd characters, which the synthetic data lack; sources and the streaming front."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from pagewright.functions import text as T
from pagewright.operators import assign
from pagewright.operators import labels as L
from pagewright.operators import reading
from pagewright.operators import templates as M
from pagewright.sources import files
from pagewright.streaming import front


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return row.select(column.alias("x")).first()["x"]


def test_normal_forms(spark):
    assert one(spark, T.no_space_lower("t"), t="A b　 C") == "abc"
    assert one(spark, T.plain("t"), t="가-A_1 ß") == "가a1"
    assert one(spark, T.nfkc_alnum(F.col("t")), t="ﬁ①가 ß") == "fi1가ss"
    assert one(spark, T.nullable(F.col("t")), t="  ") is None


def test_digital_share_counts_folded_characters(spark):
    lines = [(1, 1, "r", 0, 0, 0, "ß ß", "digital"), (1, 1, "r", 1, 0, 1, "a b", "ocr")]
    owned = spark.createDataFrame(lines, "doc_id long, page_no long, region_id string, y0 long, x0 long, i long, text string, source string")
    assert assign.assembled(owned).first()["digital_share"] == pytest.approx(4 / 6)


def test_quotes(spark):
    assert one(spark, L.quoted(F.col("q"), F.col("s")), q="심의필 2026-0000(2026.0…", s="준법감시인 | 심의필 2026-0000(2026.01.02)")
    assert not one(spark, L.quoted(F.col("q"), F.col("s")), q="a.b", s="a:b")
    assert one(spark, L.quoted(F.col("q"), F.col("s")), q="abc.def", s="abc:def")


def test_headings_begin_lines(spark):
    lines = spark.createDataFrame([(1, "• 대출한도: 1억"), (2, "이 대출기간은 다릅니다"), (3, "대출기간"), (4, "예금자보호법에 따라 보호"), (5, "대출한도 또")], "pos int, text string").withColumns({"k": F.lit(1), "allowed": F.array(*[F.lit(x) for x in L.ALIASES])})
    found = {r["label"]: (r["quote"], r["place"]) for r in L.headings(lines, ("k",)).collect()}
    assert found == {"대출한도": ("• 대출한도: 1억", 1), "대출기간": ("대출기간", 2), "예금자보호": ("예금자보호법에 따라 보호", 3)}


def test_review_numbers(spark):
    for text in ("준법감시인 심의필 2026-0000", "심의번호 2026-****", "2026-0000(심의일 : 2026. 00. 00.)"):
        assert one(spark, L.review_number(F.col("t")), t=f"앞말 {text} 뒷말")
    assert one(spark, L.review_number(F.col("t")), t="전화 02-1234") is None


def test_deposit_rules_need_one_hint(spark):
    rule = M.rule_template(F.col("g"), F.col("s"), F.col("t"))
    assert one(spark, rule, g="예금성", s=None, t="자유 적금") == "예금성상품-적립식"
    assert one(spark, rule, g="예금성", s=None, t="적금과 정기예금") is None
    assert one(spark, rule, g="투자성", s=None, t="ISA 신탁형 일임형") == "투자성상품-개인종합자산관리계좌(ISA) 일반"
    assert one(spark, M.first_group(F.col("t"), M.NAME_WORDS), t="4. 카드 적금.pdf") == "카드"


def test_common_labels_are_in_all_templates(spark):
    items = spark.createDataFrame(M.catalog_rows(), "template_id string, template_pos int, product_group string, label_pos int, label string")
    assert items.select("template_id").distinct().count() == 19
    assert [r["label"] for r in M.common_labels(items).orderBy("pos").collect()] == list(M.EVERY_LABEL)


def test_private_glyphs_give_way_to_what_structure_and_reading_say(spark):
    row = [(" 동의", "digital_lines", True, "동의", None, "☑ 동의", None, None)]
    df = spark.createDataFrame(row, "text string, text_source string, structure_agrees boolean, structure_text string, digital_share double, reader_text string, judge_text string, judge_confidence double")
    found = reading.apply_reading(df).first()
    assert (found["reading_status"], found["final_text"], found["final_source"]) == ("vlm_glyph_verified_by_hwp_structure", "☑ 동의", "vlm_structure_verified")


def test_catalog_is_checked(spark, tmp_path):
    item = {"label": "a", "example": "x"}
    good = {"version": "template-catalog-v1", "templates": [{"template_id": "t", "product_group": "g", "items": [item]}]}
    (tmp_path / "good.json").write_text(json.dumps(good))
    assert files.catalog(spark, str(tmp_path / "good.json")).count() == 1
    good["templates"][0]["items"].append(item)
    (tmp_path / "twice.json").write_text(json.dumps(good))
    with pytest.raises(ValueError):
        files.catalog(spark, str(tmp_path / "twice.json"))


def test_inputs_are_listed_by_suffix(spark, tmp_path):
    for name in ("b.PDF", "a.png", "c.txt", "skip_me.jpg"):
        (tmp_path / name).write_bytes(b"x")
    found = files.list_inputs(spark, str(tmp_path), "skip").orderBy("name").collect()
    assert [(r["name"], r["kind"]) for r in found] == [("a.png", "image"), ("b.PDF", "pdf")]


def test_saved_boxes_are_read(spark, tmp_path):
    (tmp_path / "p1.json").write_text(json.dumps({"doc_id": 1, "page_no": 1, "blocks": [{"block_id": "b", "bbox": [1, 2, 3, 4]}], "lines": []}))
    assert files.saved_boxes(spark, str(tmp_path)).select(F.element_at("blocks", 1)["bbox"][3].alias("y1")).first()["y1"] == 4


def test_stream_equals_batch(spark, tmp_path, small):
    from pagewright.operators import assign
    from pagewright.sources import derived as D

    lines = D.lines(spark, small).where("doc_id < 12").select(*[f.split()[0] for f in front.LINES.split(", ")])
    lines.where("doc_id < 6").coalesce(1).write.parquet(str(tmp_path / "in/a"))
    lines.where("doc_id >= 6").coalesce(1).write.parquet(str(tmp_path / "in/b"))
    work = lambda df: assign.with_owner(df, D.regions(df)).select("doc_id", "page_no", "i", "region_id")
    front.run_batches(front.line_stream(spark, str(tmp_path / "in/*"), 1), work, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    ours = spark.read.parquet(str(tmp_path / "out")).select("doc_id", "page_no", "i", "region_id")
    assert sorted(map(tuple, ours.collect()), key=str) == sorted(map(tuple, work(lines).collect()), key=str)
