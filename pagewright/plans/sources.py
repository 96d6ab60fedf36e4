"""Queries on sources: service answers, rendered rows, affine forms, page fills, windows of events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import derived as D
from ..sources import files
from ..streaming import front


def _answers(spark: SparkSession, folder: str) -> DataFrame:
    """Each page's lines and blocks as a service would answer: halves in coordinates, some entries with three of them."""
    lines = D.lines(spark, folder)
    box = lambda n: F.when(n % 10 == 9, F.array(F.col("x0") + 0.5, F.col("y0").cast("double"), F.col("x1").cast("double"))).otherwise(F.array(F.col("x0") + 0.5, F.col("y0") + 1.5, F.col("x1").cast("double"), F.col("y1") + 0.25))
    l = lines.groupBy(*D.PAGE).agg(F.array_sort(F.collect_list(F.struct("i", "text", (F.col("i") % 7 / 10.0).alias("score"), box(F.col("i")).alias("bbox")))).alias("lines"))
    r = D.regions(lines).groupBy(*D.PAGE).agg(F.array_sort(F.collect_list(F.struct("seq", "label", F.col("seq").alias("ord"), box(F.col("seq")).alias("bbox"), "content"))).alias("blocks"))
    return l.join(r, list(D.PAGE)).select(*D.PAGE, F.to_json(F.struct("blocks", "lines")).alias("answer"))


def layout_answer_blocks(spark: SparkSession, folder: str) -> DataFrame:
    return files.layout_answers(_answers(spark, folder))[0]


def layout_answer_lines(spark: SparkSession, folder: str) -> DataFrame:
    return files.layout_answers(_answers(spark, folder))[1].select("doc_id", "page_no", "idx", "text", "score", "x0", "y0", "x1", "y1")


def dom_row_blocks(spark: SparkSession, folder: str) -> DataFrame:
    rows = D.lines(spark, folder).select("doc_id", "page_no", F.expr("i div 4").alias("row_no"), "i", (F.col("x0") + (F.col("i") % 4) * 300).alias("x0"), "y0", (F.col("x1") + (F.col("i") % 4) * 300).alias("x1"), "y1", F.lit(1000).alias("canvas_w"), F.lit(900).alias("canvas_h"))
    return files.dom_blocks(rows, F.lit(0.75)).select("doc_id", "page_no", "i", "col", "x0", "y0", "x1", "y1")


def form_boxes(spark: SparkSession, folder: str) -> DataFrame:
    """Boxes within two nested forms: a shift in a scale, turned by a right angle."""
    r = D.regions(D.lines(spark, folder))
    lit = lambda *v: [F.lit(float(x)) for x in v]
    m = files.compose_affine(lit(2, 0, 0, 2, 10, 20), lit(0, 1, -1, 0, 500, 0))
    found = files.transform_box(m, [F.col(c).cast("double") for c in ("x0", "y0", "x1", "y1")])
    return r.select("doc_id", "page_no", "region_id", *[c.alias(n) for c, n in zip(found, ("x0", "y0", "x1", "y1"), strict=True)])


def page_fill_placement(spark: SparkSession, folder: str) -> DataFrame:
    fills = spark.createDataFrame([("a", "both", False), ("b", "even", False), ("c", "odd", True)], "fill_id string, parity string, hide_first boolean")
    return files.page_fills(fills, D.lines(spark, folder).select(*D.PAGE).distinct()).select("doc_id", "page_no", "fill_id")


def floating_pictures(spark: SparkSession, folder: str) -> DataFrame:
    """Offsets written without their sign, in hundredths of a point."""
    r = D.regions(D.lines(spark, folder))
    off = files.signed(F.when(F.col("seq") % 2 == 0, (1 << 32) - F.col("seq") * 100).otherwise(F.col("seq") * 100)) / 100.0
    align = F.element_at(F.array(F.lit("left"), F.lit("center"), F.lit("right")), (F.col("seq") % 3 + 1).cast("int"))
    found = files.floating_box([F.lit(float(x)) for x in (50, 60, 550, 800)], align, off, off, (F.col("x1") - F.col("x0")).cast("double"), (F.col("y1") - F.col("y0")).cast("double"))
    return r.select("doc_id", "page_no", "region_id", *[F.round(c, 4).alias(n) for c, n in zip(found, ("x0", "y0", "x1", "y1"), strict=True)])


def event_windows(spark: SparkSession, folder: str) -> DataFrame:
    """An addition of this engine: the windows of its streaming front, over a table."""
    found = front.windowed(D.table(spark, folder, "events").withColumn("value", F.round(F.col("value") * 100).cast("long")))
    return found.select(F.unix_timestamp("window_start").alias("window_start"), "event_type", "events", "total")


QUERIES = {f.__name__: f for f in (layout_answer_blocks, layout_answer_lines, dom_row_blocks, form_boxes, page_fill_placement, floating_pictures, event_windows)}

ORACLE_SQL = {
    "layout_answer_blocks": D.with_("regions", "select doc_id, page_no, seq - 1 as idx, label, seq as ord, content, round_even(x0 + 0.5, 0)::bigint as x0, round_even(y0 + 1.5, 0)::bigint as y0, x1, y1 from regions where seq % 10 <> 9"),
    "layout_answer_lines": D.with_("lines", "n as (select *, row_number() over (partition by doc_id, page_no order by i) - 1 as idx from lines where (doc_id, page_no) in (select (doc_id, page_no) from lines where (doc_id + i) % 7 <> 0)) select doc_id, page_no, idx, text, i % 7 / 10.0::double as score, round_even(x0 + 0.5, 0)::bigint as x0, round_even(y0 + 1.5, 0)::bigint as y0, x1, y1 from n where i % 10 <> 9"),
    "dom_row_blocks": D.with_(
        "lines",
        """
s as (select doc_id, page_no, i, i // 4 as row_no, greatest(0, least(1000, round_even((x0 + (i % 4) * 300) * 0.75::double, 0)))::bigint as x0, greatest(0, least(900, round_even(y0 * 0.75::double, 0)))::bigint as y0,
  greatest(0, least(1000, round_even((x1 + (i % 4) * 300) * 0.75::double, 0)))::bigint as x1, greatest(0, least(900, round_even(y1 * 0.75::double, 0)))::bigint as y1 from lines)
select doc_id, page_no, i, row_number() over (partition by doc_id, page_no, row_no order by x0, y0) - 1 as col, x0, y0, x1, y1 from s where x1 > x0 and y1 > y0""",
    ),
    "form_boxes": D.with_("regions", "select doc_id, page_no, region_id, 500.0 - (2 * y1 + 20) as x0, 2.0 * x0 + 10 as y0, 500.0 - (2 * y0 + 20) as x1, 2.0 * x1 + 10 as y1 from regions"),
    "page_fill_placement": D.with_("lines", "p as (select distinct doc_id, page_no from lines) select doc_id, page_no, f as fill_id from p, (values ('a'), ('b'), ('c')) t(f) where f = 'a' or (f = 'b' and page_no % 2 = 0) or (f = 'c' and page_no % 2 = 1 and page_no > 1)"),
    "floating_pictures": D.with_(
        "regions",
        """
o as (select *, case when seq % 2 = 0 then -seq else seq end::double as off, (x1 - x0)::double as w, (y1 - y0)::double as h from regions),
l as (select *, case seq % 3 when 0 then 50 + off when 1 then (50 + 550 - w) / 2 + off else 550 - w - off end as lx, 60 + off as ty from o)
select doc_id, page_no, region_id, round(lx, 4) as x0, round(ty, 4) as y0, round(lx + w, 4) as x1, round(ty + h, 4) as y1 from l""",
    ),
    "event_windows": "select floor(epoch(ts) / 3600)::bigint * 3600 as window_start, event_type, count(*) as events, sum(round(value * 100)::bigint)::bigint as total from events group by all",
}
