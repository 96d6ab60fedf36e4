"""Lines and regions of a page: who owns a line, what a region says, which region holds which.

All joins have page equality as their key and the boxes as a residual, so they are hash joins; the arg-max of a line is an aggregate
on the same partitioning, not another shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import text as T
from ..options import DEFAULT, Options
from ..sources.derived import PAGE


def _prefixed(df: DataFrame, prefix: str, *names: str) -> DataFrame:
    return df.select(*PAGE, *[F.col(c).alias(f"{prefix}{c}") for c in names])


def assign_lines(lines: DataFrame, regions: DataFrame, key: tuple[str, ...] = ("i",), least: float = DEFAULT.line_overlap) -> DataFrame:
    """key of each line with the region_id that owns it and the overlap; lines without an owner are not in the result.

    The owner covers most of the line's area, at least `least`; of equals the smaller region, then the earlier one.
    """
    r = _prefixed(regions, "r_", "region_id", "seq", *G.BOX)
    met = lines.join(r, list(PAGE)).withColumn("ov", G.overlap(G.box(), G.box("r_"))).where(F.col("ov") >= least)
    best = F.max_by(F.struct("r_region_id", "ov"), F.struct("ov", -G.area(G.box("r_")), -F.col("r_seq")))
    return met.groupBy(*PAGE, *key).agg(best.alias("b")).select(*PAGE, *key, F.col("b.r_region_id").alias("region_id"), F.col("b.ov").alias("overlap"))


def with_owner(lines: DataFrame, regions: DataFrame, key: tuple[str, ...] = ("i",)) -> DataFrame:
    """Every line exactly once, region_id and overlap null if none owns it."""
    return lines.join(assign_lines(lines, regions, key), [*PAGE, *key], "left")


def uncovered(lines: DataFrame, by: DataFrame, least: float = DEFAULT.line_overlap) -> DataFrame:
    """Lines of which no line of `by` covers `least` of the area."""
    other = _prefixed(by, "o_", *G.BOX).withColumnsRenamed({c: f"o_{c}" for c in PAGE})
    same = (F.col("doc_id") == F.col("o_doc_id")) & (F.col("page_no") == F.col("o_page_no"))
    return lines.join(other, same & (G.overlap(G.box(), G.box("o_")) >= least), "left_anti")


def canonical_lines(digital: DataFrame, ocr: DataFrame) -> DataFrame:
    """Digital lines and the OCR lines they don't cover, as one stream with line_id p<page>_l<nr> by place, digital first."""
    both = digital.withColumn("rank", F.lit(0)).unionByName(uncovered(ocr, digital).withColumn("rank", F.lit(1)))
    nr = F.row_number().over(Window.partitionBy(*PAGE).orderBy("y0", "x0", "rank", "i")).cast("long")
    return both.withColumn("line_id", F.format_string("p%d_l%04d", "page_no", nr)).drop("rank")


def parents(regions: DataFrame) -> DataFrame:
    """doc_id, page_no, region_id, parent_id: the smallest strictly larger region that contains it; of equals the earlier one."""
    outer = _prefixed(regions, "p_", "region_id", "seq", *G.BOX)
    met = regions.join(outer, list(PAGE)).where(G.contains(G.box("p_"), G.box()) & (G.area(G.box("p_")) > G.area(G.box())))
    best = met.groupBy(*PAGE, "region_id").agg(F.min_by("p_region_id", F.struct(G.area(G.box("p_")), "p_seq")).alias("parent_id"))
    return regions.select(*PAGE, "region_id", "seq").join(best, [*PAGE, "region_id"], "left")


def children(links: DataFrame) -> DataFrame:
    """doc_id, page_no, region_id, child_ids in region order, from parents()."""
    found = links.where("parent_id is not null").groupBy(*PAGE, F.col("parent_id").alias("region_id"))
    return found.agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", "region_id"))), lambda s: s["region_id"]).alias("child_ids"))


def assembled(owned: DataFrame) -> DataFrame:
    """Per region: line_text (trimmed lines by place), n_lines, digital_share (of characters, case folded, null without any), has_digital, texts (without white space, case folded)."""
    owned = owned.withColumn("low", T.no_space_lower("text"))
    size = F.length("low")
    ordered = F.array_sort(F.collect_list(F.struct("y0", "x0", "i", F.trim("text").alias("t"))))
    parts = F.filter(F.transform(ordered, lambda s: s["t"]), lambda t: t != "")
    total = F.sum(F.when(F.col("source").isin("digital", "ocr"), size))
    return owned.groupBy(*PAGE, "region_id").agg(
        F.array_join(parts, "\n").alias("line_text"),
        F.count("*").alias("n_lines"),
        (F.sum(F.when(F.col("source") == "digital", size).otherwise(0)).cast("double") / F.when(total > 0, total)).alias("digital_share"),
        F.max(F.col("source") == "digital").alias("has_digital"),
        F.collect_list("low").alias("texts"),
    )


def choose_text(regions: DataFrame, lines: DataFrame, agreement: Column | None = None, options: Options = DEFAULT) -> DataFrame:
    """Per region: text, text_source, gap_lines (owned lines of 2 characters or more that the text misses), selection_status if agreement is given.

    regions: content (the block's text) and block_source (null for recognised blocks); lines: from assembled().
    """
    # Both texts' folded forms are columns below the join: above it they would be worked out again for each line of a region.
    low = regions.withColumn("block_low", T.no_space_lower("content"))
    r = low.join(lines.withColumn("line_low", T.no_space_lower("line_text")), [*PAGE, "region_id"], "left")
    block, line = F.coalesce("content", F.lit("")), F.coalesce("line_text", F.lit(""))
    structured = F.coalesce(F.startswith("block_source", F.lit("document_processor")), F.lit(False))
    mainly_digital = F.coalesce(F.col("digital_share") >= options.digital_share, F.lit(False))
    digital = F.coalesce("has_digital", F.lit(False))
    texts = F.coalesce("texts", F.array().cast("array<string>"))
    missed = lambda low: F.size(F.filter(texts, lambda t: (F.length(t) >= 2) & ~F.contains(F.col(low), t)))
    both = (block != "") & (line != "")
    source = (
        F.when(both & structured, F.col("block_source"))
        .when(both & mainly_digital, "digital_ocr_lines")
        .when(both & digital, "ocr_digital_lines")
        .when(both & (missed("block_low") > 0), "ocr_lines_block_incomplete")
        .when(both, "block_content")
        .when(block != "", F.coalesce("block_source", F.lit("block_content")))
        .when((line != "") & mainly_digital, "digital_ocr_fallback")
        .when((line != "") & digital, "ocr_digital_fallback")
        .when(line != "", "ocr_fallback")
        .otherwise("empty")
    )
    r = r.withColumn("text_source", source)
    takes_block = (block != "") & (F.col("text_source").eqNullSafe(F.col("block_source")) | (F.col("text_source") == "block_content"))
    r = r.withColumn("text", F.when(takes_block, block).otherwise(line))
    gaps = F.when(takes_block, missed("block_low")).otherwise(missed("line_low"))
    r = r.withColumn("gap_lines", F.when(block != "", F.coalesce(gaps, F.lit(0))).otherwise(0).cast("long"))
    if agreement is not None:
        status = (
            F.when(both & structured, F.when(agreement >= options.strong_agreement, "sources_agree").otherwise("structured_primary"))
            .when(both, F.when(agreement >= options.strong_agreement, "sources_agree").when(agreement >= options.conflict, "minor_difference").otherwise("conflict_pending_vlm"))
            .when(block != "", "block_only")
            .when(line != "", "line_fallback")
            .otherwise("empty")
        )
        r = r.withColumn("selection_status", status)
    return r.drop("texts", "block_low", "line_low")


def page_diagnostics(chosen: DataFrame, lines: DataFrame) -> DataFrame:
    """One row per page that has lines: counts of regions by text source, of lines by source, of unassigned lines and gaps."""
    of_regions = chosen.groupBy(*PAGE).agg(
        F.count("*").alias("regions"),
        F.count_if(F.col("text_source") == "block_content").alias("block_content_regions"),
        F.count_if(F.col("text_source").endswith("_fallback") & (F.col("text") != "")).alias("fallback_regions"),
        F.count_if(F.col("text_source") == "empty").alias("empty_regions"),
        F.sum("gap_lines").alias("gap_lines"),
    )
    of_lines = lines.groupBy(*PAGE).agg(
        F.count_if(F.col("source") == "ocr").alias("ocr_lines"),
        F.count_if(F.col("source") == "digital").alias("digital_lines"),
        F.count("*").alias("canonical_lines"),
        F.count_if(F.col("region_id").isNull()).alias("unassigned_lines"),
    )
    joined = of_lines.join(of_regions, list(PAGE), "left")
    counts = ("regions", "block_content_regions", "fallback_regions", "empty_regions", "gap_lines")
    route = F.when(F.col("digital_lines") > 0, "digital_primary").otherwise("ocr_only")
    return joined.withColumns({c: F.coalesce(c, F.lit(0)) for c in counts}).withColumn("route", route)


def garbled_layer(lines: DataFrame, script: str = T.HANGUL, least: int = 100, share: float = 0.2) -> DataFrame:
    """Pages whose digital text layer has under `share` of the script's characters that recognition saw, if it saw `least`."""
    count = lambda source: F.sum(F.when(F.col("source") == source, F.regexp_count("text", F.lit(script))).otherwise(0))
    per = lines.groupBy(*PAGE).agg(count("ocr").cast("long").alias("ocr_chars"), count("digital").cast("long").alias("digital_chars"))
    return per.withColumn("needs_ocr", (F.col("ocr_chars") >= least) & (F.col("digital_chars") < share * F.col("ocr_chars")))


def review_priority(pages: DataFrame, most: int = 15) -> DataFrame:
    """The pages with most to look at: by unassigned lines and gaps, then unassigned lines; ties by place."""
    order = [(F.col("unassigned_lines") + F.col("gap_lines")).desc(), F.col("unassigned_lines").desc(), *PAGE]
    return pages.select(*PAGE, "unassigned_lines", "gap_lines", (F.col("unassigned_lines") + F.col("gap_lines")).alias("weight")).orderBy(*order).limit(most)


def run_totals(pages: DataFrame) -> DataFrame:
    """One row: sums over all pages."""
    sums = ("regions", "block_content_regions", "fallback_regions", "empty_regions", "gap_lines", "ocr_lines", "digital_lines", "unassigned_lines")
    return pages.agg(F.count("*").alias("pages"), F.countDistinct("doc_id").alias("documents"), *[F.sum(c).alias(c) for c in sums])
