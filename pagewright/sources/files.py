"""Where evidence comes from: listed files, saved boxes, answers of a layout service, rows of a rendered page, a template catalog."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .derived import PAGE

# Suffixes of the inputs by kind.
SUFFIXES = {"image": ("png", "jpg", "jpeg"), "pdf": ("pdf",), "hwp": ("hwp", "hwpx")}
BOXES = "doc_id long, page_no long, blocks array<struct<block_id:string,piece:long,label:string,bbox:array<long>,content:string,score:double>>, lines array<struct<text:string,bbox:array<long>,score:double,piece:long>>"


def list_inputs(spark: SparkSession, folder: str, exclude: str | None = None) -> DataFrame:
    """path, name, kind, length of a folder's own files of known suffixes, by name; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "false").load(folder).select("path", "length")
    name = F.element_at(F.split("path", "/"), -1)
    suffix = F.lower(F.element_at(F.split(name, r"\."), -1))
    kind = F.coalesce(*[F.when(suffix.isin(*s), F.lit(k)) for k, s in SUFFIXES.items()])
    found = files.select("path", name.alias("name"), kind.alias("kind"), "length").where("kind is not null")
    return found.where(~F.contains("name", F.lit(exclude))) if exclude else found


def group_kind(files: DataFrame, group: str) -> DataFrame:
    """The one kind of a group's files, else mixed."""
    return files.groupBy(group).agg(F.when(F.countDistinct("kind") == 1, F.first("kind")).otherwise("mixed").alias("kind"))


def saved_boxes(spark: SparkSession, folder: str) -> DataFrame:
    """Page-coordinate boxes of an earlier run, one JSON file per page, for re-execution without a model."""
    return spark.read.schema(BOXES).option("multiLine", "true").json(folder)


def box_columns(box: Column) -> list[Column]:
    return [F.bround(box[k]).cast("long").alias(c) for k, c in enumerate(("x0", "y0", "x1", "y1"))]


LAYOUT_ANSWER = "blocks array<struct<label:string,ord:long,bbox:array<double>,content:string>>, lines array<struct<text:string,score:double,bbox:array<double>>>"


def layout_answers(answers: DataFrame, col: str = "answer") -> tuple[DataFrame, DataFrame]:
    """(blocks, lines) of a layout service's JSON answers; coordinates rounded half to even, entries without four of them left out."""
    read = answers.withColumn("a", F.from_json(col, LAYOUT_ANSWER))

    def entries(name: str, *more: str) -> DataFrame:
        one = read.select(*PAGE, F.posexplode(f"a.{name}").alias("idx", "e")).where(F.size("e.bbox") == 4)
        return one.select(*PAGE, F.col("idx").cast("long").alias("idx"), *[F.col(f"e.{m}").alias(m) for m in more], *box_columns(F.col("e.bbox")))

    return entries("blocks", "label", "ord", "content"), entries("lines", "text", "score")


def dom_blocks(rows: DataFrame, scale: Column) -> DataFrame:
    """Rows of a rendered page in pixels: scaled, held within the canvas, the degenerate left out, columns numbered from left. rows: PAGE, row_no, box, canvas_w, canvas_h."""
    at = {"x0": "canvas_w", "y0": "canvas_h", "x1": "canvas_w", "y1": "canvas_h"}
    r = rows.withColumns({c: F.greatest(F.lit(0), F.least(F.col(m), F.bround(F.col(c) * scale))).cast("long") for c, m in at.items()}).where("x1 > x0 and y1 > y0")
    return r.withColumn("col", F.row_number().over(Window.partitionBy(*PAGE, "row_no").orderBy("x0", "y0")).cast("long") - 1)


def signed(value: Column) -> Column:
    """A 32-bit number that was written without its sign."""
    return F.when(value >= 1 << 31, value - (1 << 32)).otherwise(value)


def compose_affine(a: list[Column], b: list[Column]) -> list[Column]:
    """The matrix (a, b, c, d, e, f) that applies a first, then b."""
    a0, a1, a2, a3, a4, a5 = a
    b0, b1, b2, b3, b4, b5 = b
    return [a0 * b0 + a1 * b2, a0 * b1 + a1 * b3, a2 * b0 + a3 * b2, a2 * b1 + a3 * b3, a4 * b0 + a5 * b2 + b4, a4 * b1 + a5 * b3 + b5]


def transform_box(m: list[Column], box: list[Column]) -> list[Column]:
    """The box around a box's corners after m."""
    x = lambda i, j: m[0] * box[i] + m[2] * box[j] + m[4]
    y = lambda i, j: m[1] * box[i] + m[3] * box[j] + m[5]
    corners = [(0, 1), (0, 3), (2, 1), (2, 3)]
    xs, ys = [x(*c) for c in corners], [y(*c) for c in corners]
    return [F.least(*xs), F.least(*ys), F.greatest(*xs), F.greatest(*ys)]


def floating_box(page: list[Column], align: Column, offset_x: Column, offset_y: Column, width: Column, height: Column) -> list[Column]:
    """Where a floating picture stands on a page area (x0, y0, x1, y1): at the left, the right or the middle, moved by its offsets."""
    left = F.when(align == "right", page[2] - width - offset_x).when(align == "center", (page[0] + page[2] - width) / 2 + offset_x).otherwise(page[0] + offset_x)
    top = page[1] + offset_y
    return [left, top, left + width, top + height]


def page_fills(fills: DataFrame, pages: DataFrame) -> DataFrame:
    """Background pictures of pages by parity: both, even or odd; hidden on the first page if so marked. fills: fill_id, parity, hide_first."""
    p = pages.select(*PAGE, F.when(F.col("page_no") % 2 == 0, "even").otherwise("odd").alias("side"))
    sides = fills.withColumn("side", F.explode(F.when(F.col("parity") == "both", F.array(F.lit("even"), F.lit("odd"))).otherwise(F.array("parity"))))
    met = p.join(sides, "side")
    return met.where(~(F.col("hide_first") & (F.col("page_no") == 1))).drop("side")


def catalog(spark: SparkSession, path: str) -> DataFrame:
    """template_id, template_pos, product_group, label_pos, label, example of a JSON catalog; refused if it is of no known version, empty, or has a label twice."""
    schema = "version string, templates array<struct<template_id:string,product_group:string,items:array<struct<label:string,example:string>>>>"
    raw = spark.read.schema(schema).option("multiLine", "true").json(path)
    t = raw.select("version", F.posexplode("templates").alias("template_pos", "t"))
    items = t.select("version", "template_pos", "t.template_id", "t.product_group", F.posexplode("t.items").alias("label_pos", "i")).select("version", "template_id", "template_pos", "product_group", "label_pos", "i.label", "i.example")
    fault = items.agg(F.count("*").alias("n"), F.count_if(F.col("version") != "template-catalog-v1").alias("other"), (F.count("*") - F.countDistinct("template_id", "label")).alias("twice")).first()
    if not fault["n"] or fault["other"] or fault["twice"]:
        raise ValueError(f"template catalog {path}: {fault.asDict()}")
    return items.drop("version")
