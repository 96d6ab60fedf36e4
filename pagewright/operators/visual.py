"""Tables seen on the page: candidates, verdicts, merged regions; styles of lines."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import text as T
from ..options import DEFAULT
from ..sources.derived import PAGE
from .folds import per_group

# How names of fonts end that are not bold, and that are.
NOT_BOLD, BOLD = ("light", "regular", "medium", "thin", "-l", "-r", "-m", "l", "r", "m"), ("bold", "black", "heavy", "-b", "b")


def candidates(regions: DataFrame, areas: DataFrame) -> DataFrame:
    """candidate, source, member_ids: regions that the layout calls a table, then areas that a model named; no set of members twice.

    regions: PAGE, region_id, seq, layout_label, has_table; areas: PAGE, area_no, pos, region_id. Regions with a source table take no part.
    """
    free = regions.where(~F.col("has_table"))
    layout = free.where(F.lower("layout_label") == "table").select(*PAGE, F.lit("layout").alias("source"), F.col("seq").alias("nr"), F.array("region_id").alias("member_ids"))
    known = areas.join(free.select(*PAGE, "region_id"), [*PAGE, "region_id"], "left_semi").groupBy(*PAGE, "area_no", "region_id").agg(F.min("pos").alias("pos"))
    named = known.groupBy(*PAGE, "area_no").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "region_id"))), lambda s: s["region_id"]).alias("member_ids"))
    both = layout.unionByName(named.select(*PAGE, F.lit("page").alias("source"), F.col("area_no").alias("nr"), "member_ids"))
    order = F.struct((F.col("source") == "page").alias("late"), "nr")
    first = both.groupBy(*PAGE, F.sort_array("member_ids").alias("key")).agg(F.min_by(F.struct("source", "member_ids", order.alias("order")), order).alias("c"))
    nr = F.row_number().over(Window.partitionBy(*PAGE).orderBy("c.order")).cast("long")
    return first.select(*PAGE, nr.alias("candidate"), F.col("c.source").alias("source"), F.col("c.member_ids").alias("member_ids"))


def verdict(is_table: Column, confidence: Column, selected: Column, owners: Column, with_source: Column, text: Column, duplicate: Column) -> Column:
    """Why a candidate is or isn't a table: accepted, or the first reason against it."""
    return (
        F.when(~is_table | (confidence < DEFAULT.confidence) | (F.size(selected) == 0), "no_table").when((owners != 1) | with_source, "held_back")
        .when((F.size(selected) == 1) & duplicate, "table_region_overlap").when(F.trim(F.coalesce(text, F.lit(""))) == "", "table_text_missing").otherwise("accepted")
    )


def repeats_another(regions: DataFrame) -> DataFrame:
    """Regions that hold the box and the words of another region of the same product. regions: PAGE, region_id, product_id, box, text."""
    o = regions.select(*PAGE, "product_id", F.col("region_id").alias("o_id"), *[F.col(c).alias(f"o_{c}") for c in G.BOX], T.no_space_lower("text").alias("o_text")).where(F.length("o_text") >= 8)
    met = regions.join(o, [*PAGE, "product_id"]).where("o_id <> region_id")
    inside = G.intersection(G.box(), G.box("o_")) / F.greatest(F.lit(1), G.area(G.box("o_"))) >= 0.85
    return met.where(inside & F.contains(T.no_space_lower("text"), F.col("o_text"))).select(*PAGE, "region_id").distinct()


def first_of_same(regions: DataFrame) -> DataFrame:
    """Regions but those of which an earlier one has the same words in nine tenths of the smaller box."""
    e = regions.select(*PAGE, F.col("seq").alias("e_seq"), *[F.col(c).alias(f"e_{c}") for c in G.BOX], T.no_space_lower("text").alias("e_text"))
    same = [regions[k] == e[k] for k in PAGE]
    smaller = F.least(F.greatest(F.lit(1), G.area(G.box())), F.greatest(F.lit(1), G.area(G.box("e_"))))
    return regions.join(e, same[0] & same[1] & (F.col("e_seq") < F.col("seq")) & (G.intersection(G.box(), G.box("e_")) / smaller >= 0.9) & (F.col("e_text") == T.no_space_lower("text")), "left_anti")


def merge_members(regions: DataFrame, members: DataFrame) -> DataFrame:
    """Regions with every accepted table's members as one, the earliest, under the box of all; merged_from names them.

    regions: PAGE, region_id, seq, box, text, text_source; members: PAGE, candidate, region_id.
    """
    m = regions.join(members, [*PAGE, "region_id"])
    source = F.when(F.max(F.startswith("text_source", F.lit("vlm"))), "vlm_table_group").when(F.min(F.startswith("text_source", F.lit("digital"))), "digital_table_group").otherwise("ocr_table_group")
    by_place = F.array_sort(F.collect_list(F.struct("y0", "x0", "seq", F.trim("text").alias("t"))))
    one = m.groupBy(*PAGE, "candidate").agg(
        F.min_by("region_id", "seq").alias("region_id"), F.min("seq").alias("seq"), F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"),
        F.array_join(F.filter(F.transform(by_place, lambda s: s["t"]), lambda t: t != ""), "\n").alias("text"), source.alias("text_source"),
        F.transform(F.array_sort(F.collect_list(F.struct("seq", "region_id"))), lambda s: s["region_id"]).alias("merged_from"),
    )
    rest = regions.join(members, [*PAGE, "region_id"], "left_anti").select(*PAGE, "region_id", "seq", *G.BOX, "text", "text_source", F.array().cast("array<string>").alias("merged_from"))
    return one.drop("candidate").select(*rest.columns).unionByName(rest)


def is_bold(weight: Column, font: Column) -> Column:
    """By the end of the font's name, what is not bold first; else by a weight of 700; null if neither says."""
    stem = F.lower(F.element_at(F.split(font, r"\+"), -1))
    ends = lambda names: F.rlike(stem, F.lit("(" + "|".join(names) + ")$"))
    return F.when(ends(NOT_BOLD), False).when(ends(BOLD), True).when(weight > 0, weight >= 700)


def _style(size: list, bold: list, color: list, font: list, n: list, pos: list) -> Iterator[tuple]:
    """A line's style from its kinds of characters, each with how many there are and where the first stands."""

    def ranked(values: list) -> list:
        found: dict = {}
        for v, times, at in zip(values, n, pos, strict=True):
            if v is not None:
                total, first = found.get(v, (0, at))
                found[v] = (total + times, min(first, at))
        return sorted(found, key=lambda v: (-found[v][0], found[v][1]))

    sizes, colors, fonts = ranked(size), ranked(color), ranked(font)
    known = [b for b in bold if b is not None]
    yield min(sizes, default=None), max(sizes, default=None), any(known) if known else None, *(next(iter(x), None) for x in (sizes, colors, fonts)), colors


def line_styles(chars: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """A line's style from its characters': the most frequent size, colour and font (of equals the first seen), all colours so, least and largest size, bold if any is.

    chars: keys, pos, size, bold, color, font.
    """
    kinds = chars.groupBy(*keys, "size", "bold", "color", "font").agg(F.count("*").alias("n"), F.min("pos").alias("pos"))
    of = dict(chars.dtypes)
    schema = f"size_min {of['size']}, size_max {of['size']}, bold boolean, size {of['size']}, color {of['color']}, font {of['font']}, colors array<{of['color']}>"
    found = per_group(kinds, keys, _style, schema)
    return found.withColumn("colors", F.when(F.size("colors") > 0, F.col("colors")))
