"""Pages, tiles and blocks: what a text layer is worth, how a page is cut, which blocks say something new."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import text as T
from ..options import DEFAULT, Options
from ..sources.derived import PAGE

#: Replacement character; letters, numbers, punctuation and symbols, or ASCII: what a sound text layer is made of.
_BROKEN, _NORMAL = "�", r"[\x00-\x7F\p{L}\p{N}\p{P}\p{S}]"


def triage(pages: DataFrame, text: str = "text", image_ratio: str = "image_ratio", options: Options = DEFAULT) -> DataFrame:
    """char_count, broken_count, normal_ratio, verdict of a page: scan_like, hybrid or structured."""
    dense = T.no_space(F.col(text))
    p = pages.withColumn("char_count", F.length(dense).cast("long"))
    p = p.withColumn("broken_count", (F.col("char_count") - F.length(F.replace(dense, F.lit(_BROKEN), F.lit("")))).cast("long"))
    # the replacement character is a symbol to Unicode, so it counts as normal; the rule before catches it
    p = p.withColumn("normal_ratio", F.when(F.col("char_count") > 0, F.regexp_count(dense, F.lit(_NORMAL)) / F.col("char_count")).otherwise(0.0))
    verdict = (
        F.when(F.col("char_count") <= options.readable_chars, "scan_like")
        .when((F.col("broken_count") >= options.broken_count) & (F.col("broken_count") / F.col("char_count") >= options.broken_ratio), "scan_like")
        .when((F.col("char_count") >= options.normal_chars) & (F.col("normal_ratio") <= options.normal_ratio), "scan_like")
        .when(F.col(image_ratio) >= options.image_ratio, "hybrid")
        .otherwise("structured")
    )
    return p.withColumn("verdict", verdict)


def object_census(objects: DataFrame, page_area: Column) -> DataFrame:
    """Share of a page under images (1 at most) and under paths (uncapped), and their number. objects: PAGE, kind, box."""
    share = lambda kind: F.sum(F.when(F.col("kind") == kind, G.area(G.box())).otherwise(0)) / F.first(page_area)
    per = objects.groupBy(*PAGE).agg(share("image").alias("image_ratio"), share("path").alias("path_ratio"), F.count_if(F.col("kind") == "path").alias("path_count"))
    return per.withColumn("image_ratio", F.least(F.lit(1.0), "image_ratio"))


def native_dpi(images: DataFrame, options: Options = DEFAULT) -> DataFrame:
    """The finest of a page's images in dots per inch, within bounds. images: PAGE, px, pt."""
    return images.groupBy(*PAGE).agg(F.greatest(F.lit(options.native_dpi_least), F.least(F.lit(options.native_dpi_most), F.max(F.col("px") / F.col("pt") * 72.0))).alias("dpi"))


def tile_decision(pages: DataFrame, options: Options = DEFAULT) -> DataFrame:
    """distortion (long by short side, 3 digits), decision whole or split, axis, span, overlap of a page of width and height."""
    sides = F.greatest("width", "height") / F.greatest(F.lit(1), F.least("width", "height"))
    span = options.tile_span
    overlap = int(min(options.tile_overlap_most, max(options.tile_overlap_least, round(span * options.tile_overlap_share))))
    p = pages.withColumn("distortion", F.bround(sides, 3))
    return p.withColumn("decision", F.when(F.col("distortion") <= options.aspect_limit, "whole").otherwise("split")).withColumns({"axis": F.when(F.col("height") >= F.col("width"), "y").otherwise("x"), "span": F.lit(span), "overlap": F.lit(overlap)})


def band_count(length: Column, span: int, overlap: int) -> Column:
    """Bands of `span`, each beginning `overlap` before the last one's end, until what is left is at most `overlap`. In closed form."""
    step = span - overlap
    return F.when(length <= span, 1).otherwise(F.greatest(F.lit(1), F.ceil((length - span - overlap) / step) + 1)).cast("int")


def band_ranges(pages: DataFrame, count: Column, limit: Column, least: int = 60, most: int = 200) -> DataFrame:
    """A row per band of a page: band, start, end by equal rounded cuts, crop_start, crop_end with an overlap of 3 %."""
    overlap = F.least(F.lit(most), F.greatest(F.lit(least), F.floor(limit * 0.03)))
    p = pages.withColumns({"bands": count, "limit": limit, "margin": overlap}).withColumn("band", F.explode(F.sequence(F.lit(1), F.col("bands"))))
    p = p.withColumns({"start": F.bround(F.col("limit") * (F.col("band") - 1) / F.col("bands")).cast("long"), "end": F.bround(F.col("limit") * F.col("band") / F.col("bands")).cast("long")})
    return p.withColumns({"crop_start": F.greatest(F.lit(0), F.col("start") - F.col("margin")), "crop_end": F.least(F.col("limit"), F.col("end") + F.col("margin"))})


def in_bands(items: DataFrame, bands: DataFrame) -> DataFrame:
    """Each item in the one band that holds its middle; the last band is open by one pixel."""
    middle = (F.col("y0") + F.col("y1")) / 2.0
    b = bands.select(*PAGE, "band", "bands", "limit", "start", "end")
    upper = F.when(F.col("band") < F.col("bands"), F.col("end")).otherwise(F.col("limit") + 1)
    return items.join(b, list(PAGE)).where((middle >= F.col("start")) & (middle < upper)).drop("bands", "limit", "start", "end")


def equal_mass_cuts(profile: DataFrame, parts: int, keys: tuple[str, ...], position: str = "pos", mass: str = "mass") -> DataFrame:
    """keys, k (1 .. parts - 1), cut: the first position where the running mass reaches k parts of the whole."""
    run = Window.partitionBy(*keys).orderBy(position)
    p = profile.withColumns({"run": F.sum(mass).over(run), "whole": F.sum(mass).over(Window.partitionBy(*keys))}).where(F.col("whole") > 0)
    before = F.col("run") - F.col(mass)
    k = F.explode(F.sequence(F.lit(1), F.lit(parts - 1)))
    return p.withColumn("k", k).where((F.col("run") * parts >= F.col("k") * F.col("whole")) & (before * parts < F.col("k") * F.col("whole"))).select(*keys, F.col("k").cast("long").alias("k"), F.col(position).alias("cut"))


def gap_segments(chars: DataFrame, keys: tuple[str, ...], options: Options = DEFAULT) -> DataFrame:
    """segment (from 0) of each character box of a row: a new one where the gap to the box before is over 4 mean widths, 6 at least."""
    row = Window.partitionBy(*keys)
    along = row.orderBy("pos")
    limit = F.greatest(F.avg(F.col("x1") - F.col("x0")).over(row) * options.column_gap_chars, F.lit(options.column_gap_least))
    c = chars.withColumns({"gap": F.col("x0") - F.lag("x1").over(along), "gap_limit": limit})
    return c.withColumn("segment", F.sum(F.coalesce((F.col("gap") > F.col("gap_limit")).cast("long"), F.lit(0))).over(along)).drop("gap", "gap_limit")


#: How an item of a list begins (fixed pattern).
ITEM_START = r"^\s*(?:[▶▷►□■◆◇●○◎◈★☆※☞✔❖]|\d{1,2}[.)]\s|[가-하][.)]\s)"


def paragraph_groups(rows: DataFrame, keys: tuple[str, ...], item_start: str = ITEM_START) -> DataFrame:
    """group number of each non-blank row of keys by index: a new group after a gap in index, after a blank row, or at an item's start."""
    along = Window.partitionBy(*keys).orderBy("index")
    blank = F.trim(F.coalesce("text", F.lit(""))) == ""
    r = rows.withColumns({"blank": blank, "last": F.lag("index").over(along), "last_blank": F.lag(blank).over(along)})
    opens = F.col("last").isNull() | (F.col("index") != F.col("last") + 1) | F.col("last_blank") | F.rlike(F.coalesce("text", F.lit("")), F.lit(item_start))
    r = r.withColumn("opens", opens & ~F.col("blank"))
    return r.withColumn("group", F.sum(F.col("opens").cast("long")).over(along)).where("not blank").drop("blank", "last", "last_blank", "opens")


def novel_blocks(visual: DataFrame, structured: DataFrame, key: str = "block_id") -> DataFrame:
    """visual with duplicate: whether structured blocks of the page already say it, by place and text, alone or three and more together, or, of a block
    with a table's markup, whether the page has a structured table.

    structured: PAGE, box, content, has_table. Texts are normalised and their characters counted before blocks meet, once a block.
    """
    s = structured.select(*PAGE, *[F.col(c).alias(f"s_{c}") for c in G.BOX], T.no_space_lower("content").alias("known"))
    s = s.withColumn("known_chars", T.char_counts(F.col("known")))
    v = visual.select(*PAGE, key, *G.BOX, T.no_space_lower("content").alias("said"))
    v = v.withColumn("said_chars", T.char_counts(F.col("said")))
    a, b = G.box("s_"), G.box()
    x, y = G.axis_share(a[0], a[2], b[0], b[2]), G.axis_share(a[1], a[3], b[1], b[3])
    met = v.join(s, list(PAGE)).withColumns({"x": x, "y": y}).where("x >= 0.8 and y >= 0.8")
    known_area, own_area = F.greatest(F.lit(1), G.area(a)), F.greatest(F.lit(1), G.area(b))
    there = lambda l, r: T.counts_coverage(F.col(f"{l}_chars"), F.col(f"{r}_chars"), F.length(l))
    x, y = F.col("x"), F.col("y")
    geometry = (x >= 0.95) & (y >= 0.95) & (F.least(known_area, own_area) / F.greatest(known_area, own_area) >= 0.75)
    present = (F.col("said") != "") & (F.col("known") != "") & F.contains("known", "said")
    met = met.withColumn("c1", F.when((x >= 0.9) & (y >= 0.9) & (F.length("said") >= 8), there("said", "known"))).withColumn("c2", F.when((F.col("c1") >= 0.8) & (F.col("c1") < 0.85), there("known", "said")))
    noisy = F.coalesce((F.col("c1") >= 0.85) | (F.col("c2") >= 0.8), F.lit(False))
    enclosed = (G.intersection(a, b) / known_area >= 0.8) & (F.col("known") != "")
    per = met.groupBy(*PAGE, key).agg(F.first("said").alias("said"), F.max(geometry | present | noisy).alias("pair"), F.count_if(enclosed).alias("inside"), F.array_join(F.collect_list(F.when(enclosed, F.col("known"))), "").alias("all_known"))
    together = (F.col("inside") >= 3) & (F.length("said") >= 20) & (T.multiset_coverage(F.col("said"), F.col("all_known")) >= DEFAULT.structure_match)
    found = per.select(*PAGE, key, (F.col("pair") | together).alias("duplicate"))
    pages = structured.where("has_table").select(*PAGE).distinct().withColumn("tabled", F.lit(True))
    joined = visual.join(found, [*PAGE, key], "left").join(pages, list(PAGE), "left")
    markup = F.contains(F.lower(F.coalesce("content", F.lit(""))), F.lit("<table")) & F.col("tabled").isNotNull()
    return joined.withColumn("duplicate", F.coalesce("duplicate", F.lit(False)) | markup).drop("tabled")


def drop_adjacent_repeats(lines: DataFrame, parser: DataFrame, keys: tuple[str, ...], least: int = 8) -> DataFrame:
    """keys and pos of lines but those equal to the line before that have `least` characters and that the parser's text has just once.

    lines: keys, pos, text; parser: keys, text, of which only keys with such a line are looked at, each once for all its lines.
    """
    k = lines.select(*keys, "pos", T.no_space_lower("text").alias("key"))
    before = F.lag("key").over(Window.partitionBy(*keys).orderBy("pos"))
    k = k.withColumn("again", F.coalesce((before == F.col("key")) & (F.length("key") >= least), F.lit(False)))
    some = k.groupBy(*keys).agg(F.collect_list(F.struct("pos", F.when(F.col("again"), F.col("key")).alias("key"))).alias("rows"))
    met = some.join(parser.select(*keys, T.no_space_lower("text").alias("said")), list(keys), "left")
    times = lambda key: (F.length("said") - F.length(F.replace(F.col("said"), key, F.lit("")))) / F.length(key)
    kept = F.filter("rows", lambda x: x["key"].isNull() | ~F.coalesce(times(x["key"]) == 1, F.lit(False)))
    return met.select(*keys, F.explode(F.transform(kept, lambda x: x["pos"])).alias("pos"))


def percent_boxes(regions: DataFrame, width: Column, height: Column) -> DataFrame:
    """x, y, w, h in percent of the canvas, within it; boxes with nothing left are not in the result."""
    left, top, right, bottom = G.percent(F.col("x0"), width), G.percent(F.col("y0"), height), G.percent(F.col("x1"), width), G.percent(F.col("y1"), height)
    return regions.withColumns({"px": left, "py": top, "pw": right - left, "ph": bottom - top}).where("pw > 0 and ph > 0")


def running_pages(pages: DataFrame, group: str) -> DataFrame:
    """run_no: pages of the files of a group numbered through, by file and page."""
    return pages.withColumn("run_no", F.row_number().over(Window.partitionBy(group).orderBy("file_no", "page_no")).cast("long"))


def render_text(blocks: DataFrame, lines: DataFrame, key: str = "block_id") -> DataFrame:
    """render_text of a block: the lines whose middle it holds, by place."""
    l = lines.select(*PAGE, *[F.col(c).alias(f"l_{c}") for c in G.BOX], F.trim("text").alias("l_text")).where("l_text <> ''")
    cx, cy = (F.col("l_x0") + F.col("l_x1")) / 2.0, (F.col("l_y0") + F.col("l_y1")) / 2.0
    met = blocks.join(l, list(PAGE)).where((cx >= F.col("x0")) & (cx <= F.col("x1")) & (cy >= F.col("y0")) & (cy <= F.col("y1")))
    parts = F.transform(F.array_sort(F.collect_list(F.struct("l_y0", "l_x0", "l_text"))), lambda s: s["l_text"])
    return met.groupBy(*PAGE, key).agg(F.array_join(parts, "\n").alias("render_text"))
