"""Queries on pages, tiles and blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import layout as L
from ..sources import derived as D


def triage_verdict(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as pages; every 7th has its vowels broken, every 5th is half under images."""
    docs = D.table(spark, folder, "documents")
    broken = F.when(F.col("doc_id") % 7 == 0, F.regexp_replace("text", "[aeiou]", "�")).when(F.col("doc_id") % 11 == 0, F.substring("text", 1, 18)).otherwise(F.col("text"))
    pages = docs.select("doc_id", broken.alias("text"), (F.col("doc_id") % 5 / 4.0).alias("image_ratio"))
    return L.triage(pages).select("doc_id", "char_count", "broken_count", "verdict")


def tile_decision(spark: SparkSession, folder: str) -> DataFrame:
    docs = D.table(spark, folder, "documents").select("doc_id", (800 + F.col("doc_id") % 300).alias("width"), (200 + F.col("n_chars")).alias("height"))
    found = L.tile_decision(docs).withColumn("pieces", F.when(F.col("decision") == "whole", 1).otherwise(L.band_count(F.greatest("width", "height"), 1600, 200)).cast("long"))
    return found.select("doc_id", "distortion", "decision", "axis", F.col("span").cast("long").alias("span"), F.col("overlap").cast("long").alias("overlap"), "pieces")


def semantic_bands(spark: SparkSession, folder: str) -> DataFrame:
    """Regions of every page in the bands of a page of 960 rows, cut in 2 to 4."""
    regions = D.regions(D.lines(spark, folder))
    bands = L.band_ranges(regions.select(*D.PAGE).distinct(), (2 + F.col("doc_id") % 3).cast("int"), F.lit(960))
    return L.in_bands(regions.select(*D.PAGE, "region_id", "y0", "y1"), bands).select("doc_id", "page_no", "region_id", F.col("band").cast("long").alias("band"))


def band_crops(spark: SparkSession, folder: str) -> DataFrame:
    docs = D.table(spark, folder, "documents").select("doc_id", F.lit(1).alias("page_no"), (F.col("n_chars") + 100).alias("n"))
    found = L.band_ranges(docs, (2 + F.col("doc_id") % 3).cast("int"), F.col("n"))
    return found.select("doc_id", F.col("band").cast("long").alias("band"), "start", "end", F.col("crop_start").cast("long").alias("crop_start"), F.col("crop_end").cast("long").alias("crop_end"))


def equal_mass_cuts(spark: SparkSession, folder: str) -> DataFrame:
    profile = D.lines(spark, folder).select("doc_id", "page_no", F.col("y0").alias("pos"), F.length("text").alias("mass"))
    return L.equal_mass_cuts(profile, 4, D.PAGE)


def gap_segments(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every line as boxes 9 wide, some further apart."""
    words = D.lines(spark, folder).select("doc_id", "page_no", "i", F.posexplode(F.split("text", " ")).alias("pos", "word"))
    x0 = F.col("pos") * 10 + F.expr("pos div 4") * (F.col("doc_id") % 9) * 10
    boxes = words.select("doc_id", "page_no", "i", F.col("pos").cast("long").alias("pos"), x0.alias("x0"), (x0 + 9).alias("x1"))
    return L.gap_segments(boxes, (*D.PAGE, "i")).select("doc_id", "page_no", "i", "pos", "segment")


def paragraph_groups(spark: SparkSession, folder: str) -> DataFrame:
    raw = D.table(spark, folder, "documents").select("doc_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("index", "text"))
    text = F.when(F.col("index") % 6 == 4, F.lit(" ")).when(F.col("index") % 9 == 2, F.concat(F.lit("■ "), "text")).when(F.col("index") % 7 == 3, F.concat(F.lit("1. "), "text")).otherwise(F.col("text"))
    rows = raw.where("index % 8 <> 7").select("doc_id", F.col("index").cast("long").alias("index"), text.alias("text"))
    return L.paragraph_groups(rows, ("doc_id",)).select("doc_id", "index", "group")


def _visual(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Blocks of a page seen again: moved a little, their text with a character lost, some with another text or as a table's markup; and page-wide ones."""
    regions = D.regions(D.lines(spark, folder, stated=True))
    shift = F.col("seq") % 4
    text = F.when(F.col("seq") % 7 == 2, F.concat(F.lit("<Table><tr><td>"), F.reverse("content"))).when(F.col("seq") % 5 == 0, F.reverse("content")).when(F.col("seq") % 3 == 0, F.lit("entirely new words")).otherwise(F.substring("content", 2, 1 << 30))
    near = regions.where("seq % 2 = 0").select(*D.PAGE, F.col("region_id").alias("block_id"), *[(F.col(c) + shift * 40).alias(c) for c in ("x0", "x1")], *[(F.col(c) + shift * 3).alias(c) for c in ("y0", "y1")], text.alias("content"))
    wide = regions.groupBy(*D.PAGE).agg(F.min("x0").alias("x0"), F.max("x1").alias("x1"), F.min("y0").alias("y0"), F.max("y1").alias("y1"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "content"))), lambda s: s["content"]), "\n").alias("content"))
    return near.unionByName(wide.withColumn("block_id", F.lit("wide"))), regions.withColumn("has_table", (F.col("doc_id") % 2 == 0) & (F.col("seq") == 1))


def novel_block_filter(spark: SparkSession, folder: str) -> DataFrame:
    visual, structured = _visual(spark, folder)
    return L.novel_blocks(visual, structured).select("doc_id", "page_no", "block_id", "duplicate")


def render_text(spark: SparkSession, folder: str) -> DataFrame:
    lines = D.lines(spark, folder)
    return L.render_text(D.regions(lines).withColumnRenamed("region_id", "block_id"), lines).select("doc_id", "page_no", "block_id", "render_text")


def adjacent_repeat_removal(spark: SparkSession, folder: str) -> DataFrame:
    """Every third line is read twice in a row."""
    lines = D.lines(spark, folder).select("doc_id", "page_no", "i", "text")
    twice = lines.withColumn("n", F.explode(F.when(F.col("i") % 3 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    rows = twice.select("doc_id", "page_no", (F.col("i") * 2 + F.col("n")).alias("pos"), "text")
    whole = lines.groupBy("doc_id", "page_no").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "text"))), lambda s: s["text"]), "\n").alias("text"))
    return L.drop_adjacent_repeats(rows, whole, D.PAGE)


def percent_rectangles(spark: SparkSession, folder: str) -> DataFrame:
    found = L.percent_boxes(D.regions(D.lines(spark, folder)), F.lit(900), F.lit(940))
    return found.select("doc_id", "page_no", "region_id", *[F.round(c, 4).alias(c) for c in ("px", "py", "pw", "ph")])


def running_page_numbers(spark: SparkSession, folder: str) -> DataFrame:
    pages = D.lines(spark, folder).select("doc_id", "page_no").distinct().withColumns({"ad_group": F.expr("doc_id div 5"), "file_no": F.col("doc_id") % 5})
    return L.running_pages(pages, "ad_group").select("doc_id", "page_no", "ad_group", "run_no")


def object_census(spark: SparkSession, folder: str) -> DataFrame:
    """Regions as page objects: every third an image, the others paths."""
    objects = D.regions(D.lines(spark, folder)).withColumn("kind", F.when(F.col("seq") % 3 == 0, "image").otherwise("path"))
    found = L.object_census(objects, F.lit(400000))
    return found.select("doc_id", "page_no", F.round("image_ratio", 6).alias("image_ratio"), F.round("path_ratio", 6).alias("path_ratio"), "path_count")


def native_dpi(spark: SparkSession, folder: str) -> DataFrame:
    images = D.regions(D.lines(spark, folder)).select(*D.PAGE, (F.col("x1") - F.col("x0")).alias("px"), (F.col("y1") - F.col("y0") + 200).alias("pt"))
    return L.native_dpi(images).select("doc_id", "page_no", F.round("dpi", 6).alias("dpi"))


QUERIES = {
    f.__name__: f
    for f in (
        triage_verdict, tile_decision, semantic_bands, band_crops, equal_mass_cuts, gap_segments, paragraph_groups, novel_block_filter, render_text,
        adjacent_repeat_removal, percent_rectangles, running_page_numbers, object_census, native_dpi,
    )
}

_N = "replace(lower(regexp_replace({0}, '\\s+', '', 'g')), 'ß', 'ss')"


def _cover(a: str, b: str) -> str:
    """Multiset coverage of a by b in SQL."""
    return (
        f"(case when length({a}) = 0 then 0 else list_sum(list_transform(list_distinct(string_split({a}, '')), "
        f"lambda c: case when c = '' then 0 else least(length({a}) - length(replace({a}, c, '')), length({b}) - length(replace({b}, c, ''))) end))::double / length({a}) end)"
    )


ORACLE_SQL = {
    "triage_verdict": """
with p as (select doc_id, regexp_replace(case when doc_id % 7 = 0 then regexp_replace(text, '[aeiou]', '�', 'g') when doc_id % 11 = 0 then substr(text, 1, 18) else text end, '\\s+', '', 'g') as d, doc_id % 5 / 4.0 as image_ratio from documents),
c as (select doc_id, length(d)::bigint as char_count, (length(d) - length(replace(d, '�', '')))::bigint as broken_count, image_ratio from p)
select doc_id, char_count, broken_count, case when char_count <= 20 then 'scan_like' when broken_count >= 8 and broken_count / char_count::double >= 0.3 then 'scan_like' when image_ratio >= 0.5 then 'hybrid' else 'structured' end as verdict from c""",
    "tile_decision": """
with p as (select doc_id, 800 + doc_id % 300 as width, 200 + n_chars as height from documents),
q as (select *, round_even(greatest(width, height)::double / greatest(1, least(width, height)), 3) as distortion, greatest(width, height) as n from p)
select doc_id, distortion, case when distortion <= 2.0 then 'whole' else 'split' end as decision, case when height >= width then 'y' else 'x' end as axis, 1600::bigint as span, 200::bigint as overlap,
  case when distortion <= 2.0 or n <= 1600 then 1 else len(generate_series(0::bigint, (greatest(n - 1600 - 200, 0) + 1399)::bigint // 1400)) end::bigint as pieces from q""",
    "semantic_bands": D.with_(
        "regions",
        """
b as (select r.*, 2 + doc_id % 3 as n, unnest(generate_series(1::bigint, 2 + doc_id % 3)) as band from regions r)
select doc_id, page_no, region_id, band from b
where (y0 + y1) / 2.0 >= round_even(960.0 * (band - 1) / n, 0) and (y0 + y1) / 2.0 < case when band < n then round_even(960.0 * band / n, 0) else 961 end""",
    ),
    "band_crops": """
with b as (select doc_id, n_chars + 100 as n, 2 + doc_id % 3 as k, unnest(generate_series(1::bigint, 2 + doc_id % 3)) as band from documents),
c as (select *, round_even((n * (band - 1))::double / k, 0)::bigint as start, round_even((n * band)::double / k, 0)::bigint as "end", least(200, greatest(60, floor(n * 0.03::double)))::bigint as m from b)
select doc_id, band, start, "end", greatest(0, start - m) as crop_start, least(n, "end" + m) as crop_end from c""",
    "equal_mass_cuts": D.with_(
        "lines",
        """
p as (select doc_id, page_no, y0 as pos, length(text) as m from lines),
r as (select *, sum(m) over (partition by doc_id, page_no order by pos) as run, sum(m) over (partition by doc_id, page_no) as whole from p),
k as (select *, unnest([1, 2, 3]) as k from r)
select doc_id, page_no, k::bigint as k, min(pos) as cut from k where whole > 0 and run * 4 >= k * whole group by all""",
    ),
    "gap_segments": D.with_(
        "lines",
        """
w as (select doc_id, page_no, i, generate_subscripts(string_split(text, ' '), 1) - 1 as pos from lines),
b as (select doc_id, page_no, i, pos, pos * 10 + (pos // 4) * (doc_id % 9) * 10 as x0 from w),
g as (select *, x0 - (lag(x0) over (partition by doc_id, page_no, i order by pos) + 9) as gap, greatest(9 * 4.0, 6.0) as lim from b)
select doc_id, page_no, i, pos, (sum(case when gap > lim then 1 else 0 end) over (partition by doc_id, page_no, i order by pos))::bigint as segment from g""",
    ),
    "paragraph_groups": """
with raw as (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as text, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 as index from documents),
r as (select doc_id, index, case when index % 6 = 4 then ' ' when index % 9 = 2 then '■ ' || text when index % 7 = 3 then '1. ' || text else text end as text from raw where index % 8 <> 7),
f as (select *, trim(text) = '' as blank, lag(index) over w as last, lag(trim(text) = '') over w as last_blank from r window w as (partition by doc_id order by index)),
o as (select *, not blank and (last is null or index <> last + 1 or last_blank or regexp_matches(text, '^\\s*(?:[▶▷►□■◆◇●○◎◈★☆※☞✔❖]|\\d{1,2}[.)]\\s|[가-하][.)]\\s)')) as opens from f),
s as (select *, sum(case when opens then 1 else 0 end) over (partition by doc_id order by index) as g from o)
select doc_id, index, g::bigint as "group" from s where not blank""",
    "novel_block_filter": D.with_(
        "regions",
        f"""
vis as (
  select doc_id, page_no, region_id as block_id, x0 + (seq % 4) * 40 as x0, x1 + (seq % 4) * 40 as x1, y0 + (seq % 4) * 3 as y0, y1 + (seq % 4) * 3 as y1,
         case when seq % 7 = 2 then '<Table><tr><td>' || reverse(content) when seq % 5 = 0 then reverse(content) when seq % 3 = 0 then 'entirely new words' else substr(content, 2) end as content from regions where seq % 2 = 0
  union all
  select doc_id, page_no, 'wide', min(x0), max(x1), min(y0), max(y1), string_agg(content, chr(10) order by seq) from regions group by doc_id, page_no
),
met as (
  select v.doc_id, v.page_no, v.block_id, {_N.format("v.content")} as said, {_N.format("s.content")} as known,
    greatest(0, least(v.x1, s.x1) - greatest(v.x0, s.x0))::double / greatest(1, least(v.x1 - v.x0, s.x1 - s.x0)) as x,
    greatest(0, least(v.y1, s.y1) - greatest(v.y0, s.y0))::double / greatest(1, least(v.y1 - v.y0, s.y1 - s.y0)) as y,
    greatest(1, (v.x1 - v.x0) * (v.y1 - v.y0)) as va, greatest(1, (s.x1 - s.x0) * (s.y1 - s.y0)) as sa,
    greatest(0, least(v.x1, s.x1) - greatest(v.x0, s.x0)) * greatest(0, least(v.y1, s.y1) - greatest(v.y0, s.y0)) as both_
  from vis v join regions s on v.doc_id = s.doc_id and v.page_no = s.page_no
),
cov as (select *, {_cover("said", "known")} as c1, {_cover("known", "said")} as c2 from met where x >= 0.8 and y >= 0.8),
per as (
  select doc_id, page_no, block_id,
    bool_or((x >= 0.95 and y >= 0.95 and least(va, sa)::double / greatest(va, sa) >= 0.75) or (said <> '' and known <> '' and contains(known, said))
      or (x >= 0.9 and y >= 0.9 and length(said) >= 8 and c1 >= 0.8 and (c2 >= 0.8 or c1 >= 0.85))) as pair,
    count_if(both_::double / sa >= 0.8 and known <> '') as inside, coalesce(string_agg(case when both_::double / sa >= 0.8 and known <> '' then known end, ''), '') as allk
  from cov group by all
),
j as (select v.*, {_N.format("v.content")} as said, p.pair, p.inside, coalesce(p.allk, '') as allk from vis v left join per p on v.doc_id = p.doc_id and v.page_no = p.page_no and v.block_id = p.block_id)
select doc_id, page_no, block_id, coalesce(pair or (inside >= 3 and length(said) >= 20 and {_cover("said", "allk")} >= 0.72), false)
  or (contains(lower(content), '<table') and exists (select 1 from regions r where r.doc_id = j.doc_id and r.page_no = j.page_no and r.doc_id % 2 = 0 and r.seq = 1)) as duplicate from j""",
    ),
    "render_text": D.with_(
        "lines regions",
        """
select r.doc_id, r.page_no, r.region_id as block_id, string_agg(trim(l.text), chr(10) order by l.y0, l.x0, trim(l.text)) as render_text
from regions r join lines l on r.doc_id = l.doc_id and r.page_no = l.page_no
where (l.x0 + l.x1) / 2.0 between r.x0 and r.x1 and (l.y0 + l.y1) / 2.0 between r.y0 and r.y1 group by r.doc_id, r.page_no, r.region_id""",
    ),
    "adjacent_repeat_removal": D.with_(
        "lines",
        f"""
w as (select doc_id, page_no, {_N.format("string_agg(text, chr(10) order by i)")} as whole from lines group by all),
t as (select doc_id, page_no, i * 2 as pos, text from lines union all select doc_id, page_no, i * 2 + 1, text from lines where i % 3 = 0),
b as (select t.*, {_N.format("t.text")} as k, lag({_N.format("t.text")}) over (partition by t.doc_id, t.page_no order by pos) as prev, w.whole from t join w on t.doc_id = w.doc_id and t.page_no = w.page_no)
select doc_id, page_no, pos from b where not coalesce(prev = k and length(k) >= 8 and (length(whole) - length(replace(whole, k, ''))) = length(k), false)""",
    ),
    "percent_rectangles": D.with_(
        "regions",
        """
p as (select doc_id, page_no, region_id, greatest(0.0, least(100.0, x0 * 100.0::double / 900)) as a, greatest(0.0, least(100.0, y0 * 100.0::double / 940)) as b,
  greatest(0.0, least(100.0, x1 * 100.0::double / 900)) as c, greatest(0.0, least(100.0, y1 * 100.0::double / 940)) as d from regions)
select doc_id, page_no, region_id, round(a, 4) as px, round(b, 4) as py, round(c - a, 4) as pw, round(d - b, 4) as ph from p where c - a > 0 and d - b > 0""",
    ),
    "running_page_numbers": D.with_("lines", "p as (select distinct doc_id, page_no, doc_id // 5 as ad_group from lines) select doc_id, page_no, ad_group, row_number() over (partition by ad_group order by doc_id % 5, page_no) as run_no from p"),
    "object_census": D.with_(
        "regions",
        """
select doc_id, page_no, round(least(1.0, sum(case when seq % 3 = 0 then (x1 - x0) * (y1 - y0) else 0 end)::double / 400000), 6) as image_ratio,
  round(sum(case when seq % 3 <> 0 then (x1 - x0) * (y1 - y0) else 0 end)::double / 400000, 6) as path_ratio, count_if(seq % 3 <> 0) as path_count from regions group by doc_id, page_no""",
    ),
    "native_dpi": D.with_("regions", "select doc_id, page_no, round(greatest(72.0, least(200.0, max((x1 - x0)::double / (y1 - y0 + 200) * 72.0))), 6) as dpi from regions group by doc_id, page_no"),
}
