"""Queries over lines and regions of pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import assign
from ..sources import derived as D


def _page(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    lines = D.lines(spark, folder)
    return lines, D.regions(lines)


def _chosen(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    lines, regions = _page(spark, folder)
    owned = assign.with_owner(lines, regions)
    texts = assign.assembled(owned.where("region_id is not null"))
    # a recognised block loses its first character where its number says so: some blocks miss a line
    blocks = regions.withColumn("content", F.when(F.col("seq") % 4 == 0, F.substring("content", 2, 1 << 30)).when(F.col("seq") % 9 == 0, F.lit("")).otherwise(F.col("content"))).withColumn("block_source", F.when(F.col("seq") % 5 == 0, "document_processor_html"))
    return assign.choose_text(blocks, texts), owned


def line_region_assignment(spark: SparkSession, folder: str) -> DataFrame:
    lines, regions = _page(spark, folder)
    return assign.with_owner(lines, regions).select("doc_id", "page_no", "i", "region_id", "overlap")


def unassigned_lines(spark: SparkSession, folder: str) -> DataFrame:
    lines, regions = _page(spark, folder)
    return assign.with_owner(lines, regions).where("region_id is null").select("doc_id", "page_no", "i")


def covered_line_antijoin(spark: SparkSession, folder: str) -> DataFrame:
    lines = D.lines(spark, folder, stated=True)
    moved = lines.where("i % 3 <> 2").withColumns({"source": F.lit("ocr"), "y0": F.col("y0") + (F.col("i") % 5) * 4, "y1": F.col("y1") + (F.col("i") % 5) * 4})
    return assign.canonical_lines(lines.where("i % 2 = 0"), moved).select("doc_id", "page_no", "i", "source", "line_id")


def region_parent_links(spark: SparkSession, folder: str) -> DataFrame:
    return assign.parents(_page(spark, folder)[1]).select("doc_id", "page_no", "region_id", "parent_id")


def region_child_links(spark: SparkSession, folder: str) -> DataFrame:
    found = assign.children(assign.parents(_page(spark, folder)[1]))
    return found.select("doc_id", "page_no", "region_id", F.array_join("child_ids", ",").alias("child_ids"))


def region_text_assembly(spark: SparkSession, folder: str) -> DataFrame:
    lines, regions = _page(spark, folder)
    owned = assign.with_owner(lines, regions).where("region_id is not null")
    return assign.assembled(owned).select("doc_id", "page_no", "region_id", "line_text", "n_lines", F.round("digital_share", 4).alias("digital_share"))


def canonical_text_choice(spark: SparkSession, folder: str) -> DataFrame:
    return _chosen(spark, folder)[0].select("doc_id", "page_no", "region_id", "text", "text_source", "gap_lines")


def selection_status(spark: SparkSession, folder: str) -> DataFrame:
    """With the sequence matcher of Arrow functions: rows only."""
    lines, regions = _page(spark, folder)
    owned = assign.with_owner(lines, regions).where("region_id is not null")
    agreement = T.seq_ratio(T.no_space_lower(F.col("content")), T.no_space_lower(F.col("line_text")))
    found = assign.choose_text(regions.withColumn("block_source", F.lit(None).cast("string")), assign.assembled(owned), agreement)
    return found.select("doc_id", "page_no", "region_id", "text_source", "selection_status")


def page_diagnostics(spark: SparkSession, folder: str) -> DataFrame:
    return assign.page_diagnostics(*_chosen(spark, folder))


def review_priority(spark: SparkSession, folder: str) -> DataFrame:
    return assign.review_priority(page_diagnostics(spark, folder))


def run_totals(spark: SparkSession, folder: str) -> DataFrame:
    return assign.run_totals(page_diagnostics(spark, folder))


def garbled_text_layer(spark: SparkSession, folder: str) -> DataFrame:
    """The data has no Hangul; Latin letters with accents stand for the script."""
    return assign.garbled_layer(D.lines(spark, folder), "[éèêçñóí]", 5, 0.9)


def line_refs(spark: SparkSession, folder: str) -> DataFrame:
    lines, regions = _page(spark, folder)
    owned = assign.with_owner(lines, regions)
    from pyspark.sql import Window

    nr = F.row_number().over(Window.partitionBy("doc_id", "page_no", F.coalesce("region_id", F.lit(""))).orderBy("y0", "x0", "i")) - 1
    place = F.coalesce("region_id", F.lit("unassigned"))
    return owned.select("doc_id", "page_no", "i", F.format_string("p%d/%s/L%03d", "page_no", place, nr).alias("line_ref"))


QUERIES = {
    f.__name__: f
    for f in (
        line_region_assignment, unassigned_lines, covered_line_antijoin, region_parent_links, region_child_links, region_text_assembly, canonical_text_choice,
        selection_status, page_diagnostics, review_priority, run_totals, garbled_text_layer, line_refs,
    )
}

_NORM = "replace(lower(regexp_replace({0}, '\\s+', '', 'g')), 'ß', 'ss')"
_TEXTS = f"""
lt as (
  select doc_id, page_no, region_id, coalesce(string_agg(case when trim(text) <> '' then trim(text) end, chr(10) order by y0, x0, i), '') as line_text, count(*) as n_lines,
         sum(case when source = 'digital' then length({_NORM.format("text")}) else 0 end)::double / nullif(sum(length({_NORM.format("text")})), 0) as digital_share,
         bool_or(source = 'digital') as has_digital
  from owned group by doc_id, page_no, region_id
)"""
_CHOSEN = f"""{_TEXTS},
bl as (select doc_id, page_no, region_id, seq, case when seq % 4 = 0 then substr(content, 2) when seq % 9 = 0 then '' else content end as content,
       case when seq % 5 = 0 then 'document_processor_html' end as bs from regions),
miss as (
  select o.doc_id, o.page_no, o.region_id, count(*) as n from owned o join bl b on o.doc_id = b.doc_id and o.page_no = b.page_no and o.region_id = b.region_id
  where length({_NORM.format("o.text")}) >= 2 and not contains({_NORM.format("b.content")}, {_NORM.format("o.text")}) group by all
),
ch0 as (
  select b.doc_id, b.page_no, b.region_id, b.content, b.bs, coalesce(l.line_text, '') as line_text, coalesce(l.digital_share, 0) as ds, coalesce(l.has_digital, false) as hd, coalesce(m.n, 0) as n_miss
  from bl b left join lt l on b.doc_id = l.doc_id and b.page_no = l.page_no and b.region_id = l.region_id
  left join miss m on b.doc_id = m.doc_id and b.page_no = m.page_no and b.region_id = m.region_id
),
ch as (
  select *, case when content <> '' and line_text <> '' then
      case when bs is not null then bs when ds >= 0.5 then 'digital_ocr_lines' when hd then 'ocr_digital_lines' when n_miss > 0 then 'ocr_lines_block_incomplete' else 'block_content' end
    when content <> '' then coalesce(bs, 'block_content')
    when line_text <> '' then case when ds >= 0.5 then 'digital_ocr_fallback' when hd then 'ocr_digital_fallback' else 'ocr_fallback' end
    else 'empty' end as text_source
  from ch0
),
chosen as (
  select doc_id, page_no, region_id, case when content <> '' and (text_source = bs or text_source = 'block_content') then content else line_text end as text, text_source, content from ch
),
gaps as (
  select c.doc_id, c.page_no, c.region_id, count(*) as n from owned o join chosen c on o.doc_id = c.doc_id and o.page_no = c.page_no and o.region_id = c.region_id
  where c.content <> '' and length({_NORM.format("o.text")}) >= 2 and not contains({_NORM.format("c.text")}, {_NORM.format("o.text")}) group by all
),
final as (select c.*, coalesce(g.n, 0) as gap_lines from chosen c left join gaps g on c.doc_id = g.doc_id and c.page_no = g.page_no and c.region_id = g.region_id)"""
_DIAGNOSTICS = _CHOSEN + """,
pr as (
  select doc_id, page_no, count(*) as regions, count_if(text_source = 'block_content') as block_content_regions,
         count_if(text_source like '%\\_fallback' escape '\\' and text <> '') as fallback_regions, count_if(text_source = 'empty') as empty_regions, sum(gap_lines) as gap_lines
  from final group by all
),
pl as (
  select l.doc_id, l.page_no, count_if(l.source = 'ocr') as ocr_lines, count_if(l.source = 'digital') as digital_lines, count(*) as canonical_lines, count_if(o.i is null) as unassigned_lines
  from lines l left join owned o on l.doc_id = o.doc_id and l.page_no = o.page_no and l.i = o.i group by all
),
diag as (
  select pl.*, coalesce(regions, 0) as regions, coalesce(block_content_regions, 0) as block_content_regions, coalesce(fallback_regions, 0) as fallback_regions,
         coalesce(empty_regions, 0) as empty_regions, coalesce(gap_lines, 0)::bigint as gap_lines, case when digital_lines > 0 then 'digital_primary' else 'ocr_only' end as route
  from pl left join pr on pl.doc_id = pr.doc_id and pl.page_no = pr.page_no
)"""
_PARENTS = """
par as (
  select * from (
    select a.doc_id, a.page_no, a.region_id, a.seq, b.region_id as parent_id,
           row_number() over (partition by a.doc_id, a.page_no, a.region_id order by (b.x1 - b.x0) * (b.y1 - b.y0), b.seq) as rn
    from regions a join regions b on a.doc_id = b.doc_id and a.page_no = b.page_no and b.x0 <= a.x0 and b.y0 <= a.y0 and b.x1 >= a.x1 and b.y1 >= a.y1
      and (b.x1 - b.x0) * (b.y1 - b.y0) > (a.x1 - a.x0) * (a.y1 - a.y0)
  ) where rn = 1
)"""

ORACLE_SQL = {
    "line_region_assignment": D.with_("lines owned", "select l.doc_id, l.page_no, l.i, o.region_id, o.ov as overlap from lines l left join owned o on l.doc_id = o.doc_id and l.page_no = o.page_no and l.i = o.i"),
    "unassigned_lines": D.with_("lines owned", "select doc_id, page_no, i from lines l where not exists (select 1 from owned o where o.doc_id = l.doc_id and o.page_no = l.page_no and o.i = l.i)"),
    "covered_line_antijoin": D.with_(
        "lines",
        """
dig as (select doc_id, page_no, i, 'digital' as source, x0, y0, x1, y1 from lines where i % 2 = 0),
ocr as (select doc_id, page_no, i, 'ocr' as source, x0, y0 + (i % 5) * 4 as y0, x1, y1 + (i % 5) * 4 as y1 from lines where i % 3 <> 2),
both_ as (select *, 0 as rank from dig union all select *, 1 from ocr o where not exists (
  select 1 from dig d where d.doc_id = o.doc_id and d.page_no = o.page_no
    and (greatest(0, least(o.x1, d.x1) - greatest(o.x0, d.x0)) * greatest(0, least(o.y1, d.y1) - greatest(o.y0, d.y0)))::double / greatest(1, (o.x1 - o.x0) * (o.y1 - o.y0)) >= 0.5))
select doc_id, page_no, i, source, printf('p%d_l%04d', page_no, row_number() over (partition by doc_id, page_no order by y0, x0, rank, i)) as line_id from both_""",
    ),
    "region_parent_links": D.with_("regions", f"{_PARENTS} select r.doc_id, r.page_no, r.region_id, p.parent_id from regions r left join par p on r.doc_id = p.doc_id and r.page_no = p.page_no and r.region_id = p.region_id"),
    "region_child_links": D.with_("regions", f"{_PARENTS} select doc_id, page_no, parent_id as region_id, string_agg(region_id, ',' order by seq) as child_ids from par group by all"),
    "region_text_assembly": D.with_("owned", f"{_TEXTS} select doc_id, page_no, region_id, line_text, n_lines, round(digital_share, 4) as digital_share from lt"),
    "canonical_text_choice": D.with_("owned", f"{_CHOSEN} select doc_id, page_no, region_id, text, text_source, gap_lines from final"),
    "page_diagnostics": D.with_("owned", f"{_DIAGNOSTICS} select * from diag"),
    "review_priority": D.with_("owned", f"{_DIAGNOSTICS} select doc_id, page_no, unassigned_lines, gap_lines, unassigned_lines + gap_lines as weight from diag order by weight desc, unassigned_lines desc, doc_id, page_no limit 15"),
    "run_totals": D.with_(
        "owned",
        f"{_DIAGNOSTICS} select count(*) as pages, count(distinct doc_id) as documents, "
        + ", ".join(f"sum({c})::bigint as {c}" for c in ("regions", "block_content_regions", "fallback_regions", "empty_regions", "gap_lines", "ocr_lines", "digital_lines", "unassigned_lines"))
        + " from diag",
    ),
    "garbled_text_layer": D.with_(
        "lines",
        """
c as (select doc_id, page_no, source, len(regexp_extract_all(text, '[éèêçñóí]')) as n from lines),
p as (select doc_id, page_no, sum(case when source = 'ocr' then n else 0 end)::bigint as ocr_chars, sum(case when source = 'digital' then n else 0 end)::bigint as digital_chars from c group by all)
select *, ocr_chars >= 5 and digital_chars < 0.9 * ocr_chars as needs_ocr from p""",
    ),
    "line_refs": D.with_(
        "lines owned",
        """
o2 as (select l.doc_id, l.page_no, l.i, l.y0, l.x0, coalesce(o.region_id, 'unassigned') as place from lines l left join owned o on l.doc_id = o.doc_id and l.page_no = o.page_no and l.i = o.i)
select doc_id, page_no, i, printf('p%d/%s/L%03d', page_no, place, row_number() over (partition by doc_id, page_no, place order by y0, x0, i) - 1) as line_ref from o2""",
    ),
}
