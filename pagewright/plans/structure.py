"""Queries on source structure and on tables seen on the page."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import align, assign
from ..operators import structure as S
from ..operators import visual as V
from ..sources import derived as D


def _regions(spark: SparkSession, folder: str, stated: bool = False) -> DataFrame:
    return D.regions(D.lines(spark, folder, stated))


def structure_parse(spark: SparkSession, folder: str) -> DataFrame:
    """Documents written as a structure answer: odd lines paragraphs, even ones tables of one row, in every tenth of which a table is nested."""
    lines = D.lines(spark, folder)
    inner = F.concat(F.lit('{"type": "table", "table": {"cells": [[{"text": "inner '), "i", F.lit('"}]]}}'))
    cell = F.concat(F.lit('{"text": "cell '), "i", F.lit('", "colSpan": 2, "blocks": ['), F.when(F.col("i") % 10 == 0, inner).otherwise(""), F.lit("]}"))
    block = F.when(F.col("i") % 2 == 1, F.concat(F.lit('{"type": "paragraph", "pageNumber": '), "page_no", F.lit(', "text": " line '), "i", F.lit(' "}'))).otherwise(F.concat(F.lit('{"type": "table", "pageNumber": '), "page_no", F.lit(', "table": {"sourceId": "T'), "i", F.lit('", "cells": [['), cell, F.lit(', {"text": "", "rowSpan": 0}, null]]}}')))
    blocks = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", block.alias("b")))), lambda s: s["b"]), ", ")
    answers = lines.groupBy("doc_id").agg(F.concat(F.lit('{"fileType": "hwp", "blocks": ['), blocks, F.lit("]}")).alias("answer"))
    return S.structure_nodes(answers).select("doc_id", "page_no", "kind", "source_id", "parent_table", "row", "col", "col_span", "text")


def page_routes(spark: SparkSession, folder: str) -> DataFrame:
    lines = D.lines(spark, folder)
    per = lines.groupBy(*D.PAGE).agg(F.count_if(F.col("i") % 7 == 0).alias("blocks"), F.count_if((F.col("source") == "digital") & (F.col("doc_id") % 3 != 0)).alias("digital"))
    return per.select(*D.PAGE, S.page_route(F.col("blocks"), F.col("digital")).alias("route"))


def structure_lines(spark: SparkSession, folder: str) -> DataFrame:
    docs = D.table(spark, folder, "documents").select("doc_id", F.lit(0).alias("pos"), F.coalesce("text", F.lit("")).alias("text"))
    return S.source_lines(docs, ("doc_id",))


def structure_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """A page's regions against candidates that cover its upper half, or a few rows."""
    r = _regions(spark, folder).where("label = 'text'")
    half = r.where("y0 < 500").groupBy(*D.PAGE).agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "content"))), lambda s: s["content"]), "").alias("whole"))
    c = half.select(*D.PAGE, F.lit("half").alias("candidate_id"), "x0", "y0", "x1", "y1", F.when(F.col("doc_id") % 3 == 0, F.reverse("whole")).when(F.col("doc_id") % 3 == 1, F.translate("whole", "aeiou", "xxxxx")).otherwise(F.col("whole")).alias("text"))
    return S.repeats_structure(c, r.withColumnRenamed("content", "text"))


def source_replacement(spark: SparkSession, folder: str) -> DataFrame:
    """Owned lines as a region's evidence, one in eight lost; with the sequence matcher: no SQL, a test holds it against difflib."""
    lines = D.lines(spark, folder)
    r = D.regions(lines)
    owned = assign.assign_lines(lines, r).join(lines.select(*D.PAGE, "i", "text"), [*D.PAGE, "i"])
    texts = S.source_texts(owned.where("i % 8 <> 6").select(*D.PAGE, "region_id", F.col("i").alias("pos"), "text"))
    said = F.when(F.col("seq") % 3 == 0, F.replace("content", F.lit(" "), F.lit("  "))).when(F.col("seq") % 5 == 0, F.substring("content", 1, 25)).otherwise(F.col("content"))
    regions = r.select(*D.PAGE, "region_id", said.alias("text"), F.when(F.col("seq") % 2 == 0, "document_processor").otherwise("block_content").alias("text_source"))
    return S.replace_by_source(regions, texts).select(*D.PAGE, "region_id", "validation", "final_text", "final_source")


def table_attachment(spark: SparkSession, folder: str) -> DataFrame:
    """Regions' lines as cells of source tables, one lost or foreign here and there, their texts reversed or a character off; with the sequence matcher."""
    r = _regions(spark, folder, stated=True).where("label = 'text'").withColumnRenamed("content", "text")
    cells = r.select(*D.PAGE, F.format_string("t%d", "seq").alias("table_id"), F.explode(F.split("text", "\n")).alias("text")).withColumn("text", F.when(F.length("text") % 9 == 0, F.lit("something foreign")).otherwise(F.col("text")))
    tables = r.select(*D.PAGE, F.format_string("t%d", "seq").alias("table_id"), (F.col("seq") * 5).alias("slots"), F.when(F.col("seq") % 3 == 0, F.reverse("text")).when(F.col("seq") % 4 == 1, F.concat(F.substring("text", 2, 1 << 30), F.lit("7"))).otherwise(F.col("text")).alias("text"))
    return S.attach_tables(tables, cells, r.select(*D.PAGE, "region_id", "seq", "text"))


def table_candidates(spark: SparkSession, folder: str) -> DataFrame:
    r = _regions(spark, folder, stated=True).select(*D.PAGE, "region_id", "seq", F.when(F.col("seq") % 4 == 0, "Table").otherwise("text").alias("layout_label"), (F.col("seq") % 7 == 0).alias("has_table"))
    areas = r.select(*D.PAGE, F.col("region_id"), F.explode(F.array(F.expr("seq div 3"), F.expr("seq div 4 + 100"), F.col("seq") + 200)).alias("area_no"), (100 - F.col("seq")).alias("pos"))
    return V.candidates(r, areas).select(*D.PAGE, "candidate", "source", F.array_join("member_ids", ",").alias("member_ids"))


def _shared(spark: SparkSession, folder: str) -> DataFrame:
    """Regions and shifted repeats of some of them, of two products."""
    r = _regions(spark, folder, stated=True).select(*D.PAGE, "region_id", "seq", (F.col("seq") % 2).alias("product_id"), "x0", "y0", "x1", "y1", F.col("content").alias("text"), F.when(F.col("seq") % 3 == 0, "vlm_reader").when(F.col("seq") % 3 == 1, "digital_lines").otherwise("ocr").alias("text_source"))
    again = r.where("seq % 3 = 1").withColumns({"region_id": F.concat("region_id", F.lit("b")), "seq": F.col("seq") + 500, "product_id": F.expr("seq div 2 % 2"), "y1": F.col("y1") + F.col("seq") % 4 * 9, "text": F.when(F.col("seq") % 4 == 1, F.translate("text", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")).otherwise(F.substring("text", 3, 40))})
    return r.unionByName(again)


def table_overlap(spark: SparkSession, folder: str) -> DataFrame:
    return V.repeats_another(_shared(spark, folder))


def same_content(spark: SparkSession, folder: str) -> DataFrame:
    return V.first_of_same(_shared(spark, folder)).select(*D.PAGE, "region_id")


def member_merge(spark: SparkSession, folder: str) -> DataFrame:
    r = _shared(spark, folder)
    members = r.where("seq < 500 and seq % 5 < 3").select(*D.PAGE, F.expr("seq div 5").alias("candidate"), "region_id")
    return V.merge_members(r.drop("product_id"), members).select(*D.PAGE, "region_id", "x0", "y0", "x1", "y1", "text", "text_source", F.array_join("merged_from", ",").alias("merged_from"))


def table_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    s = F.col("seq")
    r = _regions(spark, folder)
    chosen = F.slice(F.array(F.lit("a"), F.lit("b")), F.lit(1), (s % 3).cast("int"))
    found = V.verdict(s % 5 != 0, (s % 10) / 10.0, chosen, F.when(s % 8 == 0, 2).otherwise(1), s % 11 == 0, F.when(s % 9 == 8, " ").otherwise(F.col("content")), s % 13 == 0)
    return r.select(*D.PAGE, "region_id", found.alias("verdict"))


_FONTS = ("ABCDEF+NanumGothicBold", "Batang-L", "OTMGothicM", "Malgun Black", "Serif-B", "Dotum", "HeavyType", None)


def bold_fonts(spark: SparkSession, folder: str) -> DataFrame:
    d = D.table(spark, folder, "documents").select("doc_id")
    font = F.element_at(F.array(*[F.lit(f) for f in _FONTS]), (F.col("doc_id") % 8 + 1).cast("int"))
    return d.select("doc_id", V.is_bold((F.expr("doc_id div 8") % 4 * 300).cast("int"), font).alias("bold"))


def line_styles(spark: SparkSession, folder: str) -> DataFrame:
    chars = D.lines(spark, folder).select(*D.PAGE, "i", F.posexplode(F.split("text", "")).alias("pos", "ch"))
    code = F.ascii("ch")
    c = chars.select(*D.PAGE, "i", "pos", (8 + code % 3).cast("double").alias("size"), (code % 11 == 0).alias("bold"), F.when(code % 5 > 0, F.element_at(F.array(*[F.lit(f"#{k:02X}0000") for k in range(4)]), code % 4 + 1)).alias("color"), F.when(code % 2 == 0, "F0").otherwise("F1").alias("font"))
    return V.line_styles(c, (*D.PAGE, "i")).select(*D.PAGE, "i", "size", "size_min", "size_max", "bold", "color", "font", F.array_join("colors", ",").alias("colors"))


def neighbour_repeats(spark: SparkSession, folder: str) -> DataFrame:
    """Every third region also says the line after it: rows only, for its normal form is Python's."""
    lines = D.lines(spark, folder)
    r = D.regions(lines).where("label = 'text'")
    owned = assign.with_owner(lines, r).withColumnRenamed("region_id", "owner")
    after = lines.select(*D.PAGE, (F.expr("(i % 40) div 3 * 2 - 2")).alias("ord"), F.when(F.col("i") % 3 == 0, F.col("text")).alias("next")).where("next is not null")
    said = r.withColumn("g", F.expr("y0 div 72 * 2")).join(after.withColumnRenamed("ord", "g"), [*D.PAGE, "g"], "left").withColumn("text", F.when(F.col("seq") % 3 == 0, F.concat_ws("\n", "content", "next")).otherwise(F.col("content")))
    return align.printed_twice(said.select(*D.PAGE, "region_id", "x0", "y0", "x1", "y1", "text"), owned)


QUERIES = {
    f.__name__: f
    for f in (
        structure_parse, page_routes, structure_lines, structure_duplicates, source_replacement, table_attachment, table_candidates, table_overlap, same_content, member_merge, table_verdicts, bold_fonts, line_styles, neighbour_repeats,
    )
}

_PL = "lower(regexp_replace({0}, '[^0-9a-zA-Z가-힣]', '', 'g'))"
_NS = "replace(lower(regexp_replace({0}, '\\s+', '', 'g')), 'ß', 'ss')"
_SHARED = """
sh as (
  select doc_id, page_no, region_id, seq, seq % 2 as product_id, x0, y0, x1, y1, content as text, case seq % 3 when 0 then 'vlm_reader' when 1 then 'digital_lines' else 'ocr' end as text_source from regions
  union all
  select doc_id, page_no, region_id || 'b', seq + 500, seq // 2 % 2, x0, y0, x1, y1 + seq % 4 * 9, case when seq % 4 = 1 then translate(content, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ') else substr(content, 3, 40) end, 'digital_lines' from regions where seq % 3 = 1
)"""
_INTER = "greatest(0, least(a.x1, b.x1) - greatest(a.x0, b.x0)) * greatest(0, least(a.y1, b.y1) - greatest(a.y0, b.y0))"


def _cover(a: str, b: str) -> str:
    return f"list_sum(list_transform(list_distinct(string_split({a}, '')), lambda c: case when c = '' then 0 else least(length({a}) - length(replace({a}, c, '')), length({b}) - length(replace({b}, c, ''))) end))::double / length({a})"


ORACLE_SQL = {
    "structure_parse": D.with_(
        "lines",
        """
l as (select * from lines)
select doc_id, page_no, 'paragraph' as kind, printf('p%d_para%04d', page_no, row_number() over (partition by doc_id order by i)) as source_id, null as parent_table, null::bigint as row, null::bigint as col, 1 as col_span, 'line ' || i as text from l where i % 2 = 1
union all select doc_id, page_no, 'cell', 'T' || i, null, 0, c, case when c = 0 then 2 else 1 end, case when c = 0 then 'cell ' || i else '' end from l, (values (0), (1), (2)) v(c) where i % 2 = 0
union all select doc_id, page_no, 'cell', 'T' || i || '_nested_0_0_1', 'T' || i, 0, 0, 1, 'inner ' || i from l where i % 10 = 0""",
    ),
    "page_routes": D.with_("lines", "p as (select doc_id, page_no, count_if(i % 7 = 0) as b, count_if(source = 'digital' and doc_id % 3 <> 0) as d from lines group by all) select doc_id, page_no, case when b = 0 and d = 0 then 'structured_fast' when b >= 3 then 'hybrid' else 'visual' end as route from p"),
    "structure_lines": f"""
with l as (select doc_id, trim(regexp_replace(unnest(string_split(coalesce(text, ''), chr(10))), '\\s+', ' ', 'g')) as line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as k from documents),
f as (select doc_id, line, min(k) as k from l where length({_PL.format("line")}) >= 4 group by all)
select doc_id, line, row_number() over (partition by doc_id order by k) as place from f""",
    "structure_duplicates": D.with_(
        "regions",
        f"""
r as (select * from regions where label = 'text'),
h as (select doc_id, page_no, min(x0) as x0, min(y0) as y0, max(x1) as x1, max(y1) as y1, string_agg(content, '' order by seq) as whole from r where y0 < 500 group by doc_id, page_no),
c as (select * exclude (whole), {_NS.format("case when doc_id % 3 = 0 then reverse(whole) when doc_id % 3 = 1 then translate(whole, 'aeiou', 'xxxxx') else whole end")} as own from h),
m as (select a.doc_id, a.page_no, a.own, {_NS.format("b.content")} as said from c a join r b on a.doc_id = b.doc_id and a.page_no = b.page_no where length(a.own) >= 20 and {_INTER} / greatest(1, (b.x1 - b.x0) * (b.y1 - b.y0))::double >= 0.8),
p as (select doc_id, page_no, own, count(*) as n, string_agg(said, '') as known from m where said <> '' group by doc_id, page_no, own)
select doc_id, page_no, 'half' as candidate_id from p where n >= 3 and {_cover("own", "known")} >= 0.72""",
    ),
    "table_attachment": D.with_(
        "regions",
        f"""
r as (select doc_id, page_no, region_id, seq, content as text, {_PL.format("content")} as k from regions where label = 'text'),
ce as (select doc_id, page_no, seq as t, unnest(string_split(text, chr(10))) as c from r),
ck as (select doc_id, page_no, t, {_PL.format("case when length(c) % 9 = 0 then 'something foreign' else c end")} as c from ce),
tb as (select doc_id, page_no, seq as t, {_PL.format("case when seq % 3 = 0 then reverse(text) when seq % 4 = 1 then substr(text, 2) || '7' else text end")} as sk, {_PL.format("substr(text, 2)")} as mid from r where seq * 5 between 2 and 30),
m as (select b.doc_id, b.page_no, b.t, a.region_id, a.seq, case when sk = '' or k = '' then 0 when contains(k, sk) or contains(sk, k) then 1 when a.seq = b.t and seq % 3 <> 0 and seq % 4 = 1 then 2.0 * length(mid) / (length(k) + length(sk)) else 0 end::double as s1,
  coalesce((select sum(case when contains(a.k, c) then length(c) else 0 end)::double / greatest(1, sum(length(c))) from ck where ck.doc_id = b.doc_id and ck.page_no = b.page_no and ck.t = b.t and c <> ''), 0) as s2,
  least(length(k), length(sk))::double / greatest(1, length(k), length(sk)) as bal from tb b join r a on a.doc_id = b.doc_id and a.page_no = b.page_no),
q as (select *, row_number() over (partition by doc_id, page_no, t order by greatest(s1, s2) desc, bal desc, seq) as rn from m where greatest(s1, s2) >= 0.8 and bal >= 0.55)
select doc_id, page_no, 't' || t as table_id, region_id from q where rn = 1""",
    ),
    "table_candidates": D.with_(
        "regions",
        """
f as (select doc_id, page_no, region_id, seq from regions where seq % 7 <> 0),
ar as (select doc_id, page_no, region_id, seq, unnest([seq // 3, seq // 4 + 100, seq + 200]) as nr from f),
c as (
  select doc_id, page_no, 'layout' as source, 0 as late, seq as nr, region_id as ids, region_id as key from f where seq % 4 = 0
  union all select doc_id, page_no, 'page', 1, nr, string_agg(region_id, ',' order by seq desc), string_agg(region_id, ',' order by region_id) from ar group by doc_id, page_no, nr),
d as (select *, row_number() over (partition by doc_id, page_no, key order by late, nr) as rn from c)
select doc_id, page_no, row_number() over (partition by doc_id, page_no order by late, nr) as candidate, source, ids as member_ids from d where rn = 1""",
    ),
    "table_overlap": D.with_("regions", f"{_SHARED} select distinct a.doc_id, a.page_no, a.region_id from sh a join sh b on a.doc_id = b.doc_id and a.page_no = b.page_no and a.product_id = b.product_id and a.region_id <> b.region_id where length({_NS.format('b.text')}) >= 8 and {_INTER} / greatest(1, (b.x1 - b.x0) * (b.y1 - b.y0))::double >= 0.85 and contains({_NS.format('a.text')}, {_NS.format('b.text')})"),
    "same_content": D.with_("regions", f"{_SHARED} select doc_id, page_no, region_id from sh a where not exists (select 1 from sh b where a.doc_id = b.doc_id and a.page_no = b.page_no and b.seq < a.seq and {_NS.format('a.text')} = {_NS.format('b.text')} and {_INTER} / greatest(1, least((a.x1 - a.x0) * (a.y1 - a.y0), (b.x1 - b.x0) * (b.y1 - b.y0)))::double >= 0.9)"),
    "member_merge": D.with_(
        "regions",
        f"""{_SHARED},
mm as (select *, seq // 5 as cand from sh where seq < 500 and seq % 5 < 3)
select doc_id, page_no, arg_min(region_id, seq) as region_id, min(x0) as x0, min(y0) as y0, max(x1) as x1, max(y1) as y1, coalesce(string_agg(case when trim(text) <> '' then trim(text) end, chr(10) order by y0, x0, seq), '') as text,
  case when bool_or(text_source like 'vlm%') then 'vlm_table_group' when bool_and(text_source like 'digital%') then 'digital_table_group' else 'ocr_table_group' end as text_source, string_agg(region_id, ',' order by seq) as merged_from from mm group by doc_id, page_no, cand
union all select doc_id, page_no, region_id, x0, y0, x1, y1, text, text_source, '' from sh where not (seq < 500 and seq % 5 < 3)""",
    ),
    "table_verdicts": D.with_(
        "regions",
        """select doc_id, page_no, region_id, case when seq % 5 = 0 or (seq % 10) / 10.0 < 0.7 or seq % 3 = 0 then 'no_table' when seq % 8 = 0 or seq % 11 = 0 then 'held_back' when seq % 3 = 1 and seq % 13 = 0 then 'table_region_overlap'
  when seq % 9 = 8 or trim(content) = '' then 'table_text_missing' else 'accepted' end as verdict from regions""",
    ),
    "bold_fonts": "with w as (select doc_id, doc_id % 8 as f, doc_id // 8 % 4 * 300 as w from documents) select doc_id, case when f in (0, 3, 4) then true when f in (1, 2, 5) then false when w > 0 then w >= 700 end as bold from w",
    "line_styles": D.with_(
        "lines",
        """
ch as (select doc_id, page_no, i, unnest(string_split(text, '')) as c, generate_subscripts(string_split(text, ''), 1) as pos from lines),
s as (select doc_id, page_no, i, pos, 8 + ascii(c) % 3 as size, ascii(c) % 11 = 0 as bold, case when ascii(c) % 5 > 0 then printf('#%02X0000', ascii(c) % 4) end as color, 'F' || (ascii(c) % 2) as font from ch),
cs as (select doc_id, page_no, i, 'size' as k, size::varchar as v, count(*) as n, min(pos) as p from s group by all union all select doc_id, page_no, i, 'color', color, count(*), min(pos) from s where color is not null group by doc_id, page_no, i, color union all select doc_id, page_no, i, 'font', font, count(*), min(pos) from s group by doc_id, page_no, i, font),
rk as (select doc_id, page_no, i, k, string_agg(v, ',' order by n desc, p) as vs from cs group by all),
ag as (select doc_id, page_no, i, min(size)::double as size_min, max(size)::double as size_max, bool_or(bold) as bold from s group by all)
select ag.*, string_split(z.vs, ',')[1]::double as size, string_split(c.vs, ',')[1] as color, string_split(f.vs, ',')[1] as font, c.vs as colors from ag
left join rk z on z.doc_id = ag.doc_id and z.page_no = ag.page_no and z.i = ag.i and z.k = 'size' left join rk c on c.doc_id = ag.doc_id and c.page_no = ag.page_no and c.i = ag.i and c.k = 'color' left join rk f on f.doc_id = ag.doc_id and f.page_no = ag.page_no and f.i = ag.i and f.k = 'font'""",
    ),
}
