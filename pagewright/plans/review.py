"""Queries on folds, alignment, readings and exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import align, assign, export, folds, reading
from ..sources import derived as D


def _regions(spark: SparkSession, folder: str) -> DataFrame:
    return D.regions(D.lines(spark, folder))


def tile_block_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Blocks of rows 360 to 600 are seen again in a second tile, a pixel or two off, some under another label."""
    r = _regions(spark, folder).select("doc_id", "page_no", F.col("seq").alias("pos"), F.col("region_id").alias("block_id"), F.lit(0).cast("long").alias("piece"), "label", "x0", "y0", "x1", "y1", ((F.col("seq") % 10) / 10.0).alias("score"), "content")
    again = r.where("y0 between 360 and 600").withColumns({"pos": F.col("pos") + 1000, "block_id": F.concat("block_id", F.lit("b")), "piece": F.lit(1).cast("long"), "y0": F.col("y0") - 1, "y1": F.col("y1") + F.col("pos") % 3, "label": F.when(F.col("pos") % 4 == 0, "figure").otherwise(F.col("label"))})
    return folds.tile_dedupe(r.unionByName(again))


def line_nms(spark: SparkSession, folder: str) -> DataFrame:
    n = D.lines(spark, folder).select("doc_id", "page_no", F.col("i").alias("pos"), F.format_string("a%d", "i").alias("line_id"), F.lit(0).cast("long").alias("piece"), ((F.col("i") % 7) / 10.0).alias("score"), "x0", "y0", "x1", "y1")
    again = n.where("pos % 40 between 18 and 22").withColumns({"line_id": F.replace("line_id", F.lit("a"), F.lit("b")), "piece": F.lit(1).cast("long"), "score": F.lit(0.35), "x1": F.col("x1") - 3})
    return folds.line_nms(n.unionByName(again))


def recovery_components(spark: SparkSession, folder: str) -> DataFrame:
    """Candidates of all lines that the assignment leaves without a region; every second region is taken away, so that neighbours are among them."""
    lines = D.lines(spark, folder)
    owned = assign.with_owner(lines, D.regions(lines).where("seq % 2 = 0"))
    return folds.recovery_components(owned.where("region_id is null"))


def row_cluster(spark: SparkSession, folder: str) -> DataFrame:
    """Words of lines as boxes at differing heights, in rows by three rules."""
    raw = D.lines(spark, folder).select("doc_id", "page_no", F.col("i").alias("line"), "y0", F.posexplode(F.split("text", " ")).alias("k", "w"))
    y0 = F.col("y0") + (F.col("k") * 5 + F.col("doc_id")) % 13
    boxes = raw.select("doc_id", "page_no", (F.shiftleft("line", 20) + F.col("k")).alias("i"), (F.col("k") * 50).cast("long").alias("x0"), y0.alias("y0"), (F.col("k") * 50 + 40).cast("long").alias("x1"), (y0 + 14).alias("y1"))
    return folds.row_clusters(boxes, by_last=folds.rows_by_last, by_first=folds.rows_by_first, by_middle=folds.rows_by_middle)


def read_chunks(spark: SparkSession, folder: str) -> DataFrame:
    return folds.read_chunks(_regions(spark, folder).select("doc_id", "page_no", "seq", F.length(T.no_space("content")).alias("size")))


def table_acceptance(spark: SparkSession, folder: str) -> DataFrame:
    """Overlapping runs of regions as table candidates."""
    r = _regions(spark, folder).select("doc_id", "page_no", "region_id", F.explode(F.expr("filter(array(seq div 2, (seq + 1) div 2, (seq + 1) div 3 + 50), x -> x > 0)")).alias("candidate"))
    return folds.table_acceptance(r.select("doc_id", "page_no", F.col("candidate").cast("long").alias("candidate"), "region_id"))


def visual_supplements(spark: SparkSession, folder: str) -> DataFrame:
    r = _regions(spark, folder)
    blank = F.lit(None).cast("string")
    tables = r.where("label = 'text'").select("doc_id", "page_no", F.lit("table").alias("kind"), F.col("seq").alias("pos"), F.col("region_id").alias("block_id"), "x0", "y0", "x1", "y1", "content", blank.alias("render"))
    render = F.when(F.col("i") % 3 == 0, blank).otherwise(F.concat(F.lit("note "), F.substring("text", 1, 20)))
    visual = D.lines(spark, folder).select("doc_id", "page_no", F.lit("visual").alias("kind"), F.col("i").alias("pos"), F.format_string("v%d", "i").alias("block_id"), "x0", "y0", "x1", "y1", F.when(F.col("i") % 2 == 0, F.reverse("text")).otherwise("9999 0000").alias("content"), render.alias("render"))
    return folds.supplements(tables.unionByName(visual))


def structure_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Lines as structure nodes, some garbled, against the page's regions."""
    lines = D.lines(spark, folder)
    text = F.when(F.col("i") % 9 == 4, F.reverse("text")).when(F.col("i") % 5 == 2, F.substring("text", 3, 1 << 30)).otherwise(F.col("text"))
    nodes = lines.select("doc_id", "page_no", F.col("i").alias("pos"), text.alias("text"), F.lit(True).alias("paragraph"))
    r = D.regions(lines).where("label = 'text'").select("doc_id", "page_no", F.col("seq").alias("pos"), F.col("region_id").alias("id"), F.col("content").alias("text"))
    return align.align_structure(r, nodes)


def structure_corroboration(spark: SparkSession, folder: str) -> DataFrame:
    lines = D.lines(spark, folder)
    text = F.when(F.col("i") % 6 == 5, F.reverse("text")).otherwise(F.col("text"))
    nodes = lines.where("i % 11 <> 3").select("doc_id", "page_no", text.alias("text"))
    return align.corroborated(D.regions(lines).select("doc_id", "page_no", "region_id", F.col("content").alias("text")), nodes)


def page_repartition(spark: SparkSession, folder: str) -> DataFrame:
    """Lines as nodes declared on page 1."""
    lines = D.lines(spark, folder)
    pages = lines.groupBy("doc_id", "page_no").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "text"))), lambda s: s["text"]), "\n").alias("text"))
    return align.place_on_pages(lines.select("doc_id", F.col("i").alias("pos"), F.lit(1).cast("long").alias("declared"), "text"), pages)


def digital_anchoring(spark: SparkSession, folder: str) -> DataFrame:
    """Region texts with digits misread and lines lost, against the page's lines."""
    lines = D.lines(spark, folder)
    money = F.concat("text", F.lit(" 연 "), (F.col("doc_id") % 90 + 10).cast("string"), F.lit(".5% 예금자보호안내"))
    layer = lines.withColumn("text", F.when(F.col("i") % 5 == 0, money).otherwise(F.col("text")))
    said = F.when(F.col("seq") % 6 == 0, F.lit("")).when(F.col("seq") % 3 == 0, F.concat(F.substring_index("content", "\n", 1), F.lit(" 연 "), (F.col("doc_id") % 90 + 10).cast("string"), F.lit(".6% 예금자보흐안내"))).otherwise(F.col("content"))
    r = D.regions(lines).withColumns({"text": said, "text_source": F.when(F.col("seq") % 10 == 9, "hwp_structure").otherwise("block_content")})
    return align.anchor_pages(r, layer)


def _read(spark: SparkSession, folder: str) -> DataFrame:
    """Regions with readings and judgements by rule: same, spaced otherwise, a character off, blank, judged."""
    s, c = F.col("seq"), F.col("content")
    reader = F.when(s % 8 == 7, "  ").when(s % 4 == 1, F.replace(c, F.lit(" "), F.lit("  "))).when(s % 4 == 2, F.concat(F.lit("龘"), F.substring(c, F.lit(1), F.length(c) - 1))).otherwise(c)
    source = F.when(s % 5 == 0, "digital_ocr_lines").when(s % 7 == 0, "document_processor").otherwise("block_content")
    return _regions(spark, folder).select(
        "doc_id", "page_no", "region_id", "seq", F.when(s % 11 == 0, "").otherwise(c).alias("text"), source.alias("text_source"), (s % 13 == 0).alias("structure_agrees"), c.alias("structure_text"),
        F.when(s % 6 == 0, (s % 10) / 10.0).alias("digital_share"), reader.alias("reader_text"), F.when(s % 3 == 0, F.concat(F.lit("새로운 단어 "), F.substring(c, 1, 20))).alias("judge_text"), ((s * 3) % 10 / 10.0).alias("judge_confidence"),
    )


def apply_reading(spark: SparkSession, folder: str) -> DataFrame:
    """With the sequence matcher. A reading has the text's characters, or all but the last and one more before them: SQL can say what the matcher gives."""
    return reading.apply_reading(_read(spark, folder)).select("doc_id", "page_no", "region_id", "final_text", "final_source", "reading_status", "flag")


def similarity_judge(spark: SparkSession, folder: str) -> DataFrame:
    r = _read(spark, folder).select("doc_id", "page_no", "region_id", reading.agreement(F.col("text"), F.col("reader_text")).alias("agreement"), T.nfkc_alnum(F.col("text")).alias("a"), T.nfkc_alnum(F.col("reader_text")).alias("b"))
    return r.select("doc_id", "page_no", "region_id", "agreement", reading.needs_judge(F.col("agreement"), F.col("a"), F.col("b")).alias("needs_judge"))


def ocr_review_codes(spark: SparkSession, folder: str) -> DataFrame:
    r = _read(spark, folder).withColumnRenamed("text", "parser_text").withColumns({"reading_status": F.when(F.trim("reader_text") == "", "vlm_blank").otherwise("agree"), "fallback": F.col("seq") % 10 == 4})
    final = F.when(F.col("seq") % 9 == 2, F.concat("parser_text", F.lit(" 31,5"))).otherwise(F.coalesce("judge_text", "reader_text"))
    return reading.review_codes(r.withColumn("text", final)).select("doc_id", "page_no", "region_id", F.array_join("codes", ",").alias("codes"))


def reading_status_counts(spark: SparkSession, folder: str) -> DataFrame:
    return reading.status_counts(reading.apply_reading(_read(spark, folder)), ("doc_id",))


def read_scope(spark: SparkSession, folder: str) -> DataFrame:
    r = _read(spark, folder).withColumns({"has_box": F.col("seq") % 17 != 0, "kind": F.when(F.col("seq") % 12 == 0, "table"), "selection_status": F.when(F.col("seq") % 5 == 1, "conflict_pending_vlm"), "n_lines": F.col("seq") % 4})
    return r.select("doc_id", "page_no", "region_id", *[reading.should_read(s).alias(s) for s in ("all", "targeted", "off")])


def clean_answers(spark: SparkSession, folder: str) -> DataFrame:
    d = F.col("doc_id")
    text = F.concat(F.coalesce("text", F.lit("")), F.when(d % 3 == 0, '"} (Note: more talk "] and').when(d % 3 == 1, ' "] tail').otherwise(""))
    return D.table(spark, folder, "documents").select("doc_id", reading.clean_answer(text).alias("text"))


def text_source_rollup(spark: SparkSession, folder: str) -> DataFrame:
    names = ("vlm_judge", "digital_ocr_lines", "hwp_structure_cells", "document_processor_html_with_render_text", "document_processor", "ocr_fallback", "block_content")
    source = F.element_at(F.array(*[F.lit(x) for x in names]), (F.col("seq") % 7 + 1).cast("int"))
    return _regions(spark, folder).groupBy("doc_id", export.source_grade(source).alias("source")).agg(F.count("*").alias("n"))


def _exported(spark: SparkSession, folder: str) -> DataFrame:
    r = _regions(spark, folder)
    s = F.col("seq")
    labels = F.filter(F.array(F.when(s % 3 == 0, " a "), F.lit("a"), F.when(s % 4 == 0, "b"), F.lit("  ")), lambda x: x.isNotNull())
    return export.review_regions(r.select("doc_id", "page_no", "region_id", s.alias("page_order"), (s % 5 != 0).alias("has_box"), F.when(s % 10 == 0, "  ").otherwise(F.col("content")).alias("text"), F.when(s % 2 == 0, "vlm_reader").otherwise("ocr").alias("text_source"), labels.alias("labels"), F.when(s % 9 == 0, "table").alias("kind"), (s % 14 == 0).alias("has_table"), F.concat(F.lit("product_"), (s % 2).cast("string")).alias("product_id")))


def p3_export(spark: SparkSession, folder: str) -> DataFrame:
    return export.checked(_exported(spark, folder)).select("doc_id", "page_no", "region_id", "text", "source", F.array_join("labels", ",").alias("labels"), "kind", "product_id")


def p3_records(spark: SparkSession, folder: str) -> DataFrame:
    return export.review_documents(_exported(spark, folder))


def p1_summary(spark: SparkSession, folder: str) -> DataFrame:
    return export.summary(_exported(spark, folder))


def export_id_check(spark: SparkSession, folder: str) -> DataFrame:
    """Region ids without their pages clash; some are out of form."""
    r = _regions(spark, folder).select("doc_id", F.when(F.col("seq") % 8 == 0, F.lit("r1")).otherwise(F.format_string("p1_r%03d", "seq")).alias("region_id"))
    return export.bad_ids(r)


def model_call_stats(spark: SparkSession, folder: str) -> DataFrame:
    e = D.table(spark, folder, "events")
    calls = e.select(F.col("event_type").alias("schema"), (F.col("event_id") % 3 == 0).alias("cached"), F.round(F.abs("value") * 100).cast("long").alias("seconds"), (1 + F.col("event_id") % 3).alias("attempts"), (F.col("event_id") % 50 == 0).alias("timed_out"))
    return export.call_stats(calls)


def request_keys(spark: SparkSession, folder: str) -> DataFrame:
    t = D.table(spark, folder, "conversations")
    return t.select("conv_id", "turn", export.request_key([F.col("text")], [F.concat(F.lit("data:image/png;base64,"), F.base64(F.encode("role", "UTF-8")))], F.lit("labels"), F.lit('{"type": "object"}'), F.lit(900), F.lit("m")).alias("key"))


def answer_parsing(spark: SparkSession, folder: str) -> DataFrame:
    """Events' JSON, some with a stray backslash, some in a code fence, some broken for good."""
    e = D.table(spark, folder, "events")
    raw = F.when(F.col("event_id") % 20 == 1, F.replace("props", F.lit('"k"'), F.lit('\\q"k"'))).when(F.col("event_id") % 20 == 2, F.concat(F.lit("```json\n"), "props", F.lit("\n```"))).when(F.col("event_id") % 20 == 3, F.lit("{broken")).otherwise(F.col("props"))
    found = export.parsed(e.select("event_id", F.replace(raw, F.lit('\\q"k"'), F.lit('"\\k"')).alias("answer")), "k long")
    return found.select("event_id", F.col("parsed.k").alias("k"))


QUERIES = {
    f.__name__: f
    for f in (
        tile_block_dedup, line_nms, recovery_components, row_cluster, read_chunks, table_acceptance, visual_supplements, structure_alignment, structure_corroboration, page_repartition, digital_anchoring,
        apply_reading, similarity_judge, ocr_review_codes, reading_status_counts, read_scope, clean_answers, text_source_rollup, p3_export, p3_records, p1_summary, export_id_check, model_call_stats, request_keys, answer_parsing,
    )
}

_PL = "lower(regexp_replace({0}, '[^0-9a-zA-Z가-힣]', '', 'g'))"
_NS = "regexp_replace({0}, '\\s+', '', 'g')"
_N3 = "replace(lower(regexp_replace(nfc_normalize({0}), '[^\\p{{L}}\\p{{N}}]', '', 'g')), 'ß', 'ss')"
_READ = f"""
rd0 as (
  select doc_id, page_no, region_id, seq, case when seq % 11 = 0 then '' else content end as text, case when seq % 5 = 0 then 'digital_ocr_lines' when seq % 7 = 0 then 'document_processor' else 'block_content' end as src,
    seq % 13 = 0 as agrees, content as st, case when seq % 6 = 0 then (seq % 10) / 10.0::double end as share,
    case when seq % 8 = 7 then '  ' when seq % 4 = 1 then replace(content, ' ', '  ') when seq % 4 = 2 then '龘' || substr(content, 1, length(content) - 1) else content end as reader,
    coalesce(case when seq % 3 = 0 then '새로운 단어 ' || substr(content, 1, 20) end, '') as judge, (seq * 3) % 10 / 10.0::double as jc from regions
),
rd as (
  select *, case when {_NS.format("judge")} <> '' then judge else reader end as final,
    text <> '' and (src = 'document_processor' or agrees or coalesce(share >= 0.5, src = 'digital_ocr_lines')) as dig from rd0
),
rn as (select *, {_N3.format("text")} as na, {_N3.format("reader")} as nb, {_N3.format("substr(text, 1, length(text) - 1)")} as common from rd),
ra as (
  select *, case when na = nb then 1.0 when na = '' or nb = '' then 0.0 when seq % 8 = 7 or seq % 4 <> 2 then 0.0
    -- from 200 characters on a match begins at characters that are one in a hundred and rarer
    when length(nb) >= 200 and len(list_filter(list_distinct(string_split(common, '')), lambda c: c <> '' and length(nb) - length(replace(nb, c, '')) <= length(nb) // 100 + 1)) = 0 then 0.0
    else 2.0 * length(common) / (length(na) + length(nb)) end::double as agreed from rn
),
rs as (
  select *, case when {_NS.format("reader")} = '' then 'vlm_blank' when dig and {_NS.format("text")} = {_NS.format("final")} then 'parser_verified' when dig and agrees then 'parser_verified_by_hwp_structure' when dig then 'parser_preserved'
    when judge <> '' then 'judge_selected' when text = '' then 'vlm_only' when agreed >= 0.95 then 'agree' else 'disagree' end as status from ra
)"""
_EXPORTED = """
ex as (
  select doc_id, page_no, region_id, seq, case when seq % 10 = 0 then '  ' else content end as text, case when seq % 2 = 0 then 'vlm' else 'ocr' end as source,
    case when seq % 4 = 0 then 'a,b' else 'a' end as labels, case when seq % 9 = 0 or seq % 14 = 0 then 'table' else 'text' end as kind, 'product_' || (seq % 2) as product_id
  from regions where not (seq % 10 = 0 and seq % 5 = 0)
)"""

ORACLE_SQL = {
    "recovery_components": "with recursive "
    + D.with_("lines regions", "")[5:].rstrip().rstrip(",")
    + """,
ow as (select l.doc_id, l.page_no, l.i from lines l join regions r on l.doc_id = r.doc_id and l.page_no = r.page_no and r.seq % 2 = 0
  and (greatest(0, least(l.x1, r.x1) - greatest(l.x0, r.x0)) * greatest(0, least(l.y1, r.y1) - greatest(l.y0, r.y0)))::double / greatest(1, (l.x1 - l.x0) * (l.y1 - l.y0)) >= 0.5),
lo as (select l.* from lines l anti join ow on l.doc_id = ow.doc_id and l.page_no = ow.page_no and l.i = ow.i),
hh as (select doc_id, page_no, median(greatest(1, y1 - y0))::double as h from lo group by all),
gr as (select lo.doc_id, lo.page_no, i, y0, x0, lo.x0 - greatest(8.0, 1.5 * h) as a0, lo.x1 + greatest(8.0, 1.5 * h) as a1, lo.y0 - greatest(2.0, 0.25 * h) as b0, lo.y1 + greatest(2.0, 0.25 * h) as b1 from lo join hh on lo.doc_id = hh.doc_id and lo.page_no = hh.page_no),
ed as (select p.doc_id, p.page_no, p.i as u, q.i as v from gr p join gr q on p.doc_id = q.doc_id and p.page_no = q.page_no and p.a0 < q.a1 and q.a0 < p.a1 and p.b0 < q.b1 and q.b0 < p.b1),
re(doc_id, page_no, u, v) as (select doc_id, page_no, u, v from ed union select re.doc_id, re.page_no, re.u, ed.v from re join ed on re.doc_id = ed.doc_id and re.page_no = ed.page_no and re.v = ed.u),
co as (select doc_id, page_no, u as i, min(v) as root from re group by all),
mi as (select co.doc_id, co.page_no, root, min(y0) as my, min(x0) as mx from co join lo on co.doc_id = lo.doc_id and co.page_no = lo.page_no and co.i = lo.i group by all),
nu as (select *, row_number() over (partition by doc_id, page_no order by my, mx) as nr from mi)
select co.doc_id, co.page_no, co.i, printf('p%d_x%03d', co.page_no, nr) as candidate_id from co join nu on co.doc_id = nu.doc_id and co.page_no = nu.page_no and co.root = nu.root""",
    "structure_corroboration": D.with_(
        "regions",
        f"""
nd as (select doc_id, page_no, {_PL.format("case when i % 6 = 5 then reverse(text) else text end")} as nk from lines where i % 11 <> 3),
rk as (select doc_id, page_no, region_id, content, {_PL.format("content")} as k from regions),
wh as (select distinct r.doc_id, r.page_no, r.region_id from rk r join nd n on r.doc_id = n.doc_id and r.page_no = n.page_no where length(k) >= 6 and nk <> '' and contains(nk, k)),
rl as (select doc_id, page_no, region_id, unnest(string_split(content, chr(10))) as line, generate_subscripts(string_split(content, chr(10)), 1) as j from rk),
lk as (select doc_id, page_no, region_id, j, {_PL.format("line")} as k from rl),
sn as (select l.*, exists (select 1 from nd n where n.doc_id = l.doc_id and n.page_no = l.page_no and n.nk <> '' and contains(n.nk, l.k)) as seen from lk l where length(k) >= 2),
cv as (select doc_id, page_no, region_id, sum(case when seen then length(k) else 0 end)::double / sum(length(k)) as c from sn group by all)
select *, 'region_containment' as method from wh
union all select doc_id, page_no, region_id, 'line_coverage' from cv where c >= 0.9 and not exists (select 1 from wh where wh.doc_id = cv.doc_id and wh.page_no = cv.page_no and wh.region_id = cv.region_id)""",
    ),
    "apply_reading": D.with_(
        "regions",
        f"""{_READ}
select doc_id, page_no, region_id, case when status = 'judge_selected' then final when status in ('vlm_only', 'agree', 'disagree') then reader else text end as final_text,
  case when status = 'judge_selected' then 'vlm_judge' when status in ('vlm_only', 'agree', 'disagree') then 'vlm_reader' else src end as final_source, status as reading_status,
  case when status = 'parser_preserved' then 'digital_text_vlm_disagreement' when status = 'judge_selected' and jc < 0.7 then 'vlm_judge_low_confidence' when status = 'vlm_only' then 'vlm_only_text' when status = 'disagree' then 'ocr_vlm_disagreement' end as flag from rs""",
    ),
    "reading_status_counts": D.with_("regions", f"{_READ} select doc_id, status as reading_status, count(*) as n from rs group by all"),
    "ocr_review_codes": D.with_(
        "regions",
        f"""{_READ},
fn as (select *, case when seq % 9 = 2 then text || ' 31,5' else case when judge <> '' then judge else reader end end as ft from rd0),
nu as (select *, regexp_extract_all(ft, '\\d+(?:[.,]\\d+)*') as fnum, list_concat(regexp_extract_all(text, '\\d+(?:[.,]\\d+)*'), regexp_extract_all(reader, '\\d+(?:[.,]\\d+)*')) as known,
  list_filter(regexp_extract_all(judge, '[가-힣]{{2,}}'), lambda w: not contains({_PL.format("text")} || chr(10) || {_PL.format("reader")}, w)) as neww from fn)
select doc_id, page_no, region_id, concat_ws(',', case when trim(reader) = '' and length({_PL.format("text")}) >= 4 then 'vlm_blank_with_ocr_text' end, case when seq % 10 = 4 then 'page_reader_fallback' end,
  case when len(list_filter(fnum, lambda x: not list_contains(known, x))) > 0 then 'unsupported_number' end, case when len(neww) > 0 then 'judge_new_word' end) as codes from nu""",
    ),
    "read_scope": D.with_(
        "regions",
        f"""{_READ},
sc as (select *, seq % 17 <> 0 and seq % 12 <> 0 and not (src = 'document_processor' and {_NS.format("text")} <> '') as base, length({_NS.format("text")}) <= 3 or seq % 5 = 1 or seq % 4 = 0 as doubt from rd0)
select doc_id, page_no, region_id, base as "all", base and doubt as targeted, false as off from sc""",
    ),
    "clean_answers": "select doc_id, trim(coalesce(text, '')) as text from documents",
    "text_source_rollup": D.with_("regions", "select doc_id, ['vlm', 'digital', 'hwp', 'hwp', 'digital', 'ocr', 'ocr'][(seq % 7 + 1)::int] as source, count(*) as n from regions group by all"),
    "p3_export": D.with_("regions", f"{_EXPORTED} select doc_id, page_no, region_id, text, source, labels, kind, product_id from ex"),
    "p1_summary": D.with_("regions", f"{_EXPORTED} select doc_id, count(distinct page_no) as pages, count(*) as regions, count_if(trim(text) = '') as blank, count_if(labels = 'a,b') as multi_label, 0::bigint as no_label, count_if(kind = 'table') as tables from ex group by doc_id"),
    "export_id_check": D.with_("regions", "i as (select doc_id, case when seq % 8 = 0 then 'r1' else printf('p1_r%03d', seq) end as region_id from regions), c as (select doc_id, region_id, count(*) as n from i group by all) select * from c where n > 1 or region_id = 'r1'"),
    "model_call_stats": """
with c as (select event_type as schema, event_id % 3 = 0 as cached, round(abs(value) * 100)::bigint as seconds, 1 + event_id % 3 as attempts, event_id % 50 = 0 as timed_out from events)
select coalesce(schema, 'total') as schema, count(*) as calls, count_if(cached) as cached, sum(seconds)::bigint as seconds, sum(attempts)::bigint as attempts, count_if(timed_out) as timeouts from c group by rollup(schema)""",
    "request_keys": """select conv_id, turn, sha256('T' || coalesce(text, '') || 'I' || coalesce('data:image/png;base64,' || to_base64(encode(role)), '') || 'Slabels{"type": "object"}|900|m') as key from conversations""",
    "answer_parsing": "select event_id, case when event_id % 20 = 3 then null else (json_extract(props, '$.k'))::bigint end as k from events",
}
