"""Queries on labels and templates. The data has no Hangul, so headings, names and answers are put in by rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import labels as L
from ..operators import templates as M
from ..sources import derived as D

_HEADS = [w for words in L.ALIASES.values() for w in words]
_ALLOWED = [x for k, x in enumerate(L.ALIASES) if k % 3 != 2]


def _pick(values: list[str] | tuple[str, ...], nr: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (nr % len(values) + 1).cast("int"))


def _pick_sql(values: list[str] | tuple[str, ...], nr: str) -> str:
    return f"[{', '.join(repr(v) for v in values)}][(({nr}) % {len(values)} + 1)::int]"


def _headed(spark: SparkSession, folder: str) -> DataFrame:
    """Lines with headings: some behind bullets, some in mid-sentence, some without a colon."""
    i, d = F.col("i"), F.col("doc_id")
    head = _pick(_HEADS, i * 7 + d)
    text = (
        F.when(i % 4 == 0, F.concat(F.lit("• "), head, F.lit(": "), "text")).when(i % 4 == 1, F.concat("text", F.lit(" "), head)).when(i % 8 == 2, F.concat(F.lit("※ - "), head))
        .when(i % 8 == 6, F.concat(head, F.lit("에 따라 "), "text")).otherwise(F.concat(head, F.lit("는 "), "text"))
    )
    return D.lines(spark, folder).select("doc_id", "page_no", F.format_string("p%d_r%03d", "page_no", F.expr("(i % 40) div 5 + 1")).alias("region_id"), i.alias("pos"), text.alias("text"))


def explicit_headings(spark: SparkSession, folder: str) -> DataFrame:
    lines = _headed(spark, folder).withColumn("allowed", F.array(*[F.lit(x) for x in _ALLOWED]))
    return L.headings(lines).select("doc_id", "page_no", "region_id", "label", "quote", "place")


_NUMBERS = ("준법감시인 심의필 2026-{0} (심의일: 2026. 01. 02.)", "[여신금융협회 심의필 제{0}-000-00000호]", "심 사 번호 {0}-{0}", "2026-{0}(심의일 : 2026)", "금액 {0}", "심의일 {0}-00-00")


def review_number_extract(spark: SparkSession, folder: str) -> DataFrame:
    docs = D.table(spark, folder, "documents")
    number = F.format_string("%04d", F.col("doc_id") % 10000)
    text = F.concat(F.coalesce("text", F.lit("")), F.lit(" "), F.replace(_pick(_NUMBERS, F.col("doc_id")), F.lit("{0}"), number))
    return docs.select("doc_id", L.review_number(text).alias("quote"))


def quote_in_source(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark passages, and beginnings of documents with punctuation changed, as quotes of documents."""
    docs = D.table(spark, folder, "documents").select("doc_id", "text")
    own = F.when(F.col("doc_id") % 4 == 0, F.substring("text", 5, 40)).when(F.col("doc_id") % 4 == 1, F.concat(F.replace(F.substring("text", 1, 30), F.lit(" "), F.lit(" | ")), F.lit("..."))).when(F.col("doc_id") % 4 == 2, F.translate(F.substring("text", 3, 25), ".,", ";:")).otherwise(F.reverse(F.substring("text", 1, 9)))
    return docs.select("doc_id", F.coalesce(L.quoted(own, F.col("text")), F.lit(False)).alias("quoted"))


def label_constraints(spark: SparkSession, folder: str) -> DataFrame:
    """Titles and worked rate examples among all lines."""
    d = F.col("doc_id") + F.col("i")
    line = F.col("text")
    text = F.when(d % 3 == 0, F.concat(F.lit("기준금리 2.5% + 가산금리 1.0%, 적용시 "), line)).when(d % 3 == 1, line).otherwise(F.concat(F.lit("우대금리 0.3% "), line))
    labels = F.array(*[F.lit(x) for x in ("대출금리", "대출기간", "상품명", "우대금리")])
    rows = D.lines(spark, folder).select("doc_id", "i", text.alias("text"), labels.alias("labels"), F.when(d % 2 == 0, "paragraph_title").otherwise("text").alias("layout"))
    announced = F.when((F.col("doc_id") + F.col("i")) % 5 == 0, F.array(F.lit("우대금리"))).otherwise(F.array().cast("array<string>"))
    found = L.constrain_rates(L.constrain_title(F.col("labels"), F.col("layout"), F.col("text")), F.col("text"), announced)
    return rows.select("doc_id", "i", F.array_join(found, ",").alias("labels"))


def label_answer_validate(spark: SparkSession, folder: str) -> DataFrame:
    """Answers on documents: labels not allowed or without a quote, quotes that aren't there, contradictions, second answers, none."""
    docs = D.table(spark, folder, "documents").where("text is not null").withColumn("allowed", F.array(*[F.lit(x) for x in ("a", "b", "c")]))
    d = F.col("doc_id")
    reason = F.when(d % 9 == 0, F.lit("근거 없음")).when(d % 9 == 4, F.lit("해당 없음.")).otherwise("fine")
    first = docs.where("doc_id % 10 <> 3").select("doc_id", F.lit(1).alias("pos"), F.array(F.lit("a"), F.lit("a"), F.lit("b"), F.lit("z")).alias("labels"), (d % 10 / 10.0).alias("confidence"), reason.alias("reason"))
    second = docs.where("doc_id % 6 = 0").select("doc_id", F.lit(2).alias("pos"), F.array(F.lit("c")).alias("labels"), F.lit(0.9).alias("confidence"), F.lit("").alias("reason"))
    told = docs.select("doc_id", F.lit(1).alias("pos"), F.lit("a").alias("label"), F.substring("text", 4, 20).alias("quote")).unionByName(docs.select("doc_id", F.lit(1).alias("pos"), F.lit("b").alias("label"), F.when(d % 2 == 0, F.substring("text", 1, 15)).otherwise("nowhere to be found").alias("quote")))
    found = L.validate(docs.select("doc_id", "text", "allowed"), first.unionByName(second), told, ("doc_id",))
    return found.select("doc_id", F.array_join("labels", ",").alias("labels"), "confidence", "status")


def label_merge(spark: SparkSession, folder: str) -> DataFrame:
    """Announced labels of a region, then answered ones that are new."""
    lines = _headed(spark, folder).withColumn("allowed", F.array(*[F.lit(x) for x in _ALLOWED]))
    per = L.headings(lines).groupBy("doc_id", "page_no", "region_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "label"))), lambda s: s["label"]).alias("told"))
    answered = F.array(F.lit("유의사항"), _pick(list(L.ALIASES), F.col("doc_id")))
    return per.select("doc_id", "page_no", "region_id", F.array_join(L.merged(F.col("told"), answered), ",").alias("labels"))


def label_chunks(spark: SparkSession, folder: str) -> DataFrame:
    return L.chunks(D.regions(D.lines(spark, folder)), D.PAGE, 15).select("doc_id", "page_no", "region_id", "chunk")


def shortened_texts(spark: SparkSession, folder: str) -> DataFrame:
    return D.table(spark, folder, "documents").select("doc_id", L.shortened(F.col("text")).alias("text"), L.cut_short(F.col("text")).alias("short_text"))


_FILES = ("1. 카드상품 안내.pdf", "2. 펀드 ISA.png", "3. 정기예금.pdf", "4. 신용대출.hwp", "5. 행사 안내.png")
_GROUPS = ("카드", "투자성", "예금성", "대출성", "기타", "판단불가")


def filename_prior_fusion(spark: SparkSession, folder: str) -> DataFrame:
    d = F.col("doc_id")
    docs = D.table(spark, folder, "documents").select("doc_id", _pick(_FILES, d).alias("source_file"), (d % 7 != 0).alias("answered"), F.when(d % 7 != 0, _pick(_GROUPS, F.expr("doc_id div 5"))).alias("vlm_group"))
    return M.classify(docs).select("doc_id", "product_group", "category_source")


_HINTS = ("잔금대출", "적금", "정기예금", "입출금", "장기카드대출", "법인카드", "개인카드", "ISA 신탁형", "ISA 일임형", "ISA 신탁형 일임형", "퇴직연금 펀드상품", "IRP 금융투자상품 미노출", "IRP", "펀드", "적금 정기예금", "그 밖")


def _advertised(spark: SparkSession, folder: str) -> DataFrame:
    d = F.col("doc_id")
    shown = F.when(d % 3 == 0, M.SHOWN).when(d % 3 == 1, M.NOT_SHOWN)
    hay = F.concat(_pick(_HINTS, F.expr("doc_id div 3")), F.lit(" "), F.coalesce("text", F.lit("")))
    return D.table(spark, folder, "documents").select("doc_id", _pick(("대출성", "예금성", "카드", "투자성"), F.expr("doc_id div 2")).alias("product_group"), shown.alias("shown"), hay.alias("haystack"))


def template_rule_choice(spark: SparkSession, folder: str) -> DataFrame:
    found = _advertised(spark, folder)
    return found.select("doc_id", M.rule_template(F.col("product_group"), F.col("shown"), F.col("haystack")).alias("template_id"), M.first_group(F.lower("haystack"), M.TEXT_WORDS).alias("inferred_group"))


def _catalog(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(M.catalog_rows(), "template_id string, template_pos int, product_group string, label_pos int, label string")


def template_resolution(spark: SparkSession, folder: str) -> DataFrame:
    d = F.col("doc_id")
    answer = F.when(d % 5 == 0, M.UNDECIDED).otherwise(_pick([r[4] for r in M.RULES], d))
    p = _advertised(spark, folder).withColumns({"answer": answer, "answer_confidence": d % 10 / 10.0, "failed": d % 11 == 0, "product_group": F.when(d % 13 == 0, "없음").otherwise(F.col("product_group"))})
    return M.resolve(p, _catalog(spark).select("product_group", "template_id").distinct()).select("doc_id", "template_id", "status", "source")


def template_label_intersection(spark: SparkSession, folder: str) -> DataFrame:
    return M.common_labels(_catalog(spark))


def label_union_order(spark: SparkSession, folder: str) -> DataFrame:
    """All labels of the templates of a document's products, for regions without an owner."""
    rows = _advertised(spark, folder).select((F.expr("doc_id div 4")).alias("doc"), "doc_id", M.rule_template(F.col("product_group"), F.col("shown"), F.col("haystack")).alias("template_id")).where("template_id is not null")
    joined = rows.join(F.broadcast(_catalog(spark)), "template_id")
    return M.label_union(joined.select("doc", F.col("doc_id").alias("list_pos"), "label_pos", "label"), ("doc",))


def _products(spark: SparkSession, folder: str) -> DataFrame:
    d = F.col("doc_id")
    group = F.when(d % 4 == 3, M.UNDECIDED).when(d % 8 < 2, "예금성").otherwise(_pick(("예금성", "대출성"), d))
    return D.table(spark, folder, "documents").select(F.expr("doc_id div 3").alias("doc_id"), F.concat(F.lit("product_"), (1 + d % 3).cast("string")).alias("product_id"), d.alias("n"), group.alias("product_group"), F.when(F.expr("doc_id div 3") % 2 == 0, "카드").alias("doc_group"), "text")


def product_value_resolution(spark: SparkSession, folder: str) -> DataFrame:
    return M.product_values(_products(spark, folder), "product_group", "doc_group").select("doc_id", "product_id", "product_group_of")


def product_name_check(spark: SparkSession, folder: str) -> DataFrame:
    n = F.col("n")
    name = F.when(n % 4 == 0, F.substring("text", 2, 12)).when(n % 4 == 1, F.lit("")).when(n % 4 == 2, F.substring("text", 1, 3)).otherwise("다른 이름입니다")
    p = _products(spark, folder).withColumns({"name": name, "reported": F.when(n % 3 == 0, M.SHOWN).when(n % 3 == 1, M.NOT_SHOWN)})
    return M.check_names(p).select("doc_id", "product_id", "effective", "name_status")


def product_meta_first(spark: SparkSession, folder: str) -> DataFrame:
    turns = D.table(spark, folder, "conversations")
    p = turns.select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("page_no"), F.lit(0).alias("pos"), F.concat(F.lit("product_"), (F.col("turn") % 2).cast("string")).alias("product_id"), F.substring("text", 1, 12).alias("name"), F.col("role").alias("product_group"))
    return M.first_meta(p)


def document_template(spark: SparkSession, folder: str) -> DataFrame:
    p = _advertised(spark, folder).select(F.expr("doc_id div 2").alias("doc_id"), F.when(F.col("doc_id") % 9 == 0, "page_common").otherwise("product_1").alias("product_id"), M.rule_template(F.col("product_group"), F.col("shown"), F.col("haystack")).alias("template_id"))
    return M.document_template(p).select("doc_id", "template_id", "scope", "status", F.array_join("ids", ",").alias("ids"))


def review_units(spark: SparkSession, folder: str) -> DataFrame:
    r = D.regions(D.lines(spark, folder))
    owner = F.when(F.col("seq") % 5 == 0, "page_common").when(F.col("seq") % 7 == 3, "unknown").otherwise(F.concat(F.lit("product_"), (1 + F.col("seq") % 2).cast("string")))
    r = r.select("doc_id", "page_no", F.col("seq").alias("page_order"), "region_id", owner.alias("product_id"))
    names = F.array(F.lit("product_1"), F.lit("product_2"), F.lit("product_9"), F.lit("page_common"), F.lit("unknown"))
    p = r.select("doc_id").distinct().select("doc_id", F.explode(names).alias("product_id")).withColumn("template_id", F.concat(F.lit("t"), (F.col("doc_id") % 19).cast("string")))
    return M.review_units(p, r).select("doc_id", "unit_id", "product_id", "template_id", F.array_join("region_ids", ",").alias("region_ids"), F.array_join("common_ids", ",").alias("common_ids"))


def label_examples(spark: SparkSession, folder: str) -> DataFrame:
    turns = D.table(spark, folder, "conversations").select(F.col("role").alias("template_id"), (F.col("conv_id") % 7).cast("string").alias("label"), (F.col("conv_id") * 100 + F.col("turn")).alias("pos"), F.col("text").alias("example"))
    return M.examples(turns).select("template_id", "label", "example", "nr")


QUERIES = {
    f.__name__: f
    for f in (
        explicit_headings, review_number_extract, quote_in_source, label_constraints, label_answer_validate, label_merge, label_chunks, shortened_texts, filename_prior_fusion, template_rule_choice,
        template_resolution, template_label_intersection, label_union_order, product_value_resolution, product_name_check, product_meta_first, document_template, review_units, label_examples,
    )
}


def _has(text: str, words: tuple[str, ...]) -> str:
    return "(" + " or ".join("(" + " and ".join(f"contains({text}, '{p}')" for p in w.split("&")) + ")" for w in words) + ")"


def _rule_sql(group: str, shown: str, text: str) -> str:
    def holds(r: tuple) -> str:
        return " and ".join([f"{group} = '{r[0]}'", *([f"{shown} is not distinct from '{r[1]}'"] if r[1] else []), *([_has(text, r[2])] if r[2] else []), *([f"not {_has(text, r[3])}"] if r[3] else [])])

    alone = " + ".join(f"coalesce(({holds(r)})::int, 0)" for r in M.RULES if r[5])
    return "case " + " ".join(f"when {holds(r)}{f' and ({alone}) = 1' if r[5] else ''} then '{r[4]}'" for r in M.RULES) + " end"


def _group_sql(text: str, words: dict[str, tuple[str, ...]]) -> str:
    return "case " + " ".join(f"when {_has(text, w)} then '{g}'" for g, w in words.items()) + " end"


_QK = "regexp_replace(regexp_replace(trim(regexp_replace({0}, '<br\\s*/?>', '', 'gi')), '(?:…|\\.{{3}})+\\s*$', ''), '[\\s|]+', '', 'g')"
_QL = "regexp_replace(" + _QK + ", '[^0-9A-Za-z가-힣]', '', 'g')"


def _quoted_sql(q: str, s: str) -> str:
    return f"({_QK.format(q)} <> '' and (contains({_QK.format(s)}, {_QK.format(q)}) or (length({_QL.format(q)}) >= 6 and contains({_QL.format(s)}, {_QL.format(q)}))))"


_HEADED = f"""
hl as (
  select doc_id, page_no, printf('p%d_r%03d', page_no, (i % 40) // 5 + 1) as region_id, i as pos,
    case when i % 4 = 0 then '• ' || h || ': ' || text when i % 4 = 1 then text || ' ' || h when i % 8 = 2 then '※ - ' || h when i % 8 = 6 then h || '에 따라 ' || text else h || '는 ' || text end as text
  from (select *, {_pick_sql(_HEADS, "i * 7 + doc_id")} as h from lines)
),
al(nr, label, pat) as (values {", ".join(f"({k}, '{x}', '{L.heading_pattern(x)}')" for k, x in enumerate(L.ALIASES) if x in _ALLOWED)}),
hit as (
  select h.doc_id, h.page_no, h.region_id, a.nr, a.label, pos, trim(text) as quote from hl h join al a on regexp_matches(trim(regexp_replace(trim(text), '{L.BULLETS}', '')), a.pat)
),
hf as (select *, row_number() over (partition by doc_id, page_no, region_id, nr order by pos, quote) as rn from hit),
hd as (select *, row_number() over (partition by doc_id, page_no, region_id order by pos, nr) as place from hf where rn = 1)"""
_ADV = f"""
adv as (
  select doc_id, {_pick_sql(("대출성", "예금성", "카드", "투자성"), "doc_id // 2")} as g, case when doc_id % 3 = 0 then '{M.SHOWN}' when doc_id % 3 = 1 then '{M.NOT_SHOWN}' end as shown,
    lower({_pick_sql(_HINTS, "doc_id // 3")} || ' ' || coalesce(text, '')) as hay from documents
)"""
_CAT = "cat(template_id, template_pos, product_group, label_pos, label) as (values " + ", ".join(f"('{t}', {p}, '{g}', {k}, '{x}')" for t, p, g, k, x in M.catalog_rows()) + ")"

ORACLE_SQL = {
    "explicit_headings": D.with_("lines", f"{_HEADED} select doc_id, page_no, region_id, label, quote, place from hd"),
    "label_merge": D.with_(
        "lines",
        f"""{_HEADED},
tl as (select doc_id, page_no, region_id, list(label order by place) as told from hd group by all),
ml as (select *, told || ['유의사항', {_pick_sql(list(L.ALIASES), "doc_id")}] as l from tl)
select doc_id, page_no, region_id, array_to_string(list_filter(l, lambda x, k: list_position(l, x) = k), ',') as labels from ml""",
    ),
    "review_number_extract": f"""
select doc_id, nullif(trim(regexp_extract(coalesce(text, '') || ' ' || replace({_pick_sql(_NUMBERS, "doc_id")}, '{{0}}', printf('%04d', doc_id % 10000)), '{L.REVIEW_NUMBER}', 0)), '') as quote from documents""",
    "quote_in_source": f"""
with q as (select doc_id, text, case when doc_id % 4 = 0 then substr(text, 5, 40) when doc_id % 4 = 1 then replace(substr(text, 1, 30), ' ', ' | ') || '...' when doc_id % 4 = 2 then translate(substr(text, 3, 25), '.,', ';:') else reverse(substr(text, 1, 9)) end as quote from documents)
select doc_id, coalesce({_quoted_sql("quote", "text")}, false) as quoted from q""",
    "label_constraints": D.with_(
        "lines",
        """
r as (
  select doc_id, i, doc_id + i as d, case when (doc_id + i) % 3 = 0 then '기준금리 2.5% + 가산금리 1.0%, 적용시 ' || text when (doc_id + i) % 3 = 1 then text else '우대금리 0.3% ' || text end as text from lines)
select doc_id, i, case when d % 2 = 0 and length(regexp_replace(text, '\\s+', '', 'g')) <= 60 then '상품명' when d % 3 = 0 then case when d % 5 = 0 then '대출금리,우대금리' else '대출금리' end else '대출금리,대출기간,상품명,우대금리' end as labels from r""",
    ),
    "label_answer_validate": f"""
with d as (select doc_id, text, doc_id % 10 <> 3 as has1, doc_id % 6 = 0 as has2, {_quoted_sql("substr(text, 4, 20)", "text")} as qa,
  case when doc_id % 2 = 0 then {_quoted_sql("substr(text, 1, 15)", "text")} else {_quoted_sql("'nowhere to be found'", "text")} end as qb from documents where text is not null)
select doc_id, case when has1 and doc_id % 9 not in (0, 4) then concat_ws(',', case when qa then 'a' end, case when qb then 'b' end) else '' end as labels,
  case when has1 then doc_id % 10 / 10.0::double when has2 then 0.9::double else 0 end as confidence,
  case when has1 then case when doc_id % 9 in (0, 4) then 'contradiction' else 'ok' end when has2 then 'ok' else 'missing' end as status from d""",
    "label_chunks": D.with_("regions", "select doc_id, page_no, region_id, (row_number() over (partition by doc_id, page_no order by seq) - 1) // 15 as chunk from regions"),
    "shortened_texts": """
with t as (select doc_id, trim(regexp_replace(coalesce(text, ''), '\\s+', ' ', 'g')) as t from documents)
select doc_id, case when length(t) > 1600 then substr(t, 1, 1100) || ' …(중략 ' || (length(t) - 1600) || '자)… ' || right(t, 500) else t end as text, case when length(t) > 700 then substr(t, 1, 700) || '…' else t end as short_text from t""",
    "filename_prior_fusion": f"""
with d as (select doc_id, {_pick_sql(_FILES, "doc_id")} as f, doc_id % 7 <> 0 as answered, case when doc_id % 7 <> 0 then {_pick_sql(_GROUPS, "doc_id // 5")} end as g from documents),
p as (select doc_id, {_group_sql("f", M.NAME_WORDS)} as prior, answered and g in ('기타', '판단불가') as abst, case when answered and g not in ('기타', '판단불가') then g end as said from d)
select doc_id, coalesce(said, prior) as product_group, case when prior is not null and said is not null then case when prior = said then 'filename_and_vlm' else 'vlm_overrode_filename' end when said is not null then 'vlm'
  when prior is not null and abst then 'filename_vlm_abstained' when prior is not null then 'filename_vlm_failed' when abst then 'vlm_abstained' else 'none' end as category_source from p""",
    "template_rule_choice": f"with {_ADV} select doc_id, {_rule_sql('g', 'shown', 'hay')} as template_id, {_group_sql('hay', M.TEXT_WORDS)} as inferred_group from adv",
    "template_resolution": f"""
with {_ADV}, {_CAT},
p as (select doc_id, case when doc_id % 13 = 0 then '없음' else g end as g, shown, hay, case when doc_id % 5 = 0 then '판단불가' else {_pick_sql([r[4] for r in M.RULES], "doc_id")} end as answer, doc_id % 10 / 10.0::double as conf, doc_id % 11 = 0 as failed from adv),
c as (select product_group, list(distinct template_id) as c from cat group by all),
r as (select p.*, {_rule_sql("p.g", "shown", "hay")} as rule, coalesce(c.c, []) as c from p left join c on p.g = c.product_group)
select doc_id, case when rule is not null then rule when not failed and list_contains(c, answer) then answer end as template_id,
  case when rule is not null then 'confirmed' when len(c) = 0 or failed or not list_contains(c, answer) then 'unresolved' when conf >= 0.7 then 'confirmed' else 'needs_review' end as status,
  case when rule is not null then 'rules' when len(c) = 0 then 'none' when failed then 'vlm_failed' else 'vlm' end as source from r""",
    "template_label_intersection": f"with {_CAT} select label, (min(case when template_pos = 0 then label_pos end))::bigint as pos from cat group by label having count(distinct template_id) = (select count(distinct template_id) from cat)",
    "label_union_order": f"""
with {_ADV}, {_CAT}, t as (select doc_id // 4 as doc, doc_id, {_rule_sql("g", "shown", "hay")} as template_id from adv),
f as (select doc, label, min(doc_id * 1000 + label_pos) as p from t join cat using (template_id) group by all)
select doc, label, row_number() over (partition by doc order by p, label) as place from f""",
    "product_value_resolution": """
with p as (select doc_id // 3 as d, 'product_' || (1 + doc_id % 3) as product_id, case when doc_id % 4 = 3 then null when doc_id % 8 < 2 then '예금성' else ['예금성', '대출성'][(doc_id % 2 + 1)::int] end as own, case when (doc_id // 3) % 2 = 0 then '카드' end as whole from documents),
k as (select d, count(distinct own) as n from p group by d)
select p.d as doc_id, product_id, case when n <= 1 and whole is not null then whole else own end as product_group_of from p join k on p.d = k.d""",
    "product_name_check": """
with p as (select doc_id // 3 as d, 'product_' || (1 + doc_id % 3) as product_id, text, case when doc_id % 4 = 0 then substr(text, 2, 12) when doc_id % 4 = 1 then '' when doc_id % 4 = 2 then substr(text, 1, 3) else '다른 이름입니다' end as name,
  case when doc_id % 3 = 0 then '노출' when doc_id % 3 = 1 then '미노출' end as reported from documents),
k as (select *, lower(regexp_replace(name, '[^0-9a-zA-Z가-힣]', '', 'g')) as key, lower(regexp_replace(text, '[^0-9a-zA-Z가-힣]', '', 'g')) as hay from p),
m as (select *, length(key) >= 4 and contains(hay, key) as found from k)
select d as doc_id, product_id, case when found then '노출' else reported end as effective,
  case when found and reported is distinct from '노출' then 'corrected_to_shown' when found then 'verified_shown' when reported = '노출' then 'shown_not_verified_in_product_regions' when trim(name) = '' then 'name_missing' else 'not_shown_in_product_regions' end as name_status from m""",
    "product_meta_first": """
with p as (select conv_id as doc_id, turn as page_no, 'product_' || (turn % 2) as product_id, substr(text, 1, 12) as name, role as product_group from conversations)
select doc_id, product_id, page_no, name, product_group from (select *, row_number() over (partition by doc_id, product_id order by page_no) as rn from p) where rn = 1""",
    "document_template": f"""
with {_ADV}, t as (select doc_id // 2 as d, case when doc_id % 9 = 0 then 'page_common' else 'product_1' end as p, {_rule_sql("g", "shown", "hay")} as template_id from adv),
s as (select d, list_sort(list(distinct template_id) filter (template_id is not null)) as ids from t where p <> 'page_common' group by d),
z as (select d, coalesce(ids, []) as ids from s)
select d as doc_id, case when len(ids) = 1 then ids[1] end as template_id, case when len(ids) = 1 then 'document' else 'per_product' end as scope, case when len(ids) = 1 then 'single' when len(ids) > 1 then 'multi_product' else 'unresolved' end as status, array_to_string(ids, ',') as ids from z""",
    "review_units": D.with_(
        "regions",
        """
r as (select doc_id, page_no, seq, region_id, case when seq % 5 = 0 then 'page_common' when seq % 7 = 3 then 'unknown' else 'product_' || (1 + seq % 2) end as product_id from regions),
u as (select distinct doc_id, unnest(['product_1', 'product_2', 'product_9']) as product_id from r)
select u.doc_id, 'review_' || u.product_id as unit_id, u.product_id, 't' || (u.doc_id % 19) as template_id,
  coalesce((select string_agg(region_id, ',' order by page_no, seq) from r where r.doc_id = u.doc_id and r.product_id = u.product_id), '') as region_ids,
  coalesce((select string_agg(region_id, ',' order by page_no, seq) from r where r.doc_id = u.doc_id and r.product_id = 'page_common'), '') as common_ids from u""",
    ),
    "label_examples": """
with e as (select role as template_id, (conv_id % 7)::varchar as label, min(conv_id * 100 + turn) as pos, trim(regexp_replace(text, '\\s+', ' ', 'g')) as example from conversations group by role, conv_id % 7, trim(regexp_replace(text, '\\s+', ' ', 'g')))
select template_id, label, example, nr from (select *, row_number() over (partition by template_id, label order by pos) as nr from e where example <> '') where nr <= 2""",
}
