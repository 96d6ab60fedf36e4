"""Queries on ownership answers. Answers are derived from the data: some missing, some double, some of ids that don't exist."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import assign
from ..operators import ownership as O
from ..sources import derived as D


def _answers(regions: DataFrame) -> DataFrame:
    """First answers; where seq % 4 = 0 a second one, and an answer on a region that isn't there."""
    owner = F.when(F.col("seq") % 11 == 0, O.COMMON).when(F.col("seq") % 6 == 5, F.lit("product_9")).otherwise(F.concat(F.lit("product_"), (1 + F.col("doc_id") % 3).cast("string")))
    sure = ((F.col("doc_id") * 7 + F.col("seq") * 3) % 100) / 100.0
    first = F.struct((100 - F.col("seq")).alias("pos"), F.col("region_id").alias("region_id"), owner.alias("product_id"), sure.alias("confidence"))
    second = F.struct((200 - F.col("seq")).alias("pos"), F.col("region_id").alias("region_id"), F.lit(O.COMMON).alias("product_id"), F.lit(0.99).alias("confidence"))
    foreign = F.struct((300 - F.col("seq")).alias("pos"), F.concat("region_id", F.lit("_x")).alias("region_id"), F.lit(O.COMMON).alias("product_id"), F.lit(0.5).alias("confidence"))
    rows = F.filter(F.array(F.when(F.col("seq") % 13 != 0, first), F.when(F.col("seq") % 4 == 0, second), F.when(F.col("seq") % 10 == 0, foreign)), lambda x: x.isNotNull())
    return regions.select(*D.PAGE, F.explode(rows).alias("a")).select(*D.PAGE, "a.*")


def _validated(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    lines = D.lines(spark, folder)
    regions = D.regions(lines)
    found = O.first_answers(_answers(regions), regions, "region_id", {"product_id": F.lit(O.UNKNOWN), "confidence": F.lit(0.0)})
    products = F.array(*[F.lit(f"product_{k}") for k in range(1, 5)])
    return lines, regions, found.withColumn("product_id", O.allowed_owner(F.col("product_id"), products))


def ownership_validate(spark: SparkSession, folder: str) -> DataFrame:
    return _validated(spark, folder)[2].select("doc_id", "page_no", "region_id", "place", "answered", "product_id", "confidence")


def _recovery(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Every unowned line as a candidate with a decision, and the validated regions."""
    lines, regions, owners = _validated(spark, folder)
    loose = assign.with_owner(lines, regions).where("region_id is null")
    i = F.col("i")
    candidates = loose.select("doc_id", "page_no", F.format_string("p%d_x%03d", "page_no", i + 1).alias("candidate_id"), "i", "x0", "y0", "x1", "y1", "text")
    action = F.element_at(F.array(*[F.lit(x) for x in ("attach", "new", "decorative", "page_common", "needs_review")]), (i % 5 + 1).cast("int"))
    decisions = candidates.select(
        "doc_id", "page_no", "candidate_id", action.alias("action"),
        F.when(i % 2 == 0, F.format_string("p%d_r%03d", "page_no", F.lit(1) + i % 4)).alias("target_region_id"),
        F.concat(F.lit("product_"), (1 + F.col("doc_id") % 3).cast("string")).alias("product_id"), ((F.col("doc_id") + i) % 10 / 10.0).alias("confidence"),
    )
    owned = regions.join(owners.select("doc_id", "page_no", "region_id", "product_id"), ["doc_id", "page_no", "region_id"])
    return O.recovered(candidates, decisions), owned


def recovery_application(spark: SparkSession, folder: str) -> DataFrame:
    return _recovery(spark, folder)[0].select("doc_id", "page_no", "region_id", "owner", "action", F.array_join("reasons", ",").alias("reasons"), "ignored")


def _ordered(spark: SparkSession, folder: str) -> DataFrame:
    recovered, owned = _recovery(spark, folder)
    layout = owned.select("doc_id", "page_no", "region_id", "seq", F.lit("layout").alias("origin"), F.lit(None).cast("string").alias("related_region_id"), "product_id", "y0", "x0")
    more = recovered.select("doc_id", "page_no", "region_id", (1000 + F.col("i")).alias("seq"), F.lit("recovery").alias("origin"), F.col("target_region_id").alias("related_region_id"), F.col("owner").alias("product_id"), "y0", "x0")
    return O.reading_order(layout.unionByName(more))


def reading_order(spark: SparkSession, folder: str) -> DataFrame:
    return _ordered(spark, folder).select("doc_id", "page_no", "region_id", "page_order", "product_order")


def final_region_ids(spark: SparkSession, folder: str) -> DataFrame:
    return O.renumber(_ordered(spark, folder)).select("doc_id", "page_no", "old_id", "final_id")


def id_reference_rewrite(spark: SparkSession, folder: str) -> DataFrame:
    """Related ids and parent ids of all regions under final ids."""
    ordered = _ordered(spark, folder)
    links = assign.parents(D.regions(D.lines(spark, folder))).select("doc_id", "page_no", "region_id", "parent_id")
    joined = ordered.join(links, ["doc_id", "page_no", "region_id"], "left").withColumn("source_id", F.col("region_id"))
    found = O.rewrite(joined, O.renumber(ordered), ("region_id", "related_region_id", "parent_id"))
    return found.select("doc_id", "page_no", "source_id", "region_id", "related_region_id", "parent_id")


def duplicate_region_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Ids that an export must not have: of the answers, not of the regions."""
    return O.duplicates(_answers(D.regions(D.lines(spark, folder))), D.PAGE, "region_id").select("doc_id", "page_no", "region_id", "count")


def review_reason_flags(spark: SparkSession, folder: str) -> DataFrame:
    recovered, _ = _recovery(spark, folder)
    owners = _validated(spark, folder)[2]
    asked = O.low_confidence(owners, "ownership_low_confidence", "region_id")
    more = recovered.select("doc_id", "page_no", "region_id", F.explode("reasons").alias("code"))
    withdrawn = owners.where("place % 3 = 0").select("doc_id", "page_no", "region_id", F.lit("ownership_low_confidence").alias("code"))
    return O.review_reasons(asked.unionByName(asked).unionByName(more), withdrawn)


def product_fold(spark: SparkSession, folder: str) -> DataFrame:
    """Products that a document's pages bring in, by conversation: page = turn, name = the turn's first word."""
    turns = D.table(spark, folder, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("page_no"), F.concat(F.lit("product_"), (1 + (F.col("turn") + F.col("conv_id")) % 3).cast("string")).alias("product_id"), F.substring_index("text", " ", 1).alias("name"))
    owned = turns.where("(doc_id + page_no) % 4 <> 1").select("doc_id", "page_no", "product_id")
    return O.known_products(owned, turns).select("doc_id", "product_id", "name", "first_page", "place")


QUERIES = {f.__name__: f for f in (ownership_validate, recovery_application, reading_order, final_region_ids, id_reference_rewrite, duplicate_region_ids, review_reason_flags, product_fold)}

_ANSWERS = """
ans as (
  select doc_id, page_no, 100 - seq as pos, region_id, case when seq % 11 = 0 then 'page_common' when seq % 6 = 5 then 'product_9' else 'product_' || (1 + doc_id % 3) end as product_id, ((doc_id * 7 + seq * 3) % 100) / 100.0::double as confidence from regions where seq % 13 <> 0
  union all select doc_id, page_no, 200 - seq, region_id, 'page_common', 0.99::double from regions where seq % 4 = 0
  union all select doc_id, page_no, 300 - seq, region_id || '_x', 'page_common', 0.5::double from regions where seq % 10 = 0
)"""
_VALID = _ANSWERS + """,
fa as (select * from (select *, row_number() over (partition by doc_id, page_no, region_id order by pos) as rn from ans) where rn = 1),
val as (
  select r.doc_id, r.page_no, r.region_id, r.seq, r.x0, r.y0, row_number() over (partition by r.doc_id, r.page_no order by f.pos is null, f.pos, r.seq) as place, f.pos is not null as answered,
         case when coalesce(f.product_id, 'unknown') in ('page_common', 'unknown', 'product_1', 'product_2', 'product_3', 'product_4') then coalesce(f.product_id, 'unknown') else 'unknown' end as product_id,
         coalesce(f.confidence, 0) as confidence
  from regions r left join fa f on r.doc_id = f.doc_id and r.page_no = f.page_no and r.region_id = f.region_id
)"""
_RECOVERED = _VALID + """,
rec as (
  select l.doc_id, l.page_no, printf('p%d_x%03d', l.page_no, l.i + 1) as region_id, l.i, l.x0, l.y0,
         ['attach', 'new', 'decorative', 'page_common', 'needs_review'][(l.i % 5 + 1)::int] as action,
         case when l.i % 2 = 0 then printf('p%d_r%03d', l.page_no, 1 + l.i % 4) end as target, 'product_' || (1 + l.doc_id % 3) as product_id, (l.doc_id + l.i) % 10 / 10.0::double as confidence
  from lines l where not exists (select 1 from owned o where o.doc_id = l.doc_id and o.page_no = l.page_no and o.i = l.i)
), recd as (
  select *, case when action = 'page_common' then 'page_common' else product_id end as owner,
         concat_ws(',', case when action = 'needs_review' then 'recovery_action_uncertain' end, case when confidence < 0.7 then 'recovery_low_confidence' end) as reasons, action = 'decorative' as ignored
  from rec
)"""
_ORDERED = _RECOVERED + """,
al as (
  select doc_id, page_no, region_id, seq, seq as anchor, 0 as late, null::bigint as ky, null::bigint as kx, product_id, null::varchar as related from val
  union all
  select r.doc_id, r.page_no, r.region_id, 1000 + r.i, coalesce(v.seq, 1::bigint << 40), 1, case when v.seq is not null then r.y0 end, case when v.seq is not null then r.x0 end, r.owner, r.target
  from recd r left join val v on v.doc_id = r.doc_id and v.page_no = r.page_no and v.region_id = r.target
), ord as (
  select *, row_number() over (partition by doc_id, page_no order by anchor, late, ky nulls first, kx nulls first, seq, region_id) as page_order,
         row_number() over (partition by doc_id, page_no, product_id order by anchor, late, ky nulls first, kx nulls first, seq, region_id) as product_order from al
), fin as (select *, printf('p%d_r%03d', page_no, page_order) as final_id from ord)"""
_PARENTS = """,
par as (
  select * from (
    select a.doc_id, a.page_no, a.region_id, b.region_id as parent_id, row_number() over (partition by a.doc_id, a.page_no, a.region_id order by (b.x1 - b.x0) * (b.y1 - b.y0), b.seq) as rn
    from regions a join regions b on a.doc_id = b.doc_id and a.page_no = b.page_no and b.x0 <= a.x0 and b.y0 <= a.y0 and b.x1 >= a.x1 and b.y1 >= a.y1
      and (b.x1 - b.x0) * (b.y1 - b.y0) > (a.x1 - a.x0) * (a.y1 - a.y0)) where rn = 1
)"""

ORACLE_SQL = {
    "ownership_validate": D.with_("regions", f"{_VALID} select doc_id, page_no, region_id, place, answered, product_id, confidence from val"),
    "recovery_application": D.with_("regions owned", f"{_RECOVERED} select doc_id, page_no, region_id, owner, action, reasons, ignored from recd"),
    "reading_order": D.with_("regions owned", f"{_ORDERED} select doc_id, page_no, region_id, page_order, product_order from ord"),
    "final_region_ids": D.with_("regions owned", f"{_ORDERED} select doc_id, page_no, region_id as old_id, final_id from fin"),
    "id_reference_rewrite": D.with_(
        "regions owned",
        f"""{_ORDERED}{_PARENTS}
select f.doc_id, f.page_no, f.region_id as source_id, f.final_id as region_id, coalesce(t.final_id, f.related) as related_region_id, coalesce(q.final_id, p.parent_id) as parent_id
from fin f left join par p on p.doc_id = f.doc_id and p.page_no = f.page_no and p.region_id = f.region_id
left join fin t on t.doc_id = f.doc_id and t.page_no = f.page_no and t.region_id = f.related
left join fin q on q.doc_id = f.doc_id and q.page_no = f.page_no and q.region_id = p.parent_id""",
    ),
    "duplicate_region_ids": D.with_("regions", f"{_ANSWERS} select doc_id, page_no, region_id, count(*) as count from ans group by all having count(*) > 1"),
    "review_reason_flags": D.with_(
        "regions owned",
        f"""{_RECOVERED}
select doc_id, page_no, region_id, 'ownership_low_confidence' as code from val where confidence < 0.7 and place % 3 <> 0
union all select doc_id, page_no, region_id, unnest(string_split(reasons, ',')) from recd where reasons <> ''""",
    ),
    "product_fold": """
with t as (select conv_id as doc_id, turn as page_no, 'product_' || (1 + (turn + conv_id) % 3) as product_id, string_split(text, ' ')[1] as name from conversations),
f as (select doc_id, product_id, min(page_no) as first_page, (list(name order by page_no, name))[1] as name from t where (doc_id + page_no) % 4 <> 1 group by all)
select doc_id, product_id, name, first_page, row_number() over (partition by doc_id order by first_page, product_id) as place from f""",
}
