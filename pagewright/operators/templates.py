"""Templates of products: which one a product's evidence points to, which labels it allows, how a document is reviewed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..options import DEFAULT
from .ownership import COMMON, UNKNOWN

SHOWN, NOT_SHOWN, UNDECIDED, OTHER = "노출", "미노출", "판단불가", "기타"

# Words of a file name that point to a product group, groups in order of priority.
NAME_WORDS = {
    "카드": ("카드상품", "카드"),
    "투자성": ("투자성", "ISA", "개인종합자산관리계좌", "IRP", "퇴직연금", "펀드"),
    "예금성": ("예금성", "예금", "적금", "입출금"),
    "대출성": ("대출성", "대출", "신용대출", "담보"),
}
# Words of a whole text, lower case, that point to a product group, in order of priority.
TEXT_WORDS = {
    "투자성": ("투자성", "isa", "개인종합자산관리계좌", "irp", "퇴직연금", "펀드", "집합투자"),
    "카드": ("카드상품", "카드대출"),
    "대출성": ("대출성", "대출상품", "대출한도", "대출금리"),
    "예금성": ("예금성", "예금상품", "적금", "입출금"),
}
# The rules for a template, the first that holds counts. (group, name shown or any, words of which the text has one, words of which it has
# none, template); an exclusive rule holds only if no other exclusive rule of its group does.
RULES: tuple[tuple[str, str | None, tuple[str, ...], tuple[str, ...], str, bool], ...] = (
    ("대출성", None, ("대출모집", "잔금대출"), (), "대출성상품-대출모집인(잔금대출)", False),
    ("대출성", SHOWN, (), (), "대출성상품-상품명 노출", False),
    ("대출성", NOT_SHOWN, (), (), "대출성상품-상품명 미노출", False),
    ("예금성", NOT_SHOWN, (), (), "예금성상품-상품명 미노출", False),
    ("예금성", None, ("지수연동", "eld"), (), "예금성상품-지수연동예금", True),
    ("예금성", None, ("적립식", "적금"), (), "예금성상품-적립식", True),
    ("예금성", None, ("거치식", "정기예금"), (), "예금성상품-거치식", True),
    ("예금성", None, ("입출식", "입출금", "요구불"), (), "예금성상품-입출식", True),
    ("카드", None, ("장기카드대출", "단기카드대출", "카드론"), (), "카드상품-장·단기카드대출", False),
    ("카드", NOT_SHOWN, (), (), "카드상품-상품명 미노출", False),
    ("카드", SHOWN, ("법인카드",), (), "카드상품-상품명(법인) 노출", False),
    ("카드", SHOWN, ("개인카드",), (), "카드상품-상품명(개인) 노출", False),
    ("투자성", None, ("isa&신탁형", "개인종합자산관리계좌&신탁형"), ("일임형",), "투자성상품-개인종합자산관리계좌(ISA) 신탁형", False),
    ("투자성", None, ("isa&일임형", "개인종합자산관리계좌&일임형"), ("신탁형",), "투자성상품-개인종합자산관리계좌(ISA) 일임형", False),
    ("투자성", None, ("isa", "개인종합자산관리계좌"), (), "투자성상품-개인종합자산관리계좌(ISA) 일반", False),
    ("투자성", None, tuple(f"{a}&{b}" for a in ("퇴직연금", "irp") for b in ("펀드상품", "집합투자증권", "펀드 노출")), (), "투자성상품-퇴직연금(IRP) 펀드상품 노출", False),
    ("투자성", None, ("퇴직연금&금융투자상품 미노출", "irp&금융투자상품 미노출"), (), "투자성상품-퇴직연금(IRP) 금융투자상품 미노출", False),
    ("투자성", None, ("퇴직연금", "irp"), (), "투자성상품-퇴직연금 일반", False),
    ("투자성", None, ("펀드", "집합투자"), (), "투자성상품-펀드", False),
)
#: Labels of every template, and of each group's: the catalog that ships with the engine; a caller may bring another.
EVERY_LABEL = ("회사명", "유의사항", "심의번호")
GROUP_LABELS = {
    "대출성": ("상품명", "대출대상", "대출한도", "대출기간", "대출금리", "상환방법", "부대비용"),
    "예금성": ("상품명", "가입대상", "가입금액", "가입기간", "금리", "우대금리", "예금자보호"),
    "카드": ("상품명", "연회비", "수수료"),
    "투자성": ("상품명", "수수료", "가입대상"),
}


def catalog_rows() -> list[tuple[str, int, str, int, str]]:
    """(template_id, template_pos, product_group, label_pos, label) of the shipped catalog; a template that hides the product's name has no label for it."""
    found = []
    for pos, (group, _, _, _, template, _) in enumerate(RULES):
        own = [x for x in GROUP_LABELS[group] if not (x == "상품명" and template.endswith(NOT_SHOWN))]
        found += [(template, pos, group, k, x) for k, x in enumerate(own + list(EVERY_LABEL))]
    return found


def has_words(text: Column, words: tuple[str, ...]) -> Column:
    """Whether the text has one of the words; a&b: both."""
    out = F.lit(False)
    for w in words:
        one = F.lit(True)
        for part in w.split("&"):
            one = one & F.contains(text, F.lit(part))
        out = out | one
    return out


def first_group(text: Column, words: dict[str, tuple[str, ...]]) -> Column:
    """The first group of which the text has a word."""
    return F.coalesce(*[F.when(has_words(text, w), F.lit(g)) for g, w in words.items()])


def rule_template(group: Column, shown: Column, text: Column) -> Column:
    """The template that the rules choose, null if none does."""
    text = F.lower(text)
    hold = [(group == g) & (F.lit(True) if s is None else shown.eqNullSafe(F.lit(s))) & (has_words(text, some) if some else F.lit(True)) & ~has_words(text, none) for g, s, some, none, _, _ in RULES]
    alone = sum((F.coalesce(h, F.lit(False)).cast("int") for h, r in zip(hold, RULES, strict=True) if r[5]), F.lit(0)) == 1
    return F.coalesce(*[F.when(h & alone if r[5] else h, F.lit(r[4])) for h, r in zip(hold, RULES, strict=True)])


def classify(docs: DataFrame) -> DataFrame:
    """product_group and category_source from the file name's prior and a model's answer. docs: source_file, answered (whether one came), vlm_group."""
    prior = first_group(F.col("source_file"), NAME_WORDS)
    abstains = F.coalesce(F.col("answered") & F.col("vlm_group").isin(OTHER, UNDECIDED), F.lit(False))
    said = F.when(F.col("answered") & ~abstains, F.col("vlm_group"))
    source = (
        F.when(prior.isNotNull() & said.isNotNull(), F.when(prior == said, "filename_and_vlm").otherwise("vlm_overrode_filename"))
        .when(said.isNotNull(), "vlm").when(prior.isNotNull() & abstains, "filename_vlm_abstained").when(prior.isNotNull(), "filename_vlm_failed").when(abstains, "vlm_abstained").otherwise("none")
    )
    return docs.withColumns({"product_group": F.coalesce(said, prior), "category_source": source})


def common_labels(items: DataFrame) -> DataFrame:
    """Labels of all templates, in the order of the first one. items: template_id, template_pos, label, label_pos."""
    n = items.agg(F.countDistinct("template_id").alias("n"))
    per = items.groupBy("label").agg(F.countDistinct("template_id").alias("has"), F.min_by("label_pos", F.struct("template_pos", "label_pos")).alias("pos"))
    return per.join(n, F.col("has") == F.col("n")).select("label", F.col("pos").cast("long").alias("pos"))


def label_union(rows: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Every label of a key once, by its first place. rows: keys, list_pos, label_pos, label."""
    first = rows.groupBy(*keys, "label").agg(F.min(F.struct("list_pos", "label_pos")).alias("p"))
    return first.select(*keys, "label", F.row_number().over(Window.partitionBy(*keys).orderBy("p", "label")).cast("long").alias("place"))


def product_values(products: DataFrame, field: str, doc_value: str) -> DataFrame:
    """The document's value for all products if their own don't differ and it has one; else each its own."""
    own = T.nullable(F.when(F.col(field) != UNDECIDED, F.col(field)))
    kinds = F.size(F.collect_set(own).over(Window.partitionBy("doc_id")))
    whole = T.nullable(F.when(F.col(doc_value) != UNDECIDED, F.col(doc_value)))
    return products.withColumn(f"{field}_of", F.when((kinds <= 1) & whole.isNotNull(), whole).otherwise(own))


def first_meta(products: DataFrame) -> DataFrame:
    """A product's data as the first page that names it has them."""
    return products.where("product_id <> ''").groupBy("doc_id", "product_id").agg(F.min_by(F.struct("page_no", "name", "product_group"), F.struct("page_no", "pos")).alias("m")).select("doc_id", "product_id", "m.*")


def check_names(products: DataFrame) -> DataFrame:
    """effective and status: whether the product's own text shows its name. products: name, reported, text."""
    key = T.plain("name")
    found = (F.length(key) >= 4) & F.contains(T.plain("text"), key)
    reported = F.col("reported").eqNullSafe(F.lit(SHOWN))
    status = (
        F.when(found & ~reported, "corrected_to_shown").when(found, "verified_shown").when(reported, "shown_not_verified_in_product_regions")
        .when(F.trim(F.coalesce("name", F.lit(""))) == "", "name_missing").otherwise("not_shown_in_product_regions")
    )
    return products.withColumns({"effective": F.when(found, SHOWN).otherwise(F.col("reported")), "name_status": status})


def resolve(products: DataFrame, candidates: DataFrame) -> DataFrame:
    """template_id, status, source: by the rules, a group's only candidate, or the model's answer on several.

    products: key columns, product_group, shown, haystack, answer, answer_confidence, failed; candidates: product_group, template_id.
    """
    per = candidates.groupBy("product_group").agg(F.sort_array(F.collect_set("template_id")).alias("c")).withColumnRenamed("product_group", "c_group")
    every = candidates.agg(F.sort_array(F.collect_set("template_id")).alias("every"))
    p = products.withColumn("by_rule", rule_template(F.col("product_group"), F.col("shown"), F.col("haystack")))
    p = p.join(F.broadcast(per), F.col("product_group") == F.col("c_group"), "left").crossJoin(F.broadcast(every))  # both sides: one row per group, one row
    c = F.when(F.col("product_group").isNull(), F.col("every")).otherwise(F.coalesce("c", F.array().cast("array<string>")))
    known = F.array_contains(c, F.col("answer"))
    unsure = F.coalesce(F.col("answer_confidence") >= DEFAULT.confidence, F.lit(False))
    template = F.when(F.col("by_rule").isNotNull(), F.col("by_rule")).when(F.size(c) == 1, F.element_at(c, 1)).when(~F.col("failed") & known, F.col("answer"))
    status = (
        F.when(F.col("by_rule").isNotNull() | (F.size(c) == 1), "confirmed").when((F.size(c) == 0) | F.col("failed") | ~F.coalesce(known, F.lit(False)), "unresolved").when(unsure, "confirmed").otherwise("needs_review")
    )
    source = F.when(F.col("by_rule").isNotNull() | (F.size(c) == 1), "rules").when(F.size(c) == 0, "none").when(F.col("failed"), "vlm_failed").otherwise("vlm")
    return p.withColumns({"template_id": template, "status": status, "source": source}).drop("by_rule", "c", "c_group", "every")


def document_template(products: DataFrame) -> DataFrame:
    """One template if all products have the same, else the list of them. products: doc_id, product_id, template_id."""
    per = products.where(F.col("product_id") != COMMON).groupBy("doc_id").agg(F.sort_array(F.collect_set("template_id")).alias("ids"))
    one = F.size("ids") == 1
    return per.select(
        "doc_id", F.when(one, F.element_at("ids", 1)).alias("template_id"),
        F.when(one, "document").otherwise("per_product").alias("scope"),
        F.when(one, "single").when(F.size("ids") > 1, "multi_product").otherwise("unresolved").alias("status"), "ids",
    )


def review_units(products: DataFrame, regions: DataFrame) -> DataFrame:
    """A row per product of a document: its regions and, in each unit again, the common ones, in page order.

    products: doc_id, product_id, template_id; regions: doc_id, page_no, page_order, region_id, product_id.
    """
    ids = lambda cond: F.transform(F.array_sort(F.collect_list(F.when(cond, F.struct("page_no", "page_order", "region_id")))), lambda s: s["region_id"])
    own = regions.groupBy("doc_id", "product_id").agg(ids(F.lit(True)).alias("region_ids"))
    common = regions.where(F.col("product_id") == COMMON).groupBy("doc_id").agg(ids(F.lit(True)).alias("common_ids"))
    none = F.array().cast("array<string>")
    p = products.where(~F.col("product_id").isin(COMMON, UNKNOWN)).join(own, ["doc_id", "product_id"], "left").join(common, "doc_id", "left")
    return p.select("doc_id", F.concat(F.lit("review_"), "product_id").alias("unit_id"), "product_id", "template_id", F.coalesce("region_ids", none).alias("region_ids"), F.coalesce("common_ids", none).alias("common_ids"))


def examples(items: DataFrame, most: int = 2) -> DataFrame:
    """The first `most` different examples of a label of a template. items: template_id, label, pos, example."""
    one = items.withColumn("example", T.one_space("example")).where("example <> ''").groupBy("template_id", "label", "example").agg(F.min("pos").alias("pos"))
    nr = F.row_number().over(Window.partitionBy("template_id", "label").orderBy("pos"))
    return one.withColumn("nr", nr.cast("long")).where(F.col("nr") <= most)
