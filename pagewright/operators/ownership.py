"""Model answers on ownership: validated, filled up, applied, put in reading order, renumbered.

An answer can name what it likes; only ids that exist come through, the first answer of each, and every id has one afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..options import DEFAULT
from ..sources.derived import PAGE

COMMON, UNKNOWN = "page_common", "unknown"


def first_answers(answers: DataFrame, known: DataFrame, id_col: str, defaults: dict[str, Column]) -> DataFrame:
    """Each known id of a page once: its first answer by pos, or the defaults; answered says which. Order: answers, then the missing in known order.

    known: PAGE, id_col, seq. answers: PAGE, id_col, pos and the columns named in defaults.
    """
    first = answers.groupBy(*PAGE, id_col).agg(F.min_by(F.struct("pos", *defaults), "pos").alias("a"))
    joined = known.select(*PAGE, id_col, "seq").join(first, [*PAGE, id_col], "left")
    filled = {c: F.when(F.col("a").isNull(), d).otherwise(F.col(f"a.{c}")) for c, d in defaults.items()}
    order = Window.partitionBy(*PAGE).orderBy(F.col("a").isNull(), F.col("a.pos"), "seq")
    return joined.select(*PAGE, id_col, F.row_number().over(order).cast("long").alias("place"), F.col("a").isNotNull().alias("answered"), *[v.alias(c) for c, v in filled.items()])


def allowed_owner(owner: Column, products: Column) -> Column:
    """The owner if it is common, unknown or one of the page's products; else unknown."""
    return F.when(owner.isin(COMMON, UNKNOWN) | F.array_contains(products, owner), owner).otherwise(UNKNOWN)


def product_index(owner: Column) -> Column:
    """The number in product_<number>, else 0."""
    return F.coalesce(F.when(F.regexp_extract(owner, r"product_(\d+)", 1) != "", F.regexp_extract(owner, r"product_(\d+)", 1).cast("long")), F.lit(0).cast("long"))


def product_names(pages: int | Column, used: Column) -> Column:
    """Ids that a page may name: product_1 to the larger of 4 and two more than are used so far."""
    return F.transform(F.sequence(F.lit(1), F.greatest(F.lit(4), used + 2)), lambda k: F.format_string("product_%d", k))


def known_products(owned: DataFrame, named: DataFrame) -> DataFrame:
    """The product list of a document after its last page: doc_id, product_id, name, first_page, place.

    A product enters with the first page where it owns something, with that page's name for it. Pages are in order and a page's
    new products by index, so the list's order is a sort and the fold over pages an aggregate.
    named: PAGE, product_id, name, one row for each that a page names. owned: PAGE, product_id.
    """
    real = lambda df: df.where(~F.col("product_id").isin(COMMON, UNKNOWN))
    seen = real(named).join(real(owned).select(*PAGE, "product_id").distinct(), [*PAGE, "product_id"], "left_semi")
    first = seen.groupBy("doc_id", "product_id").agg(F.min("page_no").alias("first_page"), F.min_by("name", F.struct("page_no", "name")).alias("name"))
    order = Window.partitionBy("doc_id").orderBy("first_page", product_index(F.col("product_id")), "product_id")
    return first.withColumn("place", F.row_number().over(order).cast("long"))


def recovered(candidates: DataFrame, decisions: DataFrame) -> DataFrame:
    """Recovery candidates with a decision as regions: owner, reasons to review, whether their lines may be ignored. None is dropped.

    decisions: PAGE, candidate_id, action, target_region_id, product_id, confidence.
    """
    d = candidates.join(decisions, [*PAGE, "candidate_id"])
    owner = F.when(F.col("action") == COMMON, COMMON).otherwise(F.col("product_id"))
    reasons = F.array_compact(F.array(F.when(F.col("action") == "needs_review", "recovery_action_uncertain"), F.when(F.col("confidence") < DEFAULT.confidence, "recovery_low_confidence")))
    return d.select(*candidates.columns, F.col("candidate_id").alias("region_id"), owner.alias("owner"), "action", "target_region_id", reasons.alias("reasons"), (F.col("action") == "decorative").alias("ignored"))


def reading_order(regions: DataFrame) -> DataFrame:
    """place within the page and within page and product.

    regions: PAGE, region_id, seq, origin ('layout' or 'recovery'), related_region_id, product_id, y0, x0. Layout regions keep their order; a
    recovered one follows the region that it belongs to, by place; those that belong to none of the page come last, as they came.
    """
    base = regions.where("origin = 'layout'").select(*PAGE, F.col("region_id").alias("related_region_id"), F.col("seq").alias("anchor"))
    joined = regions.join(base, [*PAGE, "related_region_id"], "left")
    layout = F.col("origin") == "layout"
    anchor = F.when(layout, F.col("seq")).otherwise(F.coalesce("anchor", F.lit(1 << 40)))
    attached = ~layout & F.col("anchor").isNotNull()
    keys = [anchor, (~layout).cast("int"), F.when(attached, F.col("y0")), F.when(attached, F.col("x0")), F.col("seq"), F.col("region_id")]
    whole, own = Window.partitionBy(*PAGE).orderBy(*keys), Window.partitionBy(*PAGE, "product_id").orderBy(*keys)
    return joined.select(*regions.columns, F.row_number().over(whole).cast("long").alias("page_order"), F.row_number().over(own).cast("long").alias("product_order"))


def renumber(ordered: DataFrame) -> DataFrame:
    """old_id and final_id p<page>_r<place>, by page_order."""
    return ordered.select(*PAGE, F.col("region_id").alias("old_id"), F.format_string("p%d_r%03d", "page_no", "page_order").alias("final_id"), "page_order")


def rewrite(df: DataFrame, ids: DataFrame, single: tuple[str, ...] = (), lists: tuple[str, ...] = ()) -> DataFrame:
    """References by old id as references by final id; one that is unknown stays as it is. One map per page, joined once."""
    maps = ids.groupBy(*PAGE).agg(F.map_from_entries(F.collect_list(F.struct("old_id", "final_id"))).alias("of_id"))
    new = lambda x: F.coalesce(F.try_element_at("of_id", x), x)
    joined = df.join(maps, list(PAGE), "left")
    return joined.withColumns({c: new(F.col(c)) for c in single} | {c: F.transform(c, new) for c in lists}).drop("of_id")


def duplicates(df: DataFrame, keys: tuple[str, ...], id_col: str) -> DataFrame:
    """Ids that are blank or occur again: an export must have none."""
    return df.groupBy(*keys, id_col).count().where((F.col("count") > 1) | F.col(id_col).isNull() | (F.trim(id_col) == ""))


def low_confidence(decisions: DataFrame, code: str, id_col: str, least: float = DEFAULT.confidence) -> DataFrame:
    return decisions.where(F.col("confidence") < least).select(*PAGE, F.col(id_col).alias("region_id"), F.lit(code).alias("code"))


def review_reasons(reasons: DataFrame, withdrawn: DataFrame | None = None) -> DataFrame:
    """Each reason of a region once, without the withdrawn ones."""
    found = reasons.dropDuplicates([*PAGE, "region_id", "code"])
    return found if withdrawn is None else found.join(withdrawn, [*PAGE, "region_id", "code"], "left_anti")
