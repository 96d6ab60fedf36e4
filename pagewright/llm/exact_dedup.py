"""Exact dedup by progressive refinement: length, then prefix hash, then full hash. DataFrame functions only.

A column file gives no length without its text, so the one scan computes the three keys of a row together and no text is
ever shuffled; each level then looks only at rows whose group survived the level before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import ascii_lower, masked, store

PREFIX_CHARS = 64
#: Groups that hold a share of 1 in HOT_SHARE of all rows, and so HOT_SHARE at most, are sent to all tasks.
HOT_SHARE = 10_000


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null equals empty. The largest id of a group stays, null being
    smallest; of rows that repeat id and text, exactly one has kept = true. keep_id is null only if all ids are. Other columns
    of docs, whatever their names, take no part. An empty table gives an empty result.
    """
    text = ascii_lower(F.col(text_col))
    rows = store(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.octet_length(text).cast("long").alias("n_bytes"),
            F.xxhash64(F.substring(text, 1, PREFIX_CHARS)).alias("prefix"),
            F.sha2(text, 256).alias("text_sha256"),
            F.monotonically_increasing_id().alias("row_no"),
        ),
        "exact_rows",
    )
    lengths = store(rows.groupBy("n_bytes").count().where("count > 1").select("n_bytes"), "exact_lengths")
    alike = rows.join(lengths, "n_bytes", "left_semi")
    prefixes = store(alike.groupBy("n_bytes", "prefix").count().where("count > 1").drop("count"), "exact_prefixes")
    alike = alike.join(prefixes, ["n_bytes", "prefix"], "left_semi")
    # A sort-based aggregate, partial before its shuffle: copies meet as one row a task. A null id is the smallest.
    stays = (
        alike.groupBy("text_sha256").agg(F.count("*").alias("group_size"), F.max(F.struct("doc_id", "row_no")).alias("top")).where("group_size > 1")
        .select("text_sha256", F.col("top.doc_id").alias("keep_id"), "group_size", F.col("top.row_no").alias("stay_no"))
    )
    groups = store(stays, "exact_groups")
    # Rows of large groups, of which there can be but HOT_SHARE, stay where they are; the others meet their group by its digest.
    hot = F.col("group_size") * HOT_SHARE >= rows.count()
    large = groups.where(hot).withColumnsRenamed({"text_sha256": "hot_sha", "keep_id": "hot_id", "group_size": "hot_size", "stay_no": "hot_no"})
    seen = rows.join(F.broadcast(large), F.col("text_sha256") == F.col("hot_sha"), "left")
    seen = seen.withColumn("meets", F.when(F.col("hot_sha").isNotNull(), F.col("row_no").cast("string")).otherwise(F.col("text_sha256")))
    small = groups.where(~hot).withColumnRenamed("text_sha256", "of_sha")
    found = seen.join(small, F.col("meets") == F.col("of_sha"), "left")
    size, stay = F.coalesce("hot_size", "group_size"), F.coalesce("hot_no", "stay_no")
    return found.select(
        "doc_id",
        F.when(size.isNull(), F.col("doc_id")).when(F.col("hot_sha").isNotNull(), F.col("hot_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce(size, F.lit(1).cast("long")).alias("group_size"),
        (stay.isNull() | (stay == F.col("row_no"))).alias("kept"),
        "text_sha256",
    )


def drop_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the rows that exact_groups() drops; the columns of docs, of any names, in their order."""
    whole = docs.columns
    docs, named = masked(docs)
    id_col, text_col, names, spare = named[id_col], named[text_col], docs.columns, "pw_sha"
    found = exact_groups(docs, id_col, text_col).where("group_size > 1")
    decided = store(
        found.groupBy("doc_id", "text_sha256").agg(F.max("kept").alias("stays"), F.count("*").alias("copies")).withColumnsRenamed({"doc_id": "pw_id", "text_sha256": "pw_key"}),
        "exact_decided",
    )
    keyed = docs.withColumn(spare, F.sha2(ascii_lower(F.col(text_col)), 256))
    at = (keyed[spare] == decided["pw_key"]) & keyed[id_col].eqNullSafe(decided["pw_id"])
    # What goes grows with the input, so texts are shuffled, once, at any size: the plan doesn't change as tables grow.
    once = keyed.join(decided.where("not stays or copies > 1").hint("merge"), at, "left_anti").select(names)
    repeated = decided.where("stays and copies > 1")
    if repeated.isEmpty():
        return once.toDF(*whole)
    # A stayer whose row is repeated: one of its identical rows stays.
    again = keyed.join(repeated, at, "left_semi").dropDuplicates([id_col, spare]).select(names)
    return once.unionByName(again).toDF(*whole)
