"""Mixing sources to target weights: hash-random keys, key ranges within each source, distributed prefix sums, exact cuts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import masked, store, word_count

WEIGHTS = (1, 2, 3)
MOST_EPOCHS = 3
RANGES_PER_PARTITION = 4
_HEX = 12  # hex digits of a key that place it in a range: 48 bits, exact as a double


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """One row per source of sizes(source, size): no_source, source, source_size, n_rows, target.

    Sources by code point, null last, weigh as weights in turn. Targets are in proportion and share all sizes; a target stops at
    most_epochs times its source's size and the excess goes to the others by weight. Only this table, a row per source, is
    ordered as a whole.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    nth = (F.row_number().over(order) - 1) % len(weights) + 1
    per = per.withColumn("weight", F.element_at(F.array([F.lit(float(w)) for w in weights]), nth))
    per = per.withColumn("ceiling", (F.col("source_size") * most_epochs).cast("double"))
    by_need = Window.orderBy(F.col("ceiling") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    level = (F.sum(F.col("source_size").cast("double")).over(everything) - F.coalesce(F.sum("ceiling").over(by_need.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))) / F.sum("weight").over(by_need.rowsBetween(0, Window.unboundedFollowing))
    per = per.withColumn("level", level).withColumn("level", F.max("level").over(everything))
    target = F.when(F.col("ceiling") / F.col("weight") <= F.col("level"), F.col("ceiling")).otherwise(F.col("level") * F.col("weight"))
    return per.select(F.col("source").isNull().alias("no_source"), F.coalesce("source", F.lit("")).alias("source"), "source_size", "n_rows", target.alias("target"))


def mix_sources(rows: DataFrame, size: Column, id_col: str = "doc_id", source_col: str = "source", weights: Sequence[int] = WEIGHTS, most_epochs: int = MOST_EPOCHS, seed: int = 0, ties: Sequence[Column] = ()) -> DataFrame:
    """The rows, all their columns kept, with mix_size, mix_source_size, mix_target (double) and mix_taken (long).

    Within a source, rows stand in the order of a hash of seed and id; the budget, the rounded target, takes whole epochs of the
    source and then the first words in that order, cut at exactly the budget. Rows that repeat an id stand together, ordered
    by size and ties; those without one, which may be many, stand by a hash of size and ties. A null source is a source; empty
    texts take 0; an empty table gives an empty result. Names that begin with mix_ must not occur in rows (see scratch.masked).
    """
    spark = rows.sparkSession
    nameless = F.concat_ws(":", F.lit("null"), size.cast("string"), *[t.cast("string") for t in ties])
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), nameless)))
    slim = store(rows.select(F.col(source_col).alias("source"), size.alias("size"), F.substring(key, 1, _HEX).alias("key")), "mix_sizes")
    place = F.conv(F.col("key"), 16, 10).cast("double") / float(16**_HEX)
    # As many key ranges as keep every range small, also those of a source with a third of all rows.
    parts = RANGES_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    targets = source_targets(slim, weights, most_epochs)
    targets = targets.withColumn("n_ranges", F.greatest(F.lit(1), F.ceil(F.col("n_rows") * parts / F.sum("n_rows").over(Window.partitionBy()))))
    budget = F.least(F.floor(F.col("target") + 0.5), F.col("source_size") * most_epochs).cast("long")
    whole = F.when(F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(F.lit(0))
    targets = targets.withColumn("budget", budget).withColumn("whole", whole.cast("long")).withColumn("part", F.col("budget") - F.col("whole") * F.col("source_size"))
    targets = store(targets, "mix_targets")

    ranged = (
        slim.select(F.col("source").isNull().alias("no_source"), F.coalesce("source", F.lit("")).alias("source"), "size", place.alias("place"))
        .join(targets, ["no_source", "source"])
        .groupBy("no_source", "source", F.floor(F.col("place") * F.col("n_ranges")).alias("range_no"))
        .agg(F.sum("size").alias("range_size"), *[F.first(c).alias(c) for c in ("source_size", "target", "whole", "part")])
    )
    before = F.sum("range_size").over(Window.partitionBy("no_source", "source").orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1))
    ranges = store(ranged.withColumn("before", F.coalesce(before, F.lit(0))), "mix_ranges")

    named = {"no_source": "mix_none", "source": "mix_name"}
    keyed = rows.withColumns({"mix_size": size, "mix_none": F.col(source_col).isNull(), "mix_name": F.coalesce(F.col(source_col), F.lit("")), "mix_key": key})
    keyed = keyed.join(targets.select("no_source", "source", F.col("n_ranges").alias("mix_ranges")).withColumnsRenamed(named), ["mix_none", "mix_name"])
    keyed = keyed.withColumn("mix_range", F.floor(F.conv(F.substring("mix_key", 1, _HEX), 16, 10).cast("double") / float(16**_HEX) * F.col("mix_ranges")))
    within = Window.partitionBy("mix_none", "mix_name", "mix_range").orderBy("mix_key", F.col(id_col), "mix_size", *ties).rowsBetween(Window.unboundedPreceding, -1)
    keyed = keyed.withColumn("mix_run", F.coalesce(F.sum("mix_size").over(within), F.lit(0)))
    found = ranges.select(*[F.col(c).alias(named.get(c, f"mix_{c}")) for c in ("no_source", "source", "before", "source_size", "target", "whole", "part")], F.col("range_no").alias("mix_range"))
    mixed = keyed.join(found, ["mix_none", "mix_name", "mix_range"])
    left = F.col("mix_part") - F.col("mix_before") - F.col("mix_run")
    taken = F.col("mix_whole") * F.col("mix_size") + F.greatest(F.lit(0), F.least(left, F.col("mix_size")))
    return mixed.select(*[F.col(c) for c in rows.columns], "mix_size", "mix_source_size", "mix_target", taken.cast("long").alias("mix_taken"))


def mixture_table(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken, source for every row of docs, texts scanned once."""
    sizes = store(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("tie")), "mix_documents")
    mixed = mix_sources(sizes, F.col("size"), ties=[F.col("tie")])
    return mixed.select("doc_id", "size", F.col("mix_source_size").alias("source_size"), F.col("mix_target").alias("target"), F.col("mix_taken").alias("taken"), "source")


def mix_documents(docs: DataFrame) -> DataFrame:
    """docs as the mix has them: a row for each epoch that takes the document, the cut one once more if at least half is taken.

    A document of no words, which no budget counts, stays once.
    """
    plain, names = masked(docs)
    text = names["text"]
    mixed = mix_sources(plain, word_count(F.col(text)), names["doc_id"], names["source"], ties=[F.xxhash64(text)])
    whole = F.expr("mix_taken div mix_size") + F.when(F.col("mix_taken") % F.col("mix_size") * 2 >= F.col("mix_size"), 1).otherwise(0)
    copies = F.when(F.col("mix_size") == 0, F.lit(1)).otherwise(whole.cast("int"))
    return mixed.withColumn("mix_copy", F.explode(F.array_repeat(F.lit(0), copies))).select(plain.columns).toDF(*docs.columns)
