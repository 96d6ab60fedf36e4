"""Evidence tables derived from the synthetic tables with integer arithmetic, and the same as SQL for the second engine.

A document's text lines are page lines, 40 to a page; every three lines are a layout block, some with a nested title block.
All later operators work on these tables or on the caller's own of the same shape.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

PAGE = ("doc_id", "page_no")


#: Bytes of files that make a partition of rows dealt by key.
PIECE = 16 << 20


def dealt(rows: DataFrame, of: DataFrame, *keys: str, stated: bool = False) -> DataFrame:
    """rows dealt by keys, into more partitions the larger the files of `of` are, so that a task's rows, and what it sorts, do not grow with the input.

    stated: their number is stated for small files too, for plans that unite branches. Partitions without a number are joined into fewer at run time, in
    each branch by itself, while the union's rows still count as dealt by key (Spark 4.1), so that a key's rows were met in parts.
    """
    least = int(of.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = min(int(str(of._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) // PIECE, 1 << 14)
    if pieces <= least and not stated:
        return rows.repartition(*keys)
    return rows.repartition(max(least, pieces), *keys)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def lines(spark: SparkSession, folder: str, stated: bool = False) -> DataFrame:
    """doc_id, page_no, i, text, source, box; dealt by page, the partitioning that all page-wise operators need."""
    documents = table(spark, folder, "documents")
    raw = documents.select("doc_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("i", "text"))
    i = F.col("i").cast("long")
    x0, y0 = 40 + (i % 3) * 4, (i % 40) * 24
    found = raw.where(F.trim("text") != "").select(
        "doc_id",
        F.expr("cast(i div 40 + 1 as bigint)").alias("page_no"),
        i.alias("i"),
        "text",
        F.when(i % 2 == 0, "digital").otherwise("ocr").alias("source"),
        x0.alias("x0"),
        y0.alias("y0"),
        (x0 + F.least(F.length("text") * 8, F.lit(1500))).cast("long").alias("x1"),
        (y0 + 16 + (F.col("doc_id") + i) % 5).alias("y1"),
    )
    return dealt(found, documents, *PAGE, stated=stated)


def regions(of_lines: DataFrame) -> DataFrame:
    """doc_id, page_no, seq, region_id, box, label, content, from the lines of a page."""
    kept = of_lines.where((F.col("doc_id") + F.col("i")) % 7 != 0).withColumn("g", F.expr("(i % 40) div 3"))
    first = F.min(F.struct("i", "x0", "y0", "x1", "y1", "text"))
    per = kept.groupBy(*PAGE, "g").agg(
        F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "text"))), lambda s: s["text"]), "\n").alias("content"),
        first.alias("f"),
    )
    whole = F.struct((F.col("g") * 2).alias("ord"), "x0", "y0", "x1", "y1", F.lit("text").alias("label"), "content")
    nested = F.struct((F.col("g") * 2 + 1).alias("ord"), *[F.col(f"f.{c}").alias(c) for c in ("x0", "y0", "x1", "y1")], F.lit("paragraph_title").alias("label"), F.col("f.text").alias("content"))
    blocks = per.select(*PAGE, F.explode(F.when((F.col("doc_id") + F.col("g")) % 5 == 0, F.array(whole, nested)).otherwise(F.array(whole))).alias("b")).select(*PAGE, "b.*")
    return with_region_ids(blocks, "ord").drop("ord")


def with_region_ids(blocks: DataFrame, *order: str) -> DataFrame:
    """seq and region_id p<page>_r<seq> in the given order within a page."""
    seq = F.row_number().over(Window.partitionBy(*PAGE).orderBy(*order)).cast("long")
    return blocks.withColumn("seq", seq).withColumn("region_id", F.format_string("p%d_r%03d", "page_no", "seq"))


#: The same tables in SQL: with_() puts these in front of a query.
_SQL = {
    "lines": """select doc_id, i // 40 + 1 as page_no, i, line as text, case when i % 2 = 0 then 'digital' else 'ocr' end as source,
  40 + (i % 3) * 4 as x0, (i % 40) * 24 as y0, 40 + (i % 3) * 4 + least(length(line) * 8, 1500) as x1, (i % 40) * 24 + 16 + (doc_id + i) % 5 as y1
  from (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 as i from documents)
  where trim(line) <> ''""",
    "kept": "select *, (i % 40) // 3 as g from lines where (doc_id + i) % 7 <> 0",
    "grouped": """select doc_id, page_no, g, min(x0) as x0, min(y0) as y0, max(x1) as x1, max(y1) as y1, string_agg(text, chr(10) order by i) as content, min(i) as i0
  from kept group by doc_id, page_no, g""",
    "regions": """select *, row_number() over (partition by doc_id, page_no order by ord) as seq,
  printf('p%d_r%03d', page_no, row_number() over (partition by doc_id, page_no order by ord)) as region_id
  from (select doc_id, page_no, g * 2 as ord, x0, y0, x1, y1, 'text' as label, content from grouped
        union all
        select k.doc_id, k.page_no, k.g * 2 + 1, k.x0, k.y0, k.x1, k.y1, 'paragraph_title', k.text
        from kept k join grouped b on k.doc_id = b.doc_id and k.page_no = b.page_no and k.g = b.g and k.i = b.i0 where (k.doc_id + k.g) % 5 = 0)""",
    "pairs": """select l.doc_id, l.page_no, l.i, l.text, l.source, l.x0, l.y0, l.x1, l.y1, r.seq, r.region_id, (r.x1 - r.x0) * (r.y1 - r.y0) as region_area,
  (greatest(0, least(l.x1, r.x1) - greatest(l.x0, r.x0)) * greatest(0, least(l.y1, r.y1) - greatest(l.y0, r.y0)))::double / greatest(1, (l.x1 - l.x0) * (l.y1 - l.y0)) as ov
  from lines l join regions r on l.doc_id = r.doc_id and l.page_no = r.page_no""",
    "owned": "select * from (select *, row_number() over (partition by doc_id, page_no, i order by ov desc, region_area, seq) as rn from pairs where ov >= 0.5) where rn = 1",
}
_NEEDS = {"lines": [], "kept": ["lines"], "grouped": ["kept"], "regions": ["grouped", "kept"], "pairs": ["lines", "regions"], "owned": ["pairs"]}


def with_(names: str, query: str) -> str:
    """SQL with the named derived tables, and those that they need, in front."""
    found: list[str] = []

    def add(name: str) -> None:
        for x in _NEEDS[name]:
            add(x)
        if name not in found:
            found.append(name)

    for name in names.split():
        add(name)
    more = query.strip()
    joined = ",\n".join(f"{x} as ({_SQL[x]})" for x in found)
    return f"with {joined}{',' if not more.lower().startswith('select') else ''}\n{more}"
