"""What leaves the engine: review records, summaries, stage views, call statistics, files."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from ..functions import text as T
from ..sources.derived import PAGE

REGION_ID = r"^p\d+_r\d{3,}$"


def source_grade(text_source: Column) -> Column:
    """vlm, digital, hwp or ocr, by how the source's name begins; the longer beginnings first."""
    s = F.coalesce(text_source, F.lit(""))
    begins = (("vlm", "vlm"), ("digital", "digital"), ("hwp_structure", "hwp"), ("document_processor_html", "hwp"), ("document_processor", "digital"))
    return F.coalesce(*[F.when(F.startswith(s, F.lit(b)), F.lit(g)) for b, g in begins], F.lit("ocr"))


def review_regions(regions: DataFrame) -> DataFrame:
    """Regions as a reviewer gets them: none without text and box, labels trimmed and once each, kind table where there is one.

    regions: PAGE, region_id, page_order, has_box, text, text_source, labels, kind, has_table, product_id.
    """
    kept = regions.where((F.trim(F.coalesce("text", F.lit(""))) != "") | F.col("has_box"))
    labels = F.array_distinct(F.filter(F.transform("labels", lambda x: F.trim(x)), lambda x: x != ""))
    kind = F.when((F.col("kind") == "table") | F.coalesce("has_table", F.lit(False)), "table").otherwise(F.coalesce("kind", F.lit("text")))
    return kept.select(*PAGE, "region_id", "page_order", F.coalesce("text", F.lit("")).alias("text"), source_grade(F.col("text_source")).alias("source"), labels.alias("labels"), kind.alias("kind"), "product_id")


def bad_ids(regions: DataFrame) -> DataFrame:
    """Regions whose id has another form or occurs again in its document; an export with any is refused."""
    again = regions.groupBy("doc_id", "region_id").agg(F.count("*").alias("n"))
    return again.where(~F.rlike(F.coalesce("region_id", F.lit("")), F.lit(REGION_ID)) | (F.col("n") > 1))


def checked(regions: DataFrame) -> DataFrame:
    """regions, failing when read if an id has another form."""
    good = F.rlike(F.coalesce("region_id", F.lit("")), F.lit(REGION_ID))
    return regions.withColumn("region_id", F.when(good, F.col("region_id")).otherwise(F.raise_error(F.concat(F.lit("region id out of form: "), F.coalesce("region_id", F.lit("null"))))))


def review_documents(regions: DataFrame) -> DataFrame:
    """One JSON record per document: its pages, their regions in order."""
    region = F.struct("region_id", "kind", "text", "source", "labels", "product_id")
    pages = regions.groupBy(*PAGE).agg(F.transform(F.array_sort(F.collect_list(F.struct("page_order", "region_id", region.alias("r")))), lambda s: s["r"]).alias("regions"))
    docs = pages.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("page_no", "regions"))).alias("pages"))
    return docs.select("doc_id", F.to_json(F.struct(F.lit("region-review-v1").alias("contract"), "doc_id", "pages")).alias("record"))


def summary(regions: DataFrame) -> DataFrame:
    """Per document: pages, regions, those without text, with several labels, with none, to be reviewed."""
    n = F.size("labels")
    return regions.groupBy("doc_id").agg(F.countDistinct("page_no").alias("pages"), F.count("*").alias("regions"), F.count_if(F.trim("text") == "").alias("blank"), F.count_if(n > 1).alias("multi_label"), F.count_if(n == 0).alias("no_label"), F.count_if(F.col("kind") == "table").alias("tables"))


def call_stats(calls: DataFrame) -> DataFrame:
    """calls, cached, seconds, attempts by schema, and of all as `total`."""
    per = calls.rollup("schema").agg(F.count("*").alias("calls"), F.count_if("cached").alias("cached"), F.sum("seconds").alias("seconds"), F.sum("attempts").alias("attempts"), F.count_if("timed_out").alias("timeouts"), F.grouping("schema").alias("g"))
    return per.withColumn("schema", F.when(F.col("g") == 1, "total").otherwise(F.col("schema"))).drop("g")


def request_key(texts: list[Column], images: list[Column], schema_name: Column, schema: Column, max_tokens: Column, model: Column) -> Column:
    """What an answer is kept under: the request's texts and images (data URIs), schema (JSON with sorted keys), limit and model, hashed. The form is fixed."""
    told = [F.concat(F.lit(mark), F.coalesce(p.cast("string"), F.lit(""))) for mark, parts in (("T", texts), ("I", images)) for p in parts]
    return F.sha2(F.concat(*told, F.lit("S"), schema_name, schema, F.lit("|"), max_tokens.cast("string"), F.lit("|"), model), 256)


def repaired(raw: str | None, most: int = 8) -> str | None:
    """The text of a JSON answer, out of its code fence, without the backslashes at which parsing fails; None if it stays broken."""
    text = (raw or "").strip()
    if text.startswith("```"):
        text = text.strip("`").removeprefix("json").strip()
    for _ in range(most + 1):
        try:
            json.loads(text)
            return text
        except json.JSONDecodeError as e:
            at = text.rfind("\\", 0, e.pos + 1)
            if at < 0:
                return None
            text = text[:at] + text[at + 1 :]
    return None


@pandas_udf(StringType())
def repair_json(answers: pd.Series) -> pd.Series:
    return answers.map(repaired)


def parsed(answers: DataFrame, schema: str, col: str = "answer") -> DataFrame:
    """answer parsed by its schema, null if it can't be: as it is where it parses, repaired where not, so that only broken answers reach Python."""
    read = lambda c: F.from_json(c, f"{schema}, pw_broken string", {"columnNameOfCorruptRecord": "pw_broken"})
    once = answers.withColumn("parsed", read(F.col(col)))
    fails = F.col("parsed.pw_broken").isNotNull()
    again = once.where(fails).withColumn("parsed", read(repair_json(F.col(col))))
    both = once.where(F.coalesce(~fails, F.lit(True))).unionByName(again)
    return both.withColumn("parsed", F.when(F.col("parsed.pw_broken").isNull(), F.col("parsed").dropFields("pw_broken")))


def write_documents(records: DataFrame, folder: str) -> None:
    """A folder per document with its record, by safe names."""
    records.withColumn("name", T.safe_name(F.col("doc_id").cast("string"))).select("name", F.col("record").alias("value")).write.mode("overwrite").partitionBy("name").text(folder)
