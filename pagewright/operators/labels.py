"""Labels of regions: what headings say by themselves, which answers of a model stand, how both come together."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..sources.derived import PAGE

# Labels with the headings that announce them.
ALIASES: dict[str, tuple[str, ...]] = {
    "가입대상": ("가입대상", "가입자격"),
    "가입금액": ("가입금액", "납입금액"),
    "가입기간": ("가입기간", "계약기간"),
    "금리": ("기본금리", "적용금리", "최고금리", "최저금리"),
    "우대금리": ("우대금리", "금리우대"),
    "중도해지이율": ("중도해지이율", "중도해지금리"),
    "만기후이율": ("만기후이율", "만기후금리"),
    "이자지급시기": ("이자지급시기", "이자지급방식", "이자지급방법", "이자지급주기"),
    "이자지급제한": ("이자지급제한",),
    "예상수취이자": ("예상수취이자", "예상이자"),
    "예금자보호": ("예금자보호법", "예금자보호", "예금보호"),
    "유의사항": ("유의사항",),
    "대출대상": ("대출대상",),
    "대출한도": ("대출한도",),
    "대출기간": ("대출기간",),
    "대출금리": ("대출금리",),
    "상환방법": ("상환방법", "상환방식"),
    "부대비용": ("부대비용",),
    "채권보전": ("채권보전",),
    "연회비": ("연회비",),
    "수수료": ("수수료",),
}
TITLE_LABEL, NUMBER_LABEL, RATE_LABEL, DEPOSIT_GUARD = "상품명", "심의번호", "대출금리", "예금자보호"
TITLE_LAYOUTS = ("doc_title", "paragraph_title", "title")
RATE_WORDS = ("기준금리", "가산금리", "우대금리")
BULLETS = r"^[※*ㆍ·•▶▷▪■□◾§\-–—\s]+"
#: How a review number is printed (fixed pattern).
_DIGITS = r"[\d○●*＊]{2,4}\s*[-‐–]\s*[\d○●*＊]{2,6}(?:\s*[-‐–]\s*[\d○●*＊]{2,6})?\s*호?"
REVIEW_NUMBER = rf"(?:(?:준법감시인|은행연합회|[가-힣]{{2,8}}협회)\s*)?심\s*[의사]\s*(?:필|번호|일)?[^\d○●*＊]{{0,12}}?(?:제\s*)?{_DIGITS}(?:\s*\([^()]{{0,40}}\))?|{_DIGITS}\s*\(\s*심\s*의\s*일[^()]{{0,30}}\)"
#: Reasons that take an answer back (fixed phrases, spaces left out).
CONTRADICTIONS = ("허용라벨없음", "해당없음", "근거없음")


def heading_pattern(label: str) -> str:
    """A line that begins with one of the label's headings, then a colon, space or nothing."""
    words = "|".join(re.escape(w) for w in sorted(ALIASES[label], key=len, reverse=True))
    more = r"에\s*따라|" if label == DEPOSIT_GUARD else ""
    return rf"^(?:{words})(?:{more}\s*[:：]|\s+|$)"


def headings(lines: DataFrame, keys: tuple[str, ...] = (*PAGE, "region_id")) -> DataFrame:
    """keys, label, quote, place of the labels that a region's lines announce: the first line of each, in the order of lines, then of ALIASES.

    lines: keys, pos, text, allowed (labels that count).
    """
    head = F.trim(F.regexp_replace(F.trim("text"), BULLETS, ""))
    told = F.array(*[F.when(F.array_contains("allowed", x) & F.rlike("head", F.lit(heading_pattern(x))), F.lit(k)) for k, x in enumerate(ALIASES)])
    hits = lines.withColumn("head", head).where("head <> ''").select(*keys, "pos", F.trim("text").alias("quote"), F.explode(F.array_compact(told)).alias("nr"))
    first = hits.groupBy(*keys, "nr").agg(F.min(F.struct("pos", "quote")).alias("f"))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("f.pos", "nr")).cast("long")
    label = F.element_at(F.array(*[F.lit(x) for x in ALIASES]), F.col("nr") + 1)
    return first.select(*keys, label.alias("label"), F.col("f.quote").alias("quote"), place.alias("place"))


def review_number(text: Column) -> Column:
    """The printed review number, null if there is none."""
    return T.nullable(F.regexp_extract(F.coalesce(text, F.lit("")), REVIEW_NUMBER, 0))


def quoted(quote: Column, source: Column) -> Column:
    """Whether the source has the quote, or six characters and more of it if punctuation is left out."""
    strict, loose = T.quote_key(quote), T.quote_key(quote, False)
    return (strict != "") & (F.contains(T.quote_key(source), strict) | ((F.length(loose) >= 6) & F.contains(T.quote_key(source, False), loose)))


def constrain_title(labels: Column, layout: Column, text: Column) -> Column:
    """A short title has no label but the product's name."""
    title = F.lower(F.coalesce(layout, F.lit(""))).isin(*TITLE_LAYOUTS) & (F.length(T.no_space(text)) <= 60) & F.array_contains(labels, TITLE_LABEL)
    return F.when(title, F.array(F.lit(TITLE_LABEL))).otherwise(labels)


def constrain_rates(labels: Column, text: Column, announced: Column) -> Column:
    """A worked example of a rate has the rate's label and those its headings announce."""
    dense = T.no_space_lower(text)
    words = sum((F.contains(dense, F.lit(w)).cast("int") for w in RATE_WORDS[1:]), F.contains(dense, F.lit(RATE_WORDS[0])).cast("int"))
    example = (words >= 2) & (F.contains(dense, F.lit("적용시")) | F.contains(dense, F.lit("기준,"))) & F.array_contains(labels, RATE_LABEL)
    return F.when(example, F.filter(labels, lambda x: (x == RATE_LABEL) | F.array_contains(announced, x))).otherwise(labels)


def validate(regions: DataFrame, answers: DataFrame, evidence: DataFrame, keys: tuple[str, ...] = (*PAGE, "region_id")) -> DataFrame:
    """keys, labels, confidence, status of every region: ok, contradiction or missing.

    regions: keys, text, allowed. answers: keys, pos, labels, confidence, reason; the first of a region counts. evidence: keys, pos, label, quote. A label
    stands if it is allowed and the text has the first quote for it that there is; a reason that says there is none clears all.
    """
    first = answers.groupBy(*keys).agg(F.min_by(F.struct("pos", "labels", "confidence", "reason"), "pos").alias("a"))
    sound = evidence.where(F.trim("quote") != "").join(regions.select(*keys, "text"), list(keys)).where(quoted(F.col("quote"), F.col("text")))
    shown = sound.groupBy(*keys, "pos").agg(F.collect_set("label").alias("shown"))
    joined = regions.join(first, list(keys), "left").join(shown.withColumnRenamed("pos", "shown_pos"), [*[regions[k] == shown[k] for k in keys], F.col("a.pos") == F.col("shown_pos")], "left").select(*[regions[k] for k in keys], "allowed", "a", "shown")
    selected = F.array_distinct(F.filter(F.coalesce("a.labels", F.array().cast("array<string>")), lambda x: F.array_contains("allowed", x)))
    against = F.lit(False)
    for phrase in CONTRADICTIONS:
        against = against | F.contains(F.replace(F.coalesce("a.reason", F.lit("")), F.lit(" "), F.lit("")), F.lit(phrase))
    contradiction = (F.size(selected) > 0) & against
    labels = F.when(contradiction, F.array().cast("array<string>")).otherwise(F.filter(selected, lambda x: F.array_contains(F.coalesce("shown", F.array().cast("array<string>")), x)))
    status = F.when(F.col("a").isNull(), "missing").when(contradiction, "contradiction").otherwise("ok")
    return joined.select(*keys, labels.alias("labels"), F.coalesce("a.confidence", F.lit(0.0)).alias("confidence"), status.alias("status"))


def merged(announced: Column, answered: Column) -> Column:
    """Announced labels first, then the answered ones that are new."""
    return F.array_distinct(F.concat(announced, answered))


def chunks(regions: DataFrame, keys: tuple[str, ...], size: int) -> DataFrame:
    """chunk number from 0 of `size` regions each, by seq."""
    nr = F.row_number().over(Window.partitionBy(*keys).orderBy("seq")) - 1
    return regions.withColumn("chunk", F.floor(nr / size).cast("long"))


def shortened(text: Column, most: int = 1600, tail: int = 500) -> Column:
    """A text, white space as single spaces; of over `most` characters its beginning and its end, and how many are left out. The form of the gap is fixed."""
    t = T.one_space(text)
    gap = F.concat(F.lit(" …(중략 "), (F.length(t) - most).cast("string"), F.lit("자)… "))
    return F.when(F.length(t) > most, F.concat(F.substring(t, 1, most - tail), gap, F.right(t, F.lit(tail)))).otherwise(t)


def cut_short(text: Column, most: int = 700) -> Column:
    """A text, white space as single spaces, up to `most` characters."""
    t = T.one_space(text)
    return F.when(F.length(t) > most, F.concat(F.substring(t, 1, most), F.lit("…"))).otherwise(t)
