"""Readings of a region: whom to ask, when to judge, what its text and status become."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..options import DEFAULT

NUMBER, WORD = r"\d+(?:[.,]\d+)*", "[가-힣]{2,}"


def should_read(scope: str) -> Column:
    """Whether a region goes to the reader; scope all, targeted or off. Columns: has_box, kind, text, text_source, selection_status, n_lines."""
    structured = F.startswith(F.coalesce("text_source", F.lit("")), F.lit("document_processor")) & (T.no_space("text") != "")
    base = F.col("has_box") & ~F.coalesce(F.col("kind") == "table", F.lit(False)) & ~structured & F.lit(scope != "off")
    if scope != "targeted":
        return base
    doubtful = (F.length(T.no_space("text")) <= 3) | F.coalesce(F.col("selection_status") == "conflict_pending_vlm", F.lit(False)) | (F.coalesce("n_lines", F.lit(0)) == 0)
    return base & doubtful


def needs_judge(agreement: Column, parser_key: Column, reader_key: Column, strict: bool = True) -> Column:
    """Too little agreement or, strictly, any letter or digit that differs."""
    return (agreement < DEFAULT.reader_agreement) | (parser_key != reader_key if strict else F.lit(False))


def review_codes(regions: DataFrame) -> DataFrame:
    """codes of a reading, without a digital source: a blank answer to text, a fallback, numbers or Hangul words that no reading has.

    regions: text (final), parser_text, reader_text, judge_text, reading_status, fallback.
    """
    n = lambda c: F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(NUMBER), F.lit(0))
    known = F.concat(T.plain("parser_text"), F.lit("\n"), T.plain("reader_text"))
    new = F.filter(F.regexp_extract_all(F.coalesce("judge_text", F.lit("")), F.lit(WORD), F.lit(0)), lambda w: ~F.contains(known, w))
    codes = F.array_compact(
        F.array(
            F.when((F.col("reading_status") == "vlm_blank") & (F.length(T.plain("parser_text")) >= 4), "vlm_blank_with_ocr_text"),
            F.when(F.col("fallback"), "page_reader_fallback"),
            F.when(F.size(F.array_except(n("text"), F.array_union(n("parser_text"), n("reader_text")))) > 0, "unsupported_number"),
            F.when(F.size(new) > 0, "judge_new_word"),
        )
    )
    return regions.withColumn("codes", codes)


def digital_evidence(text_source: Column, structure_agrees: Column, share: Column) -> Column:
    """Whether a text rests on digital sources: structure, confirmation by structure, half of its characters, or what it says itself."""
    source = F.coalesce(text_source, F.lit(""))
    return F.startswith(source, F.lit("document_processor")) | F.coalesce(structure_agrees, F.lit(False)) | F.coalesce(share >= DEFAULT.digital_share, F.startswith(source, F.lit("digital_")))


def agreement(text: Column, reader: Column) -> Column:
    """How alike two readings are, by letters and digits: the sequence matcher's ratio, 1 for two empty ones."""
    return T.seq_ratio(T.nfkc_alnum(text), T.nfkc_alnum(reader))


def apply_reading(regions: DataFrame) -> DataFrame:
    """final_text, final_source, reading_status, flag of a region that was read and perhaps judged.

    regions: text, text_source, structure_agrees, structure_text, digital_share, reader_text, judge_text, judge_confidence. A text with digital evidence is
    never rewritten, but for private-use glyphs that structure and reading explain alike.
    """
    ocr, reader, judge = (F.coalesce(c, F.lit("")) for c in ("text", "reader_text", "judge_text"))
    blank, judged = T.no_space(reader) == "", T.no_space(judge) != ""
    final = F.when(judged, judge).otherwise(reader)
    digital = (ocr != "") & digital_evidence(F.col("text_source"), F.col("structure_agrees"), F.col("digital_share"))
    same = T.no_space(ocr) == T.no_space(final)
    agrees = F.coalesce("structure_agrees", F.lit(False))
    private = lambda c: F.rlike(c, F.lit(r"\p{Co}"))
    glyph = agrees & private(ocr) & ~private(final) & (T.plain(final) == T.plain("structure_text"))
    status = (
        F.when(blank, "vlm_blank").when(digital & same, "parser_verified").when(digital & glyph, "vlm_glyph_verified_by_hwp_structure").when(digital & agrees, "parser_verified_by_hwp_structure")
        .when(digital, "parser_preserved").when(judged, "judge_selected").when(T.no_space(ocr) == "", "vlm_only").when(F.col("agreed") >= DEFAULT.reader_agreement, "agree").otherwise("disagree")
    )
    r = regions.withColumn("agreed", agreement(F.col("text"), F.col("reader_text"))).withColumn("reading_status", status)
    s = F.col("reading_status")
    takes = s.isin("judge_selected", "vlm_glyph_verified_by_hwp_structure")
    reads = s.isin("vlm_only", "agree", "disagree")
    source = F.when(s == "judge_selected", "vlm_judge").when(s == "vlm_glyph_verified_by_hwp_structure", "vlm_structure_verified").when(reads, "vlm_reader").otherwise(F.col("text_source"))
    flag = F.when(s == "parser_preserved", "digital_text_vlm_disagreement").when((s == "judge_selected") & (F.coalesce("judge_confidence", F.lit(0.0)) < DEFAULT.confidence), "vlm_judge_low_confidence").when(s == "vlm_only", "vlm_only_text").when(s == "disagree", "ocr_vlm_disagreement")
    return r.withColumns({"final_text": F.when(takes, final).when(reads, reader).otherwise(ocr), "final_source": source, "flag": flag}).drop("agreed")


def clean_answer(text: Column) -> Column:
    """An answer up to where it closes its JSON and goes on talking, trimmed."""
    first = F.regexp_replace(F.coalesce(text, F.lit("")), r'(?s)^(.+?)"\}.*$', "$1")
    return F.trim(F.regexp_replace(first, r'(?s)^(.+?)"\].*$', "$1"))


def status_counts(regions: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    return regions.groupBy(*keys, "reading_status").agg(F.count("*").alias("n"))
