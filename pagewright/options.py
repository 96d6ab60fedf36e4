"""Thresholds of the engine in one place; operators take them as literals."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Options:
    line_overlap: float = 0.5
    strong_agreement: float = 0.8
    conflict: float = 0.5
    digital_share: float = 0.5
    reader_agreement: float = 0.95
    confidence: float = 0.7
    label_chunk: int = 15
    read_chunk_regions: int = 20
    read_chunk_chars: int = 2400
    aspect_limit: float = 2.0
    tile_span: int = 1600
    tile_overlap_share: float = 0.15
    tile_overlap_least: int = 80
    tile_overlap_most: int = 200
    dedupe_x: float = 0.90
    dedupe_y: float = 0.50
    dedupe_conflict: float = 0.95
    nms_iou: float = 0.5
    nms_containment: float = 0.7
    readable_chars: int = 20
    normal_chars: int = 50
    normal_ratio: float = 0.1
    broken_count: int = 8
    broken_ratio: float = 0.3
    image_ratio: float = 0.5
    structure_match: float = 0.72
    structure_penalty: float = 0.03
    page_match: float = 0.35
    grid_coverage: float = 0.85
    near_margin: int = 16
    near_overlap: float = 0.3
    missing_chars: int = 6
    missing_coverage: float = 0.6
    align_anchor: int = 3
    align_span: int = 6
    column_gap_chars: float = 4.0
    column_gap_least: float = 6.0
    divider_height: float = 36.0
    native_dpi_least: float = 72.0
    native_dpi_most: float = 200.0
    recovery_x: tuple[float, float] = (8.0, 1.5)
    recovery_y: tuple[float, float] = (2.0, 0.25)


DEFAULT = Options()
