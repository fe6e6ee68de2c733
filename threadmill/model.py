"""Schemas of the tables that operators exchange, and what differs between platforms."""

from __future__ import annotations

from typing import NamedTuple

from .functions import tables as t

SCHEMAS = {
    "evidence_source": "original_path string, root_path string, source_type string, extracted boolean",
    "file_inventory": "source string, path string, absolute_path string, extension string, status string",
    "report": "report_id string, text string",
    "participant": "report_id string, ord int, name string, role string, contact_numbers array<string>",
    "screen_crop": "image_id string, screen_idx int, x int, y int, w int, h int, png binary",
    "ocr_text": "image_id string, content string",
    "ocr_block": "image_id string, screen_idx int, line_no int, block int, pos string, x int, y int, w int, h int, text string",
    "bubble": "image_id string, screen_idx int, kind string, ord int, hhmm string, side string, confidence double, text string",
    "allowed_time": "image_id string, screen_idx int, hhmm string",
    "side_csv_text": "image_id string, screen_idx int, candidate string, content string",
    "side_row": "image_id string, screen_idx int, candidate string, row_no int, time_text string, side string, message string",
    "side_map": "image_id string, left_name string, right_name string",
    "chat_row": "seq bigint, time_text string, sender string, receiver string, message string, source_csv string, source_image string, source_row int",
    "item_status": "image string, platform string, csv string, debug_dir string, status string, reason string, rows int",
}


class PlatformProfile(NamedTuple):
    """Thresholds and lists of one platform; coordinates are of the picture at twice its size."""

    name: str
    ui_substrings: tuple[str, ...]
    icons: str
    right_from: float  # share of the width from which a block is on the right
    line_left_below: float  # a visual line that starts before this share is on the left
    date_from_y: int | None  # dates are looked for from here down
    date_needs_end: bool  # whether a date must end at a word's end
    carries_date: bool  # whether a screen without a date takes that of the screen before
    filters_times: bool  # whether rows must show a time that is visible
    side_confidence: float  # of timed bubbles that may correct a side
    split_words: int
    split_overlap: float
    add_words: int  # of a bubble that may be added to rows
    geometric: bool  # whether bubbles are told apart by gaps (else by the times that close them)
    additive: bool  # whether a repair may add rows to a draft
    purple_right_from: float | None
    asks_date: bool  # whether a model is asked for the date of a screen that shows none


FACEBOOK = PlatformProfile("facebook", t.UI_FACEBOOK, t.ICONS_FACEBOOK, 0.30, 0.35, 80, False, False, False, 0.62, 6, 0.92, 2, True, True, None, True)
VIBER = PlatformProfile("viber", t.UI_VIBER, t.ICONS_VIBER, 0.25, 0.22, None, True, True, True, 0.0, 9, 0.90, 4, False, False, 0.065, False)
PROFILES = {p.name: p for p in (FACEBOOK, VIBER)}

#: Rows above this are a screen's top where no date shows where messages begin, and rows above HEADER its header.
TOP, HEADER = 250, 350
