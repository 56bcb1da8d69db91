"""Schemas of the tables the pipeline reads and writes."""

REGISTRY = "source_id string, file_path string, format string"
PAGES = "source_id string, page int, text string, parser string"
MANIFEST = (
    "source_id string, file_path string, format string, status string, page_count int, error string, notes array<string>, "
    "route string, ocr_mode string, parser string, process_time_sec double"
)
CHUNKS = (
    "chunk_id string, doc_id string, page int, page_end int, section_title string, text string, entities array<struct<type:string,value:string>>, "
    "source_ref string, block_type string, block_level int, parent_header_id string, structure_confidence double, is_continuation boolean, "
    "is_truncated boolean, needs_review boolean, formula_vars string"
)
CELLS = "source_id string, sheet_idx int, sheet string, row_idx int, cells array<string>"
