"""Queries of the document pipeline over the project's tables. Each covers its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.functions import text as X
from pagemill.operators import blocks, chunks, layout, registry, running, tables


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks, each once."""
    return _table(spark, sf_dir, "structural_chunks").dropDuplicates(["chunk_id"])


# --- registry ------------------------------------------------------------------------------------------------------


def registry_valid(spark, sf_dir):
    return registry.valid_rows(_table(spark, sf_dir, "registry")).select("source_id", "file_path", "format")


def format_policy(spark, sf_dir):
    return registry.format_policy(_table(spark, sf_dir, "registry"))


def policy_counts(spark, sf_dir):
    return registry.policy_counts(_table(spark, sf_dir, "registry"))


def route_decision(spark, sf_dir):
    rows = registry.valid_rows(_table(spark, sf_dir, "registry"))
    ext = registry.extension(F.col("file_path"))
    return rows.select("source_id", ext.alias("extension"), registry.route(ext).alias("route"), registry.service_route(ext).alias("service_route"), registry.service_route(ext, False).alias("service_route_bare"))


def document_profiles(spark, sf_dir):
    out = registry.document_profiles(_table(spark, sf_dir, "registry"), _table(spark, sf_dir, "pages"))
    return out.drop("size_mb").withColumn("text_ratio", F.round("text_ratio", 6))


def parser_modes(spark, sf_dir):
    """The mode of each registry row if scans are asked for the layout parser and spreadsheets leave it open."""
    rows = registry.valid_rows(_table(spark, sf_dir, "registry"))
    ext = registry.extension(F.col("file_path"))
    asked = F.when(ext == "pdf", " YOLO").when(ext.isin("xls", "xlsx"), "  ").when(ext == "docx", "Docling\n")
    return rows.select("source_id", registry.parser_mode(asked, "Auto").alias("mode"))


def selected_sources(spark, sf_dir):
    return registry.selected(_table(spark, sf_dir, "registry"), key="source_id").groupBy("source_id").agg(F.count("*").alias("n"))


def run_counters(spark, sf_dir):
    return registry.run_counters(_table(spark, sf_dir, "registry"), _table(spark, sf_dir, "manifests"))


def converter_failures(spark, sf_dir):
    return registry.converter_failures(_table(spark, sf_dir, "manifests")).select("source_id", "finished_at", "page_count", "reason")


def envelopes(spark, sf_dir):
    out = registry.envelopes(_table(spark, sf_dir, "structural_chunks"), _table(spark, sf_dir, "registry"))
    return out.select("source_id", "filename", "route", F.size("chunks").alias("n_chunks"), F.md5(F.array_join(F.transform("chunks", lambda c: F.concat_ws("|", c["chunk_id"], c["block_type"], c["section_title"], c["text"])), "\n")).alias("body"))


def resume_pending(spark, sf_dir):
    return registry.pending(_table(spark, sf_dir, "registry"), _table(spark, sf_dir, "manifests"))


def source_profiles(spark, sf_dir):
    out = registry.profiles(_table(spark, sf_dir, "pages"))
    return out.select("source_id", "page_count", F.round("text_ratio", 6).alias("text_ratio"), "has_text_layer")


def latest_manifests(spark, sf_dir):
    return registry.latest_manifests(_table(spark, sf_dir, "manifests")).select("source_id", "status", "page_count", "finished_at")


def patched_manifests(spark, sf_dir):
    """The page count of each manifest as the pages say."""
    seen = registry.profiles(_table(spark, sf_dir, "pages")).select("source_id", F.col("page_count").cast("int").alias("page_count"))
    return registry.patch_manifests(_table(spark, sf_dir, "manifests"), seen).select("source_id", "status", "page_count")


def document_list(spark, sf_dir):
    return registry.documents(_table(spark, sf_dir, "structural_chunks"))


def clean_up(spark, sf_dir):
    """What a clean-up of interactive uploads leaves: documents and chunks."""
    kept, _ = registry.cleaned_up(_table(spark, sf_dir, "structural_chunks"))
    return kept.agg(F.countDistinct("doc_id").alias("n_docs"), F.count("*").alias("n_chunks"))


def response_sizes(spark, sf_dir):
    return registry.response_sizes(_table(spark, sf_dir, "structural_chunks"))


# --- text rules ----------------------------------------------------------------------------------------------------


def normalize_text(spark, sf_dir):
    t = F.col("text")
    return _chunks(spark, sf_dir).select("chunk_id", X.normalize_ocr(t).alias("normal"), X.collapse_newlines(t).alias("collapsed"), X.unbold(t).alias("unbold"))


def line_keys(spark, sf_dir):
    lines = X.full_lines(F.col("text"))
    return _chunks(spark, sf_dir).select("chunk_id", F.size(lines).alias("n_lines"), X.line_key(F.get(lines, F.lit(0))).alias("first_key"), X.line_key(F.element_at(lines, -1)).alias("last_key"))


def predicates(spark, sf_dir):
    t = F.col("text")
    return _chunks(spark, sf_dir).select(
        "chunk_id", X.dangling_end(t).alias("dangling_end"), X.dangling_start(t).alias("dangling_start"), X.is_micro(t).alias("micro"), X.is_formula(t).alias("formula"),
        X.is_table_fragment(t).alias("table_fragment"), X.is_table_block(t).alias("table_block"), X.keeps_lines(t).alias("keeps_lines"),
    )


def headers(spark, sf_dir):
    t = F.col("text")
    return _chunks(spark, sf_dir).select("chunk_id", X.is_header(t).alias("is_header"), X.header_level(t).alias("level"))


def classified(spark, sf_dir):
    rows = _chunks(spark, sf_dir).select("chunk_id", X.classify(F.col("text")).alias("c"), "text")
    flags = X.quality_flags(F.col("text"), F.col("c.block_type"), F.col("c.confidence"))
    return rows.select("chunk_id", "c.block_type", "c.block_level", "c.confidence", flags.alias("q")).select("chunk_id", "block_type", "block_level", "confidence", "q.is_continuation", "q.is_truncated", "q.needs_review")


def entity_list(spark, sf_dir):
    rows = _chunks(spark, sf_dir).select("chunk_id", F.posexplode(X.entities(F.col("text"))).alias("i", "e"))
    return rows.select("chunk_id", "i", "e.type", "e.value")


def readability(spark, sf_dir):
    cyrillic, odd = X.readability(F.col("text"))
    return _chunks(spark, sf_dir).select("chunk_id", F.round(cyrillic, 6).alias("cyr_ratio"), F.round(odd, 6).alias("weird_ratio"))


def cleaned_pages(spark, sf_dir):
    """Control characters, bullets, broken words and simple mojibake of every page's text repaired."""
    t = X.clean_page(X.bullets(F.col("text")))
    return _table(spark, sf_dir, "pages").select("page_id", X.repair_text(t).alias("text"))


def native_pages(spark, sf_dir):
    """Pages whose recognised text lost its vowels on every second page, with the page's text as the native one."""
    pages = _table(spark, sf_dir, "pages")
    read = F.when(F.col("page_id") % 2 == 0, F.regexp_replace("text", "[аеёиоуыэюя]", "")).otherwise(F.col("text"))
    rows = pages.select("page_id", read.alias("text"), F.col("text").alias("native_text"), F.size(F.split("text", " ")).alias("native_words"), (F.col("parser") == "yolo_doctr").alias("is_scan"))
    return layout.native_where_better(rows).select("page_id", "text", "used_native")


def mojibake_tokens(spark, sf_dir):
    """token, repaired, n of all page tokens that look like Cyrillic read as Latin-1."""
    tokens = _table(spark, sf_dir, "pages").select(F.explode(F.split("text", "[ \\n\\t]+")).alias("token")).filter(X.is_mojibake(F.col("token")))
    return tokens.groupBy("token").agg(F.count("*").alias("n")).select("token", X.repair_token(F.col("token")).alias("repaired"), "n")


# --- structure -----------------------------------------------------------------------------------------------------


def section_links(spark, sf_dir):
    return chunks.link_sections(_chunks(spark, sf_dir))


def stripped_pages(spark, sf_dir):
    return running.strip_running(_table(spark, sf_dir, "pages"), fraction=0.5)


def block_list(spark, sf_dir):
    rows = _table(spark, sf_dir, "pages").select("page_id", F.posexplode(blocks.page_blocks(F.col("text"))).alias("idx", "text"))
    return rows.select("page_id", "idx", "text")


def long_pieces(spark, sf_dir):
    rows = _table(spark, sf_dir, "documents").select("doc_id", F.posexplode(blocks.long_pieces(F.col("text"), 800, 100)).alias("idx", "piece"))
    return rows.select("doc_id", "idx", "piece")


def built_chunks(spark, sf_dir):
    return chunks.structural_chunks(_table(spark, sf_dir, "pages")).drop("entities")


def enriched_chunks(spark, sf_dir):
    out = chunks.enrich(chunks.structural_chunks(_table(spark, sf_dir, "pages")))
    return out.select("chunk_id", "doc_id", "page", "page_end", "block_type", "text", "formula_vars", F.size("entities").alias("n_entities"))


# --- tables --------------------------------------------------------------------------------------------------------


def table_matrices(spark, sf_dir):
    rows = _chunks(spark, sf_dir).filter(F.col("block_type") == "table").select("chunk_id", X.drop_table_label(F.col("text")).alias("t"))
    m = tables.parse(F.col("t"))
    return rows.select("chunk_id", F.size(m).alias("n_rows"), tables.width(m).cast("int").alias("n_columns"), tables.rebuild(m).alias("rebuilt"), tables.promote_head(F.col("t")).alias("promoted"), X.is_separator_cells(F.get(m, F.lit(1))).alias("has_rule")).filter("n_rows is not null and n_rows >= 0")


def _cells(spark, sf_dir) -> DataFrame:
    """A sheet per return flag of each order, with a head row: cells for the sheet operators."""
    items = _table(spark, sf_dir, "lineitem").filter("l_orderkey is not null")
    source = F.format_string("ORD-%d", "l_orderkey")
    body = items.select(source.alias("source_id"), F.ascii("l_returnflag").alias("sheet_idx"), F.col("l_returnflag").alias("sheet"), F.col("l_linenumber").cast("int").alias("row_idx"), F.array(F.col("l_partkey").cast("string"), F.col("l_quantity").cast("int").cast("string"), F.concat_ws("|", "l_linestatus", "l_returnflag")).alias("cells"))
    head = body.select("source_id", "sheet_idx", "sheet").distinct().withColumn("row_idx", F.lit(0)).withColumn("cells", F.array(F.lit("part"), F.lit("quantity"), F.lit("status")))
    return body.unionByName(head)


def sheet_pages(spark, sf_dir):
    return tables.sheet_pages(_cells(spark, sf_dir))


# --- layout --------------------------------------------------------------------------------------------------------


def _boxes(spark, sf_dir) -> DataFrame:
    """A page per order, a box per order line: places from the line's own numbers."""
    i = _table(spark, sf_dir, "lineitem")
    x1, y1 = F.col("l_partkey") % 600, F.col("l_suppkey") * 37 % 800
    label = F.when(F.col("l_linestatus") == "O", layout.FORMULA).when(F.col("l_returnflag") == "R", "table").otherwise("plain text")
    return i.select(F.lit("L").alias("source_id"), F.col("l_orderkey").cast("int").alias("page"), F.col("l_linenumber").cast("int").alias("box_ord"), label.alias("label"), x1.cast("int").alias("x1"), y1.cast("int").alias("y1"), (x1 + 20 + F.col("l_quantity") * 8).cast("int").alias("x2"), (y1 + 10 + F.col("l_quantity") * 4).cast("int").alias("y2"), (F.round(F.col("l_discount") * 10, 2)).alias("conf"))


def _words(spark, sf_dir) -> DataFrame:
    i = _table(spark, sf_dir, "lineitem")
    cx, cy = F.col("l_partkey") * 7 % 700, F.col("l_suppkey") * 53 % 900
    native = F.col("l_returnflag") == "N"
    return i.select(F.lit("L").alias("source_id"), F.col("l_orderkey").cast("int").alias("page"), F.col("l_linenumber").cast("int").alias("word_ord"), cx.cast("double").alias("cx"), cy.cast("double").alias("cy"), F.concat(F.lit("w"), F.col("l_partkey").cast("string")).alias("text"), (cx - 10).cast("double").alias("x_min"), (cx + 10).cast("double").alias("x_max"), F.when(native, 0).otherwise(-1).alias("block_no"), F.when(native, 0).otherwise(-1).alias("line_no"), F.when(native, F.col("l_linenumber")).otherwise(-1).cast("int").alias("word_no"))


def _tokens(spark, sf_dir) -> DataFrame:
    i = _table(spark, sf_dir, "lineitem")
    return i.select(F.lit("L").alias("source_id"), (F.col("l_suppkey") % 500).cast("int").alias("page"), (F.col("l_linenumber") % 4 * 90).cast("int").alias("angle"), F.concat(F.lit("t"), F.col("l_partkey").cast("string")).alias("text"), (F.col("l_quantity") / F.when(F.col("l_suppkey") % 3 == 0, 100).otherwise(50)).alias("conf"))


def word_boxes(spark, sf_dir):
    return layout.words_to_boxes(_words(spark, sf_dir), _boxes(spark, sf_dir)).select("page", "word_ord", "box_ord")


def free_words(spark, sf_dir):
    return layout.words_outside_formulas(_words(spark, sf_dir), _boxes(spark, sf_dir)).select("page", "word_ord")


def box_pairs(spark, sf_dir):
    out = layout.box_pairs(_boxes(spark, sf_dir))
    return out.select("page", "a", "b", *[F.round(c, 6).alias(c) for c in ("iou", "a_in_b", "b_in_a")])


def unique_formulas(spark, sf_dir):
    return layout.usable_boxes(layout.unique_formulas(_boxes(spark, sf_dir))).select("page", "box_ord", "label")


def reading_order(spark, sf_dir):
    return layout.reading_order(_boxes(spark, sf_dir), F.lit(800)).select("page", "box_ord", "two_columns", "position")


def line_gaps(spark, sf_dir):
    return layout.line_gaps(_words(spark, sf_dir).withColumn("box_ord", F.lit(1))).select("page", "gap")


def box_texts(spark, sf_dir):
    words = layout.words_to_boxes(_words(spark, sf_dir), _boxes(spark, sf_dir))
    return layout.box_texts(words).select("page", "box_ord", "text")


def word_tables(spark, sf_dir):
    words = layout.words_to_boxes(_words(spark, sf_dir), _boxes(spark, sf_dir).filter(F.col("label") == "table"))
    return layout.word_tables(words).select("page", "box_ord", "text")


def page_texts(spark, sf_dir):
    words = layout.words_to_boxes(_words(spark, sf_dir), _boxes(spark, sf_dir))
    placed = layout.reading_order(_boxes(spark, sf_dir), F.lit(800)).select("source_id", "page", "box_ord", "label", "position")
    return layout.page_texts(layout.box_texts(words).join(placed, ["source_id", "page", "box_ord"])).select("page", "text")


def orientations(spark, sf_dir):
    return layout.orientations(_tokens(spark, sf_dir)).select("page", "angle", F.round("score", 4).alias("score"))


def unreadable_pages(spark, sf_dir):
    return layout.unreadable_pages(_tokens(spark, sf_dir)).select("page", "n", F.round("share", 6).alias("share"))


def readable_pages(spark, sf_dir):
    """Pages of recognised tokens, unreadable ones with the notice."""
    tokens = _tokens(spark, sf_dir)
    pages = tokens.groupBy("source_id", "page").agg(F.concat(F.min("text"), F.lit(" "), F.max("text")).alias("text"))
    return layout.with_unreadable(pages, tokens).select("page", "text")


def formula_scales(spark, sf_dir):
    out = layout.scaled_formulas(_boxes(spark, sf_dir))
    return out.select("page", "box_ord", *(F.round(c, 4).alias(c) for c in ("x1", "y1", "x2", "y2", "scale")))


def skews(spark, sf_dir):
    contours = _table(spark, sf_dir, "lineitem").select(F.lit("L").alias("source_id"), (F.col("l_suppkey") % 500).cast("int").alias("page"), (F.col("l_quantity") % 40 - 18).alias("angle"))
    return layout.skews(contours).select("page", "skew")


def item_pages(spark, sf_dir):
    label = F.when(F.col("block_type") == "header", "page_header").otherwise(F.col("block_type"))
    rows = _chunks(spark, sf_dir).select(F.col("doc_id").alias("source_id"), "page", F.regexp_extract("chunk_id", r":b(\d+)$", 1).cast("int").alias("item_ord"), label.alias("label"), "text")
    return layout.item_pages(rows)


_NAMES = (
    "registry_valid format_policy policy_counts route_decision document_profiles parser_modes selected_sources run_counters converter_failures envelopes native_pages readable_pages formula_scales resume_pending source_profiles latest_manifests patched_manifests document_list clean_up response_sizes "
    "normalize_text line_keys predicates headers classified entity_list readability cleaned_pages mojibake_tokens section_links stripped_pages block_list long_pieces "
    "built_chunks enriched_chunks table_matrices sheet_pages word_boxes free_words box_pairs unique_formulas reading_order line_gaps box_texts word_tables page_texts "
    "orientations unreadable_pages skews item_pages"
).split()
QUERIES = {name: globals()[name] for name in _NAMES}
