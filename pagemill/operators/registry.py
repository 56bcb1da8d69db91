"""Source registry: valid rows, formats, profiles, processing routes, resumption, manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.functions.text import strip

# Extensions by kind, and what each format's pages mean and need before extraction. The first row that fits decides.
IMAGES = ("jpg", "jpeg", "png", "bmp", "tiff", "tif")
OFFICE = ("docx", "doc", "rtf", "xls", "xlsx", "txt", "csv")
WORD = ("doc", "docx", "rtf")
ALLOWED = ("pdf", *OFFICE, *IMAGES)
POLICY = (
    (("pdf",), ("pdf",), "none", "pdf_print_pages_match_pymupdf_index_usually", False, True, ()),
    (("docx",), ("docx",), "export_pdf_from_word_set_registry_to_pdf_for_page_critical_qa", "pymupdf_docx_page_index_may_differ_from_word_status_bar", True, True, ("keep_docx_use_chunk_id_and_citation_only", "run_link_qa_to_chunks_with_strategy_page_then_global")),
    (("doc",), ("doc",), "convert_binary_doc_to_docx_or_pdf_via_word_or_libreoffice_then_update_registry", "n_a_until_converted", True, False, ("libreoffice_headless_convert_if_installed",)),
    (("rtf",), ("rtf",), "export_pdf_from_word_set_registry_to_pdf_same_as_docx_policy", "single_pseudo_page_if_no_form_feed_split_breaks_search_and_golden_pages", True, True, ("keep_rtf_temporary_only_use_page_1_and_chunk_id_and_page_then_global_linking",)),
    (("txt",), ("txt", "log", "md", "csv"), "none_plain_text_chunking", "no_print_pages_use_chunk_or_line_offset", False, True, ()),
    (("xlsx", "xls"), ("xlsx", "xls"), "dedicated_table_ingest_future_not_pdf_print", "sheet_row_range_not_print_page", False, True, ("export_csv_per_sheet_for_prototype",)),
    ((), ("jpg", "jpeg", "png", "webp", "heic", "tif", "tiff", "bmp", "gif"), "ocr_pipeline_not_in_current_ingest", "image_one_file_or_multipage_tiff", False, False, ()),
)
PARSERS = ("auto", "docling", "yolo")
FINISHED = ("ok", "empty")
#: Pages whose text decides whether a document has a text layer, and the mean characters from which on it has.
SAMPLE_PAGES, LAYER_CHARS = 5, 50


def extension(path: Column) -> Column:
    """Lower-case text behind the last dot, empty if there is none or no path."""
    p = F.lower(strip(F.coalesce(path, F.lit(""))))
    return F.when(p.contains("."), F.substring_index(p, ".", -1)).otherwise("")


def normal_format(fmt: Column, path: Column) -> Column:
    """The stated format in lower case; the extension where none is stated."""
    f = F.lower(strip(F.coalesce(fmt, F.lit(""))))
    return F.when((f != "") & (f != "nan"), f).otherwise(extension(path))


def valid_rows(registry: DataFrame) -> DataFrame:
    """Rows with an id and a path; null, empty and ``nan`` ids are none. Repeated rows stay."""
    sid, path = strip(F.coalesce("source_id", F.lit(""))), strip(F.coalesce("file_path", F.lit("")))
    return registry.filter((sid != "") & (F.lower(sid) != "nan") & (path != "") & (F.lower(path) != "nan"))


def format_policy(registry: DataFrame) -> DataFrame:
    """source_id, extension, format_normalized, ingest_as_in_registry, recommended_preprocessing, page_semantics, alternatives, optional_pdf_conversion."""
    fmt, ext = normal_format(F.col("format"), F.col("file_path")), extension(F.col("file_path"))
    none = F.array().cast("array<string>")
    fields = ("recommended_preprocessing", "page_semantics", "optional_pdf_conversion", "ingest_as_in_registry", "alternatives")
    row = lambda p, s, conversion, keep, other: F.struct(*(v.alias(n) for n, v in zip(fields, (F.lit(p), F.lit(s), F.lit(conversion), F.lit(keep), F.array(*map(F.lit, other)) if other else none))))
    out = row("review_manually", "unknown", False, True, ())
    for formats, extensions, *values in reversed(POLICY):
        out = F.when(ext.isin(*extensions) | (fmt.isin(*formats) if formats else F.lit(False)), row(*values)).otherwise(out)
    named = F.when(fmt != "", fmt).when(ext != "", ext).otherwise("unknown")
    rows = registry.select("source_id", ext.alias("extension"), named.alias("format_normalized"), out.alias("p"))
    return rows.select("source_id", "extension", "format_normalized", "p.ingest_as_in_registry", "p.recommended_preprocessing", "p.page_semantics", "p.alternatives", "p.optional_pdf_conversion")


def policy_counts(registry: DataFrame) -> DataFrame:
    """recommended_preprocessing, n of the valid rows, most frequent first."""
    policy = format_policy(valid_rows(registry))
    return policy.groupBy(F.coalesce("recommended_preprocessing", F.lit("?")).alias("recommended_preprocessing")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "recommended_preprocessing")


def route(ext: Column, parser: str = "auto", force_heavy: bool = False, force_light: bool = False) -> Column:
    """``docling``, ``heavy`` or ``light`` for a file extension; an unknown parser mode raises."""
    if parser not in PARSERS:
        raise ValueError(f"unknown parser mode: {parser}")
    if parser == "docling":
        return F.lit("docling")
    if parser == "yolo" or force_heavy:
        return F.lit("heavy")
    if force_light:
        return F.lit("light")
    return F.when(ext.isin(*[e for e in OFFICE if e not in WORD]), "light").otherwise("heavy")


def service_route(ext: Column, converter: bool = True) -> Column:
    """Route of a single interactive file; without an office converter, old Word files have none (null)."""
    native = F.when(ext.isin("xls", "xlsx", "csv"), "native_table").when(ext == "txt", "native_txt_api")
    if converter:
        return native.otherwise("heavy")
    return native.when(ext.isin("docx", "rtf"), "native_office_api").when(ext == "doc", F.lit(None).cast("string")).otherwise("heavy")


def parser_mode(asked: Column, default: str | None = None) -> Column:
    """The parser mode asked for, else the default, else ``auto``; case and outer blanks do not count. Any other value fails the query."""
    mode = F.lower(strip(F.coalesce(F.when(strip(asked) != "", asked), F.lit(default or "auto"))))
    return F.when(mode.isin(*PARSERS), mode).otherwise(F.raise_error(F.concat(F.lit("unknown parser mode: "), mode)).cast("string"))


def selected(rows: DataFrame, only: list[str] | None = None, key: str = "source_id") -> DataFrame:
    """Rows of documents, without those whose id is null or begins with ``_``, and of those in ``only`` where it is given."""
    kept = rows.filter(F.col(key).isNotNull() & ~F.col(key).startswith("_"))
    return kept if only is None else kept.filter(F.col(key).isin(*only))


def run_counters(registry: DataFrame, manifests: DataFrame) -> DataFrame:
    """total, processed, failed, skipped: one row. Valid sources, those with a finished run, those with failed runs only, and those never run."""
    source = valid_rows(registry).select("source_id").distinct()
    state = manifests.groupBy(F.col("source_id").alias("s")).agg(F.max(F.col("status").isin(*FINISHED)).alias("done"))
    seen = source.join(state, F.col("source_id") == F.col("s"), "left")
    return seen.agg(F.count("*").alias("total"), F.count_if(F.col("done")).alias("processed"), F.count_if(~F.col("done")).alias("failed"), F.count_if(F.col("s").isNull()).alias("skipped"))


def converter_failures(runs: DataFrame) -> DataFrame:
    """Runs of an external converter that failed, with ``reason``: ``exit_code``, ``no_output``, ``no_pages``.

    ``runs``: source_id, page_count, and exit_code and output_bytes where they are known.
    """
    code = F.coalesce(F.col("exit_code"), F.lit(0)) if "exit_code" in runs.columns else F.lit(0)
    size = F.coalesce(F.col("output_bytes"), F.lit(0)) if "output_bytes" in runs.columns else F.lit(1)
    reason = F.when(code != 0, "exit_code").when(size == 0, "no_output").when(F.coalesce("page_count", F.lit(0)) < 1, "no_pages")
    return runs.withColumn("reason", reason).filter("reason is not null")


def pending(registry: DataFrame, manifests: DataFrame) -> DataFrame:
    """Valid, allowed registry rows, each once, whose source has no finished manifest."""
    done = manifests.filter(F.col("status").isin(*FINISHED)).select("source_id").distinct()
    allowed = valid_rows(registry).filter(normal_format(F.col("format"), F.col("file_path")).isin(*ALLOWED))
    return allowed.select("source_id", "file_path", "format").distinct().join(done, "source_id", "left_anti")


def existing(registry: DataFrame, files: DataFrame) -> DataFrame:
    """Registry rows whose path is among ``files.path``."""
    return registry.join(files.select(F.col("path").alias("file_path")).distinct(), "file_path", "left_semi")


def profiles(pages: DataFrame) -> DataFrame:
    """source_id, page_count, text_ratio (mean stripped characters of the first pages), has_text_layer; a page number that is repeated counts once."""
    one = pages.filter("source_id is not null").groupBy("source_id", "page").agg(F.max(F.length(strip(F.coalesce("text", F.lit(""))))).alias("chars"))
    return one.groupBy("source_id").agg(
        F.count("page").alias("page_count"), F.coalesce(F.avg(F.when(F.col("page") <= SAMPLE_PAGES, F.col("chars"))), F.lit(0.0)).alias("text_ratio")
    ).withColumn("has_text_layer", F.col("text_ratio") > LAYER_CHARS)


def document_profiles(registry: DataFrame, pages: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """source_id, extension, size_mb, is_image, is_pdf, is_office, page_count, text_ratio, has_text_layer of each valid registry row, each once.

    Only the text of PDF files is looked at; office files have a text layer and images none, both on one page. ``files``: path, length.
    """
    rows = valid_rows(registry).select("source_id", "file_path").distinct().withColumn("extension", extension(F.col("file_path")))
    text = profiles(pages).withColumnsRenamed({"page_count": "n", "text_ratio": "ratio", "has_text_layer": "layer"})
    rows = rows.join(text, "source_id", "left")
    if files is None:
        rows = rows.withColumn("length", F.lit(None).cast("long"))
    else:
        rows = rows.join(files.groupBy(F.col("path").alias("file_path")).agg(F.max("length").alias("length")), "file_path", "left")
    pdf, office = F.col("extension") == "pdf", F.col("extension").isin(*OFFICE)
    return rows.select(
        "source_id", "extension", (F.col("length") / (1024 * 1024)).alias("size_mb"), F.col("extension").isin(*IMAGES).alias("is_image"), pdf.alias("is_pdf"), office.alias("is_office"),
        F.when(pdf, F.coalesce("n", F.lit(0))).otherwise(1).cast("long").alias("page_count"), F.when(pdf, F.coalesce("ratio", F.lit(0.0))).otherwise(0.0).alias("text_ratio"), (office | (pdf & F.coalesce("layer", F.lit(False)))).alias("has_text_layer"),
    )


def patch_manifests(manifests: DataFrame, patch: DataFrame, key: str = "source_id") -> DataFrame:
    """Manifests with the patch's non-null values in place; rows of the patch must be unique by key. Unknown keys are ignored."""
    new = [c for c in patch.columns if c != key]
    renamed = patch.select(key, *[F.col(c).alias(f"_{c}") for c in new])
    joined = manifests.join(renamed, key, "left")
    columns = [F.coalesce(f"_{c}", c).alias(c) if c in new else F.col(c) for c in manifests.columns]
    return joined.select(*columns, *[F.col(f"_{c}").alias(c) for c in new if c not in manifests.columns])


def latest_manifests(manifests: DataFrame) -> DataFrame:
    """One row per source: the last finished run, a finished one before any other; equal ones by the smallest remaining columns."""
    rest = [c for c in manifests.columns if c not in ("source_id", "finished_at")]
    best = F.max_by(F.struct(*manifests.columns), F.struct(F.col("status").isin(*FINISHED), "finished_at", F.to_json(F.struct(*rest))))
    return manifests.groupBy("source_id").agg(best.alias("m")).select("m.*")


def documents(chunks: DataFrame) -> DataFrame:
    """doc_id of every document with chunks, sorted."""
    return chunks.filter("doc_id is not null").select("doc_id").distinct().orderBy("doc_id")


def cleaned_up(rows: DataFrame, column: str = "doc_id", prefix: str = "API-") -> tuple[DataFrame, DataFrame]:
    """The rows that stay after a clean-up of interactive uploads, and the ids it removes."""
    gone = F.coalesce(F.col(column).startswith(prefix), F.lit(False))
    return rows.filter(~gone), rows.filter(gone).select(column).distinct()


def response(chunks: DataFrame, doc_id: str) -> DataFrame:
    """The chunks of one document in order, each once: chunk_id, page, block_type, section_title, text."""
    own = chunks.filter(F.col("doc_id") == doc_id).dropDuplicates(["chunk_id"])
    return own.orderBy("page", F.regexp_extract("chunk_id", r":b(\d+)$", 1).cast("int"), "chunk_id").select("chunk_id", "page", "block_type", "section_title", "text")


def response_sizes(chunks: DataFrame) -> DataFrame:
    """doc_id, n_chunks, first_chunk, last_chunk of each document's response, without assembling it."""
    order = F.struct("page", F.regexp_extract("chunk_id", r":b(\d+)$", 1).cast("int"), "chunk_id")
    one = chunks.select("doc_id", "chunk_id", "page").distinct()
    return one.groupBy("doc_id").agg(F.count("*").cast("int").alias("n_chunks"), F.min_by("chunk_id", order).alias("first_chunk"), F.max_by("chunk_id", order).alias("last_chunk"))


def envelopes(chunks: DataFrame, registry: DataFrame) -> DataFrame:
    """source_id, filename, route, chunks of each document: what its response holds, the chunks in order and each once."""
    order = F.struct("page", F.regexp_extract("chunk_id", r":b(\d+)$", 1).cast("int").alias("idx"), "chunk_id", "block_type", "section_title", "text")
    body = chunks.filter("doc_id is not null").dropDuplicates(["chunk_id"]).groupBy(F.col("doc_id").alias("source_id")).agg(F.array_sort(F.collect_list(order)).alias("chunks"))
    name = F.min(F.when(strip(F.col("file_path")) != "", F.col("file_path")))
    files = registry.groupBy(F.col("source_id").alias("s")).agg(name.alias("path"))
    rows = body.join(files, F.col("source_id") == F.col("s"), "left")
    return rows.select("source_id", F.element_at(F.split("path", "[/\\\\]"), -1).alias("filename"), service_route(extension(F.col("path"))).alias("route"), "chunks")


def envelope(chunks: DataFrame, registry: DataFrame, doc_id: str) -> DataFrame:
    """The envelope of one document; an unknown document fails the query when it runs."""
    own = envelopes(chunks.filter(F.col("doc_id") == doc_id), registry.filter(F.col("source_id") == doc_id))
    missing = chunks.sparkSession.range(1).select(F.lit(doc_id).alias("source_id")).join(own, "source_id", "left")
    found = F.when(F.col("chunks").isNull(), F.raise_error(F.lit(f"no such document: {doc_id}")).cast("string")).otherwise(F.col("source_id"))
    return missing.select(found.alias("source_id"), "filename", "route", "chunks")
