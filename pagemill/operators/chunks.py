"""Blocks of pages to linked chunks.

Merging across blocks depends on the text merged so far, so it is an ordered fold. A block that is neither a continuation nor
part of a table never goes to an earlier one, though: the fold runs once per such block and what continues it, not once
per document, and a document of any size spreads over the cluster.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.functions import rules as R
from pagemill.functions import text as X
from pagemill.operators.blocks import MAX_CHARS, OVERLAP, blocks_of_page
from pagemill.operators.ordered import carry_last, fold_groups
from pagemill.storage import Scratch

#: Characters up to which pieces of one table are put together again.
TABLE_CHARS = 500_000
_RUNNING_TEXT = {"paragraph", "list", "other"}


@dataclass
class Piece:
    page: int
    idx: int
    text: str
    kind: R.Kind
    end: int
    marks: tuple[bool, bool, bool]
    swallowed: list[int] = field(default_factory=list)  # pages whose first block went into this piece

    @property
    def is_continuation(self) -> bool:
        return self.marks[0]


def _piece(page: int, idx: int, text: str) -> Piece:
    kind = R.classify(text)
    return Piece(page, idx, text, kind, page, R.flags(text, kind.block_type, kind.confidence))


def _across_pages(rows: Iterable[tuple[int, int, str]]) -> Iterator[Piece]:
    """The first block of a page goes to the last piece if that breaks off and this continues; marks of the piece stay as they were."""
    last: Piece | None = None
    for page, idx, text in rows:
        new = _piece(page, idx, text)
        if idx == 0 and last is not None and last.page <= page:
            kind = last.kind.block_type
            fits = kind in _RUNNING_TEXT or (kind == "formula" and new.kind.block_type == "formula")
            if fits and R.dangling_end(last.text) and R.dangling_start(text):
                last.text = f"{last.text.rstrip()} {text.strip()}"
                last.end = page
                last.kind = last.kind._replace(confidence=min(last.kind.confidence, 0.7))
                last.swallowed.append(page)
                continue
        if last is not None:
            yield last
        last = new
    if last is not None:
        yield last


def _new_rows(above: str, below: str) -> str | None:
    """Rows of ``below`` behind the table head it repeats from ``above``; null if it repeats none of two rows with a separator."""
    a, b = ([line.rstrip() for line in R.unlabelled(t).splitlines()] for t in (above, below))
    same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    if len(a) < 2 or len(b) < 2 or same < 2 or not any(map(R.is_separator, b[:same])):
        return None
    return "\n".join(b[same:])


def _table_rest(last: Piece, new: Piece, most: int) -> str | None:
    """What of ``new`` continues the table ``last``; null if nothing does."""
    if last.kind.block_type != "table" or not (new.kind.block_type == "table" or R.is_table_fragment(new.text)):
        return None
    room = max(most, TABLE_CHARS) - len(last.text) - 2
    rest = _new_rows(last.text, new.text)
    if rest is not None:
        return rest if len(rest) <= room else None
    t = new.text.strip()
    plain_rows = t.startswith("|") and not R.is_separator(t.split("\n", 1)[0])
    return R.unlabelled(t) if len(new.text) <= room and (new.is_continuation or plain_rows) else None


def _continued(last: Piece, new: Piece, most: int) -> Piece | None:
    """Both as one piece, null if they stay apart."""
    kinds = {last.kind.block_type, new.kind.block_type}
    fits = kinds == {"formula"} or kinds <= _RUNNING_TEXT
    if not (new.is_continuation and fits and len(last.text) + len(new.text) + 1 <= most):
        return None
    text = f"{last.text.rstrip()} {new.text.strip()}"
    kind = R.classify(text)
    if kind.block_type not in _RUNNING_TEXT | {"formula"}:
        return None
    kind = kind._replace(confidence=min(last.kind.confidence, kind.confidence, 0.85))
    return Piece(last.page, last.idx, text, kind, max(last.end, new.end), R.flags(text, kind.block_type, kind.confidence), last.swallowed + new.swallowed)


def merge_rows(rows: Iterable[tuple[int, int, str]], most: int = MAX_CHARS) -> Iterator[Piece]:
    """The fold over one run of blocks (page, idx, text) in order; only the last piece is held."""
    last: Piece | None = None
    for new in _across_pages(rows):
        if last is not None:
            rest = _table_rest(last, new, most)
            if rest is not None:
                text = f"{last.text.rstrip()}\n{rest}"
                conf = min(last.kind.confidence, new.kind.confidence)
                last = Piece(last.page, last.idx, text, R.Kind("table", None, conf), max(last.end, new.end), R.flags(text, "table", conf), last.swallowed + new.swallowed)
                continue
            both = _continued(last, new, most)
            if both is not None:
                last = both
                continue
            yield last
        last = new
    if last is not None:
        yield last


_FOLDED = (
    "doc_id string, page int, idx int, page_end int, text string, block_type string, block_level int, structure_confidence double, "
    "is_continuation boolean, is_truncated boolean, needs_review boolean, swallowed array<int>"
)


def _cut_pages(most: int, overlap: int):
    """Blocks of each page, with a mark on those that can't go on from an earlier one: neither a continuation nor part of a table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, page, text in zip(*(c.to_pylist() for c in batch.columns)):
                for idx, block in enumerate(blocks_of_page(text, most, overlap)):
                    head = not (R.dangling_start(block) or R.is_table_fragment(block) or R.classify(block).block_type == "table")
                    out.append((doc, page, idx, block, head))
            columns = list(zip(*out)) if out else [[]] * 5
            kinds = (pa.string(), pa.int32(), pa.int32(), pa.string(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=["doc_id", "page", "idx", "text", "head"])

    return run


def structural_chunks(pages: DataFrame, most: int = MAX_CHARS, overlap: int = OVERLAP) -> DataFrame:
    """Pages (source_id, page, text) to chunks: chunk_id, doc_id, page, page_end, section_title, text, entities, source_ref, block_type,
    block_level, parent_header_id, structure_confidence, is_continuation, is_truncated, needs_review.

    Defined cases: rows without source or page are left out; of several rows of one page the last one loaded whose text is not blank counts
    (by ``loaded_at``, if there is such a column; of equal ones the smallest text); null and blank texts have no chunks; other columns are not read.
    """
    work = Scratch(pages.sparkSession, "chunks")
    loaded = F.col("loaded_at").cast("timestamp") if "loaded_at" in pages.columns else F.lit(None).cast("timestamp")
    one = pages.select(F.col("source_id").alias("doc_id"), F.col("page").cast("int").alias("page"), "text", loaded.alias("loaded")).filter("doc_id is not null and page is not null")
    full = F.when(F.col("text").rlike(r"[^\s\p{Z}]"), F.struct((-F.coalesce(F.unix_micros("loaded"), F.lit(-(1 << 62)))).alias("age"), "text"))
    one = one.groupBy("doc_id", "page").agg(F.min(full)["text"].alias("text")).filter("text is not null")
    rows = work.cut(one.mapInArrow(_cut_pages(most, overlap), "doc_id string, page int, idx int, text string, head boolean"), "blocks")
    rows = carry_last(rows, F.when(F.col("head"), F.struct("page", "idx")), "run", inclusive=True)

    def fold(group: Iterator[dict]) -> Iterator[tuple]:
        first = next(group)
        for p in merge_rows(((r["page"], r["idx"], r["text"]) for r in chain([first], group)), most):
            yield first["doc_id"], p.page, p.idx, p.end, p.text, *p.kind, *p.marks, p.swallowed

    rows = rows.select("doc_id", F.col("run.page").alias("run_page"), F.col("run.idx").alias("run_idx"), "page", "idx", "text")
    folded = work.cut(fold_groups(rows, ["doc_id", "run_page", "run_idx"], ["page", "idx"], fold, _FOLDED, stream=True), "folded")
    shifted = folded.select("doc_id", F.explode("swallowed").alias("page")).distinct().withColumn("shift", F.lit(1))
    out = folded.join(shifted, ["doc_id", "page"], "left").withColumn("idx", F.col("idx") - F.coalesce("shift", F.lit(0)))
    out = out.withColumn("chunk_id", F.format_string("%s:p%d:b%d", "doc_id", "page", "idx"))
    title = F.regexp_replace(X.strip(F.col("text")), X.rx(r"\s+"), " ")
    out = out.withColumn("own", F.when(F.col("block_type") == "header", F.struct("chunk_id", title.alias("title"))))
    out = carry_last(out, F.col("own"), "above")
    return out.select(
        "chunk_id", "doc_id", "page", "page_end", F.coalesce("own.title", "above.title", F.lit("")).alias("section_title"), "text",
        F.array().cast("array<struct<type:string,value:string>>").alias("entities"), F.concat_ws(":", "doc_id", F.col("page").cast("string"), "chunk_id").alias("source_ref"),
        "block_type", "block_level", F.col("above.chunk_id").alias("parent_header_id"), "structure_confidence", "is_continuation", "is_truncated", "needs_review",
    )


def link_sections(chunks: DataFrame) -> DataFrame:
    """chunk_id, title, header_id: section carried forward and previous header of any chunk table with doc_id, page, chunk_id, block_type, text."""
    rows = chunks.withColumn("idx", F.regexp_extract("chunk_id", r":b(\d+)$", 1).cast("int"))
    title = F.regexp_replace(X.strip(F.col("text")), X.rx(r"\s+"), " ")
    rows = rows.withColumn("own", F.when(F.col("block_type") == "header", F.struct("chunk_id", title.alias("title"))))
    out = carry_last(rows, F.col("own"), "above", order=("idx", "chunk_id"))
    return out.select("chunk_id", F.coalesce("own.title", "above.title", F.lit("")).alias("title"), F.col("above.chunk_id").alias("header_id"))


def enrich(chunks: DataFrame) -> DataFrame:
    """Entities, explanations of formulas taken into them, and lists of one page put together.

    A chunk behind a formula on the same page that begins with ``где`` becomes the formula's ``formula_vars``; it is not looked at
    again. A list behind a list of the same page is appended to it. Both stay inside a page, so pages run in parallel.
    """
    rows = chunks.withColumn("entities", F.when(F.size("entities") > 0, F.col("entities")).otherwise(X.entities(F.col("text"))))
    rows = rows.withColumn("idx", F.regexp_extract("chunk_id", r":b(\d+)$", 1).cast("int"))
    if "formula_vars" not in rows.columns:
        rows = rows.withColumn("formula_vars", F.lit(None).cast("string"))
    rows = Scratch(chunks.sparkSession, "enrich").cut(rows, "rows")

    def fold(todo: list[dict]) -> list[tuple]:
        out: list[dict] = []
        skip = False
        for row, after in zip(todo, [*todo[1:], None]):
            if skip:
                skip = False
                continue
            if row["block_type"] == "formula" and after is not None and (after["text"] or "").strip().lower().startswith(("где ", "где:", "где\n", "где\t", "где\xa0")):
                row["formula_vars"] = after["text"]
                row["entities"] = [*row["entities"], *after["entities"]]
                skip = True
            elif row["block_type"] == "list" and out and out[-1]["block_type"] == "list":
                out[-1]["text"] += "\n" + row["text"]
                out[-1]["entities"] = [*out[-1]["entities"], *row["entities"]]
                continue
            out.append(row)
        return [tuple(r.values()) for r in out]

    kinds = ["formula", "list"]
    busy = rows.filter(F.col("block_type").isin(kinds)).select("doc_id", "page").distinct()
    folded = rows.join(busy, ["doc_id", "page"], "left_semi")
    folded = fold_groups(folded, ["doc_id", "page"], ["idx"], fold, folded.schema)
    return rows.join(busy, ["doc_id", "page"], "left_anti").unionByName(folded).drop("idx")
