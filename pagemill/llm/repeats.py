"""Lines repeated across one source's pages.

The page numbers of each line are kept as a compressed bitmap in rows: one per (source, line, 64-bit word) that has a bit
set. Variants of a line, which differ in case, blanks or numbers, have bitmaps of their own first; those of one key are
united by OR, on the map side where they meet there. Exact cardinalities are sums of bit counts. The bitmaps of lines over
the threshold are turned to the pages: per source and word the lines with a bit in it. A page looks up its own bit
there, which gives the lines to delete; only pages with any are split into lines again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.storage import Scratch

#: Bytes of repeated lines' bitmaps up to which they are broadcast; beyond, the lookup is a shuffled join.
BROADCAST_BYTES = 64 << 20
#: Word of the rows that stands for all pages: pages without a number have the lines of their source looked up there.
NO_PAGE = -(1 << 40)

#: White space cut off at both ends of a line: fixed values of Unicode's White_Space property and the separators U+001C-U+001F.
SPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def line_key(line: Column) -> Column:
    """What equal lines share: outer white space cut, blank runs as one blank, case ignored, digit runs as one ``0``."""
    text = F.regexp_replace(F.btrim(line, F.lit(SPACE)), "[ \\t]{2,}|\\t", " ")
    return F.regexp_replace(F.lower(text), "[0-9]+", "0")


def page_lines(pages: DataFrame, min_letters: int = 0, *more: str) -> DataFrame:
    """One row per line of each page: page_id, source_id, page, line_no from 1, line, and the columns ``more``."""
    lines = pages.select("page_id", "source_id", "page", *more, F.posexplode(F.split("text", "\n", -1)).alias("i", "line"))
    if min_letters:
        lines = lines.filter(F.length("line") >= min_letters).filter(F.col("line").rlike(f"(?s)(?:\\P{{L}}*+\\p{{L}}){{{min_letters}}}"))
    return lines.select("page_id", "source_id", "page", *more, (F.col("i") + 1).alias("line_no"), "line")


def _marked(lines: DataFrame) -> DataFrame:
    """Two 64-bit hashes of source and key stand for both: 128 bits, so that the bitmaps are keyed by two numbers."""
    owner, key = F.coalesce(F.concat(F.lit("s"), "source_id"), F.lit("")), line_key(F.col("line"))
    lines = lines.withColumn("key", key)
    return lines.withColumns({"h1": F.xxhash64(owner, "key"), "h2": F.xxhash64("key", F.lit(1), owner), "variant": F.xxhash64("line")})


def line_bitmaps(marked: DataFrame) -> DataFrame:
    """source_id, h1, h2, word, bits: per source the pages on which a line or a variant of it stands, 64 to a row.

    The bitmaps of the variants (h1, h2, variant) are made first, then united.
    """
    bit = F.bit_or(F.expr("shiftleft(1L, page & 63)")).alias("bits")
    variants = marked.filter("page is not null").groupBy("source_id", "h1", "h2", "variant", F.shiftright("page", 6).cast("long").alias("word")).agg(bit)
    return variants.groupBy("source_id", "h1", "h2", "word").agg(F.bit_or("bits").alias("bits"))


def repeated_lines(pages: DataFrame, min_share: float = 0.25, min_pages: int = 20, min_letters: int = 10) -> DataFrame:
    """page_id, line_no of each occurrence of a line that stands on at least ``min_share`` of the distinct page
    numbers of its source, in sources with at least ``min_pages`` of them.

    Defined cases: a null source is a source of its own; a row without a page number sets no bit, but its lines
    are reported if they equal a repeated one; null and empty texts have no lines; repeated deliveries set
    the same bit and are each reported; extra columns are not read; an empty table gives an empty result.
    """
    work = Scratch(pages.sparkSession, "repeats")
    pages = pages.select("page_id", "source_id", "page", "text")
    size = (
        pages.filter("page is not null").groupBy("source_id", F.shiftright("page", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, page & 63)")).alias("bits"))
        .groupBy(F.col("source_id").alias("owner")).agg(F.sum(F.bit_count("bits")).alias("n_pages")).filter(F.col("n_pages") >= min_pages)
    )
    maps = work.cut(line_bitmaps(_marked(page_lines(pages, min_letters))), "bitmaps")
    many = maps.groupBy("source_id", "h1", "h2").agg(F.sum(F.bit_count("bits")).alias("n")).filter(F.col("n") >= F.ceil(F.lit(min_share) * min_pages))
    over = many.join(size, F.col("source_id").eqNullSafe(F.col("owner"))).filter(F.col("n") >= F.col("n_pages") * F.lit(min_share)).select("h1", "h2")
    kept = maps.join(over, ["h1", "h2"], "left_semi")
    kept = kept.unionByName(kept.select("source_id", "h1", "h2", F.lit(NO_PAGE).alias("word"), F.lit(-1).cast("long").alias("bits")).distinct())
    # a source has at most 1 / min_share times as many repeated lines as lines on a page, which bounds the list of each row
    turned = kept.groupBy(F.coalesce(F.concat(F.lit("s"), "source_id"), F.lit("")).alias("owner"), "word").agg(F.collect_list(F.struct("h1", "h2", "bits")).alias("lines"))
    turned = work.cut(turned, "turned")
    rows, entries = turned.agg(F.count("*"), F.coalesce(F.sum(F.size("lines")), F.lit(0))).first()
    if 64 * rows + 32 * entries <= BROADCAST_BYTES:
        turned = F.broadcast(turned)
    own = pages.withColumns({"owner": F.coalesce(F.concat(F.lit("s"), "source_id"), F.lit("")), "word": F.coalesce(F.shiftright("page", 6).cast("long"), F.lit(NO_PAGE))})
    here = F.filter("lines", lambda x: (F.col("page").isNull()) | (x["bits"].bitwiseAND(F.expr("shiftleft(1L, page & 63)")) != 0))
    hit = own.join(turned, ["owner", "word"]).withColumn("here", F.transform(here, lambda x: F.struct(x["h1"], x["h2"]))).filter(F.size("here") > 0)
    lines = _marked(page_lines(hit, min_letters, "here"))
    return lines.filter(F.array_contains("here", F.struct("h1", "h2"))).select("page_id", "line_no")


def remove_repeated(pages: DataFrame, **settings: float) -> DataFrame:
    """page_id, text, n_removed: every page row without its repeated lines; null texts stay null."""
    gone = repeated_lines(pages, **settings).groupBy("page_id").agg(F.collect_set("line_no").alias("gone"))
    kept = F.expr("filter(split(text, '\\n', -1), (x, i) -> not array_contains(coalesce(gone, array()), i + 1))")
    out = pages.select("page_id", "text").join(gone, "page_id", "left")
    return out.select("page_id", F.array_join(kept, "\n").alias("text"), F.coalesce(F.size("gone"), F.lit(0)).alias("n_removed"))
