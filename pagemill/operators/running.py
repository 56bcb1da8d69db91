"""Running headers and footers, removed per document.

Every page keeps only the keys of its lines and two counters: how many lines are off its head and foot. A round
counts the lines now in front by document; where one reaches the threshold, the pages that have it move on. Rounds are
aggregates and joins on the document, and only the pages of documents that lost a line are carried into the next one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.functions.text import full_lines, line_key, split_lines, strip
from pagemill.storage import Scratch

#: Rounds at either end, share of the pages, and the length of a line that may be a running one.
ROUNDS, MIN_FRACTION, MIN_LEN, MAX_LEN, MIN_PAGES = 5, 0.9, 5, 240, 3


def _rounds(work: Scratch, state: DataFrame, need: DataFrame, counter: str, front: Column, rounds: int) -> DataFrame | None:
    """page_id, n: lines that come off one end of each page of the documents that lose some; null if none does."""
    key = F.when((F.length(front) >= MIN_LEN) & (F.length(front) <= MAX_LEN), line_key(front))
    out = None
    for _ in range(rounds):
        now = state.withColumn("key", key)
        count = now.filter("key is not null").groupBy("source_id", "key").agg(F.count("*").alias("n"), F.min("page").alias("seen"))
        top = count.groupBy("source_id").agg(F.max_by("key", F.struct("n", -F.col("seen"))).alias("best"), F.max("n").alias("n"))
        top = top.join(need, "source_id").filter("n >= need").select("source_id", "best")
        state = work.cut(now.join(top, "source_id").withColumn(counter, F.col(counter) + F.when(F.col("key") == F.col("best"), 1).otherwise(0)).drop("key", "best"), "running")
        if state.isEmpty():
            break
        seen = state.select("page_id", F.col(counter).alias("n"))
        out = seen if out is None else out.unionByName(seen)
    return None if out is None else out.groupBy("page_id").agg(F.max("n").alias("n"))


def strip_running(pages: DataFrame, rounds: int = ROUNDS, fraction: float = MIN_FRACTION) -> DataFrame:
    """page_id, source_id, page, text, n_head, n_foot: pages without the lines that begin or end almost all pages of their source.

    Defined cases: sources with fewer than MIN_PAGES page rows stay as they are, as does a page that would become empty; of equally frequent
    lines the one seen first counts; null texts stay null; a null source is a source of its own; a line is cut only where
    it is first or last when its round comes.
    """
    fraction = min(1.0, max(0.5, fraction))
    work = Scratch(pages.sparkSession, "running")
    rows = pages.select("page_id", F.coalesce("source_id", F.lit("")).alias("source_id"), "page", F.coalesce("text", F.lit("")).alias("text"))
    lines = full_lines(F.col("text"), "any")
    need = rows.groupBy("source_id").agg(F.count("*").alias("n")).filter(F.col("n") >= MIN_PAGES)
    need = need.select("source_id", F.greatest(F.lit(1), F.ceil(F.col("n") * fraction - 1e-12)).alias("need"))
    rows = rows.select("page_id", "source_id", "page", F.slice(lines, 1, rounds).alias("heads"), F.slice(F.reverse(lines), 1, rounds).alias("feet"), F.size(lines).alias("size"), F.lit(0).alias("h"), F.lit(0).alias("f"))
    state = work.cut(rows, "lines")
    left = F.col("size") - F.col("h") - F.col("f") > 0
    none = state.select("page_id", F.lit(0).alias("n")).limit(0)
    heads = _rounds(work, state, need, "h", F.when(left, F.get("heads", F.col("h"))), rounds)
    heads = none if heads is None else work.cut(heads, "heads")
    state = state.drop("h").join(heads.withColumnRenamed("n", "h"), "page_id", "left").withColumn("h", F.coalesce("h", F.lit(0)))
    feet = _rounds(work, state, need, "f", F.when(left, F.get("feet", F.col("f"))), rounds)
    feet = none if feet is None else feet
    cuts = heads.withColumnRenamed("n", "h").join(feet.withColumnRenamed("n", "f"), "page_id", "full").na.fill(0, ["h", "f"]).filter("h + f > 0")
    out = pages.select("page_id", "source_id", "page", "text").join(cuts, "page_id", "left")
    out = out.withColumn("lines", split_lines(F.coalesce("text", F.lit(""))))
    full = F.filter(F.transform("lines", lambda s, i: F.when(strip(s) != "", i)), lambda i: i.isNotNull())
    first = F.when(F.col("h") > 0, F.get(full, F.col("h") - 1) + 1).otherwise(0)
    last = F.when(F.col("f") > 0, F.get(full, F.size(full) - F.col("f"))).otherwise(F.size("lines"))
    rest = strip(F.array_join(F.slice("lines", first + 1, F.greatest(last - first, F.lit(0))), "\n"))
    kept = F.when(F.col("h").isNull() | (rest == ""), F.col("text")).otherwise(rest)
    return out.select("page_id", "source_id", "page", kept.alias("text"), F.coalesce("h", F.lit(0)).alias("n_head"), F.coalesce("f", F.lit(0)).alias("n_foot"))
