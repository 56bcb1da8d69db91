"""Page geometry: words, boxes and recognised tokens as tables; joins and windows instead of nested loops.

boxes: source_id, page, box_ord, label, x1, y1, x2, y2, conf. words: source_id, page, word_ord, cx, cy, text, x_min, x_max,
block_no, line_no, word_no. tokens: source_id, page, angle, text, conf. A page is the unit of every join, so all of it
spreads over pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagemill.functions import text as X
from pagemill.operators.ordered import fold_groups
from pagemill.operators.tables import promote_head

PAGE = ["source_id", "page"]
# Labels that carry text, thresholds of the detections, and how columns, lines and table cells are told apart.
TEXT_LABELS = ("title", "plain text", "abandon", "figure_caption", "table_caption", "table_footnote", "table", "isolate_formula", "formula_caption")
FORMULA = "isolate_formula"
MIN_BOX_CONF, SAME_IOU, MOSTLY_INSIDE = 0.25, 0.45, 0.82
TOKEN_CONF = {"tesseract": 40.0, "easyocr": 0.4}
REJECT_TOKENS, REJECT_SHARE = 15, 0.4
TWO_COLUMNS = {"boxes": 6, "share": 0.22, "left": 0.42, "right": 0.58}
ROW_PX, CELL_PX, LINE_PX = 15, 30, (7, 26, 10)
UNREADABLE = "[ВНИМАНИЕ: СТРАНИЦА НЕЧИТАЕМА ИЗ-ЗА ПЛОХОГО КАЧЕСТВА СКАНА. ПОЖАЛУЙСТА, ОБРАТИТЕСЬ К ОРИГИНАЛУ]"
NATIVE_WORDS, NATIVE_CHARS, POOR_CYRILLIC, POOR_ODD = 30, 200, 0.35, 0.55


def area(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.greatest(F.lit(1), (x2 - x1) * (y2 - y1))


def _overlap(a: str, b: str) -> Column:
    def side(lo: str, hi: str) -> Column:
        return F.greatest(F.lit(0), F.least(f"{a}.{hi}", f"{b}.{hi}") - F.greatest(f"{a}.{lo}", f"{b}.{lo}"))

    return side("x1", "x2") * side("y1", "y2")


def _area_of(a: str) -> Column:
    return area(*(F.col(f"{a}.{c}") for c in ("x1", "y1", "x2", "y2")))


def box_pairs(boxes: DataFrame) -> DataFrame:
    """source_id, page, a, b, iou, a_in_b, b_in_a of each two boxes of one page that overlap, a before b."""
    one, two = boxes.alias("a"), boxes.alias("b")
    pairs = one.join(two, (F.col("a.source_id") == F.col("b.source_id")) & (F.col("a.page") == F.col("b.page")) & (F.col("a.box_ord") < F.col("b.box_ord")))
    shared = _overlap("a", "b")
    pairs = pairs.filter(shared > 0)
    union = F.greatest(F.lit(1), _area_of("a") + _area_of("b") - shared)
    return pairs.select(
        F.col("a.source_id").alias("source_id"), F.col("a.page").alias("page"), F.col("a.box_ord").alias("a"), F.col("b.box_ord").alias("b"),
        (shared / union).alias("iou"), (shared / _area_of("a")).alias("a_in_b"), (shared / _area_of("b")).alias("b_in_a"),
    )


def unique_formulas(boxes: DataFrame) -> DataFrame:
    """Boxes with one detection per formula: the surest is kept, others that coincide with a kept one go. Other labels stay."""
    def keep(group: list[dict]) -> list[tuple]:
        kept: list[dict] = []
        for b in sorted(group, key=lambda b: (-b["conf"], b["box_ord"], b["x1"], b["y1"], b["x2"], b["y2"])):
            size = max(1, (b["x2"] - b["x1"]) * (b["y2"] - b["y1"]))
            for k in kept:
                shared = max(0, min(b["x2"], k["x2"]) - max(b["x1"], k["x1"])) * max(0, min(b["y2"], k["y2"]) - max(b["y1"], k["y1"]))
                other = max(1, (k["x2"] - k["x1"]) * (k["y2"] - k["y1"]))
                if shared and (shared / (size + other - shared) >= SAME_IOU or shared / min(size, other) >= MOSTLY_INSIDE):
                    break
            else:
                kept.append(b)
        return [tuple(b.values()) for b in kept]

    formulas = boxes.filter(F.col("label") == FORMULA)
    return boxes.filter(F.col("label") != FORMULA).unionByName(fold_groups(formulas, PAGE, ["box_ord"], keep, boxes.schema))


def usable_boxes(boxes: DataFrame) -> DataFrame:
    """Boxes with text, without unsure ones that are neither table nor formula."""
    return boxes.filter(F.col("label").isin(*TEXT_LABELS)).filter((F.col("conf") >= MIN_BOX_CONF) | F.col("label").isin("table", FORMULA))


def words_to_boxes(words: DataFrame, boxes: DataFrame) -> DataFrame:
    """Each word with the box its centre lies in (null: none): the smallest, text before formula, the first of equal ones."""
    b = boxes.select(*PAGE, "box_ord", "label", "x1", "y1", "x2", "y2")
    inside = (F.col("cx") >= F.col("x1")) & (F.col("cx") <= F.col("x2")) & (F.col("cy") >= F.col("y1")) & (F.col("cy") <= F.col("y2"))
    rank = F.struct((F.col("label") == FORMULA).alias("f"), area(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2")).alias("size"), "box_ord")
    best = words.join(b, PAGE).filter(inside).groupBy(*PAGE, "word_ord").agg(F.min(rank).alias("best"))
    return words.join(best, [*PAGE, "word_ord"], "left").withColumn("box_ord", F.col("best.box_ord")).drop("best")


def words_outside_formulas(words: DataFrame, boxes: DataFrame) -> DataFrame:
    """Words whose centre lies in no formula."""
    f = boxes.filter(F.col("label") == FORMULA).select(F.col("source_id").alias("s"), F.col("page").alias("p"), "x1", "y1", "x2", "y2")
    return words.join(f, (F.col("source_id") == F.col("s")) & (F.col("page") == F.col("p")) & F.col("cx").between(F.col("x1"), F.col("x2")) & F.col("cy").between(F.col("y1"), F.col("y2")), "left_anti")


def reading_order(boxes: DataFrame, page_width: Column | str = "page_width") -> DataFrame:
    """Boxes with ``position`` (from 1): left column before right where a page has two, else from top to bottom."""
    page_width = F.col(page_width) if isinstance(page_width, str) else page_width
    page = Window.partitionBy(*PAGE)
    centre = (F.col("x1") + F.col("x2")) / 2
    n = F.count("*").over(page)
    need = F.greatest(F.lit(3), F.floor(n * TWO_COLUMNS["share"]))
    two = (n >= TWO_COLUMNS["boxes"]) & (F.sum((centre < page_width * TWO_COLUMNS["left"]).cast("int")).over(page) >= need) & (F.sum((centre > page_width * TWO_COLUMNS["right"]).cast("int")).over(page) >= need)
    rows = boxes.withColumns({"two_columns": two, "column": F.when(two & (centre >= page_width * 0.5), 1).otherwise(0)})
    return rows.withColumn("position", F.row_number().over(page.orderBy("column", "y1", "x1", "box_ord"))).drop("column")


def kept_tokens(tokens: DataFrame, engine: str) -> DataFrame:
    """Recognised tokens sure enough for the engine: above 40 for tesseract, from 0.4 for easyocr."""
    least = TOKEN_CONF[engine]
    return tokens.filter(F.col("conf") > least if engine == "tesseract" else F.col("conf") >= least)


def unreadable_pages(tokens: DataFrame) -> DataFrame:
    """source_id, page, n, share of pages with many tokens of which too few are sure."""
    sure = F.avg((F.col("conf") >= TOKEN_CONF["easyocr"]).cast("int"))
    return tokens.groupBy(*PAGE).agg(F.count("*").alias("n"), sure.alias("share")).filter((F.col("n") > REJECT_TOKENS) & (F.col("share") < REJECT_SHARE))


def with_unreadable(pages: DataFrame, tokens: DataFrame) -> DataFrame:
    """Pages (source_id, page, text, ...) with the fixed notice in place of the text where recognition failed (:func:`unreadable_pages`)."""
    bad = unreadable_pages(tokens).select(*PAGE, F.lit(True).alias("_bad"))
    return pages.join(bad, PAGE, "left").withColumn("text", F.when(F.col("_bad"), F.lit(UNREADABLE)).otherwise(F.col("text"))).drop("_bad")


def native_where_better(pages: DataFrame) -> DataFrame:
    """Scanned pages whose recognised text reads poorly take their native text if it is long enough and reads no worse.

    ``pages``: text, native_text, native_words (their number), is_scan; adds ``used_native``. Nulls never replace anything.
    """
    native = X.repair_words(X.clean_controls(F.col("native_text")))
    rows = pages.withColumns(dict(zip(("_c", "_w"), X.readability(F.col("text"))))).withColumn("_native", native)
    rows = rows.withColumns(dict(zip(("_nc", "_nw"), X.readability(F.col("_native")))))
    poor = F.col("is_scan") & (F.col("native_words") > NATIVE_WORDS) & ((F.col("_c") < POOR_CYRILLIC) | (F.col("_w") > POOR_ODD))
    better = (F.length("_native") > NATIVE_CHARS) & (F.col("_nc") >= F.col("_c")) & (F.col("_nw") <= F.col("_w"))
    rows = rows.withColumn("used_native", F.coalesce(poor & better, F.lit(False)))
    return rows.withColumn("text", F.when(F.col("used_native"), F.col("_native")).otherwise(F.col("text"))).drop("_c", "_w", "_nc", "_nw", "_native")


def orientations(tokens: DataFrame) -> DataFrame:
    """source_id, page, angle, score of the angle at which a page reads best: length by confidence, a little less upside down."""
    worth = F.length("text") * F.col("conf") * F.when(F.col("angle").isin(180, 270), 0.95).otherwise(1.0)
    score = tokens.filter(F.col("conf") > 0.4).groupBy(*PAGE, "angle").agg(F.sum(worth).alias("score"))
    best = score.groupBy(*PAGE).agg(F.max(F.struct("score", (-F.col("angle")).alias("minus"))).alias("b"))
    return best.select(*PAGE, (-F.col("b.minus")).alias("angle"), F.col("b.score").alias("score"))


def skews(contours: DataFrame) -> DataFrame:
    """source_id, page, skew: median of the contour angles between -15 and 15 but 0; pages with no more than half a degree are left out."""
    fit = contours.filter((F.abs("angle") < 15) & (F.col("angle") != 0))
    return fit.groupBy(*PAGE).agg(F.median("angle").alias("skew")).filter(F.abs("skew") > 0.5)


def line_gaps(words: DataFrame) -> DataFrame:
    """source_id, page, box_ord, gap: vertical distance up to which words share a line, from the lower quartile of the gaps."""
    low, high, default = LINE_PX
    ys = words.select(*PAGE, "box_ord", F.round("cy", 1).alias("y")).distinct()
    box = Window.partitionBy(*PAGE, "box_ord")
    steps = ys.withColumn("step", F.lead("y").over(box.orderBy("y")) - F.col("y")).filter(F.col("step") > 0.5)
    steps = steps.withColumns({"i": F.row_number().over(box.orderBy("step")) - 1, "n": F.count("*").over(box)})
    q = steps.filter(F.col("i") == F.floor(F.col("n") / 4)).select(*PAGE, "box_ord", F.greatest(F.lit(low), F.least(F.lit(high), F.floor(F.col("step") * 0.55))).alias("g"))
    return ys.select(*PAGE, "box_ord").distinct().join(q, [*PAGE, "box_ord"], "left").select(*PAGE, "box_ord", F.coalesce("g", F.lit(default)).cast("int").alias("gap"))


def box_lines(words: DataFrame) -> DataFrame:
    """source_id, page, box_ord, line, text of recognised words: a word joins the line whose running mean height is near enough."""
    gaps = line_gaps(words)

    def fold(group: list[dict]) -> list[tuple]:
        lines: list[list[dict]] = []
        mean = 0.0
        for w in group:
            if lines and abs(w["cy"] - mean) <= w["gap"]:
                lines[-1].append(w)
                mean += (w["cy"] - mean) / len(lines[-1])
            else:
                lines.append([w])
                mean = w["cy"]
        key = tuple(group[0][k] for k in (*PAGE, "box_ord"))
        return [(*key, i, " ".join(w["text"] for w in sorted(line, key=lambda w: w["cx"]))) for i, line in enumerate(lines)]

    rows = words.filter("box_ord is not null").join(gaps, [*PAGE, "box_ord"]).select(*PAGE, "box_ord", "cx", "cy", "text", "gap")
    return fold_groups(rows, [*PAGE, "box_ord"], ["cy", "cx", "text"], fold, "source_id string, page int, box_ord int, line int, text string")


def box_texts(words: DataFrame) -> DataFrame:
    """source_id, page, box_ord, text: native words by block, line and word number, recognised ones by lines."""
    native = words.filter("block_no >= 0 and line_no >= 0 and word_no >= 0 and box_ord is not null")
    own = native.select(*PAGE, "box_ord").distinct()
    ordered = words.join(own, [*PAGE, "box_ord"], "left_semi").groupBy(*PAGE, "box_ord").agg(F.array_sort(F.collect_list(F.struct("block_no", "line_no", "word_no", "cx", X.repair_token(F.col("text")).alias("text")))).alias("w"))
    ordered = ordered.select(*PAGE, "box_ord", F.array_join(F.transform("w", lambda x: x["text"]), " ").alias("text"))
    lines = box_lines(words.join(own, [*PAGE, "box_ord"], "left_anti"))
    lines = lines.groupBy(*PAGE, "box_ord").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "text"))), lambda x: x["text"]), " ").alias("text"))
    return ordered.unionByName(lines)


def word_tables(words: DataFrame) -> DataFrame:
    """source_id, page, box_ord, text: a markdown table of each box's words, as far as their places tell.

    A row takes words whose height is near that of its first one; a gap between words makes a cell. Rows are padded to the most pipes of any,
    pipes of the words included, and placeholder heads promoted; a wide table with few words of two letters or digits is given as plain lines.
    """
    def rows_of(group: list[dict]) -> list[tuple]:
        out, first, row = [], None, -1
        for w in group:
            if first is None or abs(w["cy"] - first) > ROW_PX:
                first, row = w["cy"], row + 1
            out.append((w["source_id"], w["page"], w["box_ord"], row, w["cx"], w["text"], w["x_min"], w["x_max"]))
        return out

    box = [*PAGE, "box_ord"]
    rows = words.filter("box_ord is not null").select(*box, "cx", "cy", "text", "x_min", "x_max")
    rows = fold_groups(rows, box, ["cy", "cx", "text"], rows_of, "source_id string, page int, box_ord int, line int, cx double, text string, x_min double, x_max double")
    line = Window.partitionBy(*box, "line").orderBy("cx", "text")
    text = F.replace(F.replace(X.repair_token(F.col("text")), F.lit("\n"), F.lit(" ")), F.lit("|"), F.lit("\\|"))
    edge = F.lag("x_max").over(line)
    glue = F.when(edge.isNull(), "").when(F.col("x_min") - edge > CELL_PX, " | ").otherwise(" ")
    rows = rows.withColumn("piece", F.struct(F.row_number().over(line).alias("i"), F.concat(glue, text).alias("t")))
    lines = rows.groupBy(*box, "line").agg(F.array_join(F.transform(F.array_sort(F.collect_list("piece")), lambda x: x["t"]), "").alias("t"))
    tables_ = lines.groupBy(*box).agg(F.transform(F.array_sort(F.collect_list(F.struct("line", "t"))), lambda x: x["t"]).alias("lines"))
    pipes = lambda t: F.length(t) - F.length(F.replace(t, F.lit("|")))
    tables_ = tables_.withColumn("most", F.array_max(F.transform("lines", pipes)))
    padded = F.transform("lines", lambda t: X.squeeze(F.concat(F.lit("| "), t, F.lit(" "), F.repeat(F.lit("| "), F.col("most") - pipes(t)), F.lit("|"))))
    rule = F.concat(F.lit("|"), F.rtrim(F.repeat(F.lit("---| "), F.col("most") + 1)))
    made = F.array_join(F.concat(F.slice(padded, 1, 1), F.array(rule), F.slice(padded, F.lit(2), F.greatest(F.size(padded) - 1, F.lit(0)))), "\n")
    few = (F.col("most") >= 4) & (F.regexp_count(made, F.lit("[А-Яа-яЁёA-Za-z0-9]{2,}")) < 2 * F.size("lines"))
    plain = F.array_join(F.filter(F.transform("lines", X.squeeze), lambda t: t != ""), "\n")
    return tables_.select(*box, F.concat(F.lit("[Таблица]\n"), F.when(few, plain).otherwise(promote_head(made))).alias("text"))


def page_texts(blocks: DataFrame) -> DataFrame:
    """source_id, page, text of block texts (position, label, text) in order: page numbers and tables of contents out, formula numbers
    to their formula, titles marked."""
    rows = blocks.withColumn("text", X.clean_controls(X.bullets(F.col("text")))).filter(~F.col("text").rlike(r"^(?:#\s*)?\d{1,3}$") & ~F.col("text").rlike(r"\.{5,}") & (F.col("text") != ""))
    page = Window.partitionBy(*PAGE).orderBy("position")
    number = F.col("text").rlike(r"^\(\s*\d+\s*\)$")
    rows = rows.withColumn("number", number).withColumn("formula", X.is_formula(F.col("text")))
    # consecutive numbers all go to the formula in front of them
    base = F.last(F.when(~F.col("number"), F.struct("position", "formula")), True).over(page)
    rows = rows.withColumn("base", base).withColumn("to", F.when(F.col("number") & F.coalesce(F.col("base.formula"), F.lit(False)), F.col("base.position")).otherwise(F.col("position")))
    title = F.when((F.col("label") == "title") & (F.col("to") == F.col("position")) & ~F.col("text").rlike(r"^\d+[.)]\s"), F.concat(F.lit("# "), "text")).otherwise(F.col("text"))
    joined = rows.withColumn("text", title).groupBy(*PAGE, "to").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", "text"))), lambda x: x["text"]), " ").alias("text"))
    whole = joined.groupBy(*PAGE).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("to", "text"))), lambda x: x["text"]), "\n\n").alias("text"))
    return whole.withColumn("text", X.clean_page(F.col("text")))


def item_pages(items: DataFrame) -> DataFrame:
    """source_id, page, text of a converter's items (item_ord, label, page, text): page headers and footers out, page 1 where none is given."""
    kept = items.filter(~F.coalesce("label", F.lit("")).isin("page_header", "page_footer")).withColumn("page", F.coalesce("page", F.lit(1)))
    kept = kept.withColumn("text", X.tidy_paragraphs(F.col("text"))).filter(F.col("text") != "")
    return kept.groupBy(*PAGE).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("item_ord", "text"))), lambda x: x["text"]), "\n\n").alias("text"))


def scaled_formulas(boxes: DataFrame, dpi: int = 300, target: int = 512, most: float = 4.0) -> DataFrame:
    """source_id, page, box_ord, x1 to y2 in pixels and ``scale`` (1 where nothing is gained) of each formula box in points."""
    pixels = {c: F.col(c) * F.lit(dpi / 72.0) for c in ("x1", "y1", "x2", "y2")}
    edge = F.least(pixels["x2"] - pixels["x1"], pixels["y2"] - pixels["y1"])
    scale = F.least(F.lit(most), F.greatest(F.lit(1.0), F.lit(float(target)) / F.greatest(edge, F.lit(1.0))))
    return boxes.filter(F.col("label") == FORMULA).select(*PAGE, "box_ord", *(v.alias(c) for c, v in pixels.items()), F.when(scale <= 1.001, 1.0).otherwise(scale).alias("scale"))
