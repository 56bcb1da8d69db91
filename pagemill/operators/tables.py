"""Markdown tables as matrices, and back: Column expressions on array<array<string>>, one fold for wrapped rows."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagemill.functions import text as X

#: Characters of a cell from which a wrapped row may go to the head row as well: the same column, the other one.
LONG_SAME, LONG_OTHER = 22, 35


def parse(table: Column) -> Column:
    """Matrix of a pipe table of at least three rows, all bounded by pipes; null otherwise."""
    lines = X.full_lines(table, "any")
    bounded = F.forall(lines, lambda s: s.startswith("|") & s.endswith("|") & (F.length(s) > 1))
    cells = F.transform(lines, lambda s: F.transform(F.split(F.substring(s, F.lit(2), F.length(s) - 2), r"\|", -1), X.strip))
    return F.when((F.size(lines) >= 3) & bounded, cells)


def rebuild(matrix: Column) -> Column:
    """``|a|b|`` rows."""
    return F.array_join(F.transform(matrix, lambda row: F.concat(F.lit("|"), F.array_join(row, "|"), F.lit("|"))), "\n")


def promote_head(table: Column) -> Column:
    """Head cells ``ColN`` take the first data row, which goes; unchanged if widths differ or all replacements are one text."""
    m = parse(table)
    head, rule, first = F.get(m, F.lit(0)), F.get(m, F.lit(1)), F.get(m, F.lit(2))
    placeholder = r"(?i)^col\d+$"
    new = F.zip_with(head, first, lambda h, v: F.when(h.rlike(placeholder), F.when(v != "", v).otherwise(h)).otherwise(h))
    put = F.filter(F.zip_with(head, first, lambda h, v: F.when(h.rlike(placeholder), F.when(v != "", v).otherwise(h))), lambda v: v.isNotNull())
    good = m.isNotNull() & X.is_separator_cells(rule) & (F.size(first) == F.size(head)) & (F.size(put) > 0) & ~((F.size(put) >= 2) & (F.size(F.array_distinct(put)) == 1))
    return F.when(good, rebuild(F.concat(F.array(new, rule), F.slice(m, F.lit(4), F.greatest(F.size(m) - 3, F.lit(0)))))).otherwise(table)


def fit_row(row: Column, n: Column) -> Column:
    """A row with ``n`` stripped cells: padded; an overlong one of at least two columns becomes its first cell and all others joined."""
    cells = F.transform(row, lambda c: X.strip(F.coalesce(c, F.lit(""))))
    padded = F.concat(cells, F.array_repeat(F.lit(""), F.greatest(n - F.size(cells), F.lit(0)).cast("int")))
    rest = F.array_join(F.slice(cells, F.lit(2), F.greatest(F.size(cells) - 1, F.lit(0))), " ")
    return F.when((n >= 2) & (F.size(cells) > n), F.array(F.get(cells, F.lit(0)), rest)).otherwise(F.slice(padded, F.lit(1), n.cast("int")))


def width(matrix: Column) -> Column:
    return F.coalesce(F.array_max(F.transform(matrix, F.size)), F.lit(0))


def to_markdown(matrix: Column) -> Column:
    """Pipe table with head and separator, rows padded to the widest; line ends as ``<br>``, pipes escaped. Empty for no rows."""
    n = width(matrix)
    def cell(c: Column) -> Column:
        return F.replace(F.regexp_replace(X.strip(F.coalesce(c, F.lit(""))), "\n", "<br>"), F.lit("|"), F.lit("\\|"))
    rows = F.transform(matrix, lambda r: F.concat(F.lit("| "), F.array_join(F.concat(F.transform(r, cell), F.array_repeat(F.lit(""), (n - F.size(r)).cast("int"))), " | "), F.lit(" |")))
    rule = F.concat(F.lit("| "), F.array_join(F.array_repeat(F.lit("---"), n.cast("int")), " | "), F.lit(" |"))
    body = F.concat(F.slice(rows, 1, 1), F.array(rule), F.slice(rows, F.lit(2), F.greatest(F.size(rows) - 1, F.lit(0))))
    return F.when(F.size(matrix) > 0, F.array_join(body, "\n")).otherwise("")


def merge_wrapped(matrix: list[list[str | None]] | None) -> list[list[str]]:
    """Two-column tables: rows with one empty cell go to the row above, which must not be the head unless that is long; noise rows go.

    Tables of other widths only get rows of one width.
    """
    rows = [[("" if c is None else str(c)).strip() for c in row] for row in (matrix or [])]
    n = max(map(len, rows), default=0)
    if n != 2:
        return [(row + [""] * (n - len(row)))[:n] for row in rows]
    out: list[list[str]] = []
    for row in rows:
        left, right = (row + ["", ""])[:2]
        if not right and (not left or (len(left) <= 12 and set(left) <= set("Ёё: \t"))):
            continue
        side = 1 if not left else 0 if not right else None
        if out and side is not None:
            above = out[-1]
            if len(out) > 1 or len(above[side]) > LONG_SAME or len(above[1 - side]) > LONG_OTHER:
                above[side] = f"{above[side]} {left or right}".strip()
                continue
        out.append([left, right])
    return out


def unwrapped(matrix: Column) -> Column:
    """:func:`merge_wrapped` as a vectorised function."""

    @F.pandas_udf("array<array<string>>")
    def run(tables: pd.Series) -> pd.Series:
        return tables.map(lambda t: merge_wrapped([list(r) for r in t] if t is not None else None))

    return run(matrix)


def table_text(matrix: Column) -> Column:
    """An extracted table as markdown: blank rows out, wrapped rows of two columns merged."""
    full = F.filter(matrix, lambda r: F.exists(r, lambda c: X.strip(F.coalesce(c, F.lit(""))) != ""))
    return to_markdown(unwrapped(full))


def _sheets(cells: DataFrame) -> DataFrame:
    """source_id, sheet_idx, sheet, head, rule of each sheet that holds something: any cell that is not blank, or a head cell that does not begin with ``unnamed``.

    ``cells``: source_id, sheet_idx, sheet, row_idx (0: head), cells. Sheets without a head row have none.
    """
    filled = F.exists("cells", lambda c: X.strip(F.coalesce(c, F.lit(""))) != "")
    named = F.exists("cells", lambda c: (X.strip(F.coalesce(c, F.lit(""))) != "") & ~F.lower(X.strip(F.coalesce(c, F.lit("")))).startswith("unnamed"))
    top = F.col("row_idx") == 0
    rule = F.concat(F.lit("| "), F.array_join(F.transform("cells", lambda c: F.lit("---")), " | "), F.lit(" |"))
    out = cells.groupBy("source_id", "sheet_idx").agg(F.min("sheet").alias("sheet"), F.bool_or(F.when(top, named).otherwise(filled)).alias("full"), F.min(F.when(top, _line())).alias("head"), F.min(F.when(top, rule)).alias("rule"))
    return out.filter("full and head is not null").drop("full")


def _line() -> Column:
    return F.concat(F.lit("| "), F.array_join(F.transform("cells", X.cell_text), " | "), F.lit(" |"))


def _text(title: Column, rows: Column) -> Column:
    return F.concat(F.lit("# Лист: "), title, F.lit("\n\n[Таблица]\n"), F.concat_ws("\n", "head", "rule", F.when(rows != "", rows)))


def _joined(rows: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(rows), lambda r: r["line"]), "\n")


def sheet_pages(cells: DataFrame, split_chars: int = 0) -> DataFrame:
    """source_id, page, text: one markdown page per filled sheet, in tab order; with ``split_chars``, parts of about that size with the head repeated.

    Parts are cut where the running length passes a multiple of ``split_chars``, so the rows of a sheet are numbered by
    a window over that sheet alone; a part is assembled from its own rows only. Sheets without a head row have no page.
    """
    by_sheet = ["source_id", "sheet_idx"]
    heads = _sheets(cells)
    body = cells.filter("row_idx > 0").select(*by_sheet, "row_idx", _line().alias("line"))
    part = F.lit(0)
    if split_chars > 0:
        body = body.join(heads.select(*by_sheet, (F.length("head") + F.length("rule")).alias("top")), by_sheet)
        size = F.sum(F.length("line") + 1).over(Window.partitionBy(*by_sheet).orderBy("row_idx"))
        part = F.floor((size - 1) / F.greatest(F.lit(1), F.lit(split_chars) - F.col("top") - 2)).cast("int")
    parts = body.withColumn("part", part).groupBy(*by_sheet, "part").agg(_joined(F.collect_list(F.struct("row_idx", "line"))).alias("rows"))
    parts = heads.join(parts, by_sheet, "left").fillna({"part": 0, "rows": ""})
    if split_chars > 0:
        sheet = Window.partitionBy(*by_sheet)
        parts = parts.withColumns({"i": F.row_number().over(sheet.orderBy("part")), "n": F.count("*").over(sheet)})
        title = F.when(F.col("n") == 1, F.col("sheet")).otherwise(F.format_string("%s (часть %d/%d)", "sheet", "i", "n"))
    else:
        title = F.col("sheet")
    page = F.row_number().over(Window.partitionBy("source_id").orderBy("sheet_idx", "part"))
    return parts.select("source_id", page.alias("page"), _text(title, F.col("rows")).alias("text"))
