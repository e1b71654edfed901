"""Table grids: HTML or Markdown table bodies as cells, header inference, header context, roles, recall audit."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataquery.functions.numeric import ratio
from strataquery.functions.text import evidence_key, has_number, is_value_like, looks_like_identifier

ARROW = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "array<string>": pa.list_(pa.string())}
CELLS = "block_id string, cell_id string, row_index long, column_index long, row_span int, column_span int, text string, is_header boolean"
CONTEXT = CELLS + ", headers long, column_headers array<string>, row_headers array<string>"
#: Bodies of these tags alone, without references, are read by a pattern, with the parser's cells in a fraction of its time.
PLAIN = re.compile(r"""[^&<>\x00]*(?:<(?:/?(?:table|thead|tbody|tr|td|th)|br|t[dh](?: (?:row|col)span=(?:[0-9]{1,18}|'[0-9]{1,18}'|"[0-9]{1,18}"))+)>[^&<>\x00]*)*""")
TAG = re.compile("<(/?[a-z]+)([^>]*)>([^<]*)")
SPAN = re.compile("((?:row|col)span)=.?([0-9]+)")
NUMBER = re.compile("[0-9]")


class _Grid(HTMLParser):
    """Places cells in the first free slot of their row. Spans are kept as column intervals with the row before which they end, whatever their size."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.cells: list[list] = []
        self.row = -1
        self.column = 0
        self.spans: list[tuple[int, int, int]] = []
        self.open: list | None = None

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "tr":
            self.close_cell()
            self.row, self.column = self.row + 1, 0
            self.spans = [x for x in self.spans if x[2] > self.row]
        elif tag in ("td", "th"):
            self.close_cell()
            self.row = max(self.row, 0)
            rows, columns = (_span(dict(attrs).get(k)) for k in ("rowspan", "colspan"))
            while ends := [end for start, end, last in self.spans if last > self.row and start <= self.column < end]:
                self.column = max(ends)
            self.open = [self.row, self.column, rows, columns, [], tag == "th"]
            self.spans.append((self.column, self.column + columns, self.row + rows))
            self.column += columns
        elif tag == "br" and self.open:
            self.open[4].append(" ")

    def handle_endtag(self, tag: str) -> None:
        if tag in ("td", "th", "tr", "table"):
            self.close_cell()

    def handle_data(self, data: str) -> None:
        if self.open:
            self.open[4].append(data)

    def close_cell(self) -> None:
        if self.open:
            row, column, rows, columns, text, head = self.open
            self.cells.append([row, column, rows, columns, " ".join("".join(text).split()), head])
            self.open = None


def _span(value: str | None) -> int:
    """A span of 1 at least and of what an int holds at most; what is no number in ASCII digits is 1."""
    given = re.fullmatch(r"\s*\+?([0-9]{1,18})\s*", value or "")
    return min(max(1, int(given[1])), (1 << 31) - 1) if given else 1


def _markdown(body: str) -> list[list]:
    """Lines with a bar, without those of three dashes or more in each cell; the first is the header."""
    rows = [[c.strip() for c in x.strip().strip("|").split("|")] for x in body.splitlines() if "|" in x]
    rows = [row for row in rows if not all(re.fullmatch(":?-{3,}:?", c.replace(" ", "")) for c in row)]
    return [[r, c, 1, 1, text, r == 0] for r, row in enumerate(rows) for c, text in enumerate(row)]


def _plain(body: str) -> list[list]:
    """The cells that _Grid gives for a body of PLAIN; a cell of one row can't stand in the way of a later row, so only taller ones are kept as spans."""
    cells, spans, cell, row, column = [], [], None, -1, 0
    for tag, attributes, text in TAG.findall(body):
        if tag == "td" or tag == "th":
            if row < 0:
                row = 0
            rows = columns = 1
            if attributes:
                given = dict(SPAN.findall(attributes))
                rows, columns = _span(given.get("rowspan")), _span(given.get("colspan"))
            while spans and (ends := [end for start, end, last in spans if last > row and start <= column < end]):
                column = max(ends)
            cell = [row, column, rows, columns, text, tag == "th"]
            cells.append(cell)
            if rows > 1:
                spans.append((column, column + columns, row + rows))
            column += columns
        elif tag == "br":
            if cell:
                cell[4] += " " + text
        elif tag == "tr":
            row, column, cell = row + 1, 0, None
        elif tag == "/thead" or tag == "/tbody" or tag == "table" or tag == "thead" or tag == "tbody":
            if cell:
                cell[4] += text
        else:
            cell = None
    for cell in cells:
        cell[4] = " ".join(cell[4].split())
    return cells


def cells_of(body: str) -> list[list]:
    """Cells of one table body: HTML where a table, row or cell tag gives any, else Markdown."""
    if re.search(r"(?i)<t(?:able|r|d|h)\b", body):
        if PLAIN.fullmatch(body):
            cells = _plain(body)
        else:
            grid = _Grid()
            grid.feed(body)
            grid.close()
            grid.close_cell()
            cells = grid.cells
        if cells:
            return cells
    return _markdown(body)


def _mapped(tables: DataFrame, schema: str, rows_of: Callable[[str], list[tuple]]) -> DataFrame:
    """Rows (block_id, cell_id, ..) of each table, by its own body alone."""
    names, types = zip(*[x.split() for x in schema.split(", ")], strict=True)
    target = pa.schema([(n, ARROW[t]) for n, t in zip(names, types, strict=True)])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("block_id").to_pylist(), batch.column("table_body").to_pylist(), strict=True)
            rows = [(b, f"{b}:r{x[0]:04d}:c{x[1]:04d}", *x) for b, body in pairs for x in rows_of(body or "")]
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, target.types, strict=True)], schema=target)

    return tables.select(F.col("block_id").cast("string").alias("block_id"), "table_body").mapInArrow(parse, schema)


def table_cells(tables: DataFrame) -> DataFrame:
    """Cells of (block_id, table_body); ids are block:rROW:cCOLUMN in four digits."""
    return _mapped(tables, CELLS, cells_of)


def _with_context(body: str) -> list[tuple]:
    """The rows of header_context for one body: its numeric cells below the headers, each with the texts above and left of it."""
    cells = cells_of(body)
    numbers, filled, seen = {}, {}, []
    for x in cells:
        row, text = x[0], x[4]
        number = text != "" and NUMBER.search(text) is not None
        seen.append(number)
        if number:
            numbers[row] = numbers.get(row, 0) + 1
        if text:
            filled[row] = filled.get(row, 0) + 1
    if not numbers:
        return []
    headers = min((y for y, n in numbers.items() if n >= 0.4 * filled[y]), default=None)
    if headers is None:
        return []
    above, beside, tall = [], {}, []
    for x, number in zip(cells, seen, strict=True):
        if x[4]:
            if x[0] < headers:
                above.append((x[0], x[1], x[4], x[1] + x[3]))
            elif not number:
                if x[2] == 1:
                    beside.setdefault(x[0], []).append((x[1], x[4]))
                else:
                    tall.append((x[1], x[4], x[0], x[0] + x[2]))
    above.sort()
    over, out = {}, []
    for x, number in zip(cells, seen, strict=True):
        row, column = x[0], x[1]
        if number and row >= headers:
            if column not in over:
                over[column] = [h[2] for h in above if h[1] <= column < h[3]]
            left = beside.get(row, ())
            if tall:
                left = [*left, *(c[:2] for c in tall if c[2] <= row < c[3])]
            out.append((*x, headers, over[column], [t for y, t in sorted(left) if y < column] if left else []))
    return out


def table_context(tables: DataFrame) -> DataFrame:
    """header_context(table_cells(tables)) in one pass: a cell's context stands in its own body, so nothing is shuffled or parsed twice.

    Of repeated block ids each body is a table of its own.
    """
    return _mapped(tables, CONTEXT, _with_context)


def header_rows(cells: DataFrame) -> DataFrame:
    """block_id, headers: leading rows before the first with a number in 40 % or more of its filled cells."""
    filled = F.col("text") != ""
    rows = cells.groupBy("block_id", "row_index").agg(F.count_if(filled & has_number(F.col("text"))).alias("numbers"), F.count_if(filled).alias("filled"))
    data = (F.col("numbers") >= 1) & (F.col("numbers") >= 0.4 * F.col("filled"))
    return rows.groupBy("block_id").agg(F.coalesce(F.min(F.when(data, F.col("row_index"))), F.max("row_index") + 1).alias("headers"))


def header_context(cells: DataFrame) -> DataFrame:
    """Numeric body cells with column_headers (above, covering their column) and row_headers (left of them)."""
    cells = cells.join(header_rows(cells), "block_id")
    body = cells.where((F.col("row_index") >= F.col("headers")) & has_number(F.col("text")))
    head = cells.where("row_index < headers AND text <> ''").select("block_id", F.col("row_index").alias("h_row"), F.col("column_index").alias("h_col"), F.col("column_span").alias("h_span"), F.col("text").alias("h_text"))
    left = cells.where("row_index >= headers AND text <> ''").where(~has_number(F.col("text"))).select("block_id", F.col("row_index").alias("l_row"), F.col("row_span").alias("l_span"), F.col("column_index").alias("l_col"), F.col("text").alias("l_text"))
    over = body.join(head, "block_id").where("column_index >= h_col AND column_index < h_col + h_span AND h_row < row_index")
    over = over.groupBy("cell_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("h_row", "h_col", "h_text"))), lambda x: x["h_text"]).alias("column_headers"))
    side = body.join(left, "block_id").where("row_index >= l_row AND row_index < l_row + l_span AND l_col < column_index")
    side = side.groupBy("cell_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("l_col", "l_text"))), lambda x: x["l_text"]).alias("row_headers"))
    empty = F.array().cast("array<string>")
    return body.join(over, "cell_id", "left").join(side, "cell_id", "left").withColumns({c: F.coalesce(c, empty) for c in ("column_headers", "row_headers")})


def classify(context: DataFrame, properties: Mapping[str, str], conditions: str) -> DataFrame:
    """Adds role, reason and property: what a numeric cell stands for. ``properties``: name to pattern, first match wins."""
    heads = F.lower(F.concat_ws(" ", F.array_join("column_headers", " "), F.array_join("row_headers", " ")))
    columns = F.lower(F.array_join("column_headers", " "))
    name = F.coalesce(*[F.when(heads.rlike(p), F.lit(n)) for n, p in properties.items()])
    text = F.col("text")
    # what is used more than once is a column of its own, so that it is computed once
    told = context.withColumns({"__value": is_value_like(text), "__name": name})
    value, name = F.col("__value"), F.col("__name")
    role = F.when(looks_like_identifier(text), "identifier").when(~value, "unknown").when(columns.rlike(conditions), "condition").when(name.isNotNull(), "property").otherwise("unknown")
    reason = F.when(F.col("role") == "identifier", "looks_like_identifier").when(F.col("role") == "condition", "condition_header").when(F.col("role") == "property", "header_pattern").when(~value, "not_value_like").otherwise("no_header_match")
    return told.withColumn("role", role).withColumns({"reason": reason, "property": F.when(F.col("role") == "property", name)}).drop("__value", "__name")


def recall_audit(classified: DataFrame, covered: DataFrame, threshold: float = 0.8) -> DataFrame:
    """For each table numeric cells, property candidates, covered ones (block_id, cell_id in covered), shares, and whether it needs recovery.

    Both sides meet by their table in one shuffle: a group of a cell's rows stays within the partition of its table.
    """
    asked = classified.select("block_id", "cell_id", (F.col("role") == "property").alias("wanted"), F.lit(1).alias("asked"))
    told = covered.select("block_id", "cell_id", F.lit(None).cast("boolean").alias("wanted"), F.lit(0).alias("asked"))
    met = asked.union(told).repartition("block_id").groupBy("block_id", "cell_id").agg(F.sum("asked").alias("n"), F.count_if("wanted").alias("wanted"), F.bool_or(F.col("asked") == 0).alias("hit")).where("n > 0")
    rows = met.groupBy("block_id").agg(
        F.sum("n").alias("numeric_cells"), F.sum(F.when(F.col("hit"), F.col("n")).otherwise(0)).alias("represented"), F.sum("wanted").alias("candidates"), F.sum(F.when(F.col("hit"), F.col("wanted")).otherwise(0)).alias("covered"),
        F.array_sort(F.flatten(F.collect_list(F.when(~F.col("hit") & (F.col("wanted") > 0), F.array_repeat("cell_id", F.col("wanted").cast("int")))))).alias("missing"),
    )
    share = ratio(F.col("covered"), F.col("candidates"), "audit")
    return rows.select("*", ratio(F.col("represented"), F.col("numeric_cells"), "audit").alias("representation"), share.alias("coverage"), F.coalesce(share < threshold, F.lit(False)).alias("needs_recovery"))


def batch_audit(audits: DataFrame) -> DataFrame:
    """Sums over tables and micro-averaged shares."""
    sums = audits.agg(F.count("*").alias("tables"), *[F.sum(c).alias(c) for c in ("numeric_cells", "represented", "candidates", "covered")])
    return sums.select("*", ratio(F.col("represented"), F.col("numeric_cells"), "audit").alias("representation"), ratio(F.col("covered"), F.col("candidates"), "audit").alias("coverage"))


def resolve_locator(cells: DataFrame, locators: DataFrame) -> DataFrame:
    """locator_id, cell_id, status for (locator_id, block_id, row_label, column_label, cell_value).

    Cells score 2 for a label in their row and 2 for one above their column; the value must match, and only
    one best cell is an answer.
    """
    key = evidence_key
    at = locators.join(cells, "block_id").where(key(F.col("text")) == key(F.col("cell_value")))
    labels = cells.select("block_id", F.col("row_index").alias("y"), F.col("column_index").alias("x"), F.col("column_span").alias("w"), F.col("row_span").alias("h"), key(F.col("text")).alias("label"))
    met = at.join(labels, "block_id").withColumn("by_row", (F.col("label") == key(F.col("row_label"))) & F.expr("row_index >= y AND row_index < y + h AND x <> column_index"))
    met = met.withColumn("by_column", (F.col("label") == key(F.col("column_label"))) & F.expr("column_index >= x AND column_index < x + w AND y < row_index"))
    scored = met.groupBy("locator_id", "cell_id").agg((F.max(F.col("by_row").cast("int")) * 2 + F.max(F.col("by_column").cast("int")) * 2).alias("score"))
    best = scored.withColumn("rank", F.rank().over(Window.partitionBy("locator_id").orderBy(F.desc("score")))).where("rank = 1")
    one = best.groupBy("locator_id").agg(F.count("*").alias("n"), F.min("cell_id").alias("id"))
    status = F.when(F.col("n") == 1, "matched").when(F.col("n") > 1, "ambiguous").otherwise("unresolved")
    return locators.select("locator_id").join(one, "locator_id", "left").select("locator_id", F.when(F.col("n") == 1, F.col("id")).alias("cell_id"), status.alias("status"))


def fill_up(cells: DataFrame) -> DataFrame:
    """cells with label: a blank cell's text is the nearest above it in its column."""
    w = Window.partitionBy("block_id", "column_index").orderBy("row_index").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return cells.withColumn("label", F.last(F.nullif(F.trim("text"), F.lit("")), ignorenulls=True).over(w))


def numeric_columns(cells: DataFrame) -> Column:
    """Share of a column's filled cells that hold a number; an aggregate."""
    return F.count_if(has_number(F.col("text"))) / F.nullif(F.count_if(F.col("text") != ""), F.lit(0))
