r"""Tables in LaTeX and lists in JSON, as returned by page readers, parsed with built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.text import first_of, once, strip

ITEM = "array<struct<text:string,indent:int,is_subtotal:boolean,col1:string,col2:string,col3:string,col4:string,col5:string>>"
_TABULAR = r"(?s)\\begin\{tabular\}\{[^}]*\}(.*?)\\end\{tabular\}"


def tables(raw: Column) -> Column:
    """array<array<array<string>>>: tables, rows, cells."""
    bodies = F.regexp_extract_all(raw, F.lit(_TABULAR), 1)
    clean = lambda cell: strip(F.regexp_replace(F.regexp_replace(cell, r"\\(hline|textbf|textit|multicolumn\{\d+\}\{[^}]*\})", ""), r"[{}$]|\\(?=[&%$#])", ""))
    row = lambda r: F.transform(F.split(r, r"(?<!\\)&"), clean)
    return F.transform(bodies, lambda b: F.transform(F.filter(F.split(b, r"\\\\"), lambda r: strip(F.regexp_replace(r, r"\\hline", "")) != ""), row))


def header_slot(cell: Column) -> Column:
    """Which of the five amounts a header cell names, 0 to 4; null for none."""

    def slot(low: Column) -> Column:
        versus = low.contains("vs") | low.contains("compared")
        return first_of((versus & low.contains("enacted"), F.lit(3)), (versus & (low.contains("request") | low.contains("estimate")), F.lit(4)), (low.contains("enacted"), F.lit(0)), (low.contains("request") | low.contains("estimate"), F.lit(1)), (low.contains("bill") | low.contains("recommend"), F.lit(2)))

    return once(F.lower(cell), slot)


def is_comparative(table: Column) -> Column:
    """Its header names both an enacted and a bill column, and it is none of the summary tables."""
    names = once(F.transform(F.element_at(table, 1), header_slot), lambda head: F.array_contains(head, 0) & F.array_contains(head, 2))
    text = F.lower(F.array_join(F.flatten(table), " "))
    return names & ~text.rlike(r"302\s*\(b\)|budget authority|projection of outlays")


def table_items(table: Column) -> Column:
    """The rows of a comparative table as items; the last cells are the values, by the header's order."""
    # an expression is evaluated wherever it stands: the header is read once a table, the values are cut once a row
    header = F.filter(F.transform(F.element_at(table, 1), header_slot), lambda s: s.isNotNull())

    def item(row: Column, slots: Column) -> Column:
        cut = F.slice(row, F.greatest(F.size(row) - F.size(slots) + 1, F.lit(2)), F.size(slots))
        column = lambda values, n: F.nullif(F.get(values, F.array_position(slots, F.lit(n)).cast("int") - 1), F.lit(""))
        label = F.element_at(row, 1)
        return once(cut, lambda values: F.struct(label.alias("text"), F.lit(0).alias("indent"), F.coalesce(F.lower(label).rlike(r"^(sub)?total\b"), F.lit(False)).alias("is_subtotal"), *[column(values, n).alias(f"col{n + 1}") for n in range(5)]))

    return once(header, lambda slots: F.transform(F.slice(table, 2, F.greatest(F.size(table) - 1, F.lit(0))), lambda row: item(row, slots)))


def has_items(found: Column) -> Column:
    """Whether tables() has found a comparative table with a row below its header."""
    return F.coalesce(F.exists(found, lambda t: (F.size(t) > 1) & is_comparative(t)), F.lit(False))


def comparative_items(raw: Column) -> Column:
    return F.flatten(F.transform(F.filter(tables(raw), is_comparative), table_items)).cast(ITEM)


def single_column_items(raw: Column) -> Column:
    """Rows of two-column tables whose value has a digit; the value is the recommendation."""
    rows = F.flatten(F.filter(tables(raw), lambda t: F.forall(t, lambda r: F.size(r) == 2)))
    none = F.lit(None).cast("string")
    item = lambda r: F.struct(r[0].alias("text"), F.lit(0).alias("indent"), F.coalesce(F.lower(r[0]).rlike(r"^(sub)?total\b"), F.lit(False)).alias("is_subtotal"), none.alias("col1"), none.alias("col2"), r[1].alias("col3"), none.alias("col4"), none.alias("col5"))
    return F.transform(F.filter(rows, lambda r: r[1].rlike(r"\d")), item).cast(ITEM)


def json_items(raw: Column) -> Column:
    """A JSON list, also in a code fence; anything else gives no items."""
    body = F.regexp_extract(raw, r"(?s)^\s*(?:```(?:json)?\s*)?(.*?)(?:```)?\s*$", 1)
    return F.coalesce(F.from_json(body, ITEM), F.array().cast(ITEM))
