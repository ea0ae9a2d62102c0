"""Landed API pages (S11-S13) and the JSON-array writer used by landing.

A page payload is a bare list, ``{"data": [...], "hasMore": ..,
"continueFrom": ..}`` or a report page of positional rows.  Each page is one
row; unwrapping is an ``explode`` over the parsed variant, so pages of one
endpoint spread over all tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def page_items(payload: Column) -> Column:
    """The items of a page: the list itself, or its ``data`` array."""
    v = F.try_parse_json(payload)
    kind = F.schema_of_variant(v)
    return F.when(kind.startswith("ARRAY"), F.try_variant_get(v, "$", "array<variant>")) \
        .otherwise(F.try_variant_get(v, "$.data", "array<variant>"))


def unwrap_pages(pages: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per item with its position in the page; empty pages
    yield nothing (the puller stops on them)."""
    keep = [c for c in pages.columns if c != payload]
    return pages.select(*keep, F.posexplode(page_items(F.col(payload))).alias("item_pos", "item"))


def zip_report_row(row: Column, field_names: Column) -> Column:
    """Positional values + field names -> name->value map; extra values
    are ignored, missing ones are absent."""
    n = F.least(F.size(row), F.size(field_names))
    return F.map_from_arrays(F.slice(field_names, 1, n), F.slice(row, 1, n))


def report_rows(pages: DataFrame, field_names: list[str], types: dict[str, str],
                report_date: Column, payload: str = "payload") -> DataFrame:
    """S12 over report pages: one row per positional row, columns typed by
    the catalog's field list, ``_report_date`` injected."""
    keep = [c for c in pages.columns if c != payload]
    rows = pages.select(*keep, F.explode(F.try_variant_get(
        F.try_parse_json(F.col(payload)), "$.data", "array<array<variant>>")).alias("r"))
    names = F.array(*[F.lit(n) for n in field_names])
    m = zip_report_row(F.col("r"), names)
    cols = [F.try_variant_get(F.try_element_at(m, F.lit(n)), "$", types.get(n, "string")).alias(n)
            for n in field_names]
    return rows.select(*keep, *cols, report_date.alias("_report_date"))


def export_cursor(pages: DataFrame, by: list[str], seq: str = "page_seq",
                  payload: str = "payload") -> DataFrame:
    """Items fetched and the last continuation token per endpoint
    (kept in a cursor table, unlike the source which drops it)."""
    v = F.try_parse_json(F.col(payload))
    n = F.coalesce(F.size(page_items(F.col(payload))), F.lit(0))
    token = F.try_variant_get(v, "$.continueFrom", "string")
    return (pages.select(*by, seq, n.alias("n"), token.alias("token"))
            .groupBy(*by).agg(F.sum("n").cast("bigint").alias("n_items"),
                              F.max_by("token", seq).alias("last_token")))


CURSORS = "_cursors"


def save_cursors(cursors: DataFrame, root: str, version: int) -> None:
    """Keep each endpoint's last continuation token (the source drops
    it) as the next version of the cursor table; a retry of the same
    version is a no-op."""
    from ledgerline.operators.publish import publish
    publish(cursors, root, CURSORS, version)


def read_cursors(spark, root: str) -> DataFrame | None:
    from ledgerline.operators.publish import read_published
    return read_published(spark, root, CURSORS)
