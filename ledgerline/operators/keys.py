"""Surrogate keys (P9) and the duplicate-source-key guard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.values import json_text


def surrogate_key_col(cols: list[str]) -> Column:
    """``hex(md5(concat of coalesce(cast(pk as string), '') joined by '|')))``.

    Spark's ``md5`` already returns lower-case hex text.
    """
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]
    return F.md5(F.concat_ws("|", *parts))


def with_surrogate_key(df: DataFrame, cols: list[str], name: str = "id") -> DataFrame:
    return df.withColumn(name, surrogate_key_col(cols))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once in a source, with their copy count.

    A partial+final aggregate: a key holding a third of all rows is combined
    map-side before the shuffle, so no task receives its rows.
    """
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_copies"))
            .where(F.col("n_copies") > 1))


def comparable(c: Column, kind: T.DataType) -> Column:
    """The column itself, or its JSON text where its type has no order."""
    return json_text(F.struct(c.alias("v"))) if "variant" in kind.simpleString() or "map<" in kind.simpleString() else c


def latest_per_key(df: DataFrame, keys: list[str], order_cols: list[str]) -> DataFrame:
    """Keep the newest row per key (T1 micro-batches, optional W9 repair).

    ``max_by`` over a struct is an aggregate with a partial step, so a hot
    key is reduced map-side instead of sorting its rows in one task (a
    ``row_number`` window would).  Ties on the order columns are broken by
    the row's remaining columns, so the result is deterministic.
    """
    rest = [c for c in df.columns if c not in keys]
    kinds = {f.name: f.dataType for f in df.schema.fields}
    order = F.struct(*[comparable(F.col(c), kinds[c]).alias(f"o{i}") for i, c in enumerate([*order_cols, *rest])])
    picked = (df.groupBy(*keys)
              .agg(F.max_by(F.struct(*[F.col(c) for c in rest]), order).alias("row__")))
    return picked.select(*keys, *[F.col("row__." + c).alias(c) for c in rest]).select(*df.columns)


def assert_unique_keys(df: DataFrame, keys: list[str], sample: int = 5) -> None:
    """W9 guard: raise with a few offending keys when a source holds the
    same key more than once (one partial+final aggregate)."""
    dups = duplicate_keys(df, keys).limit(sample).collect()
    if dups:
        raise ValueError(f"duplicate source keys {keys}: " + ", ".join(str(tuple(r)) for r in dups))
