"""Normalisation of landed objects.

Records are parsed once into ``obj: map<string, variant>``, which keeps
every key in source order, duplicates included (H4).  A single aggregate
over **all** records (A11, not a sample) decides each output column's
source keys and type; the driver then builds one projection from that
small result, so the data is walked once and the schema once.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.names import snake, snake_col
from ledgerline.functions.values import NUMERIC, coerce_to
from ledgerline.sources.landing import one_object, one_object_array, recovered_key

NUMBER_KINDS = ("BIGINT", "DOUBLE", "BOOLEAN", "FLOAT", "INT", "SMALLINT", "TINYINT")


def _kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def _is_number_kind(kind: Column) -> Column:
    return kind.isin(*NUMBER_KINDS) | kind.startswith("DECIMAL")


def _as_text(v: Column) -> Column:
    return F.try_variant_get(v, "$", "string")


# --------------------------------------------------------------------- A11
def probe(parsed: DataFrame, obj: str = "obj") -> DataFrame:
    """A11 + C1: per source key, what its values look like over all rows.

    saw_number: a number, a bool (finding 6) or numeric-looking text;
    saw_text: non-blank text that is not numeric; saw_list: an array;
    variant_type: ``schema_of_variant_agg`` of the non-null values.
    The exploded (key, value) rows are combined map-side per key.
    """
    e = parsed.select(F.explode(F.map_entries(F.col(obj))).alias("e")).select(
        F.col("e.key").alias("k"), F.col("e.value").alias("v"))
    # The kind of a value, and its text if it is one, are taken once.
    e = e.withColumn("kind", _kind(F.col("v"))).withColumn("t", F.when(F.col("kind") == "STRING", _as_text(F.col("v"))))
    k, v, kind, txt = F.col("k"), F.col("v"), F.col("kind"), F.col("t")
    numeric_text = (kind == "STRING") & F.coalesce(txt.rlike(NUMERIC), F.lit(False))
    rows = e.select(
        k.alias("source_key"),
        (_is_number_kind(kind) | numeric_text).alias("num"),
        ((kind == "STRING") & (F.trim(txt) != "") & ~numeric_text).alias("txt"),
        kind.startswith("ARRAY").alias("lst"),
        kind.startswith("OBJECT").alias("obj"),
        F.when(kind != "VOID", v).alias("v"),
        # the value as it will look once repaired as a list (an object is
        # wrapped): gives the element type of list columns
        F.when(kind.startswith("ARRAY"), v)
        .when(kind.startswith("OBJECT") & (kind != "OBJECT<>"),
              F.to_variant_object(F.array(v))).alias("as_list"))
    return (rows.groupBy("source_key")
            .agg(F.bool_or("num").alias("saw_number"), F.bool_or("txt").alias("saw_text"),
                 F.bool_or("lst").alias("saw_list"), F.bool_or("obj").alias("saw_object"),
                 F.schema_of_variant_agg("v").alias("variant_type"),
                 F.schema_of_variant_agg("as_list").alias("list_type"),
                 F.count(F.lit(1)).alias("n_present"))
            .withColumn("column_name", snake_col(F.col("source_key"))))


# More distinct keys than this are data, not names (ids as object keys).
OPEN_KEYS = 1000
REST = "_other_fields"


@dataclass
class ColumnPlan:
    name: str
    source_keys: list[str]
    kind: str            # "array", "text", "bigint", "double", "boolean", "string", "variant"
    mixed: bool = False
    coerce: str | None = None
    struct_type: T.StructType | None = None
    known_arrays: frozenset = frozenset()


@dataclass
class NormalizePlan:
    """The columns, and with ``rest`` one map of all other keys (``REST``)."""
    columns: list[ColumnPlan] = field(default_factory=list)
    rest: bool = False

    def names(self) -> list[str]:
        return [c.name for c in self.columns] + ([REST] if self.rest else [])


def _spark_kind(variant_type: str | None) -> str:
    t = (variant_type or "VOID").upper()
    if t in ("BIGINT", "INT", "SMALLINT", "TINYINT"):
        return "bigint"
    if t in ("DOUBLE", "FLOAT") or t.startswith("DECIMAL"):
        return "double"
    if t == "BOOLEAN":
        return "boolean"
    if t == "STRING":
        return "string"
    if t.startswith("TIMESTAMP") or t == "DATE":
        return "string"
    return "variant"


def plan_from_probe(probe_rows: list, *, array_fields: set[str] | None = None,
                    stringify: set[str] | None = None, type_map: dict[str, str] | None = None
                    ) -> NormalizePlan:
    """Driver-side: one ColumnPlan per snake-cased name (P1), from the
    collected probe (one row per distinct key, i.e. schema-sized)."""
    array_fields = set(array_fields or ())
    stringify = set(stringify or ())
    type_map = {snake(k): v for k, v in (type_map or {}).items()}
    by_name: dict[str, dict] = {}
    for r in probe_rows:
        d = by_name.setdefault(r["column_name"], {"keys": [], "num": False, "txt": False,
                                                  "lst": False, "obj": False, "types": set(), "list_types": set()})
        d["list_types"].add(r["list_type"] if "list_type" in r.asDict() else None)
        d["keys"].append(r["source_key"])
        d["num"] |= bool(r["saw_number"])
        d["txt"] |= bool(r["saw_text"])
        d["lst"] |= bool(r["saw_list"])
        d["obj"] |= bool(r["saw_object"])
        d["types"].add(r["variant_type"])
    plan = NormalizePlan()
    for name in sorted(by_name):
        d = by_name[name]
        keys = sorted(d["keys"])
        if (d["lst"] or name in array_fields) and name not in stringify:
            lt = {t for t in d["list_types"] if t and t != "VOID"}
            elem = None
            if len(lt) == 1:
                m = re.fullmatch(r"ARRAY<(OBJECT<.*>)>", lt.pop())
                elem = object_struct_type(m.group(1)) if m else None
            # Elements of one plain type hold nothing to repair.
            mixed = elem is None and any("VARIANT" in t or "OBJECT" in t for t in d["list_types"] if t)
            plan.columns.append(ColumnPlan(name, keys, "array", mixed=mixed, struct_type=elem))
            continue
        mixed = d["num"] and d["txt"]
        if mixed or name in stringify:
            plan.columns.append(ColumnPlan(name, keys, "text", mixed=mixed))
            continue
        types = {t for t in d["types"] if t and t != "VOID"}
        st = object_struct_type(types.pop()) if len(types) == 1 and next(iter(types)).startswith("OBJECT") \
            else None
        if st is not None:
            plan.columns.append(ColumnPlan(name, keys, "struct", struct_type=st))
            continue
        kinds = {_spark_kind(t) for t in d["types"] if t and t != "VOID"}
        if kinds == {"bigint", "double"}:
            kinds = {"double"}
        if (len(kinds) > 1 or kinds == {"variant"}) and not d["obj"]:
            # scalars of several kinds, such as numbers and texts that look
            # like numbers: text holds all
            plan.columns.append(ColumnPlan(name, keys, "text", mixed=True))
            continue
        kind = kinds.pop() if len(kinds) == 1 else ("variant" if kinds else "string")
        plan.columns.append(ColumnPlan(name, keys, kind, coerce=type_map.get(name)))
    # A known array that no record has is there all the same, empty.
    have = set(plan.names())
    plan.columns += [ColumnPlan(name, [], "array") for name in sorted(array_fields) if name not in have and "." not in name]
    plan.columns.sort(key=lambda c: c.name)
    known = frozenset(c.name for c in plan.columns if c.kind == "array") | frozenset(array_fields)
    for c in plan.columns:
        c.known_arrays = known
    return plan


def object_struct_type(variant_type: str) -> T.StructType | None:
    """The merged ``OBJECT<...>`` of a key as a Spark struct (names keep
    their case; decimals become doubles, JSON nulls text)."""
    ddl = re.sub(r"(^|[<\s,])OBJECT<", r"\1STRUCT<", variant_type)
    ddl = re.sub(r"(^|[<\s,:])VOID(?=[,>\s]|$)", r"\1STRING", ddl)
    ddl = re.sub(r"DECIMAL\(\d+,\d+\)", "DOUBLE", ddl)
    try:
        dt = T._parse_datatype_string(ddl)
    except Exception:
        return None
    return dt if isinstance(dt, T.StructType) else None


# ------------------------------------------------------------- P2 / N1-N3
def last_present(obj: Column, keys: list[str]) -> Column:
    """Value of the last entry whose key is one of ``keys`` (last wins,
    even when that value is JSON null); null when none is present."""
    hits = F.filter(F.map_entries(obj), lambda e: e["key"].isin(*keys))
    return F.try_element_at(hits, F.lit(-1))["value"]


def fix_array(v: Column, kind: Column | None = None) -> Column:
    """N1-N3 for one known array field (``kind``: its variant type, if known).

    null / absent / JSON null / ``{}`` -> ``[]``; an object -> ``[object]``;
    inside an array: empty inner arrays dropped, other inner arrays turned
    into their JSON text; a scalar -> ``[scalar]``.
    """
    kind = _kind(v) if kind is None else kind
    arr = F.try_variant_get(v, "$", "array<variant>")
    inner = F.filter(arr, lambda x: ~(_kind(x).startswith("ARRAY") & (
        F.size(F.try_variant_get(x, "$", "array<variant>")) == 0)))
    inner = F.transform(inner, lambda x: F.when(
        _kind(x).startswith("ARRAY"), F.to_json(x).cast("variant")).otherwise(x))
    empty = F.array().cast("array<variant>")
    return (F.when(v.isNull() | (kind == "VOID") | (kind == "OBJECT<>"), empty)
            .when(kind.startswith("OBJECT"), F.array(v))
            .when(kind.startswith("ARRAY"), inner)
            .otherwise(F.array(v)))


# Objects and lists below an element of a mixed list that are repaired.
MIXED_DEPTH = 3


def _fixed_list(v: Column, known: frozenset, depth: int) -> Column:
    return F.transform(fix_array(v), lambda x: repair_variant(x, known, depth))


def repair_variant(v: Column, known: frozenset, depth: int = MIXED_DEPTH) -> Column:
    """N1-N4 for a value without a merged schema (an element of a list that
    mixes objects with other values): known array fields and lists at any
    place down to ``depth`` levels are repaired, names and other values stay."""
    if not depth:
        return v
    kind = _kind(v)

    def field(k: Column, x: Column) -> Column:
        below = repair_variant(x, known, depth - 1)
        return F.when(snake_col(k).isin(*sorted(known)), F.to_variant_object(_fixed_list(x, known, depth - 1))).otherwise(below)

    fields = F.to_variant_object(F.transform_values(F.try_variant_get(v, "$", "map<string,variant>"), field))
    return (F.when(kind.startswith("OBJECT") & (kind != "OBJECT<>"), fields)
            .when(kind.startswith("ARRAY"), F.to_variant_object(_fixed_list(v, known, depth - 1))).otherwise(v))


# All up to the next separator of compact JSON, strings taken whole.
_TO_SEPARATOR = r'((?:[^",:]++|"(?:[^"\\]++|\\.)*+")*+)([,:])'


def spaced_json(compact: Column) -> Column:
    """Compact JSON text with a space behind each comma and colon, as the
    source's own serialiser writes it."""
    return F.regexp_replace(compact, _TO_SEPARATOR, "$1$2 ")


def stringify_value(v: Column, mode: str = "plain", own: Column | None = None) -> Column:
    """Text of a value.  ``json`` mode: the JSON text (strings gain
    quotes); ``plain`` (default): strings as they are, other values as JSON
    text.  JSON null stays null.  ``own`` is the value's text in the record:
    with it, ``json`` mode keeps the order of keys and the form of numbers."""
    kind = _kind(v)
    js = F.to_json(v)
    if mode == "json":
        js = js if own is None else F.when(kind == "STRING", js).otherwise(spaced_json(own))
        return F.when(kind != "VOID", js)
    return F.when(kind == "STRING", _as_text(v)).when(kind != "VOID", js)


def normalize(parsed: DataFrame, plan: NormalizePlan, *, obj: str = "obj",
              keep: list[str] | None = None, stringify_mode: str = "plain") -> DataFrame:
    return normalized_select(parsed, plan, obj=obj, keep=keep, stringify_mode=stringify_mode)


def normalized_select(parsed: DataFrame, plan: NormalizePlan, *, obj: str = "obj",
                      keep: list[str] | None = None, stringify_mode: str = "plain",
                      value: str = "value") -> DataFrame:
    """P1-P5 + N1-N4 in one pass over the rows.

    The record text is parsed once more against a struct whose fields are
    the discovered source keys (as VARIANT): the JSON reader fills fields by
    name in one go, the last duplicate key wins, an absent key stays SQL
    NULL while a present JSON null does not, and the bracket-wrapped parse
    is strict (``is_bad``).  The struct is cast to positional field names,
    so keys differing only in case never clash.  Only a column fed by two
    different source keys (a naming collision, P2) needs key order; it alone
    reads the ordered entry list.  Stacked projections keep each costly
    piece computed once per row.
    """
    keep = list(keep or [])
    src = sorted({k for cp in plan.columns for k in cp.source_keys})
    multi = [cp for cp in plan.columns if len(cp.source_keys) > 1]
    if plan.rest and REST not in keep:
        parsed = parsed.withColumn(REST, other_fields(src, obj))
        out = normalized_select(parsed, NormalizePlan(plan.columns), obj=obj, keep=[*keep, REST], stringify_mode=stringify_mode, value=value)
        return out.select(*keep, *plan.names())
    if value not in parsed.columns or not src:
        return _normalized_from_entries(parsed, plan, obj=obj, keep=keep, stringify_mode=stringify_mode)
    idx = {k: i for i, k in enumerate(src)}
    # a key feeding one plain-typed column is parsed straight into that type
    # (mixed-type text keeps the source's own text); others stay VARIANT
    key_type = {k: T.VariantType() for k in src}
    for cp in plan.columns:
        if len(cp.source_keys) == 1 and _direct_type(cp) is not None and not (cp.kind == "text" and stringify_mode == "json"):
            key_type[cp.source_keys[0]] = _direct_type(cp)
    st = T.StructType([T.StructField(k, key_type[k]) for k in src])
    pos = T.StructType([T.StructField(f"f{i}", key_type[k]) for i, k in enumerate(src)])
    arr = one_object_array(F.col(value), st)
    base_keep = [c for c in keep if c != "is_bad"]
    extra = [F.map_entries(F.col(obj)).alias("__entries")] if multi else []
    texts = [i for i, cp in enumerate(plan.columns) if cp.kind == "text"] if stringify_mode == "json" else []
    if texts:  # the values' own texts
        extra.append(F.map_entries(F.from_json(F.col(value), "map<string,string>")).alias("__own"))
    staged = parsed.select(*base_keep, arr.alias("__arr"), F.col(value).alias("__text"), *extra)
    rec = one_object(F.col("__arr"), F.col("__text")).cast(pos)
    staged = staged.select(*base_keep, rec.alias("__rec"), *(["__entries"] if multi else []), *(["__own"] if texts else []))
    picks = []
    for i, cp in enumerate(plan.columns):
        if not cp.source_keys:
            v = F.lit(None).cast("variant")
        elif len(cp.source_keys) == 1:
            v = F.col("__rec")[f"f{idx[cp.source_keys[0]]}"]
        else:
            hits = F.filter(F.col("__entries"), _key_in(cp.source_keys))
            v = F.try_element_at(hits, F.lit(-1))["value"]
        picks.append(v.alias(f"__v{i}"))
        if i in texts:
            picks.append(F.try_element_at(F.filter("__own", _key_in(cp.source_keys)), F.lit(-1))["value"].alias(f"__t{i}"))
    bad = [F.col("__rec").isNull().alias("is_bad")] if "is_bad" in keep else []
    staged = staged.select(*base_keep, *bad, *picks)
    direct = {i for i, cp in enumerate(plan.columns)
              if len(cp.source_keys) == 1 and _direct_type(cp) is not None
              and not (cp.kind == "text" and stringify_mode == "json")}
    return _typed_select(staged, plan, keep, stringify_mode, direct)


def _direct_type(cp: ColumnPlan) -> T.DataType | None:
    if cp.coerce:
        return None
    return {"bigint": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType(),
            "string": T.StringType(), "text": T.StringType()}.get(cp.kind)


def _normalized_from_entries(parsed: DataFrame, plan: NormalizePlan, *, obj: str, keep: list[str],
                             stringify_mode: str) -> DataFrame:
    """Fallback without the record text: pick each column from the ordered
    entry list of the parsed map."""
    picks = [last_present(F.col(obj), cp.source_keys).alias(f"__v{i}") for i, cp in enumerate(plan.columns)]
    staged = parsed.select(*keep, *picks)
    return _typed_select(staged, plan, keep, stringify_mode)


def _typed_select(staged: DataFrame, plan: NormalizePlan, keep: list[str], stringify_mode: str,
                  direct: set[int] | None = None) -> DataFrame:
    """Repair the VARIANT picks (``direct`` ones are already typed)."""
    direct = direct or set()
    staged = staged.select(*keep, *[c for i in range(len(plan.columns))
                                    for c in ((F.col(f"__v{i}"),) if i in direct else
                                              (F.col(f"__v{i}"),
                                               F.schema_of_variant(F.col(f"__v{i}")).alias(f"__k{i}")))],
                           *[c for c in staged.columns if c.startswith("__t")])
    cols = [(F.col(f"__v{i}") if i in direct else
             _typed(F.col(f"__v{i}"), F.col(f"__k{i}"), cp, stringify_mode,
                    F.col(f"__t{i}") if f"__t{i}" in staged.columns else None)).alias(cp.name)
            for i, cp in enumerate(plan.columns)]
    return staged.select(*keep, *cols)


def _coerce_type(expected: str) -> str:
    from ledgerline.functions.values import BOOL_TYPES, FLOAT_TYPES, INT_TYPES
    e = expected.upper()
    return "bigint" if e in INT_TYPES else "double" if e in FLOAT_TYPES else \
        "boolean" if e in BOOL_TYPES else "string"


def _key_in(keys: list[str]):
    return lambda e: e["key"].isin(*keys)


def _typed(v: Column, kind: Column, cp: ColumnPlan, stringify_mode: str, own: Column | None = None) -> Column:
    """Column repair given the picked value and its precomputed kind."""
    if cp.kind == "array":
        fixed = fix_array(v, kind)
        if cp.struct_type is not None:   # every element is an object: N4 into the elements
            return F.transform(fixed, _repair_each(cp.struct_type, cp.known_arrays))
        if cp.mixed:     # objects among other values
            return F.transform(fixed, lambda x: repair_variant(x, cp.known_arrays))
        return fixed
    if cp.kind == "text":
        return stringify_value(v, stringify_mode, own)
    if cp.coerce:   # P5: the column takes the expected type
        s = _as_text(v)
        target = _coerce_type(cp.coerce)
        return (F.when((kind == "STRING") & (s != ""), coerce_to(s, cp.coerce).cast(target))
                .otherwise(F.try_variant_get(v, "$", target)))
    if cp.kind == "variant":
        return F.when(kind != "VOID", v)
    if cp.kind == "struct":
        return repair_struct(v, cp.struct_type, cp.known_arrays)
    return F.try_variant_get(v, "$", cp.kind)


def _field(v: Column, name: str) -> Column:
    return F.try_variant_get(v, "$['" + name.replace("'", "\\'") + "']", "variant")


def _array_of_arrays_text(v: Column) -> Column:
    """N3 for a list that holds lists: empty inner lists dropped, the
    others turned into their JSON text."""
    arr = F.try_variant_get(v, "$", "array<variant>")
    keep = F.filter(arr, lambda x: F.size(F.try_variant_get(x, "$", "array<variant>")) != 0)
    return F.transform(keep, lambda x: F.to_json(x))


def _repair_each(et: T.StructType, known: frozenset):
    return lambda x: repair_struct(x, et, known)


def repair_struct(v: Column, st: T.StructType, known: frozenset) -> Column:
    """N1-N4 below the top level, driven by the merged schema (walked once).

    A field whose snake-cased name is a known array field is repaired as
    one (null / ``{}`` -> ``[]``, object -> ``[object]``); nested objects
    recurse; lists of lists become lists of JSON text; other leaves are read
    with their merged type.  A null or non-object value gives null.
    """
    parts = []
    for f in st.fields:
        fv = _field(v, f.name)
        dt = f.dataType
        if snake(f.name) in known:
            val = fix_array(fv)
        elif isinstance(dt, T.StructType):
            val = repair_struct(fv, dt, known)
        elif isinstance(dt, T.ArrayType) and isinstance(dt.elementType, T.StructType):
            val = F.transform(F.try_variant_get(fv, "$", "array<variant>"),
                              _repair_each(dt.elementType, known))
        elif isinstance(dt, T.ArrayType) and isinstance(dt.elementType, T.ArrayType):
            val = _array_of_arrays_text(fv)
        elif isinstance(dt, T.VariantType):
            val = F.when(_kind(fv) != "VOID", fv)
        else:
            val = F.try_variant_get(fv, "$", dt.simpleString())
        parts.append(val.alias(f.name))
    return F.when(_kind(v).startswith("OBJECT"), F.struct(*parts))


def stage_landed(parsed: DataFrame, plan: NormalizePlan, path: str, *, keep: list[str] | None = None,
                 stringify_mode: str = "plain", append: bool = False, recover: list[str] | None = None) -> None:
    """Normalise every landed record once and write the staging table
    (truncate; ``append=True`` adds to it instead, S16).

    Bad records are not filtered out before the write (a pushed-down filter
    would re-run the parse); they keep ``is_bad`` and a 200-character
    preview.  Reading the table back (``read_staging``) cuts the lineage
    for the merge, whose join, null-key and tenant branches all read it.
    ``recover`` names the keys whose value is taken from a bad record's text
    where that can be trusted (``landing.recovered_key``), as ``__key``.
    """
    keep = list(keep or [])
    df = normalized_select(parsed, plan, keep=keep + ["is_bad", "value"], stringify_mode=stringify_mode)
    out = df.select(*keep, *plan.names(), "is_bad",
                    F.when(F.col("is_bad"), F.substring("value", 1, 200)).alias("__preview"),
                    *([F.when(F.col("is_bad"), recovered_key(F.col("value"), recover)).alias("__key")] if recover else []))
    out.write.mode("append" if append else "overwrite").parquet(path)   # S16 / S15


def infer_plan(parsed: DataFrame, declared: list[str] | None = None, obj: str = "obj", **kw) -> NormalizePlan:
    """C1 end to end: the probe aggregate, collected, planned.

    The probe has one row per distinct top-level key, which is schema-sized
    unless a feed uses data as keys (ids as object keys).  Beyond OPEN_KEYS
    keys, only those become columns that a thousandth (one in OPEN_KEYS) of
    the records has, and all others go to one ``map<string,variant>`` column:
    so there are at most OPEN_KEYS times as many columns as an average record
    has keys, whatever the data, and no entry is lost.  The counts stay in
    Spark until they are filtered.

    Where the ``declared`` columns are known (of a registry or the target),
    only their keys become columns, and ``undeclared`` gives the others.
    """
    if declared is not None:
        parsed = parsed.select(F.map_filter(obj, lambda k, _: snake_col(k).isin(*declared)).alias(obj))
        return plan_from_probe(probe(parsed, obj).collect(), **kw)
    found = probe(parsed, obj)
    rows = found.limit(OPEN_KEYS + 1).collect()
    if len(rows) <= OPEN_KEYS:
        return plan_from_probe(rows, **kw)
    records = parsed.count()   # malformed ones too: no parse is needed to count
    plan = plan_from_probe(found.where(F.col("n_present") * OPEN_KEYS >= records).collect(), **kw)
    plan.rest = True
    return plan


def other_fields(keys: list[str], obj: str = "obj") -> Column:
    """The entries of a record with other keys than ``keys``; null if there
    are none."""
    rest = F.map_filter(obj, lambda k, _: ~k.isin(*keys))
    return F.when(F.size(rest) > 0, rest)


def undeclared(declared: list[str], obj: str = "obj") -> Column:
    """The entries of a record whose keys are none of the declared columns,
    as one ``map<string,variant>``; null if there are none."""
    rest = F.map_filter(obj, lambda k, _: ~snake_col(k).isin(*declared))
    return F.when(F.size(rest) > 0, rest)
