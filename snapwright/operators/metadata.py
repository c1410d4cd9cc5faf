"""Nested metadata columns to plain values, driven by the schema.

Three forms: wide columns where the keys are known from the schema, one map per row where they are not
(map fields have data-dependent keys), and long (key, value, value_type) entries.
Absent, NULL and empty values leave no trace; empty text is a value and stays.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapwright.functions.hhmm import iso_text

_JSON = {"ignoreNullFields": "false"}
_TIMES = (T.TimestampType, T.TimestampNTZType)


@dataclass(frozen=True)
class Leaf:
    """One plain value reached through structs; ``kind`` is the type of the value it stands for."""

    key: str
    value: Column
    kind: str


@dataclass(frozen=True)
class Dynamic:
    """A map reached through structs; each of its keys becomes ``prefix`` + key."""

    prefix: str
    value: Column
    data_type: T.MapType


def _plain(value: Column, data_type: T.DataType) -> tuple[Column, str]:
    """Value and kind of a non-struct, non-map type. Arrays become JSON text, times ISO text."""
    if isinstance(data_type, T.ArrayType):
        return F.when(F.size(value) > 0, F.to_json(value, _JSON)), "string"
    if isinstance(data_type, _TIMES):
        return iso_text(value), "string"
    if isinstance(data_type, T.BooleanType):
        return value, "bool"
    if isinstance(data_type, T.IntegralType):
        return value, "int"
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return value, "float"
    return value.cast("string"), "string"


def walk(data_type: T.StructType, prefix: str = "", parent: Column | None = None) -> list[Leaf | Dynamic]:
    """All leaves of a schema in field order; struct names are joined with ``_``."""
    found: list[Leaf | Dynamic] = []
    for field in data_type.fields:
        value = F.col(f"`{field.name}`") if parent is None else parent.getField(field.name)
        key = f"{prefix}{field.name}"
        if isinstance(field.dataType, T.StructType):
            found.extend(walk(field.dataType, f"{key}_", value))
        elif isinstance(field.dataType, T.MapType):
            found.append(Dynamic(f"{key}_", value, field.dataType))
        else:
            found.append(Leaf(key, *_plain(value, field.dataType)))
    return found


#: Most keys of one map field that become columns; the rest of a map stays together as JSON text.
MAP_COLUMNS = 1000


def _keys_of(df: DataFrame, value: Column) -> list[str]:
    """Distinct keys of a map column over all rows, in order, at most one more than ``MAP_COLUMNS``."""
    keys = df.select(F.explode(F.map_keys(value).cast("array<string>")).alias("key")).distinct()
    return [row["key"] for row in keys.orderBy("key").limit(MAP_COLUMNS + 1).collect()]


def flatten_wide(
    df: DataFrame, keep: Sequence[str] = (), map_keys: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """Plain columns, NULL where a value is absent. ``keep`` columns pass through unchanged.

    Every key of a map field becomes a column. Where ``map_keys`` names the keys (by flattened field name) those are
    taken; otherwise one pass over the data finds them. Keys beyond those named, or beyond ``MAP_COLUMNS``, are kept as
    JSON text in a column with the field's own name. Of two fields with the same flattened name the later one wins where
    it is present.
    """
    columns: dict[str, list[tuple[Column, str]]] = {}

    def add(item: Leaf | Dynamic) -> None:
        if isinstance(item, Leaf):
            columns.setdefault(item.key, []).append((item.value, item.kind))
            return
        field, inner = item.prefix[:-1], item.data_type.valueType
        named = (map_keys or {}).get(field)
        keys = list(named) if named is not None else _keys_of(df, item.value)
        for key in keys[:MAP_COLUMNS] if named is None else keys:
            value = item.value.getItem(F.lit(key).cast(item.data_type.keyType))
            if isinstance(inner, T.StructType):
                for nested in walk(inner, f"{item.prefix}{key}_", value):
                    add(nested)
            elif isinstance(inner, T.MapType):
                add(Dynamic(f"{item.prefix}{key}_", value, inner))
            else:
                columns.setdefault(item.prefix + key, []).append(_plain(value, inner))
        if named is not None or len(keys) > MAP_COLUMNS:
            rest = F.map_filter(item.value, lambda k, v: ~k.cast("string").isin(keys[:MAP_COLUMNS] if named is None else keys))
            columns.setdefault(field, []).append((F.when(F.size(rest) > 0, F.to_json(rest, _JSON)), "string"))

    for item in walk(T.StructType([f for f in df.schema.fields if f.name not in keep])):
        add(item)

    def chosen(values: list[tuple[Column, str]]) -> Column:
        if len({kind for _, kind in values}) > 1:
            values = [(value.cast("string"), "string") for value, _ in values]
        return F.coalesce(*[value for value, _ in reversed(values)])

    return df.select(*keep, *[chosen(values).alias(name) for name, values in columns.items()])


ENTRY = "struct<key:string,value:string,value_type:string>"


def _entry(key: Column, value: Column, kind: str) -> Column:
    return F.struct(key.alias("key"), value.cast("string").alias("value"), F.lit(kind).alias("value_type"))


def _map_entries(prefix: Column, value: Column, data_type: T.MapType) -> Column:
    """Entries of a map, or of the structs and maps inside it."""
    inner = data_type.valueType

    def entry(pair: Column) -> Column:
        key, item = F.concat(prefix, pair["key"].cast("string")), pair["value"]
        if isinstance(inner, T.StructType):
            return _entries(inner, item, F.concat(key, F.lit("_")))
        if isinstance(inner, T.MapType):
            return _map_entries(F.concat(key, F.lit("_")), item, inner)
        plain, kind = _plain(item, inner)
        return F.array(_entry(key, plain, kind))

    listed = F.flatten(F.transform(F.map_entries(value), entry))
    return F.coalesce(listed, F.array().cast(f"array<{ENTRY}>"))


def _entries(data_type: T.StructType, parent: Column | None, prefix: Column) -> Column:
    parts = []
    for item in walk(data_type, "", parent):
        if isinstance(item, Leaf):
            parts.append(F.array(_entry(F.concat(prefix, F.lit(item.key)), item.value, item.kind)))
        else:
            parts.append(_map_entries(F.concat(prefix, F.lit(item.prefix)), item.value, item.data_type))
    return F.concat(*parts)


def _may_collide(items: list[Leaf | Dynamic]) -> bool:
    """Whether two items of a schema could give the same flattened key."""
    fixed = [item.key for item in items if isinstance(item, Leaf)]
    prefixes = [item.prefix for item in items if isinstance(item, Dynamic)]
    if len(set(fixed)) < len(fixed):
        return True
    return any(
        name.startswith(prefix)
        for i, prefix in enumerate(prefixes)
        for name in fixed + prefixes[:i] + prefixes[i + 1 :]
    ) or any(_nests(item.data_type) for item in items if isinstance(item, Dynamic))


def _nests(data_type: T.MapType) -> bool:
    """Maps of maps or of structs: an inner key may spell out the same name as an outer one."""
    return isinstance(data_type.valueType, (T.MapType, T.StructType))


def metadata_entries(df: DataFrame, keep: Sequence[str] = (), out: str = "entries") -> DataFrame:
    """``keep`` columns plus an array of present (key, value, value_type); a later equal key wins."""
    schema = T.StructType([f for f in df.schema.fields if f.name not in keep])
    present = F.filter(_entries(schema, None, F.lit("")), lambda e: e["value"].isNotNull())
    if not _may_collide(walk(schema)):
        return df.select(*keep, present.alias(out))
    # Sorted by (key, place), an entry stays where the next one has another key; then back into the order of places.
    placed = F.array_sort(F.transform(present, lambda e, i: F.struct(e["key"].alias("key"), i.alias("place"), e.alias("entry"))))
    df = df.select(*keep, placed.alias("__placed"))
    following = F.concat(F.transform(F.slice("__placed", 2, F.size("__placed")), lambda z: z["key"]), F.array(F.lit(None).cast("string")))
    last = F.zip_with("__placed", following, lambda z, after: F.struct(z["place"].alias("place"), z["entry"].alias("entry"), (~z["key"].eqNullSafe(after)).alias("last")))
    kept = F.transform(F.array_sort(F.filter(last, lambda z: z["last"])), lambda z: z["entry"])
    return df.select(*keep, kept.alias(out))


def metadata_map(df: DataFrame, keep: Sequence[str] = (), out: str = "metadata") -> DataFrame:
    """``keep`` columns plus one map<string,string> per row holding only present keys."""
    pairs = F.transform("entries", lambda e: F.struct(e["key"], e["value"]))
    return metadata_entries(df, keep).select(*keep, F.map_from_entries(pairs).alias(out))


def metadata_long(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """One row per present key: ``keep`` columns, key, value, value_type."""
    return metadata_entries(df, keep).select(*keep, F.explode("entries").alias("e")).select(*keep, "e.*")


def _as_variant(value: Column, data_type: T.DataType) -> Column:
    """A value with plain leaves, map keys as text, ready to become a VARIANT object."""
    if isinstance(data_type, T.StructType):
        fields = [_as_variant(value.getField(f.name), f.dataType).alias(f.name) for f in data_type.fields]
        return F.struct(*fields)
    if isinstance(data_type, T.MapType):
        named = F.transform_keys(value, lambda k, _: k.cast("string"))
        return F.transform_values(named, lambda _, v: _as_variant(v, data_type.valueType))
    return _plain(value, data_type)[0]


def _depth(data_type: T.DataType) -> int:
    if isinstance(data_type, T.StructType):
        return 1 + max((_depth(f.dataType) for f in data_type.fields), default=0)
    return 1 + _depth(data_type.valueType) if isinstance(data_type, T.MapType) else 0


_KINDS = {"BOOLEAN": "bool", "BIGINT": "int", "FLOAT": "float", "DOUBLE": "float"}


def metadata_variant(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """One row per present key, as :func:`metadata_long`, by way of Spark's VARIANT: maps of any number of keys need no columns.

    Each level of nesting is one ``variant_explode``. Of fields whose flattened names are equal, all are given.
    """
    fields = [f for f in df.schema.fields if f.name not in keep]
    packed = F.struct(*[_as_variant(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in fields])
    view = df.select(*keep, F.lit(None).cast("string").alias("__key"), F.to_variant_object(packed).alias("__value"))
    kept = ", ".join(f"t.`{name}`" for name in keep)
    for _ in range(_depth(T.StructType(fields))):
        # What is plain already is wrapped, so that one explode serves all.
        view = df.sparkSession.sql(
            f"""select {kept}, case when t.__plain then t.__key else concat_ws('_', t.__key, z.key) end as __key, z.value as __value
from (select *, schema_of_variant(__value) not like 'OBJECT%' as __plain from {{view}} where not is_variant_null(__value)) t,
lateral variant_explode(case when t.__plain then to_variant_object(named_struct('', t.__value)) else t.__value end) z""",
            view=view,
        )
    kinds = F.create_map(*[F.lit(x) for pair in _KINDS.items() for x in pair])
    kind = F.coalesce(F.try_element_at(kinds, F.schema_of_variant("__value")), F.lit("string"))
    present = view.filter("not is_variant_null(__value) and schema_of_variant(__value) not like 'OBJECT%'")
    return present.select(*keep, F.col("__key").alias("key"), F.col("__value").cast("string").alias("value"), kind.alias("value_type"))


def _serialised(value: Column, data_type: T.DataType) -> Column:
    """Top-level value: structs, maps and arrays become JSON text.

    A struct is first put through this same rule field by field, so its own complex fields are JSON text
    inside the JSON text; it is absent when nothing is left of it.
    """
    if isinstance(data_type, T.StructType):
        fields = [_serialised(value.getField(f.name), f.dataType).alias(f.name) for f in data_type.fields]
        return F.nullif(F.to_json(F.struct(*fields)), F.lit("{}")) if fields else F.lit(None).cast("string")
    if isinstance(data_type, T.MapType):
        return F.when(F.size(value) > 0, F.to_json(value, _JSON))
    return _plain(value, data_type)[0]


def serialise(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One plain column per top-level field, without flattening."""
    fields = [f for f in df.schema.fields if f.name not in keep]
    return df.select(*keep, *[_serialised(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in fields])


def is_plain(schema: T.StructType) -> bool:
    """True when every column is text, a number or a boolean."""
    return all(isinstance(f.dataType, (T.StringType, T.BooleanType, T.NumericType)) for f in schema.fields)


def prepare_metadata(df: DataFrame, keep: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Wide columns and long entries of the same metadata."""
    wide = flatten_wide(df, keep)
    plain = T.StructType([f for f in wide.schema.fields if f.name not in keep])
    if not is_plain(plain):
        raise TypeError("metadata did not flatten to plain values")
    return wide, metadata_long(df, keep)
