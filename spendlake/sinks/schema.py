"""Differences between the schema of a table and of a batch, at any depth."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    ShortType,
    StructField,
    StructType,
    TimestampType,
)

_WHOLE = (ByteType, ShortType, IntegerType, LongType)
#: Decimal digits that hold every value of a whole-number type.
_DIGITS = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 19}


@dataclass
class SchemaChange:
    """Paths of fields, such as ``cost.currency`` or ``labels.element.key``."""

    added: tuple[str, ...] = ()
    removed: tuple[str, ...] = ()
    #: Types that grew and that old files are read with.
    widened: tuple[str, ...] = ()
    #: Types that old files have to be written anew for.
    rewritten: tuple[str, ...] = ()
    #: What the table then has.
    schema: StructType = field(default_factory=StructType)

    def __bool__(self) -> bool:
        return bool(self.added or self.removed or self.widened or self.rewritten)


def _readable(old: DataType, new: DataType) -> bool:
    """Do Parquet files with the old type read as the new one without loss?"""
    if isinstance(old, _WHOLE) and isinstance(new, _WHOLE):
        return _WHOLE.index(type(old)) < _WHOLE.index(type(new))
    if isinstance(old, DecimalType) and isinstance(new, DecimalType):
        grows = new.scale >= old.scale and new.precision - new.scale >= old.precision - old.scale
        return grows and old != new
    if isinstance(new, DoubleType):
        return isinstance(old, (FloatType, *_WHOLE[:3]))
    return False


def _castable(old: DataType, new: DataType) -> bool:
    """Does every value of the old type have one of the new, though files must be rewritten?"""
    if isinstance(old, _WHOLE) and isinstance(new, DecimalType):
        return new.precision - new.scale >= _DIGITS[type(old)]
    return isinstance(old, DateType) and isinstance(new, TimestampType)


def compare(current: StructType, wanted: StructType) -> SchemaChange:
    """What it takes to give a table the columns and types of a batch.

    Fields are matched by name, at any depth of structs, arrays and maps.  Fields the batch lacks
    go, new ones come last; of two types the wider stays, so a batch may also be narrower than the
    table.  Types of which neither holds all values of the other are an error.
    """
    found: dict[str, list[str]] = {"added": [], "removed": [], "widened": [], "rewritten": [], "wrong": []}

    def both(old: DataType, new: DataType, path: str) -> DataType:
        if isinstance(old, StructType) and isinstance(new, StructType):
            return structs(old, new, f"{path}." if path else "")
        if isinstance(old, ArrayType) and isinstance(new, ArrayType):
            return ArrayType(both(old.elementType, new.elementType, f"{path}.element"))
        if isinstance(old, MapType) and isinstance(new, MapType) and old.keyType == new.keyType:
            return MapType(old.keyType, both(old.valueType, new.valueType, f"{path}.value"))
        if old.simpleString() == new.simpleString() or _readable(new, old) or _castable(new, old):
            return old
        kind = "widened" if _readable(old, new) else "rewritten" if _castable(old, new) else "wrong"
        found[kind].append(path)
        return new

    def structs(old: StructType, new: StructType, prefix: str) -> StructType:
        names, fields = {f.name: f for f in new.fields}, []
        for f in old.fields:
            if f.name in names:
                kind = both(f.dataType, names[f.name].dataType, prefix + f.name)
                fields.append(StructField(f.name, kind, True, f.metadata))
            else:
                found["removed"].append(prefix + f.name)
        known = set(old.names)
        for f in new.fields:
            if f.name not in known:
                found["added"].append(prefix + f.name)
                fields.append(StructField(f.name, f.dataType, True, f.metadata))
        return StructType(fields)

    schema = structs(current, wanted, "")
    if found["wrong"]:
        raise ValueError(f"type of {sorted(found['wrong'])} changed, rebuild the table")
    lists = {kind: tuple(paths) for kind, paths in found.items() if kind != "wrong"}
    return SchemaChange(**lists, schema=schema)


def conformed(column: Column, have: DataType, want: DataType) -> Column:
    """The column with another type, its fields matched by name; missing ones are NULL."""
    if have.simpleString() == want.simpleString():
        return column
    if isinstance(want, StructType):
        names = {f.name: f.dataType for f in have.fields}
        fields = [
            conformed(column.getField(f.name), names[f.name], f.dataType).alias(f.name)
            if f.name in names
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in want.fields
        ]
        return F.when(column.isNotNull(), F.struct(*fields))
    if isinstance(want, ArrayType):
        return F.transform(column, lambda x: conformed(x, have.elementType, want.elementType))
    if isinstance(want, MapType):
        return F.transform_values(column, lambda _, x: conformed(x, have.valueType, want.valueType))
    return column.cast(want)


def columns_of(have: StructType, want: StructType) -> Iterator[Column]:
    """Expressions that give rows of one schema the columns of another."""
    names = {f.name: f.dataType for f in have.fields}
    for f in want.fields:
        if f.name in names:
            yield conformed(F.col(f"`{f.name}`"), names[f.name], f.dataType).alias(f.name, metadata=f.metadata)
        else:
            yield F.lit(None).cast(f.dataType).alias(f.name, metadata=f.metadata)
