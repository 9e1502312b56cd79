"""What a table promises from load to load: its columns and their types, in versions.

A load may add columns and widen types, which makes a new version; files of
earlier loads are then read by the new one, with NULL in added columns. A column
that goes, another type or a narrower one breaks the promise.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

#: What a contract lets a load do: add columns and widen types, or nothing.
WIDEN, SAME = "widen", "same"

VERSIONS = T.StructType([
    T.StructField("layer", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("version", T.IntegerType()),
    T.StructField("load_id", T.StringType()),
    T.StructField("allows", T.StringType()),
    T.StructField("schema", T.StringType()),
])


class ContractBroken(ValueError):
    """A load was refused: its rows don't keep what the table promises."""

    def __init__(self, layer: str, table: str, version: int, breaks: list[str]):
        self.breaks = breaks
        super().__init__(f"{layer}.{table} breaks version {version} of its contract: {'; '.join(breaks)}")


@dataclass(frozen=True)
class Contract:
    version: int
    allows: str
    schema: T.StructType

    def breaks(self, new: T.StructType) -> list[str]:
        """What in a load's columns the contract forbids. The order of columns is free."""
        found = {f.name: f.dataType for f in new.fields}
        old = {f.name: f.dataType for f in self.schema.fields}
        told = [f"{name} is missing" for name in old if name not in found]
        for name, kind in found.items():
            if name not in old:
                told += [f"{name} is new"] if self.allows == SAME else []
            elif kind != old[name] and (self.allows == SAME or not widens(old[name], kind)):
                told.append(f"{name} was {old[name].simpleString()}, is {kind.simpleString()}")
        return told

    def following(self, new: T.StructType) -> Contract:
        """The contract after a load that keeps it; a new version if columns or types changed."""
        changed = {(f.name, f.dataType) for f in new.fields} != {(f.name, f.dataType) for f in self.schema.fields}
        return Contract(self.version + 1, self.allows, new) if changed else self


_WHOLE = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 20}


def widens(old: T.DataType, new: T.DataType) -> bool:
    """Whether every value of the old type is one of the new, and files of the old type can be read as the new."""
    if old in _WHOLE:
        if new in _WHOLE:
            return _WHOLE[new] > _WHOLE[old]
        return isinstance(new, T.DecimalType) and new.precision - new.scale >= _WHOLE[old]
    if isinstance(old, T.DecimalType):
        return (
            isinstance(new, T.DecimalType) and new != old
            and new.scale >= old.scale and new.precision - new.scale >= old.precision - old.scale
        )
    return (old, new) in ((T.FloatType(), T.DoubleType()), (T.DateType(), T.TimestampNTZType()))
