"""Description of a resource: its columns, keys, raw shape and filters."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

from palimpsest.functions.casing import camel

TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "array": T.ArrayType(T.StringType()),
    "json": T.StringType(),
}


@dataclass(frozen=True)
class Field:
    """A column. `kind` is a name of TYPES; "json" is JSON text kept in canonical form."""

    name: str
    kind: str = "string"
    raw: str | None = None
    raw_kind: str | None = None
    required: bool = False
    sensitive: bool = False

    @property
    def dtype(self) -> T.DataType:
        return TYPES[self.kind]

    @property
    def raw_name(self) -> str:
        return self.raw or camel(self.name)

    @property
    def raw_dtype(self) -> T.DataType:
        return TYPES[self.raw_kind or self.kind]


@dataclass(frozen=True)
class Filter:
    """A filter argument of a read: which predicate it applies to which column.

    Kinds: equals, value, text, include, exclude, prefix_include, prefix_exclude, scope, unresolved.
    """

    kind: str
    column: str
    strip: bool = False


@dataclass(frozen=True, eq=False)
class ResourceSpec:
    name: str
    keys: tuple[str, ...]
    fields: tuple[Field, ...]
    path: str
    versioned: bool = True
    # Raw shape: the array of child records in each landed record, and the parent's columns
    # each child takes over. `position` names the column that takes the child's 0-based index.
    children: str | None = None
    parent: tuple[str, ...] = ()
    position: str | None = None
    # Columns filled from a nested object when absent: column -> path in the raw record.
    flatten: dict[str, str] = field(default_factory=dict)
    filters: dict[str, Filter] = field(default_factory=dict)
    sort: tuple[str, ...] = ()
    # Order of refresh, and the product type a network needs for this feed.
    after: tuple[str, ...] = ()
    product_type: str | None = None

    @property
    def columns(self) -> list[str]:
        """All declared columns without versioning."""
        return [f.name for f in self.fields]

    @property
    def values(self) -> list[str]:
        """Business columns: neither key nor versioning."""
        return [f.name for f in self.fields if f.name not in self.keys]

    @property
    def json_cols(self) -> list[str]:
        return [f.name for f in self.fields if f.kind == "json"]

    @property
    def sensitive(self) -> list[str]:
        return [f.name for f in self.fields if f.sensitive]

    def shown(self, sensitive: bool = False) -> list[str]:
        """Business columns for diffs and updates; secrets only where asked for."""
        return [v for v in self.values if sensitive or v not in self.sensitive]

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.fields if f.required or f.name in self.keys]

    @property
    def overrides(self) -> dict[str, str]:
        """Raw name -> column, where the general rule does not give it."""
        return {f.raw: f.name for f in self.fields if f.raw}

    @property
    def schema(self) -> T.StructType:
        """Stored rows."""
        fields = [T.StructField(f.name, f.dtype) for f in self.fields]
        times = ("active_from", "active_to", "last_seen") if self.versioned else ("last_seen",)
        return T.StructType(fields + [T.StructField(t, T.TimestampType()) for t in times])

    def _raw_fields(self, skip: tuple[str, ...] = ()) -> list[T.StructField]:
        """Raw columns; those a nested object fills come with that object."""
        out = [T.StructField(f.raw_name, f.raw_dtype) for f in self.fields if f.name not in skip]
        nested: dict[str, list[str]] = {}
        for path in self.flatten.values():
            outer, inner = path.split(".")
            nested.setdefault(outer, []).append(inner)
        for outer, inner in nested.items():
            struct = T.StructType([T.StructField(i, T.StringType()) for i in inner])
            out.append(T.StructField(outer, struct))
        return out

    @property
    def raw_schema(self) -> T.StructType:
        """Landed records. A STRING over a nested object keeps the object's text."""
        if not self.children:
            return T.StructType(self._raw_fields())
        own = {f.name: f for f in self.fields}
        carried = [
            T.StructField(camel(p), own[p].raw_dtype if p in own else T.StringType())
            for p in self.parent
        ]
        # The counters' time columns come from the reading, not from the child record.
        skip = (*(p for p in self.parent if p in own), *([self.position] if self.position else []))
        child = T.StructType(self._raw_fields(skip))
        return T.StructType([*carried, T.StructField(self.children, T.ArrayType(child))])
