"""Schema evolution and rescue of fields that do not fit the schema."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.sources.files import SchemaLike, as_struct

# Evolution modes; whole numbers from narrow to wide, with their decimal digits.
MODES = ("addNewColumns", "addNewColumnsWithTypeWidening", "rescue", "failOnNewColumns", "none")
INTEGERS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}


class UnknownFieldError(ValueError):
    """New fields arrived. With ``schema_recorded`` the next run reads them."""

    def __init__(self, fields: list[str], schema_recorded: bool):
        super().__init__(f"fields not in the schema: {fields}")
        self.fields = fields
        self.schema_recorded = schema_recorded


@dataclass(frozen=True)
class Verdict:
    """What a schema comparison means: ``ok``, ``restart`` (record and fail once) or ``fail``."""

    action: str
    new_fields: list[str] = field(default_factory=list)
    widened: list[str] = field(default_factory=list)


def widens(old: T.DataType, new: T.DataType) -> bool:
    """Whether every value of ``old`` is one of ``new``."""
    a, b = old.simpleString(), new.simpleString()
    if a in INTEGERS and b in INTEGERS:
        return INTEGERS[b] > INTEGERS[a]
    if a == "float" and b == "double":
        return True
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        return (new.scale >= old.scale and new != old
                and new.precision - new.scale >= old.precision - old.scale)
    if a in INTEGERS and isinstance(new, T.DecimalType):
        return new.precision - new.scale >= INTEGERS[a]
    return a in INTEGERS and a != "bigint" and b == "double"


def evolve_schema(current: T.StructType, incoming: T.StructType,
                  mode: str = "addNewColumns") -> tuple[T.StructType, Verdict]:
    """Compare schemas (metadata only) and say how to go on."""
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode}")
    known = {f.name: f for f in current.fields}
    new = [f for f in incoming.fields if f.name not in known]
    names = [f.name for f in new]
    if mode in ("rescue", "none"):
        return current, Verdict("ok", names)
    widened = []
    if mode == "addNewColumnsWithTypeWidening":
        widened = [f.name for f in incoming.fields
                   if f.name in known and widens(known[f.name].dataType, f.dataType)]
    if not new and not widened:
        return current, Verdict("ok")
    if mode == "failOnNewColumns":
        return current, Verdict("fail", names)
    types = {f.name: f.dataType for f in incoming.fields}
    fields = [T.StructField(f.name, types[f.name]) if f.name in widened else f
              for f in current.fields]
    return T.StructType([*fields, *new]), Verdict("restart", names, widened)


def rescue_json(raw: DataFrame, schema: SchemaLike, value: str = "value",
                case_sensitive: bool = True, rescued: str = "_rescued_data",
                path_col: str | None = None) -> DataFrame:
    """Parse JSON text by ``schema`` and keep everything that does not fit as JSON.

    A key is rescued when the schema does not have it (in this exact case, unless
    ``case_sensitive`` is off), when its value does not parse as the declared type, or when that is so
    for anything inside it: a struct, array or map whose typed value lost something is kept
    whole. Rows are never dropped; other columns of ``raw`` are kept. With ``path_col`` the rescued JSON also
    names the source file.
    """
    struct = as_struct(schema)
    text = F.col(value)
    if not case_sensitive:
        text = _lower_keys(text)
        struct = T.StructType([T.StructField(f.name.lower(), f.dataType) for f in struct.fields])
    rows = raw.withColumns({"__typed": F.from_json(text, struct),
                            "__raw": F.from_json(text, "map<string,string>")})

    # Keys that found a typed value; set difference keeps this linear for wide schemas.
    def fits(f: T.StructField) -> Column:
        typed = F.col("__typed").getField(f.name)
        return typed.isNotNull() & ~_loses(F.col("__raw").getItem(f.name), typed, f.dataType)

    fitting = F.array_compact(F.array(*[F.when(fits(f), f.name) for f in struct.fields]))
    odd = F.array_except(F.map_keys("__raw"), fitting)
    names = F.array(*[F.lit(f.name) for f in struct.fields])
    rows = rows.withColumn("__odd", odd)
    extra = F.map_filter("__raw", lambda k, v: F.array_contains("__odd", k) & (
        v.isNotNull() | ~F.array_contains(names, k)))
    if path_col is not None:
        place = F.create_map(F.lit("_file_path"), F.col(path_col).cast("string"))
        extra = F.when(F.size(extra) > 0, F.map_concat(extra, place))
    # A line that is not a JSON object is rescued whole.
    no_object = F.col("__raw").isNull() & F.col(value).isNotNull()
    body = (F.when(no_object, F.to_json(F.create_map(F.lit("_corrupt_record"), F.col(value))))
            .when(F.size(extra) > 0, F.to_json(extra)))
    kept = [c for c in raw.columns if c != value]
    declared = as_struct(schema).names
    return rows.select(*kept, *[F.col("__typed").getField(f.name).alias(n)
                                for n, f in zip(declared, struct.fields, strict=True)],
                       body.alias(rescued))


def _loses(raw: Column, typed: Column, kind: T.DataType) -> Column:
    """Whether JSON text says something that its typed value doesn't, at any depth."""
    missing = raw.isNotNull() & typed.isNull()
    if isinstance(kind, T.StructType):
        fields = F.from_json(raw, "map<string,string>")
        inside = F.exists(F.map_keys(fields), lambda k: ~k.isin(*kind.names) if kind.names else F.lit(True))
        for f in kind.fields:
            inside = inside | _loses(fields.getItem(f.name), typed.getField(f.name), f.dataType)
    elif isinstance(kind, T.ArrayType):
        inside = F.exists(F.zip_with(F.from_json(raw, "array<string>"), typed,
                                     lambda r, t: _loses(r, t, kind.elementType)), lambda lost: lost)
    elif isinstance(kind, T.MapType):
        values = F.map_values(F.from_json(raw, "map<string,string>"))
        inside = F.exists(F.zip_with(values, F.map_values(typed),
                                     lambda r, t: _loses(r, t, kind.valueType)), lambda lost: lost)
    else:
        return missing
    return missing | F.coalesce(inside, F.lit(False))


def _lower_keys(text: Column) -> Column:
    """The JSON object with lower-case keys; a key that has this case already wins."""
    fields = F.try_parse_json(text).cast("map<string,variant>")
    single = F.map_filter(
        fields, lambda k, _: (k == F.lower(k)) | ~F.map_contains_key(fields, F.lower(k)))
    return F.to_json(F.transform_keys(single, lambda k, _: F.lower(k)))


def rescue_report(df: DataFrame, path_col: str = "source_file",
                  rescued: str = "_rescued_data") -> DataFrame:
    """Rows with rescued data per source file."""
    return (df.where(F.col(rescued).isNotNull())
            .groupBy(F.col(path_col).alias("file_path"))
            .agg(F.count(F.lit(1)).alias("rescued_rows")))
