"""Schema tools: flatten, edit structs, parse JSON, clean names, enforce types."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


STRING_MAP = T.MapType(T.StringType(), T.StringType(), True)

# The marker and the name rules decide the resulting names.
UNIQUE_MARK = "_UNIQUESUFFIX_"
NAME_RULES = [
    (r"\s", ""),
    (r"[^a-zA-Z0-9]", "_"),
    ("_UNIQUESUFFIX_", "_UNIQUESUFFIX__"),
]


def _quoted(path: str) -> str:
    return ".".join(f"`{p}`" for p in path.split("."))


def find_type(schema: T.StructType, path: str) -> T.DataType | None:
    """Type at a dotted path, or None."""
    here: T.DataType = schema
    for part in path.split("."):
        if not isinstance(here, T.StructType) or part not in here.fieldNames():
            return None
        here = here[part].dataType
    return here


def flatten(df: DataFrame) -> DataFrame:
    """One column per struct leaf, named by its path with underscores."""

    def leaves(schema: T.StructType, prefix: list[str]) -> list[Column]:
        out = []
        for f in schema.fields:
            path = [*prefix, f.name]
            if isinstance(f.dataType, T.StructType):
                out += leaves(f.dataType, path)
            else:
                out.append(F.col(".".join(f"`{p}`" for p in path)).alias("_".join(path)))
        return out

    return df.select(*leaves(df.schema, []))


def drop_struct_fields(df: DataFrame, struct: str, fields: list[str]) -> DataFrame:
    """Drop fields of a top-level struct."""
    if any("." in f for f in fields):
        raise ValueError("only direct fields of the struct can be dropped")
    if not re.fullmatch(r"\w+", struct):
        raise ValueError("only a top-level struct can lose fields")
    present = df.schema[struct].dataType.fieldNames()
    ignore_case = df.sparkSession.conf.get("spark.sql.caseSensitive") != "true"
    gone = {f.lower() if ignore_case else f for f in fields}
    keep = [f for f in present if (f.lower() if ignore_case else f) not in gone]
    return df.withColumn(struct, F.struct(*[F.col(f"`{struct}`.`{f}`") for f in keep]))


def modify_struct(df: DataFrame, changes: dict[str, Column]) -> DataFrame:
    """Replace columns or struct fields by dotted path; other fields stay.

    Structs are rebuilt as a whole, so a null struct with a changed field
    becomes a struct of nulls.
    """

    def touched(path: str) -> bool:
        return any(c == path or c.startswith(path + ".") for c in changes)

    def rebuild(schema: T.StructType, prefix: str) -> list[Column]:
        out = []
        for f in schema.fields:
            path = f"{prefix}.{f.name}" if prefix else f.name
            if path in changes:
                out.append(changes[path].alias(f.name))
            elif isinstance(f.dataType, T.StructType) and touched(path):
                out.append(F.struct(*rebuild(f.dataType, path)).alias(f.name))
            else:
                out.append(F.col(_quoted(path)).alias(f.name))
        return out

    return df.select(*rebuild(df.schema, ""))


def append_to_struct(
    df: DataFrame,
    struct: str,
    columns: dict[str, Column],
    override: bool = False,
    new_name: str | None = None,
) -> DataFrame:
    """Add fields to a struct; existing ones change only with ``override``."""
    if struct not in df.columns:
        raise ValueError(f"{struct} is not in the frame")
    kind = df.schema[struct].dataType
    if not isinstance(kind, T.StructType):
        raise ValueError(f"{struct} must be a struct, not {kind.simpleString()}")
    have = set(kind.fieldNames())
    added = {n: c for n, c in columns.items() if override or n not in have}
    grown = reduce(lambda s, nc: s.withField(nc[0], nc[1]), added.items(), F.col(struct))
    return df.withColumn(new_name or struct, grown)


CORRUPT = "_corrupt_record"


def json_schemas(df: DataFrame, columns: list[str]) -> dict[str, T.StructType]:
    """Schemas of the JSON texts of several columns, found by one aggregation over all of them.

    Objects and arrays of objects give the fields of all objects, sorted by name. Fields of
    different kinds are texts, as are those that are always null; numbers with a fraction are
    doubles; objects without any field are left out. Texts that are neither an object nor an
    array of objects add the field ``_corrupt_record``. Blank texts and nulls do
    not count; a column without any other text has no fields.
    """
    texts, wanted = [], []
    for c in columns:
        kind = find_type(df.schema, c)
        if kind is None:
            raise ValueError(f"the frame has no column {c}")
        if not isinstance(kind, T.StringType):
            raise ValueError(f"{c} must be JSON text")
        # every text becomes an array of objects, so both spellings have one schema
        text = F.btrim(F.col(_quoted(c)), F.lit(" \t\r\n"))
        listed = F.when(F.startswith(text, F.lit("{")), F.concat(F.lit("["), text, F.lit("]"))).when(
            F.startswith(text, F.lit("[")), text
        )
        texts.append(F.nullif(F.nullif(text, F.lit("")), F.lit("null")))
        wanted.append(F.try_parse_json(listed))
    if not columns:
        return {}
    found = df.select(*[t.alias(f"t{i}") for i, t in enumerate(texts)], *[v.alias(f"v{i}") for i, v in enumerate(wanted)]).agg(
        *[F.schema_of_variant_agg(f"v{i}").alias(f"s{i}") for i in range(len(columns))],
        *[F.count_if(F.col(f"t{i}").isNotNull() & F.col(f"v{i}").isNull()).alias(f"n{i}") for i in range(len(columns))],
    ).first()
    out = {}
    for i, c in enumerate(columns):
        kind = variant_type(found[f"s{i}"])
        element = kind.elementType if isinstance(kind, T.ArrayType) else None
        fields = element.fields if isinstance(element, T.StructType) else []
        odd = found[f"n{i}"] or not isinstance(kind, T.NullType) and not isinstance(element, (T.StructType, T.NullType))
        if odd and CORRUPT not in [f.name for f in fields]:
            fields = sorted([*fields, T.StructField(CORRUPT, T.StringType())], key=lambda f: f.name)
        out[c] = _json_type(T.StructType(fields)) or T.StructType()
    return out


def variant_type(shown: str) -> T.DataType:
    """The type that the schema of a variant shows; names in backquotes stay as they are."""
    ddl = re.sub(r"`(?:[^`]|``)*`|OBJECT<", lambda m: "STRUCT<" if m[0] == "OBJECT<" else m[0], shown)
    return T.StructType.fromDDL(f"c {ddl}")["c"].dataType


def _json_type(kind: T.DataType) -> T.DataType | None:
    """The type that JSON texts are read with; None for objects without fields."""
    if isinstance(kind, T.StructType):
        inner = [(f.name, _json_type(f.dataType)) for f in kind.fields]
        fields = [T.StructField(n, k) for n, k in inner if k is not None]
        return T.StructType(fields) if fields else None
    if isinstance(kind, T.ArrayType):
        element = _json_type(kind.elementType)
        return None if element is None else T.ArrayType(element)
    if isinstance(kind, T.DecimalType):
        return kind if kind.scale == 0 and kind.precision > 18 else T.DoubleType()
    return T.StringType() if isinstance(kind, (T.VariantType, T.NullType)) else kind


def json_schema(df: DataFrame, column: str) -> T.StructType:
    """Schema of the JSON texts of one column (see `json_schemas`)."""
    return json_schemas(df, [column])[column]


def struct_from_json(
    df: DataFrame,
    column: str,
    *,
    is_array: bool = False,
    when_empty: T.DataType | str | None = None,
    schema: T.DataType | None = None,
) -> Column:
    """Parse a JSON text column with the schema of all its values.

    A known ``schema`` spares the pass over the data. Without any value the
    result is a null of type ``when_empty``.
    """
    found = schema if schema is not None else json_schema(df, column)
    name = column.split(".")[-1]
    if isinstance(found, T.StructType) and not found.fields:
        return F.lit(None).cast(when_empty or T.NullType()).alias(name)
    return F.from_json(F.col(_quoted(column)), T.ArrayType(found) if is_array else found).alias(name)


def struct_to_map(
    schema: T.StructType, path: str, drop_empty: bool = True, source: Callable[[str], Column] | None = None
) -> Column:
    """Map of text from a struct of simple fields; null values are left out.

    A missing or untyped column gives a null map, another type is an error.
    ``source`` gives the column of a path; the default reads it from the frame.
    """
    name = path.split(".")[-1]
    null_map = F.lit(None).cast(STRING_MAP).alias(name)
    kind = find_type(schema, path)
    if kind is None or isinstance(kind, T.NullType):
        return null_map
    if isinstance(kind, T.MapType):
        return (source or (lambda p: F.col(_quoted(p))))(path).cast(STRING_MAP).alias(name)
    if not isinstance(kind, T.StructType):
        raise ValueError(f"{path} must be a struct, not {kind.simpleString()}")
    base = (source or (lambda p: F.col(_quoted(p))))(path)
    pairs = []
    for i, f in enumerate(kind.fields):
        key = f.name.strip() or f"null_{i}"
        value = base.getField(f.name)
        text = F.to_json(value) if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)) else value.cast("string")
        pairs += [F.lit(key), text]
    if not pairs:
        return null_map
    full = F.create_map(*pairs)
    kept = F.map_filter(full, lambda _, v: v.isNotNull()) if drop_empty else full
    return F.when(base.isNotNull(), kept).cast(STRING_MAP).alias(name)


CLUSTER_MAPS = ["custom_tags", "spark_conf", "spark_env_vars", "aws_attributes", "azure_attributes"]


def cluster_map_changes(schema: T.StructType, prefix: str) -> dict[str, Column]:
    """The cluster fields with user-defined keys, as maps; only those present."""
    return {
        f"{prefix}.{f}": struct_to_map(schema, f"{prefix}.{f}")
        for f in CLUSTER_MAPS
        if find_type(schema, f"{prefix}.{f}") is not None
    }


def clean_struct_array(df: DataFrame, path: str, maps: list[str], when_missing: T.DataType | str | None = None) -> Column:
    """An array of structs whose listed inner structs become maps, element by element.

    No explode and no regrouping: the elements stay in their row. ``maps`` are
    paths within an element. A missing or empty array gives a typed null.
    """
    name = path.split(".")[-1]
    kind = find_type(df.schema, path)
    if not isinstance(kind, T.ArrayType) or not isinstance(kind.elementType, T.StructType):
        return F.lit(None).cast(when_missing or T.NullType()).alias(name)
    element = kind.elementType

    def rebuild(schema: T.StructType, value: Column, prefix: str) -> Column:
        cols = []
        for f in schema.fields:
            here = f"{prefix}.{f.name}" if prefix else f.name
            inner = value.getField(f.name)
            if here in maps and isinstance(f.dataType, (T.StructType, T.NullType)):
                cols.append(_value_map(f.dataType, inner).alias(f.name))
            elif isinstance(f.dataType, T.StructType) and any(m.startswith(here + ".") for m in maps):
                cols.append(F.when(inner.isNotNull(), rebuild(f.dataType, inner, here)).alias(f.name))
            else:
                cols.append(inner.alias(f.name))
        return F.struct(*cols)

    array = F.col(_quoted(path))
    return F.when(F.size(array) > 0, F.transform(array, lambda e: rebuild(element, e, ""))).alias(name)


def _value_map(kind: T.DataType, value: Column) -> Column:
    if not isinstance(kind, T.StructType) or not kind.fields:
        return F.lit(None).cast(STRING_MAP)
    full = F.create_map(
        *[c for f in kind.fields for c in (F.lit(f.name), value.getField(f.name).cast("string"))]
    )
    return F.when(value.isNotNull(), F.map_filter(full, lambda _, v: v.isNotNull()))


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Drop the columns without any value; one pass counts all of them."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns)]).first()
    return df.select(*[F.col(f"`{c}`") for i, c in enumerate(df.columns) if counts[i] > 0])


# --- names ------------------------------------------------------------------


@dataclass(frozen=True)
class NameException:
    """Other rules for one field, and with ``recursive`` for all below it."""

    field: str
    rules: list[tuple[str, str]] = field(default_factory=list)
    recursive: bool = False


def java_hash(text: str) -> int:
    """Hash code of a text as the JVM computes it."""
    value = 0
    for unit in memoryview(text.encode("utf-16-le")).cast("H"):
        value = (value * 31 + unit) & 0xFFFFFFFF
    return value - (1 << 32) if value >= 1 << 31 else value


def scrub_schema(
    df: DataFrame,
    rules: list[tuple[str, str]] | None = None,
    exceptions: list[NameException] | None = None,
    drop_null_types: bool = False,
) -> DataFrame:
    """Clean all field names by pattern rules, down through structs and arrays.

    Names that become equal get a suffix from the hash of the original name.
    Fields are renamed by casting, so no row is rebuilt outside the JVM.
    """
    rules = NAME_RULES if rules is None else rules
    exceptions = exceptions or []
    special = {e.field: e for e in exceptions}
    if len(special) != len(exceptions):
        raise ValueError("two exceptions for the same field")
    case = df.sparkSession.conf.get("spark.sql.caseSensitive") == "true"

    def cleaned(name: str, by: list[tuple[str, str]]) -> str:
        for pattern, to in by:
            name = re.sub(pattern, to, name)
        return name

    def struct(schema: T.StructType, inherited: list[tuple[str, str]], top: bool) -> T.StructType:
        fresh = []
        for f in schema.fields:
            exception = special.get(f.name) if top else None
            if inherited:
                own = list(dict.fromkeys([*inherited, *(exception.rules if exception else rules)]))
            else:
                own = exception.rules if exception else rules
            # rules go down only where an exception is recursive
            passed = own if inherited or (exception and exception.recursive) else []
            fresh.append((f, cleaned(f.name, own), kind(f.dataType, passed)))
        compare = [n.strip() if case else n.strip().lower() for _, n, _ in fresh]
        twice = {n for n in compare if compare.count(n) > 1}
        out = []
        for (f, name, new_kind), key in zip(fresh, compare):
            if key in twice:
                name = f"{name}{UNIQUE_MARK}{java_hash(f.name)}"
            out.append(T.StructField(name, new_kind, f.nullable))
        return T.StructType(out)

    def kind(dt: T.DataType, inherited: list[tuple[str, str]]) -> T.DataType:
        if isinstance(dt, T.StructType):
            return struct(dt, inherited, False)
        if isinstance(dt, T.ArrayType):
            return T.ArrayType(kind(dt.elementType, []), dt.containsNull)
        return dt

    if drop_null_types:
        df = drop_void_fields(df)
    target = struct(df.schema, [], True)
    plain = df.toDF(*[f"__c{i}" for i in range(len(df.columns))])
    return plain.select(
        *[
            (F.col(f"__c{i}").cast(f.dataType) if f.dataType != s.dataType else F.col(f"__c{i}")).alias(f.name)
            for i, (f, s) in enumerate(zip(target.fields, df.schema.fields))
        ]
    )


def drop_void_fields(df: DataFrame) -> DataFrame:
    """Drop fields without a type, at any struct depth."""

    def has_void(dt: T.DataType) -> bool:
        if isinstance(dt, T.StructType):
            return any(has_void(f.dataType) for f in dt.fields)
        return isinstance(dt, T.NullType)

    def keep(dt: T.DataType, value: Column) -> Column:
        if not isinstance(dt, T.StructType) or not has_void(dt):
            return value
        return F.when(
            value.isNotNull(),
            F.struct(
                *[
                    keep(f.dataType, value.getField(f.name)).alias(f.name)
                    for f in dt.fields
                    if not isinstance(f.dataType, T.NullType)
                ]
            ),
        )

    return df.select(
        *[
            keep(f.dataType, F.col(f"`{f.name}`")).alias(f.name)
            for f in df.schema.fields
            if not isinstance(f.dataType, T.NullType)
        ]
    )


# --- minimum schema ---------------------------------------------------------


@dataclass(frozen=True)
class FieldCheck:
    """What the minimum schema does to one field."""

    path: str
    action: str  # added, kept, cast, checked
    found: str | None
    required: str | None


class SchemaMismatch(ValueError):
    """A field has a structure the minimum schema cannot accept."""


def _enforced(
    have: T.StructType, need: T.StructType, value: Callable[[str], Column], prefix: str, log: list[FieldCheck]
) -> list[Column]:
    banned = {f.name.lower() for f in need.fields if isinstance(f.dataType, T.NullType)}
    required = {f.name.lower(): f for f in need.fields if f.name.lower() not in banned}
    present = [f for f in have.fields if f.name.lower() not in banned]
    names = {f.name.lower() for f in present}

    added, free, checked = [], [], []
    for f in need.fields:
        if f.name.lower() in required and f.name.lower() not in names:
            log.append(FieldCheck(prefix + f.name, "added", None, f.dataType.simpleString()))
            added.append(F.lit(None).cast(f.dataType).alias(f.name))
    for f in present:
        if f.name.lower() not in required:
            log.append(FieldCheck(prefix + f.name, "kept", f.dataType.simpleString(), None))
            free.append(value(f.name).alias(f.name))
        else:
            checked.append(
                _fitted(f, required[f.name.lower()].dataType, value(f.name), prefix + f.name, log).alias(f.name)
            )
    return [*added, *free, *checked]


def _fitted(f: T.StructField, need: T.DataType, value: Column, path: str, log: list[FieldCheck]) -> Column:
    have = f.dataType

    def note(action: str) -> None:
        log.append(FieldCheck(path, action, have.simpleString(), need.simpleString()))

    def refuse() -> SchemaMismatch:
        return SchemaMismatch(f"{path}: found {have.simpleString()}, required {need.simpleString()}")

    if isinstance(have, T.StructType):
        if not isinstance(need, T.StructType):
            raise refuse()
        note("checked")
        return F.struct(*_enforced(have, need, value.getField, path + ".", log))
    if isinstance(have, T.MapType):
        if not isinstance(need, T.MapType) or (have.keyType, have.valueType) != (need.keyType, need.valueType):
            raise refuse()
        note("checked")
        return value
    if isinstance(have, T.ArrayType):
        if not isinstance(need, T.ArrayType):
            raise refuse()
        if isinstance(have.elementType, T.StructType):
            if not isinstance(need.elementType, T.StructType):
                raise refuse()
            note("checked")  # structure is compared, the elements stay as they are
            _enforced(have.elementType, need.elementType, lambda n: F.lit(None), path + ".", [])
            return value
        if have.elementType != need.elementType:
            note("cast")
            return value.cast(need)
        note("checked")
        return value
    if isinstance(need, (T.StructType, T.MapType, T.ArrayType)) and not isinstance(have, T.NullType):
        raise refuse()
    if have != need:
        note("cast")
        scalar = not isinstance(need, (T.StructType, T.MapType, T.ArrayType)) and not isinstance(have, T.NullType)
        return value.try_cast(need) if scalar else value.cast(need)
    note("checked")
    return value


def enforce_schema(df: DataFrame, required: T.StructType | None) -> DataFrame:
    """Bring a frame to a minimum schema.

    Missing fields come first, as typed nulls; then the fields without a
    requirement; then the checked ones. Scalars of another type are cast,
    fields required without a type are dropped, other structures raise.
    """
    if required is None:
        return df
    return df.select(*_enforced(df.schema, required, lambda n: F.col(f"`{n}`"), "", []))


def review_schema(df: DataFrame, required: T.StructType) -> list[FieldCheck]:
    """What ``enforce_schema`` would do, field by field."""
    log: list[FieldCheck] = []
    _enforced(df.schema, required, lambda n: F.col(f"`{n}`"), "", log)
    return log


# --- columns ----------------------------------------------------------------


def suffix_columns(df: DataFrame, suffix: str, columns: list[str] | None = None) -> DataFrame:
    chosen = set(df.columns if not columns else columns)
    return df.select(*[F.col(f"`{c}`").alias(c + suffix if c in chosen else c) for c in df.columns])


def prefix_columns(df: DataFrame, prefix: str, columns: list[str]) -> DataFrame:
    return df.withColumnsRenamed({c: prefix + c for c in columns})


def columns_to_front(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*columns, *[F.col(f"`{c}`") for c in df.columns if c not in columns])


def drop_by_alias(df: DataFrame, alias: str, columns: list[str]) -> DataFrame:
    """Drop the columns of one side of a join."""
    return df.drop(*[F.col(f"{alias}.{c}") for c in columns])


def union_with_nulls(base: DataFrame, other: DataFrame) -> DataFrame:
    """All rows of both; columns of one side only are null in the other's rows."""
    return base.unionByName(other, allowMissingColumns=True)


def add_columns_of(df: DataFrame, other: DataFrame) -> DataFrame:
    """Typed nulls for the other frame's columns."""
    return df.select(
        "*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in other.schema.fields if f.name not in df.columns]
    )


def fill_all_nulls(df: DataFrame) -> DataFrame:
    """Zero, "0" and false for nulls of simple columns."""
    return df.na.fill(0).na.fill("0").na.fill(False)


def apply_filters(df: DataFrame, filters: list[Column]) -> DataFrame:
    return reduce(lambda d, f: d.filter(f), filters, df)


def project_properties(properties: Column, spec: dict) -> Column:
    """Nested struct out of map keys: ``{field: key}`` or ``{field: {...}}``.

    The struct is made in a lambda, which Spark keeps out of the code it generates for the
    whole stage: with dozens of fields beside other columns that code is one method too
    long for the JVM to compile.
    """

    def made(m: Column, fields: dict) -> Column:
        return F.struct(
            *[(made(m, v) if isinstance(v, dict) else F.try_element_at(m, F.lit(v))).alias(k) for k, v in fields.items()]
        )

    return F.get(F.transform(F.array(properties), lambda m: made(m, spec)), F.lit(0))


def merge_case_variants(
    df: DataFrame, struct: str, rules: dict[str, tuple[str, list[tuple[list[str], str]], bool]], action: str
) -> DataFrame:
    """One field out of two that differ only in case, chosen by the action.

    ``rules`` maps the lower-case-first field to (its variant, [(actions,
    source field)], whether other actions take the field itself).
    The frame must have been read with case-sensitive names.
    """
    kind = df.schema[struct].dataType
    names = kind.fieldNames()
    variants = {v[0] for v in rules.values()}
    if not variants & set(names):
        return df
    value = F.col(struct)
    cols = []
    for name in names:
        if name in variants:
            continue
        if name in rules and rules[name][0] in names:
            _, cases, keep_own = rules[name]
            pick = F.lit(None).cast(kind[name].dataType) if not keep_own else value.getField(name)
            for actions, source in reversed(cases):
                pick = F.when(F.col(action).isin(actions), value.getField(source)).otherwise(pick)
            cols.append(pick.alias(name))
        else:
            cols.append(value.getField(name).alias(name))
    return df.withColumn(struct, F.struct(*cols))
