"""JSON lines of unknown and differing shape: parsed once into VARIANT, typed by the schema that all lines share."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow import schemas
from tierflow.runtime import scratch_path, session_conf
from tierflow.sources.json_logs import PATH_COLUMN

RECORD = "__record"


def widened(dtype: T.DataType, exact_decimals: bool = False) -> T.DataType:
    """The column type for a type found in variants.

    Values of conflicting types (found as ``variant``) and fields that are always null become text; objects and arrays among
    them their JSON text. Numbers with a fraction or beyond 64 bits become double unless ``exact_decimals``.
    """
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, widened(f.dataType, exact_decimals)) for f in dtype.fields])
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(widened(dtype.elementType, exact_decimals))
    if isinstance(dtype, (T.VariantType, T.NullType)):
        return T.StringType()
    if isinstance(dtype, T.DecimalType) and not exact_decimals:
        return T.DoubleType()
    return dtype


def variant_type(text: str) -> T.DataType:
    """The type written as ``schema_of_variant_agg`` writes it: objects are named OBJECT outside of back quotes."""
    parts = re.split(r"(`(?:[^`]|``)*`)", text)
    return T.DataType.fromDDL("".join(p if p.startswith("`") else re.sub(r"\bOBJECT<", "STRUCT<", p) for p in parts))


def _check_names(dtype: T.DataType, place: str = "$") -> None:
    if isinstance(dtype, T.ArrayType):
        _check_names(dtype.elementType, f"{place}[]")
    if isinstance(dtype, T.StructType):
        seen: dict[str, str] = {}
        for field in dtype.fields:
            other = seen.setdefault(field.name.lower(), field.name)
            if other != field.name:
                raise ValueError(f"fields {other!r} and {field.name!r} of {place} differ by case only")
            _check_names(field.dataType, f"{place}.{field.name}")


def _ddl(dtype: T.DataType) -> str:
    if isinstance(dtype, T.StructType):
        return "STRUCT<" + ", ".join(f"`{f.name.replace('`', '``')}`: {_ddl(f.dataType)}" for f in dtype.fields) + ">"
    if isinstance(dtype, T.ArrayType):
        return f"ARRAY<{_ddl(dtype.elementType)}>"
    return dtype.simpleString()


def _member(field: T.StructField) -> Column:
    """One field of the record; a name that no path can hold is taken through a struct of that field alone."""
    if field.name and not set(field.name) & set("'?"):
        return F.variant_get(RECORD, f"$['{field.name}']", _ddl(field.dataType)).alias(field.name)
    alone = F.variant_get(RECORD, "$", _ddl(T.StructType([field])))
    return alone.getField(field.name).alias(field.name)


def store_variants(df: DataFrame, text: str = "value") -> tuple[DataFrame, T.StructType]:
    """The texts of a column as stored variants, with the other columns, and the type that all of them share.

    The job that parses and stores the texts also merges their types, so the texts are read once. A text that is no JSON
    object (an object that names a member twice included) has a null record and is kept in ``_corrupt_record``; blank and
    null texts are left out, as line readers do. Without any object the type has no fields. Names that differ by case only
    raise, since columns could not tell them apart.
    """
    spark = df.sparkSession
    others = [name for name in df.columns if name != text]
    taken = {RECORD, schemas.CORRUPT_COLUMN} & set(others)
    if taken:
        raise ValueError(f"reserved column names: {sorted(taken)}")
    is_object = F.ltrim(text).startswith("{")
    record = F.when(is_object, F.try_parse_json(text))
    parsed = df.filter(F.trim(text) != "").select(*others, record.alias(RECORD), F.col(text))
    kept = parsed.select(
        *others, RECORD, F.when(F.col(RECORD).isNull(), F.col(text)).alias(schemas.CORRUPT_COLUMN)
    )
    found = Observation()
    path = scratch_path(spark, "variants")
    watched = kept.observe(found, F.schema_of_variant_agg(RECORD).alias("shape"))
    with session_conf(spark, {"spark.sql.caseSensitive": "true"}):  # else names that differ by case merge without a trace
        watched.write.option("compression", "zstd").parquet(path)
    shape = found.get["shape"]
    dtype = variant_type(shape) if shape else T.NullType()
    _check_names(dtype)
    return spark.read.schema(kept.schema).parquet(path), dtype if isinstance(dtype, T.StructType) else T.StructType([])


def typed(records: DataFrame, schema: T.StructType) -> DataFrame:
    """Stored variants with the fields of ``schema`` as columns, before the columns they came with.

    A field that a record lacks is null. Only the fields that a query uses are taken out of the variant.
    """
    names = {field.name.lower() for field in schema.fields}
    others = [name for name in records.columns if name != RECORD]
    clash = [name for name in others if name.lower() in names]
    if clash:
        raise ValueError(f"columns and fields of the records share names: {clash}")
    return records.select(*[_member(field) for field in schema.fields], *others)


def infer_json_lines(
    spark: SparkSession,
    paths: str | Sequence[str],
    glob: str | None = "*.json",
    recursive: bool = False,
    ignore_missing: bool = False,
    exact_decimals: bool = False,
) -> DataFrame:
    """JSON lines typed by what all of them hold, with ``_corrupt_record`` and the path of their file in ``__path``.

    Unlike plain inference, which reads everything twice, files are read once, and the result no longer depends on them:
    it reads the variants stored in the scratch folder. Lines may differ in shape; see ``widened`` for conflicts.
    """
    reader = spark.read
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if ignore_missing:
        reader = reader.option("ignoreMissingFiles", "true")
    lines = reader.text(paths if isinstance(paths, str) else list(paths))
    lines = lines.select("value", F.col("_metadata.file_path").alias(PATH_COLUMN))
    records, found = store_variants(lines)
    return typed(records, widened(found, exact_decimals))
