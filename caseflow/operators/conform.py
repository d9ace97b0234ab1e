"""Making rows and columns fit a target schema."""

from pyspark.sql import DataFrame, functions as F, types as T

from caseflow.functions.instants import iso_utc
from caseflow.schemas import INTERACTION_MODEL, MODEL_REQUIRED

UUID_TEXT = "(?i)^[0-9a-f]{8}-?[0-9a-f]{4}-?[0-9a-f]{4}-?[0-9a-f]{4}-?[0-9a-f]{12}$"


def _typed(df, field):
    """The field in its model type; NULL where the value does not fit."""
    if field.name not in df.columns:
        return F.lit(None).cast(field.dataType)
    value = F.col(field.name)
    source = df.schema[field.name].dataType
    if isinstance(field.dataType, T.MapType) and isinstance(source, T.StringType):
        return F.from_json(value, field.dataType)
    if field.name == "interaction_id":
        return F.when(value.cast("string").rlike(UUID_TEXT), value.cast("string"))
    return value.try_cast(field.dataType)


def check_model(df: DataFrame) -> DataFrame:
    """The model columns in their types, and ``rejected``: the names of the fields that do not fit.

    A field does not fit when it is required and missing, or present but not convertible.
    """
    problems = []
    for field in INTERACTION_MODEL.fields:
        missing = F.col(f"_typed.{field.name}").isNull()
        if field.name not in MODEL_REQUIRED:
            missing = missing & (
                F.col(field.name).isNotNull() if field.name in df.columns else F.lit(False))
        problems.append(F.when(missing, F.lit(field.name)))
    typed = F.struct(*[_typed(df, field).alias(field.name) for field in INTERACTION_MODEL.fields])
    return (
        df.withColumn("_typed", typed)
        .withColumn("rejected", F.array_compact(F.array(*problems)))
        .select("_typed.*", "rejected"))


def conform(df: DataFrame):
    """Split into rows that fit the interaction model and rows that do not."""
    checked = check_model(df)
    fits = F.size("rejected") == 0
    return checked.filter(fits).drop("rejected"), checked.filter(~fits)


def keep_columns(df: DataFrame, names) -> DataFrame:
    return df.select([name for name in names if name in df.columns])


def serialize_nested(df: DataFrame) -> DataFrame:
    """Nested columns become JSON text, timestamps ISO text."""
    changed = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.MapType, T.StructType, T.ArrayType)):
            changed[field.name] = F.to_json(field.name)
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            changed[field.name] = iso_utc(F.col(field.name))
    return df.withColumns(changed)


def ids_to_text(df: DataFrame, names) -> DataFrame:
    return df.withColumns({
        name: F.coalesce(F.col(name).cast("string"), F.lit("")) for name in names})


def _without_decimals(kind):
    if isinstance(kind, T.DecimalType):
        return T.DoubleType()
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_without_decimals(kind.elementType), kind.containsNull)
    if isinstance(kind, T.MapType):
        return T.MapType(
            _without_decimals(kind.keyType), _without_decimals(kind.valueType),
            kind.valueContainsNull)
    if isinstance(kind, T.StructType):
        return T.StructType([
            T.StructField(f.name, _without_decimals(f.dataType), f.nullable) for f in kind.fields])
    return kind


def decimals_to_double(df: DataFrame) -> DataFrame:
    """Decimals become doubles, also inside arrays, maps and structs."""
    return df.select([
        F.col(f.name).cast(_without_decimals(f.dataType)).alias(f.name) for f in df.schema.fields])
