"""JSON-lines source and sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheaf.sources.schemas import SCHEMAS


def read_json(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None,
              mode: str = "PERMISSIVE") -> DataFrame:
    """Read JSON lines with a declared schema.

    Without a schema Spark infers one, which costs a full pass over the input and adds a
    ``_corrupt_record`` column for malformed lines; with a schema, malformed lines become null rows.
    """
    reader = spark.read.option("mode", mode)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def read_table(spark: SparkSession, name: str, path: str | list[str]) -> DataFrame:
    """Read one of the six workload tables with its declared schema.

    Business records may hold ``attributes`` and ``hours`` as flat dotted fields or as nested objects;
    both give the flat columns.
    """
    schema = SCHEMAS[name]
    parents = sorted({f.name.split(".")[0] for f in schema.fields if "." in f.name})
    if not parents:
        return read_json(spark, path, schema)
    nested = [T.StructField(p, T.StructType([T.StructField(f.name.split(".", 1)[1], f.dataType)
                                             for f in schema.fields if f.name.startswith(p + ".")]))
              for p in parents]
    df = read_json(spark, path, T.StructType([*schema.fields, *nested]))
    return df.select([F.coalesce(F.col(f"`{f.name}`"), F.col(f.name)).alias(f.name)
                      if "." in f.name else F.col(f"`{f.name}`") for f in schema.fields])


def read_json_checked(spark: SparkSession, path: str | list[str], schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of JSON lines, so that no line turns into nulls unseen.

    A line is parsed once, as a variant. ``rows`` are the objects, with the schema's fields and ``drifted``, the names of
    fields that are there with a value that does not fit their type (the field itself is null). ``rejects`` are the
    other lines that are not blank, as text, with the ``reason``: ``malformed`` (no JSON) or ``not an object``. What follows
    a complete value on a line is not looked at (Spark's parser ends there).
    """
    lines = spark.read.text(path).filter(F.trim("value") != "").select("value", F.try_parse_json("value").alias("v"))
    kind = F.schema_of_variant("v")
    lines = lines.withColumn("reason", F.when(F.col("v").isNull(), "malformed")
                             .when(~kind.startswith("OBJECT"), "not an object"))
    at = {f.name: "$['" + f.name + "']" for f in schema.fields}
    value = {f.name: F.try_variant_get("v", at[f.name], f.dataType.simpleString()) for f in schema.fields}
    off = [F.when(F.try_variant_get("v", at[n], "variant").isNotNull() & ~F.is_variant_null(
        F.try_variant_get("v", at[n], "variant")) & c.isNull(), F.lit(n)) for n, c in value.items()]
    rows = lines.filter("reason IS NULL").select(*[c.alias(n) for n, c in value.items()],
                                                 F.array_compact(F.array(*off)).alias("drifted"))
    return rows, lines.filter("reason IS NOT NULL").select("value", "reason")


def flatten_structs(df: DataFrame, sep: str = ".") -> DataFrame:
    """Struct fields as top-level columns named ``parent<sep>child`` (recursively), in one projection.

    Nested records (``attributes: {RestaurantsTakeOut: ...}``) become the flat dotted names the
    workload expects (``attributes.RestaurantsTakeOut``); other columns pass through.
    """
    def walk(prefix: list[str], dtype: T.DataType):
        if isinstance(dtype, T.StructType):
            for f in dtype.fields:
                yield from walk(prefix + [f.name], f.dataType)
        else:
            yield prefix

    cols = []
    for f in df.schema.fields:
        for path in walk([f.name], f.dataType):
            ref = ".".join(f"`{p}`" for p in path)
            cols.append(F.col(ref).alias(sep.join(path)))
    return df.select(cols)


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    df.write.mode(mode).json(path)
    return path
