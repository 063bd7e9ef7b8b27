"""What landed against the declared schema.

Reads go by the declared schema, so a field it does not have vanishes, one of another type is turned
to text and one that is gone becomes NULL, all without a word. Here the lines are read as text, their
fields and types are taken as they are, and what differs is counted per landing hour.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from adpulse.functions.days import Day
from adpulse.model import EVENT_SCHEMA
from adpulse.sources.landing import PLAIN, Layout, hour_of_path, paths_of

#: What a line of a declared type looks like in JSON.
JSON_TYPES = {"string": "STRING", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN"}
HOUR = ("landing_date", "landing_hour")


def landed_lines(
    spark: SparkSession,
    base: str,
    days: list[Day] | None = None,
    layout: Layout = PLAIN,
    allow_missing: bool = False,
) -> DataFrame:
    """``landing_date, landing_hour, value``: the lines of some landing days, or of all."""
    dirs = None if days is None else [layout.day_dir(day) for day in days]
    paths = base if dirs is None else paths_of(base, dirs, allow_missing)
    date, hour = hour_of_path(F.col("_metadata.file_path"), layout)
    lines = spark.read.option("recursiveFileLookup", "true").text(paths)
    return lines.select(date.alias("landing_date"), hour.alias("landing_hour"), "value")


def fields_seen(lines: DataFrame) -> DataFrame:
    """``landing_date, landing_hour, field, seen, lines``: the fields of the lines' objects and the
    JSON type of each, ``OBJECT`` and ``ARRAY`` without what is in them, null for a null. Lines that
    are no object have a null field."""
    spark = lines.sparkSession
    parsed = lines.select(*HOUR, F.try_parse_json("value").alias("line"))
    is_object = F.schema_of_variant("line").startswith("OBJECT")
    parsed = parsed.select(*HOUR, F.when(is_object, F.col("line")).alias("line"))
    fields = parsed.lateralJoin(
        spark.tvf.variant_explode_outer(F.col("line").outer()), how="left"
    )
    kind = F.substring_index(F.schema_of_variant("value"), "<", 1)
    # An object without fields has none missing from it that a null field could stand for.
    empty = F.col("line").isNotNull() & F.col("key").isNull()
    return (
        fields.select(
            *HOUR,
            F.when(empty, "").otherwise(F.col("key")).alias("field"),
            F.when(kind != "VOID", F.regexp_replace(kind, r"\(.*", "")).alias("seen"),
        )
        .groupBy(*HOUR, "field", "seen")
        .agg(F.count("*").alias("lines"))
    )


def schema_drift(
    spark: SparkSession,
    base: str,
    days: list[Day] | None = None,
    layout: Layout = PLAIN,
    declared: StructType = EVENT_SCHEMA,
    allow_missing: bool = False,
) -> DataFrame:
    """``landing_date, landing_hour, field, seen, problem, lines``: per landing hour the fields that
    are ``unknown`` or of another ``type`` than declared, in how many lines a declared field is
    ``missing`` or null, and how many lines are ``unparsable``."""
    rows = fields_seen(landed_lines(spark, base, days, layout, allow_missing))
    types = {field.name: JSON_TYPES.get(field.dataType.simpleString(), "") for field in declared}
    expected = F.create_map(*[F.lit(part) for pair in types.items() for part in pair])
    name = F.col("field")
    problem = (
        F.when(name.isNull(), "unparsable")
        .when(name == "", F.lit(None))
        .when(~name.isin(*types), "unknown")
        .when(F.col("seen").isNotNull() & (F.col("seen") != expected[name]), "type")
    )
    found = rows.withColumn("problem", problem).where("problem is not null")
    # Of every hour's objects, those that do not have a declared field with a value.
    any_field = declared.names[0]
    have = rows.where(F.col("seen").isNotNull() & name.isin(*types))
    lines = landed_lines(spark, base, days, layout, allow_missing).select(
        *HOUR, F.schema_of_variant(F.try_parse_json("value")).startswith("OBJECT").alias("object")
    )
    objects = lines.where("object").groupBy(*HOUR).agg(F.count("*").alias("objects"))
    each = objects.select(*HOUR, "objects", F.explode(F.array(*map(F.lit, types))).alias("field"))
    counted = have.groupBy(*HOUR, "field").agg(F.sum("lines").alias("lines"))
    missing = each.join(counted, [*HOUR, "field"], "left").select(
        *HOUR,
        "field",
        F.lit(None).cast(StringType()).alias("seen"),
        F.lit("missing").alias("problem"),
        (F.col("objects") - F.coalesce("lines", F.lit(0))).alias("lines"),
    )
    columns = [*HOUR, "field", "seen", "problem", "lines"]
    return found.select(*columns).unionByName(missing.where("lines > 0"))
