"""S1, S2 for sources that differ from the event schema: inference, drift report, tolerant reading.

Every line is parsed once into a VARIANT. ``inferred_fields`` gives the fields
that the data have with the one type that holds all values (the reference infers
on every read). ``drift_report`` compares them with the event schema, field by
field and type by type. ``read_events_open`` reads with the event schema but
keeps what does not fit it: unknown fields, values that cannot be cast, and
lines that are no JSON object. All of it is JVM expressions and one aggregation
combined before the shuffle; a result has a row per field and type.

A line with a repeated key counts as malformed; blank lines are skipped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.checkpoint import materialize_observed
from ..schema import EVENT_SCHEMA

#: JSON types that a column of the event schema takes as they are.
FITS = {"bigint": ["integer"], "double": ["number", "integer"], "string": ["string"]}
MALFORMED, EXTRA, LOST = "_malformed", "_extra", "_lost"


def read_variants(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Rows (line, fields): a line's text and its fields as a map of VARIANTs, null if it is no JSON object."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    return lines.select(F.col("value").alias("line"),
                        F.expr("try_cast(try_parse_json(value) AS MAP<STRING, VARIANT>)").alias("fields"))


def json_type(value: Column) -> Column:
    """integer, number, string, boolean, object, array or null."""
    name = F.schema_of_variant(value)
    return (F.when(name == "BIGINT", "integer").when(name.rlike("^(DECIMAL|DOUBLE|FLOAT)"), "number")
            .when(name.startswith("OBJECT"), "object").when(name.startswith("ARRAY"), "array")
            .when(name == "VOID", "null").otherwise(F.lower(name)))


def cast_exactly(value: Column, kind: str) -> Column:
    """The value as ``kind``, or null if that would change it: no fraction is cut off, no object becomes text."""
    got = F.try_variant_get(value, "$", kind)
    if kind == "bigint":
        real = F.try_variant_get(value, "$", "double")
        return F.when(json_type(value).isin("integer", "string") | (json_type(value).eqNullSafe("number")
                                                                   & (real == F.floor(real))), got)
    if kind == "double":
        return F.when(json_type(value).isin("integer", "number", "string"), got)
    return F.when(json_type(value).isin("integer", "number", "string", "boolean"), got)


def _kinds(schema: T.StructType) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in schema.fields}


def _entries(variants: DataFrame) -> DataFrame:
    return variants.where("fields IS NOT NULL").select(F.explode("fields").alias("field", "value"))


def inferred_fields(variants: DataFrame) -> DataFrame:
    """A row per field: the merged type of its values (VARIANT where they contradict) and how many lines have it."""
    return _entries(variants).groupBy("field").agg(F.schema_of_variant_agg("value").alias("merged_type"),
                                                   F.count(F.lit(1)).alias("n"))


def drift_report(variants: DataFrame, schema: T.StructType = EVENT_SCHEMA) -> DataFrame:
    """Rows (field, type, expected, n, share, status, lost) over all JSON objects of the source.

    ``status``: ok, null, absent (the lines without the field), conflict
    (another type than the schema's) or unknown (no field of the schema);
    ``lost``: how many of the conflicts no exact cast mends. One pass over the
    lines; the second step works on the counts.
    """
    kinds = _kinds(schema)
    value, field = F.col("value"), F.col("field")
    lost = F.lit(False)
    for kind in sorted(set(kinds.values())):
        of_kind = field.isin(*[f for f, k in kinds.items() if k == kind])
        lost = F.when(of_kind, cast_exactly(value, kind).isNull() & ~F.is_variant_null(value)).otherwise(lost)
    # The number of objects rides along as a field without a name.
    entries = variants.where("fields IS NOT NULL").select(F.explode(F.concat(
        F.map_entries("fields"), F.expr("array(named_struct('key', '', 'value', parse_json('null')))"))).alias("e"))
    entries = entries.select(F.nullif(F.col("e.key"), F.lit("")).alias("field"), F.col("e.value").alias("value"))
    counts = entries.groupBy("field", json_type(value).alias("type")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(lost).alias("lost"))
    counts, seen = materialize_observed(counts, "json-fields", total=F.sum(F.when(field.isNull(), F.col("n"))))
    total = seen["total"] or 0
    found = counts.where(field.isNotNull())
    expected = F.create_map(*[F.lit(x) for item in kinds.items() for x in item])
    present = found.groupBy("field").agg(F.sum("n").alias("n"))
    wanted = counts.sparkSession.range(1).select(F.explode(F.array(*[F.lit(f) for f in kinds])).alias("field"))
    absent = (wanted.join(present, "field", "left")
              .select("field", F.lit("absent").alias("type"), (F.lit(total) - F.coalesce("n", F.lit(0))).alias("n"),
                      F.lit(0).cast("long").alias("lost")).where("n > 0"))
    rows = found.unionByName(absent).withColumn("expected", F.try_element_at(expected, field))
    fits = F.lit(False)
    for kind, types in FITS.items():
        fits = F.when(F.col("expected") == kind, F.col("type").isin(*types)).otherwise(fits)
    status = (F.when(F.col("expected").isNull(), "unknown").when(F.col("type").isin("null", "absent"), F.col("type"))
              .when(fits, "ok").otherwise("conflict"))
    return rows.select("field", "type", "expected", F.col("n").cast("long").alias("n"),
                       (F.col("n") / F.lit(float(total))).alias("share"), status.alias("status"), "lost")


def read_events_open(spark: SparkSession, path: str | list[str], schema: T.StructType = EVENT_SCHEMA) -> DataFrame:
    """The schema's columns, and what is not in them, per line.

    ``_extra``: an object of the unknown fields; ``_lost``: an object of the
    known fields whose value has no exact cast (their columns are null);
    ``_malformed``: the text of a line that is no JSON object. Each is null
    where there is nothing to keep.
    """
    kinds = _kinds(schema)
    fields = F.col("fields")
    columns = [cast_exactly(F.try_element_at(fields, F.lit(f)), k).alias(f) for f, k in kinds.items()]
    known = F.array(*[F.lit(f) for f in kinds])
    extra = F.map_filter(fields, lambda k, v: ~F.array_contains(known, k))

    def unfit(k: Column, v: Column) -> Column:
        out = F.lit(False)
        for kind in sorted(set(kinds.values())):
            out = F.when(k.isin(*[f for f, x in kinds.items() if x == kind]),
                         cast_exactly(v, kind).isNull() & ~F.is_variant_null(v)).otherwise(out)
        return out

    lost = F.map_filter(fields, unfit)
    return read_variants(spark, path).select(
        *columns, F.when(F.size(extra) > 0, F.to_variant_object(extra)).alias(EXTRA),
        F.when(F.size(lost) > 0, F.to_variant_object(lost)).alias(LOST),
        F.when(fields.isNull(), F.col("line")).alias(MALFORMED))
