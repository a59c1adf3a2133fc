"""Decoding of JSON response envelopes into typed rows."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import ENVELOPES


def envelope_type(kind, row_schema=None):
    """Schema of a whole envelope: its list of rows and its other members."""
    rows, schema, extra = ENVELOPES[kind]
    schema = row_schema or schema
    envelope = T.StructType([T.StructField(rows, T.ArrayType(T.StructType.fromDDL(schema)))])
    for name, kind_text in extra.items():
        envelope = envelope.add(name, T.StructType.fromDDL(f"x {kind_text}")["x"].dataType)
    return envelope


def malformed(column, kind, row_schema=None):
    """Whether a response is no JSON of its kind: cut short, or a member of another type."""
    schema = envelope_type(kind, row_schema).add("_corrupt", T.StringType())
    parsed = F.from_json(column, schema, {"columnNameOfCorruptRecord": "_corrupt"})
    return column.isNotNull() & (parsed.isNull() | parsed["_corrupt"].isNotNull())


def decode_envelope(df, column, kind, row_schema=None):
    """One row per element of the envelope's list: its place in the list (pos), its members and the
    envelope's other members. A malformed response raises: what it held can't be told, so nothing may pass it."""
    rows, _, extra = ENVELOPES[kind]
    text = F.col(column)
    failure = F.raise_error(F.concat(F.lit(f"{kind} response that can't be read: "), F.substring(text, 1, 200))).cast("string")
    checked = df.select(F.when(malformed(text, kind, row_schema), failure).otherwise(text).alias("_text"))
    parsed = checked.select(F.from_json("_text", envelope_type(kind, row_schema)).alias("_e")).select("_e.*")
    return parsed.select(*extra, F.posexplode(rows).alias("pos", "_row")).select("pos", "_row.*", *extra)


def unknown_members(df, column, kind):
    """Distinct envelope or row members that the schema does not name."""
    rows, schema, extra = ENVELOPES[kind]
    row_names = T.StructType.fromDDL(schema).names
    nothing = F.array().cast("array<string>")
    top = F.map_keys(F.from_json(column, "map<string,variant>"))
    elements = F.from_json(column, f"{rows} array<map<string,variant>>")[rows]
    inner = F.array_distinct(F.flatten(F.transform(elements, lambda e: F.map_keys(e))))
    names = F.concat(
        F.coalesce(F.array_except(top, F.array(*map(F.lit, (rows, *extra)))), nothing),
        F.coalesce(F.array_except(inner, F.array(*map(F.lit, row_names))), nothing),
    )
    return df.select(F.explode(names).alias("member")).distinct()
