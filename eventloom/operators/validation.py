"""Record validation: input columns plus ``is_valid`` and ``errors``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the registered UserEvent schema.
EVENT_ENUM = ("LOGIN", "LOGOUT", "PURCHASE", "VIEW", "CLICK")
REQUIRED = ("user_id", "event_type", "timestamp")
OPTIONAL = ("properties", "session_id", "user_agent")


def with_rules(df: DataFrame, rules: Sequence[tuple[str, Column]]) -> DataFrame:
    """``rules``: (name, condition that holds on a valid row); unknown means broken."""
    # array_remove, unlike array_compact, is compiled, and so are the rules inside it.
    broken = [F.when(F.coalesce(ok, F.lit(False)), "").otherwise(name) for name, ok in rules]
    return df.withColumn("errors", F.array_remove(F.array(*broken), "")).withColumn(
        "is_valid", F.size("errors") == 0
    )


def validate_json_syntax(df: DataFrame, column: str = "value") -> DataFrame:
    return with_rules(df, [("not_json", F.try_parse_json(F.col(column)).isNotNull())])


def _type_of(document: Column, name: str) -> Column:
    """Type name of a top-level field; NULL when absent, VOID for a JSON null."""
    return F.schema_of_variant(F.try_variant_get(document, f"$.{name}", "variant"))


def _text_of(document: Column, name: str) -> Column:
    return F.try_variant_get(document, f"$.{name}", "string")


def _nullable_text(document: Column, keys: Column, name: str) -> Column:
    absent = ~F.array_contains(keys, name)
    return absent | F.coalesce(_type_of(document, name), F.lit("VOID")).isin("STRING", "VOID")


def _entries(document: Column, path: str) -> Column:
    """The fields of an object; NULL for anything else."""
    return F.try_variant_get(document, path, "map<string,variant>")


def validate_json_schema(df: DataFrame, column: str = "value") -> DataFrame:
    """The UserEvent JSON Schema: required fields, types, enum, and no further properties."""
    doc, keys = F.col("_doc"), F.col("_keys")
    known = F.array(*[F.lit(n) for n in (*REQUIRED, *OPTIONAL)])
    time_type = _type_of(doc, "timestamp")
    number = F.try_variant_get(doc, "$.timestamp", "decimal(38,6)")
    whole = (time_type == "BIGINT") | (time_type.startswith("DECIMAL") & (F.floor(number) == number))
    entries = _entries(doc, "$.properties")
    each_text = F.forall(
        F.map_values(entries), lambda v: F.coalesce(F.schema_of_variant(v), F.lit("")) == "STRING"
    )
    # Plain keys with text values show in the type's name; only other objects are opened.
    properties_type = F.coalesce(_type_of(doc, "properties"), F.lit(""))
    text_values = F.when(
        properties_type.rlike("^OBJECT<(\\w+: STRING(, \\w+: STRING)*)?>$"), True
    ).otherwise(each_text)
    no_properties = ~F.array_contains(keys, "properties")
    is_object = properties_type.startswith("OBJECT")
    rules = [
        ("not_json", doc.isNotNull()),
        ("not_object", keys.isNotNull()),
        *[(f"missing_{n}", F.array_contains(keys, n)) for n in REQUIRED],
        ("user_id", (_type_of(doc, "user_id") == "STRING") & (F.length(_text_of(doc, "user_id")) >= 1)),
        (
            "event_type",
            (_type_of(doc, "event_type") == "STRING") & _text_of(doc, "event_type").isin(*EVENT_ENUM),
        ),
        ("timestamp", whole & (number >= 0)),
        ("properties", no_properties | (is_object & text_values)),
        ("session_id", _nullable_text(doc, keys, "session_id")),
        ("user_agent", _nullable_text(doc, keys, "user_agent")),
        ("additional_properties", F.size(F.array_except(keys, known)) == 0),
    ]
    parsed = df.withColumn("_doc", F.try_parse_json(F.col(column))).withColumn(
        "_keys", F.map_keys(_entries(doc, "$"))
    )
    return with_rules(parsed, rules).drop("_doc", "_keys")


def validate_business_rules(df: DataFrame, column: str = "value") -> DataFrame:
    """Stricter than the schema at zero: ``timestamp > 0`` and a user id."""
    doc = F.try_parse_json(F.col(column))
    return with_rules(
        df,
        [
            ("timestamp", F.try_variant_get(doc, "$.timestamp", "bigint") > 0),
            ("user_id", _text_of(doc, "user_id").isNotNull()),
        ],
    )


def _filled(name: str) -> Column:
    return F.length(F.col(name)) > 0


def validate_csv(df: DataFrame) -> DataFrame:
    return with_rules(
        df,
        [
            ("user_id", _filled("user_id")),
            ("event_type", _filled("event_type")),
            ("timestamp", F.col("timestamp").rlike("^[0-9]+$")),
        ],
    )


def validate_fields(df: DataFrame, corrupt: str | None = None) -> DataFrame:
    """Field rules on typed columns (XML, Avro, Protobuf); ``corrupt`` names the raw bad record."""
    rules = [
        ("user_id", _filled("user_id")),
        ("event_type", F.col("event_type").isin(*EVENT_ENUM)),
        ("timestamp", F.col("timestamp").try_cast("bigint") >= 0),
    ]
    if corrupt:
        rules.insert(0, ("malformed", F.col(corrupt).isNull()))
    return with_rules(df, rules)


def rollup(validated: DataFrame, record_format: str) -> DataFrame:
    m = validated.agg(F.count(F.lit(1)).alias("total"), F.count_if("is_valid").alias("valid"))
    share = F.col("valid") / F.nullif(F.col("total"), F.lit(0)) * 100
    return m.select(
        F.lit(record_format).alias("format"),
        "total",
        "valid",
        (F.col("total") - F.col("valid")).alias("invalid"),
        share.alias("valid_pct"),
    )


def error_counts(validated: DataFrame) -> DataFrame:
    return (
        validated.select(F.explode("errors").alias("error"))
        .groupBy("error")
        .agg(F.count(F.lit(1)).alias("records"))
    )
