"""JSON messages to declared columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tableload.functions.convert import with_policy
from tableload.functions.types import ColSchema
from tableload.operators.conform import quoted

# Columns that tell one message from another.
DEDUPE_KEYS = ("_topic", "_partition", "_offset", "_timestamp")
REST_COLUMN = "_rest"
REJECTED = "_rejected"


def parse_messages(
    messages: DataFrame,
    cols: Sequence[ColSchema],
    rest: bool = False,
    dedupe_keys: bool = True,
    value: str = "value",
    on_error: str | None = None,
) -> DataFrame:
    """Declared fields of each JSON object in ``value``; rows without a JSON object are left out.

    ``rest`` adds the undeclared fields as a map to text, ``dedupe_keys`` keeps the message position.
    """
    text = quoted(value).cast("string")
    keys = [k for k in DEDUPE_KEYS if k in messages.columns] if dedupe_keys else []
    # as a generator the text is parsed once, and rows without an object fall out
    objects = F.filter(F.array(F.try_parse_json(text)), lambda o: o.isNotNull())
    kept = [text.alias("_text"), *[quoted(k) for k in keys]]
    parsed = messages.filter(_begins_object(text)).select(F.explode(objects).alias("_object"), *kept)
    # one extraction per field, then its conversion
    fields = [
        F.try_variant_get("_object", f"$['{c.name}']", "variant").alias(f"_field_{i}") for i, c in enumerate(cols)
    ]
    parsed = parsed.select(*fields, "_text", *[quoted(k) for k in keys])
    out = [
        F.expr(with_policy(f"_field_{i}", T.VariantType(), c, on_error)).alias(c.name) for i, c in enumerate(cols)
    ]
    if rest:
        declared = [c.name for c in cols]
        members = F.from_json("_text", T.MapType(T.StringType(), T.StringType()))
        out.append(F.map_filter(members, lambda k, v: ~k.isin(declared)).alias(REST_COLUMN))
    return parsed.select(*out, *[quoted(k) for k in keys])


def _begins_object(text: Column) -> Column:
    """Of valid JSON texts, exactly the objects begin with a brace."""
    return F.coalesce(F.ltrim(text, F.lit(" \t\r\n")).startswith("{"), F.lit(False))


def bad_messages(messages: DataFrame, value: str = "value") -> DataFrame:
    """Messages that ``parse_messages`` leaves out, whole."""
    text = quoted(value).cast("string")
    return messages.filter(~_begins_object(text) | F.try_parse_json(text).isNull())


def quarantined(messages: DataFrame, cols: Sequence[ColSchema], value: str = "value") -> DataFrame:
    """Every message once: the declared columns, its position, and ``_reason`` (null: none) why it cannot be loaded.

    Reasons are that the text is no JSON object, that declared columns hold values without a form in their type, or that
    required ones are missing; columns are named in declared order. The text of such a message is in ``_rejected``.
    """
    text = quoted(value).cast("string")
    keys = [quoted(k) for k in DEDUPE_KEYS if k in messages.columns]
    held = messages.select(F.when(_begins_object(text), F.try_parse_json(text)).alias("_object"), text.alias("_text"), *keys)
    fields = [F.try_variant_get("_object", f"$['{c.name}']", "variant").alias(f"_field_{i}") for i, c in enumerate(cols)]
    held = held.select(*fields, F.col("_object").isNotNull().alias("_is_object"), "_text", *keys)
    values = [F.expr(with_policy(f"_field_{i}", T.VariantType(), c, "null")).alias(c.name) for i, c in enumerate(cols)]
    out = held.select(*values, *[f"_field_{i}" for i in range(len(cols))], "_is_object", "_text", *keys)
    faults = []
    for i, col in enumerate(cols):
        given = F.col(f"_field_{i}").isNotNull() & ~F.coalesce(F.is_variant_null(f"_field_{i}"), F.lit(False))
        lost = quoted(col.name).isNull()
        faults.append(F.when(given & lost, f"{col.name}: no {col.data_type}").when(lost & F.lit(col.required), f"{col.name}: missing"))
    reason = F.when(~F.col("_is_object"), "no JSON object").otherwise(F.nullif(F.concat_ws(", ", *faults), F.lit("")))
    out = out.withColumn("_reason", reason).withColumn(REJECTED, F.when(F.col("_reason").isNotNull(), F.col("_text")))
    return out.drop(*[f"_field_{i}" for i in range(len(cols))], "_is_object", "_text")


def dedupe_messages(df: DataFrame, keys: Sequence[str], watermark: tuple[str, str] | None = None) -> DataFrame:
    """One row per message position. Copies are dropped before the shuffle, so a hot key stays small.

    On a stream the state is bounded by ``watermark`` = (event time column, delay).
    """
    if df.isStreaming:
        if watermark is None:
            raise ValueError("a stream needs a watermark to de-duplicate")
        return df.withWatermark(*watermark).dropDuplicatesWithinWatermark(list(keys))
    return df.dropDuplicates(list(keys))
