"""The event stream: envelopes (E1-E3, K8), decode (S2), routing (W11),
normalisation into the three event tables (E4-E6), the dead-letter path
(K6) and the table layout job (K4).

All of it is column expressions over a ``(topic, key, value, timestamp)``
frame, so the same functions serve a batch frame and a streaming one.

Missing vs null (X1): values decode as ``map<string,string>``, so an absent
key and an explicit JSON null stay distinguishable (``map_contains_key``); a
typed schema would turn both into NULL. The producer's defaults apply only to
absent keys, as ``dict.get(k, default)`` does.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.exprs import iso_text, trunc_second

USER_TOPIC = "user_events"
PRODUCT_TOPIC = "product_events"
ORDER_TOPIC = "order_events"
TOPIC_NAMES = [USER_TOPIC, PRODUCT_TOPIC, ORDER_TOPIC]

# Required fields per topic (a missing or NULL one rejects the message), and
# optional ones with the default used when the key is absent.
REQUIRED = {
    USER_TOPIC: ["event_id", "timestamp", "user_id", "event_type", "page"],
    PRODUCT_TOPIC: ["event_id", "timestamp", "product_id", "event_type"],
    ORDER_TOPIC: ["event_id", "timestamp", "order_id", "event_type"],
}
JSON_DEFAULTS = {"metadata": "{}", "items": "[]"}


# --- envelopes (producer side) ----------------------------------------------------

def envelope(df: DataFrame, topic: str, key: str, fields: list[tuple[str, Column]]) -> DataFrame:
    """(topic, key, value, event_time): the value is the JSON object of ``fields`` in
    order, NULLs kept (the producer always writes every key); an empty key becomes a
    NULL key, as the producer's key serializer does. The event's time is carried
    along, so that nobody parses the message again for it."""
    body = F.to_json(F.struct(*[c.alias(n) for n, c in fields]), {"ignoreNullFields": "false"})
    return df.select(F.lit(topic).alias("topic"),
                     F.nullif(F.col(key).cast("string"), F.lit("")).alias("key"),
                     body.alias("value"), F.col("timestamp").alias("event_time"))


def _json_or(col: str, default_json: str, df: DataFrame) -> Column:
    """A nested JSON value: the column's JSON text parsed, or the default. A text that is
    no JSON gives the default; ``bad_metadata`` picks those rows out."""
    if col in df.columns:
        return F.coalesce(F.try_parse_json(F.col(col)), F.parse_json(F.lit(default_json)))
    return F.parse_json(F.lit(default_json))


def bad_metadata(df: DataFrame) -> DataFrame:
    """Producer rows whose metadata text is no JSON, to be set aside by the caller."""
    return df.filter(F.col("metadata").isNotNull() & F.try_parse_json("metadata").isNull())


# Fixed value: the namespace of this library's event ids (RFC 4122, version 5).
ID_NAMESPACE = uuid.UUID("6f1d3a52-0c7b-5e0e-9a53-2c4b8f3f7d10")
ORDINALS = 65_536


def _name_of(df: DataFrame, topic: str) -> Column:
    """A row's content as one text: topic, then each column by name with the length of its value, so that
    different rows have different names."""
    def value(field) -> Column:
        c, t = F.col(f"`{field.name}`"), field.dataType
        if isinstance(t, T.TimestampNTZType):
            return iso_text(c)
        return F.to_json(F.struct(c)) if isinstance(t, (T.ArrayType, T.MapType, T.StructType)) else c.cast("string")
    parts = [F.lit(topic)]
    for field in sorted(df.schema.fields, key=lambda f: f.name):
        v = value(field)
        parts.append(F.concat(F.lit(f";{field.name}="),
                              F.coalesce(F.concat(F.length(v).cast("string"), F.lit(":"), v), F.lit("-"))))
    return F.concat(*parts)


def uuid5(name: Column, namespace: uuid.UUID = ID_NAMESPACE) -> Column:
    """The name-based UUID (version 5) of a text, as Python's ``uuid.uuid5``."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace.hex)), F.encode(name, "UTF-8")))
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat(F.substring(digest, 1, 8), F.lit("-"), F.substring(digest, 9, 4), F.lit("-5"),
                    F.substring(digest, 14, 3), F.lit("-"), variant, F.substring(digest, 18, 3), F.lit("-"),
                    F.substring(digest, 21, 12))


def with_event_ids(df: DataFrame, topic: str) -> DataFrame:
    """An ``event_id`` made from the row's content, so a task that is run again, or a second run over the
    same input, gives the same ids. Equal rows are different events: they are counted first, in the map
    tasks, and dealt out again with an ordinal, which takes no sort and no list of the copies. Columns of
    type VARIANT cannot be compared and are not accepted."""
    last = F.col("_copies") - 1
    first = F.col("_block") * ORDINALS
    numbered = (df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("_copies"))
                .select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor(last / ORDINALS))).alias("_block"))
                .select("*", F.explode(F.sequence(first, F.least(last, first + (ORDINALS - 1)))).alias("_ordinal")))
    name = F.concat(_name_of(df, topic), F.lit("#"), F.col("_ordinal").cast("string"))
    return numbered.select(*[F.col(f"`{c}`") for c in df.columns], uuid5(name).alias("event_id"))


def _identified(df: DataFrame, topic: str) -> DataFrame:
    """The input's own ids where it has them. A stream without ids has no table to count copies in: its
    rows get random ids, or ids of their own micro-batch inside ``foreachBatch``."""
    if "event_id" in df.columns:
        return df.withColumn("event_id", F.col("event_id").cast("string"))
    return df.withColumn("event_id", F.expr("uuid()")) if df.isStreaming else with_event_ids(df, topic)


def _opt(df: DataFrame, name: str, type_name: str = "string") -> Column:
    return F.col(name).cast(type_name) if name in df.columns else F.lit(None).cast(type_name)


def user_event_envelopes(df: DataFrame) -> DataFrame:
    """E1. ``df``: event_id, timestamp, user_id, event_type, page and optional
    session_id, user_agent, ip_address, metadata (JSON text)."""
    df = _identified(df, USER_TOPIC)
    fields = [("event_id", F.col("event_id")),
              ("timestamp", iso_text(F.col("timestamp"))),
              ("user_id", F.col("user_id").cast("string")),
              ("event_type", F.col("event_type")),
              ("page", F.col("page")),
              ("session_id", _opt(df, "session_id")),
              ("user_agent", _opt(df, "user_agent")),
              ("ip_address", _opt(df, "ip_address")),
              ("metadata", _json_or("metadata", "{}", df))]
    return envelope(df.withColumn("_key", F.col("user_id").cast("string")), USER_TOPIC, "_key",
                    fields)


def product_event_envelopes(df: DataFrame, omit_quantity: Column | None = None) -> DataFrame:
    """E2 (quantity defaults to 1 when the column is absent). ``omit_quantity``
    marks rows whose message leaves the quantity key out altogether."""
    df = _identified(df, PRODUCT_TOPIC)
    qty = F.col("quantity").cast("int") if "quantity" in df.columns else F.lit(1)
    base = [("event_id", F.col("event_id")),
            ("timestamp", iso_text(F.col("timestamp"))),
            ("product_id", F.col("product_id").cast("string")),
            ("event_type", F.col("event_type")),
            ("user_id", _opt(df, "user_id"))]
    tail = [("price", _opt(df, "price", "double")),
            ("category_id", _opt(df, "category_id")),
            ("metadata", _json_or("metadata", "{}", df))]
    keyed = df.withColumn("_key", F.col("product_id").cast("string"))
    if omit_quantity is None:
        return envelope(keyed, PRODUCT_TOPIC, "_key", base + [("quantity", qty)] + tail)
    with_q = F.to_json(F.struct(*[c.alias(n) for n, c in base + [("quantity", qty)] + tail]),
                       {"ignoreNullFields": "false"})
    without_q = F.to_json(F.struct(*[c.alias(n) for n, c in base + tail]),
                          {"ignoreNullFields": "false"})
    return keyed.select(F.lit(PRODUCT_TOPIC).alias("topic"),
                        F.nullif(F.col("_key"), F.lit("")).alias("key"),
                        F.when(omit_quantity, without_q).otherwise(with_q).alias("value"),
                        F.col("timestamp").alias("event_time"))


def order_event_envelopes(df: DataFrame) -> DataFrame:
    """E3. ``items`` is an array of structs (or absent -> [])."""
    df = _identified(df, ORDER_TOPIC)
    items = F.col("items") if "items" in df.columns else F.array()
    fields = [("event_id", F.col("event_id")),
              ("timestamp", iso_text(F.col("timestamp"))),
              ("order_id", F.col("order_id").cast("string")),
              ("event_type", F.col("event_type")),
              ("user_id", _opt(df, "user_id")),
              ("total_amount", _opt(df, "total_amount", "double")),
              ("items", items),
              ("payment_method", _opt(df, "payment_method")),
              ("metadata", _json_or("metadata", "{}", df))]
    return envelope(df.withColumn("_key", F.col("order_id").cast("string")), ORDER_TOPIC, "_key",
                    fields)


# --- decode, route, normalise (consumer side) -------------------------------------

def decode(raw: DataFrame) -> DataFrame:
    """Add ``m`` = the value as ``map<string,string>`` and ``v`` = the same as a
    VARIANT, which knows each field's JSON type; both NULL if malformed. Nested objects
    and arrays come back in ``m`` as their JSON text.

    Malformed is what a strict parser refuses, a repeated key, anything behind the closing
    brace, and a value that is no object. The value is parsed as the first element of a list whose
    second is a mark drawn for this query: what stands behind the brace either breaks the list or takes
    the mark's place, and no message can know the mark. So the text is one JSON value, and an object if it
    begins with a brace.

    Both come out of a one-element ``explode`` (one row out per row in). A filter on
    a generated column is not pushed below the generator, so Catalyst cannot inline the
    parsers into every branch of the validity test: each message is parsed once for the
    values and once for the types."""
    text = F.col("value").cast("string")
    mark = uuid.uuid4().hex
    wrapped = F.try_parse_json(F.concat(F.lit("["), text, F.lit(f',"{mark}"]')))
    parsed = raw.select("*", F.explode(F.array(F.struct(
        F.from_json(text, "map<string,string>").alias("m"), wrapped.alias("w")))).alias("j"))
    body = F.try_variant_get(F.col("j.w"), "$[0]", "variant")
    whole = ((F.try_variant_get(F.col("j.w"), "$[1]", "string") == F.lit(mark))
             & F.ltrim(text, F.lit(" \t\r\n")).startswith("{"))
    checked = parsed.select(*raw.columns, F.explode(F.array(F.struct(
        F.when(whole, F.col("j.m")).alias("m"), F.when(whole, body).alias("v")))).alias("k"))
    return checked.select(*raw.columns, "k.m", "k.v")


def _has(key: str) -> Column:
    return F.map_contains_key(F.col("m"), F.lit(key))


def _get(key: str) -> Column:
    return F.col("m").getItem(key)


def _is(key: str, *types: str) -> Column:
    """The field's JSON type is one of ``types`` (prefixes of its SQL name)."""
    found = F.schema_of_variant(F.try_variant_get(F.col("v"), f"$.{key}", "variant"))
    test = F.lit(False)
    for t in types:
        test = test | found.startswith(t)
    return F.coalesce(test, F.lit(False))


NUMBER = ("BIGINT", "DECIMAL", "DOUBLE")
# Fields that hold text when they are there and not null.
TEXT_FIELDS = {
    USER_TOPIC: ["event_id", "timestamp", "user_id", "event_type", "page", "session_id",
                 "user_agent", "ip_address"],
    PRODUCT_TOPIC: ["event_id", "timestamp", "product_id", "event_type", "user_id", "category_id"],
    ORDER_TOPIC: ["event_id", "timestamp", "order_id", "event_type", "user_id", "payment_method"],
}


def _ts(key: str = "timestamp") -> Column:
    """ISO text -> TIMESTAMP_NTZ truncated to the second (a DateTime column). A text
    with a zone is that moment in UTC; one without is taken as it stands."""
    zoned = _get(key).rlike("(Z|[+-][0-9]{2}:?[0-9]{2})$")
    moment = F.expr(f"timestampadd(MICROSECOND, unix_micros(try_cast(m['{key}'] AS TIMESTAMP)), "
                    "TIMESTAMP_NTZ'1970-01-01 00:00:00')")
    return trunc_second(F.when(zoned, moment)
                        .otherwise(F.expr(f"try_cast(m['{key}'] AS TIMESTAMP_NTZ)")))


def _nested(key: str) -> Column:
    """``json.dumps(event.get(key, default))``: an absent key gives the
    default, an explicit null gives ``null``."""
    return (F.when(_has(key), F.coalesce(_get(key), F.lit("null")))
             .otherwise(F.lit(JSON_DEFAULTS[key])))


def _reason(topic: str) -> Column:
    """The first reason a message of ``topic`` cannot be stored, or NULL."""
    reason = F.when(F.col("m").isNull(), F.lit("malformed_json"))
    for key in REQUIRED[topic]:
        reason = reason.when(~_has(key), F.lit(f"missing_field:{key}"))
        reason = reason.when(_get(key).isNull(), F.lit(f"null_field:{key}"))
    for key in TEXT_FIELDS[topic]:
        reason = reason.when(_get(key).isNotNull() & ~_is(key, "STRING"), F.lit(f"bad_type:{key}"))
    reason = reason.when(_ts().isNull(), F.lit("bad_timestamp"))
    if topic == PRODUCT_TOPIC:
        reason = reason.when(_has("quantity") & _get("quantity").isNull(),
                             F.lit("null_field:quantity"))
        reason = reason.when(_has("quantity")
                             & (F.expr("try_cast(m['quantity'] AS INT)").isNull()
                                | ~_is("quantity", "BIGINT")),
                             F.lit("bad_quantity"))
        reason = reason.when(_get("price").isNotNull()
                             & ~_is("price", *NUMBER),
                             F.lit("bad_price"))
    if topic == ORDER_TOPIC:
        reason = reason.when(_get("total_amount").isNotNull()
                             & ~_is("total_amount", *NUMBER),
                             F.lit("bad_total_amount"))
    return reason


def _normalised_columns(topic: str) -> list[Column]:
    if topic == USER_TOPIC:
        return [_get("event_id").alias("event_id"), _ts().alias("timestamp"),
                _get("user_id").alias("user_id"), _get("event_type").alias("event_type"),
                _get("page").alias("page"), _get("session_id").alias("session_id"),
                _get("user_agent").alias("user_agent"), _get("ip_address").alias("ip_address"),
                _nested("metadata").alias("metadata")]
    if topic == PRODUCT_TOPIC:
        qty = F.when(_has("quantity"), F.expr("try_cast(m['quantity'] AS INT)")).otherwise(F.lit(1))
        return [_get("event_id").alias("event_id"), _ts().alias("timestamp"),
                _get("product_id").alias("product_id"), _get("event_type").alias("event_type"),
                _get("user_id").alias("user_id"), qty.alias("quantity"),
                F.expr("try_cast(m['price'] AS DOUBLE)").alias("price"),
                _get("category_id").alias("category_id"), _nested("metadata").alias("metadata")]
    return [_get("event_id").alias("event_id"), _ts().alias("timestamp"),
            _get("order_id").alias("order_id"), _get("event_type").alias("event_type"),
            _get("user_id").alias("user_id"),
            F.expr("try_cast(m['total_amount'] AS DOUBLE)").alias("total_amount"),
            _nested("items").alias("items"), _get("payment_method").alias("payment_method"),
            _nested("metadata").alias("metadata")]


def with_reason(raw: DataFrame) -> DataFrame:
    """Decode and tag every message with its rejection reason (NULL = valid).
    Messages of other topics get ``reason = 'unknown_topic'``; the reference's
    consumer skips them without an error, and so does routing."""
    decoded = decode(raw)
    reason = F.lit("unknown_topic")
    for topic in reversed(TOPIC_NAMES):
        reason = F.when(F.col("topic") == topic, _reason(topic)).otherwise(reason)
    return decoded.withColumn("reason", reason)


def normalise(raw: DataFrame, topic: str) -> DataFrame:
    """The valid messages of ``topic`` as rows of its event table.

    The validity test is NULL-safe (``reason IS NULL`` is never NULL), so a
    message is either stored here or in the dead-letter table, never lost."""
    # Only this topic's checks: a third of the expression the router needs,
    # so less generated code to compile per query.
    tagged = decode(raw.filter(F.col("topic") == topic)).withColumn("reason", _reason(topic))
    schema = schemas.TOPICS[topic][1]
    rows = tagged.filter(F.col("reason").isNull()).select(*_normalised_columns(topic))
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def dead_letter(raw: DataFrame) -> DataFrame:
    """K6: messages of the three topics that cannot be stored, with a reason."""
    tagged = with_reason(raw.filter(F.col("topic").isin(*TOPIC_NAMES)))
    return (tagged.filter(F.col("reason").isNotNull())
            .select("topic", "key", F.col("value").cast("string").alias("value"), "timestamp",
                    "reason"))


def routed(raw: DataFrame, topics: list[str]) -> DataFrame:
    """Every message of ``topics`` parsed once, ready to be stored: ``destination`` (its topic, or
    ``dead_letter``) and one struct per destination, filled where the row goes there."""
    tagged = with_reason(raw.filter(F.col("topic").isin(*topics)))
    good = F.col("reason").isNull()
    bad = F.struct("topic", "key", F.col("value").cast("string").alias("value"), "timestamp", "reason")
    return tagged.select(
        F.when(good, F.col("topic")).otherwise("dead_letter").alias("destination"),
        *[F.when(good & (F.col("topic") == t), F.struct(*_normalised_columns(t))).alias(t) for t in topics],
        F.when(~good, bad).alias("dead_letter"))


def stored_columns(topic: str) -> list[Column]:
    """The topic's struct of ``routed`` as columns in the types and order of its event table."""
    return [F.col(f"{topic}.{f.name}").cast(f.dataType).alias(f.name) for f in schemas.TOPICS[topic][1].fields]


def routed_counts(raw: DataFrame) -> DataFrame:
    """Rows per destination (three tables, dead letter, ignored topics)."""
    tagged = with_reason(raw)
    dest = (F.when(F.col("reason") == "unknown_topic", F.lit("ignored"))
             .when(F.col("reason").isNotNull(), F.lit("dead_letter"))
             .otherwise(F.col("topic")))
    return tagged.groupBy(dest.alias("destination")).agg(F.count(F.lit(1)).alias("rows"))


def event_layout(events: DataFrame, topic: str) -> DataFrame:
    """K4: the stored order of an event table: rows of one day and hour together,
    sorted by (timestamp, entity id) inside each file, with an ``event_date``
    partition column. Parquet row-group min/max statistics then prune scans on
    time and entity. A streaming query cannot sort, so this is the batch
    compaction of landed files."""
    sort_keys = list(schemas.TOPICS[topic][2])
    dated = (events.withColumn("event_date", F.to_date("timestamp"))
             .withColumn("_hour", F.hour("timestamp")))
    # Hours are rebalanced by size: a large hour is cut into several tasks, small ones share one. A range
    # partitioning would run its input twice, once for the bounds.
    return (dated.hint("rebalance", F.col("event_date"), F.col("_hour")).drop("_hour")
            .sortWithinPartitions("event_date", *sort_keys))


def event_file_options(topic: str, row_group_bytes: int = 32 * 1024 * 1024) -> dict[str, str]:
    """Parquet options of an event table: row groups small enough that the time bounds of a sorted file
    cut a day finely, and Bloom filters on the ids, which are spread over all times, so that a lookup of an
    event or an entity reads the row groups that may hold it. Event ids are unique: no dictionary.
    (Entity ids that repeat keep theirs, which prunes exactly; a filter is written where one overflows.)"""
    ids = ["event_id", *[f.name for f in schemas.TOPICS[topic][1].fields if f.name in ENTITY_IDS]]
    options = {"parquet.block.size": str(row_group_bytes), "parquet.enable.dictionary#event_id": "false",
               "parquet.bloom.filter.adaptive.enabled": "true"}
    options.update({f"parquet.bloom.filter.enabled#{c}": "true" for c in ids})
    return options


ENTITY_IDS = ("user_id", "product_id", "order_id")
