"""Message envelopes derived from the driver tables.

Each is a ``DataFrame -> DataFrame`` projection, so it applies to a batch
read and to a file stream of the same table alike. ``value`` is binary, as
the Kafka source delivers it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

# Topic names and the number of Kafka partitions of each
# derived topic.
CUSTOMER_TOPIC = "inputTopic"
CUSTOMER_PARTITIONS = 4
EVENTS_TOPIC = "events"
EVENTS_PARTITIONS = 3
DOCUMENTS_TOPIC = "documents"
DOCUMENTS_PARTITIONS = 8


def _envelope(df: DataFrame, topic: str, partition: str, offset: str, value: str, timestamp: str | None = None) -> DataFrame:
    """Kafka-source columns from SQL expression text over ``df``'s columns."""
    return df.selectExpr(
        "CAST(NULL AS BINARY) AS key",
        f"CAST({value} AS BINARY) AS value",
        f"'{topic}' AS topic",
        f"CAST({partition} AS INT) AS `partition`",
        f"CAST({offset} AS BIGINT) AS `offset`",
        f"CAST({timestamp or 'NULL'} AS TIMESTAMP) AS `timestamp`",
        "0 AS timestampType",
    )


# Fixed value: the customer message payload (same SQL as the DuckDB oracle).
_CUSTOMER_GOOD = """concat('{"id":"', CAST(c_custkey AS STRING), '","name":"', c_name,
    '","firstName":"', c_mktsegment, '"',
    CASE WHEN c_acctbal >= 0 THEN concat(',"lastName":"N', CAST(c_nationkey AS STRING), '"') ELSE '' END,
    '}')"""
_CUSTOMER_VALUE = f"""CASE c_custkey % 20
    WHEN 3 THEN 'not json' WHEN 7 THEN '' WHEN 11 THEN 'null'
    WHEN 13 THEN '{{"id":{{"a":1}}}}' WHEN 17 THEN concat({_CUSTOMER_GOOD}, ' x')
    ELSE {_CUSTOMER_GOOD} END"""


def customer_envelope(customer: DataFrame) -> DataFrame:
    """One message per customer: an employee-shaped JSON record, with a
    deterministic share of broken payloads (garbage, empty, JSON null,
    nested field, trailing text) so every reject path is exercised.
    ``lastName`` is absent when the balance is negative."""
    return _envelope(
        customer,
        CUSTOMER_TOPIC,
        f"c_custkey % {CUSTOMER_PARTITIONS}",
        f"floor(c_custkey / {CUSTOMER_PARTITIONS})",
        _CUSTOMER_VALUE,
    )


def customer_bytes_envelope(customer: DataFrame) -> DataFrame:
    """The customer messages as raw bytes: some are tombstones (null value)
    and some carry a stray invalid UTF-8 byte before the JSON."""
    env = customer_envelope(customer)
    return env.selectExpr(
        "key",
        f"""CASE (`offset` * {CUSTOMER_PARTITIONS} + `partition`) % 20
              WHEN 1 THEN CAST(NULL AS BINARY)
              WHEN 19 THEN concat(unhex('FF'), value)
              ELSE value END AS value""",
        "topic",
        "`partition`",
        "`offset`",
        "`timestamp`",
        "timestampType",
    )


def events_envelope(events: DataFrame) -> DataFrame:
    """One message per event; the payload is the event's ``props`` JSON."""
    return _envelope(
        events,
        EVENTS_TOPIC,
        f"event_id % {EVENTS_PARTITIONS}",
        f"floor(event_id / {EVENTS_PARTITIONS})",
        "props",
        "ts",
    )


# Wall time of the (zone-less) event time: cast to text, never through the session zone.
_WALL_SECONDS = "substring(replace(CAST(CAST(ts AS TIMESTAMP_NTZ) AS STRING), ' ', 'T'), 1, 19)"


def events_time_envelope(events: DataFrame) -> DataFrame:
    """One message per event with a timed record ``{"id", "at"}``.

    ``at`` is the event time written with a ``+0100`` zone; error events
    carry a number and signup events a word instead, which the parser must
    report as ``bad_field``.
    """
    value = f"""concat('{{"id":"', CAST(event_id AS STRING), '","at":',
        CASE WHEN event_type = 'error' THEN CAST(user_id AS STRING)
             WHEN event_type = 'signup' THEN concat('"', event_type, '"')
             ELSE concat('"', {_WALL_SECONDS}, '+0100"') END,
        '}}')"""
    return _envelope(
        events,
        EVENTS_TOPIC,
        f"event_id % {EVENTS_PARTITIONS}",
        f"floor(event_id / {EVENTS_PARTITIONS})",
        value,
        "ts",
    )


def documents_envelope(documents: DataFrame) -> DataFrame:
    """One message per document: the whole document (up to ~128K characters
    of prose with newlines, quotes and non-ASCII text) as a JSON record."""
    return _envelope(
        documents,
        DOCUMENTS_TOPIC,
        f"doc_id % {DOCUMENTS_PARTITIONS}",
        f"floor(doc_id / {DOCUMENTS_PARTITIONS})",
        "to_json(named_struct('doc_id', CAST(doc_id AS STRING), 'lang', lang, 'source', source, 'text', text))",
    )


# Payloads that try to close the parser's wrapper, and two valid
# ones that look like it.
HOSTILE_PAYLOADS = (
    '{"id":"1"}],"r":[{"id":"2"}',
    '{"id":"1"}],"end":"x","r":[{"id":"2"}',
    '],"r":[{"id":"2"}',
    '{"id":"1"}],"x":[1',
    '{"id":"1"}],"_corrupt":["a"',
    '{"id":"1"}],"_corrupt":null,"r":[{"id":"3"}',
    '],"x":[{"id":"2"}',
    '{"id":"1"}],"r":[',
    '{"id":"1"}],"r":[null',
    '{"id":"1"}],[{"_n":"x"}]],"w":[[{"_n":"x"}],[{"id":"2"}',
    '{"id":"1"}],[{"_n":null}]],"w":[[{"_n":null}],[{"id":"2"}',
    ']],"w":[[{"id":"2"}',
    '{"id":"1"}]]}',
    '{"id":"ferry-eof-5b1c9e"}',
    '{"id":"],[","name":"]]}","w":[[1],[2]],"_n":"x","_corrupt":"y"}',
)


def customer_hostile_envelope(customer: DataFrame) -> DataFrame:
    """The customer messages, most of them replaced by hostile payloads."""
    cases = " ".join(f"WHEN {i} THEN '{p}'" for i, p in enumerate(HOSTILE_PAYLOADS))
    value = f"CASE c_custkey % {len(HOSTILE_PAYLOADS) + 3} {cases} ELSE {_CUSTOMER_GOOD} END"
    partition, offset = f"c_custkey % {CUSTOMER_PARTITIONS}", f"floor(c_custkey / {CUSTOMER_PARTITIONS})"
    return _envelope(customer, CUSTOMER_TOPIC, partition, offset, value)


# Numbers that a double or a decimal would say otherwise.
WRITTEN_NUMBERS = ("1.50", "1e3", "1e400", "-0", "12.0", "-0.0", "1E-400", "7.00e+2")


def customer_long_number_envelope(customer: DataFrame) -> DataFrame:
    """``{"id": N}``: integers of 39 to 60 digits, decimals of 44 and more digits,
    the numbers of ``WRITTEN_NUMBERS``, and literals that are no numbers."""
    cases = " ".join(f"WHEN {10 + i} THEN '{{\"id\":{n}}}'" for i, n in enumerate(WRITTEN_NUMBERS))
    value = f"""CASE c_custkey % 30 {cases} WHEN 20 THEN '{{"id":NaN}}' WHEN 21 THEN '{{"id":-Infinity}}'
        WHEN 22 THEN concat('{{"id":', '3.', lpad(CAST(c_custkey AS STRING), CAST(43 + c_custkey % 22 AS INT), '1'), '0}}')
        ELSE concat('{{"id":', '1', lpad(CAST(c_custkey AS STRING), CAST(38 + c_custkey % 22 AS INT), '7'), '}}') END"""
    partition, offset = f"c_custkey % {CUSTOMER_PARTITIONS}", f"floor(c_custkey / {CUSTOMER_PARTITIONS})"
    return _envelope(customer, CUSTOMER_TOPIC, partition, offset, value)


# Fixed value: levels of nesting, more than a JSON reader takes by default.
DEEP = 1100


def customer_deep_envelope(customer: DataFrame) -> DataFrame:
    """The customer messages with deep values: under an unknown key (arrays, or
    objects around a string of brackets), under a field, unclosed, and none."""
    arrays = f"concat(repeat('[', {DEEP}), repeat(']', {DEEP}))"
    objects = f"""concat(repeat('{{"id":', {DEEP}), '"]}}"', repeat('}}', {DEEP}))"""
    good = f"substring({_CUSTOMER_GOOD}, 2)"
    value = f"""CASE c_custkey % 6 WHEN 0 THEN concat('{{"zzz":', {arrays}, ',', {good})
        WHEN 1 THEN concat('{{"zzz":', {objects}, ',', {good})
        WHEN 2 THEN concat('{{"firstName":', {arrays}, ',"id":"1"}}')
        WHEN 3 THEN concat('{{"zzz":', {objects}, ',"name":', {objects}, '}}')
        WHEN 4 THEN concat('{{"zzz":[', {arrays}, ',', {good})
        ELSE concat('{{', {good}) END"""
    partition, offset = f"c_custkey % {CUSTOMER_PARTITIONS}", f"floor(c_custkey / {CUSTOMER_PARTITIONS})"
    return _envelope(customer, CUSTOMER_TOPIC, partition, offset, value)


def orders_typed_envelope(orders: DataFrame) -> DataFrame:
    """``{"k", "price", "flag", "ratio", "exact"}`` of each order, with values that
    an int, a decimal(12,2), a boolean or a double cannot hold without loss."""
    value = """concat('{"k":', CASE o_orderkey % 7 WHEN 1 THEN '1.7' WHEN 2 THEN 'true' ELSE CAST(o_orderkey AS STRING) END,
        ',"price":', CASE o_orderkey % 7 WHEN 3 THEN '1.239' ELSE '1.50' END,
        ',"flag":', CASE o_orderkey % 7 WHEN 4 THEN '2' WHEN 5 THEN '1.5' ELSE 'true' END,
        ',"ratio":', CASE o_orderkey % 11 WHEN 1 THEN '9007199254740993' WHEN 2 THEN '9223372036854775807' WHEN 3 THEN '9007199254740992'
                     WHEN 4 THEN 'NaN' WHEN 5 THEN '-Infinity' ELSE '0.5' END,
        ',"exact":"', CASE o_orderkey % 13 WHEN 1 THEN '1.239' WHEN 2 THEN '7.0000001' WHEN 3 THEN '7.0000' ELSE '2.5' END, '"}')"""
    return _envelope(orders, "orders", "o_orderkey % 4", "floor(o_orderkey / 4)", value)
