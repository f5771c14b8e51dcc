"""Registered queries: one per operator of the relay, each over whole driver
tables, each with an equivalent DuckDB SQL string (the correctness oracle).

Each query takes ``(spark, sf_dir)`` and returns a DataFrame. Message
envelopes are derived from ``customer`` (employee-shaped JSON with every
reject path), ``events`` (3 partitions, offsets in event-time order) and
``documents`` (whole texts as large payloads).
The ``stream_*`` queries run a Structured Streaming query to completion
(``availableNow``) into a fresh folder under the shared checkpoint folder
and return its output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferry.functions.decode import decode
from ferry.functions.serialize import serialize
from ferry.functions.strict_json import classify
from ferry.operators.offsets import after_committed, max_offsets, record_counts
from ferry.operators.records import (
    header,
    parsed_fields,
    publish_envelope,
    records,
    reject_counts,
    rejects,
    serialized,
)
from ferry.schemas import EMPLOYEE, PUBLISHED_WITH_HEADERS
from ferry.session import fresh_dir
from ferry.sources.derived import (
    HOSTILE_PAYLOADS,
    WRITTEN_NUMBERS,
    customer_bytes_envelope,
    customer_envelope,
    customer_deep_envelope,
    customer_hostile_envelope,
    customer_long_number_envelope,
    documents_envelope,
    events_envelope,
    events_time_envelope,
    orders_typed_envelope,
)
from ferry.sources.offset_index import read_after, update_index
from ferry.sources.replay import read_replay, read_table, stream_table
from ferry.streaming.jobs import (
    RelayTables,
    committed_offsets,
    read_published,
    read_rejects,
    start_publish,
    start_relay,
)
from ferry.streaming.read_once import read_once
from ferry.streaming.resume import frozen_marks, resume_replay
from ferry.streaming.sinks import FileSink

# Fixed values of the registered queries.
EMPLOYEE_TOPIC = "employees"
EVENTS_OUT_TOPIC = "events_out"
UNMARKED_PARTITION = 1
DEAD_LETTER_TOPIC = "employees_dead_letter"
EVENT_RECORD = "k string"
TIMED_RECORD = "id string, at timestamp"
TYPED_RECORD = "k int, price decimal(12,2), flag boolean, ratio double, exact decimal(12,2)"
DOCUMENT_RECORD = "doc_id string, lang string, source string, text string"
# Event time up to which a previous run has committed (resume queries), and
# the boundary between the two arrivals of the resumed stream.
COMMITTED_BEFORE = "2024-01-16 00:00:00"
AVAILABLE_NOW = {"availableNow": True}
# Partitions for each core where a small file's rows grow into large messages.
DEAL = 3

Query = Callable[[SparkSession, str], DataFrame]


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_envelope(read_table(spark, sf_dir, "customer"))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_envelope(read_table(spark, sf_dir, "events"))


def _classified_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(_customers(spark, sf_dir), EMPLOYEE)


def _with_text(df: DataFrame) -> DataFrame:
    return df.withColumn("value", F.col("value").cast("string"))


# --- batch queries ----------------------------------------------------------


def scan_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The message envelope (key and value as text)."""
    return _customers(spark, sf_dir).select(
        "topic", "partition", "offset", F.col("key").cast("string").alias("key"), F.col("value").cast("string")
    )


def decode_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UTF-8 text of every payload and its size in bytes."""
    return decode(_customers(spark, sf_dir)).select("topic", "partition", "offset", "value", "n_bytes")


def classify_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status of every message."""
    return _classified_customers(spark, sf_dir).select("topic", "partition", "offset", "status")


def classify_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1+P3 on raw bytes: invalid UTF-8 and tombstones get their own reasons."""
    messages = customer_bytes_envelope(read_table(spark, sf_dir, "customer"))
    classified = classify(messages.withColumn("n_bytes", F.length("value")), EMPLOYEE)
    return classified.select("topic", "partition", "offset", "status", "n_bytes")


def classify_hostile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P2/P3 on payloads that try to escape the parser's wrapper."""
    messages = customer_hostile_envelope(read_table(spark, sf_dir, "customer"))
    classified = classify(messages, EMPLOYEE)
    return classified.select("topic", "partition", "offset", "status", F.col("record.id").alias("id"))


def parse_long_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers in a string field stay as they are written."""
    classified = classify(customer_long_number_envelope(read_table(spark, sf_dir, "customer")), EMPLOYEE)
    return classified.select("topic", "partition", "offset", "status", F.col("record.id").alias("id"))


def classify_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deep values of unknown keys are skipped, those of fields are too deep."""
    # a message is 50 times its row and slow to read: the rows are dealt out before the messages are made
    customer = read_table(spark, sf_dir, "customer").repartition(DEAL * spark.sparkContext.defaultParallelism)
    return parsed_fields(classify(customer_deep_envelope(customer), EMPLOYEE))


def parse_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed fields take only what they hold without loss."""
    return parsed_fields(classify(orders_typed_envelope(read_table(spark, sf_dir, "orders")), TYPED_RECORD))


def parse_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid records as typed columns."""
    return records(_classified_customers(spark, sf_dir))


def reject_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invalid messages with their reason."""
    return rejects(_classified_customers(spark, sf_dir))


def reject_counts_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected messages per topic and reason."""
    return reject_counts(_classified_customers(spark, sf_dir))


def parse_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5: timed records; ``at`` as epoch seconds (time-zone free)."""
    classified = classify(events_time_envelope(read_table(spark, sf_dir, "events")), TIMED_RECORD)
    fields = parsed_fields(classified)
    return fields.select("topic", "partition", "offset", "status", "id", F.unix_seconds("at").alias("at_unix"))


def serialize_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON text of every valid record."""
    return serialized(_classified_customers(spark, sf_dir))


def publish_envelope_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The outgoing messages."""
    return publish_envelope(_classified_customers(spark, sf_dir), EMPLOYEE_TOPIC)


def relay_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1-P6 on large payloads: each whole document is parsed and re-serialized;
    the text and the outgoing message are summarized by length and MD5."""
    classified = classify(documents_envelope(read_table(spark, sf_dir, "documents")), DOCUMENT_RECORD)
    out = serialize("record")
    return classified.select(
        F.col("topic"),
        F.col("partition"),
        F.col("offset"),
        F.col("status"),
        F.col("record.doc_id").alias("doc_id"),
        F.length("record.text").alias("n_chars"),
        F.md5("record.text").alias("text_md5"),
        F.octet_length(out).alias("out_bytes"),
        F.md5(out).alias("out_md5"),
    )


def partition_max_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: highest offset per partition."""
    return max_offsets(_events(spark, sf_dir))


def partition_record_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: messages per partition."""
    return record_counts(_events(spark, sf_dir))


def read_after_committed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3/K2: messages after the offsets a previous run committed."""
    messages = _events(spark, sf_dir)
    committed = max_offsets(messages.filter(F.col("timestamp") < F.lit(COMMITTED_BEFORE).cast("timestamp")))
    return _with_text(after_committed(messages, committed)).select("topic", "partition", "offset", "value")


def read_after_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: messages after the committed offsets, from the files of a replay folder
    that an index says can hold one; one partition has no mark, so all of it stays."""
    root, messages = fresh_dir(spark, "read_after_index"), _events(spark, sf_dir)
    messages.repartitionByRange("offset").write.parquet(f"{root}/landing")
    index = update_index(spark, f"{root}/landing", f"{root}/index", messages.schema)
    committed = max_offsets(messages.filter(F.col("timestamp") < F.lit(COMMITTED_BEFORE).cast("timestamp")))
    marks = committed.where(F.col("partition") != UNMARKED_PARTITION)
    found = read_after(spark, f"{root}/landing", index, marks, messages.schema)
    return _with_text(found).select("topic", "partition", "offset", "value")


# --- streaming queries ------------------------------------------------------


def stream_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer messages as a file stream, published to a file sink."""
    root = fresh_dir(spark, "stream_publish")
    sink = FileSink(f"{root}/out")
    query = start_publish(
        stream_table(spark, sf_dir, "customer"),
        EMPLOYEE,
        EMPLOYEE_TOPIC,
        sink,
        f"{root}/checkpoint",
        trigger=AVAILABLE_NOW,
        prepare=customer_envelope,
    )
    query.awaitTermination()
    return sink.read(spark)


def _stage_arrival(spark: SparkSession, sf_dir: str, landing: str, first: bool) -> None:
    """Land one arrival of event messages (before / from the boundary time),
    in the splits of the scan."""
    messages = _events(spark, sf_dir)
    early = F.col("timestamp") < F.lit(COMMITTED_BEFORE).cast("timestamp")
    arrival = messages.filter(early if first else ~early)
    arrival.write.mode("append").parquet(landing)


def _landing_stream(spark: SparkSession, landing: str) -> DataFrame:
    schema = spark.read.parquet(landing).schema
    return read_replay(spark, landing, schema)


def stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: two arrivals, two runs on one checkpoint; each message published once."""
    root = fresh_dir(spark, "stream_resume")
    landing, checkpoint = f"{root}/landing", f"{root}/checkpoint"
    sink = FileSink(f"{root}/out")
    for first in (True, False):
        _stage_arrival(spark, sf_dir, landing, first)
        start_publish(
            _landing_stream(spark, landing), EVENT_RECORD, EVENTS_OUT_TOPIC, sink, checkpoint, trigger=AVAILABLE_NOW
        ).awaitTermination()
    return sink.read(spark)


def stream_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1/K1: foreachBatch relay over two arrivals; the committed offsets after both."""
    root = fresh_dir(spark, "stream_offsets")
    landing, checkpoint = f"{root}/landing", f"{root}/checkpoint"
    tables = RelayTables(f"{root}/tables")
    sink = FileSink(f"{root}/out")
    for first in (True, False):
        _stage_arrival(spark, sf_dir, landing, first)
        start_relay(
            _landing_stream(spark, landing),
            EVENT_RECORD,
            EVENTS_OUT_TOPIC,
            sink,
            tables,
            checkpoint,
            trigger=AVAILABLE_NOW,
        ).awaitTermination()
    return committed_offsets(spark, tables)


def stream_resume_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3/K2: a run over the first arrival, then another with a new checkpoint
    over both, which goes on after the first run's committed-offsets table; what
    the two published."""
    root = fresh_dir(spark, "stream_resume_table")
    landing, tables, sink = f"{root}/landing", RelayTables(f"{root}/tables"), FileSink(f"{root}/out")
    for first in (True, False):
        _stage_arrival(spark, sf_dir, landing, first)
        source, run = _landing_stream(spark, landing), f"{root}/run{1 if first else 2}"
        if not first:
            marks = frozen_marks(spark, committed_offsets(spark, tables), f"{run}/resume_marks")
            source = resume_replay(source, marks)
        start_relay(
            source, EVENT_RECORD, EVENTS_OUT_TOPIC, sink, tables, f"{run}/checkpoint", trigger=AVAILABLE_NOW
        ).awaitTermination()
    return read_published(spark, tables, sink)


def stream_dead_letter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer stream in one routed write: valid messages to the
    target topic, the others with their reason to the dead-letter topic."""
    root = fresh_dir(spark, "stream_dead_letter")
    sink = FileSink(f"{root}/out", routed=True)
    start_publish(
        stream_table(spark, sf_dir, "customer"),
        EMPLOYEE,
        EMPLOYEE_TOPIC,
        sink,
        f"{root}/checkpoint",
        trigger=AVAILABLE_NOW,
        prepare=customer_envelope,
        dead_letter_topic=DEAD_LETTER_TOPIC,
    ).awaitTermination()
    out = sink.read(spark, PUBLISHED_WITH_HEADERS)
    source = [header(f"src_{c}").alias(f"src_{c}") for c in ("topic", "partition", "offset")]
    return out.select("topic", "key", "value", header("reason").alias("reason"), *source)


def stream_read_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O2: the published customer messages arrive twice, as after a replayed
    batch; a stream over both arrivals gives each message once."""
    root = fresh_dir(spark, "stream_read_once")
    sent = publish_envelope(_classified_customers(spark, sf_dir), EMPLOYEE_TOPIC, source_headers=True)
    sink = FileSink(f"{root}/out")
    for _ in range(2):
        sent.write.mode("append").parquet(f"{root}/topic")
        arrived = read_replay(spark, f"{root}/topic", PUBLISHED_WITH_HEADERS)
        writer = sink.write_stream(read_once(arrived)).option("checkpointLocation", f"{root}/checkpoint")
        writer.trigger(**AVAILABLE_NOW).start().awaitTermination()
    source = [header(f"src_{c}").alias(f"src_{c}") for c in ("topic", "partition", "offset")]
    return sink.read(spark, PUBLISHED_WITH_HEADERS).select("topic", "key", "value", *source)


def _relay_customers(spark: SparkSession, sf_dir: str, name: str) -> tuple[RelayTables, FileSink]:
    """Run the foreachBatch job over the customer stream; return its tables and sink."""
    root = fresh_dir(spark, name)
    tables, sink = RelayTables(f"{root}/tables"), FileSink(f"{root}/out")
    start_relay(
        stream_table(spark, sf_dir, "customer"),
        EMPLOYEE,
        EMPLOYEE_TOPIC,
        sink,
        tables,
        f"{root}/checkpoint",
        trigger=AVAILABLE_NOW,
        envelope=customer_envelope,
    ).awaitTermination()
    return tables, sink


def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rejects table written by the foreachBatch job over the customer stream."""
    tables, _sink = _relay_customers(spark, sf_dir, "stream_rejects")
    return read_rejects(spark, tables)


def stream_relay_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1/O2: the messages the foreachBatch job published over the customer stream."""
    tables, sink = _relay_customers(spark, sf_dir, "stream_relay_publish")
    return read_published(spark, tables, sink)


def stream_prepare_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offsets after a user stage that drops most messages: those of the
    whole stream."""
    root = fresh_dir(spark, "stream_prepare_offsets")
    tables = RelayTables(f"{root}/tables")
    start_relay(
        stream_table(spark, sf_dir, "events"),
        EVENT_RECORD,
        EVENTS_OUT_TOPIC,
        FileSink(f"{root}/out"),
        tables,
        f"{root}/checkpoint",
        trigger=AVAILABLE_NOW,
        envelope=events_envelope,
        prepare=lambda messages: messages.filter("`partition` = 0 AND `offset` % 2 = 0"),
    ).awaitTermination()
    return committed_offsets(spark, tables)


QUERIES: dict[str, Query] = {
    "scan_envelope": scan_envelope,
    "decode_payload": decode_payload,
    "classify_payloads": classify_payloads,
    "classify_bytes": classify_bytes,
    "classify_hostile": classify_hostile,
    "parse_long_numbers": parse_long_numbers,
    "classify_deep": classify_deep,
    "parse_typed": parse_typed,
    "parse_records": parse_records,
    "reject_records": reject_records,
    "reject_counts": reject_counts_q,
    "parse_timestamps": parse_timestamps,
    "serialize_records": serialize_records,
    "publish_envelope": publish_envelope_q,
    "relay_documents": relay_documents,
    "partition_max_offset": partition_max_offset,
    "partition_record_count": partition_record_count,
    "read_after_committed": read_after_committed,
    "read_after_index": read_after_index,
    "stream_publish": stream_publish,
    "stream_resume": stream_resume,
    "stream_offsets": stream_offsets,
    "stream_prepare_offsets": stream_prepare_offsets,
    "stream_rejects": stream_rejects,
    "stream_relay_publish": stream_relay_publish,
    "stream_resume_table": stream_resume_table,
    "stream_dead_letter": stream_dead_letter,
    "stream_read_once": stream_read_once,
}


# --- DuckDB oracle ----------------------------------------------------------

_CUSTOMER_ENV = """
customer_env AS (
  SELECT 'inputTopic' AS topic,
         CAST(c_custkey % 4 AS INTEGER) AS "partition",
         CAST(floor(c_custkey / 4) AS BIGINT) AS "offset",
         CASE c_custkey % 20
           WHEN 3 THEN 'not json' WHEN 7 THEN '' WHEN 11 THEN 'null'
           WHEN 13 THEN '{"id":{"a":1}}' WHEN 17 THEN good || ' x' ELSE good END AS value
  FROM (SELECT *, concat('{"id":"', CAST(c_custkey AS VARCHAR), '","name":"', c_name,
                         '","firstName":"', c_mktsegment, '"',
                         CASE WHEN c_acctbal >= 0
                              THEN concat(',"lastName":"N', CAST(c_nationkey AS VARCHAR), '"')
                              ELSE '' END, '}') AS good
        FROM customer) c
)"""

_STATUS_CASE = """CASE
      WHEN value IS NULL THEN 'null_payload'
      WHEN trim(value) = '' THEN 'empty'
      WHEN NOT json_valid(value) THEN 'malformed'
      WHEN trim(value) = 'null' THEN 'json_null'
      WHEN json_type(value) <> 'OBJECT' THEN 'malformed'
      WHEN coalesce(json_type(value, '$.id') IN ('OBJECT', 'ARRAY'), false)
        OR coalesce(json_type(value, '$.name') IN ('OBJECT', 'ARRAY'), false)
        OR coalesce(json_type(value, '$.firstName') IN ('OBJECT', 'ARRAY'), false)
        OR coalesce(json_type(value, '$.lastName') IN ('OBJECT', 'ARRAY'), false) THEN 'nested_field'
      ELSE 'ok' END"""

_CLASSIFIED = (
    "WITH"
    + _CUSTOMER_ENV
    + f""",
classified AS (
  SELECT *, {_STATUS_CASE} AS status
  FROM customer_env
),
parsed AS (
  SELECT topic, "partition", "offset",
         json_extract_string(value, '$.id') AS id,
         json_extract_string(value, '$.name') AS name,
         json_extract_string(value, '$.firstName') AS "firstName",
         json_extract_string(value, '$.lastName') AS "lastName"
  FROM classified WHERE status = 'ok'
)
"""
)

_EVENTS_ENV = """
WITH events_env AS (
  SELECT 'events' AS topic,
         CAST(event_id % 3 AS INTEGER) AS "partition",
         CAST(floor(event_id / 3) AS BIGINT) AS "offset",
         props AS value, ts
  FROM events
)
"""

_SERIALIZED = """CAST(json_merge_patch('{}', json_object('id', id, 'name', name,
         'firstName', "firstName", 'lastName', "lastName")) AS VARCHAR)"""

_COMMITTED = f"""
, committed AS (
  SELECT topic, "partition", max("offset") AS committed
  FROM events_env WHERE ts < TIMESTAMP '{COMMITTED_BEFORE}'
  GROUP BY topic, "partition"
)
"""

_PUBLISHED = f"""SELECT '{EMPLOYEE_TOPIC}' AS topic, CAST(NULL AS VARCHAR) AS key, {_SERIALIZED} AS value FROM parsed"""

_EVENTS_PUBLISHED = f"""SELECT '{EVENTS_OUT_TOPIC}' AS topic, CAST(NULL AS VARCHAR) AS key,
       CAST(json_object('k', json_extract_string(props, '$.k')) AS VARCHAR) AS value
FROM events"""

_MAX_OFFSET = (
    _EVENTS_ENV
    + """SELECT topic, "partition", max("offset") AS max_offset FROM events_env GROUP BY topic, "partition\""""
)

_TIMED = """
WITH timed AS (
  SELECT 'events' AS topic,
         CAST(event_id % 3 AS INTEGER) AS "partition",
         CAST(floor(event_id / 3) AS BIGINT) AS "offset",
         concat('{"id":"', CAST(event_id AS VARCHAR), '","at":',
                CASE WHEN event_type = 'error' THEN CAST(user_id AS VARCHAR)
                     WHEN event_type = 'signup' THEN concat('"', event_type, '"')
                     ELSE concat('"', strftime(ts, '%Y-%m-%dT%H:%M:%S'), '+0100"') END,
                '}') AS value
  FROM events
),
typed AS (
  SELECT *, json_type(value, '$.at') AS at_type,
         try_strptime(json_extract_string(value, '$.at'), '%Y-%m-%dT%H:%M:%S%z') AS at_ts
  FROM timed
),
checked AS (
  SELECT *, CASE WHEN at_type IS NULL OR at_type = 'NULL' OR (at_type = 'VARCHAR' AND at_ts IS NOT NULL)
                 THEN 'ok' ELSE 'bad_field' END AS status
  FROM typed
)
SELECT topic, "partition", "offset", status,
       CASE WHEN status = 'ok' THEN json_extract_string(value, '$.id') END AS id,
       CASE WHEN status = 'ok' THEN CAST(epoch(at_ts) AS BIGINT) END AS at_unix
FROM checked
"""

_BYTES = (
    "WITH"
    + _CUSTOMER_ENV
    + f""",
raw_env AS (
  SELECT topic, "partition", "offset",
         CASE ("offset" * 4 + "partition") % 20
           WHEN 1 THEN NULL WHEN 19 THEN unhex('FF') || encode(value) ELSE encode(value) END AS raw
  FROM customer_env
),
decoded AS (SELECT *, try(decode(raw)) AS value FROM raw_env)
SELECT topic, "partition", "offset",
       CASE WHEN raw IS NOT NULL AND value IS NULL THEN 'bad_utf8' ELSE {_STATUS_CASE} END AS status,
       CAST(octet_length(raw) AS INTEGER) AS n_bytes
FROM decoded
"""
)

_GOOD = """concat('{"id":"', CAST(c_custkey AS VARCHAR), '","name":"', c_name, '","firstName":"', c_mktsegment, '"',
    CASE WHEN c_acctbal >= 0 THEN concat(',"lastName":"N', CAST(c_nationkey AS VARCHAR), '"') ELSE '' END, '}')"""

_HOSTILE = f"""WITH env AS (
  SELECT 'inputTopic' AS topic, CAST(c_custkey % 4 AS INTEGER) AS "partition",
         CAST(floor(c_custkey / 4) AS BIGINT) AS "offset",
         CASE c_custkey % {len(HOSTILE_PAYLOADS) + 3}
           {" ".join(f"WHEN {i} THEN '{p}'" for i, p in enumerate(HOSTILE_PAYLOADS))} ELSE {_GOOD} END AS value
  FROM customer),
classified AS (SELECT *, {_STATUS_CASE} AS status FROM env)
SELECT topic, "partition", "offset", status,
       CASE WHEN status = 'ok' THEN json_extract_string(value, '$.id') END AS id
FROM classified"""

_LONG_NUMBERS = f"""
SELECT 'inputTopic' AS topic, CAST(c_custkey % 4 AS INTEGER) AS "partition",
       CAST(floor(c_custkey / 4) AS BIGINT) AS "offset",
       CASE WHEN c_custkey % 30 IN (20, 21) THEN 'bad_field' ELSE 'ok' END AS status,
       CASE c_custkey % 30 {" ".join(f"WHEN {10 + i} THEN '{n}'" for i, n in enumerate(WRITTEN_NUMBERS))}
            WHEN 20 THEN NULL WHEN 21 THEN NULL
            WHEN 22 THEN concat('3.', lpad(CAST(c_custkey AS VARCHAR), CAST(43 + c_custkey % 22 AS INTEGER), '1'), '0')
            ELSE concat('1', lpad(CAST(c_custkey AS VARCHAR), CAST(38 + c_custkey % 22 AS INTEGER), '7')) END AS id
FROM customer"""

_DEEP = """
WITH deep AS (
  SELECT *, CASE c_custkey % 6 WHEN 2 THEN 'too_deep' WHEN 3 THEN 'too_deep' WHEN 4 THEN 'malformed' ELSE 'ok' END AS status
  FROM customer)
SELECT 'inputTopic' AS topic, CAST(c_custkey % 4 AS INTEGER) AS "partition",
       CAST(floor(c_custkey / 4) AS BIGINT) AS "offset", status,
       CASE WHEN status = 'ok' THEN CAST(c_custkey AS VARCHAR) END AS id,
       CASE WHEN status = 'ok' THEN c_name END AS name,
       CASE WHEN status = 'ok' THEN c_mktsegment END AS "firstName",
       CASE WHEN status = 'ok' AND c_acctbal >= 0 THEN concat('N', CAST(c_nationkey AS VARCHAR)) END AS "lastName"
FROM deep"""

_TYPED = """
WITH typed AS (
  SELECT *, o_orderkey % 7 NOT IN (1, 2, 3, 4, 5) AND o_orderkey % 11 NOT IN (1, 2, 4, 5) AND o_orderkey % 13 NOT IN (1, 2) AS good
  FROM orders)
SELECT 'orders' AS topic, CAST(o_orderkey % 4 AS INTEGER) AS "partition",
       CAST(floor(o_orderkey / 4) AS BIGINT) AS "offset",
       CASE WHEN good THEN 'ok' ELSE 'bad_field' END AS status,
       CASE WHEN good THEN CAST(o_orderkey AS INTEGER) END AS k,
       CASE WHEN good THEN CAST(1.50 AS DECIMAL(12,2)) END AS price,
       CASE WHEN good THEN true END AS flag,
       CASE WHEN good THEN CASE o_orderkey % 11 WHEN 3 THEN 9007199254740992::DOUBLE ELSE 0.5::DOUBLE END END AS ratio,
       CASE WHEN good THEN CASE o_orderkey % 13 WHEN 3 THEN 7.00::DECIMAL(12,2) ELSE 2.50::DECIMAL(12,2) END END AS exact
FROM typed"""

_DOCUMENTS = """
WITH doc_msg AS (
  SELECT 'documents' AS topic,
         CAST(doc_id % 8 AS INTEGER) AS "partition",
         CAST(floor(doc_id / 8) AS BIGINT) AS "offset",
         CAST(json_object('doc_id', CAST(doc_id AS VARCHAR), 'lang', lang, 'source', source, 'text', text)
              AS VARCHAR) AS value
  FROM documents
),
parsed AS (
  SELECT topic, "partition", "offset",
         CASE WHEN json_valid(value) AND json_type(value) = 'OBJECT' THEN 'ok' ELSE 'malformed' END AS status,
         json_extract_string(value, '$.doc_id') AS doc_id,
         json_extract_string(value, '$.lang') AS lang,
         json_extract_string(value, '$.source') AS source,
         json_extract_string(value, '$.text') AS text
  FROM doc_msg
),
republished AS (
  SELECT *, CAST(json_merge_patch('{}', json_object('doc_id', doc_id, 'lang', lang, 'source', source,
                                                   'text', text)) AS VARCHAR) AS out
  FROM parsed
)
SELECT topic, "partition", "offset", status, doc_id,
       CAST(length(text) AS INTEGER) AS n_chars, md5(text) AS text_md5,
       CAST(octet_length(encode(out)) AS INTEGER) AS out_bytes, md5(out) AS out_md5
FROM republished
"""

ORACLE_SQL: dict[str, str] = {
    "scan_envelope": "WITH"
    + _CUSTOMER_ENV
    + """
SELECT topic, "partition", "offset", CAST(NULL AS VARCHAR) AS key, value FROM customer_env""",
    "decode_payload": "WITH"
    + _CUSTOMER_ENV
    + """
SELECT topic, "partition", "offset", value, CAST(octet_length(encode(value)) AS BIGINT) AS n_bytes
FROM customer_env""",
    "classify_payloads": _CLASSIFIED + """SELECT topic, "partition", "offset", status FROM classified""",
    "classify_bytes": _BYTES,
    "classify_hostile": _HOSTILE,
    "parse_long_numbers": _LONG_NUMBERS,
    "classify_deep": _DEEP,
    "parse_typed": _TYPED,
    "parse_records": _CLASSIFIED + "SELECT * FROM parsed",
    "reject_records": _CLASSIFIED
    + """SELECT topic, "partition", "offset", value, status AS reason FROM classified WHERE status <> 'ok'""",
    "reject_counts": _CLASSIFIED
    + """SELECT topic, status AS reason, count(*) AS n_rejects FROM classified
WHERE status <> 'ok' GROUP BY topic, status""",
    "parse_timestamps": _TIMED,
    "serialize_records": _CLASSIFIED + f"""SELECT topic, "partition", "offset", {_SERIALIZED} AS value FROM parsed""",
    "publish_envelope": _CLASSIFIED + _PUBLISHED,
    "relay_documents": _DOCUMENTS,
    "partition_max_offset": _MAX_OFFSET,
    "partition_record_count": _EVENTS_ENV
    + """SELECT topic, "partition", count(*) AS n_records FROM events_env GROUP BY topic, "partition\"""",
    "read_after_committed": _EVENTS_ENV
    + _COMMITTED
    + """SELECT e.topic, e."partition", e."offset", e.value
FROM events_env e LEFT JOIN committed c ON e.topic = c.topic AND e."partition" = c."partition"
WHERE e."offset" > coalesce(c.committed, -1)""",
    "read_after_index": _EVENTS_ENV
    + _COMMITTED
    + f"""SELECT e.topic, e."partition", e."offset", e.value
FROM events_env e LEFT JOIN committed c ON e.topic = c.topic AND e."partition" = c."partition"
WHERE e."partition" = {UNMARKED_PARTITION} OR e."offset" > coalesce(c.committed, -1)""",
    "stream_publish": _CLASSIFIED + _PUBLISHED,
    "stream_resume": _EVENTS_PUBLISHED,
    "stream_offsets": _MAX_OFFSET,
    "stream_prepare_offsets": _MAX_OFFSET,
    "stream_rejects": _CLASSIFIED
    + """SELECT topic, "partition", "offset", value, status AS reason FROM classified WHERE status <> 'ok'""",
    "stream_relay_publish": _CLASSIFIED + _PUBLISHED,
    "stream_resume_table": _EVENTS_PUBLISHED,
    "stream_dead_letter": _CLASSIFIED
    + f"""SELECT '{EMPLOYEE_TOPIC}' AS topic, CAST(NULL AS VARCHAR) AS key, {_SERIALIZED} AS value, CAST(NULL AS VARCHAR) AS reason,
       topic AS src_topic, CAST("partition" AS VARCHAR) AS src_partition, CAST("offset" AS VARCHAR) AS src_offset FROM parsed
UNION ALL
SELECT '{DEAD_LETTER_TOPIC}', NULL, value, status, topic, CAST("partition" AS VARCHAR), CAST("offset" AS VARCHAR)
FROM classified WHERE status <> 'ok'""",
    "stream_read_once": _CLASSIFIED
    + f"""SELECT '{EMPLOYEE_TOPIC}' AS topic, CAST(NULL AS VARCHAR) AS key, {_SERIALIZED} AS value,
       topic AS src_topic, CAST("partition" AS VARCHAR) AS src_partition, CAST("offset" AS VARCHAR) AS src_offset FROM parsed""",
}
