"""Golden matrix and fuzz for the strict JSON classifier."""

from __future__ import annotations

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from ferry import EMPLOYEE, classify, serialize
from ferry.operators.records import parsed_fields, records, serialized
from ferry.sources.derived import HOSTILE_PAYLOADS

# Fixed value: the one sample message of the relayed stream (68 bytes); parse
# then serialize must give it back byte for byte.
SAMPLE = '{"id":"1","name":"Mark","firstName":"Polosnikov","lastName":"Doyle"}'
FIELDS = ["id", "name", "firstName", "lastName"]

# (payload, status, (id, name, firstName, lastName) when ok)
GOLDEN = [
    (SAMPLE, "ok", ("1", "Mark", "Polosnikov", "Doyle")),
    ('{"id":1,"name":true,"firstName":1.50,"lastName":null}', "ok", ("1", "true", "1.50", None)),
    ("{}", "ok", (None, None, None, None)),
    ('{"id":"1","zzz":5}', "ok", ("1", None, None, None)),
    ('{"ID":"1"}', "ok", (None, None, None, None)),
    ('{"id":"1","id":"2"}', "ok", ("2", None, None, None)),
    ('{"id":"{\\"a\\":1}"}', "ok", ('{"a":1}', None, None, None)),
    ("{'id':'1'}", "ok", ("1", None, None, None)),
    ('{"id":12345678901234567890123}', "ok", ("12345678901234567890123", None, None, None)),
    ('{"id":1e3}', "ok", ("1e3", None, None, None)),
    ('{"zzz":{"a":[1]}}', "ok", (None, None, None, None)),
    ('{"id":{"a": 1}}', "nested_field", None),
    ('{"id":[1]}', "nested_field", None),
    ('{"id":{}}', "nested_field", None),
    ('{"id":[]}', "nested_field", None),
    ('{"id":"1"} trailing', "malformed", None),
    ('{"id":"1"}{"id":"2"}', "malformed", None),
    ('{"id":"1"},{"id":"2"}', "malformed", None),
    ('{"id":"1"}]', "malformed", None),
    ('{"id":"1"}]}', "malformed", None),
    ('{"id":"1"},', "malformed", None),
    ('{"id":"1"}],"end":"x"}', "malformed", None),
    ('{id:"1"}', "malformed", None),
    ('{"id":"1",', "malformed", None),
    ("not json", "malformed", None),
    ("[]", "malformed", None),
    ('[{"id":"1"}]', "malformed", None),
    ("5", "malformed", None),
    ("", "empty", None),
    ("   ", "empty", None),
    ("null", "json_null", None),
    (None, "null_payload", None),
]


def _run(spark, payloads, schema=EMPLOYEE, **kw):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(payloads)], "offset long, value string")
    rows = parsed_fields(classify(df, schema, **kw)).orderBy("offset").collect()
    return rows


def test_golden_matrix(spark):
    rows = _run(spark, [p for p, _, _ in GOLDEN])
    for (payload, status, fields), row in zip(GOLDEN, rows):
        assert row["status"] == status, payload
        got = tuple(row[f] for f in FIELDS)
        assert got == (fields or (None, None, None, None)), payload


def test_binary_payloads(spark):
    df = spark.createDataFrame(
        [(0, bytes([0xFF, 0xFE, 0x7B])), (1, None), (2, SAMPLE.encode()), (3, b"")],
        "offset long, value binary",
    )
    rows = parsed_fields(classify(df, EMPLOYEE)).orderBy("offset").collect()
    assert [r["status"] for r in rows] == ["bad_utf8", "null_payload", "ok", "empty"]
    assert rows[2]["lastName"] == "Doyle"


def test_sample_round_trip_is_byte_identical(spark):
    df = spark.createDataFrame([(0, SAMPLE)], "offset long, value string")
    out = serialized(classify(df, EMPLOYEE)).collect()
    assert out[0]["value"] == SAMPLE
    assert len(out[0]["value"].encode()) == 68


def test_serialize_omits_null_fields(spark):
    df = spark.createDataFrame([(0, '{"name":"x","id":null}')], "offset long, value string")
    assert serialized(classify(df, EMPLOYEE)).collect()[0]["value"] == '{"name":"x"}'


def test_lenient_options_pass_through(spark):
    strict = _run(spark, ['{id:"1"}', '{"id":"1" /* c */}'])
    assert [r["status"] for r in strict] == ["malformed", "malformed"]
    lenient = _run(
        spark,
        ['{id:"1"}', '{"id":"1" /* c */}'],
        json_options={"allowUnquotedFieldNames": "true", "allowComments": "true"},
    )
    assert [(r["status"], r["id"]) for r in lenient] == [("ok", "1"), ("ok", "1")]


def test_marker_smuggling_is_malformed(spark):
    smuggled = '{"id":"1"}],"end":"ferry-eof-5b1c9e"} junk'
    assert _run(spark, [smuggled])[0]["status"] == "malformed"


def test_schema_given_as_ddl(spark):
    rows = _run(spark, ['{"a":"x","b":7}'], schema="a string, b string")
    assert (rows[0]["status"], rows[0]["a"], rows[0]["b"]) == ("ok", "x", "7")


def test_timestamp_field(spark):
    payloads = [
        '{"id":"1","at":"2016-12-22T18:16:00+0100"}',
        '{"id":"2","at":"garbage"}',
        '{"id":"3","at":5}',
        '{"id":"4","at":{"x":1}}',
        '{"id":"5","at":null}',
        '{"id":"6"}',
    ]
    rows = _run(spark, payloads, schema="id string, at timestamp")
    assert [r["status"] for r in rows] == ["ok", "bad_field", "bad_field", "nested_field", "ok", "ok"]
    at = rows[0]["at"]
    # the session runs in UTC
    assert at.replace(tzinfo=None) == dt.datetime(2016, 12, 22, 17, 16, 0)
    assert rows[4]["at"] is None and rows[5]["at"] is None


def test_numeric_field(spark):
    rows = _run(spark, ['{"n":5}', '{"n":"7"}', '{"n":"x"}', '{"n":null}'], schema="n bigint")
    assert [(r["status"], r["n"]) for r in rows] == [("ok", 5), ("ok", 7), ("bad_field", None), ("ok", None)]


def test_nested_schema_rejected(spark):
    df = spark.createDataFrame([(0, "{}")], "offset long, value string")
    with pytest.raises(TypeError):
        classify(df, "a array<string>")


def test_serialize_column_helper(spark):
    df = spark.createDataFrame([("a", None)], "x string, y string")
    assert df.select(serialize(F.struct("x", "y")).alias("j")).collect()[0]["j"] == '{"x":"a"}'


# --- fuzz: status must equal strict JSON (Python json) under the same rules ----


def _reject_constant(_):
    raise ValueError("non-numeric number")


def _expected(payload: str | None) -> str:
    if payload is None:
        return "null_payload"
    if payload.strip(" \t\n\r") == "":
        return "empty"
    try:
        doc = json.loads(payload, parse_constant=_reject_constant)
    except ValueError:
        return "malformed"
    if doc is None:
        return "json_null"
    if not isinstance(doc, dict):
        return "malformed"
    if any(isinstance(doc.get(f), (dict, list)) for f in FIELDS):
        return "nested_field"
    return "ok"


def _mutations(seed: int, n: int) -> list[str]:
    rng = random.Random(seed)
    bases = [SAMPLE, '{"id":[1,{"a":null}],"name":"x y","zzz":{"k":-1.5e3}}']
    alphabet = list('{}[]",: \t\n0123456789.-+eEtrufalsn\\abxyz\'')
    out = set()
    while len(out) < n:
        s = list(rng.choice(bases))
        for _ in range(rng.randint(1, 4)):
            op = rng.random()
            i = rng.randrange(len(s) + 1)
            if op < 0.4 and s:
                del s[min(i, len(s) - 1)]
            elif op < 0.8:
                s.insert(i, rng.choice(alphabet))
            elif s:
                s[min(i, len(s) - 1)] = rng.choice(alphabet)
        out.add("".join(s))
    return sorted(out)


def test_fuzz_matches_strict_json(spark):
    payloads = _mutations(seed=7, n=2000)
    rows = _run(
        spark, payloads, json_options={"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
    )
    diffs = [(p, r["status"], _expected(p)) for p, r in zip(payloads, rows) if r["status"] != _expected(p)]
    assert not diffs, diffs[:5]
    # field values of valid rows: strings exactly as Python reads them, null/missing as null
    checked = 0
    for p, r in zip(payloads, rows):
        if r["status"] != "ok":
            continue
        doc = json.loads(p)
        for f in FIELDS:
            v = doc.get(f)
            if v is None or isinstance(v, str):
                assert r[f] == v, (p, f)
                checked += 1
    assert checked > 0


def test_number_rendering_in_string_fields(spark):
    cases = {
        "1.50": "1.50",
        "12.0": "12.0",
        "1e3": "1e3",
        "-0": "-0",
        "1E+2": "1E+2",
        "3.14159265358979323846": "3.14159265358979323846",
        "0.000001": "0.000001",
        "12345678901234567890123": "12345678901234567890123",
        "-7": "-7",
        "true": "true",
    }
    rows = _run(spark, ['{"id":%s}' % k for k in cases])
    assert [(r["status"], r["id"]) for r in rows] == [("ok", v) for v in cases.values()]


@pytest.mark.parametrize(
    "conf", [("spark.sql.ansi.enabled", "false"), ("spark.sql.json.enablePartialResults", "false")]
)
def test_golden_matrix_under_other_session_settings(spark, conf):
    key, value = conf
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        rows = _run(spark, [p for p, _, _ in GOLDEN])
    finally:
        spark.conf.set(key, before)
    for (payload, status, fields), row in zip(GOLDEN, rows):
        assert row["status"] == status, payload
        assert tuple(row[f] for f in FIELDS) == (fields or (None, None, None, None)), payload


def test_other_atomic_fields(spark):
    import datetime

    schema = "d date, b boolean, x double"
    rows = _run(
        spark,
        [
            '{"d":"2024-01-02","b":true,"x":1.5}',
            '{"b":"maybe"}',
            '{"x":"abc"}',
            '{"d":"not a date"}',
            '{"d":null,"b":null,"x":null}',
            '{"b":"yes","x":"7"}',
        ],
        schema=schema,
    )
    assert (rows[0]["status"], rows[0]["d"], rows[0]["b"], rows[0]["x"]) == ("ok", datetime.date(2024, 1, 2), True, 1.5)
    assert [r["status"] for r in rows[1:5]] == ["bad_field", "bad_field", "bad_field", "ok"]
    # conversion follows Spark's variant cast: "yes" is true, "7" is 7.0
    assert (rows[5]["status"], rows[5]["b"], rows[5]["x"]) == ("ok", True, 7.0)


def test_timestamp_ntz_field_is_wall_time_in_session_zone(spark):
    rows = _run(spark, ['{"at":"2016-12-22T18:16:00+0100"}', '{"at":5}'], schema="at timestamp_ntz")
    assert rows[0]["status"] == "ok"
    assert rows[0]["at"] == dt.datetime(2016, 12, 22, 17, 16, 0)  # the test session runs in UTC
    assert rows[1]["status"] == "bad_field"


def test_classify_refuses_column_clashes(spark):
    df = spark.createDataFrame([("{}", "x")], "value string, status string")
    with pytest.raises(ValueError, match="status"):
        classify(df, EMPLOYEE)


def _strict(text):
    """Status and id that Python's parser gives a payload (for string ids)."""
    try:
        doc = json.loads(text)
    except ValueError:
        return ("malformed", None) if text.strip() else ("empty", None)
    if doc is None:
        return "json_null", None
    if not isinstance(doc, dict):
        return "malformed", None
    if isinstance(doc.get("id"), (dict, list)):
        return "nested_field", None
    return "ok", doc.get("id")


def test_payloads_cannot_escape_the_wrapper(spark):
    rng = random.Random(5)
    tokens = ["]", "]]", "[", "[[", "{", "}", ",", '"r":', '"w":', '"_n":', '"_corrupt":', '"id":', '"x"', "null", "1",
              '{"id":"1"}', '{"id":"2"}', '{"_n":"x"}', "\n"]
    fuzz = {"".join(rng.choices(tokens, k=rng.randrange(1, 9))) for _ in range(4000)}
    fuzz |= {p + "".join(rng.choices(tokens, k=rng.randrange(3))) for p in HOSTILE_PAYLOADS for _ in range(60)}
    # numbers as ids are another test's matter
    payloads = [*HOSTILE_PAYLOADS, *sorted(p for p in fuzz if '"id":1' not in p)]
    rows = _run(spark, payloads, schema="id string")
    wrong = [(p, r["status"], r["id"]) for p, r in zip(payloads, rows, strict=True) if (r["status"], r["id"]) != _strict(p)]
    assert wrong == []


def test_long_strings_and_numbers(spark):
    df = spark.range(1).selectExpr("0L AS offset", "concat('{\"id\":\"', repeat('x', 90 << 20), '\"}') AS value")
    assert classify(df, "id string").selectExpr("status", "length(record.id)").first() == ("ok", 90 << 20)
    digits = "7" * 1100
    rows = _run(spark, ['{"id":"1","zzz":%s}' % digits, '{"id":%s}' % digits, '{"id":-%s}' % digits[:40]], "id string")
    assert [(r["status"], r["id"]) for r in rows] == [("ok", "1"), ("ok", digits), ("ok", "-" + digits[:40])]
    far = ["1e400", "-1e400", "1e-400", "3." + "1" * 44]
    rows = _run(spark, ['{"id":%s}' % x for x in far], "id string")
    assert [(r["status"], r["id"]) for r in rows] == [("ok", x) for x in far]
    rows = _run(spark, ['{"a":%s,"b":1e3}' % digits, '{"b":%s,"b":5}' % digits], "a string, b string")
    assert [(r["a"], r["b"]) for r in rows] == [(digits, "1e3"), (None, "5")]


def test_numbers_beside_strings_and_keys_like_numbers(spark):
    payloads = {
        '{"id":2.50,"id":"1.0"}': ("1.0", None),
        '{"id":"1.0","id":2.50}': ("2.50", None),
        '{"\\u0069d":7.10}': ("7.10", None),
        '{"name":"a \\" 1.50 [,:","id":1.0}': ("1.0", 'a " 1.50 [,:'),
        """{'name':'5 "1.0" 6','id':1.0}""": ("1.0", '5 "1.0" 6'),
        '{"z":{"id":9.0},"id" : -0.0 , "y":[1.0,{"id":8.0}]}': ("-0.0", None),
        '{"1.0":2.0,"id":3.0}': ("3.0", None),
    }
    rows = _run(spark, list(payloads), "id string, name string")
    assert [(r["status"], r["id"], r["name"]) for r in rows] == [("ok", *v) for v in payloads.values()]
    options = {"allowComments": "true", "allowUnquotedFieldNames": "true", "allowNumericLeadingZeros": "true"}
    rows = _run(spark, ['{a1: 1.0, /* it\'s 5.0 "x */ id: 007} // 1.0'], "id string", json_options=options)
    assert [(r["status"], r["id"]) for r in rows] == [("ok", "007")]


def test_depth(spark):
    """A value of an unknown key may be of any depth; a field's is too deep beyond 1,000
    levels; broken payloads stay malformed however deep they are."""
    arrays, objects = "[" * 1100 + "]" * 1100, '{"id":' * 1100 + "1.50" + "}" * 1100
    far = "[" * 100_000 + "]" * 100_000
    cases = [
        ('{"id":1.50,"x":%s,"name":"q\\"[\\n"}' % arrays, "ok", ("1.50", 'q"[\n', None, None)),
        ('{"x":%s,"id":"S5","name":7.0,"firstName":true,"lastName":null}' % objects, "ok", ("S5", "7.0", "true", None)),
        ('{"x":%s,"id":"5","id":6.0}' % far, "ok", ("6.0", None, None, None)),
        ("{'x':%s, 'id' : 'a\"b'}" % arrays, "ok", ('a"b', None, None, None)),
        ('{"x":"%s","id":1.0}' % ("[1, " * 1000), "ok", ("1.0", None, None, None)),
        ('{"x":[%s1],"id":1.0}' % ("[1]," * 2000), "ok", ("1.0", None, None, None)),
        ('{"x":%s,"id":NaN}' % objects, "bad_field", None),
        ('{"x":%s,"id":{"a":1}}' % objects, "nested_field", None),
        ('{"id":%s}' % arrays, "too_deep", None),
        ('{"name":"a","id":%s}' % objects, "too_deep", None),
        ('{"id":%s}' % far, "too_deep", None),
        ('{"id":%s' % far, "malformed", None),
        ('{"x":%s,"id":"5"' % arrays, "malformed", None),
        ('{"x":%s,"id":"5"} {"id":2}' % arrays, "malformed", None),
        ('{"x":%s,"id":01}' % arrays, "malformed", None),
        ('{"x":%s,1:2}' % arrays, "malformed", None),
        (arrays, "malformed", None),
        ("[%s]" % objects, "malformed", None),
    ]
    rows = _run(spark, [p for p, _, _ in cases])
    got = [(r["status"], tuple(r[f] for f in FIELDS)) for r in rows]
    assert got == [(s, f or (None,) * 4) for _, s, f in cases]
    rows = _run(spark, ['{"z":%s,"n":7,"b":true,"d":"1.5","s":2.0}' % arrays, '{"z":%s,"n":"x"}' % arrays], "n int, b boolean, d double, s string")
    assert (rows[0]["n"], rows[0]["b"], rows[0]["d"], rows[0]["s"]) == (7, True, 1.5, "2.0")
    assert rows[1]["status"] == "bad_field"


def test_typed_fields_take_only_what_they_hold(spark):
    def statuses(schema, *values):
        return [r["status"] for r in _run(spark, ['{"x":%s}' % v for v in values], f"x {schema}")]

    ok, bad = "ok", "bad_field"
    assert statuses("int", "1", "1.0", "1e0", '"7"', "null", "1.7", "true", "3000000000") == [ok] * 5 + [bad] * 3
    assert statuses("boolean", "true", '"yes"', "2", "1.5", "0") == [ok, ok, bad, bad, bad]
    assert statuses("decimal(5,2)", "1.23", "1.5", "100", "1.239", "1000", "true") == [ok, ok, ok, bad, bad, bad]
    assert statuses("double", "1.5", "2", "1e400", "true") == [ok, ok, bad, bad]


def test_comment_after_the_document(spark):
    rows = _run(spark, ['{"id":"1"} // c', '{"id":"1"} /* c */'], "id string", json_options={"allowComments": "true"})
    assert [r["status"] for r in rows] == ["ok", "ok"]


def test_clashing_names_are_refused(spark):
    df = spark.createDataFrame([(0, "{}")], "offset long, value string")
    with pytest.raises(ValueError, match="clash"):
        records(classify(df, "id string, offset long"))
    with pytest.raises(ValueError, match="_n"):
        classify(df, "_n string")


def test_a_time_is_parsed_once(spark):
    df = spark.createDataFrame([(0, "{}")], "offset long, value string")
    plan = parsed_fields(classify(df, "id string, at timestamp"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("gettimestamp") == 1
