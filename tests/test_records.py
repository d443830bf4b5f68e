import json
import random

import model
import pytest
from pyspark.sql import functions as F

import promptsieve as ps
from promptsieve.operators.summary import clean_cells
from promptsieve.functions.jsontext import strict_parse
from promptsieve.operators import prompts as K

SHAPES = [
    {"id": "e", "conversation_id": "c", "user_id": "u", "created_at": "t", "message": {"id": "m", "role": "user", "content": "hello"}},
    {"event_id": "e", "conversation": {"id": "c"}, "message": {"id": "m", "author": {"role": "user", "id": "u"},
     "content": {"content_type": "text", "parts": ["What is policy?"]}, "create_time": 1770000000}},
    {"event_id": "e", "actor": {"type": "user", "user_id": "u", "user_email": "u@e.t"}, "timestamp": "outer",
     "conversation": {"id": "c"}, "message": {"id": "m", "author": {"type": "user"}, "content": {"value": "What?"}, "created_at": "inner"}},
    {"role": "assistant", "content": "r"},
    {"message": {"author": {"type": "assistant"}, "content": {"value": "r"}}},
    {"role": "assistant", "message": {"role": "user", "content": "the message's role counts"}},
    [{"role": "user", "content": "yes"}, {"role": "user", "content": "yes"}],
    {"z": {"role": "user", "content": "1", "id": "a"}, "a": {"role": "user", "content": "1", "id": "a", "user_id": "late"}},
    {"z": {"role": "user", "content": "1", "id": "a"}, "a": {"role": "user", "content": "2", "id": "a"}},
    {"role": "user", "content": {"parts": ["a", "b"]}, "child": {"role": "human", "text": "inner"}},
    {"role": "user", "content": None, "text": "not used"},
    {"role": "user", "content": {"parts": None, "text": "not used"}},
    {"role": "user", "message": "plain"},
    {"role": "USER", "prompt": ""},
    {"role": "", "sender_role": 0, "senderRole": "", "author": {"role": "user"}, "content": "an empty last alias stops"},
    {"role": "", "sender_role": None, "author": {"role": "", "type": ""}, "sender": {"role": "user"}, "content": "x"},
    {"author": {"role": "", "type": None}, "sender": {"type": "end_user"}, "input": "x"},
    {"user_id": "outer", "x": {"role": "user", "content": "own value wins", "user_id": "inner"}},
    {"user_id": "outer", "x": {"role": "user", "content": "falsy own value", "user_id": ""}},
    {"role": "user", "content": "falsy and nothing outside", "user_id": 0, "id": False, "event_id": "0"},
    {"conversation": "a string", "m": {"role": "user", "content": "x"}},
    {"conversation": '{"id": "not an object"}', "m": {"role": "user", "content": "x"}},
    {"user": "not an object", "actor": {"email": "a@b"}, "role": "user", "content": "x"},
    {"it's": {"a.b": [{"role": "user", "content": "keys with marks"}]}},
    {"text": '{"role": "user", "content": "JSON in a string is not walked"}', "role": "x"},
    {"role": "user", "content": [{"text": "a"}, {"value": ["b", {"parts": ["c"]}]}, 7, None, True, {"k": "v", "a": [1, {"b": "x, y: z"}]}]},
    {"role": "user", "content": {"kind": "image", "ref": 'q"uo: te, \\'}},
    5, "text", None, True, [], {},
]


def nested(depth: int):
    value = {"role": "user", "content": "deep", "id": "d"}
    for i in range(depth):
        value = [value] if i % 2 else {"n": value, "event_id": i}
    return value


def random_record(rng: random.Random, depth: int = 0):
    kind = rng.random()
    if depth > 4 or kind < 0.25:
        return rng.choice(["x", "user", "", 0, 1, True, False, None, "a b", [], {}, 2.5, "0", "false"])
    if kind < 0.45:
        return [random_record(rng, depth + 1) for _ in range(rng.randint(0, 3))]
    keys = K.ROLE_KEYS + K.EVENT_KEYS + K.CONVERSATION_KEYS + K.OWN_MESSAGE_KEYS + K.USER_KEYS[:3] + K.EMAIL_KEYS[:3]
    keys += K.CREATED_KEYS[:3] + K.PERSON_KEYS + K.CONTENT_KEYS + K.NORMAL_PARTS + ("message", "conversation", "type", "k")
    node = {rng.choice(keys): random_record(rng, depth + 1) for _ in range(rng.randint(1, 7))}
    if rng.random() < 0.5:
        node["role"] = rng.choice(["user", "Human", "assistant", "end_user", "", None])
    if rng.random() < 0.5:
        node[rng.choice(K.CONTENT_KEYS)] = random_record(rng, depth + 2)
    return node


@pytest.fixture(scope="module")
def records():
    rng = random.Random(11)
    return SHAPES + [nested(d) for d in (3, 13, 40, 90)] + [random_record(rng) for _ in range(1500)]


@pytest.fixture(scope="module")
def frame(spark, records):
    rows = [(i, json.dumps(r)) for i, r in enumerate(records)]
    return spark.createDataFrame(rows, "n int, t string").repartition(8).withColumn("record_json", strict_parse(F.col("t")))


def test_prompts_ids_order_and_text(frame, records):
    fields = (*K.CONTEXT_FIELDS, "prompt")
    rows = ps.prompt_rows(ps.extract_prompts(frame)).withColumn("prompt", ps.prompt_text())
    got = {}
    for row in rows.orderBy("n", "prompt_no").collect():
        got.setdefault(row.n, []).append({f: row[f] for f in fields})
    for n, record in enumerate(records):
        expected = model.prompts(record)
        assert got.get(n, []) == expected, json.dumps(record)


def test_model_responses(frame, records):
    got = {r.n: r.is_response for r in ps.with_record_facts(frame).collect()}
    assert got == {n: model.is_response(r) for n, r in enumerate(records)}


def test_many_prompts_in_one_record(spark):
    items = [{"role": "user", "content": f"p{i % 700}", "id": "same" if i % 2 else None} for i in range(3000)]
    df = spark.createDataFrame([(json.dumps({"items": items}),)], "record_json string")
    rows = ps.prompt_rows(ps.extract_prompts(df)).orderBy("prompt_no").collect()
    assert [r.content for r in rows] == [p["prompt"] for p in model.prompts({"items": items})]


def test_strict_parse(spark):
    good = ['{"a":1}', "[1, 2]", "1", '"s"', "null", " ".join(["[", "]"]), '{"a":{"b":1.50}}', '{"k":"\\u00e9"}', "[]"]
    bad = ['{"a":1} x', "1,2", "1] [2", "{}{}", "{bad", "{'a':1}", "{\"a\":01}", '{"a":"x\ty"}', "nul", '{"a":1,}', "[1", '"', ""]
    df = spark.createDataFrame([(t,) for t in good + bad], "t string")
    got = {r.t: r.p is not None for r in df.select("t", strict_parse(F.col("t")).alias("p")).collect()}
    assert got == {t: True for t in good} | {t: False for t in bad}


def test_decode_payload(spark):
    bodies = {
        "object": '{"a": 1}', "lines": '{"a":1}\n{"b":2}\n', "array": ' [{"a":1}, "s", null, [2]] ', "empty": " \n", "null": None,
        "broken": '\n{"a":1}\r\n\r\n{bad  {"b":2} x\x0b3', "blank line": "1\n \n2",
    }
    df = spark.createDataFrame(list(bodies.items()), "log_id string, body string")
    got = {}
    for r in ps.decode_payload(df).orderBy("log_id", "record_no").collect():
        got.setdefault(r.log_id, []).append((r.record_no, r.line_number, r.record_json, r.parse_ok))

    def stand_in(line, log_id, number):
        return json.dumps({"_unparsed_log_line": line, "source_log_id": log_id, "line_number": number}, separators=(",", ":"))

    assert got["object"] == [(0, None, '{"a":1}', True)]
    assert got["lines"] == [(0, 1, '{"a":1}', True), (1, 2, '{"b":2}', True)]
    assert got["array"] == [(i, None, t, True) for i, t in enumerate(['{"a":1}', '"s"', "null", "[2]"])]
    assert got["empty"] == got["null"] == [(None, None, None, None)]
    assert got["broken"] == [
        (0, 1, '{"a":1}', True), (1, 3, stand_in("{bad", "broken", 3), False),
        (2, 4, stand_in('{"b":2} x', "broken", 4), False), (3, 5, "3", True),
    ]
    assert [g[1] for g in got["blank line"]] == [1, 3]


REPEATED_KEYS = {
    '{"meta":{"a":1,"a":2},"message":{"role":"user","content":"x","id":"m"}}': ["x"],
    '{"items":[{"role":"user","content":"x","k":{"a":1,"a":2}},{"role":"user","content":"y"}]}': ["x", "y"],
    '{"role":"user","content":{"kind":"image","k":1,"k":2}}': ['{"k": 2, "kind": "image"}'],
    '{"message":{"role":"user","content":"a"},"message":{"role":"user","content":"b"}}': ["b"],
    '{"role":"user","content":"x","k":1,"k":2}': ["x"],
    '{"role":"user","content":"1","content":"2"}': ["2"],
    '{"items":[{"role":"user","content":"a \\"q\\" {\\\\\\\\}"},"{\\"role\\":\\"user\\",\\"content\\":\\"no\\"}"]}': ['a "q" {\\\\}'],
}


def test_of_repeated_keys_the_last_counts(spark):
    df = spark.createDataFrame(list(enumerate(REPEATED_KEYS)), "i int, record_json string")
    rows = ps.prompt_rows(ps.extract_prompts(df)).select("i", "prompt_no", ps.prompt_text().alias("t")).orderBy("i", "prompt_no").collect()
    assert [[r.t for r in rows if r.i == i] for i in range(len(REPEATED_KEYS))] == list(REPEATED_KEYS.values())
    body = '[{"role":"user","content":"x","m":{"a":1,"a":2}},{"role":"user","content":"y"}]'
    decoded = ps.decode_payload(spark.createDataFrame([("l", body)], "log_id string, body string")).collect()
    assert [r.record_no for r in decoded] == [0, 1] and all(r.parse_ok for r in decoded)


def test_long_prompts_are_whole(spark):
    """One string beyond the reader's default limit."""
    df = spark.createDataFrame([(json.dumps({"role": "user", "content": "y" * 21_000_000}),)], "line string")
    walked = ps.extract_prompts(df.withColumn("record_json", strict_parse(F.col("line"))))
    assert ps.prompt_rows(walked).select(F.length("content")).first()[0] == 21_000_000


def test_ids_of_different_types_are_different(spark):
    items = [{"role": "user", "content": "x", "id": i} for i in (1, "1", 1, "1", 2)]
    df = spark.createDataFrame([(json.dumps(items),)], "record_json string")
    rows = ps.prompt_rows(ps.extract_prompts(df)).orderBy("prompt_no").collect()
    assert [r.message_id for r in rows] == ["1", "1", "2"]


@pytest.mark.parametrize("depth", [6, 7, 40, 500])
def test_content_of_any_depth(spark, depth):
    content = ["first", 1.5, None, True, []]
    for i in range(depth):
        content = [content] if i % 3 else {"parts": content, "k": 1} if i % 2 else [{"text": content}, "after"]
    record = {"role": "user", "content": content}
    df = spark.createDataFrame([(json.dumps(record),)], "t string").withColumn("record_json", strict_parse(F.col("t")))
    text = ps.prompt_rows(ps.extract_prompts(df)).select(ps.prompt_text().alias("p")).first().p
    assert text == model.prompts(record)[0]["prompt"]


def test_wide_content(spark):
    record = {"role": "user", "content": [{"text": f"part {i}"} for i in range(20_000)]}
    df = spark.createDataFrame([(json.dumps(record),)], "record_json string")
    text = ps.prompt_rows(ps.extract_prompts(df)).select(ps.prompt_text().alias("p")).first().p
    assert text == model.prompts(record)[0]["prompt"]


def test_large_contents_do_not_vanish(spark):
    """Ten parts of 15 MB are one prompt, beyond what a VARIANT holds."""
    part = F.repeat(F.lit("abcdefghij klmno "), 900_000)
    parts = F.array(*(F.concat(part, F.lit(str(i))) for i in range(10)))
    record = F.to_json(F.struct(F.lit("human").alias("role"), F.struct(parts.alias("parts")).alias("content")))
    df = spark.range(1).select(record.alias("record_json"))
    rows = ps.prompt_rows(ps.extract_prompts(df)).select("content_kind", F.length("content").alias("n"), F.length(ps.prompt_text()).alias("t"))
    assert [(r.content_kind, r.n, r.t) for r in rows.collect()] == [("ARRAY", 10 * (17 * 900_000 + 3) + 11, 10 * (17 * 900_000 + 1) + 9)]


def test_strings_that_look_like_tags(spark):
    texts = ["n", "s", "null", ":null,", '"n"', 'x"n', "sn", "\\", '\\"n', "[null]", '{"a": null}', "", "nnn", "a\nnull"]
    record = {"null": None, "items": [{"role": "user", "id": t, "content": [t, None, {"k": t, "n": None}]} for t in texts]}
    df = spark.createDataFrame([(json.dumps(record),)], "t string").withColumn("record_json", strict_parse(F.col("t")))
    rows = ps.prompt_rows(ps.extract_prompts(df)).withColumn("prompt", ps.prompt_text()).orderBy("prompt_no").collect()
    assert [(r.message_id, r.prompt) for r in rows] == [(p["message_id"], p["prompt"]) for p in model.prompts(record)]
    assert [json.loads(r.raw) for r in rows] == record["items"]


def test_nested_cells_are_sorted_json(spark):
    value = {"b": [1, None, -2], "a": {"z": 'q"uote\n', "é": None}, "c": {2: True, 10: False}, "d.d": 1.5, "e": [], "f": None}
    schema = "v struct<b: array<int>, a: map<string, string>, c: map<int, boolean>, `d.d`: double, e: array<int>, f: struct<x: int>>, t string"
    table = spark.createDataFrame([(value, "a\x00b"), (None, None)], schema)
    rows = clean_cells(table).collect()
    wanted = '{"a": {"z": "q\\"uote\\n", "é": null}, "b": [1, null, -2], "c": {"2": true, "10": false}, "d.d": 1.5, "e": [], "f": null}'
    assert [tuple(r) for r in rows] == [(wanted, "ab"), ("", "")]
