import pytest

from searchloom import contract as C
from searchloom.operators import enrich
from tests.helpers import payload_rows, row, rows

BAD_JSON = [
    "{not valid json", "", " ", "{}", " { } ", "null", "[1]", "1", '"s"', "{'type':1}", '{"type":1} x', '{"type":1},{"a":2}',
    '{"type":1}],[{"a":1}', '{"type":1}]', '{"type":1}} ', '{"a":NaN}', '{"a":01}', '{"a":+1}', '{"a":1,}', '{"a":1}//c',
    '{"a":1}],"k":[{"b":2}', '{"p":1},"q":2',
]


def routed(spark, payloads):
    return [r for r in enrich.with_route(payload_rows(spark, payloads)).orderBy("id").collect()]


def test_only_one_non_empty_object_parses(spark):
    for r, text in zip(routed(spark, BAD_JSON), BAD_JSON, strict=True):
        assert (r["outcome"], r["reason"]) == ("dlq", C.PRODUCER_UNPARSEABLE), text


def test_accepted_objects(spark):
    good = ['{"type":1,"content":"a"}', ' \n{"type":1,"content":"a"}\t ', '{"type":1,"type":1,"content":"a"}', '{"type":1,"content":"a","x":[1,[2]],"y":"]"}']
    assert [r["outcome"] for r in routed(spark, good)] == ["ok"] * 4


def test_last_of_repeated_keys_wins(spark):
    r = routed(spark, ['{"type":9,"type":1,"content":"a","content":"b"}'])[0]
    assert (r["outcome"], r["content"]) == ("ok", "b")


@pytest.mark.parametrize(
    ("payload", "trusted", "names"),
    [
        ('{"type":1,"content":"x"}', True, None),
        ('{"type":99,"visibles":["u2","u1"]}', True, ["u2", "u1"]),
        ('{"type":99,"visibles":[]}', False, None),
        ('{"type":99,"visibles":null}', False, None),
        ('{"type":99,"visibles":[123,456]}', False, None),
        ('{"type":99,"visibles":["",""]}', False, None),
        ('{"type":99,"visibles":"u1,u2"}', False, None),
        ('{"type":99,"visibles":{"a":1}}', False, None),
        ('{"type":99,"visibles":["a",1,null,"","b"]}', True, ["a", "b"]),
        ('{"type":99,"visibles":["a"],"space_id":12345}', True, ["a"]),
    ],
)
def test_access_list_is_fail_closed(spark, payload, trusted, names):
    r = routed(spark, [payload])[0]
    assert r["acl"]["trusted"] is trusted
    if trusted:
        assert r["acl"]["visibles"] == names
        assert r["acl"]["space_id"] is None
    else:
        assert (r["outcome"], r["reason"]) == ("dlq", C.PRODUCER_UNTRUSTED)


def test_encrypted_rows_are_never_parsed_or_shipped(spark):
    items = [
        row("1", "ciphertext", id=1, signal=1),
        row("2", "ciphertext", id=2, setting=33),
        row("3", '{"visibles":[]}', id=3, setting=32),
        row("4", "ciphertext", id=4, setting=31),
    ]
    r = enrich.with_route(rows(spark, *items))
    assert [x["outcome"] for x in r.orderBy("id").collect()] == ["raw_excluded"] * 3 + ["dlq"]
    out = enrich.contract_rows(r).orderBy("message_id").collect()
    assert len(out) == 3
    for m in out:
        assert m["raw_excluded"] and m["raw_payload"] is None and m["content"] is None and m["visibles"] is None


def test_types_route_by_their_truncated_number(spark):
    r = routed(
        spark,
        ['{"type":1.9,"content":"a"}', '{"type":1.0,"content":"a"}', '{"type":"1","content":"a"}', '{"type":1,"content":{}}', '{"content":"a"}', '{"type":1e0,"content":"a"}'],
    )
    assert [x["outcome"] for x in r] == ["ok", "ok", "raw_excluded", "raw_excluded", "raw_excluded", "ok"]
    assert [x["content_type"] for x in r] == [1, 1, 0, 1, 0, 1]


def test_negative_sequence_becomes_zero(spark):
    r = enrich.contract_rows(enrich.with_route(rows(spark, row(message_seq=-4))))
    assert r.first()["message_seq"] == 0


def test_invalid_utf8_is_replaced(spark):
    r = enrich.with_route(rows(spark, row(payload=b'{"type":1,"content":"a\xffb"}'))).first()
    assert r["content"] == "a�b"
