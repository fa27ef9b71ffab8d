import random

import numpy as np
import pyarrow as pa

from siftlane.sources import records as R

GOOD = "block,||a.example^,a.example,false,,ads,2024-02-29"
CASES = [
    (GOOD, None),
    (GOOD + "\r", None),
    (' block , ||a.example^ ,x, true ,, , ', None),
    ('"block","||a.example^","x","true","","",""', None),
    ('"block","||a.example^$client=a,b","x,y","true","a""b","other","2023-01-01"\r', None),
    ('allow,"@@/a,""b""/$a,b",,false,,,', None),
    ("block,/a\nb/,,false,,,", None),
    ('block,"/a\nb,c/",,false,,,', None),
    (GOOD.replace("block", 'bl"ock'), "quoting"),
    (GOOD.replace("block", ' "block"'), "quoting"),
    (GOOD.replace("block", '"block" '), "quoting"),
    (GOOD.replace("block", '"block" ok'), "quoting"),
    (GOOD.replace("block", '"block'), "quoting"),
    ('"' , "quoting"),
    ('block,"||a.example^', "quoting"),
    (GOOD + ",x", "column_count"),
    ("block,||a.example^,a.example,false,,ads", "column_count"),
    (None, "column_count"),
    ("", "column_count"),
    (" \t\r", "column_count"),
    ("\xa0", "column_count"),
    (GOOD + "\r\r", None),
    (GOOD.replace("block", "Block"), "invalid_value"),
    (GOOD.replace("block", '" block"'), "invalid_value"),
    (GOOD.replace("false", "no"), "invalid_value"),
    (GOOD.replace("ads", "ad"), "invalid_value"),
    (GOOD.replace("02-29", "02-30"), "invalid_value"),
    (GOOD.replace("2024", "2023"), "invalid_value"),
    (GOOD.replace("2024-02-29", "1.2.2024"), "invalid_value"),
    (GOOD.replace("2024-02-29", "0000-01-01"), "invalid_value"),
    (GOOD.replace("||a.example^", "||example^"), "invalid_value"),
    (GOOD.replace("||a.example^", "||a.b^"), "invalid_value"),
    (GOOD.replace("||a.example^", "||a.bc^"), None),
    (GOOD.replace("||a.example^", "||" + "x" * 64 + ".example^"), "invalid_value"),
    (GOOD.replace("||a.example^", "||" + ("x" * 60 + ".") * 5 + "example^"), "invalid_value"),
    (GOOD.replace("||a.example^", "||a..example^"), "invalid_value"),
    (GOOD.replace("||a.example^", "||a.example^^"), "invalid_value"),
    (GOOD.replace("||a.example^", "||*.a_b-c.example^$x=1"), None),
    (GOOD.replace("||a.example^", "/x/$A"), "invalid_value"),
    (GOOD.replace("||a.example^", "//"), "invalid_value"),
]


def plain(body):
    """The quoting rule and the columns, byte by byte."""
    fields, current, state = [], "", "start"
    for c in body:
        if state == "quoted":
            if c == '"':
                state = "closed"
            else:
                current += c
        elif state == "closed":
            if c == '"':
                current, state = current + c, "quoted"
            elif c == ",":
                fields.append(current)
                current, state = "", "start"
            else:
                return None
        elif c == ",":
            fields.append(current.strip())
            current, state = "", "start"
        elif c == '"':
            if state != "start":
                return None
            state = "quoted"
        else:
            current, state = current + c, "plain"
    if state == "quoted":
        return None
    return [*fields, current if state == "closed" else current.strip()]


def test_cases(spark):
    df = spark.createDataFrame([(i, b, "x") for i, (b, _) in enumerate(CASES)] + [(None, None, "x")], "feed_id long, body string, reason string")
    got = {r["feed_id"]: r for r in R.split_records(df).collect()}
    for i, (body, why) in enumerate(CASES):
        assert got[i]["reason"] == why, body
        assert (got[i]["rule_type"] is None) == (why is not None)
    assert got[None]["reason"] == "column_count"
    assert got[4]["modifiers"] == 'a"b' and got[4]["normalized_domain"] == "x,y" and got[4]["wildcard"] is True
    assert got[0]["added_on"].isoformat() == "2024-02-29" and got[2]["added_on"] is None and got[2]["category"] is None
    assert got[8]["reason_at"] == 2 and got[22]["reason_column"] == "rule_type" and got[24]["reason_at"] == GOOD.index("false")


def test_against_bytes():
    rng = random.Random(1)
    bodies = ["".join(rng.choices('"",,ab \n\ré', k=rng.randint(0, 60))) for _ in range(3000)] + ['"' + "x,\n" * 5000 + '"' + ",a" * 6, '"' * 1001]
    got = R.read_records(pa.array(bodies))
    for body, why in zip(bodies, got["reason"].to_pylist()):
        fields = plain(body[:-1] if body.endswith("\r") else body)
        assert (why == "quoting") == (fields is None), body
        if fields is not None:
            assert (why == "column_count") == (len(fields) != 7 or not body.strip()), body


def test_chunks_compose():
    rng = np.random.default_rng(0)
    classes = rng.integers(0, 4, 5000).astype(np.uint8)
    state, want = R.START, []
    for c in classes:
        want.append(state)
        state = R.NEXT[c, state]
    for chunk in (1, 7, 64, 4999, 9000):
        assert R.states_before(classes, chunk).tolist() == want


def test_empty(spark):
    assert R.split_records(spark.createDataFrame([], "feed_id long, body string")).count() == 0
    assert len(R.read_records(pa.array([], pa.string()))["reason"]) == 0
