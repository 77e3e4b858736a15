"""Chat formatting: the query against SQL and a text parser, reply trees against brute force, odd rows."""

from __future__ import annotations

import hashlib
import re

from compare import compare, duck
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortlens.llm import chat
from cohortlens.llm.queries import ORACLES, op2_chat

SF = "/root/testdata/sf0.01"
MSG = "conv_id long, msg_id long, parent_id long, role string, text string, score double"


def read_back(formatted):
    """(role, text) per turn by plain string operations."""
    def plain(s):
        return re.sub(r"\\(.)", lambda m: {"\\": "\\", "l": "<", "h": "#", "c": ":"}[m[1]], s, flags=re.S)

    out = []
    for piece in formatted.split("</turn>\n")[:-1]:
        assert piece.startswith("### ")
        role, text = piece[4:].split(": ", 1)
        out.append((plain(role[1:]) if role.startswith("=") else role.lower(), plain(text)))
    return out


def test_query_against_sql(spark):
    got = op2_chat(spark, SF)
    problems, n, _ = compare(got, duck(SF), ORACLES["op2_chat"])
    assert not problems and n == 101
    row = got.where("conv_id = -7").first()
    text = "\\### Assistant: </turn> ok"
    assert row.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
    assert row.loss_sha256 == hashlib.sha256(text.encode()).hexdigest() and row.loss_chars == len(text)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="\\#</turn>\n: hlcé=###😀", max_size=30), min_size=1, max_size=30))
def test_escapes_round_trip(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("b")).collect():
        assert r.b == r.t and "###" not in r.e and "</turn>" not in r.e


def test_reply_tree_branches(spark):
    rows = [(1, 10, None, "user", "root", 1.0), (1, 11, 10, "assistant", "a", 5.0), (1, 12, 10, "assistant", "b", 3.0), (1, 13, 11, "user", "c", None),
            (1, 14, 13, "assistant", "d", 9.0), (1, 15, 12, "user", "e", 3.0), (2, 10, None, "user", "only", None), (3, 1, 99, "user", "dangling", 1.0),
            (4, 1, 2, "user", "cycle", 1.0), (4, 2, 1, "user", "cycle", 1.0), (4, 3, 2, "user", "leaf on a cycle", 1.0), (4, 5, 5, "user", "self", 0.0),
            (None, 1, None, "user", "null tree", 0.0), (None, 2, 1, "tool: ###", None, 0.0)]
    got = chat.conversations(spark.createDataFrame(rows, MSG)).collect()
    told = {(r.conv_id, r["leaf"]): (r["rank"], round(r.score, 6), [t for _, t in read_back(r.formatted)]) for r in got}
    assert told == {(1, 14): (1, 3.75, ["root", "a", "c", "d"]), (1, 15): (2, round(7 / 3, 6), ["root", "b", "e"]), (2, 10): (1, 0.0, ["only"]),
                    (3, 1): (1, 1.0, ["dangling"]), (4, 5): (1, 0.0, ["self"]), (None, 2): (1, 0.0, ["null tree", ""])}
    assert read_back([r for r in got if r.conv_id is None][0].formatted)[1] == ("tool: ###", "")
    best = chat.conversations(spark.createDataFrame(rows, MSG), best=1).collect()
    assert sorted((r.conv_id or 0, r["leaf"]) for r in best) == [(0, 2), (1, 14), (2, 10), (3, 1), (4, 5)]
    for r in got:
        assert [unescape_py(r.formatted[s.start:s.start + s.chars]) for s in r.spans] == [t for role, t in read_back(r.formatted) if role == "assistant"]


def unescape_py(s):
    return re.sub(r"\\(.)", lambda m: {"\\": "\\", "l": "<", "h": "#", "c": ":"}[m[1]], s)


def test_deep_and_wide_trees(spark):
    chain = [(1, i, i - 1 if i else None, "user", str(i), 0.0) for i in range(100)]
    star = [(2, i, 0 if i else None, "assistant", str(i), float(i)) for i in range(200)]
    got = chat.conversations(spark.createDataFrame(chain + star, MSG)).collect()
    one = [r for r in got if r.conv_id == 1]
    assert len(one) == 1 and [t for _, t in read_back(one[0].formatted)] == [str(i) for i in range(100)]
    two = {r["leaf"]: r for r in got if r.conv_id == 2}
    assert len(two) == 199 and two[199]["rank"] == 1 and all(r.n_turns == 2 for r in two.values())


def test_linear_odd_rows(spark):
    rows = [(1, 0, "user", None), (1, 0, "user", None), (1, None, None, "no turn"), (2, 5, "assistant", "x" * 500_000), (None, 1, "assistant", ""), (3, 1, "assistant", "😀 é"), (3, 0, "", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("score", F.lit("x")).withColumn("msg_id", F.lit("x"))
    got = {r.conv_id: r for r in chat.conversations(chat.as_tree(df)).collect()}
    assert read_back(got[1].formatted) == [("", "no turn"), ("user", ""), ("user", "")]
    assert got[None].n_turns == 1 and read_back(got[3].formatted) == [("", ""), ("assistant", "😀 é")]
    back = chat.turns(F.col("formatted"))
    one = spark.createDataFrame([(got[3].formatted,)], "formatted string").select(back.alias("r")).first().r
    assert [(t.role, t.text) for t in one] == read_back(got[3].formatted)
    assert chat.conversations(chat.as_tree(df.where("false"))).count() == 0
