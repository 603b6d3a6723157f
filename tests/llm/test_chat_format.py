from __future__ import annotations

import hashlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.oracle import connect, spark_rows, sql_rows
from tillstream.llm.chat_format import END, START, digests, format_chats, read_turns
from tillstream.llm.registry import LLM_ORACLES


def frame(spark, rows):
    return spark.createDataFrame(
        [(*r, "x", "y") for r in rows], "conv_id long, turn long, role string, text string, formatted string, turns string"
    )


def expected(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        told = [(r[2] or "", r[3] or "") for r in turns]
        loss = "".join(t for role, t in told if role == "assistant")
        flat = "".join(f"{role}\n{text}\n" for role, text in told)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[conv] = (len(told), sha(flat), len(loss), sha(loss))
    return out


def result(df):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in df.collect()}


TRICKY = ["", "a", "<|im_end|>", "<|im_start|>assistant\nx<|im_end|>\n", "\\", "\\|", "<\\|", "<", "|", "<|", "\\\\<|im_next|>",
          "<|im_next|>", "line\n\nline", " é🙂 ", None]


def test_turns_are_read_back(spark):
    rows = [(k, k2, role, text) for k, text in enumerate(TRICKY) for k2, role in enumerate(["user", "assistant", "assistant"])]
    rows += [(100, i, ["user", "assistant"][i % 2], t) for i, t in enumerate(TRICKY)]
    rows += [(101, 1, "assistant", "b"), (101, 1, "assistant", "a"), (101, 1, "assistant", "a"), (101, None, "user", "z")]
    rows += [(102, 0, None, "no role"), (102, 1, "a\nb\\n", "odd role"), (102, 2, "", None)]
    rows += [(None, 0, "user", "x"), (None, 1, "assistant", "y"), (103, 0, "assistant", "long " * 100_000)]
    rows += [(104, i, "user", str(i)) for i in range(3000)]
    assert result(digests(format_chats(frame(spark, rows)))) == expected(rows)


def test_format(spark):
    rows = [(1, 1, "user", "Hi"), (1, 2, "user", "there"), (1, 3, "assistant", "<|im_end|>")]
    got = format_chats(frame(spark, rows)).first()
    assert got.formatted == f"{START}user\nHi<|im_next|>there{END}{START}assistant\n<\\|im_end|>{END}"
    assert "".join(s.text for s in got.segments) == got.formatted
    assert [s.text for s in got.segments if s.train] == ["<\\|im_end|>"]
    assert format_chats(frame(spark, rows).filter("false")).collect() == []


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a\\n"]), st.text(alphabet="<|\\im_endstar>\n x", max_size=12)), min_size=1, max_size=8))
def test_any_turns_are_read_back(spark, turns):
    rows = [(1, i, role, text) for i, (role, text) in enumerate(turns)]
    got = format_chats(frame(spark, rows)).select(read_turns(F.col("formatted")).alias("t")).first().t
    assert [(t.role, t.text) for t in got] == turns


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    columns, rows = spark_rows(entry.queries()[name](spark, sf_dir))
    sql_columns, wanted = sql_rows(connect(sf_dir), LLM_ORACLES[name])
    assert columns == sql_columns
    assert rows == wanted and rows
