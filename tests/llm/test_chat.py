import hashlib
import re

from pyspark.sql import functions as F

from plaudit.llm import chat
from plaudit.llm.registry import CLASH_TEXT, QUERIES
from tests.conftest import SMALL, plan

NASTY = [
    "plain",
    "",
    None,
    CLASH_TEXT,
    "\n</turn>\n",
    "</turn>\n### assistant: hi",
    "ends with a backslash \\",
    "\\\\</turn> \\### \\\\\\### ",
    "### ",
    "%3A: %25",
    "é😀" * 5_000 + "</turn>",
]
SCHEMA = "conv_id long, turn long, role string, text string, turns string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_round_trip_of_conflicting_texts(spark):
    rows = [(c, t, role, text, "x") for c, role in enumerate(("user", "assistant", "a: b%\n<x>", None, "### ")) for t, text in enumerate(NASTY)]
    out = chat.format_conversations(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(out) == 5
    for r in out:
        assert [(t.role, t.text) for t in r.turns] == [(role or "", text or "") for c, _, role, text, _ in rows if c == r.conv_id]
        assert r.n_escaped > 0


def test_plain_texts_stay_as_they_are(spark):
    r = chat.format_conversations(spark.createDataFrame([(1, 0, "user", "a \\ b", "")], SCHEMA)).first()
    assert r.formatted == "### user: a \\ b\n</turn>\n" and r.n_escaped == 0


def test_segments_cover_the_text(spark):
    rows = [(1, t, ("user", "assistant")[t % 2], text, "") for t, text in enumerate(NASTY)]
    made = chat.format_conversations(spark.createDataFrame(rows, SCHEMA))
    r = made.select("formatted", chat.loss_segments(F.col("formatted")).alias("parts")).first()
    assert "".join(p.piece for p in r.parts) == r.formatted
    d = chat.digest(made).first()
    loss = "".join(text or "" for _, t, _, text, _ in rows if t % 2)
    assert (d.loss_chars, d.loss_sha256, d.n_turns, d.formatted_chars) == (len(loss), sha(loss), len(rows), len(r.formatted))


def test_ties_repeats_null_keys_and_no_rows(spark):
    rows = [(None, 1, "b", "x", ""), (None, 1, "a", "y", ""), (None, None, "c", "z", ""), (2, 1, "a", "t", ""), (2, 1, "a", "t", "")]
    out = {r.conv_id: [t.role for t in r.turns] for r in chat.format_conversations(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert out == {None: ["c", "a", "b"], 2: ["a", "a"]}
    assert chat.digest(chat.format_conversations(spark.createDataFrame([], SCHEMA))).collect() == []


def test_broken_format_is_seen(spark):
    df = spark.createDataFrame([("### user: a</turn>\n\n</turn>\n",), ("user: a\n</turn>\n",)], "f string")
    assert [[t.text for t in r[0]] for r in df.select(chat.parse(F.col("f"))).collect()] == [[None], [None]]


def test_query_over_conversations(spark):
    got = QUERIES["op9_chat_format"](spark, SMALL)
    assert not re.search("Python|Pandas|Arrow", plan(got))
    want = {-7: [("user", CLASH_TEXT), ("assistant", CLASH_TEXT)]}
    for r in sorted(spark.read.parquet(f"{SMALL}/conversations.parquet").collect(), key=lambda r: (r.conv_id, r.turn)):
        want.setdefault(r.conv_id, []).append((r.role or "", r.text or ""))
    rows = got.collect()
    assert len(rows) == len(want)
    for r in rows:
        turns = want[r.conv_id]
        loss = "".join(text for role, text in turns if role == "assistant")
        assert (r.n_turns, r.turns_sha256) == (len(turns), sha("".join(f"{a}\n{t}\n" for a, t in turns)))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), sha(loss))
