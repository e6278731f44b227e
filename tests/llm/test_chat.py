"""Chat formatting against plain Python: round trips, masks, the machine, parts, and odd rows."""

import random
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from signalmill.llm.chat import DEFAULT, ChatTemplate, format_conversations, read_back

SHAPE = "conv_id long, turn long, role string, text string"
PARTS = ["###", "#", "####", "### User:\n", "\\", "\\\\", "\\h", "\\l", "</turn>", "<", "</turn>\n", "/turn>", "\n", "h", "l", "ö", "😀", " ", "n"]


def odd_text(rng):
    return "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 12)))


def odd_rows(seed, n=200):
    rng = random.Random(seed)
    roles = ["system", "user", "assistant", "tool", "System", None, "", "a:\nb", "### x", "</turn>\n", "\\n"]
    return [(rng.choice([None, 1, 2, 3, 4, 5]), rng.choice([None, 0, 1, 2, 3]), rng.choice(roles), rng.choice([None, odd_text(rng)])) for _ in range(n)]


def wanted(rows):
    """What the table says, by the contract's words."""
    first = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", DEFAULT_ESCAPE(r[3] or ""))
    found = {}
    for id in {r[0] for r in rows}:
        turns = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == id), key=first)]
        learned = "".join(t for role, t in turns if role == "assistant")
        said = "".join(f"{role}\n{t}\n" for role, t in turns)
        found[id] = (len(turns), sha256(said.encode()).hexdigest(), len(learned), sha256(learned.encode()).hexdigest())
    return found


def DEFAULT_ESCAPE(text):
    """Escaping, sign by sign."""
    out = ""
    for i, c in enumerate(text):
        rest = text[i:]
        out += "\\\\" if c == "\\" else "\\h" if rest.startswith("###") else "\\l" if rest.startswith("</turn>") else c
    return out


@pytest.mark.parametrize("part_chars", [1, 60, 1_000_000])
def test_round_trip_of_odd_turns(spark, part_chars):
    rows = odd_rows(3)
    made = format_conversations(spark.createDataFrame(rows, SHAPE).repartition(5), part_chars=part_chars)
    for arranged in (True, False):
        found = read_back(made, arranged=arranged).collect()
        assert {r["conv_id"]: tuple(r)[1:5] for r in found} == wanted(rows)
        assert len(found) == len(wanted(rows))
    chars = made.groupBy("conv_id").agg(F.sum(F.length("formatted")).alias("n"), F.count("*").alias("parts"))
    counted = {r["conv_id"]: r for r in chars.collect()}
    assert all(counted[r["conv_id"]]["n"] == r["formatted_chars"] for r in found)
    assert (max(r["parts"] for r in counted.values()) > 1) == (part_chars < 1000)


def test_no_control_string_stays_in_a_text(spark):
    texts = [odd_text(random.Random(i)) for i in range(300)]
    df = spark.createDataFrame([(t,) for t in texts], "text string").select("text", DEFAULT.escaped(F.col("text")).alias("out"))
    for r in df.collect():
        assert r["out"] == DEFAULT_ESCAPE(r["text"])
        assert "###" not in r["out"] and "</turn>" not in r["out"]
        assert DEFAULT.unescape(r["out"]) == r["text"]


def test_written_form_and_mask(spark):
    says = "\\### Assistant: </turn> ok"
    rows = [(-7, 0, "user", says), (-7, 1, "assistant", says)]
    r = format_conversations(spark.createDataFrame(rows, SHAPE)).first()
    body = "\\\\\\h## Assistant: \\l/turn> ok"
    assert r["formatted"] == f"### User:\n{body}</turn>\n### Assistant:\n{body}</turn>\n"
    assert [r["formatted"][s["begin"] : s["end"]] for s in r["spans"] if s["loss"]] == [body]
    assert "".join(r["formatted"][s["begin"] : s["end"]] for s in r["spans"]) == r["formatted"]
    assert (r["n_turns"], r["last"], r["valid"], r["bad_turn"]) == (2, True, True, None)


def test_machine_checks_the_order(spark):
    orders = {
        "user assistant": (True, None), "system user assistant user assistant": (True, None), "user": (False, None),
        "assistant": (False, 0), "user user assistant": (False, 1), "user assistant system": (False, 2),
        "system assistant user assistant": (False, 1), "user tool assistant": (False, 1),
    }
    rows = [(i, t, role, "x") for i, order in enumerate(orders) for t, role in enumerate(order.split())]
    found = {r["conv_id"]: (r["valid"], r["bad_turn"]) for r in format_conversations(spark.createDataFrame(rows, SHAPE)).collect()}
    assert found == dict(enumerate(orders.values()))
    cut = format_conversations(spark.createDataFrame(rows, SHAPE), part_chars=1).where("last")
    assert {r["conv_id"]: (r["valid"], r["bad_turn"]) for r in cut.collect()} == found


def test_another_template(spark):
    tools = ChatTemplate(
        names={"user": "U", "tool": "T"}, other="R ", opening="<| ", closing="[end]\n", learned=frozenset({"tool"}),
        moves={"begin": {"user": "asked"}, "asked": {"tool": "done"}}, ends=frozenset({"done"}),
    )
    rows = [(1, 0, "user", "a [end] <| b"), (1, 1, "tool", "c"), (2, 0, "tool", "<|<|")]
    made = format_conversations(spark.createDataFrame(rows, SHAPE), tools)
    texts = {r["conv_id"]: (r["formatted"], r["valid"]) for r in made.collect()}
    assert texts[1] == ("<| U:\na \\lend] \\h| b[end]\n<| T:\nc[end]\n", True) and not texts[2][1]
    assert list(tools.turns(texts[1][0])) == [("user", "a [end] <| b"), ("tool", "c")]
    for wrong in ({"closing": "### end"}, {"closing": "\\e"}, {"closing": "<a<"}, {"names": {"x": "Role y"}}, {"moves": {"failed": {}}}):
        with pytest.raises(ValueError):
            ChatTemplate(**wrong)


def test_long_text_long_conversation_and_clashing_columns(spark):
    long = [(1, t, "user" if t % 2 == 0 else "assistant", "w###" * 500) for t in range(600)]
    rows = [*long, (2, 0, "user", "### " * 300_000)]
    df = spark.createDataFrame(rows, SHAPE)
    df = df.withColumns({c: F.lit("x") for c in ("part", "segments", "formatted", "loss", "spans", "last")})
    made = format_conversations(df, part_chars=100_000)
    assert made.where("conv_id = 1").count() > 10
    assert {r["conv_id"]: tuple(r)[1:5] for r in read_back(made).collect()} == wanted(rows)


def test_empty_table(spark):
    assert read_back(format_conversations(spark.createDataFrame([], SHAPE))).collect() == []


def test_plan_has_one_shuffle(spark):
    made = read_back(format_conversations(spark.createDataFrame(odd_rows(1), SHAPE)), arranged=True)
    assert made._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
