import hashlib

from hypothesis import given
from hypothesis import strategies as st

from tallyloom.llm.chat import TEMPLATE, format_turns, read_back

SCHEMA = "conv_id long, turn long, role string, text string"
PARTS = st.sampled_from(["\\", ":", "<", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "\\:", "a", " ", "é"])
TEXT = st.lists(PARTS, max_size=8).map("".join)
ROLE = st.one_of(st.sampled_from(["system", "user", "assistant", ""]), TEXT)


@given(st.lists(st.tuples(ROLE, TEXT), max_size=6))
def test_any_turns_parse_back(turns):
    parts = [TEMPLATE.segments(role, text) for role, text in turns]
    formatted = "".join(t for p in parts for t, _ in p)
    assert TEMPLATE.parse(formatted) == turns
    learned = "".join(TEMPLATE.unescape(t) for p in parts for t, loss in p if loss)
    assert learned == "".join(text for role, text in turns if role == "assistant")
    for _, text in turns:
        assert not any(c in TEMPLATE.escape(text) for c in TEMPLATE.control)


def expected(turns):
    text = "".join(t or "" for r, t in turns if r == "assistant")
    whole = "".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)
    return (
        len(turns),
        hashlib.sha256(whole.encode()).hexdigest(),
        len(text),
        hashlib.sha256(text.encode()).hexdigest(),
    )


def test_conversations(spark):
    data = {
        1: [("system", "be"), ("user", "hi"), ("assistant", "yo </s>"), ("user", "q"), ("assistant", "a")],
        2: [("user", "hi")],
        3: [("assistant", "first"), ("assistant", "again")],
        4: [("user", None), ("assistant", None)],
        5: [(None, "nobody"), ("tool", "x\\:<<SAYS>>")],
        6: [("user", "long " * 50_000), ("assistant", "é" * 50_000)],
        None: [("user", "x"), ("assistant", "y")],
    }
    rows = [(c, i, r, t) for c, turns in data.items() for i, (r, t) in enumerate(turns)]
    found = read_back(format_turns(spark.createDataFrame(rows[::-1], SCHEMA))).collect()
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in found}
    assert got == {c: expected(turns) for c, turns in data.items()}
    assert {r.conv_id for r in found if r.valid} == {1, 4, 6, None}


def test_ties_and_null_turns(spark):
    rows = [(1, 1, "user", "b"), (1, 1, "user", "a"), (1, None, "user", "z"), (1, 1, "user", "a")]
    frame = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("x", "valid")
    row = read_back(format_turns(frame.selectExpr("*", "1 AS valid", "2 AS place"))).first()
    assert tuple(row)[1:3] == expected([("user", t) for t in "zaab"])[:2]


def test_empty_table(spark):
    assert read_back(format_turns(spark.createDataFrame([], SCHEMA))).count() == 0


def test_segments_carry_loss_flags(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "a")]
    turns = format_turns(spark.createDataFrame(rows, SCHEMA)).orderBy("place").collect()
    flags = [[(s.text, s.loss) for s in t.segments] for t in turns]
    assert flags == [
        [("<s>[INST] ", False), ("q", False), (" [/INST]", False)],
        [("[OUT] ", False), ("a", True), ("</s>", False)],
    ]
    assert [t.last for t in turns] == [False, True]
