import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from depotlake.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def restored(spark, rows):
    formatted = chat.format_conversations(spark.createDataFrame(rows, SCHEMA))
    return {r.conv_id: ([tuple(t) for t in r.turns], r.loss_text, r.valid) for r in chat.read_back(formatted).collect()}


def expected(rows):
    out = {}
    for conv, _turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        out.setdefault(conv, []).append((role or "", text or ""))
    return {c: (t, "".join(x for role, x in t if role == "assistant")) for c, t in out.items()}


TEXT = st.one_of(st.none(), st.lists(st.sampled_from(["<", "|", "<|", "|>", "\\", "end", "<|end|>", "<|text|>", "</s>", "[INST]", "[/INST]", "<\\|", "\n", "é", " "]), max_size=8).map("".join))


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 2), st.one_of(st.none(), st.integers(0, 3)), st.one_of(st.sampled_from(["user", "assistant"]), TEXT), TEXT), min_size=1, max_size=25))
def test_everything_is_read_back(spark, rows):
    assert {c: v[:2] for c, v in restored(spark, rows).items()} == expected(rows)


@pytest.mark.parametrize(
    ("roles", "valid"),
    [
        ("user assistant", True),
        ("system user assistant user assistant", True),
        ("user", False),
        ("assistant user assistant", False),
        ("user user assistant", False),
        ("user system assistant", False),
        ("user assistant tool", False),
        ("user bot user assistant", False),
    ],
)
def test_turn_order(spark, roles, valid):
    rows = [(1, i, role, "t") for i, role in enumerate(roles.split())]
    assert restored(spark, rows)[1][2] is valid


def test_segments_carry_the_loss_flag(spark):
    rows = [(1, 1, "assistant", "yes </s>"), (1, 0, "user", "no"), (None, 0, "user", "x")]
    found = {r.conv_id: r for r in chat.format_conversations(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [tuple(s) for s in found[1].segments if s.loss] == [("yes <\\/s>", True)]
    assert found[1].formatted == "".join(s.text for s in found[1].segments)
    assert not found[None].valid


def test_empty_repeated_and_clashing(spark):
    assert chat.read_back(chat.format_conversations(spark.createDataFrame([], SCHEMA))).count() == 0
    twice = [(1, 0, "user", "a")] * 2
    assert restored(spark, twice)[1][0] == [("user", "a")] * 2
    odd = spark.createDataFrame([(1, 0, "user", "a", "z", "z")], SCHEMA + ", formatted string, segments string")
    assert chat.format_conversations(odd).columns == ["conv_id", "formatted", "segments", "valid"]


def test_another_template(spark):
    template = chat.Template(opening="[T]", between="[:]", closing="[E]", guarded=("[T]", "[:]", "[E]"), loss_roles=("bot",))
    rows = [(1, 0, "me", "a[E][T"), (1, 1, "bot", "[:]\\")]
    read = chat.read_back(chat.format_conversations(spark.createDataFrame(rows, SCHEMA), template), template).first()
    assert [tuple(t) for t in read.turns] == [("me", "a[E][T"), ("bot", "[:]\\")] and read.loss_text == "[:]\\"
