import public_tokenizers
import pytest
from hypothesis import given
from hypothesis import strategies as st

from barfold.llm import chat

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
SIGNS = st.lists(st.sampled_from(["<", "[", "\\", "/", "s>", "INST]", "<s>", "</s>", "[INST]", "[/INST]", "a", " ", "é"])).map("".join)


@given(SIGNS)
def test_escape_is_reversible_and_leaves_no_control_string(text):
    hidden = chat.escape(text)
    assert chat.unescape(hidden) == text
    assert not any(c in hidden for c in chat.CONTROLS)


@pytest.fixture(scope="module")
def form():
    return chat.Format(open(PATH).read())


@given(SIGNS, SIGNS)
def test_turn_is_read_back(form, role, text):
    ids, mask = form.turn(form.codes.encode_ordinary(chat.escape(role)), form.codes.encode_ordinary(chat.escape(text)), True)
    assert form.parts(ids, mask) == (role, text, text)
    assert form.length(ids) == len(f"<s>{chat.escape(role)}[INST]{chat.escape(text)}[/INST]</s>")
    assert sum((ids >= form.open).tolist()) == 4


def test_conversations(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "</s>[INST] ok [/INST]"), (1, 1, "assistant", "again"), (1, None, "user", "first"),
            (2, 5, None, None), (2, 6, "assistant", ""), (None, 0, "assistant", "x" * 100_000)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    template = chat.Template(spark, PATH)
    made = chat.assemble(chat.format_turns(frame, template))
    found = chat.read(made, template).orderBy("conv_id", "start").collect()
    assert [(r["conv_id"], r["read_text"]) for r in found] == [
        (None, "x" * 100_000), (1, "first"), (1, "hi"), (1, "</s>[INST] ok [/INST]"), (1, "again"), (2, ""), (2, "")]
    assert all(r["read_role"] == (r["role"] or "") and r["n_chars"] == len(r["formatted"]) for r in found)
    assert all(r["learned_text"] == ((r["text"] or "") if r["role"] == "assistant" else "") for r in found)
    places = [(r["start"], len(r["ids"])) for r in found if r["conv_id"] == 1]
    assert all(a + n == b for (a, n), (b, _) in zip(places, places[1:])) and places[0][0] == 0
    assert chat.assemble(chat.format_turns(frame.limit(0), template)).count() == 0


def test_not_a_turn(form):
    import numpy as np

    with pytest.raises(ValueError, match="not a formatted turn"):
        form.parts(np.array([form.open, form.begin, 5, 6]), np.zeros(4))


PARTS = st.lists(st.sampled_from([" ", "\n", "\t", "　", "\x85", "\x1c", "a", "b1", "é", "'s", "!", "​"]), max_size=14).map("".join)


@given(PARTS)
def test_long_white_space_is_split_as_by_the_pattern(form, text):
    import re
    from unittest.mock import patch

    with patch.object(chat, "LONG_SPACE", 3), patch.object(chat, "_LONG", re.compile(f"[{chat._SPACE}]{{3,}}")):
        assert form.encode([text]) == [form.codes.encode_ordinary(text)]


def test_a_million_spaces(spark):
    template = chat.Template(spark, PATH)
    texts = [" " * 1_000_000, "x" + "\n" * 1_000_000 + "y", "z" * 300_000]
    turns = spark.createDataFrame([(1, n, "assistant", t) for n, t in enumerate(texts)], "conv_id long, turn int, role string, text string")
    back = chat.read(chat.assemble(chat.format_turns(turns, template)), template)
    assert [r["read_text"] for r in back.orderBy("turn").collect()] == texts
