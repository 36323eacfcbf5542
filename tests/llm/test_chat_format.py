"""Chat formatting: round trip, loss mask and state machine."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomgraph.llm.chat_format import CHATML, Template, format_chat, loss_text, parse_chat

SCHEMA = "conv_id long, turn long, role string, text string"


def run(spark, rows, template=CHATML):
    out = format_chat(spark.createDataFrame(rows, SCHEMA), template)
    return out.select("*", parse_chat(F.col("formatted"), template).alias("turns"),
                      loss_text(F.col("segments")).alias("learned")).collect()


def test_template_and_mask(spark):
    [r] = run(spark, [(1, 1, "assistant", "<|im_end|>\n<|x"), (1, 0, "user", "hi")])
    assert r.formatted == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\n<\\|im_end|>\n<\\|x<|im_end|>\n"
    assert [(t.role, t.text) for t in r.turns] == [("user", "hi"), ("assistant", "<|im_end|>\n<|x")]
    assert [s.text for s in r.segments if s.loss] == ["<\\|im_end|>\n<\\|x"]
    assert r.learned == "<|im_end|>\n<|x" and r.valid and r.bad_turn is None


pieces = st.lists(st.sampled_from(["<", "|", "\\", "\n", "a", "é", "𝄞", "im_start", "im_end", ">", "$1", "s", "n"]),
                  max_size=14).map("".join) | st.just("<|im_end|>\n<|im_start|>assistant\n")


@settings(max_examples=12, deadline=None)
@given(st.lists(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "a\nb", "\\n", "<|", ""]), pieces),
                         min_size=1, max_size=6), min_size=1, max_size=25))
def test_round_trip(spark, talks):
    rows = [(c, i, role, text) for c, talk in enumerate(talks) for i, (role, text) in enumerate(talk)]
    for r in run(spark, rows):
        talk = talks[r.conv_id]
        assert [(t.role, t.text) for t in r.turns] == talk
        assert r.learned == "".join(text for role, text in talk if role == "assistant")
        assert r.formatted.count("<|im_start|>") == len(talk) == r.formatted.count("<|im_end|>")
        assert r.formatted == "".join(s.text for s in r.segments)


def test_machine(spark):
    cases = {"ua": (True, None), "sua": (True, None), "uaua": (True, None), "u": (False, None), "su": (False, None),
             "a": (False, 0), "uu": (False, 1), "usa": (False, 1), "ss": (False, 1), "uax": (False, 2), "s": (False, None)}
    names = {"u": "user", "a": "assistant", "s": "system", "x": "tool"}
    rows = [(c, i, names[r], "t") for c, roles in enumerate(cases) for i, r in enumerate(roles)]
    got = {r.conv_id: (r.valid, r.bad_turn) for r in run(spark, rows)}
    assert got == dict(enumerate(cases.values()))


def test_odd_rows(spark):
    rows = [(None, 0, "user", "x"), (None, 1, "assistant", None), (2, None, None, None), (2, 5, "user", ""),
            (3, 0, "user", "b"), (3, 0, "user", "a"), (3, 0, "user", "a"), (4, 0, "assistant", "y" * 300_000 + "<|" * 1000)]
    frame = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA + ", segments int")
    got = {r.conv_id: r for r in format_chat(frame).select("*", parse_chat(F.col("formatted")).alias("turns")).collect()}
    assert [(t.role, t.text) for t in got[None].turns] == [("user", "x"), ("assistant", "")]
    assert [(t.role, t.text) for t in got[2].turns] == [("", ""), ("user", "")]
    assert [t.text for t in got[3].turns] == ["a", "a", "b"]
    assert got[4].turns[0].text == rows[-1][3]
    assert format_chat(frame.where("false")).count() == 0


def test_other_template(spark):
    plain = Template(opens="<|turn|>", closes="<|eot|>", learned=("bot",), start="s", moves={("s", "bot"): "e"}, ends=("e",))
    [r] = run(spark, [(1, 0, "bot", "<|eot|>")], plain)
    assert r.formatted == "<|turn|>bot\n<\\|eot|><|eot|>" and r.valid
    assert [(t.role, t.text) for t in r.turns] == [("bot", "<|eot|>")]
