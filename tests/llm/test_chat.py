import hashlib
import random

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from daybook.llm import chat, template
from daybook.llm.template import Const, Generation, Loop, Template, TemplateError, Write

TEXTS = ["", " ", "\\", "###", "####", "#" * 9, "\\### Assistant: </turn> ok", "</turn></turn>\n", "<</turn>", "a\\", "\\\\###", "### user\nhi</turn>\n### assistant\nx", "é　\U0001f600 ##", "</turn", "\n", "{{ turn.text }}{% generation %}"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="#\\</turn>\n xé"), st.text(alphabet="#\\</turn>\n xé")), max_size=5))
def test_any_text_comes_back(turns):
    text, spans = Template(chat.TEMPLATE, chat.CHAT_FILTERS).render(turns)
    assert chat.read_turns(text) == turns and spans == []


def test_learned_spans_are_what_assistants_say():
    turns = [("system", "### x"), ("assistant", "a\\b"), ("user", "</turn>"), ("assistant", ""), ("assistant", "###"), ("Assistant", "no")]
    text, spans = Template(chat.TEMPLATE, chat.CHAT_FILTERS).render(turns)
    assert [chat.unescape(text[a:b]) for a, b in spans] == ["a\\b", "###"] and chat.read_turns(text) == turns
    assert text.startswith("### system\n\\### x</turn>\n### assistant\na\\\\b</turn>\n")


def test_constants_are_folded():
    tree = Template("a{{ 'b' ~ 1 }}{% if 1 == 1 and not false %}c{% else %}{{ 'x' }}{% endif %}{% for turn in turns %}{% if 'a' in 'b' %}no{% elif true %}yes{{ '!' | upper }}{% endif %}{% generation %}{{ turn.text }}{% endgeneration %}{% endfor %}{# end #}z").tree
    assert tree[0] == Write(Const("ab1c")) and tree[2] == Write(Const("z"))
    assert isinstance(tree[1], Loop) and tree[1].body[0] == Write(Const("yes!")) and isinstance(tree[1].body[1], Generation) and len(tree) == 3


def test_branches_operators_and_places():
    source = "<{% for turn in turns %}{% if loop.first %}F{% elif loop.last and turn.role != 'x' %}L{% else %}{{ loop.index }}{% endif %}{{ (turn.role ~ '-' ~ turn.text) | trim | upper }}{% if 'q' in turn.text or not loop.last %},{% endif %}{% endfor %}>"
    assert Template(source).render([("a", " b"), ("c", "q"), ("x", "d"), ("y", "q")])[0] == "<FA- B,1C-Q,2X-D,LY-Q,>"
    whole, spans = Template("{% for turn in turns %}[{% generation %}{{ turn.text }}{% if loop.last %}.{% endif %}{% endgeneration %}]{% endfor %}").render([("a", "bc"), ("a", "d")])
    assert whole == "[bc][d.]" and [whole[a:b] for a, b in spans] == ["bc", "d."]


@pytest.mark.parametrize("source", [
    "no loop", "{% for turn in turns %}", "{% for t in turns %}{% endfor %}", "{% for turn in turns %}{% endfor %}{% for turn in turns %}{% endfor %}", "{{ turn.text }}{% for turn in turns %}{% endfor %}",
    "{% for turn in turns %}{{ turn.__class__ }}{% endfor %}", "{% for turn in turns %}{{ open('x') }}{% endfor %}", "{% for turn in turns %}{{ turn.text | exec }}{% endfor %}", "{% for turn in turns %}{{ turn.text. }}{% endfor %}",
    "{% for turn in turns %}{{ 1 + 1 }}{% endfor %}", "{% for turn in turns %}{% if %}{% endif %}{% endfor %}", "{% for turn in turns %}{% else %}{% endfor %}", "{% for turn in turns %}{% import os %}{% endfor %}", "{% for turn in turns %}{% if true %}{% endfor %}{% endif %}",
    "{% if true %}{% for turn in turns %}{% endfor %}{% endif %}", "{% endfor %}", "{% for turn in turns %}{{ 'a' 'b' }}{% endfor %}", "{% for turn in turns %}{{ (turn.text }}{% endfor %}", "{% for turn in turns %}{{ __import__ }}{% endfor %}", "{% for turn in turns %}{% if true %}a{% else %}b{% else %}c{% endif %}{% endfor %}",
])
def test_what_is_unknown_is_refused(source):
    with pytest.raises(TemplateError):
        Template(source)


def digest(rows):
    """By conversation: what op12 returns, from the rows themselves."""
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, []).append(((turn is not None, turn or 0), role or "", text or ""))
    got = {}
    for conv, turns in out.items():
        turns.sort(key=lambda t: t[:2])
        said = [(r, t) for _, r, t in turns]
        loss = "".join(t for r, t in said if r == "assistant")
        formatted, _ = Template(chat.TEMPLATE, chat.CHAT_FILTERS).render(said)
        got[conv] = (len(said), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in said).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(formatted))
    return got


def odd_rows():
    rng = random.Random(7)
    rows = [(k, t, rng.choice(["user", "assistant", "system", "a\nb", "### r", None]), rng.choice([*TEXTS, None])) for k in range(60) for t in range(rng.randint(1, 6))]
    rows += [(1000, t, "assistant" if t % 2 else "user", f"{t} " + rng.choice(TEXTS)) for t in range(900)]  # a third of all rows and more
    rows += [(None, None, "user", "x"), (None, 1, "assistant", "y"), (-7, 3, None, None), (2000, 0, "assistant", "w" * 50_000)]
    rows += [(3000, 0, "user", "same")] * 200  # repeated rows are turns of their own
    return rows


@pytest.mark.parametrize("partitions, piece_chars", [(1, 1 << 20), (23, 300)])
def test_odd_conversations(spark, partitions, piece_chars):
    rows = odd_rows()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5).withColumn("part", F.lit(1)).withColumn("conv", F.lit("x"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
        pieces = chat.written(chat.format_conversations(df, piece_chars=piece_chars), "pieces")
        got = {r["conv_id"]: tuple(r)[1:] for r in chat.read_back(pieces).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == digest(rows)
    if partitions > 1:
        many = pieces.filter("conv_id = 1000").orderBy("start").collect()
        assert len(many) > 5 and [p["start"] for p in many] == [sum(q["n_turns"] for q in many[:k]) for k in range(len(many))] and [p["last"] for p in many] == [False] * (len(many) - 1) + [True]
        whole, spans = Template(chat.TEMPLATE, chat.CHAT_FILTERS).render([(r, t) for c, _, r, t in rows if c == 1000])
        assert "".join(p["text"] for p in many) == whole
        shift, moved = 0, []
        for p in many:
            moved += [(s["begin"] + shift, s["end"] + shift) for s in p["spans"]]
            shift += len(p["text"])
        assert moved == spans


def test_no_rows_and_a_template_of_ones_own(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.format_conversations(df)).collect() == []
    with pytest.raises(TemplateError):
        chat.format_conversations(df, "{{ x }}")
    df = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "assistant", "b"), (2, 0, "user", "c")], "c long, t long, r string, m string")
    own = "BOS{% for turn in turns %}|{{ turn.role }}:{% generation %}{{ turn.text }}{% endgeneration %}{% if not loop.last %};{% endif %}{% endfor %}EOS"
    out: dict = {}
    for r in chat.format_conversations(df, own, "c", "t", "r", "m").orderBy("c", "start").collect():  # a range may end inside of a conversation
        text, spans = out.get(r["c"], ("", []))
        out[r["c"]] = (text + r["text"], spans + [(s["begin"] + len(text), s["end"] + len(text)) for s in r["spans"]])
    assert out == {1: ("BOS|user:a;|assistant:bEOS", [(9, 10), (22, 23)]), 2: ("BOS|user:cEOS", [(9, 10)])}


def test_query_has_the_fixed_conversation(spark, sf_dir):
    got = {r["conv_id"]: r for r in chat.op12_chat_format(spark, sf_dir).collect()}
    said = "\\### Assistant: </turn> ok"
    assert got[-7]["n_turns"] == 2 and got[-7]["loss_chars"] == len(said) and got[-7]["loss_sha256"] == hashlib.sha256(said.encode()).hexdigest()
    assert template.NAMES[0] == "turn.role"
