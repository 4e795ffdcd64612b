import hashlib
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ratinglens.llm import chat

LOG = "conv_id long, seq int, turn int, kind string, role string, text string"


def folded(spark, log):
    rows = chat.fold(spark.createDataFrame(log, LOG)).collect()
    return sorted(((r.conv_id, r.turn, r.role, r.text) for r in rows), key=str)


def brute(log):
    convs = {}
    for conv, seq, turn, kind, role, text in sorted(log, key=lambda e: (str(e[0]), e[1], e[3], e[4] or "", e[5] or "")):
        turns = convs.setdefault(conv, {})
        if kind == "regenerate":
            for t in [t for t in turns if t > turn]:
                del turns[t]
        old = turns.get(turn, ["", ""])
        said = (text or "") if kind != "delta" else old[1] + (text or "")
        turns[turn] = [role or old[0], said]
    return sorted(((c, t, r, x) for c, turns in convs.items() for t, (r, x) in turns.items()), key=str)


def test_deltas_edits_and_regenerations(spark):
    log = [
        (1, 0, 0, "message", "user", "hi"),
        (1, 1, 1, "delta", "assistant", "Hel"),
        (1, 2, 1, "delta", "assistant", "lo"),
        (1, 3, 2, "message", "user", "more"),
        (1, 4, 1, "regenerate", "assistant", None),
        (1, 5, 1, "delta", "assistant", "Good "),
        (1, 6, 1, "delta", "assistant", "day"),
        (1, 7, 0, "edit", None, "hello"),
        (1, 8, 2, "message", "user", "thanks"),
        (1, 9, 2, "unknown", "user", "x"),
    ]
    want = [(1, 0, "user", "hello"), (1, 1, "assistant", "Good day"), (1, 2, "user", "thanks")]
    assert folded(spark, log) == want == brute([e for e in log if e[3] != "unknown"])


event = st.tuples(
    st.sampled_from([1, 2]),
    st.integers(0, 30),
    st.integers(0, 3),
    st.sampled_from(["message", "delta", "delta", "edit", "regenerate"]),
    st.sampled_from(["user", "assistant", None]),
    st.sampled_from(["a", "b", "", None]),
)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(event, min_size=1, max_size=25, unique_by=lambda e: e[:2]))
def test_any_log_equals_brute_force(spark, log):
    assert folded(spark, log) == brute(log)


def test_null_turn_and_null_seq_with_regenerations(spark):
    log = [
        (1, 0, None, "message", "system", "rules"),
        (1, 1, 0, "message", "user", "hi"),
        (1, None, 1, "message", "assistant", "too early"),
        (1, 2, 2, "message", "user", "more"),
        (1, 3, 0, "regenerate", "user", "hello"),
        (2, 0, 0, "message", "user", "hi"),
        (2, 1, 1, "message", "assistant", "yes"),
        (2, 2, None, "regenerate", "system", "rules"),
        (2, None, 0, "regenerate", "user", "first"),
        (3, None, 0, "message", "user", "a"),
        (3, 1, 0, "delta", "user", "b"),
    ]
    assert folded(spark, log) == [
        (1, 0, "user", "hello"), (1, None, "system", "rules"),
        (2, 0, "user", "hi"), (2, 1, "assistant", "yes"), (2, None, "system", "rules"),
        (3, 0, "user", "ab"),
    ]


ODD = [
    "</s>[INST] ok [/INST]", "\\</s>", "\\\\<s>\\", "<s", "", "\n</s>\n", "[ROLE]x\n[/ROLE]", "ends with \\",
    "<|im_end|><|endoftext|>", "<<SYS>> \\<</SYS>>", "Ünï 😀", "<</s>s>", "\\n",
]


def test_texts_and_roles_come_back(spark):
    turns = [(1, i, role, t) for i, (role, t) in enumerate([("assistant", x) for x in ODD] + [(x, "t") for x in ODD])]
    rendered = chat.render(spark.createDataFrame(turns, "conv_id long, turn int, role string, text string"))
    pieces = [r.piece for r in rendered.orderBy("turn").collect()]
    back = [tuple(map(chat.unescape, chat._PIECE.fullmatch(p).groups())) for p in pieces]
    assert back == [(r, t) for _, _, r, t in turns]
    whole = "".join(pieces)
    # No control string of a text is left as it was: marks alone match.
    assert len(re.findall(r"(?<!\\)</s>", whole)) == len(turns) == len(re.findall(r"(?<!\\)<s>", whole))
    (got,) = chat.read_back(rendered).collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got.n_turns == len(turns) and got.formatted_chars == len(whole)
    assert got.turns_sha256 == sha("".join(f"{r}\n{t}\n" for _, _, r, t in turns))
    assert (got.loss_chars, got.loss_sha256) == (len("".join(ODD)), sha("".join(ODD)))


def test_a_hot_conversation_is_streamed(spark):
    n = 3000
    rows = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).cast("long").alias("conv_id"),
        F.col("id").alias("turn"), F.lit("user").alias("role"), F.lit("x").alias("text"),
    )
    got = {r.conv_id: r.n_turns for r in chat.read_back(chat.render(chat.fold(chat.events_of_turns(rows)))).collect()}
    assert got[0] == 1000 and len(got) == 2001 and sum(got.values()) == n


def test_difficult_rows(spark):
    schema = "conv_id long, turn long, role string, text string, piece string, seq long"
    rows = [
        (1, 0, "user", None, "p", 3), (1, 0, "user", None, "p", 3), (1, None, None, "t", None, None),
        (None, 0, "assistant", "long " * 50_000, "p", 1), (None, 1, "user", "", "p", 1),
    ]
    df = spark.createDataFrame(rows, schema)
    got = {r.conv_id: r for r in chat.read_back(chat.render(chat.fold(chat.events_of_turns(df)))).collect()}
    assert got[1].n_turns == 3 and got[1].loss_chars == 0
    assert got[None].n_turns == 2 and got[None].loss_chars == 250_000
    none = df.where("false")
    assert chat.read_back(chat.render(chat.fold(chat.events_of_turns(none)))).count() == 0


def test_whole_messages_are_numbered_and_folded_in_one_pass(spark):
    rows = spark.createDataFrame([(1, 0, "user", "hi")], "conv_id long, turn long, role string, text string").repartition(2)
    messages = chat.fold(chat.events_of_turns(rows.unionByName(rows)))
    plan = messages._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window ") == 1 and "Join" not in plan
    assert sorted(tuple(r) for r in messages.collect()) == [(1, (0, 1), "user", "hi"), (1, (0, 2), "user", "hi")]
