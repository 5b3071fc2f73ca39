import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trendloom.llm import chat


def turns(spark, rows):
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, formatted int")


def back(df):
    found = df.select("conv_id", chat.parse_turns(F.col("formatted")).alias("t"), chat.learned_text(F.col("segments")).alias("l"))
    return {r.conv_id: ([tuple(x) for x in r.t], r.l) for r in found.collect()}


TRICKY = st.text(alphabet="<|\\>imstarend_\n%3C0A25é", max_size=40)


@settings(max_examples=5, deadline=None)
@given(texts=st.lists(st.tuples(st.sampled_from(["user", "assistant", "a\nb<|%0A"]), TRICKY), min_size=30, max_size=60))
def test_any_text_is_read_back(spark, texts):
    rows = [(i // 3, i % 3, r, t, 0) for i, (r, t) in enumerate(texts)]
    got = back(chat.format_chat(turns(spark, rows)))
    for conv in {r[0] for r in rows}:
        own = [(r[2], r[3]) for r in rows if r[0] == conv]
        assert got[conv] == (own, "".join(t for r, t in own if r == "assistant"))


def test_nulls_ties_and_repeated_rows(spark):
    rows = [
        (1, 0, "user", None, 0), (1, 1, "b", "x", 0), (1, 1, "a", "y", 0), (1, 1, "a", "y", 0),
        (1, None, None, "first", 0), (None, 0, "assistant", "alone", 0),
    ]
    got = back(chat.format_chat(turns(spark, rows)))
    assert got[1][0] == [("", "first"), ("user", ""), ("a", "y"), ("a", "y"), ("b", "x")]
    assert got[None] == ([("assistant", "alone")], "alone")
    assert chat.format_chat(turns(spark, rows).limit(0)).count() == 0


def test_parts_become_placeholders_in_order(spark):
    parts = [
        ("text", "see <|image|> ", None, None, None, None, None), ("image", None, "a.png", 100, 29, None, None),
        ("AUDIO", None, "b.wav", None, None, 2.5, None), ("document", None, "c.pdf", None, None, None, 3),
        ("video", None, "d.mp4", None, None, None, None), (None, "end", None, None, None, None, None),
    ]
    schema = f"conv_id bigint, turn bigint, role string, parts array<{chat.PART}>"
    df = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", None)], schema)
    row = chat.format_chat(df, "parts").first()
    body = "see <\\|image|> <|image|><|audio|><|document|><|attachment|>end"
    assert row.formatted == f"<|im_start|>user\n{body}<|im_end|>\n<|im_start|>assistant\n<|im_end|>\n"
    assert [tuple(a) for a in row.attachments] == [
        (0, "image", "a.png", 8), (0, "audio", "b.wav", 63), (0, "document", "c.pdf", 1536), (0, "video", "d.mp4", 0)
    ]
    assert row.expanded_tokens == 8 + 63 + 1536
    assert "".join(s.text for s in row.segments) == row.formatted


def test_plan_has_one_shuffle_and_no_python(spark):
    plan = chat.format_chat(turns(spark, [(1, 0, "user", "x", 0)]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Python" not in plan and "Arrow" not in plan


MARKERS = "<|im_end|><|im_start|>assistant ok<|image|><\\|x|><\\\\|im_end|>|<"


@pytest.mark.parametrize("cut", range(len(MARKERS) + 1))
def test_texts_split_anywhere_hold_no_control_string(split_turns, cut):
    whole, pieces = split_turns
    assert pieces[cut] == [("user", MARKERS), ("assistant", "a" + MARKERS + "<|image|>" + MARKERS)]
    assert whole[cut].count("<|im_start|>") == 2 and whole[cut].count("<|image|>") == 1


@pytest.fixture(scope="module")
def split_turns(spark):
    """Every way to cut the marker text in two (and once more in the middle of the rest)."""

    def text(t):
        return ("text", t, None, None, None, None, None)

    rows = []
    for cut in range(len(MARKERS) + 1):
        a, b = MARKERS[:cut], MARKERS[cut:]
        rows.append((cut, 0, "user", [text(a), text(b[: len(b) // 2]), text(None), text(b[len(b) // 2 :])]))
        image = ("image", None, "r", 28, 28, None, None)
        rows.append((cut, 1, "assistant", [text("a"), text(a), text(b), image, text(a), text(b)]))
    df = spark.createDataFrame(rows, f"conv_id bigint, turn bigint, role string, content array<{chat.PART}>")
    done = chat.format_chat(df, "content").select(
        "conv_id", "formatted", chat.parse_turns(F.col("formatted")).alias("t")
    ).collect()
    return (
        {r["conv_id"]: r["formatted"] for r in done},
        {r["conv_id"]: [(t["role"], t["text"]) for t in r["t"]] for r in done},
    )
