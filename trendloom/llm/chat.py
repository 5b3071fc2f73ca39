"""Chat formatting with typed content parts, in built-in Spark expressions only.

A turn is a list of typed parts. The visitor ``visit`` maps every part, by its kind, to
its place in the formatted text: text stays, everything else becomes one placeholder, an
attachment reference and a token count. Neighbouring texts are joined and then escaped, so
that no control string can arise where two of them meet. Conversations are assembled
with one shuffle on their id; a conversation is one output row, so it must fit in a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Markers of the template.
START, END = "<|im_start|>", "<|im_end|>"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
OTHER = "<|attachment|>"
#: Tokens that stand for an attachment: image patches, audio frames, document pages.
PATCH, FRAMES_PER_SECOND, TOKENS_PER_PAGE = 28, 25, 512

PART = (
    "struct<kind:string,text:string,ref:string,width:bigint,height:bigint,"
    "seconds:double,pages:bigint>"
)


def escape(text: Column) -> Column:
    """No ``<|`` is left: each ``<``, any backslashes, ``|`` gets one backslash more."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    """A role is one line without ``<``: percent, line feed and ``<`` are percent-encoded."""
    out = F.replace(role, F.lit("%"), F.lit("%25"))
    out = F.replace(out, F.lit("\n"), F.lit("%0A"))
    return F.replace(out, F.lit("<"), F.lit("%3C"))


def unescape_role(role: Column) -> Column:
    out = F.replace(role, F.lit("%3C"), F.lit("<"))
    out = F.replace(out, F.lit("%0A"), F.lit("\n"))
    return F.replace(out, F.lit("%25"), F.lit("%"))


def text_part(text: Column) -> Column:
    """A turn's plain text as its only part; null counts as empty."""
    fields = ("ref", "width", "height", "seconds", "pages")
    return F.array(
        F.struct(
            F.lit("text").alias("kind"),
            F.coalesce(text, F.lit("")).alias("text"),
            *[F.lit(None).alias(f) for f in fields],
        ).cast(PART)
    )


def visit(part: Column) -> Column:
    """One part: its text as it is or its placeholder, its reference, its token count.

    A part without a kind is text. Unknown kinds get a general placeholder and no tokens;
    missing measures count as zero.
    """
    kind = F.lower(F.coalesce(part["kind"], F.lit("text")))
    zero = F.lit(0).cast("bigint")
    size = lambda name: F.coalesce(part[name], F.lit(0))
    piece = F.when(kind == "text", F.coalesce(part["text"], F.lit("")))
    for name, mark in PLACEHOLDERS.items():
        piece = piece.when(kind == name, F.lit(mark))
    tokens = (
        F.when(kind == "image", F.ceil(size("width") / PATCH) * F.ceil(size("height") / PATCH))
        .when(kind == "audio", F.ceil(size("seconds") * FRAMES_PER_SECOND))
        .when(kind == "document", size("pages") * TOKENS_PER_PAGE)
        .otherwise(zero)
        .cast("bigint")
    )
    return F.struct(
        kind.alias("kind"),
        piece.otherwise(F.lit(OTHER)).alias("piece"),
        part["ref"].alias("ref"),
        tokens.alias("tokens"),
    )


def body(seen: Column) -> Column:
    """The formatted text of visited parts: runs of texts escaped, placeholders between."""
    start = F.struct(F.lit("").alias("done"), F.lit("").alias("run"))

    def add(made: Column, part: Column) -> Column:
        longer = F.struct(made["done"].alias("done"), F.concat(made["run"], part["piece"]).alias("run"))
        closed = F.concat(made["done"], escape(made["run"]), part["piece"])
        return F.when(part["kind"] == "text", longer).otherwise(
            F.struct(closed.alias("done"), F.lit("").alias("run"))
        )

    return F.aggregate(seen, start, add, lambda made: F.concat(made["done"], escape(made["run"])))


def format_chat(
    turns: DataFrame,
    parts: str | None = None,
    *,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    learn: tuple[str, ...] = ("assistant",),
) -> DataFrame:
    """One row per conversation: its formatted text, loss mask and attachments.

    ``parts`` names an array column of ``PART``; without it ``text`` is the only part.
    Columns: the conversation id, ``formatted``, ``segments`` (the formatted text cut
    into pieces with and without loss, in order), ``attachments`` (turn position, kind,
    reference, tokens, in the order of their placeholders) and ``expanded_tokens``.

    Null roles and texts are empty, null ids are one conversation. Turns are ordered by
    turn (nulls first), then role and text, so ties and repeated rows have one order.
    Other columns are dropped; an empty table gives no rows.
    """
    content = F.col(parts) if parts else text_part(F.col(text))
    who = F.coalesce(F.col(role), F.lit(""))
    visited = turns.select(
        F.col(conv).alias("_conv"),
        F.col(turn).alias("_turn"),
        who.alias("_role"),
        F.transform(F.coalesce(content, F.array().cast(f"array<{PART}>")), visit).alias("_seen"),
    ).select(
        "_conv",
        F.struct(
            "_turn",
            F.concat(F.lit(START), escape_role(F.col("_role")), F.lit("\n")).alias("head"),
            body(F.col("_seen")).alias("body"),
            F.col("_role").isin(*learn).alias("learn"),
            F.filter("_seen", lambda p: p["kind"] != "text").alias("held"),
        ).alias("_t"),
    )
    whole = visited.groupBy("_conv").agg(F.array_sort(F.collect_list("_t")).alias("_ts"))
    tail = F.lit(END + "\n")
    segments = F.flatten(
        F.transform(
            "_ts",
            lambda t: F.array(
                F.struct(t["head"].alias("text"), F.lit(False).alias("loss")),
                F.struct(t["body"].alias("text"), t["learn"].alias("loss")),
                F.struct(tail.alias("text"), F.lit(False).alias("loss")),
            ),
        )
    )
    held = F.flatten(
        F.transform(
            "_ts",
            lambda t, i: F.transform(
                t["held"],
                lambda p: F.struct(
                    i.cast("bigint").alias("turn_index"), p["kind"].alias("kind"),
                    p["ref"].alias("ref"), p["tokens"].alias("tokens"),
                ),
            ),
        )
    )
    return (
        whole.select(
            F.col("_conv").alias(conv), segments.alias("segments"), held.alias("attachments")
        )
        .withColumn("formatted", F.array_join("segments.text", ""))
        .withColumn(
            "expanded_tokens",
            F.aggregate("attachments.tokens", F.lit(0).cast("bigint"), lambda a, b: a + b),
        )
    )


def parse_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: an array of (role, text), both unescaped."""
    pieces = F.slice(
        F.split(formatted, r"<\|im_start\|>"), 2, F.greatest(F.size(F.split(formatted, r"<\|im_start\|>")) - 1, F.lit(0))
    )

    def turn(piece: Column) -> Column:
        cut = F.instr(piece, "\n")
        text = F.substring(piece, cut + 1, F.length(piece) - cut - len(END) - 1)
        return F.struct(
            unescape_role(F.substring(piece, F.lit(1), cut - 1)).alias("role"),
            unescape(text).alias("text"),
        )

    return F.transform(pieces, turn)


def learned_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped and joined."""
    under = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(under, lambda s: unescape(s["text"])), "")
