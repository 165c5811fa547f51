r"""Chat formatting: conversations of typed parts as one marked-up string each.

Template, one turn after the other, with nothing between::

    [INST] role\ntext [/INST]     every role but the assistant
    <s>text</s>                   the assistant; its text is under the loss mask

Parts that are not text become placeholders (``<|image|>``, ``<|audio|>``, ``<|document|>``) in their
place; what they refer to, and the tokens they expand to, go to a list in the same order. A control string
inside a text gets a backslash behind its first character, and one that has backslashes there gets
one more, so the texts can be read back exactly. Neighbouring text parts are one text, also where a control
string begins in one and ends in another. Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ASSISTANT = "assistant"
KINDS = ("image", "audio", "document")
_CONTROL = r"/?s>|/?INST\]|\|(?:" + "|".join(KINDS) + r")\|>"
#: Tokens that an attachment expands to: image patches, seconds of audio, pages.
PATCH, PER_SECOND, PER_PAGE = 28, 25, 576

PARTS = "array<struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*)({_CONTROL})", r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*)({_CONTROL})", r"$1$2$3")


def text_parts(text: Column) -> Column:
    """A text as a message of one part."""
    none = {"ref": "string", "width": "int", "height": "int", "seconds": "double", "pages": "int"}
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"), *(F.lit(None).cast(t).alias(n) for n, t in none.items()))).cast(PARTS)


def formatted(messages: DataFrame) -> DataFrame:
    """``conv_id``, ``formatted``, ``n_turns``, ``loss_spans``, ``attachments``, ``attachment_tokens`` per conversation.

    ``messages`` has ``conv_id``, ``turn``, ``role`` and ``parts`` (:data:`PARTS`). Turns are
    ordered by number, NULL first; equal numbers by role, then by the rendered text; repeated rows are repeated turns.
    A NULL role or text counts as empty, NULL or no parts as an empty message, and a part of an unknown kind as text.
    Each message without a conversation is one of its own, so that any number of them is shared by all tasks.
    ``loss_spans`` are start and length, in code points, of the escaped assistant texts. Other columns of ``messages`` are not
    read, whatever their names.

    One shuffle by conversation. A conversation is one output row, so it has to fit into a row, and a text of any length that does is formatted whole.
    """
    body = F.coalesce(_body(F.col("parts")), F.lit(""))
    others = F.filter("parts", lambda p: p["kind"].isin(*KINDS))
    turns = messages.select(
        "conv_id",
        F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id()).alias("alone"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        body.alias("body"),
        F.coalesce(F.transform(others, lambda p: _attachment(p, F.col("turn"))), F.array()).alias("attached"),
    )
    spoken = F.col("role") == ASSISTANT
    piece = F.when(spoken, F.concat(F.lit("<s>"), "body", F.lit("</s>"))).otherwise(
        F.concat(F.lit("[INST] "), _role_out(F.col("role")), F.lit("\n"), "body", F.lit(" [/INST]"))
    )
    order = Window.partitionBy("conv_id", "alone").orderBy("turn", "role", "body", F.to_json("attached"))
    placed = turns.withColumn("piece", piece).withColumns(
        {
            "place": F.row_number().over(order),
            "start": F.sum(F.length("piece")).over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.length("piece"),
        }
    )
    span = F.when(spoken, F.struct((F.col("start") + 3).alias("start"), F.length("body").cast("bigint").alias("length")))
    turn = F.struct("place", "piece", span.alias("span"), "attached")
    whole = placed.groupBy("conv_id", "alone").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    attachments = F.flatten("turns.attached")
    return whole.select(
        "conv_id",
        F.array_join("turns.piece", "").alias("formatted"),
        F.size("turns").cast("bigint").alias("n_turns"),
        F.filter("turns.span", lambda s: s.isNotNull()).alias("loss_spans"),
        attachments.alias("attachments"),
        F.aggregate(attachments, F.lit(0).cast("bigint"), lambda n, a: n + a["tokens"]).alias("attachment_tokens"),
    )


def read_back(text: Column) -> Column:
    """The turns of a formatted conversation: array of role and text, placeholders left in the text."""
    found = F.regexp_extract_all(text, F.lit(r"(?s)\[INST\] .*? \[/INST\]|<s>.*?</s>"), F.lit(0))
    role = lambda m: F.substring_index(F.substr(m, F.lit(8)), "\n", 1)
    return F.transform(
        found,
        lambda m: F.when(
            m.startswith("<s>"),
            F.struct(F.lit(ASSISTANT).alias("role"), unescaped(F.substr(m, F.lit(4), F.length(m) - 7)).alias("text")),
        ).otherwise(
            F.struct(
                _role_in(role(m)).alias("role"),
                unescaped(F.substr(m, F.length(role(m)) + 9, F.length(m) - F.length(role(m)) - 16)).alias("text"),
            )
        ),
    )


def under_mask(formatted: Column, loss_spans: Column) -> Column:
    """The texts of the spans, cut out of a formatted conversation and read back, one after the other."""
    cut = lambda s: F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int"))
    return F.array_join(F.transform(loss_spans, lambda s: unescaped(cut(s))), "")


def _body(parts: Column) -> Column:
    """The parts in order: each run of texts as one escaped text, and the placeholders between them."""
    texts = F.transform(parts, lambda p: F.when(p["kind"].isin(*KINDS), "").otherwise(F.coalesce(p["text"], F.lit(""))))
    places = F.filter(F.transform(parts, lambda p, i: F.when(p["kind"].isin(*KINDS), i)), lambda i: i.isNotNull())
    ends = F.concat(F.array(F.lit(-1)), places, F.array(F.size(parts)))
    run = lambda start, end: escaped(F.array_join(F.slice(texts, start + 2, end - start - 1), ""))
    shown = lambda end: F.coalesce(F.concat(F.lit("<|"), F.get(parts, end)["kind"], F.lit("|>")), F.lit(""))
    pairs = F.arrays_zip(F.slice(ends, 1, F.size(ends) - 1).alias("start"), F.slice(ends, 2, F.size(ends) - 1).alias("end"))
    return F.array_join(F.transform(pairs, lambda p: F.concat(run(p["start"], p["end"]), shown(p["end"]))), "")


def _attachment(part: Column, turn: Column) -> Column:
    tokens = (
        F.when(part["kind"] == "image", F.ceil(part["width"] / PATCH) * F.ceil(part["height"] / PATCH))
        .when(part["kind"] == "audio", F.ceil(part["seconds"] * PER_SECOND))
        .otherwise(part["pages"].cast("bigint") * PER_PAGE)
    )
    return F.struct(part["kind"].alias("kind"), part["ref"].alias("ref"), turn.alias("turn"), F.coalesce(tokens, F.lit(0)).cast("bigint").alias("tokens"))


def _role_out(role: Column) -> Column:
    """On one line: backslashes and line breaks are spelt out."""
    spelt = F.replace(F.replace(role, F.lit("\\"), F.lit("\\b")), F.lit("\n"), F.lit("\\n"))
    return escaped(spelt)


def _role_in(role: Column) -> Column:
    return F.replace(F.replace(unescaped(role), F.lit("\\n"), F.lit("\n")), F.lit("\\b"), F.lit("\\"))
