"""Chat formatting with typed content parts, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The control strings of the template. None of them occurs inside an escaped text.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<|image|>", "<|audio|>", "<|document|>")
MARK = "\u241b"  # written MARK 0 in texts; MARK 1 breaks a control string after its first character
PATCH, AUDIO_TOKENS_S, PAGE_TOKENS = 14, 25, 1024  # pixels to a side of an image token; tokens a second; tokens a page

PART = "struct<type:string,text:string,uri:string,width:int,height:int,seconds:double,pages:int>"


def escape(text: Column) -> Column:
    """Text without control strings; reversed by unescape()."""
    out = F.replace(text, F.lit(MARK), F.lit(MARK + "0"))
    for c in CONTROLS:
        out = F.replace(out, F.lit(c), F.lit(f"{c[0]}{MARK}1{c[1:]}"))
    return out


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit(MARK + "1"), F.lit("")), F.lit(MARK + "0"), F.lit(MARK))


def as_parts(text: Column) -> Column:
    """A text as the array of typed parts that it is: one text part."""
    kinds = dict(x.split(":") for x in PART[len("struct<") : -1].split(","))
    own = {"type": F.lit("text"), "text": F.coalesce(text.cast("string"), F.lit(""))}
    return F.array(F.struct(*[own.get(n, F.lit(None).cast(t)).alias(n) for n, t in kinds.items()]))


def expanded_tokens(part: Column) -> Column:
    """Tokens that an attachment takes in the model's input: 14-pixel patches, seconds of audio, pages; unknown sizes count as one unit."""
    side = lambda n: F.ceil(F.coalesce(part[n], F.lit(PATCH)) / PATCH)
    return (
        F.when(part["type"] == "image", side("width") * side("height"))
        .when(part["type"] == "audio", F.ceil(F.coalesce(part["seconds"], F.lit(1.0)) * AUDIO_TOKENS_S))
        .when(part["type"] == "document", F.coalesce(part["pages"], F.lit(1)) * PAGE_TOKENS)
        .otherwise(0)
        .cast("long")
    )


def _visit(part: Column) -> Column:
    """What a part becomes in the text: its escaped text, or its placeholder. A null part or one of another type is empty."""
    kind = part["type"]
    return F.when(kind.isin("image", "audio", "document"), F.concat(F.lit("<|"), kind, F.lit("|>"))).when(
        kind == "text", escape(F.coalesce(part["text"], F.lit("")))
    ).otherwise("")


def _attachment(part: Column, turn: Column) -> Column:
    return F.struct(
        turn.alias("turn"), part["type"].alias("type"), part["uri"].alias("uri"), expanded_tokens(part).alias("tokens")
    )


def format_conversations(turns: DataFrame, content: str = "text") -> DataFrame:
    """One formatted string a conversation from rows (conv_id, turn, role, content).

    content is a string, which counts as one text part, or an array of typed parts (PART). A visitor flattens the
    parts in order into text and one placeholder each; attachments holds their turn, type, uri and expanded token
    count in that order. Assistant turns read <s>text</s>, all others [INST]role, newline, text[/INST]; control
    strings inside texts and roles are escaped reversibly. loss_spans are the start (code points from 0) and length
    of each assistant text, from a running sum over the turns.

    Rows go by turn, nulls first; equal turns by role, then content. Null text or role counts as empty, rows of a null conv_id
    are one conversation. An empty table gives no rows. Other columns of turns are ignored. A conversation becomes
    one row, so its turns meet in one task; they are the only rows that do.
    Returns conv_id, formatted, loss_spans, attachments, n_turns, expanded_tokens.
    """
    parts = F.col(content)
    if not isinstance(turns.schema[content].dataType, T.ArrayType):
        parts = as_parts(parts)
    parts = F.coalesce(parts.cast(f"array<{PART}>"), F.array().cast(f"array<{PART}>"))
    kept = F.filter(parts, lambda p: p["type"].isin("image", "audio", "document"))
    role = F.coalesce(F.col("role"), F.lit(""))
    flat = turns.select(
        "conv_id",
        F.col("turn").cast("long").alias("_turn"),
        role.alias("_role"),
        F.array_join(F.transform(parts, _visit), "").alias("_body"),
        F.transform(kept, lambda p: _attachment(p, F.col("turn").cast("long"))).alias("_attached"),
    )
    head = F.replace(escape(F.col("_role")), F.lit("\n"), F.lit(MARK + "2"))
    ours = F.col("_role") == "assistant"
    out = F.when(ours, F.concat(F.lit("<s>"), F.col("_body"), F.lit("</s>"))).otherwise(
        F.concat(F.lit("[INST]"), head, F.lit("\n"), F.col("_body"), F.lit("[/INST]"))
    )
    lines = flat.select("conv_id", "_turn", "_role", "_body", "_attached", out.alias("_out"), ours.alias("_ours"))
    order = Window.partitionBy("conv_id").orderBy("_turn", "_role", "_body", "_attached")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    placed = lines.select(
        "conv_id",
        F.row_number().over(order).alias("nth"),
        F.coalesce(F.sum(F.length("_out").cast("long")).over(earlier), F.lit(0)).alias("at"),
        F.length("_body").cast("long").alias("chars"),
        "_out",
        "_ours",
        "_attached",
    )
    row = F.struct("nth", "_out", "_ours", "at", "chars", "_attached")
    grouped = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("rows"))
    spans = F.transform(
        F.filter("rows", lambda r: r["_ours"]), lambda r: F.struct((r["at"] + 3).alias("start"), r["chars"].alias("length"))
    )
    return grouped.select(
        "conv_id",
        F.array_join(F.transform("rows", lambda r: r["_out"]), "").alias("formatted"),
        spans.alias("loss_spans"),
        F.flatten(F.transform("rows", lambda r: r["_attached"])).alias("attachments"),
        F.size("rows").cast("long").alias("n_turns"),
    ).withColumn(
        "expanded_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda acc, a: acc + F.coalesce(a["tokens"], F.lit(0)))
    )


def parsed_turns(formatted: Column) -> Column:
    """The turns of a formatted string as array<struct<role,text>>, read from its marks alone."""
    pieces = F.filter(F.split(formatted, "(?<=\\[/INST\\])|(?<=</s>)"), lambda p: p != "")
    back = lambda head: unescape(F.replace(head, F.lit(MARK + "2"), F.lit("\n")))

    def turn(p: Column) -> Column:
        inner = F.substring(p, F.lit(7), F.length(p) - 13)
        role = F.substring_index(inner, "\n", 1)
        text = F.substring(inner, F.length(role) + 2, F.length(inner))
        return F.when(
            p.startswith("<s>"),
            F.struct(F.lit("assistant").alias("role"), unescape(F.substring(p, F.lit(4), F.length(p) - 7)).alias("text")),
        ).otherwise(F.struct(back(role).alias("role"), unescape(text).alias("text")))

    return F.transform(pieces, turn)


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped. Four bytes a code point, so that each span is cut at its place without counting from the start."""
    wide = F.array(F.struct(F.encode(formatted, "UTF-32").alias("bytes"), spans.alias("spans")))
    cut = lambda x, s: F.decode(F.substring(x["bytes"], (4 * s["start"] + 1).cast("int"), (4 * s["length"]).cast("int")), "UTF-32")
    pieces = F.transform(wide, lambda x: F.transform(x["spans"], lambda s: unescape(cut(x, s))))
    return F.array_join(F.get(pieces, F.lit(0)), "")


def formatted_digest(turns: DataFrame) -> DataFrame:
    """Formats conversations and returns, from the output alone, each one's turns and loss text as lengths and digests, with its attachments' counts."""
    out = format_conversations(turns)
    lines = F.transform(parsed_turns(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    read = out.select("conv_id", "formatted", lines.alias("lines"), loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"), "attachments", "expanded_tokens")
    return read.select(
        "conv_id",
        F.size("lines").cast("long").alias("n_turns"),
        F.sha2(F.array_join("lines", ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        F.size("attachments").cast("long").alias("n_attachments"),
        "expanded_tokens",
    )
