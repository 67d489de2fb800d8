"""Chat formatting with typed content parts, in DataFrame functions only.

A turn's content is an ordered list of parts (text, image, audio, document). A visitor over the parts keeps
text, replaces every other part by a numbered placeholder, and records what it stands for and how many tokens it will become.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

START, END = "<|im_start|>", "<|im_end|>"
#: Tokens of an attachment whose own number isn't given.
EXPANDED = {"image": 576, "audio": 750, "document": 1024}
PARTS = "array<struct<kind: string, text: string, ref: string, tokens: bigint>>"


def escaped(text: Column) -> Column:
    """Text in which no control string can be read; ``unescaped`` gives the text back."""
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def escaped_after(text: Column) -> Column:
    """As :func:`escaped`, for text that follows other pieces: with a bar at its start it might complete a control string."""
    plain = escaped(text)
    return F.when(F.startswith(plain, F.lit("|")), F.concat(F.lit("&#124;"), F.substr(plain, F.lit(2)))).otherwise(plain)


def unescaped(text: Column) -> Column:
    bars = F.replace(F.replace(text, F.lit("&lt;|"), F.lit("<|")), F.lit("&#124;"), F.lit("|"))
    return F.replace(bars, F.lit("&amp;"), F.lit("&"))


def escaped_role(role: Column) -> Column:
    """A role ends at its line's end, so that line ends in it are escaped too."""
    return F.replace(escaped(role), F.lit("\n"), F.lit("&#10;"))


def unescaped_role(role: Column) -> Column:
    return unescaped(F.replace(role, F.lit("&#10;"), F.lit("\n")))


def text_parts(text: Column) -> Column:
    """The parts of a turn that is plain text; a null text is an empty one."""
    return F.array(
        F.struct(
            F.lit("text").alias("kind"),
            F.coalesce(text, F.lit("")).alias("text"),
            F.lit(None).cast("string").alias("ref"),
            F.lit(None).cast("bigint").alias("tokens"),
        )
    )


def _visited(part: Column, index: Column) -> Column:
    """One part as (piece, attachment): what it leaves in the text, and null or what stands behind its placeholder."""
    kind = F.coalesce(part["kind"], F.lit("text"))
    tokens = F.coalesce(part["tokens"], *[F.when(kind == k, F.lit(n)) for k, n in EXPANDED.items()], F.lit(0))
    text = F.coalesce(part["text"], F.lit(""))
    return F.struct(
        F.when(kind == "text", F.when(index == 0, escaped(text)).otherwise(escaped_after(text)))
        .otherwise(F.concat(F.lit("<|"), escaped_role(kind), F.lit(":"), index.cast("string"), F.lit("|>")))
        .alias("piece"),
        F.when(
            kind != "text",
            F.struct(index.cast("int").alias("part"), kind.alias("kind"), part["ref"].alias("ref"), tokens.alias("tokens")),
        ).alias("attachment"),
    )


def format_chats(turns: DataFrame) -> DataFrame:
    """One row per conversation of ``turns`` (conv_id, turn, role string, parts as in ``PARTS``).

    Returns conv_id, n_turns, ``formatted`` (``<|im_start|>role\\ncontent<|im_end|>\\n`` per turn, by turn), ``loss_spans``
    (start and length in code points of each assistant content in ``formatted``), ``attachments`` in order of their
    placeholders (turn's place, part, kind, ref, tokens), and ``expanded_tokens``, their sum.

    Control strings in texts and roles are escaped, so that the text can be divided into its turns again. Null roles
    and null or empty parts are empty; a null part kind is text; kinds that are not known become placeholders of no tokens.
    Null turns come first; equal turns are ordered by role and content; repeated rows stay. Null conv_ids are one conversation. No rows
    give no rows. Other columns are not read. Turns are formatted one by one; only their finished texts are gathered by conversation.
    """
    parts = F.coalesce(F.col("parts"), F.array().cast(PARTS))
    visited = F.transform(F.filter(parts, lambda p: p.isNotNull()), _visited)
    turns = turns.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.array_join(F.transform(visited, lambda v: v["piece"]), "").alias("content"),
        F.filter(F.transform(visited, lambda v: v["attachment"]), lambda a: a.isNotNull()).alias("attached"),
    )
    head = F.concat(F.lit(START), escaped_role(F.col("role")), F.lit("\n"))
    turns = turns.withColumns(
        {
            "line": F.concat(head, F.col("content"), F.lit(END + "\n")),
            "before": F.char_length(head).cast("long"),
            "inside": F.char_length("content").cast("long"),
        }
    )
    # Ties go by what turns say, not by how that is escaped.
    order = Window.partitionBy("conv_id").orderBy("turn", "role", unescaped(F.col("content")), "line")
    turns = turns.withColumns(
        {
            "place": F.row_number().over(order),
            "end": F.sum(F.char_length("line").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0)),
        }
    )
    span = F.when(
        F.col("role") == "assistant",
        F.struct((F.col("end") - F.char_length("line") + F.col("before")).alias("start"), F.col("inside").alias("length")),
    )
    rows = F.sort_array(
        F.collect_list(F.struct("place", "line", span.alias("span"), F.col("attached")))
    )
    attachments = F.flatten(
        F.transform(
            F.col("rows"),
            lambda r: F.transform(
                r["attached"],
                lambda a: F.struct(
                    r["place"].alias("turn_place"), a["part"].alias("part"), a["kind"].alias("kind"), a["ref"].alias("ref"), a["tokens"].alias("tokens")
                ),
            ),
        )
    )
    return (
        turns.groupBy("conv_id")
        .agg(rows.alias("rows"))
        .select(
            "conv_id",
            F.size("rows").cast("long").alias("n_turns"),
            F.array_join(F.transform("rows", lambda r: r["line"]), "").alias("formatted"),
            F.filter(F.transform("rows", lambda r: r["span"]), lambda s: s.isNotNull()).alias("loss_spans"),
            attachments.alias("attachments"),
        )
        .withColumn(
            "expanded_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda total, a: total + a["tokens"])
        )
    )


def read_turns(formatted: Column) -> Column:
    """The turns (role, content) of a formatted conversation; the content is unescaped and keeps its placeholders."""
    # Neither control string is left inside a turn, so that the text is divided just where turns begin.
    lines = F.slice(F.split(formatted, r"<\|im_start\|>"), 2, 1_000_000_000)
    close = len(END) + 1

    def turn(line: Column) -> Column:
        role = F.substring_index(line, "\n", 1)
        size = F.char_length(role)
        return F.struct(
            unescaped_role(role).alias("role"),
            unescaped(F.substring(line, size + 2, F.char_length(line) - size - 1 - close)).alias("content"),
        )

    return F.transform(lines, turn)


def content_pieces(content: Column) -> Column:
    """The pieces (kind, text) of a turn's escaped content, in order: placeholders by their kind, everything else as text.

    What was typed is escaped and never begins with ``<|``, so that text which looks like a placeholder is text here. ``turn_contents`` gives
    such contents.
    """
    pieces = F.filter(F.split(content, r"(?=<\|)|(?<=<\|[^|<]{1,200}\|>)"), lambda p: p != "")
    mark = r"^<\|([^|<]+):[0-9]+\|>$"

    def piece(p: Column) -> Column:
        kind = F.regexp_extract(p, mark, 1)
        return F.struct(
            F.when(kind != "", unescaped_role(kind)).otherwise(F.lit("text")).alias("kind"), unescaped(p).alias("text")
        )

    return F.transform(pieces, piece)


def turn_contents(formatted: Column) -> Column:
    """The contents of a formatted conversation's turns, still escaped."""
    lines = F.slice(F.split(formatted, r"<\|im_start\|>"), 2, 1_000_000_000)

    def content(line: Column) -> Column:
        size = F.char_length(F.substring_index(line, "\n", 1))
        return F.substring(line, size + 2, F.char_length(line) - size - 1 - (len(END) + 1))

    return F.transform(lines, content)


def masked_texts(formatted: Column, spans: Column) -> Column:
    """The unescaped texts under the loss mask, in order."""
    return F.transform(spans, lambda s: unescaped(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int"))))
