"""Chat formatting with typed content parts, in DataFrame functions only.

A turn holds a role and parts: text, image, audio or document. A visitor flattens the parts in
order: texts are escaped, the others leave a placeholder, a reference and a count of the tokens
that the placeholder expands to. Turns of a conversation are marked and joined; the loss mask
covers the text parts of assistant turns, as spans of code points of the formatted string.

Escaping is reversible: a backslash doubles, then "<|" becomes "<\\|" and, in roles, a line feed
becomes "<\\+". A "<" that ends a part becomes "<\\~" if another part follows, so that no mark comes
about where parts meet. Backslashes of the first step come in pairs, so a single one after "<" is
always one that the second step put there. No turn's escaped text holds "<|": marks can't be forged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
#: Kinds of attachments: placeholder, and tokens for each unit (a tile, a second, a page).
ATTACHMENTS = {"image": ("<|image|>", 256), "audio": ("<|audio|>", 25), "document": ("<|document|>", 512)}
PART = "array<struct<kind:string,text:string,ref:string,units:bigint>>"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    plain = F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("<\\~"), F.lit("<"))
    return F.replace(plain, F.lit("\\\\"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("<\\+"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("<\\+"), F.lit("\n")))


def text_parts(text: Column) -> Column:
    """A text as the only part of a turn; null: empty."""
    return F.array(
        F.struct(F.lit("text").alias("kind"), F.coalesce(text, F.lit("")).alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("bigint").alias("units"))
    ).cast(PART)


def _visit(part: Column, followed: Column) -> Column:
    """What a part leaves in the string. A kind that is null or unknown counts as text."""
    out = escape(F.coalesce(part["text"], F.lit("")))
    out = F.when(followed & F.endswith(out, F.lit("<")), F.concat(out, F.lit("\\~"))).otherwise(out)
    for kind, (mark, _) in ATTACHMENTS.items():
        out = F.when(part["kind"] == kind, F.lit(mark)).otherwise(out)
    return out


def _tokens(part: Column) -> Column:
    out = F.lit(0).cast("bigint")
    for kind, (_, each) in ATTACHMENTS.items():
        out = F.when(part["kind"] == kind, F.coalesce(part["units"], F.lit(1)) * each).otherwise(out)
    return out


def _attached(part: Column) -> Column:
    return F.coalesce(part["kind"].isin(*ATTACHMENTS), F.lit(False))


def format_chats(turns: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One row for each conversation of turns(conv_id, turn, role, parts, ...).

    formatted; n_turns; loss_spans: (start, length) in code points from 0, of each text part under
    the loss mask; attachments: (kind, ref, place of its placeholder, tokens), in order;
    attachment_tokens: their sum. Turns go by turn (null first), then role, then content, so equal
    turn numbers have a fixed order and repeated rows both stay. Null roles and parts are empty.
    A null conv_id is a conversation of its own. Other columns are ignored; an empty table gives an
    empty table. The string of a conversation is built whole in one row, whatever its length.
    """
    empty = F.array().cast(PART)
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("parts", empty).alias("parts"))
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    rows = rows.withColumn("head", head).withColumn("bodies", F.transform("parts", lambda p, i: _visit(p, i < F.size("parts") - 1)))
    rows = rows.withColumn("body", F.concat(F.col("head"), F.array_join("bodies", ""), F.lit(END + "\n")))
    # The same order everywhere: the window sorts by content, the collected list by the place it gives.
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "body", F.to_json("parts"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("start", F.coalesce(F.sum(F.char_length("body").cast("bigint")).over(before), F.lit(0).cast("bigint")))
    here = F.col("start") + F.char_length("head")
    # Parts of a turn are few: each one's place is the sum of the lengths before it.
    spans = F.transform(
        "parts",
        lambda p, i: F.struct(
            (here + F.aggregate(F.slice("bodies", F.lit(1), i), F.lit(0).cast("bigint"), lambda n, b: n + F.char_length(b))).alias("start"),
            F.char_length(F.get("bodies", i)).cast("bigint").alias("length"),
            p["kind"].alias("kind"),
            p["ref"].alias("ref"),
            _attached(p).alias("attached"),
            _tokens(p).alias("tokens"),
        ),
    )
    rows = rows.select("conv_id", "start", "role", "body", spans.alias("spans"))
    chats = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("start", "body", "role", "spans"))).alias("t"))
    masked = F.flatten(
        F.transform(
            F.filter("t", lambda t: t["role"] == loss_role),
            lambda t: F.filter(t["spans"], lambda s: ~s["attached"]),
        )
    )
    attached = F.filter(F.flatten(F.transform("t", lambda t: t["spans"])), lambda s: s["attached"])
    return chats.select(
        "conv_id",
        F.array_join(F.transform("t", lambda t: t["body"]), "").alias("formatted"),
        F.size("t").cast("bigint").alias("n_turns"),
        F.transform(masked, lambda s: F.struct(s["start"], s["length"])).alias("loss_spans"),
        F.transform(attached, lambda s: F.struct(s["kind"], s["ref"], s["start"].alias("place"), s["tokens"])).alias("attachments"),
        F.aggregate(attached, F.lit(0).cast("bigint"), lambda n, s: n + s["tokens"]).alias("attachment_tokens"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted string, unescaped: array of (role, text); placeholders stay in the text."""
    cut = F.split(formatted, r"\Q" + END + r"\E\n")
    blocks = F.slice(cut, F.lit(1), F.greatest(F.size(cut) - 1, F.lit(0)))
    plain = F.transform(blocks, lambda b: F.substring(b, F.lit(len(START) + 1), F.char_length(b)))
    return F.transform(
        plain,
        lambda b: F.struct(
            unescape_role(F.substring_index(b, "\n", 1)).alias("role"),
            unescape(F.substring(b, F.char_length(F.substring_index(b, "\n", 1)) + 2, F.char_length(b))).alias("text"),
        ),
    )


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(
        F.transform(spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), ""
    )
