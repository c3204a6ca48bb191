"""Chat transcripts of typed content parts as one marked-up text per conversation; built-in functions only.

A turn reads ``<|turn|>role<|text|>content<|end|>``. In roles and texts a backslash is doubled and ``<|`` becomes
``<\\|``, so no text holds a control string and the escapes can be taken back. Parts that are not text become a
placeholder such as ``<|image|>``; the k-th placeholder of a conversation belongs to its k-th attachment.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: Turns that are joined to one string before a conversation's strings meet.
CHUNK = 64
PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
#: Part types with a placeholder of their own.
ATTACHED = ("image", "audio", "document")


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def text_parts(text: Column) -> Column:
    """A plain text as the only content part; null counts as empty."""
    empty = {n: F.lit(None).cast(t) for n, t in (("ref", "string"), ("width", "int"), ("height", "int"),
                                                 ("seconds", "double"), ("pages", "int"))}
    return F.array(F.struct(F.lit("text").alias("type"), F.coalesce(text, F.lit("")).alias("text"),
                            *(c.alias(n) for n, c in empty.items()))).cast(f"array<{PART}>")


def _placeholder(p: Column) -> Column:
    return F.when(p["type"].isin(*ATTACHED), p["type"]).otherwise("other")


def _tokens(p: Column) -> Column:
    """Tokens that a placeholder stands for: 28 x 28 patches, 25 a second, 256 a page; at least one of each."""
    def least_one(c: Column) -> Column:
        return F.greatest(F.lit(1), F.ceil(F.coalesce(c, F.lit(0)))).cast("long")

    return (F.when(p["type"] == "image", least_one(p["width"] / 28.0) * least_one(p["height"] / 28.0))
            .when(p["type"] == "audio", least_one(p["seconds"] * 25))
            .when(p["type"] == "document", least_one(p["pages"]) * 256).otherwise(F.lit(0).cast("long")))


def _flattened(parts: Column) -> tuple[Column, Column]:
    """The content of a turn and its attachments, both in the order of its parts.

    Neighbouring text parts are escaped as the one text that they make: ``<`` at the end of one and ``|`` at the start of
    the next get the same backslash between them as within a text.
    """
    kept = F.filter(parts, lambda p: ~(p["type"].eqNullSafe("text") & (F.coalesce(p["text"], F.lit("")) == "")))

    def content(p: Column, before: Column) -> Column:
        split = before["type"].eqNullSafe("text") & before["text"].endswith("<") & p["text"].startswith("|")
        return F.when(p["type"] == "text", F.concat(F.when(split, F.lit("\\")).otherwise(F.lit("")), escape(p["text"]))
                      ).otherwise(F.concat(F.lit("<|"), _placeholder(p), F.lit("|>")))

    # Each part with the one before it; the last pair has no part of its own.
    pairs = F.zip_with(kept, F.concat(F.array(F.lit(None).cast(PART)), kept), content)
    others = F.filter(parts, lambda p: ~p["type"].eqNullSafe("text"))
    return F.array_join(F.slice(pairs, F.lit(1), F.size(kept)), ""), F.transform(others, lambda p: F.struct(
        _placeholder(p).alias("type"), p["ref"].alias("ref"), _tokens(p).alias("tokens")))


def format_chat(turns: DataFrame, parts: str | None = None, trained_role: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, n_turns, formatted, loss_spans, attachments, placeholder_tokens.

    ``turns`` has conv_id, turn, role and either text or the column ``parts``, an array of typed parts (see PART).
    ``loss_spans`` are start and stop, in code points of ``formatted``, of the contents of ``trained_role``;
    ``attachments`` are type, ref and tokens in order, a part of an unknown or null type counting as "other" with
    no tokens. Rows go by turn, then role, then content; nulls first, repeated rows all kept. A null text is empty, a
    null role an empty role, a null conv_id a conversation of its own; null and empty parts arrays are an empty content. Other
    columns are not read. Texts of any length are kept whole, within what a string may hold; an empty table gives no rows.

    Turns are joined in chunks of their numbers first, so a long conversation is put together from a few strings.
    """
    content, attachments = _flattened(F.col(f"`{parts}`") if parts else text_parts(F.col("text").cast("string")))
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    head = F.concat(F.lit(TURN), escape(F.col("role")), F.lit(TEXT))
    row = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"),
                       F.coalesce(content, F.lit("")).alias("body"), attachments.alias("attachments"))
    row = row.select("conv_id", F.floor(F.col("turn") / CHUNK).alias("chunk"), F.struct(
        "turn", "role", "body", head.alias("head"), "attachments").alias("r"))
    chunks = (row.groupBy("conv_id", "chunk").agg(F.sort_array(F.collect_list("r")).alias("pieces"))
              .select("conv_id", F.struct(
                  "chunk", F.size("pieces").alias("n"),
                  F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit(END))), "")
                  .alias("text"), _spans(trained_role).alias("spans"),
                  F.flatten(F.filter("pieces.attachments", lambda x: x.isNotNull())).alias("attachments")).alias("c")))
    whole = chunks.groupBy("conv_id").agg(F.sort_array(F.collect_list("c")).alias("c"))
    moved = F.expr("""aggregate(c, named_struct('pos', 0, 'out', cast(array() as array<array<struct<start:int,stop:int>>>)),
        (a, x) -> named_struct('pos', a.pos + length(x.text), 'out', array_append(a.out,
            transform(x.spans, s -> named_struct('start', s.start + a.pos, 'stop', s.stop + a.pos)))),
        a -> flatten(a.out))""")
    return whole.select(
        "conv_id", F.expr("aggregate(c.n, 0L, (a, n) -> a + n)").alias("n_turns"),
        F.array_join("c.text", "").alias("formatted"), moved.alias("loss_spans"),
        F.flatten("c.attachments").alias("attachments"),
        F.expr("aggregate(flatten(c.attachments).tokens, 0L, (a, n) -> a + n)").alias("placeholder_tokens"))


def _spans(trained_role: str) -> Column:
    return F.expr(f"""aggregate(pieces,
        named_struct('pos', 0, 'out', cast(array() as array<struct<start:int,stop:int>>)),
        (a, p) -> named_struct('pos', a.pos + length(p.head) + length(p.body) + {len(END)}, 'out',
            if(p.role = '{trained_role}', array_append(a.out, named_struct('start', a.pos + length(p.head),
                'stop', a.pos + length(p.head) + length(p.body))), a.out)), a -> a.out)""")


def read_back(formatted: DataFrame) -> DataFrame:
    """``formatted`` with ``turns``, an array of role and text parsed from the markup, and ``loss_text``, what the
    spans cover; both with the escapes taken back."""
    def parse(turn: Column) -> Column:
        return F.struct(unescape(F.substring_index(turn, TEXT, 1)).alias("role"),
                        unescape(F.regexp_replace(F.regexp_replace(turn, r"(?s)^.*?<\|text\|>", ""),
                                                  r"<\|end\|>$", "")).alias("text"))

    turns = F.filter(F.split("formatted", r"<\|turn\|>", -1), lambda t: t != "")
    covered = F.expr("transform(loss_spans, s -> substring(formatted, s.start + 1, s.stop - s.start))")
    return formatted.withColumns({"turns": F.transform(turns, parse),
                                  "loss_text": F.array_join(F.transform(covered, unescape), "")})


def chat_report(formatted: DataFrame) -> DataFrame:
    """Digests of what is read back from the formatted conversations."""
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read_back(formatted).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
