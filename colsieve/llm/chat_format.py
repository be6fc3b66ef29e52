"""Chat formatting with typed content parts, in DataFrame functions only.

A message is a list of parts: text, image, audio or document. A visitor turns every part into text:
text is escaped, any other part becomes a placeholder, and what it stood for is recorded in order
with the number of tokens it expands to. A conversation becomes a list of marked turns:

    <|im_start|>ROLE
    BODY<|im_end|>

Each turn carries its own loss span and attachments, so the format can be read back turn by turn.

Escaping: ``<`` followed by any number of backslashes and ``|`` gets one backslash more, so texts
never hold ``<|``; in roles ``%`` and line feeds are percent-encoded as well. Both are undone exactly.

A conversation is one row of the result and must fit one task, as its digests and its formatted text
are each of the whole; conversations don't meet each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
END_PATTERN = r"<\|im_end\|>\n"
PLACEHOLDER = r"<\|(?:image|audio|document)\|>"
KINDS = ("image", "audio", "document")

#: An attachment written in a text, and the endings that tell its kind; any other is an image.
ATTACHMENT = r"!\[[^\[\]\n]*\]\(([^()\x00-\x20]+)\)"
AUDIO = r"(?i)\.(mp3|wav|flac|ogg|opus|m4a)$"
DOCUMENT = r"(?i)\.(pdf|docx|pptx|xlsx|epub|odt)$"

#: Pixels on a side of an image token, audio tokens a second, tokens a page; tokens where sizes are unknown.
PATCH, AUDIO_RATE, PAGE_TOKENS = 28, 25, 1024
UNKNOWN = {"image": 256, "audio": 750, "document": 1024}

PART = ("struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>")


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _escaped_role(role: Column) -> Column:
    return F.replace(F.replace(escaped(role), F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))


def _unescaped_role(role: Column) -> Column:
    return unescaped(F.replace(F.replace(role, F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%")))


def part(kind: Column | str, text: Column, ref: Column | None = None) -> Column:
    """One part of unknown size."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    ref = F.lit(None).cast("string") if ref is None else ref
    empty = [F.lit(None).cast(t).alias(n) for n, t in (("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int"))]
    return F.struct(kind.alias("kind"), text.alias("text"), ref.alias("ref"), *empty)


def parts_of_text(text: Column) -> Column:
    """Parts of a plain text: what ``![name](address)`` names is an attachment, the rest is text."""
    plain = F.split(text, ATTACHMENT)
    marks = F.regexp_extract_all(text, F.lit(ATTACHMENT), F.lit(0))

    def attachment(mark: Column) -> Column:
        ref = F.regexp_extract(mark, ATTACHMENT, 1)
        kind = F.when(ref.rlike(AUDIO), "audio").when(ref.rlike(DOCUMENT), "document").otherwise("image")
        return part(kind, mark, ref)

    both = F.flatten(F.zip_with(plain, marks, lambda t, m: F.array(part("text", t), F.when(m.isNotNull(), attachment(m)))))
    return F.when(text.contains("!["), F.filter(both, lambda p: p.isNotNull())).otherwise(F.array(part("text", text)))


def _kind(p: Column) -> Column:
    """``text`` or one of KINDS; an unknown kind is a document, a null kind is text."""
    return F.when(p["kind"].isNull() | (p["kind"] == "text"), "text").when(p["kind"].isin(*KINDS), p["kind"]).otherwise("document")


def expanded_tokens(p: Column) -> Column:
    """Tokens that an attachment takes in place of its placeholder."""
    image = F.ceil(p["width"] / PATCH) * F.ceil(p["height"] / PATCH)
    sizes = {"image": image, "audio": F.ceil(p["seconds"] * AUDIO_RATE), "document": p["pages"].cast("long") * PAGE_TOKENS}
    found = F.lit(0).cast("long")
    for kind, size in sizes.items():
        found = F.when(_kind(p) == kind, F.coalesce(size, F.lit(UNKNOWN[kind])).cast("long")).otherwise(found)
    return found


def _visit(p: Column) -> Column:
    return F.when(_kind(p) == "text", escaped(F.coalesce(p["text"], F.lit("")))).otherwise(F.concat(F.lit("<|"), _kind(p), F.lit("|>")))


def _attachments(parts: Column) -> Column:
    others = F.filter(parts, lambda p: _kind(p) != "text")
    return F.transform(others, lambda p: F.struct(
        _kind(p).alias("kind"), p["ref"].alias("ref"), expanded_tokens(p).alias("n_tokens"),
        F.coalesce(p["text"], F.lit("")).alias("source")))


def marked_turn(role: Column, parts: Column) -> Column:
    """``struct<text, loss_from, loss_to, attachments>``; the span is the body of an assistant's turn, else empty."""
    held = F.filter(F.coalesce(parts, F.array().cast(f"array<{PART}>")), lambda p: p.isNotNull())
    head = F.concat(F.lit(START), _escaped_role(role), F.lit("\n"))

    def turn(x: Column) -> Column:
        begin = F.length(x["head"])
        end = F.when(role == "assistant", begin + F.length(x["body"])).otherwise(begin)
        return F.struct(
            F.concat(x["head"], x["body"], F.lit(END)).alias("text"), begin.alias("loss_from"), end.alias("loss_to"),
            x["attachments"].alias("attachments"))

    made = F.struct(
        head.alias("head"), F.array_join(F.transform(held, _visit), "").alias("body"), _attachments(held).alias("attachments"))
    return F.element_at(F.transform(F.array(made), turn), 1)  # a lambda's argument is computed once


def format_conversations(messages: DataFrame) -> DataFrame:
    """``(conv_id, turns, n_turns, attachment_tokens)`` from ``(conv_id, turn, role, parts)``.

    ``turns`` is an array of ``marked_turn`` in the order of turn (null first), then role, then text;
    repeated rows stay turns of their own. Null roles and parts are empty; rows without a conv_id
    form one conversation. Other columns are ignored. An empty table gives no row.
    """
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    marked = messages.select("conv_id", F.struct("turn", role.alias("role"), marked_turn(role, F.col("parts")).alias("marked")).alias("x"))
    grouped = marked.groupBy("conv_id").agg(F.sort_array(F.collect_list("x")).alias("xs"))
    turns = grouped.select("conv_id", F.transform("xs", lambda x: x["marked"]).alias("turns"))
    tokens = F.aggregate("turns", F.lit(0).cast("long"), lambda total, t: total + F.aggregate(
        t["attachments"], F.lit(0).cast("long"), lambda n, a: n + a["n_tokens"]))
    return turns.select("conv_id", "turns", F.size("turns").cast("long").alias("n_turns"), tokens.alias("attachment_tokens"))


def rendered(turns: Column) -> Column:
    """The whole formatted text."""
    return F.array_join(F.transform(turns, lambda t: t["text"]), "")


def restored(body: Column, attachments: Column) -> Column:
    """The text that a body was made of: placeholders give way to their sources, escapes are undone."""
    plain = F.split(body, PLACEHOLDER)
    sources = F.transform(attachments, lambda a: a["source"])
    return F.array_join(F.zip_with(plain, sources, lambda t, s: F.concat(unescaped(t), F.coalesce(s, F.lit("")))), "")


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what the formatted texts hold, by parsing them.

    ``(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars)``: turns come from
    the whole text, cut at its end marks; the learned text comes from the loss spans.
    """
    def turn_text(text: Column, attachments: Column) -> Column:
        head = F.substring_index(text, "\n", 1)
        body = F.substr(text, F.length(head) + 2)
        role = _unescaped_role(F.substr(head, F.lit(len(START) + 1)))
        return F.concat(role, F.lit("\n"), restored(body, attachments), F.lit("\n"))

    def parsed(x: Column) -> Column:
        pieces = F.split(x["whole"], END_PATTERN)  # the last one is empty
        cut = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
        found = F.zip_with(cut, x["turns"], lambda text, t: turn_text(text, t["attachments"]))
        return F.struct(
            F.size(found).cast("long").alias("n_turns"), F.sha2(F.array_join(found, ""), 256).alias("turns_sha256"),
            F.length(x["whole"]).cast("long").alias("formatted_chars"))

    def learned(t: Column) -> Column:
        return restored(F.substr(t["text"], t["loss_from"] + 1, t["loss_to"] - t["loss_from"]), t["attachments"])

    whole = F.struct(rendered(F.col("turns")).alias("whole"), F.col("turns").alias("turns"))
    loss = F.array_join(F.transform(F.filter("turns", lambda t: t["loss_to"] > t["loss_from"]), learned), "")
    lossy = F.transform(F.array(loss), lambda s: F.struct(F.length(s).cast("long").alias("loss_chars"), F.sha2(s, 256).alias("loss_sha256")))
    both = formatted.select(
        "conv_id", F.element_at(F.transform(F.array(whole), parsed), 1).alias("p"), F.element_at(lossy, 1).alias("l"))
    return both.select("conv_id", "p.n_turns", "p.turns_sha256", "l.loss_chars", "l.loss_sha256", "p.formatted_chars")


def messages_of(conversations: DataFrame) -> DataFrame:
    """Messages of a plain table ``(conv_id, turn, role, text)``; null texts are empty."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return conversations.select("conv_id", "turn", "role", parts_of_text(text).alias("parts"))
