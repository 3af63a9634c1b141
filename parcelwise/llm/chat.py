r"""Chat formatting with typed content parts (operator 4); DataFrame functions only.

A turn is (conversation, turn number, role, parts), a part is a struct with
``type`` (text, image, audio or document), ``text`` (text parts), ``ref`` (the
attachment's address) and ``units`` (images, seconds or pages). A visitor over
the parts writes every part as one segment

    <|turn|>role   <|text|>text   <|image|>  <|audio|>  <|document|>   <|end|>

so that the k-th placeholder of a conversation stands for the k-th entry of
its ``attachments`` (type, ref, expanded token count). Roles and texts are
escaped reversibly: a backslash is doubled, and one backslash is put behind
the first character of any control string (``<|``, ``<s>``, ``</s>``,
``[INST]``, ``[/INST]``), so no text can forge a marker.

``loss_mask`` has one (skip, learn) entry per segment: characters outside and
inside the loss; only bodies of the assistant's text parts are learnt.

Rules for odd rows: null texts, roles and part lists are empty; rows of one
conversation are ordered by turn (nulls first), ties by role and parts; rows
with a null conversation form one conversation; unknown part types become a
``<|document|>`` placeholder; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Tokens that one unit of an attachment expands to.
TOKENS_PER_UNIT = {"image": 256, "audio": 50, "document": 800}
LEARNT_ROLES = ("assistant",)
PART_TYPE = "struct<type:string,text:string,ref:string,units:long>"

_CONTROL = r"([<\[])(\||s>|/s>|INST\]|/INST\])"
_ESCAPED = r"([<\[])\\(\||s>|/s>|INST\]|/INST\])"
_SEGMENT = r"(?=<\|(?:turn|text|image|audio|document|end)\|>)"


def escape(text: Column) -> Column:
    doubled = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, _CONTROL, r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.replace(F.regexp_replace(text, _ESCAPED, "$1$2"), F.lit("\\\\"), F.lit("\\"))


def text_part(text: Column) -> Column:
    """A list with the one text part of a plain row."""
    return F.array(F.struct(F.lit("text").alias("type"), F.coalesce(text, F.lit("")).alias("text"),
                            F.lit(None).cast("string").alias("ref"), F.lit(None).cast("long").alias("units")))


def _segment(marker: Column, body: Column, learn: Column, attachment: Column) -> Column:
    head = F.concat(F.lit("<|"), marker, F.lit("|>"))
    learnt = F.when(learn, F.length(body)).otherwise(F.lit(0))
    skip = F.length(head) + F.length(body) - learnt
    return F.struct(F.concat(head, body).alias("text"), skip.alias("skip"), learnt.alias("learn"), attachment.alias("attachment"))


def _attachment(part: Column, kind: Column) -> Column:
    per = F.when(kind == "image", TOKENS_PER_UNIT["image"]).when(kind == "audio", TOKENS_PER_UNIT["audio"]).otherwise(TOKENS_PER_UNIT["document"])
    units = F.greatest(F.coalesce(part["units"], F.lit(1)), F.lit(1))
    return F.struct(kind.alias("type"), part["ref"].alias("ref"), (units * per).cast("long").alias("tokens"))


_NO_ATTACHMENT = "struct<type:string,ref:string,tokens:bigint>"


def _visit(part: Column, learn: Column) -> Column:
    """The segment of one content part."""
    none = F.lit(None).cast(_NO_ATTACHMENT)
    kind = F.when(part["type"].isin("image", "audio"), part["type"]).otherwise(F.lit("document"))
    is_text = F.coalesce(part["type"], F.lit("text")) == "text"
    return F.when(is_text, _segment(F.lit("text"), escape(part["text"]), learn, none)).otherwise(
        _segment(kind, F.lit(""), F.lit(False), _attachment(part, kind)))


def _turn_segments(turn: Column) -> Column:
    none = F.lit(None).cast(_NO_ATTACHMENT)
    learn = F.coalesce(turn["role"].isin(*LEARNT_ROLES), F.lit(False))
    parts = F.coalesce(turn["parts"], F.array().cast(f"array<{PART_TYPE}>"))
    return F.concat(F.array(_segment(F.lit("turn"), escape(turn["role"]), F.lit(False), none)),
                    F.transform(parts, lambda p: _visit(p, learn)),
                    F.array(_segment(F.lit("end"), F.lit(""), F.lit(False), none)))


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 parts_col: str = "parts") -> DataFrame:
    """One row per conversation: formatted text, loss_mask, attachments, expanded_tokens.

    ``expanded_tokens`` counts what the attachments expand to. One
    conversation is one output string, so its turns meet in one row.
    """
    ordered = turns.groupBy(F.col(conv_col).alias("conv_id")).agg(
        F.sort_array(F.collect_list(F.struct(F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(parts_col).alias("parts")))).alias("turns"))
    parts = ordered.select("conv_id", F.flatten(F.transform("turns", _turn_segments)).alias("segments"))
    found = F.filter(F.transform("segments", lambda s: s["attachment"]), lambda a: a.isNotNull())
    return parts.select(
        "conv_id",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        F.transform("segments", lambda s: F.struct(s["skip"].alias("skip"), s["learn"].alias("learn"))).alias("loss_mask"),
        found.alias("attachments"),
    ).withColumn("expanded_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + a["tokens"]))


def read_back(formatted: Column, loss_mask: Column) -> Column:
    """Segments read from the formatted text, beside their mask: (marker, body unescaped, learnt text unescaped)."""
    pieces = F.split(formatted, _SEGMENT, -1)

    def segment(piece: Column, mask: Column) -> Column:
        return F.struct(
            F.substring_index(F.substring(piece, 3, 20), "|>", 1).alias("marker"),
            unescape(F.regexp_replace(piece, r"^<\|\w+\|>", "")).alias("body"),
            unescape(F.substr(piece, mask["skip"] + 1, mask["learn"])).alias("learnt"),
        )

    return F.zip_with(pieces, loss_mask, segment)


def chat_digests(formatted: DataFrame) -> DataFrame:
    """Digest columns of ``format_chats`` output, all read back from the formatted text and its mask."""
    back = formatted.select("conv_id", "formatted", read_back(F.col("formatted"), F.col("loss_mask")).alias("back"))
    said = F.array_join(F.transform(F.filter("back", lambda s: s["marker"].isin("turn", "text")), lambda s: F.concat(s["body"], F.lit("\n"))), "")
    learnt = F.array_join(F.transform("back", lambda s: s["learnt"]), "")
    return back.select(
        "conv_id",
        F.size(F.filter("back", lambda s: s["marker"] == "turn")).cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length(learnt).cast("long").alias("loss_chars"),
        F.sha2(learnt, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


ORACLE_SQL = r"""
with rows_ as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
escaped as (select *,
  length(regexp_replace(replace(role, '\', '\\'), '([<\[])(\||s>|/s>|INST\]|/INST\])', '\1\\\2', 'g')) as role_chars,
  length(regexp_replace(replace(text, '\', '\\'), '([<\[])(\||s>|/s>|INST\]|/INST\])', '\1\\\2', 'g')) as text_chars
  from rows_)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  sum(23 + role_chars + text_chars)::bigint as formatted_chars
from escaped group by conv_id
"""
