"""Chat formatting: conversations as one training text with a loss mask.

Turn structs are collected by conversation and sorted, adjacent turns of one
role are merged into one block, and the blocks are concatenated.

Template of a block, with ``\\m`` between the texts that were merged into it::

    ### role: text</turn>

Backslashes and the template's control strings inside roles and texts are
escaped by two-character codes that start with a backslash, so the marks
``### ``, ``: `` (in roles), ``</turn>`` and ``\\m`` stand only where the
template puts them, and the turns can be read back exactly.

Native: DataFrame and SQL functions only.  One shuffle, by conversation.  The
group of a conversation is bounded by that conversation, as its text is one
row of the result; work within it is linear (sort aside).

Defined cases: null text and null role are empty; turns are ordered by (turn,
role, text) with nulls first, so ties have one order; repeated rows are
separate turns; a row with a null conversation id is a conversation of its
own with a null id, so such rows never gather in one group; an empty table
gives an empty table; other columns of the input are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let

HEAD, COLON, END, MERGED = "### ", ": ", "</turn>\n", "\\m"
LOSS_ROLE = "assistant"

#: control string -> code; the backslash first when escaping and last when reading back
_TEXT_CODES = {"\\": "\\s", "###": "\\h", "</turn>": "\\e"}
_ROLE_CODES = {**_TEXT_CODES, ":": "\\c"}


def _escape(col: Column, codes: dict[str, str]) -> Column:
    for raw, code in codes.items():
        col = F.replace(col, F.lit(raw), F.lit(code))
    return col


def _unescape(col: Column, codes: dict[str, str]) -> Column:
    for raw, code in reversed(codes.items()):
        col = F.replace(col, F.lit(code), F.lit(raw))
    return col


def _turns(rows: Column) -> Column:
    """Per turn: escaped role and text, whether it joins the turn before it and the turn after it."""
    def shifted(ts):
        roles = F.transform(ts, lambda t: t["role"])
        before = F.concat(F.array(F.lit(None).cast("string")), F.slice(roles, F.lit(1), F.size(roles) - 1))
        after = F.concat(F.slice(roles, F.lit(2), F.size(roles)), F.array(F.lit(None).cast("string")))
        joins = F.zip_with(F.zip_with(ts, before, lambda t, b: F.struct(t["role"].alias("role"), t["text"].alias("text"),
                                                                         F.coalesce(t["role"] == b, F.lit(False)).alias("on"))),
                           after, lambda t, a: F.struct(t["role"].alias("role"), t["text"].alias("text"), t["on"].alias("on"),
                                                        F.coalesce(t["role"] == a, F.lit(False)).alias("more")))
        return joins
    return let(rows, shifted)


def _pieces(turns: Column, loss_role: str) -> Column:
    """Per turn: what stands before its text, its escaped text, what stands behind it, and whether it is under the loss mask."""
    def piece(t):
        lead = F.when(t["on"], F.lit(MERGED)).otherwise(F.concat(F.lit(HEAD), _escape(t["role"], _ROLE_CODES), F.lit(COLON)))
        return F.struct(lead.alias("lead"), _escape(t["text"], _TEXT_CODES).alias("text"),
                        F.when(t["more"], F.lit("")).otherwise(F.lit(END)).alias("tail"), (t["role"] == loss_role).alias("loss"))
    return F.transform(turns, piece)


def _runs(pieces: Column) -> Column:
    """The loss mask run by run: per turn the code points before, in and behind its text, and whether the text is under the mask."""
    return F.transform(pieces, lambda p: F.struct(F.length(p["lead"]).alias("lead"), F.length(p["text"]).alias("text"),
                                                  F.length(p["tail"]).alias("tail"), p["loss"].alias("loss")))


def format_chats(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text", loss_role: str = LOSS_ROLE) -> DataFrame:
    """One row per conversation: ``id_col``, ``formatted`` and ``loss_runs``, the loss mask over ``formatted``."""
    turn = F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                    F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = conversations.select(F.col(id_col).alias("id"), turn.alias("t"))
    grouped = rows.where("id IS NOT NULL").groupBy("id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    alone = rows.where("id IS NULL").select("id", F.array("t").alias("ts"))
    pieces = grouped.unionByName(alone).select("id", _pieces(_turns(F.col("ts")), loss_role).alias("ps"))
    return pieces.select(
        F.col("id").alias(id_col),
        F.array_join(F.transform("ps", lambda p: F.concat(p["lead"], p["text"], p["tail"])), "").alias("formatted"),
        _runs(F.col("ps")).alias("loss_runs"))


def read_turns(formatted: Column) -> Column:
    """The (role, text) structs of a formatted text, merged turns apart again."""
    blocks = F.split(formatted, "</turn>\\n", -1)
    blocks = let(blocks, lambda bs: F.slice(bs, F.lit(1), F.size(bs) - 1))  # behind the last mark stands nothing
    def turns(block):
        role = _unescape(F.substring_index(F.substr(block, F.lit(len(HEAD) + 1)), COLON, 1), _ROLE_CODES)
        texts = F.split(F.substr(block, F.instr(block, COLON) + len(COLON)), r"\\m", -1)
        return let(role, lambda r: F.transform(texts, lambda x: F.struct(r.alias("role"), _unescape(x, _TEXT_CODES).alias("text"))))
    return F.flatten(F.transform(blocks, turns))


def read_loss(formatted: Column, loss_runs: Column) -> Column:
    """All text under the loss mask, cut out of ``formatted`` by the mask's code points, unescaped and in order."""
    def step(acc, run):
        text = _unescape(F.substr(formatted, acc["at"] + run["lead"] + 1, run["text"]), _TEXT_CODES)
        return F.struct((acc["at"] + run["lead"] + run["text"] + run["tail"]).alias("at"),
                        F.when(run["loss"], F.array_append(acc["texts"], text)).otherwise(acc["texts"]).alias("texts"))
    none = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("texts"))
    return F.aggregate(loss_runs, none, step, lambda acc: F.array_join(acc["texts"], ""))
