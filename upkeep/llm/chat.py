"""Chat formatting as one string per conversation with a loss mask. DataFrame expressions only.

    <s>[user]text[/user][assistant]text<t>text[/assistant]</s>

Neighbouring turns of one role share a block, their texts with `<t>` between. `<`, `[`, `]` and `&` inside texts and roles
are escaped, so no text can hold a control string, and undone after the blocks are cut apart. The mask says of each
segment of the string whether the loss counts there: on assistant texts, not on marks.

Turns are merged CHUNK by CHUNK before a conversation is, since merging copies what is merged already.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK = 256
ESCAPES = {"&": "&amp;", "<": "&lt;", "[": "&lsb;", "]": "&rsb;"}  # fixed values, in the order of use
OPEN, CLOSE, NEXT = "<s>", "</s>", "<t>"
_BLOCKS = "array<struct<role:string,texts:array<string>>>"


def escaped(text: Column) -> Column:
    for raw, code in ESCAPES.items():
        text = F.replace(text, F.lit(raw), F.lit(code))
    return text


def unescaped(text: Column) -> Column:
    for raw, code in reversed(ESCAPES.items()):
        text = F.replace(text, F.lit(code), F.lit(raw))
    return text


def _append(done: Column, more: Column) -> Column:
    """Blocks, and blocks that follow them; a role that goes on is one block."""
    last, first = F.try_element_at(done, F.lit(-1)), F.get(more, 0)
    together = F.struct(last["role"].alias("role"), F.concat(last["texts"], first["texts"]).alias("texts"))
    return F.when(F.coalesce(last["role"] == first["role"], F.lit(False)), F.concat(
        F.slice(done, 1, F.size(done) - 1), F.array(together), F.slice(more, 2, F.size(more)))).otherwise(F.concat(done, more))


def format_chat(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", loss_role: str = "assistant") -> DataFrame:
    """One row a conversation: its key, `n_turns`, `formatted`, and `segments` (text, loss): the string cut where the mask
    changes.

    Turns stand by `turn`, null last; equal turns by role and text. A null role or text is empty, a null key is a
    conversation, rows that repeat are turns of their own, other columns are not read, an empty table gives none.
    """
    name = lambda c: F.col(f"`{c}`")
    role_, text_ = (F.coalesce(name(c).cast("string"), F.lit("")) for c in (role, text))
    rows = turns.select(name(key), F.floor(name(turn) / CHUNK).alias("chunk"), F.struct(
        name(turn).isNull().alias("none"), name(turn).alias("turn"), role_.alias("role"), text_.alias("text")).alias("one"))
    # One shuffle: rows of a conversation stay where they are for both steps.
    rows = rows.repartition(name(key))
    one = lambda t: F.array(F.struct(t["role"].alias("role"), F.array(t["text"]).alias("texts")))
    empty = F.array().cast(_BLOCKS)
    parts = rows.groupBy(name(key), "chunk").agg(F.array_sort(F.collect_list("one")).alias("ones")).select(
        name(key), "chunk", F.size("ones").cast("long").alias("n"), F.aggregate("ones", empty, lambda done, t: _append(done, one(t))).alias("blocks"))
    whole = parts.groupBy(name(key)).agg(F.sum("n").alias("n_turns"), F.array_sort(F.collect_list(
        F.struct(F.col("chunk").isNull().alias("none"), "chunk", "blocks"))).alias("chunks"))
    blocks = whole.select(name(key), "n_turns", F.aggregate("chunks", empty, lambda done, c: _append(done, c["blocks"])).alias("blocks"))

    def segment(value: Column, loss: Column) -> Column:
        return F.struct(value.alias("text"), loss.alias("loss"))

    mark = lambda value: F.array(segment(value, F.lit(False)))
    def block(b: Column) -> Column:
        said = F.transform(b["texts"], lambda t, i: F.concat(
            F.when(i == 0, F.array().cast("array<struct<text:string,loss:boolean>>")).otherwise(mark(F.lit(NEXT))), F.array(segment(escaped(t), b["role"] == loss_role))))
        return F.concat(mark(F.concat(F.lit("["), escaped(b["role"]), F.lit("]"))), F.flatten(said), mark(F.concat(F.lit("[/"), escaped(b["role"]), F.lit("]"))))

    out = blocks.select(name(key), "n_turns", F.concat(mark(F.lit(OPEN)), F.flatten(F.transform("blocks", block)), mark(F.lit(CLOSE))).alias("segments"))
    return out.select(name(key), "n_turns", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments")


def read_chat(formatted: Column) -> Column:
    """The turns (role, text) of a formatted string."""
    body = F.substring(formatted, F.lit(len(OPEN) + 1), F.length(formatted) - len(OPEN) - len(CLOSE))
    blocks = F.filter(F.split(body, r"\[/[^\]]*\]"), lambda b: b != "")
    def turns(b: Column) -> Column:
        head = F.split(b, r"\]", 2)
        role = unescaped(F.substring(F.get(head, 0), 2, 2**31 - 1))
        return F.transform(F.split(F.get(head, 1), NEXT), lambda t: F.struct(role.alias("role"), unescaped(t).alias("text")))
    return F.flatten(F.transform(blocks, turns))


def masked_text(segments: Column) -> Column:
    """All text where the loss counts, unescaped."""
    return unescaped(F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: s["text"]), ""))
