"""Chat formatting in budgeted windows.

The turns of a conversation are counted in tokens; prefix sums of these choose
spans that begin and end with a turn.  Each window holds the system turn, a
limited history repeated from before, and its own span; only the assistant
texts of the own span are targets.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridtally.llm.common import ship, text_or_empty
from gridtally.llm.tokens import default_vocabulary, encoder

# The template and the control strings of common templates.
START, END = "<|im_start|>", "<|im_end|>"
_REST = r"(\|[A-Za-z_]+\|>|/?s>|/?INST\]|</?SYS>>)"
_CONTROL = re.compile(r"([<\[])(\\*)" + _REST)
_ESCAPED = re.compile(r"([<\[])\\(\\*)" + _REST)
_TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + r"\n", re.S)
#: Turns of a conversation are numbered in runs of so many, so that no window function has a longer group.
RUN = 1024


@dataclass(frozen=True)
class Budget:
    """Tokens of a window and of its repeated history; ``block`` windows are cut in one task."""

    window: int = 2048
    history: int = 512
    least: int = 256
    block: int = 64


def escape(text: str) -> str:
    """One backslash more inside every control string; no control string is left."""
    return _CONTROL.sub(r"\1\2" + r"\\" + r"\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def render(role: str, text: str) -> str:
    return f"{START}{escape_role(role)}\n{escape(text)}{END}\n"


def read_window(text: str, mask: list[tuple[int, int]], repeated: int) -> tuple[list[tuple[str, str]], str]:
    """The new turns of a formatted window, and the unescaped text under its loss mask."""
    turns = [(unescape_role(m[1]), unescape(m[2])) for m in _TURN.finditer(text)]
    return turns[repeated:], "".join(unescape(text[a:b]) for a, b in mask)


def _count_tokens(path: str):
    def count(frames: Iterator) -> Iterator:
        for f in frames:
            texts = [render(r, t) for r, t in zip(f["role"], f["text"], strict=True)]
            f["tokens"] = [len(ids) // 4 for ids in encoder(path).many(texts)]
            yield f
    return count


def _place(turns: DataFrame) -> DataFrame:
    """``turns`` with ``pos``, their place in the conversation, and ``before``, the tokens that precede them.

    A conversation is numbered run by run; the runs' sums, a thousandth of the rows, carry over.
    """
    order = ["turn", "role", "text"]
    runs = turns.withColumn("run", F.floor(F.coalesce("turn", F.lit(-1)) / RUN))
    inside = Window.partitionBy("conv_id", "run").orderBy(*order)
    across = Window.partitionBy("conv_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        runs.groupBy("conv_id", "run").agg(F.sum("tokens").alias("sum"), F.count("*").alias("n"))
        .select(F.col("conv_id").alias("c"), F.col("run").alias("r"),
                F.coalesce(F.sum("sum").over(across), F.lit(0)).alias("earlier"),
                F.coalesce(F.sum("n").over(across), F.lit(0)).alias("earlier_n"))
    )
    return (
        runs.withColumns({
            "in_run": F.sum("tokens").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("tokens"),
            "n_run": F.row_number().over(inside) - 1})
        .join(carried, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("run") == F.col("r")))
        .select("conv_id", "role", "text", "tokens", (F.col("in_run") + F.col("earlier")).alias("before"),
                (F.col("n_run") + F.col("earlier_n")).alias("pos"))
    )


def format_conversations(conversations: DataFrame, budget: Budget = Budget(), vocabulary: str | None = None) -> DataFrame:
    """One row per window: (conv_id, block, window, text, mask, repeated, tokens).

    ``text`` is the formatted window, ``mask`` the places (start, end) of its targets in characters, ``repeated`` how
    many of its first turns stand in an earlier window too (the system turn, then history), ``tokens`` its length.
    A window keeps to the budget unless its system turn or one turn of its own is too long for it; such a turn stays
    whole.  Windows of a conversation are ordered by (block, window).

    Turns are ordered by ``turn``, then role and text, so that repeated rows and ties have a fixed order and all
    count; null turns come first.  Null texts and roles are empty.  Rows without conv_id form a conversation.  A
    conversation without a system turn at its beginning has none.  Other columns are not read; an empty table gives
    no window.
    """
    ship(conversations.sparkSession)
    path = vocabulary or default_vocabulary()
    turns = conversations.select(
        F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"),
        text_or_empty("role").alias("role"), text_or_empty("text").alias("text"))
    counted = turns.mapInPandas(
        _count_tokens(path), "conv_id bigint, turn bigint, role string, text string, tokens int")
    placed = _place(counted)
    is_system = (F.col("pos") == 0) & (F.col("role") == "system")
    system = placed.where(is_system).select(
        F.col("conv_id").alias("c"), F.col("text").alias("system"), F.col("tokens").alias("system_tokens"))
    room = F.greatest(F.lit(budget.window - budget.history) - F.coalesce("system_tokens", F.lit(0)), F.lit(budget.least))
    size = F.col("room") * budget.block
    block = F.floor(F.col("start") / size)
    near_next = F.col("start") + F.col("tokens") > (block + 1) * size - budget.history
    spread = (
        placed.join(system, F.col("conv_id").eqNullSafe(F.col("c")), "left")
        .withColumn("start", F.when(is_system, 0).otherwise(F.col("before") - F.coalesce("system_tokens", F.lit(0))))
        .withColumn("room", room)
        .withColumn("own", block)
        .withColumn("block", F.explode(F.when(near_next & ~is_system, F.array(block, block + 1)).otherwise(F.array(block))))
    )
    blocks = (
        spread.groupBy("conv_id", "block")
        .agg(F.any_value("system").alias("system"), F.any_value("system_tokens").alias("system_tokens"),
             F.any_value("room").alias("room"),
             F.sort_array(F.collect_list(F.struct("pos", "role", "text", "tokens", (F.col("own") == F.col("block")).alias("own")))).alias("turns"))
        .where(F.exists("turns", lambda t: t["own"]))
    )

    def cut(frames: Iterator) -> Iterator:
        import pandas as pd

        for f in frames:
            rows = []
            for row in f.itertuples(index=False):
                rows += [(row.conv_id, row.block, *w) for w in _windows(row, budget)]
            yield pd.DataFrame(rows, columns=["conv_id", "block", "window", "text", "mask", "repeated", "tokens"]).astype(
                {"conv_id": "Int64"})

    return blocks.mapInPandas(cut, (
        "conv_id bigint, block bigint, window int, text string, mask array<struct<start:int,end:int>>, "
        "repeated int, tokens int"))


def _windows(row, budget: Budget) -> Iterator[tuple]:
    """Windows of one block; the turns that are not its own are history of its first window."""
    import numpy as np

    turns = list(row.turns)
    first = next(i for i, t in enumerate(turns) if t["own"])
    has_system = row.system is not None and row.system == row.system
    body = turns[1:] if first == 0 and has_system and turns[0]["pos"] == 0 else turns
    first -= len(turns) - len(body)
    first = max(first, 0)
    ends = np.cumsum([0] + [t["tokens"] for t in body])
    opening = render("system", row.system) if has_system else ""
    opening_tokens = int(row.system_tokens) if has_system else 0
    new_system = has_system and len(body) < len(turns)
    at, number = first, 0
    while at < len(body) or (number == 0 and new_system):
        last = max(int(np.searchsorted(ends, ends[at] + row.room, side="right")) - 1, min(at + 1, len(body)))
        back = int(np.searchsorted(ends, ends[at] - budget.history, side="left"))
        parts, mask, length = [opening], [], len(opening)
        for i in range(back, last):
            turn = render(body[i]["role"], body[i]["text"])
            if i >= at and body[i]["role"] == "assistant":
                begin = length + len(START) + len(escape_role("assistant")) + 1
                mask.append({"start": begin, "end": begin + len(escape(body[i]["text"]))})
            parts.append(turn)
            length += len(turn)
        repeated = at - back + int(has_system and not (new_system and number == 0))
        yield number, "".join(parts), mask, repeated, opening_tokens + int(ends[last] - ends[back])
        at, number = last, number + 1
