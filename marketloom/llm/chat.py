"""Chat formatting: budgeted windows of whole turns with a loss mask that covers each assistant text once."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.S)
WINDOWS = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("window", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("repeated", T.IntegerType()),
        T.StructField("loss_starts", T.ArrayType(T.LongType())),
        T.StructField("loss_ends", T.ArrayType(T.LongType())),
        T.StructField("tokens", T.LongType()),
    ]
)
DIGESTS = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("n_turns", T.LongType()),
        T.StructField("turns_sha256", T.StringType()),
        T.StructField("loss_chars", T.LongType()),
        T.StructField("loss_sha256", T.StringType()),
        T.StructField("formatted_chars", T.LongType()),
        T.StructField("n_windows", T.LongType()),
    ]
)


def escape(text: str) -> str:
    """'<|' never occurs in the result: '<', any backslashes and '|' get one backslash more."""
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescape(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def _turn(role: str, text: str) -> tuple[str, int]:
    """The formatted turn and where its text begins."""
    head = f"{OPEN}{escape_role(role)}\n"
    return f"{head}{escape(text)}{CLOSE}\n", len(head)


def _window_rows(batches: Iterator[pd.DataFrame], budget: int, history: int) -> Iterator[pd.DataFrame]:
    """Rows of a conversation come together and in order; all that is held is the window being filled and its history (no more than `history` tokens)."""
    conv = object()
    system: tuple | None = None
    new: list[tuple] = []
    recent: list[tuple] = []
    number = base = 0
    out: list[tuple] = []
    held = 0

    def close() -> None:
        """base: the prefix sum before the window's first new turn. History: the last turns whose sum fits."""
        nonlocal number, new, recent, held
        if not new:
            return
        lead = [*([system] if number and system else []), *recent]
        text, starts, ends = [], [], []
        at = 0
        for i, (role, body, _) in enumerate([*lead, *new]):
            piece, head = _turn(role, body)
            if i >= len(lead) and role == "assistant":
                starts.append(at + head)
                ends.append(at + len(piece) - len(CLOSE) - 1)
            text.append(piece)
            at += len(piece)
        out.append((conv, number, "".join(text), len(lead), starts, ends, sum(t[2] for t in (*lead, *new))))
        held += at
        number += 1
        turns, recent, room = [t for t in [*recent, *new] if t is not system], [], history
        while turns and turns[-1][2] <= room:
            room -= turns[-1][2]
            recent.insert(0, turns.pop())
        new = []

    for pdf in batches:
        for c, role, body, through, n in zip(pdf.conv, pdf.role, pdf.text, pdf.through, pdf.tokens, strict=True):
            c = int(c) if c else None
            if c != conv:
                close()
                conv, system, recent, number, base = c, None, [], 0, 0
            room = budget - (history + (system[2] if system else 0) if number else 0)
            if new and through - base > max(room, 1):
                close()
                base = through - n
            turn = (role, body, int(n))
            if system is None and role == "system" and not number and not new:
                system = turn
            new.append(turn)
            if held > 1 << 22:
                yield pd.DataFrame(out, columns=WINDOWS.names)
                out, held = [], 0
    close()
    yield pd.DataFrame(out, columns=WINDOWS.names)


def format_windows(turns: DataFrame, budget: int = 512, history: int = 96) -> DataFrame:
    """(conv_id, window, text, repeated, loss_starts, loss_ends, tokens): windows of whole turns of every conversation.

    Turns are ordered by turn (null first; ties by role, then text). A prefix sum of their tokens (words, marks and four
    for the template) decides where a window ends: it takes turns while their sum fits the budget less what is
    repeated; a turn larger than that has a window of its own. From the second window on, the system turn with which the
    conversation began and the last turns within `history` tokens are repeated in front: `repeated` counts them, and
    the loss spans (code points of text, each new assistant turn's text) leave them out. Null role and text count as
    empty; a null conv_id is a conversation; an empty table gives no rows; other columns are not read.
    """
    tokens = F.regexp_count("text", F.lit(r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]")) + 4
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("tokens", tokens.cast("long"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def sums() -> Iterator[pd.DataFrame]:
            last, total = None, 0
            for pdf in batches:
                if pdf.empty:
                    continue
                first = pdf.conv.ne(pdf.conv.shift())
                first.iloc[0] = pdf.conv.iloc[0] != last
                block = first.astype(int).cumsum()
                through = pdf.tokens.groupby(block).cumsum()
                through[block == 0] += total
                last, total = pdf.conv.iloc[-1], int(through.iloc[-1])
                yield pdf.assign(through=through)

        yield from _window_rows(sums(), budget, history)

    conv = F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv")
    return rows.select(conv, "role", "text", "tokens").mapInPandas(run, WINDOWS)


def read_back(windows: DataFrame) -> DataFrame:
    """Per conversation, what format_windows wrote, parsed from the windows: n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars, n_windows. Windows of a conversation must lie together and in order, as
    format_windows leaves them; only hash states are held."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        conv = object()
        state: list = []
        out: list[tuple] = []

        def close() -> None:
            if state:
                n, turns, chars, loss, size, k = state
                out.append((conv, n, turns.hexdigest(), chars, loss.hexdigest(), size, k))

        for pdf in batches:
            for c, text, repeated, starts, ends in zip(pdf.conv, pdf.text, pdf.repeated, pdf.loss_starts, pdf.loss_ends, strict=True):
                c = int(c) if c else None
                if c != conv:
                    close()
                    conv, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                for role, body in _TURN.findall(text)[repeated:]:
                    state[0] += 1
                    state[1].update(f"{unescape_role(role)}\n{unescape(body)}\n".encode())
                for s, e in zip(starts, ends, strict=True):
                    body = unescape(text[s:e])
                    state[2] += len(body)
                    state[3].update(body.encode())
                state[4] += len(text)
                state[5] += 1
            if len(out) > 20_000:
                yield pd.DataFrame(out, columns=DIGESTS.names)
                out = []
        close()
        yield pd.DataFrame(out, columns=DIGESTS.names)

    conv = F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv")
    return windows.select(conv, "text", "repeated", "loss_starts", "loss_ends").mapInPandas(run, DIGESTS)
