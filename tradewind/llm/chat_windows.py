"""Chat formatting in budgeted windows of whole turns.

Prefix sums of turn tokens lay a conversation out on a line. The line is cut into stretches of `STRETCH` budgets; a
turn belongs to the stretch in which it begins, so a task holds a bounded part of a conversation, however long
that is. Inside a stretch, searches in the prefix sums choose the longest spans of turns that fit the budget
together with the system turn and a limited history of turns before. Only new assistant turns are under the loss
mask, so each is learned once, though it may be repeated as history.

A turn is `<|im_start|>role, line break, text, <|im_end|>, line break`. Inside roles and texts `<|` never stands: every
`<`, any number of backslashes, `|` gets one backslash more, which reading takes away again.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import null_safe, prefix_sums, row_hash

BUDGET, HISTORY, STRETCH = 2048, 512, 32
START, END = "<|im_start|>", "<|im_end|>"
TURN = re.compile(r"<\|im_start\|>(.*?)\n(.*?)<\|im_end\|>\n", re.S)
PIECE = re.compile(r"\w+|[^\w\s]")
FRAME_TOKENS = 4  # of a turn besides its text
NEW, BEFORE, SYSTEM = 0, 1, 2


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn, and where in it the text begins and ends."""
    head = START + escape(role.replace("\\", "\\\\").replace("\n", "\\n")) + "\n"
    body = escape(text)
    return head + body + END + "\n", len(head), len(head) + len(body)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn."""
    def role(r):
        return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(r))

    return [(role(m[1]), unescape(m[2])) for m in TURN.finditer(formatted)]


def token_counter(tokenizer_path: str | None):
    """Counts tokens of many texts: by a tokenizer file, or else words and marks."""
    if tokenizer_path is None:
        return lambda texts: [len(PIECE.findall(t)) for t in texts]
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path)
    tokenizer.encode_special_tokens = True
    return lambda texts: [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def spans(begin: np.ndarray, end: np.ndarray, first: int, budget: int, history: int, fixed: int) -> Iterator[tuple[int, int, int]]:
    """(history from, new from, new to) over turns given by their prefix sums; turns before `first` are history
    only. `fixed` tokens go to the system turn. A turn that fits in no window stands alone, over the budget."""
    at = first
    while at < len(begin):
        back = int(np.searchsorted(begin, begin[at] - history, "left"))
        # History makes way for a new turn that would not fit beside it.
        back = min(at, max(back, int(np.searchsorted(begin, end[at] - (budget - fixed), "left"))))
        to = max(int(np.searchsorted(end, begin[back] + budget - fixed, "right")), at + 1)
        yield back, at, to
        at = to


WINDOW = ("conv_id bigint, begin bigint, n_repeated int, n_tokens bigint, over_budget boolean, text string, "
          "loss_from array<int>, loss_to array<int>")


def windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY, stretch: int = STRETCH,
            tokenizer_path: str | None = None) -> DataFrame:
    """Windows of all conversations (conv_id, turn, role, text).

    A window has its place in the conversation (`begin`, in tokens), the number of turns repeated at its head, its tokens,
    the formatted text, and the spans under the loss mask. Turns are ordered by number, then role and text; repeated
    rows are turns of their own. Null roles and texts are empty, rows without conv_id are one conversation. The
    first turn is retained as the system turn if its role is `system`. Other columns are not looked at."""
    if not 0 <= history < budget:
        raise ValueError("history is smaller than the budget")

    def count(frames):
        count_tokens = token_counter(tokenizer_path)
        for frame in frames:
            frame["tokens"] = np.array(count_tokens(frame["text"].tolist()), np.int64) + FRAME_TOKENS
            yield frame

    rows = turns.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
                        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    counted = rows.mapInPandas(count, "conv_id bigint, turn bigint, role string, text string, tokens bigint").withColumn(
        "_row", row_hash(F.col("role"), F.col("text")))
    laid = prefix_sums(counted, ["conv_id"], ["turn", "role", "_row"], "tokens", "turns").select(
        "conv_id", F.col("_before").alias("begin"), (F.col("_before") + F.col("tokens")).alias("end"), "_id", "role", "text")
    size = budget * stretch
    own = F.floor(F.col("begin") / size)
    following = F.floor((F.col("end") + history) / size)  # stretches that may repeat the turn as history
    place = lambda s, kind: F.struct(s.alias("stretch"), F.lit(kind).alias("kind"))
    later = F.when(following > own, F.transform(F.sequence(own + 1, following), lambda s: place(s, BEFORE))).otherwise(
        F.array().cast("array<struct<stretch:bigint,kind:int>>"))
    first = (F.col("begin") == 0) & (F.col("role") == "system")
    body = laid.select("*", F.explode(F.concat(F.array(place(own, NEW)), F.when(first, F.slice(later, 1, 0)).otherwise(later))).alias("_p"))
    last = laid.groupBy("conv_id").agg(F.max(own).alias("_last"))
    system = null_safe(laid.where(first), last, ["conv_id"], "inner").where(F.col("_last") > 0).select(
        *laid.columns, F.explode(F.transform(F.sequence(F.lit(1).cast("bigint"), "_last"), lambda s: place(s, SYSTEM))).alias("_p"))
    placed = body.unionByName(system).select("conv_id", "_p.stretch", "_p.kind", "begin", "end", "_id", "role", "text")

    def cut(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["begin", "_id"], kind="stable")
        kinds, roles, texts = frame["kind"].tolist(), frame["role"].tolist(), frame["text"].tolist()
        has_system = kinds[0] == SYSTEM or bool(frame["begin"].iloc[0] == 0 and roles[0] == "system")
        begin, end = frame["begin"].to_numpy(), frame["end"].to_numpy()
        fixed = int(end[0] - begin[0]) if has_system else 0
        made = [format_turn(r, t) for r, t in zip(roles, texts)]
        out = []
        new = kinds.index(NEW) if NEW in kinds else len(kinds)
        skip = 1 if has_system else 0
        leading = has_system and new == 0  # the system turn itself is new here
        first_ = max(new - skip, 0)
        found = list(spans(begin[skip:], end[skip:], first_, budget, history, fixed))
        if leading and not found:
            found = [(0, 0, 0)]
        for n, (back, at, to) in enumerate(found):
            shown = ([0] if has_system else []) + list(range(skip + back, skip + to))
            fresh = skip + at
            repeated = sum(i < fresh for i in shown)
            if leading and n == 0:
                repeated = 0
            text, low, high, length = [], [], [], 0
            for i in shown:
                formatted, a, b = made[i]
                if roles[i] == "assistant" and i >= fresh:
                    low.append(length + a)
                    high.append(length + b)
                text.append(formatted)
                length += len(formatted)
            tokens = fixed + (int(end[skip + to - 1] - begin[skip + back]) if to > back else 0)
            place_ = 0 if leading and n == 0 else int(begin[fresh])
            out.append((frame["conv_id"].iloc[0], place_, repeated, tokens, tokens > budget, "".join(text), low, high))
        names = ["conv_id", "begin", "n_repeated", "n_tokens", "over_budget", "text", "loss_from", "loss_to"]
        return pd.DataFrame(out, columns=names).astype({"conv_id": "Int64"})

    return placed.groupBy("conv_id", "stretch").applyInPandas(cut, WINDOW)


def digests(made: DataFrame) -> DataFrame:
    """What windows say when read back, per conversation: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    A digest is over a whole conversation in order, so its windows stream through one task, which holds one of them."""
    def run(frames):
        state = None

        def result():
            return [state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5]]

        for frame in frames:
            done = []
            for w in frame.itertuples():
                conv = None if pd.isna(w.conv_id) else int(w.conv_id)
                if state is None or state[0] != conv:
                    if state is not None:
                        done.append(result())
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in read_turns(w.text)[w.n_repeated:]:
                    state[1] += 1
                    state[2].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                for a, b in zip(w.loss_from, w.loss_to):
                    text = unescape(w.text[a:b])
                    state[3] += len(text)
                    state[4].update(text.encode("utf-8", "surrogatepass"))
                state[5] += len(w.text)
            yield pd.DataFrame(done, columns=names).astype({"conv_id": "Int64"})
        if state is not None:
            yield pd.DataFrame([result()], columns=names).astype({"conv_id": "Int64"})

    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    return made.repartition("conv_id").sortWithinPartitions("conv_id", "begin").mapInPandas(
        run, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")
