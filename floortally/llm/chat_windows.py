"""Conversations as training windows of a bounded number of tokens.

Every turn is rendered and counted on its own; prefix sums of the counts, kept across ranges of the whole
table, put each turn into a block of its conversation and choose spans of whole turns inside a block. A
window holds the system turn, a limited history that repeats earlier turns, and a span of new turns; the
loss mask covers the new assistant texts alone, so that a repeated target is never learned twice.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from floortally.llm import tokens
from floortally.llm.storage import discard, stored

BEGIN, END, TARGET, SYSTEM = "<|im_start|>", "<|im_end|>\n", "assistant", "system"
#: Where a control string of this template or another common one begins.
CONTROL = re.compile(r"<(?=\||/?s>|</?SYS>>)|\[(?=/?INST\])")
ESCAPED = re.compile(r"\\(.)", re.DOTALL)
HEADER = re.compile(re.escape(BEGIN) + r"((?:\\.|[^\\\n])*)\n", re.DOTALL)
WINDOW_SCHEMA = (
    "conv_id long, block long, window int, first_turn long, n_turns int, n_repeated int, n_tokens long, "
    "text string, loss array<struct<start: int, stop: int>>"
)


@dataclass(frozen=True)
class Budget:
    """Tokens of a window, of its history at most, and of a system turn that is retained at most. A
    conversation is cut into blocks of `block` tokens, in which windows are chosen; a block outgrows any history."""

    window: int = 1024
    history: int = 256
    system: int = 512
    block: int = 16_384


def escaped(text: str) -> str:
    """No control string is left: a backslash follows its first character, and backslashes are doubled."""
    return CONTROL.sub(lambda m: m.group() + "\\", text.replace("\\", "\\\\"))


def unescaped(text: str) -> str:
    return ESCAPED.sub(r"\1", text) if "\\" in text else text


def rendered(role: str, text: str) -> str:
    return f"{BEGIN}{escaped(role).replace('\n', '\\\n')}\n{escaped(text)}{END}"


def read_back(window: str) -> list[tuple[str, str, int]]:
    """Role, text and place of the rendered text, of every turn of a window."""
    turns, at = [], 0
    for turn in window.split(END)[:-1]:
        head = HEADER.match(turn)
        turns.append((unescaped(head[1]), unescaped(turn[head.end() :]), at + head.end()))
        at += len(turn) + len(END)
    return turns


def token_counter(tokenizer_json: str, singles: list[str]) -> Callable[[str], int]:
    """Tokens of a text as the tokenizer counts them, proven whole tokens without merging."""
    own = tokens._tokenizer(tokenizer_json)
    counts, special = tokens.Counter(own, singles), tokens.special_strings(own)
    find, plain = regex.compile(tokens.PRE_TOKEN).findall, regex.compile(tokens.PLAIN).fullmatch

    def count(text: str) -> int:
        if plain(text) and not any(s in text for s in special):
            return sum(map(counts.__getitem__, find(text)))
        return len(own.encode(text, add_special_tokens=False).ids)

    return count


def _turns(conversations: DataFrame, tokenizer_json: str) -> DataFrame:
    """Rendered turns with their tokens, each counted once: the table is written before it is sampled for ranges."""
    singles = tokens.proven_singles(tokens._tokenizer(tokenizer_json))
    schema = "conv_id long, turn long, said string, is_system boolean, is_target boolean, n_tokens long"

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = token_counter(tokenizer_json, singles)
        for batch in batches:
            roles = batch.column("role").fill_null("").to_pylist()
            said = [rendered(r, t) for r, t in zip(roles, batch.column("text").fill_null("").to_pylist())]
            columns = [batch.column("conv_id"), batch.column("turn"), pa.array(said, pa.string())]
            columns += [pa.array([r == x for r in roles], pa.bool_()) for x in (SYSTEM, TARGET)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(map(count, said), pa.int64())], [c.split()[0] for c in schema.split(", ")])

    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role"), F.col("text")
    )
    return stored(rows.mapInArrow(render, schema))


def _placed(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns with `position` and `before`, the turns and tokens in front of them in their conversation, and
    the stored table behind it. Rows are ranged by conversation and turn, and summed within each range; what
    a conversation has in earlier ranges is added after, so that a hot one is never summed in one task."""
    schema = "conv_id long, said string, is_system boolean, is_target boolean, n_tokens long, cell int, position long, before long"
    salted = turns.select("*", F.xxhash64("said").alias("tie"), F.monotonically_increasing_id().alias("salt"))
    ranged = salted.repartitionByRange("conv_id", "turn", "tie", "salt").sortWithinPartitions("conv_id", "turn", "tie", "said")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, last, position, before = TaskContext.get().partitionId(), (), 0, 0
        for batch in batches:
            n = batch.num_rows
            own = batch.column("conv_id")
            ids, known = own.fill_null(0).to_numpy(zero_copy_only=False), own.is_valid().to_numpy(zero_copy_only=False)
            size = batch.column("n_tokens").to_numpy()
            new = np.ones(n, bool)
            new[1:] = (ids[1:] != ids[:-1]) | (known[1:] != known[:-1])
            if n:
                new[0] = last != (ids[0], known[0])
                last = ids[-1], known[-1]
            total, nth = np.cumsum(size) - size + before, np.arange(n) + position
            group = np.cumsum(new)
            # What had been summed where the row's conversation begins; 0 for the one carried over.
            begin = np.concatenate([[0], np.flatnonzero(new)])
            sums_at, nth_at = np.append(total, 0)[begin] * (np.arange(len(begin)) > 0), np.append(nth, 0)[begin] * (np.arange(len(begin)) > 0)
            places, befores = nth - nth_at[group], total - sums_at[group]
            if n:
                position, before = int(places[-1]) + 1, int(befores[-1] + size[-1])
            columns = [batch.column(c) for c in ("conv_id", "said", "is_system", "is_target", "n_tokens")]
            columns += [pa.array(np.full(n, cell, np.int32)), pa.array(places), pa.array(befores)]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in schema.split(", ")])

    local = stored(ranged.mapInArrow(sums, schema))
    discard(turns)
    cells = local.groupBy("conv_id", "cell").agg(F.count("*").alias("n"), F.sum("n_tokens").alias("size"))
    earlier = Window.partitionBy("conv_id").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    # Only a range's first conversation can have begun in an earlier one: a row a range at most.
    offsets = (
        cells.select(F.col("conv_id").alias("_conv"), F.col("cell").alias("_cell"), F.sum("n").over(earlier).alias("_n"), F.sum("size").over(earlier).alias("_size"))
        .where("_n is not null")
    )
    joined = local.join(F.broadcast(offsets), F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("cell") == F.col("_cell")), "left")
    placed = joined.select(
        "conv_id", "said", "is_system", "is_target", "n_tokens",
        (F.col("position") + F.coalesce("_n", F.lit(0))).alias("position"),
        (F.col("before") + F.coalesce("_size", F.lit(0))).alias("before"),
    )
    return placed, local


def _windows_of(turns: list[dict], budget: Budget) -> Iterator[tuple]:
    """Windows of one block: its turns by position, those of kind 0 (system) and 1 (history) repeated."""
    turns = sorted(turns, key=lambda t: (t["position"], t["kind"]))
    head = None
    if turns[0]["position"] == 0 and turns[0]["is_system"] and turns[0]["n_tokens"] <= budget.system:
        head = turns[0]
    if turns[0]["kind"] == 0:
        turns = turns[1:]
    repeatable = 1 if head is not None and turns[0] is head else 0  # the system turn is no history
    upto = np.cumsum([0, *(t["n_tokens"] for t in turns)])
    new = next((i for i, t in enumerate(turns) if t["kind"] == 2), len(turns))
    while new < len(turns):
        kept = [head] if head is not None and turns[new] is not head else []
        room = budget.window - sum(t["n_tokens"] for t in kept)
        reach = min(budget.history, max(0, room - int(upto[new + 1] - upto[new])))
        first = max(int(np.searchsorted(upto, upto[new] - reach)), min(repeatable, new))
        stop = max(int(np.searchsorted(upto, upto[first] + room, "right")) - 1, new + 1)
        shown = kept + turns[first:stop]
        repeated = len(kept) + new - first
        text, loss, at = [], [], 0
        for i, turn in enumerate(shown):
            said = turn["said"]
            if i >= repeated and turn["is_target"]:
                loss.append({"start": at + HEADER.match(said).end(), "stop": at + len(said) - len(END)})
            text.append(said)
            at += len(said)
        size = sum(t["n_tokens"] for t in shown)
        yield turns[new]["position"], stop - new, repeated, size, "".join(text), loss
        new = stop


def chat_windows(conversations: DataFrame, tokenizer_json: str, budget: Budget = Budget()) -> DataFrame:
    """conv_id, block, window, first_turn (place of its first new turn), n_turns (new ones), n_repeated (turns
    at its front that stood in an earlier window), n_tokens, text, and loss: code-point spans of the new
    assistant texts, without their markers.

    Each turn is new in exactly one window, in order. A window holds the budget's tokens at most, unless a
    single new turn is larger: such a turn has a window of its own, without history. A system turn of
    more than `budget.system` tokens stands in the first window only. Tokens are those of turns encoded
    one by one. Turns are ordered by turn, null first, ties by a hash of role and text; repeated rows are each
    a turn. Null roles and texts are empty; rows without conv_id are one conversation; an empty table gives no
    windows; other columns are ignored. Long conversations are worked on in ranges and blocks, never whole.
    """
    placed, behind = _placed(_turns(conversations, tokenizer_json))
    turns = placed.withColumn("block", F.floor(F.col("before") / budget.block).cast("long"))
    fields = ["position", "kind", "n_tokens", "is_system", "is_target", "said"]
    kind = lambda k: F.lit(k).alias("kind")
    kept = F.col("is_system") & (F.col("position") == 0) & (F.col("n_tokens") <= budget.system)
    own = turns.select("conv_id", "block", *[kind(2) if f == "kind" else f for f in fields])
    history = turns.where((F.col("before") >= (F.col("block") + 1) * budget.block - budget.history) & ~kept)
    history = history.select("conv_id", (F.col("block") + 1).alias("block"), *[kind(1) if f == "kind" else f for f in fields])
    later = turns.where("block > 0").groupBy("conv_id", "block").agg(F.lit(1).alias("_later")).select(F.col("conv_id").alias("_conv"), "block")
    heads = turns.where(kept).select("conv_id", *[kind(0) if f == "kind" else f for f in fields])
    heads = heads.join(later, F.col("conv_id").eqNullSafe(F.col("_conv"))).select("conv_id", "block", *fields)
    blocks = own.unionByName(history).unionByName(heads).groupBy("conv_id", "block").agg(F.collect_list(F.struct(*fields)).alias("turns"))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in ("conv_id", "block", "window", "first_turn", "n_turns", "n_repeated", "n_tokens", "text", "loss")]
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.string()]
        types.append(pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])))
        for batch in batches:
            made, held = [], 0
            for i in range(batch.num_rows):
                conv, block = batch.column("conv_id")[i].as_py(), batch.column("block")[i].as_py()
                for nth, found in enumerate(_windows_of(batch.column("turns")[i].as_py(), budget)):
                    made.append((conv, block, nth, *found))
                    held += len(found[4])
                if made and (held > 1 << 22 or i == batch.num_rows - 1):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), types)], names)
                    made, held = [], 0

    windows = stored(blocks.mapInArrow(choose, WINDOW_SCHEMA))
    discard(behind)
    return windows


def digests(windows: DataFrame) -> DataFrame:
    """What the windows say, read back from their texts and masks: per conversation n_turns, turns_sha256,
    loss_chars, loss_sha256, formatted_chars. A conversation's windows stream through one task in order, as
    a digest of their concatenation must; one window is held at a time."""
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    ordered = windows.select("conv_id", "block", "window", "n_repeated", "text", "loss").repartition("conv_id").sortWithinPartitions("conv_id", "block", "window")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told() -> tuple:
            return conv, turns, said.hexdigest(), chars, learned.hexdigest(), shown

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            names = [c.split()[0] for c in schema.split(", ")]
            types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

        begun, conv = False, None
        for batch in batches:
            ended = []
            columns = (batch.column(c) for c in ("conv_id", "n_repeated", "text", "loss"))
            for own, repeated, text, loss in zip(*columns):
                own, text = own.as_py(), text.as_py()
                if not begun or own != conv:
                    if begun:
                        ended.append(told())
                    begun, conv, turns, chars, shown = True, own, 0, 0, 0
                    said, learned = hashlib.sha256(), hashlib.sha256()
                new = read_back(text)[repeated.as_py() :]
                turns += len(new)
                shown += len(text)
                for role, body, _ in new:
                    said.update(f"{role}\n{body}\n".encode())
                for span in loss.as_py():
                    body = unescaped(text[span["start"] : span["stop"]])
                    chars += len(body)
                    learned.update(body.encode())
            if ended:
                yield batch_of(ended)
        if begun:
            yield batch_of([told()])

    return ordered.mapInArrow(read, schema)
