"""Operator 5: chat formatting in budgeted windows.

A conversation's turns are rendered as

    <|im_start|>role\\n text <|im_end|>\\n        (no spaces)

and cut into turn-aligned windows by the prefix sums of the turns' tokens: a window takes new turns while their sum
fits into the budget that the retained system turn and the repeated history leave. Every window after the first
begins with the system turn and with up to `history` of the turns just before it, within `history_tokens`; these
are context only. The loss mask covers the text of every new assistant turn, so each target is learned once and
repeated targets are masked. A turn larger than the budget gets a window of its own, marked oversize; nothing is
truncated.

Escapes: inside a text a backslash is doubled and `<|` becomes `<\\|`, so no text can hold a control string and
unescape() gives the text back. In a role a newline becomes `\\n` too.

Execution: rows are dealt by conversation and sorted by turn, and a task streams through them holding one window,
so a conversation of any length needs bounded memory; a conversation's digest is a sequential hash and belongs to
one task by its nature.

Defined cases: null text or role is empty; turns with equal or null numbers come in the order of role and text, null
turn first; a null conv_id is a conversation; repeated rows are repeated turns; only a first turn with the role
`system` is retained; empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
#: Fixed value: the pre-tokenizer pattern of the byte-level vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"

WINDOWS = "conv_id long, window_no int, first_turn int, n_new int, n_history int, n_tokens int, oversize boolean, new_from int, formatted string, loss_spans array<struct<start:int,end:int>>"
DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
_TURN = re.compile(re.escape(START) + r"(.*?)\n(.*?)" + re.escape(END) + r"\n", re.S)


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\n")


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], role, flags=re.S)


@lru_cache(maxsize=2)
def encoder(ranks: bytes):
    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines()) if a}
    return tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})


class Turn:
    """A rendered turn: head, escaped text, tokens."""

    def __init__(self, role: str, text: str, count):
        self.head, self.body, self.target = f"{START}{escape_role(role)}\n", escape(text), role == "assistant"
        self.text = f"{self.head}{self.body}{END}\n"
        self.tokens = count(self.text)


def windows_of(conv, turns: Iterator[Turn], budget: int, history: int, history_tokens: int) -> Iterator[tuple]:
    """The windows of one conversation; holds one window and its history at a time."""
    system, number, first, past, new = None, 0, 0, [], []

    def emit() -> tuple:
        context = ([system] if system and number else []) + past
        parts, spans, at = [t.text for t in context], [], sum(len(t.text) for t in context)
        new_from = at
        for t in new:
            if t.target:
                spans.append({"start": at + len(t.head), "end": at + len(t.head) + len(t.body)})
            parts.append(t.text)
            at += len(t.text)
        tokens = sum(t.tokens for t in context + new)
        return conv, number, first, len(new), len(past), tokens, tokens > budget, new_from, "".join(parts), spans

    used = 0  # prefix sum of this window: context and new turns
    for n, turn in enumerate(turns):
        if n == 0 and turn.head == f"{START}system\n":
            system = turn
        if new and used + turn.tokens > budget:
            yield emit()
            number, first = number + 1, n
            room, kept = history_tokens, []
            for t in reversed([t for t in past + new if t is not system][-history:] if history else []):
                if t.tokens > room:
                    break
                room -= t.tokens
                kept.insert(0, t)
            fixed = system.tokens if system else 0
            while kept and fixed + sum(t.tokens for t in kept) + turn.tokens > budget:
                kept.pop(0)
            past, new = kept, []
            used = fixed + sum(t.tokens for t in past)
        new.append(turn)
        used += turn.tokens
    if new:
        yield emit()


def format_windows(conversations: DataFrame, budget: int = 1024, history: int = 2, history_tokens: int = 256, tokenizer: str = TOKENIZER) -> DataFrame:
    """conversations: conv_id, turn, role, text. tokenizer: a vocabulary file of at most a few MB, read here and shipped to the tasks."""
    with open(tokenizer, "rb") as f:
        ranks = conversations.sparkSession.sparkContext.broadcast(f.read())
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce(F.col("role"), F.lit("")).alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import itertools

        encode = encoder(ranks.value).encode_ordinary
        count = lambda text: len(encode(text))
        stream = ((c, r, t) for b in batches for c, r, t in zip(b.column("conv_id").to_pylist(), b.column("role").to_pylist(), b.column("text").to_pylist()))
        out, size = [], 0
        for conv, group in itertools.groupby(stream, key=lambda x: x[0]):
            for w in windows_of(conv, (Turn(r, t, count) for _, r, t in group), budget, history, history_tokens):
                out.append(w)
                size += len(w[8])
                if size > 4_000_000:
                    yield as_batch(out, WINDOWS_ARROW)
                    out, size = [], 0
        if out:
            yield as_batch(out, WINDOWS_ARROW)

    return dealt.mapInArrow(render, WINDOWS)


WINDOWS_ARROW = pa.schema([("conv_id", pa.int64()), ("window_no", pa.int32()), ("first_turn", pa.int32()), ("n_new", pa.int32()), ("n_history", pa.int32()), ("n_tokens", pa.int32()), ("oversize", pa.bool_()), ("new_from", pa.int32()), ("formatted", pa.string()), ("loss_spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])
DIGEST_ARROW = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def as_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def read_back(windows: DataFrame, written: bool = False) -> DataFrame:
    """The contract's columns, parsed from the formatted windows as format_windows() left them in their partitions; if they were written meanwhile, they are dealt and sorted anew."""
    if written:
        windows = windows.repartition("conv_id").sortWithinPartitions("conv_id", "window_no")

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import itertools

        names = ("conv_id", "new_from", "formatted", "loss_spans")
        stream = (row for b in batches for row in zip(*[b.column(c).to_pylist() for c in names]))
        out = []
        for conv, group in itertools.groupby(stream, key=lambda x: x[0]):
            turns, loss, n, chars, formatted = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
            for _, new_from, text, spans in group:
                formatted += len(text)
                for m in _TURN.finditer(text, new_from):
                    turns.update(f"{unescape_role(m[1])}\n{unescape(m[2])}\n".encode("utf-8", "surrogatepass"))
                    n += 1
                for s in spans:
                    target = unescape(text[s["start"] : s["end"]])
                    chars += len(target)
                    loss.update(target.encode("utf-8", "surrogatepass"))
            out.append((conv, n, turns.hexdigest(), chars, loss.hexdigest(), formatted))
            if len(out) == 10_000:
                yield as_batch(out, DIGEST_ARROW)
                out = []
        if out:
            yield as_batch(out, DIGEST_ARROW)

    return windows.mapInArrow(parse, DIGEST)
