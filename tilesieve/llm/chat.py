"""Chat formatting with loss masks aligned by offsets.

A conversation is rendered as a whole: every turn is ``<|im_start|>role``, a line end, the text,
``<|im_end|>`` and a line end.  The rendered string is encoded once, with offsets.  The spans of
the texts to learn from are sorted, as are the tokens' spans, so a binary search finds the tokens
of each; the mask keeps, per token, the characters inside the span, so it is exact even where a
token reaches over the edge of a text.

Control strings cannot occur inside a text or role: after ``<`` and any number of backslashes, a
``|`` gets one backslash more.  Unescaping takes it away again.

Turns are ordered by their number, ties by role and text; a null turn comes first, null role and
text count as empty, and rows without conversation id are one conversation.  Rows that repeat are
turns that repeat.  Other columns are ignored.  A conversation is one string and one task's work,
whatever its length: tasks hold one conversation, a bounded number of characters of shorter
ones and the batch that is being read.
"""

from __future__ import annotations

import hashlib
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import process_state, slices

# The control strings of the template.
START, END = "<|im_start|>", "<|im_end|>"
LEARN = "assistant"
# Characters of whole conversations after which a task sends them on.
BATCH_CHARS = 1 << 18

_OPEN, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    return _OPEN.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def _escape_role(role: str) -> str:
    return escape(role).replace("%", "%25").replace("\n", "%0A")


def _unescape_role(role: str) -> str:
    return unescape(role.replace("%0A", "\n").replace("%25", "%"))


def render(turns: list[tuple[str, str]], learn: str = LEARN) -> tuple[str, list[tuple[int, int]]]:
    """The formatted string, and the spans of the texts whose role is ``learn``."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{_escape_role(role)}\n", escape(text)
        if role == learn:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END, "\n"]
        at += len(head) + len(body) + len(END) + 1
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted string."""
    turns = []
    for part in formatted.split(START)[1:]:
        head, _, rest = part.partition("\n")
        turns.append((_unescape_role(head), unescape(rest[: rest.rindex(END)])))
    return turns


def aligned(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> list[np.ndarray]:
    """Columns (span, token, first, last character + 1) of every token inside each span, by binary search.

    Several tokens of one character (bytes of it) are all under the mask; the first has its character.
    """
    a, b = np.array(spans, np.int64).reshape(-1, 2).T
    first = np.searchsorted(ends, a, "right")
    n = np.searchsorted(starts, b, "left") - first
    span = np.repeat(np.arange(len(a)), n)
    token = np.arange(len(span)) + np.repeat(first - np.cumsum(n) + n, n)
    lo, hi = np.maximum(starts[token], a[span]), np.minimum(ends[token], b[span])
    # Spans are in order, so what was covered before is a running maximum.
    lo = np.maximum(lo, np.concatenate([[0], np.maximum.accumulate(hi)])[:-1])
    return [span, token, lo, np.maximum(lo, hi)]


def masked(formatted: str, span: np.ndarray, start: np.ndarray, end: np.ndarray) -> str:
    """All text under a loss mask, unescaped: the texts in order, nothing between."""
    held = np.flatnonzero(end > start)
    held = held[np.argsort(span[held], kind="stable")]
    span, start, end = span[held], start[held], end[held]
    opens = np.ones(len(held), bool)  # a run of characters of one text begins here
    opens[1:] = (span[1:] != span[:-1]) | (start[1:] != end[:-1])
    texts: dict[int, list[str]] = {}
    for k, a, b in zip(span[opens].tolist(), start[opens].tolist(), end[np.roll(opens, -1)].tolist()):
        texts.setdefault(k, []).append(formatted[a:b])
    return "".join(unescape("".join(parts)) for parts in texts.values())


def _ends(lengths: list[int]) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32())


def _tokenizer(path: str):
    held = process_state().setdefault("chat_tokenizers", {})
    if path not in held:
        from tokenizers import Tokenizer

        held[path] = Tokenizer.from_file(path)
        held[path].no_truncation()
        held[path].no_padding()
        held[path].encode_special_tokens = True  # the vocabulary's own control strings are text here
    return held[path]


def format_chats(turns: DataFrame, path: str, learn: str = LEARN, id_col: str = "conv_id") -> DataFrame:
    """(id, formatted, ids, loss) of every conversation of rows (id, turn, role, text).

    ``loss`` has a row (text, token, start, end) per token under the mask: which of the texts to
    learn from, the token's place in ``ids`` and its characters of ``formatted``.
    """
    kind = turns.schema[id_col].dataType.simpleString()
    names = ["text", "token", "start", "end"]

    def run(batches):
        library = _tokenizer(path)

        def made(held, id_type):
            ids, marks, texts = [], [], []
            for _, rows in held:
                formatted, spans = render(rows, learn)
                found = library.encode(formatted, add_special_tokens=False)
                ids.append(np.array(found.ids, np.int32))
                offsets = np.fromiter(chain.from_iterable(found.offsets), np.int64, 2 * len(ids[-1])).reshape(-1, 2)
                marks.append(aligned(offsets[:, 0], offsets[:, 1], spans))
                texts.append(formatted)
            loss = pa.StructArray.from_arrays([np.concatenate(c).astype(np.int32) for c in zip(*marks)], names)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([conversation for conversation, _ in held], id_type),
                    pa.array(texts, pa.string()),
                    pa.ListArray.from_arrays(_ends([len(i) for i in ids]), pa.array(np.concatenate(ids))),
                    pa.ListArray.from_arrays(_ends([len(m[0]) for m in marks]), loss),
                ],
                names=[id_col, "formatted", "ids", "loss"],
            )

        # Conversations that are complete but for the last, and the characters in them.
        held, size, id_type = [], 0, None
        for batch in slices(batches):
            id_type = batch.column(0).type
            for conversation, role, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if not held or conversation != held[-1][0]:
                    if size > BATCH_CHARS:
                        yield made(held, id_type)
                        held, size = [], 0
                    held.append((conversation, []))
                held[-1][1].append((role or "", text or ""))
                size += len(text or "")
        if held:
            yield made(held, id_type)

    schema = f"`{id_col}` {kind}, formatted string, ids array<int>, loss array<struct<text:int,token:int,start:int,end:int>>"
    ordered = turns.select(id_col, "role", "text", "turn").repartition(id_col)
    ordered = ordered.sortWithinPartitions(id_col, "turn", F.coalesce("role", F.lit("")), F.coalesce("text", F.lit("")))
    return ordered.select(id_col, "role", "text").mapInArrow(run, schema)


def read_back(formatted: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Digests of what the output says: (id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars)."""
    kind = formatted.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in slices(batches, 16):
            rows, loss = [], batch.column(2)
            span, start, end = (loss.flatten().field(n).to_numpy() for n in ("text", "start", "end"))
            at = (loss.offsets.to_numpy() - loss.offsets[0].as_py()).tolist()
            for text, i, j in zip(batch.column(1).to_pylist(), at, at[1:]):
                turns = parse(text)
                digest = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode("utf-8", "surrogatepass"))
                learnt = masked(text, span[i:j], start[i:j], end[i:j])
                rows.append((len(turns), digest.hexdigest(), len(learnt), hashlib.sha256(learnt.encode()).hexdigest(), len(text)))
            columns = list(zip(*rows))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, kinds))], names=names)

    names = [id_col, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    schema = f"`{id_col}` {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    return formatted.select(id_col, "formatted", "loss").mapInArrow(run, schema)
