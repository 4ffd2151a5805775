"""Chat formatting with offset-aligned loss masks.

A conversation is rendered in turn order, `### <role>: <text></turn>` and a line feed per turn, encoded once with offsets, and the
sorted spans of the texts are intersected with the sorted token spans by binary search. A backslash before each
backslash, `#`, `<` (in roles also `:`) of what is said keeps the marks out of it and can be taken back.

Rows stream through sorted partitions. Conversations of ordinary length are encoded whole; a longer one goes on in blocks
of whole turns, cut behind a line feed before `###`, where the vocabulary's split pattern starts a new match anyway: ids and
offsets are those of the whole, and memory is bounded by a block and a turn.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from tidemark.functions.shipping import ship_package
from tidemark.llm.tokenizing import once

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
#: Characters after which a conversation goes on in a new block.
BLOCK = 1 << 19
#: Role whose texts are learned.
LEARNED = "assistant"

_HEAD, _MID, _TAIL = "### ", ": ", "</turn>\n"


def escaped(text: str, role: bool = False) -> str:
    return re.sub(r"[\\#<:]" if role else r"[\\#<]", r"\\\g<0>", text)


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int, bool]]]:
    """The rendered block and, sorted, the span of each turn's escaped text and whether it is learned."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = _HEAD + escaped(role, True) + _MID, escaped(text)
        spans.append((at + len(head), at + len(head) + len(body), role == LEARNED))
        parts += [head, body, _TAIL]
        at += len(head) + len(body) + len(_TAIL)
    return "".join(parts), spans


#: A turn: a role up to the first colon that is not escaped, a text up to the first mark that is not.
_TURN = re.compile(r"### ([^\\:]*+(?:\\.[^\\:]*+)*+): ([^\\<]*+(?:\\.[^\\<]*+)*+)</turn>\n", re.DOTALL)


def parse(rendered: str) -> list[tuple[str, str]]:
    """Role and text of each turn, read back from a rendered block."""
    out, at = [], 0
    while at < len(rendered):
        turn = _TURN.match(rendered, at)
        if turn is None:
            raise ValueError(f"no turn at character {at} of a rendered block")
        out.append((unescaped(turn[1]), unescaped(turn[2])))
        at = turn.end()
    return out


def loss_mask(offsets: np.ndarray, spans: list[tuple[int, int, bool]]) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Which tokens touch a learned span, and the characters of learned spans that those tokens cover."""
    starts, ends = offsets[:, 0], offsets[:, 1]
    mask, covered = np.zeros(len(offsets), bool), []
    for low, high, learned in spans:
        if not learned or low == high:
            continue
        first = int(np.searchsorted(ends, low, side="right"))
        last = int(np.searchsorted(starts, high, side="left"))
        mask[first:last] = True
        if first < last:
            covered.append((max(low, int(starts[first])), min(high, int(ends[last - 1]))))
    return mask, covered


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, str, str]]:
    for batch in batches:
        rows = (batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))
        for conv, role, text in zip(*rows, strict=True):
            yield conv, role or "", text or ""


def _blocks(turns: Iterator[tuple[object, str, str]], block: int) -> Iterator[tuple[object, bool, list[tuple[str, str]]]]:
    """conv_id, whether the conversation ends here, and turns; blocks of one conversation follow one another."""
    own, size, held = None, 0, []
    for conv, role, text in turns:
        if held and (conv != own or size > block):
            yield own, conv != own, held
            held, size = [], 0
        own = conv
        held.append((role, text))
        size += len(role) + len(text)
    if held:
        yield own, True, held


def _sorted(turns: DataFrame) -> DataFrame:
    columns = ["conv_id", "turn", "role", "text"]
    return turns.select(*columns).repartition("conv_id").sortWithinPartitions(*columns)


_KINDS = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}


def _tokenizer(path: str) -> Tokenizer:
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer


def format_conversations(turns: DataFrame, path: str = VOCABULARY, block: int = BLOCK) -> DataFrame:
    """One row per block of a conversation: conv_id, block, formatted, ids, loss (a flag per id), learned (array of
    [start, end) of `formatted` under the mask).

    Turns are taken in the order of turn, then role, then text; nulls first. A null role or text counts as empty. Rows that
    repeat are turns of their own; rows without a conv_id are one conversation; other columns are ignored; no rows give none.
    """
    ship_package()
    name = turns.schema["conv_id"].dataType.simpleString()
    span = pa.struct({"start": pa.int64(), "end": pa.int64()})
    arrow = pa.schema(
        {
            "conv_id": _KINDS[name], "block": pa.int64(), "formatted": pa.string(), "ids": pa.list_(pa.int32()),
            "loss": pa.list_(pa.bool_()), "learned": pa.list_(span),
        }
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, number, rows, size = once(_tokenizer, path), 0, [], 0
        for conv, last, held in _blocks(_turns(batches), block):
            rendered, spans = render(held)
            encoding = tokenizer.encode(rendered, add_special_tokens=False)
            mask, covered = loss_mask(np.array(encoding.offsets, np.int64).reshape(-1, 2), spans)
            rows.append((conv, number, rendered, encoding.ids, mask, [{"start": a, "end": b} for a, b in covered]))
            number, size = (0 if last else number + 1), size + len(rendered)
            if size > block:
                yield _record(rows, arrow)
                rows, size = [], 0
        if rows:
            yield _record(rows, arrow)

    schema = (
        f"conv_id {name}, block long, formatted string, ids array<int>, loss array<boolean>,"
        " learned array<struct<start: long, end: long>>"
    )
    return _sorted(turns).mapInArrow(run, schema)


def _record(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation, read back from format_conversations: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars. Blocks of a conversation stand together there, so no shuffle is needed."""
    name = formatted.schema["conv_id"].dataType.simpleString()
    arrow = pa.schema(
        {
            "conv_id": _KINDS[name], "n_turns": pa.int64(), "turns_sha256": pa.string(), "loss_chars": pa.int64(),
            "loss_sha256": pa.string(), "formatted_chars": pa.int64(),
        }
    )

    def ended(rows: list[list]) -> pa.RecordBatch:
        return _record([(c, n, a.hexdigest(), k, b.hexdigest(), m) for c, n, a, k, b, m in rows], arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[list] = []
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "block", "formatted", "learned"))
            for conv, number, rendered, spans in zip(*columns, strict=True):
                if number == 0:
                    rows.append([conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0])
                row, said = rows[-1], parse(rendered)
                row[1] += len(said)
                row[5] += len(rendered)
                for role, text in said:
                    row[2].update(f"{role}\n{text}\n".encode())
                for span in spans:
                    text = unescaped(rendered[span["start"] : span["end"]])
                    row[3] += len(text)
                    row[4].update(text.encode())
            if len(rows) > 1:
                yield ended(rows[:-1])
                rows = rows[-1:]
        if rows:
            yield ended(rows)

    schema = (
        f"conv_id {name}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
    return formatted.select("conv_id", "block", "formatted", "learned").mapInArrow(run, schema)
