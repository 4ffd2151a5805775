"""Removal of repeated byte passages by an enhanced suffix array and its common-prefix interval tree.

Suffixes that begin at equal anchors are sorted, a stack scan of the common prefixes of neighbours yields the intervals
of the tree, and in each interval the texts before the anchors are compared: where they differ the repeat ends to
the left, where they agree it goes on. So each interval gives maximal repeats with all their occurrences.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.repeats import covered, marked, repeated_spans
from tidemark.llm.words import _VALUES, buffer, slices

#: Bytes of a repeated string, and of an anchor.
LENGTH, WIDTH = 400, 32
#: Different contexts of one anchor (at most 800 bytes each) that are sorted together.
CROWD = 20_000


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    size = min(len(a), len(b))
    if a[:size] == b[:size]:
        return size
    low, high = 0, size
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


class Aligned:
    """Byte strings as numbers of one width: a common prefix is read off one exclusive or."""

    def __init__(self, strings: list[bytes]):
        self.width = max(map(len, strings))
        self.size = list(map(len, strings))
        self.number = [int.from_bytes(s.ljust(self.width, b"\0")) for s in strings]

    def common(self, i: int, j: int) -> int:
        """Length of the common prefix of strings i and j."""
        equal = self.width - (((self.number[i] ^ self.number[j]).bit_length() + 7) >> 3)
        return min(equal, self.size[i], self.size[j])

    def neighbours(self, order: list[int]) -> list[int]:
        return [self.common(i, j) for i, j in zip(order, order[1:], strict=False)]

    def reach(self, order: list[int]) -> dict[int, int]:
        """Of each string in a sorted order: its longest prefix that another one has."""
        shared = self.neighbours(order)
        return {i: max(before, after) for i, before, after in zip(order, [0, *shared], [*shared, 0], strict=True)}


Visit = Callable[[int, list[int], int], list[int]]


def scan(order: list[int], prefixes: list[int], visit: Visit) -> None:
    """Visit every interval of the tree, inner ones first, as (depth, members, depth of the interval around it).

    `prefixes` are those of sorted neighbours. Members that visit does not return are left out of the intervals around.
    """
    stack: list[tuple[int, list[int]]] = []
    for member, depth in zip(order, [*prefixes, -1], strict=True):
        members = [member]
        while stack and stack[-1][0] > depth:
            deep, inside = stack.pop()
            inside += members
            around = max(depth, stack[-1][0] if stack else -1)
            members = visit(deep, inside, around) if len(inside) > 1 else inside
        if stack and stack[-1][0] == depth:
            stack[-1][1].extend(members)
        elif depth >= 0:
            stack.append((depth, members))


def maximal_repeats(contexts: list[tuple[bytes, bytes, int]], length: int) -> list[list[tuple[int, int]]]:
    """Per context (before, after, copies): spans around the anchor, of `length` bytes or more, that another one shares.

    What a context shares with any other on each side bounds what it shares with one of them on both. By that bound, contexts are
    left out of the tree, and members out of the intervals around the last one that can give them a repeat.
    """
    found: list[list[tuple[int, int]]] = [[] for _ in contexts]
    before, after = [c[0][::-1] for c in contexts], [c[1] for c in contexts]
    left, right = Aligned(before), Aligned(after)
    backward, order = sorted(range(len(contexts)), key=before.__getitem__), sorted(range(len(contexts)), key=after.__getitem__)
    behind, ahead = left.reach(backward), right.reach(order)
    order = [i for i in order if behind[i] + ahead[i] >= length]
    rank = dict(zip(backward, range(len(backward)), strict=True))

    def visit(depth: int, members: list[int], around: int) -> list[int]:
        members.sort(key=rank.__getitem__)
        # Left extension: how far each member goes on like its closest one. Where that is no further than in an interval inside
        # this one, the repeat is part of the one found there.
        for member, extent in left.reach(members).items():
            own = found[member]
            if extent + depth >= length and not (own and own[-1][0] <= -extent):
                own.append((-extent, depth))
        return [m for m in members if behind[m] + around >= length]

    if order:
        scan(order, right.neighbours(order), visit)
    return found


def byte_units(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data, offsets = buffer(texts)
    return _VALUES[data], data, offsets


def remove_repeats(docs: DataFrame, length: int = LENGTH, width: int = WIDTH, output: str = "digests") -> DataFrame:
    """Take away every byte of a `length`-byte string that also starts elsewhere in docs. One row per row of docs: doc_id,
    n_bytes, n_removed, n_spans (maximal removed runs), and kept_sha256 or, with output="kept", the bytes kept.

    Texts are UTF-8; null is empty. Overlapping occurrences count, strings are judged on the input. Rows that repeat are
    copies of each other, null ids included; texts under `length` bytes stay whole; other columns are ignored.
    """
    docs = marked(docs.select("doc_id", "text"))
    spans = repeated_spans(docs, byte_units, maximal_repeats, length, width, "u1", CROWD)
    joined = docs.join(spans, docs["doc_id"].eqNullSafe(spans["doc_id"]) & (docs["mark"] == spans["mark"]), "left")
    last = ("kept", pa.binary(), "binary") if output == "kept" else ("kept_sha256", pa.string(), "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            data, offsets = buffer(batch.column("text"))
            rows = []
            for k, own in enumerate(batch.column("spans").to_pylist()):
                text = data[offsets[k] : offsets[k + 1]]
                gone = covered(own, len(text))
                rest = text[~gone].tobytes()
                runs = int(gone[:1].sum()) + int((gone[1:] & ~gone[:-1]).sum())
                rows.append((len(text), int(gone.sum()), runs, rest if output == "kept" else hashlib.sha256(rest).hexdigest()))
            kinds = (pa.int64(), pa.int64(), pa.int64(), last[1])
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=["doc_id", "n_bytes", "n_removed", "n_spans", last[0]])

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_removed long, n_spans long, {last[0]} {last[2]}"
    return joined.select(docs["doc_id"], docs["text"], F.col("spans")).mapInArrow(run, schema)
