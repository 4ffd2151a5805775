"""Removal of repeated word passages by suffix automata of reference shards.

A shard is what surrounds one anchor: its different contexts are bounded in number, so its automaton is bounded in size. Each
context streams through the automaton for matching statistics, the longest string ending at each word that occurs
elsewhere; where that reaches the length, the words go. Shards grow in number with the corpus, so they are not broadcast to every
task: they go, by a shuffle on the anchor, to the passages that can match them, and to no others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.repeats import covered, marked, repeated_spans
from tidemark.llm.suffixes import common
from tidemark.llm.words import slices, split_words

#: Words of a repeated window, and of an anchor.
LENGTH, WIDTH = 35, 6
_ANCHOR = -1


class SuffixAutomaton:
    """Of several strings; `weight` of a state is the number of occurrences of its strings, by the weights given."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.weight = [-1], [0], [0]

    def _state(self, length: int, moves: dict[int, int], link: int) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        self.weight.append(0)
        return len(self.next) - 1

    def _clone(self, p: int, symbol: int, q: int) -> int:
        copy = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(symbol) == q:
            self.next[p][symbol] = copy
            p = self.link[p]
        return copy

    def extend(self, last: int, symbol: int) -> int:
        """The state of the string of `last` and one symbol more."""
        q = self.next[last].get(symbol)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._clone(last, symbol, q)
        new, p = self._state(self.length[last] + 1, {}, 0), last
        while p >= 0 and symbol not in self.next[p]:
            self.next[p][symbol] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][symbol]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._clone(p, symbol, q)
        return new

    def add(self, string: list[int], weight: int) -> None:
        state = 0
        for symbol in string:
            state = self.extend(state, symbol)
            self.weight[state] += weight

    def close(self) -> None:
        """Sum the weights up along the suffix links, longest first."""
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            if self.link[state] > 0:
                self.weight[self.link[state]] += self.weight[state]

    def statistics(self, string: list[int]) -> Iterator[int]:
        """At each symbol of a string that was added: the longest string ending there that occurs twice or more."""
        state = 0
        for symbol in string:
            state = self.next[state][symbol]
            repeated = state
            while repeated > 0 and self.weight[repeated] < 2:
                repeated = self.link[repeated]
            yield self.length[repeated]


def matching_spans(contexts: list[tuple[bytes, bytes, int]], length: int) -> list[list[tuple[int, int]]]:
    """Per context (before, after, copies; words as 64-bit hashes): spans around the anchor that another one shares.

    Words that no other context has at that distance from the anchor are left out first; contexts that are then equal are one. The
    anchor's place is a symbol of its own, so that a string never matches another part of the same stretch of text.
    """
    shared = [[0, 0] for _ in contexts]
    for side in (0, 1):
        texts = [c[1] if side else np.frombuffer(c[0], np.uint64)[::-1].tobytes() for c in contexts]
        order = sorted(range(len(texts)), key=texts.__getitem__)
        for i, j in zip(order, order[1:], strict=False):
            same = common(texts[i], texts[j]) // 8
            shared[i][side], shared[j][side] = max(shared[i][side], same), max(shared[j][side], same)
    strings: dict[tuple[bytes, bytes], int] = {}
    names = []
    for (before, after, copies), (left, right) in zip(contexts, shared, strict=True):
        if left + right < length:
            names.append(None)
            continue
        name = (before[len(before) - 8 * left :], after[: 8 * right])
        names.append(name)
        strings[name] = strings.get(name, 0) + copies
    automaton = SuffixAutomaton()
    symbols = {}
    for name, weight in strings.items():
        before, after = (np.frombuffer(x, np.uint64).tolist() for x in name)
        symbols[name] = [*before, _ANCHOR, *after]
        automaton.add(symbols[name], weight)
    automaton.close()
    spans = {}
    for name, string in symbols.items():
        mark, own, low_before = len(name[0]) // 8, [], None
        for end, size in enumerate(automaton.statistics(string)):
            low = end - size + 1
            if end > mark and low <= mark and size - 1 >= length:
                if own and own[-1][0] == low - mark:
                    own[-1] = (low - mark, end - mark)
                else:
                    own.append((low - mark, end - mark))
        spans[name] = own
    return [spans[name] if name else [] for name in names]


def word_units(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    words = split_words(texts)
    hashes = words.hashes(False)
    return hashes, hashes, words.bounds()


def remove_repeats(docs: DataFrame, length: int = LENGTH, width: int = WIDTH, output: str = "digests") -> DataFrame:
    """Take away every word of a window of `length` words that also starts elsewhere in docs. One row per row of docs:
    doc_id, n_words, n_removed, and kept_sha256 or, with output="kept", the text of the words kept, one space between (the text
    as it was where nothing is removed); its other columns then come along as `others`.

    A null text counts as empty. Overlapping occurrences count, windows are judged on the input; words are compared by
    64-bit hashes. Rows that repeat are copies of each other, null ids included; texts under `length` words stay whole.
    """
    rest = [c for c in docs.columns if c not in ("doc_id", "text")] if output == "kept" else []
    # Other columns keep out of the way of names used here.
    docs = marked(docs.select("doc_id", "text", *(F.struct(*rest).alias("others") for _ in rest[:1])))
    narrow = docs.select("doc_id", "text", "mark")
    spans = repeated_spans(narrow, word_units, matching_spans, length, width, "<u8")
    joined = docs.join(spans, docs["doc_id"].eqNullSafe(spans["doc_id"]) & (docs["mark"] == spans["mark"]), "left")
    last = "kept" if output == "kept" else "kept_sha256"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = split_words(batch.column("text"))
            raw, bounds = words.data.tobytes(), words.bounds().tolist()
            start, end, offsets = words.start.tolist(), words.end.tolist(), words.offsets.tolist()
            rows = []
            for k, own in enumerate(batch.column("spans").to_pylist()):
                low, high = bounds[k], bounds[k + 1]
                stay = ~covered(own, high - low)
                kept = b" ".join([raw[start[i] : end[i]] for i in (np.flatnonzero(stay) + low).tolist()])
                if output == "kept":
                    kept = raw[offsets[k] : offsets[k + 1]].decode() if stay.all() else kept.decode()
                else:
                    kept = hashlib.sha256(kept).hexdigest()
                rows.append((high - low, int((~stay).sum()), kept))
            kinds = (pa.int64(), pa.int64(), pa.string())
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
            more = [batch.column("others")] if rest else []
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns, *more], names=["doc_id", "n_words", "n_removed", last, *["others"] * len(more)]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    more = f", others {docs.schema['others'].dataType.simpleString()}" if rest else ""
    schema = f"doc_id {kind}, n_words long, n_removed long, {last} string{more}"
    columns = [docs["doc_id"], docs["text"], F.col("spans"), *([docs["others"]] if rest else [])]
    return joined.select(*columns).mapInArrow(run, schema)
