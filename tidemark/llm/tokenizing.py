"""Ids of texts by a public tokenizer's vocabulary, word by word with a bounded memory of words seen.

Where every white space of a text is one space or one line feed between words, the split pattern of the byte-level
vocabularies starts a new match at each of them, so the ids of the text are those of its words.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from tokenizers import Tokenizer

from tidemark.llm.words import split_words

#: Words remembered by a worker; when full, the memory starts anew.
WORDS = 600_000

_kept: dict[tuple, object] = {}


def once(make: Callable, *arguments):
    """make(*arguments), kept for the later tasks of this worker."""
    key = (make.__qualname__, *arguments)
    if key not in _kept:
        _kept[key] = make(*arguments)
    return _kept[key]


def spread(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Indices start[0], start[0]+1, .. for length[0] of them, then those from start[1] on, and so forth."""
    ends = np.cumsum(length)
    return np.repeat(start - (ends - length), length) + np.arange(ends[-1] if len(ends) else 0)


def _unicode_space(data: np.ndarray) -> np.ndarray:
    """Positions of white space beyond one byte, and of control characters that some count as such."""
    lead = np.flatnonzero((data == 0xC2) | ((data >= 0xE1) & (data <= 0xE3)) | ((data >= 0x1C) & (data <= 0x1F)))
    byte = np.append(data, np.zeros(2, np.uint8))
    a, b, c = byte[lead], byte[lead + 1], byte[lead + 2]
    odd = (a < 0x20) | ((a == 0xC2) & ((b == 0x85) | (b == 0xA0))) | ((a == 0xE1) & (b == 0x9A) & (c == 0x80))
    odd |= (a == 0xE2) & (b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))
    odd |= ((a == 0xE2) & (b == 0x81) & (c == 0x9F)) | ((a == 0xE3) & (b == 0x80) & (c == 0x80))
    return lead[odd]


class Encoder:
    """Ids of whole texts from those of their words.

    `direct(text)` gives the ids of any text. `batch(text, before)` gives the ids of a text made of words, each after
    `before` (a space or line feed), and the index of the first id of each. Texts that hold one of `whole` are never cut.
    """

    def __init__(
        self,
        direct: Callable[[str], np.ndarray],
        batch: Callable[[str, str], tuple[np.ndarray, np.ndarray]],
        limit: int = WORDS,
        whole: tuple[str, ...] = (),
    ):
        self.direct, self.batch, self.limit = direct, batch, limit
        self.whole = re.compile(b"|".join(re.escape(x.encode()) for x in whole)) if whole else None
        self.known: dict[int, bytes] = {}

    def _learn(self, keys: list[int], texts: bytes, before: str, skip: int) -> None:
        if not keys:
            return
        ids, starts = self.batch(texts.decode(), before)
        raw, ends = ids.astype("<u4").tobytes(), [*starts[1:].tolist(), len(ids)]
        for key, a, b in zip(keys, starts.tolist(), ends, strict=True):
            self.known[key] = raw[4 * (a + skip) : 4 * b]

    def many(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and where those of each begin and the last end. Null is empty."""
        words = split_words(texts)
        data, offsets, n = words.data, words.offsets, len(words.offsets) - 1
        first = np.ones(len(words.text), bool)
        first[1:] = words.text[1:] != words.text[:-1]
        last = np.append(first[1:], True) if len(first) else first
        gap = words.start - np.where(first, offsets[words.text], np.append(0, words.end)[:-1])
        before = data[np.maximum(words.start - 1, 0)]
        kind = np.where(first, 0, np.where(before == 10, 2, 1))
        # In a plain text every white space is one space or one line feed between words.
        strange = np.where(first, gap != 0, (gap != 1) | ((before != 32) & (before != 10)))
        strange |= last & (words.end != offsets[words.text + 1])
        odd = (np.bincount(words.text, minlength=n) == 0) & (offsets[1:] > offsets[:-1])
        odd[words.text[strange]] = True
        odd[np.searchsorted(offsets, _unicode_space(data), side="right") - 1] = True
        if self.whole:
            spots = [m.start() for m in self.whole.finditer(data)]
            odd[np.searchsorted(offsets, np.array(spots, np.int64), side="right") - 1] = True
        plain = ~odd[words.text]
        start, end, kind = words.start[plain], words.end[plain], kind[plain]
        keys, at, where = np.unique(
            words.hashes(False)[plain] + kind.astype(np.uint64), return_index=True, return_inverse=True
        )
        if len(self.known) + len(keys) > self.limit:
            self.known.clear()
        listed = keys.tolist()
        new = np.array([key not in self.known for key in listed], bool)
        for which in (0, 1, 2):
            chosen = np.flatnonzero(new & (kind[at] == which))
            low, high = start[at[chosen]], end[at[chosen]]
            named = keys[chosen].tolist()
            if which:
                self._learn(named, data[spread(low - 1, high - low + 1)].tobytes(), " \n"[which - 1], 0)
            else:
                pieces = b"".join(b"\n" + data[a:b].tobytes() for a, b in zip(low.tolist(), high.tolist(), strict=True))
                self._learn(named, pieces, "\n", 1)
        parts = [self.known[key] for key in listed]
        sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        store = np.frombuffer(b"".join(parts), "<u4")
        length = sizes[where]
        ids = store[spread((np.cumsum(sizes) - sizes)[where], length)]
        counts = np.bincount(words.text[plain], weights=length, minlength=n).astype(np.int64)
        bounds = np.append(0, np.cumsum(counts))
        if not odd.any():
            return ids, bounds
        runs, done = [], 0
        for k in np.flatnonzero(odd).tolist():
            own = self.direct(data[offsets[k] : offsets[k + 1]].tobytes().decode())
            runs += [ids[done : bounds[k]], own]
            done, counts[k] = bounds[k], len(own)
        return np.concatenate([*runs, ids[done:]]).astype("<u4"), np.append(0, np.cumsum(counts))


def ranks_of_json(path: str) -> dict[bytes, int]:
    """Ranks by token bytes of a byte-level vocabulary file whose ids follow its merges."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in shown}
    letters |= {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in shown)}
    ranks = {bytes(letters[c] for c in token): id_ for token, id_ in model["vocab"].items()}
    pairs = (tuple(x.split(" ")) if isinstance(x, str) else tuple(x) for x in model["merges"])
    made = [model["vocab"][a + b] for a, b in pairs]
    if made != sorted(made):
        raise ValueError("the ids of this vocabulary do not follow its merges")
    return ranks


def added_tokens(path: str) -> tuple[str, ...]:
    """Strings that the library of a vocabulary file takes out of a text before it is split."""
    with open(path, encoding="utf-8") as file:
        return tuple(t["content"] for t in json.load(file).get("added_tokens") or [] if t["content"])


def library_encoder(path: str) -> Encoder:
    """Encoder over the vocabulary of a tokenizers file; texts with an added token are encoded by its own library."""
    ranks, added, own = ranks_of_json(path), added_tokens(path), Tokenizer.from_file(path)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    opens = np.zeros(max(ranks.values()) + 1, bool)
    opens[[rank for token, rank in ranks.items() if token[:1] == b" "]] = True
    newline = ranks[b"\n"]

    def direct(text: str) -> np.ndarray:
        if any(token in text for token in added):
            return np.array(own.encode(text, add_special_tokens=False).ids, "<u4")
        return np.array(library.encode_ordinary(text), "<u4")

    def batch(text: str, before: str) -> tuple[np.ndarray, np.ndarray]:
        ids = np.array(library.encode_ordinary(text), "<u4")
        return ids, np.flatnonzero(opens[ids] if before == " " else ids == newline)

    return Encoder(direct, batch, whole=added)
