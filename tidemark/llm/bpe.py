"""Byte-level BPE: a lazily determinised transducer for encoding, an incremental UTF-8 state machine for decoding.

Encoding rests on two facts of rank-ordered merging. The encoding of a prefix is the encoding of a shorter prefix and one
last token; and a sequence of tokens is an encoding if each neighbouring pair, alone, is encoded as that pair. So the
transducer keeps, for every position at which a later token may still begin, the last token before it. Tokens common to
all these positions are emitted; the rest waits, at most for the longest token. Equal situations are one state, made, with its
transitions, when met for the second time.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tidemark.functions.shipping import ship_package
from tidemark.llm.tokenizing import Encoder, once, spread
from tidemark.llm.words import slices

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
#: States and compared token pairs kept by a worker; when full, they are made anew.
STATES, PAIRS = 120_000, 400_000


class State(dict):
    """Transitions by byte: (next state, tokens emitted).

    nodes: (distance back from here, token that ends there, index of the node before), root first. The root's token is
    emitted already; it is None at the start of the text. live: nodes at which a token may still begin, farthest first.
    """

    __slots__ = ("live", "missed", "nodes", "tail")


class Transducer:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.prefixes = {token[:n] for token in ranks for n in range(1, len(token))}
        self.pairs: dict[int, bool] = {}
        self.whole: dict[int, bool] = {}
        self.edges: dict[tuple[int, bool], list | None] = {}
        self.forget()

    def forget(self) -> None:
        self.states: dict[tuple, State] = {}
        self.start = self.state(((0, None, -1),), (0,), b"")

    def state(self, nodes: tuple, live: tuple, tail: bytes) -> State:
        key = (nodes, live, tail)
        found = self.states.get(key)
        if found is None:
            found = self.states[key] = State()
            found.nodes, found.live, found.tail, found.missed = nodes, live, tail, b""
        return found

    def merged(self, text: bytes, least_parts: int = 1) -> list[int]:
        """The definition: merge the neighbours of least rank, leftmost first, until none can be."""
        parts = [text[i : i + 1] for i in range(len(text))]
        while len(parts) > least_parts:
            ranks = [self.ranks.get(a + b, 1 << 60) for a, b in zip(parts, parts[1:], strict=False)]
            least = min(ranks)
            if least == 1 << 60:
                break
            at = ranks.index(least)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def edge(self, token: int, right: bool) -> list[tuple[bytes, int]] | None:
        """Pieces at one edge of a token while it is merged, each with the rank that ends it; None if ranks do not grow."""
        key = (token, right)
        if key not in self.edges:
            out, piece, until = [], self.tokens[token], 1 << 60
            while True:
                out.append((piece, until))
                if len(piece) == 1:
                    break
                until = self.ranks[piece]
                parts = self.merged(piece, 2)
                if len(parts) != 2 or max(parts) >= until:
                    out = None
                    break
                piece = self.tokens[parts[-1 if right else 0]]
            self.edges[key] = out
        return self.edges[key]

    def follows(self, left: int | None, token: int) -> bool:
        """Whether `token` stays a token after `left`, or at the start of the text.

        After `left` it does unless, some time while both are merged, the pieces at their common edge are a token of a
        rank that comes before those that end these pieces.
        """
        if left is None:
            if token not in self.whole:
                self.whole[token] = self.merged(self.tokens[token]) == [token]
            return self.whole[token]
        pair = (left << 32) | token
        fits = self.pairs.get(pair)
        if fits is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            fits = self.pairs[pair] = self._apart(left, token)
        return fits

    def _apart(self, left: int, token: int) -> bool:
        before, after, ranks = self.edge(left, True), self.edge(token, False), self.ranks
        if before is None or after is None:
            return self.merged(self.tokens[left] + self.tokens[token]) == [left, token]
        for x, x_ends in before:
            for y, y_ends in after:
                rank = ranks.get(x + y)
                if rank is not None and rank < x_ends and rank <= y_ends:
                    return False
        return True

    def step(self, state: State, byte: int) -> tuple[State, tuple[int, ...]]:
        nodes, tail, ranks, prefixes = state.nodes, state.tail + bytes((byte,)), self.ranks, self.prefixes
        size = len(tail)
        for at in state.live:
            token = ranks.get(tail[size - 1 - nodes[at][0] :])
            if token is not None and self.follows(nodes[at][1], token):
                break
        else:
            raise ValueError("the vocabulary lacks a byte")
        end = len(nodes)
        live = [n for n in state.live if tail[size - 1 - nodes[n][0] :] in prefixes]
        live.append(end)
        parents = [node[2] for node in nodes]
        parents.append(at)
        # Tokens before all live nodes are settled: their deepest common node becomes the root.
        heirs = [0] * (end + 1)
        for n in live:
            heirs[n] = 1
        for n in range(end, 0, -1):
            heirs[parents[n]] += heirs[n]
        root = end
        while heirs[root] < len(live):
            root = parents[root]
        emitted, n = [], root
        while n > 0:
            emitted.append(nodes[n][1] if n < end else token)
            n = parents[n]
        index, kept = {}, []
        for n in range(root, end + 1):
            if not heirs[n]:
                continue
            index[n] = len(kept)
            if n == root:
                if n in live:
                    kept.append((nodes[n][0] + 1, nodes[n][1], -1) if n < end else (0, token, -1))
                else:
                    kept.append((-1, -1, -1))
            else:
                kept.append((nodes[n][0] + 1, nodes[n][1], index[parents[n]]) if n < end else (0, token, index[at]))
        longest = kept[index[live[0]]][0]
        made = self.state(tuple(kept), tuple([index[n] for n in live]), tail[size - longest :] if longest else b"")
        hop = state[byte] = (made, tuple(emitted[::-1]))
        return hop

    def encode(self, text: bytes) -> list[int]:
        """Tokens of a text. A move missing for the second time is added; for the first, the rest is worked out alone."""
        if len(self.states) > STATES:
            self.forget()
        state, out = self.start, []
        for i, byte in enumerate(text):
            hop = state.get(byte)
            if hop is None:
                if byte not in state.missed:
                    state.missed += bytes((byte,))
                    return out + self._alone(state, text, i)
                hop = self.step(state, byte)
            if hop[1]:
                out.extend(hop[1])
            state = hop[0]
        rest, n = [], len(state.nodes) - 1
        while n > 0:
            rest.append(state.nodes[n][1])
            n = state.nodes[n][2]
        return out + rest[::-1]

    def _alone(self, state: State, text: bytes, i: int) -> list[int]:
        """Tokens after the root of `state`, which has read text[:i]: the same moves without states."""
        ranks, prefixes, pairs, follows = self.ranks, self.prefixes, self.pairs, self.follows
        at = [i - back for back, _, _ in state.nodes]
        ends = [end for _, end, _ in state.nodes]
        befores = [before for _, _, before in state.nodes]
        live = state.live
        for k in range(i + 1, len(text) + 1):
            for n in live:
                token = ranks.get(text[at[n] : k])
                if token is not None:
                    left = ends[n]
                    fits = pairs.get((left << 32) | token) if left is not None else None
                    if fits or (fits is None and follows(left, token)):
                        break
            else:
                raise ValueError("the vocabulary lacks a byte")
            live = [m for m in live if text[at[m] : k] in prefixes]
            live.append(len(at))
            at.append(k)
            ends.append(token)
            befores.append(n)
        rest, n = [], len(at) - 1
        while n > 0:
            rest.append(ends[n])
            n = befores[n]
        return rest[::-1]


class Utf8:
    """Incremental UTF-8: the state is the bytes of an unfinished character; what cannot be one becomes U+FFFD."""

    def __init__(self):
        self.pending = b""

    @staticmethod
    def unfinished(data: bytes) -> int:
        """Bytes at the end that begin a character and lack its end."""
        for size in range(1, min(3, len(data)) + 1):
            lead = data[-size]
            if lead & 0xC0 != 0x80:
                room = 2 if 0xC2 <= lead < 0xE0 else 3 if 0xE0 <= lead < 0xF0 else 4 if 0xF0 <= lead < 0xF5 else 1
                low = {0xE0: 0xA0, 0xF0: 0x90}.get(lead, 0x80)
                high = {0xED: 0xA0, 0xF4: 0x90}.get(lead, 0xC0)
                return size if size < room and (size == 1 or low <= data[1 - size] < high) else 0
        return 0

    def feed(self, data: bytes) -> str:
        data = self.pending + data
        at = len(data) - self.unfinished(data)
        self.pending = data[at:]
        return data[:at].decode("utf-8", "replace")

    def close(self) -> str:
        rest, self.pending = self.pending.decode("utf-8", "replace"), b""
        return rest


class Decoder:
    """Text of ids as they arrive, in chunks of any size."""

    def __init__(self, tokens: dict[int, bytes]):
        ordered = [tokens.get(i, b"") for i in range(max(tokens) + 1)]
        self.bytes = np.frombuffer(b"".join(ordered), np.uint8)
        self.size = np.array([len(t) for t in ordered])
        self.at = np.cumsum(self.size) - self.size

    def stream(self, chunks: Iterable[np.ndarray]) -> Iterator[str]:
        machine = Utf8()
        for ids in chunks:
            yield machine.feed(self.bytes[spread(self.at[ids], self.size[ids])].tobytes())
        yield machine.close()

    def text(self, ids: np.ndarray, chunk: int = 1 << 16) -> str:
        return "".join(self.stream(ids[i : i + chunk] for i in range(0, len(ids), chunk)))


def ranks_of(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class Codec:
    """Encoder and decoder of a rank file; each match of the pattern is encoded alone."""

    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN):
        self.transducer = Transducer(ranks_of(path))
        self.decoder = Decoder(self.transducer.tokens)
        self.split = regex.compile(pattern).findall
        self.encoder = Encoder(self._direct, self._batch)

    def _ids(self, match: str) -> list[int]:
        raw = match.encode()
        whole = self.transducer.ranks.get(raw)  # a match that is a token is that token
        return self.transducer.encode(raw) if whole is None else [whole]

    def _direct(self, text: str) -> np.ndarray:
        return np.array([id_ for match in self.split(text) for id_ in self._ids(match)], "<u4")

    def _batch(self, text: str, before: str) -> tuple[np.ndarray, np.ndarray]:
        out: list[int] = []
        starts = []
        for match in self.split(text):
            if match[0] == before:
                starts.append(len(out))
            out += self._ids(match)
        return np.array(out, "<u4"), np.array(starts)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        return self.encoder.many(texts)

    def decode(self, ids: np.ndarray) -> str:
        return self.decoder.text(ids)


def codec_rows(docs: DataFrame, path: str = VOCABULARY, output: str = "digests") -> DataFrame:
    """Encode every text, decode the ids again. One row per row of docs: doc_id, n_tokens, and
    output="digests": ids_sha256, decoded_sha256; output="ids": ids (binary, little-endian unsigned 32 bits), decoded.

    A null text counts as empty: no tokens. Rows are handled one by one, so repeated and null ids and very long
    texts are like any other; columns other than doc_id and text are ignored.
    """
    ship_package()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = once(Codec, path)
        for batch in slices(batches, "text", 2 << 20):
            flat, bounds = codec.encode(batch.column("text"))
            counts, first, second = np.diff(bounds), [], []
            for ids in np.split(flat, bounds[1:-1]):
                decoded = codec.decode(ids)
                first.append(ids.tobytes() if output == "ids" else hashlib.sha256(ids.tobytes()).hexdigest())
                second.append(decoded if output == "ids" else hashlib.sha256(decoded.encode()).hexdigest())
            kind = pa.binary() if output == "ids" else pa.string()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(first, kind), pa.array(second, pa.string())],
                names=["doc_id", "n_tokens", *names],
            )

    names = ["ids", "decoded"] if output == "ids" else ["ids_sha256", "decoded_sha256"]
    kinds = f"{names[0]} {'binary' if output == 'ids' else 'string'}, {names[1]} string"
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long, {kinds}"
    return docs.select("doc_id", "text").mapInArrow(run, schema)
