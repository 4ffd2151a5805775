"""Two tokenizers' ids of the same texts side by side, and in how many documents each pair of ids goes together.

Inverted pair bitmaps: tasks read documents in blocks and write, for each block and each pair of ids linked in it, a compressed
bitmap of the documents that hold the pair, with planes of bits for how often each does. Blocks have no document in
common, so the bitmap of a pair is that of its blocks one after another, and its popcount the sum of theirs. Every
block's bitmaps then get the counts of their pairs, and their postings hand them back to the documents as scores. A
block is bounded in documents and bytes, so that a pair, however common, has one row per block, and no task holds more than one block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemark.functions.shipping import ship_package
from tidemark.llm.staging import written
from tidemark.llm.tokenizing import once, ranks_of_json, spread
from tidemark.llm.words import buffer, slices

A_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
B_VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
#: A block ends after the slice of rows that takes it to one of these; slices have 20,000 rows at most.
BLOCK_DOCS, BLOCK_BYTES = 1 << 15, 12 << 20
#: Characters after which a text is cut for encoding, at the next place where no token of either vocabulary reaches across.
PART = 1 << 17

_COMMA, _BAR, _SEMICOLON = b",|;"


class Vocabulary:
    """Encodes lists of texts, a space before each; knows the bytes that each id stands for."""

    def __init__(self, tokens: list[bytes]):
        self.size = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.start = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def spelled(self, ids: np.ndarray) -> np.ndarray:
        return self.bytes[spread(self.start[ids], self.size[ids])]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and how many each has."""
        raise NotImplementedError


class ByteVocabulary(Vocabulary):
    """A byte-level vocabulary file; strings of special tokens are plain text."""

    def __init__(self, path: str):
        ranks = ranks_of_json(path)
        self.library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        super().__init__(tokens)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [self.library.encode_ordinary(f" {text}") for text in texts]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.int64, int(counts.sum())), counts


class PieceVocabulary(Vocabulary):
    """A piece model that puts a space before the text itself and spells unknown characters in bytes."""

    def __init__(self, path: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        tokens = []
        for i in range(self.library.vocab_size()):
            piece = self.library.id_to_piece(i)
            plain = piece.replace("▁", " ").encode()
            tokens.append(bytes([int(piece[3:5], 16)]) if self.library.is_byte(i) else b"" if self.library.is_control(i) else plain)
        super().__init__(tokens)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = self.library.encode(texts, num_threads=1)
        counts = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.int64, int(counts.sum())), counts


class Decimals:
    """Decimal numbers as bytes, each with room for one more behind it."""

    def __init__(self, n: int):
        texts = [f"{i},".encode() for i in range(n)]
        self.size = np.fromiter(map(len, texts), np.int64, n)
        self.start = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(texts), np.uint8)


def parts(text: str, limit: int = PART) -> list[str]:
    """The text without the spaces it is cut at: each stands after a character that is no white space.

    Both tokenizers begin a token there: pieces hold spaces only at their beginning, and the pattern of byte-level vocabularies
    matches white space only before what it belongs to.
    """
    out, low = [], 0
    while len(text) - low > limit:
        cut = text.find(" ", low + limit)
        while cut > 0 and (text[cut - 1].isspace() or text[cut - 1] == "▁"):
            cut = text.find(" ", cut + 1)
        if cut < 0 or cut == len(text) - 1:  # no part is empty: pieces have no space before one
            break
        out.append(text[low:cut])
        low = cut + 1
    return [*out, text[low:]]


def _between(total: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of the values between each two bounds."""
    return np.diff(np.append(0, np.cumsum(total))[bounds])


class Aligned:
    """The tokens of some texts by both vocabularies, cut where both end one.

    `good` tells which texts have tokens: those that are not empty and that both vocabularies spell back.
    """

    def __init__(self, texts: pa.Array, a: Vocabulary, b: Vocabulary):
        data, offsets = buffer(texts)
        size = np.diff(offsets)
        strings = [parts(t or "") for t in texts.to_pylist()]
        owner = np.repeat(np.arange(len(strings)), [len(p) for p in strings])
        flat = list(chain.from_iterable(strings))
        self.good = size > 0
        encoded = []
        for vocabulary in (a, b):
            ids, counts = vocabulary.encode(flat)
            text = np.repeat(owner, counts)
            length = np.bincount(text, weights=vocabulary.size[ids], minlength=len(size)).astype(np.int64)
            self.good &= length == size + 1
            encoded.append((ids, text))
        encoded = [(ids[self.good[text]], text[self.good[text]]) for ids, text in encoded]
        # The texts still in question, a space before each.
        kept = np.flatnonzero(self.good)
        begin = np.append(0, np.cumsum(size[kept] + 1))
        wanted = np.full(begin[-1], 32, np.uint8)
        wanted[spread(begin[:-1] + 1, size[kept])] = data[spread(offsets[:-1][kept], size[kept])]
        for vocabulary, (ids, _) in zip((a, b), encoded, strict=True):
            wrong = np.flatnonzero(vocabulary.spelled(ids) != wanted)
            self.good[kept[np.searchsorted(begin, wrong, side="right") - 1]] = False
        (self.a, self.a_text), (self.b, self.b_text) = ((ids[self.good[text]], text[self.good[text]]) for ids, text in encoded)
        every = np.arange(len(size) + 1)
        self.a_bounds, self.b_bounds = (np.searchsorted(text, every) for text in (self.a_text, self.b_text))
        a_end, b_end = np.cumsum(a.size[self.a]), np.cumsum(b.size[self.b])
        # Of each A token the last B token that it overlaps; they end together where a group does.
        self.last = np.searchsorted(b_end, a_end)
        self.ends_group = b_end[self.last] == a_end if len(a_end) else np.zeros(0, bool)
        after = self.last + self.ends_group
        self.first = np.append(0, after[:-1]) if len(after) else after

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, A id and B id of every pair of overlapping tokens."""
        n = self.last - self.first + 1
        return np.repeat(self.a_text, n), np.repeat(self.a, n), self.b[spread(self.first, n)]

    def counts(self) -> dict[str, np.ndarray]:
        return {
            "n_a": np.diff(self.a_bounds), "n_b": np.diff(self.b_bounds), "n_groups": _between(self.ends_group, self.a_bounds),
            "n_links": _between(self.last - self.first + 1, self.a_bounds),
        }

    def groups(self, decimals: Decimals) -> list[bytes | None]:
        """Per text its groups as `a1,a2|b1;a3|b2,b3`; None for a text without tokens."""
        cut_a = np.flatnonzero(self.ends_group)
        cut_b = self.last[cut_a]
        group_a = np.cumsum(self.ends_group) - self.ends_group
        ends_b = np.zeros(len(self.b), np.int64)
        ends_b[cut_b] = 1
        group_b = np.cumsum(ends_b) - ends_b
        # Each token's place among the tokens of both, group by group.
        place_a = np.arange(len(self.a)) + np.append(0, cut_b + 1)[group_a]
        place_b = np.arange(len(self.b)) + (cut_a + 1)[group_b]
        ids, mark = (np.empty(len(self.a) + len(self.b), kind) for kind in (np.int64, np.uint8))
        ids[place_a], ids[place_b] = self.a, self.b
        mark[place_a] = np.where(self.ends_group, _BAR, _COMMA)
        mark[place_b] = np.where(ends_b, _SEMICOLON, _COMMA)
        size = decimals.size[ids]
        said = decimals.bytes[spread(decimals.start[ids], size)]
        end = np.cumsum(size)
        said[end - 1] = mark
        raw, bounds = said.tobytes(), np.append(0, end)[self.a_bounds + self.b_bounds].tolist()
        return [raw[x : y - 1] if y > x else None for x, y in zip(bounds, bounds[1:], strict=False)]


def _binaries(data: np.ndarray, size: np.ndarray) -> pa.Array:
    ends = np.append(0, np.cumsum(size)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data.tobytes())])


def bitmaps(keys: np.ndarray, docs: int) -> Iterator[pa.RecordBatch]:
    """Postings of one block: per pair n_docs, n_links, docs, planes.

    `keys` are pair * 65536 + document of every link. `docs` of a row is the sorted documents as 16-bit numbers or, where that
    is shorter, one bit per document of the block. Plane k has, for each document of the pair in order, bit k of how often
    it holds the pair beyond once; a pair that no document holds twice has no planes.
    """
    keys = np.sort(keys)
    new = np.append(True, keys[1:] != keys[:-1])
    at = np.flatnonzero(new)
    more = np.diff(np.append(at, len(keys))) - 1
    keys = keys[at]
    pair, doc = keys >> 16, (keys & 0xFFFF).astype("<u2")
    starts = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
    n = np.diff(np.append(starts, len(pair)))
    most = np.maximum.reduceat(more, starts)
    planes = np.zeros(len(starts), np.int64)
    for k in range(int(most.max()).bit_length()):
        planes += most >> k > 0
    for low in range(0, len(starts), 20_000):
        rows = slice(low, low + 20_000)
        first, count, deep = starts[rows], n[rows], planes[rows]
        inside = slice(int(first[0]), int(first[-1] + count[-1]))
        rank = spread(np.zeros(len(count), np.int64), count)
        width = -(-count // 8)
        base = 8 * (np.cumsum(width * deep) - width * deep)
        bits = np.zeros(8 * int((width * deep).sum()), np.uint8)
        row = np.repeat(np.arange(len(count)), count)
        for k in range(int(deep.max())):
            held = deep[row] > k
            bits[(base + 8 * k * width)[row[held]] + rank[held]] = more[inside][held] >> k & 1
        flat, size = doc[inside].view(np.uint8), 2 * count
        dense = np.flatnonzero(size > -(-docs // 8))
        if len(dense):
            pieces, done = [], 0
            for r in dense.tolist():
                x = int(first[r] - first[0])
                there = np.zeros(docs, np.uint8)
                there[doc[inside][x : x + count[r]]] = 1
                pieces += [flat[done : 2 * x], np.packbits(there, bitorder="little")]
                done, size[r] = 2 * (x + int(count[r])), len(pieces[-1])
            flat = np.concatenate([*pieces, flat[done:]])
        yield pa.record_batch(
            {
                "pair": pa.array(pair[first]),
                "n_docs": pa.array(count.astype(np.int64)),
                "n_links": pa.array(count + np.add.reduceat(more[inside], first - first[0])),
                "docs": _binaries(flat, size),
                "planes": _binaries(np.packbits(bits, bitorder="little"), width * deep),
            }
        )


def postings(n: np.ndarray, docs: pa.Array, planes: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, document and how often, of all postings of such rows."""
    flat, offsets = buffer(docs)
    size = np.diff(offsets)
    row = np.repeat(np.arange(len(n)), n)
    first = np.cumsum(n) - n
    doc = np.empty(len(row), np.int64)
    listed = size == 2 * n
    doc[spread(first[listed], n[listed])] = flat[spread(offsets[:-1][listed], size[listed])].view("<u2")
    for r in np.flatnonzero(~listed).tolist():
        there = np.unpackbits(flat[offsets[r] : offsets[r + 1]], bitorder="little")
        doc[first[r] : first[r] + n[r]] = np.flatnonzero(there)
    flat, offsets = buffer(planes)
    width = -(-n // 8)
    deep = np.diff(offsets) // np.maximum(width, 1)
    often = np.ones(len(row), np.int64)
    bits = np.unpackbits(flat, bitorder="little")
    for k in range(int(deep.max(initial=0))):
        held = deep > k
        begin = 8 * (offsets[:-1][held] + k * width[held])
        often[spread(first[held], n[held])] += bits[spread(begin, n[held])].astype(np.int64) << k
    return row, doc, often


_DOCUMENT = ("n_a", "n_b", "n_groups", "n_links", "groups_sha256")


def blocks(docs: DataFrame, a_path: str = A_VOCABULARY, b_path: str = B_VOCABULARY, groups: bool = False, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The written index: rows of documents (pair null) with block and slot, and rows of pairs with their bitmaps."""
    ship_package()
    kind = docs.schema["doc_id"].dataType.simpleString()

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = once(ByteVocabulary, a_path), once(PieceVocabulary, b_path)
        decimals = once(Decimals, max(len(a.size), len(b.size)))
        block, slot, held, seen = TaskContext.get().partitionId() << 32, 0, [], 0

        def finished() -> Iterator[pa.RecordBatch]:
            keys = np.concatenate(held) if held else np.zeros(0, np.int64)
            for batch in bitmaps(keys, slot) if len(keys) else ():
                yield _padded({"block": pa.array(np.full(batch.num_rows, block)), **dict(zip(batch.schema.names, batch.columns, strict=True))})

        for batch in slices(batches, "text"):
            texts = batch.column("text")
            aligned = Aligned(texts, a, b)
            said = aligned.groups(decimals)
            text, left, right = aligned.links()
            held.append((left * len(b.size) + right) << 16 | (text + slot))
            rows = {name: pa.array(x.astype(np.int64)) for name, x in aligned.counts().items()}
            rows |= {
                "block": pa.array(np.full(len(said), block)),
                "slot": pa.array(np.arange(slot, slot + len(said))),
                "doc_id": batch.column("doc_id"),
                "groups_sha256": pa.array([hashlib.sha256(x).hexdigest() if x else "" for x in said]),
            }
            if groups:
                rows["groups"] = pa.array([(x or b"").decode() for x in said])
            yield _padded(rows)
            slot += len(said)
            seen += texts.nbytes
            if slot >= BLOCK_DOCS or seen >= block_bytes:
                yield from finished()
                block, slot, held, seen = block + 1, 0, [], 0
        yield from finished()

    longs = ("block", "slot", "pair", "n_docs", "n_a", "n_b", "n_groups", "n_links")
    schema = f"{', '.join(f'{x} long' for x in longs)}, docs binary, planes binary, groups_sha256 string, doc_id {kind}"
    schema += ", groups string" if groups else ""
    kinds = {f.name: f.type for f in to_arrow_schema(StructType.fromDDL(schema))}

    def _padded(columns: dict[str, pa.Array]) -> pa.RecordBatch:
        n = len(columns["block"])
        return pa.record_batch({x: columns[x].cast(k) if x in columns else pa.nulls(n, k) for x, k in kinds.items()})

    return written(docs.select("doc_id", "text").mapInArrow(index, schema), "pair-bitmaps")


def pair_counts(index: DataFrame, b_size: int) -> DataFrame:
    """Per linked pair: pair, a, b, n_docs (documents that hold it), n_links (how often), top (no pair of its A id is in more)."""
    counted = index.where("pair IS NOT NULL").groupBy("pair").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_links").alias("n_links"))
    size = F.lit(b_size).cast("long")
    named = counted.withColumns({"a": F.floor(F.col("pair") / size).cast("long"), "b": F.col("pair") % size})
    # The pairs of an A id are at most as many as the other vocabulary has ids.
    return named.withColumn("top", F.col("n_docs") == F.max("n_docs").over(Window.partitionBy("a")))


def align(
    docs: DataFrame, a_path: str = A_VOCABULARY, b_path: str = B_VOCABULARY, groups: bool = False, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 and, if asked for, groups.

    Texts that are null or empty, or that a vocabulary does not spell back byte for byte, have zeros and an empty
    groups_sha256. Rows count as documents, also where they repeat; null ids keep their rows; columns other than doc_id and text
    are ignored; an empty table gives no rows. Ties for the highest count are all counted in n_best.
    """
    index = blocks(docs, a_path, b_path, groups, block_bytes)
    counts = pair_counts(index, len(PieceVocabulary(b_path).size)).select("pair", F.col("n_docs").alias("count"), "top")
    told = ["block", "slot", "doc_id", *_DOCUMENT, *(["groups"] if groups else [])]
    scores = index.where("pair IS NOT NULL").select("block", "pair", "n_docs", "docs", "planes").join(counts, "pair").drop("pair")
    mixed = index.where("pair IS NULL").select(*told).unionByName(scores, allowMissingColumns=True)
    result = ["doc_id", *_DOCUMENT[:-1], "n_best", "count_sum", *told[7:]]
    kind = docs.schema["doc_id"].dataType.simpleString()
    strings = {"groups_sha256", "groups"}
    schema = ", ".join(f"{c} {kind if c == 'doc_id' else 'string' if c in strings else 'long'}" for c in result)

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, rows = None, []
        sums, best = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)

        def finished() -> Iterator[pa.RecordBatch]:
            for batch in rows:
                slot = batch.column("slot").to_numpy()
                columns = {c: batch.column(c) for c in result if c in batch.schema.names}
                columns |= {"n_best": pa.array(best[slot]), "count_sum": pa.array(sums[slot])}
                yield pa.record_batch({c: columns[c] for c in result})

        for batch in batches:
            block = batch.column("block").to_numpy()
            edges = [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1).tolist(), batch.num_rows]
            for low, high in zip(edges, edges[1:], strict=False):
                if low == high:
                    continue
                if block[low] != current:
                    yield from finished()
                    current, rows = block[low], []
                    sums[:], best[:] = 0, 0
                run = batch.slice(low, high - low)
                posted = run.filter(run.column("slot").is_null())
                if posted.num_rows < run.num_rows:
                    rows.append(run.filter(run.column("slot").is_valid()).select(told))
                if posted.num_rows:
                    count, top = posted.column("count").to_numpy(), posted.column("top").to_numpy(zero_copy_only=False)
                    row, doc, often = postings(posted.column("n_docs").to_numpy(), posted.column("docs"), posted.column("planes"))
                    np.add.at(sums, doc, count[row] * often)
                    np.add.at(best, doc, often * top[row].astype(np.int64))
        yield from finished()

    return mixed.repartition("block").sortWithinPartitions("block").mapInArrow(assemble, schema)
