"""Concatenate and cut: all documents' token ids in one row, cut into sequences of a fixed length.

Pass one encodes each document once and writes its ids with their offset within the partition; the partitions' totals,
summed up, give each partition's global offset. Pass two cuts each document where a sequence ends. A document longer than what
is left of its sequence yields a boundary record in each sequence it reaches; only the last sequence is padded.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.shipping import ship_package
from tidemark.llm.staging import written
from tidemark.llm.tokenizing import library_encoder, once
from tidemark.llm.words import slices

#: Tokens of a sequence.
SEQUENCE = 1024
#: Id after each document.
END = 0
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def encoded(docs: DataFrame, path: str = VOCABULARY, end: int = END) -> DataFrame:
    """Per document: doc_id, ids (unsigned 16-bit where the vocabulary allows), doc_tokens, part, in_part; written."""
    ship_package()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, at = once(library_encoder, path), TaskContext.get().partitionId(), 0
        for batch in slices(batches, "text", 2 << 20):
            flat, bounds = encoder.many(batch.column("text"))
            ids, sizes = [], np.diff(bounds) + 1
            for own in np.split(flat, bounds[1:-1]):
                own = np.append(own, np.uint32(end))
                ids.append(own.astype("<u2").tobytes() if own.max() < 1 << 16 else own.astype("<u4").tobytes())
            ends = np.cumsum(sizes)
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "ids": pa.array(ids, pa.binary()),
                    "doc_tokens": pa.array(sizes, pa.int64()),
                    "part": pa.array(np.full(len(sizes), part)),
                    "in_part": pa.array(at + ends - sizes),
                }
            )
            at += int(ends[-1])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, ids binary, doc_tokens long, part long, in_part long"
    return written(docs.select("doc_id", "text").mapInArrow(encode, schema), "token-ids")


def pack(docs: DataFrame, path: str = VOCABULARY, length: int = SEQUENCE, end: int = END, ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if asked for, ids.

    A null or empty text is one piece: the end token. Every row of docs is packed, repeated and null ids too; columns
    other than doc_id and text are ignored; an empty table gives no pieces. Order is that of the rows as read.
    """
    tokens = encoded(docs, path, end)
    # One row per task of the first pass, not per document.
    totals = sorted(tuple(r) for r in tokens.groupBy("part").agg(F.sum("doc_tokens")).collect())
    # Each task of the second pass has them all and adds them itself: the tokens stay where they were written.
    bases = dict(zip([p for p, _ in totals], accumulate((n for _, n in totals), initial=0), strict=False))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "ids"):
            docs_, rows, crcs, parts = batch.column("doc_id"), [], [], []
            columns = (batch.column(n).to_pylist() for n in ("ids", "doc_tokens", "part", "in_part"))
            for at, (raw, size, part, in_part) in enumerate(zip(*columns, strict=True)):
                begin = bases[part] + in_part
                own = np.frombuffer(raw, f"<u{len(raw) // size}").astype("<u4").tobytes()
                first = -(begin % length)
                for start in range(first, size, length):
                    low, high = max(start, 0), min(start + length, size)
                    piece = own[4 * low : 4 * high]
                    rows.append((at, low, high - low, size, (begin + low) // length, (begin + low) % length))
                    crcs.append(zlib.crc32(piece))
                    parts.append(piece)
            at, low, size, whole, sequence, offset = (pa.array(x, pa.int64()) for x in zip(*rows, strict=True))
            out = {
                "doc_id": docs_.take(at), "start": low, "length": size, "ids_crc32": pa.array(crcs, pa.int64()),
                "doc_tokens": whole, "sequence_id": sequence, "offset": offset,
            }
            yield pa.record_batch(out | ({"ids": pa.array(parts, pa.binary())} if ids else {}))

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return tokens.mapInArrow(cut, schema + (", ids binary" if ids else ""))
