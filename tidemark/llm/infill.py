"""Fill-in-middle: documents cut at two units into prefix, middle and suffix, and put together in another order.

Secondary-sort assembly: every document leaves its task as pieces of whole units, keyed by its row and their position in the
output. One shuffle deals the rows out, each task sorts its pieces by row and position and streams them into the digest of
each output. What comes out, read as text with markers, is then sorted by original position, in the same task, and
streamed into the digest of the restored text. No task holds a document, however long, beyond the task that reads it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemark.functions.shipping import ship_package
from tidemark.llm.tokenizing import spread
from tidemark.llm.words import slices, split_words

#: The markers before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Seed of the draws; percentage of texts that are cut, and of those, that have the suffix first.
SEED, RATE, SPM = 42, 50, 80
#: Bytes of a piece, unless a single unit is longer: that is cut at a code point.
PIECE = 4 << 10

_FIELDS = "form string, n long, prefix_chars long, middle_chars long"
_ORDER = {"psm": (PREFIX, "prefix", SUFFIX, "suffix", MIDDLE, "middle"), "spm": (SUFFIX, "suffix", PREFIX, "prefix", MIDDLE, "middle")}
#: Where the text after a marker stands in the restored one.
_PLACE = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}


def draws(doc_id: object, seed: int = SEED) -> list[int]:
    """Four 32-bit numbers drawn from seed and id; a null id counts as an empty string."""
    said = f"{seed}:{'' if doc_id is None else doc_id}"
    raw = hashlib.sha256(said.encode()).digest()
    return [int.from_bytes(raw[i : i + 4], "big") for i in range(0, 16, 4)]


def _marked(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which texts hold one of the markers."""
    at = np.flatnonzero(data[:-2] == PREFIX[0]) if len(data) > 2 else np.zeros(0, np.int64)
    at = at[np.isin(data[at + 1], [m[1] for m in _PLACE]) & (data[at + 2] == PREFIX[2])]
    text = np.searchsorted(offsets, at, side="right") - 1
    out = np.zeros(len(offsets) - 1, bool)
    out[text[at + 3 <= offsets[text + 1]]] = True
    return out


def _cut(low: int, high: int, ends: np.ndarray, lead: np.ndarray, piece: int) -> Iterator[tuple[int, int]]:
    """Spans of [low, high) that end with a unit, or, within a unit longer than a piece, with a code point.

    `ends` are the ends of the text's units, `lead` tells for each byte (and the end) whether a code point starts there.
    """
    while high - low > piece:
        k = int(np.searchsorted(ends, low + piece, side="right")) - 1
        end = int(ends[k]) if k >= 0 and ends[k] > low else low + piece
        while not lead[end]:
            end -= 1
        yield low, end
        low = end
    if high > low:
        yield low, high


def pieces(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm: int = SPM, piece: int = PIECE) -> DataFrame:
    """Every document's output in pieces: part and at (its row), position, piece; and doc_id, form, n, prefix_chars, middle_chars.

    The latter stand at position 0 only, an empty piece that every document has. A plain text has no prefix_chars and
    middle_chars.
    """
    if piece < 4:
        raise ValueError("a piece holds at least one code point")
    ship_package()
    kind = docs.schema["doc_id"].dataType
    schema = f"part long, at long, doc_id {kind.simpleString()}, {_FIELDS}, position long, piece binary"
    markers = np.frombuffer(PREFIX + SUFFIX + MIDDLE, np.uint8)
    where = {PREFIX: 0, SUFFIX: 3, MIDDLE: 6}

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, done = TaskContext.get().partitionId(), 0
        for batch in slices(batches, "text"):
            words = split_words(batch.column("text"))
            data, offsets = words.data, words.offsets
            bounds = words.bounds()
            lead = np.append((data & 0xC0) != 0x80, True)
            # Code points before each byte.
            chars = np.append(0, np.cumsum(lead[:-1]))
            marked = _marked(data, offsets)
            ids = batch.column("doc_id").to_pylist()
            forms, counts, prefixes, middles = [], [], [], []
            rows, positions, starts, lengths = [], [], [], []
            for k, doc_id in enumerate(ids):
                low, high = int(offsets[k]), int(offsets[k + 1])
                ends = words.end[bounds[k] : bounds[k + 1]]
                if high > (ends[-1] if len(ends) else low):
                    ends = np.append(ends, high)  # white space that no word follows
                n, (h1, h2, h3, h4) = len(ends), draws(doc_id, seed)
                plain = low == high or marked[k] or h3 % 100 >= rate
                form = "plain" if plain else "spm" if h4 % 100 < spm else "psm"
                a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
                a, b = (int(ends[x - 1]) if x else low for x in (a, b))
                forms.append(form)
                counts.append(n)
                prefixes.append(None if plain else int(chars[a] - chars[low]))
                middles.append(None if plain else int(chars[b] - chars[a]))
                spans = {"prefix": (low, a), "middle": (a, b), "suffix": (b, high), "text": (low, high)}
                placed = [(0, 0)]
                for section in _ORDER.get(form, ("text",)):
                    if section in where:
                        placed.append((len(data) + where[section], 3))
                    else:
                        placed += [(x, y - x) for x, y in _cut(*spans[section], ends, lead, piece)]
                rows += [k] * len(placed)
                positions += range(len(placed))
                for x, y in placed:
                    starts.append(x)
                    lengths.append(y)
            length = np.array(lengths, np.int64)
            whole = np.append(data, markers)[spread(np.array(starts, np.int64), length)]
            ends_ = np.append(0, np.cumsum(length)).astype(np.int64)
            first = pa.array(rows, pa.int64(), mask=np.array(positions) > 0)
            told = {
                "doc_id": batch.column("doc_id"), "form": pa.array(forms, pa.string()), "n": pa.array(counts, pa.int64()),
                "prefix_chars": pa.array(prefixes, pa.int64()), "middle_chars": pa.array(middles, pa.int64()),
            }
            binary = pa.Array.from_buffers(pa.large_binary(), len(length), [None, pa.py_buffer(ends_), pa.py_buffer(whole.tobytes())])
            out = {"part": pa.array(np.full(len(rows), part, np.int64)), "at": pa.array(np.array(rows, np.int64) + done)}
            out |= {name: column.take(first) for name, column in told.items()}
            out |= {"position": pa.array(positions, pa.int64()), "piece": binary.cast(pa.binary())}
            yield from slices(iter([pa.record_batch(out)]), "piece")
            done += len(ids)

    return docs.select("doc_id", "text").mapInArrow(emit, schema)


def _runs(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows of each batch by (part, at), as they stand: (part, at) and the values of the named columns."""
    for batch in batches:
        part, at = (batch.column(n).to_numpy() for n in ("part", "at"))
        edges = np.flatnonzero((part[1:] != part[:-1]) | (at[1:] != at[:-1])) + 1
        columns = [batch.column(n).to_pylist() for n in names]
        bounds = [0, *edges.tolist(), batch.num_rows]
        for low, high in zip(bounds, bounds[1:], strict=False):
            if high > low:
                yield (int(part[low]), int(at[low])), list(zip(*(c[low:high] for c in columns), strict=True))


def _flush(rows: list[tuple], kinds: pa.Schema) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), kinds, strict=True)], schema=kinds)


def transform(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm: int = SPM, piece: int = PIECE) -> DataFrame:
    """One row per document: doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256.

    A null text counts as empty: plain, n 0. Every row has a result of its own, repeated and null ids too, and rows of one id
    are drawn alike; columns other than doc_id and text are ignored; an empty table gives no rows.
    """
    told = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {_FIELDS}"
    cut = pieces(docs, seed, rate, spm, piece)
    dealt = cut.repartition("part", "at").sortWithinPartitions("part", "at", "position")
    names = ("doc_id", "form", "n", "prefix_chars", "middle_chars")  # told once per document
    placed = f"part long, at long, place long, seq long, piece binary, {told}, output_sha256 string"
    result = f"{told}, output_sha256 string, restored_sha256 string"
    placed_kinds, result_kinds = (to_arrow_schema(StructType.fromDDL(x)) for x in (placed, result))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each output's digest, as a row before all of its pieces; the pieces with their place in the restored text."""
        current, said, sha, place, seq, rows, size = None, None, None, 0, 0, [], 0

        def closing() -> tuple:
            return (*current, -1, 0, b"", *said, sha.hexdigest())

        for key, run in _runs(batches, (*names, "piece")):
            if key != current:
                if current is not None:
                    rows.append(closing())
                current, said, sha, place, seq = key, run[0][:-1], hashlib.sha256(), 0, 0
            for *_, piece_ in run:
                sha.update(piece_)
                if said[1] != "plain" and piece_ in _PLACE:
                    place = _PLACE[piece_]
                    continue
                rows.append((*key, place, seq, piece_, *[None] * 6))
                seq += 1
                size += len(piece_)
            if size > 1 << 20 or len(rows) > 5000:
                yield _flush(rows, placed_kinds)
                rows, size = [], 0
        if current is not None:
            rows.append(closing())
            yield _flush(rows, placed_kinds)

    def restored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, said, sha, rows = None, None, None, []
        for key, run in _runs(batches, (*names, "output_sha256", "piece")):
            if key != current:
                if current is not None:
                    rows.append((*said, sha.hexdigest()))
                current, said, sha = key, run[0][:-1], hashlib.sha256()
            for *_, piece_ in run:
                sha.update(piece_)
            if len(rows) > 5000:
                yield _flush(rows, result_kinds)
                rows = []
        if current is not None:
            yield _flush([*rows, (*said, sha.hexdigest())], result_kinds)

    streamed = dealt.mapInArrow(digest, placed).sortWithinPartitions("part", "at", "place", "seq")
    return streamed.mapInArrow(restored, result).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"
    )


def outputs(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm: int = SPM) -> DataFrame:
    """One row per document: doc_id, form and the output itself, put together from its sorted pieces."""
    cut = pieces(docs, seed, rate, spm).groupBy("part", "at").agg(
        F.max("doc_id").alias("doc_id"), F.max("form").alias("form"),
        F.sort_array(F.collect_list(F.struct("position", "piece"))).alias("parts"),
    )
    joined = F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["piece"]))
    return cut.select("doc_id", "form", F.decode(joined, "UTF-8").alias("output"))


def restore(output: str, form: str) -> str:
    """The text that an output was made from."""
    if form == "plain":
        return output
    found = sorted((output.index(m.decode()), m) for m in _PLACE)
    ends = [at for at, _ in found[1:]] + [len(output)]
    return "".join(t for _, t in sorted((_PLACE[m], output[at + 3 : end]) for (at, m), end in zip(found, ends, strict=True)))
