"""Vector bin packing of tokenised documents into training sequences (operator 4).

A sequence has limits on three resources at once: tokens, segments (pieces of
documents) and loss-bearing tokens. The open sequence takes, of the pieces that
fit in every limit, the one whose need points most along what the sequence has
left (largest dot product of need and residual, both as shares of the limits,
weighted by how scarce each resource is); of equal pieces the first goes first. When no
piece fits and more than ``slack`` tokens are free, the piece of best dot product
among the pieces left is cut to fill the sequence, and its rest opens the next one. A
sequence that is full of segments or loss-bearing tokens with more than ``slack``
tokens free becomes sequences of power-of-two length, which need no padding.

Documents are cut into whole sequences first where they are longer than one. The
work runs in each partition on its own; only the last open sequence of an
Arrow batch goes on to the next, so memory is bounded by a batch. What is left at
the end of a partition goes to sequences of power-of-two length, which need no
padding. Sequence ids hold the partition and a counter.

Each token lies in exactly one piece. A null or empty text has no ids but its end
id, which is packed like any other. Rows with a null id are packed too; repeated
rows are packed as often as they occur; other columns are never read; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from cropledger.llm.pieces import LibraryEncoder, cache_for, encoded_blocks

SEQUENCE = 4096
SEGMENTS = 256
SLACK = 32
END_ID = 2


Piece = tuple[int, int, int, int]  # key, start, tokens, loss tokens


def cut(piece: Piece, share: int) -> tuple[Piece, Piece]:
    """A piece's first ``share`` tokens and the rest. Its loss-bearing tokens are its last."""
    key, start, tokens, loss = piece
    part = max(0, share - (tokens - loss))
    return (key, start, share, part), (key, start + share, tokens - share, loss - part)


class Packer:
    """Packs pieces ``(key, start, tokens, loss tokens)`` under limits on tokens, pieces
    and loss tokens of a sequence."""

    def __init__(self, limits: tuple[int, int, int], slack: int = SLACK):
        if min(limits) < 1:
            raise ValueError("a limit under 1 leaves no room for any piece")
        self.limits, self.slack = limits, slack
        self.open: list[Piece] = []
        self.left = list(limits)

    def _put(self, piece: Piece) -> None:
        self.open.append(piece)
        self.left[0] -= piece[2]
        self.left[1] -= 1
        self.left[2] -= piece[3]

    def _close(self) -> Iterator[list[Piece]]:
        """The open sequence; with more than ``slack`` tokens free (another limit is used
        up) as sequences of power-of-two length."""
        done, free = self.open, self.left[0]
        self.open, self.left = [], list(self.limits)
        if done:
            yield from [done] if free <= self.slack else _powers(done)

    def _room(self, piece: Piece) -> int:
        """Tokens of the piece's front that fit in the open sequence."""
        if self.left[1] < 1:
            return 0
        _, _, tokens, loss = piece
        return min(self.left[0], tokens if loss <= self.left[2] else tokens - loss + self.left[2])

    def _fill(self, piece: Piece) -> Iterator[list[Piece]]:
        """Places a whole piece, cut where a sequence ends."""
        while piece[2]:
            share = min(self._room(piece), piece[2])
            if share:
                front, piece = cut(piece, share)
                self._put(front)
            if piece[2] or not self.left[0]:
                yield from self._close()

    def pack(self, pieces: list[Piece]) -> Iterator[list[Piece]]:
        """Closed sequences made of the open one and ``pieces``; all pieces are placed.

        Pieces of equal need are a class; the classes are scored, not the pieces. What is
        left of a cut piece opens the next sequence."""
        size, most = self.limits[0], self.limits[2]
        classes: dict[tuple[int, int], list[Piece]] = {}
        for piece in pieces:  # whole sequences of long pieces
            while piece[2] > size or (piece[2] == size and piece[3] <= most):
                front, piece = cut(piece, min(size, piece[2] - piece[3] + most))
                yield from [[front]] if front[2] == size else _powers([front])
            if piece[2]:
                classes.setdefault(piece[2:], []).append(piece)
        queues = [q[::-1] for q in classes.values()]
        need = np.array([(t, 1, loss) for t, loss in classes], dtype=np.float64).reshape(-1, 3)
        total = (need * np.array([len(q) for q in queues]).reshape(-1, 1)).sum(axis=0)
        weight = total / self.limits  # scarce resources count more
        scale = weight / max(weight.max(), 1e-9) / np.array(self.limits, dtype=np.float64) ** 2
        alive = np.ones(len(queues), dtype=bool)
        while queues:
            left = np.array(self.left, dtype=np.float64)
            score = need @ (scale * left)
            fitting = np.where(alive & (need <= left).all(axis=1), score, -1.0)
            best = int(np.argmax(fitting))
            if fitting[best] >= 0:
                self._put(queues[best].pop())
                if not self.left[0]:
                    yield from self._close()
            else:
                best = int(np.argmax(np.where(alive, score, -1.0)))
                if not self.open or min(self.left[0], self._room(queues[best][-1])) > self.slack:
                    yield from self._fill(queues[best].pop())
                else:
                    yield from self._close()
                    continue
            if not queues[best]:
                alive[best] = False
                if 2 * alive.sum() <= len(queues):
                    queues, need = [q for q in queues if q], need[alive]
                    alive = np.ones(len(queues), dtype=bool)

    def rest(self) -> Iterator[list[Piece]]:
        """The open sequence as sequences of power-of-two length."""
        done, self.open, self.left = self.open, [], list(self.limits)
        yield from _powers(done)


def _powers(pieces: list[Piece]) -> Iterator[list[Piece]]:
    """The pieces in their order as sequences of power-of-two length, longest first."""
    queue = pieces[::-1]
    total = sum(p[2] for p in pieces)
    while total:
        size = 1 << (total.bit_length() - 1)
        total -= size
        part = []
        while size:
            front, after = cut(queue[-1], min(size, queue[-1][2]))
            part.append(front)
            size -= front[2]
            queue.pop()
            if after[2]:
                queue.append(after)
        yield part


def _ids(path: str, spaced: bool, end_id: int | None):
    def run(texts: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
        cache = cache_for("library", path, LibraryEncoder, spaced)
        end = np.array([] if end_id is None else [end_id], dtype=np.int32).tobytes()
        for lo, rows in encoded_blocks(texts, cache):
            yield lo, [r + end for r in rows]

    return run


def pack_documents(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    spaced: bool = False,
    end_id: int = END_ID,
    limits: tuple[int, int, int] = (SEQUENCE, SEGMENTS, SEQUENCE),
    slack: int = SLACK,
    prompt_col: str | None = None,
) -> DataFrame:
    """A row per piece: ``id_col, start, length, ids`` (little-endian unsigned 32-bit),
    ``doc_tokens, sequence_id, offset, loss_tokens``. ``spaced``: the vocabulary is
    byte-level, where a space belongs to the word after it. All tokens of a document bear
    loss, unless ``prompt_col`` names a text that goes before it: that one's tokens
    (encoded by itself; null: none) bear none."""
    encode, bare = _ids(path, spaced, end_id), _ids(path, spaced, None)
    kind = to_arrow_type(docs.schema[id_col].dataType)
    prompt = [F.col(f"`{prompt_col}`").cast("string").alias("p")] if prompt_col is not None else []
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("t"), *prompt)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, first = Packer(limits, slack), TaskContext.get().partitionId() << 36
        number = 0
        held: dict[int, tuple[object, bytes]] = {}  # key -> id, ids: documents of the open sequence or the batch
        key = 0

        def emit(sequences) -> Iterator[pa.RecordBatch]:
            nonlocal number
            out: list[list] = [[] for _ in range(8)]
            for seq in sequences:
                offset = 0
                for k, start, n, loss in seq:
                    doc, ids = held[k]
                    for col, x in zip(out, (doc, start, n, ids[4 * start : 4 * (start + n)], len(ids) // 4, first + number, offset, loss), strict=True):
                        col.append(x)
                    offset += n
                number += 1
            types = [kind, pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "loss_tokens"])

        for batch in batches:
            ids = batch.column(0).to_pylist()
            pieces = []
            prompts = [b for _, bs in bare(batch.column(2)) for b in bs] if prompt_col is not None else None
            for lo, encoded in encode(batch.column(1)):
                for i, body in enumerate(encoded):
                    whole = prompts[lo + i] + body if prompts else body
                    held[key] = ids[lo + i], whole
                    pieces.append((key, 0, len(whole) // 4, len(body) // 4))
                    key += 1
            yield from emit(packer.pack(pieces))
            held = {p[0]: held[p[0]] for p in packer.open}
        yield from emit(packer.rest())

    schema = f"id {rows.schema['id'].dataType.simpleString()}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, loss_tokens long"
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


NAME, ORACLE = "op4_packing", None


def digest(packed: DataFrame) -> DataFrame:
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return digest(pack_documents(docs, public_tokenizers.path("word_bpe_49k.json")))
