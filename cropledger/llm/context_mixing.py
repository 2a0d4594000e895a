"""LM scoring by online logistic context mixing (operator 5).

A text is its words (A-Z lower-cased), a blank after each, and one end: a string of
bytes. Each byte is predicted bit by bit. For every order 1 to 5 the last bytes and
the bits known so far name a slot that counts the zeros and ones seen in
training; so is the word so far, of any length. The logits of these six counts are the bit
predictors. They are combined by weights that a gate selects (the place in the word,
how often the word so far was seen, the highest order seen), learned online by gradient descent on
coding cost; an adaptive map then refines the probability by gate and logit. The sum of
-log2 of the final probabilities is the text's cost in bits; a text's score doesn't
depend on other texts, partitions or their order.

The counts cover all training rows: tasks count (context, byte) strings and words, Spark
sums them, then the zeros and ones of each (context, bits known) pair. A table has as many
slots as its pairs ask for (``LOAD`` of them are filled); pairs that meet go to slots of
their own, and a slot holds a check of ``CHECK_BITS`` of its pair, so a context that was
not seen finds nothing (but for one lookup in some thousands). Tables grow with the different
pairs of the corpus, 4 / LOAD bytes each; the driver assembles and broadcasts them.
The mixing weights and the refinement map are fitted on whole texts, a share of
``MIX_SHARE`` of the training rows whatever their number, chosen by hash, under the
counts of the other rows; partitions learn online and are averaged by their size. The
final counts are those of all rows.

``base`` scores are exact unigram scores with add-one smoothing. The ``TOP_WORDS`` most
frequent training words are broadcast; other words of a text are counted per text and
joined with the counts of all words, so every count is exact and no text is shuffled.

Null and empty texts have the end only. A row of null id is scored and not learned
from. Repeated rows get equal scores. With no training rows all counts are 0. Other columns are
never read. An empty table gives no rows.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cropledger.llm.words import LOWER as _LOWER
from cropledger.llm.words import Block, blocks, discard, map_texts, mix, prefix_hash, span_hash, stored
from cropledger.session import cut_lineage

ORDERS = 5
#: The word so far counts as the context of order WORD.
WORD = ORDERS + 1
MIX_SHARE = 0.1
#: Slots of a chunk of a table, and the share of them that is filled on average.
CHUNK, LOAD = 1 << 16, 0.5
#: Bytes of text looked at together: a byte takes some 150 bytes of arrays.
BLOCK = 1 << 18
TOP_WORDS = 200_000
LEVELS = 6
GATES = 3 * LEVELS * (ORDERS + 1)
#: A second gate, by bit and last byte's class, adds its weights to the first one's.
WEIGHTS = GATES + 8 * 4 * LEVELS
KNOTS, SPAN = 33, 8.0
END, BLANK = 0x0A, 0x20
_CACHE_BITS = 21
_DELTA = 0.3
#: A slot holds its logit in steps of 1 / SCALE, shifted over the check of its pair and its
#: level of evidence; 0 is an empty slot.
SCALE, LEVEL_BITS, CHECK_BITS = 4096, 3, 12
_LEVEL, _CHECK = (1 << LEVEL_BITS) - 1, (1 << CHECK_BITS) - 1
_SALT = mix(np.arange(1, WORD + 1, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019))


def byte_strings(b: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, word so far, document) of each byte to predict. The key is the byte and
    the five before it, ends where the text hasn't begun; the word so far is a hash,
    0 where none of the word is known."""
    length = b.end - b.start
    word = np.repeat(np.arange(len(b.start)), length)
    doc = b.doc[word]
    head = np.cumsum(length) - length
    inside = np.arange(len(word)) - head[word] + b.start[word]
    per = np.bincount(doc, minlength=b.n) + np.diff(b.first) + 1
    out = np.full(int(per.sum()), BLANK, dtype=np.uint8)
    at = np.arange(len(word)) + word + doc
    out[at] = _LOWER[b.buf[inside]]
    last = np.cumsum(per) - 1
    out[last] = END
    owner = np.repeat(np.arange(b.n), per)
    place = np.arange(len(out)) - (last - per + 1)[owner]
    wide = out.astype(np.uint64)
    key = wide.copy()
    for j in range(1, ORDERS + 1):
        before = np.full(len(out), END, dtype=np.uint64)
        before[j:] = np.where(place[j:] >= j, wide[:-j], np.uint64(END))
        key |= before << np.uint64(8 * j)
    # a word's bytes and the blank behind it lie at `start` and on; an end has no word so far
    start = np.arange(len(out))
    begin = at[head]
    inner = np.repeat(begin, length + 1)
    spots = np.repeat(begin - (np.cumsum(length + 1) - (length + 1)), length + 1) + np.arange(len(inner))
    start[spots] = inner
    return key, _so_far(out, start, np.arange(len(out))), owner


def _so_far(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return np.where(end > start, span_hash(prefix_hash(buf), start, end), np.uint64(0))


def _pairs(context: np.ndarray, node: np.ndarray) -> np.ndarray:
    """A 64-bit name of each pair of context and bits known."""
    name = context + node * np.uint64(0x9E3779B97F4A7C15)
    name *= np.uint64(0xD6E8FEB86659FD93)
    return name ^ (name >> np.uint64(32))


def _homes(name: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A pair's first place in its chunk, and its check."""
    return (name & np.uint64(CHUNK - 1)).astype(np.int64), ((name >> np.uint64(16)) & np.uint64(_CHECK)).astype(np.int32)


class Table:
    """Slots of pairs, in chunks. A pair lies in its chunk at its home or behind it,
    before the next empty slot."""

    def __init__(self, chunks: int):
        self.slots = np.zeros(chunks * CHUNK, dtype=np.int32)

    def find(self, name: np.ndarray) -> np.ndarray:
        """The pairs' slots, 0 where a pair wasn't counted."""
        chunk = ((name >> np.uint64(32)) * np.uint64(len(self.slots) // CHUNK)) >> np.uint64(32)
        base, (home, check) = chunk.astype(np.int64) * CHUNK, _homes(name)
        out = self.slots[base + home]
        other = np.flatnonzero((out != 0) & (((out >> LEVEL_BITS) & _CHECK) != check))
        step = 0
        while len(other):
            step += 1
            got = self.slots[base[other] + ((home[other] + step) & (CHUNK - 1))]
            out[other] = got
            other = other[(got != 0) & (((got >> LEVEL_BITS) & _CHECK) != check[other])]
        return out


def _context(key: np.ndarray, order: int) -> np.ndarray:
    return mix(((key >> np.uint64(8)) & np.uint64((1 << (8 * order)) - 1)) + _SALT[order - 1])


def _contexts(key: np.ndarray, so_far: np.ndarray) -> dict[int, np.ndarray]:
    return {k: _context(key, k) for k in range(1, ORDERS + 1)} | {WORD: mix(so_far + _SALT[WORD - 1])}


def _bit(key: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The bits of the byte known at ``depth`` (as a node of its tree), and the next."""
    byte = key & np.uint64(0xFF)
    return (byte >> np.uint64(8 - depth)) | np.uint64(1 << depth), ((byte >> np.uint64(7 - depth)) & np.uint64(1)).astype(np.int64)


def _place(key: np.ndarray) -> np.ndarray:
    """0 at a word's start, 1 in the word, 2 where the context holds no word border."""
    out = np.full(len(key), 2, dtype=np.int64)
    for j in range(ORDERS, 0, -1):
        byte = (key >> np.uint64(8 * j)) & np.uint64(0xFF)
        out[(byte == BLANK) | (byte == END)] = 1 if j > 1 else 0
    return out


def _unread(key: np.ndarray) -> np.ndarray:
    return np.ones((WORD, len(key)), dtype=bool)


@dataclass
class Model:
    tables: dict[int, Table]  # order -> slots: logit of a one and level of evidence
    weights: np.ndarray  # [gate, order], those of the second gate behind the first one's
    refine: np.ndarray  # [gate, knot]: probability of a one

    def inputs(self, key: np.ndarray, contexts: dict, place: np.ndarray, depth: int, seen: np.ndarray):
        """(logits [m, order], first gate, second gate, bit). ``seen`` [order, m]: contexts
        counted with the bits known before; it is brought up to this depth."""
        node, bit = _bit(key, depth)
        x = np.zeros((len(key), WORD), dtype=np.float32)
        high = np.zeros(len(key), dtype=np.int64)
        for k in range(1, WORD + 1):
            if 1 < k <= ORDERS:  # what was seen after a long context was so after its end
                seen[k - 1] &= seen[k - 2]
            at = np.flatnonzero(seen[k - 1])
            slot = self.tables[k].find(_pairs(contexts[k][at], node[at]))
            seen[k - 1, at] = slot != 0
            x[at, k - 1] = slot >> (LEVEL_BITS + CHECK_BITS)
            level = np.zeros(len(key), dtype=np.int64)
            level[at] = slot & _LEVEL
            if k <= ORDERS:
                high[level > 1] = k
        x *= np.float32(1 / SCALE)
        first = (place * LEVELS + level) * (ORDERS + 1) + high
        last = (key >> np.uint64(8)) & np.uint64(0xFF)
        kind = np.where(last > 0x7F, 3, np.where(last > 0x60, 2, np.where(last > 0x20, 1, 0)))
        return x, first, GATES + (depth * 4 + kind) * LEVELS + level, bit

    def mixed(self, x: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        return np.clip(np.einsum("ij,ij->i", x, self.weights[first] + self.weights[second]), -20, 20)

    def final(self, logit: np.ndarray, gate: np.ndarray) -> np.ndarray:
        """Probability of a one: the mixed one averaged with its refinement."""
        p = 1 / (1 + np.exp(-logit))
        at = (np.clip(logit, -SPAN, SPAN) + SPAN) * ((KNOTS - 1) / (2 * SPAN))
        low = np.minimum(at.astype(np.int64), KNOTS - 2)
        part = at - low.astype(at.dtype)
        r = self.refine[gate, low] * (1 - part) + self.refine[gate, low + 1] * part
        return np.clip((p + r) / 2, 1e-6, 1 - 1e-6)

    def bits(self, key: np.ndarray, so_far: np.ndarray) -> np.ndarray:
        """Cost in bits of each key's byte after its context."""
        cost = np.zeros(len(key), dtype=np.float32)
        contexts, place, seen = _contexts(key, so_far), _place(key), _unread(key)
        for depth in range(8):
            x, gate, more, bit = self.inputs(key, contexts, place, depth, seen)
            p = self.final(self.mixed(x, gate, more), gate)
            cost -= np.log2(np.where(bit == 1, p, 1 - p))
        return cost


class _Scorer:
    """Costs of keys with a direct-mapped cache of fixed size."""

    def __init__(self, model: Model):
        self.model = model
        self.key = np.full(1 << _CACHE_BITS, np.iinfo(np.uint64).max, dtype=np.uint64)
        self.cost = np.zeros(1 << _CACHE_BITS, dtype=np.float32)

    def __call__(self, key: np.ndarray, so_far: np.ndarray) -> np.ndarray:
        name = mix(key + mix(so_far))  # one key for both
        slot = name >> np.uint64(64 - _CACHE_BITS)
        out = self.cost[slot]
        miss = np.flatnonzero(self.key[slot] != name)
        if len(miss):
            new, first, inverse = np.unique(name[miss], return_index=True, return_inverse=True)
            at = miss[first]
            got = np.concatenate([self.model.bits(key[at[i : i + 65536]], so_far[at[i : i + 65536]]) for i in range(0, len(at), 65536)])
            out[miss] = got[inverse]
            at = new >> np.uint64(64 - _CACHE_BITS)
            self.key[at], self.cost[at] = new, got
        return out


_scorers: dict[str, _Scorer] = {}


# -- training --------------------------------------------------------------------------


class _Counts:
    """(key, n), and for words their bytes, summed within a task. Memory is bounded:
    ``FOLD`` new rows are summed at a time, and a sum over ``FLUSH`` rows goes out."""

    FOLD, FLUSH = 500_000, 1_000_000

    def __init__(self):
        _scorers.clear()  # a worker that scored before gives that memory back
        self.parts, self.size, self.folded = [], 0, 0

    def add(self, key: np.ndarray, n: np.ndarray, words: pa.Array | None = None) -> Iterator[pa.RecordBatch]:
        self.parts.append((key, n, words))
        self.size += len(key)
        if self.size > self.folded + self.FOLD:
            self._fold()
            if self.size > self.FLUSH:
                yield from self.flush()

    def _fold(self) -> None:
        key = np.concatenate([p[0] for p in self.parts])
        u, first, inverse = np.unique(key, return_index=True, return_inverse=True)
        n = np.bincount(inverse, weights=np.concatenate([p[1] for p in self.parts])).astype(np.int64)
        words = pa.concat_arrays([p[2] for p in self.parts]).take(pa.array(first)) if self.parts[0][2] is not None else None
        self.parts, self.size, self.folded = [(u, n, words)], len(u), len(u)

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.parts:
            self._fold()
            key, n, words = self.parts[0]
            arrays = [pa.array(key.view(np.int64)), pa.array(n)]
            if words is not None:
                yield pa.RecordBatch.from_arrays([*arrays, words.cast(pa.binary())], names=["key", "n", "word"])
            else:
                yield pa.RecordBatch.from_arrays(arrays, names=["key", "n"])
            self.parts, self.size, self.folded = [], 0, 0


def _count_strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = _Counts()
    for batch in batches:
        for b in blocks(batch.column(0), BLOCK):
            key, n = np.unique(byte_strings(b.split_words())[0], return_counts=True)
            yield from counts.add(key, n)
    yield from counts.flush()


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = _Counts()
    for batch in batches:
        for b in blocks(batch.column(0), BLOCK):
            h = b.split_words().word_hashes(lower=True)
            key, first, n = np.unique(h, return_index=True, return_counts=True)
            length = (b.end - b.start)[first]
            off = np.concatenate([[0], np.cumsum(length)])
            at = np.arange(off[-1]) + np.repeat(b.start[first] - off[:-1], length)
            words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(key), [None, pa.py_buffer(off.astype(np.int64).tobytes()), pa.py_buffer(_LOWER[b.buf[at]].tobytes())])
            yield from counts.add(key, n, words)
    yield from counts.flush()


def _totals(rows: DataFrame, of: str) -> DataFrame:
    """Stored sums over ``rows(t, mix)``: (key, n, m) of byte strings, or with the
    ``word`` of words; m is the part of n in the texts kept for mixing."""
    run = _count_strings if of == "strings" else _count_words
    schema = "key long, n long" + (", word binary" if of == "words" else "")
    parts = [rows.where("NOT mix").select("t").mapInArrow(run, schema).withColumn("m", F.lit(0))]
    parts.append(rows.where("mix").select("t").mapInArrow(run, schema).withColumn("m", F.col("n")))
    word = [F.min("word").alias("word")] if of == "words" else []
    return stored(parts[0].unionByName(parts[1]).groupBy("key").agg(F.sum("n").alias("n"), F.sum("m").cast("long").alias("m"), *word))


_PAIRS = "k int, h long, z long, o long, zm long, om long"


def _pair_counts(k: int, context: np.ndarray, byte: np.ndarray, n: np.ndarray, m: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Zeros and ones by pair of rows (context, byte) that are sorted by both."""
    if not len(byte):
        return
    other = np.concatenate([[True], context[1:] != context[:-1]])
    for depth in range(8):
        node, bit = _bit(byte, depth)
        at = np.flatnonzero(other | np.concatenate([[True], node[1:] != node[:-1]]))
        sums = [pa.array(np.add.reduceat(np.where(bit == b, x, 0), at)) for x in (n, m) for b in (0, 1)]
        name = pa.array(_pairs(context[at], node[at]).view(np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k, dtype=np.int32)), name, *sums], names=["k", "h", "z", "o", "zm", "om"])


def _some(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= rows:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


#: Counted rows: a context by the hash of its bytes and order, order * 256 + byte, n, m.
_ROWS = "x long, b int, n long, m long"


def _rows(k: int, context: np.ndarray, byte: np.ndarray, n: np.ndarray, m: np.ndarray) -> pa.RecordBatch:
    cols = [pa.array(context.view(np.int64)), pa.array((byte + np.uint64(256 * k)).astype(np.int32)), pa.array(n), pa.array(m)]
    return pa.RecordBatch.from_arrays(cols, names=["x", "b", "n", "m"])


def _string_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in _some(batches, 250_000):
        key, n, m = (part[c].to_numpy() for c in ("key", "n", "m"))
        for k in range(1, ORDERS + 1):
            u, inverse = np.unique(key.view(np.uint64) & np.uint64((1 << (8 * k + 8)) - 1), return_inverse=True)
            sums = (np.bincount(inverse, weights=x, minlength=len(u)).astype(np.int64) for x in (n, m))
            yield _rows(k, _context(u, k), u & np.uint64(0xFF), *sums)


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of the words so far. An empty word stands for the end of a text."""
    for part in _some(batches, 50_000):
        texts = part["word"].to_pylist()
        length = np.array([len(w) for w in texts], dtype=np.int64) + 1
        buf = np.frombuffer(b"".join(w + (b" " if w else b"\n") for w in texts), dtype=np.uint8)
        begin = np.repeat(np.cumsum(length) - length, length)
        context = mix(_so_far(buf, begin, np.arange(len(buf))) + _SALT[WORD - 1])
        order = np.lexsort((buf, context))
        context, byte = context[order], buf[order].astype(np.uint64)
        n, m = (np.repeat(part[c].to_numpy(), length)[order] for c in ("n", "m"))
        at = np.flatnonzero(np.concatenate([[True], (context[1:] != context[:-1]) | (byte[1:] != byte[:-1])]))
        yield _rows(WORD, context[at], byte[at], np.add.reduceat(n, at), np.add.reduceat(m, at))


def _joint_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of rows sorted by context and byte; a context's rows stay together."""
    held: tuple[np.ndarray, ...] | None = None
    for part in _some(batches, 250_000):
        now = tuple(part[c].to_numpy() for c in ("x", "b", "n", "m"))
        if held is not None:
            now = tuple(np.concatenate(c) for c in zip(held, now, strict=True))
        last = int(np.searchsorted(now[0], now[0][-1]))
        held = tuple(c[last:] for c in now)
        yield from _by_order(*(c[:last] for c in now))
    if held is not None:
        yield from _by_order(*held)


def _by_order(x: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> Iterator[pa.RecordBatch]:
    for k in np.unique(b >> 8).tolist():
        at = np.flatnonzero(b >> 8 == k)
        yield from _pair_counts(k, x[at].view(np.uint64), (b[at] & 0xFF).astype(np.uint64), n[at], m[at])


def _fill(name: np.ndarray, zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """The slots of a chunk that holds these pairs, each behind its home if that is taken."""
    if len(name) >= CHUNK:
        raise ValueError("a chunk of a table is full")
    home, check = _homes(name)
    n = zeros + ones
    logit = np.clip(np.log((ones + _DELTA) / (zeros + _DELTA)), -15, 15)
    level = (n > 0).astype(np.int64) + (n > 1) + (n > 3) + (n > 15) + (n > 255)
    value = ((((np.rint(logit * SCALE).astype(np.int64) << CHECK_BITS) | check) << LEVEL_BITS) | level).astype(np.int32)
    order = np.lexsort((name, home))
    home, value = home[order], value[order]
    row = np.arange(len(home))
    at = np.maximum.accumulate(home - row) + row if len(row) else row
    slots = np.zeros(CHUNK, dtype=np.int32)
    slots[at[at < CHUNK]] = value[at < CHUNK]
    over = value[at >= CHUNK]  # those behind the end go on at the start
    slots[np.flatnonzero(slots == 0)[: len(over)]] = over
    return slots


def _fill_chunk(frame: pd.DataFrame) -> pd.DataFrame:
    slots = _fill(frame["h"].to_numpy().view(np.uint64), frame["z"].to_numpy(), frame["o"].to_numpy())
    return pd.DataFrame({"k": frame["k"].iloc[:1].to_numpy(), "c": frame["c"].iloc[:1].to_numpy(), "data": [slots.tobytes()]})


def _items(batches: Iterator[pa.RecordBatch]):
    """(key, contexts, place, n) of the different predictions of each block."""
    for batch in batches:
        for b in blocks(batch.column(0), BLOCK):
            key, so_far, _ = byte_strings(b.split_words())
            _, first, n = np.unique(mix(key + mix(so_far)), return_index=True, return_counts=True)
            key, so_far = key[first], so_far[first]
            yield key, _contexts(key, so_far), _place(key), n.astype(np.float64)


def _learn(bc, weights: np.ndarray, refine: np.ndarray, rate: float = 0.05, step: int = 4096):
    """Online gated mixing over a task's texts: the weights times the bytes learned from.
    Steps are scaled by each weight's past gradients."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(bc.value, weights.copy(), refine)
        past, seen = np.full((WEIGHTS, WORD), 1e-8), 0.0
        for key, contexts, place, n in _items(batches):
            seen += n.sum()
            for i in range(0, len(key), step):
                now, w = slice(i, i + step), n[i : i + step]
                part, unread = {k: c[now] for k, c in contexts.items()}, _unread(key[now])
                for depth in range(8):
                    x, *gates, bit = model.inputs(key[now], part, place[now], depth, unread)
                    error = (bit - 1 / (1 + np.exp(-model.mixed(x, *gates)))) * w
                    for gate in gates:
                        mass = np.bincount(gate, weights=w, minlength=WEIGHTS)
                        grad = np.stack([np.bincount(gate, weights=error * x[:, k], minlength=WEIGHTS) for k in range(WORD)], axis=1)
                        grad /= np.maximum(mass, 1)[:, None]
                        past += grad**2
                        model.weights += rate * grad / np.sqrt(past)
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([seen]), pa.array([(model.weights * seen).ravel().tolist()])], names=["seen", "w"])

    return run


def _refine(bc, weights: np.ndarray, refine: np.ndarray):
    """Ones and all bits by gate and knot, under the learned weights."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(bc.value, weights, refine)
        one, all_ = np.zeros(GATES * KNOTS), np.zeros(GATES * KNOTS)
        for key, contexts, place, n in _items(batches):
            unread = _unread(key)
            for depth in range(8):
                x, gate, more, bit = model.inputs(key, contexts, place, depth, unread)
                at = np.rint((np.clip(model.mixed(x, gate, more), -SPAN, SPAN) + SPAN) * ((KNOTS - 1) / (2 * SPAN))).astype(np.int64)
                one += np.bincount(gate * KNOTS + at, weights=n * bit, minlength=len(one))
                all_ += np.bincount(gate * KNOTS + at, weights=n, minlength=len(one))
        yield pa.RecordBatch.from_arrays([pa.array([one.tolist()]), pa.array([all_.tolist()])], names=["one", "all"])

    return run


def _summed(df: DataFrame, cols: list[str]) -> list[np.ndarray]:
    """Element-wise sums of array columns of fixed length, by Spark."""
    out = []
    for c in cols:
        got = df.select(F.posexplode(c).alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v")).orderBy("i").collect()
        out.append(np.array([r["v"] for r in got]))
    return out


@dataclass
class Counts:
    """What Spark has counted of the training rows."""

    texts: DataFrame  # t, mix
    strings: DataFrame  # key, n, m
    words: DataFrame  # key, n, m, word
    n_texts: int


def marked(docs: DataFrame, text_col: str = "text", id_col: str | None = None) -> DataFrame:
    """``t, mix``: the texts, ``MIX_SHARE`` of them marked for the mixing weights by the
    hash of the id (else of the text)."""
    text = F.col(f"`{text_col}`").cast("string")
    by = F.xxhash64(F.col(f"`{id_col}`").cast("string")) if id_col else F.xxhash64(text)
    return docs.select(text.alias("t"), (F.pmod(by, F.lit(1_000_003)) < MIX_SHARE * 1_000_003).alias("mix"))


def count(docs: DataFrame, text_col: str = "text", id_col: str | None = None) -> Counts:
    """Counts over all rows of ``docs``."""
    rows = marked(docs, text_col, id_col)
    return Counts(rows, _totals(rows, "strings"), _totals(rows, "words"), docs.count())


def pairs(counts: Counts) -> DataFrame:
    """Stored sums by order and pair: zeros and ones in all texts, and in those kept for mixing.
    A context's bytes go to one task, 256 at most from each, where all its pairs are made: a
    byte is a row on the way, not the eight pairs it stands in."""
    spark = counts.texts.sparkSession
    n_mix = counts.texts.where("mix").count()
    end = spark.range(1 if counts.n_texts else 0).select(F.lit(counts.n_texts).cast("long").alias("n"), F.lit(n_mix).cast("long").alias("m"), F.lit(b"").alias("word"))
    made = counts.strings.select("key", "n", "m").mapInArrow(_string_rows, _ROWS)
    made = made.union(counts.words.select("n", "m", "word").union(end).mapInArrow(_word_rows, _ROWS))
    return stored(made.repartition("x").sortWithinPartitions("x", "b").mapInArrow(_joint_pairs, _PAIRS))


def _tables(counted: DataFrame, zeros: str = "z", ones: str = "o") -> dict[int, Table]:
    """Tables of the pairs, a task per chunk."""
    rows = counted.selectExpr("k", "h", f"{zeros} AS z", f"{ones} AS o").where("z + o > 0")
    sizes = {r["k"]: r["count"] for r in rows.groupBy("k").count().collect()}
    chunks = {k: max(1, math.ceil(sizes.get(k, 0) / (LOAD * CHUNK))) for k in range(1, WORD + 1)}
    many = F.element_at(F.array(*[F.lit(n).cast("long") for n in chunks.values()]), F.col("k"))
    rows = rows.withColumn("c", F.shiftright(F.shiftrightunsigned("h", 32) * many, 32).cast("int"))
    made = stored(rows.groupBy("k", "c").applyInPandas(_fill_chunk, "k int, c int, data binary"))
    tables = {k: Table(n) for k, n in chunks.items()}
    for r in made.toLocalIterator():
        tables[r["k"]].slots[r["c"] * CHUNK : (r["c"] + 1) * CHUNK] = np.frombuffer(bytes(r["data"]), dtype=np.int32)
    discard(made)
    return tables


def fit(counts: Counts) -> Model:
    """Weights learned on the texts kept for mixing, under the counts of the others; then
    the counts of all."""
    sc = counts.texts.sparkSession.sparkContext
    counted = pairs(counts)
    some = counts.texts.where("mix").select("t")
    knots = 1 / (1 + np.exp(-np.linspace(-SPAN, SPAN, KNOTS)))
    weights, refine = np.full((WEIGHTS, WORD), 0.1), np.tile(knots, (GATES, 1))
    # the tables go out once for both passes; every executor keeps a copy on its disk until it is destroyed
    tables = sc.broadcast(_tables(counted, "z - zm", "o - om"))
    learned = cut_lineage(some.mapInArrow(_learn(tables, weights, refine), "seen double, w array<double>"))
    seen = learned.agg(F.sum("seen")).first()[0]
    if seen:
        weights = (_summed(learned, ["w"])[0] / seen).reshape(WEIGHTS, WORD)
        one, all_ = _summed(cut_lineage(some.mapInArrow(_refine(tables, weights, refine), "one array<double>, all array<double>")), ["one", "all"])
        prior = 100.0
        refine = (one.reshape(GATES, KNOTS) + prior * knots) / (all_.reshape(GATES, KNOTS) + prior)
    tables.destroy()
    model = Model(_tables(counted), weights.astype(np.float32), refine.astype(np.float32))
    discard(counted)
    return model


# -- scoring ---------------------------------------------------------------------------


def _scorer(name: str, bc) -> _Scorer:
    if name not in _scorers:
        _scorers.clear()
        _scorers[name] = _Scorer(bc.value)
    return _scorers[name]


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` without the text, with ``n_bytes`` (predicted, the end too), ``bits`` and
    ``bits_per_byte``."""
    name, bc = uuid.uuid4().hex, docs.sparkSession.sparkContext.broadcast(model)

    def run(texts: pa.Array) -> Iterator[list[pa.Array]]:
        for b in blocks(texts, BLOCK):
            key, so_far, doc = byte_strings(b.split_words())
            n = np.bincount(doc, minlength=b.n)
            bits = np.bincount(doc, weights=_scorer(name, bc)(key, so_far), minlength=b.n)
            yield [pa.array(n, pa.int64()), pa.array(bits), pa.array(bits / n)]

    return map_texts(docs, text_col, run, "n_bytes long, bits double, bits_per_byte double", drop_text=True)


def unigram(docs: DataFrame, trained: Counts, text_col: str = "text", top_words: int = TOP_WORDS) -> DataFrame:
    """``docs`` without the text, with ``n_tokens, n_known, train_tokens, base_score``
    under the words counted."""
    sc = docs.sparkSession.sparkContext
    counts, ends = trained.words.select("key", F.col("n").alias("c")), trained.n_texts
    n_words, total = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("c"), F.lit(0))).first()
    tokens, distinct = total + ends, n_words + (ends > 0)
    top = counts.orderBy(F.desc("c"), "key").limit(top_words).toPandas().sort_values("key")
    bc = sc.broadcast((top["key"].to_numpy(), top["c"].to_numpy(dtype=np.int64)))

    def run(texts: pa.Array) -> Iterator[list[pa.Array]]:
        keys, known = bc.value
        for b in blocks(texts, BLOCK):
            h = b.split_words().word_hashes(lower=True).view(np.int64)
            at = np.minimum(np.searchsorted(keys, h), max(len(keys) - 1, 0))
            hit = keys[at] == h if len(keys) else np.zeros(len(h), dtype=bool)
            c = known[at[hit]]
            n = np.diff(b.first)
            rare, doc = h[~hit], b.doc[~hit]
            order = np.lexsort((rare, doc))
            rare, doc = rare[order], doc[order]
            new = np.flatnonzero(np.concatenate([[True], (rare[1:] != rare[:-1]) | (doc[1:] != doc[:-1])])) if len(rare) else np.zeros(0, dtype=np.int64)
            times = np.diff(np.append(new, len(rare)))
            off = np.concatenate([[0], np.cumsum(np.bincount(doc[new], minlength=b.n))]).astype(np.int32)
            items = pa.StructArray.from_arrays([pa.array(rare[new]), pa.array(times.astype(np.int64))], names=["h", "m"])
            yield [
                pa.array(n + 1, pa.int64()),
                pa.array(np.bincount(b.doc[hit], minlength=b.n) + int(ends > 0), pa.int64()),
                pa.array(np.bincount(b.doc[hit], weights=np.log10(c + 1.0), minlength=b.n) + np.log10(ends + 1.0)),
                pa.ListArray.from_arrays(off, items),
            ]

    fields = "n_tokens long, n_known long, base_score double, rare array<struct<h:long,m:long>>"
    rows = map_texts(docs, text_col, run, fields, drop_text=True)
    kept = [c for c in rows.columns if c not in ("n_tokens", "n_known", "base_score", "rare", "row__")]
    rows = stored(rows.withColumn("row__", F.monotonically_increasing_id()))
    rare = rows.select("row__", F.inline("rare")).join(counts, F.col("h") == F.col("key"))
    more = rare.groupBy("row__").agg(F.sum("m").alias("k__"), F.sum(F.col("m") * F.log10(F.col("c") + 1.0)).alias("s__"))
    size = F.log10(F.lit(float(tokens + distinct + 1)))
    return rows.join(more, "row__", "left").select(
        *[F.col(f"`{c}`") for c in kept],
        "n_tokens",
        (F.col("n_known") + F.coalesce("k__", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("s__", F.lit(0.0)) - F.col("n_tokens") * size).alias("base_score"),
    )


NAME, ORACLE = "op5_context_mixing", None


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(True))
    docs = docs.select("doc_id", held.alias("held_out"), "text")
    train = docs.where(~F.col("held_out"))
    counts = count(train, id_col="doc_id")
    model = fit(counts)
    scored = score(docs.select("*", F.col("text").alias("words")), model)
    return unigram(scored, counts, "words").select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", (F.col("bits") * float(-np.log10(2))).alias("score"), "bits_per_byte"
    )
