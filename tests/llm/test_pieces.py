"""The piece cache: runs of letters and signs are encoded once, whatever stands beside them."""

import numpy as np
import public_tokenizers as P
import pytest

from cropledger.llm.byte_bpe import BytePairs, read_ranks
from cropledger.llm.pieces import LibraryEncoder, PieceCache
from cropledger.llm.token_files import Shard, re_pair

TEXTS = [
    "One two. Two\nthree, one$$ Three.\nTwo\nOne",
    "two.\nThree, $$one #two%three\none. one\n\ntwo .\none it's one.\n'tis <|endoftext|> 7\nécole.\nÉté&&&",
    "",
    "three.\nOne\n",
    " one  two\n",
]


class Recorder:
    """An encoder that notes the pieces it is given."""

    def __init__(self, encoder):
        self.encoder, self.pre_tokens, self.given = encoder, getattr(encoder, "pre_tokens", None), []

    def __call__(self, pieces):
        self.given += pieces
        return self.encoder(pieces)


def _encoder(name):
    if name.endswith(".json"):
        return LibraryEncoder(P.path(name))
    return BytePairs(read_ranks(P.path(name)), P.PATTERN)


def _ids(rows):
    return [np.frombuffer(r, dtype=np.int32).tolist() for r in rows]


@pytest.mark.parametrize("name,spaced", [("byte_bpe_50k.json", True), ("byte_bpe_multi_50k.tiktoken", True), ("word_bpe_49k.json", False)])
def test_runs_are_encoded_once(name, spaced):
    encoder = _encoder(name)
    whole = encoder._whole if name.endswith(".json") else encoder.encode_pieces
    recorder = Recorder(encoder)
    cache = PieceCache(recorder, spaced)
    assert _ids(cache.encode(TEXTS[:1])) == whole(TEXTS[:1])
    assert len(recorder.given) == len(set(recorder.given))
    assert not any("\n" in p.strip("\n") or "$" in p.strip("$ ") or "." in p.strip(". ") for p in recorder.given)
    assert _ids(cache.encode(TEXTS)) == whole(TEXTS)
    assert _ids(cache.encode(TEXTS)) == whole(TEXTS)


def test_another_pattern_keeps_its_pieces():
    """A pattern whose signs take line breaks along: pieces are not cut there."""
    ranks = {bytes([i]): i for i in range(256)} | {b".\n": 256, b" one": 257, b"on": 258}
    pairs = BytePairs(ranks, r"[^\r\n\p{L}\p{N}]?\p{L}+| ?[^\s\p{L}\p{N}]+[\r\n]*|\s+")
    cache = PieceCache(pairs, True)
    texts = ["one one.\none .\none on$one"]
    assert not cache.runs
    assert _ids(cache.encode(texts)) == pairs.encode_pieces(texts)
    assert pairs.decode(pairs.encode_pieces(texts)[0]) == texts[0].encode()


@pytest.mark.parametrize("name,spaced", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_a_piece_is_looked_up_once_in_a_block(name, spaced):
    """However often its texts hold it."""

    class Counted(dict):
        asked = 0

        def get(self, *key):
            Counted.asked += 1
            return super().get(*key)

    cache = PieceCache(_encoder(name), spaced)
    cache.known = Counted()
    if not spaced:
        cache.plain = cache.known
    texts = ["one two three, " * 2000 + "end", "", " ", "two", "one two　 three"]
    assert _ids(cache.encode(texts)) == cache.encode_pieces._whole(texts)
    assert Counted.asked < 100


def test_shard_expands_nested_rules():
    ids = np.array([5, 6] * 500 + [7] * 333 + [5, 6, 7, 7] * 200 + [8], dtype=np.int32)
    first = np.array([0, 1, 1000, 1333, len(ids)])
    symbols, doc_at, rules, lengths = re_pair(ids, first, 10, least=2)
    assert (rules >= 10).any() and len(symbols) < len(ids) // 10
    shard = Shard({"base": 10, "symbols": symbols.astype("<u4").tobytes(), "width": 4, "doc_at": doc_at.astype("<u4").tobytes(), "rules": rules.astype("<u4").tobytes(), "lengths": lengths.astype("<u4").tobytes(), "n_ids": len(ids)})
    assert shard.all_ids().tolist() == ids.tolist()
    assert shard.document_starts().tolist() == first.tolist()
