"""The training-data operators against brute-force versions, exact round trips and
held-out accuracy, on small fixtures with nulls, empty and long texts, ties, repeated
rows, empty tables and extra columns of clashing names."""

import hashlib
import html
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cropledger.llm import byte_bpe, context_mixing, exact_dedup, html_extract, language_id, ngram_join, packing, prefix_trie, quality_rules, registry, spelling, suffix_dedup, token_files, words
from cropledger.llm.pieces import LibraryEncoder, PieceCache
from cropledger.sources.csv_source import path_exists

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LOW = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, _gone string, n_bytes string, id string, kept string, t string"


def _texts():
    rng = random.Random(5)
    vocab = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(1, 8))) for _ in range(150)]
    body = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    base = [body(rng.randint(1, 120)) for _ in range(25)]
    near = []
    for x in base[:8]:
        w = x.split()
        if len(w) > 30:
            w[len(w) // 2] = "changed"
        near.append(" ".join(w))
    shared = body(120)
    texts = base + near + [base[0].upper(), base[1] + "  ", "", " \n\t", None, "É" + base[2], "é" + base[2], "x", "a b c"]
    texts += [body(20) + " " + shared, shared + "\n" + body(30), "ab" * 900, "ab" * 700, body(4000)]
    texts += ["same line\nsame line\nother\n\nsame line", "# $ % & | < > !!! ??? * UPPER", "漢字 仮名 テキスト ß ñ ́ \x1c \x85 z"]
    return texts


@pytest.fixture(scope="module")
def rows():
    texts = _texts()
    out = [(i, t) for i, t in enumerate(texts)]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    full = [(i, t, "en" if i % 3 else None, "g", "b", "i", "k", "t") for i, t in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def got(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_words_block_matches_regex(rows):
    texts = [t or "" for _, t in rows]
    for limit in (50, 1 << 20):
        seen = []
        for b in words.blocks(pa.array([t for _, t in rows], pa.string()), limit):
            b.split_words()
            for d in range(b.n):
                seen.append([b.word(i) for i in range(b.first[d], b.first[d + 1])])
        assert seen == [WORD.findall(t.encode()) for t in texts]


def test_exact_dedup(spark, docs, rows, empty):
    key = {i: hashlib.sha256((t or "").encode().translate(LOW)).hexdigest() for i, t in rows}
    groups = defaultdict(list)
    for i, k in key.items():
        groups[k].append(i)
    want = sorted((i, max(groups[k]), len(groups[k]), i == max(groups[k])) for i, k in key.items())
    assert got(exact_dedup.exact_dedup(docs), "doc_id", "keep_id", "group_size", "kept") == want
    kept = exact_dedup.exact_dedup_rows(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {w[0] for w in want if w[3]}
    assert exact_dedup.exact_dedup(empty).count() == 0
    twice = spark.createDataFrame([(1, "a"), (1, "a"), (None, "a"), (2, "b")], "doc_id long, text string")
    assert got(exact_dedup.exact_dedup(twice), "doc_id", "keep_id", "kept") == [(1, 1, True), (2, 2, True)]
    assert exact_dedup.exact_dedup_rows(twice).count() == 4


def _shingles(t):
    w = WORD.findall((t or "").encode().translate(LOW))
    return frozenset(tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))) if w else frozenset()


def _brute_join(rows, threshold=0.8):
    sets = {i: _shingles(t) for i, t in rows}
    links = {i: {j for j, b in sets.items() if j != i and a and b and len(a & b) / len(a | b) >= threshold} for i, a in sets.items()}
    root = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for i, js in links.items():
            low = min([root[i], *(root[j] for j in js)])
            if low != root[i]:
                root[i], changed = low, True
    return sorted((i, root[i], len(links[i])) for i in sets)


def test_ngram_join(spark, docs, rows, empty):
    assert got(ngram_join.ngram_join(docs), "doc_id", "class_id", "n_links") == _brute_join(rows)
    assert ngram_join.ngram_join(empty).count() == 0
    assert ngram_join.bands_for(0.999, 0.8, 6) == 23
    # a group of near copies beyond a tile: every link is counted, nothing is dropped
    base = [f"w{i}" for i in range(60)]
    many = [(i, " ".join(base[:30] + [f"v{i}"] + base[30:])) for i in range(23)] + [(None, "x y z")]
    df = spark.createDataFrame(many, "doc_id long, text string")
    assert got(ngram_join.ngram_join(df, tile=4), "doc_id", "class_id", "n_links") == _brute_join([m for m in many if m[0] is not None])
    kept = ngram_join.drop_near_duplicates(docs)
    assert {r["doc_id"] for r in kept.collect()} == {i for i, c, _ in _brute_join(rows) if i == c}


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(45)] + [(100, 100 + i) for i in range(1, 20)]
    root = list(range(200))
    for _ in range(200):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    df = ngram_join.components(spark.createDataFrame(edges, "a long, b long"))
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    assert {(r["node"], r["root"]) for r in df.collect()} == {(n, root[n]) for n in nodes}


def _brute_repeats(rows, length):
    data = {i: (t or "").encode() for i, t in rows}
    seen = Counter(d[s : s + length] for d in data.values() for s in range(len(d) - length + 1))
    out = []
    for i, d in data.items():
        gone = bytearray(len(d))
        for s in range(len(d) - length + 1):
            if seen[d[s : s + length]] > 1:
                gone[s : s + length] = b"\1" * length
        left = bytes(x for x, g in zip(d, gone) if not g)
        out.append((i, len(d), len(d) - len(left), len(re.findall(b"\x01+", bytes(gone))), hashlib.sha256(left).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("length,block", [(400, 512), (40, 512), (40, 2)])
def test_suffix_dedup(spark, docs, rows, length, block):
    df = suffix_dedup.remove_repeats(docs, length=length, block=block)
    assert got(df, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == _brute_repeats(rows, length)


def test_suffix_dedup_edges(spark, empty):
    assert suffix_dedup.remove_repeats(empty, length=40).count() == 0
    t = "0123456789" * 3 + "abcdefghijklmnopqrst"
    df = spark.createDataFrame([(1, t), (1, t), (None, t), (2, "short")], "doc_id long, text string")
    rows = got(suffix_dedup.remove_repeats(df.where("doc_id IS NOT NULL"), length=40), "doc_id", "n_removed")
    assert rows == [(1, len(t)), (1, len(t)), (2, 0)]


def test_suffix_array_gives_maximal_repeats():
    texts = [b"xxABCDEFGHIJKLMNOPQRyy", b"zzABCDEFGHIJKLMNOPQRww", b"qABCDEFGHIJKLMNOPzz\0", b"ABCDEFGHIJKLMNOPQR"]
    found, places = suffix_dedup.repeat_tree(texts, np.zeros(4, dtype=np.int64), 16)
    where = {p: (t, s) for p, _, t, s in places.tolist()}
    groups = {frozenset(where[p] for p in range(a, b + 1)): n for n, a, b in found.tolist()}
    assert groups == {frozenset({(0, 2), (1, 2), (2, 1), (3, 0)}): 16, frozenset({(0, 2), (1, 2), (3, 0)}): 18}
    assert {(t, s): n for _, n, t, s in places.tolist()} == {(0, 2): 18, (1, 2): 18, (2, 1): 16, (3, 0): 18}


def _brute_maximal(texts, length):
    """Maximal repeats of distinct texts: groups of all occurrences, from all pairs."""
    strings = {t[a:b] for t in texts for a in range(len(t)) for b in range(a + length, len(t) + 1)}
    out = {}
    for s in strings:
        at = [(i, k) for i, t in enumerate(texts) for k in range(len(t) - len(s) + 1) if t[k : k + len(s)] == s]
        if len(at) > 1:
            left = {texts[i][k - 1] if k else (i, "head") for i, k in at}
            right = {texts[i][k + len(s)] if k + len(s) < len(texts[i]) else (i, "end") for i, k in at}
            if len(left) > 1 and len(right) > 1:
                out[frozenset(at)] = len(s)
    return out


@pytest.mark.parametrize("seed", range(6))
def test_repeat_tree_equals_brute_force(seed):
    rng = random.Random(seed)
    shared = bytes(rng.choice(b"ab") for _ in range(14))
    texts = []
    for _ in range(7):
        t = bytearray(rng.choice(b"abc") for _ in range(rng.randint(0, 5))) + shared[: rng.randint(9, 14)]
        if rng.random() < 0.5:
            t[rng.randrange(len(t))] = ord("d")
        texts.append(bytes(t + bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 5)))))
    texts = sorted(set(texts))
    found, places = suffix_dedup.repeat_tree(texts, np.zeros(len(texts), dtype=np.int64), 8)
    where = {p: (t, s) for p, _, t, s in places.tolist()}
    assert {frozenset(where[p] for p in range(a, b + 1)): n for n, a, b in found.tolist()} == _brute_maximal(texts, 8)


def test_repeat_rows_grow_with_the_copies_not_their_square(spark):
    rng = random.Random(4)
    base = "".join(rng.choice("abcdefgh") for _ in range(500))
    counts = []
    for n in (40, 160):
        near = [base[: 120 + i % 20] + f"#{i}#" + base[121 + i % 20 :] for i in range(n)]
        df = spark.createDataFrame(list(enumerate(near)), "doc_id long, text string")
        tree, _ = suffix_dedup.maximal_repeats(df, length=100)
        counts.append(tree.count())
        if n == 40:
            got = suffix_dedup.occurrences(tree)
            sizes = got.groupBy("part", "repeat").agg(F.count(F.lit(1)).alias("m"), F.count_distinct("id", "start").alias("d")).collect()
            assert sizes and all(r["m"] == r["d"] >= 2 for r in sizes)
    assert counts[1] <= 6 * counts[0]


def test_planted_passages_go_and_clean_documents_stay(spark):
    """Passages of over 50 words that documents share are removed, and nothing else."""
    rng = random.Random(11)
    words = lambda n: " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 9))) for _ in range(n))
    passages = [words(rng.randint(70, 120)) for _ in range(5)]
    rows, planted = [], {}
    for i in range(60):
        text = words(rng.randint(20, 300))
        if i % 3 == 0:
            p = passages[i // 3 % 5]
            text, planted[i] = f"{text}\n{p}\n{words(30)}", p
        rows.append((i, text))
    got_rows = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [tuple(r) for r in sorted(got_rows)] and len(got_rows) == 60
    for r in got_rows:
        if r["doc_id"] in planted:
            assert planted[r["doc_id"]] not in r["kept_text"] and abs(r["n_removed"] - len(planted[r["doc_id"]])) <= 4
        else:
            assert r["n_removed"] == 0


def test_byte_bpe_equals_library(spark, docs, rows, empty):
    import tiktoken

    path = P.path("byte_bpe_multi_50k.tiktoken")
    ranks = byte_bpe.read_ranks(path)
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    both = byte_bpe.decode(byte_bpe.encode(docs, path, P.PATTERN), path, P.PATTERN)
    text = dict(rows)
    for r in both.collect():
        want = library.encode_ordinary(text[r["doc_id"]] or "")
        assert list(r["ids"]) == want and bytes(r["decoded"]) == (text[r["doc_id"]] or "").encode()
    once = byte_bpe.encode(docs, path, P.PATTERN, decoded=True)
    assert sorted((r["doc_id"], bytes(r["decoded"])) for r in once.collect()) == sorted((i, (t or "").encode()) for i, t in rows)
    assert byte_bpe.encode(empty, path, P.PATTERN).count() == 0
    rng, tokens, pairs = random.Random(1), list(ranks), byte_bpe.coder(path, P.PATTERN)
    for _ in range(3000):
        word = b"".join(rng.choice(tokens) for _ in range(rng.randint(1, 4)))
        assert pairs.encode_word(word) == library._encode_single_piece(word)


@pytest.mark.parametrize("name,spaced", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_piece_cache_equals_library(rows, name, spaced):
    encoder = LibraryEncoder(P.path(name))
    rng = random.Random(9)
    texts = [t or "" for _, t in rows] + ["".join(rng.choice("ab  \n\té'sßñ漢12 .,!-_\x1c\x85") for _ in range(rng.randint(0, 50))) for _ in range(800)]
    texts += ["<|endoftext|> a <|startoftext|>", "Word, word. WORD! 'S it's", " lead", "trail ", "a  b"]
    ids = [np.frombuffer(x, dtype=np.int32).tolist() for x in PieceCache(encoder, spaced).encode(texts)]
    assert ids == [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_packing(spark, docs, rows, empty):
    path = P.path("word_bpe_49k.json")
    whole = LibraryEncoder(path)
    want = {i: [*whole._whole([t or ""])[0], 2] for i, t in rows}
    limits = (256, 8, 256)
    out = packing.pack_documents(docs, path, limits=limits).collect()
    pieces, seqs = defaultdict(list), defaultdict(list)
    for r in out:
        ids = np.frombuffer(r["ids"], dtype="<u4").tolist()
        assert len(ids) == r["length"] and r["doc_tokens"] == len(want[r["doc_id"]])
        pieces[r["doc_id"]].append((r["start"], ids))
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
    assert {i: [x for _, p in sorted(v) for x in p] for i, v in pieces.items()} == want
    pad = 0
    for parts in seqs.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))]
        total = sum(n for _, n in parts)
        assert total <= 256 and len(parts) <= 8
        pad += 0 if total & (total - 1) == 0 else 256 - total
    assert pad <= 0.15 * sum(map(len, want.values()))  # short limits and few documents; SLACK is an eighth here
    assert packing.pack_documents(empty, path).count() == 0


def test_packer_keeps_all_limits():
    rng = random.Random(4)
    items = []
    for k in range(300):
        n = rng.randint(1, 150)
        items.append((k, 0, n, rng.randint(0, n)))
    p = packing.Packer((100, 4, 40), slack=5)
    done = [*p.pack(items), *p.rest()]
    assert all(sum(x[2] for x in s) <= 100 and len(s) <= 4 for s in done)
    assert all(sum(x[3] for x in s) <= 40 for s in done)
    assert Counter({k: n for k, _, n, _ in items}) == sum((Counter({x[0]: x[2]}) for s in done for x in s), Counter())


def test_packer_short_pieces_need_little_padding():
    for limits, tokens in (((4096, 256, 4096), 11), ((4096, 8, 4096), 300), ((4096, 256, 500), 90)):
        p = packing.Packer(limits)
        done = [s for b in range(3) for s in p.pack([(b * 2000 + k, 0, tokens, tokens) for k in range(2000)])] + [*p.rest()]
        sizes = [sum(x[2] for x in s) for s in done]
        assert sum(sizes) == 6000 * tokens
        assert all(len(s) <= limits[1] and sum(x[3] for x in s) <= limits[2] for s in done)
        assert sum(0 if n & (n - 1) == 0 else 4096 - n for n in sizes) <= 0.05 * sum(sizes)


def test_packer_takes_the_best_dot_product():
    """Without cuts the order is that of an exhaustive search over single pieces."""
    rng = random.Random(9)
    items = [(k, 0, n := rng.randint(1, 40), rng.randint(0, n)) for k in range(60)]
    limits, p = (10**6, 10**6, 10**6), packing.Packer((10**6, 10**6, 10**6))
    assert list(p.pack(items)) == []
    left, pool, order = np.array(limits, dtype=float), list(items), []
    total = np.array([(t, 1, loss) for _, _, t, loss in items], dtype=float).sum(axis=0) / limits
    scale = total / total.max() / np.array(limits, dtype=float) ** 2
    while pool:
        score = [np.array((t, 1, loss)) @ (scale * left) for _, _, t, loss in pool]
        best = pool.pop(int(np.argmax(score)))
        order.append(best)
        left -= (best[2], 1, best[3])
    assert [x[2:] for x in p.open] == [x[2:] for x in order]


def test_packing_prompts_bear_no_loss(spark):
    path = P.path("word_bpe_49k.json")
    whole = LibraryEncoder(path)
    texts = [(1, "what is a cow", "an animal that gives milk"), (2, None, "only an answer"), (3, "no answer", None), (4, "long prompt " * 90, "long answer " * 60), (None, "", "")] * 4
    docs = spark.createDataFrame(texts, "id int, prompt string, text string").coalesce(1)
    limits = (64, 6, 20)
    out = packing.pack_documents(docs, path, "id", limits=limits, slack=4, prompt_col="prompt").collect()
    seqs, got, loss = defaultdict(list), Counter(), Counter()
    bare = {i: (len(whole._whole([p or ""])[0]), len(whole._whole([t or ""])[0]) + 1) for i, p, t in texts}
    for r in out:
        before, after = bare[r["id"]]
        assert r["doc_tokens"] == before + after
        assert r["loss_tokens"] == max(0, r["start"] + r["length"] - max(before, r["start"]))
        got[r["id"]] += r["length"]
        loss[r["id"]] += r["loss_tokens"]
        seqs[r["sequence_id"]].append(r)
    assert got == {i: 4 * sum(n) for i, n in bare.items()} and loss == {i: 4 * n[1] for i, n in bare.items()}
    for s in seqs.values():
        assert sum(r["length"] for r in s) <= 64 and len(s) <= 6 and sum(r["loss_tokens"] for r in s) <= 20


def test_token_files(spark, docs, rows, empty, tmp_path):
    path, whole = P.path("byte_bpe_50k.json"), LibraryEncoder(P.path("byte_bpe_50k.json"))
    token_files.write(docs, str(tmp_path / "f"), path, shard_ids=3000)
    start, want = 0, []
    for i, t in sorted(rows):
        ids = [*whole._whole([t or ""])[0], 2]
        want.append((i, start, np.array(ids, dtype="<u4").tobytes()))
        start += len(ids)
    back = token_files.read(spark, str(tmp_path / "f"))
    assert sorted((r["doc_id"], r["start"], bytes(r["ids"])) for r in back.collect()) == want
    token_files.write(empty, str(tmp_path / "e"), path)
    assert token_files.read(spark, str(tmp_path / "e")).count() == 0
    flat = np.concatenate([np.frombuffer(w[2], dtype="<u4") for w in want]).astype(np.int32)
    first = np.concatenate([[0], np.cumsum([len(w[2]) // 4 for w in want])])
    s, at, rules, lengths = token_files.re_pair(flat, first, 50257, least=4)
    assert len(rules) and len(s) < len(flat)
    shard = token_files.Shard({"base": 50257, "width": 4, "n_ids": len(flat), "symbols": s.astype("<u4").tobytes(), "doc_at": at.astype("<u4").tobytes(), "rules": rules.astype("<u4").tobytes(), "lengths": lengths.astype("<u4").tobytes()})
    for a, n in ((0, 1), (17, 300), (len(flat) - 5, 50), (len(flat), 3)):
        assert shard.read_ids(a, n).tolist() == flat[a : a + n].tolist()
    assert [shard.document(k).tolist() for k in range(len(want))] == [np.frombuffer(w[2], dtype="<u4").tolist() for w in want]


def test_context_mixing(spark, docs, rows, empty):
    train = docs.where("doc_id % 5 != 0 OR doc_id IS NULL")
    counts = context_mixing.count(train, id_col="doc_id")
    model = context_mixing.fit(counts)
    base = context_mixing.unigram(docs.select("doc_id", "text"), counts, top_words=7)  # few: others go through the join
    c, ends = Counter(), 0
    for i, t in rows:
        if i % 5:
            c.update(WORD.findall((t or "").encode().translate(LOW)))
            ends += 1
    n, v = sum(c.values()) + ends, len(c) + 1
    for r in base.collect():
        w = WORD.findall((dict(rows)[r["doc_id"]] or "").encode().translate(LOW))
        want = sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w) + math.log10((ends + 1) / (n + v + 1))
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(w) + 1, sum(c[x] > 0 for x in w) + 1, n)
        assert r["base_score"] == pytest.approx(want)
    scored = context_mixing.score(docs, model).select("doc_id", "bits", "n_bytes").collect()
    for r in scored:
        w = WORD.findall((dict(rows)[r["doc_id"]] or "").encode().translate(LOW))
        assert r["n_bytes"] == sum(len(x) + 1 for x in w) + 1 and r["bits"] > 0
    assert context_mixing.score(empty, model).count() == 0
    # the bytes that may follow a context share a probability of one
    key, so_far, _ = context_mixing.byte_strings(next(words.blocks(pa.array(["the quick"]))).split_words())
    every = np.arange(256, dtype=np.uint64)
    for k, s in zip(key, so_far):
        bits = model.bits((k & ~np.uint64(0xFF)) | every, np.full(256, s))
        assert np.exp2(-bits.astype(np.float64)).sum() == pytest.approx(1, abs=1e-3)
    none = context_mixing.fit(context_mixing.count(empty))
    assert context_mixing.score(docs, none).count() == len(rows)


def test_context_mixing_beats_order_zero_on_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = context_mixing.fit(context_mixing.count(docs.where("doc_id % 7 != 2"), id_col="doc_id"))
    r = context_mixing.score(docs.where("doc_id % 7 = 2"), model).agg((F.sum("bits") / F.sum("n_bytes")).alias("b")).first()
    assert r["b"] < 3.0  # letters alone take more than four bits


def test_context_mixing_tables_hold_every_pair_apart(spark):
    """Slots of their own however many contexts there are; contexts not seen find nothing."""
    rng = np.random.default_rng(1)
    name = np.unique(rng.integers(0, 2**63, 40_000, dtype=np.uint64) << np.uint64(1))
    table = context_mixing.Table(1)
    table.slots[:] = context_mixing._fill(name, np.zeros(len(name), dtype=np.int64), np.full(len(name), 2))
    assert np.count_nonzero(table.slots) == len(name) and (table.find(name) != 0).all()
    other = np.setdiff1d(rng.integers(0, 2**63, 40_000, dtype=np.uint64), name)
    assert (table.find(other) != 0).mean() < 0.005
    # sums by pair against a count of the bits after each context
    texts = ["".join(random.Random(i).choices("abcdefgh ", k=3000)) for i in range(30)]
    counts = context_mixing.count(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), id_col="doc_id")
    got = context_mixing.pairs(counts)
    want, after = Counter(), defaultdict(lambda: [0, 0])
    for t in texts:
        data = b"\n" * 5 + b"".join(w + b" " for w in t.encode().split()) + b"\n"
        for i in range(5, len(data)):
            for depth in range(8):
                for k in range(1, 6):
                    after[k, data[i - k : i], 1 << depth | data[i] >> 8 - depth][data[i] >> 7 - depth & 1] += 1
    for k, _, _ in after:
        want[k] += 1
    assert {r["k"]: r["count"] for r in got.where("k < 6").groupBy("k").count().collect()} == dict(want)
    sums = Counter((r["k"], r["z"], r["o"]) for r in got.where("k < 6").collect())
    assert sums == Counter((k, z, o) for (k, _, _), (z, o) in after.items())
    tables = context_mixing._tables(got)
    assert {k: np.count_nonzero(t.slots) for k, t in tables.items() if k < 6} == dict(want)
    # more contexts, more slots
    assert len(tables[5].slots) >= want[5] / context_mixing.LOAD > len(tables[1].slots)


def test_context_mixing_learns_from_a_tenth_at_any_size(spark):
    """2.4 GB of text, of which more than 48 MB take part; also of few rows."""
    for rows, size in ((4000, 200_000), (4000, 1)):
        big = spark.range(rows).select(F.col("id").alias("doc_id"), F.repeat(F.lit("ab "), F.lit(size)).alias("text"))
        assert context_mixing.marked(big, id_col="doc_id").where("mix").count() == pytest.approx(rows / 10, rel=0.2)


def test_quality_measures(spark, docs, rows):
    out = {r["doc_id"]: r for r in quality_rules.measure(docs).collect()}
    for i, t in rows:
        t = t or ""
        w = WORD.findall(t.encode())
        windows = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        hit = {j for k in range(len(w) - 4) if windows[tuple(w[k : k + 5])] > 1 for j in range(k, k + 5)}
        lines = [x for x in t.split("\n") if WORD.search(x.encode())]
        want = (len(w), sum(len(x.decode()) for x in w), sum(t.count(x) for x in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit), len(lines))
        assert tuple(out[i][c] for c in quality_rules.MEASURES[:6]) == want, i


def test_quality_cutoffs_and_bounds(spark, docs, empty):
    assert quality_rules.binomial_cdf(2, 10, 0.3) == pytest.approx(sum(math.comb(10, k) * 0.3**k * 0.7 ** (10 - k) for k in range(3)))
    good, bad = [0] * 201, [0] * 201
    good[0], good[30], bad[0], bad[150] = 3000, 3, 100, 400
    c = quality_rules.choose_cutoff(good, bad, 0.01, 0.01)
    assert 30 < c <= 150  # rejects the bad ones, none of the good ones
    assert quality_rules.choose_cutoff([20] + [0] * 200, bad, 0.01, 0.01) is None  # too few labels for the bound
    assert quality_rules.choose_cutoff(good, [0] * 201, 0.01, 0.01) is None  # nothing to gain
    labels = spark.createDataFrame([(0, 1), (0, 0), (1, None), (None, 1)], "doc_id long, quality int")
    out = quality_rules.quality_rules(docs, labels)
    assert out.count() == docs.count() and out.where("base_failed AND kept").count() == 0
    assert quality_rules.quality_rules(empty, labels).count() == 0
    judged = quality_rules.judge(quality_rules.measure(docs), {"en": {"symbols": 1}, None: {"upper": 1}}, "lang")
    symbols = judged.where("lang = 'en' AND n_symbols * 200 >= word_chars AND n_symbols > 0")
    assert symbols.count() == symbols.where(F.array_contains("broken_rules", "symbols")).count()


def test_quality_guarantee_on_simulated_labels():
    """Over many draws the chosen cutoff breaks the bound no more often than delta allows."""
    rng, broken = np.random.default_rng(2), 0
    truth = np.array([0.97] + [0.03 / 50] * 50 + [0] * 150)
    for _ in range(200):
        good = rng.multinomial(2000, truth).tolist()
        bad = rng.multinomial(500, [0.3] + [0.014] * 50 + [0] * 150).tolist()
        c = quality_rules.choose_cutoff(good, bad, 0.02, 0.05, good_weight=0.01)
        broken += c is not None and truth[c:].sum() > 0.02
    assert broken <= 20


def _measured(rng, stratum, n_good, n_bad, first):
    """Rows of (id, stratum, good, scores of two rules in bins): bad ones break one of two rules."""
    out = []
    for i in range(n_good + n_bad):
        good, at = i < n_good, rng.integers(2)
        score = rng.integers(0, 20, 2)
        if not good:
            score[at] = rng.integers(60, 120)
        out.append((first + i, stratum, int(good), *(int(x) for x in score)))
    return out


def test_quality_small_strata_get_cutoffs(spark):
    """300 good labels bound the union of the rules in each of four strata, also without
    documents that have no label; 100 don't."""
    rng, rows = np.random.default_rng(4), []
    for i, (s, n) in enumerate((("en", 3000), ("de", 300), (None, 300), ("es", 100))):
        rows += _measured(rng, s, n, 60, 10_000 * i)
    table = spark.createDataFrame(rows, "doc_id long, lang string, quality int, n_symbols long, n_marks long").selectExpr(
        "*", "200L AS word_chars", "50L AS n_words", "0L AS n_dup_lines", "0L AS n_repeat_words", "0L AS n_upper", "10L AS n_lines"
    )
    cutoffs = quality_rules.fit(table, table.select("doc_id", "quality"), "doc_id", "lang")
    assert cutoffs["es"] == {} and all(set(cutoffs[s]) == {"symbols", "marks"} for s in ("en", "de", None))
    judged = quality_rules.judge(table, cutoffs, "lang")
    r = {x["lang"]: x for x in judged.where("lang IS NULL OR lang <> 'es'").groupBy("lang").agg(F.sum(F.expr("int(kept AND quality = 0)")).alias("b"), F.sum(F.expr("int(NOT kept AND quality = 1)")).alias("g")).collect()}
    assert all(x["b"] == 0 and x["g"] == 0 for x in r.values()) and len(r) == 3


def test_quality_path_is_nested_and_blind_to_good_labels():
    rng = np.random.default_rng(3)
    bad, reference = rng.poisson(0.3, (5, 201)), rng.poisson(1, (5, 201))
    path = quality_rules.choose_path(bad, reference)
    for r in range(5):
        own = [c for x, c in path if x == r]
        assert own == [c for c in range(200, 0, -1) if bad[r, c]]


def test_language_id(spark, docs, empty):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = language_id.fit(table, train=~held)
    out = language_id.identify(table.where(held), model)
    n, right = out.count(), out.where("lang_pred = lang").count()
    assert right >= 0.95 * n
    odd = language_id.identify(docs, model).collect()
    for r in odd:
        if not any(c.isalpha() for c in r["text"] or ""):
            assert (r["lang_pred"], r["score"], r["accepted"]) == ("und", 0.0, False)
        else:
            assert r["lang_pred"] in model["langs"] and 0 <= r["score"] <= 1
    assert language_id.identify(empty, model).count() == 0
    assert {r["lang_pred"] for r in language_id.identify(docs, language_id.fit(empty)).collect()} == {"und"}


def test_kneser_ney_sums_to_one_and_matches_formula():
    blocks = words.blocks(pa.array(["banana bandana ban", "Cabana"]))
    key = np.concatenate([language_id.keys_of(b)[0] for b in blocks])
    model = language_id.fit_counts(key)
    last = np.arange(1 << language_id.BITS, dtype=np.uint64)
    for k in key[:12]:
        context = (k >> np.uint64(12)) << np.uint64(12)
        assert np.exp2(language_id.log_probs(model, context | last)).sum() == pytest.approx(1)


def test_html_extract(spark):
    weights = html_extract.Weights({})
    page = """<html><head><title>t</title><script>var a="</p>"</script></head><body><header><h1>Site</h1></header>
    <div id="cookie-notice">We use cookies</div><nav><a href=x>Home</a></nav><div class="content"><h2>Real   title</h2>
    <p>First <a href="q">link</a> &eacute;&amp;&#33;.<p>Second one<br>line<div class="ad">Buy now</div><ul><li>one here<li>two here</ul>
    <aside>Side</aside><p>Last of it.</p></div><section class="comments"><article class="comment"><p>a reader says a lot of words here</p></article></section>
    <form><label>mail</label></form><footer>&copy; 2020</footer></body></html>"""
    want = "Real title\n\nFirst link é&!.\n\nSecond one line\n\none here\n\ntwo here\n\nLast of it."
    assert html_extract.main_text(page, weights) == want
    assert html_extract.best_region([-1.0, 2, -1, 3, -5, 4]) == (1, 4) and html_extract.best_region([-1.0]) == (0, 0)
    table = spark.createDataFrame([(1, "u", page, "x"), (2, None, None, "y"), (None, "u", "", "z"), (4, "u", "just words", "w")], "page_id long, url string, html string, text string")
    out = html_extract.extract(table, html_extract.fit(table))
    assert sorted((r["page_id"] or 0, r["text"], r["n_chars"]) for r in out.collect()) == [(0, "", 0), (1, want, len(want)), (2, "", 0), (4, "just words", 10)]


@pytest.mark.parametrize(
    "middle,words",
    [
        ('<p>one</p><svg class="i"/><p>two</p><p>three</p>', "one two three"),
        ("<p>one</p><svg/><p>two</p><svg><text>no</text></svg><p>three</p>", "one two three"),
        ("<p>one <svg><path d='x'><text>no</text></p><p>two</p>", "one two"),  # ended by its parent
        ("<p>one</p><svg><g><text>no</text><p>two</p>", "one two"),  # a paragraph ends svg
        ("<p>one <a href=x><svg><path></a> two</p>", "one two"),
        ("<p>one</p><svg><foreignObject><p>no</p></foreignObject></svg><p>two</p>", "one two"),
        ("<p>one</p><svg><title/><style/><text>no</text></svg><p>two</p>", "one two"),
        ("<div><button>no <button>no</button></div><p>one</p><div><select><option>no</div><p>two", "one two"),
        ("<div><noscript><p>no</p></div><p>one</p><math><mi>no</mi></math><video src=x>no</video> two", "one two"),
        ("<p>one</p><script>if (a < b) no</script><p>two</p><textarea>no <p>no", "one two"),
    ],
)
def test_html_elements_left_out_take_nothing_with_them(middle, words):
    got = " ".join(r.text for r in html_extract.read_page(f"<article>{middle}</article>"))
    assert " ".join(got.split()) == words


def test_html_extract_on_all_pages(spark):
    """The articles of the test pages, cut out by their own markup."""
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    out = {r["page_id"]: r["text"] for r in html_extract.query(spark, "/root/testdata/sf0.001").collect()}
    for r in pages.collect():
        inner = r["html"].split("<article>")[1].split("</article>")[0]
        inner = re.sub(r"</?b>", "", inner.replace("<br>", " "))
        blocks = (" ".join(html.unescape(x).split()) for x in re.split(r"<[^>]*>", inner))
        assert out[r["page_id"]] == "\n\n".join(x for x in blocks if x)


def test_context_mixing_gives_its_disk_back(spark, monkeypatch):
    """The learned tables are sent out once for both passes, and neither they nor the pairs stay."""
    docs = spark.createDataFrame([(i, f"a text of a few words, number {i % 7}") for i in range(60)], "doc_id long, text string")
    sent, gone, stored = [], [], []
    real, keep = spark.sparkContext.broadcast, context_mixing.stored

    def broadcast(value):
        bc = real(value)
        sent.append(bc)
        end = bc.destroy
        bc.destroy = lambda *a: (gone.append(bc), end(*a))[1]
        return bc

    counts = context_mixing.count(docs, id_col="doc_id")
    monkeypatch.setattr(spark.sparkContext, "broadcast", broadcast)
    monkeypatch.setattr(context_mixing, "stored", lambda df: (stored.append(keep(df)), stored[-1])[1])
    model = context_mixing.fit(counts)
    assert len(sent) == 1 and gone == sent and model.tables
    paths = {f.rsplit("/", 1)[0] for df in stored for f in df.inputFiles()}
    assert len(paths) == len(stored) == 3 and not any(path_exists(spark, p) for p in paths)


def test_pipeline_stages_by_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").withColumn("_gone", F.lit(1))
    now = docs
    model = language_id.fit(docs)
    want = [(r["doc_id"], r["text"]) for r in language_id.identify(docs, model).where("accepted").collect()]
    for name, stage in corpus_pipeline.STAGES[:4]:
        now = spark.createDataFrame(stage(spark, now, "").collect(), docs.schema)
        if name == "exact_dedup":
            last = {(t or "").translate({c: c + 32 for c in range(65, 91)}): i for i, t in sorted(want)}
            want = [(i, t) for i, t in want if i in set(last.values())]
        elif name == "near_dedup":
            stay = {i for i, c, _ in _brute_join(want) if i == c}
            want = [(i, t) for i, t in want if i in stay]
        elif name == "suffix_dedup":
            kept = {i: (gone, sha) for i, _, gone, _, sha in _brute_repeats(want, 400)}
            for r in now.collect():
                gone, sha = kept[r["doc_id"]]
                if hashlib.sha256(r["text"].encode()).hexdigest() != sha:  # a cut through a character leaves it out
                    assert gone and not r["text"].isascii()
                assert r["n_chars"] == len(r["text"])
            want = [(r["doc_id"], r["text"]) for r in now.collect()]
        assert sorted((r["doc_id"], r["text"]) for r in now.collect()) == sorted(want), name
        assert now.columns == docs.columns
    packed = corpus_pipeline.STAGES[4][1](spark, now, "")
    assert packed.agg(F.count_distinct("doc_id")).first()[0] == now.count()


def test_queries_are_registered():
    found = registry.queries()
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in found) == list(range(1, 14))
    assert set(registry.oracle_sql()) == {exact_dedup.NAME, spelling.NAME, prefix_trie.NAME}
    assert zlib.crc32(b"1") >= 0


def test_context_mixing_sends_a_byte_once(monkeypatch):
    """Strings give a row per context and byte, not one per pair; a context cut by the end
    of a batch gives its pairs once."""
    rng = np.random.default_rng(3)
    key = np.unique(rng.integers(97, 101, size=(300, 6)).astype(np.uint64) @ np.array([1 << (8 * j) for j in range(6)], dtype=np.uint64))
    n = rng.integers(1, 9, size=len(key))
    batch = pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n), pa.array(n // 2)], names=["key", "n", "m"])
    sent = pa.Table.from_batches(context_mixing._string_rows(iter([batch])))
    assert sent.num_rows == sum(len(np.unique(key & np.uint64((1 << (8 * k + 8)) - 1))) for k in range(1, 6))
    batches = sent.sort_by([("x", "ascending"), ("b", "ascending")]).combine_chunks().to_batches(max_chunksize=3)
    whole = pa.Table.from_batches(context_mixing._joint_pairs(iter(batches))).to_pylist()
    monkeypatch.setattr(context_mixing, "_some", lambda batches, rows: (pa.Table.from_batches([b]) for b in batches))
    cut = pa.Table.from_batches(context_mixing._joint_pairs(iter(batches))).to_pylist()
    assert len({(r["k"], r["h"]) for r in cut}) == len(cut)
    assert sorted(map(str, cut)) == sorted(map(str, whole))
    for k in range(1, 6):
        top = [r for r in whole if r["k"] == k]
        assert sum(r["z"] + r["o"] for r in top) == 8 * n.sum() and sum(r["zm"] + r["om"] for r in top) == 8 * (n // 2).sum()
