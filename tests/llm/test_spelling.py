"""Spelling variants against brute force: exact near words, forms, roots, planted deletions."""

import random
import re
import zlib
from collections import Counter

import duckdb
import pytest

from conftest import SF_SMALL
from cropledger.llm import spelling as M

SCHEMA = "doc_id long, text string, word string, n long, key string, root string"


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def counts(rows, planted):
    out = Counter()
    for key, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if c < "\x80" else c for c in w)
            h = zlib.crc32(f"{'' if key is None else key}:{w}".encode())
            if planted and h % planted == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            out[w] += 1
    out.pop("", None)
    return out


def brute(counted):
    words = {w: n for w, n in counted.items() if len(w) >= 5 and n >= 3}
    found = {}
    for w, n in words.items():
        others = sorted(((-words[v], v) for v in words if near(w, v)))
        form = others[0][1] if others and -others[0][0] >= 2 * n else None
        found[w] = (form, len(others))
    out = []
    for w, (form, k) in found.items():
        root = w
        while found[root][0]:
            root = found[root][0]
        out.append((w, form, root, words[w], k, words[form] if form else None))
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    letters = "abcdeéÉß×"
    stems = ["".join(rng.choice(letters) for _ in range(rng.randint(4, 9))) for _ in range(60)]
    texts = []
    for i in range(150):
        some = []
        for _ in range(60):
            w = rng.choice(stems)
            if rng.random() < 0.4:
                at = rng.randrange(len(w))
                w = rng.choice([w[:at] + w[at + 1 :], w[:at] + rng.choice(letters) + w[at:], w[:at] + rng.choice(letters) + w[at + 1 :]])
            some.append(w.upper() if rng.random() < 0.1 else w)
        texts.append(rng.choice([" ", "-", "1", "\n"]).join(some))
    chain = ["abcdefgh", "abcdefgx", "abcdefyx", "abcdezyx", "abcdwzyx"]  # counts 48, 24, 12, 6, 3: roots over four forms
    texts += [" ".join(w for i, w in enumerate(chain) for _ in range(48 >> i))]
    texts += [None, "", "  ", "aaaaa aaaaa aaaaa aaaaaa aaaaaa aaaaaa", "q" * 5000 + " " + "q" * 5001, ("q" * 5000 + " ") * 3, ("q" * 5001 + " ") * 3, "same one", "same one"]
    out = list(enumerate(texts))
    return out + [(3, "shares its idents"), (3, "shares its idents"), (None, "shares null idents"), (None, "shares null idents")]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "w", 1, "k", "r") for i, t in rows], SCHEMA).repartition(4)


def result(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("planted", [0, 3, 97])
def test_groups_equal_brute_force(spark, rows, planted):
    counted = M.word_counts(frame(spark, rows), planted=planted)
    assert result(M.spelling_groups(counted)) == brute(counts(rows, planted))


@pytest.mark.parametrize("symbols, bits", [(1, 1 << 15), (2, 1 << 20)])
def test_alphabet_and_filter_change_no_result(spark, rows, symbols, bits):
    counted = M.word_counts(frame(spark, rows[60:]), planted=0)
    assert result(M.spelling_groups(counted, symbols=symbols, bits=bits)) == brute(counts(rows[60:], 0))


def test_neighbourhood_is_full_and_without_repeats():
    rng = random.Random(1)
    for n in (1, 2, 5, 9):
        word = "".join(rng.choice("012") for _ in range(n))
        edits = {word}
        edits |= {word[:i] + word[i + 1 :] for i in range(n)}
        edits |= {word[:i] + a + word[i + 1 :] for i in range(n) for a in "012"}
        edits |= {word[:i] + a + word[i:] for i in range(n + 1) for a in "012"}
        for part in (3, 1 << 18):
            made = [int(k) for keys in M.neighbours(word, 3, part) for k in keys]
            assert sorted(made) == sorted(int(M.reduced_key(e)[0]) for e in edits)


def test_empty_table(spark):
    assert result(M.spelling_groups(M.word_counts(frame(spark, [(1, None)]).where("doc_id > 1")))) == []


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_SMALL}/documents.parquet')")
    df = M.query(spark, SF_SMALL)
    rel = con.sql(M.ORACLE)
    assert rel.columns == df.columns
    assert result(df) == sorted(rel.fetchall())
