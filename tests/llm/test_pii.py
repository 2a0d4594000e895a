"""Personal data: fixed patterns against plain regular expressions, the model's sums and
best paths against enumeration, its accuracy on windows it never saw, edge cases."""

import hashlib
import random
import re
import time

import numpy as np
import pytest

from conftest import SF_SMALL
from cropledger.llm import pii as M

SF = "/root/testdata/sf0.01"


def plain(text):
    """The contract's patterns as they stand."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((0, *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append((1, *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m.group() if c.isdigit()]
        if 13 <= len(d) <= 19 and (sum(d[-1::-2]) + sum(sum(divmod(2 * x, 10)) for x in d[-2::-2])) % 10 == 0:
            out.append((2, *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append((3, *m.span()))
    return out


def samples(n, seed=4):
    rng = random.Random(seed)
    bits = ["a", "é", "@", ".", "-", " ", "+", "(", ")", "1", "22", "255", "256", "0", "4111111111111111", "x.y", "@mail.com", "%", "_", "+1 (651) 555-8500", "10.0.0.1", "at", " dot ", "\n", "007"]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(0, 24))) for _ in range(n)]


def test_base_equals_plain_patterns():
    for text in [*samples(6000), "a@b.c_d@e.f", "a@b.c@d.e", "1.2.3.4.5.6.7.8.9", "1..2.3.4.5", "0001.2.3.00255", "a.b@c..d", "@x.y", "1.2.3.4444"]:
        assert M.base_spans(text) == plain(text), text


def test_texts_that_defeat_plain_patterns_take_linear_time():
    start = time.time()
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "+1" + "(" * 300_000, "a@" * 100_000, "1 " * 60_000, "a.b at " * 30_000):
        M.find(text, M.Model({}, np.zeros((5, 5))))
    assert time.time() - start < 60


def paths(lattice):
    """All paths as lists of edge numbers."""
    def go(at):
        if at == len(lattice.points) - 1:
            yield []
        for j, (a, b, _, _) in enumerate(lattice.edges):
            if a == at:
                for rest in go(b):
                    yield [j, *rest]

    return list(go(0))


def path_score(lattice, path, model):
    label = total = 0
    for j in path:
        _, _, y, features = lattice.edges[j]
        total += model.score(features) + model.follows[label, y]
        label = y
    return total


def small_lattices():
    texts = ["call +1 (651) 555-8500 x", "10.0.0.1 4111 1111 1111 1111", "jane.doe at mail dot example dot org", "555-1234 555-9876", "a.b@c.de 1234567"]
    return [x for t in texts for x in M.lattices(t) if len(x.edges) < 60]


def test_best_path_and_sums_equal_enumeration():
    rng = np.random.default_rng(2)
    found = small_lattices()
    assert len(found) >= 5
    names = sorted({f for x in found for e in x.edges for f in e[3]})
    w, follows = rng.normal(size=len(names)), rng.normal(size=(5, 5))
    model = M.Model(dict(zip(names, w.tolist())), follows)
    batch = M.Batch(found, {f: i for i, f in enumerate(names)})
    z, edge, pairs = batch.expect(w, follows)
    total_pairs = np.zeros((5, 5))
    for r, lattice in enumerate(found):
        every = paths(lattice)
        scores = np.array([path_score(lattice, p, model) for p in every])
        top = scores.max()
        sums = np.exp(scores - top)
        assert np.isclose(z[r], np.log(sums.sum()) + top)
        chance = np.zeros(len(lattice.edges))
        for p, s in zip(every, sums / sums.sum()):
            chance[p] += s
            label = 0
            for j in p:
                total_pairs[label, lattice.edges[j][2]] += s
                label = lattice.edges[j][2]
        assert np.allclose(edge[r, : len(chance)], chance)
        best = every[int(scores.argmax())]
        assert model.best(lattice) == [(lattice.edges[j][2] - 1, lattice.points[lattice.edges[j][0]], lattice.points[lattice.edges[j][1]]) for j in best if lattice.edges[j][2]]
    assert np.allclose(pairs, total_pairs)


@pytest.fixture(scope="module")
def model(spark):
    return M.train(spark.read.parquet(f"{SF}/documents.parquet"))


def test_accuracy_on_unseen_variants(spark, model):
    """Windows of another table, rewritten: the spans found against those planted."""
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("text").where("text rlike '[0-9@]' and doc_id > 2000").collect()]
    rng = random.Random(8)
    windows = [w for t in texts[:400] for _, _, w, spans in M._windows(t) for w in M.variants(w, spans, rng)]
    assert len(windows) > 1500
    hit = wrong = missed = 0
    for text, spans in windows:
        base, added = M.find(text, model)
        got, want = set(base) | set(added), set(spans)
        hit, wrong, missed = hit + len(got & want), wrong + len(got - want), missed + len(want - got)
    assert hit / (hit + wrong) > 0.97 and hit / (hit + missed) > 0.97


def test_model_keeps_near_misses_out(model):
    for text in ("pay 4111 1111 1111 1112 now", "version 3.1.22.400 of it", "order 12345678 shipped", "the 2024-12-31 or 12/31/2024", 'token = "cb1a9fee807a05366fcb8b6c95c7c565ede51a72"', "look at example. Com is", "version 3."):
        assert M.find(text, model) == ([], []), text
    assert [s[0] for s in M.find("call (651) 555-8500 or mail jane at example dot com", model)[1]] in ([3, 0], [0, 3])


def test_nulls_clashes_and_empty(spark, model):
    rows = [(1, "a@b.cd"), (1, "a@b.cd"), (2, None), (3, ""), (None, "+1 (651) 555-8500"), (5, "x" * 100_000 + " a@b.cd"), (6, "𝄞𝄞 10.0.0.1")]
    docs = spark.createDataFrame([(i, t, "c", 1) for i, t in rows], "doc_id long, text string, found string, c0 int")
    got = M.find_private(docs, model)
    assert got.columns == ["doc_id", "c0", "found"]
    spans = sorted((str(r.doc_id), [(s.kind, s.start, s.end, s.base) for s in r.found]) for r in got.collect())
    assert spans == sorted([("1", [("email", 0, 6, True)])] * 2 + [("2", []), ("3", []), ("None", [("phone", 0, 17, True)]), ("5", [("email", 100_001, 100_007, True)]), ("6", [("ip", 3, 11, True)])])
    none = docs.where("doc_id > 99")
    assert M.train(none) is None and M.find_private(none, None).collect() == []
    assert M.find("a@b.cd (651) 555-8500", None) == ([(0, 0, 6)], [])


def test_query_equals_plain_patterns(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    rows = M.query(spark, SF_SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = plain(texts[r.doc_id])
        written = [f"{M.KINDS[k]}:{s}:{e}" for k, s, e in base]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(b[0] == k for b in base) for k in range(4)]
        assert r.base_sha256 == hashlib.sha256(",".join(written).encode()).hexdigest()
        assert set(written) <= set(r.spans.split(",")) | {""}
