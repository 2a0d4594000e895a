"""Personal data by a semi-Markov conditional random field (operator 12).

``base_spans`` finds the spans that fixed patterns define (email, ip, card, phone); they
always stay. The model adds spans that the patterns miss: addresses written with
``(at)`` and ``dot``, numbers without ``+`` or with other separators. Candidates are
whole spans over tokens (runs of digits with separators; local part, at, labels), each
with a bounded number of tokens. A candidate of a kind is scored by features of the
whole span: the lengths of its runs, its separators, Luhn's sum, the range of its parts,
what stands left and right, whether the run goes on. A lattice joins overlapping
candidates; between its positions go the candidates and steps of no entity, and a weight
for each pair of following labels. The best path over (position, last label) chooses
boundaries and kinds jointly; entities are bounded, so the work is linear in the text.

The weights are learned by maximum likelihood (forward-backward over whole lattices, L2
penalty) on a bounded sample: at most ``TRAIN_PER_KIND`` windows around base spans of
each kind, and as many without any, the different ones of the smallest hash over the
whole table.
From every window variants are made by rule, some that are still personal data in
another writing, some that no longer are (a wrong check digit, a part over 255), so the
features of the whole span decide and not the pattern.

Defined cases: a null text is empty and has no spans; a null id stays null; rows that
share an id are texts of their own; without a window of any kind the model adds nothing;
an empty table gives no rows; positions are code points, ends exclusive. All patterns
run in time linear in the text; a text's candidates are held in memory while it is read.
"""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cropledger.llm.words import map_texts

KINDS = ("email", "ip", "card", "phone")
#: Windows of each kind (and without any) that the model is learned from.
TRAIN_PER_KIND = 250
#: Code points kept on each side of a window's spans.
MARGIN = 40
#: Most runs of digits, labels of a domain and written parts of a local part in a span.
MAX_RUNS, MAX_LABELS, MAX_PARTS = 8, 6, 3
#: Passes, step size and L2 penalty of the learning.
PASSES, STEP, PENALTY = 60, 0.25, 0.02
#: Features seen in fewer edges of the sample are left out.
MIN_SEEN = 3

Span = tuple[int, int, int]  # kind, start, end

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_CHAIN = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3,}+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]+")
_GAP = re.compile(r"[ ().\-/ ]{1,3}|\[\.\]|\(\.\)")
_AT = re.compile(r"@| @ | ?[\[({](?:at|@)[\])}] ?| at (?=[A-Za-z0-9-]+(?: dot | ?[\[({](?:dot|\.)[\])}] ?|\.)[A-Za-z0-9])", re.IGNORECASE)
_DOT = re.compile(r"\.| dot | ?[\[({](?:dot|\.)[\])}] ?", re.IGNORECASE)
_LABEL = re.compile("[A-Za-z0-9-]{1,63}")
_PART = re.compile(r"[A-Za-z0-9._%+-]{1,64}\Z")
_WRITTEN_DOT = re.compile(r"(?: dot | ?[\[({](?:dot|\.)[\])}] ?)\Z", re.IGNORECASE)
_ANY = re.compile(r"[0-9@]| at |[\[({]at[\])}]", re.IGNORECASE)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From sign to sign: the local part is the run before it, never searched twice."""
    free, at = 0, text.find("@")
    while at >= 0:
        lo = at
        while lo > free and text[lo - 1] in _LOCAL:
            lo -= 1
        found = _DOMAIN.match(text, at + 1) if lo < at else None
        if found:
            free = found.end()
            yield lo, free
        at = text.find("@", max(at + 1, free))


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for chain in _CHAIN.finditer(text):
        runs = [m.span() for m in _DIGIT.finditer(text, *chain.span())]
        for i in range(0, len(runs) - 3, 4):
            four = runs[i : i + 4]
            if all(e - s <= 3 or not text[s : e - 3].strip("0") for s, e in four) and all(int(text[max(s, e - 3) : e]) <= 255 for s, e in four):
                yield four[0][0], four[3][1]


def base_spans(text: str) -> list[Span]:
    """The spans of the fixed patterns, by kind, then start."""
    out = [(0, s, e) for s, e in _emails(text)]
    out += [(1, s, e) for s, e in _ips(text)]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            d = _digits(m.group())
            if 13 <= len(d) <= 19 and luhn(d):
                out.append((2, *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_digits(m.group())) <= 15:
            out.append((3, *m.span()))
    return out


# --- candidates and their features ------------------------------------------


def _class(text: str, at: int) -> str:
    """Class of the character at a place, for the features left and right of a span."""
    if not 0 <= at < len(text):
        return "edge"
    c = text[at]
    if c.isdigit():
        return "digit"
    if c.isalpha():
        return "letter"
    if c == "\n":
        return "line"
    return "space" if c.isspace() else c if c in "@+-./(),:;\"'=_[]" else "sign"


def _around(text: str, start: int, end: int) -> list[str]:
    left, right = _class(text, start - 1), _class(text, end)
    return [f"left={left}", f"right={right}", f"left2={left},{_class(text, start - 2)}", f"right2={right},{_class(text, end + 1)}"]


def _numbers(text: str) -> Iterator[tuple[int, int, tuple[int, ...], list[str]]]:
    """Spans over runs of digits: ``start, end, kinds, features``."""
    runs = [m.span() for m in _DIGIT.finditer(text)]
    gaps = []  # text between a run and the next, if it may lie within a span
    for (_, a), (b, _) in zip(runs, runs[1:]):
        gaps.append(text[a:b] if b - a <= 3 and _GAP.fullmatch(text, a, b) else None)
    for i, (start, _) in enumerate(runs):
        total = 0
        for j in range(i, min(len(runs), i + MAX_RUNS)):
            if j > i and gaps[j - 1] is None:
                break
            total += runs[j][1] - runs[j][0]
            if total > 19:
                break
            sizes = [e - s for s, e in runs[i : j + 1]]
            quad = len(sizes) == 4 and max(sizes) <= 3
            if total < 7 and not quad:
                continue
            end = runs[j][1]
            inner = gaps[i:j]
            kinds = (1, 2, 3) if quad else (2, 3)
            shape = [
                "lens=" + "-".join(map(str, sizes)),
                f"digits={total}",
                f"runs={len(sizes)}",
                "gaps=" + "|".join(sorted(set(inner))),
                f"even={len(set(inner)) < 2}",
                f"more={i > 0 and gaps[i - 1] is not None},{j < len(gaps) and gaps[j] is not None}",
            ]
            if 13 <= total <= 19:
                shape.append(f"luhn={luhn(_digits(text[start:end]))}")
            if quad:
                parts = [text[s:e] for s, e in runs[i : j + 1]]
                shape.append(f"bytes={all(int(p) <= 255 and str(int(p)) == p for p in parts)},{'|'.join(sorted(set(inner)))}")
            for lead in ("", "+", "(", "+("):
                if lead and not (start >= len(lead) and text.startswith(lead, start - len(lead))):
                    continue
                at = start - len(lead)
                ahead = text[at - 1] if at and text[at - 1] in "+(" else ""
                opened = text.count("(", at, end) - text.count(")", at, end)
                yield at, end, kinds, [*shape, f"lead={lead},{ahead}", f"lead+digits={lead},{total}", f"opened={opened}", *_around(text, at, end)]


def _addresses(text: str) -> Iterator[tuple[int, int, tuple[int, ...], list[str]]]:
    """Spans of local part, at and domain: ``start, end, kinds, features``."""
    for sign in _AT.finditer(text):
        starts = []
        at = sign.start()
        for k in range(MAX_PARTS):
            part = _PART.search(text, max(0, at - 64), at)
            if not part:
                break
            starts.append((part.start(), k))
            if not k and "." in part.group():
                starts.append((part.start() + part.group().rindex(".") + 1, -1))
            joint = _WRITTEN_DOT.search(text, max(0, part.start() - 8), part.start())
            if not joint:
                break
            at = joint.start()
        ends, dots, at = [], [], sign.end()
        for k in range(MAX_LABELS):
            label = _LABEL.match(text, at)
            if not label:
                break
            dot = _DOT.match(text, label.end())
            goes_on = bool(dot and _LABEL.match(text, dot.end()))
            ends.append((label.end(), k + 1, label.group(), tuple(dots), goes_on))
            if not goes_on:
                break
            dots.append(dot.group().strip().lower())
            at = dot.end()
        form = f"{sign.group().strip().lower()},{sign.group().startswith(' ')}"
        for (start, parts), (end, labels, last, joints, goes_on) in product(starts, ends):
            if start >= sign.start():
                continue
            top = "digit" if last.isdigit() else "alpha" if last.isalpha() and last.isascii() else "mixed"
            yield start, end, (0,), [
                f"at={form}",
                f"labels={min(labels, 4)}",
                f"labels+at={min(labels, 2)},{form}",
                f"top={top},{min(len(last), 5)}",
                "dots=" + "|".join(sorted(set(joints))),
                f"parts={parts}",
                f"more={goes_on}",
                f"cut={_class(text, start - 1) in '.-+_' or _class(text, start - 1) in ('letter', 'digit')}",
                *_around(text, start, end),
            ]


@dataclass
class Lattice:
    """Overlapping candidates: ``points`` in the text, ``edges`` (from, to, label,
    features) in order of from. Label 0 is a step of no entity, k + 1 the kind k."""

    points: list[int]
    edges: list[tuple[int, int, int, list[str]]] = field(default_factory=list)


def lattices(text: str, taken: list[Span] = ()) -> Iterator[Lattice]:
    """The lattices of a text's candidates that touch no span of ``taken``."""
    found = sorted([*_numbers(text), *_addresses(text)], key=lambda c: (c[0], c[1]))
    if taken:
        held = np.array(sorted((s, e) for _, s, e in taken))
        reach = np.maximum.accumulate(held[:, 1])
        at = np.searchsorted(held[:, 0], [c[1] for c in found])
        found = [c for c, i in zip(found, at) if not (i and reach[i - 1] > c[0])]
    lo = 0
    while lo < len(found):
        hi, end = lo + 1, found[lo][1]
        while hi < len(found) and found[hi][0] < end:
            end = max(end, found[hi][1])
            hi += 1
        points = sorted({p for c in found[lo:hi] for p in c[:2]})
        place = {p: i for i, p in enumerate(points)}
        edges = [(i, i + 1, 0, []) for i in range(len(points) - 1)]
        for start, stop, kinds, features in found[lo:hi]:
            edges += [(place[start], place[stop], k + 1, [f"{KINDS[k]}:{f}" for f in features]) for k in kinds]
        edges.sort(key=lambda e: (e[0], e[1], e[2]))
        yield Lattice(points, edges)
        lo = hi


# --- the model -------------------------------------------------------------------


@dataclass
class Model:
    """Weights of features, and of each pair of following labels."""

    weights: dict[str, float]
    follows: np.ndarray

    def score(self, features: list[str]) -> float:
        get = self.weights.get
        return sum(get(f, 0.0) for f in features)

    def best(self, lattice: Lattice) -> list[Span]:
        """The entities of the best path over (position, last label)."""
        n, labels = len(lattice.points), len(KINDS) + 1
        value = [[-np.inf] * labels for _ in range(n)]
        back: list[list] = [[None] * labels for _ in range(n)]
        value[0][0] = 0.0
        follows = self.follows.tolist()
        for a, b, y, features in lattice.edges:
            gain = self.score(features)
            prior = max(range(labels), key=lambda x: value[a][x] + follows[x][y])
            v = value[a][prior] + follows[prior][y] + gain
            if v > value[b][y]:
                value[b][y], back[b][y] = v, (a, prior)
        at, y = n - 1, max(range(labels), key=lambda x: value[n - 1][x])
        out = []
        while at:
            a, prior = back[at][y]
            if y:
                out.append((y - 1, lattice.points[a], lattice.points[at]))
            at, y = a, prior
        return out[::-1]


def find(text: str, model: Model | None) -> tuple[list[Span], list[Span]]:
    """Base spans, and the spans that the model adds."""
    if not _ANY.search(text):
        return [], []
    base = base_spans(text)
    added = [s for lattice in lattices(text, base) for s in model.best(lattice)] if model else []
    return base, added


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis=axis, keepdims=True)
    return (np.log(np.exp(x - m).sum(axis=axis, keepdims=True)) + m).squeeze(axis)


class Batch:
    """Lattices as padded arrays for forward-backward over all at once."""

    def __init__(self, lattices_: list[Lattice], index: dict[str, int]):
        n, edges = len(lattices_), max(len(x.edges) for x in lattices_)
        self.n, self.points = n, max(len(x.points) for x in lattices_)
        self.a, self.b, self.y = (np.zeros((n, edges), dtype=np.int64) for _ in range(3))
        self.real = np.zeros((n, edges), dtype=bool)
        self.last = np.array([len(x.points) - 1 for x in lattices_])
        edge, feature = [], []
        for r, x in enumerate(lattices_):
            for j, (a, b, y, features) in enumerate(x.edges):
                self.a[r, j], self.b[r, j], self.y[r, j], self.real[r, j] = a, b, y, True
                ids = [index[f] for f in features if f in index]
                feature += ids
                edge += [r * edges + j] * len(ids)
        self.edge, self.feature = np.array(edge, dtype=np.int64), np.array(feature, dtype=np.int64)
        self.size = len(index)

    def scores(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.edge, w[self.feature], self.a.size).reshape(self.a.shape)

    def expect(self, w: np.ndarray, follows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log of the sum over paths; probability of each edge; expected pairs of labels."""
        labels, r, low = len(follows), np.arange(self.n), -1e30
        s = self.scores(w)
        ahead = np.full((self.n, self.points, labels), low)
        ahead[:, 0, 0] = 0.0
        for j in range(self.a.shape[1]):
            a, b, y = self.a[:, j], self.b[:, j], self.y[:, j]
            v = _log_sum(ahead[r, a] + follows[:, y].T, 1) + s[:, j]
            new = np.logaddexp(ahead[r, b, y], v)
            ahead[r, b, y] = np.where(self.real[:, j], new, ahead[r, b, y])
        z = _log_sum(ahead[r, self.last], 1)
        behind = np.full((self.n, self.points, labels), low)
        behind[r, self.last] = 0.0
        edge = np.zeros(s.shape)
        pairs = np.zeros((labels, labels))
        for j in range(self.a.shape[1] - 1, -1, -1):
            a, b, y, real = self.a[:, j], self.b[:, j], self.y[:, j], self.real[:, j]
            onward = follows[:, y].T + (s[:, j] + behind[r, b, y])[:, None]  # by label before
            p = np.exp(np.minimum(ahead[r, a] + onward - z[:, None], 0.0)) * real[:, None]
            edge[:, j] = p.sum(axis=1)
            np.add.at(pairs.T, y, p)
            behind[r, a] = np.where(real[:, None], np.logaddexp(behind[r, a], onward), behind[r, a])
        return z, edge, pairs

    def sums(self, edge: np.ndarray) -> np.ndarray:
        return np.bincount(self.feature, edge.reshape(-1)[self.edge], self.size)


def _gold(lattice: Lattice, spans: set[Span]) -> list[int] | None:
    """The edges of the labelled path; None if a labelled span is no candidate."""
    wanted = {(k + 1, s, e) for k, s, e in spans if s < lattice.points[-1] and e > lattice.points[0]}
    at, out = 0, []
    place = {(a, b, y): j for j, (a, b, y, _) in enumerate(lattice.edges)}
    while at < len(lattice.points) - 1:
        here = [(y, lattice.points.index(e)) for y, s, e in wanted if s == lattice.points[at] and e in lattice.points]
        y, to = here[0] if here else (0, at + 1)
        if (at, to, y) not in place:
            return None
        if here:
            wanted = {x for x in wanted if x[1] != lattice.points[at]}
        out.append(place[at, to, y])
        at = to
    return None if wanted else out


def fit(windows: list[tuple[str, list[Span]]], passes: int = PASSES, step: float = STEP, penalty: float = PENALTY) -> Model | None:
    """Weights from labelled windows; None if none of them has a candidate."""
    known = []
    for text, spans in windows:
        for lattice in lattices(text):
            path = _gold(lattice, set(spans))
            if path:
                known.append((lattice, path))
    if not known:
        return None
    seen = Counter(f for lattice, _ in known for e in lattice.edges for f in e[3])
    names = sorted(f for f, n in seen.items() if n >= MIN_SEEN)
    index = {f: i for i, f in enumerate(names)}
    known.sort(key=lambda x: len(x[0].edges))
    labels = len(KINDS) + 1
    batches, target, target_pairs = [], np.zeros(len(names)), np.zeros((labels, labels))
    for lo in range(0, len(known), 512):  # lattices of like size share a batch
        part = known[lo : lo + 512]
        batch = Batch([lattice for lattice, _ in part], index)
        gold = np.zeros(batch.a.shape)
        for r, (lattice, path) in enumerate(part):
            gold[r, path] = 1.0
            label = 0
            for j in path:
                target_pairs[label, lattice.edges[j][2]] += 1
                label = lattice.edges[j][2]
        target += batch.sums(gold)
        batches.append(batch)
    w, follows = np.zeros(len(names)), np.zeros((labels, labels))
    state = [np.zeros_like(x) for x in (w, w, follows, follows)]
    for t in range(1, passes + 1):
        g, gp = target - penalty * len(known) * w / 10, target_pairs - penalty * len(known) * follows / 10
        for batch in batches:
            _, edge, pairs = batch.expect(w, follows)
            g = g - batch.sums(edge)
            gp = gp - pairs
        for x, grad, m, v in ((w, g / len(known), state[0], state[1]), (follows, gp / len(known), state[2], state[3])):
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            x += step * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return Model({f: float(x) for f, x in zip(names, w)}, follows)


# --- the sample and its variants ---------------------------------------------------


def _swap(text: str, spans: list[Span], which: int, new: str, keep: bool) -> tuple[str, list[Span]]:
    """The window with one span rewritten; the others move along."""
    k, s, e = spans[which]
    moved = len(new) - (e - s)
    out = [(q, a + moved * (a >= e), b + moved * (a >= e)) for i, (q, a, b) in enumerate(spans) if i != which and (b <= s or a >= e)]
    return text[:s] + new + text[e:], out + ([(k, s, s + len(new))] if keep else [])


def variants(text: str, spans: list[Span], rng: random.Random) -> list[tuple[str, list[Span]]]:
    """The window itself and rewritten copies: other writings, and near misses without the span."""
    out = [(text, spans)]
    for i, (k, s, e) in enumerate(spans):
        span, yes, no = text[s:e], [], []
        d = _digits(span)
        if k == 0:
            local, domain = span.rsplit("@", 1)
            for at in (" at ", " [at] ", "(at)", " (at) ", " @ ", "[at]"):
                dot = rng.choice([" dot ", " [dot] ", "(dot)", "."])
                yes.append(local + at + domain.replace(".", dot))
                if at != " @ " and "." in local:
                    yes.append(local.replace(".", dot if dot != "." else " dot ") + at + domain.replace(".", dot))
            first = domain.split(".")[0]
            no += [f"{local} at {first}", f"{local}@{first}", f"{local} at {domain.replace('.', ' ')}"]
        elif k == 1:
            parts = span.split(".")
            yes += [g.join(parts) for g in ("[.]", "(.)", " . ")]
            big = [*parts[:2], str(rng.randint(256, 999)), parts[3]]
            no += [".".join(big), "[.]".join(big), "-".join(parts), " ".join(parts), ".".join(parts[:3]), "/".join(parts[:3])]
        elif k == 2:
            g = rng.choice([".", "/", "  ", " - "])
            yes += [g.join(d[j : j + 4] for j in range(0, len(d), 4)), ".".join(d[j : j + 4] for j in range(0, len(d), 4))]
            wrong = d[:-1] + str((int(d[-1]) + rng.randint(1, 9)) % 10)
            no += [wrong, " ".join(wrong[j : j + 4] for j in range(0, len(d), 4)), ".".join(wrong[j : j + 4] for j in range(0, len(d), 4)), "-".join(wrong[j : j + 4] for j in range(0, len(d), 4)), d[: rng.randint(7, 12)]]
        else:
            rest = span.lstrip("+")
            head, _, tail = rest.partition(" ")
            if tail and len(_digits(tail)) >= 7:
                yes += [tail, "00" + rest, rest, tail.replace(") ", ")"), tail.replace("(", "").replace(") ", "-"), tail.replace("(", "").replace(") ", ".").replace("-", ".")]
            else:
                yes += ["00" + rest]
            no += [d, d[:7], f"{d[:4]}-{d[4:6]}-{d[6:8]}", f"{d[:3]}.{d[3:5]}", d + d]
        out += [_swap(text, spans, i, x, True) for x in yes]
        out += [_swap(text, spans, i, x, False) for x in no]
    # a rewritten neighbourhood may hold new base spans of other kinds: such copies are unclear
    return [out[0], *((t, x) for t, x in out[1:] if set(base_spans(t)) <= set(x))]


def _windows(text: str) -> Iterator[tuple[int, int, str, list[Span]]]:
    """``kind, place, window, spans`` around base spans (kind 0 to 3) and around lattices without any (4)."""
    base = base_spans(text)
    plain = [(len(KINDS), x.points[0], x.points[-1]) for x in lattices(text, base)]
    for k, s, e in base + plain:
        lo, hi = max(0, s - MARGIN), min(len(text), e + MARGIN)
        while lo and not text[lo - 1].isspace() and s - lo < 2 * MARGIN:
            lo -= 1
        while hi < len(text) and not text[hi].isspace() and hi - e < 2 * MARGIN:
            hi += 1
        inside = [(q, a, b) for q, a, b in base if a < hi and b > lo]
        if k == len(KINDS) and inside:
            continue
        if all(lo <= a and b <= hi for _, a, b in inside):
            # spans of two kinds over one place have no one path: such windows don't teach
            order = sorted(inside, key=lambda x: x[1])
            if all(x[2] <= y[1] for x, y in zip(order, order[1:])):
                yield k, s, text[lo:hi], [(q, a - lo, b - lo) for q, a, b in order]


def train(docs: DataFrame, text_col: str = "text", per_kind: int = TRAIN_PER_KIND, seed: int = 12) -> Model | None:
    """The model from the table's windows of smallest hash, ``per_kind`` of each kind at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind, order, window, spans = [], [], [], []
            for text in batch.column(0):
                text = text.as_py() or ""
                if not _ANY.search(text):
                    continue
                for k, _, w, inside in _windows(text):
                    kind.append(k)
                    order.append(zlib.crc32(f"{seed}:{w}".encode("utf-8", "surrogatepass")))
                    window.append(w)
                    spans.append([x for s in inside for x in s])
            columns = [pa.array(kind, pa.int32()), pa.array(order, pa.int64()), pa.array(window, pa.string()), pa.array(spans, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["kind", "h", "w", "spans"])

    texts = docs.select(F.col(f"`{text_col}`").cast("string").alias("t"))
    # copies of a text give the same windows: each counts once
    made = texts.mapInArrow(run, "kind int, h long, w string, spans array<long>").distinct()
    # the smallest of 64 parts of each kind first, then of these: no task sorts a whole kind
    for keys in (["kind", F.pmod("h", F.lit(64))], ["kind"]):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy("h", "w"))
        made = made.withColumn("i", place).where(F.col("i") <= per_kind)
    rows = made.orderBy("kind", "i").collect()
    windows = []
    for r in rows:
        spans = [tuple(r["spans"][j : j + 3]) for j in range(0, len(r["spans"]), 3)]
        windows += variants(r["w"], spans, random.Random(r["h"]))
    return fit(windows)


def find_private(docs: DataFrame, model: Model | None, text_col: str = "text", out: str = "found") -> DataFrame:
    """``docs`` without the text, and ``out``: its spans as structs kind, start, end,
    base (of a fixed pattern or added by the model), by kind in the order of KINDS, then start."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts: pa.Array) -> Iterator[list[pa.Array]]:
        rule = sent.value
        for lo in range(0, len(texts), 256):
            rows = []
            for text in texts.slice(lo, 256):
                base, added = find(text.as_py() or "", rule)
                spans = sorted([(*s, True) for s in base] + [(*s, False) for s in added])
                rows.append([{"kind": KINDS[k], "start": s, "end": e, "base": b} for k, s, e, b in spans])
            item = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])
            yield [pa.array(rows, pa.list_(item))]

    return map_texts(docs, text_col, run, f"`{out}` array<struct<kind:string,start:long,end:long,base:boolean>>", drop_text=True)


NAME, ORACLE = "op12_private_spans", None


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_private(docs, train(docs))
    written = lambda spans: F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))))
    base = F.filter("found", lambda x: x["base"])
    of_kind = lambda k: F.filter(base, lambda x: x["kind"] == k)
    counts = [F.size(of_kind(k)).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(written(base), 256).alias("base_sha256"), written(F.col("found")).alias("spans"))
