"""Toxicity: a support vector machine on a gap-weighted subsequence string kernel
with Nyström landmarks.

A text is a bag of strings: its words, lower-cased and free of outer
punctuation, and the runs of single letters joined ("i d i o t"). Longer
strings are seen through overlapping windows.

Kernel: phi_u(s) sums decay**span over the occurrences of the three characters
u in s in this order with any gaps, so inserted characters and gaps weaken a
match and do not break it. k is the fourth power of the cosine of phi (a power
of a kernel is one), so that likeness counts and common letters don't. The map
z = k(s, landmarks) K**-1/2 is Nyström's, and a linear squared-hinge SVM is
trained on z; its decision is bias + sum_j beta_j k(s, landmark_j).

Training: labelled texts are bags, so the toxic strings in them are found
first, as those that turn up in toxic texts far oftener than chance allows.
These strings, and variants with characters put in, are the positive examples;
other frequent strings, the clean ones that look most like insults included,
the negative ones. A text's score is a logistic function, fitted to the
labels, of its most toxic string's decision.

Only a bounded sample of labelled rows (``max_rows``) is used for training. It
is small enough to be broadcast whatever the size of the tables; all texts are
scored where they are read, without a shuffle.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import checkpointed, columns, opened, released, sealed, ship, slices

MAX_ROWS = 20_000  # labelled rows used for training
PLAIN, HARD = 3_000, 3_000  # clean strings for training: any, and the likest to insults
LANDMARKS = 96  # clean ones
COVER = 0.7  # each insult string is as much like some landmark
THRESHOLD = 0.7
WIDTH, STEP = 16, 8  # windows over longer strings
NARROW, SLIDES = (3, 4), (5, 6, 8, 10)  # windows for insults inside strings, the narrow ones only beyond ASCII
SEEDS = 2  # runs of three characters of insults that such a window holds
DECAY = 0.75
POWER = 4
NEAR = 0.5
ALIKE, COARSE, GROUPS = 0.7, 6, 48  # groups of like insults in the bound, the large ones' and all ones' number
RIDGE = 1e-4
SYMBOLS = 64
GAP = SYMBOLS - 1  # anything but letters and digits
BANDS, BAND = 6, 3  # of minima by which like training texts are told
_CELLS = 200_000  # of the kernel's arrays at a time
_WINDOWS = 50_000  # windows cut at a time
_BLOCK = 10_000  # new strings looked at together
_MEMORY = 200_000  # strings whose decisions a worker remembers

_SPELT = re.compile(r"(?<!\S)(?:\S[^\S\n]+){2,}\S(?!\S)")
_OUTER = re.compile(r"^[\W_]+|[\W_]+$")
_INNER = re.compile(r"[\W_]+")


def _symbol(c: str) -> int:
    if "a" <= c <= "z":
        return ord(c) - 97
    if c in "^$":
        return 61 if c == "^" else 62
    return 26 + ord(c) % 35 if c.isalnum() else GAP


def strings(text: str) -> set[str]:
    """The raw strings of a text: lower-cased words and joined runs of single
    characters."""
    text = text.lower()
    found = set(text.split())
    for run in _SPELT.findall(text):
        found.add("".join(run.split()))
    return found


@lru_cache(maxsize=1 << 16)
def _pieces(string: str) -> tuple[str, ...]:
    s = _OUTER.sub("", string)
    parts = [p for p in _INNER.split(s) if p]
    return (s,) if len(parts) < 2 else tuple(dict.fromkeys([s, "".join(parts), *parts]))


def pieces(string: str) -> tuple[str, ...]:
    """A string, the letters and digits alone of one that has others inside, and
    its parts between these."""
    return (string,) if string.isalnum() else _pieces(string)


def bag(text: str) -> set[str]:
    """The pieces of a text's strings, those of fewer than three characters left out."""
    whole = strings(text)
    found = {s for s in whole if s.isalnum()}
    for s in whole - found:
        found.update(_pieces(s))
    return {p for p in found if len(p) >= 3}


def windows(string: str) -> list[str]:
    """What the kernel sees of a string's pieces as a whole, and the places in
    those over the width where an insult can stand without a gap; nothing of
    fewer than three characters."""
    out = []
    for s in pieces(string):
        out += _cut(s)
        if len(s) > WIDTH - 2:
            out += [f"^{s[i : i + w]}$" for w in _slides(s) for i in range(0, len(s) - w + 1, _step(w))]
    return list(dict.fromkeys(out))


def _slides(s: str) -> tuple[int, ...]:
    return tuple(w for w in (SLIDES if s.isascii() else (*NARROW, *SLIDES)) if w < len(s))


def _step(width: int) -> int:
    return 1 if width <= 8 else 2


def _cut(s: str) -> list[str]:
    if len(s) < 3:
        return []
    s = f"^{s}$"
    if len(s) <= WIDTH:
        return [s]
    return [s[i : i + WIDTH] for i in range(0, len(s) - WIDTH + STEP, STEP)]


@lru_cache(maxsize=None)
def _triples(length: int) -> tuple[np.ndarray, np.ndarray]:
    at = np.array(list(combinations(range(length), 3)), np.intp)
    return at, (DECAY ** (at[:, 2] - at[:, 0] - 2)).astype(np.float32)


_SYMBOLS = np.array([_symbol(chr(i)) for i in range(0x3000)], np.int32)


def _symbols(words: list[str]) -> np.ndarray:
    """The symbols of words of one length, a row each."""
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(words), -1)
    symbols = _SYMBOLS[np.minimum(points, len(_SYMBOLS) - 1)]
    for row, col in zip(*np.nonzero(points >= len(_SYMBOLS)), strict=True):
        symbols[row, col] = _symbol(chr(points[row, col]))
    return symbols


_START, _END = _symbol("^"), _symbol("$")


def _triple_codes(symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (symbols[:, at[:, 0]] * SYMBOLS + symbols[:, at[:, 1]]) * SYMBOLS + symbols[:, at[:, 2]]


def _codes(words: list[str], at: np.ndarray) -> np.ndarray:
    """The code of each three characters of words of one length."""
    return _triple_codes(_symbols(words), at)


def _by_length(words: list[str]) -> dict[int, list[int]]:
    out: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        out.setdefault(len(w), []).append(i)
    return {length: places for length, places in out.items() if length >= 3}


def _norms(codes: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """|phi| of words of one length: codes [words, triples], weights [triples]."""
    order = np.argsort(codes, axis=1, kind="stable")
    ordered = np.take_along_axis(codes, order, 1)
    total = np.cumsum(weight[order], axis=1, dtype=np.float64)
    last = np.ones(codes.shape, bool)
    last[:, :-1] = ordered[:, 1:] != ordered[:, :-1]
    row, col = np.nonzero(last)
    ends = total[row, col]
    first = np.ones(len(row), bool)
    first[1:] = row[1:] != row[:-1]
    sums = ends - np.where(first, 0.0, np.concatenate([[0.0], ends[:-1]]))
    return np.sqrt(np.bincount(row, sums * sums, len(codes)))


def subsequences(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For the words of each length: their places, their three-character codes
    [words, triples] and the weights [triples]."""
    for length, places in _by_length(words).items():
        at, weight = _triples(length)
        step = max(1, _CELLS // len(weight))
        for start in range(0, len(places), step):
            part = places[start : start + step]
            yield np.array(part), _codes([words[i] for i in part], at), weight


class _ByCode:
    """Lists of (column, value) by a code's place; the last place has none."""

    def __init__(self, places: np.ndarray, columns_: np.ndarray, values: np.ndarray, count: int, size: int):
        order = np.argsort(places, kind="stable")
        self.which, self.value, self.size = columns_[order], values[order].astype(np.float32), size
        self.count = np.bincount(places, minlength=count + 1)
        self.begin = np.cumsum(self.count) - self.count

    def product(self, places: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """[words, columns]: the weighted sums over places [words, triples]."""
        out = np.empty((len(places), self.size), np.float32)
        step = max(1, _CELLS // (self.size + 4 * len(weight)))
        for start in range(0, len(places), step):
            block = places[start : start + step]
            word, triple = np.nonzero(self.count[block])
            found = block[word, triple]
            many = self.count[found]
            at = np.arange(many.sum()) + np.repeat(self.begin[found] - (np.cumsum(many) - many), many)
            cell = np.repeat(word * self.size, many) + self.which[at]
            sums = np.bincount(cell, np.repeat(weight[triple], many) * self.value[at], len(block) * self.size)
            out[start : start + step] = sums.reshape(len(block), self.size)
        return out


class Kernel:
    """k(s, landmark)**POWER for fixed landmarks, the first ``insults`` of which
    are insults.

    The landmarks' phi is kept by code, as a list of (landmark, value), so that a
    word costs a look-up for each of its triples and a product only where a
    landmark has that triple, too.
    """

    def __init__(self, landmarks: list[str], insults: int = 0):
        self.size, self.insults = len(landmarks), insults
        keys, values = [], []
        for places, codes, weight in subsequences(landmarks):
            keys.append((codes.astype(np.int64) * self.size + places[:, None]).ravel())
            values.append((weight / _norms(codes, weight)[:, None]).ravel())
        keys, at = np.unique(np.concatenate(keys), return_inverse=True)
        value, landmark = np.bincount(at, np.concatenate(values)), keys % self.size
        used, of = np.unique(keys // self.size, return_inverse=True)
        # the last place is for codes that no landmark has
        self.place = np.full(SYMBOLS**3, len(used), np.int32)
        self.place[used] = np.arange(len(used))
        self.phi = _ByCode(of, landmark, value, len(used), self.size)
        # the runs of three characters of the insults
        self.runs = np.zeros(SYMBOLS**3, bool)
        for w in landmarks[:insults]:
            self.runs[_codes([w], np.arange(max(0, len(w) - 4))[:, None] + [1, 2, 3])] = True
        self.reach = []
        if insults:
            own, group = landmark < insults, self._groups(landmarks)
            self.insult = _ByCode(of[own], landmark[own], value[own], len(used), insults)
            # the largest phi of each code over all insults, over few large groups, and over groups of like ones
            self.most = np.zeros(SYMBOLS**3, np.float32)
            np.maximum.at(self.most, keys[own] // self.size, value[own].astype(np.float32))
            for groups in (group % COARSE, group):
                reach = np.zeros((len(used) + 1, int(groups.max()) + 1), np.float32)
                np.maximum.at(reach, (of[own], groups[landmark[own]]), value[own].astype(np.float32))
                self.reach.append(reach)

    def _groups(self, landmarks: list[str]) -> np.ndarray:
        like, leaders = self(landmarks[: self.insults])[:, : self.insults], []
        group = np.zeros(self.insults, int)
        for i in range(self.insults):
            best = int(np.argmax(like[i, leaders])) if leaders else 0
            if not leaders or like[i, leaders[best]] < ALIKE**POWER and len(leaders) < GROUPS:
                best = len(leaders)
                leaders.append(i)
            group[i] = best
        return group

    def __call__(self, words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), self.size), np.float32)
        for places, codes, weight in subsequences(words):
            out[places] = self.phi.product(self.place[codes], weight) / _norms(codes, weight)[:, None]
        return out**POWER

    def near(self, codes: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The words of one length that are NEAR an insult, and k(s, landmark)
        without the power for these. First those go whose product with the
        insults of a group, at most sum_u phi_u(s) max_j phi_u(insult_j), is too
        small for each group, even for the least |phi(s)|, that of a word in
        which no u occurs twice."""
        floor = NEAR * math.sqrt(weight @ weight) * (1 - 1e-5)
        some = np.flatnonzero(self.most[codes] @ weight >= floor)
        places = self.place[codes[some]]
        for reach in self.reach:
            step = max(1, _CELLS // (len(weight) * reach.shape[1]))
            held = [np.matmul(weight, reach[places[i : i + step]]).max(1) >= floor for i in range(0, len(some), step)]
            held = np.concatenate(held) if held else np.empty(0, bool)
            some, places = some[held], places[held]
        held = self.insult.product(places, weight).max(1, initial=0) >= floor
        some, places = some[held], places[held]
        like = self.phi.product(places, weight) / _norms(codes[some], weight)[:, None]
        close = like[:, : self.insults].max(1, initial=0) >= NEAR
        return some[close], like[close]


@dataclass
class Model:
    """The decision bias + sum_j beta_j k(s, landmark_j)**POWER, and the logistic
    of the largest decision of a text. Strings that are less than NEAR like each
    of the first ``insults`` landmarks decide like the bias."""

    landmarks: list[str]
    insults: int
    beta: np.ndarray
    bias: float
    slope: float = 1.0
    offset: float = 0.0

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "kernel"}

    def ready(self) -> None:
        if not hasattr(self, "kernel"):
            self.kernel = Kernel(self.landmarks, self.insults)

    def of_symbols(self, symbols: np.ndarray) -> np.ndarray:
        """The decisions of strings of one length, a row of symbols each."""
        out = np.full(len(symbols), self.bias)
        at, weight = _triples(symbols.shape[1])
        step = max(1, _CELLS // len(weight))
        for start in range(0, len(symbols), step):
            near, like = self.kernel.near(_triple_codes(symbols[start : start + step], at), weight)
            out[start + near] += like**POWER @ self.beta
        return out

    def near(self, words: list[str]) -> list[int]:
        """Places of the strings that are near an insult."""
        self.ready()
        return [int(places[i]) for places, codes, weight in subsequences(words) for i in self.kernel.near(codes, weight)[0]]

    def decisions(self, words: list[str]) -> np.ndarray:
        self.ready()
        out = np.full(len(words), self.bias)
        for _, places in _by_length(words).items():
            out[places] = self.of_symbols(_symbols([words[i] for i in places]))
        return out

    def largest(self, strings_: list[str]) -> np.ndarray:
        """For each piece of a string the largest decision of it as a whole (of
        its overlapping windows, if it is longer) and of the places inside where
        an insult can stand; -inf if it has none."""
        self.ready()
        out = np.full(len(strings_), -math.inf)
        for length, places in _by_length(strings_).items():
            many = max(1, _WINDOWS // length)
            for first in range(0, len(places), many):
                part = np.array(places[first : first + many])
                symbols = _symbols([strings_[i] for i in part])
                framed = np.pad(symbols, ((0, 0), (1, 1)), constant_values=((0, 0), (_START, _END)))
                best = np.full(len(part), -math.inf)
                starts = np.arange(0, max(1, length + 2 - WIDTH + STEP), STEP)
                full = starts[starts + WIDTH <= length + 2]
                for i in range(0, len(full), _WINDOWS):
                    seen = framed[:, full[i : i + _WINDOWS, None] + np.arange(WIDTH)].reshape(-1, WIDTH)
                    best = np.maximum(best, self.of_symbols(seen).reshape(len(part), -1).max(1))
                if len(full) < len(starts) and length + 2 - starts[-1] >= 3:  # the last one is shorter
                    best = np.maximum(best, self.of_symbols(framed[:, starts[-1] :]))
                others = np.array([not strings_[i].isascii() for i in part])
                for w in (w for w in (*NARROW, *SLIDES) if w < length):
                    rows, starts = self._seeded(symbols, w, others if w in NARROW else None)
                    for i in range(0, len(rows), _WINDOWS):
                        row = rows[i : i + _WINDOWS]
                        seen = symbols[row[:, None], starts[i : i + _WINDOWS, None] + np.arange(w)]
                        seen = np.pad(seen, ((0, 0), (1, 1)), constant_values=((0, 0), (_START, _END)))
                        np.maximum.at(best, row, self.of_symbols(seen))
                out[part] = best
        return out

    def _seeded(self, symbols: np.ndarray, width: int, only: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """Rows and starts of the windows inside strings that hold SEEDS of the
        insults' runs of three characters, or one if they are narrow."""
        hits = self.kernel.runs[(symbols[:, :-2] * SYMBOLS + symbols[:, 1:-1]) * SYMBOLS + symbols[:, 2:]]
        if only is not None:
            hits = hits & only[:, None]
        before = np.zeros((len(symbols), symbols.shape[1] - 1), np.int32)
        np.cumsum(hits, axis=1, out=before[:, 1:])
        held = before[:, width - 2 :] - before[:, : before.shape[1] - width + 2]
        return np.nonzero(held >= (1 if width in NARROW else SEEDS))


def _svm(z: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = RIDGE) -> tuple[np.ndarray, float]:
    """Weighted squared-hinge linear SVM by Newton steps in the primal."""
    x = np.hstack([z, np.ones((len(z), 1))])
    w = np.zeros(x.shape[1])
    penalty = ridge * np.sum(weight) * np.diag([1.0] * z.shape[1] + [1e-6])

    def loss(w):
        return weight @ np.maximum(0, 1 - y * (x @ w)) ** 2 + w @ penalty @ w

    for _ in range(200):
        near = y * (x @ w) < 1
        a = x[near] * weight[near, None]
        step = np.linalg.solve(a.T @ x[near] + penalty, a.T @ y[near]) - w
        now, size = loss(w), 1.0
        while size > 1e-4 and loss(w + size * step) > now:
            size /= 2
        w = w + size * step
        if now - loss(w) <= 1e-7 * now:
            break
    return w[:-1], w[-1]


def _variants(word: str, seed: int) -> list[str]:
    """The string with one character put in, at each place inside, and one with two."""
    rng = np.random.default_rng(seed)
    letter = lambda: chr(97 + int(rng.integers(26)))
    places = range(2, max(3, len(word) - 1))
    out = [word[:i] + letter() + word[i:] for i in places]
    i, j = sorted(int(x) for x in rng.choice(places, 2))
    out.append(word[:i] + letter() + word[i:j] + letter() + word[j:])
    return [v[:WIDTH] for v in out]


def cover(words: list[str]) -> list[str]:
    """The first words so that each word is COVER like one of them at least."""
    left, out = list(words), []
    while left:
        chosen = left[:1]
        for w in left[1:64]:  # of the next, those that are unlike each other
            if Kernel(chosen)([w]).max() < COVER**POWER:
                chosen.append(w)
        out += chosen
        like = Kernel(chosen)(left).max(1)
        left = [w for w, k in zip(left, like, strict=True) if k < COVER**POWER and w not in chosen]
    return out


def train_strings(toxic: list[tuple[str, float]], clean: list[tuple[str, float]]) -> Model:
    """toxic, clean: (string, texts that hold it), the likeliest landmarks first."""
    good, bad = [w for w, _ in clean], [w for w, _ in toxic]
    insults = cover(bad)
    landmarks = [*insults, *good[:LANDMARKS]]
    variants = [(v, n / len(found)) for i, (w, n) in enumerate(toxic) for found in [_variants(w, i)] for v in found]
    extra = [v for v, _ in variants]
    words = [*bad, *extra, *good]
    y = np.array([1.0] * (len(bad) + len(extra)) + [-1.0] * len(good))
    # an example weighs as the texts that hold it, its variants together as much
    texts = np.array([n for _, n in [*toxic, *variants, *clean]], float)
    weight = np.sqrt(texts)
    for side in (1, -1):
        weight[y == side] *= len(y) / (2 * weight[y == side].sum())
    kernel = Kernel(landmarks)
    values, vectors = np.linalg.eigh(kernel(landmarks).astype(np.float64))
    keep = values > 1e-6 * values[-1]
    root = vectors[:, keep] / np.sqrt(values[keep])
    w, bias = _svm(kernel(words) @ root, y, weight)
    return Model(landmarks, len(insults), (root @ w).astype(np.float32), float(bias))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Platt's fit of P(y = 1) by slope * x + offset, with his smoothed targets."""
    ones, n = weight @ y, weight.sum()
    target = np.where(y > 0, (ones + 1) / (ones + 2), 1 / (n - ones + 2))
    a = np.array([0.0, math.log((ones + 1) / (n - ones + 1))])
    design = np.stack([x, np.ones(len(x))], 1)
    loss = lambda a: weight @ (np.logaddexp(0, design @ a) - target * (design @ a))
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ a, -500, 500)))
        gradient = design.T @ (weight * (p - target))
        step = np.linalg.solve((design * (weight * p * (1 - p))[:, None]).T @ design + 1e-9 * np.eye(2), gradient)
        size = 1.0
        while size > 1e-6 and loss(a - size * step) > loss(a):
            size /= 2
        a = a - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return float(a[0]), float(a[1])


_DRAWS = np.random.default_rng(5).integers(0, 1 << 63, BANDS * BAND, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with the keys of BANDS bands of minima of their strings' hashes."""
    for batch, texts in slices(batches):
        keys = []
        for text in texts:
            hashes = pd.util.hash_array(np.array(sorted(strings(text.decode())) or [""], object), categorize=False)
            minima = (hashes[:, None] * _DRAWS).min(0).reshape(BANDS, BAND)
            keys.append(np.bitwise_xor.reduce(minima * np.array([1, 3, 5], np.uint64), axis=1).view(np.int64).tolist())
        yield pa.RecordBatch.from_arrays([*columns(batch, "text", "toxic"), pa.array(keys, pa.list_(pa.int64()))], names=["text", "toxic", "bands"])


def without_copies(labelled: DataFrame) -> DataFrame:
    """One of each group of like texts (text, toxic) with a label: near copies
    share their rare words, which say no more than those of one of them. A text
    goes if one of a lesser hash shares a band."""
    rows = labelled.select("text", "toxic").distinct().mapInArrow(released(_sign), "text string, toxic int, bands array<long>")
    rows = checkpointed(rows.withColumn("id", F.xxhash64("text")))
    held = rows.select("id", "toxic", F.posexplode("bands").alias("band", "key"))
    least = held.groupBy("toxic", "band", "key").agg(F.min("id").alias("least"))
    copies = held.join(least, ["toxic", "band", "key"]).where("id > least").select("id", "toxic").distinct()
    return checkpointed(rows.join(copies, ["id", "toxic"], "left_anti").select("text", "toxic"))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many texts of either label hold each string, summed per task in part."""
    toxic, clean = Counter(), Counter()

    def out():
        words = list(toxic.keys() | clean.keys())
        return pa.RecordBatch.from_arrays(
            [pa.array(words, pa.string()), pa.array([toxic[w] for w in words], pa.int64()), pa.array([clean[w] for w in words], pa.int64())],
            names=["word", "toxic", "clean"],
        )

    for batch, texts in slices(batches):
        for text, label in zip(texts, columns(batch, "toxic")[0].to_pylist(), strict=True):
            found = {v for s in strings(text.decode()) for v in windows(s)}
            (toxic if label == 1 else clean).update(found)
        if len(toxic) + len(clean) > 100_000:
            yield out()
            toxic.clear(), clean.clear()
    yield out()


class Scorer:
    """The largest decision of a text's pieces; remembers many pieces' decisions."""

    def __init__(self, model: Model):
        self.model = model
        self.plain: set[str] = set()  # pieces that decide like the bias
        self.known: dict[str, float] = {}  # and the others
        self.others: set[str] = set()

    def __call__(self, texts: list[str]) -> list[float]:
        bags = [bag(t) for t in texts]
        seen = set().union(*bags)
        new = list(seen - self.plain - self.others)
        if len(self.plain) + len(self.others) + len(new) > _MEMORY:
            # those of these texts, the frequent ones among them, stay
            self.plain &= seen
            self.others &= seen
            self.known = {p: self.known[p] for p in self.others}
        for at in range(0, len(new), _BLOCK):
            block = new[at : at + _BLOCK]
            found = self.model.largest(block)
            same = found == self.model.bias
            self.plain.update(p for p, s in zip(block, same.tolist(), strict=True) if s)
            self.known.update((block[i], float(found[i])) for i in np.flatnonzero(~same).tolist())
        self.others = set(self.known)
        out = []
        for b in bags:
            most = self.model.bias if b else -math.inf
            out.append(max([most, *(self.known[p] for p in b & self.others)]))
        return out


def _decide(model: Model, keep: list[str]):
    """Texts to the columns ``keep`` and their largest decision."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch, texts in slices(batches):
            found = np.maximum(scorer([t.decode() for t in texts]), model.bias - 2.0)
            yield pa.RecordBatch.from_arrays([*columns(batch, *keep), pa.array(found, pa.float64())], names=[*keep, "decision"])

    return released(run)


def fit(labelled: DataFrame) -> Model | float:
    """A model from bounded rows (text string, toxic int); the share of toxic
    rows (0 without rows) if they don't allow one, as when all are of a kind."""
    share = labelled.agg(F.count("*").alias("n"), F.count_if(F.col("toxic") == 1).alias("ones")).first()
    n, ones = share.n, share.ones
    if not n:
        return 0.0
    rate = ones / n
    if rate in (0.0, 1.0):
        return rate
    labelled = without_copies(labelled)
    alone = labelled.agg(F.avg((F.col("toxic") == 1).cast("double"))).first()[0]
    words = checkpointed(
        labelled.select("text", "toxic")
        .mapInArrow(released(_count), "word string, toxic long, clean long")
        .groupBy("word")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .where("toxic + clean >= 3")
    )
    # Chernoff's bound on seeing so many toxic texts by chance, in nats
    held = F.col("toxic") + F.col("clean")
    share_of = F.col("toxic") / held
    surprise = held * (
        share_of * F.log(share_of / alone) + F.when(share_of < 1, (1 - share_of) * F.log((1 - share_of) / (1 - alone))).otherwise(0.0)
    )
    usual = math.log(max(2, words.count())) + math.log(10)
    insults = words.where((F.col("toxic") > 0) & (share_of >= 0.8)).where(surprise > usual)
    bad = [(r.word, r.toxic) for r in insults.orderBy(F.desc("toxic"), "word").collect()]
    if not bad:
        return rate
    plain = words.where(share_of <= min(0.5, 2 * alone + 0.1))
    some = plain.orderBy(F.xxhash64("word"), "word").limit(PLAIN)
    good = [(r.word, r.clean) for r in some.collect()]
    model = train_strings(bad, good)
    # once more, with the clean strings that this model finds most toxic
    closest = plain.select(F.col("word").alias("text"), "clean").mapInArrow(
        _decide(model, ["text", "clean"]), "text string, clean long, decision double"
    )
    hard = [(r.text, r.clean) for r in closest.orderBy(F.desc("decision"), "text").limit(HARD).collect()]
    model = train_strings(bad, [*hard[:LANDMARKS], *good, *hard[LANDMARKS:]])
    rows = labelled.select("text", "toxic").mapInArrow(_decide(model, ["toxic"]), "toxic int, decision double").collect()
    model.slope, model.offset = calibrate(model, [(r.decision, r.toxic) for r in rows], bad)
    return model


def calibrate(model: Model, found: list[tuple[float, int]], toxic: list[tuple[str, float]]) -> tuple[float, float]:
    """The logistic of the texts' decisions, in which variants of the toxic
    strings that training has not seen, of those that are decided as toxic,
    weigh together as half of the texts with a toxic string."""
    hidden = [(v, n / len(found)) for i, (w, n) in enumerate(toxic) for found in [_variants(w, len(toxic) + i)] for v in found]
    decided = model.decisions([w for w, _ in hidden])
    hidden = [(d, n) for d, (_, n) in zip(decided.tolist(), hidden, strict=True) if d > 0]
    x = np.array([d for d, _ in found] + [d for d, _ in hidden])
    y = np.array([float(t == 1) for _, t in found] + [1.0] * len(hidden))
    share = 0.5 * sum(d > 0 and t == 1 for d, t in found) / max(1.0, sum(n for _, n in hidden))
    return _logistic(x, y, np.array([1.0] * len(found) + [share * n for _, n in hidden]))


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """Text and label of at most ``max_rows`` labelled documents, held-out ones
    excepted, chosen by a hash of their ids."""
    chosen = (
        labels.select(F.col("doc_id").alias("labelled_id"), F.col("toxic").cast("int").alias("toxic"))
        .where("labelled_id is not null and toxic in (0, 1)")
        .where(~held_out(F.col("labelled_id")))
        .orderBy(F.xxhash64("labelled_id"), "labelled_id", "toxic")
        .limit(max_rows)
    )
    # max_rows rows of 12 bytes: a bounded side
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled_id"))
    return checkpointed(found.select("text", "toxic"))


def score(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` (doc_id, text and any others) with held_out boolean,
    score double (0 to 1) and predicted int (1 from ``threshold`` up) in front
    of which any columns of these names are dropped.

    Null and empty texts score like a text without any toxic string. A null
    doc_id is not held out. Without labels of both kinds, every score is the
    share of toxic labels (0 without labels). Repeated rows stay.
    """
    ship(docs.sparkSession)
    whole = opened(docs.columns, "doc_id", "text", but=("held_out", "score", "predicted"))
    docs = sealed(docs, "doc_id", "text")
    model = fit(training_rows(docs, labels))
    if isinstance(model, Model):
        schema = T.StructType([*docs.schema.fields, T.StructField("decision", T.DoubleType())])
        decided = docs.mapInArrow(_decide(model, docs.columns), schema)
        value = 1 / (1 + F.exp(-(F.col("decision") * F.lit(model.slope) + F.lit(model.offset))))
        scored = decided.withColumn("score", value)
    else:
        scored = docs.withColumn("score", F.lit(float(model)))
    return scored.select(
        *whole,
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).cast("int").alias("predicted"),
    )
