"""The kernel, the Nyström map and the machine of op 7 against their definitions."""

import itertools
import math
import random
from collections import defaultdict

import numpy as np

from stratocast.llm import toxicity as X


def _phi(word):
    out = defaultdict(float)
    for a, b, c in itertools.combinations(range(len(word)), 3):
        out[tuple(X._symbol(word[i]) for i in (a, b, c))] += X.DECAY ** (c - a - 2)
    return out


def _k(x, y):
    a, b = _phi(x), _phi(y)
    dot = sum(v * b.get(u, 0.0) for u, v in a.items())
    return (dot / math.sqrt(sum(v * v for v in a.values()) * sum(v * v for v in b.values()))) ** X.POWER


def _words(count, seed, letters="abcdefghij"):
    rng = random.Random(seed)
    return ["^" + "".join(rng.choices(letters, k=rng.randint(1, 12))) + "$" for _ in range(count)]


def test_kernel_is_what_it_says():
    landmarks = [*_words(15, 1), "^ééa漢$", "^aaaaaa$"]
    words = [*_words(40, 2), "^aaaa$", "^zzz$", "a-b", "^é漢字$", *landmarks]
    got = X.Kernel(landmarks, 6)(words)
    want = np.array([[_k(w, m) for m in landmarks] for w in words])
    assert np.abs(got - want).max() < 1e-5
    assert np.abs(np.diag(got[-len(landmarks) :]) - 1).max() < 1e-5


def test_near_strings_are_exactly_those_of_the_definition():
    words = _words(500, 3, "abcde")
    model = X.train_strings([(w, 5) for w in words[:25]], [(w, 3) for w in words[25:150]])
    want = []
    for i, w in enumerate(words):
        like = [_k(w, m) for m in model.landmarks]
        near = max(like[: model.insults]) ** (1 / X.POWER) >= X.NEAR
        want.append(model.bias + (np.dot(like, model.beta) if near else 0.0))
    assert np.abs(model.decisions(words) - want).max() < 1e-3
    assert len(model.near(words)) == sum(d != model.bias for d in want) > 25


def test_nystrom_map_and_machine():
    """Features whose products are the kernel's on the landmarks, and weights at
    which the weighted squared-hinge loss has no slope."""
    toxic, clean = [(w, 4.0) for w in _words(20, 4)], [(w, 2.0) for w in _words(60, 5)]
    landmarks = [w for w, _ in toxic]
    gram = X.Kernel(landmarks)(landmarks).astype(float)
    values, vectors = np.linalg.eigh(gram)
    root = vectors[:, values > 1e-6 * values[-1]] / np.sqrt(values[values > 1e-6 * values[-1]])
    z = gram @ root
    assert np.abs(z @ z.T - gram).max() < 1e-5
    words = [w for w, _ in toxic + clean]
    features = X.Kernel(landmarks)(words) @ root
    y = np.array([1.0] * len(toxic) + [-1.0] * len(clean))
    weight = np.random.default_rng(0).uniform(0.5, 2, len(y))
    w, bias = X._svm(features, y, weight)

    def loss(w, b):
        slack = np.maximum(0, 1 - y * (features @ w + b))
        return weight @ slack**2 + X.RIDGE * weight.sum() * (w @ w + 1e-6 * b * b)

    least = loss(w, bias)
    rng = np.random.default_rng(1)
    for size in (1e-4, 1e-3, 1e-2, 0.1):
        for _ in range(50):
            assert loss(w + size * rng.normal(size=len(w)), bias + size * rng.normal()) >= least * (1 - 1e-6)


def test_windows_inside_strings_hold_a_run_of_an_insult():
    rng = random.Random(7)
    insults = ["^grubhead$", "^snivelwort$", "^fizzlank$"]
    model = X.train_strings([(w, 9) for w in insults], [(w, 9) for w in _words(200, 8, "ktpmsrao")])
    glued = ["".join(rng.choices("ktpmsrao", k=4)) + i[1:-1] + "".join(rng.choices("ktpmsrao", k=5)) for i in insults * 10]
    plain = ["".join(rng.choices("ktpmsrao", k=rng.randint(6, 30))) for _ in range(200)]
    assert (model.largest(glued) > 0).all() and (model.largest(plain) > 0).mean() < 0.02
    long = "ktpmsrao" * 4000 + "grubhead" + "oarsmptk" * 4000
    assert model.largest([long, "ktpmsrao" * 8000, "ab", ""])[0] > 0
    assert model.largest(["ab", ""]).tolist() == [-math.inf] * 2


def test_near_copies_count_once(spark):
    """A group of near copies brings none of its rare words among the insults."""
    rng = random.Random(3)
    syllables = ["ba", "do", "ki", "lu", "me", "ny", "po", "ra", "se", "tu"]
    text = lambda n: ["".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(n)]
    rows = []
    for _ in range(500):
        words, toxic = text(40), rng.random() < 0.2
        if toxic:
            words.insert(rng.randrange(40), "grubhead")
        rows.append((" ".join(words), int(toxic)))
    first = ["".join(rng.choices("bcfgjqvwxz", k=7)) for _ in range(60)]
    copies = []
    for _ in range(60):
        words = list(first)
        words[rng.randrange(60)] = text(1)[0]
        copies.append((" ".join(words), 1))
    frame = lambda rows: spark.createDataFrame(rows, "text string, toxic int")
    alone, with_copies = (X.without_copies(frame(r)).count() for r in (rows, rows + copies))
    assert 400 <= alone < with_copies <= alone + 8
    model = X.fit(frame(rows + copies))
    assert model.landmarks[: model.insults] == ["^grubhead$"]
