"""Operators 11 to 13: whitening, fill-in-middle, source mixing."""

import itertools
import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from helpers import ODD_TEXTS, odd_documents, sha
from pyspark.sql import functions as F

from stratocast.llm import fill_in_middle as FIM
from stratocast.llm import queries, source_mixing, whitening

SF = "/root/testdata/sf0.001"


# -- op 11 ----------------------------------------------------------------------
def _whitened_brute(vectors, wanted):
    x = np.array([[int(np.floor(1024 * float(c))) + 100_000 for c in v] for v in vectors])
    n, sums = len(x), [int(s) for s in x.sum(0)]
    c = x - np.array(sums) / n
    values, q = np.linalg.eigh(c.T @ c / n)
    values, q = values[::-1], q[:, ::-1][:, :wanted]
    deviation = [sum((n * int(a) - s) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    return c @ q / np.sqrt(values[:wanted]), values[:wanted] / values.sum(), deviation


def _same_up_to_sign(got, want, within=1e-9):
    signs = np.sign((got * want).sum(0))
    assert np.abs(got * signs - want).max() < within


def test_op11_on_a_whole_table(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()
    want, explained, deviation = _whitened_brute([r.embedding for r in rows], 8)
    place = {r.vec_id: i for i, r in enumerate(rows)}
    got = queries.op11_embedding_whitening(spark, SF).collect()
    assert len(got) == 8 * len(rows) and {r.n for r in got} == {len(rows)}
    z = np.empty_like(want)
    for r in got:
        z[place[r.vec_id], r.component - 1] = r.whitened
        assert r.deviation == deviation[place[r.vec_id]]
        assert abs(r.explained / explained[r.component - 1] - 1) < 1e-10 and r.identity_error < 1e-10
    _same_up_to_sign(z, want)


def test_whitening_of_odd_rows(spark):
    rng = np.random.default_rng(1)
    good = [(i, [float(c) for c in rng.normal(size=6) * [9, 5, 3, 2, 1, 1]]) for i in range(60)]
    good += [good[0], good[0], (None, good[1][1]), (70, [0.0] * 6)]
    odd = [None, [], [1.0] * 5 + [None], [float("nan")] * 6, [1.0] * 5 + [float("-inf")], [1.0, 2.0]]
    df = spark.createDataFrame(good + [(100 + i, v) for i, v in enumerate(odd)], "vec_id long, embedding array<double>")
    df = df.withColumns({c: F.lit("x") for c in ("rows", "cells", "part", "sums", "total", "at", "deviation", "whitened", "component")})
    out, model = whitening.whiten(df, wanted=4)
    assert model.n == len(good) and out.columns[-2:] == ["deviation", "whitened"]
    assert model.residuals.max() <= 1e-12 * model.eigenvalues[0] and model.identity_error < 1e-12
    rows = out.select("vec_id", "embedding", "deviation", "whitened", "rows", "component").collect()
    assert Counter(r.vec_id for r in rows) == Counter(i for i, _ in good) and {r.rows + r.component for r in rows} == {"xx"}
    want, explained, deviation = _whitened_brute([v for _, v in good], 4)
    order = {tuple(v): k for k, (_, v) in enumerate(good)}
    at = [order[tuple(r.embedding)] for r in rows]
    _same_up_to_sign(np.array([r.whitened for r in rows]), want[at])
    assert [r.deviation for r in rows] == [deviation[k] for k in at]
    assert np.abs(model.explained / explained - 1).max() < 1e-12


def test_whitening_without_variance_or_rows(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0])] * 3, "vec_id long, embedding array<float>")
    out, model = whitening.whiten(df)
    assert model.n == 3 and [(r.deviation, r.whitened) for r in out.collect()] == [(0, [])] * 3
    line, model = whitening.whiten(spark.createDataFrame([(i, [float(i), 0.0, float(i)]) for i in range(5)], df.schema))
    assert len(model.eigenvalues) == 1 and {len(r.whitened) for r in line.collect()} == {1}
    for empty in (df.where("false"), df.withColumn("embedding", F.lit(None).cast("array<float>"))):
        out, model = whitening.whiten(empty)
        assert out.count() == 0 and model is None


def test_deviation_beyond_a_long_is_null(spark):
    far = spark.createDataFrame([(1, [2.0**40, 1.0]), (2, [0.0, 1.0]), (3, [0.0, 2.0])], "vec_id long, embedding array<double>")
    out, _ = whitening.whiten(far)
    assert {r.vec_id: r.deviation for r in out.collect()} == {1: None, 2: None, 3: None}
    with pytest.raises(Exception, match="too large"):
        whitening.whiten(far.withColumn("embedding", F.array(F.lit(1e300), F.lit(0.0))))[0].collect()


@pytest.mark.parametrize("kind", ["close", "equal", "steep", "few"])
def test_leading_eigenpairs(kind):
    rng = np.random.default_rng(3)
    d = 120
    values = {
        "close": 1 + 0.01 * rng.random(d),
        "equal": np.ones(d),
        "steep": 10.0 ** -np.arange(0, 24, 0.2),
        "few": np.where(np.arange(d) < 3, 5.0, 0.0),
    }[kind]
    turn = np.linalg.qr(rng.normal(size=(d, d)))[0]
    v = (turn * values) @ turn.T
    passes = []
    found, q, residual = whitening.leading_eigenpairs(lambda x: passes.append(1) or v @ x, d, 8)
    want = np.sort(values)[::-1][:8]
    assert np.abs(found - want).max() <= 1e-13 * want[0]
    assert np.abs(q.T @ q - np.eye(8)).max() < 1e-13 and residual.max() <= 1e-12 * want[0]
    assert np.linalg.norm(v @ q - q * found, axis=0).max() <= 1e-12 * want[0]


def test_chebyshev_damps_the_unwanted_spectrum():
    values = np.concatenate([[10.0, 9.0], np.linspace(0, 4, 50)])
    out = whitening.chebyshev(lambda x: values[:, None] * x, np.ones((52, 1)), 4.0, 10.0, 9)[:, 0]
    want = np.polynomial.chebyshev.Chebyshev.basis(9)
    assert np.allclose(out, want(values / 2 - 1) / want(4.0), atol=1e-12)
    assert abs(out[0] - 1) < 1e-12 and np.abs(out[2:]).max() < 1e-6


# -- op 12 ----------------------------------------------------------------------
def _middle_brute(doc_id, text):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n, digest = len(units), sha(f"7:{'' if doc_id is None else doc_id}")
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")):
        return n, "plain", None, None, text
    if h[3] % 100 < 50:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_fill_in_middle_of_odd_rows(spark):
    more = ["\n", "\n\n\n", "a\nb\nc", "a\r\nb\x85c d\n", "<P", "<P\n<S\n<M>x", "no <S> here\n", "<\nP>\n", "é\n漢\n\U0001f600" * 90_000]
    docs = odd_documents(spark, [*ODD_TEXTS, *more, *more, *more]).withColumns({c: F.lit(1) for c in ("key_", "restored", "output", "form", "n")})
    out = FIM.restore(FIM.fill_in_middle(docs)).collect()
    assert len(out) == docs.count() and {r.form for r in out} == {"plain", "psm", "spm"}
    for r in out:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == _middle_brute(r.doc_id, r.text)
        assert r.restored == (r.text or "")
    assert FIM.restore(FIM.fill_in_middle(docs.where("false"))).count() == 0


def test_rate_and_forms(spark):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("a\nb\nc\nd\n").alias("text"))
    plain = FIM.fill_in_middle(docs, rate=0, spm=50)
    assert {r.form for r in plain.select("form").distinct().collect()} == {"plain"} and plain.where("output <> text").count() == 0
    forms = Counter(r.form for r in FIM.fill_in_middle(docs, seed=1, rate=50, spm=20).select("form").collect())
    assert 850 < forms["plain"] < 1150 and 130 < forms["spm"] < 270


@pytest.mark.parametrize("size", [0, 1, 2, 5, FIM.BLOCK - 1, 2 * FIM.BLOCK + 1, 5 * FIM.BLOCK])
def test_rotation_in_place(size):
    rng = random.Random(size)
    data = rng.randbytes(size)
    for a in {0, 1, size // 3, size // 2, size}:
        if a <= size:
            buffer = bytearray(data)
            FIM.rotate(buffer, 0, a, size)
            assert bytes(buffer) == data[a:] + data[:a]
            FIM.rotate(buffer, 0, size - a, size)
            assert bytes(buffer) == data


def test_op12_on_a_whole_table(spark):
    rows = {r.doc_id: r for r in queries.op12_fill_in_middle(spark, SF).collect()}
    for d in spark.read.parquet(f"{SF}/documents.parquet").collect():
        *start, output = _middle_brute(d.doc_id, d.text)
        r = rows[d.doc_id]
        assert [r.n, r.form, r.prefix_chars, r.middle_chars] == start and r.output_sha256 == sha(output) and r.restored_sha256 == sha(d.text or "")


# -- op 13 ----------------------------------------------------------------------
def test_targets_share_the_excess_again():
    got = source_mixing.targets({"a": 1, "b": 100, "c": 50, None: 49}, {"a": 1, "b": 2, "c": 3, None: 1}, 200, 3)
    assert got["a"] == 3 and got["c"] == Fraction(197, 2) and got["b"] == Fraction(197, 3) and got[None] == Fraction(197, 6)
    tight = source_mixing.targets({"a": 1, "b": 2}, {"a": 1, "b": 1}, 100, 3)
    assert tight == {"a": 3, "b": 6}
    whole = source_mixing.quotas(got)
    assert sum(whole.values()) == 200 and all(abs(whole[s] - got[s]) < 1 for s in got)


def test_route_is_the_cheapest_of_the_largest_flows():
    rng = random.Random(4)
    for _ in range(60):
        names = "xyz"[: rng.randint(1, 3)]
        patterns = [tuple(sorted(rng.sample(names, rng.randint(1, len(names))))) for _ in range(rng.randint(1, 3))]
        patterns = list(dict.fromkeys(patterns))
        sizes = [rng.randint(0, 2) for _ in patterns]
        quota = {s: rng.randint(0, 4) for s in names}
        most = rng.randint(1, 3)
        cost = lambda give: sum(k * min(n, max(0, g - k * n)) for g, n in zip(give, sizes, strict=True) for k in range(most))

        def fits(give):
            units = [i for i, g in enumerate(give) for _ in range(g)]
            return any(all(c[s] <= quota[s] for s in names) for c in (Counter(x) for x in itertools.product(*(patterns[i] for i in units))))

        every = [g for g in itertools.product(*(range(most * n + 1) for n in sizes)) if fits(g)]
        best = min((-sum(g), cost(g)) for g in every)
        got = source_mixing.route(patterns, sizes, quota, most)
        assert fits(got) and (-sum(got), cost(got)) == best


def _by_source(rows):
    out = {}
    for r in rows:
        size, _, target, taken, largest = out.get(tuple(r.members), (0, 0, 0, 0, 0))
        out[tuple(r.members)] = size + r.size, r.source_size, r.target, taken + r.taken, max(largest, r.size)
    return out


def test_op13_on_a_whole_table(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op13_source_mixing(spark, SF).collect()
    assert len(rows) == len(docs)
    sizes, taken, target = Counter(), Counter(), {}
    for r in rows:
        words = len(re.findall(r"[^\x20\x09-\x0D]+", docs[r.doc_id].text or ""))
        assert r.size == words and (r.taken % words == 0 and r.taken <= 3 * words if words else r.taken == 0)
        source = docs[r.doc_id].source
        sizes[source] += words
        taken[source] += r.taken
        target[source] = (r.target, r.source_size)
    weights = {s: (1, 2, 3)[i % 3] for i, s in enumerate(sorted(sizes))}
    want = source_mixing.targets(sizes, weights, sum(sizes.values()), 3)
    assert target == {s: (float(want[s]), sizes[s]) for s in sizes}
    for s in sizes:  # within half of the largest document, at least
        assert abs(taken[s] - want[s]) <= max(r.size for r in rows if docs[r.doc_id].source == s) / 2
    assert sorted(rows) == sorted(queries.op13_source_mixing(spark, SF).collect())


@pytest.mark.parametrize("few", [2, 2000])
def test_mix_meets_targets_whatever_the_partitions(spark, few, monkeypatch):
    monkeypatch.setattr(source_mixing, "FEW", few)
    rng = random.Random(2)
    rows = [(i, "w " * rng.choice([1, 2, 3, 5, 8, 40, 300]), "hot" if i % 3 else f"s{i % 7}") for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    one = source_mixing.mix(docs, F.array("source")).collect()
    two = source_mixing.mix(docs.repartition(13, "text").coalesce(3), F.array("source")).collect()
    assert sorted(one) == sorted(two)
    for size, source_size, target, taken, _ in _by_source(one).values():
        assert size == source_size and abs(taken - target) <= 1
    assert all(r.taken == r.copies * r.size and r.copies <= 3 for r in one)


def test_mix_of_odd_rows(spark):
    docs = odd_documents(spark).withColumns({c: F.lit("x") for c in ("size", "members", "place", "key", "words", "rows", "uid", "extra", "pattern", "target", "used", "p")})
    got = source_mixing.mix(docs, F.array("source")).collect()
    assert len(got) == docs.count() and sum(r.size for r in got) == sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in docs.collect())
    assert {tuple(r.members) for r in got} == {(None,), ("s",)}
    none = source_mixing.mix(docs, F.lit(None).cast("array<string>")).collect()
    assert len(none) == docs.count() and {(r.copies, r.target, r.source_size) for r in none} == {(0, None, None)}
    assert source_mixing.mix(docs.where("false"), F.array("source")).count() == 0


def test_mix_of_repeated_rows_and_overlapping_sources(spark):
    rows = [(1, "a b c", ["x"])] * 400 + [(i, "d e", ["x", "y", "x"]) for i in range(2, 102)] + [(200, "f", ["z", None]), (201, "f g h", ["null"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, s array<string>")
    got = source_mixing.mix(docs, F.col("s"), weights={"x": 2, "y": 1}).collect()
    assert len(got) == len(rows) and {tuple(r.members) for r in got} == {("x",), ("x", "y"), ("z", None), ("null",)}
    sums = _by_source(got)
    total = sum(r.size for r in got)
    # x can give y nothing but the documents of both, three times at most
    assert sums["x", "y"][1] == 1400 and sums["z", None][3] == 3 and sums[("null",)][3] == 9
    assert abs(sum(v[3] for v in sums.values()) - total) <= 3
    assert Counter(r.copies for r in got if r.doc_id == 1).keys() <= {0, 1, 2}


def test_too_many_patterns_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(source_mixing, "MAX_PATTERNS", 3)
    docs = spark.range(5).select(F.col("id").alias("doc_id"), F.lit("a").alias("text"), F.col("id").cast("string").alias("source"))
    with pytest.raises(ValueError, match="more than 3"):
        source_mixing.mix(docs, F.array("source"))
