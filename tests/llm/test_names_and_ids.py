"""Extra columns named like what operators and stages make inside, and ids that
are no numbers: nothing else changes."""

import ast
import glob
import os

import pytest
from pyspark.sql import functions as F

import stratocast.llm
from stratocast.llm import bpe, decontaminate, fill_in_middle, license_scan, minhash_dedup, queries, source_mixing, stages, suffix_dedup, toxicity, url_filter

SF = "/root/testdata/sf0.001"
HERE = os.path.dirname(stratocast.llm.__file__)
GIVEN = {"doc_id", "text", "lang", "source", "n_chars"}


def _inner_names():
    """Every string in the operators' code that could be a column's name."""
    found = set()
    for path in glob.glob(f"{HERE}/*.py"):
        for node in ast.walk(ast.parse(open(path).read())):
            if isinstance(node, ast.Constant) and isinstance(node.value, str) and node.value.isidentifier():
                found.add(node.value.lower())
    return sorted(found - GIVEN - {"url", "page_id", "embedding", "vec_id", "null", "true", "false"})


NAMES = _inner_names()


def _with_names(df):
    return df.select("*", *[F.concat(F.lit(f"{n}:"), F.lit(i)).alias(n) for i, n in enumerate(NAMES)])


def _documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_the_names_are_many():
    assert len(NAMES) > 150 and {"rid", "decision", "others_", "copies", "kept_id", "w0", "score"} - {"w0"} <= set(NAMES)


STAGES = {
    "toxic": stages.drop_toxic,
    "near": stages.drop_near_duplicates,
    "repeats": stages.cut_repeats,
    "leaks": stages.drop_contaminated,
}


@pytest.mark.parametrize("name", sorted(STAGES))
def test_stages_keep_columns_of_any_name(spark, name):
    docs = _documents(spark)
    plain = STAGES[name](spark, docs, SF)
    out = STAGES[name](spark, _with_names(docs), SF)
    assert out.columns == [*docs.columns, *NAMES]
    assert sorted(map(repr, out.select(*docs.columns).collect())) == sorted(map(repr, plain.collect()))
    for row in out.select(*NAMES).distinct().collect():
        assert list(row) == [f"{n}:{i}" for i, n in enumerate(NAMES)]


def _operators(spark):
    ranks, pattern = bpe.public_vocabulary()
    bench, labels = spark.read.parquet(f"{SF}/benchmark.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    return {
        "decontaminate": (lambda d: decontaminate.contamination(d, bench), ["n_words", "n_hit", "items", "contaminated"]),
        "suffix": (lambda d: suffix_dedup.repeated_spans(d), ["n_bytes", "spans", "kept"]),
        "toxicity": (lambda d: toxicity.score(d, labels), ["held_out", "score", "predicted"]),
        "middle": (lambda d: fill_in_middle.fill_in_middle(d), ["n", "form", "prefix_chars", "middle_chars", "output"]),
    }


@pytest.mark.parametrize("name", ["decontaminate", "suffix", "toxicity", "middle"])
def test_operators_keep_columns_of_any_name(spark, name):
    run, made = _operators(spark)[name]
    docs = _documents(spark)
    plain, out = run(docs), run(_with_names(docs))
    kept = [n for n in NAMES if n not in made]
    assert sorted(out.columns) == sorted([*docs.columns, *kept, *made])
    columns = [*docs.columns, *made]
    assert sorted(map(repr, out.select(*columns).collect())) == sorted(map(repr, plain.select(*columns).collect()))
    for row in out.select(*kept).distinct().collect():
        assert list(row) == [f"{n}:{NAMES.index(n)}" for n in kept]


def test_operators_that_return_no_other_columns(spark):
    docs = _documents(spark)
    for run in (
        lambda d: minhash_dedup.near_duplicates(d, 4, 80),
        lambda d: source_mixing.mix(d, F.array("source")),
    ):
        assert sorted(map(repr, run(_with_names(docs)).collect())) == sorted(map(repr, run(docs).collect()))


def test_url_filter_keeps_columns_of_any_name(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url")
    more = [*NAMES, *[f"w{i}" for i in range(8)]]
    more = [n for n in dict.fromkeys(more) if n not in ("host", "path", "rule", "verdict")]
    wide = pages.select("*", *[F.lit(n).alias(n) for n in more])
    judge = lambda p: url_filter.judge(p, queries.URL_RULES, pages.where("page_id % 100 = 0"))
    plain, out = judge(pages), judge(wide)
    assert sorted(map(repr, out.select(*plain.columns).collect())) == sorted(map(repr, plain.collect()))
    assert [list(r) for r in out.select(*more).distinct().collect()] == [more]


def test_ids_that_are_strings(spark):
    """Item and document ids keep their type; sorted as strings."""
    docs, bench = _documents(spark), spark.read.parquet(f"{SF}/benchmark.parquet")
    named = bench.withColumn("item_id", F.concat(F.lit("q-"), F.col("item_id")))
    numbers = {r.doc_id: r["items"] for r in decontaminate.contamination(docs, bench).collect()}
    strings = {r.doc_id: r["items"] for r in decontaminate.contamination(docs, named).collect()}
    assert any(numbers.values()) and strings == {k: sorted(f"q-{i}" for i in v) for k, v in numbers.items()}
    texts = docs.withColumn("doc_id", F.format_string("d%06d", "doc_id"))
    plain = {r.doc_id: (r.component_id, r.kept) for r in minhash_dedup.near_duplicates(docs, 4, 80).collect()}
    got = {r.doc_id: (r.component_id, r.kept) for r in minhash_dedup.near_duplicates(texts, 4, 80).collect()}
    assert got == {f"d{k:06d}": (f"d{c:06d}", kept) for k, (c, kept) in plain.items()}
    assert license_scan.scan_licenses(texts).count() == docs.count()
