"""Operators 2, 6, 7, 9 and 10, the registered queries and the pipeline."""

import os
import random
import subprocess
import sys
import zlib

import duckdb
import numpy as np
import pytest
from helpers import ODD_TEXTS, Groups, near_duplicate_classes, odd_documents, sha
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from stratocast.llm import bpe, chat_format, embedding_dedup, queries, stages, token_counts, toxicity, url_filter

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")
VOCABULARY, PATTERN = bpe.public_vocabulary()


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
@pytest.mark.parametrize("folder", [SF, "/root/testdata/sf0.01"])
def test_queries_with_sql(spark, name, folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    got = queries.queries()[name](spark, folder)
    want = con.sql(queries.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    order = [want.columns.index(c) for c in got.columns]
    rows = [tuple(r[i] for i in order) for r in want.fetchall()]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, rows))


# -- op 2 -----------------------------------------------------------------------
def test_token_counts(spark):
    own = bpe.Encoder(bpe.load_ranks(VOCABULARY), PATTERN)
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    lengths = sorted(len(own.encode(t)) for t in texts)
    sums = queries.op2_token_counts(spark, SF).cache()
    rows = sorted(sums.collect(), key=lambda r: r.n_tokens)
    assert [r.n_tokens for r in rows for _ in range(r.n_docs)] == lengths
    for r in rows:
        longer = [x for x in lengths if x >= r.n_tokens]
        assert (r.docs_from, r.tokens_from) == (len(longer), sum(longer))
        assert r.truncated_total == sum(min(x, r.n_tokens) for x in lengths)
        assert (r.docs_total, r.tokens_total) == (len(lengths), sum(lengths))
        assert lengths[r.rank_from - 1] == lengths[r.rank_to - 1] == r.n_tokens
    shares = {r.share: r.n_tokens for r in token_counts.quantiles(sums, [0.0, 0.5, 0.99, 1.0]).collect()}
    for share, n in shares.items():
        assert n == min(x for x in lengths if sum(y <= x for y in lengths) >= max(1, share * len(lengths)))
    totals = {r.context_limit: r.total for r in token_counts.truncated_totals(sums, [0, 7, 512, 10**9]).collect()}
    assert totals == {c: sum(min(x, c) for x in lengths) for c in totals}


def test_token_counts_of_odd_rows(spark):
    histogram = token_counts.length_histogram(odd_documents(spark), VOCABULARY, PATTERN)
    rows = {r.n_tokens: r.n_docs for r in histogram.collect()}
    assert sum(rows.values()) == len(ODD_TEXTS) + 4 and rows[0] == 3
    assert token_counts.suffix_sums(histogram.where("false")).count() == 0


# -- op 6 -----------------------------------------------------------------------
def _near_vectors_brute(vectors, threshold):
    good = {
        i: np.array(v, float)
        for i, v in vectors
        if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and np.any(np.array(v, float))
    }
    groups, links = Groups(), dict.fromkeys([i for i, _ in vectors], 0)
    for i, _ in vectors:
        groups.top(i)
    ids = sorted(good)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            x, y = good[a], good[b]
            if len(x) == len(y) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold:
                links[a] += 1
                links[b] += 1
                groups.join(a, b)
    return {i: (links[i], groups.top(i), groups.top(i) == i) for i, _ in vectors}


@pytest.mark.parametrize("kind", ["float", "double"])
def test_near_vectors(spark, kind):
    rng = np.random.default_rng(2)
    vectors = []
    for i in range(150):
        if i and rng.random() < 0.6:
            old = np.array(vectors[rng.integers(i)][1])
            v = old * rng.choice([1.0, 3.0]) + rng.choice([0, 0.05, 0.3]) * rng.normal(size=8)
        else:
            v = rng.normal(size=8)
        vectors.append((i, [float(x) for x in v.astype(np.float32)]))
    odd = [None, [], [0.0] * 8, [1.0, None] + [0.0] * 6, [float("nan")] * 8, [float("inf")] + [0.0] * 7, [1.0, 0.0], [1.0, 0.0]]
    vectors += [(200 + i, v) for i, v in enumerate(odd)] + [(300, vectors[0][1]), (301, vectors[0][1])]
    df = spark.createDataFrame(vectors, f"vec_id long, embedding array<{kind}>").withColumn("label", F.lit(None))
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_vectors(df, 0.95).collect()}
    want = _near_vectors_brute(vectors, 0.95)
    assert got == want and sum(n for n, _, _ in want.values()) > 100
    assert embedding_dedup.near_vectors(df.where("false")).count() == 0


def test_quantisation_bound_holds():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 24)) * rng.choice([1, 1e-3, 50], size=(300, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    q, s, length, error = embedding_dedup.quantise(x)
    assert np.abs(q).max() == 127 and np.all(q == np.rint(q))
    true, approx = x @ x.T, s[:, None] * s * (q @ q.T)
    assert np.all(np.abs(true - approx) <= length[:, None] * error + error[:, None] + 1e-12)


def test_op6_on_a_whole_table(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()
    want = _near_vectors_brute([(r.vec_id, r.embedding) for r in rows], 0.95)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in queries.op6_embedding_near_dedup(spark, SF).collect()}
    assert got == want


# -- op 7 -----------------------------------------------------------------------
def _labelled(spark, count=600):
    rng = random.Random(7)
    syllables = ["ba", "do", "ki", "lu", "me", "ny", "po", "ra", "se", "tu", "vo", "wi"]
    word = lambda: "".join(rng.choices(syllables, k=rng.randint(1, 4)))
    docs, labels = [], []
    for i in range(count):
        words = [word() for _ in range(rng.randint(5, 60))]
        toxic = rng.random() < 0.2
        if toxic:
            for insult in rng.choices(["grubhead", "snivelwort", "fizzlank"], k=2):
                words.insert(rng.randrange(len(words)), insult.capitalize() + rng.choice(["", ".", "!"]))
        docs.append((i, " ".join(words)))
        labels.append((i, None, int(toxic)))
    return (
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
        {i: t for i, _, t in labels},
    )


def test_toxicity_held_out(spark):
    docs, labels, truth = _labelled(spark)
    extra = [
        (1000, "ba do grubxhead ki lu"),  # an inserted character
        (1001, "ba do snivel-wort ki"),
        (1002, "me ny f i z z l a n k po"),  # spelt with gaps
        (1003, "ba do ki lu me ny"),
        (1004, None),
        (1005, ""),
        (1006, "ra se " * 5000 + "grubhead"),
    ]
    docs = docs.union(spark.createDataFrame(extra, "doc_id long, text string")).withColumn("score", F.lit("clash"))
    out = toxicity.score(docs, labels)
    assert out.columns == ["doc_id", "text", "held_out", "score", "predicted"]
    rows = {r.doc_id: r for r in out.collect()}
    for i, r in rows.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    right = [rows[i].predicted == t for i, t in truth.items() if rows[i].held_out]
    assert len(right) > 150 and np.mean(right) > 0.97
    assert [rows[i].predicted for i in range(1001, 1007)] == [1, 1, 0, 0, 0, 1]
    assert rows[1000].score > 5 * rows[1003].score and rows[1004].score == rows[1005].score <= rows[1003].score
    # held-out labels are never used
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {r.doc_id: r.score for r in toxicity.score(docs, flipped).collect()}
    assert again == {i: r.score for i, r in rows.items()}


def test_toxicity_of_insults_with_a_letter_put_in(spark):
    docs, labels, truth = _labelled(spark)
    rng = random.Random(11)
    planted = ["ba do grubxhead ki lu"]
    for insult in ("grubhead", "snivelwort", "fizzlank") * 20:
        at = rng.randrange(1, len(insult))
        planted.append("ba do " + insult[:at] + rng.choice("abcdefghijklmnopqrstuvwxyz") + insult[at:] + " ki lu")
    extra = spark.createDataFrame([(3000 + i, t) for i, t in enumerate(planted)], docs.schema)
    got = {r.doc_id: r.predicted for r in toxicity.score(docs.union(extra), labels).collect()}
    assert [got[3000 + i] for i in range(len(planted))] == [1] * len(planted)
    assert sum(got[i] for i, t in truth.items() if not t) <= 5


def test_toxicity_of_glued_insults(spark):
    docs, labels, truth = _labelled(spark)
    texts = ["ba lume/grubhead ki", "ba grubhead...fizzlank", "such-a-grubhead-me", "doyouknowgrubheadki lu", "nysnivelwortba", "漢字漢字grubhead漢字漢字漢字漢字"]
    clean = ["ba lume/dora ki", "badokilumenyporase lu", "漢字漢字漢字漢字漢字"]
    extra = [(2000 + i, t) for i, t in enumerate(texts + clean)]
    out = toxicity.score(docs.union(spark.createDataFrame(extra, docs.schema)), labels).collect()
    got = {r.doc_id: r.predicted for r in out}
    assert [got[2000 + i] for i in range(len(extra))] == [1] * len(texts) + [0] * len(clean)
    assert sum(got[i] for i, t in truth.items() if not t) <= 5


def test_toxicity_with_a_group_of_copies(spark):
    """A third of the rows are one toxic text of rare words; the insults of the
    others still count."""
    docs, labels, truth = _labelled(spark)
    rng = random.Random(3)
    rare = " ".join("".join(rng.choices("bcdfgjklmnpqrtvwxz", k=7)) for _ in range(150))
    copies = spark.range(5000, 5300).select(F.col("id").alias("doc_id"))
    docs = docs.union(copies.select("doc_id", F.lit(rare)))
    labels = labels.union(copies.select("doc_id", F.lit(None).cast("int"), F.lit(1)))
    rows = {r.doc_id: r for r in toxicity.score(docs, labels).collect()}
    right = [rows[i].predicted == t for i, t in truth.items() if rows[i].held_out]
    assert np.mean(right) > 0.97


def test_insult_landmarks_cover_every_family():
    rng = random.Random(1)
    words = ["^" + "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=8)) + "$" for _ in range(800)]
    model = toxicity.train_strings([(w, 5) for w in words[:300]], [(w, 9) for w in words[300:]])
    assert (model.decisions(words[:300]) > 0).mean() > 0.99 > 0.05 > (model.decisions(words[300:]) > 0).mean()


def test_toxicity_without_usable_labels(spark):
    docs = odd_documents(spark)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in toxicity.score(docs, none).collect()} == {0.0}
    odd = spark.createDataFrame([(0, 1, None), (None, 1, 1), (3, 0, 0), (5, 0, 0), (6, None, 0)], none.schema)
    rows = toxicity.score(docs, odd).collect()
    assert {r.score for r in rows} == {0.0} and len(rows) == len(ODD_TEXTS) + 4
    assert toxicity.score(docs.where("false"), none).count() == 0


def test_kernel_bound_never_hides_a_near_string():
    rng = random.Random(0)
    words = ["".join(rng.choices("abcdef", k=rng.randint(3, 10))) for _ in range(400)]
    model = toxicity.train_strings([(w, 5) for w in words[:20]], [(w, 3) for w in words[20:120]])
    model.decisions(["abc"])
    like = model.kernel(words)[:, : model.insults].max(1)
    near = set(model.near(words))
    assert all(i in near for i in range(len(words)) if like[i] >= toxicity.NEAR**toxicity.POWER)


# -- op 9 -----------------------------------------------------------------------
def test_chat_round_trip(spark):
    nasty = ["</turn>", "<sep>", "<\\sep>", "<\\\\turn>", "<", "<turn", "turn>", "</turn>\n", "\\", "### x", "", None, "é😀", "a<sep", ">"]
    rng = random.Random(9)
    rows = []
    for c in range(40):
        for t in range(rng.randint(1, 9)):
            text = None if rng.random() < 0.1 else "".join(x or "" for x in rng.choices(nasty, k=rng.randint(0, 4)))
            rows.append((c, t, rng.choice(["user", "assistant", "assistant", "system", "o\ndd\\n<sep>", None]), text))
    rows += [rows[0], (None, None, "assistant", "x"), (None, 1, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("t", F.lit("clash")).repartition(4)
    out = chat_format.format_conversations(df)
    out = out.withColumn("turns", chat_format.read_turns(F.col("formatted"))).withColumn(
        "loss", chat_format.masked_text(F.col("formatted"), F.col("loss_mask"))
    )
    got = {r.conv_id: r for r in out.collect()}
    assert set(got) == {r[0] for r in rows}
    for c, r in got.items():
        own = sorted(((x[1] is not None, x[1] or 0, x[2] or "", x[3] or "") for x in rows if x[0] == c), key=lambda x: x[:3])
        read = [(t.role, t.text) for t in r.turns]
        assert sorted(read) == sorted((x[2], x[3]) for x in own)
        assert [x[0] for x in read] == [x[2] for x in own]
        assert r.loss == "".join(t for role, t in read if role == "assistant")
        changes = 1 + sum(a[0] != b[0] for a, b in zip(read, read[1:]))
        assert r.formatted.count("</turn>\n") == changes  # adjacent turns of a role share a block
    assert chat_format.format_conversations(df.where("false")).count() == 0


def test_op9_has_the_extra_conversation(spark):
    row = queries.op9_chat_format(spark, SF).where("conv_id = -7").first()
    said = "\\### Assistant: </turn> ok"
    assert (row.n_turns, row.loss_chars, row.loss_sha256) == (2, len(said), sha(said))
    assert row.turns_sha256 == sha(f"user\n{said}\nassistant\n{said}\n")


def test_chat_plan_has_no_python(spark):
    plan = queries.op9_chat_format(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# -- op 10 ----------------------------------------------------------------------
def test_url_parts_and_rules(spark):
    cases = {
        "HTTPS://WWW.Example.ORG/en/12?x#y": ("www.example.org", "/en/12", "example.org/en/1", "block"),
        "http://example.org/es": ("example.org", "/es", "org/", "allow"),
        "http://example.org/es/": ("example.org", "/es/", "example.org/es/", "block"),
        "http://badexample.org/es/": ("badexample.org", "/es/", "org/", "allow"),
        "http://a.com/de/?q": ("a.com", "/de/", "com/de/", "block"),
        "http://a.net#/fr/": ("a.net", "", None, "allow"),
        "http://x.net/p/?utm_source=a&b=1": ("x.net", "/p/", None, "block"),
        "https://www.X.net/p?b=1#z": ("www.x.net", "/p", None, "block"),
        "https://x.net/p?b=2": ("x.net", "/p", None, "allow"),
        "a://b://c/d": ("b:", "//c/d", None, "allow"),
        "no scheme": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "x://": ("", "", None, "allow"),
        "http://ÄB.net/ß\n?": ("Äb.net", "/ß\n", None, "allow"),
        "http://org": ("org", "", None, "allow"),
    }
    listed = ["ftp://x.net/p/?b=1&ref=me", "ftp://x.net/p/?b=1&ref=me", None, "nothing", "http://a.com/fr/1"]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(cases)], "page_id long, url string").withColumn("host", F.lit(0))
    pages = pages.union(pages.where("page_id = 0"))
    block = spark.createDataFrame([(u,) for u in listed], "url string")
    out = url_filter.judge(pages, queries.URL_RULES, block)
    assert out.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    rows = out.collect()
    assert len(rows) == len(cases) + 1
    for r in rows:
        assert (r.host, r.path, r.rule, r.verdict) == cases[r.url], r.url
    empty = block.where("false")
    assert {r.verdict for r in url_filter.judge(pages, [], empty).collect()} == {"allow"}
    assert url_filter.judge(pages.where("false"), queries.URL_RULES, block).count() == 0


def test_a_full_filter_still_gives_exact_verdicts(spark, monkeypatch):
    """One block for many URLs: nearly everything passes, the join decides."""
    monkeypatch.setattr(url_filter, "MAX_BLOCKS", 1)
    pages = spark.range(0, 2000).select(F.col("id").alias("page_id"), F.format_string("http://h%d.net/%d", F.col("id") % 7, "id").alias("url"))
    out = url_filter.judge(pages, [], pages.where("page_id % 3 = 0")).collect()
    assert len(out) == 2000 and all((r.verdict == "block") == (r.page_id % 3 == 0) for r in out)


# -- registration and pipeline --------------------------------------------------------
def test_registration():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries() and set(queries.oracle_sql()) <= set(entry.oracle_sql())
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "minhash_near_dedup", "suffix_array_dedup", "benchmark_decontamination", "byte_bpe"
    ]


def test_entry_without_this_folder(tmp_path):
    root = os.path.dirname(os.path.abspath(entry.__file__))
    code = (
        "import sys; sys.modules['corpus_pipeline'] = None\n"
        "import importlib.abc\n"
        "class Gone(importlib.abc.MetaPathFinder):\n"
        "    def find_spec(self, name, path, target=None):\n"
        "        if name == 'corpus_pipeline' or name.startswith('stratocast.llm'): raise ModuleNotFoundError(name, name=name)\n"
        "del sys.modules['corpus_pipeline']; sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e; assert len(e.queries()) > 40 and not any(n.startswith('op') or n == 'pipeline' for n in e.queries())\n"
        "assert set(e.oracle_sql()) == set(e.queries())\n"
    )
    subprocess.run([sys.executable, "-c", code], check=True, cwd=root, env=os.environ | {"PYTHONPATH": root})


def test_stages_on_odd_rows(spark, tmp_path):
    folder = str(tmp_path)
    long = "this passage of many words is said in two documents and so it goes from both of them " * 6
    texts = [*ODD_TEXTS, "aa bb cc " + long, long + " dd ee ff", "one two three four five six seven eight nine ten eleven"]
    docs = odd_documents(spark, texts)
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    items = [(1, "one two three four five six seven eight nine ten")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    n = len(texts)
    kept = stages.drop_toxic(spark, docs, folder)
    assert kept.columns == docs.columns and kept.count() == n + 4
    kept = stages.drop_near_duplicates(spark, docs, folder)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id is None, r.doc_id) for r in kept.collect())
    assert ids == [(False, i) for i in range(n)] + [(True, None)]
    cut = {r.doc_id: r for r in stages.cut_repeats(spark, kept, folder).collect()}
    # the passage repeats itself, so the space before it is part of what repeats
    assert cut[n - 3].text == "aa bb cc" and cut[n - 2].text == " dd ee ff" and cut[n - 3].n_chars == 8
    assert cut[0].text is None and cut[1].text == ""
    clean = stages.drop_contaminated(spark, kept, folder)
    assert clean.columns == docs.columns and {n - 1} == {r.doc_id for r in kept.collect()} - {r.doc_id for r in clean.collect()}
    assert corpus_pipeline.run(spark, folder).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_near_duplicates_stage_decides_by_row(spark):
    """Different texts without an id, and under one id, stay; near copies go."""
    rng = random.Random(4)
    text = lambda: " ".join(f"w{rng.randrange(10**6)}" for _ in range(60))
    a, b, c, d, e, f, g = (text() for _ in range(7))
    near = lambda t: t + " more"
    rows = [(None, a), (None, b), (None, b), (None, near(b)), (5, c), (5, d), (5, d), (2, near(c)), (7, e), (None, e), (8, f), (8, near(f)), (None, ""), (None, None), (None, ""), (9, g)]
    docs = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, row int")
    kept = {r.row for r in stages.drop_near_duplicates(spark, docs, "").collect()}
    assert {0, 7, 8, 12, 13, 14, 15} <= kept and 9 not in kept
    assert [len(kept & group) for group in ({1, 2, 3, 4}, {5, 6}, {10, 11})] == [1, 1, 1] and len(kept) == 10


def test_pipeline_on_a_whole_table(spark):
    """The stages' decisions against brute force on what each got."""
    from helpers import contamination, repeated_bytes

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in stages.drop_toxic(spark, docs, SF).collect()}
    groups = near_duplicate_classes(texts, 5, 80)
    texts = {i: t for i, t in sorted(texts.items()) if groups[i] == i}
    raw = [t.encode() for t in texts.values()]
    left = [bytes(b for b, f in zip(t, flags) if not f).decode(errors="ignore") for t, flags in zip(raw, repeated_bytes(raw, 400))]
    texts = {i: new for (i, old), new in zip(texts.items(), left) if new or not old}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    texts = {i: t for i, t in texts.items() if not contamination(t, items, 10)[1]}
    own = bpe.Encoder(bpe.load_ranks(VOCABULARY), PATTERN)
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert set(got) == set(texts)
    for i, t in texts.items():
        ids = own.encode(t)
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == (len(ids), sha(",".join(map(str, ids))), sha(t))
