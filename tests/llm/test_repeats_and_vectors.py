"""Quality rules on repeats, periodic runs and whitened embeddings, with their queries, against plain versions."""

from __future__ import annotations

import math
import os
import random
import sys
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402
from txrisk.llm import feast, periods, queries, repetition, suffixes, whitening  # noqa: E402

# Extra columns have names of the results and of what the operators use themselves.
SCHEMA = "doc_id long, text string, n_words string, kept int, spans string, runs string, text_in string, row string, start string"
EXTRA = ("x", 1, "x", "x", "x", "x", "x")


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    texts = [None, "", " \n\t", "one", "日本 é\x0bx # *|", "a\nb\na\n \na", "x " * 300, "line of nine words that comes again and again\n" * 2]
    for k in range(60):
        words = [f"w{i}" for i in range(rng.choice([1, 2, 3, 10, 500]))]
        base = [rng.choice(words) for _ in range(rng.randint(1, 60))]
        parts = base * rng.choice([1, 1, 2, 5]) + [rng.choice(words) for _ in range(rng.randint(0, 60))] + base[:rng.randint(0, 40)]
        texts.append(rng.choice([" ", "\n", " \t\x0c"]).join(parts))
    common = [f"c{i}" for i in range(2000)]
    texts += [" ".join(rng.choice(common) for _ in range(8_000)), texts[-1], texts[-1]]
    found = [(i, text, *EXTRA) for i, text in enumerate(texts)]
    return found + [found[20], (None, texts[30], *EXTRA), (None, None, *EXTRA), (21, "another text of an id", *EXTRA)]


@pytest.fixture(scope="module")
def folder(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    return path


@pytest.fixture(scope="module")
def blank(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("blank"))
    spark.createDataFrame([], SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], "vec_id long, embedding array<float>").write.parquet(f"{path}/embeddings.parquet")
    return path


def test_suffix_order_and_common_prefixes():
    rng = random.Random(1)
    for _ in range(100):
        texts = [[rng.choice("abc") for _ in range(rng.randint(0, 25))] for _ in range(rng.randint(0, 4))]
        s = suffixes.Suffixes([" ".join(words).encode() for words in texts])
        line = [("start",)]
        for k, words in enumerate(texts):
            line += [(k, word) for word in words] + [("end", k)]
        order = s.order().tolist()
        assert sorted(order) == list(range(len(line)))
        shared = []
        for i, j in zip(order, order[1:]):
            n = 0
            while i + n < len(line) and j + n < len(line) and line[i + n] == line[j + n]:
                n += 1
            shared.append(n)
        at, first, length = s.common(2)
        assert [(a, order[a], n) for a, n in enumerate(shared) if n >= 2] == list(zip(at.tolist(), first.tolist(), length.tolist()))


def test_maximal_repeats_match_all_substrings():
    rng = random.Random(2)
    for _ in range(60):
        texts = [rng.choice([" ", "\n"]).join(rng.choice(["a", "bé", "ccc"]) for _ in range(rng.randint(0, 40))) for _ in range(4)]
        least = rng.randint(1, 6)
        block = repetition.Block(texts, repetition.Limits(least_words=least))
        for t, text in enumerate(texts):
            want, origin = brute.repetition(text, least), block.suffixes.starts[t]
            covered = {i - origin for s, e, o in zip(block.start, block.end, block.of) if o == t for i in range(s, e)}
            assert covered == want["covered"]
            for name in ("n_repeat_words", "n_repeats", "longest_repeat", "covered_chars"):
                assert getattr(block, name)[t] == want[name]


def test_repetition_query(spark, folder, blank, rows):
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_repeats", "longest_repeat",
             "covered_chars")
    got = Counter(tuple(r) for r in queries.op11_suffix_repetition(spark, folder).select("doc_id", *names).collect())
    want = [(r[0], brute.repetition(r[1])) for r in rows]
    assert got == Counter((i, *(w[name] for name in names)) for i, w in want)
    assert {w["kept"] for _, w in want} == {True, False} and any(not w["kept"] and not w["base_failed"] for _, w in want)
    assert queries.op11_suffix_repetition(spark, blank).count() == 0


def test_repetitive_rows_go(spark, folder, rows):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = repetition.drop_repetitive(docs)
    assert kept.schema == docs.schema
    assert Counter(map(tuple, kept.collect())) == Counter(r for r in rows if brute.repetition(r[1])["kept"])
    measured = repetition.measure(docs)
    assert set(measured.columns) == set(docs.columns) | {f.split()[0] for f in repetition.MEASURES.split(", ") if "end" not in f}


@pytest.mark.parametrize("least", [2, 5, 12])
def test_runs_match_all_periods(least):
    rng = random.Random(least)
    for _ in range(150):
        texts = []
        for _ in range(4):
            letters = "abcd"[:rng.randint(1, 4)]
            base = [rng.choice(letters) for _ in range(rng.randint(0, 25))]
            texts.append(base * rng.randint(1, 4) + [rng.choice(letters) for _ in range(rng.randint(0, 15))])
        s = suffixes.Suffixes([" ".join(words).encode() for words in texts])
        want = [(int(s.starts[k]) + start, *rest) for k, words in enumerate(texts) for start, *rest in brute.periodic_runs(words, least)]
        assert periods.runs(s, least) == want


def test_periodic_runs_query(spark, folder, blank, rows):
    got = Counter(tuple(r) for r in queries.op13_periodic_runs(spark, folder).select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256").collect())
    want = []
    for i, text, *_ in rows:
        words = brute.with_periodic_tail(i, brute.words_of(text))
        if len(words) > 5000 and i is not None and words == brute.words_of(text):
            found = []  # eight thousand words at random of two thousand
        else:
            found = brute.periodic_runs(words)
        best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=None)
        figures = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
        lines = "".join(f"{s},{length},{p}\n" for s, length, p in found)
        want.append((i, len(found), *figures, brute.sha256(lines), brute.sha256(brute.collapsed(words, found))))
    assert got == Counter(want)
    assert queries.op13_periodic_runs(spark, blank).count() == 0


def test_texts_without_repetitions(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = periods.find(docs)
    assert set(found.columns) == set(docs.columns) | {"collapsed"}
    row = found.filter("doc_id = 6").first()
    assert [tuple(r) for r in row["runs"]] == [(0, 300, 1)] and row["collapsed"] == "x"


@pytest.mark.parametrize("kind", ["full", "thin", "ties", "steep", "flat", "one"])
def test_contours_find_the_leading_pairs(kind):
    rng = np.random.default_rng(4)
    size = 1 if kind == "one" else 48
    q, _ = np.linalg.qr(rng.standard_normal((size, size)))
    spectrum = {"full": rng.random(size) + 0.1, "thin": np.append(rng.random(20) + 0.1, np.zeros(size - 20)) if size > 20 else None,
                "ties": np.repeat(np.arange(1.0, 7.0), 8), "steep": np.exp(-0.2 * np.arange(size)), "flat": np.ones(size), "one": np.ones(1)}
    matrix = (q * spectrum[kind]) @ q.T
    matrix = (matrix + matrix.T) / 2
    values, vectors = feast.leading(matrix, 32)
    want = np.sort(spectrum[kind][spectrum[kind] > 1e-9])[::-1][:32]
    assert np.allclose(values, want, rtol=1e-12, atol=1e-14)
    assert np.abs(matrix @ vectors - vectors * values).max() < 1e-13 * want[0]
    assert np.abs(vectors.T @ vectors - np.eye(len(want))).max() < 1e-12
    inertia = feast.Inertia(matrix)
    for shift in rng.random(20):
        assert inertia.above(shift) == (np.linalg.eigvalsh(matrix) > shift).sum()


def whitened_rows(spark, path):
    return queries.op12_feast_whitening(spark, path).collect()


def test_whitening_query(spark, tmp_path, blank):
    rng = np.random.default_rng(7)
    data = [(i, [float(v) for v in rng.standard_normal(40) * np.linspace(3, 0.1, 40) + 5], "x") for i in range(500)]
    data += [data[0], (None, data[1][1], "x"), (900, None, "x"), (901, [], "x"), (902, [1.0, None] * 20, "x"), (903, [math.nan] * 40, "x"),
             (904, [math.inf] + [0.0] * 39, "x"), (905, [1.0] * 39, "x"), (906, [1e300] * 40, "x")]
    # Extra columns are called as the results.
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, whitened string").withColumn("n", F.lit(1)).repartition(4)
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    got = defaultdict_of(whitened_rows(spark, str(tmp_path)))
    counted = [(i, v) for i, v, _ in data if v and len(v) == 40 and all(c is not None and math.isfinite(c) for c in v) and v[0] < 1e15]
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for _, v in counted])
    n, sums = len(x), x.sum(axis=0)
    centred = (x * n - sums) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:32], vectors[:, ::-1][:, :32]
    want = centred @ vectors / np.sqrt(values)
    assert sorted(got, key=str) == sorted({i for i, _ in counted}, key=str)
    signs = None
    for (i, v), row, own in zip(counted, want, x):
        mine = got[i]
        assert len(mine) == 32 * sum(j == i for j, _ in counted)
        mine = sorted({r["component"]: r for r in mine}.items())
        assert [c for c, _ in mine] == list(range(1, 33))
        assert {r["deviation"] for _, r in mine} == {int(((n * own - sums) ** 2).sum())} and {r["n"] for _, r in mine} == {n}
        values_ = np.array([r["whitened"] for _, r in mine])
        signs = np.sign(values_ * row) if signs is None else signs
        assert np.allclose(values_, signs * row, atol=1e-8)
    spread = np.var(centred, axis=0).sum()
    assert np.allclose([r["explained"] for _, r in mine], values / spread, rtol=1e-9)
    assert len({r["identity_error"] for rows in got.values() for r in rows}) == 1 and mine[0][1]["identity_error"] < 1e-9
    assert whitened_rows(spark, blank) == []


def defaultdict_of(rows):
    found = {}
    for r in rows:
        found.setdefault(r["vec_id"], []).append(r)
    return found


def test_few_directions_and_large_entries(spark):
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 1e9]) for i in range(10)], "vec_id long, embedding array<double>")
    model = whitening.fit(line)
    assert model.n == 10 and len(model.values) == 1 and model.identity_error < 1e-9
    got = {r["vec_id"]: r for r in whitening.transform(line, model).collect()}
    assert got[3]["deviation"] == sum((10 * 64 * k * 3 - 64 * k * 45) ** 2 for k in (1, 2))
    assert set(got[3].asDict()) == {"vec_id", "embedding", "whitened", "deviation"}
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(3)], "vec_id long, embedding array<double>")
    assert len(whitening.fit(same).values) == 0
    assert [r["whitened"] for r in whitening.transform(same, whitening.fit(same)).collect()] == [[]] * 3
    wide = spark.createDataFrame([(0, [-1e12, 0.0]), (1, [1e12, 1.0]), (2, [3e12, 5.0])], "vec_id long, embedding array<double>")
    model = whitening.fit(wide)
    # The second lies on the first mean, and 192 from three times the other; the others' squares don't fit.
    assert {r["vec_id"]: r["deviation"] for r in whitening.transform(wide, model).collect()} == {0: None, 1: 192 ** 2, 2: None}


def test_products_are_exact():
    rng = np.random.default_rng(1)
    for most in (10, 1 << 20, 1 << 25, 1 << 40):
        y = rng.integers(-most, most, (50, 3))
        assert (products := whitening.products(y)).tolist() == (y.astype(object).T @ y.astype(object)).tolist(), products
