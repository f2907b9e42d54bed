"""Registered queries that SQL can't express, on whole small tables against plain versions of their contracts."""

from __future__ import annotations

import os
import random
import sys
from collections import Counter

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402
from txrisk.llm import ctph, queries  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, fingerprint string, position string, score string, tie string"


def table(spark, folder, rows):
    """`rows` of (doc_id, text, lang, source) as documents, with extra columns whose names the operators use."""
    data = [(*row, len(row[1] or ""), "x", "x", "x", "x") for row in rows]
    spark.createDataFrame(data, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def asked(spark, name, folder):
    return queries.QUERIES[name](spark, folder).collect()


def test_languages_of_held_out_texts(spark, tmp_path):
    rng = random.Random(8)
    syllables = {"aa": ["ka", "to", "mi", "ra"], "bb": ["sch", "ung", "ein", "ver"], "cc": ["eau", "oix", "ent", "que"]}

    def text(lang, n):
        return " ".join("".join(rng.choices(syllables[lang], k=rng.randint(1, 4))) for _ in range(n))

    rows, true = [], {}
    for i in range(600):
        true[i] = rng.choice(list(syllables))
        # Held-out rows are labelled wrongly: their labels must not be learned.
        label = "dd" if brute.fold(i, 5) == 0 else true[i] if i % 9 else None
        rows.append((i, text(true[i], rng.choice([5, 40, 300])), label, None if i % 3 else "s"))
    rows += [(600, None, "aa", "s"), (601, "", "aa", "s"), (602, "12 ... ½ 34", "aa", "s"), (603, text("bb", 30_000), "bb", "s"),
             (None, text("aa", 30), "aa", None), rows[1]]
    found = asked(spark, "op3_language_id", table(spark, tmp_path, rows))
    assert Counter(r["doc_id"] for r in found) == Counter(row[0] for row in rows)
    for r in found:
        assert 0 <= r["score"] <= 1 and r["lang_pred"] in {"und", *syllables}
        assert r["held_out"] == (brute.fold("" if r["doc_id"] is None else r["doc_id"], 5) == 0)
    by_id = {r["doc_id"]: r for r in found}
    assert [by_id[i]["lang_pred"] for i in (600, 601, 602, 603, None)] == ["und", "und", "und", "bb", "aa"]
    held = [r for r in found if r["held_out"] and r["doc_id"] in true]
    assert sum(r["lang_pred"] == true[r["doc_id"]] for r in held) >= 0.98 * len(held) > 0
    assert sum(r["rejected"] for r in held) <= 0.02 * len(held)


def test_mixed_sources(spark, tmp_path):
    rows = [(i, "t", "en", None if i % 10 < 3 else "a" if i % 10 < 9 else "b") for i in range(6000)]
    rows += [(None, "t", "en", "b"), rows[5]]
    found = asked(spark, "op4_pfair_mix", table(spark, tmp_path, rows))
    assert Counter((r["doc_id"], r["source"]) for r in found) == Counter((row[0], row[3]) for row in rows)
    assert len({r["position"] for r in found}) == len(rows) and all(r["slot"] == r["position"] // 32 for r in found)
    counts = Counter(row[3] for row in rows)
    weights = {s: n ** 0.7 for s, n in counts.items()}
    done, ordered = Counter(), sorted(found, key=lambda r: r["position"])
    for k, r in enumerate(ordered, 1):
        done[r["source"]] += 1
        # Until a source runs out each is within a block of its share, and the share is held in thousandths.
        if any(done[s] >= n - 32 for s, n in counts.items()):
            break
        if k % 32 == 0:
            assert all(abs(done[s] - k * w / sum(weights.values())) <= 32 + k / 1000 for s, w in weights.items())
    assert k > 1000


@pytest.mark.parametrize("ids", [[5], [], None])
def test_fingerprints_of_texts_edited_texts_and_next_ones(spark, tmp_path, ids):
    rng = random.Random(9)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(300)]
    if ids is None:
        ids = [-7, *rng.sample(range(10_000), 60)]
    texts = {i: " ".join(rng.choices(words, k=rng.choice([0, 1, 3, 80, 900]))) for i in ids}
    if len(ids) > 9:
        texts[ids[0]], texts[ids[1]], texts[ids[2]] = None, "é" * 5 + "日本語 " * 40, "z" * 100_000
        texts[ids[4]] = texts[ids[3]]
    folder = table(spark, tmp_path, [(i, text, "en", "s") for i, text in texts.items()])
    found = {r["doc_id"]: r for r in asked(spark, "op10_ctph", folder)}
    assert len(found) == len(ids)
    whole = {i: text or "" for i, text in texts.items()}
    changed, order = brute.edited(whole), sorted(whole, reverse=True)
    for here, there in zip(order, order[1:] + order[:1]):
        r, own, other = found[here], ctph.fingerprint(whole[here]), ctph.fingerprint(changed[here])
        assert (r["n_chars"], r["edited_sha256"]) == (len(whole[here]), brute.sha256(changed[here]))
        assert (r["fingerprint"], r["edited_fingerprint"]) == (own, other)
        assert r["near_edited"] == pytest.approx(ctph.likeness(own, other))
        assert r["near_next"] == pytest.approx(ctph.likeness(own, ctph.fingerprint(whole[there])))
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1


def test_fingerprints_of_rows_with_equal_ids_and_without_one(spark, tmp_path):
    rows = [(1, "one two three " * 40, "en", "s")] * 5 + [(None, "four five", "en", "s"), (None, None, None, None), (2, "six", "en", "s")]
    found = asked(spark, "op10_ctph", table(spark, tmp_path, rows))
    assert Counter(r["doc_id"] for r in found) == Counter(row[0] for row in rows)
    assert len({r["fingerprint"] for r in found if r["doc_id"] == 1}) == 1
