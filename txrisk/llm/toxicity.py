"""Toxic passages as maximum-scoring segments of token log-odds.

Tokens are words in lower case and, for words too rare to judge, their first four letters. Each gets the log-odds of
the toxic against the other class with an informative Dirichlet prior, in proportion to its frequency in both classes,
from document counts. Tokens significantly on the toxic side score their log-odds; all others score the
small negative log-odds of an ordinary token. One linear scan finds all maximal segments of positive score.

Extreme-value calibration: in other documents of n tokens the best segment's score S follows
P(S > s) = 1 - exp(-K n exp(-lambda (s - u))) beyond the least score u, in toxic ones a Frechet distribution (log S a Gumbel).
The document's score is the posterior of the toxic class. Every training row takes part in it, scored by a model of the
other `FOLDS` - 1 parts, so that no row judges itself. A passage is reported if less than `EXPECTED` like it are expected in so
long an ordinary text.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from txrisk.llm.common import blocks, own_name, stored, text_column

WORDS = re.compile(r"[^\W\d_]+")
STEM = 4
# A classifier is fitted on so many rows of each class at most, those of the least hash of their id.
MOST_ROWS = 40_000
MOST_WORDS = 500_000
PRIOR = 0.1
FOLDS = 5
EXPECTED = 0.01
# The log-odds of a token that speaks for neither class: toxic passages hold about one toxic token in fifty.
ORDINARY = -0.02
RESULT = "score double, best double, n long, passages array<struct<start:int,end:int,score:double,expected:double>>"


@dataclass
class Calibration:
    """Parameters of both distributions, and the share of toxic rows."""

    prior: float
    k: float
    decay: float
    least: float
    quiet: float  # share of other rows without a segment
    mode: float  # of the logarithm, as is the scale
    scale: float
    none: float  # share of toxic rows without a segment


@dataclass
class Model:
    tokens: dict[str, float]
    ordinary: float
    calibration: Calibration | None

    def posterior(self, best: float, n: int) -> float:
        """The share of toxic documents among those of `n` tokens with such a best segment."""
        c = self.calibration
        if c is None:
            return 0.5
        odds = c.none / c.quiet
        if best > 0:
            # Beyond its mode the toxic density counts as level, as does the other one before its mode: more evidence never
            # lowers the score, and the least segment is no better than none.
            z = max(min((math.log(best) - c.mode) / c.scale, -math.log1p(c.scale)), -4.0)
            toxic = (1 - c.none) * math.exp(-(z + math.exp(-z)) - (c.mode + c.scale * z)) / c.scale
            rate = min(self.expected(best, max(n, 1)), 1.0)
            odds = max(odds, toxic / max(rate * c.decay * math.exp(-rate), 1e-300))
        return 1 / (1 + (1 - c.prior) / (c.prior * odds))

    def expected(self, score: float, n: int) -> float:
        c = self.calibration
        return math.inf if c is None else c.k * n * math.exp(-c.decay * max(score - c.least, 0.0))


class Weights(dict):
    """Scores of words as they are met."""

    def __init__(self, model: Model) -> None:
        super().__init__()
        self.model = model

    def __missing__(self, word: str) -> float:
        tokens, token = self.model.tokens, word.lower()
        score = tokens.get(token)
        if score is None:
            score = tokens.get("^" + token[:STEM], self.model.ordinary) if len(token) > STEM else self.model.ordinary
        self[word] = score
        return score


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal segments (start, end, sum) of positive sum, in one pass, by their cumulative bounds."""
    total = np.concatenate([[0.0], np.cumsum(scores)])
    found: list[tuple[int, int, float, float]] = []  # start, end, sums before and after
    lower: list[int] = []  # of each, the last earlier one whose sum before is lower
    for at in np.flatnonzero(scores > 0).tolist():
        start, before, after = at, total[at], total[at + 1]
        i = len(found) - 1
        while True:
            while i >= 0 and found[i][2] >= before:
                i = lower[i]
            if i < 0 or found[i][3] >= after:
                break
            start, before = found[i][0], found[i][2]
            del found[i:], lower[i:]
            i = len(found) - 1
        found.append((start, at + 1, before, after))
        lower.append(i)
    return [(start, end, float(after - before)) for start, end, before, after in found]


def count_tokens(rows: DataFrame) -> DataFrame:
    """(part, token, toxic, other): in how many texts of each part and class of (toxic, part, text) rows a token is."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[int, str], list[int]] = {}

        def counted() -> pa.RecordBatch:
            found = pa.RecordBatch.from_arrays(
                [pa.array([part for part, _ in counts], pa.int32()), pa.array([token for _, token in counts], pa.string()),
                 *(pa.array([n[k] for n in counts.values()], pa.int64()) for k in (1, 0))],
                ["part", "token", "toxic", "other"])
            counts.clear()
            return found

        for block, texts in blocks(batches, 2):
            for toxic, part, text in zip(block.column(0).to_pylist(), block.column(1).to_pylist(), texts):
                words = set(map(str.lower, WORDS.findall(text)))
                words |= {"^" + word[:STEM] for word in words if len(word) > STEM}
                words.add("")  # counts the texts
                for word in words:
                    counts.setdefault((part, word), [0, 0])[toxic] += 1
            if len(counts) > MOST_WORDS:
                yield counted()
        yield counted()

    return (rows.mapInArrow(run, "part int, token string, toxic long, other long").groupBy("part", "token")
            .agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")))


def sample(docs: DataFrame, labels: DataFrame, training: Column, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """(toxic, part, text): training rows with a label, in `FOLDS` parts.

    An id with several labels counts as toxic if any is. Of near copies in a class one is taken, so that a word that
    only they have doesn't count for many. At most `MOST_ROWS` ids of each class are taken.
    """
    known = (labels.filter(training & F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).alias("label_id")).agg(F.max(F.when(F.col(label_col) > 0, 1).otherwise(0)).alias("toxic")))
    order = [F.xxhash64("label_id"), F.col("label_id")]
    taken = [known.filter(F.col("toxic") == toxic).orderBy(*order).limit(MOST_ROWS) for toxic in (0, 1)]
    ids = taken[0].union(taken[1])
    rows = docs.select(F.col(id_col).alias("id"), text_column(text_col).alias("text"))
    rows = rows.join(F.broadcast(ids), rows["id"] == ids["label_id"])
    part = F.pmod(F.xxhash64(F.lit("part"), "id"), F.lit(FOLDS)).cast("int")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, texts in blocks(batches, 2):
            sketches = pa.array([_sketch(text) for text in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([block.column(0), block.column(1), sketches, pa.array(texts)],
                                             ["toxic", "part", "sketch", "text"])

    sketched = rows.select("toxic", part.alias("part"), "text").mapInArrow(run, "toxic int, part int, sketch binary, text string")
    return sketched.dropDuplicates(["toxic", "sketch"]).drop("sketch")


def _sketch(text: str) -> bytes:
    """The least hash of runs of five words: near copies mostly agree in it, other texts never do."""
    words = text.split()
    return min(xxhash.xxh64_digest(" ".join(words[i:i + 5])) for i in range(max(1, len(words) - 4)))


def fit(docs: DataFrame, labels: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic") -> Model:
    """A model of the labelled rows of `labels` for which `training` holds."""
    rows = stored(sample(docs, labels, training, id_col, text_col, label_col), "toxicity-sample")
    counts = stored(count_tokens(rows.select("toxic", "part", "text")), "toxicity-tokens")
    models = _models(counts)
    model = models[FOLDS]
    scored = score(rows, models, keep=["toxic"], model_col="part")
    best, positive = F.col("best"), F.col("best") > 0
    stats = {row["toxic"]: row for row in scored.groupBy("toxic").agg(
        F.count("*").alias("rows"), F.sum("n").alias("n"), F.count_if(positive).alias("hits"), F.avg(F.when(positive, best)).alias("mean"),
        F.min(F.when(positive, best)).alias("least"), F.avg(F.when(positive, F.log(best))).alias("log_mean"),
        F.stddev_pop(F.when(positive, F.log(best))).alias("log_deviation")).collect()}
    if len(stats) < 2:
        return model
    other, toxic = stats[0], stats[1]
    free = min((other["hits"] + 0.5) / (other["rows"] + 1), 0.99)
    least = other["least"] or 0.0
    scale = max((toxic["log_deviation"] or 0.0) * math.sqrt(6) / math.pi, 0.1)
    model.calibration = Calibration(
        prior=(toxic["rows"] + 0.5) / (toxic["rows"] + other["rows"] + 1),
        k=-math.log(1 - free) * (other["rows"] + 1) / max(other["n"], 1),
        decay=1 / max(other["mean"] - least, 0.25) if other["hits"] > 1 else 1.0, least=least, quiet=1 - free,
        mode=(toxic["log_mean"] or 0.0) - 0.5772 * scale, scale=scale,
        none=(toxic["rows"] - toxic["hits"] + 0.5) / (toxic["rows"] + 1))
    return model


def _models(counts: DataFrame) -> list[Model]:
    """Models not calibrated yet: for each part, of the counts of the others; last, of all counts."""
    of_part = [*(F.col("part") != part for part in range(FOLDS)), F.lit(True)]
    texts = counts.filter("token = ''").select(*[F.struct(
        F.sum(F.when(has, F.col("toxic"))).alias("toxic"), F.sum(F.when(has, F.col("other"))).alias("other")) for has in of_part]).first()
    pairs = stored(counts.filter("token != ''").groupBy("token").agg(*[
        F.sum(F.when(has, F.col(name))).alias(f"{name}{i}") for i, has in enumerate(of_part) for name in ("toxic", "other")]),
        "toxicity-pairs")
    kinds = pairs.agg(*[F.count(f"toxic{i}") for i in range(FOLDS + 1)]).first()
    models = []
    for i, (toxic, other) in enumerate(texts):
        if not toxic or not other:
            models.append(Model({}, ORDINARY, None))
            continue
        with_token, without = F.col(f"toxic{i}"), F.col(f"other{i}")
        # Prior counts are a tenth of the rows, dealt out by frequency in both classes together.
        share = PRIOR * (with_token + without) / (toxic + other)
        a, b = with_token + share * toxic, without + share * other
        odds = F.log(a / (toxic * (1 + PRIOR) - a)) - F.log(b / (other * (1 + PRIOR) - b))
        # Above the largest value that so many tokens without any effect would be expected to reach.
        bound = math.sqrt(2 * math.log(max(kinds[i], 2)))
        sure = pairs.select("token", odds.alias("odds"), (odds / F.sqrt(1 / a + 1 / b)).alias("z")).filter(F.col("z") > bound)
        # Such a token is in several texts of the bounded sample, so the sample bounds their number.
        tokens = sure.collect()
        models.append(Model({row["token"]: row["odds"] for row in tokens}, ORDINARY, None))
    return models


class Scorer:
    def __init__(self, model: Model) -> None:
        self.model, self.weights = model, Weights(model)

    def score(self, text: str) -> tuple[float, float, int, list[dict]]:
        """(posterior, best segment's score, tokens, passages); passages by code points, end exclusive."""
        if len(self.weights) > MOST_WORDS:
            self.weights.clear()
        words = WORDS.findall(text)
        scores = np.fromiter(map(self.weights.__getitem__, words), np.float64, len(words))
        found = segments(scores) if len(words) and scores.max() > 0 else []
        best = max((s for _, _, s in found), default=0.0)
        passages = []
        places = None
        for start, end, value in found:
            if (expected := self.model.expected(value, len(words))) < EXPECTED:
                places = places or [m.span() for m in WORDS.finditer(text)]
                passages.append({"start": places[start][0], "end": places[end - 1][1], "score": value, "expected": expected})
        return self.model.posterior(best, len(words)), best, len(words), passages


def score(docs: DataFrame, model: Model | list[Model], text_col: str = "text", keep: list[str] | None = None,
          model_col: str | None = None) -> DataFrame:
    """The columns `keep` of each row (default: all) with score, best, n and passages.

    With several models `model_col` has the number of each row's own.

    Null texts count as empty and score like any text without a toxic token. Columns of the same names are replaced.
    """
    from pyspark.sql.types import StructType, _parse_datatype_string

    sent = docs.sparkSession.sparkContext.broadcast(model if isinstance(model, list) else [model])
    result = _parse_datatype_string(RESULT)
    keep = [name for name in (docs.columns if keep is None else keep) if name not in result.fieldNames()]
    which = F.lit(0) if model_col is None else F.col(model_col)
    rows = docs.select(*keep, which.alias(own_name(docs, "which")), text_column(text_col).alias(own_name(docs, "whole_text")))
    passage = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("expected", pa.float64())]))

    names = [*keep, *result.fieldNames()]
    n_keep = len(keep)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorers = list(map(Scorer, sent.value))
        for block, texts in blocks(batches, n_keep + 1):
            values = list(zip(*(scorers[i].score(text) for i, text in zip(block.column(n_keep).to_pylist(), texts))))
            yield pa.RecordBatch.from_arrays(
                [*block.columns[:n_keep], pa.array(values[0], pa.float64()), pa.array(values[1], pa.float64()),
                 pa.array(values[2], pa.int64()), pa.array(values[3], passage)], names)

    return rows.mapInArrow(run, StructType([*(docs.schema[name] for name in keep), *result.fields]))
