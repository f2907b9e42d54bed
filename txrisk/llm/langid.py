"""Language identification with interpolated Kneser-Ney character models.

A model predicts each letter of a word, and its end, from the three characters before it; words are runs of
letters in lower case, preceded by blanks. Counts of four-character runs are taken over all training texts.
Lower orders count the distinct runs that end alike. Each order keeps one discount, and a sorted array of
64-bit keys (four 16-bit characters; characters beyond are folded) for runs and for contexts.

Counts, discounts and the numbers of distinct runs are taken in Spark over all runs. Tables are then built and sent piece by
piece: a piece has several languages, or of a language with very many runs those with some of the characters before the
last. Each piece adds its nats to the texts; as the runs of all orders that predict a character share the one
before it, no piece needs another, and results are the same however many there are.

A text goes to the language with the lowest cross-entropy per predicted character. Rejection is
calibrated on the training texts: a text is rejected if its cross-entropy exceeds the mean of its language by
`REJECT_AT` deviations, of texts and, by length, of characters.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from txrisk.llm.common import Numbers, blocks, id_hash, own_name, stored, text_column

ORDER = 4
# A piece of the models is sent to every task; it has about so many runs.
MOST_RUNS = 1_500_000
MOST_WORDS = 400_000
REJECT_AT = 12.0
UNKNOWN = "und"
WORDS = re.compile(r"[^\W\d_]+").findall
COSTS = "letters long, costs array<struct<lang: int, nats: double, squares: double>>"
COST_TYPE = pa.struct([("lang", pa.int32()), ("nats", pa.float64()), ("squares", pa.float64())])


def _runs(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the runs that predict each letter and the end of each word, and how many a word has."""
    padded = [f"   {word} " for word in words]
    points = np.frombuffer("".join(padded).encode("utf-32-le"), np.uint32).astype(np.uint64)
    points = (points ^ (points >> np.uint64(16)) * np.uint64(0x9E5)) & np.uint64(0xFFFF)
    sizes = np.fromiter(map(len, padded), np.int64, len(padded))
    keys = np.zeros(max(len(points) - 3, 0), np.uint64)
    for i in range(ORDER):
        keys |= points[i:len(points) - 3 + i] << np.uint64(16 * (3 - i))
    starts = np.cumsum(sizes) - sizes
    counts = sizes - 3
    at = np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    return keys[at], counts


def count_runs(docs: DataFrame, lang: Column, text_col: str = "text") -> DataFrame:
    """(lang, run, n) over all rows whose language isn't null."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, Counter] = {}

        def counted() -> Iterator[pa.RecordBatch]:
            for name, tokens in words.items():
                found = Counter()
                for token, n in tokens.items():
                    for word in WORDS(token.lower()):
                        found[word] += n
                keys, sizes = _runs(list(found))
                times = np.repeat(np.fromiter(found.values(), np.int64, len(found)), sizes)
                distinct, which = np.unique(keys, return_inverse=True)
                n = np.bincount(which, weights=times, minlength=len(distinct)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(distinct), pa.string()), pa.array(distinct.view(np.int64)), pa.array(n)],
                    ["lang", "run", "n"])
            words.clear()

        for block, texts in blocks(batches, 1):
            for name, text in zip(block.column(0).to_pylist(), texts):
                words.setdefault(name, Counter()).update(text.split())
            if sum(map(len, words.values())) > MOST_WORDS:
                yield from counted()
        yield from counted()

    rows = docs.select(lang.alias("lang"), text_column(text_col).alias("text")).filter("lang is not null")
    parts = rows.mapInArrow(run, "lang string, run long, n long")
    return parts.groupBy("lang", "run").agg(F.sum("n").alias("n"))


@dataclass
class Level:
    """One order of one language: sorted keys of runs and contexts with what they add."""

    runs: np.ndarray
    gains: np.ndarray
    contexts: np.ndarray
    backoffs: np.ndarray


def _find(keys: np.ndarray, values: np.ndarray, asked: np.ndarray, otherwise: float) -> np.ndarray:
    if not len(keys):
        return np.full(len(asked), otherwise)
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return np.where(keys[at] == asked, values[at], otherwise)


def levels(runs: np.ndarray, n: np.ndarray, often: dict[int, tuple[int, int]] | None = None,
           letters: tuple[np.ndarray, np.ndarray] | None = None) -> list[Level]:
    """The orders of a language, lowest first, from the counts of its longest runs.

    Where `runs` are a part of the language's, `often` has how many runs of each order have the counts one and two, and
    `letters` the lowest order's runs with their counts.
    """
    found = []
    for order in range(ORDER, 0, -1):
        if order == 1 and letters is not None:
            runs, n = letters
        ones, twos = often[order] if often else (np.count_nonzero(n == 1), np.count_nonzero(n == 2))
        discount = min(max(ones / (ones + 2 * twos), 0.1), 0.95) if ones and twos else 0.5
        contexts, which = np.unique(runs >> np.uint64(16), return_inverse=True)
        total, kinds = np.bincount(which, weights=n), np.bincount(which)
        found.append(Level(runs, (n - discount) / total[which], contexts, discount * kinds / total))
        # A lower order counts the distinct runs that end with it.
        runs, n = np.unique(runs & np.uint64((1 << 16 * (order - 1)) - 1), return_counts=True)
    return found[::-1]


@dataclass
class Model:
    """What a task needs of some languages, or of parts of them, and the two tables of a calibration.

    Of a language's `parts` (which, of how many) the model has one, the whole language where there are no parts.
    """

    langs: list[str]
    levels: list[list[Level]]
    mean: dict[str, float]
    variance: dict[str, tuple[float, float]]
    parts: list[tuple[int, int]] | None = None

    def costs(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """By word and language, the nats of all its characters and their squares; and how many characters."""
        keys, counts = _runs(words)
        starts = np.cumsum(counts) - counts
        distinct, which = np.unique(keys, return_inverse=True)
        total, squares = (np.zeros((len(words), len(self.langs))) for _ in range(2))
        for i, orders in enumerate(self.levels):
            alphabet = len(orders[0].runs) + 1
            p = np.full(len(distinct), 1 / alphabet)
            for order, level in enumerate(orders, 1):
                run = distinct & np.uint64((1 << 16 * order) - 1) if order < ORDER else distinct
                p = (_find(level.runs, level.gains, run, 0.0)
                     + _find(level.contexts, level.backoffs, run >> np.uint64(16), 1.0) * p)
            nats = -np.log(np.maximum(p, 1e-12))
            if self.parts:
                part, of = self.parts[i]
                nats[(distinct >> np.uint64(16) & np.uint64(0xFFFF)) % np.uint64(of) != part] = 0
            nats = nats[which]
            total[:, i] = np.add.reduceat(nats, starts)
            squares[:, i] = np.add.reduceat(nats * nats, starts)
        return total, squares, counts


class Identifier:
    """Scores texts; remembers the words it has met."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.tokens = Numbers()
        n = len(self.model.langs)
        self.total, self.squares, self.counts = np.zeros((0, n)), np.zeros((0, n)), np.zeros(0, np.int64)

    def _learn(self, tokens: list[str]) -> None:
        """Costs of new tokens, which are runs of anything but white space and may hold several words."""
        lists = [WORDS(token.lower()) for token in tokens]
        # Runs of other word characters, such as superscript digits, have no letter.
        lists = [words if all(map(str.isalpha, words)) else [w for w in words if any(map(str.isalpha, w))] for words in lists]
        words = Numbers()
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        which = np.fromiter(map(words.__getitem__, chain.from_iterable(lists)), np.int64, int(sizes.sum()))
        n = len(self.model.langs)
        total, squares, counts = self.model.costs(words.fresh) if words else (np.zeros((0, n)), np.zeros((0, n)), np.zeros(0, np.int64))
        self.total = np.concatenate([self.total, self._sums(total[which], sizes)])
        self.squares = np.concatenate([self.squares, self._sums(squares[which], sizes)])
        self.counts = np.concatenate([self.counts, self._sums(counts[which], sizes)])

    def scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nats by text and language, their squares, and characters predicted."""
        if len(self.tokens) > MOST_WORDS:
            self._forget()
        lists = [text.split() for text in texts]
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        which = np.fromiter(map(self.tokens.__getitem__, chain.from_iterable(lists)), np.int64, int(sizes.sum()))
        self._learn(self.tokens.fresh)
        self.tokens.fresh = []
        return tuple(self._sums(values[which], sizes) for values in (self.total, self.squares, self.counts))

    @staticmethod
    def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        result = np.zeros((len(sizes), *values.shape[1:]), values.dtype)
        if len(values):
            full = sizes > 0
            result[full] = np.add.reduceat(values, (np.cumsum(sizes) - sizes)[full])
        return result


class Models:
    """The models of all languages of a table; their tables are built a piece at a time."""

    def __init__(self, docs: DataFrame, lang: Column, text_col: str = "text") -> None:
        """Counts all rows whose `lang` isn't null. Without such rows no language is known.

        The driver holds a few numbers a language, and a piece: about `MOST_RUNS` runs.
        """
        self.runs = stored(count_runs(docs, lang, text_col), "language-runs")
        often, order = [], self.runs
        for k in range(ORDER, 0, -1):
            if k < ORDER:
                # A lower order counts the distinct runs that end with it.
                order = order.groupBy("lang", F.col("run").bitwiseAND((1 << 16 * k) - 1).alias("run")).agg(F.count("*").alias("n"))
            often.append(order.groupBy("lang").agg(F.lit(k).alias("k"), F.count("*").alias("kinds"), F.count_if(F.col("n") == 1).alias("ones"),
                                                   F.count_if(F.col("n") == 2).alias("twos")))
        self.letters = stored(order, "language-letters")
        self.often: dict[str, dict[int, tuple[int, int]]] = {}
        kinds = {}
        for row in often[0].unionAll(often[1]).unionAll(often[2]).unionAll(often[3]).collect():  # four rows a language
            self.often.setdefault(row["lang"], {})[row["k"]] = (row["ones"], row["twos"])
            kinds[row["lang"], row["k"]] = row["kinds"]
        self.langs = sorted(self.often)
        self.pieces: list[list[tuple[str, int, int]]] = []
        room = 0
        for name in self.langs:
            size = kinds[name, ORDER]
            if size > MOST_RUNS:
                of = -(-size // MOST_RUNS)
                self.pieces += [[(name, part, of)] for part in range(of)]
                room = 0
            elif size <= room:
                self.pieces[-1].append((name, 0, 1))
                room -= size
            else:
                self.pieces.append([(name, 0, 1)])
                room = MOST_RUNS - size

    def build(self, piece: list[tuple[str, int, int]]) -> Model:
        names = [name for name, _, _ in piece]
        _, part, of = piece[0]
        mine = F.shiftrightunsigned("run", 16).bitwiseAND(0xFFFF) % of == part

        def by_lang(rows: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray]]:
            table = rows.filter(F.col("lang").isin(names)).select("lang", "run", "n").toArrow().to_pandas()
            found = {}
            for name, group in table.groupby("lang"):
                keys = group["run"].to_numpy().view(np.uint64)
                order = np.argsort(keys)
                found[name] = keys[order], group["n"].to_numpy()[order].astype(np.float64)
            return found

        runs, letters = by_lang(self.runs.filter(mine)), by_lang(self.letters)
        none = np.zeros(0, np.uint64), np.zeros(0)
        tables = [levels(*runs.get(name, none), self.often[name], letters[name]) for name in names]
        return Model(names, tables, {}, {}, [(which, of) for _, which, of in piece])


def calibrated(scored: DataFrame) -> Model:
    """A model of no language, with the mean cross-entropy of training texts and its variance between texts and characters.

    `scored` has `own_entropy` and `own_within` of training rows by their own language, as `score` gives them.
    """
    sums = (scored.filter("own_entropy is not null").groupBy("own_lang").agg(
        F.avg("own_entropy"), F.var_pop("own_entropy"), F.avg("own_within")).collect())  # a row a language of the model
    return Model([], [], {row[0]: row[1] for row in sums}, {row[0]: (row[2], row[3]) for row in sums})


def rejected(model: Model) -> Column:
    """Whether a scored row is rejected: no language, or too high a cross-entropy for it."""
    if not model.mean:
        return F.col("lang") == UNKNOWN

    def of_lang(values: dict[str, float]) -> Column:
        return F.element_at(F.create_map(*[F.lit(v) for pair in values.items() for v in pair]), F.col("lang"))

    between, within = ({lang: pair[i] for lang, pair in model.variance.items()} for i in (0, 1))
    bound = of_lang(model.mean) + REJECT_AT * F.sqrt(of_lang(between) + of_lang(within) / F.col("letters"))
    return (F.col("lang") == UNKNOWN) | F.coalesce(F.col("entropy") > bound, F.lit(False))


def _costs(rows: DataFrame, model: Model, first: int) -> DataFrame:
    """`rows`, whose last column is the text, with what `model` adds in its place; languages are numbered from `first`."""
    from pyspark.sql.types import StructType, _parse_datatype_string

    sent = rows.sparkSession.sparkContext.broadcast(model)
    schema = StructType([*rows.schema.fields[:-1], *_parse_datatype_string(COSTS).fields])
    # Plain values, so that tasks get nothing of the session.
    names, n_keys = schema.fieldNames(), len(rows.columns) - 1

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        identifier = Identifier(sent.value)
        langs = np.arange(len(sent.value.langs), dtype=np.int32) + np.int32(first)
        for block, texts in blocks(batches, n_keys):
            total, squares, n = identifier.scores(texts)
            flat = [pa.array(np.tile(langs, len(texts))), pa.array(total.ravel()), pa.array(squares.ravel())]
            costs = pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1, dtype=np.int32) * np.int32(len(langs))),
                                             pa.StructArray.from_arrays(flat, fields=list(COST_TYPE)))
            yield pa.RecordBatch.from_arrays([*block.columns[:n_keys], pa.array(n), costs], names)

    return rows.mapInArrow(run, schema)


def _added(parts: list[DataFrame], keys: list[str]) -> DataFrame:
    """The costs of all pieces by row. Rows equal in all `keys` have equal texts: they are added up together and told apart again."""
    whole = parts[0].withColumn("first", F.lit(1))
    for part in parts[1:]:
        whole = whole.unionAll(part.withColumn("first", F.lit(0)))
    by_lang = (whole.select(*keys, "first", F.explode("costs").alias("cost")).groupBy(*keys, "cost.lang")
               .agg(F.sum("first").alias("copies"), F.sum("cost.nats").alias("nats"), F.sum("cost.squares").alias("squares")))
    rows = by_lang.groupBy(*keys).agg(F.max("copies").alias("copies"), F.collect_list(F.struct("lang", "nats", "squares")).alias("costs"))
    each = F.transform("costs", lambda c: F.struct(c["lang"].alias("lang"), (c["nats"] / F.col("copies")).alias("nats"),
                                                   (c["squares"] / F.col("copies")).alias("squares")))
    # Two short sequences in place of one as long as there are copies.
    hundreds = rows.select(*keys, "copies", each.alias("costs"), F.explode(F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / 1000))).alias("at"))
    left = F.least(F.lit(1000), F.col("copies") - F.col("at") * 1000)
    return hundreds.select(*keys, "costs", F.explode(F.sequence(F.lit(1), left))).select(*keys, "costs")


def _decided(costs: DataFrame, keys: list[str], langs: list[str]) -> DataFrame:
    n = F.greatest("letters", F.lit(1))
    each = F.transform("costs", lambda c: F.struct((c["nats"] / n).alias("entropy"), c["lang"].alias("lang"), (c["squares"] / n).alias("squares")))
    rows = costs.select(*keys, "own_lang", "letters", F.when(F.col("letters") > 0, each).alias("each"))
    names = F.array(*map(F.lit, langs)).cast("array<string>")
    name_of = F.get(names, F.col("best.lang"))
    # The posterior of equally likely languages; evidence beyond some words isn't counted as independent.
    rows = rows.withColumn("best", F.array_min("each"))
    others = F.aggregate("each", F.lit(0.0), lambda s, c: s + F.exp((F.col("best.entropy") - c["entropy"]) * F.least("letters", F.lit(50))))
    own = F.get(F.filter("each", lambda c: F.get(names, c["lang"]) == F.col("own_lang")), F.lit(0))
    return rows.select(
        *keys, F.coalesce(name_of, F.lit(UNKNOWN)).alias("lang"), F.col("best.entropy").alias("entropy"),
        F.when(F.col("best").isNull(), 0.0).otherwise(1 / others).alias("score"), "letters", "own_lang",
        own["entropy"].alias("own_entropy"), (own["squares"] - own["entropy"] * own["entropy"]).alias("own_within"))


def score(docs: DataFrame, models: Models, keys: dict[str, Column], text_col: str = "text", lang: Column | None = None) -> DataFrame:
    """`keys`, which tell texts apart, with lang, entropy, score and letters of each row's whole text.

    With `lang`, the training language or null, also what `calibrated` asks for: own_lang, own_entropy, own_within.
    """
    rows = docs.select(*[column.alias(name) for name, column in keys.items()],
                       (F.lit(None) if lang is None else lang).cast("string").alias("own_lang"), text_column(text_col).alias("text_"))
    pieces = models.pieces or [[]]
    place = {name: i for i, name in enumerate(models.langs)}
    parts = []
    for piece in pieces:
        model = models.build(piece) if piece else Model([], [], {}, {})
        costs = _costs(rows, model, place[piece[0][0]] if piece else 0)
        # A piece is done with before the next one is built.
        parts.append(stored(costs, "language-costs") if len(pieces) > 1 else costs)
    costs = parts[0] if len(parts) == 1 else _added(parts, [*keys, "own_lang", "letters"])
    return stored(_decided(costs, list(keys), models.langs), "language-scores")


def identify(docs: DataFrame, lang: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, digest, lang, entropy, score, letters, rejected) of each row's whole text; models learn from `lang`.

    `lang` in the result is a learned one or `und`, for null texts and texts without a letter, or where nothing was learned;
    `und` is always rejected. `score` is the posterior if all languages are equally likely. Of equally good languages the
    first by name is taken. `digest` tells rows with equal ids apart.
    """
    keys = {"id": F.col(id_col), "digest": F.xxhash64(text_column(text_col))}
    scored = score(docs, Models(docs, lang, text_col), keys, text_col, lang)
    return scored.select("id", "digest", "lang", "entropy", "score", "letters", rejected(calibrated(scored)).alias("rejected"))


def drop_rejected(docs: DataFrame, lang: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` without the rows whose text is rejected; columns stay as they are."""
    id_, digest = own_name(docs, "gone_id"), own_name(docs, "gone_digest")
    gone = identify(docs, lang, id_col, text_col).filter("rejected").select(F.col("id").alias(id_), F.col("digest").alias(digest)).distinct()
    same = (F.xxhash64(text_column(text_col)) == F.col(digest)) & F.col(id_col).eqNullSafe(F.col(id_))
    return docs.join(gone, same, "left_anti")


def training_lang(lang_col: str = "lang", id_col: str = "doc_id", folds: int = 5, held_out: int = 0) -> Column:
    """The language of training rows; null for rows of the held-out fold, by crc32 of the id."""
    return F.when(id_hash(id_col) % folds != held_out, F.col(lang_col))
