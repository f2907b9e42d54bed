"""Byte-pair encoding over an occurrence index of pairs, and its decoding.

The distinct pieces of a block of texts lie end to end in one array of symbols with links to the
next and previous living symbol. An index maps the rank of each mergeable pair to all its positions. The
ranks present are taken in ascending order; a merge replaces all occurrences of its pair at once, and only the
pairs beside them are looked up and added to their lists. Ranks are independent of each other across
pieces, and in a merge table learned from data a merge makes no pair of lower rank, so each piece comes out as if
encoded alone.

Texts are cut at plain spaces first, so that normalisation and splitting, done by the tokenizer file's own
components, and encoding run once for each distinct cut of a block.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from txrisk.llm.common import Numbers, blocks, text_column

# Distinct cuts that a task remembers before it starts afresh.
MOST_CUTS = 500_000
CUTS_AT_ONCE = 1000

# How byte-level files write bytes: as the character of that number where it prints, else as the next from 256 on.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_LETTERS = {byte: chr(byte) for byte in _PRINTED}
_LETTERS |= {byte: chr(256 + i) for i, byte in enumerate(byte for byte in range(256) if byte not in _LETTERS)}
NUL = _LETTERS[0]
# The usual split of word files; see `Encoder` for when the shorter way for Latin letters holds.
WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
LATIN = re.compile("[!-~\u00c0-\u012f\u0131-\u024f]+").fullmatch
LATIN_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|[\W_]+").findall


def _as_letters(piece: str) -> str:
    return piece.encode().decode("latin-1").translate(_LETTERS)


class Pool:
    """Runs of numbers end to end, looked up by number."""

    def __init__(self) -> None:
        self.values, self.starts, self.lengths = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, values: np.ndarray, lengths: np.ndarray) -> None:
        starts = len(self.values) + np.cumsum(lengths) - lengths
        self.values = np.concatenate([self.values, values])
        self.starts = np.concatenate([self.starts, starts])
        self.lengths = np.concatenate([self.lengths, lengths])

    def gather(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The runs numbered `which`, end to end, and their lengths."""
        lengths = self.lengths[which]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        at = np.repeat(self.starts[which] - (ends - lengths), lengths) + np.arange(total)
        return self.values[at], lengths


def _sums(lengths: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive groups of `lengths`; `counts` has the sizes of the groups."""
    total = np.concatenate([[0], np.cumsum(lengths)])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


class Merges:
    """A merge table as sorted pair keys."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]], word_end: str) -> None:
        ids = [(vocabulary[a], vocabulary[b], vocabulary[a + b]) for a, b in merges]
        self.left, self.right, self.made = np.array(ids or np.zeros((0, 3)), np.int64).T
        self.width = max(vocabulary.values()) + 1
        keys = self.left * self.width + self.right
        self.rank = np.argsort(keys, kind="stable")
        self.keys = keys[self.rank]
        # Symbols before any merge; those that end a piece may differ.
        letters = {ord(token): number for token, number in vocabulary.items() if len(token) == 1}
        ends = {ord(token[0]): number for token, number in vocabulary.items() if token[1:] == word_end and token}
        self.inner, self.last = (np.full(1 + max(letters), -1, np.int64) for _ in range(2))
        self.inner[list(letters)] = list(letters.values())
        self.last[list(ends)] = list(ends.values())

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs; -1 for pairs that never merge."""
        keys = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        if not len(self.keys):
            return np.full(len(keys), -1)
        return np.where(self.keys[at] == keys, self.rank[at], -1)

    def encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces end to end, and how many each has."""
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        points = np.frombuffer("".join(pieces).encode("utf-32-le"), np.uint32)
        n = len(points)
        symbol = np.empty(n + 1, np.int64)
        symbol[:n] = self.inner[points]
        ends = np.cumsum(sizes)
        symbol[ends - 1] = self.last[points[ends - 1]]
        symbol[n] = -2  # beyond the last symbol of any piece
        following, previous = np.arange(1, n + 2), np.arange(-1, n)
        following[ends - 1] = n
        previous[ends - sizes] = -1

        places: dict[int, list[np.ndarray]] = {}
        ranks: list[int] = []

        def index(at: np.ndarray) -> None:
            rank = self.ranks(symbol[at], symbol[following[at]])
            known = rank >= 0
            at, rank = at[known], rank[known]
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            cuts = np.flatnonzero(np.diff(rank)) + 1
            for first, part in zip(rank[np.concatenate([[0], cuts])].tolist() if len(rank) else (), np.split(at, cuts)):
                if first in places:
                    places[first].append(part)
                else:
                    places[first] = [part]
                    heapq.heappush(ranks, first)

        index(np.flatnonzero(following[:n] < n))
        while ranks:
            rank = heapq.heappop(ranks)
            found = places.pop(rank)
            at = found[0] if len(found) == 1 else _distinct(np.concatenate(found))
            left, right = self.left[rank], self.right[rank]
            at = at[(symbol[at] == left) & (symbol[following[at]] == right)]
            if left == right and len(at) > 1:
                # In a run of one symbol the pairs overlap; the leftmost merges first.
                taken, after = [], -1
                for place in at.tolist():
                    if place != after:
                        taken.append(place)
                        after = following[place]
                    else:
                        after = -1
                at = np.array(taken)
            gone = following[at]
            beyond = following[gone]
            symbol[at], symbol[gone] = self.made[rank], -1
            following[at] = beyond
            inside = beyond < n
            previous[beyond[inside]] = at[inside]
            before = previous[at]
            index(_distinct(np.concatenate([before[before >= 0], at[inside]])))
        alive = symbol[:n] >= 0
        return symbol[:n][alive], _sums(alive.astype(np.int64), sizes)


class Encoder:
    """Encodes texts as the tokenizer file at hand says; made once in each task."""

    def __init__(self, spec: str) -> None:
        from tokenizers import Tokenizer

        data = json.loads(spec)
        model = data["model"]
        if model["type"] != "BPE" or model.get("byte_fallback") or model.get("ignore_merges") or model.get("dropout"):
            raise ValueError("a plain byte-pair model is needed")
        merges = [tuple(pair.split(" ")) if isinstance(pair, str) else tuple(pair) for pair in model["merges"]]
        tokenizer = Tokenizer.from_str(spec)
        self.normalizer, self.pre_tokenizer = tokenizer.normalizer, tokenizer.pre_tokenizer
        self.merges = Merges(model["vocab"], merges, model.get("end_of_word_suffix") or "")
        added = {token["content"]: token["id"] for token in data["added_tokens"]}
        if any(token["normalized"] or token["single_word"] or token["lstrip"] or token["rstrip"]
               for token in data["added_tokens"]):
            raise ValueError("added tokens that take their surroundings along are not supported")
        self.added = added
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        # Composed Latin letters without white space need no normalisation but lower case, and split alike here.
        split = data["pre_tokenizer"].get("pretokenizers", [{}])
        steps = [step["type"] for step in (data["normalizer"] or {}).get("normalizers", [])]
        self.latin = (steps == ["NFC", "Replace", "Lowercase"] and len(split) == 2
                      and split[0].get("pattern") == {"Regex": WORD_SPLIT} and split[0].get("invert") is True
                      and split[1]["type"] == "ByteLevel" and not split[1]["use_regex"])
        self._forget()

    def _forget(self) -> None:
        self.cuts = Numbers()
        self.pieces = Numbers()
        self.piece_ids, self.cut_ids = Pool(), Pool()

    def _split(self, cuts: list[str]) -> Iterator[list[str]]:
        """The pieces of each cut, in bytes written as letters. NUL between cuts stays a piece of its own."""
        plain = [cut for cut in cuts if "\0" not in cut]
        groups: list[list[str]] = []
        for start in range(0, len(plain), CUTS_AT_ONCE):
            groups.append([])
            for piece in self._pieces(" \0 ".join(plain[start:start + CUTS_AT_ONCE])):
                if piece == NUL:
                    groups.append([])
                else:
                    groups[-1].append(piece)
        plain_groups = iter(groups)
        return (self._pieces(cut) if "\0" in cut else next(plain_groups) for cut in cuts)

    def _pieces(self, text: str) -> list[str]:
        if self.normalizer is not None:
            text = self.normalizer.normalize_str(text)
        return [piece for piece, _ in self.pre_tokenizer.pre_tokenize_str(text)]

    def _learn(self, cuts: list[str]) -> None:
        """Adds new distinct cuts, in the order of their numbers."""
        numbers: list[int] = []
        counts: list[int] = []
        places: list[int] = []
        known, number_of = self.pieces, self.pieces.__getitem__
        other = []
        for place, cut in enumerate(cuts):
            if self.latin and LATIN(cut) and cut not in self.added:
                pieces = LATIN_PIECES(cut.lower())
                counts.append(len(pieces))
                places.append(place)
                numbers += map(number_of, pieces)
            else:
                other.append(place)
        added = {place: self.added[cuts[place]] for place in other if cuts[place] in self.added}
        other = [place for place in other if place not in added]
        for place, pieces in zip(other, self._split([cuts[place] for place in other])):
            counts.append(len(pieces))
            places.append(place)
            # Apart from the others: these are written as letters already.
            numbers += map(number_of, ["\0" + piece for piece in pieces])
        for place, token in added.items():
            counts.append(1)
            places.append(place)
            numbers.append(number_of(token))
        if known.fresh:
            # An added token stands for itself, as a piece that is a number.
            written = [piece for piece in known.fresh if not isinstance(piece, int)]
            ids, lengths = self.merges.encode([piece[1:] if piece[0] == "\0" else piece if piece.isascii() else _as_letters(piece)
                                               for piece in written])
            if len(written) < len(known.fresh):
                ids, lengths = self._with_added(known.fresh, ids, lengths)
            self.piece_ids.add(ids, lengths)
            known.fresh = []
        ids, lengths = self.piece_ids.gather(np.array(numbers, np.int64))
        sizes = _sums(lengths, np.array(counts, np.int64))
        # Back into the order of the cuts.
        found = Pool()
        found.add(ids, sizes)
        place_of = np.empty(len(cuts), np.int64)
        place_of[np.array(places, np.int64)] = np.arange(len(cuts))
        self.cut_ids.add(*found.gather(place_of))

    @staticmethod
    def _with_added(pieces: list, ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.ones(len(pieces), np.int64)
        written = np.array([not isinstance(piece, int) for piece in pieces])
        sizes[written] = lengths
        result = np.empty(int(sizes.sum()), np.int64)
        of = np.repeat(written, sizes)
        result[of], result[~of] = ids, [piece for piece in pieces if isinstance(piece, int)]
        return result, sizes

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and how many each has."""
        if len(self.cuts) > MOST_CUTS:
            self._forget()
        lists = [self._cut(text) for text in texts]
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        which = np.fromiter(map(self.cuts.__getitem__, chain.from_iterable(lists)), np.int64, int(sizes.sum()))
        self._learn(self.cuts.fresh)
        self.cuts.fresh = []
        ids, lengths = self.cut_ids.gather(which)
        return ids.astype(np.int32), _sums(lengths, sizes)

    def _cut(self, text: str) -> list[str]:
        cuts = text.split(" ")
        if self.special is not None and self.special.search(text):
            cuts = [part for cut in cuts for part in self.special.split(cut)]
        return cuts


def tokenizer_spec(spark: SparkSession, path: str):
    """The tokenizer file, sent to every task; its size is that of a vocabulary."""
    with open(path, encoding="utf-8") as file:
        return spark.sparkContext.broadcast(file.read())


def encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids) of each row: the token ids of its whole text, without begin or end tokens.

    `tokenizer` is the path of a byte-level BPE file of the tokenizers library whose text is split at
    spaces. Null and empty texts have no ids; rows with equal ids or texts are encoded each for itself.
    """
    spec = tokenizer_spec(docs.sparkSession, tokenizer)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(spec.value)
        for block, texts in blocks(batches, 1):
            ids, counts = encoder.encode(texts)
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [block.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))], ["id", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), text_column(text_col).alias("text")).mapInArrow(
        run, f"id {kind}, ids array<int>")


def decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """The rows of `encoded`, which has an array column `ids`, with their text in `decoded`.

    Only for files without a decoder of their own: tokens are joined by spaces. Null ids decode to an empty text.
    """
    spec = tokenizer_spec(encoded.sparkSession, tokenizer)
    if json.loads(spec.value)["decoder"] is not None:
        raise ValueError("the file has a decoder of its own")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = json.loads(spec.value)
        tokens = {number: token for token, number in data["model"]["vocab"].items()}
        tokens |= {token["id"]: token["content"] for token in data["added_tokens"]}
        table = np.array([tokens.get(number, "") for number in range(max(tokens) + 1)], object)
        for batch in batches:
            at = batch.schema.get_field_index("ids")
            lists = batch.column(at)
            for start in range(0, len(batch), 200):
                texts = [" ".join(table[ids.values.to_numpy()].tolist()) if ids.is_valid else ""
                         for ids in lists[start:start + 200]]
                part = batch.slice(start, 200)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())],
                                                 [*batch.schema.names, "decoded"])

    from pyspark.sql.types import StringType, StructField, StructType

    return encoded.mapInArrow(run, StructType([*encoded.schema.fields, StructField("decoded", StringType())]))
