"""Token counts kept in a cache of digests.

A text's count depends on its content and on the tokenizer file alone. Both are known by digest, and
counts already stored under that pair are joined. Texts not stored are encoded once each, however many
rows have them, and their counts are appended to the store, a Parquet table in a shared folder.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from txrisk.llm.common import Numbers, blocks, read_if_there, text_column

STORE_SCHEMA = "digest binary, version string, n_tokens long"
# Distinct cuts that a task remembers before it starts afresh.
MOST_CUTS = 500_000
# A byte-level file's split starts a new piece at each single space between two characters that aren't white space.
CUT = re.compile(r"(?<=\S) (?=\S)")
CUTS_AT_ONCE = 1000
# Cuts that may hold an added token are encoded by themselves.
SPECIAL = re.compile(r"<\|").search


class Counter:
    """Counts tokens as the library does for a byte-level file; texts are cut and each distinct cut is encoded once."""

    def __init__(self, spec: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        if not can_cut(self.tokenizer):
            raise ValueError("a file with the byte-level split and no normaliser is needed")
        line = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.line = line[0] if len(line) == 1 else None
        self._forget()

    def _forget(self) -> None:
        # Cuts by number, with and without the space before them; counts, -1 where a text can't be cut like that.
        self.later, self.counts = Numbers(), np.zeros(0, np.int64)
        self.first: dict[str, int] = {}

    def count(self, texts: list[str]) -> list[int]:
        if len(self.later) + len(self.first) > MOST_CUTS:
            self._forget()
        lists = [text.split(" ") for text in texts]
        firsts = [cuts.pop(0) for cuts in lists]
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        which = np.fromiter(map(self.later.__getitem__, chain.from_iterable(lists)), np.int64, int(sizes.sum()))
        self.counts = np.concatenate([self.counts, self._count(self.later.fresh)])
        self.later.fresh = []
        new = list(dict.fromkeys(cut for cut in firsts if cut not in self.first))
        self.first.update(zip(new, self._each(new)))
        total = np.concatenate([[0], np.cumsum(self.counts[which])])
        doubtful = np.concatenate([[0], np.cumsum(self.counts[which] < 0)])
        ends = np.cumsum(sizes)
        total, doubtful = total[ends] - total[ends - sizes], doubtful[ends] - doubtful[ends - sizes]
        return [self._slowly(text) if unsure or first != first.strip() or not first else self.first[first] + n
                for text, first, n, unsure in zip(texts, firsts, total.tolist(), doubtful.tolist())]

    def _slowly(self, text: str) -> int:
        """For texts with white space beside white space: cut only where a single space stands alone."""
        first, *later = CUT.split(text)
        return sum(self._each([first, *(" " + cut for cut in later)]))

    def _count(self, cuts: list[str]) -> np.ndarray:
        """Tokens of new cuts with a space before each."""
        result = np.full(len(cuts), -1, np.int64)
        sound = [i for i, cut in enumerate(cuts) if cut and not cut[0].isspace() and not cut[-1].isspace()]
        # A line end after a cut and before a space is a piece, and here a token, of its own.
        plain = [i for i in sound if self.line is not None and "\n" not in cuts[i] and not SPECIAL(cuts[i])]
        taken = set(plain)
        rest = [i for i in sound if i not in taken]
        result[rest] = self._each([" " + cuts[i] for i in rest])
        groups = [plain[start:start + CUTS_AT_ONCE] for start in range(0, len(plain), CUTS_AT_ONCE)]
        for start in range(0, len(groups), 16):
            part = groups[start:start + 16]
            found = self.tokenizer.encode_batch_fast(
                ["".join(f" {cuts[i]}\n" for i in group) + " ." for group in part], add_special_tokens=False)
            for group, encoded in zip(part, found):
                ends = np.flatnonzero(np.array(encoded.ids) == self.line)
                result[group] = np.diff(ends, prepend=-1) - 1
        return result

    def _each(self, texts: list[str]) -> list[int]:
        counts: list[int] = []
        for start in range(0, len(texts), 2000):
            counts += map(len, self.tokenizer.encode_batch_fast(texts[start:start + 2000], add_special_tokens=False))
        return counts


def can_cut(tokenizer) -> bool:
    data = json.loads(tokenizer.to_str())
    split = data["pre_tokenizer"] or {}
    plain = not any(t["lstrip"] or t["rstrip"] or t["single_word"] or " " in t["content"] or not SPECIAL(t["content"]) for t in data["added_tokens"])
    return plain and data["normalizer"] is None and split.get("type") == "ByteLevel" and split["use_regex"] \
        and not split["add_prefix_space"]


def count_tokens(docs: DataFrame, tokenizer: str, store: str, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens) of each row's whole text.

    `tokenizer` is the path of a byte-level tokenizer file, `store` a folder that all executors can
    reach. Null texts count as empty and have no tokens. Rows with equal ids are rows of their own. A
    store that got a text twice, from two jobs at once, counts it once.
    """
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as file:
        spec = file.read()
    version = hashlib.sha256(spec.encode()).hexdigest()
    sent = spark.sparkContext.broadcast(spec)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(sent.value)
        for block, texts in blocks(batches, 1):
            yield pa.RecordBatch.from_arrays(
                [block.column(0), pa.array([version] * len(texts)), pa.array(counter.count(texts), pa.int64())],
                ["digest", "version", "n_tokens"])

    rows = docs.select(F.col(id_col).alias("id"), text_column(text_col).alias("text"))
    digest = F.unhex(F.sha2("text", 256))
    known = read_if_there(spark, store, STORE_SCHEMA).filter(F.col("version") == version)
    misses = (rows.groupBy(digest.alias("digest")).agg(F.first("text").alias("text"))
              .join(known.select("digest"), "digest", "left_anti"))
    misses.mapInArrow(run, STORE_SCHEMA).write.mode("append").parquet(store)

    counts = (spark.read.schema(STORE_SCHEMA).parquet(store).filter(F.col("version") == version)
              .groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")))
    asked = rows.select("id", digest.alias("digest"), F.octet_length("text").cast("long").alias("n_bytes"))
    return asked.join(counts, "digest").select("id", "n_bytes", "n_tokens")
