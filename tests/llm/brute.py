"""Plain versions of the operators, as their contracts put them."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

import xxhash

BASE = [
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 12),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 16),
]


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def fold(doc_id, folds: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % folds


def base_spans(text: str) -> list[tuple[int, int, str]]:
    found = [(m.start(), k, m.end(), name) for k, (name, pattern, group, least) in enumerate(BASE)
             for m in pattern.finditer(text) if len(m.group(group)) >= least]
    return [(start, end, name) for start, _, end, name in sorted(found)]


def spans_text(spans) -> str:
    return ",".join(f"{name}:{start}:{end}" for start, end, name in spans)


def fingerprint(text: str) -> int:
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", "".join(c.lower() if c <= "z" else c for c in text)) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(prints: dict[int, list], within: int = 2) -> dict[int, int]:
    """A fingerprint for each that it reaches, by comparing all pairs."""
    keys = sorted(prints)
    parent = {k: k for k in keys}

    def root(k):
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            if (a ^ b).bit_count() <= within:
                parent[root(a)] = root(b)
    return {k: root(k) for k in keys}


def components(prints: dict[int, list], within: int = 2) -> dict[int, int]:
    """The least id that each fingerprint reaches."""
    root, ids = roots(prints, within), defaultdict(list)
    for k in prints:
        ids[root[k]] += prints[k]
    return {k: min(ids[root[k]]) for k in prints}


def edited(texts: dict) -> dict:
    """By id, the text with its last third replaced by the start of the next in descending order."""
    order = sorted(texts, reverse=True)
    result = {}
    for here, there in zip(order, order[1:] + order[:1]):
        text, k = texts[here], len(texts[here]) // 3
        result[here] = text[:len(text) - k] + texts[there][:k]
    return result


def words_of(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def repetition(text: str | None, least: int = 8) -> dict:
    """The measures of the quality rules, and the words (by number) that maximal repeats cover."""
    words, lines = words_of(text), [line for line in (text or "").split("\n") if words_of(line)]
    n = len(words)
    windows = defaultdict(list)
    for i in range(n - 2):
        windows[tuple(words[i:i + 3])].append(i)
    in_windows = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(3)}
    covered, longest, repeats, length = set(), 0, 0, least
    while length < n:
        places = defaultdict(list)
        for i in range(n - length + 1):
            places[tuple(words[i:i + length])].append(i)
        again = {words_: at for words_, at in places.items() if len(at) > 1}
        for words_, at in again.items():
            left = {words[i - 1] if i else ("start", i) for i in at}
            right = {words[i + length] if i + length < n else ("end", i) for i in at}
            if len(left) > 1 and len(right) > 1:
                repeats, longest = repeats + 1, max(longest, sum(map(len, words_)))
                covered.update(i + k for i in at for k in range(length))
        if not again:
            break
        length += 1
    chars = sum(map(len, words))
    failed = n < 50 or 100 * len(in_windows) > 50 * n
    covered_chars = sum(len(words[i]) for i in covered)
    return {"n_words": n, "word_chars": chars, "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(in_windows), "base_failed": failed,
            "n_repeats": repeats, "longest_repeat": longest, "covered_chars": covered_chars, "covered": covered,
            "kept": not failed and covered_chars <= 0.4 * chars and longest <= 0.25 * chars}


def with_periodic_tail(doc_id: int | None, words: list[str]) -> list[str]:
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[a + (i - a) % p] if i >= a else word for i, word in enumerate(words)]


def periodic_runs(words: list, least: int = 12) -> list[tuple[int, int, int]]:
    """(start, length, period) by start and period: of each period all maximal stretches, shorter periods struck out."""
    n, found = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            if length >= max(least, 2 * q):
                stretch = words[start:start + length]
                if all(any(stretch[k] != stretch[k + d] for k in range(length - d)) for d in range(1, q)):
                    found.append((start, length, q))
            i += 1
    return sorted(found)


def collapsed(words: list[str], runs) -> str:
    gone = {i for start, length, period in runs for i in range(start + period, start + length)}
    return " ".join(word for i, word in enumerate(words) if i not in gone)
