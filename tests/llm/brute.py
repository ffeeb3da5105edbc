"""Plain versions of what the operators compute, and small tables."""

from __future__ import annotations

import re

import xxhash
from pyspark.sql import SparkSession

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(spark: SparkSession, rows):
    """A documents table of (doc_id, text) or (doc_id, text, lang)."""
    filled = []
    for doc_id, text, *lang in rows:
        size = None if text is None else len(text)
        filled.append((doc_id, text, lang[0] if lang else "en", "src", size))
    return spark.createDataFrame(filled, DOCUMENTS)


def lower_ascii(text: str) -> str:
    return re.sub("[A-Z]", lambda found: found[0].lower(), text)


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", lower_ascii(text or ""))


def fingerprint(text: str | None, size: int = 3) -> int:
    found = words(text)
    if not found:
        return 0
    last = max(1, len(found) - size + 1)
    hashes = [
        xxhash.xxh64_intdigest(" ".join(found[i : i + size]).encode(), seed=42)
        for i in range(last)
    ]
    value = 0
    for bit in range(64):
        if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes):
            value |= 1 << bit
    return value


def linked(values: list, close) -> list[int]:
    """The component of each place, named by its first place."""
    names = list(range(len(values)))

    def find(i):
        while names[i] != i:
            i = names[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if close(values[i], values[j]):
                a, b = sorted((find(i), find(j)))
                names[b] = a
    return [find(i) for i in range(len(values))]
