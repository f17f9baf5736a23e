"""Passages of evaluation items inside documents.

A passage counts if a document has at least ``min_words`` consecutive words of
an item as consecutive words.  The search is one for MinHash containment: a
text is represented by the MinHash of the word shingles of each of its windows
of ``min_words`` words.  Windows hold the same number of shingles on both
sides, so a small item inside a long document is judged like an item inside a
short one, and neighbouring windows mostly share their MinHash, which leaves a
text about a fifth as many values as words.  Equal windows have equal MinHashes,
so every passage shares at least one value with its item and none is missed.
Each pair of texts that share a value is then verified by exact containment of
the item's windows, words compared as text.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrig.llm.canonical import canonical
from tallyrig.session import written

#: Lower-case letters whose capitals look like a Latin capital (from, to).
_CASE_TWINS = str.maketrans("вкмнтαβεζηικμτυχς", "bkmhtabezhikmtyxσ")
_PLAIN_WORD, _WORD = re.compile("[a-z0-9]+"), re.compile(r"[^\W_]+")
#: Characters of text whose words are hashed at once.
_SLICE_CHARS = 4_000_000
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def words(text: str | None) -> list[str]:
    """The words of a text in consistent form without case: stretches of letters and digits."""
    if not text:
        return []
    if text.isascii():
        return _PLAIN_WORD.findall(text.lower())
    lower = canonical(text).lower()
    if not lower.isascii():
        lower = lower.translate(_CASE_TWINS).replace("ß", "ss")
    return _WORD.findall(lower)


class _WordHashes(dict):
    """64-bit hashes of words, remembered."""

    def __missing__(self, word: str) -> int:
        if len(self) >= 1_000_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value


_hash_of = _WordHashes()


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX[0]
    h = (h ^ (h >> np.uint64(27))) * _MIX[1]
    return h ^ (h >> np.uint64(31))


def _least(h: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` successive values."""
    reach = 1
    while reach < width:
        step = min(reach, width - reach)
        h = np.minimum(h[: len(h) - step], h[step:])
        reach += step
    return h


def sketches(texts: Iterable[str | None], min_words: int, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """The different window MinHashes of each text, as (position of the text, value), both sorted."""
    lists = [words(t) for t in texts]
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    total = int(sizes.sum())
    if total < min_words:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    flat = np.fromiter((_hash_of[w] for each in lists for w in each), np.uint64, total)
    count = total - shingle + 1
    rolled = np.zeros(count, np.uint64)
    for k in range(shingle):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + flat[k : k + count]
    values = _least(_mixed(rolled), min_words - shingle + 1)
    owner = np.repeat(np.arange(len(lists)), sizes)
    # A window must not run from one text into the next.
    inside = owner[: len(values)] == owner[min_words - 1 :]
    owner, values = owner[: len(values)][inside], values[inside].view(np.int64)
    fresh = np.ones(len(values), bool)
    fresh[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    owner, values = owner[fresh], values[fresh]
    order = np.lexsort((values, owner))
    owner, values = owner[order], values[order]
    fresh = np.ones(len(values), bool)
    fresh[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    return owner[fresh], values[fresh]


def _slices(texts: pd.Series) -> Iterator[slice]:
    """Stretches of a batch of at most about ``_SLICE_CHARS`` characters; a longer text is one by itself."""
    ends = texts.str.len().fillna(0).cumsum().to_numpy()
    start = 0
    while start < len(texts):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + _SLICE_CHARS, side="right")))
        yield slice(start, stop)
        start = stop


def sketched(rows: DataFrame, key: str, text: str, min_words: int, shingle: int) -> DataFrame:
    """``key, __h``: the different window MinHashes of each row's text."""
    taken = rows.select(key, text)

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in _slices(batch[text]):
                owner, values = sketches(batch[text].iloc[part], min_words, shingle)
                yield pd.DataFrame({key: batch[key].iloc[part].to_numpy()[owner], "__h": values})

    schema = taken.select(key, F.lit(0).cast("long").alias("__h")).schema
    return taken.mapInPandas(each, schema)


@lru_cache(maxsize=256)
def _windows(text: str | None, size: int) -> frozenset:
    """The different windows of ``size`` words of a text."""
    each = words(text)
    return frozenset(zip(*(each[i:] for i in range(size))))


def leaked_passages(
    documents: DataFrame,
    items: DataFrame,
    text: str = "text",
    document_id: str = "doc_id",
    item_id: str = "item_id",
    item_text: str = "text",
    min_words: int = 13,
    shingle: int = 5,
) -> DataFrame:
    """Each document with each item of which it holds a passage.

    Result: ``document_id, item_id, shared_windows, item_windows, containment``:
    how many of the item's different windows of ``min_words`` words are in the
    document, how many it has, and their ratio.

    The documents are read twice: all of them for their MinHashes, of which one
    number a value travels, and for verification only those that share one with
    an item.  Whether the items' values or the pairs are sent to all executors
    or shuffled Spark decides by their size; a value that very many documents
    hold is a skewed key of that join, which adaptive execution splits.

    Null ids are left out; null, empty and shorter texts hold no passage.  Texts
    of any length are used whole.  Repeated rows count once; of several texts
    under one id the pair of texts that shares most counts.  Empty tables give
    no rows.
    """
    if not 0 < shingle <= min_words:
        raise ValueError("a shingle has at least one word and no more than a window")
    left = documents.select(F.col(document_id).alias("__doc"), F.col(text).alias("__text")).filter(F.col("__doc").isNotNull())
    right = items.select(F.col(item_id).alias("__item"), F.col(item_text).alias("__item_text")).filter(F.col("__item").isNotNull()).distinct()
    values = written(sketched(right, "__item", "__item_text", min_words, shingle).distinct())
    pairs = written(sketched(left, "__doc", "__text", min_words, shingle).join(values, "__h").select("__doc", "__item").distinct())
    met = left.join(pairs, "__doc").join(right, "__item").select("__doc", "__item", "__text", "__item_text")

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            whole = [_windows(t, min_words) for t in batch["__item_text"]]
            shared = [len(_windows(t, min_words) & w) for t, w in zip(batch["__text"], whole)]
            yield pd.DataFrame({"__doc": batch["__doc"], "__item": batch["__item"], "shared": shared, "all": [len(w) for w in whole]})

    schema = met.select("__doc", "__item", F.lit(0).cast("long").alias("shared"), F.lit(0).cast("long").alias("all")).schema
    best = met.mapInPandas(verify, schema).filter("shared > 0").groupBy("__doc", "__item").agg(F.max(F.struct("shared", "all")).alias("m"))
    return best.select(
        F.col("__doc").alias(document_id),
        F.col("__item").alias(item_id),
        F.col("m.shared").alias("shared_windows"),
        F.col("m.all").alias("item_windows"),
        F.round(F.col("m.shared") / F.col("m.all"), 6).alias("containment"),
    )
