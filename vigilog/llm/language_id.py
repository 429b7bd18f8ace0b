"""Language identification by rank-order profiles of letter n-grams.

A language's profile is the list of its ``PROFILE`` most frequent n-grams of one to three
letters, a blank standing for either end of a word. A text's own list is compared with each
profile: every n-gram costs the number of places it is off, or ``PROFILE`` if the profile
lacks it. The language of least distance is predicted. Profiles are counted over all
training rows; tasks count before anything is shuffled.

Defined cases: a null text or one without letters is ``und`` with score 0, as is every
text if nothing was learned; rows with a null language teach nothing; a null id counts as
0 when rows are held out; equal distances go to the first language in text order; repeated
rows are predicted one by one; an empty table stays empty. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigilog.llm.common import ship
from vigilog.llm.words import pieces
from vigilog.session import materialize

PROFILE = 300
UNKNOWN = "und"
FOLDS, HELD_OUT = 4, 2
COUNTED = 3_000_000  # n-grams a task counts at a time
_BLANK = np.int64(32)


@lru_cache(1)
def _letters() -> np.ndarray:
    """Of every code point the lower-case letter, or a blank if it is no letter."""
    points = map(chr, range(0x110000))
    return np.fromiter((ord(c.lower()[0]) if c.isalpha() else 32 for c in points), np.int64, 0x110000)


def grams(text: str | None) -> np.ndarray:
    """The n-grams of a text as numbers, with repeats; none without a letter."""
    if not text:
        return np.empty(0, np.int64)
    points = _letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    letter = points != _BLANK
    if not letter.any():
        return np.empty(0, np.int64)
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # one blank after each word
    a = np.concatenate(([_BLANK], points[keep], [_BLANK] if letter[-1] else []))
    a = a.astype(np.int64)
    is_letter = a != _BLANK
    one = a[is_letter]
    two = (a[:-1] << 21 | a[1:])[is_letter[:-1] | is_letter[1:]]
    three = (a[:-2] << 42 | a[1:-1] << 21 | a[2:])[is_letter[1:-1]]
    return np.concatenate((one, two, three))


def ranked(values: np.ndarray, most: int = PROFILE) -> np.ndarray:
    """The most frequent values, ties by value."""
    found, count = np.unique(values, return_counts=True)
    if len(found) > most:
        least = np.partition(count, len(count) - most)[len(count) - most]
        keep = count >= least
        found, count = found[keep], count[keep]
    return found[np.argsort(-count, kind="stable")][:most]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """n-grams of the texts of each language, added up as far as a task sees them."""
    waiting: dict[str, list[np.ndarray]] = {}
    size = 0

    def counted() -> Iterator[pa.RecordBatch]:
        for lang, parts in waiting.items():
            gram, n = np.unique(np.concatenate(parts), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(gram), pa.string()), pa.array(gram), pa.array(n)], names=["lang", "gram", "n"])

    for batch in batches:
        for part in pieces(batch, 0):
            for text, lang in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                found = grams(text)
                waiting.setdefault(lang, []).append(found)
                size += len(found)
                if size >= COUNTED:
                    yield from counted()
                    waiting, size = {}, 0
    yield from counted()


def learn_profiles(rows: DataFrame, text: str = "text", lang: str = "lang", most: int = PROFILE) -> dict[str, list[int]]:
    """The profile of each language; ``most`` numbers a language reach the driver."""
    ship(rows.sparkSession)
    counts = rows.where(F.col(lang).isNotNull()).select(text, F.col(lang).cast("string").alias("lang"))
    total = counts.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    best = total.withColumn("rank", rank).where(F.col("rank") <= most)
    profiles: dict[str, list[int]] = {}
    for r in materialize(best, "profiles").orderBy("lang", "rank").collect():
        profiles.setdefault(r["lang"], []).append(r["gram"])
    return profiles


class Profiles:
    def __init__(self, profiles: dict[str, list[int]], most: int = PROFILE):
        self.langs, self.most = sorted(profiles), most
        self.known = np.unique(np.concatenate([np.array(p, np.int64) for p in profiles.values()])) if profiles else np.empty(0, np.int64)
        self.places = np.full((len(self.langs), len(self.known) + 1), -1, np.int64)
        for k, lang in enumerate(self.langs):
            self.places[k, np.searchsorted(self.known, profiles[lang])] = np.arange(len(profiles[lang]))

    def predict(self, text: str | None) -> tuple[str, float]:
        own = ranked(grams(text), self.most)
        if not len(own) or not self.langs:
            return UNKNOWN, 0.0
        at = np.searchsorted(self.known, own)
        at = np.where(self.known[np.minimum(at, len(self.known) - 1)] == own, at, len(self.known))
        places = self.places[:, at]
        off = np.where(places < 0, self.most, np.abs(places - np.arange(len(own)))).sum(1)
        best = int(off.argmin())
        return self.langs[best], 1.0 - float(off[best]) / (self.most * len(own))


def held_out(doc_id: Column, folds: int = FOLDS, which: int = HELD_OUT) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(0)) == which


def identify(docs: DataFrame, profiles: dict[str, list[int]], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Profiles(profiles)
        for batch in batches:
            for part in pieces(batch, 1):
                lang, score = zip(*(model.predict(t) for t in part.column(1).to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "lang_pred", "score"]
                )

    ship(docs.sparkSession)
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), text).mapInArrow(run, "doc_id long, lang_pred string, score double")


def language_id(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(doc_id, held_out, lang_pred, score): profiles learned from the rows that are not held out."""
    profiles = learn_profiles(docs.where(~held_out(F.col(doc_id))), text, lang)
    found = identify(docs, profiles, doc_id, text)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
