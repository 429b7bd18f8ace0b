"""Quality scores by Bradley-Terry pairwise ranking: learned from which of two texts is preferred.

A text labelled 1 is preferred to one labelled 0. The probability that x beats y is the
logistic function of w (f(x) - f(y)), f being statistics of the text; w minimises the
logistic loss over preference pairs. A text's own value is w f(x). The threshold is the
quantile of the learned texts' values that parts them with the fewest errors; the score is
a logistic function of the value whose slope is fitted to the labels and which is 0.3 at
the threshold.

Learning takes the ``SAMPLE`` labelled texts of either label that come first by a hash of
their ids, or all if there are fewer; ``PAIRED`` opponents, drawn without regard to order,
are put against each. Only their features reach the driver. A linear function of a few
dozen statistics does not gain from more. The shares of both labels are counted over all.

Defined cases: a null text counts as empty and gets the score that its features give; a
null id counts as held out or not as the remainder 0 does and has no label; labels other
than 0 and 1 teach nothing; where an id has both labels, either one teaches; repeated rows
are scored one by one; without labels of both kinds every score is 0.5; an empty table
stays empty. Only the named columns are read.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilog.llm.common import ship

FOLDS, HELD_OUT = 5, 0
CUT = 0.3  # score at the threshold
SAMPLE = 20_000  # learned texts of either label, at most
PAIRED = 4
RIDGE = 1e-3
STEPS = 40


def _classes() -> np.ndarray:
    """The class of each byte: 0 lower case, 1 upper case, 2 digit, 3 blank, 4 line end, 5 mark of prose, 6 other mark, 7 start of a longer character, 8 its rest, 9 control."""
    kind = np.full(256, 6)
    kind[:32], kind[127] = 9, 9
    kind[97:123], kind[65:91], kind[48:58] = 0, 1, 2
    kind[[32, 9, 11, 12]], kind[[10, 13]] = 3, 4
    kind[list(b".,;:!?'\"()-")] = 5
    kind[128:192], kind[192:] = 8, 7
    return kind.astype(np.uint8)


_KIND = _classes()
FEATURES = (
    "letters", "upper", "digits", "blanks", "line_ends", "prose_marks", "other_marks", "wide", "control",
    "length", "words", "word_length", "short_words", "long_words", "distinct_words", "top_word", "repeated_lines",
    "line_length", "upper_words", "marked_words", "doubled_marks", "bare_marks", "sentence_ends", "same_again", "empty",
)


def features(text: str | None) -> np.ndarray:
    """Statistics of a whole text, each near 0 to 1."""
    raw = (text or "").encode()
    out = np.zeros(len(FEATURES))
    words = raw.split()
    n = len(words)
    if not n:
        out[-1] = 1
        return out
    kinds = _KIND[np.frombuffer(raw, np.uint8)]
    count = np.bincount(kinds, minlength=10)
    chars = len(raw) - count[8]
    letters = max(1, count[0] + count[1] + count[7])
    out[:9] = count[[0, 1, 2, 3, 4, 5, 6, 7, 9]] / chars
    out[0], out[1] = letters / chars, count[1] / letters
    space = (kinds == 3) | (kinds == 4)  # as bytes.split() parts words
    edges = np.flatnonzero(np.diff(space, prepend=True, append=True))
    starts, ends = edges[::2], edges[1::2]
    sizes = ends - starts
    mark = (kinds == 5) | (kinds == 6)
    first, last = kinds[starts], kinds[ends - 1]
    seen: dict[bytes, int] = {}
    for word in words:
        seen[word] = seen.get(word, 0) + 1
    lines = [x for x in raw.split(b"\n") if x]
    out[9:] = (
        np.log10(chars) / 6,
        np.log10(n) / 5,
        min(4.0, sizes.mean() / 10),
        (sizes <= 2).mean(),
        (sizes > 15).mean(),
        len(seen) / n,
        max(seen.values()) / n,
        1 - len(set(lines)) / max(1, len(lines)),
        min(4.0, chars / max(1, len(lines)) / 500),
        ((first == 1) & (kinds[np.maximum(ends - 2, starts)] == 1) & (sizes > 1)).mean(),
        ((last == 5) | (last == 6)).mean(),
        (mark[1:] & mark[:-1]).sum() / n,
        ((sizes == 1) & mark[starts]).mean(),
        min(1.0, (raw.count(b". ") + raw.count(b".\n") + raw.endswith(b".")) / n),
        sum(map(bytes.__eq__, words, words[1:])) / n,
        0.0,
    )
    return out


class Model(NamedTuple):
    """Value of features f: (f - mean) . weights; score: logistic of slope * (value - threshold), 0.3 at 0."""

    mean: np.ndarray
    weights: np.ndarray
    threshold: float
    slope: float

    def values(self, f: np.ndarray) -> np.ndarray:
        return (f - self.mean) @ self.weights

    def scores(self, f: np.ndarray) -> np.ndarray:
        """CUT or more exactly where the value reaches the threshold."""
        over = self.slope * (self.values(f) - self.threshold)
        logit = np.clip(over + np.log(CUT / (1 - CUT)), -700, 700)
        score = 1 / (1 + np.exp(-logit))
        return np.where(over >= 0, np.maximum(score, CUT), np.minimum(score, np.nextafter(CUT, 0)))


def preference_pairs(winners: int, losers: int, paired: int = PAIRED) -> tuple[np.ndarray, np.ndarray]:
    """Places of winners and losers, each text in ``paired`` pairs or more, against opponents in shuffled order."""
    rng = np.random.default_rng(11)
    size = max(winners, losers)
    a = np.concatenate([np.resize(rng.permutation(winners), size) for _ in range(paired)])
    b = np.concatenate([np.resize(rng.permutation(losers), size) for _ in range(paired)])
    return a, b


def bradley_terry(winners: np.ndarray, losers: np.ndarray, paired: int = PAIRED, ridge: float = RIDGE) -> np.ndarray:
    """Weights of least logistic loss over differences of features, by Newton's steps."""
    a, b = preference_pairs(len(winners), len(losers), paired)
    diff = winners[a] - losers[b]
    w = np.zeros(diff.shape[1])

    def loss(w: np.ndarray) -> float:
        return np.logaddexp(0, -diff @ w).mean() + ridge * (w @ w) / 2

    for _ in range(STEPS):
        wrong = 1 / (1 + np.exp(np.clip(diff @ w, -700, 700)))
        gradient = ridge * w - diff.T @ wrong / len(diff)
        curve = (diff * (wrong * (1 - wrong))[:, None]).T @ diff / len(diff) + ridge * np.eye(len(w))
        step, size, now = np.linalg.solve(curve, gradient), 1.0, loss(w)
        while size > 1e-6 and loss(w - size * step) > now:
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-6:
            break
    return w


def best_quantile(values: np.ndarray, good: np.ndarray, weight: np.ndarray) -> float:
    """The value between two neighbours in order that leaves the least weight on the wrong side; the middle one of equals."""
    order = np.argsort(values, kind="stable")
    v, g, w = values[order], good[order], weight[order]
    wrong = np.concatenate(([0.0], np.cumsum(np.where(g, w, -w)))) + w[~g].sum()  # the first k stand below
    wrong[1:-1][v[1:] == v[:-1]] = np.inf
    best = np.flatnonzero(wrong <= wrong.min() + 1e-9)
    k = int(best[len(best) // 2])
    if k in (0, len(v)):
        return float(v[0] - 1 if k == 0 else v[-1] + 1)
    return float(v[k - 1] + v[k]) / 2


def _slope(over: np.ndarray, good: np.ndarray, weight: np.ndarray) -> float:
    """How steeply the probability of label 1 rises, by bisection on the gradient; bounded where labels part without error."""
    start, target = np.log(CUT / (1 - CUT)), good.astype(float)
    low, high = 1e-3, 20 / max(1e-9, float(np.abs(over).mean()))
    for _ in range(60):
        slope = (low + high) / 2
        p = 1 / (1 + np.exp(-np.clip(start + slope * over, -700, 700)))
        low, high = (slope, high) if (weight * (target - p) * over).sum() > 0 else (low, slope)
    return (low + high) / 2


def fit(f: np.ndarray, good: np.ndarray, shares: tuple[float, float]) -> Model | None:
    """A model from features, labels and the shares of labels 0 and 1 among all labelled texts; None if a label is missing."""
    if good.all() or not good.any():
        return None
    mean, spread = f.mean(0), f.std(0)
    scale = np.where(spread > 1e-9, spread, np.inf)
    z = (f - mean) / scale
    weights = bradley_terry(z[good], z[~good]) / scale
    values = (f - mean) @ weights
    weight = np.where(good, shares[1] / good.sum(), shares[0] / (~good).sum())
    threshold = best_quantile(values, good, weight)
    return Model(mean, weights, threshold, _slope(values - threshold, good, weight))


def held_out(doc_id: Column, folds: int = FOLDS, which: int = HELD_OUT) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(0)) == which


def _features(text: Column) -> Column:
    ship(SparkSession.active())

    @F.arrow_udf("array<double>")
    def read(texts: pa.Array) -> pa.Array:
        found = np.array([features(t) for t in texts.to_pylist()]).reshape(len(texts), len(FEATURES))
        offsets = np.arange(len(texts) + 1, dtype=np.int32) * len(FEATURES)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(found.ravel()))

    return read(text.cast("string"))


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE) -> Model | None:
    """A model from the labelled rows of ``docs`` that are not held out."""
    known = labels.select(F.col(doc_id).cast("long").alias("id"), F.col(label).cast("int").alias("label"))
    known = known.where(F.col("id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("id"))).distinct()
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}  # two rows
    if len(counts) < 2:
        return None
    chosen = None
    for value in (0, 1):
        some = known.where(F.col("label") == value).orderBy(F.xxhash64("id"), "id").limit(sample)
        chosen = some if chosen is None else chosen.unionByName(some)
    texts = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    rows = texts.join(F.broadcast(chosen), "id").select("label", _features(F.col("text")).alias("f"))  # 2 * sample ids
    found = rows.toArrow()
    if not found.num_rows:
        return None
    f = found.column("f").combine_chunks().flatten().to_numpy().reshape(-1, len(FEATURES))
    good = found.column("label").to_numpy() == 1
    order = np.lexsort((*f.T, good))  # the result depends on the rows, not on the order in which they come
    total = counts[0] + counts[1]
    return fit(f[order], good[order], (counts[0] / total, counts[1] / total))


def quality_score(text: Column, model: Model | None) -> Column:
    """Score of whole texts from 0 to 1; 0.5 without a model."""
    if model is None:
        return F.lit(0.5)
    ship(SparkSession.active())

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        found = np.array([features(t) for t in texts.to_pylist()]).reshape(len(texts), len(FEATURES))
        return pa.array(model.scores(found))

    return score(text.cast("string"))


def keep_preferred(docs: DataFrame, model: Model | None, text: str = "text", cut: float = CUT) -> DataFrame:
    """Rows whose score reaches ``cut``."""
    return docs.where(quality_score(F.col(text), model) >= cut)
