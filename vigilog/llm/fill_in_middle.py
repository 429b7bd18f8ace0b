"""Fill-in-middle: a text's middle moves behind its suffix, by rotations of blocks in place.

A text is cut into units, runs of ASCII letters or single other characters. Two cuts, drawn
from a hash of the id, part it into prefix, middle and suffix. The sentinels are inserted
into the UTF-8 bytes where the parts stand, ``<P>`` prefix ``<M>`` middle ``<S>`` suffix,
and one rotation brings the blocks into the order of the form:

    psm   <P> prefix <S> suffix <M> middle     middle and suffix change places
    spm   <S> suffix <P> prefix <M> middle     the suffix goes before both others

A rotation is three reversals within the bytearray. Restoring finds the sentinels, turns
the same blocks back and deletes the sentinels; the text returns byte by byte. Texts that
hold a sentinel stay plain, so each sentinel stands once in an output that is not plain.

Defined cases: a null text counts as empty; an empty text is plain, has no units and
restores to itself; a null id is hashed as the empty string; repeated rows come out alike;
an empty table stays empty. Other columns are kept, but for those named like a result.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilog.llm.common import clash_free, ship

# The sentinels, the form names.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"

SEED = "1:"
TRANSFORMED = 90  # of 100 texts
SUFFIX_FIRST = 20  # of 100 transformed texts


class Cut(NamedTuple):
    form: str
    units: int
    prefix_chars: int | None
    middle_chars: int | None
    output: bytes


def rotate(buffer: bytearray, low: int, cut: int, high: int) -> None:
    """Exchange the neighbouring blocks [low, cut) and [cut, high): reverse each, then both together."""
    for a, b in ((low, cut), (cut, high), (low, high)):
        buffer[a:b] = buffer[a:b][::-1]


def unit_starts(raw: np.ndarray) -> np.ndarray:
    """Where units begin in UTF-8 bytes: at the first of a run of ASCII letters, and at every other character."""
    letter = ((raw | 0x20) >= 97) & ((raw | 0x20) <= 122) & (raw < 128)
    start = (raw & 0xC0) != 0x80
    start[1:] &= ~(letter[1:] & letter[:-1])
    return np.flatnonzero(start)


def draws(doc_id: int | None) -> tuple[int, int, int, int]:
    digest = hashlib.sha256(f"{SEED}{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(digest[k : k + 8], 16) for k in range(0, 32, 8))


def _chars(raw: np.ndarray) -> int:
    return int(np.count_nonzero((raw & 0xC0) != 0x80))


def transform(doc_id: int | None, text: str | None) -> Cut:
    buffer = bytearray((text or "").encode())
    raw = np.frombuffer(bytes(buffer), np.uint8)
    starts = unit_starts(raw)
    n = len(starts)
    first, second, transformed, suffix_first = draws(doc_id)
    if not n or transformed % 100 >= TRANSFORMED or any(s in buffer for s in (PREFIX, SUFFIX, MIDDLE)):
        return Cut(PLAIN, n, None, None, bytes(buffer))
    a, b = (int(starts[k]) if k < n else len(raw) for k in sorted((first % (n + 1), second % (n + 1))))
    for at, sentinel in ((b, SUFFIX), (a, MIDDLE), (0, PREFIX)):
        buffer[at:at] = sentinel
    middle, suffix = a + len(PREFIX), b + len(PREFIX) + len(MIDDLE)  # where these blocks begin now
    form = SPM if suffix_first % 100 < SUFFIX_FIRST else PSM
    rotate(buffer, 0 if form == SPM else middle, suffix, len(buffer))
    return Cut(form, n, _chars(raw[:a]), _chars(raw[a:b]), bytes(buffer))


def restore(output: bytes, form: str) -> bytes:
    """The text that ``transform`` gave this output and form for."""
    if form == PLAIN:
        return output
    buffer = bytearray(output)
    suffix, prefix, middle = (buffer.find(s) for s in (SUFFIX, PREFIX, MIDDLE))
    if form == SPM:
        rotate(buffer, suffix, prefix, len(buffer))
    else:
        rotate(buffer, suffix, middle, len(buffer))
    middle, suffix = buffer.find(MIDDLE), buffer.rfind(SUFFIX)
    for at, sentinel in ((suffix, SUFFIX), (middle, MIDDLE), (0, PREFIX)):
        del buffer[at : at + len(sentinel)]
    return bytes(buffer)


_CUT = "form string, n_units long, prefix_chars long, middle_chars long, output string"


def transformed(doc_id: Column, text: Column) -> Column:
    """Struct of form, units, lengths of prefix and middle in characters, and output."""
    ship(SparkSession.active())

    @F.arrow_udf(_CUT)
    def cut(ids: pa.Array, texts: pa.Array) -> pa.Array:
        rows = [transform(i, t) for i, t in zip(ids.to_pylist(), texts.to_pylist())]
        form, units, prefix, middle, output = zip(*rows) if rows else ((),) * 5
        return pa.StructArray.from_arrays(
            [
                pa.array(form, pa.string()),
                pa.array(units, pa.int64()),
                pa.array(prefix, pa.int64()),
                pa.array(middle, pa.int64()),
                pa.array(output, pa.binary()).cast(pa.string()),
            ],
            names=["form", "n_units", "prefix_chars", "middle_chars", "output"],
        )

    return cut(doc_id.cast("long"), text.cast("string"))


def restored(output: Column, form: Column) -> Column:
    """The texts again; null for a null output."""
    ship(SparkSession.active())

    @F.arrow_udf("string")
    def back(outputs: pa.Array, forms: pa.Array) -> pa.Array:
        texts = [None if o is None else restore(o.encode(), f) for o, f in zip(outputs.to_pylist(), forms.to_pylist())]
        return pa.array(texts, pa.binary()).cast(pa.string())

    return back(output, form)


def fill_in_middle(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``form``, ``n_units``, ``prefix_chars``, ``middle_chars`` and ``output``."""
    results = ["form", "n_units", "prefix_chars", "middle_chars", "output"]
    safe, names = clash_free(docs)
    cut = safe.withColumn("cut", transformed(F.col(names[doc_id]), F.col(names[text])))
    kept = [F.col(new).alias(old) for old, new in names.items() if old not in results]
    return cut.select(*kept, *[F.col(f"cut.{r}").alias(r) for r in results])
