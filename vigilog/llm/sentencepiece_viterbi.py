"""SentencePiece encoding and decoding by a Viterbi pass shared between words with a common prefix.

Spaces become the mark U+2581, one is put in front, and the text falls into marked words.
No piece reaches past a word, so words are segmented alone. The distinct words of a batch
are sorted, which makes them a trie read depth first: the forward table of the prefix that
a word shares with the one before it is kept, only the rest is computed. Which pieces end
at a letter is told by an automaton over all pieces, whose state is part of that table.

The public vocabulary is a byte-pair one, whose scores are merge ranks and not log
probabilities; a path of greatest score sum would not be its segmentation. So a forward
step scores a piece 0 if byte-pair merging leaves it beside the piece before, and minus
infinity if not. Exactly one path survives for each prefix, and it is the segmentation:
the ids equal those of the sentencepiece library, as the tests check.

Defined cases: a null text has null ids, an empty one has none, and both decode to
themselves; a U+2581 in a text decodes to a space, as in the library; repeated rows are
encoded one by one; an empty table stays empty; only the named column is read.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigilog.llm.common import clash_free, ship
from vigilog.llm.words import give_back

MODEL = "piece_bpe_32k.model"  # of the public vocabularies
MARK = "▁"
_UNITS = re.compile(f"{MARK}+[^{MARK}\n]*|\n[^{MARK}\n]*")
UNKNOWN = -1
NEVER = float("-inf")
TEXTS = 2048  # segmented together: the more words, the longer the prefixes that they share; what is held besides grows with it


class Pieces:
    """The vocabulary of a model file, and the words segmented so far (bounded)."""

    most_words = 400_000
    most_pairs = 1_000_000
    most_letters = 16_000_000  # of the words kept

    def __init__(self, model: bytes):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_proto=model)
        ids = range(sp.get_piece_size())
        plain = [i for i in ids if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.text = {i: sp.id_to_piece(i) for i in plain}
        self.id = {piece: i for i, piece in self.text.items()}
        self.score = {i: sp.get_score(i) for i in plain}
        # the automaton of all pieces: next states by letter (filled as they are met), the state of the longest
        # proper suffix, the letters read; state 0 has read none
        self.next: list[dict[str, int]] = [{}]
        self.read = [""]
        for piece in self.id:
            state = 0
            for c in piece:
                if c not in self.next[state]:
                    self.next[state][c] = len(self.next)
                    self.next.append({})
                    self.read.append(self.read[state] + c)
                state = self.next[state][c]
        self.state = {text: state for state, text in enumerate(self.read)}
        self.ends: list[tuple[tuple[int, int], ...] | None] = [None] * len(self.next)
        self.byte = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.runs = sorted((len(p) for p in self.id if not p.strip(MARK)), reverse=True)
        spelled = {i: piece.replace(MARK, " ").encode() for i, piece in self.text.items()}
        spelled |= {i: bytes([b]) for b, i in enumerate(self.byte)}
        self.bytes = pa.array([spelled.get(i, b"") for i in ids], pa.large_binary())
        self.spelled = {i: array("i", [i]).tobytes() for i in ids}
        self.pairs: dict[int, dict[int, bool]] = {}
        self.n_pairs = 0
        self.built: dict[int, tuple[list, list] | None] = {}
        self.words: dict[str, bytes] = {}
        self.letters = 0

    def history(self, piece: int) -> tuple[list, list] | None:
        """How byte-pair merging (the best pair first, the left one of equals) builds the piece.

        Two lists with an entry before each merge and one at the end: the score of that
        merge, and the outermost part on the right (on the left). None if merging the
        piece's characters gives something else.
        """
        if piece not in self.built:
            parts, right, left = list(self.text[piece]), [], []
            while True:
                scores = [self.score.get(self.id.get(x + y), NEVER) for x, y in zip(parts, parts[1:])]
                best = max(scores, default=NEVER)
                right.append((best, parts[-1]))
                left.append((best, parts[0]))
                if best == NEVER:
                    break
                k = scores.index(best)
                parts[k : k + 2] = [parts[k] + parts[k + 1]]
            self.built[piece] = (right, left) if parts == [self.text[piece]] and parts[0] in self.id else None
        return self.built[piece]

    def beside(self, left: int, right: int) -> bool:
        """Whether merging leaves these two pieces side by side.

        Both are built in step, the better merge first; they stay apart unless a pair
        across the border is at some time the best there is.
        """
        if self.n_pairs >= self.most_pairs:
            self.n_pairs = 0
            for known in self.pairs.values():
                known.clear()
        self.n_pairs += 1
        ours, theirs, i, j = self.built[left][0], self.built[right][1], 0, 0
        while True:
            (a, x), (b, y) = ours[i], theirs[j]
            across = self.score.get(self.id.get(x + y), NEVER)
            if across > a and across >= b or a == b == NEVER:
                break
            if a >= b:
                i += 1
            else:
                j += 1
        fits = self.pairs[left][right] = across == NEVER
        return fits

    def _follow(self, state: int, letter: str) -> int:
        """The state after one more letter: the longest suffix of what was read that begins a piece."""
        suffix = self.read[state] + letter
        while suffix not in self.state:
            suffix = suffix[1:]
        found = self.next[state][letter] = self.state[suffix]
        return found

    def _ending(self, state: int) -> tuple[tuple[int, int], ...]:
        """Pieces that end where this state is reached, and their lengths, longest first."""
        text = self.read[state]
        suffixes = (self.id.get(text[k:]) for k in range(len(text)))
        found = self.ends[state] = tuple((i, len(self.text[i])) for i in suffixes if i is not None and self.history(i))
        for i, _ in found:
            self.pairs.setdefault(i, {})
        return found

    def _segment(self, words: list[str], first: str = "", before: bytes = b"") -> None:
        """Forward passes over sorted ``words``, each from the end of the prefix shared with the one before.

        The words stand behind a space, whose mark is their ``first`` letter, or behind
        the end of a line, whose ids are put ``before`` theirs.
        """
        pairs, spelled, ends, following, follow = self.pairs, self.spelled, self.ends, self.next, self._follow
        # for each prefix length: the automaton's state, the surviving path's last piece, and the length of the prefix before that piece
        states, last, back = [0], [UNKNOWN], [0]
        previous = ""
        for key in words:
            word = first + key
            shared = 0
            for x, y in zip(previous, word):
                if x != y:
                    break
                shared += 1
            del states[shared + 1 :], last[shared + 1 :], back[shared + 1 :]
            state = states[shared]
            for end in range(shared + 1, len(word) + 1):
                c = word[end - 1]
                to = following[state].get(c)
                state = follow(state, c) if to is None else to
                states.append(state)
                ending = ends[state]
                if ending is None:
                    ending = self._ending(state)
                for i, size in ending:
                    left = last[end - size]
                    if left != UNKNOWN:
                        fits = pairs[left].get(i)
                        if not (self.beside(left, i) if fits is None else fits):
                            continue
                    last.append(i)
                    back.append(end - size)
                    break
                else:
                    last.append(UNKNOWN)
                    back.append(end - 1)
            ids, end = [], len(word)
            while end:
                i, at = last[end], back[end]
                ids.append(spelled[i] if i != UNKNOWN else array("i", [self.byte[b] for b in word[at].encode()]).tobytes())
                end = at
            ids.append(before)
            self.words[key if first else "\n" + key] = b"".join(reversed(ids))
            previous = word

    def _run(self, marks: int) -> bytes:
        """Pieces for marks that no word takes: merging grows them from the left, as far as a piece reaches."""
        ids = b""
        while marks:
            size = next(s for s in self.runs if s <= marks)
            ids += self.spelled[self.id[MARK * size]]
            marks -= size
        return ids

    def _learn(self, units: set[str]) -> None:
        """Segment what is new: words behind one space, words behind a line end (with it), runs of marks with a word or none."""
        new = units - self.words.keys()
        letters = sum(map(len, new))
        if len(self.words) + len(new) > self.most_words or self.letters + letters > self.most_letters:
            self.words.clear()
            new, self.letters, letters = units, 0, sum(map(len, units))
        self.letters += letters
        runs = {u: u.lstrip(MARK) for u in new if u[0] == MARK}
        plain = {u for u in new if u[0] not in (MARK, "\n")} | {core for core in runs.values() if core and core not in self.words}
        self._segment(sorted(plain), first=MARK)
        self._segment(sorted(u[1:] for u in new if u[0] == "\n"), before=self.spelled[self.byte[10]])
        lone = self.spelled[self.id[MARK]]
        for unit, core in runs.items():
            marks, ids = len(unit) - len(core), self.words[core] if core else b""
            if ids[:4] == lone:  # the word takes no mark, so the run has them all
                ids = ids[4:]
            elif core:
                marks -= 1
            self.words[unit] = self._run(marks) + ids

    def _parts(self, text: str) -> list[str]:
        """The units of a text that has more than single spaces between words."""
        units = _UNITS.findall(MARK + text.replace(" ", MARK))
        return [u[1:] if u[0] == MARK and len(u) > 1 and u[1] != MARK else u for u in units]

    def _split(self, text: str | None) -> list[str]:
        if not text:
            return []
        spaced = text.replace("\n", " \n")
        if spaced[0] == " " or spaced[-1] == " " or "  " in spaced or MARK in text:
            return self._parts(text)
        return spaced.split(" ")

    def encode(self, texts: list[str | None]) -> list[np.ndarray | None]:
        split = [self._split(t) for t in texts]
        low = 0
        found: list[np.ndarray | None] = []
        while low < len(split):  # as many texts at a time as the memory for words allows
            high, words, letters = low, set(), 0
            while high < len(split) and (high == low or len(words) < self.most_words // 2 and letters < self.most_letters // 2):
                words.update(split[high])
                letters += len(texts[high] or "")
                high += 1
            self._learn(words)
            get = self.words.__getitem__
            found += [np.frombuffer(b"".join(map(get, s)), np.int32) for s in split[low:high]]
            low = high
        return [None if t is None else ids for t, ids in zip(texts, found)]

    def decode(self, lists: pa.ListArray) -> pa.Array:
        """The texts of lists of ids; a first space is the one that encoding put there."""
        offsets = lists.offsets.to_numpy().astype(np.int64)
        joined = self.bytes.take(lists.values.slice(int(offsets[0]), int(offsets[-1] - offsets[0])))
        ends = np.frombuffer(joined.buffers()[1], np.int64, len(joined) + 1)[offsets - offsets[0]]
        data = np.frombuffer(joined.buffers()[2], np.uint8, int(ends[-1])) if ends[-1] else np.empty(0, np.uint8)
        starts = ends[:-1][np.diff(ends) > 0]
        space = starts[data[starts] == 32]
        data = np.delete(data, space)
        ends = ends - np.searchsorted(space, ends)
        texts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lists), [None, pa.py_buffer(ends), pa.py_buffer(data)])
        try:
            found = texts.cast(pa.large_string()).cast(pa.string())
        except pa.ArrowInvalid:  # ids that no text has
            found = pa.array([t.decode(errors="replace") for t in texts.to_pylist()], pa.string())
        return pc.if_else(lists.is_valid(), found, None) if lists.null_count else found


@lru_cache(2)
def pieces_of(model: bytes) -> Pieces:
    return Pieces(model)


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def read_model(path: str | None = None) -> bytes:
    """The model file, read on the driver and sent with the tasks."""
    with open(path or model_path(), "rb") as f:
        return f.read()


def _encoded(pieces: Pieces, texts: pa.Array) -> pa.ListArray:
    ids = pieces.encode(texts.to_pylist())
    sizes = np.cumsum([0, *(0 if x is None else len(x) for x in ids)])
    missing = [x is None for x in ids]
    values = np.concatenate([x for x in ids if x is not None]) if not all(missing) else np.empty(0, np.int32)
    mask = pa.array(missing, pa.bool_()) if any(missing) else None
    return pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(values, pa.int32()), mask=mask)


def _in_slices(array: pa.Array, kind: pa.DataType, job: Callable[[pa.Array], pa.Array]) -> pa.Array:
    """``job`` on some texts at a time, so that only these are held in other forms."""
    parts = [job(array.slice(low, TEXTS)) for low in range(0, len(array), TEXTS)]
    return pa.concat_arrays(parts) if parts else pa.array([], kind)


_IDS = pa.list_(pa.int32())


def encode_pieces(text: Column, model: bytes) -> Column:
    ship(SparkSession.active())

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def encode(texts: pa.Array) -> pa.Array:
        pieces = pieces_of(model)
        return _in_slices(texts, _IDS, lambda some: _encoded(pieces, some))

    return encode(text)


def decode_pieces(ids: Column, model: bytes) -> Column:
    ship(SparkSession.active())

    @F.arrow_udf(T.StringType())
    def decode(lists: pa.Array) -> pa.Array:
        return _in_slices(lists, pa.string(), pieces_of(model).decode)

    return decode(ids)


def encode_and_decode(text: Column, model: bytes) -> Column:
    """Struct of the ids and the text that these decode to, both made in one pass over the texts."""
    ship(SparkSession.active())

    @F.arrow_udf("ids array<int>, decoded string")
    def both(texts: pa.Array) -> pa.Array:
        pieces = pieces_of(model)

        def one(some: pa.Array) -> pa.Array:
            ids = _encoded(pieces, some)
            return pa.StructArray.from_arrays([ids, pieces.decode(ids)], names=["ids", "decoded"])

        found = _in_slices(texts, pa.struct([("ids", _IDS), ("decoded", pa.string())]), one)
        give_back()
        return found

    return both(text)


def with_pieces(docs: DataFrame, model: bytes, text: str = "text") -> DataFrame:
    """``docs`` with ``token_ids`` and with the text that they decode to."""
    safe, names = clash_free(docs.drop("token_ids"))
    coded = safe.withColumn("coded", encode_and_decode(F.col(names[text]).cast("string"), model))
    columns = [F.col("coded.decoded" if old == text else new).alias(old) for old, new in names.items()]
    return coded.select(*columns, F.col("coded.ids").alias("token_ids"))
