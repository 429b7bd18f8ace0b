"""Secret scans: an Aho-Corasick pass for keywords, anchored patterns only at its hits, then checksums.

A keyword hit names the patterns worth trying there; each is matched at that place only,
left to right and without overlap per kind, which finds what a scan of the whole text with
the pattern would. A private key is its header, its body and its END line, or the base64
lines that follow if that line is missing. Runs of hex digits have no keyword; a byte table and a substring search
tell the texts that have one. Tokens that carry a checksum count only if it is right.

Spans are in code points, end exclusive, ordered by start, then by kind as in ``KINDS``.

Defined cases: null and empty texts have no spans; redaction leaves a null text null;
repeated rows are scanned one by one; other columns pass through, whatever their names and
nulls; an empty table stays empty.
"""

from __future__ import annotations

import base64
import json
import re
import string
import zlib
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigilog.llm.common import clash_free, keep_batches_small, ship

BASE_KINDS = ("assign", "access", "hex")

# The formats of well-known credentials. Keywords are in lower case.
ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
_EOL, _PAD, _B64 = r"(?:\r?\n|\r|(?:\\r)?\\n)", r"""(?:[\x20\t"'+,;>|\#*]|//(?=[\x20\t]))*+""", r"[A-Za-z0-9+/=]"
_LINE_END = rf"""["',;]*+[\x20\t]*+(?:\+[\x20\t]*+)?(?={_EOL}|\Z)"""
# A key runs on to the END line of its label, whatever stands between, or, if no such line comes before the next
# header, to the end of the base64 lines (or blank-separated base64 words) behind its own header and header fields.
PRIVATE_KEY = re.compile(
    rf"""-----BEGIN\x20((?:[A-Z0-9]+\x20)*PRIVATE\x20KEY(?:\x20BLOCK)?)-----(?:
    (?:[^-]++|-(?!----(?:BEGIN\x20|END\x20\1-----)))*+-----END\x20\1-----
    |(?:{_PAD}{_B64}++{_LINE_END}|{_B64}++(?:[\x20\t]++{_B64}{{16,}}+)*+(?:[\x20\t]++{_B64}++)?|(?:[\x20\t]++{_B64}{{16,}}+)++(?:[\x20\t]++{_B64}++)?)?
    (?:{_LINE_END}{_EOL}{_PAD}(?:Proc-Type|DEK-Info|Version|Comment|Hash|Charset|MessageID):[^\r\n\\]*+)*+
    (?:(?:{_LINE_END}{_EOL})++{_PAD}{_B64}{{16,}}+{_LINE_END}|{_LINE_END}{_EOL}(?:["']{_PAD}{_EOL})?{_PAD}{_B64}++{_LINE_END})*+
    )""",
    re.VERBOSE,
)
MORE = {
    "github": (("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), re.compile(r"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])")),
    "npm": (("npm_",), re.compile(r"npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])")),
    "slack": (("xoxb-", "xoxa-", "xoxp-", "xoxr-", "xoxs-"), re.compile(r"xox[baprs]-[0-9]{8,}-[A-Za-z0-9-]{10,}")),
    "google": (("aiza",), re.compile(r"AIza[A-Za-z0-9_-]{35}(?![A-Za-z0-9_-])")),
    "stripe": (("sk_live_", "rk_live_"), re.compile(r"[sr]k_live_[A-Za-z0-9]{24,}")),
    "jwt": (("eyj",), re.compile(r"(eyJ[A-Za-z0-9_-]{8,})\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{16,}")),
    "private_key": (("-----begin ",), PRIVATE_KEY),
}
_RUN = re.compile(r"[A-Za-z0-9_-]*")
KINDS = (*BASE_KINDS, *MORE)
_BASE62 = string.digits + string.ascii_uppercase + string.ascii_lowercase


def checksum62(text: str) -> str:
    """CRC-32 of ``text`` as six base-62 digits."""
    value, digits = zlib.crc32(text.encode()), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        digits = _BASE62[digit] + digits
    return digits


def _valid(kind: str, found: re.Match) -> bool:
    token = found.group()
    if kind == "assign":
        return len(found.group(1)) >= 8
    if kind == "access":
        return len(token) >= 16
    if kind in ("github", "npm"):
        return checksum62(token[4:-6]) == token[-6:]
    if kind == "jwt":
        head = found.group(1)
        try:
            return "alg" in json.loads(base64.urlsafe_b64decode(head + "=" * (-len(head) % 4)))
        except (ValueError, TypeError):
            return False
    return True


_HEX_DIGIT = bytes(120 if chr(b) in "0123456789abcdef" else 32 for b in range(256))  # x or blank


class Scanner:
    def __init__(self):
        patterns = {"assign": (("password", "passwd", "secret", "token", "apikey", "api_key"), ASSIGN), "access": (("akia",), ACCESS)} | MORE
        self.patterns = {kind: pattern for kind, (_, pattern) in patterns.items()}
        self.automaton = ahocorasick.Automaton()
        for kind, (keywords, _) in patterns.items():
            for k in keywords:
                self.automaton.add_word(k, (kind, len(k)))
        self.automaton.make_automaton()

    def spans(self, text: str | None) -> list[tuple[str, int, int]]:
        if not text:
            return []
        raw = text.encode()
        hits = {}
        for end, (kind, length) in self.automaton.iter(raw.lower().decode()):
            hits.setdefault(kind, []).append(end + 1 - length)
        found = []
        for kind, starts in hits.items():
            past, pattern = 0, self.patterns[kind]
            for start in sorted(starts):
                if start < past:
                    continue
                m = pattern.match(text, start)
                if m is None and kind == "jwt":
                    past = _RUN.match(text, start).end()  # what follows the run is the same for all hits in it
                elif m:
                    past = m.end()
                    if _valid(kind, m):
                        found.append((start, KINDS.index(kind), past))
        if b"x" * 32 in raw.translate(_HEX_DIGIT):
            found += [(m.start(), KINDS.index("hex"), m.end()) for m in HEX.finditer(text)]
        return [(KINDS[k], start, end) for start, k, end in sorted(found)]

    def redact(self, text: str | None) -> str | None:
        """``text`` with every span replaced by its kind; overlapping spans become one, named after the first."""
        kept, at = [], 0
        for kind, start, end in self.spans(text):
            if start >= at:
                kept += [text[at:start], f"[{kind.upper()}]"]
            at = max(at, end)
        return "".join([*kept, text[at:]]) if kept else text


@lru_cache(1)
def _scanner() -> Scanner:
    return Scanner()


_SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
_SPANS_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


@F.arrow_udf(_SPANS)
def _find(texts: pa.Array) -> pa.Array:
    scan = _scanner()
    return pa.array([[dict(zip(("kind", "start", "end"), s)) for s in scan.spans(t.as_py())] for t in texts], _SPANS_ARROW)


@F.arrow_udf(T.StringType())
def _replace(texts: pa.Array) -> pa.Array:
    scan = _scanner()
    return pa.array([scan.redact(t.as_py()) for t in texts], pa.string())


def secret_spans(text: Column) -> Column:
    """The secrets of a text: array of (kind, start, end)."""
    ship(SparkSession.active())
    return _find(text)


def written(spans: Column, kinds: tuple[str, ...] = KINDS) -> Column:
    """``kind:start:end`` of the spans of ``kinds``, comma-joined."""
    wanted = spans if kinds == KINDS else F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(
        F.transform(wanted, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def redact_secrets(docs: DataFrame, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """``docs`` with secrets replaced by their kind in brackets, and ``n_chars``, if there is one, counted anew."""
    ship(docs.sparkSession)
    keep_batches_small(docs.sparkSession)  # whole texts go to Python and come back
    safe, names = clash_free(docs)
    done = safe.withColumn("redacted", _replace(names[text]))
    out = dict.fromkeys(docs.columns)
    for c in out:
        out[c] = F.col(names[c]).alias(c)
    out[text] = F.col("redacted").alias(text)
    if n_chars in out:
        changed = ~F.col("redacted").eqNullSafe(F.col(names[text]))
        kind = docs.schema[n_chars].dataType
        out[n_chars] = F.when(changed, F.length("redacted").cast(kind)).otherwise(F.col(names[n_chars])).alias(n_chars)
    return done.select(*out.values())
