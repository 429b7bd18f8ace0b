import base64
import json
import random
import re
import time

import pyarrow as pa
from pyspark.sql import functions as F

from vigilog.llm import secret_scans
from vigilog.llm.secret_scans import BASE_KINDS, KINDS, Scanner, checksum62, redact_secrets, secret_spans, written

ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def brute(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(1)) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 32]
    return [(KINDS[k], a, b) for a, k, b in sorted(found)]


def test_base_kinds_as_a_scan_of_the_whole_text():
    rng, scan = random.Random(1), Scanner()
    parts = ["token", "=", ":", "AKIA", "ABCDEFGH12345678", "0123456789abcdef" * 2, " ", "'", '"', "api_key", "APIKEY", "PassWord", "é😀", "x", "secret", "ſecret"]
    for _ in range(20_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(25)))
        assert [s for s in scan.spans(text) if s[0] in BASE_KINDS] == brute(text), text


def test_checksums_decide():
    scan, body = Scanner(), "aB3" * 10
    good = "ghp_" + body + checksum62(body)
    assert scan.spans("é " + good) == [("github", 2, 42)]
    assert scan.spans("é " + good[:-1] + ("0" if good[-1] != "0" else "1")) == []
    head = base64.urlsafe_b64encode(json.dumps({"alg": "none"}).encode()).decode().rstrip("=")
    assert [s[0] for s in scan.spans(f"{head}.{head}.{'s' * 20}")] == ["jwt"]
    assert scan.spans(f"eyJ{'!' * 9}.eyJxxxxxxxxx.{'s' * 20}") == []


def test_spans_of_odd_texts(odd, empty):
    rows = odd.withColumn("found", secret_spans(odd["text"])).withColumn("spans", written(secret_spans(odd["text"]))).collect()
    for r in rows:
        assert [tuple(s) for s in r.found if s["kind"] in BASE_KINDS] == brute(r.text)
        assert r.spans == ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in r.found)
    assert redact_secrets(empty).count() == 0


def test_redaction(odd):
    rows = {(r.doc_id, r.lang): r for r in redact_secrets(odd).collect()}
    assert redact_secrets(odd).columns == odd.columns
    hit = rows[-14, "en"]
    assert hit.text == "[ASSIGN] [ACCESS]" and hit.n_chars == len(hit.text)
    assert rows[1, "en"].text is None and rows[4, "en"].n_chars is None and rows[6, None].n_chars == 3


def keys():
    """(text, lines of the key in it, what redaction leaves) of private keys in the forms that texts hold them."""
    rng = random.Random(2)
    body = base64.b64encode(rng.randbytes(700)).decode()
    lines = [body[k : k + 64] for k in range(0, len(body), 64)]
    for label in ("PRIVATE KEY", "RSA PRIVATE KEY", "OPENSSH PRIVATE KEY", "PGP PRIVATE KEY BLOCK"):
        head, end = f"-----BEGIN {label}-----", f"-----END {label}-----"
        for eol in ("\n", "\r\n", "\\n", "\n    ", "\n> ", '\\n" +\n  "', " "):
            for last in (end, ""):
                yield f"before {head}{eol}{eol.join([*lines, last])}\nclean words after", lines, "before [PRIVATE_KEY]"
        fields = "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,00FF\n\n" if "PGP" not in label else "Version: GnuPG v2\n\n"
        for last in ("\n" + end, ""):
            yield "\n".join([head, fields + lines[0], *lines[1:]]) + last + "\n\nclean words after", lines, "[PRIVATE_KEY]"
        yield f"{head}\n{lines[0]}\n{lines[1][:5]}", [lines[0], lines[1][:5]], "[PRIVATE_KEY]"  # cut off
        yield f"{head}{body}{end} clean words after", [body], "[PRIVATE_KEY] clean words after"
        other = "-----END EC PRIVATE KEY-----"
        yield "\n".join([head, *lines, other, "clean words after"]), lines, f"[PRIVATE_KEY]\n{other}\nclean words after"


def test_no_part_of_a_private_key_survives():
    scan = Scanner()
    for text, lines, left in keys():
        done = scan.redact(text)
        assert not [x for x in lines if x in done] and done.startswith(left), (text, done)
        assert done.endswith("clean words after") == text.endswith("clean words after"), (text, done)
    both = "\n".join(text for text, _, _ in keys())
    assert not [x for _, lines, _ in keys() for x in lines if x in scan.redact(both)]


def test_a_header_in_prose_keeps_the_prose():
    scan = Scanner()
    said = "The line -----BEGIN PRIVATE KEY----- is the header of a key.\nIt is followed by base64 lines."
    assert scan.redact(said) == said.replace("-----BEGIN PRIVATE KEY-----", "[PRIVATE_KEY]")
    public = "-----BEGIN PUBLIC KEY-----\nMIIB\n-----END PUBLIC KEY-----"
    assert scan.redact(public) == public
    many = "-----BEGIN PRIVATE KEY-----\n" * 20_000
    assert scan.redact(many) == "[PRIVATE_KEY]\n" * 20_000


def test_a_run_is_read_once():
    """Keywords packed into one run of a megabyte; hits behind it are still found."""
    head = base64.urlsafe_b64encode(b'{"alg":"none"}').decode().rstrip("=")
    token = f"{head}.{head}.{'s' * 20}"
    scan, text = Scanner(), "eyJ" * 350_000 + " " + token
    started = time.time()
    assert scan.spans(text) == [("jwt", len(text) - len(token), len(text))]
    assert time.time() - started < 5
    for odd in ("eyJeyJeyJeyJ." + token, "eyJab." + token, "eyJ" * 5 + "." + "eyJ" * 5 + "." + "s" * 30, "xeyJ" + token):
        every = [m.span() for m in re.finditer(r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{16,}", odd)]
        assert [s[1:] for s in scan.spans(odd) if s[0] == "jwt"] == [s for s in every if _is_jwt(odd[slice(*s)])]


def _is_jwt(token):
    head = token.split(".")[0]
    try:
        return "alg" in json.loads(base64.urlsafe_b64decode(head + "=" * (-len(head) % 4)))
    except (ValueError, TypeError):
        return False


def test_whole_texts_go_to_python_in_small_batches(spark, monkeypatch):
    """Texts of 40 MB in one task: a batch of rows by number would hold all of them."""
    held = F.arrow_udf(lambda texts: pa.array([str(texts.nbytes)] * len(texts), pa.string()), "string")
    monkeypatch.setattr(secret_scans, "_replace", held)
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(setting)
    try:
        docs = spark.range(400, numPartitions=1).select(F.repeat(F.lit("x"), 100_000).alias("text"))
        most = redact_secrets(docs).agg(F.max(F.col("text").cast("long"))).first()[0]
    finally:
        spark.conf.set(setting, before)
    assert most <= 5_000_000
