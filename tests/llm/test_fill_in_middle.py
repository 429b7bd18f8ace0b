import hashlib
import random
import re

import pytest

from vigilog.llm.fill_in_middle import fill_in_middle, restore, restored, rotate, transform


def plain_version(doc_id, text):
    """Tokens, cuts and output from the definition, by string slices."""
    tokens = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(tokens)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[k : k + 8], 16) for k in (0, 8, 16, 24))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return "plain", n, None, None, text
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(tokens[:low]), "".join(tokens[low:high]), "".join(tokens[high:])
    if h4 % 100 < 20:
        return "spm", n, len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return "psm", n, len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_random_texts_against_slices():
    rng = random.Random(1)
    forms = set()
    for i in range(6000):
        text = "".join(rng.choice("ab <>PSM\nüß日😀.Z\x1c") for _ in range(rng.randrange(40)))
        form, n, prefix, middle, output = plain_version(i, text)
        cut = transform(i, text)
        assert cut == (form, n, prefix, middle, output.encode())
        assert restore(cut.output, form) == text.encode()
        forms.add(form)
    assert forms == {"plain", "psm", "spm"}


@pytest.mark.parametrize("low, cut, high", [(0, 0, 5), (0, 5, 5), (2, 4, 9), (0, 3, 10), (4, 4, 4)])
def test_rotation(low, cut, high):
    buffer = bytearray(b"0123456789")
    rotate(buffer, low, cut, high)
    assert buffer == b"0123456789"[:low] + b"0123456789"[cut:high] + b"0123456789"[low:cut] + b"0123456789"[high:]


def test_a_text_of_megabytes():
    text = "wörd <P " * 400_000
    doc_id = next(i for i in range(100) if plain_version(i, text[:80])[0] == "psm")
    cut = transform(doc_id, text)
    assert cut == tuple(x.encode() if isinstance(x, str) and len(x) > 9 else x for x in plain_version(doc_id, text))
    assert restore(cut.output, cut.form).decode() == text


def test_odd_rows(spark, odd):
    rows = odd.withColumnsRenamed({"lang": "form", "source": "cut"}).withColumn("in_0_doc_id", odd["n_chars"])
    got = fill_in_middle(rows)
    assert got.columns == ["doc_id", "text", "cut", "n_chars", "in_0_doc_id", "form", "n_units", "prefix_chars", "middle_chars", "output"]
    found = got.select("doc_id", "text", "form", "n_units", "prefix_chars", "middle_chars", "output", restored(got["output"], got["form"])).collect()
    assert len(found) == rows.count()
    for doc_id, text, *result, back in found:
        assert tuple(result) == plain_version(doc_id, text or "")
        assert back == (text or "")


def test_empty_table(empty):
    assert fill_in_middle(empty).collect() == []
