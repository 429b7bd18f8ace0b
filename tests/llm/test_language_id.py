import random
import zlib
from collections import Counter

from vigilog.llm.language_id import PROFILE, Profiles, grams, language_id, ranked

from .conftest import SCHEMA


def brute_grams(text):
    words = "".join(c.lower()[0] if c.isalpha() else " " for c in text or "").split()
    found = Counter()
    for w in words:
        padded = f" {w} "
        for n in (1, 2, 3):
            found.update(g for k in range(len(padded) - n + 1) if (g := padded[k : k + n]).strip())
    return found


def as_text(number):
    out = ""
    while number:
        out = chr(number & 0x1FFFFF) + out
        number >>= 21
    return out


def test_grams():
    for text in ["", None, "12 ..", "a", "Ab c", "ß ÜBER x1y", "日本語 テスト", "a-b", " é "]:
        assert Counter(as_text(int(g)) for g in grams(text)) == brute_grams(text)


def test_ranks_and_distance():
    values = grams("the cat and the dog and the bird")
    own = ranked(values)
    count = Counter(values.tolist())
    assert own.tolist() == sorted(count, key=lambda g: (-count[g], g))[:PROFILE]
    model = Profiles({"x": own.tolist(), "y": own[::-1].tolist()})
    assert model.predict("the cat and the dog and the bird") == ("x", 1.0)
    assert model.predict("12 34") == ("und", 0.0) and Profiles({}).predict("abc") == ("und", 0.0)
    lang, score = model.predict("bird dog")
    places = {"x": own.tolist(), "y": own[::-1].tolist()}
    mine = ranked(grams("bird dog")).tolist()
    off = {k: sum(abs(p.index(g) - i) if g in p else PROFILE for i, g in enumerate(mine)) for k, p in places.items()}
    assert lang == min(off, key=lambda k: (off[k], k)) and abs(score - (1 - off[lang] / (PROFILE * len(mine)))) < 1e-12


def test_held_out_accuracy_and_odd_texts(spark, odd, empty):
    rng = random.Random(3)
    syllables = {"en": ["the", "ing", "tion", "sh"], "fr": ["eau", "oi", "que", "é"], "de": ["ung", "sch", "ver", "ü"]}
    rows = [
        (i, " ".join("".join(rng.choice(syllables[lang]) for _ in range(3)) for _ in range(30)), lang, None, None)
        for i, lang in enumerate(list(syllables) * 60)
    ]
    found = {r.doc_id: r for r in language_id(spark.createDataFrame(rows, SCHEMA)).collect()}
    for i, _, lang, *_ in rows:
        assert found[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert found[i].lang_pred == lang and 0 <= found[i].score <= 1
    strange = language_id(odd).collect()
    assert len(strange) == odd.count()
    assert all((r.lang_pred == "und") == (r.doc_id in (1, 2, 3) or r.doc_id is None and r.score == 0) for r in strange)
    assert language_id(empty).count() == 0


def number_of(gram):
    out = 0
    for c in gram:
        out = out << 21 | ord(c)
    return out


def test_whole_table_against_dictionaries(spark):
    """Profiles counted over all training rows, and the prediction and score of every row."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    rows = [tuple(r) for r in docs.collect()] + [(None, "the cat and the dog", None), (10**6, "ü", None), (10**6, None, "xx")]
    counts = {}
    for i, text, lang in rows:
        if lang is not None and (zlib.crc32(str(i).encode()) % 4 if i is not None else 0) != 2:
            counts.setdefault(lang, Counter()).update(brute_grams(text))
    in_order = lambda c: sorted(c, key=lambda g: (-c[g], number_of(g)))[:PROFILE]
    profiles = {lang: {g: k for k, g in enumerate(in_order(c))} for lang, c in counts.items()}
    wanted = Counter()
    for i, text, _ in rows:
        own = in_order(brute_grams(text))
        off = {lang: sum(abs(p[g] - k) if g in p else PROFILE for k, g in enumerate(own)) for lang, p in profiles.items()}
        best = min(off, key=lambda lang: (off[lang], lang))
        out = i is not None and zlib.crc32(str(i).encode()) % 4 == 2
        wanted[(i, out, best, round(1 - off[best] / (PROFILE * len(own)), 9)) if own else (i, out, "und", 0.0)] += 1
    found = language_id(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert Counter((r.doc_id, r.held_out, r.lang_pred, round(r.score, 9)) for r in found) == wanted
