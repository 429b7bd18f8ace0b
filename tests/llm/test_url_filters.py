import random
import re
from typing import NamedTuple

from vigilog.llm import common
from vigilog.llm.url_filters import HOST_RULES, PATTERNS, compile_patterns, url_filters


class Pattern(NamedTuple):
    number: int
    verdict: str
    regex: str
    tokens: list[str]


def compile_pattern(number, text):
    """The syntax in plain Python."""
    verdict = "allow" if text.startswith("@@") else "block"
    body = text.removeprefix("@@").lower()
    regex = ""
    if body.startswith("||"):
        regex, body, edge = r"^[a-z][a-z0-9+.-]*://(?:[^/?#]*\.)?", body[2:], True
    elif body.startswith("|"):
        regex, body, edge = "^", body[1:], True
    else:
        edge = False
    ending = body.endswith("|")
    body = body[:-1] if ending else body
    separator = r"(?:[^a-z0-9_.%-]|$)"
    regex += "".join({"*": ".*", "^": separator}.get(c) or re.escape(c) for c in body) + ("$" if ending else "")
    tokens = []
    for m in re.finditer("[a-z0-9]+", body):
        left = edge if m.start() == 0 else body[m.start() - 1] != "*"
        right = ending if m.end() == len(body) else body[m.end()] != "*"
        if left and right:
            tokens.append(m.group())
    return Pattern(number, verdict, regex, sorted(set(tokens)) or [""])


def compiled(spark, patterns):
    rows = compile_patterns(spark.createDataFrame(list(enumerate(patterns)), "number long, pattern string")).collect()
    return {r.pattern: Pattern(r.number, r.verdict, r.regex, sorted(r.tokens)) for r in rows}

URLS = [
    None,
    "",
    "no scheme",
    "http://",
    "HTTP://WWW.Example.ORG/es/1?x=/fr/",
    "https://example.org/en/12",
    "https://a.example.org/en/2#x",
    "https://notexample.org/es/1",
    "http://x.com/fr/1",
    "http://x.com/de/1",
    "http://x.com/DE/1",
    "http://com/de/1",
    "http://a.net?u=http://b.org/",
    "http://www.casino-win.example.com/en/1",
    "http://casino-win.example.com/fr/1",
    "http://mycasino-win.example.net/1",
    "http://a.net/login",
    "http://a.net/login?x",
    "http://a.net/loginpage",
    "http://a.net/buy-VIAGRA-now",
    "http://a.net/setup.exe",
    "http://a.net/setup.exe?x",
    "http://docs.x.example.org/login",
    "http://docs.x.example.org",
    "http://a.net/\nline",
]


def brute(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]+", lambda x: x.group().lower(), m.group(1)), m.group(2)) if m else ("", "")
    fits = [r for r in HOST_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    rule = max(fits, key=lambda r: len(r.text), default=None)
    hits = [c for c in (compile_pattern(i, p) for i, p in enumerate(PATTERNS)) if url is not None and re.search(c.regex, url.lower())]
    hit = min(hits, key=lambda c: (c.verdict, c.number), default=None)
    return host, path, rule and rule.text, hit and PATTERNS[hit.number], rule.verdict if rule else hit.verdict if hit else "allow"


def test_against_all_rules_on_all_urls(spark):
    pages = spark.createDataFrame([(i if i % 7 else None, u, "x") for i, u in enumerate(URLS * 3)], "page_id long, url string, verdict string")
    rows = url_filters(pages).collect()
    assert len(rows) == len(URLS) * 3
    for r in rows:
        assert (r.host, r.path, r.rule, r.pattern, r.verdict) == brute(r.url), r.url
    assert {r.verdict for r in rows} == {"allow", "block"} and len({r.pattern for r in rows}) > 5


def test_compiled_patterns(spark):
    """Verdict and tokens as in the plain version, and expressions that fit the same URLs."""
    rng = random.Random(5)
    pieces = ["ads", "track", "x1", "/", ".", "-", "^", "*", "?", "=", "&", "|", "||", "@@", "+", "(", "[", "{", "$", "\\", "#", "_", "%", " ", "é", "'", '"']
    patterns = sorted({"".join(rng.choice(pieces) for _ in range(rng.randrange(1, 7))) for _ in range(300)} | set(PATTERNS))
    found = compiled(spark, patterns)
    for p in patterns:
        plain = compile_pattern(0, p)
        assert (found[p].verdict, found[p].tokens) == (plain.verdict, plain.tokens), p
        for url in [u.lower() for u in URLS if u] + [p.lower().strip("|@"), "http://ads.track/" + p.lower()]:
            assert bool(re.search(found[p].regex, url)) == bool(re.search(plain.regex, url)), (p, url)
    assert found["||ads-track."].tokens == ["ads", "track"] and found["*viagra*"].tokens == [""] and found["/login^"].tokens == ["login"]


def test_ten_thousand_rules(spark, monkeypatch):
    """Each URL meets few rules, and the verdicts are those of all rules on all URLs; also without broadcasts."""
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    rules = [f"||{word()}-{word()}." for _ in range(4000)] + [f"/{word()}/{word()}^" for _ in range(3000)] + [f"@@||{word()}.com^" for _ in range(1500)]
    rules += [f"?{word()}=*&{word()}|" for _ in range(1500)]
    assert len(rules) == 10_000
    urls = [f"http://www.{word()}.com/{word()}/{word()}?q={word()}" for _ in range(60)]
    for r in rng.sample(rules, 60):
        body = r.removeprefix("@@").strip("|").replace("^", "/").replace("*", "1")
        urls.append(f"http://{body}net/" if r.startswith("||") else f"http://{body}" if r.startswith("@@") else f"http://h.net{body}")
    plain = [(r, compile_pattern(i, r)) for i, r in enumerate(rules)]
    hits = {u: min(((c.verdict, c.number, r) for r, c in plain if re.search(c.regex, u)), default=None) for u in urls}
    table = spark.createDataFrame(list(enumerate(rules)), "number long, pattern string")
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    for most in (common.LIGHT_ROWS, -1):
        monkeypatch.setattr(common, "LIGHT_ROWS", most)
        rows = url_filters(pages, (), table).collect()
        assert {r.url: (r.verdict, r.pattern) for r in rows} == {u: (h[0], h[2]) if h else ("allow", None) for u, h in hits.items()}
    assert sum(h is not None for h in hits.values()) >= 60


def test_no_rules_and_no_pages(spark):
    pages = spark.createDataFrame([(1, "http://casino-win.com/")], "page_id long, url string")
    assert url_filters(pages, (), ()).first().verdict == "allow"
    assert url_filters(pages.where("false")).count() == 0


def test_runs_without_python(spark):
    pages = spark.range(3).selectExpr("id AS page_id", "concat('http://casino.example.net/', id) AS url")
    plan = url_filters(pages)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
