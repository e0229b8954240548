from __future__ import annotations

import numpy as np
import pytest

from freshhaul.llm import url_filter as uf
from freshhaul.llm.queries import URL_RULES


def parts(url):
    """Host and path as the contract words them."""
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    path = rest[cut:]
    end = min([path.find(c) for c in "?#" if c in path], default=len(path))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), path[:end]


def rule(host, path):
    fits = [
        r for r in URL_RULES
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    return max(fits, key=lambda r: len(str(r)), default=None)


URLS = [
    None, "", "no scheme", "http://", "http://COM", "http://com/", "https://www.Example.com/en/1?x#y",
    "http://example.com/en/", "http://example.com/en", "http://a.example.com/en/2", "http://notexample.com/en/2",
    "http://x.net/es/1", "http://x.net/fr/1", "http://x.net/de/1", "http://net?/es/", "ftp://a.org#/x://y",
    "http://www.example.com.net/fr/\n2", "http://ÄB.org/ß", "a://b://c/d",
]


def test_parts_and_rules(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id int, url string").selectExpr(
        "*", "'x' AS host", "'x' AS rule", "'x' AS odds"
    )
    rows = uf.url_verdicts(pages, URL_RULES).collect()
    assert len(rows) == len(URLS)
    for r in rows:
        assert (r.host, r.path) == parts(r.url), r.url
        found = rule(r.host, r.path)
        assert r.rule == (str(found) if found else None), r.url
        if found:
            assert r.verdict == found.verdict
        assert r.verdict in ("allow", "block")
    assert uf.url_verdicts(pages.filter("false"), URL_RULES).count() == 0


@pytest.fixture(scope="module")
def segmenter():
    counts = np.zeros(2 * uf.WORDS, np.int64)
    for word in (*uf.UNWANTED, "en", "html", "news", "world"):
        for slot in uf._slots(word):
            counts[slot] += 50
    return uf.Segmenter(counts, int(counts[: uf.WORDS].sum()))


@pytest.mark.parametrize(
    ("host", "words"),
    [
        ("cheappills.org", ["cheap", "pills", "org"]),
        ("www.freecasinobonus.net", ["www", "free", "casino", "bonus", "net"]),
        ("worldnews24.org", ["world", "news", "0", "org"]),
        ("", []),
    ],
)
def test_names_fall_apart(segmenter, host, words):
    assert segmenter.host(host) == words


def test_names_in_one_piece_are_judged(spark):
    urls = [f"https://site{chr(97 + i % 20)}town.example.org/en/{i}.html" for i in range(200)]
    urls += ["http://best-casino.example.org/x", "http://cheappills.example.org/en/1", "http://porn.example.org/"]
    pages = spark.createDataFrame([(u,) for u in urls], "url string")
    got = {r.url: r.verdict for r in uf.url_verdicts(pages, []).collect()}
    assert all(got[u] == "allow" for u in urls[:200])
    assert all(got[u] == "block" for u in urls[200:])


def test_names_fall_apart_among_many_path_words(spark):
    """600,000 distinct path words: hashed counters of a fixed size take any string for a word."""
    rng = np.random.default_rng(9)
    letters = np.array(list("bdfghjkqvwyz"))
    rows = []
    for i in range(400):
        drawn = rng.choice(letters, (1500, 10))
        rows.append((f"http://site{chr(97 + i % 20)}.example.org/" + "-".join(map("".join, drawn)),))
    named = [f"http://{n}.example.org/" for n in ("freecasinobonus", "cheapviagra", "pornwebcam", "cheappills")]
    pages = spark.createDataFrame(rows + [(u,) for u in named], "url string").repartition(8)
    got = {r.url: r.verdict for r in uf.url_verdicts(pages, []).select("url", "verdict").collect()}
    assert [got[u] for u in named] == ["block"] * 4
    assert all(got[u] == "allow" for u, in rows)


def test_counts_are_exact(spark):
    kinds = spark.createDataFrame([("a", "x y 0", 2), ("b", "x casino", 3), ("b", "", 1)], "host string, words string, n long")
    counts, total = uf.word_counts(kinds)
    got = {r.word: r.n for r in counts.collect()}
    want = dict.fromkeys(uf.UNWANTED, uf.PRIOR) | {"x": 5, "y": 2, "0": 2, "casino": uf.PRIOR + 3}
    assert got == want and total == sum(want.values())
