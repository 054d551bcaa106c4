import re

from hypothesis import given, settings
from hypothesis import strategies as st

from churnlens.llm.url_filter import GLOBS, ShiftAnd, judge_urls

PAGES = "page_id long, url string, host string"


def _regex(glob):
    parts = {"**": ".*", "*": "[^/]*", "?": "[^/]"}
    return re.compile("".join(parts.get(p, re.escape(p)) for p in re.findall(r"\*\*|\*|.", glob)), re.S)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("ab/*?.", max_size=9), min_size=1, max_size=25), st.lists(st.text("ab/.é", max_size=12), max_size=6))
def test_automaton_equals_regular_expressions(globs, urls):
    globs = [g.replace("***", "**") for g in globs]
    hits = ShiftAnd(globs).match(urls)
    for i, u in enumerate(urls):
        assert [bool(_regex(g).fullmatch(u)) for g in globs] == hits[i].tolist()


def test_masks_span_words():
    long = "a" * 150 + "*b"
    hits = ShiftAnd(["x", long, "**b"]).match(["a" * 150 + "zzb", "a" * 149 + "b", "x"])
    assert hits.tolist() == [[False, True, True], [False, False, True], [True, False, False]]


def test_verdicts(make):
    urls = ["http://Sub.Example.NET/en/x?q", "https://example.net/EN/x", "https://notnet/", "https://a.net", "http://net/",
            "x://example.com/de/1", "http://example.com/fr/1", "http://a.org/fr/", "http://m.b.org/en/55", "http://m.b.org/en/555",
            "http://a.com/x.zip", "http://a.com/zip#x.zip", None, "", "a.net/", "http://a/" + "b" * 200_000 + ".exe",
            "http://a.com/z.net/y"]
    df = make([(i, u, "old") for i, u in enumerate(urls)] + [(0, urls[0], "old")], PAGES)
    got = {r.page_id: r for r in judge_urls(df).collect()}
    assert judge_urls(df).count() == len(urls) + 1
    rules = [got[i].rule for i in range(len(urls))]
    assert rules == ["example.net/en/", "net/", None, None, "net/", "example.com/de/", None, "org/fr/",
                     *[None] * 9]
    verdicts = [got[i].verdict for i in range(len(urls))]
    assert verdicts == ["allow", "block", "allow", "allow", "block", "block", "allow", "allow", "allow", "block",
                        "block", "allow", "allow", "allow", "allow", "block", "allow"]
    assert (got[0].host, got[0].path) == ("sub.example.net", "/en/x")
    assert (got[12].host, got[12].path, got[13].host) == ("", "", "")


def test_empty_table(make):
    assert judge_urls(make([], PAGES)).collect() == []
    assert len(GLOBS) == len(set(GLOBS))
