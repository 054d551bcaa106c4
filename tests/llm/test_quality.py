from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from churnlens.llm.quality import judge_documents, keep_good, repeated_words

from .conftest import doc, prose


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=25))
def test_repeated_words(w):
    n = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    want = {i + k for i in range(len(w) - 2) if n[tuple(w[i:i + 3])] > 1 for k in range(3)}
    assert repeated_words(w) == len(want)


def test_rules_and_edges(make):
    good = prose(1)
    df = make([doc(1, good), doc(2, None), doc(3, ""), doc(4, "x " * 60), doc(5, good + "\n \n" + good.replace(" ", "\x0b")),
               doc(None, good, None), doc(1, good), doc(7, "é\u3000z " + good)]
              + [doc(10 + i, prose(i)) for i in range(20)])
    got = judge_documents(df).collect()
    assert len(got) == 28
    q = {r.doc_id: r.__q if hasattr(r, "__q") else r["__q"] for r in got}
    assert (q[2].n_words, q[3].n_words, q[4].n_words) == (0, 0, 60)
    assert q[4].n_repeat_words == 60 and q[4].base_failed and q[2].base_failed
    assert q[5].n_repeat_words == 160
    assert q[7].n_words == 81 and q[7].word_chars == q[1].word_chars + 3
    assert {r.doc_id for r in keep_good(df).collect()} == {1, None, 7, *range(10, 30)}
    assert keep_good(df).columns == df.columns


def test_bad_host_takes_its_documents(make):
    rows = [doc(i, "too short", "junk") for i in range(40)] + [doc(100, prose(3), "junk")]
    rows += [doc(200 + i, prose(i), "fine") for i in range(40)] + [doc(300, "short", "tiny")]
    kept = {r.doc_id for r in keep_good(make(rows)).collect()}
    assert 100 not in kept and kept == {200 + i for i in range(40)}


def test_small_host_is_shrunk(make):
    """One failure in a host of two does not condemn the other document."""
    rows = [doc(200 + i, prose(i), f"h{i % 5}") for i in range(60)] + [doc(300, "short", "tiny"), doc(301, prose(99), "tiny")]
    assert 301 in {r.doc_id for r in keep_good(make(rows)).collect()}


def test_clashing_columns_and_empty(make):
    df = make([doc(1, prose(1))]).withColumnRenamed("lang", "failed").withColumnRenamed("n_chars", "n_words")
    assert keep_good(df).columns == df.columns and keep_good(df).count() == 1
    assert keep_good(make([])).collect() == []


def test_rule_and_host_together_decide(make):
    """A document with many signs goes with a host that often fails, and stays with one that never does."""
    signs = prose(5) + " #" * 40
    rows = [doc(i, "short" if i % 4 == 0 else prose(i), "often") for i in range(200)]
    rows += [doc(1000 + i, prose(i), "never") for i in range(800)]
    rows += [doc(3000, signs, "often"), doc(3001, signs, "never"), doc(3002, prose(8) + "\n" + "\n".join(["one line"] * 9), "often")]
    kept = {r.doc_id for r in keep_good(make(rows)).collect()}
    assert 3001 in kept and not {3000, 3002} & kept
    assert kept - {3001} == {r[0] for r in rows if r[1] != "short"} - {3000, 3001, 3002}  # nothing else goes


def test_labelled_documents(spark):
    """On the given labels: what the method rejects beyond base is bad, and no good document goes."""
    from churnlens.llm.quality import op3_quality_rules

    path = "/root/testdata/sf0.01"
    got = op3_quality_rules(spark, path).join(spark.read.parquet(f"{path}/labels.parquet"), "doc_id")
    beyond = got.filter("NOT base_failed AND NOT kept")
    assert beyond.count() > 10 and beyond.filter("quality = 1").count() == 0
    assert got.filter("quality = 1 AND NOT kept AND NOT base_failed").count() == 0


def test_very_long_text(make):
    rows = [doc(1, " ".join(f"w{i}" for i in range(300_000))), doc(2, "again " * 200_000)] + [doc(10 + i, prose(i)) for i in range(20)]
    assert {r.doc_id for r in keep_good(make(rows)).select("doc_id").collect()} == {1, *range(10, 30)}


def test_any_column_name_stays(make):
    names = ["__host", "__rate", "__q", "__kept", "a.b", "row", "text_", "host", "failed", "c0"]
    df = make([doc(1, prose(1)), doc(2, None)]).selectExpr("*", *[f"'{i}' AS `{n}`" for i, n in enumerate(names)])
    out = keep_good(df)
    assert out.columns == df.columns
    assert list(out.first())[5:] == [str(i) for i in range(len(names))] and out.count() == 1
