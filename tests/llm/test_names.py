"""Extra columns of any name come through every table function, and very long texts do."""

import pytest

from churnlens.llm import brown_lm, line_dedup, mixing, personal, pieces, quality, simhash
from churnlens.llm.sharding import shard_by_bytes

from .conftest import doc, prose

#: Names that the functions use inside, or that need quoting.
NAMES = ["__host", "__rate", "__q", "__kept", "__doc", "__text", "__d", "__t", "__dropped", "__keep", "__n_lines", "__source", "__whole",
         "__size", "__key", "__copies", "__rare", "__row", "__hash", "__id", "a.b", "tick`s", "row", "text_", "c0", "fp", "order", "find"]


def lm(docs):
    return brown_lm.score(docs, brown_lm.fit(docs))


FUNCTIONS = {
    "quality": quality.keep_good, "line_dedup": line_dedup.drop_repeated_lines, "simhash": simhash.keep_one_of_each, "mixing": mixing.mix,
    "pieces": pieces.encode_pieces, "personal": personal.find_personal, "brown_lm": lm,
}
SAME = ("quality", "line_dedup", "simhash", "mixing")


@pytest.mark.parametrize("name", FUNCTIONS)
def test_columns_of_any_name(make, name):
    rows = [doc(i, prose(i)) for i in range(12)] + [doc(50, None), doc(None, prose(3))]
    df = make(rows).selectExpr("*", *["'{}' AS `{}`".format(i, n.replace("`", "``")) for i, n in enumerate(NAMES)])
    out = FUNCTIONS[name](df)
    if name in SAME:
        assert out.columns == df.columns
    at = [out.columns.index(n) for n in NAMES]
    got = out.collect()
    assert got and all([r[i] for i in at] == [str(i) for i in range(len(NAMES))] for r in got)
    assert any(r[out.columns.index("doc_id")] == 1 for r in got)


@pytest.mark.parametrize("name", FUNCTIONS)
def test_very_long_texts(make, name):
    long = "\n".join(prose(k, 200) for k in range(600)) + " mail me at long.text@example.com"
    out = FUNCTIONS[name](make([doc(1, long), doc(2, prose(2)), doc(3, "x" * 50_000 + " " + prose(3))])).collect()
    row = {r["doc_id"]: r for r in out}
    assert 1 in row
    if name in SAME:
        assert row[1]["text"] == long
    if name == "personal":
        assert [(s["start"], s["kind"]) for s in row[1]["spans"] if s["base"]] == [(long.index("long.text"), 0)]
    if name == "pieces":
        assert row[1]["exact"] and row[1]["n_tokens"] == len(row[1]["ids"])
    if name == "brown_lm":
        assert row[1]["n_tokens"] == len(long.split()) + 1


def test_sharding_takes_odd_names_and_long_texts(make):
    df = make([doc(1, "y" * 3_000_000), doc(2, "z")]).withColumnsRenamed({"text": "a.b", "doc_id": "key"}).selectExpr("*", "1 AS size", "2 AS row")
    got = {r["doc_id"]: r["size"] for r in shard_by_bytes(df, text="a.b", doc_id="key").collect()}
    assert got == {1: 3_000_001, 2: 2}
