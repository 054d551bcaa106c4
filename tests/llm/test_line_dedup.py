from collections import defaultdict

from pyspark.sql import functions as F

from churnlens.llm.line_dedup import apply_bitmap, drop_repeated_lines, with_bitmaps

from .conftest import doc, prose

LINE = "this line is long enough to count"
WHITE = " \t\n\x0b\f\r"


def _key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(WHITE))


def _brute(rows):
    found = defaultdict(set)
    for i, text, *_ in rows:
        for line in (text or "").split("\n"):
            if len(_key(line)) >= 20:
                found[_key(line)].add(-2**63 if i is None else i)
    out = []
    for i, text, *_ in rows:
        d = -2**63 if i is None else i
        lines = (text or "").split("\n")
        keep = [x for x in lines if not (len(found[_key(x)]) >= 3 and d < max(found[_key(x)]))]
        out.append((i, len(lines), len(lines) - len(keep), "\n".join(keep)))
    return sorted(out, key=repr)


ROWS = [doc(1, f"{LINE}\nshort\n {LINE.upper()}\t\n\n"), doc(2, LINE), doc(3, f"x\n{LINE}\nx\n{LINE}"), doc(4, None), doc(5, ""),
        doc(6, "\n\n"), doc(7, "É" + LINE), doc(8, "é" + LINE), doc(9, "É" + LINE), doc(None, f"{LINE}\r\nnull id"), doc(2, LINE), doc(2, f"other\n{LINE}"),
        doc(11, "nineteen chars here"), doc(12, "nineteen chars here"), doc(13, "nineteen chars here"),
        doc(14, "twenty characters 20"), doc(15, "twenty characters 20"), doc(16, "twenty characters 20"),
        doc(17, "\n".join([prose(5)] * 3000)), doc(18, prose(5)), doc(19, prose(5) + "\n" + "y" * 100_000), doc(20, "in two documents only"), doc(21, "in two documents only")]


def _got(df):
    out = with_bitmaps(df)
    return sorted((tuple(r) for r in out.select("doc_id", "__n_lines", "__n_dropped", apply_bitmap(F.coalesce("text", F.lit("")), F.col("__keep"))).collect()), key=repr)


def test_against_brute_force(make):
    assert _got(make(ROWS)) == _brute(ROWS)


def test_hot_line(make):
    rows = [doc(i, f"{LINE}\n{prose(i)}") for i in range(500)]
    assert _got(make(rows).repartition(9)) == _brute(rows)


def test_texts(make):
    df = make(ROWS).withColumnRenamed("lang", "__keeper")
    out = drop_repeated_lines(df)
    assert out.columns == df.columns
    got = {r.doc_id: r.text for r in out.collect() if r.doc_id not in (2, None)}
    assert got[4] is None and got[5] == "" and got[3] == f"x\n{LINE}\nx\n{LINE}" and got[1] == "short\n\n"
    assert drop_repeated_lines(make([])).collect() == []


def test_no_python(make):
    plan = with_bitmaps(make(ROWS))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
