import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from fundscope.llm import line_dedup as ld

UP = str.maketrans(ld.UPPER, ld.LOWER)


def brute(rows, min_docs):
    found = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            found[line.strip(ld.BLANK).translate(UP)].add((i, t or ""))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (k := x.strip(ld.BLANK).translate(UP))
                or len(found[k]) < min_docs]
        out.append((i, len(lines), len(lines) - len(kept),
                    hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def run(df, **kw):
    out = ld.line_dedup(df, **kw)
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, hashlib.sha256(r.t.encode()).hexdigest())
                   for r in out.withColumn("t", ld.kept_text(F.col("text"), F.col("keep_runs")))
                   .collect()), key=str)


def test_matches_brute_force(make_docs):
    rows = [(i, "\n".join(["Shared ONE", f"own {i}", " shared two\t" if i % 2 else "", "É",
                           "end", "Shared one"][: 2 + i % 5])) for i in range(40)]
    for least in (1, 5, 10, 20, 41):
        assert run(make_docs(rows), min_docs=least) == brute(rows, least)


def test_odd_rows(make_docs, odd_rows):
    rows = [(r[0], r[1]) for r in odd_rows]
    assert run(make_docs(odd_rows), min_docs=2) == brute(rows, 2)


def test_empty_table_and_other_columns(make_docs, odd_rows, clashing):
    assert ld.line_dedup(make_docs([])).count() == 0
    out = ld.line_dedup(clashing(make_docs(odd_rows)), min_docs=2)
    assert out.count() == len(odd_rows)
    assert {r.n_lines for r in out.collect()} == {"own n_lines"}
    assert out.columns[-3:] == ["n_lines_", "n_dropped_", "keep_runs_"]


def test_keep_first(make_docs):
    rows = [(i, f"same\nown {i}\nsame") for i in range(3)]
    out = ld.line_dedup(make_docs(rows), min_docs=2, keep_first=True)
    kept = {r.doc_id: r.t for r in out.withColumn(
        "t", ld.kept_text(F.col("text"), F.col("keep_runs"))).collect()}
    assert kept == {0: "same\nown 0", 1: "own 1", 2: "own 2"}


def test_native_plan(make_docs, capsys):
    ld.line_dedup(make_docs([(1, "a")])).explain()
    assert "Python" not in capsys.readouterr().out


def test_rows_of_one_id_with_different_texts_are_documents(make_docs):
    """A document is an id and a text: two ids can share a line ten times, copies of a row cannot."""
    apart = [(i % 2, f"shared\nown {i}") for i in range(10)]
    got = ld.line_dedup(make_docs(apart)).collect()
    assert [r.n_dropped for r in got] == [1] * 10
    copies = [(i % 2, f"shared\nown {i % 2}") for i in range(20)]
    assert [r.n_dropped for r in ld.line_dedup(make_docs(copies)).collect()] == [0] * 20
