from trendloom.llm.lines import dedup_lines
from tests.llm.conftest import CLASHES, EDGE, prose

BLANKS = " \t\x0b\x0c\r"


def brute(rows):
    """Kept texts in order of distinct (id, text); ids None first, ties by text hash are not needed here."""
    seen, out = {}, {}
    for doc, text in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        lines = text.split("\n")
        full = [i for i, x in enumerate(lines) if x.strip(BLANKS)]
        gone = set()
        for at in range(len(full) - 2):
            win = tuple(lines[i].strip(BLANKS) for i in full[at : at + 3])
            if seen.setdefault(win, (doc, at)) != (doc, at):
                gone |= set(full[at : at + 3])
        out[doc, text] = ("\n".join(x for i, x in enumerate(lines) if i not in gone), len(full), len(gone))
    return out


def test_matches_brute_force(spark):
    rows = [(i, "\n".join(prose(s % 7, 44).split("\n")[a:] + ["", " a ", "a", "a\t", "a"] * (s % 2))) for i, (s, a) in enumerate([(x * y, x) for x in range(4) for y in range(9)])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    want = brute(rows)
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in dedup_lines(df).collect()}
    assert got == {doc: v for (doc, _), v in want.items()}
    assert any(v[2] for v in got.values())


def test_edges(edge, nothing):
    done = dedup_lines(edge)
    assert [c for c in edge.columns if c != "n_lines"] == done.columns[: len(edge.columns) - 1]
    got = done.collect()
    assert len(got) == len(EDGE)
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, []).append(r)
    assert all(r.n_removed == 0 and r.text == prose(1, 120) for r in by_id[1])  # the first, in both its rows
    assert by_id[2][0].text == "" and by_id[2][0].n_spans == 1
    assert by_id[3][0].text == "" and by_id[3][0].n_lines == 0
    assert by_id[7][0].text == prose(7, 6000)
    assert {r.kept for r in got} == {CLASHES.index("kept")}
    assert dedup_lines(nothing).count() == 0
