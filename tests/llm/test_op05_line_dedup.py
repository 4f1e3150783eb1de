import duckdb
import pytest

from codefacts.llm import op05_line_dedup as L
from codefacts.sources.tables import table

SCHEMA = "doc_id long, text string, k string, row int, line string, n_dropped double"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "k", 1, "l", .5) for i, t in rows], SCHEMA)


def run(spark, rows, **kw):
    out = L.drop_recurring_lines(frame(spark, rows), **kw)
    assert out.columns == ["doc_id", "k", "row", "line", "text", "n_lines", "n_dropped"]
    return {(r.doc_id, r.k): (r.text, r.n_lines, r.n_dropped) for r in out.collect()}


def oracle(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    return sorted(con.sql(L.ORACLE_SQL).fetchall())


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_tables_match_sql(spark, sf):
    docs = table(spark, f"/root/testdata/{sf}", "documents").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    got = sorted(tuple(r) for r in L.drop_recurring_lines(docs).collect())
    assert sum(r[3] for r in got) > 0
    assert got == oracle(rows)


LINES = [
    "User 17 logged in from 10.0.0.1 today at noon",
    "User 99 logged in from 10.0.0.2 today at noon",
    "alpha beta gamma delta one two three four five six",
    "alpha beta gamma delta one TWO three four five six",
    "alpha beta gamma delta uno dos tres cuatro cinco seis",
    "The. Er.", "a b c d", "", "  spaced\tout   words are the same  ", "spaced out words are the same",
]


def test_small_cases_match_sql(spark):
    rows = [(i, "\n".join(LINES[j] for j in range(len(LINES)) if (i * 7 + j) % 3)) for i in range(12)]
    rows += [(50, "\n".join(LINES)), (51, ""), (52, "unique words that are only in here"), (53, LINES[0])]
    got = sorted((i, *v) for (i, _), v in run(spark, rows).items())
    assert [(a, t, b, c) for a, t, b, c in got] == oracle(rows)
    assert run(spark, rows)[53, "k"] == ("", 1, 1)
    assert run(spark, rows)[52, "k"][0] == "unique words that are only in here"


def test_variable_fields_and_first_document(spark):
    got = run(spark, [(5, LINES[0] + "\nown words of five here"), (9, "x\n" + LINES[1] + "\ny"),
                      (2, LINES[2]), (3, LINES[3]), (4, LINES[4])])
    assert got[5, "k"][0] == LINES[0] + "\nown words of five here"
    assert got[9, "k"] == ("x\ny", 3, 1)
    assert got[2, "k"][0] == LINES[2] and got[3, "k"][0] == "" and got[4, "k"][0] == LINES[4]


def test_nulls_repeats_long_texts_and_empty_table(spark):
    long = "word " * 200_000
    rows = [(None, LINES[0]), (1, None), (2, ""), (7, long), (8, long), (9, LINES[1]), (9, LINES[1]),
            (10, "\n".join([LINES[2]] * 300))]
    got = run(spark, rows)
    assert got[None, "k"][0] == LINES[0] and got[9, "k"][0] == ""
    assert got[1, "k"] == (None, 0, 0) and got[2, "k"] == ("", 1, 0)
    assert got[7, "k"][2] == 0 and got[8, "k"] == ("", 1, 1)
    assert got[10, "k"][2] == 0        # only inside one document
    assert L.drop_recurring_lines(frame(spark, rows)).count() == len(rows)
    assert run(spark, []) == {}


def test_shuffle_path_equals_broadcast_path(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")
    k = docs.selectExpr("doc_id", "xxhash64(text) AS h", "text")
    a = {tuple(r) for r in L.recurring_lines(k).collect()}
    assert a == {tuple(r) for r in L.recurring_lines(k, broadcast_rows=0).collect()}
