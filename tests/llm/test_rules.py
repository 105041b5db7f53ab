"""Quality rules against SQL and against plain counts."""

import duckdb
import pytest
from tables import documents, odd_rows, prose, rows_of, saved, word_list

from starloom.llm import queries, threshold_rules

COLUMNS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


def more_rows():
    line = prose(9, 12)
    loop = prose(8, 10)
    texts = [
        f"{line}\n{line}\n \n{line} ", f"{loop} " * 5, f"{prose(7, 40)} {loop} x {loop}", "A " * 30, "b " * 9, "b " * 8,
        "\n".join([line, "", "\t", line, line]), "# * $ %& | < > " * 10, "WOW!! " * 30 + prose(6, 30), f"{prose(5, 100)}\r\n",
        " | ".join(prose(11, 50).split()), prose(12, 7), "the of and " * 20,
    ]
    return odd_rows() + [(500 + i, t, "en", "a", None) for i, t in enumerate(texts)]


def plain(row):
    text = row[1] or ""
    words = word_list(text)
    lines = [x for x in text.split("\n") if word_list(x)]
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    counts = {}
    for w in windows:
        counts[w] = counts.get(w, 0) + 1
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(8)}
    n, repeated = len(words), len(covered)
    return (row[0], n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            sum(x in lines[:i] for i, x in enumerate(lines)), repeated, n < 20 or 100 * repeated > 30 * n)


@pytest.mark.parametrize("clash", [False, True])
def test_op9(spark, tmp_path, clash):
    folder = saved(tmp_path, documents=documents(spark, more_rows(), clash))
    got = rows_of(queries.op9_threshold_rules(spark, folder).select(COLUMNS))
    assert [r[:-1] for r in got] == sorted(map(plain, more_rows()), key=repr)
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{folder}/documents.parquet/*.parquet')")
    sql = con.execute(f"select {', '.join(COLUMNS)} from ({threshold_rules.sql()})").fetchall()
    assert got == sorted(sql, key=repr)


def test_keep_good_returns_whole_rows(spark):
    docs = documents(spark, more_rows(), clash=True)
    kept = threshold_rules.keep_good(docs)
    assert kept.columns == docs.columns
    verdicts = {(r.doc_id, r.n_words): r.kept for r in threshold_rules.judged(docs, ["doc_id"]).collect()}
    assert sorted((r.doc_id or 0) for r in kept.collect()) == sorted(
        (r[0] or 0) for r in more_rows() if verdicts[r[0], len(word_list(r[1]))])
    assert threshold_rules.keep_good(documents(spark, [])).count() == 0


def test_projection_runs_no_python_and_no_shuffle(spark):
    plan = threshold_rules.judged(documents(spark), ["doc_id"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
