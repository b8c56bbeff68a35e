import duckdb
import pytest

from stockflow.llm.mixing import mix_sources, mixed_documents
from stockflow.llm.queries import OP9_SQL

ROWS = [(i, "w " * (i % 7), f"s{i % 3}" if i % 5 else None) for i in range(60)]
ROWS += [(100, None, "s0"), (101, "", "empty"), (102, "x" * 9 + " y" * 4000, "s1"), (None, "null id", "s2"),
         (7, "same", "s0"), (7, "same", "s0"), (8, " one\x1cword  ", "s0")]


def sql_rows(rows):
    con = duckdb.connect()
    con.execute("create table documents(doc_id bigint, text varchar, source varchar)")
    if rows:
        con.executemany("insert into documents values (?,?,?)", rows)
    return con.sql(OP9_SQL).fetchall()


def key(r):
    return tuple((x is None, x or 0) for x in r)


@pytest.mark.parametrize("rows", [ROWS, [], [(1, None, None)], [(i, "a b c", "one") for i in range(9)]])
def test_mix_is_the_oracle(make_docs, rows):
    got = mix_sources(make_docs(rows)).drop("source", "row").collect()
    assert sorted(map(tuple, got), key=key) == sorted(sql_rows(rows), key=key)


def test_targets_and_budgets(make_docs):
    out = mix_sources(make_docs(ROWS)).collect()
    total = sum(r["size"] for r in out)
    by = {}
    for r in out:
        by.setdefault(r["source"], [r["source_size"], r["target"], 0])[2] += r["taken"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    assert abs(sum(t for _, t, _ in by.values()) - 1.5 * total) < 1e-6
    for size, target, taken in by.values():
        assert target <= 2 * size and taken == int(target)


def test_documents_as_mixed(make_docs):
    docs = make_docs(ROWS)
    mix = mix_sources(docs)
    out = mixed_documents(docs, mix)
    assert out.columns == docs.columns
    words = sum(len((r.text or "").encode().split()) for r in out.collect())
    assert words == sum(r["taken"] for r in mix.collect())
