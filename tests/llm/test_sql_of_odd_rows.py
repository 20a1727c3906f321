"""The registered SQL on rows that no given table has."""

import duckdb
import pytest
from conftest import rows

from titlematch.llm.queries import ORACLE_SQL, QUERIES

ACCESS, WEAK = "AKIA" + "Q7" * 8, "aB3/" * 10


def tables():
    own = [(7, "same five words each time", "a")] * 50 + [(None, f"no id {i} here", "b") for i in range(40)] + [(None, None, None), (8, "", None)]
    own += [(1000 + i, f"own id {i % 7} {'w ' * (i % 9)}", "c") for i in range(60)]
    named = [f"aws_secret_access_key={WEAK} {ACCESS} https://h.example/a", f"SecretAccessKey={WEAK}\n{ACCESS}", f"key=={WEAK}== {ACCESS}", f"{ACCESS} pad{WEAK}"]
    return own + [(2000 + i, t, "d") for i, t in enumerate(named)]


@pytest.mark.parametrize("name", ["op1_exact_dedup", "op2_secrets", "op3_source_mix"])
def test_sql_matches(spark, tmp_path, name):
    spark.createDataFrame(tables(), "doc_id long, text string, source string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    res = con.execute(ORACLE_SQL[name])
    columns = [d[0] for d in res.description]
    want = sorted(res.fetchall(), key=lambda t: tuple((x is None, str(x)) for x in t))
    assert rows(QUERIES[name](spark, str(tmp_path)).select(columns)) == want
    if name == "op2_secrets":
        spans = {r[0]: r[columns.index("spans")] for r in want if r[0] and r[0] >= 2000}
        assert ["secret" in spans[i] for i in range(2000, 2004)] == [True, True, True, False] and "endpoint" in spans[2000]
