"""The structure score counts sections, opened by marked headings or lines in capitals, and marked headings."""

import duckdb
import pytest

from quillmill.operators import structure
from quillmill.plans import queries


def test_capitals_count_as_sections(spark):
    df = spark.createDataFrame([(0, "GENERAL TERMS\nbody\nFINAL CLAUSES\nbody\nSCHEDULE ONE\nx"), (1, "# A\nx\n## B\nLAST CLAUSES"), (2, "plain"), (3, ""), (4, None)], "doc_id int, text string")
    got = structure.structure_score(df).orderBy("doc_id").select("n_sections", "n_headings", "structure_score").collect()
    assert [(r[0], r[1], r[2] if r[2] is None else round(r[2], 6)) for r in got] == [(3, 0, 0.7), (3, 2, 0.9), (0, 0, 0.0), (0, 0, 0.0), (None, None, None)]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_sql(spark, sf):
    got = sorted(map(tuple, queries.QUERIES["structure_scores"](spark, f"/root/testdata/{sf}").collect()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('/root/testdata/{sf}/documents.parquet')")
    assert got == sorted(con.execute(queries.ORACLES["structure_scores"]).fetchall())
    assert any(score for _, _, score in got)
