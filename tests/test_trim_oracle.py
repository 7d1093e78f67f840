"""Trims with binding caps on a many-partition table, ranks included, against
the DuckDB oracle (regression test for the distributed ranking)."""

import duckdb
from pyspark.sql import functions as F

from charloom.plans import oracle as O
from charloom.plans import queries as Q
from charloom.plans.model import CharModel, ModelParams
from conftest import SF_MID


def test_order7_trims_match_duckdb(spark):
    p = ModelParams(ngram_order=7, max_chars_per_context=12, min_context_count=3, max_contexts=60_000)
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_MID}/{t}.parquet')")
    ctes = Q._head(7) + Q._cfg_ctes(p, "m") + [O.trim_ctes("m_trim", "r", 4, 20_000, 12, ranked=True)]
    first = set(con.sql(O.with_(*ctes, select="SELECT context, ch, cnt, ctx_rank, char_rank FROM m_trim")).fetchall())
    second = set(con.sql(O.with_(*ctes, select="SELECT context, ch, cnt, ctx_rank, char_rank FROM r")).fetchall())
    model = CharModel.fit(Q._corpus(spark, SF_MID), p)
    cols = ["context", "ch", "cnt", "ctx_rank", F.col("char_rank").cast("long")]
    assert set(map(tuple, model.context_chars.select(*cols).collect())) == first
    assert set(map(tuple, model.retrim(4, 20_000).context_chars.select(*cols).collect())) == second
