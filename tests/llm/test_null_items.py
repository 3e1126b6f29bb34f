"""Benchmark rows without an id are searched like the others."""

import pytest
from compare import check

from chamberlens.llm.decontaminate import find_contamination
from chamberlens.llm.oracles import LLM_ORACLES
from chamberlens.llm.queries import LLM_QUERIES

ITEM = "one two three four five six seven eight nine ten eleven"
BENCH = [(None, "alpha beta"), (None, "gamma delta"), (4, ITEM), (None, ITEM), (5, None), (None, "!!"), (None, None)]
DOCS = [(1, "x alpha beta y"), (2, ITEM), (3, "alpha beta gamma delta"), (4, "beta alpha"), (5, None)]


@pytest.mark.parametrize("block_bytes", [1, 1 << 20])
def test_items_without_id_hit(spark, docs_of, by_id, block_bytes):
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    got = by_id(find_contamination(docs_of(DOCS), bench, block_bytes=block_bytes))
    assert {i: (r["n_hit"], list(r["items"])) for i, r in got.items()} == {1: (2, [None]), 2: (11, [4, None]), 3: (4, [None]), 4: (0, []), 5: (0, [])}


def test_query_matches_sql(spark, docs_of, tmp_path):
    docs_of(DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(BENCH, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert check(spark, str(tmp_path), LLM_QUERIES["op2_decontamination"], LLM_ORACLES["op2_decontamination"]) is None
