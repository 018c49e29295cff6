"""The native operator stays native, and columns are pruned at the scan."""

import re

from tidewell.llm import linededup
from tidewell.sources.tables import read_table


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_line_dedup_is_native(spark, sf):
    text = plan(linededup.dedup_lines(read_table(spark, sf, "documents").select("doc_id", "text")))
    assert not re.search(r"Python|Pandas|MapInArrow|ExistingRDD", text)
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", text)
    assert all("lang" not in s for s in re.findall(r"ReadSchema: struct<([^>]*)>", text))
