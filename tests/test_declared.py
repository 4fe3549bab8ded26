"""The declared datasets, registered without a pipeline server and run one by one."""

from __future__ import annotations

from pyspark.pipelines.graph_element_registry import (
    GraphElementRegistry,
    graph_element_registration_context,
)

from solstrand.plans.messages import article_scorer, survey_scorer
from solstrand.sources.messages import file_stream
from solstrand.streaming.declared import declare
from solstrand.streaming.hops import append_to_table
from tests.test_articles import message
from tests.test_streams import SCHEMA, article


class Registry(GraphElementRegistry):
    def __init__(self) -> None:
        self.outputs, self.flows = {}, {}

    def register_output(self, output) -> None:
        self.outputs[output.name] = output

    def register_flow(self, flow) -> None:
        self.flows[flow.target] = flow

    def register_sql(self, sql_text, file_path) -> None:
        raise AssertionError("no SQL is declared")


def test_declared_datasets(spark, tmp_path):
    rows = [message(0, article(1)), message(1, article(1)), message(2, "bad"), message(3, article(2))]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "in"))
    registry = Registry()
    with graph_element_registration_context(registry):
        declare(
            lambda: spark,
            lambda: file_stream(spark, str(tmp_path / "in")),
            article_scorer(),
            survey_scorer,
            prefix="declared_",
            salts=2,
        )
    names = [f"declared_{n}" for n in ("bronze_news", "clean_news", "survey_news", "survey_options_news")]
    assert list(registry.outputs) == list(registry.flows) == names
    bronze = registry.outputs[names[0]]
    assert bronze.partition_cols == ["eh_enqueued_date"] and bronze.comment
    assert registry.outputs[names[1]].cluster_by == ["id"]
    counts = []
    for name in names:
        stream = registry.flows[name].func()
        assert stream.isStreaming
        by = registry.outputs[name].partition_cols or []
        append_to_table(stream, name, str(tmp_path / "c" / name), by).awaitTermination()
        counts.append(spark.table(name).count())
    assert counts == [4, 2, 2, 6]
    for name in names:
        spark.sql(f"DROP TABLE {name}")
