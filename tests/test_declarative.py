"""The declarative definition file registers every dataset with its
comment and properties (running it needs the pipelines runner)."""

import importlib
import sys

from pyspark.pipelines.graph_element_registry import GraphElementRegistry, graph_element_registration_context
from pyspark.pipelines.output import MaterializedView, StreamingTable

from retailflow.plans.pipeline import DATASETS


class Recorder(GraphElementRegistry):
    def __init__(self):
        self.outputs, self.flows = {}, {}

    def register_output(self, output):
        self.outputs[output.name] = output

    def register_flow(self, flow):
        self.flows[flow.name] = flow

    def register_sql(self, sql_text, file_path):
        raise AssertionError("no SQL expected")


def test_definitions_register_every_dataset():
    rec = Recorder()
    sys.modules.pop("retailflow.plans.declarative", None)
    with graph_element_registration_context(rec):
        importlib.import_module("retailflow.plans.declarative")
    for d in DATASETS:
        out = rec.outputs[d.name]
        assert out.comment == d.comment and dict(out.table_properties) == d.properties
        kind = StreamingTable if d.kind == "stream" else MaterializedView
        assert type(out) is kind, d.name
        assert d.name in rec.flows
    assert {"product_sales", "product_revenue_ranges"} <= set(rec.outputs)
