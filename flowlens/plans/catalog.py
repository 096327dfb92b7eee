"""All registered queries."""

from __future__ import annotations

from flowlens.plans import alert_queries, detection_queries, flow_queries, metric_queries, store_queries, stream_queries
from flowlens.plans.registry import Registry

REGISTRY = Registry()
for _module in (flow_queries, metric_queries, alert_queries, store_queries, stream_queries, detection_queries):
    for _name, _query in _module.REG.queries.items():
        if _name in REGISTRY.queries:
            raise ValueError(f"query {_name} registered twice")
        REGISTRY.add(_name, _module.REG.sql.get(_name))(_query)
