"""Rule sets used by the query catalogue (same shapes as the reference's YAML files).

They exercise the semantics that must not be lost: wildcard field lists, a
repeated rule for one measurement (last wins), a rule without ``tags.remove``,
non-numeric fields dropped by coercion, and one row matching several functions.
"""

ROUTER = {
    "database_filter": [
        {"measurement": "click", "field.name": "value"},
        {"measurement": "purchase"},
    ],
    "onoff_filter": [
        {"measurement": "view", "field.name": "value"},
        {"measurement": "error"},
    ],
    "aggregator_filter": [
        {"measurement": "click", "field.name": "value,k"},
        {"measurement": "purchase", "field.name": "k"},
        {"measurement": "purchase", "field.name": "value"},
    ],
}

AGGREGATOR = {
    "aggregation_config": {"window.s": 3600, "topic.input": "agg-in", "topic.output": "agg-out"},
    "avg_filter": [
        {"measurement": "click", "field.name": "value", "tags.remove": "user"},
        {"measurement": "view", "field.name": "value,k", "tags.remove": "user"},
    ],
    "sum_filter": [
        {"measurement": "click", "field.name": "k", "tags.remove": "user,shard"},
        {"measurement": "purchase", "field.name": "value", "tags.remove": "user"},
    ],
    "min_filter": [
        {"measurement": "error", "field.name": "value"},
        {"measurement": "click", "field.name": "value", "tags.remove": "user"},
    ],
    "max_filter": [
        {"measurement": "purchase", "field.name": "value", "tags.remove": "shard"},
        {"measurement": "signup", "field.name": "value,bad", "tags.remove": "user"},
    ],
}

HEADER_AGGREGATOR = {
    "general": {"appname": "HeaderAggregator", "window": 3600},
    "input": {"bindaddress": "0.0.0.0", "port": 0},
    "output": {"hostname": "localhost", "port": 0},
    "aggr_functs": {
        "default": {"function": "avg", "removetags": ["tag_user"]},
        "avg": [{"metricname": "click", "removetags": ["tag_user", "tag_shard"]}],
        "sum": [{"metricname": "click", "removetags": ["tag_user"]}],
        "max": [{"metricname": "purchase", "removetags": ["tag_user"]}],
        "min": [{"metricname": "purchase", "removetags": []}],
    },
}

HEADER_MINMAX = {
    "general": {"appname": "HeaderAggregator", "window": 3600},
    "input": {},
    "output": {},
    "aggr_functs": {
        "max": [{"metricname": "purchase", "removetags": ["tag_user"]}, {"metricname": "view", "removetags": ["tag_user", "tag_shard"]}],
        "min": [{"metricname": "purchase", "removetags": ["tag_user"]}],
    },
}
