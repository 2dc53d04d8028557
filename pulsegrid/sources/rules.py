"""Rule loading (S9-S11): YAML/dict config -> small rule lists -> DataFrames.

Rules are configuration, compiled on the driver with the reference's map
semantics (a repeated rule for one key replaces the earlier one). Their row
count is known here, which is the size bound that lets joins broadcast them.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Config keys of the reference's YAML files.
MEASUREMENT_KEY = "measurement"
FIELDNAME_KEY = "field.name"
TAGSREMOVE_KEY = "tags.remove"
ROUTER_BRANCHES = ("database", "onoff", "aggregator")
AGG_FUNCTIONS = ("avg", "sum", "min", "max")
DEFAULT_KEY = "default"
HEADER_SECTIONS = ("general", "input", "output")

# Above this many bytes a rule table is joined with a shuffle instead of broadcast.
MAX_BROADCAST_BYTES = 64 << 20


def load_config(cfg) -> dict:
    """A dict as is, else YAML text or a YAML file path."""
    if isinstance(cfg, dict):
        return cfg
    import yaml

    if isinstance(cfg, str) and os.path.exists(cfg):
        with open(cfg, encoding="utf-8") as fh:
            return yaml.safe_load(fh) or {}
    return yaml.safe_load(cfg) or {}


@dataclass(frozen=True)
class RuleTable:
    """Rule rows plus their count; ``df(spark)`` builds the (broadcastable) DataFrame."""

    rows: tuple
    schema: T.StructType

    def __len__(self) -> int:
        return len(self.rows)

    def df(self, spark: SparkSession) -> DataFrame:
        d = spark.createDataFrame(list(self.rows), self.schema)
        return F.broadcast(d) if self.size_bytes <= MAX_BROADCAST_BYTES else d

    def measurements(self, spark: SparkSession) -> DataFrame:
        """The distinct measurements that have a rule, broadcast like the rules."""
        place = self.schema.names.index(MEASUREMENT_KEY)
        rows = tuple((m,) for m in sorted({r[place] for r in self.rows}))
        return RuleTable(rows, T.StructType([self.schema[place]])).df(spark)

    @property
    def size_bytes(self) -> int:
        """Bytes of all rule texts and tag lists, with 16 a value for Spark's row format."""
        def size(v) -> int:
            return 16 + (sum(map(size, v)) if isinstance(v, (list, tuple)) else len(str(v or "").encode("utf-8")))

        return sum(size(r) for r in self.rows)


ROUTER_SCHEMA = T.StructType(
    [
        T.StructField("branch", T.StringType(), False),
        T.StructField("measurement", T.StringType(), False),
        T.StructField("rule_field", T.StringType(), True),
    ]
)


def _filter_section(entries, require_field: bool, section: str) -> list[dict]:
    out = []
    for e in entries or []:
        if not isinstance(e, dict) or MEASUREMENT_KEY not in e:
            raise ValueError(f"{section}: rule without '{MEASUREMENT_KEY}': {e!r}")
        if require_field and FIELDNAME_KEY not in e:
            raise ValueError(f"{section}: rule without '{FIELDNAME_KEY}': {e!r}")
        out.append(e)
    return out


def router_rules(cfg) -> RuleTable:
    """``<branch>_filter`` lists of ``{measurement, field.name?}``.

    Per branch, measurement -> set of fields, or all fields when ``field.name``
    is absent; the last rule for a measurement wins.
    """
    cfg = load_config(cfg)
    rows = []
    for branch in ROUTER_BRANCHES:
        compiled: dict[str, set | None] = {}
        for e in _filter_section(cfg.get(f"{branch}_filter"), False, f"{branch}_filter"):
            fields = e.get(FIELDNAME_KEY)
            compiled[str(e[MEASUREMENT_KEY])] = None if fields is None else set(str(fields).split(","))
        for meas, fields in compiled.items():
            if fields is None:
                rows.append((branch, meas, None))
            else:
                rows.extend((branch, meas, f) for f in sorted(fields))
    return RuleTable(tuple(rows), ROUTER_SCHEMA)


AGG_SCHEMA = T.StructType(
    [
        T.StructField("fn", T.StringType(), False),
        T.StructField("measurement", T.StringType(), False),
        T.StructField("field", T.StringType(), False),
        T.StructField("remove_tags", T.ArrayType(T.StringType()), False),
    ]
)


def agg_rules(cfg) -> RuleTable:
    """``avg_/sum_/min_/max_filter`` lists of ``{measurement, field.name, tags.remove?}``.

    ``field.name`` is a comma list; the key ``meas#field`` maps to its tags to
    remove, the last rule for a key wins.
    """
    cfg = load_config(cfg)
    rows = []
    for fn in AGG_FUNCTIONS:
        compiled: dict[tuple[str, str], list[str]] = {}
        for e in _filter_section(cfg.get(f"{fn}_filter"), True, f"{fn}_filter"):
            remove = e.get(TAGSREMOVE_KEY, "")
            names = [] if remove is None else str(remove).split(",")
            meas = str(e[MEASUREMENT_KEY])
            for f in str(e[FIELDNAME_KEY]).split(","):
                key = f"{meas}#{f}".strip()
                m, fld = key.split("#", 1)
                compiled[(m, fld)] = sorted(set(names))
        rows.extend((fn, m, f, r) for (m, f), r in compiled.items())
    return RuleTable(tuple(rows), AGG_SCHEMA)


def agg_window_seconds(cfg) -> int:
    cfg = load_config(cfg)
    return int(cfg["aggregation_config"]["window.s"])


METRIC_SCHEMA = T.StructType(
    [
        T.StructField("metric", T.StringType(), False),
        T.StructField("fn", T.StringType(), False),
        T.StructField("remove_tags", T.ArrayType(T.StringType()), False),
    ]
)


def metric_rules(cfg, require_sections: bool = True) -> tuple[RuleTable, RuleTable]:
    """Header-flavour rules -> (per-metric rules, default rule).

    ``aggr_functs`` maps a function to ``[{metricname, removetags}]``; the
    optional ``default`` entry ``{function, removetags}`` applies to metrics
    without any rule. ``general``, ``input`` and ``output`` are mandatory.
    """
    cfg = load_config(cfg)
    if require_sections:
        for s in HEADER_SECTIONS:
            if s not in cfg:
                raise ValueError(f"missing section '{s}'")
    compiled: dict[tuple[str, str], list[str]] = {}
    default_rows: list = []
    functs = cfg.get("aggr_functs") or {}
    for fn, entries in functs.items():
        if fn == DEFAULT_KEY:
            continue
        if fn not in AGG_FUNCTIONS:
            raise ValueError(f"aggr_functs: unknown function {fn!r}")
        for e in entries or []:
            if "metricname" not in e:
                raise ValueError(f"aggr_functs.{fn}: entry without metricname: {e!r}")
            compiled[(str(e["metricname"]), str(fn))] = [str(t) for t in (e.get("removetags") or [])]
    if DEFAULT_KEY in functs:
        d = functs[DEFAULT_KEY] or {}
        if "function" not in d:
            raise ValueError("aggr_functs.default without function")
        if str(d["function"]) not in AGG_FUNCTIONS:
            raise ValueError(f"aggr_functs.default: unknown function {d['function']!r}")
        default_rows.append((DEFAULT_KEY, str(d["function"]), [str(t) for t in (d.get("removetags") or [])]))
    rows = tuple((m, f, r) for (m, f), r in compiled.items())
    return RuleTable(rows, METRIC_SCHEMA), RuleTable(tuple(default_rows), METRIC_SCHEMA)


def header_window_seconds(cfg) -> int:
    cfg = load_config(cfg)
    return int((cfg.get("general") or {}).get("window", 30))
