"""The rule file and its compiled form."""

from __future__ import annotations

import os
import warnings
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigilog.functions.predicates import rule_condition
from vigilog.schema import RULES_FILE

DEFAULT_RULES = str(Path(__file__).resolve().parent.parent / "data" / "default_rules.json")

# What a rate condition means when a part of it is missing.
DEFAULT_THRESHOLD = 5
DEFAULT_WINDOW_SECONDS = 60


@dataclass(frozen=True)
class Rule:
    """One detection rule; ``conditions`` holds only the keys the rule sets."""

    name: str
    severity: str | None = None
    conditions: dict | None = None
    rule_id: int | None = None
    mitre_id: str | None = None
    mitre_tactic: str | None = None

    @property
    def rate(self) -> tuple[int, int] | None:
        """``(threshold, window_seconds)`` of a rate rule."""
        rate = (self.conditions or {}).get("rate")
        if rate is None:
            return None
        threshold, window = rate.get("threshold"), rate.get("window_seconds")
        return (
            DEFAULT_THRESHOLD if threshold is None else threshold,
            DEFAULT_WINDOW_SECONDS if window is None else window,
        )

    @property
    def source(self) -> str | None:
        """The only source the rule looks at, if it names one."""
        return (self.conditions or {}).get("source")

    @property
    def condition(self) -> str:
        """Everything the rule asks of a single event, as SQL; the rate is not part of it."""
        return rule_condition(self.conditions or {})

    @property
    def condition_in_source(self) -> str:
        """The same for events known to be of the rule's source."""
        return rule_condition({k: v for k, v in (self.conditions or {}).items() if k != "source"})


def rules_path(env: Mapping[str, str] = os.environ) -> str:
    """The rule file that ``RULES_PATH`` names, else the default rules."""
    return env.get("RULES_PATH") or DEFAULT_RULES


def load_rules(spark: SparkSession, path: str | None = None) -> DataFrame:
    """One row per rule with its position; a missing or malformed file gives no rows.

    Without a path the setting ``RULES_PATH`` names the file, else the default rules are read.

    A rule that does not fit the layout is left out with a warning; the others hold.
    """
    path = path or rules_path()
    reader = spark.read.schema("rules ARRAY<STRING>").option("multiLine", True).option("mode", "DROPMALFORMED")
    try:
        content = reader.json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        content = spark.createDataFrame([], "rules ARRAY<STRING>")
    layout = RULES_FILE["rules"].dataType.elementType
    checked = T.StructType([*layout.fields, T.StructField("_bad", T.StringType())])
    parsed = F.from_json("text", checked, {"columnNameOfCorruptRecord": "_bad"})
    rules = content.select(F.posexplode("rules").alias("rule_ord", "text")).select("rule_ord", parsed.alias("rule"))
    bad = [r.rule_ord for r in rules.where("rule._bad IS NOT NULL").select("rule_ord").collect()]  # a rule file has tens of rows
    if bad:
        warnings.warn(f"{path}: rules at positions {sorted(bad)} do not fit the layout and are left out", stacklevel=2)
    return rules.where("rule._bad IS NULL").select("rule_ord", *[f"rule.{f.name}" for f in layout.fields])


def rules_from(rules: DataFrame) -> list[Rule]:
    """The rules as objects, in order. A rule file is configuration: tens of rows."""
    rows = rules.orderBy("rule_ord").collect()
    names = [row.name for row in rows]
    repeated = sorted({n for n in names if names.count(n) > 1})
    if repeated:
        raise ValueError(f"rule names must be unique: {', '.join(map(str, repeated))}")
    return [
        Rule(
            row.name,
            row.severity,
            _set_keys(row.conditions.asDict(recursive=True)) if row.conditions else {},
            row.rule_id,
            row.mitre_id,
            row.mitre_tactic,
        )
        for row in rows
    ]


def rule_versions(spark: SparkSession, paths: Mapping[datetime | None, str | None]) -> list[tuple[datetime | None, list[Rule]]]:
    """Rules by the time from which they hold, in order of it; None is the beginning. A handful of files."""
    times = sorted(paths, key=lambda t: (t is not None, t or datetime.min))
    return [(t, rules_from(load_rules(spark, paths[t]))) for t in times]


def _set_keys(conditions: dict) -> dict:
    return {k: v for k, v in conditions.items() if v is not None}
