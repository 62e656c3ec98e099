"""Row-level quality rules (Q1-Q3): ``EXPECT (cond) ON VIOLATION ...``.

A rule is a boolean SQL expression plus an action:

* ``drop`` - keep only rows where the condition is true (NULL counts as a
  violation);
* ``fail`` - raise as soon as a violating row is seen, which fails the
  batch or the streaming query. It is written as a filter whose condition
  calls ``raise_error``; as a plain extra column Catalyst would prune it
  and nothing would ever fail;
* ``warn`` - keep the row, only count it.

Violation counts are attached with ``observe``: for a batch pass an
:class:`pyspark.sql.Observation`, for a stream a name (the counts show up
in ``StreamingQuery.lastProgress['observedMetrics']``). Counting is part of
the same scan, no extra job. Streaming tables also keep the counts of every
batch as a table and the dropped rows in quarantine (``streaming.runner``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

ACTIONS = ("drop", "fail", "warn")


@dataclass(frozen=True)
class Expectation:
    name: str
    condition: str  # SQL boolean expression
    action: str = "warn"

    def __post_init__(self):
        if self.action not in ACTIONS:
            raise ValueError(f"action must be one of {ACTIONS}, got {self.action!r}")

    def holds(self) -> Column:
        return F.coalesce(F.expr(self.condition), F.lit(False))


Rules = tuple[Expectation, ...] | list[Expectation]


def metrics(expectations: Rules) -> list[Column]:
    """Violations of each rule and rows seen, as aggregates to observe."""
    counts = [F.count(F.when(~e.holds(), F.lit(1))).alias(f"violations_{e.name}") for e in expectations]
    return [*counts, F.count(F.lit(1)).alias("rows_seen")]


def kept(expectations: Rules) -> Column:
    """True where no ``drop`` rule is violated."""
    holds = F.lit(True)
    for e in expectations:
        if e.action == "drop":
            holds = holds & e.holds()
    return holds


def failing(df: DataFrame, expectations: Rules) -> DataFrame:
    """``df``, whose run fails at a row that violates a ``fail`` rule."""
    for e in expectations:
        if e.action == "fail":
            message = F.lit(f"expectation {e.name} violated: {e.condition}")
            df = df.filter(F.when(e.holds(), F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))
    return df


def violated(expectations: Rules) -> Column:
    """The names of the rules that a row violates."""
    return F.array_compact(F.array(*(F.when(~e.holds(), F.lit(e.name)) for e in expectations)))


def apply_expectations(
    df: DataFrame, expectations: Rules, observation: Observation | str | None = None
) -> DataFrame:
    """Rules in the order given: a row that one drops is not seen by the next."""
    if not expectations:
        return df
    if observation is not None:
        df = df.observe(observation, *metrics(expectations))
    for e in expectations:
        df = df.filter(e.holds()) if e.action == "drop" else failing(df, [e])
    return df


# The rules written (commented out) next to the JSON orders
# pipeline, kept here so they can be switched on.
VALID_ORDER_ID_DROP = Expectation("valid_order_id", "order_id IS NOT NULL", "drop")
VALID_TIMESTAMP_DROP = Expectation("valid_timestamp", "order_timestamp > '2021-12-25'", "drop")
VALID_ORDER_ID_FAIL = Expectation("valid_order_id", "order_id IS NOT NULL", "fail")
