"""Data tests as table operators.

A check is a DataFrame of *failing rows*.  The suite (``run_checks``) turns
each check into a failure count with one row per check: row-level checks of
the same table are fused into a single aggregate pass (``count_if`` per
condition), so a suite over a 100 TB table scans it once, not once per check.
NULL passes range, regex and between checks (only ``not_null`` fails NULLs).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tierflow.functions.scalar import as_of, safe_date, safe_decimal, safe_int
from tierflow.operators.joins import orphans


# --- failing-row checks ---------------------------------------------------------------

def not_null(df: DataFrame, column: str) -> DataFrame:
    """H1: rows where ``column`` is NULL."""
    return df.filter(F.col(column).isNull())


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """H2 / E5: key groups with more than one row, with their row count.

    Partial aggregation runs before the shuffle, so a hot key costs one
    partial count per map task.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
              .filter(F.col("n_rows") > 1))


def below_min(df: DataFrame, column: str, min_value, inclusive: bool = True) -> DataFrame:
    """H4: rows outside ``[min, +inf)`` (or ``(min, +inf)``)."""
    return df.filter(_below_min_cond(column, min_value, inclusive))


def not_matching(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """H5: rows whose value does not match ``pattern``."""
    return df.filter(_regex_fail_cond(column, pattern))


def not_between(df: DataFrame, column: str, low: Column, high: Column) -> DataFrame:
    """H6: rows outside ``[low, high]`` (bounds may be expressions)."""
    return df.filter(_between_fail_cond(column, low, high))


def row_count_between(df: DataFrame, min_rows: int | None = None, max_rows: int | None = None) -> DataFrame:
    """One row (row_count, passed)."""
    n = F.count(F.lit(1))
    ok = F.lit(True)
    if min_rows is not None:
        ok = ok & (n >= min_rows)
    if max_rows is not None:
        ok = ok & (n <= max_rows)
    return df.agg(n.alias("row_count"), ok.alias("passed"))


def _below_min_cond(column, min_value, inclusive=True) -> Column:
    c = F.col(column)
    return ~(c >= F.lit(min_value)) if inclusive else ~(c > F.lit(min_value))


def _regex_fail_cond(column, pattern) -> Column:
    return ~F.col(column).rlike(pattern)


def _between_fail_cond(column, low, high) -> Column:
    return ~F.col(column).between(low, high)


# --- the suite -------------------------------------------------------------------------------

@dataclass(eq=False)
class Check:
    """One data test. ``kind`` in not_null / unique / relationships / min / regex / between / row_count."""
    name: str
    model: str
    kind: str
    column: str | None = None
    severity: str = "error"
    args: dict = field(default_factory=dict)


_ROW_LEVEL = {
    "not_null": lambda c: F.col(c.column).isNull(),
    "min": lambda c: _below_min_cond(c.column, c.args["min_value"], c.args.get("inclusive", True)),
    "regex": lambda c: _regex_fail_cond(c.column, c.args["pattern"]),
    "between": lambda c: _between_fail_cond(c.column, c.args["low"], c.args["high"]),
}


def _failing_rows(checks: list[Check]) -> list[Column]:
    return [F.count_if(F.coalesce(_ROW_LEVEL[c.kind](c), F.lit(False))).alias(f"c{i}") for i, c in enumerate(checks)]


class WriteChecks:
    """The row checks and row counts of a suite, counted while its models are written.

    ``on`` hands back the frame to write; the write itself counts, so these checks read
    no table.  Write it once and by a plain write, without a shuffle of the
    writer's own: Spark then adds up each task once, also when tasks are repeated.
    Ask for ``counted`` after the write.  Set checks (unique, relationships) need the
    written rows and stay with ``run_checks``.
    """

    def __init__(self, checks: list[Check]):
        self.checks = checks
        self._seen: dict[str, tuple[Observation, list[Check]]] = {}

    def on(self, model: str, df: DataFrame) -> DataFrame:
        mine = [c for c in self.checks if c.model == model and c.kind in _ROW_LEVEL]
        seen = Observation()
        self._seen[model] = (seen, mine)
        return df.observe(seen, F.count(F.lit(1)).alias("n"), *_failing_rows(mine))

    def counted(self) -> list[tuple[Check, int]]:
        """Each check that a write has answered, with its failures."""
        out = []
        for model, (seen, mine) in self._seen.items():
            got = seen.get
            out += [(c, got[f"c{i}"]) for i, c in enumerate(mine)]
            for c in self.checks:
                if c.model == model and c.kind == "row_count":
                    low, high = c.args.get("min_rows"), c.args.get("max_rows")
                    ok = (low is None or got["n"] >= low) and (high is None or got["n"] <= high)
                    out.append((c, 0 if ok else 1))
        return out


def run_checks(models: dict[str, DataFrame], checks: list[Check], written: WriteChecks | None = None) -> DataFrame:
    """H8: one row per check (check_name, model, severity, failures, status).

    Checks that ``written`` counted during the writes take their figures from
    there.  Other row-level checks are fused per model into one ``agg`` of
    ``count_if`` expressions; set-level checks (unique, relationships, row count)
    each reduce to one row.  The result is the union of these one-row aggregates,
    so its size is the number of checks, never the data.  No checks give no rows.
    """
    session = next(iter(models.values())).sparkSession
    columns = "check_name string, model string, severity string, failures bigint"
    if not checks:
        return session.createDataFrame([], f"{columns}, status string")
    known = [] if written is None else [(c, n) for c, n in written.counted() if c in checks]
    checks = [c for c in checks if c not in [k for k, _ in known]]
    parts: list[DataFrame] = []
    if known:
        parts.append(session.createDataFrame([(c.name, c.model, c.severity, n) for c, n in known], columns))
    by_model: dict[str, list[Check]] = {}
    for c in checks:
        if c.kind in _ROW_LEVEL:
            by_model.setdefault(c.model, []).append(c)
    for model, cs in by_model.items():
        one = models[model].agg(*_failing_rows(cs))
        stack = ", ".join(f"'{c.name}', '{c.model}', '{c.severity}', c{i}" for i, c in enumerate(cs))
        parts.append(one.selectExpr(
            f"stack({len(cs)}, {stack}) as (check_name, model, severity, failures)"))
    for c in checks:
        if c.kind == "unique":
            n = duplicate_keys(models[c.model], c.column).agg(F.count(F.lit(1)).alias("failures"))
        elif c.kind == "relationships":
            parent_model, parent_col = c.args["to"], c.args.get("field", c.column)
            n = orphans(models[c.model], models[parent_model], c.column, parent_col) \
                .agg(F.count(F.lit(1)).alias("failures"))
        elif c.kind == "row_count":
            n = row_count_between(models[c.model], c.args.get("min_rows"), c.args.get("max_rows")) \
                .select(F.when(F.col("passed"), 0).otherwise(1).alias("failures"))
        else:
            continue
        parts.append(n.select(F.lit(c.name).alias("check_name"), F.lit(c.model).alias("model"),
                              F.lit(c.severity).alias("severity"), F.col("failures")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out = out.withColumn("failures", F.col("failures").cast("bigint"))
    return out.withColumn(
        "status",
        F.when(F.col("failures") == 0, "pass").when(F.col("severity") == "warn", "warn").otherwise("fail"))


class CheckFailed(RuntimeError):
    pass


def enforce(report_rows) -> None:
    """Stop the job when an error-severity check failed; warnings pass."""
    failed = [r["check_name"] for r in report_rows if r["status"] == "fail"]
    if failed:
        raise CheckFailed(f"data tests failed: {', '.join(sorted(failed))}")


# --- E7: per-batch quality profile ------------------------------------------------------------

def batch_quality_profile(raw_orders: DataFrame, as_of_date, customers: DataFrame | None = None,
                          id_col: str = "id", customer_key: str = "cliente_id",
                          customer_id: str = "id") -> DataFrame:
    """Rows per dirt class and batch, counted with conditional aggregates.

    One hash aggregate over the raw table gives the value classes; a batch
    holding most of the rows is pre-aggregated per map task, so the group
    key's skew does not matter.  Two classes need a second pass:

    * ``copies_new_id``: extra rows equal on every column but the id (a copy
      inserted under a fresh id, which key dedup cannot remove).  A group by
      all content columns, combined map-side, so a hot copy group costs one
      partial count per task.
    * ``orphan_customer`` (when ``customers`` is given): rows whose customer
      key has no customer row, by a left anti join.

    Both reduce to one row per batch before being joined to the profile.
    """
    qty = safe_int("cantidad")
    price = safe_decimal("precio_unitario")
    day = safe_date("fecha_pedido")
    out = raw_orders.groupBy("_batch_id").agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("precio_unitario").isNull()).alias("null_price"),
        F.count_if(F.col("cantidad").isNotNull() & qty.isNull()).alias("corrupt_quantity"),
        F.count_if(qty <= 0).alias("non_positive_quantity"),
        F.count_if(price <= 0).alias("non_positive_price"),
        F.count_if(F.col("fecha_pedido").isNotNull() & day.isNull()).alias("bad_date_format"),
        F.count_if(day > as_of(as_of_date)).alias("future_date"),
        F.count_if(F.col("producto") != F.trim("producto")).alias("untrimmed_product"),
    )
    content = [c for c in raw_orders.columns if c != id_col]
    copies = (raw_orders.groupBy(*content).agg(F.count(F.lit(1)).alias("_n"))
              .filter(F.col("_n") > 1)
              .groupBy("_batch_id").agg(F.sum(F.col("_n") - 1).alias("copies_new_id")))
    extra = [("copies_new_id", copies)]
    if customers is not None:
        orph = (orphans(raw_orders, customers, customer_key, customer_id)
                .groupBy("_batch_id").agg(F.count(F.lit(1)).alias("orphan_customer")))
        extra.append(("orphan_customer", orph))
    for name, part in extra:
        out = (out.join(part, "_batch_id", "left")
                  .withColumn(name, F.coalesce(F.col(name), F.lit(0)).cast("bigint")))
    return out
