"""Data-quality operators: each returns the failing rows; a suite counts them and raises."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from isoclime.session import scratch


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a null in any of the columns, and which."""
    nulls = F.filter(F.array(*(F.when(F.col(c).isNull(), F.lit(c)) for c in columns)), lambda x: x.isNotNull())
    return df.withColumn("null_columns", F.array_join(nulls, ",")).filter("null_columns <> ''")


def check_relationship(fact: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """Fact rows whose key isn't in the dimension; null keys aren't orphans."""
    known = dim.select(F.col(dim_key or key).alias(key)).distinct()
    return fact.filter(F.col(key).isNotNull()).join(known, key, "left_anti")


def check_accepted(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Rows with a value that isn't listed; nulls pass."""
    return df.filter(~F.col(column).isin(list(values)))


def check_expectations(df: DataFrame, spec: Sequence[dict]) -> DataFrame:
    """(expectation, failing, ok) in one pass of conditional aggregates.

    Kinds: range (column, low, high), regex (column, pattern), not_null (column), monotone (column, by, order: rows
    below the one before them in their group): failing rows; rows (low, high) and mean (column, low, high): 0 or 1.
    Only monotone needs an order, taken group by group.
    """
    cells = []
    for i, e in enumerate(spec):
        kind, c = e["kind"], e.get("column")
        name = f"{kind}({c})" if c else kind
        if kind == "range":
            failing = F.count_if(~F.col(c).between(e["low"], e["high"]))
        elif kind == "regex":
            failing = F.count_if(~F.col(c).rlike(e["pattern"]))
        elif kind == "not_null":
            failing = F.count_if(F.col(c).isNull())
        elif kind == "monotone":
            before = F.lag(c).over(Window.partitionBy(*e["by"]).orderBy(*e["order"]))
            df = df.withColumn(f"_falls{i}", F.col(c) < before)
            failing = F.count_if(f"_falls{i}")
        elif kind == "rows":
            failing = F.when(F.count(F.lit(1)).between(e["low"], e["high"]), 0).otherwise(1)
        elif kind == "mean":
            failing = F.when(F.avg(c).between(e["low"], e["high"]), 0).otherwise(1)
        else:
            raise ValueError(f"unknown expectation {kind}")
        cells.append(F.struct(F.lit(name).alias("expectation"), failing.cast("long").alias("failing")))
    out = df.agg(F.array(*cells).alias("_r")).select(F.inline("_r"))
    return out.withColumn("ok", F.col("failing") == 0)


def run_suite(checks: Sequence[tuple[str, str, DataFrame]], stop: bool = True) -> DataFrame:
    """(check, table_name, failing, ok) for (check, table, failing rows) triples; raises on any failure if ``stop``."""
    out = None
    for name, table, failing in checks:
        row = failing.agg(F.count(F.lit(1)).alias("failing")).select(F.lit(name).alias("check"), F.lit(table).alias("table_name"), "failing", (F.col("failing") == 0).alias("ok"))
        out = row if out is None else out.unionByName(row)
    if stop and (bad := out.filter("NOT ok").collect()):  # one row a check
        raise RuntimeError("failed checks: " + ", ".join(f"{r['check']} on {r['table_name']} ({r['failing']})" for r in bad))
    return out


class GateError(RuntimeError):
    """A table was not published; ``report`` has (check, failing) of all its checks."""

    def __init__(self, table: str, report: list[tuple[str, int]]):
        self.report = report
        super().__init__(f"{table} not written: " + ", ".join(f"{name} ({n})" for name, n in report if n))


def row_rules(spec: dict[str, Sequence[str] | dict]) -> dict[str, Column]:
    """Failing-row conditions by name: not_null (columns), accepted, range and regex (column: values, (low, high), pattern). Nulls pass but for not_null."""
    out: dict[str, Column] = {f"not_null({c})": F.col(c).isNull() for c in spec.get("not_null", ())}
    out |= {f"accepted({c})": ~F.col(c).isin(list(v)) for c, v in spec.get("accepted", {}).items()}
    out |= {f"range({c})": ~F.col(c).between(*v) for c, v in spec.get("range", {}).items()}
    return out | {f"regex({c})": ~F.col(c).rlike(v) for c, v in spec.get("regex", {}).items()}


def gated_write(df: DataFrame, path: str, rules: dict[str, Column], least_rows: int = 1, by: Sequence[str] = ()) -> list[tuple[str, int]]:
    """Write ``df`` to ``path`` if every rule holds, in one pass over its rows; (check, failing) of each rule, and of rows.

    The rows are counted against all rules while they are written to a folder beside ``path``; only then is that folder
    renamed to ``path``, or, if a rule failed, deleted and ``GateError`` raised: readers never see a table that failed, and
    what was published before stays until the new one passes. ``rules``: conditions that are true of failing rows.
    """
    spark, seen = df.sparkSession, Observation()
    staged = f"{path.rstrip('/')}-staged-{scratch(spark, 'gate').rsplit('-', 1)[1]}"
    names = list(rules)
    watched = df.observe(seen, F.count(F.lit(1)).alias("rows"), *(F.count_if(rules[n]).alias(f"rule{i}") for i, n in enumerate(names)))
    watched.write.partitionBy(*by).parquet(staged)
    got = seen.get
    report = [("rows", 0 if got["rows"] >= least_rows else 1), *((n, got[f"rule{i}"]) for i, n in enumerate(names))]
    if any(n for _, n in report):
        _delete(spark, staged)
        raise GateError(path, report)
    _delete(spark, path)
    at = spark._jvm.org.apache.hadoop.fs.Path
    if not at(staged).getFileSystem(spark._jsc.hadoopConfiguration()).rename(at(staged), at(path)):
        raise RuntimeError(f"{staged} could not be renamed to {path}")
    return report


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
