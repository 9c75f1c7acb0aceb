"""Data quality: quarantine splits and declarative checks.

A quarantine tags every row with the first failing rule in one pass
(a CASE ladder); good and bad rows are two filters of the same plan.
Checks return their *failing rows* as DataFrames, so storing failures is a
plain write and counting them is a distributed count.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from histmart.functions.keys import surrogate_key, NULL_TOKEN
from histmart.sources.sink import replace_table, table_exists


@dataclass(frozen=True)
class Rule:
    reason_code: str
    condition: Column  # True = the row is bad for this reason


def reason_column(rules: Sequence[Rule], default: str | None = None) -> Column:
    """First matching reason code, else ``default`` (NULL = good row).

    A NULL condition counts as not failing, like ``WHERE`` does.
    """
    expr = None
    for r in rules:
        cond = F.coalesce(r.condition, F.lit(False))
        expr = F.when(cond, F.lit(r.reason_code)) if expr is None else expr.when(cond, F.lit(r.reason_code))
    if default is not None:
        expr = expr.otherwise(F.lit(default))
    return expr


def quarantine(df: DataFrame, rules: Sequence[Rule], key_parts: Sequence,
               detail: str, keep: Sequence[str] | None = None,
               id_col: str = "bad_row_id") -> tuple[DataFrame, DataFrame]:
    """Split ``df`` into (good, bad).

    bad rows carry ``bad_row_id`` = md5 of ``key_parts`` with NULL token,
    ``reason_code`` and ``reason_detail``.
    """
    tagged = df.withColumn("reason_code", reason_column(rules))
    good = tagged.filter(F.col("reason_code").isNull()).drop("reason_code")
    cols = list(keep) if keep is not None else list(df.columns)
    bad = (tagged.filter(F.col("reason_code").isNotNull())
           .select(surrogate_key(*key_parts, null_token=NULL_TOKEN).alias(id_col),
                   *cols, "reason_code", F.lit(detail).alias("reason_detail")))
    return good, bad


BITMAP_BITS = 1 << 26  # 2,048 rows of 4 KB, whatever is put in


def suspects(df: DataFrame, keys: Sequence[str], bad: DataFrame) -> DataFrame:
    """The rows of ``df`` whose keys may be among those of ``bad``: all of those, and few others while ``bad`` is sparse.

    Where one row of each key is kept, a key none of whose rows breaks a rule keeps a good one, whichever it is. So a
    quarantine of kept rows has only to look at the keys of the rows that break a rule (``bad``). One bit for the hash of
    each key is broadcast, at most 8 MB; NULL is a value.
    """
    def placed(rows):
        h = F.pmod(F.xxhash64(*keys), F.lit(BITMAP_BITS)) + 1
        return rows.withColumn("_bucket", F.bitmap_bucket_number(h)).withColumn("_at", F.bitmap_bit_position(h))
    bits = placed(bad).groupBy("_bucket").agg(F.bitmap_construct_agg("_at").alias("_bits"))
    byte = F.conv(F.hex(F.substring("_bits", (F.floor(F.col("_at") / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return placed(df).join(F.broadcast(bits), "_bucket").filter(F.getbit(byte, (F.col("_at") % 8).cast("int")) == 1).select(*df.columns)


def quarantine_union(parts: Sequence[tuple[str, DataFrame]],
                     columns: Sequence[str] = ("bad_row_id", "asin", "snapshot_ts",
                                               "reason_code", "reason_detail", "ingest_ts"),
                     types: dict | None = None) -> DataFrame:
    """Roll-up of several quarantines: tag + common columns, NULL padded."""
    types = types or {}
    out = None
    for name, df in parts:
        sel = [F.lit(name).alias("table_name")]
        for c in columns:
            if c in df.columns:
                col = F.col(c)
            else:
                col = F.lit(None)
            if c in types:
                col = col.cast(types[c])
            sel.append(col.alias(c))
        piece = df.select(*sel)
        out = piece if out is None else out.unionByName(piece)
    return out


# ---- declarative checks: each returns the failing rows -------------------

def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once (NULLs ignored), with their count.

    groupBy + count is a partial (map-side) aggregate, so a hot value is
    pre-counted in each task before the shuffle.
    """
    return (df.filter(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1))


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.filter(F.col(column).isNotNull() & ~F.col(column).isin(list(values)))


def relationships(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent row (anti-join)."""
    keys = parent.select(F.col(field).alias("__parent_key")).filter(F.col("__parent_key").isNotNull())
    c = child.filter(F.col(column).isNotNull())
    return c.join(keys, c[column] == keys["__parent_key"], "left_anti")


def expression_is_true(df: DataFrame, expression: str) -> DataFrame:
    """Rows where the SQL expression is false (NULL results do not fail)."""
    return df.filter(~F.expr(expression))


def failing_rows(df: DataFrame, condition: str | Column) -> DataFrame:
    """Singular check: the rows matching ``condition`` are failures."""
    return df.filter(F.expr(condition) if isinstance(condition, str) else condition)


@dataclass
class Check:
    name: str
    failures: DataFrame


def check_summary(spark, checks: Sequence[Check], severity: str = "warn") -> DataFrame:
    """One row per check: name, failure count, status (pass / warn / fail).

    Each count is a distributed aggregate; the union runs them as one job.
    """
    out = None
    for ch in checks:
        piece = ch.failures.agg(F.count(F.lit(1)).alias("failures")).select(
            F.lit(ch.name).alias("check_name"), F.col("failures"))
        out = piece if out is None else out.unionByName(piece)
    status = F.when(F.col("failures") == 0, F.lit("pass")).otherwise(F.lit(severity))
    return out.withColumn("status", status)


@dataclass(frozen=True)
class DataTest:
    """A declared check of one table. ``kind``: not_null, unique, accepted_values (``arg``: the values), relationships
    (``arg``: parent table and column), expression (``arg``: must not be false) or failing (``arg``: must not be true)."""
    name: str
    table: str
    kind: str
    column: str | None = None
    arg: object = None

    def failures(self, tables: Mapping[str, DataFrame]) -> DataFrame:
        """The failing rows."""
        df = tables[self.table]
        if self.kind == "relationships":
            return relationships(df, self.column, tables[self.arg[0]], self.arg[1])
        if self.kind in ("not_null", "unique"):
            return (not_null if self.kind == "not_null" else unique)(df, self.column)
        if self.kind == "accepted_values":
            return accepted_values(df, self.column, self.arg)
        return (expression_is_true if self.kind == "expression" else failing_rows)(df, self.arg)

    def _fails(self) -> Column:
        """Row checks: whether the row fails."""
        if self.kind == "not_null":
            return F.col(self.column).isNull()
        if self.kind == "accepted_values":
            return F.col(self.column).isNotNull() & ~F.col(self.column).isin(list(self.arg))
        return ~F.expr(self.arg) if self.kind == "expression" else F.expr(self.arg)

    def entries(self) -> dict[str, list[Column]]:
        """Table -> what each of its rows contributes: (check, key, whether it is a parent's row), or NULL."""
        def entry(when, key, parent):
            return F.when(when, F.struct(F.lit(self.name).alias("check_name"), key.cast("string").alias("key"), F.lit(parent).alias("parent")))
        if self.kind not in ("unique", "relationships"):
            return {self.table: [entry(self._fails(), F.lit(None), False)]}
        out = {self.table: [entry(F.col(self.column).isNotNull(), F.col(self.column), False)]}
        if self.kind == "relationships":
            out.setdefault(self.arg[0], []).append(entry(F.col(self.arg[1]).isNotNull(), F.col(self.arg[1]), True))
        return out


def summarise(spark, tables: Mapping[str, DataFrame], tests: Sequence[DataTest], severity: str = "warn") -> DataFrame:
    """One row per test: check_name, failures and status, as ``check_summary`` gives, from one scan of each table.

    Every row yields an entry for each row check that it fails and for each key
    that a test counts; entries are summed by (check, key) in the map tasks and
    once after one shuffle. A unique test fails for a key with two rows, a
    relationship for the child rows of a key without a parent's row.
    """
    by_table: dict[str, list[Column]] = {}
    for t in tests:
        for table, entries in t.entries().items():
            by_table.setdefault(table, []).extend(entries)
    parts = [tables[t].select(F.explode(F.array_compact(F.array(*entries))).alias("e")).select("e.*") for t, entries in by_table.items()]
    keys = reduce(DataFrame.unionByName, parts).groupBy("check_name", "key").agg(
        F.count_if(~F.col("parent")).alias("rows"), F.count_if("parent").alias("parents"))
    kinds = spark.createDataFrame([(t.name, t.kind) for t in tests], "check_name string, kind string")
    bad = (F.when(F.col("kind") == "unique", (F.col("rows") > 1).cast("long"))
           .when(F.col("kind") == "relationships", F.when(F.col("parents") == 0, F.col("rows")))
           .otherwise(F.col("rows")))
    found = kinds.join(keys, "check_name", "left").groupBy("check_name").agg(F.coalesce(F.sum(bad), F.lit(0)).alias("failures"))
    status = F.when(F.col("failures") == 0, F.lit("pass")).otherwise(F.lit(severity))
    return found.withColumn("status", status)


def store_failures(checks: Sequence[Check], root: str, run_id: str | None = None, passed: Sequence[str] = ()) -> None:
    """Replace each check's stored rows by its failing rows (``root/<check name>``; warn, go on), with ``run_id`` where given.

    The stored rows of the checks that ``passed`` are emptied, so the store holds the failures of the last run.
    """
    for ch in checks:
        rows = ch.failures if run_id is None else ch.failures.withColumn("run_id", F.lit(run_id))
        replace_table(rows, f"{root}/{ch.name}")
    for name in passed:
        spark, path = SparkSession.active(), f"{root}/{name}"
        if table_exists(spark, path):
            old = spark.read.parquet(path)
            if not old.isEmpty():
                replace_table(old.limit(0), path)
