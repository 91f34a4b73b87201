"""Reports, named checks, status and seals."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.operators.gates import reasons


def status(**tables: DataFrame) -> DataFrame:
    """relation, n of each table."""
    out = None
    for name, df in tables.items():
        part = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("relation"), "n")
        out = part if out is None else out.unionByName(part)
    return out


def status_matrix(stages: Mapping[str, DataFrame], split: str = "split") -> DataFrame:
    """One row a split, one column a stage."""
    out = None
    for name, df in stages.items():
        part = df.groupBy(split).agg(F.count("*").alias("n")).withColumn("stage", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out.groupBy(split).pivot("stage", list(stages)).agg(F.first("n")).na.fill(0)


def checks(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """One row: each check as 1 or 0, all in one pass. A check over no rows counts as passed."""
    return df.agg(*(F.coalesce(c, F.lit(True)).cast("int").alias(name) for name, c in conditions.items()))


def require(result: DataFrame) -> dict[str, bool]:
    """The checks as a dict; raises with the names of those that failed."""
    found = {k: bool(v) for k, v in result.first().asDict().items()}
    if failed := [k for k, ok in found.items() if not ok]:
        raise ValueError(f"failed checks: {', '.join(failed)}")
    return found


def summary(df: DataFrame, group: str, chars: str, source: str) -> DataFrame:
    return df.groupBy(group).agg(
        F.count("*").alias("n"), F.countDistinct(source).alias("sources"), F.round(F.avg(chars), 2).alias("mean_chars"),
        F.max(chars).cast("bigint").alias("most_chars"), F.round(F.avg(chars) / 3.5, 2).alias("tokens_estimate"),
    )


def seal(df: DataFrame, order: str, line: Column) -> DataFrame:
    """sha-256 of the lines in order, joined by newlines. The lines meet in one row: for sealed sets of bounded size."""
    rows = df.select(F.struct(F.col(order).alias("o"), line.alias("x")).alias("r"))
    rows = rows.agg(F.array_sort(F.collect_list("r")).alias("rs"), F.count("*").alias("n"))
    return rows.select(F.sha2(F.array_join(F.transform("rs", lambda r: r["x"]), "\n"), 256).alias("seal"), "n")


def canonical_sha256(value: object) -> str:
    """Hash of a configuration: compact JSON with sorted keys."""
    return hashlib.sha256(json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()


def best_experiment(metrics: DataFrame, loss: str = "eval_loss", order: str | None = None) -> DataFrame:
    """The row of the least loss; a missing loss is the worst. Of equal losses the least of the column `order` counts, if given."""
    least = F.struct(F.coalesce(loss, F.lit(float("inf"))).alias("loss"), *([F.col(order).alias("order")] if order else []))
    return metrics.agg(F.min_by(F.struct("*"), least).alias("r")).select("r.*")


def loss_curves(metrics: DataFrame, key: str = "experiment", epoch: str = "epoch", loss: str = "eval_loss") -> DataFrame:
    """Each experiment's points (epoch, loss) with their places in order of epochs; points without a loss are left out."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(epoch))
    return metrics.where(F.col(loss).isNotNull()).select(key, place.alias("place"), epoch, loss)


def join_metrics(metadata: DataFrame, metrics: DataFrame, key: str = "experiment", step: str = "step") -> DataFrame:
    """Each experiment with its evaluations in order, one for each step."""
    once = metrics.dropDuplicates([key, step])
    rest = [step, *(c for c in once.columns if c not in (key, step))]
    lists = once.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*rest))).alias("evaluations"))
    return metadata.join(lists, key, "left")


__all__ = ["best_experiment", "canonical_sha256", "checks", "join_metrics", "loss_curves", "reasons", "require", "seal", "status", "status_matrix", "summary"]
