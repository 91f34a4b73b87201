"""Sinks: data sets by Spark's writers, and canonical files (whose bytes are hashed) by the driver, row by row.

Canonical files are for sealed sets of bounded size. Rows come through toLocalIterator, so one partition at a time is held.
"""

from __future__ import annotations

import csv
import hashlib
import json
import os
from collections.abc import Iterator, Sequence
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_rows(df: DataFrame, path: str, mode: str = "overwrite", by: Sequence[str] = ()) -> None:
    """JSON lines at any scale; nulls are kept."""
    writer = df.write.mode(mode).option("ignoreNullFields", False)
    (writer.partitionBy(*by) if by else writer).json(path)


def _replaced(path: Path, lines: Iterator[str], encoding: str = "utf-8") -> int:
    path.parent.mkdir(parents=True, exist_ok=True)
    temporary, count = path.with_name(path.name + ".tmp"), 0
    with temporary.open("w", encoding=encoding, newline="") as out:
        for line in lines:
            out.write(line)
            count += 1
    os.replace(temporary, path)
    return count


def write_canonical(df: DataFrame, path: str | Path, *order: str | Column) -> int:
    """One file of JSON lines in a defined order, keys sorted, text unescaped, put in place at once; returns the rows."""
    rows = (df.orderBy(*order) if order else df).toLocalIterator()
    return _replaced(Path(path), (json.dumps(r.asDict(recursive=True), ensure_ascii=False, sort_keys=True) + "\n" for r in rows))


def write_document(path: str | Path, value: dict) -> None:
    """One JSON object, indented, keys sorted."""
    _replaced(Path(path), iter([json.dumps(value, indent=2, ensure_ascii=False, sort_keys=True) + "\n"]))


def write_review(df: DataFrame, path: str | Path, fields: Sequence[str], *order: str | Column) -> int:
    """A review table as CSV with a byte order mark: these fields only, blank where df has no such column or a null."""
    columns = [F.col(c).cast("string").alias(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in fields]
    rows = (df.orderBy(*order) if order else df).select(*columns).toLocalIterator()

    class Line(list):
        write = list.append

    def lines() -> Iterator[str]:
        out = Line()
        writer = csv.writer(out, lineterminator="\n")
        writer.writerow(fields)
        for r in rows:
            writer.writerow(["" if v is None else v for v in r])
            yield out.pop(0)
        yield out.pop(0)

    return _replaced(Path(path), lines(), "utf-8-sig") - 1


def write_paragraphs(df: DataFrame, path: str, text: str = "text") -> None:
    """Texts with a blank line after each."""
    df.select(text).write.mode("overwrite").option("lineSep", "\n\n").text(path)


def append_event(path: str | Path, command: str, status: str, payload: dict, now: str | None = None) -> None:
    """Add an event to a Markdown ledger."""
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    now = now or datetime.now(UTC).isoformat(timespec="seconds")
    body = json.dumps(payload, indent=2, ensure_ascii=False, sort_keys=True)
    with Path(path).open("a", encoding="utf-8") as out:
        out.write(f"\n## {now} {command}: {status}\n\n```json\n{body}\n```\n")


def sha256_file(path: str | Path) -> str:
    with Path(path).open("rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()
