"""Sinks: reports, manifests, label trees, quarantine, resumable state, verified writes."""

from __future__ import annotations

import json
import os
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frond import storage
from frond.operators.compaction import multiset_checksum

#: A report is a small aggregate; more rows than this are a table and belong to a table sink.
MAX_REPORT_ROWS = 100_000


def _rows(df: DataFrame) -> list:
    got = df.limit(MAX_REPORT_ROWS + 1).collect()
    if len(got) > MAX_REPORT_ROWS:
        raise ValueError(f"a report of more than {MAX_REPORT_ROWS} rows; write a table")
    return got


def save_json_report(data: dict | DataFrame, path: str) -> dict:
    """SNK-01, DAT-01: one JSON document with ``timestamp_utc``; a DataFrame becomes its ``rows``."""
    body = dict(data) if isinstance(data, dict) else {"rows": [r.asDict(True) for r in _rows(data)]}
    body["timestamp_utc"] = datetime.now(timezone.utc).isoformat()
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        json.dump(body, f, indent=2, default=str)
    return body


def save_csv(df: DataFrame, columns: list[str], path: str, mode: str = "errorifexists") -> None:
    """SNK-02: the given columns in their order, with a header, as a folder of CSV files."""
    df.select(*columns).write.mode(mode).option("header", True).csv(path)


def markdown_report(title: str, sections: dict[str, DataFrame], path: str | None = None) -> str:
    """SNK-03: a title and a table for each small aggregate."""
    out = [f"# {title}", ""]
    for name, df in sections.items():
        out += [f"## {name}", "", "| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
        out += ["| " + " | ".join("" if v is None else str(v).replace("|", "\\|") for v in r) + " |" for r in _rows(df)] + [""]
    text = "\n".join(out)
    if path:
        with open(path, "w", encoding="utf-8") as f:
            f.write(text)
    return text


def html_report(title: str, sections: dict[str, DataFrame], path: str | None = None) -> str:
    """SNK-03: as ``markdown_report``, as a page of HTML; all text is escaped."""
    from html import escape

    text = lambda v: "" if v is None else escape(str(v))
    out = ["<!DOCTYPE html>", f'<html><head><meta charset="utf-8"><title>{escape(title)}</title></head><body>', f"<h1>{escape(title)}</h1>"]
    for name, df in sections.items():
        out += [f"<h2>{escape(name)}</h2>", "<table>", "<tr>" + "".join(f"<th>{escape(c)}</th>" for c in df.columns) + "</tr>"]
        out += ["<tr>" + "".join(f"<td>{text(v)}</td>" for v in r) + "</tr>" for r in _rows(df)] + ["</table>"]
    page = "\n".join([*out, "</body></html>"])
    if path:
        with open(path, "w", encoding="utf-8") as f:
            f.write(page)
    return page


def write_manifest(df: DataFrame, path: str, by: str = "split", mode: str = "errorifexists") -> None:
    """SNK-04, SNK-07: rows in one folder for each value of ``by``: a copy plan, or records by status.

    REBALANCE by the column keeps files well-sized even if one value owns most rows.
    """
    df.hint("rebalance", by).write.mode(mode).partitionBy(by).parquet(path)


def copy_files(manifest: DataFrame, source: str = "source", target: str = "target") -> DataFrame:
    """SNK-04: copy bytes on the executors; (source, target, status) copied, present or missing.

    A copy is written beside its target and renamed, so a task that runs twice leaves one whole file.
    """

    def run(batches):
        import os
        import shutil
        import uuid

        import pandas as pd

        for pdf in batches:
            out = []
            for s, t in zip(pdf[source], pdf[target]):
                if not s or not os.path.isfile(s):
                    out.append("missing")
                elif os.path.exists(t) and os.path.getsize(t) == os.path.getsize(s):
                    out.append("present")
                else:
                    os.makedirs(os.path.dirname(t), exist_ok=True)
                    shutil.copyfile(s, part := f"{t}.{uuid.uuid4().hex}.part")
                    os.replace(part, t)
                    out.append("copied")
            yield pd.DataFrame({"source": pdf[source], "target": pdf[target], "status": out})

    return manifest.select(source, target).mapInPandas(run, "source string, target string, status string")


def write_label_tree(labels: DataFrame, root: str, path: str = "path", content: str = "content") -> DataFrame:
    """SNK-05: one file for each row, empty ones included; (path, bytes) written."""

    def run(batches):
        import os
        import uuid

        import pandas as pd

        for pdf in batches:
            sizes = []
            for p, c in zip(pdf[path], pdf[content]):
                at = os.path.join(root, p)
                os.makedirs(os.path.dirname(at), exist_ok=True)
                data = (c or "").encode("utf-8")
                with open(part := f"{at}.{uuid.uuid4().hex}.part", "wb") as f:
                    f.write(data)
                os.replace(part, at)
                sizes.append(len(data))
            yield pd.DataFrame({"path": pdf[path], "bytes": sizes})

    return labels.select(path, content).mapInPandas(run, "path string, bytes bigint")


def write_class_files(names: dict[int, str], folder: str) -> None:
    """SNK-06: data.yaml with a list of names in the order of their ids, and classes.txt."""
    os.makedirs(folder, exist_ok=True)
    order = [names[k] for k in sorted(names)]
    with open(os.path.join(folder, "data.yaml"), "w", encoding="utf-8") as f:
        f.write("train: train/images\nval: val/images\ntest: test/images\n" + f"nc: {len(order)}\nnames:\n" + "".join(f"  - {json.dumps(n)}\n" for n in order))
    with open(os.path.join(folder, "classes.txt"), "w", encoding="utf-8") as f:
        f.write("".join(f"{n}\n" for n in order))


def verify_written(df: DataFrame, path: str) -> bool:
    """SNK-09: whether the table at ``path`` holds exactly the rows of ``df``, by multiset checksum."""
    return multiset_checksum(df) == multiset_checksum(df.sparkSession.read.schema(df.schema).parquet(path))


def differences(df: DataFrame, path: str) -> DataFrame:
    """SNK-09: rows that only one side has, with ``side``; empty if the write was faithful."""
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    return df.exceptAll(back).withColumn("side", F.lit("missing")).unionByName(back.exceptAll(df).withColumn("side", F.lit("extra")))


def without(df: DataFrame, losers: DataFrame, id_col: str) -> DataFrame:
    """SNK-11: the rows that are not losers; inputs are never changed."""
    return df.join(losers.select(id_col), id_col, "left_anti")


def plan_write(df: DataFrame, path: str, overwrite: bool = False, dry_run: bool = False) -> dict:
    """SNK-12: write once, or say what would be written. An existing path is refused unless overwritten."""
    spark = df.sparkSession
    there = storage.exists(spark, path)
    if there and not overwrite:
        raise FileExistsError(path)
    if not dry_run:
        df.write.mode("overwrite" if overwrite else "errorifexists").parquet(path)
    return {"path": path, "exists": there, "written": not dry_run, "columns": df.columns}


class ResumeState:
    """SNK-08, JN-14: keys already processed, as an append-only table in a folder.

    A batch is appended under its own name by a rename, so a batch that fails leaves no part of
    itself. A key is (rel_path, sha256): changed content is processed again.
    """

    SCHEMA = "rel_path string, sha256 string, status string"

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def done(self) -> DataFrame:
        if not storage.exists(self.spark, self.folder):
            return self.spark.createDataFrame([], self.SCHEMA)
        return self.spark.read.schema(self.SCHEMA).option("recursiveFileLookup", "true").parquet(self.folder)

    def pending(self, df: DataFrame) -> DataFrame:
        """Rows of ``df`` (rel_path, sha256, …) without a COMPLETED record."""
        return df.join(self.done().where("status = 'COMPLETED'").select("rel_path", "sha256").distinct(), ["rel_path", "sha256"], "left_anti")

    def record(self, batch: str, df: DataFrame) -> None:
        """Append (rel_path, sha256, status) of one batch; a batch recorded before is left as it is."""
        target = f"{self.folder}/batch={batch}"
        if storage.exists(self.spark, target):
            return
        staging = f"{self.folder}.staging-{batch}"
        df.select("rel_path", "sha256", "status").write.mode("overwrite").parquet(staging)
        storage.rename(self.spark, staging, target)
