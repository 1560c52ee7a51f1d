"""Numbered records of CSV files whose splits are read by many tasks.

A split begins at a line, but the line may lie inside a quoted cell. Every line is
therefore read under both states, outside and inside a quoted cell, and the records
that begin are counted under both. One small row per split carries what the split does
to either state; folding these rows in file order fixes the state in which each split
begins and the number of its first record. Rows of the files are not shuffled: only a
record that reaches over the end of a split is put together from its parts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmill.operators.joins import bounded_broadcast
from feedmill.session import stage

_QUOTED = r'"[^"]*+(?:""[^"]*+)*+'
# a record, with a comma put before it, that ends inside a quoted cell
_OPEN = re.compile(rf'(?:,(?:{_QUOTED}"[^,]*+|(?!")[^,]*+))*+,{_QUOTED}\Z')
_CELL = re.compile(r',(?:"([^"]*+(?:""[^"]*+)*+)"?([^,]*+)|([^,]*+))')
_PART = (
    "file string, split long, line long, text string, was_out boolean, was_in boolean, "
    "records_out long, records_in long, ends_out boolean, ends_in boolean"
)


def ends_inside(text: str, inside: bool) -> bool:
    """Whether a line that begins outside or ``inside`` a quoted cell ends inside one."""
    if '"' not in text:
        return inside
    return _OPEN.match(',"' + text if inside else "," + text) is not None


class _Split:
    """The lines of one split so far, under both states in which it may begin."""

    def __init__(self, file: str, number: int):
        self.file, self.number, self.line = file, number, -1
        self.inside = [False, True]
        self.records = [0, 0]
        self.row: list | None = None

    def add(self, text: str) -> list | None:
        """The row before, once it is complete; lines inside a cell under both states go on with their row."""
        self.line += 1
        before = self.inside
        self.inside = [ends_inside(text, state) for state in before]
        if self.row is not None and before[0] and before[1]:
            self.row[3].append(text)
            self.row[8:] = self.inside
            return None
        for k in (0, 1):
            self.records[k] += not before[k] and text not in ("", "\r")
        done, self.row = self.row, [self.file, self.number, self.line, [text], *before, *self.records, *self.inside]
        return done


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in _PART.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_()]

    def batch(rows: list[list]) -> pa.RecordBatch:
        for row in rows:
            # a line break within a cell is \n
            row[3] = "\n".join([*(t.removesuffix("\r") for t in row[3][:-1]), row[3][-1]])
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    split = None
    for lines in batches:
        rows = []
        for file, number, text in zip(*(lines.column(c).to_pylist() for c in ("file", "split", "value"))):
            if split is None or (file, number) != (split.file, split.number):
                if split is not None and split.row is not None:
                    rows.append(split.row)
                split = _Split(file, number)
            done = split.add(text)
            if done is not None:
                rows.append(done)
        if rows:
            yield batch(rows)
    if split is not None and split.row is not None:
        yield batch([split.row])


def split_parts(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Lines of all files, read once: where each lies and what it is under both states."""
    lines = spark.read.options(lineSep="\n", ignoreMissingFiles=True).text(paths)
    return lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), "value"
    ).mapInArrow(_parts, _PART)


def split_starts(parts: DataFrame) -> DataFrame:
    """file, split, inside (state in which the split begins) and before (records of the file that begin before it)."""
    effects = parts.groupBy("file", "split").agg(
        F.max("records_out").alias("records_out"), F.max("records_in").alias("records_in"),
        F.max_by("ends_out", "line").alias("ends_out"), F.max_by("ends_in", "line").alias("ends_in"),
    )
    # one row per split, not per line
    effects = effects.groupBy("file").agg(F.array_sort(F.collect_list(F.struct(
        "split", "records_out", "records_in", "ends_out", "ends_in"))).alias("effects"))
    state = "struct<inside:boolean,before:bigint,starts:array<struct<split:bigint,inside:boolean,before:bigint>>>"

    def follow(done: Column, effect: Column) -> Column:
        start = F.struct(effect["split"].alias("split"), done["inside"].alias("inside"), done["before"].alias("before"))
        return F.struct(
            F.when(done["inside"], effect["ends_in"]).otherwise(effect["ends_out"]).alias("inside"),
            (done["before"] + F.when(done["inside"], effect["records_in"]).otherwise(effect["records_out"])).alias("before"),
            F.concat(done["starts"], F.array(start)).alias("starts"),
        ).cast(state)

    first = F.struct(F.lit(False).alias("inside"), F.lit(0).alias("before"), F.array().alias("starts")).cast(state)
    return effects.select("file", F.inline(F.aggregate("effects", first, follow)["starts"]))


def records(parts: DataFrame) -> DataFrame:
    """file, row_no (from 1, blank lines do not count) and text of every record."""
    starts = stage(split_starts(parts), "splits").select(F.col("file").alias("_file"), F.col("split").alias("_split"), "inside", "before")
    at = parts.join(bounded_broadcast(starts), (F.col("file") == F.col("_file")) & (F.col("split") == F.col("_split")))
    one = lambda kind: F.when(F.col("inside"), F.col(f"{kind}_in")).otherwise(F.col(f"{kind}_out"))
    at = at.select("file", "split", "line", "text", (F.col("before") + one("records")).alias("row_no"),
                   one("was").alias("goes_on"), one("ends").alias("open"))
    whole = at.where(~F.col("goes_on") & ~F.col("open") & ~F.col("text").isin("", "\r")).select("file", "row_no", "text")
    pieces = at.where(F.col("goes_on") | F.col("open")).groupBy("file", "row_no").agg(
        F.array_sort(F.collect_list(F.struct("split", "line", "text"))).alias("pieces"))
    last = F.size("pieces") - 1
    joined = F.transform("pieces", lambda p, i: F.when(i < last, F.regexp_replace(p["text"], "\r$", "")).otherwise(p["text"]))
    return whole.unionByName(pieces.select("file", "row_no", F.array_join(joined, "\n").alias("text")))


def cells_of(text: str) -> list[str | None]:
    """Cells of one record; an empty cell is null, with quotes or without."""
    return [quoted.replace('""', '"') + rest or bare or None for quoted, rest, bare in _CELL.findall("," + text)]


def split_cells(rows: DataFrame) -> DataFrame:
    """``rows`` with ``cells`` in place of ``text``."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = pc.replace_substring_regex(batch.column("text"), "\r$", "")
            # a byte order mark belongs to the file
            text = pc.if_else(pc.equal(batch.column("row_no"), 1), pc.replace_substring_regex(text, "^﻿", ""), text)
            if pc.any(pc.match_substring(text, '"')).as_py():
                cells = pa.array([cells_of(t) for t in text.to_pylist()], pa.list_(pa.string()))
            else:
                lists = pc.split_pattern(text, ",")
                flat = lists.flatten()
                flat = pc.if_else(pc.equal(flat, ""), pa.scalar(None, pa.string()), flat)
                cells = pa.ListArray.from_arrays(pc.subtract(lists.offsets, lists.offsets[0]), flat)
            yield pa.RecordBatch.from_arrays([batch.column("file"), batch.column("row_no"), cells], names=["file", "row_no", "cells"])

    return rows.mapInArrow(split, "file string, row_no long, cells array<string>")
