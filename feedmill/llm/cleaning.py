"""What problems 2, 3, 4, 6 and 7 share: one pass over texts that decodes, spells and judges them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.llm import encoding, mainbody, repeats, spelling
from feedmill.llm.encoding import Repairer
from feedmill.llm.residue import residue_flags


#: Rows that are worked on at once.
ROWS_AT_ONCE = 2000


def marked(df: DataFrame, source: str = "source", item: str = "item_no", text: str = "content_text", keep: tuple[str, ...] = (), frequent: DataFrame | None = None) -> DataFrame:
    """What ``judged`` needs of each row: its text and the identifiers of its source's repeated lines."""
    rows = df.select(F.col(item).cast("long").alias("item"), F.col(text).alias("text"), F.col(source).alias("source"), *keep)
    return repeats.with_repeated_ids(rows, "_ids", "source", "item", "text", frequent).select("item", "text", "_ids", *keep)


def holds(texts: pa.Array, pattern: str) -> np.ndarray:
    """Whether each text holds the pattern; null texts don't."""
    return pc.fill_null(pc.match_substring_regex(texts, pattern), False).to_numpy(zero_copy_only=False)


def restored(texts: pa.Array, repairer: Repairer) -> list[str | None]:
    """The texts, decoded rightly and in one spelling."""
    garbled, misspelt = holds(texts, encoding.SIGNS), holds(texts, spelling.SIGNS)
    out = texts.to_pylist()
    for i in np.flatnonzero(garbled):
        out[i] = repairer.restore(out[i])[0]
    for i in np.flatnonzero(misspelt | garbled):
        out[i] = spelling.normalise(out[i])
    return out


def judged(batches: Iterator[pa.RecordBatch], repairer: Repairer) -> Iterator[tuple[pa.RecordBatch, list]]:
    """For each batch, the rows' (lines, own, repeated); None for rows that are null, blank or residue.

    ``own`` says of each line whether it is the article's; ``repeated`` holds numbers from 1.
    """
    for whole in batches:
        for k in range(0, whole.num_rows, ROWS_AT_ONCE):
            batch = whole.slice(k, ROWS_AT_ONCE)
            texts = restored(batch.column("text"), repairer)
            residue = residue_flags(pa.array(texts, type=pa.string()))
            repeated = repeats.repeated_numbers(batch.column("text"), batch.column("_ids").to_pylist())
            rows: list = []
            for text, bad, lines_out in zip(texts, residue, repeated):
                if bad or not text or not text.strip():
                    rows.append(None)
                    continue
                lines = text.split("\n")
                rows.append((lines, mainbody.own_lines(lines), lines_out))
            yield batch, rows


def surrounding_lines(df: DataFrame, repairer: Repairer, source: str = "source", item: str = "item_no", text: str = "content_text") -> DataFrame:
    """(item, line_no) of the lines with text that are not the article's own, without those that repeat in their source.

    Null and blank texts and residue have no such lines. Lines are numbered from 1, blank ones included.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, rows in judged(batches, repairer):
            items, numbers = [], []
            for key, row in zip(batch.column("item").to_pylist(), rows):
                if row:
                    lines, own, repeated = row
                    found = [n for n, (line, mine) in enumerate(zip(lines, own), 1) if not mine and n not in repeated and line.strip()]
                    items += [key] * len(found)
                    numbers += found
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.int64()), pa.array(numbers, pa.int64())], names=["item", "line_no"])

    return marked(df, source, item, text).mapInArrow(find, "item long, line_no long").withColumnRenamed("item", item)


def bodies(df: DataFrame, repairer: Repairer, source: str = "source", item: str = "item_no", text: str = "content_text") -> DataFrame:
    """(item, body): the article's own lines of every text; null for null texts, empty for blank ones and residue."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, rows in judged(batches, repairer):
            was = batch.column("text").to_pylist()
            out = [None if t is None else "" if row is None else "\n".join(x for n, (x, mine) in enumerate(zip(row[0], row[1]), 1) if mine and n not in row[2]) for t, row in zip(was, rows)]
            yield pa.RecordBatch.from_arrays([batch.column("item"), pa.array(out, pa.string())], names=["item", "body"])

    return marked(df, source, item, text).mapInArrow(keep, "item long, body string").withColumnRenamed("item", item)


def residue_items(df: DataFrame, repairer: Repairer | None = None, item: str = "item_no", text: str = "content_text") -> DataFrame:
    """(item) of the rows whose text is template residue, filler, an error page or a script notice.

    With a repairer, texts are judged as they read when they are decoded rightly. Null and blank texts are no such rows.
    """
    rows = df.select(F.col(item).cast("long").alias("item"), F.col(text).alias("text")).where(F.col("text").rlike(r"\S"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                texts = batch.column("text").cast(pa.string())
                flags = residue_flags(pa.array(restored(texts, repairer), pa.string()) if repairer else texts)
                yield pa.RecordBatch.from_arrays([batch.column("item").filter(pa.array(flags))], names=["item"])

    return rows.mapInArrow(find, "item long").withColumnRenamed("item", item)


def garbled_fields(df: DataFrame, repairer: Repairer, fields: tuple[str, ...] = ("title", "content_text"), item: str = "item_no", pattern: str = encoding.SIGNS) -> DataFrame:
    """(item, field_name, restored) of the fields of which at least one passage was decoded wrongly."""
    one = F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).alias("text")) for f in fields])
    rows = df.select(F.col(item).cast("long").alias("item"), F.explode(one).alias("x")).select("item", "x.field_name", "x.text").where("text is not null")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(holds(batch.column("text"), pattern)))
            out = [(i, f, *repairer.restore(t)) for i, f, t in zip(*(batch.column(c).to_pylist() for c in ("item", "field_name", "text")))]
            out = [(i, f, t) for i, f, t, bad in out if bad]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], kind) for k, kind in enumerate((pa.int64(), pa.string(), pa.string()))], names=["item", "field_name", "restored"])

    return rows.mapInArrow(find, "item long, field_name string, restored string").withColumnRenamed("item", item)


def misspelt_fields(df: DataFrame, repairer: Repairer, fields: tuple[str, ...] = ("title", "content_text"), item: str = "item_no") -> DataFrame:
    """(item, field_name) of the fields that hold a form of problem 6 and no wrong decoding."""
    one = F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).alias("text")) for f in fields])
    rows = df.select(F.col(item).cast("long").alias("item"), F.explode(one).alias("x")).select("item", "x.field_name", "x.text").where("text is not null")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(holds(batch.column("text"), spelling.SIGNS)))
            keep = spelling.per_distinct(lambda t: spelling.respelt(t) and not repairer.restore(t)[1], batch.column("text"), pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in ("item", "field_name")], names=["item", "field_name"])

    return rows.mapInArrow(find, "item long, field_name string").withColumnRenamed("item", item)
