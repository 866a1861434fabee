"""Problem 1: lines repeated across one source's documents.

Every source's lines become one sequence of identifiers. Its suffixes, each compared by its first 1, 2, 4, ... lines up to
its row's end, are sorted over the whole cluster: that is the source's suffix array. Neighbours with a common prefix form a
run; a run that enough rows of the source take part in is a repeated block. A block of any other length is two such blocks
that overlap, so their lines are the lines of all repeated blocks. The sort carries the row's number as its last key, so a
line that stands in a third of all rows is split over many partitions, and runs are summed up from partial runs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmill.shared import small_side, unused, written

#: A block is repeated excessively if it occurs in this share of its source's rows and in this many of them.
MIN_SHARE, MIN_ROWS = 0.1, 6
#: Sources up to which their repeated lines are broadcast.
FEW_SOURCES = 20_000

_IDS = "src long, item long, lines array<int>, ids array<long>"
_RUN = "src long, depth int, block long, rows long, i0 long"


def line_keys(texts: pa.Array) -> pa.ListArray:
    """For each text the letters of its lines in order, whatever their case and whatever stands between them.

    Null texts give null. Lines are what lies between line feeds; one without letters gives the empty text.
    """
    small = pc.replace_substring(pc.utf8_lower(texts), "ß", "ss")
    return pc.split_pattern(pc.replace_substring_regex(small, r"[^\pL\n]+", ""), "\n")


def line_ids(keys: pa.Array) -> np.ndarray:
    """An identifier for each line key; 0 for the empty one."""
    return np.fromiter((xxhash.xxh64_intdigest(k) | 1 if k else 0 for k in keys.to_pylist()), np.uint64, len(keys)).view(np.int64)


def source_id(source: Column) -> Column:
    return F.xxhash64(F.coalesce(source, F.lit("\u0000")))


def _identify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines of each text that have letters: their numbers from 1 and their identifiers."""
    for batch in batches:
        keys = line_keys(batch.column("text"))
        offsets = keys.offsets.to_numpy().astype(np.int64)
        ids = line_ids(keys.flatten())
        numbers = np.arange(len(ids)) - np.repeat(offsets[:-1] - offsets[0], np.diff(offsets)) + 1
        kept = ids != 0
        ends = np.concatenate(([0], np.cumsum(kept)))[offsets - offsets[0]].astype(np.int32)
        lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x[kept].astype(kind))) for x, kind in ((numbers, np.int32), (ids, np.int64))]
        found = pa.RecordBatch.from_arrays([batch.column("src"), batch.column("item"), *lists], names=["src", "item", "lines", "ids"])
        yield found.filter(pa.array(np.diff(ends) > 0))


def _identified(df: DataFrame, source: str, item: str, text: str) -> DataFrame:
    rows = df.where(F.col(text).isNotNull()).select(source_id(F.col(source)).alias("src"), F.col(item).cast("long").alias("item"), F.col(text).alias("text"))
    return rows.mapInArrow(_identify, _IDS)


def _mix(h: np.ndarray, x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ x) * np.uint64(0x9E3779B97F4A7C15)
        return h ^ (h >> np.uint64(29))


def _suffixes(levels: int):
    """The suffixes of each row's lines: column k stands for their first 2^k lines, 0 where the row ends before; bit k of
    ``first`` says that these occur first here in the row."""

    def suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            offsets = ids.offsets.to_numpy()
            now = ids.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]].view(np.uint64)
            row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
            n = len(now)
            left = np.repeat(offsets[1:] - offsets[0], np.diff(offsets)) - np.arange(n)
            columns, first = [now.view(np.int64)], np.zeros(n, np.int32)
            for k in range(levels):
                inside = left >= 1 << k
                at = np.flatnonzero(inside)
                order = at[np.lexsort((at, now[at], row[at]))]
                new = np.ones(len(order), bool)
                new[1:] = (row[order][1:] != row[order][:-1]) | (now[order][1:] != now[order][:-1])
                first[order[new]] |= 1 << k
                if k + 1 < levels:
                    longer, at = np.zeros(n, np.uint64), np.flatnonzero(left >= 2 << k)
                    longer[at] = _mix(now[at] + np.uint64(k + 1), now[at + (1 << k)]) | np.uint64(1)
                    now = longer
                    columns.append(now.view(np.int64))
            src, item = (batch.column(c).to_numpy(zero_copy_only=False)[row] for c in ("src", "item"))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (src, *columns, item, first)], names=["src", *(f"i{k}" for k in range(levels)), "item", "first"])

    return suffixes


def _runs(levels: int, min_rows: int):
    """Runs of neighbouring suffixes with a common prefix of 1, 2, 4, ... lines.

    Runs inside a batch are whole and come out if enough rows take part; those at its ends may go on and always do.
    """

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            src, *ids = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("src", *(f"i{k}" for k in range(levels))))
            first = batch.column("first").to_numpy(zero_copy_only=False)
            change = np.ones(n, bool)
            change[1:] = src[1:] != src[:-1]
            out = []
            for k in range(levels):
                change = change.copy()
                change[1:] |= ids[k][1:] != ids[k][:-1]
                starts = np.flatnonzero(change)
                rows = np.add.reduceat((first >> k & 1).astype(np.int64), starts)
                keep = rows >= min_rows
                keep[0] = keep[-1] = True
                keep &= rows > 0
                at = starts[keep]
                out.append((src[at], np.full(len(at), 1 << k, np.int32), ids[k][at], rows[keep], ids[0][at]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], names=["src", "depth", "block", "rows", "i0"])

    return runs


def repeated_blocks(df: DataFrame, source: str = "source", item: str = "item_no", text: str = "content_text", min_share: float = MIN_SHARE, min_rows: int = MIN_ROWS) -> tuple[DataFrame, DataFrame]:
    """The blocks of 1, 2, 4, ... lines that occur in at least ``min_share`` of a source's rows and in ``min_rows``.

    Returns (blocks, ids): blocks (src, depth, block, rows, source_rows, i0) and the written line identifiers of every
    row (src, item, lines, ids). Blocks are as long as rows go. A row counts once for a block, however often the block
    occurs in it. Rows of a null source form a source of their own; null texts and lines without letters are no part of
    any block but their rows count. An empty table gives empty results.
    """
    ids = written(_identified(df, source, item, text), "line-ids")
    longest = ids.agg(F.max(F.size("ids"))).first()[0] or 1
    levels = int(longest).bit_length()
    columns = [f"i{k}" for k in range(levels)]
    order = ["src", *columns, "item"]
    array = ids.mapInArrow(_suffixes(levels), f"src long, {', '.join(f'{c} long' for c in columns)}, item long, first int").repartitionByRange(*order).sortWithinPartitions(*order)
    runs = array.mapInArrow(_runs(levels, min_rows), _RUN).groupBy("src", "depth", "block").agg(F.sum("rows").alias("rows"), F.min("i0").alias("i0"))
    sizes = df.groupBy(source_id(F.col(source)).alias("src")).agg(F.count(F.lit(1)).alias("source_rows"))
    blocks = runs.where(F.col("rows") >= min_rows).join(sizes, "src").where(F.col("rows") >= F.col("source_rows") * F.lit(min_share))
    return written(blocks.select("src", "depth", "block", "rows", "source_rows", "i0"), "blocks"), ids


def repeated_lines(df: DataFrame, source: str = "source", item: str = "item_no", text: str = "content_text", min_share: float = MIN_SHARE, min_rows: int = MIN_ROWS) -> DataFrame:
    """(item, line_no) of every line that belongs to a repeated block.

    Every line of a block that spans enough rows spans as many by itself, so the blocks of one line name them all.
    """
    blocks, ids = repeated_blocks(df, source, item, text, min_share, min_rows)
    single = blocks.where("depth = 1").select("src", F.col("i0").alias("id"))
    lines = ids.select("src", "item", F.explode(F.arrays_zip("lines", "ids")).alias("x")).select("src", "item", F.col("x.lines").alias("line_no"), F.col("x.ids").alias("id"))
    return lines.join(small_side(single), ["src", "id"], "left_semi").select(F.col("item").alias(item), F.col("line_no").cast("long").alias("line_no"))


def repeated_ids(df: DataFrame, source: str = "source", item: str = "item_no", text: str = "content_text") -> DataFrame:
    """(src, ids): the identifiers of the lines that belong to repeated blocks of each source."""
    blocks, _ = repeated_blocks(df, source, item, text)
    # a source has at most lines-a-row / min_share such lines: the arrays are short, however large the source is
    return written(blocks.where("depth = 1").groupBy("src").agg(F.collect_set("i0").alias("ids")), "repeated-ids")


def with_repeated_ids(df: DataFrame, out: str, source: str = "source", item: str = "item_no", text: str = "content_text", frequent: DataFrame | None = None) -> DataFrame:
    """``df`` with ``out``: the identifiers of the lines that belong to repeated blocks of its source, as an array; of the
    sources of ``df``, unless ``frequent`` has what ``repeated_ids`` found in a larger table, with a hint if it is small."""
    frequent = small_side(repeated_ids(df, source, item, text), FEW_SOURCES) if frequent is None else frequent
    src = unused(df, "_src")
    named = frequent.select(F.col("src").alias(src), F.col("ids").alias(out))
    return df.withColumn(src, source_id(F.col(source))).join(named, src, "left").drop(src)


def repeated_numbers(texts: pa.Array, ids: list[list[int] | None]) -> list[frozenset[int]]:
    """For each text the numbers, from 1, of the lines whose identifiers are among its source's repeated ones."""
    keys = line_keys(texts)
    offsets = keys.offsets.to_numpy().astype(np.int64)
    flat = line_ids(keys.flatten())
    # identifiers of any source first: few lines are left to compare with those of their own
    some = np.isin(flat, np.unique(np.array([x for row in ids if row for x in row], np.int64)))
    out: list[frozenset[int]] = [frozenset()] * len(texts)
    rows = np.searchsorted(offsets - offsets[0], np.flatnonzero(some), side="right") - 1
    for row, at in zip(rows.tolist(), np.flatnonzero(some).tolist()):
        if ids[row] and flat[at] in ids[row]:
            out[row] = out[row] | {at - int(offsets[row] - offsets[0]) + 1}
    return out


def without_repeated(df: DataFrame, source: str = "source", item: str = "item_no", text: str = "content_text") -> DataFrame:
    """``df`` with the lines of repeated blocks taken out of every text; all other lines and columns stay as they are.

    A text of which all lines go becomes the empty text; a null text stays null.
    """
    ids = unused(df, "_ids")
    marked = with_repeated_ids(df, ids, source, item, text)

    @F.pandas_udf("string")
    def keep(texts: pd.Series, ids: pd.Series) -> pd.Series:
        out = repeated_numbers(pa.array(texts, pa.string(), from_pandas=True), [list(x) if x is not None else None for x in ids])
        return pd.Series([t if not gone else "\n".join(x for n, x in enumerate(t.split("\n"), 1) if n not in gone) for t, gone in zip(texts, out)], dtype=object)

    return marked.withColumn(text, F.when(F.col(ids).isNotNull() & F.col(text).isNotNull(), keep(F.col(text), F.col(ids))).otherwise(F.col(text))).drop(ids)
