"""Blocked cross products of mixed columns.

For pairs of columns the table is read once: of every Arrow batch the cross
products of each pair are summed with numpy (the block of the Gram matrix that
two numbers, a number and a one-hot category, or two one-hot categories span,
its non-zero cells only), and Spark adds the sums up by cell. A row is never
repeated for a pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DENSE_CELLS = 1 << 16  # cells of a pair's block that are counted in an array; larger ones by sorting
CELLS = "pair int, va string, vb string, n long, a double, b double, aa double, bb double, ab double"
SUMS = ("n", "a", "b", "aa", "bb", "ab")


def _cells(codes_a: np.ndarray, codes_b: np.ndarray, width_b: int, total: int) -> tuple[np.ndarray, np.ndarray]:
    """(key, rows) of the non-empty cells of two coded columns."""
    key = codes_a * width_b + codes_b
    if total <= DENSE_CELLS:
        count = np.bincount(key, minlength=total)
        return np.flatnonzero(count), count[count > 0]
    return np.unique(key, return_counts=True)


def batch_products(columns: list, numeric: list[bool], pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    """The cells of one batch. A number comes as (values, present), a category
    as (codes, -1 where it is null, names)."""
    pair, va, vb, sums = [], [], [], {c: [] for c in SUMS}

    def put(k, names_a, names_b, **cells):
        size = len(cells["n"])
        pair.append(np.full(size, k, np.int32))
        va.extend(names_a or [None] * size)
        vb.extend(names_b or [None] * size)
        for c in SUMS:
            sums[c].append(np.asarray(cells.get(c, np.zeros(size)), np.int64 if c == "n" else np.float64))

    for k, (i, j) in enumerate(pairs):
        (x, x_set), (y, y_set) = columns[i][:2], columns[j][:2]
        if numeric[i] and numeric[j]:
            both = x_set & y_set
            x, y = x[both], y[both]
            put(k, None, None, n=[len(x)], a=[x.sum()], b=[y.sum()], aa=[x @ x], bb=[y @ y], ab=[x @ y])
        elif numeric[i] or numeric[j]:
            (codes, _, names), (value, present) = (columns[j], columns[i]) if numeric[i] else (columns[i], columns[j])
            both = present & (codes >= 0)
            codes, value = codes[both], value[both]
            n = np.bincount(codes, minlength=len(names))
            held = np.flatnonzero(n)
            put(k, [names[c] for c in held], None, n=n[held], a=np.bincount(codes, value, len(names))[held],
                aa=np.bincount(codes, value * value, len(names))[held])
        else:
            names_a, names_b = columns[i][2], columns[j][2]
            both = (x >= 0) & (y >= 0)
            key, n = _cells(x[both], y[both], len(names_b), len(names_a) * len(names_b))
            put(k, [names_a[c] for c in key // max(len(names_b), 1)], [names_b[c] for c in key % max(len(names_b), 1)], n=n)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(pair), pa.int32()), pa.array(va, pa.string()), pa.array(vb, pa.string()),
         *(pa.array(np.concatenate(sums[c])) for c in SUMS)], names=["pair", "va", "vb", *SUMS])


def cross_products(df: DataFrame, numeric: list, categorical: list, pairs: list, centres: dict) -> DataFrame:
    """(pair, va, vb, n, a, b, aa, bb, ab) of the (name, name) ``pairs`` over
    the rows where both columns are set: for two numbers one row of sums (less
    the columns' ``centres``), for a category and a number a row a value with
    the number's sums in a and aa, for two categories a row a cell."""
    names = [*numeric, *categorical]
    is_number = [True] * len(numeric) + [False] * len(categorical)
    at = {c: i for i, c in enumerate(names)}
    places = [(at[a], at[b]) for a, b in pairs]
    middle = [float(centres.get(c) or 0.0) for c in numeric]

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            if not batch.num_rows:
                continue
            columns: list = []
            for i, column in enumerate(batch.columns):
                if is_number[i]:
                    present = np.asarray(column.is_valid())
                    columns.append((np.where(present, column.fill_null(0.0).to_numpy(), 0.0) - middle[i], present))
                else:
                    coded = column.dictionary_encode()
                    columns.append((coded.indices.fill_null(-1).to_numpy().astype(np.int64), None, coded.dictionary.to_pylist()))
            yield batch_products(columns, is_number, places)

    typed = df.select(*[F.col(c).cast("double") for c in numeric], *[F.col(c).cast("string") for c in categorical])
    return typed.mapInArrow(batches, CELLS).groupBy("pair", "va", "vb").agg(*[F.sum(c).alias(c) for c in SUMS])
