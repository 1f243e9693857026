"""Frames, weighted sums and detrended boxes over Arrow batches of rows in block order.

A batch holds many short blocks; each operation runs over all of them at once, and a
row that has too few rows of its block before it is masked.  Sums and extremes of many
rows come from those of half as many, so no sum is longer than its frame and nothing
is taken off again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T


class Held(NamedTuple):
    """A column: its doubles, NaN for what is null, and what is null."""

    x: np.ndarray
    null: np.ndarray


class Blocks:
    """A table of whole blocks; ``place`` counts a row's block from 0."""

    def __init__(self, table: pa.Table):
        self.table, self.made = table, {}
        new = self.starts(table)
        at = np.arange(table.num_rows)
        self.first = np.maximum.accumulate(np.where(new, at, 0))
        self.place = at - self.first

    @staticmethod
    def starts(table: pa.Table) -> np.ndarray:
        """Whether a row begins a block."""
        new = np.ones(table.num_rows, bool)
        for c in ("__key", "__block"):
            x = table[c].chunk(0)
            differs = pc.not_equal(x.slice(1), x.slice(0, len(x) - 1)).to_numpy(zero_copy_only=False)
            new[1:] = differs if c == "__key" else new[1:] | differs
        return new

    def column(self, name: str) -> pa.Array:
        return self.made[name] if name in self.made else self.table[name].chunk(0)

    def doubles(self, name: str) -> np.ndarray:
        """Doubles, NaN for what is null."""
        return self.column(name).cast(pa.float64(), safe=False).to_numpy(zero_copy_only=False)

    def held(self, name: str) -> Held:
        return Held(self.doubles(name), self.column(name).is_null().to_numpy(zero_copy_only=False))

    def values(self, name: str) -> np.ndarray:
        """Doubles, NaN for what is null or not finite."""
        x = self.doubles(name).copy()
        x[~np.isfinite(x)] = np.nan
        return x

    def true(self, name: str) -> np.ndarray:
        return self.column(name).to_numpy(zero_copy_only=False).astype(bool)

    def put(self, name: str, x: np.ndarray) -> None:
        self.made[name] = pa.array(x, mask=np.isnan(x)) if x.dtype == float else pa.array(x)

    def check(self) -> None:
        """Of a time of a key there is one row, and the rows of an earlier part come first."""
        at, own = self.table["__at"].chunk(0), self.true("__own")
        if len(at) > 1:
            a, b = at.slice(1), at.slice(0, len(at) - 1)
            same = pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(a.is_null(), b.is_null())).to_numpy(zero_copy_only=False)
            follows = self.place[1:] > 0
            for wrong, what in ((follows & own[:-1] & ~own[1:], "not after the stored rows"), (follows & same & (own[:-1] == own[1:]), "repeated"), (follows & same, "not after the stored rows")):
                if wrong.any():
                    k = int(np.flatnonzero(wrong)[0]) + 1
                    raise ValueError(f"{what}: {self.table['__key'].chunk(0)[k].as_py()}, {at[k].as_py()}")

    def lag(self, name: str, rows: int) -> pa.Array:
        at = np.arange(len(self.place)) - rows
        return self.column(name).take(pa.array(np.maximum(at, 0), mask=self.place < rows))


def beside(table: pa.Table, names: tuple[str, ...]) -> pa.Table:
    """Without the rows marked ``__beside``, whose values of ``names`` go to the row before them, the one they belong to."""
    more = table["__beside"].chunk(0).to_numpy(zero_copy_only=False).astype(bool)
    at = np.flatnonzero(~more)
    has = np.append(more[1:], False)[at]
    own, after = pa.array(at), pa.array(np.minimum(at + 1, max(table.num_rows - 1, 0)), mask=~has)
    kept = [c for c in table.column_names if c != "__beside"]
    return pa.table({c: table[c].chunk(0).take(after if c in names else own) for c in kept})


def appended(frame: DataFrame, fields: list[T.StructField], work: Callable[[Blocks], None], keep: str | None = None, drop: tuple[str, ...] = (), more: tuple[str, ...] = ()) -> DataFrame:
    """``frame``, whose partitions hold rows in block order, with the columns that ``work`` puts; the order stays.

    Only rows for which ``keep`` holds are given back, and not the columns ``drop``.
    The columns ``more`` come in rows of their own, see ``beside``.
    """
    drop = (*drop, "__beside") if more else drop
    names, new = [c for c in frame.columns if c not in {f.name for f in fields} | set(drop)], [f.name for f in fields if f.name not in drop]
    fields = [f for f in fields if f.name not in drop]
    schema = T.StructType([frame.schema[c] for c in names] + fields)

    def done(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches).combine_chunks()
        blocks = Blocks(beside(table, more).combine_chunks() if more else table)
        work(blocks)
        columns = [blocks.column(c) for c in names] + [blocks.made[c] for c in new]
        if keep is not None:
            held = pa.array(blocks.true(keep))
            columns = [c.filter(held) for c in columns]
        yield pa.RecordBatch.from_arrays(columns, [*names, *new])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if batch.num_rows == 0:
                continue
            held.append(batch)
            table = pa.Table.from_batches(held).combine_chunks()
            last = int(np.flatnonzero(Blocks.starts(table))[-1])  # the last block may go on in the next batch
            held = [b for b in table.to_batches() if b.num_rows]
            if last:
                yield from done(table.slice(0, last).to_batches())
                held = table.slice(last).to_batches()
        if held:
            yield from done(held)

    return frame.mapInArrow(run, schema)


def shifted(x: np.ndarray, rows: int) -> np.ndarray:
    out = np.full_like(x, np.nan)
    if rows < len(x):
        out[rows:] = x[: len(x) - rows]
    return out


def rolled(x: np.ndarray, n: int, op: Callable, step: int = 1) -> np.ndarray:
    """``op`` over the last ``n`` values that are ``step`` rows apart."""
    out, had, size = None, 0, 1
    while True:
        if n & size:
            out = x if out is None else op(out, shifted(x, had * step))
            had += size
        if size * 2 > n:
            return out
        x = op(x, shifted(x, size * step))
        size *= 2


def frame_value(x: np.ndarray, place: np.ndarray, how: str, n: int) -> np.ndarray:
    """The mean, extreme or deviation of the last ``n`` rows of a block; NaN if there are fewer or one has no value.

    ``some`` is the mean of those of them that have a value.
    """
    if how == "some":
        has = ~np.isnan(x)
        count = rolled(has.astype(float), n, np.add)
        out = np.where(count > 0, rolled(np.where(has, x, 0.0), n, np.add) / np.where(count > 0, count, 1.0), np.nan)
    elif how == "std":
        out = np.full_like(x, np.nan)
        if 1 < n <= len(x):
            out[n - 1 :] = np.lib.stride_tricks.sliding_window_view(x, n).std(axis=1, ddof=1)
    else:
        out = rolled(x, n, {"mean": np.add, "min": np.minimum, "max": np.maximum}[how]) / (n if how == "mean" else 1)
    return np.where(place >= n - 1, out, np.nan)


def decayed(x: np.ndarray, place: np.ndarray, w: float) -> np.ndarray:
    """Sums of a block's values so far, each taken times ``w`` per place of age."""
    size, most = 1, int(place.max(initial=0))
    while size <= most:
        x = x + np.where(place >= size, w**size * shifted(x, size), 0.0)
        size *= 2
    return x


class Sums:
    """The values of a column in a block's own rows so far: how many, their decayed sums and the first of them."""

    def __init__(self, blocks: Blocks, source: str):
        x, own = blocks.values(source), blocks.true("__own")
        has = own & ~np.isnan(x)
        upto = np.cumsum(has)
        self.seen = upto - (upto - has)[blocks.first]
        self.values, self.places = x[has], self.seen[has] - 1
        self.some, self.newest, self.oldest = self.seen > 0, np.maximum(upto - 1, 0), upto - self.seen

    def decayed(self, w: float) -> np.ndarray:
        return np.where(self.some, decayed(self.values, self.places, w)[self.newest], 0.0) if len(self.values) else np.zeros(len(self.seen))

    def first(self) -> np.ndarray:
        return np.where(self.some, self.values[self.oldest.clip(max=len(self.values) - 1)], np.nan) if len(self.values) else np.full(len(self.seen), np.nan)


def box_exponents(z: np.ndarray, place: np.ndarray, window: int, scales: tuple[int, ...], reverse: bool) -> np.ndarray:
    """Slope of the log fluctuation of detrended boxes over their log size, in the last ``window`` values; see ``fractal``."""
    c = np.zeros_like(z)
    edges = [*np.flatnonzero(place == 0), len(z)]
    for a, b in zip(edges, edges[1:], strict=False):
        held = z[a:b][~np.isnan(z[a:b])]
        c[a:b] = np.cumsum(np.nan_to_num(z[a:b] - (held.mean() if len(held) else 0.0)))
        c[a:b] -= c[a:b].mean()
    x = place.astype(float)
    n, sx, sxx, sy, sxy = (np.zeros_like(z) for _ in range(5))
    for s in scales:
        y, yy, xy = rolled(c, s, np.add), rolled(c * c, s, np.add), rolled(x * c, s, np.add)
        xy = xy - (x - (s - 1) / 2) * y
        residual = np.maximum(yy - y * y / s - xy * xy / (s * (s * s - 1) / 12), 0.0)
        boxes = window // s
        sums = rolled(residual, boxes, np.add, s)
        total = shifted(sums, window - boxes * s) + (sums if reverse else 0.0)
        f2 = total / ((2 if reverse else 1) * boxes * s)
        known = f2 > 0
        log = np.where(known, 0.5 * np.log(np.where(known, f2, 1.0)), 0.0)
        lx = np.log(float(s))
        n, sx, sxx, sy, sxy = n + known, sx + known * lx, sxx + known * lx * lx, sy + log, sxy + lx * log
    below = n * sxx - sx * sx
    full = (place >= window - 1) & ~np.isnan(rolled(z, window, np.add)) & (n >= 3) & (below != 0)
    return np.where(full, (n * sxy - sx * sy) / np.where(full, below, 1.0), np.nan)
