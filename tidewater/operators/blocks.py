"""Series in blocks: rolling and weighted columns whose work splits within a key.

The rows of a key that has at most a block of them are its one block.  Rows of longer
keys are numbered along their order and cut into blocks of ``ROWS`` rows; a block
carries the last rows of the block before it, as many as the widest frame reaches
back.  Numbers come from counts by (key, stretch of time), so no task needs a key's
whole history.  Series are written once, as several passes read them, unless they are
read from files as they are.  A repeated (key, time) is an error found in the passes.

Tasks get whole blocks with their rows in order, sorted once, and go over them in
Arrow batches (``arrays``):

* means, extremes and deviations: from those of half as many rows, so a small value
  after a large one loses nothing;
* weighted means: decayed sums within the block.  What a block adds up to decays over
  the values of the blocks after it; those carries are summed by cells of so many values
  that whatever is older than two cells has decayed below the last bit, and are joined
  to the rows before anything is made of them;
* what is made across keys comes back as rows of its own, dealt with the series and put
  beside its rows in the same pass, so that no side is shuffled for a join.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.operators import arrays
from tidewater.operators.panel import stretch
from tidewater.sources.datasets import cut

ROWS = 4096
#: Weights below exp(-SPENT) times the newest one do not change a double.
SPENT = 41.5

#: (source column, alpha, min_periods, output): a weighted mean; nulls take no weight, it
#: stands still over them; a fifth entry asks for the recursive form.
#: (source column, 'mean' | 'min' | 'max' | 'std', rows, output): an aggregate of the last
#: rows, null until all of them have a value.  (source column, 'some', rows, output): the mean of those that
#: have a value.  (source column, 'lag', rows, output).  (source column, 'exponent', rows, output, scales, reverse):
#: see ``fractal``.
#: (names of columns, expression over them, None, output): a column of the row's own values; a fifth entry
#: makes the same of ``arrays.Held`` columns, and so in the pass of the steps that read it.
Step = tuple


def in_order(frame: DataFrame, ranges: bool = False) -> DataFrame:
    """Whole blocks to a task, rows in order; with ``ranges`` tasks follow the order of keys too.

    The rows are dealt by a hash of their own: Spark would take the deal of a join before
    for one by the same columns, and may give that up for a broadcast while it runs.
    """
    dealt = frame.repartitionByRange("__key", "__block") if ranges else frame.repartition(F.xxhash64("__key", "__block"))
    return dealt.sortWithinPartitions("__key", "__block", "__at", *[c for c in ("__beside",) if c in frame.columns])


def _name(df: DataFrame, key: str) -> Column:
    """A key that is never null: of a string its text after a '=', so that it need not be kept beside it."""
    return F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit(""))


def _named(df: DataFrame, key: str, time: str) -> DataFrame:
    """``df`` with ``__key`` and ``__at``, without the columns that these stand for."""
    gone = (key, time) if isinstance(df.schema[key].dataType, T.StringType) else (time,)
    return df.withColumns({"__key": _name(df, key), "__at": F.col(time)}).drop(*gone)


def _back(df: DataFrame, key: str, time: str) -> DataFrame:
    """The key and the time under their names."""
    own = {} if key in df.columns else {key: F.when(F.col("__key") != "", F.substring("__key", 2, 2**31 - 1))}
    return df.withColumns(own | {time: F.col("__at")})


def numbered(df: DataFrame, key: str = "ticker", time: str = "date") -> DataFrame:
    """``df`` with ``__key``, ``__row`` (from 0 along ``time``, nulls first) and ``__rows`` of the key.

    Two rows with one (key, time) raise an error when the plan runs.  A null key is a
    key of its own.
    """
    slotted = df.withColumns({"__key": F.coalesce(F.col(key).cast("string"), F.lit("\x00")), "__slot": F.coalesce(stretch(df, time), F.lit(-(2**31))).cast("long")})
    counts = slotted.groupBy("__key", "__slot").agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.partitionBy("__key").orderBy("__slot").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("__key", "__slot", F.coalesce(before, F.lit(0)).alias("__first"), F.sum("__n").over(Window.partitionBy("__key")).alias("__rows"))
    inside = Window.partitionBy("__key", "__slot").orderBy(time)
    twice = F.lag(F.struct(time)).over(inside) == F.struct(time)
    place = F.when(twice, F.raise_error(F.concat(F.lit(f"repeated ({key}, {time}): "), F.col("__key"), F.lit(", "), F.col(time).cast("string")))).otherwise(F.row_number().over(inside) - 1)
    return slotted.join(starts, ["__key", "__slot"]).withColumn("__row", F.col("__first") + place).drop("__slot", "__first")


def lay(df: DataFrame, reach: int, key: str = "ticker", time: str = "date", rows: int = ROWS, tail: DataFrame | None = None, written: bool = False) -> DataFrame:
    """Rows with ``__key``, ``__at`` and ``__block``, and in blocks after the first of a key the last ``reach`` rows before it; read from files.

    ``__own`` tells a block's own rows, ``__end`` the last block of a key.  ``tail`` has
    the rows before those of ``df``, by ``__key`` and ``__row`` from -1 down, and must
    end before they begin.  ``written`` rows are read from files as they are.
    """
    held = df if written else cut(df, "series")
    sizes = held.groupBy(_name(held, key).alias("__key")).agg(F.count("*").alias("__rows"))
    long = cut(sizes.where(F.col("__rows") > rows), "long")
    whole = {"__block": F.lit(0).cast("long"), "__own": F.lit(True), "__end": F.lit(True)}
    single = _named(held, key, time).withColumns(whole)
    before = None if tail is None else _named(tail.drop("__key", "__row"), key, time).withColumns(whole | {"__own": F.lit(False)})
    if not long.take(1):
        return single if before is None else single.unionByName(before)
    keys = long.select("__key")
    out = _several(held.withColumn("__key", _name(held, key)).join(keys, "__key", "left_semi"), reach, key, time, rows, tail)
    for part in (single, before):
        if part is not None:
            out = out.unionByName(part.join(keys, "__key", "left_anti"))
    return cut(out, "blocks")


def _several(df: DataFrame, reach: int, key: str, time: str, rows: int, tail: DataFrame | None) -> DataFrame:
    """The blocks of keys that have more rows than one takes."""
    number = numbered(df.drop("__key"), key, time)
    if tail is not None:
        sizes = number.groupBy("__key", F.col(key).alias("__was")).agg(F.first("__rows").alias("__rows"))
        earlier = tail.drop("__key").join(sizes, F.col(key).eqNullSafe(F.col("__was"))).drop("__was")
        number = number.unionByName(earlier.select(*number.columns))
    block, end = F.floor(F.col("__row") / rows), F.floor((F.col("__rows") - 1) / rows)
    blocks = F.sequence(F.greatest(block, F.lit(0)), F.least(F.floor((F.col("__row") + reach) / rows), end))
    spread = number.where(F.col("__row") + reach >= 0).withColumn("__block", F.explode(blocks))
    spread = spread.withColumns({"__own": F.col("__block") == block, "__end": F.col("__block") == end}).drop("__rows", "__row", "__key")
    return _named(spread, key, time)


# --- one pass ------------------------------------------------------------------

def _passed(frame: DataFrame, steps: list[Step], carries: dict[str, str], keep: str | None, drop: tuple[str, ...], beside: tuple[str, ...] = ()) -> DataFrame:
    """Frames, lags, weighted means and array forms over rows in order; a step may read an earlier one's output.

    ``carries`` names, for a weighted mean, the columns with what earlier blocks left.
    """
    kinds = {f.name: f.dataType for f in frame.schema.fields}
    plain = []
    for source, how, n, out, *more in steps:
        how = "array" if isinstance(how, Column) else how
        kinds[out] = kinds[source] if how == "lag" else T.DoubleType()
        plain.append((source, how, n, out, more))

    def work(blocks: arrays.Blocks) -> None:
        blocks.check()
        sums: dict[str, arrays.Sums] = {}
        for source, how, n, out, more in plain:
            if how == "array":
                blocks.put(out, more[0](*[blocks.held(c) for c in source]))
            elif how == "lag":
                blocks.made[out] = blocks.lag(source, n)
            elif how == "exponent":
                blocks.put(out, arrays.box_exponents(blocks.values(source), blocks.place, n, *more))
            elif isinstance(how, str):
                blocks.put(out, arrays.frame_value(blocks.values(source), blocks.place, how, n))
            else:
                if source not in sums:
                    sums[source] = arrays.Sums(blocks, source)
                blocks.put(out, _weighted(blocks, sums[source], how, n, bool(more), carries.get(out)))

    gone = tuple(c for c in frame.columns if c.startswith("__was")) if keep else ()
    return arrays.appended(frame, [T.StructField(out, kinds[out]) for *_, out, _ in plain], work, keep, (*gone, *drop), beside)


def _weighted(blocks: arrays.Blocks, sums: arrays.Sums, alpha: float, least: int, plain: bool, carry: str | None) -> np.ndarray:
    """A weighted mean, in the recursive form if it is ``plain``, with what earlier blocks left in ``carry``'s columns."""
    n, w = sums.seen.astype(float), 1 - alpha
    total, first = sums.decayed(w), sums.first() if plain else None
    if carry is not None:
        was = {c: blocks.doubles(carry.format(c)) for c in ("sum", "n", "first")}
        total = total + w**n * np.nan_to_num(was["sum"])
        n = n + np.nan_to_num(was["n"])
        first = np.where(np.isnan(was["first"]), first, was["first"]) if plain else None
    value = alpha * total + w**n * first if plain else total * alpha / -np.expm1(np.maximum(n, 1) * math.log1p(-alpha))
    return np.where(n >= max(1, least), value, np.nan)


# --- weighted means ----------------------------------------------------------

def _running(frame: DataFrame, steps: list[Step]) -> DataFrame:
    """Of a block's own rows so far, over rows in order: counts ``__c`` and first values ``__f`` by source, decayed sums ``__s`` by step."""
    sources = {s: k for k, s in enumerate(dict.fromkeys(s for s, *_ in steps))}
    weights = [(i, sources[s], 1 - alpha) for i, (s, alpha, *_) in enumerate(steps)]
    firsts = sorted({sources[s] for s, _, _, _, *plain in steps if plain})

    def work(blocks: arrays.Blocks) -> None:
        for source, k in sources.items():
            sums = arrays.Sums(blocks, source)
            blocks.put(f"__c{k}", sums.seen.astype(np.int64))
            for i, of, w in weights:
                if of == k:
                    blocks.put(f"__s{i}", sums.decayed(w))
            if k in firsts:
                blocks.put(f"__f{k}", sums.first())

    fields = [T.StructField(f"__c{k}", T.LongType()) for k in sources.values()] + [T.StructField(f"__s{i}", T.DoubleType()) for i, *_ in weights]
    return arrays.appended(frame, fields + [T.StructField(f"__f{k}", T.DoubleType()) for k in firsts], work)


def _left(totals: DataFrame, steps: list[Step], stored: DataFrame | None) -> DataFrame:
    """What each block and those before it leave: (__key, __block, i, seen, left, first) for each step i.

    ``stored`` has such rows by the name of the step, from before the first block.
    """
    sources = {s: k for k, s in enumerate(dict.fromkeys(s for s, *_ in steps))}
    state, constants = [], []
    for i, (source, alpha, _, name, *plain) in enumerate(steps):
        k = sources[source]
        w, cell = F.lit(1 - alpha), F.lit(math.ceil(SPENT / -math.log1p(-alpha))).cast("long")
        constants.append(F.struct(F.lit(i).alias("i"), F.lit(name).alias("step"), w.alias("w"), cell.alias("cell_n")))
        first = F.col(f"__f{k}") if plain else F.lit(None).cast("double")
        state.append(F.struct(F.lit(i).alias("i"), w.alias("w"), cell.alias("cell_n"), F.col(f"__c{k}").alias("n"), F.col(f"__s{i}").alias("sum"), first.alias("first")))
    last = totals.where("__own").groupBy("__key", "__block").agg(F.max_by(F.array(*state), F.struct("__at")).alias("s"))
    long = last.select("__key", "__block", F.explode("s").alias("s")).select("__key", "__block", "s.*")
    if stored is not None:
        known = stored.withColumn("c", F.explode(F.array(*constants))).where("step = c.step")
        long = long.unionByName(known.select("__key", F.lit(-1).cast("long").alias("__block"), "c.i", "c.w", "c.cell_n", F.col("seen").alias("n"), F.col("left").alias("sum"), "first"))
    upto = Window.partitionBy("__key", "i").orderBy("__block").rowsBetween(Window.unboundedPreceding, 0)
    long = long.withColumns({"seen": F.sum("n").over(upto), "first": F.first("first", ignorenulls=True).over(upto)}).withColumn("cell", F.floor(F.col("seen") / F.col("cell_n")))
    long = long.withColumn("lifted", F.col("sum") * F.pow("w", -(F.col("seen") - F.col("cell") * F.col("cell_n"))))
    cells = long.groupBy("__key", "i", "cell").agg(F.sum("lifted").alias("older")).withColumn("cell", F.col("cell") + 1)
    inside = Window.partitionBy("__key", "i", "cell").orderBy("__block").rowsBetween(Window.unboundedPreceding, 0)
    long = long.withColumn("newer", F.sum("lifted").over(inside)).join(cells, ["__key", "i", "cell"], "left")
    age = F.col("seen") - F.col("cell") * F.col("cell_n")
    left = F.pow("w", age) * F.col("newer") + F.coalesce(F.pow("w", age + F.col("cell_n")) * F.col("older"), F.lit(0.0))
    return long.select("__key", "__block", "i", "seen", left.alias("left"), "first")


def _carries(totals: DataFrame, steps: list[Step], stored: DataFrame | None, turn: int) -> DataFrame:
    """What the blocks before leave to each block in a round: counts, decayed sums and first values, as ``__was...``."""
    pick = lambda c, i: F.max(F.when(F.col("i") == i, F.col(c)))
    done = _left(totals, steps, stored).groupBy("__key", (F.col("__block") + 1).alias("__block"))
    return done.agg(*[pick(c, i).alias(f"__was{turn}_{n}{i}") for i in range(len(steps)) for c, n in (("left", "sum"), ("seen", "n"), ("first", "first"))])


# --- passes ------------------------------------------------------------------

def _read(laid: DataFrame, *steps: Step) -> DataFrame:
    """The columns of ``laid`` that ``steps`` read, so that no others are dealt with its rows."""
    names = {c for s in steps for c in (s[0] if isinstance(s[0], tuple) else (s[0],))}
    return laid.select(*[f"`{c}`" for c in laid.columns if c in names or c in ("__key", "__block", "__at", "__own", "__end")])


class Plan:
    """The steps and the round of weighted means that each waits for.

    Frames, weighted means and array forms of one batch are made in one pass; a column
    expression that one of them waits for ends it.
    """

    def __init__(self, steps: list[Step]):
        self.steps, self.at, self.reach, self.rows = steps, {}, 0, ROWS
        reach: dict[str, int] = {}
        for source, how, n, out, *_ in steps:
            names = source if isinstance(source, tuple) else (source,)
            turn, far = max(self.at.get(c, 0) for c in names), max(reach.get(c, 0) for c in names)
            if isinstance(how, str):
                if turn:
                    raise ValueError(f"{out}: no frame over a weighted mean in one call")
                self.at[out], reach[out] = 0, far + (n if how == "lag" else n - 1)
                self.rows = max(self.rows, 2 * n) if how == "exponent" else self.rows
            elif isinstance(how, Column):
                self.at[out], reach[out] = turn, far
            elif 0 < how < 1:
                self.at[out] = turn + 1
                self.rows = min(self.rows, max(1, int(650 / -math.log1p(-how))))
            else:
                raise ValueError(f"{out}: alpha must be between 0 and 1")
        self.reach = max(reach.values(), default=0)
        self.rounds = max(self.at.values(), default=0)

    @staticmethod
    def _taken(steps: list[Step], known: set[str], plain: bool) -> list[Step]:
        """Those ``steps`` that can be made now, as column expressions if ``plain``, else in a pass."""
        known, taken = set(known), []
        for step in steps:
            source, how, _, out, *more = step
            if (isinstance(how, Column) and not more) == plain and known.issuperset(source if isinstance(source, tuple) else (source,)):
                known.add(out)
                taken.append(step)
        return taken

    @staticmethod
    def _without(steps: list[Step], taken: list[Step]) -> list[Step]:
        made = {s[3] for s in taken}
        return [s for s in steps if s[3] not in made]

    @staticmethod
    def _own(frame: DataFrame, steps: list[Step]) -> DataFrame:
        made: dict[str, Column] = {}
        for names, how, _, out in steps:
            if made.keys() & set(names):
                frame, made = frame.withColumns(made), {}
            made[out] = how.cast("double")
        return frame.withColumns(made) if made else frame

    def weights(self, turn: int) -> list[Step]:
        return [s for s in self.steps if isinstance(s[1], float) and self.at[s[3]] == turn]

    def before(self, turn: int) -> Plan:
        """The steps that the weighted means of a round read, and what those read."""
        want, kept = {s[0] for s in self.weights(turn)}, []
        for step in reversed(self.steps):
            if step[3] in want:
                want |= set(step[0]) if isinstance(step[0], tuple) else {step[0]}
                kept.append(step)
        return Plan(kept[::-1])

    def run(self, laid: DataFrame, totals: DataFrame | None, rounds: int | None = None, stored: DataFrame | None = None, keep: str = "__own", drop: tuple[str, ...] = (), ranges: bool = False, extra: DataFrame | None = None) -> DataFrame:
        """All columns over the rows of ``laid``, in order; ``totals`` are the rows of blocks that others follow, ``stored`` what was left before the first.

        The last pass gives back rows for which ``keep`` holds, without the columns ``drop``.
        ``extra`` has further columns for own rows, by ``__key``, ``__block`` and ``__at``.
        """
        frame, rounds, carries, beside = laid, self.rounds if rounds is None else rounds, {}, ()
        if extra is not None:
            beside = _further(extra)
            frame = laid.withColumn("__beside", F.lit(False)).unionByName(extra.withColumn("__beside", F.lit(True)), allowMissingColumns=True)
        for turn in range(1, rounds + 1 if totals is not None else 1):
            steps = self.weights(turn)
            first = self.before(turn)
            few = _read(totals, *first.steps, *steps)
            before = first.run(few, few, turn - 1, stored)
            frame = frame.join(_carries(_running(before, steps), steps, stored, turn), ["__key", "__block"], "left")
            carries |= {s[3]: f"__was{turn}_{{}}{i}" for i, s in enumerate(steps)}
        frame = in_order(frame, ranges)
        todo = [s for s in self.steps if self.at[s[3]] <= rounds]
        while todo or beside:
            plain = self._taken(todo, set(frame.columns), True)
            frame, todo = self._own(frame, plain), self._without(todo, plain)
            inside = self._taken(todo, set(frame.columns), False)
            todo = self._without(todo, inside)
            if inside or beside:
                last = all(isinstance(s[1], Column) and len(s) == 4 for s in todo)
                read = {c for s in todo for c in s[0]} if last else set()
                frame = _passed(frame, inside, carries, keep if last else None, tuple(c for c in drop if c not in read) if last else (), beside)
                beside = ()
            elif not plain:
                raise ValueError(f"no column for {todo[0][0]}")
        return frame

    def left(self, laid: DataFrame, stored: DataFrame | None) -> DataFrame:
        """(__key, step, seen, left, first): what the whole of ``laid`` leaves to rows that may come later."""
        out = None
        for turn in range(1, self.rounds + 1):
            steps = self.weights(turn)
            first = self.before(turn)
            few = _read(laid, *first.steps, *steps)
            at = _left(_running(first.run(few, few, turn - 1, stored), steps), steps, stored)
            name = F.element_at(F.array(*[F.lit(s[3]) for s in steps]), F.col("i") + 1)
            last = at.groupBy("__key", name.alias("step")).agg(F.max_by(F.struct("seen", "left", "first"), F.col("__block")).alias("s")).select("__key", "step", "s.*")
            out = last if out is None else out.unionAll(last)
        return out


#: Steps, the columns that are read of their rows, and what is made of these across keys: a table of ``__key``, ``__block``, ``__at`` and further columns.
Across = tuple[list[Step], tuple[str, ...], Callable[[DataFrame], DataFrame]]


def _further(extra: DataFrame) -> tuple[str, ...]:
    return tuple(c for c in extra.columns if c not in ("__key", "__block", "__at"))


def _across(laid: DataFrame, totals: DataFrame | None, across: Across | None, time: str, ranges: bool, stored: DataFrame | None = None) -> DataFrame | None:
    """What is made across keys; only the steps that it reads are run for it, over the columns that these read.

    It is written where the rows are dealt by ranges, as that reads it twice.
    """
    if across is None:
        return None
    steps, read, made = across
    gone = tuple(c for c in [*laid.columns, *[s[3] for s in steps]] if c not in {"__key", "__block", "__at", "__own", "__end", *read})
    rows = Plan(steps).run(_read(laid, *steps), totals, stored=stored, drop=gone).where("__own")
    extra = made(rows.withColumnRenamed("__at", time)).withColumnRenamed(time, "__at")
    return cut(extra, "across") if ranges else extra


def run_steps(
    df: DataFrame, steps: list[Step], key: str = "ticker", time: str = "date", only: Callable[[DataFrame], DataFrame] | None = None,
    across: Across | None = None, drop: tuple[str, ...] = (), ranges: bool = False, written: bool = False,
) -> DataFrame:
    """Append a column for each step but those in ``drop``; a step may read an earlier one's output, a frame only what is no weighted mean.

    ``only`` gets the rows of ``df`` and returns a table of times; the result has the
    rows at those times, and blocks without such a row give their carry alone.
    ``across`` makes columns over all keys from narrow rows, before the pass over the
    whole ones.  With ``ranges`` the rows come dealt by ranges of the key and in order.
    ``written`` says that ``df`` is read from files, so that reading it again costs little.
    """
    plan, made = Plan(steps), [s[3] for s in steps if s[3] not in drop]
    plain = df.drop(*[s[3] for s in steps])
    laid, keep = lay(plain, plan.reach, key, time, plan.rows, written=written), "__own"
    totals, rows = laid.where("not __end"), laid
    totals = totals if totals.take(1) else None  # without a second block nothing is carried
    if only is not None:
        times, keep = cut(only(_back(laid.where("__own"), key, time)).select(F.col(time).alias("__at")).distinct(), "times"), "__asked"
        rows = laid.join(times.withColumn("__asked", F.lit(True)), "__at", "left").withColumn(keep, F.col("__own") & F.coalesce("__asked", F.lit(False)))
        if totals is not None:
            rows = rows.join(rows.where(keep).select("__key", "__block").distinct(), ["__key", "__block"], "left_semi")
    extra = _across(rows, totals, across, time, ranges)
    done = _back(plan.run(rows, totals, keep=keep, drop=drop, ranges=ranges, extra=extra).where(keep), key, time)
    return done.select(*[f"`{c}`" for c in plain.columns], *([] if extra is None else _further(extra)), *made)


# --- rows that come later ----------------------------------------------------

@dataclass
class State:
    """What later rows need of a series: its last rows (with ``__key`` and ``__row`` from -1 down), and what its weighted means have summed."""

    tail: DataFrame
    left: DataFrame


def advance(new: DataFrame, steps: list[Step], state: State | None = None, key: str = "ticker", time: str = "date", across: Across | None = None, ranges: bool = False, written: bool = False) -> tuple[DataFrame, State]:
    """The rows of ``new`` with the steps' columns, and the state after them; ``across``, ``ranges`` and ``written`` as in ``run_steps``.

    ``state`` stands for all rows before; none of them is read.  A row that does not
    come after its key's stored rows raises an error.  Both parts of the new state are
    written.
    """
    plan, made = Plan(steps), [s[3] for s in steps]
    plain = new.drop(*made)
    laid = lay(plain, plan.reach, key, time, plan.rows, state and state.tail, written)
    stored = state and state.left
    totals = laid.where("not __end")
    totals = totals if state or totals.take(1) else None
    extra = _across(laid, totals, across, time, ranges, stored)
    done = _back(plan.run(laid, totals, stored=stored, ranges=ranges, extra=extra).where("__own"), key, time)
    place = F.row_number().over(Window.partitionBy("__key").orderBy(F.desc_nulls_last("__at")))
    tail = _back(laid.where("__end").withColumn("__row", -place.cast("long")).where(F.col("__row") >= -max(1, plan.reach)), key, time).select("__key", *plain.columns, "__row")
    left = plan.left(laid, stored)
    if state is not None:  # keys without new rows keep what they have
        left = left.unionByName(stored.join(laid.where("__own").select("__key").distinct(), "__key", "left_anti"))
    return done.select(*[f"`{c}`" for c in plain.columns], *([] if extra is None else _further(extra)), *made), State(cut(tail, "tail"), cut(left, "left"))
