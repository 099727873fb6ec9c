"""Equi-join chains with set semantics.

A chain starts from a base table and folds a declared list of join steps over
it, left-deep, in the declared order. Each step names a table, its key
columns and the join type (``inner`` or ``left``). The key appears once,
from the left; the output keeps the left columns, then each step's right
non-key columns in step order. A non-key name that already exists on the
left is an error, never silently suffixed.

Set semantics. The jobs this library re-expresses take a full-row distinct
after *every* join. No join here drops a column, so the distinct after each
step and one distinct later give the same set of rows. ``unique_from`` names the
step after which the frame becomes a set, while it is narrow; without it the chain
applies one ``distinct()`` at the end. Two rewrites keep the intermediate bag
from fanning out before that:

* an inner join to a table that has only the key columns (a pure existence
  check whose key may repeat) becomes a ``left_semi`` join against the
  pre-aggregated distinct keys - the partial aggregate collapses a repeated
  key on the map side before anything is shuffled;
* ``distinct_after`` adds an early distinct after named steps, for a right
  side known to multiply rows.

When the base rows are known to be unique (``base_unique``, e.g. rows that
carry a checked unique id) and every right side is deduplicated, a join of
sets is already a set, so the final distinct - a shuffle of the widest frame
of the job - is skipped and only the (small) right sides are deduplicated.

Branches. A step may carry its own ``branch`` of steps whose keys all come
from the step's table (a snowflake arm, e.g. caregiver -> address and
caregiver -> contact). The arm is joined first, at the size of the dimension,
and the chain then joins the result once: ``(L ⟕ B) ⟕ C`` equals
``L ⟕ (B ⟕ C)`` when C's key comes from B, so the rows are the same while the
wide chain frame is shuffled once instead of once per arm table. If every table of a
marked arm is known to be small, each is broadcast by itself and nothing is joined first.

Broadcasts. A step may mark one side as expected small (``broadcast="left"``
for a dimension-only prefix in front of a fact table, ``"right"`` for a small
dimension). That side is broadcast only if it has at most ``max_broadcast_rows`` rows
and ``max_broadcast_bytes`` bytes of values; otherwise the join is left to Spark (a
sort-merge join, with AQE splitting skewed partitions). ``sizes`` (upper bounds of
tables, from parquet footers, ``sources.sizes``) decides that without a job, through the chain: a
join is bounded by the product of its sides. Marked sides that no size bounds are
counted, all of a chain in one job (one pass over each, partial in its scan
tasks). Unmarked steps are left to Spark's own size estimate and AQE's runtime conversion.

Null keys never match. In a left join Spark hashes every null key to the same
shuffle partition, so a frame where many rows lack the key (e.g. after an
earlier left join found nothing) would pile them into one task. For integer
keys the chain joins on a 64-bit surrogate that equals the key when present
and, when the key is null, a hashed value below the 32-bit range that no
right-side key can equal; the null rows then spread over all partitions and
still find no partner. A key that an earlier inner step already matched can
not be null, so it is joined as itself; its hash partitioning then carries on
to the final distinct, which needs no shuffle of its own.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Collection, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, ByteType, IntegerType, ShortType, StringType

from lodestar.sources.sizes import FIXED_WIDTH, OTHER_WIDTH, Sizes, TableSize, no_sizes

_HOWS = ("inner", "left")
_SIDES = (None, "left", "right")
_NARROW_INT = (ByteType, IntegerType, ShortType)
_SURROGATE = "__lodestar_join_key"
_NULL_SPREAD = 1 << 16

# Largest side that a marked step broadcasts: rows, and bytes of column data.
DEFAULT_MAX_BROADCAST_ROWS = 1_000_000
DEFAULT_MAX_BROADCAST_BYTES = 64 << 20


@dataclass(frozen=True)
class JoinStep:
    table: str
    on: tuple[str, ...]
    how: str = "inner"
    branch: tuple["JoinStep", ...] = ()
    broadcast: str | None = None

    def __post_init__(self) -> None:
        if isinstance(self.on, str):
            object.__setattr__(self, "on", (self.on,))
        object.__setattr__(self, "branch", tuple(self.branch))
        if self.how not in _HOWS:
            raise ValueError(f"join type {self.how!r} not in {_HOWS}")
        if not self.on:
            raise ValueError(f"step {self.table!r} has no key")
        if self.broadcast not in _SIDES:
            raise ValueError(f"broadcast side {self.broadcast!r} not in {_SIDES}")
        if self.broadcast == "left" and self.how != "inner":
            raise ValueError("only an inner join can broadcast its left side")
        for sub in self.branch:
            if sub.how == "inner" and self.how != "inner":
                raise ValueError(f"inner branch step {sub.table!r} under a left join "
                                 f"would drop rows of the chain")


class ColumnCollisionError(ValueError):
    pass


def _check_keys(df: DataFrame, keys: Sequence[str], side: str, table: str) -> None:
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise KeyError(f"{side} side of join with {table!r} lacks keys {missing}")


def _spreadable(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> bool:
    if len(keys) != 1:
        return False
    k = keys[0]
    return (isinstance(left.schema[k].dataType, _NARROW_INT)
            and isinstance(right.schema[k].dataType, _NARROW_INT))


def _value_bytes(df: DataFrame) -> Column:
    """Bytes of one row's values: octet length for text and binary, the fixed width otherwise."""
    parts = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (StringType, BinaryType)):
            parts.append(F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)))
        else:
            parts.append(F.lit(FIXED_WIDTH.get(f.dataType.typeName(), OTHER_WIDTH)))
    return sum(parts[1:], parts[0]) if parts else F.lit(0)


def small_enough(frames: Sequence[DataFrame], max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                 max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> list[bool]:
    """For each frame, whether it has at most ``max_rows`` rows and ``max_bytes`` value bytes.

    All frames are counted in one job: a union of one global aggregate per
    frame, each computed partially inside its scan tasks, so only one row per
    task and one row per frame move; nothing is gathered into a single task.
    """
    if not frames:
        return []
    sized = [df.agg(F.count(F.lit(1)).alias("n"), F.sum(_value_bytes(df)).alias("b"))
             .select(F.lit(i).alias("tag"), "n", "b") for i, df in enumerate(frames)]
    found = {r["tag"]: (int(r["n"]), int(r["b"] or 0))
             for r in reduce(DataFrame.unionAll, sized).collect()}
    return [found[i][0] <= max_rows and found[i][1] <= max_bytes for i in range(len(frames))]


def left_join(left: DataFrame, right: DataFrame, keys: Sequence[str],
              spread_null_keys: bool = True) -> DataFrame:
    """``left`` LEFT JOIN ``right`` USING ``keys``; null left keys do not gather in one task.

    Output: the left columns, then the right non-key columns.
    """
    keys = list(keys)
    extra = [c for c in right.columns if c not in keys]
    if not (spread_null_keys and _spreadable(left, right, keys)):
        return left.join(right, keys, "left").select(*left.columns, *extra)
    k = keys[0]
    fallback = F.lit(-(1 << 31) - 1) - F.pmod(F.xxhash64(*[F.col(c) for c in left.columns]),
                                              F.lit(_NULL_SPREAD))
    lhs = left.withColumn(_SURROGATE, F.coalesce(F.col(k).cast("bigint"), fallback))
    rhs = right.select(F.col(k).cast("bigint").alias(_SURROGATE), *extra)
    return lhs.join(rhs, _SURROGATE, "left").select(*left.columns, *extra)


def step_columns(columns: Mapping[str, Sequence[str]], step: JoinStep) -> list[str]:
    """Columns a step adds to the chain: its table's non-keys, then its branch's."""
    added = [c for c in columns[step.table] if c not in step.on]
    for sub in step.branch:
        added += step_columns(columns, sub)
    return added


def chain_output_columns(columns: Mapping[str, Sequence[str]], base: str,
                         steps: Sequence[JoinStep]) -> list[str]:
    """Output column order of a chain, from the tables' column lists alone."""
    order = list(columns[base])
    for st in steps:
        order += step_columns(columns, st)
    return order


def join_chain(tables: Mapping[str, DataFrame], base: str, steps: Sequence[JoinStep], *,
               dedup: bool = True, base_unique: bool = False,
               distinct_after: Collection[str] = (), unique_from: str | None = None,
               semi_for_key_only: bool = True, spread_null_keys: bool = True,
               max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
               max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
               sizes: Sizes = no_sizes) -> DataFrame:
    """Fold ``steps`` over ``tables[base]``; see the module docstring.

    ``dedup=False`` returns the bag (no distinct, no semi-join rewrite).

    ``unique_from`` names the step after which the frame is made a set, while it
    is narrow; the tables after it are deduplicated at their own size, joins of
    sets are sets, and the wide result needs no distinct.

    The chain is built once with every marked side hinted for broadcast. The
    marked sides that ``sizes`` does not prove small are then counted together in
    one job. Only if one of them is too big is the chain built again, with that
    hint left out.
    """
    if unique_from is not None and unique_from not in [s.table for s in steps]:
        raise KeyError(f"no step {unique_from!r} in the chain")
    opts = dict(dedup=dedup, base_unique=base_unique, distinct_after=set(distinct_after),
                unique_from=unique_from,
                semi_for_key_only=semi_for_key_only, spread_null_keys=spread_null_keys, sizes=sizes)
    undecided: list[DataFrame] = []

    def known_small(size: TableSize | None) -> bool:
        return size is not None and size.fits(max_broadcast_rows, max_broadcast_bytes)

    def optimistic(df: DataFrame, size: Callable[[], TableSize | None]) -> DataFrame:
        if not known_small(size()):
            undecided.append(df)
        return F.broadcast(df)

    chain = _fold(tables, base, steps, optimistic, known_small, **opts)
    verdicts = small_enough(undecided, max_broadcast_rows, max_broadcast_bytes)
    if all(verdicts):
        return chain
    it = iter(verdicts)

    def decided(df: DataFrame, size: Callable[[], TableSize | None]) -> DataFrame:
        return F.broadcast(df) if known_small(size()) or next(it) else df

    return _fold(tables, base, steps, decided, known_small, **opts)


def _chain_size(sizes: Sizes, base: str, joined: Sequence[tuple[str, str]]) -> TableSize | None:
    """A bound of ``base`` joined to tables in turn, each (table, how)."""
    size = sizes(base)
    for table, how in joined:
        other = sizes(table) if how != "semi" else size
        if size is None or other is None:
            return None
        size = size.joined(other, how)
    return size


def _all_small(step: JoinStep, sizes: Sizes, known_small: Callable[[TableSize | None], bool]) -> bool:
    """Whether a marked arm is only left joins of tables that are each known to be small."""
    return (step.broadcast == "right" and not any(s.branch or s.how != "left" for s in step.branch)
            and all(known_small(sizes(s.table)) for s in (step, *step.branch)))


def _fold(tables: Mapping[str, DataFrame], base: str, steps: Sequence[JoinStep],
          hint: Callable[[DataFrame, Callable[[], TableSize | None]], DataFrame],
          known_small: Callable[[TableSize | None], bool], *, dedup: bool, base_unique: bool,
          distinct_after: Collection[str], unique_from: str | None, semi_for_key_only: bool,
          spread_null_keys: bool, sizes: Sizes) -> DataFrame:
    df = tables[base]
    order = list(df.columns)
    dedup_right = dedup and base_unique
    not_null: set[str] = set()
    joined: list[tuple[str, str]] = []
    todo = deque(steps)
    while todo:
        step = todo.popleft()
        keys = list(step.on)
        _check_keys(df, keys, "left", step.table)
        right = tables[step.table]
        arm: list[tuple[str, str]] = []
        if step.branch:
            arm_keys = {k for sub in step.branch for k in sub.on}
            shadowed = sorted(arm_keys & set(order))
            if shadowed:
                raise ColumnCollisionError(
                    f"branch of {step.table!r} joins on {shadowed}, which the chain already has")
            if _all_small(step, sizes, known_small):
                todo.extendleft(replace(s, branch=(), broadcast="right") for s in reversed((step, *step.branch)))
                continue
            right = _fold(tables, step.table, step.branch, hint, known_small, dedup=False, base_unique=False,
                          distinct_after=(), unique_from=None, semi_for_key_only=False,
                          spread_null_keys=spread_null_keys, sizes=sizes)
            arm = [(sub.table, sub.how) for sub in step.branch]

        def right_size(table=step.table, arm=arm) -> TableSize | None:
            return _chain_size(sizes, table, arm)

        _check_keys(right, keys, "right", step.table)
        extra = [c for c in right.columns if c not in keys]
        clash = [c for c in extra if c in order]
        if clash:
            raise ColumnCollisionError(f"joining {step.table!r} repeats columns {clash}")

        if step.broadcast == "left":
            df = hint(df, lambda done=tuple(joined): _chain_size(sizes, base, done))

        if dedup and semi_for_key_only and step.how == "inner" and not extra:
            right = right.select(*keys).distinct()
            if step.broadcast == "right":
                right = hint(right, right_size)
            df = df.join(right, keys, "left_semi").select(*order)
            joined.append((step.table, "semi"))
        else:
            right = right.select(*keys, *extra)
            if dedup_right:
                right = right.distinct()
            if step.broadcast == "right":
                right = hint(right, right_size)
            joined += [(step.table, step.how), *arm]
            if step.how == "left":
                spread = spread_null_keys and not set(keys) <= not_null
                df = left_join(df, right, keys, spread)
                order += extra
            else:
                # USING puts the keys first; restore the chain order.
                order += extra
                df = df.join(right, keys, "inner").select(*order)
        if step.how == "inner":
            not_null.update(keys)
        if dedup and step.table == unique_from:
            df, dedup_right = df.distinct(), True
        elif dedup and step.table in distinct_after:
            df = df.distinct()

    if dedup and not dedup_right:
        df = df.distinct()
    return df
