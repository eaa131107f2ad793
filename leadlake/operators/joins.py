"""Equi-joins against lookups and logs.

Broadcast policy
----------------
Lookups carry no size check and no hint: Spark broadcasts a side below
``spark.sql.autoBroadcastJoinThreshold`` bytes by its statistics, adaptive execution
does the same at run time from real shuffle sizes, and anything larger is a shuffle
join.  Building a plan therefore starts no job.  ``broadcast=True`` is for fixed
vocabularies, whose size does not depend on the data.

Skew
----
* Lookups (``lookup``): the fact side is the preserved side of a LEFT join, which
  AQE's skew handling can split, and the lookup side has unique keys.
* One-to-many left joins (``left_join_one_to_many``): a hot key sits on the
  *non-preserved* side, which AQE cannot split in an outer join.  The join is
  therefore written as an INNER join (either side splittable, NULL keys filtered
  before the shuffle) plus the unmatched rows found with an anti join against the
  *distinct* keys of the many side (map-side pre-aggregated, so a hot key is one
  row per map task before shuffling).
* Where the hot keys are known, ``left_join_salted`` needs neither the second scan of the
  left side nor that of the right keys: rows of those keys are dealt to ``salts`` places.
* ``role_lookups_once`` is ``role_lookups`` for lookup tables too large to broadcast: all
  roles in one join of narrow rows, and one shuffle of the wide ones.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KeyPair = tuple["str | Column", str]


def _as_col(c: "str | Column") -> Column:
    return F.col(c) if isinstance(c, str) else c


def _side(
    dim: DataFrame, columns: Mapping[str, str], keys: Sequence[str], tag: str, taken: Sequence[str]
) -> tuple[DataFrame, dict[str, str], list[str], dict[str, str]]:
    """Project the lookup side for a join: value columns under their output names,
    keys that are not also values under ``tag + key``.

    Returns (side, name of each key on the side, side columns to drop after the
    join, renames to apply after the join).  When an output name would clash with
    a column of the other side, everything is tagged and renamed after the join.
    Naming the side's columns up front keeps the big plan to one join and at most
    one drop, which matters for wide plans (each DataFrame step re-analyses them).
    """
    outs = list(columns.values())
    if set(outs) & set(taken) or len(set(outs)) < len(outs):
        needed = list(dict.fromkeys(list(columns) + list(keys)))
        side = dim.select(*[f"`{c}`" for c in needed]).toDF(*[tag + c for c in needed])
        drop = [tag + k for k in keys if k not in columns]
        return side, {k: tag + k for k in keys}, drop, {tag + d: o for d, o in columns.items()}
    exprs = list(columns.items())
    key_names: dict[str, str] = {}
    for k in keys:
        if k in columns:
            key_names[k] = columns[k]
        else:
            key_names[k] = tag + k
            exprs.append((k, tag + k))
    side = dim.select(*[f"`{d}`" for d, _ in exprs]).toDF(*[o for _, o in exprs])
    return side, key_names, [tag + k for k in keys if k not in columns], {}


def _finish(df: DataFrame, drop: list[str], renames: dict[str, str]) -> DataFrame:
    if drop:
        df = df.drop(*drop)
    return df.withColumnsRenamed(renames) if renames else df


def lookup(
    fact: DataFrame,
    dim: DataFrame,
    on: Sequence[KeyPair],
    columns: Mapping[str, str],
    how: str = "left",
    role: str = "lk",
    broadcast: bool = False,
) -> DataFrame:
    """Add ``columns`` (dim column -> output name) from ``dim`` to ``fact``.

    ``on`` pairs a fact column name or Column expression (a computed key such as
    the digits of a phone number) with a dim column name.  The dim side is
    projected under the output names (keys under ``role``-tagged names), so one
    lookup table can be joined several times in different roles without
    ambiguous references.
    """
    keys = [d for _, d in on]
    side, key_names, drop, renames = _side(dim, columns, keys, f"__{role}__", fact.columns)
    if broadcast:
        side = F.broadcast(side)
    cond = reduce(lambda a, b: a & b, [_as_col(f) == F.col(key_names[d]) for f, d in on])
    joined = fact.join(side, cond, how)
    if how in ("left_semi", "left_anti"):
        return joined
    return _finish(joined, drop, renames)


def role_lookups(
    fact: DataFrame,
    dim: DataFrame,
    roles: Mapping[str, tuple[Sequence[KeyPair], Mapping[str, str]]],
    broadcast: bool = False,
) -> DataFrame:
    """The same lookup table joined once per role: ``roles`` maps a role
    name to (key pairs, dim column -> output name)."""
    out = fact
    for role, (on, columns) in roles.items():
        out = lookup(out, dim, on, columns, role=role, broadcast=broadcast)
    return out


def left_join_one_to_many(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    right_columns: Mapping[str, str],
    skew_safe: bool = True,
) -> DataFrame:
    """Every left row with each matching right row; unmatched left rows once,
    with NULL right columns.  ``right_columns`` maps right column -> output name
    (the right keys may be among them).  See the module docstring for why the
    skew-safe form is an inner join plus an anti join."""
    rkeys = [r for _, r in on]
    rside, key_names, drop, renames = _side(right, right_columns, rkeys, "__r__", left.columns)
    cond = reduce(lambda a, b: a & b, [F.col(f"`{lc}`") == F.col(key_names[rc]) for lc, rc in on])
    if not skew_safe:
        return _finish(left.join(rside, cond, "left"), drop, renames)

    matched = _finish(left.join(rside, cond, "inner"), drop, renames)
    right_keys = rside.select(*[key_names[r] for r in rkeys]).distinct()
    unmatched = left.join(right_keys, cond, "left_anti")
    # the right-side columns of unmatched rows are NULLs of the right types
    return matched.unionByName(unmatched, allowMissingColumns=True)


def _is_one_of(columns: Sequence[Column], keys: Sequence[tuple]) -> Column:
    """Whether the tuple of ``columns`` is one of ``keys`` (no NULLs in them)."""
    if not keys:
        return F.lit(False)
    names = [f"k{n}" for n in range(len(columns))]
    row = F.struct(*[c.alias(n) for c, n in zip(columns, names)])
    whole = reduce(lambda a, b: a & b, [c.isNotNull() for c in columns])
    return F.coalesce(whole & row.isin(*[
        F.struct(*[F.lit(v).alias(n) for v, n in zip(key, names)]) for key in keys]), F.lit(False))


def left_join_salted(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    right_columns: Mapping[str, str],
    hot: Sequence[tuple],
    salts: int = 32,
) -> DataFrame:
    """J1 in one pass, with keys that hold a large share of the right rows.

    ``hot`` lists such keys (at most some hundred, each *with a row on the right*; see
    ``sources.catalog.hot_key_summary``).  Right rows of a hot key get one of ``salts`` numbers
    by a hash of the row; left rows of a hot key are repeated for every number, all others
    join under number 0.  A repeated left row that meets no right row is not an unmatched
    row - its key does have rows - and is left out.  Each side is read and shuffled once.
    """
    lkeys, rkeys = [F.col(f"`{lc}`") for lc, _ in on], [F.col(f"`{rc}`") for _, rc in on]
    if not hot:
        return left_join_one_to_many(left, right, on, right_columns, skew_safe=False)
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in right_columns]), F.lit(salts)).cast("int")
    salted = right.withColumn("__salt", F.when(_is_one_of(rkeys, hot), spread).otherwise(F.lit(0)))
    salted = salted.withColumn("__there", F.lit(True))
    left_hot = _is_one_of(lkeys, hot)
    repeated = left.withColumn("__hot", left_hot).withColumn("__lsalt", F.explode(
        F.when(F.col("__hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))))
    joined = left_join_one_to_many(
        repeated, salted, [*on, ("__lsalt", "__salt")], {**right_columns, "__there": "__there"}, skew_safe=False)
    return joined.where(~F.col("__hot") | F.col("__there")).drop("__hot", "__lsalt", "__there")


def role_lookups_once(
    fact: DataFrame,
    dim: DataFrame,
    roles: Mapping[str, tuple[Sequence[KeyPair], Mapping[str, str]]],
) -> DataFrame:
    """J3 / J4 with one shuffle of the wide rows, for a ``dim`` that no broadcast fits.

    The distinct combinations of all roles' keys are made into narrow rows (combination,
    role, key), joined to ``dim`` once, and gathered again as a map from role to the values
    found.  The wide rows then meet that map in one join, on their combination (NULL-safe).
    Same rows as ``role_lookups``: without a match NULLs, with several a row for each.
    """
    dim_keys = [d for _, d in next(iter(roles.values()))[0]]
    if any([d for _, d in on] != dim_keys for on, _ in roles.values()):
        raise ValueError("all roles must use the same key columns of the lookup table")
    wanted = list(dict.fromkeys(c for _, columns in roles.values() for c in columns))
    names = {(role, d): f"__{role}__{d}" for role in roles for d in dim_keys}
    key = {names[role, d]: _as_col(f) for role, (on, _) in roles.items() for f, d in on}
    # the same column in several roles (an organisation, say) is one column of a combination
    alike: dict[str, str] = {}
    for name, column in key.items():
        alike.setdefault(str(column), name)
    place = {name: alike[str(column)] for name, column in key.items()}
    parts = sorted(set(place.values()))
    tagged = fact.withColumns({p: key[p] for p in parts})
    combos = tagged.select(*parts).distinct()
    narrow = combos.select(*parts, F.explode(F.array(*[
        F.struct(F.lit(role).alias("role"), *[F.col(place[names[role, d]]).alias(d) for d in dim_keys])
        for role in roles])).alias("__need")).where(
            reduce(lambda a, b: a & b, [F.col(f"__need.{d}").isNotNull() for d in dim_keys]))
    side = dim.select(*[F.col(f"`{d}`").alias(f"__d__{d}") for d in dim_keys],
                      F.struct(*[F.col(f"`{c}`").alias(c) for c in wanted]).alias("__value"))
    met = narrow.join(side, reduce(lambda a, b: a & b, [
        F.col(f"__need.{d}") == F.col(f"__d__{d}") for d in dim_keys]), "inner")
    per_role = met.groupBy(*parts, F.col("__need.role").alias("__role")).agg(F.collect_list("__value").alias("__values"))
    maps = per_role.groupBy(*[F.col(p).alias(f"__m{p}") for p in parts]).agg(
        F.map_from_entries(F.collect_list(F.struct("__role", "__values"))).alias("__found"))
    out = tagged.join(maps, reduce(lambda a, b: a & b, [F.col(p).eqNullSafe(F.col(f"__m{p}")) for p in parts]), "left")
    out = out.select(*[F.col(f"`{c}`") for c in fact.columns], "__found")
    for role, (_, columns) in roles.items():
        kept = out.columns
        out = out.select(*[F.col(f"`{c}`") for c in kept], F.explode_outer(F.col("__found")[role]).alias("__at"))
        out = out.select(*[F.col(f"`{c}`") for c in kept], *[F.col(f"__at.{d}").alias(o) for d, o in columns.items()])
    return out.drop("__found")
