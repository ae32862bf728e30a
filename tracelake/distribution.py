"""Building blocks that keep ordered and keyed work spread over many tasks.

A window over one huge group, or over no group at all, sends every row of it to one task. The helpers here number rows,
take running totals and compute exact percentiles through many small buckets instead, and join facts to keyed tables
without piling a hot key on one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracelake.session import materialise

BUCKET = "__bucket"
SALT = "__salt"

# Rows of one range where rows are put in order by ranges; their number grows with the table.
ROWS_PER_RANGE = 2_000_000

# Salts for rows that cannot match: no copy of the other side has to meet them, so they may spread as far as they like.
FREE_SALTS = 1 << 20


def seeded_key(id_col: str | Column, seed: str | int) -> Column:
    """Hex digest that orders rows in a reproducible shuffle; equal ids always get equal keys."""
    ident = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.md5(F.concat_ws(":", F.lit(str(seed)), ident.cast("string")))


def _running(df: DataFrame, bucket: Column, order: Sequence[Column], weight: Column, group: Sequence[str], out: str) -> DataFrame:
    """Exclusive running total of ``weight``, where ``bucket`` must be monotone in ``order``.

    Per-bucket totals are small (groups x buckets); their running total gives each bucket its offset, and the ordered work
    inside a bucket is one task's share. The offset join uses the key the window is already partitioned by.
    """
    keyed = df.withColumn(BUCKET, F.struct(*[F.col(g) for g in group], bucket.alias("b")))
    totals = keyed.groupBy(BUCKET).agg(F.sum(weight).alias("__total"))
    by_group = Window.partitionBy(*[F.col(f"{BUCKET}.{g}") for g in group]).orderBy(f"{BUCKET}.b")
    ahead = totals.select(
        BUCKET,
        F.coalesce(F.sum("__total").over(by_group.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__ahead"),
    )
    inside = Window.partitionBy(BUCKET).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = keyed.withColumn("__local", F.coalesce(F.sum(weight).over(inside), F.lit(0)))
    return local.join(ahead, BUCKET).withColumn(out, F.col("__local") + F.col("__ahead")).drop(BUCKET, "__local", "__ahead")


def shuffled_index(df: DataFrame, id_col: str, seed: str | int, out: str, group: Sequence[str] = (), digits: int = 3) -> DataFrame:
    """Dense 0-based position of each row in the seeded shuffle, within ``group`` if given.

    The digest spreads ids evenly over ``16 ** digits`` buckets, so no bucket is hot whatever the group sizes are.
    """
    keyed = df.withColumn("__key", seeded_key(id_col, seed))
    order = [F.col("__key"), F.col(id_col)]
    return _running(keyed, F.substring("__key", 1, digits), order, F.lit(1).cast("long"), group, out).drop("__key")


def ordered_total(
    df: DataFrame,
    order: Column,
    ties: Sequence[str],
    out: str,
    group: Sequence[str] = (),
    weight: Column | None = None,
    splits: int = 64,
) -> DataFrame:
    """Exclusive running total in the order of a column; with no weight, a dense 0-based index.

    Numbers and times of up to ``splits`` ranges' rows are cut into buckets at quantiles (``splits`` numbers). They are taken
    over all rows, so a group that holds a third of the rows is spread over about a third of the buckets. Rows of one order
    value follow each other by the digest of their ``ties``; a value so frequent that it fills whole buckets is split further
    by that digest. More rows, and other orders such as texts, are dealt into as many ranges as their number asks for, by order
    and ties; the result is the same.
    """
    kind = df.select(order.alias("o")).schema["o"].dataType
    timed = kind.typeName() in ("timestamp", "timestamp_ntz")
    value = F.unix_micros(order.cast("timestamp")) if timed else order
    if not (timed or isinstance(kind, T.NumericType)):
        return _ranged_total(df, order, ties, out, group, weight, df.count())
    shares = [i / splits for i in range(1, splits)]
    marks, rows = df.agg(F.percentile_approx(value, F.array(*[F.lit(s) for s in shares]), 10 * splits), F.count("*")).first()
    if rows > splits * ROWS_PER_RANGE:
        return _ranged_total(df, order, ties, out, group, weight, rows)
    marks = marks or []
    cuts = sorted(set(marks))
    frequent = [c for c in cuts if marks.count(c) > 1]
    bucket = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c < value)) if cuts else F.lit(0)
    step = F.lit(1).cast("long") if weight is None else weight
    if not ties:
        return _running(df, bucket, [order], step, group, out)
    digest = F.md5(F.concat_ws(":", *[F.col(t).cast("string") for t in ties]))
    keyed = df.withColumn("__digest", digest)
    piece = F.when(value.isin(frequent), F.substring("__digest", 1, 2)).otherwise("") if frequent else F.lit("")
    ordered = [order, F.col("__digest"), *[F.col(t) for t in ties]]
    return _running(keyed, F.struct(bucket.alias("i"), piece.alias("piece")), ordered, step, group, out).drop("__digest")


def _ranged_total(df: DataFrame, order: Column, ties: Sequence[str], out: str, group: Sequence[str], weight: Column | None, rows: int) -> DataFrame:
    """``ordered_total`` over ranges of the order itself. They are written once: a later sample could cut them elsewhere."""
    step = F.lit(1).cast("long") if weight is None else weight
    digest = [F.md5(F.concat_ws(":", *[F.col(t).cast("string") for t in ties])).alias("__digest")] if ties else []
    keyed = df.select("*", order.alias("__order"), step.alias("__step"), *digest)
    by = ["__order", *(["__digest"] if ties else []), *ties]
    dealt = keyed.repartitionByRange(max(1, -(-rows // ROWS_PER_RANGE)), *by).withColumn("__range", F.spark_partition_id())
    ranged = materialise(dealt, "ranges")
    return _running(ranged, F.col("__range"), [F.col(c) for c in by], F.col("__step"), group, out).drop("__order", "__step", "__digest", "__range")


def spread_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str, spread_by: str, salts: int = 8) -> DataFrame:
    """Equi join of a fact table with a keyed table, with each key split over ``salts`` tasks.

    Only the keyed table is repeated. No broadcast is forced: Catalyst broadcasts it when its measured size allows.
    Where it does not, a key so hot that even a salt of it is too large is split on by adaptive skew handling. Rows
    without a key are spread freely.
    """
    copies = right.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    keyless = _any([F.col(k).isNull() for k in on])
    salted = left.withColumn(SALT, _salt(spread_by, F.when(keyless, FREE_SALTS).otherwise(salts)))
    return salted.join(copies, [*on, SALT], how).drop(SALT)


def _salt(spread_by: str, salts: Column) -> Column:
    return F.pmod(F.xxhash64(F.col(spread_by)), salts).cast("int")


def heavy_keys(df: DataFrame, key: str, parts: int = 1000) -> DataFrame:
    """Keys that hold at least ``1 / parts`` of the rows; at most ``parts`` of them can exist."""
    total = df.count()
    return df.where(F.col(key).isNotNull()).groupBy(key).count().where(F.col("count") >= max(2, -(-total // parts))).select(key)


def heavy_join(left: DataFrame, right: DataFrame, key: str, how: str, spread_by: str, salts: int = 16, parts: int = 1000) -> DataFrame:
    """Equi join of two large tables, ``right`` unique on ``key``: only rows of the few heavy keys are repeated.

    The broadcast list is bounded by ``heavy_keys`` (at most ``parts`` rows) whatever the data size.
    """
    hot = F.broadcast(heavy_keys(left, key, parts).withColumn("__hot", F.lit(True)))
    flag = F.coalesce(F.col("__hot"), F.lit(False))
    spread = F.when(F.col(key).isNull(), FREE_SALTS).when(flag, salts).otherwise(1)
    salted = left.join(hot, key, "left").withColumn(SALT, _salt(spread_by, spread))
    copies = right.join(hot, key, "left").withColumn(
        SALT, F.explode(F.when(flag, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0))))
    )
    return salted.drop("__hot").join(copies.drop("__hot"), [key, SALT], how).drop(SALT)


def exact_percentiles(df: DataFrame, group: Sequence[str], value: str, shares: Sequence[float]) -> DataFrame:
    """Exact percentiles with linear interpolation, one ``p<share>`` column each.

    The built-in exact aggregate keeps a whole group's values in one task. Here values are counted first (map-side
    combine), ranked through buckets, and only the rows around each wanted rank are brought together. The counts are
    written once, since cut points, ranks and sizes all need them.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count("*").alias("__n"))
    counted = materialise(counts, "counts")
    ranked = ordered_total(counted, F.col(value), [], "__start", group, F.col("__n"))
    sizes = counted.groupBy(*group).agg(F.sum("__n").alias("__size"))
    key = F.struct(*[F.col(g) for g in group])
    placed = ranked.withColumn("__g", key).drop(*group).join(sizes.withColumn("__g", key), "__g").drop("__g")
    last = F.col("__start") + F.col("__n") - 1
    marks = []
    for share in shares:
        at = F.lit(float(share)) * (F.col("__size") - 1)
        low, high = F.floor(at), F.ceil(at)
        holds = ((F.col("__start") <= high) & (last >= low))
        marks.append((share, at, low, high, holds))
    near = placed.where(_any([m[4] for m in marks]))
    columns = []
    for share, at, low, high, _ in marks:
        below = F.max(F.when((F.col("__start") <= low) & (last >= low), F.col(value)))
        above = F.max(F.when((F.col("__start") <= high) & (last >= high), F.col(value)))
        part = F.max(at - low)
        columns.append((below + (above - below) * part).alias(percentile_name(share)))
    return near.groupBy(*group).agg(*columns)


def percentile_name(share: float) -> str:
    return f"p{round(share * 100):d}"


def _any(conditions: Sequence[Column]) -> Column:
    result = conditions[0]
    for condition in conditions[1:]:
        result = result | condition
    return result
