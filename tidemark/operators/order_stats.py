"""Running totals and ranks over sorted values without a one-task window.

A window partitioned by feature sorts a whole feature in one task. Here the
value range is sliced at approximate quantiles first, each slice is summed on
its own, and a head row per slice carries what lies before it. Every step is
keyed by (keys, slice), so work spreads over keys x slices tasks and a heavy
value costs nothing extra because values are aggregated before they are sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.sources.tables import materialized

# The rows one slice of a sorted column, or one slice of a hash order, should hold.
ROWS_PER_SLICE = 1_000_000
ROWS_PER_LEAD = 100_000

# Rows drawn per slice to place the cuts.
SAMPLE_PER_SLICE = 2_000


def cuts_by_feature(rows: DataFrame, counts: dict[str, int], rows_per_slice: int = ROWS_PER_SLICE) -> dict[str, list[float]]:
    """Ascending cut points per feature of (feature, value) rows, {} if one slice will do.

    Any cut points give the same result, they only balance the work, so they may
    come from a sample. The number of slices follows the counted rows.
    """
    largest = max(counts.values(), default=0)
    if largest <= rows_per_slice:
        return {}
    slices = -(-largest // rows_per_slice)
    fraction = min(1.0, slices * SAMPLE_PER_SLICE / largest)
    sampled = rows if fraction == 1.0 else rows.sample(fraction, seed=17)
    points = _doubles([k / slices for k in range(1, slices)])
    found = sampled.groupBy("feature").agg(
        F.array_distinct(F.percentile_approx("value", points, 10 * slices)).alias("cuts")
    )
    return {r["feature"]: list(r["cuts"]) for r in found.collect() if counts.get(r["feature"], 0) > rows_per_slice}


def column_cuts(df: DataFrame, value: str, rows_per_slice: int = ROWS_PER_SLICE) -> list[float]:
    """Cut points of one column, decided on its counted rows."""
    rows = df.select(F.lit("value").alias("feature"), F.col(value).cast("double").alias("value")).filter("value IS NOT NULL")
    return cuts_by_feature(rows, {"value": rows.count()}, rows_per_slice).get("value", [])


def lead_digits(rows: int) -> int:
    """Leading hex digits that cut a hash order into slices of at most about ROWS_PER_LEAD rows."""
    digits = 0
    while rows > ROWS_PER_LEAD * 16**digits:
        digits += 1
    return digits


def _null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", plain: Sequence[str] = ()) -> DataFrame:
    """Join on keys, where NULL equals NULL, and on plain columns that hold no NULL. Key columns come from the left."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in [*keys, *plain]})
    on = [left[k].eqNullSafe(renamed[f"_right_{k}"]) for k in keys] + [left[k] == renamed[f"_right_{k}"] for k in plain]
    return left.join(renamed, on, how).drop(*[f"_right_{k}" for k in [*keys, *plain]])


def _doubles(values: Sequence[float]) -> Column:
    """A constant array; one text literal keeps the plan small."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast("array<double>")


def slice_of(value: Column, cuts: Sequence[float]) -> Column:
    """Number of cut points <= value, by binary search in a literal array."""
    if not cuts:
        return F.lit(0)
    edges = _doubles(cuts)

    def advance(found: Column, step: Column) -> Column:
        reached = F.coalesce(F.get(edges, found + step - 1) <= value, F.lit(False))
        return F.when(reached, found + step).otherwise(found)

    steps = [1 << k for k in range(len(cuts).bit_length() - 1, -1, -1)]
    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), advance)


def running_totals(cells: DataFrame, keys: Sequence[str], value: str, measures: Sequence[str]) -> DataFrame:
    """Running sums along `value` inside `keys`.

    `cells` holds one row per (keys, value), with a `slice` column if the value
    range is sliced. Adds for every measure m: cum_m (sum up to and including
    this value), total_m (sum over the keys), and prev_value, the next smaller
    value (NULL at the smallest).
    """
    keys, measures = list(keys), list(measures)
    if "slice" not in cells.columns:
        along = Window.partitionBy(*keys).orderBy(value)
        upto = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        whole = Window.partitionBy(*keys)
        return cells.select(
            "*",
            *[F.sum(m).over(upto).alias(f"cum_{m}") for m in measures],
            *[F.sum(m).over(whole).alias(f"total_{m}") for m in measures],
            F.lag(value).over(along).alias("prev_value"),
        )

    # Carried columns are aggregated too: the slices then read the very same
    # cells as the body, and Spark can run that exchange once.
    carried = [c for c in cells.columns if c not in {*keys, *measures, value, "slice"}]
    sums = [F.sum(m).alias(m) for m in measures] + [F.max(c).alias(c) for c in carried]
    slices = cells.groupBy(*keys, "slice").agg(*sums, F.max(value).alias("top"))

    # One row per slice of a key combination reaches this window.
    before = Window.partitionBy(*keys).orderBy("slice")
    whole = Window.partitionBy(*keys)
    heads = slices.select(
        *keys,
        "slice",
        F.lag("top").over(before).alias(value),
        *[(F.sum(m).over(before) - F.col(m)).alias(m) for m in measures],
        *[F.sum(m).over(whole).alias(f"total_{m}") for m in measures],
        *carried,
        F.lit(0).alias("is_cell"),
    )
    body = cells.select("*", F.lit(1).alias("is_cell"))
    stacked = body.unionByName(heads, allowMissingColumns=True)

    inside = Window.partitionBy(*keys, "slice").orderBy("is_cell", value)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = stacked.select(
        *[c for c in stacked.columns if not c.startswith("total_")],
        *[F.sum(m).over(upto).alias(f"cum_{m}") for m in measures],
        *[F.first(f"total_{m}").over(upto).alias(f"total_{m}") for m in measures],
        F.lag(value).over(inside).alias("prev_value"),
    )
    return out.filter("is_cell = 1").drop("is_cell", "slice")


def with_slice(cells: DataFrame, value: str, cuts: Sequence[float]) -> DataFrame:
    return cells.withColumn("slice", slice_of(F.col(value), cuts)) if cuts else cells


def with_feature_slice(cells: DataFrame, value: str, cuts: dict[str, list[float]]) -> DataFrame:
    if not cuts:
        return cells
    chosen = F.lit(0)
    for feature, edges in cuts.items():
        chosen = F.when(F.col("feature") == feature, slice_of(F.col(value), edges)).otherwise(chosen)
    return cells.withColumn("slice", chosen)


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, fractions: dict[str, float],
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Exact linear-interpolated quantiles per key, one output column per fraction.

    The built-in exact percentile keeps every distinct value of a group in one
    buffer; this one reads them off the running counts instead.
    """
    keys = list(keys)
    present = df.filter(F.col(value).isNotNull())
    cells = present.groupBy(*keys, F.col(value).cast("double").alias("value")).agg(F.count("*").alias("n"))
    cells = with_slice(cells, "value", column_cuts(present, value, rows_per_slice))
    return quantiles_of_cells(running_totals(cells, keys, "value", ["n"]), keys, fractions)


def quantiles_of_cells(ranked: DataFrame, keys: Sequence[str], fractions: dict[str, float]) -> DataFrame:
    """Quantiles from (keys, value, n, cum_n, total_n) rows."""

    def at_rank(rank: Column) -> Column:
        covers = (F.col("cum_n") - F.col("n") < rank) & (rank <= F.col("cum_n"))
        return F.max(F.when(covers, F.col("value")))

    picked = []
    for name, fraction in fractions.items():
        position = F.lit(fraction) * (F.col("total_n") - 1)
        picked += [
            at_rank(F.floor(position) + 1).alias(f"{name}_lo"),
            at_rank(F.ceil(position) + 1).alias(f"{name}_hi"),
            F.max(position - F.floor(position)).alias(f"{name}_part"),
        ]
    found = ranked.groupBy(*keys).agg(*picked)
    return found.select(
        *keys,
        *[
            (F.col(f"{n}_lo") + (F.col(f"{n}_hi") - F.col(f"{n}_lo")) * F.col(f"{n}_part")).alias(n)
            for n in fractions
        ],
    )


def quantiles_of_slices(cells: DataFrame, keys: Sequence[str], fractions: dict[str, float], sets: DataFrame | None = None) -> DataFrame:
    """quantiles_of_cells of (keys, value, n) rows with a `slice` column, of which only the slices that hold a wanted rank are sorted.

    Rows are counted per slice first. With `sets`, (group, part) pairs without
    NULL, the cells are those of parts and the keys hold `group`: a set has the
    cells of all its parts, and only those of the wanted slices are dealt out to sets.
    """
    keys = list(keys)
    own = keys if sets is None else ["part", *[k for k in keys if k != "group"]]
    sizes = cells.groupBy(*own, "slice").agg(F.sum("n").alias("n"))
    if sets is not None:
        sizes = sizes.join(F.broadcast(sets), "part").groupBy(*keys, "slice").agg(F.sum("n").alias("n"))
    before = Window.partitionBy(*keys).orderBy("slice")
    sizes = sizes.select(
        *keys, "slice", "n", (F.sum("n").over(before) - F.col("n")).alias("ahead"), F.sum("n").over(Window.partitionBy(*keys)).alias("total"),
    )
    position = {name: F.lit(fraction) * (F.col("total") - 1) for name, fraction in fractions.items()}
    asked = F.explode(F.array(*[
        F.struct(F.lit(f"{name}_{side}").alias("what"), (at + 1).cast("bigint").alias("rank"), (p - F.floor(p)).alias("part_way"))
        for name, p in position.items() for side, at in (("lo", F.floor(p)), ("hi", F.ceil(p)))
    ])).alias("asked")
    wanted = sizes.select(*keys, "slice", "n", "ahead", asked).select("*", "asked.*").filter("ahead < rank AND rank <= ahead + n")
    wanted = wanted.select(*keys, "slice", "what", (F.col("rank") - F.col("ahead")).alias("rank"), "part_way")
    # One row or two per key and fraction.
    needed = wanted.select(*keys, "slice").distinct()
    needed = needed if sets is None else needed.join(F.broadcast(sets), "group")
    inside = cells.join(F.broadcast(needed), [*own, "slice"]).groupBy(*keys, "slice", "value").agg(F.sum("n").alias("n"))
    ranked = inside.withColumn("upto", F.sum("n").over(Window.partitionBy(*keys, "slice").orderBy("value")))
    found = ranked.join(F.broadcast(wanted), [*keys, "slice"]).filter("upto - n < rank AND rank <= upto")
    picked = lambda what, c: F.max(F.when(F.col("what") == what, F.col(c)))
    return found.groupBy(*keys).agg(*[
        (picked(f"{n}_lo", "value") + (picked(f"{n}_hi", "value") - picked(f"{n}_lo", "value")) * picked(f"{n}_lo", "part_way")).alias(n) for n in fractions
    ])


def hash_ranked(df: DataFrame, keys: Sequence[str], order: Column, tie: Sequence[str], digits: int | None = None) -> DataFrame:
    """Exact 1-based rank inside `keys` by an evenly spread hex text such as an md5.

    Adds `rank` and `group_rows`. Rows are sorted per (keys, leading hex digits);
    the number of digits follows the counted rows. NULL keys are one group.
    """
    keys = list(keys)
    digits = lead_digits(df.count()) if digits is None else digits
    tagged = df.withColumn("_hex", order).withColumn("_lead", F.substring("_hex", 1, digits))
    leads = tagged.groupBy(*keys, "_lead").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_lead")
    offsets = leads.select(
        *keys,
        "_lead",
        (F.sum("_n").over(before) - F.col("_n")).alias("_offset"),
        F.sum("_n").over(Window.partitionBy(*keys)).alias("group_rows"),
    )
    local = Window.partitionBy(*keys, "_lead").orderBy("_hex", *tie)
    numbered = tagged.withColumn("_local", F.row_number().over(local))
    return (
        _null_safe(numbered, offsets, keys, plain=["_lead"])
        .withColumn("rank", (F.col("_offset") + F.col("_local")).cast("bigint"))
        .drop("_hex", "_lead", "_local", "_offset")
    )


def hash_cutoffs(df: DataFrame, keys: Sequence[str], order: Column, tie: Sequence[str], wanted: Sequence[Column], digits: int | None = None) -> DataFrame:
    """Per key the position (hex, tie) of its wanted-th row by an evenly spread hex text.

    Columns cut_0, cut_1, ... hold structs, NULL where less than one row is
    wanted; take_0, take_1, ... tell how many of the rows at that very position
    belong to the wanted ones. `wanted` may use `group_rows`. Rows are counted per
    leading hex digits first; only the slices that a cut falls into are sorted,
    and of those only the key columns. NULL keys are one group.
    """
    keys, tie = list(keys), list(tie)
    digits = lead_digits(df.count()) if digits is None else digits
    place = F.struct(F.col("_hex").alias("hex"), *tie)
    narrow = df.select(*keys, *[t for t in tie if t not in keys], order.alias("_hex")).withColumn(
        "_lead", F.substring("_hex", 1, digits)
    )
    leads = narrow.groupBy(*keys, "_lead").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_lead")
    counted = leads.select(
        *keys, "_lead", "_n",
        (F.sum("_n").over(before) - F.col("_n")).alias("_offset"),
        F.sum("_n").over(Window.partitionBy(*keys)).alias("group_rows"),
    )
    asked = F.posexplode(F.array(*[w.cast("bigint") for w in wanted])).alias("_cut", "_wanted")
    owed = counted.select("*", asked).filter("_offset < _wanted AND _wanted <= _offset + _n").select(
        *keys, "_lead", "_cut", (F.col("_wanted") - F.col("_offset")).alias("_owed")
    )
    # One row per cut (and group), written first: with its size known, Spark broadcasts a small one and the rows stay where they lie.
    owed = materialized(owed, "cut-slices")
    cut_slices = owed.select(*keys, "_lead").distinct()
    cells = _null_safe(narrow, cut_slices, keys, "left_semi", ["_lead"])
    # Equal positions are one cell, so a key that very many rows repeat is sorted once.
    cells = cells.groupBy(*keys, "_lead", "_hex", *[t for t in tie if t not in keys]).agg(F.count("*").alias("_rows"))
    local = Window.partitionBy(*keys, "_lead").orderBy("_hex", *tie)
    placed = cells.withColumn("_upto", F.sum("_rows").over(local))
    found = _null_safe(placed, owed, keys, plain=["_lead"]).filter("_upto - _rows < _owed AND _owed <= _upto")
    cuts = []
    for i in range(len(wanted)):
        here = F.col("_cut") == i
        cuts += [F.max(F.when(here, place)).alias(f"cut_{i}"), F.max(F.when(here, F.col("_owed") - F.col("_upto") + F.col("_rows"))).alias(f"take_{i}")]
    return found.groupBy(*keys).agg(*cuts)


def with_cutoffs(df: DataFrame, keys: Sequence[str], order: Column, tie: Sequence[str], wanted: Sequence[Column], digits: int | None = None) -> DataFrame:
    """Add cut_i and take_i of the row's key and `place`, the row's own position.

    The cut-offs are one row per key combination and written once: a scalar
    subquery without keys, else a join, NULL keys included. Spark knows the size
    of the written rows and broadcasts them if it is small, so that the rows of a
    few large keys are not dealt to as few tasks.
    """
    keys = list(keys)
    cuts = materialized(hash_cutoffs(df, keys, order, tie, wanted, digits), "cuts")
    names = [f"{n}_{i}" for i in range(len(wanted)) for n in ("cut", "take")]
    placed = df.withColumn("_hex", order).withColumn("place", F.struct(F.col("_hex").alias("hex"), *tie)).drop("_hex")
    if not keys:
        return placed.withColumn("_cuts", cuts.select(F.struct(*names)).scalar()).select(
            *placed.columns, *[F.col(f"_cuts.{n}").alias(n) for n in names]
        )
    return _null_safe(placed, cuts, keys, "left")


def hash_first(df: DataFrame, keys: Sequence[str], order: Column, tie: Sequence[str], wanted: Column, digits: int | None = None) -> DataFrame:
    """The first `wanted` rows of each key by an evenly spread hex text, exactly.

    Of several rows at the last position, those first by their other columns are taken.
    """
    keys = list(keys)
    placed = with_cutoffs(df, keys, order, tie, [wanted], digits)
    below = placed.filter(F.col("place") < F.col("cut_0")).select(*df.columns)
    rest = placed.filter(F.col("place") == F.col("cut_0"))
    among = Window.partitionBy(*keys, "place").orderBy(F.xxhash64(*df.columns))
    last = rest.withColumn("_nth", F.row_number().over(among)).filter(F.col("_nth") <= F.col("take_0"))
    return below.unionByName(last.select(*df.columns))
