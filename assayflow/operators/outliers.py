"""Outlier flags: domain rules, grouped log-IQR fences with adaptive width, and their sequence."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayflow import defaults as D
from assayflow.functions.numbers import flag, log10_positive, nan_to_null, safe_ratio
from assayflow.operators.isolation import IsolationForest, isolation_features
from assayflow.operators.joins import join_groups
from assayflow.operators.quantiles import exact_quantiles, quantile_values
from assayflow.operators.stats import group_median_mad
from assayflow.sources.tables import Scope, cut_lineage, scope


def any_of(predicates: Sequence[Column]) -> Column:
    """OR of predicates in which a missing value raises no flag."""
    return reduce(lambda a, b: a | b, [flag(p) for p in predicates], F.lit(False))


# --- domain rules --------------------------------------------------------------------------------

def default_rules(ph: str = "pH_value", temperature: str = "temperature_C",
                  measures: Sequence[str] = ("kcat_value", "km_value"),
                  unknown: str = "unknown_frac") -> dict[str, Column]:
    """{column: predicate of a value that cannot be right}. Extend or replace as needed."""
    known = lambda c: nan_to_null(F.col(c).cast("double"))
    rules = {
        ph: (known(ph) <= D.PH_RANGE[0]) | (known(ph) > D.PH_RANGE[1]),
        temperature: ((known(temperature) < D.TEMPERATURE_RANGE[0])
                      | (known(temperature) > D.TEMPERATURE_RANGE[1])),
        unknown: known(unknown) > D.MAX_UNKNOWN_FRACTION,
    }
    return rules | {m: known(m) <= 0 for m in measures}


def domain_flag(df: DataFrame, rules: dict[str, Column] | None = None) -> Column:
    """Flag of rows that break a rule; rules on absent columns are skipped."""
    rules = default_rules() if rules is None else rules
    return any_of([p for c, p in rules.items() if c in df.columns])


# --- log-IQR fences ------------------------------------------------------------------------------

def measures_of(df: DataFrame, a: str, b: str, use_ratio: bool = True) -> dict[str, Column]:
    """log10 of the two measures and of their ratio."""
    logs = {"_x_a": log10_positive(F.col(a)), "_x_b": log10_positive(F.col(b))}
    if use_ratio:
        logs["_x_ratio"] = log10_positive(safe_ratio(F.col(a), F.col(b)))
    return logs


def quartile_names(logs) -> list[str]:
    return [f"{q}{x}" for x in logs for q in ("q1", "q3")]


def _outside(x: str, fence) -> Column:
    q1, q3 = F.col(f"q1{x}"), F.col(f"q3{x}")
    width = q3 - q1
    return (F.col(x) < q1 - fence * width) | (F.col(x) > q3 + fence * width)


def _outside_any(logs: Sequence[str], fence) -> Column:
    return any_of([_outside(x, fence) for x in logs])


def group_fences(df: DataFrame, a: str, b: str, group: str, *, fence: float = D.FENCE,
                 adaptive: bool = True, target_rate: float = D.TARGET_RATE,
                 fence_grid: Sequence[float] = D.FENCE_GRID, min_group_size: int = D.MIN_GROUP_SIZE,
                 use_ratio: bool = True, limit: int | None = None) -> DataFrame:
    """One row per group: size, quartiles per measure, flag rate per fence, and the chosen fence.

    Groups of at least ``min_group_size`` rows take the tightest fence that flags no more than
    ``target_rate`` of their rows; NULL when none does. Smaller groups take ``fence``. The table is
    written out, so that whatever uses it reads a few numbers per group and not the rows again.
    """
    with scope() as held:
        return held.keep(cut_lineage(_fences(df, a, b, group, fence, adaptive, target_rate, fence_grid, min_group_size, use_ratio, limit)))


def _fences(df, a, b, group, fence, adaptive, target_rate, fence_grid, min_group_size, use_ratio, limit) -> DataFrame:
    logs = measures_of(df, a, b, use_ratio)
    # What the passes below read is a key and a few numbers per row, whatever it took to compute them.
    rows = cut_lineage(df.select(group, *[x.alias(name) for name, x in logs.items()]))
    quartiles = exact_quantiles(rows, list(logs), [0.25, 0.75], [group], limit)
    quartiles = quartiles.select(group, "n_rows", *[F.get(f"q_{x}", i).alias(q) for x in logs
                                                    for i, q in enumerate(quartile_names([x]))])
    quartiles = cut_lineage(quartiles)  # its size decides how it is joined
    if not adaptive:
        return quartiles.withColumn("fence", F.lit(float(fence)))
    joined = join_groups(rows, quartiles, [group], "left")
    rates = joined.groupBy(group).agg(
        *[F.first(c).alias(c) for c in ("n_rows", *quartile_names(logs))],
        *[F.avg(_outside_any(list(logs), f).cast("int")).alias(f"rate_{i}") for i, f in enumerate(fence_grid)])
    chosen = F.when(F.col("n_rows") < min_group_size, F.lit(float(fence)))
    for i, f in enumerate(fence_grid):
        chosen = chosen.when(F.col(f"rate_{i}") <= target_rate, F.lit(float(f)))
    return rates.withColumn("fence", chosen)


def adaptive_iqr(df: DataFrame, a: str = "kcat_value", b: str = "km_value", group: str | None = "enzyme", *,
                 name: str = "kinetics_flag", fallback: str = "none", mad_cutoff: float = D.MAD_CUTOFF,
                 use_ratio: bool = True, limit: int | None = None, keep_fence: bool = False,
                 **options) -> DataFrame:
    """Add the flag of rows whose log10 value of a, b or a/b lies outside the fence of their group.

    ``fallback='mad'`` flags by distance from the median in groups where no fence reaches the
    target rate; otherwise such groups flag nothing. Without the group column the whole table is
    one group.
    """
    if a not in df.columns or b not in df.columns:
        return df.withColumn(name, F.lit(False))
    if group is None or group not in df.columns:
        whole = df.withColumn("_whole", F.lit(1))
        return adaptive_iqr(whole, a, b, "_whole", name=name, fallback=fallback, mad_cutoff=mad_cutoff,
                            use_ratio=use_ratio, limit=limit, keep_fence=keep_fence, **options).drop("_whole")

    logs = measures_of(df, a, b, use_ratio)
    fences = group_fences(df, a, b, group, use_ratio=use_ratio, limit=limit, **options)
    fences = fences.select(group, "fence", *quartile_names(logs))
    if fallback == "mad":
        fences = _with_mad(df, fences, logs, group, limit)
    rows = join_groups(df.withColumns(logs), fences, [group], "left")
    flagged = flag(F.col("fence").isNotNull() & _outside_any(list(logs), F.col("fence")))
    if fallback == "mad":
        far = [F.abs(F.col(x) - F.col(f"med_{x}")) > mad_cutoff * D.MAD_SCALE * F.col(f"mad_{x}") for x in logs]
        spread = [F.col(f"mad_{x}") > 0 for x in logs]
        flagged = flagged | (F.col("fence").isNull() & any_of([s & f for s, f in zip(spread, far)]))
    extra = [F.col("fence").alias(f"{name}_fence")] if keep_fence else []
    return rows.select(*df.columns, *extra, flagged.alias(name))


def _with_mad(df, fences, logs, group, limit) -> DataFrame:
    """Add median and MAD for the groups without a fence; only their rows are read again."""
    failing = fences.filter(F.col("fence").isNull()).select(group)
    rows = df.select(group, *[x.alias(n) for n, x in logs.items()])
    middle = group_median_mad(join_groups(rows, failing, [group], "left_semi"), list(logs), [group], limit)
    return join_groups(fences, middle, [group], "left")


def iqr_bounds(df: DataFrame, values: dict[str, Column], fence: float = D.FENCE,
               limit: int | None = None) -> dict[str, tuple[float, float] | None]:
    """Bounds on the log10 scale over the whole table, per named value."""
    logs = df.select(*[log10_positive(x).alias(n) for n, x in values.items()])
    bounds = {}
    for n, q in quantile_values(logs, list(values), [0.25, 0.75], limit).items():
        bounds[n] = (q[0] - fence * (q[1] - q[0]), q[1] + fence * (q[1] - q[0])) if q else None
    return bounds


def fixed_iqr(df: DataFrame, a: str = "kcat_value", b: str = "km_value", fence: float = D.FENCE,
              name: str = "kinetics_flag", limit: int | None = None) -> DataFrame:
    """Flag by one fixed fence over the whole table. The bounds become literals: no join."""
    values = {"a": F.col(a), "b": F.col(b), "ratio": safe_ratio(F.col(a), F.col(b))}
    outside = []
    for n, bound in iqr_bounds(df, values, fence, limit).items():
        if bound:
            x = log10_positive(values[n])
            outside.append((x < bound[0]) | (x > bound[1]))
    return df.withColumn(name, any_of(outside))


# --- the three stages ----------------------------------------------------------------------------

def apply_outlier_strategy(df: DataFrame, *, row_id: Sequence[str], a: str = "kcat_value", b: str = "km_value",
                           group: str | None = "enzyme", rules: dict[str, Column] | None = None,
                           iso_columns: Sequence[str] | None = None, contamination: float = D.CONTAMINATION,
                           isolation: bool = True, limit: int | None = None, **options) -> DataFrame:
    """Keep the rows that pass domain rules, then the fences, then the isolation forest.

    Every stage is fitted on the survivors of the stage before.
    """
    rules = rules or default_rules(measures=(a, b))
    survivors = df.filter(~domain_flag(df, rules))
    survivors = adaptive_iqr(survivors, a, b, group, name="_kin", limit=limit, **options)
    survivors = survivors.filter(~F.col("_kin")).drop("_kin")
    if not isolation:
        return survivors
    columns = iso_columns or isolation_features(survivors)
    with scope() as held:
        scored, threshold = score_once(held, survivors, columns, row_id, contamination, "_iso", limit=limit)
    return scored.filter(~flag(F.col("_iso") < F.lit(threshold))).drop("_iso")


def score_once(held: Scope, df: DataFrame, columns: Sequence[str], row_id: Sequence[str], contamination: float, name: str,
               among: Column | None = None, limit: int | None = None) -> tuple[DataFrame, float]:
    """The rows with their score, written and handed on by the scope ``held``, and the threshold below which the contamination share lies.

    The forest and the threshold rest on the rows that ``among`` picks, by default all. The rows are computed once and scored once: both
    tables are written, and the threshold is found in the second one.
    """
    rows = cut_lineage(df)
    known = rows if among is None else rows.filter(among)
    forest = IsolationForest(columns, row_id, contamination).fit(known, limit)
    scored = held.keep(cut_lineage(forest.score(rows, name), last=[rows]))
    return scored, forest.threshold_of(scored if among is None else scored.filter(among), name, limit)


def sequential_labels(df: DataFrame, *, row_id: Sequence[str], a: str = "kcat_value", b: str = "km_value",
                      group: str | None = "enzyme", rules: dict[str, Column] | None = None,
                      iso_columns: Sequence[str] | None = None, contamination: float = D.CONTAMINATION,
                      isolation: bool = True, name: str = "outcome", limit: int | None = None,
                      **options) -> DataFrame:
    """Label every row with the stage that drops it: domain_drop, kinetics_drop, iso_drop or kept.

    Rows of earlier stages stay in the table but give no value to later fits.
    """
    rules = rules or default_rules(measures=(a, b))
    labelled = df.withColumn("_dom", domain_flag(df, rules))
    masked = labelled.withColumns({"_a": F.when(~F.col("_dom"), F.col(a)), "_b": F.when(~F.col("_dom"), F.col(b))})
    survivors = masked.filter(~F.col("_dom"))
    if group is None or group not in df.columns:
        group = "_whole"
        masked = masked.withColumn(group, F.lit(1))
        survivors = survivors.withColumn(group, F.lit(1))
    logs = measures_of(masked, "_a", "_b")
    fences = group_fences(survivors, "_a", "_b", group, limit=limit, **options)
    rows = join_groups(masked.withColumns(logs), fences.select(group, "fence", *quartile_names(logs)),
                       [group], "left")
    kinetics = flag(F.col("fence").isNotNull() & _outside_any(list(logs), F.col("fence")))
    labelled = rows.select(*df.columns, "_dom", kinetics.alias("_kin"))
    iso = F.lit(False)
    if isolation:
        columns = iso_columns or isolation_features(df)
        with scope() as held:
            labelled, threshold = score_once(held, labelled, columns, row_id, contamination, "_score", ~F.col("_dom") & ~F.col("_kin"), limit)
        iso = flag(F.col("_score") < F.lit(threshold))
    outcome = (F.when(F.col("_dom"), "domain_drop").when(F.col("_kin"), "kinetics_drop")
               .when(iso, "iso_drop").otherwise("kept"))
    return labelled.select(*df.columns, outcome.alias(name))


def independent_masks(df: DataFrame, *, a: str = "kcat_value", b: str = "km_value", fence: float = D.FENCE,
                      rules: dict[str, Column] | None = None, row_id: Sequence[str] = (),
                      iso_columns: Sequence[str] | None = None, contamination: float = D.CONTAMINATION,
                      isolation: bool = True, limit: int | None = None) -> DataFrame:
    """Flags of all rules side by side, each on the full table: domain, kinetics (one fence), iso."""
    rules = rules or default_rules(measures=(a, b))
    flags = fixed_iqr(df.withColumn("domain", domain_flag(df, rules)), a, b, fence, "kinetics", limit)
    if not isolation:
        return flags
    columns = iso_columns or isolation_features(df)
    with scope() as held:
        scored, threshold = score_once(held, flags, columns, row_id, contamination, "iso_score", limit=limit)
    return scored.withColumn("iso", flag(F.col("iso_score") < F.lit(threshold)))


def priority_label(flags: dict[str, Column], order: Sequence[str], otherwise: str = "regular") -> Column:
    """The first flag that is up, in the given order."""
    return F.coalesce(*[F.when(flag(flags[k]), F.lit(k)) for k in order if k in flags], F.lit(otherwise))


def reason_counts(df: DataFrame, flags: dict[str, Column], order: Sequence[str]) -> DataFrame:
    """(reason, n): every flagged row counts once, under its first reason."""
    return (df.select(priority_label(flags, order).alias("reason")).filter(F.col("reason") != "regular")
            .groupBy("reason").agg(F.count(F.lit(1)).alias("n")))


def flag_totals(df: DataFrame, flags: dict[str, Column]) -> DataFrame:
    """(flag, n) where a row may count under several flags."""
    sums = df.agg(*[F.count_if(flag(c)).alias(n) for n, c in flags.items()])
    return sums.select(F.inline(F.array(*[F.struct(F.lit(n).alias("flag"), F.col(n).alias("n")) for n in flags])))
