"""Panels of related series from latent factors, behind a gate on the relations that they really have.

A scenario is a row: its factors are arrays made by column functions, a series is a mixture of a common, a
group's and its own factor, and only then rows are made.  Draws come from hashes of scenario, attempt and
name, so a panel is the same wherever and however often it is made, and no shuffle is needed to make it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.hashing import stable_hash, unit_interval
from tidemark.operators.generators import trend_column, wave_column
from tidemark.shared import dealt, written

# Bands of general correlation and how often each is drawn; kinds of relation with their range, by pattern.
BANDS = {"low": (0.10, 0.40, 0.25), "medium": (0.40, 0.70, 0.50), "high": (0.70, 0.90, 0.25)}
GENERAL = ["multi_period", "missing_blocks", "covariates", "leakage", "residual_period", "residual_hetero"]
KINDS = {
    "scaled_groups": ("scaled_shape", 0.75, 0.95),
    "phase_groups": ("phase_shift", -0.10, 0.75),
    "distribution_mismatch": ("distribution_not_shape", -0.40, 0.40),
    "motif": ("local_motif", 0.10, 0.65),
    "sequence_anomaly": ("sequence_anomaly", 0.60, 0.90),
    "heterogeneous_panel": ("heterogeneous", 0.05, 0.65),
    "hierarchical": ("hierarchical", 0.10, 0.65),
    "intermittent": ("intermittent", 0.0, 0.60),
}
OTHER = ("general", 0.10, 0.90)
_TRENDS = ("none", "linear", "quadratic", "saturating", "piecewise")
_WAVES = ("sine", "triangle", "soft_square")


def _u(*parts: Column | str) -> Column:
    return unit_interval(stable_hash("panel", *parts))


def _between(low, high, *parts: Column | str) -> Column:
    low, high = (F.lit(float(v)) if isinstance(v, int | float) else v for v in (low, high))
    return low + (high - low) * _u(*parts)


def _normal(*parts: Column | str) -> Column:
    return F.sqrt(-2 * F.log(F.greatest(_u(*parts, "a"), F.lit(1e-12)))) * F.cos(2 * math.pi * _u(*parts, "b"))


def relation_profile(scenarios: DataFrame) -> DataFrame:
    """``scenarios`` (scenario, pattern) with kind, tier, low, high and target of the relation that is aimed at."""
    who = F.col("scenario")
    draw, cumulative, tier = _u(who, "tier"), 0.0, None
    for name, (_, _, share) in list(BANDS.items())[:-1]:
        cumulative += share
        tier = F.when(draw < cumulative, name) if tier is None else tier.when(draw < cumulative, name)
    tier = F.when(F.col("pattern").isin(GENERAL), tier.otherwise(list(BANDS)[-1]))
    kind, low, high = (F.lit(v) for v in OTHER)
    for pattern, (k, a, b) in KINDS.items():
        kind, low, high = (F.when(F.col("pattern") == pattern, v).otherwise(old) for v, old in ((k, kind), (a, low), (b, high)))
    with_kind = scenarios.withColumns({"kind": kind, "tier": tier, "low": low, "high": high})
    for name, (a, b, _) in BANDS.items():
        with_kind = with_kind.withColumns({"low": F.when(F.col("tier") == name, a).otherwise(F.col("low")), "high": F.when(F.col("tier") == name, b).otherwise(F.col("high"))})
    return with_kind.withColumn("target", _between(F.greatest(F.lit(0.0), F.col("low")), F.col("high"), who, "target"))


def _weights(rows: DataFrame) -> DataFrame:
    """w_common, w_group and w_own: shares of variance that let pairs reach the target on average."""
    k, groups = F.col("k"), F.col("groups")
    big, left = F.floor(k / groups), k % groups
    pairs = lambda s: s * (s - 1) / 2
    share = (left * pairs(big + 1) + (groups - left) * pairs(big)) / F.greatest(F.lit(1.0), pairs(k))
    kind, target = F.col("kind"), F.col("target")
    group = (
        F.when(kind == "scaled_shape", 0.02).when(kind.isin("heterogeneous", "local_motif"), 0.12)
        .when(kind.isin("phase_shift", "distribution_not_shape", "sequence_anomaly"), 0.0).otherwise(F.least(F.lit(0.18), F.greatest(F.lit(0.05), (1 - target) * 0.25)))
    )
    clip = lambda v, a, b: F.greatest(F.lit(a), F.least(F.lit(b), v))
    tall = clip(target, 0.18, 0.60)
    common = F.when(kind == "hierarchical", tall).otherwise(clip(target - share * group, 0.02, 0.92))
    group = F.when(kind == "hierarchical", F.least(F.lit(0.45), 0.85 - tall)).otherwise(group)
    own = F.when(kind == "hierarchical", 1 - common - group).otherwise(F.greatest(F.lit(0.04), 1 - common - group))
    total = common + group + own
    return rows.withColumns({"w_common": common / total, "w_group": group / total, "w_own": own / total})


def _standard(values: Column) -> Column:
    """The array without its mean, over its deviation."""
    total = lambda v: F.aggregate(v, F.lit(0.0), lambda s, x: s + x)
    inner = lambda v: F.transform(F.array(total(v) / F.size(v)), lambda m: F.transform(v, lambda x: x - m))[0]
    scaled = lambda c: F.transform(F.array(F.sqrt(total(F.transform(c, lambda x: x * x)) / F.size(c)) + 1e-8), lambda d: F.transform(c, lambda x: x / d))[0]
    return F.transform(F.transform(F.array(values), inner), scaled)[0]


def _factor(name: Column, period: Column, seasonal_only: Column | None = None) -> Column:
    """A standardised latent signal of a scenario: a trend, a wave and some noise."""
    key = (F.col("scenario"), F.col("attempt"), name)
    pick = lambda kinds, what: F.element_at(F.array(*map(F.lit, kinds)), (F.floor(_u(*key, what) * len(kinds)) + 1).cast("int"))
    # a draw of the whole signal is held as one value, so that it is hashed once and not at every point
    drawn = F.struct(
        _between(-1.2, 1.2, *key, "rise").alias("rise"), _u(*key, "phase").alias("phase"), pick(_TRENDS, "trend").alias("trend"), pick(_WAVES, "wave").alias("wave"),
        period.alias("period"), (F.lit(False) if seasonal_only is None else seasonal_only).alias("plain"),
    )

    def at(t: Column, h: Column) -> Column:
        season = wave_column(h["wave"], t / h["period"] + h["phase"])
        whole = h["rise"] * trend_column(h["trend"], t / F.greatest(F.lit(1), F.col("n") - 1)) + season + 0.35 * _normal(*key, t.cast("string"))
        return whole if seasonal_only is None else F.when(h["plain"], season).otherwise(whole)

    return _standard(F.transform(F.array(drawn), lambda h: F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda t: at(t, h)))[0])


def _shuffled_blocks(n: Column, *key: Column | str) -> Column:
    """Places 0 to n - 1 with their blocks, 5 to 16 of them, in the order of a hash."""
    blocks = F.greatest(F.lit(5), F.least(F.lit(16), F.floor(n / 35).cast("int")))
    small, left = F.floor(n / blocks).cast("int"), n % blocks
    order = F.array_sort(F.transform(F.sequence(F.lit(0), blocks - 1), lambda b: F.struct(_u(*key, b.cast("string")).alias("u"), b.alias("b"))))
    start = lambda b: b * small + F.least(b, left)
    return F.flatten(F.transform(order, lambda o: F.sequence(start(o["b"]), start(o["b"]) + small + (o["b"] < left).cast("int") - 1)))


def synthesize(scenarios: DataFrame) -> DataFrame:
    """A row for each series: its values as an array, and how it was made.

    ``scenarios`` has scenario, attempt, pattern, n (points, 20 or more), k (series), period, odd (the series that
    stands out in ``sequence_anomaly``) and what ``relation_profile`` adds.  Phase groups roll the common factor by
    parts of its period; distribution mismatch reorders its blocks; motifs, an odd series' own wave and local
    reversals are added on top.  A scenario without series makes no rows; nulls make null values.
    """
    base = _weights(dealt(scenarios, "scenario").withColumn("groups", F.when(F.col("pattern") == "phase_groups", 3).otherwise(2)))
    phased = F.col("pattern") == "phase_groups"
    group_names = F.transform(F.sequence(F.lit(0), F.col("groups") - 1), lambda g: F.concat(F.lit("g"), g))
    made = base.withColumn("common", _factor(F.lit("common"), F.col("period"), phased)).withColumn("group_factors", F.transform(group_names, lambda g: _factor(g, _own_period(g))))
    each = made.where("k > 0").withColumn("series", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    i, n, name = F.col("series"), F.col("n"), F.concat(F.lit("s"), F.col("series"))
    key = (F.col("scenario"), F.col("attempt"), name)
    odd = (F.col("pattern") == "sequence_anomaly") & (i == F.col("odd"))
    is_ = lambda p: F.col("pattern") == p
    weight = lambda c, phase, block, alone: F.when(odd, alone).when(is_("phase_groups"), phase).when(is_("distribution_mismatch"), block).otherwise(F.col(c))
    group = (i % F.col("groups")).cast("int")
    lag = F.when(phased, F.round(group / F.col("groups") * F.col("period"))).otherwise(0).cast("int")
    scale = F.when(is_("scaled_groups"), 0.60 + 0.28 * i).when(is_("heterogeneous_panel"), _between(0.55, 1.75, *key, "scale")).otherwise(_between(0.82, 1.22, *key, "scale"))
    offset = F.when(is_("scaled_groups"), _between(-2, 2, *key, "offset")).when(is_("heterogeneous_panel"), _between(-12, 16, *key, "offset")).otherwise(_between(-6, 7, *key, "offset"))
    amplitude = F.when(is_("heterogeneous_panel"), _between(8, 19, *key, "amplitude")).otherwise(_between(9, 16, *key, "amplitude"))
    told = each.withColumns({
        "grp": group, "lag": lag, "wc": weight("w_common", 0.88, 0.82, 0.04), "wg": weight("w_group", 0.0, 0.0, 0.0), "wi": weight("w_own", 0.12, 0.18, 0.96),
        "scale": scale, "offset": offset, "amplitude": amplitude, "own": _factor(name, _own_period(name)),
        "places": F.when(is_("distribution_mismatch"), _shuffled_blocks(n, *key, "block")).otherwise(F.transform(F.sequence(F.lit(0), n - 1), lambda t: F.pmod(t - lag, n))),
        "motif_length": F.when(is_("motif"), F.greatest(F.lit(12), F.least(F.lit(36), F.floor(n / 12).cast("int")))),
        "motif_starts": F.when(is_("motif"), F.array((F.floor(n * 0.18) + 2 * i).cast("int"), (F.floor(n * 0.62) - i).cast("int"))),
    })
    # what all points share is held as one value, so that it is worked out once a series and not once a point
    held = F.struct(
        "own", "places", F.get("group_factors", F.col("grp")).alias("grouped"), F.sqrt("wc").alias("wc"), F.sqrt("wg").alias("wg"), F.sqrt("wi").alias("wi"),
        (45 + F.col("offset")).alias("base"), (F.col("amplitude") * F.col("scale")).alias("stretch"), odd.alias("odd"), *_extras(key),
    )

    def value(t: Column, h: Column) -> Column:
        mixed = h["wc"] * F.get("common", F.get(h["places"], t)) + h["wg"] * F.get(h["grouped"], t) + h["wi"] * F.get(h["own"], t)
        return h["base"] + h["stretch"] * mixed + _added(t, key, h)

    kept = ["scenario", "attempt", "series", "pattern", "kind", "tier", "low", "high", "target", "n", "k", "odd", "grp", "lag", "wc", "wg", "wi", "scale", "offset", "amplitude", "motif_starts", "motif_length"]
    points_of = F.transform(F.array(held), lambda h: F.transform(F.sequence(F.lit(0), n - 1), lambda t: value(t, h)))
    return told.select(*kept, points_of[0].alias("values"))


def _own_period(name: Column) -> Column:
    return F.greatest(F.lit(6.0), F.col("n") / (4 + F.floor(8 * _u(F.col("scenario"), F.col("attempt"), name, "period"))))


def _extras(key: tuple) -> list[Column]:
    """Draws of what may stand on top of a series' factors."""
    n = F.col("n")
    return [
        "motif_starts", "motif_length", _between(28, 40, *key, "motif").alias("motif_height"), _between(5, 12, *key, "wave height").alias("wave_height"),
        F.greatest(F.lit(4.0), n / _between(5, 11, *key, "waves")).alias("wave_length"), _between(7, 13, *key, "reversal").alias("reversal"),
        F.floor(n * 0.62).alias("reversed_at"), F.greatest(F.lit(8.0), F.floor(n / 16).cast("double")).alias("width"),
    ]


def _added(t: Column, key: tuple, h: Column) -> Column:
    """What stands on top of the factors at t: motifs, the odd series' wave, a local reversal."""
    n, length = F.col("n"), h["motif_length"]

    def motif(start: Column) -> Column:
        inside = (t >= start) & (t < start + length) & (start + length <= n)
        return F.when(inside, h["motif_height"] * F.sin(2 * math.pi * (t - start) / (length - 1)) + 0.35 * _normal(*key, "motif", t.cast("string"))).otherwise(0.0)

    motifs = F.when(F.col("pattern") == "motif", motif(h["motif_starts"][0]) + motif(h["motif_starts"][1])).otherwise(0.0)
    wave = h["wave_height"] * F.sin(2 * math.pi * t / h["wave_length"])
    late = (F.col("pattern") == "heterogeneous_panel") & (F.col("series") >= F.greatest(F.lit(1), F.col("k") - 2))
    reversal = -h["reversal"] * F.exp(-0.5 * F.pow((t - h["reversed_at"]) / h["width"], 2))
    return motifs + F.when(h["odd"], wave).otherwise(0.0) + F.when(late, reversal).otherwise(0.0)


def points(panel: DataFrame) -> DataFrame:
    """(scenario, series, t, value) of a synthesized panel."""
    return panel.select("scenario", "series", F.posexplode("values").alias("t", "value"))


def _corr(x: Column, y: Column) -> Column:
    """r of two arrays of one length; null where one is constant."""
    total = lambda v: F.aggregate(v, F.lit(0.0), lambda s, e: s + e)
    mean = lambda v: total(v) / F.size(v)
    centred = lambda v: F.transform(F.array(mean(v)), lambda m: F.transform(v, lambda e: e - m))[0]

    def of(p: Column) -> Column:
        square = lambda v: total(F.transform(v, lambda e: e * e))
        return F.try_divide(total(F.zip_with(p["x"], p["y"], lambda a, b: a * b)), F.sqrt(square(p["x"]) * square(p["y"])))

    return F.transform(F.array(F.struct(centred(x).alias("x"), centred(y).alias("y"))), of)[0]


def panel_metrics(panel: DataFrame) -> DataFrame:
    """For each scenario and attempt the relations between its series, those that its pattern is judged by.

    Pairs of series are pairs within one panel, as many as its width gives; the rest is arithmetic on arrays.
    """
    panel = dealt(panel, "scenario", "attempt")
    side = lambda s: panel.select("scenario", "attempt", F.col("series").alias(f"s{s}"), F.col("grp").alias(f"g{s}"), F.col("values").alias(f"v{s}"), F.get("motif_starts", F.lit(0)).alias(f"m{s}"))
    about = panel.groupBy("scenario", "attempt").agg(*[F.first(c).alias(c) for c in ("pattern", "kind", "low", "high", "n", "k", "odd", "motif_length")])
    pairs = side("a").join(side("b"), ["scenario", "attempt"]).where("sa < sb").join(about, ["scenario", "attempt"])
    reach = F.least(F.lit(60), F.greatest(F.lit(3), F.floor(F.col("n") / 6).cast("int")))

    def lagged(lag: Column) -> Column:
        size = (F.col("n") - F.abs(lag)).cast("int")
        return _corr(F.slice("va", F.greatest(lag, F.lit(0)) + 1, size), F.slice("vb", F.greatest(-lag, F.lit(0)) + 1, size))

    first = F.col("sa") == 0
    best = F.when(first & (F.col("pattern") == "phase_groups"), F.array_max(F.transform(F.sequence(-reach, reach), lagged)))
    total = lambda v: F.aggregate(v, F.lit(0.0), lambda s, e: s + e)
    both = F.concat("va", "vb")
    spread = F.transform(F.array(total(both) / F.size(both)), lambda m: F.sqrt(total(F.transform(both, lambda e: (e - m) * (e - m))) / (F.size(both) - 1)))[0]
    moved = total(F.zip_with(F.array_sort("va"), F.array_sort("vb"), lambda a, b: F.abs(a - b))) / F.col("n")
    far = F.when(first & (F.col("pattern") == "distribution_mismatch"), moved / (spread + 1e-8))
    local = F.when(first & (F.col("pattern") == "motif"), _corr(F.slice("va", F.col("ma") + 1, F.col("motif_length")), F.slice("vb", F.col("mb") + 1, F.col("motif_length"))))
    odd = (F.col("pattern") == "sequence_anomaly") & ((F.col("sa") == F.col("odd")) | (F.col("sb") == F.col("odd")))
    scored = pairs.select("scenario", "attempt", "ga", "gb", odd.alias("is_odd"), _corr(F.col("va"), F.col("vb")).alias("r"), best.alias("best"), far.alias("far"), local.alias("local"))
    same = F.col("ga") == F.col("gb")
    found = scored.groupBy("scenario", "attempt").agg(
        F.avg("r").alias("mean_r"), F.coalesce(F.min("r") > 0.9, F.lit(False)).alias("all_above"), F.avg(F.when(same, F.col("r"))).alias("within_r"), F.avg(F.when(~same, F.col("r"))).alias("between_r"),
        F.avg("best").alias("best_lag_r"), F.avg("far").alias("distance"), F.avg("local").alias("motif_r"), F.avg(F.when(~F.col("is_odd"), F.col("r"))).alias("normal_r"), F.avg(F.when(F.col("is_odd"), F.col("r"))).alias("odd_r"),
    )
    return about.join(found, ["scenario", "attempt"], "left")


def relation_reasons() -> Column:
    """Names of what a panel's metrics lack for its kind of relation; none for a panel of one series."""
    mean, within, between = F.col("mean_r"), F.col("within_r"), F.col("between_r")
    outside = lambda c, a, b: ~F.coalesce(c.between(a, b), F.lit(False))
    least = lambda c, a: ~F.coalesce(c >= a, F.lit(False))
    most = lambda c, b: ~F.coalesce(c <= b, F.lit(False))
    rules = [
        ("general", "general_correlation_out_of_band", ~F.coalesce(mean.between(F.col("low") - 0.06, F.col("high") + 0.06), F.lit(False))),
        ("general", "general_mean_above_0_90", mean > 0.90),
        ("general", "all_pairs_above_0_90", F.col("all_above")),
        ("scaled_shape", "scaled_shape_correlation_out_of_band", outside(mean, 0.75, 0.95)),
        ("phase_shift", "phase_zero_lag_out_of_band", outside(mean, -0.10, 0.75)),
        ("phase_shift", "phase_best_lag_too_low", least(F.col("best_lag_r"), 0.80)),
        ("distribution_not_shape", "distribution_shape_correlation_too_high", F.abs(mean) > 0.40),
        ("distribution_not_shape", "distribution_distance_too_high", most(F.col("distance"), 0.45)),
        ("local_motif", "motif_global_correlation_out_of_band", outside(mean, 0.10, 0.65)),
        ("local_motif", "motif_local_similarity_too_low", least(F.col("motif_r"), 0.80)),
        ("sequence_anomaly", "normal_group_correlation_out_of_band", outside(F.col("normal_r"), 0.60, 0.90)),
        ("sequence_anomaly", "anomaly_not_separated", most(F.col("odd_r"), 0.45)),
        ("heterogeneous", "heterogeneous_correlation_out_of_band", outside(mean, 0.05, 0.65)),
        ("hierarchical", "hierarchy_within_group_out_of_band", outside(within, 0.55, 0.90)),
        ("hierarchical", "hierarchy_between_group_out_of_band", outside(between, 0.10, 0.65)),
        ("hierarchical", "hierarchy_group_gap_too_small", least(within - between, 0.15)),
        ("intermittent", "intermittent_correlation_out_of_band", outside(mean, 0.0, 0.60)),
    ]
    told = F.array_compact(F.array(*[F.when((F.col("kind") == kind) & broken, reason) for kind, reason, broken in rules]))
    return F.when(F.col("k") < 2, F.array().cast("array<string>")).when(mean.isNull(), F.array(F.lit("raw_correlation_unavailable"))).otherwise(told)


def gated_panels(scenarios: DataFrame, attempts: int = 12) -> tuple[DataFrame, DataFrame]:
    """Panels whose relations hold, and for each scenario its attempts and what the last one lacked.

    Only scenarios that failed are made again, with other draws; one that never holds has no panel but keeps
    its reasons, one without series has neither.
    """
    left = written(relation_profile(scenarios.where("k > 0")), "scenarios")
    kept, verdicts = [], []
    for attempt in range(attempts):
        panel = written(synthesize(left.withColumn("attempt", F.lit(attempt))), "panel")
        judged = written(panel_metrics(panel).withColumn("reasons", relation_reasons()), "panel-verdicts")
        passed = judged.where("size(reasons) = 0").select("scenario")
        kept.append(panel.join(passed, "scenario", "left_semi"))
        last = judged if attempt == attempts - 1 else judged.join(passed, "scenario", "left_semi")
        verdicts.append(last.select("scenario", "pattern", (F.col("attempt") + 1).alias("attempts"), *[F.round(c, 4).alias(c) for c in ("mean_r", "within_r", "between_r")], F.array_join("reasons", ",").alias("reasons")))
        if judged.where("size(reasons) > 0").isEmpty():
            break
        left = left.join(passed, "scenario", "left_anti")
    panels, verdict = kept[0], verdicts[0]
    for p, v in zip(kept[1:], verdicts[1:], strict=True):
        panels, verdict = panels.unionByName(p), verdict.unionByName(v)
    return panels, verdict
