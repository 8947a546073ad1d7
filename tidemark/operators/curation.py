"""Gates and merges over recorded rows: versions, verdicts, repairs, catalogues, asserted findings, difficulty."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Chinese words for things that data claims are about, findings, assertions and doubt.
ENTITY = "数据|序列|指标|残差|模型|训练|验证|预测|预测区间|时间戳|时间索引|历史数据|历史观测|样本"
FINDING = (
    "缺失|异常|趋势|周期|季节|漂移|变点|相关|自相关|异方差|非平稳|长尾|零膨胀|偏差|偏离|遗漏|过拟合|欠拟合|震荡|白噪声|覆盖|退化|相似|差异|不同|不规则|历史(?:较短|较长|有限|不足)"
)
ASSERTION = "存在|出现|呈现|表现|包含|显示|发现|具有|都有|均有|明显|显著|有限|不足|较短|较长|严重|偏离|遗漏|过拟合|欠拟合|震荡|退化|相似|不同"
DOUBT = "是否|有无|能否|判断|检查|识别|评估|确认|核验|验证|分析|不确定|如果|若"
CLAUSE_ENDS = "[，。；？！\n]"


def finding_assertions(text: Column) -> Column:
    """Clauses that claim a finding about data and voice no doubt; a null text has none."""
    claims = lambda c: c.rlike(ENTITY) & c.rlike(FINDING) & c.rlike(ASSERTION) & ~c.rlike(DOUBT)
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), CLAUSE_ENDS), lambda c: F.trim(c)), claims)


def stale_rows(rows: DataFrame, key: str, version: str, current: str, shown: int = 3) -> DataFrame:
    """One row: how many rows don't have the ``current`` version (null neither), and the least ``shown`` keys of them."""
    stale = rows.where(~F.col(version).eqNullSafe(F.lit(current)))
    first = stale.orderBy(key).limit(shown).agg(F.array_sort(F.collect_list(key)).alias("first"))
    return stale.agg(F.count("*").alias("n_stale")).join(F.broadcast(first))


def require_version(rows: DataFrame, key: str, version: str, current: str) -> DataFrame:
    """``rows``, or an error that names the first stale ones."""
    found = stale_rows(rows, key, version, current).first()
    if found.n_stale:
        raise ValueError(f"{found.n_stale} rows aren't of version {current}: {', '.join(map(str, found.first))}")
    return rows


def route(rows: DataFrame, passed: Column, path: str) -> None:
    """Write ``rows`` below ``path`` in one pass, passed and rejected ones (nulls among them) in folders of their own."""
    rows.withColumn("passed", F.coalesce(passed, F.lit(False))).write.partitionBy("passed").mode("overwrite").parquet(path)


def limited_with_repairs(rows: DataFrame, group: str, invalid: Column, limit: int) -> DataFrame:
    """Rows of the least ``limit`` groups, and of every later group with an invalid row; ``repair`` marks the latter."""
    groups = rows.groupBy(group).agg(F.max(F.coalesce(invalid, F.lit(False))).alias("bad"))
    first = groups.orderBy(group).limit(limit).select(group, F.lit(True).alias("chosen"))
    taken = groups.join(first, group, "left").where(F.col("chosen") | F.col("bad")).select(group, F.col("chosen").isNull().alias("repair"))
    return rows.join(taken, group)


def merged_catalogue(sources: list[DataFrame], name: str) -> DataFrame:
    """The entries of all sources, each name once: that of the first source that has it; absent columns are null."""
    ranked = [s.withColumn("source_rank", F.lit(k)) for k, s in enumerate(sources)]
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), ranked)
    columns = [c for c in union.columns if c != name]
    best = union.groupBy(name).agg(F.min_by(F.struct(*columns), F.struct("source_rank", *[c for c in columns if c != "source_rank"])).alias("entry"))
    return best.select(name, "entry.*")


def difficulty(facts: DataFrame) -> DataFrame:
    """``facts`` with reasons and difficulty: hard if one reason is a conflict and there are two or more, else medium.

    Facts of a scenario: complexity, pattern, within and between (mean correlations in and across groups),
    mechanisms (of missing values), seasons (their number), season_moves (a period drifts or holds in a
    part only) and noise.  A null fact is no reason.
    """
    usual = F.col("pattern") != "intermittent"
    blocks = F.col("pattern") == "missing_blocks"
    when = {
        "confounded_components": F.col("complexity") == "confounded",
        "cross_series_heterogeneity": F.abs(F.col("within") - F.col("between")) >= 0.15,
        "ambiguous_missing_mechanism": blocks & F.exists("mechanisms", lambda m: m.contains("value_dependent") | m.contains("synchronous")),
        "mixed_missing_mechanisms": blocks & (F.size(F.array_distinct("mechanisms")) > 1),
        "diagnostic_conflict": F.col("pattern").isin("distribution_mismatch", "sequence_anomaly", "residual_hetero", "drift"),
        "time_varying_multiseasonality": usual & (F.col("seasons") >= 2) & F.col("season_moves"),
        "nonstandard_noise": usual & F.col("noise").isin("student_t", "heteroscedastic", "level_dependent", "mixture"),
    }
    reasons = F.filter(F.array(*[F.when(c, F.lit(k)) for k, c in when.items()]), lambda k: k.isNotNull())
    conflicts = F.array(*map(F.lit, ["confounded_components", "cross_series_heterogeneity", "ambiguous_missing_mechanism", "diagnostic_conflict"]))
    marked = facts.withColumn("reasons", reasons)
    return marked.withColumn("difficulty", F.when(F.arrays_overlap("reasons", conflicts) & (F.size("reasons") >= 2), "hard").otherwise("medium"))
