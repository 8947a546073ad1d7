"""Queries over recorded questions, with the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import curation as cu
from tidemark.operators import questions as qs
from tidemark.plans.panel_queries import _t

# Questions and what was recorded with them; a row takes one of each by its number.
_TEXTS = [
    "我们要在控制缺货风险和压低库存成本之间取舍，请先判断历史记录是否存在缺失，再评估哪些门店需要补充证据，并说明在什么条件下应当停止分析、转交人工复核，以及复核之后由谁来承担后续的补货决定。",
    "数据存在明显缺失，请处理。",
    "业务上希望在算力有限的前提下安排下一步工作，材料一共有三条时间序列，图中显示波动很大，请逐步写明工具调用顺序，并给出 Top-3 的结论，同时保证解释能够被门店经理理解和执行，不要遗漏风险说明。",
    "团队需要为每周数据安排人工复核，请确认是否有多个序列受到影响，并比较模型A与模型B的已有结果，说明哪一份更适合继续观察，再决定补充证据的先后顺序，同时兼顾时延要求与解释要求这两个方面的约束。",
    "我们打算替换现有预测模型，请用 adf_test 说明理由，推荐哪种算法更合适，并在30天内给出上线安排，同时考虑成本和时延的约束，以及在证据不足时如何回退到原来的方案并通知相关的业务负责人。",
]
_COSTS = ["under_forecast_higher", "false_alarm_higher", "symmetric", ""]
_GOALS = ["forecast", "point_anomaly_detection", "monitoring"]
_COLUMNS = [["time", "series_id", "value"], ["step", "actual", "model_b_prediction", "prediction_lower", "prediction_upper"], ["train_loss", "val_loss", "Residual"], []]
_FORBIDDEN = {"truth", "answer", "observed_values"}


def _pick(values: list, k: str, d: int = 1):
    lit = lambda v: F.array(*map(F.lit, v)).cast("array<string>") if isinstance(v, list) else F.lit(v)
    return F.element_at(F.array(*map(lit, values)), (F.pmod(F.floor(F.col(k) / d), F.lit(len(values))) + 1).cast("int"))


def _recorded(spark: SparkSession, sf: str) -> DataFrame:
    days = F.array(F.when(F.col("c_custkey") % 2 == 0, "30").otherwise("7"))
    return _t(spark, sf, "customer").select(
        "c_custkey", F.concat(_pick(_TEXTS, "c_custkey"), F.when(F.col("c_custkey") % 11 == 0, F.col("c_name")).otherwise("")).alias("text"),
        _pick([["a", "b"], ["a", " "], ["a", "b", "c"]], "c_custkey").alias("decision_points"), F.lit(2).alias("min_decisions"),
        _pick(["latency", "cost", "unknown"], "c_custkey", 2).alias("constraint_key"), F.array(F.lit("latency"), F.lit("cost")).alias("constraints"),
        _pick([["goal"], ["external_context.days"], ["other"], []], "c_custkey", 3).alias("facts_used"),
        F.create_map(F.lit("goal"), F.array().cast("array<string>"), F.lit("days"), days).alias("context"),
        F.array(F.lit("adf_test"), F.lit("compute_acf")).alias("tools"), _pick([[], ["adf_test"]], "c_custkey", 5).alias("allowed_tools"),
        F.array(F.lit("packages"), F.lit("ARIMA")).alias("models"), _pick(["none", "forecast"], "c_custkey", 7).alias("scope"),
    )


def _validation(spark: SparkSession, sf: str) -> DataFrame:
    judged = qs.question_checks(_recorded(spark, sf))
    told = qs.feedback(judged, spark.createDataFrame([(k, n, f"mend {n}") for k, n in enumerate(_CHECKS)], "ord int, check string, message string"))
    failed = F.map_keys(F.map_filter("checks", lambda _, held: ~held))
    return told.select("c_custkey", F.array_join(F.array_sort(failed), ",").alias("failed"), "passed", "complexity_score", "n_chars", F.size("feedback").alias("n_messages"))


def _diversity(spark: SparkSession, sf: str) -> DataFrame:
    turns = _t(spark, sf, "conversations").where("role = 'user'").groupBy("conv_id").agg(F.min_by("text", "turn").alias("text"))
    judged = qs.diversity_checks(turns.withColumn("checks", F.create_map(F.lit("not_empty"), F.coalesce(F.trim("text") != "", F.lit(False)))), "conv_id", "text")
    return judged.select("conv_id", *[F.element_at("checks", F.lit(n)).alias(n) for n in ("not_empty", "cross_group_unique", "opening_prefix_not_overused")], "passed", "complexity_score")


def _context(spark: SparkSession, sf: str) -> DataFrame:
    facts = _t(spark, sf, "customer").select("c_custkey", _pick(_GOALS, "c_custkey").alias("goal"), F.create_map(F.lit("latency"), F.lit("low"), F.lit("error_cost"), _pick(_COSTS, "c_custkey", 3)).alias("constraints"), _pick(_COLUMNS, "c_custkey", 2).alias("columns"))
    kept = qs.fitting_constraints(F.col("goal"), F.col("constraints"))
    shown = facts.select("c_custkey", "goal", F.array_join(F.array_sort(F.map_keys(kept)), ",").alias("constraint_keys"), F.element_at(kept, F.lit("error_cost")).alias("error_cost"), F.array_join(qs.resource_roles(F.col("columns")), ",").alias("roles"))
    return qs.writer_payload(shown, _FORBIDDEN)


QUERIES = {"question_validation": _validation, "question_diversity": _diversity, "writer_context": _context}


def _sql(values: list, d: int = 1) -> str:
    return f"({values!r})[CAST(c_custkey // {d} AS BIGINT) % {len(values)} + 1]"


_OR = lambda patterns: "|".join(f"(?:{p})" for p in patterns)
_NUMBERS = r"(?:^|[^A-Za-z_0-9.])(\d+(?:\.\d+)?%?)"
_CLAIMS = lambda p: f"len(list_filter(clauses, lambda x: regexp_matches(x, '{p}') AND NOT regexp_matches(regexp_extract(x, '^(.*?)(?:{p})', 1), '{cu.DOUBT}'))) = 0"
_NAMED = "regexp_matches(lower(text), '(^|[^a-z0-9_])' || lower(x) || '($|[^a-z0-9_])')"
_CHECKS = {
    "minimum_length": "length(trim(text)) >= 60",
    "maximum_length": "length(trim(text)) <= 360",
    "multiple_decisions": "len(list_filter(decisions, lambda x: trim(x) <> '')) >= 2",
    "business_constraint": "constraint_key IN ('latency', 'cost')",
    "no_answer_blueprint": f"NOT regexp_matches(text, '(?is){_OR(qs.BLUEPRINTS)}')",
    "grounded_numbers": f"len(list_filter(regexp_extract_all(text, '{_NUMBERS}', 1), lambda x: x <> days)) = 0",
    "grounded_business_facts": "len(facts) > 0 AND list_has_all(['goal', 'days', 'days.' || days, 'external_context.goal', 'external_context.days', 'external_context.days.' || days], facts)",
    "no_derived_findings": f"len(list_filter(clauses, lambda x: regexp_matches(x, '{cu.ENTITY}') AND regexp_matches(x, '{cu.FINDING}') AND regexp_matches(x, '{cu.ASSERTION}') AND NOT regexp_matches(x, '{cu.DOUBT}'))) = 0",
    "no_ungrounded_data_counts": _CLAIMS(qs.COUNTS),
    "no_ungrounded_frequency": _CLAIMS(qs.FREQUENCIES),
    "modality_neutral": f"NOT regexp_matches(text, '{qs.IMAGE_CLAIMS}')",
    "allowed_tool_mentions": f"len(list_filter(['adf_test', 'compute_acf'], lambda x: NOT list_contains(allowed, x) AND {_NAMED})) = 0",
    "no_model_name_leak": f"len(list_filter(['packages', 'ARIMA'], lambda x: {_NAMED})) = 0",
    "model_scope": f"NOT (scope = 'none' AND regexp_matches(regexp_replace(regexp_replace(text, '{qs.ANONYMOUS}', '已有方案', 'g'), '\\s+', '', 'g'), '(?i){_OR(qs.DECISIONS)}'))",
    "not_single_fact": f"NOT regexp_matches(trim(text), '{qs.SINGLE_FACT}')",
}
_ROLES = {
    "actual_values": "x = 'actual' OR ends_with(x, '__actual')", "forecast_horizon": "contains(x, 'horizon')", "model_a_predictions": "contains(x, 'prediction') AND NOT contains(x, 'model_b')",
    "model_b_predictions": "contains(x, 'model_b_prediction')", "residuals": "contains(x, 'residual')", "series_identifier": "contains(x, 'series_id')", "time_index": "x IN ('time', 'step', 'timestamp', 'date')",
    "time_series_values": "", "training_metrics": "starts_with(x, 'train_') OR contains(x, 'train_loss')", "validation_metrics": "starts_with(x, 'val_') OR contains(x, 'validation')",
}
_SOME = lambda rule: f"len(list_filter(names, lambda x: {rule})) > 0" if rule else "true"
_ROLE_TESTS = sorted([(n, _SOME(r)) for n, r in _ROLES.items()] + [("prediction_intervals", f"{_SOME("contains(x, 'lower')")} AND {_SOME("contains(x, 'upper')")}")])

ORACLE_SQL = {
    "question_validation": f"""WITH q AS (SELECT c_custkey, {_sql(_TEXTS)} || CASE WHEN c_custkey % 11 = 0 THEN c_name ELSE '' END AS text, {_sql([['a', 'b'], ['a', ' '], ['a', 'b', 'c']])} AS decisions,
        {_sql(['latency', 'cost', 'unknown'], 2)} AS constraint_key, {_sql([['goal'], ['external_context.days'], ['other'], []], 3)} AS facts, CASE WHEN c_custkey % 2 = 0 THEN '30' ELSE '7' END AS days,
        {_sql([[], ['adf_test']], 5)} AS allowed, {_sql(['none', 'forecast'], 7)} AS scope FROM customer),
        c AS (SELECT *, list_transform(regexp_split_to_array(text, '{cu.CLAUSE_ENDS}'), lambda x: trim(x)) AS clauses FROM q),
        f AS (SELECT c_custkey, length(trim(text)) AS n_chars, list_filter([{', '.join(f"CASE WHEN NOT coalesce({_CHECKS[n]}, false) THEN '{n}' END" for n in sorted(_CHECKS))}], lambda x: x IS NOT NULL) AS failed FROM c)
        SELECT c_custkey, array_to_string(failed, ',') AS failed, len(failed) = 0 AS passed, round((15 - len(failed)) / 15, 4) AS complexity_score, CAST(n_chars AS INTEGER) AS n_chars, CAST(len(failed) AS INTEGER) AS n_messages FROM f""",
    "question_diversity": """WITH u AS (SELECT conv_id, arg_min(text, turn) AS text FROM conversations WHERE role = 'user' GROUP BY conv_id),
        p AS (SELECT conv_id, text, lower(regexp_replace(coalesce(text, ''), '[^0-9A-Za-z一-鿿]', '', 'g')) AS plain FROM u),
        k AS (SELECT conv_id, coalesce(trim(text) <> '', false) AS not_empty, row_number() OVER (PARTITION BY plain ORDER BY conv_id) = 1 AS cross_group_unique,
        plain = '' OR row_number() OVER (PARTITION BY plain[1:12] ORDER BY conv_id) <= 2 AS opening_prefix_not_overused FROM p)
        SELECT *, not_empty AND cross_group_unique AND opening_prefix_not_overused AS passed,
        round((not_empty::INT + cross_group_unique::INT + opening_prefix_not_overused::INT + 1) / 4, 4) AS complexity_score FROM k""",
    "writer_context": f"""WITH f AS (SELECT c_custkey, {_sql(_GOALS)} AS goal, {_sql(_COSTS, 3)} AS cost, list_transform({_sql(_COLUMNS, 2)}, lambda x: lower(x)) AS names FROM customer),
        k AS (SELECT *, cost = '' OR goal = 'monitoring' OR (goal = 'forecast' AND cost IN {tuple(qs.ERROR_COSTS['forecast'])}) OR (goal = 'point_anomaly_detection' AND cost IN {tuple(qs.ERROR_COSTS['point_anomaly_detection'])}) AS fits FROM f)
        SELECT c_custkey, goal, CASE WHEN fits THEN 'error_cost,latency' ELSE 'latency' END AS constraint_keys, CASE WHEN fits THEN cost END AS error_cost,
        array_to_string(list_filter([{', '.join(f"CASE WHEN {t} THEN '{n}' END" for n, t in _ROLE_TESTS)}], lambda x: x IS NOT NULL), ',') AS roles FROM k""",
}
