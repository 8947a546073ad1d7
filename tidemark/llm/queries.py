"""The queries opN_<name>: each operator over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    ball_trees,
    decontamination,
    hard_negatives,
    html_extraction,
    language_id,
    line_dedup,
    mixing,
    near_duplicates,
    packing,
    preference,
    quality_classifier,
    quality_rules,
    toxicity,
)
from tidemark.llm.common import held_out


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return decontamination.decontaminate(docs, items, keep=["doc_id"]).drop("hit_spans", "cut_spans")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract(_table(spark, sf_dir, "pages"), keep=["page_id", "url"])


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = language_id.identify(docs, language_id.fit(docs), keep=["doc_id"])
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(_table(spark, sf_dir, "documents")).drop("k1", "k2")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.apply_rules(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    net = quality_classifier.fit(docs, _table(spark, sf_dir, "labels"))
    return quality_classifier.score(docs, net, keep=["doc_id"]).select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op8_preference_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations")
    pairs = preference.preference_pairs(turns, preference.echoed(turns), pair="conv_id")
    shown = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws("-", s["start"], s["end"])), ",")
    return pairs.withColumns({c: shown(c) for c in ("chosen_spans", "rejected_spans")})


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(_table(spark, sf_dir, "documents"))


def op9_line_dedup_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(_table(spark, sf_dir, "documents"), percent=line_dedup.PERCENT)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, keep=["doc_id"])


def op11_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixing.by_position(mixed, "doc_id", "size", "source_size", "target", "taken")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(rows.select("vec_id", "embedding", label.alias("label")))


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_trees.cluster(_table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_html_extraction": op3_html_extraction,
    "op4_language_id": op4_language_id,
    "op5_minhash_near_dedup": op5_minhash_near_dedup,
    "op6_quality_rules": op6_quality_rules,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_preference_formatting": op8_preference_formatting,
    "op9_line_dedup": op9_line_dedup,
    "op9_line_dedup_whole": op9_line_dedup_whole,
    "op10_toxicity": op10_toxicity,
    "op11_source_mixing": op11_source_mixing,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_centroid_clustering": op13_centroid_clustering,
}

_OP1 = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), item_words AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), starts AS (
  SELECT item_id, w, least(len(w), 13) AS n, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS s FROM item_words WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[s:s + n - 1], ' ') AS k FROM starts
), doc_starts AS (
  SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM words, (SELECT DISTINCT n FROM windows) AS sizes WHERE len(w) >= n
), hits AS (
  SELECT d.doc_id, d.s, d.n, x.item_id
  FROM (SELECT doc_id, s, n, array_to_string(w[s:s + n - 1], ' ') AS k FROM doc_starts) AS d JOIN windows AS x ON x.n = d.n AND x.k = d.k
), marks AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + n)) AS p FROM hits
), runs AS (
  SELECT doc_id, g, count(*) AS n FROM (SELECT doc_id, p - row_number() OVER (PARTITION BY doc_id ORDER BY p) AS g FROM marks) AS t GROUP BY doc_id, g
), places AS (
  SELECT doc_id, sum(n) AS n_hit, sum(n) FILTER (n >= 13) AS n_cut FROM runs GROUP BY doc_id
), owners AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(id, ',' ORDER BY id)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) AS t GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated,
       CAST(coalesce(n_cut, 0) AS BIGINT) AS n_cut
FROM words LEFT JOIN places USING (doc_id) LEFT JOIN owners USING (doc_id)
"""

_GRID = ", ".join(f"('{r}', {k}, CAST({c} AS DOUBLE))" for r, cs in quality_rules.RULES.items() for k, c in enumerate(cs, 1))
_ALPHA = quality_rules.ALPHA / len(quality_rules.RULES)
_DELTA = quality_rules.DELTA / len(quality_rules.RULES) / len(quality_rules.STRATA)
_STRATUM = " + ".join(f"CAST(n_words >= {n} AS INTEGER)" for n in quality_rules.STRATA[1:])

_OP6 = rf"""
WITH split AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM split) AS x WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id
), windows AS (
  SELECT doc_id, s, array_to_string(w[s:s + 7], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS s FROM split) AS x
), twice AS (
  SELECT doc_id, s FROM (SELECT doc_id, s, count(*) OVER (PARTITION BY doc_id, k) AS c FROM windows) AS x WHERE c > 1
), repeats AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, unnest(range(s, s + 8)) AS p FROM twice) AS x GROUP BY doc_id
), base AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS BIGINT) AS n_capitals,
         CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM split LEFT JOIN lines USING (doc_id) LEFT JOIN repeats USING (doc_id)
), judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, {_STRATUM} AS stratum FROM base
), measures AS (
  SELECT doc_id, stratum, base_failed, unnest([
    {{'rule': 'symbols_per_word', 'm': coalesce(n_symbols / nullif(n_words, 0), 0)}}, {{'rule': 'capitals_share', 'm': coalesce(n_capitals / nullif(word_chars, 0), 0)}},
    {{'rule': 'dup_line_share', 'm': coalesce(n_dup_lines / nullif(n_lines, 0), 0)}}, {{'rule': 'repeat_word_share', 'm': coalesce(n_repeat_words / nullif(n_words, 0), 0)}},
    {{'rule': 'word_length', 'm': coalesce(word_chars / nullif(n_words, 0), 0)}}, {{'rule': 'word_shortness', 'm': -coalesce(word_chars / nullif(n_words, 0), 0)}}], recursive := true)
  FROM judged
), grid AS (
  SELECT * FROM (VALUES {_GRID}) AS g(rule, nth, cutoff)
), counted AS (
  SELECT stratum, g.rule, nth, cutoff, count(*) FILTER (quality > 0) AS n, count(*) FILTER (quality > 0 AND m > cutoff) AS x, count(*) FILTER (quality <= 0 AND m > cutoff) AS caught
  FROM measures JOIN (SELECT doc_id, min(quality) AS quality FROM labels WHERE quality IS NOT NULL GROUP BY doc_id) AS l USING (doc_id) JOIN grid AS g USING (rule)
  WHERE NOT base_failed GROUP BY ALL
), tested AS (
  SELECT *, x <= n * {_ALPHA} AND list_sum(list_transform(range(0, x + 1), lambda i: exp(lgamma(n + 1.0) - lgamma(i + 1.0) - lgamma(n - i + 1.0) + i * ln({_ALPHA}) + (n - i) * ln(1 - {_ALPHA})))) <= {_DELTA} AS fine FROM counted
), certified AS (
  SELECT *, bool_and(coalesce(fine, false)) OVER (PARTITION BY stratum, rule ORDER BY nth) AS so_far FROM tested
), chosen AS (
  SELECT stratum, rule, cutoff FROM certified WHERE so_far AND caught > x QUALIFY row_number() OVER (PARTITION BY stratum, rule ORDER BY x - caught, nth) = 1
), bad AS (
  SELECT DISTINCT doc_id FROM measures JOIN chosen USING (stratum, rule) WHERE m > cutoff
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM bad) AS kept FROM judged
"""

_OP8 = r"""
WITH turns AS (
  SELECT conv_id, row_number() OVER w AS n, role, text, lag(text, 1, '') OVER w AS before FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
), sides AS (
  SELECT conv_id, n, role, text AS c, CASE WHEN n = max(n) FILTER (role = 'assistant') OVER (PARTITION BY conv_id) THEN before ELSE text END AS r FROM turns
), marked AS (
  SELECT *, coalesce(min(n) FILTER (c <> r) OVER (PARTITION BY conv_id), 1000000000) AS differs FROM sides
), shown AS (
  SELECT conv_id, n, role, n < differs AS shared, '<|im_start|>' || role || chr(10) || c || '<|im_end|>' || chr(10) AS tc, '<|im_start|>' || role || chr(10) || r || '<|im_end|>' || chr(10) AS tr FROM marked
), placed AS (
  SELECT *, coalesce(sum(length(tc)) OVER w, 0) AS ac, coalesce(sum(length(tr)) OVER w, 0) AS ar FROM shown
  WINDOW w AS (PARTITION BY conv_id, shared ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
)
SELECT conv_id, count(*) FILTER (shared) AS n_prompt_turns,
       coalesce(string_agg(tc, '' ORDER BY n) FILTER (shared), '') AS prompt,
       coalesce(string_agg(tc, '' ORDER BY n) FILTER (NOT shared), '') AS chosen,
       coalesce(string_agg(tr, '' ORDER BY n) FILTER (NOT shared), '') AS rejected,
       coalesce(string_agg((ac + 13 + length(role)) || '-' || (ac + length(tc) - 1), ',' ORDER BY n) FILTER (NOT shared AND role = 'assistant'), '') AS chosen_spans,
       coalesce(string_agg((ar + 13 + length(role)) || '-' || (ar + length(tr) - 1), ',' ORDER BY n) FILTER (NOT shared AND role = 'assistant'), '') AS rejected_spans
FROM placed GROUP BY conv_id
"""

_OP5 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), classes AS (
  SELECT doc_id, w, CASE WHEN len(w) > 0 THEN min(doc_id) OVER (PARTITION BY w) ELSE doc_id END AS class_id FROM words
), starts AS (
  SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM classes WHERE doc_id = class_id AND len(w) > 0
), bags AS (
  SELECT doc_id, array_to_string(w[i:i + 4], ' ') AS s, count(*) AS c FROM starts GROUP BY ALL
), sizes AS (
  SELECT doc_id, sum(c) AS n FROM bags GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, sum(least(a.c, b.c)) AS m FROM bags AS a JOIN bags AS b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN sizes AS x ON x.doc_id = a JOIN sizes AS y ON y.doc_id = b WHERE 10 * m >= 8 * (x.n + y.n - m)
), sides AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach(doc, root) AS (
  SELECT DISTINCT a, a FROM sides UNION SELECT s.b, r.root FROM reach AS r JOIN sides AS s ON s.a = r.doc
), groups AS (
  SELECT doc AS class_id, min(root) AS g FROM reach GROUP BY doc
)
SELECT doc_id, class_id, coalesce(g, class_id) AS group_id, doc_id = coalesce(g, class_id) AS keep FROM classes LEFT JOIN groups USING (class_id)
"""

_OP9 = r"""
WITH lines AS (
  SELECT doc_id, pos - 1 AS pos, l[pos] AS line, len(l) AS n_lines FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents) AS d, LATERAL (SELECT unnest(range(1, len(l) + 1)) AS pos) AS p
), firsts AS (
  SELECT line, length(line) AS n, min({'d': doc_id, 'p': pos}) AS first FROM lines
  WHERE length(line) >= 32 OR regexp_matches(line, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]') GROUP BY line
), long AS (
  SELECT * FROM firsts WHERE n >= 32
), parts AS (
  SELECT line, n, first, k, substr(line, k * (n // 3) + 1, n // 3) AS part FROM long, range(0, 3) AS r(k)
), probes AS (
  SELECT line, n, first, k, n + d AS other, substr(line, k * ((n + d) // 3) + 1 + m, (n + d) // 3) AS part FROM long, range(0, 3) AS r(k), range(-2, 3) AS e(d), range(-2, 3) AS f(m) WHERE k * ((n + d) // 3) + m >= 0
), candidates AS (
  SELECT DISTINCT a.line AS line, b.line AS earlier FROM probes AS a JOIN parts AS b ON b.n = a.other AND b.k = a.k AND b.part = a.part AND b.line <> a.line AND b.first < a.first
), near AS (
  SELECT DISTINCT line FROM candidates WHERE levenshtein(line, earlier) <= 2
), kinds AS (
  SELECT l.doc_id, l.pos, CASE WHEN f.first <> {'d': l.doc_id, 'p': l.pos} THEN 'exact' WHEN n.line IS NOT NULL THEN 'near' END AS kind FROM lines AS l JOIN firsts AS f ON f.line = l.line LEFT JOIN near AS n ON n.line = l.line
), gone AS (
  SELECT doc_id, count(*) FILTER (kind = 'exact') AS n_exact, count(*) FILTER (kind = 'near') AS n_near, list(CAST(pos AS INTEGER) ORDER BY pos) AS removed FROM kinds WHERE kind IS NOT NULL GROUP BY doc_id
)
SELECT doc_id, CAST(coalesce(len(string_split(text, chr(10))), 0) AS BIGINT) AS n_lines, coalesce(n_exact, 0) AS n_exact, coalesce(n_near, 0) AS n_near, coalesce(removed, []::INTEGER[]) AS removed FROM documents LEFT JOIN gone USING (doc_id)
"""

_WEIGHTS = ", ".join(str(float(s.weight)) for s in mixing.SCHEDULES)
_STARTS = ", ".join(str(float(s.knots[0][1])) for s in mixing.SCHEDULES)
_ENDS = ", ".join(str(float(s.knots[-1][1])) for s in mixing.SCHEDULES)

_OP11 = rf"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size, md5(CAST(doc_id AS VARCHAR)) AS k FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.SCHEDULES)} AS INTEGER) + 1 AS turn FROM sized GROUP BY source
), capped AS (
  SELECT *, [{_WEIGHTS}][turn] AS w, CAST({mixing.MOST} * source_size AS DOUBLE) AS cap FROM sources
), levels AS (
  SELECT *, ({mixing.SHARE} * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(w) OVER (ORDER BY cap / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM capped
), targets AS (
  SELECT source, source_size, turn, w, least(cap, w * (SELECT level FROM levels WHERE cap > level * w ORDER BY cap / w, source LIMIT 1)) AS target FROM levels
), placed AS (
  SELECT doc_id, size, source_size, target, turn, w, CAST(floor(target + 0.5) AS BIGINT) AS goal,
         CAST(sum(size) OVER (PARTITION BY s.source ORDER BY k, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS BIGINT) AS c FROM sized AS s JOIN targets AS t ON s.source IS NOT DISTINCT FROM t.source
), due AS (
  SELECT *, (c / goal) * w AS q, [{_STARTS}][turn] AS a, [{_ENDS}][turn] AS b FROM placed
)
SELECT doc_id, size, source_size, target, CAST(greatest(0, least(size, goal - c)) + greatest(0, least(size, goal - source_size - c)) AS BIGINT) AS taken,
       CASE WHEN size > 0 AND c < goal THEN least(2 * q / (a + sqrt(a * a + q * (2 * (b - a)))), 1.0) END AS position
FROM due
"""

_OP12 = """
WITH usable AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(list_filter(embedding, lambda x: NOT coalesce(isfinite(x), false))) = 0
), scored AS (
  SELECT a.id AS a, b.id AS b, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS s FROM usable AS a JOIN usable AS b ON a.id % 100 = 0 AND a.id <> b.id
), positives AS (
  SELECT a, b, s FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY s DESC, b) <= 5
)
SELECT p.a AS anchor_id, p.b AS positive_id, CAST(row_number() OVER (PARTITION BY p.a, p.b ORDER BY n.s DESC, n.b) AS INTEGER) AS rank, n.b AS negative_id, p.s AS positive_score, n.s AS negative_score
FROM positives AS p JOIN scored AS n ON n.a = p.a AND NOT n.same AND 80 * p.s <= 100 * n.s AND 100 * n.s <= 100 * p.s
QUALIFY row_number() OVER (PARTITION BY p.a, p.b ORDER BY n.s DESC, n.b) <= 5
"""


def _rounds(rounds: int = ball_trees.ROUNDS) -> str:
    """SQL of the centroids c0, c1, ... and assignments a0, a1, ... of all rounds."""
    parts = []
    for i in range(rounds + 1):
        parts.append(
            f"""a{i} AS MATERIALIZED (
  SELECT row_id, arg_min(c, {{'d': d, 'c': c}}) AS c, min(d) AS d FROM (
    SELECT v.row_id, m.c, CAST(list_inner_product(v.v, v.v) - 2 * list_inner_product(v.v, m.v) + list_inner_product(m.v, m.v) AS BIGINT) AS d FROM vectors AS v, c{i} AS m
  ) AS t GROUP BY row_id
)"""
        )
        if i < rounds:
            parts.append(
                f"""c{i + 1} AS MATERIALIZED (
  SELECT m.c, coalesce(f.v, m.v) AS v FROM c{i} AS m LEFT JOIN (
    SELECT c, list(floor(s / n) ORDER BY p) AS v FROM (
      SELECT a.c, p, sum(v.v[p]) AS s, count(*) AS n FROM a{i} AS a JOIN vectors AS v USING (row_id), range(1, 65) AS r(p) GROUP BY a.c, p
    ) AS sums GROUP BY c
  ) AS f USING (c)
)"""
            )
    return ", ".join(parts)


_OP13 = f"""
WITH vectors AS MATERIALIZED (
  SELECT row_number() OVER () AS row_id, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: NOT coalesce(isfinite(x), false))) = 0
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS c, v FROM vectors WHERE vec_id IS NOT NULL ORDER BY c LIMIT 40
), {_rounds()}
SELECT vec_id, CAST(c AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(list_transform(m.v, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ',')) AS centroid_sha256
FROM a{ball_trees.ROUNDS} JOIN vectors USING (row_id) JOIN c{ball_trees.ROUNDS} AS m USING (c)
"""

ORACLE_SQL = {"op11_source_mixing": _OP11, "op12_hard_negatives": _OP12, "op13_centroid_clustering": _OP13, "op5_minhash_near_dedup": _OP5, "op9_line_dedup": _OP9, "op8_preference_formatting": _OP8, "op1_decontamination": _OP1, "op6_quality_rules": _OP6}
