"""The registered queries of the training-data operators, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recolake.llm import language_id
from recolake.llm.common import WS, crc_of_id
from recolake.llm.exact_dedup import content_sort_dedup
from recolake.llm.filter_audit import filter_audit
from recolake.llm.line_dedup import line_dedup
from recolake.llm.mixing import schedule
from recolake.llm.packing import pack
from recolake.llm.periodic_runs import periodic_runs
from recolake.llm.quality_classifier import classify
from recolake.llm.quality_rules import score_quality
from recolake.llm.simhash import simhash_groups
from recolake.llm.substring_dedup import substring_dedup
from recolake.llm.token_table import read_tokens, with_ids_crc32, write_tokens
from recolake.llm.toxicity import score_toxicity
from recolake.plans.registry import Query
from recolake.session import scratch_path

QUERIES: dict[str, Query] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = Query(name, fn, sql)
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


OP5_SQL = r"""
WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS n,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
w AS (SELECT *, first_value(doc_id) OVER g AS keep_id, row_number() OVER g AS place,
             count(*) OVER (PARTITION BY norm) AS group_size
      FROM t WINDOW g AS (PARTITION BY norm ORDER BY n DESC, doc_id ASC NULLS LAST))
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(norm) AS text_sha256 FROM w
"""


@register("op5_exact_dedup", OP5_SQL)
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (content_sort_dedup(table(spark, sf_dir, "documents"))
            .select("doc_id", "keep_id", "group_size", "kept", "text_sha256"))


@register("op10_simhash")
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"))


@register("op7_quality_rules")
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), columns=["doc_id"])


@register("op3_token_table")
def op3_token_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token_table")
    write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), end_id=0,
                 cache=400_000)
    return with_ids_crc32(read_tokens(spark, path))


@register("op6_best_fit_packing")
def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), length=4096, end_id=1,
                cache=500_000)


@register("op1_quality_classifier")
def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"),
                    held_out=crc_of_id() % 3 == 1)


@register("op8_language_id")
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_of_id() % 4 == 2
    model = language_id.fit(docs, ~held_out)
    return (language_id.identify(docs.select("doc_id", "text"), model)
            .select("doc_id", held_out.alias("held_out"), "language.lang_pred", "language.score",
                    "language.rejected"))


# The exponent at which the rarest source is read MIX_PASSES times is solved in
# closed form here; the operator bisects it.
MIX_PASSES, MIX_BLOCK, MIX_SEED = 2.0, 1 << 18, 11
OP2_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS source,
                  len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS n_tokens FROM documents),
s AS (SELECT source, sum(n_tokens)::BIGINT AS tokens FROM d GROUP BY 1),
e AS (SELECT round(greatest(0, 1 - ln({MIX_PASSES}) / ln(max(tokens) / min(tokens))), 6) AS a, sum(tokens) AS total
      FROM s WHERE tokens > 0),
r AS (SELECT source, tokens, (tokens / total) ** a AS raw FROM s, e),
w AS (SELECT source, tokens, raw / (SELECT sum(raw) FROM r) AS weight FROM r),
m AS (SELECT source, tokens, weight, round((SELECT max(tokens / weight) FROM w) * weight / tokens, 9) AS passes FROM w),
p AS (SELECT d.*, tokens, passes, weight, unnest(range(0, ceil(passes)::INT)) AS pass FROM d JOIN m USING (source)),
k AS (SELECT *, ('0x' || substr(md5('{MIX_SEED}|' || pass || '|' || doc_id), 1, 15))::BIGINT AS key FROM p),
c AS (SELECT *, (pass * tokens + coalesce(sum(n_tokens) OVER (PARTITION BY source, pass ORDER BY key, doc_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS start FROM k)
SELECT doc_id, source, pass::INT AS pass, n_tokens, start, floor(start / (weight * {MIX_BLOCK}))::BIGINT AS block
FROM c WHERE pass + 1 <= passes OR start < passes * tokens
"""


@register("op2_mixing", OP2_SQL)
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schedule(table(spark, sf_dir, "documents"), block_tokens=MIX_BLOCK, seed=MIX_SEED, max_passes=MIX_PASSES)


OP9_SQL = r"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                  unnest(range(0, len(string_split(coalesce(text, ''), chr(10))))) AS no FROM documents),
f AS (SELECT *, regexp_matches(line, '[^\x20\x09-\x0D]') AS full_line FROM l),
v AS (SELECT doc_id, no, line, row_number() OVER (PARTITION BY doc_id ORDER BY no) - 1 AS ln FROM f WHERE full_line),
w AS (SELECT doc_id, no, ln, line, lead(line) OVER (PARTITION BY doc_id ORDER BY ln) AS next FROM v),
x AS (SELECT *, row_number() OVER (PARTITION BY line, next ORDER BY doc_id, ln) > 1 AS later FROM w
      WHERE next IS NOT NULL),
s AS (SELECT doc_id, ln, row_number() OVER (PARTITION BY line ORDER BY doc_id, ln) > 1 AS later,
             len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) >= 8 AS long FROM v),
g AS (SELECT v.doc_id, v.no FROM v SEMI JOIN
        (SELECT doc_id, ln FROM x WHERE later UNION SELECT doc_id, ln + 1 FROM x WHERE later
         UNION SELECT doc_id, ln FROM s WHERE later AND long) y
        ON v.doc_id = y.doc_id AND v.ln = y.ln),
k AS (SELECT f.doc_id, f.no, f.line, f.full_line, g.no IS NOT NULL AS gone
      FROM f LEFT JOIN g ON f.doc_id = g.doc_id AND f.no = g.no)
SELECT doc_id, count(*) FILTER (full_line) AS n_lines, count(*) FILTER (gone) AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY no) FILTER (NOT gone), '')) AS kept_sha256
FROM k GROUP BY doc_id
"""


@register("op9_line_dedup", OP9_SQL)
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of two lines, and single lines of eight words: short lines that
    stand alone, such as a closing formula, stay."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup(docs, run=2, min_words=8).drop("text", "kept_text")


OP9_LINES_SQL = r"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                  unnest(range(0, len(string_split(coalesce(text, ''), chr(10))))) AS no FROM documents),
f AS (SELECT *, regexp_matches(line, '[^\x20\x09-\x0D]') AS full_line FROM l),
k AS (SELECT *, full_line AND row_number() OVER (PARTITION BY line ORDER BY doc_id, no) > 1 AS gone FROM f)
SELECT doc_id, count(*) FILTER (full_line) AS n_lines, count(*) FILTER (gone) AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY no) FILTER (NOT gone), '')) AS kept_sha256
FROM k GROUP BY doc_id
"""


@register("op9_line_dedup_lines", OP9_LINES_SQL)
def op9_line_dedup_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of one line count too: no line stays that stood earlier."""
    return line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), run=1).drop("text", "kept_text")


OP4_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d),
x AS (SELECT doc_id, i, sha256(array_to_string(w[i:i + 49], ' ')) AS h FROM s),
f AS (SELECT h, min(doc_id) AS m FROM x GROUP BY h),
r AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM x JOIN f USING (h) WHERE m < doc_id),
v AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
k AS (SELECT v.doc_id, v.p, v.word, r.p IS NOT NULL AS gone FROM v LEFT JOIN r ON v.doc_id = r.doc_id AND v.p = r.p),
g AS (SELECT doc_id, count(*) AS n, count(*) FILTER (gone) AS c,
             string_agg(word, ' ' ORDER BY p) FILTER (NOT gone) AS kept FROM k GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_words, coalesce(c, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN g USING (doc_id)
"""


@register("op4_substring_dedup", OP4_SQL)
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"), window=50)


@register("op11_toxicity")
def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"),
                          held_out=crc_of_id() % 4 == 2)


OP12_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, min(doc_id) OVER (PARTITION BY t) AS least FROM d),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
             (len(ws) < 100)::INT + 2 * (100 * len(list_distinct(ws)) < 80 * len(ws))::INT
             + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t))::INT
             + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * (least < w.doc_id)::INT AS mask
      FROM w LEFT JOIN l ON w.doc_id = l.doc_id),
m AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, mask),
c AS (SELECT unnest(range(1, 6)) AS i, substr('ABCDE', i, 1) AS name, 1 << (i - 1) AS bit),
o AS (SELECT a.name || b.name || c.name || d.name || e.name AS filter_order, [a.i, b.i, c.i, d.i, e.i] AS filters,
             [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
      FROM c a JOIN c b ON b.i <> a.i JOIN c ON c.i NOT IN (a.i, b.i)
      JOIN c d ON d.i NOT IN (a.i, b.i, c.i) JOIN c e ON e.i NOT IN (a.i, b.i, c.i, d.i)),
s AS (SELECT *, unnest(range(1, 6)) AS step FROM o),
b AS (SELECT filter_order, step, filters[step] AS filter, bits[step] AS bit,
             coalesce(list_sum(bits[:step - 1]), 0)::INT AS earlier FROM s),
r AS (SELECT part, filter_order, step::INT AS step, filter,
             coalesce(sum(n) FILTER (mask & (bit | earlier) = 0), 0)::BIGINT AS kept,
             coalesce(sum(n) FILTER (mask & bit > 0 AND mask & earlier = 0), 0)::BIGINT AS removed,
             coalesce(sum(n) FILTER (mask & bit > 0 AND mask & earlier > 0), 0)::BIGINT AS redundant,
             coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
             coalesce(sum(good) FILTER (mask & bit > 0 AND mask & earlier = 0), 0)::BIGINT AS good_lost,
             coalesce(sum(toxic) FILTER (mask & bit > 0 AND mask & earlier = 0), 0)::BIGINT AS toxic_lost
      FROM m CROSS JOIN b GROUP BY part, filter_order, step, filter)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, filter))::BIGINT AS shapley FROM r
"""


@register("op12_filter_audit", OP12_SQL)
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """In a tenth of the documents (by h = crc32 of the id) word i >= a becomes
    word a + (i - a) % p, with g = h div 10, a = g % n and
    p = 1 + (n - a) div (3 + g % 8)."""
    h = crc_of_id()
    words = F.array_remove(F.split("text", WS + "+"), "")
    n, g = F.size(words), F.floor(h / 10)
    a = (g % n).cast("int")
    rest = n - a
    p = (F.lit(1) + F.floor(rest / (F.lit(3) + g % 8))).cast("int")
    cycle = F.slice(words, a + 1, p)
    repeated = F.slice(F.flatten(F.array_repeat(cycle, F.ceil(rest / p).cast("int"))), F.lit(1), rest)
    planted = F.array_join(F.concat(F.slice(words, F.lit(1), a), repeated), " ")
    return docs.withColumn("text", F.when((h % 10 == 0) & (n > 0), planted).otherwise(F.col("text")))


@register("op13_periodic_runs")
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_planted_runs(table(spark, sf_dir, "documents").select("doc_id", "text"))
    best = F.col("strongest")
    lines = F.transform("runs", lambda r: F.concat(r.start, F.lit(","), r.length, F.lit(","), r.period, F.lit("\n")))
    return periodic_runs(docs, min_length=6, min_exponent=4).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best.start.alias("start"), best.length.alias("length"),
        best.period.alias("period"), F.expr("strongest.length * 1000 div strongest.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("kept_text").cast("binary"), 256).alias("collapsed_sha256"))
