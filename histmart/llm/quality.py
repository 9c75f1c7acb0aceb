"""Quality rules with adaptive thresholds from mergeable quantile sketches.

Per text, integer measures are taken with built-in functions only. Three of
them (symbols per word, mean word length, share of repeated lines, each in
thousandths) are sketched per (lang, source): a value falls into the bucket
made of its leading ``SKETCH_BITS`` bits, and a sketch is the count of each
bucket. Counts add up, so sketches merge exactly in any order: map-side
partial sums make a hot source cheap, and sources sum into their language and
languages into the corpus. The relative error is below 2^-(SKETCH_BITS-1).

A group's fences are q25 - max(reach * (q75 - q25), slack) and
q75 + max(reach * (q75 - q25), slack). A group of fewer than ``min_rows``
texts uses its language's fences, a language of fewer the corpus's. A text is
kept when the base rule passes and each measure lies within its fences.

Defined cases: a NULL or wordless text has zero words and fails the base rule;
wordless texts are not sketched. NULL lang or source is a group of its own.
Repeated rows count as often as they stand. An empty table gives an empty
result. An input column named ``quality`` is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from histmart.llm.common import WORD_SPACE, bind, prepare, stage, text_or_empty, word_array

SKETCH_BITS = 6
MIN_ROWS = 200
REACH = 3
# Least distance of a fence from its quartile, in thousandths, per measure.
SLACK = {"symbol_rate": 100, "word_length": 2000, "dup_line_rate": 500}
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words")
MAX_BROADCAST_GROUPS = 100_000
SYMBOLS = "#*$%&|<>"  # Fixed value of the base rule.


def _repeat_words(hashes: Column) -> Column:
    """Words inside a 3-word window whose hash occurs twice: sort (hash, position), mark equal neighbours.

    Windows are compared by their 64-bit hash; a text of 20,000 words has a
    false match with probability 1e-11.
    """
    ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    marked = bind(ordered, lambda s: F.transform(s, lambda x, j: F.when(
        ((j > 0) & (F.get(s, j - 1)["h"] == x["h"])) | (F.get(s, j + 1)["h"] == x["h"]), x["i"])))
    inside = F.flatten(F.transform(F.filter(marked, lambda i: i.isNotNull()), lambda i: F.array(i, i + 1, i + 2)))
    return F.size(F.array_distinct(inside))


def _grams(words: Column) -> Column:
    """Hash of each 3-word window, by the position of its first word."""
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return bind(hashes, lambda h: F.slice(F.transform(
        h, lambda x, i: F.xxhash64(F.get(h, i - 2), F.get(h, i - 1), x)), F.lit(3), F.greatest(F.size(h), F.lit(1))))


def _without(text: Column, characters: str) -> Column:
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def with_measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add plain columns _llm_<measure> (long): n_words, word_chars, n_symbols, n_dup_lines, n_lines, n_repeat_words."""
    t = text_or_empty(text)
    lines = F.filter(F.split(t, "\n", -1), lambda x: F.btrim(x, F.lit(WORD_SPACE)) != "")
    words = F.col("_llm_words")
    repeat = bind(_grams(words), lambda g: F.when(
        F.size(F.array_distinct(g)) < F.size(g), _repeat_words(g)).otherwise(0))
    out = docs.withColumn("_llm_words", word_array(t)).withColumn("_llm_lines", lines)
    return out.withColumns({
        "_llm_n_words": F.size(words).cast("long"),
        "_llm_word_chars": F.length(F.array_join(words, "")).cast("long"),
        "_llm_n_symbols": (F.length(t) - F.length(_without(t, SYMBOLS))).cast("long"),
        "_llm_n_dup_lines": (F.size("_llm_lines") - F.size(F.array_distinct("_llm_lines"))).cast("long"),
        "_llm_n_lines": F.size("_llm_lines").cast("long"),
        "_llm_n_repeat_words": repeat.cast("long"),
    }).drop("_llm_words", "_llm_lines")


def rates() -> dict[str, Column]:
    """The adaptive measures in thousandths (long), from the columns of with_measures."""
    per = lambda a, b: F.expr(f"_llm_{a} * 1000L div greatest(_llm_{b}, 1L)")
    return {"symbol_rate": per("n_symbols", "n_words"), "word_length": per("word_chars", "n_words"),
            "dup_line_rate": per("n_dup_lines", "n_lines")}


def bucket(v: Column) -> Column:
    """Lower end of a value's sketch bucket: its leading SKETCH_BITS bits."""
    shift = F.greatest(F.length(F.bin(v)) - SKETCH_BITS, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", v, shift), shift)


def sketches(measured: DataFrame) -> DataFrame:
    """Rows (lang, source, measure, bucket, n): one mergeable sketch per group and measure."""
    r = rates()
    return (measured.filter(F.col("_llm_n_words") > 0)
            .select("lang", "source", F.inline(F.array(*[
                F.struct(F.lit(k).alias("measure"), bucket(v).alias("bucket")) for k, v in r.items()])))
            .groupBy("lang", "source", "measure", "bucket").agg(F.count(F.lit(1)).alias("n")))


def _fences(sketch: DataFrame, keys: list[str], reach: int) -> DataFrame:
    """Quartiles by cumulative count, then one row per group with a map measure -> (low, high)."""
    merged = sketch.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys, "measure")
    upto = group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    c = merged.withColumn("upto", F.sum("n").over(upto)).withColumn("rows", F.sum("n").over(group))
    q = c.groupBy(*keys, "measure").agg(
        F.max("rows").alias("rows"),
        F.min(F.when(F.col("upto") * 4 >= F.col("rows"), F.col("bucket"))).alias("q1"),
        F.min(F.when(F.col("upto") * 4 >= F.col("rows") * 3, F.col("bucket"))).alias("q3"))
    slack = F.coalesce(*[F.when(F.col("measure") == k, F.lit(v)) for k, v in SLACK.items()])
    room = F.greatest((F.col("q3") - F.col("q1")) * reach, slack)
    pick = lambda k, c: F.max(F.when(F.col("measure") == k, c))
    return q.groupBy(*keys).agg(F.max("rows").alias("rows"), *[
        F.struct(pick(k, F.col("q1") - room).alias("low"), pick(k, F.col("q3") + room).alias("high")).alias(k)
        for k in SLACK])


def thresholds(measured: DataFrame, min_rows: int = MIN_ROWS, reach: int = REACH) -> DataFrame:
    """One row per (lang, source) with its fences, taken from the smallest group that is large enough."""
    s = stage(sketches(measured), "quality-sketches")  # read by three levels; groups x buckets rows
    own = _fences(s, ["lang", "source"], reach)
    lang = _fences(s, ["lang"], reach).select(
        F.col("lang").alias("_llm_l_lang"), F.struct("rows", *SLACK).alias("by_lang"))
    corpus = _fences(s.withColumn("corpus", F.lit(1)), ["corpus"], reach).select(F.struct("rows", *SLACK).alias("all"))
    j = (own.join(lang, F.col("lang").eqNullSafe(F.col("_llm_l_lang")))
         .join(F.broadcast(corpus)))  # one row
    level = lambda k: (F.when(F.col("rows") >= min_rows, F.col(k))
                       .when(F.col("by_lang.rows") >= min_rows, F.col("by_lang")[k]).otherwise(F.col("all")[k]))
    return j.select(F.col("lang").alias("_llm_f_lang"), F.col("source").alias("_llm_f_source"),
                    F.struct(*[level(k).alias(k) for k in SLACK]).alias("_llm_fences"))


def judge(docs: DataFrame, text: str = "text", min_rows: int = MIN_ROWS, reach: int = REACH) -> DataFrame:
    """Input columns plus ``quality``: the measures, base_failed, kept and the fences applied.

    The sketch pass reads and computes only the three adaptive measures; the
    second pass computes all and joins the fences. The fence table is broadcast
    only when counted to at most MAX_BROADCAST_GROUPS groups; beyond that the
    join shuffles and adaptive execution splits hot groups.
    """
    prepare(docs.sparkSession)
    measured = with_measures(docs, text)
    names = set(docs.columns)
    for key in ("lang", "source"):
        if key not in names:
            measured = measured.withColumn(key, F.lit(None).cast("string"))
    fences = stage(thresholds(measured, min_rows, reach), "quality-fences")
    if fences.count() <= MAX_BROADCAST_GROUPS:
        fences = F.broadcast(fences)
    j = measured.join(fences, F.col("lang").eqNullSafe(F.col("_llm_f_lang"))
                      & F.col("source").eqNullSafe(F.col("_llm_f_source")), "left")
    r = rates()
    base_failed = F.expr("_llm_n_words < 50 or _llm_n_repeat_words * 100 > _llm_n_words * 50")
    within = F.lit(True)
    for k, v in r.items():
        within = within & F.coalesce(v.between(F.col("_llm_fences")[k]["low"], F.col("_llm_fences")[k]["high"]), F.lit(True))
    return j.withColumn("quality", F.struct(
        *[F.col(f"_llm_{k}").alias(k) for k in MEASURES],
        *[v.alias(k) for k, v in r.items()], F.col("_llm_fences").alias("fences"),
        # one CASE over both sides: as a conjunction, a filter on it would be split and the measures computed twice
        base_failed.alias("base_failed"), F.when(base_failed, False).otherwise(within).alias("kept"))
    ).select(*[c for c in docs.columns if c != "quality"], "quality")


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows that pass, with the input columns."""
    cols = [c for c in docs.columns if c != "quality"]
    return judge(docs, text).filter(F.col("quality.kept")).select(*cols)


def op1_query(docs: DataFrame) -> DataFrame:
    q = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judge(docs).select("doc_id", *[F.col("quality")[c].alias(c) for c in q])


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
g AS (SELECT rid, unnest(range(1, len(w) - 1)) AS i, w FROM d WHERE len(w) >= 3),
h AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, w[i], w[i + 1], w[i + 2]) AS c FROM g),
p AS (SELECT DISTINCT rid, unnest([i, i + 1, i + 2]) AS pos FROM h WHERE c >= 2),
r AS (SELECT rid, count(*) AS n FROM p GROUP BY rid),
m AS (
  SELECT d.rid, doc_id, lang, source, len(w)::BIGINT AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, len(l) AS n_lines,
         coalesce(r.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN r ON d.rid = r.rid),
v AS (
  SELECT *, [n_symbols * 1000 // greatest(n_words, 1), word_chars * 1000 // greatest(n_words, 1),
             n_dup_lines * 1000 // greatest(n_lines, 1)] AS x FROM m),
u AS (SELECT lang, source, unnest([1, 2, 3]) AS k, unnest(x)::BIGINT AS y FROM v WHERE n_words > 0),
b AS (SELECT lang, source, k, (y >> s) << s AS b FROM
      (SELECT *, greatest(length(bin(y)) - 6, 0)::BIGINT AS s FROM u)),
a AS (
  SELECT 1 AS lv, lang, source, k, b, count(*) AS n FROM b GROUP BY ALL
  UNION ALL SELECT 2, lang, NULL, k, b, count(*) FROM b GROUP BY ALL
  UNION ALL SELECT 3, NULL, NULL, k, b, count(*) FROM b GROUP BY ALL),
c AS (
  SELECT *, sum(n) OVER (PARTITION BY lv, lang, source, k ORDER BY b) AS upto,
         sum(n) OVER (PARTITION BY lv, lang, source, k) AS total FROM a),
q AS (
  SELECT lv, lang, source, k, max(total) AS total, min(b) FILTER (upto * 4 >= total) AS q1,
         min(b) FILTER (upto * 4 >= total * 3) AS q3 FROM c GROUP BY ALL),
f AS (
  SELECT *, q1 - greatest((q3 - q1) * 3, [100, 2000, 500][k]) AS lo,
         q3 + greatest((q3 - q1) * 3, [100, 2000, 500][k]) AS hi FROM q),
e AS (
  SELECT o.lang, o.source, o.k,
         CASE WHEN o.total >= 200 THEN o.lo WHEN l.total >= 200 THEN l.lo ELSE z.lo END AS lo,
         CASE WHEN o.total >= 200 THEN o.hi WHEN l.total >= 200 THEN l.hi ELSE z.hi END AS hi
  FROM f o JOIN f l ON l.lv = 2 AND l.k = o.k AND l.lang IS NOT DISTINCT FROM o.lang
  JOIN f z ON z.lv = 3 AND z.k = o.k WHERE o.lv = 1),
t AS (SELECT lang, source, list(lo ORDER BY k) AS lo, list(hi ORDER BY k) AS hi FROM e GROUP BY ALL)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
       AND coalesce(x[1] BETWEEN t.lo[1] AND t.hi[1], true) AND coalesce(x[2] BETWEEN t.lo[2] AND t.hi[2], true)
       AND coalesce(x[3] BETWEEN t.lo[3] AND t.hi[3], true) AS kept
FROM v LEFT JOIN t ON v.lang IS NOT DISTINCT FROM t.lang AND v.source IS NOT DISTINCT FROM t.source
"""
