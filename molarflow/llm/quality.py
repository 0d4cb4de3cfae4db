"""Quality rules with adaptive thresholds (DataFrame operations only).

Fixed rules (`base_failed`) judge each text alone. Beyond them, each metric is
compared with its own distribution in the document's (language, source) group:
a mergeable quantile sketch per group is built in one aggregation, thresholds
are read from it, and the documents are joined with them.

The sketch is a table of relative-error buckets: value v > 0 falls into bucket
ceil(ln v / ln GAMMA), zero into its own bucket; a row is (lang, source, metric,
bucket, n). Sketches merge by adding n, so daily sketches can be stored and
added, and a group with fewer than `min_rows` documents takes the merged sketch
of its language, or of everything. The table has at most a few hundred rows per
group, however many documents there are.

A value is an outlier above q50 + SPREAD * (q50 - q25) + slack, and, for the word
length, below q50 - SPREAD * (q75 - q50) - slack. The half of the distribution
away from the suspects gives the spread, so up to half of a group may be junk
without moving its own limit.

Edge cases: null text counts as empty (no words, fails the base rules); null lang
or source is a group of its own; very long texts are measured whole; repeated rows are judged alike, one result each;
an empty table gives an empty result; other columns pass through untouched.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from molarflow.llm.common import checkpointed, free_name, stored, whole_row

SPACE = r"[\x20\x09-\x0D]+"
NON_SPACE = r"[^\x20\x09-\x0D]"
SYMBOL = r"[#*$%&|<>]"
GAMMA = 1.02
SPREAD = 8.0
MIN_ROWS = 200
BASE_METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """One adaptive metric: its slack, and whether low values are outliers too."""
    name: str
    slack: float
    two_sided: bool = False


RULES = (Rule("symbol_share", 0.02), Rule("dup_line_share", 0.5), Rule("word_length", 2.0, two_sided=True))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def _repeat_starts(words: Column, keys: Column, bits: Column) -> Column:
    """Start positions of the 3-word windows that occur twice or more.

    `keys` are the sorted (window hash << bits | position) values: equal windows
    are neighbours. Words are compared too, so that equal hashes alone do not count."""
    def same(a: Column, b: Column) -> Column:
        i, j = (x.bitwiseAND(_mask(bits)).cast("int") for x in (a, b))
        equal = F.lit(True)
        for d in range(3):
            equal = equal & (F.get(words, i + d) == F.get(words, j + d))
        return (F.call_function("shiftrightunsigned", a, bits) == F.call_function("shiftrightunsigned", b, bits)) & equal

    hit = F.filter(keys, lambda k, j: ((j > 0) & same(k, F.get(keys, j - 1)))
                   | ((j < F.size(keys) - 1) & same(k, F.get(keys, j + 1))))
    return F.sort_array(F.transform(hit, lambda k: k.bitwiseAND(_mask(bits))))


def _mask(bits: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), bits) - 1


def with_metrics(df: DataFrame, text_col: str = "text", out: str = "metrics") -> DataFrame:
    """`df` and a struct column `out` with the base metrics and n_lines."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    w, k, s, b = (free_name(df, x) for x in ("__words", "__keys", "__starts", "__bits"))
    empty = F.array().cast("array<bigint>")
    df = df.withColumn(w, words_of(F.col(text_col)))
    df = df.withColumn(b, F.length(F.bin(F.size(w))).cast("int"))
    hashed = F.transform(F.sequence(F.lit(0), F.size(w) - 3),
                         lambda i: F.call_function("shiftleft", F.xxhash64(F.get(F.col(w), i), F.get(F.col(w), i + 1),
                                                                           F.get(F.col(w), i + 2)), F.col(b))
                         .bitwiseOR(i.cast("bigint")))
    df = df.withColumn(k, F.sort_array(F.when(F.size(w) >= 3, hashed).otherwise(empty)))
    df = df.withColumn(s, _repeat_starts(F.col(w), F.col(k), F.col(b)))
    covered = F.aggregate(
        F.col(s), F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("end")),
        lambda a, p: F.struct((a["n"] + p + 3 - F.greatest(a["end"], p)).alias("n"), (p + 3).alias("end")),
        lambda a: a["n"])
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(NON_SPACE))
    word_chars = F.aggregate(F.col(w), F.lit(0).cast("bigint"), lambda a, x: a + F.length(x))
    df = df.withColumn(out, F.struct(
        F.size(w).cast("bigint").alias("n_words"), word_chars.alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOL)).cast("bigint").alias("n_symbols"),
        F.size(lines).cast("bigint").alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"),
        covered.alias("n_repeat_words")))
    return df.drop(w, k, s, b)


def base_failed(m: Column) -> Column:
    return (m["n_words"] < 50) | (100 * m["n_repeat_words"] > 50 * m["n_words"])


def _values(m: Column) -> dict[str, Column]:
    def share(a, b):
        return F.when(m[b] > 0, m[a] / m[b]).otherwise(F.lit(0.0))
    return {"symbol_share": share("n_symbols", "word_chars"), "dup_line_share": share("n_dup_lines", "n_lines"),
            "word_length": share("word_chars", "n_words")}


def sketch(df: DataFrame, metrics: str = "metrics", lang: str = "lang", source: str = "source") -> DataFrame:
    """Quantile sketches (lang, source, metric, bucket, n) of the documents that pass the base rules."""
    v = _values(F.col(metrics))
    named = F.array(*[F.struct(F.lit(r.name).alias("metric"), v[r.name].alias("v")) for r in RULES])
    bucket = F.when(F.col("m.v") > 0, F.ceil(F.log(F.col("m.v")) / F.log(F.lit(GAMMA)))).cast("int")
    return (df.where(~base_failed(F.col(metrics)))
            .select(F.col(lang).alias("lang"), F.col(source).alias("source"), F.explode(named).alias("m"))
            .groupBy("lang", "source", F.col("m.metric").alias("metric"), bucket.alias("bucket"))
            .agg(F.count("*").alias("n")))


def merge(sketches: DataFrame, *keys: str) -> DataFrame:
    """Sketches added up over everything but `keys`."""
    return sketches.groupBy(*keys, "metric", "bucket").agg(F.sum("n").alias("n"))


def quantiles(sketches: DataFrame, *keys: str) -> DataFrame:
    """(keys, metric, rows, q25, q50, q75) read from sketches; the zero bucket (null) sorts first."""
    group = Window.partitionBy(*keys, "metric")
    value = F.when(F.col("bucket").isNull(), 0.0).otherwise(2 * F.pow(F.lit(GAMMA), F.col("bucket")) / (GAMMA + 1))
    cum = F.sum("n").over(group.orderBy(F.col("bucket").asc_nulls_first()))
    ranked = sketches.select(*keys, "metric", value.alias("value"), cum.alias("cum"), F.sum("n").over(group).alias("rows"))
    return ranked.groupBy(*keys, "metric").agg(
        F.max("rows").alias("rows"),
        *[F.min(F.when(F.col("cum") >= q * F.col("rows"), F.col("value"))).alias(f"q{int(q * 100)}") for q in (.25, .5, .75)])


def thresholds(sketches: DataFrame, min_rows: int = MIN_ROWS) -> DataFrame:
    """One row per (lang, source): low_<metric> and high_<metric>, from the smallest
    group (own, language, all) that has `min_rows` documents."""
    groups = sketches.select("lang", "source", "metric").distinct()
    own, lang, everything = (quantiles(merge(sketches, *k), *k) for k in (("lang", "source"), ("lang",), ()))
    pick = F.struct("rows", "q25", "q50", "q75")
    own, lang, everything = (x.select(*k, "metric", pick.alias(a)) for x, k, a in
                             ((own, ("lang", "source"), "o"), (lang, ("lang",), "l"), (everything, (), "a")))
    g = groups.alias("g")
    on = lambda other, *k: [F.col(f"g.{c}").eqNullSafe(F.col(f"{other}.{c}")) for c in (*k, "metric")]
    j = (g.join(own.alias("own"), on("own", "lang", "source"))
         .join(lang.alias("lang"), on("lang", "lang")).join(everything.alias("every"), on("every")))
    q = F.when(F.col("own.o.rows") >= min_rows, F.col("own.o")).when(F.col("lang.l.rows") >= min_rows, F.col("lang.l")) \
        .otherwise(F.col("every.a"))
    j = j.select("g.lang", "g.source", "g.metric", q.alias("q"))
    limits = []
    for r in RULES:
        mine = F.col("metric") == r.name
        high = F.col("q.q50") + SPREAD * (F.col("q.q50") - F.col("q.q25")) + r.slack
        low = F.col("q.q50") - SPREAD * (F.col("q.q75") - F.col("q.q50")) - r.slack
        limits.append(F.max(F.when(mine, high)).alias(f"high_{r.name}"))
        limits.append(F.max(F.when(mine, low if r.two_sided else F.lit(float("-inf")))).alias(f"low_{r.name}"))
    return j.groupBy("lang", "source").agg(*limits)


def judge(df: DataFrame, metrics: str = "metrics", lang: str = "lang", source: str = "source",
          min_rows: int = MIN_ROWS) -> DataFrame:
    """`df` (materialised, with `metrics`) and booleans base_failed and kept.

    The thresholds have one row per group, so a hot group is a skewed join with one
    row on the other side: broadcast when measured small, split by AQE otherwise."""
    t = thresholds(sketch(df, metrics, lang, source), min_rows)
    limits = [c for c in t.columns if c not in ("lang", "source")]
    t = t.select(F.col("lang").alias("__t_lang"), F.col("source").alias("__t_source"),
                 F.struct(*limits).alias("__limits"))
    j = df.join(t, F.col(lang).eqNullSafe(F.col("__t_lang")) & F.col(source).eqNullSafe(F.col("__t_source")), "left")
    v, lim = _values(F.col(metrics)), F.col("__limits")
    inside = F.lit(True)
    for r in RULES:
        inside = inside & (v[r.name] <= lim[f"high_{r.name}"]) & (v[r.name] >= lim[f"low_{r.name}"])
    failed = base_failed(F.col(metrics))
    return (j.withColumn("base_failed", failed)
            .withColumn("kept", ~failed & F.coalesce(inside, F.lit(True)))
            .drop("__t_lang", "__t_source", "__limits"))


def score_documents(docs: DataFrame, text_col: str = "text", min_rows: int = MIN_ROWS) -> DataFrame:
    """doc_id, the metrics, base_failed and kept, one row per document."""
    m = with_metrics(docs.select("doc_id", "lang", "source", text_col), text_col).drop(text_col)
    judged = judge(checkpointed(m), min_rows=min_rows)
    return judged.select("doc_id", *[F.col(f"metrics.{c}").alias(c) for c in BASE_METRICS], "base_failed", "kept")


def keep_good(docs: DataFrame, text_col: str = "text", min_rows: int = MIN_ROWS) -> DataFrame:
    """The documents that pass, with their own columns."""
    packed = docs.select(whole_row(docs).alias("row"), F.col(text_col).alias("text"),
                         F.col("lang").alias("lang"), F.col("source").alias("source"))
    m = stored(with_metrics(packed).drop("text"), "quality")
    return judge(m, min_rows=min_rows).where("kept").select("row.*")
