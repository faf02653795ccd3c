"""Quality rules with risk-controlled thresholds (DataFrame functions only).

Every rule rejects a document whose figure exceeds a cutoff. Cutoffs are chosen per
stratum (language) on labelled good documents, each different text counted once, in
two halves dealt by the text's hash. The first half proposes: ``STEPS`` combinations
of one cutoff a rule, from mild to strict, out of fixed grids. The second half
decides: a combination is admitted only if the exact binomial test - of the half's
texts, k would be rejected by any rule - shows that all rules together reject less
than ``RISK`` of the good documents, at level ``ERROR / strata`` (Bonferroni over
strata; along the steps the tests are a fixed sequence and counts only grow, so the
last admitted one is valid). At most ``RISK`` of the good documents of any stratum
are rejected, with probability ``1 - ERROR`` over all strata at once. Strata with too
few labels get no cutoff.

Words within one text are compared by 64-bit hashes of their three-word windows.
Edge cases: null text is an empty text (fails the base rule); a null language is a
stratum of its own; labels that disagree for a doc_id are not used; repeated rows
are judged each; a figure equal to its cutoff passes; very long texts are one row of
arrays; other columns of docs are not read; empty tables give no rows or no cutoffs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glean.llm.common import save, table, with_columns_of
from glean.llm.registry import query

RISK, ERROR = 0.04, 0.05
MIN_WORDS = 50
#: Proposals, mild to strict: (share of the proposing third that a rule may reject, notches of its grid to step back).
STEPS = [(0.0, 2), (0.0, 1), (0.0, 0), (0.0025, 0), (0.005, 0), (0.01, 0)]
_SPACE = " \t\n\x0b\f\r"
#: Rule: (figure, cutoffs from mild to strict).
RULES: dict[str, tuple[str, list[float]]] = {
    "symbols": ("n_symbols / greatest(word_chars, 1)", [1.0, 0.7, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.12, 0.1, 0.08, 0.06, 0.05, 0.04, 0.03, 0.02, 0.01]),
    "dup_lines": ("n_dup_lines / greatest(n_lines, 1)", [0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1, 0.05]),
    "repeats": ("n_repeat_words / greatest(n_words, 1)", [0.49, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1, 0.05]),
    "long_words": ("word_chars / greatest(n_words, 1)", [40.0, 30.0, 25.0, 20.0, 16.0, 14.0, 12.0, 11.0, 10.0, 9.0, 8.0]),
}


def _windows_repeated(g: Column) -> Column:
    """(hash, position) of the three-word windows in order of the hash, only if any hash occurs twice."""
    return F.when(F.size(F.array_distinct(g)) < F.size(g), F.sort_array(F.transform(g, lambda x, i: F.struct(x.alias("h"), i.alias("i")))))


def figures(docs: DataFrame) -> DataFrame:
    """doc_id, stratum and the counts of every row."""
    d = with_columns_of(docs, ["doc_id", "text", "lang"]).select(
        "doc_id", F.coalesce("lang", F.lit("(none)")).alias("stratum"), F.coalesce("text", F.lit("")).alias("text"))
    d = d.withColumn("w", F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda x: x != ""))
    d = d.withColumn("lines", F.filter(F.split("text", "\n", -1), lambda x: F.translate(x, _SPACE, "") != ""))
    d = d.select("doc_id", "stratum", F.xxhash64("text").alias("text_hash"), F.size("w").cast("long").alias("n_words"),
                 F.length(F.translate("text", _SPACE, "")).cast("long").alias("word_chars"),
                 (F.length("text") - F.length(F.translate("text", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
                 F.size("lines").cast("long").alias("n_lines"),
                 (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
                 F.transform("w", lambda x: F.xxhash64(x)).alias("h"))
    d = d.withColumn("g", F.transform(F.slice("h", F.lit(1), F.greatest(F.size("h") - 2, F.lit(0))),
                                      lambda x, i: F.xxhash64(x, F.get("h", i + 1), F.get("h", i + 2)))).drop("h")
    d = d.withColumn("s", _windows_repeated(F.col("g"))).drop("g")
    d = d.withColumn("p", F.sort_array(F.transform(F.filter("s", lambda x, i: F.coalesce(F.get("s", i - 1)["h"] == x["h"], F.lit(False))
                                                            | F.coalesce(F.get("s", i + 1)["h"] == x["h"], F.lit(False))), lambda x: x["i"]))).drop("s")
    covered = F.aggregate(F.transform("p", lambda x, i: F.least(F.lit(3), F.coalesce(F.get("p", i + 1) - x, F.lit(3)))),
                          F.lit(0).cast("long"), lambda a, x: a + x)
    return d.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop("p")


def most_rejections(n: Column, risk: float, level: Column) -> Column:
    """Largest k with P(Binomial(n, risk) <= k) <= level; -1 if there is none. The tail is summed in logarithms."""
    import math

    odds, log_level = math.log(risk / (1 - risk)), F.log(level)
    zero = F.struct((n * math.log1p(-risk)).cast("double").alias("term"), F.lit(float("-inf")).alias("total"), F.lit(-1).cast("long").alias("k"))

    def add(s, k):
        high, low = F.greatest(s["total"], s["term"]), F.least(s["total"], s["term"])
        total = high + F.log1p(F.exp(low - high))
        return F.struct((s["term"] + F.log((n - k).cast("double")) - F.log((k + 1).cast("double")) + odds).alias("term"), total.alias("total"),
                        F.when(total <= log_level, k).otherwise(s["k"]).cast("long").alias("k"))

    return F.aggregate(F.sequence(F.lit(0).cast("long"), F.floor(n * risk).cast("long")), zero, add, lambda s: s["k"])


def cutoffs(fig: DataFrame, labels: DataFrame) -> DataFrame:
    """stratum, n_good (texts of the deciding part) and a cutoff (or null) of each rule."""
    good = (labels.filter("doc_id is not null and quality is not null").groupBy("doc_id")
            .agg(F.min("quality").alias("lo"), F.max("quality").alias("hi")).filter("lo = 1 and hi = 1").select("doc_id"))
    counts = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]  # equal for equal texts
    held = (fig.join(good, "doc_id", "left_semi").groupBy("stratum", "text_hash").agg(*[F.min(c).alias(c) for c in counts])
            .withColumn("second", F.pmod(F.xxhash64("text_hash", F.lit(4)), F.lit(3)) > 0))
    rejected = [F.array(*[F.count_if(F.expr(figure) > c) for c in grid]).alias(f"k_{name}") for name, (figure, grid) in RULES.items()]
    first = held.filter("not second").groupBy("stratum").agg(F.count("*").alias("n"), *rejected)

    def proposed(name: str, share: float, back: int) -> Column:
        grid = F.array(*[F.lit(c) for c in RULES[name][1]])
        return F.get(grid, F.size(F.filter(f"k_{name}", lambda k: k <= share * F.col("n"))) - 1 - back).alias(f"cut_{name}")

    steps = first.select("stratum", F.array(*[F.struct(*[proposed(name, *step) for name in RULES]) for step in STEPS]).alias("steps"))

    def any_rule(step: int) -> Column:
        out = F.lit(False)
        for name, (figure, _) in RULES.items():
            out = out | F.coalesce(F.expr(figure) > F.get("steps", F.lit(step))[f"cut_{name}"], F.lit(False))
        return out

    by = (held.filter("second").join(steps, "stratum", "left").groupBy("stratum")
          .agg(F.count("*").alias("n_good"), F.array(*[F.count_if(any_rule(i)) for i in range(len(STEPS))]).alias("k")))
    n_strata = fig.agg(F.count_distinct("stratum").alias("m")).first()["m"]
    by = by.withColumn("k_max", most_rejections(F.col("n_good"), RISK, F.lit(ERROR / max(1, n_strata)))).join(steps, "stratum", "left")
    last = F.get("steps", F.size(F.filter("k", lambda k: k <= F.col("k_max"))) - 1)
    return by.select("stratum", "n_good", *[last[f"cut_{name}"].alias(f"cut_{name}") for name in RULES])


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    fig = save(figures(docs), "quality-figures")
    cuts = save(cutoffs(fig, labels), "quality-cutoffs")  # a row a language; Spark broadcasts it below its threshold
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    passes = F.lit(True)
    for name, (figure, _) in RULES.items():
        passes = passes & F.coalesce(F.expr(figure) <= F.col(f"cut_{name}"), F.lit(True))
    return fig.join(cuts, "stratum", "left").withColumn("base_failed", failed).withColumn("kept", ~failed & passes)


@query("op4_quality_rules")
def op4_quality_rules(spark, sf_dir):
    out = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
