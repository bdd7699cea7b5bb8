"""Quality rules with risk-controlled thresholds (DataFrame functions only).

Base rules reject texts that are too short or mostly repeat themselves.
Beyond them, each rule compares one signal with a cutoff that is *learned
under a guarantee*, per stratum (language by default):

* Labelled documents are split by a hash of doc_id into a tuning part and a
  holdout.
* A cutoff is certified for a stratum if the holdout rejects the hypothesis
  "it rejects more than ``risk / number of rules`` of the good documents" by
  the exact binomial test, that is, if the Clopper-Pearson upper bound of
  its false rejection rate is at most that.
* Cutoffs of one rule and stratum are tested from lenient to strict and
  testing stops at the first failure (fixed sequence, no loss of level); the
  level ``delta`` is divided by strata times rules (Bonferroni). So with
  probability 1 - delta, *every* stratum loses at most ``risk`` of its good
  documents to the learned rules.
* Among certified cutoffs the tuning part picks the most useful one; a rule
  that catches nothing there stays off. A stratum with too few labels to
  certify anything gets no learned rule.

No text is ever shuffled: signals are computed where the text is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, join_small, materialise, words

#: rule -> (signal in thousandths as SQL over the counts, cutoffs from
#: lenient to strict). A document is rejected if the signal reaches the cutoff.
RULES = {
    "symbols": ("1000 * n_symbols div n_words", [2500, 2000, 1500, 1000, 700, 500, 300, 200, 100, 50]),
    "capitals": ("1000 * n_capitals div word_chars", [800, 700, 600, 500, 400, 300, 250, 200, 150, 100]),
    "dup_lines": ("1000 * n_dup_lines div n_lines", [900, 800, 700, 600, 500, 400, 350, 300, 250, 200]),
    "monotony": ("1000 - 1000 * n_distinct div n_words", [950, 900, 850, 800, 750, 700, 650, 600, 550, 500]),
}
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
REPEAT_WINDOW = 8
#: A good document lost weighs as much as so many bad ones caught.
LOSS_WEIGHT = 4

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _without(text: Column, characters: str) -> Column:
    return F.length(F.translate(text, characters, ""))


def _repeat_words(w: Column, hashes: Column, size: int) -> Column:
    """Words inside windows of ``size`` words found twice or more. Distinct
    window hashes prove that nothing repeats; else the windows themselves
    are sorted and equal neighbours mark their words."""
    last = F.size(w) - size + 1
    windows = F.transform(
        F.sequence(F.lit(1), last), lambda i: F.struct(F.array_join(F.slice(w, i, size), " ").alias("s"), i.alias("i"))
    )

    def covered(p: Column) -> Column:
        n = F.size(p)
        same = lambda j, k: F.get(p, j)["s"] == F.get(p, k)["s"]
        twice = F.filter(
            F.sequence(F.lit(0), n - 1),
            lambda j: F.coalesce((j > 0) & same(j, j - 1), F.lit(False)) | F.coalesce(same(j, j + 1), F.lit(False)),
        )
        starts = F.sort_array(F.transform(twice, lambda j: F.get(p, j)["i"]))
        state = lambda n, upto: F.struct(n.cast("long").alias("n"), upto.cast("long").alias("upto"))
        return F.aggregate(
            starts,
            state(F.lit(0), F.lit(0)),
            lambda acc, i: state(acc["n"] + i + size - F.greatest(acc["upto"], i.cast("long")), i + size),
            lambda acc: acc["n"],
        )

    # transform over a one-element array binds the sorted windows once.
    marked = F.get(F.transform(F.array(F.sort_array(windows)), covered), 0)
    return (
        F.when(last < 2, F.lit(0).cast("long"))
        .when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long"))
        .otherwise(marked)
    )


def text_signals(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns plus the counts of each whole text (null: empty)."""
    text = F.coalesce("text", F.lit(""))
    base = docs.select(*keep, text.alias("_text"), words(F.col("text")).alias("_w"))
    lines = F.filter(F.split("_text", "\n", -1), lambda x: x.rlike(WORD))
    last = F.size("_w") - REPEAT_WINDOW + 1
    hashes = F.when(
        last >= 2, F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(F.slice("_w", i, REPEAT_WINDOW)))
    ).otherwise(F.array().cast("array<long>"))
    length = F.length("_text")
    staged = base.select(
        *keep,
        "_w",
        hashes.alias("_h"),
        lines.alias("_lines"),
        F.size("_w").cast("long").alias("n_words"),
        _without(F.col("_text"), " \t\n\u000b\f\r").cast("long").alias("word_chars"),
        (length - _without(F.col("_text"), "#*$%&|<>")).cast("long").alias("n_symbols"),
        (length - F.length(F.regexp_replace("_text", r"\p{Lu}+", ""))).cast("long").alias("n_capitals"),
    )
    return staged.select(
        *keep,
        "n_words", "word_chars", "n_symbols", "n_capitals",
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.array_distinct("_w")).cast("long").alias("n_distinct"),
        _repeat_words(F.col("_w"), F.col("_h"), REPEAT_WINDOW).alias("n_repeat_words"),
    ).withColumn(
        "base_failed",
        (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
    )


def _ln_factorial(n: str) -> str:
    return (
        f"(CASE WHEN {n} <= 20 THEN ln(cast(factorial(cast({n} as int)) as double)) "
        f"ELSE {n} * ln({n}) - {n} + 0.5 * ln(2 * pi() * {n}) + 1 / (12.0D * {n}) "
        f"- 1 / (360.0D * pow({n}, 3)) + 1 / (1260.0D * pow({n}, 5)) END)"
    )


def binomial_p_value(n: str, k: str, rate: float) -> Column:
    """P(Binomial(n, rate) <= k), exact to double precision where it is
    small; 1 where k is not below the mean (never certified). Terms fall
    from k downwards, so those beyond 60 standard deviations are nothing."""
    odds = (1 - rate) / rate
    log_term = (
        f"{_ln_factorial(n)} - {_ln_factorial(k)} - {_ln_factorial(f'({n} - {k})')} "
        f"+ {k} * ln({rate!r}D) + ({n} - {k}) * ln({1 - rate!r}D)"
    )
    total = (
        f"aggregate(sequence(0L, least({k}, cast(60 * sqrt({k} + 1) as bigint))), "
        f"named_struct('term', 1.0D, 'sum', 0.0D), (acc, j) -> named_struct("
        f"'term', acc.term * ({k} - j) / ({n} - {k} + j + 1) * {odds!r}D, 'sum', acc.sum + acc.term), acc -> acc.sum)"
    )
    return F.expr(f"CASE WHEN {k} >= {rate!r}D * {n} THEN 1.0D ELSE exp({log_term}) * {total} END")


def _reached(signal: str, cutoffs: list[int]) -> Column:
    """How many of the cutoffs a document's signal reaches."""
    return F.size(F.filter(F.lit(cutoffs), lambda c: F.expr(signal) >= c))


def certified_cutoffs(signals: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = 0.05,
                      delta: float = 0.1) -> DataFrame:
    """The tests and choices: one row per stratum, rule and cutoff with
    n (good holdout documents), k (of them rejected), p_value, certified,
    gain (on the tuning part) and chosen.

    Of several labels of a document the lowest counts; labels without
    doc_id or quality are ignored, as are documents that fail a base rule.
    """
    label = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.min("quality").alias("quality")
    )
    label = label.withColumnRenamed("doc_id", "_label_id")
    known = signals.filter("not base_failed").join(label, F.col("doc_id") == F.col("_label_id"))
    known = known.withColumn("holdout", F.substring(F.md5(F.col("doc_id").cast("string")), 1, 1) < "a")
    # The strictest cutoffs that a document reaches, rule by rule.
    steps = F.array(
        *[F.struct(F.lit(rule).alias("rule"), _reached(*RULES[rule]).alias("reached")) for rule in RULES]
    )
    good, held = F.col("quality") == 1, F.col("holdout")
    counts = known.select(F.col(stratum).alias("stratum"), good.alias("good"), held.alias("held"),
                          F.explode(steps).alias("s"))
    counts = counts.groupBy("stratum", F.col("s.rule").alias("rule"), F.col("s.reached").alias("reached")).agg(
        F.count_if(F.col("good") & F.col("held")).alias("good_held"),
        F.count_if(F.col("good") & ~F.col("held")).alias("good_tuned"),
        F.count_if(~F.col("good") & ~F.col("held")).alias("bad_tuned"),
    )
    grid = F.array(
        *[
            F.struct(F.lit(rule).alias("of_rule"), F.lit(i).alias("step"), F.lit(c).alias("cutoff"))
            for rule, (_, cuts) in RULES.items()
            for i, c in enumerate(cuts)
        ]
    )
    # Cutoffs fall, so a document that reaches j of them reaches the last j.
    sizes = {rule: len(cuts) for rule, (_, cuts) in RULES.items()}
    length = F.create_map(*[x for r, n in sizes.items() for x in (F.lit(r), F.lit(n))])
    spread = counts.select("*", F.explode(F.filter(grid, lambda g: g["of_rule"] == F.col("rule"))).alias("g"))
    rejected = F.col("g.step") >= length[F.col("rule")] - F.col("reached")
    tested = spread.groupBy("stratum", "rule", "g.step", "g.cutoff").agg(
        F.sum("good_held").alias("n"),
        F.sum(F.when(rejected, F.col("good_held")).otherwise(0)).alias("k"),
        F.sum(F.when(rejected, F.col("bad_tuned") - LOSS_WEIGHT * F.col("good_tuned")).otherwise(0)).alias("gain"),
    )
    strata = known.agg(F.countDistinct(F.coalesce(F.col(stratum), F.lit(""))).alias("n_strata"))
    tested = tested.crossJoin(F.broadcast(strata))  # one row
    tested = tested.withColumn("p_value", binomial_p_value("n", "k", risk / len(RULES)))
    # k grows with strictness, so the p-values do: "up to the first failure"
    # and "p below the level" select the same cutoffs.
    level = F.lit(delta) / (F.col("n_strata") * len(RULES))
    tested = tested.withColumn("certified", (F.col("n") > 0) & (F.col("p_value") <= level))
    best = tested.filter("certified and gain > 0").groupBy("stratum", "rule").agg(
        F.max(F.struct("gain", "cutoff")).alias("best")
    )
    best = best.select(F.col("stratum").alias("_s"), F.col("rule").alias("_r"), F.col("best.cutoff").alias("_cut"))
    on = tested["stratum"].eqNullSafe(best["_s"]) & (tested["rule"] == best["_r"]) & (tested["cutoff"] == best["_cut"])
    return tested.join(best, on, "left").select(
        "stratum", "rule", "cutoff", "n", "k", "p_value", "certified", "gain", F.col("_cut").isNotNull().alias("chosen")
    )


def chosen_cutoffs(tests: DataFrame) -> DataFrame:
    """One row per stratum with a chosen cutoff: stratum, cut_<rule> ..."""
    return tests.filter("chosen").groupBy("stratum").agg(
        *[F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"cut_{r}") for r in RULES]
    )


def with_verdict(signals: DataFrame, cutoffs: DataFrame, stratum: str = "lang") -> DataFrame:
    """``signals`` plus kept: false where a base rule fails or a signal
    reaches its stratum's cutoff."""
    joined = join_small(signals, cutoffs.withColumnRenamed("stratum", stratum), stratum)
    # A base-failed text may have no words; its signals are not asked.
    rejected = F.lit(False)
    for rule, (signal, _) in RULES.items():
        rejected = rejected | F.coalesce(F.expr(f"CASE WHEN n_words > 0 AND n_lines > 0 THEN {signal} >= cut_{rule} END"),
                                         F.lit(False))
    out = joined.withColumn("kept", ~F.col("base_failed") & ~rejected)
    return out.drop(*[f"cut_{r}" for r in RULES])


def quality_rules(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = 0.05,
                  delta: float = 0.1) -> DataFrame:
    """One row per row of ``docs(doc_id, text, <stratum>)``: doc_id, the
    counts, base_failed, kept.

    A null or empty text has no words and fails the base rules. A null
    stratum is a stratum. Repeated rows are judged alike. Without labels,
    kept is ``not base_failed``. Extra columns are ignored.
    """
    signals = materialise(text_signals(docs, ("doc_id", stratum)), "signals")
    tests = materialise(certified_cutoffs(signals, labels, stratum, risk, delta), "cutoff-tests")
    judged = with_verdict(signals, chosen_cutoffs(tests), stratum)
    return judged.select("doc_id", *COUNTS, "base_failed", "kept")


def keep_quality(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = 0.05,
                 delta: float = 0.1) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their columns.

    Rows are written once together with their signals: texts stay where they
    are, rows need no key, and the signals are not computed again inside the
    final filter (which the optimizer would push below them)."""
    every = docs.select("doc_id", "text", stratum, F.struct("*").alias("_row"))
    signals = materialise(text_signals(every, ("_row", "doc_id", stratum)), "signals")
    tests = materialise(certified_cutoffs(signals.drop("_row"), labels, stratum, risk, delta), "cutoff-tests")
    return with_verdict(signals, chosen_cutoffs(tests), stratum).filter("kept").select("_row.*")
