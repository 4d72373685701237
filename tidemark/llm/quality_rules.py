"""Quality rules: a decision list learned by sequential covering.

Text statistics are built-in column expressions. From labelled rows the learner
grows one rule at a time, a conjunction of thresholds that singles out bad rows, on a
grow part, cuts it back on a prune part, takes out the rows that it covers, and
goes on. Each step is one grouped count over the labelled rows' histogram bins, so
the driver sees (features x bins) counts, never rows. The list comes out as an
ordered Spark conditional expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import UPPER, bind, words
from tidemark.session import materialize

SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20


def _repeated_window_words(ws: Column) -> Column:
    """Words in windows of five that occur twice or more in the text.

    Equal window hashes are only a first look: where there are none, no window
    repeats. Else the windows themselves are sorted with their places, those equal
    to a neighbour are kept, and each adds the words the one before it has not counted.
    """
    n_windows = F.size(ws) - F.lit(WINDOW - 1)

    def count_exactly(ws: Column) -> Column:
        grams = F.transform(
            F.sequence(F.lit(0), F.size(ws) - F.lit(WINDOW)),
            lambda i: F.struct(F.slice(ws, i + 1, F.lit(WINDOW)).alias("g"), i.alias("i")),
        )

        def places(s: Column) -> Column:
            same = F.filter(
                s, lambda x, k: F.coalesce(F.get(s, k - 1)["g"] == x["g"], F.lit(False)) | F.coalesce(F.get(s, k + 1)["g"] == x["g"], F.lit(False))
            )
            return F.array_sort(F.transform(same, lambda x: x["i"]))

        def total(at: Column) -> Column:
            return F.aggregate(
                F.transform(at, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(p - F.get(at, k - 1), F.lit(WINDOW)))),
                F.lit(0),
                lambda a, x: a + x,
            )

        return bind(bind(F.array_sort(grams), places), total)

    def any_equal(hs: Column) -> Column:
        keys = F.transform(
            F.sequence(F.lit(0), F.size(hs) - F.lit(WINDOW)),
            lambda i: F.xxhash64(*(F.get(hs, i + j) for j in range(WINDOW))),
        )
        return bind(keys, lambda k: F.size(F.array_distinct(k)) < F.size(k))

    repeated = F.when(
        bind(F.transform(ws, lambda w: F.xxhash64(w)), any_equal), count_exactly(ws)
    ).otherwise(F.lit(0))
    return F.when(n_windows < 2, F.lit(0)).otherwise(repeated)


def _removed(text: Column, chars: str) -> Column:
    for c in chars:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the statistics of each row's whole text, one row per input row.

    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines (lines with a word),
    n_bangs (exclamation marks), n_upper (A-Z) and base_failed (fewer than 10 words, or over
    20 % of them in repeated windows). A null text has no words; further columns are not read.
    """
    body = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    base = docs.select(F.col(f"`{id_col}`").alias("doc_id"), body.alias("body"))

    def word_part(ws: Column) -> Column:
        return F.struct(
            F.size(ws).cast("bigint").alias("n_words"),
            F.char_length(F.array_join(ws, "")).cast("bigint").alias("word_chars"),
            _repeated_window_words(ws).cast("bigint").alias("n_repeat_words"),
        )

    def line_part(ls: Column) -> Column:
        return F.struct(
            F.size(ls).cast("bigint").alias("n_lines"),
            (F.size(ls) - F.size(F.array_distinct(ls))).cast("bigint").alias("n_dup_lines"),
        )

    lines = F.filter(F.split("body", "\n"), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))
    chars = F.char_length("body")
    stats = base.select(
        "doc_id",
        bind(words(F.col("body")), word_part).alias("w"),
        bind(lines, line_part).alias("l"),
        (chars - F.char_length(_removed(F.col("body"), SYMBOLS))).cast("bigint").alias("n_symbols"),
        (chars - F.char_length(_removed(F.col("body"), "!"))).cast("bigint").alias("n_bangs"),
        (chars - F.char_length(F.translate("body", UPPER, ""))).cast("bigint").alias("n_upper"),
    ).select("doc_id", "w.*", "l.*", "n_symbols", "n_bangs", "n_upper")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return stats.withColumn("base_failed", failed)


def _per(a: str, b: str) -> Column:
    return F.col(a) / F.greatest(F.col(b), F.lit(1)).cast("double")




def features() -> dict[str, Column]:
    return {
        "n_words": F.col("n_words").cast("double"),
        "mean_word_chars": _per("word_chars", "n_words"),
        "symbol_ratio": _per("n_symbols", "n_words"),
        "bang_ratio": _per("n_bangs", "n_words"),
        "upper_ratio": _per("n_upper", "word_chars"),
        "repeat_ratio": _per("n_repeat_words", "n_words"),
        "dup_line_ratio": _per("n_dup_lines", "n_lines"),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool  # feature > threshold, else feature <= threshold
    threshold: float

    def column(self) -> Column:
        x = features()[self.feature]
        return x > F.lit(self.threshold) if self.above else x <= F.lit(self.threshold)


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]
    precision: float

    def column(self) -> Column:
        out = F.lit(True)
        for c in self.conditions:
            out = out & c.column()
        return out


def list_expression(rules: list[Rule]) -> Column:
    """The ordered conditional: the first rule that holds rejects, else the row is kept."""
    out = None
    for r in rules:
        out = F.when(r.column(), F.lit(False)) if out is None else out.when(r.column(), F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def learn_rules(
    labelled: DataFrame, bad_col: str = "bad", bins: int = 32, max_conditions: int = 3, max_rules: int = 8, min_precision: float = 0.9, min_cover: int = 3
) -> list[Rule]:
    """Learn an ordered list of rules that single out the rows with ``bad`` = 1.

    ``labelled`` has the statistics and 0/1 ``bad``. Thresholds are quantiles (``bins`` of
    them) of each feature over the bad rows and over the others. Two thirds of the rows, by a hash of their
    statistics, grow rules by FOIL's gain; the rest prune them: the shortest prefix with the best
    (p - n) / (p + n) there stays. Learning ends with ``max_rules`` rules or
    with the first rule that covers under ``min_cover`` bad rows of the grow part or has less than ``min_precision`` over both
    parts. With no bad or no good rows the list is empty and everything is kept.
    """
    names = list(features())
    grid = [i / (bins + 1) for i in range(1, bins + 1)]
    base = labelled.select(F.col(bad_col).cast("int").alias("bad"), *(c.alias(n) for n, c in features().items()))
    base = base.filter(F.col("bad").isNotNull())
    quant = (
        base.groupBy("bad")
        .agg(*(F.percentile_approx(n, grid, 10_000).alias(n) for n in names))
        .collect()  # two rows of (features x bins) numbers
    )
    if len(quant) < 2:
        return []
    cuts = {n: sorted({v for row in quant for v in row[n]}) for n in names}

    def bin_of(n: str) -> Column:
        # The number of cuts below the value; x > cuts[k] exactly where bin > k.
        return F.size(F.filter(F.array(*(F.lit(float(c)) for c in cuts[n])), lambda c: c < F.col(n)))

    binned = materialize(
        base.select(
            "bad",
            (F.pmod(F.xxhash64(*names), F.lit(3)) == 0).alias("prune"),
            *(bin_of(n).alias(n) for n in names),
        )
        .groupBy("bad", "prune", *names)
        .agg(F.count("*").alias("n")),
        "rule-bins",
    )

    def test(c: Condition) -> Column:
        k = cuts[c.feature].index(c.threshold)
        return F.col(c.feature) > k if c.above else F.col(c.feature) <= k

    def all_of(conds) -> Column:
        out = F.lit(True)
        for c in conds:
            out = out & test(c)
        return out

    def histogram(left: DataFrame, conds) -> list:
        pairs = F.array(*(F.struct(F.lit(n).alias("f"), F.col(n).alias("b")) for n in names))
        return (
            left.filter(~F.col("prune") & all_of(conds))
            .select("bad", "n", F.explode(pairs).alias("x"))
            .groupBy("x.f", "x.b")
            .agg(F.sum(F.col("bad") * F.col("n")).alias("p"), F.sum((1 - F.col("bad")) * F.col("n")).alias("q"))
            .collect()  # at most features x (cuts + 1) rows
        )

    def best_condition(hist) -> tuple[float, Condition | None, int, int]:
        per: dict[str, dict[int, tuple[int, int]]] = {}
        for r in hist:
            per.setdefault(r["f"], {})[r["b"]] = (r["p"], r["q"])
        any_feature = next(iter(per.values()), {})
        all_p, all_q = sum(p for p, _ in any_feature.values()), sum(q for _, q in any_feature.values())
        if not all_p:
            return 0.0, None, 0, 0
        prior = math.log2(all_p / (all_p + all_q))
        best = (1e-9, None, all_p, all_q)
        for f in names:
            low_p = low_q = 0
            for k, cut in enumerate(cuts[f]):
                p, q = per.get(f, {}).get(k, (0, 0))
                low_p, low_q = low_p + p, low_q + q
                for above, cp, cq in ((False, low_p, low_q), (True, all_p - low_p, all_q - low_q)):
                    if cp:
                        gain = cp * (math.log2(cp / (cp + cq)) - prior)
                        if gain > best[0]:
                            best = (gain, Condition(f, above, cut), cp, cq)
        return best

    rules: list[Rule] = []
    left = binned
    while len(rules) < max_rules:
        conds: list[Condition] = []
        while len(conds) < max_conditions:
            _, c, p, q = best_condition(histogram(left, conds))
            if c is None:
                break
            conds.append(c)
            if q == 0:
                break
        if not conds:
            break
        sums = []
        for k in range(1, len(conds) + 1):
            hit = all_of(conds[:k])
            for part in ("prune", "grow"):
                here = hit & (F.col("prune") if part == "prune" else ~F.col("prune"))
                sums.append(F.coalesce(F.sum(F.when(here, F.col("bad") * F.col("n"))), F.lit(0)).alias(f"{part}_p{k}"))
                sums.append(F.coalesce(F.sum(F.when(here, (1 - F.col("bad")) * F.col("n"))), F.lit(0)).alias(f"{part}_q{k}"))
        got = left.agg(*sums).first()

        def worth(k: int) -> float:
            p, q = got[f"prune_p{k}"], got[f"prune_q{k}"]
            return (p - q) / (p + q) if p + q else -1.0

        top = max(worth(k) for k in range(1, len(conds) + 1))
        keep = len(conds) if top == -1.0 else min(k for k in range(1, len(conds) + 1) if worth(k) == top)
        p = got[f"prune_p{keep}"] + got[f"grow_p{keep}"]
        q = got[f"prune_q{keep}"] + got[f"grow_q{keep}"]
        if got[f"grow_p{keep}"] < min_cover or p < min_precision * (p + q):
            break
        rules.append(Rule(tuple(conds[:keep]), p / (p + q)))
        left = left.filter(~all_of(conds[:keep]))
    return rules


def apply_rules(stats: DataFrame, rules: list[Rule]) -> DataFrame:
    """``stats`` with ``kept``: false where the base filter fails, else the list's verdict."""
    return stats.withColumn("kept", ~F.col("base_failed") & list_expression(rules))


def judge_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", quality_col: str = "quality") -> DataFrame:
    """Statistics, learned verdict and ``kept`` of every document.

    The statistics are computed once and written; learning reads those of rows with a
    label (several labels of one id: the lowest quality counts; null ids and labels are left out) that pass the base filter.
    """
    stats = materialize(text_statistics(docs, id_col, text_col), "text-stats")
    marks = (
        labels.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{quality_col}`").alias("q"))
        .dropna()
        .groupBy("doc_id")
        .agg(F.when(F.min("q") > 0, F.lit(0)).otherwise(F.lit(1)).alias("bad"))
    )
    labelled = stats.filter(~F.col("base_failed")).join(marks, "doc_id")
    return apply_rules(stats, learn_rules(labelled))
