"""Evaluation metrics over tables of predictions and references."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.text import clean

# Metrics of the comparison, their labels, and whether less is better.
METRICS = [
    ("loss", "Loss", True),
    ("perplexity", "Perplexity (PPL)", True),
    ("em", "Exact Match (EM)", False),
    ("bleu", "BLEU", False),
    ("rouge_l", "ROUGE-L", False),
    ("codebleu", "CodeBLEU", False),
    ("avg_response_length", "Avg Response Length", False),
    ("tokens_per_sec", "Tokens/sec", False),
]
MAX_ORDER = 4


def exact_match(prediction: Column, reference: Column) -> Column:
    """Share of equal pairs, blanks at the ends and case aside."""
    return F.avg((F.lower(clean(prediction)) == F.lower(clean(reference))).cast("int"))


def tokens_13a(c: Column) -> Column:
    """Words after the public 13a rules: punctuation apart, but periods and commas inside numbers kept."""
    t = F.concat(F.lit(" "), c, F.lit(" "))
    for pattern, to in (
        ("<skipped>", ""),
        ("-\n", ""),
        ("\n", " "),
        ("&quot;", '"'),
        ("&amp;", "&"),
        ("&lt;", "<"),
        ("&gt;", ">"),
        (r"([\{-\~\[-\` -\&\(-\+\:-\@\/])", " $1 "),
        (r"([^0-9])([\.,])", "$1 $2 "),
        (r"([\.,])([^0-9])", " $1 $2"),
        (r"([0-9])(-)", "$1 $2 "),
    ):
        t = F.regexp_replace(t, pattern, to)
    return F.filter(F.split(t, r"\s+"), lambda x: x != "")


def bleu_counts(df: DataFrame, group: str, prediction: str, reference: str, key: str) -> DataFrame:
    """Per group and order 1 to 4: clipped matches and totals of n-grams, and lengths of both sides."""
    toks = df.select(F.col(group).alias("grp"), F.col(key).alias("k"), tokens_13a(F.col(prediction)).alias("p"), tokens_13a(F.col(reference)).alias("r"))
    orders = F.explode(F.sequence(F.lit(1), F.lit(MAX_ORDER)))

    def grams(side: str) -> DataFrame:
        per = toks.select("grp", "k", orders.alias("o"), F.col(side).alias("t"))
        at = F.sequence(F.lit(1), F.greatest(F.size("t") - F.col("o") + 1, F.lit(1)))
        each = F.when(F.size("t") >= F.col("o"), F.transform(at, lambda i: F.array_join(F.slice("t", i, F.col("o")), " "))).otherwise(F.array().cast("array<string>"))
        return per.select("grp", "k", "o", F.explode(each).alias("g")).groupBy("grp", "k", "o", "g").agg(F.count(F.lit(1)).alias(f"n_{side}"))

    clipped = grams("p").join(grams("r"), ["grp", "k", "o", "g"], "left").groupBy("grp", "o").agg(
        F.sum(F.least("n_p", F.coalesce("n_r", F.lit(0)))).alias("matches"), F.sum("n_p").alias("total")
    )
    lengths = toks.groupBy("grp").agg(F.sum(F.size("p")).alias("pred_len"), F.sum(F.size("r")).alias("ref_len"))
    every = lengths.select("*", orders.alias("o"))
    return every.join(clipped, ["grp", "o"], "left").select(
        F.col("grp").alias(group), F.col("o").alias("order"), F.coalesce("matches", F.lit(0)).cast("long").alias("matches"), F.coalesce("total", F.lit(0)).cast("long").alias("total"), "pred_len", "ref_len"
    )


def bleu_scores(counts: DataFrame, group: str) -> DataFrame:
    """0 to 100, with the effective order (orders without n-grams don't count) and exponential smoothing of empty matches."""
    orders = F.array_sort(F.collect_list(F.struct("order", "matches", "total")))
    per = counts.groupBy(group).agg(orders.alias("o"), F.max("pred_len").alias("p"), F.max("ref_len").alias("r"))
    used = F.filter("o", lambda x: x["total"] > 0)
    start = F.struct(F.lit(0.0).alias("log"), F.lit(1.0).alias("smooth"))
    folded = F.aggregate(
        used,
        start,
        lambda a, x: F.when(x["matches"] > 0, F.struct((a["log"] + F.log(x["matches"] / x["total"])).alias("log"), a["smooth"].alias("smooth"))).otherwise(
            F.struct((a["log"] + F.log(F.lit(1.0) / (a["smooth"] * 2 * x["total"]))).alias("log"), (a["smooth"] * 2).alias("smooth"))
        ),
    )
    brevity = F.when(F.col("p") >= F.col("r"), 0.0).otherwise(1 - F.col("r") / F.col("p"))
    some = F.exists(used, lambda x: x["matches"] > 0)
    return per.select(group, F.when(some, 100 * F.exp(brevity + folded["log"] / F.size(used))).otherwise(0.0).alias("bleu"))


def stem(word: str) -> str:
    """The classic suffix stripper of Porter (1980), as published."""
    if len(word) <= 2:
        return word
    vowel = lambda w, i: w[i] in "aeiou" or (w[i] == "y" and i > 0 and not vowel(w, i - 1))

    def measure(w: str) -> int:
        kinds = [vowel(w, i) for i in range(len(w))]
        return sum(a and not b for a, b in zip(kinds, kinds[1:]))

    has_vowel = lambda w: any(vowel(w, i) for i in range(len(w)))
    double = lambda w: len(w) > 1 and w[-1] == w[-2] and not vowel(w, len(w) - 1)
    cvc = lambda w: len(w) > 2 and not vowel(w, len(w) - 3) and vowel(w, len(w) - 2) and not vowel(w, len(w) - 1) and w[-1] not in "wxy"

    def swap(w: str, rules: list[tuple[str, str]], least: int) -> str:
        for end, to in rules:
            if w.endswith(end):
                root = w[: len(w) - len(end)]
                return root + to if measure(root) >= least else w
        return w

    w = word
    for end, to in (("sses", "ss"), ("ies", "i"), ("ss", "ss"), ("s", "")):
        if w.endswith(end):
            w = w[: len(w) - len(end)] + to
            break
    if w.endswith("eed"):
        w = w[:-1] if measure(w[:-3]) > 0 else w
    else:
        for end in ("ed", "ing"):
            if w.endswith(end) and has_vowel(w[: -len(end)]):
                w = w[: -len(end)]
                if w.endswith(("at", "bl", "iz")):
                    w += "e"
                elif double(w) and w[-1] not in "lsz":
                    w = w[:-1]
                elif measure(w) == 1 and cvc(w):
                    w += "e"
                break
    if w.endswith("y") and has_vowel(w[:-1]):
        w = w[:-1] + "i"
    # Suffixes of steps 2 to 4 of the published algorithm.
    w = swap(w, [("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("abli", "able"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble")], 1)
    w = swap(w, [("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", "")], 1)
    for end in ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize"):
        if w.endswith(end):
            root = w[: -len(end)]
            if measure(root) > 1 and (end != "ion" or root.endswith(("s", "t"))):
                w = root
            break
    if w.endswith("e") and (measure(w[:-1]) > 1 or (measure(w[:-1]) == 1 and not cvc(w[:-1]))):
        w = w[:-1]
    return w[:-1] if double(w) and w[-1] == "l" and measure(w) > 1 else w


def rouge_tokens(text: str | None) -> list[str]:
    import re

    words = re.sub("[^a-z0-9]+", " ", (text or "").lower()).split()
    return [stem(w) if len(w) > 3 else w for w in words]


def rouge_l_f(prediction: str | None, reference: str | None) -> float:
    """F-measure of the longest common subsequence of stems."""
    a, b = rouge_tokens(prediction), rouge_tokens(reference)
    if not a or not b:
        return 0.0
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    p, r = row[-1] / len(a), row[-1] / len(b)
    return 2 * p * r / (p + r) if p + r else 0.0


def rouge_l(prediction: Column, reference: Column) -> Column:
    """Per row; its mean is the metric."""

    @F.pandas_udf("double")
    def score(p, r):  # noqa: ANN001, ANN202
        import pandas as pd

        return pd.Series([rouge_l_f(x, y) for x, y in zip(p, r)], dtype="float64")

    return score(prediction, reference)


def code_bleu(prediction: Column, reference: Column) -> Column:
    """Null: the metric needs parsers that stay outside; reports show it as absent."""
    return F.lit(None).cast("double")


def by_category(df: DataFrame, category: str, prediction: str, reference: str, key: str) -> DataFrame:
    """A row per category: rows, exact match, BLEU (0 to 100), mean ROUGE-L, CodeBLEU."""
    p, r = F.col(prediction), F.col(reference)
    rows = df.select(F.col(category).alias("category"), F.col(key).alias("k"), p.alias("p"), r.alias("r"))
    means = rows.groupBy("category").agg(F.count(F.lit(1)).alias("n"), exact_match(F.col("p"), F.col("r")).alias("em"))
    rouge = rows.select("category", rouge_l(F.col("p"), F.col("r")).alias("x")).groupBy("category").agg(F.avg("x").alias("rouge_l"))
    bleu = bleu_scores(bleu_counts(rows, "category", "p", "r", "k"), "category")
    return means.join(bleu, "category", "left").join(rouge, "category", "left").withColumn("codebleu", code_bleu(p, r))


def with_metrics(categories: DataFrame, **sides: DataFrame) -> DataFrame:
    """categories: category. Each side: category, value. A category that a side lacks stays, with a null."""
    out = categories
    for name, side in sides.items():
        out = out.join(side.select("category", F.col("value").alias(name)), "category", "left")
    return out


def perplexity(loss: Column) -> Column:
    """exp of the unweighted mean of the samples' losses."""
    return F.exp(F.avg(loss))


def throughput(tokens: Column, seconds: Column) -> Column:
    """A ratio of sums; 0 if no time passed."""
    return F.when(F.sum(seconds) > 0, F.sum(tokens) / F.sum(seconds)).otherwise(0.0)


def token_hits(predictions: Column, labels: Column, mask: int = -100) -> Column:
    """struct<correct, total>: the prediction at t against the label at t + 1, masked labels left out."""
    n = F.size(labels)
    pairs = F.zip_with(F.slice(predictions, F.lit(1), F.greatest(n - 1, F.lit(0))), F.slice(labels, F.lit(2), F.greatest(n - 1, F.lit(0))), lambda p, y: F.struct(p.alias("p"), y.alias("y")))
    real = F.filter(pairs, lambda x: x["y"] != mask)
    return F.struct(F.size(F.filter(real, lambda x: x["p"] == x["y"])).cast("long").alias("correct"), F.size(real).cast("long").alias("total"))


def token_accuracy(correct: Column, total: Column) -> Column:
    return F.when(F.sum(total) > 0, F.sum(correct) / F.sum(total)).otherwise(0.0)


def improvement(base: Column, tuned: Column, lower_is_better: Column | bool = False) -> Column:
    """Per cent; null if either is missing or the base is 0."""
    lower = F.lit(lower_is_better) if isinstance(lower_is_better, bool) else lower_is_better
    change = F.when(lower, (base - tuned) / base).otherwise((tuned - base) / F.abs(base)) * 100
    return F.when(base.isNull() | tuned.isNull() | (base == 0), F.lit(None).cast("double")).otherwise(F.round(change, 2))


def improvement_label(imp: Column) -> Column:
    """Signed, two places; N/A for none and for 0."""
    text = F.format_string("%.2f%%", imp)
    return F.when(imp > 0, F.concat(F.lit("+"), text)).when(imp < 0, text).otherwise("N/A")


def compare(config: DataFrame, **sides: DataFrame) -> DataFrame:
    """config: metric, label, lower_is_better. Each side: metric, value. Left joins on the metric: absent values are null."""
    out = config
    for name, side in sides.items():
        out = out.join(side.select("metric", F.col("value").alias(name)), "metric", "left")
    return out


def metrics_config(spark) -> DataFrame:  # noqa: ANN001
    return spark.createDataFrame(METRICS, "metric string, label string, lower_is_better boolean")
