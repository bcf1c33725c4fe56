"""Quality rules whose cutoffs are selected under control of the risk to reject good documents: built-in functions only."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, joined, written

SYMBOLS = "#*$%&|<>"
#: Words of a window, of which repeats are counted.
WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """A document is rejected if value, a share in thousandths, is over the cutoff. SQL over the measures, so that it is one text for all engines."""

    name: str
    value: str
    #: From the most lenient to the strictest.
    cutoffs: tuple[int, ...]


RULES = (
    Rule("symbols", "1000 * n_symbols {div} greatest(word_chars, 1)", tuple(range(500, 9, -10))),
    Rule("repeats", "1000 * n_repeat_words {div} greatest(n_words, 1)", tuple(range(200, 9, -10))),
    Rule("same_lines", "1000 * n_dup_lines {div} greatest(n_lines, 1)", tuple(range(900, 19, -20))),
    Rule("long_words", "1000 * word_chars {div} greatest(n_words, 1)", tuple(range(40_000, 3_999, -500))),
)
#: At most this share of good documents may be rejected by the selected cutoffs of a stratum, in all rules together ...
ALPHA = 0.05
#: ... which holds for all strata at once but for this probability.
DELTA = 0.1


def _let(value: Column, then) -> Column:
    """then(value), where value is worked out once."""
    return F.transform(F.array(value), then)[0]


def _repeat_words(words: Column) -> Column:
    """Words in windows that are in the text twice or more.

    Windows are 64-bit hashes. Where they are not all different, they are sorted with their places, so that equal ones are neighbours; the
    places of those are sorted, and each covers what is before the next one.
    """
    hashes = lambda w: F.slice(F.transform(w, lambda x, k: F.xxhash64(x, *[F.get(w, k + j) for j in range(1, WINDOW)])), F.lit(1), F.size(w) - (WINDOW - 1))
    pairs = lambda h: F.array_sort(F.transform(h, lambda x, k: F.struct(x.alias("h"), k.alias("k"))))
    same = lambda s, x, k: F.coalesce(x["h"] == F.get(s, k - 1)["h"], F.lit(False)) | F.coalesce(x["h"] == F.get(s, k + 1)["h"], F.lit(False))
    places = lambda s: F.array_sort(F.transform(F.filter(s, lambda x, k: same(s, x, k)), lambda x: x["k"]))
    cover = lambda p: F.aggregate(F.transform(p, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW)))), F.lit(0), lambda a, x: a + x)
    sorted_ = lambda h: _let(pairs(h), lambda s: _let(places(s), cover))
    some = lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), sorted_(h)).otherwise(0)
    return F.when(F.size(words) > WINDOW, _let(hashes(words), some)).otherwise(0).cast("long")


def measured(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_lines (with a word), n_dup_lines and n_repeat_words, all long, of the whole text.

    Words are runs of what is no white space of ASCII. Null counts as empty; a text is worked on in its row, in memory that is some tens of bytes
    a word. Columns of docs with one of these names are replaced.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
    docs = docs.drop(*names)
    own = [F.col(f"`{c}`") for c in docs.columns]
    t, words, lines, symbols = (fresh(docs, x) for x in ("t", "words", "lines", "symbols"))
    text = docs.select(*own, F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias(t))
    row = F.struct(
        F.filter(F.split(F.col(t), r"[ \t-\r]+", -1), lambda w: w != "").alias(words),
        F.filter(F.split(F.col(t), "\n", -1), lambda x: x.rlike(r"[^ \t-\r]")).alias(lines),
        F.when(F.col(t).rlike(f"[{SYMBOLS}]"), F.char_length(F.col(t)) - F.char_length(F.translate(F.col(t), SYMBOLS, ""))).otherwise(0).alias(symbols),
    )
    # The generator keeps the arrays from being worked out again for each use.
    cut = text.select(*own, F.inline(F.array(row)))
    return cut.select(*own, F.size(words).cast("long").alias("n_words"), F.aggregate(words, F.lit(0).cast("long"), lambda a, w: a + F.char_length(w)).alias("word_chars"), F.col(symbols).cast("long").alias("n_symbols"), F.size(lines).cast("long").alias("n_lines"), (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"), _repeat_words(F.col(words)).alias("n_repeat_words"))


BASE_FAILED = "n_words < 10 OR 100 * n_repeat_words > 20 * n_words"


def _tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) of X ~ Binomial(n, p), summed exactly term by term; 1 where k is over the mean, where no bound can hold."""
    zero = F.struct((n * math.log1p(-p)).alias("log"), F.exp(n * math.log1p(-p)).alias("sum"))

    def more(a: Column, i: Column) -> Column:
        log = a["log"] + F.log((n - i + 1) / i) + math.log(p) - math.log1p(-p)
        return F.struct(log.alias("log"), (a["sum"] + F.exp(log)).alias("sum"))

    steps = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<long>"))
    return F.when(k > n * p, F.lit(1.0)).otherwise(F.aggregate(steps, zero, more, lambda a: a["sum"]))


def select_cutoffs(holdout: DataFrame, *, rules: tuple[Rule, ...] = RULES, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """holdout (stratum: string, quality: 0 or 1, and the rules' measures) -> (stratum, rule, cutoff, n_good, n_rejected, p_value): the cutoffs of
    rules that reject good documents of the stratum in at most a share of alpha, all rules together.

    The null hypothesis of a cutoff is that its rule rejects more than alpha / rules of the stratum's good documents; its p-value is the exact
    binomial probability of as few rejected as there are in the holdout. A rule's cutoffs are tested from the most lenient to the strictest, up
    to the first that fails at delta / (rules * strata): the fixed order needs no further correction within a rule, and the division is
    Bonferroni's over rules and strata. So with probability 1 - delta all cutoffs that pass keep their promise together, and any of them may
    be taken: that which rejects the largest share of bad documents beyond its share of good ones, the more lenient of equal ones, none if no
    cutoff rejects more of the bad. A stratum with few good documents passes no cutoff, and nothing is rejected there.

    Rows are counted by stratum, rule and the first cutoff that rejects them, so what the windows see is strata * rules * cutoffs rows. Rows
    with a null stratum or quality do not count; an empty holdout selects nothing.
    """
    known = holdout.where("stratum is not null and quality is not null")
    level = lambda r: F.size(F.filter(F.lit(list(r.cutoffs)), lambda c: F.expr(r.value.format(div="div")) <= c))
    each = known.select("stratum", (F.col("quality") == 1).alias("good"), F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), level(r).alias("level")) for r in rules])).alias("x"))
    counted = each.groupBy("stratum", "x.rule", "x.level").agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad"))
    grid = F.create_map(*[x for r in rules for x in (F.lit(r.name), F.lit(list(r.cutoffs)))])
    # A row for each cutoff, which rejects all whose first rejecting cutoff it is or comes after.
    strata = counted.groupBy("stratum", "rule").agg(F.sum("good").alias("n_good"), F.sum("bad").alias("n_bad"), F.collect_list(F.struct("level", "good", "bad")).alias("levels"))  # a level for each cutoff and 0
    steps = strata.select("*", F.posexplode(F.element_at(grid, F.col("rule"))).alias("step", "cutoff"))
    reached = lambda what: F.aggregate("levels", F.lit(0).cast("long"), lambda a, x: a + F.when(x["level"] <= F.col("step"), x[what]).otherwise(0))
    tested = steps.select("stratum", "rule", "step", "cutoff", "n_good", "n_bad", reached("good").alias("n_rejected"), reached("bad").alias("bad_rejected"))
    n_strata = strata.agg(F.count_distinct("stratum")).first()[0]
    limit = delta / (len(rules) * max(n_strata, 1))
    tested = tested.withColumn("p_value", _tail(F.col("n_rejected"), F.col("n_good"), alpha / len(rules)))
    so_far = Window.partitionBy("stratum", "rule").orderBy("step")
    passed = tested.withColumn("passes", F.min(F.col("p_value") <= limit).over(so_far)).where("passes")
    # Whole numbers, so that equal gains are equal.
    gain = F.col("bad_rejected") * F.col("n_good") - F.col("n_rejected") * F.col("n_bad")
    best = Window.partitionBy("stratum", "rule").orderBy(gain.desc(), "step")
    return passed.withColumn("place", F.row_number().over(best)).where((F.col("place") == 1) & (gain > 0)).select("stratum", "rule", "cutoff", "n_good", "n_rejected", "p_value")


def judged(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang", rules: tuple[Rule, ...] = RULES, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """docs -> (id_col, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, base_failed, failed_rules, kept), a row for each row.

    base_failed: under 10 words, or over 20 % of the words in repeated windows. kept is false if that holds, or if the value of a rule is over the
    cutoff that select_cutoffs gives for the row's stratum; failed_rules lists these rules, joined by commas. The holdout are the rows with a
    label (labels: doc_id, quality) that do not fail the base; an id that is labelled more than once is good if one of its labels is. Whether
    a label says good is all that is used of it, for cutoffs only.

    Texts are read once and only their measures are written and joined. Strata are of any number: those with a thousandth of all rows get their
    cutoffs by broadcast, the others by a join. A null stratum is one of its own. Null and empty texts fail the base; rows with a null id
    have no label; repeated rows are judged alike, and count as often as they are there; without labels only the base rejects; an empty table gives no rows;
    other columns of docs, of any name, do not matter.
    """
    col = lambda name: F.col(f"`{name}`")
    stratum = F.coalesce(F.concat(F.lit("="), col(stratum_col).cast("string")), F.lit("-"))
    own = docs.select(col(id_col).alias("i"), stratum.alias("stratum"), col(text_col).alias("t"))
    seen = written(measured(own, text_col="t").drop("t").withColumn("base_failed", F.expr(BASE_FAILED)), "measured")
    known = labels.where("quality is not null").groupBy(F.col("doc_id").alias("i")).agg(F.max("quality").alias("quality"))
    chosen = select_cutoffs(seen.where("not base_failed").join(known, "i"), rules=rules, alpha=alpha, delta=delta)
    per = chosen.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs"))  # one of each rule
    sizes = seen.groupBy("stratum").agg(F.count(F.lit(1)).alias("rows"))
    met = joined(seen, written(sizes.join(per, "stratum", "left"), "cutoffs"), "stratum")
    over = [F.when(F.expr(r.value.format(div="div")) > F.element_at("cutoffs", F.lit(r.name)), F.lit(r.name)) for r in rules]
    failed = met.withColumn("failed_rules", F.concat_ws(",", *over))
    measures = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
    return failed.select(F.col("i").alias(id_col), *measures, "base_failed", "failed_rules", (~F.col("base_failed") & (F.col("failed_rules") == "")).alias("kept"))
