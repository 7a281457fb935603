"""Rejecting documents by a short list of rules learnt from labelled ones.

A rule is a conjunction of thresholds on whole numbers that describe a text (symbols a
thousand words, how many of them are distinct, how many words begin with a telling stem). The list is
learnt by sequential covering: a rule grows by the condition with the most information gain on
two thirds of the labelled rows, is pruned on the other third, and the rows it covers go; the
next rule grows on what is left, until none is precise enough. Only histograms of the labelled
rows by threshold reach the driver. What comes out is an ordered Spark conditional expression.
Everything is DataFrame operations, a text's words and windows as arrays of its own row.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmotion.llm.common import SEPARATORS, stored

WINDOW_WORDS = 8
LEAST_WORDS = 20
MOST_REPEATED = 30  # percent of the words
SYMBOLS = "#*$%&|<>"
LABELLED_ROWS = 40_000  # about so many labelled documents are learnt from, chosen by a hash
STEM_LETTERS = (4, 5, 6)
TELLING_STEMS = 64  # beginnings of words that are counted as a feature
LEAST_GAIN, LEAST_PURITY = 15.0, 0.9  # a telling stem's log-likelihood ratio, and its share of bad texts
LEAST_SHARE = 0.05  # of the most telling stem's ratio
CUTS = 16  # thresholds of a feature, even among the bad rows and among the good ones
MOST_RULES, MOST_CONDITIONS = 16, 4
LEAST_PRECISION = 0.8  # of a rule on rows it was not grown on
LEAST_COVER = 5

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = [
    "n_words", "chars_per_word", "symbols_per_word", "exclamations_per_word", "capitals", "digits",
    "distinct_words", "duplicate_lines", "repeated_words", "telling_words",
]


def _count(text: Column, characters: str) -> Column:
    return F.regexp_count(text, F.lit(f"[{characters}]"))


def _joined(column: str, step: int) -> Column:
    """Hashes of the pairs of hashes that stand `step` apart."""
    n = F.greatest(F.size(column) - step, F.lit(0))
    return F.zip_with(F.slice(column, 1, n), F.slice(column, step + 1, n), lambda a, b: F.xxhash64(a, b))


def base_measures(docs: DataFrame) -> DataFrame:
    """docs (with a text) and the BASE columns, all long; a null text has none of anything.

    Windows are told apart by 64-bit hashes of the hashes of their halves, quarters and words.
    """
    line = F.filter(F.split("text", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    long = lambda c: c.cast("long")
    rows = docs.withColumn("text", F.coalesce(F.col("text"), F.lit(""))).withColumns(
        {"__w": F.array_remove(F.split("text", SEPARATORS), ""), "__lines": line}
    )
    rows = rows.withColumns(
        {
            "n_words": long(F.size("__w")),
            "word_chars": long(F.length(F.array_join("__w", ""))),
            "n_symbols": long(_count(F.col("text"), SYMBOLS)),
            "n_dup_lines": long(F.size("__lines") - F.size(F.array_distinct("__lines"))),
            "__n_lines": long(F.size("__lines")),
            "__distinct": long(F.size(F.array_distinct("__w"))),
            "__win": F.transform("__w", lambda x: F.xxhash64(x)),
        }
    ).drop("__w", "__lines")
    for step in (1, 2, 4):  # every column is used more than once, so Spark keeps the steps apart
        rows = rows.withColumn("__win", _joined("__win", step))
    # Most texts repeat no window; only the others are sorted to find which ones.
    again = F.size(F.array_distinct("__win")) < F.size("__win")
    entries = F.sort_array(F.transform("__win", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    rows = rows.withColumn("__s", F.when(again, entries)).drop("__win")
    same = lambda s, j: F.coalesce(F.get("__s", j)["x"] == s["x"], F.lit(False))
    twice = F.filter("__s", lambda s, i: same(s, i - 1) | same(s, i + 1))
    rows = rows.withColumn("__p", F.array_sort(F.transform(twice, lambda s: s["i"]))).drop("__s")
    covered = F.transform(
        "__p", lambda p, i: F.least(F.coalesce(F.get("__p", i + 1) - p, F.lit(WINDOW_WORDS)), F.lit(WINDOW_WORDS))
    )
    total = F.aggregate(covered, F.lit(0), lambda a, x: a + x)
    return rows.withColumn("n_repeat_words", long(F.coalesce(total, F.lit(0)))).drop("__p")


def base_failed() -> Column:
    """Too few words, or too many of them in windows that occur twice or more."""
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def _plain_words(text: Column) -> Column:
    """Lower-cased runs of letters; some may be empty."""
    return F.split(F.lower(text), "[^\\p{L}]+")


def _stems(words: str) -> Column:
    """The beginnings of STEM_LETTERS letters of the words that have so many."""
    cut = lambda n: F.transform(F.filter(words, lambda x: F.length(x) >= n), lambda x: F.left(x, F.lit(n)))
    return F.concat(*[cut(n) for n in STEM_LETTERS])


def with_features(rows: DataFrame, telling: list[str]) -> DataFrame:
    """The FEATURES of rows that have their base measures; shares are in thousandths."""
    per = lambda n, of: F.floor(1000 * n / F.greatest(of, F.lit(1))).cast("long")
    words, found = F.col("n_words"), F.lit(0)
    if telling:
        found = F.regexp_count(F.lower("text"), F.lit(f"(?<!\\p{{L}})(?:{'|'.join(telling)})"))
    return rows.withColumns(
        {
            "chars_per_word": per(F.col("word_chars"), words),
            "symbols_per_word": per(F.col("n_symbols"), words),
            "exclamations_per_word": per(_count(F.col("text"), "!"), words),
            "capitals": per(_count(F.col("text"), "A-Z"), F.col("word_chars")),
            "digits": per(_count(F.col("text"), "0-9"), F.col("word_chars")),
            "distinct_words": per(F.col("__distinct"), words),
            "duplicate_lines": per(F.col("n_dup_lines"), F.col("__n_lines")),
            "repeated_words": per(F.col("n_repeat_words"), words),
            "telling_words": found.cast("long"),
        }
    ).drop("__distinct", "__n_lines")


@dataclass(frozen=True)
class Condition:
    feature: str
    least: bool  # value >= cut, else value < cut
    cut: int

    def column(self) -> Column:
        return F.col(self.feature) >= self.cut if self.least else F.col(self.feature) < self.cut

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.least else '<'} {self.cut}"


@dataclass(frozen=True)
class DecisionList:
    """Rules in order, each a conjunction that rejects; a document no rule meets is kept."""

    rules: tuple[tuple[Condition, ...], ...] = ()
    telling: tuple[str, ...] = ()

    def first_rule(self) -> Column:
        """Number of the first rule that holds, from 1; null, if none does."""
        chosen = F.lit(None).cast("int")
        for n, rule in reversed(list(enumerate(self.rules, 1))):
            chosen = F.when(_all(rule), F.lit(n)).otherwise(chosen)
        return chosen

    def __str__(self) -> str:
        return "\n".join(f"{n}. reject if " + " and ".join(map(str, r)) for n, r in enumerate(self.rules, 1))


def _all(rule) -> Column:
    out = F.lit(True)
    for condition in rule:
        out = out & condition.column()
    return out


def labelled_rows(docs: DataFrame, labels: DataFrame, most: int = LABELLED_ROWS) -> DataFrame:
    """Base measures of distinct labelled texts that pass the base rules: text, bad, grow and measures.

    A text is bad if a label of its document says toxic 1 or quality 0. Of more than `most` labels
    about that many are taken, chosen by a hash of the id, so that they may be broadcast.
    """
    said = labels.select(F.col("doc_id").cast("long").alias("__id"), "quality", "toxic").where("__id IS NOT NULL")
    bad = (F.coalesce(F.col("toxic"), F.lit(0)) == 1) | (F.coalesce(F.col("quality"), F.lit(1)) == 0)
    said = said.where("quality IS NOT NULL OR toxic IS NOT NULL").groupBy("__id").agg(F.max(bad).alias("__bad"))
    share = min(1.0, most / max(1, labels.count()))
    slot = F.pmod(F.xxhash64("__id"), F.lit(1_000_000))
    said = said.where(slot < int(share * 1_000_000))
    rows = docs.select("doc_id", "text").join(F.broadcast(said), F.col("doc_id") == F.col("__id"))  # about `most` rows
    texts = rows.groupBy(F.coalesce("text", F.lit("")).alias("text")).agg(F.max("__bad").alias("bad"))
    # Stored before the filter, which Spark would else push down and compute the measures in.
    measured = stored(base_measures(texts).withColumn("grow", F.pmod(F.xxhash64("text"), F.lit(3)) > 0), "labelled")
    return measured.where(~base_failed())


def telling_stems(sample: DataFrame, most: int = TELLING_STEMS) -> list[str]:
    """Beginnings of words that stand in bad texts far more often than in good ones, the most telling first."""
    grown = sample.where("grow")
    bad, good = grown.agg(F.sum(F.col("bad").cast("long")), F.sum((~F.col("bad")).cast("long"))).first()
    if not bad or not good:
        return []
    words = grown.select("bad", F.array_distinct(_plain_words(F.col("text"))).alias("w"))
    counts = words.select("bad", F.explode(F.array_distinct(_stems("w"))).alias("stem")).groupBy("stem").agg(
        F.sum(F.col("bad").cast("long")).alias("p"), F.sum((~F.col("bad")).cast("long")).alias("n")
    )
    counts = counts.where(F.col("p") >= LEAST_PURITY * (F.col("p") + F.col("n")))
    both, share = F.col("p") + F.col("n"), bad / (bad + good)
    part = lambda c, s: F.when(c > 0, c * F.ln(c / (both * s))).otherwise(0.0)
    gain = F.round(2 * (part(F.col("p"), share) + part(F.col("n"), 1 - share)), 6)
    best = counts.withColumn("gain", gain).where(F.col("gain") >= LEAST_GAIN)
    found = [(r["stem"], r["gain"]) for r in best.orderBy(F.desc("gain"), F.length("stem"), "stem").limit(3 * most).collect()]
    found = [x for x, gain in found if gain >= LEAST_SHARE * found[0][1]]
    # A longer stem says nothing beside its own beginning.
    short = [x for i, x in enumerate(found) if not any(x.startswith(y) for y in found[:i])]
    return short[:most]


def _cuts(sample: DataFrame) -> dict[str, list[int]]:
    """Thresholds of each feature: values that part the bad rows, and the good ones, evenly."""
    shares = [(i + 0.5) / CUTS for i in range(CUTS)]
    found = sample.groupBy("bad").agg(*[F.percentile_approx(f, shares, 10_000).alias(f) for f in FEATURES]).collect()
    out = {}
    for f in FEATURES:
        values = {v for r in found for v in r[f] or []}
        out[f] = sorted(values | {v + 1 for v in values})  # v < cut and v >= cut tell a value from both neighbours
    return out


def _bin(feature: str, cuts: list[int]) -> Column:
    """How many of the ascending cuts a value reaches."""
    return F.size(F.filter(F.array(*map(F.lit, cuts)).cast("array<bigint>"), lambda c: c <= F.col(feature)))


def _histogram(rows: DataFrame) -> dict:
    """{(feature, bin): [good, bad]} of the rows; bins lie between cuts."""
    entries = F.array(*[F.col(f"__bin{i}") for i in range(len(FEATURES))])
    counts = rows.select("bad", F.posexplode(entries).alias("f", "bin")).groupBy("f", "bin", "bad").count().collect()
    out: dict = {}
    for r in counts:  # at most FEATURES x cuts x 2 rows
        out.setdefault((r["f"], r["bin"]), [0, 0])[int(r["bad"])] += r["count"]
    return out


def _best_condition(counts: dict, cuts: dict[str, list[int]]) -> tuple[Condition | None, int, int]:
    """The condition of most information gain, with the bad and good rows that meet it."""
    first = [v for (f, _), v in counts.items() if f == 0]
    bad, good = sum(v[1] for v in first), sum(v[0] for v in first)
    best = (1e-9, None, bad, good)
    if not bad:
        return None, 0, good
    for i, f in enumerate(FEATURES):
        low = [0, 0]
        for k, cut in enumerate(cuts[f]):
            below = counts.get((i, k), (0, 0))
            low = [low[0] + below[0], low[1] + below[1]]
            for least, p, n in ((True, bad - low[1], good - low[0]), (False, low[1], low[0])):
                if p < LEAST_COVER or (p == bad and n == good):
                    continue
                gain = p * (log2(p / (p + n)) - log2(bad / (bad + good)))
                if gain > best[0] + 1e-9:
                    best = (gain, Condition(f, least, cut), p, n)
    return best[1:]


def learn(sample: DataFrame) -> DecisionList:
    """The decision list of labelled rows that have their base measures (see `labelled_rows`)."""
    telling = telling_stems(sample)
    rows = with_features(sample, telling).select("bad", "grow", *FEATURES)
    cuts = _cuts(rows)
    bins = {f"__bin{i}": _bin(f, cuts[f]) for i, f in enumerate(FEATURES)}
    left = stored(rows.withColumns(bins), "learnt-from")
    rules: list[tuple[Condition, ...]] = []
    while len(rules) < MOST_RULES:
        rule: list[Condition] = []
        while len(rule) < MOST_CONDITIONS:
            counts = _histogram(left.where(F.col("grow") & _all(rule)))
            condition, _, good = _best_condition(counts, cuts)
            if condition is None:
                break
            rule.append(condition)
            if not good:
                break
        if not rule:
            break
        held = left.where(~F.col("grow"))
        sums = [F.sum((_all(rule[: k + 1]) & (F.col("bad") == F.lit(b))).cast("long")) for k in range(len(rule)) for b in (True, False)]
        found = [v or 0 for v in held.agg(*sums).first()]
        judged = [(found[2 * k], found[2 * k + 1]) for k in range(len(rule))]
        worth = [(p - n) / (p + n) if p + n else -1.0 for p, n in judged]
        keep = worth.index(max(worth))
        p, n = judged[keep]
        if p < 1 or p / (p + n) < LEAST_PRECISION:
            break
        rules.append(tuple(rule[: keep + 1]))
        left = left.where(~_all(rules[-1]))
    return DecisionList(tuple(rules), tuple(telling))


def screened(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, DecisionList]:
    """(docs with the BASE columns, base_failed, rule and kept; the list learnt from the labels)."""
    chosen = learn(labelled_rows(docs, labels))
    rows = with_features(base_measures(docs), list(chosen.telling)).withColumn("base_failed", base_failed())
    rows = rows.withColumn("rule", F.when(~F.col("base_failed"), chosen.first_rule()))
    return rows.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull()), chosen


def judged_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every row of docs (doc_id, text) with its measures and verdict by base rules and learnt list.

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept
    and rule (the number of the learnt rule that rejects, else null). A null or empty text has no
    words and fails the base rules; a null doc_id is kept and has no label; repeated rows stay and
    are judged alike; texts are taken whole, whatever their length; equal gains go to the feature
    and threshold that stand first. Without labels of both kinds the list is empty. Other columns
    are ignored; an empty table gives an empty result.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows, _ = screened(slim, labels)
    return rows.select("doc_id", *BASE, "base_failed", "kept", "rule")
