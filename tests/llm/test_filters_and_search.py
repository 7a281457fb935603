"""Rules, lexical search and the filter audit: against brute force, and on odd tables."""

import math
import random
import re
from collections import Counter
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from gridmotion.llm import interactions, lexical, queries, rules

CLASH = ["rule", "row", "part", "n", "m", "piece", "kept", "n_words", "telling_words", "term", "item", "digest", "bad"]
WORDS = [f"wort{i}" for i in range(300)]


def prose(n, seed):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(n))


ODD = [None, "", "  \n\t ", "one", "Two Words", prose(300, 1), prose(300, 1), prose(20_000, 2), "ß Ünï " * 40, "\x1c x\x1fy #| !!",
       "same line here\nother\nsame line here\n\n\nsame line here", "a b c d e f g h i " * 30, prose(9, 4) * 2, "X" * 50 + " 1 2 3"]


@pytest.fixture
def odd(documents):
    return documents([*enumerate(ODD), (None, "no id here"), (5, prose(300, 1)), (3, "same id, other text")], CLASH)


def words_of(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def base_of(text):
    words = words_of(text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if words_of(x)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)
    )


# ------------------------------------------------------------------ learnt rules


def test_base_measures(odd, spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = rules.judged_documents(odd, none).collect()
    texts = Counter(r["text"] for r in odd.collect())
    assert len(rows) == sum(texts.values())
    got = Counter((*(r[c] for c in rules.BASE), r["base_failed"], r["kept"], r["rule"]) for r in rows)
    want = Counter()
    for text, times in texts.items():
        base = base_of(text)
        failed = base[0] < 20 or 100 * base[4] > 30 * base[0]
        want[(*base, failed, not failed, None)] += times
    assert got == want
    assert rules.judged_documents(odd.limit(0), none).collect() == []


def test_base_measures_of_the_small_table(spark, sf_dir):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.op11_rules(spark, sf_dir).collect()
    assert {r["doc_id"]: tuple(r[c] for c in rules.BASE) for r in rows} == {d: base_of(t) for d, t in docs.items()}
    for r in rows:
        failed = r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"]
        assert r["base_failed"] == failed and r["kept"] == (not failed and r["rule"] is None)
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    good = [r for r in rows if r["doc_id"] in labels and labels[r["doc_id"]]["quality"] == 1 and not labels[r["doc_id"]]["toxic"] and not r["base_failed"]]
    assert sum(r["kept"] for r in good) >= 0.97 * len(good)


@pytest.fixture
def marked(spark):
    """Good prose, and two kinds of bad texts: hostile words, symbols after words."""
    rng, rows = random.Random(5), []
    for i in range(600):
        own = [rng.choice(WORDS) for _ in range(rng.randint(40, 120))]
        kind = i % 6
        if kind == 0:
            own[10], own[20] = "grumbold", "Grumbolder!"
        elif kind == 1:
            own = [w + rng.choice(["###", "|", "$"]) for w in own]
        rows.append((i, " ".join(own), kind))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(k != 1), int(k == 0)) for i, _, k in rows if i % 2 or i % 3 == 0], "doc_id long, quality int, toxic int")
    return docs, labels, {i: k > 1 for i, _, k in rows}


def test_learnt_list_judges_rows_it_has_not_seen(marked):
    docs, labels, good = marked
    rows, chosen = rules.screened(docs, labels)
    got = {r["doc_id"]: r["kept"] for r in rows.select("doc_id", "kept").collect()}
    assert sum(got[d] == good[d] for d in good) >= 0.99 * len(good)
    assert "grum" in chosen.telling and len(chosen.rules) == 2
    assert all(len(rule) <= rules.MOST_CONDITIONS for rule in chosen.rules)


def test_list_is_the_greedy_cover(spark):
    """The first grown condition has the most gain of all thresholds, counted one by one."""
    rng = random.Random(9)
    values = [{f: rng.randint(0, 30) for f in rules.FEATURES} for _ in range(300)]
    bad = [v["digits"] > 20 and v["capitals"] < 12 or rng.random() < 0.05 for v in values]
    cuts = {f: list(range(0, 32, 3)) for f in rules.FEATURES}
    counts = {}
    for v, b in zip(values, bad):
        for i, f in enumerate(rules.FEATURES):
            place = sum(c <= v[f] for c in cuts[f])
            counts.setdefault((i, place), [0, 0])[int(b)] += 1
    condition, p, n = rules._best_condition(counts, cuts)
    all_bad, best = sum(bad), -1.0
    for f in rules.FEATURES:
        for cut in cuts[f]:
            for least in (True, False):
                hit = [b for v, b in zip(values, bad) if (v[f] >= cut) == least]
                if sum(hit) >= rules.LEAST_COVER and len(hit) < len(values):
                    gain = sum(hit) * (math.log2(sum(hit) / len(hit)) - math.log2(all_bad / len(bad)))
                    best = max(best, gain)
    mine = p * (math.log2(p / (p + n)) - math.log2(all_bad / len(bad)))
    assert math.isclose(mine, best) and condition.feature in ("digits", "capitals")


def test_expression_is_the_list(spark):
    chosen = rules.DecisionList(
        ((rules.Condition("digits", True, 5), rules.Condition("capitals", False, 3)), (rules.Condition("n_words", False, 10),))
    )
    rows = [(d, c, w) for d in (4, 5) for c in (2, 3) for w in (9, 10)]
    got = spark.createDataFrame(rows, "digits long, capitals long, n_words long").select("*", chosen.first_rule().alias("r")).collect()
    assert {tuple(r)[:3]: r["r"] for r in got} == {r: 1 if r[0] >= 5 and r[1] < 3 else 2 if r[2] < 10 else None for r in rows}
    assert str(chosen) == "1. reject if digits >= 5 and capitals < 3\n2. reject if n_words < 10"


def test_labels_of_one_kind_teach_nothing(marked):
    docs, labels, _ = marked
    assert rules.screened(docs, labels.withColumns({"quality": F.lit(1), "toxic": F.lit(0)}))[1].rules == ()


def test_conflicting_and_odd_labels(spark, marked):
    docs, labels, _ = marked
    more = labels.union(spark.createDataFrame([(None, 0, 1), (10**9, 0, 0), (3, None, None)], labels.schema))
    assert rules.judged_documents(docs, more.union(more)).count() == docs.count()


# ------------------------------------------------------------------ lexical search


def terms(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", lowered)


def brute_search(docs, items, k=10):
    """[(item, rank, doc_id, score)]; docs and items are (id, text) rows."""
    held = [(d, Counter(own), len(own)) for d, t in docs if (own := terms(t))]
    n, total = len(held), sum(m for _, _, m in held)
    df = Counter(t for _, own, _ in held for t in own)
    asked = {}
    for item, text in set(items):
        asked.setdefault(item, Counter()).update(terms(text))
    out = []
    for item, own in asked.items():
        found = []
        for place, (doc, tf, size) in enumerate(held):
            m = 25 + (75 * size * n) // total
            score = sum(
                times * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 8 * m))
                for t, times in own.items()
                if t in tf
            )
            if score > 0:
                found.append((-score, doc is None, doc or 0, place))
        out += [(item, i + 1, None if none else doc, -s) for i, (s, none, doc, _) in enumerate(sorted(found)[:k])]
    return sorted(out, key=str)


ITEMS = [(0, prose(30, 1)), (1, "Two words, two WORDS"), (2, None), (3, "..."), (4, "ünï ß"), (None, "no id here"), (5, "wort1"), (5, "wort2 wort2"), (5, "wort1"),
         (6, prose(400, 8))]


@pytest.mark.parametrize("piece_rows,at_once", [(4096, 500_000), (7, 500_000), (4096, 25)])
def test_search(spark, odd, documents, monkeypatch, piece_rows, at_once):
    build = lexical.build_index
    monkeypatch.setattr(lexical, "build_index", lambda rows: build(rows, piece_rows))
    monkeypatch.setattr(lexical, "PAIRS_AT_ONCE", 50)
    more = [(100 + i, prose(20 + i % 4, 50 + i)) for i in range(150)] + [(300 + i, prose(40, 99)) for i in range(30)]
    docs = odd.union(documents(more, CLASH))
    items = spark.createDataFrame([(*i, "x") for i in ITEMS], "item_id long, text string, score string")
    got = sorted((tuple(r) for r in lexical.ranked_documents(docs, items, at_once=at_once).collect()), key=str)
    assert got == brute_search([(r["doc_id"], r["text"]) for r in docs.collect()], ITEMS)


def test_search_of_empty_tables(spark, odd):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert lexical.ranked_documents(odd.limit(0), items).collect() == []
    assert lexical.ranked_documents(odd, items.limit(0)).collect() == []


def test_bounds_hold():
    tf, m = lexical.np.arange(1, 50), 37
    assert (lexical.np.diff(lexical.impacts(tf, m)) > 0).all()


# ------------------------------------------------------------------ filter audit


def brute_audit(docs, labels):
    """{(part, order, step): counts}; docs are (doc_id, text, lang) rows, labels (doc_id, quality, toxic)."""
    judged = []
    for doc, text, lang in docs:
        words, text = words_of(text), text or ""
        failed = set()
        if len(words) < 200:
            failed.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            failed.add("B")
        if 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text):
            failed.add("C")
        if re.search("[#$%&*|]", text):
            failed.add("D")
        if doc is not None and any(d is not None and d < doc and (t or "") == text for d, t, _ in docs):
            failed.add("E")
        good = any(d is not None and d == doc and q == 1 for d, q, _ in labels)
        toxic = any(d is not None and d == doc and t == 1 for d, _, t in labels)
        judged.append((lang or "", failed, good, toxic))
    out, shapley = {}, Counter()
    for order in permutations("ABCDE"):
        for part in {j[0] for j in judged}:
            left = [j for j in judged if j[0] == part]
            whole = left
            for step, f in enumerate(order, 1):
                gone = [j for j in left if f in j[1]]
                left = [j for j in left if f not in j[1]]
                shapley[part, f] += len(gone)
                fails = sum(f in j[1] for j in whole)
                alone = sum(j[1] == {f} for j in whole)
                out[part, "".join(order), step] = (
                    len(left), len(gone), fails - len(gone), alone, sum(j[2] for j in gone), sum(j[3] for j in gone)
                )
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_audit(spark):
    rng = random.Random(3)
    texts = [*ODD, prose(300, 11) + " #", prose(250, 12).upper(), "a b " * 150, "a b " * 150 + "$"]
    rows = [(None if i % 17 == 0 else i % 40, rng.choice(texts), rng.choice(["en", "de", None, ""])) for i in range(90)]
    labels = [(i % 45 or None, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(60)]
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, lang string, part string, digest string")
    told = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("removed", F.lit(1))
    got = interactions.interaction_audit(docs.repartition(3), told).collect()
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in names) for r in got} == brute_audit(rows, labels)
    assert len(got) == 3 * 600 and spark.catalog.listTables() == []
    assert interactions.interaction_audit(docs.limit(0), told.limit(0)).collect() == []
