"""Lexical search, quality rules and the Merkle manifest against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulseframe.llm import lexical, merkle, quality, queries
from pulseframe.llm.common import UPPER

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, i long, pos long, hash string, stratum string, ids string"


def lower(text):
    return (text or "").translate(str.maketrans(UPPER, UPPER.lower()))


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls everywhere, empty and long texts, repeated rows and ids, a hot source, and columns whose names the operators use."""
    rng = random.Random(5)
    words = [f"w{k}" for k in range(60)] + ["Éa", "ñ", "a-b", "don't", "x_y", "\x0b", "日本"]
    rows = [(1, None, "a"), (2, "", "a"), (3, "  \n ", None), (None, "Some w1 Text", "a"), (None, None, "b"), (4, "w1 w1 w2", "b"), (5, "W1 w1 W2", "b"), (5, "W1 w1 W2", "b"), (5, "w3", "b"), (6, "x " * 20_000, ""), (7, "lone", "only")]
    rows += [(100 + k, " ".join(rng.choices(words, k=rng.randint(1, 60))), "hot") for k in range(300)]
    rows += [(1000 + k, "w5 W6 same in all of these", f"s{k}") for k in range(40)]
    rows += [(2000 + k, f"w7 {k % 3}", "hot") for k in range(90)]
    return spark.createDataFrame([(i, t, None if k % 5 == 0 else "en", s, None if k % 7 == 0 else len(t or ""), 1, 2, "h", "s", "x") for k, (i, t, s) in enumerate(rows)], SCHEMA)


# ---- lexical search


def ranked(docs, items, k=20):
    """docs, items: lists of (id, text) -> the ranks by the formula, one document after the other."""
    term = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    bags = [(i, Counter(term.findall(lower(t)))) for i, t in docs]
    bags = [(i, b, sum(b.values())) for i, b in bags if b]
    n, length = len(bags), sum(x[2] for x in bags)
    df = Counter(w for _, b, _ in bags for w in b)
    out = []
    for item, text in items:
        scores = []
        for at, (i, bag, size) in enumerate(bags):
            m = 75 + 25 * size * n // length
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * (10**9 * bag[w] // (1000 * bag[w] + 12 * m)) for w in term.findall(lower(text)) if bag[w])
            if s > 0:
                scores.append((-s, i is None, i or 0, at, i))
        out += [(item, r, x[4], -x[0]) for r, x in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


ITEMS = [(1, "w1 w2 w2 Éa"), (2, None), (3, "nothing here"), (4, "W7 same"), (5, "日本 ñ don't w3 w3 w3"), (5, "w5"), (6, ""), (7, "x"), (8, " ".join(f"w{k}" for k in range(60)))]


@pytest.mark.parametrize("block_terms", [10_000, 20])  # the second: several blocks
def test_search(spark, odd, block_terms):
    items = spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id long, text string, score string")
    got = lexical.search(odd, items, block_terms=block_terms)
    rows = sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in got.collect()), key=repr)
    assert rows == ranked([(r.doc_id, r.text) for r in odd.collect()], ITEMS)
    assert [(f.name, f.dataType.simpleString()) for f in got.schema.fields] == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]


def test_search_of_empty_tables(spark, odd):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert lexical.search(odd.limit(0), items).count() == 0
    assert lexical.search(odd, items.limit(0)).count() == 0
    assert lexical.search(odd, items.where("text is null or text = ''")).count() == 0


def test_scores_come_in_parts(monkeypatch):
    """However few products are worked out at once, the sums are those of a loop."""
    rng = np.random.default_rng(1)
    items = [Counter({b"%d" % w: int(rng.integers(1, 4)) for w in rng.choice(30, 8, replace=False)}) for _ in range(7)]
    words = {b"%d" % k: k for k in range(30)}
    weights = rng.integers(0, 9000, 30)
    ids = [np.sort(rng.choice(30, rng.integers(1, 12), replace=False)) for _ in range(40)]
    tfs = [rng.integers(1, 50, len(x)) for x in ids]
    m = rng.integers(75, 300, 40)
    slow = [[sum(items[k][b"%d" % t] * int(weights[t]) * (10**9 * int(f) // (1000 * int(f) + 12 * int(m[r]))) for t, f in zip(ids[r], tfs[r], strict=True)) for k in range(7)] for r in range(40)]
    for at_once in (1, 13, 10**6):
        monkeypatch.setattr(lexical, "AT_ONCE", at_once)
        assert lexical.Postings(items, words, weights).scores(ids, tfs, m).tolist() == slow


# ---- quality rules


def slow_measures(text):
    text = text or ""
    words = [w for w in re.split(r"[ \t-\r]+", text) if w]
    lines = [x for x in text.split("\n") if re.search(r"[^ \t-\r]", x)]
    windows = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
    covered = {k + j for k in range(len(words) - 4) if windows[tuple(words[k : k + 5])] > 1 for j in range(5)}
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines), len(lines) - len(set(lines)), len(covered)


def test_measures(spark, odd):
    rng = random.Random(2)
    texts = [None, "", "a", "a b c d e", "a b c d e a b c d e", "a a a a a a a", "a\nb\n\n a\na\nb\n \t\n", "# é$% |日本| <x>", "a\x0bb\x0cc\rd\x1ce f g h", "\n\n"]
    texts += [" ".join(rng.choices("ab cd ef\ngh".split(" "), k=rng.randint(1, 90))) for _ in range(60)]
    texts += ["v " * 30_000, " ".join(f"u{k % 7000}" for k in range(20_000))]
    docs = spark.createDataFrame([(k, t, "old", "w") for k, t in enumerate(texts)], "k long, text string, n_words string, words string")
    names = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
    for r in [*quality.measured(docs).collect(), *quality.measured(odd).collect()]:
        assert tuple(r[c] for c in names) == slow_measures(r.text), r.text[:100]


def test_tail_is_the_binomial(spark):
    cases = [(0, 700, 0.0125), (3, 700, 0.0125), (12, 1000, 0.0125), (13, 1000, 0.0125), (0, 0, 0.1), (900, 100_000, 0.01)]
    df = spark.createDataFrame([c[:2] for c in cases], "k long, n long")
    for k, n, p in cases:
        got = df.where(f"k = {k} and n = {n}").select(quality._tail(F.col("k"), F.col("n"), p)).first()[0]
        exact = 1.0 if k > n * p else sum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)) for i in range(k + 1))
        assert got == pytest.approx(exact, rel=1e-9)


RULES = (quality.Rule("a", "n_symbols", (90, 70, 50, 30, 10)), quality.Rule("b", "n_lines", (90, 50, 10)))


def slow_cutoffs(rows, rules, alpha, delta):
    strata = sorted({r[0] for r in rows})
    out = set()
    for s in strata:
        for rule, at in zip(rules, (2, 3), strict=True):
            good, bad = [r[at] for r in rows if r[0] == s and r[1] == 1], [r[at] for r in rows if r[0] == s and r[1] == 0]
            best = (0, None)
            for c in rule.cutoffs:
                k, kb, p, n = sum(v > c for v in good), sum(v > c for v in bad), alpha / len(rules), len(good)
                tail = 1 if k > n * p else sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
                if tail > delta / (len(rules) * len(strata)):
                    break
                gain = kb * len(good) - k * len(bad)
                if gain > best[0]:
                    best = (gain, c)
            if best[1] is not None:
                out.add((s, rule.name, best[1]))
    return out


def test_cutoffs(spark):
    rng = random.Random(8)
    rows = [("x", 1, int(rng.betavariate(1, 9) * 100), int(rng.betavariate(1, 20) * 100)) for _ in range(900)] + [("x", 0, rng.randint(0, 100), rng.randint(0, 12)) for _ in range(200)]
    rows += [("y", 1, rng.randint(0, 40), 5) for _ in range(400)] + [("y", 0, rng.randint(0, 100), 5) for _ in range(90)] + [("z", 1, 3, 3)] * 20 + [("z", 0, 99, 99)] * 20 + [("w", 0, 99, 99)] * 20
    df = spark.createDataFrame([*rows, (None, 1, 99, 99), ("x", None, 99, 99)], "stratum string, quality int, n_symbols long, n_lines long")
    for alpha in (0.05, 0.2):
        got = {(r.stratum, r.rule, r.cutoff) for r in quality.select_cutoffs(df, rules=RULES, alpha=alpha, delta=0.1).collect()}
        assert got == slow_cutoffs(rows, RULES, alpha, 0.1) and got
    assert quality.select_cutoffs(df.limit(0), rules=RULES).count() == 0


def test_promise_is_kept(spark):
    """Strata whose good documents are rejected by a cutoff in just more than alpha: hardly ever is that cutoff selected."""
    rng = random.Random(4)
    rule = (quality.Rule("a", "n_symbols", (50,)),)
    rows = [(f"s{k}", 1, 60 if rng.random() < 0.11 else 0) for k in range(60) for _ in range(250)] + [(f"s{k}", 0, 60) for k in range(60) for _ in range(5)]
    df = spark.createDataFrame(rows, "stratum string, quality int, n_symbols long")
    assert quality.select_cutoffs(df, rules=rule, alpha=0.1, delta=0.1).count() == 0
    assert quality.select_cutoffs(df, rules=rule, alpha=0.4, delta=0.1).count() == 60


def test_judged(spark, odd):
    """Base failures by brute force; a rule rejects bad documents and few good ones; odd labels count as stated."""
    rng = random.Random(6)
    good = [(10_000 + k, " ".join(f"w{rng.randint(0, 999)}" for _ in range(40)), "en") for k in range(1200)]
    bad = [(20_000 + k, " ".join(f"w{rng.randint(0, 999)}%%" for _ in range(40)), "en") for k in range(300)]
    more = spark.createDataFrame([(i, t, s, None, None, 1, 2, "h", "s", "x") for i, t, s in good + bad], SCHEMA)
    labels = spark.createDataFrame([(i, 1, 0) for i, _, _ in good] + [(i, 0, 0) for i, _, _ in bad[:200]] + [(None, 1, 0), (10_000, 0, 1), (77, None, 0)], "doc_id long, quality int, toxic int")
    docs = odd.unionByName(more)
    got = quality.judged(docs, labels).collect()
    assert len(got) == docs.count()
    texts = defaultdict(list)
    for r in docs.collect():
        texts[r.doc_id].append(slow_measures(r.text))
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_lines, r.n_dup_lines, r.n_repeat_words) in texts[r.doc_id]
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert r.kept == (not r.base_failed and r.failed_rules == "")
    kept = {r.doc_id for r in got if r.kept}
    assert not kept & {i for i, _, _ in bad} and len(kept & {i for i, _, _ in good}) >= 1140
    assert quality.judged(docs.limit(0), labels).count() == 0
    assert {r.kept for r in quality.judged(more, labels.limit(0)).collect()} == {True}


def test_quality_has_no_python(odd, spark):
    labels = spark.createDataFrame([(100, 1)], "doc_id long, quality int")
    plan = quality.judged(odd, labels)._jdf.queryExecution().executedPlan().toString() + quality.measured(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


# ---- Merkle manifest


def slow_leaf(r, text):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r.doc_id, r.source, r.lang, r.n_chars, text)])


def slow_tree(nodes):
    """digests -> (root, siblings of each, level by level as (before, after))."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, p in enumerate(at):
            a = p // 16 * 16
            run = nodes[a : a + 16]
            paths[k].append((run[: p - a], run[p - a + 1 :]))
        at = [p // 16 for p in at]
        nodes = [h(*nodes[a : a + 16]) for a in range(0, len(nodes), 16)]
    return nodes[0], paths


def slow_manifest(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r.source].append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        groups[s].sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, slow_leaf(r, r.text)))
        trees[s] = slow_tree([slow_leaf(r, r.text) for r in groups[s]])
    root, upper = slow_tree([trees[s][0] for s in names])
    out = []
    for s, above in zip(names, upper, strict=True):
        for r, own in zip(groups[s], trees[s][1], strict=True):
            chosen = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0
            digest = slow_leaf(r, lower(r.text) if chosen and r.text is not None else r.text)
            for before, after in own + above:
                digest = h(*before, digest, *after)
            proof = h(*[x for before, after in own + above for x in before + after])
            out.append((r.doc_id, slow_leaf(r, r.text), trees[s][0], root, proof, digest, digest == root))
    return sorted(out, key=repr)


NAMES = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


@pytest.mark.parametrize("where", ["true", "source = 'only'", "source = 's1' or source = 's2'", "source is null or source = ''", "doc_id between 100 and 115", "doc_id between 100 and 116", "doc_id between 1000 and 1016"])
def test_manifest(odd, where):
    rows = odd.where(where)
    got = sorted([tuple(r[c] for c in NAMES) for r in merkle.verified(rows).collect()], key=repr)
    assert got == slow_manifest(rows.collect())


def test_manifest_of_many_and_of_none(spark, odd, monkeypatch):
    assert merkle.verified(odd.limit(0)).collect() == []
    monkeypatch.setattr(merkle, "RUNS", 2)  # many windows in one source
    many = spark.range(700).select(F.col("id").alias("doc_id"), F.concat(F.lit("Text "), F.col("id")).alias("text"), F.lit(None).cast("string").alias("lang"), F.lit("one").alias("source"), F.lit(3).alias("n_chars"))
    got = merkle.verified(many).collect()
    assert sorted([tuple(r[c] for c in NAMES) for r in got], key=repr) == slow_manifest(many.collect())
    assert 0 < sum(not r.verified for r in got) < 300


def test_changes_are_found(spark, odd):
    """A manifest written before and rows read later: every changed leaf folds to another root, every other one to the same."""
    found = merkle.manifest(odd.where("source = 'hot'"), also={"given": F.when(F.col("doc_id") % 3 == 0, F.sha2("text", 256)).otherwise(merkle.leaf([F.col(c) for c in merkle.FIELDS]))})
    for r in found.withColumn("folded", merkle.fold(F.col("given"), F.col("path"))).collect():
        assert (r.folded == r.root) == (r.doc_id % 3 != 0)


def test_sql(spark, sf_dir):
    import duckdb

    c = duckdb.connect()
    for name in ("documents", "benchmark", "labels"):
        c.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    for name in ("op11_lexical_search", "op12_quality_rules", "op13_merkle_manifest"):
        got, expected = queries.queries()[name](spark, sf_dir).toPandas(), c.execute(queries.oracle_sql()[name]).df()
        cells = lambda df: sorted(map(repr, df[sorted(df.columns)].astype(str).itertuples(index=False, name=None)))
        assert sorted(got.columns) == sorted(expected.columns) and cells(got) == cells(expected), name
