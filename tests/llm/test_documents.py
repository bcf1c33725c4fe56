"""Language ID, exact dedup, SimHash, packing and the pipeline against brute force."""

import random
import zlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pulseframe.llm import common, dedup, graph, langid, packing, queries, simhash
from pulseframe.llm.common import UPPER

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, p string, sha string, i long, kept string"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls everywhere, empty and long texts, repeated rows, and columns whose names the operators use."""
    rng = random.Random(3)
    words = [f"w{k}" for k in range(400)]
    base = [" ".join(rng.choices(words, k=120)) for _ in range(6)]
    rows = [(1, None), (2, ""), (3, "  \n "), (None, "Some Text"), (None, None), (4, "some text"), (5, "SOME TEXT"), (5, "SOME TEXT"), (6, "a"), (7, "ÀB"), (8, "àb"), (9, "Àb"), (10, "x " * 60_000), (11, "one two"), (12, "1234 !!")]
    rows += [(20 + k, t) for k, t in enumerate(base)] + [(40 + k, t.replace(" w1", " v1", 1)) for k, t in enumerate(base)]
    rows += [(100 + k, "Same Everywhere in the corpus") for k in range(50)]
    return spark.createDataFrame([(i, t, None if k % 5 == 0 else "en", None, None, "p", "s", 1, "x") for k, (i, t) in enumerate(rows)], SCHEMA)


def lower(text):
    return (text or "").translate(str.maketrans(UPPER, UPPER.lower()))


def test_exact_dedup(spark, odd):
    groups = defaultdict(list)
    for r in odd.collect():
        groups[lower(r.text)].append(r.doc_id)
    for most_hot in (10_000, 5):  # with 5, the group of 50 is hot and dealt to several ranges
        got = dedup.exact_dedup(odd, most_hot=most_hot, least_hot=5).collect()
        assert len(got) == odd.count()
        kept = Counter()
        for r in got:
            ids = groups[lower(r.text)]
            assert r.group_size == len(ids) and r.keep_id == max((i for i in ids if i is not None), default=None) and r.p == "p"
            kept[lower(r.text)] += r.kept
        assert set(kept.values()) == {1}
    assert dedup.exact_dedup(odd.limit(0)).count() == 0


def test_exact_dedup_shuffles_texts_once(odd):
    plan = dedup.exact_dedup(odd)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange rangepartitioning") == 1 and "Exchange hashpartitioning" not in plan and "Python" not in plan


def slow_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(rows):
    prints = [(r.doc_id, slow_print(r.text)) for r in rows]
    group = list(range(len(prints)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a][1] ^ prints[b][1]).bit_count() <= 2:
                group[find(a)] = find(b)
    low = {}
    for k, (i, _) in enumerate(prints):
        low[find(k)] = min((x for x in (i, low.get(find(k))) if x is not None), default=None)
    return sorted((str(i), f"{p:016x}", low[find(k)]) for k, (i, p) in enumerate(prints))


def test_simhash(spark, odd, sf_dir):
    for docs in (odd.where("doc_id <> 10 or doc_id is null"), spark.read.parquet(f"{sf_dir}/documents.parquet")):
        got = simhash.simhash_components(docs).collect()
        assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in got) == slow_components(docs.collect())
    assert simhash.simhash_components(odd.limit(0)).count() == 0


def test_links_of_crowded_cells(spark):
    """Clouds of prints at 1 to 4 bits around some centres: many share grid points."""
    rng = random.Random(5)
    prints = set()
    for _ in range(4):
        centre = rng.getrandbits(64)
        for _ in range(150):
            x = centre
            for b in rng.sample(range(64), rng.randint(0, 4)):
                x ^= 1 << b
            prints.add(x)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    got = {r.node: r.root for r in graph.components(simhash.links(spark.createDataFrame([(p,) for p in signed], "p long"))).collect()}
    group = {p: p for p in signed}

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in signed:
        for b in signed:
            if 0 < ((a ^ b) & (1 << 64) - 1).bit_count() <= 2 and find(a) != find(b):
                lo, hi = sorted((find(a), find(b)))
                group[hi] = lo
    assert {p: got.get(p, p) for p in signed} == {p: find(p) for p in signed}


def test_components_of_a_chain(spark):
    rng = random.Random(1)
    nodes = list(range(300))
    rng.shuffle(nodes)
    links = spark.createDataFrame(list(zip(nodes, nodes[1:])), "a long, b long")
    assert {r.root for r in graph.components(links).collect()} == {0}
    assert graph.components(links.limit(0)).count() == 0


def test_near_dedup_keeps_one_of_each(spark, odd):
    kept = simhash.near_dedup(odd).collect()
    found = {r.doc_id: r.component_id for r in simhash.simhash_components(odd).collect()}
    assert {r.doc_id for r in kept} == {x for x in found.values()}


def test_near_dedup_judges_rows_of_one_id_by_their_texts(spark):
    """Of an id's rows only those go that are copies of another's, and null ids count as larger than any."""
    a, b, c = ("alpha " * 30, "beta gamma " * 30, "delta epsilon zeta " * 30)
    rows = [(1, a), (5, a), (5, b), (7, c), (7, c), (None, b), (None, "eta theta " * 9), (8, None)]
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, ident string, p string")
    kept = simhash.near_dedup(docs).collect()
    assert sorted((str(r.doc_id), r.text) for r in kept) == sorted((str(i), t) for i, t in (rows[0], rows[2], rows[3], rows[4], rows[6], rows[7]))
    assert {(r.ident, r.p) for r in kept} == {("x", "y")} and simhash.near_dedup(docs.limit(0)).count() == 0


def test_joined_with_a_hot_key(spark):
    left = spark.range(5_000).select("id", F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id")).alias("k"))
    right = left.groupBy("k").agg(F.count(F.lit(1)).alias("rows"), F.max("id").alias("top"))
    for how, some in (("inner", right), ("left", right.where("k % 2 = 0"))):
        got = {(r.id, r.k, r.top) for r in common.joined(left, some, "k", how).collect()}
        assert got == {tuple(r) for r in left.join(some.drop("rows"), "k", how).select("id", "k", "top").collect()}
    assert common.joined(left, right.limit(0), "k", "left").where("top is null").count() == 5_000


def test_language_id(spark, odd):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = queries.language_id(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(got) == 1000 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.97 and all(0 <= r.score <= 1 for r in got)
    found = langid.identify(odd, langid.profiles(odd)).collect()
    assert all((r.lang_pred == "und") == (not any(map(str.isalpha, r.text or ""))) for r in found)
    assert langid.profiles(odd.limit(0)) == {} and {r.lang_pred for r in langid.identify(odd, {}).collect()} == {"und"}


def test_language_stage_finds_wrong_labels_of_each_language(spark):
    """Documents that are not learned from are declared as another language, the others as they are."""
    import corpus_pipeline as c

    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = ["de", "en", "es", "fr"]
    array, held = F.array(*map(F.lit, names)), langid.held_out(F.col("doc_id"))
    # Each language is followed by another one, by one, two or three places.
    turned = F.get(array, ((F.array_position(array, F.col("lang")) - 1 + 1 + F.col("doc_id") % 3) % 4).cast("int"))
    swapped = docs.withColumn("lang", F.when(held, turned).otherwise(F.col("lang")))
    kept = {r.doc_id for r in c.language(spark, swapped, sf).collect()}
    own = {r.doc_id: r for r in swapped.withColumn("held", held).where(F.col("text").rlike(r"\p{L}")).collect()}
    assert sum(i not in kept for i, r in own.items() if not r.held) <= 0.002 * len(own)
    for name in names:
        wrong = [i for i, r in own.items() if r.held and r.lang == name]
        assert len(wrong) > 10 and sum(i not in kept for i in wrong) >= 0.95 * len(wrong), name


def test_predictions_against_single_ngrams(spark):
    """Prototypes, cosines and predictions from loops over letters."""
    first, second, third = (v.astype(np.int64) for v in langid._vectors())
    classes = langid._classes()

    def vector(text):
        x = [0]
        for c in text or "":
            k = int(classes[ord(c)])
            if k or x[-1]:
                x.append(k)
        x += [0] if x[-1] else []
        return sum((first[a] * second[b] * third[c] for a, b, c in zip(x, x[1:], x[2:])), np.zeros(langid.DIM, np.int64))

    rows = [(1, "The cat sat on the mat", "en"), (2, "Der Hund liegt unter dem Tisch", "de"), (3, "the dog and the cat", "en"), (4, "Le chat est sur la table", "fr"), (5, "under the table", None), (6, "12 34", "en"), (7, None, "de"), (8, "liegt der Hund", "xx")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    known = langid.profiles(docs.where("doc_id <> 8"))
    sums = {lang: sum((vector(t) for _, t, l in rows if l == lang), np.zeros(langid.DIM, np.int64)) for lang in ("de", "en", "fr")}
    assert set(known) == set(sums) and all(np.allclose(known[k], v / np.linalg.norm(v), atol=1e-6) for k, v in sums.items())
    for r in langid.identify(docs, known).collect():
        v = vector(r.text)
        if not any(map(str.isalpha, r.text or "")):
            assert (r.lang_pred, r.score, r.cosines) == ("und", 0, [])
            continue
        cosines = {k: max(0.0, float(v @ s / np.linalg.norm(v) / np.linalg.norm(s))) for k, s in sums.items()}
        assert np.allclose(r.cosines, [cosines[k] for k in sorted(cosines)], atol=1e-5) and r.lang_pred == max(cosines, key=cosines.get)


def test_bundling_against_single_ngrams():
    text = "Über alle Gipfel, ist Ruh!"
    first, second, third = langid._vectors()
    x = [langid._classes()[ord(c)] for c in " über alle gipfel ist ruh "]
    expected = sum(first[a].astype(int) * second[b] * third[c] for a, b, c in zip(x, x[1:], x[2:], strict=False))
    assert (langid.bundled([langid.ngrams(text)])[0] == expected).all()


@settings(deadline=None, max_examples=300)
@given(st.one_of(st.text(max_size=60), st.text("aBé'sLl 9.<|endoftext>\n\x1cΣſİ", max_size=40)))
def test_encoder_is_the_tokenizer(text):
    own = packing.encoder(TOKENIZER).tokenizer.encode(text, add_special_tokens=False).ids
    assert packing.encoder(TOKENIZER)([text])[0] == np.array(own, "<u4").tobytes()


def test_encoder_asks_for_a_stem_once_and_forgets(monkeypatch):
    texts = ["gerlich, gerlich. (gerlich) it's gerlich!!", "", "漢 gerlich", "a1 b2, c3. d4; e5: f6 gerlich.,"]
    monkeypatch.setattr(packing, "REMEMBERED", 6)
    own = [np.array(packing.encoder(TOKENIZER).tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    encode, asked = packing.Encoder(TOKENIZER), []
    ids = encode._ids
    monkeypatch.setattr(encode, "_ids", lambda part: asked.append(part) or ids(part))
    assert encode(texts[:1]) == own[:1] and asked.count("gerlich") == 1
    for k in (1, 2, 3, 0):
        assert encode(texts[k : k + 1]) == own[k : k + 1]
    assert encode(texts) == own and encode([]) == []


@settings(deadline=None, max_examples=80)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 9)))
def test_plan(counts):
    found = packing.plan(counts, 40)
    places = defaultdict(list)
    for length, n in counts.items():
        for j in range(n):
            at = np.searchsorted(found.first[length], j, "right") - 1
            places[int(found.sequence[length][at] + j - found.first[length][at])].append((int(found.offset[length][at]), length))
    assert set(places) == set(range(found.sequences))
    for own in places.values():
        own.sort()
        assert own[0][0] == 0 and all(a[0] + a[1] == b[0] for a, b in zip(own, own[1:])) and own[-1][0] + own[-1][1] <= 40
    # No plan has fewer sequences than the tokens fill, or than there are pieces longer than half of one.
    least = max(-(-sum(k * n for k, n in counts.items()) // 40), sum(n for k, n in counts.items() if k > 20))
    assert found.sequences <= 1.5 * least + 1


def best_fit_decreasing(lengths, capacity):
    """The number of sequences of plain best fit, by gaps one at a time."""
    gaps, sequences = [], 0
    for n in sorted(lengths, reverse=True):
        at = bisect_left(gaps, n)
        if at == len(gaps):
            sequences += 1
        gap = (gaps.pop(at) if at < len(gaps) else capacity) - n
        if gap:
            insort(gaps, gap)
    return sequences


@pytest.mark.parametrize("seed", [1, 2])
def test_plans_are_never_worse_than_best_fit(seed):
    """Ten distributions of lengths; and of most the number is near the bound by tokens."""
    rng = np.random.default_rng(seed)
    n = 4000
    some = {
        "all": rng.integers(1, 4097, n),
        "no short ones": rng.integers(200, 4097, n),
        "middle": rng.integers(600, 2001, n),
        "around half": rng.integers(1000, 3001, n),
        "thirds": rng.integers(1200, 1500, n),
        "short": np.minimum(rng.geometric(1 / 300, n), 4096),
        "log": np.clip(rng.lognormal(6.5, 1, n).astype(int), 1, 4096),
        "long and tiny": np.r_[rng.integers(3000, 4097, n // 4), rng.integers(1, 60, n)],
        "few lengths": rng.choice([1365, 1366, 2048, 700, 4096], n),
        "one": np.full(n, 1025),
    }
    for name, lengths in some.items():
        found = packing.plan(dict(Counter(lengths.tolist())))
        assert -(-int(lengths.sum()) // 4096) <= found.sequences <= best_fit_decreasing(lengths.tolist(), 4096), name
    assert packing.plan({}).sequences == 0


def test_packing(spark, odd, sf_dir):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    for docs in (odd, spark.read.parquet(f"{sf_dir}/documents.parquet")):
        expected, got, places = Counter(), Counter(), defaultdict(list)
        for r in docs.collect():
            ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1]
            for k, a in enumerate(range(0, len(ids), 4096)):
                part = ids[a : a + 4096]
                expected[r.doc_id, k, a, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
        for r in packing.pack(docs, TOKENIZER).collect():
            got[r.doc_id, r.piece, r.start, r.length, r.ids_crc32] += 1
            places[r.sequence_id].append((r.offset, r.length))
        assert got == expected
        for own in places.values():
            own.sort()
            assert own[0][0] == 0 and all(a[0] + a[1] == b[0] for a, b in zip(own, own[1:])) and own[-1][0] + own[-1][1] <= 4096
        assert len(places) <= 1.02 * -(-sum(k[3] * n for k, n in got.items()) // 4096) + 1
    assert packing.pack(odd.limit(0), TOKENIZER).count() == 0


def test_packing_of_frequent_lengths_and_texts_as_ids(spark):
    """Lengths that are dealt to many groups, null and repeated ids, ids that are texts, columns with the names of own ones."""
    rows = [(None if k % 3 == 0 else f"d{k % 7}", "word " * (k % 5), "g", "r") for k in range(200)] + [("long", "word " * 9_000, "g", "r")]
    docs = spark.createDataFrame(rows, "doc_id string, text string, number string, rank string")
    got = packing.pack(docs, TOKENIZER, least_group=7).collect()
    places = defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 4096
    ends = Counter(r.doc_id for r in got if r.piece == 0)
    assert ends == Counter(r[0] for r in rows) and sum(r.length for r in got if r.doc_id == "long") == 9_001


def test_other_tokenizers_get_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = ["Hello  World\n don't ", "", "naïve 日本語 12 345", "x" * 5_000]
    theirs = Tokenizer.from_file(path)
    assert not packing.encoder(path).by_words and packing.encoder(TOKENIZER).by_words
    assert packing.encoder(path)(texts) == [np.array(theirs.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


def test_pipeline(spark, sf_dir):
    import corpus_pipeline as c

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = {r.doc_id: r for r in c.language(spark, docs, sf_dir).collect()}
    assert len(kept) > 0.95 * docs.count()
    best = {}
    for i, r in kept.items():
        best[lower(r.text)] = max(i, best.get(lower(r.text), -1))
    left = [kept[i] for i in best.values()]
    winners = {component for _, _, component in slow_components(left)}
    packed = c.run(spark, sf_dir).collect()
    assert {r.doc_id for r in packed} == winners
    assert all(c.exact(spark, docs, sf_dir).columns == c.COLUMNS for _ in range(1))


def test_stages_on_odd_and_empty_tables(spark, odd, sf_dir):
    """Each stage takes nulls, repeated rows and empty tables, and returns the columns of documents."""
    import corpus_pipeline as c

    docs = odd.where("doc_id <> 10 or doc_id is null")
    for name, stage in c.STAGES:
        for table in (docs, docs.limit(0)):
            got = stage(spark, table, sf_dir)
            assert name == "pack" or got.columns == c.COLUMNS
            assert 0 < got.count() <= docs.count() if table is docs else got.count() == 0
    kept = {r.text for r in c.language(spark, docs, sf_dir).collect()}
    assert None not in kept and "12 ... 34" not in kept and "some text" in kept
    assert c.exact(spark, docs, sf_dir).count() == len({lower(r.text) for r in docs.collect()})


def test_language_stage_rejects_what_is_in_another_language(spark, sf_dir):
    import corpus_pipeline as c

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    german = docs.where("lang = 'de' and n_chars > 500").limit(3).selectExpr("doc_id + 100000 AS doc_id", "text", "'en' AS lang", "source", "n_chars")
    kept = c.language(spark, docs.unionByName(german), sf_dir).select("doc_id").collect()
    assert max(r.doc_id for r in kept) < 100_000 and len(kept) > 0.98 * docs.count()


def test_language_stage_on_short_and_mixed_texts(spark):
    """Texts of 3 to 30 words go under another language's name and stay under their own; mixed ones stay under either."""
    import corpus_pipeline as c

    import corpus_pipeline as c

    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    by = defaultdict(list)
    for r in docs.where("n_chars > 900").orderBy("doc_id").collect():
        by[r.lang].append(r.text.split())
    by = {k: x[:40] for k, x in by.items()}
    rows, kinds = [], {}

    def plant(kind, text, lang):
        rows.append((100_000 + len(rows), text, lang, "", len(text)))
        kinds[rows[-1][0]] = kind

    for lang, texts in by.items():
        for k, words in enumerate(texts):
            for n in (3, 6, 9, 12, 20, 30):
                text = " ".join(words[:n])
                plant(("own", n > 9), text, lang)
                for other in by.keys() - {lang}:
                    plant(("wrong", n > 9), text, other)
            other = sorted(by.keys() - {lang})[k % 3]
            mixed = " ".join(words[:50] + by[other][k % len(by[other])][:50])
            plant("mixed", mixed, lang)
            plant("mixed", mixed, other)
    planted = spark.createDataFrame(rows, docs.select(*c.COLUMNS).schema)
    kept = Counter(kinds[r.doc_id] for r in c.language(spark, docs.select(*c.COLUMNS).unionByName(planted), sf).where("doc_id >= 100000").select("doc_id").collect())
    share = {kind: kept[kind] / n for kind, n in Counter(kinds.values()).items()}
    assert share["wrong", False] < 0.2 and share["wrong", True] < 0.05, share
    assert share["own", False] > 0.98 and share["own", True] > 0.98 and share["mixed"] > 0.97, share
    unnamed = planted.limit(9).selectExpr("doc_id", "if(doc_id = 100000, '12 .', text) AS text", "string(null) AS lang", "source", "n_chars")
    assert c.language(spark, unnamed, sf).count() == 8
