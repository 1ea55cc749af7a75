"""Operators on texts against plain models, and their defined cases."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from evidlake.llm import jaccard, langid, linededup, lm, packing, quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n, vocab=60):
    return [f"w{rng.randrange(vocab)}" for _ in range(n)]


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    rows = []
    for i in range(60):
        w = words(rng, rng.randrange(1, 90), 4000)
        rows.append((i, " ".join(w)))
    for i in range(60, 90):  # near copies
        w = rows[i - 60][1].split()
        w[rng.randrange(len(w))] = "changed"
        rows.append((i, " ".join(w)))
    base = [f"b{k}" for k in range(120)]
    for i in range(90, 140):  # a large group of near copies, each with an edit or two
        w = list(base)
        for _ in range(rng.randrange(0, 3)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(40)}"
        rows.append((i, " ".join(w)))
    rows += [(140, None), (141, ""), (142, " \n\t "), (143, "one two"), (144, "one two"), (145, "ONE  two"), (146, rows[0][1]), (147, "x " * 30000), (None, "no id here at all"), (148, "no id here at all"), (143, "one two")]
    return [(d, t, "en", "s", 0) for d, t in rows]


def brute_jaccard(rows, k, percent):
    def sets(t):
        w = WORD.findall((t or "").translate({c: c + 32 for c in range(65, 91)}))
        return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()

    s = [sets(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(s)):
        for j in range(i):
            if s[i] and s[j] and 100 * len(s[i] & s[j]) >= percent * len(s[i] | s[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    low = collections.defaultdict(list)
    for i, r in enumerate(rows):
        low[find(i)].append(r[0])
    name = {k: min((x for x in v if x is not None), default=None) for k, v in low.items()}
    return sorted(((r[0], len(s[i]), name[find(i)]) for i, r in enumerate(rows)), key=str)


@pytest.mark.parametrize(("k", "percent", "rare"), [(3, 90, 24), (3, 90, 3), (5, 80, 8)])
def test_jaccard_matches_brute_force(spark, corpus, k, percent, rare):
    docs = spark.createDataFrame(corpus, SCHEMA).withColumn("cid", F.lit("clash"))
    got = jaccard.join(spark, docs, words=k, percent=percent, rare=rare).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_jaccard(corpus, k, percent)


def test_window_bound_holds():
    rng = np.random.default_rng(1)
    for percent in (80, 90):
        for _ in range(200):
            n = int(rng.integers(3, 120))
            a = rng.choice(10**6, n, replace=False)
            b = np.unique(np.r_[a[: int(rng.integers(int(n * 0.85), n + 1))], rng.choice(10**6, int(rng.integers(0, 8)))])
            shared = len(np.intersect1d(a, b))
            if 100 * shared >= percent * (len(a) + len(b) - shared):
                wa, wb = (np.sort(x)[: jaccard.window(len(x), percent)] for x in (a, b))
                least = min(jaccard.window(len(a), percent) - len(a), jaccard.window(len(b), percent) - len(b)) + jaccard.overlap(len(a), len(b), percent)
                assert len(np.intersect1d(wa, wb)) >= max(1, least)
                assert least >= max(jaccard.least_shared(len(a), percent), jaccard.least_shared(len(b), percent))
                both = [set(zip(w[:-1].tolist(), w[1:].tolist(), strict=True)) for w in (wa, wb)]
                assert len(a) == len(b) == shared or len(both[0] & both[1]) >= jaccard.adjacent(len(a), len(b), percent) >= 1
    assert not any(jaccard.needs_single(n, percent) for percent in (80, 90) for n in range(1, 3000))


def test_jaccard_combinations_serve_documents_of_every_length():
    for n in (30, 200, 5000):
        tokens = np.arange(jaccard.window(n, 90), dtype=np.int64)
        keys = jaccard.combination_keys(tokens, jaccard.least_shared(n, 90), jaccard.needs_single(n, 90))
        assert len(keys) == len(tokens) - 1 <= 0.2 * n + 2 and not set(keys.tolist()) & set(tokens.tolist())


def test_jaccard_work_on_near_copies_is_in_proportion(spark, monkeypatch):
    """Pairs that are verified in a group of near copies: about as many for each document, whatever the group's size."""
    pairs = []
    verified = jaccard._Links.verified
    monkeypatch.setattr(jaccard._Links, "verified", lambda self, df: (pairs.append(df.count()), verified(self, df))[1])
    monkeypatch.setattr(jaccard, "_rest", lambda *_: pytest.fail("the group was compared in full"))
    rng = random.Random(3)
    base = [f"b{k}" for k in range(300)]
    made = []
    for n in (150, 600):
        rows = []
        for i in range(n):
            w = list(base)
            w[rng.randrange(len(w))] = f"e{i}"
            rows.append((i, " ".join(w)))
        pairs.clear()
        got = jaccard.join(spark, spark.createDataFrame(rows, "doc_id long, text string"), words=3, percent=90)
        assert {r["component_id"] for r in got.collect()} == {0}
        made.append(sum(pairs))
    assert made[1] < 6 * made[0]


@pytest.mark.parametrize("rounds", [1, 4])
def test_jaccard_compares_what_rounds_leave(spark, rounds):
    """Texts around one long passage, most of them not similar, some in chains and pairs."""
    rng = random.Random(4)
    passage = [f"p{k}" for k in range(60)]
    rows = []
    for i in range(120):
        w = passage + [f"o{i % 90}x{k}" for k in range(rng.choice([4, 8, 12, 16]))]
        if i % 4 == 0:
            w[rng.randrange(len(w))] = f"e{i}"
        rows.append((i, " ".join(w)))
    got = jaccard.join(spark, spark.createDataFrame(rows, "doc_id long, text string"), words=3, percent=80, rare=3, rounds=rounds).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_jaccard(rows, 3, 80)


def test_jaccard_on_nothing(spark):
    assert jaccard.join(spark, spark.createDataFrame([], SCHEMA)).count() == 0


def test_quality_base_features(spark, corpus):
    rows = [*corpus, (200, "a b c d e f g h a b c d e f g h z", "en", "s", 0), (201, "é#ü\nline\n\nline\nline", None, "s", 0)]
    got = {r["doc_id"]: r for r in quality.features(spark.createDataFrame(rows, SCHEMA), keep=("doc_id",)).collect()}
    for d, t, *_ in rows:
        w = WORD.findall(t or "")
        seen = collections.Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        hit = {i + k for i in range(len(w) - 7) if seen[tuple(w[i : i + 8])] > 1 for k in range(8)}
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        want = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in (t or "")), len(lines) - len(set(lines)), len(hit))
        assert tuple(got[d][1:6]) == want, d


def binomial_cdf(k, n, p):
    return sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))


def test_quality_bounds_are_exact():
    for n in (20, 60, 300):
        for k in (0, 1, 3):
            assert quality.rejects_at_most(k, n, 0.05, 0.01) == (k < n * 0.05 and binomial_cdf(k, n, 0.05) <= 0.01)
    assert [quality.most_rejects(n, 0.03, 0.01) for n in (0, 100, 151, 152)] == [-1, -1, -1, 0]
    k = quality.most_rejects(10**6, 0.03, 0.01, step=1000)
    assert k == quality.most_rejects(10**6, 0.03, 0.01) and 29500 < k < 29700
    good, bad = np.zeros(11, int), np.zeros(11, int)
    good[0], good[8], bad[9], bad[8] = 400, 4, 30, 20
    assert quality.cutoffs(good, bad, np.array([0, 0.005, 0.01, 0.03])).tolist() == [9, 9, 8, 8]
    assert quality.cutoffs(good, good, np.array([0.03])).tolist() == [11]
    held_good, held_bad = np.array([0, 2, 9, 0, 400]), np.array([5, 9, 3, 1, 0])
    assert quality.choose(held_good, held_bad, 0.03, 0.01) == 1  # 11 of 411 would be too many
    assert quality.choose(held_good // 40, held_bad, 0.03, 0.01) is None


def test_quality_loses_few_good_documents_to_all_rules_together(spark):
    """Good documents with independent flaws, each caught by another rule, are lost to the union within the risk."""
    rng, n = np.random.default_rng(7), 6000
    cells = (rng.random((n, 6)) * 60).astype(int)
    good = rng.random(n) < 0.7
    cells[good] += 120 * (rng.random((good.sum(), 6)) < 0.012)  # each rule alone would be allowed to lose these
    cells[~good] += 100 * (rng.random(((~good).sum(), 6)) < 0.25)
    names = [f"r_{k}" for k in "abcdef"]
    rows = [(i, "x" if i % 2 else None, *map(int, c)) for i, c in enumerate(cells)]
    scored = spark.createDataFrame(rows, "doc_id long, lang string, " + ", ".join(f"{x} int" for x in names))
    labels = spark.createDataFrame([(i, int(g)) for i, g in enumerate(good)], "doc_id long, quality int")
    got = {r["stratum"]: r["cuts"] for r in quality.calibrate(scored, labels, names, stratum="lang").collect()}
    assert set(got) == {"=x", "-"}
    for stratum, odd in (("=x", 1), ("-", 0)):
        mine = np.arange(n) % 2 == odd
        out = (cells >= np.array(got[stratum])).any(1)
        assert out[mine & good].mean() <= 0.03 < 0.05 < out[mine & ~good].mean()


def test_quality_strata_of_null_and_empty_names_are_apart(spark):
    rows = [(i, "" if i % 2 else None, 150 if i % 4 == 0 else 3) for i in range(4000)]
    scored = spark.createDataFrame(rows, "doc_id long, lang string, r_a int")
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(4000)], "doc_id long, quality int")
    got = {r["stratum"]: r["cuts"] for r in quality.calibrate(scored, labels, ["r_a"], stratum="lang").collect()}
    assert got == {"-": [150]}


def test_quality_rules_learn_and_keep_good_documents(spark):
    rng = random.Random(2)
    docs, labels = [], []
    for i in range(900):
        junk = i % 4 == 0
        w = words(rng, 40, 5000)
        docs.append((i, " ".join(x + "###" if junk else x for x in w), "en", "s", 0))
        labels.append((i, 0 if junk else 1))
    labels += [(5000, 0), (None, 1), (3, None), (4, 7)]
    docs += [(900, None, None, None, 0), (901, "", "xx", "s", 0)]
    clash = spark.createDataFrame(docs, SCHEMA).withColumn("n_words", F.lit("clash")).withColumn("r_upper", F.lit("clash")).withColumn("quality", F.lit("clash"))
    got = {r["doc_id"]: r for r in quality.assess(clash, spark.createDataFrame(labels, "doc_id long, quality int")).collect()}
    assert len(got) == 902
    assert all(got[i]["kept"] == (i % 4 != 0) for i in range(900))
    assert got[900]["base_failed"] and not got[900]["kept"] and got[900]["n_words"] == 0
    none = quality.assess(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame([], "doc_id long, quality int"))
    assert none.where("kept <> (NOT base_failed)").count() == 0


def test_langid_learns_and_defines_odd_cases(spark):
    rng = random.Random(3)
    say = {"aa": ["kaka", "laka", "raka", "taka"], "bb": ["mimi", "nini", "pipi", "titi"]}
    rows = [(i, " ".join(rng.choice(say[x]) for _ in range(30)), x, "s", 0) for i in range(200) for x in [("aa", "bb")[i % 2]]]
    rows += [(500, None, "aa", "s", 0), (501, "", None, "s", 0), (502, "123 !!", None, "s", 0), (503, "mimi " * 40000, None, "s", 0), (None, "kaka laka", None, None, 0), (3, rows[3][1], "bb", "s", 0)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("lang_pred", F.lit("clash")).withColumn("score", F.lit(9.0))
    got = langid.identify(spark, docs).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert all(by[i]["lang_pred"] == ("aa", "bb")[i % 2] and 0.5 < by[i]["score"] <= 1 for i in range(200))
    assert all(by[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i in range(200))
    assert [by[i]["lang_pred"] for i in (500, 501, 502, 503, None)] == ["und", "und", "und", "bb", "aa"]
    assert by[500]["score"] == 0
    unlabelled = langid.identify(spark, docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in unlabelled.collect()} == {"und"}
    assert langid.identify(spark, docs.limit(0)).count() == 0


def test_langid_batches_equal_single_texts():
    rng = random.Random(4)
    model = langid.Model(["a", "b"], np.random.default_rng(0).normal(size=(langid.BUCKETS, 2)).astype(np.float32), np.zeros(2), (1, 2, 3))
    texts = ["".join(rng.choice("abcdé ") for _ in range(n)) for n in (1, 2, 3, 50, 7, 900)]
    together = model.scores(texts)[0]
    for t, row in zip(texts, together, strict=True):
        assert np.allclose(model.scores([t])[0][0], row, rtol=1e-4)
        assert np.allclose(model.long(t)[0], row, rtol=1e-4)


def plain_grams(text, orders=(1, 2, 3)):
    t = f" {' '.join(text.lower().split())} "
    return collections.Counter(t[i : i + k] for k in orders for i in range(len(t) - k + 1))


def test_langid_counts_parts_of_long_texts_as_a_whole(monkeypatch):
    rng = random.Random(5)
    for _ in range(200):
        text = "".join(rng.choice("abCé \n\t") for _ in range(rng.randrange(0, 60)))
        whole = next(langid._points(text, (1, 2, 3)))[0]
        for part in (3, 7, 20):
            got = np.concatenate([codes[old:] for codes, old in langid._points(text, (1, 2, 3), part)])
            assert got.tobytes() == whole.tobytes(), (text, part)
        assert langid._counts(text, (1, 2, 3), 1 << 15).sum() == sum(plain_grams(text).values())
    text = "some words of a long text, " * 40
    want = langid._counts(text, (1, 2, 3), 1 << 15)
    monkeypatch.setattr(langid._points, "__defaults__", (50,))
    assert (langid._counts(text, (1, 2, 3), 1 << 15) == want).all()


def test_langid_matches_a_plain_model(spark):
    """All documents against naive Bayes on exact n-grams, with more languages than one broadcast holds and a rare one."""
    rng = random.Random(6)
    alphabets = {f"l{i}": "".join(chr(97 + (7 * i + 3 * k) % 26) for k in range(9)) + chr(0xE0 + i) for i in range(7)}
    rows = []
    for i in range(700):
        lang = f"l{i % 6}" if i % 100 else "l6"
        rows.append((i, " ".join("".join(rng.choice(alphabets[lang]) for _ in range(5)) for _ in range(12)), lang if i % 9 else None))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    train = [r for r in rows if r[2] and zlib.crc32(str(r[0]).encode()) % 5]
    counts, prior = collections.defaultdict(collections.Counter), collections.Counter(r[2] for r in train)
    for _, t, x in train:
        counts[x] += plain_grams(t)
    total = {x: sum(c.values()) for x, c in counts.items()}

    def best(t):
        g = plain_grams(t)
        return max(sorted(counts), key=lambda x: math.log(prior[x]) + sum(n * math.log((counts[x][k] + 0.5) / (total[x] + 0.5 * langid.BUCKETS)) for k, n in g.items()))

    want = {i: best(t) for i, t, _ in rows}
    for at_once in (256, 3):
        model = langid.fit(docs.where(langid.fold("doc_id", 5) != 0), at_once=at_once)
        got = {r["doc_id"]: r for r in langid.predict(spark, docs, model).collect()}
        assert {i: r["lang_pred"] for i, r in got.items()} == want
        assert want[0] == "l6" and all(0.4 < r["lang_score"] <= 1 for r in got.values())
        if at_once == 256:
            one = {i: r["lang_score"] for i, r in got.items()}
    assert all(math.isclose(one[i], r["lang_score"], rel_tol=1e-6) for i, r in got.items())
    few = langid.fit(docs, sample=20)
    assert next(few).langs == sorted(alphabets)  # the rare language is learned from all its rows


def test_lm_base_score_is_exact_and_scores_are_probabilities(spark, corpus):
    docs = spark.createDataFrame(corpus, SCHEMA).withColumn("score", F.lit("clash"))
    assert lm.score(spark, docs, lm.fit(spark, docs)).count() == len(corpus)
    for common in (1 << 19, 40):  # all words looked up in place, and most through the join
        got = lm.score_all(spark, docs, common=common).collect()
        assert len(got) == len(corpus)
        train = [t for d, t, *_ in corpus if d is None or zlib.crc32(str(d).encode()) % 7 != 2]
        c = collections.Counter()
        for t in train:
            c.update(WORD.findall((t or "").lower()))
            c[None] += 1
        n, v = sum(c.values()), len(c)
        texts = collections.defaultdict(list)
        for d, t, *_ in corpus:
            texts[d].append(t)
        for r in got:
            ways = [[*WORD.findall((t or "").lower()), None] for t in texts[r["doc_id"]]]
            assert any(r["n_tokens"] == len(w) and r["n_known"] == sum(c[x] > 0 for x in w) and math.isclose(r["base_score"], sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), rel_tol=1e-9) for w in ways), r
            assert r["train_tokens"] == n and r["score"] < 0
    assert lm.score_all(spark, docs.limit(0)).count() == 0


class PlainTree:
    """The suffix tree by its definition: counts of all contexts, a dictionary of states, distributions as lists."""

    def __init__(self, texts, depth, root, gain):
        self.depth, n = depth, collections.defaultdict(collections.Counter)
        for t in texts:
            s = b"\t" * depth + t
            for i in range(depth, len(s)):
                for d in range(depth + 1):
                    n[s[i - d : i]][s[i]] += 1
        places = sum(n[b""].values())
        smooth, self.states = {}, {b""}
        for ctx in sorted(n, key=len):
            if sum(n[ctx].values()) < root * math.sqrt(places):
                continue
            above = smooth[ctx[1:]] if ctx else [1 / 256] * 256
            total, kinds = sum(n[ctx].values()), len(n[ctx])
            if ctx and sum(c * math.log(c / total / above[x]) for x, c in n[ctx].items()) > gain:
                self.states |= {ctx[k:] for k in range(len(ctx))}
            smooth[ctx] = [(n[ctx][x] + kinds * above[x]) / (total + kinds) for x in range(256)]
        self.smooth = smooth

    def score(self, t):
        s, out = b"\t" * self.depth + t, 0.0
        for i in range(self.depth, len(s)):
            ctx = next(s[i - d : i] for d in range(self.depth, -1, -1) if s[i - d : i] in self.states)
            out += math.log10(self.smooth[ctx][s[i]])
        return out


def test_lm_matches_a_plain_suffix_tree(spark):
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choice(["abab", "cdcd", "the", "of", "Thé", f"n{i % 7}"]) for _ in range(rng.randrange(0, 40)))) for i in range(120)]
    rows += [(200, None), (201, "zz\x00 ~ \u00ff new bytes"), (202, "abab " * 3000), (None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    said = lambda t: b" ".join(lm.tokens(t)) + b"\n"
    train = [said(t) for d, t in rows if d is None or zlib.crc32(str(d).encode()) % 7 != 2]
    plain = PlainTree(train, 3, 0.2, 2.0)
    assert len(plain.states) > 40 and max(map(len, plain.states)) == 3
    assert all(math.isclose(sum(p), 1) for p in plain.smooth.values())
    for at_once in (1 << 16, 9):
        got = lm.score_all(spark, docs, depth=3, root=0.2, gain=2.0, at_once=at_once).collect()
        assert len(got) == len(rows)
        by = {r["doc_id"]: r["score"] for r in got}
        for d, t in rows:
            assert math.isclose(by[d], plain.score(said(t)), rel_tol=1e-4), (at_once, d)


def test_suffix_trees_score_long_texts_in_parts_and_grow_with_the_corpus(spark):
    rng = random.Random(10)
    known = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(2, 9))) for _ in range(300)]
    say = lambda n: " ".join(rng.choice(known) for _ in range(n))
    sizes = []
    for n in (20, 400):
        model = lm.fit(spark, spark.createDataFrame([(say(30),) for _ in range(n)], "text string"))
        sizes.append(model.states.count())
    assert sizes[1] > 1.5 * sizes[0]
    tree = next(lm.shards(model.states, model.depth))
    text = lm.tokens(say(500))
    assert np.allclose(tree.texts([text, [], text], most=64), tree.texts([text, [], text]))


def test_line_dedup_deletes_later_blocks_only(spark):
    p = "this passage has more than ten words and is shared by many of them"
    q = "another long passage of words that only two of the documents have in common today"
    rows = [(1, f"first own line\n{p}\nend one"), (2, f"second own line\n{p}\n{q}\nshort"), (3, f"third\n  {p} \n\n{q}\nshort\nlast"), (4, None), (5, ""), (6, p), (7, "short\nnothing else"), (8, f"{q}\nx"), (1, f"first own line\n{p}\nend one"), (None, p)]
    rows += [(100 + i, f"unique {i}\n{p}") for i in range(30)]
    docs = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in rows], SCHEMA).withColumn("k", F.lit("clash")).withColumn("lines", F.lit(1))
    out = linededup.dedup(spark, docs).collect()
    assert len(out) == len(rows) and out[0]["k"] == "clash"
    got = {r["doc_id"]: r["text"] for r in out}
    assert got[1] == rows[0][1]
    assert got[2] == f"second own line\n{q}\nshort"
    assert got[3] == "third\n\nlast"
    assert got[4] is None and got[5] == "" and got[6] == "" and got[7] == rows[6][1] and got[8] == "x" and got[None] == ""
    assert all(got[100 + i] == f"unique {i}" for i in range(30))
    assert linededup.dedup(spark, docs.limit(0)).count() == 0
    last = [(2**63 - 1, p), (None, p), (3, f"{p}\n{q}\n" + "z\n" * 40000 + q)]  # the largest id, none, and a very long text
    out = {r["doc_id"]: r for r in linededup.dedup(spark, spark.createDataFrame(last, "doc_id long, text string")).collect()}
    assert out[2**63 - 1]["text"] == out[None]["text"] == "" and out[3]["text"] == last[2][1] and out[3]["n_lines_left"] == 40003


def brute_line_dedup(rows, min_words=10):
    """Every document against every earlier one."""
    out = {}
    split = [[" ".join(x.split()) or None for x in t.split("\n")] for _, t in rows]
    for j, (d, t) in enumerate(rows):
        sizes = [len((x or "").split()) for x in split[j]]
        gone = {x for i in range(j) for x in linededup.common_blocks(split[i], split[j], sizes, min_words)}
        out[d] = "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone)
    return out


def test_line_dedup_finds_blocks_of_lines_with_different_first_holders(spark):
    one, two = "six words that open a block", "six words that close the block"
    rows = [(1, f"{one}\nx"), (2, f"{two}\ny")] + [(3 + i, f"{one}\n{two}\nown line {i}") for i in range(12)]
    rows += [(20, "\n".join([one, "a", two]))]
    got = {r["doc_id"]: r["text"] for r in linededup.dedup(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[3] == rows[2][1] and all(got[3 + i] == f"own line {i}" for i in range(1, 12)) and got[20] == rows[-1][1]


def test_line_dedup_equals_all_pairs(spark):
    rng = random.Random(6)
    common = [" ".join(words(rng, rng.choice([2, 4, 6, 12]))) for _ in range(14)]
    rows = []
    for i in range(120):
        lines = [rng.choice(["", f"own {i} {n}", *common, *common]) for n in range(rng.randrange(1, 14))]
        if i % 3 == 0:  # blocks in another order
            lines = [*common[4:7], "x", *common[:3], *lines] if i % 2 else [*common[:3], f"y {i}", *common[4:7], *lines]
        rows.append((i, "\n".join(lines) if i % 17 else rows[i - 1][1] if i else common[3]))
    got = {r["doc_id"]: r["text"] for r in linededup.dedup(spark, spark.createDataFrame(rows, "doc_id long, text string"), rare=2).collect()}
    assert got == brute_line_dedup(rows)


def test_patience_alignment_is_a_common_subsequence():
    rng = random.Random(8)
    for _ in range(200):
        a = [rng.randrange(12) for _ in range(rng.randrange(0, 25))]
        b = list(a)
        for _ in range(rng.randrange(0, 6)):
            if b:
                b[rng.randrange(len(b))] = rng.randrange(40)
        got = linededup.align(a, b)
        assert all(a[i] == b[j] for i, j in got)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(got, got[1:], strict=False))
    assert linededup.align([1, 2, 3], [1, 2, 3]) == [(0, 0), (1, 1), (2, 2)]


def test_alignment_without_anchors_is_a_longest_common_subsequence():
    assert len(linededup.align([1, 9, 2], [3, 9, 4, 9, 5])) == 1 and len(linededup.align([3, 9, 4, 9, 5], [1, 9, 2])) == 1
    passage = [6, 7, 8]
    sizes = [4] * 9
    assert linededup.common_blocks([1, *passage, 2], [3, *passage, 4, *passage, 5], sizes, 10) in ([1, 2, 3], [5, 6, 7])
    assert linededup.common_blocks([3, *passage, 4, *passage, 5], [1, *passage, 2], sizes, 10) == [1, 2, 3]
    assert linededup.common_blocks([1, *passage, 2], [3, 6, 4, *passage, 6, *passage, 0], [4] * 11, 10) != []
    rng = random.Random(9)
    for n in range(400):
        a, b = ([rng.randrange(5) for _ in range(rng.randrange(0, 30))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        got = linededup.longest(a, b)
        assert got == linededup.longest(a, b, 1 + n % 40)  # whatever the size of the table that is held
        assert len(got) == table[-1][-1] and all(a[i] == b[j] for i, j in got)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(got, got[1:], strict=False))


def test_packing_round_trip(spark, corpus):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    assert 50256 in tok.encode("x <|endoftext|> y", add_special_tokens=False).ids
    rows = [*corpus[:146], corpus[147], (900, "a  b\tc\n\n don't <|endoftext|> é \U0001f600", "en", "s", 0)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("length", F.lit("clash"))
    cut = packing.pieces(docs, path).cache()
    packed = packing.pack(spark, cut, lane_rows=50).collect()
    assert len(packed) == cut.count()
    by = collections.defaultdict(list)
    for r in packed:
        by[r["doc_id"]].append(r)
    for d, t, *_ in rows:
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], dtype="<u4")
        parts = sorted(by[d], key=lambda r: r["piece"])
        assert b"".join(r["ids"] for r in parts) == ids.tobytes()
        assert [r["piece"] for r in parts] == list(range(len(parts)))
        assert all(zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] and r["length"] <= 1024 for r in parts)
        assert len(parts) == -(-len(ids) // 1024) and all(r["length"] == 1024 for r in parts[1:])
    bins = collections.defaultdict(list)
    for r in packed:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for b in bins.values():
        at = 0
        for off, size in sorted(b):
            assert off == at
            at += size
        assert at <= 1024
    assert {r["sequence_id"]: len(r["ids"]) // 4 for r in packing.sequences(packing.pack(spark, cut, lane_rows=50)).collect()} == {k: sum(x[1] for x in b) for k, b in bins.items()}
    assert packing.pack(spark, packing.pieces(docs.limit(0), path)).count() == 0


def test_packer_closes_the_fullest_when_bins_run_out():
    p = packing.Packer(10, 2)
    assert [p.put(7), p.put(5), p.put(6)] == [(0, 0), (1, 0), (2, 0)]  # the bin with 3 free closes
    assert p.put(3) == (2, 6)
    assert p.put(5) == (1, 5)
    rng = random.Random(1)
    p = packing.Packer(1024, 10**6)
    sizes = sorted((rng.randrange(1, 1025) for _ in range(5000)), reverse=True)
    used = collections.Counter()
    for s in sizes:
        seq, off = p.put(s)
        assert used[seq] == off
        used[seq] += s
    assert max(used.values()) <= 1024 and len(used) <= 1.02 * sum(sizes) / 1024


def test_packing_closes_bins_and_fills_sequences(spark):
    """As the query packs: pieces of all lengths, null and repeated ids among them, spread over lanes and batches."""
    rng = random.Random(7)
    rows = [(i if i % 3 else None if i % 2 else 5, 0, rng.randrange(1, 1025)) for i in range(30000)]
    cut = spark.createDataFrame(rows, "doc_id long, piece int, length long").repartition(4).cache()
    got = packing.pack(spark, cut).select("sequence_id", "offset", "length").collect()
    used, lanes = collections.Counter(), collections.Counter()
    for r in got:
        used[r["sequence_id"]] += r["length"]
        lanes[r["sequence_id"] >> 40] += 1
    assert len(got) == 30000 and max(used.values()) <= 1024
    assert len(lanes) == 3 and max(lanes.values()) < 1.1 * min(lanes.values())
    assert sum(used.values()) >= 0.985 * 1024 * len(used)
    wide = packing.pack(spark, cut, open_bins=10**6).select("sequence_id").distinct().count()
    few = packing.pack(spark, cut, open_bins=100).select("sequence_id").distinct().count()
    assert wide <= len(used) < few  # at the defaults some bins close early, with fewer open ones many do
    p, sizes = packing.Packer(1024, packing.OPEN_BINS), [r[2] for r in rows[:10000]]
    for lo in range(0, 10000, packing.BATCH_ROWS):
        for size in sorted(sizes[lo : lo + packing.BATCH_ROWS], reverse=True):
            p.put(size)
    assert p.closed > 100 and p.count <= packing.OPEN_BINS


def test_packing_encodes_whole_texts_for_files_of_another_kind(tmp_path):
    import json

    import public_tokenizers
    from tokenizers import Tokenizer

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        spec = json.load(f)
    spec["pre_tokenizer"]["add_prefix_space"] = True
    path = tmp_path / "other.json"
    path.write_text(json.dumps(spec))
    tok, text = Tokenizer.from_file(str(path)), "some words\nand  more"
    assert packing.encoder(str(path))(text) == np.array(tok.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
