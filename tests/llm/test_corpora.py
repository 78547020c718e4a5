"""Near duplicates, neighbours, languages, quality and mixing: against brute
force on small tables, held-out accuracy, and every odd case."""

from __future__ import annotations

import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinship.llm import common, forest, hashing, language_id, minhash, mixing, ngram_quality, pairwise_quality
from kinship.llm.components import components

LABELS = "doc_id long, quality int, toxic int"


def fold(doc_id, folds):
    return zlib.crc32(str(doc_id).encode()) % folds


# Near duplicates


def brute_components(rows, size, share):
    """doc_id -> (set sizes, smallest id reachable), by comparing every pair of rows."""
    sets = []
    for _, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall("[^\x20\x09-\x0d]+", low)
        sets.append({tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set())
    parent = {i: i for i, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x in range(len(rows)):
        for y in range(x):
            both = len(sets[x] & sets[y])
            if both and share[1] * both >= share[0] * len(sets[x] | sets[y]):
                a, b = sorted((root(rows[x][0]), root(rows[y][0])))
                parent[b] = a
    return {(i, len(s), root(i)) for (i, _), s in zip(rows, sets)}


def near_copies(seed=1, groups=6, members=14):
    rng, rows = random.Random(seed), []
    for g in range(groups):
        base = [f"g{g}w{rng.randint(0, 60)}" for _ in range(rng.choice([4, 30, 120]))]
        for _ in range(members):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(["x", "y", f"z{rng.randint(0, 99)}"])
            rows.append(" ".join(copy))
    rng.shuffle(rows)
    return list(enumerate([*rows, None, "", " ", "a", "A", "a b", "b a"]))


@pytest.mark.parametrize(("words", "share"), [(3, (85, 100)), (5, (80, 100))])
def test_near_duplicates_equal_brute_force(spark, words, share):
    rows = near_copies()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = minhash.near_duplicates(docs, words, share).collect()
    assert {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in got} == brute_components(rows, words, share)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got) and len(got) == len(rows)


def test_near_duplicates_in_large_buckets(spark, monkeypatch):
    """The comparison by blocks gives what the comparison by pairs gives."""
    rows = near_copies(seed=4, groups=2, members=60)
    monkeypatch.setattr(minhash, "LARGE_BUCKET", 4)
    monkeypatch.setattr(minhash, "BLOCK", 5)
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, (85, 100)).collect()
    assert {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in got} == brute_components(rows, 3, (85, 100))


def test_near_duplicates_of_odd_rows(documents, no_documents):
    got = minhash.near_duplicates(documents, 3, (85, 100)).collect()
    component = {r["doc_id"]: r["component_id"] for r in got}
    assert len(got) == documents.count()
    assert component[1] == component[2] == component[3] == 1 and component[9] == 9
    assert [component[i] for i in (4, 5, 6, 7)] == [4, 5, 6, 7]
    assert component[None] == 1  # linked by its text, though it has no id of its own
    assert minhash.near_duplicates(no_documents).count() == 0


def test_repeated_ids_join_what_they_link_to(spark):
    a, b = "one two three four five six", "seven eight nine ten eleven twelve"
    rows = [(5, a), (5, b), (3, a), (9, b), (1, "alone on this line")]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, (85, 100)).collect()
    assert {(r["doc_id"], r["component_id"]) for r in got} == {(5, 3), (3, 3), (9, 3), (1, 1)}


def test_looks_never_exclude_what_surely_passes():
    looks = minhash.needed_matches(144, 24, 0.85, 1e-6)
    assert [n for n, _ in looks] == [24, 48, 72, 96, 120, 144]
    assert all(0 < m < 0.85 * n for n, m in looks) and all(a[1] <= b[1] for a, b in zip(looks, looks[1:]))


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(20)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(21)} | {100 + i: 100 for i in range(30)}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


# Neighbours


def vectors(spark, n=900, dim=12, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    x[50:90] = x[50]  # ties
    return x, spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")


def test_neighbours_recall_and_exact_scores(spark):
    x, rows = vectors(spark)
    bad = [(5000, None), (5001, [0.0] * 12), (5002, [float("nan")] * 12), (5003, [1.0]), (None, [1.0] * 12), (5004, [None] * 12), (5005, [float("inf")] * 12)]
    all_rows = rows.unionByName(spark.createDataFrame(bad, rows.schema)).withColumn("leaf", F.lit("x"))
    found = forest.nearest(all_rows, lambda i: i % 100 == 0, k=10, sample_rows=300, leaf_sample=40, visits=20, block_rows=16).collect()
    hits = 0
    for q in range(0, 900, 100):
        distance = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        distance[q] = np.inf
        true = np.lexsort((np.arange(len(x)), distance))[:10]
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in found if r["query_id"] == q)
        assert [r for r, *_ in mine] == list(range(1, 11))
        assert all(distance[i] == pytest.approx(s, abs=1e-12) for _, i, s in mine)
        assert [(s, i) for _, i, s in mine] == sorted((s, i) for _, i, s in mine)
        hits += len({i for _, i, _ in mine} & set(true.tolist()))
    assert hits >= 0.9 * 90 and {r["query_id"] for r in found} == set(range(0, 900, 100))


def test_neighbours_visiting_every_leaf_equal_brute_force(spark):
    x, rows = vectors(spark, 300, 4, 3)
    found = forest.nearest(rows, lambda i: i % 10 == 0, k=5, sample_rows=200, leaf_sample=30, visits=10_000).collect()
    for q in range(0, 300, 10):
        distance = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        distance[q] = np.inf
        true = np.lexsort((np.arange(len(x)), distance))[:5].tolist()
        assert [r["vec_id"] for r in sorted((r for r in found if r["query_id"] == q), key=lambda r: r["rank"])] == true


def test_neighbours_of_few_rows(spark):
    rows = spark.createDataFrame([(0, [1.0, 0.0]), (7, [1.0, 1.0])], "vec_id long, embedding array<double>")
    got = forest.nearest(rows, lambda i: i % 100 == 0).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got] == [(0, 1, 7, 1.0)]
    assert forest.nearest(rows.limit(0), lambda i: i % 100 == 0).count() == 0
    assert forest.nearest(rows.limit(1), lambda i: i % 100 == 0).count() == 0


def test_neighbours_by_query_blocks_are_bounded_and_equal(spark):
    """All queries visit all leaves; no group holds more than about a block of either side."""
    _, rows = vectors(spark, 600, 4, 5)
    options = dict(k=5, sample_rows=200, leaf_sample=30, visits=10_000)
    whole = forest.nearest(rows, lambda i: i >= 0, **options).collect()
    cut = forest.nearest(rows, lambda i: i >= 0, **options, block_rows=20, query_block_rows=25).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, cut)) and len(cut) == 600 * 5
    x = np.array([r["embedding"] for r in rows.limit(200).collect()])
    trees = spark.sparkContext.broadcast([forest.grow(x, 30, np.random.default_rng(0))])
    table = rows.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    for side in forest.groups(table, table, trees, 10_000, 4, 24):
        assert max(r["count"] for r in side.groupBy(*forest.KEY).count().collect()) <= 60


# Languages


def plain_phrases(sample, text):
    """Phrases of the parse, by substring search; a letter the sample lacks ends a phrase."""
    count, phrase = 0, ""
    for c in text:
        if any(phrase + c in s for s in sample):
            phrase += c
        else:
            count, phrase = count + 1, c if any(c in s for s in sample) else ""
    return count + bool(phrase)


def test_phrases_equal_substring_search():
    rng = random.Random(2)
    samples = {lang: ["".join(rng.choices(letters, k=60)) for _ in range(3)] for lang, letters in (("x", "aab "), ("y", "abc "), ("z", "cd"))}
    parser = language_id.Parser(samples)
    texts = ["".join(rng.choices("abcde ", k=rng.randint(0, 300))) for _ in range(40)]
    got, counts = parser.phrases(texts)

    def reduced(text):
        return re.sub(" +", " ", text).lstrip(" ") if text.strip() else ""

    for i, text in enumerate(texts):
        assert counts[i] == len(reduced(text))
        for k, lang in enumerate(parser.languages):
            assert got[k, i] == plain_phrases([reduced(s) for s in samples[lang]], reduced(text))


def test_blocks_of_a_long_text_add_at_most_a_phrase_each():
    parser = language_id.Parser({"x": ["abcabcabd" * 20]})
    text = "abcabd" * 1000
    got, counts = parser.phrases([text])
    whole = plain_phrases(["abcabcabd" * 20], text)
    assert whole <= got[0, 0] <= whole + -(-counts[0] // language_id.BLOCK)


def test_letters_beyond_the_samples_and_large_alphabets():
    """Letters that no sample holds end a phrase each; each of thousands of letters is its own symbol."""
    rng = random.Random(5)
    han = [chr(0x4E00 + i) for i in range(3000)]
    samples = {"h": ["".join(rng.choices(han, k=2000)) for _ in range(2)], "g": ["".join(rng.choices(han[:400], k=2000))], "l": ["abc abd " * 30]}
    parser = language_id.Parser(samples)
    unknown = "".join(chr(0x9000 + i) for i in range(400))
    texts = [unknown, samples["h"][0][500:900], "".join(rng.choices(han, k=300)) + " abc", "abcé abd"]
    got, counts = parser.phrases(texts)
    assert got[:, 0].tolist() == [400.0] * 3 and counts[0] == 400
    for i, text in enumerate(texts):
        for k, lang in enumerate(parser.languages):
            reduced = [s.rstrip(" ") + (" " if s.endswith(" ") else "") for s in samples[lang]]
            assert got[k, i] == plain_phrases(reduced, text)
    assert parser.predict(texts)[0][1] == "h"


def test_rows_of_steps_that_find_no_room_get_their_own(monkeypatch):
    rng = random.Random(6)
    samples = {"x": ["".join(rng.choices("abcdefgh", k=300))], "y": ["".join(rng.choices("efghij", k=300))]}
    texts = ["".join(rng.choices("abcdefghijk", k=200)) for _ in range(10)]
    usual = language_id.Parser(samples).phrases(texts)[0]
    monkeypatch.setattr(language_id, "TRIES", 1)
    assert (language_id.Parser(samples).phrases(texts)[0] == usual).all()


def test_dirty_language_values_do_not_grow_the_fit(spark):
    rows = [(i, f"word{'x' * (i % 7)} tale", f"dirty{i}") for i in range(300)] + [(1000 + i, "a tale of two cities " * 9, "en") for i in range(20)]
    docs = spark.createDataFrame([*rows, (None, "zz", "en"), (None, "aa", "en")], "doc_id long, text string, lang string")
    samples = language_id.learn(docs, sample_letters=600, languages=50)
    assert len(samples) == 50 and "en" in samples and sum(len(t) for found in samples.values() for t in found) <= 600
    assert all(found for found in samples.values())
    assert language_id.learn(docs.orderBy(F.desc("text")).repartition(5), sample_letters=600, languages=50) == samples


def test_languages_held_out(small):
    docs = small("documents")
    got = {r["doc_id"]: r for r in language_id.held_out_languages(docs).collect()}
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    assert all(r["held_out"] == (fold(i, 4) == 2) and 0 <= r["score"] <= 1 for i, r in got.items())
    held = [i for i, r in got.items() if r["held_out"]]
    assert sum(got[i]["lang_pred"] == truth[i] for i in held) >= 0.95 * len(held)


def test_languages_of_odd_rows(documents, no_documents):
    rows = language_id.held_out_languages(documents).collect()
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in rows}
    assert len(rows) == documents.count()
    assert got[4] == got[5] == got[6] == ("und", 0.0)
    assert language_id.held_out_languages(no_documents).count() == 0
    untaught = documents.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in language_id.held_out_languages(untaught).collect()} == {"und"}


def test_languages_of_long_texts_only_are_learned(spark):
    """A language whose labelled texts are all over the limit, and one with its only word far from the window's place."""
    rng = random.Random(8)
    words = {lang: ["".join(rng.choices(letters, k=rng.randint(2, 8))) for _ in range(60)] for lang, letters in (("s", "abcdef"), ("l", "uvwxyz"))}
    rows = [(i, " ".join(rng.choices(words["s"], k=40)), "s") for i in range(30)]
    rows += [(100 + i, " ".join(rng.choices(words["l"], k=4000)), "l") for i in range(5)]
    rows += [(200, "1 " * 20_000 + "ŵŷ", "far")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    samples = language_id.learn(docs)
    assert sorted(samples) == ["far", "l", "s"] and samples["far"] == ["ŵŷ"]
    assert all(len(t) <= language_id.SAMPLE_CHARS for texts in samples.values() for t in texts)
    assert {t for t in samples["l"]} <= {r[1][k : k + language_id.SAMPLE_CHARS] for r in rows[30:35] for k in range(len(r[1]))}
    two = docs.where("lang <> 'far'")
    got = {r["doc_id"]: r["lang_pred"] for r in language_id.identify(two, language_id.learn(two)).collect()}
    assert got == {i: lang for i, _, lang in rows if lang != "far"}


# Quality


def test_pairwise_quality_held_out(small):
    labels = small("labels")
    got = {r["doc_id"]: r for r in pairwise_quality.quality(small("documents"), labels).collect()}
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    assert all(r["held_out"] == (fold(i, 3) == 1) and r["predicted"] == (r["score"] >= 0.5) for i, r in got.items())
    held = [i for i, r in got.items() if r["held_out"] and i in truth]
    assert sum(got[i]["predicted"] == truth[i] for i in held) >= 0.9 * len(held)


def test_pairwise_weights_equal_a_plain_fit(small):
    """Newton's method on the logistic loss of the same pairs, each the right way round."""
    docs, labels = small("documents"), common.one_label(small("labels"), "quality")
    pairs = pairwise_quality.preference_pairs(docs, labels, 40, 3).collect()
    assert {r["turned"] for r in pairs} == {True, False} and len(pairs) % 3 == 0
    x = np.array([r["difference"] for r in pairs])
    assert x.shape[1] == pairwise_quality.N_FEATURES
    sign = np.array([-1.0 if r["turned"] else 1.0 for r in pairs])
    sigma = (x * sign[:, None]).std(axis=0, ddof=1)
    z = np.divide(x, sigma, out=np.zeros_like(x), where=sigma > 0)
    beta, penalty = np.zeros(z.shape[1]), pairwise_quality.PENALTY
    for _ in range(60):
        p = 1 / (1 + np.exp(-z @ beta))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z / len(z) + penalty * np.eye(z.shape[1]), z.T @ (p - 1) / len(z) + penalty * beta)
        beta -= step
    assert np.abs(step).max() < 1e-9
    got = np.array(pairwise_quality.fit_weights(docs, labels, 40, 3)) * sigma
    texts = [r["text"] or "" for r in docs.select("text").collect()]
    f = np.array([pairwise_quality.features(t) for t in texts])
    f = np.divide(f, sigma, out=np.zeros_like(f), where=sigma > 0)
    assert np.corrcoef(f @ got, f @ beta)[0, 1] > 0.999
    assert np.abs(got - beta).max() < 0.02 * np.abs(beta).max()


def test_pairwise_quality_learns_from_words_and_characters(spark):
    """Good and bad texts of one shape, told apart by their words only, or by runs of letters in new words."""
    rng = random.Random(9)
    kinds = {1: ["abbey", "cabin", "delta", "eagle"], 0: ["zebra", "yacht", "waltz", "vodka"]}
    rows = [(i, " ".join(rng.choices(kinds[i % 2], k=30))) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i, _ in rows], LABELS)
    assert {r["doc_id"]: r["predicted"] for r in pairwise_quality.quality(docs, labels).collect()} == {i: i % 2 for i, _ in rows}


def test_character_runs_are_of_characters():
    """Equal runs share a bucket wherever they stand; a run is of code points, not of bytes."""
    assert hashing.character_runs("", 256).size == hashing.character_runs("äöü", 256).size == 0
    got = hashing.character_runs("äöü€äöü€", 256)
    assert got.size == 5 and got[0] == got[4] and got.max() < 256
    text = "".join(chr(0x4E00 + i) for i in range(5000))
    assert np.bincount(hashing.character_runs(text, 64), minlength=64).max() < 3 * 5000 / 64


def test_quality_never_reads_held_out_labels(small):
    labels = small("labels")
    held = common.key_fold(F.col("doc_id"), 3) == 1
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    one, other = (
        {r["doc_id"]: r["score"] for r in pairwise_quality.quality(small("documents"), x).collect()} for x in (labels, turned)
    )
    assert one == pytest.approx(other, rel=1e-6)


def test_pairwise_quality_of_odd_rows(spark, documents, no_documents):
    labels = spark.createDataFrame([(1, 1, 0), (9, 0, 0), (10, None, None), (None, 1, 0), (77, 0, 0), (1, 1, 0)], LABELS)
    rows = pairwise_quality.quality(documents, labels, folds=1000, fold=999).collect()
    assert len(rows) == documents.count() and all(0 <= r["score"] <= 1 for r in rows)
    none = spark.createDataFrame([], LABELS)
    assert {r["score"] for r in pairwise_quality.quality(documents, none).collect()} == {0.5}
    assert pairwise_quality.accepted(documents, none).count() == documents.count()
    assert pairwise_quality.quality(no_documents, none).count() == 0


def test_ngram_quality(spark, small, documents, no_documents):
    labels = small("labels")
    rows = {r["doc_id"]: r for r in ngram_quality.judge(small("documents"), labels).collect()}
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    sure = [i for i in truth if not rows[i]["base_failed"]]
    assert sum(rows[i]["kept"] == truth[i] for i in sure) >= 0.95 * len(sure)
    assert all(not (r["kept"] and r["base_failed"]) for r in rows.values())
    none = spark.createDataFrame([], LABELS)
    odd = ngram_quality.judge(documents, none).collect()
    assert len(odd) == documents.count() and {r["probability"] for r in odd} == {1.0}
    assert {r["doc_id"] for r in odd if r["base_failed"]} >= {4, 5, 6, 7, 8}
    assert ngram_quality.judge(no_documents, none).count() == 0


def test_ngram_quality_held_out(spark):
    """Learns from the labels of one half of the ids and judges the other half."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet") for name in ("documents", "labels"))
    held = common.key_fold(F.col("doc_id"), 2) == 1
    classifier = ngram_quality.fit(docs, labels.where(~held))
    truth = {r["doc_id"]: r["quality"] for r in labels.where(held).collect()}
    known = [r for r in docs.where(held).collect() if r["doc_id"] in truth]
    good = classifier.probabilities([r["text"] or "" for r in known]) >= ngram_quality.KEEP_FROM
    assert np.mean([g == truth[r["doc_id"]] for g, r in zip(good, known)]) >= 0.95


# Mixing


def test_rates_meet_the_targets(spark):
    rng = np.random.default_rng(1)
    p = rng.dirichlet([0.3, 0.3, 0.3], 400)
    rows = [(i, int(n), v.tolist()) for i, (n, v) in enumerate(zip(rng.integers(1, 500, 400), p))]
    weighed = spark.createDataFrame(rows, "doc_id long, n_tokens long, posterior array<double>")
    history, targets, reached = mixing.fit_rates(weighed, [0.6, 0.3, 0.1])
    assert reached == pytest.approx(targets, rel=1e-3)
    rates = {r["doc_id"]: r["rate"] for r in mixing.with_rates(weighed, history, float("inf"), 3).collect()}
    again = sum(rates[i] * n * np.array(v) for i, n, v in rows)
    assert min(rates.values()) >= 0 and again.tolist() == pytest.approx(reached)


def test_rates_are_the_least_squares_optimum(spark):
    """Targets out of reach: no rate can be moved to come closer."""
    rows = [(0, 10, [0.5, 0.5]), (1, 20, [0.6, 0.4]), (2, 5, [0.2, 0.8])]
    weighed = spark.createDataFrame(rows, "doc_id long, n_tokens long, posterior array<double>")
    history, targets, reached = mixing.fit_rates(weighed, [0.99, 0.01], steps=500)
    rates = [r["rate"] for r in mixing.with_rates(weighed, history, float("inf"), 2).orderBy("doc_id").collect()]
    held = np.array([sum(n * v[k] for _, n, v in rows) for k in range(2)])
    slope = [((np.array(reached) - targets) / held) @ np.array(v) for _, _, v in rows]
    assert all(abs(s) < 5e-3 or (r == 0 and s > 0) for r, s in zip(rates, slope))


def test_mixing_of_labelled_documents(small):
    docs, labels = small("documents"), mixing.label_domains(small("labels"))
    shares = {"good": 0.9, "poor": 0.05, "toxic": 0.05}
    rows = mixing.mix(docs, labels, shares).collect()
    total = sum(r["n_tokens"] for r in rows)
    for k, share in enumerate(shares.values()):
        assert sum(r["rate"] * r["n_tokens"] * r["posterior"][k] for r in rows) == pytest.approx(share * total, rel=0.01)
    assert all(sum(r["posterior"]) == pytest.approx(1) and r["copies"] in (int(r["rate"]), int(r["rate"]) + 1) for r in rows)
    assert len(rows) == docs.count()


def test_mixing_of_odd_rows(spark, documents, no_documents):
    labels = spark.createDataFrame([(1, "a"), (9, "b"), (None, "a"), (10, None), (77, "b")], "doc_id long, domain string")
    shares = {"a": 0.5, "b": 0.5}
    rows = mixing.mix(documents, labels, shares).collect()
    assert len(rows) == documents.count() and all(r["rate"] >= 0 for r in rows)
    assert mixing.mix(no_documents, labels, shares).count() == 0
    unlabelled = mixing.mix(documents, labels.limit(0), shares).collect()
    assert {tuple(r["posterior"]) for r in unlabelled} == {(1.0, 0.0)} and {r["rate"] for r in unlabelled} == {1.0}
    kept = mixing.mixed(documents, labels, shares, "a")
    assert kept.columns == documents.columns and kept.count() <= documents.count()
