"""Quality rules, classifier, near-duplicates, decontamination, language model: odd rows and brute force."""

import random
import zlib

import brute
import numpy as np
import pytest
from conftest import SF_MID, SF_SMALL
from odd_rows import CLASH, ROWS, empty, odd, own_columns_are_kept  # noqa: F401  (fixtures)
from pyspark.sql import functions as F

from cardlens.llm import components, decontaminate, language_model, quality_classifier, quality_rules, simhash


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


def random_texts(n, seed):
    r = random.Random(seed)
    words = ["a", "b", "the", "été", "x" * 30, "|", "A", "B!", "1", "\U0001f600"]
    gaps = [" ", "  ", "\n", "\n\n", "\t", "\x0b", "\x1c", " ", " "]
    return ["".join(r.choice(words[:r.choice((2, 10))]) + r.choice(gaps) for _ in range(r.randrange(0, 60))) for _ in range(n)]


# ---- quality rules ---------------------------------------------------------

def _check_measures(rows, text_of):
    for r in rows:
        m = r.measures if "measures" in r.asDict() and not isinstance(r.measures, str) else r["_measures"]
        assert (m.n_words, m.word_chars, m.n_symbols, m.n_dup_lines, m.n_repeat_words) == brute.quality_counts(text_of(r)), text_of(r)[:80]


def test_measures_equal_brute_force(spark):
    texts = random_texts(400, 5) + ["", None, "w " * 7, "w " * 8, "w " * 9, ("a b c d e f g h i j\n" * 3)]
    rows = quality_rules.measure(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), keep_text=True).collect()
    assert len(rows) == len(texts)
    _check_measures(rows, lambda r: r.text)


def test_fertility_equals_the_vocabularies(spark):
    v = quality_rules._Vocabularies(quality_rules.VOCABULARIES)
    text = "The été \U0001f9ff the THE 你好 no\u00a0break\u2003 it's 12.5% \u0301 x" + "y" * 250 + " " + "z1" * 4000
    m = quality_rules.measure(spark.createDataFrame([(text,)], "text string")).first().measures
    ids, fallback, pieces = [], 0, 0
    for w in brute.space_words(text):
        ids += v.bpe.encode_ordinary(" " + w)
        got = v.piece.encode(w)
        pieces += len(got)
        fallback += sum(v.piece.is_byte(i) for i in got)
    p = np.unique(ids, return_counts=True)[1] / len(ids)
    assert m.n_tokens == len(ids) and m.chars_per_token == pytest.approx(m.word_chars / len(ids))
    assert m.byte_share == pytest.approx(fallback / pieces) and fallback > 0
    assert m.token_entropy == pytest.approx(-(p * np.log2(p)).sum())


def test_bands_reject_junk_and_keep_prose(spark):
    labels, docs = (spark.read.parquet(f"{SF_MID}/{t}.parquet") for t in ("labels", "documents"))
    rows = quality_rules.judge(quality_rules.measure(docs.select("doc_id", "lang", "text"))).join(labels, "doc_id").collect()
    good, bad = [r for r in rows if r.quality == 1], [r for r in rows if r.quality == 0]
    assert sum(r.kept for r in good if not r.base_failed) >= 0.98 * sum(not r.base_failed for r in good)
    assert sum(not r.kept for r in bad) >= 0.8 * len(bad)
    for r in rows:
        m = r.measures
        assert r.base_failed == (m.n_words < 20 or 100 * m.n_repeat_words > 30 * m.n_words) and not (r.base_failed and r.kept)


def test_exact_copies_do_not_move_the_bands(spark, docs):
    few = docs.select("doc_id", "lang", "text")
    copies = few.filter("doc_id = 3").select(F.explode(F.sequence(F.lit(10_000), F.lit(12_000))).alias("doc_id"), "lang", "text")
    order = ["lang", "length_class"]
    alone = quality_rules.fit_bands(quality_rules.measure(few)).orderBy(order).collect()
    assert alone and quality_rules.fit_bands(quality_rules.measure(few.union(copies))).orderBy(order).collect() == alone


def test_thin_classes_have_bands(spark):
    """One text alone in its length class, its language or its script is judged too: junk goes, prose stays."""
    labels, docs = (spark.read.parquet(f"{SF_MID}/{t}.parquet") for t in ("labels", "documents"))
    good = docs.join(labels.filter("quality = 1"), "doc_id").filter("lang = 'en'").orderBy("doc_id").select("text").limit(300).collect()
    texts = [r.text for r in good]
    r = random.Random(3)
    junk = lambda n: " ".join("".join(r.choice("abcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(12)) for _ in range(n))
    long = " ".join(texts)
    rows = [(i, "en", t) for i, t in enumerate(texts)] + [(1000, "en", long), (1001, "xx", texts[0] + " " + texts[1])]
    rows += [(2000, "en", junk(20_000)), (2001, "xx", junk(300)), (2002, None, junk(300)), (2003, "en", junk(100_000))]
    out = quality_rules.judge(quality_rules.measure(spark.createDataFrame(rows, "doc_id long, lang string, text string"))).collect()
    got = {x.doc_id: (x.base_failed, x.kept) for x in out}
    assert all(got[d] == (False, False) for d in (2000, 2001, 2002, 2003)) and got[1000] == got[1001] == (False, True)
    assert all(x.kept is not None for x in out)


def test_script_is_that_of_most_letters(spark):
    texts = ["plain words", "\u043f\u0440\u0438\u0432\u0435\u0442 abc", "\u4f60\u597d a", "\u3053\u3093\u306b\u3061\u306f", "\u00e9t\u00e9", "12 34", "\u0939\u093f\u0928\u094d\u0926\u0940"]
    rows = quality_rules.measure(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [x.measures.script for x in rows] == ["LATIN", "CYRILLIC", "CJK", "KANA", "LATIN", "", "DEVANAGARI"]


def test_rules_on_odd_rows(odd, empty):
    rows = quality_rules.judge(quality_rules.measure(odd, keep_text=True), measures="_measures").collect()
    assert len(rows) == len(ROWS) and own_columns_are_kept(rows)
    _check_measures(rows, lambda r: r.text)
    assert all(r["_base_failed"] and not r["_kept"] for r in rows if r.doc_id in (2, 3, 4, 8))
    assert quality_rules.judge(quality_rules.measure(empty), measures="_measures").count() == 0
    kept = quality_rules.keep_good(odd).collect()
    assert own_columns_are_kept(kept) and quality_rules.keep_good(empty).count() == 0 and all(len(brute.space_words(r.text)) >= 20 for r in kept)


# ---- quality classifier ----------------------------------------------------

def test_sum_of_squares_identity():
    r = np.random.default_rng(0)
    words, width = 1 << quality_classifier.WORD_BITS, len(quality_classifier.STRUCTURE)
    linear, factors = r.normal(size=words + width), r.normal(size=(words + width, quality_classifier.FACTORS))
    x = r.normal(size=(2, width))
    row, column, value = np.array([0, 0, 0, 1]), np.array([1, 7, 99, 7]), r.normal(size=4)
    z, _ = quality_classifier._forward(0.5, linear, factors, x, row, column, value)
    for t in (0, 1):
        full = {**{c: v for a, c, v in zip(row, column, value) if a == t}, **{words + j: x[t, j] for j in range(width)}}
        pairs = sum(full[i] * full[j] * factors[i] @ factors[j] for i in full for j in full if i < j)
        assert z[t] == pytest.approx(0.5 + sum(v * linear[i] for i, v in full.items()) + pairs)


def test_classifier_on_held_out_rows(spark, docs):
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet")
    texts = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text")
    model = quality_classifier.fit(texts, labels)
    rows = quality_classifier.score(texts, model, keep_text=False).withColumn("out", quality_classifier.held_out()).join(labels, "doc_id").collect()
    assert all(r.out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    out = [r for r in rows if r.out]
    assert sum((r.score >= 0.5) == (r.quality == 1) for r in out) >= 0.95 * len(out)
    again = quality_classifier.fit(texts.repartition(5), labels.repartition(2))
    assert again.bias == model.bias and (again.linear == model.linear).all()


def test_classifier_on_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1), (5, 0), (6, None), (99, 1), (None, 0), (7, 0), (9, 1), (9, 1)], "doc_id long, quality int")
    model = quality_classifier.fit(odd, labels)
    rows = quality_classifier.score(odd, model).collect()
    assert len(rows) == len(ROWS) and own_columns_are_kept(rows) and all(0 <= r["_score"] <= 1 for r in rows)
    assert len({r["_score"] for r in rows if not brute.space_words(r.text) and not r.text}) == 1
    assert quality_classifier.score(empty, model).count() == 0
    none = quality_classifier.fit(odd, labels.limit(0))
    assert {r["_score"] for r in quality_classifier.score(odd, none).collect()} == {0.5}
    assert quality_classifier.keep_good(odd, model, threshold=0.0).columns == odd.columns


# ---- near-duplicates -------------------------------------------------------

def _classes(rows):
    return {(r[0], r[1]): r[2] for r in rows}


def test_fingerprints_and_groups_equal_brute_force(spark, docs):
    rows = simhash.near_duplicates(docs).collect()
    texts = sorted((r.doc_id, r.text) for r in docs.collect())
    prints = [brute.fingerprint(t) for _, t in texts]
    root = brute.groups(prints)
    got = {r.doc_id: (r.fingerprint & (1 << 64) - 1, r.component_id) for r in rows}
    assert got == {d: (p, texts[g][0]) for (d, _), p, g in zip(texts, prints, root)}


@pytest.mark.parametrize("light, dense", [(16, 20_000), (0, 20_000), (0, 0), (1, 4)])
def test_all_three_ways_find_every_link(spark, light, dense):
    r = random.Random(6)
    prints = set()
    for centre in [0, (1 << 64) - 1] + [r.getrandbits(64) for _ in range(8)]:
        for _ in range(25):  # chains and clouds around a centre
            flips = r.sample(range(64), r.randrange(0, 5))
            prints.add(centre ^ sum(1 << b for b in flips))
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    edges = simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long"), light=light, dense=dense)
    pairs = edges.collect()
    assert all(bin((a ^ b) & (1 << 64) - 1).count("1") <= 3 for a, b in pairs)
    roots = {x.node: x.root for x in components.connected_components(edges).collect()}
    mine, want = {}, {}
    for i, (p, g) in enumerate(zip(signed, brute.groups(prints))):
        mine.setdefault(roots.get(p, p), set()).add(i)
        want.setdefault(g, set()).add(i)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, want.values()))


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(200)] + [(1000, j) for j in range(1001, 1200)] + [(7, 7), (500, 500)]
    random.Random(7).shuffle(chain)
    got = {r.node: r.root for r in components.connected_components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, **{i: 1000 for i in range(1000, 1200)}}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates_of_odd_rows(odd, empty):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == len(ROWS)
    one = {r.doc_id: r for r in rows}
    assert one[2].fingerprint == one[3].fingerprint == one[4].fingerprint == 0
    assert {one[i].component_id for i in (2, 3, 4)} == {2} and one[6].component_id == one[7].component_id == 6
    kept = simhash.drop_near_duplicates(odd).collect()
    assert own_columns_are_kept(kept)
    # one row per group: (None, None) goes with the empty texts of 2, 3 and 4
    assert sorted(map(str, (r.doc_id for r in kept))) == sorted(["1", "2", "5", "6", "8", "9", "None"])
    assert simhash.near_duplicates(empty).count() == 0 and simhash.drop_near_duplicates(empty).count() == 0


# ---- decontamination -------------------------------------------------------

def test_leaks_equal_brute_force(spark):
    r = random.Random(8)
    vocabulary = [f"w{i}" for i in range(40)] + ["été", "A1"]
    text = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    items = [(i, text(r.choice((3, 5, 6, 9, 17, 40)))) for i in range(60)] + [(90, None), (91, ""), (92, "too few words"), (93, "one two three four five")]
    docs = []
    for d in range(150):
        words = text(r.randrange(0, 300)).split()
        for _ in range(r.randrange(0, 3)):
            part = (r.choice(items)[1] or "").split()
            for _ in range(r.choice((0, 0, 1, 2))):
                if part:
                    part[r.randrange(len(part))] = "changed"
            at = r.randrange(len(words) + 1)
            words[at:at] = [p.upper() + r.choice(["", ",", "!"]) for p in part]
        docs.append((d, " ".join(words)))
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = brute.leaks(docs, items)
    for bits in (24, 8):  # a bitmap that lets nearly everything through changes nothing
        got = {(x.doc_id, x.item_id): (x.n_shared, x.n_shingles) for x in decontaminate.find_leaks(*frames, bits=bits).collect()}
        assert got == want and len(want) > 40
    left = {x.doc_id for x in decontaminate.drop_leaks(*frames).collect()}
    assert left == {d for d, _ in docs} - {d for d, _ in want}


def test_leaks_of_odd_rows(spark, odd, empty):
    items = spark.createDataFrame([(1, "a row without an id, but with"), (2, "lorem ipsum dolor sit amet"), (3, "x")], "item_id long, text string")
    got = {(x.doc_id, x.item_id) for x in decontaminate.find_leaks(odd, items).collect()}
    assert got == {(None, 1), (5, 2)}
    left = decontaminate.drop_leaks(odd, items).collect()
    assert own_columns_are_kept(left) and len(left) == len(ROWS) - 2  # the other row without id stays
    short = spark.createDataFrame([(4, "ipsum DOLOR"), (5, "words!"), (6, "x y"), (7, None)], "item_id long, text string")
    found = {(x.doc_id, x.item_id, x.shingle_words) for x in decontaminate.find_leaks(odd, short).collect()}
    assert found == {(5, 4, 2), (6, 5, 1), (7, 5, 1), (None, 5, 1)}
    assert len(decontaminate.drop_leaks(odd, short).collect()) == len(ROWS) - 5
    assert decontaminate.drop_leaks(odd, short, min_words=5).count() == len(ROWS)
    assert decontaminate.find_leaks(empty, items).count() == 0 and decontaminate.find_leaks(odd, items.limit(0)).count() == 0
    assert decontaminate.drop_leaks(odd, items.limit(0)).count() == len(ROWS)


# ---- language model --------------------------------------------------------

def test_model_equals_brute_force(spark, monkeypatch):
    texts = random_texts(300, 9) + [None, "", "never seen words"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    rows, model = language_model.score_texts(docs, language_model.learns_from())
    learnt = [t for i, t in enumerate(texts) if zlib.crc32(str(i).encode()) % 7 != 2]
    want = brute.Bigrams(learnt)
    assert (model.total, model.distinct) == (want.total, want.distinct)
    found = rows.collect()
    assert len(found) == len(texts)
    for r in found:
        t = texts[r.doc_id]
        assert r.learn == (zlib.crc32(str(r.doc_id).encode()) % 7 != 2)
        assert (r.n_tokens, r.n_known) == (len(want.tokens(t)), want.known(t))
        assert r.base_score == pytest.approx(want.base(t)) and r.score == pytest.approx(want.score(t, model.weights))
    assert np.allclose(model.weights.sum(1), 1) and (model.weights[:, 2] > 0).all()


def test_weights_are_a_fixed_point_of_em():
    cells = np.array([(3 << 40) | ((-8 + 2048) << 20) | (20 + 2048), (3 << 40) | ((-1000 + 2048) << 20) | (8 + 2048)])
    times = np.array([30, 70])
    lam = language_model.learn_weights(cells, times, 1000, 50, rounds=4000)[3]
    p = np.array([[2.0 ** -2, 2.0 ** 5 / 999, 1 / 51], [0.0, 2.0 ** 2 / 999, 1 / 51]])
    share = p * lam / (p * lam).sum(1, keepdims=True)
    assert lam == pytest.approx((times[:, None] * share).sum(0) / 100, abs=1e-6)


def test_model_on_odd_rows(odd, empty):
    rows, model = language_model.score_texts(odd, language_model.learns_from())
    rows = rows.collect()
    assert len(rows) == len(ROWS) and all(r.score <= 0 and r.base_score <= 0 for r in rows)
    assert sorted(r.n_tokens for r in rows) == sorted(len(brute.space_words(t)) + 1 for _, t, _, _ in ROWS)
    rows, model = language_model.score_texts(empty, language_model.learns_from())
    assert rows.count() == 0 and model.total == 0
    rows, model = language_model.score_texts(odd, F.lit(False))
    assert all(r.n_known == 0 and r.score == 0 and r.base_score == 0 for r in rows.collect()) and model.total == 0
