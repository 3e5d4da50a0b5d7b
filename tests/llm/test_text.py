"""Language, language model, page text and quality rules."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import zstandard
from llm_rows import rows_of, words
from pyspark.sql import functions as F

from watchledger.llm import class_lm, html_text, language_id, quality_bands
from watchledger.llm.queries import op10_quality_bands, op1_language_id

SMALL = "/root/testdata/sf0.001"

# --- language ------------------------------------------------------------------------------------

ENGLISH = ["the cat sat on the mat and then it went home", "there is nothing that they would rather have than this", "when the weather is good the other people walk there"]
GERMAN = ["der hund liegt auf der decke und schläft dann ein", "es gibt nichts was sie lieber hätten als dieses", "wenn das wetter schön ist gehen die anderen dorthin"]


def grams_by_hand(text):
    out = Counter()
    for word in "".join(c if c.isalpha() else " " for c in text.lower()).split():
        out.update(word)
        framed = f" {word} "
        out.update(framed[i : i + 2] for i in range(len(framed) - 1))
        out.update(framed[i : i + 3] for i in range(len(framed) - 2))
    return out


def as_text(gram):
    letters = []
    while gram:
        gram, letter = divmod(gram, 1 << 21)
        letters.append(chr(letter) if letter else " ")
    return "".join(reversed(letters))


def test_grams_are_those_of_framed_words():
    text = "Über den-Fluß, 3 mal!"
    found = Counter(as_text(int(g)).strip() for g in language_id.grams(language_id.Letters()(text)))
    want = Counter()
    for gram, n in grams_by_hand(text).items():
        want[gram.strip()] += n
    assert found == want


def test_language_of_small_sets(documents, clashing):
    rows = [(i, t, "en") for i, t in enumerate(ENGLISH)] + [(10 + i, t, "de") for i, t in enumerate(GERMAN)]
    profiles = language_id.learn_profiles(clashing(documents(rows)))
    asked = [(1, "they have nothing there", None), (2, "sie hätten nichts", None), (3, None, "en"), (4, "12 !? 34", "en"), (5, "", None), (5, "", None), (None, "the other cat", None)]
    found = language_id.predict(clashing(documents(asked)), profiles)
    assert rows_of(found, "doc_id", "lang_pred") == sorted([(1, "en"), (2, "de"), (3, "und"), (4, "und"), (5, "und"), (5, "und"), (None, "en")], key=repr)
    assert all(0 <= r["score"] <= 1 for r in found.collect())
    assert {r["doc_id"] for r in language_id.in_a_language(documents(asked), profiles).collect()} == {1, 2, None}


def test_no_labels_no_language(documents):
    assert language_id.learn_profiles(documents([])) == {}
    assert rows_of(language_id.predict(documents([(1, "some words")]), {}), "lang_pred", "score") == [("und", 0.0)]


def test_learning_holds_the_grams_of_few_texts(documents, monkeypatch):
    """The n-grams that are sorted together come from ``COUNTED_BYTES`` of text, and the profiles are those of all texts."""
    docs = documents([(i, words(i, 400), "ab"[i % 2] * 2) for i in range(60)], partitions=1)
    want = language_id.learn_profiles(docs, train_docs=None)
    monkeypatch.setattr(language_id, "COUNTED_BYTES", 5_000)
    assert {k: v.tolist() for k, v in language_id.learn_profiles(docs, train_docs=None).items()} == {k: v.tolist() for k, v in want.items()}
    assert len(list(language_id.blocks([docs.select("text").toArrow().combine_chunks().to_batches()[0]], limit=language_id.COUNTED_BYTES))) > 20


def test_ties_go_to_the_first_language():
    same = np.asarray([ord("a")], np.int64)
    assert language_id.Classifier({"b": same, "a": same})("aaa")[0] == "a"


def test_held_out_accuracy(spark):
    found = op1_language_id(spark, SMALL).join(spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang"), "doc_id")
    out = found.where("held_out").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in found.collect())
    assert np.mean([r["lang_pred"] == r["lang"] for r in out]) > 0.95


# --- language model ------------------------------------------------------------------------------


def base_by_hand(rows):
    tokens = [(r[0], (r[1] or "").encode().lower().split() + [None]) for r in rows]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    c = Counter(t for i, ts in tokens if not held(i) for t in ts)
    n, v = sum(c.values()), len(c)
    return sorted(((i, held(i), len(ts), sum(c[t] > 0 for t in ts), n, round(sum(math.log10((c[t] + 1) / (n + v + 1)) for t in ts), 6)) for i, ts in tokens), key=repr)


@pytest.mark.parametrize("head", [3, 100_000])
def test_base_scores(documents, hostile, clashing, head, monkeypatch):
    monkeypatch.setattr(class_lm.vocabulary, "__defaults__", (head, min(head, 20), 5))
    found = class_lm.class_lm_scores(clashing(documents(hostile)))
    got = [(*r[:5], round(r[5], 6)) for r in rows_of(found, "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score")]
    want = base_by_hand(hostile)
    assert [r[:5] for r in got] == [r[:5] for r in want] and [r[5] for r in got] == pytest.approx([r[5] for r in want])
    assert all(r["score"] < 0 and r["perplexity"] > 1 for r in found.collect())


def test_model_adds_up_to_one():
    """Known words and one unseen slot per class share the probability after any word."""
    vocab = class_lm.Vocabulary([b"the", b"cat", b"dog"], np.asarray([5, 3, 2]), {b"at": 3, b"og": 4}, 3)
    of = np.asarray([0, 1, 1, 0, 1, 0, 2])
    classes = of[[vocab.units([w])[1][0] for w in vocab.words]]
    counts = np.asarray([5, 5, 4])
    distinct = np.asarray([1, 2, 1])
    norm = np.log10(counts + distinct + 1)
    emitted = np.zeros(3)
    for k, w in zip(classes, vocab.counts):
        emitted[k] += (w + 1) / 10 ** norm[k]
    emitted[2] += (4 + 1) / 10 ** norm[2]
    assert emitted + 1 / 10**norm == pytest.approx(np.ones(3))


def likelihood(counts, of):
    table = np.zeros((3, 3))
    np.add.at(table, (of[:, None], of[None, :]), counts)
    f = lambda x: (x * np.log(np.maximum(x, 1))).sum()
    return f(table) - f(table.sum(axis=0)) - f(table.sum(axis=1))


def test_exchange_raises_the_likelihood():
    rng = np.random.default_rng(3)
    kind = np.asarray([i % 2 for i in range(20)] + [2])
    counts = np.where(kind[:, None] != kind[None, :], rng.integers(50, 60, (21, 21)), rng.integers(0, 2, (21, 21)))
    of = class_lm.exchange(counts, classes=2)
    assert of[20] == 2 and len(set(zip(of[:20].tolist(), kind[:20].tolist()))) == 2
    # No single move is better: every gain that the sweeps use is the change of the likelihood.
    moved = [np.where(np.arange(21) == u, 1 - of, of) for u in range(20)]
    assert all(likelihood(counts, m) <= likelihood(counts, of) for m in moved)


def test_class_model_beats_the_unigram(spark):
    scored = class_lm.class_lm_scores(spark.read.parquet(f"{SMALL}/documents.parquet")).where("held_out").collect()
    assert sum(r["score"] for r in scored) > sum(r["base_score"] for r in scored)


def test_language_model_on_empty_and_untrained(documents):
    assert class_lm.class_lm_scores(documents([])).count() == 0
    two = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    r = class_lm.class_lm_scores(documents([(two, "a b")])).first()
    assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) == (3, 0, 0, 0.0, 0.0)


# --- pages ---------------------------------------------------------------------------------------

PAGE = (
    '<html><head><title>T</title><style>p{}</style><script>var a="</p><b>";</script></head><body><div class="menu"><ul><li><a href="/a">Home</a></li><li><a href="/b">About us</a></li></ul></div>'
    "<!-- c --><{0}><h1>A  long\n spring</h1><p>The river rose &amp; fell. Nobody could remember&nbsp;it so <b>high<br>or</b> so wild.<p>Engineers measured the dam twice a day, and wrote it down.</p>"
    '<section class="comments"><div class="comment"><p>First! I do not agree with any of this, it is all wrong.</p></div></section></{1}>'
    '<div class="cookie-notice"><p>We use cookies. Accept?</p></div><form><label>Search</label><input name="q"></form><footer>&copy; <a href="/c">Imprint</a></footer></body></html>')
TEXT = "A long spring\nThe river rose & fell. Nobody could remember it so high or so wild.\nEngineers measured the dam twice a day, and wrote it down."


@pytest.fixture(scope="module")
def page_model(spark):
    return html_text.fit(spark.read.parquet(f"{SMALL}/pages.parquet"))


def test_page_text(spark, page_model):
    rows = [(1, "u", PAGE.replace("{0}", "article").replace("{1}", "article")), (2, "u", PAGE.replace("{0}", 'div class="post-content"').replace("{1}", "div")), (3, None, None), (4, "u", ""), (5, "u", "<p"),
            (None, "u", "<div " + "x" * 50_000), (6, "u", "<div>" * 2000), (6, "u", "<div>" * 2000)]
    pages = spark.createDataFrame([(*r, "own") for r in rows], "page_id long, url string, html string, text string")
    found = {r["page_id"]: r for r in html_text.extract(pages, page_model).collect()}
    assert found[1]["text"] == TEXT and found[2]["text"] == TEXT and found[1]["n_chars"] == len(TEXT)
    assert all(found[i]["text"] == "" and found[i]["n_chars"] == 0 for i in (3, 4, 5, 6))
    assert html_text.extract(pages.where("false"), page_model).count() == 0 and html_text.extract(pages, page_model).count() == len(rows)


def test_formulas_and_figure_labels_are_text(spark, page_model):
    body = "".join(f"<p>{words(40 + i, 60)}.</p>" for i in range(4))
    page = f"<html><body><article><h1>Sums</h1>{body}<p>It follows from <math><mi>a</mi><mo>+</mo><mi>b</mi></math> which <svg><title>t</title><text>Figure label</text></svg> shows.</p></article></body></html>"
    found = html_text.extract(spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string"), page_model).first()["text"]
    assert "It follows from a+b which Figure label shows." in found


def test_fit_on_tables_without_articles(spark):
    weights, edges = html_text.fit(spark.createDataFrame([], "page_id long, url string, html string"))
    assert np.isfinite(weights).all() and np.isfinite(edges).all()


def test_marginals_equal_enumeration(page_model):
    page = html_text.parse("<body><div class='ad'><p>one</p></div><article><p>two words.</p></article></body>")
    forest = html_text.Forest.of([page])
    weights, edges = page_model
    unary = weights[forest.slots].sum(axis=1) + forest.names @ weights[html_text._AT[-1] :]
    n, total, ones = len(page.tags), 0.0, np.zeros(len(page.tags))
    for bits in range(1 << n):
        y = [(bits >> i) & 1 for i in range(n)]
        weight = math.exp(sum(unary[i] * y[i] for i in range(n)) + sum(edges[forest.kinds[i], y[page.parents[i]], y[i]] for i in range(1, n)))
        total += weight
        ones += weight * np.asarray(y)
    assert html_text.sum_product(forest, weights, edges)[0][:, 1] == pytest.approx(ones / total)


def test_held_out_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").orderBy("page_id").limit(60).collect()
    model = html_text.train(*html_text.training_set([r["html"] for r in pages[:30]]))
    for r in pages[30:]:
        page = html_text.parse(r["html"])
        marginals, _ = html_text.sum_product(html_text.Forest.of([page]), *model)
        y = html_text.marked(page)
        assert ((marginals[:, 1] > 0.5) == y).all()


# --- quality -------------------------------------------------------------------------------------


def quality_by_hand(text):
    text = text or ""
    w = [x for x in __import__("re").split(r"[ \t\n\x0b\x0c\r]+", text) if x]
    grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {i + k for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), len(w) < 10 or 100 * len(covered) > 20 * len(w)


def test_quality_figures(documents, hostile, clashing):
    more = [(50, "a b\na b\n \na b c d e\na b c d e f", "en"), (51, words(1, 50) + " # * $ <b> " + words(1, 50), "en"), (52, "x " * 5000, "en"), (53, "no break " * 12, "en")]
    rows = hostile + more
    found = quality_bands.quality_bands(clashing(documents(rows)))
    want = sorted(((r[0], *quality_by_hand(r[1])) for r in rows), key=repr)
    assert rows_of(found, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed") == want
    assert quality_bands.quality_bands(documents([])).count() == 0


def test_bands_reject_repetition_and_noise_and_keep_prose(spark):
    rng = np.random.default_rng(5)
    z = zstandard.ZstdCompressor(level=quality_bands.LEVEL)
    prose = [r["text"].encode() for r in spark.read.parquet(f"{SMALL}/documents.parquet").join(spark.read.parquet(f"{SMALL}/labels.parquet").where("quality = 1"), "doc_id").collect()]
    for t in prose:
        v = quality_bands.verdict(t, z)
        assert v[5] or v[6]
    noise = " ".join("".join(chr(c) for c in rng.integers(33, 0x24F, 12)) for _ in range(800)).encode()
    repeated = b" ".join(b"all work and no play number%d" % (i % 3) for i in range(400))
    near = b" ".join(b"line%d of the same thing again" % i for i in range(2000))
    assert not any(quality_bands.verdict(t, z)[6] for t in (noise, repeated, near, b"", b"a few words"))


NOISE = {"base64": (130, "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"), "printable": (130, "".join(map(chr, range(33, 127)))), "hex": (4096, "0123456789abcdef")}


@pytest.mark.parametrize("kind", NOISE)
def test_bands_reject_noise_of_any_length(spark, kind):
    """From the length on at which prose compresses better (hex digits: 4 KB), alone and as a tail of a quarter or more."""
    least, alphabet = NOISE[kind]
    rng = np.random.default_rng(6)
    z = zstandard.ZstdCompressor(level=quality_bands.LEVEL)

    def noise(n):
        return " ".join("".join(rng.choice(list(alphabet), rng.integers(4, 11))) for _ in range(n // 5 + 3))[:n].encode()

    for n in (100, 130, 200, 512, 1024, 2000, 3072, 4096, 5000, 16_000, 40_000, 100_000):
        if n >= least:
            assert not quality_bands.verdict(noise(n), z)[6], n
    texts = (r["text"].encode() for r in spark.read.parquet(f"{SMALL}/documents.parquet").join(spark.read.parquet(f"{SMALL}/labels.parquet").where("quality = 1"), "doc_id").collect())
    prose = next(t for t in texts if len(t) > 4096 and quality_bands.verdict(t, z)[6])[:4096]
    assert quality_bands.verdict(prose, z)[6]
    for n in (3500, 6000, 20_000, 100_000):
        assert not quality_bands.verdict(prose + noise(n), z)[6], n
    assert quality_bands.ratios(prose + noise(3500), z)[1:] == (2, 1, 3500)


def test_learned_bands(spark, documents):
    """Limits follow the labelled rows; planted repetition below them goes, clean rows of the same kind stay."""
    clean = [(i, words(i, 20 + i % 300), "en", "a") for i in range(600)]
    labels = spark.createDataFrame([(i, int(i < 600), 0) for i in range(620)], "doc_id long, quality int, toxic int")
    bands = quality_bands.learn_bands(documents(clean), labels)
    assert all(0 < lo < hi < 1.5 for _, lo, hi in bands.whole) and bands.whole[-1][0] == float("inf")
    fresh = [(1000 + i, words(5000 + i, 20 + i % 300), "en", "a") for i in range(200)]
    few = [(2000 + i, " ".join(f"{w}{i}" for w in random.Random(i).choices(["alpha", "beta", "gamma", "delta"], k=300)), "en", "a") for i in range(20)]
    kept = {r["doc_id"] for r in quality_bands.quality_bands(documents(fresh + few), bands).where("kept").collect()}
    assert len(kept & {r[0] for r in fresh}) >= 190 and not kept & {r[0] for r in few}
    assert quality_bands.learn_bands(documents(clean), labels.where("quality > 1")) == quality_bands.DEFAULT
    assert quality_bands.learn_bands(documents([]), labels) == quality_bands.DEFAULT


def test_query_bands_equal_brute_force(spark):
    """The query's verdicts from the limits written out as loops over the same training rows."""
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    docs = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    z = zstandard.ZstdCompressor(level=3)
    ratio = lambda t: len(z.compress(t)) / len(t)
    train = []
    for i, t in docs.items():
        if labels.get(i) == 1 and zlib.crc32(str(i).encode()) % 4 != 2 and t and not quality_by_hand(t.decode())[-1]:
            train.append((len(t), ratio(t), [ratio(t[k : k + 4096]) for k in range(0, len(t) - 4095, 4096)]))
    train.sort(key=lambda r: r[0])
    least = np.quantile([min(c) for *_, c in train if c], 0.01)
    most = np.quantile([max(c) for *_, c in train if c], 0.999)

    def limits(n):
        c = int(8 * np.log2(train[0][0]))
        while c < int(8 * np.log2(train[-1][0])) and n > 2 ** ((c + 1) / 8):
            c += 1
        inside = [k for k, r in enumerate(train) if 2 ** (c / 8) <= r[0] < 2 ** ((c + 1) / 8)]
        a = inside[0] if inside else sum(r[0] < 2 ** (c / 8) for r in train)
        short = max(0, 400 - len(inside))
        near = [r[1] for r in train[max(0, a - (short + 1) // 2) : a + len(inside) + (short + 1) // 2]]
        return np.quantile(near, 0.01), np.quantile(near, 0.999)

    def kept(t):
        if not t or quality_by_hand(t.decode())[-1]:
            return False
        lo, hi = limits(len(t))
        bad = 0
        for k in range(0, len(t), 4096):
            c = t[k : k + 4096]
            a, b = (least, most) if len(c) == 4096 else limits(len(c))
            bad += 0 if a <= ratio(c) <= b else len(c)
        return bool(lo <= ratio(t) <= hi and bad <= 0.25 * len(t))

    got = {r.doc_id: r.kept for r in op10_quality_bands(spark, SMALL).collect()}
    assert got == {i: kept(t) for i, t in docs.items()}


def test_texts_far_from_every_profile_are_in_no_language(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    profiles = language_id.learn_profiles(docs)
    floors = language_id.score_floors(docs, profiles)
    assert set(floors) == set(profiles) and all(0.1 < f < 0.5 for f in floors.values())
    odd = ["Все счастливые семьи похожи друг на друга", "### 123 $$$", "吾輩は猫である。名前はまだ無い。", "zzxq qqzx xzqq vvkx"]
    rows = spark.createDataFrame([(-1 - i, t, None, None, len(t)) for i, t in enumerate(odd)], docs.schema)
    kept = {r["doc_id"] for r in language_id.in_a_language(docs.unionAll(rows), profiles, floors).collect()}
    assert kept == {r["doc_id"] for r in docs.where("text rlike '\\\\p{L}'").collect()}


def test_floors_come_from_all_labelled_documents(spark):
    """More documents than a sample of the profiles holds: the floor is the quantile of every one's score."""
    text = F.concat_ws(" ", F.lit("the river rose and fell again"), *[F.substring(F.md5(F.concat_ws(":", F.col("id").cast("string"), F.lit(str(i)))), 1, 7) for i in range(5)])
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), text.alias("text"), F.when(F.col("id") % 5 < 4, "en").otherwise("xx").alias("lang"))
    profiles = language_id.learn_profiles(docs, train_docs=None)
    scores = {}
    classify = language_id.Classifier(profiles)
    for r in docs.collect():
        lang, score = classify(r["text"])
        scores.setdefault(lang, []).append(score)
    assert language_id.score_floors(docs, profiles) == pytest.approx({lang: 0.5 * np.quantile(found, 0.01) for lang, found in scores.items()}, rel=1e-12)
    letters = language_id.Letters()
    every = np.concatenate([language_id.grams(letters(r["text"])) for r in docs.where("lang = 'en'").collect()])
    assert profiles["en"].tolist() == language_id.top_grams(every).tolist()


def test_bands_come_from_all_labelled_documents(spark):
    """Tens of thousands of labelled documents: every one counts, in classes of many documents and of few."""
    word = lambda i: F.substring(F.md5(F.concat_ws(":", F.col("id").cast("string"), F.lit(str(i)))), 1, 6)
    text = F.substring(F.concat_ws(" ", *[word(i) for i in range(60)]), F.lit(1), F.when(F.col("id") % 50 == 0, F.col("id") % 340 + 70).otherwise(F.col("id") % 40 + 150).cast("int"))
    docs = spark.range(24_000).select(F.col("id").alias("doc_id"), text.alias("text")).unionAll(spark.range(30).select(F.col("id") + 24_000, F.concat_ws(" ", *[word(i) for i in range(1300)])))
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    bands = quality_bands.learn_bands(docs, labels)
    z = zstandard.ZstdCompressor(level=quality_bands.LEVEL)
    ratio = lambda t: len(z.compress(t)) / len(t)
    train = []
    for r in docs.collect():
        t = r["text"].encode()
        train.append((len(t), ratio(t), [ratio(t[k : k + 4096]) for k in range(0, len(t) - 4095, 4096)]))
    train.sort()
    sizes = np.asarray([n for n, *_ in train])
    low, high = int(8 * np.log2(sizes[0])), int(8 * np.log2(sizes[-1]))
    whole = []
    for c in range(low, high + 1):
        a, end = np.searchsorted(sizes, [2 ** (c / 8), 2 ** ((c + 1) / 8)])
        short = max(0, 400 - (end - a))
        near = [r[1] for r in train[max(0, a - (short + 1) // 2) : end + (short + 1) // 2]]
        whole.append((math.inf if c == high else 2 ** ((c + 1) / 8), *np.quantile(near, [0.01, 0.999])))
    assert [len(whole), *np.ravel(bands.whole)] == pytest.approx([len(bands.whole), *np.ravel(whole)], rel=1e-12)
    chunks = [c for *_, c in train if c]
    assert bands.chunk == pytest.approx((np.quantile([min(c) for c in chunks], 0.01), np.quantile([max(c) for c in chunks], 0.999)), rel=1e-12)


def test_words_and_endings_without_a_unit_choose_their_class(documents, monkeypatch):
    """Nouns and verbs take turns; those that no unit stands for, and whose endings have none, are told apart by their neighbours."""
    rng = random.Random(8)
    nouns, verbs = ([f"{kind}{chr(97 + i)}{chr(97 + j)}" for i in range(10) for j in range(4)] for kind in "nv")
    rows = [(i, " ".join(w for _ in range(40) for w in (rng.choice(nouns[: rng.randrange(1, 41)]), rng.choice(verbs[: rng.randrange(1, 41)]))), "en") for i in range(60)]
    monkeypatch.setattr(class_lm.exchange, "__defaults__", (3, 8))
    for head in (100, 12):
        monkeypatch.setattr(class_lm.vocabulary, "__defaults__", (head, 8, 2))
        model, _ = class_lm.train(documents(rows))
        usual = lambda words: Counter(model.of_unit[model.vocab.units([w.encode() for w in words])[1]].tolist()).most_common(1)[0]
        assert len(model.vocab.endings) == 40
        if head == 100:  # but for words met once or twice
            (noun, n), (verb, v) = usual(nouns), usual(verbs)
            assert noun != verb and n >= 36 and v >= 36
    assert model.tokens == 60 * 81 and model.end_count == 60
