"""Mixing, packing, token files and the pipeline."""

import random
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from llm_rows import rows_of, words

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from check import compare
from watchledger.llm import mixing, orc_tokens, packing

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op5_exact_dedup", "op6_jaccard_join", "op7_mixing"])
def test_equals_duckdb(spark, name):
    assert compare(spark, name, queries()[name], oracle_sql()[name], SMALL).startswith("ok")


# --- mixing --------------------------------------------------------------------------------------


def targets_by_hand(sizes):
    """sizes: source -> words."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    free, target, left = set(order), {}, float(sum(sizes.values()))
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 3 * sizes[s]}
        if not over:
            return target | {s: level * weight[s] for s in free}
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        free -= over
    return target


def test_targets_and_draws(documents, hostile, clashing):
    rows = hostile + [(1000 + i, words(i, 200), "en", "big") for i in range(400)] + [(3000 + i, words(i, 20), "en", f"s{i % 7}") for i in range(300)]
    report = mixing.mixing_report(clashing(documents(rows)))
    got = report.collect()
    size = Counter()
    for r in rows:
        size[r[3]] += len((r[1] or "").encode().split())
    want = targets_by_hand(size)
    by_id = {r[0]: r for r in rows}
    taken = Counter()
    for r in got:
        source = by_id[r["doc_id"]][3]
        assert r["taken"] in {r["size"] * k for k in range(4)}
        if r["doc_id"] is not None:
            assert r["source_size"] == size[source] and r["target"] == pytest.approx(want[source])
            taken[source] += r["taken"]
    assert len(got) == len(rows) and sum(want.values()) == pytest.approx(sum(size.values()))
    assert abs(taken["big"] - want["big"]) < 0.1 * want["big"]
    assert rows_of(report, "doc_id", "taken") == rows_of(mixing.mixing_report(clashing(documents(rows, 5))), "doc_id", "taken")
    mix = mixing.mix(clashing(documents(rows)))
    assert mix.columns == clashing(documents(rows)).columns
    assert Counter(r["doc_id"] for r in mix.collect()) == Counter({k: v for k, v in _copies(got).items() if v})


def _copies(got):
    out = Counter()
    for r in got:
        out[r["doc_id"]] += r["copies"]
    return out


def test_mixing_without_words(documents):
    assert mixing.mixing_report(documents([])).count() == 0 and mixing.mix(documents([])).count() == 0
    assert rows_of(mixing.mixing_report(documents([(1, None), (2, " ")])), "doc_id", "target", "taken") == [(1, 0.0, 0), (2, 0.0, 0)]


# --- packing -------------------------------------------------------------------------------------


def padding(lengths, counts, ends):
    return sum(c * (min(e for e in ends if e >= n) - n) for n, c in zip(lengths, counts))


def test_boundaries_are_optimal():
    rng = random.Random(4)
    for _ in range(60):
        lengths = sorted(rng.sample(range(1, 40), rng.randrange(1, 9)))
        counts = [rng.randrange(1, 50) for _ in lengths]
        k = rng.randrange(1, 5)
        ends = packing.best_boundaries(lengths, counts, k)
        best = min(padding(lengths, counts, [*c, lengths[-1]]) for m in range(min(k, len(lengths))) for c in combinations(lengths[:-1], m))
        assert len(ends) <= k and ends[-1] == lengths[-1] and padding(lengths, counts, ends) == best


def test_packing(documents, hostile, clashing):
    out = packing.pack(clashing(documents(hostile)), context=64, buckets=3, budget=256).collect()
    whole = defaultdict(list)
    for r in out:
        whole[r["doc_id"]].append((r["first_token"], r["n_tokens"]))
        assert r["n_tokens"] <= r["padded_length"] <= 64
    expected = Counter()
    for r in hostile:
        expected[r[0]] += len((r[1] or "").encode().split()) + 1
    assert {i: sum(n for _, n in v) for i, v in whole.items()} == expected
    assert all(sorted(v)[i + 1][0] == sorted(v)[i][0] + sorted(v)[i][1] for k, v in whole.items() if k in (1, 4, 5) for i in range(len(v) - 1))
    for bucket in {r["bucket"] for r in out}:
        rows = sorted((r["batch"], r["slot"]) for r in out if r["bucket"] == bucket)
        room = 256 // next(r["padded_length"] for r in out if r["bucket"] == bucket)
        assert rows == [(i // room, i % room) for i in range(len(rows))]
    assert packing.pack(documents([])).count() == 0
    with pytest.raises(ValueError):
        packing.pack(documents([]), context=64, budget=10)


# --- tokens --------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(orc_tokens.tokenizer_file())


def test_encoder_equals_the_library(tokenizer):
    plain = lambda t: np.asarray(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
    encode = orc_tokens.Encoder(orc_tokens.tokenizer_file(), cache=50)
    rng, parts = random.Random(3), [" ", "  ", "\n", " \n", "'s", "'", "a", "B", "é", "ß", "1", "９", ",", "...", "<|endoftext|>", "<|", "\t", " ", "中", "\U0001f600", "́", "\x1c", "_", "word", "ing"]
    for t in ["", " ", "a  b", " a", "don't  it's\t x", "é ü 　 z", "word" * 3000, *("".join(rng.choices(parts, k=rng.randrange(14))) for _ in range(3000))]:
        assert encode(t) == plain(t), repr(t)


def test_ascii_parts_are_the_pre_tokenizers(tokenizer):
    """What the fast path for ASCII cuts and maps, byte by byte and in odd company."""
    rng, encode = random.Random(5), orc_tokens.Encoder(orc_tokens.tokenizer_file(), cache=50)
    some = [chr(c) for c in range(128)] + ["'s", "'ll", "'re", "'VE", "ab", "12", "$$$", "\n\n"]
    for t in [*some, *("".join(rng.choices(some, k=rng.randrange(1, 9))) for _ in range(3000))]:
        assert "<|" in t or orc_tokens._ASCII_PART.findall(t) == orc_tokens._PART.findall(t), repr(t)
        assert encode(t) == np.asarray(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes(), repr(t)
    assert sorted(encode.letter) == sorted(set(encode.letter)) and len(encode.letter) == 256


def test_other_tokenizers_go_through_the_library():
    from tokenizers import Tokenizer

    path = orc_tokens.tokenizer_file("word_bpe_49k.json")
    assert orc_tokens.cuts_at_spaces(orc_tokens.tokenizer_file()) and not orc_tokens.cuts_at_spaces(path)
    library, encode = Tokenizer.from_file(path), orc_tokens.Encoder(path)
    for t in ["", " ", "Two  words", " Ünïcode and more, don't\n", "a b c" * 50]:
        assert encode(t) == np.asarray(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes()


@pytest.mark.parametrize("file", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_blocks_equal_the_library(file):
    import pyarrow as pa
    from tokenizers import Tokenizer

    path = orc_tokens.tokenizer_file(file)
    library, encode = Tokenizer.from_file(path), orc_tokens.Encoder(path, cache=60)
    rng, parts = random.Random(4), [" ", " ", "  ", "\n", "\xa0", "\u3000", "\x1c", "\x85", "é", "été", "naïve,", "word", "Word.", "x1", "中", "'s", "<|endoftext|>", "ǅ", "ɐ"]
    texts = [None, "", " ", "a", " a b", *("".join(rng.choices(parts, k=rng.randrange(20))) for _ in range(1500))]
    column = pa.array(["skipped", *texts], pa.string()).slice(1)
    want = [library.encode(t or "", add_special_tokens=False).ids + [orc_tokens.END_ID] for t in texts]
    assert encode.lists(column).to_pylist() == want
    assert encode.lists(pa.array([], pa.string())).to_pylist() == []


def test_files_round_trip(spark, documents, hostile, clashing, tokenizer, tmp_path):
    out = str(tmp_path / "tokens")
    orc_tokens.write_tokens(clashing(documents(hostile)), out)
    files = orc_tokens.read_tokens(spark, out)
    ids = {(r["doc_id"], r["place"], r["shard"]): r["ids"] for r in files.collect()}
    texts = sorted(((r[0], r[1] or "") for r in hostile), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = [(i, tokenizer.encode(t, add_special_tokens=False).ids + [orc_tokens.END_ID]) for i, t in texts]
    assert sorted(ids.values()) == sorted(x for _, x in want)
    report = sorted((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in orc_tokens.token_report(files).collect())
    start, expected = 0, []
    for i, x in want:
        expected.append((start, i, len(x), zlib.crc32(np.asarray(x, "<u4").tobytes())))
        start += len(x)
    assert [(a, c, d) for a, _, c, d in report] == [(a, c, d) for a, _, c, d in expected]
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,5)]" in files.where("doc_id = 5")._jdf.queryExecution().executedPlan().toString()
    assert files.where("doc_id = 5").count() == 1


def test_bloom_filters_and_indexes_are_in_the_files(spark, documents, tmp_path):
    from pyarrow import orc

    out = tmp_path / "tokens"
    orc_tokens.write_tokens(documents([(i, words(i, 5)) for i in range(3000)]), str(out))
    file = orc.ORCFile(max(out.glob("*.orc"), key=lambda p: p.stat().st_size))
    assert file.row_index_stride == orc_tokens.INDEX_ROWS and file.compression == "ZSTD"
    assert file.nstripe_statistics >= 1 and file.stripe_statistics_length > 0


def test_tokens_of_empty_table(documents):
    assert orc_tokens.tokens_written(documents([])).count() == 0
    assert rows_of(orc_tokens.tokens_written(documents([(1, None)])), "doc_id", "start", "n_tokens") == [(1, 0, 1)]


# --- pipeline ------------------------------------------------------------------------------------


def test_stages_keep_clean_documents(spark, documents, hostile, clashing):
    docs = clashing(documents(hostile + [(100 + i, words(100 + i, 50), "en", "a") for i in range(20)]))
    for name, stage in corpus_pipeline.STAGES[:-2]:
        kept = stage(spark, docs, SMALL)
        assert kept.columns == docs.columns, name
        assert {100 + i for i in range(20)} <= {r["doc_id"] for r in kept.collect()}, name


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
        path = corpus_pipeline.new_path(spark, f"test-{name}")
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        seen[name] = docs.count()
    assert rows_of(docs, "doc_id", "piece", "bucket", "batch", "slot") == rows_of(corpus_pipeline.run(spark, SMALL), "doc_id", "piece", "bucket", "batch", "slot")
    assert seen["exact_dedup"] >= seen["jaccard_join"] > 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "jaccard_join", "mixing", "packing"]


def test_stages_on_empty_tables(spark, documents):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, documents([]), SMALL).count() == 0, name


# --- batches -------------------------------------------------------------------------------------


def test_blocks_are_bounded_by_bytes_whatever_the_batches(monkeypatch):
    import pyarrow as pa

    from watchledger.llm import common

    texts = [None, "", "a" * 7, "b" * 30, "c" * 4, "d" * 4, "", "e", None, "f" * 9, *["g"] * 9]
    for size in (1, 2, 3, 50):
        for limit, most in ((10, 10_000), (10, 4), (1, 3), (1 << 20, 10_000)):
            monkeypatch.setattr(common, "BLOCK_ROWS", most)
            batches = pa.table({"n": range(len(texts)), "text": pa.array(texts, pa.string())}).to_batches(max_chunksize=size)
            found = list(common.blocks([batches[0].slice(0, 0), *batches], limit=limit))
            assert [r for b in found for r in b.to_pylist()] == [{"n": n, "text": t} for n, t in enumerate(texts)]
            held = [[len(t or "") for t in b.column("text").to_pylist()] for b in found]
            assert all(len(h) <= most and (sum(h) <= limit or sum(map(bool, h)) == 1) for h in held)
            if (limit, most) == (1 << 20, 10_000):
                assert len(found) == 1
    assert list(common.blocks([])) == []


def test_corpus_work_gets_small_arrow_batches(spark, documents):
    """Before, a batch held 10,000 texts: over 0.5 GB an executor and its workers went beyond 3000 MB."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        for name, stage in corpus_pipeline.STAGES:
            spark.conf.set(key, "10000")
            stage(spark, documents([(1, words(1, 20), "en", "a")]), SMALL)
            assert int(spark.conf.get(key)) <= 1_000, name
        spark.conf.set(key, "50")
        entry = __import__("__spark_entry__").queries()
        entry["op3_html_text"](spark, SMALL)
        assert spark.conf.get(key) == "50"  # a smaller setting stays
        spark.conf.set(key, "0")
        entry["op3_html_text"](spark, SMALL)
        assert 0 < int(spark.conf.get(key)) <= 1_000
    finally:
        spark.conf.set(key, before)


def test_token_report_reads_the_files_once(spark, documents, tmp_path, monkeypatch):
    """Before, the shards' sums and the documents each decoded all ids."""
    out = str(tmp_path / "tokens")
    orc_tokens.write_tokens(documents([(i, words(i, 20)) for i in range(50)]), out)
    report = orc_tokens.token_report(orc_tokens.read_tokens(spark, out))
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and "orc" not in plan.lower().replace("force", "")
    assert report.count() == 50
