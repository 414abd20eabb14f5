"""Token ids, wavelet shards and packing against the tokenizers library and plain Python."""

import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from tastecore.llm import packing, wavelet
from tastecore.llm.batches import BATCH_ROWS, BATCH_SETTING, given_back, map_arrow, text_of
from tastecore.llm.token_ids import Encoder, _Places

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")
WORD, BYTE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
SIGNS = [
    "a", "B", "é", "É", " ", "  ", "\n", "\t", "'s", "1", "23", ".", ",", "<|endoftext|>", "Σ", "ß", "İ", "\xa0", "　", "\x1c",
    "漢", "😀", "_", "-", " \n", "́", "\r\n", "\x85", "I'll", "Word", "#",
]
ROWS = [(7, "One two, two.\nThree #"), (3, None), (3, ""), (None, "no id"), (12, "x y " * 4000), (5, "é ß 漢\n" * 40), (7, "One two, two.\nThree #")]


def expected_ids(path, text, end):
    ids = tokenizers.Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids
    return np.array([*ids, end], "<u4")


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_encoder_equals_library(path, monkeypatch):
    monkeypatch.setattr("tastecore.llm.token_ids.REMEMBERED", 200)
    monkeypatch.setattr("tastecore.llm.token_ids.BLOCK_BYTES", 2000)
    rng, ours = random.Random(3), Encoder(path)
    texts = [None] + ["".join(rng.choice(SIGNS) for _ in range(rng.randrange(16))) for _ in range(4000)]
    for text, ids in zip(texts, ours.encode(texts)):
        assert ids.tolist() == ours.tokenizer.encode(text or "", add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_long_and_real_texts_equal_library(path, monkeypatch):
    monkeypatch.setattr("tastecore.llm.token_ids.BLOCK_BYTES", 300)
    docs = duckdb.sql("SELECT text FROM '/root/testdata/sf0.01/documents.parquet' LIMIT 300").fetchall()
    texts = [t for (t,) in docs] + ["  ".join(t for (t,) in docs[:20] if t), "", None, "no cut" * 500, " \n" * 700, "a.\n\n b,\n" * 200]
    ours = Encoder(path)
    for text, ids in zip(texts, ours.encode(texts), strict=True):
        assert ids.tolist() == ours.tokenizer.encode(text or "", add_special_tokens=False).ids, repr(text)[:200]


def test_table_of_places_grows_with_its_keys():
    rng, table = np.random.default_rng(1), _Places()
    keys = np.unique(rng.integers(1, 1 << 62, 300_000).astype(np.uint64))
    for part in np.array_split(np.arange(len(keys)), 40):
        assert (table.find(keys[part]) == -1).all()
        table.put(keys[part], part.astype(np.int32))
        assert table.keys.nbytes + table.places.nbytes <= max(12 << 16, 12 * 2 * 8 * (part[-1] + 1) // 5)
    assert (table.find(keys) == np.arange(len(keys))).all()
    assert (table.find(keys + np.uint64(1 << 62)) == -1).all()
    table.clear()
    assert (table.find(keys) == -1).all()


def test_python_gets_small_batches_of_texts_and_gives_memory_back(spark, monkeypatch):
    given = []
    monkeypatch.setattr("tastecore.llm.batches.give_back", lambda: given.append(1))
    assert given_back(lambda group: [group])("rows") == ["rows"] and given == [1]
    monkeypatch.undo()
    before = spark.conf.get(BATCH_SETTING, None)
    try:
        for own, most in ((None, BATCH_ROWS), ("700", 700)):
            spark.conf.unset(BATCH_SETTING) if own is None else spark.conf.set(BATCH_SETTING, own)
            texts = text_of(spark.range(0, 5000, 1, 1).selectExpr("id AS doc_id", "'a' AS text"))
            sizes = map_arrow(texts, lambda parts: (p.from_pydict({"n": [p.num_rows]}) for p in parts), "n long").collect()
            assert sum(r.n for r in sizes) == 5000 and max(r.n for r in sizes) == most
    finally:
        spark.conf.unset(BATCH_SETTING) if before is None else spark.conf.set(BATCH_SETTING, before)


@pytest.mark.parametrize("distinct", [0, 1, 2, 3, 100, 70_000])
def test_wavelet_matrix(distinct):
    rng = np.random.default_rng(distinct)
    ids = rng.integers(0, max(distinct, 1), 5000 if distinct else 0).astype(np.uint32) * np.uint32(30 if distinct > 3 else 1)
    matrix = wavelet.WaveletMatrix.from_bytes(wavelet.WaveletMatrix.of(ids).to_bytes())
    assert matrix.decode().tolist() == ids.tolist()
    for place in range(0, len(ids), 97):
        assert matrix.access(place) == ids[place]
    for token in {0, 1, *ids[:40].tolist()}:
        places = np.flatnonzero(ids == token)
        assert matrix.count(token) == len(places)
        assert matrix.count(token, 11, 3000) == ((places >= 11) & (places < 3000)).sum() if len(ids) else True
        assert [matrix.select(token, i) for i in range(len(places))] == places.tolist()
        assert matrix.select(token, len(places)) is None
    with pytest.raises(IndexError):
        matrix.access(len(ids))


def test_wavelet_files(spark, tmp_path):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").selectExpr("*", "'x' as start", "1 as n_tokens")
    wavelet.write_shards(docs.repartition(3), str(tmp_path / "w"), WORD, 2, shard_tokens=1000)
    shards = wavelet.read_shards(spark, str(tmp_path / "w"))
    found = [tuple(r) for r in wavelet.documents(shards).orderBy("start").collect()]
    order = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r[0] for r in found] == [r[0] for r in order]
    ids = {(i, t): expected_ids(WORD, t, 2) for i, t in ROWS}
    want = Counter((i, len(x), zlib.crc32(x.tobytes())) for i, t in ROWS for x in [ids[i, t]])
    assert Counter((r[0], r[2], r[3]) for r in found) == want
    starts = np.cumsum([0] + [r[2] for r in found])
    assert [r[1] for r in found] == starts[:-1].tolist()
    every = np.concatenate(list(ids.values()) + [ids[ROWS[0]]])
    assert {r.token: r.n for r in wavelet.token_counts(shards, [2, 320]).collect()} == {t: int((every == t).sum()) for t in (2, 320)}
    assert wavelet.occurrences(shards, 2).count() == (every == 2).sum()


def test_wavelet_empty_table(spark, tmp_path):
    wavelet.write_shards(spark.createDataFrame([], "doc_id long, text string"), str(tmp_path / "e"), WORD, 2)
    assert wavelet.documents(wavelet.read_shards(spark, str(tmp_path / "e"))).count() == 0


def one_by_one(lengths, capacity):
    """Best-fit decreasing, piece by piece: number of bins and what they have left."""
    left = []
    for n in sorted(lengths, reverse=True):
        fits = [(r, i) for i, r in enumerate(left) if r >= n]
        if fits:
            left[min(fits)[1]] -= n
        else:
            left.append(capacity - n)
    return sorted(left)


@pytest.mark.parametrize("seed", range(8))
def test_plan_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 31, 64])
    lengths = [rng.randint(1, rng.choice([capacity, capacity // 2, 3])) for _ in range(300)]
    counts = Counter(lengths)
    bins = {}
    for run in packing.best_fit_decreasing(counts, capacity):
        for i in range(run.pieces):
            bins.setdefault(run.bin + i // run.each, []).append((run.offset + i % run.each * run.length, run.length))
    assert sum(len(b) for b in bins.values()) == len(lengths)
    for content in bins.values():
        at = 0
        for offset, length in sorted(content):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted(capacity - sum(n for _, n in b) for b in bins.values()) == one_by_one(lengths, capacity)


def test_pack(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").selectExpr("*", "'x' as length", "1 as offset")
    found = packing.pack(docs.repartition(4), BYTE, capacity=64).collect()
    want = Counter()
    for i, t in ROWS:
        ids = expected_ids(BYTE, t, 0)
        start = 0
        for piece in range(-(-len(ids) // 64)):
            n = (len(ids) - 1) % 64 + 1 if piece == 0 else 64
            want[i, piece, start, n, zlib.crc32(ids[start : start + n].tobytes())] += 1
            start += n
    assert Counter(tuple(r)[:5] for r in found) == want
    bins = {}
    for r in found:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for content in bins.values():
        assert [o for o, _ in sorted(content)] == np.cumsum([0] + [n for _, n in sorted(content)])[:-1].tolist()
        assert sum(n for _, n in content) <= 64
    assert len(bins) == len(one_by_one([r.length for r in found], 64))
    assert packing.pack(docs.limit(0), BYTE).collect() == []
