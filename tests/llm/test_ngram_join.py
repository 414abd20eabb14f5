"""The join against all pairs compared in Python."""

import random
import re
from collections import defaultdict

import pytest

from tastecore.llm import ngram_join
from tastecore.llm.shingles import shingle_sets

SF = "/root/testdata/sf0.001"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text, width=4):
    w = words(text)
    if len(w) < width:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}


def expected(rows, percent=85):
    """Per row: (doc_id, size, component)."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    postings = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            postings[g].append(i)
    for i, s in enumerate(sets):
        near = {j for g in s for j in postings[g] if j > i}
        for j in near:
            both = len(s & sets[j])
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                root[find(j)] = find(i)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(rows[i][0])
    name = {k: min((x for x in v if x is not None), default=None) for k, v in groups.items()}
    return sorted(((rows[i][0], len(sets[i]), name[find(i)]) for i in range(len(rows))), key=str)


def found(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted((tuple(r) for r in ngram_join.similar_documents(docs, **options).collect()), key=str)


def test_shingle_sizes_and_identity():
    texts = [None, "", " \n", "One two", "one  TWO", "a b c d e a b c d", "x" * 3000 + " b c d", "é b c d", "E b c d"]
    sets = list(shingle_sets(texts, 4))
    assert [len(s) for s in sets] == [len(shingles(t)) for t in texts]
    assert sets[3].tolist() == sets[4].tolist() and sets[7].tolist() != sets[8].tolist()


@pytest.mark.parametrize("seed,heavy", [(1, 20_000), (2, 20_000), (2, 10)])
def test_equals_all_pairs(spark, monkeypatch, seed, heavy):
    """Stars, chains, copies and texts around the limit; small blocks, so that many tasks take part."""
    monkeypatch.setattr(ngram_join, "BLOCK_ENTRIES", 3_000)
    monkeypatch.setattr(ngram_join, "HEAVY_ROWS", heavy)
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, number = [], iter(range(10_000))
    shared = [rng.choice(vocabulary) for _ in range(30)]
    for _ in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 5, 40, 120]))] + shared * rng.choice([0, 1])
        rows.append((next(number), " ".join(base)))
        for _ in range(rng.choice([1, 12])):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((next(number), " ".join(copy).title()))
            base = copy if rng.random() < 0.3 else base
    rows += [(None, None), (next(number), None), (next(number), ""), (next(number), " ".join(shared)), (0, rows[0][1]), (None, rows[5][1])]
    rng.shuffle(rows)
    assert found(spark, rows) == expected(rows)


def test_documents_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert found(spark, rows) == expected(rows)


def test_empty_table_and_unlinked(spark):
    assert found(spark, []) == []
    assert found(spark, [(3, "a b c d e")]) == [(3, 2, 3)]


def test_one_document_of_each_group_stays(spark):
    rows = [(5, "a b c d e", "x"), (2, "A b c d e", "y"), (2, "A b c d e", "y"), (9, None, "z"), (None, "a b c d e", "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    kept = sorted((tuple(r) for r in ngram_join.one_of_each(docs).collect()), key=str)
    assert kept == sorted([rows[1], rows[3], rows[4]], key=str)


def test_unlike_texts_of_one_id_are_kept(spark):
    one, two = "a b c d e f g h i j k l m n o p", "q r s t u v w x y z aa bb cc dd ee ff"
    rows = [(1, one, None), (1, two, "x"), (1, two, "y"), (2, one, "x"), (3, two + " gg", "x"), (None, one, "x"), (4, None, None), (4, "", None)]
    kept = ngram_join.one_of_each(spark.createDataFrame(rows, "doc_id long, text string, n string").repartition(3), 5, 80).collect()
    assert sorted(map(str, ((r.doc_id, r.text) for r in kept))) == sorted(map(str, [(1, one), (1, two), (None, one), (4, None), (4, "")]))
