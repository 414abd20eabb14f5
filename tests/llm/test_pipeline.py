"""The pipeline's stages, each against a plain restatement on a small table; and what it leaves to others."""

import subprocess
import sys
from collections import Counter
from pathlib import Path

import corpus_pipeline
from test_ngram_join import expected, shingles

from tastecore.llm import secret_scan

SF = "/root/testdata/sf0.001"
ROOT = Path(__file__).parents[2]


def test_stages_are_named_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "ngram_jaccard", "secret_scan", "soft_mixing", "best_fit_packing"]


def test_each_stage_works_on_what_is_left(spark, tmp_path):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame(
        [(9001, None, "en", "x", 0), (9002, "", "en", "x", 0), (9003, "12 34 !!", None, "x", 8), (None, "the and of that", "en", None, None),
         (9100, "the and of that is to in the password=45bb0d53635bf1b89d and the of", "en", "x", 10)], documents.schema
    )
    docs, columns, kept = documents.unionByName(extra), documents.columns, []
    for number, (name, function) in enumerate(corpus_pipeline.STAGES):
        function(spark, docs, SF).write.parquet(str(tmp_path / str(number)))
        docs = spark.read.parquet(str(tmp_path / str(number)))
        kept.append({"name": name, "rows": docs.collect(), "columns": docs.columns})
    assert all(k["columns"] == columns for k in kept[:-1])
    language, unique, clean, mixed, packed = (k["rows"] for k in kept)

    before = {r.doc_id: r for r in documents.collect()}
    assert {r.doc_id for r in language if r.doc_id is not None and r.doc_id < 9000} == set(before)  # clean documents stay
    assert not {9001, 9002, 9003} & {r.doc_id for r in language}

    named = [(r.doc_id, r.text) for r in language if r.doc_id is not None]
    sets = {i: shingles(t, 5) for i, t in named}
    near = {(i, j) for i in sets for j in sets if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])}
    root = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for i, j in near:
            low = min(root[i], root[j])
            changed |= (root[i], root[j]) != (low, low)
            root[i] = root[j] = low
    assert {r.doc_id for r in unique if r.doc_id is not None} == {i for i in root if root[i] == i}
    assert len({r.doc_id for r in unique}) == len(unique)

    assert [r.doc_id for r in sorted(clean, key=str)] is not None and len(clean) == len(unique)
    texts = {r.doc_id: r.text for r in unique}
    assert all(r.text == secret_scan.redacted(texts[r.doc_id]) for r in clean)
    assert any("[SECRET]" in r.text for r in clean) and not any(secret_scan.base_spans(r.text) for r in clean)

    assert set(mixed) <= set(clean) and mixed
    pieces = Counter(r.doc_id for r in packed if r.piece == 0)
    assert pieces == Counter(r.doc_id for r in mixed)
    ends = {}
    for r in sorted(packed, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 2048


def test_equal_rule_as_the_join():
    """The brute-force component rule of the join's own tests, once more on texts that only just link."""
    base = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join(base)), (2, " ".join([*base[:-1], "x"])), (3, " ".join(reversed(base)))]
    assert [c for _, _, c in expected(rows)] == [1, 1, 3]


def test_the_rest_works_without_this_package():
    """Without the two folders and the pipeline the registered queries are the others."""
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name == 'corpus_pipeline' or name.startswith('tastecore.llm'):\n"
        "            raise ModuleNotFoundError(f'No module named {name!r}', name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "names = e.queries()\n"
        "assert len(names) > 100 and not [n for n in names if n.startswith('op') or n == 'pipeline'], names\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)
