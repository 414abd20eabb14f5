"""Held-out language accuracy, mixing against a direct solution, rollups against a recount."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tastecore.llm import langid, mixing, token_rollup
from oracle import connect, difference
from tastecore.llm.queries import ORACLES, QUERIES, mix_domain

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_language_held_out_accuracy(docs):
    model = langid.learn(langid.training_rows(docs))
    found = langid.predict(docs, model).withColumn("held_out", langid.held_out()).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in found)
    held = [r for r in found if r.held_out]
    assert len(held) > 200 and sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)


def test_language_edges(spark, docs):
    model = langid.learn(langid.training_rows(docs))
    rows = [(1, None), (2, ""), (3, "12 !? 3"), (None, "le la que"), (4, "the and " * 100_000), (5, "漢字"), (5, "漢字")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as score", "1 as lang_pred")
    found = sorted((tuple(r)[:2] for r in langid.predict(frame, model).collect()), key=str)
    assert [x for x in found if x[0] in (1, 2, 3)] == [(1, "und"), (2, "und"), (3, "und")]
    assert (4, "en") in found and len(found) == 7 and all(x[1] in model.languages for x in found if x[0] in (4, 5, None))
    kept = langid.keep_identified(frame, model, 0.25)
    assert kept.columns == frame.columns and {r.doc_id for r in kept.collect()} >= {4}
    nothing = langid.learn(langid.training_rows(spark.createDataFrame([], "doc_id long, lang string, text string")))
    assert {r.lang_pred for r in langid.predict(frame, nothing).collect()} == {"und"}


def grams_by_hand(text):
    letters = " ".join(["", *"".join(c if c.isalpha() else " " for c in text.lower()).split(), ""])
    return sorted(letters[i : i + 3] for i in range(len(letters) - 2)) if letters.strip() else []


def grams_found(texts):
    found = [[] for _ in texts]
    for owners, parts in langid._pieces(texts):
        grams, bounds = langid._grams(parts)
        for n, owner in enumerate(owners):
            found[owner] += ["".join(chr(int(g) >> 21 * i & 0x1FFFFF) for i in (2, 1, 0)) for g in grams[bounds[n] : bounds[n + 1]]]
    return [sorted(x) for x in found]


def test_grams_stay_within_their_text(monkeypatch):
    texts = ["This.", "der hund", "", None, "a", "!?", "x,  y", "ab", " İ'ΟΔΟΣ ", "zz" * 40, "..." * 30 + "end", "le" + "," * 60 + "la", "b" * 31 + " c" * 9]
    for piece in (langid.PIECE, 1, 2, 3, 7, 32):
        monkeypatch.setattr(langid, "PIECE", piece)
        assert grams_found(texts) == [grams_by_hand(t or "") for t in texts]
        assert grams_found(texts[::-1]) == [grams_by_hand(t or "") for t in texts[::-1]]


def test_language_is_the_same_alone_and_in_any_slice(spark, docs):
    model = langid.learn(langid.training_rows(docs))
    texts = ["This.", "der hund", "a", "y", "le", "No", "12", "que la", None] * 40
    alone = [tuple(x[0] for x in langid.identify(model, [t])) for t in texts]
    assert list(zip(*langid.identify(model, texts))) == alone
    assert list(zip(*langid.identify(model, texts[::-1]))) == alone[::-1]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for frame in (rows.coalesce(1), rows.repartition(7), rows.orderBy(F.desc("doc_id"))):
        assert [tuple(r)[1:] for r in sorted(langid.predict(frame, model).collect())] == alone


def test_filters_return_all_languages_of_a_gram():
    """One look-up per gram; counts corrected for false positives stay near the true ones in a small, full filter."""
    rng = np.random.default_rng(0)
    size, own = 1 << 12, {0: rng.integers(1, 1 << 60, 900, dtype=np.uint64), 1: rng.integers(1, 1 << 60, 300, dtype=np.uint64)}
    table, fill = np.zeros((1, size), np.uint8), np.zeros(2)
    for number, grams in own.items():
        positions = np.unique(np.concatenate(langid._positions(grams, size)))
        table[0, positions] |= np.uint8(1 << number)
        fill[number] = len(positions) / size
    asked = np.concatenate([own[0][:200], own[1][:100], rng.integers(1, 1 << 60, 5000, dtype=np.uint64)])
    at = langid._positions(asked, size)
    masks = table[0][at[0]] & table[0][at[1]] & table[0][at[2]]
    assert (masks[:200] & 1).all() and (masks[200:300] & 2).all()
    for number, true in ((0, 200), (1, 100)):
        rate = fill[number] ** 3
        hits = int((masks >> number & 1).sum())
        assert abs((hits - len(asked) * rate) / (1 - rate) - true) < 60


def test_mixing_meets_targets(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    classifier = mixing.learn_domains(docs, labels, mix_domain())
    weights = {"q1t0": 0.6, "q0t0": 0.3, "q1t1": 0.1}
    rows = mixing.document_rates(docs, classifier, weights, 0.8).collect()
    p, t, r = np.array([x.posteriors for x in rows]), np.array([x.n_tokens for x in rows], float), np.array([x.rate for x in rows])
    assert (r >= 0).all() and len(rows) == docs.count()
    want = np.array([weights.get(d, 0.0) for d in classifier.domains]) * 0.8 * t.sum()
    assert np.abs((r * t) @ p - want).max() < 2e-3 * t.sum()
    best = p.argmax(1)
    truth = {(x.doc_id): f"q{x.quality}t{x.toxic}" for x in labels.collect()}
    right = [classifier.domains[b] == truth[x.doc_id] for b, x in zip(best, rows) if x.doc_id in truth]
    assert sum(right) > 0.9 * len(right)
    assert abs(sum(x.copies for x in rows) - r.sum()) < 0.1 * len(rows)


def test_projected_steps_equal_direct_loop(spark):
    """The same steps in numpy, with targets that force rates to zero."""
    rng = np.random.default_rng(1)
    p = rng.dirichlet([0.3, 0.3, 0.3], 200)
    t = rng.integers(0, 500, 200).astype(float)
    scored = spark.createDataFrame([(float(a), [float(x) for x in b]) for a, b in zip(t, p)], f"{mixing.TOKENS} double, {mixing.POSTERIORS} array<double>")
    targets = np.array([0.9, 0.1, 0.0]) * t.sum()
    rates = mixing.solve(scored, targets, most=25)
    r, before = np.full(200, targets.sum() / t.sum()), np.inf
    for _ in rates.steps:
        residual = ((r * t) @ p - targets) / t.sum()
        metric = (p * (t * (r > 0))[:, None]).T @ p / t.sum() + 1e-9 * np.eye(3)
        length, before = (1.0 if np.abs(residual).max() < before else 0.5), np.abs(residual).max()
        r = np.maximum(0, r - p @ (length * np.linalg.solve(metric, residual)))
    found = np.array([x.r for x in scored.select(rates.column().alias("r")).collect()])
    assert np.allclose(sorted(found), sorted(r), atol=1e-9) and (r == 0).any() and np.abs(rates.residual).max() < 0.02


def test_posteriors_run_the_model_once_a_row(spark, docs):
    """Inside a lambda the whole model, texts included, would run once per domain."""
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scored = mixing.with_posteriors(docs.select("doc_id", "text"), mixing.learn_domains(docs, labels, mix_domain()))
    plan = scored.select("doc_id", mixing.TOKENS, mixing.POSTERIORS)._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan and plan.count("split(") == 1 and "regexp" not in plan


def test_tokens_are_the_runs_without_white_space(spark):
    texts = [None, "", " ", "\t\n", "a", " a", "a ", " a\r\nb\x0b", "a b  c", "\u00a0", "a\u2003b c", "\u0130 I\x1f x"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = mixing.with_posteriors(rows, mixing.DomainClassifier((), None)).collect()
    assert {r.doc_id: r[mixing.TOKENS] for r in found} == {i: float(len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for i, t in enumerate(texts)}


def test_mixing_edges(spark):
    docs = spark.createDataFrame([(1, "a b", "x"), (1, "a b", "x"), (None, None, "y")], "doc_id long, text string, rate string")
    labels = spark.createDataFrame([], "doc_id long, quality long, toxic long")
    none = mixing.learn_domains(docs, labels, mix_domain())
    assert [r.rate for r in mixing.document_rates(docs, none, {}, 1.0).collect()] == [1.0] * 3
    assert sorted(map(str, mixing.mixed(docs, none, {}, 1.0).collect())) == sorted(map(str, docs.collect()))
    one = mixing.learn_domains(docs, spark.createDataFrame([(1, 1, 0), (None, 1, 0), (7, None, 1)], labels.schema), mix_domain())
    assert one.domains == ("q1t0",) and {r.rate for r in mixing.document_rates(docs, one, {"q1t0": 1.0}, 2.0).collect()} == {2.0}
    assert mixing.mixed(docs, one, {"q1t0": 1.0}, 2.0).count() == 6
    assert mixing.document_rates(docs.limit(0), one, {"q1t0": 1.0}, 1.0).collect() == []


@pytest.mark.parametrize("gone", ["a", "m", "z"])
def test_mixing_without_text_of_a_labelled_domain(spark, gone):
    """A domain, first, middle or last by name, that has labels but no text here."""
    rows = [(i, f"{w} common {w}{i % 7}") for i, w in enumerate(["alpha", "middle", "omega"] * 60)]
    labels = [(i, "amz"[i % 3]) for i, _ in rows]
    docs = spark.createDataFrame([r for r, (_, d) in zip(rows, labels) if d != gone], "doc_id long, text string")
    classifier = mixing.learn_domains(docs, spark.createDataFrame(labels, "doc_id long, domain string"), F.col("domain"))
    assert classifier.domains == ("a", "m", "z")
    found = mixing.document_rates(docs, classifier, {"a": 0.5, "m": 0.3, "z": 0.2}, 1.0).collect()
    place, wanted = "amz".index(gone), {"a": 0.5, "m": 0.3, "z": 0.2}
    total = sum(r.n_tokens for r in found)
    assert all(r.posteriors[place] == 0.0 and len(r.posteriors) == 3 for r in found)
    assert all(r.converged and r.residual <= 1e-5 for r in found)
    for k, d in enumerate("amz"):
        share = sum(r.rate * r.n_tokens * r.posteriors[k] for r in found) / total
        assert abs(share - (0.0 if d == gone else wanted[d] / (1 - wanted[gone]))) < 2e-5
    never = mixing.document_rates(docs, classifier, {"amz".replace(gone, "")[0]: 1.0}, 400.0).collect()
    assert {r.converged for r in never} == {max(abs(r.residual) for r in never) <= 1e-5}


EVENTS = "doc_id long, tokenizer string, source string, lang string, n_tokens long, action string, change_order int"


def test_rollup_against_recount(spark, tmp_path):
    rollup = token_rollup.TokenRollup(spark, str(tmp_path / "rollup"))
    batches = {
        1: [(1, "v1", "a", "en", 5, "insert", 0), (2, "v1", "a", None, 7, "insert", 0), (None, "v1", None, None, 3, "insert", 0), (9, "v1", "a", "en", 1, "delete", 0)],
        2: [(1, "v1", "a", "en", 8, "revise", 0), (2, "v1", None, None, 0, "delete", 0), (1, "v2", "a", "en", 4, "insert", 0)],
        3: [],
        4: [(2, "v1", "b", "de", 2, "insert", 0), (1, "v1", "c", "en", 6, "revise", 1), (1, "v1", "c", "en", 9, "revise", 0), (None, "v1", None, None, 4, "revise", 0)],
    }
    live = {}
    for number, events in batches.items():
        frame = spark.createDataFrame(events, EVENTS).withColumn("old", F.lit("x"))
        assert rollup.apply(number, frame) and not rollup.apply(number, frame)
        for doc, version, source, lang, n, action, _ in sorted(events, key=lambda e: (e[6], e[4])):
            live.pop((doc, version), None)
            if action != "delete":
                live[doc, version] = (source, lang, n)
        want = defaultdict(lambda: [0, 0])
        for (_, version), (source, lang, n) in live.items():
            want[source, lang, version][0] += 1
            want[source, lang, version][1] += n
        assert {tuple(r)[:3]: list(r)[3:] for r in rollup.totals().collect()} == dict(want)
    assert rollup.batches() == [1, 2, 3, 4] and rollup.ledger().count() == len(live)


def test_half_written_batch_is_done_anew(spark, tmp_path):
    rollup = token_rollup.TokenRollup(spark, str(tmp_path / "rollup"))
    events = spark.createDataFrame([(1, "v1", "a", "en", 5, "insert", 0)], EVENTS)
    rollup.apply(1, events)
    (tmp_path / "rollup/deltas/batch=1/_SUCCESS").unlink()
    assert rollup.batches() == [] and rollup.totals().collect() == []
    assert rollup.apply(1, events) and [tuple(r) for r in rollup.totals().collect()] == [("a", "en", "v1", 1, 5)]


def test_token_counts_keep_null_and_repeated_ids(spark, tmp_path):
    texts = ["a b c", "a b c", None, "", "d, e!", "le la"]
    docs = [(i, t, len(t or ""), s, lang) for i in (None, 1, 2, 3) for t in texts for s, lang in (("web", "en"), (None, None), ("web", "de"))]
    docs += [(7, "one", 3, "web", "en"), (8, "one", 3, "web", "en"), (None, "one", 3, "web", "en")]
    spark.createDataFrame(docs, "doc_id long, text string, n_chars long, source string, lang string").repartition(3).write.parquet(str(tmp_path / "docs"))
    spark.createDataFrame([(2, 1), (2, 1), (8, 1), (9, 1), (None, 1), (1, 0), (3, None)], "doc_id long, toxic long").write.parquet(str(tmp_path / "lab"))
    (tmp_path / "sf").mkdir()
    for name, folder in (("documents", "docs"), ("labels", "lab")):
        spark.read.parquet(str(tmp_path / folder)).toPandas().astype({"doc_id": "Int64"}).to_parquet(tmp_path / f"sf/{name}.parquet")
    con = connect(str(tmp_path / "sf"))
    found = QUERIES["op10_token_counts"](spark, str(tmp_path / "sf"))
    assert difference(found, con, ORACLES["op10_token_counts"]) is None
    assert sum(r.n_docs for r in found.collect()) == 2 * (len(docs) - 18 - 1)


def test_inserts_add_rows_and_changes_act_on_all_of_them(spark, tmp_path):
    rollup = token_rollup.TokenRollup(spark, str(tmp_path / "rollup"))
    batches = [
        ([(1, 5, "insert", 0), (1, 5, "insert", 0), (None, 3, "insert", 0), (None, 4, "insert", 1)], (4, 17)),
        ([(None, 3, "insert", 0), (1, 6, "insert", 0)], (6, 26)),
        ([(1, 7, "revise", 0), (1, 8, "revise", 0)], (5, 25)),
        ([(None, 0, "delete", 0), (1, 2, "delete", 1), (1, 9, "insert", 0), (1, 1, "insert", 2), (2, 0, "delete", 0)], (1, 1)),
        ([(1, 0, "delete", 0), (1, 3, "revise", 0), (1, 3, "insert", 0)], (2, 6)),
    ]
    for number, (events, want) in enumerate(batches):
        rollup.apply(number, spark.createDataFrame([(i, "v1", "a", "en", n, action, order) for i, n, action, order in events], EVENTS))
        assert [tuple(r)[3:] for r in rollup.totals().collect()] == [want]


@pytest.mark.parametrize("seed", [1])
def test_batches_in_any_order_agree_with_the_ledger(spark, tmp_path, seed):
    import random

    rng = random.Random(seed)
    rollup = token_rollup.TokenRollup(spark, str(tmp_path / "rollup"))
    live = defaultdict(list)  # document: counts of its rows
    for number in rng.sample(range(100), 5):
        events = [(rng.choice([1, 2, 3, None]), "v1", rng.choice(["a", "b"]), "en", rng.randrange(9), rng.choice(["insert", "revise", "delete"]), i) for i in range(rng.randrange(4))]
        rollup.apply(number, spark.createDataFrame(events, EVENTS))
        for doc, _, source, _, n, action, _ in events:
            if action != "insert":
                live[doc] = []
            if action != "delete":
                live[doc].append((source, n))
        if rng.random() < 0.5:
            rollup.compact()
            rollup.compact()
        want = Counter(s for rows in live.values() for s, _ in rows), Counter()
        for rows in live.values():
            for s, n in rows:
                want[1][s] += n
        ledger = rollup.ledger().collect()
        assert Counter({(r.doc_id, r.source, r.n_tokens): r.copies for r in ledger}) == Counter((d, s, n) for d, rows in live.items() for s, n in rows)
        assert {r.source: (r.n_docs, r.n_tokens) for r in rollup.totals().collect()} == {s: (want[0][s], want[1][s]) for s in want[0]}
    assert not rollup.apply(rollup.batches()[0], spark.createDataFrame([(9, "v1", "a", "en", 5, "insert", 0)], EVENTS))
