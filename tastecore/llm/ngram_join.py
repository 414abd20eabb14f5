"""N-gram Jaccard join: a blocked sparse product of the document by n-gram matrix with itself.

Documents with equal shingle sets are one row of the matrix (a fingerprint). The matrix is dealt out
in blocks of n-grams; a block counts in how many rows each n-gram stands. Size-derived bounds then
discard rows and pairs before any product is made: two sets of sizes n and m with similarity t
share at least t / (1 + t) * (n + m) n-grams, so with the n-grams of a row in the order rarest first, one of
its first n - ceil(t * n) + 1 has to be shared. A row whose n-grams that stand nowhere else fill these places
has no partner at all. The product runs over the first places only, each n-gram met with its rows,
and pairs whose places leave too few n-grams behind them are discarded. What is left is counted exactly,
over the n-grams that stand in more than one row (no other can be shared).

An n-gram that very many documents hold would fill its block alone. Such n-grams are found first, from counts
that tasks have summed already; they are dealt out by document instead, without being counted, and come last
in the order of every document alike. The result is the same for any set of them.

Groups of copies don't become all their pairs: first every row is met with one hub row per n-gram, the
links so found are contracted to components, and only pairs between different components are
met after that. No pair that could link two components is left out.

Edge cases: a null text, or one without words, has size 0, is linked with nothing and is its own
component; ids are taken as they are (a repeated row is answered each time, equal texts are linked); a
null id never names a component unless no other id is there. Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastecore.llm.batches import given_back, map_arrow, map_slices, ship_package, slices, small_batches, text_of
from tastecore.llm.components import connect
from tastecore.llm.shingles import fingerprint, shingle_sets
from tastecore.plans.staging import stage

BLOCK_ENTRIES = 1_000_000  # matrix entries in a block
GATHERED = 500_000  # entries a map task holds before it deals them out
HEAVY_ROWS, HEAVY_PART = 20_000, 500  # an n-gram of that many documents, and of one in that many, is dealt out by document
LOCAL_ROWS = 4  # rows among the gathered ones from which on a task reports an n-gram
UNCOUNTED = np.uint32(2**32 - 1)
HUB_ROUNDS = 2


def document_sets(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, n_shingles, set_id): size and fingerprint of each document's set; null fingerprint if empty."""

    def run(ids: list, texts: list) -> dict[str, object]:
        sets = list(shingle_sets(texts, width))
        return {"doc_id": ids, "n_shingles": [len(s) for s in sets], "set_id": [fingerprint(s) if len(s) else None for s in sets]}

    return map_slices(text_of(docs), ["doc_id", "text"], run, "doc_id long, n_shingles long, set_id long")


BLOCK_SCHEMA = "block int, grams binary, counts binary, set_ids binary, sizes binary"


def _gathered(texts: Iterator[pa.RecordBatch], width: int) -> Iterator[dict[int, np.ndarray]]:
    """Different sets by fingerprint, about GATHERED entries at a time."""
    held: dict[int, np.ndarray] = {}
    size = 0
    for part in slices(texts):
        for grams in shingle_sets(part.column(0).to_pylist(), width):
            if len(grams) and (key := fingerprint(grams)) not in held:
                held[key] = grams
                size += len(grams)
        if size >= GATHERED:
            yield held
            held, size = {}, 0
    if held:
        yield held


def _frequent(texts: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for held in _gathered(texts, width):
        grams, rows = np.unique(np.concatenate(list(held.values())), return_counts=True)
        many = rows >= LOCAL_ROWS
        yield pa.RecordBatch.from_pydict({"gram": pa.array(grams[many].view(np.int64)), "n": pa.array(rows[many], pa.int64())})


def heavy_grams(texts: DataFrame, documents: int, width: int) -> np.ndarray:
    """N-grams of at least one in HEAVY_PART documents: HEAVY_PART times the mean set size of them at most."""
    found = map_arrow(texts, lambda parts: _frequent(parts, width), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    rows = found.filter(F.col("n") >= F.lit(max(HEAVY_ROWS, documents // HEAVY_PART))).select("gram").collect()
    return np.sort(np.array([r["gram"] for r in rows], np.int64).view(np.uint64))


def _is_heavy(grams: np.ndarray, heavy: np.ndarray) -> np.ndarray:
    if not len(heavy):
        return np.zeros(len(grams), bool)
    return heavy[np.minimum(np.searchsorted(heavy, grams), len(heavy) - 1)] == grams


def _deal(texts: Iterator[pa.RecordBatch], width: int, blocks: int, heavy: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Matrix entries by block: n-grams, row after row, with the number that each row has in the block."""

    def dealt(held: dict[int, np.ndarray]) -> pa.RecordBatch:
        set_ids, sets = np.array(list(held), np.int64), list(held.values())
        sizes = np.array([len(s) for s in sets], np.uint32)
        grams = np.concatenate(sets)
        row = np.repeat(np.arange(len(sets)), sizes)
        by = np.where(_is_heavy(grams, heavy), set_ids.view(np.uint64)[row] ^ grams, grams)
        block = ((by >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int32)
        order = np.argsort(block, kind="stable")
        grams, row = grams[order], row[order]
        limits = np.searchsorted(block[order], np.arange(blocks + 1))
        out: dict[str, list] = {name.split()[0]: [] for name in BLOCK_SCHEMA.split(", ")}
        for b in range(blocks):
            part = slice(limits[b], limits[b + 1])
            counts = np.bincount(row[part], minlength=len(sets)).astype(np.uint32)
            there = counts > 0
            if there.any():
                for name, value in zip(out, (b, grams[part].tobytes(), counts[there].tobytes(), set_ids[there].tobytes(), sizes[there].tobytes())):
                    out[name].append(value)
        return pa.RecordBatch.from_pydict({k: pa.array(v, pa.int32() if k == "block" else pa.binary()) for k, v in out.items()})

    yield from map(dealt, _gathered(texts, width))


SHARED_SCHEMA = "rows_block int, set_ids binary, grams binary, rows binary, sizes binary"


def _joined(table: pa.Table, name: str, kind: type) -> np.ndarray:
    return np.concatenate([np.frombuffer(v, kind) for v in table.column(name).to_pylist()] or [np.empty(0, kind)])


def _count_block(table: pa.Table, blocks: int, heavy: np.ndarray) -> pa.Table:
    """Of one block, the entries whose n-gram stands in more than one row, with that number of rows."""
    counts = _joined(table, "counts", np.uint32)
    grams = _joined(table, "grams", np.uint64)
    set_ids = np.repeat(_joined(table, "set_ids", np.int64), counts)
    sizes = np.repeat(_joined(table, "sizes", np.uint32), counts)
    order = np.argsort(grams, kind="stable")
    grams, set_ids, sizes = grams[order], set_ids[order], sizes[order]
    equal = grams[1:] == grams[:-1]
    many = np.concatenate(([False], equal)) | np.concatenate((equal, [False])) | _is_heavy(grams, heavy)
    grams, set_ids, sizes = grams[many], set_ids[many], sizes[many]
    order = np.lexsort((set_ids, grams))  # the same row may have come from several tasks
    grams, set_ids, sizes = grams[order], set_ids[order], sizes[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (set_ids[1:] != set_ids[:-1])
    grams, set_ids, sizes = grams[new], set_ids[new], sizes[new]
    first = np.ones(len(grams), bool)
    first[1:] = grams[1:] != grams[:-1]
    number = np.cumsum(first) - 1
    rows = np.bincount(number, minlength=1)[number].astype(np.uint32) if len(grams) else np.empty(0, np.uint32)
    rows[_is_heavy(grams, heavy)] = UNCOUNTED
    shared = rows > 1
    grams, set_ids, sizes, rows = grams[shared], set_ids[shared], sizes[shared], rows[shared]
    target = (set_ids.view(np.uint64) >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)
    order = np.lexsort((set_ids, target))
    grams, set_ids, sizes, rows, target = grams[order], set_ids[order], sizes[order], rows[order], target[order]
    limits = np.searchsorted(target, np.arange(blocks + 1, dtype=np.uint64))
    out: dict[str, list] = {name.split()[0]: [] for name in SHARED_SCHEMA.split(", ")}
    for b in np.flatnonzero(np.diff(limits)).tolist():
        part = slice(limits[b], limits[b + 1])
        for name, value in zip(out, (b, set_ids[part].tobytes(), grams[part].tobytes(), rows[part].tobytes(), sizes[part].tobytes())):
            out[name].append(value)
    return pa.table({k: pa.array(v, pa.int32() if k == "rows_block" else pa.binary()) for k, v in out.items()})


CANDIDATE_SCHEMA = "set_id long, n long, single long, places int, weight double, grams binary"


def _candidates(table: pa.Table, percent: int) -> pa.Table:
    """Rows that may have a partner: their shared n-grams, rarest first, and how many of these are first places."""
    set_ids, grams = _joined(table, "set_ids", np.int64), _joined(table, "grams", np.uint64)
    rows, sizes = _joined(table, "rows", np.uint32), _joined(table, "sizes", np.uint32)
    order = np.lexsort((grams, rows, set_ids))
    set_ids, grams, rows, sizes = set_ids[order], grams[order], rows[order], sizes[order]
    starts = np.flatnonzero(np.concatenate(([True], set_ids[1:] != set_ids[:-1]))) if len(set_ids) else np.empty(0, np.int64)
    out: dict[str, list] = {name.split()[0]: [] for name in CANDIDATE_SCHEMA.split(", ")}
    for start, end in zip(starts.tolist(), [*starts[1:].tolist(), len(set_ids)]):
        n, shared = int(sizes[start]), end - start
        first_places = n - -(-percent * n // 100) + 1
        places = min(shared, first_places - (n - shared))
        if places > 0:
            weight = float(np.log2(rows[start:end].astype(float)).sum()) / n
            for name, value in zip(out, (int(set_ids[start]), n, n - shared, places, weight, grams[start:end].tobytes())):
                out[name].append(value)
    kinds = {"set_id": pa.int64(), "n": pa.int64(), "single": pa.int64(), "places": pa.int32(), "weight": pa.float64(), "grams": pa.binary()}
    return pa.table({k: pa.array(v, kinds[k]) for k, v in out.items()})


def _first_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        grams, row, place = [], [], []
        for i, (value, places) in enumerate(zip(part.column("grams").to_pylist(), part.column("places").to_pylist())):
            grams.append(np.frombuffer(value, np.int64)[:places])
            row.append(np.full(places, i))
            place.append(np.arange(places))
        take = pa.array(np.concatenate(row or [np.empty(0, np.int64)]), pa.int64())
        names = ("set_id", "n", "weight")
        single = part.column("single").to_numpy()[np.concatenate(row or [np.empty(0, np.int64)])]
        columns = {"gram": pa.array(np.concatenate(grams or [np.empty(0, np.int64)]), pa.int64())}
        columns |= {k: part.column(k).take(take) for k in names}
        columns["place"] = pa.array(single + np.concatenate(place or [np.empty(0, np.int64)]), pa.int64())
        yield pa.RecordBatch.from_pydict(columns)


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        both = zip(part.column("grams_a").to_pylist(), part.column("grams_b").to_pylist())
        found = [len(np.intersect1d(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), assume_unique=True)) for a, b in both]
        columns = {k: part.column(k) for k in ("a", "b", "n_a", "n_b")}
        yield pa.RecordBatch.from_pydict({**columns, "overlap": pa.array(found, pa.int64())})


def _verified(pairs: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) with `linked`: whether their exact overlap reaches the similarity."""
    for end in ("a", "b"):
        side = rows.select(F.col("set_id").alias(end), F.col("n").alias(f"n_{end}"), F.col("grams").alias(f"grams_{end}"))
        pairs = pairs.join(side, end)
    counted = map_arrow(pairs.select("a", "b", "n_a", "n_b", "grams_a", "grams_b"), _overlaps, "a long, b long, n_a long, n_b long, overlap long")
    return counted.select("a", "b", (F.lit(100) * F.col("overlap") >= F.lit(percent) * (F.col("n_a") + F.col("n_b") - F.col("overlap"))).alias("linked"))


def _may_link(n: Column, m: Column, percent: int) -> Column:
    return F.lit(100) * F.least(n, m) >= F.lit(percent) * F.greatest(n, m)


def _pair(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def linked_sets(docs: DataFrame, sets: DataFrame, width: int, percent: int) -> DataFrame:
    """(node, root) of all sets that may have a partner: the components of the links between sets."""
    total = sets.agg(F.sum("n_shingles")).head()[0] or 0
    blocks = max(1, -(-total // BLOCK_ENTRIES))
    ship_package(docs)
    small_batches(docs)
    texts = docs.select(F.col("text").cast("string").alias("text"))
    heavy = heavy_grams(texts, sets.count(), width)
    dealt = map_arrow(texts, lambda parts: _deal(parts, width, blocks, heavy), BLOCK_SCHEMA)
    shared = dealt.groupBy("block").applyInArrow(given_back(lambda block: _count_block(block, blocks, heavy)), SHARED_SCHEMA)
    rows = stage(shared.groupBy("rows_block").applyInArrow(given_back(lambda block: _candidates(block, percent)), CANDIDATE_SCHEMA), "rows")
    places = stage(map_arrow(rows, _first_places, "gram long, set_id long, n long, weight double, place long"), "places")
    roots = rows.select(F.col("set_id").alias("node"), F.col("set_id").alias("root"))
    tested = None
    for turn in range(HUB_ROUNDS + 1):
        entries = places.join(roots.withColumnRenamed("node", "set_id"), "set_id")
        if turn < HUB_ROUNDS:
            rank = F.col("weight") if turn == 0 else F.xxhash64("set_id", F.lit(turn)).cast("double")
            hubs = entries.groupBy("gram").agg(F.max_by(F.struct("set_id", "n", "root"), F.struct(rank, F.col("set_id"))).alias("hub"), F.min("root").alias("low"), F.max("root").alias("high"))
            met = entries.join(hubs.filter("low <> high").select("gram", "hub"), "gram").filter((F.col("root") != F.col("hub.root")) & _may_link(F.col("n"), F.col("hub.n"), percent))
            pairs = met.select(*_pair(F.col("set_id"), F.col("hub.set_id"))).distinct()
        else:
            mixed = entries.groupBy("gram").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high").select("gram")
            entries = stage(entries.join(mixed, "gram"), "mixed")
            left, right = entries.alias("l"), entries.alias("r")
            share = F.lit(100 + percent)
            behind = F.least(F.col("l.n") - F.col("l.place"), F.col("r.n") - F.col("r.place"))
            met = left.join(right, F.col("l.gram") == F.col("r.gram")).filter(
                (F.col("l.set_id") < F.col("r.set_id")) & (F.col("l.root") != F.col("r.root"))
                & _may_link(F.col("l.n"), F.col("r.n"), percent)
                & (share * behind >= F.lit(percent) * (F.col("l.n") + F.col("r.n")))
            )
            pairs = met.select(*_pair(F.col("l.set_id"), F.col("r.set_id"))).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        result = stage(_verified(pairs, rows, percent), "pairs")
        roots = connect(roots, result.filter("linked").select("a", "b"))
        tested = result.select("a", "b") if tested is None else tested.unionAll(result.select("a", "b"))
    return roots


def similar_documents(docs: DataFrame, width: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id: the smallest doc_id that links lead to, itself included.

    Two documents link when 100 * |intersection| >= percent * |union| of their shingle sets.
    """
    sets = stage(document_sets(docs, width), "sets")
    roots = linked_sets(docs, sets, width, percent)
    named = sets.filter("set_id is not null").groupBy("set_id").agg(F.min("doc_id").alias("first"))
    named = named.join(roots, F.col("set_id") == F.col("node"), "left").select("set_id", "first", F.coalesce("root", "set_id").alias("root"))
    names = named.groupBy("root").agg(F.min("first").alias("component_id"))
    by_set = stage(named.join(names, "root").select("set_id", "component_id"), "named")
    found = sets.join(by_set, "set_id", "left")
    return found.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, width: int = 4, percent: int = 85) -> DataFrame:
    """The rows of `docs` that stand for their group: of those with its smallest doc_id, one of each text.

    Different texts that share a doc_id are all kept, as their links can't be told apart; rows without a doc_id stay, as
    nothing can name them.
    """
    keep = similar_documents(docs, width, percent).filter("doc_id = component_id").select("doc_id").distinct()
    # Repeated rows differ in other columns at most: the smallest stands for them, whatever the partitioning.
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    named = docs.join(keep, "doc_id", "left_semi")
    single = named.groupBy("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("_text"), F.isnull("text").alias("_null"))
    # One text, and rows that differ only in small columns, for each key.
    chosen = single.agg(F.min(F.struct("text", *rest)).alias("_row")) if all(t != "map" and not t.startswith("map") for _, t in docs.dtypes) else single.agg(F.first(F.struct("text", *rest)).alias("_row"))
    named = chosen.select("doc_id", "_row.*")
    return named.select(*docs.columns).unionByName(docs.filter("doc_id is null"))
