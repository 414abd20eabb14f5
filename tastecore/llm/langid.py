"""Language identification with language-bitmask n-gram filters.

A bit-sliced Bloom filter holds, at each of its positions, one bit per language. The AND of the
positions of an n-gram is the set of all languages that contain it, so one look-up serves all
languages. A text's n-grams are counted per language (popcounts); each count is corrected for
the false positives of that language's slice, and the largest corrected count decides.

Edge cases: a null text or one without a letter gives `und` and score 0; without any learned
language every text gives `und`; equal counts go to the language with the smaller name; repeated
rows are each answered; a text's n-grams end at its own opening and closing space, whatever texts are
read with it; long texts are read in pieces that overlap by n - 1 characters, so all their n-grams
count once. Columns other than doc_id and text are never read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastecore.llm.batches import map_arrow, map_slices, slices, small_batches, text_of

GRAM = 3
PIECE = 1 << 18  # characters looked at together
HASHES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93))
UNDETERMINED = "und"


@dataclass(frozen=True)
class LanguageFilters:
    """`slices[i, position]`: bit l is set if the position is set for language 64 * i + l."""

    languages: tuple[str, ...]
    slices: np.ndarray
    false_positive: np.ndarray


@functools.cache
def _letters() -> np.ndarray:
    """Per code point: itself if it is a letter, else a space."""
    table = np.full(0x110000, 32, dtype=np.uint32)
    for point in range(0x110000):
        if chr(point).isalpha():
            table[point] = point
    return table


def _grams(parts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """All n-grams within each of the parts (as numbers) and each part's bounds among them."""
    ends = np.concatenate(([0], np.cumsum([len(p) for p in parts], dtype=np.int64)))
    points = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    points = _letters()[points]
    space = points == 32
    keep = ~(space & np.concatenate(([False], space[:-1])))  # runs of non-letters become one space
    keep[ends[:-1][ends[:-1] < len(keep)]] = True  # but each part has its own
    ends = np.concatenate(([0], np.cumsum(keep)))[ends]
    points = points[keep].astype(np.uint64)
    if len(points) < GRAM:
        return np.empty(0, np.uint64), np.zeros(len(parts) + 1, np.int64)
    grams = points[: len(points) - GRAM + 1].copy()
    for i in range(1, GRAM):
        grams = (grams << np.uint64(21)) | points[i : len(points) - GRAM + 1 + i]
    within = np.ones(len(points), bool)  # what starts at a part's last places would reach into the next
    for back in range(1, GRAM):
        within[np.maximum(ends[1:] - back, ends[:-1])[ends[1:] > ends[:-1]]] = False
    bounds = np.concatenate(([0], np.cumsum(within)))[ends]
    return grams[within[: len(grams)]], bounds


def _last(part: str) -> str:
    """The last GRAM - 1 characters of a part, with runs of non-letters as one space."""
    found = ""
    for char in reversed(part):
        char = char if char.isalpha() else " "
        if char != " " or not found.startswith(" "):
            if len(found) == GRAM - 1:
                break
            found = char + found
    return found


def _pieces(texts: Sequence[str | None]) -> Iterator[tuple[list[int], list[str]]]:
    """Groups of pieces of bounded total length, with the number of the text each belongs to.

    A text has one opening and one closing space; a piece starts with the last characters of the one before.
    """
    owners: list[int] = []
    parts: list[str] = []
    held = 0
    for i, text in enumerate(texts):
        text = (text or "").lower()
        part = " "
        for start in range(0, len(text), PIECE):
            part = (_last(part) if start else part) + text[start : start + PIECE]
            if start + PIECE >= len(text):
                part += " "
            owners.append(i)
            parts.append(part)
            held += len(part)
            if held >= PIECE:
                yield owners, parts
                owners, parts, held = [], [], 0
    if parts:
        yield owners, parts


def _positions(grams: np.ndarray, size: int) -> list[np.ndarray]:
    shift = np.uint64(64 - (size.bit_length() - 1))
    return [(grams * h ^ (grams * h) >> np.uint64(29)) * HASHES[0] >> shift for h in HASHES]


def counted_grams(docs: DataFrame) -> DataFrame:
    """(lang, gram, n): n-gram counts of the rows of (lang, text), summed per slice before the shuffle."""

    def count(langs: list, texts: list) -> dict[str, object]:
        out: dict[str, list] = {"lang": [], "gram": [], "n": []}
        for lang in sorted({x for x in langs if x is not None}):
            own = [t for x, t in zip(langs, texts) if x == lang]
            seen = [_grams(parts)[0] for _, parts in _pieces(own)]
            grams, n = np.unique(np.concatenate(seen or [np.empty(0, np.uint64)]), return_counts=True)
            out["lang"] += [lang] * len(grams)
            out["gram"] += grams.astype(np.int64).tolist()
            out["n"] += n.tolist()
        return out

    small_batches(docs)
    rows = map_slices(docs, ["lang", "text"], count, "lang string, gram long, n long")
    return rows.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def learn(docs: DataFrame, rows_per_language: int = 2_000, min_share: float = 2e-5, bits: int = 20) -> LanguageFilters:
    """Filters of the n-grams that make up at least `min_share` of a language's n-grams.

    Fitted on about `rows_per_language` rows of each language (rows of (doc_id, lang, text), chosen
    by a hash of doc_id over the whole table). A language has 1 / min_share n-grams at most, so what
    reaches the driver is bounded by the number of languages.
    """
    labelled = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not sizes:
        return LanguageFilters((), np.zeros((1, 1 << bits), np.uint64), np.zeros(0))
    limits = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, rows_per_language / n))])
    draw = F.pmod(F.xxhash64(F.lit("language"), "doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = labelled.filter(draw < limits[F.col("lang")])
    counts = counted_grams(sample)
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    kept = counts.join(totals, "lang").filter(F.col("n") >= F.col("total") * F.lit(min_share)).select("lang", "gram")
    languages = tuple(sorted(sizes))
    size = 1 << bits
    table = np.zeros((-(-len(languages) // 64), size), np.uint64)
    fill = np.zeros(len(languages))
    found = kept.toPandas()
    for number, lang in enumerate(languages):
        grams = found.loc[found.lang == lang, "gram"].to_numpy(np.int64).astype(np.uint64)
        positions = np.unique(np.concatenate(_positions(grams, size)))
        table[number // 64, positions] |= np.uint64(1 << number % 64)
        fill[number] = len(positions) / size
    if len(languages) <= 64:  # the narrowest type that holds all languages: it stays in the processor's cache
        table = table.astype(next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if len(languages) <= 8 * t().itemsize))
    return LanguageFilters(languages, table, fill ** len(HASHES))


def _counts(model: LanguageFilters, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Per text: number of n-grams, and popcounts per language."""
    total = np.zeros(len(texts), np.int64)
    hits = np.zeros((len(texts), len(model.languages)), np.int64)
    for owners, parts in _pieces(texts):
        grams, bounds = _grams(parts)
        np.add.at(total, owners, np.diff(bounds))
        positions = _positions(grams, model.slices.shape[1])
        for word, table in enumerate(model.slices):
            masks = table[positions[0]] & table[positions[1]] & table[positions[2]]
            for bit, number in enumerate(range(64 * word, min(64 * word + 64, len(model.languages)))):
                ones = np.concatenate(([0], np.cumsum(masks >> masks.dtype.type(bit) & masks.dtype.type(1), dtype=np.int64)))
                np.add.at(hits[:, number], owners, ones[bounds[1:]] - ones[bounds[:-1]])
    return total, hits


def identify(model: LanguageFilters, texts: Sequence[str | None]) -> tuple[list[str], list[float], list[float]]:
    """Language, score (share of the text's n-grams that the language has) and lead over the next language."""
    has_letter = [bool(t) and any(map(str.isalpha, t)) for t in texts]
    if not model.languages:
        return [UNDETERMINED] * len(texts), [0.0] * len(texts), [0.0] * len(texts)
    total, hits = _counts(model, texts)
    rate = model.false_positive
    true = np.clip((hits - total[:, None] * rate) / np.maximum(1 - rate, 1e-9), 0, None)
    share = np.minimum(true / np.maximum(total, 1)[:, None], 1.0)
    best = share.argmax(axis=1)
    ranked = np.sort(share, axis=1)
    lead = ranked[:, -1] - (ranked[:, -2] if share.shape[1] > 1 else 0)
    langs = [model.languages[b] if ok else UNDETERMINED for b, ok in zip(best, has_letter)]
    return langs, np.where(has_letter, ranked[:, -1], 0.0).tolist(), np.where(has_letter, lead, 0.0).tolist()


def predict(docs: DataFrame, model: LanguageFilters) -> DataFrame:
    """doc_id, lang_pred, score, lead: one row per row of `docs`, from its whole text alone."""

    def run(ids: list, texts: list) -> dict[str, object]:
        langs, scores, leads = identify(model, texts)
        return {"doc_id": ids, "lang_pred": langs, "score": scores, "lead": leads}

    return map_slices(text_of(docs), ["doc_id", "text"], run, "doc_id long, lang_pred string, score double, lead double")


def keep_identified(docs: DataFrame, model: LanguageFilters, min_score: float) -> DataFrame:
    """Rows of `docs`, unchanged, whose text is in a learned language with at least `min_score`."""
    small_batches(docs)
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            langs, scores, _ = identify(model, part.column(place).to_pylist())
            yield part.filter(pa.array([x != UNDETERMINED and s >= min_score for x, s in zip(langs, scores)]))

    return map_arrow(docs, run, docs.schema)


def training_rows(docs: DataFrame) -> DataFrame:
    """Rows with a language whose crc32(doc_id as text) mod 4 is not 2; without a doc_id there is no fold."""
    return docs.filter(F.crc32(F.col("doc_id").cast("string")) % 4 != 2).select("doc_id", "lang", "text")


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
