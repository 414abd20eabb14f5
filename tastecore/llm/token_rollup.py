"""Token counts by source, language and tokenizer version, maintained by deltas.

A batch of changes (insert, delete, revise) is turned into signed rows per key, summed before they
are stored, and added under the batch's own number. Totals are the sums of all stored deltas, so
nothing is ever recounted. A batch is committed by one rename-free step: its folder counts only
with Spark's success mark, a repeated batch number is not applied again, and a batch that failed
half-way is written anew over its remains.

The ledger is what makes a revised count or a delete additive: the old counts are looked up there and
taken off. A document and tokenizer version can have several rows, since ids can be null or repeated;
the ledger holds how many there are of each source, language and count. Each batch stores the rows that
it added, marked if they replace all older rows of their document and version. Older means committed before: batches
act in the order of their commits, whatever their numbers. `compact` writes the live rows of all batches so far as one table,
from which on only newer batches are read beside it.

An insert adds a row. A revision replaces all rows of a document and version by the rows given for it, a
delete ends them all. Several changes of one document and version in a batch act in the given order; at
one place of that order deletes go first, then revisions, then inserts.

Edge cases: null source, language, text or id form keys of their own (null-safe joins); every row with a
null id counts; a null or empty text has 0 tokens and counts as a document; a delete or a revision of
what is not there acts as nothing, or as an insert; empty batches commit and change nothing; extra
columns are not read.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ("source", "lang", "tokenizer")
DOCUMENT = ("doc_id", "tokenizer")
INSERT, REVISE, DELETE = "insert", "revise", "delete"
LEDGER_SCHEMA = "doc_id long, tokenizer string, source string, lang string, n_tokens long, copies long, anew boolean, turn long"
DELTA_SCHEMA = "source string, lang string, tokenizer string, n_docs long, n_tokens long"

#: Tokenizer versions that SQL can state: runs of non-space characters; runs of letters or digits and single other signs.
WORDS, PIECES = "words-1", "pieces-2"
PATTERNS: Mapping[str, str] = {WORDS: r"[^\x20\x09-\x0D]+", PIECES: r"[a-zA-Z0-9]+|[^a-zA-Z0-9\x20\x09-\x0D]"}


def count_tokens(text: Column, version: str) -> Column:
    """Number of tokens of a text under a version; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(PATTERNS[version])), F.lit(0)).cast("long")


def changes(docs: DataFrame, action: str, version: str, order: int = 0) -> DataFrame:
    """The same change for every row of `docs`, with its count under a tokenizer version."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.lit(version).alias("tokenizer"),
        F.col("source").cast("string").alias("source"),
        F.col("lang").cast("string").alias("lang"),
        count_tokens(F.col("text"), version).alias("n_tokens"),
        F.lit(action).alias("action"),
        F.lit(order).alias("change_order"),
    )


def _beside(rows: DataFrame, others: DataFrame, how: str) -> DataFrame:
    """Rows joined with `others` by document and tokenizer version, null or not."""
    named = others.withColumnsRenamed({c: f"other_{c}" for c in DOCUMENT})
    same = F.lit(True)
    for c in DOCUMENT:
        same = same & F.col(c).eqNullSafe(F.col(f"other_{c}"))
    return rows.join(named, same, how).drop(*[f"other_{c}" for c in DOCUMENT])


class TokenRollup:
    """A rollup stored under `path`: `deltas/batch=N` and `ledger/batch=N`, written once per batch."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def _folder(self, kind: str, batch: int) -> str:
        return f"{self.path}/{kind}/batch={batch}"

    def _done(self, kind: str, batch: int) -> bool:
        mark = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self._folder(kind, batch)}/_SUCCESS")
        return mark.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(mark)

    def batches(self) -> list[int]:
        """Numbers of the committed batches. The deltas are written last and make the commit."""
        root = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/deltas")
        files = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(root):
            return []
        names = [s.getPath().getName() for s in files.listStatus(root)]
        numbers = [int(n.split("=")[1]) for n in names if n.startswith("batch=")]
        return sorted(n for n in numbers if self._done("deltas", n))

    def _read(self, kind: str, schema: str, batches: list[int]) -> DataFrame:
        paths = [self._folder(kind, n) for n in batches]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _live(self) -> DataFrame:
        """Ledger rows since the last batch that replaced or ended the rows of their document and version."""
        base, covered = self._base()
        rows = self._read("ledger", LEDGER_SCHEMA, [n for n in self.batches() if n not in covered])
        rows = rows if base is None else rows.unionByName(base)
        anew = rows.filter("anew").groupBy(*DOCUMENT).agg(F.max("turn").alias("since"))
        found = _beside(rows, anew, "left").filter(F.col("since").isNull() | (F.col("turn") >= F.col("since")))
        return found.filter("copies > 0").select(*DOCUMENT, "source", "lang", "n_tokens", "copies")

    def _base(self) -> tuple[DataFrame | None, set[int]]:
        """The newest compacted ledger, and the batches that it covers."""
        root = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/base")
        files = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in files.listStatus(root)] if files.exists(root) else []
        for turn in sorted((int(n.split("=")[1]) for n in names), reverse=True):
            folder = f"{self.path}/base/turn={turn}"
            if files.exists(self.spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/batches/_SUCCESS")):
                covered = {r["batch"] for r in self.spark.read.schema("batch long").parquet(f"{folder}/batches").collect()}
                return self.spark.read.schema(LEDGER_SCHEMA).parquet(f"{folder}/rows"), covered
        return None, set()

    def compact(self) -> None:
        """Write the live rows of all committed batches as one table; the list of the batches, written last, commits it."""
        numbers = self.batches()
        folder = f"{self.path}/base/turn={len(numbers)}"
        rows = self.ledger().select("*", F.lit(False).alias("anew"), F.lit(0).cast("long").alias("turn"))
        if numbers and len(numbers) != len(self._base()[1]):
            rows.write.mode("overwrite").parquet(f"{folder}/rows")
            self.spark.createDataFrame([(n,) for n in numbers], "batch long").write.mode("overwrite").parquet(f"{folder}/batches")

    def ledger(self) -> DataFrame:
        """Live rows: how many a document and tokenizer version has of each source, language and count."""
        return self._live().groupBy(*DOCUMENT, "source", "lang", "n_tokens").agg(F.sum("copies").alias("copies"))

    def apply(self, batch: int, events: DataFrame) -> bool:
        """Commit a batch of changes; False if that batch is there already (nothing is done then)."""
        committed = self.batches()
        if batch in committed:
            return False
        place = F.struct("change_order").alias("place")  # null goes first
        summed = events.groupBy(*DOCUMENT, "source", "lang", "n_tokens", "action", "change_order").agg(F.count(F.lit(1)).alias("n"))
        turns = events.filter(F.col("action") != INSERT).select(*DOCUMENT, F.struct(place, (F.col("action") == REVISE).alias("revised")).alias("last"))
        last = turns.groupBy(*DOCUMENT).agg(F.max("last").alias("last"))
        rows = _beside(summed, last, "left").withColumn("place", place)
        added = (F.col("action") == INSERT) & (F.col("last").isNull() | (F.col("place") >= F.col("last.place")))
        set_now = (F.col("action") != INSERT) & (F.col("place") == F.col("last.place")) & ((F.col("action") == REVISE) == F.col("last.revised"))
        (
            rows.filter(added | set_now)
            .select(*DOCUMENT, "source", "lang", "n_tokens", F.when(F.col("action") == DELETE, 0).otherwise(F.col("n")).cast("long").alias("copies"),
                    F.col("last").isNotNull().alias("anew"), F.lit(len(committed) + 1).cast("long").alias("turn"))
            .write.mode("overwrite").parquet(self._folder("ledger", batch))
        )
        self._write_deltas(batch)
        return True

    def _write_deltas(self, batch: int) -> None:
        """Signed sums of a batch, from its ledger rows and the rows that they replace."""
        rows = self.spark.read.schema(LEDGER_SCHEMA).parquet(self._folder("ledger", batch))
        signed = rows.filter("copies > 0").select(*KEYS, F.col("copies").alias("n_docs"), (F.col("copies") * F.col("n_tokens")).alias("n_tokens"))
        if self.batches():
            gone = _beside(self._live(), rows.filter("anew").select(*DOCUMENT), "left_semi")
            signed = signed.unionAll(gone.select(*KEYS, -F.col("copies"), -F.col("copies") * F.col("n_tokens")))
        sums = signed.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        sums.write.mode("overwrite").parquet(self._folder("deltas", batch))

    def totals(self) -> DataFrame:
        """Sums of all committed deltas; keys without documents are left out."""
        deltas = self._read("deltas", DELTA_SCHEMA, self.batches())
        sums = deltas.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        return sums.filter("n_docs <> 0 or n_tokens <> 0")
