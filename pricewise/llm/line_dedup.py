"""Line dedup over levelled sorted runs of line keys.

The documents' line keys are gathered in one scan and written by batch; batches ascend in
doc_id, and their number grows with the texts' bytes. The store of known lines is a set of
*runs*: tables of (key hash, owner), bucketed and sorted by hash, all with the same buckets. A
batch is ingested in three steps: its distinct keys are gathered with the smallest doc_id of
each (map-side aggregation, so a line that a third of all documents hold is one row per task),
they are merge-anti-joined with one run after the other, which needs no exchange on either
side once the batch is dealt into the same buckets, and the rest becomes a new run of level 0.
When a level holds ``fanout`` runs they are compacted, bucket by bucket, into one run of the
next level, so the store has a logarithmic number of runs. As batches ascend, the owner of a
key is the smallest doc_id that holds it.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends, A-Z in lower case. Keys of
at least 10 code points keep their lines in the owner only. Key hashes are 128 bits.

Defined cases: a null or empty text is one empty line; rows with the same doc_id are one
document; rows without doc_id are one document that comes last; extra columns are not read
by the query (``drop_repeated_lines`` hands them on). What a row loses is gathered by doc_id and
hash of its text, so a doc_id of many rows, or none, is no group of its own.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh_path, read, shuffle_partitions, text_bytes
from .textblock import (SEPARATOR, Texts, ascii_lower, batch_slices, byte_sums,
                        range_hash, slices)

MIN_KEY_CHARS = 10
#: Stands for a missing doc_id: after every other.
LAST = 2**63 - 1
KEY = ["h1", "h2"]
#: Bytes of texts that make a batch, and batches that there are at least.
BATCH_BYTES, LEAST_BATCHES = 8 << 30, 4
#: Bytes of texts for each bucket of a run.
BUCKET_BYTES = 64 << 20


def line_hashes(t: Texts) -> tuple[np.ndarray, ...]:
    """Begin, end and document of every line of a slice, whether its key counts, and the
    two halves of the key's hash."""
    begin, end, doc = t.lines()
    solid = np.append(np.nonzero(~SEPARATOR[t.data])[0], len(t.data))
    first = np.minimum(solid[np.searchsorted(solid, begin)], end)
    last = solid[np.maximum(0, np.searchsorted(solid, end) - 1)] + 1
    last = np.where(first < end, last, first)
    points = np.append(0, np.cumsum((t.data & 0xC0) != 0x80))
    counts = points[last] - points[first] >= MIN_KEY_CHARS
    lower = ascii_lower(t.data)
    halves = [range_hash(byte_sums(lower, second), first, last).view(np.int64)
              for second in (False, True)]
    return begin, end, doc, counts, *halves


def owner_id() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))


def text_hash() -> Column:
    """As ``_text_hashes`` of the texts (null ones as empty)."""
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def _text_hashes(t: Texts) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(t.text(i), seed=42) for i in range(len(t))], np.uint64).view(np.int64)


def _keyed(bounds: list[int]):
    """Batches are numbered by the doc_ids at which they begin."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in slices(batches):
            _, _, doc, counts, h1, h2 = line_hashes(t)
            doc = doc[counts]
            who = np.where(t.null_id, LAST, t.ids)
            batch = np.searchsorted(np.array(bounds, dtype=np.int64), who, side="right").astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a) for a in (who[doc], _text_hashes(t)[doc], h1[counts], h2[counts], batch[doc])],
                ["who", "part", "h1", "h2", "batch"])
    return run


KEYED_SCHEMA = "who long, part long, h1 long, h2 long, batch int"


def keyed_lines(docs: DataFrame, bounds: list[int]) -> DataFrame:
    """(who, part, h1, h2, batch) of every line whose key counts; (who, part) are a row's doc_id
    and its text's hash. Written by batch, so that each batch is read by itself."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    path = fresh_path(spark, "line-keys")
    rows.mapInArrow(_keyed(bounds), KEYED_SCHEMA).write.partitionBy("batch").parquet(path)
    return spark.read.schema(KEYED_SCHEMA).parquet(path)


@dataclass
class LevelledRuns:
    """Sorted runs of (h1, h2, owner) in the shared folder, as tables of ``buckets`` buckets. The
    list of runs is the only state on the driver: a table name per run."""
    spark: SparkSession
    folder: str
    fanout: int = 4
    buckets: int = 8
    levels: list[list[str]] = field(default_factory=list)
    written: int = 0
    compactions: int = 0

    def _write(self, rows: DataFrame, level: int) -> None:
        """``rows`` are dealt into the buckets already."""
        name = "line_run_" + self.folder.rsplit("-", 1)[-1] + f"_{level}_{self.written}"
        self.written += 1
        rows.write.bucketBy(self.buckets, *KEY).sortBy(*KEY) \
            .option("path", f"{self.folder}/{name}").saveAsTable(name)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)

    def runs(self) -> list[str]:
        return [r for level in self.levels for r in level]

    def dealt(self, rows: DataFrame) -> DataFrame:
        return rows.repartition(self.buckets, *KEY)

    def known(self) -> DataFrame:
        """Every known key with its owner; a key is in one run only."""
        out = self.spark.createDataFrame([], "h1 long, h2 long, owner long")
        for run in self.runs():
            out = out.unionByName(self.spark.table(run))
        return out

    def fresh(self, batch: DataFrame) -> DataFrame:
        """(h1, h2, owner) of the keys of ``batch`` (who, h1, h2) that no run holds."""
        out = self.dealt(batch.groupBy(*KEY).agg(F.min("who").alias("owner")))
        for run in self.runs():
            out = out.join(self.spark.table(run).select(*KEY).hint("merge"), KEY, "left_anti")
        return out

    def ingest(self, batch: DataFrame) -> None:
        """Add the keys of ``batch`` that no run holds."""
        self._write(self.fresh(batch), 0)
        self.compact()

    def compact(self) -> None:
        """Merge the runs of every level that is full into one of the next level. The merged runs
        leave the catalogue; their files go with the folder (``session.remove_scratch``)."""
        for level, runs in enumerate(self.levels):
            if len(runs) >= self.fanout:
                merged = self.spark.table(runs[0])
                for run in runs[1:]:
                    merged = merged.unionByName(self.spark.table(run))
                self.levels[level] = []
                self._write(self.dealt(merged), level + 1)
                self.compactions += 1
                for run in runs:
                    self.spark.sql(f"DROP TABLE {run}")
                return self.compact()
        return None


def batches_of(total: int, least: int = LEAST_BATCHES, batch_bytes: int = BATCH_BYTES) -> int:
    """Number of batches of texts of ``total`` bytes."""
    return max(least, -(-total // batch_bytes))


def batch_bounds(docs: DataFrame, batches: int) -> list[int]:
    """doc_ids at which batches begin, by approximate quantiles: balance only, any bounds
    give the same result."""
    if batches < 2:
        return []
    at = [i / batches for i in range(1, batches)]
    found = docs.select(F.percentile_approx("doc_id", at, 1000).alias("q")).first()["q"]
    return sorted({int(x) for x in found or []})


def ingest_all(docs: DataFrame, batches: int | None = None, fanout: int = 4) -> tuple[LevelledRuns, DataFrame]:
    """Runs over all lines of ``docs``, in batches of ascending doc_id, and the keyed lines."""
    spark = docs.sparkSession
    total = text_bytes(docs)
    bounds = batch_bounds(docs, batches or batches_of(total))
    buckets = int(max(shuffle_partitions(spark), -(-total // BUCKET_BYTES)))
    runs = LevelledRuns(spark, fresh_path(spark, "line-runs"), fanout, buckets)
    keyed = keyed_lines(docs, bounds)
    for batch in range(len(bounds) + 1):
        runs.ingest(keyed.filter(F.col("batch") == batch))
    return runs, keyed


def repeated_lines(keyed: DataFrame, runs: LevelledRuns) -> DataFrame:
    """(who, part, gone): per document and text the keys of its lines that another document
    owns. Keys and runs are dealt anew, so that a key of many lines can be split."""
    hits = keyed.join(runs.known(), KEY).filter(F.col("owner") != F.col("who"))
    return hits.groupBy("who", "part").agg(F.collect_set(F.struct(*KEY)).alias("gone"))


def _drop_lines(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc", "n_lines", "n_dropped", "kept_text"]
    for b in batches:
        gone, id_and_text = b.column("gone"), b.select(["doc_id", "text"])
        for row, stop, t in batch_slices(id_and_text):
            begin, end, doc, counts, h1, h2 = line_hashes(t)
            stays = np.ones(len(begin), dtype=bool)
            own = np.searchsorted(doc, np.arange(len(t) + 1))
            for i in np.nonzero(gone.slice(row, stop - row).is_valid().to_numpy(zero_copy_only=False))[0]:
                drop = {(x["h1"], x["h2"]) for x in gone[row + int(i)].as_py()}
                for k in range(own[i], own[i + 1]):
                    stays[k] = not (counts[k] and (int(h1[k]), int(h2[k])) in drop)
            n = np.bincount(doc, minlength=len(t))
            dropped = np.bincount(doc[~stays], minlength=len(t))
            texts = []
            for i in range(len(t)):
                if dropped[i]:
                    keep = [t.data[begin[k]:end[k]].tobytes() for k in range(own[i], own[i + 1]) if stays[k]]
                    texts.append(b"\n".join(keep))
                else:
                    texts.append(t.text(i))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc").slice(row, stop - row), pa.array(n.astype(np.int64)),
                 pa.array(dropped.astype(np.int64)), pa.array(texts, pa.binary()).cast(pa.string())], names)


def drop_repeated_lines(docs: DataFrame, batches: int | None = None, fanout: int = 4) -> DataFrame:
    """(doc, n_lines, n_dropped, kept_text): the other columns of every row of ``docs`` as
    the struct ``doc``, and what its lines come to."""
    runs, keyed = ingest_all(docs.select("doc_id", "text"), batches, fanout)
    gone = repeated_lines(keyed, runs)
    other = F.struct("doc_id", *(F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")))
    rows = docs.select(other.alias("doc"), F.col("doc_id").cast("long"),
                       F.col("text").cast("string"), owner_id().alias("who"), text_hash().alias("part"))
    joined = rows.join(gone, ["who", "part"], "left").select("doc", "doc_id", "text", "gone")
    schema = T.StructType([joined.schema["doc"], T.StructField("n_lines", T.LongType()),
                           T.StructField("n_dropped", T.LongType()), T.StructField("kept_text", T.StringType())])
    return joined.mapInArrow(_drop_lines, schema)


def line_counts(docs: DataFrame, batches: int | None = None, fanout: int = 4) -> DataFrame:
    """Per document: lines, lines dropped, and the kept text."""
    return drop_repeated_lines(docs.select("doc_id", "text"), batches, fanout).select(
        F.col("doc.doc_id").cast("long").alias("doc_id"), "n_lines", "n_dropped", "kept_text")


def without_repeated_lines(docs: DataFrame, batches: int | None = None, fanout: int = 4) -> DataFrame:
    """``docs`` with the kept lines as their text, and n_chars (if there) of that text. A
    document of which nothing but white space is left goes."""
    rows = drop_repeated_lines(docs, batches, fanout)
    kept = rows.filter((F.col("n_dropped") == 0) | F.col("kept_text").rlike(r"[^\x20\x09-\x0D]"))
    text = {"text": F.col("kept_text"),
            "n_chars": F.when(F.col("n_dropped") == 0, F.col("doc.n_chars"))
            .otherwise(F.char_length("kept_text")) if "n_chars" in docs.columns else None}
    return kept.select(*[(text[c].cast(docs.schema[c].dataType) if text.get(c) is not None
                          else F.col("doc").getField(c)).alias(c) for c in docs.columns])


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated lines dropped from all documents."""
    return line_counts(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


#: chr(9), chr(11) ... are the white space that DuckDB's literals can't escape.
OP4_SQL = """
WITH rows AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
lines AS (
    SELECT r, doc_id, t.line, t.pos,
           translate(trim(t.line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM (SELECT r, doc_id, unnest(string_split(text, chr(10))) AS line,
                 generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM rows) t),
owners AS (SELECT key, min(doc_id) AS owner FROM lines WHERE length(key) >= 10 GROUP BY key),
marked AS (
    SELECT l.r, l.doc_id, l.line, l.pos,
           coalesce(length(l.key) >= 10 AND o.owner <> l.doc_id, false) AS gone
    FROM lines l LEFT JOIN owners o ON l.key = o.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r, doc_id
"""
