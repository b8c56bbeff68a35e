"""Small pieces shared by the operators: table reads, batch sizes, folds and word rules."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word everywhere in this subpackage: a run without ASCII white space. ``bytes.split()`` cuts
# at exactly the same characters.
WORD = r"[^\x20\x09-\x0D]+"

# Rows and bytes of one Arrow batch: texts may be long, so a batch stays at some megabytes.
BATCH_CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}


def small_batches(spark: SparkSession) -> None:
    """Bound Arrow batches of this session (documents can be very long)."""
    for k, v in BATCH_CONF.items():
        spark.conf.set(k, v)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def drop(spark: SparkSession, path: str) -> None:
    """Remove a table from the shared folder."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def row_key(text_col: str, *others: str) -> Column:
    """A key of a row's values: rows agree where text and other columns do, nulls included."""
    parts = [x for c in (text_col, *others) for x in (F.col(c).isNull(), F.col(c))]
    return F.concat(F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary")), F.hex(F.xxhash64(*parts)))


def crc_fold(id_col: Column, mod: int = 5) -> Column:
    """``crc32(id as text) mod 5``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % mod


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a text column without decoding; null is empty."""
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


def texts(column: pa.Array) -> list[str]:
    return [t or "" for t in column.to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Cut incoming batches to at most ``rows`` rows."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


#: Bits of a filter for each member (a power of two above), its smallest and its largest size (128 MB).
BITS_EACH, MIN_BITS, MAX_BITS = 16, 2 ** 16, 2 ** 30


class BitFilter:
    """A set of hashes as bits, of bounded size; may say yes to a hash that is no member, never no to
    one that is."""

    def __init__(self, bits: int, cells: np.ndarray | None = None):
        self.bits = bits
        self.cells = cells if cells is not None else np.zeros(max(1, bits // 8), np.uint8)

    def holds(self, h: np.ndarray) -> np.ndarray:
        at = h & np.uint64(self.bits - 1)
        return (self.cells[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def bit_filter(hashes: DataFrame, min_bits: int = MIN_BITS) -> BitFilter:
    """The filter of the hashes ``h`` (long), sized by their number: ``BITS_EACH`` bits or more for each
    of them, from ``min_bits`` up to ``MAX_BITS``.

    Bits are set by Spark, in rows of 2^20 of them; what reaches the driver is the filter itself.
    """
    bits, n = min_bits, hashes.count()
    while bits < n * BITS_EACH and bits < MAX_BITS:
        bits *= 2
    at = F.col("h").bitwiseAND(F.lit(bits - 1))
    cells = (hashes.select(F.shiftright(at, 6).alias("cell"), at.bitwiseAND(F.lit(63)).cast("int").alias("bit"))
             .groupBy("cell").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("set"))
             .withColumn("part", F.shiftright("cell", 14)))

    def fill(key: tuple[pa.Scalar, ...], g: pa.Table) -> pa.Table:
        row = np.zeros(min(bits, 1 << 20) // 64, np.int64)
        row[g["cell"].to_numpy() & (2 ** 14 - 1)] = g["set"].to_numpy()
        return pa.table({"part": [key[0].as_py()], "row": pa.array([row.tobytes()], pa.binary())})

    out = BitFilter(bits)
    for part, row in cells.groupBy("part").applyInArrow(fill, "part long, row binary").toLocalIterator():
        start = part << 17
        out.cells[start:start + len(row)] = np.frombuffer(row, np.uint8)
    return out


def local_components(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Smallest member of each node's component, for ``n`` nodes and the links ``u``-``v``.

    Minimum hooking with pointer jumping: each round halves the depth of the label trees.
    """
    lab = np.arange(n)
    if len(u) == 0:
        return lab
    while True:
        lu, lv = lab[u], lab[v]
        lo, hi = np.minimum(lu, lv), np.maximum(lu, lv)
        if (lo == hi).all():
            return lab
        np.minimum.at(lab, hi, lo)
        while True:
            nxt = lab[lab]
            if (nxt == lab).all():
                break
            lab = nxt
