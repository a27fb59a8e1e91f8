"""Helpers shared by the training-data operators: shared-folder tables, Arrow loops, word hashing."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import shared_path

#: Rows turned into Python objects at once inside a task; keeps memory flat when texts are long.
SLICE_ROWS = 256

#: Bits of an id bitmap at most, 32 MB.
MOST_BITS = 1 << 28

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
#: bytes.translate table: ASCII capitals to small letters, ASCII white space to blanks, all else unchanged.
LOWER_WORDS = bytes.maketrans(_UPPER + b"\t\n\x0b\x0c\r", _LOWER + b"     ")
#: bytes.translate table: small ASCII letters, digits and bytes of non-ASCII characters stay, the rest becomes a blank.
WORDS_ONLY = bytes(
    (b + 32 if 65 <= b <= 90 else b) if b >= 128 or 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 else 32
    for b in range(256)
)


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing uses yet."""
    return shared_path(spark, label)


def short_batches(spark: SparkSession) -> None:
    """Lets Spark send whole texts to Python in batches of 1,024 rows where the session leaves the number at Spark's default of
    10,000: up to 64 MB a batch, held on both sides by every task, are then a few. A number that the user chose stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000" and not spark.sparkContext.getConf().contains(key):
        spark.conf.set(key, "1024")


def unused(df: DataFrame, name: str) -> str:
    """name, or the like, that no column of df has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def materialise(df: DataFrame, label: str, rows: int | None = None, rows_a_task: int = 50_000) -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it back: it cuts the lineage, survives the loss of
    executors, and lets later steps read single columns. rows: a bound of df's rows, if one is known, so that a small result
    of a wide shuffle takes a few tasks of rows_a_task rows and is a few files; it never makes the tasks more than they are."""
    spark = df.sparkSession
    path = new_path(spark, label)
    if rows is not None:
        df = df.coalesce(rows // rows_a_task + 1)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _array(values, kind: pa.DataType) -> pa.Array:
    return (values if values.type == kind else values.cast(kind)) if isinstance(values, pa.Array) else pa.array(values, kind)


def map_rows(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], dict]], schema: str, arrow: pa.Schema) -> DataFrame:
    """mapInArrow over slices of SLICE_ROWS rows. make() runs once per task and returns the function from a record batch
    to the columns of the result; every column that df has but the function does not return is left out."""
    short_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                got = work(batch.slice(at, SLICE_ROWS))
                yield pa.RecordBatch.from_arrays([_array(got[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def hash_bitmap(hashes: DataFrame) -> np.ndarray:
    """Bits, as unsigned bytes, at the places that the hashes (one column of longs, repeats allowed) say: 16 bits a hash, a
    power of two in number and MOST_BITS at most. Only the bitmap's 64-bit words come to the driver."""
    bits = min(MOST_BITS, 1 << max(16, (16 * hashes.count()).bit_length()))
    h = hashes.columns[0]
    placed = hashes.select(F.expr(f"shiftright(pmod({h}, {bits}L), 6)").alias("word"), F.expr(f"shiftleft(1L, cast(pmod({h}, 64L) as int))").alias("bit"))
    words = placed.groupBy("word").agg(F.bit_or("bit").alias("bit")).toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[words["word"].to_numpy()] = words["bit"].to_numpy()
    return out.view(np.uint8)


def in_bitmap(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which of the hashes (signed longs) have their bit set."""
    at = h & (8 * len(bitmap) - 1)
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit scrambler (xor-shift and multiply rounds)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k-word grams of a word-hash array, one per start; the order of the words counts."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n]
        out ^= out >> np.uint64(29)
    return mixed(out)


_ROOT = 0xD1342543DE82EF95  # of the polynomial; 5 modulo 8, so its powers differ in low bits
_BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_SEGMENT = 1 << 18


def _powers(root: int, n: int) -> np.ndarray:
    out = np.full(n, root, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_ROOT, _SEGMENT), _powers(pow(_ROOT, -1, 2**64), _SEGMENT)


def word_hashes(raw: bytes) -> np.ndarray:
    """64-bit hashes of the words of raw, which blanks part, in order. A word's hash is a polynomial over its bytes modulo
    2**64, taken for all words at once from one running sum, and scrambled."""
    parts, at = [], 0
    while at < len(raw):
        end = min(len(raw), at + _SEGMENT)
        if end < len(raw):
            cut = raw.rfind(b" ", at, end)
            if cut < 0:  # a word longer than a segment
                cut = raw.find(b" ", end)
                end = len(raw) if cut < 0 else cut
            else:
                end = cut
        parts.append(_segment_hashes(np.frombuffer(raw, np.uint8, end - at, at)))
        at = end + 1
    return np.concatenate(parts) if parts else np.empty(0, np.uint64)


def _segment_hashes(buf: np.ndarray) -> np.ndarray:
    up, down = (_UP, _DOWN) if len(buf) <= _SEGMENT else (_powers(_ROOT, len(buf)), _powers(pow(_ROOT, -1, 2**64), len(buf)))
    inside = np.zeros(len(buf) + 2, np.int8)
    inside[1:-1] = buf != 32
    edge = np.diff(inside)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return np.empty(0, np.uint64)
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_BYTES[buf] * up[: len(buf)], out=total[1:])
    return mixed((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))
