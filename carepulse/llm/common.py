"""Shared parts of the corpus operators: Arrow batches, byte kernels, shared-folder tables.

Conventions that hold for every operator of this subpackage:

* a document is one input row; rows that repeat a ``doc_id`` stay separate rows;
* a null text counts as an empty text; a null ``doc_id`` is a value like any other;
* input columns beside the ones an operator reads are ignored unless they are
  named in ``carry``; a carried column that has the name of a result column is
  replaced by the result.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from carepulse.session import ensure_checkpoint_dir

#: Texts handled together in one numpy pass, in bytes.  A longer text is a pass of its own.
CHUNK_BYTES = 1 << 19

_U = np.uint64
#: Base of the polynomial hashes modulo 2**64 and its inverse (both odd, so powers never vanish).
BASE = 0x9E3779B97F4A7C15
BASE_INV = pow(BASE, -1, 1 << 64)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: cuts the lineage,
    and a lost executor costs a re-read, never a recomputation of what came before."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_table(df: DataFrame) -> None:
    """Delete the files of a ``checkpoint_table`` that no later plan reads."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


_SHIPPED: set[str] = set()


def map_arrow(df: DataFrame, f: Callable, schema: StructType | str) -> DataFrame:
    """``df.mapInArrow`` with this package sent to the executors once per application, wherever they run."""
    sc = df.sparkSession.sparkContext
    if sc.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parents[1]
        to = Path(tempfile.mkdtemp(prefix="carepulse-code-")) / "carepulse_code.zip"  # served by the driver, not a shared file
        with zipfile.ZipFile(to, "w") as z:
            for file in sorted(package.rglob("*.py")):
                z.write(file, file.relative_to(package.parent))
        sc.addPyFile(str(to))
        _SHIPPED.add(sc.applicationId)
    return df.mapInArrow(f, schema)


def result_schema(df: DataFrame, carry: list[str], result: str) -> StructType:
    """Schema of the carried columns that keep their name, then the result columns."""
    out = StructType.fromDDL(result)
    kept = [df.schema[c] for c in carry if c not in out.names]
    return StructType(kept + out.fields)


def hand_back(collect: bool = True) -> None:
    """Return to the system what a task has freed: its worker process is used again and would hold it while others need it."""
    if collect:
        gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


def map_texts(df: DataFrame, result: str, work: Callable[[], Callable], carry: list[str], text: str = "text", after: Callable[[], None] | None = None) -> DataFrame:
    """Append result columns computed from ``text``; no shuffle.

    ``work()`` is called once per task and returns ``f(texts) -> list of arrays``,
    where ``texts`` is an Arrow string array without nulls of about
    ``CHUNK_BYTES`` bytes, and each array has one value per text.  ``after()`` is called when a task has let go of ``f``.
    """
    schema = result_schema(df, carry, result)
    kept = [c for c in carry if c not in StructType.fromDDL(result).names]
    n_kept = len(kept)
    arrow = to_arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = work()
        for batch in batches:
            for part in chunks(batch, batch.num_columns - 1):
                texts = part.column(part.num_columns - 1).fill_null("")
                made = [x if isinstance(x, pa.Array) else pa.array(x) for x in f(texts)]
                cols = [part.column(i) for i in range(n_kept)] + made
                yield pa.RecordBatch.from_arrays([c if c.type == t.type else c.cast(t.type) for c, t in zip(cols, arrow, strict=True)], schema=arrow)
        if after:
            f = texts = made = None
            after()

    return map_arrow(df.select(*[df[c] for c in kept], df[text].alias("__text")), run, schema)


def to_arrow(schema: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(schema)


def chunks(batch: pa.RecordBatch, column: int, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts take about ``limit`` bytes; every row is in one slice."""
    off, _ = utf8(batch.column(column), data=False)
    at, n = 0, batch.num_rows
    while at < n:
        to = int(np.searchsorted(off, off[at] + limit, "right")) - 1
        to = min(max(to, at + 1), n)
        yield batch.slice(at, to - at)
        at = to


def utf8(texts: pa.Array, data: bool = True) -> tuple[np.ndarray, np.ndarray | None]:
    """Offsets (from 0) and bytes of an Arrow string array; nulls are empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    bufs = texts.buffers()
    n = len(texts)
    if n == 0 or bufs[1] is None:
        return np.zeros(n + 1, np.int64), np.zeros(0, np.uint8)
    off = np.frombuffer(bufs[1], np.int64 if wide else np.int32)[texts.offset:texts.offset + n + 1].astype(np.int64)
    if not data:
        return off, None
    raw = np.frombuffer(bufs[2], np.uint8)[off[0]:off[-1]] if bufs[2] is not None else np.zeros(0, np.uint8)
    return off - off[0], raw


def per_text(mask: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sum of an integer or boolean array over each text's stretch; exact in any order."""
    total = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=total[1:])
    return total[off[1:]] - total[off[:-1]]


def byte_set(pattern: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(pattern)] = True
    return out


#: Bytes of a word: all but space and 9 to 13.
WORD = ~byte_set(bytes([32, 9, 10, 11, 12, 13]))
#: Bytes of a word of letters and digits: 0-9, a-z and all beyond ASCII (A-Z are lowered first).
ALNUM = byte_set(bytes([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def words(data: np.ndarray, off: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of all texts, and the first word of each text (n + 1 values)."""
    inside = member[data]
    first = np.zeros(len(data) + 1, bool)
    first[off] = True
    before = np.empty(len(data), bool)
    before[:1] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | first[:-1]))
    after = np.empty(len(data), bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | first[1:])) + 1
    return starts, ends, np.searchsorted(starts, off)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64 over unsigned 64-bit values."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


#: A random value for each byte, from the finaliser.
BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
_POWERS: dict[int, np.ndarray] = {}


def powers(n: int, base: int = BASE) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64; kept per process, grown when asked for more."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        made = np.full(max(n, 1 << 16), base, np.uint64)
        made[0] = 1
        have = _POWERS[base] = np.multiply.accumulate(made)
    return have[:n]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Polynomial hash of each prefix (n + 1 values), modulo 2**64."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUE[data] * powers(len(data)), out=out[1:])
    return out


def slice_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each stretch [start, end), the same wherever its bytes stand; the length is part of it."""
    h = (prefix[ends] - prefix[starts]) * powers(len(prefix), BASE_INV)[starts]
    return mix(h + (ends - starts).astype(np.uint64) * _U(0xD6E8FEB86659FD93))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def row_key(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``__id`` and ``__sum``, which name a row by its doc_id and a 64-bit checksum of its text.
    Rows that agree in both are the same document twice and get the same results."""
    from pyspark.sql import functions as F
    return df.withColumns({"__id": F.col("doc_id"), "__sum": F.xxhash64(F.coalesce(F.col(text), F.lit("")))})


def same_row(a: DataFrame, b: DataFrame):
    return a["__id"].eqNullSafe(b["__id"]) & (a["__sum"] == b["__sum"])
