"""Hard-negative mining: candidates in Hilbert order, in Parquet blocks with zone maps that tell which blocks an anchor reads.

Vectors are whole numbers (``vectors.whole``), a score is an inner product, exact.  An anchor's positives are its best
other rows of the same label; a positive's negatives are the best rows of other labels whose score lies in a window below
the positive's score.  Higher scores come first, ties by smaller vec_id.

* Rows are range-partitioned by their place on a Hilbert curve over the dimensions of largest spread and packed into
  blocks of bounded size, a row of a Parquet table each: ids, labels, vectors, and as zone map the least and greatest
  component of every dimension and the least and greatest label.  Zone maps are boxes; boxes of neighbouring blocks make
  pages, boxes of pages make further pages, up to one root page.
* Interval arithmetic gives the least and greatest score an anchor can have with a box.  Starting at the root, requests
  (up to ``BATCH`` anchors with their windows) follow the children whose interval meets a window of one of them, by
  equi-joins on the page, and end at the blocks that have to be read.  Everything else is proven to hold no result.
* Positives use one window, from the score that is fifth in the anchor's own block upwards; negatives use one for each
  positive, raised to the fifth negative of the anchor's own block where that holds five.

So each anchor is compared with the blocks that can matter, in matrix products of a bounded request and a bounded block;
no task holds more, and best lists are cut to their length in each task before they are shuffled.  How many blocks that
is depends on the data: vectors without clusters in 64 dimensions have wide intervals, and most blocks are read then.
Blocks, pages, positives and requests are tables in the shared checkpoint folder.

Rows with a null vec_id, a null label, a null vector or a null or non-finite component take no part; nor do rows with a
component of 2**23 or more or a squared length (after scaling) of 2**55 or more, whose scores may not fit the arithmetic.
Shorter vectors end in zeros.  Rows that repeat a vec_id are rows of their own: an anchor is compared with all rows but
itself, and repeated anchors each have their results.  A positive below zero has an empty window.  An empty table gives an
empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carepulse.llm import common as C
from carepulse.llm import hilbert, vectors

#: Sizes: bytes of a block's vectors and of a request's, rows at most in a block (12 bits of an anchor's key), children of a page.
BLOCK_BYTES, BATCH_BYTES = 1 << 18, 1 << 16
BLOCK_BITS, PAGE_BITS, SEQ_BITS, PARTS_BITS = 12, 9, 24, 8
#: Axes and bits of the curve.
AXES, KEY_BITS = 128, 128
#: Results held by a task before they are cut or passed on.
HELD = 1 << 19

_ZONE = "lo binary, hi binary, label_lo long, label_hi long"
_BLOCK = f"block long, n int, ids binary, labels binary, x binary, anchors binary, {_ZONE}"
_REQUEST = "node long, n int, aids binary, a_labels binary, a_x binary, lows binary, highs binary"
_FOUND = "aid long, w int, vec_id long, score long"


def _arrow(ddl: str) -> pa.Schema:
    from pyspark.sql.types import StructType
    return C.to_arrow(StructType.fromDDL(ddl))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def _i32(raw: bytes, dim: int) -> np.ndarray:
    return np.frombuffer(raw, np.int32).reshape(-1, dim)


def _i64(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.int64)


# ------------------------------------------------------------------------------------------------------------- layout ---
def _prepared(rows: DataFrame, anchor: Column) -> DataFrame:
    vec = F.col("embedding")
    kept = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & vectors.usable(vec, 2.0**31))
    kept = kept.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.coalesce(anchor, F.lit(False)).alias("anchor"), vectors.whole(vec).alias("x"))
    return kept.where(F.aggregate("x", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double")) < 2.0**55)


def _spread(rows: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of rows, and mean and standard deviation of each dimension: one row a dimension reaches the driver."""
    def run(batches):
        for b in batches:
            x = b.column(0)
            dim = max(1, int(np.diff(x.offsets.to_numpy()).max(initial=0)))
            m = vectors.matrix(x, dim).astype(np.float64)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim)), pa.array(np.r_[len(x), np.zeros(dim - 1, np.int64)]), pa.array(m.sum(0)), pa.array((m * m).sum(0))], names=["dim", "n", "s", "q"])

    got = C.map_arrow(rows.select("x"), run, "dim long, n long, s double, q double").groupBy("dim").agg(*[F.sum(c).alias(c) for c in "nsq"]).collect()
    n = sum(r["n"] for r in got)
    s, q = np.zeros(len(got)), np.zeros(len(got))
    for r in got:
        s[r["dim"]], q[r["dim"]] = r["s"], r["q"]
    mean = s / max(n, 1)
    return n, mean, np.sqrt(np.maximum(q / max(n, 1) - mean * mean, 0))


def _blocks(rows: DataFrame, n: int, mean: np.ndarray, std: np.ndarray) -> tuple[DataFrame, int]:
    """The rows along the curve, a row for each block; and the number of partitions they were dealt to."""
    dim = len(mean)
    axes = np.argsort(-std, kind="stable")[:AXES]
    bits = max(1, min(8, KEY_BITS // len(axes)))
    # cells are cubes, and an axis' mean lies a third into its range, so an axis of little spread is not cut in its middle
    low, high = (mean - std.max() * 4 / 3)[axes], (mean + std.max() * 8 / 3)[axes]
    size = max(16, min(1 << BLOCK_BITS, BLOCK_BYTES // (4 * dim)))

    def keyed(batches):
        for b in batches:
            m = vectors.matrix(b.column(3), dim)
            keys = hilbert.hilbert_keys(hilbert.cells(m[:, axes], low, high, bits), bits)
            raw = lambda a: pa.array([r.tobytes() for r in np.ascontiguousarray(a)], pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns[:3], raw(m.astype(np.int32)), raw(keys)], names=["vec_id", "label", "anchor", "x", "place"])

    schema = _arrow(_BLOCK)

    def packed(batches):
        from pyspark import TaskContext
        part, seq, held = TaskContext.get().partitionId(), 0, None

        def block(b: pa.RecordBatch, seq: int) -> pa.RecordBatch:
            x = np.frombuffer(b"".join(b.column(3).to_pylist()), np.int32).reshape(-1, dim)
            labels = b.column(1).to_numpy().astype(np.int64)
            picked = np.flatnonzero(b.column(2).to_numpy(zero_copy_only=False)).astype(np.int64)
            return _batch([((part << SEQ_BITS) | seq, len(x), b.column(0).to_numpy().tobytes(), labels.tobytes(), x.tobytes(), picked.tobytes(), x.min(0).tobytes(), x.max(0).tobytes(), int(labels.min()), int(labels.max()))], schema)

        for b in batches:
            held = b if held is None else pa.Table.from_batches([held, b]).combine_chunks().to_batches()[0] if b.num_rows else held
            at = 0
            while held.num_rows - at >= size:
                yield block(held.slice(at, size), seq)
                at, seq = at + size, seq + 1
            held = held.slice(at)
        if held is not None and held.num_rows:
            yield block(held, seq)

    spark = rows.sparkSession
    parts = max(1, -(-n // (size << PAGE_BITS)), min(2 * spark.sparkContext.defaultParallelism, -(-n // size)))
    # rows equal in every column differ in the last sort key, so that a great many of them are still several partitions
    placed = C.map_arrow(rows, keyed, "vec_id long, label long, anchor boolean, x binary, place binary").withColumn("tie", F.monotonically_increasing_id())
    order = ["place", "vec_id", "tie"]
    ranged = placed.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("place", "tie")
    blocks = C.checkpoint_table(C.map_arrow(ranged, packed, _BLOCK), "candidate-blocks")
    top = blocks.agg(F.max("block")).head()[0] or 0
    return blocks, (top >> SEQ_BITS) + 1


def _pages(boxes: DataFrame, shift: int, dim: int) -> DataFrame:
    """Boxes (node, zone map) gathered by ``node >> shift``: each page has its children's boxes as matrices and a box of its own."""
    out = f"page long, children binary, los binary, his binary, labels_lo binary, labels_hi binary, {_ZONE}"
    schema = _arrow(out)

    def run(batches):
        for b in batches:
            for page, children in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                los, his = (b"".join(c[k] for c in children) for k in ("lo", "hi"))
                ends = [np.array([c[k] for c in children], np.int64) for k in ("label_lo", "label_hi")]
                yield _batch([(page, np.array([c["node"] for c in children], np.int64).tobytes(), los, his, ends[0].tobytes(), ends[1].tobytes(), _i32(los, dim).min(0).tobytes(), _i32(his, dim).max(0).tobytes(), int(ends[0].min()), int(ends[1].max()))], schema)

    grouped = boxes.groupBy(F.shiftright("node", shift).alias("page")).agg(F.sort_array(F.collect_list(F.struct("node", "lo", "hi", "label_lo", "label_hi"))).alias("children"))
    return C.checkpoint_table(C.map_arrow(grouped, run, out), "zone-pages")


def _tree(blocks: DataFrame, parts: int, dim: int) -> list[DataFrame]:
    """Pages of all levels, the root's first.  A page has the boxes of 512 blocks, of some 256 pages or, above, of 512 pages."""
    zone = ("lo", "hi", "label_lo", "label_hi")
    levels = [_pages(blocks.select(F.col("block").alias("node"), *zone), PAGE_BITS, dim)]
    shift, left = SEQ_BITS - PAGE_BITS + PARTS_BITS, (parts - 1) >> PARTS_BITS
    while True:
        levels.insert(0, _pages(levels[0].select(F.col("page").alias("node"), *zone), shift, dim))
        if not left:
            return levels
        shift, left = PAGE_BITS, left >> PAGE_BITS


# ------------------------------------------------------------------------------------------------------------ scoring ---
def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of two whole-number matrices, exact.  By Cauchy and Schwarz no sum of some of a product's
    terms is greater than the two lengths multiplied, so floats that hold all whole numbers up to there make no error."""
    longest = math.sqrt(float((a.astype(np.float64) ** 2).sum(1).max(initial=0)) * float((b.astype(np.float64) ** 2).sum(1).max(initial=0)))
    kind = np.float32 if longest < 2**23 else np.float64 if longest < 2**52 else np.int64
    return (a.astype(kind) @ b.astype(kind).T).astype(np.int64)


def best(scores: np.ndarray, ids: np.ndarray, valid: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k valid entries of each row that come first by falling score, then id."""
    masked = np.where(valid, scores, np.iinfo(np.int64).min)
    if masked.shape[1] > k:
        valid = valid & (masked >= np.partition(masked, -k, axis=1)[:, -k, None])
    row, col = np.nonzero(valid)
    order = np.lexsort((ids[col], -scores[row, col], row))
    row, col = row[order], col[order]
    keep = np.arange(len(row)) - np.searchsorted(row, row) < k
    return row[keep], col[keep]


def _windows(positive: np.ndarray, percent: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest whole scores s with ``low * positive <= 100 * s <= high * positive``."""
    return -((-percent[0] * positive) // 100), percent[1] * positive // 100


def _seeded(scores, ids, allowed, lows, highs, k) -> np.ndarray:
    """Lows raised to the k-th best score that one block has in the window, where it has k."""
    out = lows.copy()
    for w in range(lows.shape[1]):
        row, col = best(scores, ids, allowed & (scores >= lows[:, w, None]) & (scores <= highs[:, w, None]), k)
        full = np.flatnonzero(np.bincount(row, minlength=len(scores)) == k)
        last = np.searchsorted(row, full, "right") - 1
        out[full, w] = scores[row[last], col[last]]
    return out


_LEAST, _MOST = -(2**60), 2**60


def _requests(source: DataFrame, dim: int, k: int, same: bool, percent: tuple[int, int] | None) -> DataFrame:
    """Anchors of the blocks in ``source`` in requests to the root, with windows seeded from their own block.

    With ``percent``, ``source`` also has ``positives``: (aid, w, score) of the anchors' positives."""
    size = max(16, BATCH_BYTES // (4 * dim))
    schema = _arrow(_REQUEST)

    def run(batches):
        held: list[tuple] = []

        def send():
            columns = [np.concatenate(c) for c in zip(*held, strict=True)]
            held.clear()
            for i in range(0, len(columns[0]), size):
                aids, labels, x, lows, highs = (c[i:i + size] for c in columns)
                yield _batch([(0, len(aids), aids.tobytes(), labels.tobytes(), x.tobytes(), lows.tobytes(), highs.tobytes())], schema)

        for b in batches:
            for r in b.to_pylist():
                ids, labels, x = _i64(r["ids"]), _i64(r["labels"]), _i32(r["x"], dim)
                if percent is None:
                    at = _i64(r["anchors"])
                    if not len(at):
                        continue
                    lows, highs = np.full((len(at), 1), _LEAST), np.full((len(at), 1), _MOST)
                else:
                    aid, w, score = (np.array([p[c] for p in r["positives"]], np.int64) for c in ("aid", "w", "score"))
                    at, back = np.unique(aid & ((1 << BLOCK_BITS) - 1), return_inverse=True)
                    lows, highs = np.full((len(at), k), _MOST), np.full((len(at), k), _LEAST)
                    lows[back, w], highs[back, w] = _windows(score, percent)
                scores = products(x[at], x)
                allowed = (labels[at][:, None] == labels) == same
                allowed[np.arange(len(at)), at] = False
                lows = _seeded(scores, ids, allowed, lows, highs, k)
                held.append(((r["block"] << BLOCK_BITS) | at, labels[at], x[at], lows, highs))
                if sum(len(h[0]) for h in held) >= size:
                    yield from send()
        if held:
            yield from send()

    return C.map_arrow(source, run, _REQUEST)


def _descend(requests: DataFrame, pages: DataFrame, root: bool, dim: int, same: bool) -> DataFrame:
    """Requests passed on to the children of their page that may have a result for one of their anchors."""
    schema = _arrow(_REQUEST)

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                n = r["n"]
                x = _i32(r["a_x"], dim).astype(np.float64)
                lo, hi = (_i32(r[c], dim).astype(np.float64).T for c in ("los", "his"))
                up, down = np.maximum(x, 0), np.minimum(x, 0)
                slack = np.abs(x) @ np.maximum(np.abs(lo), np.abs(hi)) * 1e-12
                most, least = up @ hi + down @ lo + slack, up @ lo + down @ hi - slack
                lows, highs = _i64(r["lows"]).reshape(n, -1), _i64(r["highs"]).reshape(n, -1)
                meets = ((most[:, :, None] >= lows[:, None, :]) & (least[:, :, None] <= highs[:, None, :]) & (lows <= highs)[:, None, :]).any(2)
                labels, first, last = _i64(r["a_labels"]), _i64(r["labels_lo"]), _i64(r["labels_hi"])
                holds = (labels[:, None] >= first) & (labels[:, None] <= last) if same else ~((labels[:, None] == first) & (labels[:, None] == last))
                meets &= holds
                children, aids, whole = _i64(r["children"]), _i64(r["aids"]), _i32(r["a_x"], dim)
                for c in np.flatnonzero(meets.any(0)):
                    at = np.flatnonzero(meets[:, c])
                    yield _batch([(int(children[c]), len(at), aids[at].tobytes(), labels[at].tobytes(), whole[at].tobytes(), lows[at].tobytes(), highs[at].tobytes())], schema)

    pages = pages.select("page", "children", "los", "his", "labels_lo", "labels_hi")
    # the root level is one page of bounded size; below, a page that many requests need is split by the join
    joined = requests.join(F.broadcast(pages) if root else pages, requests["node"] == pages["page"])
    return C.map_arrow(joined, run, _REQUEST)


def _read(requests: DataFrame, blocks: DataFrame, dim: int, k: int, same: bool) -> DataFrame:
    """(aid, w, vec_id, score): the k first rows in each anchor's windows among the blocks it reads."""
    schema = _arrow(_FOUND)

    def cut(parts: list[tuple]) -> list[np.ndarray]:
        aid, w, vec, score = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.lexsort((vec, -score, w, aid))
        aid, w, vec, score = aid[order], w[order], vec[order], score[order]
        new = np.r_[True, (aid[1:] != aid[:-1]) | (w[1:] != w[:-1])]
        start = np.maximum.accumulate(np.where(new, np.arange(len(aid)), 0))
        keep = np.arange(len(aid)) - start < k
        return [c[keep] for c in (aid, w, vec, score)]

    def out(columns):
        return pa.RecordBatch.from_arrays([pa.array(c).cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    def run(batches):
        parts: list[tuple] = []
        held = 0
        for b in batches:
            for r in b.to_pylist():
                aids, labels, ids = _i64(r["aids"]), _i64(r["labels"]), _i64(r["ids"])
                scores = products(_i32(r["a_x"], dim), _i32(r["x"], dim))
                allowed = (_i64(r["a_labels"])[:, None] == labels) == same
                own = np.flatnonzero(aids >> BLOCK_BITS == r["block"])
                allowed[own, aids[own] & ((1 << BLOCK_BITS) - 1)] = False
                lows, highs = (_i64(r[c]).reshape(len(aids), -1) for c in ("lows", "highs"))
                for w in range(lows.shape[1]):
                    row, col = best(scores, ids, allowed & (scores >= lows[:, w, None]) & (scores <= highs[:, w, None]), k)
                    parts.append((aids[row], np.full(len(row), w, np.int64), ids[col], scores[row, col]))
                    held += len(row)
                if held > HELD:
                    parts = [tuple(cut(parts))]
                    held = len(parts[0][0])
                    if held > HELD // 2:  # of so many anchors that cutting doesn't help
                        yield out(parts.pop())
                        held = 0
        if held:
            yield out(cut(parts))

    some = blocks.select("block", "ids", "labels", "x")
    found = C.map_arrow(requests.join(some, requests["node"] == some["block"]), run, _FOUND)
    first = F.row_number().over(Window.partitionBy("aid", "w").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", first).where(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, anchor: Column, n_positives: int = 5, n_negatives: int = 5, percent: tuple[int, int] = (80, 100)) -> DataFrame:
    """For each anchor and positive its hard negatives: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` has vec_id, embedding and label; ``anchor`` says which rows are anchors.  ``percent`` are the ends of the window
    of a negative's score, in hundredths of the positive's.  The numbers of positives and negatives are at most ``1 << BLOCK_BITS``.
    """
    prepared = _prepared(rows, anchor)
    n, mean, std = _spread(prepared)
    if not n:
        return rows.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    blocks, parts = _blocks(prepared, n, mean, std)
    dim = len(mean)
    tree = _tree(blocks, parts, dim)

    def search(source: DataFrame, k: int, same: bool, window: tuple[int, int] | None) -> DataFrame:
        asked = _requests(source, dim, k, same, window)
        for level, pages in enumerate(tree):
            asked = _descend(asked, pages, level == 0, dim, same)
        return _read(asked, blocks, dim, k, same)

    asking = blocks.where(F.octet_length("anchors") > 0)
    positives = C.checkpoint_table(search(asking.select("block", "ids", "labels", "x", "anchors"), n_positives, True, None), "positives")
    # a block's anchors have a bounded number of positives
    by_block = positives.groupBy(F.shiftright("aid", BLOCK_BITS).alias("own")).agg(F.collect_list(F.struct("aid", (F.col("rank") - 1).alias("w"), "score")).alias("positives"))
    source = asking.join(by_block, F.col("block") == F.col("own")).select("block", "ids", "labels", "x", "positives")
    negatives = search(source, n_negatives, False, percent)
    anchors = _anchors(asking)
    pos = positives.select("aid", (F.col("rank") - 1).alias("w"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")).join(anchors, "aid")
    neg = negatives.select("aid", "w", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return pos.join(neg, ["aid", "w"]).select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def _anchors(asking: DataFrame) -> DataFrame:
    """(aid, anchor_id) of all anchors."""
    def run(batches):
        for b in batches:
            for block, ids, picked in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                at = _i64(picked)
                yield pa.RecordBatch.from_arrays([pa.array((block << BLOCK_BITS) | at), pa.array(_i64(ids)[at])], names=["aid", "anchor_id"])

    return C.map_arrow(asking.select("block", "ids", "anchors"), run, "aid long, anchor_id long")
