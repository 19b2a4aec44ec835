"""Quality rules: base rules, then a hashed n-gram log-likelihood ratio.

The ratio compares two multinomials over hashed byte n-grams: the trusted target
(documents labelled good) and the raw corpus (every document).  A document's score
is the mean over its n-grams of ``log p_target - log p_raw``, so it does not grow
with length.  Log ratios are held as integers (``SCALE`` per nat); sums are exact
and every document's verdict is the same whatever the partitioning.

* Raw counts come from every byte of every document; they are summed in each task,
  then by bucket, and the two models have ``buckets`` rows each, whatever the input.
* Target and junk examples are all labelled documents; labels meet documents in a join, and texts are counted where they meet.
  A caller may set ``sample`` to fit on that many smallest hashes of doc_id per class; no query does.
* The threshold is fitted on all examples that pass the base rules: the cut with the best balanced accuracy, in the middle of
  its widest gap.  Scores are sorted and summed up in ranges, so the driver gets a row for each range and the cut.  Without junk
  labels the cut is below every target score; without target labels nothing but the base rules rejects.

Null or empty text: no words, rejected by the base rules.  Rows that repeat a doc_id are judged
each on its own text.  Labels that are null, repeated or contradict each other (both 0 and 1)
don't count as examples.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carepulse.llm import common as C

#: Fixed by the contract.
SYMBOLS = C.byte_set(b"#*$%&|<>")
MIN_WORDS, WINDOW, REPEAT_PERCENT = 50, 3, 50

BUCKETS = 1 << 16
ORDERS = (2, 4)
SCALE = 1 << 16

BASE_RESULT = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean"


def repeats(doc: np.ndarray, value: np.ndarray) -> np.ndarray:
    """For values of texts: how often each value stands in its own text."""
    key = C.mix(value ^ C.mix(doc.astype(np.uint64) + np.uint64(1)))
    _, back, n = np.unique(key, return_inverse=True, return_counts=True)
    return n[back]


def base_stats(data: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """The base rules' counts for each text."""
    n = len(off) - 1
    inside = C.WORD[data]
    starts, ends, first = C.words(data, off, C.WORD)
    n_words = np.diff(first)
    prefix = C.prefix_hash(data)
    # lines: from a text's start or past a newline to the next newline or the text's end; in order, starts and ends are pairs
    newlines = np.flatnonzero(data == 10)
    l_start = np.sort(np.concatenate([off[:-1], newlines + 1]))
    l_end = np.sort(np.concatenate([newlines, off[1:]]))
    worded = np.zeros(len(data) + 1, np.int64)
    np.cumsum(inside, out=worded[1:])
    keep = (l_end > l_start) & (worded[l_end] > worded[l_start])
    l_start, l_end = l_start[keep], l_end[keep]
    l_doc = np.searchsorted(off, l_start, "right") - 1
    key = C.mix(C.slice_hash(prefix, l_start, l_end) ^ C.mix(l_doc.astype(np.uint64) + np.uint64(1)))
    _, at = np.unique(key, return_index=True)
    n_dup = np.bincount(l_doc, minlength=n) - np.bincount(l_doc[at], minlength=n)
    # words in windows that their text has more than once
    in_window = np.zeros(len(starts) + 1, np.int64)
    if len(starts) >= WINDOW:
        h = C.slice_hash(prefix, starts, ends)
        w_doc = np.searchsorted(off, starts, "right") - 1
        at = np.flatnonzero(w_doc[WINDOW - 1:] == w_doc[:len(w_doc) - WINDOW + 1])
        value = h[at]
        for i in range(1, WINDOW):
            value = C.mix(value * np.uint64(0x9E3779B97F4A7C15) + h[at + i])
        again = at[repeats(w_doc[at], value) > 1]
        np.add.at(in_window, again, 1)
        np.add.at(in_window, again + WINDOW, -1)
    hit = np.cumsum(in_window[:-1]) > 0
    total = np.zeros(len(hit) + 1, np.int64)
    np.cumsum(hit, out=total[1:])
    n_repeat = total[first[1:]] - total[first[:-1]]
    return {"n_words": n_words, "word_chars": C.per_text(inside & ((data & 0xC0) != 0x80), off), "n_symbols": C.per_text(SYMBOLS[data], off),
            "n_dup_lines": n_dup, "n_repeat_words": n_repeat, "base_failed": (n_words < MIN_WORDS) | (100 * n_repeat > REPEAT_PERCENT * n_words)}


def ngrams(data: np.ndarray, off: np.ndarray, orders: tuple[int, ...], buckets: int):
    """For each order: the bucket of the n-gram at each byte, and where one starts that its text holds whole."""
    for n in orders:
        if len(data) < n:
            continue
        value = np.zeros(len(data) - n + 1, np.uint64)
        for i in range(n):
            value = value * np.uint64(257) + data[i:len(data) - n + 1 + i]
        valid = np.ones(len(value), bool)
        for i in range(1, n):
            at = off[1:-1] - i
            valid[at[(at >= 0) & (at < len(value))]] = False
        yield ((value + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).astype(np.int64) % buckets, valid


def count_ngrams(docs: DataFrame, orders: tuple[int, ...], buckets: int) -> np.ndarray:
    """n-gram counts of every text by bucket: summed in each task, then by bucket over all tasks."""
    import pyarrow as pa

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in C.chunks(batch, 0):
                off, data = C.utf8(part.column(0))
                for at, valid in ngrams(data, off, orders, buckets):
                    total += np.bincount(at[valid], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    # a task gives a row for each bucket, so there are some tasks for each core, whatever the number of partitions
    texts = docs.select("text").coalesce(4 * docs.sparkSession.sparkContext.defaultParallelism)
    rows = C.map_arrow(texts, run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, np.int64)
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out


def examples(labels: DataFrame, sample: int | None = None) -> DataFrame:
    """doc_id and good (0 or 1) of the labelled documents: all, or the ``sample`` smallest hashes of doc_id of each class.

    For a sample, hashes are first counted by their upper bits, so that the task that picks the smallest gets little more than
    ``sample`` of them, whatever the number of partitions."""
    one = (labels.select("doc_id", F.col("quality").cast("int").alias("good")).where("doc_id is not null and good in (0, 1)")
           .groupBy("doc_id").agg(F.min("good").alias("good"), F.max("good").alias("top")).where("good = top").drop("top"))
    one, order = C.checkpoint_table(one, "labelled"), F.xxhash64("doc_id")
    if sample is None:
        return one
    upper = F.shiftright(order, 48)
    counted, cuts = sorted(tuple(r) for r in one.groupBy("good", upper.alias("upper")).count().collect()), {}
    have = {0: 0, 1: 0}
    for good, at, n in counted:
        if have[good] < sample:
            have[good], cuts[good] = have[good] + n, at
    one = one.where(F.when(F.col("good") == 1, upper <= cuts.get(1, 0)).otherwise(upper <= cuts.get(0, 0)))
    return one.where("good = 1").orderBy(order, "doc_id").limit(sample).union(one.where("good = 0").orderBy(order, "doc_id").limit(sample))


def ratio(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Log ratios as integers; each bucket has one more count, so none is missing."""
    t, r = target + 1.0, raw + 1.0
    return np.rint(SCALE * (np.log(t / t.sum()) - np.log(r / r.sum()))).astype(np.int64)


def threshold(good: np.ndarray, junk: np.ndarray) -> float:
    """Scores below it are rejected."""
    if not len(good):
        return -np.inf
    if not len(junk):
        return float(good.min())
    both = np.unique(np.concatenate([good, junk]))
    if len(both) < 2:
        return -np.inf
    cuts = (both[1:] + both[:-1]) / 2
    kept = 1 - np.searchsorted(np.sort(good), cuts) / len(good)
    gone = np.searchsorted(np.sort(junk), cuts) / len(junk)
    best = np.flatnonzero(kept + gone >= (kept + gone).max() - 1e-12)
    return float(cuts[best[np.argmax(np.diff(both)[best])]])


def find_threshold(seen: DataFrame) -> float:
    """``threshold`` of a table of (good, score), however long: scores are dealt into ranges, summed up within each, and the
    driver adds a row for each range."""
    counted = seen.groupBy("score").agg(F.sum("good").alias("good"), F.sum(1 - F.col("good")).alias("junk"))
    counted = C.checkpoint_table(counted.repartitionByRange("score").withColumn("part", F.spark_partition_id()), "scores")
    parts = sorted(tuple(r) for r in counted.groupBy("part").agg(F.sum("good"), F.sum("junk"), F.min("score"), F.min(F.when(F.col("good") > 0, F.col("score"))), F.count("*")).collect())
    good, junk, n = (sum(p[i] for p in parts) for i in (1, 2, 5))
    if not good:
        return -np.inf
    if not junk:
        return float(min(p[4] for p in parts if p[4] is not None))
    if n < 2:
        return -np.inf
    before, rows = [0, 0], []
    for p, after in zip(parts, [*parts[1:], None], strict=True):
        rows.append((p[0], *before, after and after[3]))
        before = [before[0] + p[1], before[1] + p[2]]
    offsets = F.broadcast(seen.sparkSession.createDataFrame(rows, "part int, good0 long, junk0 long, after double"))
    by = Window.partitionBy("part").orderBy("score")
    up = by.rowsBetween(Window.unboundedPreceding, 0)
    cuts = counted.join(offsets, "part").select(
        "score", F.coalesce(F.lead("score").over(by), "after").alias("next"), (F.col("good0") + F.sum("good").over(up)).alias("lost"), (F.col("junk0") + F.sum("junk").over(up)).alias("gone"))
    # balanced accuracy in whole numbers, so that equal ones are equal
    exact, middle = "decimal(19,0)", (F.col("next") + F.col("score")) / 2
    value = F.col("gone").cast(exact) * F.lit(good).cast(exact) - F.col("lost").cast(exact) * F.lit(junk).cast(exact)
    best = cuts.where("next is not null").orderBy(value.desc(), (F.col("next") - F.col("score")).desc(), "score")
    return best.select(F.when(middle > F.col("score"), middle).otherwise(F.col("next")).alias("cut")).head()["cut"]


def scores(data: np.ndarray, off: np.ndarray, model: np.ndarray, orders: tuple[int, ...]) -> np.ndarray:
    """Mean log ratio of each text's n-grams (0 without any)."""
    total, n = np.zeros(len(off) - 1, np.int64), np.zeros(len(off) - 1, np.int64)
    for at, valid in ngrams(data, off, orders, len(model)):
        end = np.minimum(off, len(at))
        total += C.per_text(np.where(valid, model[at], 0), end)
        n += C.per_text(valid, end)
    return total / np.maximum(n, 1) / SCALE


def fit(docs: DataFrame, labels: DataFrame, sample: int | None = None, buckets: int = BUCKETS, orders: tuple[int, ...] = ORDERS) -> tuple[np.ndarray, float]:
    """The log ratios by bucket, and the threshold."""
    spark = docs.sparkSession
    raw = count_ngrams(docs, orders, buckets)
    known = examples(labels, sample)
    # labels of any number: their part of each shuffle partition is hashed, texts pass by unsorted
    target = count_ngrams(docs.select("doc_id", "text").join(known.where("good = 1").hint("shuffle_hash"), "doc_id"), orders, buckets)
    model = ratio(target, raw)
    sent = spark.sparkContext.broadcast(model)

    def work():
        def f(texts):
            off, data = C.utf8(texts)
            return [scores(data, off, sent.value, orders), base_stats(data, off)["base_failed"]]
        return f

    # the base rules decide on their own, so what they reject teaches nothing; rows that repeat a doc_id are one example with
    # their least score.  Labels meet scores, so that texts need not be moved again
    seen = C.map_texts(docs, "score double, base_failed boolean", work, ["doc_id"]).where("not base_failed and doc_id is not null")
    return model, find_threshold(seen.groupBy("doc_id").agg(F.min("score").alias("score")).join(known, "doc_id").select("good", "score"))


def quality_rules(docs: DataFrame, labels: DataFrame, carry: list[str] | None = None, sample: int | None = None, buckets: int = BUCKETS, orders: tuple[int, ...] = ORDERS) -> DataFrame:
    """Every document with its base counts, ``score`` and ``kept``; ``carry`` names input columns to pass on (doc_id)."""
    model, cut = fit(docs, labels, sample, buckets, orders)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def work():
        def f(texts):
            off, data = C.utf8(texts)
            base = base_stats(data, off)
            score = scores(data, off, sent.value, orders)
            return [*base.values(), score, ~base["base_failed"] & (score >= cut)]
        return f

    return C.map_texts(docs, BASE_RESULT + ", score double, kept boolean", work, ["doc_id"] if carry is None else carry)
