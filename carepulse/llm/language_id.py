"""Language ID: multinomial naive Bayes over hashed character n-grams.

Counts of hashed n-grams of lower-cased code points are summed per language in each
task, then over all tasks; the model has ``buckets`` rows and a column per learned
language.  It is broadcast in blocks of about ``languages`` columns, so what is sent, and
what reaches the driver, is bounded by ``buckets`` x ``languages`` however many languages
there are: each block scores every text, and a text keeps its best language so far.
Log probabilities are integers (``SCALE`` per nat), so a prediction is the same in any
batch and any block.  Every training document is used; none is sampled.  There is no
class prior: all languages are equally likely before the text is read.

The score is the posterior of the predicted language over the mean log probability times
``min(n-grams, 50)``: a plain posterior would be 1 for any text of a few words.
Null text and text without a letter: ``und`` with score 0, as is any text when nothing was
learned.  Ties go to the language that sorts first.  A null doc_id is neither learned from nor held out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carepulse.llm import common as C

BUCKETS, ORDERS, SCALE = 1 << 15, (1, 2, 3), 1 << 12
#: Languages of a block of the model: at 32,768 buckets of four bytes, 64 MB.
LANGUAGES = 512
#: Languages whose counts a task holds before it hands them on.
HELD = 64
HELD_OUT = 2
LETTER = regex.compile(r"\p{L}")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == HELD_OUT, F.lit(False))


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and code points of the lower-cased texts."""
    lowered = [t.lower() for t in texts]
    off = np.zeros(len(lowered) + 1, np.int64)
    np.cumsum([len(t) for t in lowered], out=off[1:])
    return off, np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)


def ngrams(points: np.ndarray, off: np.ndarray, orders: tuple[int, ...], buckets: int):
    """For each order: the bucket of the n-gram at each code point, and whether its text holds it whole."""
    for n in orders:
        if len(points) < n:
            continue
        value = np.zeros(len(points) - n + 1, np.uint64)
        for i in range(n):
            value = value * np.uint64(0x110011) + points[i:len(points) - n + 1 + i]
        valid = np.ones(len(value), bool)
        for i in range(1, n):
            at = off[1:-1] - i
            valid[at[(at >= 0) & (at < len(value))]] = False
        yield ((value + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).astype(np.int64) % buckets, valid


def learn(docs: DataFrame, buckets: int, orders: tuple[int, ...]) -> DataFrame:
    """(lang, model): the integer log probability of each bucket, as int32 bytes; one row per learned language."""

    def flush(counts: dict[str, np.ndarray]):
        for lang, into in counts.items():
            some = np.flatnonzero(into)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some), pa.string()), pa.array(some), pa.array(into[some])], names=["lang", "bucket", "n"])
        counts.clear()

    def run(batches):
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in C.chunks(batch, 1):
                by_lang: dict[str, list[str]] = {}
                for lang, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    by_lang.setdefault(lang, []).append(t)
                for lang, texts in by_lang.items():
                    if lang not in counts and len(counts) >= HELD:
                        yield from flush(counts)
                    off, points = code_points(texts)
                    into = counts.setdefault(lang, np.zeros(buckets, np.int64))
                    for at, valid in ngrams(points, off, orders, buckets):
                        into += np.bincount(at[valid], minlength=buckets)
        yield from flush(counts)

    def column(rows: pa.Table) -> pa.Table:
        counts = np.ones(buckets)
        counts[rows.column("bucket").to_numpy()] += rows.column("n").to_numpy()
        logs = np.rint(SCALE * np.log(counts / counts.sum())).astype("<i4")
        return pa.table({"lang": rows.column("lang").slice(0, 1), "model": pa.array([logs.tobytes()], pa.binary())})

    train = docs.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    made = C.map_arrow(train, run, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    # a group is one language's buckets, whatever the corpus
    return made.groupBy("lang").applyInArrow(column, "lang string, model binary")


def block_of(models: DataFrame, at: int, blocks: int, buckets: int) -> tuple[list[str], np.ndarray]:
    """Languages of a block in order, and their log probabilities [buckets, languages]."""
    rows = sorted((r.lang, r.model) for r in models.where(F.pmod(F.xxhash64("lang"), F.lit(blocks)) == at).collect())
    model = np.empty((buckets, len(rows)), np.int32)
    for i, (_, logs) in enumerate(rows):
        model[:, i] = np.frombuffer(logs, "<i4")
    return [lang for lang, _ in rows], model


def predict(texts: list[str], langs: list[str], model: np.ndarray, orders: tuple[int, ...]) -> tuple[list, list, list, list]:
    """For each text, among ``langs``: the best language, its summed log probability, the languages' mass as multiples of
    the best one's, and the weight of a unit of log probability in it.  Null for a text without a letter."""
    some = [i for i, t in enumerate(texts) if langs and LETTER.search(t)]
    lang, best, mass, weight = ([None] * len(texts) for _ in range(4))
    if not some:
        return lang, best, mass, weight
    off, points = code_points([texts[i] for i in some])
    total, n = np.zeros((len(some), len(langs)), np.int64), np.zeros(len(some), np.int64)
    step = max(1, (1 << 20) // len(langs))
    for at, valid in ngrams(points, off, orders, len(model)):
        end = np.minimum(off, len(at))
        n += C.per_text(valid, end)
        # sparse scoring: rows of the matrix for the n-grams that occur, summed text by text in bounded steps
        for a in range(0, len(at), step):
            b = min(a + step, len(at))
            ok = np.flatnonzero(valid[a:b]) + a
            if not len(ok):
                continue
            doc = np.searchsorted(end, ok, "right") - 1
            cut = np.flatnonzero(np.diff(doc, prepend=-1))
            np.add.at(total, doc[cut], np.add.reduceat(model[at[ok]], cut, axis=0, dtype=np.int64))
    top = total.argmax(axis=1)
    high = total[np.arange(len(some)), top]
    per_unit = np.minimum(n, 50) / np.maximum(n, 1) / SCALE
    all_mass = np.exp((total - high[:, None]) * per_unit[:, None]).sum(axis=1)
    for j, i in enumerate(some):
        lang[i], best[i], mass[i], weight[i] = langs[top[j]], int(high[j]), float(all_mass[j]), float(per_unit[j])
    return lang, best, mass, weight


def merged() -> list[Column]:
    """The best language of the blocks so far (``lang``, ``best``, ``mass``) and of one more (``b_lang``, ``b_best``, ``b_mass``) together."""
    more = F.col("lang").isNull() | (F.col("b_best") > F.col("best")) | ((F.col("b_best") == F.col("best")) & (F.col("b_lang") < F.col("lang")))
    far = F.exp(-F.abs(F.col("b_best") - F.col("best")) * F.col("b_weight"))
    mass = F.when(F.col("lang").isNull(), F.col("b_mass")).when(more, F.col("b_mass") + F.col("mass") * far).otherwise(F.col("mass") + F.col("b_mass") * far)
    # a block without languages, or a text without a letter, changes nothing
    none = F.col("b_lang").isNull()
    return [F.when(none | ~more, F.col(c)).otherwise(F.col(f"b_{c}")).alias(c) for c in ("lang", "best")] + [F.when(none, F.col("mass")).otherwise(mass).alias("mass")]


def language_id(docs: DataFrame, buckets: int = BUCKETS, orders: tuple[int, ...] = ORDERS, languages: int = LANGUAGES) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document, learned from the documents not held out."""
    models = C.checkpoint_table(learn(docs, buckets, orders), "languages")
    blocks = max(1, -(-models.count() // languages))
    now = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"), F.lit(None).cast("string").alias("lang"), F.lit(None).cast("long").alias("best"), F.lit(None).cast("double").alias("mass"))
    for at in range(blocks):
        sent = docs.sparkSession.sparkContext.broadcast(block_of(models, at, blocks, buckets))

        def work(sent=sent):
            def f(texts):
                lang, best, mass, weight = predict(texts.to_pylist(), *sent.value, orders)
                return [pa.array(lang, pa.string()), pa.array(best, pa.int64()), pa.array(mass, pa.float64()), pa.array(weight, pa.float64())]
            return f

        last = at == blocks - 1
        kept = ["doc_id", "held_out", "lang", "best", "mass"] + ["text"] * (not last)
        made = C.map_texts(now, "b_lang string, b_best long, b_mass double, b_weight double", work, kept)
        made = made.select(*[c for c in kept if c not in ("lang", "best", "mass")], *merged())
        if last:
            score = F.coalesce(1 / F.col("mass"), F.lit(0.0))
            return made.select("doc_id", "held_out", F.coalesce("lang", F.lit("und")).alias("lang_pred"), score.alias("score"))
        before, now = now, C.checkpoint_table(made, "languages-so-far")
        sent.destroy()
        if at:
            C.drop_table(before)
