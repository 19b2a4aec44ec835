"""Benchmark decontamination: a prefix-filtered set join of item windows with documents.

A window (``WINDOW`` consecutive words of an item) is a set of word shingles.  Shingles are ordered by
rarity over the whole corpus.  A document must contain a window whole, so the prefix that is necessary
is one token: the window's rarest shingle.  Documents are joined on those tokens alone; a match fixes where
the window would start, positional and length bounds drop what doesn't fit into the document, and
what is left is verified word by word.

The benchmark is the stated query set: it is taken in blocks of about ``BLOCK_BYTES``, each of them
broadcast and compared with all documents.  With one block no document is shuffled; with more, the hits
(not the texts) are grouped by document.  A shingle that no document has drops its windows before the join.

Null text has no words.  An item of fewer words than a window is one window; without words it is none.
A null item_id is named by the empty string; rows that repeat an item_id are one item.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carepulse.llm import common as C

WINDOW, SHINGLE = 10, 5
BLOCK_BYTES = 2 << 20


def item_words(text: str) -> list[bytes]:
    off, data = C.utf8(pa.array([text]))
    data = C.LOWER[data]
    raw = data.tobytes()
    starts, ends, _ = C.words(data, off, C.ALNUM)
    return [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]


def word_hashes(data: np.ndarray, off: np.ndarray):
    """Starts, ends and hashes of the words, and each text's first word."""
    starts, ends, first = C.words(data, off, C.ALNUM)
    return starts, ends, C.slice_hash(C.prefix_hash(data), starts, ends), first


def shingle_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each word on."""
    if len(h) < size:
        return np.zeros(0, np.uint64)
    n = len(h) - size + 1
    value = h[:n] + np.uint64(size)
    for i in range(1, size):
        value = C.mix(value * np.uint64(0x9E3779B97F4A7C15) + h[i:i + n])
    return value


class Block:
    """Distinct windows of some items, and after ``order`` their prefix tokens."""

    def __init__(self, items: list[tuple[str, str]], window: int, shingle: int):
        self.windows: dict[tuple[bytes, ...], set[str]] = {}
        for item, text in items:
            w = item_words(text)
            for i in range(max(1, len(w) - window + 1) if w else 0):
                self.windows.setdefault(tuple(w[i:i + window]), set()).add(item)
        self.words = list(self.windows)
        self.items = [sorted(x) for x in self.windows.values()]
        self.sizes = sorted({min(shingle, len(w)) for w in self.words})
        token, at, place = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i, w in enumerate(self.words):
            off = np.cumsum([0] + [len(x) for x in w])
            data = np.frombuffer(b"".join(w), np.uint8)
            h = shingle_hashes(C.slice_hash(C.prefix_hash(data), off[:-1], off[1:]), min(shingle, len(w)))
            token.append(h)
            at.append(np.full(len(h), i))
            place.append(np.arange(len(h)))
        self.token, self.at, self.place = map(np.concatenate, (token, at, place))
        self.length = np.array([len(w) for w in self.words], np.int64)
        self.tokens = np.unique(self.token)

    def order(self, counts: np.ndarray) -> None:
        """Keep each window's rarest token (by ``counts`` of ``tokens``); none if no document has it."""
        n = counts[np.searchsorted(self.tokens, self.token)]
        by = np.lexsort((self.place, self.token, n, self.at))
        first = by[np.unique(self.at[by], return_index=True)[1]] if len(by) else by
        first = first[n[first] > 0]
        first = first[np.argsort(self.token[first], kind="stable")]
        self.token, self.at, self.place = self.token[first], self.at[first], self.place[first]
        self.tokens = np.unique(self.token)

    def hits(self, data: np.ndarray, off: np.ndarray):
        """(words of each text, and for texts with hits: the hit words' places and the items)."""
        starts, ends, h, first = word_hashes(data, off)
        n_words, found = np.diff(first), {}
        raw = data.tobytes()
        for size in self.sizes:
            value = shingle_hashes(h, size)
            if not len(value) or not len(self.tokens):
                continue
            near = np.minimum(np.searchsorted(self.tokens, value), len(self.tokens) - 1)
            pos = np.flatnonzero(self.tokens[near] == value)
            a, b = np.searchsorted(self.token, value[pos]), np.searchsorted(self.token, value[pos], "right")
            doc = np.searchsorted(first, pos, "right") - 1
            n = b - a
            post = np.repeat(a, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            pos, doc = np.repeat(pos, n), np.repeat(doc, n)
            start, win = pos - self.place[post], self.at[post]
            fits = (start >= first[doc]) & (start + self.length[win] <= first[doc + 1])
            for s, w, d in zip(start[fits].tolist(), win[fits].tolist(), doc[fits].tolist(), strict=True):
                if all(raw[starts[s + i]:ends[s + i]] == x for i, x in enumerate(self.words[w])):
                    places, items = found.setdefault(d, (set(), set()))
                    places.update(range(s - int(first[d]), s - int(first[d]) + len(self.words[w])))
                    items.update(self.items[w])
        return n_words, found


def token_counts(docs: DataFrame, block: Block) -> np.ndarray:
    """How often each token of the block stands in the whole corpus; the driver gets a row per token at most."""
    sent = docs.sparkSession.sparkContext.broadcast((block.tokens, block.sizes))

    def run(batches):
        tokens, sizes = sent.value
        total = np.zeros(len(tokens), np.int64)
        for batch in batches:
            for part in C.chunks(batch, 0):
                off, data = C.utf8(part.column(0))
                _, _, h, first = word_hashes(C.LOWER[data], off)
                for size in sizes:
                    value = shingle_hashes(h, size)
                    if len(value) and len(tokens):
                        near = np.minimum(np.searchsorted(tokens, value), len(tokens) - 1)
                        pos = np.flatnonzero(tokens[near] == value)
                        doc = np.searchsorted(first, pos, "right") - 1
                        total += np.bincount(near[pos[pos + size <= first[doc + 1]]], minlength=len(tokens))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["token", "n"])

    rows = C.map_arrow(docs.select("text"), run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(len(block.tokens), np.int64)
    for r in rows:
        out[r["token"]] = r["n"]
    return out


def scan(docs: DataFrame, block: Block, carry: list[str]) -> DataFrame:
    """``carry``, n_words, ``hit`` (places of hit words) and ``items`` of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(block)

    def work():
        def f(texts):
            off, data = C.utf8(texts)
            n_words, found = sent.value.hits(C.LOWER[data], off)
            got = [found.get(d, ((), ())) for d in range(len(texts))]
            return [n_words, pa.array([sorted(g[0]) for g in got], pa.list_(pa.int64())), pa.array([sorted(g[1]) for g in got], pa.list_(pa.string()))]
        return f

    return C.map_texts(docs, "n_words long, hit array<long>, items array<string>", work, carry)


def blocks(benchmark: DataFrame, limit: int) -> list[DataFrame]:
    """The items in parts of about ``limit`` bytes (one part if they fit)."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text").where("text is not null")
    n = max(1, math.ceil((items.agg(F.sum(F.octet_length("text") + 16)).head()[0] or 0) / limit))
    return [items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i) for i in range(n)]


def decontaminate(docs: DataFrame, benchmark: DataFrame, carry: list[str] | None = None, window: int = WINDOW, shingle: int = SHINGLE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Every document with n_words, n_hit, ``items`` (sorted ids) and contaminated, after the columns in ``carry`` (doc_id)."""
    carry = ["doc_id"] if carry is None else carry
    parts = blocks(benchmark, block_bytes)
    keyed = C.row_key(docs)
    carried = [c for c in carry if c not in ("n_words", "hit", "items", "n_hit", "n_items", "contaminated")]
    done = None
    for part in parts:
        block = Block([(r["item_id"], r["text"]) for r in part.collect()], window, shingle)
        block.order(token_counts(docs, block))
        if len(parts) == 1:
            out = scan(docs, block, carried)
        else:
            hits = scan(keyed, block, ["__id", "__sum"]).where(F.size("hit") > 0).drop("n_words")
            done = hits if done is None else done.union(hits)
    if len(parts) > 1:
        done = C.checkpoint_table(done.groupBy("__id", "__sum").agg(F.flatten(F.collect_list("hit")).alias("hit"), F.flatten(F.collect_list("items")).alias("items")), "hits")
        base = scan(keyed, Block([], window, shingle), [*carried, "__id", "__sum"]).drop("hit", "items")
        empty = {"hit": F.array().cast("array<long>"), "items": F.array().cast("array<string>")}
        out = base.join(done, C.same_row(base, done), "left").select(*[base[c] for c in carried], "n_words", *[F.coalesce(done[c], e).alias(c) for c, e in empty.items()])
    items = F.array_sort(F.array_distinct("items"))
    return out.select(*carried, "n_words", F.size(F.array_distinct("hit")).cast("long").alias("n_hit"), items.alias("items")).withColumns(
        {"n_items": F.size("items").cast("long"), "contaminated": F.col("n_hit") > 0})
