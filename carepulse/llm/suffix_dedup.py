"""Suffix-array dedup: removes every byte covered by a long string that also starts elsewhere.

The suffixes that matter are found by sampling, exactly.  Each window of ``LENGTH`` bytes picks its anchor, the ``GRAM``-byte
string of smallest hash in it (the first of equals), so equal windows pick equal anchors at equal
offsets.  Neighbouring windows with one anchor are a run (about one for each 80 bytes).  Then

1. anchors that stand once in the corpus drop out; what is left is counted by the run's bytes:
   a run that stands twice or more is a repeat as a whole;
2. the distinct runs of an anchor that has several are sorted as suffixes: prefix polynomial hashes give the common
   extension of two suffixes by binary search, which makes a comparison in a mergesort take a logarithmic
   number of steps; neighbours in the order that agree over LENGTH bytes are repeats, after their bytes
   were compared (should hashes collide, the group is sorted out by bytes).

The mergesort merges all runs of a level at once, in numpy.  A sort group is one anchor; an anchor with more than ``GROUP`` distinct
runs is dealt out by the hash of the window, so equal windows still meet and no task gets it whole.  Copies meet in counts that
combine in the map tasks.  Texts cross a shuffle twice, compressed: for the runs to sort, and to take the repeats out.

Null text: empty.  Rows that repeat doc_id and text are copies of each other and get the same result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carepulse.llm import common as C

LENGTH, GRAM, GROUP = 200, 32, 4096
SORT_BYTES = 1 << 18


def find_runs(data: np.ndarray, off: np.ndarray, length: int, gram: int) -> dict[str, np.ndarray]:
    """Runs of all texts: text, first and last window (from the text's start), anchor's offset and hash, hash of the run's bytes."""
    n = len(data)
    if not 0 < gram <= length <= 255:
        raise ValueError("a run's offsets are kept in eight bits")
    if n < length:
        return {k: np.zeros(0, np.int64) for k in ("doc", "first", "last", "lead", "key", "run")}
    prefix = C.prefix_hash(data)
    at = np.arange(n - gram + 1)
    grams = C.slice_hash(prefix, at, at + gram)
    # the smallest hash of each window and, among equals, the first place: kept in the low 31 bits
    low = np.uint64((1 << 31) - 1)
    best, span, width = (grams & ~low) | at.astype(np.uint64), 1, length - gram + 1
    while span * 2 <= width:
        best = np.minimum(best[:-span], best[span:])
        span *= 2
    if width > span:
        best = np.minimum(best[:len(best) - (width - span)], best[width - span:])
    anchor = (best & low).astype(np.int64)
    whole = np.ones(n - length + 1, bool)  # windows within one text
    cross = np.zeros(n + 1, np.int64)
    inner = off[1:-1]
    np.add.at(cross, np.maximum(inner - length + 1, 0), 1)
    np.add.at(cross, inner, -1)
    whole &= np.cumsum(cross)[:len(whole)] == 0
    new = np.ones(len(whole), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | ~whole[:-1]
    ends = np.ones(len(whole), bool)
    ends[:-1] = new[1:] | ~whole[1:]
    first, last = np.flatnonzero(new & whole), np.flatnonzero(ends & whole)
    # a text boundary between two windows of one anchor can't be: the anchor lies in both
    doc = np.searchsorted(off, first, "right") - 1
    return {"doc": doc, "first": first - off[doc], "last": last - off[doc], "lead": anchor[first] - first,
            "key": C.signed(grams[anchor[first]]), "run": C.signed(C.slice_hash(prefix, first, last + length))}


def runs_of(keyed: DataFrame, length: int, gram: int) -> DataFrame:
    """A row for each run.  Neighbouring equal runs of a text (a text that repeats itself) are one row.

    ``shape`` packs the anchor's offset (8 bits), the last window's (8 bits) and how far equal runs go on after it."""
    result = "__id long, __sum long, first long, shape long, key long, run long"
    from pyspark.sql.types import StructType
    schema = StructType.fromDDL(result)
    schema["__id"].dataType = keyed.schema["__id"].dataType
    arrow = C.to_arrow(schema)

    def run(batches):
        for batch in batches:
            for part in C.chunks(batch, 2):
                off, data = C.utf8(part.column(2))
                r = find_runs(data, off, length, gram)
                if not len(r["doc"]):
                    continue
                new = np.ones(len(r["doc"]), bool)
                new[1:] = (r["run"][1:] != r["run"][:-1]) | (r["key"][1:] != r["key"][:-1]) | (r["doc"][1:] != r["doc"][:-1]) | (r["first"][1:] != r["last"][:-1] + 1)
                at = np.flatnonzero(new)
                to = np.append(at[1:], len(new)) - 1
                who = pa.array(r["doc"][at])
                shape = r["lead"][at] | (r["last"] - r["first"])[at] << 8 | r["last"][to] - r["last"][at] << 16
                cols = [part.column(0).take(who), part.column(1).take(who), r["first"][at], shape, r["key"][at], r["run"][at]]
                yield pa.RecordBatch.from_arrays([pa.array(c).cast(f.type) for c, f in zip(cols, arrow, strict=True)], schema=arrow)

    return C.map_arrow(keyed.select("__id", "__sum", "text"), run, schema)


def packed(keyed: DataFrame) -> DataFrame:
    """(__id, __sum, z): each text compressed, as it crosses a shuffle."""
    from pyspark.sql.types import BinaryType, StructField, StructType
    schema = StructType([keyed.schema["__id"], keyed.schema["__sum"], StructField("z", BinaryType())])
    arrow = C.to_arrow(schema)

    def run(batches):
        press = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            z = [press(t.encode()) if t else press(b"") for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(z, pa.binary())], schema=arrow)

    return C.map_arrow(keyed.select("__id", "__sum", "text"), run, schema)


def contexts(keyed: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes of each wanted run, dealt to sort groups (key, sub)."""
    by_doc = wanted.groupBy("__id", "__sum").agg(F.collect_list(F.struct("first", "shape", "key", "c", "parts")).alias("runs"))
    texts = packed(keyed)
    both = texts.join(by_doc, C.same_row(texts, by_doc)).select(texts["__id"], texts["__sum"], texts["z"], "runs").dropDuplicates(["__id", "__sum"])
    from pyspark.sql.types import StructType
    schema = StructType.fromDDL("__id long, __sum long, first long, lead long, key long, c long, parts long, sub long, bytes binary")
    schema["__id"].dataType = keyed.schema["__id"].dataType
    arrow = C.to_arrow(schema)

    def run(batches):
        for batch in batches:
            out = []
            for ident, check, z, runs in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                raw = zstandard.decompress(z)
                for r in runs:
                    lead, span = r["shape"] & 255, r["shape"] >> 8 & 255
                    own = raw[r["first"]:r["first"] + span + length]
                    subs = [0]
                    if r["parts"] > 1:
                        prefix = C.prefix_hash(np.frombuffer(own, np.uint8))
                        subs = np.unique(_part(prefix, np.arange(len(own) - length + 1), length, r["parts"])).tolist()
                    out += [(ident, check, r["first"], lead, r["key"], r["c"], r["parts"], s, own) for s in subs]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), arrow, strict=True)], schema=arrow)

    return C.map_arrow(both, run, schema)


def _part(prefix: np.ndarray, start: np.ndarray, length: int, parts) -> np.ndarray:
    return (C.slice_hash(prefix, start, start + length) % np.asarray(parts).astype(np.uint64)).astype(np.int64)


def common_extension(prefix: np.ndarray, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """How many bytes the suffixes at ``a`` and ``b`` have in common, up to ``length``; both are that long."""
    power = C.powers(len(prefix))
    have = np.zeros(len(a), np.int64)
    step = 1 << (length.bit_length() - 1)
    while step:
        can = np.flatnonzero(have + step <= length)
        x, y = a[can] + have[can], b[can] + have[can]
        # the same hash up to the power of the place
        same = (prefix[x + step] - prefix[x]) * power[y] == (prefix[y + step] - prefix[y]) * power[x]
        have[can[same]] += step
        step >>= 1
    return have


def compare(data: np.ndarray, front: np.ndarray, prefix: np.ndarray, whole: np.ndarray, start: np.ndarray, i: np.ndarray, j: np.ndarray, length: int) -> np.ndarray:
    """-1, 0 or 1 for suffixes i and j; ``front`` has the eight bytes from each place on as a number."""
    out = np.zeros(len(i), np.int8)
    differ = np.flatnonzero(whole[i] != whole[j])
    a, b = start[i[differ]], start[j[differ]]
    x, y = front[a], front[b]
    soon = x != y  # within the first eight bytes
    out[differ[soon]] = np.where(x < y, -1, 1)[soon]
    differ, a, b = differ[~soon], a[~soon], b[~soon]
    have = common_extension(prefix, a, b, length)
    ends = have >= length
    x, y = data[a + np.where(ends, 0, have)], data[b + np.where(ends, 0, have)]
    out[differ] = np.where(ends, 0, np.where(x < y, -1, 1))
    return out


def suffix_sort(data: np.ndarray, prefix: np.ndarray, whole: np.ndarray, start: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """Order of the suffixes by group, then bytes: a bottom-up mergesort, all merges of a level at once."""
    front = np.zeros(len(data), np.uint64)
    for k in range(8):
        front[:len(data) - k] |= data[k:].astype(np.uint64) << np.uint64(56 - 8 * k)
    order = np.argsort(group, kind="stable")
    sorted_group = group[order]
    begin = np.searchsorted(sorted_group, sorted_group)
    end = np.searchsorted(sorted_group, sorted_group, "right")
    width, most = 1, int((end - begin).max()) if len(order) else 0
    while width < most:
        at = np.flatnonzero(end - begin > width)
        place = at - begin[at]
        base = begin[at] + place // (2 * width) * 2 * width
        right = place // width % 2 == 1
        lo = np.where(right, base, np.minimum(base + width, end[at]))
        hi = np.where(right, base + width, np.minimum(base + 2 * width, end[at]))
        other = lo.copy()
        own = order[at]
        busy = np.flatnonzero(lo < hi)
        while len(busy):
            mid = (lo[busy] + hi[busy]) // 2
            c = compare(data, front, prefix, whole, start, own[busy], order[mid], length)
            after = (c > 0) | ((c == 0) & right[busy])
            lo[busy] = np.where(after, mid + 1, lo[busy])
            hi[busy] = np.where(after, hi[busy], mid)
            busy = busy[lo[busy] < hi[busy]]
        order[base + place % width + (lo - other)] = own
        width *= 2
    return order


def repeated(rows: dict[str, np.ndarray], data: np.ndarray, off: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, window) of each repeat among the runs of whole sort groups, for the runs that stand once."""
    n_windows = np.maximum(np.diff(off) - length + 1, 0)
    row = np.repeat(np.arange(len(n_windows)), n_windows)
    window = np.arange(len(row)) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
    start = off[row] + window
    prefix = C.prefix_hash(data)
    mine = _part(prefix, start, length, rows["parts"][row]) == rows["sub"][row]
    row, window, start = row[mine], window[mine], start[mine]
    whole = C.slice_hash(prefix, start, start + length)
    # suffixes of one anchor (rows come sorted by it) at one offset from it
    new = np.ones(len(rows["key"]), bool)
    new[1:] = (rows["key"][1:] != rows["key"][:-1]) | (rows["sub"][1:] != rows["sub"][:-1])
    group = np.cumsum(new)[row] * 512 + 256 + rows["lead"][row] - window
    some = np.bincount(group)[group] > 1 if len(group) else np.zeros(0, bool)
    row, window, start, whole, group = row[some], window[some], start[some], whole[some], group[some]
    order = suffix_sort(data, prefix, whole, start, group, length)
    a, b = order[:-1], order[1:]
    same = (group[a] == group[b]) & (whole[a] == whole[b])
    a, b = a[same], b[same]
    hit = np.zeros(len(row), bool)
    hit[a] = hit[b] = True
    for i in range(0, len(a), 1 << 14):  # collisions: the bytes of neighbours must agree
        x, y = start[a[i:i + (1 << 14), None]] + np.arange(length), start[b[i:i + (1 << 14), None]] + np.arange(length)
        if (data[x] != data[y]).any():
            seen: dict[tuple, int] = {}
            texts = [(g, data[s:s + length].tobytes()) for g, s in zip(group.tolist(), start.tolist(), strict=True)]
            for t in texts:
                seen[t] = seen.get(t, 0) + 1
            hit = np.array([seen[t] > 1 for t in texts], bool)
            break
    hit &= rows["c"][row] == 1
    return row[hit], window[hit]


def sort_groups(dealt: DataFrame, length: int) -> DataFrame:
    """Windows found to be repeats, as (__id, __sum, a, b): first and last window."""
    from pyspark.sql.types import StructType
    schema = StructType.fromDDL("__id long, __sum long, a long, b long")
    schema["__id"].dataType = dealt.schema["__id"].dataType
    arrow = C.to_arrow(schema)
    n = len(dealt.columns)

    def work(held: pa.Table):
        held = held.combine_chunks()
        rows = {c: held.column(c).to_numpy() for c in ("first", "lead", "key", "c", "parts", "sub")}
        raw = held.column("bytes").combine_chunks()
        off, data = C.utf8(raw.chunk(0) if isinstance(raw, pa.ChunkedArray) else raw)
        row, window = repeated(rows, data, off, length)
        if not len(row):
            return
        by = np.lexsort((window, row))
        row, window = row[by], window[by]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (window[1:] != window[:-1] + 1)
        at = np.flatnonzero(new)
        to = np.append(at[1:], len(new)) - 1
        base = rows["first"][row[at]]
        cols = [held.column(0).take(pa.array(row[at])), held.column(1).take(pa.array(row[at])), base + window[at], base + window[to]]
        yield from pa.Table.from_arrays([pa.chunked_array(c) if isinstance(c, pa.ChunkedArray) else pa.chunked_array([c]) for c in (*cols[:2], pa.array(cols[2]), pa.array(cols[3]))], schema=arrow).to_batches()

    def run(batches):
        held, size = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.column(n - 1).nbytes
            if size >= SORT_BYTES:  # all but the last group are whole
                all_of = pa.Table.from_batches(held)
                key, sub = all_of.column("key").to_numpy(), all_of.column("sub").to_numpy()
                cut = int(np.flatnonzero((key != key[-1]) | (sub != sub[-1])).max(initial=-1)) + 1
                if cut:
                    for i in _pieces(all_of.slice(0, cut)):
                        yield from work(i)
                    held = all_of.slice(cut).to_batches()
                    size = sum(b.column(n - 1).nbytes for b in held) if cut < all_of.num_rows else 0
        if held:
            for i in _pieces(pa.Table.from_batches(held)):
                yield from work(i)

    return C.map_arrow(dealt.repartition("key", "sub").sortWithinPartitions("key", "sub"), run, schema)


def _pieces(rows: pa.Table):
    """Parts of about ``SORT_BYTES`` that don't cut a group."""
    key, sub = rows.column("key").to_numpy(), rows.column("sub").to_numpy()
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (sub[1:] != sub[:-1])
    cuts = np.append(np.flatnonzero(new), len(key))
    size = np.cumsum([0, *(len(x) for x in rows.column("bytes").to_pylist())])
    at = 0
    while at < len(cuts) - 1:
        to = max(at + 1, int(np.searchsorted(size[cuts], size[cuts[at]] + SORT_BYTES, "right")) - 1)
        yield rows.slice(int(cuts[at]), int(cuts[to] - cuts[at]))
        at = to


def repeats(keyed: DataFrame, length: int, gram: int, group: int) -> DataFrame:
    """(__id, __sum, a, b): first and last window of stretches of repeats."""
    runs = C.checkpoint_table(runs_of(keyed, length, gram), "sampled")  # read twice; texts are hashed once
    more = F.shiftright("shape", 16)
    times = F.when(more > 0, 2).otherwise(1)  # only one or several matters
    anchors = runs.groupBy("key").agg(F.sum(times).alias("total"), F.min("run").alias("lo"), F.max("run").alias("hi")).where("total > 1").select("key", (F.col("lo") != F.col("hi")).alias("several"))
    # a table of its own: a join of two shuffles can be split where an anchor is hot, a join on an aggregate's own shuffle can't
    shared = C.checkpoint_table(runs.join(C.checkpoint_table(anchors, "anchors"), "key"), "runs")
    several = shared.where("several")
    distinct = several.groupBy("key", "run").agg(F.sum(times).alias("c"), F.min(F.struct("__id", "__sum", "first", "shape")).alias("one"))
    parts = distinct.groupBy("key").agg(F.ceil(F.count("*") / group).cast("long").alias("parts"))
    wanted = C.checkpoint_table(distinct.join(parts, "key").select("one.*", "key", "run", "c", "parts"), "wanted")
    copied = several.join(wanted.where("c > 1").select("key", "run"), ["key", "run"], "left_semi")
    sorted_out = sort_groups(contexts(keyed, wanted, length), length)
    last = F.col("first") + F.shiftright("shape", 8).bitwiseAND(F.lit(255)) + more
    whole = shared.where("not several").unionByName(copied).select("__id", "__sum", F.col("first").alias("a"), last.alias("b"))
    return whole.unionByName(sorted_out)


def suffix_dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, group: int = GROUP, text: bool = True) -> DataFrame:
    """Every document with n_bytes, n_removed, n_spans, kept_sha256 and with ``text`` the ``kept`` bytes (removal can cut a character)."""
    keyed = C.row_key(docs.select("doc_id", "text"))
    # a set, combined in the map tasks: rows that repeat an id and a text have one list, no longer than one text's runs; a table, so that the join can split them
    found = C.checkpoint_table(repeats(keyed, length, gram, group).groupBy("__id", "__sum").agg(F.collect_set(F.struct("a", "b")).alias("spans")), "spans")
    texts = packed(keyed)
    both = texts.join(found, C.same_row(texts, found), "left").select(texts["__id"], texts["z"], "spans")
    schema = C.result_schema(docs, ["doc_id"], "n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * text)
    arrow = C.to_arrow(schema)

    def run(batches):
        for batch in batches:
            out = []
            for z, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                raw = zstandard.decompress(z)
                kept, at, n_spans, end = [], 0, 0, -1
                for a, b in sorted((s["a"], s["b"] + length) for s in spans or ()):
                    if a > end:
                        kept.append(raw[at:a])
                        n_spans += 1
                    end = max(end, b)
                    at = end
                kept.append(raw[at:])
                left = b"".join(kept)
                out.append((len(raw), len(raw) - len(left), n_spans, hashlib.sha256(left).hexdigest(), left)[:len(arrow) - 1])
            if out:
                yield pa.RecordBatch.from_arrays([batch.column(0).cast(arrow[0].type), *(pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), list(arrow)[1:], strict=True))], schema=arrow)

    return C.map_arrow(both, run, schema)
