"""Suffix, line, SimHash and substring dedup against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from carepulse.llm import line_dedup, simhash, substring_dedup, suffix_dedup
from carepulse.llm.components import connected_components


def brute_suffixes(rows, length):
    count = collections.Counter()
    raws = [(r[0], (r[1] or "").encode()) for r in rows]
    for _, b in raws:
        count.update(b[i:i + length] for i in range(len(b) - length + 1))
    out = []
    for doc, b in raws:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if count[b[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((doc, len(b), len(b) - len(kept), len(re.findall(b"\1+", gone)), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("group", [4096, 3])
def test_suffixes_match_brute_force(docs, messy, group):
    got = suffix_dedup.suffix_dedup(docs, group=group, text=False).collect()
    assert sorted(map(tuple, got), key=str) == brute_suffixes(messy, 200)


def test_suffixes_of_a_row_that_repeats_thousands_of_times(spark):
    """All copies of a row share one list of spans, as long as one row's; null ids repeat too."""
    rnd = random.Random(2)
    text = "".join(rnd.choice("abcdefgh ") for _ in range(1500))
    rows = [(None, text)] * 3000 + [(7, text)] * 50 + [(8, "x" + text[300:900] + "y"), (9, text[:150])]
    got = collections.Counter(map(tuple, suffix_dedup.suffix_dedup(spark.createDataFrame(rows, "doc_id long, text string"), text=False).select("doc_id", "n_bytes", "n_removed", "n_spans").collect()))
    assert got == {(None, 1500, 1500, 1): 3000, (7, 1500, 1500, 1): 50, (8, 602, 600, 1): 1, (9, 150, 0, 0): 1}


def test_suffix_collisions_are_found_by_bytes(monkeypatch):
    """With a hash that always collides, only the bytes tell repeats apart."""
    data = np.frombuffer(b"abcdefgh" + b"abcdefgh" + b"abcdefgx", np.uint8)
    rows = {"key": np.ones(3, np.int64), "sub": np.zeros(3, np.int64), "lead": np.zeros(3, np.int64), "c": np.ones(3, np.int64), "parts": np.ones(3, np.int64)}
    monkeypatch.setattr(suffix_dedup.C, "slice_hash", lambda p, a, b: np.zeros(len(a), np.uint64))
    row, _ = suffix_dedup.repeated(rows, data, np.array([0, 8, 16, 24]), 8)
    assert sorted(row.tolist()) == [0, 1]


def test_suffix_sort_is_by_bytes():
    rnd = random.Random(3)
    raw = bytes(rnd.choice(b"ab") for _ in range(600))
    data, start = np.frombuffer(raw, np.uint8), np.arange(560)
    prefix = suffix_dedup.C.prefix_hash(data)
    order = suffix_dedup.suffix_sort(data, prefix, suffix_dedup.C.slice_hash(prefix, start, start + 40), start, np.zeros(560, np.int64), 40)
    assert [raw[i:i + 40] for i in order] == sorted(raw[i:i + 40] for i in range(560))


def test_lines_match_brute_force(docs, messy):
    sites = collections.defaultdict(set)
    where = collections.defaultdict(list)
    trimmed = lambda x: x.strip(line_dedup.BLANKS)
    for r in messy:
        for i, line in enumerate((r[1] or "").split("\n")):
            if trimmed(line):
                sites[trimmed(line)].add(r[3])
                where[trimmed(line)].append((r[0] is not None, r[0], i))
    want = []
    for r in messy:
        if r[1] is None:
            want.append((r[0], None, 0, 0))
            continue
        ls = r[1].split("\n")
        kept = [x for i, x in enumerate(ls) if not (len(sites[trimmed(x)]) >= 5 and trimmed(x) and (r[0] is not None, r[0], i) != min(where[trimmed(x)], key=lambda t: (t[0], t[1] or 0, t[2])))]
        want.append((r[0], "\n".join(kept), len(ls), len(ls) - len(kept)))
    got = [(r.doc_id, r.text, r.n_lines, r.n_removed) for r in line_dedup.line_dedup(docs).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert any(r[3] for r in got)


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(words[i:i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints_and_groups_match_brute_force(spark, docs, messy):
    got = {(r.doc_id, r.fingerprint): r.component_id for r in simhash.simhash_groups(docs).collect()}
    want = [(r[0], brute_fingerprint(r[1])) for r in messy]
    assert set(got) == {(d, f"{fp:016x}") for d, fp in want}
    groups = brute_groups({fp for _, fp in want})
    least = collections.defaultdict(list)
    for d, fp in want:
        least[groups[fp]].append(d)
    for d, fp in want:
        ids = [x for x in least[groups[fp]] if x is not None]
        assert got[d, f"{fp:016x}"] == (min(ids) if ids else None)


def brute_groups(fps, bits=2):
    root = {f: f for f in fps}

    def top(f):
        while root[f] != f:
            f = root[f]
        return f
    for a in fps:
        for b in fps:
            if bin(a ^ b).count("1") <= bits:
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {f: top(f) for f in fps}


@pytest.mark.parametrize("bits", [1, 2])
def test_links_lose_no_pair_of_near_fingerprints(spark, bits):
    rnd = random.Random(1)
    fps = set()
    for _ in range(60):
        f = rnd.getrandbits(64)
        for _ in range(6):
            fps.add(f)
            for _ in range(rnd.randint(1, 4)):
                f ^= 1 << rnd.randrange(64)
    fps |= {0, 3, 7, (1 << 64) - 1, 1 << 63}
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    linked = {r.node: r.root for r in connected_components(simhash.links(df, bits)).collect()}
    want = brute_groups(fps, bits)
    for a in fps:
        for b in fps:
            assert (want[a] == want[b]) == (linked.get(signed(a), signed(a)) == linked.get(signed(b), signed(b)))


def test_components_of_long_paths(spark):
    e = [(i, i + 1) for i in range(300) if i % 100 != 99] + [(1000, 1000), (None, 5)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(e, "a long, b long")).collect()}
    assert got == {i: i // 100 * 100 for i in range(300)}


def test_shared_passages_are_found_and_the_rest_is_left_alone(docs, messy):
    got = collections.defaultdict(list)
    for r in substring_dedup.substring_dedup(docs).collect():
        got[r.doc_id].append(r)
    shared = {i for i in range(120) if i % 3 == 0}
    copies = {6, 203, 204, 3, None, 9}
    for i in range(120):
        assert any(r.n_passages for r in got[i]) == (i in shared or i in copies), i
    assert all(not r.n_passages and r.class_id == r.doc_id and not r.n_links for d in (200, 201, 202, 205, 209, 210) for r in got[d])
    assert got[203][0].class_id == got[204][0].class_id == got[6][0].class_id


def test_edited_passages_are_one_class(spark):
    rnd = random.Random(2)
    w = lambda n: [f"{rnd.choice('abcdef')}{rnd.randint(0, 5000)}" for _ in range(n)]
    passage = w(80)
    rows = []
    for i in range(30):
        p = list(passage)
        for k in (25, 50):
            p[k + rnd.randint(0, 4)] = f"edit{i}"
        p.insert(38, f"more{i}")
        rows.append((i, " ".join(w(rnd.randint(0, 50)) + p + w(rnd.randint(0, 50)))))
    rows += [(100 + i, " ".join(w(120))) for i in range(10)]
    got = {r.doc_id: r for r in substring_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i].class_id == 0 and got[i].n_shared_words >= 70 for i in range(30))
    assert all(got[100 + i].n_passages == 0 for i in range(10))


def test_exact_passages_are_found_whatever_the_hubs_hold(spark):
    """A third document has only the middle of the passage, a fourth its halves in the other order; one of them can be the seeds' hub."""
    rnd, n = random.Random(12), iter(range(10**9))
    w = lambda k: [f"w{next(n)}" for _ in range(k)]
    rows, want = [], {}
    for i in range(60):
        p, edge = w(rnd.randint(50, 60)), len(rows)
        shorter = p[3:48]
        for d, text in enumerate((w(30) + p + w(20), w(7) + p + w(33) + p, w(15) + shorter + w(15), w(9) + p[28:] + w(5) + p[:28])):
            rows.append((edge + d, " ".join(text)))
        want[edge], want[edge + 1] = [(30, 30 + len(p))], [(7, 7 + len(p)), (40 + len(p), 40 + 2 * len(p))]
    got = {r.doc_id: r for r in substring_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for d in range(len(rows)):
        assert [(p.a, p.b) for p in got[d].passages] == want.get(d, []), d
        assert got[d].class_id == (d // 4 * 4 if d in want else d)


def test_exact_windows_match_brute_force(docs, messy):
    """Every window of 50 words that two documents have lies in a passage of each of them."""
    word = lambda t: re.findall(r"[0-9a-z\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    texts = {(r[0], r[1] or "") for r in messy}
    has = collections.defaultdict(set)
    for d, t in texts:
        v = word(t)
        for i in range(len(v) - 49):
            has[tuple(v[i:i + 50])].add((d, t))
    got = collections.defaultdict(list)
    for r in substring_dedup.substring_dedup(docs).collect():
        got[r.doc_id, r.n_words].append(r)
    n = 0
    for d, t in texts:
        v = word(t)
        for i in range(len(v) - 49):
            if len(has[tuple(v[i:i + 50])]) > 1:
                n += 1
                assert any(p.a <= i and i + 50 <= p.b for p in got[d, len(v)][0].passages)
    assert n > 500


def brute_passage(x, y):
    """Length of the best-scoring stretch of two equally long passages (1 for a word that agrees, -4 for one that doesn't)."""
    best = (0, 0)
    for i in range(len(x)):
        score = 0
        for j in range(i, len(x)):
            score += 1 if x[j] == y[j] else -4
            best = max(best, (score, j + 1 - i))
    return best[1]


def test_recall_of_edited_passages_against_brute_force(spark):
    """10 and 15 % of the words replaced, evenly and at random; decoys hold the seeds in another order, but no passage."""
    rnd, n = random.Random(5), iter(range(10**9))
    w = lambda k: [f"w{next(n)}" for _ in range(k)]
    rows, want, decoys = [], collections.defaultdict(list), []
    for length, share, even, extra in [(80, 0.1, 0, 0), (80, 0.1, 1, 0), (80, 0.15, 0, 0), (80, 0.15, 1, 0), (120, 0.15, 0, 0), (120, 0.15, 1, 0), (200, 0.15, 0, 0), (200, 0.15, 1, 0), (80, 0.06, 0, 2), (80, 0.1, 0, 2)]:
        for _ in range(40):
            p, d, m = w(length), len(rows), round(length * share)
            q = list(p)
            for i in [int((i + 0.5) * length / m) for i in range(m)] if even else rnd.sample(range(length), m):
                q[i] = next(iter(w(1)))
            rows += [(d + i, " ".join(w(rnd.randint(5, 60)) + x + w(rnd.randint(5, 60)))) for i, x in enumerate((p, q))]
            for _ in range(extra):
                cut = [p[s:s + 12] for s in range(0, length - 11, 9)]
                rnd.shuffle(cut)
                decoys.append(len(rows))
                rows.append((len(rows), " ".join(sum((c + w(25) for c in cut), []))))
            if brute_passage(p, q) >= 50:
                want[length, share, even, extra].append(d)
    got = {r.doc_id: r for r in substring_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    recall = {k: sum(got[d].n_passages > 0 and got[d].class_id == got[d + 1].class_id for d in v) / len(v) for k, v in want.items()}
    assert min(recall.values()) >= 0.9 and len(recall) == 10, recall
    assert not any(got[d].n_passages for d in decoys)


@pytest.mark.parametrize("others", [6, 90])
def test_edited_passages_are_found_whatever_the_hubs_of_seeds_and_pairs_hold(spark, others):
    """Others have all of the passage in pieces of 40 words, so their hash decides who is the hub of its seeds and pairs of seeds; none has
    the passage.  With 90 others no place of the passage has few."""
    rnd, n = random.Random(7), iter(range(10**9))
    w = lambda k: [f"w{next(n)}" for _ in range(k)]
    rows, want, pieces = [], [], []
    for _ in range(40 if others < 10 else 4):
        p = w(120)
        q = [f"e{next(n)}" if i % 14 == 9 else x for i, x in enumerate(p)]
        want.append(len(rows))
        rows += [(len(rows) + i, " ".join(w(rnd.randint(5, 60)) + x + w(rnd.randint(5, 60)))) for i, x in enumerate((p, q))]
        for _ in range(others):
            cut = [x[s:s + 40] for x in (p, q) for s in range(rnd.randint(0, 3), 90, 39)]
            rnd.shuffle(cut)
            pieces.append(len(rows))
            rows.append((len(rows), " ".join(sum((c + w(30) for c in cut), []))))
    got = {r.doc_id: r for r in substring_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[d].class_id == got[d + 1].class_id == d and min(got[d + i].n_shared_words for i in (0, 1)) >= 50 for d in want)
    assert not any(got[d].n_passages for d in pieces)


def test_copies_of_a_text_are_one_class_and_counted(spark):
    """Copies share the whole text; a text of too few words is none; rows that repeat id and text, and null ids, are told apart."""
    rnd = random.Random(9)
    w = lambda k: " ".join(f"{rnd.choice('abc')}{rnd.randint(0, 10**6)}" for _ in range(k))
    long, short, own, unnamed = w(60), w(40), w(90), w(70)
    rows = [(i, long) for i in range(3, 2003)] + [(5000, short), (5001, short), (6000, own), (6000, own), (None, unnamed), (7000, unnamed)]
    got = collections.Counter((r.doc_id, r.n_words, r.n_shared_words, r.n_links, r.class_id) for r in substring_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == collections.Counter([(i, 60, 60, 1, 3) for i in range(3, 2003)] + [(5000, 40, 0, 0, 5000), (5001, 40, 0, 0, 5001)] + [(6000, 90, 0, 0, 6000)] * 2 + [(None, 70, 70, 1, 7000), (7000, 70, 70, 1, 7000)])


def test_alignments_made_together_match_one_by_one():
    """Diagonals compared in one pass give what an alignment of its own gives each of them."""
    rnd = np.random.default_rng(3)
    pairs = []
    for _ in range(150):
        x = rnd.integers(0, 1 << 30, rnd.integers(60, 200)).astype("<u4")
        y = np.where(rnd.random(len(x)) < rnd.choice([0, 0.05, 0.15, 0.5]), 7, x).astype("<u4")
        i = int(rnd.integers(0, len(x) - 40))
        y[i:i + 5], y[i + 20:i + 25] = x[i:i + 5], x[i + 20:i + 25]
        pairs.append((x, np.concatenate([rnd.integers(0, 99, rnd.integers(0, 9)).astype("<u4"), y]), i))
    size = lambda a: np.cumsum([0, *map(len, a)])
    xs, ys, i = [p[0] for p in pairs], [p[1] for p in pairs], np.array([p[2] for p in pairs])
    j = i + np.array([len(y) - len(x) for x, y, _ in pairs])
    got = substring_dedup.straight(np.concatenate(xs), np.concatenate(ys), size(xs)[:-1], np.diff(size(xs)), size(ys)[:-1], np.diff(size(ys)), i, j, np.full(len(i), 20), 50)
    want = [(r, *f) for r, (x, y, _) in enumerate(pairs) for f in substring_dedup.align(x, y, np.array([[i[r], j[r]], [i[r] + 20, j[r] + 20]]), 50)]
    assert sorted(got) == sorted(want) and len(got) > 60


def test_chains_match_quadratic_dynamic_programme():
    rnd = random.Random(4)
    for _ in range(200):
        n = rnd.randint(2, 25)
        pos = np.sort(np.array([rnd.randint(0, 300) for _ in range(n)]))
        hpos = np.array([rnd.randint(0, 300) for _ in range(n)])
        best = [6.0] * n
        for i in range(n):
            for j in range(n):
                if pos[j] < pos[i] and hpos[j] < hpos[i]:
                    best[i] = max(best[i], best[j] + 6 - 0.05 * (pos[i] - pos[j] + hpos[i] - hpos[j]))
        chain = substring_dedup.best_chains(pos, hpos, 6, 0.05)
        score = lambda c: 6 * len(c) - 0.05 * sum(pos[b] - pos[a] + hpos[b] - hpos[a] for a, b in zip(c, c[1:]))
        assert sorted(sum(chain, [])) == list(range(n))
        assert max(map(score, chain)) == pytest.approx(max(best))


def test_places_meet_by_three_words_as_in_brute_force(spark):
    """Each place of a pair of seeds once for each three words, however often they stand around it; sliced, whole and as rows the same."""
    rnd = random.Random(5)
    texts = {d: [w for _ in range(12) for w in ([rnd.choice("abcdefghi")] * 25 if rnd.random() < 0.3 else rnd.choices("abcdefghi", k=rnd.randint(5, 30)))] for d in range(14)}
    places = sorted({(k, d, p, p + 7, rnd.randint(1, 2) * 100, rnd.random() < 0.3) for k in (1, 2, 3) for d in texts for p in rnd.sample(range(len(texts[d]) - 12), 4)})
    n = collections.Counter(p[0] for p in places)
    many, want = 12, set()
    for key in n:
        parts = collections.defaultdict(set)
        for x in places:
            text = texts[x[1]]
            for t in substring_dedup.STEPS.tolist():
                if x[0] == key and 0 <= x[2] + t <= len(text) - 3:
                    parts[(t > 0, *text[x[2] + t:x[2] + t + 3])].add(x)
        for part in map(sorted, parts.values()):
            for i, x in enumerate(part):
                for y in part[i + 1:] if len(part) <= many else part[:1]:
                    a, b = sorted((x, y))
                    if a[1] != b[1] and (len(part) > many or a[4] != b[4] or a[5] or b[5]):
                        want |= {(b[1], a[1], b[2], a[2]), (b[1], a[1], b[3], a[3])}
    packed = substring_dedup.packed_texts(spark.createDataFrame([(d, " ".join(t)) for d, t in texts.items()], "rid long, text string"))
    leads = spark.createDataFrame([(*p, True, n[p[0]]) for p in places], "key long, rid long, pos long, next long, root long, open boolean, lead boolean, n long")
    for got in (substring_dedup.met_in_zones(packed, leads, many), substring_dedup.met_in_zones(packed, leads, many, 10), substring_dedup.met_by_threes(packed, leads, many)):
        assert {tuple(r) for r in got.collect()} == want
    assert len(want) > 300


def test_chains_of_many_pairs_match_those_of_each(spark):
    rnd = random.Random(6)
    rows = {(a, b, p, p + rnd.choice([-40, 0, 0, 0, 0, 7])) for a in range(40) for b in range(a) if rnd.random() < 0.2 for p in rnd.sample(range(50, 400), rnd.randint(1, 6))}
    got = substring_dedup.chains(spark.createDataFrame(sorted(rows), "rid long, hub long, pos long, hpos long"), 5, 0.05, 48).collect()
    want = set()
    for pair in {r[:2] for r in rows}:
        pos, hpos = np.array(sorted(r[2:] for r in rows if r[:2] == pair)).T
        for c in substring_dedup.best_chains(pos, hpos, 5, 0.05):
            p, h = pos[c], hpos[c]
            want.add((*pair, *(max(0, int(x - 48) // 32 * 32) if i % 2 == 0 else -(-int(x + 53) // 32) * 32 for x, i in ((p[0], 0), (p[-1], 1), (h[0], 0), (h[-1], 1))), np.stack([p, h], 1).astype("<i8").tobytes()))
    assert sorted((*r[:6], bytes(r[6])) for r in got) == sorted(want) and len(want) > len({r[:2] for r in rows})


@pytest.mark.parametrize(("held", "hot"), [(1 << 20, 1 << 10), (40, 5)])
def test_places_of_keys_cross_the_shuffle_packed(spark, monkeypatch, held, hot):
    """Keys of one text end where they meet; a key with many places meets its hub in a join.  Rows that cross are packs, not places."""
    rnd = random.Random(11)
    rows = sorted({(rnd.choice([1, 2, 2, 2, 3] + [rnd.randint(10, 400)] * 4), rnd.randint(-50, 50), rnd.randint(0, 10**6), i) for i in range(1500)} | {(5, 7, p, 0) for p in range(60)})
    first = {}
    for k, r, p, _ in rows:
        first.setdefault(k, []).append((r, p))
    want = collections.Counter((k, r, p, n, *min(first[k])) for k, r, p, n in rows if len({r for r, _ in first[k]}) > 1)

    def find(batches):
        for b in batches:
            k, r, p, n = (b.column(i).to_numpy() for i in range(4))
            yield k.view(np.uint64), r, np.stack([p, n], 1)

    met, crossed = substring_dedup.map_batches, []
    monkeypatch.setattr(substring_dedup, "map_batches", lambda df, f, schema: crossed.append(met(df, f, schema)) or crossed[-1])
    df = spark.createDataFrame(rows, "key long, rid long, pos long, next long").repartition(3)
    got = substring_dedup.meeting(df, find, ["pos", "next"], "met", held, hot)
    assert collections.Counter(map(tuple, got.collect())) == want and len(want) > 500
    assert (crossed[0].where("kind = 2").isEmpty()) == (hot > 1000)
    packs = spark.conf.get("spark.sql.shuffle.partitions")
    assert hot < 1000 or crossed[0].count() <= 3 * substring_dedup.BUCKETS * int(packs)


def test_merged_spans_match_brute_force(spark):
    rnd = random.Random(8)
    rows = [(rnd.randint(0, 20), rnd.randint(-9, -1), a, a + rnd.randint(1, 40), h, h + rnd.randint(1, 9)) for a, h in [(rnd.randint(0, 900), rnd.randint(0, 60)) for _ in range(400)]]
    inside = collections.defaultdict(set)
    for r, hub, a, b, ha, hb in rows:  # places in halves, so that spans that touch are one and those a word apart are two
        inside[r] |= set(range(2 * a, 2 * b + 1))
        inside[hub] |= set(range(2 * ha, 2 * hb + 1))
    inside[3] |= set(range(0, 2 * 55 + 1))
    want = {r: [(p // 2, next(q for q in range(p, 10**4) if q + 1 not in x) // 2) for p in sorted(x) if p - 1 not in x] for r, x in inside.items()}
    found = spark.createDataFrame(rows, "rid long, hub long, a long, b long, ha long, hb long").repartition(4)
    got = substring_dedup.merged_spans(found, spark.createDataFrame([(3, 0, 55)], "rid long, a long, b long")).collect()
    assert {r.rid: [tuple(p) for p in r.passages] for r in got} == want and len(got) == len(want)


def test_alignments_over_several_diagonals_match_one_by_one():
    """How far alignments reach is found for many in one pass; those that are too short for a passage aren't aligned."""
    rnd = np.random.default_rng(5)
    pairs = []
    for _ in range(120):
        x = rnd.integers(0, 1 << 30, rnd.integers(60, 160)).astype("<u4")
        n, cut = len(x), int(rnd.integers(20, 30))
        y = np.concatenate([x[:cut], rnd.integers(0, 99, rnd.integers(1, 6)).astype("<u4"), x[cut:]])
        y = np.where(rnd.random(len(y)) < rnd.choice([0, 0.05, 0.3]), 7, y).astype("<u4")
        skip = len(y) - n
        y[10:15], y[cut + skip + 5:cut + skip + 10] = x[10:15], x[cut + 5:cut + 10]
        pairs.append((x, y, np.array([[10, 10], [cut + 5, cut + 5 + skip]])))
    pack = lambda v, t: pa.array([np.asarray(x).astype(t).tobytes() for x in v], pa.binary())
    zero = pa.array(np.zeros(len(pairs), np.int64))
    batch = pa.RecordBatch.from_arrays([zero, zero, zero, zero, pack([p[2] for p in pairs], "<i8"), pack([p[0] for p in pairs], "<u4"), pack([p[1] for p in pairs], "<u4")], names=list("abcdefg"))
    want = [(r, *f) for r, (x, y, m) in enumerate(pairs) for f in substring_dedup.align(x, y, m, 50)]
    assert substring_dedup.align_batch(batch, 50) == want and 40 < len(want) < 119
    for r, a, b, ha, hb, m in want:
        x, y, _ = pairs[r]
        assert 50 <= min(b - a, hb - ha) and m <= min(b - a, hb - ha) and x[a] == y[ha] and x[b - 1] == y[hb - 1]


def test_chains_have_each_match_once(spark):
    rows = [(2, 1, 100 + 9 * i, 200 + 9 * i) for i in range(6)] + [(3, 1, 50, 60), (3, 1, 50, 10), (3, 1, 90, 100)]
    one, two = (substring_dedup.chains(spark.createDataFrame(x, "rid long, hub long, pos long, hpos long"), 5, 0.05, 48).collect() for x in (rows, rows * 3))
    assert sorted(one) == sorted(two) and len(one) == 3


def test_empty_tables(none):
    assert suffix_dedup.suffix_dedup(none).count() == 0
    assert line_dedup.line_dedup(none).count() == 0
    assert simhash.simhash_groups(none).count() == 0
    assert substring_dedup.substring_dedup(none).count() == 0
