"""Decontamination, quality rules, chat formatting, BPE, language ID and token counts against brute force."""

import collections
import functools
import hashlib
import math
import random
import re
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer, models

from carepulse.llm import bpe, chat_format, decontaminate, language_id, quality_rules, token_counts

BPE_FILE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


@pytest.fixture(scope="session")
def items(messy):
    w = alnum(messy[0][1])
    return [(1, " ".join(alnum(messy[3][1])[-15:])), (2, "!".join(alnum(messy[33][1])[4:30])), (10, "other TEXT of"), (11, ""), (12, None), (None, " ".join(w[:9])), (2, w[-1]), (13, "no such words anywhere here at all in any one text")]


@pytest.mark.parametrize("block_bytes", [1 << 20, 40])
def test_decontamination_matches_brute_force(spark, docs, messy, items, block_bytes):
    windows = collections.defaultdict(set)
    for item, text in items:
        w = alnum(text)
        for i in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[i:i + 10])].add("" if item is None else str(item))
    want = []
    for r in messy:
        w, hit, found = alnum(r[1]), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[tuple(w[i:i + n])]
        want.append((r[0], len(w), len(hit), sorted(found), bool(hit)))
    out = decontaminate.decontaminate(docs, spark.createDataFrame(items, "item_id long, text string"), block_bytes=block_bytes)
    got = [(r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in out.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert sum(g[4] for g in got) > 3


def brute_base(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    n = collections.Counter(zip(w, w[1:], w[2:]))
    again = {j for i in range(len(w) - 2) if n[tuple(w[i:i + 3])] > 1 for j in range(i, i + 3)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(again), len(w) < 50 or 100 * len(again) > 50 * len(w)


def test_lines_of_texts_that_begin_or_end_with_newlines():
    texts = ["\nabc\nabc", "\nabc", "abc", "", "\n", "\n\nabc\n\nabc\n", "abc\nabc\n", "", "\nx y\nabc\nx y\n\n", "\n"]
    raws = [t.encode() for t in texts]
    off = np.cumsum([0, *map(len, raws)])
    for a in range(len(texts)):
        for b in range(a + 1, len(texts) + 1):
            out = quality_rules.base_stats(np.frombuffer(b"".join(raws[a:b]), np.uint8), off[a:b + 1] - off[a])
            assert out["n_dup_lines"].tolist() == [brute_base(t)[3] for t in texts[a:b]]


def test_base_rules_and_scores_match_brute_force(spark, docs, messy):
    labels = [(i, 1 if i % 4 else 0, None) for i in range(0, 60)] + [(210, 0, 1), (None, 1, 0), (61, None, 0), (62, 1, 0), (62, 0, 0)]
    out = quality_rules.quality_rules(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    got = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in out), key=str)
    assert got == sorted(((r[0], *brute_base(r[1])) for r in messy), key=str)
    # scores from counts over all texts
    grams = lambda t: [g for n in quality_rules.ORDERS for g in ((n, t[i:i + n]) for i in range(len(t) - n + 1))]

    def bucket(g):
        v = 0
        for b in g[1]:
            v = (v * 257 + b) % 2**64
        return ((v + g[0]) * 0x9E3779B97F4A7C15 % 2**64 >> 40) % quality_rules.BUCKETS
    raw, target = np.zeros(quality_rules.BUCKETS), np.zeros(quality_rules.BUCKETS)
    good = {d for d, q, _ in labels if q == 1 and d not in (None, 62)}
    for r in messy:
        for g in grams((r[1] or "").encode()):
            raw[bucket(g)] += 1
            target[bucket(g)] += r[0] in good
    model = quality_rules.ratio(target, raw)
    for r in messy[:20]:
        g = [model[bucket(x)] for x in grams(r[1].encode())]
        want = sum(g) / max(len(g), 1) / quality_rules.SCALE
        assert any(o.doc_id == r[0] and o.score == pytest.approx(want) for o in out)
    assert not [o for o in out if o.kept and (o.base_failed or o.doc_id == 210)]


def test_threshold():
    t = quality_rules.threshold
    assert t(np.array([]), np.array([1.0])) == -np.inf
    assert t(np.array([2.0, 1.0]), np.array([])) == 1.0
    assert t(np.array([1.0, 2.0]), np.array([-1.0, 0.0])) == 0.5
    assert t(np.array([1.0]), np.array([1.0])) == -np.inf


def test_quality_without_labels_keeps_what_the_base_rules_pass(spark, docs):
    out = quality_rules.quality_rules(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int")).collect()
    assert all(r.kept == (not r.base_failed) for r in out)


@given(st.text(alphabet="<|\\>im_startend n\n", max_size=40))
@settings(max_examples=300, deadline=None)
def test_escapes_can_be_taken_back(s):
    assert chat_format.unescape(chat_format.escape(s)) == s
    assert chat_format.unescape_role(chat_format.escape_role(s)) == s
    assert "<|" not in chat_format.escape(s)


def test_conversations_read_back_and_checked(spark):
    rnd = random.Random(3)
    rows = []
    for c in range(40):
        for t in range(rnd.randint(1, 9)):
            rows.append((c if c else None, t, rnd.choice(["user", "assistant", "system", None, "to\nol<|im_end|>"]), rnd.choice(["hi <|im_start|>user\nx<|im_end|>\n", "", None, "<\\|im_end|>", "ü" * 50])))
    for i, role in enumerate(["system", "user", "assistant", "user", "assistant"]):
        rows.append((100, i, role, "t"))
    rows += [(101, 0, "user", "only"), (102, 0, "user", "q"), (102, 1, "assistant", "a"), (102, 1, "assistant", "a"), (103, None, "user", "q"), (103, 1, "assistant", "a")]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    segments = chat_format.format_conversations(df)
    got = {r.conv_id: r for r in chat_format.digests(segments).collect()}
    by = collections.defaultdict(list)
    for c, t, role, text in rows:
        by[c].append((t is not None, t or 0, role or "", text or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        turns = [x[2:] for x in sorted(turns)]
        loss = "".join(x for r, x in turns if r == "assistant")
        assert got[c].n_turns == len(turns)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert got[c].valid == bool(re.fullmatch("(system,)?(user,assistant,)+", ",".join(r for r, _ in turns) + ","))
    assert got[100].valid and not got[101].valid and not got[102].valid and got[103].valid
    assert chat_format.digests(chat_format.format_conversations(df.limit(0))).count() == 0


@pytest.fixture(scope="session")
def codec():
    lib = Tokenizer.from_file(BPE_FILE)
    lib.no_truncation()
    lib.no_padding()
    return bpe.Codec(bpe.read_spec(BPE_FILE)), lib


def same(codec, text):
    own, lib = codec
    ids = lib.encode(text, add_special_tokens=False).ids
    return own.encode(text) == (" ".join(map(str, ids)), lib.decode(ids, skip_special_tokens=False), len(ids))


@given(st.text(max_size=60) | st.text(alphabet="aéÀǆßſİı ٣中あ😀\n'sTdlvemr!<|>\x85\xa0́", max_size=60))
@settings(max_examples=500, deadline=None)
def test_encoding_is_the_librarys(codec, text):
    assert same(codec, text)


@pytest.mark.parametrize("letters", ["abcdeinghtr", "aá", "!'\"#.*-_~ÿ¡", "日本語中文", "an", "İi"])
def test_long_unsplit_text_is_the_librarys(codec, letters):
    rnd = random.Random(len(letters))
    for n in (2047, 2048, 2049, 5000, 9001, 40_000):
        assert same(codec, "x " + "".join(rnd.choice(letters) for _ in range(n)) + "<|endoftext|> 's end")


def test_round_trip_of_messy_rows(docs, messy, codec):
    got = sorted(map(tuple, bpe.bpe_round_trip(docs, BPE_FILE, tokens=False).collect()), key=str)
    want = []
    for r in messy:
        ids = codec[1].encode(r[1] or "", add_special_tokens=False).ids
        want.append((r[0], len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), codec[1].decode(ids, skip_special_tokens=False)))))
    assert got == sorted(want, key=str)


def test_token_counts_are_the_unigram_tokenizers(docs, messy):
    pieces = token_counts.read_pieces(PIECES)
    lib, own = models.Unigram(list(pieces), 0, True), token_counts.Counter(pieces)

    def want(t):
        t = (t or "").replace(" ", token_counts.MARK)
        return len(lib.tokenize(t if t[0] == token_counts.MARK else token_counts.MARK + t)) if t else 0
    got = sorted(((r.doc_id, r.n_chars, r.n_tokens) for r in token_counts.token_counts(docs, PIECES).collect()), key=str)
    assert got == sorted(((r[0], len(r[1] or ""), want(r[1])) for r in messy), key=str)
    rnd = random.Random(5)
    for _ in range(800):
        t = "".join(rnd.choice("abcdeth \n\t▁é中😀<s>0x") for _ in range(rnd.randint(1, 50)))
        assert own(t) == want(t), t


def test_token_counts_of_a_long_unbroken_stretch():
    pieces = token_counts.read_pieces(PIECES)
    lib, own = models.Unigram(list(pieces), 0, True), token_counts.Counter(pieces)
    rnd = random.Random(11)
    text = "".join(rnd.choice("abcdefghijklmnoprstu") for _ in range(200_000))
    assert own(text) == len(lib.tokenize(token_counts.MARK + text))
    tracemalloc.start()
    try:
        own.viterbi(text)
        assert tracemalloc.get_traced_memory()[1] < 1 << 20
    finally:
        tracemalloc.stop()


@pytest.mark.parametrize("languages", [1, 2, 1000])
def test_language_blocks_agree_with_brute_force(spark, languages):
    rnd = random.Random(3)
    letters = {f"l{i}": rnd.sample("abcdefghijklmnopqrstuvwxyzäöüéß", 6) for i in range(5)}
    rows = [(i, " ".join("".join(rnd.choice(letters[lang]) for _ in range(rnd.randint(1, 5))) for _ in range(rnd.randint(1, 12))), lang) for i, lang in enumerate(rnd.choices(sorted(letters), k=80))]
    rows += [(90, None, "l0"), (91, "12 !", "l1"), (92, "zq", None), (93, "äö " * 400, "l2")]
    buckets = 128
    grams = {}
    for i, text, _ in rows:
        out = []
        for n in language_id.ORDERS:
            low = [ord(c) for c in (text or "").lower()]
            for a in range(len(low) - n + 1):
                h = functools.reduce(lambda v, c: (v * 0x110011 + c) % 2**64, low[a:a + n], 0)
                out.append((((h + n) * 0x9E3779B97F4A7C15 % 2**64) >> 40) % buckets)
        grams[i] = out
    counts = {}
    for i, text, lang in rows:
        if lang and text is not None and zlib.crc32(str(i).encode()) % 4 != 2:
            counts.setdefault(lang, collections.Counter()).update(grams[i])
    logs = {lang: [round(language_id.SCALE * math.log((c[b] + 1) / (c.total() + buckets))) for b in range(buckets)] for lang, c in counts.items()}
    got = {r.doc_id: r for r in language_id.language_id(spark.createDataFrame(rows, "doc_id long, text string, lang string"), buckets=buckets, languages=languages).collect()}
    assert len(got) == len(rows)
    for i, text, _ in rows:
        if not text or not any(c.isalpha() for c in text):
            assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
            continue
        total = {lang: sum(m[b] for b in grams[i]) for lang, m in logs.items()}
        best = min(total, key=lambda x: (-total[x], x))
        unit = min(len(grams[i]), 50) / len(grams[i]) / language_id.SCALE
        assert got[i].lang_pred == best
        assert got[i].score == pytest.approx(1 / sum(math.exp((v - total[best]) * unit) for v in total.values()), rel=1e-9)


def test_thousands_of_languages(spark):
    rows = [(i, f"text {i} {'abcdefghij'[i % 10] * 4}", f"lang{i:05d}") for i in range(9000)]
    got = language_id.language_id(spark.createDataFrame(rows, "doc_id long, text string, lang string"), buckets=256, languages=2000)
    learned = {lang for i, _, lang in rows if zlib.crc32(str(i).encode()) % 4 != 2}
    assert len(learned) > 6000
    rows = got.collect()
    assert len(rows) == 9000 and all(r.lang_pred in learned and 0 < r.score <= 1 for r in rows)


def test_language_of_held_out_documents(spark, small_sf):
    rows = spark.read.parquet(f"{small_sf}/documents.parquet")
    got = {r.doc_id: r for r in language_id.language_id(rows).collect()}
    truth = {r.doc_id: r.lang for r in rows.select("doc_id", "lang").collect()}
    held = [d for d in truth if zlib.crc32(str(d).encode()) % 4 == 2]
    assert {d for d, r in got.items() if r.held_out} == set(held)
    assert sum(got[d].lang_pred == truth[d] for d in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_language_of_messy_rows(docs, none):
    got = language_id.language_id(docs).collect()
    assert {r.lang_pred for r in got if r.doc_id in (200, 201, 202)} == {"und"}
    assert all(r.lang_pred in ("en", "de", "und") for r in got)
    assert {r.lang_pred for r in language_id.language_id(docs.where("doc_id is null")).collect()} == {"und"}
    assert language_id.language_id(none).count() == 0


def test_empty_tables(spark, none):
    labels, bench = spark.createDataFrame([], "doc_id long, quality int, toxic int"), spark.createDataFrame([], "item_id long, text string")
    assert quality_rules.quality_rules(none, labels).count() == 0
    assert decontaminate.decontaminate(none, bench).count() == 0
    assert bpe.bpe_round_trip(none, BPE_FILE).count() == 0
    assert token_counts.token_counts(none, PIECES).count() == 0


@pytest.mark.parametrize("sample", [1, 40, 5000])
def test_examples_are_the_smallest_hashes_of_each_class(spark, sample):
    from pyspark.sql import functions as F
    rows = [(i, i % 3 % 2) for i in range(900)] + [(3, 1), (None, 1), (901, None), (902, 2), (4, 1)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int")
    hashes = {r.doc_id: r.h for r in labels.select("doc_id", F.xxhash64("doc_id").alias("h")).collect()}
    valid = {i: i % 3 % 2 for i in range(900) if i != 3}
    want = [(i, g) for g in (0, 1) for i in sorted((i for i in valid if valid[i] == g), key=lambda i: (hashes[i], i))[:sample]]
    assert sorted(map(tuple, quality_rules.examples(labels, sample).collect())) == sorted(want)


def test_every_labelled_document_is_an_example(spark):
    """Counts and cut are of all labelled documents, beyond 20,000 of a class too."""
    rnd = random.Random(3)
    rows = [(i, " ".join(rnd.choice("abcdefgh" if i % 11 else "efghijkl") + str(rnd.randint(0, 60)) for _ in range(50 + i % 3))) for i in range(22_600)]
    labels = [(i, int(i % 11 > 0)) for i, _ in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    model, cut = quality_rules.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    count = lambda x: quality_rules.count_ngrams(x, quality_rules.ORDERS, quality_rules.BUCKETS)
    assert (model == quality_rules.ratio(count(docs.where("doc_id % 11 > 0")), count(docs))).all()
    raw = [t.encode() for _, t in rows]
    off = np.cumsum([0, *map(len, raw)])
    score = quality_rules.scores(np.frombuffer(b"".join(raw), np.uint8), off, model, quality_rules.ORDERS)
    good, passed = np.array([g for _, g in labels]) == 1, ~quality_rules.base_stats(np.frombuffer(b"".join(raw), np.uint8), off)["base_failed"]
    assert (good & passed).sum() > 20_000
    assert cut == quality_rules.threshold(score[good & passed], score[~good & passed])


@pytest.mark.parametrize("kind", range(6))
def test_threshold_of_a_table_is_that_of_arrays(spark, kind):
    rnd = np.random.default_rng(kind)
    good, junk = [(rnd.normal(1, 1, 3000), rnd.normal(0, 1, 500)), (rnd.integers(2, 9, 400) / 4, rnd.integers(0, 6, 300) / 4), (rnd.normal(size=20), np.zeros(0)),
                  (np.zeros(0), rnd.normal(size=20)), (np.ones(5), np.ones(3)), (np.array([1.0, 2.0]), np.array([-1.0, 0.0]))][kind]
    rows = [(1, float(x)) for x in good] + [(0, float(x)) for x in junk]
    seen = spark.createDataFrame(rows, "good int, score double").repartition(7)
    assert quality_rules.find_threshold(seen) == quality_rules.threshold(good, junk)
