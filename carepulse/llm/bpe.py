"""BPE encoding and decoding, identical to the tokenizers library.

A text is normalised and split into words as the vocabulary file says, and each distinct word is
encoded once per task (until its bounded cache is full); a task ends without
leaving the vocabulary or the cache behind in its worker process, where later stages need the memory.  A stretch that nothing splits and that is longer than ``LONG`` characters
is encoded as a tree: its leaves of ``LEAF`` characters are encoded together, then neighbours are joined level
by level.  At each join the last tokens on the left and the first on the right are encoded
again as one window, which grows until its first token is the left side's and its last the right side's.
A BPE encoding is valid when each neighbouring pair of tokens is, so the join is then exact.

Texts of common European letters take a word cache in Python; the library itself encodes all
others, unless they hold a long stretch.  No shuffle and no collect; a document is encoded whole.
The vocabulary file is read once on the driver and sent as a broadcast of ``MAX_FILE`` bytes at most.
Null and empty texts have no tokens: ids ``""`` and decoded ``""``.
"""

from __future__ import annotations

import hashlib
import json
from pathlib import Path

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from carepulse.llm import common as C

MAX_FILE = 64 << 20
LONG, LEAF = 2048, 512
#: Distinct words kept by a task.
CACHE = 300_000
#: Letters and signs below U+0250 without the odd control and space characters: stable under NFC, and lowered alike everywhere.
PLAIN = regex.compile(r"[\t\n\r !-~¡-ɏ]*")
#: A stretch that can't be split anywhere: letters only, or neither letters, digits nor spaces.
UNSPLIT = regex.compile(rf"\p{{L}}{{{LONG},}}|[^\s\p{{L}}\p{{N}}]{{{LONG},}}")


class Codec:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer, models
        data = json.loads(spec)
        self.lib = Tokenizer.from_str(spec)
        self.lib.no_truncation()
        self.lib.no_padding()
        bpe = data["model"]
        self.names = {i: t for t, i in bpe["vocab"].items()} | {a["id"]: a["content"] for a in data["added_tokens"]}
        self.special = {a["content"]: a["id"] for a in data["added_tokens"]}
        self.at_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in bpe["merges"]]
        self.suffix = bpe.get("end_of_word_suffix") or ""
        # the same merges for a word's last part and for the parts before it, which have no word end
        self.inner = models.BPE(vocab=bpe["vocab"], merges=merges)
        self.last = models.BPE(vocab=bpe["vocab"], merges=merges, end_of_word_suffix=self.suffix) if self.suffix else self.inner
        self.pieces = regex.compile(data["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.cache: dict[str, tuple[str, str, int]] = {}
        bytes_as = _byte_characters()
        self.byte_of = [chr(bytes_as[b]) for b in range(256)]

    def ids(self, text: str) -> list[int]:
        """Token ids of a text."""
        if UNSPLIT.search(text) is None and UNSPLIT.search(text.lower()) is None:
            return self.lib.encode(text, add_special_tokens=False).ids
        out: list[int] = []
        for part in self.at_special.split(text) if self.at_special else [text]:
            if part in self.special:
                out.append(self.special[part])
            elif part:
                for piece, _ in self.lib.pre_tokenizer.pre_tokenize_str(self.lib.normalizer.normalize_str(part)):
                    out += self.word(piece)
        return out

    def word(self, piece: str) -> list[int]:
        """Ids of one word, given in the vocabulary's byte characters."""
        if len(piece) <= LONG:
            return [t.id for t in self.last.tokenize(piece)]
        return self.tree(piece)

    def encode_part(self, part: str, ends: bool) -> list[int]:
        return [t.id for t in (self.last if ends else self.inner).tokenize(part)]

    def tree(self, piece: str) -> list[int]:
        """Halves, halves of halves and so on down to leaves; joined level by level."""
        level = [(piece[i:i + LEAF], i + LEAF >= len(piece)) for i in range(0, len(piece), LEAF)]
        parts = [self.encode_part(*x) for x in level]
        while len(parts) > 1:
            top = len(parts) - 1
            parts = [self.join(parts[i], parts[i + 1], i + 1 == top) if i < top else parts[i] for i in range(0, len(parts), 2)]
        return parts[0]

    def text_of(self, ids: list[int]) -> str:
        return "".join(map(self.names.__getitem__, ids))

    def join(self, left: list[int], right: list[int], ends: bool) -> list[int]:
        """The encoding of both sides' text, from a window around the join that grows until it agrees with both."""
        size = 2
        while True:
            a, b = left[-size:], right[:size]
            whole = len(b) == len(right)
            s = self.text_of(a) + self.text_of(b)
            if whole and ends and self.suffix:
                s = s.removesuffix(self.suffix)
            window = self.encode_part(s, whole and ends)
            left_agrees = len(a) == len(left) or window[0] == a[0]
            right_agrees = whole or window[-1] == b[-1]
            if left_agrees and right_agrees:
                return left[:len(left) - len(a)] + window + right[len(b):]
            size *= 2

    def plain(self, text: str) -> tuple[str, str, int]:
        """Ids and tokens, each joined by spaces, and their number, of a text that ``PLAIN`` matches whole."""
        found, cache = self.pieces.findall(text.lower()), self.cache
        missing = {w for w in found if w not in cache}
        if missing:
            if len(cache) + len(missing) > CACHE:
                cache.clear()
                missing = set(found)
            for w in missing:
                got = self.word("".join(map(self.byte_of.__getitem__, w.encode())))
                cache[w] = (" ".join(map(str, got)), " ".join(map(self.names.__getitem__, got)), len(got))
        got = [cache[w] for w in found]
        return " ".join([x[0] for x in got]), " ".join([x[1] for x in got]), sum([x[2] for x in got])

    def encode(self, text: str) -> tuple[str, str, int]:
        """Ids as text, decoded text and number of tokens."""
        if PLAIN.fullmatch(text) and not (self.at_special and "<|" in text):
            return self.plain(text)
        ids = self.ids(text)
        return " ".join(map(str, ids)), self.decode(ids), len(ids)

    def decode(self, ids: list[int]) -> str:
        """Text of ids; the vocabulary file has no decoder, so tokens are joined by spaces."""
        return self.lib.decode(ids, skip_special_tokens=False)


def _byte_characters() -> list[int]:
    """The character that stands for each byte: itself if printable, else the next from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    return [b if b in set(printable) else 256 + rest.index(b) for b in range(256)]


def read_spec(path: str) -> str:
    if Path(path).stat().st_size > MAX_FILE:
        raise ValueError(f"vocabulary file over {MAX_FILE} bytes")
    return Path(path).read_text("utf-8")


def bpe_round_trip(docs: DataFrame, path: str, carry: list[str] | None = None, tokens: bool = True) -> DataFrame:
    """Every document with ``n_tokens``, the digests of its ids and of its decoded text, and with ``tokens`` the ids and decoded text."""
    sent = docs.sparkSession.sparkContext.broadcast(read_spec(path))
    result = "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids string, decoded string" * tokens

    def work():
        own = Codec(sent.value)

        def f(texts):
            made = [own.encode(t) for t in texts.to_pylist()]
            out = [pa.array([m[2] for m in made], pa.int64()), *(pa.array([hashlib.sha256(m[k].encode()).hexdigest() for m in made], pa.string()) for k in (0, 1))]
            return out + [pa.array([m[k] for m in made], pa.string()) for k in (0, 1)] * tokens
        return f

    return C.map_texts(docs, result, work, ["doc_id"] if carry is None else carry, after=C.hand_back)
