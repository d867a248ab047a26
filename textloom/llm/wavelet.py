"""Token ids in wavelet matrices: one succinct file image per shard of documents.

Documents are range-partitioned by doc_id and text hash; each task encodes its texts in order
and cuts the ids into shards of about ``SHARD_TOKENS``. A shard's image holds a
document table and one bit-plane per bit of a token id, highest first, each
stably sorted by the bits before (a wavelet matrix), with ones counted at every
``RANK_STEP`` bits. ``Shard`` reads one image: access, rank, select, counting
and occurrences of a token without decoding the rest, or everything in order.

Images are binary values of a Parquet table in the shared folder, written by
Spark's committer, so a lost executor's shards are written again and any store
Spark reaches will do. Parquet compresses the images.

Defined results: a null or empty text is just the end id; null doc_ids come
first; repeated doc_ids are ordered by text hash and each is a document; an
empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import saved, text_pieces

SHARD_TOKENS = 1 << 18
PIECE_BYTES = 4 << 20      # text encoded at once
RANK_STEP = 512
END_ID = 1
CACHE_WORDS = 300_000      # distinct words a worker remembers before it starts anew
_MAGIC = b"TLWM0001"
SHARDS = "part int, seq int, n_docs long, n_tokens long, image binary"


# ---- encoding ----------------------------------------------------------------------------------

# What the tokenizer does to a word of these characters, as long as no special token is in it: lower
# case, then these runs, each spelled in byte letters. All other words go to the tokenizer whole.
# The words of a batch are split at once, with a space between words, which is a run of its own.
_PLAIN = "^[\x21-\x7e\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+$"
_RUNS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^ a-z0-9\u00df-\u00f6\u00f8-\u00ff]+| ")

# The normalizer and the pre-tokenizer that these rules stand for. A file with others has
# its texts encoded whole.
_SPLITS = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
         "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}}


def _by_words(path: str) -> bool:
    """Whether white space ends every token of this tokenizer file and its words may be encoded one by one."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    return (all(spec.get(k) == v for k, v in _SPLITS.items()) and not spec.get("truncation")
            and all(t["special"] and not (t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]) and not re.search(r"\s", t["content"])
                    for t in spec.get("added_tokens", ())))


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: itself where printable, else one from 256 up."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


def _segments(flat: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The pieces of ``flat`` that begin at ``start``, one after the other."""
    to = np.cumsum(length, dtype=np.int64)
    return flat[np.repeat(start - (to - length), length) + np.arange(to[-1] if len(to) else 0)]


def _places(values: pa.Array, known: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The place of each distinct value in ``known`` with the unknown ones put at its end, and these."""
    at = pc.index_in(values, value_set=known)
    new = values.filter(at.is_null())
    at = np.asarray(at.fill_null(-1)).astype(np.int64)
    at[at < 0] = len(known) + np.arange(len(new))
    return at, new


class WordEncoder:
    """Encodes texts word by word through the tokenizer, remembering words and runs.

    White space ends every token of a tokenizer with ``_SPLITS``, so a text's ids are
    its words' ids in turn; for any other file texts are encoded whole. Words are split and numbered by Arrow; only the
    distinct words of a batch are looked up, and only unknown ones encoded, all of a batch at once. Known words and
    runs are Arrow strings, numbered by their place: a few bytes each. When too many are known, those that came in
    one batch only are forgotten.
    """

    def __init__(self, path: str, end_id: int = END_ID, cache_words: int = CACHE_WORDS):
        from tokenizers import Tokenizer
        self.tok, self.by_words = Tokenizer.from_file(path), _by_words(path)
        self.end_id, self.cache_words = end_id, cache_words
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.signs = os.path.commonprefix(self.special)       # begins every special token
        self.letters = _byte_letters()
        self.bits = max(1, int(self.tok.get_vocab_size(with_added_tokens=True) - 1).bit_length())
        self._reset()
        self._reset_runs()

    @property
    def index(self) -> dict[str, int]:
        """The words known and their numbers."""
        return {w: i for i, w in enumerate(self.words.to_pylist())}

    def _reset(self) -> None:
        self.words = pa.array([""], pa.large_string())
        self.flat = np.zeros(0, np.uint32)
        self.start, self.length = np.zeros(1, np.int64), np.zeros(1, np.int32)
        self.seen = np.zeros(1, np.uint8)               # batches that held the word, 2 at most

    def _reset_runs(self) -> None:
        self.runs = pa.array([" "], pa.large_string())
        self.run_flat = np.zeros(0, np.uint32)
        self.run_start, self.run_length = np.zeros(1, np.int64), np.zeros(1, np.int32)

    def _forget(self) -> None:
        """Words of one batch go; if those of several are too many, all go."""
        keep = np.flatnonzero(self.seen > 1)
        if len(keep) * 2 > self.cache_words:
            self._reset()
            return
        keep = np.r_[0, keep[keep > 0]]
        length = self.length[keep]
        self.flat = _segments(self.flat, self.start[keep], length)
        self.words = self.words.take(pa.array(keep))
        self.start, self.length = np.cumsum(length, dtype=np.int64) - length, length
        self.seen = np.ones(len(keep), np.uint8)

    def _runs_of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, ids per word) of words of plain characters."""
        if len(self.runs) > 2 * self.cache_words:
            self._reset_runs()
        found = pa.array(_RUNS.findall(" ".join(words).lower()), pa.large_string()).dictionary_encode()
        number, unknown = _places(found.dictionary, self.runs)
        if len(unknown):
            new = unknown.to_pylist()
            spelled = [r if r.isascii() else "".join([self.letters[b] for b in r.encode()]) for r in new]
            ids, length = array("I"), array("i")
            for r in spelled:
                got = self.tok.model.tokenize(r)
                length.append(len(got))
                if len(got) == 1:
                    ids.append(got[0].id)
                else:
                    ids.extend([t.id for t in got])
            length = np.array(length, np.int32)
            start = len(self.run_flat) + np.cumsum(length, dtype=np.int64) - length
            self.run_flat = np.concatenate([self.run_flat, np.array(ids, np.uint32)])
            self.runs = pa.concat_arrays([self.runs, unknown])
            self.run_start, self.run_length = np.r_[self.run_start, start], np.r_[self.run_length, length]
        at = number[np.asarray(found.indices)]
        length = self.run_length[at]
        upto = np.r_[0, np.cumsum(length, dtype=np.int64)]
        ends = np.r_[np.flatnonzero(at == 0), len(at)]
        return _segments(self.run_flat, self.run_start[at], length), np.diff(np.r_[0, upto[ends]]).astype(np.int32)

    def _encoded(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, ids per word) of words."""
        new = words.to_pylist()
        plain = np.asarray(pc.match_substring_regex(words, _PLAIN))
        for i in np.flatnonzero(plain & np.asarray(pc.match_substring(words, self.signs))) if self.special else ():
            plain[i] = not any(t in new[i] for t in self.special)
        own = np.flatnonzero(plain)
        if len(own) == len(new):
            return self._runs_of(new)
        length = np.zeros(len(new), np.int32)
        whole = {i: self.tok.encode(new[i], add_special_tokens=False).ids for i in np.flatnonzero(~plain)}
        ids, sizes = self._runs_of([new[i] for i in own]) if len(own) else (np.zeros(0, np.uint32), np.zeros(0, np.int32))
        length[own] = sizes
        length[list(whole)] = [len(x) for x in whole.values()]
        start = np.zeros(len(new), np.int64)
        start[own] = np.cumsum(sizes, dtype=np.int64) - sizes
        rest = length[list(whole)]
        start[list(whole)] = len(ids) + np.cumsum(rest, dtype=np.int64) - rest
        ids = np.concatenate([ids, np.fromiter(chain.from_iterable(whole.values()), np.uint32, int(rest.sum()))])
        return _segments(ids, start, length), length

    def _numbers(self, words: pa.Array) -> np.ndarray:
        if len(self.words) > self.cache_words:
            self._forget()
        at, new = _places(words, self.words)
        if len(new):
            ids, length = self._encoded(new)
            start = len(self.flat) + np.cumsum(length, dtype=np.int64) - length
            self.flat = np.concatenate([self.flat, ids])
            self.words = pa.concat_arrays([self.words, new])
            self.start, self.length = np.r_[self.start, start], np.r_[self.length, length]
            self.seen = np.r_[self.seen, np.zeros(len(new), np.uint8)]
        self.seen[at] = np.minimum(self.seen[at] + 1, 2)
        return at

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, ids per text) of an array of strings without nulls; every text ends with the end id."""
        if not self.by_words:
            got = [np.array([*self.tok.encode(t, add_special_tokens=False).ids, self.end_id], np.uint32) for t in texts.to_pylist()]
            return np.concatenate(got or [np.zeros(0, np.uint32)]), np.array([len(g) for g in got], np.int64)
        lists = pc.ascii_split_whitespace(texts)
        ends = np.asarray(lists.offsets)[1:].astype(np.int64) - lists.offsets[0].as_py()
        found = pc.dictionary_encode(lists.flatten())
        at = self._numbers(found.dictionary.cast(pa.large_string()))[np.asarray(found.indices)]
        length, start = self.length[at], self.start[at]
        length, start = np.insert(length, ends, 1), np.insert(start, ends, len(self.flat))
        to = np.cumsum(length, dtype=np.int64)
        ids = _segments(np.append(self.flat, np.uint32(self.end_id)), start, length)
        last = ends + np.arange(len(ends))
        return ids, np.diff(np.r_[0, to[last]]) if len(ends) else np.zeros(0, np.int64)


@lru_cache(maxsize=2)
def encoder(path: str, end_id: int) -> WordEncoder:
    """One encoder (and its memory of words) per worker process."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordEncoder(path, end_id)


# ---- the file image ----------------------------------------------------------------------------

def build_image(ids: np.ndarray, bits: int, docs: np.ndarray, known: np.ndarray, sizes: np.ndarray) -> bytes:
    """The image of one shard: header, document table, zeros per plane, planes with rank counts."""
    n = len(ids)
    wide = np.uint16 if bits <= 16 else np.uint32
    a = ids.astype(wide)
    planes, zeros = [], []
    for level in range(bits):
        bit = (a >> wide(bits - 1 - level)) & wide(1)
        one = bit.astype(bool)
        packed = np.packbits(one, bitorder="little")
        packed = np.pad(packed, (0, -len(packed) % (RANK_STEP // 8)))
        ones = np.bitwise_count(packed.view(np.uint64)).reshape(-1, RANK_STEP // 64).sum(1)
        planes += [packed.tobytes(), (np.cumsum(ones) - ones).astype("<u4").tobytes()]
        low = a.compress(~one)
        zeros.append(len(low))
        a = np.concatenate([low, a.compress(one)])
    head = struct.pack("<8sQQII", _MAGIC, n, len(docs), bits, RANK_STEP)
    table = docs.astype("<i8").tobytes() + known.astype("u1").tobytes() + sizes.astype("<u8").tobytes()
    return b"".join([head, table, np.array(zeros, "<u8").tobytes(), *planes])


class Shard:
    """A wavelet matrix read from its image."""

    def __init__(self, image: bytes):
        magic, self.n, n_docs, self.bits, self.step = struct.unpack_from("<8sQQII", image)
        if magic != _MAGIC:
            raise ValueError("not a shard image")
        at = struct.calcsize("<8sQQII")

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(image, kind, n, at)
            at += out.nbytes
            return out

        self.docs, self.known, self.sizes = take("<i8", n_docs), take("u1", n_docs).astype(bool), take("<u8", n_docs)
        self.zeros = take("<u8", self.bits)
        blocks = -(-self.n // self.step)
        self.planes, self.counts = [], []
        for _ in range(self.bits):
            self.planes.append(take("u1", blocks * self.step // 8))
            self.counts.append(take("<u4", blocks))

    def _bit(self, level: int, i: int) -> int:
        return int(self.planes[level][i >> 3] >> (i & 7)) & 1

    def _ones(self, level: int, i: int) -> int:
        """Ones before position ``i``."""
        block, rest = divmod(i, self.step)
        if not rest:
            return int(self.counts[level][block]) if block < len(self.counts[level]) else self.n - int(self.zeros[level])
        part = self.planes[level][block * self.step // 8:][:-(-rest // 8)]
        return int(self.counts[level][block]) + int(np.unpackbits(part, bitorder="little")[:rest].sum())

    def _down(self, level: int, i: int, bit: int) -> int:
        ones = self._ones(level, i)
        return int(self.zeros[level]) + ones if bit else i - ones

    def access(self, i: int) -> int:
        """The token at position ``i``."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        out = 0
        for level in range(self.bits):
            bit = self._bit(level, i)
            out, i = out << 1 | bit, self._down(level, i, bit)
        return out

    def _range(self, token: int, lo: int, hi: int) -> tuple[int, int]:
        for level in range(self.bits):
            bit = token >> (self.bits - 1 - level) & 1
            lo, hi = self._down(level, lo, bit), self._down(level, hi, bit)
        return lo, hi

    def rank(self, token: int, i: int) -> int:
        """Occurrences of a token before position ``i``."""
        if token >> self.bits or token < 0:
            return 0
        lo, hi = self._range(token, 0, min(max(i, 0), self.n))
        return hi - lo

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def select(self, token: int, k: int) -> int:
        """Position of the ``k``-th occurrence (from 0) of a token."""
        if not 0 <= k < self.count(token):
            raise IndexError(k)
        i = self._range(token, 0, self.n)[0] + k
        for level in range(self.bits - 1, -1, -1):
            one = token >> (self.bits - 1 - level) & 1
            want = i - int(self.zeros[level]) if one else i      # that many ones (zeros) lie before
            lo, hi = 0, self.n - 1
            while lo < hi:                                       # first position with want + 1 of them
                mid = (lo + hi) // 2
                ones = self._ones(level, mid + 1)
                if (ones if one else mid + 1 - ones) > want:
                    hi = mid
                else:
                    lo = mid + 1
            i = lo
        return i

    def occurrences(self, token: int) -> list[int]:
        return [self.select(token, k) for k in range(self.count(token))]

    def decode(self) -> np.ndarray:
        """All tokens in order: planes merged from the lowest up."""
        wide = np.uint16 if self.bits <= 16 else np.uint32
        v = np.zeros(self.n, wide)
        for level in range(self.bits - 1, -1, -1):
            one = np.unpackbits(self.planes[level], count=self.n, bitorder="little").astype(bool)
            v[int(self.zeros[level]):] |= wide(1 << (self.bits - 1 - level))
            up = np.empty(self.n, wide)
            up[~one], up[one] = v[:int(self.zeros[level])], v[int(self.zeros[level]):]
            v = up
        return v


# ---- Spark jobs --------------------------------------------------------------------------------

def write_shards(docs: DataFrame, path: str, text: str = "text", end_id: int = END_ID,
                 shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Encode, in ascending doc_id order, into shard images saved in the shared folder.
    ``path`` is the tokenizer file, present on every executor."""
    t = F.coalesce(F.col(text), F.lit(""))
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), t.alias("text"))
            .repartitionByRange(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
            .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), "text"))

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, seq = encoder(path, end_id), TaskContext.get().partitionId(), 0
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        tokens = 0

        def flush() -> pa.RecordBatch:
            nonlocal held, tokens, seq
            ids, docs, known, sizes = (np.concatenate(x) for x in zip(*held, strict=True))
            image = build_image(ids, enc.bits, docs, known, sizes)
            row = {"part": [part], "seq": [seq], "n_docs": [len(docs)], "n_tokens": [len(ids)], "image": [image]}
            held, tokens, seq = [], 0, seq + 1
            return pa.RecordBatch.from_pydict(row, pa.schema([
                ("part", pa.int32()), ("seq", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()),
                ("image", pa.binary())]))

        for b in batches:
            ids = b.column("doc_id")
            known, docs = ~np.asarray(ids.is_null()), np.asarray(ids.fill_null(0))
            for i, j, *_ in text_pieces(b.column("text"), PIECE_BYTES):
                got, sizes = enc.encode(b.column("text").slice(i, j - i))
                pa.default_memory_pool().release_unused()      # else Arrow keeps the largest piece's share
                end = np.cumsum(sizes)
                while i < j:                      # documents up to the one that fills the shard
                    k = min(j, i + 1 + int(np.searchsorted(end, shard_tokens - tokens)))
                    n = int(end[k - i - 1])
                    held.append((got[:n], docs[i:k], known[i:k], sizes[:k - i]))
                    got, sizes, end, i, tokens = got[n:], sizes[k - i:], end[k - i:] - n, k, tokens + n
                    if tokens >= shard_tokens:
                        yield flush()
        if held:
            yield flush()

    return saved(rows.mapInArrow(job, SHARDS), "token-shards")


def read_shards(shards: DataFrame) -> DataFrame:
    """Per document, from the images: doc_id, start, n_tokens and the CRC of its ids."""
    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, seq, image in zip(b["part"].to_pylist(), b["seq"].to_pylist(), b["image"], strict=True):
                s = Shard(image.as_buffer())
                ids = s.decode().astype("<u4")
                end = np.cumsum(s.sizes.astype(np.int64))
                start = np.r_[np.int64(0), end[:-1]]
                crc = [zlib.crc32(ids[a:e]) for a, e in zip(start, end, strict=True)]
                n = len(end)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * n, pa.int32()), pa.array([seq] * n, pa.int32()),
                     pa.array(s.docs, pa.int64(), mask=~s.known), pa.array(start), pa.array(end - start),
                     pa.array(crc, pa.int64())],
                    ["part", "seq", "doc_id", "local", "n_tokens", "ids_crc32"])

    rows = shards.select("part", "seq", "image").mapInArrow(
        job, "part int, seq int, doc_id long, local long, n_tokens long, ids_crc32 long")
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)   # one row per shard
    base = shards.select("part", "seq", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))
    return rows.join(base, ["part", "seq"]).select(
        "doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")


def token_digest(docs: DataFrame, path: str) -> DataFrame:
    return read_shards(write_shards(docs, path))
