"""Byte-pair encoding and decoding of whole texts with a published vocabulary.

The vocabulary is a tokenizer file with byte-level BPE (``byte_bpe_50k.json``); its path is a
parameter (by default that of the installed public files), the driver reads it and broadcasts its content, whose size is fixed by the file.

Method: a short word is held as a contiguous array of parts (one id from each part boundary on)
next to the array of the ranks of adjacent parts. The minimum of the ranks is scanned for, the
boundary behind it deleted and the two neighbouring ranks refreshed until no rank is left. Words
beyond ``SHORT`` bytes would make that quadratic; they take the same merges from a heap. Words
seen before come from a cache of bounded size.

Cases: a null text counts as empty and has no ids and an empty decoded text; the strings of
special tokens inside a text become their single id, as the public library does by default;
lone ids of a vocabulary that does not hold them decode to nothing. Rows repeat as they are.
"""

import heapq
import json
import re

import numpy as np
import pyarrow as pa
import regex

from panelloom.llm.common import list_array, map_batches, slices, texts_of, vocabulary

VOCABULARY = "byte_bpe_50k.json"
NONE = 1 << 30
SHORT = 256
CACHED = 250_000

# fixed values: the word pattern that the vocabulary was made with
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# fixed values: code points that the public library's Unicode tables do not have as letters or digits
NEWER = ("\u0558\u058b-\u058c\u088f\u0c5c\u0cdc\u208f\u209d\ua7ce-\ua7cf\ua7d2\ua7d4\ua7dd\ua7e2\ua7f1\uab6c-\uab6d"
         "\U000107bb-\U000107bf\U00010940-\U00010959\U00010ec5-\U00010ec7\U00010ed9-\U00010eee\U00011b0a"
         "\U00011db0-\U00011ddb\U00011de0-\U00011de9\U00011df1\U0001246f\U00012475-\U0001247f\U00012550-\U00012686"
         "\U00016ea0-\U00016eb8\U00016ebb-\U00016ed3\U00016ff2-\U00016ff6\U000187f8-\U000187ff\U00018cd6-\U00018cda"
         "\U00018d09-\U00018d20\U00018d80-\U00018df2\U00018e00-\U00019191\U000191a0-\U000191d2\U0001b123-\U0001b128"
         "\U0001b168\U0001d6a6\U0001df1f-\U0001df24\U0001df2b-\U0001df81\U0001df90-\U0001df96\U0001dfcd-\U0001dfff"
         "\U0001e6c0-\U0001e6de\U0001e6e0-\U0001e6e2\U0001e6e4-\U0001e6e5\U0001e6e7-\U0001e6ed\U0001e6f0-\U0001e6f4"
         "\U0001e6fe-\U0001e6ff\U0002b73a-\U0002b73f\U0002b81e\U0002cea2-\U0002cead\U000323b0-\U00033479\U0003d000-\U0003fc3f")
ASCII_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"


def byte_alphabet():
    """The printable character that stands for each byte in vocabulary files."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


class Words(dict):
    """Word to packed ids; two generations bound the memory, the older one is asked first."""

    def __init__(self, encode, limit=CACHED):
        self.encode, self.limit, self.older = encode, limit, {}

    def __missing__(self, word):
        got = self.older.get(word)
        if got is None:
            got = np.array(self.encode(word), dtype="<i4").tobytes()
        if len(word) <= 64:
            self[word] = got
        return got

    def settle(self):
        if len(self) > self.limit:
            self.older = dict(self)
            self.clear()


class Merges:
    """Ranked merges over ids: ``rank`` by pair, ``made`` by rank."""

    def __init__(self, vocab, merges):
        self.rank, self.made = {}, []
        for at, pair in enumerate(merges):
            left, right = pair if isinstance(pair, (list, tuple)) else pair.split(" ")
            self.rank.setdefault(vocab[left] << 20 | vocab[right], at)
            self.made.append(vocab[left + right])

    def merge(self, parts):
        """The parts of one word, merged to the end."""
        return self._scan(parts) if len(parts) <= SHORT else self._heap(parts)

    def _scan(self, parts):
        rank, made = self.rank.get, self.made
        ranks = [rank(a << 20 | b, NONE) for a, b in zip(parts, parts[1:])]
        while ranks:
            best = min(ranks)
            if best == NONE:
                break
            at = ranks.index(best)
            parts[at] = made[best]
            del parts[at + 1], ranks[at]
            if at < len(ranks):
                ranks[at] = rank(parts[at] << 20 | parts[at + 1], NONE)
            if at:
                ranks[at - 1] = rank(parts[at - 1] << 20 | parts[at], NONE)
        return parts

    def _heap(self, parts):
        """Same merges in the same order for long words, in n log n."""
        rank, n = self.rank.get, len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = []

        def push(i):
            j = after[i]
            if j < n:
                r = rank(parts[i] << 20 | parts[j])
                if r is not None:
                    queue.append((r, i, parts[i], parts[j]))
                    return True
            return False

        for i in range(n - 1):
            push(i)
        heapq.heapify(queue)
        while queue:
            r, i, left, right = heapq.heappop(queue)
            j = after[i] if parts[i] == left else n
            if j >= n or parts[j] != right:
                continue
            parts[i], parts[j] = self.made[r], -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for k in (i, before[i]):
                if k >= 0 and push(k):
                    heapq.heappush(queue, queue.pop())
        return [x for x in parts if x >= 0]


class ByteBpe:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, content):
        spec = json.loads(content)
        vocab = spec["model"]["vocab"]
        alphabet = byte_alphabet()
        self.byte_ids = [vocab[c] for c in alphabet]
        self.merges = Merges(vocab, spec["model"]["merges"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        longest = sorted(self.special, key=len, reverse=True)
        self.splitter = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None
        self.find_ascii, self.find_any = re.compile(ASCII_PATTERN, re.A).findall, regex.compile(PATTERN).findall
        self.newer = re.compile(f"[{NEWER}]").search
        # newer code points count as neither letters nor digits
        self.find_newer = regex.compile(
            PATTERN.replace(r"[^\s\p{L}\p{N}]", rf"(?:[^\s\p{{L}}\p{{N}}]|[{NEWER}])")
            .replace(r"\p{L}+", rf"(?:(?![{NEWER}])\p{{L}})+").replace(r"\p{N}+", rf"(?:(?![{NEWER}])\p{{N}})+")).findall
        byte_of = {c: b for b, c in enumerate(alphabet)}
        self.bytes_of = {i: bytes(map(byte_of.__getitem__, token)) for token, i in vocab.items()}
        self.bytes_of |= {i: token.encode() for token, i in self.special.items()}
        self.words = Words(self._word)

    def _word(self, word):
        return self.merges.merge([self.byte_ids[b] for b in word.encode("utf-8", "replace")])

    def encode(self, text):
        """Ids of a whole text, packed as little-endian 32-bit integers."""
        if self.splitter and any(token in text for token in self.special):
            return b"".join(
                np.int32(self.special[piece]).tobytes() if piece in self.special else self._plain(piece)
                for piece in self.splitter.split(text))
        return self._plain(text)

    def _plain(self, text):
        if text.isascii():
            words = self.find_ascii(text)
        else:
            words = (self.find_newer if self.newer(text) else self.find_any)(text)
        return b"".join(map(self.words.__getitem__, words))

    def decode(self, ids):
        """Text of ids; broken byte sequences become the replacement character."""
        try:
            data = b"".join(map(self.bytes_of.__getitem__, ids))
        except KeyError:
            data = b"".join(self.bytes_of.get(i, b"") for i in ids)
        return data.decode("utf-8", "replace")


_LOADED = {}


def loaded(content):
    """The vocabulary in this process, kept across the tasks of a worker."""
    key = (len(content), hash(content))
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = ByteBpe(content)
    return _LOADED[key]


def _read(spark, path):
    with open(path or vocabulary(VOCABULARY), "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def _encoded(batches, content):
    bpe = loaded(content)
    for batch in slices(batches):
        packed = [bpe.encode(t) for t in texts_of(batch.column(batch.num_columns - 1))]
        bpe.words.settle()
        ids = list_array(np.frombuffer(b"".join(packed), "<i4"), [len(p) // 4 for p in packed], pa.int32())
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], ids], [*batch.schema.names[:-1], "ids"])


def _decoded(batches, content):
    bpe = loaded(content)
    for batch in slices(batches):
        texts = []
        for ids in batch.column(batch.num_columns - 1):
            texts.append(bpe.decode(ids.values.to_numpy().tolist()) if ids.is_valid else "")
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "decoded"])


def _keys(df, last, keys):
    return df.select(*[f"`{k}`" for k in keys], f"`{last}`")


def _kinds(df, keys):
    return "".join(f"`{k}` {df.schema[k].dataType.simpleString()}, " for k in keys)


def encode(df, text="text", keys=("doc_id",), path=None):
    """``keys`` and ``ids`` (array of int), one row per row of ``df``."""
    content = _read(df.sparkSession, path)
    return map_batches(_keys(df, text, keys), lambda it: _encoded(it, content.value),
                       _kinds(df, keys) + "ids array<int>")


def decode(df, ids="ids", keys=("doc_id",), path=None):
    """``keys``, the ids and ``decoded``, one row per row of ``df``; null ids give an empty text."""
    content = _read(df.sparkSession, path)
    return map_batches(_keys(df, ids, keys), lambda it: _decoded(it, content.value),
                       _kinds(df, keys) + f"`{ids}` array<int>, decoded string")


def encode_decode(df, text="text", keys=("doc_id",), path=None):
    """Encode, then decode what was encoded, in one pass through the workers."""
    content = _read(df.sparkSession, path)
    return map_batches(_keys(df, text, keys),
                       lambda it: _decoded(_encoded(it, content.value), content.value),
                       _kinds(df, keys) + "ids array<int>, decoded string")
