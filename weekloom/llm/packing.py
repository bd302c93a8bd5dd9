"""Cost-balanced packing of tokenized documents into sequences of fixed capacity.

Each task packs the documents it reads, in groups of some million tokens: no shuffle, and memory
bounded by a group (or one document, if that is longer). A group gets as many full sequences as its tokens fill and, for
the rest, sequences of powers of two, which need no padding; so nothing is padded at all. The
attention cost of a piece is linear plus quadratic in its length. Pieces as long as a sequence take
one each; the other documents go, longest first, to the sequence of lowest cost that has room for
them. Only what no sequence has room for is cut.
"""

from __future__ import annotations

import string
import struct
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from weekloom.llm.common import word_blocks

CAPACITY, END = 4096, 2
LINEAR, QUADRATIC = 1.0, 1.0 / 2048
GROUP_TOKENS = 1024 * CAPACITY
#: Words whose ids a worker remembers; about 200 bytes each.
REMEMBERED = 250_000
_PUNCTUATION = string.punctuation.encode()
_encoders: dict[str, Encoder] = {}
#: Byte-level alphabet: printable Latin-1 bytes stand for themselves, the others for code points from 256 on.
_PRINTABLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_OTHERS = [b for b in range(256) if b not in _PRINTABLE]
_BYTE_LEVEL = {b: 256 + i for i, b in enumerate(_OTHERS)}


def _closed(head: bytes) -> bool:
    """Whether no token spans the border of ``head`` and punctuation behind it: it ends, as normalised, in a letter or number."""
    if head[-1] < 0x80:
        return head[-1:].isalnum()
    last = unicodedata.normalize("NFC", head.decode()).lower()[-1]
    return unicodedata.ucd_3_2_0.category(last)[0] in "LN"


class Encoder:
    """Token ids of whole texts, as little-endian unsigned 32-bit numbers.

    The tokenizer lower-cases and never joins tokens over white space, nor over the border of
    letters and other signs; so the ids of a text are those of its lower-cased words, one after the
    other, and of a word that has a letter or number before its closing punctuation, those of both parts. Words are looked up, and
    only new ones are tokenized.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.known: dict[bytes, bytes] = {}

    def _letters(self, part: bytes) -> bytes | None:
        """Ids of lower-cased Latin letters; they have one normal form, so the model can be asked directly."""
        if part.isalpha():
            data = part.decode()
        else:
            data = part.decode()
            if not data.isalpha() or max(data) >= "\u0250" or "\u0130" in data:
                return None
            data = data.lower().encode().decode("latin-1").translate(_BYTE_LEVEL)
        ids = [t.id for t in self.tokenizer.model.tokenize(data)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _learn(self, words: list[bytes]) -> None:
        known, letters = self.known, self._letters
        later, ends = [], []
        for word in words:
            head = word.rstrip(_PUNCTUATION)
            whole = len(head) == len(word)
            ids = known.get(head) or letters(head) if head and (whole or _closed(head)) else None
            if ids is None:
                later.append(word)
            elif whole:
                known[word] = ids
            else:
                known[head] = ids
                ends.append((word, ids, word[len(head) :]))
        later += {end for _, _, end in ends if end not in known}
        encoded = self.tokenizer.encode_batch_fast([w.decode() for w in later], add_special_tokens=False)
        for word, e in zip(later, encoded):
            known[word] = struct.pack(f"<{len(e.ids)}I", *e.ids)
        for word, ids, end in ends:
            known[word] = ids + known[end]

    def ids(self, text: bytes) -> bytes:
        out = []
        for words in word_blocks(text.lower()):
            if len(self.known) > REMEMBERED:
                self.known.clear()
            new = [w for w in set(words) if w not in self.known]
            if new:
                self._learn(new)
            out.append(b"".join(map(self.known.__getitem__, words)))
        return b"".join(out)


def encoder(path: str) -> Encoder:
    """One encoder for each worker process and vocabulary."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def cost(tokens: np.ndarray | int) -> np.ndarray | float:
    return LINEAR * tokens + QUADRATIC * tokens * tokens


def pack_group(lengths: list[int], capacity: int = CAPACITY) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Pieces (document, start, length, sequence, offset) of documents of these lengths, and how many sequences."""
    total = sum(lengths)
    rest = total % capacity
    room = [capacity] * (total // capacity) + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]
    left, load = np.array(room, np.int64), np.zeros(len(room))
    pieces, used = [], 0
    tails = []
    for doc, n in enumerate(lengths):
        for start in range(0, n - n % capacity, capacity):
            pieces.append((doc, start, capacity, used, 0))
            left[used], load[used] = 0, cost(capacity)
            used += 1
        if n % capacity:
            tails.append((-(n % capacity), doc))
    for short, doc in sorted(tails):
        n, start = -short, lengths[doc] + short
        while n:
            fits = np.where(left >= n, load, np.inf)
            best = int(fits.argmin())
            if fits[best] == np.inf:
                best = int(np.where(left > 0, load, np.inf).argmin())
            size = min(n, int(left[best]))
            pieces.append((doc, start, size, best, room[best] - int(left[best])))
            left[best] -= size
            load[best] += cost(size)
            n, start = n - size, start + size
    return pieces, len(room)


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    Every document ends with the id ``end``; null and empty texts have only that. Rows that repeat are packed as
    often; a null doc_id stays null; other columns are ignored; an empty table gives no rows. ``tokenizer``
    is the path of a vocabulary file that every executor has. ``capacity`` is a power of two.
    """
    schema = pa.schema([("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])
    last = np.array([end], "<u4").tobytes()

    def packed(names: list, texts: list[bytes], first: int) -> tuple[list[pa.RecordBatch], int]:
        sizes = [len(t) // 4 for t in texts]
        pieces, n = pack_group(sizes, capacity)
        pieces.sort(key=lambda p: (p[3], p[4]))
        docs = pa.concat_arrays(names)
        out = []
        for k in range(0, len(pieces), 1024):
            part = pieces[k : k + 1024]
            columns = [
                pa.array([p[1] for p in part], pa.int64()),
                pa.array([p[2] for p in part], pa.int64()),
                pa.array([texts[p[0]][4 * p[1] : 4 * (p[1] + p[2])] for p in part], pa.binary()),
                pa.array([sizes[p[0]] for p in part], pa.int64()),
                pa.array([first + p[3] for p in part], pa.int64()),
                pa.array([p[4] for p in part], pa.int64()),
            ]
            out.append(pa.RecordBatch.from_arrays([docs.take(pa.array([p[0] for p in part])), *columns], ["doc_id", *schema.names]))
        return out, first + n

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        names, texts, held, first = [], [], 0, TaskContext.get().partitionId() << 33
        for batch in batches:
            for i, data in enumerate(batch.column(1)):
                texts.append(encode.ids(data.as_py() or b"") + last)
                names.append(batch.column(0).slice(i, 1))
                held += len(texts[-1]) // 4
                if held >= GROUP_TOKENS:
                    out, first = packed(names, texts, first)
                    yield from out
                    names, texts, held = [], [], 0
        if texts:
            yield from packed(names, texts, first)[0]

    kind = docs.schema["doc_id"].dataType.simpleString()
    read = docs.select("doc_id", F.col("text").cast("binary").alias("data"))
    return read.mapInArrow(per_task, f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
