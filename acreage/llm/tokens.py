"""Token ids of whole texts, by a public tokenizer whose pieces never span white space."""

from __future__ import annotations

import json
import os
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as compute
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame

from acreage.llm.common import text_bytes

# Words kept per Python worker: two generations of at most this many.
CACHE_WORDS = 300_000
# Longer words are encoded each time, so that the cache has a bound in bytes.
CACHE_LENGTH = 64
END_ID = 1
# Fixed value: the pieces of tokenizers that allow encoding by words.
_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Classes of bytes: a letter or digit, a mark that is a piece of its own behind one of these, white space.
_CLASS = np.zeros(256, dtype=np.uint8)
_CLASS[[c for c in range(128) if chr(c).isalnum()]] = 1
# No apostrophe, which may begin a piece with letters.
_MARKS = b"!#$%&*.,:;?)-"
_CLASS[list(_MARKS)] = 2
_CLASS[list(b" \t\n\x0b\x0c\r")] = 4
# The second bytes of Latin-1's letters, behind 0xC3; the two that are left out are signs.
_CLASS[[c for c in range(0x80, 0xC0) if c not in (0x97, 0xB7)]] = 3
# Stands for the end of a text among words; no byte of UTF-8.
_APART = b"\xff"
_SPLIT = b" \xff "
# Texts that are encoded at a time, in bytes.
PORTION_BYTES = 1 << 18

# Letters below this are single composed characters, which composing leaves as they are.
_COMPOSED = "\u0250"
# Byte-level models write each byte as a visible character: Latin-1's own, and for the others the next from 256 on.
_SHOWN = {b for b in range(256) if chr(b).isprintable() and not chr(b).isspace()}
_BYTE_LETTERS = {b: chr(b) if b in _SHOWN else chr(256 + k - sum(x < b for x in _SHOWN)) for k, b in enumerate(range(256))}

_ENCODERS: dict[str, "WordEncoder"] = {}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Words(dict):
    """The ids of words in lower case, each learned when it is first asked for; ``turn`` forgets those long unused."""

    def __init__(self, tokenizer, code: str) -> None:
        super().__init__()
        self.tokenizer, self.tokenize, self.code, self.old = tokenizer, tokenizer.model.tokenize, code, {}

    def turn(self) -> None:
        if len(self) > CACHE_WORDS:
            self.old = dict(self)
            self.clear()

    def __missing__(self, word: bytes) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = self._learned(word)
        if len(word) <= CACHE_LENGTH:
            self[word] = ids
        return ids

    def _learned(self, word: bytes) -> bytes:
        if word.isalpha():
            # letters alone are one piece: straight to the merges
            mapped = word.decode()
        else:
            stem = word.rstrip(_MARKS)
            if stem is not word and stem[-1:].isalnum():
                # marks behind a letter or digit are pieces of their own
                return self[stem] + self[word[len(stem) :]]
            text = word.decode("utf-8", "replace")
            low = text.lower()
            if not low.isalpha() or max(low) >= _COMPOSED:
                return array(self.code, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
            # the normaliser only lower-cases such letters
            mapped = low.encode().decode("latin-1").translate(_BYTE_LETTERS)
        return array(self.code, [t.id for t in self.tokenize(mapped)]).tobytes()


class WordEncoder:
    """Encodes texts, word by word with a cache where the tokenizer allows it.

    A tokenizer that drops white space and joins no characters across it gives a text the ids of its words (split
    at ASCII white space) in order. Others encode whole texts. Ids are little-endian, two bytes each if all fit.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = id_type(self.tokenizer.get_vocab_size())
        self.code = "H" if self.dtype == "<u2" else "I"
        self.by_words = _drops_spaces(json.loads(self.tokenizer.to_str()))
        self.end = np.array([END_ID], dtype=self.dtype).tobytes()
        # in lower case, as the texts they are looked for in
        self.special = [t.content.lower().encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.words = Words(self.tokenizer, self.code)

    @classmethod
    def at(cls, path: str) -> "WordEncoder":
        """The worker's encoder for the file: tasks that follow one another share the cache."""
        if path not in _ENCODERS:
            _ENCODERS[path] = cls(path)
        return _ENCODERS[path]

    def encode(self, text: bytes) -> bytes:
        """The ids of one text, without an end id."""
        # the tokenizer lower-cases letters, but finds special tokens before that
        low = text.lower()
        if not self.by_words or any(s in low for s in self.special):
            whole = self.tokenizer.encode(text.decode("utf-8", "replace"), add_special_tokens=False)
            return array(self.code, whole.ids).tobytes()
        return b"".join(map(self.words.__getitem__, with_marks_apart(low).split()))

    def encode_all(self, texts: list[bytes]) -> list[bytes]:
        """The ids of texts, each with the end id."""
        low, get = _SPLIT.join(texts).lower(), self.words.__getitem__
        self.words.turn()
        if not self.by_words or low.count(_APART) >= len(texts) or any(s in low for s in self.special):
            return [self.encode(t) + self.end for t in texts]
        return [b"".join(map(get, own.split())) + self.end for own in with_marks_apart(low).split(_APART)]


def with_marks_apart(text: bytes) -> bytes:
    """A space put before every single mark that stands between a letter or digit and white space or the end.

    Such a mark is a piece of its own, so "word," has the ids of "word" and of ",". Letters are those of ASCII and, as two
    bytes, of Latin-1.
    """
    raw = np.frombuffer(text + b" ", dtype=np.uint8)
    kinds = _CLASS[raw]
    at = np.flatnonzero((kinds[1:-1] == 2) & (kinds[2:] == 4)) + 1
    before = kinds[at - 1]
    at = at[(before == 1) | ((before == 3) & (raw[np.maximum(at, 2) - 2] == 0xC3) & (at > 1))]
    if not len(at):
        return text
    places = at + np.arange(len(at))
    out = np.empty(len(text) + len(at), dtype=np.uint8)
    kept = np.ones(len(out), dtype=bool)
    kept[places] = False
    out[places], out[kept] = 32, raw[:-1]
    return out.tobytes()


def _drops_spaces(config: dict) -> bool:
    """Whether the tokenizer is of the kind whose pieces are letters, digits or marks and never white space."""
    splits = (config.get("pre_tokenizer") or {}).get("pretokenizers") or [{}, {}]
    steps = [n.get("type") for n in (config.get("normalizer") or {}).get("normalizers") or []]
    return (
        steps == ["NFC", "Replace", "Lowercase"]
        and [x.get("type") for x in splits] == ["Split", "ByteLevel"]
        and splits[0]["pattern"].get("Regex") == _PIECES
        and (splits[0]["behavior"], splits[0]["invert"]) == ("Removed", True)
        and not splits[1]["add_prefix_space"]
        and config.get("post_processor") is None
    )


def id_type(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def id_width(path: str) -> int:
    return np.dtype(WordEncoder.at(path).dtype).itemsize


def _portions(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """Batches of a bounded number of bytes; a longer text is one by itself."""
    for batch in batches:
        first = size = 0
        for k, n in enumerate(compute.binary_length(batch.column(column)).to_pylist()):
            if size and size + n > PORTION_BYTES:
                yield batch.slice(first, k - first)
                first, size = k, 0
            size += n
        if batch.num_rows:
            yield batch.slice(first)


def tokenized(docs: DataFrame, path: str, *columns: tuple[str, Column], queue: str | None = None) -> DataFrame:
    """``columns`` beside ``ids`` (with the end id) and ``n``, their number.

    ``part`` is the task that made the row. With ``queue``, one of the columns, ``before`` is the number of tokens in
    earlier rows of this task with an equal value there.
    """
    names = [n for n, _ in columns]
    narrow = docs.select(*(c.alias(n) for n, c in columns), text_bytes().alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema if f.name != "_text")
    at = names.index(queue) if queue else None

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder.at(path)
        width = np.dtype(encoder.dtype).itemsize
        part, sums = TaskContext.get().partitionId(), {}
        for batch in _portions(batches, len(names)):
            ids = encoder.encode_all(batch.column(len(names)).to_pylist())
            counts = np.array([len(x) // width for x in ids], dtype=np.int64)
            kept = [batch.column(k) for k in range(len(names))]
            made = {"part": pa.array(np.full(len(ids), part, dtype=np.int32)), "n": pa.array(counts)}
            if at is not None:
                before = []
                for key, n in zip(batch.column(at).to_pylist(), counts.tolist()):
                    before.append(sums.get(key, 0))
                    sums[key] = before[-1] + n
                made["before"] = pa.array(before, pa.int64())
            made["ids"] = pa.array(ids, pa.binary())
            yield pa.RecordBatch.from_arrays([*kept, *made.values()], names=[*names, *made])

    more = "part int, n bigint, " + ("before bigint, " if queue else "") + "ids binary"
    return narrow.mapInArrow(encode, f"{schema}, {more}")


def encoded_table(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder, its ids compressed, and read back."""
    from acreage.session import fresh_folder

    path = fresh_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

