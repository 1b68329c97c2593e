"""Byte-level BPE over Arrow batches: encoding by the tokenizers library, decoding by the inverse byte table."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from matchloom.llm.shared import only, slices, text_bytes

#: Kinds of bytes. A byte that is of no kind is left to the tokenizer's own pattern, with what stands about it.
_SPACE, _BREAK, _LETTER, _DIGIT, _MARK, _QUOTE = range(1, 7)
_KINDS = np.zeros(256, np.uint8)
_KINDS[0x21:0x7F] = _MARK
_KINDS[[*b"0123456789"]] = _DIGIT
_KINDS[[*b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"]] = _LETTER
_KINDS[[*b" \n'"]] = _SPACE, _BREAK, _QUOTE
#: A space before a character that every engine takes for no white space: pieces never reach across it from the left.
_WORD = re.compile(" [^\\s\x85\u180e\u200b\ufeff]")
#: The others of U+0080 and more, in UTF-8: those of two bytes and of three, as numbers.
_WHITE = [[int.from_bytes(c.encode()) for c in map(chr, span) if not _WORD.match(" " + c)] for span in (range(0x80, 0x800), [*range(0x800, 0xD800), *range(0xE000, 0x10000)])]
#: Bytes of text that are encoded at once: each different piece of them is looked up once.
SLICE = 8 << 20


def byte_table() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: printable Latin-1 for itself, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    chars = {b: chr(b) for b in plain}
    return [chars[b] if b in chars else chr(next(rest)) for b in range(256)]


def _kinds(raw: np.ndarray) -> np.ndarray:
    """The kind of each byte of UTF-8. Both bytes of U+00C0 to U+017F and U+0400 to U+047F are letters, the signs U+00D7 and U+00F7 apart."""
    kinds = _KINDS[raw]
    high = np.flatnonzero(raw >= 0x80)
    lead = raw[high]
    high = high[((lead >= 0xC3) & (lead <= 0xC5)) | (lead == 0xD0) | (lead == 0xD1)]
    high = high[(raw[high] != 0xC3) | ((raw[high + 1] != 0x97) & (raw[high + 1] != 0xB7))]
    kinds[high] = kinds[high + 1] = _LETTER
    return kinds


def _starts(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Places where the splitting pattern of byte-level BPE surely begins a piece: where letters, digits and marks follow one another or a line
    ends or begins, and at the last white space before one of them, or a space before any character that shows. Not after a quote, which may begin a contraction, and not between marks."""
    kinds = _kinds(raw)
    left, right, here = kinds[:-1], kinds[1:], np.ones(len(raw), bool)
    shown = right >= _LETTER
    here[1:] = (left != right) & (left >= _LETTER) & (left != _QUOTE) & (right >= _BREAK) & ~((left == _MARK) & (right == _QUOTE)) | (left == _BREAK) & shown
    before = ((left == _SPACE) | (left == _BREAK)) & shown
    at = np.flatnonzero((left == _SPACE) & (raw[1:] >= 0x80))
    two = raw[at + 1].astype(np.int64) << 8 | raw[at + 2]
    before[at[~np.isin(two, _WHITE[0]) & ~np.isin(two << 8 | raw[np.minimum(at + 3, len(raw) - 1)], _WHITE[1])]] = True
    first = offsets[:-1][offsets[:-1] < len(raw)]
    before[first[first > 0] - 1] = False  # white space that ends a text has nothing after it
    here[:-1] |= before
    here[first] = True
    return np.flatnonzero(here)


class ByteBpe:
    """A vocabulary file of the tokenizers library. Encodes each different piece of a worker once and keeps its ids, in two generations.

    Texts are cut where a piece of the splitting pattern surely begins, so the ids of what lies between in turn are the ids of the text.
    Of that, what is letters, digits or marks throughout, with or without a space before it, is one piece and needs the merges alone; the
    rest takes the tokenizer's own pattern. What is kept is bounded by bytes: a generation ends at ``keep`` bytes, as counted by ``ENTRY``,
    and pieces of more than ``LONG`` bytes (texts without spaces, base64) are never kept.
    """

    #: Bytes that an entry takes besides its letters and ids, the most bytes of a piece that is kept, and the pieces of a call.
    ENTRY, LONG, CALL = 160, 48, 4000

    def __init__(self, path: str, keep: int = 64 << 20):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.tokenizer = Tokenizer.from_file(path)
        self.merger = Tokenizer(self.tokenizer.model)  # the merges alone
        self.merger.pre_tokenizer = WhitespaceSplit()
        self.table = byte_table()
        self.table[10] = " "  # between words, none of which has a line end
        self.tokenizer.encode_special_tokens = True
        self.keep, self.held = keep, 0
        self.spaced: dict[bytes, bytes] = {}  # pieces, most of them words with the space before them
        self.older: dict[bytes, bytes] = {}
        back = {c: b for b, c in enumerate(byte_table())}
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        added = {i: t.content for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.pieces = [added[i].encode() if i in added else bytes(back[c] for c in self.tokenizer.id_to_token(i) or "") for i in range(size)]
        self.digits = [str(i) for i in range(size)]

    def _parted(self, tokenizer, text: str, words: list[bytes]) -> list[bytes]:
        """The ids of a text of many words, cut where the bytes of the words end."""
        ids = np.asarray(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")
        ends = (4 * np.searchsorted(np.cumsum(self.lengths[ids]), np.cumsum([len(w) for w in words])) + 4).tolist()
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]

    def _merged(self, words: list[bytes]) -> list[bytes]:
        """Words that are one piece each."""
        return self._parted(self.merger, b"\n".join(words).decode("latin-1").translate(self.table), words)

    def _split(self, words: list[bytes]) -> list[bytes]:
        """Words that the pattern may split: those with a space before them as one text, each of the others as a text."""
        joined = [w for w in words if _WORD.match(w.decode())]
        found = dict(zip(joined, self._parted(self.tokenizer, b"".join(joined).decode(), joined), strict=True)) if joined else {}
        alone = [w for w in words if w not in found]
        ids = self.tokenizer.encode_batch_fast([w.decode() for w in alone], add_special_tokens=False)
        found.update((w, np.asarray(f.ids, dtype="<u4").tobytes()) for w, f in zip(alone, ids, strict=True))
        return [found[w] for w in words]

    def _keep(self, words: list[bytes], found: list[bytes]) -> None:
        self.spaced.update(zip(words, found, strict=True))
        self.held += sum(map(len, words)) + sum(map(len, found)) + len(words) * self.ENTRY
        if self.held > self.keep:  # pieces of the last generation stay at hand, and come over when they are met again
            self.older, self.spaced, self.held = self.spaced, {}, 0

    def _ids(self, words: pa.LargeBinaryArray) -> list[bytes]:
        """The ids of different words."""
        raw, offsets = text_bytes(words)
        letters, ends = raw.tobytes(), offsets.tolist()
        names = [letters[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
        found = list(map(self.spaced.get, names))
        new = [i for i, x in enumerate(found) if x is None]
        again = [i for i in new if names[i] in self.older]
        for i in again:
            found[i] = self.older[names[i]]
        for at in range(0, len(again), self.CALL):
            some = again[at : at + self.CALL]
            self._keep([names[i] for i in some], [found[i] for i in some])
        kinds = _kinds(raw)
        mixed = (kinds < _LETTER) | (kinds == _QUOTE)
        mixed[offsets[:-1]] &= kinds[offsets[:-1]] != _SPACE
        one = np.add.reduceat(mixed, offsets[:-1], dtype=np.int64) == 0
        new = np.array([i for i in new if found[i] is None], dtype=np.int64)
        large = np.diff(offsets)[new] > self.LONG
        for i in new[large].tolist():  # one after the other: a call's memory follows the longest word, not their number
            found[i] = (self._merged if one[i] else self._split)([names[i]])[0]
        for encode, which in ((self._merged, one[new]), (self._split, ~one[new])):
            some = new[which & ~large].tolist()
            for at in range(0, len(some), self.CALL):
                part = [names[i] for i in some[at : at + self.CALL]]
                ids = encode(part)
                for i, x in zip(some[at : at + self.CALL], ids, strict=True):
                    found[i] = x
                self._keep(part, ids)
        return found

    def encode_column(self, texts: pa.Array) -> pa.LargeBinaryArray:
        """The ids of each text (null: empty) as little-endian unsigned 32-bit numbers. Each different piece of all texts is looked up once."""
        texts.validate(full=True)  # UTF-8 throughout
        raw, offsets = text_bytes(texts)
        if not len(raw):
            return pa.array([b""] * len(texts), pa.large_binary())
        starts = _starts(raw, offsets)
        pieces = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(np.append(starts, len(raw))), pa.py_buffer(raw)])
        numbered = pieces.dictionary_encode()
        ids = pa.array(self._ids(numbered.dictionary), pa.large_binary()).take(numbered.indices)
        ends = np.frombuffer(ids.buffers()[1], dtype=np.int64)[ids.offset : ids.offset + len(ids) + 1]
        return pa.Array.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(ends[np.searchsorted(starts, offsets)]), ids.buffers()[2]])

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        return self.encode_column(pa.array(texts, pa.large_string())).to_pylist()

    def offsets(self, ids: bytes) -> np.ndarray:
        """Where each token's bytes end in the UTF-8 bytes of the text; tokens may end inside a character."""
        return np.cumsum(self.lengths[np.frombuffer(ids, dtype="<u4")])

    @property
    def lengths(self) -> np.ndarray:
        if not hasattr(self, "_lengths"):
            self._lengths = np.array([len(x) for x in self.pieces], dtype=np.int64)
        return self._lengths

    def decode(self, ids: bytes) -> bytes:
        """The bytes of the text; characters split over tokens come together again because bytes, not characters, are joined."""
        return b"".join(map(self.pieces.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


_loaded: dict[str, ByteBpe] = {}


def load(path: str) -> ByteBpe:
    """One tokenizer for each Python worker and file."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _loaded:
        _loaded[path] = ByteBpe(path)
    return _loaded[path]


def encode_documents(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, ids (array of int) and ends (array of long: where each token ends in the UTF-8 bytes).

    Null or empty texts have no ids. Long texts are taken whole, in a batch of their own; repeated rows stay repeated; an empty table gives
    an empty result. Other columns, whatever their names, are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(vocabulary)
        for batch in slices(batches, limit=SLICE):
            found = bpe.encode_column(batch.column(1)).to_pylist()
            counts = np.cumsum([0, *[len(x) // 4 for x in found]]).astype(np.int32)
            ids = np.frombuffer(b"".join(found), dtype="<i4")
            ends = np.concatenate([bpe.offsets(x) for x in found]) if found else np.zeros(0, np.int64)
            arrays = [pa.ListArray.from_arrays(pa.array(counts), pa.array(x)) for x in (ids, ends.astype(np.int64))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["doc_id", "ids", "ends"])

    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("ends", T.ArrayType(T.LongType()))])
    return only(docs, doc_id="long", text="string").mapInArrow(run, schema)


def decode_documents(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id and raw (binary) from doc_id and ids. Null ids: empty; repeated rows stay repeated; an empty table gives an empty result."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(vocabulary)
        for batch in slices(batches, column="ids", limit=SLICE):
            raw = [bpe.decode(np.asarray(x or [], dtype="<u4").tobytes()) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], names=["doc_id", "raw"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, raw binary")


def digest_documents(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Encodes and decodes in one pass over the texts, and keeps digests only: doc_id, n_tokens, ids_sha256, decoded_sha256, ends_crc32.

    The last is of the offsets: where each token ends in the bytes of the text, as little-endian unsigned 32-bit numbers.

    Null and empty texts have no tokens; their digests are those of the empty string. Repeated rows stay repeated. Texts of any length are
    taken whole: batches are cut at ``SLICE`` bytes, and only a single longer text makes a larger one. An empty table gives an empty result.
    Other columns, whatever their names, are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(vocabulary)
        digits, pieces = bpe.digits.__getitem__, bpe.pieces.__getitem__
        for batch in slices(batches, limit=SLICE):
            counts, of_ids, of_bytes, of_ends = [], [], [], []
            for raw in bpe.encode_column(batch.column(1)).to_pylist():
                ids = np.frombuffer(raw, dtype="<u4").tolist()
                counts.append(len(ids))
                of_ends.append(zlib.crc32(bpe.offsets(raw).astype("<u4").tobytes()))
                of_ids.append(hashlib.sha256(" ".join(map(digits, ids)).encode()).hexdigest())
                of_bytes.append(hashlib.sha256(b"".join(map(pieces, ids))).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(of_ids), pa.array(of_bytes), pa.array(of_ends, pa.int64())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ends_crc32"])

    return only(docs, doc_id="long", text="string").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, ends_crc32 long")


def op4_byte_bpe(spark, sf_dir: str) -> DataFrame:
    """The query: every document encoded, with offsets, and decoded."""
    import public_tokenizers

    return digest_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))
