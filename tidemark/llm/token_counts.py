"""Token counts by a two-tier lookup on the map side.

A text is cut into pre-tokens where no piece of the vocabulary can span, so
the tokens of a text are those of its pre-tokens one after another.  Tier one
is a compact open-addressing table of the frequent pre-tokens' lengths,
broadcast to all workers; it holds at most ``FREQUENT`` entries of at most
``LONGEST`` bytes, so its size is bounded whatever the input.  Its misses go to
tier two, a cache in each Python worker; what that does not hold is encoded by
the tokenizer library, many at once.  No pre-token is shuffled.

Which pre-tokens are in the table is taken from about ``SAMPLE_BYTES`` of text.
That decides the cost only: each hit is compared byte by byte, each miss is
encoded, so every text's count is the library's own.

Cuts lie before a run of spaces, around a newline, and where a letter (ASCII or
U+00C0 to U+07FF) meets an ASCII sign or digit.  ``Pieces`` checks against
the vocabulary that no piece spans such a cut; where one does, whole texts are
encoded.

Defined results: null and empty texts have 0 bytes and 0 tokens.  A row is
returned for every row, repeated rows and null doc_ids included.  A special
token's string inside a text is ordinary text.  Extra columns are ignored.
"""

from __future__ import annotations

import os
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import flat
from tidemark.llm.store import text_input

VOCABULARY = "piece_bpe_32k.model"
LIMIT = 4096
#: Entries of the broadcast table, and the most bytes of one: some 3 MB in all.
FREQUENT = 65_536
LONGEST = 32
#: Text that the table is chosen from, and the longest text taken for it.
SAMPLE_BYTES = 8 << 20
SAMPLE_TEXT = 1 << 18
#: Pre-tokens that a worker keeps (some 150 bytes each) before it starts anew.
KEPT = 500_000
#: Pre-tokens of more bytes are encoded each time.
KEPT_BYTES = 64

SPACE, LETTER, SIGN, NEWLINE, ANY = range(5)
_KIND = np.full(256, SIGN, np.int8)
_KIND[flat.table_of((0x41, 0x5A), (0x61, 0x7A))] = LETTER
_KIND[0x80:] = ANY
_KIND[0x20], _KIND[0x0A] = SPACE, NEWLINE
#: First bytes of U+00C0 to U+07FF: letters, mostly.
_TWO_BYTES = flat.table_of((0xC3, 0xDF))

#: The vocabulary's own sign for a space; in a text it means the same.
_SIGN = "▁"


def cut_at(data: np.ndarray) -> np.ndarray:
    """Whether a pre-token starts at each byte."""
    kind = _KIND[data]
    first = np.flatnonzero(_TWO_BYTES[data])
    kind[first] = LETTER
    kind[first[first + 1 < len(data)] + 1] = LETTER
    cut = np.ones(len(data), bool)
    a, b = kind[:-1], kind[1:]
    cut[1:] = ((a != b) & (a != SPACE) & (b == SPACE)) | (b == NEWLINE) | (a == NEWLINE) | (
        (np.minimum(a, b) == LETTER) & (np.maximum(a, b) == SIGN))
    return cut


class Pieces:
    """The library's model, and the lengths a worker has seen."""

    def __init__(self, vocabulary: str):
        import public_tokenizers
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(
            model_file=vocabulary if os.path.isabs(vocabulary) else public_tokenizers.path(vocabulary))
        m = self.model
        spanning = any(cut_at(np.frombuffer(m.id_to_piece(i).replace(_SIGN, " ").encode(), np.uint8))[1:].any()
                       for i in range(m.get_piece_size()) if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i)))
        # the model must leave characters as they are, put one space in front, and give a newline a token of its own
        newline = m.encode("\n")
        plain = (m.encode("a  ﬁ\t　é ") == m.encode(f"a{_SIGN}{_SIGN}ﬁ\t　é{_SIGN}")
                 and m.decode(m.encode("a  ﬁ\t　é ")) == "a  ﬁ\t　é ")
        self.cuttable = not spanning and plain and len(newline) == 2 and m.id_to_piece(newline[0]) == _SIGN
        self.newline = newline[-1]
        self.seen: dict[bytes, int] = {}

    def whole(self, text: str) -> int:
        return len(self.model.encode(text))

    def encode(self, tokens: list[bytes]) -> np.ndarray:
        """Lengths of pre-tokens without a newline; they are joined by newlines, which no piece spans."""
        ids = np.array(self.model.encode(b"\n".join([b"", *tokens, b""]).decode()), np.int64)
        return np.diff(np.flatnonzero(ids == self.newline)) - 1

    def lengths(self, tokens: list[bytes]) -> np.ndarray:
        """Tier two: from the worker's cache, the rest encoded."""
        seen = self.seen
        out = np.array([seen.get(t, -1) for t in tokens], np.int64)
        new = list({tokens[i]: None for i in np.flatnonzero(out < 0)})
        if new:
            found = dict(zip(new, self.encode(new).tolist()))
            rest = out < 0
            out[rest] = [found[tokens[i]] for i in np.flatnonzero(rest)]
            if len(seen) > KEPT:
                seen.clear()
            seen.update((t, n) for t, n in found.items() if len(t) <= KEPT_BYTES)
        return out


_pieces: dict[str, Pieces] = {}


def pieces(vocabulary: str) -> Pieces:
    """One per worker process; later tasks find its cache filled."""
    if vocabulary not in _pieces:
        _pieces[vocabulary] = Pieces(vocabulary)
    return _pieces[vocabulary]


class Table:
    """Pre-token -> number of tokens, in flat arrays: an open-addressing table
    of 64-bit hashes, and the bytes for the comparison of a hit."""

    def __init__(self, tokens: list[bytes], lengths: np.ndarray):
        self.blob = np.frombuffer(b"".join(tokens), np.uint8)
        self.ends = np.cumsum([len(t) for t in tokens], dtype=np.int64)
        self.starts = self.ends - np.array([len(t) for t in tokens], np.int64)
        self.lengths = np.asarray(lengths, np.int32)
        self.hashes = flat.span_hash(flat.prefix_hash(self.blob), self.starts, self.ends)
        size = 1 << max(4, (4 * len(tokens) - 1).bit_length())
        self.slots = np.full(size, -1, np.int32)
        waiting, at = np.arange(len(tokens)), (self.hashes & np.uint64(size - 1)).astype(np.int64)
        while len(waiting):  # of those that want a free slot the last one gets it, the others go on
            free = self.slots[at] < 0
            self.slots[at[free]] = waiting[free]
            left = self.slots[at] != waiting
            waiting, at = waiting[left], (at[left] + 1) & (size - 1)

    def find(self, data: np.ndarray, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Number of tokens of each span of data, -1 where the table has none."""
        found = np.full(len(hashes), -1, np.int64)
        mask = len(self.slots) - 1
        open_, at = np.arange(len(hashes)), (hashes & np.uint64(mask)).astype(np.int64)
        while len(open_):
            entry = self.slots[at]
            some = entry >= 0
            open_, at, entry = open_[some], at[some], entry[some]
            same = self.hashes[entry] == hashes[open_]
            found[open_[same]] = entry[same]
            open_, at = open_[~same], (at[~same] + 1) & mask
        hit = np.flatnonzero(found >= 0)
        entry = found[hit]
        size = ends[hit] - starts[hit]
        equal = size == self.ends[entry] - self.starts[entry]
        hit, entry, size = hit[equal], entry[equal], size[equal]
        out = np.full(len(hashes), -1, np.int64)
        if len(hit):
            first = np.cumsum(size) - size
            inside = np.arange(int(size.sum())) - np.repeat(first, size)
            differs = data[np.repeat(starts[hit], size) + inside] != self.blob[np.repeat(self.starts[entry], size) + inside]
            equal = np.add.reduceat(differs, first) == 0
            out[hit[equal]] = self.lengths[entry[equal]]
        return out


def _blocks(data: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(start, cuts) of parts of about CHUNK_BYTES that end at a cut; a part without one grows."""
    lo, n = 0, len(data)
    while lo < n:
        size = flat.CHUNK_BYTES
        while True:
            hi = min(lo + size, n)
            cuts = np.flatnonzero(cut_at(data[lo:hi]))
            if hi == n or len(cuts) > 1:
                break
            size *= 2
        yield (lo, np.append(cuts, hi - lo)) if hi == n else (lo, cuts)
        lo += hi - lo if hi == n else int(cuts[-1])


def _spaced(column: pa.Array) -> pa.Array:
    """Texts as the model sees them: a space in front, its sign as a space; empty texts stay empty."""
    text = pc.replace_substring(pc.fill_null(column, ""), _SIGN, " ")
    empty = pc.equal(pc.binary_length(text), 0)
    return pc.if_else(empty, text, pc.binary_join_element_wise(pa.scalar(" ", text.type), text, pa.scalar("", text.type)))


def _tokens(data: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(starts, ends) of the pre-tokens, a part of data at a time."""
    for lo, cuts in _blocks(data):
        yield lo + cuts[:-1], lo + cuts[1:]


def _counted(own: Pieces, table: Table, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Number of tokens of each text of a slice."""
    total = np.zeros(len(offs) - 1, np.int64)
    firsts = offs[:-1][offs[:-1] < offs[1:]]
    for starts, ends in _tokens(data):
        # a text starts anew even where its first byte would go on with the one before
        inside = firsts[(firsts > starts[0]) & (firsts < ends[-1])]
        starts = np.union1d(starts, inside)
        ends = np.append(starts[1:], ends[-1])
        part = data[starts[0]:ends[-1]]
        a, b = starts - starts[0], ends - starts[0]
        n = table.find(part, flat.span_hash(flat.prefix_hash(part), a, b), a, b)
        n[part[a] == 0x0A] = 1
        miss = np.flatnonzero(n < 0)
        if len(miss):
            raw = part.tobytes()
            n[miss] = own.lengths([raw[i:j] for i, j in zip(a[miss].tolist(), b[miss].tolist())])
        total += np.bincount(np.searchsorted(offs, starts, "right") - 1, n, len(total)).astype(np.int64)
    return total


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(piece, n) of a task's texts of the sample."""
    seen: Counter[bytes] = Counter()
    for batch in batches:
        for _, _, data, _ in flat.text_slices(_spaced(batch.column(0))):
            raw = data.tobytes()
            for starts, ends in _tokens(data):
                short = ends - starts <= LONGEST
                seen.update(raw[i:j] for i, j in zip(starts[short].tolist(), ends[short].tolist()))
    seen.pop(b"\n", None)
    if seen:
        yield pa.RecordBatch.from_arrays([pa.array(list(seen.keys()), pa.binary()), pa.array(list(seen.values()), pa.int64())],
                                         names=["piece", "n"])


def frequent(docs: DataFrame, vocabulary: str = VOCABULARY) -> Table:
    """The table of frequent pre-tokens.  The driver gets the distinct short
    pre-tokens of the sample, so at most about SAMPLE_BYTES."""
    own = pieces(vocabulary)
    if not own.cuttable:
        return Table([], np.zeros(0))
    texts = docs.select(F.col("text").cast("string").alias("text")).where(F.octet_length("text").between(1, SAMPLE_TEXT))
    size = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    if size > SAMPLE_BYTES:
        texts = texts.where(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < int(SAMPLE_BYTES / size * (1 << 20)) + 1)
    rows = texts.mapInArrow(_sampled, "piece binary, n long").toArrow()
    seen: Counter[bytes] = Counter()
    for piece, n in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
        seen[piece] += n
    # most frequent first, equal ones by their bytes, so that reruns agree
    most = [t for t, _ in sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:FREQUENT]]
    return Table(most, own.encode(most) if most else np.zeros(0))


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row of docs."""
    docs = text_input(docs)
    table = docs.sparkSession.sparkContext.broadcast(frequent(docs, vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, known = pieces(vocabulary), table.value
        for batch in batches:
            column = batch.column(1)
            if own.cuttable:
                parts = [_counted(own, known, data, offs) for _, _, data, offs in flat.text_slices(_spaced(column))]
                counts = np.concatenate(parts) if parts else np.zeros(0, np.int64)
            else:
                counts = np.array([own.whole(t or "") for t in column.to_pylist()], np.int64)
            sizes = pc.cast(pc.fill_null(pc.binary_length(column), 0), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, pa.array(counts), pa.array(counts > limit)],
                                             names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
