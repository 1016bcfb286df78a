"""Token ids in Arrow files of fixed-size-list batches.

Documents are range-partitioned and sorted by doc_id; each task encodes its
run of documents and writes one shard: ``tokens-*.arrow``, an Arrow file whose
record batches hold sequences of ``SEQUENCE`` ids and their masks as
fixed-size lists (one buffer each, so any sequence is a zero-copy slice at a
known place), and ``docs-*.arrow``, each document's place in the shard.  A
shard's documents follow one another without gaps; the last sequence is filled
up with id 0 and mask 0.  File names hold the task attempt, and the manifest
names the files of the attempt that counted, so a retried or speculative task
cannot damage a shard.

Encoding is done by the tokenizer library.  A pre-token never spans a space
that stands between two other characters, so a text is cut at its spaces and
each different piece is encoded once per worker; a text with a space inside or
at the end of a longer run of white space is encoded whole.

Rows of one doc_id, or without one, are ordered by their text's length, hash and text
and may fill several shards.

Defined results: null and empty texts are the end id alone.  Repeated rows are
written each.  Null doc_ids come first.  A special token's string inside a
text is ordinary text.  Extra columns are ignored; an empty table gives no
shard.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import flat
from tidemark.llm.store import stored, text_input
from tidemark.session import scratch_path

SEQUENCE = 2048
BATCH_SEQUENCES = 64
VOCABULARY = "byte_bpe_50k.json"
END_ID = 0
#: Different pieces a worker keeps (some 200 bytes each) before it starts anew.
KEPT_PIECES = 1_000_000
#: New pieces joined to one text for the tokenizer.
JOINED = 256

#: A space next to white space (or the text's edge) on both sides.
_INNER_SPACE = re.compile(r" (?!\S)(?<=\s )")


class Encoder(dict):
    """Piece -> row of a table of encoded pieces; unknown pieces wait for flush()."""

    def __init__(self, vocabulary: str):
        import public_tokenizers
        from tokenizers import Tokenizer
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        path = vocabulary if os.path.isabs(vocabulary) else public_tokenizers.path(vocabulary)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        vocab = self.tokenizer.get_vocab(with_added_tokens=False)
        self.dtype = np.uint16 if max(vocab.values()) < 1 << 16 else np.uint32
        # a byte-level token's string has one character per byte of text
        self.width = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, i in vocab.items():
            self.width[i] = len(token)
        self.restart()

    def restart(self) -> None:
        self.clear()
        self.ids = np.array([END_ID], self.dtype)
        self.lengths = np.array([1], np.int64)
        self.waiting: list[str] = []
        self.rows = 1  # row 0: the end id

    def add(self, text: str) -> int:
        self.waiting.append(text)
        self.rows += 1
        return self.rows - 1

    def __missing__(self, piece: str) -> int:
        row = self[piece] = self.add(" " + piece)
        return row

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def flush(self) -> None:
        """Encode what waits.  Pieces of a space and a word are joined to long
        texts, whose ids are dealt back by their widths in bytes."""
        if not self.waiting:
            return
        plain = [len(t) > 1 and t[0] == " " and not t[1].isspace() and " " not in t[1:] for t in self.waiting]
        joined = [t for t, p in zip(self.waiting, plain) if p]
        ids, lengths = [self.ids], np.zeros(len(plain), np.int64)
        parts: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        for at in range(0, len(joined), JOINED):
            own = joined[at:at + JOINED]
            got = np.array(self._ids(["".join(own)])[0], np.int64)
            ends = np.cumsum([len(t.encode()) for t in own])
            sizes.append(np.diff(np.searchsorted(np.cumsum(self.width[got]), ends, "right"), prepend=0))
            parts.append(got)
        alone = self._ids([t for t, p in zip(self.waiting, plain) if not p])
        mask = np.array(plain, bool)
        lengths[mask] = np.concatenate(sizes) if sizes else 0
        lengths[~mask] = [len(g) for g in alone]
        # the table is in the order of waiting: runs from `parts` and `alone` interleave
        every = np.concatenate([*parts, np.fromiter((i for g in alone for i in g), np.int64)])
        taken = np.where(mask, np.cumsum(np.where(mask, lengths, 0)), 0) - np.where(mask, lengths, 0)
        n_joined = int(lengths[mask].sum())
        taken[~mask] = n_joined + np.cumsum(lengths[~mask]) - lengths[~mask]
        ends = np.cumsum(lengths)
        ids.append(every[np.repeat(taken - (ends - lengths), lengths) + np.arange(ends[-1])].astype(self.dtype))
        self.ids = np.concatenate(ids)
        self.lengths = np.concatenate([self.lengths, lengths])
        self.waiting = []

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and each text's number of ids with the end id."""
        if self.rows > KEPT_PIECES:
            self.restart()
        rows: list[int] = []
        counts = np.empty(len(texts), np.int64)
        look = self.__getitem__
        for i, text in enumerate(texts):
            before = len(rows)
            if text:
                if _INNER_SPACE.search(text):
                    rows.append(self.add(text))
                else:
                    first, *rest = text.split(" ")
                    rows.append(self.add(first))
                    rows.extend(map(look, rest))
            rows.append(0)
            counts[i] = len(rows) - before
        self.flush()
        at = np.array(rows, np.int64)
        size = self.lengths[at]
        begin = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])[at]
        ends = np.cumsum(size)
        ids = self.ids[np.repeat(begin - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        return ids, np.diff(bounds)


_encoders: dict[str, Encoder] = {}


def encoder(vocabulary: str) -> Encoder:
    """One per worker process; later tasks find its pieces encoded."""
    if vocabulary not in _encoders:
        _encoders[vocabulary] = Encoder(vocabulary)
    return _encoders[vocabulary]


def _schema(dtype) -> pa.Schema:
    return pa.schema([("ids", pa.list_(pa.from_numpy_dtype(dtype), SEQUENCE)), ("mask", pa.list_(pa.bool_(), SEQUENCE))])


_DOCS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


def _file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pafs.LocalFileSystem(), uri)


class _Shard:
    """One shard being written; holds less than a batch of ids."""

    def __init__(self, folder: str, name: str, dtype):
        fs, path = _file_system(folder)
        fs.create_dir(path, recursive=True)
        self.schema, self.dtype = _schema(dtype), dtype
        self.files = [fs.open_output_stream(f"{path}/{kind}-{name}.arrow") for kind in ("tokens", "docs")]
        self.tokens = pa.ipc.new_file(self.files[0], self.schema)
        self.docs = pa.ipc.new_file(self.files[1], _DOCS)
        self.held: list[np.ndarray] = []
        self.n_held = self.n_tokens = self.n_docs = 0

    def write(self, doc_ids: pa.Array, ids: np.ndarray, counts: np.ndarray) -> None:
        starts = self.n_tokens + np.cumsum(counts) - counts
        self.docs.write_batch(pa.RecordBatch.from_arrays([doc_ids, pa.array(starts), pa.array(counts)], schema=_DOCS))
        self.n_tokens += len(ids)
        self.n_docs += len(counts)
        self.held.append(ids)
        self.n_held += len(ids)
        block = SEQUENCE * BATCH_SEQUENCES
        if self.n_held >= block:
            every = np.concatenate(self.held)
            whole = len(every) // block * block
            for at in range(0, whole, block):
                self._batch(every[at:at + block], block)
            self.held, self.n_held = [every[whole:]], len(every) - whole

    def _batch(self, ids: np.ndarray, n: int) -> None:
        filled = np.full(-(-n // SEQUENCE) * SEQUENCE, END_ID, self.dtype)
        filled[:n] = ids
        mask = pa.array(np.arange(len(filled)) < n)
        self.tokens.write_batch(pa.RecordBatch.from_arrays(
            [pa.FixedSizeListArray.from_arrays(pa.array(filled), SEQUENCE),
             pa.FixedSizeListArray.from_arrays(mask, SEQUENCE)], schema=self.schema))

    def close(self) -> None:
        if self.n_held:
            self._batch(np.concatenate(self.held), self.n_held)
        for x in (self.tokens, self.docs, *self.files):
            x.close()


def _write(folder: str, vocabulary: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, own = TaskContext.get(), encoder(vocabulary)
        name = f"{task.partitionId():06d}-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        shard: _Shard | None = None
        for batch in batches:
            for lo, hi, _, _ in flat.text_slices(batch.column(1)):
                shard = shard or _Shard(folder, name, own.dtype)
                shard.write(batch.column(0).slice(lo, hi - lo), *own.encode(batch.column(1).slice(lo, hi - lo).to_pylist()))
        if shard:
            shard.close()
            yield pa.RecordBatch.from_pylist([{"shard": task.partitionId(), "name": name, "n_docs": shard.n_docs,
                                               "n_tokens": shard.n_tokens}],
                                             pa.schema([("shard", pa.int64()), ("name", pa.string()),
                                                        ("n_docs", pa.int64()), ("n_tokens", pa.int64())]))

    return run


def write_tokens(docs: DataFrame, folder: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """Write the shards below folder (shared by all executors); return the
    manifest (shard, name, n_docs, n_tokens, base): base is the number of ids
    in all shards before."""
    place = [F.col("doc_id").asc_nulls_first(), F.length("text"), F.xxhash64("text"), F.col("text")]
    ordered = text_input(docs).repartitionByRange(*place[:3]).sortWithinPartitions(*place)
    manifest = stored(ordered.mapInArrow(_write(folder, vocabulary), "shard long, name string, n_docs long, n_tokens long"),
                      "token-manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    return manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0).cast("long")))


def open_shard(folder: str, kind: str, name: str) -> pa.ipc.RecordBatchFileReader:
    """A shard's file; a local one is mapped, so its buffers are not copied."""
    fs, path = _file_system(folder)
    where = f"{path}/{kind}-{name}.arrow"
    return pa.ipc.open_file(pa.memory_map(where) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(where))


def read_sequence(folder: str, name: str, i: int) -> tuple[np.ndarray, pa.Array]:
    """Sequence i of a shard and its mask, without reading any other."""
    batch = open_shard(folder, "tokens", name).get_batch(i // BATCH_SEQUENCES)
    return (batch.column(0)[i % BATCH_SEQUENCES].values.to_numpy(zero_copy_only=True), batch.column(1)[i % BATCH_SEQUENCES].values)


def _read(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, base in zip(*(c.to_pylist() for c in batch.columns)):
                tokens, docs = open_shard(folder, "tokens", name), open_shard(folder, "docs", name)
                block = SEQUENCE * BATCH_SEQUENCES
                at, ids = -1, np.zeros(0)
                for d in range(docs.num_record_batches):
                    part = docs.get_batch(d)
                    crcs = np.zeros(part.num_rows, np.int64)
                    start, size = (part.column(i).to_numpy() for i in (1, 2))
                    for r, (s, n) in enumerate(zip(start.tolist(), size.tolist())):
                        crc, end = 0, s + n
                        while s < end:
                            if s // block != at:
                                at = s // block
                                ids = tokens.get_batch(at).column(0).flatten().to_numpy(zero_copy_only=True)
                            piece = ids[s - at * block:min(end, (at + 1) * block) - at * block]
                            crc = zlib.crc32(piece.astype("<u4").tobytes(), crc)
                            s += len(piece)
                        crcs[r] = crc
                    yield pa.RecordBatch.from_arrays([part.column(0), pa.array(start + base), part.column(2), pa.array(crcs)],
                                                     names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return run


def read_documents(manifest: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""
    shards = max(1, manifest.count())  # one row per shard; a task for each, which no coalescing joins
    each = manifest.select("shard", "name", "base").repartitionByRange(shards, "shard").select("name", "base")
    return each.mapInArrow(_read(folder), "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Write docs as token files below the shared folder and read them back."""
    folder = scratch_path(docs.sparkSession, "token-files")
    return read_documents(write_tokens(docs, folder, vocabulary), folder)
