"""Language ID by segmentation-marginalised unigrams.

A language is a probability for every piece of a fixed public vocabulary.  The
score of a word is the sum, over all ways to cut it into pieces, of the
product of their probabilities (a forward algorithm); a text's score is the
product over its words, and the language of the highest score is predicted.
The probabilities are learned from labelled texts by expectation maximisation
with the same sum over segmentations.

A word is a maximal run of letters, lower-cased, behind the vocabulary's word
mark; a run of more than ``LONGEST`` letters is scored in pieces of that many.
A letter that no piece covers costs every language the same.  Each different
word is scored once per worker and then looked up.

The fit uses a bounded sample: about ``FIT_DOCS`` texts of each language,
chosen by a hash of the doc_id.  Scoring reads every text whole.

Defined results: null or empty texts and texts without a letter give ``und``
with score 0.  Repeated rows are scored alike.  Without any labelled training
text every text is ``und``.
"""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import flat
from tidemark.llm.store import stored, text_batches, text_input

VOCABULARY = "piece_bpe_32k.model"
FIT_DOCS = 600
ROUNDS = 3
LONGEST = 64
SMOOTHING = 0.1
UNKNOWN = 1e-7
UNDETERMINED = "und"
KEPT_WORDS = 1_000_000
_MARK = "▁"


class Pieces:
    """The vocabulary's text pieces: string -> id; id 0 is no piece."""

    def __init__(self, vocabulary: str):
        import os

        import public_tokenizers
        import sentencepiece
        path = vocabulary if os.path.isabs(vocabulary) else public_tokenizers.path(vocabulary)
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        texts = [sp.id_to_piece(i) for i in range(sp.get_piece_size())
                 if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        texts = [t for t in texts if t == t.lower() and t.strip(_MARK).isalpha() or t == _MARK]
        self.ids = {t: i for i, t in enumerate(texts, 1)}
        self.size = len(texts) + 1
        self.longest = max(map(len, texts))

    def lattice(self, words: list[str]) -> np.ndarray:
        """[word, start, length - 1] piece ids for words of one length."""
        n, get = len(words[0]), self.ids.get
        spans = [(i, j) for i in range(n) for j in range(i + 1, min(n, i + self.longest) + 1)]
        out = np.zeros((len(words), n, min(n, self.longest)), np.int32)
        rows = np.array([[get(w[i:j], 0) for i, j in spans] for w in words], np.int32)
        at = np.array(spans)
        out[:, at[:, 0], at[:, 1] - at[:, 0] - 1] = rows
        return out


_pieces: dict[str, Pieces] = {}


def pieces(vocabulary: str) -> Pieces:
    """One per process."""
    if vocabulary not in _pieces:
        _pieces[vocabulary] = Pieces(vocabulary)
    return _pieces[vocabulary]


def words_of(piece: str) -> list[str]:
    """The marked, lower-cased words in a run of non-space characters."""
    low = piece.lower()
    runs = [low] if low.isalpha() else "".join(c if c.isalpha() else " " for c in low).split()
    return [_MARK + r[i:i + LONGEST] for r in runs for i in range(0, len(r), LONGEST)]


def forward(ids: np.ndarray, probs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward sums alpha[word, end, language], rescaled at each end, and the
    logarithms of the scales.  probs[0] is 0: no piece."""
    n_words, n, longest = ids.shape
    alpha = np.zeros((n_words, n + 1, probs.shape[1]))
    scale = np.zeros((n_words, n + 1, probs.shape[1]))
    alpha[:, 0] = 1.0
    for end in range(1, n + 1):
        # the sums before `end` are brought to the scale of the last one
        here = alpha[:, end - 1] * np.where(ids[:, end - 1, 0] == 0, UNKNOWN, 0.0)[:, None]
        for k in range(min(longest, end)):
            own = ids[:, end - 1 - k, k]
            here = here + alpha[:, end - 1 - k] * probs[own] * np.exp(scale[:, end - 1 - k] - scale[:, end - 1])
        alpha[:, end] = 1.0
        scale[:, end] = scale[:, end - 1] + np.log(here)
    return alpha, scale


def word_scores(words: list[str], model_probs: np.ndarray, own: Pieces) -> np.ndarray:
    """Log score of each word in each language."""
    out = np.zeros((len(words), model_probs.shape[1]))
    by_length: dict[int, list[int]] = defaultdict(list)
    for i, w in enumerate(words):
        by_length[len(w)].append(i)
    for rows in by_length.values():
        for at in range(0, len(rows), 4096):
            part = rows[at:at + 4096]
            out[part] = forward(own.lattice([words[i] for i in part]), model_probs)[1][:, -1]
    return out


def _expected(words: list[str], weight: np.ndarray, probs: np.ndarray, own: Pieces) -> np.ndarray:
    """Expected piece counts per language; weight[word, language] is its count."""
    out = np.zeros_like(probs)
    by_length: dict[int, list[int]] = defaultdict(list)
    for i, w in enumerate(words):
        by_length[len(w)].append(i)
    for n, rows in by_length.items():
        for at in range(0, len(rows), 4096):
            part = rows[at:at + 4096]
            ids = own.lattice([words[i] for i in part])
            _, head = forward(ids, probs)
            back = np.full((len(part), n + 1, probs.shape[1]), -np.inf)  # log sums from each start
            back[:, n] = 0.0
            with np.errstate(divide="ignore"):
                for start in range(n - 1, -1, -1):
                    terms = [np.log(probs[ids[:, start, k]]) + back[:, start + 1 + k] for k in range(min(ids.shape[2], n - start))]
                    terms.append(np.where(ids[:, start, 0] == 0, np.log(UNKNOWN), -np.inf)[:, None] + back[:, start + 1])
                    back[:, start] = np.logaddexp.reduce(np.stack(terms))
                for start in range(n):
                    for k in range(min(ids.shape[2], n - start)):
                        got = ids[:, start, k]
                        hit = np.flatnonzero(got)
                        if len(hit):
                            share = np.exp(head[hit, start] + np.log(probs[got[hit]]) + back[hit, start + 1 + k] - head[hit, n])
                            np.add.at(out, got[hit], share * weight[part][hit])
    return out


@dataclass(frozen=True)
class Model:
    languages: list[str]
    probs: np.ndarray  # [piece, language]
    vocabulary: str


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()
    for batch in batches:
        for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for piece, n in Counter((text or "").split()).items():
                for word in words_of(piece):
                    counts[lang, word] += n
    keys = list(counts)
    yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
                                      pa.array(list(counts.values()), pa.int64())], names=["lang", "word", "n"])


def _e_step(languages: list[str], probs: np.ndarray, vocabulary: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, column = pieces(vocabulary), {x: i for i, x in enumerate(languages)}
        total = np.zeros_like(probs)
        for batch in batches:
            c = flat.columns_of(batch)
            words, back = np.unique(np.array(c["word"].to_pylist(), object), return_inverse=True)
            weight = np.zeros((len(words), len(languages)))
            np.add.at(weight, (back, [column[x] for x in c["lang"].to_pylist()]), c["n"].to_numpy())
            total += _expected(words.tolist(), weight, probs, own)
        piece, lang = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(piece, pa.int64()), pa.array(lang, pa.int64()), pa.array(total[piece, lang])],
                                         names=["piece", "lang", "n"])

    return run


def train(docs: DataFrame, vocabulary: str = VOCABULARY) -> Model:
    """Learn piece probabilities from doc_id, text and lang of the rows given."""
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                        F.col("lang").cast("string").alias("lang")).where("lang is not null and text is not null")
    totals = {r["lang"]: r["n"] for r in named.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # a row per language
    languages, own = sorted(totals), pieces(vocabulary)
    probs = np.full((own.size, len(languages)), 1.0 / own.size)
    probs[0] = 0.0
    if not languages:
        return Model([], probs, vocabulary)
    rate = F.element_at(F.create_map(*[F.lit(x) for k, n in totals.items() for x in (k, min(1.0, FIT_DOCS / n))]), F.col("lang"))
    sample = named.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < rate * (1 << 30)).select("text", "lang")
    words = stored(sample.repartition(12).mapInArrow(_word_counts, "lang string, word string, n long")
                   .groupBy("lang", "word").agg(F.sum("n").alias("n")), "fit-words").repartition(12)
    for _ in range(ROUNDS):
        got = (words.mapInArrow(_e_step(languages, probs, vocabulary), "piece long, lang long, n double")
               .groupBy("piece", "lang").agg(F.sum("n").alias("n")).toPandas())  # at most pieces x languages
        counts = np.zeros_like(probs)
        counts[got["piece"].to_numpy(), got["lang"].to_numpy()] = got["n"].to_numpy()
        counts[1:] += SMOOTHING
        probs = counts / counts.sum(axis=0)
    return Model(languages, probs, vocabulary)


_kept: dict[bytes, "_Scores"] = {}


def _scores_of(model: Model) -> "_Scores":
    """One table per worker process, kept for the model's later tasks."""
    key = hashlib.sha256(model.probs.tobytes()).digest()
    if key not in _kept:
        _kept.clear()
        _kept[key] = _Scores(model)
    return _kept[key]


class _Scores(dict):
    """Run of non-space characters -> row of a table of log scores; row 0: no letter."""

    def __init__(self, model: Model):
        super().__init__()
        self.model, self.own = model, pieces(model.vocabulary)
        self.restart()

    def restart(self) -> None:
        self.clear()
        self.table = np.zeros((1, len(self.model.languages)), np.float32)
        self.waiting: list[list[str]] = []

    def __missing__(self, piece: str) -> int:
        words = words_of(piece)
        if words:
            self.waiting.append(words)
        row = self[piece] = len(self.table) + len(self.waiting) - 1 if words else 0
        return row

    def flush(self) -> None:
        if self.waiting:
            sizes = np.array([len(w) for w in self.waiting])
            scores = word_scores([w for ws in self.waiting for w in ws], self.model.probs, self.own)
            at = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            self.table = np.concatenate([self.table, np.add.reduceat(scores, at).astype(np.float32)])
            self.waiting = []


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score) for every row of docs; score is the chance of
    the predicted language against the other learned ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = _scores_of(model)
        look = scores.__getitem__
        names = np.array([*model.languages, UNDETERMINED], object)
        for batch in flat.sliced(batches, "text"):
            if len(scores) > KEPT_WORDS:
                scores.restart()
            rows: list[int] = []
            ends = np.zeros(batch.num_rows, np.int64)
            for i, text in enumerate(batch.column(1).to_pylist()):
                rows.append(0)
                if text and model.languages:
                    rows.extend(map(look, text.split()))
                ends[i] = len(rows)
            scores.flush()
            at = np.array(rows, np.int64)
            starts = np.concatenate([[0], ends[:-1]])
            best, chance = np.full(len(ends), len(model.languages)), np.zeros(len(ends))
            if model.languages:
                known = np.add.reduceat((at > 0).astype(np.int64), starts) > 0
                total = np.add.reduceat(scores.table[at].astype(np.float64), starts)
                total -= total.max(axis=1, keepdims=True)
                best[known] = total.argmax(axis=1)[known]
                chance[known] = 1.0 / np.exp(total[known]).sum(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names[best], pa.string()), pa.array(chance)],
                                             names=["doc_id", "lang_pred", "score"])

    docs = text_input(docs)
    text_batches(docs.sparkSession, 2000)
    return docs.mapInArrow(run, "doc_id long, lang_pred string, score double")
