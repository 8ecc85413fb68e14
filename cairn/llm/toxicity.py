"""Toxicity by multiple-instance learning.

A document is a bag of sentences.  A sentence's probability is a logistic
function of hashed word features; the document's is their noisy-or,
``1 - prod(1 - p)``.  Only documents carry labels: gradients of the document
likelihood reach the sentences through the noisy-or, so the trained model also
tells which sentences offend.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm import runtime, wordhash
from cairn.llm.scratch import Scratch

#: Width of the feature table.
BUCKETS = 1 << 18
#: Bound of the training sample: labelled documents, and words of them.
TRAIN_DOCUMENTS = 8_000
TRAIN_WORDS = 5_000_000
#: Letters (bytes) of a word's prefix that make a second and a third feature.
PREFIXES = (4, 5)
SENTENCE_ENDS = b".!?\n"
EPOCHS = 50
RATE = 0.4
SPARSITY = 0.7
LEAST_DOCUMENTS = 6
LEAST_WEIGHT = 0.3
_PART = 1 << 20
#: A sentence with at least this probability is reported as offending.
OFFENDING = 0.5

_ENDS = np.zeros(256, dtype=bool)
_ENDS[list(SENTENCE_ENDS)] = True
_TRIM = np.zeros(256, dtype=bool)
_TRIM[list(b".,;:!?\"'()*%&$#|-")] = True

RESULT = "doc_id long, score double, n_sentences int, offending array<struct<start:int,end:int,score:double>>"
_RESULT_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("score", pa.float64()), ("n_sentences", pa.int32()),
    ("offending", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))),
])


@dataclass
class Sentences:
    """Features of a block's sentences; word j has features[:, j]."""

    features: np.ndarray  # (1 + len(PREFIXES), words) bucket numbers
    first_word: np.ndarray  # of each sentence
    document: np.ndarray  # of each sentence, within the block
    start: np.ndarray  # bytes within the block
    end: np.ndarray


def sentences(block: wordhash.Block) -> Sentences:
    """Cut a block's texts after words that end in, or are followed by a line end after, ``.!?``."""
    starts, ends = block.starts, block.ends
    n = len(starts)
    if not n:
        none = np.zeros(0, dtype=np.int64)
        return Sentences(np.zeros((1 + len(PREFIXES), 0), np.int64), none, none, none, none)
    document = np.repeat(np.arange(block.n_docs), np.diff(block.words))
    breaks = np.zeros(len(block.data) + 1, dtype=np.int64)
    np.cumsum(block.data == 10, out=breaks[1:])
    new = np.ones(n, dtype=bool)
    new[1:] = (
        _ENDS[block.data[ends[:-1] - 1]]
        | (breaks[starts[1:]] > breaks[ends[:-1]])
        | (document[1:] != document[:-1])
    )
    first = np.flatnonzero(new)
    last = np.append(first[1:], n) - 1
    return Sentences(_features(block), first, document[first], starts[first], ends[last])


def _features(block: wordhash.Block) -> np.ndarray:
    starts, ends = block.starts.copy(), block.ends.copy()
    for _ in range(4):  # surrounding punctuation is no part of a feature
        longer = ends - starts > 1
        starts += longer & _TRIM[block.data[starts]]
        longer = ends - starts > 1
        ends -= longer & _TRIM[block.data[ends - 1]]
    parts = [ends, *(np.minimum(ends, starts + k) for k in PREFIXES)]
    out = np.empty((len(parts), len(starts)), dtype=np.int64)
    for k, upto in enumerate(parts):
        piece = wordhash.Block(0, block.data, block.offsets, starts, upto, block.words)
        out[k] = ((piece.hashes() + np.uint64(k * 0x5851F42D4C957F2D)) & np.uint64(BUCKETS - 1)).astype(np.int64)
    return out


def _sentence_logits(s: Sentences, weights: np.ndarray, bias: float) -> np.ndarray:
    per_word = weights[s.features].sum(axis=0, dtype=np.float64)
    return np.add.reduceat(per_word, s.first_word) + bias if len(s.first_word) else np.zeros(0)


@dataclass
class Model:
    """Weights by bucket, and the bias of a sentence."""

    weights: np.ndarray
    bias: float

    def score(self, block: wordhash.Block) -> tuple[np.ndarray, Sentences, np.ndarray]:
        """Document scores, sentences and sentence probabilities of a block."""
        s = sentences(block)
        p = _sigmoid(_sentence_logits(s, self.weights, self.bias))
        log_clean = np.bincount(s.document, np.log1p(-np.minimum(p, 1 - 1e-12)), block.n_docs)
        return -np.expm1(log_clean), s, p


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def training_sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "toxic", max_documents: int = TRAIN_DOCUMENTS) -> DataFrame:
    """At most ``max_documents`` labelled texts that are not held out, in order of an id hash."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(
        F.col(id_col).alias("doc_id")).agg(F.max(label_col).cast("int").alias("label"))
    known = known.where(~held_out(F.col("doc_id")))
    # a threshold first, so that no more than about the sample itself is gathered to find its end
    share = min(1.0, (1.2 * max_documents + 100) / max(1, known.count()))
    near = known.where(F.xxhash64("doc_id") <= int(min(2**63 - 1, -(2**63) + share * 2**64)))
    known = near.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_documents)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return texts.join(F.broadcast(known.withColumn("turn", F.xxhash64("doc_id"))), "doc_id").where(F.col("text").isNotNull())


def held_out(doc_id) -> object:
    return F.crc32(doc_id.cast("string")) % 5 == 0


_TRAINING = "doc_id long, turn long, label int, words int, features binary, first_word binary"
_TRAINING_ARROW = pa.schema([("doc_id", pa.int64()), ("turn", pa.int64()), ("label", pa.int32()), ("words", pa.int32()),
                             ("features", pa.binary()), ("first_word", pa.binary())])


def _training_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows: dict[str, list] = {n: [] for n in _TRAINING_ARROW.names}
        ids, turns, labels = (b.column(c).to_pylist() for c in ("doc_id", "turn", "label"))
        for block in wordhash.blocks(b.column("text")):
            s = sentences(block)
            for d in range(block.n_docs):
                a, e = block.words[d], block.words[d + 1]
                own = s.first_word[(s.first_word >= a) & (s.first_word < e)] - a
                for name, value in zip(rows, (ids[block.first + d], turns[block.first + d], labels[block.first + d], int(e - a),
                                              s.features[:, a:e].astype(np.int32).tobytes(), own.astype(np.int32).tobytes())):
                    rows[name].append(value)
        yield pa.RecordBatch.from_pydict(rows, schema=_TRAINING_ARROW)


def _within(sizes: list[tuple[int, int, int]], max_words: int) -> list[tuple[int, int]]:
    """Documents and words of the first (turn, document, words) that the bound holds; what alone exceeds it is passed over."""
    taken, words = [], 0
    for _, doc, n in sorted(sizes):
        if n > max_words:
            continue
        if words + n > max_words:
            break
        taken.append((doc, n))
        words += n
    return sorted(taken)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", max_documents: int = TRAIN_DOCUMENTS,
          max_words: int = TRAIN_WORDS, epochs: int = EPOCHS) -> Model:
    """Fit on a bounded sample of labelled documents; none give the model that scores near 0.

    Both bounds are spent in order of an id hash, so the sample is a random one;
    a text that alone exceeds the bound of words is passed over.  Of several
    labels of one id the largest counts, null labels and labels without id do
    not; each text of a repeated id is a document of the sample.
    """
    runtime.prepare(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "toxicity")
    sample = scratch.cut(training_sample(docs, labels, id_col, text_col, label_col, max_documents).mapInArrow(
        _training_rows, _TRAINING), "sample")
    taken = _within([tuple(r) for r in sample.where("words > 0").select("turn", "doc_id", "words").collect()], max_words)
    places: dict[tuple[int, int], list[tuple[int, int]]] = {}
    total = 0
    for k, (doc, n) in enumerate(taken):
        places.setdefault((doc, n), []).append((k, total))
        total += n
    # straight into the arrays of the whole sample: the driver holds it once
    features = np.empty((1 + len(PREFIXES), total), dtype=np.int32)
    firsts, label = [np.zeros(0, dtype=np.int64)] * len(taken), np.zeros(len(taken))
    # only what is taken reaches the driver, so its words are bounded by max_words
    wanted = docs.sparkSession.createDataFrame([(k, max_words) for k in sorted({d for d, _ in taken})] or [(None, 0)], "doc_id long, most int")
    for r in sample.join(F.broadcast(wanted), "doc_id").where("words <= most").drop("most").toLocalIterator():
        free = places.get((r.doc_id, r.words))
        if free:
            k, at = free.pop()
            features[:, at : at + r.words] = np.frombuffer(r.features, np.int32).reshape(len(features), -1)
            firsts[k] = np.frombuffer(r.first_word, np.int32).astype(np.int64) + at
            label[k] = r.label
    scratch.drop(sample)
    if len(set(label)) < 2:
        return Model(np.zeros(BUCKETS), -12.0)
    none = np.zeros(0, dtype=np.int64)
    document = np.repeat(np.arange(len(taken)), [len(f) for f in firsts])
    return _fit(Sentences(features, np.concatenate(firsts), document, none, none), label, epochs)


def _fit(s: Sentences, y: np.ndarray, epochs: int = EPOCHS) -> Model:
    """Fit weights to document labels through the noisy-or; overwrites ``s.features``.

    The first pass, under an L1 penalty, selects features: one gets a weight
    only where it explains more of the likelihood's slope than a document or
    so, and is not weighed at all if fewer than ``LEAST_DOCUMENTS`` have it, so
    words of single documents cannot stand for their label.  The second pass
    fits the selected features without a penalty.
    """
    n_words = s.features.shape[1]
    sentence_of = np.repeat(np.arange(len(s.first_word), dtype=np.int32), np.diff(np.append(s.first_word, n_words)))
    known = np.flatnonzero(_document_counts(s, sentence_of, len(y)) >= LEAST_DOCUMENTS)
    bias = _base_bias(s, y)
    # bucket numbers become numbers of known features, or the one after these
    column = np.full(BUCKETS, len(known), dtype=np.int32)
    column[known] = np.arange(len(known))
    parts = []  # (feature, sentence) of limited length: temporaries stay small
    for row in s.features:
        for lo in range(0, n_words, _PART):
            code = row[lo : lo + _PART]
            code[:] = column[code]
            parts.append((code, sentence_of[lo : lo + _PART]))
    w, bias = _descend(s, y, parts, bias, epochs, SPARSITY, np.zeros(len(known)))
    chosen = np.append(np.abs(w) > LEAST_WEIGHT, False)
    column = (np.cumsum(chosen) - 1).astype(np.int32)
    parts = [(column[code[kept]], owner[kept]) for code, owner in parts for kept in [chosen[code]]]
    w, bias = _descend(s, y, parts, bias, 2 * epochs, 0.0, w[chosen[:-1]])
    weights = np.zeros(BUCKETS)
    weights[known[chosen[:-1]]] = w
    return Model(weights, float(bias))


def _document_counts(s: Sentences, sentence_of: np.ndarray, n: int) -> np.ndarray:
    """In how many documents each feature occurs, by groups of whole documents."""
    counts = np.zeros(BUCKETS, dtype=np.int64)
    at = np.append(s.first_word, len(sentence_of))[np.searchsorted(s.document, np.arange(0, n + 500, 500))]
    for lo, hi in zip(at[:-1], at[1:]):
        document = s.document[sentence_of[lo:hi]].astype(np.int64)
        for row in s.features:
            counts += np.bincount(np.unique(row[lo:hi] * np.int64(n) + document) // n, minlength=BUCKETS)
    return counts


def _base_bias(s: Sentences, y: np.ndarray) -> float:
    """The bias at which the mean document score is the mean label, without any feature."""
    bias = -6.0
    for _ in range(40):
        clean = np.bincount(s.document, minlength=len(y)) * np.log1p(-_sigmoid(np.array(bias)))
        bias += 0.5 * np.log((y.mean() + 1e-6) / max(1e-9, float((-np.expm1(clean)).mean())))
    return float(bias)


def _slopes(z: np.ndarray, document: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Slope of -log likelihood of the document labels at each sentence's logit: p in a clean bag, -p(1-P)/P in an offending one."""
    p = np.minimum(_sigmoid(z), 1 - 1e-9)
    clean = np.bincount(document, np.log1p(-p), len(y))
    doc = np.clip(-np.expm1(clean), 1e-9, 1.0)
    return p * np.where(y > 0, -np.exp(clean) / doc, 1.0)[document]


def _descend(s: Sentences, y: np.ndarray, parts: list[tuple[np.ndarray, np.ndarray]], bias: float,
             epochs: int, sparsity: float, w: np.ndarray) -> tuple[np.ndarray, float]:
    """Adagrad over the whole sample from the weights ``w``; a part's features from len(w) on have none."""
    known = len(w)
    total, bias_total = np.ones(known), 1.0
    n = len(s.first_word)
    for _ in range(epochs):
        z = np.full(n, bias)
        wide = np.append(w, 0.0)
        for code, owner in parts:
            z += np.bincount(owner, wide[code], n)
        g = _slopes(z, s.document, y)
        gw = np.zeros(known)
        for code, owner in parts:
            gw += np.bincount(code, g[owner], known + 1)[:known]
        total += gw * gw
        step = RATE / np.sqrt(total)
        w -= step * gw
        w = np.sign(w) * np.maximum(0, np.abs(w) - step * sparsity)
        gb = g.sum()
        bias_total += gb * gb
        bias -= RATE * gb / np.sqrt(bias_total)
    return w, bias


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Score every whole text and locate its offending sentences.

    Returns ``doc_id``, ``score`` (0 to 1), ``n_sentences`` and ``offending``:
    byte ranges of sentences of probability 0.5 or more.  Null, empty and
    wordless texts have no sentence and score 0.  Repeated rows are scored one
    by one; an empty table gives none; no other column is read.
    """
    runtime.prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((model.weights.astype(np.float32), model.bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = shared.value
        known = Model(weights, bias)
        for b in batches:
            scores, counts, found = np.zeros(b.num_rows), np.zeros(b.num_rows, np.int32), [[] for _ in range(b.num_rows)]
            for block in wordhash.blocks(b.column("text")):
                at = slice(block.first, block.first + block.n_docs)
                scores[at], s, p = known.score(block)
                counts[at] = np.bincount(s.document, minlength=block.n_docs)
                for j in np.flatnonzero(p >= OFFENDING):
                    d = s.document[j]
                    found[block.first + d].append({
                        "start": int(s.start[j] - block.offsets[d]), "end": int(s.end[j] - block.offsets[d]),
                        "score": float(p[j])})
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").cast(pa.int64()), pa.array(scores), pa.array(counts),
                 pa.array(found, type=_RESULT_ARROW.field("offending").type)], schema=_RESULT_ARROW)

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, RESULT)


def without_toxic(docs: DataFrame, model: Model, limit: float, text_col: str = "text") -> DataFrame:
    """The documents that score below ``limit``, with their columns unchanged; rows are judged where they lie.

    Null, empty and wordless texts score 0.  Rows without id and repeated rows
    are judged like others; an empty table stays empty.
    """
    runtime.prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((model.weights.astype(np.float32), model.bias))
    schema = docs.schema
    names = [f"c{i}" for i in range(len(schema))]
    text_at = names[schema.names.index(text_col)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Model(*shared.value)
        for b in batches:
            scores = np.zeros(b.num_rows)
            for block in wordhash.blocks(b.column(text_at)):
                scores[block.first : block.first + block.n_docs] = known.score(block)[0]
            yield b.filter(pa.array(scores < limit))

    ddl = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, schema))
    return docs.toDF(*names).mapInArrow(run, ddl).toDF(*schema.names)
