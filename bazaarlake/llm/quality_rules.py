"""Quality rules: counting rules, then a hashed n-gram log-likelihood ratio of trusted text against all text.

Byte 3-grams and words are hashed into a fixed number of buckets each. For both, two multinomials are counted: one over the labelled good
documents whose id has an even hash (the trusted target), one over every document. A bucket's weight is the logarithm of how often the target has it
against how often it would by the raw multinomial, ``SMOOTH`` added to both: what is rare in all text says little, what is common and missing in the
target says much. A document's score is the mean weight of its byte n-grams plus the mean weight of its words, so it does not grow with the
length; weights are rounded to 2**-16, so that sums are exact and the same in any order. The threshold is the one that errs least on all other
labelled documents, those with an odd hash, an unjust rejection counting ``REJECT_COST`` times. Every label is used for one of the two.

Defined results: null or empty text has no words, all counts 0, score 0 and fails the base rules; repeated rows are
judged alike, one result per input row; a null id is carried along; without labels every score is 0 and the base rules
decide; other columns are ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm import bytewords

N = 3
BYTE_BUCKETS = 1 << 16
WORD_BUCKETS = 1 << 18
BUCKETS = BYTE_BUCKETS + WORD_BUCKETS
#: Added to the counts of the target and to those that the raw multinomial makes expect.
SMOOTH = 4.0
SCALE = 1 << 16
REJECT_COST = 5
#: Width of the score bins in which the threshold is sought.
BIN = 0.005
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Fixed: characters that count as symbols.
SYMBOLS = b"#*$%&|<>"

RESULT = (
    "doc_id {id}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, score double, kept boolean"
)


@dataclass
class Model:
    weights: np.ndarray  # of each bucket, times SCALE
    threshold: float


def byte_buckets(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of each byte n-gram that lies in one text, and its text's number."""
    size = np.diff(at)
    n = max(0, len(raw) - N + 1)
    doc = np.repeat(np.arange(len(size)), size)[:n]
    code = np.zeros(n, np.uint32)
    for j in range(N):
        code = code * np.uint32(256) + raw[j : j + n]
    code = (code * np.uint32(2654435769)) >> np.uint32(32 - BYTE_BUCKETS.bit_length() + 1)
    whole = np.arange(n) + N <= at[1:][doc] if n else np.zeros(0, bool)
    return code[whole], doc[whole]


def buckets(w: bytewords.Words, hashes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Buckets and text numbers of the byte n-grams, then of the words."""
    words = (hashes >> np.uint64(64 - WORD_BUCKETS.bit_length() + 1)).astype(np.int64) + BYTE_BUCKETS
    return [byte_buckets(w.raw, w.at), (words, w.doc)]


def scores(w: bytewords.Words, hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    n = len(w.count)
    out = np.zeros(n)
    for code, doc in buckets(w, hashes):
        run = np.concatenate([[0], np.cumsum(weights[code])])
        count = np.bincount(doc, minlength=n)
        edge = np.concatenate([[0], np.cumsum(count)])
        out += (run[edge[1:]] - run[edge[:-1]]) / np.maximum(count, 1) / SCALE
    return out


def weights_of(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log-likelihood ratio of each bucket, times SCALE, for the two kinds of n-grams by themselves."""
    out = np.zeros(BUCKETS, np.int64)
    for part in (slice(0, BYTE_BUCKETS), slice(BYTE_BUCKETS, BUCKETS)):
        expected = raw[part] * (target[part].sum() / max(1, raw[part].sum()))
        out[part] = np.round(np.log((target[part] + SMOOTH) / (expected + SMOOTH)) * SCALE)
    return out


def even(doc_id: Column) -> Column:
    """Whether a document belongs to the target's half; the other half is for the threshold."""
    return F.xxhash64(doc_id) % 2 == 0


def labelled(labels: DataFrame) -> DataFrame:
    """(doc_id, good, fit) of every labelled document.

    Good: quality 1 and not toxic. Of contradicting labels the bad one counts.
    """
    return (
        labels.where("doc_id is not null and quality is not null")
        .groupBy("doc_id")
        .agg(F.min((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).alias("good"))
        .select("doc_id", "good", even(F.col("doc_id")).alias("fit"))
    )


#: The name it had when it took a part of the labels.
labelled_sample = labelled


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Counts over all documents and over the trusted ones, then the threshold on the other labelled ones.

    The labels may be as many as the documents, so they are not broadcast: the texts of the target's half are shuffled
    to them, by the same plan at any size. Of the other half only ids and scores are.
    """
    known = labelled(labels).withColumnRenamed("doc_id", "labelled_id")
    # the hash depends on the type, so the documents' ids take that of the labels
    half = F.coalesce(even(F.col("doc_id").try_cast(known.schema["labelled_id"].dataType)), F.lit(False))
    half = half & F.col("doc_id").isNotNull()
    same = F.col("doc_id") == F.col("labelled_id")
    targets = docs.where(half).join(known.where("fit").hint("merge"), same, "left").select(
        "text", F.coalesce("good", F.lit(False)).alias("trusted")
    )
    others = docs.where(~half).select("text", F.lit(False).alias("trusted"))
    trusted = targets.union(others)

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw_count, target_count = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for part in bytewords.slices(batch):
                chosen = part.column("trusted").to_numpy(zero_copy_only=False)
                w = bytewords.words(part.column("text"))
                for code, doc in buckets(w, w.hashes()):
                    raw_count += np.bincount(code, minlength=BUCKETS)
                    if chosen.any():
                        target_count += np.bincount(code[chosen[doc]], minlength=BUCKETS)
        seen = np.flatnonzero(raw_count)
        yield pa.record_batch(
            [pa.array(seen.astype(np.int32)), pa.array(raw_count[seen]), pa.array(target_count[seen])],
            ["bucket", "raw", "target"],
        )

    rows = (
        trusted.mapInArrow(counts, "bucket int, raw long, target long")
        .groupBy("bucket")
        .agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
        .toPandas()  # at most BUCKETS rows
    )
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    raw[rows["bucket"]], target[rows["bucket"]] = rows["raw"], rows["target"]
    if not target.any():
        return Model(np.zeros(BUCKETS, np.int64), -np.inf)
    weights = weights_of(raw, target)

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in bytewords.slices(batch):
                w = bytewords.words(part.column("text"))
                judged = w.count >= MIN_WORDS  # shorter ones fail anyway
                bins = np.floor(scores(w, w.hashes(), weights) / BIN).astype(np.int64)[judged]
                yield pa.record_batch([part.column("doc_id").filter(pa.array(judged)), pa.array(bins)], ["doc_id", "bin"])

    held = docs.where(~half).select("doc_id", "text")
    scored = held.mapInArrow(binned, f"doc_id {dict(docs.dtypes)['doc_id']}, bin long")
    found = (
        scored.join(known.where("not fit"), same).groupBy("bin").agg(
            F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad")
        ).orderBy("bin").toPandas()  # scores lie within +-20, so at most 8000 bins
    )
    if not len(found) or not found["bad"].sum():
        return Model(weights, -np.inf)
    # rejecting all bins before k: the good ones among them are lost, the bad ones from k on are kept
    lost = np.concatenate([[0], found["good"].cumsum()])
    left = found["bad"].sum() - np.concatenate([[0], found["bad"].cumsum()])
    cost = REJECT_COST * lost + left
    best = int(np.argmin(cost))
    edges = [float(b) * BIN for b in found["bin"]] + [np.inf]
    if not best:
        return Model(weights, -np.inf)
    # midway in the gap between the last rejected bin and the first kept one
    low = float(found["bin"][best - 1] + 1) * BIN
    return Model(weights, (low + edges[best]) / 2 if np.isfinite(edges[best]) else low)


def measured(text: pa.Array, model: Model) -> dict[str, np.ndarray]:
    """The counts, the score and the verdict of each text."""
    w = bytewords.words(text)
    n = len(w.count)
    totals = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[w.at])
    in_word = ~bytewords.WHITE[w.raw]
    lead = (w.raw & 0xC0) != 0x80
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    hashes = w.hashes()
    begin, key = bytewords.windows(w, hashes, 3)
    doc = w.doc
    key = key ^ bytewords.mixed(doc[begin].astype(np.uint64))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(doc), bool)
    for j in range(3):
        covered[begin[twice] + j] = True
    dup_lines = np.zeros(n, np.int64)
    whole = w.raw.tobytes()
    for i in range(n):
        seen = set()
        lines = whole[w.at[i] : w.at[i + 1]].split(b"\n")
        if len(lines) > 1:
            for line in lines:
                if line in seen:
                    dup_lines[i] += 1
                elif line and not line.isspace():
                    seen.add(line)
    repeat = np.bincount(doc[covered], minlength=n)
    failed = (w.count < MIN_WORDS) | (100 * repeat > MAX_REPEAT_PERCENT * w.count)
    score = scores(w, hashes, model.weights)
    return {
        "n_words": w.count,
        "word_chars": totals(in_word & lead),
        "n_symbols": totals(symbol[w.raw]),
        "n_dup_lines": dup_lines,
        "n_repeat_words": repeat,
        "base_failed": failed,
        "score": score,
        "kept": ~failed & (score >= model.threshold),
    }


def quality_rules(docs: DataFrame, labels: DataFrame, model: Model | None = None) -> DataFrame:
    """Counts, score and verdict of every document; see the module's text."""
    rows = docs.select("doc_id", "text")
    model = model or fit(rows, labels)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in bytewords.slices(batch):
                found = measured(part.column("text"), model)
                yield pa.record_batch([part.column("doc_id"), *map(pa.array, found.values())], ["doc_id", *found])

    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(judged, RESULT.format(id=kind))


def keep_good(docs: DataFrame, labels: DataFrame, model: Model | None = None) -> DataFrame:
    """The documents that the rules keep, with all their columns."""
    model = model or fit(docs.select("doc_id", "text"), labels)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in bytewords.slices(batch):
                yield part.filter(pa.array(measured(part.column("text"), model)["kept"]))

    return docs.mapInArrow(kept, docs.schema)
