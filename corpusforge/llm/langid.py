"""Language identification by multilingual mixture inference.

A model of byte trigrams per language is learned from labelled rows. A document is a mixture: each word is drawn
from one of its languages, with likelihoods from the word's trigrams. Expectation-maximisation estimates the
proportions, and the set of languages is the one, among the 1, 2, 3 ... strongest, with the best penalised
likelihood (each further language costs half the logarithm of the number of words, times ``penalty``).

Defined cases: a null text, or one without any letter, gets ``und`` with score 0, as does any text if there is no
labelled row to learn from. Ties go to the first language in code point order. Labels may name any languages; null
labels, null texts and texts without letters teach nothing. Repeated rows count each in learning and are predicted
alike. Empty tables give no rows. Columns other than those named are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusforge.llm.kernels import U

UNKNOWN = "und"
_table_bits = 17
_letter = np.zeros(256, dtype=bool)
_letter[128:] = True
_letter[65:91] = _letter[97:123] = True


@dataclass(frozen=True)
class LangConfig:
    #: Labelled documents to learn from, about; more are thinned by a hash of their id.
    max_train_docs: int = 20_000
    rounds: int = 10
    penalty: float = 4.0
    smoothing: float = 0.5


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def word_trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(slot of each trigram, index of each word's first trigram, index of each text's first word)``.

    Words are runs of letters, lower-cased, with a blank at both ends, as UTF-8 bytes. Both index arrays end in the
    total.
    """
    parts = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
    buf = np.frombuffer(b" " + b" ".join(parts) + b"  ", dtype=np.uint8)
    inside = _letter[buf]
    buf = np.where(inside, buf, np.uint8(32))
    middle = np.flatnonzero(inside)  # one trigram around each byte of a word
    codes = (buf[middle - 1].astype(U) << U(16)) | (buf[middle].astype(U) << U(8)) | buf[middle + 1]
    slots = ((codes * U(0x9E3779B97F4A7C15)) >> U(64 - _table_bits)).astype(np.int64)
    first = ~inside[middle - 1]
    starts = np.flatnonzero(first)
    at = 1 + np.cumsum([0] + [len(p) + 1 for p in parts])
    return slots, np.append(starts, len(middle)), np.searchsorted(middle[starts], at)


def _steps(texts: list[str | None], most: int = 2_000_000) -> Iterator[np.ndarray]:
    run, size = [], 0
    for i, t in enumerate(texts):
        run.append(i)
        size += len(t or "")
        if size > most:
            yield np.array(run)
            run, size = [], 0
    if run:
        yield np.array(run)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trigram counts per language, summed over the whole split."""
    counts: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(1 << _table_bits, dtype=np.int64))
    for b in batches:
        texts, langs = b.column("text").to_pylist(), b.column("lang").to_pylist()
        for run in _steps(texts):
            by = defaultdict(list)
            for i in run:
                if has_letter(texts[i]):
                    by[langs[i]].append(texts[i])
            for lang, own in by.items():
                counts[lang] += np.bincount(word_trigrams(own)[0], minlength=1 << _table_bits)
    for lang, c in counts.items():
        slot = np.flatnonzero(c)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(slot), pa.string()), pa.array(slot, pa.int64()), pa.array(c[slot], pa.int64())], names=["lang", "slot", "n"])


def learn(labelled: DataFrame, config: LangConfig = LangConfig()) -> tuple[list[str], np.ndarray]:
    """``(languages, log-likelihood of each slot by language)`` from rows with ``doc_id, text, lang``.

    What comes to the driver is bounded by the number of languages and the size of the slot table.
    """
    rows = labelled.where("lang IS NOT NULL AND text IS NOT NULL")
    total = rows.count()
    if total > config.max_train_docs:
        part = int(config.max_train_docs / total * (1 << 30))
        rows = rows.where(F.xxhash64("doc_id").bitwiseAND(F.lit((1 << 30) - 1)) < part)
    sums = rows.select("text", "lang").mapInArrow(_count, "lang string, slot long, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(sums["lang"].unique().tolist())
    table = np.full((len(langs), 1 << _table_bits), config.smoothing)
    for k, lang in enumerate(langs):
        own = sums[sums["lang"] == lang]
        table[k, own["slot"].to_numpy()] += own["n"].to_numpy()
    return langs, np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32).T.copy()


def mixtures(words: np.ndarray, at: np.ndarray, config: LangConfig) -> tuple[np.ndarray, np.ndarray]:
    """``(proportions, chosen)`` per document from word log-likelihoods (words x languages).

    ``at`` holds each document's first word and the total; documents without words are not allowed.
    """
    n, (starts, docs) = np.diff(at), (at[:-1], len(at) - 1)
    owner = np.repeat(np.arange(docs), n)
    top = words.max(axis=1, keepdims=True)
    lik = np.exp(words - top, dtype=np.float64)
    base = np.add.reduceat(top[:, 0].astype(np.float64), starts)
    L = words.shape[1]

    def em(pi: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
        for _ in range(rounds):
            r = lik * pi[owner]
            r /= np.maximum(r.sum(axis=1, keepdims=True), 1e-300)
            pi = np.add.reduceat(r, starts, axis=0) / n[:, None]
        ll = np.add.reduceat(np.log(np.maximum((lik * pi[owner]).sum(axis=1), 1e-300)), starts) + base
        return pi, ll

    full, full_ll = em(np.full((docs, L), 1.0 / L), config.rounds)
    rank = np.argsort(np.argsort(-full, axis=1, kind="stable"), axis=1, kind="stable")
    best, best_pi = np.full(docs, -np.inf), full.copy()
    for size in range(1, L + 1):
        if size == L:
            pi, ll = full, full_ll
        else:
            pi = np.where(rank < size, np.maximum(full, 1e-9), 0.0)
            pi, ll = em(pi / pi.sum(axis=1, keepdims=True), 0 if size == 1 else max(config.rounds // 2, 1))
        value = ll - 0.5 * config.penalty * (size - 1) * np.log(np.maximum(n, 2))
        better = value > best
        best = np.where(better, value, best)
        best_pi[better] = pi[better]
        if size > 1 and not better.any():
            break
    return best_pi, best_pi > 0


def _predict(batches: Iterator[pa.RecordBatch], langs: list[str], model: np.ndarray, config: LangConfig) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = b.column("text").to_pylist()
        pred, score, sets = [UNKNOWN] * len(texts), np.zeros(len(texts)), [None] * len(texts)
        for run in _steps(texts) if langs else ():
            use = np.array([i for i in run if has_letter(texts[i])], dtype=np.int64)
            if not len(use):
                continue
            slots, starts, at = word_trigrams([texts[i] for i in use])
            some = np.diff(at) > 0
            use, at = use[some], np.append(at[:-1][some], at[-1])
            if not len(use):
                continue
            pi, chosen = mixtures(np.add.reduceat(model[slots], starts[:-1], axis=0), at, config)
            win = pi.argmax(axis=1)
            for k, i in enumerate(use):
                pred[i] = langs[win[k]]
                sets[i] = [langs[j] for j in np.flatnonzero(chosen[k])]
            score[use] = np.clip(pi[np.arange(len(use)), win], 0.0, 1.0)
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), b.column("held_out"), pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(sets, pa.list_(pa.string()))],
            names=["doc_id", "held_out", "lang_pred", "score", "lang_set"],
        )


def identify(docs: DataFrame, labelled: DataFrame, config: LangConfig = LangConfig()) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, lang_set`` of every row of ``docs`` (``doc_id, text, held_out``)."""
    langs, model = learn(labelled, config)
    held = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select("doc_id", "text", "held_out").mapInArrow(lambda it: _predict(it, langs, held.value, config), "doc_id long, held_out boolean, lang_pred string, score double, lang_set array<string>")


def identify_documents(docs: DataFrame, config: LangConfig = LangConfig()) -> DataFrame:
    """Learns from two thirds of the labelled rows (by CRC-32 of the id as text) and predicts every row."""
    split = docs.withColumn("held_out", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False)))
    return identify(split, split.where(~F.col("held_out")).select("doc_id", "text", "lang"), config)
